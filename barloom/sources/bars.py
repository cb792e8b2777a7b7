"""Reading bar tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schema import BARS, RAW_BARS, nan_to_null
from barloom.sources.sinks import SYMBOL_KEY, folder_of


def _chosen(df: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    if symbols is None:
        return df
    wanted = list(symbols)
    chosen = df.where(F.col("Symbol").isin(wanted))
    if SYMBOL_KEY in df.columns:  # reads only their folders
        chosen = chosen.where(F.col(SYMBOL_KEY).isin([folder_of(s) for s in wanted]))
    found = {r[0] for r in chosen.select("Symbol").distinct().collect()}  # at most the wanted ones
    if missing := [s for s in wanted if s not in found]:
        raise FileNotFoundError(f"no bars for {missing}")
    return chosen


def read_bars_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    symbols: Sequence[str] | None = None,
    schema: T.StructType = BARS,
) -> DataFrame:
    """Bars from CSV files with a header: one file, many, or a glob.

    The schema is given, not inferred; a value that does not fit becomes NULL.
    ``symbols`` keeps only these series and fails if one of them isn't there.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.schema(schema).csv(paths, header=True, mode="PERMISSIVE", enforceSchema=False)
    return _chosen(nan_to_null(df), symbols)


def read_raw_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The same files with every column as text, for type checks."""
    return read_bars_csv(spark, paths, schema=RAW_BARS)


def read_bars_parquet(
    spark: SparkSession, path: str, symbols: Sequence[str] | None = None
) -> DataFrame:
    """Bars or features from Parquet. Written with ``write_features``, a choice
    of symbols reads only their folders."""
    return _chosen(nan_to_null(spark.read.parquet(path)), symbols).drop(SYMBOL_KEY)
