"""Writing result tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.series import drop_working_columns

SYMBOL_KEY = "symbol_key"
KEY_START = "s_"
RUNS = "run_id string, kind string, name string, value double"


def folder_of(symbol: str) -> str:
    """The folder key of a symbol in a table of features."""
    return KEY_START + symbol


def write_bars_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    drop_working_columns(df).write.mode(mode).csv(path, header=True)


def write_features(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Features as Parquet, a folder per symbol. Rows come blocked by series and
    are written where they are, so a long series is written by many tasks.

    The symbol stays an ordinary text column; folders have a key of their own, which
    no reader takes for a number or a date.
    """
    key = F.when(F.col("Symbol").isNotNull(), F.concat(F.lit(KEY_START), F.col("Symbol").cast("string")))
    keyed = drop_working_columns(df).withColumn(SYMBOL_KEY, key)
    keyed.write.mode(mode).partitionBy(SYMBOL_KEY).parquet(path)


def write_summary(
    summary: DataFrame, path: str, version: str = "1.0.0", at: Column | None = None
) -> None:
    """A one-row summary as JSON, with the time and version of the job."""
    at = F.localtimestamp() if at is None else at
    stamped = summary.withColumns({
        "etl_timestamp": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"),
        "etl_version": F.lit(version),
    })
    stamped.coalesce(1).write.mode("overwrite").json(path)


def write_importances(importances: DataFrame, path: str) -> None:
    """Feature importances as one CSV file: a row per feature column."""
    importances.coalesce(1).write.mode("overwrite").csv(path, header=True)


def append_run(
    spark: SparkSession, path: str, run_id: str, values: dict[tuple[str, str], float]
) -> None:
    """Add one run to the run table: ``(kind, name) -> value``, where kind is
    param, cv, train, validation, test or importance.

    A run has a folder of its own, with one file. A run of the same id is replaced, so a
    job that is tried again counts once; other runs are not touched. Values that are None are left out.
    """
    if not run_id:
        raise ValueError("a run needs an id")
    rows = [(run_id, kind, name, float(v)) for (kind, name), v in values.items() if v is not None]
    (spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path).select("run_id", "kind", "name", "value")
