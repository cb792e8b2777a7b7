"""Cleaning of raw bars."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import config
from barloom.operators.series import POS, drop_working_columns, number_rows
from barloom.schema import nan_to_null, parse_date


def _first_of(df: DataFrame, subset: list[str]) -> DataFrame:
    """Of rows equal in ``subset`` the first by date and serial number; of equal ones the
    smallest row, so that every run keeps the same."""
    order = [c for c in ("Date", "SNo") if c in df.columns]
    row = F.struct(*df.columns)
    first = F.min(F.struct(*order, row.alias("_row")))
    return df.groupBy(*[F.col(c).alias(f"_by_{c}") for c in subset]).agg(first.alias("_first")).select("_first._row.*")


def parse_and_fix(
    df: DataFrame, date_formats: tuple[str, ...] = (), subset: Sequence[str] | None = None
) -> DataFrame:
    """Drop rows without a readable date, drop repeated rows, make prices and
    volumes positive. Rows keep their source serial number."""
    df = nan_to_null(df)
    if isinstance(df.schema["Date"].dataType, T.StringType):
        df = df.withColumn("Date", parse_date(F.col("Date"), date_formats))
    df = df.where(F.col("Date").isNotNull())
    df = _first_of(df, list(subset)) if subset else df.dropDuplicates()
    signed = [c for c in [*config.PRICE_COLUMNS, "Volume"] if c in df.columns]
    return df.withColumns({c: F.abs(c) for c in signed})


def clean_bars(
    df: DataFrame,
    date_formats: tuple[str, ...] = (),
    subset: Sequence[str] | None = None,
    keep_positions: bool = False,
) -> DataFrame:
    """Cleaned bars, with ``SNo`` renumbered 1..n per symbol in date order.

    With ``keep_positions`` the result also carries the working columns that the
    feature step needs, so that nothing has to be numbered twice.
    """
    order = [c for c in ("Date", "SNo") if c in df.columns]
    numbered = number_rows(parse_and_fix(df, date_formats, subset), order)
    if "SNo" in df.columns:
        numbered = numbered.withColumn("SNo", F.col(POS))
    return numbered if keep_positions else drop_working_columns(numbered)
