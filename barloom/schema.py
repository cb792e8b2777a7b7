"""Schemas of the bar tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BARS = T.StructType([
    T.StructField("SNo", T.LongType()),
    T.StructField("Name", T.StringType()),
    T.StructField("Symbol", T.StringType()),
    T.StructField("Date", T.StringType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
    T.StructField("Marketcap", T.DoubleType()),
])

# All columns as text, for checking which values do not fit their type.
RAW_BARS = T.StructType([T.StructField(f.name, T.StringType()) for f in BARS])

# A scoring request: a bar whose Close is not known yet.
REQUESTS = T.StructType([f for f in BARS if f.name != "Close"])


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, without this library's working columns."""
    return [
        f.name for f in df.schema
        if isinstance(f.dataType, T.NumericType) and not f.name.startswith("_")
    ]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL, the only missing value used here.

    Spark sorts NaN above every number and aggregates it as a value, so it has
    to go before the first quantile, maximum or mean.
    """
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def parse_date(col: Column, formats: tuple[str, ...] = ()) -> Column:
    """Text to a zone-free timestamp, NULL where it does not parse.

    ISO shapes (``2023-1-5``, ``2023-01-05 10:00:00``) need no format. Others
    are tried in the given order.
    """
    tries = [col.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(col, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)
