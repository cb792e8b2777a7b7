"""Summaries of feature tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.numeric import count_where
from barloom.operators.split import PARTS, features_and_target

# First match wins, in this order; fixed words of the feature classes.
CLASS_WORDS = {
    "price": ["price", "high", "low", "open", "close"],
    "volume": ["volume"],
    "marketcap": ["marketcap"],
    "time": ["year", "month", "day", "time"],
    "technical": ["sma", "ema", "rsi", "macd", "bb"],
}


def feature_class(name: Column) -> Column:
    lower = F.lower(name)
    out = None
    for label, words in CLASS_WORDS.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(lower, F.lit(word))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise("statistical")


def feature_classes(df: DataFrame) -> DataFrame:
    """(column, class) for every column of a table."""
    names = [(c,) for c in df.columns if not c.startswith("_")]
    table = df.sparkSession.createDataFrame(names, "column string")
    return table.withColumn("class", feature_class(F.col("column")))


def feature_summary(df: DataFrame) -> DataFrame:
    """One row: columns, numeric and text columns, missing cells."""
    fields = [f for f in df.schema if not f.name.startswith("_")]
    numeric = sum(isinstance(f.dataType, T.NumericType) for f in fields)
    text = sum(isinstance(f.dataType, T.StringType) for f in fields)
    missing = sum((count_where(F.col(f.name).isNull()) for f in fields), F.lit(0).cast("long"))
    return df.agg(
        F.lit(len(fields)).cast("long").alias("total_features"),
        F.lit(numeric).cast("long").alias("numeric_features"),
        F.lit(text).cast("long").alias("categorical_features"),
        missing.alias("missing_values"),
    )


def pipeline_summary(df: DataFrame, target: str = "Close") -> DataFrame:
    """One row: rows, features, samples per part, the first ten feature names."""
    features, _ = features_and_target(df, target)
    shown = features[:10] + (["..."] if len(features) > 10 else [])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(features)).cast("long").alias("features"),
        *[count_where(F.col("split") == p).alias(f"{p}_samples") for p in PARTS],
        F.lit(", ".join(shown)).alias("feature_names"),
    )
