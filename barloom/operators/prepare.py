"""Encoding, imputing and scaling, fitted on the training rows."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.quantiles import SORTED_ROWS, exact_quantiles, quantile_name
from barloom.operators.series import BLOCK_ROWS, KEYS, POS, in_blocks, number_rows
from barloom.schema import numeric_columns
from barloom.session import stored

CATEGORIES = ("Name", "Symbol")
STATISTICS = "feature string, median double, mean double, sd double"


def category_codes(df: DataFrame, columns: Sequence[str] = CATEGORIES) -> DataFrame:
    """(column, value, code): codes 0, 1, ... in the sorted order of the values."""
    values = None
    for c in columns:
        one = df.where(F.col(c).isNotNull()).select(
            F.lit(c).alias("column"), F.col(c).alias("value")
        ).distinct()
        values = one if values is None else values.unionByName(one)
    numbered = number_rows(values, order=("value",), symbol="column")
    return numbered.select("column", "value", (F.col(POS) - 1).cast("double").alias("code"))


def encode(
    df: DataFrame, codes: DataFrame, columns: Sequence[str] = CATEGORIES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Date as days since 1970-01-01, categories as codes (-1: missing or unseen),
    only numeric columns kept (beside the working columns and ``split``).

    Codes are looked up once per block and value and joined back on the block, so
    a frequent value does not end in one join task. The looked-up codes are stored
    to let the join see their size.
    """
    if "Date" in df.columns:
        df = df.withColumn("Date", F.unix_date(F.col("Date").cast("date")).cast("double"))
    present = [c for c in columns if c in df.columns]
    df = in_blocks(df, block_rows)
    for c in present:
        code = codes.where(F.col("column") == c).select(
            F.col("value").alias(c), F.col("code").alias("_code")
        )
        seen = df.where(F.col(c).isNotNull()).select(*KEYS, c).distinct().join(code, c)
        seen = stored(seen, "seen")
        df = df.join(seen, [*KEYS, c], "left").withColumn(
            c, F.coalesce("_code", F.lit(-1.0))
        ).drop("_code")
    df = df.drop("_block")
    keep = {*numeric_columns(df), "split", "role"}
    return df.select(*[c for c in df.columns if c in keep or c.startswith("_")])


@dataclass(frozen=True)
class Statistics:
    """Median, mean and population standard deviation of each feature.

    One entry per column of the table: its size does not depend on the rows.
    """

    values: dict[str, tuple[float, float, float]]

    @staticmethod
    def fit(
        df: DataFrame, features: Sequence[str], sorted_rows: int = SORTED_ROWS
    ) -> "Statistics":
        """Fit on the rows given; missing values are imputed before mean and sd."""
        medians = exact_quantiles(
            df, features, [0.5], whole_table=True, sorted_rows=sorted_rows
        ).first()
        median = {c: medians[quantile_name(c, 0)] if medians else None for c in features}
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(median[c])) for c in features}
        row = df.agg(
            *[F.avg(x).alias(f"mean_{c}") for c, x in filled.items()],
            *[F.stddev_pop(x).alias(f"sd_{c}") for c, x in filled.items()],
        ).first()
        return Statistics({c: (median[c], row[f"mean_{c}"], row[f"sd_{c}"]) for c in features})

    def apply(self, df: DataFrame, scale: bool = True) -> DataFrame:
        """Impute medians and, with ``scale``, standardize. Columns the statistics
        do not know are kept only if they are no features."""
        if not self.values:
            raise ValueError("statistics are not fitted")

        def prepared(c: str) -> Column:
            median, mean, sd = self.values[c]
            x = F.coalesce(F.col(c).cast("double"), F.lit(median).cast("double"))
            if not scale:
                return x
            centered = x - F.lit(mean)
            return centered / F.lit(sd) if sd else centered

        absent = [c for c in self.values if c not in df.columns]
        if absent:
            raise ValueError(f"features missing from the table: {absent}")
        return df.withColumns({c: prepared(c) for c in self.values})

    def to_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(c, *v) for c, v in self.values.items()], STATISTICS)

    @staticmethod
    def from_table(table: DataFrame) -> "Statistics":
        return Statistics({r.feature: (r.median, r.mean, r.sd) for r in table.collect()})


@dataclass(frozen=True)
class Preprocessor:
    """Everything fitted on the training rows that scoring needs again."""

    codes: DataFrame
    statistics: Statistics
    features: list[str]
    scale: bool = True

    @staticmethod
    def fit(train: DataFrame, target: str = "Close", scale: bool = True) -> "Preprocessor":
        codes = stored(category_codes(train), "codes")
        encoded = encode(train, codes)
        features = [c for c in numeric_columns(encoded) if c != target]
        return Preprocessor(codes, Statistics.fit(encoded, features), features, scale)

    def transform(self, df: DataFrame) -> DataFrame:
        """The features, encoded, imputed and scaled; other numeric columns (the
        target), ``split`` and the working columns pass through."""
        return self.statistics.apply(encode(df, self.codes), self.scale)
