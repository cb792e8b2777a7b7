"""Quality report: every check of every symbol from one pass over the bars.

The table is aggregated once per symbol with conditional sums; repeated rows and
the order of dates need their own passes, since they compare rows with each
other. All of them reduce map-side, so a symbol with most of the rows costs its
tasks no more than the others.

Report columns: ``Symbol, check, item, violations, status``. The count is always
reported; ``status`` is pass, fail, or skipped where the rules leave the check
out because an earlier one failed.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import config
from barloom.functions.numeric import count_where
from barloom.operators.series import (
    BLOCK_ROWS, block_window, in_blocks_with_halo, number_rows, without_halo,
)
from barloom.schema import BARS, nan_to_null, parse_date

# The check a report row belongs to, in report order.
CHECKS = [
    "required_columns", "data_presence", "data_types", "missing_values", "duplicates",
    "price_data", "volume_data", "date_data", "temporal_consistency",
    "price_consistency", "volume_consistency",
]

CONSISTENCY_RULES = [
    ("High", "<", "Low"), ("High", "<", "Open"), ("High", "<", "Close"),
    ("Low", ">", "Open"), ("Low", ">", "Close"),
]


def schema_issues(df: DataFrame) -> tuple[list[str], list[str]]:
    """Missing required columns, and columns whose type is not the expected one."""
    have = {f.name: f.dataType for f in df.schema}
    missing = [c for c in config.REQUIRED_COLUMNS if c not in have]
    wrong = [f.name for f in BARS if f.name in have and have[f.name] != f.dataType]
    return missing, wrong


def unreadable_values(raw: DataFrame) -> DataFrame:
    """For bars read as text: per column, how many values do not fit their type."""
    columns = [f for f in BARS if f.name in raw.columns and not isinstance(f.dataType, T.StringType)]
    counts = raw.agg(*[
        count_where(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
        .alias(f.name) for f in columns
    ])
    cells = [F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("violations"))
             for f in columns]
    return counts.select(F.inline(F.array(*cells)))


def _counts(df: DataFrame, as_of: Column) -> dict[tuple[str, str], Column]:
    """(check, item) -> number of violating rows."""
    have = set(df.columns)
    out: dict[tuple[str, str], Column] = {}
    for c in config.CRITICAL_COLUMNS:
        if c in have:
            source = "_date_text" if c == "Date" else c
            out["missing_values", c] = count_where(F.col(source).isNull())
    for c in config.PRICE_COLUMNS:
        if c in have:
            out["price_data", f"{c}:negative"] = count_where(F.col(c) < 0)
            out["price_data", f"{c}:above"] = count_where(F.col(c) > config.MAX_PRICE)
            out["price_data", f"{c}:below"] = count_where(F.col(c) < config.MIN_PRICE)
    if "Volume" in have:
        out["volume_data", "negative"] = count_where(F.col("Volume") < 0)
        out["volume_data", "above"] = count_where(F.col("Volume") > config.MAX_VOLUME)
        out["volume_consistency", "negative"] = count_where(F.col("Volume") < 0)
    if "Date" in have:
        earliest = F.lit(config.EARLIEST_DATE).cast("timestamp_ntz")
        out["date_data", "invalid"] = count_where(F.col("Date").isNull())
        out["date_data", "future"] = count_where(F.col("Date") > as_of)
        out["date_data", "before_2010"] = count_where(F.col("Date") < earliest)
    if set(config.PRICE_COLUMNS) <= have:
        for a, op, b in CONSISTENCY_RULES:
            broken = F.col(a) < F.col(b) if op == "<" else F.col(a) > F.col(b)
            out["price_consistency", f"{a}{op}{b}"] = count_where(broken)
    return out


def _order_counts(distinct_rows: DataFrame, block_rows: int) -> DataFrame:
    """Inversions and long gaps between neighbouring rows in source order.

    Copies of a row would be neighbours with equal dates and violate nothing, so
    the distinct rows are enough.
    """
    numbered = number_rows(distinct_rows.select("Symbol", "SNo", "Date"), order=("SNo", "Date"))
    pairs = in_blocks_with_halo(numbered, 1, block_rows).withColumn(
        "_before", F.lag("Date").over(block_window())
    )
    gap = F.make_dt_interval(F.lit(config.MAX_GAP_DAYS))
    return without_halo(pairs).groupBy("Symbol").agg(
        count_where(F.col("Date") < F.col("_before")).alias("_inversions"),
        count_where(F.col("Date") - F.col("_before") > gap).alias("_gaps"),
    )


def quality_report(
    bars: DataFrame,
    as_of: Column | None = None,
    date_formats: tuple[str, ...] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per symbol, check and item. ``as_of`` is the time after which a
    date counts as in the future (default: now)."""
    missing, wrong = schema_issues(bars)
    as_of = F.localtimestamp() if as_of is None else as_of
    df = nan_to_null(bars)
    if "Symbol" not in df.columns:
        df = df.withColumn("Symbol", F.lit(None).cast("string"))
    if "Date" in df.columns:
        parsed = F.col("Date")
        if isinstance(df.schema["Date"].dataType, T.StringType):
            parsed = parse_date(parsed, date_formats)
        df = df.withColumn("_date_text", F.col("Date")).withColumn("Date", parsed)

    # Copies collapse before anything is shuffled by symbol.
    keys = [c for c in df.columns if c != "Date"]
    copies = df.groupBy(*keys).agg(F.first("Date").alias("Date"), F.count(F.lit(1)).alias("_copies"))
    repeated = copies.groupBy("Symbol").agg(F.sum(F.col("_copies") - 1).alias("_repeated"))

    counts = _counts(df, as_of)
    wide = df.groupBy("Symbol").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[c.alias(f"_n{i}") for i, c in enumerate(counts.values())],
    )
    at = {key: F.col(f"_n{i}") for i, key in enumerate(counts)}
    wide = _null_safe_join(wide, repeated, "Symbol")
    if {"Date", "SNo"} <= set(df.columns):
        wide = _null_safe_join(wide, _order_counts(copies, block_rows), "Symbol")
        at["temporal_consistency", "inversions"] = F.col("_inversions")
        at["temporal_consistency", "gaps"] = F.col("_gaps")

    rows = [("required_columns", "all", F.lit(len(missing)), None),
            ("data_presence", "rows", F.when(F.col("_rows") < config.MIN_ROWS, 1).otherwise(0), None),
            ("data_types", "all", F.lit(len(wrong)), None),
            ("duplicates", "rows", F.col("_repeated"), None)]
    # A check is skipped when an earlier one of its group failed.
    after = {
        ("volume_data", "above"): [("volume_data", "negative")],
        ("date_data", "future"): [("date_data", "invalid")],
        ("date_data", "before_2010"): [("date_data", "invalid"), ("date_data", "future")],
        ("temporal_consistency", "inversions"): [("date_data", "invalid")],
        ("temporal_consistency", "gaps"): [
            ("date_data", "invalid"), ("temporal_consistency", "inversions")],
    }
    for key, c in at.items():
        gates = [at[g] == 0 for g in after.get(key, [])]
        rows.append((*key, c, reduce(Column.__and__, gates) if gates else None))
    if {"Date", "SNo"} <= set(df.columns):
        # A date that cannot be read leaves the order unknown, which is a failure.
        rows.append(("temporal_consistency", "unreadable", at["date_data", "invalid"], None))
    cells = []
    for check, item, c, gate in rows:
        status = F.when(c == 0, "pass").otherwise("fail")
        if gate is not None:
            status = F.when(gate, status).otherwise("skipped")
        cells.append(F.struct(
            F.lit(check).alias("check"), F.lit(item).alias("item"),
            c.cast("long").alias("violations"), status.alias("status"),
        ))
    return wide.select("Symbol", F.inline(F.array(*cells)))


def _null_safe_join(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Join two tables of one row per key, where the key may be NULL."""
    right = b.withColumnRenamed(key, "_right_key")
    return a.join(right, F.col(key).eqNullSafe(F.col("_right_key"))).drop("_right_key")


def quality_summary(report: DataFrame) -> DataFrame:
    """Per symbol: is everything valid, one flag per check, and the issues found.

    Missing values are one issue however many columns have them.
    """
    failed = F.col("status") == "fail"
    label = F.when(F.col("check") == "missing_values", F.col("check")).otherwise(
        F.concat_ws(":", "check", "item")
    )
    flags = [
        F.bool_and(F.when(F.col("check") == c, ~failed)).alias(c)
        for c in CHECKS
    ]
    return report.groupBy("Symbol").agg(
        *flags,
        F.array_sort(F.collect_set(F.when(failed, label))).alias("issues"),
    ).select(
        "Symbol",
        reduce(Column.__and__, [F.coalesce(c, F.lit(True)) for c in CHECKS]).alias("overall_valid"),
        *CHECKS, "issues", F.size("issues").cast("long").alias("total_issues"),
    )
