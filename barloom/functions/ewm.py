"""Exponentially weighted means without a row-by-row recursion.

The weighted mean of span s at row t is ``sum(q^i x[t-i]) / sum(q^i [x[t-i] known])``
with ``q = 1 - 2/(s+1)``. Rows are cut into segments of SEGMENT_ROWS rows; inside a
segment both sums are running sums of rescaled values, and the previous
segment's end value, decayed, adds the rest. Anything older weighs less than
``q^SEGMENT_ROWS`` and vanishes in double precision, which fixes SEGMENT_ROWS:

* long enough that ``q^SEGMENT_ROWS`` < 1e-16 for the longest span,
* short enough that ``q^-SEGMENT_ROWS`` stays a finite double for the shortest.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from barloom.operators.series import BLOCK, HALO, KEYS, POS, SEGMENT, SEGMENT_ROWS, SERIES

# Two exact segments of history are needed where a mean is taken of a mean
# (the MACD signal), and one more to make the earliest of them exact.
LOOKBACK = 3 * SEGMENT_ROWS

_LOG_NEGLIGIBLE = 37.0
_LOG_LARGEST = 600.0


def decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def check_span(span: int) -> None:
    per_row = -math.log(decay(span)) if span > 1 else float("inf")
    if not _LOG_NEGLIGIBLE <= per_row * SEGMENT_ROWS <= _LOG_LARGEST:
        raise ValueError(f"span {span} does not fit segments of {SEGMENT_ROWS} rows")


@dataclass(frozen=True)
class Ewm:
    """One weighted mean: ``name`` is the output, ``source`` the input column."""

    name: str
    source: str
    span: int

    def sums(self) -> dict[str, Column]:
        """Running sums within the segment. Needs ``SEGMENT``."""
        check_span(self.span)
        q = F.lit(decay(self.span))
        step = ((F.col(POS) - 1) % SEGMENT_ROWS).cast("double")
        window = (
            Window.partitionBy(*KEYS, SEGMENT).orderBy(POS)
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        x = F.col(self.source)
        scale = F.pow(q, -step)
        num = F.coalesce(F.sum(x * scale).over(window), F.lit(0.0))
        den = F.coalesce(F.sum(F.when(x.isNotNull(), scale)).over(window), F.lit(0.0))
        return {f"_num_{self.name}": num * F.pow(q, step), f"_den_{self.name}": den * F.pow(q, step)}

    def mean(self, block_rows: int) -> Column:
        """The weighted mean, from the running sums, at rows where x is known."""
        q = decay(self.span)
        offset = (F.col(POS) - 1) % SEGMENT_ROWS
        previous = Window.partitionBy(*KEYS).orderBy(SEGMENT).rangeBetween(-1, -1)

        def total(c: str) -> Column:
            at_end = F.max(F.when(offset == SEGMENT_ROWS - 1, F.col(c))).over(previous)
            return F.col(c) + F.coalesce(at_end, F.lit(0.0)) * F.pow(F.lit(q), offset + 1.0)

        # Exact only once a whole segment precedes the row; halo rows of the
        # first segment are not, unless the series itself starts there.
        warm = ~F.col(HALO) | (F.col(BLOCK) * block_rows - F.col(POS) < 2 * SEGMENT_ROWS)
        known = F.col(self.source).isNotNull() & warm
        return F.when(known, F.try_divide(total(f"_num_{self.name}"), total(f"_den_{self.name}")))


def stale_means(bars, ewms: list[Ewm], block_rows: int):
    """Means that started before a block's halo and are carried into it.

    A missing value keeps the mean of the last known row. When no value is known
    in the halo's exact segments, that row lies further back; its mean is then
    summed here directly. Blocks like that are rare, so this is normally empty.
    Returns (series, block, ``_stale_<name>``).
    """
    source = ewms[0].source
    x = F.col(source)
    offset = (F.col(POS) - 1) % block_rows
    known = x.isNotNull()
    rows = bars.select(SERIES, POS, source).withColumn(
        BLOCK, F.floor((F.col(POS) - 1) / block_rows).cast("long")
    )
    blocks = rows.groupBy(*KEYS).agg(
        F.max(F.when(known, F.col(POS))).alias("_last"),
        F.max(F.when(known & (offset < block_rows - SEGMENT_ROWS), F.col(POS))).alias("_last_early"),
    )
    by_block = Window.partitionBy(SERIES).orderBy(BLOCK)
    older = by_block.rowsBetween(Window.unboundedPreceding, -2)
    anchor = F.coalesce(F.lag("_last_early").over(by_block), F.max("_last").over(older))
    stale = (
        blocks.select(*KEYS, anchor.alias("_anchor"))
        .where(F.col("_anchor") <= F.col(BLOCK) * block_rows - 2 * SEGMENT_ROWS)
        .withColumn("_home", F.floor((F.col("_anchor") - 1) / block_rows).cast("long"))
        .withColumn("_from", F.explode(F.array(F.col("_home") - 1, F.col("_home"))))
        .withColumnRenamed(BLOCK, "_to")
    )
    age = (F.col("_anchor") - F.col(POS)).cast("double")
    near = (
        rows.where(known).withColumnRenamed(BLOCK, "_from")
        .join(stale, [SERIES, "_from"])
        .where((age >= 0) & (age < 2 * SEGMENT_ROWS))
    )
    means = []
    for e in ewms:
        weight = F.pow(F.lit(decay(e.span)), age)
        means.append((F.sum(x * weight) / F.sum(weight)).alias(f"_stale_{e.name}"))
    return near.groupBy(SERIES, F.col("_to").alias(BLOCK)).agg(*means)
