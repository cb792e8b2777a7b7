"""Series, positions and blocks: how long series are spread over many tasks.

Every windowed operator needs the rows of one series in time order. Windowing
by ``Symbol`` alone would put a whole series into one task, which fails once
one symbol holds a large share of the table. So rows get a dense position 1..n
per series, and positions are cut into blocks of ``block_rows`` rows. Windows
run per (series, block); a block also receives copies of the last ``lookback``
rows before it (its halo), which are dropped after the window step. Whatever
must be known from further back is carried by a table with one row per block.

Working columns start with an underscore and never reach a sink.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import stored

SERIES = "_series"
POS = "_pos"
BLOCK = "_block"
HALO = "_halo"
KEYS = [SERIES, BLOCK]

# Blocks are made of whole segments, the unit in which weighted means are summed
# (functions.ewm). Windows order by segment before position: the same order, but
# one sort then also serves the windows over segments.
SEGMENT = "_segment"
SEGMENT_ROWS = 512
BLOCK_ROWS = 512 * SEGMENT_ROWS

# monotonically_increasing_id() holds the partition number above bit 33 and the
# row number within the partition below.
_ID_BITS = 33


def series_key(symbol: str = "Symbol") -> Column:
    """A never-NULL series key; rows without a symbol form their own series."""
    c = F.col(symbol)
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c.cast("string")))


def with_known_positions(df: DataFrame, position: str = "SNo", symbol: str = "Symbol") -> DataFrame:
    """Use a column that already numbers each series 1..n in time order."""
    return df.withColumns({SERIES: series_key(symbol), POS: F.col(position).cast("long")})


def number_rows(
    df: DataFrame, order: Sequence[str] = ("Date", "SNo"), symbol: str = "Symbol"
) -> DataFrame:
    """Number each series 1..n in the given order, without a per-series window.

    Rows are range-partitioned by (series, order), so a long series spans many
    partitions, and written with their row numbers. The position is the row's
    number within its (series, partition) chunk plus the rows of the earlier
    chunks. The chunk table has at most one row per series and partition.
    Equal order values are told apart by a hash of the whole row, which makes
    the numbering the same on every run.
    """
    keyed = df.withColumns({
        SERIES: series_key(symbol),
        "_tie": F.xxhash64(*[F.col(c) for c in df.columns]),
    })
    sort_keys = [SERIES, *order, "_tie"]
    ranged = (
        keyed.repartitionByRange(*sort_keys)
        .sortWithinPartitions(*sort_keys)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    rows = stored(ranged.drop("_tie"), "numbered").withColumns({
        "_part": F.shiftright("_id", _ID_BITS),
        "_row": F.col("_id").bitwiseAND(F.lit((1 << _ID_BITS) - 1)),
    })
    earlier = (
        Window.partitionBy(SERIES).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    chunks = (
        rows.groupBy(SERIES, "_part")
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    # Stored, so that its size is known: a small one is broadcast and the rows stay where they are.
    return (
        rows.join(stored(chunks, "chunks"), [SERIES, "_part"])
        .withColumn(POS, F.col("_before") + F.col("_row") - F.col("_first") + 1)
        .drop("_id", "_part", "_row", "_first", "_before")
    )


def in_blocks(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return df.withColumn(BLOCK, F.floor((F.col(POS) - 1) / block_rows).cast("long"))


def in_blocks_with_halo(df: DataFrame, lookback: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks, each preceded by copies of the ``lookback`` rows before it."""
    if lookback > block_rows:
        raise ValueError(f"lookback {lookback} exceeds block_rows {block_rows}")
    if block_rows % SEGMENT_ROWS:
        raise ValueError(f"block_rows must be a multiple of {SEGMENT_ROWS}")
    own = F.floor((F.col(POS) - 1) / block_rows).cast("long")
    at_end = (F.col(POS) - 1) % block_rows >= block_rows - lookback
    blocks = F.when(at_end, F.array(own, own + 1)).otherwise(F.array(own))
    segment = F.floor((F.col(POS) - 1) / SEGMENT_ROWS).cast("long")
    return df.withColumn(BLOCK, F.explode(blocks)).withColumns(
        {HALO: F.col(BLOCK) != own, SEGMENT: segment}
    )


def without_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(HALO, SEGMENT)


def block_window() -> WindowSpec:
    return Window.partitionBy(*KEYS).orderBy(SEGMENT, POS)


def carried_values(
    df: DataFrame,
    columns: dict[str, Column],
    lookback: int = 0,
    block_rows: int = BLOCK_ROWS,
    prefix: str = "_carry_",
) -> DataFrame:
    """Per (series, block): the last non-missing value of each column that lies
    before the block's halo.

    ``df`` holds each row once (no halo). One aggregation with map-side partials
    leaves a row per block; the running step works on that small table.
    """
    offset = (F.col(POS) - 1) % block_rows
    aggs = []
    for name, c in columns.items():
        aggs.append(F.max_by(c, F.when(c.isNotNull(), F.col(POS))).alias(f"_all_{name}"))
        if lookback:
            early = c.isNotNull() & (offset < block_rows - lookback)
            aggs.append(F.max_by(c, F.when(early, F.col(POS))).alias(f"_early_{name}"))
    blocks = in_blocks(df, block_rows).groupBy(*KEYS).agg(*aggs)
    by_block = Window.partitionBy(SERIES).orderBy(BLOCK)

    def before(name: str) -> Column:
        if not lookback:
            frame = by_block.rowsBetween(Window.unboundedPreceding, -1)
            return F.last(f"_all_{name}", ignorenulls=True).over(frame)
        frame = by_block.rowsBetween(Window.unboundedPreceding, -2)
        return F.coalesce(
            F.lag(f"_early_{name}").over(by_block),
            F.last(f"_all_{name}", ignorenulls=True).over(frame),
        )

    return blocks.select(*KEYS, *[before(n).alias(f"{prefix}{n}") for n in columns])


# Columns that one aggregation looks at: more would exceed what Spark compiles into one loop.
AGGREGATED = 16


def known_values(df: DataFrame, columns: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per (series, block): ``_before_<c>``, the last value known before the block, and
    ``_first_<c>``, the first one known in the series.

    Hash aggregations with map-side partials, ``AGGREGATED`` columns each, so that each reads only its
    columns and no row is sorted. Text can't be held in such an aggregation: its positions are, and the
    text is looked up. The result, a row per block, is stored so that its size is known when it is joined.
    """
    texts = [c for c in columns if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType))]
    rest = [c for c in columns if c not in texts]
    by_block = Window.partitionBy(SERIES).orderBy(BLOCK)
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def carried(part: Sequence[str], last: Callable[[str, Column], Column],
                first: Callable[[str, Column], Column]) -> DataFrame:
        aggs = []
        for c in part:
            at = F.when(F.col(c).isNotNull(), F.col(POS))
            aggs += [last(c, at).alias(f"_last_{c}"), first(c, at).alias(f"_own_{c}")]
        blocks = in_blocks(df.select(SERIES, POS, *part), block_rows).groupBy(*KEYS).agg(F.count("*").alias("_rows"), *aggs)
        return blocks.select(*KEYS, *[x for c in part for x in (
            F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_before_{c}"),
            F.first(f"_own_{c}", ignorenulls=True).over(whole).alias(f"_first_{c}"))])

    known = carried(texts, lambda c, at: F.max(at), lambda c, at: F.min(at))
    for c in texts:
        found = df.select(F.col(SERIES).alias("_of"), F.col(POS).alias("_at"), F.col(c).alias("_text"))
        for name in (f"_before_{c}", f"_first_{c}"):
            known = known.join(found, (F.col(SERIES) == F.col("_of")) & (F.col(name) == F.col("_at")), "left").withColumn(
                name, F.col("_text")).drop("_of", "_at", "_text")
    for k in range(0, len(rest), AGGREGATED):
        known = known.join(carried(rest[k:k + AGGREGATED], F.max_by, F.min_by), KEYS)
    return stored(known, "known")


def series_lengths(df: DataFrame) -> DataFrame:
    return df.groupBy(SERIES).agg(F.max(POS).alias("_n"))


def spread_over_blocks(per_series: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A per-series table with its length ``_n`` to one row per block.

    Joining on (series, block) instead of the series keeps a long series from
    landing in one join task.
    """
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / block_rows).cast("long"))
    return per_series.withColumn(BLOCK, F.explode(blocks))


def join_per_series(df: DataFrame, per_series: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add the columns of a per-series table (with ``_n``) to every row.

    The table is stored first, so its size is known when the join is planned:
    below ``spark.sql.autoBroadcastJoinThreshold`` the rows are not shuffled.
    """
    per_block = stored(spread_over_blocks(per_series, block_rows), "per_block")
    return in_blocks(df, block_rows).join(per_block, KEYS).drop(BLOCK)


def drop_working_columns(df: DataFrame, keep: Callable[[str], bool] = lambda c: False) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_") and not keep(c)])
