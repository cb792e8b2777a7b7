"""Exact quantiles of many columns, per series or of the whole table.

A group of at most ``sorted_rows`` rows is sorted. A series may be most of the
table, and sorting would take all its values into one task. So the values of a
longer group are narrowed down by counting until what is left is that small:

1. one pass counts the values of every column by sign and magnitude
   (``MAGNITUDES`` steps per factor of e), with the least and greatest value of
   each step. Spark adds up before it shuffles, so what is shuffled depends on
   the steps in use, not on the rows;
2. running sums tell the step that holds a rank, and the rank's place in it. At
   the edge of a step, or if all its values are equal, the value is known;
3. otherwise the step is a bracket of two values. While a bracket holds more
   than ``sorted_rows`` values, another pass counts what is inside by ``PARTS``
   equal parts. Both ends of a bracket fall into different parts, so it shrinks;
4. what is left in the brackets is sorted.

Both kinds of groups are in one result, whatever the longest one is.
Missing values and NaN are left out; a column without values has NULL quantiles.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.series import BLOCK_ROWS, POS, SERIES, join_per_series
from barloom.session import stored

MAGNITUDES = 16
PARTS = 1024
SORTED_ROWS = 4096

ITEM = [SERIES, "_item"]
# Above the logarithm of every finite double, and below that of the smallest with its sign turned.
_LOG_END = 800


def quantile_name(column: str, i: int) -> str:
    return f"_q{i}_{column}"


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    whole_table: bool = False,
    sorted_rows: int = SORTED_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per series (or one row): linear quantiles, ``quantile_name`` columns.

    ``df`` should be a stored table, it is read several times. The result also
    holds ``_n``, the last position of the series.
    """
    values = F.array(*[F.expr(f"CAST(`{c}` AS DOUBLE)") for c in columns]).alias("_values")
    key = F.lit("*").alias(SERIES) if whole_table else F.col(SERIES)
    rows = df.select(key, POS, values)
    sizes = stored(df.select(key, POS).groupBy(SERIES).agg(
        F.max(POS).alias("_n"), F.count("*").alias("_size")), "sizes")

    def with_series(per_series: DataFrame) -> DataFrame:
        if whole_table:  # one row
            return rows.join(F.broadcast(per_series), SERIES)
        return join_per_series(rows, per_series, block_rows)

    sized = with_series(sizes)
    short = _of_short_groups(sized.where(F.col("_size") <= sorted_rows), len(columns), probs)

    state = stored(_located(_by_magnitude(sized.where(F.col("_size") > sorted_rows), probs)), "ranks")
    found = [state]
    while widest := state.where(_OPEN).agg(F.max("_rows")).first()[0]:
        inside = _in_brackets(with_series(_per_series(state.where(_OPEN), len(probs)).join(sizes, SERIES)))
        if widest <= sorted_rows:
            found.append(_sorted(inside))
            break
        state = stored(_located(_by_parts(inside)), "ranks")
        found.append(state)
    value = F.expr(_between("_v0", "_v1", "_share")).alias("_v")
    known = found[0].where(f"NOT ({_OPEN})").select(*ITEM, value)
    for part in found[1:]:
        known = known.unionByName(part.where(f"NOT ({_OPEN})").select(*ITEM, value))
    names = [quantile_name(c, i) for c in columns for i in range(len(probs))]
    long = known.groupBy(SERIES).agg(
        F.map_from_entries(F.collect_list(F.struct("_item", "_v"))).alias("_map")
    ).select(SERIES, F.expr(f"transform(sequence(0, {len(names) - 1}), k -> _map[k]) AS _found"))
    return sizes.join(short.unionByName(long), SERIES, "left").select(
        SERIES, "_n", *[F.expr(f"_found[{k}]").alias(name) for k, name in enumerate(names)])


def _between(low: str, high: str, share: str) -> str:
    """A linear quantile lies between two neighbours; equal ones may be infinite."""
    return f"CASE WHEN {low} = {high} THEN {low} ELSE {low} + ({high} - {low}) * {share} END"


def _of_short_groups(rows: DataFrame, n_columns: int, probs: Sequence[float]) -> DataFrame:
    """One list of row arrays per group is several times faster than a list per column, and
    one expression for all columns than a plan with one per column."""
    ordered = rows.groupBy(SERIES).agg(F.collect_list("_values").alias("_list")).select(SERIES, F.expr(
        f"""transform(sequence(0, {n_columns - 1}), k -> sort_array(filter(
            transform(_list, r -> r[k]), v -> v IS NOT NULL AND NOT isnan(v)))) AS _sorted"""))
    wanted = ", ".join(f"{float(p)!r}D" for p in probs)
    at = "(size(s) - 1) * p"
    low, high = f"get(s, CAST(floor({at}) AS INT))", f"get(s, least(CAST(floor({at}) AS INT) + 1, size(s) - 1))"
    return ordered.select(SERIES, F.expr(
        f"""flatten(transform(_sorted, s -> transform(array({wanted}),
            p -> {_between(low, high, f"({at} - floor({at}))")}))) AS _found"""))


# A rank whose value, or whose upper neighbour's value, is not known yet.
_OPEN = "_v0 IS NULL OR _v1 IS NULL"


def _ranks() -> list[Column]:
    """The same in all rows of an item."""
    return [F.max(c).alias(c) for c in ("_k0", "_k1", "_share")]


def _tally(values: DataFrame, group: Sequence[str], step: Column, *more: Column) -> DataFrame:
    """Values per step with the least and greatest, and how many lie in earlier steps."""
    counted = values.groupBy(*group, step.alias("_step")).agg(
        F.count("*").alias("_count"), F.min("_x").alias("_min"), F.max("_x").alias("_max"), *more)
    upto = Window.partitionBy(*group).orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("_below", F.sum("_count").over(upto) - F.col("_count"))


def _by_magnitude(rows: DataFrame, probs: Sequence[float]) -> DataFrame:
    values = rows.select(SERIES, F.posexplode("_values").alias("_column", "_x")).where(
        "_x IS NOT NULL AND NOT isnan(_x)")
    size = F.floor((F.least(F.ln(F.abs("_x")), F.lit(float(_LOG_END))) + _LOG_END) * MAGNITUDES) + 1
    step = F.when(F.col("_x") > 0, size).when(F.col("_x") < 0, -size).otherwise(0)
    everything = Window.partitionBy(SERIES, "_column").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    counted = _tally(values, [SERIES, "_column"], step).withColumn(
        "_all", F.sum("_count").over(everything))
    wanted = F.array(*[F.struct(
        (F.col("_column") * len(probs) + i).alias("_item"),
        (F.lit(float(p)) * (F.col("_all") - 1)).alias("_at")) for i, p in enumerate(probs)])
    return counted.select("*", F.inline(wanted)).withColumns({
        "_share": F.col("_at") - F.floor("_at"),
        "_k0": F.floor("_at") + 1,
        "_k1": F.least(F.floor("_at") + 2, F.col("_all")),
    })


def _by_parts(inside: DataFrame) -> DataFrame:
    # Halves, because the distance of two finite doubles may not be finite.
    step = F.expr(f"""CASE WHEN _high / 2 - _low / 2 = 0 THEN IF(_x <= _low, 0, {PARTS})
        ELSE floor((_x / 2 - _low / 2) / (_high / 2 - _low / 2) * {PARTS}) END""")
    return _tally(inside, ITEM, step, *_ranks())


def _located(tally: DataFrame) -> DataFrame:
    """Per item the values at its two ranks where the step tells them, else the
    step as a bracket, with the ranks counted from its start.

    The ranks are neighbours. If one is unknown, it is inside a step and the
    other one is in the same step.
    """
    def value_at(k: str) -> Column:
        return F.max(F.expr(f"""CASE
            WHEN {k} = _below + 1 THEN _min WHEN {k} = _below + _count THEN _max
            WHEN {k} BETWEEN _below + 1 AND _below + _count AND _min = _max THEN _min END"""))

    def of_step(value: str) -> Column:
        return F.max(F.expr(f"CASE WHEN _k0 BETWEEN _below + 1 AND _below + _count THEN {value} END"))

    hit = tally.where("_below < _k1 AND _below + _count >= _k0")
    return hit.groupBy(*ITEM).agg(
        value_at("_k0").alias("_v0"), value_at("_k1").alias("_v1"), F.max("_share").alias("_share"),
        of_step("_min").alias("_low"), of_step("_max").alias("_high"),
        of_step("_k0 - _below").alias("_k0"), of_step("_k1 - _below").alias("_k1"),
        of_step("_count").alias("_rows"),
    )


def _per_series(brackets: DataFrame, n_probs: int) -> DataFrame:
    """At most one entry per column and quantile."""
    return brackets.groupBy(SERIES).agg(F.collect_list(F.struct(
        "_item", F.expr(f"_item DIV {n_probs}").cast("int").alias("_column"),
        "_low", "_high", "_k0", "_k1", "_share")).alias("_open"))


def _in_brackets(rows: DataFrame) -> DataFrame:
    """The values inside each bracket of their series, with the ranks wanted there."""
    return rows.select(SERIES, F.expr("""inline(transform(
        filter(_open, o -> _values[o._column] >= o._low AND _values[o._column] <= o._high),
        o -> named_struct('_item', o._item, '_x', _values[o._column], '_low', o._low, '_high', o._high,
                          '_k0', o._k0, '_k1', o._k1, '_share', o._share)))"""))


def _sorted(inside: DataFrame) -> DataFrame:
    ordered = inside.groupBy(*ITEM).agg(F.sort_array(F.collect_list("_x")).alias("_sorted"), *_ranks())
    return ordered.select(
        *ITEM, "_share", *[F.expr(f"_sorted[CAST(_k{i} - 1 AS INT)]").alias(f"_v{i}") for i in (0, 1)])
