"""Repair of feature tables: infinities, outliers, gaps.

Steps, in this order: infinities and NaN become missing; every numeric column is
clipped to its 1 % and 99 % quantiles, widened by 1.5 times their distance;
missing values take the last known value, leading ones the first known value of
the series, and 0 where a column has none at all.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import config
from barloom.operators.quantiles import SORTED_ROWS, exact_quantiles, quantile_name
from barloom.operators.series import (
    BLOCK_ROWS, KEYS, POS, SERIES, in_blocks, join_per_series, known_values, series_lengths,
)
from barloom.operators.split import train_end
from barloom.schema import numeric_columns
from barloom.session import stored


def drop_infinities(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({
        c: F.expr(f"CASE WHEN NOT isnan(`{c}`) AND abs(`{c}`) <> double('Infinity') THEN `{c}` END")
        for c in floats if not c.startswith("_")
    })


def clip_bounds(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    fit_scope: str = "all",
    quantiles: tuple[float, float] = config.CLIP_QUANTILES,
    reach: float = config.CLIP_REACH,
    ratios: tuple[float, float, float] = config.SPLIT_RATIOS,
    block_rows: int = BLOCK_ROWS,
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """Per series: ``_low_<c>`` and ``_high_<c>``. ``fit_scope="train"`` looks only
    at the training part of each series, "all" at the whole of it."""
    if fit_scope not in ("all", "train"):
        raise ValueError(f"unknown fit_scope: {fit_scope}")
    columns = numeric_columns(df) if columns is None else list(columns)
    fitted = df
    if fit_scope == "train":
        lengths = series_lengths(df)
        fitted = join_per_series(df, lengths, block_rows).where(
            F.col(POS) <= train_end(F.col("_n"), ratios)
        ).drop("_n")
    found = exact_quantiles(
        fitted, columns, quantiles, sorted_rows=sorted_rows, block_rows=block_rows
    )
    bounds = []
    for c in columns:
        low, high = F.col(quantile_name(c, 0)), F.col(quantile_name(c, 1))
        bounds.append((low - (high - low) * reach).alias(f"_low_{c}"))
        bounds.append((high + (high - low) * reach).alias(f"_high_{c}"))
    return found.select(SERIES, *bounds)


def _clipped(c: str, bounded: str) -> Column:
    x, low, high = f"CAST(`{c}` AS DOUBLE)", f"`_low_{bounded}`", f"`_high_{bounded}`"
    return F.expr(f"CASE WHEN {x} < {low} THEN {low} WHEN {x} > {high} THEN {high} ELSE {x} END")


def _bounded(bounds: DataFrame, df: DataFrame) -> list[str]:
    columns = [c.removeprefix("_low_") for c in bounds.columns if c.startswith("_low_")]
    return [c for c in columns if c in df.columns]


def clip(df: DataFrame, bounds: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Clip to the bounds; missing values stay missing, results are doubles.

    A series without bounds (not seen when they were fitted) is left as it is.
    """
    columns = _bounded(bounds, df)
    per_series = series_lengths(df).join(bounds, SERIES, "left")
    df = join_per_series(df, per_series, block_rows)
    return df.withColumns({c: _clipped(c, c) for c in columns}).drop(
        "_n", *[c for c in bounds.columns if c != SERIES]
    )


def fill_gaps(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Forward fill, then backward fill, then 0.

    What lies outside a row's block comes from a table with a row per block, joined on
    (series, block); inside a block one running window is enough. ``df`` is read for each: a stored
    table, best.
    """
    columns = [c for c in df.columns if not c.startswith("_")]
    blocked = in_blocks(df, block_rows).join(known_values(df, columns, block_rows), KEYS)
    return _filled(blocked, columns, [c for c in df.columns if c.startswith("_")])


def _filled(blocked: DataFrame, columns: Sequence[str], further: Sequence[str]) -> DataFrame:
    """Blocks joined with their known values, filled."""
    so_far = Window.partitionBy(*KEYS).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    types = {f.name: f.dataType for f in blocked.schema}

    def filled(c: str) -> Column:
        values = [F.last(c, ignorenulls=True).over(so_far), F.col(f"_before_{c}"), F.col(f"_first_{c}")]
        return F.coalesce(*values, *zero(types[c])).alias(c)

    return blocked.select(*[filled(c) for c in columns], *further)


def clip_and_fill(df: DataFrame, bounds: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``fill_gaps`` of ``clip`` for a stored table.

    Clipping changes no gap, so the known values are taken from the table as it is and clipped themselves:
    the clipped rows are made once. Known values and bounds come as one table with a row per block.
    """
    columns = [c for c in df.columns if not c.startswith("_")]
    bounded = _bounded(bounds, df)
    limits = [c for c in bounds.columns if c != SERIES]
    known = known_values(df, columns, block_rows).join(bounds, SERIES, "left").withColumns(
        {f"_{k}_{c}": _clipped(f"_{k}_{c}", c) for c in bounded for k in ("before", "first")})
    blocked = in_blocks(df, block_rows).join(stored(known, "known-clipped"), KEYS).withColumns(
        {c: _clipped(c, c) for c in bounded}).drop(*limits)
    return _filled(blocked, columns, [c for c in df.columns if c.startswith("_")])


def zero(kind: T.DataType) -> list[Column]:
    """What stands for a value that a whole series lacks; dates have none."""
    if isinstance(kind, (T.NumericType, T.StringType)):
        return [F.lit("0" if isinstance(kind, T.StringType) else 0).cast(kind)]
    return []


def repair(
    df: DataFrame,
    bounds: DataFrame | None = None,
    fit_scope: str = "all",
    block_rows: int = BLOCK_ROWS,
    sorted_rows: int = SORTED_ROWS,
    store: bool = True,
) -> DataFrame:
    """All repair steps. With ``bounds`` given (scoring) nothing is fitted.

    The table is stored once: bounds, clipping and filling all read it again, and
    computing its features anew each time would cost more. ``store=False`` is for
    a table that is stored already.
    """
    table = drop_infinities(df)
    if store:
        table = stored(table, "features")
    if bounds is None:
        bounds = clip_bounds(
            table, fit_scope=fit_scope, block_rows=block_rows, sorted_rows=sorted_rows
        )
    return clip_and_fill(table, bounds, block_rows)
