"""Raw bars to a split feature table."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import config
from barloom.operators.clean import clean_bars
from barloom.operators.features import FAMILIES, add_features
from barloom.operators.prepare import Preprocessor
from barloom.operators.repair import clip_bounds, drop_infinities, repair
from barloom.operators.report import pipeline_summary
from barloom.operators.series import BLOCK_ROWS, series_lengths
from barloom.operators.split import add_split
from barloom.operators.validate import quality_report
from barloom.session import stored


def validate_and_clean(
    raw: DataFrame, as_of: Column | None = None, date_formats: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Quality report and cleaned bars. Failed checks are reported, they stop
    nothing and drop no row."""
    return (
        quality_report(raw, as_of, date_formats),
        clean_bars(raw, date_formats, keep_positions=True),
    )


@dataclass(frozen=True)
class Prepared:
    """What a data job leaves behind: the repaired features with their split,
    the same table ready for a model, and what was fitted on the way."""

    report: DataFrame
    features: DataFrame
    table: DataFrame
    preprocessor: Preprocessor
    bounds: DataFrame
    summary: DataFrame


def prepare_bars(
    raw: DataFrame,
    target: str = "Close",
    windows: Sequence[int] = config.ROLLING_WINDOWS,
    technical: bool = True,
    scale: bool = True,
    fit_scope: str = "all",
    ratios: tuple[float, float, float] = config.SPLIT_RATIOS,
    as_of: Column | None = None,
    date_formats: tuple[str, ...] = (),
    block_rows: int = BLOCK_ROWS,
) -> Prepared:
    """Validate, clean, add features, repair, split, fit on train and apply."""
    report, clean = validate_and_clean(raw, as_of, date_formats)
    clean = stored(clean, "clean")  # the features read it three times
    families = [f for f in FAMILIES if technical or f != "technical"]
    made = stored(
        drop_infinities(add_features(clean, windows, families, block_rows)), "features"
    )
    bounds = stored(clip_bounds(made, fit_scope=fit_scope, ratios=ratios, block_rows=block_rows),
                    "bounds")
    fixed = repair(made, bounds=bounds, block_rows=block_rows, store=False)
    split = add_split(fixed, ratios, block_rows, lengths=series_lengths(made))
    features = stored(split, "split")
    preprocessor = Preprocessor.fit(features.where(F.col("split") == "train"), target, scale)
    return Prepared(
        report=report,
        features=features,
        table=stored(preprocessor.transform(features), "prepared"),
        preprocessor=preprocessor,
        bounds=bounds,
        summary=pipeline_summary(features, target),
    )
