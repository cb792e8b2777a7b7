"""The registered queries, one per operator family.

Names start with the family's letter: s sources and sinks, v quality checks,
c cleaning, p/u/k price, volume and market-cap features, t calendar, i technical
indicators, z statistics, r repair, e encoding and scaling, x splits, m models
and metrics, b batch scoring, q summaries.
"""

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.config import N_FOLDS
from barloom.operators.clean import clean_bars
from barloom.operators.evaluate import comparison, metrics, performance_summary, top_features
from barloom.operators.features import CALENDAR, add_features, feature_names
from barloom.operators.persist import load_model, model_info, save_model
from barloom.operators.prepare import Statistics, category_codes, encode
from barloom.operators.repair import clip, clip_bounds, fill_gaps, repair
from barloom.operators.report import feature_classes, feature_summary, pipeline_summary
from barloom.operators.score import check_requests, score
from barloom.operators.series import POS, SERIES, drop_working_columns, number_rows, with_known_positions
from barloom.operators.split import (
    add_split, fold_counts, fold_part, split_counts, with_folds,
)
from barloom.operators.train import cross_validate, cv_summary, grid_search, importances, predict, train
from barloom.operators.validate import quality_report, quality_summary, unreadable_values
from barloom.plans.etl import prepare_bars
from barloom.plans.training import run_values
from barloom.schema import parse_date
from barloom.session import scratch_root, stored
from barloom.sources.bars import read_bars_csv, read_bars_parquet, read_raw_csv
from barloom.sources.derived import (
    BAR_COLUMNS, bars_from_events, bars_from_order_lines, damaged_bars,
)
from barloom.sources.sinks import (
    append_run, read_runs, write_bars_csv, write_features, write_importances, write_summary,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The time after which a bar counts as lying in the future.
AS_OF = "2030-01-01"
VALUES = ["High", "Low", "Open", "Close", "Volume", "Marketcap"]
# Forests of the registered queries; the library's defaults are larger.
SMALL_FOREST = {"numTrees": 10, "maxDepth": 5, "maxBins": 64}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 6, large: Sequence[str] = ()) -> DataFrame:
    """Round doubles; columns of large numbers keep two digits.

    Ties are moved up a little first: a value computed in another order may
    differ in its last bit and must not fall on the other side of a tie.
    """
    out = {}
    for name, kind in df.dtypes:
        if kind == "double":
            wide = name in large or name.startswith(("Marketcap", "Volume_M", "Volume_S"))
            places = 2 if wide else digits
            out[name] = F.round(F.col(name) + 10.0 ** -(places + 3), places)
    return df.withColumns(out)


def event_bars(spark: SparkSession, sf: str) -> DataFrame:
    return with_known_positions(bars_from_events(spark, sf))


def features_of(spark, sf, families, names, bars=event_bars) -> DataFrame:
    df = add_features(bars(spark, sf), families=families)
    return df.select("Symbol", "SNo", *names)


def names_of(*families: str) -> list[str]:
    return feature_names(BAR_COLUMNS, families=families)


# Sources and sinks

def scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def dated(df: DataFrame) -> DataFrame:
    return df.withColumn("Date", parse_date(F.col("Date")))


@query
def s_csv_bars(spark, sf):
    path = scratch(spark, "csv")
    write_bars_csv(bars_from_order_lines(spark, sf), path)
    return dated(read_bars_csv(spark, path))


@query
def s_csv_one_symbol(spark, sf):
    path = scratch(spark, "csv")
    write_bars_csv(bars_from_events(spark, sf), path)
    chosen = read_bars_csv(spark, path, symbols=["click", "purchase"])
    return dated(chosen).drop("Name")


@query
def s_csv_unreadable_values(spark, sf):
    path = scratch(spark, "csv")
    spoilt = damaged_bars(spark, sf).select(
        *[F.col(c).cast("string").alias(c) for c in BAR_COLUMNS]
    ).withColumn("Volume", F.when(F.col("SNo").cast("long") % 50 == 0, "n/a").otherwise(F.col("Volume")))
    write_bars_csv(spoilt, path)
    return unreadable_values(read_raw_csv(spark, path))


@query
def s_feature_table(spark, sf):
    path = scratch(spark, "features")
    write_features(add_features(event_bars(spark, sf), families=("price",)), path)
    return rounded(read_bars_parquet(spark, path).select("Symbol", "SNo", *names_of("price")))


@query
def s_run_table(spark, sf):
    path = scratch(spark, "runs")
    for run, bars in (("events", bars_from_events), ("orders", bars_from_order_lines)):
        row = bars(spark, sf).agg(
            F.count(F.lit(1)).alias("rows"), F.max("High").alias("high"), F.min("Low").alias("low")
        ).first()
        append_run(spark, path, run, {("data", k): row[k] for k in ("rows", "high", "low")})
    return read_runs(spark, path)


@query
def s_summary_json(spark, sf):
    path = scratch(spark, "summary")
    split = add_split(event_bars(spark, sf))
    write_summary(pipeline_summary(split), path, at=F.lit(AS_OF).cast("timestamp_ntz"))
    return spark.read.json(path)


# Quality checks

@query
def v_quality_report(spark, sf):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return quality_report(damaged_bars(spark, sf), as_of)


@query
def v_quality_summary(spark, sf):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    found = quality_summary(quality_report(damaged_bars(spark, sf), as_of))
    return found.withColumn("issues", F.concat_ws(",", "issues"))


@query
def v_quality_report_many_symbols(spark, sf):
    as_of = F.lit("1997-01-01").cast("timestamp_ntz")
    return quality_report(bars_from_order_lines(spark, sf), as_of)


# Cleaning

@query
def c_clean_bars(spark, sf):
    return clean_bars(damaged_bars(spark, sf))


# Features

@query
def p_price_features(spark, sf):
    return rounded(features_of(spark, sf, ("price",), names_of("price")))


@query
def p_price_features_many_symbols(spark, sf):
    bars = lambda s, d: with_known_positions(bars_from_order_lines(s, d))
    return rounded(features_of(spark, sf, ("price",), names_of("price"), bars))


@query
def u_volume_features(spark, sf):
    return rounded(features_of(spark, sf, ("volume",), names_of("volume")))


@query
def k_marketcap_features(spark, sf):
    return rounded(features_of(spark, sf, ("marketcap",), names_of("marketcap")))


@query
def t_calendar_features(spark, sf):
    return rounded(features_of(spark, sf, ("calendar",), CALENDAR))


@query
def t_calendar_features_many_symbols(spark, sf):
    bars = lambda s, d: with_known_positions(bars_from_order_lines(s, d))
    return rounded(features_of(spark, sf, ("calendar",), CALENDAR, bars))


TREND = ["SMA_5", "SMA_10", "SMA_20", "EMA_5", "EMA_10", "EMA_20"]
MACD = ["MACD", "MACD_Signal", "MACD_Histogram"]
BANDS = ["BB_Upper", "BB_Middle", "BB_Lower", "BB_Width", "BB_Position"]


@query
def i_moving_averages(spark, sf):
    return rounded(features_of(spark, sf, ("technical",), TREND))


@query
def i_rsi(spark, sf):
    return rounded(features_of(spark, sf, ("technical",), ["RSI_14"]))


@query
def i_macd(spark, sf):
    return rounded(features_of(spark, sf, ("technical",), MACD))


@query
def i_bollinger(spark, sf):
    return rounded(features_of(spark, sf, ("technical",), BANDS))


@query
def i_indicators_many_symbols(spark, sf):
    bars = lambda s, d: with_known_positions(bars_from_order_lines(s, d))
    return rounded(features_of(spark, sf, ("technical",), [*TREND[:3], "RSI_14", *BANDS], bars))


@query
def z_return_statistics(spark, sf):
    names = names_of("statistical")
    return rounded(features_of(spark, sf, ("statistical",), names), 4)


@query
def z_return_statistics_many_symbols(spark, sf):
    bars = lambda s, d: with_known_positions(bars_from_order_lines(s, d))
    return rounded(features_of(spark, sf, ("statistical",), names_of("statistical"), bars), 4)


@query
def z_features_of_dirty_bars(spark, sf):
    """Cleaning and the window features in one go, with gaps in the data."""
    clean = clean_bars(damaged_bars(spark, sf), keep_positions=True)
    df = add_features(clean, families=("price", "volume", "statistical"))
    names = ["Open_Change", "Open_MA_5", "Open_Std_20", "Volume_Change", "Volume_MA_10",
             "Volume_Ratio", "Momentum_10", "Volatility_5"]
    return rounded(df.select("Symbol", "SNo", *names), 4)


def long_series(spark, sf) -> DataFrame:
    """All events as one numbered series; values are unknown at the start and now and then."""
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        F.lit("all").alias("Symbol"), F.col("ts").alias("Date"), F.col("event_id").alias("SNo"),
        F.col("value").alias("Open"))
    numbered = stored(number_rows(events), "events").withColumn("SNo", F.col(POS))
    gaps = (F.col(POS) > 700) & (F.col(POS) % 7 == 0)
    return numbered.withColumns({"Close": F.when(gaps, F.col("Open"))})


@query
def p_long_windows(spark, sf):
    """Windows longer than the history that weighted means need, over several blocks."""
    df = add_features(long_series(spark, sf), windows=(2000,), families=("price", "technical"), block_rows=2048)
    return rounded(df.select("SNo", *[f"Open_{k}_2000" for k in ("MA", "Std", "Min", "Max")]))


@query
def r_fill_long_series(spark, sf):
    """Gaps of one series over several blocks, the first ones before any known value."""
    df = long_series(spark, sf).drop("Date")
    return rounded(fill_gaps(df, block_rows=1024).select("SNo", "Open", "Close"))


# Repair

def damaged_values(spark, sf) -> DataFrame:
    clean = clean_bars(damaged_bars(spark, sf), keep_positions=True)
    return stored(clean, "clean")


@query
def r_bounds(spark, sf):
    df = clip_bounds(damaged_values(spark, sf), VALUES)
    return rounded(df.select(
        F.expr("substring(_series, 2)").alias("Symbol"),
        *[F.col(f"_{k}_{c}").alias(f"{c}_{k}") for c in VALUES for k in ("low", "high")],
    ), 2)


@query
def r_bounds_many_symbols(spark, sf):
    df = with_known_positions(stored(bars_from_order_lines(spark, sf), "bars"))
    return rounded(clip_bounds(df, VALUES).select(
        F.expr("substring(_series, 2)").alias("Symbol"),
        *[F.col(f"_{k}_{c}").alias(f"{c}_{k}") for c in VALUES for k in ("low", "high")],
    ), 2)


@query
def r_bounds_long_series(spark, sf):
    """One series longer than what is sorted at once; one column is known in every 200th row."""
    names = ["Open", "Close", "High"]
    df = long_series(spark, sf).withColumn("High", F.when(F.col(POS) % 200 == 0, F.col("Open")))
    return rounded(clip_bounds(df, names, block_rows=1024).select(
        F.expr("substring(_series, 2)").alias("Symbol"),
        *[F.col(f"_{k}_{c}").alias(f"{c}_{k}") for c in names for k in ("low", "high")],
    ))


@query
def r_bounds_of_training_part(spark, sf):
    df = clip_bounds(damaged_values(spark, sf), VALUES, fit_scope="train")
    return rounded(df.select(
        F.expr("substring(_series, 2)").alias("Symbol"),
        *[F.col(f"_{k}_{c}").alias(f"{c}_{k}") for c in VALUES for k in ("low", "high")],
    ), 2)


@query
def r_clip(spark, sf):
    df = damaged_values(spark, sf)
    clipped = clip(df, clip_bounds(df, VALUES))
    return rounded(clipped.select("Symbol", "SNo", *VALUES), 2)


@query
def r_fill(spark, sf):
    df = damaged_values(spark, sf)
    return rounded(fill_gaps(df).select("Symbol", "SNo", *VALUES), 2)


@query
def r_repair(spark, sf):
    df = repair(damaged_values(spark, sf).drop("Name"))
    return rounded(df.select("Symbol", F.col(POS).alias("position"), "SNo", *VALUES), 2)


@query
def r_repaired_features(spark, sf):
    """All 80 features, repaired."""
    df = repair(add_features(event_bars(spark, sf)))
    df = df.withColumn("position", F.col(POS))
    return rounded(drop_working_columns(df), 4, VALUES)


# Encoding, imputing, scaling

NUMBERS = ["Open", "Close", "Volume"]


@query
def e_encoded(spark, sf):
    split = add_split(event_bars(spark, sf))
    codes = category_codes(split.where("split = 'train' AND Symbol != 'view'"))
    return encode(split, codes).select(F.col(POS).alias("position"), "Date", "Name", "Symbol", "Close")


@query
def e_statistics(spark, sf):
    split = add_split(damaged_values(spark, sf)).where("split = 'train'")
    return rounded(Statistics.fit(split, NUMBERS).to_table(spark), 4)


@query
def e_imputed(spark, sf):
    split = add_split(damaged_values(spark, sf))
    fitted = Statistics.fit(split.where("split = 'train'"), NUMBERS)
    return rounded(fitted.apply(split, scale=False).select("Symbol", "SNo", "split", *NUMBERS), 4)


@query
def e_scaled(spark, sf):
    split = add_split(damaged_values(spark, sf))
    fitted = Statistics.fit(split.where("split = 'train'"), NUMBERS)
    return rounded(fitted.apply(split).select("Symbol", "SNo", "split", *NUMBERS))


# Splits

@query
def x_split_counts(spark, sf):
    return rounded(split_counts(add_split(event_bars(spark, sf))))


@query
def x_split_counts_many_symbols(spark, sf):
    bars = with_known_positions(bars_from_order_lines(spark, sf))
    return rounded(split_counts(add_split(bars)))


@query
def x_split_rows(spark, sf):
    return add_split(event_bars(spark, sf)).select("Symbol", "SNo", "split")


@query
def x_folds(spark, sf):
    train_rows = add_split(event_bars(spark, sf)).where("split = 'train'")
    return fold_counts(train_rows)


@query
def x_fold_rows(spark, sf):
    bars = stored(event_bars(spark, sf), "bars")
    marked = stored(with_folds(bars.select(SERIES, POS, "Symbol", "SNo"), N_FOLDS), "folds")
    parts = [fold_part(marked, i, role).select(F.lit(i).alias("fold"), "Symbol", "SNo", F.lit(role).alias("role"))
             for i in range(N_FOLDS) for role in ("train", "test")]
    return reduce(DataFrame.unionByName, parts)


# Models and metrics. The first three judge a rule that needs no training: the
# mean of the last five closes.

def rule_predictions(spark, sf, bars=bars_from_events) -> DataFrame:
    df = add_features(with_known_positions(bars(spark, sf)), families=("technical",))
    return add_split(df.withColumn("prediction", F.col("SMA_5")))


@query
def m_metrics(spark, sf):
    return rounded(metrics(rule_predictions(spark, sf)), large=["mse"])


@query
def m_performance_summary(spark, sf):
    return rounded(performance_summary(rule_predictions(spark, sf)))


@query
def m_metrics_by_symbol(spark, sf):
    df = rule_predictions(spark, sf, bars_from_order_lines)
    return rounded(metrics(df, by=("Symbol", "split")), large=["mse"])


@query
def m_comparison(spark, sf):
    known = rule_predictions(spark, sf).where("prediction IS NOT NULL")
    names = ["actual", "predicted", "error", "abs_error", "pct_error"]
    return rounded(comparison(known).select("Symbol", "SNo", "split", *names))


def prepared(spark, sf):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return prepare_bars(damaged_bars(spark, sf), as_of=as_of)


def trained(spark, sf):
    data = prepared(spark, sf)
    return data, train(data.table, data.preprocessor.features, perform_cv=False, **SMALL_FOREST)


@query
def m_training_metrics(spark, sf):
    _, result = trained(spark, sf)
    rows = [(part, m, v) for part, values in result.metrics.items() for m, v in values.items()]
    return spark.createDataFrame(rows, "split string, metric string, value double")


@query
def m_predictions(spark, sf):
    data, result = trained(spark, sf)
    return predict(result.model, data.table).select("split", "Close", "prediction")


@query
def m_importances(spark, sf):
    _, result = trained(spark, sf)
    path = scratch(spark, "importances")
    write_importances(result.importances, path)
    return spark.read.schema("feature string, importance double").csv(path, header=True)


@query
def m_top_features(spark, sf):
    _, result = trained(spark, sf)
    return top_features(result.importances, 10)


@query
def m_cross_validation(spark, sf):
    data = prepared(spark, sf)
    rows = data.table.where("split = 'train'")
    scores = cross_validate(rows, data.preprocessor.features, **SMALL_FOREST)
    return cv_summary(scores)


@query
def m_grid_search(spark, sf):
    data = prepared(spark, sf)
    grid = {"numTrees": [5, 10], "maxDepth": [3], "minInstancesPerNode": [2]}
    rows = data.table.where("split = 'train'")
    return grid_search(rows, data.preprocessor.features, grid=grid, n_folds=2)


# Training whose result SQL can tell: a tree of depth 0 over all rows is the mean of
# its training rows. Folds, scores, grid and run table are those of any forest.

MEAN = {"numTrees": 1, "maxDepth": 0, "bootstrap": False}
MEAN_FEATURES = ["High", "Low", "Open", "Volume"]


def split_bars(spark, sf) -> DataFrame:
    return stored(add_split(event_bars(spark, sf)), "split-bars")


@query
def m_mean_predictions(spark, sf):
    table = split_bars(spark, sf)
    result = train(table, MEAN_FEATURES, perform_cv=False, **MEAN)
    return rounded(predict(result.model, table).select("Symbol", "SNo", "split", "Close", "prediction"))


@query
def m_mean_cross_validation(spark, sf):
    rows = split_bars(spark, sf).where("split = 'train'")
    return rounded(cross_validate(rows, MEAN_FEATURES, **MEAN), 4)


@query
def m_mean_grid_search(spark, sf):
    rows = split_bars(spark, sf).where("split = 'train'")
    return rounded(grid_search(rows, MEAN_FEATURES, grid={k: [v] for k, v in MEAN.items()} | {"numTrees": [2, 1]}), 4)


@query
def s_training_runs(spark, sf):
    """The run table of a training with cross-validation that was tried twice, beside another run."""
    path = scratch(spark, "runs")
    append_run(spark, path, "tried twice", {("data", "lost"): 1.0, ("cv", "mse_mean"): -1.0})
    append_run(spark, path, "other", {("param", "numTrees"): 7, ("cv", "none"): None})
    result = train(split_bars(spark, sf), MEAN_FEATURES, **MEAN)
    append_run(spark, path, "tried twice", run_values(result))
    return rounded(read_runs(spark, path), 4)


# Batch scoring

def requests(spark, sf) -> DataFrame:
    """Every bar as a scoring request, some of them not acceptable."""
    i = F.col("SNo")
    return bars_from_events(spark, sf).select(
        F.when(i % 41 == 0, 0).otherwise(i).cast("long").alias("SNo"),
        F.when(i % 43 == 0, "").otherwise(F.col("Name")).alias("Name"),
        F.when(i % 47 == 0, "a symbol too long").otherwise(F.col("Symbol")).alias("Symbol"),
        F.when(i % 53 == 0, "01/02/2023").otherwise(F.date_format("Date", "yyyy-MM-dd")).alias("Date"),
        F.when(i % 59 == 0, F.col("Low") - 1).otherwise(F.col("High")).alias("High"),
        F.when(i % 61 == 0, -F.col("Low")).otherwise(F.col("Low")).alias("Low"),
        "Open",
        F.when(i % 37 != 0, F.col("Volume")).alias("Volume"),
        F.when(i % 31 == 0, -1.0).otherwise(F.col("Marketcap")).alias("Marketcap"),
    )


@query
def b_request_rules(spark, sf):
    checked = check_requests(requests(spark, sf))
    return checked.groupBy(F.concat_ws(",", "errors").alias("errors")).agg(
        F.count(F.lit(1)).alias("requests")
    )


def saved_model(spark, sf):
    data, result = trained(spark, sf)
    path = scratch(spark, "models")
    save_model(result, data.preprocessor, data.bounds, path, at=F.lit(AS_OF).cast("timestamp_ntz"))
    return load_model(spark, path)


@query
def b_scores(spark, sf):
    history = clean_bars(damaged_bars(spark, sf), keep_positions=True)
    at = F.lit(AS_OF).cast("timestamp_ntz")
    return score(saved_model(spark, sf), stored(history, "history"), requests(spark, sf), at=at)


@query
def b_model_info(spark, sf):
    return model_info(saved_model(spark, sf))


# Summaries

@query
def q_feature_summary(spark, sf):
    df = add_features(event_bars(spark, sf), families=("price", "volume"))
    return feature_summary(df)


@query
def q_feature_classes(spark, sf):
    """Classes of the feature columns, with the number of known values of each."""
    df = add_features(event_bars(spark, sf))
    names = [c for c in df.columns if not c.startswith("_")]
    cells = [F.struct(F.lit(c).alias("column"), F.count(c).alias("known")) for c in names]
    known = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return feature_classes(df).join(known, "column")


@query
def q_pipeline_summary(spark, sf):
    return prepared(spark, sf).summary
