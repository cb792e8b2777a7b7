import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators.evaluate import comparison, metrics, performance_summary, top_features
from barloom.operators.features import add_features
from barloom.operators.persist import load_model, model_info, save_model, saves
from barloom.operators.repair import repair
from barloom.operators.report import feature_classes, feature_summary
from barloom.operators.score import check_requests, request_features, score
from barloom.operators.series import with_known_positions
from barloom.operators.train import cross_validate, cv_summary, grid_search, make_model, predict, train
from barloom.plans.training import train_and_save
from barloom.sources.sinks import append_run, read_runs
from tests.series_data import make_bars, to_spark

FOREST = {"numTrees": 3, "maxDepth": 3, "maxBins": 32}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("job"))
    bars = make_bars({"AAA": 150, "BBB": 70})
    raw = to_spark(spark, bars)
    prepared, training = train_and_save(
        raw, path, "first", perform_cv=False, **FOREST
    )
    return path, bars, prepared, training


def test_metrics_match_formulas(spark):
    rng = np.random.default_rng(2)
    y, p = rng.normal(10, 3, 50), rng.normal(10, 3, 50)
    y[7] = 0.0
    rows = [("a", float(a), float(b)) for a, b in zip(y, p)]
    df = spark.createDataFrame(rows, "split string, Close double, prediction double")
    got = metrics(df).first()
    e = y - p
    assert got["mae"] == pytest.approx(np.abs(e).mean())
    assert got["rmse"] == pytest.approx(np.sqrt((e**2).mean()))
    assert got["r2"] == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    assert got["mape"] == pytest.approx(np.abs(e[y != 0] / y[y != 0]).mean() * 100)
    assert got["zero_actuals"] == 1
    assert performance_summary(df).columns == ["split", "mae", "rmse", "r2", "mape"]
    pair = comparison(df).where("Close != 0").first()
    assert pair["pct_error"] == pytest.approx(abs(pair["error"] / pair["actual"]) * 100)


def test_training_run(run):
    path, _, prepared, training = run
    assert set(training.metrics) == {"train", "validation", "test"}
    assert len(prepared.preprocessor.features) == 89
    weights = [r["importance"] for r in training.importances.collect()]
    assert len(weights) == 89 and sum(weights) == pytest.approx(1.0)
    assert weights == sorted(weights, reverse=True)
    assert top_features(training.importances, 5).count() == 5
    summary = prepared.summary.first()
    assert summary["rows"] == 220 and summary["train_samples"] == 90 + 42


def test_saved_model_predicts_the_same(spark, run):
    path, _, prepared, training = run
    saved = load_model(spark, f"{path}/models")
    a = predict(training.model, prepared.table).select("_series", "_pos", "prediction").toPandas()
    b = predict(saved.model, saved.preprocessor.transform(prepared.features)).select(
        "_series", "_pos", "prediction").toPandas()
    keys = ["_series", "_pos"]
    np.testing.assert_allclose(
        a.sort_values(keys)["prediction"], b.sort_values(keys)["prediction"], rtol=1e-12
    )
    info = model_info(saved).first()
    assert info["feature_count"] == 89 and info["model_version"] == "1.0.0"
    runs = {(r["kind"], r["name"]): r["value"] for r in read_runs(spark, f"{path}/runs").collect()}
    assert runs["test", "mae"] == pytest.approx(training.metrics["test"]["mae"])
    with pytest.raises(FileNotFoundError):
        load_model(spark, f"{path}/nowhere")
    with pytest.raises(ValueError):
        predict(None, prepared.table)


def test_scoring_continues_the_series(spark, run):
    path, bars, prepared, _ = run
    saved = load_model(spark, f"{path}/models")
    raw = with_known_positions(to_spark(spark, bars)).withColumn(
        "Date", F.to_timestamp_ntz("Date", F.lit("yyyy-MM-dd")))
    requests = spark.createDataFrame(
        [(151, "AAA coin", "AAA", "2016-01-01", 110.0, 90.0, 100.0, 3.0, 1e8),
         (71, "BBB coin", "BBB", "2016-01-01", 110.0, 90.0, 100.0, 3.0, 1e8),
         (72, "BBB coin", "BBB", "2016-01-01", 80.0, 90.0, 100.0, 3.0, 1e8),
         (1, "New", "NEW", "2016-01-01", 110.0, 90.0, 100.0, 3.0, 1e8)],
        "SNo long, Name string, Symbol string, Date string, High double, Low double, "
        "Open double, Volume double, Marketcap double",
    )
    errors = {r["SNo"]: r["errors"] for r in check_requests(requests).collect()}
    assert errors[72] == ["High<Low", "High<Open"] and errors[151] == []
    got = {r["input_data"]["Symbol"]: r for r in score(saved, raw, requests).collect()}
    assert set(got) == {"AAA", "BBB", "NEW"}
    assert all(r["predicted_price"] is not None for r in got.values())
    assert got["AAA"]["confidence_score"] == 0.85
    assert got["AAA"]["input_data"]["Date"] == "2016-01-01"


def asked_rows(spark, rows):
    return spark.createDataFrame(rows, "_request long, SNo long, Name string, Symbol string, Date string, High double, "
                                 "Low double, Open double, Volume double, Marketcap double")


def test_requests_see_the_whole_history_and_not_each_other(spark, run):
    """The features of each request against those of its history with the request as last row."""
    path, _, _, _ = run
    saved = load_model(spark, f"{path}/models")
    long = make_bars({"AAA": 2100, "BBB": 30})
    # The closes and opens of most of the series are unknown, and some single ones.
    gone = (long["Symbol"] == "AAA") & (long["SNo"] > 290)
    long.loc[gone, ["Close", "Open"]] = np.nan
    long.loc[long["SNo"] % 17 == 3, ["Close", "Volume"]] = np.nan
    raw = with_known_positions(to_spark(spark, long)).withColumn(
        "Date", F.to_timestamp_ntz("Date", F.lit("yyyy-MM-dd")))
    dates = [str(d)[:10] for d in long[long["Symbol"] == "AAA"]["Date"]]
    rows = [(k, 9, "n", s, d, 110.0 + k, 90.0, 100.0, 3.0, 1e8) for k, (s, d) in enumerate(
        [("AAA", dates[2099]), ("AAA", dates[300]), ("NEW", "2016-01-01")])]
    asked = asked_rows(spark, rows).withColumn("Date", F.to_timestamp_ntz("Date", F.lit("yyyy-MM-dd")))
    got = {r["_request"]: r for r in request_features(saved, raw, asked).collect()}
    assert len(got) == len(rows)
    # A new symbol has no known close.
    assert got[2]["Close"] == 0 and got[2]["EMA_20"] == 0
    names = [f.name for f in raw.schema if not f.name.startswith("_")]
    for request in asked.where("_request = 0").collect():
        before = raw.where((F.col("Symbol") == request["Symbol"]) & (F.col("Date") < F.lit(request["Date"])))
        n = before.count()
        last = asked.where(F.col("_request") == request["_request"]).drop("_request").withColumns(
            {"Close": F.lit(None).cast("double")}).select(*names)
        whole = with_known_positions(before.select(*names).unionByName(
            last.withColumn("SNo", F.lit(n + 1).cast("long"))))
        want = repair(add_features(whole), bounds=saved.bounds).where(F.col("_pos") == n + 1).first()
        for c in names + ["EMA_20", "MACD", "MACD_Signal", "MACD_Histogram", "RSI_14", "BB_Position", "Open_MA_20",
                          "Volume_Std_20", "Skewness_20", "Momentum_10", "Marketcap_Change", "SMA_5", "Open_Change"]:
            if c not in ("SNo", "Date", "Name", "Symbol"):
                assert got[request["_request"]][c] == pytest.approx(want[c], rel=1e-6, abs=1e-7), (request, c)


def test_a_batch_scores_like_its_requests_alone(spark, run):
    path, bars, _, training = run
    saved = load_model(spark, f"{path}/models")
    raw = with_known_positions(to_spark(spark, bars)).withColumn(
        "Date", F.to_timestamp_ntz("Date", F.lit("yyyy-MM-dd")))
    rows = [(k, 1, "n", s, f"201{y}-01-0{k + 1}", 110.0 + 9 * k, 90.0, 100.0, 3.0 * k, 1e8)
            for k, (s, y) in enumerate([("AAA", 6), ("AAA", 6)])]
    asked = asked_rows(spark, rows).withColumnRenamed("_request", "request_id")
    at = F.lit("2030-01-01").cast("timestamp_ntz")
    batch = {r["request_id"]: r for r in score(saved, raw, asked, at=at).collect()}
    assert {r["prediction_timestamp"] for r in batch.values()} == {"2030-01-01T00:00:00"}
    assert {r["model_version"] for r in batch.values()} == {"1.0.0"}
    save_model(training, saved.preprocessor, saved.bounds, f"{path}/models", version="2.5.0")
    newer = load_model(spark, f"{path}/models", "2.5.0")
    alone = score(newer, raw, asked.where("request_id = 0"), at=at).first()
    assert alone["predicted_price"] == pytest.approx(batch[0]["predicted_price"], rel=1e-12)
    assert alone["model_version"] == "2.5.0"


def test_an_interrupted_save_leaves_the_old_model(spark, run, tmp_path, monkeypatch):
    from barloom.operators import persist
    _, _, prepared, training = run
    path = str(tmp_path / "models")
    assert saves(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    early = F.lit("2024-01-01").cast("timestamp_ntz")
    first = save_model(training, prepared.preprocessor, prepared.bounds, path, at=early)

    def fails(*_):
        raise OSError("gone")

    with monkeypatch.context() as broken:  # half of the files are written then
        broken.setattr(persist, "write_importances", fails)
        with pytest.raises(OSError):
            save_model(training, prepared.preprocessor, prepared.bounds, path)
    with monkeypatch.context() as broken:  # all files, but no commit
        broken.setattr(persist, "_commit", fails)
        with pytest.raises(OSError):
            save_model(training, prepared.preprocessor, prepared.bounds, path)
    assert model_info(load_model(spark, path)).first()["training_date"] == "2024-01-01T00:00:00"

    reader = load_model(spark, path)
    late = F.lit("2025-01-01").cast("timestamp_ntz")
    second = save_model(training, prepared.preprocessor, prepared.bounds, path, at=late)
    assert first != second
    assert model_info(load_model(spark, path)).first()["training_date"] == "2025-01-01T00:00:00"
    # What was open before is still whole.
    assert model_info(reader).first()["training_date"] == "2024-01-01T00:00:00"
    assert reader.bounds.count() == prepared.bounds.count()
    save_model(training, prepared.preprocessor, prepared.bounds, path, version="0.9.0")
    assert load_model(spark, path).version == "1.0.0"
    assert load_model(spark, path, None).version == "0.9.0"
    assert [r["number"] for r in saves(spark, path).orderBy("number").collect()] == [1, 2, 3]
    with pytest.raises(FileNotFoundError):
        load_model(spark, path, "7.0.0")


def test_cross_validation_and_grid(run):
    _, _, prepared, _ = run
    rows = prepared.table.where("split = 'train'")
    features = ["Open", "High", "Low"]
    scores = cross_validate(rows, features, n_folds=3, **FOREST)
    mse = [r["mse"] for r in scores.collect()]
    assert cv_summary(scores).first()["mse_std"] == pytest.approx(np.std(mse))
    best = grid_search(rows, features, grid={"numTrees": [2], "maxDepth": [2, 4]}, n_folds=2).collect()
    assert len(best) == 2 and best[0]["mse_mean"] <= best[1]["mse_mean"]
    result = train(prepared.table, features, perform_cv=False, perform_grid_search=True,
                   grid={"numTrees": [2], "maxDepth": [3]}, n_folds=2)
    assert result.best_params == {"numTrees": 2, "maxDepth": 3}


def test_unknown_model_type():
    with pytest.raises(ValueError):
        make_model(["a"], model_type="boosting")


def test_feature_reports(spark):
    df = spark.createDataFrame(
        [(1.0, None, "x", 2.0)], "BB_Lower double, Quarter double, Name string, SMA_5 double")
    got = {r["column"]: r["class"] for r in feature_classes(df).collect()}
    assert got == {"BB_Lower": "price", "Quarter": "statistical", "Name": "statistical",
                   "SMA_5": "technical"}
    row = feature_summary(df).first()
    assert (row["total_features"], row["numeric_features"], row["missing_values"]) == (4, 3, 1)


def test_impossible_trees_are_refused():
    for wrong in ({"numTrees": 0}, {"maxDepth": -1}, {"minInstancesPerNode": 0}, {"maxBins": 1}):
        with pytest.raises(ValueError, match="at least"):
            make_model(["a"], **wrong)


def test_a_run_tried_again_counts_once(spark, tmp_path):
    path = str(tmp_path / "runs")
    append_run(spark, path, "2024-01-01", {("cv", "lost"): 1.0, ("cv", "mse_mean"): 2.0})
    append_run(spark, path, "a/b=c", {("cv", "mse_mean"): 3.0, ("cv", "none"): None})
    append_run(spark, path, "2024-01-01", {("cv", "mse_mean"): 4.0})
    got = read_runs(spark, path)
    assert got.columns == ["run_id", "kind", "name", "value"]
    assert {tuple(r) for r in got.collect()} == {
        ("2024-01-01", "cv", "mse_mean", 4.0), ("a/b=c", "cv", "mse_mean", 3.0)}
    with pytest.raises(ValueError):
        append_run(spark, path, "", {("cv", "mse_mean"): 1.0})
