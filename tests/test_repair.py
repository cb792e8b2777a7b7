import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators.prepare import Preprocessor, Statistics, category_codes, encode
from barloom.operators.quantiles import exact_quantiles, quantile_name
from barloom.operators.repair import clip_bounds, fill_gaps, repair
from barloom.operators.series import with_known_positions
from barloom.operators.split import add_fold, add_split, fold_counts, fold_part, split_counts, with_folds
from barloom.schema import parse_date
from tests.series_data import make_bars, to_spark

COLS = ["Open", "Close", "Volume", "High", "Low", "Marketcap", "SNo"]


def positioned(spark, bars):
    df = to_spark(spark, bars).withColumn("Date", parse_date(F.col("Date")))
    return with_known_positions(df)


def pandas_repair(part):
    out = part.copy()
    for c in COLS:
        q1, q3 = out[c].quantile(0.01), out[c].quantile(0.99)
        out[c] = out[c].clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    return out.ffill().bfill().fillna(0)


def spiky(lengths, **kw):
    bars = make_bars(lengths, **kw)
    bars.loc[bars.index % 50 == 3, "Close"] *= 1e6
    bars.loc[bars.index % 400 == 7, "Open"] /= 1e3
    return bars


@pytest.mark.parametrize("sorted_rows", [4096, 3])
def test_quantiles_are_exact(spark, sorted_rows):
    bars = spiky({"AAA": 4000, "BBB": 300, "CCC": 1}, null_share=0.1)
    bars.loc[bars["Symbol"] == "BBB", "Volume"] = np.nan
    df = positioned(spark, bars)
    probs = [0.01, 0.5, 0.99]
    got = exact_quantiles(df, COLS, probs, sorted_rows=sorted_rows, block_rows=512)
    got = got.toPandas().set_index("_series")
    for symbol, part in bars.groupby("Symbol"):
        for c in COLS:
            for i, p in enumerate(probs):
                have, want = got.loc[f"+{symbol}", quantile_name(c, i)], part[c].quantile(p)
                np.testing.assert_allclose(
                    float(have), want, rtol=1e-12, err_msg=f"{symbol} {c} {p}"
                )


def test_quantiles_of_whole_table_with_ties(spark):
    bars = make_bars({"AAA": 3000, "BBB": 50})
    bars.loc[bars.index < 2000, "Close"] = 5.0  # two thirds of the rows are one value
    got = exact_quantiles(
        positioned(spark, bars), ["Close", "Open"], [0.5, 0.9], whole_table=True, sorted_rows=5
    ).collect()
    assert len(got) == 1
    for c in ("Close", "Open"):
        for i, p in enumerate((0.5, 0.9)):
            assert got[0][quantile_name(c, i)] == pytest.approx(bars[c].quantile(p), rel=1e-12)


def test_quantiles_of_odd_values(spark):
    """Signs, magnitudes, neighbouring doubles, infinities, single and missing values."""
    one = float(np.nextafter(1.0, 2.0))
    lists = {
        "mixed": [-1e308, -3.5, -5e-324, -0.0, 0.0, 5e-324, 1e-300, 2.0, 7.0, 1e308],
        "close": [1.0] * 40 + [one] * 41 + [float(np.nextafter(one, 2.0))] * 3,
        "tiny": [5e-324] * 7 + [1e-323] * 8,
        "ends": [float("-inf")] * 3 + [0.5] + [float("inf")] * 4,
        "single": [4.0], "none": [None, None], "partly": [None, 3.0, float("nan"), 1.0],
        "spread": [float(x) for x in np.exp(np.random.default_rng(5).normal(0, 40, 300))],
    }
    rows = [(s, k + 1, x) for s, xs in lists.items() for k, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "_series string, _pos long, x double")
    probs = [0.0, 0.01, 0.3, 0.5, 0.99, 1.0]
    for sorted_rows in (1, 4096):
        got = {r["_series"]: r for r in exact_quantiles(df, ["x"], probs, sorted_rows=sorted_rows).collect()}
        assert {s: r["_n"] for s, r in got.items()} == {s: len(xs) for s, xs in lists.items()}
        for s, xs in lists.items():
            known = sorted(x for x in xs if x is not None and x == x)
            for i, p in enumerate(probs):
                if not known:
                    assert got[s][quantile_name("x", i)] is None
                    continue
                k = int(p * (len(known) - 1))
                low, high = known[k], known[min(k + 1, len(known) - 1)]
                want = low if low == high else low + (high - low) * (p * (len(known) - 1) - k)
                # Between infinities of both signs it is NaN.
                np.testing.assert_equal(got[s][quantile_name("x", i)], want, err_msg=f"{s} {p}")


def test_quantiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "_series string, _pos long, x double")
    assert exact_quantiles(df, ["x"], [0.5]).collect() == []
    assert exact_quantiles(df, ["x"], [0.5], whole_table=True).collect() == []


def test_a_long_series_with_few_values(spark):
    """One series is nearly the whole table, and one of its columns is nearly empty."""
    rows = (spark.range(1, 200_001).select(
        F.lit("+long").alias("_series"), F.col("id").alias("_pos"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0).alias("full"),
        F.when(F.col("id") % 200 == 0, F.sin("id")).alias("rare"))
        .unionByName(spark.range(1, 4).select(
            F.lit("+short").alias("_series"), F.col("id").alias("_pos"), F.col("id").cast("double").alias("full"),
            F.lit(None).cast("double").alias("rare"))))
    got = {r["_series"]: r for r in exact_quantiles(rows, ["full", "rare"], [0.01, 0.99], block_rows=4096).collect()}
    long = rows.where("_series = '+long'").toPandas()
    for c in ("full", "rare"):
        for i, p in enumerate((0.01, 0.99)):
            assert got["+long"][quantile_name(c, i)] == pytest.approx(long[c].quantile(p), rel=1e-12)
    assert got["+short"]["_q0_full"] == pytest.approx(1.02) and got["+short"]["_q0_rare"] is None


@pytest.mark.parametrize("block_rows", [512, 65536])
def test_repair_matches_pandas(spark, block_rows):
    bars = spiky({"AAA": 2600, "BBB": 70}, null_share=0.1, seed=4)
    bars.loc[:600, "Open"] = np.nan
    bars.loc[900:2100, "Volume"] = np.nan
    bars.loc[bars["Symbol"] == "BBB", "Marketcap"] = np.nan
    got = repair(positioned(spark, bars), block_rows=block_rows).toPandas()
    for symbol, part in bars.groupby("Symbol"):
        want = pandas_repair(part).reset_index(drop=True)
        have = got[got["Symbol"] == symbol].sort_values("_pos").reset_index(drop=True)
        for c in COLS:
            np.testing.assert_allclose(have[c].astype(float), want[c].astype(float), rtol=1e-12)
        assert not have.isna().any().any()


def test_missing_text_is_filled(spark):
    bars = make_bars({"AAA": 5})
    bars["Name"] = [None, "x", None, "y", None]
    got = fill_gaps(positioned(spark, bars)).orderBy("_pos").toPandas()["Name"]
    assert list(got) == ["x", "x", "x", "y", "y"]
    bars["Name"] = None
    got = fill_gaps(positioned(spark, bars)).toPandas()["Name"]
    assert list(got) == ["0"] * 5


def test_bounds_of_training_part(spark):
    bars = make_bars({"AAA": 100})
    got = clip_bounds(positioned(spark, bars), ["Close"], fit_scope="train").first()
    train = bars["Close"][:60]
    q1, q3 = train.quantile(0.01), train.quantile(0.99)
    assert got["_low_Close"] == pytest.approx(q1 - 1.5 * (q3 - q1))
    assert got["_high_Close"] == pytest.approx(q3 + 1.5 * (q3 - q1))


def test_split_sizes(spark):
    df = positioned(spark, make_bars({"AAA": 1000, "BBB": 7}))
    got = {(r.Symbol, r.split): r.rows for r in split_counts(add_split(df, block_rows=512)).collect()}
    assert [got["AAA", p] for p in ("train", "validation", "test")] == [600, 200, 200]
    assert [got["BBB", p] for p in ("train", "validation", "test")] == [4, 1, 2]
    with pytest.raises(ValueError):
        add_split(df, (0.5, 0.2, 0.2))


def test_folds(spark):
    df = positioned(spark, make_bars({"AAA": 65}))
    rows = {(r.fold, r.role): (r.rows, r.first_row, r.last_row) for r in fold_counts(df).collect()}
    assert [rows[i, "train"][0] for i in range(5)] == [15, 25, 35, 45, 55]
    assert all(rows[i, "test"][0] == 10 for i in range(5))
    fold = add_fold(df, 2).toPandas()
    assert (fold["role"] == "train").sum() == 35 and (fold["role"] == "test").sum() == 10
    assert fold[fold["role"] == "train"]["_pos"].max() < fold[fold["role"] == "test"]["_pos"].min()


def test_all_folds_of_one_table(spark):
    """Series of several lengths, more folds than rows in some; the marks tell the parts of each fold."""
    df = positioned(spark, make_bars({"AAA": 1300, "BBB": 7, "CCC": 2}))
    marked = with_folds(df, 5, block_rows=512).select("Symbol", "_pos", "_train_folds", "_test_folds").cache()
    assert marked.count() == 1309
    for i in range(5):
        want = {(r.Symbol, r.role): (r.rows, r.first_row, r.last_row)
                for r in fold_counts(df, 5).where(F.col("fold") == i).collect() if r.rows}
        got = {(r.Symbol, role): (r.n, r.low, r.high) for role in ("train", "test") for r in
               fold_part(marked, i, role).groupBy("Symbol").agg(
                   F.count("*").alias("n"), F.min("_pos").alias("low"), F.max("_pos").alias("high")).collect()}
        assert got == want
    for wrong in (0, 64):
        with pytest.raises(ValueError):
            with_folds(df, wrong)


def test_codes_are_sorted_and_unseen_is_minus_one(spark):
    bars = make_bars({"BBB": 3, "AAA": 3, "CCC": 2})
    df = positioned(spark, bars)
    codes = category_codes(df.where("Symbol != 'CCC'"))
    got = {(r["column"], r["value"]): r["code"] for r in codes.collect()}
    assert got["Symbol", "AAA"] == 0 and got["Symbol", "BBB"] == 1 and len(got) == 4
    encoded = encode(df, codes).toPandas()
    assert sorted(encoded["Symbol"].unique()) == [-1.0, 0.0, 1.0]
    assert encoded["Date"].min() == (pd.Timestamp("2015-01-01") - pd.Timestamp(0)).days


def test_scaling_uses_population_sd(spark):
    bars = make_bars({"AAA": 40}, null_share=0.2)
    df = positioned(spark, bars).withColumn("One", F.lit(1.0))
    stats = Statistics.fit(df, ["Open", "Volume", "One"])
    got = stats.apply(df).orderBy("_pos").toPandas()
    for c in ("Open", "Volume"):
        x = bars[c].fillna(bars[c].median())
        np.testing.assert_allclose(got[c], (x - x.mean()) / x.std(ddof=0), rtol=1e-9, atol=1e-12)
    assert (got["One"] == 0).all()
    table = stats.to_table(spark)
    assert Statistics.from_table(table) == stats
    with pytest.raises(ValueError):
        stats.apply(df.drop("Open"))
    with pytest.raises(ValueError):
        Statistics({}).apply(df)


def test_preprocessor_gives_same_columns_to_every_part(spark):
    df = add_split(positioned(spark, make_bars({"AAA": 50, "BBB": 20})))
    fitted = Preprocessor.fit(df.where("split = 'train'"))
    out = fitted.transform(df)
    assert set(fitted.features) <= set(out.columns) and "Close" not in fitted.features
    assert out.count() == 70
