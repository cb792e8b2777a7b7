import numpy as np
import pandas as pd
import pytest

from barloom.operators.features import add_features, feature_names
from barloom.operators.series import number_rows, with_known_positions
from barloom.schema import BARS
from tests.series_data import make_bars, pandas_features, to_spark

NAMES = feature_names([f.name for f in BARS])


def compare(got: pd.DataFrame, bars: pd.DataFrame, names=NAMES, rtol=1e-8, skip=()):
    got = got.set_index(["Symbol", "SNo"]).sort_index()
    for symbol, part in bars.groupby("Symbol"):
        want = pandas_features(part.reset_index(drop=True)).set_index("SNo")
        have = got.loc[symbol]
        assert list(have.index) == list(want.index)
        for c in names:
            if c in skip:
                continue
            np.testing.assert_allclose(
                have[c].astype(float).to_numpy(), want[c].astype(float).to_numpy(),
                rtol=rtol, atol=1e-7, err_msg=f"{symbol} {c}",
            )


def test_counts_eighty_features():
    assert len(NAMES) == 80 and len(set(NAMES)) == 80


def test_two_shuffled_series_match_pandas(spark):
    bars = make_bars({"AAA": 200, "BBB": 61})
    got = add_features(with_known_positions(to_spark(spark, bars)))
    compare(got.toPandas(), bars)


def test_missing_values_match_pandas(spark):
    bars = make_bars({"AAA": 300, "BBB": 90}, null_share=0.05, seed=11)
    got = add_features(with_known_positions(to_spark(spark, bars)))
    compare(got.toPandas(), bars)


def test_short_series_has_no_rolling_values(spark):
    bars = make_bars({"AAA": 3})
    got = add_features(with_known_positions(to_spark(spark, bars))).toPandas()
    assert got[[f"SMA_{n}" for n in (5, 10, 20)] + ["RSI_14", "BB_Upper"]].isna().all().all()


def test_blocks_do_not_change_results(spark):
    """A series over several blocks, with runs of missing closes longer than the
    halo that cross block borders."""
    bars = make_bars({"AAA": 7000, "BBB": 1600}, null_share=0.02, seed=5)
    close = bars.columns.get_loc("Close")
    for start, stop in ((1200, 1530), (1900, 3100), (4000, 6700)):
        bars.iloc[start:stop, close] = np.nan
    bars.iloc[2500:4700, bars.columns.get_loc("Open")] = np.nan
    got = add_features(with_known_positions(to_spark(spark, bars)), block_rows=1536)
    compare(got.toPandas(), bars, rtol=1e-7)


def test_short_lookback_blocks(spark):
    bars = make_bars({"AAA": 2000}, null_share=0.1, seed=8)
    got = add_features(
        with_known_positions(to_spark(spark, bars)), block_rows=512,
        families=("price", "volume", "marketcap", "statistical"),
    ).toPandas()
    names = feature_names(bars.columns, families=("price", "volume", "marketcap", "statistical"))
    compare(got, bars, names)


def test_flat_and_rising_series(spark):
    flat = make_bars({"FLAT": 30}, flat=("FLAT",))
    got = add_features(with_known_positions(to_spark(spark, flat))).toPandas().sort_values("SNo")
    last = got.iloc[-1]
    assert pd.isna(last["RSI_14"]) and pd.isna(last["BB_Position"])
    assert last["Skewness_20"] == 0.0 and last["Kurtosis_20"] == -3.0
    rising = make_bars({"UP": 30}).assign(Close=np.arange(1.0, 31.0))
    got = add_features(with_known_positions(to_spark(spark, rising))).toPandas()
    assert (got["RSI_14"].dropna() == 100).all() and got["RSI_14"].notna().sum() == 17


def test_families_follow_available_columns(spark):
    bars = make_bars({"AAA": 30})
    df = with_known_positions(to_spark(spark, bars)).drop("Close", "Volume")
    got = add_features(df)
    assert not any(c.startswith(("SMA", "Volume", "Volatility")) for c in got.columns)
    assert "Open_MA_5" in got.columns and "Year" in got.columns
    with pytest.raises(ValueError):
        add_features(df, families=("prices",))


def test_numbering_spans_partitions(spark):
    bars = make_bars({"AAA": 900, "BBB": 20, "CCC": 1})
    bars["SNo"] = 5  # no help from the serial number
    got = number_rows(to_spark(spark, bars)).select("Symbol", "Date", "_pos").toPandas()
    got = got.sort_values(["Symbol", "Date"])
    for _, part in got.groupby("Symbol"):
        assert list(part["_pos"]) == list(range(1, len(part) + 1))


def test_numbering_with_missing_symbol_and_ties(spark):
    bars = make_bars({"AAA": 40})
    bars["Date"] = pd.Timestamp("2020-01-01")
    df = to_spark(spark, bars.assign(Symbol=np.nan))
    got = number_rows(df).select("_pos").toPandas()["_pos"]
    assert sorted(got) == list(range(1, 41))
