import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators.clean import clean_bars
from barloom.operators.validate import (
    quality_report, quality_summary, schema_issues, unreadable_values,
)
from barloom.sources.bars import read_bars_csv, read_bars_parquet, read_raw_csv
from barloom.sources.sinks import write_bars_csv, write_features
from tests.series_data import make_bars, to_spark

AS_OF = datetime.datetime(2030, 1, 1)


def report_of(df):
    rows = quality_report(df, F.lit(AS_OF).cast("timestamp_ntz"), block_rows=512).collect()
    return {(r["Symbol"], r["check"], r["item"]): (r["violations"], r["status"]) for r in rows}


def test_clean_series_passes_everything(spark):
    bars = make_bars({"AAA": 700, "BBB": 30})
    df = to_spark(spark, bars)
    assert {s for _, s in report_of(df).values()} == {"pass"}
    summary = quality_summary(quality_report(df)).collect()
    assert all(r["overall_valid"] and r["total_issues"] == 0 for r in summary)


def test_each_defect_is_counted(spark):
    bars = make_bars({"AAA": 1300, "BBB": 30, "CCC": 4})
    bars.loc[3, "Close"] = -5.0
    bars.loc[5, "Open"] = 2e6
    bars.loc[7, "Volume"] = -1.0
    bars.loc[9, "High"] = np.nan
    bars = pd.concat([bars, bars.iloc[[20, 20, 21]]])
    bars.loc[600, "SNo"], bars.loc[601, "SNo"] = 602, 601
    got = report_of(to_spark(spark, bars))
    assert got["AAA", "price_data", "Close:negative"] == (1, "fail")
    assert got["AAA", "price_data", "Close:below"] == (1, "fail")
    assert got["AAA", "price_data", "Open:above"] == (1, "fail")
    assert got["AAA", "volume_data", "negative"] == (1, "fail")
    assert got["AAA", "volume_data", "above"] == (0, "skipped")
    assert got["AAA", "volume_consistency", "negative"] == (1, "fail")
    assert got["AAA", "missing_values", "High"] == (1, "fail")
    assert got["AAA", "duplicates", "rows"] == (3, "fail")
    assert got["AAA", "price_consistency", "High<Open"] == (1, "fail")
    assert got["AAA", "temporal_consistency", "inversions"] == (1, "fail")
    assert got["AAA", "temporal_consistency", "gaps"][1] == "skipped"
    assert got["BBB", "duplicates", "rows"] == (0, "pass")
    assert got["CCC", "data_presence", "rows"] == (1, "fail")


def test_dates_that_cannot_be_read_skip_later_checks(spark):
    df = to_spark(spark, make_bars({"AAA": 40}))
    df = df.withColumn("Date", F.when(F.col("SNo") == 4, "bad").otherwise(F.col("Date")))
    got = report_of(df)
    assert got["AAA", "date_data", "invalid"] == (1, "fail")
    assert got["AAA", "date_data", "future"][1] == "skipped"
    assert got["AAA", "temporal_consistency", "unreadable"] == (1, "fail")
    assert clean_bars(df).count() == 39


def test_gap_and_missing_symbol(spark):
    bars = make_bars({"AAA": 40})
    bars.loc[20:, "Date"] += pd.Timedelta(days=31)
    got = report_of(to_spark(spark, bars.assign(Symbol=None)))
    assert got[None, "temporal_consistency", "gaps"] == (1, "fail")
    assert got[None, "duplicates", "rows"] == (0, "pass")


def test_missing_column_is_reported_not_raised(spark):
    df = to_spark(spark, make_bars({"AAA": 20})).drop("Close", "Volume")
    assert schema_issues(df) == (["Close", "Volume"], [])
    got = report_of(df)
    assert got["AAA", "required_columns", "all"] == (2, "fail")
    assert ("AAA", "volume_data", "negative") not in got


def test_cleaning(spark):
    bars = make_bars({"AAA": 60, "BBB": 10})
    bars.loc[4, "Close"] *= -1
    bars = pd.concat([bars, bars.iloc[[4, 5]]]).assign(SNo=lambda d: d["SNo"] * 3)
    got = clean_bars(to_spark(spark, bars)).toPandas().sort_values(["Symbol", "SNo"])
    assert len(got) == 70 and (got["Close"] > 0).all()
    for _, part in got.groupby("Symbol"):
        assert list(part["SNo"]) == list(range(1, len(part) + 1))
        assert part["Date"].is_monotonic_increasing


def test_csv_and_parquet(spark, tmp_path):
    bars = to_spark(spark, make_bars({"AAA": 20, "BBB": 10}))
    spoilt = bars.withColumn("Volume", F.when(F.col("SNo") == 2, "n/a").otherwise(F.col("Volume").cast("string")))
    write_bars_csv(spoilt, str(tmp_path / "csv"))
    back = read_bars_csv(spark, str(tmp_path / "csv"), symbols=["BBB"])
    assert back.count() == 10 and back.where("Volume IS NULL").count() == 1
    raw = read_raw_csv(spark, str(tmp_path / "csv"))
    assert {r["column"]: r["violations"] for r in unreadable_values(raw).collect()}["Volume"] == 2
    with pytest.raises(FileNotFoundError):
        read_bars_csv(spark, str(tmp_path / "csv"), symbols=["ZZZ"])
    write_features(bars, str(tmp_path / "features"))
    one = read_bars_parquet(spark, str(tmp_path / "features"), symbols=["AAA"])
    assert one.count() == 20
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "symbol_key#" in plan.split("PartitionFilters")[1][:60]
    with pytest.raises(FileNotFoundError):
        read_bars_parquet(spark, str(tmp_path / "features"), symbols=["AAA", "ZZZ"])


def test_symbols_stay_text_in_parquet(spark, tmp_path):
    names = ["007", "10", "2024-01-01", "", "a/b=c", None]
    bars = spark.createDataFrame([(s, float(i)) for i, s in enumerate(names)], "Symbol string, Close double")
    write_features(bars, str(tmp_path / "features"))
    back = read_bars_parquet(spark, str(tmp_path / "features"))
    assert back.columns == bars.columns and dict(back.dtypes) == dict(bars.dtypes)
    assert {(r[0], r[1]) for r in back.collect()} == {(r[0], r[1]) for r in bars.collect()}
    one = read_bars_parquet(spark, str(tmp_path / "features"), symbols=["007", ""])
    assert {r[0] for r in one.collect()} == {"007", ""}


def test_of_rows_equal_in_some_columns_the_first_stays(spark):
    bars = make_bars({"AAA": 6})
    again = bars.assign(SNo=bars["SNo"] + 100, Open=1.0)
    got = clean_bars(to_spark(spark, pd.concat([again, bars])), subset=["Symbol", "Date"]).toPandas()
    assert len(got) == 6 and sorted(got["Open"]) == sorted(bars["Open"].abs())
