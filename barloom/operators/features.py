"""The feature families of a bar table.

Each family is a handful of columns over the last rows of its series. All
windows share one partitioning (series, block), so one exchange serves them all.
Features that need other features (returns, MACD signal) are computed in later
steps over the same partitioning.
"""

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import config
from barloom.functions import rolling as r
from barloom.functions.ewm import LOOKBACK, Ewm, stale_means
from barloom.functions.numeric import finite, safe_div
from barloom.functions.rolling import Rolling
from barloom.operators.series import (
    BLOCK_ROWS, KEYS, block_window, carried_values, in_blocks_with_halo, without_halo,
)
from barloom.schema import parse_date

FAMILIES = ("price", "volume", "marketcap", "calendar", "technical", "statistical")

CALENDAR = ["Year", "Month", "Day", "DayOfWeek", "Quarter", "Month_Sin", "Month_Cos",
            "DayOfWeek_Sin", "DayOfWeek_Cos", "DayOfYear_Sin", "DayOfYear_Cos"]

PAD = "_pad_"


def usable_families(columns: Iterable[str], families: Sequence[str] = FAMILIES) -> list[str]:
    """The families whose source columns are all there, in feature order."""
    have = set(columns)
    needs = {
        "price": {"Open"}, "volume": {"Volume"}, "marketcap": {"Marketcap"},
        "calendar": {"Date"}, "technical": {"Close"}, "statistical": {"Close"},
    }
    unknown = set(families) - set(FAMILIES)
    if unknown:
        raise ValueError(f"unknown feature families: {sorted(unknown)}")
    return [f for f in FAMILIES if f in families and needs[f] <= have]


def feature_names(
    columns: Iterable[str],
    windows: Sequence[int] = config.ROLLING_WINDOWS,
    families: Sequence[str] = FAMILIES,
) -> list[str]:
    """Names of the features added for a table with these columns."""
    columns = list(columns)
    use = usable_families(columns, families)
    names: list[str] = []
    if "price" in use:
        if {"High", "Low"} <= set(columns):
            names += ["High_Low_Spread", "High_Low_Ratio", "Price_Range",
                      "Open_Change", "High_Change", "Low_Change"]
        for n in windows:
            names += [f"Open_{s}_{n}" for s in ("MA", "Std", "Min", "Max", "MA_Ratio")]
    if "volume" in use:
        names += ["Volume_Change", "Volume_Ratio"]
        for n in windows:
            names += [f"Volume_{s}_{n}" for s in ("MA", "Std", "Min", "Max")]
    if "marketcap" in use:
        names += ["Marketcap_Change"]
        for n in windows:
            names += [f"Marketcap_{s}_{n}" for s in ("MA", "Std")]
    if "calendar" in use:
        names += CALENDAR
    if "technical" in use:
        names += [f"SMA_{n}" for n in config.TREND_WINDOWS]
        names += [f"EMA_{n}" for n in config.TREND_WINDOWS]
        names += ["RSI_14", "MACD", "MACD_Signal", "MACD_Histogram",
                  "BB_Upper", "BB_Middle", "BB_Lower", "BB_Width", "BB_Position"]
    if "statistical" in use:
        for n in windows:
            names += [f"Volatility_{n}", f"Skewness_{n}", f"Kurtosis_{n}"]
        names += [f"Momentum_{n}" for n in config.TREND_WINDOWS]
    return names


def _calendar() -> dict[str, Column]:
    date = F.col("Date")

    def cycle(value: Column, period: float) -> Column:
        return value * (2 * math.pi) / period

    month, weekday, yearday = F.month(date), F.weekday(date), F.dayofyear(date)
    return {
        "Year": F.year(date),
        "Month": month,
        "Day": F.dayofmonth(date),
        "DayOfWeek": weekday,
        "Quarter": F.quarter(date),
        "Month_Sin": F.sin(cycle(month, 12)),
        "Month_Cos": F.cos(cycle(month, 12)),
        "DayOfWeek_Sin": F.sin(cycle(weekday, 7)),
        "DayOfWeek_Cos": F.cos(cycle(weekday, 7)),
        "DayOfYear_Sin": F.sin(cycle(yearday, config.DAYS_PER_YEAR)),
        "DayOfYear_Cos": F.cos(cycle(yearday, config.DAYS_PER_YEAR)),
    }


def _rollings(use: Sequence[str], windows: tuple[int, ...]) -> dict[str, Rolling]:
    """The rolling statistics the families need, by source column."""
    out: dict[str, Rolling] = {}
    if "price" in use:
        out["Open"] = Rolling("Open", windows, order=2, extremes=True)
    if "volume" in use:
        volume = tuple(sorted({*windows, config.VOLUME_RATIO_WINDOW}))
        out["Volume"] = Rolling("Volume", volume, order=2, extremes=True)
    if "marketcap" in use:
        out["Marketcap"] = Rolling("Marketcap", windows, order=2)
    if "technical" in use:
        close = tuple(sorted({*config.TREND_WINDOWS, config.BOLLINGER_WINDOW}))
        out["Close"] = Rolling("Close", close, order=2)
        out["_gain"] = Rolling("_gain", (config.RSI_WINDOW,))
        out["_loss"] = Rolling("_loss", (config.RSI_WINDOW,))
    if "statistical" in use:
        out["_return"] = Rolling("_return", windows, order=4)
    return out


def _price(have: set[str], windows: Sequence[int], x: Rolling) -> dict[str, Column]:
    out: dict[str, Column] = {}
    if {"High", "Low"} <= have:
        high, low = F.col("High"), F.col("Low")
        out["High_Low_Spread"] = high - low
        out["High_Low_Ratio"] = safe_div(high, low)
        out["Price_Range"] = safe_div(high - low, F.col("Open"))
    for n in windows:
        out[f"Open_MA_{n}"] = r.mean(x, n)
        out[f"Open_Std_{n}"] = r.sd(x, n)
        out[f"Open_Min_{n}"] = r.minimum(x, n)
        out[f"Open_Max_{n}"] = r.maximum(x, n)
        out[f"Open_MA_Ratio_{n}"] = safe_div(F.col("Open"), r.mean(x, n))
    return out


def _volume(windows: Sequence[int], x: Rolling) -> dict[str, Column]:
    out = {"Volume_Ratio": safe_div(F.col("Volume"), r.mean(x, config.VOLUME_RATIO_WINDOW))}
    for n in windows:
        out[f"Volume_MA_{n}"] = r.mean(x, n)
        out[f"Volume_Std_{n}"] = r.sd(x, n)
        out[f"Volume_Min_{n}"] = r.minimum(x, n)
        out[f"Volume_Max_{n}"] = r.maximum(x, n)
    return out


def _marketcap(windows: Sequence[int], x: Rolling) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for n in windows:
        out[f"Marketcap_MA_{n}"] = r.mean(x, n)
        out[f"Marketcap_Std_{n}"] = r.sd(x, n)
    return out


def _technical(x: Rolling, gains: Rolling, losses: Rolling) -> dict[str, Column]:
    out = {f"SMA_{n}": r.mean(x, n) for n in config.TREND_WINDOWS}
    out |= {f"EMA_{n}": F.col(f"ewm{n}") for n in config.TREND_WINDOWS}
    n = config.RSI_WINDOW
    gain, loss = r.mean(gains, n), r.mean(losses, n)
    # No loss at all is the top of the scale; neither gain nor loss is undefined.
    strength = 100 - safe_div(F.lit(100.0), safe_div(gain, loss) + 1)
    out["RSI_14"] = F.when((loss == 0) & (gain > 0), 100.0).otherwise(strength)
    out["MACD_Histogram"] = F.col("MACD") - F.col("MACD_Signal")
    middle = r.mean(x, config.BOLLINGER_WINDOW)
    reach = r.sd(x, config.BOLLINGER_WINDOW) * config.BOLLINGER_SDS
    lower, width = middle - reach, (middle + reach) - (middle - reach)
    out["BB_Upper"] = middle + reach
    out["BB_Middle"] = middle
    out["BB_Lower"] = lower
    out["BB_Width"] = width
    out["BB_Position"] = safe_div(F.col("Close") - lower, width)
    return out


def _statistical(windows: Sequence[int], x: Rolling) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for n in windows:
        out[f"Volatility_{n}"] = r.sd(x, n)
        out[f"Skewness_{n}"] = r.skew(x, n)
        out[f"Kurtosis_{n}"] = r.kurt(x, n)
    for n in config.TREND_WINDOWS:
        out[f"Momentum_{n}"] = r.change(F.col("Close"), F.col(f"_close_{n}"))
    return out


def _trend_means() -> list[Ewm]:
    spans = sorted({*config.TREND_WINDOWS, *config.MACD_SPANS})
    return [Ewm(f"ewm{s}", "Close", s) for s in spans]


def _add_means(df: DataFrame, block_rows: int) -> DataFrame:
    """Weighted means of Close, then of their difference (MACD)."""
    w = block_window().rowsBetween(Window.unboundedPreceding, 0)
    means = _trend_means()
    df = df.withColumns({k: v for e in means for k, v in e.sums().items()})
    df = df.withColumns({f"_raw_{e.name}": e.mean(block_rows) for e in means})
    df = df.withColumns({
        e.name: F.coalesce(
            F.last(f"_raw_{e.name}", ignorenulls=True).over(w), F.col(f"_stale_{e.name}")
        )
        for e in means
    })
    fast, slow = config.MACD_SPANS
    df = df.withColumn("MACD", F.col(f"ewm{fast}") - F.col(f"ewm{slow}"))
    signal = Ewm("signal", "MACD", config.MACD_SIGNAL_SPAN)
    return df.withColumns(signal.sums()).withColumn("MACD_Signal", signal.mean(block_rows))


def _changes(use: Sequence[str], columns: set[str]) -> dict[str, str]:
    """Source column -> name of its row-to-row change."""
    out: dict[str, str] = {}
    if "price" in use and {"High", "Low"} <= columns:
        out |= {c: f"{c}_Change" for c in ("Open", "High", "Low")}
    if "volume" in use:
        out["Volume"] = "Volume_Change"
    if "marketcap" in use:
        out["Marketcap"] = "Marketcap_Change"
    if "statistical" in use:
        out["Close"] = "_return"
    return out


def add_features(
    bars: DataFrame,
    windows: Sequence[int] = config.ROLLING_WINDOWS,
    families: Sequence[str] = FAMILIES,
    block_rows: int = BLOCK_ROWS,
    date_formats: tuple[str, ...] = (),
) -> DataFrame:
    """Bars with positions (see ``series``) plus the features of each family.

    A family is left out when its source columns are absent.
    """
    inputs = bars.columns
    columns = set(inputs)
    use = usable_families(inputs, families)
    names = feature_names(inputs, windows, families)
    if "Date" in columns and isinstance(bars.schema["Date"].dataType, T.StringType):
        bars = bars.withColumn("Date", parse_date(F.col("Date"), date_formats))

    windowed = [f for f in use if f != "calendar"]
    if not windowed:
        return bars.withColumns(_calendar()).select(*inputs, *names) if use else bars

    technical = "technical" in use
    # One row more than the longest frame: a return looks one row back.
    lookback = max([*windows, *config.TREND_WINDOWS, config.RSI_WINDOW]) + 1
    lookback = max(LOOKBACK, lookback) if technical else lookback
    df = in_blocks_with_halo(bars, lookback, block_rows)

    changes = _changes(use, columns)
    if changes:
        carried = carried_values(
            bars, {c: F.col(c) for c in changes}, lookback, block_rows
        )
        df = df.join(carried, KEYS, "left")
    if technical:
        df = df.join(stale_means(bars, _trend_means(), block_rows), KEYS, "left")

    # What a row needs of the rows before it: padded values, single lags.
    w = block_window()
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    close = F.col("Close")
    step = {
        f"{PAD}{c}": F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(f"_carry_{c}"))
        for c in changes
    }
    if technical:
        step["_step"] = close - F.lag(close).over(w)
    if "statistical" in use:
        step |= {f"_close_{n}": F.lag(close, n).over(w) for n in config.TREND_WINDOWS}
    if step:
        df = df.withColumns(step)

    step = {
        name: finite(r.change(F.col(f"{PAD}{c}"), F.lag(f"{PAD}{c}").over(w)))
        for c, name in changes.items()
    }
    if technical:
        # The first row and rows next to a missing close have no difference;
        # they count as neither gain nor loss.
        step["_gain"] = F.when(F.col("_step") > 0, F.col("_step")).otherwise(0.0)
        step["_loss"] = F.when(F.col("_step") < 0, -F.col("_step")).otherwise(0.0)
    if step:
        df = df.withColumns(step)

    if technical:
        df = _add_means(df, block_rows)
    rolls = _rollings(use, tuple(windows))
    df = without_halo(r.add_rolling(df, list(rolls.values())))

    made: dict[str, Column] = {}
    if "price" in use:
        made |= _price(columns, windows, rolls["Open"])
    if "volume" in use:
        made |= _volume(windows, rolls["Volume"])
    if "marketcap" in use:
        made |= _marketcap(windows, rolls["Marketcap"])
    if "calendar" in use:
        made |= _calendar()
    if technical:
        made |= _technical(rolls["Close"], rolls["_gain"], rolls["_loss"])
    if "statistical" in use:
        made |= _statistical(windows, rolls["_return"])
    return df.select(*inputs, *[made[c].alias(c) if c in made else F.col(c) for c in names])
