"""Small seeded series, and the pandas form of what is expected of them."""

import numpy as np
import pandas as pd

from barloom.schema import BARS


def make_bars(lengths: dict, seed: int = 7, null_share: float = 0.0, flat: tuple = ()) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    parts = []
    for symbol, n in lengths.items():
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        open_ = close * (1 + rng.normal(0, 0.01, n))
        if symbol in flat:
            close = np.full(n, 50.0)
        part = pd.DataFrame({
            "SNo": np.arange(1, n + 1, dtype="int64"),
            "Name": f"{symbol} coin", "Symbol": symbol,
            "Date": pd.date_range("2015-01-01", periods=n, freq="D"),
            "High": np.maximum(open_, close) * 1.01, "Low": np.minimum(open_, close) * 0.99,
            "Open": open_, "Close": close,
            "Volume": rng.integers(0, 5, n).astype(float),
            "Marketcap": close * 1e6,
        })
        for c in ("Open", "Close", "Volume", "High"):
            part.loc[rng.random(n) < null_share, c] = np.nan
        parts.append(part)
    return pd.concat(parts, ignore_index=True)


def to_spark(spark, pdf: pd.DataFrame, shuffle: bool = True):
    """A Spark table in random row order, dates as text, missing as NULL."""
    if shuffle:
        pdf = pdf.sample(frac=1, random_state=3)
    rows = pdf.assign(Date=pdf["Date"].astype(str)).astype(object)
    rows = rows.where(pdf.notna().values, None)
    return spark.createDataFrame(rows[[f.name for f in BARS]].values.tolist(), BARS)


def rsi(close: pd.Series, n: int) -> pd.Series:
    step = close.diff()
    up = step.clip(lower=0).fillna(0).rolling(n).mean()
    down = (-step).clip(lower=0).fillna(0).rolling(n).mean()
    return 100 - 100 / (1 + up / down)


def pandas_features(bars: pd.DataFrame) -> pd.DataFrame:
    """All features of one series in time order, before repair."""
    out = bars.copy()
    o, h, low, c = (bars[k] for k in ("Open", "High", "Low", "Close"))
    pct = {k: bars[k].pct_change(fill_method="pad") for k in
           ("Open", "High", "Low", "Close", "Volume", "Marketcap")}
    f = {"High_Low_Spread": h - low, "High_Low_Ratio": h / low, "Price_Range": (h - low) / o}
    f |= {f"{k}_Change": pct[k] for k in ("Open", "High", "Low", "Volume", "Marketcap")}
    f["Volume_Ratio"] = bars["Volume"] / bars["Volume"].rolling(5).mean()
    for n in (5, 10, 20):
        ro, rv, rm = (bars[k].rolling(n) for k in ("Open", "Volume", "Marketcap"))
        f |= {f"Open_MA_{n}": ro.mean(), f"Open_Std_{n}": ro.std(), f"Open_Min_{n}": ro.min(),
              f"Open_Max_{n}": ro.max(), f"Open_MA_Ratio_{n}": o / ro.mean()}
        f |= {f"Volume_MA_{n}": rv.mean(), f"Volume_Std_{n}": rv.std(),
              f"Volume_Min_{n}": rv.min(), f"Volume_Max_{n}": rv.max()}
        f |= {f"Marketcap_MA_{n}": rm.mean(), f"Marketcap_Std_{n}": rm.std()}
        rr = pct["Close"].rolling(n)
        f |= {f"Volatility_{n}": rr.std(), f"Skewness_{n}": rr.skew(), f"Kurtosis_{n}": rr.kurt()}
        f |= {f"SMA_{n}": c.rolling(n).mean(), f"EMA_{n}": c.ewm(span=n).mean(),
              f"Momentum_{n}": c / c.shift(n) - 1}
    f["RSI_14"] = rsi(c, 14)
    macd = c.ewm(span=12).mean() - c.ewm(span=26).mean()
    signal = macd.ewm(span=9).mean()
    mid, sd = c.rolling(20).mean(), c.rolling(20).std()
    f |= {"MACD": macd, "MACD_Signal": signal, "MACD_Histogram": macd - signal,
          "BB_Upper": mid + 2 * sd, "BB_Middle": mid, "BB_Lower": mid - 2 * sd,
          "BB_Width": 4 * sd, "BB_Position": (c - (mid - 2 * sd)) / (4 * sd)}
    d = bars["Date"].dt
    f |= {"Year": d.year, "Month": d.month, "Day": d.day, "DayOfWeek": d.dayofweek,
          "Quarter": d.quarter}
    for name, value, period in (("Month", d.month, 12), ("DayOfWeek", d.dayofweek, 7),
                                ("DayOfYear", d.dayofyear, 365.25)):
        f |= {f"{name}_Sin": np.sin(2 * np.pi * value / period),
              f"{name}_Cos": np.cos(2 * np.pi * value / period)}
    out = pd.concat([out, pd.DataFrame(f)], axis=1)
    return out.replace([np.inf, -np.inf], np.nan)
