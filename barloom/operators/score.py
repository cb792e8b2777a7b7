"""Scoring of bars whose close is not known yet."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import config
from barloom.operators.features import add_features
from barloom.operators.persist import SavedModel
from barloom.operators.repair import clip, drop_infinities, zero
from barloom.operators.series import (
    BLOCK_ROWS, KEYS, POS, SERIES, in_blocks, known_values, number_rows, series_key,
)
from barloom.operators.train import predict
from barloom.schema import REQUESTS, nan_to_null, parse_date
from barloom.session import stored

MAX_NAME = 50
MAX_SYMBOL = 10


def request_errors() -> Column:
    """The names of the rules a request breaks; a missing value breaks its rule."""
    def breaks(name: str, rule: Column) -> Column:
        return F.when(F.coalesce(rule, F.lit(False)), F.lit(None).cast("string")).otherwise(name)

    high, low, open_ = F.col("High"), F.col("Low"), F.col("Open")
    date = F.col("Date")
    return F.array_compact(F.array(
        breaks("SNo", F.col("SNo") >= 1),
        breaks("Name", F.char_length("Name").between(1, MAX_NAME)),
        breaks("Symbol", F.char_length("Symbol").between(1, MAX_SYMBOL)),
        breaks("Date", date.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & parse_date(date).isNotNull()),
        breaks("High", high > 0),
        breaks("Low", low > 0),
        breaks("Open", open_ > 0),
        breaks("Volume", F.col("Volume") >= 0),
        breaks("Marketcap", F.col("Marketcap") >= 0),
        breaks("High<Low", ~(high < low)),
        breaks("High<Open", ~(high < open_)),
        breaks("Low>Open", ~(low > open_)),
    ))


def check_requests(requests: DataFrame) -> DataFrame:
    """Requests with ``errors``: empty for those that can be scored."""
    return nan_to_null(requests).withColumn("errors", request_errors())


# A request's windows reach back so far; the row before them stands for all earlier rows.
REACH = max(*config.ROLLING_WINDOWS, *config.TREND_WINDOWS, config.BOLLINGER_WINDOW, config.RSI_WINDOW) + 2
# Means over the whole history: at a row without a close they keep their last value.
MEANS = [*(f"EMA_{n}" for n in config.TREND_WINDOWS), "MACD"]
SIGNAL = ["MACD_Signal", "MACD_Histogram"]


def history_state(saved: SavedModel, history: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """What scoring needs of a history with positions, a stored row for each of its rows.

    The bars themselves; ``_known_<c>``: their last known values so far; all features,
    clipped; and ``_macd``, ``_signal``: two unclipped ones.
    """
    bars = [f.name for f in REQUESTS if f.name not in ("Name", "Symbol", "Date")] + ["Close"]
    so_far = Window.partitionBy(*KEYS).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    table = stored(drop_infinities(add_features(history, block_rows=block_rows)), "history-features")
    known = in_blocks(table, block_rows).join(known_values(table, bars, block_rows), KEYS).select(
        SERIES, POS, *[F.col(c).alias(f"_bar_{c}") for c in bars], *[F.coalesce(
            F.last(c, ignorenulls=True).over(so_far), F.col(f"_before_{c}")).alias(f"_known_{c}") for c in bars],
        F.col("MACD").alias("_macd"), F.col("MACD_Signal").alias("_signal"))
    return stored(clip(table, saved.bounds, block_rows).join(known, [SERIES, POS]), "history-state")


def with_last_known(asked: DataFrame, state: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``asked(_request, Symbol, Date)`` with the last known value of each column of ``state``
    dated before, and ``_p``, the position of the last row dated before.

    Requests take places in the numbered history, before rows of their own date; they hold
    no values, so they don't change each other's.
    """
    columns = [c for c in state.columns if c not in (SERIES, POS, "Symbol", "Date")]
    rows = state.select("Symbol", "Date", *columns, F.col(POS).alias("_p"), F.lit(None).cast("long").alias("_request"),
                        F.lit(1).alias("_order"))
    places = asked.select("Symbol", "Date", *[F.lit(None).cast(state.schema[c].dataType).alias(c) for c in columns],
                          F.lit(None).cast("long").alias("_p"), "_request", F.lit(0).alias("_order"))
    numbered = stored(number_rows(rows.unionByName(places), order=("Date", "_order", "_p")), "asked-places")
    filled = [*columns, "_p"]
    so_far = Window.partitionBy(*KEYS).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    return (in_blocks(numbered, block_rows).join(known_values(numbered, filled, block_rows), KEYS)
            .select("_request", SERIES, *[F.coalesce(F.last(c, ignorenulls=True).over(so_far),
                                                     F.col(f"_before_{c}")).alias(c) for c in filled])
            .where(F.col("_request").isNotNull()))


def request_features(
    saved: SavedModel, history: DataFrame, requests: DataFrame, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The repaired features of every request, each by itself.

    ``requests`` are acceptable ones with a distinct ``_request`` number and read dates.
    A request is the row after all rows of its symbol that are dated before it. Its windows
    see copies of the last ``REACH`` of them, the first of these with all earlier known
    values; what a window can't tell is the history's last known value, or 0.
    """
    names = [f.name for f in REQUESTS]
    asked = requests.withColumn(SERIES, series_key())
    wanted = asked.select(SERIES).distinct()
    past = history.join(wanted, SERIES, "left_semi").select(*names, "Close", SERIES, POS)
    state = history_state(saved, past, block_rows)
    last = stored(with_last_known(asked, state, block_rows), "last-known")

    bars = [n for n in [*names, "Close"] if n not in ("Name", "Symbol", "Date")]
    start = F.greatest(F.col("_p") - REACH, F.lit(1).cast("long"))
    copies = (last.where(F.col("_p").isNotNull())
              .select("_request", SERIES, start.alias("_start"), F.explode(F.sequence(start, F.col("_p"))).alias(POS))
              .join(state.select(SERIES, POS, "Name", "Symbol", "Date",
                                 *[f"_{k}_{c}" for k in ("bar", "known") for c in bars]), [SERIES, POS]))
    first = F.col(POS) == F.col("_start")
    copies = copies.select(
        "_request", "Name", "Symbol", "Date", (F.col(POS) - F.col("_start") + 1).alias(POS),
        *[F.when(first, F.col(f"_known_{c}")).otherwise(F.col(f"_bar_{c}")).alias(c) for c in bars])
    rest = asked.join(last.select("_request", "_p"), "_request").select(
        "_request", "Name", "Symbol", "Date",
        F.coalesce(F.col("_p") - start + 2, F.lit(1)).cast("long").alias(POS),
        *[(F.col(c) if c != "Close" else F.lit(None).cast("double")).alias(c) for c in bars])
    small = copies.unionByName(rest).withColumn(SERIES, F.col("_request").cast("string"))
    made = drop_infinities(add_features(small, block_rows=block_rows))
    made = made.withColumn("_request", F.col(SERIES).cast("long"))
    ends = stored(made.join(rest.select("_request", POS), ["_request", POS], "left_semi").drop(SERIES, POS), "asked")

    # The signal takes one more value of a MACD that stays what it was.
    opened = past.where("Close IS NOT NULL").groupBy(SERIES).agg(F.min(POS).alias("_open"))
    known = last.join(opened, SERIES, "left")
    q = 1.0 - 2.0 / (config.MACD_SIGNAL_SPAN + 1.0)
    weight = (1.0 - F.pow(F.lit(q), (F.col("_p") - F.col("_open") + 1).cast("double"))) / (1.0 - q) * q
    signal = (weight * F.col("_signal") + F.col("_macd")) / (weight + 1.0)
    columns = [c for c in ends.columns if not c.startswith("_")]
    known = known.select(
        "_request", SERIES, F.coalesce("_p", F.lit(0).cast("long")).alias("_p"), signal.alias("_next_signal"), "_macd",
        *[F.col(c).alias(f"_last_{c}") for c in columns if c in state.columns and c not in ("Name", "Symbol", "Date")])
    rows = ends.join(known, "_request").withColumn(POS, F.col("_p") + 1).withColumns(
        {c: F.lit(None).cast("double") for c in MEANS}
        | {"MACD_Signal": F.col("_next_signal"), "MACD_Histogram": F.col("_macd") - F.col("_next_signal")})
    clipped = clip(stored(rows, "asked-rows"), saved.bounds, block_rows)
    types = {f.name: f.dataType for f in clipped.schema}
    return clipped.select("_request", SERIES, POS, *[
        F.coalesce(c, *([f"_last_{c}"] if f"_last_{c}" in types else []), *zero(types[c])).alias(c) for c in columns])


def score(
    saved: SavedModel,
    history: DataFrame,
    requests: DataFrame,
    version: str | None = None,
    block_rows: int = BLOCK_ROWS,
    at: Column | None = None,
) -> DataFrame:
    """Predictions for all acceptable requests, in one job; each is what it would be alone.

    ``history`` has positions. A request sees the whole history of its symbol dated before
    it. ``request_id`` is the requests' own column of that name or a number given here;
    ``at`` is the time of the answer (now), ``version`` the saved model's.
    """
    names = [f.name for f in REQUESTS]
    accepted = check_requests(requests).where(F.size("errors") == 0)
    own = "request_id" in requests.columns
    number = F.monotonically_increasing_id()
    accepted = stored(accepted.select(
        number.alias("_request"), (F.col("request_id") if own else number).alias("request_id"), *names), "requests")
    dated = accepted.drop("request_id").withColumn("Date", parse_date(F.col("Date")))
    ready = stored(request_features(saved, history, dated, block_rows), "request-features")
    scored = predict(saved.model, saved.preprocessor.transform(ready)).select("_request", "prediction")
    asked = accepted.select("_request", "request_id", F.struct(*[
        (F.date_format(parse_date(F.col("Date")), "yyyy-MM-dd") if n == "Date" else F.col(n)).alias(n)
        for n in names]).alias("input_data"))
    at = F.localtimestamp() if at is None else at
    return asked.join(scored, "_request").select(
        "request_id",
        F.col("prediction").alias("predicted_price"),
        F.lit(config.CONFIDENCE).alias("confidence_score"),
        F.lit(version or saved.version).alias("model_version"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("prediction_timestamp"),
        "input_data",
    )
