"""The registered queries in SQL, for comparison on the same tables."""

from barloom.operators.features import FAMILIES, feature_names
from barloom.sources.derived import BAR_COLUMNS

VALUES = ["High", "Low", "Open", "Close", "Volume", "Marketcap"]
NUMBERS = ["Open", "Close", "Volume"]
WINDOWS = (5, 10, 20)
AS_OF = "TIMESTAMP '2030-01-01'"

_BARS = """bars AS (
  SELECT row_number() OVER (PARTITION BY Symbol ORDER BY Date) AS SNo, Symbol AS Name, Symbol, Date,
         High, Low, Open, Close, Volume, Close * 1e6::DOUBLE AS Marketcap
  FROM base)"""

EVENTS = """base AS (
  SELECT event_type AS Symbol, date_trunc('hour', ts)::TIMESTAMP AS Date, max(value) AS High, min(value) AS Low,
         first(value ORDER BY ts, event_id) AS Open, last(value ORDER BY ts, event_id) AS Close,
         sum(user_id)::DOUBLE AS Volume
  FROM events GROUP BY 1, 2), """ + _BARS

ORDERS = """lines AS (
  SELECT 'S' || l_suppkey AS Symbol, date_trunc('day', l_shipdate)::TIMESTAMP AS Date,
         floor(l_extendedprice / l_quantity * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS price, l_quantity, l_orderkey, l_linenumber
  FROM lineitem),
base AS (
  SELECT Symbol, Date, max(price) AS High, min(price) AS Low,
         first(price ORDER BY l_orderkey, l_linenumber, price) AS Open,
         last(price ORDER BY l_orderkey, l_linenumber, price) AS Close,
         sum(l_quantity) AS Volume
  FROM lines GROUP BY 1, 2), """ + _BARS

_SPIKE = "CASE WHEN SNo % 71 = 0 THEN 1e6::DOUBLE ELSE 1.0::DOUBLE END"
DIRTY = EVENTS + f""",
dirty AS (
  SELECT CASE WHEN SNo % 67 = 0 THEN SNo + 1 WHEN SNo % 67 = 1 AND SNo > 1 THEN SNo - 1 ELSE SNo END AS SNo,
         Name, Symbol,
         CASE WHEN SNo % 103 = 0 THEN 'bad' ELSE strftime(
           CASE WHEN SNo > 300 THEN Date + INTERVAL 40 DAY ELSE Date END, '%Y-%m-%d %H:%M:%S') END AS Date,
         CASE WHEN SNo % 83 = 0 THEN Low ELSE High END * {_SPIKE} AS High,
         CASE WHEN SNo % 83 = 0 THEN High ELSE Low END * {_SPIKE} AS Low,
         CASE WHEN SNo % 79 <> 0 THEN Open * {_SPIKE} END AS Open,
         CASE WHEN SNo % 97 = 0 THEN -Close ELSE Close END * {_SPIKE} AS Close,
         CASE WHEN SNo % 101 <> 0 THEN Volume END AS Volume, Marketcap
  FROM bars, LATERAL (SELECT unnest(CASE WHEN SNo % 89 = 0 THEN [1, 2] ELSE [1] END)))"""

CLEAN = DIRTY + """,
fixed AS (
  SELECT DISTINCT * REPLACE (try_cast(Date AS TIMESTAMP) AS Date) FROM dirty
  WHERE try_cast(Date AS TIMESTAMP) IS NOT NULL),
clean AS (
  SELECT row_number() OVER (PARTITION BY Symbol ORDER BY Date, SNo) AS SNo, Name, Symbol, Date,
         abs(High) AS High, abs(Low) AS Low, abs(Open) AS Open, abs(Close) AS Close,
         abs(Volume) AS Volume, Marketcap
  FROM fixed)"""

S = "PARTITION BY Symbol ORDER BY SNo"


def rnd(x: str, digits: int = 6) -> str:
    """Rounded, with ties moved up a little: results that differ in the last bit
    must not fall on two sides of a tie."""
    return f"round({x} + {10.0 ** -(digits + 3)!r}::DOUBLE, {digits})"



def frame(n: int) -> str:
    return f"OVER ({S} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(x: str, n: int, value: str) -> str:
    return f"CASE WHEN count({x}) {frame(n)} = {n} THEN {value} END"


def roll(f: str, x: str, n: int) -> str:
    return full(x, n, f"{f}({x}) {frame(n)}")


def ewm(x: str, span: int) -> str:
    q = f"{1 - 2 / (span + 1)!r}::DOUBLE"
    so_far = f"OVER ({S} ROWS UNBOUNDED PRECEDING)"
    return (f"sum({x} * pow({q}, -SNo)) {so_far} / "
            f"sum(CASE WHEN {x} IS NOT NULL THEN pow({q}, -SNo) END) {so_far}")


def moment(f: str, flat: str, n: int) -> str:
    return full("ret", n, f"CASE WHEN max(ret) {frame(n)} = min(ret) {frame(n)} THEN {flat} "
                          f"WHEN var_pop(ret) {frame(n)} > 1e-14 THEN {f}(ret) {frame(n)} END")


def feature_ctes(source: str) -> str:
    """CTEs f1..f4 over ``source``; f4 has all feature columns."""
    pads = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER ({S} ROWS UNBOUNDED PRECEDING) AS pad_{c}" for c in VALUES
    )
    ewms = ", ".join(f"{ewm('Close', s)} AS ewm{s}" for s in (5, 10, 12, 20, 26))
    change = ", ".join(
        f"pad_{c} / NULLIF(lag(pad_{c}) OVER ({S}), 0) - 1 AS {'ret' if c == 'Close' else c + '_Change'}"
        for c in VALUES
    )
    out = ["High - Low AS High_Low_Spread", "High / NULLIF(Low, 0) AS High_Low_Ratio",
           "(High - Low) / NULLIF(Open, 0) AS Price_Range",
           f"Volume / NULLIF({roll('avg', 'Volume', 5)}, 0) AS Volume_Ratio"]
    for n in WINDOWS:
        for c in ("Open", "Volume"):
            out += [f"{roll(f, c, n)} AS {c}_{s}_{n}" for f, s in
                    (("avg", "MA"), ("stddev_samp", "Std"), ("min", "Min"), ("max", "Max"))]
        out.append(f"Open / NULLIF({roll('avg', 'Open', n)}, 0) AS Open_MA_Ratio_{n}")
        out += [f"{roll(f, 'Marketcap', n)} AS Marketcap_{s}_{n}"
                for f, s in (("avg", "MA"), ("stddev_samp", "Std"))]
        out.append(f"{roll('avg', 'Close', n)} AS SMA_{n}")
        out.append(f"ewm{n} AS EMA_{n}")
        out.append(f"{roll('stddev_samp', 'ret', n)} AS Volatility_{n}")
        out.append(f"{moment('skewness', '0.0', n)} AS Skewness_{n}")
        out.append(f"{moment('kurtosis', '-3.0', n)} AS Kurtosis_{n}")
        out.append(f"Close / NULLIF(lag(Close, {n}) OVER ({S}), 0) - 1 AS Momentum_{n}")
    gain, loss = roll("avg", "gain", 14), roll("avg", "loss", 14)
    out.append(f"CASE WHEN {loss} = 0 AND {gain} > 0 THEN 100.0 "
               f"ELSE 100 - 100 / (1 + {gain} / NULLIF({loss}, 0)) END AS RSI_14")
    out += ["ewm12 - ewm26 AS MACD", f"{roll('avg', 'Close', 20)} AS BB_Middle",
            f"{roll('stddev_samp', 'Close', 20)} AS sd20"]
    d = "Date"
    out += [f"year({d}) AS Year", f"month({d}) AS Month", f"day({d}) AS Day",
            f"isodow({d}) - 1 AS DayOfWeek", f"quarter({d}) AS Quarter"]
    for name, v, period in (("Month", f"month({d})", "12"), ("DayOfWeek", f"(isodow({d}) - 1)", "7"),
                            ("DayOfYear", f"dayofyear({d})", "365.25")):
        out += [f"sin(2 * pi() * {v} / {period}::DOUBLE) AS {name}_Sin",
                f"cos(2 * pi() * {v} / {period}::DOUBLE) AS {name}_Cos"]
    return f"""
f1 AS (SELECT *, {pads}, {ewms}, Close - lag(Close) OVER ({S}) AS step FROM {source}),
f2 AS (SELECT *, {change}, CASE WHEN step > 0 THEN step ELSE 0 END AS gain,
       CASE WHEN step < 0 THEN -step ELSE 0 END AS loss FROM f1),
f3 AS (SELECT *, {', '.join(out)} FROM f2),
f4 AS (SELECT *, {ewm('MACD', 9)} AS MACD_Signal, MACD - {ewm('MACD', 9)} AS MACD_Histogram,
       BB_Middle + 2 * sd20 AS BB_Upper, BB_Middle - 2 * sd20 AS BB_Lower, 4 * sd20 AS BB_Width,
       (Close - (BB_Middle - 2 * sd20)) / NULLIF(4 * sd20, 0) AS BB_Position FROM f3)"""


INTEGERS = {"Year", "Month", "Day", "DayOfWeek", "Quarter"}


def rounded(names, digits: int = 6, large=(), as_is=()) -> str:
    out = []
    for c in names:
        if c in as_is:
            out.append(c)
        else:
            wide = c in large or c.startswith(("Marketcap", "Volume_M", "Volume_S"))
            out.append(f"{rnd(c, 2 if wide else digits)} AS {c}")
    return ", ".join(out)


def features(names, source: str = EVENTS, table: str = "bars", digits: int = 6) -> str:
    return (f"WITH {source}, {feature_ctes(table)} "
            f"SELECT Symbol, SNo, {rounded(names, digits, as_is=INTEGERS)} FROM f4")


def bounds_cte(columns, table: str, extra: str = "") -> str:
    q = ", ".join(f"quantile_cont({c}, 0.01) AS q1_{c}, quantile_cont({c}, 0.99) AS q3_{c}" for c in columns)
    b = ", ".join(f"q1_{c} - 1.5 * (q3_{c} - q1_{c}) AS {c}_low, q3_{c} + 1.5 * (q3_{c} - q1_{c}) AS {c}_high"
                  for c in columns)
    return (f"quants AS (SELECT Symbol, {q} FROM {table} {extra} GROUP BY Symbol), "
            f"bounds AS (SELECT Symbol, {b} FROM quants)")


def clipped_cte(columns, table: str, keep) -> str:
    c = ", ".join(f"CASE WHEN t.{c} < {c}_low THEN {c}_low WHEN t.{c} > {c}_high THEN {c}_high ELSE t.{c} END AS {c}"
                  for c in columns)
    k = ", ".join(f"t.{x}" for x in keep)
    return f"clipped AS (SELECT {k}, {c} FROM {table} t JOIN bounds b ON t.Symbol = b.Symbol)"


def filled(columns, order: str) -> list[str]:
    w = f"PARTITION BY Symbol ORDER BY {order}"
    return [f"coalesce(last_value({c} IGNORE NULLS) OVER ({w} ROWS UNBOUNDED PRECEDING), "
            f"first_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0)"
            for c in columns]


def filled_select(columns, order: str, digits) -> str:
    return ", ".join(f"{rnd(e, digits(c))} AS {c}" for c, e in zip(columns, filled(columns, order)))


def split_case(n: str = "n", pos: str = "SNo") -> str:
    return (f"CASE WHEN {pos} <= floor({n} * 0.6::DOUBLE) THEN 'train' "
            f"WHEN {pos} <= floor({n} * {0.6 + 0.2!r}::DOUBLE) THEN 'validation' ELSE 'test' END")


def split_cte(table: str) -> str:
    return (f"counted AS (SELECT *, count(*) OVER (PARTITION BY Symbol) AS n FROM {table}), "
            f"split AS (SELECT *, {split_case()} AS split FROM counted)")


def quality(source: str, table: str, as_of: str) -> str:
    """CTEs ending in ``report``. ``source`` defines ``table``."""
    aggs = ["count(*) AS n"]
    cells = []

    def cell(check, item, violations, gate="true"):
        cells.append(f"('{check}', '{item}', ({violations})::BIGINT, ({gate}))")

    cell("required_columns", "all", "0")
    cell("data_presence", "rows", "CASE WHEN n < 10 THEN 1 ELSE 0 END")
    cell("data_types", "all", "wrong_types")
    cell("duplicates", "rows", "repeated")
    for c in ("Date", "High", "Low", "Open", "Close"):
        aggs.append(f"count(*) FILTER ({c} IS NULL) AS missing_{c}")
        cell("missing_values", c, f"missing_{c}")
    for c in ("High", "Low", "Open", "Close"):
        for item, rule in (("negative", "< 0"), ("above", "> 100000"), ("below", "< 0.01")):
            aggs.append(f"count(*) FILTER ({c} {rule}) AS {c}_{item}")
            cell("price_data", f"{c}:{item}", f"{c}_{item}")
    aggs += ["count(*) FILTER (Volume < 0) AS vol_neg", "count(*) FILTER (Volume > 1e12) AS vol_high"]
    cell("volume_data", "negative", "vol_neg")
    cell("volume_data", "above", "vol_high", "vol_neg = 0")
    cell("volume_consistency", "negative", "vol_neg")
    aggs += ["count(*) FILTER (parsed IS NULL) AS bad", f"count(*) FILTER (parsed > {as_of}) AS future",
             "count(*) FILTER (parsed < TIMESTAMP '2010-01-01') AS old"]
    cell("date_data", "invalid", "bad")
    cell("date_data", "future", "future", "bad = 0")
    cell("date_data", "before_2010", "old", "bad = 0 AND future = 0")
    for a, op, b in (("High", "<", "Low"), ("High", "<", "Open"), ("High", "<", "Close"),
                     ("Low", ">", "Open"), ("Low", ">", "Close")):
        name = f"{a}_{'lt' if op == '<' else 'gt'}_{b}"
        aggs.append(f"count(*) FILTER ({a} {op} {b}) AS {name}")
        cell("price_consistency", f"{a}{op}{b}", name)
    cell("temporal_consistency", "inversions", "inversions", "bad = 0")
    cell("temporal_consistency", "gaps", "gaps", "bad = 0 AND inversions = 0")
    cell("temporal_consistency", "unreadable", "bad")
    return f"""{source},
parsed AS (SELECT *, try_cast(Date AS TIMESTAMP) AS parsed FROM {table}),
sums AS (SELECT Symbol, {', '.join(aggs)} FROM parsed GROUP BY Symbol),
uniq AS (SELECT DISTINCT * FROM parsed),
pairs AS (SELECT Symbol, parsed, lag(parsed) OVER (PARTITION BY Symbol ORDER BY SNo, parsed NULLS FIRST) AS before FROM uniq),
ordered AS (SELECT Symbol, count(*) FILTER (parsed < before) AS inversions,
  count(*) FILTER (parsed - before > INTERVAL 30 DAY) AS gaps FROM pairs GROUP BY Symbol),
dups AS (SELECT p.Symbol, p.n - u.n AS repeated FROM (SELECT Symbol, count(*) AS n FROM parsed GROUP BY 1) p
  JOIN (SELECT Symbol, count(*) AS n FROM uniq GROUP BY 1) u ON p.Symbol = u.Symbol),
wide AS (SELECT *, (SELECT CASE WHEN any_value(typeof(Date)) = 'VARCHAR' THEN 0 ELSE 1 END FROM parsed) AS wrong_types
  FROM sums JOIN ordered USING (Symbol) JOIN dups USING (Symbol)),
report AS (SELECT Symbol, t."check", t.item, t.violations,
  CASE WHEN NOT t.evaluated THEN 'skipped' WHEN t.violations = 0 THEN 'pass' ELSE 'fail' END AS status
  FROM wide, LATERAL (VALUES {', '.join(cells)}) t("check", item, violations, evaluated))"""


CHECKS = ["required_columns", "data_presence", "data_types", "missing_values", "duplicates",
          "price_data", "volume_data", "date_data", "temporal_consistency",
          "price_consistency", "volume_consistency"]


def metric_select(by: str) -> str:
    values = {
        "mae": "avg(abs(e))", "mse": "avg(e * e)", "rmse": "sqrt(avg(e * e))",
        "r2": "1 - sum(e * e) / NULLIF(var_pop(Close) * count(*), 0)",
        "mape": "avg(abs(e / NULLIF(Close, 0))) * 100",
    }
    shown = ", ".join(f"{rnd(v, 2 if n == 'mse' else 6)} AS {n}" for n, v in values.items())
    return (f"SELECT {by}, count(*) AS rows, {shown}, count(*) FILTER (Close = 0) AS zero_actuals "
            f"FROM (SELECT *, Close - SMA_5 AS e FROM split WHERE SMA_5 IS NOT NULL) GROUP BY {by}")


def mean_model_ctes() -> str:
    """``told``: all bars with the mean of the training part; ``cv``: a row of scores per fold of that part."""
    return f"""{EVENTS}, {split_cte('bars')},
told AS (SELECT *, Close - prediction AS e FROM (
  SELECT split.*, (SELECT avg(Close) FROM split WHERE split = 'train') AS prediction FROM split)),
held AS (SELECT Symbol, SNo, Close, count(*) OVER (PARTITION BY Symbol) AS m FROM split WHERE split = 'train'),
folds AS (SELECT held.*, fold, m - (m // 6) * (5 - fold) AS cut, m // 6 AS t FROM held, range(5) r(fold)),
means AS (SELECT fold, avg(Close) AS p FROM folds WHERE SNo <= cut GROUP BY fold),
missed AS (SELECT fold, Close, Close - p AS e FROM folds JOIN means USING (fold) WHERE SNo > cut AND SNo <= cut + t),
cv AS (SELECT fold::INTEGER AS fold, avg(e * e) AS mse, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae,
  1 - sum(e * e) / NULLIF(var_pop(Close) * count(*), 0) AS r2 FROM missed GROUP BY fold)"""


def training_runs_sql() -> str:
    cells = [f"SELECT 'param' AS kind, '{k}' AS name, {v}.0::DOUBLE AS value" for k, v in (
        ("numTrees", 1), ("maxDepth", 0), ("bootstrap", 0))]
    cells += [f"SELECT 'importance', '{c}', 0.0::DOUBLE" for c in ("High", "Low", "Open", "Volume")]
    cells += [f"SELECT 'cv', '{m}_{name}', {f}({m}) FROM cv" for m in ("mse", "rmse", "mae", "r2")
              for name, f in (("mean", "avg"), ("std", "stddev_pop"))]
    cells += [f"SELECT split, '{name}', {v} FROM told GROUP BY split" for name, v in (
        ("mae", "avg(abs(e))"), ("mse", "avg(e * e)"), ("rmse", "sqrt(avg(e * e))"),
        ("r2", "1 - sum(e * e) / NULLIF(var_pop(Close) * count(*), 0)"),
        ("mape", "avg(abs(e / NULLIF(Close, 0))) * 100"))]
    return (f"WITH {mean_model_ctes()}, logged AS ({' UNION ALL '.join(cells)}) "
            f"SELECT 'tried twice' AS run_id, kind, name, {rnd('value', 4)} AS value FROM logged "
            f"UNION ALL SELECT 'other', 'param', 'numTrees', {rnd('7.0::DOUBLE', 4)}")


def statistics_ctes() -> str:
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS med_{c}" for c in NUMBERS)
    stats = ", ".join(f"avg(coalesce({c}, med_{c})) AS mean_{c}, stddev_pop(coalesce({c}, med_{c})) AS sd_{c}"
                      for c in NUMBERS)
    return (f"{split_cte('clean')}, meds AS (SELECT {meds} FROM split WHERE split = 'train'), "
            f"stats AS (SELECT {stats} FROM split, meds WHERE split = 'train')")


def feature_class_case(name: str) -> str:
    # Fixed words; the first class with one of them in the name.
    classes = [("price", "price|high|low|open|close"), ("volume", "volume"), ("marketcap", "marketcap"),
               ("time", "year|month|day|time"), ("technical", "sma|ema|rsi|macd|bb")]
    whens = " ".join(f"WHEN regexp_matches(lower({name}), '{words}') THEN '{label}'" for label, words in classes)
    return f"CASE {whens} ELSE 'statistical' END"


def request_sql() -> str:
    rules = [
        ("SNo", "SNo >= 1"), ("Name", "length(Name) BETWEEN 1 AND 50"),
        ("Symbol", "length(Symbol) BETWEEN 1 AND 10"),
        ("Date", "regexp_matches(Date, '^\\d{4}-\\d{1,2}-\\d{1,2}$') AND try_cast(Date AS TIMESTAMP) IS NOT NULL"),
        ("High", "High > 0"), ("Low", "Low > 0"), ("Open", "Open > 0"), ("Volume", "Volume >= 0"),
        ("Marketcap", "Marketcap >= 0"), ("High<Low", "NOT High < Low"), ("High<Open", "NOT High < Open"),
        ("Low>Open", "NOT Low > Open"),
    ]
    parts = ", ".join(f"CASE WHEN coalesce({rule}, false) THEN NULL ELSE '{n}' END" for n, rule in rules)
    return f"""WITH {EVENTS}, asked AS (
  SELECT CASE WHEN SNo % 41 = 0 THEN 0 ELSE SNo END AS SNo, CASE WHEN SNo % 43 = 0 THEN '' ELSE Name END AS Name,
    CASE WHEN SNo % 47 = 0 THEN 'a symbol too long' ELSE Symbol END AS Symbol,
    CASE WHEN SNo % 53 = 0 THEN '01/02/2023' ELSE strftime(Date, '%Y-%m-%d') END AS Date,
    CASE WHEN SNo % 59 = 0 THEN Low - 1 ELSE High END AS High, CASE WHEN SNo % 61 = 0 THEN -Low ELSE Low END AS Low,
    Open, CASE WHEN SNo % 37 <> 0 THEN Volume END AS Volume,
    CASE WHEN SNo % 31 = 0 THEN -1.0 ELSE Marketcap END AS Marketcap FROM bars)
SELECT concat_ws(',', {parts}) AS errors, count(*) AS requests FROM asked GROUP BY 1"""


def sql_by_query() -> dict[str, str]:
    def names(*families):
        return feature_names(BAR_COLUMNS, families=families)

    trend = ["SMA_5", "SMA_10", "SMA_20", "EMA_5", "EMA_10", "EMA_20"]
    bands = ["BB_Upper", "BB_Middle", "BB_Lower", "BB_Width", "BB_Position"]
    out: dict[str, str] = {}
    out["s_csv_bars"] = f"WITH {ORDERS} SELECT * FROM bars"
    out["s_csv_one_symbol"] = (
        f"WITH {EVENTS} SELECT SNo, Symbol, Date, High, Low, Open, Close, Volume, Marketcap FROM bars "
        "WHERE Symbol IN ('click', 'purchase')")
    numeric = ["SNo", "High", "Low", "Open", "Close", "Volume", "Marketcap"]
    out["s_csv_unreadable_values"] = f"WITH {DIRTY} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", " + ("count(*) FILTER (SNo % 50 = 0)" if c == "Volume" else "0::BIGINT")
        + " AS violations FROM dirty" + ("" if c == "Volume" else " LIMIT 1") for c in numeric
    ).replace("FROM dirty LIMIT 1", "")
    out["s_feature_table"] = features(names("price"))
    out["s_run_table"] = f"WITH e AS (WITH {EVENTS} SELECT * FROM bars), o AS (WITH {ORDERS} SELECT * FROM bars) " + \
        " UNION ALL ".join(
            f"SELECT '{run}' AS run_id, 'data' AS kind, '{n}' AS name, ({f})::DOUBLE AS value FROM {t}"
            for run, t in (("events", "e"), ("orders", "o"))
            for n, f in (("rows", "count(*)"), ("high", "max(High)"), ("low", "min(Low)")))
    samples = ", ".join(f"count(*) FILTER (split = '{p}') AS {p}_samples" for p in ("train", "validation", "test"))
    first_nine = "SNo, Name, Symbol, Date, High, Low, Open, Volume, Marketcap"
    out["s_summary_json"] = (
        f"WITH {EVENTS}, {split_cte('bars')} SELECT count(*) AS rows, 9::BIGINT AS features, {samples}, "
        f"'{first_nine}' AS feature_names, "
        "'2030-01-01T00:00:00' AS etl_timestamp, '1.0.0' AS etl_version FROM split")

    out["v_quality_report"] = f"WITH {quality(DIRTY, 'dirty', AS_OF)} SELECT * FROM report"
    out["v_quality_report_many_symbols"] = (
        f"WITH {quality(ORDERS, 'bars', chr(39).join(['TIMESTAMP ', '1997-01-01', '']))} SELECT * FROM report")
    flags = ", ".join(f"bool_and(CASE WHEN \"check\" = '{c}' THEN status <> 'fail' END) AS {c}" for c in CHECKS)
    out["v_quality_summary"] = f"""WITH {quality(DIRTY, 'dirty', AS_OF)},
labels AS (SELECT *, CASE WHEN status = 'fail' THEN
  CASE WHEN "check" = 'missing_values' THEN "check" ELSE "check" || ':' || item END END AS label FROM report),
flags AS (SELECT Symbol, {flags}, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS issues,
  count(DISTINCT label) AS total_issues FROM labels GROUP BY Symbol)
SELECT *, {' AND '.join(CHECKS)} AS overall_valid FROM flags"""

    out["c_clean_bars"] = f"WITH {CLEAN} SELECT * FROM clean"

    out["p_price_features"] = features(names("price"))
    out["p_price_features_many_symbols"] = features(names("price"), ORDERS)
    out["u_volume_features"] = features(names("volume"))
    out["k_marketcap_features"] = features(names("marketcap"))
    out["t_calendar_features"] = features(names("calendar"))
    out["t_calendar_features_many_symbols"] = features(names("calendar"), ORDERS)
    out["i_moving_averages"] = features(trend)
    out["i_rsi"] = features(["RSI_14"])
    out["i_macd"] = features(["MACD", "MACD_Signal", "MACD_Histogram"])
    out["i_bollinger"] = features(bands)
    out["i_indicators_many_symbols"] = features([*trend[:3], "RSI_14", *bands], ORDERS)
    out["z_return_statistics"] = features(names("statistical"), digits=4)
    out["z_return_statistics_many_symbols"] = features(names("statistical"), ORDERS, digits=4)
    out["z_features_of_dirty_bars"] = features(
        ["Open_Change", "Open_MA_5", "Open_Std_20", "Volume_Change", "Volume_MA_10",
         "Volume_Ratio", "Momentum_10", "Volatility_5"], CLEAN, "clean", 4)

    both = ", ".join(f"{rnd(c + '_' + k, 2)} AS {c}_{k}" for c in VALUES for k in ("low", "high"))
    out["r_bounds"] = f"WITH {CLEAN}, {bounds_cte(VALUES, 'clean')} SELECT Symbol, {both} FROM bounds"
    out["r_bounds_many_symbols"] = f"WITH {ORDERS}, {bounds_cte(VALUES, 'bars')} SELECT Symbol, {both} FROM bounds"
    train = "WHERE split = 'train'"
    out["r_bounds_of_training_part"] = (
        f"WITH {CLEAN}, {split_cte('clean')}, {bounds_cte(VALUES, 'split', train)} "
        f"SELECT Symbol, {both} FROM bounds")
    two = ", ".join(f"{rnd(c, 2)} AS {c}" for c in VALUES)
    out["r_clip"] = (f"WITH {CLEAN}, {bounds_cte(VALUES, 'clean')}, "
                     f"{clipped_cte(VALUES, 'clean', ['Symbol', 'SNo'])} SELECT Symbol, SNo, {two} FROM clipped")
    out["r_fill"] = f"WITH {CLEAN} SELECT Symbol, SNo, {filled_select(VALUES, 'SNo', lambda c: 2)} FROM clean"
    placed = "placed AS (SELECT *, SNo AS position FROM clean)"
    numbers = ["SNo", *VALUES]
    out["r_repair"] = (
        f"WITH {CLEAN}, {placed}, {bounds_cte(numbers, 'placed')}, "
        f"{clipped_cte(numbers, 'placed', ['Symbol', 'position'])} "
        f"SELECT Symbol, position, {filled_select(numbers, 'position', lambda c: 2)} FROM clipped")
    everything = ["SNo", *VALUES, *names(*FAMILIES)]

    def digits(c):
        return 2 if c in VALUES or c.startswith(("Marketcap", "Volume_M", "Volume_S")) else 4

    out["r_repaired_features"] = (
        f"WITH {EVENTS}, {feature_ctes('bars')}, placed AS (SELECT *, SNo AS position FROM f4), "
        f"{bounds_cte(everything, 'placed')}, {clipped_cte(everything, 'placed', ['Symbol', 'Name', 'Date', 'position'])} "
        f"SELECT Symbol, Name, Date, position, {filled_select(everything, 'position', digits)} FROM clipped")

    out["e_encoded"] = f"""WITH {EVENTS}, {split_cte('bars')},
codes AS (SELECT Symbol, (row_number() OVER (ORDER BY Symbol) - 1)::DOUBLE AS code FROM
  (SELECT DISTINCT Symbol FROM split WHERE split = 'train' AND Symbol <> 'view'))
SELECT SNo AS position, date_diff('day', DATE '1970-01-01', Date::DATE)::DOUBLE AS Date,
  coalesce(code, -1.0::DOUBLE) AS Name, coalesce(code, -1.0::DOUBLE) AS Symbol, Close
FROM split LEFT JOIN codes USING (Symbol)"""
    out["e_statistics"] = f"WITH {CLEAN}, {statistics_ctes()} " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {rnd('med_' + c, 4)} AS median, {rnd('mean_' + c, 4)} AS mean, "
        f"{rnd('sd_' + c, 4)} AS sd FROM meds, stats" for c in NUMBERS)
    out["e_imputed"] = (f"WITH {CLEAN}, {statistics_ctes()} SELECT Symbol, SNo, split, "
                        + ", ".join(f"{rnd(f'coalesce({c}, med_{c})', 4)} AS {c}" for c in NUMBERS)
                        + " FROM split, meds")
    out["e_scaled"] = (f"WITH {CLEAN}, {statistics_ctes()} SELECT Symbol, SNo, split, "
                       + ", ".join(f"{rnd(f'(coalesce({c}, med_{c}) - mean_{c}) / sd_{c}')} AS {c}" for c in NUMBERS)
                       + " FROM split, meds, stats")

    for name, source in (("x_split_counts", EVENTS), ("x_split_counts_many_symbols", ORDERS)):
        out[name] = f"""WITH {source}, {split_cte('bars')},
parts AS (SELECT DISTINCT Symbol, n, p.split FROM split, (VALUES ('train'), ('validation'), ('test')) p(split)),
held AS (SELECT Symbol, split, count(*) AS rows FROM split GROUP BY 1, 2)
SELECT parts.Symbol, parts.split, coalesce(rows, 0) AS rows, {rnd('coalesce(rows, 0) / n::DOUBLE')} AS share
FROM parts LEFT JOIN held ON parts.Symbol = held.Symbol AND parts.split = held.split"""
    out["x_split_rows"] = f"WITH {EVENTS}, {split_cte('bars')} SELECT Symbol, SNo, split FROM split"
    out["x_folds"] = f"""WITH {EVENTS}, {split_cte('bars')},
sizes AS (SELECT Symbol, count(*) AS n FROM split WHERE split = 'train' GROUP BY 1),
folds AS (SELECT Symbol, i::INTEGER AS fold, n - (n // 6) * (5 - i) AS cut, n // 6 AS t FROM sizes, range(5) r(i))
SELECT Symbol, fold, 'train' AS role, cut AS rows, 1::BIGINT AS first_row, cut AS last_row FROM folds
UNION ALL SELECT Symbol, fold, 'test', t, cut + 1, cut + t FROM folds"""
    out["x_fold_rows"] = f"""WITH {EVENTS}, counted AS (SELECT *, count(*) OVER (PARTITION BY Symbol) AS n FROM bars),
cuts AS (SELECT *, n - (n // 6) * (5 - fold) AS cut, n // 6 AS t FROM counted, range(5) f(fold))
SELECT fold::INTEGER AS fold, Symbol, SNo, CASE WHEN SNo <= cut THEN 'train' ELSE 'test' END AS role FROM cuts WHERE SNo <= cut + t"""

    out["m_metrics"] = f"WITH {EVENTS}, {feature_ctes('bars')}, {split_cte('f4')} {metric_select('split')}"
    out["m_metrics_by_symbol"] = (
        f"WITH {ORDERS}, sma AS (SELECT *, {roll('avg', 'Close', 5)} AS SMA_5 FROM bars), "
        f"{split_cte('sma')} {metric_select('Symbol, split')}")
    out["m_comparison"] = (
        f"WITH {EVENTS}, sma AS (SELECT *, {roll('avg', 'Close', 5)} AS SMA_5 FROM bars), {split_cte('sma')} "
        f"SELECT Symbol, SNo, split, {rnd('Close')} AS actual, {rnd('SMA_5')} AS predicted, "
        f"{rnd('Close - SMA_5')} AS error, {rnd('abs(Close - SMA_5)')} AS abs_error, "
        f"{rnd('abs((Close - SMA_5) / NULLIF(Close, 0)) * 100')} AS pct_error "
        "FROM split WHERE SMA_5 IS NOT NULL")

    out["m_mean_predictions"] = (
        f"WITH {mean_model_ctes()} SELECT Symbol, SNo, split, {rnd('Close')} AS Close, "
        f"{rnd('prediction')} AS prediction FROM told")
    scores = ", ".join(f"{rnd(m, 4)} AS {m}" for m in ("mse", "rmse", "mae", "r2"))
    out["m_mean_cross_validation"] = f"WITH {mean_model_ctes()} SELECT fold, {scores} FROM cv"
    out["m_mean_grid_search"] = (
        f"WITH {mean_model_ctes()} SELECT n::INTEGER AS numTrees, 0::INTEGER AS maxDepth, 0::INTEGER AS bootstrap, "
        f"{rnd('avg(mse)', 4)} AS mse_mean FROM cv, range(1, 3) r(n) GROUP BY n")
    out["s_training_runs"] = training_runs_sql()

    out["m_performance_summary"] = (
        f"SELECT split, mae, rmse, r2, mape FROM ({out['m_metrics']})")

    events = ("e AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS SNo, value AS Open FROM events), "
              "gaps AS (SELECT *, CASE WHEN SNo > 700 AND SNo % 7 = 0 THEN Open END AS Close FROM e)")
    frame = "OVER (ORDER BY SNo ROWS BETWEEN 1999 PRECEDING AND CURRENT ROW)"
    cells = ", ".join(f"CASE WHEN SNo >= 2000 THEN {rnd(f'{f}(Open) {frame}')} END AS Open_{k}_2000" for k, f in (
        ("MA", "avg"), ("Std", "stddev_samp"), ("Min", "min"), ("Max", "max")))
    out["p_long_windows"] = f"WITH {events} SELECT SNo, {cells} FROM gaps"
    filled = ("coalesce(last_value(Close IGNORE NULLS) OVER (ORDER BY SNo ROWS BETWEEN UNBOUNDED PRECEDING AND "
              "CURRENT ROW), first_value(Close IGNORE NULLS) OVER (ORDER BY SNo ROWS BETWEEN UNBOUNDED PRECEDING "
              "AND UNBOUNDED FOLLOWING), 0)")
    out["r_fill_long_series"] = f"WITH {events} SELECT SNo, {rnd('Open')} AS Open, {rnd(filled)} AS Close FROM gaps"
    names_of_long = ["Open", "Close", "High"]
    four = ", ".join(f"{rnd(f'{c}_{k}')} AS {c}_{k}" for c in names_of_long for k in ("low", "high"))
    out["r_bounds_long_series"] = (
        f"WITH {events}, long AS (SELECT 'all' AS Symbol, *, CASE WHEN SNo % 200 = 0 THEN Open END AS High FROM gaps), "
        f"{bounds_cte(names_of_long, 'long')} SELECT Symbol, {four} FROM bounds")

    out["b_request_rules"] = request_sql()

    made = [*BAR_COLUMNS, *names("price", "volume")]
    missing = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in made)
    out["q_feature_summary"] = (
        f"WITH {EVENTS}, {feature_ctes('bars')} SELECT {len(made)}::BIGINT AS total_features, "
        f"{len(made) - 3}::BIGINT AS numeric_features, 2::BIGINT AS categorical_features, "
        f"({missing})::BIGINT AS missing_values FROM f4")
    every = [*BAR_COLUMNS, *names(*FAMILIES)]
    cells = ", ".join(f"('{c}', k_{c})" for c in every)
    known = ", ".join(f"count({c}) AS k_{c}" for c in every)
    out["q_feature_classes"] = (
        f"WITH {EVENTS}, {feature_ctes('bars')}, known AS (SELECT {known} FROM f4) "
        f"SELECT t.\"column\", {feature_class_case('t.' + chr(34) + 'column' + chr(34))} AS class, t.known "
        f"FROM known, LATERAL (VALUES {cells}) t(\"column\", known)")
    out["q_pipeline_summary"] = (
        f"WITH {CLEAN}, {split_cte('clean')} SELECT count(*) AS rows, 89::BIGINT AS features, {samples}, "
        f"'{first_nine}, High_Low_Spread, ...' AS feature_names FROM split")
    return out
