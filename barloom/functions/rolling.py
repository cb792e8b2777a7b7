"""Rolling statistics over the last n rows of a series.

A sliding frame re-reads n rows for every row and copies whole rows while it
slides, which gets slow with many columns and higher moments. Here windows are
put together from halves instead: statistics of 2 rows come from two rows, of 4
rows from two pairs, and so on, each half fetched with one ``lag``; a window of
20 rows is its last 16 and the 4 before. Merging central moments this way is
exact up to rounding, needs no subtraction of large sums, and takes log2(n)
steps for all columns at once.

A statistic appears once the window holds n non-missing values, since a missing
one makes every merge NULL. No window reaches past the block's halo.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.numeric import safe_div
from barloom.operators.series import block_window

# Below this variance a window counts as constant up to rounding noise and has
# no defined third or fourth moment.
FLAT_VARIANCE = 1e-14

MOMENTS = ["mean", "m2", "m3", "m4"]


@dataclass(frozen=True)
class Rolling:
    """Statistics wanted of one column: central moments up to ``order`` (1, 2 or
    4) and, with ``extremes``, the minimum and maximum, for each window."""

    source: str
    windows: tuple[int, ...]
    order: int = 1
    extremes: bool = False

    @property
    def stats(self) -> list[str]:
        return MOMENTS[: self.order] + (["min", "max"] if self.extremes else [])

    def output(self, n: int, stat: str) -> str:
        return f"_roll_{self.source}_{n}_{stat}"

    def level(self, rows: int, stat: str) -> str:
        return f"_level_{self.source}_{rows}_{stat}"

    def older(self, n: int, rows: int, stat: str) -> str:
        return f"_older_{self.source}_{n}_{rows}_{stat}"

    def first_level(self) -> dict[str, Column]:
        """A single row: its value is mean, minimum and maximum."""
        zero, x = F.lit(0.0), F.col(self.source)
        return {self.level(1, s): zero if s in MOMENTS[1:] else x for s in self.stats}


def _merged(stats: Sequence[str], a: dict[str, str], na: int, b: dict[str, str], nb: int) -> dict:
    """Statistics of ``na`` older rows (columns ``a``) joined with ``nb`` newer ones."""
    n = na + nb
    a, b = ({s: f"`{c}`" for s, c in side.items()} for side in (a, b))
    d = f"({b['mean']} - {a['mean']})"

    def weigh(stat: str, wb: float, sign: str, wa: float) -> str:
        return f"({b[stat]} * {float(wb)!r}D {sign} {a[stat]} * {float(wa)!r}D)"

    sql = {"mean": f"{a['mean']} + {d} * {nb / n!r}D"}
    if "m2" in stats:
        sql["m2"] = f"{a['m2']} + {b['m2']} + {d} * {d} * {na * nb / n!r}D"
    if "m4" in stats:
        sql["m3"] = (
            f"{a['m3']} + {b['m3']} + {d} * {d} * {d} * {na * nb * (na - nb) / n**2!r}D"
            f" + {d} * {weigh('m2', na, '-', nb)} * {3 / n!r}D"
        )
        sql["m4"] = (
            f"{a['m4']} + {b['m4']}"
            f" + {d} * {d} * {d} * {d} * {na * nb * (na * na - na * nb + nb * nb) / n**3!r}D"
            f" + {d} * {d} * {weigh('m2', na * na, '+', nb * nb)} * {6 / n**2!r}D"
            f" + {d} * {weigh('m3', na, '-', nb)} * {4 / n!r}D"
        )
    if "min" in stats:
        sql["min"] = f"least({a['min']}, {b['min']})"
        sql["max"] = f"greatest({a['max']}, {b['max']})"
    return {s: F.expr(sql[s]) for s in stats}


def _parts(n: int) -> list[int]:
    """n as powers of two, largest first: the newest rows are the largest part."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def add_rolling(df: DataFrame, wanted: Sequence[Rolling]) -> DataFrame:
    """Add the wanted statistics as ``Rolling.output`` columns."""
    w = block_window()
    df = df.withColumns({name: c for r in wanted for name, c in r.first_level().items()})

    rows = 1
    longest = max(max(r.windows) for r in wanted)
    while 2 * rows <= longest:
        grow = [r for r in wanted if max(r.windows) >= 2 * rows]
        df = df.withColumns({
            r.older(0, rows, s): F.lag(r.level(rows, s), rows).over(w) for r in grow for s in r.stats
        })
        step = {}
        for r in grow:
            older = {s: r.older(0, rows, s) for s in r.stats}
            newer = {s: r.level(rows, s) for s in r.stats}
            merged = _merged(r.stats, older, rows, newer, rows)
            step |= {r.level(2 * rows, s): merged[s] for s in r.stats}
        df = df.withColumns(step)
        rows *= 2

    lags = {}
    for r in wanted:
        for n in r.windows:
            newer_rows = 0
            for part in _parts(n):
                if newer_rows:
                    lags |= {
                        r.older(n, part, s): F.lag(r.level(part, s), newer_rows).over(w)
                        for s in r.stats
                    }
                newer_rows += part
    if lags:
        df = df.withColumns(lags)

    for i in range(max(len(_parts(n)) for r in wanted for n in r.windows)):
        step = {}
        for r in wanted:
            for n in r.windows:
                parts = _parts(n)
                if i == 0:
                    step |= {r.output(n, s): F.col(r.level(parts[0], s)) for s in r.stats}
                elif i < len(parts):
                    older = {s: r.older(n, parts[i], s) for s in r.stats}
                    newer = {s: r.output(n, s) for s in r.stats}
                    merged = _merged(r.stats, older, parts[i], newer, sum(parts[:i]))
                    step |= {r.output(n, s): merged[s] for s in r.stats}
        df = df.withColumns(step)
    return df


def mean(r: Rolling, n: int) -> Column:
    return F.col(r.output(n, "mean"))


def sd(r: Rolling, n: int) -> Column:
    """Sample standard deviation."""
    return F.sqrt(F.col(r.output(n, "m2")) / (n - 1))


def minimum(r: Rolling, n: int) -> Column:
    return F.when(mean(r, n).isNotNull(), F.col(r.output(n, "min")))


def maximum(r: Rolling, n: int) -> Column:
    return F.when(mean(r, n).isNotNull(), F.col(r.output(n, "max")))


def _shaped(r: Rolling, n: int, flat_value: float, value: Column) -> Column:
    m2 = F.col(r.output(n, "m2"))
    return F.when(m2 == 0, F.lit(flat_value)).when(m2 / n > FLAT_VARIANCE, value)


def skew(r: Rolling, n: int) -> Column:
    """Bias-corrected skewness (n >= 3)."""
    variance = F.col(r.output(n, "m2")) / n
    ratio = safe_div(F.col(r.output(n, "m3")) / n, variance * F.sqrt(variance))
    return _shaped(r, n, 0.0, ratio * ((n * (n - 1)) ** 0.5 / (n - 2)))


def kurt(r: Rolling, n: int) -> Column:
    """Bias-corrected excess kurtosis (n >= 4)."""
    variance = F.col(r.output(n, "m2")) / n
    excess = safe_div(F.col(r.output(n, "m4")) / n, variance * variance) - 3
    return _shaped(r, n, -3.0, (excess * (n + 1) + 6) * ((n - 1) / ((n - 2) * (n - 3))))


def change(current: Column, previous: Column) -> Column:
    """Relative change, NULL where the previous value is 0 or missing."""
    return safe_div(current, previous) - 1
