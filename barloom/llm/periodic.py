"""Stretches of words that repeat with a fixed period, found by a difference cover.

A run is a stretch whose smallest period is q, at least ``LEAST_LENGTH`` words and
``LEAST_POWER`` periods long, and not to be extended with that period. The texts of a slice
are one sequence of word numbers, each text closed by a number of its own, so that no match
leaves its text.

1. Suffixes at places whose remainder by 13 is in a difference cover are sorted: by their
   first 13 words, then by doubling, looking only at suffixes that are still tied. Their
   common prefixes with their neighbours go into a sparse table of minima.
2. The common extension of any two places compares the few words up to the first pair of
   places that are both in the cover, then takes a minimum out of the sparse table. The
   sequence read backwards has a structure of its own.
3. A run of period p has equal words p apart over at least 3 p places (5 for p = 1), so it
   holds a place of the grid with that spacing. From each place of each period's grid the
   match is extended both ways; of equal stretches the smallest period is the run's.

A text of n words has about n (ln n) / 3 grid places, looked at in portions of fixed size.
Slices hold ``SLICE`` bytes, a longer text is a slice of its own.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.words import freeing, slices, split_words, texts_of

LEAST_LENGTH = 6
LEAST_POWER = 4
SLICE = 2 << 20
# Grid places looked at together.
PORTION = 1 << 20

# Every remainder by 13 is a difference of two of these.
COVER = (0, 1, 3, 9)
MODULUS = 13

_SLOT = np.full(MODULUS, -1, np.int64)
_SLOT[list(COVER)] = np.arange(len(COVER))
# How far two places with given remainders are from places that are both in the cover.
_SHIFT = np.array([[next(k for k in range(MODULUS) if (a + k) % MODULUS in COVER and (b + k) % MODULUS in COVER)
                    for b in range(MODULUS)] for a in range(MODULUS)])


class Extensions:
    """Common extensions to the right of places of a sequence whose last number is unique."""

    def __init__(self, x: np.ndarray):
        self.n = len(x)
        # Beyond the end every place differs from every other.
        self.x = np.concatenate([x, -1 - np.arange(2 * MODULUS)])
        self.rank = None

    def _build(self) -> None:
        """Sorts the sampled suffixes and lays out the minima of neighbours' common prefixes."""
        blocks = -(-self.n // MODULUS)
        at = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()
        at = at[at < self.n]
        m = len(at)
        order, head, rank = np.arange(m), np.zeros(m + 1, bool), np.zeros(m, np.int64)
        head[[0, m]] = True

        def refine(key: np.ndarray, depth: int) -> None:
            """Sorts within the groups of equal rank by ``key``; new neighbours share ``depth`` words at least."""
            tied = np.flatnonzero(~(head[:-1] & head[1:]))
            if not len(tied):
                return
            s = order[tied]
            g, k = rank[s], key[s]
            by = np.lexsort((k, g))
            s, k = s[by], k[by]
            order[tied] = s
            new = np.flatnonzero((k[1:] != k[:-1]) & ~head[tied[1:]])
            head[tied[1:][new]] = True
            shared[tied[1:][new]] = depth
            rank[s] = np.maximum.accumulate(np.where(head[tied], tied, 0))

        shared = np.zeros(m, np.int64)
        wide = self.x - self.x.min()
        bits = int(wide.max()).bit_length()
        together = max(1, 63 // max(1, bits))
        for first in range(0, MODULUS, together):
            key = np.zeros(m, np.int64)
            for k in range(first, min(first + together, MODULUS)):
                key = (key << bits) | wide[at + k]
            refine(key, first)
        levels, step = [], len(COVER)  # ``step`` samples further on are MODULUS words further on
        while not head.all():
            levels.append(rank.astype(np.int32))
            key = np.full(m, -1, np.int64)
            key[:max(0, m - step)] = rank[step:]
            refine(key, MODULUS * step // len(COVER))
            step *= 2
        left, right = order[:-1], order[1:]
        common = self._common(at, levels, left, right, shared[1:])
        self.rank = np.empty(m, np.int64)
        self.rank[order] = np.arange(m)
        self.minima = [common.astype(np.int32)]
        while len(self.minima[-1]) > 1 << (len(self.minima) - 1):
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def _common(self, at, levels, left, right, shared) -> np.ndarray:
        """Common prefixes of neighbours in the order: whole levels first, then single words."""
        found = np.zeros(len(left), np.int64)
        deep = np.flatnonzero(shared >= MODULUS)
        a, b, got = left[deep].copy(), right[deep].copy(), np.zeros(len(deep), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            ranks, samples = levels[level], len(COVER) << level
            inside = (a < len(ranks)) & (b < len(ranks))
            same = np.zeros(len(a), bool)
            same[inside] = ranks[a[inside]] == ranks[b[inside]]
            a[same] += samples
            b[same] += samples
            got[same] += MODULUS << level
        found[deep] = got
        i, j, open_ = at[left] + found, at[right] + found, np.arange(len(left))
        for _ in range(MODULUS):
            same = self.x[i] == self.x[j]
            i, j, open_ = i[same] + 1, j[same] + 1, open_[same]
            if not len(open_):
                break
            found[open_] += 1
        return found

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers from i and from j on are equal, one by one; i and j differ."""
        out = np.zeros(len(i), np.int64)
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        open_ = np.arange(len(i))
        synced = []
        for k in range(MODULUS + 1):
            there = shift[open_] == k
            synced.append(open_[there])
            open_ = open_[~there]
            open_ = open_[self.x[i[open_] + k] == self.x[j[open_] + k]]
            out[open_] += 1
            if not len(open_):
                break
        synced = np.concatenate(synced)
        if len(synced):
            if self.rank is None:
                self._build()
            a, b = i[synced] + shift[synced], j[synced] + shift[synced]
            a, b = (self.rank[p // MODULUS * len(COVER) + _SLOT[p % MODULUS]] for p in (a, b))
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1  # the power of two at or below
            least = np.empty(len(low), np.int64)
            for t in np.unique(level).tolist():
                mine = level == t
                table = self.minima[t]
                least[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << t)])
            out[synced] += least
        return out


def _grid(sizes: np.ndarray, starts: np.ndarray):
    """Portions of (place, period): the grids of every period of every text."""
    most = np.where(sizes >= LEAST_LENGTH, sizes // LEAST_POWER, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    spacing = np.maximum(LEAST_LENGTH, LEAST_POWER * period) - period
    count = -(-(sizes[text] - period) // spacing)
    ends = np.cumsum(count)
    first = 0
    while first < len(text):
        last = max(first + 1, int(np.searchsorted(ends, PORTION + (ends[first - 1] if first else 0), "right")))
        n = count[first:last]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield (np.repeat(starts[text[first:last]], n) + k * np.repeat(spacing[first:last], n),
               np.repeat(period[first:last], n))
        first = last


def runs_of(x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of the texts in ``x``, by start, then period.

    ``x`` holds the texts one after the other, text t with ``sizes[t]`` words and a number of
    its own after them.
    """
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    onward, backward = Extensions(x), Extensions(np.append(x[::-1], x.max(initial=0) + 1))
    found = [np.zeros((3, 0), np.int64)]
    for at, period in _grid(sizes, starts):
        equal = np.flatnonzero(x[at] == x[at + period])
        at, period = at[equal], period[equal]
        ahead = onward(at, at + period)
        # Backwards from the places before; before the first text there is nothing.
        behind, inner = np.zeros(len(at), np.int64), at > 0
        last = len(x) - 1
        behind[inner] = backward(last - (at[inner] - 1), last - (at[inner] + period[inner] - 1))
        length = behind + ahead + period
        long = length >= np.maximum(LEAST_LENGTH, LEAST_POWER * period)
        found.append(np.stack([(at - behind)[long], length[long], period[long]]))
    start, length, period = np.concatenate(found, axis=1)
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def repeated_tails(codes: np.ndarray, starts: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Word numbers with the tails of marked texts made periodic; a mark below 0 leaves its text as it is.

    A text of n words with mark h, a multiple of 10, repeats from word a = g % n on its next p
    words, g = h // 10 and p = 1 + (n - a) // (3 + g % 8).
    """
    out = codes.copy()
    sizes = np.diff(starts)
    for t in np.flatnonzero((marks >= 0) & (marks % 10 == 0) & (sizes > 0)).tolist():
        n, g = int(sizes[t]), int(marks[t]) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        first = int(starts[t]) + a
        out[first:first + n - a] = codes[first + np.arange(n - a) % p]
    return out


_OUT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                  ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
                  ("collapsed_sha256", pa.string()), ("collapsed", pa.string())])


def _described(part: pa.RecordBatch, with_text: bool) -> pa.RecordBatch:
    words = split_words(texts_of(part, "text"))
    marks = pc.fill_null(part.column("mark"), -1).to_numpy()
    codes = repeated_tails(words.codes, words.starts, marks) if len(words.codes) else words.codes
    sizes, n_texts = np.diff(words.starts), part.num_rows
    place = np.arange(len(codes)) + np.repeat(np.arange(n_texts), sizes)
    x = np.empty(len(codes) + n_texts, np.int64)
    x[place] = codes
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)])
    x[firsts[1:] - 1] = len(words.distinct) + np.arange(n_texts)
    start, length, period = runs_of(x, sizes)

    dropped = np.zeros(len(x) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    kept = (np.cumsum(dropped[:-1]) == 0)[place]
    ends = np.concatenate([[0], np.cumsum(kept)])[words.starts]
    if len(words.distinct):
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.distinct.take(pa.array(codes[kept])))
        collapsed = pc.binary_join(lists, " ").to_pylist()
    else:
        collapsed = [""] * n_texts

    owner = np.searchsorted(firsts, start, "right") - 1
    start = start - firsts[owner]
    n_runs = np.bincount(owner, minlength=n_texts)
    own = np.concatenate([[0], np.cumsum(n_runs)])
    best = np.full((4, n_texts), -1, np.int64)
    by = np.lexsort((period, start, -length, owner))
    first = by[np.searchsorted(owner[by], np.flatnonzero(n_runs))]
    best[:, n_runs > 0] = start[first], length[first], period[first], 1000 * length[first] // period[first]
    none = hashlib.sha256(b"").hexdigest()
    listed = [none] * n_texts
    rows = np.stack([start, length, period], axis=1).tolist()
    for t in np.flatnonzero(n_runs).tolist():
        said = "".join(f"{s},{n},{q}\n" for s, n, q in rows[own[t]:own[t + 1]])
        listed[t] = hashlib.sha256(said.encode()).hexdigest()
    empty = n_runs == 0
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(n_runs, pa.int64()), *[pa.array(b, pa.int64(), mask=empty) for b in best],
         pa.array(listed, pa.string()),
         pa.array([hashlib.sha256(c.encode()).hexdigest() for c in collapsed], pa.string()),
         pa.array(collapsed if with_text else [None] * n_texts, pa.string())], schema=_OUT)


def find_runs(docs: DataFrame, made_periodic: bool = False, with_text: bool = False) -> DataFrame:
    """Per row: n_runs, the longest run (ties: smallest start, then period; null without runs), digests
    of all runs and of the text without repetitions, and with ``with_text`` that text as ``collapsed``.

    ``made_periodic`` first makes the tails of texts whose id's crc32 is a multiple of 10 periodic
    (see ``repeated_tails``). A word is dropped from the collapsed text if a run holds it after the
    run's first period. A null text is empty; a null id stays and its text is taken as it is; rows
    with equal ids are described one by one; other columns are not looked at.
    """
    mark = F.crc32(F.col("doc_id").cast("long").cast("string")) if made_periodic else F.lit(None)

    def run(batches):
        for part in slices(batches, "text", SLICE):
            yield _described(part, with_text)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       mark.cast("long").alias("mark"))
    found = rows.mapInArrow(freeing(run), "doc_id long, n_runs long, start long, length long, period long, "
                                 "exponent_milli long, runs_sha256 string, collapsed_sha256 string, collapsed string")
    return found if with_text else found.drop("collapsed")
