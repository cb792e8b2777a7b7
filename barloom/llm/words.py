"""Arrow batches of texts: cut into bounded slices, split into words, gathered back.

Helpers for functions given to ``mapInArrow``. A word is a run of characters other
than space and \\t \\n \\v \\f \\r. Every distinct word of a slice is looked at once;
its occurrences are numbers into that list.
"""

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Bytes of text handled at once in a Python worker; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20
# Words up to this many bytes are hashed together.
HASHED_BYTES = 128

_stores: list[dict] = []
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def task_store() -> dict:
    """A dictionary that is emptied whenever a task of this Python worker ends."""
    _stores.append({})
    return _stores[-1]


def end_task() -> None:
    """Empties the stores of a finished task and returns unused memory to the system."""
    for store in _stores:
        store.clear()
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def freeing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for mapInArrow, giving back the worker's memory at its end: workers outlive their tasks."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            end_task()

    return own


@dataclass
class Words:
    """``codes[starts[i]:starts[i + 1]]`` are the words of text i, as places in ``distinct``."""

    starts: np.ndarray
    codes: np.ndarray
    distinct: pa.Array

    @property
    def owners(self) -> np.ndarray:
        """The text that each word stands in."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A text column as plain strings, null as empty."""
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def slices(batches: Iterator[pa.RecordBatch], column: str,
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, cut where the texts of a part exceed ``most`` bytes."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(texts_of(batch, column)), dtype=np.int64)
        ends, first = np.cumsum(sizes), 0
        while first < len(sizes):
            reach = most + (ends[first - 1] if first else 0)
            last = max(first + 1, int(np.searchsorted(ends, reach, side="right")))
            yield batch.slice(first, last - first)
            first = last


def split_words(texts: pa.Array) -> Words:
    cut = pc.ascii_split_whitespace(texts)
    starts = np.asarray(cut.offsets, dtype=np.int64)
    starts = starts - starts[0] if len(starts) else np.zeros(1, np.int64)
    coded = cut.flatten().dictionary_encode()
    codes, distinct = np.asarray(coded.indices, dtype=np.int64), coded.dictionary
    blank = pc.index(distinct, "").as_py() if len(distinct) else -1
    if blank >= 0:  # what a split leaves before the first and after the last word
        kept = codes != blank
        before = np.concatenate([[0], np.cumsum(kept)])
        starts, codes = before[starts], codes[kept]
        codes = codes - (codes > blank)
        distinct = pa.concat_arrays([distinct.slice(0, blank), distinct.slice(blank + 1)])
    return Words(starts, codes, distinct)


def gather(starts: np.ndarray, values: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``picks`` out of ``values[starts[i]:starts[i + 1]]``, one after the other.

    Returns where each picked list starts (one more entry than picks) and the values.
    """
    sizes = np.diff(starts)[picks]
    new = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = np.arange(new[-1]) + np.repeat(starts[picks] - new[:-1], sizes)
    return new, values[at]


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[starts[i]:starts[i + 1]]``; an empty list sums to 0."""
    # Per list, not by differences of a running total: a list's sum must not depend on its neighbours.
    out = np.zeros(len(starts) - 1, dtype=np.float64)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        out[full] = np.add.reduceat(values, starts[full])
    return out


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that scatters them (finaliser of splitmix64)."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def map_texts(docs: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
              schema: str, column: str = "text") -> DataFrame:
    """``work`` over bounded slices of ``docs``, on the executors."""
    def run(batches):
        for part in slices(batches, column):
            done = work(part)
            if done is not None:
                yield done

    return docs.mapInArrow(freeing(run), schema)


def free_name(docs: DataFrame, wanted: str) -> str:
    """A column name that ``docs`` doesn't have yet (names differ in more than case)."""
    used = {c.lower() for c in docs.columns}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, the same in every process: eight bytes at a time, all words together."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64) \
        if len(words) else np.zeros(1, np.int64)
    sizes = np.diff(ends)
    out = mixed(sizes.astype(np.uint64), 31)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8) if len(words) else np.zeros(0, np.uint8)
    data = np.concatenate([data[ends[0]:ends[-1]], np.zeros(8, np.uint8)])
    starts, place = ends[:-1] - ends[0], np.arange(8)
    left = np.flatnonzero((sizes > 0) & (sizes <= HASHED_BYTES))
    done = 0
    while len(left):
        eight = data[(starts[left] + done)[:, None] + place]
        eight[place >= (sizes[left] - done)[:, None]] = 0
        out[left] = mixed(out[left] ^ eight.view("<u8").ravel(), 32)
        done += 8
        left = left[sizes[left] > done]
    for i in np.flatnonzero(sizes > HASHED_BYTES).tolist():
        whole = data[starts[i]:starts[i] + sizes[i]]
        out[i] = np.frombuffer(hashlib.blake2b(whole.tobytes(), digest_size=8).digest(), "<u8")[0]
    return out
