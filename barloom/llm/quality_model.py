"""Quality of texts: logistic regression on hashed word n-grams, trained online.

Words and runs of punctuation, and pairs of neighbours (all pairs of equal ones as one),
are hashed to 2**20 slots; a text of n such grams has 1 / sqrt(n) in a slot for each occurrence. The weights follow
the regularised leader (FTRL-proximal) over a bounded sample of labelled documents; a
score is the sparse dot product through the logistic function.

A null or empty text has no grams and scores what the bias says. Without labelled
documents every score is 0.5. Rows with equal ids are scored one by one; null ids stay.
"""

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from barloom.llm.labelled import labelled_sample
from barloom.llm.words import (
    free_name, freeing, hashes, map_texts, mixed, slices, split_words, sums, texts_of,
)

SLOTS = 1 << 20
# The labelled documents that training looks at, at most.
SAMPLE = 10_000
KEEP_FROM = 0.5
# Words looked at together.
PORTION = 1 << 17
PUNCTUATION = r"([!-/:-@\[-`{-~]+)"


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's grams start (one more entry than texts), and the slots of all grams."""
    words = split_words(pc.replace_substring_regex(texts, PUNCTUATION, r" \1 "))
    codes, n = words.codes, np.diff(words.starts)
    if not len(codes):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int32)
    h = hashes(words.distinct)
    alone = (mixed(h, 1) % np.uint64(SLOTS)).astype(np.int32)
    before, behind = h * np.uint64(3), mixed(h, 2)
    starts = np.concatenate([[0], np.cumsum(2 * n - (n > 0))])
    # A word stands at every second place of its text, the pair with its successor after it.
    shift = np.repeat(starts[:-1] - 2 * words.starts[:-1], n)
    last = np.zeros(len(codes), bool)
    last[words.starts[1:][n > 0] - 1] = True
    slots = np.empty(starts[-1], np.int32)
    for first in range(0, len(codes), PORTION):
        mine = np.arange(first, min(first + PORTION, len(codes)))
        slots[shift[mine] + 2 * mine] = alone[codes[mine]]
        mine = mine[~last[mine]]
        a, b = codes[mine], codes[mine + 1]
        pairs = mixed(before[a] + behind[b], 3)
        pairs[a == b] = 0  # a word said twice is one gram, whatever the word
        slots[shift[mine] + 2 * mine + 1] = pairs % np.uint64(SLOTS)
    return starts, slots


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Each text's different slots, how often it has them, and how many grams it has."""
    starts, slots = grams(texts_of(batch, "text"))
    n = np.diff(starts)
    pairs, counts = np.unique(np.repeat(np.arange(len(n)), n) * SLOTS + slots, return_counts=True)
    ends = pa.array(np.searchsorted(pairs, np.arange(len(n) + 1) * SLOTS), pa.int32())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("label"), pa.array(n, pa.int64()),
         pa.ListArray.from_arrays(ends, pa.array(pairs % SLOTS, pa.int32())),
         pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))],
        names=["doc_id", "label", "n", "slots", "counts"])


def follow_the_leader(rows: Iterable[tuple[int, int, np.ndarray, np.ndarray]], epochs: int = 3, alpha: float = 0.3,
                      beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> QualityModel:
    """FTRL-proximal over rows of (label, grams, different slots, their counts), in the given order.

    The last slot is the bias.
    """
    z, n, w = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    cuts = [(label, np.append(slots, SLOTS).astype(np.int32),
             np.append(counts / np.sqrt(max(1, total)), 1.0).astype(np.float32))
            for label, total, slots, counts in rows]
    for _ in range(epochs):
        for label, at, x in cuts:
            zs, ns = z[at], n[at]
            ws = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2)
            ws[np.abs(zs) <= l1] = 0
            g = (1 / (1 + np.exp(-np.clip(ws @ x, -30, 30))) - label) * x
            grown = ns + g * g
            z[at] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / alpha * ws
            n[at] = grown
    w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    w[np.abs(z) <= l1] = 0
    return QualityModel(w[:-1].astype(np.float32), float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> QualityModel:
    """Train on at most ``sample`` documents whose ids satisfy ``usable``.

    Their different slots with counts, not their texts, come to the driver: 8 bytes for each, at most
    ``SLOTS`` of them for a text of any length.
    """
    chosen = labelled_sample(docs, labels, "quality", usable, sample)
    found = map_texts(chosen, _features, "doc_id long, label int, n long, slots array<int>, counts array<int>")
    got = found.toArrow().combine_chunks()
    ids, label, total = (got.column(c).to_numpy() for c in ("doc_id", "label", "n"))
    slots, counts = got.column("slots"), got.column("counts")
    # By a hash of the id: no run of one source or label.
    order = np.lexsort((total, ids, mixed(ids.astype(np.uint64), 5)))
    return follow_the_leader((int(label[i]), int(total[i]), slots[int(i)].values.to_numpy(),
                              counts[int(i)].values.to_numpy()) for i in order)


def add_score(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score, 0 to 1, as a double called ``name``."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {name} already")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, "text"):
            starts, slots = grams(texts_of(batch, "text"))
            known = shared.value
            size = np.sqrt(np.maximum(1, np.diff(starts)))
            score = 1 / (1 + np.exp(-(known.bias + sums(known.weights[slots].astype(np.float64), starts) / size)))
            yield batch.append_column(name, pa.array(score))

    return docs.mapInArrow(freeing(run), StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def keep_good(docs: DataFrame, model: QualityModel, least: float = KEEP_FROM) -> DataFrame:
    """The documents that score ``least`` or more, unchanged."""
    name = free_name(docs, "quality_score")
    return add_score(docs, model, name).where(F.col(name) >= least).drop(name)
