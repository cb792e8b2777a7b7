"""Toxic texts and the sentences that make them so, learned from labels of whole texts.

Multiple-instance learning: a text is a bag of sentences. Each sentence has a chance
p = logistic(bias + weights of its words
and of their beginnings), and a text is toxic unless every sentence
is clean (noisy-or): 1 - product of (1 - p). Both sets of numbers are fitted to the
labels of texts; the fitted p then tell which sentences offend.

A null or empty text has no sentences and scores 0. Without labelled documents every
score is 0. Rows with equal ids are scored one by one; null ids stay.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.labelled import labelled_sample
from barloom.llm.words import hashes, map_texts, mixed, slices, split_words, sums, texts_of
from barloom.session import stored

SLOTS = 1 << 18
# The labelled documents that training looks at, at most.
SAMPLE = 12_000
# A word counts only if so many of them have it.
LEAST_DOCUMENTS = 4
# ... and so many standard deviations more of the toxic ones than its share.
DEVIATIONS = 4.0
# So many letters of a word are its beginning.
HEAD = 6
TOXIC_FROM = 0.3
OFFENDING_FROM = 0.3

# One character ends a sentence, so that places can be told; most sentences between marks are empty.
ENDS = r"[.!?\n]"
MARKS = r"[\"-\-/:->@\[-`{-~]+"


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float


@dataclass
class Sentences:
    """Sentences of texts and their words' slots, each as starts into the next."""

    texts: np.ndarray
    words: np.ndarray
    slots: np.ndarray
    sizes: np.ndarray


def sentences_of(texts: pa.Array) -> Sentences:
    cut = pc.split_pattern_regex(texts, ENDS)
    offsets = np.asarray(cut.offsets, dtype=np.int64)
    flat = cut.flatten()
    words = split_words(pc.replace_substring_regex(pc.utf8_lower(flat), MARKS, " "))
    slots = np.zeros(0, np.int64)
    if len(words.codes):
        # A word stands for itself and for all words that begin like it.
        heads = pc.utf8_slice_codeunits(words.distinct, 0, HEAD)
        both = np.stack([mixed(hashes(words.distinct), 7), mixed(hashes(heads), 8)], axis=1)
        slots = (both % np.uint64(SLOTS)).astype(np.int64)[words.codes].ravel()
    return Sentences(offsets - offsets[0], 2 * words.starts, slots,
                     np.asarray(pc.utf8_length(flat), dtype=np.int64))


def sentence_scores(found: Sentences, model: ToxicityModel) -> np.ndarray:
    """p of every sentence; one without words is clean."""
    x = np.clip(model.bias + sums(model.weights[found.slots], found.words), -30, 25)
    return (np.diff(found.words) > 0) / (1 + np.exp(-x))


def noisy_or(p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return -np.expm1(sums(np.log1p(-p), starts))


def telling_slots(chosen: DataFrame) -> np.ndarray:
    """Which slots stand in toxic texts more often than chance explains.

    All others keep weight 0: most words are in few texts, and would learn those by heart.
    Counted on the executors; the slots that tell, at most all, come to the driver.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = sentences_of(texts_of(batch, "text"))
        owners = np.repeat(np.repeat(np.arange(len(batch)), np.diff(found.texts)), np.diff(found.words))
        pairs = np.unique(owners * SLOTS + found.slots)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs % SLOTS, pa.int32()), batch.column("label").take(pa.array(pairs // SLOTS))],
            names=["slot", "label"])

    every = chosen.agg(F.avg("label")).first()[0]
    if every is None:
        return np.zeros(0, np.int64)
    rate = min(max(every, 1e-6), 1 - 1e-6)
    seen = map_texts(chosen, work, "slot int, label int").groupBy("slot").agg(
        F.count("*").alias("texts"), F.sum("label").alias("toxic"))
    told = seen.where((F.col("texts") >= LEAST_DOCUMENTS) & (
        F.col("toxic") - F.col("texts") * rate >= DEVIATIONS * F.sqrt(F.col("texts") * rate * (1 - rate))))
    return np.sort(told.select("slot").toArrow().column("slot").to_numpy().astype(np.int64))


def fit(labels: np.ndarray, found: Sentences, n: int, steps: int = 150, rate: float = 0.1,
        l2: float = 3e-5) -> tuple[np.ndarray, float]:
    """Weights of ``n`` slots and the bias that minimise the texts' log loss, by Adam steps.

    A sentence is known by its telling words alone; ``found.sizes`` tells which have words.
    """
    owners = np.repeat(np.arange(len(labels)), np.diff(found.texts))
    of_word = np.repeat(np.arange(len(owners)), np.diff(found.words))
    spoken = found.sizes > 0
    per_text = max(1.0, spoken.sum() / len(labels))
    x = np.append(np.zeros(n), np.log(np.clip(labels.mean(), 1e-3, 0.5) / per_text))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    toxic = labels[owners] == 1
    for step in range(1, steps + 1):
        p = spoken / (1 + np.exp(-np.clip(x[-1] + sums(x[found.slots], found.words), -30, 25)))
        whole = np.clip(noisy_or(p, found.texts), 1e-9, 1)[owners]
        pull = np.where(toxic, -p * (1 - whole) / whole, p)
        g = np.append(np.bincount(found.slots, weights=pull[of_word], minlength=n), pull.sum()) / len(labels)
        g[:-1] += l2 * x[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return x[:-1], float(x[-1])


def train(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> ToxicityModel:
    """Train on at most ``sample`` documents whose ids satisfy ``usable``.

    Their telling slots, not their texts, come to the driver.
    """
    chosen = stored(labelled_sample(docs, labels, "toxic", usable, sample), "toxic-sample")
    telling = telling_slots(chosen)
    shared = docs.sparkSession.sparkContext.broadcast(telling)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = sentences_of(texts_of(batch, "text"))
        known = shared.value
        at = np.searchsorted(known, found.slots)
        kept = known[np.minimum(at, len(known) - 1)] == found.slots if len(known) else found.slots < 0
        starts = np.concatenate([[0], np.cumsum(kept)])[found.words]
        words = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(at[kept], pa.int32()))
        bags = pa.StructArray.from_arrays([words, pa.array(np.diff(found.words), pa.int32())], ["slots", "n"])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"),
             pa.ListArray.from_arrays(pa.array(found.texts, pa.int32()), bags)],
            names=["doc_id", "label", "sentences"])

    got = map_texts(chosen, work, "doc_id long, label int, "
                    "sentences array<struct<slots: array<int>, n: int>>").toArrow()
    if not got.num_rows:
        return ToxicityModel(np.zeros(SLOTS), -30.0)
    got = got.take(pc.sort_indices(got, [("doc_id", "ascending")])).combine_chunks()
    bags = got.column("sentences").chunk(0)
    texts, flat = np.asarray(bags.offsets, np.int64), bags.flatten()
    lists = flat.field("slots")
    words = np.asarray(lists.offsets, np.int64)
    found = Sentences(texts - texts[0], words - words[0], lists.flatten().to_numpy().astype(np.int64),
                      flat.field("n").to_numpy())
    own, bias = fit(got.column("label").to_numpy(), found, len(telling))
    weights = np.zeros(SLOTS)
    weights[telling] = own
    return ToxicityModel(weights, bias)


def score(docs: DataFrame, model: ToxicityModel, least: float = OFFENDING_FROM) -> DataFrame:
    """Per document: doc_id, score and the sentences with p >= ``least`` (start, end, p).

    Starts and ends count code points, the end is exclusive.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = sentences_of(texts_of(batch, "text"))
        p = sentence_scores(found, shared.value)
        ends = np.cumsum(found.sizes + 1)
        owners = np.repeat(np.arange(len(batch)), np.diff(found.texts))
        begun = np.concatenate([[0], ends])[found.texts[:-1]]
        bad = np.flatnonzero(p >= least)
        first = begun[owners[bad]]
        spans = pa.StructArray.from_arrays(
            [pa.array(ends[bad] - 1 - found.sizes[bad] - first), pa.array(ends[bad] - 1 - first),
             pa.array(p[bad])], fields=list(span))
        starts = np.concatenate([[0], np.cumsum(np.bincount(owners[bad], minlength=len(batch)))])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(noisy_or(p, found.texts)),
             pa.ListArray.from_arrays(pa.array(starts, pa.int32()), spans)],
            names=["doc_id", "score", "offending"])

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return map_texts(chosen, work, "doc_id long, score double, "
                     "offending array<struct<start: long, end: long, score: double>>")
