"""Sequences that never cross documents: every document is cut at powers of two.

A document of n ids becomes n // most pieces of ``most`` ids and, of the rest, one
piece for each bit of its length, longest first. Each piece is a sequence of its own
and the sequences of one length form a bucket, so a batch from a bucket has no
padding and no attention across documents.

A null text is empty and has the end id alone; a null id stays null; rows with equal
ids are packed one by one. An empty table gives no pieces. Other columns are not
looked at.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.tokens import word_encoder
from barloom.llm.words import freeing, slices, texts_of

MOST = 2048
_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, ids binary"


def cut(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For documents of ``sizes`` ids: the document and the length of every piece, in order."""
    lengths = most >> np.arange(most.bit_length())
    counts = np.empty((len(sizes), len(lengths)), dtype=np.int64)
    counts[:, 0] = sizes // most
    counts[:, 1:] = (sizes[:, None] // lengths[1:]) & 1
    owners = np.repeat(np.arange(len(sizes)), counts.sum(axis=1))
    return owners, np.repeat(np.tile(lengths, len(sizes)), counts.ravel())


def pack(docs: DataFrame, tokenizer: str, end_id: int, most: int = MOST) -> DataFrame:
    """The pieces of ``docs(doc_id, text)``; ``ids`` holds unsigned little-endian 32-bit numbers.

    ``sequence_id`` is bucket, task and place in the task's bucket in one number, so
    equal lengths have neighbouring ids and numbering needs no shuffle. It is the same
    for any run over the same files.
    """
    if most & (most - 1) or most < 1:
        raise ValueError("the longest sequence must be a power of two")
    bits = most.bit_length()

    def run(batches):
        part = TaskContext.get().partitionId()
        made = np.zeros(bits, dtype=np.int64)
        for batch in slices(batches, "text"):
            starts, ids = word_encoder(tokenizer).encode(texts_of(batch, "text"))
            ids = np.insert(ids, starts[1:], end_id).astype("<u4")
            sizes = np.diff(starts) + 1
            owners, lengths = cut(sizes, most)
            ends = np.cumsum(lengths)
            doc_starts = np.concatenate([[0], np.cumsum(sizes)])
            bucket = np.log2(lengths).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            held = np.bincount(bucket, minlength=bits)
            place = np.empty(len(bucket), np.int64)
            place[order] = np.arange(len(bucket)) - np.repeat(np.cumsum(held) - held, held)
            place += made[bucket]
            made += held
            offsets = np.concatenate([[0], ends]).astype(np.int32) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owners)),
                 pa.array(ends - lengths - doc_starts[owners]), pa.array(lengths),
                 pa.array(sizes[owners]), pa.array((bucket << 58) + (part << 34) + place),
                 pa.Array.from_buffers(pa.binary(), len(lengths),
                                       [None, pa.py_buffer(offsets), pa.py_buffer(ids)])],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "ids"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(freeing(run), _PIECES).withColumn("offset", F.lit(0).cast("long")))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder for each length."""
    pieces.write.partitionBy("length").parquet(path)
