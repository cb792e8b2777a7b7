"""Token ids of a corpus in Arrow files of equal-length sequences.

A corpus becomes numbered pairs of Arrow files (random-access "file" format):
``tokens-N.arrow`` has batches of two fixed-size-list columns, ``ids`` and ``mask``
(false where the file's last sequence is filled up), and ``documents-N.arrow`` says
where each document starts. Both columns are plain buffers, so sequence i is found
by division and a local file is read through a memory map without copying.

Documents follow each other in ascending id, across files too; a null id comes first,
rows with equal ids follow in the order of their token ids. A null text is empty and
has the end id alone. An empty table makes no files. Other columns are not looked at.
"""

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.tokens import word_encoder
from barloom.llm.words import freeing, map_texts, texts_of
from barloom.session import stored

LENGTH = 2048
SEQUENCES_PER_BATCH = 512
TEXT_BYTES_PER_FILE = 64 << 20

_ENCODED = "file int, doc_id long, ids binary"
_MANIFEST = "file int, path string, documents long, sequences long, tokens long"
_FOUND = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _place(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def first_ids(docs: DataFrame, bytes_per_file: int) -> list[int]:
    """The smallest document id of every file but the first.

    Like a range partitioner's bounds: one number per output file on the driver.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // bytes_per_file))
    if files == 1:
        return []
    dealt = docs.select("doc_id").repartitionByRange(files, "doc_id")
    firsts = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min("doc_id").alias("first"))
    return sorted(r["first"] for r in firsts.collect() if r["first"] is not None)[1:]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int,
                      length: int = LENGTH, bytes_per_file: int = TEXT_BYTES_PER_FILE) -> DataFrame:
    """Write ``docs(doc_id, text)`` below ``folder``; returns one row per written file."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    bounds = np.array(first_ids(docs, bytes_per_file), dtype=np.int64)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = word_encoder(tokenizer)
        starts, ids = encoder.encode(texts_of(batch, "text"))
        # One end id behind every document.
        ids = np.insert(ids, starts[1:], end_id)
        ends = (starts + np.arange(len(starts))) * encoder.dtype.itemsize
        keys = batch.column("doc_id")
        file = np.searchsorted(bounds, np.asarray(keys.fill_null(-(1 << 63))), side="right")
        return pa.RecordBatch.from_arrays(
            [pa.array(file, pa.int32()), keys,
             pa.Array.from_buffers(pa.binary(), len(batch),
                                   [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])],
            names=["file", "doc_id", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                writer = _FileWriter(folder, batch.column("file")[0].as_py(), length,
                                     word_encoder(tokenizer).dtype)
            writer.add(batch)
        if writer is not None:
            yield writer.close()

    files = len(bounds) + 1
    dealt = map_texts(docs, encode, _ENCODED).repartitionById(files, "file")
    rows = dealt.sortWithinPartitions("doc_id", "ids").mapInArrow(freeing(write), _MANIFEST)
    return stored(rows, "token-files")


class _FileWriter:
    """Writes one pair of files; a failed or repeated task leaves the same finished pair."""

    def __init__(self, folder: str, file: int, length: int, dtype: np.dtype):
        self.fs, top = _place(folder)
        self.fs.create_dir(top, recursive=True)
        self.file, self.length, self.dtype = file, length, dtype
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        self.names = {kind: (f"{top}/_{kind}-{file:06d}-{attempt}", f"{top}/{kind}-{file:06d}.arrow")
                      for kind in ("tokens", "documents")}
        self.uri = f"{folder}/tokens-{file:06d}.arrow"
        kinds = [pa.list_(pa.from_numpy_dtype(dtype), length), pa.list_(pa.bool_(), length)]
        self.schemas = {
            "tokens": pa.schema([pa.field("ids", kinds[0], False), pa.field("mask", kinds[1], False)]),
            "documents": pa.schema([("doc_id", pa.int64()), ("start", pa.int64()),
                                    ("n_tokens", pa.int64())])}
        self.streams = {k: self.fs.open_output_stream(n[0]) for k, n in self.names.items()}
        self.writers = {k: pa.ipc.new_file(s, self.schemas[k]) for k, s in self.streams.items()}
        self.waiting: list[np.ndarray] = []
        self.held = self.tokens = self.sequences = self.documents = 0

    def add(self, batch: pa.RecordBatch) -> None:
        column = batch.column("ids")
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(batch) + 1]
        ids = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(self.dtype)
        sizes = np.diff(ends) // self.dtype.itemsize
        starts = self.tokens + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        self.writers["documents"].write_batch(pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(starts[:-1]), pa.array(sizes, pa.int64())],
            schema=self.schemas["documents"]))
        self.tokens, self.documents = int(starts[-1]), self.documents + len(batch)
        self.waiting.append(ids.copy())
        self.held += len(ids)
        if self.held >= SEQUENCES_PER_BATCH * self.length:
            self._write(SEQUENCES_PER_BATCH)

    def _write(self, per_batch: int, last: bool = False) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.dtype)
        whole = -(-len(ids) // self.length) if last else len(ids) // (per_batch * self.length) * per_batch
        used = min(len(ids), whole * self.length)
        for first in range(0, whole, per_batch):
            n = min(per_batch, whole - first)
            part = ids[first * self.length:(first + n) * self.length]
            mask = np.arange(n * self.length) < len(part)
            full = np.concatenate([part, np.zeros(n * self.length - len(part), self.dtype)])
            self.writers["tokens"].write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(full), type=self.schemas["tokens"][0].type),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schemas["tokens"][1].type)],
                schema=self.schemas["tokens"]))
        self.sequences += whole
        self.waiting, self.held = [ids[used:].copy()], len(ids) - used

    def close(self) -> pa.RecordBatch:
        self._write(SEQUENCES_PER_BATCH, last=True)
        for kind, (draft, name) in self.names.items():
            self.writers[kind].close()
            self.streams[kind].close()
            self.fs.move(draft, name)
        return pa.RecordBatch.from_pylist(
            [{"file": self.file, "path": self.uri, "documents": self.documents,
              "sequences": self.sequences, "tokens": self.tokens}],
            schema=pa.schema([("file", pa.int32()), ("path", pa.string()), ("documents", pa.int64()),
                              ("sequences", pa.int64()), ("tokens", pa.int64())]))


class TokenFile:
    """Random access to one pair of files; arrays are views of the file where it is local."""

    def __init__(self, uri: str):
        fs, path = _place(uri)
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        opened = pa.memory_map(path) if local else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(opened)
        head, name = path.rsplit("/", 1)
        with fs.open_input_file(f"{head}/{name.replace('tokens-', 'documents-')}") as f:
            self.documents = pa.ipc.open_file(f).read_all()
        self.length = self.reader.schema.field("ids").type.list_size

    def _column(self, k: int, name: str) -> pa.Array:
        return self.reader.get_batch(k).column(name)

    def sequence(self, i: int) -> np.ndarray:
        k, at = divmod(i, SEQUENCES_PER_BATCH)
        return self._column(k, "ids").flatten().to_numpy()[at * self.length:(at + 1) * self.length]

    def mask(self, i: int) -> np.ndarray:
        k, at = divmod(i, SEQUENCES_PER_BATCH)
        flat = self._column(k, "mask").flatten()
        return flat.slice(at * self.length, self.length).to_numpy(zero_copy_only=False)

    def parts(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids start .. start + n of the file, batch by batch."""
        size = SEQUENCES_PER_BATCH * self.length
        while n:
            k, at = divmod(start, size)
            take = min(n, size - at)
            yield self._column(k, "ids").flatten().to_numpy()[at:at + take]
            start, n = start + take, n - take


def read_documents(manifest: DataFrame) -> DataFrame:
    """Every document of written files, read back: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over all files.
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    asked = manifest.select("file", "path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["path"])
                for docs in file.documents.to_batches():
                    starts, sizes = (docs.column(c).to_numpy() for c in ("start", "n_tokens"))
                    crcs = []
                    for start, n in zip(starts.tolist(), sizes.tolist()):
                        crc = 0
                        for part in file.parts(start, n):
                            crc = zlib.crc32(part.astype("<u4"), crc)
                        crcs.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [docs.column("doc_id"), pa.array(starts + row["before"]), pa.array(sizes),
                         pa.array(crcs, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.agg(F.max("file")).first()[0] or 0) + 1
    return asked.repartitionById(n, "file").mapInArrow(freeing(read), _FOUND)
