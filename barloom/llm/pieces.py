"""Ids of texts by the best-scoring cut into pieces, and back.

The pieces and scores of a SentencePiece model file go into an Aho-Corasick automaton.
One pass over a text follows it: where a piece ends, the automaton's output links give
all pieces that end there, longest first, and each relaxes the best score up to that
place (Viterbi). A character without a piece becomes its bytes (or the unknown id)
at a score below every piece's, as the file's own library does it for unigram models.

White space is written as the mark U+2581 and a mark is put in front. No piece holds
a mark behind another character, so the best cut of a text is the best cuts of its
words, each with the marks before it; every distinct word of a slice is cut once.
Decoding gives the text back, except that a mark in the text itself comes back as a
space. A null or empty text has no ids. Rows with equal ids are encoded one by one.
"""

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.words import freeing, gather, map_texts, task_store, texts_of

MARK = "▁"
# Bytes of words and ids that a task keeps, about; when full, it starts anew.
KEPT_BYTES = 24 << 20
# What an entry takes beside its letters and ids.
ENTRY_BYTES = 200
_coders: dict[str, "PieceCoder"] = {}


def piece_coder(path: str) -> "PieceCoder":
    """The coder of a model file in this Python process."""
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]


class PieceCoder:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unknown = model.unk_id()
        self.bytes: list[int | None] = [None] * 256
        self.piece_bytes: list[bytes] = []
        self.automaton = ahocorasick.Automaton()
        self.alone: set[str] = set()  # characters that are pieces
        least = 0.0
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.piece_bytes.append(bytes([int(piece[3:5], 16)]))
            elif model.is_unknown(i):
                self.piece_bytes.append(" ⁇ ".encode())
            elif model.is_control(i) or model.is_unused(i):
                self.piece_bytes.append(b"")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} reaches across words")
                least = min(least, model.get_score(i))
                if len(piece) == 1:
                    self.alone.add(piece)
                self.automaton.add_word(piece, (len(piece), model.get_score(i), i))
                self.piece_bytes.append(piece.replace(MARK, " ").encode())
        self.automaton.make_automaton()
        # An unknown character scores so much less than the worst piece.
        self.unknown_score = least - 10.0
        self.kept: dict[str, bytes] = task_store()
        self.held = 0

    def cut(self, text: str) -> list[int]:
        """The ids of the best cut of a marked text. Of equal scores the longer last piece wins."""
        n = len(text)
        best = [-math.inf] * (n + 1)
        best[0] = 0.0
        back = [None] * (n + 1)
        if self.alone.issuperset(text):
            for end, match in self.automaton.iter(text):
                total = best[end + 1 - match[0]] + match[1]
                if total > best[end + 1]:
                    best[end + 1], back[end + 1] = total, match
        else:  # characters that are no pieces step on by one place
            step, done = (1, self.unknown_score, -1), 0
            ends = [*((end, match) for end, match in self.automaton.iter(text)), (n, None)]
            for end, match in ends:
                while done < end:  # no later match ends here
                    done += 1
                    if text[done - 1] not in self.alone and best[done - 1] + step[1] > best[done]:
                        best[done], back[done] = best[done - 1] + step[1], step
                if match:
                    total = best[end + 1 - match[0]] + match[1]
                    if total > best[end + 1]:
                        best[end + 1], back[end + 1] = total, match
        ids: list[int] = []
        while n:
            length, _, piece = back[n]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self._unknown(text[n - 1]))
            n -= length
        ids.reverse()
        return ids

    def _unknown(self, character: str) -> list[int]:
        """The ids of a character without a piece, last first."""
        codes = [self.bytes[b] for b in character.encode()]
        return codes[::-1] if None not in codes else [self.unknown]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids start (one more entry than texts), and all ids."""
        # A separator that stands before every run of marks cuts the text into marked words.
        marked = pc.replace_substring(texts, " ", MARK)
        marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(MARK, marked, ""))
        marked = pc.replace_substring_regex(marked, f"([^{MARK}]){MARK}", f"\\1 {MARK}")
        cut = pc.split_pattern(marked, " ")
        starts = np.asarray(cut.offsets, dtype=np.int64)
        coded = cut.flatten().dictionary_encode()
        listed = coded.dictionary.to_pylist()
        new = [w for w in listed if w not in self.kept]
        if not self.kept:
            self.held = 0
        if self.held > KEPT_BYTES:
            still = {w: self.kept[w] for w in listed if w in self.kept}
            self.kept.clear()
            self.kept.update(still)
            self.held = 0
        for w in new:
            self.kept[w] = np.array(self.cut(w), "<i4").tobytes()
            self.held += len(w) + len(self.kept[w]) + ENTRY_BYTES
        ids = [self.kept[w] for w in listed]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        word_starts, out = gather(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
                                  np.frombuffer(b"".join(ids), "<i4"),
                                  np.asarray(coded.indices, dtype=np.int64))
        return word_starts[starts - starts[0]], out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: marks become spaces, the first of them is the one put in front."""
        raw = b"".join(map(self.piece_bytes.__getitem__, ids.tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids (unsigned little-endian 32-bit numbers) of every text."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        starts, ids = piece_coder(model).encode(texts_of(batch, "text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"),
             pa.Array.from_buffers(pa.binary(), len(batch),
                                   [None, pa.py_buffer((starts * 4).astype(np.int32)),
                                    pa.py_buffer(ids.astype("<u4"))])], names=["doc_id", "ids"])

    return map_texts(_plain(docs), work, "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of ids as ``encode`` gives them."""
    def run(batches):
        coder = piece_coder(model)
        for batch in batches:
            texts = [coder.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(freeing(run), "doc_id long, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """Per document: n_ids, ids_crc32, n_byte_ids and whether decoding gives the text back."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder, texts = piece_coder(model), texts_of(batch, "text")
        starts, ids = coder.encode(texts)
        fallback = np.isin(ids, [b for b in coder.bytes if b is not None])
        raw, crcs, same = ids.astype("<u4"), [], []
        for i, text in enumerate(texts.to_pylist()):
            own = raw[starts[i]:starts[i + 1]]
            crcs.append(zlib.crc32(own))
            same.append(coder.decode(own) == text.replace(MARK, " "))
        before = np.concatenate([[0], np.cumsum(fallback)])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(starts)), pa.array(crcs, pa.int64()),
             pa.array(np.diff(before[starts])), pa.array(same)],
            names=["doc_id", "n_ids", "ids_crc32", "n_byte_ids", "decoded_same"])

    return map_texts(_plain(docs), work, "doc_id long, n_ids long, ids_crc32 long, "
                     "n_byte_ids long, decoded_same boolean")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
