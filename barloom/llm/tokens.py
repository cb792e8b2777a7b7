"""Token ids of whole texts by a public tokenizer file, one encoding per distinct word.

For tokenizers whose pre-tokenizer drops white space, the ids of a text are the ids
of its words, one after the other: no rule of the file reaches across white space.
So a slice's distinct words go through the tokenizers library once, and frequent
ones stay in a bounded store until the task ends.
"""

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from barloom.llm.words import gather, split_words, task_store

# Bytes of words and ids that a task keeps, about; when full, it starts anew.
KEPT_BYTES = 24 << 20
# What an entry takes beside its letters and ids.
ENTRY_BYTES = 150
# A letter of Latin-1, then dots or commas up to the word's end: always two tokens apart.
STOPS = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,]+)$"
PLAIN = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+$"

_encoders: dict[str, "WordEncoder"] = {}


def word_encoder(path: str) -> "WordEncoder":
    """The encoder of a tokenizer file in this Python process."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class WordEncoder:
    """Ids of texts under a ``tokenizers`` file that lower-cases and drops white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.kept: dict[str, bytes] = task_store()
        self.held = 0
        # What the byte-level pre-tokenizer makes of the lower-case letters of Latin-1.
        self.bytes_of = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))[0][0]
                         for c in range(0xC0, 0x100) if chr(c).isalpha()}

    def _ids(self, words: list[str], plain: list[bool]) -> list[bytes]:
        """The ids of words, as bytes. Words of Latin-1 letters alone need only the library's model."""
        tokenize, pack = self.tokenizer.model.tokenize, lambda ids: np.array(ids, self.dtype).tobytes()
        rest = [w for w, p in zip(words, plain) if not p]
        whole = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        size, order = self.dtype.itemsize, "little"
        out = []
        for w, p in zip(words, plain):
            if p:
                w = w.lower()
                found = tokenize(w if w.isascii() else w.translate(self.bytes_of))
                out.append(b"".join([t.id.to_bytes(size, order) for t in found]))
            else:
                out.append(pack(next(whole).ids))
        return out

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an array of distinct words: where each starts, and all ids."""
        listed = words.to_pylist()
        new = [w for w in listed if w not in self.kept]
        if new:
            plain = pc.match_substring_regex(pa.array(new, pa.string()), PLAIN).to_pylist()
            made = self._ids(new, plain)
            size = sum(map(len, new)) + sum(map(len, made)) + ENTRY_BYTES * len(new)
            self.held = size + (self.held if self.kept else 0)
            if self.held > KEPT_BYTES:
                still = {w: self.kept[w] for w in listed if w in self.kept}
                self.kept.clear()
                self.kept.update(still)
                self.held = size
            self.kept.update(zip(new, made))
        ids = [self.kept[w] for w in listed]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        return (np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
                np.frombuffer(b"".join(ids), self.dtype))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids start (one more entry than texts), and all ids."""
        words = split_words(texts)
        if not len(words.distinct):
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, self.dtype)
        # Case and final stops make many spellings of a word; the ids are put together from parts.
        simple = pc.and_(pc.string_is_ascii(words.distinct),
                         pc.invert(pc.match_substring(words.distinct, "<|")))
        folded = pc.if_else(simple, pc.ascii_lower(words.distinct), words.distinct)
        parts = split_words(pc.replace_substring_regex(folded, STOPS, r"\1 \2"))
        starts, ids = self._distinct(parts.distinct)
        part_starts, ids = gather(starts, ids, parts.codes)
        starts, ids = gather(part_starts[parts.starts], ids, words.codes)
        return starts[words.starts], ids
