import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.llm import packing, pieces, token_files
from barloom.llm.tokens import word_encoder
from tests.llm.llm_data import clashing, docs_of, odd_rows, prose

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "It's DON'T x'S. !., a,. <|endoftext|>. <|ENDOFTEXT|> H̱ İstanbul ﬁ 日本語 １２ 12.5 ... é. é.",
         "x y\x1c z\x85q ªº µm ÿ ÐÞ ñ,,, ́x", "a\x00b ﻿ ​ ΑΣ Σ ẞ", "word.word word... Word,", prose(3)]


def library_ids(text, end):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_encode_like_whole_texts():
    starts, ids = word_encoder(WORDS).encode(pa.array(TEXTS))
    for i, text in enumerate(TEXTS):
        assert list(ids[starts[i]:starts[i + 1]]) == library_ids(text, 0)[:-1]


def test_token_files_give_back_the_ids(spark, tmp_path):
    rows = [(i * 7 % 40, prose(i, i % 9 + 1)) for i in range(40)] + [(50, None), (51, ""), (52, "a b")]
    docs = clashing(docs_of(spark, rows).repartition(5))
    made = token_files.write_token_files(docs, str(tmp_path), WORDS, end_id=2, length=64, bytes_per_file=3000)
    assert made.count() > 3
    start, want = 0, []
    for i, text in sorted(rows):
        ids = library_ids(text, 2)
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    got = token_files.read_documents(made).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want


def test_token_files_are_cut_into_equal_sequences(spark, tmp_path):
    rows = [(i, prose(i, 3)) for i in range(6)]
    made = token_files.write_token_files(docs_of(spark, rows), str(tmp_path), WORDS, 2, length=100).collect()
    assert len(made) == 1
    ids = np.concatenate([library_ids(t, 2) for _, t in rows])
    file = token_files.TokenFile(made[0]["path"])
    assert made[0]["sequences"] == -(-len(ids) // 100)
    for i in range(made[0]["sequences"]):
        own = ids[i * 100:(i + 1) * 100]
        assert list(file.sequence(i)[:len(own)]) == list(own) and file.mask(i).sum() == len(own)
    kinds = file.reader.schema
    assert kinds.field("ids").type.list_size == kinds.field("mask").type.list_size == 100


def test_token_files_of_odd_rows(spark, tmp_path):
    got = token_files.read_documents(token_files.write_token_files(
        docs_of(spark, odd_rows()), str(tmp_path / "a"), WORDS, 2)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, -4, 3, 5, 6, 7, 7, 8, 8, 9, 10, 12]
    assert [r["n_tokens"] for r in got if r["doc_id"] in (3, 5, 6)] == [1, 1, 1]
    none = token_files.write_token_files(docs_of(spark, []), str(tmp_path / "b"), WORDS, 2)
    assert none.count() == 0 and token_files.read_documents(none).count() == 0


def test_pieces_of_power_of_two_length(spark):
    rows = [(100 + i, prose(i, 12 * (i % 3 + 1), 20)) for i in range(9)] + odd_rows()
    got = packing.pack(clashing(docs_of(spark, rows)), WORDS, end_id=1, most=256).collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    assert all(r["length"] <= 256 and r["length"] & (r["length"] - 1) == 0 and r["offset"] == 0 for r in got)
    assert all(len(r["ids"]) == 4 * r["length"] for r in got)
    want = sorted((str(i), list(library_ids(t, 1))) for i, t in rows)
    whole = {}
    for r in got:
        whole.setdefault((str(r["doc_id"]), r["doc_tokens"]), []).append(r)
    rebuilt = []
    for (i, n), own in whole.items():
        copies = sorted(own, key=lambda r: (r["sequence_id"]))
        starts = sorted({r["start"] for r in own})
        ids = [np.frombuffer(next(r["ids"] for r in copies if r["start"] == s), "<u4") for s in starts]
        assert sum(map(len, ids)) == n
        rebuilt.append((i, list(np.concatenate(ids))))
    assert sorted(rebuilt) == [w for k, w in enumerate(want) if w not in want[:k]]
    one = [r for r in got if r["doc_id"] == 3]
    assert [(r["length"], r["doc_tokens"]) for r in one] == [(1, 1)]
    assert packing.pack(docs_of(spark, []), WORDS, 1).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs_of(spark, []), WORDS, 1, most=100)


def best_score(coder, scores, text):
    """The best cut's score by trying all pieces at all places."""
    best = [0.0] + [-math.inf] * len(text)
    for i in range(len(text)):
        if text[i] not in coder.alone:
            best[i + 1] = max(best[i + 1], best[i] + coder.unknown_score)
        for n in range(1, min(50, len(text) - i) + 1):
            if (s := scores.get(text[i:i + n])) is not None:
                best[i + n] = max(best[i + n], best[i] + s)
    return best[-1]


def test_cuts_are_best_and_decode_to_the_text():
    coder = pieces.piece_coder(PIECES)
    scores = {w: v[1] for w, v in coder.automaton.items()}
    value = {v[2]: v[1] for _, v in coder.automaton.items()}
    texts = [t.replace("\x00", "") for t in TEXTS] + ["a  b ", "  x", "😀 z\n\n y", " " * 30 + "q"]
    starts, ids = coder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        own = ids[starts[i]:starts[i + 1]]
        assert coder.decode(own) == text
        marked = pieces.MARK + text.replace(" ", pieces.MARK) if text else ""
        unknown = sum(c not in coder.alone for c in marked)
        total = sum(value[k] for k in own.tolist() if k in value) + unknown * coder.unknown_score
        assert total == pytest.approx(best_score(coder, scores, marked), abs=1e-6)


def test_round_trip_of_odd_rows(spark):
    docs = clashing(docs_of(spark, odd_rows()))
    got = pieces.round_trip(docs, PIECES).collect()
    assert len(got) == len(odd_rows()) and all(r["decoded_same"] for r in got)
    assert [r["n_ids"] for r in got if r["doc_id"] in (3, 5)] == [0, 0]
    encoded = pieces.encode(docs, PIECES)
    back = pieces.decode(encoded, PIECES).where(F.col("doc_id") == 10).first()
    assert back["text"] == "x y\n" * 3_000
    assert pieces.round_trip(docs.limit(0), PIECES).count() == 0


def test_buckets_hold_one_length_each(spark, tmp_path):
    rows = [(i, prose(i, 3 + i)) for i in range(6)] + odd_rows()
    pieces_ = packing.pack(docs_of(spark, rows), WORDS, end_id=1, most=256)
    packing.write_buckets(pieces_, str(tmp_path / "buckets"))
    want = sorted((r["length"], r["sequence_id"], bytes(r["ids"])) for r in pieces_.collect())
    back = []
    for folder in (tmp_path / "buckets").glob("length=*"):
        length = int(folder.name.split("=")[1])
        for r in spark.read.parquet(str(folder)).collect():
            assert len(r["ids"]) == 4 * length
            back.append((length, r["sequence_id"], bytes(r["ids"])))
    assert sorted(back) == want
    packing.write_buckets(packing.pack(docs_of(spark, []), WORDS, 1), str(tmp_path / "none"))
    assert not list((tmp_path / "none").glob("length=*"))
