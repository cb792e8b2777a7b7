import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barloom.llm import quality_model, toxicity
from barloom.llm.labelled import labelled_sample, remainder
from tests.llm.llm_data import clashing, docs_of, odd_rows, prose


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(n=240):
    """Junk has bars between its words; a toxic text has one sentence with a bad word."""
    r, rows, labels = random.Random(1), [], []
    for i in range(n):
        text, junk, bad = prose(i, 5), i % 4 == 0, i % 3 == 0
        if junk:
            text = text.replace(" ", " | ")
        if bad:
            parts = text.split("\n")
            parts[r.randrange(len(parts))] += f" so {r.choice(['grobble', 'snark'])} here."
            text = "\n".join(parts)
        rows.append((i, text))
        labels.append((i, int(not junk), int(bad)))
    return rows, labels


def test_quality_on_held_out_documents(spark):
    rows, labels = corpus()
    docs, held_out = clashing(docs_of(spark, rows)).drop("score"), remainder(F.col("doc_id"), 3) == 1
    model = quality_model.train(docs, labels_of(spark, labels), ~held_out)
    truth = {i: q for i, q, _ in labels}
    got = quality_model.add_score(docs, model).where(held_out).collect()
    assert len(got) > 50 and all((r["score"] >= 0.5) == truth[r["doc_id"]] for r in got)
    kept = quality_model.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.where(held_out).collect()} == {r["doc_id"] for r in got if truth[r["doc_id"]]}


def test_scores_are_dot_products(spark):
    rows, labels = corpus(60)
    docs = docs_of(spark, rows + odd_rows())
    model = quality_model.train(docs, labels_of(spark, labels), F.lit(True))
    scored = quality_model.add_score(docs.select("doc_id", "text"), model).collect()
    assert len(scored) == len(rows) + len(odd_rows())
    for r in scored:
        words = re.sub(quality_model.PUNCTUATION, r" \1 ", r["text"] or "").split()
        _, slots = quality_model.grams(pa.array([r["text"] or ""]))
        assert len(slots) == max(0, 2 * len(words) - 1)
        want = model.bias + sum(float(model.weights[s]) for s in slots) / max(1, len(slots)) ** 0.5
        assert abs(r["score"] - 1 / (1 + np.exp(-want))) < 1e-9


def test_without_labels(spark):
    docs, none = docs_of(spark, odd_rows()), labels_of(spark, [])
    quality = quality_model.train(docs, none, F.lit(True))
    assert {r["score"] for r in quality_model.add_score(docs, quality).collect()} == {0.5}
    toxic = toxicity.train(docs, none, F.lit(True))
    assert all(r["score"] < 1e-6 for r in toxicity.score(docs, toxic).collect())
    assert quality_model.add_score(docs.limit(0), quality).count() == 0
    assert toxicity.score(docs.limit(0), toxic).count() == 0


def test_toxic_sentences_are_located(spark):
    rows, labels = corpus(400)
    docs, held_out = clashing(docs_of(spark, rows)), remainder(F.col("doc_id"), 4) == 2
    model = toxicity.train(docs, labels_of(spark, labels), ~held_out)
    truth, text = {i: t for i, _, t in labels}, dict(rows)
    got = toxicity.score(docs, model).where(held_out).collect()
    assert len(got) > 60
    for r in got:
        assert (r["score"] >= toxicity.TOXIC_FROM) == truth[r["doc_id"]]
        told = [text[r["doc_id"]][s["start"]:s["end"]] for s in r["offending"]]
        assert len(told) == truth[r["doc_id"]]
        assert all("grobble" in s or "snark" in s for s in told)


def test_texts_are_toxic_unless_every_sentence_is_clean():
    p = np.array([0.1, 0.5, 0.0, 0.2])
    assert np.allclose(toxicity.noisy_or(p, np.array([0, 2, 2, 4])), [1 - 0.9 * 0.5, 0, 0.2])


def test_sample_is_bounded_and_settles_repeated_labels(spark):
    docs = docs_of(spark, [(i, str(i)) for i in range(20)] + [(None, "n")])
    labels = labels_of(spark, [(i, i % 2, None) for i in range(20)] + [(1, 0, 0), (1, 0, 0), (None, 1, 1), (99, 1, 1)])
    got = labelled_sample(docs, labels, "quality", F.lit(True), 100).collect()
    assert {r["doc_id"]: r["label"] for r in got} == {i: i % 2 if i != 1 else 0 for i in range(20)}
    few = labelled_sample(docs.repartition(3), labels, "quality", F.lit(True), 5).collect()
    assert {r["doc_id"] for r in few} <= set(range(20)) and 0 < len(few) <= 5
    assert labelled_sample(docs, labels, "toxic", F.lit(True), 100).count() == 1
