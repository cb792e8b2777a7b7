import random
import re

import pytest

import corpus_pipeline
from barloom.llm import components, near_copies
from tests.llm.llm_data import clashing, docs_of, odd_rows, prose


def plain_groups(rows):
    """Components by comparing all sets."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]) > 0:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def changed(text, n, seed):
    r, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[r.randrange(len(words))] = f"w{r.randrange(10 ** 6)}"
    return " ".join(words)


def near_rows():
    """Copies, chains whose ends are not linked, a large group, and others of any likeness."""
    rows, base = [], prose(1, 12, 15)
    for i in range(60):
        rows.append((100 + i, changed(base, i % 9, i)))
    chain = prose(2, 10, 20)
    for i in range(12):
        chain = changed(chain, 2, 1000 + i)
        rows.append((300 - i, chain))
    rows += [(400 + i, prose(5)) for i in range(5)] + [(500 + i, prose(500 + i)) for i in range(30)]
    rows += [(600, "one two three"), (601, "One  two THREE"), (602, "one two"), (603, ""), (604, "é a b c d"),
             (605, "É a b c d"), (606, "a b c d e"), (607, "A B C D E")]
    return rows


@pytest.mark.parametrize("block", [256, 7])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rows = near_rows()
    got = near_copies.near_copies(clashing(docs_of(spark, rows))).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(plain_groups(rows))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_first_of_each_group_stays(spark):
    docs = clashing(docs_of(spark, near_rows()))
    kept = near_copies.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _, c in plain_groups(near_rows()) if d == c}


def test_one_text_of_a_group_stays_where_ids_tie(spark):
    base = prose(21, 12)
    near = [base + "\n" + x for x in ("one", "two", "three")]
    alone = prose(22, 12)
    # Three near copies without an id, two with one id, and that id again on a text of its own.
    rows = [(None, t) for t in near] + [(7, alone), (7, prose(23) + "."), (7, prose(23) + ". end")]
    kept = [(r["doc_id"], r["text"]) for r in near_copies.keep_first(docs_of(spark, rows), percent=80).collect()]
    assert len([t for i, t in kept if i is None]) == 1 and (7, alone) in kept
    assert len(kept) == 3
    flags = near_copies.near_copies(docs_of(spark, rows + rows), percent=80)
    assert flags.where("first").count() == 6 and not flags.where("first AND NOT kept").count()
    # Texts without a word are linked with nothing.
    blank = docs_of(spark, [(None, None), (None, ""), (None, " "), (1, "")])
    assert near_copies.keep_first(blank).count() == 4


def apart(n, seed):
    """A text of 84 different words, and one with ``n`` of its 80 shingles changed."""
    words = [f"s{seed}w{k}" for k in range(84)]
    other = words[:len(words) - n] + [f"s{seed}x{k}" for k in range(n)]
    return " ".join(words), " ".join(other)


def test_stage_drops_pairs_from_80_percent_on(spark):
    # n changed shingles of 80: a similarity of (80 - n) / (80 + n), from 0.80 to under 0.85 with 7 and 8.
    rows = []
    for seed in range(60):
        one, other = apart(6 + seed % 4, seed)
        rows += [(seed * 2, one), (seed * 2 + 1, other)]
    docs = docs_of(spark, rows)
    kept = {r["doc_id"] for r in corpus_pipeline.near(spark, docs, None).collect()}
    assert {i for i in kept if i % 2} == {i * 2 + 1 for i in range(60) if i % 4 == 3}
    strict = {r["doc_id"] for r in near_copies.keep_first(docs, percent=85).collect()}
    assert {i for i in strict if i % 2} == {i * 2 + 1 for i in range(60) if i % 4}
    assert [near_copies.bands_for(p) for p in (80, 85, 100)] == [28, 20, 1]


def test_groups_of_odd_rows(spark):
    docs = docs_of(spark, odd_rows())
    got = near_copies.near_copies(docs).collect()
    assert len(got) == len(odd_rows())
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by_id[3] == [(0, 3, True)] and by_id[5] == [(0, 5, True)] and by_id[6] == [(0, 6, True)]
    # The copy with a null id counts as the largest; equal rows are one document.
    assert [x[1:] for x in by_id[7]] == [(7, True)] * 2
    assert sorted(str(x[1:]) for x in by_id[None]) == ["(7, False)", "(None, True)"]
    assert near_copies.near_copies(docs.limit(0)).count() == 0 and near_copies.keep_first(docs.limit(0)).count() == 0


def test_coordinates_follow_the_similarity():
    import numpy as np

    r = np.random.default_rng(1)
    pool = r.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    same = (near_copies.coordinates(a, 4000) == near_copies.coordinates(b, 4000)).mean()
    assert abs(same - 1500 / 2500) < 0.05


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(5, 5), (200, 201), (201, 200)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["label"], set()).add(r["vertex"])
    assert sorted(map(sorted, groups.values())) == [list(range(41)), list(range(100, 130)), [200, 201]]
