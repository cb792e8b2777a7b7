import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from barloom.llm import periodic
from tests.llm.llm_data import clashing, docs_of, odd_rows, prose


def plain_runs(words):
    """(start, length, period) by trying every period at every place."""
    out, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            first = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - first + q
            if length >= max(6, 4 * q):
                out.setdefault((first, length), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, made_periodic):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if made_periodic and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(" ".join(kept)))


def by_repr(rows):
    return sorted(map(tuple, rows), key=repr)


def periodic_texts(n):
    r = random.Random(3)
    for k in range(n):
        words = [r.choice("abcdefgh"[:r.choice([1, 2, 8])]) for _ in range(r.choice([5, 6, 7, 40, 300]))]
        if len(words) > 20 and r.random() < 0.7:
            p, a = r.randint(1, 9), r.randrange(10)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        yield k, " ".join(words)


def test_runs_are_those_of_all_periods_at_all_places(spark):
    rows = [*periodic_texts(120), (9_000, " ".join(prose(5, 40).split() * 5)), (9_001, "z " * 5_000)]
    got = periodic.find_runs(clashing(docs_of(spark, rows)), made_periodic=True).collect()
    assert by_repr(got) == by_repr(plain_row(i, t, True) for i, t in rows)


@pytest.mark.parametrize("made_periodic", [False, True])
def test_odd_rows(spark, made_periodic):
    rows = [r for r in odd_rows() if not (r[1] or "").startswith("x y")]
    got = periodic.find_runs(clashing(docs_of(spark, rows)), made_periodic).collect()
    assert by_repr(got) == by_repr(plain_row(i, t, made_periodic) for i, t in rows)
    assert not periodic.find_runs(docs_of(spark, []), made_periodic).count()


def test_collapsed_text_keeps_one_period(spark):
    text = "so it goes " + "on and " * 9 + "on until it ends"
    row = periodic.find_runs(docs_of(spark, [(1, text)]), with_text=True).first()
    assert (row.start, row.length, row.period, row.exponent_milli) == (3, 19, 2, 9500)
    assert row.collapsed == "so it goes on and until it ends"


@pytest.mark.parametrize("letters", [1, 2, 30])
def test_extensions_of_any_two_places(letters):
    r = np.random.default_rng(letters)
    x = np.append(np.tile(r.integers(0, letters, 90), 4), letters)
    lce = periodic.Extensions(x)
    i, j = (a.ravel() for a in np.meshgrid(np.arange(len(x)), np.arange(len(x))))
    i, j = i[i != j], j[i != j]
    equal = lambda a, b: next((k for k in range(len(x)) if max(a, b) + k >= len(x) or x[a + k] != x[b + k]))
    some = r.permutation(len(i))[:4000]
    assert lce(i[some], j[some]).tolist() == [equal(a, b) for a, b in zip(i[some].tolist(), j[some].tolist())]


def test_a_very_long_text_in_linear_portions(monkeypatch):
    monkeypatch.setattr(periodic, "PORTION", 1000)
    words = np.arange(200_000) % 50_000 % 40_000
    start, length, period = periodic.runs_of(np.append(words, 10 ** 6), np.array([len(words)]))
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == [(0, 200_000, 50_000)]
