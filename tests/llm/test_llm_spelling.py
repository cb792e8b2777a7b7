import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from barloom.llm import spelling
from tests.llm.llm_data import clashing, docs_of, odd_rows, prose


def one_edit(a, b):
    """Whether one code point inserted, deleted or replaced makes a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1:] or (len(a) == len(b) and a[k + 1:] == b[k + 1:])


def plain_variants(rows, one_in):
    counts = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if one_in and h % one_in == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if c >= 3 and len(w) >= 5}
    near = defaultdict(list)
    for a in n:
        near[a] = [b for b in n if one_edit(a, b)]
    form = {}
    for w in n:
        best = min(near[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=repr)


def spelt_rows():
    """Chains of variants, ties, letters at both ends, runs of one letter, accents."""
    words = ["colour"] * 40 + ["color"] * 16 + ["colr"] * 9 + ["coloor"] * 4 + ["colours"] * 40 + ["xcolour"] * 7
    words += ["aaaaa"] * 5 + ["aaaaaa"] * 11 + ["aaaaaaa"] * 25 + ["aaaab"] * 3 + ["élève"] * 4 + ["eleve"] * 4 + ["élèves"] * 9
    words += ["Straße"] * 6 + ["strasse"] * 12 + ["abcde"] * 2 + ["bcdef"] * 3 + ["bcdeg"] * 3 + ["÷×ÿÀß"] * 3
    r = random.Random(7)
    for _ in range(900):
        words.append("".join(r.choice("ab") for _ in range(r.randint(4, 9))))
    r.shuffle(words)
    return [(k, " ".join(words[k::40])) for k in range(40)] + [(100 + k, prose(k % 7)) for k in range(30)]


@pytest.mark.parametrize("one_in,most", [(0, 8192), (5, 8192), (5, 6)])
def test_variants_are_those_of_all_pairs(spark, one_in, most):
    rows = spelt_rows()
    got = spelling.variants(clashing(docs_of(spark, rows)), one_in, most).collect()
    assert sorted(map(tuple, got), key=repr) == plain_variants(rows, one_in)


def test_odd_rows(spark):
    rows = odd_rows() * 3
    got = spelling.variants(clashing(docs_of(spark, rows)), 11).collect()
    assert sorted(map(tuple, got), key=repr) == plain_variants(rows, 11)
    assert not spelling.variants(docs_of(spark, []), 97).count()
    assert not spelling.variants(docs_of(spark, [(1, None), (2, "")]), 97).count()


def test_checksums_of_texts_put_together():
    parts = [(b"", b"a"), (b"12:", "é".encode()), (b"-9007:", b"abcdefghij" * 9)]
    for a, b in parts:
        first, second = (np.array([zlib.crc32(x)], np.uint32) for x in (a, b))
        assert spelling._checksums.joined(first, second, len(b)).tolist() == [zlib.crc32(a + b)]


def test_a_chain_of_forms_leads_to_its_end(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}" if i < 9 else None) for i in range(10)], "word string, form string")
    assert {tuple(r) for r in spelling.roots(forms).collect()} == {(f"w{i}", "w9") for i in range(9)}
