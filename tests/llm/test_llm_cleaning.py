import hashlib
import math
import re

import pytest

from barloom.llm import disclosure, line_windows, merkle, rules
from tests.llm.llm_data import clashing, docs_of, odd_rows, prose


def plain_base(text):
    """The four kinds by search alone, as the patterns are written."""
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    found = {"email": re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text),
             "ip": (m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
                    if all(int(p) <= 255 for p in m[0].split("."))),
             "card": (m for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
                      if 13 <= len(d := re.sub(r"[^0-9]", "", m[0])) <= 19 and luhn(d)),
             "phone": (m for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                       if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15)}
    return [(k, *m.span()) for k, ms in found.items() for m in ms]


@pytest.mark.parametrize("text", [
    "", "a@b", "a@b.c", "x a@b@c.d, e@f.g.h!", "a.b@c.d@e.f.g", "@a.b c@-.-", "ü@a.bé x@y.z..w",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0000.1.2.3 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112",
    "+1 (017) 555-7713, +49 30 123456-, +1 2 ++12345678901 +1((((2", "😀 +1 234 567 8901 😀 a@b.co",
    "4242424242424242 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0", "9" * 40 + ".1.2.3",
])
def test_base_spans_are_those_of_plain_search(text):
    assert disclosure.base_spans(text) == plain_base(text)


def names(spark):
    """Ann's address stands near 'zanthor' in different surroundings; others have neither."""
    rows = [(i, f"{prose(i, 2)}\nwrite to Zanthor, ann@x.org {prose(i + 100, 1)}") for i in range(6)]
    rows += [(i, prose(i, 4)) for i in range(20, 60)] + [(60, "once more zanthor, alone"), (61, "nothing here")]
    return docs_of(spark, rows)


def test_words_that_reveal_an_entity_are_found_and_replaced(spark):
    docs = clashing(names(spark))
    told = {r["word"] for r in disclosure.telling_words(docs, disclosure.find_base(docs)).collect()}
    assert "zanthor" in told and "nothing" not in told
    got = {r["doc_id"]: r for r in disclosure.sanitise(docs).collect()}
    for i in range(6):
        assert "anthor" not in got[i]["text"] and "[EMAIL]" in got[i]["text"]
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert got[60]["text"] == "once more [WORD], alone" or got[60]["text"] == "once more , alone"
    assert got[61]["text"] == "nothing here" and got[61]["found"] == "found"
    assert got[25]["text"] == prose(25, 4)


def test_copies_prove_nothing(spark):
    docs = docs_of(spark, [(i, "call Zanthor at ann@x.org now") for i in range(30)]
                   + [(i, prose(i)) for i in range(50, 60)])
    assert all(not r["added"] for r in disclosure.find_spans(docs).collect())


def test_a_passage_shared_by_different_texts_is_evidence(spark):
    block = ("for all that you may want to ask about this page please write to Zanthor at ann@x.org "
             "and you will hear from us within two or three days of the same week")
    docs = docs_of(spark, [(i, f"{prose(i, 2)}\n{block}\n{prose(i + 100, 2)}") for i in range(6)]
                   + [(i, prose(i, 4)) for i in range(20, 60)])
    told = {r["word"]: r["revealed"] for r in disclosure.telling_words(docs, disclosure.find_base(docs)).collect()}
    assert told.get("zanthor", 0) > 0.999
    assert all("anthor" not in r["text"] for r in disclosure.sanitise(docs).collect())


def test_words_far_from_an_entity_are_counted_in_whole_documents(spark):
    """'qorvex' stands far from the address in all ten documents, 'zanthor' near it in three and far in seven."""
    rows = [(i, f"Qorvex {'Zanthor' if i >= 3 else ''}\n{prose(i, 4)}\n{'Zanthor' if i < 3 else ''} ann@x.org")
            for i in range(10)]
    rows += [(i, prose(i, 4)) for i in range(100, 290)]
    docs = docs_of(spark, rows)
    told = {r["word"]: r["revealed"] for r in disclosure.telling_words(docs, disclosure.find_base(docs)).collect()}
    assert told.get("qorvex") == pytest.approx(1) and told.get("zanthor") == pytest.approx(1)
    own = {i: {w for w in (x.strip(disclosure.PUNCTUATION).lower() for x in re.findall(r"[^\x20\x09-\x0D]+", t))
               if any(c.isalpha() for c in w)} for i, t in rows}
    plain = {}
    for w in set().union(*(own[i] for i in range(10))):
        both, texts = sum(w in own[i] for i in range(10)), sum(w in x for x in own.values())
        revealed = math.log(both * 200 / (10 * texts)) / math.log(20)
        if both >= 3 and revealed >= disclosure.GENERALISE_FROM:
            plain[w] = pytest.approx(revealed)
    assert told == plain
    assert all(not re.search("anthor|orvex", r["text"]) for r in disclosure.sanitise(docs).collect())


def secrets(spark):
    """Documents with an address of their own and a token, some with a token alone, others with neither."""
    digest = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    rows = [(i, f"{prose(i, 2)}\n{prose(i + 900, 1)} mail u{i}@x{i}.org then token = \"{digest(i)}\" {prose(i + 300, 1)}")
            for i in range(14)]
    rows += [(i, f"{prose(i, 3)} token = \"{digest(i)}\" and so on\n{prose(i + 500, 1)}") for i in range(20, 25)]
    rows += [(i, prose(i, 4) + (f" nothing {i}" if i % 3 == 0 else "")) for i in range(100, 260)]
    rows += [(300, f"{prose(300)} {digest(300)} alone")]  # no cue before it
    # Near copies around one address prove nothing about their other words.
    rows += [(i, f"{prose(7000, 3)} xylograph w{i} one@and.only") for i in range(400, 430)]
    rows += [(i, f"{prose(i, 2)} xylograph") for i in range(440, 444)]
    return rows


def test_words_that_reveal_a_kind_and_what_they_point_to(spark):
    rows = secrets(spark)
    docs = docs_of(spark, rows)
    found = disclosure.find_base(docs)
    told = {r["word"]: r for r in disclosure.telling_words(docs, found).collect()}
    own = {i: {w for w in (x.strip(disclosure.PUNCTUATION).lower() for x in re.findall(r"[^\x20\x09-\x0D]+", t))
               if any(c.isalpha() for c in w)} for i, t in rows}
    held = {i: {f"email:{t[s:e]}" for _, s, e in plain_base(t)} | {f"secret:{x}" for x in re.findall("[0-9a-f]{40}", t)}
            for i, t in rows}
    plain, n = {}, len(rows)
    for kind in ("email:", "secret:", ""):
        has = {i: any(x.startswith(kind) for x in held[i]) for i in held}
        for w in set().union(*own.values()):
            values = {min(held[i]) for i in own if has[i] and w in own[i]}
            both, texts = sum(has[i] and w in own[i] for i in own), sum(w in x for x in own.values())
            if len(values) >= disclosure.LEAST_VALUES:
                revealed = math.log(both * n / (sum(has.values()) * texts)) / math.log(n / sum(has.values()))
                if revealed >= max(disclosure.GENERALISE_FROM, plain.get(w, 0)):
                    plain[w] = revealed
    plain = {w: pytest.approx(x) for w, x in plain.items()}
    assert {w: r["revealed"] for w, r in told.items() if r["cue"]} == plain and "token" in plain
    spans = {r["doc_id"]: r["added"] for r in disclosure.find_spans(docs).collect()}
    for i, t in rows:
        secret = re.search('token = "([0-9a-f]+)"', t)
        ends = {(s["start"], s["end"]) for s in spans[i] if s["kind"] == "remove"}
        assert not secret or secret.span(1) in ends
        assert i != 300 or not any(re.fullmatch("[0-9a-f]{40}", t[s["start"]:s["end"]]) for s in spans[i])
    texts = {r["doc_id"]: r["text"] for r in disclosure.sanitise(docs).collect()}
    assert not any(re.search("[0-9a-f]{40}", texts[i]) for i in [*range(14), *range(20, 25)])
    assert re.search("[0-9a-f]{40}", texts[300])


def counted(text):
    return {w for w in (x.strip(disclosure.PUNCTUATION).lower() for x in re.findall(r"[^\x20\x09-\x0D]+", text))
            if any(c.isalpha() for c in w)}


def long_passage():
    """Different texts around a passage of 100 words and an address, near copies around another, and the words of both."""
    passage = " ".join(f"{a}{b}x" for a in "bcdfghjklm" for b in "npqrstvwyz")
    rows = [(i, f"{prose(i, 2)}\n{passage} Zanthor ann@x.org\n{prose(i + 100, 12)}") for i in range(6)]
    rows += [(i, f"{prose(7000, 5)} xylograph w{i} one@and.only") for i in range(400, 430)]
    # With two different texts these are three pieces of evidence for 'qorvex', and one for the other words.
    rows += [(i, f"{prose(7100, 5)} quagga qorvex w{i} two@and.only") for i in range(500, 510)]
    rows += [(i, f"{prose(i, 5)} qorvex two@and.only") for i in (510, 511)]
    rows += [(i, prose(i, 4)) for i in range(1000, 1150)]
    return rows, counted(passage) | {"zanthor"}


def test_long_passages_are_evidence_and_near_copies_are_not(spark):
    rows, passage = long_passage()
    docs = docs_of(spark, rows)
    told = {r["word"]: r["revealed"] for r in disclosure.telling_words(docs, disclosure.find_base(docs)).collect()
            if not r["cue"]}
    own, n, plain = {i: counted(t) for i, t in rows}, len(rows), {}
    different = {i: 400 if 400 <= i < 430 else 500 if 500 <= i < 510 else i for i in own}
    for entity in ("ann@x.org", "one@and.only", "two@and.only"):
        held = [i for i, t in rows if entity in t]
        for w in set().union(*(own[i] for i in held)):
            has = [i for i in held if w in own[i]]
            revealed = math.log(len(has) * n / (len(held) * sum(w in x for x in own.values()))) / math.log(n / len(held))
            if len({different[i] for i in has}) >= 3 and revealed >= max(disclosure.GENERALISE_FROM, plain.get(w, 0)):
                plain[w] = revealed
    assert told == {w: pytest.approx(x) for w, x in plain.items()}
    assert len(passage) > 100 and passage | {"qorvex"} <= told.keys() and not {"xylograph", "quagga"} & told.keys()


def test_the_pipeline_takes_words_of_long_passages_out(spark):
    import corpus_pipeline

    rows, passage = long_passage()
    texts = {r["doc_id"]: r["text"] for r in corpus_pipeline.personal(spark, docs_of(spark, rows), "").collect()}
    assert len(texts) == len(rows) and not any(passage & counted(texts[i]) for i in range(6))
    assert all("xylograph" in texts[i] for i in range(400, 430)) and all("quagga" in texts[i] for i in range(500, 510))


def test_cues_beside_few_of_many_values(spark):
    """'token' stands beside eight of 1,008 values."""
    digest = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    rows = [(i, f"{prose(i, 1)} token = \"{digest(i)}\"") for i in range(8)]
    rows += [(i, f"{prose(i, 2)} u{i}@x{i}.org{' gnomon' * (i % 90 == 0)}") for i in range(1000, 2000)]
    rows += [(i, prose(i, 2) + " gnomon" * (i == 3000)) for i in range(3000, 4000)]
    docs = docs_of(spark, rows)
    told = {r["word"]: r["revealed"] for r in disclosure.telling_words(docs, disclosure.find_base(docs)).collect()
            if r["cue"]}
    own, n, plain = {i: counted(t) for i, t in rows}, len(rows), {}
    for has in (range(1000, 2000), range(8), [*range(8), *range(1000, 2000)]):
        for w in set().union(*(own[i] for i in has)):
            both, texts = sum(w in own[i] for i in has), sum(w in x for x in own.values())
            revealed = math.log(both * n / (len(has) * texts)) / math.log(n / len(has))
            if both >= disclosure.LEAST_VALUES and revealed >= max(disclosure.GENERALISE_FROM, plain.get(w, 0)):
                plain[w] = revealed
    assert told == {w: pytest.approx(x) for w, x in plain.items()} and told["token"] == pytest.approx(1)
    texts = {r["doc_id"]: r["text"] for r in disclosure.sanitise(docs).where("doc_id < 8").collect()}
    assert not any(re.search("[0-9a-f]{40}", x) for x in texts.values())


def several_values():
    """Documents with an address that all of them have and a token of their own, and such whose values prove little."""
    digest = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    many = " ".join(f"m{k}@many.org" for k in range(10))
    rows = [(i, f"{prose(i, 2)} ask help@a.org, token = \"{digest(i)}\" {prose(i + 300, 1)}") for i in range(12)]
    # Ten values in near copies of one text are one set; eleven sets of four values are four values.
    rows += [(i, f"{prose(7000, 5)} xylograph w{i} {many}") for i in range(400, 412)]
    rows += [(i, f"{prose(i, 3)} quagga {' '.join(f'q{k}@four.org' for k in range(4) if (i - 500) >> k & 1)}")
             for i in range(505, 516)]
    # Ten values in one text, and seven texts with some of them.
    rows += [(i, f"{prose(i, 3)} gnomon {many if i == 600 else f'm{i - 600}@many.org'}") for i in range(600, 608)]
    rows += [(i, prose(i, 3)) for i in range(1000, 1100)]
    return rows


def test_all_values_of_a_document_count(spark):
    rows = several_values()
    docs = docs_of(spark, rows)
    told = {r["word"]: r["revealed"] for r in disclosure.telling_words(docs, disclosure.find_base(docs)).collect()
            if r["cue"]}
    own, n, plain = {i: counted(t) for i, t in rows}, len(rows), {}
    held = {i: frozenset([f"email:{t[s:e]}" for _, s, e in plain_base(t)]
                         + [f"secret:{x}" for x in re.findall("[0-9a-f]{40}", t)]) for i, t in rows}
    for kind in ("email:", "secret:", ""):
        has = {i: any(x.startswith(kind) for x in held[i]) for i in held}
        for w in set().union(*own.values()):
            sets = {held[i] for i in own if has[i] and w in own[i]}
            both, texts = sum(has[i] and w in own[i] for i in own), sum(w in x for x in own.values())
            if min(len(sets), len(frozenset().union(*sets))) >= disclosure.LEAST_VALUES:
                revealed = math.log(both * n / (sum(has.values()) * texts)) / math.log(n / sum(has.values()))
                if revealed >= max(disclosure.GENERALISE_FROM, plain.get(w, 0)):
                    plain[w] = revealed
    assert told == {w: pytest.approx(x) for w, x in plain.items()}
    assert {"token", "gnomon"} <= told.keys() and not {"xylograph", "quagga"} & told.keys()


def test_the_pipeline_takes_tokens_beside_a_shared_address_out(spark):
    import corpus_pipeline

    docs = docs_of(spark, several_values())
    texts = {r["doc_id"]: r["text"] for r in corpus_pipeline.personal(spark, docs, "").collect()}
    assert not any(re.search("[0-9a-f]{40}", texts[i]) for i in range(12))
    assert all("xylograph" in texts[i] for i in range(400, 412)) and all("quagga" in texts[i] for i in range(505, 516))


def test_spans_of_odd_rows(spark):
    docs = docs_of(spark, odd_rows() + [(40, "mail a@b.co")])
    got = disclosure.find_spans(clashing(docs)).collect()
    assert len(got) == len(odd_rows()) + 1
    assert [len(r["base"]) for r in got if r["doc_id"] == 40] == [1]
    texts = {(r["doc_id"], r["text"]) for r in disclosure.sanitise(docs).collect()}
    assert (40, "mail [EMAIL]") in texts and (3, None) in texts and (5, "") in texts
    empty = docs.limit(0)
    assert disclosure.sanitise(empty).count() == 0 and disclosure.find_spans(empty).count() == 0


def plain_lines(rows):
    """Repeated windows by looking at all earlier ones, in order of id and line."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = text.split("\n")
        at = [k for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        gone = set()
        for a in range(len(at) - 2):
            own = tuple(lines[at[a + k]] for k in range(3))
            if own in seen:
                gone.update(range(at[a], at[a + 2] + 1))
            seen.add(own)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_repeated_passages_go_and_first_copies_stay(spark):
    shared = prose(50, 3)
    rows = [(i, f"{prose(i, 2)}\n{shared}\n{prose(i + 9, 1)}") for i in range(6)]
    rows += [(10, "a\na\na\na\na"), (11, prose(60, 5)), (12, prose(60, 5)), (13, "b\n\nc\n \nd\ne"),
             (14, "x\nb\nc\nd\ny"), (15, "one\ntwo"), (16, "one\ntwo")]
    got = {r["doc_id"]: r for r in line_windows.clean_lines(clashing(docs_of(spark, rows))).collect()}
    assert {i: r["text"] for i, r in got.items()} == plain_lines(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert got[12]["text"] == "" and got[0]["text"] == rows[0][1]


def test_lines_of_odd_rows(spark):
    docs = docs_of(spark, odd_rows())
    got = sorted(((r["doc_id"], r["text"]) for r in line_windows.clean_lines(docs).collect()), key=str)
    assert len(got) == len(odd_rows())
    # The null id comes first, so the copies of its text lose their lines; equal rows lose the same.
    assert [t for i, t in got if i == 7] == ["", ""]
    assert (None, prose(1)) in got and (3, None) in got and (6, " \t\n \r\n") in got
    assert line_windows.clean_lines(docs.limit(0)).count() == 0


def plain_repeats(words):
    at, covered = {}, set()
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in at.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(8))
    return len(covered)


def test_ledger_measures_and_bits(spark):
    rows = [(i, t) for i, t in enumerate(t for _, t in odd_rows())]
    rows += [(100, "the cat sat on the mat and slept. " * 5), (101, prose(7)), (102, "UP " * 40 + "low"),
             (103, "w### " * 30), (104, "a b c d e f g h i a b c d e f g h i j k l m n o p")]
    got = {r["doc_id"]: r for r in rules.ledger(clashing(docs_of(spark, rows))).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        own = got[i]
        assert own["n_words"] == len(words) and own["word_chars"] == sum(map(len, words))
        assert own["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert own["n_repeat_words"] == plain_repeats(words)
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert own["n_dup_lines"] == len(lines) - len(set(lines))
    bits = {name: 1 << k for k, (name, _) in enumerate(rules.RULES)}
    assert got[102]["failures"] & bits["shouting"] and got[103]["failures"] & bits["many_symbols"]
    assert got[101]["failures"] == 0 and got[0]["failures"] == bits["few_words"]


def test_ablations_are_sums_over_the_ledger(spark):
    rows = spark.createDataFrame([(i, m) for i, m in enumerate([0, 0, 1, 3, 4, 5, 4])], "doc_id long, failures long")
    got = {r["rule"]: (r["n_failed"], r["n_failed_alone"], r["n_kept_without"])
           for r in rules.ablations(rows, "v1").collect()}
    assert got == {"few_words": (3, 1, 3), "repeated_words": (1, 0, 2), "many_symbols": (3, 2, 4)}
    assert rules.ledger(docs_of(spark, [])).count() == 0


def test_roots_tell_equal_texts_and_branches_the_edits(spark):
    text = prose(5, 30)
    lines = text.split("\n")
    edited = "\n".join(lines[:12] + ["something else"] + lines[13:])
    longer = "\n".join(lines[:20] + ["put in between"] + lines[20:])
    old = merkle.fingerprints(docs_of(spark, [(1, text), (2, text), (3, text), (4, None)]))
    new = merkle.fingerprints(docs_of(spark, [(1, edited), (2, longer), (3, text), (4, "")]))
    assert {(r["doc_id"], r["paragraph"]) for r in merkle.locate_edits(old, new).collect()} == {(1, 12), (2, 20)}


def test_places_of_edits_of_odd_rows(spark):
    old = merkle.fingerprints(docs_of(spark, [(None, "a\nb\nc"), (1, "a\nb"), (1, "a\nc"), (2, "x"), (4, None)]))
    new = merkle.fingerprints(docs_of(spark, [(None, "a\nB\nc"), (1, "a\nb"), (3, "y"), (4, "z"), (4, "z")]))
    # The text of id 1 equals one old version and differs from the other; ids 2 and 3 have no counterpart.
    assert sorted(map(str, merkle.locate_edits(old, new).collect())) == sorted(
        f"Row(doc_id={i}, paragraph={p})" for i, p in ((None, 1), (1, 1), (4, 0)))
    assert merkle.locate_edits(old.limit(0), new).count() == merkle.locate_edits(old, new.limit(0)).count() == 0


def test_edited_texts_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle.with_next, "__defaults__", (3,))
    rows = [(i, t) for i, t in enumerate([prose(1), "", prose(2), "é😀" * 9, "x", prose(3, 30), prose(2), "", prose(9)])]
    got = {r["doc_id"]: r for r in merkle.edited_fingerprints(clashing(docs_of(spark, rows[::-1]))).collect()}
    for i, text in rows:
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        assert got[i]["edited"] == text[:len(text) - half] + after[:half]
        assert got[i]["next"]["text"] == after and got[i]["n_chars"] == len(text)
    assert got[2]["tree"]["root"] == got[6]["tree"]["root"] != got[0]["tree"]["root"]
    digest = hashlib.sha256(hashlib.sha256(hashlib.sha256(b"x").hexdigest().encode()).hexdigest().encode())
    assert got[4]["tree"]["root"] == digest.hexdigest()


def test_fingerprints_of_odd_rows(spark):
    got = merkle.edited_fingerprints(docs_of(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    assert merkle.edited_fingerprints(docs_of(spark, [])).count() == 0
    one = merkle.edited_fingerprints(docs_of(spark, [(1, "abcd")])).first()
    assert one["edited"] == "abab"
