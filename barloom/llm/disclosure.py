"""Personal data in texts, and the words that give its owners away.

Base spans are e-mail addresses, IP addresses, payment cards and phone numbers, found by
pattern. Their distinct values are the protected entities. The corpus tells how much a
word in their documents reveals: with document counts, the pointwise mutual information of word
and entity, as a share of the entity's own information (1: the word never occurs without
the entity; 0: it says nothing). A word that reveals ``GENERALISE_FROM`` or more of an
entity is replaced by a general one, from ``REMOVE_FROM`` on it is removed, wherever it
stands outside base spans. Only words that stand in ``LEAST_TEXTS`` different
texts with an entity count, wherever in them, so that a text and its copies prove nothing; a
passage that many different texts share does, however long it is. Texts are different if they are in
different groups of near copies (``COPY_PERCENT`` of the shingles or more).

The same information is taken about a whole kind of entity (identifiers, long runs of letters and
digits, are a further kind), and about any of them:
a word beside ``LEAST_VALUES`` different values or more that mostly stands in documents with such data
is a cue. All values of a document count; as many documents must differ in theirs, so that one with
many values, and its copies, prove nothing. A cue is treated as any telling word, and the identifiers it points to (``token =
"..."``) are telling by what they are: words that hardly any other document holds.

A word is a run without white space, less punctuation at its ends, in lower case; it has
a letter. A null text is empty. Rows with equal ids are told apart by their texts; rows
with equal ids and texts get the same spans. Null ids stay.
"""

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barloom.llm.near_copies import near_copies
from barloom.llm.words import free_name, freeing, map_texts, slices, split_words, texts_of
from barloom.session import stored

KINDS = ("email", "ip", "card", "phone")
LEAST_TEXTS = 3
# Texts that share so many of their shingles are near copies: together they prove as much as one of them.
COPY_PERCENT = 80
# A word tells a kind of entity only if it stands beside so many different ones, in as many texts that differ in theirs.
LEAST_VALUES = 8
# One in so many documents is counted first, to see which words stand in too many in any case.
SIEVE = 8
ANY = "any"
SECRET = "secret"
# The words behind a cue that may be identifiers.
REACH = 3
GENERALISE_FROM = 0.9
REMOVE_FROM = 0.97
# Size of the filter for words worth a closer look, whatever the corpus: 8 MB.
FILTER_BITS = 1 << 26
# Words a task counts before it passes the counts on.
MOST_COUNTED = 200_000

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGIT = re.compile(r"[0-9]")
IDENTIFIER = re.compile(r"[A-Za-z0-9]{16,}")
LETTER = re.compile(r"[A-Za-z]")
# A match that fails from the start of a run of digits fails from within it as well.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# What stands for a span in the cleaned text.
STANDS_FOR = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]",
              "generalise": "[WORD]", "remove": ""}

_SPANS = "array<struct<kind: string, start: long, end: long>>"
_FOUND = f"doc_id long, text_key long, spans {_SPANS}, entities array<string>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @: the address around it. Linear in the text, unlike a search for its start."""
    at, free = text.find("@"), 0
    while at >= 0:
        found = DOMAIN.match(text, at)
        start = at
        while found and start > free and text[start - 1] in LOCAL:
            start -= 1
        if found and start < at:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; code points, the end exclusive."""
    out = [("email", *s) for s in _emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def entity_of(kind: str, value: str) -> str:
    """The name under which equal values of a kind are one entity."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(DIGIT.findall(value))}"


def identifiers(text: str, spans: list[tuple[str, int, int]]) -> set[str]:
    """Long runs of letters and digits, with both, outside ``spans``."""
    found = [m for m in IDENTIFIER.finditer(text) if DIGIT.search(m[0]) and LETTER.search(m[0])]
    if not found:
        return set()
    taken = _Taken(spans)
    return {m[0] for m in found if not taken(*m.span())}


class _Taken:
    """Whether places lie in one of some spans."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.starts, self.ends = [], []
        for start, end in sorted((s, e) for _, s, e in spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def __call__(self, start: int, end: int) -> bool:
        i = bisect_right(self.starts, end - 1) - 1
        return i >= 0 and self.ends[i] > start


def normal(words: pa.Array) -> pa.Array:
    """Words as they are counted; null where a word has no letter."""
    bare = pc.utf8_lower(pc.utf8_trim(words, characters=PUNCTUATION))
    return pc.if_else(pc.match_substring_regex(bare, r"\pL"), bare, None)


def find_base(docs: DataFrame) -> DataFrame:
    """Per document: base spans, and the distinct entities: what they name, and identifiers."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans, entities = [], []
        for text in texts_of(batch, "text").to_pylist():
            found = base_spans(text)
            spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
            entities.append(sorted({entity_of(k, text[s:e]) for k, s, e in found}
                                   | {f"{SECRET}:{x}" for x in identifiers(text, found)}))
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"),
             pa.array(spans, pa.list_(span)), pa.array(entities, pa.list_(pa.string()))],
            names=["doc_id", "text_key", "spans", "entities"])

    return map_texts(_keyed(docs), work, _FOUND)


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _text_key() -> Column:
    return F.xxhash64(_text())


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("text_key"),
                       _text().alias("text"))


def _sieved(text_key: Column | str) -> Column:
    """Whether a text is one of those that are counted first."""
    return F.pmod(text_key, F.lit(SIEVE)) == 0


def _most(both: Column, n: int, n_entity: Column) -> Column:
    """From so many texts on a word reveals less than GENERALISE_FROM; a little more, as doubles are not exact."""
    return both * F.pow(F.lit(float(n)) / n_entity, F.lit(1 - GENERALISE_FROM)) * 1.000001


def word_filter(words: DataFrame) -> np.ndarray:
    """A bit for the hash of every word of ``words(word)``, in an array of fixed size."""
    place = (F.crc32("word") % FILTER_BITS + 1).alias("place")  # bitmap buckets count places from 1
    rows = (words.select(place).groupBy(F.expr("bitmap_bucket_number(place)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, bits in rows:
        out[(bucket - 1) * len(bits):bucket * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _passing(words: pa.Array, bits: np.ndarray) -> np.ndarray:
    """Which of some counted words (null: none) the filter lets through."""
    hashes = np.fromiter((-1 if w is None else zlib.crc32(w.encode()) % FILTER_BITS
                          for w in words.to_pylist()), np.int64, len(words))
    return (hashes >= 0) & ((bits[hashes >> 3] >> (hashes & 7).astype(np.uint8)) & 1).astype(bool)


def document_counts(docs: DataFrame, words: DataFrame) -> DataFrame:
    """word, texts: how many documents have each word of ``words(word)``.

    Every word of every text is looked up in the filter; what passes is counted per task (up to
    ``MOST_COUNTED`` words at once), then summed up, and words that passed by accident fall out in a join.
    """
    shared = docs.sparkSession.sparkContext.broadcast(word_filter(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def taken() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                names=["word", "texts"])
            total.clear()
            return rows

        for part in slices(batches, "text"):
            found = split_words(texts_of(part, "text"))
            counted = normal(found.distinct).dictionary_encode()
            passing = _passing(counted.dictionary, shared.value)
            codes = np.asarray(counted.indices.fill_null(len(passing)), dtype=np.int64)
            passing = np.append(passing, False)
            mine = codes[found.codes] if len(codes) else found.codes
            kept = passing[mine] if len(codes) else np.zeros(0, bool)
            pairs = np.unique(found.owners[kept] * len(passing) + mine[kept])
            n = np.bincount(pairs % len(passing), minlength=len(passing))
            has = np.flatnonzero(n)
            total.update(dict(zip(counted.dictionary.take(pa.array(has)).to_pylist(), n[has].tolist())))
            if len(total) > MOST_COUNTED:
                yield taken()
        yield taken()

    seen = _keyed(docs).select("text").mapInArrow(freeing(run), "word string, texts long")
    return seen.groupBy("word").agg(F.sum("texts").alias("texts")).join(words.select("word"), "word")


def words_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """text_key, words: the distinct words of the texts ``keys(text_key)``, and of some that pass by accident."""
    shared = docs.sparkSession.sparkContext.broadcast(
        word_filter(keys.select(F.col("text_key").cast("string").alias("word"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passing = _passing(batch.column("text_key").cast(pa.string()), shared.value)
            for part in slices([batch.filter(pa.array(passing))], "text"):
                found = split_words(texts_of(part, "text"))
                counted = normal(found.distinct).dictionary_encode()
                none = len(counted.dictionary)
                codes = np.asarray(counted.indices.fill_null(none), dtype=np.int64)
                mine = codes[found.codes] if len(codes) else found.codes
                kept = mine < none
                pairs = np.unique(found.owners[kept] * (none + 1) + mine[kept])
                starts = np.searchsorted(pairs, np.arange(part.num_rows + 1) * (none + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("text_key"), pa.ListArray.from_arrays(
                        pa.array(starts, pa.int32()), counted.dictionary.take(pa.array(pairs % (none + 1))))],
                    names=["text_key", "words"])

    found = _keyed(docs).select("text_key", "text").mapInArrow(freeing(run), "text_key long, words array<string>")
    return found.groupBy("text_key").agg(F.first("words").alias("words"))


def copies_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """text_key, copies: the group of near copies that each text of ``keys(text_key)`` is in, among them."""
    shared = docs.sparkSession.sparkContext.broadcast(
        word_filter(keys.select(F.col("text_key").cast("string").alias("word"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_passing(batch.column("text_key").cast(pa.string()), shared.value)))

    asked = _keyed(docs).select("text_key", "text").mapInArrow(freeing(run), "text_key long, text string")
    texts = stored(asked.join(keys, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
                   .withColumnRenamed("text_key", "doc_id"), "shared-texts")
    return near_copies(texts, COPY_PERCENT).select(
        F.col("doc_id").alias("text_key"), F.col("component_id").alias("copies"))


def telling_words(docs: DataFrame, found: DataFrame) -> DataFrame:
    """word, revealed, cue: the words that reveal an entity or its kind, and how much at most.

    ``found`` is what ``find_base`` gave for ``docs``. All words of all documents with an
    entity are candidates; counts are of whole documents. Left out early is only what cannot be
    in the result: entities, and words with them, of fewer than ``LEAST_TEXTS`` different texts, words beside
    fewer than ``LEAST_VALUES`` different values or sets of values, and words that stand in too many texts to reveal enough:
    in those with an entity alone, or in these and one in ``SIEVE`` of the others. What is left is counted in all documents.
    """
    n = docs.count()
    # Equal texts are brought together; n is the number of their documents.
    texts = stored(
        found.where(F.size("entities") > 0).groupBy("text_key")
        .agg(F.count("*").alias("n"), F.first("entities").alias("entities")), "entity-texts")
    # A text's words are many bytes: what goes with them comes to them, and they are exchanged once.
    def holds(kind: str) -> Column:
        return F.exists("entities", lambda e: e.startswith(f"{kind}:"))

    of_kind = {k: holds(k) for k in (*KINDS, SECRET)} | {ANY: F.lit(True)}
    marked = texts.select("text_key", "n", F.when(~_sieved("text_key"), F.col("n")).alias("unsieved"),
                          F.xxhash64("entities").alias("value_set"),
                          # A text with more values than that has enough: so many of them tell it as all do.
                          F.transform(F.slice("entities", 1, LEAST_VALUES), lambda e: F.xxhash64(e)).alias("values"),
                          *[has.alias(f"has_{k}") for k, has in of_kind.items()])
    marked = stored(words_of(docs, texts).join(marked, "text_key"), "entity-text-words")
    words = marked.select("text_key", "words")

    # One value at a time: entities that several texts share.
    held = texts.select("text_key", "n", F.explode("entities").alias("entity")).where(
        ~F.col("entity").startswith(f"{SECRET}:"))
    entities = held.groupBy("entity").agg(
        F.count("*").alias("different"), F.sum("n").alias("n_entity")).where(
        (F.col("different") >= LEAST_TEXTS) & (F.col("n_entity") < n)).drop("different")
    held = stored(held.join(entities, "entity"), "entity-texts-shared")
    held = stored(held.join(copies_of(docs, held.select("text_key").distinct()), "text_key"), "entity-texts-grouped")
    several = held.groupBy("entity").agg(F.countDistinct("copies").alias("different")).where(
        F.col("different") >= LEAST_TEXTS).select("entity")
    held = stored(held.join(several, "entity", "left_semi"), "entity-texts-asked")
    pairs = stored(
        held.join(words, "text_key").select("entity", "n_entity", "n", "copies", F.explode("words").alias("word"))
        .groupBy("entity", "n_entity", "word")
        .agg(F.countDistinct("copies").alias("different"), F.sum("n").alias("both"))
        .where(F.col("different") >= LEAST_TEXTS), "entity-words")

    # A whole kind, or personal data of any kind: words beside many different values, in texts that differ in theirs.
    totals = texts.agg(*[F.sum(F.when(has, F.col("n"))).alias(k) for k, has in of_kind.items()]).first().asDict()
    beside = marked.withColumn("word", F.explode("words")).groupBy("word", "value_set").agg(
        F.sum("unsieved").alias("unsieved"), *[F.sum(F.when(F.col(f"has_{k}"), F.col("n"))).alias(k) for k in of_kind])
    # Copies, all with the same values, are one set of values.
    kinds = beside.groupBy("word").agg(
        F.count("*").alias("sets"), F.sum("unsieved").alias("unsieved"),
        *[F.sum(k).alias(k) for k in of_kind], *[F.count(k).alias(f"sets_{k}") for k in of_kind],
    ).where(F.col("sets") >= LEAST_VALUES)
    told_by = [k for k in of_kind if 0 < (totals[k] or 0) < n]
    bounds = [F.when(F.col(f"sets_{k}") >= LEAST_VALUES, _most(F.col(k), n, F.lit(totals[k]))) for k in told_by]
    kinds = stored(kinds.withColumn("most", F.greatest(*bounds, F.lit(-1.0), F.lit(-1.0))), "kind-words")
    first = document_counts(docs.where(_sieved(_text_key())), kinds.select("word"))
    kinds = stored(kinds.join(first, "word", "left").where(
        F.coalesce("unsieved", F.lit(0)) + F.coalesce("texts", F.lit(0)) <= F.col("most")).drop("texts"), "kind-words-left")
    has = [f"has_{k}" for k in of_kind]
    values = marked.select("values", *has, F.explode("words").alias("word")).join(kinds.select("word"), "word").select(
        "word", *has, F.explode("values").alias("value")).groupBy("word", "value").agg(
        *[F.bool_or(h).alias(h) for h in has]).groupBy("word").agg(
        *[F.count_if(f"has_{k}").alias(f"values_{k}") for k in of_kind])
    enough = {k: (F.col(f"sets_{k}") >= LEAST_VALUES) & (F.col(f"values_{k}") >= LEAST_VALUES) for k in told_by}
    kinds = stored(kinds.join(values, "word").where(
        reduce(or_, enough.values(), F.lit(False))), "kind-words-beside-values")

    own = F.log(F.lit(n) / F.col("n_entity"))
    most = _most(F.col("both"), n, F.col("n_entity"))
    least = held.select("text_key", "n").distinct().join(words, "text_key").select(
        "n", F.explode("words").alias("word")).groupBy("word").agg(F.sum("n").alias("least"))
    asked = pairs.groupBy("word").agg(F.max(most).alias("most")).join(least, "word").where("least <= most")
    asked = stored(asked.select("word").union(kinds.select("word")).distinct(), "asked-words")
    counts = stored(document_counts(docs, asked), "asked-counts")
    mutual = F.log(F.col("both") * F.lit(float(n)) / (F.col("n_entity") * F.col("texts")))
    of_values = (pairs.join(counts, "word").groupBy("word").agg(F.max(mutual / own).alias("revealed"))
                 .withColumn("cue", F.lit(False)))
    shares = [F.when(enough[k], F.log(
        F.col(k) * F.lit(float(n)) / (F.lit(float(totals[k])) * F.col("texts"))) / math.log(n / totals[k]))
        for k in told_by]
    if shares:
        cues = kinds.join(counts, "word").select("word", F.greatest(*shares, F.lit(-1.0)).alias("revealed"),
                                                 F.lit(True).alias("cue"))
        of_values = of_values.unionByName(cues)
    telling = of_values.where(F.col("revealed") >= GENERALISE_FROM).groupBy("word").agg(
        F.max("revealed").alias("revealed"), F.bool_or("cue").alias("cue"))
    return stored(telling, "telling-words")  # looked up twice


def pointed_at(docs: DataFrame, cues: DataFrame) -> DataFrame:
    """doc_id, text_key, spans: identifiers that a cue points to and that few documents hold.

    An identifier is a run of 16 or more letters and digits, with both; asked for are the ``REACH``
    words behind a cue on its line. What it tells is its own information as a share of the most that a
    word can have: 1 if one document holds it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(word_filter(cues))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch, "text")
        found = split_words(texts)
        counted = normal(found.distinct)
        passing = _passing(counted, shared.value)
        asked = dict(zip(found.distinct.filter(pa.array(passing)).to_pylist(),
                         counted.filter(pa.array(passing)).to_pylist()))
        rows, out = np.unique(found.owners[passing[found.codes]]), []
        for row in rows.tolist():
            text = texts[row].as_py()
            taken = None
            for line in re.finditer(r"[^\n]+", text):
                words = list(WORD.finditer(line[0]))
                for k, m in enumerate(words):
                    if m[0] not in asked:
                        continue
                    for w in words[k + 1:k + 1 + REACH]:
                        bare = w[0].lstrip(PUNCTUATION)
                        start = line.start() + w.end() - len(bare)
                        bare = bare.rstrip(PUNCTUATION)
                        if IDENTIFIER.fullmatch(bare) and DIGIT.search(bare) and LETTER.search(bare):
                            taken = taken or _Taken(base_spans(text))
                            if not taken(start, start + len(bare)):
                                out.append((row, asked[m[0]], bare.lower(), start, start + len(bare)))
        at = pa.array([o[0] for o in out], pa.int64())
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("text_key").take(at),
             *[pa.array([o[i + 1] for o in out], kind) for i, kind in enumerate(kinds)]],
            names=["doc_id", "text_key", "cue", "word", "start", "end"])

    places = map_texts(_keyed(docs), work, "doc_id long, text_key long, cue string, word string, start long, end long")
    places = stored(places.join(cues.select(F.col("word").alias("cue")), "cue", "left_semi"), "identifiers")
    n = docs.count()
    counts = document_counts(docs, places.select("word").distinct())
    told = counts.select("word", (F.log(F.lit(float(n)) / F.col("texts")) / math.log(max(n, 2))).alias("told")).where(
        F.col("told") >= GENERALISE_FROM)
    kind = F.when(F.col("told") >= REMOVE_FROM, "remove").otherwise("generalise")
    return places.join(told, "word").select("doc_id", "text_key", F.struct(
        kind.alias("kind"), "start", "end").alias("span")).groupBy("doc_id", "text_key").agg(
        F.collect_set("span").alias("spans"))


def telling_places(docs: DataFrame, telling: DataFrame) -> DataFrame:
    """doc_id, text_key, spans: where telling words stand outside base spans."""
    shared = docs.sparkSession.sparkContext.broadcast(word_filter(telling))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch, "text")
        found = split_words(texts)
        counted = normal(found.distinct)
        passing = _passing(counted, shared.value)
        asked = dict(zip(found.distinct.filter(pa.array(passing)).to_pylist(),
                         counted.filter(pa.array(passing)).to_pylist()))
        rows, out = np.unique(found.owners[passing[found.codes]]), []
        for row in rows.tolist():
            text = texts[row].as_py()
            taken = _Taken(base_spans(text))
            for m in WORD.finditer(text):
                word = asked.get(m[0])
                if word is not None:
                    bare = m[0].lstrip(PUNCTUATION)
                    start = m.end() - len(bare)
                    end = start + len(bare.rstrip(PUNCTUATION))
                    if not taken(start, end):
                        out.append((row, word, start, end))
        at = pa.array([o[0] for o in out], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("text_key").take(at),
             *[pa.array([o[i] for o in out], kind) for i, kind in ((1, pa.string()), (2, pa.int64()), (3, pa.int64()))]],
            names=["doc_id", "text_key", "word", "start", "end"])

    places = map_texts(_keyed(docs), work, "doc_id long, text_key long, word string, start long, end long")
    kind = F.when(F.col("revealed") >= REMOVE_FROM, "remove").otherwise("generalise")
    return (places.join(telling, "word").select("doc_id", "text_key", F.struct(
        kind.alias("kind"), "start", "end").alias("span"))
        .groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans")))


def find_spans(docs: DataFrame) -> DataFrame:
    """Every row's doc_id and text_key with its ``base`` spans and the ``added`` ones."""
    found = stored(find_base(docs), "base-spans")
    telling = telling_words(docs, found)
    both = telling_places(docs, telling).unionByName(pointed_at(docs, telling.where("cue")))
    added = both.groupBy("doc_id", "text_key").agg(F.array_sort(F.array_distinct(F.flatten(
        F.collect_list("spans")))).alias("added")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "added")
    return found.join(added, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")),
                      "left").select("doc_id", "text_key", F.col("spans").alias("base"),
                                     F.coalesce("added", F.array().cast(_SPANS)).alias("added"))


def listed(spans: Column) -> Column:
    """Spans as text, kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def cleaned(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with what stands for its spans. Of overlapping ones the first and longest names all."""
    parts, done, upto = [], 0, 0
    for start, _, end, kind in sorted((s, -e, e, k) for k, s, e in spans):
        if start >= upto:
            parts += [text[done:start], STANDS_FOR[kind]]
        upto = done = max(upto, end)
    return "".join(parts) + text[done:]


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data and telling words replaced in ``text``.

    ``n_chars``, if there, counts the new text. Rows without spans are returned as they are.
    """
    name, own = free_name(docs, "spans"), docs.columns
    spans = (find_spans(docs).where((F.size("base") > 0) | (F.size("added") > 0))
             .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
                     F.concat("base", "added").alias(name)).dropDuplicates(["_id", "_key"]))
    text = F.coalesce(F.col("docs.text").cast("string"), F.lit(""))
    joined = docs.alias("docs").join(
        spans.alias("found"), F.col("docs.doc_id").cast("long").eqNullSafe(F.col("found._id"))
        & (F.xxhash64(text) == F.col("found._key")), "left").select(
        *[F.col(f"docs.`{c}`") for c in docs.columns], F.col(f"found.{name}").alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            spans, text = batch.column(name), batch.column("text")
            rows = np.flatnonzero(np.asarray(pc.is_valid(spans)))
            new = text.to_pylist()
            for i in rows.tolist():
                new[i] = cleaned(new[i], [(s["kind"], s["start"], s["end"]) for s in spans[i].as_py()])
            columns = {c: batch.column(c) for c in own}
            columns["text"] = pa.array(new, text.type)
            if "n_chars" in columns:
                counted = pc.utf8_length(columns["text"]).cast(columns["n_chars"].type)
                columns["n_chars"] = pc.if_else(pc.is_valid(spans), counted, columns["n_chars"])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return joined.mapInArrow(freeing(run), StructType(docs.schema.fields))
