"""Groups of spelling variants: words one edit apart, and what each is a variant of.

A word is a run of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z lower-cased; words of at
least ``LEAST_LENGTH`` code points that occur ``LEAST_COUNT`` times are the vocabulary. Two
words are near if one code point inserted, deleted or replaced makes one the other. A word's
form is its most frequent near word (ties: the first in code-point order) if that occurs
``LEAST_RATIO`` times as often; its root is where the forms lead.

Near words are found by dynamic programming over sorted lists. One edit lies in one third of
the shorter word, so words that agree outside that third make up a list (two lists for each
word and third: as the shorter or equal one and as the longer one). A list holds the differing
parts in order, which puts equal prefixes side by side; the common prefixes of neighbours cut
it into ranges. The edit matrix has three cells a row (the diagonal and one beside it); the row
of a prefix is made once for each range and part and reused by all words of the range, and a
range whose row has no cell of one edit or less is skipped whole. All parts of many lists go down
together, row by row.

A list of more than ``MOST_LISTED`` words is not scanned: its words go into lists again, by thirds
of the part that differed, until lists are short. Parts of a single letter have at most some
3,500 words, so this ends, and no task holds more than a list of that size.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.words import freeing, map_texts, texts_of
from barloom.session import stored

LEAST_LENGTH = 5
LEAST_COUNT = 3
LEAST_RATIO = 2
MOST_LISTED = 8192
PARTS = 3
# Pairs of a part and a range looked at together.
PORTION = 1 << 20
NOT_LETTERS = r"[^a-z\x{C0}-\x{FF}]+"
_FAR = 9


class _ShiftedChecksums:
    """crc32 of texts put together, from the checksums of their parts (crc32 is linear)."""

    def __init__(self):
        self.tables: dict[int, np.ndarray] = {}

    def table(self, size: int) -> np.ndarray:
        """What each byte of a checksum becomes when ``size`` more bytes follow."""
        if size not in self.tables:
            zeros = bytes(size)
            base = zlib.crc32(zeros)
            self.tables[size] = np.array([[zlib.crc32(zeros, b << (8 * k)) ^ base for b in range(256)]
                                          for k in range(4)], np.uint32)
        return self.tables[size]

    def joined(self, first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
        """Checksums of first + second, the second ones ``size`` bytes long."""
        t = self.table(size)
        return t[0][first & 255] ^ t[1][(first >> 8) & 255] ^ t[2][(first >> 16) & 255] ^ t[3][first >> 24] ^ second


_checksums = _ShiftedChecksums()


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The text of every word, its place among the distinct words, and these."""
    cut = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts), NOT_LETTERS, " "))
    coded = cut.flatten().dictionary_encode()
    owners = np.repeat(np.arange(len(texts)), np.diff(np.asarray(cut.offsets)))
    codes = np.asarray(coded.indices, dtype=np.int64)
    return owners, codes, coded.dictionary


def _counted(part: pa.RecordBatch, one_in: int) -> pa.RecordBatch:
    """word, n of a slice; one occurrence in ``one_in`` loses a letter."""
    owners, codes, distinct = _letters(texts_of(part, "text"))
    listed = distinct.to_pylist()
    dropped = np.zeros(len(codes), bool)
    hashes = np.zeros(len(codes), np.uint32)
    if one_in and len(codes):
        prefixes = np.array([zlib.crc32(f"{i}:".encode()) for i in texts_of(part, "doc_id").to_pylist()], np.uint32)
        own = np.array([zlib.crc32(w.encode()) for w in listed], np.uint32)
        sizes = np.asarray(pc.binary_length(distinct), np.int64)
        by = np.argsort(sizes[codes], kind="stable")
        lengths = sizes[codes[by]]
        cuts = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), len(by)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = by[a:b]
            hashes[at] = _checksums.joined(prefixes[owners[at]], own[codes[at]], int(lengths[a]))
        dropped = hashes % one_in == 0
    dropped &= np.asarray(pc.utf8_length(distinct), np.int64)[codes] > 0 if len(codes) else dropped
    n = np.bincount(codes[~dropped], minlength=len(listed))
    whole = np.flatnonzero((n > 0) & (np.asarray(pc.utf8_length(distinct)) >= LEAST_LENGTH)) if len(listed) else []
    shortened = []
    for code, h in zip(codes[dropped].tolist(), hashes[dropped].tolist()):
        w = listed[code]
        shortened.append(w[:h % len(w)] + w[h % len(w) + 1:])
    rest = [w for w in shortened if len(w) >= LEAST_LENGTH]
    words = [listed[i] for i in whole] + rest
    counts = np.concatenate([n[whole] if len(whole) else np.zeros(0, np.int64), np.ones(len(rest), np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.astype(np.int64))],
                                      names=["word", "n"])


def vocabulary(docs: DataFrame, one_in: int = 0) -> DataFrame:
    """word, n: the words of whole texts that are long and frequent enough.

    With ``one_in`` an occurrence loses a letter if that number divides the crc32 of
    ``<doc_id>:<word>``: the one at the checksum modulo the word's length.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    counted = map_texts(rows, lambda part: _counted(part, one_in), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _lists(words: DataFrame, short: Column, first: Column, upto: Column) -> DataFrame:
    """Entries of the lists for the thirds of places first .. upto of the shorter word."""
    thirds = [F.struct((first + F.floor((upto - first) * k / PARTS)).cast("int").alias("first"),
                       (first + F.floor((upto - first) * (k + 1) / PARTS)).cast("int").alias("upto"))
              for k in range(PARTS)]
    cut = words.select("word", "n", short.cast("int").alias("short"), F.explode(F.array(*thirds)).alias("third"))
    cut = cut.where("third.first < third.upto").select("word", "n", "short", "third.first", "third.upto")
    more = F.length("word") - F.col("short")
    size = F.col("upto") - F.col("first") + more
    return cut.select(
        F.concat_ws(".", "short", "first", "upto", F.substring("word", F.lit(1), F.col("first")),
                    F.substring("word", F.col("upto") + more + 1, F.length("word"))).alias("list"),
        F.substring("word", F.col("first") + 1, size).alias("part"), "word", "n", "short", "first", "upto")


def near_in_lists(group: np.ndarray, parts: np.ndarray, shorter: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of a word, of a near word of the same length or one longer).

    ``parts`` holds code points, 0 after a part's end, sorted within each ``group`` (a number for each
    row, not falling); parts have ``shorter`` code points or one more. Unless ``last``, a longer part
    that begins with the whole shorter one is left to the next third.
    """
    n, width = parts.shape
    asking = np.flatnonzero(parts[:, shorter] == 0)
    # Where a prefix of d + 1 places differs from the one before: a range begins.
    differs = np.ones((n, width + 1), bool)
    differs[1:, 0] = group[1:] != group[:-1]
    differs[1:, 1:] = parts[1:] != parts[:-1]
    begins = np.logical_or.accumulate(differs, axis=1)
    ranges = np.cumsum(begins, axis=0) - 1
    firsts = [np.append(np.flatnonzero(begins[:, d]), n) for d in range(width + 1)]
    # One place before and two after, so that the cells beside the diagonal can be asked for.
    asked = np.zeros((n, width + 3), parts.dtype)
    asked[:, 1:width + 1] = parts
    own = ranges[asking, 0]
    cost = np.cumsum(firsts[0][own + 1] - firsts[0][own])
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(asking):
        upto = max(at + 1, int(np.searchsorted(cost, PORTION + (cost[at - 1] if at else 0), "right")))
        word, node = asking[at:upto], own[at:upto]
        before, on, after = (np.full(len(word), v, np.int8) for v in (_FAR, 0, 1))
        at = upto
        for d in range(width):
            if d == shorter:  # a word of the same length ends here
                row = firsts[d][node]
                hit = (on == 1) & (parts[row, d] == 0)
                out_a.append(word[hit])
                out_b.append(row[hit])
            # The ranges one place longer.
            low = ranges[firsts[d][node], d + 1]
            count = ranges[firsts[d][node + 1] - 1, d + 1] - low + 1
            who = np.repeat(np.arange(len(word)), count)
            node = low[who] + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
            word = word[who]
            letter = parts[firsts[d + 1][node], d]
            b = before[who] + (letter != asked[word, d])
            before_ = np.minimum(b, on[who] + 1)
            on_ = np.minimum(np.minimum(on[who] + (letter != asked[word, d + 1]), after[who] + 1), before_ + 1)
            after_ = np.minimum(after[who] + (letter != asked[word, d + 2]), on_ + 1)
            alive = (letter != 0) & (np.minimum(np.minimum(before_, on_), after_) <= 1)
            word, node = word[alive], node[alive]
            before, on, after = (c[alive].astype(np.int8) for c in (before_, on_, after_))
        row = firsts[width][node]
        hit = before == 1
        if not last:
            hit &= (parts[word, :shorter] != parts[row, :shorter]).any(axis=1)
        for a, b in ((word[hit], row[hit]), (row[hit], word[hit])):
            out_a.append(a)
            out_b.append(b)
    return np.concatenate(out_a), np.concatenate(out_b)


_LINKS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string()), ("other_n", pa.int64()),
                    ("short", pa.int32()), ("first", pa.int32()), ("upto", pa.int32())])


def _links_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links of whole lists."""
    rows = rows.combine_chunks()
    listed = rows.column("list").combine_chunks().dictionary_encode()  # numbers in order of first sight: not falling
    group = np.asarray(listed.indices, np.int64)
    first, upto, short = (rows.column(c).to_numpy() for c in ("first", "upto", "short"))
    size = upto - first
    lone = np.bincount(group, minlength=1)[group] == 1 if len(group) else np.zeros(0, bool)
    for shorter in np.unique(size[~lone]).tolist():
        for last in (False, True):
            own = np.flatnonzero((size == shorter) & ~lone & ((upto == short) == last))
            if not len(own):
                continue
            parts = np.array(rows.column("part").take(pa.array(own)).to_pylist(), f"U{shorter + 1}")
            a, b = near_in_lists(group[own], parts.view(np.uint32).reshape(len(own), shorter + 1), shorter, last)
            a, b = pa.array(own[a]), pa.array(own[b])
            none = pa.nulls(len(a), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c).take(at).combine_chunks() for at in (a, b) for c in ("word", "n")], none, none, none],
                schema=_LINKS)


def _again(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Words of a list that is too long: no other word, to be put into finer lists."""
    none = {"other": pa.nulls(len(rows), pa.string()), "other_n": pa.nulls(len(rows), pa.int64())}
    yield from pa.Table.from_arrays(
        [none[f.name] if f.name in none else rows.column(f.name) for f in _LINKS], schema=_LINKS).to_batches()


def _divisible(rows: pa.Table) -> np.ndarray:
    """Rows of lists whose parts have more than a letter; other lists are short anyway."""
    return rows.column("upto").to_numpy() - rows.column("first").to_numpy() > 1


def _whole_lists(rows: pa.Table, most: int) -> Iterator[pa.RecordBatch]:
    lists = np.asarray(rows.column("list").combine_chunks().dictionary_encode().indices, np.int64)
    long = (np.bincount(lists)[lists] > most) & _divisible(rows)
    if long.any():
        yield from _again(rows.filter(pa.array(long)))
        rows = rows.filter(pa.array(~long))
    if len(rows):
        yield from _links_of(rows)


def _scan(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Links of the lists in sorted rows; the last list of a batch may go on in the next one."""
    held, long_list = None, None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if long_list is not None:
            more = pc.equal(rows.column("list"), long_list)
            yield from _again(rows.filter(more))
            rows = rows.filter(pc.invert(more))
            if not len(rows):
                continue
            long_list = None
        held = rows if held is None else pa.concat_tables([held, rows])
        if not len(held):
            continue
        final = held.column("list")[-1]
        whole = pc.index(held.column("list"), final).as_py()
        if whole:
            yield from _whole_lists(held.slice(0, whole), most)
            held = held.slice(whole)
        if len(held) > most and _divisible(held.slice(0, 1))[0]:
            yield from _again(held)
            held, long_list = None, final
    if held is not None and len(held):
        yield from _whole_lists(held, most)


def near_words(words: DataFrame, most_listed: int = MOST_LISTED) -> DataFrame:
    """word, n, other, other_n: both directions of every pair of near words of ``words(word, n)``, once each."""
    long_enough = F.length("word") > LEAST_LENGTH
    roles = F.when(long_enough, F.array(F.length("word"), F.length("word") - 1)).otherwise(F.array(F.length("word")))
    cut = words.select("word", "n", F.explode(roles).alias("short"))
    lists = _lists(cut, F.col("short"), F.lit(0), F.col("short"))
    found = None
    while True:
        sorted_lists = lists.repartition("list").sortWithinPartitions("list", "part")
        links = stored(sorted_lists.mapInArrow(
            freeing(lambda rows: _scan(rows, most_listed)),
            "word string, n long, other string, other_n long, short int, first int, upto int"), "near-words")
        own = links.where("other IS NOT NULL").select("word", "n", "other", "other_n")
        found = own if found is None else found.unionByName(own)
        left = links.where("other IS NULL")
        if left.isEmpty():
            return found
        lists = _lists(left, F.col("short"), F.col("first"), F.col("upto"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every word of ``forms(word, form)`` with a form: where the forms lead.

    Each round doubles the way that a row has come; a form occurs at least twice as often as its word, so
    the rounds are few.
    """
    known = stored(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(known.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        known = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return known


def variants(docs: DataFrame, one_in: int = 0, most_listed: int = MOST_LISTED) -> DataFrame:
    """word, form, root, n, n_near, form_n of the vocabulary of ``docs(doc_id, text)``.

    Null texts have no words; a null id counts as an empty one; rows with equal ids are counted one by
    one, repeated rows too; an empty table gives no rows; other columns are not looked at.
    """
    words = stored(vocabulary(docs, one_in), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("word")))
    near = near_words(words, most_listed).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= LEAST_RATIO * F.col("n")
    joined = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"),
        F.when(enough, -F.col("best.minus")).alias("form_n")), "word-forms")
    return joined.join(roots(joined), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
