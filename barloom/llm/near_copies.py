"""Groups of documents that share most of their five-word shingles.

Words are lower-cased (A-Z); a document's set holds its distinct runs of five words, or
all its words as one run if it has fewer. Two documents are linked if the Jaccard
similarity of their sets is at least ``percent``, and a group is what links connect.

1. One pass over the texts: documents with equal words are one class. A class gets
   circulant MinHash coordinates: one permutation scatters the shingles over 2**32 places,
   a second one, shifted on by one place for each coordinate, gives their ranks, and the
   smallest rank is the coordinate. Four coordinates make a band. There are as many bands
   as it takes (20 for 85 %, 28 for 80 %) that two classes at the threshold have none in
   common with a chance of at most 4 in 10 million.
2. Classes with a band in common form a bucket. Buckets with the same members are kept
   once; single ones fall out.
3. The sets of the classes left are built from the texts again. Buckets are cut into
   blocks of bounded size, each with the bucket's first class, and a block's links are
   confirmed on whole sets. What a block reports are links that connect its parts.
4. In buckets of several blocks, classes that are not yet connected with the bucket's
   largest group meet all other blocks, pair by pair of blocks. So every pair of a bucket
   is compared or known to be connected, and no task sees more than two blocks.

Shingles are compared by 64-bit hashes. A document without words has an empty set and is
alone. Rows with equal ids and texts are one document; rows with equal ids and other texts
are linked by their texts alone. A null id counts as larger than all others.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.components import components
from barloom.llm.words import freeing, hashes, map_texts, mixed, slices, split_words, texts_of
from barloom.session import stored

SHINGLE = 5
PERCENT = 85
ROWS = 4
# The chance that two classes at the threshold have no band in common.
MISSED = 4e-7
# Members of a block; a task holds two blocks at most.
BLOCK = 256
NO_ID = (1 << 63) - 1
FILTER_BITS = 1 << 26

_SIGNED = "doc_id long, text_key long, n_shingles long, class binary, bands array<long>"


def shingles_of(texts: pa.Array) -> tuple[list[np.ndarray], list[bytes]]:
    """The distinct shingles of every text, as sorted hashes, and a digest of its words."""
    words = split_words(pc.ascii_lower(texts))
    if not len(words.codes):
        return [np.zeros(0, np.uint64)] * len(texts), [b""] * len(texts)
    h = hashes(words.distinct)[words.codes]
    runs = h.copy()
    for k in range(1, SHINGLE):  # the hash at i covers words i .. i + k
        runs[:-k or None] = mixed(runs[:-k or None], 11) + h[k:]
    runs, sets, digests = mixed(runs, 12), [], []
    for first, last in zip(words.starts[:-1].tolist(), words.starts[1:].tolist()):
        digests.append(hashlib.blake2b(h[first:last].tobytes(), digest_size=16).digest() if last > first else b"")
        if last - first >= SHINGLE:
            sets.append(np.unique(runs[first:last - SHINGLE + 1]))
        else:  # a hash of its own kind: never that of a run of five
            whole = np.frombuffer(digests[-1][:8], np.uint64)
            sets.append(mixed(whole, 13))
    return sets, digests


def scattered(x: np.ndarray) -> np.ndarray:
    """A permutation of unsigned 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def bands_for(percent: int) -> int:
    """How many bands two sets of that similarity need to share one but for a chance of ``MISSED``."""
    if not 0 < percent <= 100:
        raise ValueError(f"not a percentage above 0: {percent}")
    if percent == 100:
        return 1
    return math.ceil(math.log(MISSED) / math.log1p(-(percent / 100) ** ROWS))


def coordinates(shingles: np.ndarray, n: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the smallest rank under the second permutation shifted by k."""
    places = scattered((shingles >> np.uint64(32)).astype(np.uint32))
    shifts = np.arange(1, n + 1, dtype=np.uint32)[:, None]
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for first in range(0, len(places), 4096):
        x = places[None, first:first + 4096] - shifts
        x ^= x >> np.uint32(17)
        x *= np.uint32(0xED5AD4BB)
        x ^= x >> np.uint32(11)
        x *= np.uint32(0xAC4C1B51)
        x ^= x >> np.uint32(15)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def bands_of(shingles: np.ndarray, bands: int) -> np.ndarray:
    c = coordinates(shingles, bands * ROWS).reshape(bands, ROWS).astype(np.uint64)
    number = np.arange(bands, dtype=np.uint64)
    for k in range(ROWS):
        number = mixed(number, 21) + c[:, k]
    return mixed(number, 22).view(np.int64)


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, class (digest of the words) and bands of every document."""
    n_bands = bands_for(percent)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets, digests = shingles_of(texts_of(batch, "text"))
        known: dict[bytes, np.ndarray] = {}
        for s, d in zip(sets, digests):
            if d and d not in known:
                known[d] = bands_of(s, n_bands)
        bands = [known[d] if d else np.zeros(0, np.int64) for d in digests]
        ends = np.concatenate([[0], np.cumsum([len(b) for b in bands])])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"),
             pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(bands)))],
            names=["doc_id", "text_key", "n_shingles", "class", "bands"])

    return map_texts(_keyed(docs), work, _SIGNED)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.xxhash64(text).alias("text_key"), text.alias("text"))


def sets_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """class, shingles of the documents ``chosen(class, doc_id, text_key)``.

    A filter of fixed size spares the other texts; what passes by accident falls out in a join.
    """
    place = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(FILTER_BITS)).alias("place")
    rows = (chosen.select((place + 1).alias("place"))
            .groupBy(F.expr("bitmap_bucket_number(place)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))).collect()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, own in rows:
        bits[(bucket - 1) * len(own):bucket * len(own)] = np.frombuffer(own, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place").to_numpy()
            asked = (shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            for part in slices([batch.filter(pa.array(asked.astype(bool)))], "text"):
                sets, _ = shingles_of(texts_of(part, "text"))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
                         np.concatenate(sets).view(np.int64)))], names=["doc_id", "text_key", "shingles"])

    found = _keyed(docs).withColumn("place", place).mapInArrow(
        freeing(run), "doc_id long, text_key long, shingles array<long>")
    return (found.join(chosen, ["doc_id", "text_key"]).groupBy("class")
            .agg(F.first("shingles").alias("shingles")))


def buckets_of(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (class, bucket, n) of buckets with two classes or more, and each class's first document."""
    classes = signed.where("n_shingles > 0").groupBy("class").agg(
        F.min(F.struct("doc_id", "text_key")).alias("one"), F.first("bands").alias("bands"))
    classes = stored(classes, "classes")
    banded = classes.select("class", F.explode("bands").alias("bucket"))
    full = banded.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("class").alias("first"),
        F.sum(F.xxhash64("class").cast("decimal(20,0)")).alias("sum")).where("n > 1")
    # Equal counts, sums of hashes and first members: the same members.
    kept = full.groupBy("n", "first", "sum").agg(F.min("bucket").alias("bucket")).select("bucket", "n", "first")
    members = stored(banded.join(kept, "bucket"), "buckets")
    chosen = stored(classes.join(members.select("class").distinct(), "class", "left_semi")
                    .select("class", "one.doc_id", "one.text_key"), "chosen")
    return members, chosen


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of some sets share."""
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, columns, counts = np.unique(values, return_inverse=True, return_counts=True)
    common = counts > 1
    number = np.cumsum(common) - 1
    held = common[columns]
    columns, owners = number[columns[held]], owners[held]
    order = np.argsort(columns, kind="stable")
    columns, owners = columns[order], owners[order]
    out, wide = np.zeros((len(sets), len(sets)), np.int64), 4096
    for first in range(0, int(common.sum()), wide):
        a, b = np.searchsorted(columns, [first, first + wide])
        has = np.zeros((len(sets), wide), np.float32)
        has[owners[a:b], columns[a:b] - first] = 1
        out += (has @ has.T).astype(np.int64)
    return out


def joining_links(sets: list[np.ndarray], groups: list, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect members of different groups; of links within what they connect, none."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict = {}
    for i, g in enumerate(groups):
        if g is not None:
            root[i] = find(first.setdefault(g, i))
    sizes = np.array([len(s) for s in sets])
    common = _overlaps(sets)
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    out = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        a, b = find(int(i)), find(int(j))
        if a != b:
            root[b] = a
            out.append((int(i), int(j)))
    return out


def confirmed(blocks: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links a, b within ``blocks(block, class, shingles, label)``; members with one label are connected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, classes, sets, labels = None, [], [], []
        out: list[tuple[bytes, bytes]] = []

        def finish() -> None:
            if len(classes) > 1:
                out.extend((classes[i], classes[j]) for i, j in joining_links(sets, labels, percent))

        def taken() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["a", "b"])
            out.clear()
            return rows

        for batch in batches:
            lists = batch.column("shingles")
            ends, flat = np.asarray(lists.offsets), lists.values.to_numpy()
            names = [batch.column(c).to_pylist() for c in ("block", "class", "label")]
            for row, (block, own, label) in enumerate(zip(*names)):
                if block != now:
                    finish()
                    now, classes, sets, labels = block, [], [], []
                if not classes or classes[-1] != own:  # sorted by class: a first member comes twice
                    classes.append(own)
                    sets.append(flat[ends[row]:ends[row + 1]].copy())
                    labels.append(label)
            yield taken()
        finish()
        yield taken()

    rows = blocks.select("block", "class", "label", "shingles").repartition("block")
    return rows.sortWithinPartitions("block", "class").mapInArrow(freeing(run), "a binary, b binary")


def _block(n: Column) -> Column:
    """A member's block out of as many as ``n`` members need."""
    return F.pmod(F.xxhash64("class", F.lit(31)), F.ceil(n / BLOCK).cast("long"))


def links_within_blocks(members: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    n = F.ceil(F.col("n") / BLOCK).cast("long")
    own = F.when(F.col("class") == F.col("first"), F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(
        F.array(_block(F.col("n"))))
    placed = members.withColumn("at", F.explode(own)).select(
        F.xxhash64("bucket", "at").alias("block"), "class", F.lit(None).cast("binary").alias("label"))
    return confirmed(placed.join(sets, "class"), percent)


def links_between_blocks(members: DataFrame, sets: DataFrame, labels: DataFrame,
                         percent: int = PERCENT) -> DataFrame:
    """Links of classes outside a bucket's largest group, in buckets of several blocks."""
    many = members.where(F.col("n") > BLOCK).join(
        labels.select(F.col("vertex").alias("class"), "label"), "class", "left").select(
        "bucket", "class", F.coalesce("label", "class").alias("label"))
    groups = many.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    shape = groups.groupBy("bucket").agg(
        F.max(F.struct("size", "label")).alias("top"), F.sum("size").alias("n"), F.count("*").alias("groups")
    ).where("groups > 1").select(
        "bucket", F.col("top.label").alias("top"),
        F.ceil(F.col("top.size") / BLOCK).cast("long").alias("inside"),
        F.ceil((F.col("n") - F.col("top.size")) / BLOCK).cast("long").alias("outside"))
    hashed = F.xxhash64("class", F.lit(32))
    is_top = F.col("label") == F.col("top")
    # Blocks 0 .. inside - 1 hold the largest group, the others the rest. Pairs of blocks with one of the rest.
    at = F.when(is_top, F.pmod(hashed, F.col("inside"))).otherwise(
        F.col("inside") + F.pmod(hashed, F.col("outside")))
    last = F.col("inside") + F.col("outside") - 1
    with_rest = F.transform(F.sequence(F.col("inside"), last), lambda j: F.struct(
        F.least("at", j).alias("i"), F.greatest("at", j).alias("j")))
    with_top = F.transform(F.sequence(F.lit(0).cast("long"), F.col("inside") - 1), lambda i: F.struct(
        i.alias("i"), F.col("at").alias("j")))
    pairs = F.when(is_top, with_rest).otherwise(F.concat(with_rest, with_top))
    placed = many.join(shape, "bucket").withColumn("at", at).withColumn("pair", F.explode(pairs)).select(
        F.xxhash64("bucket", "pair.i", "pair.j", F.lit(33)).alias("block"), "class", "label")
    return confirmed(placed.join(sets, "class"), percent)


def near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept and first of every row, linked from ``percent`` on.

    ``component_id`` is the smallest id that links lead to; ``kept`` marks its document. Where several
    texts of a group have that id (repeated or null ids), ``first`` marks the one with the smallest text_key.
    """
    signed = stored(signatures(docs, percent), "signatures")
    members, chosen = buckets_of(signed)
    sets = stored(sets_of(docs, chosen), "shingle-sets")
    links = stored(links_within_blocks(members, sets, percent), "links-within")
    labels = components(links)
    further = stored(links_between_blocks(members, sets, labels, percent), "links-between")
    if not further.isEmpty():
        labels = components(links.union(further))
    ids = signed.groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("least")).join(
        labels.select(F.col("vertex").alias("class"), "label"), "class", "left")
    ids = stored(ids.select("class", "least", F.coalesce("label", "class").alias("label")), "class-ids")
    # The links' ends are few; the other classes are their own groups.
    grouped = ids.join(labels.select(F.col("vertex").alias("class")), "class", "left_semi").groupBy(
        "label").agg(F.min("least").alias("group_least"))
    known = ids.join(grouped, "label", "left").select(
        F.col("class").alias("_class"), F.coalesce("group_least", "least").alias("least"))
    own = F.struct("doc_id", "text_key")
    least = F.when(F.col("n_shingles") == 0, own).otherwise(F.col("least"))
    out = signed.join(known, F.col("class") == F.col("_class"), "left").withColumn("least", least).withColumn(
        "component", F.col("least.doc_id"))
    return out.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "text_key", "n_shingles",
                      F.nullif("component", F.lit(NO_ID)).alias("component_id"),
                      (F.col("doc_id") == F.col("component")).alias("kept"), (own == F.col("least")).alias("first"))


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of near copies, that of the smallest id, other rows unchanged.

    Rows with equal ids and texts are one document and stay together.
    """
    gone = near_copies(docs, percent).where(~F.col("first")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    text = F.coalesce(F.col("docs.text").cast("string"), F.lit(""))
    return docs.alias("docs").join(
        gone.alias("gone"), F.col("docs.doc_id").cast("long").eqNullSafe(F.col("gone._id"))
        & (F.xxhash64(text) == F.col("gone._key")), "left_anti")
