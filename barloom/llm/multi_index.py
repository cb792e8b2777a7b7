"""Nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately, each to one of k centroids, so k * k cells
divide the vectors finely with 2 k centroids. For a query, pairs of centroids are taken in the
order of their summed squared distances, by a heap over the two sorted lists, until the cells
hold enough vectors; these are ranked by their distances to the query itself.

* How many are enough is measured: ``PILOTS`` queries are compared with all vectors, and the traversal
  goes as deep as the share ``recall`` of their true neighbours needs. Clustered vectors need few;
  vectors without structure need a large part of the table, whatever the index.

* The centroids are fitted on at most ``SAMPLE`` vectors, those with the smallest hashes of their
  components; the number k grows with the root of the number of vectors, up to ``MOST_CENTROIDS``,
  so that a cell holds about ``PER_CELL`` of them. Every vector is indexed.
* Of equal vectors the rows with the smallest ids answer for all: as many as are asked for and one
  more, as the others come after them in every answer. Equal queries are searched once.
* Cells are cut into blocks of at most about ``BLOCK`` vectors, and blocks are dealt to shards of about
  that many vectors. A query goes to the shards that hold one of its blocks, with the numbers of these,
  and each shard answers with its best. Nothing is left out of a cell, however large.
* On the driver: the sample, the centroids, the pilots with their neighbours' cells, and the number of vectors of each cell (``MOST_CENTROIDS`` ** 2
  numbers at most, whatever the table).

Vectors that are null, zero, or of another length than most, or hold null or non-finite components take
no part, nor do null ids. Rows with the query's id are not among its answers; other rows with equal ids
are answers of their own. Fewer candidates than asked for give fewer rows. An empty table gives no rows.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.words import freeing, mixed
from barloom.session import stored

NEAREST = 10
# The share of true neighbours that the traversal is made deep enough for, and the queries that tell.
RECALL = 0.95
PILOTS = 64
SAMPLE = 16_384
MOST_CENTROIDS = 1024
PER_CELL = 2
BLOCK = 4096
ROUNDS = 12


def usable_vectors(table: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, embedding and key (a hash of the components) of the rows that take part."""
    v = F.col("embedding")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col(ident).cast("long").alias("vec_id"), F.col(vector).alias("embedding")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & whole & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size(v) == (sizes["size"] if sizes else 0)).withColumn("key", F.xxhash64(v))


def matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of doubles."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)[None, :]


def fitted(x: np.ndarray, k: int) -> np.ndarray:
    """k centroids of the rows of ``x``; its first different rows are the start."""
    _, first = np.unique(x, axis=0, return_index=True)
    centroids = x[np.sort(first)[:k]].copy()
    for _ in range(ROUNDS):
        own = squared(x, centroids).argmin(1)
        n = np.bincount(own, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, own, x)
        centroids[n > 0] = total[n > 0] / n[n > 0, None]
    return centroids


class Cells:
    """The centroids of both halves."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.first, self.second = fitted(sample[:, :self.half], k), fitted(sample[:, self.half:], k)

    def of(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        own = squared(x[:, :self.half], self.first).argmin(1)
        return own * len(self.second) + squared(x[:, self.half:], self.second).argmin(1)

    def nearest(self, x: np.ndarray, counts: np.ndarray, enough: int) -> np.ndarray:
        """The cells of a query, nearest pair of centroids first, until they hold ``enough`` vectors."""
        a, b = squared(x[None, :self.half], self.first)[0], squared(x[None, self.half:], self.second)[0]
        by_a, by_b = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
        a, b = np.sort(a).tolist(), np.sort(b).tolist()
        heap, reached, out, held = [(a[0] + b[0], 0, 0)], [0] * len(a), [], 0
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            cell = by_a[i] * len(b) + by_b[j]
            if counts[cell]:
                out.append(cell)
                held += int(counts[cell])
            # Each pair is put on the heap once: by its left neighbour, or in the first column by the one above.
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        return np.array(out, np.int64)

    def depths(self, x: np.ndarray, counts: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many vectors a query's traversal has met when it has gone through each of some cells."""
        a, b = squared(x[None, :self.half], self.first)[0], squared(x[None, self.half:], self.second)[0]
        order = np.argsort((a[:, None] + b[None, :]).ravel(), kind="stable")
        met = np.empty(len(order), np.int64)
        met[order] = np.cumsum(counts[order])
        return met[cells]


def enough_for(indexed: DataFrame, queries: DataFrame, cells: Cells, counts: np.ndarray, most: int,
               recall: float) -> int:
    """How many vectors a traversal must meet to find the share ``recall`` of the true neighbours.

    Measured on at most ``PILOTS`` queries, those with the smallest hashes, against all vectors. A task
    keeps ``most`` neighbours of each; as many rows come to the driver.
    """
    pilots = queries.orderBy("key", "least").limit(PILOTS).select("least", "embedding").toArrow()
    if not pilots.num_rows:
        return 1
    own, x = pilots.column("least").to_numpy(), matrix(pilots.column("embedding").combine_chunks())
    shared = indexed.sparkSession.sparkContext.broadcast((own, x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, x = shared.value
        best = [(np.zeros(0), np.zeros(0, np.int64))] * len(own)
        for batch in batches:
            ids, cell = (batch.column(c).to_numpy() for c in ("vec_id", "cell"))
            near = squared(x, matrix(batch.column("embedding")))
            near[own[:, None] == ids[None, :]] = np.inf
            for p, (score, at) in enumerate(best):
                score, at = np.concatenate([score, near[p]]), np.concatenate([at, cell])
                kept = np.argsort(score, kind="stable")[:most]
                best[p] = score[kept], at[kept]
        rows = [(p, s, c) for p, (score, at) in enumerate(best) for s, c in zip(score.tolist(), at.tolist()) if s < np.inf]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
            (pa.int64(), pa.float64(), pa.int64()))], names=["pilot", "score", "cell"])

    first = Window.partitionBy("pilot").orderBy("score", "cell")
    found = (indexed.mapInArrow(freeing(run), "pilot long, score double, cell long")
             .withColumn("place", F.row_number().over(first)).where(F.col("place") <= most).toArrow())
    pilot, cell = found.column("pilot").to_numpy(), found.column("cell").to_numpy()
    depths = [cells.depths(x[p], counts, cell[pilot == p]) for p in np.unique(pilot).tolist()]
    return int(np.quantile(np.concatenate(depths), recall, method="higher")) if depths else 1


def _block(cell: np.ndarray, part: np.ndarray) -> np.ndarray:
    return (cell << 32) + part


def _shard(block: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(block.astype(np.uint64), 41) % np.uint64(shards)).astype(np.int64)


_ROWS = "shard long, kind int, id long, embedding array<double>, blocks array<long>"


def _rows(shard, kind, ids, x, blocks) -> pa.RecordBatch:
    """Rows of vectors ``x`` with a list of blocks each."""
    ends = np.arange(len(ids) + 1, dtype=np.int32) * x.shape[1]
    return pa.RecordBatch.from_arrays(
        [pa.array(shard, pa.int64()), pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids, pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel(), pa.float64())),
         pa.array(blocks, pa.list_(pa.int64()))], names=["shard", "kind", "id", "embedding", "blocks"])


def placed(indexed: DataFrame, counts, shards: int) -> DataFrame:
    """The vectors with their blocks and shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cell = (batch.column(c).to_numpy() for c in ("vec_id", "cell"))
            parts = -(-counts.value[cell] // BLOCK)
            block = _block(cell, (mixed(ids.astype(np.uint64), 42) % parts.astype(np.uint64)).astype(np.int64))
            yield _rows(_shard(block, shards), 0, ids, matrix(batch.column("embedding")), block[:, None].tolist())

    return indexed.select("vec_id", "embedding", "cell").mapInArrow(freeing(run), _ROWS)


def asked(queries: DataFrame, cells, counts, shards: int, candidates: int) -> DataFrame:
    """Each query once for every shard that holds one of its blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("embedding"))
            for number, row in zip(batch.column("query").to_pylist(), x):
                near = cells.value.nearest(row, counts.value, candidates)
                parts = -(-counts.value[near] // BLOCK)
                block = _block(np.repeat(near, parts),
                               np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
                shard = _shard(block, shards)
                by = np.argsort(shard, kind="stable")
                own, first = np.unique(shard[by], return_index=True)
                yield _rows(own, 1, np.full(len(own), number), np.tile(row, (len(own), 1)),
                            [b.tolist() for b in np.split(block[by], first[1:])])

    return queries.select("query", "embedding").mapInArrow(freeing(run), _ROWS)


_FOUND = "query long, ids array<long>, scores array<double>"


def searched(rows: DataFrame, most: int) -> DataFrame:
    """query, ids, scores: for each row of a query the ``most`` nearest vectors of its blocks in the shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, vectors, ids, where = None, [], None, None, {}
        for batch in batches:
            shards, kinds, numbers = (batch.column(c).to_numpy() for c in ("shard", "kind", "id"))
            x, blocks = matrix(batch.column("embedding")), batch.column("blocks").to_pylist()
            out = []
            for r in range(batch.num_rows):
                if shards[r] != now:
                    now, held, vectors = shards[r], [], None
                if kinds[r] == 0:  # the vectors of a shard come before its queries
                    held.append((blocks[r][0], numbers[r], x[r].copy()))
                    continue
                if vectors is None:
                    held.sort(key=lambda h: h[0])
                    vectors = np.array([h[2] for h in held]).reshape(len(held), x.shape[1])
                    ids = np.array([h[1] for h in held], np.int64)
                    block, first, n = np.unique([h[0] for h in held], return_index=True, return_counts=True)
                    where = {b: (f, f + c) for b, f, c in zip(block.tolist(), first.tolist(), n.tolist())}
                    held = []
                own = np.concatenate([np.arange(*where[b]) for b in blocks[r]])
                score = np.sqrt(((vectors[own] - x[r]) ** 2).sum(1))
                best = np.lexsort((ids[own], score))[:most]
                out.append((numbers[r], ids[own][best].tolist(), score[best].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], kind) for i, kind in enumerate(
                    (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())))], names=["query", "ids", "scores"])

    return rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(freeing(run), _FOUND)


def nearest(table: DataFrame, is_query: Column, most: int = NEAREST, recall: float = RECALL,
            per_cell: int = PER_CELL) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``most`` nearest vectors found of every query.

    ``table`` has vec_id and embedding; queries are the rows that satisfy ``is_query``, a condition on
    vec_id, candidates all rows but the query's own. Equal distances are ranked by vec_id.
    """
    spark = table.sparkSession
    rows = stored(usable_vectors(table), "vectors")
    same = Window.partitionBy("key", "embedding").orderBy("vec_id")
    first = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= most + 1)
    first = stored(first, "first-copies")
    sample = first.where("copy = 1").orderBy("key", "vec_id").limit(SAMPLE).select("embedding").toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = matrix(sample.column("embedding").combine_chunks())
    n = first.count()
    cells = Cells(sample, max(1, min(MOST_CENTROIDS, len(sample) // 8, round((n / per_cell) ** 0.5))))
    shared = spark.sparkContext.broadcast(cells)

    def of_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("cell", pa.array(shared.value.of(matrix(batch.column("embedding")))))

    kind = first.schema["embedding"].dataType.simpleString()
    indexed = stored(first.select("vec_id", "embedding").mapInArrow(
        freeing(of_cells), f"vec_id long, embedding {kind}, cell long"), "cells")
    counts = np.zeros(len(cells.first) * len(cells.second), np.int64)
    held = indexed.groupBy("cell").count().toArrow()  # a row per cell at most
    counts[held.column("cell").to_numpy()] = held.column("count").to_numpy()
    asking = rows.where(is_query)
    queries = stored(asking.groupBy("key", "embedding").agg(F.min("vec_id").alias("least"))
                     .withColumn("query", F.monotonically_increasing_id()), "queries")
    candidates = enough_for(indexed, queries, cells, counts, most, recall)
    counts, shards = spark.sparkContext.broadcast(counts), max(1, -(-n // BLOCK))
    to_search = placed(indexed, counts, shards).unionByName(asked(queries, shared, counts, shards, candidates))
    found = searched(to_search, most + 1).groupBy("query").agg(
        F.flatten(F.collect_list(F.arrays_zip(F.col("scores").alias("score"), F.col("ids").alias("vec_id")))).alias("all"))
    found = stored(queries.join(found, "query").select(
        "key", "embedding", F.slice(F.array_sort("all"), 1, most + 1).alias("best")), "answers")
    answers = asking.join(found, ["key", "embedding"]).select(
        F.col("vec_id").alias("query_id"),
        F.posexplode(F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("vec_id")), 1, most)).alias("place", "hit"))
    return answers.select("query_id", (F.col("place") + 1).cast("int").alias("rank"),
                          F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
