import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import multi_index

SCHEMA = "vec_id long, embedding array<float>"


def made(n, clusters, seed=1, d=16):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, d))
    return (centres[r.integers(0, clusters, n)] + 0.3 * r.normal(size=(n, d))).astype(np.float32)


def plain_nearest(rows, is_query, most=10):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and len(v) and None not in v
            and np.isfinite(np.array(v, np.float64)).all() and any(v)]
    out = {}
    for q, x in good:
        if is_query(q):
            best = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in good if i != q)[:most]
            out[q] = [(i, s) for s, i in best]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_found_vectors_are_near_and_scores_exact(spark):
    x = made(3000, 40)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("key")).withColumn("cell", F.lit(1))
    got = by_query(multi_index.nearest(table, F.col("vec_id") % 50 == 0))
    want = plain_nearest(rows, lambda i: i % 50 == 0)
    distance = {q: dict((i, float(np.sqrt(((x[i].astype(np.float64) - x[q].astype(np.float64)) ** 2).sum()))) for i, _ in own)
                for q, own in got.items()}
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert all(s == distance[q][i] and i != q for q, own in got.items() for i, s in own)
    assert all(own == sorted(own, key=lambda h: (h[1], h[0])) for own in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_everything_is_found_when_all_cells_are_asked(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(made(300, 1, 3))]
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [(2000, None), (2100, [0.0] * 16), (None, rows[1][1]),
             (2200, [float("nan")] + [1.0] * 15), (2300, [None] + [1.0] * 15), (2400, []), (2500, [float("inf")] * 16)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = by_query(multi_index.nearest(table, F.col("vec_id") % 20 == 0, recall=1.0, per_cell=400))
    assert got == plain_nearest(rows, lambda i: i % 20 == 0)


def test_small_and_empty_tables(spark):
    def nearest(rows):
        return by_query(multi_index.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0))

    assert nearest([]) == {} and nearest([(100, None)]) == {} and nearest([(100, [1.0, 2.0])]) == {}
    assert nearest([(1, [1.0, 2.0]), (2, [1.0, 3.0])]) == {}
    assert nearest([(0, [1.0, 2.0]), (1, [1.0, 5.0]), (2, [1.0, 5.0]), (3, [1.0])]) == {0: [(1, 3.0), (2, 3.0)]}
    assert nearest([(0, [1.0]), (1, [3.0])]) == {0: [(1, 2.0)]}


@pytest.mark.parametrize("k", [1, 7])
def test_cells_come_by_summed_distance(k):
    x = made(500, 5).astype(np.float64)
    cells = multi_index.Cells(x, k)
    counts = np.bincount(cells.of(x), minlength=len(cells.first) * len(cells.second))
    near = cells.nearest(x[3], counts, 10 ** 9)
    a, b = (multi_index.squared(h[None], c)[0] for h, c in ((x[3, :8], cells.first), (x[3, 8:], cells.second)))
    key = (a[:, None] + b[None, :]).ravel()
    assert sorted(near.tolist()) == np.flatnonzero(counts).tolist()
    assert np.all(np.diff(key[near]) >= 0) and heapq.nsmallest(1, key[near])[0] == key[near[0]]
    assert cells.depths(x[3], counts, near).tolist() == np.cumsum(counts[near]).tolist()
