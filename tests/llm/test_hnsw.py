import numpy as np
import pytest
from pyspark.sql import functions as F

from tapecraft.llm.hnsw import build_graph, build_index, nearest_neighbours, usable

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, shard int, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, -1, -1, "x") for i, v in rows], SCHEMA)


def clustered(n, dim, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim)) * 3
    return (centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim))).astype(np.float32)


def brute(rows, query_id, k):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        vectors.setdefault(i, np.array(v, np.float64))
    q = vectors[query_id]
    found = [(float(np.sqrt(((v - q) ** 2).sum())), i) for i, v in vectors.items() if i != query_id and len(v) == len(q)]
    return sorted(found)[:k]


def test_recall_and_scores(spark):
    vectors = clustered(1500, 16)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = {}
    for r in nearest_neighbours(spark, table(spark, rows).repartition(3), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1500, 50))
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        for _, i, s in found:
            assert s == pytest.approx(np.sqrt(((vectors[i].astype(float) - vectors[q].astype(float)) ** 2).sum()), abs=1e-12)
        hits += len({f[1] for f in found} & {i for _, i in brute(rows, q, 10)})
    assert hits >= 0.9 * 10 * len(got)


def test_copies_ties_and_unusable_rows(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 4000, 10)] + [(5, [1.0, 2.0, 3.5]), (7, None), (8, []), (9, [0.0, 0.0, 0.0]),
            (11, [float("nan"), 1.0, 1.0]), (12, [float("inf"), 1.0, 1.0]), (13, [None, 1.0, 1.0]), (None, same), (100, same),
            (15, [1.0, 2.0]), (200, same)]
    got = {}
    for r in nearest_neighbours(spark, table(spark, rows), F.col("vec_id").isin(0, 100, 5, 15, 9, 7), k=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [0, 5, 100]      # 15 is alone in its dimension, 7 and 9 take no part
    for q in (0, 100, 5):
        want = brute(rows, q, 10)
        assert [(s, i) for _, i, s in sorted(got[q])] == [(pytest.approx(s), i) for s, i in want]


def test_fewer_candidates_than_asked_and_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 0.0])]
    got = sorted((r["rank"], r.vec_id) for r in nearest_neighbours(spark, table(spark, rows), F.col("vec_id") == 1).collect())
    assert got == [(1, 3), (2, 2)]
    assert nearest_neighbours(spark, table(spark, []), F.col("vec_id") == 1).collect() == []


def test_every_vector_is_indexed_in_bounded_shards(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(900, 8))]
    index = build_index(usable(table(spark, rows), "vec_id", "embedding"), 10, shard_rows=200).collect()
    assert len(index) == 5 and sum(r.nodes for r in index) == 900 and max(r.nodes for r in index) < 300


def test_graph_is_the_same_in_every_build():
    vectors = clustered(700, 8)
    a, b = build_graph(vectors), build_graph(vectors)
    assert all((x == y).all() for x, y in zip(a.tables, b.tables)) and a.entry == b.entry
