"""Nearest neighbours against all distances."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentscope.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows: list[tuple[int, list[float]]], asked: list[int], k: int = 10) -> dict[int, list[tuple[float, int]]]:
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for q in asked:
        distance = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        out[q] = sorted((d, i) for d, i in zip(distance.tolist(), ids.tolist(), strict=True) if i != q)[:k]
    return out


def found_rows(df) -> dict[int, list[tuple[float, int]]]:
    out: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return out


@pytest.mark.parametrize("block_rows", [8192, 90])
def test_recall(spark, medium_dir, block_rows):
    df = spark.read.parquet(f"{medium_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = found_rows(neighbours.nearest(df, F.col("vec_id") % 20 == 0, block_rows=block_rows, query_rows=10))
    expected = brute(rows, [i for i, _ in rows if i % 20 == 0])
    assert set(found) == set(expected)
    met = sum(len({i for _, i in found[q]} & {i for _, i in expected[q]}) for q in expected)
    assert met / sum(map(len, expected.values())) >= 0.95
    exact = {(q, i): d for q, near in expected.items() for d, i in near}
    for q, near in found.items():
        assert len(near) == 10 and near == sorted(near)
        for d, i in near:
            assert (q, i) not in exact or d == pytest.approx(exact[q, i], rel=1e-12)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (100, [0.0, 1.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.5], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1)]
    rows += [(6, [inf, 1.0], 1), (7, [None, 1.0], 1), (None, [1.0, 1.0], 1), (2, [1.0, 0.5], 1), (8, [1.0, 0.0], 1), (200, [1.0, 2.0, 3.0], None), (300, None, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("is_query", F.lit("x"))
    found = found_rows(neighbours.nearest(df, F.col("vec_id") % 100 == 0))
    usable = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.5]), (8, [1.0, 0.0])]
    assert found == brute(usable, [0, 100])
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).collect() == []


def test_many_equal_vectors(spark):
    """Ties at distance 0 go to the smallest ids, however many there are."""
    rows = [(i, [1.0, 2.0, 3.0] if i % 2 == 0 else [float(i), 1.0, 0.0], 0) for i in range(600)]
    found = found_rows(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 300, block_rows=100))
    assert found[300] == [(0.0, i) for i in range(0, 20, 2)]


def clustered(n: int, dim: int, centres: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.standard_normal((centres, dim))[rng.integers(0, centres, n)] * 3 + rng.standard_normal((n, dim))


@pytest.mark.parametrize(("n", "centres"), [(8192, 40), (50_000, 200)])
def test_recall_and_share_verified(n, centres):
    """Blocks of 8,192 as in a task: distances are taken of a part of the vectors only, and few neighbours are missed."""
    vectors = clustered(n, 64, centres, 5)
    indexes = [neighbours.CollisionIndex(np.arange(a, min(a + 8192, n)), vectors[a : a + 8192]) for a in range(0, n, 8192)]
    met = total = 0
    for q in range(0, n, n // 60):
        found = sorted((d, i) for x in indexes for i, d in zip(*x.search(q, vectors[q]), strict=True))[:10]
        distance = ((vectors - vectors[q]) ** 2).sum(axis=1)
        distance[q] = np.inf
        met += len({i for _, i in found} & set(np.argsort(distance)[:10].tolist()))
        total += 10
    share = sum(x.n_verified for x in indexes) / (n * (total // 10))
    print("recall", met / total, "share verified", share)
    assert met / total >= 0.95 and share < 0.5


def test_huge_components_end(spark):
    """Squares beyond the numbers' range: the search ends, and the order is that of the distances."""
    rows = [(i, [1e200 * (i + 1), 1.0]) for i in range(30)] + [(100, [1e200, 2.0]), (200, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = found_rows(neighbours.nearest(df, F.col("vec_id") % 100 == 0))
    assert [i for _, i in found[100]] == [0, 1, 200, 2, 3, 4, 5, 6, 7, 8]
    assert found[100][3][0] == pytest.approx(2e200)
