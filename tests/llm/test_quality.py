"""The quality ranking: held-out accuracy, learning on pairs, edges."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentscope.llm import quality
from tests.llm.cases import by_id, edge_documents, no_documents

LABELS = "doc_id long, quality int, toxic int"


def area(score: np.ndarray, good: np.ndarray) -> float:
    """Chance that a good row scores above a bad one."""
    return float(np.mean(score[good][:, None] > score[~good][None, :]))


def test_held_out_rows(spark, medium_dir):
    docs, labels = (spark.read.parquet(f"{medium_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality_scores(docs, labels).toPandas()
    assert len(found) == docs.count() and found["score"].between(0, 1).all()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found["doc_id"]]).all()
    assert (found["predicted"] == (found["score"] >= 0.7)).all()
    held = found[found["held_out"]].merge(labels.toPandas(), on="doc_id")
    good = held["quality"].to_numpy() == 1
    assert len(held) > 50 and area(held["score"].to_numpy(), good) > 0.97 and (held["predicted"] == good).mean() > 0.95


def test_held_out_labels_do_not_matter(spark, small_dir):
    docs, labels = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (by_id(quality.quality_scores(docs, x)) for x in (labels, turned))
    assert {k: r["score"] for k, r in first.items()} == {k: r["score"] for k, r in second.items()}


def test_threshold_is_the_quantile_of_bad_labels():
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((400, 3))
    good = vectors[:, 0] > -0.5
    ranking = quality.fit(vectors, good)
    score = 1 / (1 + np.exp(-(vectors @ np.array(ranking.weights) + ranking.offset)))
    assert (score < quality.PASS_SCORE).sum() == (~good).sum()
    assert ((score >= quality.PASS_SCORE) == good).mean() > 0.97


@pytest.mark.parametrize("value,high", [(1, True), (0, False)])
def test_one_kind_of_label(spark, value, high):
    df = edge_documents(spark)
    labels = spark.createDataFrame([(i, value, 0) for i in range(14)], LABELS)
    scores = {r["score"] for r in quality.quality_scores(df, labels).collect()}
    assert len(scores) == 1 and (scores.pop() > 0.7) == high


def test_edges(spark):
    df = edge_documents(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(14)] + [(1, 1, 0), (None, 1, 0), (5, None, None), (6, 7, 0)], LABELS)
    found = quality.quality_scores(df, labels.withColumn("features", F.lit("clash")))
    assert found.count() == df.count()
    rows = by_id(found)
    assert rows[2]["score"] == rows[3]["score"] and rows[1]["score"] == rows[12]["score"]
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert all(not r["held_out"] for r in found.filter("doc_id IS NULL").collect())
    assert quality.quality_scores(no_documents(spark), labels).collect() == []
    unlabelled = quality.quality_scores(df, spark.createDataFrame([], LABELS))
    assert len({r["score"] for r in unlabelled.collect()}) == 1
