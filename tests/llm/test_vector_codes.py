"""Vector codes against their SQL, a plain formulation and edge rows."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest

from rentscope.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """The contract read word by word; rows of one length."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [[math.floor(256 * float(np.float32(x))) for x in r[1]] for r in kept]
    width = len(ints[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in ints]
    order = sorted(range(len(kept)), key=lambda i: kept[i][0])[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]

    def nearest(p, part):
        found = [(sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p])]
        return min(found)

    for _ in range(rounds):
        for p in range(parts):
            held: dict = {}
            for v in cut:
                held.setdefault(nearest(p, v[p])[1], []).append(v[p])
            for k, members in held.items():
                books[p][k] = tuple(sum(m[j] for m in members) // len(members) for j in range(width))
    found = [[nearest(p, v[p]) for p in range(parts)] for v in cut]
    error = [sum(d for d, _ in f) for f in found]
    by_label: dict = {}
    for r, e in zip(kept, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]], digest) for r, f, e in zip(kept, found, error, strict=True))


def made(n=300, dim=32, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in rng.normal(size=dim)], [None, 1, 2][i % 3]) for i in rng.permutation(n)]


def test_equals_a_plain_formulation(spark):
    rows = made()
    rows[5] = (rows[5][0], None, 1)
    rows[6] = (rows[6][0], [float("nan"), *rows[6][1][1:]], 1)
    rows[7] = (rows[7][0], [None, *rows[7][1][1:]], 1)
    rows[8] = (rows[8][0], [float("-inf"), *rows[8][1][1:]], None)
    rows[9] = (rows[9][0], [0.0] * 32, None)
    found = vector_codes.codes_with_digests(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_equals_sql(spark, small_dir):
    found = vector_codes.codes_with_digests(spark.read.parquet(f"{small_dir}/embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small_dir}/embeddings.parquet'")
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(vector_codes.CODES_SQL).fetchall())


def test_many_labels_join_by_salted_shuffle(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    alike = [sorted(map(tuple, vector_codes.codes_with_digests(df, most_broadcast=n).collect())) for n in (0, 100)]
    assert alike[0] == alike[1] and len(alike[0]) == 300


def test_fewer_vectors_than_entries_are_coded_without_error(spark):
    found = vector_codes.codes_with_digests(spark.createDataFrame(made(20), SCHEMA)).collect()
    assert {r.error for r in found} == {0} and {r.vec_id: r.code for r in found} == {i: f"{i:02x}" * 16 for i in range(20)}


def test_edges(spark):
    """Other lengths, huge components, null and repeated ids, repeated rows, further columns."""
    rows = made(70)
    rows += [(None, rows[0][1], 1), rows[1], rows[1], (500, [1.0, 2.0], 7), (501, [], 7), (502, [3e38, -3e38] * 16, None), (503, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.selectExpr("*", "'x' AS codes", "'y' AS error", "'z' AS vector", "'w' AS code")
    found = vector_codes.codes_with_digests(df).collect()
    assert len(found) == len(rows) - 1 and found[0].asDict().keys() == {"vec_id", "code", "error", "label_error", "codebooks_sha256"}
    by = {r.vec_id: r for r in found}
    assert by[500].code is None and by[500].error is None and by[501].code is None and by[500].label_error is None
    assert by[502].error >= 0 and len(by[502].code) == 32 and None in by
    twice = [r for r in found if r.vec_id == rows[1][0]]
    assert len(twice) == 3 and len(set(map(tuple, twice))) == 1


@pytest.mark.parametrize("dim", [1, 10, 17])
def test_lengths_that_are_no_multiple_of_the_parts(spark, dim):
    coded, books = vector_codes.compress(spark.createDataFrame(made(30, dim), SCHEMA))
    assert len(books.integers()) == 30 * dim and {r.error for r in coded.collect()} == {0}


def test_decoded_vectors_are_near(spark):
    rows = {r[0]: r[1] for r in made(2000, 32)}
    coded, books = vector_codes.compress(spark.createDataFrame(made(2000, 32), SCHEMA))
    for r in coded.limit(50).collect():
        apart = sum((a - b) ** 2 for a, b in zip(books.decode(bytes(r.codes)), rows[r.vec_id], strict=True))
        assert apart == pytest.approx(r.error / 256**2, abs=0.3)


def test_nothing(spark):
    assert vector_codes.codes_with_digests(spark.createDataFrame([], SCHEMA)).collect() == []
    only = spark.createDataFrame([(1, None, 1), (2, [], None)], SCHEMA)
    assert [tuple(r)[:4] for r in vector_codes.codes_with_digests(only).collect()] == [(2, None, None, None)]
