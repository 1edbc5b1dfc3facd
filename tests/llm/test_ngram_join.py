"""Components of similar documents against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rentscope.llm import ngram_join as nj
from tests.llm.cases import by_id, edge_documents, no_documents


def shingle_set(text: str | None, words: int) -> frozenset:
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def brute(texts: dict[int, str | None], words: int, percent: int) -> dict[int, tuple[int, int]]:
    sets = {i: shingle_set(t, words) for i, t in texts.items()}
    least = {i: i for i in sets}

    def root(i: int) -> int:
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                least[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def found_rows(df) -> dict[int, tuple[int, int]]:
    return {k: (r["n_shingles"], r["component_id"]) for k, r in by_id(df).items()}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=25), min_size=2, max_size=14), st.sampled_from([50, 80, 90]), st.booleans())
def test_tree_equals_all_pairs(sets, percent, split):
    groups = np.array([i % 2 for i in range(len(sets))])
    asking = np.array([i % 3 == 0 for i in range(len(sets))]) if split else None
    labels = nj.tree_components(groups, [np.array(sorted(s), np.uint64) for s in sets], percent, asking)
    expected = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            meet = groups[a] == groups[b] and (asking is None or asking[a] != asking[b])
            if meet and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((expected[a], expected[b]))
                expected = [low if x == high else x for x in expected]
    assert labels.tolist() == expected


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 10**6), st.sampled_from([50, 80, 90]), st.booleans())
def test_similar_sets_share_a_digest(n, n_changed, seed, percent, crowded):
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 2**63, n + n_changed, dtype=np.uint64) * np.uint64(2)
    frequent = np.sort(pool[: len(pool) // 2]) if crowded else pool[:0]
    a, b = np.unique(pool[:n]), np.unique(pool[n_changed:])
    both = len(np.intersect1d(a, b))
    if len(a) and len(b) and set(a.tolist()) != set(b.tolist()) and 100 * both >= percent * (len(a) + len(b) - both):
        first, second = ({c: (set(d.tolist()), least) for c, d, least in nj.class_digests(x, percent, frequent)} for x in (a, b))
        meeting = max(min(first), min(second))
        met = first[meeting][0] & second[meeting][0]
        assert len(met) >= max(first[meeting][1], second[meeting][1])


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_equals_brute_force(spark, small_dir, words, percent):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert found_rows(nj.similar_components(docs, words, percent)) == brute(texts, words, percent)


def copies(spark, n: int):
    """One text with a few words changed in each copy, and a line that all documents share."""
    rng = np.random.default_rng(5)
    line = "the very same line of words stands at the end of each document here"
    rows = []
    for i in range(n):
        words = [f"w{k}" for k in range(120)] if i % 3 else [f"v{i}x{k}" for k in range(60)]
        for k in rng.integers(0, len(words), 3):
            words[k] = f"c{rng.integers(0, 5)}"
        rows.append((i, " ".join(words) + " " + line))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("block,frequent", [(400_000, 50), (3_000, 5)])
def test_large_groups_are_split(spark, monkeypatch, block, frequent):
    monkeypatch.setattr(nj, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(nj, "FREQUENT_DOCUMENTS", frequent)
    docs = copies(spark, 150)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert found_rows(nj.similar_components(docs, 3, 90)) == brute(texts, 3, 90)


def test_edges(spark):
    df = edge_documents(spark)
    found = nj.similar_components(df, 3, 90)
    assert found.count() == df.count()
    texts = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}
    assert found_rows(found) == brute(texts, 3, 90)
    assert {r["component_id"] for r in found.filter("doc_id IS NULL").collect()} == {None}
    assert nj.similar_components(no_documents(spark)).collect() == []


def test_one_of_each_stays(spark):
    df = edge_documents(spark)
    kept = nj.one_of_each(df)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [r["doc_id"] for r in kept.collect()]
    expected = brute({r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}, 5, 80)
    assert set(ids) - {None} == {i for i, (_, c) in expected.items() if c == i} and ids.count(None) == 2


def test_equals_sql(spark, small_dir):
    import duckdb

    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    assert sorted(map(tuple, nj.similar_components(docs, 3, 90).collect())) == sorted(con.execute(nj.SIMILAR_SQL).fetchall())


def test_a_set_between_two_size_classes_ties_both(spark):
    """Each middle text is similar to a shorter and to a longer one, which are not similar to each other."""
    rows = []
    for k, n in enumerate(range(20, 140, 3)):
        words = [f"w{k}x{i}" for i in range(2 * n)]
        rows += [(3 * k + 2 - j, " ".join(words[:size])) for j, size in enumerate((n, int(n * 0.85), int(n / 0.85)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_rows(nj.similar_components(docs, 1, 80)) == brute(dict(rows), 1, 80)
