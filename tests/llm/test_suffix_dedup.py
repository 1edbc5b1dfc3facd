"""Repeated strings against a set of all strings met before, in order of place."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rentscope.llm import suffix_dedup as sd
from tests.llm.cases import by_id, edge_documents, no_documents


def brute(texts: dict[int, str | None], length: int) -> dict[int, tuple]:
    seen, out = set(), {}
    for doc in sorted(texts):
        raw = (texts[doc] or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            string = raw[at : at + length]
            if string in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(string)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        n_spans = sum(g and not before for g, before in zip(gone, b"\0" + gone, strict=False))
        out[doc] = (len(raw), sum(gone), n_spans, hashlib.sha256(kept).hexdigest())
    return out


def found_rows(df) -> dict[int, tuple]:
    return {k: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for k, r in by_id(df).items()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.binary(min_size=16, max_size=16)), min_size=1, max_size=12), st.sampled_from([3, 5, 8]))
def test_blocks_equal_sets(pieces, length):
    """Strings over two letters, so that all lengths of common prefixes occur."""
    texts = [bytes(97 + (b & 1) for b in body)[: count - 1 + length].ljust(count - 1 + length, b"a") for count, body in pieces]
    repeated, first = sd.repeated_starts(texts, np.array([c for c, _ in pieces]), length)
    seen, expected = set(), []
    for text, (count, _) in zip(texts, pieces, strict=True):
        for at in range(count):
            expected.append(text[at : at + length] in seen)
            seen.add(text[at : at + length])
    assert repeated.tolist() == expected and (first == ~repeated).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=14), min_size=1, max_size=8))
def test_marks_are_short_common_prefixes(pieces):
    symbols = np.array([x for p in pieces for x in [*(b % 3 + 1 for b in p), 0]], np.uint16)
    order = sd.suffix_array(symbols, 16)
    ends = np.flatnonzero(symbols == 0)
    suffixes = [tuple(symbols[i : ends[np.searchsorted(ends, i)] + 1]) for i in range(len(symbols))]
    assert [(suffixes[i], i) for i in order] == sorted((s, i) for i, s in enumerate(suffixes))
    marks = sd.common_prefix_marks(symbols, order, 4)
    for k in range(1, len(order)):
        a, b = suffixes[order[k - 1]], suffixes[order[k]]
        if len(a) > 4 and len(b) > 4:
            assert marks[k] == (a[:4] != b[:4])


def test_equals_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert found_rows(sd.repeated_bytes(docs)) == brute(texts, 100)


@pytest.mark.parametrize("limits", [(4, 8, 20_000), (256, 2, 5_000)])
def test_crowded_anchors_and_small_blocks(spark, small_dir, monkeypatch, limits):
    for name, value in zip(("RUNS_TOGETHER", "RUNS_IN_BLOCK", "BLOCK_BYTES"), limits, strict=True):
        monkeypatch.setattr(sd, name, value)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    line = "this line of over one hundred bytes stands in every one of the documents, with other words before and after it: "
    docs = docs.selectExpr("doc_id", f"concat(text, ' ', doc_id, '{line}', doc_id * 7919) AS text").repartition(5)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert found_rows(sd.repeated_bytes(docs)) == brute(texts, 100)


def test_overlaps_in_one_text(spark):
    """A run of one letter: all bytes but the first belong to a string that starts earlier too."""
    df = spark.createDataFrame([(1, "a" * 350), (2, "b" + "a" * 120)], "doc_id long, text string")
    assert found_rows(sd.repeated_bytes(df)) == brute({1: "a" * 350, 2: "b" + "a" * 120}, 100)


def test_edges(spark):
    df = edge_documents(spark)
    found = sd.repeated_bytes(df)
    assert found.count() == df.count()
    texts = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}
    assert found_rows(found) == brute(texts, 100)
    assert all(r["n_removed"] == 0 for r in found.filter("doc_id IS NULL").collect())
    assert sd.repeated_bytes(no_documents(spark)).collect() == []


def test_ids_with_several_texts_stay(spark):
    df = spark.createDataFrame([(1, "x" * 300), (1, "y" * 300), (2, "z" * 300)], "doc_id long, text string")
    assert {(r["doc_id"], r["n_removed"]) for r in sd.repeated_bytes(df).collect()} == {(1, 0), (2, 299)}


def test_documents_without_repeats(spark):
    df = edge_documents(spark)
    left = sd.without_repeats(df)
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {r["doc_id"]: r for r in left.collect() if r["doc_id"] is not None}
    assert 12 not in kept and kept[2]["text"] is None and kept[3]["text"] == ""
    assert kept[6]["text"].endswith("at the very end of it.") and kept[6]["n_chars"] == len(kept[6]["text"])


def test_equals_sql(spark, small_dir):
    import duckdb

    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    assert sorted(map(tuple, sd.repeated_bytes(docs).collect())) == sorted(con.execute(sd.REPEATED_SQL).fetchall())
