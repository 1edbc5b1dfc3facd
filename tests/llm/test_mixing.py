"""The mix against its SQL and against what its documents hold."""

from __future__ import annotations

import re

import duckdb
import pytest

from rentscope.llm import mixing
from tests.llm.cases import edge_documents, no_documents, rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sql_rows(spark, df):
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "source").toArrow())
    found = con.execute(mixing.MIX_SQL).fetchall()
    return sorted(found, key=str)


def test_equals_sql_on_edges(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long")
    found = mixing.mix(edge_documents(spark)).select("doc_id", "source", "size", "source_size", "target", "taken")
    assert sorted(map(tuple, found.collect()), key=str) == sql_rows(spark, df)


def test_sources_meet_their_budgets_and_no_document_more_than_its_share(spark, medium_dir):
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet")
    found = mixing.mix(docs).toPandas()
    by_source = found.groupby("source").agg({"taken": "sum", "target": "first"})
    assert (by_source["taken"] - by_source["target"]).abs().max() <= 0.5
    assert (found["taken"] <= 3 * found["size"]).all()
    assert abs(by_source["target"].sum() - found["size"].sum()) < 1
    again = mixing.mix(docs.repartition(7)).toPandas()
    assert sorted(map(tuple, again.values), key=str) == sorted(map(tuple, found.values), key=str)


def test_excess_is_shared_by_weight(spark):
    """Source a (weight 1) fills to 3 x 2 words; b and c share what is left of 302 as 2 to 3."""
    texts = [(1, "x y", "a"), (2, "w " * 150, "b"), (3, "w " * 150, "c")]
    df = spark.createDataFrame([(i, t, None, s, len(t)) for i, t, s in texts], "doc_id long, text string, lang string, source string, n_chars long")
    targets = {r["source"]: r["target"] for r in mixing.mix(df).collect()}
    assert targets == {"a": 6.0, "b": pytest.approx(296 * 2 / 5), "c": pytest.approx(296 * 3 / 5)}


def test_mixed_documents_hold_what_the_mix_takes(spark, medium_dir):
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet")
    held: dict = {}
    for r in mixing.mixed_documents(docs).collect():
        assert r["n_chars"] == len(r["text"])
        held[r["doc_id"]] = held.get(r["doc_id"], 0) + len(WORDS.findall(r["text"]))
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect() if r["taken"]}
    assert {k: v for k, v in held.items() if v} == taken


def test_mixed_documents_on_edges(spark):
    found = mixing.mixed_documents(edge_documents(spark))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"] and found.count() > 0


def test_nothing(spark):
    assert mixing.mix(no_documents(spark)).collect() == []
    assert mixing.mixed_documents(no_documents(spark)).collect() == []
    blank = spark.createDataFrame([(1, None, None, None, None), (2, "", None, "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {(r["doc_id"], r["target"], r["taken"]) for r in mixing.mix(blank).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_rows_that_share_an_id_are_cut_once(spark):
    """A third of a source without ids, and repeated ids with other or equal texts: each source's words are met, by one short row."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = [" ".join(f"w{i}" for i in range(n)) for n in range(1, 41)]
    for seed in range(4):
        out = []
        for s in "abc":
            for i in range(240):
                text = texts[(i * 7 + seed) % 40] + (f" x{i}" if i % 3 else "")
                out.append((None if i % 3 == 0 else i % 5 if i % 3 == 1 else i, text, None, s, len(text)))
        docs = spark.createDataFrame(out, schema).repartition(5)
        for share in (0.3, 1.0):
            taken = mixing.mix(docs, share=share, seed=str(seed)).toPandas()
            held = mixing.mixed_documents(docs, share=share, seed=str(seed)).toPandas()
            held["words"] = [len(WORDS.findall(t)) for t in held["text"]]
            by_source = taken.groupby("source")["taken"].sum()
            assert held.groupby("source")["words"].sum().to_dict() == by_source.to_dict()
            assert (by_source - taken.groupby("source")["target"].first()).abs().max() <= 0.5
            known = {t for _, t, *_ in out}
            whole = held[[t in known for t in held["text"]]]
            assert len(held) - len(whole) <= 3
            assert ((taken["taken"] % taken["size"]) != 0).sum() <= 3
            found = held.groupby(["source", held["doc_id"].fillna(-1)])["words"].sum()
            expected = taken.groupby(["source", taken["doc_id"].fillna(-1)])["taken"].sum()
            assert {k: v for k, v in found.items() if v} == {k: v for k, v in expected.items() if v}


def test_repeated_rows_equal_sql(spark):
    texts = [" ".join("w" * (i % 9 + 1)) for i in range(90)]
    docs = spark.createDataFrame([(None if i % 2 else i % 4, t, None, "ab"[i % 3 == 0], len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    found = mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")
    assert sorted(map(tuple, found.collect()), key=str) == sql_rows(spark, docs)
