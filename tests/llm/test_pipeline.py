"""The pipeline: what each stage keeps of the one before, and what the query returns."""

from __future__ import annotations

import pytest
from sentencepiece import SentencePieceProcessor

import __spark_entry__ as entry
import corpus_pipeline
from rentscope.llm import queries as corpus
from rentscope.llm.common import DOCUMENT_COLUMNS
from rentscope.plans.saved import save
from tests.llm import test_ngram_join, test_suffix_dedup
from tests.llm.cases import edge_documents, no_documents


@pytest.fixture(scope="module")
def stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = save(stage(spark, docs, small_dir), f"test-{name}")
        out.append((name, docs))
    return out


def texts(df) -> dict:
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in stages[1:]] == ["recognise_language", "drop_near_duplicates", "drop_repeated_bytes", "mix_sources", "encode_pieces"]
    assert all(df.columns == DOCUMENT_COLUMNS for _, df in stages[:-1])


def test_clean_documents_are_recognised(stages):
    assert stages[1][1].count() >= 0.99 * stages[0][1].count()


def test_one_of_each_group_stays(stages):
    before, after = texts(stages[1][1]), texts(stages[2][1])
    groups = test_ngram_join.brute(before, 5, 80)
    assert after == {i: t for i, t in before.items() if groups[i][1] == i}


def test_repeated_bytes_go(stages):
    import hashlib

    before, after = texts(stages[2][1]), texts(stages[3][1])
    for i, (_, n_removed, _, digest) in test_suffix_dedup.brute(before, 100).items():
        if not n_removed:
            assert after[i] == before[i]
        elif i in after and "�" not in after[i] and after[i].isascii() and before[i].isascii():
            assert hashlib.sha256(after[i].encode()).hexdigest() == digest


def test_ids_are_those_of_the_mix(stages):
    library = SentencePieceProcessor(model_file=corpus.tokenizer_path(corpus.PIECE_BPE))
    mixed = sorted((r["doc_id"], library.encode(r["text"])) for r in stages[4][1].collect())
    assert sorted((r["doc_id"], r["ids"]) for r in stages[5][1].collect()) == mixed


def test_query_is_the_last_stage(spark, small_dir, stages):
    found = entry.queries()["pipeline"](spark, small_dir)
    assert sorted((r["doc_id"], r["ids"]) for r in found.collect()) == sorted((r["doc_id"], r["ids"]) for r in stages[5][1].collect())


@pytest.mark.parametrize("make", [edge_documents, no_documents])
def test_stages_on_edges(spark, small_dir, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = save(stage(spark, docs, small_dir), f"edge-{name}")
        assert name == "encode_pieces" or docs.columns == DOCUMENT_COLUMNS


def test_all_operators_are_registered():
    names = [n.split("_")[0] for n in corpus.queries()]
    assert names == [f"op{i}" for i in range(1, 14)] and set(corpus.oracle_sql()) <= set(corpus.queries())
    assert set(corpus.queries()) | {"pipeline"} <= set(entry.queries())
