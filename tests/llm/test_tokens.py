"""Token counts and sentence pieces against the libraries themselves."""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from rentscope.llm import sentencepieces as sp
from rentscope.llm import token_counts as tc
from rentscope.llm.queries import BYTE_BPE, PIECE_BPE, tokenizer_path
from tests.llm.cases import by_id, edge_documents, no_documents

text = st.text(st.sampled_from(list("ab  \n\t'sé漢😀 ▁<>_=09▁")), max_size=40)


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(tokenizer_path(BYTE_BPE))


@pytest.fixture(scope="module")
def pieces():
    return SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))


def counts(df, **limits):
    return {k: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for k, r in by_id(tc.token_counts(df, tokenizer_path(BYTE_BPE), **limits)).items()}


def expected_counts(byte_bpe, texts):
    out = {}
    for k, t in texts.items():
        n = len(byte_bpe.encode(t or "", add_special_tokens=False))
        out[k] = (len((t or "").encode()), n, n > 1024)
    return out


@pytest.mark.parametrize("limits", [{}, {"table_size": 5, "table_texts": 1}])
def test_counts_equal_library(spark, byte_bpe, limits):
    """Whatever the table holds, on tables of three partitions with every edge."""
    df = edge_documents(spark)
    texts = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}
    assert counts(df, **limits) == expected_counts(byte_bpe, texts)
    assert tc.token_counts(df, tokenizer_path(BYTE_BPE)).count() == df.count()
    assert tc.token_counts(no_documents(spark), tokenizer_path(BYTE_BPE)).collect() == []


def test_counts_on_documents(spark, small_dir, byte_bpe):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    assert counts(docs) == expected_counts(byte_bpe, {r["doc_id"]: r["text"] for r in docs.collect()})


def test_every_code_point_is_cut_as_the_library_cuts(byte_bpe):
    """But for characters on which the two have different Unicode tables, and these are known."""
    cut = tc.PreTokens(tokenizer_path(BYTE_BPE))
    disputed = 0
    for start in range(0, 0x11000, 64):
        kinds = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        cut.agrees("".join(kinds))
        disputed += sum(c in cut.disputed for c in kinds)
        sample = "".join(f"a{c}1{c} {c}{c}b" for c in kinds if c not in cut.disputed)
        assert len(cut.split(sample)[0]) == len(byte_bpe.pre_tokenizer.pre_tokenize_str(sample)), hex(start)
    assert 0 < disputed < 3000 and cut.agrees("plain text, naïve café “quoted” — 漢字 😀") and not cut.agrees("a \u0558 b")


def test_other_kinds_are_refused():
    with pytest.raises(ValueError):
        tc.PreTokens(tokenizer_path("word_bpe_49k.json"))


@settings(max_examples=300, deadline=None)
@given(text)
def test_pieces_equal_library(pieces, sample):
    codec = sp.codec(tokenizer_path(PIECE_BPE))
    ids = np.frombuffer(codec.encode([sample])[0], "<i4").tolist()
    assert ids == pieces.encode(sample)
    assert codec.decode(ids) == pieces.decode(ids)


def test_pieces_on_documents(spark, small_dir, pieces):
    path = tokenizer_path(PIECE_BPE)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    encoded = sp.encode(docs, path, "source")
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == {k: pieces.encode(t) for k, t in texts.items()}
    assert {r["doc_id"]: r["text"] for r in sp.decode(encoded, path).collect()} == texts


def test_pieces_on_edges(spark, pieces):
    path = tokenizer_path(PIECE_BPE)
    df = edge_documents(spark)
    found = sp.round_trip(df, path)
    assert found.count() == df.count()
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect() if r["doc_id"] is not None}
    for k, r in by_id(found).items():
        ids = pieces.encode(texts[k])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
        assert r["round_trip"] and r["decoded_sha256"] == hashlib.sha256(texts[k].encode()).hexdigest()
    assert sp.round_trip(no_documents(spark), path).collect() == [] and sp.encode(no_documents(spark), path).collect() == []
    assert {r["n_tokens"] for r in sp.encode(df, path).filter("doc_id IN (2, 3)").collect()} == {0}


def field(number: int, value) -> bytes:
    def varint(n: int) -> bytes:
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


@pytest.fixture(scope="module")
def unigram_path(tmp_path_factory):
    """A small unigram model, written by hand: no tokenizer is trained."""
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]]
    scored = {"▁": -2.0, "a": -3.0, "b": -3.1, "c": -3.3, "ab": -3.9, "▁a": -3.2, "▁ab": -4.1, "bc": -4.4, "abc": -5.0, "ca": -4.8, "▁b": -3.6}
    listed += [(p, s, 1) for p, s in scored.items()]
    body = b"".join(field(1, field(1, p.encode()) + field(2, s) + (field(3, k) if k != 1 else b"")) for p, s, k in listed)
    body += field(2, field(3, 1) + field(35, 1) + field(40, 0)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(body)
    return str(path)


@settings(max_examples=200, deadline=None)
@given(sample=st.text(st.sampled_from(list("abc  é")), max_size=20))
def test_unigram_models(unigram_path, sample):
    library, codec = SentencePieceProcessor(model_file=unigram_path), sp.Codec(unigram_path)
    ids = np.frombuffer(codec.encode([sample])[0], "<i4").tolist()
    assert ids == library.encode(sample) and codec.decode(ids) == library.decode(ids)


def test_parity_is_counted(pieces):
    codec = sp.Codec(tokenizer_path(PIECE_BPE))
    codec.encode(["The quick brown fox", "over the lazy dog"])
    assert codec.n_compared == 8 and codec.n_different == 0
