"""Packed pieces put together again, the solver against its conditions, and edge rows."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rentscope.llm import packing
from rentscope.llm.queries import BYTE_BPE, WORD_BPE, op12_packing, tokenizer_path
from tests.llm.cases import edge_documents, no_documents, rows

PATH = tokenizer_path(WORD_BPE)


def library(texts, path=PATH):
    found = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, 1] for e in found]


def put_together(pieces, window=2048):
    """Documents' ids by id, and sequence lengths; each piece in its place, none over another."""
    docs: dict = {}
    sequences: dict = {}
    for p in pieces:
        ids = list(struct.unpack(f"<{p.length}I", p.ids))
        assert p.length > 0 and p.length == len(ids)
        docs.setdefault(p.doc_id, []).append((p.start, ids, p.doc_tokens))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= window
    lengths = [sum(n for _, n in places) for places in sequences.values()]
    assert all(n & (n - 1) == 0 for n in lengths) and sum(n < window for n in lengths) <= window.bit_length()
    return docs, lengths


def whole(parts):
    at, out = 0, []
    for start, ids, n in sorted(parts):
        assert start == at
        out += ids
        at += len(ids)
        assert n >= at
    assert at == n
    return out


@pytest.mark.parametrize("window", [2048, 256])
def test_every_id_is_in_one_piece_and_nothing_is_padded(spark, medium_dir, window):
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet").repartition(6)
    pieces = packing.pack(docs, PATH, window=window).collect()
    found, lengths = put_together(pieces, window)
    given_rows = docs.select("doc_id", "text").collect()
    for row, ids in zip(given_rows, library([r.text for r in given_rows]), strict=True):
        assert whole(found[row.doc_id]) == ids
    # Most remainders stay in one piece or lose a few last ids.
    rests = {p.doc_id: p.doc_tokens % window for p in pieces if p.doc_tokens % window}
    longest = {d: max([len(ids) for s, ids, n in found[d] if s + len(ids) > n - n % window], default=0) for d in rests}
    assert sum(longest[d] >= 0.9 * n for d, n in rests.items()) > 0.8 * len(rests)


def test_digests_of_the_query(spark, small_dir):
    pieces = op12_packing(spark, small_dir)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    ids = dict(zip(texts, library(texts.values()), strict=True))
    for p in pieces.collect():
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part)) and p.doc_tokens == len(ids[p.doc_id])


def test_edges(spark):
    found, _ = put_together(packing.pack(edge_documents(spark), PATH).collect())
    held: dict = {}
    for row in rows():
        held.setdefault(row[0], []).append(row[1])
    for doc_id, texts in held.items():
        expected = library(texts)
        if len(texts) == 1:
            assert whole(found[doc_id]) == expected[0]
        assert sum(len(ids) for _, ids, _ in found[doc_id]) == sum(map(len, expected))
    assert packing.pack(no_documents(spark), PATH).collect() == []


def test_one_length_for_all_and_very_short_documents(spark):
    for text, n in (("word " * 500, 300), ("a", 5000), (None, 4097)):
        df = spark.createDataFrame([(i, text) for i in range(n)], "doc_id long, text string").repartition(5)
        found, lengths = put_together(packing.pack(df, PATH).collect())
        expected = library([text])[0]
        assert len(found) == n and all(whole(p) == expected for p in found.values())
        assert sum(lengths) == n * len(expected)


def test_a_tokenizer_that_reads_white_space_takes_texts_whole(spark, small_dir):
    path = tokenizer_path(BYTE_BPE)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    found, _ = put_together(packing.pack(docs, path).collect())
    given_rows = docs.select("doc_id", "text").collect()
    for row, ids in zip(given_rows, library([r.text for r in given_rows], path), strict=True):
        assert whole(found[row.doc_id]) == ids


PARTS = st.sampled_from(["word", "Wörd's", "WORD'S,", "x.", "5.", "!?", "'", "s", "'re", "ÀÉ:", "×", "²",  " ", "  ", "\n", "\t", " ", "\x1c", "́", "é", "Σ", "ΣΑΣ", "İ", "<|endoftext|>", "1234", "...", "'ll", "한", "하", " ", "😀"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=12))
def test_ids_are_the_librarys(parts):
    text = "".join(parts)
    assert list(np.frombuffer(WORDS.ids([text])[0], "<u4")) == Tokenizer_.encode(text, add_special_tokens=False).ids


WORDS, Tokenizer_ = packing.WordIds(PATH), Tokenizer.from_file(PATH)


def test_solver_meets_its_conditions():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a = rng.integers(0, 3, (15, 40)).astype(float)
        b = rng.integers(0, 50, 15).astype(float)
        x = packing.least_squares(a, b)
        slope = a.T @ (a @ x - b)
        assert (x >= 0).all() and (slope > -1e-6).all() and np.abs(slope[x > 0]).max(initial=0) < 1e-6


def test_a_plan_uses_what_is_there_and_little_is_left():
    rng = np.random.default_rng(4)
    for lengths in (rng.integers(1, 2048, 100_000), np.minimum(rng.exponential(500, 100_000), 2047).astype(int), np.full(1000, 700)):
        histogram = dict(zip(*(v.tolist() for v in np.unique(lengths // 16, return_counts=True)), strict=True))
        found = packing.plan(histogram)
        used: dict = {}
        for parts, n in found.repeats:
            assert sum(parts) == 128 and list(parts) == sorted(parts) and n > 0
            for s in parts:
                used[s] = used.get(s, 0) + n
        assert all(used.get(s, 0) + found.left[s] == histogram.get(s, 0) for s in range(128))
    uniform = packing.plan({s: 1000 for s in range(1, 128)})
    assert sum(uniform.left) < 0.02 * 127_000
