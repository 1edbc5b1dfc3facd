"""Fingerprints: edits by hand, equality, order and edit distance."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from rentscope.llm import fingerprints as fp
from tests.llm.cases import by_id, edge_documents, no_documents


def plain_signature(text: str) -> list[int]:
    """Entry by entry: the two smallest numbered k-mers, in text order."""
    kmers = fp.kmer_hashes(text)
    if not len(kmers):
        return [0] * fp.ENTRIES
    seen: dict[int, int] = {}
    keys = []
    for k in kmers:
        n = seen[int(k)] = seen.get(int(k), -1) + 1
        keys.append(k if not n else fp._mixed(np.array([k + np.uint64(n) * fp._STEP[6]], np.uint64))[0])
    out = []
    for odd in fp._ODD:
        smallest = sorted(range(len(keys)), key=lambda i: int(keys[i] * odd))[:2]
        low, high = min(smallest), max(smallest)
        pair = kmers[low] * fp._STEP[2] + kmers[high] * fp._STEP[7] if len(kmers) > 1 else kmers[low]
        out.append(int(fp._mixed(np.array([pair], np.uint64))[0] >> np.uint64(32)))
    return out


@pytest.mark.filterwarnings("ignore:overflow")
@pytest.mark.parametrize("text", ["", "a", "short text", "exactly12chr", "the cat sat on the mat " * 9, "x" * 300])
def test_signature(monkeypatch, text):
    expected = plain_signature(text)
    assert fp.signature(text).tolist() == expected
    monkeypatch.setattr(fp, "_CHUNK", 7)
    assert fp.signature(text).tolist() == expected


def test_near_edits_and_far_texts():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    text = " ".join(words)
    near = [fp.likeness(fp.signature(text), fp.signature(" ".join(words[:n] + words[n + n // 10 :]))) for n in (380, 200)]
    other = " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400))
    assert near[0] > 0.6 and near[1] > 0.4 and fp.likeness(fp.signature(text), fp.signature(other)) == 0
    # The same k-mers in another order are less alike than with one block moved out.
    halves = " ".join(words[200:] + words[:200])
    assert fp.likeness(fp.signature(text), fp.signature(halves)) < 0.8


def brute(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    out = {}
    for k, (i, text) in enumerate(docs):
        text, following = text or "", docs[(k + 1) % len(docs)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        own, changed, after = (fp.signature(t) for t in (text, edited, following))
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.as_hex(own), fp.as_hex(changed), (own == changed).mean(), (own == after).mean())
    return out


def found_rows(df) -> dict[int, tuple]:
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return {k: tuple(r[n] for n in names) for k, r in by_id(df).items()}


def test_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert found_rows(fp.fingerprint_edits(docs.repartition(5))) == brute(rows)
    assert {r["doc_id"]: r["fingerprint"] for r in fp.fingerprint(docs).collect()} == {k: v[2] for k, v in brute(rows).items()}


def test_edges(spark):
    df = edge_documents(spark)
    found = fp.fingerprint_edits(df)
    assert found.count() == df.count()
    texts = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}
    rows = found_rows(found.filter("doc_id > 1"))
    expected = brute(sorted(texts.items()))
    assert {k: v for k, v in rows.items() if k != 13} == {k: v for k, v in expected.items() if k not in (1, 13)}
    assert rows[2][2] == rows[3][2] and rows[12][2] == next(r["fingerprint"] for r in found.filter("doc_id = 1").collect())
    assert fp.fingerprint_edits(no_documents(spark)).collect() == []
    alone = fp.fingerprint_edits(spark.createDataFrame([(7, "a text that follows itself around")], "doc_id long, text string"))
    assert found_rows(alone) == brute([(7, "a text that follows itself around")])
