"""Licence scans against plain searches, and expressions."""

from __future__ import annotations

import re

import pytest

from rentscope.llm import licenses
from tests.llm.cases import by_id, edge_documents, no_documents


def brute(text: str | None) -> tuple:
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    starts, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        sought = phrase.split()
        for at in range(len(words) - len(sought) + 1):
            if words[at : at + len(sought)] == sought:
                starts.append(at)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def found_rows(df) -> dict[int, tuple]:
    return {k: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for k, r in by_id(licenses.license_scan(df)).items()}


def test_documents(spark, medium_dir):
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet")
    assert found_rows(docs) == {r["doc_id"]: brute(r["text"]) for r in docs.collect()}


def test_edges(spark):
    df = edge_documents(spark)
    assert found_rows(df) == {r["doc_id"]: brute(r["text"]) for r in df.collect() if r["doc_id"] is not None}
    assert licenses.license_scan(df).count() == df.count() and licenses.license_scan(no_documents(spark)).collect() == []
    empty = by_id(licenses.license_scan(df))[2]
    assert (empty["labels"], empty["base_labels"], empty["score"]) == ("", "", 1.0)


TRICKY = [
    "MIT License mit license. MIT-License, the Apache\nLicense",
    "mit licenses xmit license mit licensé",
    "GNU General Public License, version 3; CC BY-NC 4.0 and cc by 4.0",
    "cc by cc by cc by",
    "gnu general public apache license mit",
    "É MIT License É 漢 apache license",
]


@pytest.mark.parametrize("text", TRICKY)
def test_tricky_places(text):
    found = licenses.scan(text, licenses.automaton())
    assert found[:5] == brute(text)
    assert set(found[4].split(",")) <= set(found[5].split(","))


@pytest.mark.parametrize(
    "expression,names,free",
    [
        ("MIT", {"mit"}, 1.0),
        ("MIT OR GPL-3.0-only", {"mit", "gpl-3.0-only"}, 1.0),
        ("MIT AND GPL-3.0-only", {"mit", "gpl-3.0-only"}, 0.4),
        ("MIT OR Apache-2.0 AND GPL-2.0+", {"mit", "apache-2.0", "gpl-2.0+"}, 1.0),
        ("(MIT OR Apache-2.0) AND GPL-2.0+", {"mit", "apache-2.0", "gpl-2.0+"}, 0.4),
        ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl-2.0-only with classpath-exception-2.0"}, 0.5),
        ("Apache-2.0 */", {"apache-2.0"}, 0.95),
    ],
)
def test_expressions(expression, names, free):
    found, freedom = licenses.evaluate(licenses.to_postfix(expression))
    assert found == names and freedom == pytest.approx(free)


@pytest.mark.parametrize("expression", ["", "AND MIT", "MIT OR", "(MIT", "MIT OR OR GPL", ") MIT", "???"])
def test_no_expressions(expression):
    assert licenses.to_postfix(expression) is None


def test_tags():
    text = "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause\ncode\n# spdx-license-identifier: not an (expression\n"
    found = licenses.scan(text, licenses.automaton())
    assert found[5] == "bsd-3-clause,gpl-2.0-only,mit" and found[6] == pytest.approx(0.95) and found[1] == 0
