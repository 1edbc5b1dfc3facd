"""Licence notices, identifier tags and licence expressions in whole texts.

One Aho-Corasick automaton runs over the normalised words of a text and finds notice phrases
and tag names. The expression behind a tag is parsed by a shunting-yard and evaluated: ``and``
asks for all terms, ``or`` leaves the choice, ``with`` adds an exception to a licence.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from rentscope.llm.common import as_text, map_batches, pick

BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notices: phrase -> label.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu general public license v2": "gpl-2.0",
    "gnu general public license v3": "gpl-3.0",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "cc0 1 0": "cc0",
    "creative commons zero": "cc0",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
_TAG_LINE = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")

#: Freedom to reuse a text under a licence, by the first of these prefixes that its name has.
FREEDOM = [
    ("agpl", 0.3), ("lgpl", 0.6), ("gpl", 0.4), ("cc-by-nc", 0.2), ("cc-by-nd", 0.2), ("cc-by-sa", 0.6), ("cc-by", 0.9), ("cc0", 1.0),
    ("mit", 1.0), ("apache", 0.95), ("bsd", 0.95), ("isc", 1.0), ("mpl", 0.7), ("epl", 0.7), ("unlicense", 1.0), ("proprietary", 0.0),
]
#: Licences not in the list, and what an exception adds.
UNKNOWN_FREEDOM = 0.1
EXCEPTION_FREEDOM = 0.1

_TOKEN = re.compile(r"[()]|[^\s()]+")
_IDENTIFIER = re.compile(r"[a-z0-9][a-z0-9.+\-:]*$")
_BINDING = {"or": 1, "and": 2, "with": 3}

# Bytes of words: lower-case letters, digits and all of non-ASCII; capitals fold, the rest separates.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() and chr(b).islower() or chr(b).isdigit() else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def freedom(name: str) -> float:
    return next((f for prefix, f in FREEDOM if name.startswith(prefix)), UNKNOWN_FREEDOM)


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard: ``with`` binds closest, then ``and``, then ``or``; None if it is no expression.

    A comment's closing signs after a complete expression are left out.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression.lower()):
        if token in _BINDING:
            if operand_next:
                return None
            while waiting and waiting[-1] != "(" and _BINDING[waiting[-1]] >= _BINDING[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand_next = True
        elif token == "(":
            if not operand_next:
                return None
            waiting.append(token)
        elif token == ")":
            if operand_next:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif operand_next and _IDENTIFIER.match(token):
            out.append(token.rstrip("."))
            operand_next = False
        elif not operand_next and not _IDENTIFIER.match(token):
            break
        else:
            return None
    if operand_next or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], float]:
    """The licences an expression names, and the freedom it gives: least of ``and``, most of ``or``."""
    stack: list[tuple[set[str], float]] = []
    for token in postfix:
        if token not in _BINDING:
            stack.append(({token}, freedom(token)))
            continue
        (right, free_right), (left, free_left) = stack.pop(), stack.pop()
        if token == "with":
            stack.append(({f"{name} with {exception}" for name in left for exception in right}, min(1.0, free_left + EXCEPTION_FREEDOM)))
        else:
            stack.append((left | right, (max if token == "or" else min)(free_left, free_right)))
    return stack[0]


def normal_words(text: str) -> tuple[str, int]:
    """The words of a text, one space before, between and after them, and their number."""
    words = text.encode("utf-8").translate(_FOLD).split()
    return f" {b' '.join(words).decode('utf-8')} ", len(words)


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {*BASE_PHRASES, *NOTICE_PHRASES, TAG}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(text: str, phrases: ahocorasick.Automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expressions of one text."""
    words, n_words = normal_words(text)
    starts: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    tagged = False
    known, at = 0, 0
    for end, phrase in phrases.iter(words):
        if phrase == TAG:
            tagged = True
            continue
        if phrase in BASE_PHRASES:
            begin = end - len(phrase) - 1
            if begin >= at:
                known += words.count(" ", at, begin)
            else:
                known -= words.count(" ", begin, at)
            at = begin
            starts.append(known)
            base.add(BASE_PHRASES[phrase])
        if phrase in NOTICE_PHRASES:
            labels.add(NOTICE_PHRASES[phrase])
    frees = [freedom(x) for x in base | labels]
    expressions: list[str] = []
    for line in _TAG_LINE.findall(text.lower()) if tagged else ():
        if postfix := to_postfix(line):
            names, free = evaluate(postfix)
            labels |= names
            frees.append(free)
            expressions.append(" ".join(postfix))
    score = min(frees) if frees else 1.0
    return (
        n_words, len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | labels)), score, "; ".join(expressions),
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """Licence phrases, tags and labels of each whole text, one row per input row.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    expressions``. ``score`` is the freedom to reuse the text that its notices leave: 1 without
    any, else that of the strictest notice or expression. Places of several base phrases all
    count, overlapping ones too. A null or empty text has no words and no labels (empty strings);
    a tag whose rest of line is no expression adds nothing.
    """
    docs = pick(docs, "doc_id", "text")
    types = [LongType(), LongType(), LongType(), LongType(), StringType(), StringType(), DoubleType(), StringType()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions"]

    def make() -> Callable:
        phrases = automaton()

        def step(columns: dict[str, list]) -> dict[str, list]:
            rows = [scan(as_text(t), phrases) for t in columns["text"]]
            return {"doc_id": columns["doc_id"]} | {n: [r[i] for r in rows] for i, n in enumerate(names)}

        return step

    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *(StructField(n, t) for n, t in zip(names, types, strict=True))])
    return map_batches(docs, make, schema)
