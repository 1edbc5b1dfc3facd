"""Token counts of whole texts by a two-tier lookup on the map side.

A text is cut into pre-tokens by the tokenizer's own pattern. Lengths of frequent pre-tokens
come from a compact table that every task gets once; the rest is encoded by the library and
kept in a bounded cache of the worker. No pre-token is ever shuffled, and the table only
saves work: counts do not depend on what it holds. Texts with a character that the pattern
and the library class differently go to the library whole.
"""

from __future__ import annotations

import collections
import json
import uuid
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType
from tokenizers import Tokenizer

from rentscope.llm.common import BoundedCache, as_text, map_batches, pick, worker_state

# Fixed value: the pattern by which byte-level BPE cuts texts into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Entries of the table of frequent pre-tokens, and texts looked at to choose them.
TABLE_SIZE = 50_000
TABLE_TEXTS = 2_000
TABLE_LETTERS = 4_000
#: Entries of a worker's cache, and the longest pre-token kept there.
CACHE_SIZE = 300_000
LONGEST_KEPT = 64
LIMIT = 1024

class PreTokens:
    """A tokenizer file's pre-token pattern and special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
            raise ValueError(f"{path}: only byte-level BPE without normaliser and added space is counted by pre-tokens")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take their surroundings are not supported")
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.find = regex.compile(PRE_TOKEN).findall
        self.library = Tokenizer.from_file(path)
        # Letters, numbers and spaces differ between versions of Unicode: each character is tried once in both.
        self.agreed: set[str] = set()
        self.disputed: set[str] = set()

    def agrees(self, text: str) -> bool:
        """Whether the pattern cuts all characters of a text as the library does."""
        kinds = set(text)
        if not kinds <= self.agreed:
            for c in kinds - self.agreed - self.disputed:
                trial = f"a{c}1{c} {c}{c}b"
                same = len(self.find(trial)) == len(self.library.pre_tokenizer.pre_tokenize_str(trial))
                (self.agreed if same else self.disputed).add(c)
            return not kinds & self.disputed
        return True

    def split(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens between special strings, and how many special strings there are."""
        if self.special is None or not self.special.search(text):
            return self.find(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in self.find(part)], len(parts) - 1


class TokenCounter:
    """A tokenizer, the table of frequent lengths and the cache for the rest: kept by a worker over tasks."""

    def __init__(self, path: str, table: tuple[str, bytes]):
        names, lengths = table
        self.pre_tokens, self.tokenizer, self.cache = PreTokens(path), Tokenizer.from_file(path), BoundedCache(CACHE_SIZE)
        self.frequent = dict(zip(names.split("\0") if lengths else [], np.frombuffer(lengths, np.uint16).tolist(), strict=True))

    def lengths(self, pre_tokens: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(pre_tokens, add_special_tokens=False)]

    def count(self, text: str) -> int:
        """Tokens of a text."""
        if not self.pre_tokens.agrees(text):
            return self.lengths([text])[0]
        parts, n = self.pre_tokens.split(text)
        found = list(map(self.frequent.get, parts))
        if None not in found:
            return n + sum(found)
        cache = self.cache
        now, new = cache.missing({p for p, f in zip(parts, found, strict=True) if f is None and p not in cache})
        if new:
            now.update(zip(new, self.lengths(new), strict=True))
        n += sum(now[p] if p in now else cache[p] for p, f in zip(parts, found, strict=True) if f is None) + sum(filter(None, found))
        if now:
            cache.keep({p: length for p, length in now.items() if len(p) <= LONGEST_KEPT})
        return n


def frequent_lengths(texts: DataFrame, path: str, table_size: int = TABLE_SIZE, table_texts: int = TABLE_TEXTS) -> tuple[str, bytes]:
    """The commonest pre-tokens of some texts with their token counts, at most ``table_size``.

    The texts are the first ``table_texts`` that come, and of each its first TABLE_LETTERS, so the
    driver sees a bounded amount; they only decide which lengths every task knows from the start.
    Compact: the pre-tokens joined by a separator that none of them holds, and one 16-bit length each.
    """
    tools = TokenCounter(path, ("", b""))
    counts: collections.Counter[str] = collections.Counter()
    for row in texts.select(F.substring("text", 1, TABLE_LETTERS).alias("text")).limit(table_texts).collect():
        counts.update(p for p in tools.pre_tokens.split(as_text(row.text))[0] if len(p) <= LONGEST_KEPT and "\0" not in p)
    top = [p for p, _ in counts.most_common(table_size)]
    return "\0".join(top), np.array(tools.lengths(top), dtype=np.uint16).tobytes()


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, table_size: int = TABLE_SIZE, table_texts: int = TABLE_TEXTS) -> DataFrame:
    """Bytes and tokens of each text: ``doc_id, n_bytes, n_tokens, over_limit``, one row per input row.

    Counts are the library's without added tokens; special strings inside a text count as one
    token each, as by default. A null text counts as an empty one. The number of rows, ids and
    null ids are left as they are; an empty table gives an empty result.
    """
    docs = pick(docs, "doc_id", "text")
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, table_size, table_texts))
    mark = uuid.uuid4().hex

    def make() -> Callable:
        counter = worker_state(f"counts {mark}", lambda: TokenCounter(path, table.value))

        def step(columns: dict[str, list]) -> dict[str, list]:
            texts = [as_text(t) for t in columns["text"]]
            n_tokens = list(map(counter.count, texts))
            return {
                "doc_id": columns["doc_id"],
                "n_bytes": [len(t.encode("utf-8")) for t in texts],
                "n_tokens": n_tokens,
                "over_limit": [n > limit for n in n_tokens],
            }

        return step

    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_bytes", LongType()),
        StructField("n_tokens", LongType()), StructField("over_limit", BooleanType()),
    ])
    return map_batches(docs.select("doc_id", F.col("text").cast("string").alias("text")), make, schema)
