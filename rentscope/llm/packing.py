"""Packing token sequences into windows by non-negative least squares on the length histogram.

A document's ids go into whole windows first; what remains of it is shorter than a window. The
remainders' lengths are counted by steps of a few tokens. Shallow combinations of steps that fill
a window (two or three remainders) are enumerated once, and least squares with non-negative
counts says how often to repeat each, so that together they use up the histogram. Counts are
rounded within what is there; combinations that still fit are added greedily. Remainders get
their places by their rank within their step, from counts per task and prefix sums over them, so no
step, however common, is gathered. All that is left (what no combination takes, and the few ids by which
a combination exceeds its window) is laid end to end and cut at windows. The histogram, the
combinations and the solution have a size fixed by the window, whatever the input.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from rentscope.llm.common import PartTable, as_text, pick, release_memory, worker_state
from rentscope.plans.saved import save

WINDOW, STEP, DEPTH, END_ID = 2048, 16, 3, 1
#: Words of a worker's table, its bytes, and the longest word that stays there when it is full.
TABLE_SIZE, TABLE_BYTES, LONGEST_KEPT = 500_000, 50_000_000, 64
#: Words of a line, lines that are encoded at once, letters of texts that are looked up together, and bytes of ids in a batch.
LINE, LINES, LETTERS_AT_ONCE, BATCH_BYTES = 1_000, 20, 4_000_000, 4_000_000
#: Sequence ids: whole windows are numbered by task and turn, combinations and the rest from here on.
COMBINED = 2**62

# Fixed value: the pattern that cuts words in the tokenizer file with word ends. It takes no white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of printable ASCII and accented Latin letters: all versions of Unicode classify, compose and lower these alike.
PLAIN = re.compile("[\n\t -~À-ÿ]*").fullmatch
#: Parts that are one word, and already as the normaliser leaves them.
ONE_WORD = re.compile("[a-zß-öø-ÿ]+").fullmatch
#: A stop that ends a word is one of its own.
LAST_STOP = re.compile("(?<=[a-z0-9ß-öø-ÿ])[.,;:?!](?=[ \n\t]|$)").sub


class WordIds:
    """Ids of texts as the library gives them, as little-endian 32-bit bytes.

    Where the tokenizer drops white space and nothing in it reaches over a space, a text's ids are
    those of its parts between spaces, tabs and line feeds, which repeat; else texts go whole. Plain texts
    (``PLAIN``) are lowered first and their stops set apart, so that more parts repeat. New words are encoded many at a
    time, as one line: tokens that end a word say where each begins.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.table = PartTable(self.parts, TABLE_SIZE, TABLE_BYTES, LONGEST_KEPT)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        split, model = steps[0], spec["model"]
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        special = [t["content"] for t in spec["added_tokens"]]
        self.by_word = (
            split.get("type") == "Split" and split["pattern"] == {"Regex": WORD_PATTERN} and split["invert"] and split["behavior"] == "Removed"
            and all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in steps[1:])
            and normal == ["NFC", "Replace", "Lowercase"] and spec["post_processor"] is None
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
            and all(c.split() == [c] and "<|" in c for c in special) and bool(model.get("end_of_word_suffix"))
        )
        if self.by_word:
            ends = [i for t, i in model["vocab"].items() if t.endswith(model["end_of_word_suffix"])]
            self.ends_word = np.zeros(max(model["vocab"].values()) + len(special) + 1, bool)
            self.ends_word[ends] = True
            # The library's model alone: single words need neither the normaliser nor the pattern.
            self.model = Tokenizer.from_file(path)
            self.model.normalizer = normalizers.Sequence([])
            self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of single words."""
        out: list[bytes] = []
        for at in range(0, len(words), LINES * LINE):
            lines = [words[i : i + LINE] for i in range(at, min(at + LINES * LINE, len(words)), LINE)]
            for line, e in zip(lines, self.model.encode_batch_fast([" ".join(line) for line in lines], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                ends = np.flatnonzero(self.ends_word[ids]) + 1
                data = ids.tobytes()
                out += [data[a:b] for a, b in itertools.pairwise([0, *(4 * ends).tolist()])] if len(ends) == len(line) else self.encode(line)
        return out

    def parts(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts."""
        single = [w for w in parts if ONE_WORD(w)]
        found = dict(zip(single, self.words(single), strict=True))
        other = [w for w in parts if w not in found]
        found.update(zip(other, self.encode(other), strict=True))
        return [found[w] for w in parts]

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self.encode(texts)
        ready = [(LAST_STOP(r" \g<0>", t.lower()) if PLAIN(t) and "<|" not in t else t).replace("\n", " ").replace("\t", " ") for t in texts]
        split = pc.split_pattern(pa.array(ready, pa.large_string()), " ")
        return self.table.ids(split.flatten(), split.offsets.to_numpy())


def _blocks(docs: DataFrame, path: str, window: int, step: int, end_id: int) -> DataFrame:
    """Ids of all documents in blocks of a window, and one shorter remainder each.

    ``task, row`` name a block. Remainders have their length in steps and ``rank``, the number of
    remainders of as many steps that the task has had before.
    """
    schema = StructType([
        StructField("task", LongType()), StructField("row", LongType()), StructField("doc_id", docs.schema["doc_id"].dataType),
        StructField("doc_tokens", LongType()), StructField("start", LongType()), StructField("length", LongType()), StructField("whole", BooleanType()),
        StructField("steps", IntegerType()), StructField("rank", LongType()), StructField("ids", BinaryType()),
    ])
    arrow = to_arrow_schema(schema)
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch], words: WordIds) -> Iterator[tuple]:
        for batch in batches:
            texts, letters, doc_ids = [], 0, batch.column(0).to_pylist()
            # A batch may hold long texts: only some are Python strings at one time.
            for i, value in enumerate(batch.column(1)):
                texts.append(as_text(value.as_py()))
                letters += len(texts[-1])
                if letters >= LETTERS_AT_ONCE or i == len(doc_ids) - 1:
                    for doc_id, ids in zip(doc_ids[i + 1 - len(texts) : i + 1], words.ids(texts), strict=True):
                        yield doc_id, ids + end
                    texts, letters = [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        words: WordIds = worker_state(f"packing {path}", lambda: WordIds(path))
        task, row, size = TaskContext.get().partitionId(), 0, 0
        ranks = [0] * (window // step + 1)
        out: list[tuple] = []
        for doc_id, ids in encoded(batches, words):
            n = len(ids) // 4
            for at in range(0, n, window):
                length = min(window, n - at)
                steps = length // step
                whole = length == window
                out.append((task, row, doc_id, n, at, length, whole, None if whole else steps, None if whole else ranks[steps], ids[4 * at : 4 * (at + length)]))
                if not whole:
                    ranks[steps] += 1
                row += 1
            size += len(ids)
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)], schema=arrow)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)], schema=arrow)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def combinations(steps: int, depth: int) -> list[tuple[int, ...]]:
    """All ways to write ``steps`` as 2 to ``depth`` whole numbers, the smallest first."""

    def ways(rest: int, least: int, left: int) -> Iterator[tuple[int, ...]]:
        if left == 1:
            yield (rest,)
            return
        for first in range(least, rest // left + 1):
            for more in ways(rest - first, first, left - 1):
                yield (first, *more)

    return list(itertools.chain.from_iterable(ways(steps, 1, n) for n in range(2, depth + 1)))


def least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``x >= 0`` with the least ``|a x - b|``, by an active set: at most as many positive values as rows."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], bool)
    enough = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= enough:
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            trial = np.zeros_like(x)
            trial[at] = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            low = at[trial[at] <= 0]
            if not len(low):
                break
            # Go towards the trial until the first value reaches zero, and fix what did.
            share = float((x[low] / np.maximum(x[low] - trial[low], 1e-300)).min())
            x += share * (trial - x)
            fixed = free & (x <= 1e-12 * max(1.0, float(x.max())))
            x[fixed] = 0
            if not fixed.any():
                free[low] = False
                x[low] = 0
            free &= ~fixed
        x = trial
    return x


@dataclass
class Plan:
    """Combinations with their repeats, and what they leave of the histogram."""

    repeats: list[tuple[tuple[int, ...], int]]
    left: list[int]

    def places(self) -> list[tuple[int, int, int, int, int]]:
        """``steps, from, to, first, slot``: remainders of ``steps`` whose rank is in a range go to the windows from ``first`` on."""
        used: dict[int, int] = {}
        out, first = [], 0
        for parts, n in self.repeats:
            for slot, steps in enumerate(parts):
                begin = used.get(steps, 0)
                out.append((steps, begin, begin + n, first, slot))
                used[steps] = begin + n
            first += n
        return out

    @property
    def windows(self) -> int:
        return sum(n for _, n in self.repeats)


def plan(histogram: dict[int, int], window: int = WINDOW, step: int = STEP, depth: int = DEPTH) -> Plan:
    """How often to use each combination for so many remainders by length in steps."""
    full = window // step
    left = [0] * (full + 1)
    for steps, n in histogram.items():
        left[steps] = n
    ways = combinations(full, depth)
    a = np.zeros((full, len(ways)))
    for i, parts in enumerate(ways):
        for steps in parts:
            a[steps, i] += 1
    x = least_squares(a[1:], np.array(left[1:full], np.float64))
    repeats: dict[int, int] = {}

    def use(i: int, most: float) -> None:
        parts = ways[i]
        n = int(min(most, *(left[s] // parts.count(s) for s in parts)))
        if n > 0:
            repeats[i] = repeats.get(i, 0) + n
            for s in parts:
                left[s] -= n

    for i in np.argsort(-x, kind="stable").tolist():
        if x[i] > 0:
            use(i, np.floor(x[i] + 0.5))
    # Greedily what the rounded solution leaves, pairs before triples.
    for i in range(len(ways)):
        use(i, float("inf"))
    return Plan([(ways[i], n) for i, n in sorted(repeats.items())], left)


def _cut_ends(at: Column, length: Column, total: int, window: int) -> Column:
    """The windows ``(from, to, turn)`` that a stretch of the laid-out rest touches; what is over after whole windows goes to powers of two."""
    whole = total // window
    ends, begin = [], whole * window
    for turn, size in enumerate(2**e for e in range(window.bit_length() - 1, -1, -1) if (total - whole * window) & 2**e):
        ends.append((begin, begin + size, whole + turn))
        begin += size
    last = F.least(F.expr("CAST((at + length - 1) AS BIGINT)"), F.lit(whole * window - 1))
    turns = F.when(at < whole * window, F.sequence(F.floor(at / window), F.floor(last / window))).otherwise(F.array().cast("array<bigint>"))
    named = lambda a, b, t: F.struct(a.alias("from"), b.alias("to"), t.alias("turn"))
    inside = F.transform(turns, lambda t: named(t * window, (t + 1) * window, t))
    if not ends:
        return inside
    short = F.array(*[named(*(F.lit(v).cast("long") for v in e)) for e in ends])
    return F.concat(inside, F.filter(short, lambda e: (e["to"] > at) & (e["from"] < at + length)))


def _windowed(rest: DataFrame, window: int, step: int, depth: int) -> DataFrame:
    """``task, row, skip, length, sequence_id, offset``: the pieces of all remainders, ``skip`` ids after their block's first."""
    spark = rest.sparkSession
    counts = save(rest.groupBy("task", "steps").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    found = plan({r.steps: r.n for r in counts.groupBy("steps").agg(F.sum("n").alias("n")).collect()}, window, step, depth)
    before = Window.partitionBy("steps").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "steps", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # At most as many rows as the combinations have parts.
    places = spark.createDataFrame(found.places(), "of int, from long, to long, first long, slot int")
    place = rest.join(offsets, ["task", "steps"]).withColumn("place", F.col("before") + F.col("rank"))
    place = place.join(F.broadcast(places), (F.col("steps") == F.col("of")) & (F.col("place") >= F.col("from")) & (F.col("place") < F.col("to")), "left")
    place = save(place.select("task", "row", "length", (F.col("first") + F.col("place") - F.col("from")).alias("turn"), "slot"), "packing-places")
    earlier = Window.partitionBy("turn").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    # The longest remainder comes last in its window and ends where the window does; its last few ids go to the rest.
    combined = place.filter("slot IS NOT NULL").withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    combined = save(combined.withColumn("kept", F.least("length", F.lit(window) - F.col("offset"))), "packing-combined")
    zero = F.lit(0).cast("long")
    pieces = combined.select("task", "row", zero.alias("skip"), F.col("kept").alias("length"), (F.lit(COMBINED) + F.col("turn")).alias("sequence_id"), "offset")
    over = combined.filter("kept < length").select("task", "row", F.col("kept").alias("skip"), (F.col("length") - F.col("kept")).alias("length"))
    loose = save(place.filter("slot IS NULL").select("task", "row", zero.alias("skip"), "length").unionByName(over), "packing-rest")
    sums = loose.groupBy("task").agg(F.sum("length").alias("sum"))
    # One row per task that read documents.
    ahead = save(sums.select("task", F.coalesce(F.sum("sum").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"), "sum"), "packing-tasks")
    total = ahead.agg(F.coalesce(F.sum("sum"), F.lit(0))).first()[0]
    inside = Window.partitionBy("task").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    laid = loose.join(ahead.drop("sum"), "task").withColumn("at", F.col("ahead") + F.coalesce(F.sum("length").over(inside), F.lit(0)))
    cut = laid.withColumn("w", F.explode(_cut_ends(F.col("at"), F.col("length"), total, window)))
    begin, end = F.greatest("at", F.col("w.from")), F.least(F.col("at") + F.col("length"), F.col("w.to"))
    rest_pieces = cut.select(
        "task", "row", (F.col("skip") + begin - F.col("at")).alias("skip"), (end - begin).alias("length"),
        (F.lit(COMBINED + found.windows) + F.col("w.turn")).alias("sequence_id"), (begin - F.col("w.from")).alias("offset"),
    )
    return pieces.unionByName(rest_pieces)


def pack(docs: DataFrame, path: str, window: int = WINDOW, step: int = STEP, depth: int = DEPTH, end_id: int = END_ID) -> DataFrame:
    """All ids of all documents in sequences of at most ``window`` ids.

    Rows are pieces: ``doc_id, start`` (ids of the document before it), ``length, ids`` (little-endian 32-bit), ``doc_tokens,
    sequence_id, offset``. A document's ids are the library's without special tokens, with ``end_id`` after them; each is in exactly
    one piece. All sequences are full, but for the last ones of the rest, whose lengths are the powers of two that
    make it up, so nothing is padded. A null text is an empty one and has its end id only. Rows that share an id, repeat or have none are
    documents of their own. An empty table gives an empty result.
    """
    if window % step or window & (window - 1):
        raise ValueError("a window is a power of two and a number of steps")
    blocks = save(_blocks(pick(docs, "doc_id", "text"), path, window, step, end_id), "packing-blocks")
    pieces = _windowed(blocks.filter("NOT whole").select("task", "row", "length", "steps", "rank"), window, step, depth)
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    number = (F.col("task") * 2**32 + F.col("row")).alias("sequence_id")
    full = blocks.filter("whole").select("doc_id", "start", "length", "ids", "doc_tokens", number, F.lit(0).cast("long").alias("offset"))
    held = blocks.filter("NOT whole").select("task", "row", "doc_id", "doc_tokens", "start", "ids")
    cut = held.hint("merge").join(pieces, ["task", "row"])
    ids = F.expr("substring(ids, CAST(skip * 4 + 1 AS INT), CAST(length * 4 AS INT))")
    return full.unionByName(cut.select("doc_id", (F.col("start") + F.col("skip")).alias("start"), "length", ids.alias("ids"), "doc_tokens", "sequence_id", "offset").select(*names))
