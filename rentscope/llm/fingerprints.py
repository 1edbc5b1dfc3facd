"""Order MinHash fingerprints of documents.

The k-mers of a text are numbered by occurrence, so that repeats stay apart. Each of several
hash functions selects its smallest ones; these are put back into text order, and the hash of
the ordered tuple is one entry of the fingerprint. Two texts agree in an entry if the same
k-mers were selected in the same order, which falls with edit distance, and not only with the
share of common k-mers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from rentscope.llm.common import as_text, compressed, map_batches, pick, unpacked
from rentscope.plans.saved import save

#: Letters of a k-mer, entries of a fingerprint, and k-mers per entry.
KMER = 12
ENTRIES = 64
#: Columns hashed at once; bounds memory for texts of any length.
_CHUNK = 16_384
_rng = np.random.default_rng(42)
_ODD = _rng.integers(1, 2**63, ENTRIES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _rng.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _STEP[0]
    x = (x ^ (x >> np.uint64(29))) * _STEP[1]
    return x ^ (x >> np.uint64(32))


def kmer_hashes(text: str) -> np.ndarray:
    """Hashes of the k-mers in text order; a shorter text is one k-mer, an empty one has none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if len(codes) < KMER:
        if not len(codes):
            return codes
        return _mixed(np.array([(codes * _STEP[2] ** np.arange(len(codes), dtype=np.uint64)).sum() + np.uint64(len(codes))], np.uint64))
    two = codes[:-1] * _STEP[2] + codes[1:]
    four = two[:-2] * _STEP[3] + two[2:]
    eight = four[:-4] * _STEP[4] + four[4:]
    return _mixed(eight[:-4] * _STEP[5] + four[8:])


def numbered(kmers: np.ndarray) -> np.ndarray:
    """Hashes of k-mers with their occurrence number: the first occurrence keeps its hash."""
    ordered = np.sort(kmers)
    if not (ordered[1:] == ordered[:-1]).any():
        return kmers
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    place = np.arange(len(order))
    occurrence = place - np.maximum.accumulate(np.where(first, place, 0))
    out = kmers.copy()
    again = occurrence > 0
    out[order[again]] = _mixed(ordered[again] + occurrence[again].astype(np.uint64) * _STEP[6])
    return out


def signature(text: str) -> np.ndarray:
    """One 32-bit entry per hash function."""
    kmers = kmer_hashes(text)
    if not len(kmers):
        return np.zeros(ENTRIES, np.uint32)
    keys = numbered(kmers)
    rows = np.arange(ENTRIES)
    most = np.uint64(2**64 - 1)
    values = np.full((ENTRIES, 2), most)
    places = np.zeros((ENTRIES, 2), np.int64)
    for start in range(0, len(keys), _CHUNK):
        hashed = keys[None, start : start + _CHUNK] * _ODD[:, None]
        first = hashed.argmin(axis=1)
        found = [(hashed[rows, first], first + start)]
        if hashed.shape[1] > 1:
            hashed[rows, first] = most
            second = hashed.argmin(axis=1)
            found.append((hashed[rows, second], second + start))
        for value, place in found:
            smaller = value < values[:, 0]
            middle = ~smaller & (value < values[:, 1])
            values[smaller, 1], places[smaller, 1] = values[smaller, 0], places[smaller, 0]
            values[smaller, 0], places[smaller, 0] = value[smaller], place[smaller]
            values[middle, 1], places[middle, 1] = value[middle], place[middle]
    low, high = places.min(axis=1), places.max(axis=1)
    pair = _mixed(kmers[low] * _STEP[2] + kmers[high] * _STEP[7] if len(kmers) > 1 else kmers[low])
    return (pair >> np.uint64(32)).astype(np.uint32)


def as_hex(entries: np.ndarray) -> str:
    return entries.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the following one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _compared(text: str, own: np.ndarray, following: str, next_entries: np.ndarray) -> tuple:
    changed = edited(text, following)
    of_changed = own if changed == text else signature(changed)
    return (
        len(text), hashlib.sha256(changed.encode("utf-8")).hexdigest(), as_hex(own), as_hex(of_changed),
        likeness(own, of_changed), likeness(own, next_entries),
    )


_RESULT = [
    StructField("n_chars", LongType()), StructField("edited_sha256", StringType()), StructField("fingerprint", StringType()),
    StructField("edited_fingerprint", StringType()), StructField("near_edited", DoubleType()), StructField("near_next", DoubleType()),
]
#: Rows of the first pass: done, the first of a part (for the part before), and the last of a part (waits for the next part).
_DONE, _FIRST, _LAST = 0, 1, 2


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text: ``doc_id, n_chars, fingerprint``, one row per input row; null counts as empty."""
    docs = pick(docs, "doc_id", "text")

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            texts = [as_text(t) for t in columns["text"]]
            return {"doc_id": columns["doc_id"], "n_chars": list(map(len, texts)), "fingerprint": [as_hex(signature(t)) for t in texts]}

        return step

    return map_batches(docs, make, StructType([docs.schema["doc_id"], _RESULT[0], _RESULT[2]]))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of the text edited with its successor.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. Texts are ranged by id once and streamed in order, so each meets its successor
    in its task; only the first and last texts of the parts are joined afterwards. Null ids come
    first; rows that share an id follow each other by a hash of their text; a null text counts as an empty one; a
    single document is its own successor; an empty table gives an empty result.
    """
    docs = pick(docs, "doc_id", "text")
    packed = compressed(docs.withColumn("text_hash", F.xxhash64("text")), "text_hash")
    ranged = packed.repartitionByRange(F.col("doc_id").asc(), F.col("text_hash").asc()).sortWithinPartitions("doc_id", "text_hash")
    schema = StructType([docs.schema["doc_id"], *_RESULT, StructField("kind", IntegerType()), StructField("part", IntegerType()), StructField("text", StringType())])
    names, arrow = schema.names, to_arrow_schema(schema)
    empty = pa.RecordBatch.from_arrays([pa.array([], f.type) for f in arrow], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before = None
        for batch in batches:
            rows = []
            for doc_id, one in zip(batch.column("doc_id").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                text = unpacked(one).decode("utf-8")
                entries = signature(text)
                if before is None:
                    rows.append((doc_id, len(text), None, as_hex(entries), None, None, None, _FIRST, part, text))
                else:
                    rows.append((before[0], *_compared(before[1], before[2], text, entries), _DONE, part, None))
                before = doc_id, text, entries
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], names=names) if rows else empty
        if before is not None:
            row = (before[0], len(before[1]), None, as_hex(before[2]), None, None, None, _LAST, part, before[1])
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, arrow, strict=True)], names=names)

    streamed = save(ranged.mapInArrow(run, schema), "fingerprints")
    done = streamed.filter(F.col("kind") == _DONE).select("doc_id", *(f.name for f in _RESULT))
    firsts = streamed.filter(F.col("kind") == _FIRST)
    by_part = Window.orderBy("part")
    after = firsts.select("part", F.coalesce(F.lead("part").over(by_part), F.min("part").over(Window.partitionBy())).alias("next_part"))
    following = firsts.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    borders = streamed.filter(F.col("kind") == _LAST).select("doc_id", "part", "text").join(after, "part").join(following, "next_part")

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            rows = [_compared(t, signature(t), n, signature(n)) for t, n in zip(columns["text"], columns["next_text"], strict=True)]
            return {"doc_id": columns["doc_id"]} | {f.name: [r[i] for r in rows] for i, f in enumerate(_RESULT)}

        return step

    return done.unionByName(map_batches(borders.select("doc_id", "text", "next_text"), make, StructType([docs.schema["doc_id"], *_RESULT])))
