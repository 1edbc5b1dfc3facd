"""Removal of long byte strings that occur earlier in the corpus, by suffix arrays.

Candidates first. Every string of the threshold's length holds a window of k-grams; the k-gram
of least hash is its anchor. Strings with one anchor in common make a run, and equal strings
have equal anchors, so runs meet under the anchor's hash. Equal runs are settled there: all but
the earliest are repeats. What remains are runs that share an anchor but differ.

Their bytes go to blocks of bounded size. A block's suffix array and Burrows-Wheeler transform
are built, and intervals are expanded breadth first: prepending a byte to all strings of
length l gives the intervals of length l + 1, whose right ends mark common prefixes of l bytes.
Common prefixes so come out by increasing length, and the expansion stops at the threshold.
Neighbours in the suffix array without a mark start with the same string, and all but the
earliest of them are repeats.

An anchor with very many runs is spread over blocks; the first strings of their classes are
then compared by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from rentscope.llm.common import DOCUMENT_COLUMNS, as_text, compressed, map_batches, pick, release_memory, unpacked
from rentscope.plans.saved import save

#: Bytes of a string that counts as a repeat, and of the k-grams that anchor it.
LENGTH = 100
GRAM = 32
#: Bytes of runs in one block, and letters of texts whose runs are settled at once: they bound a task's memory.
BLOCK_BYTES = 600_000
TOGETHER = 6_000_000
#: Different runs of one anchor that are sent on together by a batch, and that stay in one block.
RUNS_TOGETHER, RUNS_IN_BLOCK = 256, 2_000
#: Positions whose anchors are sought at once; a place in it takes 24 bits.
SPAN = 8_000_000

_rng = np.random.default_rng(303)
_ODD = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte strings, by doubling."""
    total, size, step = data.astype(np.uint64) + np.uint64(1), 1, 0
    while size < GRAM:
        total = total[:-size] * _ODD[step] + total[size:]
        size, step = 2 * size, step + 1
    total = (total ^ (total >> np.uint64(32))) * _ODD[14]
    total = (total ^ (total >> np.uint64(29))) * _ODD[15]
    return total ^ (total >> np.uint64(32))


def runs(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first start and number of starts of each run of strings with one anchor."""
    keys, starts, counts = [], [], []
    place = np.uint64(0xFFFFFF)
    for at in range(0, len(data) - length + 1, SPAN):
        part = data[at : at + SPAN + length - 1]
        hashes = _gram_hashes(part)
        n, window = len(part) - length + 1, length - GRAM + 1
        least, size = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64), 1
        while 2 * size <= window:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        anchor = (np.minimum(least[:n], least[window - size : window - size + n]) & place).astype(np.int64)
        start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        keys.append(hashes[anchor[start]])
        starts.append(start + at)
        counts.append(np.diff(np.r_[start, n]))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(starts), np.concatenate(counts)


_RUN = {"key": np.uint64, "digest": np.uint64, "doc": np.int64, "start": np.int64, "count": np.int64, "wide": np.uint8}
_WHOLE = {"doc": np.int64, "start": np.int64, "count": np.int64}


def _packed(columns: dict[str, np.ndarray]) -> bytes:
    """Columns in one compressed string."""
    return zstandard.compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns.values()), 1)


def _unpacked(blobs: list[bytes], kinds: dict[str, type]) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {name: [np.zeros(0, kind)] for name, kind in kinds.items()}
    width = sum(np.dtype(kind).itemsize for kind in kinds.values())
    for blob in blobs:
        data = zstandard.decompress(blob)
        n, at = len(data) // width, 0
        for name, kind in kinds.items():
            parts[name].append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(found) for name, found in parts.items()}


def _settled(found: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], np.ndarray]:
    """The earliest of equal runs; the others, which are repeats as a whole; and how many different runs each one's anchor has."""
    order = np.lexsort((found["start"], found["doc"], found["digest"], found["key"]))
    found = {name: c[order] for name, c in found.items()}
    new = lambda *names: np.r_[True, np.any([found[n][1:] != found[n][:-1] for n in names], axis=0)][: len(order)]
    once = new("key", "digest", "doc", "start")  # rows that repeat an id come with the same places
    found = {name: c[once] for name, c in found.items()}
    order = order[once]
    first = new("key", "digest")
    kept = {name: c[first] for name, c in found.items()}
    repeats = {name: found[name][~first] for name in _WHOLE}
    by_key = np.r_[True, kept["key"][1:] != kept["key"][:-1]][: len(kept["key"])]
    group = np.cumsum(by_key) - 1
    wide = np.zeros(int(by_key.sum()), np.uint8)
    np.maximum.at(wide, group, kept["wide"])
    kept["wide"] = wide[group]
    return kept, repeats, np.bincount(group, minlength=1)[group]


def _candidates(docs: DataFrame, length: int) -> DataFrame:
    """``doc, start, count, key, wide``: runs to compare, and with null key runs that are repeats as a whole."""
    n_parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = StructType([StructField("part", IntegerType()), StructField("runs", BinaryType()), StructField("repeats", BinaryType())])

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"part": [], "runs": [], "repeats": []}
            ends = np.cumsum([len(as_text(t)) for t in columns["text"]])
            cuts = np.searchsorted(ends, np.arange(0, ends[-1] + TOGETHER, TOGETHER)).tolist()
            for lo, hi in zip(cuts, [*cuts[1:], len(ends)], strict=True):
                if lo < hi:
                    together(columns["doc_id"][lo:hi], columns["text"][lo:hi], out)
            return out

        def together(docs: list[int], texts: list[str | None], out: dict[str, list]) -> None:
            found: dict[str, list[np.ndarray]] = {name: [np.zeros(0, kind)] for name, kind in _RUN.items()}
            for doc, text in zip(docs, texts, strict=True):
                raw = as_text(text).encode("utf-8")
                key, start, count = runs(np.frombuffer(raw, np.uint8), length)
                view = memoryview(raw)
                ends = (start + count + length - 1).tolist()
                digest = np.array([xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(start.tolist(), ends, strict=True)], np.uint64)
                for name, values in zip(_RUN, (key, digest, np.full(len(key), doc), start, count, np.zeros(len(key), np.uint8)), strict=True):
                    found[name].append(values)
            kept, repeats, n_runs = _settled({name: np.concatenate(c) for name, c in found.items()})
            # Of an anchor with very many runs only some go to its part; the rest spreads, and all are marked.
            kept["wide"] |= (n_runs > RUNS_TOGETHER).astype(np.uint8)
            by_key = np.r_[True, kept["key"][1:] != kept["key"][:-1]][: len(n_runs)]
            turn = np.arange(len(n_runs)) - np.maximum.accumulate(np.where(by_key, np.arange(len(n_runs)), 0)) if len(n_runs) else n_runs
            part = (np.where(turn < RUNS_TOGETHER, kept["key"], kept["digest"]) % np.uint64(n_parts)).astype(np.int64)
            repeat_part = np.abs(repeats["doc"] % n_parts)
            order, repeat_order = np.argsort(part, kind="stable"), np.argsort(repeat_part, kind="stable")
            at = np.searchsorted(part[order], np.arange(n_parts + 1))
            repeat_at = np.searchsorted(repeat_part[repeat_order], np.arange(n_parts + 1))
            for p in range(n_parts):
                mine, gone = order[at[p] : at[p + 1]], repeat_order[repeat_at[p] : repeat_at[p + 1]]
                if len(mine) or len(gone):
                    # In order of place, so that documents and places compress.
                    mine = mine[np.lexsort((kept["start"][mine], kept["doc"][mine]))]
                    out["part"].append(p)
                    out["runs"].append(_packed({name: kept[name][mine] for name in _RUN}))
                    out["repeats"].append(_packed({name: repeats[name][gone] for name in _WHOLE}))

        return step

    def meet(table: pa.Table) -> pa.Table:
        release_memory()
        kept, more, n_runs = _settled(_unpacked(table.column("runs").to_pylist(), _RUN))
        repeats = _unpacked(table.column("repeats").to_pylist(), _WHOLE)
        open_ = (n_runs > 1) | (kept["wide"] > 0)
        wide = (kept["wide"] > 0) | (n_runs > RUNS_IN_BLOCK)
        n_whole = len(repeats["doc"]) + len(more["doc"])
        both = {name: np.concatenate([repeats[name], more[name], kept[name][open_]]) for name in _WHOLE}
        key = pa.array(np.concatenate([np.zeros(n_whole, np.int64), kept["key"][open_].view(np.int64)]), pa.int64(), mask=np.arange(len(both["doc"])) < n_whole)
        return pa.table({**both, "key": key, "wide": np.concatenate([np.zeros(n_whole, bool), wide[open_]])})

    schema = StructType([StructField(n, LongType()) for n in ("doc", "start", "count", "key")] + [StructField("wide", BooleanType())])
    return map_batches(docs.select("doc_id", "text"), make, sent, 4_000).groupBy("part").applyInArrow(meet, schema)


def suffix_array(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Order of all suffixes up to their separator (symbol 0); equal ones by place.

    Seven 9-bit symbols make the first key; then prefix doubling, only among suffixes that are
    still equal. ``longest`` is the most symbols between separators.
    """
    n = len(symbols)
    s = symbols.astype(np.int64)

    def joined(a: np.ndarray, b: np.ndarray, shift: int, width: int) -> np.ndarray:
        """Keys followed by the keys ``shift`` symbols on, unless a separator has ended them."""
        out = a << (9 * width)
        alive = np.flatnonzero((a[: n - shift] & 511) != 0)
        out[alive] |= b[alive + shift]
        return out

    two = joined(s, s, 1, 1)
    three = joined(two, s, 2, 1)
    four = joined(two, two, 2, 2)
    key = joined(four, three, 4, 3)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    # Symbols left up to and with the separator: a rank further on counts only within them.
    separators = np.flatnonzero(s == 0)
    left = separators[np.searchsorted(separators, np.arange(n))] - np.arange(n) + 1
    reach = 7
    while reach <= longest:
        size = np.diff(np.r_[np.flatnonzero(new), n])
        tied = np.repeat(size > 1, size)
        slot = np.flatnonzero(tied)
        if not len(slot):
            break
        place = order[slot]
        further = np.where(left[place] > reach, rank[np.minimum(place + reach, n - 1)] + 1, 0)
        pair = rank[place] * (n + 1) + further
        by = np.argsort(pair, kind="stable")
        place, pair = place[by], pair[by]
        order[slot] = place
        fresh = np.r_[True, pair[1:] != pair[:-1]]
        new[slot] |= fresh
        rank[place] = np.maximum.accumulate(np.where(new[slot], slot, 0))
        reach *= 2
    # Suffixes equal to their end stand by place.
    return order


def common_prefix_marks(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True where a suffix shares fewer than ``length`` symbols with the one before it in the suffix array.

    Breadth-first backward extension of intervals on the Burrows-Wheeler transform: an interval
    is expanded if its right end was not marked by a shorter common prefix.
    """
    n = len(symbols)
    last = symbols[order - 1].astype(np.int64)
    last[order == 0] = 0
    by_symbol = np.argsort(last, kind="stable")
    before = np.empty(n, np.int64)  # place of the suffix one symbol longer
    before[by_symbol] = np.arange(n)
    run_start = np.flatnonzero(np.r_[True, last[1:] != last[:-1]])
    run_end = np.r_[run_start[1:], n] - 1
    run_symbol = last[run_start]
    run_of = np.repeat(np.arange(len(run_start)), run_end - run_start + 1)
    marked = np.zeros(n + 1, bool)
    marked[[0, n]] = True
    low, high = np.array([0]), np.array([n - 1])
    for reached in range(length):
        first, n_runs = run_of[low], run_of[high] - run_of[low] + 1
        interval = np.repeat(np.arange(len(low)), n_runs)
        run = np.repeat(first - (np.cumsum(n_runs) - n_runs), n_runs) + np.arange(int(n_runs.sum()))
        symbol = run_symbol[run]
        if reached:  # nothing stands before a separator that could match
            keep = symbol > 0
            interval, run, symbol = interval[keep], run[keep], symbol[keep]
        child_low = before[np.maximum(run_start[run], low[interval])]
        child_high = before[np.minimum(run_end[run], high[interval])]
        several = n_runs[interval] > 1
        if several.any():
            key = interval[several] * 512 + symbol[several]
            by = np.argsort(key, kind="stable")
            starts = np.flatnonzero(np.r_[True, key[by][1:] != key[by][:-1]])
            lows, highs = np.minimum.reduceat(child_low[several][by], starts), np.maximum.reduceat(child_high[several][by], starts)
            child_low, child_high = np.concatenate([child_low[~several], lows]), np.concatenate([child_high[~several], highs])
        new = ~marked[child_high + 1]
        low, high = child_low[new], child_high[new]
        marked[high + 1] = True
        if not len(low):
            break
    return marked[:n]


def repeated_starts(pieces: list[bytes], counts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For runs in order of place: which starts (of all, run after run) repeat an earlier one, and which are first of their string."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes + 1)
    symbols = np.zeros(int(ends[-1]), np.uint16)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[inside] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint16) + 1
    order = suffix_array(symbols, int(sizes.max()) + 1)
    group = np.cumsum(common_prefix_marks(symbols, order, length))
    starts = ends - sizes - 1
    is_start = np.zeros(len(symbols), bool)
    every = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    is_start[every] = True
    slot = np.flatnonzero(is_start[order])
    place, group = order[slot], group[slot]
    begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    first = np.zeros(len(symbols), bool)
    first[np.minimum.reduceat(place, begins)] = True
    return ~first[every], first[every]


def _ranges(docs: DataFrame, length: int) -> DataFrame:
    """``doc, start, count``: consecutive starts of strings that occur earlier."""
    found = save(_candidates(docs, length), "runs")
    whole = found.filter("key IS NULL").select("doc", "start", "count")
    open_runs = found.filter("key IS NOT NULL")
    narrow, wide = open_runs.agg(F.sum(F.when(~F.col("wide"), F.col("count") + length)), F.sum(F.when(F.col("wide"), F.col("count") + length))).first()
    n_narrow, n_wide = max(1, -(-(narrow or 0) // BLOCK_BYTES)), max(1, -(-(wide or 0) // BLOCK_BYTES))
    wanted = open_runs.groupBy("doc").agg(F.collect_list(F.struct("start", "count", "key", "wide")).alias("runs"))
    # Always by a shuffle of the compressed texts: a broadcast would work on small tables only.
    texts = compressed(docs).hint("merge").join(wanted, F.col("doc_id") == F.col("doc")).select("doc", "packed", "runs")
    piece = StructType([
        StructField("doc", LongType()), StructField("start", LongType()), StructField("count", LongType()),
        StructField("key", LongType()), StructField("wide", BooleanType()), StructField("piece", BinaryType()),
    ])

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {n: [] for n in piece.names}
            for doc, packed, wanted_runs in zip(columns["doc"], columns["packed"], columns["runs"], strict=True):
                raw = unpacked(packed)
                for run in wanted_runs:
                    text = raw[run["start"] : run["start"] + run["count"] + length - 1]
                    for name, value in zip(piece.names, (doc, run["start"], run["count"], run["key"], run["wide"], text), strict=True):
                        out[name].append(value)
            return out

        return step

    block = F.when(F.col("wide"), F.pmod(F.xxhash64("doc", "start"), F.lit(n_wide)) + n_narrow).otherwise(F.pmod(F.xxhash64("key"), F.lit(n_narrow)))
    pieces = map_batches(texts, make, piece).withColumn("block", block).drop("key")
    result = StructType([StructField(n, LongType()) for n in ("doc", "start", "count", "one", "two")])

    def expand(table: pa.Table) -> pa.Table:
        release_memory()
        doc, start, count = (np.asarray(table.column(c), np.int64) for c in ("doc", "start", "count"))
        order = np.lexsort((start, doc))
        new = np.r_[True, (doc[order][1:] != doc[order][:-1]) | (start[order][1:] != start[order][:-1])]
        order = order[new]
        doc, start, count = doc[order], start[order], count[order]
        texts = table.column("piece").to_pylist()
        texts = [texts[i] for i in order]
        repeated, first = repeated_starts(texts, count, length)
        run = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        # Consecutive repeats of a run make one range.
        begin = repeated & ~(np.r_[False, repeated[:-1]] & (within > 0))
        end = repeated & ~(np.r_[repeated[1:], False] & np.r_[within[1:] > 0, False])
        at, until = np.flatnonzero(begin), np.flatnonzero(end)
        out = {"doc": doc[run[at]], "start": start[run[at]] + within[at], "count": until - at + 1, "one": np.zeros(len(at), np.int64), "two": np.zeros(len(at), np.int64)}
        empty = np.ones(len(at), bool)
        if table.column("wide")[0].as_py():
            heads = np.flatnonzero(first)
            digest = [xxhash.xxh3_128_digest(texts[r][w : w + length]) for r, w in zip(run[heads].tolist(), within[heads].tolist(), strict=True)]
            halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            more = {"doc": doc[run[heads]], "start": start[run[heads]] + within[heads], "count": np.ones(len(heads), np.int64), "one": halves[:, 0], "two": halves[:, 1]}
            out = {n: np.concatenate([out[n], more[n]]) for n in out}
            empty = np.r_[empty, np.zeros(len(heads), bool)]
        return pa.table({n: pa.array(c, pa.int64(), mask=empty if n in ("one", "two") else None) for n, c in out.items()})

    expanded = save(pieces.groupBy("block").applyInArrow(expand, result), "repeats")
    heads = expanded.filter("one IS NOT NULL")
    several = heads.groupBy("one", "two").agg(F.min(F.struct("doc", "start")).alias("earliest"), F.count("*").alias("n")).filter("n > 1").drop("n")
    late = heads.join(several, ["one", "two"]).filter(F.struct("doc", "start") != F.col("earliest")).select("doc", "start", "count")
    return whole.union(expanded.filter("one IS NULL").select("doc", "start", "count")).union(late)


def spans(starts: list[int], counts: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal removed runs from ranges of starts."""
    out: list[tuple[int, int]] = []
    for start, count in sorted(zip(starts, counts, strict=True)):
        end = start + count - 1 + length
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def _with_spans(docs: DataFrame, length: int, *keep: str) -> DataFrame:
    """``doc_id``, the columns to keep, ``packed`` and the ranges found for each row."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    known = docs.filter("doc_id IS NOT NULL")
    several = known.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b")).filter("a != b").select("doc_id")
    if not several.isEmpty():
        known = known.join(several, "doc_id", "left_anti")
    ranges = _ranges(known.select("doc_id", "text"), length).groupBy("doc").agg(F.collect_list("start").alias("starts"), F.collect_list("count").alias("counts"))
    return compressed(docs, *keep).hint("merge").join(ranges, F.col("doc_id") == F.col("doc"), "left").select("doc_id", *keep, "packed", "starts", "counts")


def _kept(raw: bytes, starts: list[int] | None, counts: list[int] | None, length: int) -> tuple[bytes, int, int]:
    """What is left of the bytes, how many went, and in how many spans."""
    gone = spans(starts or [], counts or [], length)
    at, out = 0, []
    for start, end in gone:
        out.append(raw[at:start])
        at = end
    out.append(raw[at:])
    left = b"".join(out)
    return left, len(raw) - len(left), len(gone)


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Bytes of each text that strings of ``length`` bytes cover which also start earlier.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per input row. Earlier is a
    smaller id, or an earlier start under the same id; strings are judged on the input and never
    cross texts. Null texts count as empty ones. Rows that repeat id and text are one document. Rows
    without id, and ids that come with different texts, take no part and keep all bytes.
    """
    docs = pick(docs, "doc_id", "text")

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"doc_id": columns["doc_id"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for packed, starts, counts in zip(columns["packed"], columns["starts"], columns["counts"], strict=True):
                raw = unpacked(packed)
                left, n_removed, n_spans = _kept(raw, starts, counts, length)
                for name, value in zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), (len(raw), n_removed, n_spans, hashlib.sha256(left).hexdigest()), strict=True):
                    out[name].append(value)
            return out

        return step

    schema = StructType([*(StructField(n, LongType()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")), StructField("kept_sha256", StringType())])
    return map_batches(_with_spans(docs, length), make, schema)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Documents without the bytes that ``repeated_bytes`` counts, with the columns of ``documents``.

    Parts of characters at a cut go too; ``n_chars`` follows the text. Documents of which nothing is
    left go; texts that were empty or null before stay as they are.
    """
    docs = pick(docs, *DOCUMENT_COLUMNS)
    others = [c for c in DOCUMENT_COLUMNS if c not in ("doc_id", "text")]

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {c: [] for c in DOCUMENT_COLUMNS}
            for i, packed in enumerate(columns["packed"]):
                raw = unpacked(packed)
                left, n_removed, _ = _kept(raw, columns["starts"][i], columns["counts"][i], length)
                if n_removed and not left:
                    continue
                text = left.decode("utf-8", "ignore")
                for c in DOCUMENT_COLUMNS:
                    out[c].append(columns[c][i] if c != "text" else None if packed is None else text)
                if n_removed:
                    out["n_chars"][-1] = len(text)
            return out

        return step

    schema = StructType([StructField("doc_id", LongType()), *(docs.schema[c] for c in DOCUMENT_COLUMNS[1:])])
    return map_batches(_with_spans(docs, length, *others), make, schema)


REPEATED_SQL = """
WITH docs AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
pieces AS (
  SELECT doc_id, base, substring(h, 2 * base + 1, 1198) AS p
  FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 99, 0), 500)) AS base FROM docs)),
starts AS (
  SELECT doc_id, base + j AS i, md5(substring(p, 2 * j + 1, 200)) AS string
  FROM (SELECT doc_id, base, p, unnest(range(0, least(500, len(p) // 2 - 99))) AS j FROM pieces)),
turns AS (SELECT doc_id, i, row_number() OVER (PARTITION BY string ORDER BY doc_id, i) AS turn FROM starts),
repeats AS (
  SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS apart FROM turns WHERE turn > 1),
islands AS (SELECT doc_id, i, sum(apart) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM repeats),
spans AS (SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM islands GROUP BY doc_id, island),
gaps AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS after FROM spans),
cut AS (
  SELECT g.doc_id, string_agg(substring(h, 2 * after + 1, 2 * (lo - after)), '' ORDER BY lo) || substring(any_value(h), 2 * max(hi) + 1) AS kept,
    sum(hi - lo) AS n_removed, count(*) AS n_spans
  FROM gaps g JOIN docs d ON g.doc_id = d.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM docs d LEFT JOIN cut c ON d.doc_id = c.doc_id
"""
