"""What several operators share: column choice, Arrow batches, held-out folds and bounded caches."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

_worker: dict[str, object] = {}


def worker_state(mark: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps over tasks: one thing at a time, so that a later operator's replaces it."""
    if _worker.get("mark") != mark:
        _worker.clear()
        _worker.update(mark=mark, value=make())
    _worker["used"] = True
    return _worker["value"]


def forget_state() -> None:
    """What the worker kept goes: for what costs less to make again than to hold in workers that wait."""
    _worker.clear()


def release_memory() -> None:
    """Give back what the last task of this worker has freed: workers live long and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _begun(make: Callable[[], Callable]) -> Callable:
    """A task's function; what the worker kept for another operator goes."""
    release_memory()
    _worker["used"] = False
    step = make()
    if not _worker["used"]:
        _worker.clear()
    return step


#: Rows of an Arrow batch of texts, where the session has Spark's default, which suits narrow rows.
BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 10_000, 2_000


def smaller_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold fewer rows unless the session says how many: a batch of texts lies in memory several times."""
    if int(spark.conf.get(BATCH_SETTING)) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


#: Columns of ``documents``; operators pick the ones they read first, so that further columns cannot clash.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name even where others differ in case only."""
    return df.toDF(*[c if c in names else f"_other_{i}" for i, c in enumerate(df.columns)]).select(*names)


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is fold -1 and so never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(-1))


def as_text(value: str | None) -> str:
    return "" if value is None else value


#: Rows of a batch that are Python objects at one time, and bytes from which their memory is given back at once.
ROWS, LARGE_PART = 2_000, 1_000_000


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: StructType, rows: int = ROWS
) -> DataFrame:
    """Run Arrow batches through a function of lists.

    ``make`` is called once per task and returns the function: columns as lists in, columns
    as lists (or numpy arrays) out. Batches are bounded by Spark in rows and bytes, and go
    through the function in parts of ``rows``. Where it has an attribute ``end``, this is called after a task's last batch.
    """
    smaller_batches(df.sparkSession)
    arrow = to_arrow_schema(schema)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = _begun(make)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = step({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[n], arrow.field(n).type) for n in names], names=names)
                if part.nbytes > LARGE_PART:
                    del out
                    release_memory()
        # Workers wait in turn for their next task: what only saves work within one is not kept by all of them.
        if hasattr(step, "end"):
            step.end()
        step = part = out = None
        release_memory()

    return df.mapInArrow(run, schema)


def compressed(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, the columns to keep and the text as compressed bytes (``packed``), for shuffles of texts; null stays null."""
    schema = StructType([docs.schema["doc_id"], *(docs.schema[k] for k in keep), StructField("packed", BinaryType())])

    def make() -> Callable:
        pack = zstandard.ZstdCompressor(3)

        def step(columns: dict[str, list]) -> dict[str, list]:
            packed = [None if t is None else pack.compress(t.encode("utf-8")) for t in columns["text"]]
            return {k: columns[k] for k in ("doc_id", *keep)} | {"packed": packed}

        return step

    return map_batches(docs.select("doc_id", "text", *keep), make, schema)


def unpacked(packed: bytes | None) -> bytes:
    return b"" if packed is None else zstandard.decompress(packed)


def most_frequent(counted: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of highest count ``n``, at most ``most`` of them, without ordering all rows.

    Rows go by classes of counts, an eighth of a power of two wide; the highest classes that fit
    together stay. Only the class sizes are looked at, so no task or driver holds more than it asked for.
    """
    level = F.floor(F.log2(F.col(n).cast("double")) * 8)
    sizes = sorted(((r.level, r["count"]) for r in counted.groupBy(level.alias("level")).count().collect()), reverse=True)
    total, lowest = 0, None
    for at, size in sizes:
        total += size
        if total > most:
            break
        lowest = at
    return counted.filter(F.lit(False) if lowest is None else level >= lowest)


class BoundedCache(dict):
    """A dict of at most ``most`` entries with a second one behind it.

    Once full it becomes the one behind and starts anew; what is still asked for comes back from
    there. It only ever saves work.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most = most
        self.behind: dict = {}

    def missing(self, keys: set) -> tuple[dict, list]:
        """Values found behind, and the keys that are nowhere."""
        behind = self.behind
        found = {k: behind[k] for k in keys if k in behind}
        return found, [k for k in keys if k not in found]

    def keep(self, values: dict) -> None:
        if len(self) + len(values) > self.most:
            self.behind = dict(self)
            self.clear()
        self.update(values)


class PartTable:
    """Ids of parts of texts that have come before: an Arrow column of parts and one array of their 32-bit ids.

    It takes a tenth of what a dict of them would. A table beyond ``rows`` or ``nbytes`` starts anew with the parts
    last asked for, without those above ``longest`` bytes. It only ever saves work.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], rows: int, nbytes: int, longest: int):
        self.encode, self.rows, self.nbytes, self.longest = encode, rows, nbytes, longest
        self.clear()

    def clear(self) -> None:
        self.known, self.sizes, self.held = pa.array([], pa.large_string()), np.zeros(0, np.int32), np.zeros(0, "<u4")

    def _places(self, parts: pa.Array) -> np.ndarray:
        """Each part's place in the table, which new ones join."""
        found = pc.index_in(parts, value_set=self.known)
        places = found.fill_null(-1).to_numpy()
        if found.null_count:
            missing = parts.filter(found.is_null())
            new = missing.unique()
            values = self.encode(new.to_pylist())
            places = places.copy()
            places[places < 0] = len(self.known) + pc.index_in(missing, value_set=new).to_numpy()
            self.known = pa.concat_arrays([self.known, new])
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, values), np.int32, len(values)) // 4])
            self.held = np.concatenate([self.held, np.frombuffer(b"".join(values), "<u4")])
        return places

    def _forget(self, used: np.ndarray) -> None:
        if len(self.known) <= self.rows and self.known.nbytes + self.held.nbytes <= self.nbytes:
            return
        keep = np.unique(used)
        keep = keep[pc.binary_length(self.known).to_numpy()[keep] <= self.longest][: self.rows]
        ends = np.cumsum(self.sizes)
        self.held = np.concatenate([np.zeros(0, "<u4"), *(self.held[e - n : e] for e, n in zip(ends[keep].tolist(), self.sizes[keep].tolist(), strict=True))])
        self.known, self.sizes = self.known.take(pa.array(keep)), self.sizes[keep]

    def ids(self, parts: pa.Array, bounds: np.ndarray) -> list[bytes]:
        """Ids of texts, as little-endian 32-bit bytes: text i has the parts from ``bounds[i]`` to ``bounds[i + 1]``."""
        places = self._places(parts)
        # Each part's ids lie in one array; texts gather them from there.
        begins, taken = np.cumsum(self.sizes) - self.sizes, self.sizes[places]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(taken)])
        flat = self.held[np.repeat(begins[places] - ends[:-1], taken) + np.arange(ends[-1])]
        out = [flat[a:b].tobytes() for a, b in itertools.pairwise(ends[bounds].tolist())]
        self._forget(places)
        return out
