"""Vector compression by part codebooks over per-dimension value dictionaries.

Components become integers; a vector is cut into equal consecutive parts and each part is
replaced by the index of the nearest entry in its position's codebook. Distances are never
taken vector by vector: for each dimension of a block, the distinct integers form a dictionary,
the squared differences of each of them to all entries are tabulated once, and the distance of
a part is the sum of the rows gathered by its dictionary codes. Blocks are bounded, so the
dictionaries are as well; codebooks hold entries x dimensions integers whatever the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from rentscope.llm.common import pick, release_memory
from rentscope.plans.saved import save

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Integers stop here on both sides, so that squared distances of up to 511 dimensions fit 64 bits.
LARGEST = 2**26
#: Vectors of a block: as many dictionary codes at most per dimension.
BLOCK = 8_192
#: Labels whose sums are broadcast; with more they are joined by a shuffle.
MOST_BROADCAST = 100_000
#: A label's rows are spread over so many groups in that shuffle.
SALTS = 32


def finite(vector: str) -> Column:
    """Whether an array column is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def to_integers(flat: np.ndarray, dim: int, parts: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` by vector, part and position; the last part is filled with zeros where ``dim`` is no multiple of ``parts``."""
    width = -(-dim // parts)
    values = np.zeros((len(flat) // dim if dim else 0, parts * width), np.int64)
    values[:, :dim] = np.clip(np.floor(flat.astype(np.float64).reshape(-1, dim) * scale), -LARGEST, LARGEST)
    return values.reshape(len(values), parts, width)


def nearest_entries(values: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and its squared distance, by vector and part; ties go to the lower index.

    ``books`` is parts x entries x width. Per dimension the distances of the distinct values to
    all entries form a table; vectors gather their rows of it and add them up.
    """
    n, parts, width = values.shape
    nearest, error = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
    rows = np.arange(n)
    for part in range(parts):
        total = np.zeros((n, books.shape[1]), np.int64)
        for at in range(width):
            dictionary, codes = np.unique(values[:, part, at], return_inverse=True)
            table = (dictionary[:, None] - books[part, :, at]) ** 2
            total += table[codes]
        nearest[:, part] = total.argmin(axis=1)
        error[:, part] = total[rows, nearest[:, part]]
    return nearest, error


def _blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[pa.Table]:
    """Batches drawn together into blocks, as larger blocks share more dictionary values."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            piece = batch.slice(at, size)
            if n + piece.num_rows > size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
            held.append(piece)
            n += piece.num_rows
    if n:
        yield pa.Table.from_batches(held)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks] or [np.zeros(0)])


class Codebooks:
    """Entries by part, entry and position, and what is needed to apply them."""

    def __init__(self, entries: np.ndarray, dim: int, scale: int):
        self.entries, self.dim, self.scale = entries, dim, scale

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    def integers(self) -> list[int]:
        """All components by part, entry and position, without those that only fill the last part."""
        parts, _, width = self.entries.shape
        inside = np.arange(parts * width).reshape(parts, 1, width) < self.dim
        return self.entries[np.broadcast_to(inside, self.entries.shape)].tolist()

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.integers())).encode()).hexdigest()

    def decode(self, codes: bytes) -> list[float]:
        """The vector that a code stands for: the middle of each entry's integer cell."""
        found = self.entries[np.arange(self.parts), np.frombuffer(codes, np.uint8)]
        return ((found.reshape(-1)[: self.dim] + 0.5) / self.scale).tolist()


def _summed(fitting: DataFrame, books: Codebooks) -> DataFrame:
    """``part, entry, at, n, total``: each task's own sums, one row per component that its rows use."""
    entries, dim, scale = books.entries, books.dim, books.scale
    schema = StructType([StructField(c, LongType()) for c in ("part", "entry", "at", "n", "total")])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        counts, sums = np.zeros(entries.shape[:2], np.int64), np.zeros(entries.shape, np.int64)
        for block in _blocks(batches):
            values = to_integers(_flat(block.column("vector")), dim, len(entries), scale)
            nearest, _ = nearest_entries(values, entries)
            for part in range(len(entries)):
                counts[part] += np.bincount(nearest[:, part], minlength=entries.shape[1])
                np.add.at(sums[part], nearest[:, part], values[:, part])
        part, entry, at = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, entries.shape))
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (part, entry, at, counts[part, entry], sums[part, entry, at])], schema=arrow)

    return fitting.select("vector").mapInArrow(run, schema)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks from ``vec_id, vector``: a start from the smallest ids and ``rounds`` of assignment and means.

    All entries move to the componentwise ``floor`` of their parts' means; entries without parts stay. The
    driver sees ``entries`` starting vectors and the sums of entries x dimensions. The dimension is
    that of the first starting vector with components. None where there is no such vector.
    """
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    filled = vectors.filter(F.size("vector") > 0)
    start = [r.vector for r in filled.orderBy(*order).limit(entries).collect()]
    if not start:
        return None
    dim = len(start[0])
    if any(len(v) != dim for v in start):
        start = [r.vector for r in vectors.filter(F.size("vector") == dim).orderBy(*order).limit(entries).collect()]
    first = to_integers(np.array(start, np.float64).reshape(-1), dim, parts, scale)
    books = Codebooks(np.ascontiguousarray(first.transpose(1, 0, 2)), dim, scale)
    fitting = vectors.filter(F.size("vector") == dim)
    for _ in range(rounds):
        moved = books.entries.copy()
        totals = _summed(fitting, books).groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        for r in totals.collect():
            moved[r.part, r.entry, r.at] = r.total // r.n
        books = Codebooks(moved, dim, scale)
    return books


def encode(vectors: DataFrame, books: Codebooks | None, *keep: str) -> DataFrame:
    """``keep`` columns, ``codes`` (one byte a part, in order) and ``error``, the squared distances summed over parts.

    Vectors of another length than the codebooks' have null codes and error.
    """
    schema = StructType([*(vectors.schema[k] for k in keep), StructField("codes", BinaryType()), StructField("error", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for block in _blocks(batches):
            fits = block.column("vector").is_valid().to_numpy(zero_copy_only=False)
            codes, error = np.full(len(fits), None, object), np.zeros(len(fits), np.int64)
            if fits.any():
                nearest, distance = nearest_entries(to_integers(_flat(block.column("vector")), books.dim, books.parts, books.scale), books.entries)
                codes[fits] = [row.tobytes() for row in nearest.astype(np.uint8)]
                error[fits] = distance.sum(axis=1)
            kept = [block.column(k).combine_chunks() for k in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(codes, pa.binary()), pa.array(error, mask=~fits)], schema=arrow)

    if books is None:
        return vectors.select(*keep, F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error"))
    if books.entries.shape[1] > 256:
        raise ValueError("a code byte names at most 256 entries")
    fitting = F.when(F.size("vector") == books.dim, F.col("vector")).alias("vector")
    return vectors.select(*keep, fitting).mapInArrow(run, schema)


def _with_group_error(coded: DataFrame, most_broadcast: int) -> DataFrame:
    """Adds ``label_error``, the error summed over rows of equal label, nulls together.

    Sums are combined before they are shuffled. They are broadcast if their counted number allows
    it; else rows go by label and a salt, so that a label with very many rows is spread.
    """
    totals = save(coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")), "codes-labels")
    same = F.col("label").eqNullSafe(F.col("of"))
    if totals.count() <= most_broadcast:
        return coded.join(F.broadcast(totals), same).drop("of")
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = coded.withColumn("turn", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)).cast("int"))
    return spread.join(salted.hint("shuffle_hash"), same & (F.col("turn") == F.col("salt"))).drop("of", "turn", "salt")


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, most_broadcast: int = MOST_BROADCAST) -> tuple[DataFrame, Codebooks | None]:
    """Codes of all vectors of ``vec_id, embedding, label``, and the codebooks.

    Rows: ``vec_id, label, codes, error, label_error``. Rows whose vector is null or holds null or non-finite
    components are left out. Integers beyond 2^26 stop there. Vectors of another length than
    the first with components are kept with null codes and error. Null ids come after all others in the start; rows that share an id
    or repeat are rows of their own, with ties at the start going to the smaller vector. Fewer vectors than entries make smaller
    codebooks; an empty table gives no rows and no codebooks.
    """
    vectors = pick(embeddings, "vec_id", "embedding", "label").withColumn("vector", F.col("embedding").cast("array<double>")).drop("embedding")
    vectors = vectors.filter(finite("vector"))
    books = fit(vectors, parts, entries, rounds, scale)
    coded = save(encode(vectors, books, "vec_id", "label"), "codes")
    return _with_group_error(coded, most_broadcast), books


def codes_with_digests(embeddings: DataFrame, **settings: int) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: codes in lower-case hex, and one digest of all codebooks."""
    coded, books = compress(embeddings, **settings)
    digest = hashlib.sha256(b"").hexdigest() if books is None else books.digest()
    return coded.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _codes_sql() -> str:
    """SQL for the default settings: distances of all parts to all entries of their position."""
    assign: Callable[[int], str] = lambda r: f"""
distance{r} AS MATERIALIZED (
  SELECT rid, part, entry, CAST(sum((v - c) * (v - c)) AS BIGINT) AS d
  FROM cells JOIN book{r} USING (part, pos) GROUP BY rid, part, entry),
nearest{r} AS MATERIALIZED (
  SELECT rid, part, entry, d FROM distance{r} QUALIFY row_number() OVER (PARTITION BY rid, part ORDER BY d, entry) = 1)"""
    move: Callable[[int], str] = lambda r: f"""
means{r} AS (
  SELECT part, entry, pos, CAST(floor(sum(v)::DOUBLE / count(*)) AS BIGINT) AS c
  FROM cells JOIN nearest{r} USING (rid, part) GROUP BY part, entry, pos),
book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN means{r} m USING (part, entry, pos))"""
    steps = ",".join(assign(r) + "," + move(r) for r in range(ROUNDS))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid, vec_id, label, embedding
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
places AS (SELECT rid, embedding, unnest(range(len(embedding))) AS place, len(embedding) // {PARTS} AS width FROM kept),
cells AS MATERIALIZED (
  SELECT rid, place // width AS part, place % width AS pos, CAST(floor({SCALE} * embedding[place + 1]::DOUBLE) AS BIGINT) AS v FROM places),
book0 AS MATERIALIZED (SELECT part, rid AS entry, pos, v AS c FROM cells WHERE rid < {ENTRIES}),{steps},{assign(ROUNDS)},
codes AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM nearest{ROUNDS} GROUP BY rid),
books AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (rid), books
"""


CODES_SQL = _codes_sql()
