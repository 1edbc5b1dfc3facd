"""The prefix trie of conversations by truncation peeling.

A conversation is its sequence of turns, each a 128-bit digest of role and text. Equal
conversations are drawn together first, with a combine before the shuffle, and ordered by
their digests, so that all that share a prefix lie side by side. Blocks of that order are
peeled on their own, from the greatest depth down: what ended at a depth joins the nodes
that survived from below, equal prefixes become one node with its totals, the last turn
goes, and the next depth is grouped anew. Nodes that reach over a block's border stay open: only
its first and its last path go on, with what they hold so far, to a next round of far fewer
rows, until one block holds all borders. So no prefix, however common, is ever gathered, and rounds grow
with the logarithm of the input and not with the depth.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from rentscope.llm.common import pick, release_memory
from rentscope.llm.mixing import word_count
from rentscope.plans.saved import save

#: Bytes of a turn's digest.
TURN = 16
#: Paths and turns of a block; the last round takes that many paths in one task.
BLOCK_ROWS, BLOCK_TURNS = 2_048, 200_000
#: Turns of a partition that is ordered as a whole.
PARTITION_TURNS = 1_000_000
#: Ids of a piece of one node's list of ids.
PIECE_IDS = 4_096
#: Nodes closed after the first round that are broadcast to their children; more are joined by a salted shuffle.
MOST_BROADCAST, SALTS = 100_000, 32
#: What a path carries for each of its nodes: members, the smallest one, closed children, leaves and saved words below them.
MEMBERS, SMALLEST, CHILDREN, LEAVES, SAVED = range(5)
NOBODY = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256(b"").hexdigest()

FAMILY, MOST_HEAD = 20, 3
_PATHS = StructType([StructField("conv_id", LongType()), StructField("path", BinaryType()), StructField("words", BinaryType())])
_NODES = StructType([
    *(StructField(c, LongType()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
    StructField("ends_sha256", StringType()), StructField("node", BinaryType()), StructField("parent", BinaryType()),
])
_BORDER = StructType([
    StructField("path", BinaryType()), StructField("words", BinaryType()), StructField("carried", BinaryType()), StructField("ends", ArrayType(StringType())),
])
_PEELED = StructType([StructField("open", BooleanType()), *_NODES, *_BORDER])


def _turns(conversations: DataFrame) -> DataFrame:
    """One row per turn with a conversation: the digest of role and text, and the words of the text. No text goes further."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.unhex(F.md5(whole)).alias("digest"), word_count(text).alias("words"))


def conversation_paths(conversations: DataFrame, family: Column, head: Column) -> DataFrame:
    """``conv_id, path, words``: each conversation's turns in order, their digests and word counts one after the other.

    A conversation takes the first ``head`` turns (at most 3) of the one whose id is its ``family``, and its own
    beyond as many. Turns go by number, null first, then role, then digest. A family's turns are read in one stream, its
    own conversation first; one conversation's digests, 24 bytes a turn, are held at a time.
    """
    turns = _turns(conversations).withColumn("family", family).withColumn("head", head.cast("int"))
    order = ["family", F.col("conv_id") != F.col("family"), "conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    dealt = turns.repartition("family").sortWithinPartitions(*order).select("family", "conv_id", "head", "digest", "words")
    arrow = to_arrow_schema(_PATHS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        now, own, words, head, of = None, [], [], 0, None
        donor, donor_family = ([], []), None
        out: list[tuple] = []

        def rebuilt() -> tuple:
            first, first_words = donor if donor_family == of else ([], [])
            count = np.array(first_words[:head] + words[head:], np.int64)
            return now, b"".join(first[:head] + own[head:]), count.tobytes()

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for family_id, conv_id, h, digest, n in zip(*columns, strict=True):
                if conv_id != now:
                    if now is not None:
                        out.append(rebuilt())
                    now, own, words, head, of = conv_id, [], [], h, family_id
                if conv_id == family_id and len(own) < MOST_HEAD:
                    if donor_family != family_id:
                        donor, donor_family = ([], []), family_id
                    donor[0].append(digest)
                    donor[1].append(n)
                own.append(digest)
                words.append(n)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)], schema=arrow)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(rebuilt(), arrow.types, strict=True)], schema=arrow)

    return dealt.mapInArrow(run, _PATHS)


def id_list_digests(rows: DataFrame, piece_ids: int = PIECE_IDS) -> DataFrame:
    """``key, ends``: SHA-256 of each key's ids in numeric order, as decimals joined by commas.

    Rows ``key, conv_id`` are ordered over all partitions, so a key with very many ids lies in several.
    Keys inside one partition are done there; those at its borders go on as pieces of joined ids, which
    one task per key hashes in order as they come, without holding them.
    """
    schema = StructType([StructField("key", BinaryType()), StructField("first", LongType()), StructField("piece", StringType()), StructField("ends", StringType())])
    arrow = to_arrow_schema(schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        key, ids, state, inside = None, [], None, False

        def done() -> tuple:
            state.update(",".join(ids).encode())
            return key, None, None, state.hexdigest()

        def piece() -> tuple:
            return key, int(ids[0]), ",".join(ids), None

        for batch in batches:
            out = []
            for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        if inside and state is not None:
                            # A key that began here and has ended here.
                            out.append(done())
                        elif ids:
                            out.append(piece())
                        inside = True
                    key, ids, state = k, [], hashlib.sha256()
                ids.append(str(i))
                if len(ids) == piece_ids:
                    # Too many to keep: from here on the key goes in pieces.
                    out.append(piece())
                    ids, state = [], None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)], schema=arrow)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(piece(), arrow.types, strict=True)], schema=arrow)

    digests = StructType([StructField("key", BinaryType()), StructField("ends", StringType())])
    digests_arrow = to_arrow_schema(digests)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), digests_arrow.types, strict=True)], schema=digests_arrow)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], schema=digests_arrow)

    joined = save(rows.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(join, schema), "trie-ids")
    pieces = joined.filter("piece IS NOT NULL").repartition("key").sortWithinPartitions("key", "first").select("key", "piece")
    return joined.filter("piece IS NULL").select("key", "ends").unionByName(pieces.mapInArrow(finish, digests))


@dataclass
class Path:
    """A path with what it carries for each node from the root to its end, without what its own next node holds."""

    path: bytes
    words: np.ndarray
    carried: np.ndarray
    ends: dict[int, str] = field(default_factory=dict)
    carries: bool = False

    @property
    def depth(self) -> int:
        return len(self.path) // TURN

    @classmethod
    def ended(cls, path: bytes, words: bytes, n: int, conv_id: int, ends: str) -> Path:
        depth = len(path) // TURN
        carried = np.zeros((5, depth + 1), np.int64)
        carried[SMALLEST] = NOBODY
        carried[MEMBERS, depth], carried[SMALLEST, depth] = n, conv_id
        return cls(path, np.frombuffer(words, np.int64), carried, {depth: ends})

    @classmethod
    def stored(cls, path: bytes, words: bytes, carried: bytes, ends: list) -> Path:
        depth = len(path) // TURN
        return cls(path, np.frombuffer(words, np.int64), np.frombuffer(carried, np.int64).reshape(5, depth + 1), {k: e for k, e in enumerate(ends) if e}, True)

    def node(self, depth: int) -> bytes:
        return hashlib.md5(self.path[: depth * TURN], usedforsecurity=False).digest()


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common."""
    n = min(len(a), len(b)) // TURN
    if a[: n * TURN] == b[: n * TURN]:
        return n
    differ = np.frombuffer(a, np.uint64, 2 * n) != np.frombuffer(b, np.uint64, 2 * n)
    return int(differ.argmax()) // 2


def peel(paths: list[Path], last: bool, named: bool = True) -> tuple[dict[str, list], list[Path]]:
    """Closed nodes of a block of ordered paths, and its open paths: none in the last round, else the first and the last one.

    A level has one entry per node, at the first row that runs through it. Values: the five that paths carry.
    ``named`` gives each node its digest, by which nodes closed in earlier rounds find their parents.
    """
    depths = np.array([p.depth for p in paths])
    stored = np.array([p.carries for p in paths])
    shared = np.array([-1] + [_shared(a.path, b.path) for a, b in zip(paths, paths[1:], strict=False)])
    borders = [] if last else [0] if len(paths) == 1 else [0, len(paths) - 1]
    open_paths = [Path(paths[r].path, paths[r].words, np.zeros_like(paths[r].carried)) for r in borders]
    for p in open_paths:
        p.carried[SMALLEST] = NOBODY
    out: dict[str, list] = {c: [] for c in _NODES.names}
    by_depth = np.argsort(-depths, kind="stable")
    reached = 0
    active = np.zeros(0, np.int64)
    below = (np.zeros(0, np.int64), np.zeros((5, 0), np.int64), np.zeros(0, bool))
    waiting: list[tuple[int, int]] = []
    for depth in range(int(depths.max()), -1, -1):
        ended = reached
        while reached < len(by_depth) and depths[by_depth[reached]] >= depth:
            reached += 1
        new = by_depth[ended:reached]
        # Rows with something of their own at this depth: what ends here, and stored paths at each of their depths.
        active = np.concatenate([active, new[stored[new]]])
        own = np.unique(np.concatenate([new, active]))
        own_values = np.array([paths[r].carried[:, depth] for r in own], np.int64).reshape(-1, 5).T
        reps, values, is_open = below
        closed = ~is_open
        # The last turn goes: closed nodes give their totals to the node above, open ones only keep their place.
        given = values.copy()
        given[CHILDREN] = 1
        given[:, is_open] = 0
        given[SMALLEST, is_open] = NOBODY
        rows = np.concatenate([reps, own])
        all_values = np.concatenate([given, own_values], axis=1)
        order = np.argsort(rows, kind="stable")
        rows, all_values = rows[order], all_values[:, order]
        # Rows that begin a node, by the turns they share with the row before; others belong to the last beginning.
        begins = np.unique(rows[shared[rows] < depth])
        at = np.searchsorted(begins, rows, side="right") - 1
        merged = np.zeros((5, len(begins)), np.int64)
        merged[SMALLEST] = NOBODY
        for v in (MEMBERS, CHILDREN, LEAVES, SAVED):
            np.add.at(merged[v], at, all_values[v])
        np.minimum.at(merged[SMALLEST], at, all_values[SMALLEST])
        ends = {int(a): paths[r].ends[depth] for r, a in zip(own.tolist(), (np.searchsorted(begins, own, side="right") - 1).tolist(), strict=True) if depth in paths[r].ends}
        now_open = np.zeros(len(begins), bool)
        for p, r in zip(open_paths, borders, strict=True):
            if p.depth >= depth:
                a = int(np.searchsorted(begins, r, side="right")) - 1
                if not now_open[a]:
                    now_open[a] = True
                    p.carried[:, depth] = merged[:, a]
                    if a in ends:
                        p.ends[depth] = ends[a]
        # The nodes one level down learn who their parents are.
        above = np.searchsorted(begins, reps[closed], side="right") - 1
        for (i, rep), a in zip(waiting, above.tolist(), strict=True):
            if now_open[a]:
                out["parent"][i] = paths[rep].node(depth)
            else:
                out["parent_conv_id"][i] = int(merged[SMALLEST, a])
        waiting = []
        totals = merged.copy()
        words = np.array([paths[r].words[depth - 1] if depth else 0 for r in begins.tolist()], np.int64)
        totals[LEAVES] = np.where(merged[CHILDREN] == 0, 1, merged[LEAVES])
        totals[SAVED] += np.where(merged[MEMBERS] > 0, merged[MEMBERS] - 1, 0) * words
        for a in np.flatnonzero(~now_open).tolist():
            rep = int(begins[a])
            waiting.append((len(out["depth"]), rep))
            out["conv_id"].append(int(merged[SMALLEST, a]))
            out["depth"].append(depth)
            out["parent_conv_id"].append(None)
            out["n_convs"].append(int(merged[MEMBERS, a]))
            out["n_children"].append(int(merged[CHILDREN, a]))
            out["n_leaves"].append(int(totals[LEAVES, a]))
            out["saved_tokens"].append(int(totals[SAVED, a]))
            out["ends_sha256"].append(ends.get(a, NO_ENDS))
            out["node"].append(rep)
            out["parent"].append(None)
        below = (begins, totals, now_open)
    out["node"] = [paths[r].node(d) if named else None for r, d in zip(out["node"], out["depth"], strict=True)]
    return out, open_paths



def _peeled(ordered: DataFrame, first: bool, last: bool, block_rows: int) -> DataFrame:
    """Peels ordered paths block by block: closed nodes, and open paths where ``open``."""
    arrow = to_arrow_schema(_PEELED)
    make = Path.ended if first else Path.stored

    def block(paths: list[Path]) -> pa.RecordBatch:
        nodes, border = peel(paths, last, not first)
        n, m = len(nodes["depth"]), len(border)
        columns = {"open": [False] * n + [True] * m} | {c: v + [None] * m for c, v in nodes.items()}
        columns |= {
            "path": [None] * n + [p.path for p in border],
            "words": [None] * n + [p.words.tobytes() for p in border],
            "carried": [None] * n + [p.carried.tobytes() for p in border],
            "ends": [None] * n + [[p.ends.get(k) for k in range(p.depth + 1)] for p in border],
        }
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        held: list[Path] = []
        turns = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                held.append(make(*row))
                turns += held[-1].depth
                if not last and (len(held) == block_rows or turns >= BLOCK_TURNS and len(held) >= 64):
                    yield block(held)
                    held, turns = [], 0
        if held:
            yield block(held)

    return ordered.mapInArrow(run, _PEELED)


def _with_parents(nodes: DataFrame, most_broadcast: int) -> DataFrame:
    """Gives nodes that closed before their parent its smallest member; the parents are nodes of later rounds."""
    names = [c for c in _NODES.names if c not in ("node", "parent")]
    parents = nodes.filter("node IS NOT NULL").select(F.col("node").alias("of"), F.col("conv_id").alias("found"))
    ready, waits = nodes.filter("parent IS NULL").select(*names), nodes.filter("parent IS NOT NULL")
    if parents.count() <= most_broadcast:
        joined = waits.join(F.broadcast(parents), F.col("parent") == F.col("of"))
    else:
        # A common prefix is the parent of very many nodes: each parent goes to all salts, each child to one.
        salted = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = waits.withColumn("turn", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
        joined = spread.join(salted.hint("shuffle_hash"), (F.col("parent") == F.col("of")) & (F.col("turn") == F.col("salt")))
    return ready.unionByName(joined.withColumn("parent_conv_id", F.col("found")).select(*names))


def trie_of_paths(paths: DataFrame, block_rows: int = BLOCK_ROWS, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The nodes of the trie over stored ``conv_id, path, words``, one conversation a row; see ``conversation_trie``."""
    spark = paths.sparkSession
    keyed = paths.select(F.unhex(F.md5("path")).alias("key"), "conv_id", "path", "words")
    distinct = keyed.groupBy("key").agg(F.first("path").alias("path"), F.first("words").alias("words"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("smallest"))
    rows = save(distinct.join(id_list_digests(keyed), "key").select("path", "words", "n", "smallest", "ends"), "trie-paths")
    nodes: DataFrame | None = None
    n_rows, n_turns = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("path")), F.lit(0)) / TURN).first()
    first = True
    while nodes is None or n_rows:
        last = n_rows <= block_rows
        if last:
            ordered = rows.coalesce(1).sortWithinPartitions("path")
        else:
            parts = max(math.ceil(n_turns / PARTITION_TURNS), math.ceil(n_rows / block_rows), spark.sparkContext.defaultParallelism if first else 1)
            ordered = rows.repartitionByRange(parts, "path").sortWithinPartitions("path")
        peeled = save(_peeled(ordered, first, last, block_rows), "trie-peeled")
        closed = peeled.filter("NOT open").select(*_NODES.names)
        nodes = closed if nodes is None else nodes.unionByName(closed)
        rows = peeled.filter("open").select(*_BORDER.names)
        n_rows, n_turns = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("path")), F.lit(0)) / TURN).first()
        first = False
    return _with_parents(nodes, most_broadcast)


def conversation_trie(conversations: DataFrame, shared_heads: bool = False, block_rows: int = BLOCK_ROWS, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The prefix trie of ``conv_id, turn, role, text``.

    One row per distinct sequence of first turns, the empty one included: ``conv_id`` (smallest member),
    ``depth, parent_conv_id, n_convs, n_children, n_leaves`` (childless nodes at or below), ``saved_tokens`` (words of
    the last turns at or below that members repeat) and ``ends_sha256`` (of the ids of members that end here).
    With ``shared_heads``, conversation c starts with the first crc32(c) % 4 turns of c - c % 20 instead of its own.

    Turns of one number go by role and digest; repeated rows are turns of their own. Null roles and texts
    are empty. Rows without a conversation id belong to none and are left out. No conversation, no node, not
    even the root. A conversation's turns (24 bytes each) are held at one time, nothing else grows with the input.
    """
    conv_id = F.col("conv_id")
    family = conv_id - conv_id % FAMILY if shared_heads else conv_id
    head = F.crc32(conv_id.cast("string")) % (MOST_HEAD + 1) if shared_heads else F.lit(0)
    return trie_of_paths(save(conversation_paths(conversations, family, head), "trie-conversations"), block_rows, most_broadcast)


TRIE_SQL = r"""
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT c, xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
      lambda crc, b: list_reduce(list_transform(range(8), lambda i: i::BIGINT), lambda v, i: xor(v >> 1, (v & 1) * 3988292384), xor(crc, b)),
      4294967295), 4294967295) % 4 AS h
  FROM ids),
ordered AS (
  SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS turn_value,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT c, pos, turn_value FROM heads JOIN ordered ON conv_id = c - c % 20 AND pos <= h
  UNION ALL
  SELECT c, pos, turn_value FROM heads JOIN ordered ON conv_id = c AND pos > h),
paths AS MATERIALIZED (
  SELECT c, row_number() OVER w AS depth, list(turn_value) OVER w AS path FROM rebuilt
  WINDOW w AS (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT c, 0, [] FROM ids),
lengths AS (SELECT c, max(depth) AS length FROM paths GROUP BY c),
nodes AS MATERIALIZED (
  SELECT row_number() OVER () AS node, * FROM (
    SELECT depth, path, min(c) AS conv_id, count(*) AS n_convs,
      sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = length), '')) AS ends_sha256
    FROM paths JOIN lengths USING (c) GROUP BY depth, path)),
parents AS MATERIALIZED (
  SELECT n.node, n.depth, n.conv_id, n.n_convs, n.ends_sha256, p.node AS parent, p.conv_id AS parent_conv_id,
    (n.n_convs - 1) * coalesce(len(regexp_extract_all(n.path[n.depth].t, '[^ 	-
]+')), 0) AS saved
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1]),
children AS (SELECT parent, count(*) AS n FROM parents GROUP BY parent),
subtree AS (
  WITH RECURSIVE up AS (
    SELECT p.node, p.parent AS next, p.node AS top, p.saved, c.n IS NULL AS leaf FROM parents p LEFT JOIN children c ON c.parent = p.node
    UNION ALL
    SELECT up.node, p.parent, p.node, up.saved, up.leaf FROM up JOIN parents p ON p.node = up.next)
  SELECT top, sum(saved) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM up GROUP BY top)
SELECT conv_id, CAST(p.depth AS BIGINT) AS depth, parent_conv_id, n_convs, coalesce(c.n, 0) AS n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM parents p JOIN subtree ON top = p.node LEFT JOIN children c ON c.parent = p.node
"""
