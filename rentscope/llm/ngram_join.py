"""Similarity join of documents on sets of word n-grams, by prefix trees.

Sets are n-gram hashes. Equal sets become one class first. Classes that may be similar are
found by pigeonhole: two sets of Jaccard similarity t differ in at most (1-t)/(1+t) of their
sizes' sum, so if hashes are dealt to more buckets than that, some buckets are the same in both.
N-grams that very many documents have are left out of the buckets, as two sets without them
differ in no more places; only sets that have little else are dealt with them as well. A set
that shares fewer bucket digests than similar sets must have in common is no candidate. The
candidates that digests connect form clusters.

Within clusters, sets are ordered by how rare their n-grams are and stored in a prefix tree.
Each set walks the tree with all others at once: overlaps on a shared path are counted once,
and a subtree is left as soon as the lengths that remain cannot reach the similarity, or all
it holds is connected with the set already. Large clusters are split into parts, and each
pair of parts is a task of its own.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from rentscope.llm.common import DOCUMENT_COLUMNS, as_text, compressed, map_batches, most_frequent, pick, release_memory, unpacked
from rentscope.llm.graph import components
from rentscope.plans.saved import save

#: What near-duplicate work takes unless told otherwise: words of an n-gram, and similarity in per cent.
WORDS, PERCENT = 5, 80
#: Shingles in a block of sets that are joined in one task.
BLOCK_SHINGLES = 400_000
#: N-grams left out of the buckets at most, and how many documents must have one for that.
MOST_FREQUENT, FREQUENT_DOCUMENTS = 500_000, 50
#: Sizes of one class of the pigeonhole differ by this factor at most.
CLASS_RATIO = 1.5
#: Tokens on an edge of the prefix tree at most, elements looked up at once, cells of the membership table, and
#: pairs of a set that asks and a stored one: they bound a task's memory.
EDGE, LOOKUPS, CELLS, PAIRS = 32, 1_000_000, 8_000_000, 400_000

_rng = np.random.default_rng(606)
_FACTORS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT, _ONE, _TWO, _SPARSE, _ALL = (_FACTORS[-i] for i in range(1, 6))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct word n-grams; a text of fewer words is one n-gram, an empty one has none.

    Only A-Z fold to lower case, and only space, tab, line feed, vertical tab, form feed and return separate.
    """
    found = as_text(text).encode("utf-8").lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    if not len(hashes):
        return hashes
    if len(hashes) < words:
        return _mixed(np.add.reduce(np.r_[hashes * _FACTORS[: len(hashes)], np.array([len(hashes)], np.uint64) * _SHORT], keepdims=True))
    total = hashes[: len(hashes) - words + 1] * _FACTORS[0]
    for i in range(1, words):
        total = total + hashes[i : len(hashes) - words + 1 + i] * _FACTORS[i]
    return np.unique(_mixed(total))


def digests(found: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set."""
    return tuple(int(_mixed(found * f).sum(dtype=np.uint64).astype(np.int64)) if len(found) else 0 for f in (_ONE, _TWO))


def _bounds() -> list[int]:
    """First sizes of the size classes."""
    bounds = [1]
    while bounds[-1] < 2**40:
        bounds.append(max(bounds[-1] + 1, int(np.ceil(bounds[-1] * CLASS_RATIO))))
    return bounds


_BOUNDS = _bounds()


def _buckets(size_class: int, percent: int) -> tuple[int, int]:
    """The most places in which similar sets of a class differ, and the buckets to deal to.

    The buckets beyond the difference make up for empty ones: as many as sets at the lower end of
    the class leave empty on average, twice over, if a quarter of their n-grams is left out.
    """
    largest = _BOUNDS[size_class + 1] - 1
    difference = 2 * largest * (100 - percent) // (100 + percent)
    empty = np.exp(-0.75 * (100 + percent) / (2 * (100 - percent) * CLASS_RATIO))
    return difference, difference + 3 + int(np.ceil(difference * 2 * empty / max(0.2, 1 - 2 * empty)))


def _dealt(found: np.ndarray, size_class: int, buckets: int, salt: np.uint64) -> np.ndarray:
    """Digests of the buckets that are not empty."""
    if not len(found):
        return found
    bucket = ((found >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sums = np.add.reduceat(_mixed(found * _ONE), starts)
    return _mixed(sums + _mixed(bucket[starts] + np.uint64(size_class << 40)) * salt)


def class_digests(found: np.ndarray, percent: int, frequent: np.ndarray) -> list[tuple[int, np.ndarray, int]]:
    """Per size class: digests under which any set at least ``percent`` similar meets this one, and how many at least.

    A pair meets in the size class of its larger set, so a set goes to the classes of all sizes up
    to that of the largest similar set. Two similar sets have all buckets in common but as many as they differ in
    places, so a set meets each similar one under as many digests as there are buckets beyond that
    difference, less its empty ones. If the n-grams that are not frequent leave too many buckets
    empty for that, the set is dealt with all its n-grams as well, and, should that leave too many
    empty, meets under one more digest of its class; then one common digest is enough.
    """
    n = len(found)
    if not n:
        return []
    place = np.searchsorted(frequent, found)
    rare = found[(place == len(frequent)) | (frequent[np.minimum(place, len(frequent) - 1)] != found)] if len(frequent) else found
    out = []
    for size_class in range(bisect_right(_BOUNDS, n) - 1, bisect_right(_BOUNDS, 100 * n // percent)):
        difference, buckets = _buckets(size_class, percent)
        if not difference:
            continue  # only equal sets are similar enough
        dealt = [_dealt(rare, size_class, buckets, _TWO)]
        common = len(dealt[0]) - difference
        if common < 1:
            dealt.append(_dealt(found, size_class, buckets, _ALL))
            if len(dealt[1]) - difference < 1:
                dealt.append(_mixed(np.array([size_class], np.uint64) * _SPARSE))
        out.append((size_class, np.concatenate(dealt), max(1, common)))
    return out


#: Documents whose sets are made at once; the nodes of their digests take 16 bits.
_TOGETHER = 4_000
_LOW = np.uint64(0xFFFFFFFF)


def _pack(digest: np.ndarray, node: np.ndarray) -> bytes:
    """Digests as 48 bits and nodes as places in a list of them; a digest cut short can only add candidates."""
    nodes, place = np.unique(node, return_inverse=True)
    sizes = np.array([len(nodes), len(digest)], np.int64)
    cut = ((digest & _LOW).astype(np.uint32), ((digest >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16), place.astype(np.uint16))
    return b"".join(x.tobytes() for x in (sizes, nodes, *cut))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n_nodes, n = np.frombuffer(blob, np.int64, 2)
    at = 16 + 8 * n_nodes
    nodes = np.frombuffer(blob, np.int64, n_nodes, 16)
    low, high = np.frombuffer(blob, np.uint32, n, at), np.frombuffer(blob, np.uint16, n, at + 4 * n)
    return low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)), nodes[np.frombuffer(blob, np.uint16, n, at + 6 * n)]


def _meetings(digest: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a digest and a node, of digests that several nodes have."""
    order = np.lexsort((node, digest))
    digest, node = digest[order], node[order]
    new = np.r_[True, (digest[1:] != digest[:-1]) | (node[1:] != node[:-1])][: len(node)]
    digest, node = digest[new], node[new]
    like_next = np.r_[digest[1:] == digest[:-1], False][: len(digest)]
    several = like_next | np.r_[False, like_next[:-1]][: len(digest)]
    return digest[several], node[several]


def _candidates(docs: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """``one, cluster``: digests of sets that may be similar to another, with clusters that hold all similar ones.

    A node is a set in a size class. Nodes that share fewer digests than any similar set would
    share with them are dropped before digests connect the rest, so a common passage does not.
    """
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    sent = StructType([StructField("part", IntegerType()), StructField("met", BinaryType()), StructField("nodes", BinaryType())])

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            digest, node, known = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros((3, 0), np.int64)]
            for text in columns["text"]:
                found = shingles(text, words)
                one = digests(found)[0]
                for size_class, dealt, common in class_digests(found, percent, shared.value):
                    name = _mixed(np.array([one], np.int64).view(np.uint64) + np.uint64(size_class)).view(np.int64)
                    digest.append(dealt)
                    node.append(np.repeat(name, len(dealt)))
                    known.append(np.array([[name[0]], [one], [common]], np.int64))
            digest, node, known = np.concatenate(digest), np.concatenate(node), np.unique(np.concatenate(known, axis=1), axis=1) if len(known) > 1 else known[0]
            part, node_part = digest % np.uint64(n_parts), known[0].view(np.uint64) % np.uint64(n_parts)
            order, node_order = np.argsort(part, kind="stable"), np.argsort(node_part, kind="stable")
            parts = np.arange(n_parts + 1)
            at, node_at = np.searchsorted(part[order], parts), np.searchsorted(node_part[node_order], parts)
            digest, node, known = digest[order] // np.uint64(n_parts), node[order], known[:, node_order]
            full = [p for p in range(n_parts) if at[p] < at[p + 1] or node_at[p] < node_at[p + 1]]
            return {
                "part": full,
                "met": [_pack(digest[at[p] : at[p + 1]], node[at[p] : at[p + 1]]) for p in full],
                "nodes": [known[:, node_at[p] : node_at[p + 1]].tobytes() for p in full],
            }

        return step

    def meet(table: pa.Table) -> pa.Table:
        release_memory()
        found = [_unpack(m) for m in table.column("met").to_pylist()]
        known = np.concatenate([np.frombuffer(x, np.int64).reshape(3, -1) for x in table.column("nodes").to_pylist()], axis=1)
        digest, node = _meetings(np.concatenate([d for d, _ in found]), np.concatenate([x for _, x in found]))
        digest = digest * np.uint64(n_parts) + np.uint64(table.column("part")[0].as_py())
        nothing = np.zeros(len(node), np.int64)
        is_node = np.r_[np.zeros(len(node), bool), np.ones(known.shape[1], bool)]
        return pa.table({
            "digest": pa.array(np.concatenate([digest.view(np.int64), known[0]]), pa.int64(), mask=is_node),
            "node": np.concatenate([node, known[0]]),
            "one": pa.array(np.concatenate([nothing, known[1]]), pa.int64(), mask=~is_node),
            "common": pa.array(np.concatenate([nothing, known[2]]), pa.int64(), mask=~is_node),
        })

    schema = StructType([StructField(n, LongType()) for n in ("digest", "node", "one", "common")])
    rows = save(map_batches(docs.select("text"), make, sent, _TOGETHER).groupBy("part").applyInArrow(meet, schema), "meetings")
    met = rows.filter("digest IS NOT NULL").select("digest", "node")
    nodes = rows.filter("digest IS NULL").groupBy("node").agg(F.min("one").alias("one"), F.min("common").alias("common"))
    enough = met.groupBy("node").agg(F.count("*").alias("n")).join(nodes, "node").filter("n >= common").select("node", "one")
    enough = save(enough, "candidates")
    left = save(met.join(enough.select("node"), "node"), "meetings")
    hubs = left.groupBy("digest").agg(F.min("node").alias("a"), F.max("node").alias("last")).filter("a < last").drop("last")
    edges = left.join(hubs, "digest").filter("node != a").select("a", F.col("node").alias("b"))
    clusters = components(edges).withColumnRenamed("component", "cluster")
    return clusters.join(enough, "node").select("one", "cluster").distinct()


def _frequent(sets: DataFrame) -> np.ndarray:
    """Sorted hashes of the most frequent n-grams, from what each batch of the first pass has counted."""
    several = sets.filter("often IS NOT NULL").select("often")
    schema = StructType([StructField("found", LongType()), StructField("n", LongType())])

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            both = np.concatenate([np.frombuffer(x, np.int64).reshape(2, -1) for x in columns["often"]], axis=1)
            return {"found": both[0], "n": both[1]}

        return step

    counted = map_batches(several, make, schema).groupBy("found").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT_DOCUMENTS)
    rows = most_frequent(save(counted, "frequent"), "n", MOST_FREQUENT).select("found").toPandas()
    return np.sort(rows["found"].to_numpy(np.int64).view(np.uint64))


def _often(sets: list[np.ndarray]) -> bytes | None:
    """N-grams that several sets of a batch have, and in how many."""
    found, n = np.unique(np.concatenate(sets), return_counts=True)
    several = n > 2
    return np.stack([found[several].view(np.int64), n[several]]).tobytes() if several.any() else None


class PrefixTree:
    """Sets over ranked tokens in a prefix tree whose edges hold up to EDGE tokens.

    Sequences come sorted by group and tokens; each group has a root. A node stands for the
    documents ``first .. end - 1``. ``best`` is the most that any of them can still offer:
    (100 + percent) * length - percent * size.
    """

    def __init__(self, groups: np.ndarray, sequences: list[np.ndarray], sizes: np.ndarray, percent: int):
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.first: list[int] = []
        self.end: list[int] = []
        self.last_node = np.zeros(len(sequences), np.int64)
        path: list[int] = []
        for i, sequence in enumerate(sequences):
            common = 0
            if i and groups[i] == groups[i - 1]:
                before = sequences[i - 1]
                n = min(len(before), len(sequence))
                differ = np.flatnonzero(before[:n] != sequence[:n])
                common = int(differ[0]) if len(differ) else n
                popped = -1
                while self.depth[path[-1]] > common:
                    popped = path.pop()
                    self.end[popped] = i
                if self.depth[path[-1]] < common:
                    middle = self._add(path[-1], common, self.first[popped])
                    self.parent[popped] = middle
                    path.append(middle)
            else:
                for node in path:
                    self.end[node] = i
                path = [self._add(-1, 0, i)]
            while common < len(sequence):
                common = min(len(sequence), (common // EDGE + 1) * EDGE)
                path.append(self._add(path[-1], common, i))
            self.last_node[i] = path[-1]
        for node in path:
            self.end[node] = len(sequences)
        self.parent, self.depth, self.first, self.end = (np.array(x, np.int64) for x in (self.parent, self.depth, self.first, self.end))
        lengths = np.array([len(s) for s in sequences], np.int64)
        offer = np.append((100 + percent) * lengths - percent * sizes, 0)
        self.best = np.maximum.reduceat(offer, np.stack([self.first, self.end], 1).ravel())[::2] if len(self.first) else offer[:0]
        self.tokens = np.concatenate(sequences) if sequences else np.zeros(0, np.int64)
        offsets = np.cumsum(lengths) - lengths
        above = np.where(self.parent >= 0, self.depth[self.parent], 0)
        self.edge_start, self.edge_length = offsets[self.first] + above, self.depth - above
        self.children, self.child_at = _lists(self.parent, len(self.parent))
        self.leaves, self.leaf_at = _lists(self.last_node, len(self.parent))
        self.roots = {int(groups[self.first[r]]): int(r) for r in np.flatnonzero(self.parent < 0)}

    def _add(self, parent: int, depth: int, first: int) -> int:
        self.parent.append(parent)
        self.depth.append(depth)
        self.first.append(first)
        self.end.append(-1)
        return len(self.parent) - 1


def _lists(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices grouped by owner 0 .. n - 1, and where each owner's begin."""
    order = np.argsort(owner, kind="stable")
    return order, np.searchsorted(owner[order], np.arange(n + 1))


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of consecutive runs."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels after linking ``a`` with ``b``; a label is the least index of its component."""
    while True:
        left, right = labels[a], labels[b]
        apart = left != right
        if not apart.any():
            return labels
        up = np.arange(len(labels))
        np.minimum.at(up, np.maximum(left, right)[apart], np.minimum(left, right)[apart])
        while (up[up] != up).any():
            up = up[up]
        labels = up[labels]


def tree_components(groups: np.ndarray, sets: list[np.ndarray], percent: int, asking: np.ndarray | None = None) -> np.ndarray:
    """Label per set: sets of one group that links connect have the same one.

    Without ``asking`` all sets meet each other; with it, the sets that ask meet those that don't.
    """
    n = len(sets)
    labels = np.arange(n)
    sizes = np.array([len(s) for s in sets], np.int64)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    # N-grams of one set only match nothing: they count in the sizes, not in the tree.
    shared = count[token] > 1
    owner = np.repeat(np.arange(n), sizes)[shared]
    n_alone = int((count == 1).sum())
    token = rank[token][shared] - n_alone
    order = np.lexsort((token, owner))
    sequences = np.split(token[order].astype(np.int64), np.cumsum(np.bincount(owner, minlength=n))[:-1])
    n_tokens = len(count) - n_alone
    key = [(int(g), s.astype(">u4").tobytes()) for g, s in zip(groups, sequences, strict=True)]
    stored = sorted((i for i in range(n) if asking is None or not asking[i]), key=key.__getitem__)
    tree = PrefixTree(groups[stored], [sequences[i] for i in stored], sizes[stored], percent)
    stored = np.array(stored, np.int64)
    position = np.full(n, -1)
    position[stored] = np.arange(len(stored))
    queries = [i for i in (stored if asking is None else np.flatnonzero(asking)) if int(groups[i]) in tree.roots]
    batch = max(1, min(CELLS // max(1, n_tokens), PAIRS // max(1, len(stored))))
    for at in range(0, len(queries), batch):
        ask = np.array(queries[at : at + batch], np.int64)
        member = np.zeros(len(ask) * n_tokens, bool)
        for row, i in enumerate(ask):
            member[row * n_tokens + sequences[i]] = True
        linked: list[tuple[np.ndarray, np.ndarray]] = []
        query = np.arange(len(ask))
        node = np.array([tree.roots[int(groups[i])] for i in ask], np.int64)
        overlap = np.zeros(len(ask), np.int64)
        while len(node):
            n_children = tree.child_at[node + 1] - tree.child_at[node]
            overlap, query = np.repeat(overlap, n_children), np.repeat(query, n_children)
            node = tree.children[_spread(tree.child_at[node], n_children)]
            # What the lengths before this edge leave possible, what comes later in the order, and what is not connected yet.
            doc = stored[tree.first[node]]
            alone = tree.end[node] - tree.first[node] == 1
            keep = ~(alone & (labels[doc] == labels[ask[query]]))
            if asking is None:
                keep &= tree.end[node] - 1 > position[ask[query]]
            above = tree.depth[node] - tree.edge_length[node]
            keep &= (100 + percent) * (overlap - above) + tree.best[node] >= percent * sizes[ask[query]]
            node, overlap, query = node[keep], overlap[keep], query[keep]
            if not len(node):
                break
            for lo in range(0, len(node), LOOKUPS // EDGE):
                run = slice(lo, lo + LOOKUPS // EDGE)
                lengths = tree.edge_length[node[run]]
                hit = member[np.repeat(query[run] * n_tokens, lengths) + tree.tokens[_spread(tree.edge_start[node[run]], lengths)]]
                overlap[run] += np.add.reduceat(hit, np.cumsum(lengths) - lengths, dtype=np.int64)
            n_leaves = tree.leaf_at[node + 1] - tree.leaf_at[node]
            if n_leaves.any():
                found = stored[tree.leaves[_spread(tree.leaf_at[node], n_leaves)]]
                asked, common = ask[np.repeat(query, n_leaves)], np.repeat(overlap, n_leaves)
                similar = ((100 + percent) * common >= percent * (sizes[asked] + sizes[found])) & (found != asked)
                linked.append((asked[similar], found[similar]))
        if linked:
            labels = _joined(labels, np.concatenate([x for x, _ in linked]), np.concatenate([x for _, x in linked]))
    return labels


def _links(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b`` (ids): enough links between classes to connect all that similarity connects.

    ``members`` has the classes of candidate clusters: ``rep, n, one, two, cluster``.
    """
    weights = members.groupBy("cluster").agg(F.sum("n").alias("weight"), F.count("*").alias("n_members")).filter("n_members > 1")
    placed = save(members.join(weights, "cluster").select("rep", "one", "two", "cluster", "n", F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int").alias("n_parts")), "join-members")
    total = placed.agg(F.sum("n")).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_SHINGLES))
    packed = compressed(docs)
    # Always by a shuffle of the compressed texts: a broadcast would work on small tables only.
    texts = packed.hint("merge").join(placed.drop("n"), packed["doc_id"] == placed["rep"]).select("rep", "one", "two", "cluster", "n_parts", "packed")
    schema = StructType([StructField("rep", LongType()), StructField("cluster", LongType()), StructField("n_parts", IntegerType()), StructField("found", BinaryType())])

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            sets = [shingles(unpacked(t).decode("utf-8"), words) for t in columns["packed"]]
            same = [i for i, s in enumerate(sets) if digests(s) == (columns["one"][i], columns["two"][i])]
            return {c: [columns[c][i] for i in same] for c in ("rep", "cluster", "n_parts")} | {"found": [sets[i].tobytes() for i in same]}

        return step

    part = F.pmod(F.xxhash64("rep"), F.col("n_parts")).cast("int")
    dealt = (
        map_batches(texts, make, schema).withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
        .withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
        .withColumn("block", F.when(F.col("n_parts") == 1, F.pmod(F.xxhash64("cluster"), F.lit(n_blocks))).otherwise(F.col("cluster")))
        .select("n_parts", "block", "low", "high", "part", "cluster", "rep", "found")
    )

    def join(table: pa.Table) -> pa.Table:
        release_memory()
        reps, groups, part = (np.asarray(table.column(c), np.int64) for c in ("rep", "cluster", "part"))
        # A set may be in two clusters of a block; in each it counts once, and ids ascend.
        order = np.lexsort((reps, groups))
        once = order[np.r_[True, (reps[order][1:] != reps[order][:-1]) | (groups[order][1:] != groups[order][:-1])]]
        reps, groups, part = reps[once], groups[once], part[once]
        found = table.column("found").to_pylist()
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        labels = tree_components(groups, [np.frombuffer(found[i], np.uint64) for i in once], percent, part == low if low != high else None)
        # A label is the least index of its component, so its least id.
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.table({"a": reps[labels[linked]], "b": reps[linked]})

    ends = StructType([StructField("a", LongType()), StructField("b", LongType())])
    return dealt.groupBy("n_parts", "block", "low", "high").applyInArrow(join, ends)


def similar_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Documents connected by similarity: ``doc_id, n_shingles, component_id``, one row per input row.

    Two documents link if 100 * intersection >= percent * union of their n-gram sets. The component
    is the smallest id that links reach, the row's own included. Texts without words and null texts
    have no n-grams, link with nothing and are their own component. Rows without id link with
    nothing and have a null component. Rows that share an id are each judged by their own text.
    """
    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = StructType([*(StructField(n, LongType()) for n in ("doc_id", "n", "one", "two")), StructField("often", BinaryType())])

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"doc_id": columns["doc_id"], "n": [], "one": [], "two": [], "often": []}
            for at in range(0, len(columns["text"]), _TOGETHER):
                sets = [shingles(t, words) for t in columns["text"][at : at + _TOGETHER]]
                out["n"] += map(len, sets)
                for name, values in zip(("one", "two"), zip(*map(digests, sets), strict=True), strict=True):
                    out[name] += values
                out["often"] += [_often(sets), *[None] * (len(sets) - 1)]
            return out

        return step

    sets = save(map_batches(docs, make, schema, _TOGETHER), "shingle-sets")
    known = docs.filter("doc_id IS NOT NULL")
    keys = ["n", "one", "two"]
    classes = save(sets.filter("doc_id IS NOT NULL AND n > 0").groupBy(*keys).agg(F.min("doc_id").alias("rep")), "set-classes")
    clusters = _candidates(known, words, percent, _frequent(sets))
    links = _links(known, classes.join(clusters, "one").select("rep", *keys, "cluster"), words, percent)
    linked = components(links).withColumnsRenamed({"node": "rep", "component": "linked"})
    named = classes.join(linked, "rep", "left").select(*keys, F.coalesce("linked", "rep").alias("class_component"))
    own = F.when(F.col("n") > 0, F.col("class_component")).otherwise(F.col("doc_id"))
    return (
        sets.join(named, keys, "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
    )


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents whose id names their component: one of each group of near duplicates stays.

    Rows without id or without words stay. An id goes if any row of it is a duplicate of a smaller id.
    """
    docs = pick(docs, *DOCUMENT_COLUMNS)
    found = similar_components(docs, words, percent)
    gone = found.filter("doc_id != component_id").select("doc_id").distinct()
    others = [c for c in DOCUMENT_COLUMNS if c not in ("doc_id", "text")]
    kept = compressed(docs, *others).hint("merge").join(gone, "doc_id", "left_anti")

    def make() -> Callable:
        return lambda columns: {c: columns[c] for c in ("doc_id", *others)} | {"text": [None if p is None else unpacked(p).decode("utf-8") for p in columns["packed"]]}

    return map_batches(kept, make, StructType([docs.schema[c] for c in DOCUMENT_COLUMNS]))


SIMILAR_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM worded),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 90 * (len(x.s) + len(y.s) - n)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reached.a, ways.b FROM reached JOIN ways ON reached.b = ways.a)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(b) AS component_id FROM sets JOIN reached ON sets.doc_id = a GROUP BY ALL
"""
