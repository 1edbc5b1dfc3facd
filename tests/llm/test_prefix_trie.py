"""The trie against its SQL, a plain formulation and edge rows, whole and in small blocks."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from rentscope.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, shared_heads=True):
    """Every prefix of every conversation, with its members."""
    own: dict = {}

    def key(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())

    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    members: dict = {}
    ends: dict = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4 if shared_heads else 0
        turns = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    n_children, leaves, saved = ({p: 0 for p in members} for _ in range(3))
    for p in members:
        if p:
            n_children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += n_children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
    out = []
    for p, m in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), n_children[p], leaves[p], saved[p], digest))
    return sorted(out, key=str)


def found(df, **settings):
    return sorted(map(tuple, prefix_trie.conversation_trie(df, **settings).select(*NAMES).collect()), key=str)


def made(seed, n=300, kinds=3, longest=7):
    """Conversations that share many beginnings; every third row of the common one's copies."""
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(3 * n), n):
        if rng.random() < 0.3:
            out += [(c, t, "user", f"common {t}") for t in range(5)]
        else:
            out += [(c, t, rng.choice(["user", "assistant"]), "w " * rng.randrange(kinds)) for t in range(rng.randrange(longest))]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block_rows", [8, 30, 2048])
def test_equals_a_plain_formulation(spark, block_rows):
    rows = made(block_rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, shared_heads=True, block_rows=block_rows) == plain(rows)
    assert found(df, block_rows=block_rows) == plain(rows, shared_heads=False)


def test_blocks_close_to_the_same_nodes_without_spark():
    """Many rounds over blocks of 3 paths, deep and shallow, against a plain trie."""
    for seed in range(30):
        rng = random.Random(seed)
        paths: dict = {}
        for c in range(60):
            depth = rng.randrange(rng.choice([3, 12]))
            path = b"".join(bytes([rng.randrange(2)]) * 16 for _ in range(depth))
            paths.setdefault(path, []).append(c)
        rows = []
        for path, ids in sorted(paths.items()):
            words = b"".join(int(path[i]).to_bytes(8, "little") for i in range(0, len(path), 16))
            rows.append(prefix_trie.Path.ended(path, words, len(ids), min(ids), ",".join(map(str, ids))))
        closed, parents = [], {}
        while rows:
            last, kept = len(rows) <= 3, []
            for at in range(0, len(rows), 3):
                nodes, border = prefix_trie.peel(rows[at : at + 3], last)
                closed += [dict(zip(nodes, v, strict=True)) for v in zip(*nodes.values(), strict=True)]
                kept += [prefix_trie.Path.stored(p.path, p.words.tobytes(), p.carried.tobytes(), [p.ends.get(k) for k in range(p.depth + 1)]) for p in border]
            rows = sorted(kept, key=lambda p: p.path) if not last else []
        parents = {n["node"]: n["conv_id"] for n in closed}
        assert len(parents) == len(closed)
        members: dict = {}
        for path, ids in paths.items():
            for d in range(len(path) // 16 + 1):
                members.setdefault(path[: 16 * d], []).extend(ids)
        assert len(members) == len(closed)
        by_node = {hashlib.md5(p).digest(): p for p in members}
        for n in closed:
            p = by_node[n["node"]]
            below = [q for q in members if q[: len(p)] == p]
            assert n["depth"] == len(p) // 16 and n["n_convs"] == len(members[p]) and n["conv_id"] == min(members[p])
            assert n["n_children"] == sum(len(q) == len(p) + 16 for q in below)
            assert n["n_leaves"] == sum(not any(len(r) == len(q) + 16 and r[: len(q)] == q for r in members) for q in below)
            assert n["saved_tokens"] == sum((len(members[q]) - 1) * q[-1] for q in below if q)
            assert n["ends_sha256"] == (",".join(map(str, paths[p])) if p in paths else prefix_trie.NO_ENDS)
            parent = n["parent_conv_id"] if n["parent"] is None else parents[n["parent"]]
            assert parent == (min(members[p[:-16]]) if p else None)


def test_equals_sql(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small_dir}/conversations.parquet'")
    assert found(df, shared_heads=True) == sorted(con.execute(prefix_trie.TRIE_SQL).fetchall(), key=str)


def test_edges(spark):
    """Null ids, turns, roles and texts, repeated rows, equal turns, long texts, negative ids and further columns."""
    rows = made(9, 60)
    rows += [(None, 1, "user", "lost"), (200, None, None, None), (200, None, None, None), (200, 1, None, ""), (201, 3, "user", "x " * 50_000), (201, 3, "user", "a"), (201, 3, "tool", "b")]
    rows += [(-7, 0, "user", "minus"), rows[0], rows[0]]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS path", "1 AS words", "2 AS key", "3 AS n", "4 AS family", "5 AS head", "6 AS digest").repartition(4)
    assert found(df) == plain(rows, shared_heads=False)


def test_one_prefix_for_all_and_parents_by_salted_shuffle(spark):
    rows = [(c, t, "user", "same" if t < 3 else f"own {c} {t}") for c in range(400) for t in range(5)]
    rows += [(c, t, "user", "same") for c in range(400, 600) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert found(df, block_rows=64, most_broadcast=0) == plain(rows, shared_heads=False)


def test_ids_of_a_key_in_pieces(spark):
    rows = [(b"hot", i) for i in range(5000)] + [(b"%d" % (i % 70), i) for i in range(700)] + [(b"one", 10**15)]
    made = spark.createDataFrame(rows, "key binary, conv_id long").repartition(7)
    held: dict = {}
    for k, i in rows:
        held.setdefault(k, []).append(i)
    expected = {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in held.items()}
    result = prefix_trie.id_list_digests(made, 50).collect()
    assert {bytes(r.key): r.ends for r in result} == expected and len(result) == len(expected)


def test_a_deep_conversation(spark):
    rows = [(1, t, "user", f"t {t}") for t in range(3000)] + [(2, t, "user", f"t {t}") for t in range(2990)] + [(3, 0, "user", "t 0")]
    nodes = {(r.depth, r.conv_id): r for r in prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(nodes) == 3001 and nodes[2990, 1].n_convs == 2 and nodes[0, 1].n_convs == 3
    assert nodes[0, 1].saved_tokens == 2989 * 2 + 4 and nodes[1, 1].n_leaves == 1


def test_nothing(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    c = next(c for c in range(21, 39) if zlib.crc32(str(c).encode()) % 4)
    turnless = spark.createDataFrame([(c, 0, "user", "gone"), (None, 0, "user", "x")], SCHEMA)
    assert found(turnless, shared_heads=True) == plain([(c, 0, "user", "gone")]) and len(found(turnless, shared_heads=True)) == 1
