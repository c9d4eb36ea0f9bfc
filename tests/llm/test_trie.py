"""Conversation prefix trie against a walk over all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tablehouse.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """All nodes from (conv_id, turn, role, text) rows, by definition."""
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            key = hashlib.sha256(f"{len(r or '')}:{r or ''}{x or ''}".encode()).hexdigest()[:32]
            turns[c].append(((t is not None, t or 0), key, r or "", x or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = (*turns.get(base, [])[:h], *own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def found(frame):
    rows = prefix_trie.conversation_trie(frame)
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows.select(prefix_trie.COLUMNS).collect())


def random_rows(seed, n, words):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        base = rng.choice([0, 100, 10_000, -300]) + rng.randrange(100) * rng.choice([1, -1])
        for t in range(rng.randrange(1, 8)):
            rows.append((base, t, rng.choice(["user", "assistant", None]), rng.choice(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_nodes(spark, partitions):
    rows = random_rows(partitions, 150, ["", None, "a", "bé🙂", "long text"])
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_copies_over_many_shards(spark, monkeypatch):
    """Two thirds of the conversations are one; their ids come in many pieces from many shards."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    monkeypatch.setattr(prefix_trie, "SHARD_BYTES", 256)
    rows = [(c * 100, t, "user", f"turn {t}") for c in range(400) for t in range(3)]
    rows += [(c * 100 + 50_000, t, "user", f"turn {t}" if t < c % 4 else f"own {c % 17}") for c in range(200) for t in range(5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    paths = prefix_trie.as_paths(frame)
    assert len(prefix_trie.skeleton(paths).splitters) > 50
    assert found(frame) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, "user", "x"), (1, 0, None, None), (1, 0, "", ""), (None, 1, "user", "lost"), (200, 5, "user", "a"), (200, 5, "user", "a"),
            (201, 1, "user", "b"), (2**62, 1, "system", "big"), (-7, 1, "user", "c"), (-100, 1, "user", "d"), (299, 3, None, "z")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as base", "'x' as path", "2 as shard", "array(1) as sizes", "3 as node")
    assert found(frame) == brute(rows)
    assert found(frame.filter("false")) == []


def test_long_conversation(spark):
    rows = [(0, t, "user", f"t{t}") for t in range(3000)] + [(c, t, "user", f"t{t}") for c in (1, 2) for t in range(2000)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert len(got) == len({r[1] for r in got}) == 3001
    assert got == sorted(got) and max(r[1] for r in got) == 3000
    root = next(r for r in got if r[1] == 0)
    assert root[3:6] == (3, 1, 1) and root[6] == 2 * sum(len(f"t{t}") for t in range(2000))


def test_turnless_conversation(spark):
    """Conversations whose own turns all lie in the borrowed part, without a first one to borrow from."""
    ids = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1]
    rows = [(c, 0, "user", "only") for c in ids]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and len(got) == 1 and got[0][4:6] == (0, 1)
