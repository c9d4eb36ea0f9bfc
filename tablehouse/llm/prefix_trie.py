"""Operator 13: prefix trie of conversations by a splitter skeleton.

A node is a distinct sequence of first turns; it has the conversations that start with it as
members.  A turn is the first 128 bits of the SHA-256 of its role and text, a conversation's
path the digests of its turns one after the other, so that the conversations below a node are
a run of the paths in order (two of n turns are taken for one with probability n*n / 2**129).

    rebuild   turns are gathered per conversation; texts don't travel, 24 bytes a turn do
    splitters a hashed sample of conversations, sorted by (path, conv_id), gives the splitters;
              their trie, the skeleton, is broadcast: at most `SAMPLE_BYTES` of paths
    shards    conversations between two splitters are sorted and read in one pass with a stack.
              A node that is no prefix of a splitter lies in one shard and is finished there
    skeleton  every other node gets a partial aggregate from each shard that holds members,
              and the partials are reduced.  What counts once per node is added by the shard
              that begins with the first splitter below it.  Splitters' nodes that turn out
              childless are leaves, which a second reduction adds to their ancestors

A splitter includes the conv_id, so many copies of one conversation are dealt over many shards.
Their conv_ids reach the digest of the ends as chunks of `CHUNK` ids, hashed as they arrive.

Memory: a task holds one path with its nodes, the closed children of open nodes of its shard, and
the skeleton.  All turns of one conversation are held as digests by one task (some 60 bytes a turn).

Defined cases: rows without conv_id belong to no conversation and are left out; null turns come
first; equal turn numbers are ordered by digest; repeated rows are turns of their own; null roles and
texts are empty; further columns are ignored; an empty table has no root and gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehouse.llm.common import fit, prepare, stored

WIDTH = 16                   # bytes of a turn's digest
GROUP, HEADS = 100, 6        # a conversation borrows up to HEADS - 1 first turns of its group's first one
SHARD_BYTES, SAMPLE_BYTES = 1 << 24, 1 << 26
OVERSAMPLE = 8               # sampled conversations per splitter
CHUNK = 8192                 # conv_ids in one piece of a digest

FINISHED, PARTIAL, ENDS = 0, 1, 2
NODE = ("kind int, node long, parent long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends string")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
EMPTY = hashlib.sha256().hexdigest()


def borrowed(conv_id: Column) -> Column:
    """How many first turns come from the group's first conversation."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEADS)).cast("int")


def as_paths(conversations: DataFrame, head: Callable[[Column], Column] | None = borrowed) -> DataFrame:
    """conv_id, path and sizes (code points per text) of every conversation; `head=None` takes them as they are."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.left(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), F.lit(2 * WIDTH))
    rows = fit(conversations, conv_id="long", turn="long", role="string", text="string").filter("conv_id is not null")
    rows = rows.select((F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), "conv_id",
                       F.struct("turn", digest.alias("digest"), F.length(text).alias("size")).alias("turn"))
    # dealt by group once: gathering and the join below reuse it
    own = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    turns = F.col("turns")
    if head:
        first = own.filter("conv_id = base").select("base", F.slice("turns", 1, HEADS - 1).alias("first"))
        own = own.join(first, "base", "left").withColumn("h", head(F.col("conv_id")))
        taken = F.when(F.col("first").isNotNull(), F.slice("first", F.lit(1), F.col("h"))).otherwise(F.slice("turns", 1, 0))
        turns = F.concat(taken, F.slice("turns", F.col("h") + 1, F.size("turns")))
    own = own.select("conv_id", turns.alias("turns"))
    return own.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
                      F.transform("turns", lambda t: t["size"]).alias("sizes"))


def common(a: bytes, b: bytes) -> int:
    """How many turns two paths share."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    if a[: high * WIDTH] == b[: high * WIDTH]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


class Skeleton:
    """The trie of the splitters; nodes are numbered in order, the root is 0."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = sorted(splitters)
        self.parent = [-1]
        self.ids: list[list[int]] = []    # per splitter: the nodes from the root to its path
        self.fresh: list[int] = []        # depth from which a splitter's nodes are its own
        before, nodes = b"", [0]
        for path, _ in self.splitters:
            shared = common(before, path)
            nodes = nodes[: shared + 1]
            self.fresh.append(shared + 1)
            for _ in range(len(path) // WIDTH - shared):
                self.parent.append(nodes[-1])
                nodes.append(len(self.parent) - 1)
            self.ids.append(nodes)
            before = path

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def ancestors(self, node: int) -> Iterator[int]:
        while node >= 0:
            yield node
            node = self.parent[node]


def skeleton(paths: DataFrame) -> Skeleton:
    """Splitters for shards of about `SHARD_BYTES`, as many as the session has shuffle partitions at least."""
    n, size = paths.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("path").cast("long") + 8), F.lit(0))).first()
    if not n:
        return Skeleton([])
    shards = max(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    wanted = min(OVERSAMPLE * shards, max(1, SAMPLE_BYTES * n // size))
    sample = paths.filter(F.pmod(F.xxhash64("conv_id", F.lit(13)), F.lit(n)) < wanted).select("path", "conv_id")
    found = sorted((bytes(r.path), r.conv_id) for r in sample.collect())
    places = {len(found) * i // shards for i in range(1, shards)} if found else ()
    return Skeleton([found[i] for i in sorted(places)])


class Node:
    __slots__ = ("id", "owned", "size", "conv_id", "n", "children", "leaves", "saved", "sha", "ends", "closed")

    def __init__(self, id: int | None, owned: bool, size: int):
        self.id, self.owned, self.size = id, owned, size
        self.conv_id, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.sha, self.ends, self.closed = None, [], []


class Shard:
    """One pass over the sorted conversations of a shard; `out` collects rows of `NODE`."""

    def __init__(self, bones: Skeleton, number: int, out: list[tuple]):
        self.bones, self.number, self.out = bones, number, out
        sides = [i for i in (number - 1, number) if 0 <= i < len(bones.splitters)]
        self.sides = [(bones.splitters[i][0], bones.ids[i]) for i in sides]
        # nodes counted once are this shard's own where its first splitter is the first below them
        self.own = bones.fresh[number - 1] if number else 0
        self.path, self.stack = b"", [Node(0, number == 0, 0)]

    def place(self, path: bytes, depth: int, known: list[tuple[int, list[int]]], size: int) -> Node:
        for i, (shared, ids) in enumerate(known):
            if depth <= shared:
                return Node(ids[depth], bool(self.number) and i == 0 and depth >= self.own, size)
        return Node(None, True, size)

    def add(self, conv_id: int, path: bytes, sizes: list[int]) -> None:
        keep = common(self.path, path)
        while len(self.stack) > keep + 1:
            self.close()
        known = [(common(path, s), ids) for s, ids in self.sides]
        for depth in range(len(self.stack), len(path) // WIDTH + 1):
            self.stack.append(self.place(path, depth, known, sizes[depth - 1]))
        self.path = path
        top = self.stack[-1]
        top.n += 1
        top.conv_id = conv_id if top.conv_id is None else min(top.conv_id, conv_id)
        if top.id is None:
            if top.sha is None:
                top.sha = hashlib.sha256(str(conv_id).encode())
            else:
                top.sha.update(b",%d" % conv_id)
        else:
            top.ends.append(conv_id)
            if len(top.ends) == CHUNK:
                self.piece(top)

    def piece(self, node: Node) -> None:
        if node.ends:
            self.out.append((ENDS, node.id, None, node.ends[0], None, None, None, None, None, None, ",".join(map(str, node.ends))))
            node.ends = []

    def close(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if self.stack else None
        node.saved += node.n * node.size - (node.size if node.owned else 0)
        if node.id is None:
            node.leaves += not node.children
            ends = node.sha.hexdigest() if node.sha else EMPTY
            for row in node.closed:
                self.out.append((FINISHED, None, None, row[0], depth + 1, node.conv_id, *row[1:]))
            row = (node.conv_id, node.n, node.children, node.leaves, node.saved, ends)
            if above.id is None:
                above.closed.append(row)
            else:
                self.out.append((FINISHED, None, above.id, row[0], depth, None, *row[1:]))
        else:
            self.piece(node)
            self.out.append((PARTIAL, node.id, above.id if above else None, node.conv_id, depth, None, node.n, node.children, node.leaves, node.saved, None))
        if above:
            above.n += node.n
            above.conv_id = node.conv_id if above.conv_id is None else min(above.conv_id, node.conv_id)
            above.children += node.owned
            above.leaves += node.leaves
            above.saved += node.saved

    def end(self) -> None:
        while self.stack:
            self.close()


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


ARROW = pa.schema([(c, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[kind]) for c, kind in (x.split() for x in NODE.split(", "))])


def _deal(bones: Skeleton) -> Callable:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = [bones.shard(p, c) for p, c in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.int32())], names=[*batch.schema.names, "shard"])
    return deal


def _walk(bones: Skeleton) -> Callable:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            out: list[tuple] = []
            for number, conv_id, path, sizes in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "sizes"))):
                if shard is None or shard.number != number:
                    if shard:
                        shard.out = out
                        shard.end()
                    shard = Shard(bones, number, out)
                shard.out = out
                shard.add(conv_id, path, sizes)
            yield _table(out, ARROW)
        if shard:
            shard.out = []
            shard.end()
            yield _table(shard.out, ARROW)
    return walk


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids from its pieces in order; only the hash state is held."""
    schema = pa.schema([("node", pa.int64()), ("ends", pa.string())])
    now, sha = None, None
    for batch in batches:
        out = []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if node == now:
                sha.update(b"," + ids.encode())
            else:
                if sha:
                    out.append((now, sha.hexdigest()))
                now, sha = node, hashlib.sha256(ids.encode())
        yield _table(out, schema)
    if sha:
        yield _table([(now, sha.hexdigest())], schema)


def _upwards(bones: Skeleton) -> Callable:
    def upwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            up = [a for node in batch.column("node").to_pylist() for a in bones.ancestors(node)]
            yield pa.RecordBatch.from_arrays([pa.array(up, pa.int64())], names=["node"])
    return upwards


def trie(paths: DataFrame) -> DataFrame:
    """All nodes of the trie of `as_paths` rows (each conv_id once), as `COLUMNS`."""
    prepare(paths.sparkSession)
    paths = stored(paths, "paths")
    bones = skeleton(paths)
    shards = len(bones.splitters) + 1
    dealt = paths.mapInArrow(_deal(bones), "conv_id long, path binary, sizes array<int>, shard int").repartitionById(shards, F.col("shard"))
    found = stored(dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(_walk(bones), NODE), "nodes")

    partial = found.filter(F.col("kind") == PARTIAL)
    counts = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    partial = partial.groupBy("node").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *[F.sum(c).alias(c) for c in counts])
    partial = stored(partial, "skeleton")
    pieces = found.filter(F.col("kind") == ENDS).select("node", "conv_id", "ends")
    ends = pieces.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(_digests, "node long, ends string")
    leaves = partial.filter("n_children = 0").select("node").mapInArrow(_upwards(bones), "node long").groupBy("node").agg(F.count(F.lit(1)).alias("more"))
    whole = (partial.join(leaves, "node", "left").join(ends, "node", "left")
             .withColumn("n_leaves", F.col("n_leaves") + F.coalesce("more", F.lit(0)))
             .withColumn("ends", F.coalesce("ends", F.lit(EMPTY))).withColumn("parent_conv_id", F.lit(None).cast("long")))
    fields = ["parent", "conv_id", "depth", "parent_conv_id", *counts, "ends"]
    nodes = found.filter(F.col("kind") == FINISHED).select(fields).unionByName(whole.select(fields))
    # at most one row per 16 bytes of the splitters' paths
    names = F.broadcast(partial.select(F.col("node").alias("parent"), F.col("conv_id").alias("above")))
    return (nodes.join(names, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
            .withColumnRenamed("ends", "ends_sha256").select(COLUMNS))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, each with the first turns it borrows from its group."""
    prepare(conversations.sparkSession)
    return trie(as_paths(conversations))


# every prefix as a list of turn digests; subtree sums by joining each node with its ancestors
SQL = """
with own as (
  select conv_id, list({'k': sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 'n': length(coalesce(text, ''))}
                       order by turn nulls first, role, text) as turns
  from conversations where conv_id is not null group by conv_id),
coded as (
  select conv_id, turns, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, length(conv_id::varchar) + 1), lambda i: ascii((conv_id::varchar)[i])::bigint)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, o: xor(x >> 1, (x & 1) * 3988292384))) as state
  from own),
headed as (select conv_id, turns, xor(state, 4294967295) % 6 as h from coded),
rebuilt as (
  select o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) as turns
  from headed o left join own b on b.conv_id = o.conv_id - o.conv_id % 100),
keyed as (select conv_id, turns, list_transform(turns, lambda t: t.k) as ks, len(turns) as n from rebuilt),
prefixes as (
  select conv_id, n, d, array_to_string(ks[1:d], '') as node, array_to_string(ks[1:d - 1], '') as above, ks[1:d] as ks,
         case when d = 0 then 0 else turns[d].n end as size
  from keyed, unnest(range(0, n + 1)) as u(d)),
nodes as (
  select node, d, any_value(above) as above, any_value(ks) as ks, any_value(size) as size, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where n = d), '')) as ends_sha256
  from prefixes group by node, d),
children as (select above as node, count(*) as n_children from nodes where d > 0 group by above),
facts as (select x.*, coalesce(c.n_children, 0) as n_children from nodes x left join children c on c.node = x.node),
sums as (
  select array_to_string(ks[1:a], '') as node, sum((n_children = 0)::int) as n_leaves, sum((n_convs - 1) * size) as saved_tokens
  from facts, unnest(range(0, d + 1)) as u(a) group by 1)
select f.conv_id, f.d as depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, s.n_leaves::bigint as n_leaves,
       s.saved_tokens::bigint as saved_tokens, f.ends_sha256
from facts f join sums s on s.node = f.node left join nodes p on f.d > 0 and p.node = f.above and p.d = f.d - 1
"""
