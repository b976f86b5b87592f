"""Trie of conversation prefixes, from vertical bitmaps.

Conversations lie in shards of neighbouring ids. A shard indexes every (position, turn) by a bitset of its conversations and walks
its trie depth first: a node is a bitset, its children are the intersections with the postings of the next position, its
size is a popcount. A node is known across shards by a 128-bit hash of its path, so nodes of all shards merge by one aggregation.
Sums over subtrees come back to the shards: what a node adds is given to the shard of its smallest member, every
shard sums it upwards in its own part of the trie, and the parts merge by path. No step runs once per level of the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelhouse.llm.common import ship, stored
from reelhouse.operators.skew import spread_join

# Ids differing only below this are one block; blocks are never split between shards, so that turns can be taken over within a block.
BLOCK = 100
# A shard is closed at the end of the block in which it reaches so many conversations or turns.
SHARD_CONVERSATIONS, SHARD_TURNS = 4096, 1 << 17
ROWS_AT_ONCE = 8192
# Parents of a larger share of the nodes meet their children in several tasks; there are fewer than 1 / share of them.
HOT_SHARE = 1e-3
ROOT = hashlib.md5(b"").digest()
PARTS = "shard long, path binary, parent binary, depth long, conv_id long, n long, size long, ends string"


class Turn(NamedTuple):
    """A turn: a hash of role and text, and the text's code points."""

    key: bytes
    size: int


def rebuilt(block: list[tuple[int, list[Turn]]], block_size: int = BLOCK) -> list[tuple[int, list[Turn]]]:
    """Conversations of one block with their first h turns taken from the block's first conversation, h a hash of the id."""
    turns, out = dict(block), []
    for conv, own in block:
        h = crc32(str(conv).encode()) % 6
        base = conv - (conv % block_size if conv >= 0 else -(-conv % block_size))
        out.append((conv, turns.get(base, [])[:h] + own[h:]))
    return out


def shard_nodes(conversations: list[tuple[int, list[Turn]]]) -> Iterator[tuple]:
    """(path, parent, depth, smallest member, members, size of the last turn, ids of members that end here) of every node of a shard.

    Conversations come in ascending order of their ids, so the lowest bit of a bitset is its smallest member.
    """
    postings: list[dict[bytes, int]] = []
    ending: dict[int, int] = {}
    for bit, (_, turns) in enumerate(conversations):
        ending[len(turns)] = ending.get(len(turns), 0) | 1 << bit
        for position, turn in enumerate(turns):
            if position == len(postings):
                postings.append({})
            postings[position][turn.key] = postings[position].get(turn.key, 0) | 1 << bit
    stack = [(ROOT, None, 0, (1 << len(conversations)) - 1, 0)]
    while stack:
        path, parent, depth, members, size = stack.pop()
        first = (members & -members).bit_length() - 1
        ends = members & ending.get(depth, 0)
        yield path, parent, depth, conversations[first][0], members.bit_count(), size, ",".join(_ids(ends, conversations)) if ends else None
        rest = members ^ ends
        while rest:
            turn = conversations[(rest & -rest).bit_length() - 1][1][depth]
            child = rest & postings[depth][turn.key]
            rest ^= child
            stack.append((hashlib.md5(path + turn.key).digest(), path, depth + 1, child, turn.size))


def _ids(members: int, conversations: list[tuple[int, list[Turn]]]) -> Iterator[str]:
    while members:
        low = members & -members
        yield str(conversations[low.bit_length() - 1][0])
        members ^= low


def _record(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [field.split() for field in schema.split(",")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def _batched(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_AT_ONCE:
            yield _record(held, schema)
            held = []
    if held:
        yield _record(held, schema)


def _shards(batches: Iterator[pa.RecordBatch], block_size: int, rebuild: Callable | None) -> Iterator[list[tuple[int, list[Turn]]]]:
    """Shards of whole blocks from rows in the order of (block, conversation, turn)."""
    shard, block, base, turns = [], [], None, 0
    for batch in batches:
        bases, convs, keys, sizes = (batch.column(i) for i in range(4))
        for at, conv, key, size in zip(bases.to_pylist(), convs.to_pylist(), keys.to_pylist(), sizes.to_pylist()):
            if at != base:
                if block:
                    shard += rebuild(block, block_size) if rebuild else block
                block, base = [], at
                if len(shard) >= SHARD_CONVERSATIONS or turns >= SHARD_TURNS:
                    yield shard
                    shard, turns = [], 0
            if not block or block[-1][0] != conv:
                block.append((conv, []))
            block[-1][1].append(Turn(key, size))
            turns += 1
    if block:
        shard += rebuild(block, block_size) if rebuild else block
    if shard:
        yield shard


def partial_nodes(turns: DataFrame, block_size: int = BLOCK, rebuild: Callable | None = None) -> DataFrame:
    """Nodes of every shard's trie (PARTS) from (conv_id, turn, role, text). Only hashes of the turns are shuffled, by range of blocks.

    ``shard`` is the shard's smallest conversation id: shards in its order hold ascending ids.
    """
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes() -> Iterator[tuple]:
            for shard in _shards(batches, block_size, rebuild):
                own = shard[0][0]
                for path, parent, *rest in shard_nodes(shard):
                    yield own, path, parent, *rest

        return _batched(nodes(), PARTS)

    ship(turns.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    light = turns.where(conv.isNotNull()).select(
        (conv - conv % F.lit(block_size)).alias("base"), conv.alias("conv_id"), key.alias("key"), F.length(text).cast("long").alias("size"),
        F.col("turn").alias("turn"),
    )
    ordered = light.repartitionByRange("base").sortWithinPartitions("base", "conv_id", F.col("turn").asc_nulls_first(), "key")
    return ordered.select("base", "conv_id", "key", "size").mapInArrow(walk, PARTS)


def end_hashes(parts: DataFrame) -> DataFrame:
    """(path, ends_sha256): SHA-256 of the comma-joined ids that end at a node, shards following each other.

    A list is never held whole: the pieces of a node arrive in order and go into the hash one by one.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists() -> Iterator[tuple]:
            last, state = None, None
            for batch in batches:
                for path, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if path == last:
                        state.update(b",")
                    else:
                        if state:
                            yield last, state.hexdigest()
                        last, state = path, hashlib.sha256()
                    state.update(piece.encode())
            if state:
                yield last, state.hexdigest()

        return _batched(lists(), "path binary, ends_sha256 string")

    pieces = parts.where(F.col("ends").isNotNull()).select("path", "ends", "shard")
    ordered = pieces.repartition("path").sortWithinPartitions("path", "shard").select("path", "ends")
    return ordered.mapInArrow(digest, "path binary, ends_sha256 string")


def subtree_sums(shared: DataFrame) -> DataFrame:
    """(path, n_leaves, saved_tokens) from the shards' own parts of nodes (shard, path, parent, depth, leaves, saved)."""
    def upwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(nodes: list[tuple]) -> Iterator[tuple]:
            total = {path: [leaves, saved] for path, _, leaves, saved in nodes}
            for path, parent, _, _ in nodes:  # deepest first
                if parent is not None:
                    own, up = total[path], total[parent]
                    up[0] += own[0]
                    up[1] += own[1]
            for path, (leaves, saved) in total.items():
                yield path, leaves, saved

        def shards() -> Iterator[tuple]:
            last, nodes = None, []
            for batch in batches:
                for shard, *node in zip(*[column.to_pylist() for column in batch.columns]):
                    if shard != last:
                        yield from summed(nodes)
                        last, nodes = shard, []
                    nodes.append(node)
            yield from summed(nodes)

        return _batched(shards(), "path binary, leaves long, saved long")

    ordered = shared.repartition("shard").sortWithinPartitions("shard", F.col("depth").desc())
    parts = ordered.select("shard", "path", "parent", "leaves", "saved").mapInArrow(upwards, "path binary, leaves long, saved long")
    return parts.groupBy("path").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def prefix_trie(turns: DataFrame, block_size: int = BLOCK, rebuild: Callable | None = None) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role, text; a conversation's turns are ordered by turn, null first, ties by a hash of role and text,
    and rows that repeat a turn are turns of their own. Null role and text count as empty. Rows without a conv_id belong to no conversation. No
    conversations give no rows, not even a root. Other columns are not read. ``rebuild`` may change the conversations of a block, as
    ``rebuilt`` does. A node's conv_id and depth name it: its smallest member has one prefix of that length.

    Nodes of one conversation only have one leaf and save nothing, so subtree sums are taken over shared nodes alone. A conversation's turn hashes lie
    in one task; a node's members, children and ends may be any number.
    """
    parts = stored(partial_nodes(turns, block_size, rebuild), "trie-parts")
    nodes = stored(parts.groupBy("path").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"),
        F.first("size").alias("size"),
    ), "trie-nodes")
    children = nodes.where(F.col("parent").isNotNull()).groupBy("parent").agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("alone"))
    children = children.withColumnRenamed("parent", "path")
    counted = stored(nodes.join(children, "path", "left").na.fill(0, ["n_children", "alone"]), "trie-counted")
    shared = counted.where("n_convs > 1")
    leaves = F.col("alone") + (F.col("n_children") == 0).cast("long")
    given = parts.alias("p").join(shared.alias("s"), "path").select(
        "p.shard", "path", "p.parent", "p.depth",
        F.when(F.col("p.conv_id") == F.col("s.conv_id"), leaves).otherwise(0).alias("leaves"),
        F.when(F.col("p.conv_id") == F.col("s.conv_id"), (F.col("s.n_convs") - 1) * F.col("s.size")).otherwise(0).alias("saved"))
    joined = counted.join(subtree_sums(given), "path", "left").join(end_hashes(parts), "path", "left")
    most = max(counted.count() * HOT_SHARE, 1000.0)
    hot = counted.where(F.col("n_children") > most).select(F.col("path").alias("parent"), F.ceil(F.col("n_children") / F.lit(most)).cast("int").alias("pieces"))
    above = nodes.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return spread_join(joined, above, ["parent"], "path", hot, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, md5(strlen(role) || ':' || role || text) AS key, length(text) AS size,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS pos FROM t),
lengths AS (SELECT conv_id, count(*) AS n FROM k GROUP BY conv_id),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, (xor(list_reduce(
        list_prepend(4294967295::UBIGINT, flatten([list_concat([(ascii(x) + 1000)::UBIGINT], repeat([0::UBIGINT], 8)) for x in string_split(conv_id::VARCHAR, '')])),
        lambda a, x: CASE WHEN x >= 1000 THEN xor(a, x - 1000) ELSE xor(a >> 1, (a & 1) * 3988292384::UBIGINT) END), 4294967295::UBIGINT) % 6)::BIGINT AS h FROM lengths),
r AS (SELECT c.conv_id, pos, key, size FROM c JOIN k ON k.conv_id = c.base AND pos <= h
      UNION ALL SELECT c.conv_id, pos - h + least(h, coalesce(b.n, 0)), key, size FROM c JOIN k USING (conv_id) LEFT JOIN lengths b ON b.conv_id = c.base WHERE pos > h),
p AS (SELECT conv_id, pos AS depth, size, md5(string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM p GROUP BY path, depth),
edges AS (SELECT nodes.path, p.path AS parent FROM nodes JOIN p ON p.conv_id = nodes.conv_id AND p.depth = nodes.depth - 1),
children AS (SELECT parent AS path, count(*) AS n_children FROM edges GROUP BY parent),
ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
         FROM (SELECT conv_id, path FROM p QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY path),
sums AS (SELECT p.path, count_if(n_children IS NULL) AS n_leaves, sum((n_convs - 1) * nodes.size) AS saved_tokens
         FROM nodes LEFT JOIN children USING (path) JOIN p ON p.conv_id = nodes.conv_id AND p.depth <= nodes.depth GROUP BY p.path)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes JOIN sums USING (path) LEFT JOIN children USING (path) LEFT JOIN ends USING (path) LEFT JOIN edges USING (path)
LEFT JOIN nodes above ON above.path = edges.parent
"""
