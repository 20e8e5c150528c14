"""Prefix trie of conversations, built from range-partitioned paths and a skeleton of their splitters.

A conversation's path is the sequence of its turns' 128-bit hashes, and paths sort like strings. Splitter
paths cut the sorted paths into shards. A node whose conversations lie in two shards is a prefix of a splitter
between them: the trie of the splitters, the skeleton, holds every such node and is broadcast. Each shard reads its
sorted paths once, keeps only the open path on a stack and finishes all other nodes by itself.
For skeleton nodes it yields partial aggregates, which are summed per node; the small skeleton is then folded upward.

Bounds: the skeleton has at most ``SKELETON_BYTES / 16`` nodes, since splitters are thinned out
beyond that size (shards then grow, results stay). Equal conversations are counted per block of 4096 ids before they meet, so a
conversation that many share is one path with a few packed lists of ids. SHA-256 reads its input in order, so
these lists pass through the one shard that holds the path, as a stream. The turns of one
conversation are one row: 20 bytes per turn; texts stay where they are read.

Defined results: a null role or text is empty; a null turn comes first; turns with one number are ordered by the MD5
of role and text (equal rows are turns each); rows without a conversation id belong to no conversation; an empty table
has no nodes, not even a root. Names of other columns do not matter.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import cut_lineage

KEY_BYTES = 16
# The splitters' bytes, which bound the skeleton; longer paths are no splitters.
SKELETON_BYTES, LONGEST_SPLITTER = 4 << 20, 64 << 10
# Bytes of a shard's rows, paths sampled per splitter, and the bytes of that sample.
SHARD_BYTES, SAMPLED, SAMPLE_BYTES = 32 << 20, 16, 32 << 20
# Ids of a block: conversation ids divided by 2^12.
BLOCK_BITS = 12
FLUSH_ROWS = 8192


def turn_sequences(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv_id, turns): the turns in order as (hash, code points); the texts do not move."""
    role_text = F.coalesce(conversations[role], F.lit(""))
    body = F.coalesce(conversations[text], F.lit(""))
    rows = conversations.select(
        conversations[key].cast("long").alias("conv_id"),
        conversations[turn].alias("turn"),
        F.md5(F.concat(F.octet_length(role_text).cast("string"), F.lit(":"), role_text, body)).alias("hash"),
        F.char_length(body).alias("points"),
    )
    turns = F.sort_array(F.collect_list(F.struct("turn", "hash", "points")))
    found = rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(turns.alias("turns"))
    return found.select("conv_id", F.transform("turns", lambda t: F.struct(t["hash"], t["points"])).alias("turns"))


def shared_openings(sequences: DataFrame, group: int = 100, longest: int = 5) -> DataFrame:
    """Give each conversation the opening of the first one of its hundred.

    The first h turns of conversation c - c % group replace the first h of c, where h is crc32(c) modulo
    ``longest`` + 1. Only openings of at most ``longest`` turns are joined, to at most ``group`` rows each.
    """
    stored = cut_lineage(sequences)
    c = F.col("conv_id")
    opening = stored.where(c % group == 0).select(c.alias("base"), F.slice("turns", 1, longest).alias("opening"))
    h = (F.crc32(c.cast("string")) % (longest + 1)).cast("int")
    own = stored.withColumn("base", c - c % group).withColumn("h", h)
    first = F.coalesce(F.slice("opening", 1, F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(opening, "base", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def distinct_paths(sequences: DataFrame) -> DataFrame:
    """Rows (path, block, lengths, n, least, ids): equal conversations counted per block of ids."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["hash"]), ""))
    rows = sequences.select(
        path.alias("path"),
        F.shiftright("conv_id", BLOCK_BITS).alias("block"),
        F.transform("turns", lambda t: t["points"]).alias("lengths"),
        "conv_id",
    )
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    return rows.groupBy("path", "block").agg(
        F.first("lengths").alias("lengths"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("least"),
        F.array_join(ids, ",").alias("ids"),
    )


def common_turns(a: bytes, b: bytes) -> int:
    """Number of leading turns that two paths share."""
    most, n = min(len(a), len(b)) // KEY_BYTES, 0
    while n < most and a[n * KEY_BYTES : (n + 1) * KEY_BYTES] == b[n * KEY_BYTES : (n + 1) * KEY_BYTES]:
        n += 1
    return n


def splitter_paths(paths: DataFrame) -> list[bytes]:
    """Ascending paths that cut the rows into shards of similar size.

    They come from a sample of bounded size. Each is cut after the turn that tells it from the sampled
    path before it. Which paths are splitters changes the work only, never a result.
    """
    bytes_of = F.octet_length("path") + F.octet_length("ids") + 4 * F.size("lengths") + 24
    total = paths.agg(F.count(F.lit(1)).alias("rows"), F.sum(bytes_of).alias("bytes")).first()
    if not total.rows:
        return []
    width = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    shards = max(width, -(-total.bytes // SHARD_BYTES))
    one_in = max(1, total.rows // (SAMPLED * shards), -(-total.bytes // SAMPLE_BYTES))
    drawn = (F.octet_length("path") <= LONGEST_SPLITTER) & (F.pmod(F.xxhash64("path"), F.lit(one_in)) == 0)
    sample = sorted({bytes(r.path) for r in paths.where(drawn).select("path").collect()})
    chosen = sorted({len(sample) * i // shards for i in range(1, shards)} - {0})
    cut = [sample[i][: (common_turns(sample[i - 1], sample[i]) + 1) * KEY_BYTES] for i in chosen]
    while sum(map(len, cut)) > SKELETON_BYTES:
        cut = cut[::2] if len(cut) > 1 else []
    return cut


class Skeleton:
    """The trie of the splitters: node 0 is the root, a child's number is above its parent's."""

    def __init__(self, splitters: list[bytes]):
        self.splitters = splitters
        self.children: dict[tuple[int, bytes], int] = {}
        self.parents = [-1]
        for path in splitters:
            node = 0
            for i in range(0, len(path), KEY_BYTES):
                step = (node, path[i : i + KEY_BYTES])
                if step not in self.children:
                    self.children[step] = len(self.parents)
                    self.parents.append(node)
                node = self.children[step]


class Node:
    """An open node: what its finished descendants and own conversations add up to."""

    __slots__ = ("bone", "children", "digest", "least", "leaves", "n", "points", "saved", "waiting")

    def __init__(self, bone: int, points: int):
        self.bone, self.points = bone, points
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.digest = None, None
        # Finished children, until this node's smallest conversation is known.
        self.waiting: list[tuple] = []

    def join(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


FIELDS = {
    "bone": "bigint",
    "parent_bone": "bigint",
    "conv_id": "bigint",
    "depth": "bigint",
    "parent_conv_id": "bigint",
    "n_convs": "bigint",
    "n_children": "bigint",
    "n_leaves": "bigint",
    "saved_tokens": "bigint",
    "points": "bigint",
    "ends_sha256": "string",
}
NO_END = hashlib.sha256().hexdigest()


class Shard:
    """Reads sorted paths; ``rows`` collects finished nodes and, with ``bone`` set, partial ones."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.rows = skeleton, []
        self.path, self.stack = b"", []

    def add(self, path: bytes, lengths: list[int], n: int, least: int, ids: str) -> None:
        if not self.stack:
            self.stack = [Node(0, 0)]
        same = common_turns(self.path, path)
        self.close(same + 1)
        for d in range(same, len(path) // KEY_BYTES):
            above = self.stack[-1].bone
            bone = self.skeleton.children.get((above, path[d * KEY_BYTES : (d + 1) * KEY_BYTES]), -1) if above >= 0 else -1
            self.stack.append(Node(bone, lengths[d]))
        self.path, top = path, self.stack[-1]
        top.join(n, least)
        if top.digest is None:
            top.digest = hashlib.sha256()
        else:
            top.digest.update(b",")
        top.digest.update(ids.encode())

    def close(self, depth: int) -> None:
        """Finish all open nodes but the first ``depth``."""
        while len(self.stack) > depth:
            node, at = self.stack.pop(), len(self.stack)
            above = self.stack[-1] if self.stack else None
            ends = node.digest.hexdigest() if node.digest else None
            if above:
                above.join(node.n, node.least)
            if node.bone >= 0:
                self.rows.append(
                    (node.bone, None, node.least, at, None, node.n, node.children, node.leaves, node.saved, node.points, ends)
                )
                continue
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n - 1) * node.points
            above.children += 1
            above.leaves += leaves
            above.saved += saved
            self.rows += [(None, None, *child[:2], node.least, *child[2:]) for child in node.waiting]
            row = (node.least, at, node.n, node.children, leaves, saved, node.points, ends or NO_END)
            if above.bone >= 0:
                self.rows.append((None, above.bone, *row[:2], None, *row[2:]))
            else:
                above.waiting.append(row)


def shard_nodes(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Nodes that one shard finishes, and partial aggregates of skeleton nodes (``bone`` is set)."""
    shared = paths.sparkSession.sparkContext.broadcast(skeleton)
    names = list(FIELDS)
    schema = pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in FIELDS.items()])

    @F.arrow_udf("int")
    def shard_of(paths: pa.Array) -> pa.Array:
        splitters = shared.value.splitters
        return pa.array([bisect_right(splitters, p) for p in paths.to_pylist()], pa.int32())

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(shared.value)
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("path", "lengths", "n", "least", "ids")]
            for row in zip(*columns):
                shard.add(*row)
                if len(shard.rows) >= FLUSH_ROWS:
                    yield packed(shard.rows)
                    shard.rows = []
        shard.close(0)
        if shard.rows:
            yield packed(shard.rows)

    dealt = paths.withColumn("shard", shard_of("path")).repartitionByRange(len(skeleton.splitters) + 1, "shard")
    ordered = dealt.drop("shard").sortWithinPartitions("path", "block")
    return ordered.mapInArrow(walk, ", ".join(f"{name} {FIELDS[name]}" for name in names))


def fold_skeleton(partial: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """The skeleton's nodes from the shards' partial aggregates, reduced per node on Spark."""
    sums = partial.groupBy("bone").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("points").alias("points"),
        F.max("ends_sha256").alias("ends_sha256"),
    )
    found = {r.bone: r.asDict() for r in sums.collect()}
    for bone in sorted(found, reverse=True):
        node = found[bone]
        node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["points"]
        above = found.get(skeleton.parents[bone])
        if above:
            above["n_children"] += 1
            above["n_leaves"] += node["n_leaves"]
            above["saved_tokens"] += node["saved_tokens"]
    return [
        (
            *(bone, n["conv_id"], n["depth"], found[skeleton.parents[bone]]["conv_id"] if bone else None),
            *(n["n_convs"], n["n_children"], n["n_leaves"], n["saved_tokens"], n["ends_sha256"] or NO_END),
        )
        for bone, n in sorted(found.items())
    ]


def build_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv_id, turns), turns being arrays of (hash, points).

    conv_id: the smallest conversation with this beginning; depth; parent_conv_id, the parent's conv_id;
    n_convs: conversations with this beginning; n_children; n_leaves: nodes without children in its
    subtree; saved_tokens: summed over the subtree, (n_convs - 1) times the code points of a node's last
    text; ends_sha256: digest of the ids of conversations that end here, ascending, joined by commas.
    """
    spark = sequences.sparkSession
    paths = cut_lineage(distinct_paths(sequences))
    skeleton = Skeleton(splitter_paths(paths))
    nodes = cut_lineage(shard_nodes(paths, skeleton))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    schema = ", ".join(f"{c} {FIELDS[c]}" for c in ["bone", *columns])
    bones = spark.createDataFrame(fold_skeleton(nodes.where("bone is not null"), skeleton), schema)
    # One row per skeleton node: bounded by SKELETON_BYTES.
    above = F.broadcast(bones.select(F.col("bone").alias("parent_bone"), F.col("conv_id").alias("bone_conv_id")))
    local = nodes.where("bone is null").join(above, "parent_bone", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "bone_conv_id"))
    return local.select(columns).unionByName(bones.select(columns))
