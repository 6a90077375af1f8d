"""The prefix trie of conversations, built from sorted shards and a skeleton of their splitters.

1. A turn becomes a fixed number of bytes (digest of role and text, length of the text), a conversation the
   path of its turns. Paths are counted once with the conversations that end in them.
2. Splitters cut the sorted paths into shards of about equal work. They are the shortest prefixes that separate neighbouring paths
   of a sample; the trie of the splitters, the skeleton, is broadcast. It is bounded: there are fewer splitters, and so larger
   shards, where their paths are long.
3. A node whose members lie in several shards is a prefix of the splitter between them, so it belongs to the skeleton. Every other node lies in
   one shard, which finishes it in one scan of its sorted paths with a stack as deep as a path.
4. Of a skeleton node each shard gives what it holds of it; these partial aggregates are summed up and folded from the
   deepest nodes to the root.

A hot prefix is cut by splitters like any other; a hot conversation is one path, whose conversations are counted in blocks of ids before the exchange.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import share, shared_value
from opinara.session import materialise

TURN = 24  # bytes of a turn in a path: 16 of the digest, 8 of the length
IDS = 16  # low bits of the conversation ids that share a block
SHARD_TURNS, MAX_SHARDS = 200_000, 2048
PER_SHARD = 16  # sampled paths for each shard
MAX_SKELETON = 200_000  # nodes that are broadcast
PENDING = 50_000  # finished children that wait for their parent in memory
NO_END = hashlib.sha256(b"").hexdigest()
NODE = ("skeleton int, parent binary, name binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
        "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")
TYPES = (pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string())
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_key() -> Column:
    """48 hexadecimal digits that stand for a turn's role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.concat(digest, F.lpad(F.hex(F.char_length(text).cast("long")), 16, "0"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as `turn_key`s.

    Turns go by `turn`, null first; turns of one number by role, then by digest. Rows without conv_id belong to no conversation.
    """
    one = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), turn_key().alias("key"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("one"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all")).select("conv_id", F.col("all.key").alias("turns"))


def with_shared_openings(turns: DataFrame, block: int = 100, longest: int = 6) -> DataFrame:
    """Each conversation c opens with the first h turns of conversation c - c % block, h = crc32(c) % longest, in place of its own first h."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("int")
    base = turns.filter(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, longest - 1).alias("opening"))
    own = turns.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    opening = F.slice(F.coalesce("opening", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(base, "base", "left").select("conv_id", F.concat(opening, rest).alias("turns"))


def _separators(every: int):
    """Of sorted paths, before every `every`-th: the shortest prefix that the path before it does not reach."""
    def separators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, n, out = None, 0, []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                n += 1
                if before is not None and n >= every and path != before:
                    i, end = 0, min(len(path), len(before))
                    while i < end and path[i:i + TURN] == before[i:i + TURN]:
                        i += TURN
                    out.append(path[:i + TURN])
                    n = 0
                before = path
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["path"])

    return separators


def skeleton_of(splitters: list[bytes]) -> dict[tuple[int, bytes], int]:
    """(number of the parent, turn) to number, for all prefixes of the splitters; the root is 0."""
    nodes: dict[tuple[int, bytes], int] = {}
    for path in splitters:
        at = 0
        for i in range(0, len(path), TURN):
            at = nodes.setdefault((at, path[i:i + TURN]), len(nodes) + 1)
    return nodes


def choose_splitters(paths: DataFrame, shards: int, limit: int = MAX_SKELETON) -> list[bytes]:
    """At most `shards` - 1 splitters whose skeleton has at most `limit` nodes."""
    n = paths.count()
    share_ = min(1.0, shards * PER_SHARD / max(n, 1))
    sample = paths.filter(F.xxhash64("path").cast("double") < (2 * share_ - 1) * 2.0 ** 63) if share_ < 1 else paths
    found = sample.select("path").repartition(1).sortWithinPartitions("path").mapInArrow(_separators(max(1, round(n * share_ / shards))), "path binary")
    splitters = sorted({r["path"] for r in found.collect()})[:shards - 1]
    while sum(len(s) for s in splitters) > limit * TURN:
        splitters = splitters[1::2]
    return splitters


def _shard(splitters):
    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared_value(splitters)
        for batch in batches:
            found = pa.array([bisect_right(cuts, p) for p in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([found, *batch.columns], names=["shard", *batch.schema.names])

    return shard


class _Open:
    """A node on the stack of the scan."""

    __slots__ = ("turn", "skeleton", "low", "n", "children", "leaves", "saved", "ends", "pending", "named")

    def __init__(self, turn: bytes, skeleton: int | None):
        self.turn, self.skeleton = turn, skeleton
        self.low, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.pending, self.named = None, [], False


def _scan(skeleton):
    """Finished nodes and partial skeleton nodes of a task's sorted paths."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared_value(skeleton)
        stack, rows, shard_now, path_now = [], [], None, b""

        def parent_name(depth: int) -> bytes:
            top = stack[depth]
            return top.skeleton.to_bytes(4, "big") if top.skeleton is not None else hashlib.md5(path_now[:depth * TURN]).digest()

        def close() -> None:
            node, depth = stack.pop(), len(stack)
            ends = node.ends.hexdigest() if node.ends else None
            if node.skeleton is not None:
                rows.append((node.skeleton, None, None, node.low, depth, None, node.n, node.children, node.leaves, node.saved, ends))
            else:
                saved = node.saved + (node.n - 1) * int.from_bytes(node.turn[16:], "big")
                leaves = node.leaves if node.children else 1
                mine = [None, None, None, node.low, depth, None, node.n, node.children, leaves, saved, ends or NO_END]
                up = stack[-1]
                up.children, up.leaves, up.saved = up.children + 1, up.leaves + leaves, up.saved + saved
                up.pending.append(mine)
                if len(up.pending) >= PENDING or up.skeleton is not None:
                    name = parent_name(depth - 1)
                    up.named = up.skeleton is None
                    for row in up.pending:
                        row[1] = name
                    rows.extend(up.pending)
                    up.pending = []
                if node.named:
                    rows.append((None, None, hashlib.md5(path_now[:depth * TURN]).digest(), node.low, *[None] * 7))
            for row in node.pending:
                row[5] = node.low
            rows.extend(node.pending)
            if stack:
                up = stack[-1]
                up.n += node.n
                up.low = node.low if up.low is None else min(up.low, node.low)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES, strict=True)], names=[c.split()[0] for c in NODE.split(", ")])
            rows.clear()
            return batch

        for batch in batches:
            for shard, path, n, low, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != shard_now:
                    while stack:
                        close()
                    stack.append(_Open(b"", 0))
                    shard_now, path_now = shard, b""
                i, end = 0, min(len(path), len(path_now))
                while i < end and path[i:i + TURN] == path_now[i:i + TURN]:
                    i += TURN
                while len(stack) > i // TURN + 1:
                    close()
                path_now = path
                for j in range(i, len(path), TURN):
                    turn, up = path[j:j + TURN], stack[-1].skeleton
                    stack.append(_Open(turn, None if up is None else numbers.get((up, turn))))
                top = stack[-1]
                top.n += n
                top.low = low if top.low is None else min(top.low, low)
                if top.ends is None:
                    top.ends = hashlib.sha256(ids.encode())
                else:
                    top.ends.update(b"," + ids.encode())
                if len(rows) >= 20_000:
                    yield flush()
        while stack:
            close()
        if rows:
            yield flush()

    return scan


def _fold(skeleton):
    """Whole skeleton nodes from their summed partial aggregates, from the deepest to the root."""
    def fold(table: pa.Table) -> pa.Table:
        numbers = shared_value(skeleton)
        above = {i: (up, int.from_bytes(turn[16:], "big")) for (up, turn), i in numbers.items()} | {0: (None, 0)}
        nodes = {r["skeleton"]: r for r in table.to_pylist()}
        for i in sorted(nodes, reverse=True):  # a child has a higher number than its parent
            r, (up, length) = nodes[i], above[i]
            r["saved_tokens"] += (r["n_convs"] - 1) * length
            r["n_leaves"] = r["n_leaves"] if r["n_children"] else 1
            if up is not None:
                nodes[up]["n_children"] += 1
                nodes[up]["n_leaves"] += r["n_leaves"]
                nodes[up]["saved_tokens"] += r["saved_tokens"]
        out = []
        for i, r in nodes.items():
            up = above[i][0]
            out.append(r | {"name": i.to_bytes(4, "big"), "parent_conv_id": None if up is None else nodes[up]["conv_id"], "ends_sha256": r["ends_sha256"] or NO_END})
        return pa.table({c: pa.array([r[c] for r in out], pa.string() if c == "ends_sha256" else pa.int64()) for c in COLUMNS} | {"name": pa.array([r["name"] for r in out], pa.binary())})

    return fold


def build_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS, skeleton_nodes: int = MAX_SKELETON) -> DataFrame:
    """One row for each distinct sequence of the first d turns of `turns` (conv_id, turns), as `ordered_turns` gives them.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs (members), n_children, n_leaves (childless nodes of
    the subtree), saved_tokens (over the subtree, characters of the last text times members but one) and ends_sha256 (of the sorted,
    comma-joined ids of the conversations that end here). A subtree includes its top; the root has depth 0 and no text.

    Conversations without turns are members of the root and end there. conv_ids are distinct and not null, as in the result of
    `ordered_turns`. Without any conversation the result is empty. `shard_turns` is the work of a shard and `skeleton_nodes` the
    size of what is broadcast; neither changes the result. A conversation's path (24 bytes a turn, no text) has to fit in memory.
    """
    spark = turns.sparkSession
    path = F.unhex(F.array_join("turns", ""))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    cells = materialise(turns.select("conv_id", path.alias("path")).groupBy("path", F.shiftright("conv_id", IDS).alias("block"))
                        .agg(F.count("*").alias("n"), F.min("conv_id").alias("low"), ids.alias("ids")))
    work = cells.agg(F.sum(F.octet_length("path") / TURN + 1)).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = min(MAX_SHARDS, max(width, int(work // shard_turns) + 1))
    splitters = choose_splitters(cells, shards, skeleton_nodes)
    cuts, skeleton = share(spark, splitters), share(spark, skeleton_of(splitters))
    dealt = cells.select("path", "block", "n", "low", "ids").mapInArrow(_shard(cuts), "shard int, path binary, block bigint, n bigint, low bigint, ids string")
    sorted_ = dealt.repartitionById(len(splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "block").select("shard", "path", "n", "low", "ids")
    found = materialise(sorted_.mapInArrow(_scan(skeleton), NODE))
    parts = found.filter("skeleton is not null").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("ends_sha256").alias("ends_sha256"))
    whole = materialise(parts.withColumn("all", F.lit(True)).groupBy("all").applyInArrow(_fold(skeleton), ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'bigint'}" for c in COLUMNS) + ", name binary"))
    named = lambda df: df.select(F.col("name").alias("called"), F.col("conv_id").alias("up"))
    names = named(whole).union(named(found.filter("name is not null")))
    local = found.filter("skeleton is null and name is null")
    under = local.filter("parent is not null").join(names, F.col("parent") == F.col("called")).withColumn("parent_conv_id", F.col("up")).select(*COLUMNS)
    return whole.select(*COLUMNS).union(local.filter("parent is null").select(*COLUMNS)).union(under)
