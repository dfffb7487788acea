"""The prefix trie of conversations, built from range-partitioned shards and a broadcast skeleton of splitter paths.

A conversation is the path of its turns' digests. Paths are cut into layers of 256 turns, so that no row grows with a
conversation; a layer's rows carry the digest of all turns before it. Splitters from a bounded sample deal the rows in
path order to shards. A node whose conversations lie in several shards is a prefix of a splitter, so the prefixes of
all splitters, the skeleton, are broadcast: every shard walks its rows in order with a stack of open nodes, finishes all
nodes but those of the skeleton, and gives a partial row for each of these. Partial rows are summed by node, and the
skeleton, which has no more nodes than splitters times 256, is folded from its deepest nodes up.

A sum over a node's subtree is taken within its layer by the walk. For layers below, every node's value belongs to its
smallest member, and what a conversation owns in deeper layers is added to all nodes of its path above.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from advertlake.operators.windows import running_total
from advertlake.session import scratch_path, stage

LAYER = 256
SHARD_ROWS = 100_000  # paths that one task walks through
SAMPLE_PER_SHARD = 24
CHUNK = 1 << 13  # ids that are handed on together
ROOT = bytes(16)
CODE = 16

RECORD = (
    "kind string, node binary, parent binary, depth bigint, words bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, more boolean, shard int, seq bigint, ends string"
)
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ---- conversations as paths


def turn_codes(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, code, words``: a turn's digest of role and text, and the words of its text; texts go no further."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    code = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(code).alias("code"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )


def _shared(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt_turns(codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, at, code, words`` of every rebuilt conversation, ``at`` from 0, and ``conv_id, size`` of all of them.

    Turns are numbered over ranges of (conversation, turn): within a range by a window, across ranges by counts per
    conversation and range, so that a conversation with a large part of all turns is spread over tasks.
    """
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("code")]
    dealt = stage(codes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turns")
    parts = stage(dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n")), "turn-parts")
    # a conversation has as many rows here as there are ranges
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("own")
    )
    convs = parts.groupBy("conv_id").agg(F.max("own").alias("own"))
    bases = convs.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    shared = _shared(F.col("conv_id"))
    info = convs.withColumns({"base": F.expr("conv_id - pmod(conv_id, 20)"), "h": shared}).join(bases, "base", "left")
    info = info.withColumn("taken", F.least(F.col("h"), F.coalesce("base_own", F.lit(0))))
    info = stage(info.select("conv_id", "base", "own", "h", "taken"), "conversations")
    sizes = info.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size"))

    offsets = parts.select("conv_id", "part", "before").join(info.select("conv_id", "h", "taken"), "conv_id")
    within = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "code")
    placed = dealt.withColumn("k", F.row_number().over(within) - 1).join(stage(offsets, "turn-offsets"), ["conv_id", "part"])
    placed = placed.withColumn("i", F.col("before") + F.col("k"))
    placed = stage(placed.select("conv_id", "i", "code", "words", "h", "taken"), "placed-turns")
    own = placed.filter("i >= h").select("conv_id", (F.col("taken") + F.col("i") - F.col("h")).alias("at"), "code", "words")
    heads = placed.filter("conv_id % 20 = 0 AND i < 3").select(F.col("conv_id").alias("base"), F.col("i").alias("at"), "code", "words")
    lent = info.select("conv_id", "base", "taken").join(heads, "base").filter("at < taken").select("conv_id", "at", "code", "words")
    return own.unionByName(lent), sizes


def path_rows(turns: DataFrame, sizes: DataFrame, layer_turns: int = LAYER) -> DataFrame:
    """A row per conversation and layer: ``conv_id, layer, start, path, words, end, more``.

    ``start`` is the digest of all turns before the layer, ``path`` the codes of its turns one behind the other, ``end``
    the digest after a full layer, ``more`` whether turns follow. A conversation without turns has an empty first layer.
    """
    layer = F.floor(F.col("at") / layer_turns).cast("int")
    listed = F.sort_array(F.collect_list(F.struct("at", "code", "words")))  # ``layer_turns`` of them at most
    rows = turns.withColumn("layer", layer).groupBy("conv_id", "layer").agg(listed.alias("t"))
    rows = sizes.join(rows, "conv_id", "left").select(
        "conv_id",
        F.coalesce("layer", F.lit(0)).alias("layer"),
        F.unhex(F.array_join(F.transform(F.coalesce("t", F.array()), lambda x: F.hex(x["code"])), "")).alias("path"),
        F.coalesce(F.col("t.words"), F.array().cast("array<bigint>")).alias("words"),
        "size",
    )
    rows = stage(rows, "paths")
    short = rows.filter(F.col("size") < layer_turns).select(
        "conv_id", "layer", F.lit(ROOT).alias("start"), "path", "words", F.lit(None).cast("binary").alias("end"), F.lit(False).alias("more")
    )
    # Of longer ones: sums of two numbers per layer and place, so that digests of prefixes need no chain over layers.
    digest = F.md5(F.concat(F.col("layer").cast("string").cast("binary"), F.lit(b":"), F.col("path")))
    number = lambda a: F.conv(F.substring(digest, a, 15), 16, 10).cast("decimal(38,0)")
    long = rows.filter(F.col("size") >= layer_turns).withColumns({"a": number(1), "b": number(16)})
    sums = long.select("conv_id", "layer", "a", "b")
    for value in ("a", "b"):
        sums = running_total(sums, by=["conv_id"], position="layer", value=value, output=f"sum_{value}")
    name = lambda after, x, y: F.unhex(F.md5(F.concat_ws("|", after.cast("string"), x.cast("string"), y.cast("string"))))
    whole = F.length("path") == CODE * layer_turns
    sums = sums.select("conv_id", "layer", "a", "b", "sum_a", "sum_b")
    joined = long.drop("a", "b").join(sums, ["conv_id", "layer"]).select(
        "conv_id",
        "layer",
        F.when(F.col("layer") == 0, F.lit(ROOT)).otherwise(name(F.col("layer"), F.col("sum_a") - F.col("a"), F.col("sum_b") - F.col("b"))).alias("start"),
        "path",
        "words",
        F.when(whole, name(F.col("layer") + 1, F.col("sum_a"), F.col("sum_b"))).alias("end"),
        (F.col("size") > (F.col("layer") + 1) * layer_turns).alias("more"),
    )
    return short.unionByName(joined)


# ---- splitters and shards


def _key(layer: int, start: bytes, path: bytes) -> bytes:
    """Bytes whose order is that of paths: layers, prefixes, turns; a prefix comes before what it begins."""
    return layer.to_bytes(4, "big") + start + path


def choose_splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` (key, conversation) pairs in order, from a sample of some rows per shard by hashes.

    Which rows are drawn decides how even the shards are, never the result.
    """
    rows = paths.count()
    if shards < 2 or not rows:
        return []
    part = max(1, rows // (shards * SAMPLE_PER_SHARD))
    drawn = paths.filter(F.pmod(F.xxhash64("conv_id", "layer"), F.lit(part)) == 0)
    keys = sorted((_key(r["layer"], bytes(r["start"]), bytes(r["path"])), r["conv_id"]) for r in drawn.select("layer", "start", "path", "conv_id").collect())
    return sorted({keys[len(keys) * k // shards] for k in range(1, shards)}) if keys else []


def skeleton_of(splitters: list[tuple[bytes, int]]) -> set[bytes]:
    """All prefixes of splitter paths as ``layer, start, turns``: no other node has members on both sides of a splitter."""
    out = set()
    for key, _ in splitters:
        out.update(key[:end] for end in range(4 + CODE, len(key) + 1, CODE))
    return out


@dataclass
class _Open:
    """A node on the walk's stack."""

    key: bytes
    node: bytes
    depth: int
    words: int
    conv: int
    members: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    more: bool = False
    sha: object = None
    chunks: list = field(default_factory=list)
    waiting: list = field(default_factory=list)


def _walk(rows: Iterator[tuple], skeleton: set[bytes], shard: int, layer_turns: int) -> Iterator[tuple]:
    """Records of one shard's nodes; ``rows`` are in order of key and conversation.

    ``final``: a node with all its members here; its parent's smallest member is known unless the parent is of the
    skeleton or ends the layer above. ``partial``: this shard's part of a skeleton node. ``top``: the children, in this
    layer, of a node that ends the layer above. ``ends``: a stretch of the conversations that end at a skeleton node.
    """
    stack: list[_Open] = []
    layer, start = -1, b""

    def close() -> Iterator[tuple]:
        done = stack.pop()
        parent = stack[-1] if stack else None
        above = parent.node if parent else None
        if not stack and layer:
            yield "top", done.node, None, done.depth, None, None, None, None, done.children, None, None, None, shard, None, None
            yield from done.waiting
            return
        split = done.key in skeleton
        if split:
            yield "partial", done.node, above, done.depth, done.words, done.conv, None, done.members, done.children, done.leaves, done.saved, done.more, shard, None, None
            yield from done.waiting
            if done.chunks:
                yield "ends", done.node, None, None, None, None, None, None, None, None, None, None, shard, 1 << 62, ",".join(done.chunks)
        else:
            done.leaves += done.children == 0 and not done.more
            done.saved += (done.members - 1) * done.words
            for r in done.waiting:
                yield (*r[:6], done.conv, *r[7:])
            record = ("final", done.node, above, done.depth, done.words, done.conv, None, done.members, done.children, done.leaves, done.saved, done.more, shard, None,
                      (done.sha or hashlib.sha256()).hexdigest())
            if parent:
                parent.children += 1
                parent.leaves += done.leaves
                parent.saved += done.saved
            # a parent that is split or ends the layer above tells its conversation later
            if parent and parent.key not in skeleton and not (len(stack) == 1 and layer):
                parent.waiting.append(record)
            else:
                yield record

    seq = 0
    for row_layer, row_start, path, words, conv, end, more in rows:
        if (row_layer, row_start) != (layer, start):
            while stack:
                yield from close()
            layer, start = row_layer, row_start
            base = _key(layer, start, b"")
            stack.append(_Open(base, start, layer * layer_turns, 0, conv))
        last = stack[-1].key[len(base) :]
        n = len(path) // CODE
        same = 0
        if path.startswith(last):
            same = len(last) // CODE
        else:
            while path[same * CODE : (same + 1) * CODE] == last[same * CODE : (same + 1) * CODE]:
                same += 1
        while len(stack) > same + 1:
            yield from close()
        for k in range(same, n):
            code = path[k * CODE : (k + 1) * CODE]
            node = end if k + 1 == layer_turns else hashlib.md5(stack[-1].node + code).digest()
            stack.append(_Open(base + path[: (k + 1) * CODE], node, layer * layer_turns + k + 1, words[k], conv))
        for o in stack:
            o.members += 1
            o.conv = min(o.conv, conv)
        tip = stack[-1]
        if more:
            tip.more = True
        elif tip.key in skeleton:
            tip.chunks.append(str(conv))
            if len(tip.chunks) >= CHUNK:
                yield "ends", tip.node, None, None, None, None, None, None, None, None, None, None, shard, seq, ",".join(tip.chunks)
                tip.chunks, seq = [], seq + 1
        elif tip.sha is None:
            tip.sha = hashlib.sha256(str(conv).encode())
        else:
            tip.sha.update(f",{conv}".encode())
    while stack:
        yield from close()


_RECORD_ARROW = pa.schema(
    [("kind", pa.string()), ("node", pa.binary()), ("parent", pa.binary())]
    + [(c, pa.int64()) for c in ("depth", "words", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("more", pa.bool_()), ("shard", pa.int32()), ("seq", pa.int64()), ("ends", pa.string())]
)


def _records(rows: Iterator[tuple], size: int = 5_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _RECORD_ARROW)], schema=_RECORD_ARROW)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _RECORD_ARROW)], schema=_RECORD_ARROW)


def _shard_records(paths: DataFrame, splitters: list[tuple[bytes, int]], layer_turns: int) -> DataFrame:
    spark = paths.sparkSession
    known = spark.sparkContext.broadcast((splitters, skeleton_of(splitters)))

    @F.pandas_udf("int")
    def shard_of(layer: pd.Series, start: pd.Series, path: pd.Series, conv: pd.Series) -> pd.Series:
        bounds = known.value[0]
        return pd.Series([bisect_right(bounds, (_key(a, bytes(b), bytes(c)), d)) for a, b, c, d in zip(layer, start, path, conv)], dtype="int32")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("shard", "layer", "start", "path", "words", "conv_id", "end", "more")))

        skeleton, feed = known.value[1], rows()
        ahead = next(feed, None)
        while ahead is not None:
            shard = ahead[0]

            def of_shard() -> Iterator[tuple]:
                nonlocal ahead
                while ahead is not None and ahead[0] == shard:
                    yield ahead[1:]
                    ahead = next(feed, None)

            yield from _records(_walk(of_shard(), skeleton, shard, layer_turns))

    dealt = paths.withColumn("shard", shard_of("layer", "start", "path", "conv_id"))
    # the order of keys: layer, prefix, path, conversation
    dealt = dealt.repartition(len(splitters) + 1, "shard").sortWithinPartitions("shard", "layer", "start", "path", "conv_id")
    return dealt.mapInArrow(walk, RECORD)


# ---- the skeleton


def _joined_ends(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` from stretches of ids: a digest is taken in order, so one task streams a node's stretches."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            names, digests = [], []
            for now, text in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if now == node:
                    sha.update(b"," + text.encode())
                    continue
                if node is not None:
                    names.append(node)
                    digests.append(sha.hexdigest())
                node, sha = now, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([sha.hexdigest()])], names=["node", "ends_sha256"])

    rows = ends.select("node", "shard", "seq", "ends")
    return rows.repartition("node").sortWithinPartitions("node", "shard", "seq").mapInArrow(digest, "node binary, ends_sha256 string")


def _fold_skeleton(spark: SparkSession, records: DataFrame, layer_turns: int) -> DataFrame:
    """Whole rows of the skeleton's nodes: partial rows summed by node, then folded from the deepest up.

    The summed rows are as many as the skeleton has nodes, at most the number of splitters times a layer's turns.
    """
    parts = records.filter("kind = 'partial'").groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.first("words").alias("words"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("more").alias("more"),
    )
    nodes = {bytes(r["node"]): r.asDict() for r in parts.collect()}
    for name, r in sorted(nodes.items(), key=lambda x: -x[1]["depth"]):
        # children in this layer are all folded by now
        r["n_leaves"] += r["n_children"] == 0 and not r["more"]
        r["saved_tokens"] += (r["n_convs"] - 1) * r["words"]
        # what a layer begins with hangs below a node of the layer above, whose sums it does not enter here
        if r["parent"] is not None and ((r["depth"] - 1) % layer_turns or r["depth"] == 1):
            above = nodes[bytes(r["parent"])]
            above["n_children"] += 1
            above["n_leaves"] += r["n_leaves"]
            above["saved_tokens"] += r["saved_tokens"]
    fields = ["node", "parent", "depth", "words", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "more"]
    schema = "node binary, parent binary, depth bigint, words bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, more boolean"
    return spark.createDataFrame([tuple(r[f] for f in fields) for r in nodes.values()], schema)


# ---- layers below


def _deeper_sums(nodes: DataFrame, paths: DataFrame, layer_turns: int) -> DataFrame:
    """``node, deep_leaves, deep_saved``: what the layers below add to the nodes of conversations that go on there.

    A node's own value belongs to its smallest member. Summed from a conversation's last layer up, this gives what it
    owns below each of its layers, and every node of that layer on its path gets it.
    """
    own = nodes.filter(F.col("depth") > layer_turns).groupBy("conv_id", F.floor((F.col("depth") - 1) / layer_turns).cast("int").alias("layer"))
    leaf = ((F.col("n_children") == 0) & ~F.col("more")).cast("bigint")
    own = own.agg(F.sum(leaf).alias("leaves"), F.sum((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    going_on = paths.filter(F.col("more") | (F.col("layer") > 0)).select("conv_id", "layer").join(own, ["conv_id", "layer"], "left")
    totals = going_on.fillna(0, ["leaves", "saved"]).withColumn("up", -F.col("layer"))
    for value in ("leaves", "saved"):
        totals = running_total(totals, by=["conv_id"], position="up", value=value, output=f"all_{value}")
    below = totals.select("conv_id", "layer", (F.col("all_leaves") - F.col("leaves")).alias("deep_leaves"), (F.col("all_saved") - F.col("saved")).alias("deep_saved"))
    below = below.filter("deep_leaves <> 0 OR deep_saved <> 0")

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, leaves, saved = [], [], []
            for layer, start, path, end, a, b in zip(*(batch.column(c).to_pylist() for c in ("layer", "start", "path", "end", "deep_leaves", "deep_saved"))):
                node, on_path = start, [] if layer else [start]
                for k in range(len(path) // CODE):
                    node = end if k + 1 == layer_turns else hashlib.md5(node + path[k * CODE : (k + 1) * CODE]).digest()
                    on_path.append(node)
                names += on_path
                leaves += [a] * len(on_path)
                saved += [b] * len(on_path)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], names=["node", "deep_leaves", "deep_saved"])

    rows = paths.join(below, ["conv_id", "layer"]).select("layer", "start", "path", "end", "deep_leaves", "deep_saved")
    added = rows.mapInArrow(along, "node binary, deep_leaves bigint, deep_saved bigint")
    return added.groupBy("node").agg(F.sum("deep_leaves").alias("deep_leaves"), F.sum("deep_saved").alias("deep_saved"))


def prefix_trie(conversations: DataFrame, *, layer_turns: int = LAYER, shards: int | None = None) -> DataFrame:
    """All nodes of the trie of rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    A conversation begins with up to three turns of the one with the next lower id divisible by 20, as its id's checksum
    says, and goes on with its own turns behind as many. A null role or text is empty, null turns come first, equal turns
    go by the digest of role and text, repeated rows count each. Rows without a conversation's id are left out. A table
    without conversations has no node. Other columns are not read. Turns are compared by digests of 128 bits.
    """
    spark = conversations.sparkSession
    turns, sizes = rebuilt_turns(turn_codes(conversations))
    paths = stage(path_rows(turns, sizes, layer_turns), "path-rows")
    if shards is None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = max(least, -(-paths.count() // SHARD_ROWS))
    records = stage(_shard_records(paths, choose_splitters(paths, shards), layer_turns), "trie-records", scratch_path(spark, "trie-records"))
    skeleton = _fold_skeleton(spark, records, layer_turns)
    empty = hashlib.sha256().hexdigest()
    ends = _joined_ends(records.filter("kind = 'ends'"))
    whole = ["node", "parent", "depth", "words", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "more"]
    split = skeleton.join(ends, "node", "left").select(*whole, F.lit(None).cast("bigint").alias("parent_conv_id"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
    final = records.filter("kind = 'final'").select(*whole, "parent_conv_id", F.col("ends").alias("ends_sha256"))
    nodes = final.unionByName(split)
    first = F.col("conv_id").alias("above")
    # the skeleton's nodes: at most the splitters times a layer's turns
    known = F.broadcast(skeleton.select(F.col("node").alias("parent"), first))
    nodes = nodes.join(known, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).drop("above")
    if not paths.filter("more").isEmpty():
        nodes = stage(nodes, "layer-nodes")
        begins = (F.col("depth") > 1) & ((F.col("depth") - 1) % layer_turns == 0)
        ended = (F.col("depth") > 0) & (F.col("depth") % layer_turns == 0)
        tops = records.filter("kind = 'top'").select("node", F.col("n_children").alias("more_children"))
        tops = tops.unionByName(skeleton.filter(begins).select(F.col("parent").alias("node"), F.lit(1).cast("bigint").alias("more_children")))
        tops = tops.groupBy("node").agg(F.sum("more_children").alias("more_children"))
        deep = _deeper_sums(nodes, paths, layer_turns)
        nodes = nodes.join(tops, "node", "left").join(deep, "node", "left")
        nodes = nodes.withColumns(
            {
                "n_children": F.col("n_children") + F.when(ended, F.coalesce("more_children", F.lit(0))).otherwise(0),
                "n_leaves": F.col("n_leaves") + F.coalesce("deep_leaves", F.lit(0)),
                "saved_tokens": F.col("saved_tokens") + F.coalesce("deep_saved", F.lit(0)),
            }
        )
        nodes = stage(nodes.select(*whole, "parent_conv_id", "ends_sha256"), "nodes")
        # a layer's first nodes below a node that one shard finished, which has no more members than a shard has rows
        ending = nodes.filter(ended).select(F.col("node").alias("parent"), first)
        below = nodes.filter(begins & F.col("parent_conv_id").isNull()).drop("parent_conv_id").join(ending, "parent", "left")
        others = nodes.filter(~(begins & F.col("parent_conv_id").isNull()))
        nodes = others.unionByName(below.withColumnRenamed("above", "parent_conv_id"))
    return nodes.select(*COLUMNS)
