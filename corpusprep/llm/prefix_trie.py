"""Prefix trie of conversations: blocks of turns are grouped first, turns only inside blocks where siblings diverge.

A conversation is cut into blocks of a fixed number of turns. The digest of a prefix is the exclusive or of hashes of
(position, turn), 128 bits wide, so that it can be carried across blocks and across tasks: two conversations share a
prefix if their digests at its end agree. Conversations that stand at the same block boundary and go on with the same
block are one group, and all nodes inside that block have the group's members. Only where the blocks differ are their
turns compared one by one.

Every node is owned by its smallest member. What a node sums over its subtree is then a sum over its members plus a
running total along its owner's path, so nothing walks the trie level by level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keyed import measured_lookup
from ..operators.timeline import running_total
from .common import stored

_NODE = ["depth", "a", "b"]
_GROUP = ["k", "s1", "s2"]


@dataclass(frozen=True)
class PrefixTrie:
    """``block``: turns per block. ``segment``: blocks of one conversation that one window or join key holds."""

    block: int = 4
    segment: int = 1024


def turn_digests(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, digest, n_bytes`` for rows of ``conv_id, turn, role, text``; texts are not shuffled.

    Turns are ordered by ``turn``, null first, and numbered from 0; equal turns are ordered by digest, so that the order
    does not depend on the input's. Repeated rows are turns of their own. Null role or text is empty; rows without
    ``conv_id`` belong to no conversation and stay out. Further columns are not read. The numbers come from ranges of
    (conversation, turn), so one long conversation is numbered by many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(said)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    ).filter("conv_id is not null")
    order = ["turn", "digest"]
    ranged = rows.repartitionByRange("conv_id", *order).withColumn("_bucket", F.spark_partition_id())
    cut = stored(ranged.withColumn("_one", F.lit(1).cast("long")), "trie-turns")
    numbered = running_total(cut, ["conv_id"], order, "_one", "_upto")
    return numbered.select("conv_id", (F.col("_upto") - 1).alias("pos"), "digest", "n_bytes")


def with_conversation(rows: DataFrame, convs: DataFrame, size: int) -> DataFrame:
    """Join rows ``conv_id, pos`` to a table with one row per conversation and its ``n_turns``.

    The key is the conversation and ``pos`` in steps of ``size``: a long conversation is spread over many keys.
    """
    last = F.greatest(F.col("n_turns") - 1, F.lit(0))
    parts = convs.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / size))))
    return rows.withColumn("_part", F.floor(F.col("pos") / size)).join(parts, ["conv_id", "_part"]).drop("_part")


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _blocks(digests: DataFrame, how: PrefixTrie) -> DataFrame:
    """A row per conversation and block ``k``: prefix digest at its start (``s1, s2``) and after each turn ``i``
    (``a{i}, b{i}``, null behind the last turn), bytes of the turns' texts (``m{i}``)."""
    hashes = [F.xxhash64(F.lit(seed), "pos", "digest") for seed in (1, 2)]
    turn = F.struct("pos", hashes[0].alias("x"), hashes[1].alias("y"), "n_bytes")
    k = F.floor(F.col("pos") / how.block)
    own = digests.groupBy("conv_id", k.alias("k")).agg(F.sort_array(F.collect_list(turn)).alias("t"))  # <= block turns
    own = own.select(
        "conv_id",
        "k",
        F.floor(F.col("k") / how.segment).alias("seg"),
        F.size("t").cast("long").alias("n"),
        *[F.get("t", F.lit(i))[f].alias(f"{f}{i}") for i in range(how.block) for f in ("x", "y", "n_bytes")],
    )
    whole = {f: own[f"{f}0"] for f in "xy"}
    for i in range(1, how.block):
        whole = {f: _xor(whole[f], F.coalesce(own[f"{f}{i}"], F.lit(0).cast("long"))) for f in "xy"}
    own = own.withColumns({"wx": whole["x"], "wy": whole["y"]})
    # Digests are carried from segment to segment of a conversation, inside a segment from block to block.
    sums = own.groupBy("conv_id", "seg").agg(F.bit_xor("wx").alias("cx"), F.bit_xor("wy").alias("cy"))
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "seg", F.bit_xor("cx").over(before).alias("cx"), F.bit_xor("cy").over(before).alias("cy"))
    inside = Window.partitionBy("conv_id", "seg").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    placed = own.join(carried.filter("seg > 0"), ["conv_id", "seg"], "left")
    placed = placed.withColumns(
        {f"s{i + 1}": _xor(F.coalesce(F.bit_xor(f"w{f}").over(inside), zero), F.coalesce(f"c{f}", zero)) for i, f in enumerate("xy")}
    )
    after, at = [], {"x": F.col("s1"), "y": F.col("s2")}
    for i in range(how.block):
        at = {f: _xor(at[f], F.col(f"{f}{i}")) for f in "xy"}
        after += [at["x"].alias(f"a{i}"), at["y"].alias(f"b{i}"), F.col(f"n_bytes{i}").alias(f"m{i}")]
    return placed.select("conv_id", "k", "seg", "n", "s1", "s2", "wx", "wy", *after)


def _exploded(rows: DataFrame, how: PrefixTrie, *keep: str) -> DataFrame:
    """Rows of blocks to rows of nodes: ``depth``, digest ``a, b``, the parent's ``pa, pb``, bytes ``m``."""
    nodes = F.array(
        *[
            F.struct(
                (F.col("k") * how.block + i + 1).alias("depth"),
                F.col(f"a{i}").alias("a"),
                F.col(f"b{i}").alias("b"),
                F.col(f"a{i - 1}" if i else "s1").alias("pa"),
                F.col(f"b{i - 1}" if i else "s2").alias("pb"),
                F.col(f"m{i}").alias("m"),
            )
            for i in range(how.block)
        ]
    )
    return rows.select(*keep, F.explode(nodes).alias("_v")).filter("_v.a is not null").select(*keep, "_v.*")


def _hash_members(members: DataFrame) -> DataFrame:
    """``depth, a, b, ends_sha256`` over members ``depth, a, b, conv_id`` in numeric order.

    A hash of one list is one sequence of bytes, so it is made by one task; that task reads the list as chunks of text
    that range partitions have joined before, and holds one of them at a time.
    """
    ranged = members.repartitionByRange(*_NODE, "conv_id").withColumn("_part", F.spark_partition_id())
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = ranged.groupBy(*_NODE, "_part").agg(F.array_join(ids, ",").alias("chunk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []

        def flush():
            return pa.RecordBatch.from_pylist(
                [dict(zip(_NODE, k)) | {"ends_sha256": d} for k, d in done],
                pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())]),
            )

        for batch in batches:
            for row in batch.to_pylist():
                now = (row["depth"], row["a"], row["b"])
                if now != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = now, hashlib.sha256(row["chunk"].encode())
                else:
                    digest.update(b"," + row["chunk"].encode())
            yield flush()
            done = []
        if key is not None:
            done.append((key, digest.hexdigest()))
            yield flush()

    sorted_chunks = chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "_part")
    return sorted_chunks.mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(digests: DataFrame, conversations: DataFrame | None = None, how: PrefixTrie = PrefixTrie()) -> DataFrame:
    """The trie of all prefixes of conversations given as ``conv_id, pos, digest, n_bytes`` (:func:`turn_digests`).

    One row per node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes in its subtree, itself included), ``saved_tokens`` (over its subtree,
    what storing each last text once saves, in bytes) and ``ends_sha256`` (hash of the ids of members that end there,
    ascending, joined by commas). ``conv_id`` and ``depth`` identify a node. ``conversations`` may name further ones
    (column ``conv_id``) without turns: they end at the root. Equal conversations are members of the same nodes. Without
    any conversation there is no node. Positions have to be 0, 1, 2, ... inside a conversation.
    """
    blocks = stored(_blocks(digests, how), "trie-blocks")
    ends = blocks.groupBy("conv_id").agg(
        F.sum("n").alias("depth"), F.bit_xor("wx").alias("a"), F.bit_xor("wy").alias("b")
    )
    zero = F.lit(0).cast("long")
    if conversations is not None:
        named = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).filter("conv_id is not null").distinct()
        silent = named.join(ends, "conv_id", "left_anti")
        ends = ends.unionByName(silent.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b")))
    ends = stored(ends, "trie-ends")

    # Blocks that start at the same prefix: members, and whether all go on alike.
    e1, e2 = (F.coalesce(*[F.col(f"{f}{i}") for i in reversed(range(how.block))]) for f in "ab")
    turn_columns = [f"{f}{i}" for i in range(how.block) for f in "abm"]
    groups = blocks.groupBy(*_GROUP).agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("owner"),
        ((F.min(e1) == F.max(e1)) & (F.min(e2) == F.max(e2))).alias("straight"),
        *[F.min(c).alias(c) for c in turn_columns],  # one value each where the group is straight
    )
    groups = stored(groups, "trie-groups")
    several = groups.filter("n_convs > 1").select(*_GROUP, "straight")
    shared = stored(measured_lookup(blocks, several, _GROUP, ["conv_id"], "inner"), "trie-shared")
    refined = _exploded(shared.filter("not straight"), how, "conv_id").groupBy(*_NODE).agg(
        *[F.min(c).alias(c) for c in ("pa", "pb", "m")], F.count("*").alias("n_convs"), F.min("conv_id").alias("owner")
    )
    alike = _exploded(groups.filter("straight"), how, *_GROUP, "n_convs", "owner")
    null = F.lit(None).cast("long")
    root = ends.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("owner")).filter("n_convs > 0")
    root = root.select(
        *[zero.alias(c) for c in _NODE], null.alias("pa"), null.alias("pb"), zero.alias("m"), "n_convs", "owner"
    )
    # ``_by`` is what a node's sums over members are grouped by: its group of blocks, or the node itself.
    keyed = {"_by": F.struct(F.lit(True).alias("straight"), *[F.col(x).alias(y) for x, y in zip(_GROUP, _NODE)])}
    alone = {"_by": F.struct(F.lit(False).alias("straight"), *_NODE)}
    nodes = alike.withColumns(keyed).drop(*_GROUP).unionByName(refined.unionByName(root).withColumns(alone))

    counted = stored(ends.groupBy(*_NODE).agg(F.count("*").alias("n_ends"), F.min("conv_id").alias("_only")), "trie-counts")
    crowd = measured_lookup(ends, counted.filter("n_ends > 1").select(*_NODE), _NODE, ["conv_id"], "inner")
    one = counted.filter("n_ends = 1").select(*_NODE, F.sha2(F.col("_only").cast("string"), 256).alias("ends_sha256"))
    hashed = one.unionByName(_hash_members(crowd.select(*_NODE, "conv_id")))
    hashed = hashed.join(counted.select(*_NODE, "n_ends"), _NODE)
    nodes = nodes.join(hashed, _NODE, "left").select(
        *nodes.columns,
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        F.coalesce(F.col("n_ends") == F.col("n_convs"), F.lit(False)).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("m")).alias("value"),
        F.floor(F.col("depth") / (how.segment * how.block)).alias("seg"),
    )
    nodes = stored(nodes, "trie-nodes")

    # Along each owner's path: where it starts to own, where it ends, the value it owns in all and before a segment.
    parts = nodes.groupBy("owner", "seg").agg(
        F.sum("value").alias("value"), F.min("depth").alias("low"), F.max("depth").alias("high"), F.max("leaf").alias("leaf")
    )
    path = Window.partitionBy("owner")
    earlier = path.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    owned = parts.select(
        "owner",
        "seg",
        F.coalesce(F.sum("value").over(earlier), zero).alias("before"),
        F.min("low").over(path).alias("first"),
        F.max("high").over(path).alias("last"),
        F.sum("value").over(path).alias("total"),
        F.max("leaf").over(path).alias("owns_leaf"),
    )
    owned = stored(owned, "trie-owners")
    inside = Window.partitionBy("owner", "seg").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = nodes.join(owned.select("owner", "seg", "before", "first", "last"), ["owner", "seg"]).withColumn(
        "before", F.col("before") + F.coalesce(F.sum("value").over(inside), zero)
    )
    placed = stored(placed, "trie-placed")

    # Sums over members, only where a node has several.
    worth = owned.groupBy(F.col("owner").alias("conv_id")).agg(
        F.max("last").alias("n_turns"), F.max("total").alias("total"), F.max("owns_leaf").alias("owns_leaf")
    )
    worth = worth.filter("total > 0 or owns_leaf > 0")
    members = with_conversation(shared.withColumn("pos", F.col("k") * how.block), worth, how.segment * how.block)
    added = [F.sum("total").alias("sum_total"), F.sum("owns_leaf").alias("sum_leaves")]
    sums = (
        members.filter("straight").withColumns(keyed).groupBy("_by").agg(*added)
        .unionByName(
            _exploded(members.filter("not straight"), how, "total", "owns_leaf").withColumns(alone).groupBy("_by").agg(*added)
        )
        .unionByName(
            worth.agg(*added).select(
                F.struct(F.lit(False).alias("straight"), *[zero.alias(c) for c in _NODE]).alias("_by"), "sum_total", "sum_leaves"
            )
        )
    )

    # A node's first owner hangs below a node of another owner; all other nodes hang below their own owner's.
    tops = placed.filter("depth > 0 and depth = first").select(
        (F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"), "owner"
    )
    hung = stored(tops.groupBy(*_NODE).agg(F.count("*").alias("n_hung")), "trie-hung")
    above = hung.select(*_NODE).join(nodes.select(*_NODE, F.col("owner").alias("parent")), _NODE)
    parent = measured_lookup(tops, above, _NODE, ["owner"]).select("owner", (F.col("depth") + 1).alias("depth"), "parent")
    result = placed.join(hung, _NODE, "left").join(sums, "_by", "left").join(parent, ["owner", "depth"], "left")
    alone_here = F.col("n_convs") == 1
    return result.select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > F.col("first"), F.col("owner")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        ((F.col("last") > F.col("depth")).cast("long") + F.coalesce("n_hung", zero)).alias("n_children"),
        F.when(alone_here, F.lit(1).cast("long")).otherwise(F.coalesce("sum_leaves", zero)).alias("n_leaves"),
        F.when(alone_here, zero).otherwise(F.coalesce("sum_total", zero) - F.col("before")).alias("saved_tokens"),
        "ends_sha256",
    )
