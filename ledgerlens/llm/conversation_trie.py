"""Prefix trie of conversations, with counts and savings of every subtree.

A node is a distinct sequence of first turns. Its identity is made of two 64-bit sums (exclusive or)
of the digests of its turns at their places, so identities of all prefixes come from a running sum
and no sequence is ever carried. Conversations are cut into blocks of places with offsets, so one
of any length is spread over tasks.

Totals of subtrees are rolled up by depth bands. A node adds its values to its ancestors within its
band of BAND depths only. Roots of bands are the nodes of a smaller trie, BAND times less deep,
which is rolled up in the same way; then completed totals of band roots are added to the ancestors
in the band above. A node is copied at most BAND times a level, and the levels are as many as
the logarithm of the greatest depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.heavy_join import attach
from ledgerlens.sources.scratch import Scratch

#: Fixed values of how conversations are rebuilt from the first one of their family.
FAMILY, HEADS = 20, 4
#: Depths in a band.
BAND = 8
#: Turns in a block of a conversation; a multiple of BAND.
BLOCK_TURNS = 1024
#: Consecutive conv_ids whose texts are joined at once.
ID_BLOCK = 4096

WORD = r"[^\x20\x09-\x0D]+"


def _placed(turns: DataFrame) -> DataFrame:
    """turns with their place (from 1) in their conversation.

    Places are counted within blocks of turn numbers and moved by the sizes of earlier blocks; only
    conversations of several blocks need those.
    """
    order = ["turn", "role", "text"]
    block = F.coalesce(F.expr(f"turn div {BLOCK_TURNS}"), F.lit(-(1 << 62)))
    blocked = turns.withColumn("block", block)
    in_block = Window.partitionBy("conv_id", "block").orderBy(*order)
    in_conversation = Window.partitionBy("conv_id")
    earlier = in_conversation.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy("conv_id", "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(earlier))
        .filter("before is not null")
        .drop("n")
    )
    local = blocked.withColumn("local", F.row_number().over(in_block))
    return local.join(offsets, ["conv_id", "block"], "left").withColumn(
        "place", F.col("local") + F.coalesce("before", F.lit(0))
    )


def _digests(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), words and two digests of every turn, in order of the turns."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
    )
    return _placed(turns).select(
        "conv_id",
        "place",
        F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).cast("long").alias("words"),
        F.xxhash64(F.lit("first"), "role", "text").alias("first"),
        F.xxhash64(F.lit("second"), "role", "text").alias("second"),
    )


def _rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, depth, words and node digests of every turn of the rebuilt conversations.

    Depth 0 is one row a conversation, for the root.
    """
    taken = F.crc32(F.col("conv_id").cast("string")) % HEADS
    digest = ["words", "first", "second"]
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("turns"))
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS))
    # at most three turns of the family's first conversation
    families = heads.groupBy(F.col("conv_id").alias("family")).agg(
        F.array_sort(F.collect_list(F.struct("place", *digest))).alias("heads")
    )
    plans = (
        sizes.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(families, "family", "left")
        .select(
            "conv_id",
            "turns",
            taken.alias("taken"),
            F.slice(F.coalesce("heads", F.array()), F.lit(1), taken.cast("int")).alias("heads"),
        )
    )
    none = F.lit(0).cast("long")
    root = F.struct(
        none.alias("depth"), none.alias("words"), none.alias("first"), none.alias("second")
    )
    from_family = plans.select(
        "conv_id",
        F.inline(
            F.concat(
                F.array(root),
                F.transform(
                    "heads",
                    lambda h: F.struct(
                        h["place"].alias("depth"), *[h[name].alias(name) for name in digest]
                    ),
                ),
            )
        ),
    )
    # only what a conversation takes from its family and how far its own turns move
    shifts = plans.select("conv_id", "taken", (F.size("heads") - F.col("taken")).alias("shift"))
    own = (
        turns.join(shifts, "conv_id")
        .filter(F.col("place") > F.col("taken"))
        .select("conv_id", (F.col("place") + F.col("shift")).alias("depth"), *digest)
    )
    rows = from_family.unionByName(own)
    # a turn's digest at its depth; that of the root is nothing
    at_depth = {
        name: F.when(F.col("depth") == 0, none).otherwise(F.xxhash64(name, "depth"))
        for name in ("first", "second")
    }
    return rows.withColumns(at_depth)


def _prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, words, the node of every prefix (a, b), and whether the conversation ends."""
    block = F.floor(F.col("depth") / F.lit(BLOCK_TURNS))
    in_order = Window.partitionBy("conv_id", "block").orderBy("depth")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    blocked = rows.withColumn("block", block)
    local = blocked.withColumns(
        {
            "a": F.bit_xor("first").over(so_far),
            "b": F.bit_xor("second").over(so_far),
            "follows": F.lead("depth").over(in_order),
        }
    )
    in_conversation = Window.partitionBy("conv_id")
    earlier = in_conversation.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy("conv_id", "block")
        .agg(F.bit_xor("first").alias("first_total"), F.bit_xor("second").alias("second_total"))
        .withColumns(
            {
                "a_before": F.bit_xor("first_total").over(earlier),
                "b_before": F.bit_xor("second_total").over(earlier),
                "last_block": F.max("block").over(in_conversation),
            }
        )
        .filter("last_block > 0")
        .select("conv_id", "block", "a_before", "b_before", "last_block")
    )
    none = F.lit(0).cast("long")
    return local.join(offsets, ["conv_id", "block"], "left").select(
        "conv_id",
        "depth",
        "words",
        F.col("a").bitwiseXOR(F.coalesce("a_before", none)).alias("a"),
        F.col("b").bitwiseXOR(F.coalesce("b_before", none)).alias("b"),
        (F.col("follows").isNull() & (F.col("block") == F.coalesce("last_block", F.lit(0)))).alias("ends"),
    )


def _lineage(prefixes: DataFrame, step: int) -> DataFrame:
    """prefixes at depths that step divides, with the nodes `step` to BAND * step depths above.

    They are the columns a1, b1 (the nearest), a2, b2 and so on, null above the root.
    Blocks of a conversation share BAND rows, so the list is whole in each.
    """
    rows = prefixes.filter(F.col("depth") % step == 0).withColumn("level", F.expr(f"depth div {step}"))
    block = F.expr(f"level div {BLOCK_TURNS}")
    # the last rows of a block also stand in front of the next one, if the conversation goes on
    spread = F.when(
        F.col("level") % BLOCK_TURNS >= BLOCK_TURNS - BAND, F.array(block, block + 1)
    ).otherwise(F.array(block))
    in_order = Window.partitionBy("conv_id", "block").orderBy("level")
    above = {
        f"{name}{up}": F.lag(name, up).over(in_order)
        for up in range(1, BAND + 1)
        for name in ("a", "b")
    }
    return (
        rows.withColumn("block", F.explode(spread))
        .withColumns(above)
        .filter(F.col("block") == block)
        .drop("block", "level")
    )


def _above(first: int, last: int, condition: Column) -> list[Column]:
    """Nodes that many places up as structs, where the condition (of the place) holds."""
    return [
        F.when(condition >= F.lit(up), F.struct(F.col(f"a{up}").alias("a"), F.col(f"b{up}").alias("b")))
        for up in range(first, last + 1)
    ]


def _in_band(nodes: DataFrame, step: int, values: list[str]) -> DataFrame:
    """a, b and values of every node added up over its descendants in its band, itself included."""
    inside = F.expr(f"(depth div {step}) % {BAND}")
    targets = [F.struct("a", "b"), *_above(1, BAND - 1, inside)]
    exploded = nodes.select(
        *values, F.explode(F.array_compact(F.array(*targets))).alias("to")
    )
    return exploded.groupBy("to.a", "to.b").agg(*[F.sum(name).alias(name) for name in values])


def _rolled_up(nodes: DataFrame, prefixes: DataFrame, values: list[str], depth: int, scratch: Scratch) -> DataFrame:
    """a, b and the values of every node added up over its whole subtree."""
    step, levels = 1, []
    current = nodes
    while True:
        partial = scratch.table(_in_band(current, step, values), f"band-{step}")
        levels.append((current, partial, step))
        step *= BAND
        if step > depth:
            break
        # band roots, with the roots above them, and what their bands add up to
        lineage = _distinct_lineage(prefixes, step)
        current = scratch.table(lineage.join(partial, ["a", "b"]), f"roots-{step}")

    # the highest level has one band, so its totals are complete
    _, complete, _ = levels.pop()
    while levels:
        level_nodes, partial, step = levels.pop()
        # complete are the totals of the roots of this level's bands; the first band's root has
        # nothing above it
        roots = level_nodes.filter(
            (F.col("depth") > 0) & (F.col("depth") % (step * BAND) == 0)
        ).drop(*values).join(complete, ["a", "b"])
        targets = F.array_compact(F.array(*_above(1, BAND, F.lit(BAND))))
        handed_up = roots.select(*values, F.explode(targets).alias("to")).select("to.a", "to.b", *values)
        complete = scratch.table(
            partial.select("a", "b", *values)
            .unionByName(handed_up)
            .groupBy("a", "b")
            .agg(*[F.sum(name).alias(name) for name in values]),
            f"totals-{step}",
        )
    return complete


def _lineage_names() -> list[str]:
    return [f"{name}{up}" for up in range(1, BAND + 1) for name in ("a", "b")]


def _distinct_lineage(prefixes: DataFrame, step: int) -> DataFrame:
    """One row per node at a depth that step divides; all its members have the same lineage."""
    return (
        _lineage(prefixes, step)
        .groupBy("a", "b", "depth")
        .agg(*[F.first(name).alias(name) for name in _lineage_names()])
    )


def _end_digests(prefixes: DataFrame) -> DataFrame:
    """a, b and ends_sha256 of the nodes some conversation ends at.

    Ids are sorted and joined in blocks of ID_BLOCK consecutive numbers, many tasks for one
    node; the last step only passes the joined texts through the hash, block by block.
    """
    texts = (
        prefixes.filter("ends")
        .groupBy("a", "b", F.floor(F.col("conv_id") / F.lit(ID_BLOCK)).alias("block"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        done: list[tuple[int, int, str]] = []

        def rows() -> pa.RecordBatch:
            a, b, digests = zip(*done, strict=True)
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digests, pa.string())],
                names=["a", "b", "ends_sha256"],
            )

        for batch in batches:
            for a, b, ids in zip(*[batch[name].to_pylist() for name in ("a", "b", "ids")], strict=True):
                if node == (a, b):
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield rows()
        if node is not None:
            done.append((*node, state.hexdigest()))
            yield rows()

    return (
        texts.repartition("a", "b")
        .sortWithinPartitions("a", "b", "block")
        .select("a", "b", "ids")
        .mapInArrow(digest, "a long, b long, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    conversations has conv_id, turn, role and text; other columns are not looked at. Turns are
    ordered by turn, null first, then role and text. Null roles and texts are empty; rows
    without conv_id take no part; repeated rows are turns of their own. Every conversation starts
    with the first h turns of the first one of its family of twenty ids (none if that is absent; a
    negative id's family starts at the multiple of twenty towards zero) and goes on with its own after its first h, h being the CRC of its id modulo four. Columns:
    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. An empty table gives no rows, not even a root. Nodes are
    told apart by 128-bit digests. Runs several jobs when called.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = scratch.table(_digests(conversations), "turns")
    prefixes = scratch.table(_prefixes(_rebuilt(turns)), "prefixes")
    depth = prefixes.agg(F.max("depth")).first()[0] or 0

    members, ends = F.count(F.lit(1)), F.count_if("ends")
    nodes = scratch.table(
        _lineage(prefixes, 1)
        .groupBy("a", "b", "depth")
        .agg(
            F.min("conv_id").alias("conv_id"),
            members.alias("n_convs"),
            ((members - 1) * F.first("words")).alias("saved_tokens"),
            # every member ends here exactly if no turn follows
            F.when(members == ends, 1).otherwise(0).cast("long").alias("n_leaves"),
            *[F.first(name).alias(name) for name in _lineage_names()],
        ),
        "nodes",
    )
    totals = _rolled_up(nodes, prefixes, ["saved_tokens", "n_leaves"], depth, scratch)
    children = (
        nodes.filter("depth > 0")
        .groupBy(F.col("a1").alias("a"), F.col("b1").alias("b"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nothing = hashlib.sha256(b"").hexdigest()
    whole = scratch.table(
        nodes.select("a", "b", "a1", "b1", "depth", "conv_id", "n_convs")
        .join(totals, ["a", "b"])
        .join(children, ["a", "b"], "left")
        .join(_end_digests(prefixes), ["a", "b"], "left")
        .withColumns(
            {
                "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
                "ends_sha256": F.coalesce("ends_sha256", F.lit(nothing)),
            }
        ),
        "whole",
    )
    # the root's parent is no node; all others are found, busy parents apart from the rest
    parents = whole.select(
        F.col("a").alias("pa"), F.col("b").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("weight"),
    ).filter("weight > 0")
    child = attach(whole.filter("depth > 0"), parents, {"a1": "pa", "b1": "pb"}, "weight")
    root = whole.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    shown = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    return root.select(*shown).unionByName(child.select(*shown))
