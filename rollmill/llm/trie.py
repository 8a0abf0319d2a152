"""Prefix trie of conversations by van Emde Boas recursion, and its totals."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import arrow_schema, written
from rollmill.plans.scale import attach, dense_index, row_index

#: Names are two 64-bit hashes; the root's is fixed.
NAME = "struct<x:bigint,y:bigint>"
ROOT = "named_struct('x', 0L, 'y', 0L)"
#: Rows of a conversation whose turns share all but the last bits are numbered in one window.
TURN_BITS = 8
#: conv_ids that are joined to one string before a node's digest reads them.
ID_BLOCK = 4096


def named(*parts: str | Column) -> Column:
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("x"), F.xxhash64(F.lit(2), *parts).alias("y"))


def ordered_turns(turns: DataFrame) -> DataFrame:
    """Columns conv_id, pos (from 0), token, chars of `turns` (conv_id, turn, role, text).

    By turn, NULL first; rows of one turn by role and text. NULL role or text is empty; rows without conv_id are left out.
    """
    rows = turns.where("conv_id is not null").selectExpr(
        "cast(conv_id as bigint) as conv_id",
        "cast(turn as bigint) as turn",
        "coalesce(role, '') as role",
        "coalesce(text, '') as text",
    )
    rows = rows.select("*", named("role", "text").alias("token"), F.char_length("text").cast("bigint").alias("chars"))
    part = f"shiftright(coalesce(turn, -9223372036854775808L), {TURN_BITS})"
    return row_index(rows, ["conv_id"], ["turn", "role", "text"], part, "pos").select("conv_id", "pos", "token", "chars")


def with_shared_starts(turns: DataFrame, base: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Sequences rebuilt from `turns` (conv_id, pos, token, chars), and all conv_ids (`conv_id`, `n` turns).

    A conversation begins with the first `shared` (at most `most`) turns of conversation `base`, both expressions of
    conv_id; its own turns after its first `shared` follow. `most` bounds the turns that are gathered per conversation.
    """
    heads = turns.where(F.col("pos") < most).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "token", "chars"))).alias("head"))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = sizes.select("conv_id", "own", base.alias("base"), shared.cast("int").alias("shared"))
    convs = attach(convs, heads.withColumnRenamed("conv_id", "base"), ["base"])
    taken = F.coalesce(F.slice("head", 1, F.col("shared")), F.expr("cast(array() as array<struct<pos:bigint,token:" + NAME + ",chars:bigint>>)"))
    taken = F.when(F.col("shared") > 0, taken).otherwise(F.slice(taken, 1, 0))
    convs = convs.select("conv_id", "shared", taken.alias("taken"), F.greatest(F.col("own") - F.col("shared"), F.lit(0)).alias("rest"))
    convs = written(convs.withColumn("n", F.size("taken") + F.col("rest")), "convs")
    starts = convs.select("conv_id", "n", F.inline("taken"))
    facts = convs.select("conv_id", "n", "shared", F.size("taken").alias("before"))
    own = attach(turns, facts, ["conv_id"]).where("pos >= shared")
    own = own.select("conv_id", "n", (F.col("pos") - F.col("shared") + F.col("before")).alias("pos"), "token", "chars")
    rows = starts.select("conv_id", "n", "pos", "token", "chars").unionByName(own)
    return rows.select("conv_id", "pos", "token", "chars", (F.col("pos") == F.col("n") - 1).alias("last")), convs.select("conv_id", "n")


def block_names(rows: DataFrame) -> list[DataFrame]:
    """Level k: columns conv_id, j, name, chars, last of the full blocks of 2**k turns from turn j * 2**k on."""
    levels = [written(rows.select("conv_id", F.col("pos").alias("j"), F.col("token").alias("name"), "chars", "last"), "blocks")]
    while not levels[-1].where("j > 0").isEmpty():
        sides = [F.max(F.when(F.col("j") % 2 == side, F.col("name")[c])).alias(f"{c}{side}") for side in (0, 1) for c in "xy"]
        pairs = levels[-1].groupBy("conv_id", F.expr("j div 2").alias("j")).agg(*sides).where("x0 is not null and x1 is not null")
        none = [F.lit(None).cast("bigint").alias("chars"), F.lit(None).cast("boolean").alias("last")]
        levels.append(written(pairs.select("conv_id", "j", named("x0", "y0", "x1", "y1").alias("name"), *none), "blocks"))
    return levels


def cut(levels: list[DataFrame], convs: DataFrame) -> list[DataFrame]:
    """All cuts, by level: columns conv_id, slot, root, mid, end (names), chars, last, end_chars, end_last.

    A piece of height 2h is rooted at a depth divisible by 2h. Its sequences are cut at half depth and the cut
    prefixes named from the root's name and the block of h turns above the cut: the upper trie keeps the piece's
    root, the lower forest is rooted at the new names. All pieces of one height are cut in one job, the upper and the
    lower halves then together in the next, down to single turns. A row is one piece of one conversation; `end` is
    the name at its full depth, which an earlier cut gave, so that (mid, root) and (end, mid) lead to a node's ancestor
    h turns up.
    """
    named_so_far = convs.select("conv_id", F.lit(0).cast("bigint").alias("d"), F.expr(ROOT).alias("name"))
    out = []
    for k in range(len(levels) - 1, -1, -1):
        h = 1 << k
        # a position ends one piece and is the root of the next
        spots = named_so_far.select(
            "conv_id", F.inline(F.array(*[F.struct(s.alias("slot"), r.alias("role"), F.col("name").alias("name")) for s, r in (
                (F.expr(f"d div {2 * h}"), F.lit("root")), (F.expr(f"d div {2 * h} - 1"), F.lit("end")))]))
        ).where("slot >= 0").selectExpr("conv_id", "slot", "role", "name", "cast(null as bigint) as chars", "cast(null as boolean) as last")
        blocks = levels[k].selectExpr("conv_id", "j div 2 as slot", "if(j % 2 = 0, 'block', 'after') as role", "name", "chars", "last")
        picked = [
            F.max(F.when(F.col("role") == r, F.col("name")[c])).alias(f"{r}_{c}") for r in ("root", "end", "block") for c in "xy"
        ]
        facts = [F.max(F.when(F.col("role") == r, F.col(c))).alias(f"{n}{c}") for r, n in (("block", ""), ("after", "end_")) for c in ("chars", "last")]
        pieces = spots.unionByName(blocks).groupBy("conv_id", "slot").agg(*picked, *facts).where("block_x is not null")
        cuts = pieces.select(
            "conv_id",
            "slot",
            F.struct(F.col("root_x").alias("x"), F.col("root_y").alias("y")).alias("root"),
            named("root_x", "root_y", "block_x", "block_y").alias("mid"),
            F.when(F.col("end_x").isNotNull(), F.struct(F.col("end_x").alias("x"), F.col("end_y").alias("y"))).alias("end"),
            "chars", "last", "end_chars", "end_last",
        )
        out.append(written(cuts, "cuts"))
        fresh = out[-1].select("conv_id", (F.col("slot") * (2 * h) + h).alias("d"), F.col("mid").alias("name"))
        named_so_far = named_so_far.unionByName(fresh)
    return out[::-1]


def leading_up(cuts: DataFrame, node: str, up: str) -> DataFrame:
    """node, up: each node once."""
    found = cuts.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.first(F.col(up)["x"]).alias("x"), F.first(F.col(up)["y"]).alias("y"))
    return found.select("node", F.struct("x", "y").alias("up"))


def graft(nodes: DataFrame, cuts: list[DataFrame], values: list[str]) -> DataFrame:
    """node and `values`, each summed over the node's subtree (itself included).

    Upwards: what hangs under a root within h turns, doubled level by level. Downwards: the sum of each lower
    piece is grafted on the end of the upper one, and what an end received goes to its own half and to the cut above it.
    """
    sums = lambda: [F.sum(v).alias(v) for v in values]
    below = [written(nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(*sums()), "below")]
    ups = [written(leading_up(c, "mid", "root"), "ups") for c in cuts]
    for up in ups[:-1]:
        moved = attach(below[-1], up, ["node"]).select(F.coalesce("up", "node").alias("node"), *values)
        below.append(written(moved.groupBy("node").agg(*sums()), "below"))
    received = None
    for k in range(len(cuts) - 1, -1, -1):
        own = attach(below[k], ups[k].select("node"), ["node"], "left_semi").select("node", *values)
        if received is not None:
            met = attach(received, leading_up(cuts[k], "end", "mid"), ["node"])
            parts = F.array(*[F.struct(F.col(c).alias("node"), *values) for c in ("node", "up")])
            own = own.unionByName(met.select(F.inline(parts)).where("node is not null"))
        received = written(own.groupBy("node").agg(*sums()), "received")
    top = written(nodes.where("depth > 0").agg(*sums()).select(F.expr(ROOT).alias("node"), *[F.coalesce(v, F.lit(0)).alias(v) for v in values]), "received")
    received = received.unionByName(top) if received is not None else top
    return nodes.select("node", *values).unionByName(received.select("node", *values)).groupBy("node").agg(*sums())


def id_digests(ends: DataFrame) -> DataFrame:
    """node, ends_sha256: of each node's conv_ids, ascending, comma-joined.

    The ids of a node are numbered and joined in blocks wherever they lie; only the blocks, one row for ID_BLOCK
    ids, then pass in order through the digest, which holds one of them at a time.
    """
    placed = dense_index(ends, ["node"], "conv_id", "_i")
    texts = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = placed.groupBy("node", F.expr(f"_i div {ID_BLOCK}").alias("block")).agg(texts.alias("ids"))
    arrow = arrow_schema(ends.sparkSession, "x bigint, y bigint, ends_sha256 string")

    def digested(batches):
        key, digest, done = None, None, []
        for b in batches:
            for x, y, ids in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                if (x, y) != key:
                    if digest:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (x, y), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield rows(done)
            done = []
        if digest:
            yield rows([(*key, digest.hexdigest())])

    def rows(done):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], f.type) for i, f in enumerate(arrow)], schema=arrow)

    dealt = blocks.select("node.x", "node.y", "ids", "block").repartition("x", "y").sortWithinPartitions("x", "y", "block")
    found = dealt.select("x", "y", "ids").mapInArrow(digested, "x bigint, y bigint, ends_sha256 string")
    return found.select(F.struct("x", "y").alias("node"), "ends_sha256")


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `rows` has conv_id, pos (0, 1, ... without gaps), token, chars (of the turn's text) and last; `convs` has every
    conv_id once, those without turns included. A node is a distinct start of a sequence, the root the empty one. Its
    subtree's childless nodes and the characters that its members need not repeat are summed by `graft`. A sequence
    may hold any share of the rows: it is never gathered, only pairs of neighbouring blocks meet. 128-bit hashes
    stand for turns and prefixes. Without conversations there is no node.
    """
    levels = block_names(rows)
    cuts = cut(levels, convs)
    lowest = cuts[0]
    turns = lowest.select(
        "conv_id",
        F.inline(
            F.array(
                *[
                    F.struct(*[F.expr(c).alias(n) for c, n in zip(turn, ("depth", "node", "parent", "chars", "last"), strict=True)])
                    for turn in (
                        ("slot * 2 + 1", "mid", "root", "chars", "last"),
                        ("slot * 2 + 2", "end", "mid", "end_chars", "end_last"),
                    )
                ]
            )
        ),
    ).where("node is not null")
    members = turns.groupBy("node", "depth").agg(
        F.first(F.col("parent")["x"]).alias("x"), F.first(F.col("parent")["y"]).alias("y"),
        F.first("chars").alias("chars"), F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
    )
    members = members.select("node", "depth", F.struct("x", "y").alias("parent"), "chars", "n_convs", "conv_id")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        F.expr(ROOT).alias("node"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast(NAME).alias("parent"),
        F.lit(0).cast("bigint").alias("chars"), "n_convs", "conv_id",
    )
    plain = written(members.unionByName(root), "nodes")
    children = plain.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = attach(plain, children, ["node"]).withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    nodes = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint"))
    nodes = written(nodes.withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("chars")), "nodes")

    totals = graft(nodes.select("node", "depth", "parent", "n_leaves", "saved_tokens"), cuts, ["n_leaves", "saved_tokens"])
    ends = turns.where("last").select("node", "conv_id").unionByName(convs.where("n = 0").select(F.expr(ROOT).alias("node"), "conv_id"))
    named_parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = attach(nodes.drop("n_leaves", "saved_tokens"), totals, ["node"])
    found = attach(found, id_digests(ends), ["node"])
    found = attach(found, named_parents, ["parent"])
    none = F.lit(hashlib.sha256().hexdigest())
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


def shared_start_trie(conversations: DataFrame) -> DataFrame:
    """`prefix_trie` of conversations that start with turns of their hundred's first one: the rule of the registered query.

    conversation c takes its first h turns from c - c % 100 (fewer or none, if that has no more), h = crc32(c) % 6.
    """
    turns = written(ordered_turns(conversations), "turns")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return prefix_trie(*with_shared_starts(turns, F.expr("conv_id - conv_id % 100"), shared, 5))
