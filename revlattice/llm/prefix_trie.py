"""Prefix tries of conversations and sums over their subtrees.

A prefix is known by its length and a running hash of its turns, so a trie node is a group of equal prefixes. Sums over
subtrees come from parallel tree contraction: every round compresses the chains of nodes with one child by pointer jumping and
rakes the leaves; the removed nodes are expanded again in reverse, each with one join to nodes that stayed longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.llm.common import WORD, dropped, remainder, shuffles_dropped, written

#: Rebuilt conversations borrow up to HEADS - 1 first turns from the first conversation of their family.
FAMILY, HEADS = 20, 4
#: Turns of a conversation are hashed in blocks of this many, so that a very long one is spread.
BLOCK = 4096
#: Bytes of joined ids that travel as one row.
PIECE_BYTES = 65_536
NODE = ["depth", "p", "q"]


def ranked(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, digest, words): the turns of every conversation with their places from 1.

    Turns are sorted over all conversations, so one conversation may span tasks; places add up the pieces before.
    """
    text = F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.md5(text.cast("binary")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    key = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    # Rows that are equal in all of this are told apart, so that many of them are spread as well.
    spread = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*key, "tie").sortWithinPartitions(*key, "tie")
    lined = written(spread.select("conv_id", "role", "digest", "words", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("line")), "turns")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = lined.groupBy("conv_id", "piece").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("n"))
    pieces = pieces.select("conv_id", "piece", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("first")).alias("shift"))
    return lined.join(pieces, ["conv_id", "piece"]).select("conv_id", (F.col("line") + F.col("shift")).alias("place"), "role", "digest", "words")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations (conv_id, size) and their turns (conv_id, depth, role, digest, words, last).

    Conversation c starts with the first h turns of c - c % 20, h = crc32(c) % 4, or all that there are; its own turns after
    its first h follow.
    """
    turns = written(ranked(conversations), "ranked")
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    family = sizes.select("conv_id", "n", remainder("conv_id", HEADS).alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("head"))
    donors = sizes.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("head"), F.col("n").alias("given"))
    borrowed = F.least("h", F.coalesce("given", F.lit(0)))
    convs = family.join(donors, "head", "left").select("conv_id", "head", "h", borrowed.alias("k"), (borrowed + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size"))
    convs = written(convs, "conversations")
    # Places that no conversation gives up need nothing of their conversation but numbers: one row each, never hot.
    own = turns.join(convs, "conv_id").filter("place > h").withColumn("depth", F.col("k") + F.col("place") - F.col("h"))
    first = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS)).withColumnRenamed("conv_id", "head")
    lent = convs.filter("k > 0").join(first, "head").filter("place <= k").withColumn("depth", F.col("place"))
    columns = ["conv_id", "depth", "role", "digest", "words", (F.col("depth") == F.col("size")).alias("last")]
    return convs.select("conv_id", "size"), own.select(*columns).unionByName(lent.select(*columns))


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, depth, p, q, up, uq, words, last): the hash of every conversation's every prefix and of the one before.

    The hash is the exclusive or of 128 bits a turn, which hold its place, so that blocks of turns are hashed apart.
    """
    block = F.shiftright("depth", BLOCK.bit_length() - 1)
    hashed = turns.select(
        "conv_id", "depth", "words", "last", block.alias("block"), F.xxhash64("depth", "role", "digest").alias("a"), F.xxhash64("digest", F.lit("2"), "role", "depth").alias("b")
    )
    hashed = written(hashed, "hashed")
    along = Window.partitionBy("conv_id", "block").orderBy("depth")
    inside = hashed.withColumns({"p": F.bit_xor("a").over(along), "q": F.bit_xor("b").over(along)})
    long = convs.filter(F.col("size") >= BLOCK).select("conv_id")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = hashed.join(long, "conv_id", "left_semi").groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    blocks = blocks.select("conv_id", "block", F.bit_xor("a").over(before).alias("pa"), F.bit_xor("b").over(before).alias("pb"))
    whole = inside.join(blocks, ["conv_id", "block"], "left")
    whole = whole.withColumns({"p": F.col("p").bitwiseXOR(F.coalesce("pa", F.lit(0))), "q": F.col("q").bitwiseXOR(F.coalesce("pb", F.lit(0)))})
    rows = whole.select("conv_id", "depth", "p", "q", F.col("p").bitwiseXOR(F.col("a")).alias("up"), F.col("q").bitwiseXOR(F.col("b")).alias("uq"), "words", "last")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("p"), zero.alias("q"), zero.alias("up"), zero.alias("uq"), zero.alias("words"), (F.col("size") == 0).alias("last"))
    return written(rows.unionByName(roots), "prefixes")


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(id, *values): each value summed over the subtree of every node of ``tree`` (id, parent, *values).

    Roots have a null parent. Every round removes all nodes with one child and all leaves, which is at least half of the
    nodes that have no single child; the jumps inside a round are the logarithm of its longest chain. Nodes with many children
    only ever sum them. No rows give no rows.
    """
    spark = tree.sparkSession
    acc, off, gain, got = ([f"{x}_{v}" for v in values] for x in ("acc", "off", "gain", "got"))
    alive = tree.select("id", "parent", *(F.col(v).alias(a) for v, a in zip(values, acc, strict=True)), *(F.lit(0).cast("long").alias(o) for o in off))
    alive, rounds = written(alive, "alive"), []
    added = lambda names, more, as_names: [(F.col(x) + F.col(y)).alias(z) for x, y, z in zip(names, more, as_names, strict=True)]
    with shuffles_dropped(spark):
        while not alive.isEmpty():
            children = alive.filter("parent is not null").groupBy(F.col("parent").alias("id"))
            children = children.agg(F.count(F.lit(1)).alias("children"), F.min("id").alias("next"), *(F.sum(o).alias(g) for o, g in zip(off, gain, strict=True)))
            marked = written(alive.join(children, "id", "left"), "marked")
            unary = marked.filter("children = 1 AND parent is not null")
            links = written(unary.select("id", "next", *added(gain, acc, gain)), "links")
            links = _jumped(links, gain)
            tops = unary.join(unary.select(F.col("id").alias("parent")), "parent", "left_anti").select("id", "parent", *off)
            relinked = tops.join(links, "id").select(F.col("next").alias("id"), F.col("parent").alias("above"), *added(off, gain, got))
            stays = marked.filter("children is null OR children > 1 OR parent is null").join(relinked, "id", "left")
            stays = stays.select("id", F.coalesce("above", "parent").alias("parent"), "children", *acc, *(F.coalesce(g, o).alias(o) for g, o in zip(got, off, strict=True)))
            stays = written(stays, "compressed")
            leaves = stays.filter("children is null")
            raked = leaves.groupBy(F.col("parent").alias("id")).agg(*(F.sum(F.col(a) + F.col(o)).alias(g) for a, o, g in zip(acc, off, got, strict=True)))
            rest = stays.filter("children is not null").join(raked, "id", "left")
            rest = rest.select("id", "parent", *((F.col(a) + F.coalesce(g, F.lit(0))).alias(a) for a, g in zip(acc, got, strict=True)), *off)
            rounds.append((stays, links))
            done, alive = alive, written(rest, "alive")
            dropped(done)
            dropped(marked)
        totals = None
        for stays, links in reversed(rounds):
            ended = stays.filter("children is null").select("id", *(F.col(a).alias(v) for a, v in zip(acc, values, strict=True)))
            known = ended if totals is None else ended.unionByName(totals)
            expanded = links.join(known.withColumnRenamed("id", "next"), "next").select("id", *added(values, gain, values))
            before, totals = totals, written(known.unionByName(expanded), "totals")
            for table in (stays, links, *([before] if before is not None else [])):
                dropped(table)
    return tree.select("id", *values) if totals is None else totals


def _jumped(links: DataFrame, gain: list[str]) -> DataFrame:
    """Links (id, next, gains) whose next is the first node below that has no link itself, gains summed on the way."""
    while True:
        beyond = links.select(F.col("id").alias("next"), F.col("next").alias("beyond"), *(F.col(g).alias(f"more_{g}") for g in gain))
        jumped = links.join(beyond, "next", "left").select(
            "id", F.coalesce("beyond", "next").alias("next"), *((F.col(g) + F.coalesce(f"more_{g}", F.lit(0))).alias(g) for g in gain), F.col("beyond").isNotNull().alias("moved")
        )
        before, told = links, written(jumped, "jumped")
        links = told.drop("moved")
        moved = not told.filter("moved").isEmpty()
        dropped(before)
        if not moved:
            return links


def id_digests(ends: DataFrame) -> DataFrame:
    """(depth, p, q, ends_sha256): SHA-256 of every node's ``conv_id`` in ascending order, joined by commas.

    Ids are sorted over all nodes and joined into bounded pieces first; the digest of a node then reads its pieces in turn.
    """
    schema = "depth long, p long, q long, piece int, line long, ids binary"

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        piece, line, node, held, length, rows = TaskContext.get().partitionId(), 0, None, [], 0, []

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["depth", "p", "q", "piece", "line", "ids"])

        for some in batches:
            for *new, conv in zip(*(c.to_pylist() for c in some.columns), strict=True):
                if held and (new != node or length >= PIECE_BYTES):
                    rows.append((*node, piece, line, b",".join(held)))
                    line, held, length = line + 1, [], 0
                node = new
                held.append(b"%d" % conv)
                length += len(held[-1]) + 1
            if len(rows) >= 256:
                yield batch()
                rows = []
        if held:
            rows.append((*node, piece, line, b",".join(held)))
        if rows:
            yield batch()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None

        def batch(rows: list) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*NODE, "ends_sha256"])

        for some in batches:
            rows = []
            for *new, ids in zip(*(some.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
                if new == node:
                    running.update(b"," + ids)
                    continue
                if node:
                    rows.append((*node, running.hexdigest()))
                node, running = new, hashlib.sha256(ids)
            if rows:
                yield batch(rows)
        if node:
            yield batch([(*node, running.hexdigest())])

    sorted_ids = ends.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pieces = written(sorted_ids.mapInArrow(joined, schema), "ends")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece", "line").select(*NODE, "ids").mapInArrow(digested, "depth long, p long, q long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per trie node of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``conversations`` is (conv_id, turn, role, text); more columns are ignored. Rows without conv_id belong to no
    conversation. A null turn comes first; turns that share a number go by role, then by the MD5 of their text, and rows equal in
    all of that are turns of their own. Null roles and texts are empty. Without conversations there is no row, not even the root.
    """
    convs, turns = rebuilt(conversations)
    with shuffles_dropped(conversations.sparkSession):
        paths = prefixes(convs, turns)
        nodes = paths.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("up").alias("up"), F.min("uq").alias("uq"), F.max("words").alias("words")
        )
        nodes = written(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
        above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p").alias("up"), F.col("q").alias("uq"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        tree = nodes.join(above, ["depth", "up", "uq"], "left")
        tree = written(tree.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).drop("up", "uq", "words"), "tree")
    children = tree.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = tree.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    weighed = tree.select("id", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    totals = subtree_totals(weighed, ["n_leaves", "saved_tokens"])
    digests = id_digests(paths.filter("last"))
    columns: list[Column | str] = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    none = F.lit(hashlib.sha256(b"").hexdigest())
    whole = reduce(lambda x, y: x.join(*y), [(totals, "id"), (digests, NODE, "left")], tree)
    return whole.select(*columns, F.coalesce("ends_sha256", none).alias("ends_sha256"))
