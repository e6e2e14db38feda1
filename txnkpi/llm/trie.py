"""Prefix trie of conversations by fixed-length block hashing.

Turns of a conversation are dealt to blocks of ``block`` turns. Every turn has a 128-bit digest
of its place, role and text; a block's digest, and that of any prefix, combines those of its
turns by XOR, so prefixes of very long conversations are put together from pieces.

* Conversations are first grouped by successive blocks: rows with the same prefix before a
  block and the same block digest are one class, of which only a count, the least id and one
  copy of the turns' digests go on.
* Where a prefix is followed by one class only, the nodes inside the block are that class,
  turn by turn. Where classes diverge, and only there, the turns of each class are laid out and
  grouped again, turn boundary by turn boundary.
* A node belongs to its smallest member, and a conversation's own nodes are one unbroken run
  down to its end. Sums over subtrees therefore run over the tree of these paths, by doubling
  (as many rounds as the logarithm of its height, each a written table), then along each path.

Places in a conversation come from one range sort; a conversation spread over several of its
partitions, and paths of more than 4,096 turns, are numbered and summed in pieces with what
came before added, so no task holds a whole long conversation. Ids that end at one node are
joined to chunks of text by many tasks and hashed as a stream of these chunks.

Defined cases: turns are ordered by ``turn`` (NULL first), ties by role, then by the text's
MD5; NULL role or text is empty; repeated rows are turns of their own. Rows with a NULL
conversation id belong to none and are left out. An empty table has no root and gives no rows.
A conversation without turns ends at the root. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnkpi.llm.common import reducers_for, small, written

#: Turns in a block; rows of one conversation or path that are numbered or summed in one go.
BLOCK = 4
PIECE = 4096

#: Ids joined to one chunk of text.
CHUNK_IDS = 10_000

NODE = ["depth", "a", "b"]


def turns_in_order(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, pos, role, md5, n): every turn with its place from 0, its text as digest and length."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.md5(text.cast("binary")).alias("md5"),
        F.length(text).cast("bigint").alias("n"),
    ).filter("conv_id is not null")
    order = ["conv_id", "turn", "role", "md5"]
    ranged = rows.repartitionByRange(reducers_for(conversations), *order)
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spread = counts.withColumn("before", F.sum("rows").over(before)).filter("before > 0").drop("rows")
    here = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "md5")
    rows = ranged.withColumn("here", F.row_number().over(here) - 1)
    rows = rows.join(small(written(spread, "spread")), ["conv_id", "part"], "left")
    pos = F.col("here") + F.coalesce("before", F.lit(0))
    return rows.select("conv_id", pos.cast("bigint").alias("pos"), "role", "md5", "n")


def regrafted(turns: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Turns (written) with openings exchanged, and every conversation that had any turn.

    Conversation c starts with the first h turns of conversation c - c % ``every`` (all if it has
    fewer, none if it is absent), h = crc32(c) % (``most`` + 1), and goes on with its own turns
    after its first h. Returns rows like ``turns``.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % (most + 1)
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = turns.filter((F.col("conv_id") % every == 0) & (F.col("pos") < most))
    heads = written(heads.withColumnRenamed("conv_id", "base"), "heads")
    lengths = small(written(heads.groupBy("base").agg(F.count("*").alias("length")), "lengths"))
    convs = turns.select("conv_id").distinct().withColumn("base", base)
    opening = convs.join(small(heads), "base").filter(F.col("pos") < h).drop("base")
    own = turns.filter(F.col("pos") >= h).withColumn("base", base).join(lengths, "base", "left")
    taken = F.least(h, F.coalesce("length", F.lit(0)))
    own = own.select("conv_id", (F.col("pos") - h + taken).alias("pos"), "role", "md5", "n")
    return opening.select("conv_id", "pos", "role", "md5", "n").unionByName(own)


def _running(rows: DataFrame, group: str, place: str, names: list[str], xor: bool = False, back: bool = False) -> DataFrame:
    """Adds ``<name>_run`` to written rows: the XOR of the rows before, or the sum from here to the end.

    Rows of a group are scanned in pieces of ``PIECE`` places; totals of the pieces before (or
    behind, with ``back``) are added.
    """
    rows = rows.withColumn("piece", F.expr(f"{place} div {PIECE}"))
    total = F.bit_xor if xor else F.sum
    order = (lambda c: F.col(c).desc()) if back else F.col
    here = Window.partitionBy(group, "piece").orderBy(order(place)).rowsBetween(Window.unboundedPreceding, 0 if back else -1)
    past = Window.partitionBy(group).orderBy(order("piece")).rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy(group, "piece").agg(*(total(n).alias(n) for n in names))
    carried = pieces.select(group, "piece", F.count("*").over(past).alias("c"), *(total(n).over(past).alias(f"{n}_past") for n in names))
    carried = small(written(carried.filter("c > 0").drop("c"), "carried"))
    rows = rows.select("*", *(total(n).over(here).alias(f"{n}_run") for n in names)).join(carried, [group, "piece"], "left")
    for n in names:
        run, old = F.coalesce(f"{n}_run", F.lit(0)), F.coalesce(f"{n}_past", F.lit(0))
        rows = rows.withColumn(f"{n}_run", run.bitwiseXOR(old) if xor else run + old)
    return rows.drop("piece", *(f"{n}_past" for n in names))


def blocks_of(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, block, size, a, b, turns, a_run, b_run): block digests, and those of what is before."""
    turns = turns.select(
        "conv_id", F.expr(f"pos div {block}").alias("block"), "pos", "n",
        F.xxhash64("pos", "role", "md5").alias("a"), F.xxhash64("md5", F.lit("second"), "pos", "role").alias("b"),
    )
    grouped = turns.groupBy("conv_id", "block").agg(
        F.count("*").alias("size"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
        F.array_sort(F.collect_list(F.struct("pos", "a", "b", "n"))).alias("turns"),  # block entries at most
    )
    return _running(written(grouped, "blocks"), "conv_id", "block", ["a", "b"], xor=True)


def _steps(turns: str, start: str, lane: str) -> Column:
    """Digest of the prefix at each turn boundary of a block, its start first."""
    zero = F.array(F.col(start))
    return F.aggregate(turns, zero, lambda out, t: F.concat(out, F.array(F.element_at(out, -1).bitwiseXOR(t[lane]))))


def _laid_out(classes: DataFrame) -> DataFrame:
    """A row for every turn boundary of every class: node, parent's digests, length of the last text."""
    laid = classes.withColumns({"as": _steps("turns", "a_run", "a"), "bs": _steps("turns", "b_run", "b")})
    laid = laid.select("n_convs", "conv_id", "as", "bs", F.posexplode("turns").alias("i", "t"))
    at = lambda lane, step: F.element_at(lane, F.col("i") + step)
    return laid.select(
        (F.col("t.pos") + 1).alias("depth"), at("as", 2).alias("a"), at("bs", 2).alias("b"),
        at("as", 1).alias("pa"), at("bs", 1).alias("pb"), F.col("t.n").alias("n"), "n_convs", "conv_id",
    )


def nodes_of(blocks: DataFrame) -> DataFrame:
    """(depth, a, b, pa, pb, n, n_convs, conv_id): nodes below the root."""
    start = ["block", "a_run", "b_run"]
    classes = blocks.groupBy(*start, "a", "b", "size").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.any_value("turns").alias("turns")
    )
    classes = written(classes, "classes")
    siblings = classes.groupBy(*start).agg(F.count("*").alias("siblings"))
    classes = written(classes.join(siblings, start), "siblings")
    alone = _laid_out(classes.filter("siblings = 1"))
    refined = _laid_out(classes.filter("siblings > 1")).groupBy(*NODE, "pa", "pb", "n").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    return alone.unionByName(refined)


def hashed_ids(ends: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """(depth, a, b, ends_sha256) of ends (depth, a, b, conv_id): hash of each node's ids in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield rows_of(out)
        if node:
            yield rows_of([(*node, state.hexdigest())])

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*NODE, "ends_sha256"])

    ends = written(ends, "ends")
    ordered = ends.repartitionByRange(reducers_for(ends), *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    chunk = F.expr(f"monotonically_increasing_id() div {chunk_ids}")
    chunks = ordered.withColumn("chunk", chunk).groupBy(*NODE, "chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    chunks = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk")
    return chunks.mapInArrow(run, "depth bigint, a bigint, b bigint, ends_sha256 string")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """Written nodes with n_leaves and saved_tokens summed over their subtrees."""
    sums = ["leaves", "saved"]
    own = nodes.select(
        "conv_id", "depth", "parent_conv_id", (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n")).alias("saved"),
    )
    turned = F.col("parent_conv_id") != F.col("conv_id")
    paths = own.groupBy("conv_id").agg(
        F.max(F.when(turned, F.col("parent_conv_id"))).alias("up"), F.min("depth").alias("top"), *(F.sum(s).alias(s) for s in sums)
    )
    paths = written(paths, "paths")
    tops, climb = paths.select("conv_id", F.col("up").alias("parent"), "top"), paths.drop("top")
    while not climb.filter("up is not null").isEmpty():
        below = climb.filter("up is not null").groupBy(F.col("up").alias("conv_id")).agg(*(F.sum(s).alias(f"{s}_below") for s in sums))
        higher = climb.filter("up is not null").select(F.col("conv_id").alias("up"), F.col("up").alias("higher"))
        climb = climb.join(below, "conv_id", "left").join(higher, "up", "left").select(
            "conv_id", F.col("higher").alias("up"), *((F.col(s) + F.coalesce(f"{s}_below", F.lit(0))).alias(s) for s in sums)
        )
        climb = written(climb, "climb")
    hung = tops.filter("parent is not null").join(climb, "conv_id").groupBy(
        F.col("parent").alias("conv_id"), (F.col("top") - 1).alias("depth")
    ).agg(*(F.sum(s).alias(f"{s}_hung") for s in sums))
    rows = own.join(hung, ["conv_id", "depth"], "left")
    rows = rows.select("conv_id", "depth", *((F.col(s) + F.coalesce(f"{s}_hung", F.lit(0))).alias(s) for s in sums))
    rows = _running(written(rows, "weights"), "conv_id", "depth", sums, back=True)
    return rows.select("conv_id", "depth", F.col("leaves_run").alias("n_leaves"), F.col("saved_run").alias("saved_tokens"))


def trie_of(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of turns (conv_id, pos, role, md5, n) of the written conversations ``convs`` (conv_id).

    One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    blocks = written(blocks_of(turns, block), "chained")
    ends = blocks.groupBy("conv_id").agg(F.sum("size").alias("depth"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    zero = F.lit(0).cast("bigint")
    ends = convs.join(ends, "conv_id", "left").select("conv_id", *(F.coalesce(c, zero).alias(c) for c in NODE))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0").select(
        *(zero.alias(c) for c in NODE), F.lit(None).cast("bigint").alias("pa"), F.lit(None).cast("bigint").alias("pb"),
        zero.alias("n"), "n_convs", "conv_id",
    )
    nodes = written(nodes_of(blocks).unionByName(root), "nodes")
    below = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    below = below.agg(F.count("*").alias("n_children"))
    nodes_with = nodes.join(below, NODE, "left").join(written(hashed_ids(ends), "hashed"), NODE, "left")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    linked = nodes_with.join(parents, ["depth", "pa", "pb"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n", F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    linked = written(linked, "linked")
    return linked.join(_subtree_sums(linked), ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def prefix_trie(conversations: DataFrame, block: int = BLOCK, regraft: bool = False, **columns: str) -> DataFrame:
    """The trie of whole conversations; with ``regraft`` of those with exchanged openings."""
    turns = written(turns_in_order(conversations, **columns), "turns")
    convs = written(turns.select("conv_id").distinct(), "convs")
    return trie_of(regrafted(turns) if regraft else turns, convs, block)
