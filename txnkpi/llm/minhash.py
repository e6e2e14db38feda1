"""Near-duplicates by bottom-k sketches from one hash function.

A text's set holds the hashes of its shingles (five words, A-Z in lower case). Texts with
equal sets are one class; everything below is done once for each class.

* A sketch keeps the ``k`` least values of a set. Sets up to ``k`` values are kept whole.
* Inverted lists of the retained values generate candidates. Two sets of the wanted
  similarity share at least ``t`` retained values (exactly so for whole sets; else with a
  probability of failure under ``MISS``), hence one of the ``m - t + 1`` rarest of their
  ``m`` values. Only those go into lists, a value's place in that order bounds what can
  still be shared, and values of a single set make no list at all.
* Pairs in a list are not expanded. The member with the fewest rare values leads; every
  member is compared with the leaders of its lists, and the confirmed links are closed to
  components.
* Sets in lists that still hold several components go through the same with all their values
  retained, where the bounds are exact, and are compared across components only. Lists of many
  members, such as pages of one template that are just not alike, are compared block against
  block inside tasks, which keep links and no other pairs.
* The union sketch (the ``k`` least values of both) estimates the similarity of a candidate
  pair; those that pass are confirmed on their full sets.

Defined cases: a text of fewer words than a shingle is one shingle; NULL, empty and wordless
texts have an empty set and are linked with nothing. Repeated rows are one class; of rows with
equal id and text ``keep_one`` keeps one. Classes, not ids, are compared; texts that share an id
are linked by it, and all rows of a component's least id are kept. Rows with a NULL id link like
others and take their component's least id; where no row of a component has one it is NULL, and
one text is kept. An empty table gives an empty result; further columns are ignored
(``near_duplicates``) or kept (``keep_one``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnkpi.llm.common import BROADCAST_BYTES, SPACE, Words, mix, pieces, reducers_for, row_key, small, written
from txnkpi.llm.components import stars
from txnkpi.sources.paths import scanned_bytes, scratch

#: Chance that a pair right at the limit shares fewer retained values than demanded.
MISS = 1e-9

#: Sketch size that keeps every set whole.
WHOLE = 2**31 - 1

#: What stands for a set: its size and 128 bits.
SET = ["n", "a", "b"]


@dataclass(frozen=True)
class Settings:
    #: Similarity as a percentage, shingle length in words, sketch size.
    percent: int = 85
    shingle: int = 5
    k: int = 256
    #: Lists of more members are compared block by block; values in a block's sets together.
    long_list: int = 256
    block_values: int = 1_000_000

    @property
    def sure(self) -> int:
        """Retained values that two sketches of the wanted similarity share at least."""
        p, below, t = self.percent / 100, 0.0, 0
        while self.k < WHOLE:
            below += math.comb(self.k, t) * p**t * (1 - p) ** (self.k - t)
            if below > MISS:
                return t
            t += 1
        return 0  # whole sets have exact bounds

    @property
    def whole(self) -> int:
        """Sets up to this size have no partner whose sketch is not whole."""
        return self.k * self.percent // 100


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; texts are in lower case already."""
    words = Words(texts, SPACE)
    at, hashes = words.windows(size)
    bounds = np.searchsorted(at, words.first)
    ends = np.append(bounds[1:], len(at))
    sets = []
    for i, n in enumerate(words.count):
        if n >= size:
            sets.append(np.unique(hashes[bounds[i] : ends[i]]))
        elif n:
            value = np.array([n], dtype=np.uint64)
            for h in words.hash[words.first[i] : words.first[i] + n]:
                value = mix(value + h)
            sets.append(value)
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def _signed(values: np.ndarray) -> np.ndarray:
    """Order-preserving: least unsigned value to least signed value."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)])
    values = _signed(np.concatenate([*arrays, np.zeros(0, dtype=np.uint64)]))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def _key(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    one, two = mix(values), mix(values + np.uint64(0x51ED270B))
    return tuple(np.array([one.sum(), two.sum()], dtype=np.uint64).view(np.int64).tolist())


def set_keys(docs: DataFrame, cfg: Settings, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, n, a, b): each row's set size, and 128 bits that stand for the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, texts in pieces(batch, "text", lower=True):
                rows += [(len(s), *_key(s)) for s in shingle_sets(texts, cfg.shingle)]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["_id", "_h", *SET])

    rows = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    rows = rows.withColumn("_id", F.col("_id").cast("bigint"))
    return rows.mapInArrow(run, "_id bigint, _h bigint, n bigint, a bigint, b bigint")


def sets_of(texts: DataFrame, cfg: Settings, most: int | None = None) -> DataFrame:
    """(n, a, b, values) of texts: the set's least ``most`` values in order, or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, docs in pieces(batch, "text", lower=True):
                sets = [s for s in shingle_sets(docs, cfg.shingle) if len(s)]
                keys = list(zip(*map(_key, sets))) or [(), ()]
                columns = [pa.array(c, pa.int64()) for c in ([len(s) for s in sets], *keys)]
                yield pa.RecordBatch.from_arrays([*columns, _lists([s[:most] for s in sets])], [*SET, "values"])

    return texts.select("text").mapInArrow(run, "n bigint, a bigint, b bigint, values array<bigint>")


@dataclass(frozen=True)
class Corpus:
    """Texts reduced to classes of equal sets.

    ``doc`` numbers a class: the first half of its set's 128 bits, or, where classes share
    that, a hash of all of them. ``rows`` has (_id, _h, n, doc, first) for every row, where
    ``first`` marks the rows of the class's least (id, text).
    """

    docs: DataFrame
    cfg: Settings
    id_col: str
    text_col: str
    rows: DataFrame
    classes: DataFrame
    shared: DataFrame | None
    repeated: DataFrame | None

    def texts(self, wanted: DataFrame, how: str) -> DataFrame:
        """(text), one of each pair of id and text, of rows that are, or are not, in written (_id, _h)."""
        rows = self.docs.select(*row_key(self.id_col, self.text_col), F.col(self.text_col).alias("text"))
        rows = rows.withColumn("_id", F.col("_id").cast("bigint"))
        rows = rows.join(small(wanted), _same_row(rows, wanted), how)
        if self.repeated is not None:
            twice = small(self.repeated)
            once = rows.join(twice, _same_row(rows, twice), "left_anti")
            rows = once.unionByName(rows.join(twice, _same_row(rows, twice), "left_semi").dropDuplicates(["_id", "_h"]))
        return rows

    def sets(self, texts: DataFrame, most: int | None = None) -> DataFrame:
        """(doc, n, values) of texts."""
        return _numbered(sets_of(texts, self.cfg, most), self.shared).select("doc", "n", "values")


def _same_row(rows: DataFrame, wanted: DataFrame) -> Column:
    return rows["_id"].eqNullSafe(wanted["_id"]) & (rows["_h"] == wanted["_h"])


def _numbered(rows: DataFrame, shared: DataFrame | None) -> DataFrame:
    """Adds ``doc`` to rows (n, a, b)."""
    if shared is None:
        return rows.withColumn("doc", F.col("a"))
    other = F.xxhash64("n", "b", "a")
    marked = rows.join(small(shared).withColumnRenamed("a", "s"), F.col("a") == F.col("s"), "left")
    return marked.withColumn("doc", F.when(F.col("s").isNotNull(), other).otherwise(F.col("a"))).drop("s")


def _or_none(df: DataFrame, name: str) -> DataFrame | None:
    """A written table, None if it has no rows."""
    return None if df.isEmpty() else written(df, name)


def _keys(rows: DataFrame, name: str) -> DataFrame:
    """Keys for a semi or anti join, written: each once where they are too many to be broadcast."""
    rows = written(rows, name)
    return rows if scanned_bytes(rows) <= BROADCAST_BYTES else written(rows.distinct(), name)


def corpus(docs: DataFrame, cfg: Settings, id_col: str, text_col: str) -> Corpus:
    keyed = written(set_keys(docs, cfg, id_col, text_col), "sets")
    row = F.struct(F.col("_id").isNull().alias("none"), "_id", "_h")
    grouped = keyed.filter("n > 0").groupBy(*SET).agg(F.min(row).alias("rep"), F.min("_id").alias("least"))
    grouped = written(grouped, "grouped")
    shared = _or_none(grouped.groupBy("a").agg(F.count("*").alias("c")).filter("c > 1").select("a"), "shared")
    classes = _numbered(grouped, shared).select(*SET, "doc", "rep", "least")
    classes = classes if shared is None else written(classes, "classes")
    first = F.col("rep._id").eqNullSafe(F.col("_id")) & (F.col("rep._h") == F.col("_h"))
    rows = keyed.join(classes, SET, "left").select("_id", "_h", "n", "doc", F.coalesce(first, F.lit(False)).alias("first"))
    rows = written(rows, "rows")
    repeated = rows.filter("first").groupBy("doc").agg(F.count("*").alias("c"), F.min("_id").alias("_id"), F.min("_h").alias("_h"))
    repeated = _or_none(repeated.filter("c > 1").select("_id", "_h"), "repeated")
    return Corpus(docs, cfg, id_col, text_col, rows, classes, shared, repeated)


def _needed(n: Column, cfg: Settings) -> Column:
    """Retained values that a set of n must share with any partner."""
    return F.when(n <= cfg.whole, F.ceil(n * cfg.percent / 100)).otherwise(cfg.sure)


def _pair_ok(x: str, y: str, cfg: Settings) -> Column:
    """Sizes, and places in the lists, still allow the wanted similarity."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    sizes = 100 * F.least(nx, ny) >= cfg.percent * F.greatest(nx, ny)
    both = F.ceil((nx + ny) * cfg.percent / (100 + cfg.percent) - 1e-9)
    need = F.when((nx <= cfg.k) & (ny <= cfg.k), both).otherwise(cfg.sure)
    return sizes & (F.col(f"{x}.left") >= need) & (F.col(f"{y}.left") >= need)


def lists(sketches: DataFrame, cfg: Settings) -> DataFrame:
    """(value, doc, n, left): the rarest retained values of each set, where shared.

    ``left`` counts the set's retained values from this one on, from rare to common.
    """
    postings = sketches.filter("n > 0").select("doc", "n", F.explode("values").alias("value"))
    counts = postings.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    shared = postings.join(counts, "value").groupBy("doc", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("rare")  # k at most
    )
    spare = F.size("rare") - _needed(F.col("n"), cfg) + 1  # values that occur once come first
    chosen = shared.filter(spare > 0).select("doc", "n", F.size("rare").alias("size"), F.slice("rare", F.lit(1), spare.cast("int")).alias("rare"))
    return chosen.select("doc", "n", "size", F.posexplode("rare").alias("place", "r")).select(
        F.col("r.value").alias("value"), "doc", "n", (F.col("size") - F.col("place")).cast("int").alias("left")
    )


def _star_pairs(members: DataFrame, cfg: Settings) -> DataFrame:
    """Each member of a list with the list's leader, the one with most values left.

    Leaders are a table of their own, so that Spark can split a very long list in the join.
    """
    leaders = members.groupBy("value").agg(F.max(F.struct("left", -F.col("doc"), "n")).alias("l"))
    leaders = leaders.select("value", F.col("l.left").alias("left"), (-F.col("l.col2")).alias("doc"), F.col("l.n").alias("n"))
    leaders = written(leaders, "leaders")
    pairs = members.alias("x").join(leaders.alias("y"), (F.col("x.value") == F.col("y.value")) & _pair_ok("x", "y", cfg))
    return _ordered(pairs.filter("x.doc != y.doc"))


def _mixed(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members, with ``comp``, of lists that hold more than one component."""
    marked = members.join(comp, members["doc"] == comp["node"], "left").select(
        "value", "doc", "n", "left", F.coalesce("component", "doc").alias("comp")
    )
    marked = written(marked, "marked")
    lists = marked.groupBy("value").agg(F.min("comp").alias("c"), F.max("comp").alias("d")).filter("c < d")
    return marked.join(small(written(lists.select("value"), "mixed")), "value", "left_semi")


def _across_pairs(members: DataFrame, cfg: Settings) -> DataFrame:
    """Members of one list whose components (``comp``) differ."""
    pairs = members.alias("x").join(
        members.alias("y"),
        (F.col("x.value") == F.col("y.value")) & (F.col("x.doc") < F.col("y.doc"))
        & (F.col("x.comp") != F.col("y.comp")) & _pair_ok("x", "y", cfg),
    )
    return _ordered(pairs)


def _ordered(pairs: DataFrame) -> DataFrame:
    x, y = F.col("x.doc"), F.col("y.doc")
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, cfg: Settings) -> DataFrame:
    """Pairs (a, b) that reach the similarity: estimated on union sketches, then on full sets."""
    sides = []
    for name in "ab":
        sides.append(sets.select(F.col("doc").alias(name), F.col("n").alias(f"n{name}"), F.col("values").alias(f"v{name}")))
    p = pairs
    for name, side in zip("ab", sides):
        p = p.join(side.withColumn(f"v{name}", F.slice(f"v{name}", 1, cfg.k)), name)
    union = F.slice(F.array_sort(F.array_union("va", "vb")), 1, cfg.k)
    seen = F.size(F.array_intersect(F.array_intersect("va", "vb"), union))
    whole = (F.col("na") <= cfg.k) & (F.col("nb") <= cfg.k)
    shared = F.size(F.array_intersect("va", "vb"))
    exact = 100 * shared >= cfg.percent * (F.col("na") + F.col("nb") - shared)
    p = p.select("a", "b", "na", "nb", whole.alias("whole"), F.when(whole, exact).otherwise(seen >= cfg.sure).alias("ok")).filter("ok")
    p = written(p.select("a", "b", "whole"), "estimated")
    if cfg.k == WHOLE:
        return p.select("a", "b")
    rest = p.filter("not whole")
    for name, side in zip("ab", sides):
        rest = rest.join(side, name)
    rest = rest.filter(100 * shared >= cfg.percent * (F.col("na") + F.col("nb") - shared))
    return written(p.filter("whole").select("a", "b").union(rest.select("a", "b")), "links")


def links(c: Corpus) -> DataFrame:
    """Components (node, component) of linked classes but the least of each."""
    cfg = c.cfg
    others = _keys(c.rows.filter("not first").select("_id", "_h"), "others")
    sketches = written(c.sets(c.texts(others, "left_anti"), cfg.k), "sketches")
    members = written(lists(sketches, cfg), "lists")
    star = written(_star_pairs(members, cfg), "star")
    near = _keys(star.select(F.explode(F.array("a", "b")).alias("doc")), "near")
    sets = written(_full_sets(c, sketches, near), "full")
    confirmed = _confirmed(star, sets, cfg)
    comp = stars(confirmed)
    left = _keys(_mixed(members, comp).select("doc"), "left")
    sets = written(_full_sets(c, sketches, left), "full")
    whole = replace(cfg, k=WHOLE)
    members = written(_mixed(lists(sets, whole), comp), "lists")
    long = members.groupBy("value").agg(F.count("*").alias("c")).filter(F.col("c") > cfg.long_list)
    long = written(long.select("value"), "long")
    across = _across_pairs(members.join(long, "value", "left_anti"), whole).join(star, ["a", "b"], "left_anti")
    more = written(_confirmed(written(across, "across"), sets, cfg).union(_same_ids(c)), "more")
    if not more.isEmpty():
        confirmed = confirmed.union(more)
        comp = stars(confirmed)
    if not long.isEmpty():
        rest = written(_mixed(members.join(long, "value", "left_semi").drop("comp"), comp), "rest")
        more = block_links(rest, sets, cfg)
        comp = comp if more.isEmpty() else stars(confirmed.union(more))
    return comp


def _same_ids(c: Corpus) -> DataFrame:
    """Pairs of classes that hold texts of one id."""
    rows = c.rows.filter("_id is not null and n > 0").select("_id", "doc")
    several = rows.groupBy("_id").agg(F.min("doc").alias("a"), F.max("doc").alias("z")).filter("a < z").drop("z")
    several = _or_none(several, "several")
    if several is None:
        return rows.limit(0).selectExpr("doc as a", "doc as b")
    return rows.join(small(several), "_id").filter("a < doc").select("a", F.col("doc").alias("b")).distinct()


def _full_sets(c: Corpus, sketches: DataFrame, near: DataFrame) -> DataFrame:
    """Sets (doc, n, values) of the classes ``near``: those kept whole, and the large ones anew."""
    wanted = sketches.join(small(near), "doc", "left_semi")
    large = wanted.filter(F.col("n") > c.cfg.k).select("doc")
    large = written(c.classes.join(large, "doc").select("rep._id", "rep._h"), "large")
    return wanted.filter(F.col("n") <= c.cfg.k).unionByName(c.sets(c.texts(large, "left_semi")))


# --- long lists, block against block


class Block:
    """Sets of some classes, and where each value is."""

    def __init__(self, store: fs.FileSystem, base: str, block: int):
        rows = pq.read_table(f"{base}/block={block}", filesystem=store, columns=["doc", "comp", "values"])
        self.doc = rows.column("doc").to_pylist()
        self.comp = rows.column("comp").to_pylist()
        self.sets = [np.array(v, dtype=np.int64) for v in rows.column("values").to_pylist()]
        self.size = np.array([len(s) for s in self.sets])
        values = np.concatenate(self.sets)
        order = np.argsort(values, kind="stable")
        self.value, self.owner = values[order], np.repeat(np.arange(len(self.sets)), self.size)[order]

    def shared(self, values: np.ndarray) -> np.ndarray:
        """How many of these values each set has."""
        first, end = np.searchsorted(self.value, values, "left"), np.searchsorted(self.value, values, "right")
        n = end - first
        at = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        return np.bincount(self.owner[at], minlength=len(self.sets))


def linked(x: Block, y: Block, percent: int) -> Iterator[tuple[int, int]]:
    """Links between classes of two blocks, or within one, that join different components."""
    above: dict[int, int] = {}

    def root(c: int) -> int:
        while c in above:
            c = above[c]
        return c

    for i, values in enumerate(x.sets):
        both = y.shared(values)
        near = np.flatnonzero((both > 0) & (100 * both >= percent * (len(values) + y.size - both)))
        for j in near[near > i] if x is y else near:
            a, b = root(x.comp[i]), root(y.comp[j])
            if a != b:
                above[a] = b
                yield x.doc[i], y.doc[j]


def block_links(members: DataFrame, sets: DataFrame, cfg: Settings) -> DataFrame:
    """Links between different components among written members (value, doc, n, comp) of long lists.

    Members are dealt to blocks of one size, however many reducers sort them, neighbours in a
    list to the same one. Blocks that share a list are compared by one task, which reads both
    files and returns no more links than it takes to join the components: pairs that are no link
    are seen, not stored.
    """
    placed = written(members.groupBy("doc").agg(F.min("value").alias("value"), F.min("comp").alias("comp"), F.min("n").alias("n")), "placed")
    placed = placed.repartitionByRange(reducers_for(placed), "value", "doc").withColumn("part", F.spark_partition_id())
    until = F.sum("n").over(Window.partitionBy("part").orderBy("value", "doc"))
    placed = written(placed.select("doc", "comp", "part", until.alias("until"), (until - F.col("n")).alias("begin")), "placed")
    parts = placed.groupBy("part").agg(F.max("until").alias("all"))  # as many rows as reducers
    parts = parts.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("before"))
    block = F.floor((F.col("before") + F.col("begin")) / cfg.block_values).alias("block")
    blocks = written(placed.join(F.broadcast(parts), "part").select("doc", "comp", block), "placed")
    path = scratch(members.sparkSession, "blocks")
    sets.join(blocks, "doc").select("block", "doc", "comp", "values").repartition("block").write.partitionBy("block").parquet(path)
    held = written(members.select("value", "doc").join(blocks, "doc").select("value", "block").distinct(), "held")
    pairs = held.select("value", F.col("block").alias("x")).join(held.select("value", F.col("block").alias("y")), "value")
    pairs = written(pairs.filter("x <= y").select("x", "y").distinct(), "pairs")
    percent = cfg.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(path)
        last = None
        for batch in batches:
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                last = last if last and last[0] == x else (x, Block(store, base, x))
                other = last[1] if x == y else Block(store, base, y)
                found = list(zip(*linked(last[1], other, percent))) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], ["a", "b"])

    tasks = max(1, min(pairs.count(), 100_000))
    return written(pairs.repartition(tasks).mapInArrow(run, "a bigint, b bigint"), "links")


def near_duplicates(docs: DataFrame, cfg: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: set size, component, and whether it stands for it."""
    return _labelled(docs, cfg, id_col, text_col).select(
        F.col("_id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "kept"
    )


def _labelled(docs: DataFrame, cfg: Settings, id_col: str, text_col: str) -> DataFrame:
    c = corpus(docs, cfg, id_col, text_col)
    comp = links(c)
    named = c.classes.join(comp, c.classes["doc"] == comp["node"], "left").select("doc", "least", F.coalesce("component", "doc").alias("c"))
    named = written(named, "named")
    least = named.groupBy("c").agg(F.min("least").alias("component_id"), F.min("doc").alias("head"))
    named = named.join(least, "c").select("doc", "component_id", (F.col("doc") == F.col("head")).alias("head"))
    rows = c.rows.join(named, "doc", "left")
    component = F.coalesce("component_id", "_id")
    nameless = F.col("doc").isNull() | (F.col("head") & F.col("first"))
    kept = F.when(component.isNull(), nameless).otherwise(F.col("_id").eqNullSafe(component))
    return rows.select("_id", "_h", "n", component.alias("component_id"), kept.alias("kept"))


def keep_one(docs: DataFrame, cfg: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every group of near-duplicates, the one with the least id, columns unchanged."""
    labelled = written(_labelled(docs, cfg, id_col, text_col), "labelled")
    drop = small(written(labelled.filter("not kept").select("_id", "_h").distinct(), "dropped"))
    same = docs[id_col].cast("bigint").eqNullSafe(drop["_id"]) & (F.xxhash64(docs[text_col]) == drop["_h"])
    kept = docs.join(drop, same, "left_anti")
    twice = labelled.filter("kept and n > 0").groupBy("_id", "_h").count().filter("count > 1")
    return kept if twice.isEmpty() else kept.dropDuplicates([id_col, text_col])
