"""Benchmark decontamination by winnowing.

Texts are words (A-Z in lower case). Every run of ``GRAM`` words has a hash, and of every
``SPAN - GRAM + 1`` runs in a row the least hash is kept. Two texts that share ``SPAN`` words
in a row share all hashes of that stretch, and so the kept one: joining kept hashes of rows
and items finds every shared stretch of that length. Hits are then extended: the windows of
``SPAN`` words around a shared hash are compared word by word with those of the items.

An item of fewer words than ``SPAN`` is one window. Winnowing promises nothing for it, so the
windows of its length are compared in all rows; this happens for the lengths that occur.

Native: DataFrame functions only. Rows meet items by hash or by window, never pairwise; no
text moves but those of rows with a shared hash, and these only if the hits are too many to
be sent to all executors.

Defined cases: NULL and empty texts have no words and are clean; items without words have no
window. Repeated rows get equal results. Empty tables give empty results, and an empty
benchmark leaves all rows clean. Further columns are ignored (``contamination``) or kept
(``remove_contaminated``). Items with equal ids count once, items with a NULL id not at all,
though their windows hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnkpi.llm.common import ALNUM, lower_ascii, row_key, small, words, written

SPAN = 10
GRAM = 5


def _words(text: Column) -> Column:
    return words(lower_ascii(text), ALNUM)


def _starts(count: Column, size: int) -> Column:
    """Places, from 0, where windows of ``size`` of ``count`` things start."""
    return F.when(count >= size, F.sequence(F.lit(0), count - size)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(hashes: Column, count: Column) -> Column:
    return F.transform(
        _starts(count, GRAM), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(GRAM)))
    )


def _winnowed(grams: Column, count: Column) -> Column:
    """The least of every ``SPAN - GRAM + 1`` hashes in a row, each once."""
    width = SPAN - GRAM + 1
    least = F.transform(
        _starts(count - GRAM + 1, width), lambda i: F.least(*(F.get(grams, i + j) for j in range(width)))
    )
    return F.array_distinct(least)


def _hashed(df: DataFrame) -> DataFrame:
    """Adds hashes of all runs to a frame with the words in ``w`` and their number in ``n``."""
    return df.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x))).withColumn(
        "g", _gram_hashes(F.col("wh"), F.col("n"))
    )


def _window(w: Column, start: Column, size: Column | int) -> Column:
    return F.array_join(F.slice(w, start + 1, size), " ")


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (window, len, item_id) of the items, with the hash that winnowing keeps of each."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), _words(F.col(text_col)).alias("w"))
    items = _hashed(items.withColumn("n", F.size("w")).filter("n > 0"))
    items = items.withColumn("len", F.least("n", F.lit(SPAN)))
    at = F.explode(F.sequence(F.lit(0), F.col("n") - F.col("len"))).alias("s")
    kept = F.array_min(F.slice("g", F.col("s") + 1, SPAN - GRAM + 1))
    return (
        items.select("item_id", "w", "g", "len", at)
        .select("item_id", "len", _window(F.col("w"), F.col("s"), F.col("len")).alias("window"), kept.alias("hash"))
        .distinct()
    )


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(*row_key(id_col, text_col), _words(F.col(text_col)).alias("w"))
    return texts.withColumn("n", F.size("w"))


def shared_hashes(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (by key) with the kept hashes that they share with an item."""
    hashes = windows.filter(F.col("len") == SPAN).select("hash").distinct()
    rows = _hashed(_rows(docs, id_col, text_col))
    kept = rows.select("_id", "_h", F.explode(_winnowed(F.col("g"), F.col("n"))).alias("hash"))
    return kept.join(small(hashes), "hash").groupBy("_id", "_h").agg(F.collect_set("hash").alias("shared"))


def find_hits(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct (key of the row, start, len, window) of all places where an item's window occurs.

    ``windows`` is a written table of ``item_windows``.
    """
    shared = written(shared_hashes(docs, windows, id_col, text_col), "shared")
    near = small(shared.select(F.col("_id").alias("near_id"), F.col("_h").alias("near_h"), "shared"))
    rows = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("t"))
    rows = rows.join(near, rows["_id"].eqNullSafe(near["near_id"]) & rows["_h"].eqNullSafe(near["near_h"]))
    rows = _hashed(rows.select("_id", "_h", "shared", _words(F.col("t")).alias("w")).withColumn("n", F.size("w")))
    hit = F.filter(_starts(F.col("n"), GRAM), lambda i: F.array_contains("shared", F.get(F.col("g"), i)))
    around = F.transform(
        hit,
        lambda i: F.sequence(
            F.greatest(i - (SPAN - GRAM), F.lit(0)), F.least(i, F.col("n") - SPAN), F.lit(1)
        ),
    )
    starts = rows.filter(F.col("n") >= SPAN).withColumn("s", F.explode(F.array_distinct(F.flatten(around))))
    found = starts.select("_id", "_h", "s", F.lit(SPAN).alias("len"), _window(F.col("w"), F.col("s"), SPAN).alias("window"))
    wanted = windows.select("len", "window").distinct()
    hits = found.join(small(wanted.filter(F.col("len") == SPAN)), ["len", "window"])
    lengths = [r["len"] for r in windows.filter(F.col("len") < SPAN).select("len").distinct().collect()]  # 9 at most
    for size in sorted(lengths):
        all_rows = _rows(docs, id_col, text_col)
        places = all_rows.select("_id", "_h", "w", F.explode(_starts(F.col("n"), size)).alias("s"))
        places = places.select("_id", "_h", "s", F.lit(size).alias("len"), _window(F.col("w"), F.col("s"), size).alias("window"))
        hits = hits.unionByName(places.join(small(wanted.filter(F.col("len") == size)), ["len", "window"]))
    return hits.select("_id", "_h", "s", "len", "window").distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its words, hit words, items, their digest, the verdict."""
    windows = written(item_windows(benchmark, item_id_col, item_text_col), "windows")
    hits = written(find_hits(docs, windows, id_col, text_col), "hits")
    end = F.col("s") + F.col("len")
    before = Window.partitionBy("_id", "_h").orderBy("s", "len").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), end - F.greatest("s", F.coalesce(F.max(end).over(before), F.lit(0))))
    counts = hits.withColumn("new", covered).groupBy("_id", "_h").agg(F.sum("new").alias("n_hit"))
    items = (
        hits.select("_id", "_h", "len", "window").distinct()
        .join(windows.filter("item_id is not null").select("len", "window", "item_id"), ["len", "window"])
        .select("_id", "_h", "item_id").distinct()
        .groupBy("_id", "_h").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )
    same = ["_id", "_h"]
    found = counts.alias("c").join(
        items.alias("i"), (F.col("c._id").eqNullSafe(F.col("i._id"))) & (F.col("c._h") == F.col("i._h")), "left"
    ).select(*(F.col(f"c.{x}").alias(f"f{x}") for x in same), "n_hit", "items")
    found = small(written(found, "found"))
    base = docs.select(*row_key(id_col, text_col), F.size(_words(F.col(text_col))).alias("n_words"))
    joined = base.join(found, base["_id"].eqNullSafe(found["f_id"]) & (base["_h"] == found["f_h"]), "left")
    count = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return joined.select(
        F.col("_id").alias("doc_id"),
        F.col("n_words").cast("bigint").alias("n_words"),
        count.alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        (count > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item's window occurs, all columns unchanged."""
    windows = written(item_windows(benchmark), "windows")
    hits = find_hits(docs, windows, id_col, text_col).select("_id", "_h").distinct()
    hits = small(written(hits, "hits"))
    same = docs[id_col].eqNullSafe(hits["_id"]) & (F.xxhash64(docs[text_col]) == hits["_h"])
    return docs.join(hits, same, "left_anti")
