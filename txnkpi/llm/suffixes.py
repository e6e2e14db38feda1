"""Substring dedup by prefix-partitioned suffix trees.

Every word that starts ``window`` words of its text is the start of a suffix. Suffixes are
split into groups by a prefix: their first 4 words, or 8, or the whole window where a shorter
prefix has too many suffixes for one group (found by counting every 64th suffix; this only
balances the groups). Prefixes are dealt to as many bins as keep a bin's trees in memory.

A subtree is kept as its leaves in the order of their labels, hashes of the window's words.
Leaves of equal label hang under one internal node at the window's depth: a repeat. Its least
document keeps the words, and all later documents lose them. A node with too many leaves for
one bin, such as a passage that a third of all texts share, is resolved beforehand: its least
document is one aggregate, and its leaves never move.

Labels are 56 bits within a bin: two windows share one by chance with a probability of
2**-56 each time a bin compares them.

Defined cases: NULL and empty texts have no words and lose none; texts shorter than the window
lose none. Rows without an id neither keep words from others nor lose any. Rows with equal
ids lose nothing to each other. An empty table gives an empty result; further columns are
ignored. The kept text has its words joined by one space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnkpi.llm.common import SPACE, Words, binned, bins_for, mix, pieces, small, unpacked, written

#: Words after which a prefix may end; the window's length is the last.
PREFIXES = (4, 8)
#: Suffixes gathered before they are sorted into bins.
FLUSH = 1_500_000
EVERY = 64


@dataclass(frozen=True)
class Settings:
    window: int = 13
    #: Suffixes that a bin should hold.
    group: int = 1_000_000

    @property
    def prefixes(self) -> tuple[int, ...]:
        return (*(p for p in PREFIXES if p < self.window), self.window)


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k, text): k tells apart texts of one id, and is 0 where an id has one text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    keys = rows.filter("id is not null").select("id", F.xxhash64("text").alias("h")).distinct()
    several = keys.groupBy("id").agg(F.count("*").alias("c")).filter("c > 1")
    several = written(several, "several")
    if several.isEmpty():
        return rows.select("id", F.lit(0).alias("k"), "text")
    texts = keys.join(several, "id").groupBy("id").agg(F.array_sort(F.collect_list("h")).alias("hs"))
    texts = written(texts, "texts")
    k = F.coalesce(F.array_position("hs", F.xxhash64("text")) - 1, F.lit(0)).cast("int")
    return rows.join(small(texts), "id", "left").select("id", k.alias("k"), "text")


def _suffixes(batch: pa.RecordBatch, cfg: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Document, place, and hashes of all prefixes of the suffixes, some documents at a time."""
    ids, ks = batch.column("id"), batch.column("k").to_numpy(zero_copy_only=False).astype(np.int64)
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for begin, texts in pieces(batch, "text"):
        words = Words(texts, SPACE)
        at, hashes = words.prefixes(*cfg.prefixes)
        row = words.doc[at] + begin
        keep = known[row]
        if not keep.all():
            at, row, hashes = at[keep], row[keep], [h[keep] for h in hashes]
        yield ids[row], words.place[at] + (ks[row] << 32), hashes


def _among(values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    if not len(chosen):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(chosen, values), len(chosen) - 1)
    return chosen[at] == values


def _hot_prefixes(rows: DataFrame, cfg: Settings) -> list[np.ndarray]:
    """Prefixes, by length, with more suffixes than half a bin, by a count of every 64th."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, hashes in _suffixes(batch, cfg):
                for level, h in enumerate(hashes):
                    values, counts = np.unique(h[::EVERY], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), level), pa.int32()), pa.array(values.view(np.int64)), pa.array(counts, pa.int64())],
                        ["level", "prefix", "count"],
                    )

    counts = rows.mapInArrow(run, "level int, prefix bigint, count bigint")
    counts = counts.groupBy("level", "prefix").agg(F.sum("count").alias("count"))
    hot = counts.filter(F.col("count") * EVERY > cfg.group // 2).select("level", "prefix")
    found = hot.collect()  # at most two for each bin and length
    return [
        np.sort(np.array([r["prefix"] for r in found if r["level"] == i], dtype=np.int64).view(np.uint64))
        for i in range(len(cfg.prefixes))
    ]


def _least_of(rows: DataFrame, nodes: np.ndarray, cfg: Settings) -> np.ndarray:
    """The least document of each of some sorted window labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full(len(nodes), np.iinfo(np.int64).max)
        for batch in batches:
            for docs, _, hashes in _suffixes(batch, cfg):
                hit = _among(hashes[-1], nodes)
                np.minimum.at(least, np.searchsorted(nodes, hashes[-1][hit]), docs[hit])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(nodes))), pa.array(least)], ["node", "doc"])

    found = rows.mapInArrow(run, "node bigint, doc bigint").groupBy("node").agg(F.min("doc").alias("doc"))
    out = np.full(len(nodes), np.iinfo(np.int64).max)
    for row in found.collect():  # as many as there are nodes
        out[row["node"]] = row["doc"]
    return out


def _by_text(docs: np.ndarray, places: np.ndarray, bins: int) -> pa.RecordBatch:
    """Hits dealt to bins by document."""
    bin_of = (mix(docs.astype(np.uint64)) % np.uint64(bins)).astype(np.int32)
    return binned(bin_of, docs, places)


def _gathered(group: pa.Table) -> pa.Table:
    """Rows (id, k, starts) of the hits in a bin of documents, one for each text."""
    docs, places = (x.view(np.int64) for x in unpacked(group.column("block")))
    order = np.lexsort((places, docs))
    docs, places = docs[order], places[order]
    ks, starts = places >> 32, places & 0xFFFFFFFF
    first = np.flatnonzero((np.diff(docs, prepend=~docs[:1]) != 0) | (np.diff(ks, prepend=-1) != 0))
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(docs)), pa.int32()), pa.array(starts, pa.int32()))
    return pa.Table.from_arrays([pa.array(docs[first]), pa.array(ks[first], pa.int32()), lists], ["id", "k", "starts"])


def repeats(rows: DataFrame, cfg: Settings) -> DataFrame:
    """(id, k, starts): windows of each text that an earlier document has."""
    bins = bins_for(rows, "text", cfg.group)
    hot = _hot_prefixes(rows, cfg)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        held = 0
        for batch in batches:
            for docs, places, hashes in _suffixes(batch, cfg):
                key, longer = hashes[0], np.ones(len(docs), dtype=bool)
                for level, h in enumerate(hashes):
                    key = np.where(longer, h, key)
                    longer = longer & _among(h, hot[level])
                stay = ~longer  # leaves of a node that is resolved beforehand
                bin_of = (key % np.uint64(bins)).astype(np.int32)
                parts.append([x[stay] for x in (bin_of, hashes[-1] >> np.uint64(8), docs, places)])
                held += len(docs)
                if held >= FLUSH:
                    yield binned(*(np.concatenate(x) for x in zip(*parts)))
                    parts, held = [], 0
        if held:
            yield binned(*(np.concatenate(x) for x in zip(*parts)))

    def tree(group: pa.Table) -> pa.Table:
        labels, docs, places = unpacked(group.column("block"))
        order = np.argsort(labels, kind="stable")
        labels, docs, places = labels[order], docs[order].view(np.int64), places[order].view(np.int64)
        node = np.flatnonzero(np.diff(labels, prepend=~labels[:1]))
        sizes = np.diff(np.append(node, len(labels)))
        least = np.repeat(np.minimum.reduceat(docs, node), sizes)
        hit = docs > least
        return pa.Table.from_batches([_by_text(docs[hit], places[hit], bins)])

    dealt = rows.mapInArrow(deal, "bin int, block binary")
    found = dealt.groupBy("bin").applyInArrow(tree, "bin int, block binary")
    if len(hot[-1]):
        nodes = hot[-1]
        least = _least_of(rows, nodes, cfg)

        def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for docs, places, hashes in _suffixes(batch, cfg):
                    hit = np.ones(len(docs), dtype=bool)
                    for level, h in enumerate(hashes):
                        hit = hit & _among(h, hot[level])
                    hit[hit] = docs[hit] > least[np.searchsorted(nodes, hashes[-1][hit])]
                    yield _by_text(docs[hit], places[hit], bins)

        found = found.union(rows.mapInArrow(resolved, "bin int, block binary"))
    return found.groupBy("bin").applyInArrow(_gathered, "id bigint, k int, starts array<int>")


def without_repeats(docs: DataFrame, cfg: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: words, removed words, and the text of the kept ones."""
    rows = _numbered(docs, id_col, text_col)
    hits = written(repeats(rows, cfg), "repeats").select(F.col("id").alias("_id"), F.col("k").alias("_k"), "starts")
    joined = rows.join(hits, (F.col("id") == F.col("_id")) & (F.col("k") == F.col("_k")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, texts = [], [], []
            for text, starts in zip(batch.column("text").cast(pa.large_binary()), batch.column("starts")):
                words = (text.as_py() or b"").split()  # at ASCII white space only
                counts.append(len(words))
                if starts.is_valid and len(starts):
                    at = starts.values.to_numpy(zero_copy_only=False)
                    cover = np.bincount(at, minlength=len(words) + 1).astype(np.int64)
                    cover -= np.bincount(at + cfg.window, minlength=len(words) + 1)
                    stay = np.cumsum(cover)[: len(words)] == 0
                    words = [w for w, s in zip(words, stay) if s]
                removed.append(counts[-1] - len(words))
                texts.append(b" ".join(words))
            kept = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), kept],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return joined.select("id", "text", "starts").mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
