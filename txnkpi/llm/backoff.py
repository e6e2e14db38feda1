"""Language-model scores by stupid backoff, computed relationally.

The model is the corpus itself. A word after another scores the share of that pair among all
uses of the first word, if at least two documents have the pair: a text cannot vouch for
itself. Any other word scores ``alpha`` times its share among all words. A text begins
after a start mark and ends with an end mark that is scored like a word.

Pairs are exploded once and partitioned by hash, so that each bin holds a part of the count
table together with the pairs to be scored by it:

* Counts of the most frequent words, ``frequent`` at most, are sent to all executors. A pair
  of two such words goes to a bin by the hash of the pair.
* A pair with one rare word goes by the rare one, whose count is the sum of its bin's pairs.
* A pair of two rare words goes both ways: by the first word it is scored if known, by the
  second one if not.
* A pair so frequent that its uses would fill a bin is counted beforehand and scored where it
  is read.

Bins give sums per document in whole millionths of a bit, which do not depend on order.

Defined cases: rows with equal ids, NULL among them, are scored together (``n_words`` then
counts the end marks of all but one). Texts without
words have no score (NULL). Words are separated by ASCII white space, A-Z in lower case. An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnkpi.llm.common import SPACE, Words, binned, bins_for, mix, pieces, unpacked, written

FLUSH = 1_500_000
EVERY = 64
#: Scores are summed in these parts of a bit.
UNIT = 1_000_000
NO_ID = np.iinfo(np.int64).min
#: Word numbers are 56 bits of a hash; the marks have their own.
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)


@dataclass(frozen=True)
class Settings:
    alpha: float = 0.4
    #: Pairs that a bin should hold.
    group: int = 1_000_000
    #: Most words whose counts are sent to all executors.
    frequent: int = 2**18


def _pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document, first and second word of every pair, some documents at a time."""
    ids = batch.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
    for begin, texts in pieces(batch, "text", lower=True):
        words = Words(texts, SPACE)
        full = words.count > 0
        ends = (words.first + words.count)[full]
        second = np.insert(words.hash >> np.uint64(8), ends, END)
        docs = np.insert(words.doc, ends, np.flatnonzero(full))
        first = np.roll(second, 1)
        first[first == END] = START
        yield ids[docs + begin], first, second


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, count) over all texts, with both marks; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for _, first, second in _pairs(batch):
                held += [second, first[first == START]]
                if sum(map(len, held)) >= FLUSH:
                    yield _counted(held)
                    held = []
        if held:
            yield _counted(held)

    counts = rows.mapInArrow(run, "word bigint, count bigint")
    return written(counts.groupBy("word").agg(F.sum("count").alias("count")), "words")


def _counted(parts: list[np.ndarray]) -> pa.RecordBatch:
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts, pa.int64())], ["word", "count"])


class Counts:
    """Sorted keys with their counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Counts of keys, 0 where there is none."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)


def _by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], counts[order]


def _frequent(words: DataFrame, cfg: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The words above the least power of two that leaves ``cfg.frequent`` of them at most."""
    sizes = words.groupBy(F.floor(F.log2("count")).alias("power")).agg(F.count("*").alias("n")).collect()  # 64 at most
    total, least = 0, 64
    for row in sorted(sizes, key=lambda r: -r["power"]):
        total += row["n"]
        if total > cfg.frequent:
            break
        least = row["power"]
    table = words.filter(F.col("count") >= F.lit(2.0**least)).toArrow()  # cfg.frequent at most
    keys = table.column("word").to_numpy().astype(np.int64).view(np.uint64)
    return _by_key(keys, table.column("count").to_numpy().astype(np.int64))


def _hot_pairs(rows: DataFrame, cfg: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that fill more than half a bin, found by every 64th pair: hash, exact count, and
    whether several documents have it."""

    def count(every: int, chosen: np.ndarray | None = None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for docs, first, second in _pairs(batch):
                    docs, pairs = docs[::every], _pair_hash(first, second)[::every]
                    if chosen is not None:
                        keep = Counts(chosen, np.ones(len(chosen), dtype=np.int64)).of(pairs) > 0
                        docs, pairs = docs[keep], pairs[keep]
                    if not len(pairs):
                        continue
                    order = np.lexsort((docs, pairs))
                    docs, pairs = docs[order], pairs[order]
                    at = np.flatnonzero(np.diff(pairs, prepend=~pairs[:1]))
                    size = np.diff(np.append(at, len(pairs)))
                    columns = pairs[at].view(np.int64), size, docs[at], docs[at + size - 1]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["pair", "n", "least", "most"])

        found = rows.mapInArrow(run, "pair bigint, n bigint, least bigint, most bigint")
        return found.groupBy("pair").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))

    some = count(EVERY).filter(F.col("n") * EVERY > cfg.group // 2).select("pair").collect()  # two for each bin at most
    if not some:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    chosen = np.sort(np.array([r["pair"] for r in some], dtype=np.int64).view(np.uint64))
    exact = count(1, chosen).collect()  # the same pairs
    keys = np.array([r["pair"] for r in exact], dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    counts = np.array([r["n"] for r in exact], dtype=np.int64)[order]
    return keys[order], counts, np.array([r["least"] != r["most"] for r in exact], dtype=np.int64)[order]


def _units(share: np.ndarray) -> np.ndarray:
    """Bits of shares in whole units."""
    return np.rint(-np.log2(share) * UNIT).astype(np.int64)


def _summed(docs: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct documents, and the sums of their values."""
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    first = np.flatnonzero(np.diff(docs, prepend=~docs[:1]))
    return [docs[first], *(np.add.reduceat(x[order].astype(np.int64), first) for x in values)]


def _per_doc(bins: int, docs: np.ndarray, units: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
    """Blocks of (document, units, pairs, known pairs), dealt to bins by document."""
    if len(docs):
        docs, units, n, known = _summed(docs, units, np.ones(len(docs)), known)
    else:
        n = docs
    bin_of = (mix(docs.astype(np.uint64)) % np.uint64(bins)).astype(np.int32)
    return binned(bin_of, docs, units, n, known)


def _gathered(group: pa.Table) -> pa.Table:
    """Rows (id, units, n, known) of the documents in a bin."""
    sums = _summed(*(x.view(np.int64) for x in unpacked(group.column("block"))))
    return pa.Table.from_arrays([pa.array(x) for x in sums], ["id", "units", "n", "known"])


BLOCKS = "bin int, block binary"
SUMS = "id bigint, units bigint, n bigint, known bigint"


def pair_scores(rows: DataFrame, cfg: Settings) -> DataFrame:
    """Sums of documents: (id, bits in units, pairs, pairs of the table)."""
    words = word_counts(rows)
    total = words.filter(F.col("word") != int(START)).agg(F.sum("count")).head()[0] or 0
    bins = bins_for(rows, "text", cfg.group)
    context = rows.sparkSession.sparkContext
    sent_words = context.broadcast(_frequent(words, cfg))  # cfg.frequent at most
    hot = _hot_pairs(rows, cfg)  # two for each bin at most
    sent_pairs = context.broadcast(hot)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        held, common, hot = 0, Counts(*sent_words.value), Counts(*sent_pairs.value[:2])
        for batch in batches:
            for docs, first, second in _pairs(batch):
                pair = _pair_hash(first, second)
                rare1, rare2 = common.of(first) == 0, common.of(second) == 0
                stay = (hot.of(pair) == 0) | rare1 | rare2
                to = [(x % np.uint64(bins)).astype(np.int32) for x in (pair, mix(first), mix(second))]
                again = rare2 & ~(rare1 & (to[1] == to[2]))
                for chosen, bin_of in zip((~rare1 & ~rare2, rare1, again), to):
                    chosen = chosen & stay
                    parts.append([bin_of[chosen], first[chosen], second[chosen], docs[chosen]])
                held += len(docs)
                if held >= FLUSH:
                    yield binned(*(np.concatenate(x) for x in zip(*parts)))
                    parts, held = [], 0
        if held:
            yield binned(*(np.concatenate(x) for x in zip(*parts)))

    def score(group: pa.Table) -> pa.Table:
        first, second, docs = unpacked(group.column("block"))
        common = Counts(*sent_words.value)
        own = np.uint64(group.column("bin")[0].as_py())
        docs = docs.view(np.int64)
        order = np.lexsort((docs, second, first))
        first, second, docs = first[order], second[order], docs[order]
        start = np.flatnonzero((np.diff(first, prepend=~first[:1]) != 0) | (np.diff(second, prepend=~second[:1]) != 0))
        size = np.diff(np.append(start, len(first)))
        several = docs[start] != docs[start + size - 1]
        one, two = first[start], second[start]
        count1, count2 = common.of(one), common.of(two)
        rare1, rare2 = count1 == 0, count2 == 0
        here1 = rare1 & (mix(one) % np.uint64(bins) == own)
        here2 = rare2 & (mix(two) % np.uint64(bins) == own)
        count1 = np.where(here1, _sums(one, size, here1), count1)
        count2 = np.where(here2, _sums(two, size, here2), count2)
        # a pair of two rare words is scored where the word that counts is at home
        by_pair = several & (here1 | ~rare1)
        alone = ~several & (here2 | ~rare2)
        share = np.ones(len(start))
        share[by_pair] = size[by_pair] / count1[by_pair]
        share[alone] = cfg.alpha * count2[alone] / max(total, 1)
        scored = by_pair | alone
        each = lambda x: np.repeat(x, size)
        keep = each(scored)
        sums = _per_doc(bins, docs[keep], each(_units(share))[keep], each(by_pair)[keep])
        return pa.Table.from_batches([sums])

    sums = rows.mapInArrow(deal, BLOCKS).groupBy("bin").applyInArrow(score, BLOCKS)
    if len(hot[0]):

        def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common = Counts(*sent_words.value)
            keys, counts, several = sent_pairs.value
            for batch in batches:
                for docs, first, second in _pairs(batch):
                    pair, one, two = _pair_hash(first, second), common.of(first), common.of(second)
                    count, known = Counts(keys, counts).of(pair), Counts(keys, several).of(pair) > 0
                    hit = (count > 0) & (one > 0) & (two > 0)
                    docs, count, known, one, two = (x[hit] for x in (docs, count, known, one, two))
                    units = _units(np.where(known, count / one, cfg.alpha * two / total))
                    yield _per_doc(bins, docs, units, known)

        sums = sums.union(rows.mapInArrow(resolved, BLOCKS))
    return sums.groupBy("bin").applyInArrow(_gathered, SUMS)


def _sums(words: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """For each pair the uses of all chosen pairs with the same word."""
    values, back = np.unique(words, return_inverse=True)
    totals = np.bincount(back, weights=np.where(chosen, sizes, 0), minlength=len(values))
    return totals[back].astype(np.int64)


def backoff_scores(docs: DataFrame, cfg: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: words, how many (and end marks) the table knows after the
    word before, and bits per word and end mark."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sums = pair_scores(rows, cfg).withColumnRenamed("id", "_id")
    joined = rows.select("id").join(sums, F.coalesce("id", F.lit(NO_ID)) == F.col("_id"), "left")
    bits = F.col("units") / UNIT / F.col("n")
    return joined.select(
        F.col("id").alias("doc_id"),
        F.coalesce(F.col("n") - 1, F.lit(0)).cast("bigint").alias("n_words"),
        F.coalesce("known", F.lit(0)).cast("bigint").alias("n_known"),
        bits.alias("bits_per_word"),
    )
