"""How the sources of a language differ: term counts of each source, compared pair by pair.

Each document becomes an exact sparse count vector by a ``CountVectorizerModel``. Vocabularies
are per language: a term carries its language, so one model holds all of them. They keep every
term that ``min_docs`` documents of the language hold, with no cut in number (the largest integer
as ``vocabSize``). Vectors are summed per (language, source), and everything after that works on
these sums, in whole numbers.

Shares are p = 1 + floor(10^9 (count + 2) / (N + 2 V)) and two shares differ by
f = floor((p - q)^2 / (p + q)). A pair of sources is the sum of f over all V terms, evaluated
sparsely: terms that one side lacks need only the other side's counts, of which a source has few
different ones; terms that both have are joined on the term; the rest are equal and counted.

A model's vocabulary passes through the driver and goes to all executors. It is counted by a job
of its own and measured: up to ``MOST_TERMS`` terms of ``MOST_BYTES`` together it makes the model;
beyond that the same sums come from a join with the vocabulary as a table. (The estimator's own
``fit`` would count all documents a second time.)

Defined cases: NULL text, language or source is empty, which is a language or source like
others. Repeated rows and equal ids are documents of their own; ids are not used. A language
without kept terms gives pairs of value 0 and no terms, a lone source no pairs. Ties in value go
by the item's UTF-8 bytes. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnkpi.llm.common import LOWER, LOWER_BYTES, pieces, small, written

#: Bytes of texts so that terms are left between blanks: every ASCII character but letters is one.
LETTERS = bytes(b if b > 127 or chr(b) in LOWER else 32 for b in LOWER_BYTES)

#: Terms that a task counts in memory before it passes them on.
HELD = 500_000

#: A vocabulary up to this size is fitted on the driver and sent to executors.
MOST_TERMS = 1_000_000
MOST_BYTES = 32 * 2**20

MAX_INT = 2**31 - 1

GROUP = ["lang", "source"]


@dataclass(frozen=True)
class Settings:
    #: Documents of a language that a kept term occurs in at least; terms listed per source.
    min_docs: int = 10
    top_terms: int = 10
    most_terms: int = MOST_TERMS
    most_bytes: int = MOST_BYTES


def _empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _texts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    return docs.select(_empty(lang_col).alias("lang"), _empty(source_col).alias("source"), F.col(text_col).alias("text"))


def _terms(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Terms of every text, with the first text's place."""
    for begin, texts in pieces(batch, "text"):
        yield begin, [text.translate(LETTERS).split() for text in texts]


def _ending(lang: str) -> bytes:
    """What follows a term to make it one of the language."""
    return b":" + lang.encode()


def _joined(docs: list[list[bytes]], endings: list[bytes]) -> pa.ListArray:
    """The terms of each text with its ending, put together as one run of bytes."""
    data = b"".join(end.join(terms) + end for terms, end in zip(docs, endings) if terms)
    counts = np.fromiter(map(len, docs), dtype=np.int64, count=len(docs))
    sizes = np.fromiter(map(len, chain.from_iterable(docs)), dtype=np.int64, count=counts.sum())
    sizes += np.repeat(np.fromiter(map(len, endings), dtype=np.int64, count=len(docs)), counts)
    flat = _offsets(sizes, pa.int32()).buffers()[1]
    terms = pa.StringArray.from_buffers(len(sizes), flat, pa.py_buffer(data))
    return pa.ListArray.from_arrays(_offsets(counts, pa.int32()), terms)


def _offsets(sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)), pa.int64()).cast(kind)


def terms_of(texts: DataFrame) -> DataFrame:
    """(lang, source, terms) of every document; a term is followed by ``:`` and its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            endings = [_ending(lang) for lang in batch.column("lang").to_pylist()]
            for begin, docs in _terms(batch):
                groups = [batch.column(c).slice(begin, len(docs)) for c in GROUP]
                lists = _joined(docs, endings[begin : begin + len(docs)])
                yield pa.RecordBatch.from_arrays([*groups, lists], [*GROUP, "terms"])

    return texts.mapInArrow(run, "lang string, source string, terms array<string>")


def vocabulary(texts: DataFrame, cfg: Settings) -> DataFrame:
    """(key): terms with language that enough documents hold; tasks count before they shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = defaultdict(Counter)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for begin, docs in _terms(batch):
                for lang, terms in zip(langs[begin:], docs):
                    seen[lang].update(set(terms))
                if sum(map(len, seen.values())) > HELD:
                    yield rows_of(seen)
                    seen = defaultdict(Counter)
        yield rows_of(seen)

    def rows_of(seen: dict[str, Counter]) -> pa.RecordBatch:
        keys = [term + _ending(lang) for lang, docs in seen.items() for term in docs]
        counts = list(chain.from_iterable(docs.values() for docs in seen.values()))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["key", "docs"])

    counts = texts.mapInArrow(run, "key string, docs bigint").groupBy("key").agg(F.sum("docs").alias("docs"))
    return counts.filter(F.col("docs") >= cfg.min_docs).select("key")


def _model(kept: DataFrame) -> CountVectorizerModel:
    """The vectoriser with the measured vocabulary, of which Python sees nothing."""
    jvm = kept.sparkSession._jvm
    keys = kept._jdf.sort("key", kept.sparkSession.sparkContext._gateway.new_array(jvm.String, 0))
    keys = getattr(keys, "as")(jvm.org.apache.spark.sql.Encoders.STRING()).collect()
    java = jvm.org.apache.spark.ml.feature.CountVectorizerModel("vocabulary", keys)
    return CountVectorizerModel(java).setInputCol("terms").setOutputCol("vector")


def vector_counts(texts: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, i, n), count vectors of all documents summed by source, and names (i, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held, size = {}, [], 0
        for batch in batches:
            names = zip(*(batch.column(c).to_pylist() for c in GROUP))
            which = np.array([groups.setdefault(g, len(groups)) for g in names], dtype=np.int64)
            at, n = batch.column("indices"), batch.column("values")
            lengths = np.diff(at.offsets.to_numpy())
            held.append((np.repeat(which, lengths) << 32 | at.flatten().to_numpy(), n.flatten().to_numpy().astype(np.int64)))
            size += len(held[-1][0])
            if size > HELD * 4:
                yield rows_of(groups, held)
                groups, held, size = {}, [], 0
        if held:
            yield rows_of(groups, held)

    def rows_of(groups: dict, held: list) -> pa.RecordBatch:
        keys, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, n = keys[first], np.add.reduceat(n, first) if len(first) else n
        names = [pa.array(x, pa.string()) for x in zip(*groups)]
        which = pa.array(keys >> 32)
        return pa.RecordBatch.from_arrays(
            [*(x.take(which) for x in names), pa.array(keys & MAX_INT, pa.int64()), pa.array(n)], [*GROUP, "i", "n"]
        )

    model = _model(kept)
    names = texts.sparkSession.createDataFrame(list(enumerate(model.vocabulary)), "i bigint, key string")
    vector = F.unwrap_udt("vector")
    vectors = model.transform(terms_of(texts)).select(*GROUP, vector["indices"].alias("indices"), vector["values"].alias("values"))
    sums = vectors.mapInArrow(run, "lang string, source string, i bigint, n bigint")
    return sums.groupBy(*GROUP, "i").agg(F.sum("n").alias("n")), names


def joined_counts(texts: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same by a join with the written vocabulary ``kept`` (key)."""
    names = written(kept.withColumn("i", F.monotonically_increasing_id()), "names")
    sums = terms_of(texts).select(*GROUP, F.explode("terms").alias("key")).groupBy(*GROUP, "key").agg(F.count("*").alias("n"))
    return sums.join(names, "key").drop("key"), names


def source_counts(
    docs: DataFrame, cfg: Settings, lang_col: str, source_col: str, text_col: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, source, i, n) of kept terms that occur, (lang, source, total, present, v) of all groups, (i, term)."""
    texts = _texts(docs, lang_col, source_col, text_col)
    kept = written(vocabulary(texts, cfg), "vocabulary")
    terms, size = kept.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).head()
    count = vector_counts if 0 < terms <= cfg.most_terms and size <= cfg.most_bytes else joined_counts
    counts, names = count(texts, kept)
    counts = written(counts, "counts")
    colon = F.instr("key", ":")
    names = written(names.select("i", F.substring("key", F.lit(1), colon - 1).alias("term")), "terms")
    lang = F.substring("key", colon + 1, F.length("key"))
    sizes = kept.groupBy(lang.alias("lang")).agg(F.count("*").alias("v"))
    totals = counts.groupBy(*GROUP).agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    zero = F.lit(0).cast("bigint")
    groups = texts.select(*GROUP).distinct().join(totals, GROUP, "left").join(sizes, "lang", "left")
    groups = groups.select(*GROUP, *(F.coalesce(c, zero).alias(c) for c in ("total", "present", "v")))
    return counts, written(groups, "groups"), names


def _share(n: str, total: str, v: str = "v") -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 v)) in decimals, NULL without kept terms."""
    over = f"nullif(cast({total} + 2 * {v} as decimal(20, 0)), 0)"
    return F.expr(f"cast(1 + (cast(1000000000 as decimal(10, 0)) * cast({n} + 2 as decimal(20, 0))) div {over} as bigint)")


def _apart(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares; both are at most 10^9 + 1."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy(*GROUP).orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked if most is None else ranked.filter(F.col("rank") <= most)
    return ranked.select(*GROUP, F.lit(part).alias("part"), "item", F.col("value").cast("bigint").alias("value"), "rank")


def distinctive_terms(counts: DataFrame, groups: DataFrame, names: DataFrame, cfg: Settings) -> DataFrame:
    """Terms that a source uses more than its language as a whole, the most distinctive ones."""
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    whole = counts.groupBy("i").agg(F.sum("n").alias("lang_n"))
    rows = counts.join(whole, "i").join(small(groups), GROUP).join(langs, "lang")
    rows = rows.withColumns({"p": _share("n", "total"), "q": _share("lang_n", "lang_total")}).filter("p > q")
    rows = rows.select(*GROUP, "i", _apart("p", "q").alias("value")).join(small(names.withColumnRenamed("term", "item")), "i")
    return _ranked(rows, "term", cfg.top_terms)


def source_pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of the language, the farthest first."""
    groups = groups.withColumn("p0", _share("0", "total"))
    shares = counts.join(small(groups), GROUP).withColumn("p", _share("n", "total"))
    shares = written(shares.select(*GROUP, "i", "n", "p", "p0"), "shares")
    x, y = (groups.select("lang", "v", *(F.col(c).alias(f"{c}_{s}") for c in ("source", "present", "p0"))) for s in "xy")
    both = x.join(y.drop("v"), "lang").filter("source_x < source_y")
    neither = both.select("lang", "source_x", "source_y", ((F.col("v") - F.col("present_x") - F.col("present_y")) * _apart("p0_x", "p0_y")).alias("f"))
    levels = shares.groupBy(*GROUP, "n", "p").agg(F.count("*").alias("terms"))
    one = levels.join(small(written(y, "others")), "lang").filter("source != source_y").select(
        "lang", F.least("source", "source_y").alias("source_x"), F.greatest("source", "source_y").alias("source_y"),
        (F.col("terms") * _apart("p", "p0_y")).alias("f"),
    )
    x, y = (shares.select("lang", "i", *(F.col(c).alias(f"{c}_{s}") for c in ("source", "p", "p0"))) for s in "xy")
    shared = x.join(y.drop("lang"), "i").filter("source_x < source_y").select(
        "lang", "source_x", "source_y",
        (_apart("p_x", "p_y") - _apart("p_x", "p0_y") - _apart("p0_x", "p_y") + _apart("p0_x", "p0_y")).alias("f"),
    )
    parts = [p.groupBy("lang", "source_x", "source_y").agg(F.sum("f").alias("f")) for p in (neither, one, shared)]
    pairs = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "source_x", "source_y").agg(
        F.coalesce(F.sum("f"), F.lit(0)).alias("value")
    )
    sides = F.explode(F.array(F.struct(F.col("source_x").alias("s"), F.col("source_y").alias("i")), F.struct(F.col("source_y").alias("s"), F.col("source_x").alias("i"))))
    pairs = pairs.select("lang", "value", sides.alias("e"))
    return _ranked(pairs.select("lang", F.col("e.s").alias("source"), F.col("e.i").alias("item"), "value"), "pair")


def source_divergence(
    docs: DataFrame, cfg: Settings = Settings(), lang_col: str = "lang", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    counts, groups, names = source_counts(docs, cfg, lang_col, source_col, text_col)
    return source_pairs(counts, groups).unionByName(distinctive_terms(counts, groups, names, cfg))
