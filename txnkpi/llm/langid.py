"""Language ID by prediction by partial matching over bytes.

A context tree is learned per language: how often each byte followed each context of up to
``order`` bytes. Statistics are then frozen. A text's code length in a language is exact: a
byte that was seen after the longest known context costs that estimate, any other pays the
escape and goes on with the next shorter context, down to 8 bits for any byte (method C:
escape = distinct / (total + distinct)). The shortest code wins.

All languages share one table per context length, with the costs of every language resolved
beforehand, so a byte usually takes one look-up for all of them.

The trees are learned from whole texts of a bounded sample of labelled rows
(``Settings.texts_per_language``, chosen by hash); the table is bounded by that, too.

Defined cases: text that is NULL or has no letter gives ``und`` with score 0, and so does
every text if nothing was learned. Equal code lengths go to the first language by code point.
Rows without a language, or without text, teach nothing. Repeated rows get equal results; an
empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnkpi.llm.common import pieces

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    order: int = 3
    texts_per_language: int = 200
    #: Longest text that teaches, in bytes. A language whose labelled texts are all longer is
    #: learned from its shortest ones, whole, this many of them.
    most_bytes: int = 20_000
    long_texts: int = 3

    def __post_init__(self):
        if not 0 <= self.order <= 3:
            raise ValueError("contexts have 0 to 3 bytes")


class Model:
    """Frozen statistics: per context length, sorted keys and the languages' costs in bits."""

    def __init__(self, texts: dict[str, list[bytes]], order: int):
        self.languages = sorted(texts)
        self.order = order
        n = len(self.languages)
        grams: list[list[tuple[np.ndarray, np.ndarray]]] = []
        for m in range(order + 1):
            per = []
            for lang in self.languages:
                keys = [_grams(t, m) for t in texts[lang]]
                per.append(np.unique(np.concatenate(keys or [np.zeros(0, np.uint32)]), return_counts=True))
            grams.append(per)
        #: (keys of context and byte, costs), (keys of contexts, cost of the escape)
        self.symbols: list[tuple[np.ndarray, np.ndarray]] = []
        self.escapes: list[tuple[np.ndarray, np.ndarray]] = []
        for m in range(order + 1):
            keys = np.unique(np.concatenate([k for k, _ in grams[m]] or [np.zeros(0, np.uint32)]))
            contexts = np.unique(keys >> np.uint32(8))
            escape = np.zeros((len(contexts), n))
            direct = np.full((len(keys), n), np.nan)
            for j, (k, c) in enumerate(grams[m]):
                own, first, distinct = np.unique(k >> np.uint32(8), return_index=True, return_counts=True)
                total = np.add.reduceat(c, first) if len(first) else np.zeros(0)
                escape[np.searchsorted(contexts, own), j] = np.log2((total + distinct) / distinct)
                at = np.searchsorted(own, k >> np.uint32(8))
                direct[np.searchsorted(keys, k), j] = np.log2((total + distinct)[at] / c)
            self.escapes.append((contexts, escape))
            shorter = self._cost(keys, m - 1) + self._escape(keys >> np.uint32(8), m)
            self.symbols.append((keys, np.where(np.isnan(direct), shorter, direct)))

    def _escape(self, contexts: np.ndarray, m: int) -> np.ndarray:
        known, costs = self.escapes[m]
        out = np.zeros((len(contexts), len(self.languages)))
        if len(known):
            at = np.minimum(np.searchsorted(known, contexts), len(known) - 1)
            hit = known[at] == contexts
            out[hit] = costs[at[hit]]
        return out

    def _cost(self, keys: np.ndarray, m: int) -> np.ndarray:
        """Bits of the last byte of each key after its m bytes before, per language."""
        if m < 0:
            return np.full((len(keys), len(self.languages)), 8.0)
        if m < 3:
            keys = keys & np.uint32((1 << 8 * (m + 1)) - 1)
        known, costs = self.symbols[m]
        if not len(known):
            return self._cost(keys, m - 1)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        out = costs[at]
        miss = np.flatnonzero(known[at] != keys)
        if len(miss):
            out[miss] = self._cost(keys[miss], m - 1) + self._escape(keys[miss] >> np.uint32(8), m)
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language, in bits."""
        out = np.zeros((len(texts), len(self.languages)))
        keys = [_grams(t, self.order) for t in texts]
        sizes = np.array([len(k) for k in keys], dtype=np.int64)
        grams, back, count = _distinct(np.concatenate(keys or [np.zeros(0, np.uint32)]))
        del count
        costs = self._cost(grams, self.order)[back]
        full = np.flatnonzero(sizes)
        if len(full):
            out[full] = np.add.reduceat(costs, (np.cumsum(sizes) - sizes)[full])
        return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True, return_counts=True)


def _grams(text: bytes, m: int) -> np.ndarray:
    """Each byte with the m bytes before it as one number; before the text stand zero bytes."""
    data = np.frombuffer(b"\0" * m + text, dtype=np.uint8).astype(np.uint32)
    out = np.zeros(len(text), dtype=np.uint32)
    for j in range(m + 1):
        out = (out << np.uint32(8)) | data[j : j + len(text)]
    return out


def learn(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trees of a bounded sample of rows: the first of each language by a hash of the id."""
    order = Window.partitionBy("lang").orderBy("longer", "h", "id", "text")
    size = F.octet_length("text")
    sample = (
        docs.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .withColumn("longer", F.when(size <= settings.most_bytes, 0).otherwise(size))
        .withColumn("h", F.xxhash64(F.col("id").cast("string")))
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= F.when(F.col("longer") == 0, settings.texts_per_language).otherwise(settings.long_texts))
        .select("lang", "text")
    )
    texts: dict[str, list[bytes]] = {}
    for row in sample.collect():  # bounded by texts_per_language * most_bytes for each language
        texts.setdefault(row["lang"], []).append(row["text"].encode())
    return Model(texts, settings.order)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", held_out=None) -> DataFrame:
    """One row per row of ``docs`` with the language of the shortest code; nothing is shuffled.

    The score is the share of the best language if each text had the probability of its code.
    """
    held = F.lit(None).cast("boolean") if held_out is None else held_out
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = [], []
            for _, texts in pieces(batch, "text"):
                bits = model.lengths(texts) if model.languages else np.zeros((len(texts), 0))
                for text, row in zip(texts, bits):
                    if not len(row) or not LETTER.search(text.decode("utf-8", "replace")):
                        best.append(UNKNOWN)
                        score.append(0.0)
                    else:
                        best.append(model.languages[int(np.argmin(row))])
                        score.append(float(1 / np.exp2(np.maximum(row.min() - row, -1000)).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(score, pa.float64())], names
            )

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
