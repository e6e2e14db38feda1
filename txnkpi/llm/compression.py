"""Quality rules: compression bands over whole documents and fixed chunks.

A text that zstandard shrinks too well repeats itself; one that it hardly shrinks is noise.
Short texts compress worse than long ones, so the limits depend on the length in bytes. Noise
of few characters (base64, hexadecimal) is shrunk by coding its bytes alone, without any
order in them: what zstandard does not shrink below its bytes' entropy, and bzip2 hardly
better than the same bytes shuffled, is noise as well, from ``noise_bytes`` on.

Defined cases: a NULL or empty text has no words, fails the base rule and has no ratio. Texts
under the smallest band are not judged by compression. Rows are judged one by one: repeated
rows get the same verdict each, an empty table gives an empty result, and further columns of
the input are ignored (``quality_rules``) or kept (``keep_good``).
"""

from __future__ import annotations

import bz2
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, ratio double, n_chunks bigint, "
    "n_bad_chunks bigint"
)
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits of compressed size over size, by the least number of bytes they hold for."""

    whole: tuple[tuple[int, float, float], ...] = (
        (128, 0.45, 1.05),
        (192, 0.45, 0.93),
        (256, 0.35, 0.88),
        (384, 0.35, 0.82),
        (512, 0.30, 0.90),
        (1024, 0.25, 0.80),
        (4096, 0.25, 0.75),
        (16384, 0.20, 0.70),
    )
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.25, 0.75)
    #: From this length on, noise is told by order: zstandard's size over the bytes' entropy,
    #: and bzip2's size over that of the shuffled bytes. Measured at 512 to 1,500 bytes, the
    #: latter is 0.90 at most for clean prose and 0.96 at least for random words of any alphabet.
    noise_bytes: int = 448
    noise_entropy: float = 0.95
    noise_order: float = 0.93
    #: A text goes if more than this share of its chunks' bytes lies outside the band. The last
    #: chunk is judged by the limits of its own length if that is ``noise_bytes`` or more.
    bad_chunks: float = 0.25
    level: int = 3
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8


def repeated_words(words: list, window: int) -> int:
    """Words inside windows that occur twice or more, compared exactly.

    Windows get numbers by doubling: the number of 2n words follows from those of n and n.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    parts, size, left = [], 1, window
    ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    at = 0
    while left:
        if left & 1:
            parts.append(ids[at : at + n])
            at += size
        left >>= 1
        if left:
            ids = pd.factorize(ids[:-size] * (ids.max() + 1) + ids[size:])[0].astype(np.int64)
            size *= 2
    key = parts[0]
    for part in parts[1:]:
        key = pd.factorize(key * (part.max() + 1) + part)[0].astype(np.int64)
    again = np.flatnonzero(np.bincount(key)[key] > 1)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def is_noise(data: bytes, size: int, bands: Bands) -> bool:
    """Whether bytes that zstandard makes ``size`` of have no order."""
    if len(data) < bands.noise_bytes:
        return False
    found = np.frombuffer(data, dtype=np.uint8)
    counts = np.bincount(found)
    counts = counts[counts > 0]
    entropy = float((counts * np.log2(len(data) / counts)).sum()) / 8
    if size < bands.noise_entropy * entropy:
        return False
    shuffled = np.random.RandomState(0).permutation(found).tobytes()
    return len(bz2.compress(data)) > bands.noise_order * len(bz2.compress(shuffled))


def fits(data: bytes, size: int, bands: Bands) -> bool:
    """Whether bytes that zstandard makes ``size`` of lie within the limits of their length."""
    limits = [x for x in bands.whole if len(data) >= x[0]]
    return not limits or (limits[-1][1] <= size / len(data) <= limits[-1][2] and not is_noise(data, size, bands))


def judge(text: str | None, bands: Bands, compress: zstandard.ZstdCompressor) -> tuple:
    """Counts, verdicts and ratios of one text, as in SCHEMA without the id."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at ASCII white space only
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = Counter(x for x in data.split(b"\n") if x.split())
    repeats = repeated_words(words, bands.window)
    failed = len(words) < bands.min_words or 100 * repeats > bands.max_repeat_percent * len(words)
    size = len(compress.compress(data)) if data else 0
    chunks = bad = judged = bad_bytes = 0
    for i in range(0, len(data) if len(data) >= bands.chunk_bytes else 0, bands.chunk_bytes):
        chunk = data[i : i + bands.chunk_bytes]
        if len(chunk) < min(bands.noise_bytes, bands.chunk_bytes):
            break
        part = len(compress.compress(chunk))
        if len(chunk) == bands.chunk_bytes:
            outside = not bands.chunk[0] <= part / len(chunk) <= bands.chunk[1] or is_noise(chunk, part, bands)
        else:
            outside = not fits(chunk, part, bands)
        chunks, judged = chunks + 1, judged + len(chunk)
        bad, bad_bytes = bad + outside, bad_bytes + outside * len(chunk)
    good = fits(data, size, bands) and bad_bytes <= bands.bad_chunks * judged
    dup_lines = sum(lines.values()) - len(lines)
    return (len(words), chars, symbols, dup_lines, repeats, failed, good and not failed, size / len(data) if data else None, chunks, bad)


def quality_rules(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its counts, ratios and verdict; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            rows = [judge(t.as_py(), bands, compress) for t in batch.column(1)]
            columns = list(zip(*rows)) if rows else [()] * 10
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names)

    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return docs.select(F.col(id_col).cast("bigint"), text_col).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, bands: Bands = Bands(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, all columns unchanged."""

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        compress = zstandard.ZstdCompressor(level=bands.level)
        return texts.map(lambda t: judge(None if t is None else t, bands, compress)[6]).astype(bool)

    return docs.filter(kept(F.col(text_col)))
