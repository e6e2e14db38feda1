"""Helpers shared by the operators: words, word hashes, packed blocks, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnkpi.sources.paths import scanned_bytes, scratch, text_bytes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: ASCII white space, or (``ALNUM``) every ASCII character but 0-9 and a-z.
SPACE = r"[\x20\x09-\x0D]"
ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"

#: Bytes of text turned into arrays at once; a longer document is taken alone.
PIECE_BYTES = 2_000_000


def documents(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the cluster's shared folder and read again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables read from files of up to this many bytes are sent to all executors.
BROADCAST_BYTES = 16 * 2**20


def small(df: DataFrame) -> DataFrame:
    """A frame over a written table, to be broadcast if its size on disk allows."""
    return F.broadcast(df) if scanned_bytes(df) <= BROADCAST_BYTES else df


#: Input of one reducer where the number of reducers is chosen here, and the most of them.
REDUCER_BYTES = 64 * 2**20
MOST_REDUCERS = 32_768


def reducers_for(df: DataFrame) -> int:
    """Number of reducers for a shuffle of rows read from files, by the files' size."""
    wanted = -(-text_bytes(df) // REDUCER_BYTES)
    return max(df.sparkSession.sparkContext.defaultParallelism, min(wanted, MOST_REDUCERS))


# --- words as Spark columns


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; pure ASCII text takes the fast function."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column, separator: str) -> Column:
    """The words of a text as an array; NULL has none."""
    parts = F.array_remove(F.split(text, separator + "+"), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Columns that tell rows apart without moving their text; equal rows share them."""
    return [F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_h")]


# --- words as arrays of hashes

_WORD_BYTES = {
    SPACE: np.array([b not in b" \t\n\v\f\r" for b in range(256)]),
    ALNUM: np.array([b > 127 or chr(b) in "0123456789" + LOWER for b in range(256)]),
}
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits count."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of some documents: 64-bit hash, document (by order) and byte range of each."""

    def __init__(self, texts: list[bytes], separator: str = SPACE):
        data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.doc_start = np.cumsum(sizes + 1) - sizes - 1
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = _WORD_BYTES[separator][data]
        step = np.diff(inside)
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.doc = np.searchsorted(self.doc_start, self.start, side="right") - 1
        if len(self.start):
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(_TABLE[data] * _powers(_BASE, len(data))[:-1], out=sums[1:])
            back = _powers(_BACK, len(data))[self.start]
            self.hash = mix((sums[self.end] - sums[self.start]) * back)
        else:
            self.hash = np.zeros(0, dtype=np.uint64)
        self.count = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        #: Place of each document's first word, and of each word in its document.
        self.first = np.cumsum(self.count) - self.count
        self.place = np.arange(len(self.hash)) - self.first[self.doc]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where windows of ``size`` words of one document start, and their hashes."""
        at, hashes = self.prefixes(size)
        return at, hashes[0]

    def prefixes(self, *sizes: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Where windows of the last size start, and hashes of their first words by each size."""
        n = len(self.hash) - sizes[-1] + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), [np.zeros(0, dtype=np.uint64) for _ in sizes]
        at = np.flatnonzero(self.doc[:n] == self.doc[sizes[-1] - 1 :])
        rolled, out = np.zeros(n, dtype=np.uint64), []
        for j in range(sizes[-1]):
            rolled = rolled * _BASE + self.hash[j : n + j]
            if j + 1 in sizes:
                out.append(mix(rolled[at]))
        return at, out


def pieces(batch: pa.RecordBatch, column: str, lower: bool = False) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch as bytes, NULL as empty, some megabytes at a time, with the first one's place."""
    texts = batch.column(column).cast(pa.large_binary()).to_pylist()
    begin, size = 0, 0
    for i, text in enumerate(texts):
        texts[i] = text = (text or b"").translate(LOWER_BYTES) if lower else text or b""
        if size and size + len(text) > PIECE_BYTES:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, texts[begin:]


# --- blocks of arrays that shuffle as one small value


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays of one length, not 0, as bytes; the first is sorted, its steps are kept."""
    n = len(arrays[0])
    out = [n.to_bytes(8, "little")]
    for k, a in enumerate(arrays):
        a = a.astype(np.uint64)
        a = np.diff(a, prepend=np.uint64(0)) if k == 0 else a
        out.append(np.ascontiguousarray(a.view(np.uint8).reshape(n, 8).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def binned(bins: np.ndarray, *arrays: np.ndarray) -> pa.RecordBatch:
    """Rows (bin, block) of entries dealt to bins, sorted by the first array inside a bin."""
    order = np.argsort(arrays[0], kind="stable")
    order = order[np.argsort(bins[order], kind="stable")]
    bins, arrays = bins[order], [a[order] for a in arrays]
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    ends = np.append(first[1:], len(bins))
    blocks = [pack(*(a[i:j] for a in arrays)) for i, j in zip(first, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(bins[first], pa.int32()), pa.array(blocks, pa.binary())], ["bin", "block"]
    )


def unpack(block: bytes) -> list[np.ndarray]:
    """What went into ``pack``, as unsigned 64-bit arrays."""
    data = zstandard.ZstdDecompressor().decompress(block)
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(data, dtype=np.uint8, offset=8).reshape(-1, 8, n)
    out = [np.ascontiguousarray(p.T).reshape(-1).view(np.uint64) for p in planes]
    return [np.cumsum(out[0], dtype=np.uint64), *out[1:]]


def unpacked(blocks: pa.ChunkedArray) -> list[np.ndarray]:
    """The entries of many blocks of one bin, one block after another."""
    return [np.concatenate(x) for x in zip(*(unpack(b) for b in blocks.to_pylist()))]


def bins_for(docs: DataFrame, text_col: str, entries: int) -> int:
    """Number of bins that hold about ``entries`` words each, from the size of all texts."""
    size = docs.agg(F.sum(F.octet_length(text_col))).head()[0] or 0
    return int(size // (6 * entries)) + 1
