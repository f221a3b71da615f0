"""Helpers shared by the operators: shared-folder tables and byte-level text
kernels that run inside Arrow batches.

Text kernels work on the contiguous UTF-8 buffer of an Arrow string column,
so one numpy pass covers many documents. A null text counts as empty there;
callers that must tell the two apart read the column's validity themselves.
Working memory is about 40 bytes for each byte of one slice of rows
(``SLICE_BYTES``, or one document where that is longer).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import load

SLICE_BYTES = 1 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


# ---------------------------------------------------------------- tables

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by Spark's reader."""
    return load(spark, sf_dir, name)


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and read
    it back: later readers neither recompute it nor depend on executors that
    may be lost. The files go when the session ends."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, limit: int = 8 << 20) -> None:
    """Keep the Arrow batches of this session under ``limit`` bytes (or one
    row), so that long texts and wide pairs fit a Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not str(now).isdigit() or int(now) > limit:
        spark.conf.set(key, str(limit))


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may see: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def hash128(*cols: Column) -> list[Column]:
    """Two independently seeded 64-bit hashes: 128 bits for exact grouping."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(0x5DEECE66D), *cols)]


# ---------------------------------------------------------------- hashing

def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h *= _MIX1
    h ^= h >> np.uint64(27)
    h *= _MIX2
    h ^= h >> np.uint64(31)
    return h


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants from a fixed generator."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLD + np.uint64(seed)) | np.uint64(1)


_BYTE = constants(256, 11)
_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)


def _powers(n: int):
    """base**i and base**-i modulo 2**64 for i < n (grown on demand)."""
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        base = int(constants(1, 23)[0])
        size = 1 << max(16, int(n - 1).bit_length())
        for name, b in (("_POWERS", base), ("_INVERSE", pow(base, -1, 1 << 64))):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _POWERS, _INVERSE


# ---------------------------------------------------------------- text

def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        empty = b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else ""
        col = pc.fill_null(col, empty)
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.empty(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges [i, j) of about ``limit`` bytes, one row at least."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def _byte_table(separators: list[tuple[int, int]]) -> np.ndarray:
    word = np.ones(256, bool)
    for lo, hi in separators:
        word[lo:hi + 1] = False
    return word


#: Words between ASCII white space, and words of letters, digits and all
#: non-ASCII characters (tables of "is a word byte").
BY_SPACE = _byte_table([(0x20, 0x20), (0x09, 0x0D)])
BY_LETTER = _byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


class Words:
    """Words of a slice of documents: byte range, document (row within the
    slice) and a 64-bit hash of the A-Z-lower-cased bytes of each."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray):
        low = ASCII_LOWER[data]
        inside = table[low]
        n = len(low)
        start, stop = inside.copy(), inside.copy()
        if n:
            start[1:] &= ~inside[:-1]
            stop[:-1] &= ~inside[1:]
            edge = offs[:-1][offs[:-1] < n]
            start[edge] = inside[edge]
            last = offs[1:][offs[1:] > 0] - 1
            stop[last] = inside[last]
        self.low = low
        self.start = np.flatnonzero(start)
        self.stop = np.flatnonzero(stop) + 1
        self.rows = len(offs) - 1
        #: words of row r are bounds[r]:bounds[r + 1]
        self.bounds = np.searchsorted(self.start, offs)
        self.count = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(self.rows), self.count)
        power, inverse = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[low] * power[:n], out=total[1:])
        self.hash = mix((total[self.stop] - total[self.start]) * inverse[self.start])

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the ``k``-word shingles and their rows; a row of fewer
        words (but not none) gives its whole sequence as one."""
        c = constants(k, 37)
        h, doc = self.hash, self.doc
        m = len(h) - k + 1
        if m > 0:
            acc = h[:m] * c[0]
            for t in range(1, k):
                acc += h[t:t + m] * c[t]
            ok = doc[:m] == doc[k - 1:]
            full, rows = mix(acc[ok]), doc[:m][ok]
        else:
            full, rows = np.empty(0, np.uint64), np.empty(0, doc.dtype)
        short = np.flatnonzero((self.count > 0) & (self.count < k))
        if len(short) == 0:
            return full, rows
        tail = np.array([(h[self.bounds[r]:self.bounds[r + 1]] * c[:self.count[r]]).sum()
                         for r in short], np.uint64) + self.count[short].astype(np.uint64) * _GOLD
        order = np.argsort(np.concatenate([rows, short]), kind="stable")
        return np.concatenate([full, mix(tail)])[order], np.concatenate([rows, short])[order]


def string_hashes(col) -> np.ndarray:
    """A 64-bit hash of each string of an Arrow column (of its bytes only)."""
    data, offs = buffers(col)
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:len(data)], out=total[1:])
    return mix((total[offs[1:]] - total[offs[:-1]]) * inverse[offs[:-1]] + np.diff(offs).astype(np.uint64) * _GOLD)


def batch_words(col, table: np.ndarray):
    """Yield (first row, row count, ``Words``) over an Arrow text column."""
    data, offs = buffers(col)
    for i, j in slices(offs):
        yield i, j, Words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], table)


def arrow_schema(spec: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([pa.field(n, t) for n, t in spec])
