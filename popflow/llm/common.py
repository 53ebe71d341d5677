"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body`` on a value that is computed once, also where lambdas inside use it many times."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of the whole text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != F.lit(""))


def n_words_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def small_batches(df: DataFrame, rows: int = 1000, size: int = 8 << 20) -> None:
    """Let at most ``rows`` rows and ``size`` bytes of the session go to Python in one Arrow batch.

    The defaults of 10,000 rows and 64 MB, with the copies that are made of them, are a large part
    of a worker's memory. The settings are ones of speed only; they are lowered for the session
    and stay.
    """
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{name}"
        now = int(conf.get(name).removesuffix("b"))
        if now <= 0 or now > most:
            conf.set(name, str(most))


def give_back() -> None:
    """Return freed memory to the system.

    A worker process outlives its task and waits for the next one; what its allocators keep until
    then counts against the executor all the same.
    """
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, on an array of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have inverses modulo 2**64
_SPAN = 1 << 17  # bytes hashed at a time, small enough to stay in cache


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES = [(mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(b)) | np.uint64(1),
            _powers(b, _SPAN), _powers(pow(b, -1, 1 << 64), _SPAN)) for b in _BASES]


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of every text, and the number of words of each text.

    Two polynomial hashes over the bytes come from running sums modulo 2**64, a word's being the
    difference of two sums divided by the power at its start; they are mixed into one number.
    Two different words share a number with a chance of about 1 in 2**64.
    """
    lens = np.array([len(t) + 1 for t in texts], np.int64)
    if not len(lens):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        raw = _LOWER[raw]
    edge = np.flatnonzero(np.diff(_BLANK[raw], prepend=True))
    start, end = edge[0::2], edge[1::2]
    counts = np.diff(np.searchsorted(start, np.cumsum(lens)), prepend=0)
    out = np.zeros(len(start), np.uint64)
    a = 0
    while a < len(start):
        # Whole words up to the span; a longer word is hashed alone, with tables of its size.
        b = max(a + 1, int(np.searchsorted(end, start[a] + _SPAN, "right")))
        part, s, e = raw[start[a]:end[b - 1]], start[a:b] - start[a], end[a:b] - start[a]
        for base, (values, up, down) in zip(_BASES, _TABLES):
            if len(part) > _SPAN:
                up, down = _powers(base, len(part)), down[:1]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(values[part] * up[:len(part)], out=sums[1:])
            out[a:b] = mix(out[a:b] * np.uint64(3) + (sums[e] - sums[s]) * down[s])
        a = b
    return out, counts


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote and that nothing reads any more."""
    for table in tables:
        files = table.inputFiles()
        if files:
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            if path.getName().startswith("popflow-"):
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
