"""Importance resampling towards a target corpus by hashed runs of one to three words.

A run's bucket is the crc32 of its words joined by blanks. No run is ever put together: the
distinct words of a span of text, each bounded by blanks, go into an Aho-Corasick dictionary whose
entries carry the crc32 of the word, the crc32 of the word after a blank and its length. The
automaton scans the span and emits one payload per word, and the crc32 of a run follows from the
payloads of adjacent words: appending bytes shifts the checksum before them, a linear map that
depends on their number only, and adds their own.

Two scans are made. The first counts the buckets of the raw and of the target texts; counts are
added up per task and then per bucket. The second adds up every document's gains. Memory is
bounded by a span, whatever the length of a text, and by the number of buckets.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import small_batches
from popflow.operators.ordering import rank_rows
from popflow.session import cut

BUCKETS = 10_000
LONGEST_RUN = 3
SPAN = 1 << 17  # bytes scanned with one dictionary, small enough for it to stay in cache
#: Bytes of words stand for themselves, A-Z in lower case; all others part words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else
              b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_END = b"\x01"  # parts documents; not a byte of any word


def _byte_shift() -> np.ndarray:
    """What the checksum of one byte position becomes when a zero byte follows it."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_ONE = _byte_shift()
_TABLED = 64


def _tables() -> np.ndarray:
    """[n, k, b]: the checksum with byte b in position k, shifted by n zero bytes."""
    out = np.zeros((_TABLED, 4, 256), np.uint32)
    for k in range(4):
        c = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for n in range(_TABLED):
            out[n, k] = c
            c = (c >> np.uint32(8)) ^ _ONE[c & np.uint32(255)]
    return out


_SHIFT = _tables()


def shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each checksum with ``n`` bytes appended, without what those bytes add."""
    crc, n = crc.astype(np.uint32), n.copy()
    while True:
        k = np.minimum(n, _TABLED - 1)
        crc = (_SHIFT[k, 0, crc & np.uint32(255)]
               ^ _SHIFT[k, 1, (crc >> np.uint32(8)) & np.uint32(255)]
               ^ _SHIFT[k, 2, (crc >> np.uint32(16)) & np.uint32(255)]
               ^ _SHIFT[k, 3, crc >> np.uint32(24)])
        n -= k
        if not n.any():
            return crc


class Payloads(NamedTuple):
    """Per word: crc32 of it, crc32 of a blank and it, bytes of both; -1 bytes end a document."""

    crc: np.ndarray
    joined: np.ndarray
    size: np.ndarray


def _dictionary(words: list[bytes]) -> tuple[ahocorasick.Automaton, Payloads]:
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, word in enumerate(words):
        automaton.add_word(f" {word.decode('latin-1')} ", i)
    automaton.make_automaton()
    return automaton, Payloads(
        np.array([zlib.crc32(w) for w in words], np.uint32),
        np.array([zlib.crc32(b" " + w) for w in words], np.uint32),
        np.array([-1 if w == _END else len(w) + 1 for w in words], np.int64))


def _spans(texts: list[bytes], span: int) -> Iterator[bytes]:
    """Folded texts with an end mark after each, in pieces cut between words.

    A word longer than a span is a piece by itself.
    """
    held, n = [], 0
    for text in texts:
        text = text.translate(_FOLD)
        at = 0
        while at < len(text):
            to = min(len(text), at + span - n)
            if to < len(text):
                cut_at = text.rfind(b" ", at + 1, to)
                if cut_at < at:
                    cut_at = at if n else text.find(b" ", to)
                to = cut_at if cut_at >= 0 else len(text)
            held.append(text[at:to])
            n += to - at
            at = to
            if at < len(text):
                yield b" ".join(held)
                held, n = [], 0
        held.append(_END)
        n += 3
        if n >= span:
            yield b" ".join(held)
            held, n = [], 0
    if held:
        yield b" ".join(held)


def scan(texts: list[bytes], span: int = SPAN) -> Iterator[Payloads]:
    """Payloads of the words of all texts in order, an end mark after each text."""
    for piece in _spans(texts, span):
        words = list(set(piece.split()))
        if words:
            automaton, payloads = _dictionary(words)
            at = np.fromiter(
                (i for _, i in automaton.iter(f" {piece.decode('latin-1')} ")), np.int64)
            yield Payloads(*[x[at] for x in payloads])


def run_buckets(texts: list[bytes], span: int = SPAN) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of every run of one to three words, span by span."""
    done, carry = 0, Payloads(*[np.empty(0, t) for t in (np.uint32, np.uint32, np.int64)])
    for new in scan(texts, span):
        had = len(carry.size)
        crc, joined, size = (np.concatenate(x) for x in zip(carry, new))
        text = done + np.cumsum(size < 0) - (carry.size < 0).sum()
        end = np.flatnonzero(size[had:] > 0) + had  # words that are new in this span
        of = [(text[end], crc[end])]
        for before in range(1, LONGEST_RUN):
            # The run that starts ``before`` words ahead: its first word, then each that follows.
            end = end[end >= before]
            whole = np.ones(len(end), bool)
            for i in range(before + 1):
                whole &= size[end - i] > 0
            end = end[whole]
            run = crc[end - before]
            for i in range(before - 1, -1, -1):
                run = shifted(run, size[end - i]) ^ joined[end - i]
            of.append((text[end], run))
        yield tuple(np.concatenate(x) for x in zip(
            *[(t, (r % np.uint32(BUCKETS)).astype(np.int64)) for t, r in of]))
        done = int(text[-1])
        carry = Payloads(*[x[1 - LONGEST_RUN:] for x in (crc, joined, size)])


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def bucket_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """Runs of all texts per bucket. One line per bucket, a fixed number, reaches the driver."""
    small_batches(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, bucket in run_buckets(_texts(batch.column(0))):
                n += np.bincount(bucket, minlength=BUCKETS)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    counted = df.select(F.coalesce(text, F.lit("")).alias("t")).mapInArrow(
        run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in counted.collect():
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm by which the target prefers each bucket, rounded down."""
    s_all, t_all = int(raw.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS))))
        for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weights(df: DataFrame, gain: np.ndarray, text: str = "text") -> DataFrame:
    """``df`` without its texts, with (n_words, n_features, weight) of each of them."""
    small_batches(df)
    # Names of its own, so that no column of the input is in the way.
    rest = [f for f in df.schema.fields if f.name != text]
    plain = df.select(*[F.col(f.name).alias(f"c{i}") for i, f in enumerate(rest)],
                      F.coalesce(text, F.lit("")).alias("t"))
    schema = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(rest)]
                       + [f"{c} bigint" for c in ("n_words", "n_features", "weight")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(len(rest)))
            features, weight = np.zeros((2, len(texts)), np.int64)
            for of, bucket in run_buckets(texts):
                features += np.bincount(of, minlength=len(texts))
                # Sums of a span stay far below 2**53, so doubles hold them exactly.
                weight += np.bincount(of, gain[bucket], len(texts)).astype(np.int64)
            # n, n + (n - 1) and n + (n - 1) + (n - 2) runs of up to three words.
            words = np.where(features > 1, (features + 3) // 3, features)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(rest))]
                + [pa.array(x) for x in (words, features, weight)],
                names=[f"c{i}" for i in range(len(rest))] + ["n_words", "n_features", "weight"])

    return plain.mapInArrow(run, schema).select(
        *[F.col(f"c{i}").alias(f.name) for i, f in enumerate(rest)],
        "n_words", "n_features", "weight")


def noise(key: Column, seed: int = 42) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of the key; null counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32)))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
             percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """(``key``, n_words, n_features, weight, score, rank) of every document.

    ``target`` has a column ``text``. ``percent`` of the documents with ``least_words`` words or
    more are drawn, the highest scores first, ties to the smaller key, null keys last; ``rank`` is
    null for the others. Null texts are empty: no features, weight 0. Repeated rows count and are
    drawn each. Texts of any length are read whole, in spans. Without documents there are no
    rows; without target texts every bucket has a count of 0 there. Only ``key`` and ``text`` are
    read, so other columns of any name do not matter.
    """
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    gain = gains(bucket_counts(plain), bucket_counts(target.select("text")))
    scored = cut(weights(plain, gain).withColumn("score", F.col("weight") + noise(F.col("key"), seed)))
    able = scored.filter(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    names = ["key", "n_words", "n_features", "weight", "score"]
    ranked = rank_rows(able, [F.col("score").desc(), F.col("key").asc_nulls_last(),
                              "n_features", "weight"], (), out="rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    out = ranked.select(*names, rank.cast("bigint").alias("rank")).unionByName(
        scored.filter(F.col("n_words") < least_words).select(
            *names, F.lit(None).cast("bigint").alias("rank")))
    return out.withColumnRenamed("key", key)
