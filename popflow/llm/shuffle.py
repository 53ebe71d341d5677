"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows lie in blocks by a hash of their key. The matrix says how many rows of each block go to each
shard: its line for a block is a draw without replacement from the places the shards have left,
so every shard ends with its exact size and the result has the law of a uniform shuffle. Inside a
block the rows are permuted and dealt along the line; inside a shard they are permuted again.

Only the blocks' counts and the matrix, one line for about a million rows, pass the driver.
No task holds more than a block or a part of a shard.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popflow.session import cut

_LIMIT = 900_000_000  # numpy draws from fewer than 10**9 items


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes that differ by one at most."""
    return np.array([rows // shards + (i < rows % shards) for i in range(shards)], np.int64)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Number of good items among ``n`` drawn; larger populations by inversion from the mode."""
    if good + bad <= _LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low

    def log_choose(a: int, b: int) -> float:
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    left = right = mode
    p_left = p_right = math.exp(
        log_choose(good, mode) + log_choose(bad, n - mode) - log_choose(good + bad, n))
    u = rng.random() - p_left
    while u > 0 and (left > low or right < high):
        if right < high:
            p_right *= (good - right) * (n - right) / ((right + 1) * (bad - n + right + 1))
            right += 1
            u -= p_right
            if u <= 0:
                return right
        if left > low:
            p_left *= left * (bad - n + left) / ((good - left + 1) * (n - left + 1))
            left -= 1
            u -= p_left
            if u <= 0:
                return left
    return mode


def deal_line(rng: np.random.Generator, places: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` rows go to each shard, without replacement from the ``places`` left."""
    line, rest = np.zeros(len(places), np.int64), int(places.sum())
    for j, have in enumerate(int(p) for p in places):
        if not n:
            break
        rest -= have
        line[j] = hypergeometric(rng, have, rest, n)
        n -= int(line[j])
    return line


def communication_matrix(counts: list[int], sizes: np.ndarray, seed: int) -> np.ndarray:
    """Rows from block i to shard j; lines sum to ``counts``, columns to ``sizes``.

    Blocks are first dealt in groups that numpy can draw from, then one by one inside a group.
    """
    rng, out = np.random.default_rng(seed), np.zeros((len(counts), len(sizes)), np.int64)
    groups, held = [[]], 0
    for i, n in enumerate(counts):
        if groups[-1] and held + n > _LIMIT:
            groups, held = [*groups, []], 0
        groups[-1].append(i)
        held += n
    places = np.array(sizes, np.int64)
    for group in groups:
        mine = deal_line(rng, places, sum(counts[i] for i in group))
        places = places - mine
        for i in group:
            out[i] = deal_line(rng, mine, counts[i])
            mine = mine - out[i]
    return out


def shuffle_to_shards(
    df: DataFrame, shards: int, key: list[str], seed: int = 0,
    rows_per_block: int = 1_000_000, min_blocks: int = 128,
) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (from 0, without gaps in a shard).

    ``key`` should tell rows apart; rows equal in all of it are interchangeable, and nulls are
    values like any other. Input columns named shard or slot are replaced. An empty table stays
    empty. The same rows and seed give the same result whatever the partitioning.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    rows = df.drop("shard", "slot")
    total = rows.count()
    blocks = max(min_blocks, -(-total // rows_per_block))

    def draw(salt: int):
        return F.xxhash64(F.lit(seed), F.lit(salt), *[F.col(k) for k in key])

    rows = rows.withColumns({"__block": F.pmod(draw(1), F.lit(blocks)).cast("int")})
    counts = dict(rows.groupBy("__block").count().collect())
    present = sorted(counts)
    matrix = communication_matrix(
        [counts[b] for b in present], shard_sizes(total, shards), seed)
    lines = df.sparkSession.createDataFrame(
        [(b, line) for b, line in zip(present, np.cumsum(matrix, axis=1).tolist())],
        "__block int, __upto array<bigint>")
    inside = Window.partitionBy("__block").orderBy(draw(2), *key)
    dealt = (
        rows.withColumn("__at", F.row_number().over(inside))
        .join(lines, "__block")
        .withColumn("shard", F.size(F.filter("__upto", lambda c: c < F.col("__at"))))
        .drop("__block", "__at", "__upto")
        .withColumn("__part", F.pmod(
            draw(3), F.lit(max(8, -(-total // (shards * rows_per_block))))).cast("int"))
    )
    # Written once: the parts are counted and placed from the same rows, and lost work is reread.
    dealt = cut(dealt)
    parts = dealt.groupBy("shard", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = parts.select(
        "shard", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    again = Window.partitionBy("shard", "__part").orderBy(draw(4), *key)
    return (
        dealt.withColumn("__at", F.row_number().over(again))
        .join(parts, ["shard", "__part"])
        .withColumn("slot", F.col("__before") + F.col("__at") - 1)
        .select(*[c for c in df.columns if c not in ("shard", "slot")], "shard", "slot")
    )
