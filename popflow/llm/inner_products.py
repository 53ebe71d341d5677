"""Exact search for the largest inner products, by length.

Vectors hold whole numbers. Two vectors' product is at most the product of their lengths, so going
through the candidates by descending length a query can stop as soon as its k-th product is above
that bound for all that follow. Before that, candidates are compared in an orthonormal basis from
a singular value decomposition, which puts most of a product into the leading coordinates: their
partial sum, plus the product of the lengths of what is left of both vectors (Cauchy and Schwarz),
bounds the product, and only pairs whose bound reaches the k-th product so far are multiplied out,
in whole numbers.

On Spark: the longest vectors, a bounded number, give every query a first k-th product, and with
its own length the shortest candidate that can still matter. Queries are ranked by that length and
cut into packs; candidates are ranked by their length, cut into blocks, dealt in turn to stretches,
and sent only to the packs they can matter to. A pack meets a stretch by key, so no task holds more
than one of each. Work and shuffle grow with the queries times the candidates that the bounds
leave, as the task asks for all of them.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popflow.llm.common import small_batches
from popflow.operators.ordering import rank_rows
from popflow.session import cut

SCALE = 256
BLOCK_ROWS = 1024  # candidates that share a bound on their length
BLOCKS = 8  # of a stretch
PACK_ROWS = 4096  # queries of a pack
SEED_ROWS = 4096  # longest vectors, for the first bounds
BASIS_ROWS = 8192  # sampled vectors, for the basis
LEAD = 0.8  # share of the squared lengths in the leading coordinates
_BYTES = 16 << 20  # of a pack, a stretch, the seeds or the sample; long vectors come in fewer rows
_SLACK = 1e-9  # of a product of lengths; far above the rounding of the bounds
_NONE = -(1 << 63)  # below any product


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v, length) of the rows that take part, each component as floor(scale * x).

    Null ids and vectors, and vectors with null or non-finite components, take no part.
    """
    finite = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= 1.7976931348623157e308))
    rows = df.select(F.col(key).cast("bigint").alias("id"),
                     F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
    squares = F.aggregate(F.col("v"), F.lit(0.0), lambda a, c: a + c.cast("double") * c)
    return rows.select("id", F.transform("v", lambda c: F.floor(c * float(scale))).alias("v")).withColumn(
        "length", F.sqrt(squares))


class Basis(NamedTuple):
    """Rotation, number of leading coordinates, and whether doubles hold all products exactly."""

    rotation: np.ndarray
    lead: int
    exact: bool


def fit_basis(x: np.ndarray, exact: bool, lead: float = LEAD) -> Basis:
    """Right singular vectors of ``x``; the leading ones hold ``lead`` of its squared lengths."""
    dim = x.shape[1]
    if not len(x):
        return Basis(np.eye(dim), dim, exact)
    scaled = x / max(1.0, np.abs(x).max())
    values, rotation = np.linalg.eigh(scaled.T @ scaled)
    energy = np.cumsum(np.maximum(values[::-1], 0.0))
    first = int(np.searchsorted(energy, lead * energy[-1])) + 1
    return Basis(rotation[:, ::-1], min(first, dim), exact)


class _Side(NamedTuple):
    """Vectors of one side: ids, whole numbers, rotated coordinates, lengths of all and the rest."""

    ids: np.ndarray
    x: np.ndarray
    lead: np.ndarray
    length: np.ndarray
    rest: np.ndarray

    def part(self, at) -> _Side:
        return _Side(*[c[at] for c in self])


def _dense(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to ``dim``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _side(ids: np.ndarray, x: np.ndarray, basis: Basis) -> _Side:
    as_double = x.astype(np.float64)
    rotated = as_double @ basis.rotation
    rest = rotated[:, basis.lead:]
    return _Side(ids, as_double if basis.exact else x, rotated[:, :basis.lead],
                 np.sqrt((as_double * as_double).sum(axis=1)), np.sqrt((rest * rest).sum(axis=1)))


class Best:
    """The best ``k`` candidates of each query so far, and the product a further one must reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor = floor.astype(np.int64)  # known before: that many candidates reach it
        self.score = np.full((len(floor), k), _NONE, np.int64)
        self.ids = np.full((len(floor), k), np.iinfo(np.int64).max)

    @property
    def wanted(self) -> np.ndarray:
        return np.maximum(self.floor, self.score[:, -1])

    def add(self, at: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Candidates of the queries ``at``; equal products go to the smaller id."""
        last, last_id = self.score[at, -1], self.ids[at, -1]
        better = (score >= self.floor[at]) & (
            (score > last) | ((score == last) & (ids < last_id)))
        at, ids, score = at[better], ids[better], score[better]
        if not len(at):
            return
        k = self.score.shape[1]
        rows = np.unique(at)
        at = np.concatenate([np.repeat(rows, k), at])
        ids = np.concatenate([self.ids[rows].ravel(), ids])
        score = np.concatenate([self.score[rows].ravel(), score])
        order = np.lexsort((ids, ~score, at))  # the complement turns whole numbers around
        at, ids, score = at[order], ids[order], score[order]
        first = np.searchsorted(at, rows)
        keep = first[:, None] + np.arange(k)
        self.ids[rows], self.score[rows] = ids[keep], score[keep]

    def found(self, q_ids: np.ndarray) -> pa.Table:
        at, place = np.nonzero(self.score > _NONE)
        return pa.table({"query_id": q_ids[at], "vec_id": self.ids[at, place],
                         "score": self.score[at, place]})


def search_side(queries: _Side, candidates: _Side, best: Best, block_rows: int,
                slice_rows: int = 256) -> None:
    """Candidates in blocks by descending length, each query until no longer one can matter."""
    order = np.lexsort((candidates.ids, -candidates.length))
    for a in range(0, len(order), block_rows):
        block = candidates.part(order[a:a + block_rows])
        longest = block.length[0]
        reach = queries.length * longest
        open_ = np.flatnonzero(reach * (1 + _SLACK) + _SLACK >= best.wanted)
        if not len(open_):
            return  # the following blocks are shorter still
        for b in range(0, len(open_), slice_rows):
            at = open_[b:b + slice_rows]
            q, wanted = queries.part(at), best.wanted[at]
            bound = q.lead @ block.lead.T + q.rest[:, None] * block.rest
            bound += _SLACK * (reach[at] + 1)[:, None]
            hit = (bound >= wanted[:, None]) & (q.ids[:, None] != block.ids)
            if 4 * np.count_nonzero(hit) > hit.size:
                product = (q.x @ block.x.T).astype(np.int64)
                i, j = np.nonzero(hit & (product >= wanted[:, None]))
                best.add(at[i], block.ids[j], product[i, j])
            else:
                i, j = np.nonzero(hit)
                best.add(at[i], block.ids[j], (q.x[i] * block.x[j]).sum(axis=1).astype(np.int64))


def top_products(rows: DataFrame, is_query: Column, k: int = 5, pack_rows: int = PACK_ROWS,
                 block_rows: int = BLOCK_ROWS, blocks: int = BLOCKS, seed_rows: int = SEED_ROWS,
                 basis_rows: int = BASIS_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest products of every row ``is_query`` picks.

    ``rows`` comes from ``whole_vectors``. All rows are candidates but those that share the query's
    id; of several rows with one query id the smallest vector is the query, and as candidates they
    count each. Equal products go to the smaller id. A shorter vector counts as filled up with
    zeros. Queries have fewer than ``k`` rows only where there are fewer candidates; an empty table
    gives no rows. Vectors so long that a product could leave 64 bits stop the search.

    Bounded on the driver: the seeds, the sample for the basis (any basis gives the same result),
    and one number per pack of queries.
    """
    small_batches(rows, 10_000)
    rows = cut(rows)
    spark = rows.sparkSession
    total, dim, longest = rows.agg(
        F.count(F.lit(1)), F.max(F.size("v")), F.max("length")).first()
    names = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not total:
        return spark.createDataFrame([], names)
    if longest * longest * (1 + _SLACK) >= 2.0 ** 63:
        raise ValueError("products of these vectors may leave 64 bits")
    dim = max(1, dim)

    def at_most(n: int) -> int:
        return max(16, min(n, _BYTES // (8 * dim)))

    def local(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        table = df.select("id", "v").toArrow()
        return table["id"].to_numpy(), _dense(table["v"], dim)

    share = int(min(1.0, at_most(basis_rows) / total) * (1 << 30))
    _, sample = local(rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share))
    basis = fit_basis(sample.astype(np.float64), longest * longest * (1 + _SLACK) < 2.0 ** 53)
    seeds = _side(*local(rows.orderBy(F.desc("length"), "id").limit(at_most(seed_rows))), basis)

    def first_bounds(batches):
        for batch in batches:
            ids, x = batch.column("id").to_numpy(), _dense(batch.column("v"), dim)
            q = _side(ids, x, basis)
            best = Best(np.full(len(ids), _NONE), k)
            search_side(q, seeds, best, block_rows)
            kth = best.score[:, -1]
            need = np.where((kth > 0) & (q.length > 0),
                            kth / np.maximum(q.length, 1e-300) * (1 - 1e-8), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(kth), pa.array(need)],
                names=["id", "v", "kth", "need"])

    asked = rows.filter(is_query).groupBy("id").agg(F.min("v").alias("v")).mapInArrow(
        first_bounds, "id bigint, v array<bigint>, kth bigint, need double")
    packed = rank_rows(asked, ["need", "id"], (), out="rank").withColumn(
        "pack", F.floor((F.col("rank") - 1) / at_most(pack_rows)).cast("bigint")).drop("rank")
    needs = [r["need"] for r in packed.groupBy("pack").agg(
        F.min("need").alias("need")).orderBy("pack").collect()]  # ascending, by the ranks
    if not needs:
        return spark.createDataFrame([], names)
    in_block = at_most(block_rows)
    stretches = -(-total // (in_block * blocks))
    packed = packed.withColumn("stretch", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.lit(stretches - 1).cast("bigint"))))
    # Blocks are dealt in turn, so that each stretch has vectors of all lengths.
    block = F.floor((F.col("rank") - 1) / in_block)
    bounds = F.array(*[F.lit(float(n)) for n in needs])
    sent = (
        rank_rows(rows, [F.desc("length"), "id"], (), out="rank")
        .withColumn("stretch", F.pmod(block, F.lit(stretches)).cast("bigint"))
        .withColumn("packs", F.size(F.filter(bounds, lambda b: b <= F.col("length"))))
        .filter("packs > 0")
        .withColumn("pack", F.explode(F.sequence(
            F.lit(0).cast("bigint"), (F.col("packs") - 1).cast("bigint"))))
        .select("pack", "stretch", "id", "v"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        q_ids = left["id"].to_numpy()
        best = Best(left["kth"].to_numpy(), k)
        if len(q_ids) and right.num_rows:
            search_side(_side(q_ids, _dense(left["v"], dim), basis),
                        _side(right["id"].to_numpy(), _dense(right["v"], dim), basis),
                        best, in_block)
        return best.found(q_ids)

    keys = ["pack", "stretch"]
    found = packed.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(
        meet, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
