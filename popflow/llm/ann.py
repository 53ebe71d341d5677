"""Nearest neighbours by cosine with a hierarchical k-means tree.

The tree is fitted on a bounded sample: each node splits its part by spherical k-means until parts
are small. Every vector is then put into the leaf its centres lead to. A query walks the tree best
bin first: a priority queue holds unopened nodes by the similarity of their centre, the best one is
opened, and leaves come out in the order in which they should be visited. How many leaves a query
visits is calibrated: a bounded set of queries is answered by brute force over all rows, and the
visits are widened until their recall reaches the target.

Leaves are packed into blocks of bounded size by (leaf, part); a leaf with a third of all vectors
has many parts. Queries meet the blocks of their leaves in an equi-join on that key, and every pair
of blocks keeps the best few candidates of each query, ties included.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popflow.session import cut

BRANCHES = 8
BLOCK_ROWS = 512
_SLACK = 1e-9  # above the rounding of matrix products, below any difference that matters


class Tree(NamedTuple):
    """Unit centres and children (empty for leaves) of each node; leaf number of leaf nodes."""

    centres: np.ndarray
    children: list[list[int]]
    leaf_no: np.ndarray

    @property
    def leaves(self) -> int:
        return int((self.leaf_no >= 0).sum())


def unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their length, in double precision and without overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8):
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        best = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, best, x)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norm > 0, sums / np.maximum(norm, 1e-300), centres)
    return (x @ centres.T).argmax(axis=1), centres


def fit_tree(x: np.ndarray, leaf_rows: int, branches: int = BRANCHES, seed: int = 0) -> Tree:
    """Tree over unit vectors; a part of copies of one vector is not split further."""
    rng = np.random.default_rng(seed)
    centres, children, leaf_no, leaves = [x.mean(axis=0)], [[]], [-1], 0
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        part = x[rows]
        if len(rows) > max(leaf_rows, branches):
            best, found = _k_means(part, branches, rng)
            used = np.unique(best)
            if len(used) > 1:
                for j in used:
                    children[node].append(len(centres))
                    todo.append((len(centres), rows[best == j]))
                    centres.append(found[j])
                    children.append([])
                    leaf_no.append(-1)
                continue
        leaf_no[node] = leaves
        leaves += 1
    return Tree(np.array(centres), children, np.array(leaf_no))


def assign(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf of each unit vector: the nearest centre at every level."""
    node = np.zeros(len(x), np.int64)
    inner = np.array([bool(c) for c in tree.children])
    while True:
        open_nodes = np.unique(node[inner[node]])
        if not len(open_nodes):
            return tree.leaf_no[node]
        for n in open_nodes:
            rows = np.flatnonzero(node == n)
            kids = np.array(tree.children[n])
            node[rows] = kids[(x[rows] @ tree.centres[kids].T).argmax(axis=1)]


def best_bins(tree: Tree, q: np.ndarray) -> Iterator[int]:
    """Leaves in the order in which the priority queue opens them."""
    queue = [(-1.0, 0)]
    while queue:
        _, node = heapq.heappop(queue)
        kids = tree.children[node]
        if not kids:
            yield int(tree.leaf_no[node])
            continue
        for similarity, kid in zip(tree.centres[kids] @ q, kids):
            heapq.heappush(queue, (-float(similarity), kid))


def visits(tree: Tree, q: np.ndarray, sizes: np.ndarray, least: int, rows: int) -> list[int]:
    """The first ``least`` leaves, and more until they hold ``rows`` vectors."""
    out, held = [], 0
    for leaf in best_bins(tree, q):
        if len(out) >= least and held >= rows:
            break
        out.append(leaf)
        held += int(sizes[leaf])
    return out


def exact_cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of each row pair, always summed in the same order.

    Rows are first divided by a power of two near their largest component, which changes no digit
    and keeps vectors of extreme size from leaving the range of doubles.
    """
    q, x = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (q, x))
    dot = (q * x).sum(axis=1)
    return dot / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1)))


def top_k(q_ids, q, x_ids, x, k: int):
    """Best ``k`` candidates of every query in a block: (query row, candidate row, cosine).

    Products of matrices pick the candidates down to just below the k-th, so that ties stay in;
    their cosines are then computed pair by pair and ordered with the smaller id first.
    """
    similar = unit(q) @ unit(x).T
    similar[q_ids[:, None] == x_ids[None, :]] = -np.inf
    kth = np.partition(similar, -k, axis=1)[:, -k] if x.shape[0] > k else (
        np.full(len(q), -2.0))
    at_q, at_x = np.nonzero(similar >= np.maximum(kth, -2.0)[:, None] - _SLACK)
    score = np.empty(len(at_q))
    for a in range(0, len(at_q), 1 << 16):  # copies can make this long
        s = slice(a, a + (1 << 16))
        score[s] = exact_cosines(q[at_q[s]], x[at_x[s]])
    order = np.lexsort((x_ids[at_x], -score, at_q))
    at_q, at_x, score = at_q[order], at_x[order], score[order]
    first = np.searchsorted(at_q, np.arange(len(q)))
    keep = np.arange(len(at_q)) - first[at_q] < k
    return at_q[keep], at_x[keep], score[keep]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), dim)


def valid_vectors(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(id, v) of the rows that take part, and their dimension.

    Null ids, null, empty or zero vectors and those with null or non-finite components take no part.
    A vector shorter than the longest counts as filled up with zeros.
    """
    # Absolute values below the largest finite number: false for NaN and the infinities.
    finite = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= 1.7976931348623157e308))
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull()).filter(
            F.coalesce(finite, F.lit(False)) & F.exists("v", lambda c: c != 0))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    zero = F.lit(0).cast(rows.schema["v"].dataType.elementType)
    filled = F.concat("v", F.array_repeat(zero, F.lit(dim) - F.size("v")))
    return rows.select("id", F.when(F.size("v") == dim, F.col("v")).otherwise(filled).alias("v")), dim


def _pack(dim: int, block_rows: int, keys: list[str]):
    """Rows of a sorted partition packed into blocks that share their keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_key, n = [], None, 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate([i for i, _ in held])
            x = np.concatenate([v for _, v in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([k]) for k in held_key] + [
                    pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                    pa.array([x.astype(np.float64).tobytes()], pa.binary())],
                names=[*keys, "ids", "block"])

        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
            ids, x = batch.column("id").to_numpy(), _matrix(batch.column("v"), dim)
            edges = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for a, b in zip(np.r_[0, edges], np.r_[edges, len(ids)]):
                mine = [int(v) for v in key[a]] if b > a else None
                while a < b:
                    if n and (mine != held_key or n >= block_rows):
                        yield block()
                        held, n = [], 0
                    held_key = mine
                    c = min(b, a + block_rows - n)
                    held.append((ids[a:c], x[a:c]))
                    n, a = n + c - a, c
        if n:
            yield block()
    return run


def _packed(df: DataFrame, dim: int, block_rows: int, keys: list[str]) -> DataFrame:
    """Blocks of at most ``block_rows`` rows with equal keys, as raw doubles."""
    schema = ", ".join(f"{k} bigint" for k in keys) + ", ids binary, block binary"
    return df.repartition(*keys).sortWithinPartitions(*keys, "id").mapInArrow(
        _pack(dim, block_rows, keys), schema)


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each query, nearest first, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


_FOUND = "query_id bigint, vec_id bigint, score double"


def _found(q_ids, x_ids, hits) -> pa.RecordBatch:
    at_q, at_x, score = hits
    return pa.RecordBatch.from_arrays(
        [pa.array(q_ids[at_q]), pa.array(x_ids[at_x]), pa.array(score)],
        names=["query_id", "vec_id", "score"])


def brute_force(rows: DataFrame, dim: int, q_ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """Exact neighbours of a bounded set of queries over all rows, in one scan."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column("id").to_numpy(), _matrix(batch.column("v"), dim)
            for a in range(0, len(ids), 2048):
                yield _found(q_ids, ids[a:a + 2048], top_k(
                    q_ids, q, ids[a:a + 2048], x[a:a + 2048].astype(np.float64), k))

    return _best(rows.select("id", "v").mapInArrow(run, _FOUND), k)


class Index(NamedTuple):
    """The tree, its leaves' sizes, the table (id, v, leaf) and the calibrated visits."""

    tree: Tree
    sizes: np.ndarray
    rows: DataFrame
    dim: int
    visits: int
    recall: float


def build(
    rows: DataFrame, dim: int, is_query: Column, k: int = 5, recall: float = 0.97,
    sample_rows: int = 20_000, leaf_rows: int = 400, most_leaves: int = 1024,
    calibrate: int = 100,
) -> Index:
    """Fit on about ``sample_rows`` vectors, index every row, calibrate on about ``calibrate``
    queries. All three bounds, and the number of leaves, do not grow with the data."""
    total = rows.count()

    def some(df: DataFrame, n: int, most: int, salt: str):
        share = F.lit(min(1.0, n / max(1, most)) * (1 << 30))
        got = df.filter(F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(1 << 30)) < share)
        got = got.orderBy("id").toPandas()
        return got["id"].to_numpy(np.int64), np.array(got["v"].tolist(), np.float64).reshape(
            len(got), dim)

    _, x = some(rows, sample_rows, total, "fit")
    if not len(x):
        _, x = some(rows, total, total, "fit")
    wanted = min(most_leaves, max(1, total // leaf_rows))
    # Without vectors the tree is one leaf.
    tree = (fit_tree(unit(x), max(1, len(x) // wanted)) if len(x)
            else Tree(np.zeros((1, dim)), [[]], np.array([0])))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dim).astype(np.float64)
            leaf = assign(tree, unit(x)).astype(np.int64) if len(x) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(leaf)], names=["id", "v", "leaf"])

    placed = cut(rows.mapInArrow(
        place, f"id bigint, v {rows.schema['v'].dataType.simpleString()}, leaf bigint"))
    sizes = np.zeros(tree.leaves, np.int64)
    for leaf, n in placed.groupBy("leaf").count().collect():  # one row per leaf
        sizes[leaf] = n
    queries = placed.filter(is_query).groupBy("id").agg(F.min("v").alias("v"))
    q_ids, q = some(queries, calibrate, queries.count(), "calibrate")
    if not len(q):
        return Index(tree, sizes, placed, dim, 1, 1.0)
    truth = brute_force(placed, dim, q_ids, q, k).join(
        placed.select(F.col("id").alias("vec_id"), "leaf").distinct(), "vec_id")
    order = {int(i): {leaf: n for n, leaf in enumerate(best_bins(tree, v))}
             for i, v in zip(q_ids, unit(q))}
    needed = np.array([order[r["query_id"]][r["leaf"]] + 1
                       for r in truth.select("query_id", "leaf").collect()])
    least, reached = 1, 1.0
    if len(needed):
        reached = float((needed <= least).mean())
        while reached < recall and least < tree.leaves:  # one leaf more at a time
            least += 1
            reached = float((needed <= least).mean())
    return Index(tree, sizes, placed, dim, least, reached)


def _parts(index: Index, block_rows: int) -> np.ndarray:
    """The number of parts of each leaf."""
    return -(-index.sizes // (8 * block_rows))


def query_blocks(index: Index, is_query: Column, k: int, block_rows: int) -> DataFrame:
    """(leaf, part, q_ids, q): of each block of queries those that visit the leaf, as raw numbers.

    A task walks the tree for a block or two, and lets go of the queries of one leaf before it
    gathers those of the next: what it holds does not grow with the visits.
    """
    tree, sizes, least, dim = index.tree, index.sizes, index.visits, index.dim
    parts = _parts(index, block_rows)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, block_rows):
                ids = batch.column("id")[a:a + block_rows].to_numpy().astype(np.int64)
                x = _matrix(batch.column("v")[a:a + block_rows], dim).astype(np.float64)
                to = [visits(tree, q, sizes, least, k + 1) for q in unit(x)]
                at = np.repeat(np.arange(len(to)), [len(v) for v in to])
                leaf = np.array([n for v in to for n in v], np.int64)
                order = np.argsort(leaf, kind="stable")
                at, leaf = at[order], leaf[order]
                edges = np.flatnonzero(np.diff(leaf, prepend=-1, append=-1))
                for b, c in zip(edges[:-1], edges[1:]):
                    block = [pa.array([v[at[b:c]].tobytes()], pa.binary()) for v in (ids, x)]
                    for p in range(parts[leaf[b]]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([leaf[b]], pa.int64()), pa.array([p], pa.int64()), *block],
                            names=["leaf", "part", "q_ids", "q"])

    queries = index.rows.filter(is_query).select("id", "v")
    # The few bytes of the queries say nothing of their visits, so their number sets the tasks.
    tasks = queries.select("id").distinct().count() // block_rows + 1
    return queries.repartition(tasks, "id").groupBy("id").agg(F.min("v").alias("v")).mapInArrow(
        walk, "leaf bigint, part bigint, q_ids binary, q binary")


def search(index: Index, is_query: Column, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of every indexed row that ``is_query`` picks.

    Rows that share the query's id are not its candidates; of several rows with one query id the
    smallest vector is the query. An empty table gives no rows. Fewer than ``k`` rows come only where
    there are fewer candidates.
    """
    dim, parts = index.dim, _parts(index, block_rows)
    left = query_blocks(index, is_query, k, block_rows)
    # A number of parts per leaf; both arrays are as long as the tree has leaves.
    spread = F.element_at(F.array(*[F.lit(int(p)) for p in np.maximum(parts, 1)]),
                          (F.col("leaf") + 1).cast("int"))
    stored = index.rows.withColumn("part", F.pmod(F.xxhash64("id", "v"), spread).cast("bigint"))
    keys = ["leaf", "part"]
    both = left.join(_packed(stored, dim, block_rows, keys).hint("merge"), keys).select(
        "q_ids", "q", "ids", "block")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Best candidates of the task's pairs of blocks; those of one query are merged here."""
        held, n = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            q_ids, ids, score = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((ids, -score, q_ids))
            q_ids, ids, score = q_ids[order], ids[order], score[order]
            rank = np.arange(len(q_ids)) - np.searchsorted(q_ids, q_ids)
            keep = np.flatnonzero(rank < k)
            return q_ids[keep], ids[keep], score[keep]

        for batch in batches:
            for i in range(batch.num_rows):  # read in place
                row = {c: batch.column(c)[i].as_buffer() for c in batch.schema.names}
                q_ids, ids = (np.frombuffer(row[c], np.int64) for c in ("q_ids", "ids"))
                q, x = (np.frombuffer(row[c], np.float64).reshape(-1, dim) for c in ("q", "block"))
                at_q, at_x, score = top_k(q_ids, q, ids, x, k)
                held.append((q_ids[at_q], ids[at_x], score))
                n += len(score)
                if n > 1 << 18:
                    held = [merged()]
                    n = len(held[0][0])
                    if n > 1 << 17:  # many different queries: let them go
                        yield _found(held[0][0], held[0][1], (slice(None), slice(None), held[0][2]))
                        held, n = [], 0
        if held:
            q_ids, ids, score = merged()
            yield _found(q_ids, ids, (slice(None), slice(None), score))

    found = both.mapInArrow(meet, _FOUND)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
