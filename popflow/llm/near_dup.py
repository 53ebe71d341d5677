"""Near duplicates by improved consistent weighted sampling over TF-IDF word shingles.

Texts are multisets of five-word shingles. With ``idf="every"`` a shingle weighs its count times
its smoothed inverse document frequency ``1 + ln((1 + N) / (1 + df))``, and the document frequency
of every shingle is counted exactly: the shingles of a batch of documents are dealt in packets to
slices of the hash range, a slice counts its shingles over all packets, and each packet's counts
return to its batch, which is signed there.

With ``idf="common"`` only what most documents hold loses weight: the frequency counts as
``min(1, ln(N / df) / ln(N / df0))`` with ``df0`` the larger of ``common * N`` and
``LEAST_DF``: what few documents share keeps its full weight whatever the size of a group of
copies, and what most documents hold falls to nothing. Only shingles beyond df0 need a number, and
those are few: one pass counts documents per hash bucket, a second counts the shingles of the full
buckets exactly.

Each text gets consistent weighted samples (Ioffe 2010), in bands. Equal texts are one node. Nodes
that share a band are candidates; components of the candidate graph bring each node's text to one
task, in blocks of bounded size, and there every candidate pair that is not yet linked is verified
by weighted Jaccard similarity. In components of several blocks, the buckets of each band whose
members are still in different classes are verified in the same way, bucket by bucket. A bucket
larger than a block is dealt anew until it links hardly any more, which leaves few classes; then all of its
pairs of different classes meet, half a block against half a block, so that no candidate pair stays
unverified. With the frequency of every shingle, texts leave before that which share none of their
rarest shingles with another class, as all similar pairs do. A class of more than half a block does
not meet itself, and what meets it does so once, however many buckets they share; so beside a large
class only the rest is repeated. Blocks are bounded in texts and in bytes.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import give_back, mix, small_batches, word_hashes
from popflow.session import cut

WORDS = 5
BANDS, ROWS = 14, 4  # a pair at 0.8 shares a band with probability 0.9994
COMMON, LEAST_DF = 0.5, 1000
BLOCK_NODES, BLOCK_BYTES = 512, 4 << 20
FEW_LINKS = 1 << 16  # that one task follows
LEAST_GAIN = 0.02  # links a class, below which large buckets are not dealt again
_BUCKETS, _SLICES = 1 << 18, 64
SLICE_BYTES = 16 << 20  # of text, whose shingles are counted together
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted shingle hashes and their counts, per text.

    A text of fewer than five words is one shingle; one without words has none.
    """
    words, counts = word_hashes(texts, lower=True)
    out, at = [], 0
    for n in counts.tolist():
        mine = words[at:at + n]
        at += n
        windows = max(n - WORDS + 1, min(n, 1))
        h = np.zeros(windows, np.uint64)
        for k in range(min(n, WORDS)):
            h = mix(h * _STEP + mine[k:k + windows])
        out.append(np.unique(h, return_counts=True))
    return out


def weighted(found: tuple[np.ndarray, np.ndarray], common: np.ndarray, idf: np.ndarray):
    """Shingles with positive weight, and the weights."""
    keys, counts = found
    w = counts.astype(np.float64)
    if len(common) and len(keys):
        at = np.minimum(np.searchsorted(common, keys), len(common) - 1)
        w = np.where(common[at] == keys, w * idf[at], w)
    keep = w > 0
    return keys[keep], w[keep]


def _within(most: float, wanted: float) -> bool:
    """Whether a sum that may be ``most`` reaches ``wanted``, but for rounding."""
    return most >= wanted * (1 - 1e-9)


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller over sum of the larger weights; 0 if neither has any."""
    total = a[1].sum() + b[1].sum()
    if not total:
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (total - both))


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution, 1 - (1 + x) exp(-x), for every 16-bit number."""
    wanted = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros(1 << 16), np.full(1 << 16, 64.0)
    for _ in range(60):
        x = (low + high) / 2
        below = -np.expm1(-x) - x * np.exp(-x) < wanted
        low, high = np.where(below, x, low), np.where(below, high, x)
    return (low + high) / 2


_GAMMA = _gamma_quantiles().astype(np.float32)
_LOG_GAMMA = np.log(_gamma_quantiles()).astype(np.float32)
_BETA = np.float32(2.0 ** -16)


def band_keys(texts: list[tuple[np.ndarray, np.ndarray]], bands: int, rows: int) -> np.ndarray:
    """One key per text and band, from samples (shingle, level); all 0 for texts without weight."""
    out = np.zeros((len(texts), bands), np.uint64)
    sizes = np.array([len(k) for k, _ in texts], np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    seeds = np.arange(1, bands * rows + 1, dtype=np.uint64) * _STEP
    at, ends = 0, np.cumsum(sizes[full])
    while at < len(full):  # spans that stay in cache
        done = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + (1 << 14), "right")))
        mine = full[at:upto]
        keys = np.concatenate([texts[i][0] for i in mine])
        log_w = np.log(np.concatenate([texts[i][1] for i in mine])).astype(np.float32)
        starts = np.cumsum(sizes[mine]) - sizes[mine]
        for k in range(bands * rows):
            parts = mix(keys ^ seeds[k]).view(np.uint16)  # four numbers of 16 bits
            r = _GAMMA[parts[0::4]]
            beta = parts[2::4].astype(np.float32) * _BETA
            level = np.floor(log_w / r + beta)
            a = _LOG_GAMMA[parts[1::4]] - r * (level - beta + np.float32(1))
            least = np.minimum.reduceat(a, starts)
            hits = np.flatnonzero(a == np.repeat(least, sizes[mine]))
            first = hits[np.searchsorted(hits, starts)]
            sample = mix(keys[first] + level[first].astype(np.int64).view(np.uint64) * _STEP)
            j = k // rows
            out[mine, j] = mix(out[mine, j] * _STEP + sample + np.uint64(j + 1))
        at = upto
    return out


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def common_shingles(docs: DataFrame, total: int, common: float, least_df: int):
    """(sorted hashes, idf) of the shingles in more than df0 of ``total`` documents.

    Their number is at most the mean number of shingles a document divided by ``common``.
    """
    df0 = max(common * total, least_df)
    if total <= df0:
        return np.empty(0, np.uint64), np.empty(0)
    width = _BUCKETS // _SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            for keys, _ in shingles(_bytes(batch.column("text"))):
                np.add.at(counts, np.unique(keys & np.uint64(_BUCKETS - 1)).astype(np.int64), 1)
            give_back()
        parts = counts.reshape(_SLICES, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(_SLICES, dtype=np.int32)),
             pa.array([p.tobytes() for p in parts], pa.binary())], names=["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(width, np.int64))
        for batch in batches:
            for i, c in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                sums[i] += np.frombuffer(c, np.int64)
        full = [i * width + int(b) for i, s in sums.items() for b in np.flatnonzero(s > df0)]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64())], names=["bucket"])

    # The vector per task has a fixed size; it is summed slice by slice.
    full = [r[0] for r in docs.mapInArrow(count, "slice int, counts binary")
            .repartition(_SLICES, "slice").mapInArrow(add, "bucket bigint").collect()]
    if not full:
        return np.empty(0, np.uint64), np.empty(0)
    wanted = np.zeros(_BUCKETS, bool)
    wanted[full] = True

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [k[wanted[(k & np.uint64(_BUCKETS - 1)).astype(np.int64)]]
                   for k, _ in shingles(_bytes(batch.column("text")))]
            keys, n = np.unique(np.concatenate([np.empty(0, np.uint64), *got]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])
            del got, keys, n, batch
            give_back()

    rows = docs.mapInArrow(exact, "key bigint, n bigint").groupBy("key").agg(
        F.sum("n").alias("df")).filter(F.col("df") > df0).collect()
    keys = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    df = np.array([r["df"] for r in rows], float)
    return keys[order], (np.log(total / df) / math.log(total / df0))[order]


def tfidf(found: tuple[np.ndarray, np.ndarray], df: np.ndarray, total: int):
    """Shingles and their counts times 1 + ln((1 + N) / (1 + df))."""
    keys, counts = found
    return keys, counts * (1 + np.log((1.0 + total) / (1.0 + df)))


_PACKET = "batch bigint, slice int, keys binary, df binary, held binary, often binary, times binary"


def _packets(bits: int):
    """The shingles of each batch of (id, node, text), dealt to 2 ** ``bits`` slices by their first
    bits, 40 further bits each, once a document; and one row of what stays with the batch."""
    slices = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            found = shingles(_bytes(batch.column("text")))
            sizes = np.array([len(k) for k, _ in found], np.int64)
            keys = np.concatenate([np.empty(0, np.uint64), *[k for k, _ in found]])
            times = np.concatenate([np.empty(0, np.int64), *[c for _, c in found]])
            which = (keys >> np.uint64(48)).astype(np.uint16) >> np.uint16(16 - bits)
            low = (keys >> np.uint64(24 - bits))[np.argsort(which, kind="stable")]
            low = low.view(np.uint8).reshape(-1, 8)[:, :5]
            ends = np.cumsum(np.bincount(which, minlength=slices)).tolist()
            # How many shingles of each document are in each slice, and those found repeatedly.
            held = np.bincount(np.repeat(np.arange(len(sizes)) * slices, sizes) + which,
                               minlength=len(sizes) * slices).astype(np.uint32)
            often = np.flatnonzero(times > 1)
            parts = [low[a:b].tobytes() for a, b in zip([0, *ends], ends)]
            some = [i for i, p in enumerate(parts) if p]
            n, none = len(some), pa.nulls
            of_batch = pa.array(np.full(n + 1, at))
            rows = np.arange(2, dtype=np.int32) * batch.num_rows
            columns = [
                of_batch, pa.array([*some, at % slices], pa.int32()),
                pa.array([*[parts[i] for i in some], None], pa.binary()),
                none(n + 1, pa.binary()),
                *[pa.array([*[None] * n, x], pa.binary()) for x in (
                    zlib.compress(held.tobytes(), 1), often.astype(np.uint32).tobytes(),
                    times[often].astype(np.uint32).tobytes())],
                *[pa.concat_arrays([none(n, pa.list_(c.type)), pa.ListArray.from_arrays(
                    pa.array(rows), c)]) for c in (batch.column("id"), batch.column("node"))]]
            yield pa.RecordBatch.from_arrays(columns, names=[
                "batch", "slice", "keys", "df", "held", "often", "times", "ids", "nodes"])
            at += 1
            del found, keys, times, which, low, held, parts, columns, batch
            give_back()
    return run


def _grouped(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """The rows of each value of ``by``, one value after the other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column(by).to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[0].column(by)[0].as_py() != key[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _count_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packets with 32 bits of each shingle and the number of documents that hold it."""
    for table in _grouped(batches, "slice"):
        of_batch = table.filter(table["keys"].is_null())
        if len(of_batch):
            yield from of_batch.to_batches()
        table = table.filter(table["keys"].is_valid())
        packets = table["keys"].to_pylist()
        raw = np.frombuffer(b"".join(packets), np.uint8).reshape(-1, 5)
        keys = np.zeros((len(raw), 8), np.uint8)
        keys[:, :5] = raw
        keys = keys.view(np.uint64).ravel()
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
        n = np.diff(np.r_[new, len(keys)]).astype(np.uint32)
        df = np.empty(len(keys), np.uint32)
        df[order] = np.repeat(n, n)
        at = 0
        for batch in table.to_batches(max_chunksize=256):
            sizes = [len(p) // 5 for p in batch.column("keys").to_pylist()]
            ends = np.cumsum([at, *sizes]).tolist()
            spans = list(zip(ends, ends[1:]))
            at = ends[-1]
            put = {"keys": [np.ascontiguousarray(raw[a:b, :4]).tobytes() for a, b in spans],
                   "df": [df[a:b].tobytes() for a, b in spans]}
            yield pa.RecordBatch.from_arrays(
                [pa.array(put[c], pa.binary()) if c in put else batch.column(c)
                 for c in batch.schema.names], names=batch.schema.names)
        del table, packets, raw, keys, order, new, n, df
        give_back()


def _sign_counted(bits: int, total: int, least: float, bands: int, rows: int):
    """(id, node, some, bands, df) of each batch's documents, its packets sorted by slice.

    A text with more than ``1 - least`` of its weight in shingles that no other document holds is
    not ``least`` similar to any other text; it needs no samples.
    """
    slices = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "batch"):
            own = table.filter(table["keys"].is_null()).to_pylist()
            table = table.filter(table["keys"].is_valid())
            keys, df = (np.frombuffer(b"".join(table[c].to_pylist()), np.uint32)
                        for c in ("keys", "df"))
            ids = own[0]["nodes"] if own else []
            held = np.frombuffer(zlib.decompress(own[0]["held"]), np.uint32).reshape(
                -1, slices) if own else np.zeros((0, slices), np.uint32)
            if len(own) != 1 or held.sum() != len(keys):
                raise RuntimeError("a batch of documents came back incomplete")
            # From the order by slice back to the order by document.
            doc = np.repeat(np.tile(np.arange(len(ids)), slices), held.T.ravel())
            order = np.argsort(doc, kind="stable")
            keys, df = keys[order].astype(np.uint64), df[order]
            times = np.ones(len(keys))
            times[np.frombuffer(own[0]["often"], np.uint32)] = np.frombuffer(
                own[0]["times"], np.uint32)
            ends = np.cumsum(held.sum(1, dtype=np.int64)).tolist()
            spans = list(zip([0, *ends], ends))
            keys, w = tfidf((keys, times), df, total)
            some = np.array([a < b and _within(w[a:b][df[a:b] > 1].sum(), least * w[a:b].sum())
                             for a, b in spans], bool)
            signed = band_keys([(keys[a:b], w[a:b]) if x else (keys[:0], w[:0])
                                for x, (a, b) in zip(some, spans)], bands, rows)
            offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * bands)
            back = table.schema.field("ids").type.value_type
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[0]["ids"], back), pa.array(ids, pa.binary()),
                 pa.array(some),
                 pa.ListArray.from_arrays(offsets, pa.array(signed.view(np.int64).ravel())),
                 pa.array([df[a:b].tobytes() for a, b in spans], pa.binary())],
                names=["id", "node", "some", "bands", "df"])
            del table, own, keys, df, held, doc, order, times, w, some, signed
            give_back()
    return run


def _signed_by_every(
    given: DataFrame, total: int, size: int, least: float, bands: int, rows: int,
) -> DataFrame:
    """(id, node, some, bands, df) of every document, ``df`` in the order of its shingles."""
    id_type = given.schema["id"].dataType.simpleString()
    bits = min(16, max(0, size // SLICE_BYTES).bit_length())
    packet = f"{_PACKET}, ids array<{id_type}>, nodes array<binary>"
    return (
        given.withColumn("node", text_node(F.col("text"))).mapInArrow(_packets(bits), packet)
        .repartition("slice").sortWithinPartitions("slice").mapInArrow(_count_slices, packet)
        .repartition("batch").sortWithinPartitions("batch", "slice")
        .mapInArrow(_sign_counted(bits, total, least, bands, rows),
                    f"id {id_type}, node binary, some boolean, bands array<bigint>, df binary"))


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) for the nodes of a task's few (a, b)."""
    links = _Links([])
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            links.up.setdefault(a, a)
            links.up.setdefault(b, b)
            links.link(a, b)
        kind = batch.schema.field("a").type
    if links.up:
        nodes = list(links.up)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, kind), pa.array([links.find(n) for n in nodes], kind)],
            names=["node", "root"])


def components(edges: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """(node, root) for the nodes of (a, b): alternating large and small stars until stable.

    The root is the smallest node of the component. Only minima are aggregated, so a node with
    very many neighbours is pre-aggregated and never gathered. Once at most ``few`` links are left,
    which are a few MB whatever the input, one task follows them to their roots.
    """
    def state(e: DataFrame):
        row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .filter("a != b").distinct())
    seen = None
    while (now := state(e)) != seen:
        if now[0] <= few:
            kind = e.schema["a"].dataType.simpleString()
            return e.coalesce(1).mapInArrow(_rooted, f"node {kind}, root {kind}")
        seen = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()
        e = cut(small)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


class _Links:
    """Union-find over the nodes of a block; the smallest node leads its class."""

    def __init__(self, nodes: list[bytes]):
        self.up = {n: n for n in nodes}

    def find(self, n: bytes) -> bytes:
        while self.up[n] != n:
            self.up[n] = n = self.up[self.up[n]]
        return n

    def link(self, a: bytes, b: bytes) -> None:
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def _candidates(rows: list[dict]) -> Iterator[tuple[bytes, bytes]]:
    """Pairs of a block that share a band; in a meeting, those across its sides.

    In a bucket's meeting a pair meets in the first band it shares only: an earlier bucket has it
    verified or in a class.
    """
    band = rows[0]["band"]
    if band is None:
        side = {r["node"]: r["side"] for r in rows}
        for k in range(len(rows[0]["bands"])):
            same: dict[int, list[bytes]] = defaultdict(list)
            for r in rows:
                same[r["bands"][k]].append(r["node"])
            for members in same.values():
                for i, x in enumerate(members):
                    for y in members[:i]:
                        if side[x] is None or side[x] != side[y]:
                            yield x, y
        return
    before = np.array([r["bands"][:band] for r in rows], np.int64).reshape(len(rows), band)
    side = np.array([r["side"] for r in rows])
    for i, r in enumerate(rows):
        meets = ~(before[:i] == before[i]).any(1) & ((side[:i] != side[i]) | (side[i] < 0))
        for j in np.flatnonzero(meets).tolist():
            yield r["node"], rows[j]["node"]


def _verify_block(rows: list[dict], least: float, weigh):
    """Node and leader of every node, after all candidate pairs of the block are settled."""
    nodes = [r["node"] for r in rows]
    sets = {r["node"]: weigh(s, r["df"]) for r, s in zip(rows, shingles(
        [(r["text"] or "").encode() for r in rows]))}
    sums = {n: s[1].sum() for n, s in sets.items()}
    # What a text may share is in the shingles that another text of the block holds.
    found, times = np.unique(np.concatenate([k for k, _ in sets.values()]), return_counts=True)
    shared = {n: w[times[np.searchsorted(found, k)] > 1].sum() for n, (k, w) in sets.items()}
    links, failed = _Links(nodes + [r["leader"] for r in rows]), set()
    for r in rows:
        links.link(r["node"], r["leader"])
    for x, y in _candidates(rows):
        if links.find(x) == links.find(y) or (x, y) in failed:
            continue
        most = min(shared[x], shared[y])
        if (_within(most, least * (sums[x] + sums[y] - most))
                and jaccard(sets[x], sets[y]) >= least):
            links.link(x, y)
        else:
            failed |= {(x, y), (y, x)}
    return [(r["node"], r["leader"], links.find(r["node"])) for r in rows]


def _verify(least: float, weigh):
    """Streams rows sorted by (place, block); holds one block at a time.

    ``weigh`` makes the weighted set of a text's shingles and the ``df`` that came with it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def result() -> pa.RecordBatch:
            columns = zip(*_verify_block(held, least, weigh))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary()) for c in columns], names=["node", "leader", "now"])

        for batch in batches:
            for row in batch.to_pylist():
                now = (row["place"], row["block"])
                if held and now != key:
                    yield result()
                    held = []
                key = now
                held.append(row)
            give_back()
        if held:
            yield result()
            held = []
        give_back()
    return run


def _verified(placed: DataFrame, texts: DataFrame, verify) -> DataFrame:
    """(node, leader, now) of the rows (place, block, band, side, node, leader)."""
    return cut(
        placed.join(texts.select("node", "bands", "text", "df"), "node")
        .repartition("place", "block").sortWithinPartitions("place", "block", "node")
        .select("place", "block", "band", "side", "node", "leader", "bands", "text", "df")
        .mapInArrow(verify, "node binary, leader binary, now binary"))


def _dealt(rows: DataFrame, turn: int) -> DataFrame:
    """Random blocks of the rows (place, parts, node, leader), ``parts`` of a place."""
    return rows.select(
        "place", F.pmod(F.xxhash64(F.lit(turn), "node"), "parts").cast("string").alias("block"),
        F.lit(None).cast("int").alias("band"), F.lit(None).cast("int").alias("side"), "node",
        "leader")


def _parts(sides: int, nodes: int, most: int):
    """Parts of a group's rows (.., size), ``sides`` of which make a block of about ``nodes`` texts
    and ``most`` bytes at most."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(max(1, nodes // sides))),
                      F.ceil(F.sum("size") / F.lit(max(1, most // sides)))).cast("int")


def _invited(rows: DataFrame, hosts: DataFrame, by: list[str], side: int) -> DataFrame:
    """Each row of a part of ``by`` once for every part of its hosts; see ``_meetings``."""
    return rows.join(hosts, by).withColumn("__other", F.explode(F.sequence(
        F.lit(0), F.col("__parts") - 1))).withColumn("side", F.lit(side))


def _meetings(rows: DataFrame, nodes: int, most: int) -> DataFrame:
    """Blocks in which all pairs of different leaders of the rows (place, band, node, size, leader)
    meet.

    The classes of a place with more than half a block there are large. The texts of its other
    classes meet each other in halves. Each of them meets the texts of a large class, and two large
    classes of a place meet each other, in halves too, but once for all places.
    """
    def part_of(df: DataFrame, by: list[str]) -> DataFrame:
        parts = cut(df.groupBy(*by).agg(_parts(2, nodes, most).alias("parts")))
        return df.join(parts, by).withColumn(
            "part", F.pmod(F.xxhash64(F.lit("half"), "node"), F.col("parts")))

    rows = rows.select("place", "band", "node", "size", "leader")
    classes = rows.groupBy("place", "leader").agg(_parts(2, nodes, most).alias("__halves"))
    placed = cut(rows.join(classes, ["place", "leader"]))
    small, large = placed.filter("__halves = 1"), placed.filter("__halves > 1")
    columns = ["place", "block", "band", "side", "node", "leader"]

    halves = part_of(small, ["place"])
    ways = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least(j, F.col("part")).alias("i"), F.greatest(j, F.col("part")).alias("j")))
    met = halves.withColumn("way", F.explode(ways)).select(
        "place", F.concat_ws(":", "way.i", "way.j").alias("block"), "band",
        F.when(F.col("way.i") == F.col("way.j"), -1).otherwise(
            (F.col("part") == F.col("way.j")).cast("int")).alias("side"), "node", "leader")

    members = large.select(F.col("leader").alias("host"), "node", "size", "leader").distinct()
    there = large.select("place", F.col("leader").alias("host")).distinct()
    # Guests of a large class: the texts of small classes there, and the other large classes.
    guests = small.join(there, "place").select("host", "node", "size", "leader").distinct()
    pairs = there.select("place", F.col("host").alias("guest")).join(there, "place").filter(
        "guest < host").select("host", "guest").distinct()
    guests = guests.withColumn("guest", F.lit(b"")).unionByName(
        pairs.join(members.withColumnRenamed("host", "guest"), "guest").select(
            "host", "node", "size", "leader", "guest"))
    guests = cut(part_of(guests, ["host", "guest"]))
    members = cut(part_of(members, ["host"]))
    of_guests = guests.select("host", "guest", F.col("parts").alias("__parts")).distinct()
    of_members = members.select("host", F.col("parts").alias("__parts")).distinct()
    came = _invited(guests, of_members, ["host"], 1).withColumn(
        "block", F.concat_ws(":", F.hex("guest"), "part", "__other"))
    kept = _invited(members, of_guests, ["host"], 0).withColumn(
        "block", F.concat_ws(":", F.hex("guest"), "__other", "part"))
    for invited in (came, kept):
        met = met.unionByName(invited.select(
            F.concat(F.lit(b"host:"), "host").alias("place"), "block",
            F.lit(None).cast("int").alias("band"), "side", "node", "leader"))
    return met.select(*columns)


def _prefixes(total: int, least: float):
    """(z, first, node, leader) for the rarest shingles z of each text.

    Of two texts at least ``least`` similar, the rarest shingle they share is followed by
    ``least`` of the weight of each, and by ``2 * least / (1 + least)`` of the lighter one's, which
    ``first`` says. Shingles of one document only are not shared.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, at, first = [], [], []
            for i, (s, df) in enumerate(zip(shingles(_bytes(batch.column("text"))),
                                            batch.column("df").to_pylist())):
                df = np.frombuffer(df, np.uint32)
                keys, w = tfidf(s, df, total)
                order = np.lexsort((keys, df))
                keys, w, df = keys[order], w[order], df[order]
                left = w[::-1].cumsum()[::-1] * (1 + 1e-9)
                take = (left >= least * w.sum()) & (df > 1)
                z.append(keys[take].view(np.int64))
                at.append(np.full(len(z[-1]), i))
                first.append(left[take] >= 2 * least / (1 + least) * w.sum())
            at = pa.array(np.concatenate(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(z)), pa.array(np.concatenate(first)),
                 batch.column("node").take(at), batch.column("leader").take(at)],
                names=["z", "first", "node", "leader"])
            give_back()
    return run


def _with_partners(rows: DataFrame, texts: DataFrame, total: int, least: float) -> DataFrame:
    """The rows (.., node, leader) whose text shares one of its rarest shingles with a text of
    another leader, whose rarest it is too, as every similar pair does. No pairs are made."""
    found = cut(rows.select("node", "leader").distinct().join(
        texts.select("node", "text", "df"), "node").select("text", "df", "node", "leader")
        .mapInArrow(_prefixes(total, least),
                    "z bigint, first boolean, node binary, leader binary"))
    several = found.groupBy("z").agg(
        F.min("leader").alias("a"), F.max("leader").alias("b"),
        F.max("first").alias("any")).filter("a != b AND any").select("z")
    left = cut(found.join(several, "z", "left_semi").select("node").distinct())
    return cut(rows.join(left, "node", "left_semi"))


def _new_links(found: DataFrame) -> DataFrame:
    """The links (a, b) between leaders that were found."""
    return cut(found.filter("leader != now").select(
        F.col("leader").alias("a"), F.col("now").alias("b")).distinct())


def _merged(leaders: DataFrame, links: DataFrame) -> DataFrame:
    """``leaders`` after the links."""
    to = components(links).withColumnsRenamed({"node": "leader", "root": "__to"})
    return cut(leaders.join(to, "leader", "left").select(
        "node", F.coalesce("__to", "leader").alias("leader")))


def _open(wide: DataFrame, leaders: DataFrame, nodes: int, most: int) -> DataFrame:
    """(band, bucket, place, parts, node, size, leader) of the buckets that hold several classes."""
    buckets = cut(wide.join(leaders, "node"))
    several = buckets.groupBy("band", "bucket").agg(
        _parts(1, nodes, most).alias("parts"), F.min("leader").alias("a"),
        F.max("leader").alias("b")).filter("a != b").select("band", "bucket", "parts")
    return cut(buckets.join(several, ["band", "bucket"]).withColumn(
        "place", F.concat_ws(":", "band", "bucket").cast("binary")))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8,
    bands: int = BANDS, rows: int = ROWS, common: float = COMMON, least_df: int = LEAST_DF,
    block_nodes: int = BLOCK_NODES, block_bytes: int = BLOCK_BYTES, idf: str = "common",
) -> DataFrame:
    """One row (``__node``, ``class_id``, ``class_rows``, ``first_id``, ``leader``) per text.

    ``__node`` is the md5 of the text (null as empty), ``class_id`` the smallest key in the class,
    null if it has none, ``class_rows`` the number of documents in it, ``first_id`` the smallest
    key with this text and ``leader`` whether this text stands for its class: exactly one does.
    Texts without words are only alike if equal. Very long texts are whole sets like others, and a
    block by themselves where they fill one. A table without rows gives none. Join with
    ``text_node(text)``. ``idf`` says which shingles' document frequencies count, those of "every"
    shingle or of "common" ones only.
    """
    given = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    small_batches(given)
    total, size = given.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    heavy, lighter = np.empty(0, np.uint64), np.empty(0)
    if idf == "common":
        heavy, lighter = common_shingles(given.select("text"), total, common, least_df)
    elif idf != "every":
        raise ValueError(f"idf is 'every' or 'common', not {idf!r}")

    def weigh(found: tuple[np.ndarray, np.ndarray], df: bytes | None):
        if df is None:
            return weighted(found, heavy, lighter)
        return tfidf(found, np.frombuffer(df, np.uint32), total)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [weigh(s, None) for s in shingles(_bytes(batch.column("text")))]
            keys = band_keys(found, bands, rows).view(np.int64)
            flat = pa.array(keys.ravel())
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * bands)
            some = pa.array([bool(len(k)) for k, _ in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("node"), some,
                 pa.ListArray.from_arrays(offsets, flat)], names=["id", "node", "some", "bands"])
            del found, keys, flat, offsets, batch
            give_back()

    id_type = given.schema["id"].dataType.simpleString()
    if idf == "every":
        signed = _signed_by_every(given, total, size or 0, least, bands, rows)
    else:
        signed = given.withColumn("node", text_node(F.col("text"))).mapInArrow(
            sign, f"id {id_type}, node binary, some boolean, bands array<bigint>").withColumn(
                "df", F.lit(None).cast("binary"))
    # Equal texts have equal bands; copies are combined before they are shuffled.
    nodes = cut(signed.groupBy("node").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.first("some").alias("some"),
        F.first("bands").alias("bands"), F.first("df").alias("df")))
    members = nodes.filter("some").select("node", F.posexplode("bands").alias("band", "bucket"))
    hubs = members.groupBy("band", "bucket").agg(
        F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # A bucket can hold a third of all texts: both sides are spread over salts.
    salts = max(16, total // 100_000)
    edges = members.withColumn(
        "salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")).join(
            hubs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))),
            ["band", "bucket", "salt"]).filter("node != hub").select(
                F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    roots = cut(components(edges).join(nodes.select("node", "first_id", "bands", "df"), "node"))
    # One document per candidate text; its text crosses the network here and to its block below.
    texts = cut(
        given.withColumn("node", text_node(F.col("text")))
        .join(roots, (F.col("id").eqNullSafe(F.col("first_id")))
              & (text_node(F.col("text")) == roots["node"]))
        .select(roots["node"], "root", "bands", "df", "text"))
    texts = cut(texts.dropDuplicates(["node"]).withColumn(  # rows alike in key and text
        "size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")))
    verify = _verify(least, weigh)
    bounds = block_nodes, block_bytes
    sizes = cut(texts.groupBy("root").agg(_parts(1, *bounds).alias("parts")))
    leaders = _verified(_dealt(
        texts.select(F.col("root").alias("place"), "node", F.col("node").alias("leader")).join(
            sizes.withColumnRenamed("root", "place"), "place"), 0),
        texts, verify).select("node", F.col("now").alias("leader"))
    wide = cut(texts.join(sizes.filter("parts > 1"), "root").select(
        "node", "size", F.posexplode("bands").alias("band", "bucket")))
    turn = 0
    while not wide.isEmpty():
        turn += 1
        todo = _open(wide, leaders, *bounds)
        links = _new_links(_verified(_dealt(todo, turn), texts, verify))
        # One pass settles every pair of the buckets that fit a block.
        large = todo.filter("parts > 1")
        wide = large.select("node", "size", "band", "bucket")
        n_links = links.count()
        if n_links:
            leaders = _merged(leaders, links)
        # Another deal is worth it while classes grow by it; the meetings leave out no pair.
        classes = large.agg(F.approx_count_distinct("leader")).first()[0]
        if n_links < LEAST_GAIN * classes:
            break
    if not wide.isEmpty():
        todo = _open(wide, leaders, *bounds)
        if idf == "every":
            todo = _with_partners(todo, texts, total, least)
        links = _new_links(_verified(_meetings(todo, *bounds), texts, verify))
        if not links.isEmpty():
            leaders = _merged(leaders, links)
    classes = nodes.join(leaders, "node", "left").withColumn(
        "leader", F.coalesce("leader", "node"))
    whole = classes.groupBy("leader").agg(
        F.min("first_id").alias("class_id"), F.sum("n").alias("class_rows"))
    return classes.join(whole, "leader").select(
        F.col("node").alias("__node"), "class_id", "class_rows", "first_id",
        (F.col("leader") == F.col("node")).alias("leader"))


def text_node(text):
    """Identity of a text: equal for equal texts, null like the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def with_class(docs: DataFrame, classes: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``class_id`` and ``class_rows`` on every row; such columns are replaced."""
    rows = docs.drop("class_id", "class_rows").withColumn("__node", text_node(F.col(text)))
    return rows.join(classes.select("__node", "class_id", "class_rows"), "__node").drop("__node")


def keep_one(
    docs: DataFrame, classes: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``docs`` for each class: its leading text's row with the smallest key.

    Of several such rows the smallest by all columns stays.
    """
    lead = classes.filter("leader").select("__node", "first_id")
    rows = docs.withColumn("__node", text_node(F.col(text)))
    kept = rows.join(lead, (rows["__node"] == lead["__node"])
                     & rows[key].eqNullSafe(lead["first_id"]), "left_semi")
    # A text's rows alike in key leave one, the smallest.
    return kept.groupBy("__node").agg(
        F.min(F.struct(*docs.columns)).alias("__row")).select("__row.*")
