"""Language-model scores from an Elias-Fano trie of n-grams, sharded by context.

The model is interpolated Kneser-Ney of order 2. A shard owns the contexts that hash to it, with
their successors; contexts so frequent that they would fill a shard are split over all shards by
successor. Each shard is a small trie: contexts with a quantised back-off weight, words with a
quantised unigram probability and their count, monotone pointers from a context to its successors,
and the successors with quantised probabilities. A successor is stored as its rank among the
shard's words plus the last number before its context, which keeps the whole level monotone, and
is found by a successor search relative to its context.

What a shard cannot know alone (counts of words, totals of split contexts) is asked from a second
set of shards by word. Documents reach the shards as bigrams grouped by context, and leave them as
partial sums, packed by batch of documents. The number of shards follows the bytes of text, so a
shard stays as large as it is; no model, vocabulary or count is ever in one place as a whole. (For
inputs of many terabytes, raise the bytes per shard and per batch with the memory of the workers:
the number of packets is that of batches times shards.)
"""

from __future__ import annotations

import mmap
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import forget, mix, small_batches, text_bytes, word_hashes
from popflow.llm.elias_fano import EliasFano
from popflow.session import cut

END = np.uint64(0x3C6EF372FE94F82B)  # the token after the last word
START = np.uint64(0xA54FF53A5F1D36F1)  # the context of the first token
SHARD_BYTES = 1 << 24  # of text to a shard
BATCH_BYTES, BATCH_TEXTS = 1 << 23, 1 << 16  # packed at a time
BUFFER_EVENTS = 1 << 19  # looked up in one pass over a shard's levels
LEVELS = 255  # of the quantised logarithms

_BLOBS = "shard int, kind int, payload binary"


def dump(*arrays: np.ndarray) -> bytes:
    """Arrays, compressed: sorted hashes as the bytes of their differences, plane by plane, and
    other integers as narrow as they can be."""
    small = []
    for a in arrays:
        if a.dtype == np.uint64 and len(a) > 1 and (a[1:] > a[:-1]).all():
            a = np.ascontiguousarray(np.diff(a, prepend=np.uint64(0)).view(np.uint8)
                                     .reshape(-1, 8).T)
        elif a.dtype.kind in "iu" and len(a):
            a = a.astype(np.min_scalar_type(a.max()))
        small.append(a)
    raw = pickle.dumps(small, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def undump(blob: bytes) -> list[np.ndarray]:
    arrays = pickle.loads(pa.Codec("zstd").decompress(
        blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True))
    return [np.cumsum(np.ascontiguousarray(a.T).view(np.uint64)[:, 0], dtype=np.uint64)
            if a.ndim == 2 else a for a in arrays]


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    shard, kind, payload = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(shard, pa.int32()), pa.array(kind, pa.int32()),
         pa.array(payload, pa.binary())], names=["shard", "kind", "payload"])


def _owner(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (mix(hashes) % np.uint64(shards)).astype(np.int64)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different tokens (START among them), their numbers in order, and each text's count.

    The numbers have START before the first token of every text, so that the context of a token is
    the number before it; the counts are without it.
    """
    words, counts = word_hashes(texts, lower=True)
    sizes = counts + 2
    ends = np.cumsum(sizes) - 1
    out = np.empty(len(words) + 2 * len(texts), np.uint64)
    inner = np.ones(len(out), bool)
    inner[ends] = inner[ends - sizes + 1] = False
    out[inner], out[ends], out[ends - sizes + 1] = words, END, START
    del words, inner
    names, numbers = np.unique(out, return_inverse=True)
    return names, numbers.astype(np.int32), counts + 1


def _grouped(names: np.ndarray, numbers: np.ndarray, sizes: np.ndarray, texts: np.ndarray,
             weight: np.ndarray):
    """Distinct (context, word, text) in order, with summed weights; ``texts`` and ``weight`` are
    per text."""
    n, m = np.uint64(len(names)), np.uint64(int(texts.max()) + 1)
    token = np.ones(len(numbers), bool)
    token[np.cumsum(sizes + 1) - sizes - 1] = False
    at = np.flatnonzero(token)
    key = (numbers[at - 1].astype(np.uint64) * n + numbers[at].astype(np.uint64)) * m
    key += np.repeat(texts, sizes).astype(np.uint64)
    del token, at
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    total = np.add.reduceat(np.repeat(weight, sizes)[order], new)
    key = key[new]
    del order
    pair = key // m
    return (pair // n).astype(np.int32), (pair % n).astype(np.int32), (
        key - pair * m).astype(np.int32), total


def _packed(names, first, word, rest: list[np.ndarray], shards: int, hot: np.ndarray):
    """(shard, arrays) for the bigrams of a batch: hashes of contexts, their run lengths, hashes
    of words, a word number for each bigram, and the ``rest`` along."""
    split = np.isin(names, hot)
    owner = _owner(names, shards)[first]
    some = split[first]
    owner[some] = _owner(names[first[some]] ^ mix(names[word[some]]), shards)
    order = np.argsort(owner, kind="stable")  # contexts stay sorted inside a shard
    edges = np.searchsorted(owner[order], np.arange(shards + 1))
    for s in range(shards):
        mine = order[edges[s]:edges[s + 1]]
        if len(mine):
            f, w = first[mine], word[mine]
            run = np.flatnonzero(np.r_[True, f[1:] != f[:-1]])
            used, number = np.unique(w, return_inverse=True)
            yield s, [names[f[run]], np.diff(np.r_[run, len(f)]), names[used], number,
                      *[r[mine] for r in rest]]


def _pack_counts(shards: int, hot: np.ndarray):
    """Bigrams of a stream of (text, train) with their training counts; 0 for held-out ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, rest in _portions_of_rows(batches):
            names, numbers, sizes = tokens(texts)
            texts.clear()
            weight = rest.column("train").to_numpy().astype(np.int32)
            f, w, _, n = _grouped(names, numbers, sizes, np.zeros(len(sizes), np.int32), weight)
            del numbers
            yield _blobs([(s, 0, dump(*a)) for s, a in _packed(names, f, w, [n], shards, hot)])
    return run


def _portions_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], pa.Table]]:
    """Texts in portions of about BATCH_BYTES, with the table of the other columns."""
    texts, tables, size = [], [], 0
    for whole in batches:
        for first in range(0, whole.num_rows, 64):  # few texts as objects at a time
            batch = whole.slice(first, 64)
            rest, start = batch.drop_columns(["text"]), 0
            for i, text in enumerate(batch.column("text").cast(pa.large_binary()).to_pylist()):
                texts.append(text or b"")
                size += len(texts[-1])
                if size >= BATCH_BYTES or len(texts) >= BATCH_TEXTS:
                    yield texts, pa.Table.from_batches(
                        [*tables, rest.slice(start, i + 1 - start)]).combine_chunks()
                    texts, tables, size, start = [], [], 0, i + 1
                    pa.default_memory_pool().release_unused()
            if start < batch.num_rows:
                tables.append(rest.slice(start))
    if texts:
        yield texts, pa.Table.from_batches(tables).combine_chunks()


def _by_shard(batches: Iterator[pa.RecordBatch]):
    """(shard, iterator of (kind, payload)) for rows sorted by shard and kind."""
    rows = ((s, k, p) for b in batches for s, k, p in zip(
        b.column("shard").to_pylist(), b.column("kind").to_pylist(),
        b.column("payload").to_pylist()))
    held: list = [next(rows, None)]

    def one(shard: int):
        while held[0] is not None and held[0][0] == shard:
            yield held[0][1:]
            held[0] = next(rows, None)

    while held[0] is not None:
        shard = held[0][0]
        inside = one(shard)
        yield shard, inside
        for _ in inside:  # what the caller left
            pass
        pa.default_memory_pool().release_unused()


def _merge(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Packed bigrams of several batches as one: contexts, runs, words, word numbers, counts."""
    contexts, c_ids = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    words, w_ids = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
    keys, counts, c_at, w_at = [], [], 0, 0
    for p in parts:
        c = c_ids[c_at:c_at + len(p[0])]
        w = w_ids[w_at:w_at + len(p[2])]
        c_at, w_at = c_at + len(p[0]), w_at + len(p[2])
        keys.append(np.repeat(c, p[1].astype(np.int64)) * len(words) + w[p[3]])
        counts.append(p[4].astype(np.int64))
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key, count = key[order], count[order]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    key, count = key[new], np.add.reduceat(count, new)
    first = key // len(words)
    return [contexts, np.bincount(first, minlength=len(contexts)), words, key % len(words), count]


def _count(shards: int, merge_after: int = 64):
    """Counts of each shard (kind 0), and what it asks from the shards of words (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            parts: list[list[np.ndarray]] = []
            for _, payload in rows:
                parts.append(undump(payload))
                if len(parts) >= merge_after:
                    parts = [_merge(parts)]
            contexts, runs, words, number, n = _merge(parts)
            seen = n > 0
            of = np.repeat(np.arange(len(contexts)), runs)
            asked = [
                (words, np.bincount(number, n, len(words)), np.bincount(
                    number, seen, len(words))),
                (contexts, np.bincount(of, n, len(contexts)), np.bincount(
                    of, seen, len(contexts)))]
            once = [int((n == k).sum()) for k in (1, 2)]
            out = [(shard, 0, dump(contexts, runs, words, number, n))]
            owners = [_owner(h, shards) for h, _, _ in asked]
            for u in range(shards):
                mine = [np.flatnonzero(o == u) for o in owners]
                out.append((u, 1, dump(*[a[i].astype(a.dtype if a.dtype == np.uint64 else np.int64)
                                         for (q, i) in zip(asked, mine) for a in q],
                                       np.array([shard, *(once if u == 0 else (0, 0))]))))
            yield _blobs(out)
    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of words and contexts to the shards that asked (kind 1), and sums (kind 2)."""
    for u, rows in _by_shard(batches):
        asked = [undump(p) for _, p in rows]
        out, sums = [], np.zeros(7, np.int64)
        totals = []
        for at in (0, 3):
            names, ids = np.unique(np.concatenate([a[at] for a in asked]), return_inverse=True)
            values = [np.bincount(ids, np.concatenate([a[at + k] for a in asked]), len(names))
                      .astype(np.int64) for k in (1, 2)]
            totals.append((ids, values))
        (_, (count, before)), _ = totals
        sums[:5] = (count.sum(), (count > 0).sum(), before.sum(),
                    (before == 1).sum(), (before == 2).sum())
        places = [0, 0]
        for a in asked:
            reply = []
            for j, (ids, values) in enumerate(totals):
                mine = ids[places[j]:places[j] + len(a[3 * j])]
                places[j] += len(mine)
                reply += [a[3 * j], *[v[mine] for v in values]]
            sums[5:] += a[6][1:]
            out.append((int(a[6][0]), 1, dump(*reply)))
        yield _blobs([*out, (u, 2, dump(sums))])


def _codes(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms as one byte each between their extremes."""
    low, high = (logs.min(), logs.max()) if len(logs) else (0.0, 0.0)
    step = (high - low) / LEVELS or 1.0
    return np.rint((logs - low) / step).astype(np.uint8), np.array([low, step])


def discount(once: int, twice: int) -> float:
    """Absolute discount from the numbers of things counted once and twice."""
    return once / (once + 2 * twice) if once else 0.5


def _build(totals: np.ndarray):
    """The trie of each shard, from its counts and the answers, as one row of raw levels."""
    n_tokens, n_words, n_pairs, w_once, w_twice, p_once, p_twice = (int(x) for x in totals)
    d1, d2 = discount(w_once, w_twice), discount(p_once, p_twice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            replies = []
            for kind, payload in rows:
                if kind == 0:
                    contexts, runs, words, number, n = undump(payload)
                else:
                    replies.append(undump(payload))
            by = []
            for j in (0, 3):
                order = np.argsort(np.concatenate([r[j] for r in replies]))
                by.append([np.concatenate([r[j + k] for r in replies])[order].astype(np.int64)
                           for k in (1, 2)])
            (count, different), (total, kinds) = by
            pairs = max(n_pairs, 1)
            unigram = np.maximum(different - d1, 0) / pairs + (
                d1 * n_words / pairs if n_pairs else 1.0) / (n_words + 1)
            of = np.repeat(np.arange(len(contexts)), runs.astype(np.int64))
            seen = n > 0
            known = total > 0
            back_off = np.where(known, d2 * kinds / np.maximum(total, 1), 1.0)
            of, number, n = of[seen], number[seen].astype(np.int64), n[seen].astype(np.int64)
            p = np.maximum(n - d2, 0) / total[of] + back_off[of] * unigram[number]
            place = np.cumsum(known) - 1
            starts = np.searchsorted(of, np.flatnonzero(known))
            pointers = np.r_[starts, len(of)]
            # Ranks grow inside a context; each starts after the last number before it.
            last = np.maximum(pointers[1:] - 1, 0)
            gain = np.where(pointers[1:] > pointers[:-1], number[last] + 1 if len(number) else 0, 0)
            base = np.cumsum(gain) - gain
            level = base[place[of]] + number
            yield _blobs([(shard, 0, pickle.dumps({
                "contexts": EliasFano.encode(contexts[known]),
                "back_off": _codes(np.log10(back_off[known])),
                "pointers": EliasFano.encode(pointers),
                "successors": EliasFano.encode(level),
                "pair": _codes(np.log10(p)),
                "words": EliasFano.encode(words),
                "unigram": _codes(np.log10(unigram)),
                "count": count, "totals": totals}))])
    return run


class Trie:
    """A shard's levels, mapped from an unnamed file that goes with the task."""

    def __init__(self, blob: bytes):
        parts = pickle.loads(blob)
        self.file = tempfile.TemporaryFile()
        places = {}
        for name, part in parts.items():
            arrays = [x for x in (part if isinstance(part, tuple) else (part,))
                      if isinstance(x, np.ndarray)]
            places[name] = []
            for a in arrays:
                places[name].append((self.file.tell(), a.dtype, len(a)))
                self.file.write(a.tobytes())
        self.file.write(b"\0")
        self.file.flush()
        view = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)

        def mapped(name: str) -> list[np.ndarray]:
            return [np.frombuffer(view, t, n, at) for at, t, n in places[name]]

        for name in ("contexts", "pointers", "successors", "words"):
            setattr(self, name, EliasFano(*parts[name][:2], *mapped(name)))
        self.back_off, self.pair, self.unigram = map(
            mapped, ("back_off", "pair", "unigram"))
        self.count, self.totals = mapped("count")[0], mapped("totals")[0]

    @staticmethod
    def _log(level: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        codes, (low, step) = level
        return low + step * codes[at]

    def score(self, contexts, words, context, word):
        """(log10 probability, log10 of the base model, known) of bigrams: sorted distinct hashes
        and, sorted by both, the numbers of context and word of each bigram."""
        place, has = self.contexts.successors(contexts)
        rank, listed = self.words.successors(words)
        if not listed.all():
            raise ValueError("a word is missing from its shard")
        n_tokens, n_words = int(self.totals[0]), int(self.totals[1])
        count = self.count[rank]
        base = np.log10((count + 0.5) / (n_tokens + 0.5 * (n_words + 1)))
        place = np.where(has, place, 0)
        out = self._log(self.unigram, rank)[word]
        if not self.contexts.n:
            return out, base[word], (count > 0)[word]
        pointers = self.pointers.slice(0, self.pointers.n).astype(np.int64)
        start, end = pointers[place], pointers[place + 1]
        if self.successors.n:
            # The number before a context's first successor is what its ranks were added to.
            base_at = np.maximum(start - 1, 0)
            order = np.argsort(base_at, kind="stable")
            before = np.empty(len(place), np.uint64)
            before[order] = self.successors.take(base_at[order]) + np.uint64(1)
            before[start == 0] = 0
            wanted = before[context] + rank[word].astype(np.uint64)
            ask = np.flatnonzero(has[context] & (end > start)[context])
            # Beyond a context's range the numbers of the next begin: sort, then check the range.
            ask = ask[np.argsort(wanted[ask], kind="stable")]
            at, equal = self.successors.successors(wanted[ask])
            found = equal & (at >= start[context[ask]]) & (at < end[context[ask]])
            out = out + np.where(has, self._log(self.back_off, place), 0.0)[context]
            out[ask[found]] = self._log(self.pair, at[found])
        return out, base[word], (count > 0)[word]


def _pack_events(shards: int, hot: np.ndarray):
    """Bigrams of each document for the shards (kind 1), and the documents' other columns (2).

    Documents are numbered inside their batch, a batch by the number of its first row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, rest in _portions_of_rows(batches):
            names, numbers, sizes = tokens(texts)
            n_texts = len(texts)
            texts.clear()
            f, w, t, n = _grouped(names, numbers, sizes, np.arange(n_texts),
                                  np.ones(n_texts, np.int32))
            del numbers
            batch, out = rest.column("row")[0].as_py(), []
            for s, arrays in _packed(names, f, w, [t, n], shards, hot):
                used, arrays[4] = np.unique(arrays[4], return_inverse=True)
                out.append((s, 1, dump(*arrays, used, np.array([batch]))))
            rest = rest.drop_columns(["row"]).append_column("n_tokens", pa.array(sizes))
            rest = rest.append_column("batch", pa.array(np.full(len(sizes), batch)))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema) as writer:
                writer.write_table(rest)
            out.append((int(batch % shards), 2, sink.getvalue().to_pybytes()))
            yield _blobs(out)
    return run


_SUMS = "batch bigint, kind int, payload binary"


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over a shard's bigrams for the documents of each batch (kind 1), and the batch (0)."""
    def row(batch: int, kind: int, payload: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([batch], pa.int64()), pa.array([kind], pa.int32()),
             pa.array([payload], pa.binary())], names=["batch", "kind", "payload"])

    def settle(trie: Trie, held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        contexts, c_ids = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        words, w_ids = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
        context, word, c_at, w_at = [], [], 0, 0
        for h in held:
            c, w = c_ids[c_at:c_at + len(h[0])], w_ids[w_at:w_at + len(h[2])]
            c_at, w_at = c_at + len(h[0]), w_at + len(h[2])
            context.append(np.repeat(c, h[1].astype(np.int64)))
            word.append(w[h[3]])
        score, base, known = trie.score(
            contexts, words, np.concatenate(context), np.concatenate(word))
        at = 0
        for h in held:
            mine = slice(at, at + len(h[3]))
            at += len(h[3])
            sums = [np.bincount(h[4], h[5] * v[mine], len(h[6])) for v in (known, base, score)]
            yield row(int(h[7][0]), 1, dump(h[6], sums[0].astype(np.int64), *sums[1:]))

    for _, payloads in _by_shard(batches):
        trie, held, size = None, [], 0
        for kind, payload in payloads:
            if kind == 0:
                trie = Trie(payload)
            elif kind == 2:
                first = next(iter(pa.ipc.open_stream(payload)))
                yield row(first.column("batch")[0].as_py(), 0, payload)
            else:
                held.append(undump(payload))
                size += len(held[-1][3])
                if size >= BUFFER_EVENTS:
                    yield from settle(trie, held)
                    held, size = [], 0
        if held:
            yield from settle(trie, held)


def _add_up(schema: pa.Schema):
    """The documents of each batch with the sums over all shards; rows sorted by batch and kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sums = None, []

        def result() -> Iterator[pa.RecordBatch]:
            columns = [table.column(f.name) if f.name in table.column_names
                       else pa.array(sums[schema.names[-3:].index(f.name)]) for f in schema]
            return iter(pa.table(columns, schema=schema).to_batches())

        for batch in batches:
            for kind, payload in zip(batch.column("kind").to_pylist(),
                                     batch.column("payload").to_pylist()):
                if kind == 0:
                    if table is not None:
                        yield from result()
                    table = pa.ipc.open_stream(payload).read_all()
                    sums = [np.zeros(len(table), t) for t in (np.int64, np.float64, np.float64)]
                else:
                    used, *parts = undump(payload)
                    for total, part in zip(sums, parts):
                        total[used] += part.astype(total.dtype)
        if table is not None:
            yield from result()
    return run


def _frequent_words(docs: DataFrame, shards: int, sample: int = 2000) -> np.ndarray:
    """Hashes of the words that hold over an eighth of a shard's share in a sample of texts.

    Which words these are only decides where their bigrams lie, not any count or score.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            words, numbers, _ = tokens([t or b"" for t in texts])
            n = np.bincount(numbers, minlength=len(words))
            keep = n * 16 * shards >= n.sum()  # at most 16 words a shard
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[keep].view(np.int64)), pa.array(n[keep]),
                 pa.array(np.where(np.arange(keep.sum()) == 0, n.sum(), 0))],
                names=["word", "n", "total"])

    share = min(1.0, sample / max(1, docs.count()))
    found = docs.select("text").sample(False, share, 1).mapInArrow(
        count, "word bigint, n bigint, total bigint").groupBy("word").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    total = sum(r["total"] for r in found)
    return np.array([r["word"] for r in found if r["n"] * 8 * shards >= total],
                    np.int64).view(np.uint64)


def _gathered(rows: DataFrame, shards: int) -> DataFrame:
    return rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind")


def score_documents(
    docs: DataFrame, train: Column, text: str = "text", shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` without the text, with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    and ``score``, all documents being scored by the model of those that ``train`` picks.

    Null texts are empty ones: a single end token. Texts are scored whole, however long. Without training documents every token has the
    same probability. Repeated rows are scored each. Input columns with the names of the results
    are replaced. ``train`` must not be null.
    """
    small_batches(docs)
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    rest = [c for c in docs.columns if c not in (*results, text)]
    given = docs.select(*rest, F.col(text).alias("__text"), train.alias("__train"))
    texts = given.select(F.col("__text").alias("text"), F.col("__train").alias("train"))
    shards = max(8, -(-text_bytes(texts) // shard_bytes))
    hot = _frequent_words(texts, shards)
    counted = cut(_gathered(texts.mapInArrow(_pack_counts(shards, hot), _BLOBS), shards)
                  .mapInArrow(_count(shards), _BLOBS))
    answers = cut(_gathered(counted.filter("kind = 1"), shards).mapInArrow(_answer, _BLOBS))
    totals = np.zeros(7, np.int64)
    for row in answers.filter("kind = 2").collect():  # seven numbers from each shard
        totals += undump(row["payload"])[0].astype(np.int64)
    model = cut(_gathered(
        counted.filter("kind = 0").unionByName(answers.filter("kind = 1")), shards)
        .mapInArrow(_build(totals), _BLOBS))
    forget(counted, answers)
    # One job numbers the rows, packs them and brings their sums together again.
    numbered = given.select(
        *rest, F.col("__text").alias("text"), F.monotonically_increasing_id().alias("row"))
    renamed = {c: f"c{i}" for i, c in enumerate(rest)}
    events = numbered.withColumnsRenamed(renamed).mapInArrow(_pack_events(shards, hot), _BLOBS)
    kinds = [f"{renamed[f.name]} {f.dataType.simpleString()}" for f in given.select(*rest).schema]
    out = ", ".join([*kinds, "n_tokens bigint", "n_known bigint", "base_score double",
                     "score double"])
    parts = _gathered(model.unionByName(events), shards).mapInArrow(_score, _SUMS)
    # Neither a batch nor its sums are ever rows of documents: they stay packed until here.
    summed = parts.repartition("batch").sortWithinPartitions("batch", "kind").mapInArrow(
        _add_up(df_schema(docs, out)), out).withColumnsRenamed(
            {n: c for c, n in renamed.items()})
    return summed.withColumn("train_tokens", F.lit(int(totals[0])).cast("bigint")).select(*rest, *results)


def df_schema(docs: DataFrame, ddl: str) -> pa.Schema:
    """Arrow schema of a table with these columns."""
    return docs.sparkSession.createDataFrame([], ddl).toArrow().schema
