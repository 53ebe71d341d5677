"""Encoding into the pieces of a SentencePiece vocabulary, and back.

The text, with one blank before it as SentencePiece adds it, is cut into words: letters, digits or
other signs with at most one blank before them, runs of blanks up to the last one, and single other
white-space characters. A run of more than ``LONGEST`` characters is several words. For the
different words of a batch of documents a lattice is built as a relation: their substrings up to
the longest piece are exploded, equi-joined with the piece table, and the edges grouped by word and
end. Substrings are exploded a length at a time and joined with the beginnings of the pieces, so
that those no piece begins with are not made longer. A fold with the higher-order function
``aggregate`` (Viterbi) keeps the best way to each position, the last one being the word's pieces,
and the batch's documents are put together from its words. A character no piece covers becomes its
UTF-8 bytes, which the vocabulary has as pieces of their own, so every text can be decoded exactly;
U+2581, which stands for the blank, is one.

Batches are bounded and nothing is shuffled: the piece table is as large as the vocabulary. A task
keeps the words it has seen, up to a number of bytes, and builds lattices for new ones only; they
travel in rows of their own before the documents. (One dictionary for the whole corpus was tried:
bringing the words of each text back to it takes a join on the words and another on the texts, over
three times the input in shuffle files.)

A vocabulary whose scores are merge ranks has no probabilities; pieces are then scored by Zipf's
law on the rank, ``-ln(rank + 2)``. Decoding is a column expression over the table of pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import give_back, small_batches

LONGEST = 4096  # letters, digits, signs or blanks of a word; a longer run is several words
BATCH_TEXTS, BATCH_WORDS = 250, 1 << 15
KNOWN_BYTES, LATTICE_CHARS = 3 << 20, 1 << 15  # of words a task keeps; of words exploded at a time
UNKNOWN = -20.0  # score of a character written as bytes
_ROW_BITS, _LENGTHS = 21, 64  # of an edge: place in the piece table, and how long the piece is
_EDGE_BITS = _ROW_BITS + 6
_COST_MASK = -(1 << _EDGE_BITS)
_UNIT = 1 << 16  # costs, the scores' negatives, are multiples of 1 / _UNIT
_UNKNOWN_COST = round(-UNKNOWN * _UNIT)
WORDS = (rf" ?\p{{L}}{{1,{LONGEST}}}| ?\p{{N}}{{1,{LONGEST}}}"
         rf"| ?[^\s\p{{L}}\p{{N}}]{{1,{LONGEST}}}| {{1,{LONGEST}}}(?= )|\s")


class Vocabulary(NamedTuple):
    """Ordinary pieces (blanks for U+2581) with their ids and scores, and the ids of the bytes."""

    pieces: list[tuple[str, int, float]]
    byte_ids: list[int]

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)


def load(model_file: str) -> Vocabulary:
    """Read a model file; its byte pieces must be complete."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    byte_ids, plain = {}, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            plain.append((piece.replace("▁", " "), i, model.get_score(i)))
    if len(byte_ids) != 256:
        raise ValueError("the vocabulary needs a piece for each byte")
    if all(float(score).is_integer() for _, _, score in plain):
        plain = [(p, i, -float(np.log(rank + 2))) for rank, (p, i, _) in enumerate(plain)]
    return Vocabulary(plain, [byte_ids[b] for b in range(256)])


def words_of(text: Column) -> Column:
    """Words of a text; put together they are a blank and the text. None for null or empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(F.concat(F.lit(" "), text), F.lit(WORDS), F.lit(0)))


class Prefixes(NamedTuple):
    """Beginnings of one length of the pieces."""

    keys: pa.Array  # number of the beginning that is a character shorter, and the last character
    rows: np.ndarray  # place of the piece in the table, -1 for what only begins one


def prefixes_of(pieces: list[str]) -> list[Prefixes]:
    """The piece table by beginnings, for each length from 1."""
    found: list[dict[str, int]] = [{} for _ in range(max(map(len, pieces), default=0))]
    for row, piece in enumerate(pieces):
        for n in range(1, len(piece)):
            found[n - 1].setdefault(piece[:n], -1)
        if piece and found[len(piece) - 1].get(piece, -1) < 0:
            found[len(piece) - 1][piece] = row
    out, shorter = [], {"": 0}
    for level in found:
        out.append(Prefixes(
            pa.array([shorter[p[:-1]] << _ROW_BITS | ord(p[-1]) for p in level], pa.int64()),
            np.array(list(level.values()), np.int64)))
        shorter = {p: i for i, p in enumerate(level)}
    return out


def lattice(words: pa.Array, prefixes: list[Prefixes], costs: np.ndarray) -> pa.ListArray:
    """Edges of each word by end position: cost, length less 1 and row of the piece in one number.

    A character without a piece has as its row the length of the table plus its code point.
    """
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    text = "".join(words.to_pylist())
    signs = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    left = np.repeat(ends, sizes) - np.arange(len(signs))  # characters of the word from here
    start, prefix = np.arange(len(signs)), np.zeros(len(signs), np.int64)
    found = []
    for n, (keys, rows) in enumerate(prefixes):
        within = left[start] > n
        start, prefix = start[within], prefix[within]
        if not len(start):
            break
        at = pc.index_in(pa.array(prefix << _ROW_BITS | signs[start + n]), value_set=keys)
        joined = at.is_valid().to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        row = np.where(joined, rows[at], -1)
        if n == 0:
            row = np.where(row < 0, len(costs) + signs, row)
        piece = row >= 0
        row = row[piece]
        cost = np.where(row < len(costs), costs[np.minimum(row, len(costs) - 1)], _UNKNOWN_COST)
        found.append((start[piece] + n, (cost << _EDGE_BITS) + (n << _ROW_BITS) + row))
        start, prefix = start[joined], at[joined]
    # Grouped by word and end: every position of a word has at least one edge.
    ways = np.zeros(len(signs), np.int64)
    for end, _ in found:
        ways[end] += 1
    firsts = np.r_[0, np.cumsum(ways)]
    edges, place = np.empty(firsts[-1], np.int64), firsts[:-1].copy()
    for end, edge in found:
        edges[place[end]] = edge
        place[end] += 1
    by_end = pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(edges))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), by_end)


def viterbi(ends: Column) -> Column:
    """Best way to each position of a word, the last first: the cost above, its last edge below.

    An edge carries its cost, length and row in one number, so a step adds the least cost where it
    starts to it and the smallest sum wins; ties go to the later start.
    """
    def step(best: Column, ways: Column) -> Column:
        def reach(edge: Column) -> Column:
            back = F.shiftright(edge, _ROW_BITS).bitwiseAND(F.lit(_LENGTHS - 1)).cast("int")
            return F.get(best, back).bitwiseAND(F.lit(_COST_MASK)) + edge
        return F.array_prepend(best, F.array_min(F.transform(ways, reach)))

    return F.aggregate(ends, F.array(F.lit(0).cast("bigint")), step)


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0 and the values of a list column."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten()


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most BATCH_TEXTS texts and about BATCH_WORDS words."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + BATCH_WORDS, "right")) - 1
        b = min(n, a + BATCH_TEXTS, max(a + 1, b))
        yield a, b
        a = b


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``pieces``, the ids of the text's pieces; none for null or empty texts.

    Other columns, the text among them, stay; an input column ``pieces`` is replaced.
    """
    small_batches(docs)
    rest = [c for c in docs.columns if c != "pieces"]
    kinds = {f.name: f.dataType.simpleString() for f in docs.select(*rest).schema}
    # The text itself travels as its words; whether it is null goes in its place.
    named = {c: f"c{i}" for i, c in enumerate(rest)}
    sent = {c: "boolean" if c == text else k for c, k in kinds.items()}
    prefixes = prefixes_of([p for p, _, _ in vocabulary.pieces])
    costs = np.rint([-s * _UNIT for _, _, s in vocabulary.pieces]).astype(np.int64)
    if len(costs) + 0x110000 > 1 << _ROW_BITS or vocabulary.longest >= _LENGTHS:
        raise ValueError("the vocabulary or its pieces are too large for the edges")

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of words that are new since the row that began afresh, with their lattices, and
        rows of documents: their columns, and words by number."""
        names = [*named.values(), "counts", "codes", "dictionary", "lattices", "afresh"]

        def row(columns: list[pa.Array], afresh: bool = False) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
                + [pa.array([afresh])], names=names)

        known, afresh = pa.array([], pa.string()), True
        no_words, no_codes = known, pa.array([], pa.int32())
        no_lattices = pa.array([], pa.list_(pa.list_(pa.int64())))
        for batch in batches:
            offsets, flat = _flat(batch.column("words"))
            coded = flat.cast(pa.string()).dictionary_encode()
            if known.nbytes > KNOWN_BYTES:
                known, afresh = no_words, True
            at = pc.index_in(coded.dictionary, value_set=known)
            new = coded.dictionary.filter(pc.is_null(at))
            place = at.fill_null(-1).to_numpy().astype(np.int32)
            place[place < 0] = len(known) + np.arange(len(new), dtype=np.int32)
            codes = place[coded.indices.to_numpy()]
            known = pa.concat_arrays([known, new])
            ends = np.cumsum(pc.utf8_length(new).to_numpy(zero_copy_only=False))
            borders = np.unique(np.r_[0, np.searchsorted(ends, np.arange(
                LATTICE_CHARS, ends[-1] if len(ends) else 0, LATTICE_CHARS)), len(new)])
            columns = {n: batch.column(n) for n in named.values()}
            nothing = [c.slice(0, 0) for c in columns.values()]
            for i, j in zip(borders, borders[1:]):
                part = new.slice(i, j - i)
                edges_of = lattice(part, prefixes, costs)
                yield row([*nothing, no_codes, no_codes, part, edges_of], afresh)
                afresh = False
            for a, b in _slices(offsets):
                yield row([*(c.slice(a, b - a) for c in columns.values()),
                           pa.array((offsets[a:b + 1] - offsets[a]).astype(np.int32)),
                           pa.array(codes[offsets[a]:offsets[b]]), no_words, no_lattices])
            give_back()

    rows = docs.select(*[
        (F.col(c).isNull() if c == text else F.col(c)).alias(n) for c, n in named.items()],
        words_of(F.col(text)).alias("words"))
    batched = rows.mapInArrow(edges, ", ".join(
        f"{n} array<{sent[c]}>" for c, n in named.items())
        + ", counts array<int>, codes array<int>, dictionary array<string>"
        ", lattices array<array<array<bigint>>>, afresh boolean")
    best = batched.select(*named.values(), "counts", "codes", "dictionary", "afresh", F.transform(
        "lattices", viterbi).alias("best"))
    ids = np.array([i for _, i, _ in vocabulary.pieces], np.int32)
    bytes_of = np.array(vocabulary.byte_ids, np.int32)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The rows of a task come in the order in which they left ``edges``.
        no_words, no_pieces = pa.array([], pa.string()), pa.array([], pa.list_(pa.int32()))
        words, found = [no_words], [no_pieces]
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                counts, codes, new = (
                    row.column(n).flatten() for n in ("counts", "codes", "dictionary"))
                if row.column("afresh")[0].as_py():
                    words, found = [no_words], [no_pieces]
                if len(new):
                    ways = _rows_of(row.column("best").flatten())
                    sizes, values = _pieces_of(ways, ids, bytes_of)
                    words.append(new.cast(pa.string()))
                    found.append(pa.ListArray.from_arrays(
                        pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values)))
                if not len(counts):
                    continue
                counts = counts.to_numpy()
                if len(words) > 1:
                    words, found = [pa.concat_arrays(words)], [pa.concat_arrays(found)]
                upto, flat = _flat(found[0].take(codes))
                texts = pc.binary_join(pa.ListArray.from_arrays(
                    pa.array(counts), words[0].take(codes)), "")
                columns = []
                for c, n in named.items():
                    values = row.column(n).flatten()
                    if c == text:  # without the blank before it
                        values = pc.if_else(values, pa.scalar(None, pa.string()),
                                            pc.utf8_slice_codeunits(texts, 1))
                    columns.append(values)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.ListArray.from_arrays(
                        pa.array(upto[counts].astype(np.int32)), flat)],
                    names=[*rest, "pieces"])
                give_back()

    return best.mapInArrow(apply, ", ".join(
        f"`{c}` {k}" for c, k in kinds.items()) + ", pieces array<int>")


def _rows_of(best: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and rows of the pieces of each word, followed back from its last position."""
    offsets, flat = _flat(best)
    edge = flat.to_numpy(zero_copy_only=False)
    at, begin = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64) - 1
    words = np.flatnonzero(at < begin)
    at = at[words]
    found = []
    while len(words):
        last = edge[at]
        found.append((words, last & ((1 << _ROW_BITS) - 1)))
        at = at + 1 + (last >> _ROW_BITS & (_LENGTHS - 1))
        on = at < begin[words]
        words, at = words[on], at[on]
    if not found:
        return np.zeros(1, np.int64), np.empty(0, np.int64)
    word = np.concatenate([w for w, _ in found[::-1]])
    rows = np.concatenate([r for _, r in found[::-1]])
    order = np.argsort(word, kind="stable")
    return np.searchsorted(word[order], np.arange(len(best) + 1)), rows[order]


def _pieces_of(ways: tuple[np.ndarray, np.ndarray], ids: np.ndarray, bytes_of: np.ndarray):
    """Number of pieces of each word, and the pieces of all."""
    offsets, rows = ways
    known = rows < len(ids)
    if known.all():
        return np.diff(offsets), ids[rows]
    word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    codes = {i: chr(rows[i] - len(ids)).encode() for i in np.flatnonzero(~known).tolist()}
    width = np.ones(len(rows), np.int64)
    for i, c in codes.items():
        width[i] = len(c)
    out = np.repeat(np.where(known, ids[np.where(known, rows, 0)], 0), width)
    at = np.cumsum(width) - width
    for i, c in codes.items():
        out[at[i]:at[i] + width[i]] = bytes_of[list(c)]
    return np.bincount(word, width, len(offsets) - 1).astype(np.int64), out.astype(np.int32)


def decode(encoded: DataFrame, vocabulary: Vocabulary, out: str = "decoded") -> DataFrame:
    """``encoded`` with the text its ``pieces`` stand for; an input column ``out`` is replaced.

    Ids outside the vocabulary stand for nothing, null or no pieces for the empty text.
    """
    parts: dict[int, bytes] = {i: p.encode() for p, i, _ in vocabulary.pieces}
    parts.update({i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)})
    # One constant of the plan, as large as the vocabulary.
    table = F.split(F.lit(",".join(parts.get(i, b"").hex() for i in range(max(parts) + 1))), ",")
    joined = F.array_join(F.transform("pieces", lambda p: F.get(table, p)), "")
    # The blank that encoding put before the text goes.
    text = F.substring(F.unhex(joined).cast("string"), 2, 1 << 30)
    rest = [F.col(c) for c in encoded.columns if c != out]
    return encoded.select(*rest, F.coalesce(text, F.lit("")).alias(out))


def default_model() -> str:
    """The public vocabulary with byte pieces, where it is installed."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))
