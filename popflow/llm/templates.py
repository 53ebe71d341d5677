"""Main text of web pages by equivalence classes of tokens.

Pages of one host are made from a template. Tokens of a page are its elements (by their path) and
its words (by the element they stand in). Over a group of pages of a host every token has an
occurrence vector: how often it occurs in each page. Tokens that share a vector form a class; a
class is valid if it is frequent enough and its tokens keep one order in every page. The class of
tokens found once in every page is the root of the template. Every other token is nested in the
class of the element around it, in the slot between two neighbouring tokens of that class; a token
that is not in one slot on all its pages is no part of the template. Blocks whose tokens are all of
the template belong to it, all others fill its slots. The main text is what the slots hold, without
those that lie in elements for menus, adverts and the like; where a page marks its article, the
slots inside it are chosen. Words inside a mark are never of the template, since a passage that
several articles share is text all the same. Equal pages count once.

The pages of a host are dealt by hash into groups of about equal, bounded size, whatever the
partitions of the table, so a host with a third of all pages is spread over many tasks and none
holds more than one group.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.session import cut

GROUP_PAGES = 64
GROUP_CHARS = 1 << 23
LEAST_PAGES = 4  # fewer pages tell nothing about a template
# Mean pages of the groups of a host, however long they are; 4 or more in all but one in 10^7.
MEAN_PAGES = 24

_ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
# Comments; what holds no markup up to its end tag; what is no text of the page, if it has an end
# tag, controls and drawings only where no block begins before it; tags, also with a stray quote.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)"
    rf"|<(script|style)\b{_ATTRIBUTES}>.*?(?:</\1\s*>|$)"
    rf"|<(noscript|template|textarea|title|iframe)\b{_ATTRIBUTES}>.*?</\2\s*>"
    rf"|<(svg|select|button)\b{_ATTRIBUTES}(?<!/)>"
    r"(?:(?!</?(?:address|article|aside|body|div|footer|form|h[1-6]|header|html|li|main|nav|ol|p"
    r"|pre|section|table|ul)\b).)*?</\3\s*>"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>|<[!?][^>]*(?:>|$)"
    r"|</?[a-zA-Z][^>]*(?:>|$)", re.S | re.I)
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("nav footer aside form head menu dialog".split())
LEFT_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer menu modal nav navbar navigation newsletter "
    "notice notices popup promo promoted promotion related replies reply search share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar widget "
    "contentinfo complementary".split())
# A name may add these to a word of LEFT_OUT_NAMES; "has-sidebar" or "menu-open" say something else.
PARTS = frozenset("area block box item items link links list section".split())
MAIN = ("article", "main")


def _left_out_name(name: str) -> bool:
    """Whether a whole class, id or role names a menu, advert or the like."""
    words = _WORD.findall(name)
    return any(w in LEFT_OUT_NAMES for w in words) and all(
        w in LEFT_OUT_NAMES or w in PARTS for w in words)


class Page:
    """Segments of a page: (path, left out, main element or None, text), in page order.

    ``elements`` are the paths of its elements, each with the number of segments before it.
    """

    __slots__ = ("segments", "elements")

    def __init__(self, source: str):
        self.segments: list[tuple[str, bool, str | None, str]] = []
        self.elements: list[tuple[int, str]] = []
        stack: list[tuple[str, str, bool, str | None]] = [("", "", False, None)]
        parts: list[str] = []

        def flush() -> None:
            if parts:
                text = html.unescape("".join(parts)) if any("&" in x for x in parts) else (
                    "".join(parts))
                text = _SPACE.sub(" ", text).strip(" ")
                if text:
                    _, path, out, main = stack[-1]
                    self.segments.append((path, out, main, text))
                parts.clear()

        def close(upto: int) -> None:
            flush()
            del stack[upto:]

        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                parts.append(source[at:m.start()])
            at = m.end()
            name = m.group(5)
            if not name:
                if (m.group(2) or "").lower() in ("title", "iframe"):
                    flush()
                continue
            name = name.lower()
            if name not in BLOCKS:
                if name == "br":
                    parts.append(" ")
                continue
            if name == "hr":
                flush()
                continue
            if m.group(4):
                found = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
                if found:
                    close(found)
                else:
                    flush()
                continue
            flush()
            if stack[-1][0] == "p":  # a block ends an open paragraph
                del stack[-1]
            elif name == stack[-1][0] and name in ("li", "dt", "dd", "td", "th", "tr"):
                del stack[-1]
            _, path, out, main = stack[-1]
            given = ["".join(x).lower() for x in _NAMES.findall(m.group(6))] if m.group(6) else []
            names = [_WORD.findall(x) for x in given]
            label = name + "".join("." + "-".join(x) for x in names)
            marks = name in MAIN or any(x == ["main"] for x in names)
            # The page and its outermost main element are not left out for what they are called.
            kept = name in ("html", "body") or (marks and main is None)
            out = (out or name in LEFT_OUT or (name == "header" and main is None)
                   or (not kept and any(_left_out_name(x) for g in given for x in g.split())))
            if marks:
                main = "article" if name == "article" or main == "article" else "main"
            path = f"{path}/{label}"
            self.elements.append((len(self.segments), path))
            stack.append((name, path, out, main))
        if at < len(source):
            parts.append(source[at:])
        flush()

    def tokens(self) -> list[str]:
        """Elements, and the words of segments outside any marked article, in page order."""
        out, at = [], 0
        for before, element in [*self.elements, (len(self.segments), "")]:
            for path, _, main, text in self.segments[at:before]:
                if main is None:
                    out += [f"{path} {word}" for word in text.split(" ")]
            at = before
            if element:
                out.append(f"<{element}")
        return out


def equivalence_classes(pages: list[list[str]], support: int) -> dict[str, int]:
    """Class number of every token in a valid class of its pages' token sequences.

    Tokens with one occurrence vector are a class. It is valid if at least ``support`` pages hold
    it and, where each occurs once, its tokens keep one order in all of them. Number 0 is the
    class of the tokens that occur once in every page.
    """
    counts: dict[str, dict[int, int]] = defaultdict(lambda: defaultdict(int))
    first: list[dict[str, int]] = []
    for i, tokens in enumerate(pages):
        place: dict[str, int] = {}
        for at, token in enumerate(tokens):
            counts[token][i] += 1
            place.setdefault(token, at)
        first.append(place)
    classes: dict[tuple, list[str]] = defaultdict(list)
    for token, vector in counts.items():
        if len(vector) >= support:
            classes[tuple(sorted(vector.items()))].append(token)
    root = tuple((i, 1) for i in range(len(pages)))
    out: dict[str, int] = {}
    for vector, tokens in sorted(classes.items(), key=lambda x: (x[0] != root, x[0])):
        orders = {tuple(sorted(tokens, key=first[i].__getitem__)) for i, _ in vector}
        if len(orders) == 1:
            number = 0 if vector == root else 1 + len(out)
            out.update((t, number) for t in tokens)
    return out


class Place(NamedTuple):
    """Where a token stands in the template: its class, the class it is nested in, the slot there."""

    number: int
    parent: int | None
    slot: int | None


def nested_template(pages: list[list[str]], support: int) -> dict[str, Place]:
    """Place of every token of the template; the parent is None where nothing is around a class.

    Tokens are ``<path`` of an element or ``path word``. Slot i of a class comes after the first i
    of its tokens.
    """
    numbers = equivalence_classes(pages, support)
    members: dict[int, list[str]] = defaultdict(list)
    for token, number in numbers.items():
        members[number].append(token)
    first: list[dict[str, int]] = []
    held: dict[str, list[int]] = defaultdict(list)
    for i, tokens in enumerate(pages):
        place: dict[str, int] = {}
        for at, token in enumerate(tokens):
            if token in numbers and token not in place:
                place[token] = at
                held[token].append(i)
        first.append(place)
    bounds: dict[tuple[int, int], list[int]] = {}
    out: dict[str, Place] = {}
    for token, number in numbers.items():
        path = token[1:].rpartition("/")[0] if token[0] == "<" else token.split(" ", 1)[0]
        while path and numbers.get(f"<{path}", number) == number:
            path = path.rpartition("/")[0]
        parent = numbers[f"<{path}"] if path else 0 if number and 0 in members else None
        slots: set[int | None] = set()
        for i in held[token]:
            if parent is None:
                slots.add(None)
                continue
            if (i, parent) not in bounds:
                bounds[i, parent] = sorted(first[i][t] for t in members[parent] if t in first[i])
            slots.add(bisect_left(bounds[i, parent], first[i][token]))
        if len(slots) == 1:
            out[token] = Place(number, parent, slots.pop())
    return out


def main_texts(sources: list[str | None]) -> list[str]:
    """Main text of each page of a group from one host."""
    pages = {s: Page(s) for s in dict.fromkeys(x or "" for x in sources)}
    template: dict[str, Place] = {}
    if len(pages) >= LEAST_PAGES:
        template = nested_template(
            [p.tokens() for p in pages.values()], max(LEAST_PAGES, -(-len(pages) // 2)))
    texts: dict[str, str] = {}
    for source, page in pages.items():
        slots = [(main, text) for path, left_out, main, text in page.segments if not left_out
                 and (main or not all(f"{path} {w}" in template for w in text.split(" ")))]
        marks = {main for main, _ in slots if main}
        best = "article" if "article" in marks else "main" if marks else None
        texts[source] = "\n".join(text for main, text in slots if main == best)
    return [texts[s or ""] for s in sources]


def host_of(url: Column) -> Column:
    """Host part of a URL in lower case; empty for null."""
    return F.lower(F.regexp_extract(
        F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(
    pages: DataFrame, url: str = "url", source: str = "html", key: str = "page_id",
    group_pages: int = GROUP_PAGES, group_chars: int = GROUP_CHARS,
) -> DataFrame:
    """``pages`` without ``source`` and with ``text`` (empty if there is none).

    Null pages are empty ones; pages without a host form a group of their own; equal rows stay
    separate. Input columns ``text`` and ``__host`` are replaced.
    """
    rest = [c for c in pages.columns if c not in (source, "text", "__host")]
    rows = pages.select(
        *rest, host_of(F.col(url)).alias("__host"), F.col(source).alias("__source"))
    # At most one row per group_pages pages or group_chars bytes; written, so its size is known.
    wide = cut(rows.groupBy("__host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("__source")).alias("chars")
    ).select("__host", F.greatest(F.lit(1), F.least(
        F.greatest(F.ceil(F.col("n") / group_pages), F.ceil(F.col("chars") / group_chars)),
        F.floor(F.col("n") / MEAN_PAGES))).alias("__groups")).filter("__groups > 1"))
    keys = ["__host", "__group"]
    placed = rows.join(wide, "__host", "left").withColumn("__group", F.pmod(
        F.xxhash64(key, url, "__source"), F.coalesce("__groups", F.lit(1)))
    ).drop("__groups").repartition(*keys).sortWithinPartitions(*keys)
    most = 8 * max(group_pages, MEAN_PAGES)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*rest).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group, n = None, 0

        def result() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            texts = main_texts(table.column("__source").to_pylist())
            yield from pa.table(
                [table.column(c) for c in rest] + [pa.array(texts, pa.string())],
                names=[*rest, "text"]).to_batches()

        for batch in batches:
            groups = list(zip(batch.column("__host").to_pylist(),
                              batch.column("__group").to_pylist()))
            start = 0
            for i, now in enumerate(groups):
                # Only rows equal in all of key, url and html can be that many.
                if n and (now != group or n >= most):
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield from result()
                    held, start, n = [], i, 0
                group, n = now, n + 1
            if start < len(groups):
                held.append(batch.slice(start))
        if held:
            yield from result()

    return placed.mapInArrow(run, f"{schema}, text string")
