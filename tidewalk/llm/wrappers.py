"""Main text of web pages by wrapper inference: union-free regular expressions of a host's pages.

A page is a stream of tags and texts. Adjacent copies of a group of tokens fold into one repeated group. Two streams of
a host are aligned: what only one of them has becomes optional, a group that repeats in one is a repeated group in
both, and texts meet in slots, which keep their text as long as it is the same on all pages. Aligning all streams of a
host gives its wrapper. A slot's zone (article, page furniture, other) is what most pages say of it; a page's main text
is its texts in article slots, or, if it has none, those in other slots that are not constants of the host. A constant
is the same on all pages that have the slot, and these are at least `LEAST_PAGES` pages with different texts.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import lower_ascii, materialise, slices

SHORT_GROUP = 12  # tokens; copies of longer groups are sought where their first tokens, that many, come again
TABLE_CELLS = 1 << 16  # of an alignment that is done in one table; larger ones are divided
LEAST_PAGES = 3  # a text is a constant of the host only if so many different pages have it
WRAPPERS_BROADCAST = 32 << 20  # bytes of all wrappers sent to every task; more are joined by a shuffle

MAIN, FURNITURE, OTHER = 0, 1, 2

# Fixed values of HTML, and words that name page furniture in class, id and role.
RAW, CLOSED_RAW = "script|style|textarea|title", "noscript|template|iframe"  # the latter are plain tags if left open
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img object math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mspace msub "
    "msup msubsup munder mover munderover semantics".split()
)
MAIN_TAGS = {"article", "main"}
FURNITURE_TAGS = set("nav footer menu head form button fieldset dialog select".split())
IN_SELECT = {"option", "optgroup", "hr"}  # other tags end a list of options
STICKY_TAGS = {"aside"}
FURNITURE_WORDS = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer contentinfo banner "
    "cookie cookies consent gdpr notice notices alert toolbar search login signup newsletter subscribe share social "
    "pagination pager popup modal".split()
)
STICKY_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar complementary related "
    "recommended comment comments disqus respond replies".split()
)
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<closed>{CLOSED_RAW})\b[^>]*>.*?</(?P=closed)\s*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
NAMING = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
SPACE = re.compile(r"\s+")


class Page:
    """The tokens of a page: labels, zones of the texts, and the texts with the number of the block they are in."""

    def __init__(self, source: str):
        self.labels: list[str] = []
        self.zones: list[int] = []
        self.texts: dict[int, tuple[int, str]] = {}
        self._open: list[tuple[str, int | None, bool]] = []  # tag, zone that it opens, sticky
        self._block, at = 0, 0
        for m in TOKEN.finditer(source):
            self._text(source[at:m.start()])
            at = m.end()
            if swallowed := m["raw"] or m["closed"]:
                self._add(f"<{swallowed.lower()}>")
            elif tag := (m[4] or m[7] or "").lower():
                self._tag(tag, bool(m[3] or m[6]), m[5] or m[8] or "")
        self._text(source[at:])

    def mark(self) -> int:
        """A number for the page's texts in order: equal pages, and such that differ in markup only, have the same."""
        raws = "\0".join(raw for _, raw in self.texts.values())
        return int.from_bytes(hashlib.blake2b(raws.encode("utf-8", "replace"), digest_size=8).digest())

    def _zone(self) -> int:
        zone = OTHER
        for _, opened, sticky in self._open:
            zone = opened if opened is not None else zone
            if sticky:
                return FURNITURE
        return zone

    def _add(self, label: str) -> None:
        self.labels.append(label)
        self.zones.append(self._zone())

    def _text(self, raw: str) -> None:
        if raw and not raw.isspace():
            self.texts[len(self.labels)] = (self._block, raw)
            self._add("#")
        elif raw and self.texts:  # white space between two inline tags is part of the block
            last = max(self.texts)
            if self.texts[last][0] == self._block:
                self.texts[last] = (self._block, self.texts[last][1] + " ")

    def _tag(self, tag: str, closing: bool, attributes: str) -> None:
        if tag not in INLINE and tag != "br":
            self._block += 1
        if tag == "br":
            self._text(" ")
        if closing:
            if any(tag == name for name, _, _ in self._open):
                while self._open.pop()[0] != tag:
                    pass
            self._add(f"</{tag}>")
            return
        if tag == "p" and self._open and self._open[-1][0] == "p":
            self._open.pop()
        if tag not in IN_SELECT and tag not in INLINE and any(name == "select" for name, _, _ in self._open):
            while self._open.pop()[0] != "select":
                pass
        said = [(m[1].lower(), re.split(r"[\s_-]+", (m[2] or m[3] or m[4] or "").lower())) for m in NAMING.finditer(attributes)]
        named = [w for _, words in said for w in words]
        # an id, and a number in a name, belong to the page and not to its form
        form = [re.sub(r"[0-9]+", "0", w) for kind, words in said if kind != "id" for w in words]
        if tag not in VOID and not attributes.endswith("/"):
            inside = self._zone() == MAIN
            sticky = tag in STICKY_TAGS or any(w in STICKY_WORDS for w in named) and tag not in ("html", "body")
            furniture = tag in FURNITURE_TAGS or tag == "header" and not inside or (
                not inside and tag not in ("html", "body", *MAIN_TAGS) and any(w in FURNITURE_WORDS for w in named))
            main = tag in MAIN_TAGS or "articlebody" in named
            self._open.append((tag, MAIN if main else FURNITURE if furniture or sticky else None, sticky))
        self._add(f"<{tag}>" if not form else f"<{tag} {' '.join(form)}>")


class Node:
    """A token or a repeated group: its label, and the page's or wrapper's numbers of its text slots, in order."""

    __slots__ = ("inner", "label", "slots")

    def __init__(self, label: str, slots: list, inner: tuple[str, ...] = ()):
        self.label, self.slots, self.inner = label, slots, inner


def repeated(nodes: list[Node]) -> Node:
    """The group of these nodes as a repeated group."""
    inner = tuple(n.label for n in nodes)
    label = inner[0] if len(nodes) == 1 and nodes[0].inner else f"({' '.join(inner)})+"
    return Node(label, [s for n in nodes for s in n.slots], nodes[0].inner if label == inner[0] else inner)


def fold(page: Page) -> tuple[list[Node], dict[int, int]]:
    """The page's nodes with adjacent copies folded, and for every text token the token it is folded into."""
    first = {i: i for i in page.texts}
    nodes = [Node(label, [i] if label == "#" else []) for i, label in enumerate(page.labels)]
    changed = True
    while changed:
        nodes, changed = _fold_once(nodes, first, lambda i, most: range(1, min(SHORT_GROUP, most) + 1))
        if not changed and len(nodes) > 2 * SHORT_GROUP:  # longer groups, once the short ones inside them are folded
            nodes, changed = _fold_once(nodes, first, _Stretches([n.label for n in nodes]).sizes)
    return nodes, {i: _top(first, i) for i in first}


def _top(first: dict[int, int], i: int) -> int:
    while first[i] != i:
        i = first[i]
    return i


_BASE, _MODULUS = 1_000_003, (1 << 61) - 1


class _Stretches:
    """Where stretches of `SHORT_GROUP` labels come again, and equality of longer ones, by rolling hashes."""

    def __init__(self, labels: list[str]):
        numbers: dict[str, int] = {}
        self.sums, self.powers = [0], [1]
        for label in labels:
            self.sums.append((self.sums[-1] * _BASE + numbers.setdefault(label, len(numbers) + 1)) % _MODULUS)
            self.powers.append(self.powers[-1] * _BASE % _MODULUS)
        self.next: list[int | None] = [None] * len(labels)
        seen: dict[int, int] = {}
        for i in range(len(labels) - SHORT_GROUP, -1, -1):
            key = self.of(i, SHORT_GROUP)
            self.next[i] = seen.get(key)
            seen[key] = i

    def of(self, start: int, size: int) -> int:
        return (self.sums[start + size] - self.sums[start] * self.powers[size]) % _MODULUS

    def sizes(self, i: int, most: int) -> Iterator[int]:
        """The lengths of the longer groups that come twice from this place on: their first labels come again."""
        at = self.next[i]
        while at is not None and (size := at - i) <= most:
            if size > SHORT_GROUP and self.of(i, size) == self.of(at, size):
                yield size
            at = self.next[at]


def _fold_once(
    nodes: list[Node], first: dict[int, int], sizes: Callable[[int, int], Iterable[int]]
) -> tuple[list[Node], bool]:
    """Fold the groups, of the lengths that `sizes` tells for a place, that have copies right behind them."""
    labels, out, i, changed = [n.label for n in nodes], [], 0, False
    while i < len(nodes):
        for size in sizes(i, (len(nodes) - i) // 2):
            if labels[i] == labels[i + size] and labels[i: i + size] == labels[i + size: i + 2 * size]:
                group, copies = nodes[i: i + size], 1
                while labels[i + copies * size: i + (copies + 1) * size] == labels[i: i + size]:
                    for a, b in zip(group, nodes[i + copies * size: i + (copies + 1) * size], strict=True):
                        first.update(zip(b.slots, a.slots, strict=True))
                    copies += 1
                out.append(repeated(group))
                i, changed = i + copies * size, True
                break
        else:
            out.append(nodes[i])
            i += 1
    return out, changed


def regroup(nodes: list[Node], groups: Iterable[tuple[str, tuple[str, ...]]], join) -> list[Node]:
    """Make single copies of groups that repeat elsewhere repeated groups too; `join` unites the slots of copies."""
    for label, inner in groups:
        out, i, size = [], 0, len(inner)
        while i < len(nodes):
            if tuple(n.label for n in nodes[i: i + size]) == inner:
                node = Node(label, [s for n in nodes[i: i + size] for s in n.slots], inner)
                i += size
            else:
                node, i = nodes[i], i + 1
            if out and node.inner and out[-1].label == node.label:
                join(out[-1], node)
            else:
                out.append(node)
        nodes = out
    return nodes


def _groups(nodes: list[Node]) -> set[tuple[str, tuple[str, ...]]]:
    return {(n.label, n.inner) for n in nodes if n.inner}


def align(a: list[str], b: list[str]) -> list[tuple[int | None, int | None]]:
    """Pairs of positions with equal labels in a longest common subsequence, and the others alone, in order.

    Small alignments take one table. A large one is divided where the two halves' common lengths add up to the most, so
    memory grows with the streams' length, and its tables are rows of bits.
    """
    out: list[tuple[int | None, int | None]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, n, j, m = todo.pop()
        while i < n and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        end = 0
        while n - end > i and m - end > j and a[n - 1 - end] == b[m - 1 - end]:
            end += 1
        if end:
            todo.append((n - end, n, m - end, m))
            n, m = n - end, m - end
        if (n - i) * (m - j) <= TABLE_CELLS or n - i < 2:
            out += _in_table(a, b, i, n, j, m)
            continue
        half = (i + n) // 2
        before = _common(a[i:half], b[j:m])
        after = _common(a[half:n][::-1], b[j:m][::-1])[::-1]
        cut = j + int(np.argmax(before + after))
        todo += [(half, n, cut, m), (i, half, j, cut)]
    return out


def _common(a: list[str], b: list[str]) -> np.ndarray:
    """The length of a longest common subsequence of a and every prefix of b, the empty one first.

    Bit k of the row is 0 where the length grows at b's label k; a label of a changes the row by one addition.
    """
    places: dict[str, int] = {}
    for k, label in enumerate(b):
        places[label] = places.get(label, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for label in a:
        hit = places.get(label, 0)
        shared = row & hit
        row = (row + shared | row - shared) & full
    bits = np.unpackbits(np.frombuffer((~row & full).to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(bits[: len(b)], dtype=np.int64)])


def _in_table(a: list[str], b: list[str], start: int, n: int, other: int, m: int) -> list[tuple[int | None, int | None]]:
    """The alignment of a[start:n] and b[other:m]."""
    best = [[0] * (m - other + 1) for _ in range(n - start + 1)]
    for i in range(n - 1, start - 1, -1):
        row, below = best[i - start], best[i - start + 1]
        for j in range(m - 1, other - 1, -1):
            row[j - other] = below[j - other + 1] + 1 if a[i] == b[j] else max(below[j - other], row[j - other + 1])
    out: list[tuple[int | None, int | None]] = []
    i, j = start, other
    while i < n and j < m:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i - start + 1][j - other] >= best[i - start][j - other + 1]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out + [(k, None) for k in range(i, n)] + [(None, k) for k in range(j, m)]


class Wrapper:
    """A host's nodes, which of them are optional, how many pages they stand for, and their slots: the pages' votes
    for the three zones, the checksum of the text as long as that is constant, and the smallest `LEAST_PAGES` marks of
    the different pages that have it."""

    def __init__(self, nodes: list[Node], optional: list[bool], pages: int):
        self.nodes, self.optional, self.pages = nodes, optional, pages

    @classmethod
    def of(cls, page: Page) -> Wrapper:
        nodes, first = fold(page)
        slots, mark = {}, page.mark()
        for i, (_, raw) in page.texts.items():
            votes = slots.setdefault(first[i], [0, 0, 0, _checksum(raw), [mark]] if first[i] == i else [0, 0, 0, None, []])
            if first[i] != i:
                votes[3:] = None, []
            votes[page.zones[i]] = 1
        for n in nodes:
            n.slots = [slots[s] for s in n.slots]
        return cls(nodes, [False] * len(nodes), 1)

    def merge(self, other: Wrapper) -> Wrapper:
        groups = sorted(_groups(self.nodes) | _groups(other.nodes), key=lambda g: (len(g[0]), g))
        a, b = _regrouped(self, groups), _regrouped(other, groups)
        nodes, optional = [], []
        for i, j in align([n.label for n in a.nodes], [n.label for n in b.nodes]):
            if i is None or j is None:
                nodes.append(b.nodes[j] if i is None else a.nodes[i])
                optional.append(True)
            else:
                _unite(a.nodes[i], b.nodes[j])
                nodes.append(a.nodes[i])
                optional.append(a.optional[i] or b.optional[j])
        return Wrapper(nodes, optional, self.pages + other.pages)

    def signature(self) -> str:
        """The expression: equal signatures align node by node."""
        return " ".join(n.label + "?" * o for n, o in zip(self.nodes, self.optional, strict=True))

    def dumps(self) -> str:
        return json.dumps([self.pages, [[n.label, n.slots, list(n.inner), int(o)] for n, o in zip(
            self.nodes, self.optional, strict=True)]], separators=(",", ":"))

    @classmethod
    def loads(cls, text: str) -> Wrapper:
        pages, nodes = json.loads(text)
        return cls([Node(a, b, tuple(c)) for a, b, c, _ in nodes], [bool(o) for *_, o in nodes], pages)


def _checksum(raw: str) -> int:
    return zlib.crc32(raw.encode("utf-8", "replace"))


def _unite(a: Node, b: Node) -> None:
    for x, y in zip(a.slots, b.slots, strict=True):
        x[:3] = [p + q for p, q in zip(x[:3], y[:3], strict=True)]
        same = x[3] is not None and x[3] == y[3]
        x[3:] = (x[3], sorted({*x[4], *y[4]})[:LEAST_PAGES]) if same else (None, [])


def _regrouped(w: Wrapper, groups) -> Wrapper:
    marks = {id(n): o for n, o in zip(w.nodes, w.optional, strict=True)}
    nodes = regroup(w.nodes, groups, _unite)
    return Wrapper(nodes, [marks.get(id(n), False) for n in nodes], w.pages)


def main_text(page: Page, wrapper: Wrapper | None) -> str:
    """The page's main text by the wrapper of its host."""
    if not page.texts:
        return ""
    nodes, first = fold(page)
    alias: dict[int, int] = {}

    def join(a: Node, b: Node) -> None:
        alias.update(zip(b.slots, a.slots, strict=True))

    zones: dict[int, int] = {}
    constant: dict[int, int] = {}  # the checksum of the host's constant in a slot
    if wrapper is not None:
        groups = sorted(_groups(wrapper.nodes) | _groups(nodes), key=lambda g: (len(g[0]), g))
        nodes = regroup(nodes, groups, join)
        for i, j in align([n.label for n in nodes], [n.label for n in wrapper.nodes]):
            if i is not None and j is not None:
                for own, slot in zip(nodes[i].slots, wrapper.nodes[j].slots, strict=True):
                    zones[own] = max(range(3), key=lambda z: (slot[z], -z))
                    if slot[3] is not None and len(slot[4]) >= LEAST_PAGES:
                        constant[own] = slot[3]

    def slot_of(i: int) -> int:
        i = first[i]
        while i in alias:
            i = alias[i]
        return i

    found = {i: zones.get(slot_of(i), page.zones[i]) for i in page.texts}
    if MAIN in found.values():
        chosen = [i for i in page.texts if found[i] == MAIN]
    else:
        chosen = [
            i for i, (_, raw) in page.texts.items()
            if found[i] == OTHER and not (slot_of(i) in constant and constant[slot_of(i)] == _checksum(raw))
        ]
    blocks: dict[int, str] = {}
    for i in chosen:
        block, raw = page.texts[i]
        blocks[block] = blocks.get(block, "") + raw
    clean = (SPACE.sub(" ", entities.unescape(raw)).strip() for raw in blocks.values())
    return "\n".join(text for text in clean if text)


def host_of(url) -> F.Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def infer(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of every host of the pages (host, html).

    A task keeps one wrapper per host and merges each new page form into it; the tasks' wrappers of a host are merged
    one by one from a sorted stream. So a hot host costs a task one row per task before it, and memory holds wrappers,
    never a host's pages.
    """

    def by_task(batches):
        known: dict[str, Wrapper] = {}
        for batch in slices(batches):
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                new = Wrapper.of(Page(source))
                old = known.get(host)
                known[host] = new if old is None else _merged(old, new)
        for host, wrapper in known.items():
            yield pa.RecordBatch.from_pydict({"host": [host], "wrapper": [wrapper.dumps()]})

    def by_host(batches):
        host, wrapper = None, None
        for batch in slices(batches):
            for at, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                new = Wrapper.loads(text)
                if at == host:
                    wrapper = _merged(wrapper, new)
                    continue
                if wrapper is not None:
                    yield pa.RecordBatch.from_pydict({"host": [host], "wrapper": [wrapper.dumps()]})
                host, wrapper = at, new
        if wrapper is not None:
            yield pa.RecordBatch.from_pydict({"host": [host], "wrapper": [wrapper.dumps()]})

    schema = "host string, wrapper string"
    parts = pages.select("host", "html").mapInArrow(by_task, schema)
    return parts.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(by_host, schema)


def _merged(a: Wrapper, b: Wrapper) -> Wrapper:
    """A merge that skips the alignment of equal forms."""
    if len(a.nodes) == len(b.nodes) and a.signature() == b.signature():
        for x, y in zip(a.nodes, b.nodes, strict=True):
            _unite(x, y)
        a.pages += b.pages
        return a
    return a.merge(b)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page, by the wrappers of all pages.

    A null html counts as empty and has an empty text; pages without a host share one wrapper. Repeated rows stay,
    other columns are not read. An empty table gives none.
    """
    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).withColumn("host", host_of(F.col("url")))
    wrappers = materialise(infer(rows), "wrappers")
    size = wrappers.agg(F.sum(F.length("host") + F.length("wrapper"))).first()[0] or 0
    joined = rows.join(F.broadcast(wrappers) if size <= WRAPPERS_BROADCAST else wrappers, "host", "left")

    def read(batches):
        known: dict[str | None, Wrapper | None] = {None: None}
        for batch in slices(batches):
            texts = []
            for source, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                if wrapper not in known:
                    if len(known) > 1000:
                        known = {None: None}
                    known[wrapper] = Wrapper.loads(wrapper)
                texts.append(main_text(Page(source), known[wrapper]))
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    kind = pages.schema["page_id"].dataType.simpleString()
    found = joined.select("page_id", "url", "html", "wrapper")
    return found.mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")
