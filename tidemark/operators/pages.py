"""Raw pages -> rows (H1-H5).

``with_nodes`` reads each page's markup once and adds its elements and text pieces as an
array in document order; a node knows its place and the place of its last descendant, so
"inside" is a comparison and a subtree a slice.  The rules are Column expressions over
that array.  Reading keeps an explicit list of open elements, so depth is no limit: an
element left open ends with its parent, an end tag without a start is ignored.

Selectors: ``tag``, ``.class``, ``#id``, ``[attr]``, ``[attr=v]``, ``[attr^=v]``,
``[attr*=v]``, several of those together, and a space for "inside".
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..functions.market import chain_topic, segment_code
from ..functions.text import article_body, strip
from ..session import staged

#: Fixed values of HTML: elements without content, and elements whose text is not shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(("script", "style", "template"))

#: Nodes, or entries, that a task holds at once (about; a page's nodes more), and bytes of a page that are read at once.
SLICE, PIECE = 20_000, 1 << 18

_TEXT = "#text"
_NODES = "array<struct<at:int,end:int,tag:string,attrs:map<string,string>,text:string,shown:boolean>>"
_ARROW = pa.list_(pa.struct([("at", pa.int32()), ("end", pa.int32()), ("tag", pa.string()),
                             ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string()), ("shown", pa.bool_())]))


class _Reader(HTMLParser):
    """Events of one page as nodes; ``open`` holds the places of unclosed elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.open: list[int] = []
        self.names: Counter = Counter()
        self.hidden = 0

    def _close(self) -> str:
        node = self.nodes[self.open.pop()]
        node["end"] = len(self.nodes) - 1
        self.names[node["tag"]] -= 1
        self.hidden -= node["tag"] in HIDDEN
        return node["tag"]

    def _add(self, tag: str, attrs: dict, text: str | None) -> None:
        at = len(self.nodes)
        self.nodes.append({"at": at, "end": at, "tag": tag, "attrs": list(attrs.items()), "text": text, "shown": not self.hidden})

    def handle_starttag(self, tag, attrs):
        self._add(tag, {k: v or "" for k, v in attrs}, None)
        if tag not in VOID:
            self.open.append(len(self.nodes) - 1)
            self.names[tag] += 1
            self.hidden += tag in HIDDEN

    def handle_startendtag(self, tag, attrs):
        self._add(tag, {k: v or "" for k, v in attrs}, None)

    def handle_endtag(self, tag):
        if self.names[tag]:
            while self._close() != tag:
                pass

    def handle_data(self, data):
        self._add(_TEXT, {}, data)


def read_nodes(html: str | None) -> list[dict]:
    """The nodes of one page in document order; null has none."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    while reader.open:
        reader._close()
    return reader.nodes


def with_nodes(df: DataFrame, html: str, *keep: str) -> DataFrame:
    """``keep`` columns and ``nodes`` of each page of ``df``."""
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, pages in _slices(b.column(len(keep)), read_nodes, len):
                yield pa.RecordBatch.from_arrays([*b.slice(a, len(pages)).columns[:len(keep)], pa.array(pages, _ARROW)], [*keep, "nodes"])

    return df.select(*keep, html).mapInArrow(run, f"{fields}, nodes {_NODES}")


def _slices(html: pa.Array, read: Callable, size: Callable) -> Iterator[tuple[int, list]]:
    """(place, results) of runs of pages that together have about ``SLICE`` nodes, so a task never holds those of a batch."""
    at, held, n = 0, [], 0
    for i in range(len(html)):
        held.append(read(html[i].as_py()))
        n += size(held[-1])
        if n >= SLICE or i == len(html) - 1:
            yield at, held
            at, held, n = i + 1, [], 0


# Rules over nodes

_PART = re.compile(r"(?P<tag>[a-zA-Z][\w-]*)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>[\^*]?=)\"?(?P<val>[^\]\"]*)\"?)?\]")


def _part(m: re.Match, n: Column) -> Column:
    if m["tag"]:
        return n["tag"] == m["tag"].lower()
    if m["cls"]:
        return F.array_contains(F.split(F.coalesce(F.try_element_at(n["attrs"], F.lit("class")), F.lit("")), r"\s+"), m["cls"])
    value = F.try_element_at(n["attrs"], F.lit(m["attr"] or "id"))
    if m["id"] or m["op"] == "=":
        return F.coalesce(value == (m["id"] or m["val"]), F.lit(False))
    if not m["op"]:
        return value.isNotNull()
    return F.coalesce(value.startswith(m["val"]) if m["op"] == "^=" else value.contains(m["val"]), F.lit(False))


def _is(compound: str) -> Callable[[Column], Column]:
    parts = list(_PART.finditer(compound))
    if "".join(m.group() for m in parts) != compound:
        raise ValueError(f"unsupported selector {compound!r}")

    def test(n: Column) -> Column:
        out = F.lit(True)
        for m in parts:
            out = out & _part(m, n)
        return out
    return test


def inside(n: Column, outer: Column) -> Column:
    return (n["at"] > outer["at"]) & (n["at"] <= outer["end"])


def found(nodes: Column, selector: str) -> Column:
    """Elements that a selector names, in document order."""
    *outer, last = selector.split()
    if not outer:
        return F.filter(nodes, _is(last))
    return let(found(nodes, " ".join(outer)), lambda xs: F.filter(
        nodes, lambda n: _is(last)(n) & F.exists(xs, lambda x: inside(n, x))))


def _first(xs: Column) -> Column:
    return F.get(xs, F.lit(0))


def _texts(nodes: Column, of: Column) -> Column:
    """Shown text pieces inside an element, in order: its subtree is a slice of the page."""
    return F.filter(F.slice(nodes, of["at"] + 2, of["end"] - of["at"]), lambda n: (n["tag"] == _TEXT) & n["shown"])


def _label(nodes: Column, of: Column) -> Column:
    """An element's text, each piece trimmed, without gaps; empty for no element."""
    return F.coalesce(F.array_join(F.transform(_texts(nodes, of), lambda t: strip(t["text"])), ""), F.lit(""))


def main_text(nodes: Column, container: str, drop: Sequence[str]) -> Column:
    """H1: the container's text pieces outside dropped blocks, one a line, up to the
    signature line, at most one blank line in a row, trimmed; empty without a container."""
    def body(main: Column) -> Column:
        cut = F.flatten(F.array(*[found(nodes, s) for s in drop])) if drop else F.array().cast(_NODES)
        pieces = let(cut, lambda ds: F.filter(_texts(nodes, main), lambda t: ~F.exists(ds, lambda d: inside(d, main) & inside(t, d))))
        return article_body(F.array_join(F.transform(pieces, lambda t: t["text"]), "\n"))

    return F.coalesce(let(_first(found(nodes, container)), body), F.lit(""))


def extract_main(df: DataFrame, html: str = "html", key: str = "page_id",
                 container: str = "div#main-content",
                 drop: Sequence[str] = ("div.article-metaline", "div.article-metaline-right", "div.push"),
                 out: str = "text") -> DataFrame:
    """H1 over a pages table: (key, out)."""
    return with_nodes(df, html, key).select(key, main_text(F.col("nodes"), container, list(drop)).alias(out))


def _compiled(selector: str) -> list[list[dict]]:
    """The selector's compounds, outermost first, for the reader."""
    parts = [list(_PART.finditer(c)) for c in selector.split()]
    if ["".join(m.group() for m in p) for p in parts] != selector.split() or not parts:
        raise ValueError(f"unsupported selector {selector!r}")
    return [[m.groupdict() for m in p] for p in parts]


def _fits(parts: list[dict], tag: str, attrs: dict) -> bool:
    """``_is`` for the reader."""
    for m in parts:
        value = attrs.get(m["attr"] or "id")
        if m["tag"]:
            ok = tag == m["tag"].lower()
        elif m["cls"]:
            ok = m["cls"] in re.split(r"[ \t\n\x0b\f\r]+", attrs.get("class", ""))
        elif m["id"] or m["op"] == "=":
            ok = value == (m["id"] or m["val"])
        else:
            ok = value is not None and (not m["op"] or (value.startswith(m["val"]) if m["op"] == "^=" else m["val"] in value))
        if not ok:
            return False
    return True


class _Picker(_Reader):
    """Of one page only the elements that ``wanted`` selectors name, each with its shown text pieces; no other node is kept.

    ``picked``: (selector number, attrs, pieces, ids of the picked elements around it, own id) in document order.
    """

    def __init__(self, wanted: list[list[list[dict]]]):
        super().__init__()
        self.wanted, self.picked = wanted, []
        self.around: list[tuple] = []  # (tag, attrs, picked elements) of each open element

    def _close(self) -> str:
        tag = self.around.pop()[0]
        self.names[tag] -= 1
        self.hidden -= tag in HIDDEN
        return tag

    def _add(self, tag, attrs, text):
        if tag == _TEXT:
            if not self.hidden:
                for _, _, own in self.around:
                    for p in own:
                        p[2].append(text)
            return
        own = []
        for number, parts in enumerate(self.wanted):
            if _fits(parts[-1], tag, attrs) and self._within(parts[:-1]):
                own.append((number, attrs, [], [p[4] for _, _, o in self.around for p in o], len(self.picked)))
                self.picked.append(own[-1])
        self.last = (tag, attrs, own)

    def _within(self, outer: list[list[dict]]) -> bool:
        at = len(self.around)
        for parts in reversed(outer):
            at -= 1
            while at >= 0 and not _fits(parts, *self.around[at][:2]):
                at -= 1
            if at < 0:
                return False
        return True

    def handle_starttag(self, tag, attrs):
        self._add(tag, {k: v or "" for k, v in attrs}, None)
        if tag not in VOID:
            self.around.append(self.last)
            self.names[tag] += 1
            self.hidden += tag in HIDDEN


def read_picked(html: str | None, wanted: list) -> list[tuple]:
    """The elements of one page that the compiled selectors name."""
    reader = _Picker(wanted)
    reader.feed(html or "")
    reader.close()
    return reader.picked


def _entries(picked: list[tuple]) -> list[tuple]:
    """(title pieces, href, date pieces) of each row (selector 0) whose first link (1) has an address; date is selector 2."""
    first: dict[int, dict[int, tuple]] = {p[4]: {} for p in picked if p[0] == 0}
    for p in picked:
        if p[0]:
            for row in p[3]:
                if row in first:
                    first[row].setdefault(p[0], p)
    return [(f[1][2], f[1][1]["href"], f[2][2] if 2 in f else []) for f in first.values() if 1 in f and "href" in f[1][1]]


class _Listing(_Picker):
    """Of one page the entries (selectors as in ``_entries``), each as soon as its row and those before it are closed.

    ``rows``: [open, (attrs, pieces) of the first link, the same of the first date] of the rows not taken, in document order.
    """

    def __init__(self, wanted: list[list[list[dict]]]):
        super().__init__(wanted)
        self.rows: deque[list] = deque()

    def _add(self, tag, attrs, text):
        if tag == _TEXT:
            if not self.hidden:
                for _, _, (held, _) in self.around:
                    for pieces in held:
                        pieces.append(text)
            return
        held, rows = [], []
        for number, parts in enumerate(self.wanted):
            if not (_fits(parts[-1], tag, attrs) and self._within(parts[:-1])):
                continue
            if not number:
                rows.append([True, None, None])
                continue
            pieces: list[str] = []
            lacking = [row for _, _, (_, own) in self.around for row in own if row[number] is None]
            for row in lacking:
                row[number] = (attrs, pieces)
            if lacking:
                held.append(pieces)
        self.rows.extend(rows)
        self.last = (tag, attrs, (held, rows))

    def _close(self):
        self._shut(self.around[-1])
        return super()._close()

    def _shut(self, element: tuple) -> None:
        for row in element[2][1]:
            row[0] = False

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        if tag in VOID:
            self._shut(self.last)

    def handle_startendtag(self, tag, attrs):
        super().handle_startendtag(tag, attrs)
        self._shut(self.last)

    def taken(self, end: bool = False) -> Iterator[tuple]:
        while self.rows and (end or not self.rows[0][0]):
            _, link, date = self.rows.popleft()
            if link and "href" in link[0]:
                yield link[1], link[0]["href"], date[1] if date else []


def read_entries(html: pa.StringScalar, wanted: list) -> Iterator[tuple]:
    """(title pieces, href, date pieces) of a page's entries, while it is read; no more than a piece of it and its open rows are held."""
    reader, data, a, size = _Listing(wanted), html.as_buffer() if html.is_valid else pa.py_buffer(b""), 0, PIECE
    while a < data.size:
        part = data.slice(a, min(size, data.size - a)).to_pybytes()
        z = len(part) if a + len(part) == data.size else part.rfind(b"<")  # before a tag, so no text is cut
        if z <= 0:
            size *= 2
            continue
        reader.feed(part[:z].decode())
        a, size = a + z, PIECE
        yield from reader.taken()
    reader.close()
    yield from reader.taken(True)


def _joined(pieces: str) -> Column:
    return F.array_join(F.transform(pieces, lambda t: strip(t)), "")


def extract_links(df: DataFrame, html: str = "html", key: str = "page_id", row: str = "div.r-ent",
                  link: str = "div.title a", date: str | None = "div.date",
                  base: str | None = None, base_col: str | None = None) -> DataFrame:
    """H2: one row per listing entry with a link: (key, pos, title, url, date).

    The reader keeps the text pieces of links and dates only and hands an entry on when its row is closed, so a
    page of many entries costs as much as many pages of few and a task never holds those of a page.
    """
    wanted = [_compiled(x) for x in (row, link, date) if x]
    kind = df.schema[key].dataType.simpleString()
    names = ["key", "base", "pos", "title", "href", "date"]
    pieces = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, html in enumerate(b.column(2)):
                for pos, e in enumerate(read_entries(html, wanted)):
                    rows.append((i, pos, *e))
                    if len(rows) == SLICE:
                        yield made(b, rows)
                        rows = []
            if rows:
                yield made(b, rows)

    def made(b: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        at, pos, title, href, day = (list(x) for x in zip(*rows, strict=True))
        page = b.select([0, 1]).take(pa.array(at, pa.int32()))  # never the page itself
        return pa.RecordBatch.from_arrays([page.column(0), page.column(1), pa.array(pos, pa.int32()), pa.array(title, pieces),
                                           pa.array(href, pa.string()), pa.array(day, pieces)], names)

    pages = df.select(F.col(key).alias("key"), F.coalesce(F.col(base_col) if base_col else F.lit(base), F.lit("")).alias("base"), html)
    rows = pages.mapInArrow(run, f"key {kind}, base string, pos int, title array<string>, href string, date array<string>")
    return rows.select(F.col("key").alias(key), "pos", _joined("title").alias("title"), F.concat("base", "href").alias("url"), _joined("date").alias("date"))


def extract_next(df: DataFrame, html: str = "html", key: str = "page_id", link: str = "a.btn.wide", label: str = "上頁",
                 base: str | None = None) -> DataFrame:
    """H2: (key, next_url): where the listing's button for older entries leads, null on the last page.

    The first link whose text holds ``label`` counts; a button without an address ends the listing.
    """
    wanted, kind = [_compiled(link)], df.schema[key].dataType.simpleString()
    buttons = pa.list_(pa.struct([("text", pa.list_(pa.string())), ("href", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, found in _slices(b.column(1), lambda h: [{"text": p[2], "href": p[1].get("href")} for p in read_picked(h, wanted)], lambda e: len(e) + 1):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, len(found)), pa.array(found, buttons)], ["key", "buttons"])

    made = df.select(F.col(key).alias("key"), html).mapInArrow(run, f"key {kind}, buttons array<struct<text:array<string>,href:string>>")
    named = F.filter("buttons", lambda x: F.contains(F.array_join(F.transform(x["text"], lambda t: strip(t)), ""), F.lit(label)))
    href = F.nullif(_first(named)["href"], F.lit(""))
    return made.select(F.col("key").alias(key), F.concat(F.lit(base or ""), href).alias("next_url"))


def listing_order(pages: DataFrame, starts: DataFrame, page: str = "page", following: str = "next_page", start: str = "start") -> DataFrame:
    """(start, page, rank): the pages that a reader of each listing sees, in order from 0.

    ``pages``: (page, following), each page once, null where a listing ends; ``starts``: (start,
    page).  Pointers are doubled: after round i a page knows the page 2^i further on, and the
    pages reached so far are twice as many, so a listing of L pages takes log2(L) rounds.  A
    listing that runs into itself ends before the page that it has shown already: of the ranks
    at which a page is reached the smallest counts, and the rounds end when none is new.
    """
    jump = staged(pages.where(F.col(following).isNotNull()).select(F.col(page).alias("from"), F.col(following).alias("to"))
                  .join(pages.select(F.col(page).alias("to")), "to", "left_semi").select("from", "to"), "listing-jumps")
    seen = staged(starts.select(F.col(start).alias("start"), F.col(page).alias("page"), F.lit(0).cast("long").alias("rank"))
                  .join(pages.select(F.col(page).alias("page")), "page", "left_semi").select("start", "page", "rank"), "listing-pages")
    n, step = seen.count(), 1
    while True:
        ahead = seen.join(jump, F.col("page") == F.col("from")).select("start", F.col("to").alias("page"), (F.col("rank") + step).alias("rank"))
        seen = staged(seen.unionByName(ahead).groupBy("start", "page").agg(F.min("rank").alias("rank")), "listing-pages")
        before, n, step = n, seen.count(), 2 * step
        if n == before:
            return seen.select(F.col("start").alias(start), F.col("page").alias(page), "rank")
        jump = staged(jump.join(jump.select(F.col("from").alias("to"), F.col("to").alias("on")), "to").select("from", F.col("on").alias("to")), "listing-jumps")


def extract_chain_rows(df: DataFrame, html: str = "html", ic: str = "chain_ic") -> DataFrame:
    """H4/H5 over chain pages (ic, html): one row per stock link of each shown segment.

    The bucket is the bold text of the first cell of the innermost table row around a link.
    """
    nodes = F.col("nodes")
    pages = with_nodes(df, html, ic).select(ic, "nodes", _label(nodes, _first(found(nodes, "h3"))).alias("title"), let(
        found(nodes, "noscript"), lambda off: F.filter(found(nodes, "div[id^=companyList_]"), lambda d: ~F.exists(off, lambda x: inside(d, x)))).alias("segments"),
        found(nodes, "a[href*=company_basic.php?stk_code=]").alias("links"), found(nodes, "tr").alias("trs"))
    segment = pages.select("*", F.explode_outer("segments").alias("s")).where("s IS NOT NULL")
    links = segment.select("*", F.explode_outer(F.filter("links", lambda a: inside(a, F.col("s")))).alias("a")).where("a IS NOT NULL")
    at = lambda n, k: F.coalesce(F.try_element_at(F.col(n)["attrs"], F.lit(k)), F.lit(""))
    code = F.regexp_extract(at("a", "href"), r"stk_code=(\d+)", 1)
    tr = F.try_element_at(F.filter("trs", lambda t: inside(F.col("a"), t)), F.lit(-1))
    first_in = lambda selector, x: _first(F.filter(found(nodes, selector), lambda n: inside(n, x)))
    bold = let(tr, lambda t: let(first_in("td", t), lambda td: first_in("b", td)))
    name = F.coalesce(F.nullif(at("a", "title"), F.lit("")), _label(nodes, F.col("a")))
    return links.where(code != "").select(
        ic, segment_code(at("s", "id")).alias("segment_code"), strip(at("s", "title")).alias("segment_name"),
        let(bold, lambda b: _label(nodes, b)).alias("listing_bucket"), code.alias("stock_code"), strip(name).alias("stock_name"),
        chain_topic("title").alias("chain_topic"))


_CHAIN_ID = r"introduce\.php\?ic=([A-Z0-9]+)"


def extract_chain_index(df: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """H3 over index pages: (key, pos, chain_ic, major_industry), one row per mention of a chain.

    Mentions in links come before those in ``onclick`` texts; the category is the caption
    of the innermost item around the mention, empty without one.
    """
    nodes = F.col("nodes")

    def mention(n: Column, attr: str) -> Column:
        return F.struct(n.alias("n"), F.regexp_extract(F.coalesce(F.try_element_at(n["attrs"], F.lit(attr)), F.lit("")), _CHAIN_ID, 1).alias("ic"))

    mentions = F.concat(F.transform(found(nodes, "a[href*=introduce.php?ic=]"), lambda n: mention(n, "href")),
                        F.transform(found(nodes, "span.itemLink"), lambda n: mention(n, "onclick")))
    # Captions by place, so that a mention needs its item only.
    pages = with_nodes(df, html, key).select(
        key, "nodes", found(nodes, "div.item").alias("items"), found(nodes, "a.link").alias("links"), found(nodes, "span.txt").alias("captions"),
        F.posexplode_outer(F.filter(mentions, lambda m: m["ic"] != "")).alias("pos", "m")).where("m IS NOT NULL")
    item = F.try_element_at(F.filter("items", lambda i: inside(F.col("m.n"), i)), F.lit(-1))
    caption = let(item, lambda i: let(_first(F.filter("links", lambda a: inside(a, i))),
                                      lambda a: _first(F.filter("captions", lambda c: inside(c, a)))))
    return pages.select(key, "pos", F.col("m.ic").alias("chain_ic"), let(caption, lambda c: _label(nodes, c)).alias("major_industry"))


def extract_matches(df: DataFrame, col: str, pattern: str, group: int = 1,
                    keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """H3: every regex match in ``col`` with its position (SQL only, no Python).

    ``posexplode_outer`` + a null filter keeps Catalyst from inferring a
    ``size(matches) > 0`` filter below the exchange, which would run the regex twice.
    """
    m = F.regexp_extract_all(F.col(col), F.lit(pattern), F.lit(group))
    out = df.select(*keep, F.posexplode_outer(m).alias("pos", "match"))
    return out.where(F.col("match").isNotNull())
