"""Records from stored HTML pages.

One Arrow reader lists the sought elements of a page. All rules about which element means what are column
expressions below.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.functions.amounts import awarded_amount, bidder_count, parse_amount
from tenderloom.functions.keys import content_hash
from tenderloom.functions.links import resolve, url_id
from tenderloom.functions.text import best_text, collapse, drop_label, find_date, first_group, first_text, strip

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"p", "div", "li", "ul", "ol", "tr", "table", "section", "article", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd"}
_PA_NODE = pa.struct([(n, pa.string()) for n in ("tag", "id", "css", "href", "within", "content", "inner")])
_PA_CELL = pa.struct([("content", pa.string()), ("inner", pa.string()), ("nodes", pa.list_(_PA_NODE))])
_PA_CELLS = pa.schema([("page_id", pa.int64()), ("page_hash", pa.string()), ("row_no", pa.int32()), ("cells", pa.list_(_PA_CELL))])
_PA_NODES = pa.schema([("page_id", pa.int64()), ("page_hash", pa.string()), ("nodes", pa.list_(_PA_NODE))])
_DDL_NODE = "struct<tag:string,id:string,css:string,href:string,within:string,content:string,inner:string>"
_DDL_CELLS = f"page_id long, page_hash string, row_no int, cells array<struct<content:string,inner:string,nodes:array<{_DDL_NODE}>>>"
_DDL_NODES = f"page_id long, page_hash string, nodes array<{_DDL_NODE}>"


_OPENING = re.compile(r"<(?:(!--)|(!)|(script|style)\b|(/?)[a-z])", re.I)
_SCRIPTS = ("script", "style")
_CLOSING = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style")}
_NAME_END, _SIGN = re.compile(r"[\s/>]"), re.compile("[=>]")
# A quote delimits a value only behind an equals sign; elsewhere it is a sign like any other.
_QUOTE = re.compile(r"""=\s*(["'])""")
# A whole tag by the same rules, where its quotes are closed; what this doesn't match may be a tag all the same.
_TAG = re.compile(r"""</?([a-z][^\s/>]*+)([^=>]*+(?:=(?:\s*"[^"]*"|\s*'[^']*'|(?!\s*["']))[^=>]*+)*+)>""", re.I)
_TAG_CHARS = 4096        # tags up to this length are tried so
_ATTRIBUTE = re.compile(r"""\b(id|class|href)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)


Marks = tuple[list[str], list[str]]   # id fragments, class names between spaces
_CSS = [f" {c} " for c in (S.CLASS_REFERENCE, S.CLASS_BUBBLE, S.CLASS_DEADLINE)]
ROW_MARKS: Marks = ([S.ID_OBJECT, S.ID_BUYER, S.ID_PLACE], _CSS)
DETAIL_MARKS: Marks = ([S.ID_ESTIMATE, S.ID_CONTACT_BLOCK, S.ID_CONTACT_NAME, S.ID_OBJECT, S.ID_BUYER, S.ID_PLACE,
                        *S.DETAIL_FIELDS.values(), *S.CONTACT_FIELDS.values(), *S.AWARD_IDS], _CSS)


@cache
def _any_of(fragments: tuple[str, ...]):
    """Whether a text holds one of the fragments, in one search."""
    return re.compile("|".join(map(re.escape, fragments)) or r"(?!)").search


class _Scanner:
    """Tags of a page in document order, in time linear in its length also where comments, scripts, quotes or tags are never closed.

    What isn't found once isn't sought again: the end of a comment, of a script or style, a closing quote. A tag without an end leaves its equals
    signs marked as dead; whichever later tag comes by one has no end either. After a few of those the signs that matter are looked up in lists.
    """

    def __init__(self, source: str) -> None:
        self.source = source
        self.last = source.rfind(">")
        self.missing: set[str] = set()      # of "-->", "script", "style", quotes: no more of them from here on
        self.dead: set[int] = set()
        self.failed = 0
        self.lists: dict[re.Pattern, list[int]] = {}

    def tags(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """(start, end, whether it closes, name, attributes); the name is empty for comments, declarations, scripts and styles."""
        source, at, untried = self.source, 0, 4
        while True:
            if untried and _TAG_CHARS:
                # text up to the next sign, then an ordinary tag right there
                start = source.find("<", at)
                if 0 <= start < self.last and (tag := _TAG.match(source, start, start + _TAG_CHARS)) and (
                        name := tag[1].lower()) not in _CLOSING and not name.startswith(_SCRIPTS):
                    at = tag.end()
                    yield start, at, source[start + 1] == "/", name, tag[2]
                    continue
            m = _OPENING.search(source, at)
            if not m or m.start() >= self.last:
                return
            start = m.start()
            if untried and m[4] is not None:
                if tag := _TAG.match(source, start, start + _TAG_CHARS):
                    at = tag.end()
                    yield start, at, m[4] == "/", tag[1].lower(), tag[2]
                    continue
                untried -= 1     # a few failures are enough: each may have run through all of the characters
            if m[1] or m[2]:
                end = self._find("-->", start + 4) if m[1] else -1
                end = end + 3 if end >= 0 else source.find(">", start) + 1
                yield start, end, False, "", ""
            elif m[3] and (end := self._closed(m[3].lower(), m.end())) >= 0:
                yield start, end, False, "", ""
            else:
                first = start + 1 + bool(m[4])
                name = self._next(_NAME_END, first)
                end = self._end(name)
                if end < 0:
                    at = start + 1
                    continue
                end += 1
                yield start, end, bool(m[4]), source[first:name].lower(), source[name:end - 1]
            at = end

    def _find(self, sought: str, at: int) -> int:
        found = -1 if sought in self.missing else self.source.find(sought, at)
        if found < 0:
            self.missing.add(sought)
        return found

    def _closed(self, tag: str, at: int) -> int:
        m = None if tag in self.missing else _CLOSING[tag].search(self.source, at)
        if m is None:
            self.missing.add(tag)
        return m.end() if m else -1

    def _next(self, sign: re.Pattern, at: int) -> int:
        if self.failed < 4:
            m = sign.search(self.source, at)
            return m.start() if m else -1
        if sign not in self.lists:
            self.lists[sign] = [m.start() for m in sign.finditer(self.source)]
        i = bisect_left(self.lists[sign], at)
        return self.lists[sign][i] if i < len(self.lists[sign]) else -1

    def _end(self, at: int) -> int:
        """Where the tag ends whose attributes begin at ``at``: the first > outside of quoted values; -1 if there is none."""
        passed = []
        while True:
            at = self._next(_SIGN, at)
            if at < 0 or at in self.dead:
                self.dead.update(passed)
                self.failed += 1
                return -1
            if self.source[at] == ">":
                return at
            passed.append(at)
            quote = _QUOTE.match(self.source, at)
            closed = self._find(quote[1], quote.end()) if quote else -1
            at = max(closed, at) + 1


class _Page:
    """Marked elements of a page in document order: cells, links, and elements with a sought id or class.

    Texts are kept once, in two parallel lists (as they stand, and with line ends at blocks); an element
    knows where its text and its inner elements begin and end.
    """

    def __init__(self, source: str, marks: Marks) -> None:
        self.ids, self.css = (_any_of(tuple(m)) for m in marks)
        self.raw: list[str] = []
        self.inner: list[str] = []
        self.found: list[dict] = []
        self.open: list[dict] = []
        self.open_tags: defaultdict[str, int] = defaultdict(int)
        at = 0
        for start, end, closes, tag, attributes in _Scanner(source).tags():
            if start > at:
                piece = source[at:start]
                if "&" in piece:
                    piece = unescape(piece)
                if piece:
                    self.raw.append(piece)
                    self.inner.append(piece)
            at = end
            if closes:
                self._end(tag)
            elif tag:
                self._start(tag, attributes)
        self._text(source[at:])
        self._close_from(0)

    def _text(self, piece: str) -> None:
        if piece:
            piece = unescape(piece) if "&" in piece else piece
            self.raw.append(piece)
            self.inner.append(piece)

    def _line_end(self) -> None:
        self.raw.append("")
        self.inner.append("\n")

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("td", "th", "tr"):
            self._close_row_part(tag)
        if tag in _BLOCK:
            self.raw.append("")
            self.inner.append("\n")
        node = {"tag": tag, "id": "", "css": "", "href": None}
        if attributes:
            seen: dict[str, str] = {}
            for name, double, single, bare in _ATTRIBUTE.findall(attributes):
                value = double or single or bare
                seen.setdefault(name.lower(), unescape(value) if "&" in value else value)
            node["id"], node["href"] = seen.get("id", ""), seen.get("href")
            node["css"] = f" {' '.join(seen['class'].split())} " if seen.get("class", "").strip() else ""
        if tag in ("a", "td", "tr") or (node["id"] and self.ids(node["id"])) or (node["css"] and self.css(node["css"])):
            node["within"] = " " + " ".join(u["id"] for u in self.open if u["id"]) + " "
            node["tables"] = [u for u in self.open if u["tag"] in ("table", "thead", "tfoot")] if tag == "tr" else ()
            node["first"], node["text_from"] = len(self.found), len(self.raw)
            self.found.append(node)
        if tag in _VOID:
            node["last"], node["text_to"] = len(self.found), len(self.raw)
            if tag == "br":
                self._line_end()
        else:
            self.open.append(node)
            self.open_tags[tag] += 1

    def _end(self, tag: str) -> None:
        if self.open and self.open[-1]["tag"] == tag:     # as a rule the innermost one ends
            node = self.open.pop()
            node["last"], node["text_to"] = len(self.found), len(self.raw)
            self.open_tags[tag] -= 1
        elif self.open_tags[tag]:
            i = len(self.open) - 1
            while self.open[i]["tag"] != tag:
                i -= 1
            self._close_from(i)
        if tag in _BLOCK:
            self._line_end()

    def _close_from(self, i: int) -> None:
        for node in self.open[i:]:
            node["last"], node["text_to"] = len(self.found), len(self.raw)
            self.open_tags[node["tag"]] -= 1
        del self.open[i:]

    def _close_row_part(self, tag: str) -> None:
        """A new cell ends an open cell, a new row an open row, within the same table."""
        ends = ("td", "th") if tag != "tr" else ("tr",)
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i]["tag"] == "table":
                return
            if self.open[i]["tag"] in ends:
                self._close_from(i)
                return

    def texts(self, n: dict) -> tuple[str, str]:
        """Text as it stands, and with line ends at blocks."""
        first, last = n["text_from"], n["text_to"]
        if last - first == 1:
            return self.raw[first], self.inner[first]
        return "".join(self.raw[first:last]), "".join(self.inner[first:last])


def _result_rows(page: _Page) -> list[list[dict]]:
    """Cells of each result row: rows of the result table if there is one, else all rows with cells."""
    rows = [n for n in page.found if n["tag"] == "tr"]
    listed = [r for r in rows if any(" table-results " in u["css"] for u in r["tables"] if u["tag"] == "table")
              and all(u["tag"] == "table" for u in r["tables"])]
    cells = [[n for n in page.found[r["first"] + 1:r["last"]] if n["tag"] == "td"] for r in listed or rows]
    return [c for c in cells if c or listed]


class _Lists:
    """Nested Arrow lists, column by column: plain value lists and the offsets of each level."""

    def __init__(self) -> None:
        self.nodes: list[tuple] = []
        self.size = 0

    def add(self, page: _Page, n: dict) -> None:
        content, inner = page.texts(n)
        self.nodes.append((n["tag"], n["id"], n["css"], n["href"], n["within"], content, inner))
        self.size += len(content) + len(inner) + 64

    def count(self) -> int:
        return len(self.nodes)

    def array(self) -> pa.StructArray:
        columns = zip(*self.nodes) if self.nodes else [()] * len(_PA_NODE)
        return pa.StructArray.from_arrays([pa.array(v, pa.string()) for v in columns], fields=list(_PA_NODE))


_FLUSH = 1 << 23   # characters per Arrow batch, so a batch stays small whatever the pages are like


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def fresh():
        return _Lists(), [0], [], [], [0], []

    nodes, node_ends, contents, inners, cell_ends, keys = fresh()

    def built() -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(node_ends, pa.int32()), nodes.array())
        cells = pa.StructArray.from_arrays([pa.array(contents, pa.string()), pa.array(inners, pa.string()), lists], fields=list(_PA_CELL))
        columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int32()))]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(cell_ends, pa.int32()), cells)], schema=_PA_CELLS)

    for batch in batches:
        for page_id, page_hash, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
            page = _Page(html or "", ROW_MARKS)
            for i, cells in enumerate(_result_rows(page)):
                for c in cells:
                    for n in page.found[c["first"] + 1:c["last"]]:
                        nodes.add(page, n)
                    node_ends.append(nodes.count())
                    content, inner = page.texts(c)
                    contents.append(content)
                    inners.append(inner)
                    nodes.size += len(content) + len(inner)
                cell_ends.append(len(contents))
                keys.append((page_id, page_hash, i))
                if nodes.size > _FLUSH:
                    yield built()
                    nodes, node_ends, contents, inners, cell_ends, keys = fresh()
    if keys:
        yield built()


def _read_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marked elements of whole pages. Cells and rows count only for their id or class."""
    nodes, ends, ids, hashes = _Lists(), [0], [], []

    def built() -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), nodes.array())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string()), lists], schema=_PA_NODES)

    for batch in batches:
        for page_id, page_hash, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
            page = _Page(html or "", DETAIL_MARKS)
            for n in page.found:
                if n["tag"] not in ("tr", "td") or n["id"] or n["css"]:
                    nodes.add(page, n)
            ends.append(nodes.count())
            ids.append(page_id)
            hashes.append(page_hash)
            if nodes.size > _FLUSH:
                yield built()
                nodes, ends, ids, hashes = _Lists(), [0], [], []
    if ids:
        yield built()


def _input(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long"), content_hash(F.col("html")).alias("page_hash"), "html")


def page_rows(pages: DataFrame) -> DataFrame:
    """(page_id, page_hash, row_no, cells) for every table row of ``pages(page_id, html)``."""
    return _input(pages).mapInArrow(_read_rows, _DDL_CELLS)


def page_nodes(pages: DataFrame) -> DataFrame:
    """(page_id, page_hash, nodes) for every page."""
    return _input(pages).mapInArrow(_read_nodes, _DDL_NODES)


def _first(nodes: Column, test) -> Column:
    return F.get(F.filter(nodes, test), F.lit(0))


def _by_id(fragment: str):
    return lambda n: n.id.contains(fragment)


def _bubble(fragment: str):
    return lambda n: n.css.contains(f" {S.CLASS_BUBBLE} ") & n.within.contains(fragment)


def _href(fragment: str):
    return lambda n: (n.tag == "a") & n.href.contains(fragment)


def _cell(i: int) -> Column:
    return F.get("cells", F.lit(i))


def _row_fields(base: str) -> dict[str, Column]:
    c1, c2, c5 = _cell(1), _cell(2), _cell(5)
    ref = _first(c2["nodes"], lambda n: (n.tag == "span") & n.css.contains(f" {S.CLASS_REFERENCE} "))
    anchor = _first(c5["nodes"], _href(S.HREF_DETAIL))
    return {"reference": F.coalesce(strip(ref["inner"]), F.lit("")), "date_publication": find_date(c1["inner"]),
            "lien": F.coalesce(resolve(anchor["href"], base), F.lit(""))}


def listing_rows(pages: DataFrame, base: str) -> DataFrame:
    """Listing records: rows of five cells or more with a reference of more than two characters."""
    rows = page_rows(pages).filter(F.size("cells") >= 5)
    c2, c3, c4 = _cell(2)["nodes"], _cell(3), _cell(4)
    text = lambda node: F.coalesce(collapse(node["content"]), F.lit(""))
    filled = lambda c: F.nullif(c, F.lit(""))
    place = lambda c: drop_label(c, S.PATTERN_LABEL_PLACE)
    objet = F.coalesce(filled(text(_first(c2, _bubble(S.ID_OBJECT)))),
                       drop_label(text(_first(c2, _by_id(S.ID_OBJECT))), S.PATTERN_LABEL_OBJECT))
    buyer = drop_label(text(_first(c2, _by_id(S.ID_BUYER))), S.PATTERN_LABEL_BUYER)
    lieu = F.coalesce(filled(text(_first(c3["nodes"], _bubble(S.ID_PLACE)))),
                      filled(place(text(_first(c3["nodes"], _by_id(S.ID_PLACE))))), place(c3["inner"]))
    closing = _first(c4["nodes"], lambda n: n.css.contains(f" {S.CLASS_DEADLINE} "))
    f = _row_fields(base)
    out = rows.select(
        "page_id", "page_hash", "row_no", f["reference"].alias("reference"), f["date_publication"].alias("date_publication"),
        strip(F.coalesce(closing["inner"], c4["inner"])).alias("date_limite"), f["lien"].alias("lien_detail"),
        objet.alias("objet"), buyer.alias("acheteur"), lieu.alias("lieu"))
    return out.filter(F.length("reference") > 2).withColumn("url_id", url_id(F.col("lien_detail")))


def minutes_rows(pages: DataFrame, base: str) -> DataFrame:
    """Minutes records: rows of six cells or more with a reference."""
    rows = page_rows(pages).filter(F.size("cells") >= 6)
    panel = _first(_cell(2)["nodes"], _by_id(S.ID_OBJECT))
    objet = strip(F.replace(F.coalesce(panel["content"], F.lit("")), F.lit("Objet :"), F.lit("")))
    f = _row_fields(base)
    return rows.select("page_id", "row_no", f["reference"].alias("reference"), objet.alias("objet"), f["lien"].alias("lien"),
                       f["date_publication"].alias("date_publication")).filter(F.length("reference") > 0)


def detail_records(pages: DataFrame, base: str) -> DataFrame:
    """Detail records, one per page."""
    nodes, links = F.col("nodes"), F.col("_links")
    # a fragment that is in none of the ids isn't sought element by element
    there = lambda fragment: F.col("_ids").contains(fragment)
    texts = lambda fragment, within=None: F.when(there(fragment), F.transform(F.filter(nodes, lambda n: n.id.contains(fragment) & (
        F.lit(True) if within is None else n.within.contains(within))), lambda n: n.inner)).otherwise(F.array().cast("array<string>"))
    by_id = lambda fragment: F.when(there(fragment), _first(nodes, _by_id(fragment)))
    said = lambda t: (lambda n: F.lower(collapse(n.content)).contains(t.lower()))
    anchors = [_first(links, _href(h)) for h in S.DCE_HREFS] + [_first(links, said(t)) for t in S.DCE_TEXTS]
    # what several fields or several branches of one need is sought once, in a step of its own
    rows = page_nodes(pages).withColumns({
        "_ids": F.array_join(F.transform(nodes, lambda n: n.id), "\n"), "_links": F.filter(nodes, lambda n: n.tag == "a")}).withColumns({
        "_block": by_id(S.ID_CONTACT_BLOCK), "_estimate": best_text(texts(S.ID_ESTIMATE)),
        "_bubble": _first(nodes, _bubble(S.ID_OBJECT)), "_panel": by_id(S.ID_OBJECT), "_anchor": F.coalesce(*anchors),
        "_award": strip(F.coalesce(*[by_id(i) for i in S.AWARD_IDS])["inner"])})
    block, estimate, bubble, panel, anchor, award = (F.col(f"_{c}") for c in ("block", "estimate", "bubble", "panel", "anchor", "award"))
    inside = F.concat(F.lit(" "), block["id"], F.lit(" "))
    in_block = lambda c: F.when(block.isNotNull(), c).otherwise(F.lit(""))
    without = lambda node, label: strip(F.replace(node["inner"], F.lit(label), F.lit("")))
    empty = F.lit("")
    fields = {
        "objet": F.coalesce(F.when(bubble.isNotNull(), strip(bubble["inner"])), without(panel, "Objet :"), empty),
        "acheteur": F.coalesce(without(by_id(S.ID_BUYER), "Acheteur public :"), empty),
        "lieu": F.coalesce(strip(_first(nodes, _bubble(S.ID_PLACE))["inner"]), empty),
        "domaines": empty,
        "estimation": F.when(estimate != "N/A", parse_amount(estimate)),
        "contact_nom": in_block(best_text(texts(S.ID_CONTACT_NAME))),
        **{k: in_block(first_text(texts(v, inside))) for k, v in S.CONTACT_FIELDS.items()},
        **{k: F.coalesce(F.nullif(best_text(texts(v)), F.lit("N/A")), empty) for k, v in S.DETAIL_FIELDS.items()},
        "lien_dce": F.coalesce(resolve(anchor["href"], base), empty),
        "attributaire": F.coalesce(strip(first_group(award, S.PATTERN_AWARDEE)), empty),
        "montant_reel": awarded_amount(award),
        "date_attribution": empty,
        "nb_soumissionnaires": bidder_count(award),
        "hash_content": F.col("page_hash"),
    }
    return rows.select("page_id", *[c.alias(k) for k, c in fields.items()])
