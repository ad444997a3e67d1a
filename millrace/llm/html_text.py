"""Main text of web pages by equivalence-class template deduction.

Tokens are elements, named by their path of tags and their own class or id (digits as 0), and texts under such a
path. Over the pages of a host, tokens with the same occurrence vector (how often on each page) form a class; the
vector is folded to one number by a sum of hashes, so no page list is ever gathered. Classes on ``SUPPORT`` pages or
more are valid, so a host may have several templates. They are nested by where their tokens open and close (folded
over the pages): a text within an element of its own class is constant and belongs to the template; inside article
and main this needs an element with a class or id of its own there. What is left lies in the slots. The main
slot is the innermost element, once on each of its pages, that holds ``HELD`` of their text without the constant ones; an article or main element
that occurs once on the page and is nested with it, or stands alone, goes before it.

Elements that HTML itself sets apart (head, nav, aside, scripts and the like) are left out. Whole names such as
``sidebar`` count only as a tie-break: they are left out while other text remains, and never on html, body, article
or main. A page left with nothing by its template keeps its constant texts.

In the main slot block texts are decoded, white space becomes one blank, and blocks are joined by line breaks. A page
without a slot is read from its body. Null html is empty; a null url is a host of its own. Rows that repeat a page
count twice. A tag that is never closed ends with its surroundings.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches

HELD = 0.8
#: Pages of a host that a class needs.
SUPPORT = 3

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>""", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW = frozenset("script style noscript template textarea iframe svg math object".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html"
    " legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_OUTER = frozenset("head title nav header footer aside form button select menu dialog".split()) | _RAW
_OUTER_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies consent disqus footer"
    " header masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted related reply replies respond search share"
    " sharing sidebar social sponsor sponsored subscribe toolbar topbar widget".split()
)
_MAIN = ("article", "main")
_NEVER_OUTER = frozenset(("html", "body", *_MAIN))
#: A closing tag of these ends an open p; opening one does too.
_ENDS_P = _BLOCKS - {"body", "html", "head"}


def _names(attributes: str) -> list[str]:
    return [w for m in _NAMED.finditer(attributes) for w in (m[2] or m[3] or m[4] or "").lower().split()]


@lru_cache(maxsize=100_000)
def _number(above: int, name: str) -> int:
    """A token's 64-bit number, from that of what it stands in."""
    return int.from_bytes(blake2b(name.encode("utf-8", "surrogatepass"), digest_size=8, key=above.to_bytes(8, "big", signed=True)).digest(), "big", signed=True)


def tokens(page: str) -> Iterator[tuple[str, str, list[str], str]]:
    """("open" | "close" | "text", tag, names, text) in page order; raw elements and comments are skipped."""
    at, raw = 0, None
    for m in _TAG.finditer(page):
        tag = (m[2] or m[5] or "").lower()
        closing = m[1] or m[4]
        if raw is not None:
            if closing and tag == raw:
                raw, at = None, m.end()
            continue
        if m.start() < at:
            continue
        if m.start() > at:
            yield "text", "", [], page[at : m.start()]
        at = m.end()
        if not tag:
            continue
        if tag in _RAW and not closing:
            if not m[0].endswith("/>"):
                raw, at = tag, len(page)
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, m.end())
                raw, at = None, end.end() if end else len(page)
            continue
        yield ("close" if closing else "open"), tag, [] if closing else _names(m[3] or m[6] or ""), ""
    if at < len(page):
        yield "text", "", [], page[at:]


class Element:
    """An element of a page: its token, where it opens and closes, and how much text it holds."""

    __slots__ = ("tag", "path", "token", "first", "last", "held", "out", "named", "inner", "marked")

    def __init__(self, tag: str, names: list[str], first: int, held: int, above: Element | None) -> None:
        self.tag, self.first, self.last, self.held = tag, first, first, held
        self.path = _number(above.path if above else 0, tag)
        own = sorted({re.sub(r"\d+", "0", n) for n in names}) if tag not in ("html", "body") else []
        self.token = _number(self.path, ".".join(own))
        self.out = tag in _OUTER or bool(above and above.out)
        self.named = bool(above and above.named) or (tag not in _NEVER_OUTER and any(n in _OUTER_NAMES for n in names))
        self.inner = bool(above and (above.inner or above.tag in _MAIN))  # inside article or main
        self.marked = self.inner and (bool(own) or bool(above and above.marked))  # below a class or id there


class Page:
    """One walk over a page: its elements, and its texts and breaks in page order."""

    def __init__(self, page: str) -> None:
        self.elements: list[Element] = []
        self.parts: list[tuple[int, str | None, Element | None]] = []  # place, text (None: end of a block), element
        self.whole = 0
        stack: list[Element] = []
        at = 0
        for at, (kind, tag, names, text) in enumerate(tokens(page)):
            if kind == "text":
                above = stack[-1] if stack else None
                self.parts.append((at, text, above))
                if not text.isspace() and not (above and (above.out or above.named)):
                    self.whole += len(text)
                continue
            if tag in _BLOCKS:
                self.parts.append((at, None, None))
            elif tag == "br":
                self.parts.append((at, " ", stack[-1] if stack else None))
            if kind == "open":
                if tag in _VOID:
                    continue
                if tag in _ENDS_P and any(e.tag == "p" for e in stack):
                    while any(e.tag == "p" for e in stack) and stack[-1].tag not in ("div", "article", "section", "main", "td", "li", "blockquote", "body"):
                        self._close(stack.pop(), at)
                stack.append(Element(tag, names, at, self.whole, stack[-1] if stack else None))
                self.elements.append(stack[-1])
            elif any(e.tag == tag for e in stack):
                while True:
                    closed = stack.pop()
                    self._close(closed, at)
                    if closed.tag == tag:
                        break
        while stack:
            self._close(stack.pop(), at + 1)

    def _close(self, element: Element, at: int) -> None:
        element.last, element.held = at, self.whole - element.held

    def counted(self) -> dict[int, list]:
        """token -> [times, first, last, held, is element, may be a slot, inside article or main]."""
        found: dict[int, list] = {}
        for e in self.elements:
            if e.inner and not e.marked:
                continue  # neither a slot before its article nor an owner of constant texts
            slot = not (e.out or e.named or e.tag in ("html", "body"))
            row = found.setdefault(e.token, [0, e.first, e.last, 0, True, slot, e.inner])
            row[0], row[2], row[3] = row[0] + 1, max(row[2], e.last), row[3] + e.held
        for at, text, e in self.parts:
            if (key := constant_key(text, e)) is not None:
                row = found.setdefault(key, [0, at, at, 0, False, False, e.inner])
                row[0], row[2], row[3] = row[0] + 1, at, row[3] + (0 if e.named else len(text))
        return found

    def main_text(self, slots: frozenset[int], constant: frozenset[int]) -> str:
        first, last = self._slot(slots)
        inside = [p for p in self.parts if first <= p[0] <= last and not (p[2] and p[2].out)]
        for drop_constant, drop_named in ((True, True), (False, True), (False, False)):
            text = _joined(
                part for _, part, e in inside
                if part is None or not (drop_named and e and e.named) and not (drop_constant and constant and constant_key(part, e) in constant)
            )
            if text:
                return text
        return ""

    def _slot(self, slots: frozenset[int]) -> tuple[int, int]:
        """Where the main slot opens and closes; all of the page without one."""
        best = min((e for e in self.elements if e.token in slots and not e.out), key=lambda e: (e.last - e.first, -e.first), default=None)
        for tag in _MAIN:
            own = [e for e in self.elements if e.tag == tag and not e.out]
            if len(own) == 1 and (best is None or not (own[0].last < best.first or best.last < own[0].first)):
                return own[0].first, own[0].last
        if best is None:
            best = next((e for e in self.elements if e.tag == "body"), None)
        return (best.first, best.last) if best else (0, 1 << 62)


def constant_key(text: str | None, e: Element | None) -> int | None:
    """The token of a text that may be constant: not set apart by HTML, and in article or main only below a class or id."""
    if text is None or e is None or e.out or (e.inner or e.tag in _MAIN) and not e.marked:
        return None
    said = " ".join(text.split())
    return _number(e.token, "=" + said) if said else None


def _joined(parts: Iterator[str | None]) -> str:
    blocks, line = [], []
    for part in [*parts, None]:
        if part is not None:
            line.append(part)
        elif line:
            if text := " ".join(entities.unescape("".join(line)).split()):
                blocks.append(text)
            line = []
    return "\n".join(blocks)


def _surveyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, page_id, page in zip(*(batch[c].to_pylist() for c in ("host", "page_id", "html"))):
            read = Page(page or "")
            rows += [(host, token, page_id, read.whole, *row) for token, row in read.counted().items()]
        columns = list(zip(*rows)) or [()] * 11
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
        names = ["host", "token", "page_id", "whole", "n", "first", "last", "held", "element", "slot", "inner"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/?#]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, slots, constant): the tokens of each host's templates that may hold the main text, and its constant texts.

    ``pages`` as from ``with_host``. One row per host and token leaves each map task.
    """
    found = pages.select("host", "page_id", "html").mapInArrow(
        _surveyed, "host string, token long, page_id long, whole long, n int, first long, last long, held long, element boolean, slot boolean, inner boolean"
    )
    vector = F.sum(F.xxhash64("page_id", "n").cast("decimal(38,0)"))
    folded = found.groupBy("host", "token").agg(
        vector.alias("vector"), F.count(F.lit(1)).alias("pages"),
        F.max("n").alias("most"), F.sum("first").alias("first"), F.sum("last").alias("last"), F.sum("held").alias("held"),
        F.sum("whole").alias("whole"), F.min("element").alias("element"), F.min("slot").alias("slot"), F.max("inner").alias("inner"),
    )
    of_class = W.partitionBy("host", "vector", "pages")
    opens = lambda which: F.min(F.when(which, F.col("first"))).over(of_class)
    closes = lambda which: F.max(F.when(which, F.col("last"))).over(of_class)
    element, below = F.col("element"), F.col("element") & F.col("inner")
    nested = folded.where(F.col("pages") >= SUPPORT).withColumns(
        {"opens": opens(element), "closes": closes(element), "opens_below": opens(below), "closes_below": closes(below)}
    )
    within = (F.col("opens") <= F.col("first")) & (F.col("last") <= F.col("closes"))
    within_below = (F.col("opens_below") <= F.col("first")) & (F.col("last") <= F.col("closes_below"))
    constant = ~element & F.coalesce(F.when(F.col("inner"), within_below).otherwise(within), F.lit(False))
    once = element & F.col("slot") & ~F.col("inner") & (F.col("most") == 1)
    rows = nested.withColumns({"constant": constant, "once": once}).where("constant OR once")
    # Constant text within an element and on its pages, by running sums over the places where tokens open and close.
    ends = rows.select("*", F.posexplode(F.array("first", "last")).alias("closing", "place"))
    gone = F.sum(F.when(F.col("constant") & (F.col("closing") == 0), F.col("held")).otherwise(0))
    ends = ends.withColumns({"until": gone.over(of_class.orderBy("place")), "gone": gone.over(of_class)})
    shares = ends.groupBy("host", "token", "constant", "held", "whole").agg((F.max("until") - F.min("until")).alias("inside"), F.max("gone").alias("gone"))
    left = F.col("held") - F.col("inside")
    holds = ~F.col("constant") & (left > 0) & (left >= HELD * (F.col("whole") - F.col("gone")))
    kept = shares.select("host", "token", "constant", holds.alias("holds")).where("constant OR holds")
    return kept.groupBy("host").agg(
        F.collect_list(F.when(F.col("holds"), F.col("token"))).alias("slots"), F.collect_list(F.when(F.col("constant"), F.col("token"))).alias("constant")
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page, slots, constant in zip(*(batch[c].to_pylist() for c in ("html", "slots", "constant"))):
            out.append(Page(page or "").main_text(frozenset(slots or ()), frozenset(constant or ())))
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(out, pa.string())], names=["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    bound_batches(pages.sparkSession)
    rows = with_host(pages)
    found = templates(rows).withColumnRenamed("host", "__host")
    joined = rows.join(found, rows["host"].eqNullSafe(F.col("__host")), "left").select("page_id", "url", "html", "slots", "constant")
    return joined.mapInArrow(_read, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
