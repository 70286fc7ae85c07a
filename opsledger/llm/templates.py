"""Main text of web pages, with the template of each site removed.

Pass one parses every page and hashes its element subtrees (tag, text and children). Spark
counts the pages of each host that hold a subtree; pages with the same main text, template
included, count once, so copies of a page make no template. Subtrees on at least ``LEAST_PAGES``
such pages of a host are its template, however large the host is; an element that holds an
article or main element never is. Pass two parses again, deletes the template,
what is marked as
navigation, header, footer, sidebar, notice, advert, form, script or comment by its tag,
role, class or id, and takes the text of the article (else of the main
element, else of the body). Inside the article only containers count as template, never its
headings, paragraphs and other blocks of text, so a sentence that many pages quote stays;
outside, no part of a sentence does.

The template is a table of (host, mark). If it is measured to be small, each task of pass two
gets it whole; otherwise it is joined to the marks of the pages, and each page gets its own.

Character references are decoded, white space within a block becomes one space, blocks
are joined by a newline. Pages without closing tags, with stray ones or with bare
angle brackets are read as browsers would; nothing is cut. Null and empty html give
the empty text. Pages without a host are their own template-free
group. An empty table gives no rows. Other
columns of the pages are ignored.
"""

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.functions.joins import MAX_BROADCAST_ROWS, fits_broadcast, lookup_join
from opsledger.functions.workspace import stored

LEAST_PAGES = 5
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.DOTALL,
)
_MARK = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "li", "dt", "dd",
                "td", "th", "tr", "caption", "figcaption"}
_BLOCKS = _TEXT_BLOCKS | {
    "html", "body", "div", "section", "article", "main", "header", "footer", "aside", "nav", "ul",
    "ol", "dl", "table", "thead", "tbody", "tfoot", "figure", "form", "fieldset", "address",
    "details", "summary", "hr", "center", "hgroup", "option",
}
_CONTAINERS = {"div", "section", "ul", "ol", "dl", "table", "figure", "details", "address", "header"}
_DROPPED = {
    "script", "style", "noscript", "template", "head", "title", "nav", "footer", "aside", "form",
    "button", "select", "textarea", "input", "iframe", "object", "svg", "canvas", "dialog", "menu",
    "audio", "video", "map", "option",
}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
          "alert", "alertdialog", "menu", "menubar", "toolbar"}
_COMMENTS = {"comment", "comments", "commentlist", "disqus", "replies"}
_NAMES = _COMMENTS | {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "banner", "sponsor", "sponsored",
    "promo", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay",
    "newsletter", "subscribe", "signup", "sidebar", "widget", "nav", "navbar", "navigation", "menu",
    "breadcrumb", "breadcrumbs", "pagination", "pager", "footer", "masthead", "topbar", "share",
    "sharing", "social", "related", "recommended", "toolbar", "skip",
}
_WHOLE = {"html", "body", "main"}
_MAIN_ROLE = re.compile(r"""\brole\s*=\s*["']?main\b""", re.I)
# an open element of the first kind ends when one of the others starts
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody"}, "th": {"td", "th", "tr", "tbody"}, "option": {"option"},
    "p": _BLOCKS - {"td", "th", "tr", "thead", "tbody", "tfoot", "option", "caption"},
    "head": {"body"} | (_BLOCKS - {"html"}),
}
_FENCES = {"table", "ul", "ol", "dl", "td", "th", "html"}


class Element:
    __slots__ = ("tag", "marks", "parts", "whole")

    def __init__(self, tag: str, marks: str):
        self.tag, self.marks, self.parts = tag, marks, []
        self.whole = False  # is it, or does it hold, an article or main element?


def parse(page: str) -> Element:
    """The tree of a page; text stays as written, with its character references."""
    root = Element("", "")
    path = [root]
    at, size = 0, len(page)
    lower = None
    while at < size:
        found = _TOKEN.search(page, at)
        if found is None:
            path[-1].parts.append(page[at:])
            break
        if found.start() > at:
            path[-1].parts.append(page[at : found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            _close(path, tag)
            continue
        marks = found[3] if found[2] else found[6]
        _end_implied(path, tag)
        element = Element(tag, marks)
        path[-1].parts.append(element)
        if tag in ("article", "main") or _main_role(element):
            element.whole = True
            for above in reversed(path):
                if above.whole:
                    break
                above.whole = True
        if tag in _RAW:
            lower = lower or page.lower()
            if len(lower) != size:  # a character that has two in lower case
                lower = re.sub("[A-Z]", lambda m: m[0].lower(), page)
            end = lower.find(f"</{tag}", at)
            end = size if end < 0 else end
            element.parts.append(page[at:end])
            at = page.find(">", end) + 1 or size
        elif tag not in _VOID and not marks.endswith("/"):
            path.append(element)
        elif tag not in _VOID and tag in _BLOCKS:
            path.append(element)
    return root


def _main_role(element: Element) -> bool:
    return bool(element.marks) and _MAIN_ROLE.search(element.marks) is not None


def _close(path: list[Element], tag: str) -> None:
    for i in range(len(path) - 1, 0, -1):
        if path[i].tag == tag:
            del path[i:]
            return
        if path[i].tag in _FENCES and tag in _ENDS:
            return


def _end_implied(path: list[Element], tag: str) -> None:
    for i in range(len(path) - 1, 0, -1):
        if tag in _ENDS.get(path[i].tag, ()):
            del path[i:]
            return
        if path[i].tag in _FENCES or path[i].tag in ("div", "section", "article", "body"):
            return


def hashes(root: Element) -> dict[int, int]:
    """Hash of each subtree that holds text, by identity; raw elements hash their source."""
    found, order, stack = {}, [], [root]
    while stack:
        element = stack.pop()
        order.append(element)
        stack += [p for p in element.parts if isinstance(p, Element)]
    for element in reversed(order):
        parts = [element.tag]
        for part in element.parts:
            if isinstance(part, Element):
                if id(part) in found:
                    parts.append(f"\x01{found[id(part)]}")
            elif words := part.split():
                parts.append(" ".join(words))
        if len(parts) > 1:
            text = "\x02".join(parts).encode("utf-8", "replace")
            found[id(element)] = xxhash.xxh3_64_intdigest(text) - (1 << 63)
    return found


def candidates(root: Element, found: dict[int, int]) -> set[int]:
    """Hashes of the subtrees that may be template."""
    out, stack = set(), [(root, False, False)]
    while stack:
        element, inside, worded = stack.pop()
        if _may_go(element, inside, worded) and id(element) in found:
            out.add(found[id(element)])
        inside = inside or element.tag in ("article", "main")
        worded = worded or element.tag in _TEXT_BLOCKS
        stack += [(p, inside, worded) for p in element.parts if isinstance(p, Element)]
    return out


def _may_go(element: Element, inside: bool, worded: bool = False) -> bool:
    """May it be template: ``inside`` an article, or elsewhere ``worded``, in a block of text?"""
    if element.whole or element.tag in _WHOLE or element.tag in ("", "head", "title", "meta"):
        return False
    if inside:
        return element.tag in _CONTAINERS
    return not worded or element.tag in _BLOCKS


def _marked(element: Element, inside: bool) -> bool:
    """Is the element boilerplate by its tag, role, class or id?"""
    tag = element.tag
    if tag in _DROPPED or tag == "header" and not inside:
        return True
    if not element.marks or tag in _WHOLE:
        return False
    for mark in _MARK.finditer(element.marks):
        name, value = mark[1].lower(), (mark[2] or "").strip("\"'").lower()
        if name == "role":
            if value in _ROLES:
                return True
        elif name == "hidden" or name == "aria-hidden":
            if name == "hidden" or value == "true":
                return True
        elif set(_WORD.findall(value)) & (_COMMENTS if tag == "article" else _NAMES):
            return True
    return False


def main_text(page: str | None, template: set[int] = frozenset()) -> str:
    """Text of the main part of a page, without subtrees whose hash is in ``template``."""
    if not page:
        return ""
    root = parse(page)
    return _text(root, template, hashes(root) if template else {})


def _text(root: Element, template, found) -> str:
    for wanted in ("article", "main", ""):
        tops = _tops(root, wanted, template, found)
        if tops:
            return "\n".join(b for top in tops for b in _blocks(top, template, found, wanted != ""))
    return ""


def _gone(element, inside, template, found, worded=False) -> bool:
    if _marked(element, inside):
        return True
    return bool(template) and found.get(id(element)) in template and _may_go(element, inside, worded)


def _tops(root, wanted, template, found) -> list[Element]:
    """Outermost elements of a kind that are not boilerplate, in page order."""
    if not wanted:
        return [root]
    out, stack = [], [root]
    while stack:
        element = stack.pop()
        role = wanted == "main" and _main_role(element)
        if element is not root and _gone(element, False, template, found):
            continue
        if element.tag == wanted or role:
            out.append(element)
        else:
            stack += [p for p in reversed(element.parts) if isinstance(p, Element)]
    return out


def _blocks(top: Element, template, found, inside: bool) -> list[str]:
    blocks, text = [], []

    def flush():
        words = entities.unescape("".join(text)).split()
        if words:
            blocks.append(" ".join(words))
        text.clear()

    stack = [iter(top.parts)]
    ends, worded = [True], [False]
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            worded.pop()
            if ends.pop():
                flush()
        elif isinstance(part, str):
            text.append(part)
        elif part.tag == "br":
            text.append(" ")
        elif not _gone(part, inside, template, found, worded[-1]):
            block = part.tag in _BLOCKS
            worded.append(worded[-1] or part.tag in _TEXT_BLOCKS)
            if block:
                flush()
            stack.append(iter(part.parts))
            ends.append(block)
    return blocks


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))


def site_templates(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Rows (``host``, ``mark``): the hashes of the template of each host."""

    def run(batches):
        for batch in batches:
            hosts, marks, texts = [], [], []
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                if host and page:
                    root = parse(page)
                    mine = candidates(root, hashes(root))
                    text = _text(root, frozenset(), {}).encode("utf-8", "replace")
                    hosts += [host] * len(mine)
                    marks += mine
                    texts += [xxhash.xxh3_64_intdigest(text) - (1 << 63)] * len(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(marks, pa.int64()), pa.array(texts, pa.int64())],
                ["host", "mark", "text"],
            )

    keyed = pages.select(host_of(F.col("url")).alias("host"), "html")
    distinct = keyed.mapInArrow(run, "host string, mark long, text long").distinct()
    counts = distinct.groupBy("host", "mark").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= least_pages).select("host", "mark")


def _page_templates(keyed: DataFrame, template: DataFrame) -> DataFrame:
    """Rows (``page``, ``marks``): the template of a host as far as a page holds it."""

    def run(batches):
        for batch in batches:
            pages, hosts, marks = [], [], []
            for page, host, html in zip(*(batch.column(c).to_pylist() for c in ("page", "host", "html"))):
                if host and html:
                    root = parse(html)
                    mine = candidates(root, hashes(root))
                    pages += [page] * len(mine)
                    hosts += [host] * len(mine)
                    marks += mine
            yield pa.RecordBatch.from_arrays(
                [pa.array(pages, pa.int64()), pa.array(hosts, pa.string()), pa.array(marks, pa.int64())],
                ["page", "host", "mark"],
            )

    held = keyed.select("page", "host", "html").mapInArrow(run, "page long, host string, mark long")
    held = lookup_join(held, template, ["host", "mark"], "left_semi", is_small=False)
    # a list is bounded by the subtrees of one page
    return held.groupBy("page").agg(F.collect_set("mark").alias("marks"))


def main_texts(pages: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, **limits) -> DataFrame:
    """``page_id``, ``url`` and the main text of each page."""
    rows = pages.select("page_id", "url", "html")
    keyed = rows.withColumn("host", host_of(F.col("url")))
    template = stored(site_templates(rows, **limits), "site-templates")
    known = {}
    if fits_broadcast(template, max_rows):
        for row in template.collect():
            known.setdefault(row["host"], set()).add(row["mark"])
        keyed = keyed.withColumn("marks", F.lit(None).cast("array<long>"))
    else:
        keyed = keyed.withColumn("page", F.xxhash64("host", "html"))
        keyed = keyed.join(_page_templates(keyed, template), "page", "left")

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("html", "host", "marks"))
            texts = [main_text(page, known.get(host) or set(marks or ())) for page, host, marks in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    out = keyed.select("page_id", "url", "html", "host", "marks")
    return out.mapInArrow(run, f"page_id {kind}, url string, text string")


def digests(pages: DataFrame) -> DataFrame:
    return main_texts(pages).withColumn("n_chars", F.length("text").cast("long"))
