"""Main text of web pages: parsing with rules for boilerplate elements, and removal of subtrees that a site repeats."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout.llm.common import let
from linkscout.llm.reputation import host
from linkscout.operators.storage import materialise

# Fixed values of HTML: elements without content, elements that stand on lines of their own, end tags that may be left out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody"),
}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",)}

#: Elements that are never main text.
DROPPED = frozenset(
    "head title script style noscript template nav menu header footer aside form button select textarea input label option "
    "fieldset dialog iframe object embed svg canvas audio video map search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words in class or id that mark an element as boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox adblock sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menubar topbar breadcrumb breadcrumbs sidebar sidenav aside rail header masthead footer colophon cookie "
    "cookies consent gdpr notice notices notification alert popup overlay modal newsletter subscribe subscription signup login "
    "share sharing social related recommended comment comments commentlist respond disqus reply replies discussion widget "
    "pagination pager copyright disclaimer paywall skip".split()
)
#: Inside an article or main element a name must be made of marks and these words alone, and these marks alone say nothing
#: there: they may as well name parts of the text.
PLAIN = frozenset(
    "area bar block body box btn button card column container content el element group holder inner item items list module "
    "outer panel row section slot top bottom left right site page unit view widget wrap wrapper js".split()
)
AMBIGUOUS = frozenset(
    "aside banner copyright disclaimer discussion header menu promotion rail related reply replies respond skip social widget".split()
)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
SPACE = re.compile(r"\s+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Text that flows. Inside the main part it is a template only on a larger share of a host's articles, and only where less than
#: half of a page's text would go, as pages that differ little from each other share their text and no template. Headings
#: never are, nor texts of fewer words.
PROSE = frozenset("p blockquote pre li dt dd td th figcaption".split())
PROSE_WORDS = 4


class Element:
    __slots__ = ("tag", "dropped", "children", "parent", "inside")

    def __init__(self, tag: str, dropped: bool, parent: Element | None):
        self.tag, self.dropped, self.parent = tag, dropped, parent
        self.children: list[Element | str] = []
        self.inside: bool = tag in ("article", "main") or parent is not None and parent.inside


def names_boilerplate(value: str, inside: bool) -> bool:
    """Whether a class or id marks an element: by any word on a page, by whole names inside the main part."""
    if not inside:
        return not MARKS.isdisjoint(w.lower() for w in WORD.findall(value))
    for name in value.split():
        found = {w.lower() for w in WORD.findall(name) if not w.isdigit()}
        if found and found <= MARKS | PLAIN and not found <= AMBIGUOUS | PLAIN:
            return True
    return False


def marked(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether an element is boilerplate by its name, role, visibility, class or id.

    A header inside the main part is not: its headings are the article's own.
    """
    if tag in DROPPED and not (inside and tag == "header"):
        return True
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and (value or "").lower() in ROLES:
            return True
        if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id") and value and tag not in ("html", "body", "article", "main"):
            if names_boilerplate(value, inside):
                return True
    return False


class Builder(HTMLParser):
    """Element tree of a page, however malformed. References are decoded, comments and declarations left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#root", False, None)

    def close(self) -> None:
        super().close()
        self.rawdata = ""

    def leave(self, tags: tuple[str, ...], stop: tuple[str, ...]) -> None:
        """Close the open element of one of ``tags``, with all inside it, unless one of ``stop`` is nearer."""
        e = self.at
        while e.parent is not None and e.tag not in stop:
            if e.tag in tags:
                self.at = e.parent
                return
            e = e.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.leave(("p",), ("td", "th", "button", "object"))
        if tag in CLOSES:
            stop = SCOPE.get(tag, ("table",))
            for _ in range(3):
                self.leave(CLOSES[tag], stop)
        e = Element(tag, marked(tag, attrs, self.at.inside), self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        stop = () if tag in ("body", "html", "article", "main") else ("article", "main", "body")
        e = self.at
        while e.parent is not None:
            if e.tag == tag:
                self.at = e.parent
                return
            if e.tag in stop:
                return
            e = e.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def tree(html: str) -> Element:
    builder = Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def main_parts(root: Element) -> list[tuple[Element, bool]]:
    """The outermost articles; else the outermost main elements; else the page. The flag tells a found part from a page."""
    for wanted in ("article", "main"):
        found, stack = [], [root]
        while stack:
            e = stack.pop()
            if e.dropped:
                continue
            if e.tag == wanted:
                found.append((e, True))
            else:
                stack.extend(c for c in reversed(e.children) if isinstance(c, Element))
        if found:
            return found
    return [(root, False)]


def subtree(tag: str, texts: list[str], prose: bool) -> int:
    """Hash of a subtree by its element and texts; odd for prose, even for containers."""
    h = xxhash.xxh64_intdigest("\x00".join([tag, *texts])) - (1 << 63)
    return h | 1 if prose else h & ~1


def blocks(root: Element) -> list[tuple[str, list[int]]]:
    """Text blocks of the main part in page order, each with the hashes of the subtrees around it that may be template.

    A block ends where a block element starts or ends. Every block element around it counts, but for headings and short prose
    inside an article or main element. A header there gives its headings.
    """
    out: list[tuple[str, list[int]]] = []
    for part, found in main_parts(root):
        texts: list[str] = []
        spans: list[tuple[int, int, Element]] = []
        inline: list[str] = []

        def flush() -> None:
            text = SPACE.sub(" ", "".join(inline)).strip()
            inline.clear()
            if text:
                texts.append(text)

        # Walked with a list, as pages may nest deeper than Python does. Inside a header, text waits for a heading.
        todo: list[tuple[Element | str, int | None, bool]] = [(part, None, True)]
        while todo:
            node, began, taken = todo.pop()
            if isinstance(node, str):
                inline.append(node if taken else " ")
            elif began is not None:
                if node.tag in BLOCK:
                    flush()
                    if node is not part and node.tag not in ("html", "body") and not (found and node.tag in HEADINGS):
                        spans.append((began, len(texts), node))
            elif node.tag == "br":
                inline.append(" ")
            elif not node.dropped:
                if node.tag in BLOCK:
                    flush()
                taken = taken and node.tag != "header" or node.tag in HEADINGS
                todo.append((node, len(texts), taken))
                todo.extend((c, None, taken) for c in reversed(node.children))
        flush()
        around: list[list[int]] = [[] for _ in texts]
        for a, b, node in spans:
            prose = found and node.tag in PROSE
            if a < b and b - a < len(texts) and not (prose and sum(len(t.split()) for t in texts[a:b]) < PROSE_WORDS):
                h = subtree(node.tag, texts[a:b], prose)
                for i in range(a, b):
                    around[i].append(h)
        out.extend(zip(texts, around, strict=True))
    return out


def parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(page_id, url, host, row, article, blocks)``; ``row`` is a hash of the whole row, ``article`` one of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(tree(x)) for x in batch.column(4).to_pylist()]
            article = [xxhash.xxh64_intdigest("\n\n".join(t for t, _ in page)) - (1 << 63) for page in found]
            listed = [[{"text": t, "around": a} for t, a in page] for page in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(article, pa.int64()), pa.array(listed, BLOCKS)],
                ["page_id", "url", "host", "row", "article", "blocks"],
            )

    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"),
        F.xxhash64(F.col(id_col), F.col(url_col), html).alias("row"), html.alias("html"),
    )
    return rows.mapInArrow(
        run, "page_id long, url string, host string, row long, article long, blocks array<struct<text:string,around:array<bigint>>>"
    )


BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("around", pa.list_(pa.int64()))]))


def templates(pages: DataFrame, min_pages: int, min_share: float, prose_share: float) -> DataFrame:
    """From ``(host, article, around)``, ``(host, h)``: subtrees that stand on at least ``min_pages`` different articles of a host and on
    ``min_share`` of them, prose on ``prose_share``.

    Different articles are counted, so copies of one page do not make its text a template. Counts are combined in each task.
    """
    articles = pages.select("host", "article").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("articles"))
    seen = pages.select("host", "article", F.explode("around").alias("h")).distinct()
    counts = seen.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    share = F.when(F.col("h") % 2 == 0, F.lit(min_share)).otherwise(F.lit(prose_share))
    return counts.join(articles, "host").where(F.col("n") >= share * F.col("articles")).select("host", "h")


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = 5,
    min_share: float = 0.5, prose_share: float = 0.75,
) -> DataFrame:
    """``(page_id, url, text)`` per row of ``pages``: the blocks of the main part, joined by an empty line.

    Elements that are boilerplate by name, role, class or id go; of what is left, subtrees that recur on many different
    pages of the host go, prose only where it is less than half of the page. Null or empty html gives an empty text; pages with a
    null url are one host. Repeated rows are kept. Other columns are not read. Pages are parsed twice, for the counts and for the
    text, as hashes are small to keep and texts are not; the pages that hold a template are written, so where they are few the
    texts meet them without a shuffle.
    """
    rows = parsed(pages, id_col, url_col, html_col)
    around = F.array_distinct(F.flatten("blocks.around")).alias("around")
    seen = materialise(rows.select("row", "host", "article", around))
    own = seen.select("row", "host", F.explode("around").alias("h"))
    found = own.join(templates(seen, min_pages, min_share, prose_share), ["host", "h"])
    repeated = materialise(found.groupBy("row").agg(F.collect_set("h").alias("template")))

    def without(kind: int, listed: Column) -> Column:
        hashes = F.filter("template", lambda h: F.pmod(h, F.lit(2)) == kind)
        return F.filter(listed, lambda b: ~F.arrays_overlap(b.getField("around"), hashes))

    def size(listed: Column) -> Column:
        return F.aggregate(listed, F.lit(0).cast("long"), lambda n, b: n + F.length(b.getField("text")))

    def chosen(listed: Column) -> Column:
        return let(without(1, listed), lambda rest: F.when(2 * size(rest) > size(listed), rest).otherwise(listed))

    kept = F.when(F.col("template").isNull(), F.col("blocks")).otherwise(let(without(0, F.col("blocks")), chosen))
    return rows.join(repeated, "row", "left").select(
        "page_id", "url", F.array_join(F.transform(kept, lambda b: b.getField("text")), "\n\n").alias("text")
    )
