"""Main-text extraction from web pages by site style trees.

The pages of a host are merged into one style tree: a node is a path of elements
(tag, class and id names without digits) of any depth, carried as a hash of the parent's and the style. Over the host's distinct pages a node has
- presentation: the sequences of child elements that pages show at it. Its importance is the
  entropy of their distribution, to the base of the number of pages;
- content: its text blocks. A block on k of m pages has entropy log k / log m; the
  node's content importance is one less the mean over its distinct blocks.
A node's composite importance weighs its own presentation with the content and the
children below it (``gamma``); branches whose nodes are all below ``threshold`` are removed from every page of the host.
Two things are known of a style beforehand and enter its importance. Where the element says what it is
(``nav``, ``footer``, forms, names such as ``ad`` or ``comments``) the
importance counts a tenth: many sites fill such branches anew on each page, which
entropy alone takes for content. Plain prose of an ``article`` or ``main`` (paragraphs,
headings, lists without names of their own) has importance 1: copies of an article are articles. A
page's article is what these elements hold, or else its body.
Scripts, styles and the head hold no text and are not in the tree.

Statistics are counts by (host, path, feature), summed before they are shuffled;
only a host's style nodes, not its pages, come together. A host with fewer than
``least_pages`` distinct pages removes nothing by statistics.

Defined cases: null or empty html gives an empty text; a null or odd url is the host
'' (its pages are one site); pages that repeat count once in the statistics and
each get their result row; cut-off tags and character references are read as HTML does;
only page_id, url and html are read. An empty table gives an empty result.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import saved, table

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
_PROSE = set("article main section div body html p h1 h2 h3 h4 h5 h6 ul ol li blockquote pre table tbody thead tr td th dl dt dd figure figcaption".split())
# Elements and names that say that a branch is not the article.
_NOT_TEXT = set("nav footer aside form script style noscript template button select option input iframe svg dialog head title textarea menu object".split())
_NOT_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe signup login sidebar sidebars rail menu menus nav navbar navigation breadcrumb breadcrumbs "
    "header masthead topbar footer comment comments disqus reply replies respond share sharing social related recommended widget widgets pagination pager "
    "toolbar skip complementary contentinfo search".split()
)
_SAME_LEVEL = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")


class Block:
    """A text block: its path, its text, and whether it is within an article."""

    __slots__ = ("path", "text", "article")

    def __init__(self, path: int, text: str, article: bool):
        self.path, self.text, self.article = path, text, article


#: What is known of a style beforehand.
_UNLIKELY, _OPEN, _PROSE_OF_ARTICLE = 0, 1, 2


def _h(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


_ROOT = _h("path")


def parse(page: str) -> tuple[list[Block], dict[int, list[str]], dict[int, int], dict[int, int]]:
    """(text blocks in order, children's styles of every path, what is known of every path, every path's parent)."""
    # open elements: (tag, path, inside an article, plain prose)
    stack: list[tuple] = [("", _ROOT, False, True)]
    known: dict[int, int] = {_ROOT: _OPEN}
    above: dict[int, int] = {_ROOT: 0}
    blocks: list[Block] = []
    children: dict[int, list[str]] = {}
    held: list[str] = []

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", _html.unescape("".join(held))).strip()
            held.clear()
            if text:
                # the block belongs to the innermost block element
                i = len(stack) - 1
                while i and stack[i][0] not in _BLOCK:
                    i -= 1
                if any(known[x[1]] == _UNLIKELY for x in stack[i + 1 :]):
                    i = len(stack) - 1  # an inline element that says what it is
                blocks.append(Block(stack[i][1], text, stack[i][2]))

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if not m:
            held.append(page[at:])
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end tag
            if any(tag == s[0] for s in stack):
                if tag in _BLOCK:
                    flush()
                while stack.pop()[0] != tag:
                    pass
            continue
        rest = m[3] if m[2] else m[6] or ""
        if tag in _BLOCK:
            flush()
            if any(s[0] == "p" for s in stack):  # a paragraph ends where a block begins
                while stack.pop()[0] != "p":
                    pass
            if tag in _SAME_LEVEL:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in _SAME_LEVEL[tag]:
                        break
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
        elif tag == "br":
            held.append(" ")
        names: list[str] = []
        if "=" in rest:
            for _, a, b, c in _NAMES.findall(rest):
                names += _WORDS.findall((a or b or c).lower())
        _, path, article, prose = stack[-1]
        style = ".".join([tag, *names])
        children.setdefault(path, []).append(style)
        parent, path = path, _h(str(path), style)
        above[path] = parent
        inside = article or tag in ("article", "main") or "main" in names and "role" in rest.lower()
        prose = prose and tag in _PROSE and not (names and inside) if tag in _BLOCK else prose
        if known[stack[-1][1]] == _UNLIKELY or tag in _NOT_TEXT or (tag == "header" and not article) or not _NOT_NAMES.isdisjoint(names):
            now = _UNLIKELY
        else:
            now = _PROSE_OF_ARTICLE if inside and prose else _OPEN
        known[path] = min(known.get(path, now), now)
        if tag in _VOID or rest.endswith("/") and tag in _RAW:
            continue
        if tag in _RAW:
            end = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(page, at)
            at = end.start() if end else n
            if end:
                at = page.find(">", end.start()) + 1 or n
            continue
        stack.append((tag, path, inside, prose))
    flush()
    return blocks, children, known, above


def style_rows(pages: DataFrame) -> DataFrame:
    """(host, path, parent, prior, kind, feature, page): kind 0 is a text block of the path, 1 its children's styles, once a page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for host, text in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                page = text.as_py()
                if not page:
                    continue
                blocks, children, known, above = parse(page)
                sig = _h("page", *[b.text for b in blocks])
                # the paths that hold text, up to the root
                place: dict[int, tuple] = {}
                for p in [b.path for b in blocks]:
                    while p and p not in place:
                        place[p] = (p, above[p], known[p])
                        p = above[p]
                seen = {(*place[b.path], 0, _h("text", b.text)) for b in blocks}
                seen |= {(*place[p], 1, _h("style", *children.get(p, []))) for p in place}
                out += [(host, *s, sig) for s in seen]
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["host", "path", "parent", "prior", "kind", "feature", "page"])

    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pages.mapInArrow(run, "host string, path long, parent long, prior int, kind int, feature long, page long")


def importance(rows: DataFrame, gamma: float, least_pages: int) -> DataFrame:
    """(host, path, importance): the highest composite importance in every branch, from counts of its nodes' features."""
    k = rows.distinct().groupBy("host", "path", "parent", "kind", "feature").agg(F.count(F.lit(1)).alias("k"), F.min("prior").alias("prior"))
    nodes = k.groupBy("host", "path", "parent").agg(
        F.min("prior").alias("prior"),
        F.sum(F.when(F.col("kind") == 1, F.col("k")).otherwise(0)).alias("m"),
        F.sum(F.when(F.col("kind") == 1, F.col("k") * F.log("k")).otherwise(0.0)).alias("klogk"),
        F.sum(F.when(F.col("kind") == 0, F.log("k")).otherwise(0.0)).alias("logk"),
        F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).alias("blocks"),
    )

    def compose(key: tuple, group: pa.Table) -> pa.Table:
        r = group.to_pylist()
        below: dict[int, list[dict]] = {}
        for x in r:
            below.setdefault(x["parent"], []).append(x)
        score: dict[int, float] = {}

        def visit(top: dict) -> None:
            # children before parents, without recursion
            todo = [(top, False)]
            while todo:
                x, done = todo.pop()
                kids = [c for c in below.get(x["path"], []) if c["path"] != x["path"]]
                if not done:
                    todo.append((x, True))
                    todo += [(c, False) for c in kids if c["path"] not in score]
                    continue
                m = x["m"]
                if m < least_pages:
                    score[x["path"]] = 1.0
                    continue
                shown = (math.log(m) - x["klogk"] / m) / math.log(m)
                parts = [score[c["path"]] for c in kids]
                if x["blocks"]:
                    parts.append(1 - x["logk"] / x["blocks"] / math.log(m))
                inner = sum(parts) / len(parts) if parts else 0.0
                score[x["path"]] = (1 - gamma) * shown + gamma * inner if kids else inner

        known = {x["path"] for x in r}
        for x in r:
            if x["parent"] not in known or x["parent"] == x["path"]:
                visit(x)
        for x in r:
            if x["prior"] == _UNLIKELY:
                score[x["path"]] *= 0.1
            elif x["prior"] == _PROSE_OF_ARTICLE:
                score[x["path"]] = 1.0
        # a branch is as important as the most important node in it
        up = {x["path"]: x["parent"] for x in r}
        for path, value in list(score.items()):
            above = up[path]
            while above in score and score[above] < value and above != path:
                score[above] = value
                above = up[above]
        return pa.table({"host": pa.array([key[0].as_py()] * len(score), pa.string()), "path": pa.array(list(score), pa.int64()), "importance": pa.array(list(score.values()), pa.float64())})

    return nodes.groupBy("host").applyInArrow(compose, "host string, path long, importance double")


def extract(pages: DataFrame, threshold: float = 0.2, gamma: float = 0.9, least_pages: int = 4) -> DataFrame:
    """(page_id, url, text): main text of every page."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    low = importance(style_rows(pages.select("host", "html")), gamma, least_pages).where(F.col("importance") < threshold)
    low = saved(low.groupBy("host").agg(F.collect_list("path").alias("low")), "sitestyle-low")  # style nodes of one host

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = []
            for page, gone in zip(batch.column("html"), batch.column("low").to_pylist(), strict=True):
                text.append(main_text(page.as_py(), frozenset(gone or ())))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string())], names=["page_id", "url", "text"])

    return pages.join(low, "host", "left").mapInArrow(run, "page_id long, url string, text string")


def main_text(page: str | None, low: frozenset) -> str:
    """The page's article without the branches of low importance."""
    if not page:
        return ""
    blocks, _, _, above = parse(page)
    known = {_ROOT: False}

    def gone(path: int) -> bool:
        way = []
        while path not in known and path not in low:
            way.append(path)
            path = above[path]
        known.update(dict.fromkeys([path, *way], known.get(path, True)))
        return known[path]

    kept = [b for b in blocks if not gone(b.path)]
    if any(b.article for b in kept):
        kept = [b for b in kept if b.article]
    return "\n".join(b.text for b in kept)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page and its length in code points."""
    text = extract(table(spark, sf_dir, "pages"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
