"""Main text of web pages by a site style tree.

1. Every page is cut into blocks, each with the path of elements (tag, class, id, role)
   above it.  Paths of one host are merged into its style tree.
2. For every node of the tree two entropies over the host's pages are taken: of its
   *content* (a text that stands on all of the node's pages carries nothing, one of a
   single page carries all) and of its *presentation* (the child tags it is built of).
   Their weighted sum is the node's importance.  All text counts for every node above it,
   whatever the markup says about it; the text that stands in a node beside child
   elements is a node of its own.
3. The paths of known importance, a short list per host, are joined to its pages.  The
   nearest known node of a block decides: the block is removed if that node is of low
   importance, and, where it is a node further up, holds no important block on the page.
   What the markup declares to be no text is removed too: menus, headers, footers,
   sidebars, notices, adverts, forms, comments, scripts.  A class, id or role declares it
   if all its words do, boxes aside (``cookie-notice``, ``comment-list``); one with other
   words besides (``menu-open``, ``comments-open``, ``ad-hoc``) leaves the decision to the
   tree.  Words never hide headings, sections (but for those of reader comments), html,
   body, an article or main element, or what holds one, and a form does not hide a page
   it goes round; an article inside an article counts as any element.  Where a page has
   an article or main element, only what is inside it counts.

Only hashes of paths and texts are shuffled, folded inside the tasks first: a text is one
row with the nodes above it, dealt by host and text and spread to its nodes behind the
shuffle.  The join by host is dealt over ``LANES`` lanes, so that a hot host does not end
in one task.

Defined results: null or empty html gives empty text; a page without a readable host has
no style tree, only its markup counts, and so has a host of one page; unclosed elements
end with their parent; blocks directly in an article, without attributes of their own,
are never removed by entropy, and a page that would lose all its text keeps it, so that
copies of one article on a host keep theirs.  A page is read in one pass, however long
or broken; elements nested deeper than ``DEPTH`` hang on the last one.  Repeated rows
give a row each; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter, namedtuple
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import blocks, pin_batches

# One page says nothing about its site: a text it holds stands on all pages seen.
LEAST_PAGES = 2
LANES = 32
IMPORTANCE, CONTENT_SHARE = 0.3, 0.8
# Elements nested deeper hang on the last one, as browsers do it too.
DEPTH = 256

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of HTML: elements whose content is no text, inside a line or not, and
# those that form blocks.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp"}
CONTROL = {"svg", "button", "select", "object", "canvas"}
NEVER = {"head", "nav", "footer", "aside", "form", "dialog", "menu"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form head header hr html li main menu nav ol p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
) | NEVER | HEADING
ENDS = {  # What an opening element ends first, and where the search for it stops.
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
MAIN = {"article", "main"}
# What stands in a form that goes round a whole page, as some servers write it.
FRAME = {"nav", "header", "footer", "h1"} | MAIN
NOISE = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar cookie cookies"
    " consent notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social"
    " related breadcrumb breadcrumbs menu nav navbar navigation footer masthead comment comments reply replies respond"
    " widget toolbar pagination pager contentinfo complementary header".split()
)
# Words that only name a box, and so leave the meaning to the word beside them.
BOX = set("list area box wrap wrapper container block item items thread user reader slot unit top bottom left right".split())
COMMENT = {"comment", "comments", "reply", "replies", "respond"}


@lru_cache(maxsize=1 << 14)
def _element(tag: str, attributes: str) -> tuple[str, bool]:
    """The element's name in a path, and whether its class, id or role says it is no text.

    Headings, tables' parts and the page's own elements are never hidden by a word, and
    a section, which any chapter is, only by those of reader comments.
    """
    names = []
    for kind, *values in _NAMED.findall(attributes):
        names.append((kind.lower(), next((v for v in values if v), "")))
    marks = [{w.lower() for w in _PART.findall(mark)} for _, v in names for mark in v.split()]
    said = [words for words in marks if words & NOISE and words <= NOISE | BOX]
    if tag == "section":
        noise = any(words <= COMMENT | BOX for words in said)
    else:
        noise = bool(said) and tag not in HEADING | MAIN | {"html", "body", "td", "th", "tr", "tbody", "thead"}
    return tag + "".join(f"[{k}={v}]" for k, v in sorted(names)), noise


@lru_cache(maxsize=1 << 16)
def step(above: int, name: str) -> int:
    """The code of a path from the code of the path above and one more name."""
    raw = above.to_bytes(8, "little", signed=True) + name.encode("utf-8", "surrogatepass")
    return int.from_bytes(blake2b(raw, digest_size=8).digest(), "little", signed=True)


def code(path: str) -> int:
    """The code of a path written with slashes; that of a text is its only step."""
    value = 0
    for name in path.split("/"):
        value = step(value, name)
    return value


class _Open:
    __slots__ = ("tag", "path", "above", "noise", "hinted", "holds", "main", "story", "bare", "children")

    def __init__(self, tag: str, name: str, hinted: bool, above: _Open | None) -> None:
        self.tag = tag
        self.path = step(0 if above is None else above.path, name)
        self.above = above
        inside = above is not None and above.main
        within = above is not None and above.story
        self.main = inside or tag in MAIN
        self.story = within or tag == "article"
        # A page header is noise; the header of an article holds its title.
        self.noise = tag in NEVER and tag != "form" or tag == "header" and not inside
        # Noise unless it turns out to hold the main text, as a form round a whole page does.
        self.hinted = tag == "form" or hinted and not (tag == "header" and inside)
        self.holds = False
        node: _Open | None = self
        if tag == "main" or tag == "article" and not within:
            while node is not None and not node.holds:
                node.holds = True
                node = node.above
        elif tag in FRAME:
            while node is not None:
                node.holds = node.holds or node.tag == "form"
                node = node.above
        self.bare = inside and above.bare and name == tag or tag in MAIN
        self.children: list[str] = []

    def hidden(self) -> bool:
        """Whether markup says it is no text; known once the page is read."""
        node: _Open | None = self
        while node is not None:
            if node.noise or node.hinted and not node.holds:
                return True
            node = node.above
        return False

    def paths(self) -> tuple[int, ...]:
        found, node = [], self
        while node.above is not None:
            found.append(node.path)
            node = node.above
        return tuple(reversed(found))


class _Reader:
    """Finds tags in one pass: whatever the page, no part of it is searched again and again."""

    def __init__(self, page: str) -> None:
        self.page, self.strict, self.next, self.open = page, True, {}, set()

    def find(self, what: str, at: int) -> int:
        """The next place of ``what`` from ``at`` on, or the page's end."""
        known = self.next.get(what, -1)
        if known < at:
            known = self.page.find(what, at)
            self.next[what] = known = len(self.page) if known < 0 else known
        return known

    def tag_end(self, at: int) -> int:
        """Where the tag's ``>`` is: the first outside quotes.

        Once quotes of a page turn out not to close, tags end at the first ``>``.
        """
        end = first = self.find(">", at)
        while self.strict and end < len(self.page):
            quote = min(self.find('"', at), self.find("'", at))
            if quote > end:
                return end
            closing = self.find(self.page[quote], quote + 1)
            if closing == len(self.page):
                break
            at = closing + 1
            end = self.find(">", at)
        if end != first or end == len(self.page):
            self.strict = False
        return first

    def after(self, tag: str, at: int, nested: bool) -> int | None:
        """Behind the end tag of the element opened before ``at``; None if there is none."""
        if tag in self.open:
            return None
        depth = 1
        for found in _ends(tag).finditer(self.page, at):
            depth += -1 if found[1] else nested
            if not depth:
                return min(self.find(">", found.end()) + 1, len(self.page))
        self.open.add(tag)
        return None


@lru_cache(maxsize=64)
def _ends(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){tag}(?=[\s/>])", re.I)


Block = namedtuple("Block", "paths text noise main bare heading")


def parse(page: str) -> tuple[list[Block], list[tuple[int, str]]]:
    """Blocks in page order, and the presentation (path, child tags) of every element
    that holds others.

    Text beside child elements gets a last path of its own.
    """
    found: list[tuple[_Open, str]] = []
    shapes: dict[int, list[str]] = {}
    root, reader = _Open("", "", False, None), _Reader(page)
    stack, pieces, at, size = [root], [], 0, len(page)

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                found.append((stack[-1], text))

    def close(n: int) -> None:
        while len(stack) > n:
            node = stack.pop()
            if node.children:
                shapes.setdefault(node.path, []).append(" ".join(node.children))

    while at < size:
        mark = reader.find("<", at)
        pieces.append(page[at:mark])
        if mark == size:
            break
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        ending = page.startswith("/", mark + 1)
        named = _NAME.match(page, mark + 1 + ending)
        if not named and not page.startswith(("!", "?"), mark + 1):
            pieces.append("<")
            at = mark + 1
            continue
        end = reader.tag_end(named.end()) if named else reader.find(">", mark)
        if end == size:
            pieces.append(page[mark:])
            break
        at = end + 1
        if not named:
            continue
        tag, rest = named[0].lower(), page[named.end():end]
        if tag in RAW or tag in CONTROL:
            if not ending and not rest.endswith("/"):
                behind = reader.after(tag, at, tag in CONTROL)
                at = behind if behind is not None else at if tag in CONTROL else size
            continue
        if tag not in BLOCK:
            if tag == "br":
                pieces.append(" ")
            continue
        flush()
        if ending:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        if stack[-1].tag == "p":
            close(len(stack) - 1)
        mates, stop = ENDS.get(tag, ((), ()))
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in stop or not mates:
                break
            if stack[i].tag in mates:
                close(i)
                break
        close(DEPTH)
        stack[-1].children.append(tag)
        if tag not in VOID:
            stack.append(_Open(tag, *_element(tag, rest), stack[-1]))
    flush()
    close(1)
    out, known = [], {}
    for node, text in found:
        if node not in known:
            paths = node.paths()
            if paths and node.path in shapes:
                paths += (step(node.path, ""),)
            known[node] = paths, node.hidden()
        paths, hidden = known[node]
        out.append(Block(paths, text, hidden, node.main, node.bare, node.tag in HEADING))
    return out, [(path, shape) for path, many in shapes.items() for shape in many]


def page_text(page: str, low: frozenset[int] = frozenset(), high: frozenset[int] = frozenset()) -> str:
    """The main text: blocks that are no noise and not held by the host's tree to be of low
    importance; ``low`` and ``high`` are its known nodes.

    A page that would lose all its text by the tree keeps it: it is a copy of others.
    """
    shown = [block for block in parse(page)[0] if not block.noise]
    if any(block.main for block in shown):
        shown = [block for block in shown if block.main]
    judged, rich = [], set()
    for block in shown if low else ():
        # A heading that many pages have is judged by what it stands in.
        above = block.paths if not (block.main and block.heading) else block.paths[:-1]
        known = next((p for p in reversed(above) if p in low or p in high), None)
        if block.bare or known in high:
            rich.update(block.paths)
        judged.append((not block.bare and known in low, known, bool(above) and known == block.paths[-1]))
    kept = [block for block, (poor, known, own) in zip(shown, judged) if not poor or not own and known in rich]
    return "\n".join(block.text for block in kept or shown)


def host_of(url: str = "url"):
    host = F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(host, F.lit(""))


FEATURE = "host string, kind int, value long, paths array<bigint>, pages long, uses long"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host, value and its nodes: on how many pages, how often under each node.

    Kinds: 0 the node itself, 1 a text, 2 a presentation of the node.  A text that some
    nodes of a page hold more often than others has a row for each number of uses.
    """
    for some in blocks(batches, "html", 8 << 20):
        pages: Counter = Counter()
        uses: Counter = Counter()
        for host, page in zip(some.column("host").to_pylist(), some.column("html").to_pylist()):
            found, shapes = parse(page)
            texts: dict[int, Counter] = {}
            for block in found:
                texts.setdefault(step(0, block.text), Counter()).update(block.paths)
            nodes: set[int] = set()
            for value, under in texts.items():
                nodes.update(under)
                for n in set(under.values()):
                    key = host, 1, value, tuple(sorted(p for p, m in under.items() if m == n))
                    pages[key] += 1
                    uses[key] += n
            for path, shape in shapes:
                if path in nodes:
                    uses[host, 2, step(path, f" {shape}"), (path,)] += 1
            for node in nodes:
                pages[host, 0, node, (node,)] += 1
        keys = list(pages.keys() | uses.keys())
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
            pa.array([k[2] for k in keys], pa.int64()), pa.array([k[3] for k in keys], pa.list_(pa.int64())),
            pa.array([pages[k] for k in keys], pa.int64()), pa.array([uses[k] for k in keys], pa.int64()),
        ], names=["host", "kind", "value", "paths", "pages", "uses"])


def style_tree(pages: DataFrame) -> DataFrame:
    """``host, path, pages, importance`` of every node that holds text."""
    pin_batches(pages.sparkSession)
    rows = pages.select(host_of().alias("host"), F.coalesce("html", F.lit("")).alias("html")).filter("host is not null")
    # Dealt by host and value, so that the totals per node need no further shuffle of texts.
    dealt = rows.mapInArrow(_features, FEATURE).repartition("host", "value")
    values = dealt.withColumn("path", F.explode("paths")).groupBy("host", "path", "kind", "value").agg(
        F.sum("pages").alias("pages"), F.sum("uses").alias("uses")
    )
    on = lambda kind, column: F.sum(F.when(F.col("kind") == kind, column))
    spread = F.col("uses") * F.log("pages")
    nodes = values.groupBy("host", "path").agg(
        on(0, F.col("pages")).alias("pages"), on(1, F.col("uses")).alias("texts"), on(1, spread).alias("text_spread"),
        on(2, F.col("uses")).alias("shapes"), on(2, F.col("uses") * F.log("uses")).alias("shape_spread"),
    )
    base = F.log(F.greatest("pages", F.lit(2)))
    # A text on k of the node's m pages has entropy log k / log m over them.
    content = 1 - F.col("text_spread") / F.col("texts") / base
    # The entropy of the node's presentations, again to the base of its pages.
    shown = F.when(F.col("shapes") > 0, (F.log("shapes") - F.col("shape_spread") / F.col("shapes")) / base).otherwise(content)
    importance = CONTENT_SHARE * content + (1 - CONTENT_SHARE) * F.least(shown, F.lit(1.0))
    return nodes.select("host", "path", "pages", importance.alias("importance"))


def main_texts(pages: DataFrame, least_pages: int = LEAST_PAGES, least_importance: float = IMPORTANCE) -> DataFrame:
    """``page_id, url, text`` for every row of ``pages``."""
    tree = style_tree(pages)
    is_low = F.col("importance") < least_importance
    known = tree.filter(F.col("pages") >= least_pages).groupBy("host").agg(
        F.collect_list(F.when(is_low, F.col("path"))).alias("low"),
        F.collect_list(F.when(~is_low, F.col("path"))).alias("high"),
    )
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of().alias("host"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                page_text(page, frozenset(low or ()), frozenset(high or ()))
                for page, low, high in zip(*(batch.column(name).to_pylist() for name in ("html", "low", "high")))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    # A host's short list goes to every lane, so that a hot host's pages are spread.
    known = known.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("page_id", "url"), F.lit(LANES)).cast("int"))
    return rows.join(known, ["host", "lane"], "left").select("page_id", "url", "html", "low", "high").mapInArrow(
        extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    )
