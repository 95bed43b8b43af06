"""Main text of web pages by tag-path ratios.

A page is read into blocks: runs of text between block-level tags, each with
its root-to-leaf path of block-level tags (with their classes). Per path the
text ratio (characters a block) and the punctuation ratio (marks a block) are
smoothed over neighbours in page order and fused by their geometric mean.
Blocks whose path reaches a share of the page's mean ratio are content; so are
the headings and short blocks between them and those that stand beside them in
one element. Where article and main elements hold most of the page's score
(ratio times characters), only blocks in these count.

Scripts, styles, menus (nav), footers and hidden elements (also by their style)
are never read. Asides, forms, page headers, and elements whose role, class or
id names a menu, sidebar, advert, notice, comments and the like are *suspect*, in
two degrees: they are left out unless they hold the best path or most of the
score. What a weak name stands for (discussion, tags; or a strong word among
others) doesn't tell against prose in the article, unless it is built as readers'
remarks are. An article or main element that alone holds the page's h1 is the
page's text, however short.

The page is read once from left to right, and nesting is kept as numbers with
parents, so time and memory grow with the page's length, whatever is left open.

Defined results: null or empty html, or a page without text -> empty string;
unclosed and wrongly nested tags are closed as browsers close them as far as
text needs; character references are decoded; white space inside a block
becomes one space; nulls in other columns and repeated rows are kept; an empty
table gives an empty one; all columns are kept but for one named like the
result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from mercato.llm.common import by_batch

TAG = re.compile(r"/?([a-zA-Z][^\s/>]*)")
SPECIAL = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "annotation", "annotation-xml", "object", "title", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option",
    "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: An open element of the value's kinds ends where the key begins, inside the nearest of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}), "option": ({"option"}, {"select"})}
DROPPED = RAW | {"head", "nav", "footer", "select", "input", "audio", "video", "canvas"}
#: Dropped like the elements of a listed name: unless they hold the content.
SUSPECT = {"aside", "form", "menu", "dialog", "button", "label", "fieldset", "search"}
#: Words of names that tell against an element; the weak ones also stand in articles.
STRONG = re.compile(
    r"ads?|adverts?|advertisements?|advertising|advertorials?|adsense|sponsor(?:ed|s)?|promo(?:s|ted|tion|tions)?|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|widgets?|footers?|"
    r"masthead|toolbar|cookies?|consent|popups?|modal|overlay|newsletters?|subscribe|subscription|signup|login|share|sharing|recommend(?:ed|ations?)|comments?|commenters?|commenting|"
    r"commentlist|disqus|replies|responses|pagination|pager|skip|copyright|gdpr|notices?|alerts?|banners?", re.I)
WEAK = re.compile(r"headers?|social|related|reply|discussion|commentary|toc|tags|disclaimer", re.I)
#: Makes a weak word a strong one (related-posts, social-links).
LINKED = re.compile(r"articles?|posts?|stories|story|news|links?|reading|media|share|icons?|buttons?", re.I)
#: Say nothing by themselves in a name of several words (site-footer, user-comments).
BESIDE = re.compile(r"site|page|top|bottom|left|right|primary|secondary|main|side|bar|box|block|list|area|section|links?|posts?|articles?|stories|container|wrapper|wrap|slot|unit|user|reader|visitor|"
                    r"thread|body|content|text|message|policy|inner|outer|form|item|entry|fb|facebook|google|panel|module|holder|stream|feed|view|card|group|title|count|author|\d+", re.I)
#: Tell of a state or a layout, not of what the element is (has-sidebar, comments-open).
STATE = re.compile(r"has|with|no|non|without|is|open|opened|closed|enabled|disabled|allowed|layout", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
MARKS = re.compile(r"[.,;:!?…。，！？、]")
SHARE = 0.2  #: of the page's mean ratio
PROSE = 16.0  #: ratio that suffices on any page: about 100 characters and 1.5 marks a block
BARRIERS = ("article", "body", "html", "table", "td", "li")  #: end tags of inline elements don't reach beyond
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
#: Elements of a text, as against the containers they stand in.
PARTS = HEADINGS | {"p", "ul", "ol", "li", "dl", "dt", "dd", "table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "header"}
SEMANTIC = 4  #: times a block counts inside an article or main element


class Element:
    """An open element, with what holds for all that it contains."""

    __slots__ = ("block", "chain", "container", "dropped", "linked", "name", "node", "number", "root")

    def __init__(self, name: str, up: Element | None):
        self.name, self.block = name, False
        self.dropped = up.dropped if up else False
        self.linked = up.linked if up else False        # inside a link
        self.number = up.number if up else 0            # of the innermost block-level element
        self.container = up.container if up else 0      # the innermost one that isn't a part of a text
        self.node = up.node if up else 0                # its path
        self.root = up.root if up else 0                # the outermost article or main element
        self.chain = up.chain if up else 0              # the innermost suspect element


@dataclass
class Block:
    node: int  # of its path
    text: str
    element: int
    container: int
    chain: int
    root: int
    raw: str
    line: int  # blocks of one line are pieces cut by suspect elements inside it
    linked: bool  # mostly text of links
    step: str  # tag of the innermost block-level element


class Page:
    """The blocks outside dropped elements. Paths and elements are numbers whose
    parents are kept once, so nesting costs nothing per block."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.above = [0]  # element -> the block-level element around it
        self.tag = [""]
        self.paths: dict[tuple[int, str], int] = {}
        self.chains = [(0, 0)]  # suspect element -> strength, the suspect element around it
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}  # tag -> where it is open
        self.blocks_open: list[int] = []
        self.held: list[str] = []
        self.lines = self.links = 0
        self.read(source)

    def flush(self, ends: bool = True) -> None:
        if self.held:
            raw = "".join(self.held)
            text = " ".join(raw.split())
            if text or ends:
                self.held.clear()
            if text:
                e = self.stack[-1] if self.stack else Element("", None)
                self.blocks.append(Block(e.node, text, e.number, e.container, e.chain, e.root, raw, self.lines, 2 * self.links > len(text), self.tag[e.number]))
                self.links = 0
        self.lines += ends

    def close(self, to: int) -> None:
        gone = self.stack[to:]
        if any(e.block for e in gone):
            self.flush()
        elif gone[0].chain != (self.stack[to - 1].chain if to else 0) or gone[-1].chain != gone[0].chain:
            self.flush(False)
        del self.stack[to:]
        for e in reversed(gone):
            self.places[e.name].pop()
            if e.block:
                self.blocks_open.pop()

    def last(self, names) -> int:
        """Where the innermost open element of these tags stands (-1: nowhere)."""
        return max((at[-1] for n in names if (at := self.places.get(n))), default=-1)

    def end_tag(self, name: str) -> None:
        at = self.last((name,))
        if at < 0:
            if name in BLOCK:
                self.flush()
        elif name in BLOCK or at >= self.last(BARRIERS):
            self.close(at)

    def before_block(self, name: str) -> None:
        """Close what the start of a block-level element ends."""
        if self.blocks_open and self.stack[self.blocks_open[-1]].name == "p":
            self.close(self.blocks_open[-1])
        if name in CLOSES:
            mine, inside = CLOSES[name]
            at = self.last(mine)
            if at > self.last(inside):
                self.close(at)
        self.flush()

    def open(self, name: str, attributes: dict[str, str]) -> None:
        up = self.stack[-1] if self.stack else None
        e = Element(name, up)
        e.block = name in BLOCK
        e.linked |= name == "a"
        plain = name not in ("html", "body")
        hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or HIDDEN.search(attributes.get("style", ""))
        e.dropped |= name in DROPPED or bool(plain and hidden)
        strength = 0
        if name in SUSPECT or (name == "header" and not e.root):
            strength = 2
        elif plain:
            strength = 2 if attributes.get("role", "").lower() in ROLES else suspicion(f"{attributes.get('class', '')} {attributes.get('id', '')}")
        if strength:
            if not e.block:
                self.flush(False)
            self.chains.append((strength, e.chain))
            e.chain = len(self.chains) - 1
        if e.block:
            step = name + "".join("." + c for c in sorted(attributes.get("class", "").split()))
            e.node = self.paths.setdefault((e.node, step), len(self.paths) + 1)
            self.above.append(e.number)
            self.tag.append(name)
            e.number = len(self.above) - 1
            if name not in PARTS:
                e.container = e.number
            if name in ("article", "main") and not e.root:
                e.root = e.number
            self.blocks_open.append(len(self.stack))
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append(e)

    def text(self, text: str) -> None:
        if text and not (self.stack and self.stack[-1].dropped):
            self.held.append(html.unescape(text))
            if self.stack and self.stack[-1].linked:
                self.links += len(text.strip())

    def read(self, source: str) -> None:
        """One pass that never goes back: what is not closed lasts to the end."""
        at, end = 0, len(source)
        final = {mark: source.rfind(mark) for mark in ("-->", "]]>", ">", '"', "'")}

        def after(mark: str, start: int) -> int:
            return source.index(mark, start) + len(mark) if final[mark] >= start else end

        while at < end:
            lt = source.find("<", at)
            if lt < 0:
                lt = end
            self.text(source[at:lt])
            at = lt + 1
            if lt >= end:
                break
            if source.startswith("!--", at):
                at = after("-->", at + 3)
            elif source.startswith("![CDATA[", at):
                at = after("]]>", at + 8)
            elif source[at:at + 1] in ("!", "?"):
                at = after(">", at)
            elif not (m := TAG.match(source, at)):
                self.text("<")
            else:
                stop = tag_end(source, m.end(), final)
                self.tag_at(m[1].lower(), source[at] == "/", source[m.end():stop] if stop < end else None)
                at = min(stop + 1, end)
                if m[1].lower() in RAW and source[m.start()] != "/" and stop < end:
                    close = re.compile(rf"</{re.escape(m[1])}\s*>", re.I).search(source, at)
                    at = close.end() if close else end
        self.flush()

    def tag_at(self, name: str, closing: bool, rest: str | None) -> None:
        if rest is None:  # the page ends inside the tag
            return
        if closing:
            self.end_tag(name)
        elif name == "br":
            if not (self.stack and self.stack[-1].dropped):
                self.held.append(" ")
        else:
            if name in BLOCK:
                self.before_block(name)
            if name in VOID or name in RAW or (rest.rstrip().endswith("/") and name not in BLOCK):
                return
            found: dict[str, str] = {}
            for key, *value in ATTRIBUTE.findall(rest):
                found.setdefault(key.lower(), "".join(value))
            self.open(name, found)


def tag_end(source: str, at: int, final: dict[str, int]) -> int:
    """Where the tag's ``>`` stands; a quote counts after = only, and one that
    is never closed ends with the tag's first ``>``."""
    while m := SPECIAL.search(source, at):
        if m[0] == ">":
            return m.start()
        quoted = source[max(0, m.start() - 20):m.start()].rstrip().endswith("=")
        if not quoted:
            at = m.end()
        elif final[m[0]] < m.end():
            return source.index(">", m.end()) if final[">"] >= m.end() else len(source)
        else:
            at = source.index(m[0], m.end()) + 1
    return len(source)


def suspicion(label: str) -> int:
    """2 or 1 if a class or id says that an element isn't part of the text: 2 if
    it consists of listed words, a strong one among them; 1 if these are weak, or
    a strong one stands with words that aren't listed."""
    found = 0
    for token in label.split():
        words = WORD.findall(token)
        if not words or any(STATE.fullmatch(w) for w in words):
            continue
        strong = any(STRONG.fullmatch(w) for w in words)
        weak = any(WEAK.fullmatch(w) for w in words)
        strong = strong or (weak and any(LINKED.fullmatch(w) for w in words))
        listed = all(STRONG.fullmatch(w) or WEAK.fullmatch(w) or LINKED.fullmatch(w) or BESIDE.fullmatch(w) for w in words)
        found = max(found, 2 if strong and listed else int(strong or (weak and listed)))
    return found


def path_ratios(blocks: list[Block]) -> dict[int, float]:
    """Smoothed and fused ratio of every path, in page order. A path's size
    doesn't enter: both ratios are means over its blocks."""
    paths: dict[int, list[float]] = {}
    for b in blocks:
        sums = paths.setdefault(b.node, [0, 0, 0])
        sums[0] += len(b.text)
        sums[1] += len(MARKS.findall(b.text))
        sums[2] += 1

    def smooth(values: list[float]) -> list[float]:
        return [0.15 * values[max(0, i - 1)] + 0.7 * v + 0.15 * values[min(len(values) - 1, i + 1)] for i, v in enumerate(values)]

    ratios = zip(smooth([n / k for n, _, k in paths.values()]), smooth([(k + marks) / k for _, marks, k in paths.values()]), strict=True)
    return {path: (a * b) ** 0.5 for path, (a, b) in zip(paths, ratios, strict=True)}


def threshold(blocks: list[Block], ratio: dict[int, float]) -> float:
    """``SHARE`` of the mean ratio, every character counted once; a ratio of
    prose suffices however long other blocks are."""
    return min(PROSE, SHARE * sum(ratio[b.node] * len(b.text) for b in blocks) / max(1, sum(len(b.text) for b in blocks)))


def without_suspects(page: Page) -> list[Block]:
    """The blocks outside suspect elements. One that holds the best path or most
    of the score isn't suspect, nor one by a weak name whose paths are content
    paths of the article, unless it is what readers' remarks look like: several
    blocks of one path, no heading, and nothing of the article after them."""
    blocks = page.blocks
    if not any(b.chain for b in blocks):
        return blocks
    ratio = path_ratios(blocks)
    least, semantic = threshold(blocks, ratio), any(b.root for b in blocks)
    score: dict[int, float] = {}
    weights = [ratio[b.node] * len(b.text) * (SEMANTIC if b.root else 1) for b in blocks]
    for b, weight in zip(blocks, weights, strict=True):
        score[b.node] = score.get(b.node, 0) + weight
    best, total = max(score, key=score.__getitem__), sum(weights)
    n = len(page.chains)
    inside = [[0.0, 0.0, 0, 0, 0, 0, 0] for _ in range(n)]  # weight, best path's, size, passing, headings, blocks, last block
    nodes: list[int | None] = [None] * n  # the one path of all blocks, -1: several
    last = -1
    for i, (b, weight) in enumerate(zip(blocks, weights, strict=True)):
        passing = ratio[b.node] >= least and bool(b.root or not semantic)
        if not b.chain and passing:
            last = i
        sums = inside[b.chain]
        for at, value in enumerate((weight, weight * (b.node == best), len(b.text), len(b.text) * passing, b.step in HEADINGS, 1)):
            sums[at] += value
        sums[6] = i
        nodes[b.chain] = b.node if nodes[b.chain] in (None, b.node) else -1
    for c in range(n - 1, 0, -1):  # an element's number is above that of the one around it
        up = page.chains[c][1]
        for at in range(6):
            inside[up][at] += inside[c][at]
        inside[up][6] = max(inside[up][6], inside[c][6])
        if nodes[c] is not None:
            nodes[up] = nodes[c] if nodes[up] in (None, nodes[c]) else -1
    kept = [True] * n
    for c in range(1, n):
        strength, up = page.chains[c]
        weight, of_best, size, passing, headings, count, final = inside[c]
        holds = 2 * weight > total or 2 * of_best > score[best]
        remarks = count > 1 and not headings and nodes[c] != -1 and final > last
        kept[c] = kept[up] and (holds or (strength == 1 and 2 * passing > size and not remarks))
    return [b for b in blocks if kept[b.chain]]


def titled_root(blocks: list[Block]) -> int:
    """The page's one article or main element, if it alone holds the h1 and some text."""
    titles = {b.root for b in blocks if b.step == "h1"}
    if len(titles) != 1 or titles == {0} or len({b.root for b in blocks if b.root}) != 1:
        return 0
    root = titles.pop()
    return root if any(b.root == root and b.step not in HEADINGS and not b.linked for b in blocks) else 0


def content(blocks: list[Block], page: Page) -> list[Block]:
    """Blocks whose path's ratio reaches the threshold, with the headings and
    short blocks between and beside them (blocks of links: in the same element)."""
    if root := titled_root(blocks):
        blocks = [b for b in blocks if b.root == root]
    ratio = path_ratios(blocks)
    least = threshold(blocks, ratio)
    weight = [ratio[b.node] * len(b.text) for b in blocks]
    if 2 * sum(w for w, b in zip(weight, blocks, strict=True) if b.root) > sum(weight):
        blocks = [b for b in blocks if b.root]
    plain = [ratio[b.node] >= least and not b.linked for b in blocks]
    passing = plain if any(plain) else [ratio[b.node] >= least for b in blocks]  # else a page of links
    if not any(passing):
        return []
    first, last = passing.index(True), len(passing) - 1 - passing[::-1].index(True)
    around, parents = set(), set()
    for b, yes in zip(blocks, passing, strict=True):
        if yes:
            parents.add(b.container)
            at = b.element
            while at and at not in around:
                around.add(at)
                at = page.above[at]
    around = {e for e in around if page.tag[e] not in ("html", "body")}

    def kept(at: int, b: Block) -> bool:
        heading = b.step in HEADINGS
        if passing[at] or b.container in parents or (heading and at < last):
            return True
        return (heading or not b.linked) and (first < at < last or b.container in around)

    return [b for at, b in enumerate(blocks) if kept(at, b)]


def main_text(source: str | None) -> str:
    lines: dict[int, list[str]] = {}
    page = Page(source or "")
    for b in content(without_suspects(page), page):
        lines.setdefault(b.line, []).append(b.raw)
    return "\n".join(" ".join("".join(raws).split()) for raws in lines.values())


def extract(df: DataFrame, source: str = "html", target: str = "text") -> DataFrame:
    """``df`` without ``source``, with the main text of each page."""
    plain = df.select(*(f"`{c}`" for c in df.columns if c.lower() != target.lower() or c == source))
    kept = [f for f in plain.schema.fields if f.name != source]
    out = T.StructType([*kept, T.StructField(target, T.StringType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = {n: i for i, n in enumerate(batch.schema.names)}
        made = pa.array([main_text(x) for x in batch.column(at[source]).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([*(batch.column(at[f.name]) for f in kept), made], [f.name for f in out.fields])

    return plain.mapInArrow(by_batch(run), out)
