"""Main text of web pages by tag-path ratios.

The text of a page is cut into blocks, each with its root-to-leaf tag path. Per path the text
length, the punctuation and the share of link text are added up over its blocks. Length per
block and punctuation per block are fused into one ratio, which is smoothed along the page and
compared with a multiple of its spread. Paths above the threshold are content. The page's
<article> is the article if it holds most of their text, else the innermost element that holds
all of it. Its remaining blocks (headings, short paragraphs, list items) stay, but for paths below the
threshold with several blocks that together are mostly links; without an <article>, those before
the first and after the last block of content stay unless they are mostly links.

Paths that the page itself marks as navigation, notices, adverts, forms, comments and the like
have ratio zero. Marks are whole names in class, id or role, or names made of mark words and words
of place; those of headings and paragraphs only whole words. They do not mark an element that wraps the page's <main>,
or its only <article>, or nearly all text that is not marked otherwise.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import map_texts

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
# A start tag of the key ends an open element of the value, up to the enclosing scope.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("td", "th", "tr", "thead", "tbody"),
    "tfoot": ("td", "th", "tr", "tbody"), "body": ("head",),
}
SCOPE = frozenset("table td th ul ol dl caption button object template article section div body html".split())
# Elements whose text is not the article, and words that mark such elements in class, id or role.
OUTSIDE = frozenset(
    "nav footer aside form button select textarea script style noscript template svg iframe dialog "
    "menu head title object canvas audio video map math datalist".split()
)
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored promo promotion "
    "banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments respond "
    "disqus reply replies cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations widget widgets toolbar pagination pager copyright legal disclaimer masthead "
    "complementary contentinfo search hidden skip topbar rail teaser".split()
)
# Words beside a mark word in a name made of several ("site-footer", "comment-list"); a name with
# any other word ("overflow-hidden", "no-sidebar", "legal-status") marks nothing.
PLACES = frozenset(
    "site page main global primary secondary top bottom left right upper lower inner outer fixed sticky "
    "box bar block list area section wrapper wrap container content panel unit slot strip row column item "
    "items group links link buttons button form field input post posts article articles thread js the".split()
)
# These mark page furniture only outside the article: an article may have a header of its own.
TOP_MARKS = frozenset(["header"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd pre blockquote figcaption caption summary".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PUNCT = re.compile(r"[,.;:!?…、。，！？؟،]")


@dataclass
class _Element:
    tag: str
    parent: int
    path: int
    outside: bool
    article: bool
    hard: bool = False  # outside by its tag or because it is hidden,
    soft: bool = False  # by a mark word of its own
    mass: float = 0.0


@dataclass
class _Block:
    path: int
    owner: int
    tag: str
    outside: bool
    parts: list[str] = field(default_factory=list)
    link: int = 0
    text: str = ""


class _Page:
    """Elements, paths and blocks of one page, found in one pass over its tags."""

    def __init__(self, wrappers: frozenset[int] = frozenset()) -> None:
        self.wrappers = wrappers  # elements whose mark words say nothing
        self.elements = [_Element("", -1, 0, False, False)]
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[_Block] = []
        self.open = [0]  # elements from the root down
        self.count: dict[str, int] = {}  # open elements by tag
        self.leaf: list[int] = [0]  # the block-level element at each depth
        self.links = 0
        self.scopes: list[int] = []  # depths of open scope elements
        self.current: _Block | None = None

    def text(self, raw: str) -> None:
        here = self.elements[self.open[-1]]
        if here.outside and here.tag in OUTSIDE:
            return
        if self.current is None:
            owner = self.leaf[-1]
            e = self.elements[owner]
            self.current = _Block(e.path, owner, e.tag, e.outside)
            self.blocks.append(self.current)
        said = html.unescape(raw) if "&" in raw else raw
        if here.outside and not self.current.outside:
            return  # an advert or button inside a paragraph
        self.current.parts.append(said)
        if self.links:
            self.current.link += len(said.strip())

    def _pop(self) -> None:
        e = self.elements[self.open.pop()]
        self.leaf.pop()
        self.count[e.tag] -= 1
        if self.scopes and self.scopes[-1] == len(self.open):
            self.scopes.pop()
        if e.tag == "a":
            self.links -= 1
        if e.tag in BLOCK:
            self.current = None

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self._pop()

    def _end_open(self, tags: tuple[str, ...]) -> None:
        """Close the outermost open element among ``tags`` inside the innermost other scope."""
        if not any(self.count.get(t) for t in tags):
            return
        depth, found = len(self.open) - 1, 0
        while depth > 0:
            tag = self.elements[self.open[depth]].tag
            if tag in tags:
                found = depth
            elif tag in SCOPE:
                break
            depth -= 1
        if found:
            self._close_to(found)

    def start(self, tag: str, attrs: str) -> None:
        if tag in BLOCK:
            self.current = None
            if tag in ENDS:
                self._end_open(ENDS[tag])
            if self.count.get("p"):
                self._end_open(("p",))
        if tag == "br":
            self.text(" ")
        if tag in VOID:
            return
        up = self.elements[self.open[-1]]
        label, hard, soft = _label(tag, attrs, up.article)
        soft = soft and len(self.elements) not in self.wrappers
        marked = hard or soft
        path = self.paths.setdefault((up.path, label), len(self.paths) + 1)
        article = not marked and (up.article or tag in ("article", "main"))
        self.elements.append(_Element(tag, self.open[-1], path, up.outside or marked, article, hard, soft))
        me = len(self.elements) - 1
        if tag in SCOPE:
            self.scopes.append(len(self.open))
        self.open.append(me)
        self.leaf.append(me if tag in BLOCK else self.leaf[-1])
        self.count[tag] = self.count.get(tag, 0) + 1
        if tag == "a":
            self.links += 1

    def end(self, tag: str) -> None:
        if tag in BLOCK:
            self.current = None
        if tag == "br":
            self.text(" ")
        if tag in ("html", "body") or not self.count.get(tag):
            return
        inline = tag not in BLOCK
        depth = len(self.open) - 1
        while self.elements[self.open[depth]].tag != tag:
            if inline and self.scopes and self.scopes[-1] == depth:
                return  # an inline end tag does not leave its block
            depth -= 1
        self._close_to(depth)


def _is_mark(name: str, marks: frozenset[str]) -> bool:
    """Whether a name of a class, id or role is a mark word, or made of mark words and places only."""
    if name.lower() in marks:
        return True
    words = {w.lower() for w in _WORDS.findall(name) if len(w) > 1}
    return bool(words & marks) and words <= marks | PLACES


def _label(tag: str, attrs: str, in_article: bool) -> tuple[str, bool, bool]:
    """Step of the path for a start tag, and whether its tag or state, or a name marks it as outside.

    Ids of headings are anchors and say nothing; a paragraph or heading is marked by a whole mark
    word only. Of repeated attributes the first counts.
    """
    soft = False
    marked = tag in OUTSIDE or (tag == "header" and not in_article)
    label = tag
    if not attrs:
        return label, marked, soft
    marks = MARKS if in_article else MARKS | TOP_MARKS
    seen = set()
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name in seen:
            continue
        seen.add(name)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            marked = True
        elif name == "style":
            marked |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name in ("class", "id", "role"):
            if name == "class":
                label = f"{tag}.{value}"
            if tag in ("html", "body"):
                continue
            for token in value.split():
                if tag == "p" or tag in HEADINGS:
                    soft |= name != "id" and token.lower() in marks
                else:
                    soft |= _is_mark(token, marks)
    return label, marked, soft


def _parse(page: str, wrappers: frozenset[int] = frozenset()) -> _Page:
    made = _Page(wrappers)
    i, n = 0, len(page)
    while i < n:
        at = page.find("<", i)
        if at < 0:
            made.text(page[i:])
            break
        if at > i:
            made.text(page[i:at])
        after = page[at + 1 : at + 2]
        if after == "!":
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                i = n if end < 0 else end + 3
            elif page.startswith("<![CDATA[", at):
                end = page.find("]]>", at + 9)
                i = n if end < 0 else end + 3
            else:
                end = page.find(">", at)
                i = n if end < 0 else end + 1
        elif after == "?":
            end = page.find(">", at)
            i = n if end < 0 else end + 1
        elif after.isascii() and after.isalpha() or after == "/":
            m = _TAG.match(page, at) or _LOOSE.match(page, at)
            if m is None:
                if after == "/" and not page[at + 2 : at + 3].isalpha():
                    end = page.find(">", at)  # </> and the like are comments
                    i = n if end < 0 else end + 1
                    continue
                break  # the page ends inside a tag
            i = m.end()
            tag = m[2].lower()
            if m[1]:
                made.end(tag)
                continue
            made.start(tag, m[3])
            if tag in RAW:
                close = re.compile(f"</{re.escape(tag)}", re.I).search(page, i)
                stop = n if close is None else close.start()
                made.text(page[i:stop])
                i = stop
        else:
            made.text("<")
            i = at + 1
    for b in made.blocks:
        b.text = " ".join("".join(b.parts).split())
    return made


def _wrappers(tree: _Page) -> frozenset[int]:
    """Elements with a mark word that hold the page's content all the same.

    These hold every <main>, or the only <article> and half of the text, or half of the text with
    next to none unmarked beside it. What a marked element holds counts only once no element
    around it is marked, so comments in a wrapper stay marked.
    """
    elements = tree.elements
    if not any(e.soft for e in elements):
        return frozenset()
    near, hidden = [0] * len(elements), [False] * len(elements)
    for i, e in enumerate(elements[1:], 1):
        near[i] = i if e.hard or e.soft else near[e.parent]
        hidden[i] = e.hard or hidden[e.parent]
    mass, free = [0] * len(elements), [0] * len(elements)
    for b in tree.blocks:
        if not hidden[b.owner]:
            prose = max(len(b.text) - b.link, 0)
            mass[b.owner] += prose
            free[near[b.owner]] += prose
    mains, articles = ([i for i, e in enumerate(elements) if e.tag == t and not hidden[i]] for t in ("main", "article"))
    anchors = mains or articles
    holds = [0] * len(elements)
    for i in anchors:
        holds[i] = 1
    for i in range(len(elements) - 1, 0, -1):
        mass[elements[i].parent] += mass[i]
        holds[elements[i].parent] += holds[i]
    found: set[int] = set()
    unmarked = free[0]
    for i, e in enumerate(elements):
        outer = near[e.parent] if i else 0
        if not e.soft or hidden[i] or outer and outer not in found:
            continue
        most = 2 * mass[i] >= mass[0] and mass[i]
        whole = bool(anchors) and holds[i] == len(anchors)
        if whole and (mains or most and len(articles) == 1) or most and 10 * unmarked < mass[i]:
            found.add(i)
            unmarked += free[i]
    return frozenset(found)


def _smooth(values: list[float]) -> list[float]:
    """Weights 1, 2, 1 over neighbouring blocks."""
    n = len(values)
    return [
        (values[max(i - 1, 0)] + 2 * values[i] + values[min(i + 1, n - 1)]) / 4 for i in range(n)
    ]


def _path_totals(blocks: list[_Block]) -> dict[int, list[int]]:
    """Of each path: code points, punctuation, code points in links, and blocks."""
    totals: dict[int, list[int]] = {}
    for b in blocks:
        t = totals.setdefault(b.path, [0, 0, 0, 0])
        t[0] += len(b.text)
        t[1] += len(_PUNCT.findall(b.text))
        t[2] += min(b.link, len(b.text))
        t[3] += 1
    return totals


def _ratio(chars: int, puncts: int, link: int, n: int) -> float:
    """Length a block, fused with punctuation a block and the share of text that is no link."""
    return chars / n * (1 + puncts / n) * (1 - link / chars) ** 2


def main_text(page: str | None, spread: float = 0.5, share: float = 0.6, links: float = 0.5) -> str:
    """The article of one page: blocks in page order, joined by one newline.

    ``spread`` times the standard deviation of the smoothed ratios is the threshold; the article
    is the <article> with ``share`` of the content's text, or else the innermost element with all of
    it, whose beginning and end are its first and last block that are not more than ``links`` of
    their text in links, or content.
    """
    if not page:
        return ""
    tree = _parse(page)
    if wrappers := _wrappers(tree):
        tree = _parse(page, wrappers)
    blocks = [b for b in tree.blocks if b.text and not b.outside]
    if not blocks:
        return ""
    totals = _path_totals(blocks)
    ratio = {path: _ratio(*total) for path, total in totals.items()}
    smooth = _smooth([ratio[b.path] for b in blocks])
    mean = sum(smooth) / len(smooth)
    sigma = math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
    limit = min(spread * sigma, max(ratio.values()))
    content = {path for path, r in ratio.items() if r >= limit and r > 0}
    elements = tree.elements
    for b in blocks:
        if b.path in content:
            elements[b.owner].mass += len(b.text)
    children: dict[int, list[int]] = {}
    for i in range(len(elements) - 1, 0, -1):
        elements[elements[i].parent].mass += elements[i].mass
        if elements[i].mass and elements[i].tag not in LEAF:
            children.setdefault(elements[i].parent, []).append(i)
    root = 0
    whole = elements[0].mass
    while elements[root].tag != "article":
        best = max(children.get(root, []), key=lambda i: elements[i].mass, default=-1)
        if best < 0 or elements[best].tag not in BLOCK:
            break
        if elements[best].mass < whole:
            break
        root = best
    main = max((i for i, e in enumerate(elements) if e.tag == "article" and e.mass), key=lambda i: elements[i].mass, default=-1)
    if main >= 0 and elements[main].mass >= share * whole:
        root = main
    inside = [False] * len(elements)
    inside[root] = True
    for i in range(root + 1, len(elements)):
        inside[i] = inside[elements[i].parent]
    own = [b for b in blocks if inside[b.owner]]
    if elements[root].tag == "article":
        # lists of links: paths below the threshold whose text, taken together, is mostly links
        listed = {
            path
            for path, (chars, _, link, n) in totals.items()
            if n > 1 and path not in content and link > links * chars
        }
        kept = [b.text for b in own if b.path not in listed or b.tag in HEADINGS]
    else:
        at = [i for i, b in enumerate(own) if b.path in content] or [len(own)]
        kept = [
            b.text
            for i, b in enumerate(own)
            if at[0] <= i <= at[-1] or b.link <= links * len(b.text)
        ]
    if not any(inside[b.owner] and b.tag == "h1" for b in blocks):
        title = [b.text for b in blocks if b.tag == "h1" and b.owner < root]
        kept = title[-1:] + kept
    return "\n".join(kept)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with columns page_id, url, text, n_chars; one row per input row.

    Null and empty pages, and pages without an article, have the empty text. Repeated rows and
    null ids come out as they are; further columns are left out; an empty table gives an empty
    one. A page is read once from its beginning to its end, however long. Nothing is shuffled.
    """
    rows = pages.select(
        F.struct(pages["page_id"], pages["url"]).alias("page"),
        F.coalesce(pages[html_column].cast("string"), F.lit("")).alias("text"),
    )
    made = map_texts(rows, "text string", lambda _, htmls: {"text": [main_text(h) for h in htmls]}, "text")
    return made.select("page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars"))
