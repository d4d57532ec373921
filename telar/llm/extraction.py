"""Main text of web pages by tag-path ratios.

A page is cut into text nodes with their paths from the root (tag names with
class and role; below 512 levels the path stays as it is). Per distinct path the
text length and the punctuation are summed and divided by its nodes; the two
ratios are fused (length times one plus punctuation), smoothed over paths by a
Gaussian of their distance in the tree (to six steps, beyond which it weighs less
than a ten-thousandth), and a path is chosen if its smoothed ratio is at least
``THRESHOLD`` of the page's largest. The chosen paths choose the content: all
candidates beneath their article or main element; without one, those beneath
their parents and their common ancestor, except subtrees of these that are mostly
links. Where the page has an article or main element, paths outside it count for
a tenth, and so do, elsewhere, paths through an element with a name of ``DOUBTFUL``.

Ratios cannot tell a reader's comment or a notice from an article, so names say
which elements are of the kinds that no text is wanted from (navigation, header,
footer, aside, form, advert, notice, comment ...): these are noise and no
candidates. A class that tells a state (has-sidebar, comments-open) names
nothing, and main elements and what they stand in are never noise. Where noise
leaves less than a fifth of the text, and none in an article or main element,
the articles under least noise and what they stand in are no noise either; in
pages without, the text under least noise stays.

Every step is linear in the page's length: sums go up the tree of paths once.

Defined cases: null, empty and markup-free html (its text is then the content)
never fail; unclosed and crossed tags are closed at the next block or parent;
unclosed comments, scripts and styles reach to the end of the page, as in
browsers; other unclosed elements without markup inside (title, textarea ...)
to the next tag, and drawings and formulas to the next block; a tag whose quotes
do not end is one up to the next ``>``; null and repeated page ids keep their
rows; extra columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

THRESHOLD = 0.2
SIGMA = 1.0

NEAR = 6
DEEPEST = 512
OUTSIDE = 0.1

_TEXT = re.compile(r"[^<]+")
_OTHER = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAME = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：¿¡\"“”„«»()'’]")
_SPACES = re.compile(r"\s+")

# Elements of HTML by how they are treated.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
TO_THE_END = {"script", "style"}
DRAWN = {"svg", "math"}
ENDS_DRAWN = {"address", "article", "aside", "blockquote", "body", "div", "dl", "dd", "dt", "figure", "footer", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
NOT_CONTENT = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "object", "audio", "video", "canvas", "label", "fieldset"}
MAIN = {"article", "main"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Words of class, id and role that name something else than content, and words that only say where or how such a thing stands.
NOISE = set(
    "ad ads adv advert adverts advertisement advertisements advertising adslot banner banners sponsor sponsored sponsors promo promos promotion promotions cookie cookies consent gdpr notice notices popup popups modal overlay "
    "newsletter newsletters subscribe subscription subscriptions share sharing social nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars widget related recommend recommended recommendations "
    "comment comments commentlist disqus replies respond footer masthead topbar toolbar login signup contentinfo complementary form".split()
)
PLACES = set(
    "left right top bottom upper lower first second main site page primary secondary global inner outer wide sticky fixed area areas bar bars box boxes list lists item items block blocks section wrap wrapper container content panel column col row "
    "slot unit link links button buttons icon icons post posts article articles story stories news thread count reply header title text message policy eu mobile desktop small large new".split()
)
DOUBTFUL = re.compile(r"(?:^|[\s_-])(?:side|rail|foot|search\w*|skip|copyright|legal)(?:$|[\s_-])", re.I)
_STATE = re.compile(r"(?:has|have|no|not|with|without|hide|show)[_-].*|.*[_-](?:open|opened|closed|enabled|disabled|active|inactive|on|off|none|visible|hidden|layout)", re.I)
_HEADERLIKE = re.compile(r"(?:^|\s)(?:site|page|global|top)[_-]?header(?:$|\s)|(?:^|\s)header(?:$|\s)", re.I)


class Element(NamedTuple):
    parent: int
    path: int
    noise: bool
    apart: bool  # in an element that stands apart from any content
    main: bool
    article: bool
    top: int  # path of the innermost main element or article, -1 without


class Paths:
    """The tree of distinct paths; a path is the number of its node, and follows its parent. Number 0 is the root."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, str], int] = {}
        self.parent, self.tag, self.depth, self.linked, self.doubtful = [-1], [""], [0], [False], [False]

    def below(self, parent: int, tag: str, name: str, doubtful: bool) -> int:
        if self.depth[parent] >= DEEPEST:
            return parent
        if (at := self.known.get((parent, name))) is None:
            at = self.known[parent, name] = len(self.parent)
            self.parent.append(parent)
            self.tag.append(tag)
            self.depth.append(self.depth[parent] + 1)
            self.linked.append(tag == "a" or self.linked[parent])
            self.doubtful.append(doubtful or self.doubtful[parent])
        return at

    def sums_up(self, own: list) -> list:
        """Of each path, the sum of what it and the paths beneath it have."""
        out = list(own)
        for p in range(len(out) - 1, 0, -1):
            out[self.parent[p]] += out[p]
        return out

    def beneath(self, tops: set[int]) -> list[bool]:
        """Of each path, whether it is one of the tops or beneath one."""
        out: list[bool] = []
        for p, up in enumerate(self.parent):
            out.append(p in tops or up >= 0 and out[up])
        return out


def noisy(label: str) -> bool:
    """Whether a class, id or role names something else than content.

    A token does if all its parts are known, one at least as noise: ``related-posts`` does, ``related-work``
    does not, nor does a word that only begins alike. Tokens that tell a state (``has-sidebar``) do not.
    """
    for token in label.lower().split():
        parts = [p for p in re.split(r"[-_]+|\d+", token) if p]
        if not NOISE.isdisjoint(parts) and all(p in NOISE or p in PLACES for p in parts) and not _STATE.fullmatch(token):
            return True
    return False


class Text(NamedTuple):
    element: int  # -1 for none
    text: str
    block: int
    br: bool


class Page:
    """The text nodes of a page with their elements, and the tree of their paths."""

    def __init__(self, html: str):
        self.paths, self.elements, self.texts = Paths(), [], []
        self.stack: list[tuple[str, int]] = []  # tag, element
        self.places: dict[str, list[int]] = defaultdict(list)  # of open tags, in the stack
        self.blocks: list[int] = []  # of open block elements
        self._read(html)
        self.allowed = self._judged()

    def _push(self, tag: str, element: int) -> None:
        self.places[tag].append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, element))

    def _pop(self) -> str:
        tag, _ = self.stack.pop()
        self.places[tag].pop()
        if tag not in INLINE:
            self.blocks.pop()
        return tag

    def _cut(self, n: int) -> None:
        while len(self.stack) > n:
            self._pop()

    def _text(self, text: str, block: int, br: bool = False) -> None:
        self.texts.append(Text(self.stack[-1][1] if self.stack else -1, text, block, br))

    def _read(self, html: str) -> None:
        block, at, size, last, tag_at = 0, 0, len(html), html.rfind(">"), _TAG
        never: set[str] = set()  # raw elements that no end tag follows
        while at < size:
            if html[at] != "<":
                m = _TEXT.match(html, at)
                at = m.end()
                text = m[0]
                self._text(entities.unescape(text) if "&" in text else text, block)
                continue
            if at > last and not html.startswith("<!--", at):  # no tag ends any more
                self._text(entities.unescape(html[at:]), block)
                return
            if html[at + 1 : at + 2] in ("!", "?") and (m := _OTHER.match(html, at)):
                at = m.end()
                continue
            m = tag_at.match(html, at)
            if m is None and (m := _LOOSE_TAG.match(html, at)):
                tag_at = _LOOSE_TAG  # quotes that never end: no tag after this one can be told by its quotes
            if m is None:
                self._text("<", block)
                at += 1
                continue
            at = m.end()
            closing, tag, attrs = m[1], m[2].lower(), m[3]
            if tag not in INLINE:
                block += 1
            if closing:
                self._close(tag)
            elif tag == "br":
                self._text(" ", block, True)
            elif tag in RAW:
                if attrs.rstrip().endswith("/"):
                    continue
                end = None if tag in never else re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                if end:
                    at = end.end()
                    continue
                never.add(tag)
                if tag in TO_THE_END:
                    return
                if tag not in ("noscript", "template"):
                    at = size if (i := html.find("<", at)) < 0 else i
            elif tag not in VOID:
                self._open(tag, attrs)

    def _close(self, tag: str) -> None:
        if not self.places[tag]:
            return
        at = self.places[tag][-1]
        if tag not in INLINE or not self.blocks or at > self.blocks[-1]:  # an inline end tag does not reach beyond its block
            self._cut(at)

    def _open(self, tag: str, attrs: str) -> None:
        stack = self.stack
        if tag in ENDS_DRAWN:
            for drawn in DRAWN:
                if self.places[drawn]:
                    self._cut(self.places[drawn][0])
        if tag not in INLINE:
            while stack and (stack[-1][0] in INLINE or stack[-1][0] == "p"):
                self._pop()
            while stack and stack[-1][0] in CLOSES.get(tag, ()):
                self._pop()
        named = {k.lower(): a or b or c for k, a, b, c in _NAME.findall(attrs)} if attrs.strip() else {}
        label = " ".join(named.get(k, "") for k in ("class", "id", "role")).strip()
        role, parent = named.get("role"), stack[-1][1] if stack else -1
        up = self.elements[parent] if parent >= 0 else None
        main = tag == "main" or role == "main" or named.get("id") in ("content", "main")
        inside = up is not None and up.top >= 0
        own_header = tag == "header" and inside
        outer = tag in ("html", "body")
        soft = not outer and (noisy(label) or not own_header and bool(_HEADERLIKE.search(label)))
        hard = (tag in NOT_CONTENT and not own_header) or tag in DRAWN or "hidden" in named or named.get("aria-hidden") == "true"
        kind = " ".join(named.get(k, "") for k in ("class", "role")).strip()
        path = self.paths.below(up.path if up else 0, tag, f"{tag}.{kind}{'*' if main else ''}", not outer and bool(DOUBTFUL.search(label)))
        apart = (hard and tag not in ("form", "fieldset", "label", "object")) or up is not None and up.apart
        self.elements.append(Element(parent, path, soft or hard, apart, main, tag == "article", path if main or tag in MAIN else up.top if inside else -1))
        self._push(tag, len(self.elements) - 1)

    def _judged(self) -> list[bool]:
        """Of each text node, whether it may be content."""
        elements = self.elements
        own = [e.noise for e in elements]
        spared: set[int] = set()

        def spare(i: int) -> None:
            while i >= 0 and i not in spared:
                own[i] = False
                spared.add(i)
                i = elements[i].parent

        def counts() -> list[int]:
            out: list[int] = []
            for e, noise in zip(elements, own, strict=True):
                out.append(noise + (out[e.parent] if e.parent >= 0 else 0))
            return [*out, 0]  # the last for text without an element

        for i, e in enumerate(elements):
            if e.main:
                spare(i)
        noise, level = counts(), 0
        seen: dict[int, int] = defaultdict(int)  # by noise, the characters
        free_main = False
        for i, text, _, br in self.texts:
            if not br and (n := len(text.strip())) and not (i >= 0 and elements[i].apart and noise[i]):
                seen[noise[i]] += n
                free_main |= i >= 0 and elements[i].top >= 0 and not noise[i]
        if 5 * seen.get(0, 0) < (total := sum(seen.values())) and not free_main:
            articles = [i for i, e in enumerate(elements) if e.article and not e.apart]
            if articles:
                least = min(noise[i] for i in articles)
                for i in [i for i in articles if noise[i] == least]:
                    spare(i)
                noise = counts()
            else:
                got = 0
                for level in sorted(seen):
                    got += seen[level]
                    if 5 * got >= total:
                        break
        return [not br and noise[i] <= level and not (noise[i] and i >= 0 and elements[i].apart) for i, _, _, br in self.texts]

    def path(self, element: int) -> int:
        return self.elements[element].path if element >= 0 else 0

    def top(self, element: int) -> int:
        return self.elements[element].top if element >= 0 else -1


def smoothed(paths: Paths, value: dict[int, float], sigma: float) -> dict[int, float]:
    """The means of the values of paths, weighted by a Gaussian of the distance in the tree."""
    n = len(paths.parent)
    total = [[0.0] * (NEAR + 1) for _ in range(n)]  # of the paths so many levels beneath
    count = [[0] * (NEAR + 1) for _ in range(n)]
    for p, v in value.items():
        total[p][0], count[p][0] = v, 1
    for p in range(n - 1, 0, -1):
        up = paths.parent[p]
        if count[p].count(0) <= NEAR:  # else nothing to add
            for d in range(NEAR):
                total[up][d + 1] += total[p][d]
                count[up][d + 1] += count[p][d]
    weight = [math.exp(-(d**2) / (2 * sigma**2)) for d in range(NEAR + 1)]
    out = {}
    for p in value:
        s = sum(w * x for w, x in zip(weight, total[p], strict=True))
        k = sum(w * x for w, x in zip(weight, count[p], strict=True))
        child, at = p, paths.parent[p]
        for up in range(1, NEAR + 1):
            if at < 0:
                break
            for d in range(up, NEAR + 1):  # beneath this one, but not beneath the one we came from
                less = d - up - 1
                s += weight[d] * (total[at][d - up] - (total[child][less] if less >= 0 else 0))
                k += weight[d] * (count[at][d - up] - (count[child][less] if less >= 0 else 0))
            child, at = at, paths.parent[at]
        out[p] = s / k
    return out


def ratios(page: Page, sigma: float = SIGMA) -> tuple[dict[int, float], dict[int, int], dict[int, int]]:
    """Of each candidate path: the smoothed fused ratio, the text length, and the path of its main element or -1."""
    length, marks, count, top = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for may, (element, text, _, _) in zip(page.allowed, page.texts, strict=True):
        if may and (t := text.strip()):
            p = page.path(element)
            length[p] += len(t)
            marks[p] += len(_PUNCTUATION.findall(t))
            count[p] += 1
            top[p] = page.top(element)
    fused = {p: length[p] / n * (1 + marks[p] / n) for p, n in count.items()}
    has_main = any(t >= 0 for t in top.values())
    for p in fused:
        if top[p] < 0 and (has_main or page.paths.doubtful[p]):
            fused[p] *= OUTSIDE
    inside, outside = ({p: v for p, v in fused.items() if (top[p] >= 0) == side} for side in (True, False))
    return smoothed(page.paths, inside, sigma) | smoothed(page.paths, outside, sigma), length, top


def content(page: Page, threshold: float = THRESHOLD, sigma: float = SIGMA) -> set[int]:
    """The paths of the content."""
    smooth, length, top = ratios(page, sigma)
    if not smooth:
        return set()
    paths, least = page.paths, threshold * max(smooth.values())
    on = {p for p, v in smooth.items() if v >= least}
    if any(t >= 0 for t in top.values()):
        inside = paths.beneath({top[p] for p in on if top[p] >= 0})
        return on | {p for p in smooth if inside[p]}
    tops = set()
    for p in on:  # the parent of the innermost block
        while p and paths.tag[p] in INLINE:
            p = paths.parent[p]
        tops.add(paths.parent[p] if p else 0)
    n = len(paths.parent)
    chosen = paths.sums_up([p in on for p in range(n)])
    tops.add(max((p for p in range(n) if chosen[p] == len(on)), key=lambda p: paths.depth[p]))
    own = [length.get(p, 0) for p in range(n)]
    total, linked = paths.sums_up(own), paths.sums_up([x * a for x, a in zip(own, paths.linked, strict=True)])
    kept = paths.beneath({p for p in range(1, n) if paths.parent[p] in tops and 2 * linked[p] < total[p]})
    return on | {p for p in smooth if kept[p] or p in tops and not paths.linked[p]}


def extract(html: str | None, threshold: float = THRESHOLD, sigma: float = SIGMA) -> str:
    page = Page(html or "")
    on = content(page, threshold, sigma)
    blocks: dict[int, list[str]] = {}
    for may, (element, text, block, br) in zip(page.allowed, page.texts, strict=True):
        if may and page.path(element) in on or br and block in blocks:
            blocks.setdefault(block, []).append(text)
    lines = (_SPACES.sub(" ", "".join(b)).strip() for b in blocks.values())
    return "\n".join(x for x in lines if x)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = [extract(x) for x in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return map_batches(rows, run, "page_id long, url string, text string, n_chars long")
