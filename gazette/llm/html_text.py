"""Main text of web pages by tree scoring.

A page becomes a tree of elements, held as arrays in document order, and a list of text blocks.
Frames, forms and scripts go by tag, menus, notices, adverts and reader comments by role or by the
words of class and id. Each block passes points for its length and commas to the elements around
it, half as many to the next one out, and so on; an element's sum is discounted by the share of
its characters that are link text. The best container is kept, with those of its siblings that
carry headings, prose or enough points of their own.

Defined results: null, empty and textless pages give an empty text. Markup that is cut off or
badly nested is read as far as it goes: an unfinished tag at the end is no text, an element that
is never closed ends with its parent, an unfinished script or comment swallows the rest. Equal
scores go to the element that begins first. Pages that repeat give equal rows; a null url stays
null; columns other than page_id, url and html don't matter. A page of any length is one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, BATCH_DEFAULT, BATCH_SETTING

#: The parts of HTML that the tree needs.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html tr td th tbody thead tfoot caption legend".split())
IN_HEAD = frozenset("title meta link script style base noscript template head html".split())
#: An element that opens ends the open ones of these tags, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "tr"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Where a reader finds no text of the article.
GONE = frozenset("nav footer aside script style noscript iframe svg button select option textarea template dialog menu object video audio canvas head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist".split())
#: Words of class and id that tell what an element is; a trailing * stands for any ending. FRAME words don't count beside an ARTICLE word.
#: What LOOSE and FRAME words name may also be a box around everything, as in "has-sidebar".
STRICT = (
    "comment comments commentlist commenting commenter disqus* respond* reply replies discussion* ad ads adv adbox adslot adunit adwrap advert* adsense adsby* sponsor* promo* cookie* consent* gdpr notice notices newsletter* subscri* signup* paywall* aside menu menus nav navbar* navigation navlinks breadcrumb* "
    "related* recommend* share* sharing social feedback* login* pagination pager paging tagcloud outbrain taboola teaser* announcement*"
)
LOOSE = "sidebar* sidecolumn rail widget* topbar* toolbar* popup* modal* overlay*"
FRAME = "header head masthead banner* alert* footer foot search* skip* tags toc print* legal copyright disclaimer*"
ARTICLE = frozenset("article content main body entry post story text".split())
PROSE = frozenset("p pre blockquote".split())
CONTAINERS = frozenset("article main section div td body html blockquote center dd form fieldset figure li ul ol dl table tbody tr details".split())
WEIGHTS = {"article": 25.0, "main": 15.0, "section": 5.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "dd": -3.0, "li": -3.0, "form": -3.0}
LEVELS = 5
#: Elements nested deeper hang at this depth, beside each other, as browsers do it. No text is lost.
DEEPEST = 512

_COMMAS = re.compile("[,，、،;]")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<!--|<[!?/][^>]*+>""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.IGNORECASE) for t in RAW}


def _one_of(words: str) -> re.Pattern:
    return re.compile("(?:" + "|".join(w[:-1] + ".*" if w.endswith("*") else w for w in words.split()) + ")")


_STRICT, _LOOSE, _FRAME = _one_of(STRICT), _one_of(LOOSE), _one_of(FRAME)


def _tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): kind is "text", "open" or "close". A tag that the page's end cuts off is dropped."""
    whole = html.rfind(">") + 1
    tail = re.search(r"<[a-zA-Z/!?]", html[whole:])
    end = whole + tail.start() if tail else len(html)
    at = 0
    while at < end:
        m = _TAG.search(html, at, whole)
        if m is None:
            break
        if m.start() > at:
            yield "text", "", html[at : m.start()]
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if m[0] == "<!--":
                close = at - 2 if html.startswith((">", "->"), at) else html.find("-->", at)
                if close < 0:
                    return
                at = html.index(">", close) + 1
            continue
        name, closing, rest = name.lower(), bool(m[1] or m[4]), m[3] if m[2] else m[6]
        yield "close" if closing else "open", name, rest
        if name in RAW and not closing:
            stop = _END[name].search(html, at)
            if stop is None:
                return
            at = stop.end()
            yield "close", name, ""
    if at < end:
        yield "text", "", html[at:end]


class _Page:
    """Elements in document order, each with its parent and the end of its subtree, and blocks (element, text, link characters)."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.end, self.gone = ["html"], [-1], [0], [False]
        self.named = [""]  # what its name or role tells: "", "strict" or "loose"
        self.blocks: list[tuple[int, str, int]] = []
        self._open, self._text, self._links, self._in_link, self._muted = [0], [], [], 0, 0
        for kind, name, rest in _tokens(html):
            if kind == "text":
                self._said(rest)
            elif kind == "open":
                self._opened(name, rest)
            else:
                self._closed(name)
        self._block()
        self._pop(0)

    def _said(self, text: str) -> None:
        if self.tag[self._open[-1]] == "head" and text.strip():
            self._pop(len(self._open) - 1)
        if not self._muted:
            self._text.append(unescape(text) if "&" in text else text)
            if self._in_link:
                self._links.append(self._text[-1])

    def _block(self) -> None:
        """What has been gathered since the last boundary is a block of the innermost open element."""
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                owner = next(k for k in reversed(self._open) if self.tag[k] in BLOCK)
                self.blocks.append((owner, text, len(" ".join("".join(self._links).split()))))
            self._text, self._links = [], []

    def _ended(self, k: int) -> None:
        self.end[k] = len(self.tag)
        self._in_link -= self.tag[k] == "a"
        self._muted -= self.gone[k]

    def _pop(self, depth: int) -> None:
        for k in self._open[depth:]:
            self._ended(k)
        del self._open[depth:]

    def _found(self, tags, stop) -> int | None:
        """Depth of the outermost open element of these tags above the nearest one of stop."""
        out = None
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[depth]]
            if tag in stop:
                break
            if tag in tags:
                out = depth
        return out

    def _opened(self, name: str, rest: str) -> None:
        if self.tag[self._open[-1]] == "head" and name not in IN_HEAD:
            self._pop(len(self._open) - 1)
        if name in BLOCK or name == "hr":
            self._block()
        if name in VOID:
            if name == "br":
                self._text.append(" ")
            return
        if name in ("html", "body") and any(self.tag[k] == name for k in self._open):
            return
        ended, stop = ENDS.get(name, ((), ()))
        if name in CLOSES_P:
            ended, stop = {*ended, "p"}, {*stop, "td", "th", "table"}
        if ended and (depth := self._found(ended, stop)) is not None:
            self._pop(depth)
        if name == "a":
            self._closed("a")  # links don't nest
        if len(self._open) >= DEEPEST:
            self._pop(DEEPEST - 1)
        k = len(self.tag)
        self.tag.append(name)
        self.parent.append(self._open[-1])
        self.end.append(k + 1)
        named, hidden = self._told(name, rest) if rest and name not in ("html", "body") else ("", False)
        self.named.append(named or "loose" * (name == "form"))
        self.gone.append(hidden or name in GONE)
        self._open.append(k)
        self._in_link += name == "a"
        self._muted += self.gone[k]

    def _told(self, name: str, rest: str) -> tuple[str, bool]:
        """What class, id and role tell, and whether the element is hidden. Names count for blocks only."""
        named, hidden = "", False
        for m in _ATTRIBUTE.finditer(rest):
            which, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if which in ("class", "id") and name in BLOCK:
                for part in value.split():
                    words = [w.lower() for w in _WORDS.findall(part)]
                    if any(map(_STRICT.fullmatch, words)):
                        named = "strict"
                    elif not named and (any(map(_LOOSE.fullmatch, words)) or name not in ("article", "main") and ARTICLE.isdisjoint(words) and any(map(_FRAME.fullmatch, words))):
                        named = "loose"
            elif which == "role":
                named = named or "strict" * (value.strip().lower() in ROLES)
            else:
                hidden |= which == "hidden" or which == "aria-hidden" and value.lower() == "true" or which == "style" and _HIDDEN.search(value) is not None
        return named, hidden

    def _closed(self, name: str) -> None:
        if name in BLOCK:
            self._block()
        if name in ("html", "body"):
            return  # what comes after them still belongs to the body
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[depth]]
            if tag == name:
                if name == "a":  # a link may end inside of blocks that it began outside of
                    self._ended(self._open.pop(depth))
                else:
                    self._pop(depth)
                return
            if name not in BLOCK and name != "a" and tag in BLOCK or tag in ("td", "th") and name not in ("table", "tr", "tbody", "thead", "tfoot"):
                return


def _shares(page: _Page, dropped: list[bool]) -> tuple[list[int], list[int], list[int]]:
    """Characters, link characters and links of each element's kept text, children included."""
    n = len(page.tag)
    chars, links, anchors = [0] * n, [0] * n, [0] * n
    for owner, text, inside in page.blocks:
        if not dropped[owner]:
            chars[owner] += len(text)
            links[owner] += inside
    for k in range(n - 1, 0, -1):
        up = page.parent[k]
        anchors[k] += page.tag[k] == "a"
        for sums in (chars, links, anchors):
            sums[up] += sums[k]
    return chars, links, anchors


def _dropped(page: _Page) -> list[bool]:
    """Elements whose text isn't the article's. Nothing around the page's main article goes by its name; on pages without any, no loosely named element with most of the prose."""
    n = len(page.tag)
    gone, against = [False] * n, [False] * n
    for k in range(1, n):
        up = page.parent[k]
        gone[k] = page.gone[k] or gone[up]
        against[k] = bool(page.named[k]) and page.tag[k] != "form" or against[up]
    chars, links, _ = _shares(page, gone)
    articles = [k for k in range(1, n) if page.tag[k] in ("article", "main") and not gone[k] and not page.named[k] and chars[k] > links[k]]
    heart = max(articles, key=lambda k: (not against[k], page.tag[k] == "article", chars[k] - links[k], -k), default=0)
    marked = sum(page.tag[k] in ("article", "main") and not gone[k] for k in range(n))
    spared, up = set(), heart
    while up > 0:
        spared.add(up)
        up = page.parent[up]
    inside, out = [False] * n, [False] * n  # inside: of an article, where a header holds the headline
    for k in range(1, n):
        up = page.parent[k]
        inside[k] = inside[up] or page.tag[k] in ("article", "main")
        most = marked == 0 and page.named[k] != "strict" and 2 * (chars[k] - links[k]) > chars[0] - links[0]
        framed = page.named[k] or page.tag[k] == "header" and not inside[up]
        out[k] = out[up] or page.gone[k] or bool(framed) and k not in spared and not most
    return out


def _menus(page: _Page, dropped: list[bool]) -> None:
    """Lists and boxes that are mostly links go too, if they have three links or more."""
    chars, links, anchors = _shares(page, dropped)
    for k in range(1, len(page.tag)):
        mostly = page.tag[k] in ("ul", "ol", "div", "section", "table", "dl", "p", "center") and anchors[k] >= 3 and 2 * links[k] > chars[k]
        dropped[k] = dropped[k] or dropped[page.parent[k]] or mostly


def _scores(page: _Page, dropped: list[bool]) -> dict[int, float]:
    score: dict[int, float] = {}
    for owner, text, links in page.blocks:
        if dropped[owner]:
            continue
        points = len(_COMMAS.findall(text)) + min(len(text) / 100, 3.0) + (len(text) >= 25)
        if page.tag[owner] in HEADINGS:
            points *= 0.2
        points *= 1 - links / len(text)
        up, level = owner if page.tag[owner] in CONTAINERS else page.parent[owner], 0
        while up > 0 and level < LEVELS:
            if page.tag[up] in CONTAINERS:
                level += 1
                score[up] = score.get(up, WEIGHTS.get(page.tag[up], 0.0)) + points / (1 if level == 1 else 2 if level == 2 else 3 * level)
            up = page.parent[up]
        if not level:
            score[0] = score.get(0, 0.0) + points
    chars, links, _ = _shares(page, dropped)
    return {k: s * (1 - links[k] / chars[k]) if s > 0 and chars[k] else s for k, s in score.items()}


def main_text(html: str | None) -> str:
    """The article's blocks in page order, joined by two line feeds."""
    page = _Page(html or "")
    dropped = _dropped(page)
    _menus(page, dropped)
    score = _scores(page, dropped)
    if not score:
        return ""
    best = max(score, key=lambda k: (score[k], -k))
    up = best
    while up > 0:  # an explicit article is one text; outside of one, what most of the points stand in
        if page.tag[up] == "article" or page.tag[up] == "main" and page.tag[best] != "article":
            best = up
        up = page.parent[up]
    while page.tag[best] not in ("article", "main") and page.parent[best] > 0 and score.get(page.parent[best], 0.0) >= 0.75 * score.get(best, 0.0):
        best = page.parent[best]
    kept = _siblings(page, best, score, dropped) if best else {0}
    shown = [False] * len(page.tag)
    for k in range(len(page.tag)):
        shown[k] = not dropped[k] and (k in kept or k > 0 and shown[page.parent[k]])
    return "\n\n".join(text for owner, text, _ in page.blocks if shown[owner])


def _siblings(page: _Page, best: int, score: dict[int, float], dropped: list[bool]) -> set[int]:
    chars, links, _ = _shares(page, dropped)
    least = max(3.0, 0.1 * score.get(best, 0.0))
    kept = {best}
    up = page.parent[best]
    k = up + 1
    while k < (page.end[up] if up else len(page.tag)):
        tag, share = page.tag[k], links[k] / chars[k] if chars[k] else 1.0
        if not dropped[k] and k != best and chars[k]:
            heading = tag in HEADINGS and k < best
            prose = tag in PROSE and share < 0.25
            box = tag in CONTAINERS and tag not in ("article", "main") and page.tag[best] not in ("article", "main") and share < 0.25 and score.get(k, 0.0) >= least
            if heading or prose and page.tag[best] != "article" or box:
                kept.add(k)
        k = page.end[k]
    return kept


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its code points for every page."""
    conf = pages.sparkSession.conf
    if conf.get(BATCH_SETTING) == f"{BATCH_DEFAULT}b":
        conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")

    def run(batches):
        for batch in batches:
            found = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])

    whole = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))
    return whole.mapInArrow(run, "page_id long, url string, text string, n_chars long")
