"""Main text of web pages: flat text blocks, described by themselves and their neighbours, and a decision tree.

A page is read once from left to right, by the rules of HTML for tags and attributes, into blocks of text between
block-level tags. Each block has its words, its link density, what its surroundings are named and whether it speaks of
rights: with the words and link densities of the blocks before and after, a decision tree says which blocks are content.
The tree is grown from the small labelled table below.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortloom.llm.common import map_arrow, text_or_empty

# Names of HTML elements, and words of class, id and role attributes that hint at what is not content.
_BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul head caption".split()
)
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_RAW = set("script style textarea title xmp noembed noframes iframe".split())  # text up to their end tag, or to the end of the page
_SKIPPED = set("head noscript template svg object canvas select button audio video map annotation annotation-xml".split())  # left out if they end
_OUTSIDE = set("nav footer aside dialog menu search header".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_ENDS_BEFORE = {"li": "li", "dd": "dd dt", "dt": "dd dt", "td": "td th", "th": "td th", "tr": "td th tr", "option": "option"}
_MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert "
    "warning sidebar aside menu nav navbar navigation navi breadcrumb breadcrumbs footer foot header masthead topbar comment comments commentlist reply replies "
    "respond responses discussion disqus share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay copyright disclaimer "
    "widget toolbar pagination pager hidden search form complementary contentinfo skip".split()
)
_AD_MARKS = set("ad ads adv advert adverts advertisement advertising adsense".split())
_COMMENT_MARKS = set("comment comments commentlist reply replies respond responses disqus".split())
_HEADER_MARKS = set("header banner masthead".split())
_CONTENT_MARKS = set("article post entry story content main body text".split())
#: Words that leave a name's meaning as it is (``post-comments``), and words of names that speak of a page's layout.
_NEUTRAL = _CONTENT_MARKS | set(
    "posts page site blog global local primary secondary wrapper wrap container box block area bar list item items section inner outer top bottom left right center "
    "col column module region panel slot unit zone title link links policy button buttons icon icons group row the and id cc".split()
)
#: Marks that are names of an article's own sections as well.
_SECTIONS = set("discussion warning notice notices alert social sharing menu search form promotion related".split())
#: Beginnings of the names that services for reader comments and for consent give their containers.
_COMMENT_SERVICES = re.compile(r"(?:disqus|livefyre|hyvor|commento|giscus|utterances|isso-thread|fb-comments)", re.IGNORECASE)
_CONSENT_SERVICES = re.compile(r"(?:onetrust|cookiebot|cookieconsent|usercentrics|didomi|cmpbox|cmpwrapper|cc-window|cc_banner)", re.IGNORECASE)
#: How lines at the foot of a page speak of rights.
_RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b)\s*(?:©|\(c\))?\s*(?:\d{4}|by\b)|\ball rights reserved\b", re.IGNORECASE)
#: Words without a link that a section of an article has at least, and the share of its words in links that it hasn't.
SECTION_WORDS, SECTION_LINKS = 8, 0.25
_LAYOUT = set("no with without has layout template theme enabled disabled open closed grid".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+))?+|=)*+)(?:>|\Z)")
_ATTRIBUTES = re.compile(r"(=?+[^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]*+)))?+")
_COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.DOTALL)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
WEAK, STRONG = 1, 2


class Block(NamedTuple):
    text: str
    words: int
    link_density: float
    mark: int  # how much its surroundings are named as what isn't content: 0, WEAK or STRONG
    enclosed: bool  # within an article or the main element
    heading: bool

    @property
    def rights(self) -> bool:
        """Whether it is a short line about rights."""
        return self.words <= 40 and bool(_RIGHTS.search(self.text))


class _Mark(NamedTuple):
    level: int
    firm: bool  # whatever share of the page it holds
    section: bool = False  # by a name that sections of an article have too


def _attributes(source: str) -> dict[str, str]:
    """By the rules of HTML; of repeated names the first counts."""
    given: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTES.findall(source) if source.strip() else ():
        given.setdefault(name.lower(), html.unescape(a or b or c))
    return given


@lru_cache(maxsize=1 << 14)
def _name_mark(name: str, enclosed: bool) -> _Mark | None:
    """What one class, id or role says. Names of marks and neutral words alone are strong, others that have a mark weak."""
    if _COMMENT_SERVICES.match(name) or _CONSENT_SERVICES.match(name):
        return _Mark(STRONG, True)
    parts = [w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]
    found = _MARKS.intersection(parts)
    if not found or _LAYOUT.intersection(parts) or (found <= _HEADER_MARKS and (enclosed or _CONTENT_MARKS.intersection(parts))):
        return None
    if found & _AD_MARKS or all(w in _MARKS or w in _NEUTRAL for w in parts):
        return _Mark(STRONG, bool(found & _COMMENT_MARKS))
    return None if enclosed else _Mark(WEAK, False)


def _mark_of(tag: str, given: dict[str, str], enclosed: bool) -> _Mark | None:
    """What an element's name and attributes say against it."""
    if "hidden" in given or given.get("aria-hidden") == "true" or _UNSEEN.search(given.get("style", "")):
        return _Mark(STRONG, True)
    if tag in _OUTSIDE and not (tag == "header" and enclosed):
        return _Mark(STRONG, True)
    found = [_Mark(STRONG, False)] if tag == "form" else []
    if given and tag not in ("main", "body", "html") and tag not in _HEADINGS:
        classes = given.get("class", "").split()
        names = [*classes, given.get("id", ""), given.get("role", "")]
        if tag not in _BLOCK:  # parts of a sentence
            names = [n for n in names if n.lower() in _AD_MARKS]
        named = [(n, m) for n in names if n and (m := _name_mark(n, enclosed or tag == "article"))]
        found += [m for _, m in named]
        # an element that is named for linking to it, by its id or as a section, and by no other mark
        structural = tag == "section" or not any(n in classes for n, _ in named)
        if enclosed and tag != "form" and named and structural and all(n.lower() in _SECTIONS for n, _ in named):
            return _Mark(STRONG, False, True)
    return max(found, default=None)


class _Reader:
    """One pass over a page, in time proportional to its length."""

    def __init__(self) -> None:
        self.found: list[tuple[str, int, float, int, bool, bool]] = []  # text, words, link density, number of the innermost mark, enclosed, heading
        self.marks: list[_Mark] = []
        self.above: list[int] = []  # of each mark the next one outside it, or -1
        self.words: list[int] = []  # within each mark
        self.total = 0
        self.stack: list[tuple[str, int, bool, bool]] = []  # name, innermost mark, enclosed, whether it is a block
        self.places: dict[str, list[int]] = {}  # of each name in the stack
        self.blocks: list[int] = []  # places of blocks in the stack
        self.texts: list[str] = []
        self.link_words = 0
        self.link_depth = -1  # of the stack where the open link began
        self.silent = 0  # open inline elements that are left out

    def top(self) -> tuple[int, bool]:
        return (self.stack[-1][1], self.stack[-1][2]) if self.stack else (-1, False)

    def close_block(self) -> None:
        text = " ".join(html.unescape("".join(self.texts)).split())
        self.texts.clear()
        if text:
            words = text.count(" ") + 1
            heading = bool(self.stack) and self.stack[-1][0] in _HEADINGS
            self.found.append((text, words, min(1.0, self.link_words / words), *self.top(), heading))
            self.total += words
        self.link_words = 0

    def add(self, text: str) -> None:
        if self.silent:
            return
        self.texts.append(text)
        if self.link_depth >= 0:
            self.link_words += len(html.unescape(text).split())

    def push(self, tag: str, mark: _Mark | None, enclosed: bool) -> None:
        number, inside = self.top()
        if mark:
            self.marks.append(mark)
            self.above.append(number)
            self.words.append(-self.total)
            number = len(self.marks) - 1
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in _BLOCK:
            self.blocks.append(len(self.stack))
        else:
            self.silent += 1
        self.stack.append((tag, number, inside or enclosed, tag in _BLOCK))

    def pop(self) -> str:
        tag, number, _, block = self.stack.pop()
        self.places[tag].pop()
        if block:
            self.blocks.pop()
        else:
            self.silent -= 1
        if number != self.top()[0]:
            self.words[number] += self.total
        if len(self.stack) < self.link_depth:
            self.link_depth = -1
        return tag

    def start(self, tag: str, source: str) -> None:
        given = _attributes(source)
        if tag == "a":
            self.link_depth = len(self.stack) if "href" in given else -1
        if tag not in _BLOCK:
            if tag == "br":
                self.add(" ")
            elif given and tag not in _VOID and not source.endswith("/") and not self.places.get("pre") and _mark_of(tag, given, False):
                self.push(tag, None, False)
            return
        self.close_block()
        while self.stack and self.stack[-1][0] == "p":
            self.pop()
        ends = _ENDS_BEFORE.get(tag, "").split()
        while self.stack and self.stack[-1][0] in ends:
            self.pop()
        if tag not in _VOID and not source.endswith("/"):
            mark = _mark_of(tag, given, self.top()[1])
            self.push(tag, mark, tag in ("article", "main") or given.get("role") in ("main", "article"))

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link_depth = -1
        open_at = self.places.get(tag)
        if tag in _BLOCK:
            self.close_block()
            while open_at:
                if self.pop() == tag:
                    break
        elif open_at and open_at[-1] > (self.blocks[-1] if self.blocks else -1):
            while self.pop() != tag:
                pass


def _read(page: str) -> _Reader:
    r, at = _Reader(), 0
    lower = page.lower() if len(page.lower()) == len(page) else re.sub("[A-Z]", lambda m: m[0].lower(), page)
    ended: dict[str, bool] = {}  # elements of which no further end tag is on the page

    def past_end(tag: str, at: int) -> int | None:
        while not ended.get(tag):
            at = lower.find(f"</{tag}", at)
            if at < 0:
                ended[tag] = True
                break
            after = at + len(tag) + 2
            if after >= len(page) or page[after] in "> /\t\n\r\f":
                close = page.find(">", after)
                return len(page) if close < 0 else close + 1
            at = after
        return None

    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            begin = len(page)
        if begin > at:
            r.add(page[at:begin])
        if begin == len(page):
            break
        if found := _TAG.match(page, begin):
            closing, tag, source = found.groups()
            at, tag = found.end(), tag.lower()
            if tag in _RAW or tag in _SKIPPED:
                if not closing and not (source.endswith("/") and tag in ("svg", "annotation", "annotation-xml")):
                    past = past_end(tag, at)
                    at = past if past is not None else len(page) if tag in ("script", "style", "textarea", "title") else at
                r.add(" ")
            elif closing:
                r.end(tag)
            else:
                r.start(tag, source)
        elif found := _COMMENT.match(page, begin):
            at = found.end()
        elif page[begin + 1 : begin + 2] in ("!", "?", "/") and len(page) > begin + 1:
            close = page.find(">", begin)
            at = len(page) if close < 0 else close + 1
        else:
            r.add("<")
            at = begin + 1
    r.close_block()
    while r.stack:
        r.pop()
    return r


def _sections(r: _Reader) -> list[bool]:
    """Of each mark whether it is a section of the article after all: named as one may be, it begins with a heading, holds
    text mostly out of links and no reader comments."""
    n = len(r.marks)
    first, headed, words, linked = [len(r.found)] * n, [False] * n, [0.0] * n, [0.0] * n
    comments = [m.firm for m in r.marks]
    for at, (_, count, density, number, _, heading) in enumerate(r.found):
        if number >= 0:
            if at < first[number]:
                first[number], headed[number] = at, heading
            words[number] += 0 if heading else count
            linked[number] += 0 if heading else count * density
    for i in range(n - 1, -1, -1):  # those inside come later
        if (up := r.above[i]) >= 0:
            if first[i] < first[up]:
                first[up], headed[up] = first[i], headed[i]
            words[up] += words[i]
            linked[up] += linked[i]
            comments[up] = comments[up] or comments[i]
    return [m.section and headed[i] and not comments[i] and words[i] - linked[i] >= SECTION_WORDS and linked[i] < SECTION_LINKS * words[i] for i, m in enumerate(r.marks)]


def _standing(r: _Reader) -> list[int]:
    """The level of each mark with those outside it. A strong mark that isn't firm falls if all that is outside marks, or
    only in marks around it that have fallen, is less than a tenth of its words and in no article: then its name speaks of
    the page. So do marks that are sections of an article."""
    sections = _sections(r)
    own = np.zeros((len(r.marks) + 1, 2))  # words by their innermost strong mark, the last of those in none: out of links, and in an article
    strong = [0] * len(r.marks)
    for i, mark in enumerate(r.marks):
        strong[i] = i if mark.level == STRONG else strong[r.above[i]] if r.above[i] >= 0 else -1
    for _, words, density, number, enclosed, _ in r.found:
        at = strong[number] if number >= 0 else -1
        own[at] += words * (1 - density), words * enclosed
    out, base = [0] * len(r.marks), [own[-1]] * len(r.marks)
    for i, mark in enumerate(r.marks):
        up = r.above[i]
        around = out[up] if up >= 0 else 0
        base[i] = base[up] if up >= 0 else own[-1]
        if around == STRONG or mark.level == WEAK:
            out[i] = max(around, mark.level)
        elif sections[i] or (not mark.firm and base[i][1] == 0 and 10 * base[i][0] < r.words[i]):
            out[i], base[i] = around, base[i] + own[i]
        else:
            out[i] = STRONG
    return out


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Unclosed elements end with what encloses them; an article within a mark stays marked."""
    r = _read(page)
    levels = _standing(r)
    return [Block(text, words, density, levels[number] if number >= 0 else 0, enclosed, heading) for text, words, density, number, enclosed, heading in r.found]


#: Features of a block in the order of the labelled table. place: 2 within an article or the main element, 0 outside it on a page that has one, 1 on a page without.
FEATURES = ("mark", "place", "heading", "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "calmer_side", "rights")


def calmer_side(words_before: float, density_before: float, words_after: float, density_after: float) -> float:
    """The lower link density of the two neighbours; the edge of a page counts as a link."""
    return min(density_before if words_before else 1.0, density_after if words_after else 1.0)


#: Blocks labelled by hand (features as above up to the neighbours; the last column tells whether the block is content).
LABELLED = [
    # within the article
    (0, 2, 1, 7, 0.0, 12, 0.0, 40, 0.0, 1),
    (0, 2, 1, 3, 0.0, 5, 1.0, 60, 0.0, 1),
    (0, 2, 1, 2, 1.0, 1, 1.0, 45, 0.0, 1),
    (0, 2, 0, 48, 0.0, 7, 0.0, 90, 0.02, 1),
    (0, 2, 0, 120, 0.05, 48, 0.0, 33, 0.0, 1),
    (0, 2, 0, 1, 0.0, 188, 0.0, 61, 0.0, 1),
    (0, 2, 0, 2, 0.0, 30, 0.0, 9, 0.1, 1),
    (0, 2, 0, 14, 0.6, 152, 0.0, 75, 0.0, 1),
    (0, 2, 0, 5, 1.0, 64, 0.0, 71, 0.0, 1),
    (0, 2, 0, 4, 1.0, 6, 1.0, 3, 1.0, 1),
    (0, 2, 0, 25, 0.0, 9, 0.0, 9, 0.4, 1),
    (0, 2, 0, 1, 0.0, 1, 0.0, 1, 1.0, 1),
    (0, 2, 0, 310, 0.0, 2, 1.0, 0, 0.0, 1),
    (0, 2, 0, 4, 0.0, 2, 1.0, 3, 1.0, 1),
    (0, 2, 0, 2, 0.0, 1, 1.0, 0, 0.0, 1),
    (0, 2, 0, 9, 0.0, 5, 1.0, 1, 1.0, 1),
    (0, 2, 0, 1, 0.0, 0, 0.0, 2, 1.0, 1),
    (0, 2, 0, 6, 0.2, 3, 1.0, 2, 1.0, 1),
    (0, 2, 0, 11, 0.0, 4, 1.0, 0, 0.0, 1),
    (0, 2, 1, 3, 0.0, 2, 1.0, 2, 1.0, 1),
    (0, 2, 1, 6, 0.0, 40, 0.0, 3, 1.0, 1),
    (0, 2, 1, 2, 0.0, 0, 0.0, 1, 1.0, 1),
    (0, 2, 1, 4, 0.0, 9, 0.0, 5, 1.0, 1),
    (2, 2, 0, 15, 0.0, 80, 0.0, 22, 0.0, 0),
    (2, 2, 0, 160, 0.0, 34, 0.0, 41, 0.0, 0),
    (2, 2, 1, 2, 0.0, 170, 0.0, 18, 0.0, 0),
    (2, 2, 0, 4, 1.0, 51, 0.0, 3, 1.0, 0),
    (2, 2, 0, 33, 0.1, 3, 0.0, 130, 0.0, 0),
    # outside it
    (0, 0, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0),
    (0, 0, 0, 12, 0.0, 1, 1.0, 7, 0.0, 0),
    (0, 0, 0, 35, 0.0, 90, 0.0, 8, 0.0, 0),
    (0, 0, 1, 4, 0.0, 55, 0.0, 20, 0.0, 0),
    (0, 0, 0, 180, 0.0, 6, 0.5, 70, 0.0, 0),
    (0, 0, 0, 9, 0.0, 210, 0.0, 0, 0.0, 0),
    (0, 0, 1, 6, 0.0, 0, 0.0, 48, 0.0, 0),
    (0, 0, 0, 41, 0.0, 6, 0.0, 33, 0.0, 0),
    (2, 0, 0, 1, 1.0, 0, 0.0, 1, 1.0, 0),
    (2, 0, 0, 9, 0.1, 110, 0.0, 0, 0.0, 0),
    (2, 0, 0, 42, 0.0, 1, 1.0, 7, 0.0, 0),
    (2, 0, 1, 3, 0.0, 2, 1.0, 11, 0.0, 0),
    # pages without an article
    (0, 1, 1, 8, 0.0, 1, 1.0, 66, 0.0, 1),
    (0, 1, 1, 4, 0.0, 13, 0.0, 47, 0.0, 1),
    (0, 1, 1, 6, 0.0, 0, 0.0, 30, 0.1, 1),
    (0, 1, 0, 70, 0.0, 8, 0.0, 95, 0.0, 1),
    (0, 1, 0, 26, 0.08, 70, 0.0, 44, 0.0, 1),
    (0, 1, 0, 19, 0.0, 133, 0.0, 28, 0.05, 1),
    (0, 1, 0, 150, 0.1, 2, 1.0, 3, 1.0, 1),
    (0, 1, 0, 12, 0.0, 2, 1.0, 5, 0.8, 1),
    (0, 1, 0, 6, 0.0, 58, 0.0, 37, 0.0, 1),
    (0, 1, 0, 1, 0.0, 40, 0.0, 152, 0.0, 1),
    (0, 1, 0, 3, 0.0, 129, 0.0, 24, 0.0, 1),
    (0, 1, 0, 11, 0.2, 83, 0.0, 19, 0.0, 1),
    (0, 1, 0, 14, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 1, 0, 4, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 1, 0, 9, 0.0, 12, 0.0, 0, 0.0, 1),
    (0, 1, 0, 5, 0.0, 8, 0.0, 21, 0.0, 1),
    (0, 1, 0, 40, 0.3, 22, 0.0, 17, 0.0, 1),
    (0, 1, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0),
    (0, 1, 0, 2, 1.0, 1, 1.0, 40, 0.0, 0),
    (0, 1, 0, 2, 1.0, 0, 0.0, 3, 0.0, 0),
    (0, 1, 0, 4, 1.0, 77, 0.0, 3, 1.0, 0),
    (0, 1, 0, 7, 0.86, 5, 1.0, 6, 0.9, 0),
    (0, 1, 0, 16, 0.75, 3, 1.0, 12, 0.8, 0),
    (0, 1, 0, 33, 0.7, 60, 0.0, 5, 1.0, 0),
    (0, 1, 0, 4, 0.5, 9, 0.0, 0, 0.0, 0),
    (0, 1, 0, 6, 0.5, 31, 0.0, 12, 0.0, 0),
    (0, 1, 0, 3, 0.0, 2, 1.0, 2, 1.0, 0),
    (0, 1, 1, 2, 0.0, 4, 1.0, 2, 1.0, 0),
    (0, 1, 0, 1, 0.0, 1, 1.0, 1, 1.0, 0),
    (0, 1, 0, 4, 0.0, 6, 1.0, 3, 0.9, 0),
    (2, 1, 0, 1, 1.0, 0, 0.0, 1, 1.0, 0),
    (2, 1, 0, 21, 0.0, 70, 0.0, 15, 0.0, 0),
    (2, 1, 0, 158, 0.0, 25, 0.0, 30, 0.0, 0),
    (2, 1, 1, 4, 0.0, 1, 1.0, 31, 0.0, 0),
    (2, 1, 0, 8, 0.1, 95, 0.0, 0, 0.0, 0),
    # such pages: paragraphs of any length among others
    (0, 1, 0, 2, 0.0, 4, 0.0, 3, 0.0, 1),
    (0, 1, 0, 4, 0.0, 1, 0.0, 88, 0.0, 1),
    (0, 1, 0, 8, 0.0, 150, 0.0, 2, 0.0, 1),
    (0, 1, 0, 33, 0.0, 3, 0.0, 1, 0.0, 1),
    (0, 1, 0, 66, 0.0, 7, 0.0, 6, 0.0, 1),
    (0, 1, 0, 110, 0.0, 16, 0.0, 4, 0.0, 1),
    (0, 1, 0, 25, 0.2, 2, 0.0, 10, 0.0, 1),
    (0, 1, 0, 5, 0.4, 30, 0.0, 61, 0.0, 1),
    # before a list of links
    (0, 1, 0, 38, 0.0, 71, 0.0, 2, 1.0, 1),
    (0, 1, 0, 84, 0.05, 45, 0.0, 3, 1.0, 1),
    (0, 1, 0, 17, 0.0, 52, 0.0, 1, 1.0, 1),
    (0, 1, 0, 7, 0.0, 33, 0.0, 2, 1.0, 1),
    (0, 1, 0, 3, 0.0, 60, 0.0, 2, 1.0, 1),
    (0, 1, 0, 1, 0.0, 24, 0.1, 4, 1.0, 1),
    (0, 1, 0, 22, 0.3, 48, 0.0, 3, 1.0, 1),
    (0, 1, 0, 12, 0.0, 5, 0.0, 2, 1.0, 1),
    (0, 1, 0, 46, 0.0, 4, 0.0, 1, 1.0, 1),
    (0, 1, 0, 2, 0.0, 8, 0.0, 1, 1.0, 1),
    (0, 1, 0, 1, 0.0, 3, 0.0, 5, 1.0, 1),
    (0, 1, 0, 5, 0.0, 2, 0.0, 3, 1.0, 1),
    (0, 1, 0, 4, 0.0, 130, 0.0, 6, 0.9, 1),
    # after one
    (0, 1, 0, 29, 0.0, 3, 1.0, 47, 0.0, 1),
    (0, 1, 0, 8, 0.0, 2, 1.0, 62, 0.0, 1),
    (0, 1, 0, 2, 0.0, 1, 1.0, 35, 0.0, 1),
    (0, 1, 0, 75, 0.0, 2, 1.0, 4, 0.0, 1),
    (0, 1, 0, 5, 0.0, 6, 1.0, 3, 0.0, 1),
    # between two
    (0, 1, 0, 120, 0.0, 1, 1.0, 1, 1.0, 1),
    (0, 1, 0, 16, 0.0, 2, 1.0, 3, 1.0, 1),
    (0, 1, 0, 27, 0.1, 4, 1.0, 2, 1.0, 1),
    (0, 1, 0, 5, 0.0, 1, 1.0, 2, 1.0, 0),
    (0, 1, 0, 7, 0.0, 3, 1.0, 1, 1.0, 0),
    (0, 1, 0, 2, 0.0, 5, 1.0, 4, 1.0, 0),
    (0, 1, 0, 8, 0.2, 2, 1.0, 2, 1.0, 0),
    # at the ends of a page
    (0, 1, 0, 52, 0.0, 2, 1.0, 0, 0.0, 1),
    (0, 1, 0, 31, 0.0, 0, 0.0, 3, 1.0, 1),
    (0, 1, 0, 24, 0.0, 1, 1.0, 0, 0.0, 1),
    (0, 1, 0, 1, 0.0, 90, 0.0, 0, 0.0, 1),
    (0, 1, 0, 3, 0.0, 4, 0.0, 0, 0.0, 1),
    (0, 1, 0, 140, 0.0, 6, 0.0, 0, 0.0, 1),
    (0, 1, 0, 20, 0.0, 0, 0.0, 9, 0.0, 1),
    (0, 1, 0, 2, 0.0, 0, 0.0, 1, 1.0, 0),
    (0, 1, 0, 5, 0.0, 0, 0.0, 2, 1.0, 0),
    (0, 1, 0, 8, 0.0, 0, 0.0, 4, 1.0, 0),
    (0, 1, 0, 3, 0.0, 2, 1.0, 0, 0.0, 0),
    (0, 1, 0, 6, 0.0, 1, 1.0, 0, 0.0, 0),
    (0, 1, 0, 8, 0.0, 3, 1.0, 0, 0.0, 0),
    # headings
    (0, 1, 1, 4, 0.0, 3, 1.0, 9, 0.0, 1),
    (0, 1, 1, 3, 0.0, 2, 1.0, 4, 0.0, 1),
    (0, 1, 1, 7, 0.0, 12, 0.0, 2, 0.0, 1),
    (0, 1, 1, 2, 0.0, 1, 1.0, 1, 0.0, 1),
    (0, 1, 1, 9, 0.0, 5, 1.0, 120, 0.0, 1),
    (0, 1, 1, 1, 0.0, 70, 0.0, 3, 0.0, 1),
    (0, 1, 1, 5, 0.0, 3, 0.0, 15, 0.3, 1),
    (0, 1, 1, 2, 0.0, 0, 0.0, 5, 0.0, 1),
    (0, 1, 1, 3, 0.0, 64, 0.0, 2, 1.0, 0),
    (0, 1, 1, 2, 0.0, 9, 0.0, 3, 1.0, 0),
    (0, 1, 1, 5, 0.0, 40, 0.0, 1, 1.0, 0),
    (0, 1, 1, 8, 0.0, 2, 0.0, 4, 1.0, 0),
    (0, 1, 1, 1, 0.0, 130, 0.0, 2, 0.9, 0),
    (0, 1, 1, 4, 0.0, 3, 1.0, 2, 1.0, 0),
    (0, 1, 1, 3, 1.0, 12, 0.0, 2, 1.0, 0),
    # links
    (0, 1, 0, 1, 1.0, 60, 0.0, 45, 0.0, 0),
    (0, 1, 0, 3, 1.0, 2, 0.0, 2, 1.0, 0),
    (0, 1, 0, 2, 1.0, 3, 1.0, 9, 0.0, 0),
    (0, 1, 0, 6, 1.0, 1, 1.0, 0, 0.0, 0),
    (0, 1, 0, 4, 0.9, 8, 0.0, 0, 0.0, 0),
    (0, 1, 0, 12, 0.8, 4, 0.0, 7, 0.0, 0),
    (0, 1, 0, 26, 0.9, 3, 1.0, 2, 1.0, 0),
    # within names that have other words too
    (1, 1, 0, 64, 0.0, 9, 0.0, 80, 0.0, 1),
    (1, 1, 0, 130, 0.05, 64, 0.0, 22, 0.0, 1),
    (1, 1, 0, 24, 0.0, 3, 1.0, 15, 0.0, 1),
    (1, 1, 0, 12, 0.0, 70, 0.0, 55, 0.0, 1),
    (1, 1, 1, 5, 0.0, 20, 0.0, 48, 0.0, 1),
    (1, 1, 0, 2, 1.0, 1, 1.0, 2, 1.0, 0),
    (1, 1, 0, 5, 0.8, 60, 0.0, 4, 1.0, 0),
    (1, 1, 0, 28, 0.75, 40, 0.0, 3, 1.0, 0),
    (1, 1, 0, 4, 0.0, 1, 1.0, 2, 1.0, 0),
    (1, 1, 1, 2, 0.0, 30, 0.0, 2, 1.0, 0),
    (1, 0, 0, 40, 0.0, 9, 0.0, 12, 0.0, 0),
    (1, 0, 0, 3, 1.0, 70, 0.0, 2, 1.0, 0),
    (1, 0, 1, 4, 0.0, 90, 0.0, 30, 0.0, 0),
]

#: The same of short lines about rights.
LABELLED_RIGHTS = [
    (0, 2, 0, 12, 0.0, 40, 0.0, 33, 0.0, 1),
    (0, 2, 0, 7, 0.0, 80, 0.0, 0, 0.0, 1),
    (2, 2, 0, 8, 0.1, 51, 0.0, 0, 0.0, 0),
    (0, 0, 0, 8, 0.0, 60, 0.0, 0, 0.0, 0),
    (0, 1, 0, 7, 0.0, 44, 0.0, 0, 0.0, 0),
    (0, 1, 0, 9, 0.1, 2, 1.0, 0, 0.0, 0),
    (0, 1, 0, 6, 0.0, 2, 1.0, 3, 1.0, 0),
    (0, 1, 0, 14, 0.2, 30, 0.0, 2, 1.0, 0),
    (0, 1, 0, 5, 0.0, 91, 0.0, 4, 0.0, 0),
    (0, 1, 0, 21, 0.0, 17, 0.0, 6, 0.0, 0),
    (0, 1, 0, 36, 0.0, 2, 1.0, 0, 0.0, 0),
    (1, 1, 0, 8, 0.0, 70, 0.0, 0, 0.0, 0),
    (2, 1, 0, 8, 0.1, 95, 0.0, 0, 0.0, 0),
]


class Tree(NamedTuple):
    """A decision tree: ``feature`` below ``limit`` goes to the first branch. A leaf has branches None."""

    content: bool
    feature: int = -1
    limit: float = 0.0
    below: Tree | None = None
    above: Tree | None = None


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 12) -> Tree:
    """CART by Gini impurity; of equal splits the first feature and the lowest limit win."""
    leaf = Tree(bool(y.mean() >= 0.5))
    if depth == 0 or y.all() or not y.any():
        return leaf
    best: tuple[float, int, float] | None = None
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for limit in (values[:-1] + values[1:]) / 2:
            below = x[:, k] < limit
            impurity = sum(part.mean() * (1 - part.mean()) * len(part) for part in (y[below], y[~below]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, k, float(limit))
    if best is None:
        return leaf
    _, k, limit = best
    below = x[:, k] < limit
    return Tree(leaf.content, k, limit, grow_tree(x[below], y[below], depth - 1), grow_tree(x[~below], y[~below], depth - 1))


def labelled_table() -> np.ndarray:
    """All labelled blocks with all features, and the label."""
    rows = [(*row[:-1], calmer_side(*row[5:9]), rights, row[-1]) for rights, rows in enumerate((LABELLED, LABELLED_RIGHTS)) for row in rows]
    return np.array(rows, np.float64)


@lru_cache(maxsize=1)
def content_tree() -> Tree:
    table = labelled_table()
    return grow_tree(table[:, :-1], table[:, -1])


def is_content(tree: Tree, features: tuple[float, ...]) -> bool:
    while tree.below is not None:
        tree = tree.below if features[tree.feature] < tree.limit else tree.above
    return tree.content


def features_of(found: list[Block]) -> list[tuple[float, ...]]:
    """An article counts as the page's place of content if it has a tenth of the unmarked words out of links."""
    edge = Block("", 0, 0.0, 0, False, False)
    around = [edge, *found, edge]
    plain = [b for b in found if b.mark < STRONG]
    enclosed = sum(b.words for b in plain if b.enclosed)
    article = enclosed > 0 and 10 * enclosed >= sum(b.words * (1 - b.link_density) for b in plain)
    return [
        (b.mark, (2 if b.enclosed else 0) if article else 1, b.heading, b.words, b.link_density, before.words, before.link_density, after.words, after.link_density)
        + (calmer_side(before.words, before.link_density, after.words, after.link_density), b.rights)
        for before, b, after in zip(around, around[1:], around[2:], strict=False)
    ]


def main_text(page: str) -> str:
    """The content blocks of a page, joined by blank lines; empty if there is none."""
    found, tree = blocks(page), content_tree()
    return "\n\n".join(b.text for b, features in zip(found, features_of(found), strict=True) if is_content(tree, features))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page; null or empty html has an empty text. Rows are independent; other columns are ignored."""

    def task():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

        return step

    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), text_or_empty(html_col).alias("html"))
    kinds = dict(rows.dtypes)
    return map_arrow(rows, task, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
