"""Main text of HTML pages by tree scoring.

A page is read once into a tree of its elements and a list of its text blocks.
Each block passes points, for its length and its commas, to the elements above
it: all of them to its parent, half to the next, then a third of that and so on
(the weights are in SHARES). An element's points are discounted by its link
density, the share of its text that stands in links. The best container, widened
to the article or main element around it, is kept, with those of its siblings
that score well or are paragraphs of text. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments are no candidates: they are
known by their elements, roles and the names in their class and id. A name must be
made of such words as a whole ("site-footer", not "has-footer"), and is only a
hint: an element with an article or most of the page's text stays a candidate,
of half its points. Lists and boxes of links without such a name are dropped,
but not those inside an article or between the paragraphs of the best container.
A page is read in time linear in its length, however deep its elements nest.

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined in page order by an empty line.

A null or empty page has an empty text. A page without any container keeps its
visible blocks. Broken markup (unclosed or stray tags, a page that ends inside a
tag) is read as far as it goes; a head without its end tag ends where the body's
first tag or text stands. Repeated rows are extracted each; extra columns
are kept by `extract`.
"""

from __future__ import annotations

import html as references
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglass.llm.common import small_batches

# fixed values of the HTML language
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe noframes xmp noembed svg math".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# an opening of one of these ends an open paragraph
ENDS_PARAGRAPH = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
# an opening of the key ends an open element of the values, up to the container
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SAME_UNTIL = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "select", "menu"}
# what may stand in a head; anything else ends a head that was left open
IN_HEAD = set("html head title meta link base basefont bgsound script style noscript noframes template".split())
# what is never part of an article
JUNK_TAGS = set(
    "nav footer aside form button select input option datalist menu dialog object embed canvas audio video map head "
    "fieldset legend progress meter applet".split()
)
JUNK_ROLES = set("navigation banner contentinfo complementary search menu menubar toolbar alert alertdialog dialog form".split())
JUNK_WORDS = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot banner banners breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies copyright disclaimer discussion disqus dropdown footer footers gdpr hidden login masthead menu menus "
    "menubar modal nav navbar navi navigation newsletter notice notices notification notifications alert alerts opinions overlay pager pagination "
    "paywall popup popups promo promos promotion promoted recommended recommendations related replies reply respond responses search share sharebar sharing "
    "sidebar sidebars sidenav signup skip social sponsor sponsored sponsors subscribe subscription subscriptions tagcloud teaser teasers toc toolbar "
    "topbar trending widget widgets".split()
)
#: Parts of a name that say nothing of their own: "share-box", "left-sidebar".
PLAIN_WORDS = set(
    "area articles bar bars block blocks body bottom box btn button buttons col column container desktop div el elem element entries "
    "entry form full global group head heading icon icons id img inner item items js label left line link links list lists "
    "lower main mini mobile module my node outer page pane panel primary region right row secondary section side site "
    "reader readers small sub tab text thread title top unit upper user users view visitor visitors wrap wrapper zone posts news stories".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SHARES = (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12)
#: A sibling is kept from this share of the best score on.
SIBLING = 0.2
#: Shares of a page's text that make an article its story, and a container too large to be judged by its name.
STORY, MOST = 0.25, 0.5
#: What is left of the points of a container that has a junk name all the same.
LOWERED = 0.5

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
# one attribute: its whole name, and its value in one of three groups
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """Elements as parallel lists (parent, tag, text, link text, points) and the blocks outside junk."""

    def __init__(self, html: str):
        self.parent, self.tag, self.text, self.links, self.points = [-1], ["#root"], [0], [0], [0.0]
        self.blocks: list[tuple[int, str]] = []
        # elements whose name alone says junk or header, until the whole page is known
        self.named: dict[int, str] = {}
        self.lowered: set[int] = set()
        self._read(html)
        if self.named:
            self._judge()
        self._score()

    def _read(self, html: str) -> None:
        # open tags: (tag, nearest element that is a block, is junk, is link, only headings count, in a heading, in an article)
        stack = [("#root", 0, False, False, False, False, False)]
        # where in the stack each tag is open, and which of its places are blocks: no step walks the whole stack
        places: dict[str, list[int]] = defaultdict(list)
        outer = [0]
        pieces: list[tuple[str, bool]] = []
        at, end = 0, len(html)

        def flush() -> None:
            if not pieces:
                return
            raw = "".join([p for p, _ in pieces])
            text = " ".join(raw.split())
            if text:
                block = stack[-1][1]
                self.blocks.append((block, text))
                linked = sum(len(p) for p, inside in pieces if inside)
                self.text[block] += len(text)
                self.links[block] += min(linked, len(text))
            pieces.clear()

        def add(text: str) -> None:
            if stack[-1][0] == "head" and not text.isspace():
                pop(len(stack) - 1)
            _, _, junk, link, headings, heading, _ = stack[-1]
            if junk or (headings and not heading):
                return
            pieces.append((references.unescape(text) if "&" in text else text, link))

        def pop(to: int) -> None:
            while len(stack) > to:
                if stack[-1][0] not in INLINE:
                    flush()
                    outer.pop()
                places[stack.pop()[0]].pop()

        def nearest(tags) -> int:
            return max((places[t][-1] for t in tags if places[t]), default=0)

        while at < end:
            found = TAG.search(html, at)
            if not found:
                add(html[at:])
                break
            if found.start() > at:
                add(html[at : found.start()])
            at = found.end()
            name = found.group(2) or found.group(5)
            if not name:
                continue
            name, closing, attributes = name.lower(), bool(found.group(1) or found.group(4)), found.group(3) or found.group(6) or ""
            if stack[-1][0] == "head" and not closing and name not in IN_HEAD:
                pop(len(stack) - 1)
            if name == "br" or name == "hr":
                add(" ")
                if name == "hr":
                    flush()
                continue
            if closing:
                # an inline end tag does not close blocks
                depth = nearest((name,))
                if depth and (name not in INLINE or depth > outer[-1]):
                    pop(depth)
                continue
            if name in VOID:
                continue
            if name in RAW:
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(html, at)
                if not attributes.rstrip().endswith("/"):
                    at = stop.end() if stop else end
                continue
            if name in ENDS_PARAGRAPH:
                if stack[outer[-1]][0] == "p":
                    pop(outer[-1])
            elif name in SAME:
                depth = nearest(SAME[name])
                if depth > nearest(SAME_UNTIL):
                    pop(depth)
            _, element, junk, link, headings, heading, inside = stack[-1]
            if name not in INLINE:
                flush()
                self.parent.append(element)
                self.tag.append(name)
                self.text.append(0)
                self.links.append(0)
                self.points.append(0.0)
                element = len(self.tag) - 1
            if not junk:
                kind = self._kind(name, attributes, inside)
                if kind.startswith("named "):
                    kind = kind.removeprefix("named ")
                    if name not in INLINE:
                        self.named[element], kind = kind, ""
                junk, headings = kind == "junk", headings or kind == "header"
            if name not in INLINE:
                outer.append(len(stack))
            places[name].append(len(stack))
            stack.append(
                (name, element, junk, link or name == "a", headings, heading or name in HEADINGS, inside or name in ("article", "main"))
            )
        pop(1)
        flush()

    @staticmethod
    def _kind(name: str, attributes: str, inside: bool) -> str:
        if name in JUNK_TAGS:
            return "junk"
        if name == "header":
            return "header" if inside else "junk"
        if not attributes or name in ("html", "body", "main"):
            return ""
        named = ""
        for found in ATTRIBUTE.finditer(attributes):
            key, value = found.group(1).lower(), found.group(2) or found.group(3) or found.group(4) or ""
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                return "junk"
            if key == "style" and INVISIBLE.search(value):
                return "junk"
            if key == "role" and value.lower() in JUNK_ROLES:
                return "junk"
            if key in ("class", "id"):
                for token in value.split():
                    words = {w.lower() for w in NAME_WORDS.findall(token)}
                    if not all(w in JUNK_WORDS or w in PLAIN_WORDS or w == "header" or w.isdigit() or len(w) == 1 for w in words):
                        continue
                    if words & JUNK_WORDS and not (name == "article" and not words & {"comment", "comments"}):
                        named = "named junk"
                    elif "header" in words and name not in HEADINGS and not named:
                        named = "named header" if inside else "named junk"
        return named

    def _judge(self) -> None:
        """Drop the blocks of elements with a junk name, but for those that hold the page's story or most of its text."""
        size, text = len(self.tag), list(self.text)
        last = self._last()
        for element in range(size - 1, 0, -1):
            text[self.parent[element]] += text[element]
        stories = [e for e in range(1, size) if self.tag[e] in ("article", "main") and e not in self.named and text[e] >= STORY * text[0] > 0]
        ends = min((last[s] for s in stories), default=size)
        dropped = dict.fromkeys(range(size), "")
        heading = [False] * size
        for element in range(1, size):
            above = self.parent[element]
            dropped[element] = dropped[above]
            heading[element] = heading[above] or self.tag[element] in HEADINGS
            kind = self.named.get(element)
            if not kind or dropped[element] == "junk":
                continue
            first = bisect_left(stories, element)
            holds = first < len(stories) and stories[first] <= last[element]
            # a story beside it, neither around nor within, leaves no doubt about the name
            beside = bool(stories) and (stories[-1] > last[element] or ends < element)
            if holds or (text[element] > MOST * text[0] and not beside):
                self.lowered.add(element)
            else:
                dropped[element] = kind
        kept = [(e, t) for e, t in self.blocks if not dropped[e] or (dropped[e] == "header" and heading[e])]
        if not kept:
            # names alone do not empty a page
            self.lowered.update(self.named)
            return
        if len(kept) < len(self.blocks):
            for element in {e for e, _ in self.blocks if dropped[e] and not (dropped[e] == "header" and heading[e])}:
                self.text[element] = self.links[element] = 0
            self.blocks = kept

    def _last(self) -> list[int]:
        """Per element the last one inside it: elements are in page order, those inside one are the numbers up to that."""
        last = list(range(len(self.tag)))
        for element in range(len(last) - 1, 0, -1):
            last[self.parent[element]] = max(last[self.parent[element]], last[element])
        return last

    def _under(self, some: set[int]) -> list[bool]:
        """Per element whether it is one of `some` or inside one."""
        under = [False] * len(self.tag)
        for element in range(1, len(under)):
            under[element] = element in some or under[self.parent[element]]
        return under

    def _above(self, element: int) -> Iterator[int]:
        while element > 0:
            yield element
            element = self.parent[element]

    def _score(self) -> None:
        for element, text in self.blocks:
            points = min(len(text) / 100, 3.0) + text.count(",") + (1.0 if len(text) >= 25 else 0.1)
            # a paragraph's points start at its parent, loose text counts for its own element
            start = self.parent[element] if self.tag[element] in ("p", "pre", "li", "td", "blockquote", *HEADINGS) else element
            for share, above in zip(SHARES, self._above(start)):
                self.points[above] += share * points
        for element in self.lowered:
            self.points[element] *= LOWERED
        for element in range(len(self.tag) - 1, 0, -1):
            self.text[self.parent[element]] += self.text[element]
            self.links[self.parent[element]] += self.links[element]

    def density(self, element: int) -> float:
        return self.links[element] / self.text[element] if self.text[element] else 0.0

    def score(self, element: int) -> float:
        return self.points[element] * (1 - self.density(element))

    def main(self) -> list[str]:
        """Texts of the kept blocks, in page order."""
        candidates = [e for e in range(1, len(self.tag)) if self.tag[e] not in ("html", "p", "li", "td", "th", *HEADINGS)]
        best = max(candidates, key=lambda e: (self.score(e), -e), default=0)
        if not best or self.score(best) <= 0:
            return [t for _, t in self.blocks]
        wide = [e for e in self._above(best) if self.tag[e] in ("article", "main")]
        best = wide[0] if wide else best
        limit = SIBLING * self.score(best)
        kept = {best}
        if self.tag[best] not in ("body", "main"):
            for other in range(1, len(self.tag)):
                if other == best or self.parent[other] != self.parent[best]:
                    continue
                heading = self.tag[other] in ("h1", "h2") and self.text[other] and other < best
                if self._prose(other) or heading or (self.score(other) >= limit > 0 and self.tag[other] not in HEADINGS):
                    kept.add(other)
        inside, lists = self._under(kept), self._under(self._link_lists(best))
        return [text for element, text in self.blocks if inside[element] and not lists[element]]

    def _link_lists(self, best: int) -> set[int]:
        """Lists and boxes that are little but links: menus without a name.

        Those of an article are its references, and so are those that stand
        between the paragraphs of the chosen container.
        """
        articles = self._under({e for e in range(1, len(self.tag)) if self.tag[e] == "article"})
        chosen, last = self._under({best}), self._last()
        prose = [e for e in range(1, len(self.tag)) if self._prose(e) and chosen[e]]
        crowded = set()
        for element in range(1, len(self.tag)):
            if self.tag[element] in ("ul", "ol", "table", "div", "section") and self.density(element) > 0.8:
                between = prose and prose[0] < element and last[element] < prose[-1]
                if not (chosen[element] and (articles[element] or between)):
                    crowded.add(element)
        return crowded

    def _prose(self, element: int) -> bool:
        return self.tag[element] == "p" and self.text[element] >= 80 and self.density(element) < 0.25


def main_text(html: str | None) -> str:
    """Main text of one page."""
    return "\n\n".join(Page(html).main()) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """All columns of `pages` with text and n_chars."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h) for h in batch], dtype=object)

    return pages.withColumn("text", of("html")).withColumn("n_chars", F.length("text").cast("bigint"))
