"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at its block-level tags. Pass one decides what it can: blocks in
page furniture (by tag, role or name of an enclosing element, unless that is a form or a
named wrapper around the article or most of the page's text) and blocks that are mostly
links are boilerplate, though not the links of an article; long blocks with enough stop words,
or long blocks of the article element, are text. Pass two settles the rest: a block left open
(short, or with few stop words) takes the label of its nearest decided neighbour in the same
container, text on a tie, and where the container has none, what the container stands for. On
a page without any block of text so far, open blocks are its text.

Reader comments are furniture whatever their size. An element of any kind that is hidden, or
named as an advert, a notice or the like, is left out with all it holds.

Pages are read by a scanner of tags that looks at each character a bounded number of times,
whatever the markup: what can't be closed ends with the page.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

MAX_LINK_DENSITY = 0.33
SHORT_CHARS = 70
LONG_CHARS = 200
STOP_LOW = 0.2
STOP_HIGH = 0.3

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset("""
a an and are as at be by for from had has have he her his i in is it its not of on or that the their this to
was we were which will with you
au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour
que qui sa se ses son sur un une vous
aber als am an auch auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich im in
ist mit nach nicht noch nur oder sich sie sind so und von war wie wird zu zum zur über
al como con de del el ella en entre era es esta este ha la las lo los más me mi muy no o para pero por que
se ser si sin sobre su sus un una y ya
""".split())

BLOCK_TAGS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
section summary table tbody td tfoot th thead title tr ul
""".split())
CONTAINERS = frozenset("""
article aside body center details dialog div dl fieldset figure footer form head header main menu nav ol
search section table ul
""".split())
FURNITURE_TAGS = frozenset("aside dialog footer form head header menu nav search".split())
UNSEEN_TAGS = frozenset("""
audio button canvas datalist embed iframe map math noscript object script select style svg template textarea
title video
""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
MAIN_TAGS = frozenset(["article", "main"])
_FURNITURE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|breadcrumbs?|cookies?|consent|comments?|disqus|discussion|dialog"
    r"|footer|foot|gdpr|header|login|masthead|menu|modal|nav\w*|newsletter|notices?|pagination|popup|promo\w*|related"
    r"|replies|responses?|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscri\w*|toolbar|widgets?)(?:$|[\s_-])", re.I)
_FURNITURE_ROLE = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())


#: Reader comments: furniture even where they are most of a page.
_COMMENT_NAME = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|discussion|replies|responses?)(?:$|[\s_-])", re.I)
#: Names that leave out an element of any kind; those of page parts count on containers only.
_LEFT_OUT_NAME = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|cookies?|consent|gdpr|newsletter|notices?|popup|promo\w*"
                            r"|share|sharing|signup|social|sponsor\w*|subscri\w*)(?:$|[\s_-])", re.I)
_HIDDEN_STYLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
#: Classes of wrappers that hold, or lack, the page part they name.
_PART = r"(?:sidebars?|headers?|footers?|nav\w*|menus?|banners?|widgets?|comments?)"
_WRAPPER_NAME = re.compile(rf"(?:no|not|has|have|with|without|content)[_-]{_PART}(?:[_-]\S+)?|\S+[_-]content[_-]{_PART}\S*", re.I)


def _named(pattern: re.Pattern, names: str) -> bool:
    return any(pattern.search(x) and not _WRAPPER_NAME.fullmatch(x) for x in names.split())


#: Elements whose content is characters only, up to their end tag.
RAW_TAGS = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: Controls that can't hold blocks: an unclosed one ends where one of these begins.
_CONTROLS = frozenset("button datalist select".split())
_FLOW = frozenset("address article aside blockquote footer form h1 h2 h3 h4 h5 h6 header main nav ol p pre section table ul".split())
_NAME = re.compile(r"[^\s/>]+")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)?""")
_TAG_END = re.compile(r"[\s/]*>")


class _Block:
    __slots__ = ("text", "linked", "furniture", "place", "main", "wrapper")

    def __init__(self, text: str, linked: int, furniture: bool, place: int, main: bool, wrapper: int):
        self.text, self.linked, self.furniture, self.place, self.main = text, linked, furniture, place, main
        self.wrapper = wrapper


class _Scanner:
    """Tags and character data of a page, in order, to ``handle_*``."""

    def feed(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            i = html.find("<", at)
            if i < 0:
                i = end
            if i > at:
                self.handle_data(unescape(html[at:i]))
            if i == end:
                return
            after = html[i + 1:i + 2]
            closing = after == "/" and html[i + 2:i + 3].isascii() and html[i + 2:i + 3].isalpha()
            if closing or (after.isascii() and after.isalpha()):
                at = self._tag(html, i, closing)
            elif html.startswith("<!--", i):
                at = i + 5 if html.startswith(">", i + 4) else i + 6 if html.startswith("->", i + 4) else self._past(html, "-->", i + 4)
            elif after in ("!", "?", "/"):
                at = self._past(html, ">", i + 2)
            else:
                self.handle_data("<")
                at = i + 1

    @staticmethod
    def _past(html: str, mark: str, at: int) -> int:
        i = html.find(mark, at)
        return len(html) if i < 0 else i + len(mark)

    def _tag(self, html: str, i: int, closing: bool) -> int:
        """Handle the tag at ``i``; where it ends, or the end of a page that ends in it."""
        name = _NAME.match(html, i + 1 + closing)
        tag, at = name[0].lower(), name.end()
        attrs: dict[str, str] = {}
        while not (last := _TAG_END.match(html, at)):
            found = _ATTRIBUTE.match(html, at)
            if found:
                value, at = found[2], found.end()
                if value is None and html[at:at + 1] in ('"', "'") and html[at:at + 1]:
                    stop = html.find(">", at)       # a quote that is never closed
                    stop = len(html) if stop < 0 else stop
                    value, at = html[at + 1:stop], stop
                elif value and value[0] in "\"'":
                    value = value[1:-1]
                attrs.setdefault(found[1].lower(), unescape(value or ""))
            elif at < len(html) and html[at] == "=":
                at += 1
            else:
                return len(html)
        at = last.end()
        if closing:
            self.handle_endtag(tag)
            return at
        self.handle_starttag(tag, attrs)
        if tag in RAW_TAGS:
            stop = _raw_end(tag).search(html, at)
            at = stop.start() if stop else len(html)
        elif tag not in VOID_TAGS and "/" in html[last.start():at] and tag in UNSEEN_TAGS:
            self.handle_endtag(tag)                 # <svg/>: nothing inside
        return at


@functools.cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.I)


class _Blocks(_Scanner):
    def __init__(self) -> None:
        self.blocks: list[_Block] = []
        self.parts: list[str] = []
        self.linked: list[str] = []
        # tag, furniture, place, main, the innermost enclosing form or element named as furniture
        self.stack: list[tuple[str, bool, int, bool, int]] = []
        self.on_stack: dict[str, int] = {}
        self.wrapper_of: list[int] = [0]          # the next one outwards of each, 0: none
        self.has_main = False
        self.links = self.unseen = self.places = self.inner = 0
        self.unseen_tag = ""

    def _end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, furniture, place, main, wrapper = self.stack[-1] if self.stack else ("", False, 0, False, 0)
            self.blocks.append(_Block(text, len(" ".join("".join(self.linked).split())), furniture, place, main, wrapper))
        self.parts, self.linked = [], []

    def _skip(self, tag: str) -> None:
        self.unseen, self.unseen_tag, self.inner = 1, tag, 0

    def handle_starttag(self, tag: str, attrs: dict[str, str]) -> None:
        if self.unseen:
            control = self.unseen_tag in _CONTROLS and tag in _FLOW
            if not control and (self.unseen_tag in CONTAINERS or self.unseen_tag in UNSEEN_TAGS or tag not in BLOCK_TAGS):
                self.unseen += tag == self.unseen_tag
                self.inner += tag in CONTAINERS and tag != self.unseen_tag
                return
            self.unseen = 0                       # an unclosed control or paragraph ends where a block begins
        if tag in UNSEEN_TAGS:
            if tag not in VOID_TAGS:
                self._skip(tag)
            return
        if tag in BLOCK_TAGS:
            self._end_block()
            self.links = 0 if tag in CONTAINERS else self.links
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(_HIDDEN_STYLE.search(attrs.get("style", "")))
        if tag not in CONTAINERS and tag not in VOID_TAGS and tag != "html" and (hidden or _named(_LEFT_OUT_NAME, names)):
            self._skip(tag)
            return
        if tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.links = 1                                     # links don't nest
        if tag in CONTAINERS:
            _, furniture, _, inside, wrapper = self.stack[-1] if self.stack else ("", False, 0, False, 0)
            role = attrs.get("role", "").lower()
            begins = tag in MAIN_TAGS or role == "main"
            main = inside or begins
            part = tag not in ("body", "article", "main")
            furniture = (furniture or (tag in FURNITURE_TAGS and tag != "form" and not (tag == "header" and main))
                         or (role in _FURNITURE_ROLE and role != "form") or hidden
                         or (tag != "body" and _named(_COMMENT_NAME, names)))
            by_name = _named(_FURNITURE_NAME, names)
            self.places += 1
            self.has_main = self.has_main or main and not furniture
            if begins and not inside and not by_name:
                wrapper = 0
            elif tag == "form" or role == "form" or (by_name and part):
                self.wrapper_of.append(wrapper)
                wrapper = len(self.wrapper_of) - 1
            self.stack.append((tag, furniture, self.places, main, wrapper))
            self.on_stack[tag] = self.on_stack.get(tag, 0) + 1

    def handle_endtag(self, tag: str) -> None:
        if self.unseen:
            if tag == self.unseen_tag:
                self.unseen -= 1
                return
            if tag not in CONTAINERS or self.inner:
                self.inner -= tag in CONTAINERS
                return
            if not self.on_stack.get(tag):
                return
            self.unseen = 0                       # what encloses the unclosed element ends
        if tag in BLOCK_TAGS:
            self._end_block()
        elif tag == "a":
            self.links = 0
        if tag in CONTAINERS and self.on_stack.get(tag):
            while True:
                top = self.stack.pop()[0]
                self.on_stack[top] -= 1
                if top == tag:
                    break

    def handle_data(self, data: str) -> None:
        if not self.unseen:
            self.parts.append(data)
            if self.links:
                self.linked.append(data)

    def close(self) -> None:
        self._end_block()
        # without article or main, what holds most of the page's text is not furniture
        held = [0] * len(self.wrapper_of)
        total = 0
        for b in self.blocks:
            if not b.furniture:
                total += len(b.text) - b.linked
                held[b.wrapper] += len(b.text) - b.linked
        for w in range(len(held) - 1, 0, -1):     # inner ones have the larger numbers
            if self.wrapper_of[w]:
                held[self.wrapper_of[w]] += held[w]
        named = [False] * len(held)
        for w in range(1, len(held)):
            named[w] = named[self.wrapper_of[w]] or self.has_main or 2 * held[w] <= total
        for b in self.blocks:
            b.furniture = b.furniture or named[b.wrapper]


def _stop_density(text: str) -> float:
    words = text.lower().split()
    letters = ["".join(filter(str.isalpha, w)) for w in words]
    return sum(w in STOP_WORDS for w in letters) / max(1, len(words))


def _candidate(b: _Block) -> bool:
    return not b.furniture and b.linked <= MAX_LINK_DENSITY * len(b.text)


def _knows_language(blocks: list[_Block]) -> bool:
    """Whether at least half of the page's longer text has stop words of the lists."""
    known = total = 0
    for b in blocks:
        if len(b.text) >= SHORT_CHARS and _candidate(b):
            total += len(b.text)
            known += len(b.text) * (_stop_density(b.text) >= STOP_LOW)
    return 2 * known >= total


def _first_pass(b: _Block, known: bool, plain: set[int]) -> bool | None:
    """Text, boilerplate, or None where it stays open. ``known``: stop words tell. ``plain``:
    containers with a block that is not links; a short link among such blocks leads elsewhere,
    while a linked paragraph, or a list of links only, belongs to its article."""
    if not _candidate(b):
        return None if b.main and not b.furniture and (len(b.text) >= SHORT_CHARS or b.place not in plain) else False
    if len(b.text) < SHORT_CHARS:
        return False if "©" in b.text and not b.main else None
    if b.main and len(b.text) >= LONG_CHARS:
        return True
    density = _stop_density(b.text)
    if density >= STOP_HIGH:
        return True if len(b.text) >= LONG_CHARS or b.main else None
    if density >= STOP_LOW or b.main:
        return None
    return not known


def main_blocks(html: str | None) -> list[str]:
    """Texts of the blocks that belong to the article, in page order."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    blocks = parser.blocks
    known = all(b.main for b in blocks) or _knows_language(blocks)
    plain = {b.place for b in blocks if _candidate(b)}
    first = [_first_pass(b, known, plain) for b in blocks]
    # distance to, and label of, the nearest decided block of the same container on each side
    label = list(first)
    near: list[list[tuple[int, bool]]] = [[] for _ in blocks]
    for order in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
        seen: dict[int, tuple[int, bool]] = {}
        for i in order:
            b = blocks[i]
            if first[i] is not None:
                if first[i] or not (b.furniture or b.main):   # links inside an article say nothing about their neighbours
                    seen[b.place] = (i, first[i])
            elif b.place in seen:
                at, got = seen[b.place]
                near[i].append((abs(i - at), got))
    for i, b in enumerate(blocks):
        if first[i] is None:
            if near[i]:
                least = min(d for d, _ in near[i])
                label[i] = any(got for d, got in near[i] if d == least)
            else:
                label[i] = b.main
    if not any(label):                            # a short page, or plain text
        label = [f is None for f in first]
    return [b.text for b, keep in zip(blocks, label) if keep]


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    Null or empty html gives empty text. Repeated rows are extracted one by one; an empty
    table gives an empty result; extra columns are not read. Cut-off pages are read as far
    as they go.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [" ".join(main_blocks(h.as_py())) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], schema=_OUT)

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
