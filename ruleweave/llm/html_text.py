"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags.  Pass 1 classifies each block by
itself: links take most of it outside an article, or it stands in a part of the page that is not the
article (navigation, forms, comments, ...): *bad*; long enough with enough stop words:
*good*; anything else is left *open*.  On a page without a single good block (a language without listed stop
words) length alone decides.  Articles are the main text unless more good text stands outside them (teasers).  Pass 2 gives every open block the label of its
nearest decided neighbours inside the same article (or the page, if it has none): of
both sides if they agree, else of the nearer one, bad if they are equally far.  With no
decided neighbour, blocks of an article are good and others bad.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.common import map_slices

#: A block of at least this many characters ...
LONG = 60
#: ... with this share of stop words is good, and one with this share of its text in links is bad.
STOP_SHARE = 0.08
LINK_SHARE = 0.5
#: Without stop words: enough characters of a block whose words are on average longer than this.
UNSPACED, UNSPACED_WORD = 20, 12

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
the of and to in a is that for it was on are with as be this at by from or an not have
der die das und ist in zu den von mit ein eine auf für im nicht als auch dem des sich
le la les de du des et un une est que qui dans pour sur au par en ce pas plus
el los las y del una por con se su al lo para es no
""".split())
# Tags that end a block, tags whose content is no text, tags outside the article.
BLOCK_TAGS = frozenset("""
address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td
tfoot th thead title tr ul
""".split())
SILENT_TAGS = ("script", "style", "noscript", "template", "svg", "iframe", "object", "title", "textarea", "canvas")
#: Of these an unclosed one takes the rest of the page; other unclosed ones have no content.
RAW_TAGS = frozenset(("script", "style"))
HEAD_TAGS = frozenset("base bgsound link meta noscript script style template title".split())
OUTER_TAGS = frozenset("nav footer aside form menu dialog button select".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id and role that name such parts.
OUTER_NAMES = frozenset("""
ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice
alert popup modal overlay newsletter subscribe nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget footer
masthead comment comments commentlist disqus reply replies respond related recommended share sharing social login signup
search pagination pager toolbar complementary contentinfo
""".split())
# Words that may stand beside them in a compound name.
LAYOUT_NAMES = frozenset("""
area bar block body bottom box btn button center col column container content desktop element fixed form global group header
id inner item items js large left level link links list main middle mobile modern module outer page panel post posts primary
region right row rows secondary section side site slot small sticky sub text title top unit wrap wrapper
""".split())
# Names of articles that are not the main text.
OTHER_ARTICLES = frozenset("comment comments reply ad sponsored related".split())

TOKEN = re.compile(
    r"<!--(?:.*?-->|[^>]*>?)|<(?P<silent>" + "|".join(SILENT_TAGS) + r")(?=[\s/>])(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>?)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>?)|<[!?/][^>]*>?",
    re.DOTALL | re.IGNORECASE)
ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.IGNORECASE) for t in SILENT_TAGS}
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/>]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SPLIT = re.compile(r"[^a-z]+")
WORDS = re.compile(r"[^\W\d_]+")
SPACES = re.compile(r"\s+")

GOOD, BAD, OPEN = 1, -1, 0


def _named(attrs: str, names: frozenset) -> bool:
    """A class, id or role is one of ``names``, or a compound of one with layout words (``share-bar``, not ``share-price``)."""
    for m in NAMES.finditer(attrs):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = [w for w in SPLIT.split(CAMEL.sub("-", name).lower()) if w]
            if any(w in names for w in parts) and all(w in names or w in OUTER_NAMES or w in LAYOUT_NAMES for w in parts):
                return True
    return False


class Block:
    __slots__ = ("text", "links", "outer", "room", "inside")

    def __init__(self, text: str, links: int, outer: bool, room: int, inside: bool):
        self.text, self.links, self.outer, self.room, self.inside = text, links, outer, room, inside


class Reader:
    """Collects the blocks of a page from its tags and texts; every step takes constant time, amortised."""

    def __init__(self):
        self.out: list[Block] = []
        self.parts: list[str] = []
        self.stack: list[tuple[str, int, int, int]] = []  # tag; parts outside the article, mute elements and article from here on
        self.open: dict[str, int] = {}
        self.links = self.rooms = 0
        self.in_link = self.in_head = False

    def _here(self) -> tuple[int, int, int]:
        return self.stack[-1][1:] if self.stack else (0, 0, 0)

    def flush(self) -> None:
        text = SPACES.sub(" ", html.unescape("".join(self.parts))).strip()
        if text:
            outer, _, room = self._here()
            self.out.append(Block(text, self.links, outer > 0, room, room > 0))
        self.parts.clear()
        self.links = 0

    def say(self, raw: str) -> None:
        if self.in_head and raw.strip():
            self.in_head = False
        if raw and not self._here()[1]:
            self.parts.append(raw)
            if self.in_link:
                self.links += len(raw.strip())

    def _pop(self) -> None:
        tag = self.stack.pop()[0]
        self.open[tag] -= 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag in BLOCK_TAGS:
            self.flush()
            self.in_link = False
        if self.open.get(tag):
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def begin(self, tag: str, attrs: str) -> None:
        if tag == "head":
            self.in_head = True
        elif tag not in HEAD_TAGS:
            self.in_head = False
        if tag == "br":
            self.say(" ")
        elif tag == "a":
            self.in_link = True
        block = tag in BLOCK_TAGS
        if block:
            self.flush()
            self.in_link = False
        if tag in VOID_TAGS:
            return
        if tag == "p" and self.stack and self.stack[-1][0] == "p":  # a paragraph ends the one before
            self._pop()
        outer, mute, room = self._here()
        aside = tag in OUTER_TAGS or bool(HIDDEN.search(attrs))
        if not block:
            if not aside:
                return
            mute += 1  # inside a block: its text goes, the block stays whole
        else:
            if not aside and tag not in ("html", "body", "main"):
                aside = (tag == "header" and not room) or _named(attrs, OTHER_ARTICLES if tag == "article" else OUTER_NAMES)
            outer += aside
            if tag in ("article", "main") and not aside:
                self.rooms += 1
                room = self.rooms
        self.stack.append((tag, outer, mute, room))
        self.open[tag] = self.open.get(tag, 0) + 1


def blocks(page: str) -> list[Block]:
    """Non-empty blocks in page order; ``room`` numbers the article a block is in (0: none), ``outer`` marks other parts."""
    reader = Reader()
    endless: set[str] = set()  # silent tags that are not closed any more
    at = 0
    while m := TOKEN.search(page, at):
        reader.say(page[at:m.start()])
        at = m.end()
        if m["silent"]:
            name = m["silent"].lower()
            if name not in HEAD_TAGS:
                reader.in_head = False
            if m["rest"].rstrip(">").endswith("/") and name == "svg" or name in endless:
                continue
            end = ENDS[name].search(page, at)
            if end:
                at = end.end()
            elif name in RAW_TAGS:
                at = len(page)
            else:
                endless.add(name)
        elif m["tag"]:
            if m["close"]:
                reader.end(m["tag"].lower())
            else:
                reader.begin(m["tag"].lower(), m["attrs"])
    reader.say(page[at:])
    reader.flush()
    return reader.out


def first_pass(block: Block, by_stops: bool = True) -> int:
    n = len(block.text)
    if block.outer:
        return BAD
    if block.links > LINK_SHARE * n:
        return OPEN if block.inside else BAD
    words = WORDS.findall(block.text.lower())
    if not words:
        return OPEN
    if by_stops:
        return GOOD if n >= LONG and sum(w in STOP_WORDS for w in words) >= STOP_SHARE * len(words) else OPEN
    # scripts without spaces between words say more in fewer characters
    return GOOD if n >= (UNSPACED if n > UNSPACED_WORD * len(words) else LONG) else OPEN


def second_pass(found: list[Block], labels: list[int]) -> list[int]:
    """Open blocks take over the label of the nearest decided neighbours in their room."""
    out = list(labels)
    rooms: dict[int, list[int]] = {}
    for i, b in enumerate(found):
        if not b.outer:
            rooms.setdefault(b.room, []).append(i)
    for room, at in rooms.items():
        before, seen = [], None
        for k, i in enumerate(at):
            before.append(seen)
            if labels[i]:
                seen = k
        after: list = [None] * len(at)
        seen = None
        for k in range(len(at) - 1, -1, -1):
            after[k] = seen
            if labels[at[k]]:
                seen = k
        for k, i in enumerate(at):
            if labels[i]:
                continue
            left, right = before[k], after[k]
            near = [(abs(k - x), labels[at[x]]) for x in (left, right) if x is not None]
            if not near:
                out[i] = GOOD if room else BAD
            else:
                least = min(d for d, _ in near)
                out[i] = min(label for d, label in near if d == least)
    return out


def labelled(found: list[Block]) -> list[int]:
    """Both passes."""
    labels = [first_pass(b) for b in found]
    if GOOD not in labels:
        labels = [first_pass(b, by_stops=False) for b in found]
    # a page with articles is its articles, unless more good text stands around them
    size = lambda inside: sum(len(b.text) for b, label in zip(found, labels) if label == GOOD and b.inside == inside)
    if any(b.inside and not b.outer for b in found):
        if size(True) >= size(False):
            labels = [label if b.inside else BAD for b, label in zip(found, labels)]
        else:
            for b in found:
                b.room = 0
    return second_pass(found, labels)


def main_text(page: str) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, label in zip(found, labelled(found)) if label == GOOD)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``<id, url, text, n_chars>``, one row per page.

    Null and empty pages, and pages without main text, give an empty text.  Of broken pages an unclosed head ends where
    its content can't stand in a head, and an unclosed script or style takes the rest.
    Whole pages are read; repeated rows and null ids are kept; other columns are not read.
    """
    id_type = pages.schema[id_col].dataType.simpleString()

    def make():
        def fn(ids, urls, htmls):
            texts = [main_text(h) if h else "" for h in htmls]
            return [ids, urls, texts, [len(t) for t in texts]]

        return fn

    return map_slices(pages.select(F.col(id_col), F.col(url_col), F.col(html_col)), make,
                      f"`{id_col}` {id_type}, url string, text string, n_chars bigint")
