"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags.  What stands in scripts, styles,
forms, menus, headers, footers, sidebars, notices, adverts and reader comments
(by element, role, or a name in class or id) is no block.  A name counts if it says
nothing else: ``sidebar``, ``cookie-notice`` and ``site-footer-links`` do,
``has-sidebar``, ``no-comments`` and ``legal-analysis`` don't.  An article or main
element inside a form or a part marked by such a name starts afresh; only articles
among reader comments and recommendations remain part of those.

The first pass decides each block by the share of its letters inside links, its
length and the share of stop words among its words:

    link density above 0.5, or above 0.2 in a block without many stop words   bad, in an article open
    under 70 characters                               short: bad with links outside articles, else open
    stop words from 0.25 up                                              good
    stop words from 0.12 up                                              open (near good)
    fewer                                                                bad, in an article open

Stop words are those of English, German, French and Spanish.  On a page without any
article or main element and without a good block, whose words outside links are
nearly never (under 12 %) stop words, blocks from 70 characters up with a link
density of at most 0.2 are good: it is likely in another language.

The second pass gives open blocks the label of the nearest decided neighbours:
if both sides have the same, that; else the nearer's (by characters between);
the near good and those in an article lean to good.  The ends of a page count as
bad, the ends of an article or main element as good.

The text keeps every good block in page order, joined by one \\n.  Inside a block
white space becomes one blank and character references are decoded; nothing else
is dropped or shortened.

Null and empty pages, and pages without good blocks, give the empty text.  Broken
markup is read on: elements left open end with their parent or the page, an
unfinished tag ends the page, a quote that is never closed is a character, a stray end
tag is ignored.  Character references are decoded in each piece of text between tags.
Reading takes linear time, whatever the markup.  Repeated rows give
repeated results, an empty table an empty one; other columns pass through (named
like an added one: replaced).
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import add_columns
from .stopwords import ALL

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)", re.DOTALL,
)
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[^\W\d_]+")

RAW = frozenset("script style noscript template textarea xmp iframe noembed noframes title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset("head nav footer aside form dialog menu search select button object svg math canvas audio video datalist".split())
#: Words of a name in class or id that mark what isn't the main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices alert popup modal overlay sidebar aside widget widgets menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead topbar toolbar comment comments disqus reply replies respond share sharing social related "
    "recommended recommendations newsletter subscribe subscription signup login pagination pager copyright legal disclaimer".split()
)
#: The same in an article, whose own words may name its parts otherwise.
COMMENT_MARKS = frozenset("comment comments disqus reply replies respond".split())
#: Marks of parts whose articles aren't the page's own.
OTHERS_MARKS = COMMENT_MARKS | frozenset("related recommended recommendations".split())
#: Words that may stand before and behind the marks of a name: where or in what the marked part is.
BEFORE = frozenset("site main page primary secondary global top bottom left right post article entry mobile".split())
BEHIND = frozenset(
    "area bar block bottom box button buttons container form inner item items label left link links list panel posts right row "
    "section slot top unit wrap wrapper".split()
)
#: How far an element is unwanted: not, but for an article or main element in it, but for a main element in it, wholly.
WANTED, MARKED, OTHERS, UNWANTED = range(4)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: An element that ends one of the same kind left open, unless one of the second set stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SHORT, LINKED, SOME_LINKED, MANY, SOME = 70, 0.5, 0.2, 0.25, 0.12
GOOD, BAD, SHORT_OPEN, NEAR_GOOD = "good", "bad", "short", "near good"


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(text)}


def _marks(names: str) -> frozenset[str]:
    """Words of MARKS in those names that consist of them, but for words before and behind."""
    found: set[str] = set()
    for name in names.lower().split():
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w and not w.isdigit()]
        while words and words[0] in BEFORE:
            del words[0]
        while words and words[-1] in BEHIND:
            del words[-1]
        if all(w in MARKS for w in words):
            found.update(words)
    return frozenset(found)


def _unwanted(tag: str, attrs: str, in_article: bool) -> int:
    """Whether an element holds no main text, and how far."""
    if tag in DROPPED and tag != "form" or tag == "header" and not in_article:
        return UNWANTED
    level = MARKED if tag == "form" else WANTED
    if not attrs or attrs.isspace():
        return level
    got = _attributes(attrs)
    if "hidden" in got or got.get("aria-hidden") == "true" or got.get("role", "").lower() in ROLES:
        return UNWANTED
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", got.get("style", "").lower()):
        return UNWANTED
    if tag in ("html", "body", "main"):
        return level
    marks = _marks(f"{got.get('class', '')} {got.get('id', '')}")
    if tag == "article":
        marks &= COMMENT_MARKS
    return OTHERS if marks & OTHERS_MARKS else MARKED if marks else level


def _tag_end(page: str, at: int) -> int:
    """Place of the ``>`` that ends a tag whose attributes begin at ``at``; the page's length if there is none.

    A quote behind an equals sign hides what it encloses; one that is never closed, or stands elsewhere, is a character.
    """
    while stop := _STOP.search(page, at):
        if stop.group() == ">":
            return stop.start()
        before = stop.start() - 1
        while before >= at and page[before].isspace():
            before -= 1
        at = stop.end()
        if before >= 0 and page[before] == "=":
            closed = page.find(stop.group(), at)  # without success at most once for either kind of quote
            at = closed + 1 if closed >= 0 else at
    return len(page)


class Block:
    __slots__ = ("text", "linked", "article")

    def __init__(self, text: str, linked: int, article: int):
        self.text, self.linked, self.article = text, linked, article


def blocks(page: str) -> list[Block]:
    """Blocks in page order; ``article`` is the number of the article or main element around it, 0 for none."""
    found: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # open elements: name, unwanted, article
    places: defaultdict[str, list[int]] = defaultdict(list)  # where elements of each name are in it
    parts: list[str] = []
    links: list[str] = []
    in_link, articles, at = False, 0, 0

    def close_block() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append(Block(text, len(" ".join("".join(links).split())), stack[-1][2] if stack else 0))
            parts.clear()
            links.clear()

    def hear(text: str) -> None:
        if text and not (stack and stack[-1][1]):
            parts.append(text)
            if in_link:
                links.append(text)

    def pop_to(index: int) -> None:
        close_block()
        while len(stack) > index:
            places[stack.pop()[0]].pop()

    def nearest(names: Iterable[str]) -> int:
        return max((places[name][-1] for name in names if places[name]), default=-1)

    while at < len(page):
        token = _TOKEN.search(page, at)
        if token is None:
            hear(html.unescape(page[at:]))
            break
        hear(html.unescape(page[at : token.start()]))
        at = token.end()
        if token["data"] is not None:
            hear(token["data"])
            continue
        if token["tag"] is None:
            continue
        stop = _tag_end(page, at)
        if stop == len(page):  # an unfinished tag ends the page
            break
        tag, attrs = token["tag"].lower(), page[at:stop]
        at = stop + 1
        if token["end"]:
            if tag == "a":
                in_link = False
            elif tag == "br" or tag == "p" and not places["p"]:
                hear(" ")
            if places[tag]:
                pop_to(places[tag][-1])
            continue
        if tag in RAW:
            raw_end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = raw_end.end() if raw_end else len(page)
            continue
        if tag == "a":
            in_link = "href" in attrs.lower()
        if tag == "br":
            hear(" ")
        if tag in BLOCKS:
            if tag != "head" and places["head"]:  # left open
                pop_to(places["head"][0])
            close_block()
            in_link = False
            if stack and stack[-1][0] == "p":
                places[stack.pop()[0]].pop()
            kinds, walls = CLOSES.get(tag, ((), ()))
            index = nearest(kinds)
            if index > nearest(walls):
                pop_to(index)
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
            continue
        inside = stack[-1] if stack else ("", WANTED, 0)
        afresh = inside[1] < (UNWANTED if tag == "main" else OTHERS if tag == "article" else WANTED)
        bad = max(WANTED if afresh else inside[1], _unwanted(tag, attrs, inside[2] > 0))
        article = inside[2]
        if tag in ("article", "main") and not bad:
            articles += 1
            article = article or articles
        if tag in BLOCKS or bad > inside[1]:
            if tag not in BLOCKS:  # an unwanted part of a line
                parts.append(" ")
            places[tag].append(len(stack))
            stack.append((tag, bad, article))
    close_block()
    return found


def first_pass(block: Block) -> str:
    """Label of a block by itself."""
    words = _WORD.findall(block.text.lower())
    stop = sum(w in ALL for w in words) / max(len(words), 1)
    density, size = block.linked / len(block.text), len(block.text)
    if density > LINKED or density > SOME_LINKED and stop < MANY:
        return SHORT_OPEN if block.article else BAD
    if size < SHORT:
        return BAD if block.linked and not block.article else SHORT_OPEN
    if stop >= MANY:
        return GOOD
    if stop >= SOME:
        return NEAR_GOOD
    return SHORT_OPEN if block.article else BAD


def other_language(found: list[Block], labels: list[str]) -> list[str]:
    """The labels, with long link-poor blocks good where no article and no stop words tell the main text."""
    if GOOD in labels or any(b.article for b in found):
        return labels
    long = [len(b.text) >= SHORT and b.linked / len(b.text) <= SOME_LINKED for b in found]
    words = [w for b, ok in zip(found, long) if ok for w in _WORD.findall(b.text.lower())]
    if sum(w in ALL for w in words) >= SOME * len(words):
        return labels
    return [GOOD if ok else label for ok, label in zip(long, labels)]


def second_pass(found: list[Block], labels: list[str]) -> list[bool]:
    """Whether each block is main text."""
    n, out = len(found), [label == GOOD for label in labels]
    ahead: list[tuple[bool, int]] = [(False, 0)] * n  # nearest decided label before a block, and the characters between
    last, gap, article = False, 0, 0
    for i in range(n):
        if found[i].article != article:
            last, gap, article = bool(found[i].article), 0, found[i].article
        ahead[i] = (last, gap)
        if labels[i] in (GOOD, BAD):
            last, gap = labels[i] == GOOD, 0
        else:
            gap += len(found[i].text)
    last, gap, article = False, 0, 0
    for i in range(n - 1, -1, -1):
        if found[i].article != article:
            last, gap, article = bool(found[i].article), 0, found[i].article
        if labels[i] in (GOOD, BAD):
            last, gap = labels[i] == GOOD, 0
            continue
        before, between = ahead[i]
        lean = labels[i] == NEAR_GOOD or bool(found[i].article)
        out[i] = before if before == last else lean if lean or between == gap else before if between < gap else last
        gap += len(found[i].text)
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    keep = second_pass(found, other_language(found, [first_pass(b) for b in found]))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract(df: DataFrame, source: str = "html", text: str = "text") -> DataFrame:
    """Add ``text`` and n_chars (its code points)."""

    def run(column: pa.Array) -> list[pa.Array]:
        texts = [main_text(page) for page in column.to_pylist()]
        return [pa.array(texts, type=pa.string()), pa.array(list(map(len, texts)), type=pa.int64())]

    return add_columns(df, source, f"`{text}` string, n_chars bigint", run)
