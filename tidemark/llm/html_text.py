"""Main-text extraction from HTML by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass classifies each
block by its length, its share of stop words and its share of link text: good,
bad, or, where it is short, undecided. Blocks within menus, headers, footers,
sidebars, notices, adverts, forms and comments are bad whatever their text. The
second pass lets undecided blocks inherit the class of their nearest decided
neighbours. An article or main tag is evidence: within it, the edges count as good,
short blocks need one good neighbour and a block that only its stop words speak
against is likely good; outside it, the edge to it counts as bad. Blocks outside are
judged like those of a page without the tag. A header within an article is boilerplate
but for its headings, which are the article's title.
On a page without the tag only other text decides, neither edges nor boilerplate: a
heading goes with the text that follows it, a paragraph with its nearest decided
neighbour, any other short block (a cell, a loose line) needs a good one on both sides.
Containers whose class or id alone tells of boilerplate are opened again if the page has no
other text than theirs, unless they are named as adverts, comments or consent notices.
On a page where no block has the stop words of a known language, length and links decide.
"""

from __future__ import annotations

import html
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# HTML elements by their role.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre
    section summary table tbody td tfoot th thead title tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p blockquote pre".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template svg math object noframes".split())
SHUT_TAGS = frozenset("nav header footer aside form menu head button select dialog".split())
# Class and id words of boilerplate containers.
SHUT_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|banner|sponsor|sponsored|promo|cookie|cookies|consent|notice|popup|modal|"
    r"newsletter|subscribe|comment|comments|respond|reply|replies|disqus|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|"
    r"sidebar|aside|widget|related|share|sharing|social|footer|masthead|pagination|login|search)(?:[\s_-]|$)", re.I)
# Those of them that never hold the page's own text.
NEVER_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|banner|sponsor|sponsored|promo|cookie|cookies|consent|popup|modal|"
    r"newsletter|subscribe|comment|comments|respond|reply|replies|disqus)(?:[\s_-]|$)", re.I)
SHUT_ROLES = re.compile(r"role\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|form|alert|dialog|menu)", re.I)
NAMES = re.compile(r"\b(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
TAG = re.compile(r"<(?:!--|(/?)([A-Za-z][^\s/>]*)|[!?])")
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
    a an and are as at be been but by can do for from had has have he her his i if in is it its more not of on one or our
    she so that the their there they this to was we were which who will with would you
    aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einen einer er es für haben hat ich im
    in ist mit nach nicht noch nur oder sich sie sind so über um und von vor war wenn werden wie wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et il ils la le les leur lui mais ne nous on ou par pas plus pour
    qu que qui sa se ses son sont sur un une vous
    al como con cuando de del el ella en entre es esta este fue ha hay la las lo los más muy no o para pero por que se ser
    sin sobre su sus también un una y ya""".split())
WORD = re.compile(r"\w+")

SHORT_CHARS = 70
LONG_CHARS = 200
LOW_STOPS = 0.15
HIGH_STOPS = 0.3
MOST_LINKS = 0.33


class Block:
    __slots__ = ("pieces", "link_chars", "tag", "shut", "article")

    def __init__(self, tag: str, shut: bool, article: int):
        self.pieces: list[str] = []
        self.link_chars = 0
        self.tag = tag
        self.shut = shut
        self.article = article


# What a container does to the blocks in it.
OPEN, SHUT, TITLE = 0, 1, 2  # TITLE: the header of an article, shut but for headings


def blocks_of(page: str, shut_words: re.Pattern = SHUT_WORDS) -> list[Block]:
    """The non-empty blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = [("", OPEN, 0)]  # tag, state, number of the article
    links, articles = 0, 0
    block = Block("", False, 0)

    def text(raw: str) -> None:
        if raw:
            value = html.unescape(raw) if "&" in raw else raw
            block.pieces.append(value)
            if links:
                block.link_chars += len("".join(value.split()))

    def fresh() -> None:
        nonlocal block
        if block.pieces:
            out.append(block)
        block = Block(stack[-1][0], stack[-1][1] != OPEN, stack[-1][2])

    at, size, quotes_end = 0, len(page), {'"': True, "'": True}
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        name = (m[2] or "").lower()
        if not name:
            closer = "-->" if m[0] == "<!--" else ">"
            end = page.find(closer, m.end())
            at = size if end < 0 else end + len(closer)
            continue
        # The tag ends at the first > outside quotes; a quote that never closes is an ordinary character.
        end, quote = m.end(), ""
        while end < size and (page[end] != ">" or quote):
            stop = page.find(">", end)
            if stop < 0:
                end = size
                break
            opened = min((p for q in "\"'" if quotes_end[q] and (p := page.find(q, end, stop)) >= 0), default=-1)
            if opened < 0:
                end = stop
                break
            closed = page.find(page[opened], opened + 1)
            if closed < 0:
                quotes_end[page[opened]] = False
                continue
            end = closed + 1
        attributes = page[m.end():end]
        at = min(size, end + 1)
        if m[1]:
            if name == "a":
                links = max(0, links - 1)
            if name in BLOCK_TAGS or name in SHUT_TAGS:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
                if depth:
                    del stack[depth:]
                links = 0
                fresh()
            continue
        if name in RAW_TAGS:
            close = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
            at = size if close is None else (page.find(">", close.end()) + 1 or size)
            continue
        if name == "br":
            block.pieces.append(" ")
        elif name == "a":
            links += 1
        elif name in BLOCK_TAGS or name in SHUT_TAGS:
            if name == "p" or name[0] == "h" and name[1:].isdigit():  # these end an open paragraph
                while stack[-1][0] == "p":
                    stack.pop()
            state, number = stack[-1][1:]
            if name not in ("body", "html", "article", "main") and boilerplate(attributes, shut_words):
                state = SHUT
            elif state == TITLE and name in HEADINGS:
                state = OPEN
            elif name == "header" and number and state == OPEN:
                state = TITLE
            elif name in SHUT_TAGS and not (name == "header" and state == TITLE):
                state = SHUT
            if name in ("article", "main") and not number and state == OPEN:
                articles += 1
                number = articles
            if name not in VOID_TAGS:
                stack.append((name, state, number))
            links = 0
            fresh()
    if block.pieces:
        out.append(block)
    return out


def boilerplate(attributes: str, shut_words: re.Pattern = SHUT_WORDS) -> bool:
    if not attributes:
        return False
    if SHUT_ROLES.search(attributes):
        return True
    return any(shut_words.search(a or b or c) for a, b, c in NAMES.findall(attributes))


def stop_share(text: str) -> float:
    words = WORD.findall(text)
    return sum(w.lower() in STOP_WORDS for w in words) / len(words) if words else 0.0


def first_pass(text: str, link_chars: int, known: bool = True) -> str:
    """good, bad, near (likely good) or short, by length, links and, in a ``known`` language, stop words."""
    chars = len(text) - text.count(" ")
    if link_chars > MOST_LINKS * chars:
        return "bad"
    stops = stop_share(text) if known else HIGH_STOPS
    if len(text) < SHORT_CHARS:
        return "short"
    if stops >= HIGH_STOPS:
        return "good" if len(text) > LONG_CHARS else "near"
    if stops >= LOW_STOPS:
        return "near"
    return "short" if len(text) <= LONG_CHARS else "bad"


def second_pass(classes: list[str], inside: bool) -> list[bool]:
    """Whether each block of a page with an article stays; undecided ones look to the nearest decided block on either side.

    Within a marked article an end without a decided block counts as good,
    elsewhere as bad. A likely good block stays if either side is good, and so
    does a short one of an article; elsewhere a short one needs both.
    """
    edge = "good" if inside else "bad"
    before, after, last = [], [], edge
    for c in classes:
        before.append(last)
        last = c if c in ("good", "bad") else last
    last = edge
    for c in reversed(classes):
        after.append(last)
        last = c if c in ("good", "bad") else last
    after.reverse()
    keep = []
    for c, a, b in zip(classes, before, after):
        good = (a == "good") + (b == "good")
        keep.append(c == "good" or c == "near" and good >= 1 or c == "short" and good >= (1 if inside else 2))
    return keep


def second_pass_plain(classes: list[str], tags: list[str]) -> list[bool]:
    """Whether each block of a page without an article stays; the ends of the page decide nothing."""
    def decided(order: range) -> list[tuple[str, int]]:
        out, last, distance = [("", 0)] * len(classes), "", 0
        for i in order:
            out[i] = (last, distance + 1)
            last, distance = (classes[i], 0) if classes[i] in ("good", "bad") else (last, distance + 1)
        return out

    before, after = decided(range(len(classes))), decided(range(len(classes) - 1, -1, -1))
    keep = []
    for c, tag, (a, to_a), (b, to_b) in zip(classes, tags, before, after):
        if c in ("good", "bad"):
            keep.append(c == "good")
        elif c == "near":
            keep.append("good" in (a, b))
        elif tag in HEADINGS:
            keep.append(b == "good")
        elif tag in PARAGRAPHS and a != b:
            # The nearest one decides, of two at the same distance the good one; an end is none.
            keep.append(a == "good" and (not b or to_a <= to_b) or b == "good" and (not a or to_b <= to_a))
        else:
            keep.append(a == b == "good")
    return keep


def texts_of(page: str, shut_words: re.Pattern = SHUT_WORDS) -> list[tuple[Block, str]]:
    """The blocks that hold text, with white space as one space."""
    found = [(b, " ".join("".join(b.pieces).split())) for b in blocks_of(page, shut_words)]
    return [(b, t) for b, t in found if t]


def has_own_text(found: list[tuple[Block, str]]) -> bool:
    """Whether any open block is of an article or, by itself, likely good."""
    return any(not b.shut and (b.article or first_pass(t, b.link_chars) in ("good", "near")) for b, t in found)


def main_text(page: str | None) -> str:
    """The main text: blocks joined by two line feeds, white space within a block as one space."""
    found = texts_of(page or "")
    if any(b.shut for b, _ in found) and not has_own_text(found):
        opened = texts_of(page, NEVER_WORDS)
        found = opened if has_own_text(opened) else found
    known = any(not b.shut and len(t) >= SHORT_CHARS and stop_share(t) >= LOW_STOPS for b, t in found)
    classes = ["bad" if b.shut else first_pass(t, b.link_chars, known) for b, t in found]
    # Tables and lists of an article have few stop words: there these alone do not reject a block.
    classes = ["near" if c == "bad" and b.article and not b.shut and b.link_chars <= MOST_LINKS * len(t) else c
               for c, (b, t) in zip(classes, found)]
    # Without a good block, likely good ones decide, and without those the short ones; those of an article first.
    for weaker in ("near", "short"):
        if "good" not in classes:
            inside = any(c == weaker and b.article for c, (b, _) in zip(classes, found))
            classes = ["good" if c == weaker and (b.article or not inside) else c for c, (b, _) in zip(classes, found)]
    if not any(b.article for b, _ in found):
        # Nor is a boilerplate container a neighbour to the text of a page without an article.
        own = [i for i, (b, _) in enumerate(found) if not b.shut]
        keep = second_pass_plain([classes[i] for i in own], [found[i][0].tag for i in own])
        return "\n\n".join(found[i][1] for i, k in zip(own, keep) if k)
    stays = [False] * len(found)
    for number, run in groupby(range(len(found)), key=lambda i: found[i][0].article):
        # A boilerplate container within an article is no neighbour to its text.
        own = [i for i in run if not (number and found[i][0].shut)]
        for i, keep in zip(own, second_pass([classes[i] for i in own], number > 0)):
            stays[i] = keep
    return "\n\n".join(t for (_, t), keep in zip(found, stays) if keep)


def main_text_column(page: Column) -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], type=pa.string())

    return extract(page)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``pages`` with their main ``text`` instead of ``html_col``'s markup: ``id_col``, url if any, text, n_chars.

    Defined cases: null, empty or text-free pages give an empty text; unclosed
    tags end with their container or the page; headings within the header of an
    article are its title and stay; a repeated page gives a repeated
    row; all other columns are dropped.
    """
    columns = [F.col(id_col).alias("id"), *([F.col("url")] if "url" in pages.columns else [])]
    found = pages.select(*columns, main_text_column(F.col(html_col).cast("string")).alias("text"))
    return found.select(F.col("id").alias(id_col), *found.columns[1:], F.length("text").cast("long").alias("n_chars"))
