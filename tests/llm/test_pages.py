"""Main-text extraction against a plain second form: a tree of elements, each rule read off a block's ancestors."""

import random
from html.parser import HTMLParser

import pytest

from tidemark.llm import html_text, queries
from tidemark.llm.html_text import BLOCK_TAGS, HEADINGS, PARAGRAPHS, RAW_TAGS, SHUT_TAGS, VOID_TAGS

SF = "/root/testdata/sf0.001"
LONG = "This is what the page has to say, and it is for those who will read all of it with us. " * 4
CODES = "XK-2291 QT-8837 ZP-1045 " * 12


class Element:
    def __init__(self, tag, attributes, parent):
        self.tag, self.attributes, self.parent = tag, attributes, parent

    def path(self):
        """From the page down to this element."""
        return [*(self.parent.path() if self.parent else []), self]


class Tree(HTMLParser):
    """Runs of (element, [(text, within a link)]) between block boundaries."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.at, self.runs, self.raw, self.links = Element("", [], None), [], None, 0
        self.boundary()

    def boundary(self):
        self.runs.append((self.at, []))
        self.links = 0

    def handle_starttag(self, tag, attributes):
        if self.raw:
            return
        if tag in RAW_TAGS:
            self.raw = tag
        elif tag == "br":
            self.runs[-1][1].append((" ", False))
        elif tag == "a":
            self.links += 1
        elif tag in BLOCK_TAGS | SHUT_TAGS:
            while self.at.tag == "p" and (tag == "p" or tag in HEADINGS):
                self.at = self.at.parent
            self.at = self.at if tag in VOID_TAGS else Element(tag, attributes, self.at)
            self.boundary()

    def handle_endtag(self, tag):
        if self.raw:
            self.raw = None if tag == self.raw else self.raw
        elif tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in BLOCK_TAGS | SHUT_TAGS:
            named = [e for e in self.at.path() if e.tag == tag]
            if named:
                self.at = named[-1].parent
            self.boundary()

    def handle_data(self, text):
        if not self.raw:
            self.runs[-1][1].append((text, self.links > 0))


def by_name(element, words):
    if element.tag in ("", "body", "html", "article", "main"):
        return False
    return any(words.search(v or "") for k, v in element.attributes if k in ("class", "id")) or any(
        k == "role" and html_text.SHUT_ROLES.match(f"role={v}") for k, v in element.attributes)


def is_shut(path, words):
    """Shut by a container; an article's header spares its headings."""
    number, title = False, False
    for i, e in enumerate(path):
        if by_name(e, words):
            return True
        if title and e.tag in HEADINGS:
            title = False
        elif e.tag == "header" and number:
            title = True
        elif e.tag in SHUT_TAGS:
            return True
        number = number or e.tag in ("article", "main")
    return title


def article_of(path, words):
    for i, e in enumerate(path):
        if e.tag in ("article", "main") and not is_shut(path[:i + 1], words):
            return e
    return None


def plain_blocks(page, words):
    tree = Tree()
    tree.feed(page)
    tree.close()
    out = []
    for element, parts in tree.runs:
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            path = element.path()
            links = sum(len("".join(t.split())) for t, link in parts if link)
            out.append((text, links, element.tag, is_shut(path, words), article_of(path, words)))
    return out


def look(classes, i, step):
    """(class, distance) of the nearest decided block in one direction."""
    j = i + step
    while 0 <= j < len(classes):
        if classes[j] in ("good", "bad"):
            return classes[j], abs(i - j)
        j += step
    return None, None


def plain_text(page):
    def own(blocks):
        return [b for b in blocks if not b[3] and (b[4] or html_text.first_pass(b[0], b[1]) in ("good", "near"))]

    blocks = plain_blocks(page, html_text.SHUT_WORDS)
    if any(b[3] for b in blocks) and not own(blocks):
        opened = plain_blocks(page, html_text.NEVER_WORDS)
        blocks = opened if own(opened) else blocks
    known = any(not b[3] and len(b[0]) >= 70 and html_text.stop_share(b[0]) >= 0.15 for b in blocks)
    classes = []
    for text, links, _, shut, article in blocks:
        c = "bad" if shut else html_text.first_pass(text, links, known)
        classes.append("near" if c == "bad" and article and not shut and links <= 0.33 * len(text) else c)
    for weaker in ("near", "short"):
        if "good" not in classes:
            best = [i for i, c in enumerate(classes) if c == weaker]
            best = [i for i in best if blocks[i][4]] or best
            classes = ["good" if i in best else c for i, c in enumerate(classes)]
    marked = any(b[4] for b in blocks)
    kept = []
    for i, (text, _, tag, shut, article) in enumerate(blocks):
        # The blocks that this one can look to: its run within or outside an article.
        first, last = i, i + 1
        while marked and first and blocks[first - 1][4] is article:
            first -= 1
        while marked and last < len(blocks) and blocks[last][4] is article:
            last += 1
        if not marked:
            first, last = 0, len(blocks)
        near = [j for j in range(first, last) if j == i or not (blocks[j][3] and (article or not marked))]
        (a, da), (b, db) = (look([classes[j] for j in near], near.index(i), step) for step in (-1, 1))
        if marked:
            a, b = a or ("good" if article else "bad"), b or ("good" if article else "bad")
        goods = (a == "good") + (b == "good")
        c = classes[i]
        if shut and (article or not marked):
            keep = False
        elif c in ("good", "bad"):
            keep = c == "good"
        elif c == "near":
            keep = goods > 0
        elif marked:
            keep = goods >= (1 if article else 2)
        elif tag in HEADINGS:
            keep = b == "good"
        elif tag in PARAGRAPHS and goods == 1:
            other = (db if a == "good" else da)
            keep = other is None or (da if a == "good" else db) <= other
        else:
            keep = goods == 2
        if keep:
            kept.append(text)
    return "\n\n".join(kept)


def test_whole_table_equals_the_plain_form(spark):
    got = {r.page_id: r.text for r in queries.op9_main_text(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    assert got == {p.page_id: plain_text(p.html or "") for p in pages}


def some_page(rng):
    texts = ["Short one.", "And so to the end of it.", LONG, CODES, "It is of use to all who would read it, and more so in the long run.", "Fish &amp; chips"]
    tags = ["p", "h1", "h2", "div", "li", "ul", "td", "section", "article", "main", "header", "footer", "nav", "aside", "b", "a", "pre", "hr"]
    names = ["", "", "", " class='related'", " class=comments", " id=\"widget\"", " class='post body'", " role=search"]

    def inside(depth):
        out = ""
        for _ in range(rng.randint(1, 4)):
            tag = rng.choice(tags)
            body = rng.choice(texts) if depth == 0 or rng.random() < .5 else inside(depth - 1)
            out += f"<{tag}{rng.choice(names)}>{body}" + ("" if rng.random() < .1 or tag == "hr" else f"</{tag}>")
        return out

    return inside(3)


def test_random_pages_equal_the_plain_form():
    rng = random.Random(5)
    for _ in range(3000):
        page = some_page(rng)
        assert html_text.main_text(page) == plain_text(page), page


@pytest.mark.parametrize("page, text", [
    # Heading and closing paragraph of a page without an article; its footer and menu are no neighbours.
    (f"<nav>Menu of all</nav><h1>Title</h1><p>{LONG}</p><p>So it ends.</p><footer>Imprint</footer>", f"Title\n\n{LONG.strip()}\n\nSo it ends."),
    # A heading goes with what follows it, a loose line needs text on both sides.
    (f"<div>Home</div><p>{LONG}</p><h2>More</h2><ul><li><a>one two three four</a></li></ul><div>2020</div>", LONG.strip()),
    # The nearest decided neighbour, not the other one.
    (f"<p>{LONG}</p><p>Near the text.</p><p>Far from it.</p><p>Near the code.</p><p>{CODES}</p>", f"{LONG.strip()}\n\nNear the text.\n\nFar from it."),
    # The title within an article's header stays, its other lines go.
    (f"<article><header><div><h1>Title</h1></div><p>By me</p></header><p>{LONG}</p></article>", f"Title\n\n{LONG.strip()}"),
    (f"<header><h1>Site</h1></header><article><p>{LONG}</p></article>", LONG.strip()),
    # Containers that hold all the text of the page.
    *((f"<div class='{name}'><h1>Title</h1><p>{LONG}</p></div>", f"Title\n\n{LONG.strip()}")
      for name in ("search-results", "related", "share", "notice", "widget")),
    (f"<div id=widget><article><p>Short.</p></article></div><div>Menu</div>", "Short."),
    (f"<div class=related>{LONG}</div><article><p>Own.</p></article>", "Own."),
    (f"<div class=comments><p>{LONG}</p></div><p>Own.</p>", "Own."),
])
def test_containers_and_headings(page, text):
    assert html_text.main_text(page) == text == plain_text(page)


def test_page_of_a_megabyte(spark):
    body = "".join(f"<h2>Part {i}</h2><p>{LONG}</p><p>End of {i}.</p>" for i in range(3000))
    page = f"<body><nav><a href=x>Menu</a></nav>{body}<footer>Imprint</footer></body>"
    assert len(page) > 1_000_000
    text = "\n\n".join(t for i in range(3000) for t in (f"Part {i}", LONG.strip(), f"End of {i}."))
    rows = spark.createDataFrame([(1, page), (1, page)], "page_id long, html string")
    assert [(r.text, r.n_chars) for r in html_text.extract(rows).collect()] == [(text, len(text))] * 2
