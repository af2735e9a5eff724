"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags.  The first pass decides blocks:
those in a menu, header, footer, sidebar, notice, advert, form or comment
section are boilerplate.  If the page marks its article (by an element or by a name),
the other blocks in it are content, whatever they look like, and those outside are not.
Otherwise blocks made mostly of links are boilerplate, and long blocks with
many stop words content; the rest stays ambiguous: short blocks, headings of one
link, and blocks with few stop words (their language may have none that are
listed).  The second pass gives each ambiguous block the label of the nearest decided
block, the better label when two are equally near; on a page without any block
decided as content it is content.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of the languages that pages are written in.
STOP_WORDS = frozenset("""
a an and are as at be by for from has have he in is it its of on or that the they this to was were which will with
aber als auch auf aus bei das dem den der des die ein eine er es für im ist mit nicht sich sie sind und von zu
au aux avec ce dans de des du elle en est et il la le les mais ne ou par pas pour que qui se sur un une
al como con de del el en es la las lo los más no para pero por que se sin su un una y
""".split())
# HTML's elements by their role in a page.
BLOCK_TAGS = frozenset("""
address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead
tr ul
""".split())
RAW_TAGS = frozenset("script style textarea title iframe noembed noframes xmp template noscript svg math select".split())
BOILER_TAGS = frozenset("nav footer aside menu dialog button head".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN_TAGS = frozenset("article main".split())
# Names never make these boilerplate: they hold a page or its text.
WHOLE_TAGS = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, id and role names that tell what a container is for, when
# they are the name or its last word (``left-sidebar``), or its first word before a word for
# a piece of page (``menu-item``); and words by which a name tells of a state or a relation
# to something else.  ``share-prices`` or ``header-wrap`` are names of none of these.
BOILER_NAMES = frozenset("""
ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation
breadcrumb breadcrumbs sidebar aside complementary rail widget footer contentinfo masthead topbar cookie cookies consent
gdpr notice notices notification alert popup modal overlay newsletter subscribe signup login search share sharing social
related recommended teaser toolbar pagination pager comment comments commentlist respond disqus reply replies copyright
""".split())
PIECE_NAMES = frozenset("""
area bar block box button buttons bottom col column form group icon icons inner item items left line link links list lists
outer panel right section slot text title top unit widget
""".split())
STATE_NAMES = frozenset("""
has no not with without open opened closed enabled disabled
""".split())
HEADER_NAMES = frozenset("header head".split())
MAIN_NAMES = frozenset("article main content post entry story".split())

LONG_CHARS = 140
SHORT_CHARS = 60
STOP_DENSITY = 0.12
LINK_DENSITY = 0.5

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"']+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none""", re.I)
_RAW_ENDS = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW_TAGS}
_WORD = re.compile(r"[^\W\d_]+")
GOOD, BAD, AMBIGUOUS = 1, 0, None


class _Open:
    """An open element: whether it is boilerplate or main content, itself or by
    an ancestor, and the number of the main container around it."""

    __slots__ = ("name", "boiler", "main", "link", "forms")

    def __init__(self, name: str, boiler: bool, main: int, link: bool, forms: tuple[int, ...] = ()):
        self.name, self.boiler, self.main, self.link, self.forms = name, boiler, main, link, forms


class Block:
    __slots__ = ("text", "linked", "boiler", "main", "forms", "heading", "label")

    def __init__(self, text: str, linked: int, boiler: bool, main: int, forms: tuple[int, ...] = (), heading: bool = False):
        self.text, self.linked, self.boiler, self.main = text, linked, boiler, main
        self.forms, self.heading = forms, heading
        self.label: int | None = None


def _names(attributes: str) -> set[str]:
    """What the names of an element say it is.  A name with a word of STATE_NAMES
    (``has-sidebar``, ``comments-open``) says nothing about the element itself."""
    found = set()
    for _, value in _NAMES.findall(attributes):
        for name in value.strip("\"'").split():
            words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
            if words and STATE_NAMES.isdisjoint(words):
                found.add(words[-1])
                if len(words) > 1 and words[-1] in PIECE_NAMES:
                    found.add(words[0])
    return found


def blocks(page: str) -> list[Block]:
    """Blocks with text in page order.  Unfinished markup at the end of a cut page
    is dropped; elements left open end with the page."""
    out: list[Block] = []
    stack = [_Open("", False, 0, False)]
    parts: list[str] = []
    linked = 0
    mains = forms = 0
    tag = _TAG
    at = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if stack[-1].link:
                linked += len(text)

    def close_block() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            top = stack[-1]
            out.append(Block(text, linked, top.boiler, top.main, top.forms, any(o.name in HEADINGS for o in stack[-3:])))
        parts.clear()
        linked = 0

    while True:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        add(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3
            if end < 0:
                break
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = end + 1
            if end < 0:
                break
            continue
        following = page[start + 1:start + 3]
        if not (following[:1].isalpha() or (following[:1] == "/" and following[1:].isalpha())):
            if start + 1 == len(page) or following == "/":
                break
            add("<")
            at = start + 1
            continue
        found = tag.match(page, start)
        if not found and tag is _TAG:
            tag = _PLAIN_TAG  # a quotation mark is never closed
            found = tag.match(page, start)
        if not found:
            break
        at = found.end()
        closing, name, attributes = found.group(1), found.group(2).lower(), found.group(3)
        if name == "br":
            add(" ")
            continue
        if name in RAW_TAGS:
            if not closing and not attributes.endswith("/"):
                end = _RAW_ENDS[name].search(page, at)
                if not end:
                    break
                after = page.find(">", end.end())
                if after < 0:
                    break
                at = after + 1
            continue
        if name in BLOCK_TAGS:
            close_block()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
                if name not in BLOCK_TAGS and stack[depth].name in BLOCK_TAGS:
                    break  # an inline end tag doesn't close blocks
            continue
        if name in VOID_TAGS or attributes.endswith("/"):
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or name in BLOCK_TAGS:
            # A paragraph ends, with what is open in it, where the next block begins.
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == "p" or (stack[depth].name == name and name in ("li", "dt", "dd", "tr", "td", "th")):
                    del stack[depth:]
                    break
                if stack[depth].name in BLOCK_TAGS:
                    break
        top = stack[-1]
        names = _names(attributes) if attributes and name not in WHOLE_TAGS else set()
        boiler = (top.boiler or name in BOILER_TAGS or not names.isdisjoint(BOILER_NAMES)
                  or (bool(attributes) and _HIDDEN.search(attributes) is not None)
                  or (not top.main and (name == "header" or not names.isdisjoint(HEADER_NAMES))))
        main = top.main
        if not main and not boiler and (name in MAIN_TAGS or not names.isdisjoint(MAIN_NAMES)):
            mains += 1
            main = mains if name in MAIN_TAGS else -mains
        elif main < 0 and not boiler and name in MAIN_TAGS:
            mains += 1
            main = mains
        around = top.forms
        if name == "form":
            forms += 1
            around = (*around, forms)
        stack.append(_Open(name, boiler, main, top.link or name == "a", around))
    close_block()
    return out


def _close_forms(found: list[Block]) -> None:
    """Blocks of forms become boilerplate.  A form is none if it only wraps the page: it
    holds the article, or a long block and most of the text that is no boilerplate."""
    free = [b for b in found if not b.boiler]
    size, long, article = {}, set(), set()
    for b in free:
        for form in b.forms:
            size[form] = size.get(form, 0) + len(b.text)
            if len(b.text) >= LONG_CHARS and b.linked <= LINK_DENSITY * len(b.text):
                long.add(form)
            if b.main > 0 and b.forms[-1] == form:
                article.add(form)
    total = sum(len(b.text) for b in free)
    outside = any(b.main > 0 and not b.forms for b in free)
    for b in free:
        b.boiler = not all((form in article and not outside) or (form in long and 2 * size[form] > total) for form in b.forms)


def _first_pass(block: Block, in_main: bool) -> int | None:
    if block.boiler or not in_main:
        return BAD
    if block.main:
        return GOOD
    length = len(block.text)
    if block.linked > LINK_DENSITY * length:
        return AMBIGUOUS if block.heading else BAD
    words = _WORD.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words)
    if length >= LONG_CHARS and stops >= STOP_DENSITY * len(words):
        return GOOD
    if length >= SHORT_CHARS and stops >= STOP_DENSITY * len(words) and not block.linked:
        return GOOD
    return AMBIGUOUS


def _second_pass(found: list[Block]) -> None:
    """Ambiguous blocks inherit from the nearest decided block that is no boilerplate by
    its place; if none of those is content, they are."""
    members = [b for b in found if not b.boiler]
    if not any(b.label == GOOD for b in members):
        for b in members:
            b.label = GOOD if b.label is AMBIGUOUS else b.label
        return
    far = len(members) + 1
    before, last, label = [], far, BAD
    for b in members:
        last, label = (0, b.label) if b.label is not AMBIGUOUS else (last + 1, label)
        before.append((last, label))
    last, label = far, BAD
    for b, (earlier, other) in zip(reversed(members), reversed(before)):
        if b.label is not AMBIGUOUS:
            last, label = 0, b.label
            continue
        last += 1
        b.label = label if last < earlier else other if earlier < last else max(label, other)


def main_text(page: str | None) -> str:
    """The main blocks in page order, joined by newlines; empty if there is none.

    If the page marks an article (or main) element, only its blocks count;
    otherwise those of a container named like one, otherwise all blocks."""
    found = blocks(page or "")
    _close_forms(found)
    free = [b for b in found if not b.boiler]
    if any(b.main > 0 for b in free):
        inside = {b.main for b in free if b.main > 0}
    elif any(b.main < 0 for b in free):
        inside = {b.main for b in free if b.main < 0}
    else:
        inside = {0}
    for b in found:
        b.label = _first_pass(b, b.main in inside)
    _second_pass([b for b in found if b.main in inside])
    return "\n".join(b.text for b in found if b.label == GOOD)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of every whole page instead of its HTML.

    Character references are decoded, white space within a block is one space, and
    blocks are trimmed and joined by one newline.  A null, empty or blank page has
    an empty text.  Rows are handled one by one without a shuffle; other columns
    pass through, one named ``text_col`` is replaced; an empty table stays empty.
    """
    rest = pages.drop(text_col) if text_col != html_col else pages
    rest = rest.withColumnRenamed(html_col, text_col).withColumn(text_col, F.col(text_col).cast("string"))
    at = rest.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column(at)]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return rest.mapInArrow(run, rest.schema)
