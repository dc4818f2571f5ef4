"""Main text of HTML pages by two-pass block rules.

Pass 1 cuts a page into blocks (text between block-level tags) and decides
each by itself: blocks inside boilerplate containers (menus, headers,
footers, side bars, notices, adverts, forms, reader comments) and blocks
that are mostly links are out; long blocks with enough stop words are in;
in an article, so is any block with some stop words or of some length.
Short or unclear blocks stay undecided.

Pass 2 lets undecided blocks inherit the label of their nearest decided
neighbours; in an article these are its own blocks outside boilerplate.  Where the two sides differ the
nearer one counts, and the following one on a tie (a heading belongs to what
it heads).  An undecided article without a decided block is in.

Stop words are those of a few languages; a block in another script, and a
page with hardly any of them, is judged by length and sentence ends instead.
Inside an article, ids mark boilerplate only by unmistakable words, and
headings are never boilerplate by name; text of formulas, drawings and
``noscript`` is text.

Open elements are found by tag through the places they have on the stack, so
the time is linear in the page, whatever is left unclosed.

Edge cases: null or empty html gives an empty text; unclosed tags, missing
end tags and broken markup are read to the end; every row gives one row;
repeated rows are extracted each; other columns are never read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .textarrays import slices, small_batches

LONG, SHORT = 200, 70  # characters
STOP_LOW, STOP_HIGH = 0.12, 0.25  # share of stop words
KNOWN = 0.08  # share of stop words from which a page's language counts as known
LINKS = 0.5  # share of characters inside links

# Frequent words of the languages at hand.
STOP_WORDS = frozenset("""
the of and a to in is it that was for on are with as be by at this from or an have not but they which you had we were their has
der die das und in zu den von mit ist im für auf nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um
le la les de des du et un une en que qui dans est pour par sur pas au avec ce il sont plus ne se aux ou elle mais
el los las de del y que en un una es por con para se no lo su al como más o pero sus ha este entre
""".split())
# HTML elements by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span
strike strong sub sup td th time tt u var br wbr img svg math""".split())
RAW = frozenset("script style template textarea title iframe select".split())
DRAWN = frozenset("svg math".split())  # what stands inside is inline
OUT = frozenset("nav aside footer form menu dialog button fieldset".split())
CLOSES_P = frozenset("p div section article main nav aside header footer form ul ol dl table h1 h2 h3 h4 h5 h6 pre blockquote hr figure".split())
# Words in class, id or role that mark boilerplate.
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars aside nav
navbar navigation menu menus breadcrumb breadcrumbs topbar masthead header footer comment comments commentlist reply replies respond
disqus discussion cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription
signup login share sharing social related recommended recommendations widget widgets toolbar pagination pager disclaimer copyright
search contentinfo complementary hidden""".split())

# Of these, the ones that an id inside an article must hold to mark boilerplate.
ID_MARKS = frozenset("ad ads advert adverts advertisement advertising sidebar comments commentlist disqus cookie cookies newsletter".split())

_REST = re.compile(r"""(?:=\s*+"[^"]*"|=\s*+'[^']*'|[^>])*+>""")  # of a tag, to its >, which a quoted value may hold
_SENTENCE = re.compile(r"[.!?\u2026\u3002\uff01\uff1f\u061f\u0964](?:[\"'\u201d\u2019)\]]?\s|[\"'\u201d\u2019)\]]?$)|[\u3002\uff01\uff1f]")
_HEADING = re.compile("h[1-6]")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    article: int  # number of the article it stands in, 0 for none
    out: bool  # inside boilerplate
    heading: bool


@dataclass
class Element:
    tag: str
    inline: bool
    out: bool
    article: int
    within: int  # 2 in an article, 1 in a main part only, 0 in neither


def marked_out(tag: str, attributes: str, within: int) -> bool:
    """Whether an element is a boilerplate container."""
    if tag in OUT or tag == "header" and not within:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    low = f" {attributes.lower()} "
    if re.search(r"\shidden[\s=/]", low) and "aria-hidden" not in low:
        return True
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "style" and _HIDDEN.search(value) or name == "aria-hidden" and value.lower() == "true":
            return True
        if name in ("class", "id", "role"):
            if within and (_HEADING.fullmatch(tag) or name == "id" and tag == "p"):
                continue
            words = ID_MARKS if name == "id" and within == 2 else MARKS
            for one in value.split():
                parts = [x.lower() for x in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", one)]
                if not {"has", "no", "with"} & set(parts) and any(x in words and not (x == "header" and within) for x in parts):
                    return True
    return False


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    stack: list[Element] = []
    places: dict[str, list[int]] = {}  # of the open elements of a tag, ascending
    walls: list[int] = []  # of those that are no inline elements
    p_walls: list[int] = []  # of those that a paragraph's end does not pass
    no_end: set[str] = set()  # raw elements without a further end tag
    parts: list[str] = []
    state = {"linked": 0, "links": 0, "articles": 0, "drawn": 0}

    def flush(heading: bool = False) -> None:
        text = " ".join("".join(parts).split())
        if text:
            top = stack[-1] if stack else Element("", True, False, 0, 0)
            out.append(Block(text, state["linked"], top.article, top.out, heading))
        parts.clear()
        state["linked"] = 0

    def add(text: str) -> None:
        if text:
            text = html.unescape(text)
            parts.append(text)
            if state["links"]:
                state["linked"] += len(text.strip())

    def push(e: Element) -> None:
        k = len(stack)
        stack.append(e)
        places.setdefault(e.tag, []).append(k)
        if not e.inline:
            walls.append(k)
            if e.tag != "p" and not _HEADING.fullmatch(e.tag):
                p_walls.append(k)
        state["links"] += e.tag == "a"
        state["drawn"] += e.tag in DRAWN

    def close(k: int) -> None:
        """Ends the elements from place k of the stack."""
        while len(stack) > k:
            e = stack.pop()
            places[e.tag].pop()
            for w in (walls, p_walls):
                if w and w[-1] == len(stack):
                    w.pop()
            state["links"] -= e.tag == "a"
            state["drawn"] -= e.tag in DRAWN

    def end(tag: str) -> None:
        if not places.get(tag):
            return
        k = places[tag][-1]
        if not stack[k].inline:
            flush(bool(_HEADING.fullmatch(tag)))
        elif walls and walls[-1] > k:
            return  # an inline end tag ends nothing outside its block
        close(k)

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        add(page[at:lt])
        nxt = page[lt + 1: lt + 2]
        if page.startswith("<!--", lt):
            stop = page.find("-->", lt + 4)
            at = n if stop < 0 else stop + 3
            continue
        if nxt in ("!", "?"):
            stop = page.find(">", lt)
            at = n if stop < 0 else stop + 1
            continue
        name = _NAME.match(page, lt + 2 if nxt == "/" else lt + 1)
        if not name:
            add("<")
            at = lt + 1
            continue
        rest = _REST.match(page, name.end())
        stop = rest.end() - 1 if rest else page.find(">", name.end())
        if stop < 0:
            break
        tag, attributes, at = name.group().lower(), page[name.end(): stop], stop + 1
        if nxt == "/":
            if tag not in VOID:
                end(tag)
            elif tag == "br":
                add(" ")
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in RAW:
            ends = None if tag in no_end else re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            if ends is None:
                no_end.add(tag)
            if not attributes.rstrip().endswith("/"):
                at = ends.end() if ends else (n if tag in ("script", "style") else at)
            continue
        inline = tag in INLINE or state["drawn"] > 0
        if tag in ("td", "th") or places.get("svg"):
            add(" ")
        if not inline:
            flush()
            if tag in CLOSES_P and places.get("p") and not (p_walls and p_walls[-1] > places["p"][-1]):
                close(places["p"][-1])
            if tag in ("li", "dt", "dd", "tr", "option") and stack and stack[-1].tag == tag:
                close(len(stack) - 1)
        if tag in VOID or attributes.rstrip().endswith("/"):
            continue
        top = stack[-1] if stack else Element("", True, False, 0, 0)
        article = top.article
        if tag in ("article", "main") and not article:
            state["articles"] += 1
            article = state["articles"]
        within = max(top.within, {"article": 2, "main": 1}.get(tag, 0))
        bad = not state["drawn"] and marked_out(tag, attributes, within)
        if bad and not top.out and inline and tag != "a":
            flush()  # a marked span is a block of its own
        push(Element(tag, inline, top.out or bad or tag == "head", article, within))
    flush()
    return out


def stop_share(text: str) -> tuple[int, int]:
    """Stop words and words."""
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def foreign(text: str) -> bool:
    """Most letters are of another script than Latin."""
    letters = [c for c in text if c.isalpha()]
    return 2 * sum(c > "\u024f" for c in letters) > len(letters)


def first_pass(block: Block, known: bool = True) -> bool | None:
    """In, out, or undecided; ``known`` if the stop words are of the page's language."""
    size = len(block.text)
    if block.out:
        return False
    if block.linked > LINKS * size and not block.heading:
        return False
    hit, words = stop_share(block.text)
    stops = hit / words if words else 0.0
    if block.article:
        return True if size >= SHORT or stops >= STOP_LOW else None
    wide = size + sum(c >= "\u2e80" for c in block.text)  # a wide character says as much as two letters
    if wide < SHORT or block.heading:
        return None
    sentence = bool(_SENTENCE.search(block.text))
    if not known or foreign(block.text):
        return True if sentence or wide >= LONG else None
    if size >= LONG and stops >= STOP_HIGH:
        return True
    return None if stops >= STOP_LOW or sentence else False


def second_pass(found: list[Block], label: list[bool | None]) -> list[bool]:
    """Undecided blocks inherit from their nearest decided neighbours."""
    n = len(found)

    def nearest(article: int | None) -> list[tuple[int | None, int | None]]:
        """Places of the decided blocks before and after each block, of one article if given."""
        before, after, last = [None] * n, [None] * n, None
        for k in range(n):
            before[k] = last
            if label[k] is not None and (article is None or found[k].article == article and not found[k].out):
                last = k
        last = None
        for k in range(n - 1, -1, -1):
            after[k] = last
            if label[k] is not None and (article is None or found[k].article == article and not found[k].out):
                last = k
        return list(zip(before, after))

    around = {a: nearest(a) for a in {b.article for b in found} if a}
    around[0] = nearest(None)
    out = []
    for k, block in enumerate(found):
        if label[k] is not None:
            out.append(label[k])
            continue
        prev, nxt = around[block.article][k]
        if prev is None and nxt is None:
            out.append(bool(block.article) or all(x is None for x in label))
        elif prev is None or nxt is None:
            out.append(label[nxt if prev is None else prev])
        else:
            out.append(label[prev] if k - prev < nxt - k else label[nxt])
    return out


def main_text(page: str | None) -> str:
    """The blocks that are in, joined by an empty line."""
    found = blocks(page or "")
    counts = [stop_share(b.text) for b in found if not b.out and not b.article]
    known = sum(h for h, _ in counts) >= KNOWN * sum(n for _, n in counts)
    label = [first_pass(b, known) for b in found]
    if not any(b.article for b in found) and not any(label):
        # no article and nothing clearly in: long runs of plain text are the best evidence there is
        label = [True if x is not True and not b.out and len(b.text) >= LONG and b.linked <= LINKS * len(b.text) else x
                 for b, x in zip(found, label)]
    return "\n\n".join(b.text for b, keep in zip(found, second_pass(found, label)) if keep)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            texts = [main_text(x) for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages(page_id, url, html, ..)``: page_id, url, text, n_chars."""
    small_batches(pages.sparkSession)
    p = pages.select("page_id", "url", "html")
    kinds = dict(p.dtypes)
    return p.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
