"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive (fewer points in
a link), tags negative, both with weights learned from labelled pages; what
stands in elements that never hold main text (scripts, menus, forms, elements
named as adverts, comments and so on) scores nothing. One linear scan finds
the contiguous region with the largest score. It is widened to whole blocks,
and to the whole of an ``article`` or ``main`` element that it reaches into: a
short heading or last line must not pay for its tags there. Its words outside
of elements that never hold main text are the text.

Defined results: a null or empty page, one without words, or one whose words
all stand in such elements gives an empty text; repeated rows give equal
texts; null ids and urls are kept; an empty table gives no rows; other columns
are not read. An element, comment or tag that is not closed reaches to the
end of what encloses it. Pages are read whole.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocart.llm.labelled_pages import labelled_pages
from velocart.llm.words import text_chunks

# Fixed names of HTML: elements without an end tag, elements whose content is
# not markup, elements inside a line of text, and elements ended by the next of their kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript template iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
#: Elements that hold one main text: the region is never cut inside of one.
HOLDERS = frozenset(("article", "main"))
#: Elements that never hold main text, and words in a class, id or role that name such elements.
ASIDE = frozenset("head nav footer aside form button select dialog menu svg canvas object audio video map".split()) | RAW
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|cookies?|consent|disqus|dialog|footer|masthead|menu|modal|"
    r"nav|navbar|navigation|newsletter|notice|outbrain|pagination|pager|popup|promo|promoted|related|recommended|replies|reply|respond|search|share|sharing|"
    r"sidebar|signup|site-header|social|sponsor|sponsored|subscribe|taboola|toolbar|widget|complementary|contentinfo|alert)(?:$|[\s_-])",
    re.I,
)
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
#: The attributes of a tag, up to its ">"; a quote that isn't closed counts as a letter.
REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+""")


def pieces(page: str):
    """The page as ("text", text), ("tag", name, closing, attributes) and ("mark", comment) in order."""
    at, n, paired = 0, len(page), True
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:]
            return
        if lt > at:
            yield "text", page[at:lt]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            yield "mark", page[lt + 4 : end if end >= 0 else n]
            at = end + 3 if end >= 0 else n
            continue
        found = TAG.match(page, lt)
        if not found:
            if lt + 1 < n and page[lt + 1] in "!?/":
                end = page.find(">", lt)
                at = end + 1 if end >= 0 else n
            else:
                yield "text", "<"
                at = lt + 1
            continue
        end = REST.match(page, found.end()).end() if paired else n  # a quoted ">" belongs to the tag
        if end == n:
            # quotes don't pair to the page's end: from here on tags end at the first ">", so that the scan stays linear
            paired, end = False, page.find(">", found.end())
            if end < 0:
                return
        name, closing = found[1].lower(), page[lt + 1] == "/"
        attributes = page[found.end() : end]
        at = end + 1
        yield "tag", name, closing, attributes
        if name in RAW and not closing and not attributes.endswith("/"):
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else n
            yield "tag", name, True, ""


@dataclass
class Token:
    """A tag (name) or a text with its place: the block it stands in, in a link, in an element that is left out."""

    name: str = ""
    text: str = ""
    block: int = 0
    link: bool = False
    aside: bool = False
    main: bool = False  # of labelled pages
    inside: int = 0  # number of the outermost article or main element around it, 0 without
    words: int = field(default=0)


def tokens(page: str) -> list[Token]:
    out: list[Token] = []
    stack: list[tuple[str, bool]] = []  # open elements, and whether they are left out
    opened: Counter[str] = Counter()  # by name
    left_out = links = block = holders = inside = 0
    main = False

    def pop() -> None:
        nonlocal left_out, links, inside
        name, aside = stack.pop()
        if name in HOLDERS and not any(opened[h] for h in HOLDERS - {name}) and opened[name] == 1:
            inside = 0
        opened[name] -= 1
        left_out -= aside
        links -= name == "a"

    for piece in pieces(page):
        if piece[0] == "text":
            text = entities.unescape(piece[1])
            out.append(Token(text=text, block=block, link=links > 0, aside=left_out > 0, main=main, words=len(text.split()), inside=inside))
            continue
        if piece[0] == "mark":
            main = piece[1] == "[" or (main and piece[1] != "]")
            continue
        _, name, closing, attributes = piece
        was_out = left_out > 0  # the end tag of an element that is left out is left out too
        if name not in INLINE and name != "br":
            block += 1
        if closing:
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
        elif name not in VOID:
            if name in SELF_CLOSING and stack and stack[-1][0] == name:
                pop()
            elif name not in INLINE:
                while stack and (stack[-1][0] in INLINE and not stack[-1][1] or stack[-1][0] == "p"):
                    pop()
            named = any(NAMED.search(next(v for v in m.groups() if v is not None)) for m in ATTRIBUTE.finditer(attributes)) if attributes else False
            inside = opened["article"] or opened["main"] or opened["section"]
            aside = name in ASIDE or (name == "header" and not inside) or (named and name not in ("body", "html", "article", "main"))
            if not attributes.endswith("/") or name == "a":
                if name in HOLDERS and not inside and not left_out:
                    holders += 1
                    inside = holders
                stack.append((name, aside))
                opened[name] += 1
                left_out += aside
                links += name == "a"
        out.append(Token(name=name, block=block, aside=left_out > 0 or was_out, main=main, inside=inside))
        if name == "br":
            out.append(Token(text=" ", block=block, aside=left_out > 0, main=main, inside=inside))
    return out


@dataclass
class Weights:
    word: float
    link: float
    tags: dict[str, float]
    other: float

    def score(self, t: Token) -> float:
        if t.aside:
            return 0.0
        if t.name:
            return self.tags.get(t.name, self.other)
        return t.words * (self.link if t.link else self.word)


#: Labelled pages that the weights are learned from.
LEARNED_PAGES = 200
#: Shares of a word's log odds that count: the words of a block are no independent evidence.
SHARES = (1.0, 0.5, 0.25, 0.125, 0.0625, 0.03125)


def learn(pages: list[str] | None = None) -> Weights:
    """Log odds of standing in the main text: of words and words in links at least a little positive, of tags
    at least a little negative. A tag never seen weighs as all tags do together. Words count with the share of
    their odds that gets fewest words of the labelled pages wrong, the largest of equals."""
    found = [tokens(page) for page in pages or labelled_pages(LEARNED_PAGES)]
    counts: dict[str, list[float]] = {}
    for t in (t for page in found for t in page if not t.aside):
        pair = counts.setdefault(f"<{t.name}" if t.name else "link" if t.link else "word", [0.5, 0.5])
        pair[0 if t.main else 1] += 1 if t.name else t.words
    all_tags = [sum(v[i] for k, v in counts.items() if k[0] == "<") for i in (0, 1)]

    def odds(pair) -> float:
        return math.log(pair[0] / pair[1])

    tags = {k[1:]: min(-0.1, odds(v) - 0.5) for k, v in counts.items() if k[0] == "<"}
    word, link = max(0.5, odds(counts["word"])), max(0.05, odds(counts["link"]))

    def wrong(weights: Weights) -> int:
        return sum(t.words for page in found for t, taken in zip(page, chosen(page, weights)) if not t.name and not t.aside and taken != t.main)

    tried = [Weights(word * share, link * share, tags, min(-0.3, odds(all_tags) - 0.5)) for share in SHARES]
    return min(tried, key=wrong)


def chosen(page: list[Token], weights: Weights) -> list[bool]:
    """Which tokens stand in the blocks of the best region, or in the article or main element that it reaches into."""
    begin, end = best_region([weights.score(t) for t in page])
    if begin == end:
        return [False] * len(page)
    first, last = page[begin].block, page[end - 1].block
    entered = {t.inside for t in page[begin:end] if t.inside and t.words and not t.aside}
    return [first <= t.block <= last or t.inside in entered for t in page]


def best_region(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous part with the largest sum, the first of equals; empty if none is positive."""
    best, found = 0.0, (0, 0)
    total, begin = 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, found = total, (begin, i + 1)
    return found


def main_text(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    found = tokens(page)
    blocks: dict[int, list[str]] = {}
    for t, taken in zip(found, chosen(found, weights)):
        if taken and not t.name and not t.aside:
            blocks.setdefault(t.block, []).append(t.text)
    return " ".join(text for parts in blocks.values() if (text := " ".join("".join(parts).split())))


def extract(pages: DataFrame, weights: Weights | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    weights = weights or learn()

    def run(batches):
        for batch in text_chunks(batches, "html"):
            texts = [main_text(p, weights) for p in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
