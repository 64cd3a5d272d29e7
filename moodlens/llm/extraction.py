"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: elements by what they mean for the text of a page
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
NEVER = frozenset("head nav footer aside form button dialog menu fieldset audio video canvas".split())
HOMES = frozenset(("article", "main"))
# fixed values: words of class, id or role that mark an element as no content
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner sidebar aside menu nav navbar navigation header masthead footer comment comments"
    " disqus reply replies respond cookie cookies consent notice notices gdpr promo promotion share sharing social related recommended newsletter subscribe"
    " signup login popup modal overlay breadcrumb breadcrumbs widget pagination pager toolbar search contentinfo complementary alert".split()
)
# fixed values: an opening tag of the key ends an open element of the values, up to a stopping one
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# fixed values: first parts of class names that say what an element has rather than is, and those of an article's own parts
STATES, OWN = frozenset("has no with without is not".split()), frozenset("article entry post story content".split())
# fixed values: parts that names of MARKS are combined with; headings, whose ids are made of their words; ids of sections that are none
PARTNERS = frozenset(
    "area articles bar block blocks bottom box button buttons container count fixed form global icon icons inner item items left link links list main message mobile outer"
    " page panel post posts primary right row secondary section site slot sticky stories template text title top unit wrap wrapper".split()
)
HEADINGS, ASIDES = frozenset("h1 h2 h3 h4 h5 h6".split()), frozenset("ad ads advertisement breadcrumb breadcrumbs comments disqus pager pagination respond sidebar toolbar".split())
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</?[a-zA-Z]?\Z""", re.S
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?=[\s=/]|$)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)

#: Weights of the neighbours in the smoothing, share of the text-weighted mean score that a block must reach, share of linked text.
KERNEL, LEAST_SHARE, MOST_LINKED = np.array([0.25, 0.5, 0.25]), 0.25, 0.5


def _is_marked(names: str, tag: str, known: bool = False) -> bool:
    """Whether a class, id or role says that an element is no content: by the whole name, or by its first or last part.

    With ``known`` all other parts of the name have to be usual beside those words, as in related-posts, but not in related-work.
    """
    for name in names.split():
        first, *_, last = (parts := re.split("[-_]+", name)) * 2
        if name in MARKS:
            return True
        if tag in HOMES or first in STATES or (known and not all(p in MARKS or p in PARTNERS or p.isdigit() for p in parts)):
            continue
        if first in MARKS or (last in MARKS and not (first in OWN and last == "header")):
            return True
    return False


def _is_aside(tag: str, classes: str, ident: str, inside: bool) -> bool:
    """Whether class, role or id mark an element as no content. Ids, often slugs of the heading, count by known names only."""
    if tag in HEADINGS:
        ident = ""
    elif tag == "section" and inside:
        ident = ident if ident in ASIDES else ""
    return _is_marked(classes, tag, tag == "p" or tag in HEADINGS) or _is_marked(ident, tag, True)


@dataclass
class Block:
    """A run of text between block-level tags."""

    path: int
    home: int
    text: str
    linked: int
    #: Numbers of the element of the block and of the one around it.
    within: tuple[int, ...] = ()


@dataclass
class _Element:
    tag: str
    path: int
    content: bool
    home: int
    #: Position of the innermost block-level element, itself included, its home, and the numbers of the last two of them.
    block: int
    block_home: int
    within: tuple[int, ...]


_OUTSIDE = _Element("", 0, True, 0, -1, 0, ())


@dataclass
class _Page:
    """Open elements and the blocks found so far; text outside content is left out at once.

    A tag path is a number for the number of the path above and a label, so a page takes no more for being deep.
    """

    stack: list[_Element] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    homes: int = 0
    elements: int = 0
    paths: dict[tuple[int, str], int] = field(default_factory=dict)
    open_tags: Counter = field(default_factory=Counter)

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            last = self.stack[-1] if self.stack else _OUTSIDE
            self.blocks.append(Block(last.path, last.block_home, text, self.linked, last.within))
        self.parts, self.linked = [], 0

    def text(self, raw: str) -> None:
        if raw and (not self.stack or self.stack[-1].content):
            piece = html.unescape(raw)
            self.parts.append(piece)
            if self.links:
                self.linked += len(piece.strip())

    def open(self, tag: str, attributes: str) -> None:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
        classes, ident = f"{found.get('class', '')} {found.get('role', '')}".lower(), found.get("id", "").lower()
        names = f"{found.get('class', '')} {ident} {found.get('role', '')}".lower()
        above = self.stack[-1] if self.stack else _OUTSIDE
        unseen = bool(found) and ("hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I))
        marked = names != "  " and tag not in ("html", "body", "main") and _is_aside(tag, classes, ident, above.home > 0)
        page_header = tag == "header" and not above.home
        content = above.content and not (tag in NEVER or page_header or unseen or marked)
        home = above.home
        if tag in HOMES and content and not home:
            self.homes += 1
            home = self.homes
        first_name = names.split()[0] if names.strip() else ""
        self.links += tag == "a"
        self.elements += 1
        self.open_tags[tag] += 1
        if tag in INLINE:
            self.stack.append(_Element(tag, above.path, content, home, above.block, above.block_home, above.within))
            return
        path = self.paths.setdefault((above.path, f"{tag}.{first_name}" if first_name else tag), len(self.paths) + 1)
        self.stack.append(_Element(tag, path, content, home, len(self.stack), home, (*above.within[-1:], self.elements)))

    def close_above(self, at: int) -> None:
        for element in self.stack[at:]:
            self.open_tags[element.tag] -= 1
            self.links -= element.tag == "a"
        del self.stack[at:]

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        if tag not in INLINE:
            self.end_block()
            at = self.stack[-1].block if self.stack else -1
            if at >= 0 and self.stack[at].tag == "p" and tag not in VOID:
                self.close_above(at)
            ends, stops = ENDS.get(tag, ((), ()))
            for k in range(len(self.stack) - 1, -1, -1) if any(self.open_tags[t] for t in ends) else ():
                if self.stack[k].tag in stops:
                    break
                if self.stack[k].tag in ends:
                    self.close_above(k)
                    break
        if tag not in VOID:
            self.open(tag, attributes)

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_block()
        if not self.open_tags[tag]:
            return
        # an inline end tag does not close block-level elements
        least = self.stack[-1].block if tag in INLINE else -1
        at = next((k for k in range(len(self.stack) - 1, least, -1) if self.stack[k].tag == tag), -1)
        if at >= 0:
            self.close_above(at)


def page_blocks(source: str) -> list[Block]:
    """The blocks of a page in page order, without those inside elements that are never content."""
    page, at = _Page(), 0
    while at < len(source):
        less = source.find("<", at)
        found = TAG.match(source, less) if less >= 0 else None
        while less >= 0 and not found:  # a sign that opens no tag is text
            less = source.find("<", less + 1)
            found = TAG.match(source, less) if less >= 0 else None
        page.text(source[at : less if found else len(source)])
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            page.end(tag)
            continue
        attributes = found[3] if found[2] else found[6]
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = close.end() if close else len(source)
            continue
        page.start(tag, attributes)
    page.end_block()
    return page.blocks


def select_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks that hold the main text.

    Each path sums length, punctuation and number of its blocks. Its text ratio (length per block) and punctuation ratio are fused as a
    product, smoothed along the page, and compared with a share of the mean over all text. Paths whose text is mostly links score
    nothing. If blocks that pass lie in an article or main element, all its blocks belong to the main text, short ones too. Elsewhere
    those between two passing blocks of the same element do, such as lists and tables in a story, if they are not mostly links.
    """
    if not blocks:
        return []
    totals: dict[int, np.ndarray] = {}
    sizes = np.array([len(b.text) for b in blocks], float)
    for b in blocks:
        totals[b.path] = totals.get(b.path, np.zeros(4)) + (len(b.text), len(PUNCTUATION.findall(b.text)), 1, b.linked)
    fused = {p: 0.0 if linked > MOST_LINKED * length else length / n * np.log2(2 + marks / n) for p, (length, marks, n, linked) in totals.items()}
    scores = np.array([fused[b.path] for b in blocks])
    smooth = np.convolve(np.pad(scores, 1, mode="edge"), KERNEL, mode="valid")
    least = LEAST_SHARE * (scores * sizes).sum() / sizes.sum()
    passed = (smooth >= least) & (scores > 0)
    homes = {b.home for b, ok in zip(blocks, passed) if ok and b.home}
    if homes:
        return [b for b in blocks if b.home in homes]
    between, before = passed.copy(), {}
    for k in np.flatnonzero(passed).tolist():
        for number in blocks[k].within:
            if number in before:
                between[before[number] + 1 : k] = True
            before[number] = k
    return [b for b, ok, inner in zip(blocks, passed, between) if ok or (inner and b.linked <= MOST_LINKED * len(b.text))]


def main_text(source: str | None) -> str:
    """The main text of a page, blocks joined by an empty line; empty if there is none."""
    return "\n\n".join(b.text for b in select_blocks(page_blocks(source or "")))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x) for x in batch.column("html").to_pylist()]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    A null or empty page gives an empty text, as does one without content. Repeated rows are extracted alike; other columns are ignored;
    an empty table gives no rows. Every page is judged by itself, so no host or template can be hot and nothing is shuffled.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
