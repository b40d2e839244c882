"""Main text of web pages by tag-path ratios.

A page is read as text blocks, each with its root-to-leaf tag path. For every path, text length and punctuation
are summed over its blocks and divided by their number; the two ratios are fused, smoothed over neighbouring
blocks, and paths above a threshold hold content. Their blocks and the element around most of them are the article. Text under
furniture tags and hidden elements never counts; a class or id that names furniture is evidence, judged on the text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
FURNITURE = frozenset(
    "nav footer aside form script style noscript template iframe svg button select textarea dialog menu head title "
    "object canvas audio video map fieldset label".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
#: Words in class or id that name page furniture.
NAMES = frozenset(
    "nav navbar navigation menu footer sidebar aside ad ads advert adverts advertisement advertising banner promo "
    "promotion sponsor sponsored cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription "
    "share sharing social comment comments commentlist disqus replies reply respond breadcrumb breadcrumbs pagination "
    "pager related recommended widget login signin signup search toolbar masthead skip copyright topbar menubar subnav "
    "adsbygoogle adbox adslot adunit leaderboard discussion disclaimer".split()
)
#: Of these, words that say little where another word follows (social-science, search-results, notice-list).
LOOSE = frozenset(
    "banner promo promotion sharing share social search notice widget related recommended menu subscription subscribe "
    "overlay modal popup skip disclaimer consent cookie cookies navigation respond login".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond discussion".split())
#: Layout classes: the word behind the first, or before the second, is about the element's surroundings.
WITH, AROUND = frozenset("has with no without".split()), frozenset({"container"})
LAYOUT = frozenset("sidebar widget".split())
#: Words that make a "header" part of the article.
OWN_HEADER = frozenset("article post entry content story page".split())
#: What a class or id says: nothing, furniture unless on a content path, furniture, a comment thread.
PLAIN, WEAK, STRONG, THREAD = range(4)
#: Opening tags of the second kind end an open element of the first.
ENDS = {
    "p": BLOCK - {"option"}, "li": frozenset({"li"}), "dt": frozenset("dt dd".split()), "dd": frozenset("dt dd".split()),
    "td": frozenset("td th tr tbody tfoot thead".split()), "th": frozenset("td th tr tbody tfoot thead".split()),
    "tr": frozenset("tr tbody tfoot thead".split()), "option": frozenset("option optgroup".split()), "head": frozenset({"body"}),
}
#: A comment, a declaration, a tag, a tag with an unclosed quote (which ends at the next ``>``), a cut-off last tag. A
#: quote is closed by its like before a blank, a slash or the tag's end; one before a letter opens another value.
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|(?:\"[^\"]*\"|'[^']*')(?=[\s/>]))*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[a-zA-Z/][^>]*$",
    re.DOTALL,
)
#: One attribute: its whole name, then a quoted or bare value, so that no value is ever read as a name.
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
READ = frozenset("class id role hidden aria-hidden".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，！？、]")


class Element:
    """An element of a page, numbered as it opens; what lies in it has numbers up to ``last``.

    ``named`` and ``strong`` are the innermost elements, itself included, whose names speak of furniture and do so
    strongly; ``article`` the innermost article or main of no such name. All are None where there are none. ``path`` numbers
    the block tags from the root, or all tags where none is a block.
    """

    __slots__ = ("tag", "number", "parent", "dropped", "evidence", "last", "named", "strong", "article", "path", "in_block")

    def __init__(self, tag: str, number: int, parent: Element | None, dropped: bool, evidence: int):
        self.tag, self.number, self.parent, self.dropped, self.evidence, self.last = tag, number, parent, dropped, evidence, number
        self.named = self if evidence else parent and parent.named
        self.strong = self if evidence > WEAK else parent and parent.strong
        self.article = self if tag in ("article", "main") and evidence == PLAIN else parent and parent.article
        self.in_block = tag in BLOCK or bool(parent and parent.in_block)
        self.path = 0


class Piece(NamedTuple):
    """A run of text, and the innermost element around it whose name speaks of furniture."""

    named: Element | None
    text: str


class Block(NamedTuple):
    """A text block: the number of its tag path, that path's last tag, and the innermost element around it."""

    path: int
    leaf: str
    inside: Element | None
    text: str
    pieces: tuple[Piece, ...] = ()


def is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether the tag, a role or hiding alone makes an element furniture."""
    if tag in FURNITURE or tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    return _attributes(attributes).get("role") in ROLES or _is_hidden(attributes)


def named_furniture(tag: str, attributes: str, in_article: bool) -> int:
    """What an element's class and id say of it; ``WEAK`` if only loose words do, each with another word behind it."""
    own = _attributes(attributes) if attributes else {}
    tokens = [re.split(r"[^a-z0-9]+", t) for n in ("class", "id") for t in own.get(n, "").split()]
    tokens = [[w for w in t if w] for t in tokens]
    names = {w for t in tokens for w in t}
    if tag in ("html", "body", "main"):
        return PLAIN
    if tag == "article":
        return THREAD if names & {"comment", "comments", "reply"} else PLAIN
    found = PLAIN
    for t in tokens:
        for i, w in enumerate(t):
            if w not in NAMES and w != "header" or i and t[i - 1] in WITH:
                continue
            last = i + 1 == len(t)
            if w == "header":
                level = PLAIN if names & OWN_HEADER or in_article else STRONG
            elif w in LAYOUT and not last and t[i + 1] in AROUND:
                level = PLAIN
            elif w in COMMENTS:
                level = THREAD
            else:
                level = WEAK if w in LOOSE and not last else STRONG
            found = max(found, level)
    return PLAIN if found == WEAK and any(len(t) == 1 and t[0] in OWN_HEADER for t in tokens) else found


def _attributes(attributes: str) -> dict[str, str]:
    """The attributes that are read, by name; of a repeated one the first counts, as in browsers."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(attributes):
        if (name := name.lower()) in READ:
            found.setdefault(name, value.strip("\"'").lower())
    return found


def _is_hidden(attributes: str) -> bool:
    own = _attributes(attributes)
    return "hidden" in own or own.get("aria-hidden", "").strip() == "true"


def _plain(pieces: list[Piece] | tuple[Piece, ...]) -> str:
    return " ".join(html.unescape("".join(p.text for p in pieces)).split())


def read_blocks(page: str) -> tuple[list[Block], list[Element]]:
    """Text blocks outside furniture tags, in page order, and all elements by number. Any input is read to its end:
    unclosed elements end with the page, stray end tags and a cut-off last tag are ignored. The work is in proportion
    to the page: what a block or tag needs to know of the elements around it is kept while they open and close.
    """
    stack: list[Element] = []
    elements: list[Element] = []
    blocks: list[Block] = []
    pending: list[Piece] = []
    open_at: dict[str, list[int]] = {}  # depths of the open elements of a tag
    closers: list[int] = []  # depths of the elements that an opening block tag looks at
    paths: dict[tuple[int, str], int] = {}

    def add(text: str) -> None:
        pending.append(Piece(stack[-1].named if stack else None, text))

    def flush() -> None:
        text = _plain(pending)
        if text:
            top = stack[-1] if stack else None
            leaf = top
            while leaf and leaf.in_block and leaf.tag not in BLOCK:
                leaf = leaf.parent
            pieces = tuple(pending) if any(p.named for p in pending) else ()
            blocks.append(Block(top.path if top else 0, leaf.tag if leaf else "", top, text, pieces))
        pending.clear()

    def close(depth: int) -> None:
        if any(e.tag in BLOCK for e in stack[depth:]):
            flush()
        for e in reversed(stack[depth:]):
            e.last = len(elements) - 1
            open_at[e.tag].pop()
        while closers and closers[-1] >= depth:
            closers.pop()
        del stack[depth:]

    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        if not (stack and stack[-1].dropped):
            add(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        tag, attributes = (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
        if not tag:
            continue
        if m[1] or m[4]:
            if open_at.get(tag):
                close(open_at[tag][-1])
            continue
        if tag in BLOCK:
            for i in reversed(closers):
                if tag in ENDS.get(stack[i].tag, frozenset()):
                    close(i)
                    break
                if stack[i].tag not in ENDS:
                    break
            flush()
        elif tag == "br":
            add(" ")
        if tag in VOID:
            continue
        in_article = bool(open_at.get("article") or open_at.get("main"))
        parent = stack[-1] if stack else None
        dropped = bool(parent) and parent.dropped or is_furniture(tag, attributes, in_article)
        element = Element(tag, len(elements), parent, dropped, PLAIN if dropped else named_furniture(tag, attributes, in_article))
        before = parent.path if parent else 0
        if tag in BLOCK and not (parent and parent.in_block):
            before = 0  # tags that are no blocks count only where there are no others
        if tag in BLOCK or not element.in_block:
            element.path = paths.setdefault((before, tag), len(paths) + 1)
        else:
            element.path = before
        elements.append(element)
        open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCK or tag in ENDS:
            closers.append(len(stack))
        stack.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}", re.IGNORECASE).search(page, at)
            if not dropped:
                add(page[at : end.start() if end else len(page)])
            at = end.start() if end else len(page)
    flush()
    close(0)
    return blocks, elements


def content_blocks(blocks: list[Block]) -> list[bool]:
    """Which blocks lie on content paths: ratios by path, fused, smoothed over neighbours, cut at one deviation."""
    paths = [b.path for b in blocks]
    number, length, marks = Counter(paths), Counter(), Counter()
    for b in blocks:
        length[b.path] += len(b.text)
        marks[b.path] += len(PUNCTUATION.findall(b.text))
    fused = np.array([length[p] / number[p] * (1 + marks[p] / number[p]) for p in paths])
    kernel = np.array([0.15, 0.7, 0.15])
    smooth = np.convolve(np.pad(fused, 1, mode="edge"), kernel, "valid")
    value = Counter()
    for p, v in zip(paths, smooth.tolist(), strict=True):
        value[p] += v / number[p]
    best, cut = max(value.values()), float(np.std(list(value.values())))
    return [value[p] >= min(cut, best) for p in paths]


def _size(text: str) -> int:
    return len(" ".join(text.split()))


def _outside(e: Element | None, kind: str) -> Element | None:
    """The next element outwards that speaks of furniture (``named``) or does so strongly (``strong``)."""
    return getattr(e.parent, kind) if e and e.parent else None


def _without(blocks: list[Block], elements: list[Element], gone: set[int]) -> list[Block]:
    """The blocks without the pieces under the elements ``gone``."""
    if not gone:
        return blocks
    under = dict.fromkeys(gone, True)
    for e in elements:  # outer elements come first
        if e.evidence and e.number not in under and (outer := _outside(e, "named")) and under.get(outer.number):
            under[e.number] = True
    out = []
    for b in blocks:
        pieces = tuple(p for p in b.pieces if not (p.named and p.named.number in under))
        if len(pieces) == len(b.pieces):
            out.append(b)
        elif text := _plain(pieces):
            out.append(b._replace(text=text, pieces=pieces))
    return out


def drop_named(blocks: list[Block], elements: list[Element]) -> list[Block]:
    """The blocks without those of elements that only their names make furniture.

    From the outermost inwards, an element is kept if it holds most of the text under article and main, or most of the
    page's text, or more than all the page has outside named elements. A comment thread, or an element of a page whose
    article is elsewhere, must hold nine times as much. One of weak evidence stays if any of its blocks is on a content
    path of what is left.
    """
    if not any(b.pieces for b in blocks):
        return blocks
    runs = [(p.named, _size(p.text), b.inside and b.inside.article) for b in blocks for p in b.pieces or (Piece(None, b.text),)]
    whole = sum(n for _, n, article in runs if article)
    # Text by innermost strong element, and, of that in an article, by the innermost one outside the article.
    own, inside, held = Counter(), Counter(), Counter()
    for named, n, article in runs:
        own[named.strong.number if named and named.strong else -1] += n
        if article and article.strong:
            held[article.strong.number] += n
    strong = [e for e in elements if e.evidence > WEAK]
    level: dict[int, int] = {}
    for e in strong:
        level[e.number] = level[outer.number] + 1 if (outer := _outside(e, "strong")) else 0
    seen = {e.number for named, *_ in runs for e in ([named.strong] if named and named.strong else [])}
    for e in reversed(strong):
        inside[e.number] += own[e.number]
        if outer := _outside(e, "strong"):
            inside[outer.number] += inside[e.number]
            held[outer.number] += held[e.number]
            if e.number in seen:
                seen.add(outer.number)
    by_level: dict[int, list[Element]] = {}
    for e in strong:
        if e.number in seen:
            by_level.setdefault(level[e.number], []).append(e)
    kept: set[int] = set()
    gone: set[int] = set()
    base = own[-1]
    for depth in range(len(by_level)):
        here = [e for e in by_level[depth] if not (outer := _outside(e, "strong")) or outer.number in kept]
        total = base + sum(inside[e.number] for e in here)
        times = {e.number: 9 if whole or e.evidence == THREAD else 1 for e in here}
        first = {e for e, t in times.items() if inside[e] > t * (total - inside[e]) or 2 * held[e] > whole}
        outside = base + sum(inside[e] for e in first)
        now = first | {e for e, t in times.items() if inside[e] > t * outside}
        gone |= times.keys() - now
        kept |= now
        base += sum(own[e] for e in now)
    blocks = _without(blocks, elements, gone)
    on, there, held = set(), set(), Counter()
    for b, c in zip(blocks, content_blocks(blocks) if blocks else [], strict=True):
        article = b.inside and b.inside.article
        for p in b.pieces:
            if p.named:
                there.add(p.named.number)
                if c:
                    on.add(p.named.number)
                if article and article.named:
                    held[article.named.number] += _size(p.text)
    for e in reversed(elements):
        if e.evidence and (outer := _outside(e, "named")):
            held[outer.number] += held[e.number]
            for marked in (on, there):
                if e.number in marked:
                    marked.add(outer.number)
    weak = {n for n in there - on if elements[n].evidence == WEAK}
    return _without(blocks, elements, {n for n in weak if 2 * held[n] <= whole})


def main_text(page: str | None) -> str:
    """The article of a page, blocks joined by two line ends; empty for a null, empty or textless page.

    These are all blocks on content paths, and of the element around nine tenths of their text the other blocks too.
    """
    blocks, elements = read_blocks(page or "")
    blocks = drop_named(blocks, elements)
    if not blocks:
        return ""
    chosen = content_blocks(blocks)
    held, total = [0] * len(elements), [0] * len(elements)
    for b, c in zip(blocks, chosen, strict=True):
        if b.inside:
            total[b.inside.number] += len(b.text)
            held[b.inside.number] += len(b.text) if c else 0
    for e in reversed(elements):  # text of an element: its own and that of those inside, which come later
        if e.parent:
            total[e.parent.number] += total[e.number]
            held[e.parent.number] += held[e.number]
    want = 0.9 * sum(len(b.text) for b, c in zip(blocks, chosen, strict=True) if c)
    around = max((n for n in range(len(elements)) if total[n] and held[n] >= want), default=None)
    if around is None:
        return "\n\n".join(b.text for b in blocks)
    top = elements[around]
    article = top
    while article and article.tag not in ("article", "main"):
        article = article.parent
    if article:
        top = article
    else:
        while top.parent and top.parent.tag not in ("html", "body") and total[top.parent.number] <= 1.3 * total[top.number]:
            top = top.parent
        if top.tag in ("p", *HEADINGS) and top.parent:
            top = top.parent
    within = [bool(b.inside) and top.number <= b.inside.number <= top.last for b in blocks]
    first = start = within.index(True)
    while first and blocks[first - 1].leaf in HEADINGS:  # a title may stand before the element
        first -= 1
    return "\n\n".join(
        b.text for i, (b, c) in enumerate(zip(blocks, chosen, strict=True)) if c or first <= i < start or within[i])


def _extract(page: str):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(page).to_pylist()]
            kept = [(n, batch.column(n)) for n in batch.schema.names if n not in (page, "text", "n_chars")]
            new = [("text", pa.array(texts, pa.string())), ("n_chars", pa.array([len(t) for t in texts], pa.int64()))]
            yield pa.RecordBatch.from_arrays([c for _, c in kept + new], [n for n, _ in kept + new])

    return extract


def extract_main_text(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` without its markup, with ``text`` and ``n_chars`` (code points); other columns and all rows stay.

    Columns named ``text`` or ``n_chars`` are replaced. A null, empty or textless page has an empty text.
    """
    source = pages.drop(*[c for c in ("text", "n_chars") if c != page])
    schema = StructType([*source.drop(page).schema, *StructType.fromDDL("text string, n_chars long")])
    return source.mapInArrow(_extract(page), schema)
