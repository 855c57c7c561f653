"""Main text of web pages by a minimum cut between content and boilerplate.

A page's text blocks are the nodes. What tags, class names, links and length say of a block is its
cost for either side (terminal capacities). A class name or id that speaks for boilerplate is not
believed of an element that holds the page's article, see ``_wrappers``; blocks that follow each other, and blocks that share an
element, are joined by edges whose weight falls with their distance in the tree. The minimum cut
keeps the blocks on the content side. Every page is a graph of its own, in one task.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PART = re.compile(r"[a-z0-9]+")

# Elements by what they do to text.
_NEVER_TEXT = frozenset("script style noscript template svg annotation annotation-xml iframe canvas title textarea".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
# Of these, those that may hold one another.
_NESTED = frozenset("svg template".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements below so many others count as their parents, as in browsers.
DEEPEST = 512
# What speaks for boilerplate and for content.
_BOILERPLATE_TAGS = frozenset("nav footer aside form menu button select dialog search".split())
_CONTENT_TAGS = frozenset("article main".split())
_BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu".split())
_BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted promotion related recommended replies reply respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe tags toolbar widget".split()
)
_ADVERT_NAMES = frozenset("ad ads adv advert adverts advertisement advertising promo promoted promotion sponsor sponsored".split())
_CONTENT_NAMES = frozenset("article articlebody content entry post story maintext".split())

REGION = 6.0  # cost of going against the nearest element that names its purpose
LINKS = 4.0  # cost of calling content what is all links
OUTSIDE = -0.5  # what standing outside a named article counts of that
PLAIN = 0.5  # what speaks for content if nothing else does
PROSE = 2.5  # most that length without links can say for content
NEIGHBOUR = 0.8  # weight between blocks that follow each other under one element
BORDER = 0.25  # what is left of that where one has a named purpose and the other another or none
SHARED = 0.4  # weight between the next two blocks of one element with others in between


class _Element:
    """A block element of the page, with its parent and depth among block elements, and what is said of it: the cue in
    force, vetoes by name around it, and "main" or "article" if one lies below these."""

    __slots__ = ("parent", "depth", "cue", "vetoes", "below")

    def __init__(self, parent: _Element | None, cue: float, vetoes: tuple[int, ...], below: str):
        self.parent, self.cue, self.vetoes, self.below = parent, cue, vetoes, below
        self.depth = parent.depth + 1 if parent else 1


class _Block:
    __slots__ = ("text", "element", "cue", "linked", "chars", "vetoes", "below")

    def __init__(
        self, text: str, element: _Element | None, cue: float, linked: int, chars: int, vetoes: tuple[int, ...] = (), below: str = ""
    ):
        self.text, self.element, self.cue, self.linked, self.chars = text, element, cue, linked, chars
        # Elements around it that are boilerplate by name alone, and "main" or "article" if one lies below them.
        self.vetoes, self.below = vetoes, below


def _cue(tag: str, attributes: str, inside_content: bool) -> tuple[float | None, bool, str]:
    """+1 for content, -1 for boilerplate, None if an element says nothing of its purpose; whether
    only its names say so; and "main" or "article" if it is one. What <html> and <body> are called says nothing."""
    if tag in ("html", "body"):
        return None, False, ""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    if "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower():
        return -1.0, False, ""
    if found.get("aria-hidden", "").lower() == "true":
        return -1.0, False, ""
    role = found.get("role", "").lower()
    if tag == "form" and role not in _BOILERPLATE_ROLES:
        return -1.0, True, ""  # whole pages may stand in one
    if tag in _BOILERPLATE_TAGS or role in _BOILERPLATE_ROLES:
        return -1.0, False, ""
    if tag == "header":
        return None if inside_content else -1.0, False, ""
    names = set(_NAME_PART.findall(f"{found.get('class', '')} {found.get('id', '')}".lower()))
    if names & _CONTENT_NAMES:
        names -= {"header"}  # an article's own
    if tag in _HEADINGS:
        names -= _BOILERPLATE_NAMES  # what a heading is called says what it is about
    content = "main" if "main" in (tag, role) else "article" if "article" in (tag, role) else ""
    if names & _BOILERPLATE_NAMES and not (content and not names & {"comment", "comments", "reply"}):
        if not (inside_content and names & {"header"}):
            return -1.0, True, ""
    if content or names & _CONTENT_NAMES:
        return 1.0, False, content
    return None, False, ""


def text_blocks(html: str, wrappers: frozenset[int] = frozenset()) -> list[_Block]:
    """The blocks of a page in order, with their elements and what those say of them.

    ``wrappers``: numbers of elements whose names are not read as boilerplate.
    """
    blocks: list[_Block] = []
    # Tag, cue in force, number of the element, vetoes by name around, main or article below these, block
    # element, whether its text is shown.
    stack: list[tuple[str, float, int, tuple[int, ...], str, _Element | None, bool]] = []
    open_tags: Counter[str] = Counter()
    too_deep: Counter[str] = Counter()
    parts: list[str] = []
    linked = elements = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            element = stack[-1][5] if stack else None
            said = (element.cue, element.vetoes, element.below) if element else (0.0, (), "")
            blocks.append(_Block(text, element, said[0], linked, len(text), *said[1:]))
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and (not stack or stack[-1][6]):
            text = unescape(raw)
            parts.append(text)
            if open_tags["a"]:
                linked += len(text.strip())

    def close(back: int) -> None:
        for entry in stack[back:]:
            open_tags[entry[0]] -= 1
        del stack[back:]

    at = 0
    while True:
        found = _MARKUP.search(html, at)
        if found is None:
            say(html[at:])
            break
        say(html[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        closing = found[1] or found[4]
        if tag in _NEVER_TEXT and not closing:
            if not (found[3] or found[6] or "").endswith("/"):
                at = _end_of(tag, html, at)
            continue
        if tag == "head":  # its elements with text are none of the page's; the end tag may be left out
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            flush()
        if closing:
            if too_deep[tag]:
                too_deep[tag] -= 1
            elif open_tags[tag]:
                close(next(back for back in range(len(stack) - 1, -1, -1) if stack[back][0] == tag))
            continue
        if tag in _VOID or (found[3] or found[6] or "").endswith("/") and tag not in _BLOCK:
            continue
        if len(stack) >= DEEPEST:
            too_deep[tag] += 1
            continue
        # A new block ends an open paragraph; an item ends the item before it.
        if tag in _BLOCK or tag == "option":
            for back in range(len(stack) - 1, -1, -1):
                open_tag = stack[back][0]
                if open_tag == "p" or open_tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    close(back)
                    break
                if open_tag in _BLOCK:
                    break
        _, before, _, vetoes, below, element, shown = stack[-1] if stack else _PAGE
        attributes = found[3] or found[6] or ""
        own, by_name, named = _cue(tag, attributes, before > 0) if tag in _BLOCK or attributes else (None, False, "")
        elements += 1
        if tag not in _BLOCK and own is not None and own < 0:
            # Inside a line of text: not shown, or an advert; other names speak of blocks below it, if there are any.
            if not by_name or set(_NAME_PART.findall(attributes.lower())) & _ADVERT_NAMES:
                shown = False
        if by_name and elements in wrappers:
            own = None
        elif own is not None and own < 0:
            # What an element says besides its names is final, also for what is below.
            if not by_name:
                vetoes, below = (), ""
            elif before >= 0 or vetoes:
                vetoes, below = (*vetoes, elements), ""
        elif vetoes and named and below != "main":
            below = named
        # An advert, menu or comment inside an article is none of it, and nothing in a menu is content.
        cue = before if own is None or before < 0 else own
        if tag in _BLOCK:
            element = _Element(element, cue, vetoes, below)
        stack.append((tag, cue, elements, vetoes, below, element, shown))
        open_tags[tag] += 1
    flush()
    return blocks


_PAGE = ("", 0.0, 0, (), "", None, True)


def _end_of(tag: str, html: str, at: int) -> int:
    """Where an element without text ends whose content begins at ``at``."""
    if tag not in _NESTED:
        return re.compile(rf"</{re.escape(tag)}\s*[^>]*>|\Z", re.I).search(html, at).end()
    depth = 1
    for found in re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*?(/?)>", re.I).finditer(html, at):
        depth += -1 if found[1] else 0 if found[2] else 1
        if depth == 0:
            return found.end()
    return len(html)


def _leaning(block: _Block, named: bool) -> float:
    """Above 0 for content, below for boilerplate: the difference of the two terminal capacities.

    ``named``: the page names its article, so that what is outside of it is less likely content.
    """
    density = min(1.0, block.linked / block.chars)
    words = block.text.count(" ") + 1
    cue = OUTSIDE if named and block.cue == 0 else block.cue
    return REGION * cue - LINKS * density + (1 - density) * (PLAIN + PROSE * min(1.0, words / 30))


def _apart(a: _Element | None, b: _Element | None) -> int:
    """Steps from one block element to another by the nearest that holds both."""
    steps = 0
    while a is not b:
        if b is None or a is not None and a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def _edges(blocks: list[_Block]) -> list[tuple[int, int, float]]:
    edges = []
    latest: dict[_Element | None, int] = {}
    for i, block in enumerate(blocks):
        if i:
            weight = NEIGHBOUR / (1 + max(0, _apart(blocks[i - 1].element, block.element) - 2))
            edges.append((i - 1, i, weight if block.cue == blocks[i - 1].cue else weight * BORDER))
        parent = block.element.parent if block.element else None
        if parent in latest and latest[parent] != i - 1:
            edges.append((latest[parent], i, SHARED))
        latest[parent] = i
    return edges


def minimum_cut(leaning: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: Dinic's maximum flow with both terminals folded into the nodes."""
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in leaning]
    for a, b, weight in edges:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += [b, a]
        room += [weight, weight]
    supply = [max(0.0, x) for x in leaning]
    demand = [max(0.0, -x) for x in leaning]
    tiny = 1e-9
    while True:
        level = [0 if s > tiny else -1 for s in supply]
        queue = deque(i for i, s in enumerate(supply) if s > tiny)
        met = False
        while queue:
            i = queue.popleft()
            met = met or demand[i] > tiny
            for e in out[i]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not met:
            return [x >= 0 for x in level]
        next_edge = [0] * len(leaning)
        for source in range(len(leaning)):
            while supply[source] > tiny:
                # One path at a time, depth first, along rising levels.
                path: list[int] = []
                node = source
                while demand[node] <= tiny:
                    while next_edge[node] < len(out[node]):
                        e = out[node][next_edge[node]]
                        if room[e] > tiny and level[to[e]] == level[node] + 1:
                            break
                        next_edge[node] += 1
                    else:
                        if not path:
                            break
                        node = to[path.pop() ^ 1]
                        next_edge[node] += 1
                        continue
                    path.append(e)
                    node = to[e]
                if demand[node] <= tiny:
                    break
                flow = min([supply[source], demand[node], *(room[e] for e in path)])
                supply[source] -= flow
                demand[node] -= flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def _wrappers(blocks: list[_Block], named: bool, empty: bool) -> set[int]:
    """Elements that are boilerplate by name alone but hold the page's article.

    They hold its main element, or, where no other content is named, the articles in the fewest such
    elements, or, where nothing would be left of the page, its longest block and most of its text that
    is not links.
    """
    found = {v for b in blocks for v in b.vetoes if b.below == "main"}
    if not found and not named:
        chains = [b.vetoes for b in blocks if b.below == "article"]
        found = {v for chain in chains if len(chain) == min(map(len, chains)) for v in chain}
    if not found and empty:
        plain = [b.chars - b.linked for b in blocks]
        longest = max(range(len(blocks)), key=plain.__getitem__)
        vetoes = blocks[longest].vetoes
        if vetoes and 2 * sum(n for n, b in zip(plain, blocks) if vetoes[0] in b.vetoes) > sum(plain):
            found.update(vetoes)
    return found


def main_text(html: str) -> str:
    wrappers: frozenset[int] = frozenset()
    while True:
        blocks = text_blocks(html, wrappers)
        named = any(b.cue > 0 for b in blocks)
        content = minimum_cut([_leaning(b, named) for b in blocks], _edges(blocks))
        found = _wrappers(blocks, named, bool(blocks) and not any(content))
        if not found:
            break
        wrappers |= found
    return "\n\n".join(b.text for b, keep in zip(blocks, content) if keep)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [main_text(html or "") for html in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extracted_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html).

    Character references are decoded, white space in a block becomes one space, and blocks are
    joined in page order by an empty line. Null or empty html, and pages without content, give an empty
    text. Markup that is cut off ends with the page. Very long pages are read whole, one at a time. Repeated rows give repeated results, null ids and
    urls stay null, further columns are ignored, and an empty table gives no rows.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = dict(rows.dtypes)["page_id"]
    return rows.mapInArrow(_texts, f"page_id {kind}, url string, text string, n_chars long")
