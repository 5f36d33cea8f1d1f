"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to blocks: the text between block-level tags, character
references decoded, white space as one space. Parts that the markup itself names as
something else (menus, page headers and footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments, hidden parts) hold no text. Over the lengths of the
blocks, links not counted, a window slides; where its sum surges over a part of the page's
peak or a number of characters, a stretch begins, and it ends where the sum dives below it. The
heaviest stretch is widened to the article, or else main element around it. If there is none, it
is widened to the element that holds it and all other stretches that are not mostly links. So
short headings and paragraphs between and beside the stretches stay.

Defined results: null or empty html gives an empty text; unclosed and wrongly nested tags
end with the element around them, open parts of tables also with the next of their kind, and open links with the next
link; a tag whose quote is never closed ends at its `>`; a page without blocks is empty; repeated rows give a
row each; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import map_rows

WINDOW = 3
# A stretch lasts while the window holds this part of the page's fullest window, or so many characters.
SURGE = 0.1
SURGE_CHARS = 80

# Nothing here looks beyond the next `<` outside quotes, so that open tags cost no more than their length.
_ATTRIBUTES = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(script|style|textarea|title)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1(?=[\s/>])[^<>]*+>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({_ATTRIBUTES})>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)>"  # a quote that is never closed
    r"|<[!?][^<>]*+>",
    re.S | re.I,
)

# Boilerplate within a line: it is followed as the holders are, but breaks no block.
_EMBEDDED = frozenset("noscript template svg math iframe object canvas audio video select button".split())
# Elements that are followed from their start tag to their end tag.
_HOLDERS = _EMBEDDED | frozenset(
    "html head body main article section div nav header footer aside form menu dialog ul ol dl table tbody thead "
    "tfoot tr td th fieldset figure details center blockquote a".split()
)
_INLINE = _EMBEDDED | {"a"}
# Parts of a table whose end tags may be left out: what the next one ends.
_ENDED_BY = {
    "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "tbody": ("thead", "tbody", "tfoot"), "thead": ("thead", "tbody", "tfoot"),
    "tfoot": ("thead", "tbody", "tfoot"),
}
_BREAKS = _HOLDERS - _INLINE | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd pre address hr caption figcaption summary legend option article hgroup".split()
)
_BOILERPLATE = _EMBEDDED | frozenset("head nav header footer aside form menu dialog fieldset".split())
_NEVER_BY_NAME = frozenset("html body main".split())
# Names that tell what an element goes with, not what it is.
_BESIDE = ("has-", "with-", "no-", "without-", "is-")
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_NAMES = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banners?|nav|navbar|navigation|menus?|breadcrumbs?|sidebar|sidebars|aside|widgets?|"
    r"footer|header|masthead|topbar|comments?|commentlist|disqus|respond|replies|cookies?|consent|gdpr|notices?|alert|"
    r"popup|modal|overlay|newsletter|subscribe|subscription|paywall|share|sharing|social|related|recommend\w*|outbrain|"
    r"taboola|login|signup|signin|search|pagination|pager|toolbar|copyright|disclaimer|skip",
    re.I,
)
_ATTRIBUTE = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_BARE_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|$)", re.I)


def _is_boilerplate(tag: str, attributes: str) -> bool:
    if tag in _BOILERPLATE:
        return True
    if tag in _NEVER_BY_NAME or not attributes.strip():
        return False
    if _BARE_HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)):
        return True
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            words = [word for word in value.split() if not word.startswith(_BESIDE)]
            # An article is judged by whole names: "sidebar-layout" is no sidebar.
            parts = words if tag == "article" else [part for word in words for part in re.split("[_-]+", word)]
            if any(map(_NAMES.fullmatch, parts)):
                return True
        if name == "role" and value.lower() in _ROLES or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and _HIDDEN.search(value):
            return True
    return False


@dataclass
class Elements:
    """The elements that hold blocks, numbered in page order; 0 is the page itself. A number stands for all elements
    around it, so that a block stores one, however deep it lies."""

    parent: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: [""])
    last: list[int] = field(default_factory=list)  # the highest number within an element

    def open(self, tag: str, parent: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        return len(self.tag) - 1

    def end(self) -> None:
        self.last = list(range(len(self.tag)))
        for n in range(len(self.tag) - 1, 0, -1):
            self.last[self.parent[n]] = max(self.last[self.parent[n]], self.last[n])

    def holds(self, n: int, inner: int) -> bool:
        return n <= inner <= self.last[n]

    def path(self, numbers: list[int]) -> list[int]:
        """The elements around all of the given ones, outermost first, without the page."""
        n, highest = min(numbers), max(numbers)
        while self.last[n] < highest:
            n = self.parent[n]
        found = []
        while n:
            found.append(n)
            n = self.parent[n]
        return found[::-1]

    def child(self, n: int, inner: int) -> int | None:
        """The element just below n that holds an inner one, if they differ."""
        if n == inner:
            return None
        while self.parent[inner] != n:
            inner = self.parent[inner]
        return inner


Block = tuple[str, int, int]


def blocks(page: str) -> tuple[list[Block], Elements]:
    """(text, characters outside links, innermost holding element) of every block that counts."""
    found: list[Block] = []
    parts: list[str] = []
    elements = Elements()
    stack: list[tuple[str, int, bool]] = []  # (tag, element around what follows, boilerplate)
    places: dict[str, list[int]] = defaultdict(list)  # where a tag stands in the stack
    embedded: list[int] = []  # where embedded elements stand in it
    linked = skipped = links = at = nested = 0
    line = ""  # the open paragraph or the like
    muted = False  # in a paragraph or the like that is boilerplate itself

    def end_block() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append((text, max(0, len(text) - linked), stack[-1][1] if stack else 0))
            parts, linked = [], 0

    def close(depth: int) -> None:
        nonlocal skipped, links
        while len(stack) > depth:
            open_tag, _, boiler = stack.pop()
            places[open_tag].pop()
            if open_tag in _EMBEDDED:
                embedded.pop()
            skipped -= boiler
            links -= open_tag == "a"

    def add(text: str) -> None:
        nonlocal linked
        if text and not skipped and not muted:
            parts.append(text)
            linked += len(text) if links else 0

    for match in _TOKEN.finditer(page):
        add(page[at : match.start()])
        at = match.end()
        tag = (match.group(3) or match.group(6) or "").lower()
        if not tag:
            continue
        ends = bool(match.group(2) or match.group(5))
        attributes = match.group(4) if match.group(4) is not None else match.group(7)
        if tag == "br":
            add(" ")
            continue
        inside = embedded[0] if embedded else None
        if inside is not None and tag not in _HOLDERS and tag == line:
            nested += -1 if ends else 1
            if nested < 0:  # the paragraph around an embedded element that was left open
                close(inside)
                inside = None
        elif inside is None:
            nested = 0
        # An end tag of what is around the embedded element, and not within it, ends that.
        ends_it = ends and bool(places[tag]) and places[tag][0] < (inside or 0) and places[tag][-1] < (inside or 0)
        if inside is not None and not (tag == "body" or ends_it):
            pass  # within an embedded element
        elif tag in _BREAKS:
            end_block()
            line = "" if ends or tag in _HOLDERS else tag
            muted = not ends and tag not in _HOLDERS and _is_boilerplate(tag, attributes)
        if tag not in _HOLDERS:
            continue
        if not ends:
            if tag == "body":  # ends a head that was left open
                close(0)
                skipped = links = 0
            if attributes.rstrip().endswith("/"):
                continue
            if tag == "a" and stack and stack[-1][0] == "a":
                close(len(stack) - 1)
            within = places["table"][-1] if places["table"] else -1
            before = max((places[t][-1] for t in _ENDED_BY.get(tag, ()) if places[t]), default=-1)
            if before > within and not (embedded and embedded[-1] > before):
                close(before)
            around = stack[-1][1] if stack else 0
            element = around if tag in _INLINE else elements.open(tag, around)
            boiler = _is_boilerplate(tag, attributes)
            places[tag].append(len(stack))
            if tag in _EMBEDDED:
                embedded.append(len(stack))
            stack.append((tag, element, boiler))
            skipped += boiler
            links += tag == "a"
        elif places[tag]:
            close(places[tag][-1])
    add(page[at:])
    end_block()
    elements.end()
    return found, elements


def stretches(lengths: list[int], window: int = WINDOW, surge: float = SURGE) -> list[tuple[int, int]]:
    """[surge, dive) of the stretches where the window sum stays over a part of its peak."""
    half = window // 2
    sums = [sum(lengths[max(0, i - half) : i + half + 1]) for i in range(len(lengths))]
    level = min(surge * max(sums, default=0), SURGE_CHARS)
    found, start = [], None
    for i, value in enumerate([*sums, -1]):
        if value > level and start is None:
            start = i
        elif value <= level and start is not None:
            found.append((start, i))
            start = None
    return found


def main_text(page: str) -> str:
    parts, elements = blocks(page)
    lengths = [plain for _, plain, _ in parts]
    found = stretches(lengths)
    if not found:
        return ""

    def core(*spans: tuple[int, int]) -> list[int]:
        return [element for span in spans for _, plain, element in parts[slice(*span)] if plain]

    heaviest = max(found, key=lambda span: (sum(lengths[span[0] : span[1]]), -span[0]))
    path = elements.path(core(heaviest))
    if not any(elements.tag[n] in ("article", "main") for n in path):
        texts = [span for span in found if 2 * sum(lengths[slice(*span)]) >= sum(len(text) for text, _, _ in parts[slice(*span)])]
        path = elements.path(core(heaviest, *texts))
    # The outermost article around the core, else main, else the element that holds it.
    named = [n for tag in ("article", "main") for n in path if elements.tag[n] == tag]
    holder = named[0] if named else path[-1] if path else 0
    if holder and elements.tag[holder] not in ("html", "body"):
        return "\n".join(text for text, _, element in parts if elements.holds(holder, element))
    first, last = found[0][0], found[-1][1]
    # The parts of the page in which the first surge and the last dive lie are taken to their ends.
    ends = core((first, last))
    edges = [n for n in {elements.child(holder, inner) for inner in (ends[0], ends[-1])} if n is not None]
    kept = [
        text for i, (text, plain, element) in enumerate(parts)
        if (first <= i < last or any(elements.holds(n, element) for n in edges)) and 2 * plain >= len(text)
    ]
    return "\n".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def task():
        def each(rows):
            texts = [main_text(page) for page in rows["html"]]
            return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]}

        return each

    columns = [F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")]
    return map_rows(pages.select(*columns), task, "page_id long, url string, text string, n_chars long", arrow)
