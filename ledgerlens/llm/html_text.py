"""Operator 8: main text of a page by block rules in two passes.

The page is cut into blocks at block-level tags. The first pass decides each
block from its own words: long blocks with few links are text, blocks of links
and of boilerplate marks are not, and short ones stay open. Stop-word density
separates prose from lists of labels. In the second pass open blocks take
the label of the nearest decided neighbours on both sides; headings go with the
text that follows them.

Markup that names its role (nav, footer, aside, form, hidden parts, class or id
words such as advert, cookie, comment) decides against its blocks. Words that also
qualify a page's layout (sidebar, share, search) count only where they
come first, and neither they nor a form, aside or header count if they enclose most of the page's
prose. A page's article or main element bounds where its text can be, if it holds most of the prose.

The work is per page and vector-free, so it runs as one mapInArrow over the
scan: no shuffle, memory of one page at a time.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of the four languages of the tables.
STOP_WORDS = frozenset(
    "the of and to in is it for on that with as was at by an be this are from or not which but have has had his her they you we a i he she "
    "der die das und ist in den von zu mit sich des auf für im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei um am "
    "le la les de des du et un une est en que qui dans pour pas sur au avec ce il elle ne se par plus son sa ses aux ou mais nous vous "
    "el los las del y que un una es en se no por con para su al lo como más pero sus o este ha si porque esta entre cuando muy sin sobre".split()
)
# Elements whose whole content is not text of the page.
SKIP = frozenset("script style noscript template svg math iframe object canvas audio video select option textarea button datalist map head title".split())
# Elements that hold page furniture.
FURNITURE = frozenset("nav footer aside form menu dialog header".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What may stand in a head; anything else ends it, as its end tag may be left out.
IN_HEAD = frozenset("html head title base link meta script style noscript template".split())
FOREIGN = frozenset(("svg", "math"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class, id or role attributes that name furniture wherever they stand.
ROLE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adbox|banner|breadcrumb\w*|comment\w*|cookie\w*|consent|disqus\w*|footer|gdpr|"
    r"nav\w*|newsletter|pagination|pager|popup|promo\w*|related|reply|replies|respond|subscribe|subscription|navigation)(?:$|[\s_-])",
    re.I,
)
# Words that name furniture as the first word of a class, or in an id or role.
FIRST_ROLE = re.compile(
    r"(?:^|[\s_-])(?:login|masthead|menu\w*|modal|notice\w*|share|sharing|sidebar\w*|signup|social\w*|sponsor\w*|"
    r"toolbar|(?:site|page|top|global|main)[_-]?header|widget\w*|contentinfo|complementary|search|alert\w*|disclaimer)(?:$|[\s_-])",
    re.I,
)
# Class words that state an absence or a setting name nothing.
STATE = re.compile(r"(?:no|has|with|without|hide|show|is|not)[-_].*|.*[-_](?:enabled|disabled|ready|open|closed|on|off|active)", re.I)
MAIN_ROLE = re.compile(r"(?:main|article|post|entry|story)[-_]?(?:body|content|text|main)|articlebody", re.I)
# Elements that are furniture unless they enclose most of the prose.
SOFT = frozenset("aside form header".split())
# A quote opens a value only behind an equals sign; an apostrophe inside an unquoted value does not.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)", re.S
)
ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
# A slash that ends an unquoted value does not close the element.
SLASH_VALUE = re.compile(r"=\s*[^\s\"'>]*/$")
SPACE = re.compile(r"\s+")
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
LEGAL = re.compile(r"(?:\W*(?:copyright|all rights reserved)\b|\s*\u00a9)", re.I)
LONG_CHARS = 90
STOP_LOW, STOP_HIGH = 0.08, 0.18
MAX_LINK = 0.33
RAW = {t: re.compile(rf"</{t}\s*[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "iframe", "noscript", "template")}


class Block:
    """A run of text between block-level tags: its characters, those in links, and where it stands."""

    __slots__ = ("furniture", "heading", "inside", "linked", "marks", "parts", "text")

    def __init__(self, furniture: bool, marks: tuple[int, ...], inside: bool, heading: bool):
        self.parts: list[str] = []
        self.linked = 0
        # marks: numbers of the enclosing elements that are furniture unless they hold most of the prose
        self.furniture, self.marks, self.inside, self.heading = furniture, marks, inside, heading
        self.text = ""


def blocks_of(page: str) -> tuple[list[Block], bool]:
    """Blocks with text in page order, and whether an article or main element bounds the page's text."""
    out: list[Block] = []
    # open elements: (tag, is furniture, is main part, number of its mark or 0)
    stack: list[tuple[str, bool, bool, int]] = []
    furniture = inside = links = skipped = n_marks = 0
    has_main, at, n = False, 0, len(page)
    now: Block | None = None
    xml = page[:100].lstrip("\ufeff \t\r\n").startswith("<?xml")

    def text(piece: str) -> None:
        nonlocal now, skipped
        if piece and stack and stack[-1][0] == "head" and not piece.isspace():
            stack.pop()
            skipped -= 1
        if not piece or skipped:
            return
        if now is None:
            if piece.isspace():
                return
            now = Block(furniture > 0, tuple(e[3] for e in stack if e[3]), inside > 0, any(e[0] in HEADINGS for e in stack[-4:]))
            out.append(now)
        if "&" in piece:
            piece = html_lib.unescape(piece)
        now.parts.append(piece)
        if links:
            now.linked += len(SPACE.sub("", piece))

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        m = TOKEN.match(page, lt)
        if m is None:
            text(page[at : lt + 1])
            at = lt + 1
            continue
        text(page[at:lt])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if not m.group(1) and tag not in IN_HEAD and stack and stack[-1][0] == "head":
            stack.pop()
            skipped -= 1
        if tag == "br" and now is not None and not skipped:
            now.parts.append(" ")
        if tag in BLOCK:
            now = None
        if m.group(1):
            if tag in VOID:
                continue
            # close the nearest open element of that name, and all within it
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    for name, f, a, _ in stack[i:]:
                        furniture -= f
                        inside -= a
                        links -= name == "a"
                        skipped -= name in SKIP
                    del stack[i:]
                    break
            continue
        if tag in VOID:
            continue
        if tag == "p" or tag == "a":
            # an open p ends at the next one; a link cannot hold a link
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    name, f, a, _ = stack.pop(i)
                    furniture -= f
                    inside -= a
                    links -= name == "a"
                    break
                if stack[i][0] in BLOCK and tag == "p":
                    break
        raw = (m.group(3) or "").strip()
        closed = raw.endswith("/") and not SLASH_VALUE.search(raw) and (xml or tag in FOREIGN or any(e[0] in FOREIGN for e in stack))
        main, bad, soft = tag in ("article", "main"), tag in FURNITURE and tag not in SOFT, tag in SOFT
        if raw and raw != "/":
            attrs = {k.lower(): v.strip("\"'") for k, v in ATTR.findall(raw)}
            main = main or attrs.get("role") in ("main", "article")
            bad = bad or "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDDEN.search(attrs.get("style", "")) is not None
            classes = [c for c in attrs.get("class", "").split() if not STATE.fullmatch(c)]
            named = [attrs[k] for k in ("id", "role") if attrs.get(k)]
            if (classes or named) and tag not in ("html", "body") and not main and not (inside and any("header" in c.lower() for c in classes + named)):
                bad = bad or ROLE.search(" ".join(classes + named)) is not None
                first = " ".join(classes[:1] + named)
                content = any(MAIN_ROLE.fullmatch(c) for c in classes + named)
                soft = not content and (soft or FIRST_ROLE.search(first) is not None or bool({"header", "top"} & set(first.lower().split())))
        if tag == "header" and inside:
            bad = soft = False  # the heading part of an article
        if main and (furniture or bad or skipped):
            main = False
        if not closed:
            has_main = has_main or main
            n_marks += soft
            stack.append((tag, bad, main, n_marks if soft else 0))
            furniture += bad
            inside += main
            links += tag == "a"
            skipped += tag in SKIP
            if tag in RAW:
                end = RAW[tag].search(page, at)
                at = end.start() if end else n
    kept = []
    for b in out:
        b.text = SPACE.sub(" ", "".join(b.parts)).strip()
        if b.text:
            kept.append(b)
    return kept, _settled(kept, has_main)


def _settled(blocks: list[Block], has_main: bool) -> bool:
    """Make furniture of what lies in marked elements that do not hold most of the prose; whether the main element bounds the text."""
    prose = [len(b.text) if not b.furniture and content_label(b) else 0 for b in blocks]
    held: dict[int, int] = {}
    for b, n in zip(blocks, prose):
        for mark in b.marks:
            held[mark] = held.get(mark, 0) + n
    total = sum(prose)
    for b in blocks:
        b.furniture = b.furniture or any(2 * held[mark] <= total for mark in b.marks)
    left = [(b.inside, n) for b, n in zip(blocks, prose) if not b.furniture]
    return has_main and 2 * sum(n for inside, n in left if inside) >= sum(n for _, n in left)


def first_pass(b: Block, has_main: bool) -> bool | None:
    """True: text, False: furniture, None: undecided."""
    return False if b.furniture or (has_main and not b.inside) else content_label(b)


def content_label(b: Block) -> bool | None:
    """What a block's own words say: True for prose, False for links and legal lines, None for short or odd ones."""
    chars = max(1, len(b.text) - b.text.count(" "))
    if b.linked / chars > MAX_LINK:
        return False if b.linked / chars > 0.6 or len(b.text) < LONG_CHARS else None
    if b.heading:
        return None
    if not b.inside and len(b.text) < 2 * LONG_CHARS and LEGAL.match(b.text):
        return False
    words = b.text.lower().split()
    density = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
    if len(b.text) >= LONG_CHARS:
        return True if density >= STOP_LOW or len(b.text) >= 3 * LONG_CHARS else None
    return True if density >= STOP_HIGH and len(words) >= 8 else None


def second_pass(labels: list[bool | None], blocks: list[Block], has_main: bool) -> list[bool]:
    """Undecided blocks take the label of their nearest decided neighbours.

    Blocks that markup has decided (furniture, or outside the main element) do
    not vote: a footer says nothing about the last paragraph. Headings follow the
    next decided block; at equal distances text wins only if both neighbours
    are text. Without any neighbour that votes, a block is text.
    """
    n = len(labels)
    votes = [None if b.furniture or (has_main and not b.inside) else x for x, b in zip(labels, blocks)]
    before: list[tuple[bool, int] | None] = [None] * n
    after: list[tuple[bool, int] | None] = [None] * n
    for order, seen, step in ((range(n), before, 1), (range(n - 1, -1, -1), after, -1)):
        last = None
        for i in order:
            if votes[i] is not None:
                last = i
            elif last is not None:
                seen[i] = (votes[last], (i - last) * step)
    out = []
    for i, own in enumerate(labels):
        near = [x for x in (before[i], after[i]) if x is not None]
        if own is not None:
            out.append(own)
        elif not near:
            out.append(True)
        elif blocks[i].heading and after[i] is not None:
            out.append(after[i][0])
        else:
            d = min(x[1] for x in near)
            out.append(all(x[0] for x in near if x[1] == d))
    return out


def main_text(page: str | None) -> str:
    """Main text of one page: blocks joined by one line feed; empty for a null, empty or text-free page."""
    if not page:
        return ""
    blocks, has_main = blocks_of(page)
    labels = [first_pass(b, has_main) for b in blocks]
    keep = second_pass(labels, blocks, has_main)
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = [main_text(x.as_py()) for x in b.column(2)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row, from its whole HTML.

    A null or empty page, or one without text, gives an empty text; ids and
    URLs pass through (nulls too); repeated rows are extracted each; an empty
    table gives no rows; other columns are not read.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
