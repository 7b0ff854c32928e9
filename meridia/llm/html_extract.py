"""Main text of web pages by two-pass block rules (operator 3).

A page is cut into blocks at block-level tags. The first pass classes a block by
its link density, its length and its share of stop words: linked blocks are bad,
prose is good, and what is short, or in between, is ambiguous. The second pass
gives ambiguous blocks the label of the nearest decided neighbour; a heading
looks at the blocks that follow it first.

Containers (menus, asides, forms, adverts, comments; articles) are features of
both passes: less is asked of prose in an article, prose in an advert or a
comment is not the article's, and the nearest neighbour is sought in the block's
own container. Only where no block of a container is decided does its kind decide.
A class word tells nothing of a container that holds most of the page's text and
all of its articles.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeing, pick, prepare_python

#: Share of linked characters from which a block is a menu.
LINK_DENSITY = 0.33
#: Code points under which a block is too short to judge, and from which it is long.
SHORT, LONG = 70, 200
#: Shares of stop words from which a block reads as prose, for shorter and for long blocks; elsewhere, and in an article.
STOP_HIGH, STOP_LOW = 0.30, 0.20
STOP_HIGH_IN, STOP_LOW_IN = 0.10, 0.05
#: Share of the page's unlinked characters from which a container is the page, whatever its class words say.
MOST = 0.5

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """a an and are as at be by for from has he in is it its not of on or that the this to was were will with you
    au aux avec ce dans de des du elle en est et il la le les ne pas pour par plus que qui sur un une
    aber auf aus das dem den der des die ein eine einer für im ist mit nicht sich sie sind und von war zu
    al como con del el es esta la las lo los más no para pero por que se sin su una y""".split()
)

#: Elements whose content never is a page's text.
DROPPED = frozenset("script style noscript template textarea select option button iframe object embed svg math canvas audio video head title map".split())
#: Of these, the ones whose content is not markup.
RAW = frozenset("script style textarea title iframe noscript".split())
#: Containers of what is not the article, and of the article.
OUTSIDE = frozenset("nav footer aside form menu dialog header".split())
INSIDE = frozenset("article main".split())
#: Elements that begin and end a block.
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th
    thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id or role that mark what is not the article.
CUES = frozenset(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent
    contentinfo cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices
    pager pagination popup promo promotion recommended related replies reply respond search share sharing sidebar signup skip
    social sponsor sponsored subscribe toolbar widget""".split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^<>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_CUE_WORD = re.compile(r"[a-z]+")
_LETTERS = re.compile(r"[^\W\d_]+")

#: How a container takes part: its blocks are the article's, or are not, or go unread.
IN, OUT, GONE = "in", "out", "gone"


class Block:
    """A block's text, how many of its characters are linked, whether it is a heading, and the containers around it."""

    __slots__ = ("around", "by", "heading", "label", "linked", "region", "side", "text")

    def __init__(self, text: str, linked: int, around: list[tuple[int, str, bool]], heading: bool) -> None:
        self.text, self.linked, self.around, self.heading = text, linked, around, heading
        self.side, self.region, self.label, self.by = None, 0, "", ""


def _side(name: str, rest: str) -> tuple[str | None, bool]:
    """How an opening tag says its container takes part, and whether only a class word says so."""
    if name in DROPPED:
        return GONE, False
    side, by_class = IN if name in INSIDE else OUT if name in OUTSIDE else None, False
    if rest:
        for key, value in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return GONE, False
            if key in ("class", "id", "role") and name != "body" and not CUES.isdisjoint(_CUE_WORD.findall(value)):
                by_class = by_class or side != OUT
                side = OUT
    return side, by_class


def _place(found: list[Block]) -> None:
    """Set each block's side and region: the innermost container around it that tells something."""
    own = [len(b.text) - b.linked for b in found]
    inside: dict[int, int] = {}
    for block, n in zip(found, own, strict=True):
        for number, _, by_class in block.around:
            if by_class:
                inside[number] = inside.get(number, 0) + n
    # a container beside an article is not the page
    for block in found:
        if any(side == IN for _, side, _ in block.around):
            held = {number for number, _, _ in block.around}
            inside = {number: n if number in held else 0 for number, n in inside.items()}
    for block in found:
        told = [(number, side) for number, side, by_class in block.around if not by_class or inside[number] <= MOST * sum(own)]
        block.region, block.side = told[-1] if told else (0, None)


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    found: list[Block] = []
    stack: list[tuple[str, str | None, bool, int]] = []  # open containers that are blocks or dropped
    parts: list[str] = []
    linked, in_link, heading, at, gone, number = 0, 0, False, 0, 0, 0

    def flush() -> None:
        nonlocal linked, parts
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found.append(Block(text, min(linked, len(text)), [(n, side, by_class) for _, side, by_class, n in stack if side], heading))
        parts, linked = [], 0

    def add(piece: str) -> None:
        nonlocal linked
        if not gone and piece:
            parts.append(piece)
            if in_link:
                linked += len(" ".join(html.unescape(piece).split()))

    place, last = 0, page.rfind(">")
    # what follows the last ">" is an unclosed comment or no tag
    while match := _TOKEN.search(page, place) if place <= last or "<!--" in page[place:] else None:
        add(page[at : match.start()])
        at = place = match.end()
        name = (match["name"] or "").lower()
        if not name:
            continue
        if match["close"]:
            if name == "a":
                in_link = 0
            elif name in BLOCKS or name in DROPPED:
                if name in BLOCKS:
                    flush()
                    if name in HEADINGS:
                        heading = False
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        gone -= sum(s == GONE for _, s, _, _ in stack[depth:])
                        del stack[depth:]
                        break
            continue
        if name == "a":
            in_link = 1
        elif name == "br":
            add("\n")
        elif name in BLOCKS or name in DROPPED:
            if name in BLOCKS:
                flush()
                heading = name in HEADINGS
            if name not in VOID and not match["rest"].endswith("/"):
                if name in RAW:
                    end = re.compile(f"</{name}", re.IGNORECASE).search(page, place)
                    at = place = end.start() if end else len(page)
                side, by_class = _side(name, match["rest"])
                number += 1
                if name in ("p", "li") and stack and stack[-1][0] == name:  # an end tag that may be left out
                    gone -= stack.pop()[1] == GONE
                if side == IN:  # an article ends what was left open around it
                    gone = 0
                    stack = [(n, None if s == GONE else s, c, k) for n, s, c, k in stack]
                stack.append((name, side, by_class, number))
                gone += side == GONE
    add(page[at:])
    flush()
    _place(found)
    return found


def _judge(block: Block) -> str:
    """First pass: good, bad, or ambiguous."""
    size = len(block.text)
    if block.linked > LINK_DENSITY * size or block.text.startswith(("©", "(c) ", "Copyright")):
        return "bad"
    if size < SHORT or block.heading:
        return "bad" if block.linked and block.side != IN else "ambiguous"
    words = [w.lower() for w in _LETTERS.findall(block.text)]
    share = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    high, low = (STOP_HIGH_IN, STOP_LOW_IN) if block.side == IN else (STOP_HIGH, STOP_LOW)
    if share >= (low if size >= LONG else high):
        return "bad" if block.side == OUT else "good"
    return "ambiguous" if size < LONG or block.side == IN else "bad"


def _neighbours(first: list[str], places: list[int]) -> dict[int, tuple[int | None, int | None]]:
    """The nearest decided places before and after each of ``places``, among them."""
    before: dict[int, int | None] = {}
    last = None
    for i in places:
        before[i] = last
        last = i if first[i] != "ambiguous" else last
    found, last = {}, None
    for i in reversed(places):
        found[i] = before[i], last
        last = i if first[i] != "ambiguous" else last
    return found


def classify(found: list[Block]) -> list[Block]:
    """Both passes: sets the blocks' labels to good or bad, and ``by`` to what decided."""
    first = [_judge(b) for b in found]
    regions: dict[int, list[int]] = {}
    for i, block in enumerate(found):
        regions.setdefault(block.region, []).append(i)
    near = {}
    for places in regions.values():
        near |= _neighbours(first, places)
    anywhere = _neighbours(first, list(range(len(found))))
    for i, block in enumerate(found):
        if first[i] != "ambiguous":
            block.label, block.by = first[i], "block"
            continue
        left, right = near[i] if block.side else anywhere[i]
        if left is None and right is None and block.side:
            block.label, block.by = "good" if block.side == IN else "bad", "container"
            continue
        block.by = "neighbour"
        if left is None or right is None:
            # at either end of a page without containers there is nothing good
            at = left if right is None else right
            block.label = first[at] if at is not None and (block.side or block.heading and at == right) else "bad"
        elif block.heading:
            block.label = first[right]
        elif first[left] == first[right] or i - left != right - i:
            block.label = first[left] if i - left <= right - i else first[right]
        else:
            block.label = "bad"
    return found


def main_text(page: str | None) -> str:
    """The good blocks' text, joined by empty lines; empty if there is none."""
    return "\n\n".join(b.text for b in classify(blocks(page or "")) if b.label == "good")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Return page_id, url, text, n_chars of every page.

    Null and empty pages, and pages without an article, have the empty text.
    Repeated rows, null ids and null urls stay; other columns are ignored; an
    empty table gives an empty result.
    """
    prepare_python(pages.sparkSession)
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col)
    return rows.mapInArrow(freeing(_extract), "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
