"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass classifies every
block by itself: by where it stands, its link density, its length and the share of
stop words among its words.  Short blocks stay undecided; the second pass gives them
the label of their nearest decided neighbours.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: tags, words and thresholds of the rules --------------------------------
BLOCK_TAGS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead title tr ul".split())
#: Elements whose place in the page counts; other tags only end blocks or are inline.
HOLDERS = set(
    "article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section "
    "table ul".split())
#: Elements whose content is no text of the page.
SILENT = set(
    "applet audio button canvas datalist head iframe map math noframes noscript object script select style svg "
    "template textarea title video".split())
BOILERPLATE_TAGS = {"nav", "aside", "footer", "form", "dialog", "menu"}
MAIN_TAGS = {"article", "main"}
#: Words of class, id and role values that mark what is no article text.
BOILERPLATE_WORDS = set(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "contentinfo cookie cookies complementary dialog discussion disqus footer gdpr login menu modal nav navbar "
    "navigation newsletter notice notification pager pagination popup promo promotion recommended related replies reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags teaser toc toolbar widget".split())
#: The same for elements that hold a page's or an article's head.
HEAD_WORDS = {"header", "masthead", "topbar", "head"}
#: Words that make an article element a reader's comment or a teaser.
NOT_ARTICLE_WORDS = {"comment", "comments", "reply", "replies", "teaser", "related", "promo", "ad", "ads", "sponsored", "widget"}
MAIN_WORDS = {"article", "articlebody", "content", "entry", "post", "story", "main"}
STOP_WORDS = set(
    "a an and are as at be by for from had has have he her his i in is it its not of on or she that the their they this to "
    "was we were which with you "
    "als am auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit nach nicht sich "
    "sie sind so um und von vor war wie zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il je la le les leur mais ne nous par pas plus pour qu que qui "
    "sa se ses son sur un une "
    "al como con del el ella ha las lo los más no para pero por sin su sus una y".split())
SHORT, LONG = 70, 200  # characters
STOP_LOW, STOP_HIGH = 0.20, 0.30
LINKS_MOST, LINKS_MOST_MAIN = 0.2, 0.7
# -------------------------------------------------------------------------------------------

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_ANCHOR = re.compile(r"<(/?)a(?=[\s/>])", re.I)
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
_WORDS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")
#: What a class says an element has or lacks, which is not what it is.
_HAS = re.compile(r"(?<![a-zA-Z0-9])(?:has|with|without|no)(?:[-_]+|(?=[A-Z]))\S*")
#: The named ones rest on the class words of a div or section only.
_DROP, _OUTER_HEAD, _NAMED_DROP, _NAMED_HEAD, _MAIN, _MAYBE = "drop", "head", "named-drop", "named-head", "main", "maybe"


def _kind(tag: str, rest: str) -> str | None:
    """What a holder's tag and attributes say about its content."""
    found = {a.lower(): unescape(b or c or d or "") for a, b, c, d in _ATTRIBUTE.findall(rest)} if rest.strip() else {}
    style = found.get("style", "").replace(" ", "").lower()
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style:
        return _DROP
    said = _HAS.sub(" ", " ".join(found.get(a, "") for a in ("class", "id", "role", "itemprop")))
    words = set(_WORDS.split(_CAMEL.sub("-", said).lower())) | set(_WORDS.split(said.lower())) if said.strip() else set()
    if tag in MAIN_TAGS or found.get("role", "").lower() == "main":
        return _DROP if words & NOT_ARTICLE_WORDS else _MAIN
    if tag in BOILERPLATE_TAGS:
        return _DROP
    if tag == "body":
        return None
    if words & BOILERPLATE_WORDS:
        return _NAMED_DROP if tag in ("div", "section") else _DROP
    if tag == "header" or words & HEAD_WORDS:
        return _NAMED_HEAD if tag in ("div", "section") else _OUTER_HEAD
    return _MAYBE if words & MAIN_WORDS else None


class Block:
    __slots__ = ("text", "linked", "place", "heading", "named")

    def __init__(self, text: str, linked: int, place: str | None, heading: bool, named: int = 0):
        self.text, self.linked, self.place, self.heading, self.named = text, linked, place, heading, named


def _place(stack: list[tuple[str, str | None]]) -> tuple[str | None, int]:
    """drop, the innermost declaration of main text, or None; and how many named drops articles override."""
    found, named, dropped = None, 0, 0
    for tag, kind in stack:
        if kind == _DROP or kind == _OUTER_HEAD and found != _MAIN:
            return _DROP, 0
        if kind == _NAMED_DROP or kind == _NAMED_HEAD and found != _MAIN:
            dropped += 1
        elif kind == _MAIN:  # a page has one main, but a comment or a teaser may be an article
            named += dropped if tag != "main" else 0
            found, dropped = kind, 0
        elif kind == _MAYBE and found is None:
            found = kind
    return (_DROP, 0) if dropped else (found, named)


def _links(rest: str) -> bool:
    """Whether an a element with these attributes is a link, and not an anchor or self-closed."""
    return not _SELF_CLOSED.search(rest) and any(a[0].lower() == "href" for a in _ATTRIBUTE.findall(rest))


def blocks(page: str) -> list[Block]:
    """The page's non-empty blocks in order, references decoded, white space collapsed."""
    out: list[Block] = []
    stack: list[tuple[str, str | None]] = []
    parts: list[str] = []
    # depth: block elements opened inside of the link; spans: whether the link's end tag follows before another link
    state = {"links": 0, "linked": 0, "heading": False, "depth": 0, "spans": False}

    def text(raw: str) -> None:
        if raw:
            plain = unescape(raw)
            parts.append(plain)
            if state["links"]:
                state["linked"] += len(plain.strip())

    def end_block() -> None:
        joined = " ".join("".join(parts).split())
        if joined:
            place, named = _place(stack)
            out.append(Block(joined, state["linked"], place, state["heading"], named))
        parts.clear()
        state["linked"] = 0

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        closing, rest = bool(m["close"] or m["close2"]), m["rest"] or m["rest2"] or ""
        if tag in SILENT:
            if not closing and not rest.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style", "template", "textarea", "title"):
                    at = len(page)
            continue
        if tag == "a":
            state["links"] = int(not closing and _links(rest))
            if state["links"]:
                following = _ANCHOR.search(page, at)
                state["depth"], state["spans"] = 0, bool(following and following[1])
        elif tag == "br":
            parts.append(" ")
        if tag not in BLOCK_TAGS:
            continue
        end_block()
        # a link ends with its block, but one around whole blocks goes on to its end tag
        if tag != "hr":
            state["depth"] += -1 if closing else 1
        if not state["spans"] or state["depth"] < 0:
            state["links"] = 0
        state["heading"] = not closing and tag[0] == "h" and tag[1:].isdigit()
        if tag not in HOLDERS:
            continue
        if not closing:
            stack.append((tag, _kind(tag, rest)))
        elif any(t == tag for t, _ in stack):
            while stack.pop()[0] != tag:
                pass
    end_block()
    return out


def _first_pass(b: Block, declared: str | None) -> str:
    """good, bad or short, by the block alone."""
    if b.place == _DROP or declared and b.place != declared:
        return "bad"
    density = b.linked / len(b.text)
    if density > (LINKS_MOST_MAIN if declared else LINKS_MOST):
        return "bad"
    if len(b.text) < SHORT:
        return "short"
    if declared:
        return "good"
    if b.text[0] == "©":
        return "bad"
    words = _WORD.findall(b.text.lower())
    stop = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if stop >= STOP_HIGH or stop >= STOP_LOW and len(b.text) > LONG:
        return "good"
    return "short" if stop >= STOP_LOW else "bad"


def _second_pass(found: list[Block], label: list[str], declared: str | None) -> list[bool]:
    """Undecided blocks take the label of the nearest decided ones on both sides.

    Inside declared main text, neighbours that stand outside don't count.
    """
    inside = [not declared or b.place == declared for b in found]

    keep: list[bool] = []
    before: list[str | None] = []
    last = None
    for i, b in enumerate(found):
        before.append(last)
        if inside[i] and label[i] != "short" and b.place != _DROP:
            last = label[i]
    after: list[str | None] = [None] * len(found)
    last = None
    for i in reversed(range(len(found))):
        after[i] = last
        if inside[i] and label[i] != "short" and found[i].place != _DROP:
            last = label[i]
    for i, b in enumerate(found):
        if label[i] != "short":
            keep.append(label[i] == "good")
            continue
        sides = {before[i], after[i]} - {None}
        if not sides:
            keep.append(bool(declared))
        elif len(sides) == 1:
            keep.append(sides == {"good"})
        else:  # between text and boilerplate: a heading belongs to what follows
            keep.append(bool(declared) or b.heading and after[i] == "good")
    return keep


def _text(found: list[Block], named: int) -> str:
    """The article, without what stands inside of more than ``named`` overridden drops."""
    found = [b if b.named <= named else Block(b.text, b.linked, _DROP, b.heading) for b in found]
    declared = next((kind for kind in (_MAIN, _MAYBE) if any(b.place == kind for b in found)), None)
    label = [_first_pass(b, declared) for b in found]
    keep = _second_pass(found, label, declared)
    return "\n\n".join(b.text for b, good in zip(found, keep) if good)


def main_text(page: str) -> str:
    """The page's article, its blocks joined by two line feeds; empty if there is none.

    Articles inside of divs or sections named as boilerplate count if no other part of the
    page is declared main or article, and they give more text than the rest does.
    """
    found = blocks(page)
    best = _text(found, 0)
    least = min((b.named for b in found if b.place == _MAIN), default=0)
    return max(best, _text(found, least), key=len) if least else best


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text).

    The whole html is read; a null one is empty.  Null ids and urls stay null,
    repeated rows each return, other columns are ignored.  Blocks are joined in page
    order by two line feeds; nothing of a block is cut.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(h) if h else "" for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
