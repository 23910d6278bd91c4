"""Main text of web pages by two passes over their blocks.

The page is cut into blocks at block-level tags. Element and class names are
evidence for single pieces of text: what stands in menus, headers, footers,
forms, adverts, notices and comments leaves its block, inline or not. A name is
no evidence where it can't be meant: on a wrapper that holds the heading or
article and most of the page's text, or on an inline element never closed. The
first pass judges each block by link density, length and stop-word density,
where the page's language has known stop words. It leaves short and in-between
blocks undecided. In the second pass they take the label of the nearest decided
neighbours. An article or main element counts if it holds most of what the
first pass likes; then what lies outside it is out.

Pages are handled one at a time in their own task; nothing is shuffled.

Defined cases: null and empty pages have an empty text. Cut-off pages are read
as far as they go; a cut-off tag, script or comment is no text. Repeated rows
are treated alike. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.quality_rules import STOP_WORDS

_STOP = frozenset(w for ws in STOP_WORDS.values() for w in ws)

# Element names by their part in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noscript ol option p pre section "
                  "summary table tbody td template tfoot th thead title tr ul".split())
IN_HEAD = frozenset("base head html link meta noscript script style template title".split())
BOILER = frozenset("aside button dialog fieldset footer form head header iframe label legend map menu nav noscript object "
                   "option select svg math template textarea title canvas audio video".split())
BOILER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split())
# Words of class and id names that mark boilerplate.
BOILER_WORDS = frozenset("ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs byline comment comments consent cookie "
                         "cookies copyright disclaimer disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
                         "pager pagination popup promo promoted promotion recommended related replies reply respond share sharing shoutbox sidebar "
                         "signup skip social sponsor sponsored subscribe toolbar widget widgets".split())

SHORT = 70  # characters; shorter blocks are undecided
LONG = 200
LINKS = 0.5
MENU = 3  # mostly linked blocks in a row
WRAPPER = 0.5  # share of the page's text
STOP_LOW, STOP_HIGH = 0.1, 0.2

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z""", re.S)
_RAW = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in ("script", "style")}
_ATTR = re.compile(r"""([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")
_FAR = re.compile("[^\x00-\u024f]")


# Words after a boilerplate word in the name of its box, and words
# that turn a name into a remark about something else.
BOX_WORDS = frozenset("area bar block body bottom box button buttons card cards col container content form group holder icons inner item items left "
                      "link links list menu module outer panel posts right row section slot stories text top unit widget wrap wrapper".split())
REMARKS = frozenset("for has have is no of with without".split())
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond shoutbox".split())


@dataclass(eq=False)
class Zone:
    """An open or closed element that looks like boilerplate."""

    parent: Zone | None
    named: bool = False  # by its class or id, or a form
    inline: bool = False
    comment: bool = False
    closed: bool = False
    core: bool = False  # holds an article, main or h1 element, or a form's paragraph
    chars: int = 0
    out: bool = True  # boilerplate, by itself or by an outer zone


@dataclass
class Block:
    text: str
    linked: int  # characters within links
    boiler: bool
    main: bool
    label: str = ""


def _marks(name: str) -> frozenset[str]:
    """The boilerplate words that a class or id names its element by: the
    whole name, its last part, or a first part that a box's word follows."""
    parts = [x.lower() for x in _NAME.findall(name)]
    if not parts or REMARKS & set(parts):
        return frozenset()
    some = {parts[-1]} | ({parts[0]} if len(parts) == 1 or parts[1] in BOX_WORDS | BOILER_WORDS else set())
    return BOILER_WORDS & some


def _zone(tag: str, attrs: str, in_main: bool) -> tuple[str, bool, bool]:
    """("boiler", "main" or ""; whether by name; whether of comments)."""
    values = {}
    if attrs.strip():
        values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    role = values.get("role", "").lower()
    if tag in ("form", "fieldset") or role == "form":
        return "boiler", True, False
    if role in BOILER_ROLES or tag in BOILER and not (tag == "header" and in_main):
        return "boiler", False, False
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", values.get("style", "")):
        return "boiler", False, False
    if tag not in ("html", "body", "main") and not (in_main and tag == "header"):
        marks = frozenset().union(*map(_marks, f"{values.get('class', '')} {values.get('id', '')}".split()))
        if marks:
            return "boiler", True, bool(marks & COMMENT_WORDS)
    return "main" if tag in ("article", "main") or role in ("main", "article") else "", False, False


def blocks(html: str) -> list[Block]:
    """The page's blocks with a character that is no white space."""
    found: list[tuple[list[tuple[str, bool, Zone | None]], bool]] = []  # pieces of each block, and whether in the main element
    zones: list[Zone] = []
    stack: list[tuple[str, str]] = []  # open elements and their zones
    parts: list[tuple[str, bool, Zone | None]] = []
    zone_of: list[Zone | None] = [None]  # the innermost zone of every open element
    main = links = total = 0  # open main elements and links; characters of the page

    def flush() -> None:
        nonlocal parts
        if parts:
            found.append((parts, main > 0))
            parts = []

    def say(raw: str) -> None:
        nonlocal total
        if raw:
            text, zone = unescape(raw), zone_of[-1]
            parts.append((text, links > 0, zone))
            n = len(text.strip())
            if zone is not None:
                zone.chars += n
            total += n

    def pop(n: int, own: bool = False) -> None:
        nonlocal main, links
        while len(stack) > n:
            tag, kind = stack.pop()
            zone = zone_of.pop()
            if kind == "boiler" and own and len(stack) == n:
                zone.closed = True
            main -= kind == "main"
            links -= tag == "a"

    def closes(tags: tuple[str, ...], within: frozenset) -> None:
        """Ends the innermost open element of tags, if none of within is nearer."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                pop(i)
                return
            if stack[i][0] in within:
                return

    at = 0
    while at < len(html):
        m = _TAG.search(html, at)
        if not m:
            say(html[at:])
            break
        say(html[at:m.start()])
        at = m.end()
        end, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush()
        elif tag == "br":
            parts.append((" ", False, None))
        if end:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop(i, True)
                    break
            continue
        if tag in _RAW:
            stop = _RAW[tag].search(html, at)
            at = stop.end() if stop else len(html)
            continue
        if tag not in IN_HEAD:
            closes(("head",), frozenset())
        if tag in BLOCK:
            closes(("p",), BLOCK - {"p"})
        if tag in ("li", "option", "dt", "dd", "tr", "td", "th"):
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
            closes(same, frozenset("ul ol menu dl table tbody thead tfoot select".split()) | ({"tr"} if tag in ("td", "th") else frozenset()))
        if tag == "a":
            closes(("a",), BLOCK)
        if tag in VOID or attrs.endswith("/") and tag in ("svg", "path"):
            continue
        kind, named, comment = _zone(tag, attrs, main > 0)
        outer = zone_of[-1]
        if outer is not None and (kind == "main" or tag in ("h1", "p")):
            outer.core = True
        if kind == "boiler":
            outer = Zone(outer, named, tag not in BLOCK, comment)
            zones.append(outer)
        stack.append((tag, kind))
        zone_of.append(outer)
        main += kind == "main"
        links += tag == "a"
    flush()
    for z in reversed(zones):  # inner zones come after outer ones
        if z.parent is not None:
            z.parent.chars += z.chars
            z.parent.core |= z.core
    for z in zones:
        wrapper = z.named and not z.comment and z.core and z.chars > WRAPPER * total
        lost = z.named and z.inline and not z.closed
        z.out = not wrapper and not lost or z.parent is not None and z.parent.out
    out = []
    for pieces, in_main in found:
        for boiler in (False, True):
            own = [(t, linked) for t, linked, z in pieces if (z is not None and z.out) == boiler]
            text = _SPACE.sub(" ", "".join(t for t, _ in own)).strip()
            if text:
                out.append(Block(text, sum(len(t.strip()) for t, linked in own if linked), boiler, in_main))
                break  # what is left of a block with boilerplate in it stands for the block
    return out


def _latin(text: str) -> bool:
    """Whether at most half of the letters lie beyond the Latin blocks."""
    far = 0 if text.isascii() else sum(c > "\u024f" and c.isalpha() for c in _FAR.findall(text))
    return not far or 2 * far <= sum(map(str.isalpha, text))


def _density(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in _STOP for w in words) / max(1, len(words))


def _first_pass(found: list[Block]) -> None:
    """Labels good, near, short and bad, each block by itself."""
    plain = [b for b in found if not b.boiler and b.linked <= LINKS * len(b.text)]
    long = [b for b in plain if len(b.text) >= LONG and _latin(b.text)]
    known = not long or _density(" ".join(b.text for b in long)) >= STOP_LOW  # stop words of the page's language are listed
    for b in found:
        n = len(b.text)
        if b.boiler:
            b.label = "bad"
        elif b.linked > LINKS * n:
            b.label = "linked"
        elif n < SHORT:
            b.label = "short"
        elif known and _latin(b.text):
            density = _density(b.text)
            b.label = "bad" if density < STOP_LOW else "good" if density >= STOP_HIGH and n >= LONG else "near"
        else:
            b.label = "good" if n >= LONG else "near"


def _choose_main(found: list[Block]) -> bool:
    """Whether the main elements hold most of the text that may be good; if
    so, blocks outside are bad, and only boilerplate and menus are bad inside."""
    weight = {True: 0, False: 0}
    for b in found:
        weight[b.main] += len(b.text) if b.label in ("good", "near") else 0
    inside = any(b.main and not b.boiler for b in found)
    chosen = inside and weight[True] >= weight[False]
    for i, b in enumerate(found):
        if chosen and not b.main:
            b.label = "bad"
        elif chosen and not b.boiler and b.label != "linked":
            b.label = "good" if b.label in ("good", "near") else "short"
    for i, b in enumerate(found):
        if b.label == "linked":  # one linked block may be a sentence of the text; a row of them is a menu
            row = 1
            for step in (-1, 1):
                j = i + step
                while 0 <= j < len(found) and found[j].label in ("linked", "menu") and row < MENU:
                    row, j = row + 1, j + step
            b.label = "menu" if row >= MENU or not chosen else "linked"
    for b in found:
        b.label = {"menu": "bad", "linked": "short"}.get(b.label, b.label)
    return chosen


def _second_pass(found: list[Block], has_main: bool) -> None:
    """Undecided blocks take the label of the nearest decided neighbours. What
    lies outside the main element is no neighbour of what lies in it."""
    near = [b for b in found if not has_main or b.main and not b.boiler]
    if not any(b.label == "good" for b in near):
        for b in near:  # nothing stands out: a page of short blocks only
            if b.label in ("short", "near"):
                b.label = "good"
        return
    decided = [b.label if b.label in ("good", "bad") else "" for b in near]
    before: list[tuple[str, int]] = []
    last = ("bad" if not has_main else "", -1)
    for i, x in enumerate(decided):
        before.append(last)
        last = (x, i) if x else last
    last = ("bad" if not has_main else "", len(near))
    for i in range(len(near) - 1, -1, -1):
        b = near[i]
        if b.label in ("short", "near"):
            (p, pi), (q, qi) = before[i], last
            if p == q or not q:
                b.label = p
            elif not p:
                b.label = q
            elif b.label == "near" or has_main:
                b.label = "good"
            else:
                b.label = p if i - pi < qi - i else q
        last = (decided[i], i) if decided[i] else last


def extract(html: str | None) -> str:
    """The main text: its blocks joined by an empty line."""
    found = blocks(html or "")
    _first_pass(found)
    _second_pass(found, _choose_main(found))
    return "\n\n".join(b.text for b in found if b.label == "good")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text and n_chars (its code points)."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            text = [extract(h) for h in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": text, "n_chars": [len(t) for t in text]})

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
