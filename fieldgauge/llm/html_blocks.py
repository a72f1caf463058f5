"""Visible text blocks of an HTML page, with where they stand."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

# Element names of HTML.
_RAW = "script|style|noscript|template|svg|math|iframe|object|textarea|select|title|canvas|audio|video"
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("nav footer aside form menu dialog button fieldset".split())
_CONTENT = frozenset(["article", "main"])
_MARKS = frozenset(["class", "id", "role", "hidden", "aria-hidden"])
_FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split()
)
# Words in class and id names that mark page furniture.
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside footer masthead topbar cookie cookies consent gdpr notice "
    "notices disclaimer popup modal overlay subscribe subscription newsletter signup login share sharing social "
    "related recommended recommendations comment comments commentlist disqus replies respond widget widgets form "
    "search skip toolbar pagination pager".split()
)
# Words beside those in the same name; any other word makes the name another thing's.
_PLACE_WORDS = frozenset(
    "site page main top bottom left right global primary secondary header box bar block section list item items link "
    "links container wrapper wrap inner outer area group row col column panel content text title slot unit post posts "
    "article articles story stories user reader the of and for in on to a my js fixed sticky mobile desktop".split()
)

# Every part is possessive and a tag that is never closed goes on to the end of the page, as
# browsers have it, so a page is read once from front to back whatever it holds.
_INSIDE = r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[\"'=])*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?![^\s/>]){_INSIDE}(?:>.*?(?:</\1\s*+>|\Z)|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({_INSIDE})(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    text: str
    content: bool  # inside article or main
    furniture: bool  # inside a menu, header, footer, sidebar, notice, advert, form or comments


def _is_furniture(name: str, attributes: str, in_content: bool) -> bool:
    if name in _FURNITURE or (name == "header" and not in_content):
        return True
    if not attributes:
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key not in _MARKS:
            continue
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "role" and value.lower() in _FURNITURE_ROLES:
            return True
        if key in ("class", "id") and name not in ("html", "body", "main"):
            if any(_names_furniture(word) for word in value.split()):
                return True
    return False


def _names_furniture(word: str) -> bool:
    """Whether a class or id names furniture: with a word for it, and else only words for where it stands."""
    parts = [part.lower() for part in _PARTS.findall(word)]
    return any(p in _FURNITURE_WORDS for p in parts) and all(p in _FURNITURE_WORDS or p in _PLACE_WORDS for p in parts)


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order: character references decoded, white space made one space.

    A block ends where a block-level element starts or ends; br is white space. Scripts,
    styles and comments have no text. Elements left open last to the end of the element
    around them; a tag left open takes the rest of the page. Anything that is not markup is
    text, so no input is refused. Time is in proportion to the page.
    """
    found: list[Block] = []
    pieces: list[str] = []
    open_elements: list[tuple[str, bool, bool]] = []  # name, content, furniture
    names: Counter[str] = Counter()  # of the open elements, so that an end tag of none costs nothing

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            _, content, furniture = open_elements[-1] if open_elements else ("", False, False)
            found.append(Block(text, content, furniture))

    at = 0
    for match in _TOKEN.finditer(page):
        pieces.append(page[at : match.start()])
        at = match.end()
        name = match[3]
        if not name:
            continue
        name = name.lower()
        if name == "br":
            pieces.append(" ")
            continue
        if name in _BLOCKS:
            flush()
        if match[2]:
            while names[name]:
                closed = open_elements.pop()[0]
                names[closed] -= 1
                if closed == name:
                    break
            continue
        if name in _VOID or match[4].endswith("/") or name not in _BLOCKS:
            continue
        if name == "p" and open_elements and open_elements[-1][0] == "p":
            open_elements.pop()
            names["p"] -= 1
        _, content, furniture = open_elements[-1] if open_elements else ("", False, False)
        furniture = furniture or _is_furniture(name, match[4], content)
        open_elements.append((name, content or name in _CONTENT, furniture))
        names[name] += 1
    pieces.append(page[at:])
    flush()
    return found
