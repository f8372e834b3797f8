"""Blocks of text of an HTML page, with what the markup says about each."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|/[^A-Za-z][^>]*(?:>|\Z)"
    r"""|(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)(?:>|\Z))""",
    re.S,
)
NAMED = re.compile(r"""(?<![\w-])(class|id|role|hidden|style)(?![\w-])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: their content is no markup: it ends at their own end tag only
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
#: never part of an article
CHROME = frozenset("nav footer aside form template button select option menu dialog object svg canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th caption figcaption address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: an end tag of another element closes none of these
BARRIER = frozenset("html body main article section nav header footer aside form table td th".split())
#: a start tag of the key closes an open element of the values
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",)}
#: words of class, id and role that name menus, headers, footers, sidebars, notices, adverts, forms and comments
NAMES = re.compile(
    r"(?<![a-z])(?<!has-)(?<!with-)(?<!no-)(?:ads?|advert\w*|alert|banner|breadcrumbs?|complementary|consent|contentinfo|cookies?|"
    r"copyright|dialog|disclaimer|footer|gdpr|login|menu|modal|nav|navbar|navigation|newsletter|notice|overlay|pager|pagination|popup|"
    r"promo\w*|recommended|related|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|subscription|teaser|toast|toolbar|"
    r"topbar|widget|comments?|commentlist|respond|replies)(?![a-z])"
)
HEADER_NAMES = re.compile(r"(?<![a-z])(?:header|masthead)(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none")

#: chrome whatever it holds; an article or main part inside other chrome shows that its name or form is of the whole page
CLOSED = CHROME - {"form"}
#: where a block stands; WRAPPED: in an article within an element that is chrome by its name
OUTSIDE, WRAPPED, MAIN, ARTICLE = range(4)


class Block(NamedTuple):
    """tag: the innermost element; place: OUTSIDE, WRAPPED, MAIN or ARTICLE; chrome: marked as no article text."""

    tag: str
    place: int
    chrome: bool
    text: str


def _marks(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """(no article text, a header, the main part) by the element's attributes."""
    names = {}
    for m in NAMED.finditer(attributes):
        names.setdefault(m[1].lower(), (m[2] or "").strip("\"'").lower())
    if "hidden" in names or HIDDEN.search(names.get("style", "")):
        return True, False, False
    if names.get("role") == "main":
        return False, False, True
    if tag in ("html", "body", "main"):
        return False, False, False
    own = " ".join(names.get(k, "") for k in ("class", "id", "role"))
    return bool(NAMES.search(own)), bool(HEADER_NAMES.search(own)), False


def page_blocks(page: str) -> list[Block]:
    """The page's blocks in order, character references decoded, white space as one space; empty ones left out.

    An article within an article is a reader's comment.  Of a header inside the
    main part only the headings belong to the article.  An article inside chrome
    by name (a list of teasers, or a page whose wrapper has such a name) counts
    only where a page has no other.  Unclosed and stray tags
    are tolerated, a comment or tag without an end goes up to the end of the page.
    """
    out: list[Block] = []
    text: list[str] = []
    stack: list[tuple[str, int, bool, bool]] = []  # tag, place, chrome, header
    open_: dict[str, int] = {}
    place, chrome, header = OUTSIDE, False, False

    def close(upto: int) -> None:
        while len(stack) > upto:
            open_[stack.pop()[0]] -= 1

    def flush() -> None:
        shown = " ".join("".join(text).split())
        if shown:
            tag = next((s[0] for s in reversed(stack) if s[0] not in INLINE), "body")
            inside = any(s[0] in HEADINGS for s in stack) if header else True
            out.append(Block(tag, place, chrome or (header and not (inside and place != OUTSIDE)), shown))
        text.clear()

    pos, size = 0, len(page)
    while pos < size:
        m = TAG.search(page, pos)
        piece = page[pos:m.start() if m else size]
        if piece:
            text.append(html.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        pos = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag not in INLINE:
            flush()
        if m[1]:
            if open_.get(tag):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        if tag in INLINE and stack[k][2] != (stack[k - 1][2] if k else False):
                            flush()
                        close(k)
                        break
                    if stack[k][0] in BARRIER and tag not in BARRIER:
                        break
        elif tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, pos)
            pos = end.end() if end else size
            continue
        elif tag in VOID:
            if tag in ("br", "hr"):
                text.append(" ")
            continue
        else:
            if tag not in INLINE:
                for other in ("p", *ENDS.get(tag, ())):
                    if open_.get(other):
                        for k in range(len(stack) - 1, -1, -1):
                            if stack[k][0] == other:
                                close(k)
                                break
                            if stack[k][0] in BARRIER or stack[k][0] in ("ul", "ol", "dl", "div"):
                                break
            up = stack[-1] if stack else ("", OUTSIDE, False, False)
            named, head, is_main = _marks(tag, m[3]) if m[3] else (False, False, False)
            now_place, now_chrome, now_header = up[1], up[2] or named or tag in CHROME, up[3] or head or tag == "header"
            if tag == "article":
                nested = now_place in (ARTICLE, WRAPPED)
                wrapped = up[2] and not any(map(open_.get, CLOSED))
                now_chrome = nested or named or (up[2] and not wrapped)
                now_place = max(now_place, WRAPPED if wrapped else ARTICLE)
            elif tag == "main" or is_main:
                now_chrome = up[2] and any(map(open_.get, CLOSED))
                now_place = max(now_place, MAIN)
            if tag in INLINE and now_chrome != up[2]:
                flush()
            stack.append((tag, now_place, now_chrome, now_header))
            open_[tag] = open_.get(tag, 0) + 1
        _, place, chrome, header = stack[-1] if stack else ("", OUTSIDE, False, False)
    flush()
    return out
