"""Web pages as balanced token streams: block elements, and the text between them.

Inline markup is part of the text.  What can't be article text by its element, its role or the
words of its class and id (menus, footers, adverts, forms, comments, ...) is one token without
content.
"""

from __future__ import annotations

import re
from html import unescape

OPEN, CLOSE, TEXT = 0, 1, 2
MAX_DEPTH = 200  # elements below it count as part of their ancestor there; their text stays

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+[^>]*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul head".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript svg math".split())
DROPPED = frozenset(
    "head nav footer aside form button select template dialog menu object video audio canvas label fieldset search "
    "datalist optgroup option map marquee".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist "
    "status note".split()
)
DROPPED_WORDS = frozenset(
    # adverts
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox sponsor sponsors sponsored "
    "promo promos promoted promotion banner banners outbrain taboola "
    # menus
    "nav navbar navigation menu menus menubar breadcrumb breadcrumbs pagination pager topbar toolbar sitemap dropdown "
    # around the article
    "masthead footer footers colophon copyright sidebar sidebars sidenav aside rail widget widgets "
    # notices
    "notice notices cookie cookies consent gdpr alert alerts popup popups modal overlay newsletter subscribe "
    "subscription paywall signup signin login disclaimer toast "
    # readers
    "comment comments commentlist disqus reply replies respond responses discussion feedback guestbook "
    # other pages
    "share sharing sharebar social related recommended recommendations trending teaser teasers "
    # forms and what is not shown
    "form forms search searchbox searchform hidden invisible".split()
)
READER_WORDS = frozenset("comment comments reply replies respond responses disqus discussion teaser related".split())
HEADER_WORDS = frozenset("header headers pageheader siteheader".split())
BODY_NAMES = frozenset(
    "article article-body article-content article-text articlebody post post-body post-content post-text entry entry-content "
    "entry-text story story-body story-content main main-content maincontent main-text content page-content body-text "
    "text-body content-body".split()
)

# An open element of the first column ends when one of the second starts inside the third.
_SCOPES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
_WALLS = frozenset("table td th caption button object template body html".split())


class _Element:
    __slots__ = ("tag", "hidden", "shown", "main", "place")

    def __init__(self, tag: str, hidden: bool, shown: bool, main: bool, place: dict):
        self.tag, self.hidden, self.shown, self.main, self.place = tag, hidden, shown, main, place


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _judged(tag: str, attributes: dict[str, str], in_main: bool) -> tuple[str, int]:
    """('!' for what is left out, else ''; 3, 2, 1 for what says that it is the article)."""
    if tag in DROPPED:
        return "!", 0
    if tag == "header":
        return ("" if in_main else "!"), 0
    rank = 3 if tag == "article" else 2 if tag == "main" else 0
    if not attributes:
        return "", rank
    role = attributes.get("role", "").lower()
    if role in DROPPED_ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return "!", 0
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return "!", 0
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    words = set(_WORD.findall(names))
    if words & (READER_WORDS if rank else DROPPED_WORDS) and tag not in ("body", "html"):
        return "!", 0
    if not in_main and words & HEADER_WORDS and tag not in ("body", "html", "h1", "h2"):
        return "!", 0
    if attributes.get("itemprop", "").lower() == "articlebody":
        return "", 3
    if role == "main":
        return "", max(rank, 2)
    if not rank and BODY_NAMES & set(names.replace("_", "-").split()) and tag not in ("body", "html", "p"):
        return "", 1
    return "", rank


def _label(tag: str, mark: str, rank: int, attributes: dict[str, str]) -> str:
    words = sorted(set(_WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()))) if attributes else []
    return f"{tag}{mark}{'*' * rank}{'.' + '-'.join(words[:4]) if words else ''}"


def tokens(html: str) -> list[tuple]:
    """(OPEN, label), (CLOSE,) and (TEXT, text, characters inside links), balanced.

    A label is the element, ``!`` if its content is left out, one to three ``*`` if it says
    that it is the article, and the words of class and id.  End tags that HTML implies are
    supplied, stray ones ignored.  Texts are single blocks: references decoded, white space
    made one space, never empty.
    """
    out: list[tuple] = []
    stack = [_Element("", False, False, False, {})]
    counts: dict[str, int] = {}
    pieces: list[str] = []
    depth = links = linked = at = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append((TEXT, text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def pop() -> None:
        nonlocal depth, links
        gone = stack.pop()
        counts[gone.tag] -= 1
        if gone.tag == "a":
            links -= 1
        if gone.tag in BLOCKS and not stack[-1].hidden:
            flush()
        if gone.shown:
            out.append((CLOSE,))
            depth -= 1

    def pop_to(place: int) -> None:
        while len(stack) > place:
            pop()

    def close(tag: str) -> None:
        if not counts.get(tag):
            return
        block = tag in BLOCKS
        for k in range(len(stack) - 1, 0, -1):
            open_tag = stack[k].tag
            if open_tag == tag:
                return pop_to(k)
            if (open_tag in BLOCKS and not block) or (open_tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html")):
                return

    def text(chunk: str) -> None:
        nonlocal linked
        if chunk and not stack[-1].hidden:
            chunk = unescape(chunk)
            pieces.append(chunk)
            if links:
                linked += len(chunk.strip())

    size = len(html)
    while at < size:
        found = _TOKEN.search(html, at)
        if found is None:
            text(html[at:])
            break
        text(html[at : found.start()])
        at = found.end()
        if found[1]:
            close(found[1].lower())
            continue
        if not found[2]:
            continue
        tag = found[2].lower()
        if tag in RAW:
            if not found[3].endswith("/") or tag not in ("svg", "math", "iframe"):
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else size
            continue
        if tag == "br":
            if not stack[-1].hidden:
                pieces.append(" ")
            continue
        if tag in VOID:
            if tag == "hr" and not stack[-1].hidden:
                flush()
            continue
        top = stack[-1]
        if tag in BLOCKS:
            if "p" in top.place:
                pop_to(top.place["p"])
            scope = _SCOPES.get(tag)
            if scope:
                place = max((stack[-1].place.get(t, 0) for t in scope[0]), default=0)
                if place:
                    pop_to(place)
            if tag == "body" and counts.get("head"):
                close("head")
        elif tag == "a" and links:
            close("a")
        top = stack[-1]
        attributes = _attributes(found[3]) if found[3].strip(" \t\n/") else {}
        mark, rank = _judged(tag, attributes, top.main)
        if not top.hidden and tag in BLOCKS:
            flush()
        shown = tag in BLOCKS and not top.hidden and depth < MAX_DEPTH
        if shown:
            out.append((OPEN, _label(tag, mark, rank, attributes)))
            depth += 1
        place = top.place
        if tag in ("p", *_SCOPES):
            place = {**place, tag: len(stack)}
        elif tag in _WALLS or tag in ("ul", "ol", "menu", "dir", "dl", "select"):
            walls = {t for inner, outer in _SCOPES.values() if tag in outer for t in inner}
            if tag in _WALLS:
                walls.add("p")
            place = {t: k for t, k in place.items() if t not in walls}
        stack.append(_Element(tag, top.hidden or bool(mark), shown, top.main or rank >= 2, place))
        counts[tag] = counts.get(tag, 0) + 1
        links += tag == "a"
    pop_to(1)
    flush()
    return out
