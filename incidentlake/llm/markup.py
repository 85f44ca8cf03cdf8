"""Reading HTML: tags, text blocks and what their surroundings say about them."""

from __future__ import annotations

import html
import re

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|svg|math|select)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-z][a-z0-9:-]*)([^>]*)>"
    r"|<[!?][^>]*(?:>|\Z)|</?[a-z][^>]*\Z", re.S | re.I)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table"
    " tbody tfoot thead title tr ul".split())
SPACES = frozenset("br td th".split())
#: Elements and names (parts of class, id and role) that hold no main text.
ASIDE_TAGS = frozenset("aside button dialog footer form head menu nav title".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent"
    " contentinfo cookie cookies copyright disqus footer form gdpr header login masthead menu modal nav navbar navigation"
    " newsletter notice notices pagination popup promo promoted related replies reply search share sharing sidebar signup"
    " social sponsor sponsored subscribe subscription toolbar widget widgets".split())
MAIN_NAMES = frozenset("article content entry main post story".split())


def _aside(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in ASIDE_TAGS or tag == "header" and not in_main:
        return True
    if not attributes:
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id", "role"):
            for one in value.split():
                parts = set(re.split(r"[^a-z]+", one))
                if parts & ASIDE_NAMES and not parts & MAIN_NAMES:
                    return True
        elif name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return bool(re.search(r"(?:^|\s)hidden(?:\s|/|=|$)", _ATTRIBUTE.sub(" ", attributes)))


def blocks(page: str | None) -> tuple[list[tuple[str, str, bool, bool]], bool]:
    """(tag, text, in main, aside) of every text block in page order, and whether the page marks its main text.

    Character references are decoded, white space is one space, blank blocks are left out. Unclosed elements
    end with their parent; a paragraph ends where the next block begins.
    """
    found: list[tuple[str, str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, in main, aside
    now: list[str] = []
    has_main = False
    if not page:
        return found, has_main

    def flush() -> None:
        if now:
            if text := " ".join(html.unescape("".join(now)).split()):
                tag, in_main, aside = next((s for s in reversed(stack) if s[0] in BLOCKS), ("body", False, False))
                found.append((tag, text, in_main, aside))
            now.clear()

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            now.append(page[at:m.start()])
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            if m[1]:
                now.append(" ")
            continue
        closing, attributes = m[2] or m[5], m[4] or m[7] or ""
        if tag in SPACES:
            now.append(" ")
        if tag in BLOCKS:
            flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or stack[k][0] == tag == "li":
                    del stack[k:]
                    break
                if stack[k][0] in BLOCKS:
                    break
        _, in_main, aside = stack[-1] if stack else ("", False, False)
        opens = tag in ("article", "main") or 'role="main"' in attributes or "articleBody" in attributes
        aside = aside or _aside(tag, attributes, in_main or opens)
        if opens and not aside:
            in_main = has_main = True
        stack.append((tag, in_main, aside))
    now.append(page[at:])
    flush()
    return found, has_main


def plain_text(page: str | None) -> str:
    """All visible text, one line for each block; titles included."""
    return "\n".join(text for _, text, _, _ in blocks(page)[0])


def links(page: str | None) -> list[str]:
    """Targets of links, in page order."""
    found = []
    for m in _TOKEN.finditer(page or ""):
        if (m[3] or m[6] or "").lower() == "a" and not (m[2] or m[5]):
            for name, a, b, c in _ATTRIBUTE.findall(m[4] or m[7] or ""):
                if name.lower() == "href":
                    found.append(html.unescape(a or b or c))
    return found
