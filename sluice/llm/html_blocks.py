"""Blocks of text of one HTML page, each with its place: in the article, outside it, or boilerplate."""

from __future__ import annotations

import re
from html import unescape

#: Fixed values of HTML: element names by role.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody tfoot thead title tr ul".split()
)
RAW = "script|style|noscript|template|textarea|iframe|xmp|noembed|noframes"
#: Elements that never hold main text.
BOILERPLATE = set("nav footer aside form head title menu dialog search button select option svg canvas object audio video map".split())
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Words that class names and ids of boilerplate begin with.
HINTS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside "
    "footer masthead topbar cookie cookies consent gdpr popup modal overlay "
    "comment comments commentlist disqus respond replies "
    "newsletter subscribe subscription signup login search skip".split()
)
#: Words that boilerplate and main text both have: what the host's pages repeat decides.
VAGUE = set(
    "alert banner copyright form legal notice notices promo promotion recommended related share sharing social widget widgets".split()
)
#: Words for a part of a page's layout: after a word from above they say nothing of a subject.
LAYOUT = set(
    "area articles author bar block body bottom box btn button buttons card col column container content cta date email "
    "group header holder icon icons inner input item items label left link links list main media meta mobile module next "
    "page panel post posts prev previous primary reply right row secondary section site slot stories text this thread "
    "title toggle top unit wrap wrapper zone".split()
)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[a-z0-9]+")

#: HEAD is no part of the page: its title often repeats the heading of the text.
ARTICLE, MAIN, OUTSIDE, DROPPED, HEAD = "article", "main", "outside", "dropped", "head"
#: Places of text under a vague class name, and under one that may name a subject, by what it stands in.
SUSPECT = {place: f"suspect in {place}" for place in (ARTICLE, MAIN, OUTSIDE)}
UNUSUAL = {place: f"unusual in {place}" for place in (ARTICLE, MAIN, OUTSIDE)}
_IN_ARTICLE = (ARTICLE, SUSPECT[ARTICLE], UNUSUAL[ARTICLE])


def _named(name: str) -> int:
    """What one class name or id says, as ``_verdict``.

    ``search-box`` and ``comment-12`` are boilerplate, as all of their parts are words of layout;
    ``search-theory`` and ``form-factor`` begin like boilerplate and may name the subject of a text.
    """
    parts = _PART.findall(name)
    if not parts or parts[0] not in HINTS and parts[0] not in VAGUE:
        return 0
    if any(p not in HINTS and p not in VAGUE and p not in LAYOUT and not p[0].isdigit() for p in parts):
        return 1
    return 3 if parts[0] in HINTS else 2


def _verdict(tag: str, attributes: str, in_article: bool) -> int:
    """3: boilerplate; 2: a vague name; 1: a name that may be a subject; 0: nothing speaks against the element."""
    if tag in BOILERPLATE or tag == "header" and not in_article:
        return 3
    if not attributes or attributes.isspace() or tag in ("html", "body", "article", "main") and "comment" not in attributes.lower():
        return 0
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true":
        return 3
    if found.get("role", "").lower() in ROLES:
        return 3
    if re.search(r"display\s*:\s*none", found.get("style", "")):
        return 3
    names = (found.get("class", "") + " " + found.get("id", "")).lower().split()
    return max(map(_named, names), default=0)


def blocks(html: str | None) -> list[tuple[str, str, float]]:
    """``(place, text, share of it inside links)`` of every non-empty block in page order."""
    out: list[tuple[str, str, float]] = []
    stack: list[tuple[str, str]] = []  # open elements and the place of their text
    place = OUTSIDE
    held: list[str] = []
    linked = links = 0

    def flush():
        nonlocal linked
        text = " ".join("".join(held).split())
        if text and place != HEAD:
            out.append((place, text, linked / len(text)))
        held.clear()
        linked = 0

    def add(raw: str):
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            held.append(text)
            if links:
                linked += len(text.strip())

    html = html or ""
    at = 0
    for m in _TOKEN.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if m[1] is None and m[0].startswith("<!--"):
                continue  # a comment joins what is around it
            if m[1] and m[1].lower() in ("textarea", "iframe"):
                held.append(" ")
            continue
        tag = tag.lower()
        if tag in ("br", "td", "th", "img"):
            held.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            flush()
        if m[2]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is not None:
                links -= sum(t == "a" for t, _ in stack[depth:])
                if stack[depth][1] != place:
                    flush()
                del stack[depth:]
                place = stack[-1][1] if stack else OUTSIDE
            continue
        if tag == "body":
            stack, place, links = [], OUTSIDE, 0
        elif tag in BLOCK:  # an open paragraph ends where a block begins
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in BLOCK), None)
            if depth is not None and (stack[depth][0] == "p" or stack[depth][0] == tag == "li"):
                links -= sum(t == "a" for t, _ in stack[depth:])
                del stack[depth:]
                place = stack[-1][1] if stack else OUTSIDE
        inner = place
        if tag in ("head", "title"):
            inner = HEAD
        elif place not in (DROPPED, HEAD):
            verdict = _verdict(tag, m[4], place in _IN_ARTICLE)
            if verdict == 3:
                inner = DROPPED
            elif place in UNUSUAL.values() and verdict == 2:
                inner = SUSPECT[next(p for p in UNUSUAL if UNUSUAL[p] == place)]
            elif place not in SUSPECT:  # what stands in such an element is like it
                pass
            elif verdict:
                inner = (UNUSUAL if verdict == 1 else SUSPECT)[place]
            elif tag == "article":
                inner = ARTICLE
            elif place != ARTICLE and (tag == "main" or re.search(r"\brole\s*=\s*[\"']?main\b", m[4])):
                inner = MAIN
        if inner != place:
            flush()
        links += tag == "a"
        stack.append((tag, inner))
        place = inner
    add(html[at:])
    flush()
    return out


SURE, OPEN, DOUBTFUL = 0, 1, 2


def divide(html: str | None) -> tuple[list[str], list[int], list[str], list[int]]:
    """``(texts, states, words, owner)`` of one page.

    ``texts`` are the blocks that may be main text, in page order, and ``states`` what is known of each:
    SURE (in the element that marks main text), OPEN (the page marks none and nothing speaks against
    the block, or it is under a name that begins like boilerplate and may name a subject) or DOUBTFUL
    (under a vague class name). ``words`` are all words outside sure blocks, and ``owner`` the number in
    ``texts`` of each word's block, -1 for boilerplate. A null or empty page has none of all.
    """
    found = blocks(html)
    mark = next((p for p in (ARTICLE, MAIN) if any(place in (p, UNUSUAL[p]) for place, _, _ in found)), None)
    within = mark or OUTSIDE
    states_of = {within: SURE if mark else OPEN, SUSPECT[within]: DOUBTFUL, UNUSUAL[within]: OPEN}
    texts: list[str] = []
    states: list[int] = []
    words: list[str] = []
    owner: list[int] = []
    for place, text, linked in found:
        state = states_of.get(place)
        if state == OPEN and linked >= 0.8:
            state = None
        if state is not None:
            texts.append(text)
            states.append(state)
        if state != SURE:
            own = text.split(" ")
            words += own
            owner += [-1 if state is None else len(texts) - 1] * len(own)
    return texts, states, words, owner
