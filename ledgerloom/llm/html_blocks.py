"""A page as text blocks and structural tokens, each with its place in the page.

A small reader of markup for broken pages: raw elements, comments, unclosed and
stray tags, and pages cut off anywhere never lose the text around them.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

from xxhash import xxh64_intdigest

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Kinds of elements, and names that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby s"
    " samp small span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset(
    "html body main article section div nav header footer aside form ul ol dl table center"
    " details dialog menu fieldset figure".split()
)
ENDED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
LEFT_OUT = frozenset(
    "nav header footer aside form button select option input menu dialog head object canvas"
    " fieldset legend label".split()
)
LEFT_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu"
    " menubar toolbar note status".split()
)
LEFT_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored"
    " sponsors promo promos promotion nav navbar navigation menu menus breadcrumb breadcrumbs"
    " header masthead topbar footer sidebar sidebars aside widget widgets related recommended"
    " share sharing social comment comments respond reply replies disqus discussion cookie"
    " cookies consent gdpr notice notices notification alert popup modal overlay newsletter"
    " subscribe subscription signup login register form search pagination pager copyright legal"
    " disclaimer toolbar skip".split()
)
ABOUT_OTHERS = frozenset("has no with without".split())
# what a name says of the element's form or place, behind what it says of its content
FORM_NAMES = frozenset(
    "area articles bar block body bottom box boxes button buttons cards container content entries form group icon"
    " inner input item items left link links list main message outer panel posts right row section"
    " slot stories text thread top unit wrap wrapper".split()
)
ARTICLE = ("article", "main")


@dataclass
class Block:
    """Text between two block boundaries, in the container at ``path`` (a hash), and in
    the page's ``article``-th marked article (0: in none)."""

    path: int
    text: str
    left_out: bool
    article: int


@dataclass
class Page:
    """``tags`` are the paths of all tags: hashes of the names from the root on, so
    that a tag takes the same space however deep it lies.  ``parents`` are those of
    the containers around them, 0 around all."""

    blocks: list[Block] = field(default_factory=list)
    tags: list[int] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)


@dataclass(slots=True)
class _Open:
    name: str
    container: bool
    left_out: bool
    article: int
    path: int


def below(path: int, label: str) -> int:
    """The path of ``label`` in the container at ``path``."""
    return xxh64_intdigest(label.encode(), path)


def says_left_out(name: str) -> bool:
    """Does a class, id say that the element is not of the article?

    Its last word does, less those of form: an ``ad-box`` is an ad, a
    ``form-factor`` no form; "has-sidebar" speaks of what stands elsewhere.
    """
    words = [n.lower() for n in NAME.findall(name)]
    if ABOUT_OTHERS.intersection(words):
        return False
    while len(words) > 1 and words[-1] in FORM_NAMES:
        words.pop()
    return bool(words) and words[-1] in LEFT_OUT_NAMES


def is_left_out(name: str, attributes: str, in_article: bool) -> bool:
    """In an article only containers are judged by their class: its paragraphs,
    headings and words may have any."""
    if name in LEFT_OUT:
        return True
    if not attributes or name in ("html", "body", "main", "article"):
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        if key.lower() == "role":
            if value.lower() in LEFT_OUT_ROLES:
                return True
        elif (name in CONTAINERS or not in_article) and any(map(says_left_out, value.split())):
            return True
    return False


def label_of(name: str, attributes: str) -> str:
    """The element's name with its class or id, without numbers."""
    for key, value in ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id"):
            return name + "." + re.sub(r"[\d/]+", "", value.strip("\"'")).strip()
    return name


def read(html: str) -> Page:
    """Blocks and tags in page order."""
    page, stack = Page(), [_Open("", True, False, 0, 0)]
    open_names: Counter[str] = Counter()
    pieces: list[str] = []
    articles = 0

    def flush():
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                top = stack[-1]
                page.blocks.append(Block(top.path, text, top.left_out, top.article))
            pieces.clear()

    def close_to(place: int):
        open_names.subtract(o.name for o in stack[place:])
        del stack[place:]

    at = 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            pieces.append(html[at : m.start()])
        at = m.end()
        if m[1]:
            if m[1].lower() not in ("svg", "iframe"):
                flush()
            continue
        name = (m[3] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            flush()
        if m[2]:
            if not open_names[name]:
                continue
            for place in range(len(stack) - 1, 0, -1):
                if stack[place].name == name:
                    if stack[place].left_out != stack[-1].left_out:
                        flush()
                    close_to(place)
                    break
                if stack[place].container and name not in CONTAINERS:
                    break
            continue
        attributes = m[4] or ""
        ended = ENDED_BY.get(name, frozenset())
        if name not in INLINE and (open_names["p"] or any(open_names[n] for n in ended)):
            for place in range(len(stack) - 1, 0, -1):
                if stack[place].container:
                    break
                if stack[place].name == "p" or stack[place].name in ended:
                    close_to(place)
                    break
        if name in VOID or attributes.endswith("/"):
            continue
        top = stack[-1]
        left_out = top.left_out or is_left_out(name, attributes, top.article > 0)
        if left_out and not top.left_out:
            flush()
        container = name in CONTAINERS
        path = below(top.path, label_of(name, attributes)) if container else top.path
        page.tags.append(path if container else below(path, name))
        page.parents.append(top.path)
        article = top.article
        if not article and name in ARTICLE:
            articles += 1
            article = articles  # of nested ones, the outermost
        stack.append(_Open(name, container, left_out, article, path))
        open_names[name] += 1
    if at < len(html):
        pieces.append(html[at:])
    flush()
    return page
