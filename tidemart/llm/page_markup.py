"""Pages as text blocks and tags in page order, for content extraction.

A scanner over the whole page, whose work grows with its length, gives tags and text; elements are kept in a list
with their parents. Left-out end tags are implied as browsers imply them for paragraphs, list items, cells and options. Inline
elements do not split text; ``br`` is white space. An unclosed comment, script or quoted attribute reaches to
the end of what it may hold, as in browsers; a tag also ends at the next ``<``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Element names.
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object ol optgroup "
    "option p pre script search section select style summary svg table tbody td template textarea tfoot th thead title tr "
    "ul video audio canvas".split()
)
# Blocks that an article is made of, beside those that only hold others.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl li dt dd blockquote pre figure figcaption table hr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that are never part of an article, and those that are not unless an article lies in them.
NEVER = frozenset("head title script style noscript template iframe noembed noframes svg object audio video canvas".split())
APART = frozenset("nav aside footer header form menu dialog search button select textarea fieldset".split())
APART_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
# Words of class and id names that mark what is not an article.
APART_NAMES = frozenset(
    "menu submenu nav navbar navigation topnav topbar subnav breadcrumb breadcrumbs header masthead banner footer copyright colophon "
    "sidebar sidenav widget widgets related recommended recommendations share sharing social ad ads adv advert adverts "
    "advertisement advertising adsbygoogle adslot adbox sponsor sponsored sponsors promo promotion outbrain taboola newsletter "
    "subscribe subscription signup signin login cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay paywall toolbar pager pagination search searchbox form skiplink".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist commentform disqus respond replies discussion reactions".split())
# Names beside "header" that make it an article's own.
OWN_HEADER = frozenset("article entry post story content".split())
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th", "caption"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup"])),
}

# Elements that lie deeper than this are taken as siblings, as browsers do.
DEEPEST = 512

TAG = re.compile(r"<(/?)([A-Za-z][^\s/<>]*)((?:[^<>\"'=]|[\"']|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)>?")
ATTRIBUTE = re.compile(r"(?<![^\s/=\"'<>])([^\s/=\"'<>]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+))")
ODD = re.compile(r"<(?:!--|[!?]|/?[A-Za-z]|/)")
RAW_END = {name: re.compile(rf"</{name}(?![^\s/>])", re.I) for name in RAW}
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def names(value: str) -> list[str]:
    """The words of a class or id, lower-cased, alone and joined; one after "has", "with" or "no" says nothing of the element."""
    found = []
    for token in value.split():
        words = [w.lower() for w in NAME.findall(token)]
        if words and words[0] in ("has", "with", "no", "without"):
            words = words[2:]
        found += words
        if len(words) > 1:
            found.append("".join(words))
    return found


@dataclass
class Page:
    """``parent``, ``tag`` and ``kind`` of each element, and the page's ``items``.

    Kinds are "article", "main", "comment", "never", "apart", "header" and "".

    Items are ``(element, None, 0, 0)`` where an element opens, ``(~element, None, 0, 0)`` where it closes, and
    ``(element, text, words, words in links)`` for text.
    """

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: [""])
    kind: list[str] = field(default_factory=lambda: [""])
    items: list[tuple[int, str | None, int, int]] = field(default_factory=list)

    def cut(self) -> list[int]:
        """For each element the outermost element, itself or around it, that is not part of an article; 0 for none.

        What is "apart" stays if an article or main element lies in it, and so does a form with most of the
        page's paragraphs in it; a header stays within an article.
        """
        count = len(self.tag)
        named = [kind in ("article", "main") for kind in self.kind]
        holds = list(named)
        paragraphs = [0] * count
        for element, _, words, _ in self.items:
            if words and self.tag[element] == "p":
                paragraphs[element] += words
        for k in range(count - 1, 0, -1):
            paragraphs[self.parent[k]] += paragraphs[k]
            if holds[k]:
                holds[self.parent[k]] = True
        found = [0] * count
        inside = [False] * count
        for k in range(1, count):
            up, kind = self.parent[k], self.kind[k]
            inside[k] = inside[up] or named[k]
            if found[up]:
                found[k] = found[up]
            elif kind in ("never", "comment"):
                found[k] = k
            elif kind == "apart" and not holds[k] and not (self.tag[k] == "form" and 2 * paragraphs[k] > paragraphs[0]):
                found[k] = k
            elif kind == "header" and not holds[k] and not inside[k]:
                found[k] = k
        return found


def kind_of(tag: str, attributes: str) -> str:
    """What an element is by its name, role, class and id."""
    if tag in NEVER:
        return "never"
    given: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(attributes) if "=" in attributes else ():
        given.setdefault(name.lower(), unescape("".join(values)))
    said = names(given.get("class", "")) + names(given.get("id", ""))
    if tag in ("html", "body"):
        return ""
    if any(word in COMMENT_NAMES for word in said) and tag != "main":
        return "comment"
    role = given.get("role", "").strip().lower()
    if tag == "article" or role == "article" or "articleBody" in given.get("itemprop", ""):
        return "article"
    if tag == "main" or role == "main":
        return "main"
    if tag == "header":
        return "header"
    if tag in APART or role in APART_ROLES:
        return "apart"
    marks = [word for word in said if word in APART_NAMES]
    if marks and all(word in ("header", "banner", "masthead") for word in marks):
        return "" if tag in HEADINGS or OWN_HEADER & set(said) else "header"
    return "apart" if marks else ""


class Scanner:
    """Reads one page."""

    def __init__(self, html: str):
        self.html, self.page = html, Page()
        self.stack = [0]
        self.open: dict[str, int] = {}
        self.text: list[str] = []
        self.linked = 0
        self.in_link = False
        # An inline element that is no part of an article: its name, how deep it lies, and how often its name is open in it.
        self.muted: tuple[str, int] | None = None
        self.nested = 0

    def read(self) -> Page:
        html, at = self.html, 0
        while at < len(html):
            found = ODD.search(html, at)
            if not found:
                self.add(html[at:])
                break
            self.add(html[at : found.start()])
            at = self.markup(found.start())
        self.flush()
        while len(self.stack) > 1:
            self.pop()
        return self.page

    def markup(self, at: int) -> int:
        """Handle what begins with the ``<`` at ``at``; where to go on."""
        html = self.html
        if html.startswith("<!--", at):
            end = at + 5 if html.startswith("<!-->", at) else html.find("-->", at + 4) + 3
            return end if end > at + 4 else len(html)
        tag = TAG.match(html, at)
        if not tag:
            end = html.find(">", at)
            return end + 1 if end >= 0 else len(html)
        name = tag[2].lower()
        if tag[1]:
            self.end(name)
        else:
            self.start(name, tag[3])
            if name in RAW:
                end = RAW_END[name].search(html, tag.end())
                if name in ("textarea", "title"):
                    self.add(html[tag.end() : end.start() if end else len(html)])
                return end.start() if end else len(html)
        return tag.end()

    def add(self, text: str) -> None:
        if text and not self.muted:
            text = unescape(text) if "&" in text else text
            self.text.append(text)
            if self.in_link:
                self.linked += len(text.split())

    def flush(self) -> None:
        """End the block of text."""
        if self.text:
            words = "".join(self.text).split()
            if words:
                self.page.items.append((self.stack[-1], " ".join(words), len(words), min(self.linked, len(words))))
            self.text.clear()
        self.linked = 0

    def push(self, name: str, kind: str) -> None:
        self.flush()
        if len(self.stack) > DEEPEST:
            self.pop()
        page = self.page
        page.parent.append(self.stack[-1])
        page.tag.append(name)
        page.kind.append(kind)
        self.stack.append(len(page.tag) - 1)
        self.open[name] = self.open.get(name, 0) + 1
        page.items.append((self.stack[-1], None, 0, 0))

    def pop(self) -> str:
        self.flush()
        element = self.stack.pop()
        name = self.page.tag[element]
        self.open[name] -= 1
        if self.muted and len(self.stack) < self.muted[1]:
            self.muted = None
        self.page.items.append((~element, None, 0, 0))
        return name

    def close(self, closed: frozenset[str], within: frozenset[str]) -> None:
        """Close the open elements of these names, up to an element of ``within``."""
        tags = self.page.tag
        for depth in range(len(self.stack) - 1, 0, -1):
            name = tags[self.stack[depth]]
            if name in within:
                break
            if name in closed:
                while len(self.stack) > depth:
                    self.pop()

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.in_link = False
            if self.page.tag[self.stack[-1]] == "p":
                self.pop()
            if name in CLOSES and any(self.open.get(closed) for closed in CLOSES[name][0]):
                self.close(*CLOSES[name])
            if name in HEADINGS and self.page.tag[self.stack[-1]] in HEADINGS:
                self.pop()
            self.push(name, kind_of(name, attributes))
            if name in VOID:
                self.pop()
        elif name == "br":
            self.add(" ")
        elif name not in VOID:
            if self.muted:
                self.nested += name == self.muted[0]
            elif "=" in attributes and kind_of(name, attributes) in ("apart", "comment"):
                self.muted, self.nested = (name, len(self.stack)), 1
            if name == "a":
                self.in_link = True

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name == "br":
            self.add(" ")
        elif self.open.get(name):
            while self.pop() != name:
                pass
        elif name in BLOCKS:
            self.flush()
        elif self.muted and name == self.muted[0]:
            self.nested -= 1
            if not self.nested:
                self.muted = None


def read_page(html: str | None) -> Page:
    return Scanner(html or "").read()
