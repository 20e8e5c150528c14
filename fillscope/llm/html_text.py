"""Main text of web pages by scoring the element tree.

A page is read once into block elements and runs of text. Each run passes points for its length and its commas
to the elements around it, less what is link text: all to the container, half to the next
one, less further up. The container with the most points, discounted by its share of link text, is the best; if it
lies in an article, that article is kept, else the container and those siblings that look like it. Menus, headers,
footers, sidebars, notices, adverts, forms and comments are marked by their element, role, or the words of
their class and id, and neither score nor stay. All runs of the kept elements stay, in page order.

Pages are independent rows: no shuffle, any task can be repeated, and the work is linear in a page's length
(nothing is recursive, and points rise five levels at most).

Defined results: null, empty or text-free html has the empty text. Broken html is read as far as it goes: an
unfinished tag or comment at the end is no text, elements left open end with the page, unmatched end tags are
ignored. Character references are decoded as in HTML5; what is none stays as it is. White space inside a
block, line breaks and no-break spaces included, becomes one space. A block never loses text to a limit. Equal
pages have equal texts; a null key or URL and other columns, whatever their names, are kept as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without content, with raw content, and those that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol
    optgroup option p pre search section summary table tbody td template tfoot th thead tr ul""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element ends an open one of these, unless a barrier lies between.
ENDS = {
    **dict.fromkeys(BLOCK - frozenset("body caption dd dt frameset head html legend li option optgroup tbody td tfoot th thead tr".split()), ("p",)),
    "li": ("li", "p"),
    **dict.fromkeys(("dd", "dt"), ("dd", "dt", "p")),
    **dict.fromkeys(("td", "th"), ("td", "th")),
    "tr": ("tr",),
    **dict.fromkeys(("tbody", "tfoot", "thead"), ("tbody", "tfoot", "thead")),
    **dict.fromkeys(("option", "optgroup"), ("option",)),
}
BARRIERS = {
    "p": frozenset("button caption marquee object table td template th".split()),
    "li": frozenset("ol ul menu dir".split()),
    "dd": frozenset(["dl"]),
    "dt": frozenset(["dl"]),
    **dict.fromkeys("td th tr tbody tfoot thead".split(), frozenset(["table"])),
    "option": frozenset(["select", "datalist"]),
}
HEAD_CONTENT = frozenset("base link meta noscript script style template title".split())

# What never belongs to the main text: elements, roles, and words of a class or id.
BOILERPLATE = frozenset(
    """aside audio button canvas datalist dialog embed footer form head iframe input menu nav noscript object
    search select svg template textarea video""".split()
)
BOILERPLATE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist commenter disqus discussion replies reply respond responses".split())
BOILERPLATE_WORDS = COMMENT_WORDS | frozenset(
    """ad ads adbox adslot adsense advert adverts advertisement advertisements advertising alert announcement aside banner
    banners breadcrumb breadcrumbs consent cookie cookies copyright crumbs cta donate feedback footer gdpr login masthead menu menus
    modal nav navbar navi navigation newsletter notice notices notification optin outbrain overlay pager pagination popup promo
    promos promoted promotion rail recommendations recommended related share sharebar sharing side sidebar sidebars signin signup
    skip skiplink social sponsor sponsored sponsors subnav subscribe subscription taboola teaser teasers ticker toolbar topbar
    topnav trending widget widgets""".split()
)
# A name that begins so says something about the page, as in has-sidebar.
MODIFIERS = frozenset("has hide no with without".split())
CONTENT_WORDS = frozenset("article body content entry main post story text".split())

ONE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
COMMAS = re.compile("[,،、，]")
# Containers whose text scores for the element around them.
PARAGRAPHS = frozenset("p pre li td th dd dt blockquote figcaption caption summary".split())
LEVELS = (1.0, 1 / 2, 1 / 6, 1 / 9, 1 / 12)
HEADING_SHARE = 0.1
# Prose that a page without an article must lose to names before these are no longer believed.
LOST_PROSE = 250
ARTICLE_POINTS, MAIN_POINTS, CONTENT_POINTS = 25.0, 10.0, 10.0


class Element:
    """A block element: what it is, and what its subtree adds up to."""

    __slots__ = ("block", "gone", "heading_only", "kept", "length", "links", "n_links", "names", "points", "prose", "tag", "why")

    def __init__(self, tag: str, block: Element | None, names: frozenset, why: str):
        self.tag, self.block, self.names, self.why = tag, block, names, why
        self.length = self.links = self.n_links = self.prose = 0
        self.points = 0.0
        self.gone = self.kept = self.heading_only = False

    def ancestors(self) -> Iterator[Element]:
        above = self
        while above is not None:
            yield above
            above = above.block


class Open:
    """An element on the stack of open ones; ``block`` is its nearest block element."""

    __slots__ = ("block", "muted", "tag")

    def __init__(self, tag: str, block: Element, muted: bool):
        self.tag, self.block, self.muted = tag, block, muted


def name_words(names: str) -> tuple[frozenset, frozenset]:
    """Words of class and id names, and of these the ones that are a whole name."""
    words, whole = set(), set()
    for name in names.split():
        parts = [p.lower() for p in NAME_PARTS.findall(name)]
        if not parts or parts[0] in MODIFIERS:
            continue
        words.update(parts)
        if len(parts) == 1:
            whole.add(parts[0])
    return frozenset(words), frozenset(whole)


def boilerplate(tag: str, attributes: str, in_article: bool) -> tuple[str, frozenset]:
    """Why an element is none of the main text ("" if it may be), and the words of its names.

    ``element``: by what it is; ``names``: by class or id; ``comments``: readers' comments;
    ``headings``: a header of an article, of which the headings stay.
    """
    words = whole = frozenset()
    role = ""
    if attributes and not attributes.isspace():
        found = {k.lower(): a or b or c or "" for k, a, b, c in ATTRIBUTE.findall(attributes)}
        words, whole = name_words(unescape(f"{found.get('class', '')} {found.get('id', '')}"))
        role = found.get("role", "").strip().lower()
        style = SPACE.sub("", found.get("style", "").lower())
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style
        if hidden and tag not in ("html", "body"):
            return "element", words
    if tag in ("html", "body"):
        return "", words
    if tag in BOILERPLATE or role in BOILERPLATE_ROLES:
        return "element", words
    if tag in ("article", "main"):
        # Words beside others are too weak here: article class="post ad-free".
        return ("comments" if words & COMMENT_WORDS else "names" if whole & BOILERPLATE_WORDS else ""), words
    if words & COMMENT_WORDS:
        return "comments", words
    if words & BOILERPLATE_WORDS:
        return "names", words
    if tag == "header" or "header" in words:
        return ("headings" if in_article or words & CONTENT_WORDS else "element"), words
    return "", words


class Page:
    """Reads html into block elements, in page order, and runs (element, text, characters in links)."""

    def __init__(self, html: str):
        self.root = Element("html", None, frozenset(), "")
        self.elements = [self.root]
        self.runs: list[tuple[Element, str, int]] = []
        self.stack = [Open("html", self.root, False)]
        self.open = Counter(["html"])
        self.pieces: list[str] = []
        self.linked: list[str] = []
        self.muted = 0
        self.read(html)
        self.flush()

    def read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            mark = html.find("<", at)
            if mark < 0:
                mark = end
            if mark > at:
                self.text(html[at:mark])
            if mark == end:
                return
            found = ONE_TAG.match(html, mark)
            if found:
                closing, tag, attributes = found.groups()
                tag, at = tag.lower(), found.end()
                if closing:
                    self.end(tag)
                elif tag in RAW:
                    ended = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                    at = ended.start() if ended else end
                else:
                    self.start(tag, attributes, attributes.endswith("/"))
                continue
            following = html[mark + 1 : mark + 2]
            if html.startswith("<!--", mark):
                close = html.find("-->", mark + 2)
                at = close + 3 if close >= 0 else end
            elif following in ("!", "?", "/"):
                close = html.find(">", mark)
                at = close + 1 if close >= 0 else end
            elif following.isascii() and following.isalpha():
                return  # a tag that the page does not finish
            else:
                self.text("<")
                at = mark + 1

    def text(self, raw: str) -> None:
        if self.muted:
            return
        text = unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        if self.open["a"]:
            self.linked.append(text)

    def flush(self) -> None:
        """End the run of text before a block begins or ends."""
        if self.pieces:
            text = SPACE.sub(" ", "".join(self.pieces)).strip()
            if text:
                links = len(SPACE.sub(" ", "".join(self.linked)).strip())
                self.runs.append((self.stack[-1].block, text, min(links, len(text))))
            self.pieces, self.linked = [], []

    def push(self, tag: str, block: Element, muted: bool) -> None:
        self.stack.append(Open(tag, block, muted))
        self.open[tag] += 1
        self.muted += muted

    def pop(self, place: int) -> None:
        """Close the open elements from ``place`` on."""
        for item in self.stack[place:]:
            self.open[item.tag] -= 1
            self.muted -= item.muted
        del self.stack[place:]

    def close_implied(self, tag: str) -> None:
        for other in ENDS.get(tag, ()):
            if not self.open[other]:
                continue
            for place in range(len(self.stack) - 1, 0, -1):
                if self.stack[place].tag == other:
                    self.pop(place)
                    break
                if self.stack[place].tag in BARRIERS[other]:
                    break

    def start(self, tag: str, attributes: str, closed: bool) -> None:
        if tag in ("html", "body") and self.open[tag]:
            return
        if self.open["head"] and tag not in HEAD_CONTENT:
            self.end("head")
        if tag == "br":
            self.pieces.append(" ")
            return
        block = tag in BLOCK
        if block:
            self.flush()
            self.close_implied(tag)
        if tag in VOID:
            return
        inside = self.stack[-1].block
        why, names = boilerplate(tag, attributes, bool(self.open["article"] or self.open["main"]))
        if block:
            element = Element(tag, inside, names, why)
            self.elements.append(element)
            self.push(tag, element, False)
        elif not closed:
            inside.n_links += tag == "a"
            self.push(tag, inside, bool(why) and why != "headings")

    def end(self, tag: str) -> None:
        block = tag in BLOCK
        if block:
            self.flush()
        if not self.open[tag] or tag in ("html", "body"):
            return
        place = len(self.stack) - 1
        while self.stack[place].tag != tag:
            place -= 1
        if block:
            self.pop(place)
        else:
            # An inline end leaves blocks open that began inside.
            item = self.stack.pop(place)
            self.open[tag] -= 1
            self.muted -= item.muted


def mark_boilerplate(page: Page, by_name: bool) -> None:
    """Decide which elements are gone; elements come in page order, so those above are decided first.

    What a name or a form would drop stays if it holds an article with most of the page's prose.
    """
    for element, text, links in page.runs:
        element.prose += 0 if links * 2 > len(text) else len(text)
    articles = {}
    for element in reversed(page.elements):
        articles[element] = element.tag in ("article", "main") or articles.get(element, False)
        if element.block is not None:
            element.block.prose += element.prose
            articles[element.block] = articles.get(element.block, False) or articles[element]
    whole = page.root.prose
    for element in page.elements:
        above = element.block
        element.gone, element.heading_only = (above.gone, above.heading_only) if above else (False, False)
        if element.why == "comments":
            element.gone = True
        elif element.why == "names":
            wraps = element.tag not in ("article", "main") and articles[element] and element.prose * 2 > whole
            element.gone |= by_name and not wraps
        elif element.why == "element":
            element.gone |= not (element.tag == "form" and element.prose * 2 > whole)
        elif element.why == "headings":
            element.heading_only = True


def readable(element: Element) -> bool:
    return not element.gone and (not element.heading_only or element.tag in HEADINGS)


def score(page: Page) -> list[Element]:
    """Pass points upward; returns the elements that got some, in page order."""
    for element, text, links in page.runs:
        if not readable(element):
            continue
        element.length += len(text)
        element.links += links
        points = (1 + len(COMMAS.findall(text)) + min(len(text) / 100, 3)) * (1 - links / len(text))
        points *= HEADING_SHARE if element.tag in HEADINGS else 1
        first = element.block if element.tag in PARAGRAPHS and element.block is not None else element
        for share, above in zip(LEVELS, first.ancestors()):
            above.points += share * points
    for element in reversed(page.elements):
        if element.block is not None and not element.gone:
            element.block.length += element.length
            element.block.links += element.links
            element.block.n_links += element.n_links
    scored = [e for e in page.elements if e.points > 0]
    for element in scored:
        if element.tag == "article":
            element.points += ARTICLE_POINTS
        elif element.tag == "main":
            element.points += MAIN_POINTS
        elif element.names & CONTENT_WORDS:
            element.points += CONTENT_POINTS
        element.points *= 1 - element.links / max(1, element.length)
    return scored


def kept_roots(page: Page, scored: list[Element]) -> list[Element]:
    """The best container, widened to its article, or together with the siblings that belong to it."""
    best = max(scored, key=lambda e: e.points)
    outer = [e for e in best.ancestors() if e.tag in ("article", "main")]
    if outer:
        articles = [e for e in outer if e.tag == "article"]
        return [(articles or outer)[-1]]
    while best.block is not None and best.block.tag not in ("html", "body") and best.block.points >= 0.75 * best.points:
        best = best.block
    if best.tag in ("html", "body"):
        return [best]
    roots, before = [], True
    for element in page.elements:
        if element is best:
            roots.append(element)
            before = False
        elif element.block is best.block and readable(element) and element.length:
            density = element.links / element.length
            alike = element.tag == best.tag and element.names == best.names and density < 0.5
            bonus = 0.2 * best.points if element.names and element.names == best.names else 0.0
            strong = element.points + bonus >= max(10.0, 0.2 * best.points)
            title = before and element.tag in HEADINGS
            prose = element.tag in PARAGRAPHS and density < 0.25
            if alike or strong or title or prose:
                roots.append(element)
    return roots


def link_list(element: Element) -> bool:
    """A list of hardly anything but links, inside the main text."""
    return element.tag in ("ul", "ol", "div", "section", "table") and element.n_links >= 3 and element.links > 0.8 * element.length


def main_text(html: str | None) -> str:
    """The main text of one page, blocks joined by line feeds."""
    for by_name in (True, False):
        page = Page(html or "")
        mark_boilerplate(page, by_name)
        scored = score(page)
        if scored:
            roots = kept_roots(page, scored)
            chosen = {id(e) for e in roots}
            for element in page.elements:
                above = element.block
                element.kept = id(element) in chosen or (above is not None and above.kept and not link_list(element))
            return "\n".join(text for element, text, _ in page.runs if element.kept and readable(element))
        if page.root.prose < LOST_PROSE or any(e.tag in ("article", "main") for e in page.elements):
            break
    return ""


def extract(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """Add the main text of each page as column ``name``; a column of that name is replaced."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(page.as_py()) for page in batch], pa.string())

    return pages.withColumn(name, texts(pages[html].cast("string")))
