"""Main text of web pages by tree scoring.

A page becomes a list of nodes and of text blocks. Subtrees that are never article text by element or role (menus, headers,
footers, asides, scripts) give no blocks; the header of an article or main element belongs to it. Forms and the words of class
and id (sidebar, social, comment ..) are only signs: such a subtree is left out unless it holds nearly all the running text of the
page, as a form or a `page-with-sidebar` around everything does. Adverts, consent boxes and comments of readers are not spared
so. Each paragraph passes points for its length and commas to its ancestors, less with every level, and a
container's points are discounted by its link density. The best container, raised to an enclosing article or
main element, is kept with those of its siblings that score or read like text; all blocks in them come out in page order.

When that leaves no text at all, forms and words of class and id are not looked at; links alone are no text then. Lists of links go with all else inside the best container, and are left out beside it.

Nulls and odd pages: a null or empty page has an empty text; so has one without any text outside the above. Text
without any markup is one block. Unclosed, misnested and unknown elements are read as browsers roughly do; a page
that is cut off inside a comment or script ends there. Long pages are read whole, in time linear in their length.
"""

import html
import re

import pyarrow as pa
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

# Possessive: a tag with a quote that never closes is tried once, then read up to its first `>`.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

_RAW = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noscript")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_DROPPED = frozenset(
    "script style noscript textarea title head nav header footer aside form button select input iframe object embed "
    "canvas svg template dialog menu audio video map datalist xmp".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form status".split())
_BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion promoted nav navbar "
    "navigation menu sidebar footer header masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices "
    "notification popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended "
    "recommendations comment comments commentlist disqus reply replies respond responses widget toolbar pagination pager "
    "paging search skip skyscraper alert disclaimer copyright outbrain taboola teaser trending hidden".split())
# Not spared however much text they hold, unless the words also name an article.
_NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox cookie cookies consent gdpr newsletter popup modal overlay comment "
    "comments commentlist disqus reply replies respond responses outbrain taboola disclaimer copyright hidden".split())
# On a paragraph or heading these say what it is about, not that it is none.
_TOPIC_WORDS = frozenset("related trending teaser header masthead banner search notice alert social promo recommended".split())
#: The share of the running text that makes a marked subtree the page itself.
_NEARLY_ALL = 0.8
_HEAD_WORDS = frozenset(("header", "masthead", "banner", "search", "related", "alert", "notice"))
_TEXT_WORDS = frozenset("article post entry story content body main text blog page".split())
_WRAPPING = frozenset(("with", "has", "no", "without", "is"))
_LISTS = frozenset(("ul", "ol", "dl", "table", "div", "section"))
_PARAGRAPHS = frozenset("p pre td li blockquote h1 h2 h3 h4 h5 h6".split())
_ROOTS = frozenset(("html", "body", "main"))
_CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "option": ("option", ("select",)),
           "tr": ("tr td th", ("table", "thead", "tbody", "tfoot")), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}
_INSIDE_P = frozenset(_BLOCK) - {"body", "html", "head"}


_TEXT, _MARKED, _NEVER, _GONE = range(4)


def _verdict(tag: str, attributes: str, in_article: bool) -> int:
    """_GONE: no text at all; _NEVER, _MARKED: left out, the latter unless it is nearly the whole page; else _TEXT."""
    if tag in _DROPPED and tag != "form" and not (tag == "header" and in_article):
        return _GONE
    found = _MARKED if tag == "form" else _TEXT
    if not attributes or tag in _ROOTS:
        return found
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "role" and value.lower() in _ROLES and not (value.lower() == "form" and tag == "form"):
            return _GONE
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return _GONE
        if name in ("class", "id"):
            tokens = [[w.lower() for w in _WORDS.findall(token)] for token in value.split()]
            named = any(_TEXT_WORDS.intersection(words) for words in tokens)
            for words in tokens:
                bad = _BAD_WORDS.intersection(words)
                if tag in _PARAGRAPHS:
                    bad -= _TOPIC_WORDS
                if bad and words[0] not in _WRAPPING and not (bad <= _HEAD_WORDS and _TEXT_WORDS.intersection(words)):
                    found = max(found, _NEVER if bad & _NEVER_WORDS and not named else _MARKED)
    return found


class _Page:
    """Nodes by number (parent before child) and the blocks of text in page order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.dropped, self.cue = [-1], ["#root"], [False], [False]
        self.verdict, self.in_article, self.bare = [_TEXT], [False], False
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters in links
        self._read(source)
        self._sift()

    def _sift(self) -> None:
        """Leave the marked subtrees out, but for those that hold nearly all the running text."""
        def plain(gone: list[bool]) -> list[int]:
            size = [0] * len(gone)
            for node, text, in_links in self.blocks:
                size[node] += 0 if gone[node] or in_links >= 0.66 * len(text) else len(text) - in_links
            for node in range(len(gone) - 1, 0, -1):
                size[self.parent[node]] += size[node]
            return size

        def below(own: list[bool]) -> list[bool]:
            for node in range(1, len(own)):
                own[node] = own[node] or own[self.parent[node]]
            return own

        never = below([v == _NEVER for v in self.verdict])
        size = plain(never)
        gone = below([v == _NEVER or v == _MARKED and not (size[0] and size[i] >= _NEARLY_ALL * size[0]) for i, v in enumerate(self.verdict)])
        left = [b for b in self.blocks if not gone[b[0]]]
        self.bare = not left
        if left:
            self.blocks = left
            self.dropped = [d or g for d, g in zip(self.dropped, gone)]

    def _read(self, source: str) -> None:
        stack, open_tags, links = [0], {}, 0
        pieces, linked, owner, position = [], 0, 0, 0

        def flush() -> None:
            nonlocal pieces, linked
            if pieces:
                text = " ".join(html.unescape("".join(pieces)).split())
                if text:
                    self.blocks.append((owner, text, min(linked, len(text))))
                pieces, linked = [], 0

        def pop_to(depth: int) -> None:
            nonlocal links
            while len(stack) > depth:
                tag = self.tag[stack.pop()]
                open_tags[tag] -= 1
                links -= tag == "a"
                if tag in _BLOCK:
                    flush()

        def text(part: str) -> None:
            nonlocal linked, owner
            node = stack[-1]
            if self.dropped[node] or not part:
                return
            if not pieces:
                at = len(stack) - 1
                while at and self.tag[stack[at]] not in _BLOCK:
                    at -= 1
                owner = stack[at]
            pieces.append(part)
            if links:
                linked += len(part.strip())

        end = len(source)
        while position < end:
            match = _TOKEN.search(source, position)
            if match is None:
                text(source[position:])
                break
            text(source[position:match.start()])
            position = match.end()
            closing, tag, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                if open_tags.get(tag):
                    at = len(stack) - 1
                    while self.tag[stack[at]] != tag:
                        at -= 1
                    pop_to(at)
                elif tag in _BLOCK or tag == "br":
                    flush() if tag != "br" else text(" ")
                continue
            if tag in _BLOCK:
                flush()
                if tag in _INSIDE_P and open_tags.get("p"):
                    at = len(stack) - 1
                    while at and self.tag[stack[at]] != "p" and (self.tag[stack[at]] not in _BLOCK):
                        at -= 1
                    if self.tag[stack[at]] == "p":
                        pop_to(at)
            if tag in _CLOSES:
                closed, bounds = _CLOSES[tag]
                at, found = len(stack) - 1, 0
                while at and self.tag[stack[at]] not in bounds:
                    if self.tag[stack[at]] in closed.split():
                        found = at
                    at -= 1
                if found:
                    pop_to(found)
            if tag == "br":
                text(" ")
            if tag in _VOID:
                continue
            node = len(self.parent)
            self.parent.append(stack[-1])
            self.tag.append(tag)
            self.verdict.append(_verdict(tag, attributes, self.in_article[stack[-1]]))
            self.dropped.append(self.dropped[stack[-1]] or self.verdict[-1] == _GONE)
            self.cue.append(tag in ("article", "main") or "articleBody" in attributes or 'role="main"' in attributes)
            self.in_article.append(self.cue[-1] or self.in_article[stack[-1]])
            if tag in _RAW:
                stop = _RAW[tag].search(source, position)
                position = source.find(">", stop.start()) + 1 or end if stop else end
                continue
            if attributes.endswith("/") and tag not in _BLOCK:
                continue
            if self.dropped[node] and not self.dropped[stack[-1]] and tag not in _BLOCK:
                text(" ")
            stack.append(node)
            open_tags[tag] = open_tags.get(tag, 0) + 1
            links += tag == "a"
        flush()


def main_text(source: str | None) -> str:
    """The article of one page; see the module."""
    if not source:
        return ""
    page = _Page(source)
    if not page.blocks or page.bare and all(in_links >= 0.66 * len(text) for _, text, in_links in page.blocks):
        return ""
    parent, n = page.parent, len(page.parent)
    points, size, linked = [0.0] * n, [0] * n, [0] * n
    for node, text, in_links in page.blocks:
        size[node] += len(text)
        linked[node] += in_links
        value = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - in_links / len(text))
        # A block in a container of its own passes to it too: text straight in a div scores the div.
        up, level = (parent[node] if page.tag[node] in _PARAGRAPHS else node), 0
        while up >= 0 and level < 6:
            points[up] += value / (1, 2, 6, 9, 12, 15)[level]
            up, level = parent[up], level + 1
    for node in range(n - 1, 0, -1):
        size[parent[node]] += size[node]
        linked[parent[node]] += linked[node]
    score = [p * (1 - linked[i] / size[i]) if size[i] else 0.0 for i, p in enumerate(points)]
    best = max(range(n), key=lambda i: (score[i], -i))
    up = best
    while up >= 0 and not page.cue[up]:
        up = parent[up]
    if up >= 0:
        best = up
    kept = [False] * n
    kept[best] = True
    if parent[best] >= 0 and not page.cue[best]:
        least = max(10.0, 0.2 * score[best])
        for node in range(n):
            if parent[node] == parent[best] and size[node]:
                density = linked[node] / size[node]
                reads = page.tag[node] in ("p", "h1", "h2", "blockquote", "pre") and density < 0.25
                kept[node] = kept[node] or score[node] >= least or reads
    elif page.cue[best]:
        # Several articles side by side are parts of one page when each scores.
        for node in range(n):
            if parent[node] == parent[best] and page.tag[node] == page.tag[best] and not page.dropped[node] and size[node]:
                kept[node] = kept[node] or score[node] >= max(10.0, 0.2 * score[best])
    menu, inside = [False] * n, [node == best for node in range(n)]  # lists beside the best container that are mostly links
    for node in range(1, n):
        inside[node] = inside[node] or inside[parent[node]]
        links_only = page.tag[node] in _LISTS and linked[node] > 0.66 * size[node]
        menu[node] = not inside[node] and (menu[parent[node]] or links_only)
        kept[node] = kept[node] or kept[parent[node]]
    return "\n".join(text for node, text, _ in page.blocks if kept[node] and not menu[node])


@arrow_udf(StringType())
def extract(pages: pa.Array) -> pa.Array:
    """main_text of a column of pages."""
    return pa.array((main_text(p.as_py()) for p in pages), pa.string(), size=len(pages))
