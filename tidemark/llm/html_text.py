"""Main text of web pages by composite text density.

For every node of the DOM: the number of characters and of tags below it, and of those the linked ones.  Its density
is the characters per tag, adjusted for links by the logarithm of Sun, Song and Liao's composite text density.  The sum
of the children's densities picks the subtree with the most text; the smallest density on the path from the body to
it is the threshold: lists of links outside an article element that stay below it go, and on a page without such an
element every other block that reaches it is kept too, as is a heading whose next block is kept.

What is never text (scripts, styles, menus, footers, hidden parts) is taken out before.  Forms, and what its class or
id calls a sidebar, a banner or the like, go as well if they lie outside the page's article elements; within them, or
where there are none, only while they hold less than half of the unlinked text: a name does not outweigh the text.  Of
two names that contradict each other ("post share") the text decides.  Reader comments go whatever their length, unless
the article itself, or nearly all of a page without any title, is in them.

The chosen subtree is raised to the article or main element that it is part of, so that a heading or a short paragraph
beside the densest one stays; if it is wider than one such element with most of its text, it is narrowed to that.
White space inside a block becomes one space; blocks are joined by a newline.

Cases.  Null or empty html, and pages without text, give the empty text.  Unclosed and misnested tags are closed as
browsers close them; a tag, comment or script without an end reaches to the end of the page.  Pages of any length are
read once from left to right: no construct is looked for twice, and beyond 512 open elements further ones are taken as
siblings, as browsers do, so time is bounded by the length.  One row comes out for each row, whatever repeats, and
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NO_TEXT = frozenset("script style noscript template iframe object svg math head title canvas audio video noframes applet".split())
_FURNITURE = frozenset("nav footer aside menu dialog button select textarea input datalist".split()) | _NO_TEXT
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright"
    " disqus feedback footer form gdpr hidden login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination"
    " paywall popup promo promotion promoted recommended related reply replies respond responses search share sharing sidebar signup skip social sponsor"
    " sponsored subscribe subscription toolbar widget".split()
)
#: Words that mark an article element itself as something else than the page's article.
_NO_ARTICLE = frozenset("ad ads advert comment comments promo related reply sponsored teaser".split())
_CONTENT = frozenset("article content entry main post story text body".split())
_COMMENTS = frozenset("comment comments disqus reply replies respond responses".split())
#: What a start tag closes, of what stands open, up to the first of the second set.
_P_CLOSERS = _BLOCK - frozenset("button caption li dd dt option optgroup td th tr tbody thead tfoot legend summary".split())
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot"]), frozenset(["table"])),
}
_SCOPE = frozenset("table td th caption button object html body article section main div".split())
_HEAD_TAGS = frozenset("base link meta title style script noscript template head basefont bgsound noframes".split())
_RAW = frozenset("script style xmp iframe noembed noframes title textarea".split())
_DEEPEST = 512
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Markup.  All repeats are possessive: an attempt that fails is not tried again with less.
_OPENING = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
_TO_END = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.I) for tag in _RAW}
#: The attributes that are looked at.
_WANTED = frozenset("id class role style hidden aria-hidden".split())


def _class_words(attrs: dict[str, str | None]) -> set[str]:
    words: set[str] = set()
    for value in (attrs.get("id"), attrs.get("class")):
        last = ""
        for w in _SPLIT.split(value or ""):
            w = w.lower()
            if last not in ("no", "has", "with", "without", "non", "is", "not"):
                words.add(w)
            last = w
    return words


class _Tree:
    """The DOM as parallel lists in document order; node 0 is the root.  Text is kept as (node, text) items."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.attrs = ["#root"], [-1], [{}]
        self.items: list[tuple[int, str | None]] = []  # None: a block begins or ends
        self.open = [0]
        self.counts: dict[str, int] = {}
        self.beyond: dict[str, int] = {}  # elements below the deepest level, which are not opened
        self._read(html)
        self._pop_to(1)

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            mark = html.find("<", at)
            if mark < 0:
                return self._text(html[at:])
            if mark > at:
                self._text(html[at:mark])
            found = _OPENING.match(html, mark)
            if found:
                end = _TO_END.match(html, found.end())
                if not end:
                    return None
                at, name = end.end(), found[2].lower()
                if found[1]:
                    self._end(name)
                    continue
                self._start(name, end[1])
                if name in _RAW:
                    end = _RAW_END[name].search(html, at)
                    if not end:
                        return None
                    at = end.start()
            elif html.startswith("<!--", mark):
                if html.startswith((">", "->"), mark + 4):
                    at = html.index(">", mark) + 1
                    continue
                end = _COMMENT_END.search(html, mark + 4)
                if not end:
                    return None
                at = end.end()
            elif html.startswith(("<!", "<?", "</"), mark):
                at = html.find(">", mark) + 1
                if not at:
                    return None
            else:
                self._text("<")
                at = mark + 1
        return None

    def _pop_to(self, depth: int) -> None:
        for node in self.open[depth:]:
            tag = self.tag[node]
            self.counts[tag] -= 1
            if tag in _BLOCK:
                self.items.append((self.parent[node], None))
        del self.open[depth:]

    def _close(self, tags: frozenset[str], limits: frozenset[str]) -> None:
        """Close the outermost open one of tags that stands above the nearest of limits."""
        if not any(self.counts.get(t) for t in tags):
            return
        found = 0
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in tags:
                found = depth
            elif tag in limits:
                break
        if found:
            self._pop_to(found)

    def _start(self, tag: str, rest: str) -> None:
        if tag in _P_CLOSERS:
            self._close(frozenset(["p"]), _SCOPE)
        if tag in _ENDS:
            self._close(*_ENDS[tag])
        if self.counts.get("head") and tag not in _HEAD_TAGS:
            self._close(frozenset(["head"]), frozenset())
        node, attrs = len(self.tag), {}
        if rest and not rest.isspace():
            for found in _ATTRIBUTE.finditer(rest):
                name = found[1].lower()
                if name in _WANTED and name not in attrs:
                    attrs[name] = unescape(found[2] or found[3] or found[4] or "")
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.attrs.append(attrs)
        if tag in _BLOCK:
            self.items.append((node, None))
        elif tag == "br":
            self.items.append((node, " "))
        foreign = tag in ("svg", "math") or self.counts.get("svg") or self.counts.get("math")
        if tag in _VOID or (foreign and rest.endswith("/")):
            return
        if len(self.open) > _DEEPEST:
            self.beyond[tag] = self.beyond.get(tag, 0) + 1
            return
        self.open.append(node)
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def _end(self, tag: str) -> None:
        if self.beyond.get(tag):
            self.beyond[tag] -= 1
            if tag in _BLOCK:
                self.items.append((self.open[-1], None))
            return
        if not self.counts.get(tag):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            at = self.tag[self.open[depth]]
            if at == tag:
                self._pop_to(depth)
                return
            if tag not in _BLOCK and at in _BLOCK and at != "p":
                return  # an inline end tag doesn't leave its block

    def _text(self, text: str) -> None:
        self.items.append((self.open[-1], unescape(text) if "&" in text else text))


def _unlinked(tree: _Tree, out: list[bool]) -> list[int]:
    """Characters below each node that are neither linked nor out."""
    own, in_link = [0] * len(tree.tag), [False] * len(tree.tag)
    for k in range(1, len(tree.tag)):
        in_link[k] = tree.tag[k] == "a" or in_link[tree.parent[k]]
    for node, text in tree.items:
        if text and not out[node] and not in_link[node]:
            own[node] += len("".join(text.split()))
    for k in range(len(tree.tag) - 1, 0, -1):
        own[tree.parent[k]] += own[k]
    return own


def _furniture(tree: _Tree) -> list[bool]:
    """For each node whether it is, or lies in, something that is no part of an article."""
    n = len(tree.tag)
    inside, words, sure = [False] * n, [frozenset()] * n, [False] * n
    for k in range(1, n):
        tag, attrs = tree.tag[k], tree.attrs[k]
        inside[k] = inside[tree.parent[k]] or tag in ("article", "main")
        sure[k] = sure[tree.parent[k]] or tag in _FURNITURE or (tag == "header" and not inside[k])
        if attrs and not sure[k]:
            sure[k] = "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(_HIDDEN.search(attrs.get("style") or ""))
            if ("class" in attrs or "id" in attrs) and tag not in ("html", "body", "main", "h1"):
                words[k] = _class_words(attrs)

    def below(tags: frozenset[str]) -> list[int]:
        """How many such elements, that may be part of an article, are at or below each node."""
        held = [int(t in tags and not sure[k] and not (t == "article" and words[k] & _NO_ARTICLE)) for k, t in enumerate(tree.tag)]
        for k in range(n - 1, 0, -1):
            held[tree.parent[k]] += held[k]
        return held

    articles, titles, prose = below(frozenset(["article", "main"])), below(frozenset(["article", "main", "h1"])), below(_HEADINGS | {"p"})

    # comments first: a long thread must not count as the page's text
    text = _unlinked(tree, sure)
    out = list(sure)
    for k in range(1, n):
        out[k] = out[k] or out[tree.parent[k]]
        if not out[k] and words[k] & _COMMENTS and not titles[k]:
            out[k] = text[k] < text[0] if titles[0] else 10 * text[k] < 9 * text[0]

    text = _unlinked(tree, out)
    whole = [0] * n  # the article, or else the page, that a node is part of
    for k in range(1, n):
        up = tree.parent[k]
        whole[k] = k if tree.tag[k] in ("article", "main") else whole[up]
        out[k] = out[k] or out[up]
        if out[k]:
            continue
        tag, role = tree.tag[k], (tree.attrs[k].get("role") or "").lower()
        if tag == "article":
            out[k] = bool(words[k] & _NO_ARTICLE)
        elif not articles[k] and (tag in ("form", "fieldset") or role in _ROLES or words[k] & _WORDS or (not inside[k] and "header" in words[k])):
            if (articles[0] and not inside[k]) or (tag in ("form", "fieldset") and not prose[k]):
                out[k] = True  # the article is elsewhere, or there is no text in it but labels
            else:  # not if half of the text is in it, or for a name that contradicts itself a tenth
                out[k] = text[k] * (10 if words[k] & _CONTENT else 2) < text[whole[k]] or not text[k]
    return out


def _densities(tree: _Tree, out: list[bool]) -> tuple[list[float], list[float], list[int], list[int], list[int]]:
    """Composite text densities, sums of the children's, characters, linked ones and links, without what is furniture."""
    n = len(tree.tag)
    chars, tags, linked, links = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for k in range(1, n):
        in_link[k] = tree.tag[k] == "a" or in_link[tree.parent[k]]
        if not out[k]:
            tags[tree.parent[k]] += 1
            links[tree.parent[k]] += tree.tag[k] == "a"
    for node, text in tree.items:
        if text and not out[node]:
            size = len("".join(text.split()))
            chars[node] += size
            linked[node] += size * in_link[node]
    for k in range(n - 1, 0, -1):
        up = tree.parent[k]
        for x in (chars, tags, linked, links):
            x[up] += x[k]
    share = linked[0] / chars[0] if chars[0] else 0.0
    density, sums = [0.0] * n, [0.0] * n
    for k in range(n - 1, -1, -1):
        c, t, lc, lt = chars[k], max(tags[k], 1), max(linked[k], 1), max(links[k], 1)
        if c:
            base = max(math.log(c / max(c - linked[k], 1) * linked[k] + share * c + math.e), math.e)
            density[k] = c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(base)
        if k and not out[k]:
            sums[tree.parent[k]] += density[k]
    return density, sums, chars, linked, links


def main_text(html: str | None) -> str:
    """The page's article; empty if there is none."""
    if not html:
        return ""
    tree = _Tree(html)
    out = _furniture(tree)
    density, sums, chars, linked, links = _densities(tree, out)
    if not chars[0]:
        return ""
    n = len(tree.tag)
    body = next((k for k in range(1, n) if tree.tag[k] == "body"), 0)
    best = max(range(n), key=lambda k: (sums[k], -k) if not out[k] else (-1.0, -k))
    path = [best]
    while path[-1] > 0 and path[-1] != body:
        path.append(tree.parent[path[-1]])
    named = [k for k in path if tree.tag[k] in ("article", "main")]
    if named:
        top = next((k for k in named if tree.tag[k] == "article"), named[0])
    else:
        top = best
        for k in path[1:]:
            if tree.tag[k] in ("body", "html", "#root") or not (tree.tag[k] == "section" or _class_words(tree.attrs[k]) & _CONTENT):
                break
            top = k
        if sums[best] == 0:
            top = path[-1]
        else:  # a wide choice that holds the article: go down to it
            inner = [k for k in range(1, n) if tree.tag[k] in ("article", "main") and not out[k] and 2 * (chars[k] - linked[k]) > chars[0] - linked[0]]
            if inner:
                top = max(inner, key=lambda k: (tree.tag[k] == "article", chars[k], -k))
    threshold = min(density[k] for k in path)
    on_path, keep, inside = set(path), [False] * n, [False] * n
    whole = not named and tree.tag[top] not in ("article", "main")
    for k in range(1, n):
        inside[k] = inside[tree.parent[k]] or tree.tag[k] == "article"
    keep[top] = True
    for k in range(1, n):
        list_of_links = not inside[k] and k not in on_path and links[k] > 2 and 2 * linked[k] > chars[k] and density[k] < threshold
        # without an article element, every block as dense as the path's thinnest part is text of the page
        dense = whole and k not in on_path and tree.tag[k] in _BLOCK and chars[k] > 0 and density[k] >= threshold
        keep[k] = keep[k] or ((keep[tree.parent[k]] or dense) and not out[k] and not list_of_links)
    if whole:  # a heading goes with the block after it
        after: dict[int, int] = {}
        title = [False] * n
        for k in range(n - 1, 0, -1):
            if not out[k] and chars[k]:
                up = tree.parent[k]
                if tree.tag[k] in _HEADINGS and up in after and (keep[after[up]] or after[up] in on_path):
                    title[k] = True
                after[up] = k
        for k in range(1, n):
            title[k] = (title[k] or title[tree.parent[k]]) and not out[k]
            keep[k] = keep[k] or title[k]
    blocks, line = [], []
    for node, text in tree.items:
        if text is None:
            if line:
                blocks.append(" ".join("".join(line).split()))
                line = []
        elif keep[node]:
            line.append(text)
    if line:
        blocks.append(" ".join("".join(line).split()))
    return "\n".join(b for b in blocks if b)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    kind = pages.schema[id_col].dataType.simpleString()

    def each() -> Callable:
        def work(batch: pa.RecordBatch) -> dict:
            texts = [main_text(h) for h in batch["html"].to_pylist()]
            return {id_col: batch["id"], url_col: batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

        return work

    chosen = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return map_arrow(chosen, each, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars long", 256)
