"""Main text of HTML pages by composite text density.

A page is parsed into a DOM: tags that HTML lets one leave out are closed as a
browser does, and comments, scripts and the like are no text. Elements that
say what they are (menus, headers, footers, sidebars, notices, adverts, forms,
reader comments: by tag, role, class or id) are taken out. Of what is left

* every node has a density: its characters for each tag, adjusted by the
  characters and tags of links inside it;
* the density sum of a node adds up the densities of its children and of the
  text runs right below it. The container with the largest sum is the core;
* the smallest density on the path from the body to the core is the
  threshold: every node that reaches it contributes the container with the
  largest sum below it, and the main text is the smallest subtree that covers
  all these, less blocks that are mostly links.

An ``article`` or ``main`` element, where there is one, bounds the subtree from
both sides: a core inside it grows to it, one around it shrinks to the article
with the largest sum.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text, without

# ---- fixed values: elements of HTML ----
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul""".split())
#: start tags that end an open paragraph
ENDS_P = BLOCK - frozenset("caption body tbody tfoot thead tr legend option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: a start tag ends an open one of these, unless one of those has begun since
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)),
    "option": (("option",), ("select",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)), "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}
#: no end tag or paragraph reaches out of these
SCOPE = ("td", "th", "caption", "button", "object")

# ---- fixed values: what is not main text ----
DROP_TAGS = frozenset("nav footer aside menu dialog noscript template svg math canvas audio video object iframe select button textarea script style title".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
DROP_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo promoted banner cookie cookies consent gdpr
    notice notices notification popup modal overlay newsletter subscribe subscription signup sidebar rail nav navbar navigation menu menus breadcrumb
    breadcrumbs pagination pager footer toolbar share sharing social related recommended recommendations trending widget login search""".split())
MAIN = ("article", "main")
#: lists that are mostly links are menus, wherever they stand; such boxes only where no element says what the article is
MENUS, BOXES = ("ul", "ol", "dl"), ("div", "section", "table")

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*|)))?""")
_GAP = re.compile(r"[\s/]*")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Page:
    """The DOM of one page as lists over node numbers; node 0 is the body, and
    children have larger numbers than their parents."""

    def __init__(self, source: str):
        self.tags, self.parents, self.attributes = ["body"], [-1], [{}]
        self.children: list[list] = [[]]    # node numbers and texts
        self._stack, self._open = [0], {}
        self._parse(source)

    # ---- parsing ----

    def _parse(self, s: str) -> None:
        """In time proportional to the page's length: nothing is scanned twice."""
        i, n = 0, len(s)
        while i < n:
            j = s.find("<", i)
            if j < 0:
                return self._text(s[i:])
            if j > i:
                self._text(s[i:j])
            c = s[j + 1:j + 2]
            if c in ("!", "?") or c == "/" and not _NAME.match(s, j + 2):
                end, size = ("-->", 3) if s.startswith("<!--", j) else (">", 1)
                k = s.find(end, j + 2)
                if k < 0:
                    return
                i = k + size
                continue
            closing = c == "/"
            name = _NAME.match(s, j + 1 + closing)
            if not name:
                self._text("<")
                i = j + 1
                continue
            tag, k, found = name[0].lower(), name.end(), {}
            while True:
                k = _GAP.match(s, k).end()
                if k >= n:
                    return    # the page ends inside a tag
                if s[k] == ">":
                    break
                a = _ATTRIBUTE.match(s, k)
                found.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
                k = a.end()
            i = k + 1
            if closing:
                self._end(tag)
                continue
            self._start(tag, found)
            if tag in RAW:
                end = _RAW_END[tag].search(s, i)
                i = end.start() if end else n
                self._end(tag)

    def _text(self, text: str) -> None:
        self.children[self._stack[-1]].append(html.unescape(text) if "&" in text else text)

    def _last(self, names) -> int:
        """Place in the stack of the last open element of these names, or 0."""
        return max((self._open[t][-1] for t in names if self._open.get(t)), default=0)

    def _pop_to(self, place: int) -> None:
        while len(self._stack) > place:
            self._open[self.tags[self._stack.pop()]].pop()

    def _start(self, tag: str, attributes: dict) -> None:
        if tag in ("html", "head", "body"):
            return
        if tag in ENDS_P and (p := self._last(("p",))) > self._last(SCOPE):
            self._pop_to(p)
        if tag in HEADINGS and self.tags[self._stack[-1]] in HEADINGS:
            self._pop_to(len(self._stack) - 1)
        if tag in IMPLIED and (old := self._last(IMPLIED[tag][0])) > self._last(IMPLIED[tag][1]):
            self._pop_to(old)
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.attributes.append(attributes)
        self.children.append([])
        self.children[self._stack[-1]].append(node)
        if tag not in VOID:
            self._open.setdefault(tag, []).append(len(self._stack))
            self._stack.append(node)

    def _end(self, tag: str) -> None:
        place = self._last((tag,))
        barrier = self._last(SCOPE) if tag not in SCOPE and tag not in ("table", "tr", "tbody", "thead", "tfoot") else 0
        # an inline element ends inside its own block only
        if place > barrier and (tag in BLOCK or tag in SCOPE or place > self._last(BLOCK)):
            self._pop_to(place)

    # ---- what each element says about itself ----

    def _words(self, node: int) -> set[str]:
        a = self.attributes[node]
        return {w.lower() for k in ("class", "id") for w in _WORD.findall(a.get(k, ""))} if a else set()

    def dropped(self) -> list[bool]:
        """Which nodes are, or are inside, something other than main text."""
        n = len(self.tags)
        words = [self._words(i) for i in range(n)]
        chars = [sum(len("".join(c.split())) for c in kids if isinstance(c, str)) for kids in self.children]
        article = [self.tags[i] in MAIN and not words[i] & COMMENT_WORDS for i in range(n)]
        title = [t == "h1" for t in self.tags]
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            chars[p] += 0 if self.tags[i] in RAW else chars[i]
            article[p] |= article[i]
            title[p] |= title[i]
        out, inside = [False] * n, [False] * n
        for i in range(1, n):
            p, tag, a = self.parents[i], self.tags[i], self.attributes[i]
            inside[i] = inside[p] or (tag in MAIN and not words[i] & COMMENT_WORDS)
            holds = article[i] or title[i] or (not article[0] and 2 * chars[i] > chars[0])
            hidden = "hidden" in a or re.search(r"display\s*:\s*none", a.get("style", "")) is not None
            header = tag == "header" or bool(words[i] & HEADER_WORDS)
            named = tag in MAIN or tag in ("b", "i", "em", "strong", "a", "p") and not a
            out[i] = (out[p] or tag in DROP_TAGS or hidden or (words[i] & COMMENT_WORDS and not title[i] and tag != "main")
                      or (header and not inside[p] and not article[i] and (article[0] or not title[i]))
                      or (not named and not holds and (tag == "form" or a.get("role", "").lower() in DROP_ROLES or bool(words[i] & DROP_WORDS))))
        return out

    # ---- densities ----

    def main(self) -> str:
        n = len(self.tags)
        gone = self.dropped()
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        runs: list[list[int]] = [[] for _ in range(n)]
        blocks = [False] * n
        all_links = all_chars = 0
        in_link = [False] * n
        for i in range(n):
            in_link[i] = self.tags[i] == "a" or i > 0 and in_link[self.parents[i]]
            runs[i] = [k for c in self.children[i] if isinstance(c, str) and (k := len("".join(c.split())))]
            if self.tags[i] not in RAW:
                all_chars += sum(runs[i])
                all_links += sum(runs[i]) if in_link[i] else 0
        for i in range(n - 1, -1, -1):
            if gone[i]:
                continue
            chars[i] += sum(runs[i])
            link_chars[i] = chars[i] if self.tags[i] == "a" else link_chars[i]
            if i:
                p = self.parents[i]
                chars[p] += chars[i]
                tags[p] += tags[i] + 1
                link_chars[p] += link_chars[i]
                link_tags[p] += link_tags[i] + (self.tags[i] == "a")
                blocks[p] |= self.tags[i] in BLOCK or blocks[i]
        if not chars[0]:
            return ""
        share = all_links / all_chars
        density = [composite_density(chars[i], tags[i], link_chars[i], link_tags[i], share) if not gone[i] else 0.0 for i in range(n)]
        # sums of containers; a node without blocks inside counts as its own density
        sums = [sum(composite_density(r, 1, 0, 0, share) for r in runs[i]) if blocks[i] else density[i] for i in range(n)]
        best = list(range(n))    # of each subtree, the node with the largest sum; of equal ones the outermost
        for i in range(n - 1, 0, -1):
            if gone[i]:
                continue
            p = self.parents[i]
            if blocks[p]:
                sums[p] += density[i]
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            if not gone[i] and blocks[p] and (sums[best[i]], -best[i]) > (sums[best[p]], -best[p]):
                best[p] = best[i]
        articles = {i for i in range(n) if self.tags[i] in MAIN and not gone[i] and chars[i]}
        top = self._subtree(gone, density, sums, best, articles, blocks)
        return self._blocks(top, gone, chars, link_chars, MENUS if articles else MENUS + BOXES)

    def _subtree(self, gone, density, sums, best, articles, blocks) -> int:
        path = self._path(best[0])[::-1]    # from the body to the core
        if articles:
            around = [i for i in path if i in articles]
            return around[-1] if around else max(articles, key=lambda i: (sums[best[i]], -i))
        threshold = min(density[i] for i in path)
        depth = {node: k for k, node in enumerate(path)}
        cover, climbed = len(path) - 1, set(path)
        inside = [True] + [False] * (len(self.tags) - 1)
        for i in range(1, len(self.tags)):
            # inside a paragraph there is nothing to mark
            inside[i] = not gone[i] and inside[self.parents[i]] and blocks[self.parents[i]]
            if inside[i] and density[i] >= threshold:
                node = best[i]
                while node not in climbed:
                    climbed.add(node)
                    node = self.parents[node]
                cover = min(cover, depth.get(node, cover))
        return path[cover]

    def _path(self, node: int) -> list[int]:
        """From a node up to the body."""
        out = [node]
        while out[-1]:
            out.append(self.parents[out[-1]])
        return out

    def _blocks(self, top: int, gone, chars, link_chars, menus) -> str:
        out: list[str] = []
        line: list[str] = []

        def flush() -> None:
            text = " ".join("".join(line).split())
            if text:
                out.append(text)
            line.clear()

        work: list = [(top, 0)]
        while work:
            node, k = work.pop()
            kids = self.children[node]
            while k < len(kids):
                kid = kids[k]
                k += 1
                if isinstance(kid, str):
                    line.append(kid)
                    continue
                tag = self.tags[kid]
                if gone[kid] or tag in menus and 2 * link_chars[kid] > chars[kid]:
                    if tag in BLOCK:
                        flush()
                    continue
                if tag in BLOCK:
                    flush()
                elif tag in ("br", "td", "th"):
                    line.append(" ")
                work.append((node, k))
                work.append((kid, 0))
                break
            else:
                if self.tags[node] in BLOCK:
                    flush()
        flush()
        return "\n".join(out)


def composite_density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters for each tag, times the logarithm of (characters by link
    characters) * (tags by link tags) to a base that grows with the links.
    Zero counts below a line are ones; ``share`` is the page's link
    characters by all characters, and a page without links has no adjustment."""
    if not chars:
        return 0.0
    t = max(tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
    if base <= 1.0:
        return chars / t
    return chars / t * math.log(max(chars / max(link_chars, 1) * t / max(link_tags, 1), 1.0)) / math.log(base)


def main_text(source: str | None) -> str:
    return Page(source or "").main()


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(t) for t in b.column(b.num_columns - 1).to_pylist()]
        columns = [b.column(i) for i in range(b.num_columns - 1)]
        names = b.schema.names[:-1]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])


def extract_text(pages: DataFrame, source: str = "html") -> DataFrame:
    """Every row with ``text``, its page's main text, and ``n_chars``, the
    code points of that, and without the HTML.

    Character references are decoded, white space inside a block becomes one
    space, and blocks are joined by line feeds in page order; nothing is cut. A
    null page counts as empty; a page without text, or with nothing but what
    is taken out, gives an empty text. A page that ends inside a tag, a comment
    or a script ends there. Pages of any length are read whole, in time about
    proportional to their length, one after the other and without any
    shuffle. Repeated rows are extracted one by one. Columns called ``text`` or
    ``n_chars`` are replaced. No rows give no rows.
    """
    return map_text(without(pages, ("text", "n_chars")), source, _extract, "text string, n_chars bigint", keep_text=False)
