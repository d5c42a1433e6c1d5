"""Main text of web pages by composite text density.

Every DOM node has C characters and T tags below it, of which LC and LT belong to links. Its composite density is C / T,
scaled by a logarithm that falls with the share of links against that of the whole body. The density sum of a node adds its
children's densities; the node with the largest sum holds the article. The smallest density on the path from there up to
the body is the threshold from which other subtrees count as content too.

What surrounds an article by its element or names is marked out before, except for forms and named elements that hold most of
the page's text outside links, and any article or main element with text that there is. An article or main element that the page
declares can only confirm what density has found: where over half of the text found lies within such elements, those it lies in
are taken whole, and else they do not count.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from math import e, log

from pyspark.sql import DataFrame

from .common import map_rows, need

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""[>"']""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

# Element names of HTML, and words that sites use in class, id and role for what surrounds an article.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("head script style noscript template iframe object embed svg math canvas audio video select button textarea form fieldset nav footer aside dialog menu search title xmp noembed noframes".split())
SCOPES = frozenset("html body table td th caption button object template article section main div".split())
AROUND = frozenset("ad ads adbox adslot advert adverts advertising advertisement sponsor sponsored sponsors promo promos promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer masthead comment comments commentlist disqus respond reply replies share sharing social related recommended widget widgets toolbar login signup pagination pager banner complementary contentinfo skip".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
HEADINGS = ("h1", "h2", "h3")  # of an article that stands above its text
WRAPS = frozenset(("form", "fieldset"))  # of DROPPED, what can stand around a whole page
LINK_SHARE = 0.6  # of a list's or division's characters within links, from which it is a menu


class Node:
    __slots__ = ("around", "chars", "density", "kids", "link_chars", "link_tags", "out", "parent", "sum", "tag", "tags")

    def __init__(self, tag: str, parent: Node | None, out: bool):
        self.tag, self.parent, self.out, self.around = tag, parent, out, ""
        self.kids: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _around(tag: str, attributes: str, inside: bool) -> str:
    """"hidden" for what is never content, "names" for what surrounds an article unless it holds it, else empty.

    Of a class, id or role all words count: "cookie-notice" surrounds, "has-sidebar" and "no-comments" do not.
    """
    if tag in DROPPED and tag not in WRAPS or tag == "header" and not inside or attributes and _HIDDEN.search(attributes):
        return "hidden"
    if tag in WRAPS:
        return "names"
    if not attributes or tag in ("html", "body", "article", "main"):
        return ""
    for m in _NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = _WORD.findall(name)
            if words and all(w in AROUND or w == "header" and not inside for w in words):
                return "names"
    return ""


def _keep_most(root: Node) -> None:
    """Sets `out` from `around`; what names mark stays if it holds over half of the page's text outside links, and an article if the page has one."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += [k for k in n.kids if isinstance(k, Node) and k.around != "hidden"]
    if not any(n.around for n in order) and all(not isinstance(k, Node) or k.around != "hidden" for n in order for k in n.kids):
        return
    text: dict[Node, int] = {}
    declares: set[Node] = set()
    for n in reversed(order):
        text[n] = 0 if n.tag == "a" else sum(len(_SPACE.sub("", k)) if isinstance(k, str) else text.get(k, 0) for k in n.kids)
        if n.tag in ("article", "main") and text[n] or any(k in declares for k in n.kids if isinstance(k, Node)):
            declares.add(n)
    todo = [root]
    while todo:
        n = todo.pop()
        for k in n.kids:
            if isinstance(k, Node):
                k.out = n.out or k.around == "hidden" or k.around == "names" and (text[k] * 2 <= text[root] or k not in declares and root in declares)
                todo.append(k)


class _Markup:
    """Finds the tags, comments and declarations of a page, in one pass whatever its quotes are like."""

    def __init__(self, html: str):
        self.html, self.dead, self.stop = html, set(), (0, -1)
        self.last = {c: html.rfind(c) for c in ">\"'"}

    def _next_stop(self, at: int) -> int:
        """Where the next > or quote is; -1: nowhere."""
        known, stop = self.stop
        if not (known <= at <= stop or stop < 0 and known <= at and known):
            m = _STOP.search(self.html, at)
            self.stop = at, m.start() if m else -1
        return self.stop[1]

    def _end(self, at: int) -> int:
        """The place of the > that ends a tag, outside quotes; -1: none. Places from which that failed before are not tried again."""
        passed = []
        while at <= self.last[">"] and at not in self.dead:
            passed.append(at)
            stop = self._next_stop(at)
            if stop < 0:
                break
            quote = self.html[stop]
            if quote == ">":
                return stop
            if stop >= self.last[quote]:
                break
            at = self.html.find(quote, stop + 1) + 1
        self.dead.update(passed)
        return -1

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, "/" or "", name, attributes) of what comes next, with an empty name for what is no tag; None: nothing."""
        html, at = self.html, self.html.find("<", at)
        while at >= 0:
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                return at, len(html) if end < 0 else end + 3, "", "", ""
            if m := _NAME.match(html, at + 1):
                end = self._end(m.end())
                if end >= 0:
                    return at, end + 1, m[1], m[2], html[m.end() : end]
            if html[at + 1 : at + 2] in ("!", "?", "/") and (end := html.find(">", at + 2)) >= 0:
                return at, end + 1, "", "", ""
            at = html.find("<", at + 1)
        return None


def parse(html: str) -> Node:
    """A tree of Nodes and texts; `out` marks what surrounds an article. Unclosed and stray tags are mended as browsers do."""
    root, markup = Node("html", None, False), _Markup(html)
    at, here, depth, open_ = root, 0, 0, {"html": 1}

    def leave(to: Node) -> None:
        nonlocal at, depth
        while at is not to:
            open_[at.tag] -= 1
            depth -= 1
            at = at.parent

    def close(tags: set, barrier: frozenset) -> None:
        n = at
        while n is not root and n.tag not in barrier:
            if n.tag in tags:
                leave(n.parent)
                return
            n = n.parent

    while here < len(html):
        found = markup.next(here)
        if not found:
            at.kids.append(html[here:])
            break
        start, end, slash, tag, attributes = found
        if start > here:
            at.kids.append(html[here:start])
        here, tag = end, tag.lower()
        if not tag:
            continue
        if slash:
            if open_.get(tag) and tag != "html":
                n = at
                while n.tag != tag:
                    n = n.parent
                leave(n.parent or root)
            continue
        if tag == "html":
            continue
        if tag == "body" and open_.get("head"):
            close({"head"}, frozenset())
        if tag in BLOCKS and open_.get("p"):
            close({"p"}, SCOPES)
        if tag in CLOSED_BY and any(open_.get(t) for t in CLOSED_BY[tag]):
            close(CLOSED_BY[tag], frozenset(("ul", "ol", "dl", "table", "select", "html")))
        node = Node(tag, at, False)
        node.around = _around(tag, attributes, bool(open_.get("article") or open_.get("main")))
        at.kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, here)
            here = end.end() if end else len(html)
        elif tag not in VOID and not attributes.endswith("/"):
            at, depth = node, depth + 1
            open_[tag] = open_.get(tag, 0) + 1
    _keep_most(root)
    return root


def _nodes(root: Node) -> list[Node]:
    """In page order, parents first; what is marked out is left out."""
    todo, found = [root], []
    while todo:
        n = todo.pop()
        found.append(n)
        todo += [k for k in reversed(n.kids) if isinstance(k, Node) and not k.out]
    return found


def _measure(nodes: list[Node]) -> None:
    for n in reversed(nodes):
        own = sum(len(" ".join(k.split())) for k in n.kids if isinstance(k, str))
        kids = [k for k in n.kids if isinstance(k, Node) and not k.out]
        n.chars = own + sum(k.chars for k in kids)
        n.tags = len(kids) + sum(k.tags for k in kids)
        link = n.tag == "a"
        n.link_chars = n.chars if link else sum(k.link_chars for k in kids)
        n.link_tags = n.tags + 1 if link else sum(k.link_tags for k in kids)
    body = nodes[0]
    share = body.link_chars / max(1, body.chars)
    for n in nodes:
        if n.chars:
            base = log(n.chars / max(1, n.chars - n.link_chars) * n.link_chars + share * n.chars + e)
            ratio = n.chars / max(1, n.link_chars) * max(1, n.tags) / max(1, n.link_tags)
            n.density = n.chars / max(1, n.tags) * log(max(ratio, 1.0)) / max(log(base), 0.1)
    for n in nodes:
        n.sum = sum(k.density for k in n.kids if isinstance(k, Node) and not k.out)


def _menu(n: Node) -> bool:
    return n.tag in ("ul", "ol", "div", "section", "table", "dl") and n.link_chars > LINK_SHARE * n.chars and n.link_tags > 1


def _under(n: Node, tags: tuple) -> Node | None:
    best = None
    while n:
        best, n = (n if n.tag in tags else best), n.parent
    return best


def _declared(root: Node) -> list[Node]:
    """The outermost article and main elements with text, in page order."""
    found, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.tag in ("article", "main") and n.chars:
            found.append(n)
        else:
            todo += [k for k in reversed(n.kids) if isinstance(k, Node) and not k.out]
    return found


def confirmed(root: Node, found: list[Node]) -> list[Node]:
    """The declared articles in which over half of the text found lies, else what was found."""
    declared, chosen, within = _declared(root), set(found), {}
    for d in declared:
        n = d
        while n and n not in chosen:
            n = n.parent
        within[d] = d.chars if n else 0  # all of it lies in what was found
    for f in found:
        outer = _under(f.parent, ("article", "main")) if f.parent else None
        if outer in within:
            within[outer] += f.chars
    held = [d for d in declared if within[d]]
    return held if sum(within[d] for d in held) * 2 > sum(f.chars for f in found) else found


def content(root: Node) -> list[Node]:
    """The subtrees that hold the article, in page order."""
    nodes = _nodes(root)
    _measure(nodes)
    if not nodes[0].chars:
        return []
    top = max(nodes, key=lambda n: n.sum)
    if not top.sum:
        return [nodes[0]]
    threshold, n = top.density, top
    while n.parent and n.tag != "body":
        n = n.parent
        threshold = min(threshold, n.density) if n.density else threshold
    above = set()
    n = top.parent
    while n:
        above.add(n)
        n = n.parent
    found, todo, before = [], [root], True
    while todo:
        n = todo.pop()
        before = before and n is not top
        if n is top or before and n.tag in HEADINGS or n not in above and n.density >= threshold and not _menu(n):
            found.append(n)
        elif n in above:
            todo += [k for k in reversed(n.kids) if isinstance(k, Node) and not k.out]
    return confirmed(root, found)


def text_of(roots: list[Node]) -> str:
    """Blocks in page order, one a line; white space within a block is one space; a line break counts as white space."""
    lines: list[str] = []
    words: list[str] = []

    def flush() -> None:
        if line := " ".join(unescape("".join(words)).split()):
            lines.append(line)
        words.clear()

    for root in roots:
        todo: list = [root]
        while todo:
            n = todo.pop()
            if n is None:
                flush()
            elif isinstance(n, str):
                words.append(n)
            elif not n.out and not (n is not root and _menu(n)):
                if n.tag == "br":
                    words.append(" ")
                elif n.tag in BLOCKS:
                    flush()
                    todo.append(None)
                    todo += reversed(n.kids)
                else:
                    todo += reversed(n.kids)
        flush()
    return "\n".join(lines)


def extract(html: str | None) -> str:
    """The main text of one page; empty for a null, an empty page and one without text. The time grows with the page's length, whatever its markup."""
    return text_of(content(parse(html))) if html else ""


def main_text(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) to (page_id, url, text, n_chars). Every row gives one row, repeated ones and null ids too.

    A null, empty or textless page has an empty text. Other columns, a text or n_chars among them, are left out. An empty table gives an empty one.
    """

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            texts = [extract(h) for h in batch.column(2).to_pylist()]
            yield [batch.column(0), batch.column(1), texts, [len(t) for t in texts]]

        return work

    return map_rows(need(pages, "page_id", "url", "html"), make, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
