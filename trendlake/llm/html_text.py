"""Main text of HTML pages by composite text density.

Every node of the page's tree has a density: its characters per tag, adjusted for the characters
and tags inside links. A node's density sum is the sum of its children's densities. The node with
the largest sum is the centre of the content; the least density on the path from it up to the body
is the threshold, and from the body down every branch at or above the threshold gives its node of
largest sum as content. An ``article`` or ``main`` around the centre is taken whole, otherwise
headings beside the centre's path are added: titles are short, so their own density is low.

Elements that are never content by their kind (menus, scripts, footers, ...) carry no characters.
Forms, and elements with certain words in class, id or role (adverts, notices, comments, ...), carry
none either unless that would take the content itself: see ``_strike``. Character references are decoded; within a block white space becomes one space and is trimmed; blocks are
joined in page order by one line break. A null, empty or wholly excluded page gives the empty text.
Broken markup is read leniently: unclosed elements end with their parent, stray end tags and
unfinished tags are ignored. Pages of any length are read whole, in one pass over a flat list of
nodes (no recursion).
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import without

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg annotation annotation-xml".split())
SKIPPED = RAW | frozenset(
    "head nav footer aside button select option datalist legend label input menu object audio video canvas map".split()
)
MAYBE = frozenset({"form", "fieldset", "dialog"})  # content only where they wrap it
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul br".split()
)
CLOSES_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
# Start tag: open elements it ends, and the elements that search stops at.
IMPLIED = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "tbody": (frozenset({"tbody", "thead", "tfoot"}), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
}
# Formatting inside a line makes no node of its own: its text belongs to the block around it.
INLINE = frozenset(
    "abbr acronym b bdi bdo big br cite code data del dfn em font hr i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt "
    "mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"})
FENCES = frozenset({"table", "td", "th", "caption", "button", "object", "template", "html", "body", "article", "section", "div"})
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE = frozenset(
    "ad ads adv advert advertisement advertising adbox adsense adslot banner breadcrumb breadcrumbs byline-share comment "
    "comments commentlist consent cookie cookies disqus footer gdpr header login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices notification outbrain overlay pager pagination paywall popup promo promoted "
    "promotion related replies reply respond search share sharing sidebar sidebars signup skip social sponsor sponsored "
    "sponsors subscribe subscription taboola toolbar topbar widget widgets discussion alert".split()
)
# Words for text that readers or the site's lawyers wrote: they name what a block holds, not how it is laid out.
REPLIES = frozenset("comment comments commentlist disqus replies reply respond discussion cookie cookies consent gdpr".split())
TITLED = frozenset("entry post article story news page content section main".split())  # whose header is the title
KEPT_KINDS = frozenset({"article", "main", "body", "html"})
MOST, SMALL, LITTLE = 0.5, 0.05, 50  # shares of the characters outside links; characters
START = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
BALANCED = re.compile("(?:[^\"']++|\"[^\"]*+\"|'[^']*+')*+")
MARK = re.compile("[>\"']")
UNFINISHED = re.compile(r"<(?:/?[a-zA-Z]|!)[^>]*\Z")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
GAPS = re.compile(r"\s+")


def _is_noise(tag: str, attributes: str) -> bool:
    """Never content: by its kind or because it is not shown."""
    if tag in SKIPPED:
        return True
    if tag in KEPT_KINDS or not attributes:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def _doubt(tag: str, attributes: str, in_article: bool) -> tuple[frozenset[str] | None, bool]:
    """What speaks against an element (words, role, kind), None if nothing; and whether it is the header of a text."""
    if tag in KEPT_KINDS:
        return None, False
    found, titled = set(), in_article and tag == "header"
    if tag in MAYBE:
        found.add(f"<{tag}>")
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "role" and (role := value.strip("\"'").lower()) in ROLES:
            found.add(f"role {role}")
        if name in ("class", "id"):
            parts = {p.lower() for p in PART.findall(value)}
            words = parts & NOISE
            if (tag == "header" or "header" in words) and (in_article or not TITLED.isdisjoint(parts)):
                words.discard("header")
                titled = True
            found |= words
    if tag == "header" and not titled:
        found.add("<header>")
    return frozenset(found) or None, titled


class _Tokens:
    """Comments, declarations and tags of a page. What has no end is remembered, so that all of them are found in a few
    passes over the page, whatever is left open in it."""

    def __init__(self, page: str):
        self.page, self.last, self.last_data = page, page.rfind(">"), page.rfind("]]>")
        self.endless: set[int] = set()  # quotes that lead to no end of a tag

    def _tag_end(self, at: int) -> int:
        """The next ``>`` outside quotes; where the quotes leave none, the next one."""
        page, nearest = self.page, self.page.find(">", at)
        if BALANCED.match(page, at, nearest).end() == nearest:
            return nearest
        opened, place = [], at
        while found := MARK.search(page, place):
            if found[0] == ">":
                return found.start()
            if found.start() in self.endless:
                break
            opened.append(found.start())
            place = page.find(found[0], found.end()) + 1
            if not place:
                break
        self.endless.update(opened)
        return nearest

    def after(self, at: int) -> tuple[int, int, str | None, str, str] | None:
        """(start, end, tag, ``/`` of an end tag, attributes or character data) of the next one; no tag but for tags."""
        page, found = self.page, START.search(self.page, at)
        if not found:
            return None
        start = found.start()
        if start > self.last:  # only a comment may go without an end
            start = page.find("<!--", start)
            return None if start < 0 else (start, len(page), None, "", "")
        if found[0] == "<!--":
            end = page.find("-->", found.end())
            return start, len(page) if end < 0 else end + 3, None, "", ""
        if found[2] is not None:
            end = self._tag_end(found.end())
            return start, end + 1, found[2].lower(), found[1], page[found.end() : end]
        if found[0] == "<![CDATA[" and found.end() <= self.last_data:
            end = page.find("]]>", found.end())
            return start, end + 3, None, "", page[found.end() : end]
        return start, page.find(">", start) + 1, None, "", ""


class _Tree:
    """Nodes in page order: tag, parent, noise, doubt; and the pieces of text with the node they stand in."""

    def __init__(self, page: str):
        self.tag, self.parent, self.noise, self.in_article = ["html"], [-1], [False], [False]
        self.doubt: list[frozenset[str] | None] = [None]
        self.titled = [False]
        self.still_open: Counter[str] = Counter()
        self.pieces: list[tuple[int, str | None]] = []  # None: a block begins or ends here
        self.body = 0
        self._read(page)

    def _open(self, stack: list[int], tag: str, attributes: str) -> int:
        here = stack[-1]
        if tag in CLOSES_P:
            self._end(stack, frozenset({"p"}), FENCES)
        if tag in IMPLIED:
            self._end(stack, *IMPLIED[tag])
        here = stack[-1]
        in_article = self.in_article[here]
        self.in_article.append(in_article or tag in ("article", "main"))
        self.tag.append(tag)
        self.parent.append(here)
        self.noise.append(self.noise[here] or _is_noise(tag, attributes))
        doubt, titled = _doubt(tag, attributes, in_article)
        self.doubt.append(doubt)
        self.titled.append(titled)
        node = len(self.tag) - 1
        if tag == "body":
            self.body = node
        return node

    def _end(self, stack: list[int], tags: frozenset, fences: frozenset) -> None:
        if not any(self.still_open[t] for t in tags):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if self.tag[stack[depth]] in tags:
                if not BLOCK.isdisjoint(self.tag[n] for n in stack[depth:]):
                    self.pieces.append((stack[depth], None))
                self.still_open.subtract(self.tag[n] for n in stack[depth:])
                del stack[depth:]
                return
            if self.tag[stack[depth]] in fences:
                return

    def _read(self, page: str) -> None:
        stack, at, size, tokens = [0], 0, len(page), _Tokens(page)
        while at < size:
            found = tokens.after(at)
            stop = found[0] if found else size
            if stop > at:
                text = page[at:stop] if found else UNFINISHED.sub("", page[at:])
                if text:
                    self.pieces.append((stack[-1], text))
            if not found:
                return
            _, at, tag, closing, attributes = found
            if tag is None:
                if attributes:
                    self.pieces.append((stack[-1], html.escape(attributes)))
                continue
            if tag in INLINE and not (attributes and not closing and (_is_noise(tag, attributes) or _doubt(tag, attributes, True)[0])):
                if tag in BLOCK:
                    self.pieces.append((stack[-1], None))
                if closing and self.tag[stack[-1]] == tag:
                    self.still_open[tag] -= 1
                    stack.pop()
                continue
            if tag in ("html", "body") and (closing or tag == "html" or self.body):
                continue
            if closing:
                self._end(stack, frozenset({tag}), frozenset())
                continue
            if tag == "body":
                self._end(stack, frozenset({"head"}), frozenset())
            node = self._open(stack, tag, attributes)
            if tag in BLOCK:
                self.pieces.append((node, None))
            if tag in VOID or attributes.endswith("/"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
                at = page.find(">", end.start()) + 1 or size if end else size
                continue
            stack.append(node)
            self.still_open[tag] += 1


def _density(chars: int, tags: int, link_chars: int, link_tags: int, whole_chars: int, whole_links: int) -> float:
    """Characters per tag, scaled down by the share of link characters and tags."""
    if not chars:
        return 0.0
    tags, link_tags = max(tags, 1), max(link_tags, 1)
    base = math.log(chars * link_chars / max(chars - link_chars, 1) + whole_links * chars / max(whole_chars, 1) + math.e)
    inside = chars * tags / (max(link_chars, 1) * link_tags)
    return chars / tags * math.log(max(inside, 1.0)) / math.log(max(base, 1.0001)) if base > 1 else chars / tags * math.log(max(inside, 1.0) + 1)


def _strike(tree: _Tree, children: list[list[int]]) -> None:
    """Makes noise of the doubtful nodes that do not wrap the content.

    Doubtful nodes are judged from the outside in, those with the same words within one article (or the
    body) together. They stay if they hold most of its characters outside links; with words of replies
    and notices only if next to nothing else is left. Outside the articles they go if an article or main
    element is kept, and stay if they hold the page's only one.
    """
    n, body = len(tree.tag), tree.body
    chars, links, articles = [0] * n, [0] * n, [0] * n
    scope, in_link = [body] * n, [False] * n
    for node in range(1, n):
        above = tree.parent[node]
        in_link[node] = tree.tag[node] == "a" or in_link[above]
        kept_kind = tree.tag[node] in ("article", "main")
        scope[node] = above if tree.tag[above] in ("article", "main") else scope[above]
        articles[node] = int(kept_kind and not tree.in_article[above] and not tree.noise[node])
    for node, text in tree.pieces:
        if text and not tree.noise[node] and (size := len(GAPS.sub(" ", text).strip())):
            chars[node] += size
            links[node] += size * in_link[node]
    for node in range(n - 1, 0, -1):
        above = tree.parent[node]
        for sums in (chars, links, articles):
            sums[above] += sums[node]
    plain = [c - k for c, k in zip(chars, links)] if chars[0] > links[0] else chars
    kept, todo = 0, [0]
    while todo:
        groups: dict[tuple[int, frozenset[str]], list[int]] = {}
        while todo:
            for node in children[todo.pop()]:
                if tree.noise[node]:
                    continue
                if tree.doubt[node]:
                    groups.setdefault((scope[node], tree.doubt[node]), []).append(node)
                    continue
                if tree.tag[node] in ("article", "main"):
                    kept = max(kept, plain[node])
                todo.append(node)
        for (around, words), nodes in groups.items():
            share, whole = sum(plain[k] for k in nodes), plain[around]
            outside = tree.tag[around] not in ("article", "main")
            stays = share > MOST * whole and (words.isdisjoint(REPLIES) or whole - share < LITTLE)
            if outside and kept and kept >= SMALL * whole:
                stays = False
            for node in nodes:
                wraps = outside and not kept and articles[node] == articles[body] == 1 and plain[node] >= SMALL * whole
                if stays or (wraps and words.isdisjoint(REPLIES)):
                    todo.append(node)
                else:
                    tree.noise[node] = True
    for node in range(1, n):
        tree.noise[node] = tree.noise[node] or tree.noise[tree.parent[node]]


def _content(tree: _Tree) -> list[bool]:
    """For each node whether it is inside the selected content."""
    n = len(tree.tag)
    children: list[list[int]] = [[] for _ in range(n)]
    for node in range(1, n):
        children[tree.parent[node]].append(node)
    if any(tree.doubt):
        _strike(tree, children)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for node in range(1, n):
        in_link[node] = tree.tag[node] == "a" or in_link[tree.parent[node]]
    for node, text in tree.pieces:
        if text and not tree.noise[node] and (size := len(GAPS.sub(" ", text).strip())):
            chars[node] += size
            link_chars[node] += size * in_link[node]
    for node in range(n - 1, 0, -1):
        above = tree.parent[node]
        chars[above] += chars[node]
        link_chars[above] += link_chars[node]
        tags[above] += tags[node] + 1
        link_tags[above] += link_tags[node] + (tree.tag[node] == "a")
    body = tree.body
    whole = (chars[body], link_chars[body])
    density = [0.0 if tree.noise[k] else _density(chars[k], tags[k], link_chars[k], link_tags[k], *whole) for k in range(n)]
    sums = [0.0] * n
    for node in range(1, n):
        sums[tree.parent[node]] += density[node]
    for node in range(n):
        if not sums[node] and chars[node] and not tree.noise[node]:
            sums[node] = density[node]  # a leaf stands for itself
    first = list(range(n))  # of each subtree, its node of largest sum
    for node in range(n - 1, 0, -1):
        above = tree.parent[node]
        if sums[first[node]] > sums[first[above]]:
            first[above] = first[node]
    centre = first[body]
    threshold, node = density[centre], centre
    while node not in (body, -1):
        node = tree.parent[node]
        threshold = min(threshold, density[node]) if node >= 0 else threshold
    chosen = [False] * n
    path = _above(tree, centre)
    todo = [body]
    while todo:
        node = todo.pop()
        if tree.noise[node] or not chars[node] or density[node] < threshold:
            continue
        if node == body or (first[node] != node and node in path):
            if first[node] == node:
                chosen[node] = True
            else:
                todo.extend(children[node])
        else:
            chosen[first[node] if sums[first[node]] > sums[node] else node] = True
    _complete(tree, centre, children, chosen)
    for node in range(1, n):
        chosen[node] = (chosen[node] or chosen[tree.parent[node]]) and not tree.noise[node]
    return chosen


def _complete(tree: _Tree, centre: int, children: list[list[int]], chosen: list[bool]) -> None:
    """An article element around the centre is content as a whole; else the headings and headers beside its path are."""
    path = sorted(_above(tree, centre), reverse=True)
    for node in path:
        if tree.tag[node] in ("article", "main"):
            chosen[node] = True
            return
    for node in path:
        if node == tree.body:
            return
        for beside in children[tree.parent[node]] if node else ():
            if tree.tag[beside] in HEADINGS or tree.titled[beside]:
                chosen[beside] = True


def _above(tree: _Tree, node: int) -> set[int]:
    found = set()
    while node >= 0:
        found.add(node)
        node = tree.parent[node]
    return found


def main_text(page: str | None) -> str:
    if not page:
        return ""
    tree = _Tree(page)
    chosen = _content(tree)
    blocks, parts = [], []
    for node, text in tree.pieces:
        if text is None:
            blocks.append("".join(parts))
            parts = []
        elif chosen[node]:
            parts.append(html.unescape(text))
    blocks.append("".join(parts))
    tidy = (GAPS.sub(" ", b).strip() for b in blocks if b)
    return "\n".join(b for b in tidy if b)


def extract_text(df: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of every whole page. A column of that name is replaced."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    found = extracted(F.col(f"`{page}`"))
    kept = [f"`{c}`" for c in without(df, out).columns]
    return df.select(*kept, found.alias(out))
