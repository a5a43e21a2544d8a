"""Main text of web pages by tree scoring.

A page becomes a tree; menus, page headers, footers, forms, scripts, styles and what is hidden are cut out by element, attribute and role. Each block of text passes points for its
length and commas to its ancestors, less with each step up. A container's points are discounted by the share of its text
that is in links, and points of parts whose class or id is a side part's name (a whole name, like cookie-notice, not a word of a name, like share-enabled) count a tenth. The best container found
so, side parts and reader comments that do not hold it are cut out. The article or main element around the best container is kept whole. Without one, the container grows to its parent as long as
no other part there is mostly links. Beside it headings, parts with few links and parts that score like it are kept, whatever the length of the page.
A form that holds an article, main or h1 element or most of the page's text is a plain wrapper.

Scale: one page at a time inside its partition, no shuffle. The work is linear in the length of the page.

Edge cases: null or empty html, and a page without text, give the empty text. Markup that is cut off, unclosed, wrongly nested or
no markup at all is read as far as it goes, and malformed declarations are comments. Repeated rows give a row each. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import small_batches

#: Fixed values of HTML: elements without content, elements that make a block, elements inside a line.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead"
    " title tr ul caption".split()
)
#: Elements that are never main text.
DROPPED = set("head title script style noscript template iframe object embed svg canvas audio video nav footer aside form button select textarea input option datalist dialog menu label".split())
#: Elements that a new one of the named kind closes.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

#: Words of class and id names of side parts, of reader comments, and words that may stand beside them without changing what is named.
SIDE = set(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice notification alert popup modal overlay newsletter"
    " subscribe signup login nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar side aside widget footer foot masthead topbar siteheader pageheader toolbar share sharing social"
    " related recommended recommendations trending popular outbrain taboola copyright legal disclaimer skip hidden search".split()
)
ANSWERS = set("comment comments commentlist commentsection discussion disqus respond responses replies reply".split())
PLAIN = set(
    "area bar block box bottom btn button buttons col column columns container content count field footer form global group header holder icon icons inner item items left link links list main menu meta"
    " mini mobile nav outer page panel pane post posts primary right row secondary section site slot small sticky sub text thread title top unit user widgets wrap wrapper zone".split()
)
_GOOD = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text|blog|hentry)(?:$|[\s_-])", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HUMP = re.compile("([a-z])([A-Z])")
_PARTS = re.compile(r"[_-]+|(?<=[a-z])(?=[0-9])")
#: What a wrapper has or lacks is no name of the wrapper itself.
_ABOUT = ("has-", "has_", "no-", "with-", "without-", "is-")
_BAD_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
#: What the points of a part with a side part's name count.
SIDE_WEIGHT = 0.1


def _names(attrs: dict[str, str | None]) -> str:
    found = " ".join(filter(None, (attrs.get("class"), attrs.get("id"))))
    return " ".join(t for t in _HUMP.sub(r"\1-\2", found).split() if not t.lower().startswith(_ABOUT)) if found else ""


def _says(names: str, words: set[str]) -> bool:
    """Whether a whole name is made of these words, of which it has one at least, and of words that add nothing."""
    for name in names.lower().split():
        parts = [x for x in _PARTS.split(name) if x and not x.isdigit()]
        if any(x in words for x in parts) and all(x in words or x in PLAIN for x in parts):
            return True
    return False


class Node:
    """holder: the nearest block above. dropped: not main text. side: named like a side part, which weighs its points and cuts it in the end."""

    __slots__ = ("tag", "parent", "holder", "children", "dropped", "side", "form", "bonus", "points", "length", "linked")

    def __init__(self, tag: str, parent: Node | None, attrs: dict[str, str | None] | None = None, in_article: bool = False):
        self.tag, self.parent, self.children, self.points = tag, parent, [], 0.0
        self.holder = parent if parent is None or parent.tag in BLOCK else parent.holder
        attrs = attrs or {}
        named = _names(attrs)
        article = tag in ("article", "main")
        good = bool(named and _GOOD.search(named))
        self.bonus = 25.0 * article + 15.0 * good
        self.form = tag == "form"
        self.dropped = tag in DROPPED and not self.form or tag == "header" and not in_article
        self.side = False
        if attrs and tag not in ("html", "body") and not self.dropped:
            self.dropped = "hidden" in attrs or (attrs.get("role") or "").lower() in _BAD_ROLE - {tag} or (attrs.get("aria-hidden") or "").lower() == "true" or bool(_UNSEEN.search(attrs.get("style") or ""))
            self.side = bool(named) and tag != "main" and (_says(named, ANSWERS) or _says(named, SIDE) and not (article and good))
        self.form = self.form and not self.dropped  # dropped as a form only, unless it turns out to be a wrapper
        self.dropped = self.dropped or self.form

    def above(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


class _Builder(HTMLParser):
    """Open elements are a path from the root; depths of each kind are kept, so that an element to close is found without a walk."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None)
        self.path = [self.root]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag in BLOCK:
            self._close({"p"}, None)
        if tag in CLOSED_BY:
            self._close(CLOSED_BY[tag], LIMITS[tag])
        node = Node(tag, self.path[-1], dict(attrs), self._depth({"article", "main"}) > 0)
        self.path[-1].children.append(node)
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.path))
            if tag in BLOCK:
                self.blocks.append(len(self.path))
            self.path.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID and tag not in ("html", "body"):
            self._close({tag}, set() if tag in BLOCK else None)

    def parse_marked_section(self, i: int, report: bool = True) -> int:
        return self.parse_bogus_comment(i)

    def _depth(self, tags: set[str]) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def _close(self, tags: set[str], limits: set[str] | None) -> None:
        """Closes the nearest open element of these tags, unless one of limits (None: a block) is nearer."""
        at = self._depth(tags)
        near = (self.blocks[-1] if self.blocks else 0) if limits is None else self._depth(limits)
        if at and at >= near:
            while len(self.path) > at:
                tag = self.path.pop().tag
                self.depths[tag].pop()
                if tag in BLOCK:
                    self.blocks.pop()

    def handle_data(self, data: str) -> None:
        self.path[-1].children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _walk(root: Node) -> list[Node]:
    """Kept elements, each after its ancestors."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.dropped:
            out.append(node)
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def block_points(text: str) -> float:
    return 1 + text.count(",") + min(len(text) / 100, 3)


def _score(root: Node) -> list[Node]:
    nodes = _walk(root)
    for node in reversed(nodes):
        own = "".join(c for c in node.children if isinstance(c, str))
        kept = [c for c in node.children if isinstance(c, Node) and not c.dropped]
        node.length = len(own.strip()) + sum(c.length for c in kept)
        node.linked = node.length if node.tag == "a" else sum(c.linked for c in kept)
    weight: dict[int, float] = {}
    for node in nodes:
        node.points = 0.0
    for node in nodes:
        weight[id(node)] = (weight[id(node.parent)] if node.parent else 1.0) * (SIDE_WEIGHT if node.side else 1.0)
        # A block's own text: what stands in it outside of other blocks.
        text, stack = [], node.children[::-1] if node.tag in BLOCK else []
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                text.append(c)
            elif not c.dropped and c.tag not in BLOCK:
                stack += reversed(c.children)
        joined = " ".join("".join(text).split())
        if not joined:
            continue
        share, points = 1.0, block_points(joined) * weight[id(node)]
        holder = node if node.tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "li", "td") else node.holder
        for step in range(1, 7):
            if holder is None:
                break
            holder.points += points * share
            share = 0.5 if step == 1 else 1 / (3 * step)
            holder = holder.holder
    return nodes


def _value(node: Node) -> float:
    return (node.points + (node.bonus if node.length else 0)) * (1 - node.linked / node.length if node.length else 0)


def _unwrap(root: Node) -> None:
    """Keeps forms that hold an article, main or h1 element or over half of the page's text."""
    nodes = [n for n in _all(root) if not (n.dropped and not n.form)]
    if not any(n.form for n in nodes):
        return
    hold: dict[int, tuple[int, bool]] = {}
    for n in reversed(nodes):
        inner = [hold[id(c)] for c in n.children if isinstance(c, Node) and id(c) in hold]
        own = sum(len(" ".join(c.split())) for c in n.children if isinstance(c, str))
        hold[id(n)] = own + sum(x for x, _ in inner), n.tag in ("article", "main", "h1") or any(y for _, y in inner)
    for n in nodes:
        size, main = hold[id(n)]
        if n.form and size and (main or size > hold[id(root)][0] / 2):
            n.dropped = False


def _texts(nodes: list[Node | str]) -> str:
    out: list[str] = []
    stack: list = list(reversed(nodes))
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.tag == "br":
            out.append(" ")
        elif not c.dropped:
            if c.tag in BLOCK:
                out.append(" ")
                stack.append(" ")
            stack += reversed(c.children)
    return " ".join("".join(out).split())


def extract(html: str | None) -> str:
    """The main text of a page."""
    if not html:
        return ""
    root = parse(html)
    _unwrap(root)
    # Names only weigh the scores that find the best container; then side parts go, but never one that holds it.
    best = max(_containers(root), key=_value, default=None)
    if best is None:
        return ""
    around = {id(best), *map(id, best.above())} if _value(best) > 0 else set()
    cut = [n for n in _all(root) if n.side and not n.dropped and id(n) not in around]
    for node in cut:
        node.dropped = True
    found = _best(root)
    if not found:  # nothing but side parts
        for node in cut:
            node.dropped = False
        found = _best(root)
    return found


def _containers(root: Node) -> list[Node]:
    return [n for n in _score(root) if n.tag in BLOCK and n.tag not in ("p", *HEADINGS, "li", "tr")] or [root]


def _all(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        out.append(stack.pop())
        stack += [c for c in out[-1].children if isinstance(c, Node)]
    return out


HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: A part with a smaller share of its text in links is no menu.
FEW_LINKS = 0.25


def _links(node: Node) -> float:
    return node.linked / node.length


def _whole(best: Node) -> Node:
    """The article or main element around a container, or else the highest ancestor that is reached without a part that is mostly links."""
    for tag in ("article", "main"):
        for a in (best, *best.above()):
            if a.tag == tag:
                return a
    while best.parent is not None and all(_links(c) < FEW_LINKS for c in best.parent.children if isinstance(c, Node) and c is not best and not c.dropped and c.length):
        best = best.parent
    return best


def _best(root: Node) -> str:
    best = max(_containers(root), key=_value)
    if not root.length:
        return ""
    if _value(best) <= 0:
        return _texts([root])
    bound = max(10.0, 0.2 * _value(best))
    best = _whole(best)
    kept = [best]
    if best.parent is not None:
        kept = []
        for c in best.parent.children:
            if c is best or isinstance(c, str) and best.tag != "main":
                kept.append(c)
            elif isinstance(c, Node) and not c.dropped and (c.length or c.tag == "br"):
                few = c.tag == "br" or _links(c) < FEW_LINKS
                if c.tag in HEADINGS or few and best.tag != "main" or c.tag in BLOCK and c.tag != "p" and _value(c) >= bound:
                    kept.append(c)
    return _texts(kept)


def html_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def main_text(html: pd.Series) -> pd.Series:
        return html.map(extract, na_action=None).astype(object) if len(html) else html

    found = pages.select("page_id", "url", main_text(F.coalesce("html", F.lit(""))).alias("text"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
