"""Main text of web pages by tree scoring.

A page becomes a tree of elements; tags left open are closed as browsers close
them.  Every paragraph gives points for its length and commas to its ancestors, the
full points to its parent, half to the next and a third, a quarter ... above;
an element's points are discounted by its link density and weighed by what its
name, class and id say.  The best container is kept, with the whole article it
lies in and those siblings that score near it or read like text.  Parts that no article contains (menus,
headers, footers, asides, forms, scripts, notices, adverts, comments of
readers ...) are left out wherever they stand.

Text comes out as blocks in page order: character references decoded, white
space made one space, blocks joined by an empty line.

Defined cases: null or empty html, and pages without text, give an empty text;
repeated rows each give their text; containers of equal score: the first in
page order; very long and deeply nested pages take time in proportion to their
length; other columns of the table, whatever their names, are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fixed values: elements by kind
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
LEFT_OUT = frozenset("script style noscript template head title nav header footer aside form button select option textarea input label fieldset iframe object embed "
                     "applet svg canvas audio video dialog menu noframes noembed".split())
BLOCK = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre address figure "
                  "center details summary hgroup hr header footer nav aside form fieldset".split())
#: an opening tag of the key closes an open paragraph or an open one of these
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table div article section main body td th blockquote".split())
LISTS = ("ul", "ol", "dl", "table")
CLOSED_BY = {name: ("p", *CLOSES.get(name, ())) for name in BLOCK}
SCOPES = {name: tuple(SCOPE - {name}) for name in BLOCK}
RAW_END = {name: regex.compile(f"</{name}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", regex.I) for name in RAW}
#: ancestors that a paragraph gives points to
REACH = 32
#: what names say; whole words of class, id and role
AGAINST = regex.compile(r"(?<![a-z])(ad|ads|advert\w*|adsense|adbox|banner\w*|sponsor\w*|promo\w*|promotion\w*|outbrain|taboola|comment\w*|disqus|respond|replies|reply|discussion|"
                        r"cookie\w*|consent|gdpr|notice\w*|alert|newsletter|subscribe|subscription|signup|login|paywall|popup|pop-up|modal|overlay|"
                        r"nav\w*|menu\w*|breadcrumb\w*|sidebar\w*|side-bar|rail|widget\w*|footer\w*|foot|header|masthead|topbar|toolbar|pagination|pager|paging|"
                        r"share\w*|sharing|social\w*|related\w*|recommend\w*|recirc|trending|popular|tags?|tagcloud|skip\w*|hidden|copyright|search\w*|"
                        r"complementary|contentinfo|navigation|form)(?![a-z])")
#: names of elements whose header holds the headline
STORY = regex.compile(r"(?<![a-z])(article\w*|entry\w*|hentry|post\w*|story\w*)(?![a-z])")
FOR = regex.compile(r"(?<![a-z])(article\w*|body|content|entry\w*|hentry|main|page|post\w*|text|story\w*|blog|prose)(?![a-z])")
#: a name that says both keeps its element unless it is plainly one of these
NEVER = regex.compile(r"(?<![a-z])(ad|ads|advert\w*|sponsor\w*|comment\w*|disqus|cookie\w*|consent|gdpr|sidebar\w*|newsletter|nav\w*|menu\w*|breadcrumb\w*|footer\w*|related\w*|share\w*|social\w*|notice\w*)(?![a-z])")
MARKUP = regex.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", regex.S)
ATTRIBUTE = regex.compile(r"""([^\s=/>"']+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
BLANK = regex.compile(r"\s+")
WEIGHTS = {"article": 30.0, "main": 25.0, "section": 3.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "form": -3.0}


class Node:
    __slots__ = ("name", "parent", "children", "hint", "points", "chars", "linked", "out", "story")

    def __init__(self, name: str, parent: Node | None, hint: str = "", out: bool = False):
        self.name, self.parent, self.hint, self.out = name, parent, hint, out
        #: it is, or lies in, what holds a story
        self.story = parent is not None and parent.story or name in ("article", "main") or bool(hint) and bool(STORY.search(hint))
        self.children: list[Node | str] = []
        self.points = 0.0
        self.chars = self.linked = 0


def _attributes(rest: str) -> tuple[str, bool]:
    """Class, id and role as one lower-case string; whether the element is hidden."""
    if not rest or "=" not in rest and "hidden" not in rest:
        return "", False
    words, hidden = [], False
    for m in ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name in ("class", "id", "role"):
            words.append(value.replace("_", " "))
        hidden |= name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "")
    return " ".join(words), hidden


def _excluded(name: str, hint: str, inside_article: bool) -> bool:
    if name in LEFT_OUT:
        # an article's own header holds its headline
        return not (name == "header" and inside_article)
    if not hint or name in ("html", "body"):
        return False
    if NEVER.search(hint) and name not in ("article", "main"):
        return True
    return bool(AGAINST.search(hint)) and not FOR.search(hint)


class _Open:
    """The open elements, outermost first, with the places of each name: what a
    tag closes is found without walking up, however deep the page nests."""

    def __init__(self, root: Node):
        self.nodes, self.places, self.blocks = [root], {}, []

    def last(self, names) -> int:
        """Place of the innermost open element of these names; 0, the root's, if none is open."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def first_after(self, names, place: int) -> int:
        """Place of the outermost open element of these names inside ``place``; 0 if there is none."""
        found = ((at, bisect_right(at, place)) for n in names if (at := self.places.get(n)))
        return min((at[i] for at, i in found if i < len(at)), default=0)

    def push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.nodes))
        if node.name in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        """Close the element at ``place`` and all inside it; the root stays."""
        while place and len(self.nodes) > place:
            node = self.nodes.pop()
            self.places[node.name].pop()
            if node.name in BLOCK:
                self.blocks.pop()


def parse(html: str) -> Node:
    """Tree of elements and text; excluded parts are marked ``out``."""
    root = Node("html", None)
    still = _Open(root)
    at, size = 0, len(html)
    while at < size:
        m = MARKUP.search(html, at)
        text = html[at:m.start() if m else size]
        if text:
            still.nodes[-1].children.append(text)
        if not m:
            break
        at = m.end()
        if m[1] is not None:
            still.nodes[-1].children.append(m[1].replace("&", "&amp;"))
        name = (m[3] or "").lower()
        if not name or name in ("html", "body") and not m[2]:
            continue
        if m[2]:
            place = still.last((name,))
            # a stray end tag of inline markup does not close a block
            if name in BLOCK or not still.blocks or still.blocks[-1] < place:
                still.close(place)
            continue
        if name in BLOCK:
            place = still.last(CLOSED_BY[name])
            if place > still.last(SCOPES[name]):
                still.close(place)
            if name in CLOSES:
                still.close(still.first_after(CLOSES[name], still.last(LISTS)))
        top = still.nodes[-1]
        hint, hidden = _attributes(m[4])
        node = Node(name, top, hint, top.out or hidden or _excluded(name, hint, top.story))
        top.children.append(node)
        if name in RAW and not m[4].endswith("/"):
            end = RAW_END[name].search(html, at)
            node.children.append(html[at:end.start() if end else size])
            at = end.end() if end else size
        elif name not in VOID and not m[4].endswith("/"):
            still.push(node)
    return root


def _measure(node: Node, linked: bool) -> None:
    """Characters and linked characters of each element, and points from its paragraphs; children come after their parents in ``order``."""
    order, stack = [], [(node, linked)]
    while stack:
        node, linked = stack.pop()
        if node.out:
            continue
        linked |= node.name == "a"
        order.append(node)
        for c in node.children:
            if isinstance(c, str):
                n = len(c.strip())
                node.chars += n
                node.linked += n if linked else 0
            else:
                stack.append((c, linked))
    for node in reversed(order):
        if node.parent:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    for node in order:
        text = sum(len(c) for c in node.children if isinstance(c, str))
        own = node.name in ("p", "pre", "td", "blockquote", "li", "dd") or node.name not in ("a", "b", "i", "em", "strong", "span") and text >= 25
        if own and node.chars >= 25 and node.parent:
            commas = sum(c.count(",") for c in node.children if isinstance(c, str))
            points = (1 + commas + min(node.chars / 100, 3)) * (1 - node.linked / node.chars)
            place, share = node if node.name == "div" else node.parent, 1
            while place and share <= REACH:
                place.points += points / share
                place, share = place.parent, share + 1


def _score(node: Node) -> float:
    if node.out or not node.chars:
        return 0.0
    weight = WEIGHTS.get(node.name, 0.0) + (25.0 if FOR.search(node.hint) else 0.0) - (25.0 if AGAINST.search(node.hint) else 0.0)
    return (node.points + (weight if node.points else 0.0)) * (1 - node.linked / node.chars)


def _home(best: Node) -> Node:
    """The element that holds the whole story of the best container: the nearest
    ``article``, else the nearest ``main``, else the outermost one named as a
    story; the container itself if there is none.  Beside the way down to the
    container, parts of a ``main`` or named element that are mostly links are left out."""
    above, node = [], best
    while node.parent:
        above.append(node)
        node = node.parent
    home = next((n for n in above if n.name == "article"), None)
    if home:
        return home
    named = [n for n in above if bool(n.hint) and STORY.search(n.hint)]
    home = next((n for n in above if n.name == "main"), named[-1] if named else best)
    below = best
    while below is not home:
        for c in below.parent.children:
            if isinstance(c, Node) and c is not below and c.chars and c.linked > 0.5 * c.chars:
                c.out = True
        below = below.parent
    return home


def best_parts(root: Node) -> list[Node]:
    """The story around the best container and the siblings that belong to it, in page order."""
    _measure(root, False)
    best, most, stack = root, 0.0, [root]
    while stack:
        node = stack.pop()
        if node.out:
            continue
        if node.name not in ("p", "html") and (score := _score(node)) > most:
            best, most = node, score
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    best = _home(best)
    if best.parent is None:
        return [best]
    most, parts = max(most, _score(best)), []
    for c in best.parent.children:
        if not isinstance(c, Node) or c.out:
            continue
        density = c.linked / c.chars if c.chars else 1.0
        if c is best or c.name == best.name and _score(c) >= 0.2 * most or c.name == "p" and c.chars >= 80 and density < 0.25 or c.name in ("h1", "h2") and c.chars and density < 0.25:
            parts.append(c)
    return parts


def blocks(parts: list[Node]) -> list[str]:
    """Texts of the blocks below the parts."""
    found: list[str] = []
    run: list[str] = []

    def close() -> None:
        if text := BLANK.sub(" ", unescape("".join(run))).strip():
            found.append(text)
        run.clear()

    for part in parts:
        close()
        stack: list = [part]
        while stack:
            c = stack.pop()
            if c is None:
                close()
            elif isinstance(c, str):
                run.append(c)
            elif not c.out:
                if c.name in BLOCK:
                    close()
                    stack.append(None)
                elif c.name == "br":
                    run.append(" ")
                stack.extend(reversed(c.children))
    close()
    return found


def main_text(html: str | None) -> str:
    return "\n\n".join(blocks(best_parts(parse(html)))) if html else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["row", "text", "n_chars"])


def extract(pages: DataFrame, html: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """Per page: key, url, text, n_chars."""
    rows = pages.select(F.struct(F.col(key).alias("key"), F.col(url).alias("url")).alias("row"), F.col(html).cast("string").alias("html"))
    kind = rows.schema["row"].dataType.simpleString()
    made = rows.mapInArrow(_extract, f"row {kind}, text string, n_chars long")
    return made.select(F.col("row.key").alias(key), F.col("row.url").alias(url), "text", "n_chars")
