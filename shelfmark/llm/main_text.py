"""The main text of web pages by tree scoring.

A page is read into a tree. What is no part of an article by its element, role or class
(menus, headers, footers, sidebars, notices, adverts, forms, comments) is put aside.
Each paragraph then passes points, for its length and its commas, to the elements around
it, nearer ones more, less the share of its text that is in links. The element of most
points is the container; it is kept with those of its siblings that belong to it.

Reading is linear in the length of a page, and so is scoring: points go up as sums per
depth, of which each element hands a fixed number on.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfmark.llm.parts import small_batches, texts_of, tidy

# Elements by their meaning in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noscript noframes noembed xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | frozenset("p pre blockquote li td dd dt".split())
# An element that begins where one of these is open ends it, up to the elements that hold it together.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
HOLDS_P = frozenset("table td th caption button object template".split())
ASIDE = frozenset(
    "script style title textarea iframe noscript noframes noembed xmp head nav aside footer form button select input "
    "dialog menu template svg canvas object audio video map".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert status menu menubar form toolbar".split())
# Words of class names and ids.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox adunit banner sponsor sponsored promo promotion "
    "promoted nav navbar navigation navi menu submenu breadcrumb breadcrumbs pagination pager side sidebar sidenav aside rail "
    "footer foot masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
    "subscribe subscription signup login paywall comment comments commentlist respond reply replies disqus discussion "
    "feedback share sharing social related recommended recommendations widget widgets toolbar form search".split())
MAIN_WORDS = frozenset("article articlebody body content main post entry story text page hentry".split())
SHOWS = frozenset("with has no without is not js".split())  # "has-sidebar" is no sidebar

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTES = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
WANTED = frozenset("class id role hidden aria-hidden style".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
# How many elements upwards a paragraph passes points, and the share each gets.
SHARES = (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12)


class Node:
    """An element with its parent and, in order, its texts and elements."""

    __slots__ = ("tag", "parent", "kids", "named", "score", "chars", "linked", "links")

    def __init__(self, tag: str, parent: Node | None, named: dict[str, str]):
        self.tag, self.parent, self.named = tag, parent, named
        self.kids: list[Node | str] = []
        self.score, self.chars, self.linked, self.links = 0.0, 0, 0, 0


def read(html: str) -> Node:
    """The tree of a page; whatever it holds, there is one. Tags and comments that never end take the rest along."""
    root = node = Node("#page", None, {})
    open_tags: dict[str, int] = {}
    at, size = 0, len(html)

    def leave(to: Node) -> Node:
        nonlocal node
        while node is not to:
            open_tags[node.tag] -= 1
            node = node.parent
        open_tags[node.tag] -= 1
        return node.parent

    def ended(tags, holders) -> Node | None:
        if not any(open_tags.get(t) for t in tags):
            return None
        up = node
        while up is not root and up.tag not in holders:
            if up.tag in tags:
                return up
            up = up.parent
        return None

    while at < size:
        tag_at = html.find("<", at)
        if tag_at < 0:
            node.kids.append(unescape(html[at:]))
            break
        if tag_at > at:
            node.kids.append(unescape(html[at:tag_at]))
        name = NAME.match(html, tag_at)
        if name is None:
            if html.startswith("<!--", tag_at):
                end = html.find("-->", tag_at + 2)
                at = size if end < 0 else end + 3
            elif html.startswith(("<!", "<?", "</"), tag_at):
                end = html.find(">", tag_at)
                at = size if end < 0 else end + 1
            else:
                node.kids.append("<")
                at = tag_at + 1
            continue
        closing, tag = name[1], name[2].lower()
        rest = ATTRIBUTES.match(html, name.end())
        end = rest.end() if rest else html.find(">", name.end()) + 1
        if not end:
            break
        inside, at = html[name.end():end - 1], end
        if closing:
            stop = HOLDS_P if tag in INLINE else ()
            if tag in INLINE and node.tag != tag:
                # A closed inline element does not close the blocks in it.
                up = node
                while up is not root and up.tag in INLINE and up.tag != tag:
                    up = up.parent
                if up.tag == tag:
                    node = leave(up)
            elif tag not in ("body", "html") and (up := ended({tag}, stop)) is not None:
                node = leave(up)
            continue
        if tag in ENDS and (up := ended(*ENDS[tag])) is not None:
            node = leave(up)
        elif tag not in INLINE and tag not in RAW and tag not in VOID | {"option"} or tag == "hr":
            if (up := ended({"p"}, HOLDS_P)) is not None:
                node = leave(up)
        named = {}
        for m in ATTRIBUTE.finditer(inside):
            if (key := m[1].lower()) in WANTED:
                named.setdefault(key, unescape(m[2] or m[3] or m[4] or ""))
        made = Node(tag, node, named)
        node.kids.append(made)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            stop_at = html.find(">", close.start()) if close else -1
            at = size if stop_at < 0 else stop_at + 1
        elif tag not in VOID:
            node = made
            open_tags[tag] = open_tags.get(tag, 0) + 1
    return root


def _words(name: str) -> list[str]:
    return [w.lower() for w in WORD.findall(name)]


def put_aside(node: Node) -> bool:
    """Whether an element is no part of an article, by its kind, its role, its names or because it is hidden."""
    if node.tag in ASIDE:
        return True
    if node.tag in ("#page", "html", "body", "main"):
        return False
    named = node.named
    if not named:
        return False
    style = named.get("style", "").replace(" ", "").lower()
    if "hidden" in named or named.get("aria-hidden", "").lower() == "true" or "display:none" in style:
        return True
    if named.get("role", "").lower() in ASIDE_ROLES:
        return True
    names = [w for part in ("class", "id") for n in named.get(part, "").split() if (w := _words(n))]
    if any(all(w in MAIN_WORDS for w in words) for words in names):
        return False
    return any(w[0] not in SHOWS and (w[0] in ASIDE_WORDS or w[-1] in ASIDE_WORDS) for w in names)


def is_header(node: Node) -> bool:
    """A header, of which only headings are text, and those within the container alone."""
    if node.tag == "header":
        return True
    if node.tag in HEADINGS or node.tag in ("#page", "html", "body", "main", "article"):
        return False
    names = [w for part in ("class", "id") for n in node.named.get(part, "").split() if (w := _words(n))]
    return any(w[-1] == "header" and w[0] not in SHOWS for w in names)


def _points(text: str, tag: str) -> float:
    length = len(text)
    points = 1 + text.count(",") + text.count("、") + text.count("，") + min(length / 100, 3.0)
    return points * (0.25 if tag in HEADINGS else 1.0)


def score(root: Node) -> list[Node]:
    """Give every element that is not put aside its points, characters and share of links; the elements, parents first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        if is_header(node):
            continue
        stack.extend(kid for kid in reversed(node.kids) if type(kid) is Node and not put_aside(kid))
    carried: dict[int, list[float]] = {}
    for node in reversed(order):
        for kid in node.kids:
            if type(kid) is str:
                node.chars += len(" ".join(kid.split()))
            else:
                node.chars += kid.chars
                node.linked += kid.linked
                node.links += kid.links
        if node.tag == "a":
            node.linked, node.links = node.chars, 1
        up = carried.pop(id(node), [0.0] * len(SHARES))
        if node.tag in INLINE:
            # Blocks in an inline element count as if it were not there.
            if any(up):
                above = carried.setdefault(id(node.parent), [0.0] * len(SHARES))
                above[:] = [x + y for x, y in zip(above, up, strict=True)]
            continue
        text = " ".join("".join(k if type(k) is str else _inline(k) for k in node.kids if type(k) is str or k.tag in INLINE).split())
        density = min(1.0, node.linked / node.chars) if node.chars else 0.0
        here = _points(text, node.tag) if text else 0.0
        node.score = sum(s * u for s, u in zip(SHARES, up, strict=True)) * (1 - density)
        if node.tag not in PARAGRAPHS:
            # Bare text of a container counts for it as a paragraph of it would.
            node.score += here * (1 - density)
        if node.parent is not None:
            above = carried.setdefault(id(node.parent), [0.0] * len(SHARES))
            above[0] += here * (1 - density)
            for i in range(1, len(SHARES)):
                above[i] += up[i - 1]
    return order


def _inline(node: Node) -> str:
    """The text of an inline element, without that of blocks in it and of what is set aside."""
    parts, stack = [], [node]
    while stack:
        one = stack.pop()
        if type(one) is str:
            parts.append(one)
        elif one.tag == "br":
            parts.append(" ")
        elif one is node or one.tag in INLINE and not put_aside(one):
            stack.extend(reversed(one.kids))
    return "".join(parts)


def is_menu(node: Node) -> bool:
    """A list or box of three links or more that says nothing beside them."""
    return node.tag in ("ul", "ol", "div", "table", "section") and node.links >= 3 and node.linked >= 0.8 * node.chars


def chosen(root: Node) -> list[Node]:
    """The container and those of its siblings that belong to it, in page order."""
    order = score(root)
    best = max(order, key=lambda n: n.score)
    if best.score <= 0:
        return []
    for want in ("article", "main"):
        up = best
        while up is not None and up.tag != want and up.named.get("role", "").lower() != want:
            up = up.parent
        if up is not None:
            # A title may stand before the article itself.
            titled = up.parent.kids[:up.parent.kids.index(up)] if up.parent.tag in ("main", "div", "section") else []
            return [*[k for k in titled if type(k) is Node and k.tag in HEADINGS and not put_aside(k)], up]
    if best.parent is None or best.tag in ("body", "html"):
        return [best]
    kept, passed = [], False
    for one in best.parent.kids:
        passed |= one is best
        if one is best:
            kept.append(one)
        elif type(one) is Node and one.chars and not (put_aside(one) or is_header(one) or is_menu(one)):
            dense = one.linked / one.chars
            if one.tag in HEADINGS:
                belongs = not passed
            elif best.parent.tag in ("body", "html", "#page"):
                belongs = one.score >= 0.2 * best.score or one.tag in PARAGRAPHS and dense < 0.25
            else:
                belongs = dense < 0.5
            if belongs:
                kept.append(one)
    return kept


def blocks(kept: list[Node]) -> list[str]:
    """The texts of the blocks of some elements, white space in them as one space, empty ones left out."""
    out: list[str] = []
    line: list[str] = []

    def close():
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    for top in kept:
        # None ends a block, 0 ends a header.
        stack: list = [top]
        headers = 0
        while stack:
            one = stack.pop()
            if one is None:
                close()
            elif one == 0:
                headers -= 1
            elif type(one) is str:
                if not headers:
                    line.append(one)
            elif one.tag == "br":
                line.append(" ")
            elif one is not top and (put_aside(one) or is_menu(one)):
                continue
            elif headers and one.tag in HEADINGS:
                close()
                line.append(_inline(one))
                close()
            else:
                if one is not top and is_header(one):
                    headers += 1
                    stack.append(0)
                if one.tag not in INLINE:
                    close()
                    stack.append(None)
                stack.extend(reversed(one.kids))
        close()
    return out


def main_text_of(html: str | None) -> str:
    """The main text of one page, its blocks in page order with a line feed between; '' if there is none."""
    return "\n".join(blocks(chosen(read(html)))) if html else ""


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (its code points) behind its columns; columns of these names are replaced.

    Character references are decoded, white space within a block is one space. Pages
    are whole, however long; null and empty ones, and those without any text, have the
    text ''. Every row is a page of its own, repeated ones too; an empty table gives an
    empty one.
    """
    small_batches(pages.sparkSession)
    others = [c for c in pages.columns if c.lower() not in ("text", "n_chars")]
    sent = pages.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{html}`").cast("string"))
    names = [f"c{i}" for i in range(len(others))]
    sent = sent.toDF(*names, "html")
    fields = [StructField(n, f.dataType) for n, f in zip(names, sent.schema.fields)]

    def extract(batches):
        for batch in batches:
            found = [main_text_of(h) for h in texts_of(batch.column("html")).to_pylist()]
            yield pa.record_batch(
                [*[batch.column(n) for n in names], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                [*names, "text", "n_chars"])

    schema = StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())])
    return sent.mapInArrow(tidy(extract), schema).toDF(*others, "text", "n_chars")
