"""Main text of web pages by tree scoring.

The page becomes a tree of elements. What is never article text by its element,
role or name (menus, forms, adverts, comments and the like) is cut off; of a form
that holds the article, or most of the page's paragraph text, only the controls. Each
paragraph passes points, for its length and its commas, to its ancestors: all of
them to its parent, half to the next, then less and less. A container's points
are discounted by its link density; the best container is kept. Where it lies in
an article or main element, that whole element is kept, else its whole parent;
around them only what consists of links for the most part is left out.

Cases: null and empty pages, and pages without any text block, give an empty
text. Broken markup is read as it stands: unclosed elements end with their
parent, a paragraph ends where the next block begins, a cut-off page ends where
it ends. Pages of any size and depth are read whole, without recursion and in
time that grows with their size, broken markup too. Equal scores go to the
container that begins first. Rows that repeat are read like any
other, columns besides those named are not read, and an empty table gives an
empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import slices, to_python

#: Parts of a tag. A slash in a bare value such as href=/ belongs to the value.
NAME, GAP, KEY, EQUALS, BARE = (re.compile(x) for x in (r"[a-zA-Z][^\s/>]*", r"[\s/]*", r"=?[^\s=>/]*", r"\s*=\s*", r"[^\s>]*"))
#: Tags that run into the page's end before quotes are no longer heeded.
LOST_MOST = 8
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CUT = set("script style noscript iframe noembed noframes xmp template form input button select option textarea nav footer aside menu dialog object embed applet canvas svg math audio video head title fieldset".split())
CUT_ROLE = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
CUT_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|disqus|footer|footnav|gdpr|header|masthead|menu|menubar|modal|nav|navbar|navigation|newsletter|notice|notification|overlay|pagination|pager|popup|promo|promoted|related|recommend\w*|replies|respond|share|sharing|sidebar|side|social|sponsor\w*|subscribe|subscription|tags|toolbar|widget)(?:$|[\s_-])",
    re.I,
)
KEEP_NAME = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text)(?:$|[\s_-])", re.I)
#: Open elements that a start tag ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDED = set().union(*ENDS.values())
LISTS = {"ul", "ol", "dl", "table", "select"}
SCOPE = set("ul ol dl table tbody thead tfoot article section main div body html td th li blockquote aside nav header footer form".split())
CONTAINER = {"article": 10, "main": 10, "section": 5, "div": 5, "td": 3, "blockquote": 3, "pre": 3, "body": 0}
PARAGRAPH = set("p pre blockquote td li dd div section article main h1 h2 h3 h4 h5 h6 figcaption body".split())
NO_ATTRIBUTES: dict[str, str] = {}


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "score", "chars", "linked", "cut")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.score, self.chars, self.linked, self.cut = 0.0, 0, 0, False


class Tags:
    """Reads tags of a page, in time that grows with the page whatever its quotes and brackets are."""

    def __init__(self, page: str):
        self.page, self.last, self.lost = page, page.rfind(">"), 0
        self.no_quote = {"'": len(page), '"': len(page)}

    def read(self, at: int) -> tuple[int, str, dict[str, str], bool] | None:
        """End, name and attributes of the tag whose name begins at ``at``, and whether a slash closes it; None if no tag ends any more."""
        if at > self.last:
            return None
        if self.lost < LOST_MOST:
            if found := self._scan(at):
                return found
            self.lost += 1
        end = self.page.index(">", at) + 1
        name, attributes, closed = (Tags(self.page[at:end])._scan(0) or (0, NAME.match(self.page, at)[0].lower(), NO_ATTRIBUTES, False))[1:]
        return end, name, attributes, closed

    def _scan(self, at: int) -> tuple[int, str, dict[str, str], bool] | None:
        page, size = self.page, len(self.page)
        name = NAME.match(page, at)
        at, attributes = name.end(), NO_ATTRIBUTES
        if page.startswith(">", at):
            return at + 1, name[0].lower(), attributes, False
        while True:
            gap = GAP.match(page, at)
            at = gap.end()
            if at == size:
                return None
            if page[at] == ">":
                return at + 1, name[0].lower(), attributes, gap[0].endswith("/")
            key = KEY.match(page, at)
            at, value = key.end(), ""
            if equals := EQUALS.match(page, at):
                at = equals.end()
                close = self._quote(page[at : at + 1], at + 1)
                if close >= 0:
                    value, at = page[at + 1 : close], close + 1
                else:
                    bare = BARE.match(page, at)
                    value, at = bare[0], bare.end()
            attributes = attributes or {}
            attributes.setdefault(key[0].lower(), html.unescape(value))

    def _quote(self, mark: str, at: int) -> int:
        """Where the same quotation mark comes again, or -1."""
        if at >= self.no_quote.get(mark, 0):
            return -1
        close = self.page.find(mark, at)
        if close < 0:
            self.no_quote[mark] = at
        return close


class Open:
    """The open elements; counts end a search at once that would find nothing."""

    def __init__(self, root: Node):
        self.stack, self.all, self.scope, self.lists = [root], Counter(), [Counter()], [Counter()]

    def push(self, node: Node) -> None:
        self.stack.append(node)
        self.all[node.tag] += 1
        if node.tag in SCOPE:
            self.scope.append(Counter())
        else:
            self.scope[-1][node.tag] += 1
        if node.tag in LISTS:
            self.lists.append(Counter())
        elif node.tag in ENDED:
            self.lists[-1][node.tag] += 1

    def pop(self) -> str:
        tag = self.stack.pop().tag
        self.all[tag] -= 1
        if tag in SCOPE:
            self.scope.pop()
        else:
            self.scope[-1][tag] -= 1
        if tag in LISTS:
            self.lists.pop()
        elif tag in ENDED:
            self.lists[-1][tag] -= 1
        return tag

    def start(self, tag: str) -> None:
        """Close what a start tag ends: a block an open paragraph, whatever inline elements lie between, an item the one before."""
        if tag in BLOCK and self.scope[-1]["p"]:
            while self.pop() != "p":
                pass
        ends = ENDS.get(tag)
        if ends and any(self.lists[-1][e] for e in ends):
            while self.pop() not in ends:
                pass
            while self.stack[-1].tag in ends:
                self.pop()

    def end(self, tag: str) -> None:
        """Close the nearest such element; an inline one only inside the nearest block."""
        if (self.all if tag in BLOCK else self.scope[-1])[tag]:
            while self.pop() != tag:
                pass


def parse(page: str) -> Node:
    """The tree of a page; texts with their character references decoded."""
    root = Node("html", NO_ATTRIBUTES, None)
    tags, opened, at, start = Tags(page), Open(root), 0, 0
    while (at := page.find("<", at)) >= 0:
        mark, found = page[at + 1 : at + 2], None
        ending = mark == "/"
        letter = page[at + 2 : at + 3] if ending else mark
        if letter.isascii() and letter.isalpha():
            found = tags.read(at + 1 + ending)
            if found is None:
                break
            end = found[0]
        elif mark in ("!", "?") and mark:
            close = "-->" if page.startswith("<!--", at) else ">"
            end = page.find(close, at + 2)
            end = len(page) if end < 0 else end + len(close)
        else:
            at += 1
            continue
        if at > start:
            opened.stack[-1].children.append(html.unescape(page[start:at]))
        at = start = end
        if found is None or found[1] == "html":
            continue
        _, tag, attributes, closed = found
        if ending:
            opened.end(tag)
            continue
        opened.start(tag)
        node = Node(tag, attributes, opened.stack[-1])
        node.parent.children.append(node)
        if tag in RAW:
            after = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            node.children.append(page[at : after.start() if after else len(page)])
            at = start = after.end() if after else len(page)
        elif tag not in VOID and not closed:
            opened.push(node)
    if start < len(page):
        opened.stack[-1].children.append(html.unescape(re.sub(r"<[a-zA-Z/][^<>]*\Z", "", page[start:])))
    return root


def is_cut(node: Node, within: bool, wrappers: set[int] = frozenset()) -> bool:
    """Whether a subtree is never article text; ``within`` an article or main, ``wrappers`` are the forms around the page's body."""
    if node.tag in CUT and id(node) not in wrappers:
        return True
    if node.tag == "label" and wrappers:
        return True
    if node.tag == "header":
        return not within
    a = node.attributes
    if not a:
        return False
    if a.get("role", "").lower() in CUT_ROLE or "hidden" in a or re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return True
    name = f"{a.get('class', '')} {a.get('id', '')}"
    return node.tag not in ("html", "body", "article", "main") and bool(CUT_NAME.search(name)) and not KEEP_NAME.search(name)


def form_wrappers(root: Node) -> set[int]:
    """Forms that hold an article or main element, or lie in none and hold most of the page's paragraph text."""
    order, todo, forms = [], [(root, False)], []
    while todo:
        node, within = todo.pop()
        order.append(node)
        if node.tag == "form":
            forms.append((node, within))
        within = within or node.tag in ("article", "main")
        todo += [(c, within) for c in node.children if isinstance(c, Node) and (not is_cut(c, within, {id(c)}) if c.tag == "form" else c.tag != "label" and not is_cut(c, within))]
    wrappers = {id(f) for f, _ in forms}
    if not wrappers:
        return wrappers
    text, holds = {}, {}
    for node in reversed(order):  # children before parents
        inside = [c for c in node.children if isinstance(c, Node) and id(c) in text]
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str)) if node.tag != "a" else 0
        text[id(node)] = own + sum(text[id(c)] for c in inside)
        holds[id(node)] = node.tag in ("article", "main") or any(holds[id(c)] for c in inside)
    for form, within in forms:
        if not holds[id(form)] and (within or 2 * text[id(form)] <= text[id(root)]):
            wrappers.discard(id(form))
    return wrappers


def blocks(root: Node) -> list[str]:
    """Texts of the blocks of a subtree in page order; white space is one space."""
    out, line = [], []

    def end() -> None:
        if line and (text := " ".join("".join(line).split())):
            out.append(text)
        line.clear()

    todo: list[Node | str | None] = [root]
    while todo:
        item = todo.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            line.append(item)
        elif item.cut:
            continue
        elif item.tag == "br":
            line.append(" ")
        else:
            block = item.tag in BLOCK
            if block:
                end()
                todo.append(None)
            todo += reversed(item.children)
    end()
    return out


def main_text(page: str | None) -> str:
    """The article's blocks joined by empty lines."""
    if not page:
        return ""
    root = parse(page)
    wrappers = form_wrappers(root) if "<form" in page.lower() else frozenset()
    todo, order = [(root, False)], []
    while todo:
        node, within = todo.pop()
        order.append(node)
        within = within or node.tag in ("article", "main")
        for c in reversed(node.children):
            if isinstance(c, Node):
                c.cut = is_cut(c, within, wrappers)
                if not c.cut:
                    todo.append((c, within))
    own: dict[int, tuple[int, int]] = {}
    for node in reversed(order):  # children before parents
        chars = commas = 0
        for c in node.children:
            if isinstance(c, str):
                text = c.strip()
                chars += len(text)
                commas += text.count(",") + text.count("，") + text.count("、")
            elif not c.cut and c.tag not in BLOCK:
                a, b = own[id(c)]
                chars, commas = chars + a, commas + b
            if isinstance(c, Node) and not c.cut:
                node.chars += c.chars
                node.linked += c.linked
        own[id(node)] = chars, commas
        node.chars += sum(len(c.strip()) for c in node.children if isinstance(c, str))
        if node.tag == "a":
            node.linked = node.chars
    for node in order:
        chars, commas = own[id(node)]
        if node.tag not in PARAGRAPH or not chars:
            continue
        points = 1 + commas + min(chars / 100, 3.0)
        up = node if node.tag in ("div", "section", "article", "main", "body", "td") else node.parent
        level = 1
        while up is not None and level <= 5:
            up.score += points / level if level <= 2 else points / (3 * (level - 1))
            up, level = up.parent, level + 1
    best, most = None, 0.0
    for node in order:
        if node.score and node.tag in CONTAINER or node is root and node.score:
            named = KEEP_NAME.search(f"{node.attributes.get('class', '')} {node.attributes.get('id', '')}") if node.attributes else None
            score = (node.score + CONTAINER.get(node.tag, 0) + 10 * bool(named)) * (1 - density(node))
            if score > most:
                best, most = node, score
    if best is None:
        return "\n\n".join(blocks(root))
    return "\n\n".join(blocks(enclosing(best)))


def density(node: Node) -> float:
    """Share of an element's characters that lie in links."""
    return node.linked / node.chars if node.chars else 0.0


def enclosing(best: Node) -> Node:
    """The element that the article fills: the outermost article or main around ``best``, else its parent.

    Links around the article, or around ``best`` where no article is marked, are taken out of it.
    """
    around, node = [], best
    while node is not None:
        around.append(node)
        node = node.parent
    marked = [n for n in around if n.tag in ("article", "main")]
    if not marked:
        inner, outer = best, best.parent if best.parent is not None and best.tag != "body" else best
    else:
        outer = marked[-1]
        inner = next((n for n in reversed(marked) if n.tag == "article"), outer)
    node = inner
    while node is not outer:
        node, inside = node.parent, node
        node.children = without_links(node, inside)
    return outer


def without_links(node: Node, inside: Node) -> list[Node | str]:
    """Children except those blocks and those lines between blocks that are links for half of their text or more."""
    out, line = [], []

    def end() -> None:
        chars = sum(len(c.strip()) if isinstance(c, str) else c.chars for c in line)
        if 2 * sum(c.linked for c in line if isinstance(c, Node)) < chars:
            out.extend(line)
        line.clear()

    for c in node.children:
        if isinstance(c, str) or not c.cut and c is not inside and c.tag not in BLOCK:
            line.append(c)
        elif not c.cut:
            end()
            if c is inside or density(c) < 0.5:
                out.append(c)
    end()
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` of each row."""
    kind, url_kind = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    plain = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return to_python(plain).mapInArrow(run, f"id {kind}, url {url_kind}, text string, n_chars long").withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
