"""A small tolerant HTML tree: elements with implied ends, subtree hashes, and the text blocks that are left."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import xxhash

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACES = re.compile(r"\s+")

# Element and attribute names of HTML, and usual names of page parts that are no content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head script style noscript template svg math iframe object canvas audio video form button input select textarea "
    "nav aside footer menu dialog title".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
PARTS = frozenset(
    "ad ads advert adverts advertisement advertising banner promo promoted sponsor sponsored cookie cookies consent gdpr "
    "notice notices notification sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments disqus "
    "newsletter subscribe signup login share sharing social related recommended popup modal overlay widget".split()
)
OUTER_PARTS = frozenset("header footer masthead topbar copyright legal".split())  # inside an article these may be its own
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Elements that may be a page part inside an article: no headings, list items, cells, quotations or parts of a sentence.
BOXES = frozenset("address center details div dl fieldset figure hr ol p section table ul".split())
SCOPES = frozenset("article main body html td th div section table blockquote aside header footer nav form li dd".split())


class Node:
    __slots__ = ("tag", "names", "role", "hidden", "items", "hash", "has_text", "has_main")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.names, self.role, self.hidden = tag, "", "", False
        self.items: list[Node | str] = []
        self.hash, self.has_text, self.has_main = 0, False, False
        if attributes.strip():
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), html.unescape("".join(values)).lower()
                if name in ("class", "id"):
                    self.names += f" {value}"
                elif name == "role":
                    self.role = value.strip()
                elif name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value)):
                    self.hidden = True

    @property
    def is_main(self) -> bool:
        return self.tag in ("article", "main") or self.role == "main"


def parse(page: str) -> Node:
    """The tree of a page. Tags that never end, end with what encloses them; a cut-off tag ends the page."""
    root = Node("html")
    stack = [root]
    at = 0

    def text(piece: str) -> None:
        if piece:
            stack[-1].items.append(piece)

    while (token := _TOKEN.search(page, at)) is not None:
        text(page[at : token.start()])
        at = token.end()
        closing, tag, attributes, end = token.groups()
        if tag is None:
            continue
        if end != ">":
            break
        tag = tag.lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if stack[depth].is_main and tag not in ("body", "html", "article", "main"):
                    break
            continue
        if tag in ("html", "body"):
            continue
        _imply_ends(stack, tag)
        node = Node(tag, attributes)
        stack[-1].items.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else len(page)
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append(node)
    else:
        text(page[at:])
    return root


def _imply_ends(stack: list[Node], tag: str) -> None:
    """Closes what may not hold the new element: a paragraph before a block, a list item before the next."""
    if tag in BLOCKS:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag == "p":
                del stack[depth:]
                break
            if stack[depth].tag in SCOPES:
                break
    ended, within = CLOSED_BY.get(tag, ((), ()))
    for depth in range(len(stack) - 1, 0, -1) if ended else ():
        if stack[depth].tag in within:
            break
        if stack[depth].tag in ended:
            del stack[depth:]
            if tag not in ("tr", "tbody", "tfoot"):
                break


def dropped(node: Node, in_main: bool) -> bool:
    """Whether an element is a page part by its kind or name. Reader comments may be articles within articles."""
    if node.hidden or node.tag in DROPPED or (node.tag == "header" and not in_main) or node.role in ROLES:
        return True
    if not node.names:
        return False
    names = set(node.names.split())
    words = names | {w for n in names for w in re.split(r"[-_\d]+", n)[:1] + re.split(r"[-_\d]+", n)[-1:]}
    if node.is_main:
        return bool(words & {"comment", "comments"})
    return bool(words & PARTS) or (not in_main and bool(words & OUTER_PARTS))


def mark(root: Node) -> list[int]:
    """Sets the hash of every element with text, and returns the different ones outside the main content.

    The hash covers kind, class, id and everything inside; it ignores other attributes and the width of blanks.
    What holds main content at any depth has no hash, so a wrapper of the article never counts as template. Inside
    the main content the same markup has another hash than outside.
    """
    found: dict[int, None] = {}
    todo: list[tuple[Node, bool, bool]] = [(root, False, False)]
    while todo:
        node, ready, inside = todo.pop()
        if not ready:
            node.has_main = node.is_main and not dropped(node, False)
            todo.append((node, True, inside))
            todo += [(child, False, inside or node.has_main) for child in node.items if isinstance(child, Node)]
            continue
        state = xxhash.xxh64(f"{node.tag}\0{node.names}\0{node.role}".encode("utf-8", "surrogatepass"), seed=int(inside))
        for item in node.items:
            if isinstance(item, Node):
                node.has_main |= item.has_main
                state.update(b"\1" + item.hash.to_bytes(8, "little", signed=True))
                node.has_text |= item.has_text
            elif words := _SPACES.sub(" ", item).strip():
                node.has_text = True
                state.update(b"\2" + words.encode("utf-8", "surrogatepass"))
        node.hash = 0 if node.has_main else int.from_bytes(state.digest(), "big", signed=True)
        if node is not root and not inside and node.hash and node.has_text and node.tag not in RAW:
            found[node.hash] = None
    return list(found)


def article_boxes(root: Node, least_words: int = 6) -> tuple[int, int, list[int], list[int]]:
    """(article, sketch, boxes, brief) of the main elements of a marked tree.

    ``article`` is a hash of their text. ``sketch`` is the smallest hash over their runs of three words: articles
    that share most of their words mostly have the same, articles that share only a box do not. ``boxes`` are the
    different hashes of elements that may be a page part by their kind, ``brief`` those of under ``least_words`` words.
    Longer paragraphs without class, id and role are prose, however many articles share them, and no boxes.
    """
    boxes: dict[int, None] = {}
    brief: dict[int, None] = {}
    mains = [main for main in _mains(root, frozenset()) if main.is_main]
    if not mains:
        return 0, 0, [], []
    todo = list(mains)
    while todo:
        node = todo.pop()
        for child in node.items:
            if isinstance(child, Node) and not dropped(child, True):
                todo.append(child)
                if child.tag in BOXES and child.hash and child.has_text:
                    few = sum(len(t.split()) for t in _strings(child, least_words)) < least_words
                    if few:
                        brief[child.hash] = None
                    elif child.tag != "p" or child.names.strip() or child.role:
                        boxes[child.hash] = None
    text = main_text(root).encode("utf-8", "surrogatepass")
    words = text.split()
    runs = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [text]
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    return signed(xxhash.xxh64_intdigest(text)), signed(min(map(xxhash.xxh64_intdigest, runs))), list(boxes), list(brief)


def _strings(node: Node, most: int) -> Iterator[str]:
    """The first strings of an element with text, ``most`` at the most."""
    todo: list[Node | str] = [node]
    while todo and most:
        item = todo.pop()
        if isinstance(item, str):
            if item.strip():
                most -= 1
                yield item
        elif item.tag not in RAW:
            todo += reversed(item.items)


def _mains(root: Node, removed: frozenset[int]) -> list[Node]:
    """The outermost main elements that are not part of something dropped; else the whole page."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.hash in removed and node.hash or dropped(node, False):
            continue
        if node.is_main:
            found.append(node)
        else:
            todo += [child for child in reversed(node.items) if isinstance(child, Node)]
    return found or [root]


def blocks(root: Node, removed: frozenset[int] = frozenset()) -> Iterator[str]:
    """The text blocks of the main content in page order, without dropped parts and removed subtrees."""
    line: list[str] = []

    def flush() -> Iterator[str]:
        # references are decoded before blanks are joined, so that a no-break space is a blank as well
        block = _SPACES.sub(" ", "".join(line)).strip()
        line.clear()
        if block:
            yield block

    for main in _mains(root, removed):
        inside = main.is_main
        todo: list[Node | str | None] = [main]
        while todo:
            item = todo.pop()
            if item is None:
                yield from flush()
            elif isinstance(item, str):
                line.append(html.unescape(item))
            elif item is main or not (item.hash and item.hash in removed or dropped(item, inside)):
                if item.tag in ("br", "wbr"):
                    line.append(" " if item.tag == "br" else "")
                    continue
                if item.tag in BLOCKS:
                    yield from flush()
                    todo.append(None)
                todo += reversed(item.items)
        yield from flush()


def main_text(root: Node, removed: frozenset[int] = frozenset()) -> str:
    return "\n".join(blocks(root, removed))
