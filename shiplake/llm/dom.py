"""A tolerant HTML reader: pages to trees of elements with their text blocks, as flat lists."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

# Element names as the HTML standard groups them.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "xmp"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
    "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "tr", "ul",
}
CLOSES = {  # a start tag ends these open elements
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
STOPS = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "html", "nav", "main", "aside", "form"}

MARKUP = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>|<[!?][^>]*+>",
    re.DOTALL)
NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)


class Tree:
    """parent, tag and marks (words of class, id and role) of each element, parents first; blocks: (element, text)."""

    def __init__(self) -> None:
        self.parent, self.tag, self.marks, self.linked = [-1], ["#page"], [""], [0]
        self.blocks: list[tuple[int, str]] = []


def read_page(html: str) -> Tree:
    tree = Tree()
    stack, open_tags, buffer = [0], Counter(), []
    links = 0
    at, end = 0, len(html)

    def owner() -> int:
        for node in reversed(stack):
            if tree.tag[node] in BLOCK or node == 0:
                return node
        return 0

    def flush() -> None:
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            if text:
                tree.blocks.append((owner(), text))
            buffer.clear()

    def pop() -> None:
        nonlocal links
        name = tree.tag[stack.pop()]
        open_tags[name] -= 1
        links -= name == "a"

    def close(names: set[str], stops: set[str]) -> None:
        depth = next((i for i in range(len(stack) - 1, 0, -1) if tree.tag[stack[i]] in names or tree.tag[stack[i]] in stops), 0)
        if depth and tree.tag[stack[depth]] in names:
            while len(stack) > depth:
                pop()

    while at < end:
        found = MARKUP.search(html, at)
        if found is None:
            piece, at = html[at:], end
        else:
            piece, at = html[at:found.start()], found.end()
        if piece:
            buffer.append(piece)
            if links > 0:
                tree.linked[owner()] += len(piece)
        if found is None or not found["name"]:
            continue
        name, block = found["name"].lower(), found["name"].lower() in BLOCK
        if found["end"]:
            if block:
                flush()
            if open_tags[name] > 0:
                while tree.tag[stack[-1]] != name:
                    pop()
                pop()
            continue
        if name in VOID:
            buffer.append(" ")
            if name == "hr":
                flush()
            continue
        if block:
            flush()
            if open_tags["p"] > 0:
                close({"p"}, STOPS)
        if name in CLOSES and any(open_tags[x] > 0 for x in CLOSES[name]):
            close(CLOSES[name], STOPS - {name})
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}[\s/>]", re.IGNORECASE).search(html, at)
            if stop is None:
                at = end if name in ("script", "style", "textarea", "title") else at
            else:
                at = html.find(">", stop.start()) + 1 or end
            continue
        if found["rest"].endswith("/") and name not in BLOCK and name != "a":
            continue
        marks = " ".join(
            a[1] or a[2] or a[3] or a[0] for a in NAMED.findall(found["rest"])).lower() if found["rest"].strip() else ""
        tree.parent.append(stack[-1])
        tree.tag.append(name)
        tree.marks.append(marks)
        tree.linked.append(0)
        stack.append(len(tree.tag) - 1)
        open_tags[name] += 1
        links += name == "a"
    flush()
    return tree
