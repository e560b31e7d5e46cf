"""Visible text of HTML pages, laid out in blocks, lists and aligned tables."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A cell wider than this is not padded to its column; nothing is cut.
PAD = 60
#: Tables inside tables beyond this depth are laid out as plain blocks.
NESTED_TABLES = 12

_PIECE = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</[a-zA-Z][^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z|(?=[\"']))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CSS_OPAQUE = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->|\"(?:[^\"\\\n]|\\.)*+\"?|'(?:[^'\\\n]|\\.)*+'?|url\([^()\"']*+\)", re.S)
_LENGTH = re.compile(r"([\d.]+)(px|em|rem)?")

# Element names of the HTML standard by how they are parsed and displayed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RCDATA = frozenset("textarea title".split())
HIDDEN = frozenset("head script style template title noscript noembed noframes iframe datalist audio video object map param rp".split())
HEAD = frozenset("base basefont bgsound link meta title style script noscript noframes template".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search"
    " section summary table ul xmp caption tr tbody thead tfoot td th".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl dir menu blockquote pre listing figure table hr plaintext xmp".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr listing main menu nav ol p plaintext pre search section summary table ul xmp li dd dt".split()
)
#: A start tag closes the nearest of these open elements, unless one of the stops is nearer.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dd": ({"dd", "dt"}, {"dl", "table", "td", "th"}),
    "dt": ({"dd", "dt"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"optgroup", "option"}, {"select"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "caption": ({"caption"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
}
#: What ``display`` and ``visibility`` may say that shows, that hides, and that leaves it to the browser.
SHOWN = {
    "display": frozenset(
        "block inline inline-block flex inline-flex grid inline-grid table inline-table table-row table-cell table-caption"
        " table-column table-column-group table-row-group table-header-group table-footer-group list-item contents flow"
        " flow-root run-in ruby -webkit-box -webkit-inline-box -webkit-flex -ms-flexbox -ms-grid initial inherit unset".split()
    ),
    "visibility": frozenset("visible initial inherit unset".split()),
}
HIDES = frozenset("none hidden collapse".split())
DEFAULTS = frozenset("revert revert-layer".split())
#: The screen that pages are shown on, in pixels, and what else media queries may ask.
WIDTH, HEIGHT = 1280.0, 800.0
SCREEN = {
    "orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "prefers-color-scheme": "light",
    "prefers-reduced-motion": "no-preference", "scripting": "enabled", "display-mode": "browser",
}
MEDIA = frozenset("all screen print speech aural braille embossed handheld projection tty tv".split())
SCOPE = frozenset("html table td th caption template object button".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "hidden")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.hidden, self.children = tag, attrs, False, []


def attributes(text: str) -> dict[str, str]:
    """The first value of each attribute."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def _plain(css: str) -> str:
    """CSS without comments, and without what strings and addresses hold."""
    return _CSS_OPAQUE.sub(lambda m: '""' if m[0][0] in "\"'" else " ", css)


def declaration(text: str) -> tuple[str, bool, bool | None] | None:
    """``display`` or ``visibility``, whether it is important, and whether it hides; None for the browser's own value."""
    name, _, value = text.lower().partition(":")
    name = name.strip()
    if name not in SHOWN:
        return None
    value, mark, rest = value.partition("!")
    value = " ".join(value.split())
    if mark and rest.strip() != "important" or value not in SHOWN[name] and value not in HIDES and value not in DEFAULTS:
        return None
    return name, bool(mark), None if value in DEFAULTS else value in HIDES


def _feature(text: str) -> bool | None:
    """A media feature on the screen; None if it is not known."""
    name, colon, value = (x.strip() for x in text.partition(":"))
    if colon and name in SCREEN:
        return value == SCREEN[name]
    if name in SCREEN:
        return SCREEN[name] != "none"
    sizes = {"width": WIDTH, "device-width": WIDTH, "height": HEIGHT, "device-height": HEIGHT}

    def number(x: str) -> float | None:
        if x in sizes:
            return sizes[x]
        found = _LENGTH.fullmatch(x)
        try:
            return float(found[1]) * (16 if found[2] in ("em", "rem") else 1) if found else None
        except ValueError:
            return None

    if colon:
        bound, _, of = name.partition("-") if name[:4] in ("min-", "max-") else ("", "", name)
        limit, have = number(value), sizes.get(of)
        if limit is None or have is None:
            return None
        return have >= limit if bound == "min" else have <= limit if bound == "max" else have == limit
    if name in ("color", *sizes):
        return True
    parts = [x.strip() for x in re.split(r"(<=|>=|<|>|=)", text)]
    values = [number(x) for x in parts[::2]]
    if len(parts) < 3 or None in values:
        return None
    test = {"<=": float.__le__, ">=": float.__ge__, "<": float.__lt__, ">": float.__gt__, "=": float.__eq__}
    return all(test[sign](x, y) for x, sign, y in zip(values, parts[1::2], values[1:], strict=False))


def _query(text: str) -> bool:
    """One media query; what is not known does not hold, negated or not."""
    words = re.findall(r"\([^()]*\)|[^\s()]+", text)
    if re.sub(r"\([^()]*\)|[^\s()]+|\s+", "", text):
        return False  # nested conditions
    negated = words[:1] == ["not"]
    words = words[1:] if words[:1] in (["not"], ["only"]) else words
    either = "or" in words
    found: list[bool | None] = []
    for word in words:
        if word in ("and", "or"):
            continue
        found.append(_feature(word[1:-1]) if word[0] == "(" else word in ("all", "screen") if word in MEDIA else None)
    if not found or None in found:
        return False
    return (any(found) if either else all(found)) != negated


def on_screen(media: str) -> bool:
    """Whether a list of media queries holds on a screen of ``WIDTH`` by ``HEIGHT``; an empty list does."""
    return not media.strip() or any(_query(q.strip()) for q in media.lower().split(","))


def sheet_rules(css: str) -> Iterator[tuple[str, str, bool, bool | None]]:
    """``selector, property, important, hides`` of simple selectors (``tag``, ``.class``, ``#id``), in order.

    Rules count at the top and in ``@media`` that holds on a screen, ``@supports`` that is not
    negated and ``@layer``; other at-rules and nested selectors do not.
    """
    css = _plain(css)
    blocks: list[list[str] | bool] = []  # selectors of a rule; of other blocks, whether what is in them counts
    at = 0
    for sign in (*re.finditer(r"[{};]", css), None):
        text = css[at : sign.start() if sign else len(css)].strip()
        at = sign.end() if sign else at
        inside = blocks[-1] if blocks else True
        if sign and sign[0] == "{":
            if text.startswith("@"):
                name, _, rest = re.sub(r"^@([\w-]+)", r"\1 ", text.lower()).partition(" ")
                holds = name == "media" and on_screen(rest) or name == "layer" or name == "supports" and not rest.split()[:1] == ["not"]
                blocks.append(inside if holds else False)
            elif inside is True:
                blocks.append([s.strip() for s in text.split(",") if re.fullmatch(r"\s*[.#]?[\w-]+\s*", s)])
            else:
                blocks.append(False)
            continue
        if isinstance(inside, list) and (found := declaration(text)):
            for s in inside:
                yield (s if s[0] in ".#" else s.lower(), *found)
        if sign and sign[0] == "}" and blocks:
            blocks.pop()


class Builder:
    """Builds the tree of a page, with the tags that authors may leave out."""

    def __init__(self, source: str):
        self.root = Node("html", {})
        self.stack = [self.root]
        self.nodes: list[Node] = []
        self.order = 0
        self.rules: dict[str, dict[str, tuple]] = {}
        self.open: dict[str, int] = {"html": 1}
        self._read(source)
        for node in self.nodes:  # a style sheet also counts for what stands before it
            node.hidden = self._hidden(node.tag, node.attrs)

    def _sheet(self, css: str, media: str) -> None:
        """The important declaration of a selector wins, or else the last one."""
        if not on_screen(media) or self.open.get("noscript") or self.open.get("template"):
            return
        for name, kind, important, hides in sheet_rules(css):
            self.order += 1
            own = self.rules.setdefault(name, {})
            new = (important, ".#".find(name[0]) + 1, self.order, hides)
            own[kind] = max(own.get(kind, new), new)

    def _hidden(self, tag: str, attrs: dict[str, str]) -> bool:
        if tag in HIDDEN or tag == "input" and attrs.get("type", "").lower() == "hidden":
            return True
        best: dict[str, tuple] = {}
        if self.rules:
            for name in {tag, "#" + attrs.get("id", ""), *("." + c for c in attrs.get("class", "").split())}:
                for kind, new in self.rules.get(name, {}).items():
                    best[kind] = max(best.get(kind, new), new)
        if "style" in attrs:
            for i, text in enumerate(_plain(attrs["style"]).split(";")):
                if found := declaration(text):
                    new = (found[1], 3, i, found[2])
                    best[found[0]] = max(best.get(found[0], new), new)
        display, seen = (best[kind][3] if kind in best else None for kind in ("display", "visibility"))
        if display is None:
            display = "hidden" in attrs or tag == "dialog" and "open" not in attrs
        return display or bool(seen)

    def _push(self, tag: str, attrs: dict[str, str]) -> Node:
        node = Node(tag, attrs)
        self.nodes.append(node)
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1
        return node

    def _pop_to(self, at: int) -> None:
        for node in self.stack[at:]:
            self.open[node.tag] -= 1
        del self.stack[at:]

    def _close(self, tags, stops) -> None:
        """Close the nearest open element of ``tags`` and what is in it, unless a stop is nearer."""
        if not any(self.open.get(t) for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self._pop_to(i)
                return
            if self.stack[i].tag in stops:
                return

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        top = self.stack[-1].tag
        if tag == "html":
            self.root.attrs = attrs | self.root.attrs
            return
        if tag in ("head", "body"):
            if self.open.get("body") or tag == "head" and self.open.get("head"):
                return
            self._close({"head"}, ())
        elif not self.open.get("body"):
            if tag in HEAD and len(self.stack) <= 2:
                if not self.open.get("head") and not self.root.children:
                    self._push("head", {})
            elif not any(n.tag not in ("html", "head") for n in self.stack):
                self._close({"head"}, ())
                self._push("body", {})
        if tag in CLOSES_P:
            self._close({"p"}, SCOPE)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
            top = self.stack[-1].tag
            if tag in ("td", "th") and top in ("table", "tbody", "thead", "tfoot"):
                if top == "table":
                    self._push("tbody", {})
                self._push("tr", {})
            elif tag == "tr" and top == "table":
                self._push("tbody", {})
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6") and top in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._pop_to(len(self.stack) - 1)
        self._push(tag, attrs)

    def _text(self, text: str) -> None:
        if not self.open.get("body") and not text.isspace() and self.stack[-1].tag in ("html", "head"):
            self._close({"head"}, ())
            self._push("body", {})
        self.stack[-1].children.append(html.unescape(text))

    def _end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "p" and not self.open.get("p"):
            self._start("p", {})
        if tag == "br":
            self._push("br", {})
        elif self.open.get(tag):
            for i in range(len(self.stack) - 1, 0, -1):
                node = self.stack[i].tag
                if node == tag:
                    self._pop_to(i)
                    return
                if node in ("td", "th", "caption") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th"):
                    return

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            found = _PIECE.search(source, at)
            if found is None:
                self._text(source[at:])
                return
            if found.start() > at:
                self._text(source[at : found.start()])
            at = found.end()
            piece = found[0]
            if found[1] is None:
                if piece.startswith("</"):
                    self._end(re.match(r"</([^\s/>]*)", piece)[1].lower())
                continue
            if not piece.endswith(">"):  # a stray quote: the tag ends at the next bracket
                end = source.find(">", at)
                at = n if end < 0 else end + 1
            tag = found[1].lower()
            attrs = attributes(found[2]) if found[2] else {}
            self._start(tag, attrs)
            if tag in RAW or tag in RCDATA:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                stop = end.start() if end else n
                body = source[at:stop]
                if tag == "style":
                    self._sheet(body, attrs.get("media", ""))
                elif tag == "textarea":
                    self.stack[-1].children.append(html.unescape(body))
                if self.stack[-1].tag == tag:
                    self._pop_to(len(self.stack) - 1)
                close = source.find(">", stop)
                at = n if close < 0 or not end else close + 1
            elif tag == "plaintext":
                self.stack[-1].children.append(source[at:])
                return


class Layout:
    """Lines of text; blank lines between spaced blocks collapse into one."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = False
        self.space = False
        self.indent: list[str] = []
        self.marker: str | None = None

    def word(self, text: str) -> None:
        if not self.parts:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            if self.marker is not None:
                self.parts.append("".join(self.indent[:-1]) + self.marker)
                self.marker = None
            else:
                self.parts.append("".join(self.indent))
        elif self.space:
            self.parts.append(" ")
        self.space = False
        self.parts.append(text)

    def flow(self, text: str) -> None:
        words = text.split()
        if not words:
            self.space = self.space or bool(self.parts) and bool(text)
            return
        if self.parts and text[0].isspace():
            self.space = True
        self.word(" ".join(words))
        self.space = text[-1].isspace()

    def line(self) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip())
            self.parts = []
        self.space = False

    def verbatim(self, text: str) -> None:
        for i, line in enumerate(text.expandtabs(8).split("\n")):
            if i:
                if not self.parts:
                    self.word("")
                self.line()
            if line:
                self.word(line)

    def text(self) -> str:
        self.line()
        return "\n".join(self.lines)


def _cell(text: str) -> Node:
    cell = Node("td", {})
    cell.children = [text]
    return cell


def _rows(table: Node) -> tuple[list[Node], list[list[Node]]]:
    """Captions and rows of cells; what else is in the table counts as a row of its own."""
    captions, rows = [], []
    todo = list(reversed(table.children))
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            if not node.isspace() and node:
                rows.append([_cell(node)])
        elif node.hidden:
            continue
        elif node.tag in ("tbody", "thead", "tfoot"):
            todo += reversed(node.children)
        elif node.tag == "caption":
            captions.append(node)
        elif node.tag == "tr":
            rows += [[_cell(c)] for c in node.children if isinstance(c, str) and c and not c.isspace()]
            cells = [c for c in node.children if isinstance(c, Node) and not c.hidden]
            if cells:
                rows.append(cells)
        elif node.tag not in ("col", "colgroup"):
            rows.append([node])
    return captions, rows


def _span(cell: Node) -> int:
    value = cell.attrs.get("colspan", "1").strip()
    return min(max(int(value), 1), 1000) if value.isdecimal() and len(value) < 5 else 1


def table_lines(table: Node, depth: int) -> list[str]:
    """Rows as lines; the cells of a column begin at the same place."""
    captions, rows = _rows(table)
    lines = [line for c in captions for line in render(c.children, depth + 1).split("\n") if line]
    texts = [[(" ".join(render(c.children if c.tag in ("td", "th") else [c], depth + 1).split()), _span(c)) for c in row] for row in rows]
    width: dict[int, int] = {}
    for row in texts:
        at = 0
        for text, span in row:
            if span == 1 and len(text) <= PAD:
                width[at] = max(width.get(at, 0), len(text))
            at += span
    for row in texts:
        parts, at = [], 0
        for text, span in row:
            room = sum(width.get(c, 0) for c in range(at, at + span)) + 2 * (span - 1)
            parts.append(text.ljust(min(room, PAD * span)))
            at += span
        line = "  ".join(parts).rstrip()
        if line:
            lines.append(line)
    return lines


def render(nodes: list, depth: int = 0) -> str:
    """Text of nodes, top to bottom; no recursion but for the tables in it."""
    out = Layout()
    todo: list[tuple] = [("node", n) for n in reversed(nodes)]
    keep = 0
    counters: list[list] = []
    while todo:
        what, x = todo.pop()
        if what == "end":
            tag = x.tag
            if tag in BLOCKS:
                out.line()
                out.gap = out.gap or tag in SPACED and not (tag in ("ul", "ol", "dir", "menu") and len(counters) > 1)
            if tag in ("ul", "ol", "dir", "menu"):
                counters.pop()
            elif tag == "li":
                if out.marker is not None:  # an empty item
                    out.word("")
                    out.line()
                out.indent.pop()
            elif tag in ("dd", "blockquote"):
                out.indent.pop()
            elif tag in ("pre", "listing", "xmp", "plaintext", "textarea"):
                keep -= 1
            continue
        if isinstance(x, str):
            out.verbatim(x) if keep else out.flow(x)
            continue
        tag = x.tag
        if x.hidden:
            continue
        if tag == "br":
            if not out.parts:
                out.word("")
            out.line()
            continue
        if tag == "input":
            if x.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                out.flow(x.attrs.get("value", ""))
            continue
        if tag in BLOCKS:
            out.line()
            out.gap = out.gap or tag in SPACED and not (tag in ("ul", "ol", "dir", "menu") and counters)
        if tag == "hr":
            out.word("---")
            out.line()
            out.gap = True
            continue
        if tag == "table" and depth < NESTED_TABLES:
            for line in table_lines(x, depth):
                out.word(line)
                out.line()
            out.gap = True
            continue
        if tag in ("td", "th", "button", "label", "select"):
            out.space = bool(out.parts)
        if tag in ("ul", "ol", "dir", "menu"):
            start = x.attrs.get("start", "1")
            counters.append([tag, int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
        elif tag == "li":
            if counters and counters[-1][0] == "ol":
                mark = f"{counters[-1][1]}. "
                counters[-1][1] += 1
            else:
                mark = "- "
            out.marker = mark
            out.indent.append(" " * len(mark))
        elif tag in ("dd", "blockquote"):
            out.indent.append("  ")
        elif tag in ("pre", "listing", "xmp", "plaintext", "textarea"):
            keep += 1
        todo.append(("end", x))
        todo += [("node", n) for n in reversed(x.children)]
    return out.text()


def visible_text(source: str | None) -> str | None:
    """The text a reader of the page would see; NULL for NULL, empty for a page without any."""
    if source is None:
        return None
    return render(Builder(source.replace("\r\n", "\n").replace("\r", "\n").replace("\0", "")).root.children)


def extract(page: Column) -> Column:
    """Visible text of a column of pages.

    Every page is parsed on its own and whole, in memory in proportion to its size; broken markup
    never fails but is read as a browser would, roughly.  NULL pages give NULL, pages without
    visible text an empty text; repeated rows give equal texts.
    """

    def run(pages: pa.Array) -> pa.Array:
        def texts() -> Iterator[str | None]:
            for page in pages:
                yield visible_text(page.as_py())

        return pa.array(texts(), pa.string())

    return F.arrow_udf(run, "string")(page.cast("string"))
