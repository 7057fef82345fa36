"""HTML extraction: layout-aware rendering.

A tree builder reads the markup with the implied tags of HTML (an open paragraph ends at the next block,
a list item at the next item, a cell at the next cell or row, and so on).  A renderer walks the tree and
emits all visible text: nothing from scripts, styles, templates, hidden elements or closed details, nor
from what the page's own simple style rules (of tags, classes and ids, without combinators) do not display on a
screen of ``SCREEN`` pixels; of several rules the cascade decides.  Blocks stand on lines of their own with a
blank line between paragraphs, list items have their marker and indent, table cells are padded so that
columns line up, preformatted text keeps its spacing.  Formulas (math) and the labels of drawings (text and
foreign objects of svg) run in the line, labels, cells and parts of fractions apart by a space.

Defined results: null or empty markup gives an empty text; markup of any depth is walked without
recursion; rows that repeat an id are rendered each by its own markup; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title iframe noembed noframes audio video canvas datalist".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table ul xmp".split())
#: blocks with a blank line around them
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul xmp".split())
#: not shown inside svg or math
UNDRAWN = {"svg": frozenset("defs metadata title desc symbol clippath mask pattern marker lineargradient radialgradient filter".split()),
           "math": frozenset("annotation annotation-xml mphantom".split())}
_MATH = frozenset("math semantics mrow mstyle mpadded merror menclose mtd mtable mtr mlabeledtr mfrac msup msub msubsup munder mover munderover "
                  "mmultiscripts msqrt mroot mfenced maction".split())
#: a start tag closes these open elements, as far as the nearest of the limits
CLOSES = {
    **{t: (("p",), ("button", "table", "td", "th", "caption", "object")) for t in
       "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
       "header hgroup hr main menu nav ol p pre section table ul".split()},
    "li": (("li", "p"), ("ul", "ol", "menu", "table", "td", "th")),
    "dt": (("dt", "dd", "p"), ("dl", "table", "td", "th")), "dd": (("dt", "dd", "p"), ("dl", "table", "td", "th")),
    "option": (("option",), ("select", "datalist", "optgroup")), "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th", "caption", "colgroup", "p", "li"), ("table",)),
    "td": (("td", "th", "p", "li"), ("tr", "table")), "th": (("td", "th", "p", "li"), ("tr", "table")),
    **{t: (("tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup", "p", "li"), ("table",)) for t in ("thead", "tbody", "tfoot")},
    "a": (("a",), ("table", "td", "th", "button", "object")), "button": (("button",), ("table", "td", "th", "object")),
}
#: an end tag is not looked for beyond these
_END_LIMIT = {"td": ("table",), "th": ("table",), "tr": ("table",), "li": ("ul", "ol", "menu")}
#: one token from any place on; nothing is tried twice, so reading a page takes time in proportion to its length.  A
#: quote opens a value only behind "="; a comment or a tag that nothing closes goes on to the end of the page
_PLAIN = (r"<!--(.*?)(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)"
          r"((?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+|)|[^=>])*+)(>|\Z)|[^<]+|<")
_TOKEN, _WITH_CDATA = re.compile(_PLAIN, re.S), re.compile(r"<!\[CDATA\[.*?\]\]>|" + _PLAIN, re.S)
#: elements are nested no deeper; what lies deeper stands side by side at this depth, as in browsers
MAX_DEPTH = 512
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
#: comments, strings and addresses of a style sheet
_OPAQUE = re.compile(r"/\*.*?(?:\*/|$)|\"(?:\\.|[^\"\\\n])*\"?|'(?:\\.|[^'\\\n])*'?|\burl\([^)]*\)?|<!--|-->", re.S)
_SELECTOR = re.compile(r"\*?(?:[\w-]+)?(?:[.#][\w-]+)*")
_SHOWS = re.compile(r"(display|visibility)\s*:\s*([\w-]+)[^!]*(!\s*important)?", re.I)
#: width and height of the screen that media rules are read for
SCREEN = {"width": 1280, "height": 800}
_LENGTH = re.compile(r"(\d*\.?\d+)(px|em|rem)?")
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if text and not text.isspace():
        for name, a, b, c in _ATTR.findall(text):
            out.setdefault(name.lower(), unescape(a or b or c))
    return out


def build_tree(html: str) -> tuple[Node, list[str]]:
    """(root, style sheets); children are nodes and strings."""
    root = Node("html", {})
    stack, sheets = [root], []
    opened: Counter[str] = Counter()  # the tags in the stack, so that a tag that is not open is not looked for

    def cut_off(place: int) -> None:
        opened.subtract(n.tag for n in stack[place:])
        del stack[place:]

    def enter(node: Node) -> None:
        if len(stack) < MAX_DEPTH:
            stack.append(node)
            opened[node.tag] += 1

    at, last_cdata = 0, html.rfind("]]>")
    while at < len(html):
        m = (_WITH_CDATA if at < last_cdata else _TOKEN).match(html, at)
        at = m.end()
        name = m.group(3)
        if name is None:
            text = m.group()
            if text.startswith(("<!", "<?")):
                continue
            if stack[-1].tag in ("table", "tbody", "thead", "tfoot", "tr"):
                if not text.isspace():  # text between cells is shown before the table
                    table = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "table"), 0)
                    if table:
                        stack[table - 1].children.insert(-1, unescape(text))
                    else:
                        stack[-1].children.append(unescape(text))
                continue
            stack[-1].children.append(unescape(text))
            continue
        if not m.group(5):  # the page ends within a tag: no browser shows the rest
            break
        tag = name.lower()
        if m.group(2):  # an end tag
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
            elif tag == "p" and not opened["p"]:
                stack[-1].children.append(Node("p", {}))
            elif opened[tag] > 0:
                limits = _END_LIMIT.get(tag, ("td", "th") if tag not in ("table", "tbody", "thead", "tfoot", "body", "html") else ())
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        cut_off(i)
                        break
                    if stack[i].tag in limits:
                        break
            continue
        if tag in ("html", "body"):
            if tag == "body":
                while len(stack) > 1 and opened["head"] > 0:
                    cut_off(len(stack) - 1)
            stack[0].attrs |= _attributes(m.group(4))
            continue
        if stack[-1].tag == "head" and tag not in ("title", "meta", "link", "style", "script", "base", "noscript", "template"):
            cut_off(len(stack) - 1)
        closes, limits = CLOSES.get(tag, ((), ()))
        if any(opened[c] > 0 for c in closes):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in limits:
                    break
                if stack[i].tag in closes:
                    cut = i
                    while cut - 1 > 0 and stack[cut - 1].tag in closes:
                        cut -= 1
                    cut_off(cut)
                    break
                if tag in ("li", "dt", "dd", "tr", "td", "th") or stack[i].tag not in BLOCK:
                    continue
                break
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            enter(_add(stack, Node("tr", {})))
        node = _add(stack, Node(tag, _attributes(m.group(4))))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            text = html[at: end.start() if end else len(html)]
            at = end.end() if end else len(html)
            if tag == "style":
                media = node.attrs.get("media", "").strip()
                if not media or on_screen(media):
                    sheets.append(text)
            elif tag in ("textarea", "xmp"):
                node.children.append(unescape(text) if tag == "textarea" else text)
        elif tag not in VOID and not m.group(4).endswith("/") or tag in ("div", "p", "span"):
            enter(node)
    return root, sheets


def _add(stack: list[Node], node: Node) -> Node:
    stack[-1].children.append(node)
    return node


def _feature_holds(feature: str) -> bool:
    """A media feature, such as ``max-width: 600px`` or ``600px <= width``, on a wide colour screen; False where unknown."""
    feature = feature.strip().lower()
    name, _, value = (x.strip() for x in feature.partition(":"))
    if value:
        if m := re.fullmatch(r"(min-|max-)?(?:device-)?(width|height)", name):
            length = _LENGTH.fullmatch(value)
            if not length:
                return False
            size, pixels = SCREEN[m.group(2)], float(length.group(1)) * (16 if length.group(2) in ("em", "rem") else 1)
            return size >= pixels if m.group(1) == "min-" else size <= pixels if m.group(1) == "max-" else size == pixels
        return (name, value) in {("orientation", "landscape"), ("hover", "hover"), ("any-hover", "hover"), ("pointer", "fine"), ("any-pointer", "fine"),
                                 ("prefers-color-scheme", "light"), ("prefers-reduced-motion", "no-preference"), ("scripting", "none")}
    parts = re.split(r"\s*(<=|>=|<|>|=)\s*", feature)
    if len(parts) < 3:
        return feature in ("width", "height", "color", "hover", "any-hover", "pointer", "any-pointer")
    values = []
    for part in parts[::2]:
        length = _LENGTH.fullmatch(part)
        values.append(SCREEN[part] if part in SCREEN else float(length.group(1)) * (16 if length.group(2) in ("em", "rem") else 1) if length else None)
    if None in values:
        return False
    return all({"<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y, "=": x == y}[sign] for x, sign, y in zip(values, parts[1::2], values[1:]))


def on_screen(media: str) -> bool:
    """Whether one of the media queries holds on the screen."""
    for query in media.lower().split(","):
        query = query.strip()
        negated = re.match(r"not\s+(?!\()|not\s*\((?=[^()]*\)$)", query)
        body = re.sub(r"^(?:not|only)\b\s*", "", query)
        features = re.findall(r"\(([^()]*)\)", body)
        kind = re.match(r"[\w-]+", body)
        holds = not kind or kind.group() in ("all", "screen")
        joined = any if re.search(r"\)\s*or\s*\(", body) else all
        if features:
            holds = holds and joined(map(_feature_holds, features))
        if holds != bool(negated):
            return True
    return False


class StyleRules:
    """What the simple rules of style sheets say of display and visibility, by the parts of their selectors."""

    def __init__(self, sheets: list[str]):
        #: one part of a selector -> (all its parts, property, rank in the cascade, hidden)
        self.rules: dict[str, list[tuple[frozenset[str], str, tuple, bool]]] = {}
        self.n = 0
        for sheet in sheets:
            self._read(_OPAQUE.sub(" ", sheet))

    def _read(self, sheet: str) -> None:
        """Rules on the screen; the bodies of other media and of at-rules without selectors are left out."""
        blocks: list[tuple[str, bool, str]] = []  # kind, whether it holds, selectors
        declared: list[str] = []
        for text, sign in re.findall(r"([^{};]*)([{};]|$)", sheet):
            kind, holds, selectors = blocks[-1] if blocks else ("group", True, "")
            if kind == "rule":
                declared.append(text)
            if sign == "{":
                prelude = text.strip()
                name, _, rest = re.sub(r"^@([\w-]+)", r"\1 ", prelude).partition(" ") if prelude.startswith("@") else ("", "", "")
                if kind != "group":
                    if kind == "rule":
                        declared.pop()
                    blocks.append(("other", False, ""))
                elif name:
                    group = {"media": on_screen(rest), "supports": not rest.strip().startswith("not"), "layer": True}.get(name.lower())
                    blocks.append(("other", False, "") if group is None else ("group", holds and group, ""))
                else:
                    blocks.append(("rule", holds, prelude))
                    declared = []
            elif sign == "}" and blocks:
                blocks.pop()
                if kind == "rule" and holds:
                    self._add(selectors, declared)
            elif not sign and kind == "rule" and holds:  # the sheet ends in an open rule
                self._add(selectors, declared)
                break

    def _add(self, selectors: str, declared: list[str]) -> None:
        for m in filter(None, (_SHOWS.match(x.strip()) for x in declared)):
            name, value = m.group(1).lower(), m.group(2).lower()
            hidden = value == "none" if name == "display" else value in ("hidden", "collapse")
            for selector in map(str.strip, selectors.split(",")):
                parts = frozenset(p if p[0] in ".#" else p.lower() for p in re.findall(r"[.#]?[\w-]+", selector))
                if parts and _SELECTOR.fullmatch(selector):
                    ids, classes = (sum(p[0] == c for p in parts) for c in "#.")
                    self.n += 1
                    rank = (bool(m.group(3)), False, ids, classes, len(parts) - ids - classes, self.n)
                    self.rules.setdefault(min(parts), []).append((parts, name, rank, hidden))

    def hide(self, node: Node) -> bool:
        a = node.attrs
        best: dict[str, tuple[tuple, bool]] = {}
        for m in filter(None, (_SHOWS.match(x.strip()) for x in a.get("style", "").split(";"))):
            name, value = m.group(1).lower(), m.group(2).lower()
            hidden = value == "none" if name == "display" else value in ("hidden", "collapse")
            rank = (bool(m.group(3)), True)
            if rank >= best.get(name, ((), False))[0]:
                best[name] = rank, hidden
        if self.rules:
            names = {node.tag} | {"." + c for c in a.get("class", "").split()} | ({"#" + a["id"]} if a.get("id") else set())
            for part in names & self.rules.keys():
                for parts, name, rank, hidden in self.rules[part]:
                    if parts <= names and rank > best.get(name, ((), False))[0]:
                        best[name] = rank, hidden
        return any(hidden for _, hidden in best.values())


def visible(node: Node, rules: StyleRules) -> bool:
    a = node.attrs
    if node.tag in UNSEEN or "hidden" in a or node.tag == "object" and "data" in a:  # an object without data shows what it holds
        return False
    if node.tag == "input" and a.get("type", "text").lower() in ("hidden", "password", "checkbox", "radio", "file", "image"):
        return False
    return not (rules.rules or "style" in a) or not rules.hide(node)


class Lines:
    """Lines of a block in the making: white space collapses, gaps between blocks do not add up."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.gap, self.space = "", 0, False
        self.prefix: list[str] = []  # indents of open lists and quotes
        self.marker = ""  # of a list item whose first line is still to come

    def text(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self._put(first, pre=True)
            for line in rest:
                self.end_line(keep=True)
                self._put(line, pre=True)
            return
        words = _BLANKS.sub(" ", text)
        if words.startswith(" "):
            self.space = bool(self.line)
            words = words[1:]
        if not words:
            return
        more = words.endswith(" ")
        self._put((" " if self.space and self.line else "") + words.rstrip(" "))
        self.space = more

    def _put(self, text: str, pre: bool = False) -> None:
        if not text and not pre:
            return
        if not self.line:
            if self.gap and self.lines:
                self.lines += [""] * (self.gap - 1)
            self.gap = 0
        self.line += text

    def end_line(self, keep: bool = False) -> None:
        self.space = False
        if self.line or keep:
            indent = "".join(self.prefix)
            if self.marker:
                indent = indent[: -len(self.marker)] + self.marker
                self.marker = ""
            self.lines.append((indent + self.line).rstrip())
            self.line = ""

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = max(self.gap, 2 if spaced else 1)

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


class _Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.caption: list[str] = []

    def render(self) -> list[str]:
        """Rows of padded cells; a cell may span rows and columns."""
        grid: dict[tuple[int, int], tuple[list[str], int]] = {}
        taken: set[tuple[int, int]] = set()
        for r, row in enumerate(self.rows):
            c = 0
            for lines, across, down in row:
                while (r, c) in taken:
                    c += 1
                grid[r, c] = (lines, across)
                taken |= {(r + i, c + j) for i in range(down) for j in range(across)}
                c += across
        width: dict[int, int] = {}
        for (_, c), (lines, across) in grid.items():
            if across == 1:
                width[c] = max(width.get(c, 0), max(map(len, lines), default=0))
        out = list(self.caption)
        for r in range(len(self.rows)):
            cells = sorted((c, *grid[r, c]) for c in {c for rr, c in grid if rr == r})
            for i in range(max((len(lines) for _, lines, _ in cells), default=0)):
                line, at = "", 0
                for c, lines, _ in cells:
                    start = sum(width.get(x, 0) + 2 for x in range(c))
                    line = line.ljust(start if start > at or not line else len(line) + 2)
                    line += lines[i] if i < len(lines) else ""
                    at = len(line)
                out.append(line.rstrip())
        return out


def _span(node: Node, name: str) -> int:
    value = node.attrs.get(name, "1").strip()
    return min(100, max(1, int(value))) if value.isascii() and value.isdigit() else 1


def _whole(text: str | None, otherwise: int) -> int:
    text = (text or "").strip()
    return int(text) if re.fullmatch(r"[-+]?\d{1,9}", text) else otherwise


def _numeral(n: int, kind: str) -> str:
    """The number of a list item in the ``type`` of its list: 1, a, A, i, I; plain digits where a type has no such number."""
    if kind in ("a", "A") and n > 0:
        letters = ""
        while n:
            n, digit = divmod(n - 1, 26)
            letters = chr(ord(kind) + digit) + letters
        return letters
    if kind in ("i", "I") and 0 < n < 4000:
        units = ("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")
        roman = "m" * (n // 1000) + "".join(units[n // place % 10].translate(str.maketrans("ivx", signs)) for place, signs in ((100, "cdm"), (10, "xlc"), (1, "ivx")))
        return roman if kind == "i" else roman.upper()
    return str(n)


def render(html: str) -> str:
    root, sheets = build_tree(html)
    rules = StyleRules(sheets)
    out: list[Lines] = [Lines()]
    tables: list[_Table] = []
    lists: list[list] = []  # marker kind and next number
    pre = 0
    todo: list[tuple[object, bool]] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        to = out[-1]
        if isinstance(node, str):
            to.text(node, pre > 0)
            continue
        tag = node.tag
        if not leaving:
            if not visible(node, rules):
                continue
            if tag == "br":
                if to.line:
                    to.end_line()
                else:
                    to.end_line(keep=True) if to.lines and not to.gap else None
                continue
            if tag == "img":
                to.text(node.attrs.get("alt", ""), False)
                continue
            if tag == "input":
                to.text(node.attrs.get("value") or node.attrs.get("placeholder", ""), False)
                continue
            if tag == "wbr":
                continue
            children = node.children
            if tag == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            if tag == "select":
                options = [c for c in _options(node)]
                chosen = [c for c in options if "selected" in c.attrs] or options[:1]
                children = chosen
            if tag == "svg":
                children = _labels(node, rules)
            elif tag == "text":
                children = [c for c in children if not isinstance(c, Node) or c.tag not in UNDRAWN["svg"]]
            elif tag == "tspan" and node.attrs.keys() & {"x", "y", "dy"}:
                children = [" ", *children]
            elif tag in _MATH:
                children = _formula(node)
            if tag in BLOCK:
                nested = tag in ("ul", "ol", "menu", "dl") and bool(lists)
                to.block(tag in SPACED and not nested)
            if tag in ("ul", "menu", "dir"):
                lists.append(["-", 0, 1])
            elif tag == "ol":
                items = sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
                down = "reversed" in node.attrs
                lists.append([node.attrs.get("type", "1").strip() or "1", _whole(node.attrs.get("start"), items if down else 1), -1 if down else 1])
            elif tag == "li":
                kind = lists[-1] if lists else ["-", 0, 1]
                if kind[0] != "-":
                    kind[1] = _whole(node.attrs.get("value"), kind[1])
                marker = "- " if kind[0] == "-" else f"{_numeral(kind[1], kind[0])}. "
                kind[1] += kind[2]
                to.prefix.append(" " * len(marker))
                to.marker = marker
            elif tag == "dd":
                to.prefix.append("    ")
            elif tag == "blockquote":
                to.prefix.append("> ")
            elif tag in ("pre", "textarea", "xmp"):
                pre += 1
            elif tag == "table":
                tables.append(_Table())
            elif tag == "tr" and tables:
                tables[-1].rows.append([])
            elif tag in ("td", "th", "caption") and tables:
                out.append(Lines())
            elif tag == "q":
                to.text("“", False)
            todo.append((node, True))
            todo += [(c, False) for c in reversed(children)]
            continue
        # leaving
        if tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        elif tag == "li":
            if to.marker and not to.line:
                to.line = ""
            to.end_line()
            to.marker = ""
            to.prefix.pop()
        elif tag in ("dd", "blockquote"):
            to.end_line()
            to.prefix.pop()
        elif tag in ("pre", "textarea", "xmp"):
            pre -= 1
        elif tag in ("td", "th") and tables:
            lines = out.pop().result()
            if not tables[-1].rows:
                tables[-1].rows.append([])
            tables[-1].rows[-1].append((lines, _span(node, "colspan"), _span(node, "rowspan")))
        elif tag == "caption" and tables:
            tables[-1].caption += out.pop().result()
        elif tag == "table":
            lines = tables.pop().render()
            to = out[-1]
            for line in lines:
                to._put(line, pre=True)
                to.end_line(keep=True)
        elif tag == "q":
            to.text("”", False)
        if tag in BLOCK:
            nested = tag in ("ul", "ol", "menu", "dl") and bool(lists)
            out[-1].block(tag in SPACED and not nested)
    return "\n".join(out[0].result()).strip("\n")


def _labels(svg: Node, rules: StyleRules) -> list[Node | str]:
    """The shown text and foreign objects of a drawing, apart by a space."""
    found, todo = [], list(reversed(svg.children))
    while todo:
        c = todo.pop()
        if isinstance(c, Node) and c.tag not in UNDRAWN["svg"] and visible(c, rules):
            if c.tag in ("text", "foreignobject"):
                found += [" ", c]
            else:
                todo += reversed(c.children)
    return [*found, " "] if found else []


def _formula(node: Node) -> list[Node | str]:
    """The shown children of an element of a formula."""
    shown = [c for c in node.children if not isinstance(c, Node) or c.tag not in UNDRAWN["math"]]
    if node.tag in ("mtable", "mtr", "mlabeledtr", "mfrac"):
        return [x for c in shown if isinstance(c, Node) for x in (" ", c)] + [" "]
    return shown


def _options(node: Node) -> list[Node]:
    found, todo = [], list(node.children)
    while todo:
        c = todo.pop(0)
        if isinstance(c, Node):
            if c.tag == "option":
                found.append(c)
            else:
                todo = list(c.children) + todo
    return found


def html_text(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text (visible, laid out) and n_lines; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [render(h or "") for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                                             ["page_id", "text", "n_lines"])

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, text string, n_lines long")
