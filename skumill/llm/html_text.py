"""Visible text of HTML pages with its layout: blocks, lists and aligned tables.

A page is cut into tags, comments and text, and built into a tree with the usual
implied tags: void elements have no content, text and body elements end an open head,
block elements end an open paragraph, list items, table cells, rows, options and definition entries end
their open siblings, and what is still open at the end is closed.  Rendering
walks the tree without recursion, so any depth of nesting works.

Not visible: head, script, style, template and the like, the choices of a select,
comments, a closed dialog, what a closed details holds behind its summary, and elements
with a hidden attribute, type="hidden" or display:none.  An object shows what it holds for those who cannot show it.  visibility:hidden hides text down to
elements that turn it visible again; what is hidden that way keeps its table cells.
Both properties are read from style attributes and from the page's own style rules
whose selectors name tags, classes and ids, also of ancestors and parents.  An ordered
list counts as its start, reversed and type and its items' values say.

Table cells stand in a grid: a cell that spans rows or columns keeps its places, and
columns are as wide as their text is shown, wide characters counting as two.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import refuse_clashes
from .textscan import column_bytes, slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes audio video canvas svg annotation annotation-xml select datalist meta link title base param".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks with a blank line before and after.
SPACED = HEADINGS | frozenset("p blockquote pre ul ol dl table figure hr".split())
BLOCK = SPACED | frozenset("address article aside body center details dd div dt fieldset figcaption footer form header html legend li main menu nav section summary caption tr tbody thead tfoot td th option".split())
#: An opening tag ends these open siblings, looked for inside the scope.
ENDS = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "tr": ("tr", ("table",)),
    "tbody": ("tbody thead tfoot caption colgroup", ("table",)),
    "thead": ("tbody thead tfoot caption colgroup", ("table",)),
    "tfoot": ("tbody thead tfoot caption colgroup", ("table",)),
    "option": ("option", ("select", "datalist", "optgroup")),
    "optgroup": ("optgroup", ("select",)),
}
ENDS = {k: (frozenset(v.split()), frozenset(s)) for k, (v, s) in ENDS.items()}
_CELLS, _ROW, _TABLE = frozenset(("td", "th")), frozenset(("tr",)), frozenset(("table",))
#: What a head may hold; any other tag and text end it.
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
#: Content of these inside a head is no text of its body.
_OWN_TEXT = frozenset(("template", "noscript"))
#: An end tag does not reach through these.
SCOPES = frozenset("table td th caption html body".split())

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>\"']*)")
_PLAIN = re.compile(r"[^>\"']*")
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_LOOK = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)", re.I)
_COMPOUND = re.compile(r"(\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)", re.I)
#: Inputs that show their value as a label.
BUTTONS = frozenset("submit button reset".split())


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None) -> None:
        self.tag, self.attrs, self.kids = tag, attrs or {}, []


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if text.strip(" \t\n\r\f/"):
        for name, a, b, c in _ATTR.findall(text):
            out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


class _Cutter:
    """Tags and text of a page in order, in time proportional to its length."""

    def __init__(self, page: str) -> None:
        self.page, self.at, self.last, self.quotes = page, 0, page.rfind(">"), True

    def tag_end(self, at: int) -> int:
        """The place of the > that ends a tag, outside quotes, from a quote at `at`; -1 if a quote stays open."""
        while at < len(self.page) and self.page[at] != ">":
            at = self.page.find(self.page[at], at + 1)
            if at < 0:
                return -1
            at = _PLAIN.match(self.page, at + 1).end()
        return at if at < len(self.page) else -1

    def next(self) -> tuple[str, str, str, str] | None:
        """(text before, slash, tag, attributes); the tag is empty where a comment or the end follows."""
        page, start = self.page, self.at
        while (lt := page.find("<", self.at)) >= 0 and lt < self.last:
            m = _OPEN.match(page, lt)
            if m is None:
                c = _COMMENT.match(page, lt)
                if c is None:
                    self.at = lt + 1  # a bare <
                    continue
                self.at = c.end()
                return page[start:lt], "", "", ""
            end = m.end()
            if end < len(page) and page[end] != ">":
                stop = self.tag_end(end) if self.quotes else -1
                self.quotes = stop >= 0  # after an open quote every tag ends at its first >
                end = stop if stop >= 0 else page.find(">", end)
            self.at = end + 1
            return page[start:lt], m[1], m[2].lower(), page[m.start(3) : end]
        if start >= len(page):
            return None
        self.at = len(page)
        if 0 <= lt and page.startswith("<!--", lt):
            return page[start:lt], "", "", ""
        return page[start:], "", "", ""


def build_tree(page: str) -> Node:
    """The element tree of a page; its root has no tag."""
    root = Node("")
    stack = [root]
    opened: dict[str, int] = {}
    cutter, lower = _Cutter(page), ""
    ended = 0  # paragraphs that blocks have ended and whose own end tag may still come

    def close(to: int) -> None:
        for node in stack[to:]:
            opened[node.tag] -= 1
        del stack[to:]

    def push(node: Node) -> None:
        stack[-1].kids.append(node)
        stack.append(node)
        opened[node.tag] = opened.get(node.tag, 0) + 1

    def close_sibling(tags: frozenset, scope: frozenset) -> None:
        if any(opened.get(t) for t in tags):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in tags:
                    return close(i)
                if stack[i].tag in scope:
                    return None
        return None

    def end_head() -> None:
        if opened.get("head") and not any(opened.get(t) for t in _OWN_TEXT):
            close(next(i for i, node in enumerate(stack) if node.tag == "head"))

    while (got := cutter.next()) is not None:
        text, slash, tag, attrs = got
        if text and not text.isspace():
            end_head()
        if text:
            stack[-1].kids.append(html.unescape(text))
        if not tag:
            continue
        if slash:
            names, found = HEADINGS if tag in HEADINGS else (tag,), False
            if any(opened.get(t) for t in names):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in names:
                        close(i)
                        found = True
                        break
                    if stack[i].tag in SCOPES and tag not in SCOPES and tag not in ("tr", "tbody", "thead", "tfoot"):
                        break
            if tag == "p" and not found and ended:  # its paragraph has been ended by a block: this is an empty one
                ended -= 1
                stack[-1].kids.append(Node("p"))
            continue
        if tag not in IN_HEAD:
            end_head()
        if tag in BLOCK and opened.get("p"):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    ended += tag != "p"
                    break
                if stack[i].tag in SCOPES or stack[i].tag in BLOCK:
                    break
        if tag in ENDS:
            if tag in ("tr", "tbody", "thead", "tfoot"):
                close_sibling(_CELLS, _TABLE)
                if tag != "tr":
                    close_sibling(_ROW, _TABLE)
            close_sibling(*ENDS[tag])
            if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                push(Node("tr"))
        node = Node(tag, _attributes(attrs))
        if tag in RAW:
            stack[-1].kids.append(node)
            if not lower:
                lower = page.lower()
                if len(lower) != len(page):  # lower case changed the length of some character
                    lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in page)
            end = lower.find(f"</{tag}", cutter.at)
            end = len(page) if end < 0 else end
            body = page[cutter.at : end]
            node.kids.append(html.unescape(body) if tag in ("textarea", "title") else body)
            if tag == "style":
                root.attrs["css"] = root.attrs.get("css", "") + body + "\n"
            stop = page.find(">", end)
            cutter.at = len(page) if stop < 0 else stop + 1
        elif tag in VOID:
            stack[-1].kids.append(node)
        else:
            push(node)
    return root


Compound = tuple[str, frozenset[str], frozenset[str]]


def _selector(text: str) -> tuple[list[tuple[str, Compound]], int] | None:
    """The compounds of a selector from the right, each with what stands left of it (">" or " "), and its weight; None for other selectors."""
    out, weight, parts = [], 0, re.sub(r"\s*>\s*", " > ", text.strip()).split()
    for k, part in enumerate(parts):
        if part == ">":
            if k in (0, len(parts) - 1) or parts[k - 1] == ">":
                return None
            continue
        m = _COMPOUND.fullmatch(part)
        if not m:
            return None
        names = re.findall(r"([.#])([\w-]+)", m[2])
        tag = "" if m[1] in (None, "*") else m[1].lower()
        ids, classes = (frozenset(n for kind, n in names if kind == which) for which in "#.")
        weight += 100 * len(ids) + 10 * len(classes) + bool(tag)
        out.append((">" if k and parts[k - 1] == ">" else " ", (tag, ids, classes)))
    return (out[::-1], weight) if out else None


def style_rules(css: str) -> dict[tuple[str, str], list[tuple[tuple[int, int], list[tuple[str, Compound]], dict[str, str]]]]:
    """By ("." or "#" or "", name) of the element itself: (weight, selector, display and visibility) of the rules for tags, classes and ids.

    Rules inside @media and the like are left out.
    """
    rules: dict[tuple[str, str], list] = {}
    css = re.sub(r"/\*.*?(?:\*/|\Z)", "", css, flags=re.S)
    depth, at, head, order = 0, 0, "", 0
    for m in re.finditer(r"[{}]", css):
        if m[0] == "{":
            if not depth:
                head = css[at : m.start()].rsplit(";", 1)[-1].strip()
            depth, at = depth + 1, m.end()
            continue
        if depth == 1 and not head.startswith("@") and (found := {k.lower(): v.lower() for k, v in _LOOK.findall(css[at : m.start()])}):
            for selector in head.split(","):
                if one := _selector(selector):
                    tag, ids, classes = one[0][0][1]
                    key = ("#", min(ids)) if ids else (".", min(classes)) if classes else ("", tag)
                    rules.setdefault(key, []).append(((one[1], order), one[0], found))
            order += 1
        depth, at = max(0, depth - 1), m.end()
    return rules


def _is(node: Node, compound: Compound) -> bool:
    tag, ids, classes = compound
    return tag in ("", node.tag) and (not ids or ids == {node.attrs.get("id")}) and (not classes or classes <= set(node.attrs.get("class", "").split()))


def _fits(node: Node, selector: list[tuple[str, Compound]], path: list[Node]) -> bool:
    """Whether a selector fits a node below `path`: the nearest fitting ancestor is taken, or any further one where that leads nowhere."""
    if not _is(node, selector[0][1]):
        return False
    tries = [(1, len(path))]  # next compound, ancestors that may still fit
    while tries:
        k, n = tries.pop()
        if k == len(selector):
            return True
        for i in range(n - 1, -1 if selector[k - 1][0] == " " else max(-1, n - 2), -1):
            if path[i].tag and _is(path[i], selector[k][1]):
                if selector[k - 1][0] == " " and i:
                    tries.append((k, i))
                tries.append((k + 1, i))
                break
    return False


def looks(node: Node, rules: dict, path: list[Node]) -> dict[str, str]:
    """The display and visibility that a node's style attribute, else the rules give it; `path` are its ancestors."""
    a = node.attrs
    out: dict[str, str] = {}
    if rules:
        keys = [("", node.tag), ("", ""), *[("#", i) for i in (a.get("id"),) if i], *[(".", c) for c in set(a.get("class", "").split())]]
        for _, _, found in sorted((r for k in keys for r in rules.get(k, ()) if _fits(node, r[1], path)), key=lambda r: r[0]):
            out |= found
    if "style" in a:
        out |= {k.lower(): v.lower() for k, v in _LOOK.findall(a["style"])}
    return out


def numeral(n: int, kind: str) -> str:
    """A list number in a type: 1, a, A, i or I; what letters or Roman numbers cannot write stays a number."""
    if kind in ("a", "A") and n > 0:
        out = ""
        while n:
            n, k = divmod(n - 1, 26)
            out = chr(97 + k) + out
    elif kind in ("i", "I") and 0 < n < 4000:
        out = ""
        for value, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "m cm d cd c xc l xl x ix v iv i".split(), strict=True):
            out += sign * (n // value)
            n %= value
    else:
        return str(n)
    return out.upper() if kind.isupper() else out


def hidden(node: Node, look: dict[str, str]) -> bool:
    a = node.attrs
    return node.tag in UNSEEN or "hidden" in a or node.tag == "dialog" and "open" not in a or look.get("display") == "none" or node.tag == "input" and a.get("type", "").lower() == "hidden"


def _whole(text: str, otherwise: int) -> int:
    return int(text) if re.fullmatch(r"\s*[-+]?\d{1,9}\s*", text) else otherwise


class _Lines:
    """Lines of text with collapsed white space and pending block margins."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False
        self.blank = False
        self.indent: list[str] = [""]
        self.mark = ""

    def text(self, s: str) -> None:
        body = _SPACE.sub(" ", s)
        if not body:
            return
        if body[0] == " ":
            self.space = True
            body = body[1:]
        if not body:
            return
        if self.space and self.now:
            self.now.append(" ")
        self.space = body[-1] == " "
        self.now.append(body[:-1] if self.space else body)

    def exact(self, s: str) -> None:
        for i, line in enumerate(s.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if i:
                self.flush(True)
            self.now.append(line)

    def flush(self, always: bool = False) -> None:
        """End the current line, if it has text."""
        line = "".join(self.now)
        self.now, self.space = [], False
        if line or always:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.append(((self.mark or self.indent[-1]) + line).rstrip())
            self.mark = ""

    def margin(self, blank: bool) -> None:
        self.flush()
        self.blank = self.blank or blank

    def put(self, lines: list[str]) -> None:
        self.flush()
        for line in lines:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.append(((self.mark or self.indent[-1]) + line).rstrip())
            self.mark = ""

    def done(self) -> list[str]:
        self.flush()
        return self.lines


def shown_width(s: str) -> int:
    """Columns that a text takes: two for a wide character, none for a combining or format one."""
    if s.isascii():
        return len(s)
    return sum(0 if unicodedata.category(c) in ("Mn", "Me", "Cf") else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def placed(rows: list[list[tuple[list[str], int, int]]]) -> list[list[tuple[int, int, list[str]]]]:
    """(first column, columns, lines) of the cells of each row; cells are (lines, columns, rows), no rows mean all that follow."""
    busy: list[int] = []  # the row from which each column is free again
    out = []
    for r, row in enumerate(rows):
        own, c = [], 0
        for lines, span, down in row:
            while c < len(busy) and busy[c] > r:
                c += 1
            busy += [0] * (c + span - len(busy))
            for k in range(c, c + span):
                busy[k] = max(busy[k], r + down if down else len(rows))
            own.append((c, span, lines))
            c += span
        out.append(own)
    return out


def aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table: cells (lines, columns, rows) start at their columns' common offsets, two spaces apart."""
    grid = placed(rows)
    widths = [0] * max((c + span for row in grid for c, span, _ in row), default=0)
    for single in (True, False):  # a spanning cell widens its last column
        for row in grid:
            for c, span, lines in row:
                if (span == 1) == single:
                    need = max(map(shown_width, lines), default=0) - sum(widths[c : c + span - 1]) - 2 * (span - 1)
                    widths[c + span - 1] = max(widths[c + span - 1], need)
    starts = [0]
    for w in widths:
        starts.append(starts[-1] + w + 2)
    out = []
    for row in grid:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line, at = [], 0
            for c, _, lines in row:
                if k < len(lines) and lines[k]:
                    line += [" " * (starts[c] - at), lines[k]]
                    at = starts[c] + shown_width(lines[k])
            out.append("".join(line).rstrip())
    return out


#: Stands on the stack where an element's own visibility ends.
_SEEN = Node("")


def render(root: Node) -> str:
    """The visible text of a tree, without recursion."""
    out = _Lines()
    writers: list[_Lines] = [out]
    tables: list[list[list[tuple[list[str], int, int]]]] = []
    rules = style_rules(root.attrs["css"]) if "css" in root.attrs else {}
    seen = [True]  # visibility, for each element that sets it
    lists: list[list] = []  # kind, next number, step and type
    path: list[Node] = []  # the open elements
    pre = 0
    stack: list[tuple[Node | str, bool]] = [(root, False)]
    while stack:
        node, leaving = stack.pop()
        w = writers[-1]
        if node.__class__ is str:
            if not seen[-1]:
                continue
            if pre:
                w.exact(node)
            else:
                w.text(node)
            continue
        tag = node.tag
        if not leaving:
            look = looks(node, rules, path) if node.attrs or rules else {}
            if tag and hidden(node, look):
                continue
            if "visibility" in look and tag:
                seen.append(look["visibility"] not in ("hidden", "collapse"))
                stack.append((_SEEN, True))
            if tag in VOID and not seen[-1]:
                continue
            if tag == "br":
                w.flush(True)
                continue
            if tag == "img":
                if alt := node.attrs.get("alt", "").strip():
                    w.text(alt)
                continue
            if tag == "input":
                if node.attrs.get("type", "").lower() in BUTTONS and (label := node.attrs.get("value", "").strip()):
                    w.text(label)
                continue
            if tag == "hr":
                w.margin(True)
                w.put(["---"])
                w.margin(True)
                continue
            stack.append((node, True))
            path.append(node)
            if tag == "table":
                w.margin(True)
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                writers.append(_Lines())
                lists.append([None, 0, 1, ""])
            elif tag in ("ul", "ol", "menu"):
                w.margin(not any(x[0] for x in lists))
                down = tag == "ol" and "reversed" in node.attrs
                items = sum(kid.__class__ is Node and kid.tag == "li" for kid in node.kids) if down else 1
                lists.append(["ol" if tag == "ol" else "ul", _whole(node.attrs.get("start", ""), items), -1 if down else 1, node.attrs.get("type", "")])
            elif tag == "li":
                w.flush()
                kind = lists[-1] if lists and lists[-1][0] else ["ul", 0, 1, ""]
                kind[1] = _whole(node.attrs.get("value", ""), kind[1])
                mark = f"{numeral(kind[1], node.attrs.get('type', kind[3]))}. " if kind[0] == "ol" else "- "
                kind[1] += kind[2]
                w.mark = w.indent[-1] + mark
                w.indent.append(w.indent[-1] + " " * len(mark))
            elif tag == "dd":
                w.flush()
                w.indent.append(w.indent[-1] + "  ")
            elif tag == "blockquote":
                w.margin(True)
                w.indent.append(w.indent[-1] + "> ")
            elif tag in BLOCK and not (tables and tag in ("tbody", "thead", "tfoot")):
                w.margin(tag in SPACED)
            if tag in ("pre", "xmp"):
                pre += 1
            kids = node.kids
            if tag == "details" and "open" not in node.attrs:
                kids = [kid for kid in kids if kid.__class__ is Node and kid.tag == "summary"][:1]
            stack += [(kid, False) for kid in reversed(kids)]
            continue
        if node is _SEEN:
            seen.pop()
            continue
        path.pop()
        if tag in ("pre", "xmp"):
            pre -= 1
        if tag == "table" and tables:
            rows = tables.pop()
            w.put(aligned(rows))
            w.margin(True)
        elif tag in ("td", "th") and tables:
            cell = writers.pop().done()
            lists.pop()
            span, down = (int(x) if re.fullmatch(r"\d{1,9}", x) else 1 for x in (node.attrs.get(n, "1").strip() for n in ("colspan", "rowspan")))
            tables[-1][-1].append((cell, min(1000, max(1, span)), min(65534, down)))
        elif tag in ("ul", "ol", "menu"):
            lists.pop()
            w.margin(not any(x[0] for x in lists))
        elif tag in ("li", "dd"):
            w.flush()
            w.indent.pop()
            w.mark = ""
        elif tag == "blockquote":
            w.margin(True)
            w.indent.pop()
        elif tag in BLOCK and not (tables and tag in ("tr", "tbody", "thead", "tfoot")):
            w.margin(tag in SPACED)
    return "\n".join(out.done())


def page_text(page: str | None) -> str:
    """The visible text of one page; a null or empty page has none."""
    return render(build_tree(page)) if page else ""


def page_title(page: str | None) -> str | None:
    m = re.search(r"<title[^>]*>(.*?)</title", page, re.S | re.I) if page else None
    return _SPACE.sub(" ", html.unescape(m[1])).strip() if m else None


def with_text(pages: DataFrame, text: str = "__text", title: str = "__title") -> DataFrame:
    """`pages` with the visible text of `html` and the page's title (null if it has none).

    A null or empty page has an empty text; a page of any length or depth is read
    whole.  Repeated rows come out alike, an empty table gives an empty one, and
    columns of `pages` with the names of the two added ones raise.
    """
    refuse_clashes(pages, text, title)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offs = column_bytes(batch.column("html").cast(pa.string()))
            for i, j in slices(offs):
                some = batch.slice(i, j - i)
                own = some.column("html").to_pylist()
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array([page_text(p) for p in own], pa.string()), pa.array([page_title(p) for p in own], pa.string())], [*batch.schema.names, text, title])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(text, T.StringType()), T.StructField(title, T.StringType())]))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, title, text and n_lines of every row of `pages`, as `with_text`; other columns are ignored."""
    done = with_text(pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")))
    lines = F.when(F.col("__text") == "", 0).otherwise(F.size(F.split("__text", "\n")))
    return done.select("page_id", "url", F.col("__title").alias("title"), F.col("__text").alias("text"), lines.cast("long").alias("n_lines"))
