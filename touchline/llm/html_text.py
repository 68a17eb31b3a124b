"""Operator 6, HTML extraction by layout-aware rendering.

A tree builder turns the markup into elements that open and close in tree
order, adding the end tags that HTML implies (a paragraph before a block, a
list item before the next, cells and rows of tables) and the rows that cells
imply. A renderer follows the tree: visibility rules cut what a reader doesn't
see, blocks start new lines, paragraphs and the like are set apart by a blank
line, list items get their bullets or numbers and their indent, and the cells
of a table are rendered by themselves and aligned in columns, to the right where they say
so. The open elements are a plain list, so no depth of nesting exhausts a stack.

Style sheets are gathered before anything is rendered, wherever they stand. Of their rules
``display`` and ``visibility`` count, for selectors of tags, ids, classes, attributes,
descendants and children, by importance, specificity and order; rules are looked up
by what their last part asks for. Selectors with siblings or pseudo-classes match nothing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import by_bytes, table

# Fixed values of HTML: elements by how they behave.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("head script style template title noscript iframe noembed noframes object audio video canvas datalist meta link map".split())
FOREIGN = {"svg", "math"}
#: Parts of these that are not shown.
FOREIGN_UNSEEN = set("desc defs metadata symbol clippath mask pattern marker annotation annotation-xml mphantom".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr menu".split())
BLOCK = SPACED | set(
    "html body address article aside center dd details dialog dir div dt figcaption footer form header hgroup legend li main nav optgroup option search section summary caption thead tbody tfoot tr td th select".split()
)
LISTS = {"ul", "ol", "menu", "dir"}
CELLS, SECTIONS = {"td", "th"}, {"thead", "tbody", "tfoot"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A start tag (key) ends the open elements of the first set, looked for up to one of the second.
ENDS = {
    "li": ({"li"}, LISTS | CELLS | {"table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"} | CELLS),
    "dd": ({"dt", "dd"}, {"dl", "table"} | CELLS),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    **dict.fromkeys(CELLS, (CELLS | {"caption"}, {"table", "tr"})),
    **dict.fromkeys(SECTIONS | {"caption", "colgroup"}, (SECTIONS | {"caption", "colgroup"}, {"table"})),
    "body": ({"head"}, {"table"}),
}
#: No end tag but theirs ends elements beyond these.
SCOPES = CELLS | {"table", "caption", "template"}

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s"'>/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile("[ \t\n\r\f]+")
_SHEET = re.compile(r"""[{};]|"(?:[^"\\\n]|\\.)*"?|'(?:[^'\\\n]|\\.)*'?|[^{};"']+""", re.S)
_STYLED = re.compile(r"<style(?=[\s/>]).*?(?:display|visibility)", re.I | re.S)
#: Media queries that hold for every screen.
_SCREEN = re.compile(r"(?:(?:only\s+)?(?:all|screen)|not\s+print)?", re.I)
_HIDING = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
#: A part of a selector: a tag, an id, a class, an attribute; what stands between two elements.
_PART = re.compile(r"""([a-zA-Z][\w-]*|\*)|([.#])([\w-]+)|\[\s*([\w-]+)\s*(?:([~^$*|]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\s\]"']+))\s*)?\]|\s*(>)\s*|(\s+)""")
_RIGHT = re.compile(r"(?:^|;)\s*text-align\s*:\s*(?:right|end)\b", re.I)
#: Buttons that show a text of their own without a value.
_BUTTONS = {"submit": "Submit", "reset": "Reset", "button": ""}
#: Widest line of a cell, widest indent.
WRAP, INDENT = 80, 40


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _on_screen(media: str) -> bool:
    """Whether a list of media queries holds for every screen, whatever its size."""
    return any(_SCREEN.fullmatch(m.strip()) for m in media.split(","))


def _number(text: str | None, least: int, most: int, default: int) -> int:
    return min(max(int(text), least), most) if text and re.fullmatch(r"-?[0-9]{1,9}", text.strip()) else default


class _Lines:
    """The lines of a page or a cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.indent = ""
        self.first: str | None = None  # what the next line starts with instead
        self.gap = False

    def text(self, value: str) -> None:
        value = _SPACE.sub(" ", value)
        if value[0] == " " and (not self.now or self.now[-1][-1] == " "):
            value = value[1:]
        if value:
            self.now.append(value)

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append((self.indent if self.first is None else self.first) + line)
        self.first = None

    def end(self, gap: bool = False) -> None:
        """End the line; ``gap`` asks for a blank line before the next."""
        if self.now:
            line = "".join(self.now).strip(" ")
            self.now = []
            if line:
                self.put(line)
        self.gap |= gap


class _Compound:
    """What a selector asks of one element, and of which kind of ancestor the part before it speaks."""

    __slots__ = ("tag", "ids", "classes", "attributes", "child")

    def __init__(self):
        self.tag, self.ids, self.classes, self.attributes, self.child = "", [], [], [], False

    def fits(self, e: "_Open") -> bool:
        if self.tag not in ("", e.name) or not e.classes.issuperset(self.classes) or any(i != e.got.get("id") for i in self.ids):
            return False
        return all(name in e.got and _compares(e.got[name], how, value) for name, how, value in self.attributes)


def _compares(have: str, how: str, value: str) -> bool:
    if not how:
        return True
    if how == "=":
        return have == value
    if not value:
        return False
    return {"~=": value in have.split(), "^=": have.startswith(value), "$=": have.endswith(value), "*=": value in have, "|=": have == value or have.startswith(value + "-")}[how]


def _selector(text: str) -> list[_Compound] | None:
    """The compounds of a selector, first to last; None if it has parts that are not understood."""
    text = text.strip()
    out, at = [_Compound()], 0
    while at < len(text):
        m = _PART.match(text, at)
        if not m:
            return None
        now = out[-1]
        if m[1]:
            now.tag = "" if m[1] == "*" else m[1].lower()
        elif m[2]:
            (now.classes if m[2] == "." else now.ids).append(m[3])
        elif m[4]:
            now.attributes.append((m[4].lower(), m[5] or "", m[6] or m[7] or m[8] or ""))
        else:
            out.append(_Compound())
            out[-1].child = bool(m[9])
        at = m.end()
    return out


def _asked(c: _Compound) -> bool:
    return bool(c.tag or c.ids or c.classes or c.attributes)


def _matches(selector: list[_Compound], elements: list["_Open"], last: int) -> bool:
    """Whether the element at ``last`` and ancestors of it fit the selector."""
    if not selector[-1].fits(elements[last]):
        return False
    if len(selector) == 1:
        return True
    above = range(last - 1, max(0, last - 2) if selector[-1].child else 0, -1)
    return any(_matches(selector[:-1], elements, n) for n in above)


class _Table:
    def __init__(self, above: _Lines):
        self.above = above
        self.rows: list[list[tuple[list[str], int, int, bool]]] = []

    def render(self) -> list[str]:
        """The rows as lines, columns aligned."""
        placed, held, columns = [], {}, 0
        for row in self.rows:
            at, line = 0, []
            for cell, across, down, right in row:
                while held.get(at, 0):
                    held[at] -= 1
                    at += 1
                line.append((at, across, cell, right))
                if down > 1:
                    held.update(dict.fromkeys(range(at, at + across), down - 1))
                at += across
            while held.get(at, 0):
                held[at] -= 1
                at += 1
            placed.append(line)
            columns = max(columns, at)
        several = any(sum(1 for c in line if c[2]) > 1 for line in placed)
        if several:
            placed = [[(at, across, [w for x in cell for w in _wrapped(x)], right) for at, across, cell, right in line] for line in placed]
        widths: dict[int, int] = {}
        for line in placed:
            for at, across, cell, _ in line:
                if across == 1 and cell:
                    widths[at] = max(widths.get(at, 0), max(map(len, cell)))
        starts, x = {}, 0
        for at in range(columns + 1):
            starts[at] = x
            x += widths[at] + 2 if widths.get(at) else 0
        out = []
        for line in placed:
            for k in range(max((len(cell) for _, _, cell, _ in line), default=0)):
                text = ""
                for at, across, cell, right in line:
                    if k < len(cell) and cell[k]:
                        text = text + "  " if len(text) > starts[at] - 2 and text else text
                        text = text.ljust(starts[at]) + (cell[k].rjust(widths[at]) if right and across == 1 else cell[k])
                out.append(text)
        return out


def _wrapped(line: str) -> list[str]:
    out = []
    while len(line) > WRAP and (cut := line.rfind(" ", 1, WRAP + 1)) > 0 and line[:cut].strip():
        out.append(line[:cut].rstrip())
        line = line[cut + 1 :]
    return [*out, line]


class _Open:
    __slots__ = ("name", "got", "classes", "seen", "shown", "undo", "count")

    def __init__(self, name: str, got: dict[str, str], seen: bool, shown: bool):
        self.name, self.got, self.seen, self.shown, self.undo, self.count = name, got, seen, shown, None, 0
        self.classes = set(got["class"].split()) if "class" in got else frozenset()

    def folded(self) -> bool:
        """Closed details show their summary only."""
        return self.name == "details" and "open" not in self.got


class Renderer:
    """Tree builder and renderer of one page."""

    def __init__(self):
        self.open: list[_Open] = [_Open("", {}, True, True)]
        self.out = _Lines()
        self.tables: list[_Table] = []
        #: Rules by what their last compound asks for: ``(selector, important, specificity, number, property, value)``.
        self.rules: dict[str, list[tuple]] = {}
        self.n_rules = 0
        self.pre = self.foreign = 0
        self.n_tables = self.n_items = 0
        self.title: list[str] = []

    # tree builder

    def start(self, name: str, attributes: str, closed: bool) -> None:
        if name in ENDS:
            self.end_first(*ENDS[name])
            if name in CELLS and (not self.tables or self.in_table() not in {"tr"}):
                if not self.tables:
                    return
                self.start("tr", "", False)
        elif name in HEADINGS:
            self.end_first(HEADINGS, SCOPES | BLOCK - HEADINGS - {"p"})
        if name in BLOCK and name not in CELLS | SECTIONS | {"tr", "caption"}:
            self.end_first({"p"}, SCOPES | {"button"})
        if name in SECTIONS | {"tr", "caption"} and not self.tables:
            return
        self.element(name, attributes)
        if name in VOID or closed and self.foreign:
            self.close()

    def in_table(self) -> str:
        """The innermost open part of the innermost table."""
        return next((e.name for e in reversed(self.open) if e.name in SCOPES | SECTIONS | {"tr"}), "")

    def end_first(self, names: set[str], until: set[str]) -> None:
        for n in range(len(self.open) - 1, 0, -1):
            if self.open[n].name in names:
                while len(self.open) > n:
                    self.close()
                # a row may end its cell's, a section its row's and cells
                if names & (SECTIONS | {"tr"}):
                    continue
                return
            if self.open[n].name in until:
                return

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", "", False)
            return
        stop = {"table"} if name in SCOPES | SECTIONS | {"tr"} else SCOPES
        for n in range(len(self.open) - 1, 0, -1):
            if self.open[n].name == name or name in HEADINGS and self.open[n].name in HEADINGS:
                while len(self.open) > n:
                    self.close()
                return
            if self.open[n].name in stop:
                break
        if name == "p":
            self.start("p", "", False)
            self.close()

    # renderer

    def said(self, e: _Open) -> dict[str, str]:
        """The values of ``display`` and ``visibility`` that win for the innermost open element."""
        best: dict[str, tuple] = {}
        if self.foreign:
            best = {k: ((0, (0, 0, 0, 0), -1), e.got[k].strip().lower()) for k in ("display", "visibility") if k in e.got}
        if self.rules:
            for key in (e.name, "", *("." + c for c in e.classes), "#" + e.got.get("id", "")):
                for selector, important, weight, number, what, value in self.rules.get(key, ()):
                    rank = (important, (0, *weight), number)
                    if (what not in best or rank >= best[what][0]) and _matches(selector, self.open, len(self.open) - 1):
                        best[what] = (rank, value)
        if "style" in e.got:
            for n, m in enumerate(_HIDING.finditer(e.got["style"])):
                rank, what = (bool(m[3]), (1, 0, 0, 0), n), m[1].lower()
                if what not in best or rank >= best[what][0]:
                    best[what] = (rank, m[2].lower())
        return {what: value for what, (_, value) in best.items()}

    def element(self, name: str, attributes: str) -> None:
        above = self.open[-1]
        self.foreign += name in FOREIGN
        got = _attributes(attributes) if attributes and not attributes.isspace() else {}
        e = _Open(name, got, above.seen, above.shown)
        self.open.append(e)
        if above.folded():
            e.seen = e.seen and name == "summary" and not above.count
            above.count += name == "summary"
        if not e.seen:
            return
        said = self.said(e) if got or self.rules else {}
        cut = said["display"] == "none" if "display" in said else "hidden" in got or name == "dialog" and "open" not in got
        e.seen = seen = not cut and name not in UNSEEN and not (self.foreign and name in FOREIGN_UNSEEN)
        if said.get("visibility", "inherit") != "inherit":
            e.shown = said["visibility"] == "visible"
        if not seen:
            return
        if name == "input":
            kind = got.get("type", "").strip().lower()
            if kind in _BUTTONS:
                self.text(html.escape(got.get("value", _BUTTONS[kind])))
            return
        if name == "br":
            if self.out.now:
                self.out.end()
            return
        if name not in BLOCK:
            if self.foreign and (name in ("text", "mtd") or name == "tspan" and "x" in got):
                self.text(" ")  # these have a place of their own
            return
        nested = name in LISTS and any(x.name == "li" for x in self.open[:-1])
        if name in CELLS:
            right = got.get("align", "").strip().lower() == "right" or bool(_RIGHT.search(got.get("style", "")))
            e.undo = (self.out, self.pre, _number(got.get("colspan"), 1, 1000, 1), _number(got.get("rowspan"), 1, 65534, 1), right)
            self.out, self.pre = _Lines(), 0
            return
        if name == "tr":
            self.tables[-1].rows.append([])
            return
        if name in SECTIONS:
            return
        self.out.end(name in SPACED and not nested)
        if name == "table":
            self.n_tables += 1
            self.tables.append(_Table(self.out))
        elif name == "pre":
            self.pre += 1
        elif name == "ol":
            e.count = _number(got.get("start"), -(10**9), 10**9, 1)
        elif name == "li":
            self.n_items += 1
            of = next((x for x in reversed(self.open[:-1]) if x.name in LISTS), None)
            mark = "- "
            if of and of.name == "ol":
                of.count = _number(got.get("value"), -(10**9), 10**9, of.count)
                mark = f"{of.count}. "
                of.count += 1
            self.indented(e, mark)
        elif name in ("dd", "blockquote"):
            self.indented(e, "    ")

    def indented(self, e: _Open, mark: str) -> None:
        out = self.out
        e.undo = (out.indent, out.first)
        start = out.indent if out.first is None else out.first
        if len(out.indent) < INDENT:
            out.indent += " " * len(mark)
            out.first = start + mark
        else:
            out.first = start[: len(out.indent)] + (mark if mark.strip() else "")

    def close(self) -> None:
        e = self.open.pop()
        name = e.name
        self.foreign -= name in FOREIGN
        if e.seen and self.foreign and name in ("text", "mtd"):
            self.text(" ")
        if not e.seen or name not in BLOCK:
            return
        if name in CELLS:
            self.out.end()
            lines = self.out.lines
            self.out, self.pre, across, down, right = e.undo
            if not self.tables[-1].rows:
                self.tables[-1].rows.append([])
            self.tables[-1].rows[-1].append((lines, across, down, right))
            return
        if name == "tr" or name in SECTIONS:
            return
        if name == "table":
            done = self.tables.pop()
            self.out = done.above
            self.out.end()
            for line in done.render():
                self.out.put(line)
        self.out.end(name in SPACED and not (name in LISTS and any(x.name == "li" for x in self.open)))
        if name == "pre":
            self.pre -= 1
        if e.undo:
            self.out.indent = e.undo[0]
            if self.out.first is not None:  # nothing was put
                self.out.first = e.undo[1]

    def text(self, value: str) -> None:
        e = self.open[-1]
        if not (e.seen and e.shown) or not value or e.folded():
            return
        if "&" in value:
            value = html.unescape(value)
        value = value.replace("\0", "")
        if not value:
            return
        if self.pre:
            head, *more = value.replace("\r\n", "\n").split("\n")
            self.out.now.append(head) if head else None
            for line in more:
                self.out.put("".join(self.out.now).rstrip())
                self.out.now = [line] if line else []
            return
        self.out.text(value)

    def sheets(self, page: str) -> None:
        """Gather the rules of all style sheets of the page."""
        if not _STYLED.search(page):
            return
        at = 0
        while m := _MARKUP.search(page, at):
            at = m.end()
            name = (m[2] or "").lower()
            if name in RAW and not m[1]:
                stop = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
                if name == "style" and _on_screen(_attributes(m[3] or "").get("media", "")):
                    self.styled(page[at : stop.start() if stop else len(page)])
                at = stop.end() if stop else len(page)

    def feed(self, page: str) -> None:
        self.sheets(page)
        at = 0
        while m := _MARKUP.search(page, at):
            if m.start() > at:
                self.text(page[at : m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                if m[0].startswith("<![CDATA["):
                    self.text(html.escape(m[0][9:].removesuffix("]]>")))
                continue
            attributes = (m[3] if m[2] else m[6]) or ""
            if m[1] or m[4]:
                self.end(name)
                continue
            self.start(name, attributes, attributes.endswith("/"))
            if name in RAW and not (self.foreign and attributes.endswith("/")):
                stop = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
                raw = page[at : stop.start() if stop else len(page)]
                at = stop.end() if stop else len(page)
                if name == "title" and not self.title:
                    self.title.append(_SPACE.sub(" ", html.unescape(raw)).strip())
                self.text(raw)
                if self.open[-1].name == name:
                    self.close()
        if at < len(page):
            self.text(page[at:])
        while len(self.open) > 1:
            self.close()
        self.out.end()

    def styled(self, sheet: str) -> None:
        """Rules with a plain selector that hide or show; those of at-rules only if they hold for every screen."""
        blocks: list[tuple[str | bool, str]] = []  # a rule's selectors, or whether the rules inside hold; what stood before in the block above
        now = ""
        for m in _SHEET.finditer(re.sub(r"/\*.*?(\*/|\Z)", "", sheet, flags=re.S)):
            of = blocks[-1][0] if blocks else True
            if m[0] == "{":
                before, _, head = now.rpartition(";")
                head = head.strip()
                if of is True and head.startswith("@"):
                    name, _, media = re.sub(r"^(@[\w-]+)", r"\1 ", head).partition(" ")
                    inside = name.lower() == "@layer" or name.lower() == "@media" and _on_screen(media)
                else:
                    inside = now.strip() if of is True else False
                blocks.append((inside, before if isinstance(of, str) else ""))
                now = ""
            elif m[0] == "}":
                if isinstance(of, str):
                    self.rule(of, now)
                now = blocks.pop()[1] + ";" if blocks else ""
                if not blocks or blocks[-1][0] is True:
                    now = ""
            elif m[0] == ";" and of is True and now.lstrip().startswith("@"):
                now = ""
            elif of is not False:
                now += m[0]

    def rule(self, selectors: str, body: str) -> None:
        said = [(m[1].lower(), m[2].lower(), bool(m[3])) for m in _HIDING.finditer(body)]
        for text in selectors.split(",") if said else ():
            selector = _selector(text)
            if selector is None or not text.strip() or not _asked(selector[-1]) and text.strip()[-1] != "*":
                continue
            weight = (sum(len(c.ids) for c in selector), sum(len(c.classes) + len(c.attributes) for c in selector), sum(bool(c.tag) for c in selector))
            last = selector[-1]
            key = "#" + last.ids[0] if last.ids else "." + last.classes[0] if last.classes else last.tag
            for what, value, important in said:
                self.n_rules += 1
                self.rules.setdefault(key, []).append((selector, important, weight, self.n_rules, what, value))


def render(page: str) -> tuple[str, str, int, int]:
    """The visible text of a page, its title, and how many tables and list items it has."""
    it = Renderer()
    it.feed(page)
    return "\n".join(x.rstrip() for x in it.out.lines), (it.title or [""])[0], it.n_tables, it.n_items


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, title, text, n_chars, n_lines, n_tables, n_items``.

    A null, empty or blank page has an empty text and title. Repeated rows give
    repeated results, a null id stays null, other columns are not read. Markup
    that never closes runs to the end of the page. No shuffle.
    """
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_bytes(batches, "html"):
            text, title, tables, items = zip(*map(render, texts), strict=True)
            lines = [t.count("\n") + 1 if t else 0 for t in text]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(title, pa.string()), pa.array(text, pa.string()), *(pa.array(x, pa.int64()) for x in (map(len, text), lines, tables, items))],
                names=["page_id", "title", "text", "n_chars", "n_lines", "n_tables", "n_items"],
            )

    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, f"page_id {kind}, title string, text string, n_chars bigint, n_lines bigint, n_tables bigint, n_items bigint")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query of operator 6 over all of ``pages``."""
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op6_html_text": op6_html_text}
ORACLE_SQL: dict[str, str] = {}
