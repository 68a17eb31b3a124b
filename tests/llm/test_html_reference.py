"""Operator 6 against a plain renderer: random trees are written as markup with and without implied
end tags, and rendered by definition from the tree, where every element is tested against every rule."""

from __future__ import annotations

import html
import random
import re

import pytest

from touchline.llm import html_text

SPACED = {"p", "h1", "h3", "ul", "ol", "table", "blockquote", "pre"}
BLOCK = SPACED | {"div", "section", "li", "details", "summary"}
LISTS = {"ul", "ol"}


class Node:
    def __init__(self, name, attributes, children, above=None):
        self.name, self.attributes, self.children, self.above = name, attributes, children, above


def tree(r: random.Random, above: Node, depth: int, blocks: bool) -> None:
    """Fill ``above`` with children that markup can express: paragraphs and headings hold no blocks."""
    for _ in range(r.randint(0, 4)):
        names = ["b", "span", "i", "br", "input"] + (["p", "div", "section", "h1", "h3", "ul", "ol", "table", "blockquote", "details"] * 2 if blocks else [])
        name = r.choice(["#"] * 8 + names)
        if name == "#" or depth > 4:
            above.children.append(r.choice(["word ", " two words", "a&b", "<", "é", "  ", "x\ny", "end."]))
            continue
        attributes = {}
        if r.random() < 0.4:
            attributes["class"] = " ".join(r.sample(["x", "y", "z"], r.randint(1, 2)))
        if r.random() < 0.15:
            attributes["id"] = r.choice(["one", "two"])
        if r.random() < 0.1:
            attributes["hidden"] = ""
        if r.random() < 0.15:
            attributes["style"] = r.choice(["display:none", "visibility: hidden", "visibility:visible", "color:red;display:block", "display: none !important"])
        if name == "input":
            attributes |= r.choice([{"type": "submit", "value": "go & stop"}, {"type": "reset"}, {"type": "text", "value": "typed"}, {"type": "button"}, {}])
        if name == "details" and r.random() < 0.5:
            attributes["open"] = ""
        node = Node(name, attributes, [], above)
        above.children.append(node)
        if name in ("br", "input"):
            continue
        if name in LISTS:
            if name == "ol" and r.random() < 0.3:
                attributes["start"] = str(r.randint(-2, 98))
            parts = [Node("li", {"class": "y"} if r.random() < 0.2 else {}, [], node) for _ in range(r.randint(0, 3))]
        elif name == "table":
            parts = []
            for _ in range(r.randint(1, 3)):
                row = Node("tr", {}, [], node)
                parts.append(row)
                row.children = [Node("td", r.choice([{}, {}, {"align": "right"}, {"style": "text-align:right"}]), [], row) for _ in range(r.randint(1, 3))]
        elif name == "details":
            parts = [Node(n, {}, [], node) for n in r.choice([[], ["summary"], ["summary", "div"], ["div", "summary"]])]
        else:
            parts = []
        node.children += parts
        inner = [c for row in parts for c in row.children] if name == "table" else parts
        for part in inner:
            tree(r, part, depth + 2 if name == "table" else depth + 1, name != "table" and part.name != "summary")
        if not parts and name not in LISTS | {"table", "details"}:
            tree(r, node, depth + 1, blocks and name not in ("p", "h1", "h3", "b", "span", "i"))


def markup(r: random.Random, node, last: bool = False) -> str:
    if isinstance(node, str):
        return html.escape(node, quote=False) if r.random() < 0.8 or "&" in node or "<" in node else node
    name = node.name if r.random() < 0.8 else node.name.upper()
    quoted = "".join(f" {k}" if not v and r.random() < 0.5 else f' {k}="{html.escape(v)}"' for k, v in node.attributes.items())
    inside = "".join(markup(r, c, c is node.children[-1]) for c in node.children)
    if node.name in ("br", "input"):
        return f"<{name}{quoted}{r.choice(['', '/'])}>"
    # an item, row or cell ends where the next begins or its parent ends
    siblings = node.above.children if node.above else []
    omitted = node.name in ("li", "tr", "td") and all(not isinstance(c, str) for c in siblings) and r.random() < 0.5
    return f"<{name}{quoted}>{inside}" + ("" if omitted else f"</{node.name}>")


RULES = [
    ".x{display:none}", ".x.y{display:block}", "div .z{display:none}", "#one{visibility:hidden}", "b{visibility:hidden}", "section > b{display:none}", "[hidden]{display:block}",
    ".y b, .y i{visibility:visible}", "span[class~=z]{display:none!important}", "#two.x{display:none}", "ul li{visibility:visible}", "div div .x{display:inline}", "* .y{display:none}",
    "i[style*='hidden']{display:none}", "p:hover{display:none}", "b + i{display:none}", "h3, li > .z{display:none}", "td .x{visibility:hidden}", "details > summary{visibility:visible}",
]


def chains(node: Node):
    while node is not None and node.name:
        yield node
        node = node.above


def simple(part: str, node: Node) -> bool:
    classes = node.attributes.get("class", "").split()
    for tag, kind, name, attribute, how, value in re.findall(r"^([a-z0-9]+|\*)|([.#])(\w+)|\[(\w+)(?:([~*]?=)'?(\w+)'?)?\]", part):
        have = node.attributes.get(attribute)
        fine = (
            tag in ("*", node.name) if tag else name in classes if kind == "." else name == node.attributes.get("id") if kind
            else have is not None and (not how or (value in have.split() if how == "~=" else value in have))
        )
        if not fine:
            return False
    return True


def fits(selector: str, node: Node) -> bool:
    """All ways to place the selector's parts on the element and those above it."""
    parts = selector.replace(">", " > ").split()
    if any(c in selector for c in ":+"):
        return False

    def place(k: int, node: Node | None) -> bool:
        if node is None or not node.name or not simple(parts[k], node):
            return False
        if k == 0:
            return True
        if parts[k - 1] == ">":
            return place(k - 2, node.above)
        return any(place(k - 1, above) for above in chains(node.above))

    return place(len(parts) - 1, node)


def weight(selector: str) -> tuple[int, int, int]:
    return len(re.findall(r"#\w+", selector)), len(re.findall(r"\.\w+|\[", selector)), len(re.findall(r"(?:^|[\s>])[a-z]\w*", re.sub(r"\[.*?\]", "", selector)))


def computed(node: Node, rules: list[str]) -> dict[str, str]:
    said = []
    for n, rule in enumerate(rules):
        selectors, what, value, important = re.fullmatch(r"(.*)\{(\w+):(\w+)(!important)?\}", rule).groups()
        said += [((bool(important), 0, *weight(s), n), what, value) for s in selectors.split(",") if fits(s.strip(), node)]
    for n, (what, value, important) in enumerate(re.findall(r"(display|visibility)\s*:\s*(\w+)(\s*!important)?", node.attributes.get("style", ""))):
        said.append(((bool(important), 1, 0, 0, 0, n), what, value))
    return {what: value for _, what, value in sorted(said)}


def tokens(node, rules: list[str], shown: bool) -> list:
    """``("w", text)``, ``"nl"``, ``"gap"`` and whole lines ``("l", text)``, in order."""
    if isinstance(node, str):
        return [("w", node)] if shown else []
    style = computed(node, rules)
    if style.get("display", "none" if "hidden" in node.attributes else "") == "none":
        return []
    shown = {"visible": True, "hidden": False}.get(style.get("visibility"), shown)
    if node.name == "br":
        return ["nl"]
    if node.name == "input":
        kind = node.attributes.get("type")
        text = node.attributes.get("value", {"submit": "Submit", "reset": "Reset"}.get(kind, "")) if kind in ("submit", "reset", "button") else ""
        return [("w", text)] if shown and text else []
    children = node.children
    if node.name == "details" and "open" not in node.attributes:
        children = [c for c in children if not isinstance(c, str) and c.name == "summary"][:1]
    if node.name == "table":
        inside = [("l", x) for x in aligned(node, rules, shown)]
    elif node.name in LISTS:
        inside, number = [], int(node.attributes.get("start", 1))
        for c in children:
            found = tokens(c, rules, shown)
            hidden = computed(c, rules).get("display", "none" if "hidden" in c.attributes else "") == "none"
            inside += marked(found, f"{number}. " if node.name == "ol" else "- ")
            number += not hidden
    else:
        inside = [t for c in children for t in tokens(c, rules, shown)]
    if node.name == "blockquote":
        inside = marked(inside, "    ")
    if node.name not in BLOCK:
        return inside
    nested = node.name in LISTS and any(a.name == "li" for a in chains(node.above))
    edge = "gap" if node.name in SPACED and not nested else "nl"
    return [edge, *inside, edge]


def lines_of(found: list) -> list:
    """Inline pieces put together to lines; gaps stay."""
    out, now = [], ""
    for t in [*found, "nl"]:
        if t in ("nl", "gap") or t[0] == "l":
            line = re.sub("[ \t\n\r\f]+", " ", now).strip(" ")
            now = ""
            out += [line] if line else []
            out += [None] if t == "gap" else [t[1]] if t[0] == "l" else []
        else:
            now += t[1]
    return out


def marked(found: list, mark: str) -> list:
    out, first = ["nl"], True
    for line in lines_of(found):
        if line is None:
            out.append("gap")
        else:
            out.append(("l", (mark if first else " " * len(mark)) + line))
            first = False
    return out


def joined(found: list) -> list[str]:
    out, gap = [], False
    for line in lines_of(found):
        if line is None:
            gap = True
        else:
            out += [""] * (gap and bool(out)) + [line]
            gap = False
    return out


def aligned(node: Node, rules: list[str], shown: bool) -> list[str]:
    rows = []
    for row in node.children:
        line = []
        for cell in row.children:
            right = "right" in str(cell.attributes)
            line.append((joined([t for c in cell.children for t in tokens(c, rules, shown)]), right))
        rows.append(line)
    count = max(map(len, rows))
    widths = [max((len(x) for row in rows if k < len(row) for x in row[k][0]), default=0) for k in range(count)]
    out = []
    for row in rows:
        for k in range(max(len(c) for c, _ in row)):
            parts = [(c[k] if k < len(c) else "") for c, _ in row]
            text = ""
            for n, (part, (_, right)) in enumerate(zip(parts, row)):
                if part:
                    text = text.ljust(sum(w + 2 for w in widths[:n] if w)) + (part.rjust(widths[n]) if right else part)
            out.append(text)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_random_pages(seed):
    r = random.Random(seed)
    filled = 0
    for _ in range(400):
        root = Node("", {}, [])
        while len(root.children) < 3:
            tree(r, root, 0, True)
        rules = r.sample(RULES, r.randint(0, 5))
        parts = [markup(r, c) for c in root.children]
        cut = r.randint(0, len(rules))
        for sheet in (rules[:cut], rules[cut:]):  # sheets anywhere, also behind what they hide; their order is that of the page
            parts.insert(r.randint(0, len(parts)) if sheet is rules[:cut] else len(parts), f"<style>{' '.join(sheet)}</style>")
        page = "".join(parts)
        want = [x.rstrip() for x in joined([t for c in root.children for t in tokens(c, rules, True)])]
        got = html_text.render(page)[0].split("\n")
        assert got == (want or [""]), page
        filled += len(want) > 5
    assert filled > 50


@pytest.mark.parametrize("page,text", [
    ("<p class=late>gone<style>.late{display:none}</style><p>here", "here"), ("<style>.a .b.c > i[title]{display:none}</style><div class=a><p class='b c'><i title>no</i><i>yes</i>", "yes"),
    ("<details>no<summary>sum</summary><p>no</details>after", "sum\nafter"), ("<details open><summary>sum</summary>in</details>", "sum\nin"),
    ("<input type=submit value='Send &amp; go'> <input value=typed><input type=RESET>", "Send & go Reset"),
    ("<style>#i{display:none} .c{display:block}</style><b id=i class=c>no</b>", ""), ("<style>.c{display:none!important}</style><b class=c style='display:inline'>no</b>yes", "yes"),
    ("<style>.c{display:none} b.c{display:inline}</style><b class=c>yes</b><i class=c>no</i>", "yes"), ("<b hidden style='display:inline'>yes</b>", "yes"),
    ("<table><tr><td>apple<td align=right>3<tr><td>fig<td style='text-align: right'>1000</table>", "apple     3\nfig    1000"),
])
def test_pages_by_hand(page, text):
    assert html_text.render(page)[0] == text


def test_many_rules_and_elements():
    import time

    page = "<style>" + "".join(f".c{i}{{display:none}}" for i in range(3000)) + "</style>" + "".join(f"<p class='c{i}'>no<p class=d{i}>yes" for i in range(3000))
    start = time.monotonic()
    assert html_text.render(page)[0].count("yes") == 3000
    assert time.monotonic() - start < 5
