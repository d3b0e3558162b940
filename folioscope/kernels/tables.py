"""Tables: conversion between Markdown, HTML and cells, and the tree edit distance of their structure."""

from __future__ import annotations

import re
import unicodedata
from html.parser import HTMLParser
from itertools import groupby

from folioscope.kernels.outputs import json_value

VOID = {"br", "hr", "img", "input", "col", "meta", "link", "wbr"}
#: A start tag of the key ends open elements of the values, up to the enclosing table.
ENDS = {"td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "tbody": {"td", "th", "tr", "thead", "tbody"}, "tfoot": {"td", "th", "tr", "tbody"}}


class _Tree(HTMLParser):
    """Nodes (label, children) of the first table, label = (tag, colspan, rowspan)."""

    def __init__(self) -> None:
        super().__init__()
        self.root: tuple | None = None
        self.open: list[tuple] = []
        self.done = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.done or (not self.open and tag != "table"):
            return
        while self.open and self.open[-1][0][0] in ENDS.get(tag, ()):
            self.open.pop()
        given = dict(attrs)
        node = ((tag, int(given.get("colspan") or 1), int(given.get("rowspan") or 1)), [])
        if self.open:
            self.open[-1][1].append(node)
        else:
            self.root = node
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if self.open and tag not in VOID and self.open[-1][0][0] == tag:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0][0] == tag:
                del self.open[i:]
                self.done = self.done or not self.open
                return


def tree(table_html: str) -> tuple:
    parser = _Tree()
    parser.feed(table_html)
    return parser.root or (("table", 1, 1), [])


def _postorder(node: tuple) -> tuple[list, list[int]]:
    """Labels in postorder with the index of each subtree's leftmost leaf."""
    labels, left = [], []

    def visit(n: tuple) -> int:
        first = None
        for child in n[1]:
            at = visit(child)
            first = at if first is None else first
        labels.append(n[0])
        left.append(len(labels) - 1 if first is None else first)
        return left[-1]

    visit(node)
    return labels, left


def tree_distance(a: tuple, b: tuple) -> int:
    """Least number of insertions, deletions and relabellings of nodes that turn one ordered tree into the other."""
    la, fa = _postorder(a)
    lb, fb = _postorder(b)
    keys = [sorted({f: i for i, f in enumerate(left)}.values()) for left in (fa, fb)]
    whole = [[0] * len(lb) for _ in la]
    for i in keys[0]:
        for j in keys[1]:
            rows, cols = i - fa[i] + 2, j - fb[j] + 2
            forest = [[0] * cols for _ in range(rows)]
            for x in range(1, rows):
                forest[x][0] = x
            for y in range(1, cols):
                forest[0][y] = y
            for x in range(1, rows):
                p = fa[i] + x - 1
                above, here = forest[x - 1], forest[x]
                for y in range(1, cols):
                    q = fb[j] + y - 1
                    cost = min(above[y], here[y - 1]) + 1
                    if fa[p] == fa[i] and fb[q] == fb[j]:
                        here[y] = whole[p][q] = min(cost, above[y - 1] + (la[p] != lb[q]))
                    else:
                        here[y] = min(cost, forest[fa[p] - fa[i]][fb[q] - fb[j]] + whole[p][q])
    return whole[-1][-1]


def _size(node: tuple) -> int:
    return 1 + sum(map(_size, node[1]))


def teds(prediction: str, truth: str, normalization: str = "sum") -> float:
    """1 less the tree distance over the sum (or the larger) of the sizes; cell text isn't compared; 0 if a span is no number."""
    if prediction == truth:
        return 1.0
    try:
        a, b = tree(prediction), tree(truth)
    except ValueError:
        return 0.0
    size = _size(a) + _size(b) if normalization == "sum" else max(_size(a), _size(b))
    return 1.0 - tree_distance(a, b) / size


_RULE = re.compile(r"[ \t]*\|?(?:[ \t]*:?-{3,}:?[ \t]*\|)+(?:[ \t]*:?-{3,}:?)?[ \t]*")
_TABLE = re.compile(r"<table\b[^>]*>.*?</table>", re.I | re.S)


def is_rule(line: str) -> bool:
    """Whether line is the rule below the head of a pipe table: two or more columns of three or more hyphens."""
    return line.count("---") > 1 and _RULE.fullmatch(line) is not None


def is_piped(line: str) -> bool:
    return line.count("|") > 1


def cells_of(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def from_markdown(block: str) -> str:
    """HTML of a pipe table: the first row as heads, rules left out; '' if there is no row."""
    rows = [cells_of(line) for line in block.splitlines() if is_piped(line) and not is_rule(line)]
    marked = ["".join(f"<{tag}>{c}</{tag}>" for c in cells) for tag, part in (("th", rows[:1]), ("td", rows[1:])) for cells in part]
    return f"<table><tr>{'</tr><tr>'.join(marked)}</tr></table>" if marked else ""


def _given(value) -> str:
    """The table that a JSON answer gives as html or table.html."""
    inner = value.get("table") if isinstance(value, dict) else None
    options = [value.get("html") if isinstance(value, dict) else None, inner.get("html") if isinstance(inner, dict) else None]
    return next((m[0] for x in options if isinstance(x, str) and (m := _TABLE.search(x))), "")


def html_of(text: str) -> str:
    """The table in text as HTML: written so, inside JSON, or the first run of piped lines if a rule is its second; '' if there is none."""
    if found := _TABLE.search(text):
        return found[0]
    if "{" in text and (found := _given(json_value(text))):
        return found
    piped = next((list(lines) for hit, lines in groupby(text.splitlines(), is_piped) if hit), [])
    return from_markdown("\n".join(piped)) if len(piped) > 1 and is_rule(piped[1]) else ""


class _Scored(HTMLParser):
    """Rewrites the first table while it is read: heads as cells, no sections, wrappers or style."""

    WRAPPERS = frozenset("thead tbody span sup sub div p".split())
    STYLE = frozenset("style height width align class".split())

    def __init__(self) -> None:
        super().__init__()
        self.depth = 0
        self.hidden = ""
        self.parts: list[str] = []
        self.closed = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.closed or self.hidden:
            return
        self.depth += tag == "table"
        if not self.depth or tag in self.WRAPPERS or (tag == "table" and self.depth == 1):
            return
        if tag in ("math", "colgroup"):
            self.hidden = tag
            if tag == "math" and (alt := dict(attrs).get("alttext")):
                self.parts.append(f"${alt}$")
            return
        kept = "".join(f' {k}="{v or ""}"' for k, v in attrs if k not in self.STYLE)
        self.parts.append(f"<{'td' if tag == 'th' else tag}{kept}>")

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if self.hidden == tag:
            self.hidden = ""

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            self.hidden = "" if tag == self.hidden else self.hidden
        elif self.depth and not self.closed:
            self.depth -= tag == "table"
            self.closed = not self.depth
            if self.depth and tag not in self.WRAPPERS:
                self.parts.append(f"</{'td' if tag == 'th' else tag}>")

    def handle_data(self, data: str) -> None:
        if self.depth and not self.hidden and not self.closed:
            self.parts.append(unicodedata.normalize("NFKC", data.replace("\n", "")))


def normal_html(text: str) -> str:
    """The first table of text in the form that is scored; '' if there is none, or nothing in it."""
    reader = _Scored()
    reader.feed(text)
    body = " ".join("".join(reader.parts).split()) if reader.closed else ""
    return f'<html><body><table border="1">{body}</table></body></html>' if body else ""


class _Cells(HTMLParser):
    """Texts of the cells of each closed row; character references stay as written."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.rows: list[list[str]] = []
        self.row: list[str] | None = None
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.row = [] if self.row is None else self.row
        elif tag in ("td", "th") and self.row is not None and self.cell is None:
            self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None:
            self.row.append("".join(self.cell).strip())
            self.cell = None
        elif tag == "tr" and self.row is not None:
            self.rows.append(self.row)
            self.row = self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)

    def handle_entityref(self, name: str) -> None:
        self.handle_data(f"&{name};")

    def handle_charref(self, name: str) -> None:
        self.handle_data(f"&#{name};")


def to_cells(table_html: str | None) -> dict:
    """{cells: [{row, col, text}], num_rows, num_cols} of an HTML table; nothing for a text without one."""
    reader = _Cells()
    if table_html and "<table" in table_html.lower():
        reader.feed(table_html)
    cells = [{"row": i, "col": j, "text": t} for i, row in enumerate(reader.rows) for j, t in enumerate(row)]
    return {"cells": cells, "num_rows": len(reader.rows), "num_cols": max(map(len, reader.rows), default=0)}


def _ratio(a: float, b: float) -> float:
    return a / b if b else 0.0


def detected(guess: int, truth: int) -> tuple[float, float, float]:
    """Precision, recall and F1 of counted rows or columns: as many as both sides have are right."""
    precision, recall = _ratio(min(guess, truth), guess), _ratio(min(guess, truth), truth)
    return precision, recall, _ratio(2 * precision * recall, precision + recall)


def cell_scores(guess: dict, truth: dict) -> dict[str, float]:
    """Texts of the cells that stand in the same row and column of both tables; cells empty on both sides don't count."""
    from folioscope.kernels.blocks import cer  # this module is read by blocks

    sides = [{(c["row"], c["col"]): c.get("text") or "" for c in t["cells"]} for t in (guess, truth)]
    rates = [(cer(text, sides[0][at]), len(text)) for at, text in sides[1].items() if at in sides[0] and (text or sides[0][at])]
    right = sum(rate == 0 for rate, _ in rates)
    return {
        "avg_cer": _ratio(sum(rate * size for rate, size in rates), sum(size for _, size in rates)), "cell_accuracy": _ratio(right, len(rates)),
        "perfect_cells": float(right), "total_cells": float(len(rates)),
    }


def table_scores(guess_html: str, truth_html: str, guess: dict | None = None, truth: dict | None = None) -> dict[str, float]:
    """All scores of a table: structure, cells, rows and columns; the cells are read from the HTML if they aren't given."""
    a, b = html_of(guess_html), html_of(truth_html)
    guess, truth = guess or to_cells(a), truth or to_cells(b)
    out = {"teds": teds(a, b) if a and b else float(not a and not b)} | cell_scores(guess, truth)
    f1s = []
    for name, count in (("row", "num_rows"), ("column", "num_cols")):
        values = detected(guess[count], truth[count])
        out |= {f"{name}_{k}": v for k, v in zip(("precision", "recall", "f1"), values, strict=True)}
        f1s.append(values[2])
    return out | {"structure_f1": _ratio(2 * f1s[0] * f1s[1], sum(f1s))}


def span_grid(rows: list[list[tuple[str, int, int]]], width: int) -> list[list[int | None]]:
    """Which cell covers each slot when cells (text, colspan, rowspan) are placed as a browser does; ValueError if they don't fit."""
    grid: list[list[int | None]] = []
    number = 0
    for i, row in enumerate(rows):
        while len(grid) <= i:
            grid.append([None] * width)
        at = 0
        for text, wide, high in row:
            if wide < 1 or high < 1:
                raise ValueError(f"span below 1 at {text!r}")
            while at < width and grid[i][at] is not None:
                at += 1
            if at + wide > width:
                raise ValueError(f"row {i} is wider than {width}")
            if i + high > len(rows):
                raise ValueError(f"a span of row {i} leaves the table")
            for y in range(i, i + high):
                while len(grid) <= y:
                    grid.append([None] * width)
                if any(grid[y][x] is not None for x in range(at, at + wide)):
                    raise ValueError(f"cells overlap in row {y}")
                grid[y][at : at + wide] = [number] * wide
            number += 1
            at += wide
        if any(v is None for v in grid[i]):
            raise ValueError(f"row {i} has empty slots")
    return grid
