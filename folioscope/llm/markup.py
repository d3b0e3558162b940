"""Markup residue in texts: kinds found, and clean text that keeps structure (problem 2).

A text is read once: code (fenced, inline, pre, verbatim) and formulas are taken out as
content, then HTML, LaTeX, wiki and Markdown signs are recognised line by line and
replaced by one light layout: ``# `` headings, ``- `` items, `` | `` between cells,
fences around code, ``$`` around formulas.  The lengths of the remaining text are summed
over a sliding window of lines: a block of text begins where the sum surges, ends where
it dives, and what stands between is kept.  Lines of several links, menus and rights
notices have no text of their own, so navigation and footers lie outside of the blocks, as do
lines of mere signs; a line with words of its own is always a surge, however short.

Defined results: null gives null and no kinds; empty and blank texts give an empty text
and no kinds; an unclosed code fence runs to the end; signs that are part of the prose
(5 * 3 * 2, x < 5, raw_page_01, C:\\scans, $5) are no markup.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.truncation import fold
from folioscope.sources.shared import spread

KINDS = ("html", "latex", "markdown", "wiki")
#: Lines in the sliding window, and the characters of text in it that make a surge; with more than 1, short lines that stand alone are lost.
WINDOW = 3
SURGE = 1
#: Longest entry of a menu, and least entries or links of a line without text of its own.
ENTRY_CHARS = 24
ENTRIES = 2

#: Names of HTML elements.
_NAMES = (
    "a abbr address area article aside audio b base bdi bdo big blockquote body br button canvas caption center cite code col colgroup data dd del details dfn "
    "div dl dt em embed fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main "
    "map mark math meta nav noscript object ol optgroup option output p param picture pre progress q rp rt ruby s samp script section select small source span "
    "strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr"
)
#: Commands of LaTeX that need no argument in braces.
_COMMANDS = (
    "alpha beta gamma delta epsilon varepsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau upsilon phi varphi chi psi omega Gamma Delta Theta "
    "Lambda Xi Pi Sigma Phi Psi Omega sum prod int oint lim infty partial nabla sqrt frac dfrac tfrac binom cdot cdots ldots dots times div pm mp leq geq le ge "
    "neq ne approx equiv sim propto in notin subset subseteq cup cap forall exists to rightarrow leftarrow Rightarrow Leftarrow mapsto left right quad qquad "
    "item hline toprule midrule bottomrule bf it rm sf tt sc em bfseries itshape ttfamily small large Large tiny centering noindent newline newpage clearpage "
    "maketitle tableofcontents par log ln exp sin cos tan min max"
)
_TAG = re.compile(rf"<!--.*?(?:-->|$)|</?(?:{'|'.join(_NAMES.split())})(?:\s[^<>]*|/)?>|<!DOCTYPE[^>]*>", re.I | re.S)
_REFERENCE = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")
_COMMAND = re.compile(
    rf"(?<![\w:\\/])\\(?:{'|'.join(_COMMANDS.split())})(?![A-Za-z])|(?<=[A-Za-z0-9])\\(?:{'|'.join(_COMMANDS.split())})(?![A-Za-z])"
    r"|(?<![\w:\\/])\\[A-Za-z]{2,}\*?(?:\[[^\]\n]*\])?\{|\\(?:begin|end)\{[A-Za-z]+\*?\}"
)
_FORMULA = re.compile(r"\$\$(?=[^$]*[^$\s])(.+?)\$\$|\\\[(.+?)\\\]|\\\((.+?)\\\)|\\begin\{(equation|align|gather|math|displaymath)\*?\}(.+?)\\end\{\4\*?\}", re.S)
_CODE = re.compile(
    r"^[ \t]*(?P<fence>`{3,}|~{3,})[^\n`]*\n(?P<fenced>.*?)(?:^[ \t]*(?P=fence)[`~]*[ \t]*$|\Z)"
    r"|<(?P<tag>pre|code|tt|kbd|samp)\b[^<>]*>(?P<tagged>.*?)(?:</(?P=tag)>|\Z)"
    r"|\\begin\{(?P<env>verbatim|lstlisting|minted)\*?\}(?:\{\w+\})?(?P<verbatim>.*?)(?:\\end\{(?P=env)\*?\}|\Z)"
    r"|\\verb\*?(?P<bar>[|!+])(?P<verb>[^\n]*?)(?P=bar)"
    r"|<(?P<nowiki>nowiki|syntaxhighlight|source)\b[^<>]*>(?P<raw>.*?)(?:</(?P=nowiki)>|\Z)"
    r"|\{\{code\|(?P<wiki>[^{}]*)\}\}"
    r"|(?<!`)(?P<ticks>`{1,2})(?!`)(?P<inline>[^`\n]+)(?P=ticks)(?!`)",
    re.M | re.S | re.I,
)
_CODE_KINDS = (("fenced", "markdown"), ("tagged", "html"), ("verbatim", "latex"), ("verb", "latex"), ("raw", "wiki"), ("wiki", "wiki"), ("inline", "markdown"))

_WIKI_HEAD = re.compile(r"^(={1,6})[ \t]*([^=\n][^\n]*?)[ \t]*\1[ \t]*$", re.M)
_WIKI_EMPHASIS = re.compile(r"('{2,5})(?=[^'\s])([^'\n]+?)\1")
_WIKI_LINK = re.compile(r"\[\[(?:[^\[\]|\n]*\|)*([^\[\]|\n]+)\]\]")
_WIKI_TEMPLATE = re.compile(r"(?<![A-Za-z}\\])\{\{([^{}]+)\}\}")
_WIKI_TABLE = re.compile(r"^[ \t]*\{\|", re.M)

_HEADING = re.compile(r"^[ \t]{0,3}(#{1,6})[ \t]+(\S[^\n]*?)[ \t#]*$", re.M)
_UNDERLINED = re.compile(r"^(?![ \t]*(?:[|>#=]|[-*+][ \t]))(?=[^\n]*+\n[ \t]{0,3}(?:={3,}|-{3,})[ \t]*$)([^\n]*\w[^\n]*)\n[ \t]{0,3}(={3,}|-{3,})[ \t]*$", re.M)
_LINK = re.compile(r"(!?)\[([^\[\]\n]*)\]\(([^()\s]+(?:[ \t]+\"[^\"\n]*\")?)\)")
_STRONG = re.compile(r"(?<!\*)(\*{2,3})(?=[^\s*])([^*\n]+?)(?<=[^\s*])\1(?!\*)|(?<![\w_])(_{2,3})(?=[^\s_])([^\n]+?)(?<=[^\s_])\3(?![\w_])")
_EMPHASIS = re.compile(r"(?<![\w*])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![A-Za-z0-9*])|(?<![\w_])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?![\w_])")
_STRUCK = re.compile(r"~~(?=[^\s~])([^~\n]+?)(?<=[^\s~])~~")
_QUOTE = re.compile(r"^[ \t]{0,3}>+[ \t]?(?=\S)", re.M)
_ITEM = re.compile(r"^([ \t]*)(?:[-*+]|\d{1,3}\.)[ \t]+(?:\[[ xX]\][ \t]+)?(?=\S)", re.M)
_RULE = re.compile(r"^[ \t]*(?=[^\n]*\|)\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)*\|?[ \t]*$", re.M)

#: Private characters that stand for held code and formulas, heading levels, items and cell borders until the end.
_HELD, _HEAD, _POINT, _CELL, _OPEN, _CLOSE = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004", "\ue005"
_LINKED = re.compile(f"{_OPEN}[^{_OPEN}{_CLOSE}\n]*{_CLOSE}")
_MENU = re.compile(r"[ \t]+[|·•»›/][ \t]+")
#: Words of rights notices.
_RIGHTS = re.compile(r"©|\(c\)[ \t]*(?:19|20)\d\d|\bcopyright\b|\ball rights reserved\b|저작권|무단[ \t]*(?:전재|복제)|無断転載|著作権", re.I)
_LETTER = re.compile(r"[^\W_]").search
_HOLE = re.compile(_HELD + r"(\d+)" + _HELD)


def _strip_html(text: str, kinds: set[str]) -> str:
    def tag(m: re.Match) -> str:
        kinds.add("html")
        name = m[0].strip("</>").split(None, 1)[0].lower() if m[0][:2] != "<!" else ""
        if re.fullmatch(r"h[1-6]", name):
            return "\n" + _HEAD * int(name[1]) if m[0][1] != "/" else "\n"
        if name == "li":
            return "\n" + _POINT if m[0][1] != "/" else ""
        if name in ("td", "th"):
            return _CELL if m[0][1] == "/" else ""
        if name == "a":
            return _CLOSE if m[0][1] == "/" else _OPEN
        if name == "tr":
            return "\n" if m[0][1] != "/" else ""
        return "\n" if name.rstrip("/") in ("p", "br", "div", "table", "ul", "ol", "blockquote", "hr", "section") else ""

    return _TAG.sub(tag, text)


def _strip_latex(text: str) -> str:
    text = re.sub(r"\\((?:sub)*)(?:section|chapter|paragraph|title)\*?\{([^{}\n]*)\}", lambda m: f"\n{_HEAD * (1 + len(m[1]) // 3)}{m[2]}\n", text)
    text = re.sub(r"\\(?:cite|ref|label|includegraphics|usepackage|documentclass)(?:\[[^\]\n]*\])?\{[^{}\n]*\}", "", text)
    text = re.sub(r"\\(?:begin|end)\{[^{}\n]*\}(?:\{[lcr| ]+\})?", "\n", text)
    text = re.sub(r"\\item\b[ \t]*(?:\[([^\]\n]*)\])?", "\n" + _POINT + r"\1", text)
    text = re.sub(r"[ \t]*\\\\[ \t]*$", "", text, flags=re.M)
    text = re.sub(r"(?<!\\)[ \t]+&[ \t]+", _CELL, text)
    for _ in range(2):
        text = re.sub(r"(?<![\w:\\/])\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{([^{}\n]*)\}", r"\1", text)
    text = re.sub(r"\{\\[A-Za-z]+[ \t]+([^{}\n]*)\}", r"\1", text)
    text = re.sub(r"(?<![\w:\\/])\\(?:hline|toprule|midrule|bottomrule|centering|noindent|maketitle|newpage|par)\b", "", text)
    return re.sub(r"\\([%&#_{}$])", r"\1", text)


def analyse(text: str | None, clean: bool = True) -> tuple[str | None, list[str]]:
    """Clean text (None without ``clean``) and the kinds of markup of one text."""
    if not text:
        return text, []
    text = fold(text)
    kinds: set[str] = set()
    held: list[str] = []

    def hold(body: str) -> str:
        held.append(body)
        return f"{_HELD}{len(held) - 1}{_HELD}"

    def code(m: re.Match) -> str:
        for group, kind in _CODE_KINDS:
            if (body := m[group]) is not None:
                kinds.add(kind)
                return hold(f"`{body}`" if group in ("inline", "verb", "wiki") or "\n" not in body.strip("\n") and group == "tagged" else "```\n" + body.strip("\n") + "\n```")
        return m[0]

    def formula(m: re.Match) -> str:
        kinds.add("latex")
        body = next(g for g in (m[1], m[2], m[3], m[5]) if g is not None)
        return hold(f"${body.strip()}$")

    if "`" in text or "~~~" in text or "<" in text or "\\" in text or "{{" in text:
        text = _CODE.sub(code, text)
    if "$$" in text or "\\" in text:
        text = _FORMULA.sub(formula, text)
    if "<" in text:
        text = _strip_html(text, kinds)
    if "&" in text and _REFERENCE.search(text) and (plain := html.unescape(text)) != text:
        kinds.add("html")
        text = plain
    if "\\" in text and _COMMAND.search(text):
        kinds.add("latex")
        if clean:
            text = _strip_latex(text)

    def take(pattern: re.Pattern, put, kind: str) -> None:
        nonlocal text
        if clean:
            text, n = pattern.subn(put, text)
            if n:
                kinds.add(kind)
        elif kind not in kinds and pattern.search(text):
            kinds.add(kind)

    if "[" in text:
        take(_WIKI_LINK, _OPEN + r"\1" + _CLOSE, "wiki")
        take(_LINK, lambda m: m[2] if m[1] else _OPEN + m[2] + _CLOSE, "markdown")
    if "{" in text:
        take(_WIKI_TEMPLATE, lambda m: m[1].rsplit("|", 1)[-1], "wiki")
        if "{|" in text and _WIKI_TABLE.search(text):
            kinds.add("wiki")
            text = re.sub(r"^[ \t]*(?:\{\|[^\n]*|\|\}|\|-[^\n]*)$", "", text, flags=re.M)
            text = re.sub(r"^[ \t]*[|!][ \t]*", "", re.sub(r"[ \t]*(?:\|\||!!)[ \t]*", _CELL, text), flags=re.M)
    if "''" in text:
        take(_WIKI_EMPHASIS, r"\2", "wiki")
    if "=" in text:
        take(_WIKI_HEAD, lambda m: _HEAD * max(len(m[1]) - 1, 1) + m[2], "wiki")
    if "#" in text:
        take(_HEADING, lambda m: _HEAD * len(m[1]) + m[2], "markdown")
    if "===" in text or "--" in text:
        take(_RULE, "", "markdown")
        take(_UNDERLINED, _HEAD + r"\1", "markdown")
    if "~~" in text:
        take(_STRUCK, r"\1", "markdown")
    if "*" in text or "_" in text:
        take(_STRONG, lambda m: m[2] or m[4], "markdown")
        take(_EMPHASIS, lambda m: m[1] or m[2], "markdown")
    if ">" in text:
        take(_QUOTE, "", "markdown")
    take(_ITEM, lambda m: m[1] + (m[0].split()[0] + " " if m[0].lstrip()[0].isdigit() else _POINT), "markdown")
    if not clean:
        return None, sorted(kinds)
    return "\n".join(_main_lines(text, held)), sorted(kinds)


def own_size(line: str) -> int:
    """Characters of text of a line; none if it holds no letter or digit, several links alone, a menu or a rights notice."""
    if not _LETTER(line):
        return 0
    if _CELL in line or line[0] in "#" + _HEAD + _POINT + _HELD:
        return len(line)
    if len(line) < 200 and _RIGHTS.search(line):
        return 0
    if len(_LINKED.findall(line)) >= ENTRIES and not _LETTER(_LINKED.sub("", line)):
        return 0
    entries = _MENU.split(line.strip("|").strip())
    if len(entries) > ENTRIES and not line.startswith("|") and all(0 < len(e) <= ENTRY_CHARS and not any(c.isdigit() for c in e) for e in entries):
        return 0
    return len(line)


def _main_lines(text: str, held: list[str]) -> list[str]:
    """Lines of the blocks from surge to dive: the text summed over the window stays at SURGE or more, and the outer lines have text of their own."""
    lines = [line.strip() for line in text.split("\n")]
    sizes = [own_size(line) for line in lines]  # held code and formulas count by their number
    reach = WINDOW // 2
    total = [0]
    for size in sizes:
        total.append(total[-1] + size)
    inside = [total[min(i + reach + 1, len(lines))] - total[max(i - reach, 0)] >= SURGE for i in range(len(lines))]
    at = 0
    while at < len(lines):  # a block is a run of such lines, less those without text at its ends
        end = at
        while end < len(lines) and inside[end]:
            end += 1
        own = [i for i in range(at, end) if sizes[i]]
        for i in range(at, end):
            inside[i] = bool(own) and own[0] <= i <= own[-1]
        at = end + 1
    out: list[str] = []
    for i, line in enumerate(lines):
        if not line or not inside[i]:
            if out and out[-1]:
                out.append("")
        elif sizes[i] or not any(c in line for c in "|{}<>\\"):
            line = line.removesuffix(_CELL).strip("|").strip() if "|" in line or _CELL in line else line
            if (heads := len(line) - len(line.lstrip(_HEAD))) > 0:
                line = "#" * min(heads, 6) + " " + line.lstrip(_HEAD).strip()
            line = line.replace(_POINT, "- ").replace(_CELL, " | ").replace(_HEAD, "").replace(_OPEN, "").replace(_CLOSE, "")
            out.append(_HOLE.sub(lambda m: held[int(m[1])], line))
    while out and not out[-1]:
        out.pop()
    return out


def markup(df: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """(key, field_name, clean_text, kinds) of each text column of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, name in enumerate(texts, 1):
                known: dict[str | None, tuple] = {}  # pages that many rows share are read once
                values = batch.column(i).to_pylist()
                rows = [known.get(v) or known.setdefault(v, analyse(v)) for v in values]
                clean, kinds = zip(*rows, strict=True) if rows else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([name] * len(values), pa.string()), pa.array(clean, pa.string()), pa.array(kinds, pa.list_(pa.string()))],
                    ["key", "field_name", "clean_text", "kinds"],
                )

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(df[key].alias("key"), *(df[t].alias(f"t{i}") for i, t in enumerate(texts)))
    return spread(rows).mapInArrow(run, f"key {kind}, field_name string, clean_text string, kinds array<string>").withColumnRenamed("key", key)


def found_kinds(df: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """(key, field_name, markup_kind): one row per kind of markup in a field."""
    return markup(df, key, texts).select(key, "field_name", F.explode("kinds").alias("markup_kind"))
