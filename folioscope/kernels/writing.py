"""Text of synthetic pages: list conventions, formulas from a grammar, small values, and changes that keep a page's marks."""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterable, Iterator

#: Marks of Korean official lists, circled numbers, and titles of law articles.
BULLETS = ("○", "□", "▪", "ㆍ")
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮"
SYLLABLES = "가나다라마바사아자차카타파하"
ARTICLE_TITLES = ("목적", "정의", "적용범위", "책무", "기본원칙", "위임")
NOTE = "※"

_ITEM = {"bullet_list": re.compile(r"[-*+]\s+(?P<body>\S.*)"), "numbered_list": re.compile(r"\d+\.\s+(?P<body>\S.*)")}


def items_of(block: str, kind: str) -> list[str]:
    """The items of a list block; none if one of its lines is no item."""
    found = [_ITEM[kind].fullmatch(line.strip()) for line in block.splitlines()]
    return [m["body"].strip() for m in found] if found and all(found) else []


def numbered_mark(number: int, style: str) -> str:
    """The mark of an item: 1\\), 가) or ①; numbers beyond a style's signs fall back to 1\\)."""
    signs = {"syllable": SYLLABLES, "circled": CIRCLED}.get(style, "")
    if number > len(signs):
        return f"{number}\\)"
    return signs[number - 1] + (")" if style == "syllable" else "")


def official_list(block: str, kind: str, rng: random.Random, style: str = "circled", note: str | None = None) -> str:
    """A list as Korean offices write it, with a note below it if one is given; a block that is no list of the kind stays."""
    items = items_of(block, kind)
    if not items:
        return block
    bullet = rng.choice(BULLETS)
    marks = [bullet] * len(items) if kind == "bullet_list" else [numbered_mark(i, style) for i in range(1, len(items) + 1)]
    return "\n".join([f"{m} {x}" for m, x in zip(marks, items, strict=True)] + ([f"{NOTE} {note}"] if note else []))


def law_article(block: str, number: int, rng: random.Random) -> str:
    """A numbered list as an article of a law: its first item is the article, the others its clauses."""
    items = items_of(block, "numbered_list")
    if not items:
        return block
    head = f"제{number}조({rng.choice(ARTICLE_TITLES)}) {items[0]}"
    return "\n".join([head, *(f"{numbered_mark(i, 'circled')} {x}" for i, x in enumerate(items[1:], 1))])


def flag(chance: float | bool | dict | None, rng: random.Random) -> bool:
    """Whether something is done: a probability, {"p": probability}, or a truth value; None and what is no number mean no."""
    if isinstance(chance, dict):
        chance = chance.get("p")
    if isinstance(chance, bool) or chance is None:
        return bool(chance)
    try:
        return rng.random() < float(chance)
    except (TypeError, ValueError):
        return False


#: A grammar of formulas: symbol -> weighted forms; <T> is a term one level deeper, other names in angle brackets are symbols.
GRAMMAR: dict[str, tuple[tuple[float, str], ...]] = {
    "formula": (
        (26, "<T> <rel> <T>"), (8, r"\int_{<small>}^{<large>} <T>\, dx"), (10, r"\int <T>\, dt = <T> + C"), (9, r"\frac{d}{dx}\left(<T>\right) = <T>"), (7, r"\frac{\partial}{\partial t}\left(<T>\right) = <T>"),
        (8, r"\sum_{k=0}^{\infty} <T>"), (6, r"\sum_{i=1}^{<large>} <T> = <T>"), (10, r"\lim_{n\to <end>} <T>"), (6, r"P(A\mid B) = \frac{P(B\mid A)P(A)}{P(B)}"), (4, r"f_X(x) = \frac{1}{\sigma\sqrt{2\pi}}\exp\left(-\frac{(x-\mu)^2}{2\sigma^2}\right)"),
        (6, r"\|\mathbf{u} + \mathbf{v}\|_2 \le \|\mathbf{u}\|_2 + \|\mathbf{v}\|_2"), (5, "<small>x^{<small>} + <large>x + <large> = 0"), (5, r"\log_{<small>}(<small>^{<var>}) = <T>"),
    ),
    "T": ((34, "<T> <op> <T>"), (16, r"\frac{<T>}{<T>}"), (16, r"\left(<T>\right)^{<small>}"), (14, r"<fun>\left(<T>\right)"), (8, r"\sqrt{<T>}"), (12, "<leaf>")),
    "leaf": ((4, "<var>"), (3, "<small><var>"), (2, "<large>"), (1, "<greek>")),
    "rel": ((2, "="), (1, r"\leq"), (1, r"\geq")), "op": ((1, "+"), (1, "-"), (1, r"\cdot")), "fun": ((1, r"\sin"), (1, r"\cos"), (1, r"\tan"), (1, r"\ln")),
    "var": ((1, "x"), (1, "y"), (1, "n"), (1, "t")), "greek": ((1, r"\alpha"), (1, r"\beta"), (1, r"\theta")), "small": tuple((1, str(i)) for i in range(2, 10)), "large": tuple((1, str(i)) for i in range(10, 31)), "end": ((1, "0"), (1, r"\infty")),
}
_SYMBOL = re.compile(r"<([A-Za-z]+)>")


def formula(rng: random.Random, symbol: str = "formula", depth: int = 3) -> str:
    """A formula drawn from the grammar; terms deeper than ``depth`` are leaves."""
    forms = GRAMMAR["leaf" if symbol == "T" and depth <= 0 else symbol]
    body = rng.choices([f for _, f in forms], [w for w, _ in forms])[0]
    return _SYMBOL.sub(lambda m: formula(rng, m[1], depth - (m[1] == "T")), body)


def merged_scripts(expression: str) -> str:
    """An expression in which a base has one power and one index: those that follow one another are put into one group."""
    script = r"([\^_])(\{(?:[^{}]|\{[^{}]*\})*\}|\\[A-Za-z]+|[^\s{}\\^_])"
    inner = lambda s: s[1:-1] if s.startswith("{") else s

    def merge(m: re.Match) -> str:
        parts: dict[str, str] = {}
        for sign, body in re.findall(script, m[0]):
            parts[sign] = parts.get(sign, "") + inner(body)
        return "".join(f"{sign}{{{body}}}" for sign, body in parts.items())

    return re.sub(rf"(?:{script}){{2,}}", merge, expression)


def in_turn(pool: Iterable[str], rng: random.Random) -> Iterator[str]:
    """Members of a pool without end, each once in a round, in another order each round; '' of an empty pool."""
    pool = list(pool)
    while True:
        rng.shuffle(pool)
        yield from pool or [""]


#: Forms of small values by language: # is a digit, other letters stand for themselves; * is any other language.
FORMS = {
    "phone": {"ko": "010-####-####", "ja": "090-####-####", "*": "(###) ###-####"}, "reference": {"*": "AB-####"}, "receipt": {"*": "########"}, "zip": {"ko": "#####", "ja": "###-####", "*": "#####"},
    "registration": {"ko": "###-##-#####", "*": "##-#######"}, "percent": {"*": "##.#%"}, "version": {"*": "#.#.#"}, "room": {"ko": "###호", "ja": "###号室", "*": "Room ###"},
}


def value(kind: str, lang: str, rng: random.Random, words: list[str] = ()) -> str:
    """A small value of a page: one of FORMS, a date (2019 to 2025), a time of the working day, an amount, or words: name, title, sentence, paragraph."""
    if kind in FORMS:
        form = FORMS[kind].get(lang, FORMS[kind]["*"])
        return re.sub("#", lambda m: str(rng.randint(1 if not m.start() else 0, 9)), form)
    if kind == "date":
        return f"{rng.randint(2019, 2025):04d}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    if kind == "time":
        return f"{rng.randint(8, 18):02d}:{rng.choice((0, 10, 20, 30, 40, 50)):02d}"
    if kind == "amount":
        return f"{rng.randint(1, 9_999) * 10:,}"
    counts = {"name": (1, 1), "title": (2, 4), "sentence": (6, 12), "header": (1, 2)}
    if kind == "paragraph":
        return " ".join(value("sentence", lang, rng, words) for _ in range(rng.randint(2, 5)))
    if kind not in counts or not words:
        raise ValueError(f"no value of kind {kind!r}" if kind not in counts else f"{kind} needs words")
    text = (" " if lang not in ("ja", "zh") else "").join(rng.choice(words) for _ in range(rng.randint(*counts[kind])))
    if kind == "sentence":
        return text[:1].upper() + text[1:] + {"ja": "。", "zh": "。"}.get(lang, ".")
    return text


_FENCE = re.compile(r"^[ \t]*(?:```|~~~)")
#: Marks at the start of a line that a change of its text leaves alone.
_PREFIX = re.compile(r"^(?P<prefix>[ \t]*(?:#{1,6} |> |[-*+] (?:\[[ xX]\] )?|\d+[.)] )?)(?P<body>.*)$")


def page_chunks(page: str) -> list[str]:
    """Parts of a page between blank lines; a fenced block is one part, an open one runs to the end."""
    out: list[list[str]] = [[]]
    fenced = False
    for line in page.splitlines():
        if line.strip() or fenced:
            out[-1].append(line)
        elif out[-1]:
            out.append([])
        fenced ^= bool(_FENCE.match(line))
    return ["\n".join(lines) for lines in out if lines]


def mutate_page(page: str, share: float, change: Callable[[str, float], tuple[str, int]]) -> tuple[str, int]:
    """A page whose prose, list items, quotes and table cells went through change(text, share), and how much changed.

    Code, formulas, images, rules and the marks of lines stay.
    """
    total, out = 0, []

    def changed(text: str) -> str:
        nonlocal total
        text, n = change(text, share) if any(c.isalnum() for c in text) else (text, 0)
        total += n
        return text

    for chunk in page_chunks(page):
        lines = chunk.split("\n")
        whole = chunk.strip()
        if _FENCE.match(chunk) or whole.startswith(("$$", "\\[", "![", "<")):
            out.append(chunk)
        elif all("|" in line for line in lines):
            out.append("\n".join(line if re.fullmatch(r"[|:\-\s]+", line) else "|".join(changed(c) for c in line.split("|")) for line in lines))
        else:
            parts = [_PREFIX.match(line) for line in lines]
            out.append("\n".join(m["prefix"] + changed(m["body"]) for m in parts))
    return "\n\n".join(out), total


def grouped_head(columns: list[str], groups: list[tuple[str, tuple[str, ...]]], name: Callable[[str], str] = str) -> list[list[tuple[str, int, int]]]:
    """Rows of head cells (text, colspan, rowspan): columns that stand together as a group's get a cell above them, others reach over both rows.

    A group of which a column is missing, or parted from the others, isn't drawn; without any group there is one row.
    """
    top: list[tuple[str, int, int]] = []
    below: list[tuple[str, int, int]] = []
    at = 0
    while at < len(columns):
        label, keys = next((g for g in groups if tuple(columns[at : at + len(g[1])]) == tuple(g[1])), (None, (columns[at],)))
        if label is None:
            top.append((name(columns[at]), 1, 2))
        else:
            top.append((name(label), len(keys), 1))
            below += [(name(k), 1, 1) for k in keys]
        at += len(keys)
    return [top, below] if below else [[(text, 1, 1) for text, *_ in top]]


def half_years(total: int, rng: random.Random, low: float = 0.42, high: float = 0.58) -> tuple[int, int]:
    """A year's total as two halves that add up to it."""
    first = round(total * rng.uniform(low, high))
    return first, total - first
