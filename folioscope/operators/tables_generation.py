"""Synthetic tables with row invariants, their merged-cell layouts, and page composition."""

from __future__ import annotations

import html
import random
import re
from collections.abc import Callable

from folioscope.kernels.tables import span_grid
from folioscope.kernels.writing import grouped_head, half_years

#: Column keys of each table kind, those that may be dropped last; heads in English, Korean and Japanese.
SCHEMAS = {
    "financial": ("account", "current", "prior", "change", "rate"),
    "budget": ("item", "budget", "spent", "left", "rate"),
    "schedule": ("date", "time", "content", "place"),
    "roster": ("name", "department", "position", "phone"),
    "order": ("item", "quantity", "price", "amount"),
    "statistics": ("region", "y1", "y2", "y3", "y4"),
}
HEADS = {
    "account": ("Account", "계정", "科目"), "current": ("Current", "당기", "当期"), "prior": ("Prior", "전기", "前期"), "change": ("Change", "증감", "増減"), "rate": ("Rate", "비율", "比率"),
    "item": ("Item", "항목", "項目"), "budget": ("Budget", "예산", "予算"), "spent": ("Spent", "집행", "執行"), "left": ("Left", "잔액", "残額"), "date": ("Date", "날짜", "日付"), "time": ("Time", "시간", "時刻"),
    "content": ("Content", "내용", "内容"), "place": ("Place", "장소", "場所"), "name": ("Name", "성명", "氏名"), "department": ("Department", "부서", "部署"), "position": ("Position", "직위", "役職"),
    "phone": ("Phone", "연락처", "電話"), "quantity": ("Quantity", "수량", "数量"), "price": ("Price", "단가", "単価"), "amount": ("Amount", "금액", "金額"), "region": ("Region", "지역", "地域"),
    "period": ("Period", "기간", "期間"), "amounts": ("Amounts", "금액 내역", "金額内訳"), "h1": ("First half", "상반기", "上半期"), "h2": ("Second half", "하반기", "下半期"),
}
LANGUAGES = ("en", "ko", "ja")
#: Share of financial rows with a negative prior value.
NEGATIVE = 0.08


def head(key: str, lang: str) -> str:
    """The head of a column; English for other languages, the key itself for year columns."""
    names = HEADS.get(key)
    return names[LANGUAGES.index(lang) if lang in LANGUAGES else 0] if names else key


def amount(value: float, lang: str) -> str:
    """A signed amount as financial tables print it: △ in Korean, brackets in English, a minus sign elsewhere."""
    text = f"{abs(round(value)):,}"
    return text if value >= 0 else f"△{text}" if lang == "ko" else f"({text})" if lang == "en" else f"-{text}"


def percent(value: float, lang: str) -> str:
    return amount_sign(f"{abs(value):.1f}%", value, lang)


def amount_sign(text: str, value: float, lang: str) -> str:
    return text if value >= 0 else f"△{text}" if lang == "ko" else f"({text})" if lang == "en" else f"-{text}"


def rows_of(kind: str, count: int, rng: random.Random, words: list[str]) -> list[dict]:
    """``count`` rows of numbers and texts: change = current - prior, amount = quantity x price, left = budget - spent; an order ends with its total."""
    pick = lambda: rng.choice(words)
    out = []
    for i in range(count):
        if kind == "financial":
            prior = rng.randint(100, 99_999) * (-1 if rng.random() < NEGATIVE else 1)
            current = round(prior * (1 + rng.uniform(-0.35, 0.45)))
            out.append({"account": f"{i + 1}. {pick()}", "current": current, "prior": prior, "change": current - prior, "rate": 100 * (current - prior) / abs(prior)})
        elif kind == "budget":
            budget = rng.randint(10, 9_999) * 1000
            spent = min(round(budget * rng.uniform(0.4, 1.05)), budget)
            out.append({"item": pick(), "budget": budget, "spent": spent, "left": budget - spent, "rate": 100 * spent / budget})
        elif kind == "schedule":
            out.append({"date": f"{rng.randint(2019, 2025)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", "time": f"{rng.randint(8, 18):02}:{rng.choice((0, 30)):02}", "content": pick(), "place": pick()})
        elif kind == "roster":
            out.append({"name": pick(), "department": pick(), "position": rng.choice(("lead", "staff", "aide")), "phone": f"02-{rng.randint(100, 999)}-{rng.randint(1000, 9999)}"})
        elif kind == "order":
            quantity, price = rng.randint(1, 30), rng.randint(1, 900) * 10
            out.append({"item": pick(), "quantity": quantity, "price": price, "amount": quantity * price})
        else:
            value, row = rng.randint(100, 9_999), {"region": pick()}
            for k in range(1, 5):
                value = max(0, value + rng.randint(-300, 300))
                row[f"y{k}"] = value
            out.append(row)
    if kind == "schedule":
        out.sort(key=lambda r: (r["date"], r["time"]))
    if kind == "order":
        out.append({"item": "total", "quantity": "", "price": "", "amount": sum(r["amount"] for r in out)})
    return out


def shown(key: str, value, lang: str) -> str:
    if isinstance(value, str):
        return value
    return percent(value, lang) if key == "rate" else amount(value, lang)


def compatible(rows: tuple[int, int], columns: tuple[int, int]) -> list[str]:
    """Table kinds that fit the ranges of rows and columns."""
    need = {"financial": 3, "budget": 3, "schedule": 3, "roster": 2, "order": 4, "statistics": 2}
    return [k for k in SCHEMAS if rows[1] >= 2 and columns[1] >= need[k]]


def columns_of(kind: str, width: int) -> list[str]:
    """The first ``width`` columns of a kind, dropped from the right; an order keeps all."""
    return list(SCHEMAS[kind] if kind == "order" else SCHEMAS[kind][: max(2, width)])


def markdown_table(kind: str, rows: list[dict], columns: list[str], lang: str = "en") -> str:
    line = lambda cells: "| " + " | ".join(cells) + " |"
    out = [line([head(c, lang) for c in columns]), line(["---"] * len(columns))]
    return "\n".join(out + [line([shown(c, r[c], lang) for c in columns]) for r in rows])


def merged_table(kind: str, rows: list[dict], columns: list[str], lang: str = "en") -> list[list[tuple[str, int, int]]] | None:
    """Rows of (text, colspan, rowspan): equal dates or departments merged downwards, the label of a total across; None if nothing merges."""
    body: list[list[tuple[str, int, int]]] = []
    down = {"schedule": "date", "roster": "department"}.get(kind)
    if down and down in columns:
        columns = [down, *(c for c in columns if c != down)]
        ordered = sorted(rows, key=lambda r: [x[down] for x in rows].index(r[down]))
        runs: list[list[dict]] = []
        for r in ordered:
            if runs and runs[-1][0][down] == r[down]:
                runs[-1].append(r)
            else:
                runs.append([r])
        if all(len(run) == 1 for run in runs):
            return None
        for run in runs:
            for i, r in enumerate(run):
                body.append(([(shown(down, r[down], lang), 1, len(run))] if not i else []) + [(shown(c, r[c], lang), 1, 1) for c in columns[1:]])
    elif kind == "order" and len(columns) >= 3:
        for r in rows[:-1]:
            body.append([(shown(c, r[c], lang), 1, 1) for c in columns])
        body.append([("total", len(columns) - 1, 1), (shown(columns[-1], rows[-1][columns[-1]], lang), 1, 1)])
    else:
        return None
    table = [[(head(c, lang), 1, 1) for c in columns], *body]
    span_grid(table, len(columns))
    return table


#: Columns that stand below a common head, by table kind; a year of statistics has two halves.
GROUPS = {"financial": [("period", ("current", "prior"))], "budget": [("amounts", ("budget", "spent", "left"))]}


def grouped_table(kind: str, rows: list[dict], columns: list[str], rng: random.Random, lang: str = "en") -> tuple[list[list[tuple[str, int, int]]], int] | None:
    """(rows of (text, colspan, rowspan), number of head rows) with grouped heads; years of statistics are parted into halves that add up; None if nothing is grouped."""
    groups = GROUPS.get(kind, [])
    if kind == "statistics":
        years = columns[1 : 1 + max(1, (len(columns) - 1) // 2)]
        rows = [dict(r) for r in rows]
        for r in rows:
            for y in years:
                r[f"{y}_h1"], r[f"{y}_h2"] = half_years(int(r[y]), rng)
        groups = [(y, (f"{y}_h1", f"{y}_h2")) for y in years]
        columns = [columns[0], *(k for _, keys in groups for k in keys)]
    heads = grouped_head(columns, groups, lambda key: head(key.rsplit("_", 1)[-1] if key.endswith(("_h1", "_h2")) else key, lang))
    if len(heads) < 2:
        return None
    body = [[(f"{r[c]:,}" if kind == "statistics" and c != columns[0] else shown(c, r[c], lang), 1, 1) for c in columns] for r in rows]
    span_grid([*heads, *body], len(columns))
    return [*heads, *body], len(heads)


def html_table(rows: list[list[tuple[str, int, int]]], heads: int = 1) -> str:
    """HTML of a table with spans, its first rows as heads."""

    def cell(tag: str, text: str, wide: int, high: int) -> str:
        spans = f' colspan="{wide}"' * (wide > 1) + f' rowspan="{high}"' * (high > 1)
        return f"<{tag}{spans}>{html.escape(text)}</{tag}>"

    lines = ["<tr>" + "".join(cell("td" if i >= heads else "th", *c) for c in row) + "</tr>" for i, row in enumerate(rows)]
    return f"<table><thead>{''.join(lines[:heads])}</thead><tbody>{''.join(lines[heads:])}</tbody></table>"


_KOREAN = "가나다라마바사아자차카타파하"


def roman(number: int) -> str:
    out = ""
    for value, sign in ((1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        out += sign * (number // value)
        number %= value
    return out


def heading_mark(style: str, index: int) -> str:
    """The number of a heading: arabic, dotted, roman or korean; past the end of the letters, a number."""
    if style == "roman":
        return f"{roman(index)}."
    if style == "korean" and index <= len(_KOREAN):
        return f"{_KOREAN[index - 1]}."
    return f"{index}.0" if style == "dotted" else f"{index}."


def number_headings(page: str, style: str) -> str:
    """Second-level headings outside code numbered through the page."""
    index, code, out = 0, False, []
    for line in page.split("\n"):
        code ^= line.startswith(("```", "~~~"))
        if not code and re.match(r"## \S", line):
            index += 1
            line = f"## {heading_mark(style, index)} {line[3:]}"
        out.append(line)
    return "\n".join(out)


def sections(page: str) -> list[tuple[str, list[str]]]:
    """(heading, blocks) of a page; code fences aren't divided; what stands before the first heading has the heading ''."""
    out: list[tuple[str, list[str]]] = [("", [])]
    code, block = False, []

    def close() -> None:
        if block:
            out[-1][1].append("\n".join(block))
            block.clear()

    for line in page.split("\n"):
        code ^= line.startswith(("```", "~~~"))
        if not code and line.startswith("## "):
            close()
            out.append((line, []))
        elif not code and not line.strip():
            close()
        else:
            block.append(line)
    close()
    return out


def continuation(page: str, rng: random.Random, cut: float = 0.5) -> str:
    """The tail of a page as a following sheet shows it: from a later section on, without a title, perhaps from inside a paragraph."""
    parts = sections(page)
    starts = [i for i in range(1, len(parts)) if parts[i][1]]
    if not starts:
        return page
    parts = parts[rng.choice(starts) :]
    title, blocks = parts[0]
    pieces = re.split(r"(?<=[.!?。])\s+", blocks[0])
    if len(pieces) > 1 and not blocks[0].startswith(("|", "-", "`", "$", ">", "#")) and rng.random() < cut:
        parts[0] = ("", [" ".join(pieces[rng.randrange(1, len(pieces)) :]), *blocks[1:]])
    return "\n\n".join("\n\n".join(filter(None, [t, *b])) for t, b in parts)


def fit(page: str, overflow: float) -> str:
    """The leading chunks of a page that overflows its sheet, at least one with content, without headings at the end."""
    chunks = [c for c in re.split(r"\n\s*\n", page) if c.strip()]
    content = next((i for i, c in enumerate(chunks) if not c.lstrip().startswith("#")), 0)
    kept = chunks[: max(int(len(chunks) * 0.97 / max(overflow, 1e-9)), content + 1)] if overflow > 1 else chunks
    while len(kept) > 1 and kept[-1].lstrip().startswith("#"):
        kept.pop()
    return "\n\n".join(kept)


def mutate(text: str, share: float, similar: Callable[[str], list[tuple[str, float]]], rng: random.Random, protected: frozenset[str] = frozenset("#*_`|$<>[]()\\")) -> tuple[str, int]:
    """text with about ``share`` of the characters that have look-alikes replaced, and how many were; at least one if any has."""
    places = [i for i, ch in enumerate(text) if ch not in protected and not ch.isspace() and similar(ch)]
    count = min(len(places), max(1, int(len(places) * share))) if share > 0 and places else 0
    out = list(text)
    for i in rng.sample(places, count):
        names, weights = zip(*similar(out[i]))
        out[i] = rng.choices(names, [max(w, 1e-6) for w in weights])[0]
    return "".join(out), count


def furniture(rng: random.Random, words: list[str], number: int, total: int, lang: str = "en") -> dict[str, str]:
    """Header, footer and page number of a sheet; each slot may be empty."""
    styles = {"ko": f"{number}쪽", "ja": f"{number}頁"}
    mark = rng.choice([str(number), f"- {number} -", f"{number} / {total}", styles.get(lang, f"Page {number}")])
    return {"header": rng.choice(["", rng.choice(words), f"{rng.choice(words)} | {rng.choice(words)}"]), "footer": rng.choice(["", rng.choice(words)]), "page_number": rng.choice(["", mark, mark])}


def with_typos(text: str, alike: dict[str, list[str]], rng: random.Random, share: float = 0.15) -> str:
    """text with a look-alike letter in a share of its words, at least one; numbers and words of one letter stay.

    alike: letter -> letters that look like it, the likest first; one of the first five is taken.  Words are parted by single blanks.
    """
    words = text.split()
    wanted = min(max(int(len(words) * share), 1 if share > 0 else 0), len(words))
    able = [i for i, w in enumerate(words) if len(w) > 1 and any(alike.get(c) and not c.isnumeric() for c in w)]
    for i in rng.sample(able, min(wanted, len(able))):
        at = rng.choice([k for k, c in enumerate(words[i]) if alike.get(c) and not c.isnumeric()])
        words[i] = words[i][:at] + rng.choice(alike[words[i][at]][:5]) + words[i][at + 1 :]
    return " ".join(words) if words else text
