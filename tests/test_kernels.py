import random

import numpy as np
import pytest

from folioscope.kernels import blocks, layout, outputs, tables

TABLE = "| Port | Tons |\n|:---|---:|\n| Oslo | 41 |\n| Kobe | 7 |"
PAGE = f"Harbour log\n\n{TABLE}\n\n$$a_1 \\leq b$$\n\nSigned by the clerk"


def test_blocks():
    assert [k for k, _ in blocks.split(PAGE)] == ["text", "table", "formula", "text"]
    assert blocks.split(None) == blocks.split(" \n") == []
    assert [k for k, _ in blocks.split("a | b | c\nno rule | here |\n" + TABLE + "\nlast | row |")] == ["text", "table"]
    assert [k for k, _ in blocks.split("| a | b |\n" + TABLE)] == ["text", "table"]


def test_page_scores():
    assert blocks.page_scores(PAGE, PAGE) == (1.0,) * 5
    parts = PAGE.split("\n\n")
    moved = "\n\n".join([parts[2], parts[0], parts[3], parts[1]])
    assert blocks.page_scores(moved, PAGE)[3] < 1 and blocks.page_scores(moved, PAGE)[4] < 1
    html = "<table><thead><tr><th>Port</th><th>Tons</th></tr></thead><tbody><tr><td>Oslo</td><td>41</td></tr><tr><td>Kobe</td><td>7</td></tr></tbody></table>"
    assert blocks.page_scores(html, TABLE)[1] == 1.0
    assert blocks.page_scores(r"$$\mathrm{Q} = \left[ 3 n \right]$$", "$$Q=[3n]$$")[2] < 1.0  # braces stay
    assert blocks.page_scores(r"$$\displaystyle q = \left[ 3 n \right]$$", "$$Q=[3n]$$")[2] == 1.0
    assert blocks.page_scores(None, PAGE)[0] == 0.0


def test_formulas():
    assert [blocks.formula_body(x) for x in ("$$ a $$", r"\[b\]", r" \( c \) ", "$d$", "$$", "$$$", "e")] == ["a", "b", "c", "d", "", "$", "e"]
    assert blocks.plain_formula(r"$$\begin{aligned} \text{Rate} \tag{4} \end{aligned}$$") == "{rate}"
    assert blocks.inline_as_text(r"Let $\alpha_1 \leq \frac{a}{b}$ and $5 of it, \(x^2\).") == "Let α_1 ≤a/b and $5 of it, x^2."
    assert blocks.inline_as_text("costs $3 or $4") == "costs $3 or $4"
    assert blocks.text_score(r"angle $\theta$ and $\Lambda$", "angle θ and Λ") == 1.0 > blocks.text_score(r"angle $\theta$", "angle θθθ")


def test_html_tables():
    assert tables.html_of("x <TABLE><tr></tr></TABLE> y") == "<TABLE><tr></tr></TABLE>"
    assert tables.html_of('{"table": {"html": "<table><tr><td>1<\\/td></tr><\\/table>"}}') == "<table><tr><td>1</td></tr></table>"
    assert tables.html_of("a | b | c\n\n" + TABLE) == "" and tables.html_of("no table") == ""  # the first piped lines have no rule
    assert tables.html_of(TABLE + "\n\n| z | z |").count("<tr>") == 3
    wrapped = '<table class="t"><colgroup><col/></colgroup><thead><tr><th style="x" colspan="2"><p>A&amp;B</p></th></tr></thead><tr><td><math alttext="m"><mi>m</mi></math></td><td/></tr></table>'
    assert tables.normal_html(wrapped) == '<html><body><table border="1"><tr><td colspan="2">A&B</td></tr><tr><td>$m$</td><td></tr></table></body></html>'
    assert tables.normal_html("<table></table>") == tables.normal_html("<table><tr>") == tables.normal_html("") == ""
    assert tables.to_cells("<table><tr><th>a &lt; b</th></tr><tr><td>c</td><td><b>d</b></td></tr></table>") == {
        "cells": [{"row": 0, "col": 0, "text": "a &lt; b"}, {"row": 1, "col": 0, "text": "c"}, {"row": 1, "col": 1, "text": "d"}], "num_rows": 2, "num_cols": 2,
    }


def test_text_distance_against_dynamic_programming():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 15))) for _ in range(2))
        assert blocks.text_distance(a, b) == blocks.edit_distance(a, b)


def brute_tree_distance(a, b):
    from functools import lru_cache

    @lru_cache(None)
    def forest(x, y):
        if not x and not y:
            return 0
        if not x:
            return forest((), y[:-1] + y[-1][1]) + 1
        if not y:
            return forest(x[:-1] + x[-1][1], ()) + 1
        return min(
            forest(x[:-1] + x[-1][1], y) + 1, forest(x, y[:-1] + y[-1][1]) + 1,
            forest(x[:-1], y[:-1]) + forest(x[-1][1], y[-1][1]) + (x[-1][0] != y[-1][0]),
        )

    freeze = lambda n: (n[0], tuple(map(freeze, n[1])))
    return forest((freeze(a),), (freeze(b),))


def test_tree_distance_against_brute_force():
    rng = random.Random(4)

    def make(depth):
        return (rng.choice("abc"), [make(depth - 1) for _ in range(rng.randint(0, 3))] if depth else [])

    for _ in range(60):
        a, b = make(2), make(2)
        assert tables.tree_distance(a, b) == brute_tree_distance(a, b)


def test_spans_count_and_style_does_not():
    plain = '<table><tr><th rowspan="2">Tide</th><th>High</th></tr><tr><td>4.1</td></tr></table>'
    styled = plain.replace("<th>", '<th class="c" width="40">').replace("<td>", '<td align="left">')
    assert blocks.table_score(plain, styled) == 1.0
    assert blocks.table_score(plain, plain.replace(' rowspan="2"', "")) < 1.0
    assert tables.to_cells(plain)["num_rows"] == 2
    assert tables.span_grid([[("Tide", 1, 2), ("High", 1, 1)], [("4.1", 1, 1)]], 2) == [[0, 1], [0, 2]]
    with pytest.raises(ValueError):
        tables.span_grid([[("a", 3, 1)]], 2)


def test_layout_scores():
    a = [{"type": "text", "text": "abc", "bounding_box": (0, 0, 2, 2)}, {"type": "formula", "text": "x"}]
    same = layout.document_scores(a, a)
    assert same["overall_score"] == 1.0 and same["layout_f1"] == 1.0
    assert layout.document_scores([], a)["text_score"] == 0.0 and layout.document_scores([], [])["overall_score"] == 1.0
    rng = random.Random(6)
    for _ in range(20):
        x, y = ([rng.randint(0, 6) for _ in range(9)] for _ in range(2))
        steps = [((x[i] > x[j]) - (x[i] < x[j]), (y[i] > y[j]) - (y[i] < y[j])) for i in range(9) for j in range(i)]
        untied = [sum(s[k] != 0 for s in steps) for k in (0, 1)]
        assert layout.tau_b(x, y) == pytest.approx(sum(a * b for a, b in steps) / (untied[0] * untied[1]) ** 0.5)
        places = [[1 + sum(w < v for w in side) + (sum(w == v for w in side) - 1) / 2 for v in side] for side in (x, y)]
        assert [layout.ranks(x), layout.ranks(y)] == places
        assert layout.correlation(*places) == pytest.approx(float(np.corrcoef(places)[0, 1]))
    assert layout.entity_scores({"a": "x", "b": "y"}, {"a": "x"})["precision"] == 0.5
    assert layout.item_scores([{"name": "tea", "quantity": 1}], [{"name": "tea", "quantity": 2}])["item_accuracy"] == 0.5


def test_furniture():
    page = "## Harbour  Log\nThe harbour log is kept daily\n12\n7\n(7)\nPort office of the northern quay\n"
    parts = {"header": "HARBOUR LOG", "footer": "Port office of the northern guay", "page_number": 7}
    assert outputs.without_furniture(page, parts) == "The harbour log is kept daily\n12\n(7)\n"
    assert outputs.without_furniture("**7**\n17\n7 boats", {"page_number": "7"}) == "17\n7 boats"
    assert outputs.without_furniture("x", None) == outputs.without_furniture("x", {"header": None}) == "x"


def test_outputs():
    assert outputs.json_value('see ```json\n{"a": [1, 2,],}\n```') == {"a": [1, 2]}
    assert outputs.json_value("none here") is None
    assert outputs.without_scaffold("user\nq\nassistant\nthe answer") == "the answer"
    assert outputs.without_repeated_tail("y" * 10 + "ab " * 4000) == "y" * 10 + "ab "
    assert outputs.without_repeated_tail("ab " * 9) == "ab " * 9
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choices("ab", k=rng.randint(0, 20))) + "".join(rng.choices("ab", k=rng.randint(1, 4))) * rng.randint(1, 9)
        want = text
        for size in range(2, len(text) // 3 + 1):
            n = 1
            while text.endswith(text[-size:] * (n + 1)) and (n + 1) * size <= len(text):
                n += 1
            if n >= 3:
                want = text[: len(text) - (n - 1) * size]
                break
        assert outputs.without_repeated_tail(text, least=0, copies=3) == want
