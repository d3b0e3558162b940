import random
import re

import pytest

from folioscope.kernels import blocks, tables
from folioscope.kernels import writing as w
from folioscope.operators.tables_generation import mutate


def test_lists():
    rng = random.Random(1)
    assert w.items_of("- a\n* b", "bullet_list") == ["a", "b"] and w.items_of("1. a\nb", "numbered_list") == w.items_of("", "bullet_list") == []
    assert w.official_list("1. a\n2. b", "numbered_list", rng, note="n") == "① a\n② b\n※ n"
    assert w.official_list("1. a\n2. b", "numbered_list", rng, "syllable") == "가) a\n나) b"
    assert w.official_list("- a\n- b", "bullet_list", rng)[0] in w.BULLETS and w.official_list("prose", "bullet_list", rng) == "prose"
    assert w.numbered_mark(99, "circled") == "99\\)" and w.numbered_mark(2, "plain") == "2\\)"
    lines = w.law_article("1. a\n2. b\n3. c", 7, rng).split("\n")
    assert re.fullmatch(r"제7조\(.+\) a", lines[0]) and lines[1:] == ["① b", "② c"]
    assert w.flag(None, rng) is w.flag("x", rng) is w.flag({"p": 0}, rng) is False and w.flag(True, rng) and w.flag({"p": 1.0}, rng)


def test_formulas():
    rng = random.Random(2)
    made = [w.formula(rng) for _ in range(300)]
    assert len(set(made)) > 200 and not any("<" in f for f in made)
    for f in made:
        plain = re.sub(r"\\[A-Za-z]+|\\.", "", f)
        assert plain.count("{") == plain.count("}") and f.count(r"\left(") == f.count(r"\right)")
        assert blocks.split(f"$${f}$$") == [("formula", f)]
    assert w.merged_scripts("x^2^3_i_j + y^a") == "x^{23}_{ij} + y^a" and w.merged_scripts(r"a_{n}_\alpha") == r"a_{n\alpha}"


def test_values():
    rng = random.Random(3)
    turns = w.in_turn(["a", "b", "c"], rng)
    rounds = [[next(turns) for _ in range(3)] for _ in range(4)]
    assert all(sorted(r) == ["a", "b", "c"] for r in rounds) and next(w.in_turn([], rng)) == ""
    assert re.fullmatch(r"010-\d{4}-\d{4}", w.value("phone", "ko", rng)) and re.fullmatch(r"\(\d{3}\) \d{3}-\d{4}", w.value("phone", "fr", rng))
    assert re.fullmatch(r"20(19|2[0-5])-(0[1-9]|1[0-2])-(0[1-9]|1\d|2[0-8])", w.value("date", "en", rng)) and re.fullmatch(r"(0[89]|1[0-8]):\d0", w.value("time", "en", rng))
    assert w.value("sentence", "ja", rng, ["港"]).endswith("。") and w.value("paragraph", "en", rng, ["quay"]).count(".") >= 2
    with pytest.raises(ValueError):
        w.value("unknown", "en", rng)
    assert all(sum(w.half_years(n, rng)) == n for n in range(0, 5000, 7))


def test_mutation_keeps_marks():
    page = "# Head\n\nSome prose here.\n\n```\ncode here\n\nmore code\n```\n\n- [x] item one\n- item two\n\n| a | b |\n|---|---|\n| cc | dd |\n\n$$x$$\n\n![alt](p.png)\n\n> quote"
    assert len(w.page_chunks(page)) == 8
    shout, n = w.mutate_page(page, 1.0, lambda t, s: (t.upper(), 1))
    assert shout == "# HEAD\n\nSOME PROSE HERE.\n\n```\ncode here\n\nmore code\n```\n\n- [x] ITEM ONE\n- ITEM TWO\n\n| A | B |\n|---|---|\n| CC | DD |\n\n$$x$$\n\n![alt](p.png)\n\n> QUOTE" and n == 9
    rng = random.Random(4)
    alike = lambda ch: [("ø", 0.9)] if ch == "o" else []
    out, n = w.mutate_page(page, 1.0, lambda t, s: mutate(t, s, alike, rng))
    assert n == out.count("ø") > 3 and "code here" in out


def test_grouped_heads():
    rows = w.grouped_head(["region", "y1_h1", "y1_h2", "z"], [("2024", ("y1_h1", "y1_h2")), ("none", ("q",))])
    assert rows == [[("region", 1, 2), ("2024", 2, 1), ("z", 1, 2)], [("y1_h1", 1, 1), ("y1_h2", 1, 1)]]
    assert tables.span_grid(rows, 4) == [[0, 1, 1, 2], [0, 3, 4, 2]]
    assert w.grouped_head(["a", "b"], [("g", ("a", "c"))]) == [[("a", 1, 1), ("b", 1, 1)]]
