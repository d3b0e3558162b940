import pytest

from folioscope.llm import markup

CASES = [
    ("plain text, 5 * 3 * 2 and x < 5, y > 3, raw_page_01, C:\\scans\\new, $5 to $7, R&D, see [1] and #42", []),
    ("run_all_pages(x, y) twice\n· item\n• item\n※ item", []),
    ("# Head", ["markdown"]), ("Head\n=====", ["markdown"]), ("a **b** c", ["markdown"]), ("_b_", ["markdown"]), ("~~b~~", ["markdown"]),
    ("[a](http://x)", ["markdown"]), ("![a](x.png)", ["markdown"]), ("> q", ["markdown"]), ("- a", ["markdown"]), ("* a", ["markdown"]), ("+ a", ["markdown"]), ("1. a", ["markdown"]),
    ("|a|b|\n|---|---|\n|1|2|", ["markdown"]), ("`x`", ["markdown"]),
    ("```\n<b>x</b> [[y]] \\frac{a}{b} **z**\n```", ["markdown"]), ("~~~python\n<b>\n", ["markdown"]),
    ("<p>x</p>", ["html"]), ("a &mdash; b", ["html"]), ("<!-- n -->x", ["html"]), ("<pre>**a**</pre>", ["html"]), ("a<br/>b", ["html"]),
    ("== H ==", ["wiki"]), ("'''b'''", ["wiki"]), ("[[A|b]]", ["wiki"]), ("{{quote|x}}", ["wiki"]), ("{| class=\"x\"\n|-\n| a || b\n|}", ["wiki"]),
    ("\\section{x}", ["latex"]), ("\\emph{x}", ["latex"]), ("{\\bf x}", ["latex"]), ("\\begin{itemize}\n\\item x\n\\end{itemize}", ["latex"]), ("$$ x^2 $$", ["latex"]), ("\\[ x \\]", ["latex"]),
    ("\\begin{verbatim}\n**a** <b>\n\\end{verbatim}", ["latex"]), ("# H\n\n$\\alpha$-x", ["latex", "markdown"]), ("{{code|<b>}}", ["wiki"]), ("", []), (None, []), (" \n", []),
]


@pytest.mark.parametrize("text,kinds", CASES)
def test_kinds(text, kinds):
    assert markup.analyse(text)[1] == kinds == markup.analyse(text, clean=False)[1]


def test_clean_text_keeps_structure():
    page = "<h2>Title</h2>\n\n<p class='x'>Some <b>bold</b> text &amp; more.</p>\n<ul>\n<li>one</li>\n<li>two</li>\n</ul>\n<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>\n<pre>\nx = '**'\ny\n</pre>"
    clean = markup.analyse(page)[0]
    for part in ("## Title", "Some bold text & more.", "- one", "- two", "A | B", "1 | 2", "```\nx = '**'\ny\n```"):
        assert part in clean
    assert "<" not in clean
    clean = markup.analyse("\\section*{T}\n\\textbf{a}\\cite{k}: 5\\% of \\emph{b}\n\n$$\nx \\leq 2\n$$\n\n\\begin{tabular}{ll}\na & b \\\\\n\\end{tabular}\n\\begin{enumerate}\n\\item c\n\\end{enumerate}")[0]
    assert clean.split("\n\n")[0].startswith("# T") and "a: 5% of b" in clean and "$x \\leq 2$" in clean and "a | b" in clean and "- c" in clean
    assert markup.analyse("=== H ===\n''a'' [[P|b]] {{term|c}}")[0] == "## H\na b c"


def test_lines_of_mere_markup_drop_out():
    page = "<div>\n<span>\n</span>\n\n\n<p>First words here.</p>\n<p>Second words.</p>\n\n\n\n</div>\n<hr>"
    assert markup.analyse(page)[0].split() == "First words here. Second words.".split()


def test_every_line_of_text_is_kept():
    assert markup.analyse("***\n\n\n7\n\n\n<div>\n\n\nx\n\n\n---|---\n")[0].split() == ["7", "x"]


def test_operator(spark):
    rows = [(1, "# a", "<p>a</p>"), (2, None, ""), (1, "# a", "<p>a</p>"), (3, "x " * 60_000 + "**b**", "plain")]
    df = spark.createDataFrame([(*r, "k", ["z"]) for r in rows], "result_id long, prediction string, ground_truth string, field_name string, kinds array<string>")
    got = sorted(tuple(r) for r in markup.found_kinds(df, "result_id", ["prediction", "ground_truth"]).collect())
    assert got == [(1, "ground_truth", "html")] * 2 + [(1, "prediction", "markdown")] * 2 + [(3, "prediction", "markdown")]
    assert markup.markup(df.limit(0), "result_id", ["prediction"]).count() == 0
    assert markup.markup(df, "result_id", ["prediction"]).where("result_id = 2").first().clean_text is None


FRAME = """[Home](/) | [About](/a) | [Contact](/c)

Home | About | Contact

# Report

The first paragraph of the report is here.
[one](/1) [two](/2)
It goes on below the links. © marks are named in this sentence, which is far too long for a notice of rights and has a subject of its own, and so it stays where it stands, as every other sentence of the report does.

1. first
2. second

- [kept](/k)

Signed: A. B.

Prev » Next » Top
© 2024 Example. All rights reserved.
"""


def test_navigation_and_footers_lie_outside_of_the_blocks(monkeypatch):
    clean, kinds = markup.analyse(FRAME)
    assert kinds == ["markdown"]
    for part in ("# Report", "first paragraph", "one two", "goes on below", "1. first", "2. second", "- kept", "Signed: A. B."):
        assert part in clean
    for part in ("Home", "Contact", "Prev", "2024"):
        assert part not in clean
    # Without the distribution of text over the lines the frame stays.
    monkeypatch.setattr(markup, "own_size", len)
    assert all(part in markup.analyse(FRAME)[0] for part in ("Home", "Contact", "Prev", "2024"))


def test_menu_like_lines_with_content_stay():
    for line in ("a | b | c 12", "| a | b | c |", "Total · 3 · 4", "- Home | About | Contact", "# Home | About | Contact"):
        assert markup.analyse(line)[0], line
