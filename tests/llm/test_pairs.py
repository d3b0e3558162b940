import random

import numpy as np
import pytest

from folioscope.llm import pairs, truncation
from folioscope.llm.truncation import ending, fold

PAGE = "# Head of the page\n\nThe first sentence names the keeper of the ledger. The second sentence ends here.\n\n| a | b |\n|---|---|\n| one | two |\n\nThe last paragraph closes the whole page."


def test_endings():
    at = lambda mark: PAGE[: PAGE.index(mark)]
    assert ending(PAGE, PAGE) == ending(PAGE + "\n", PAGE) == "complete"
    assert ending(at("keeper"), PAGE) == ending(at("eper of"), PAGE) == ending(at("eper of") + "…", PAGE) == ending(at("eper of") + "�", PAGE) == "inside"
    assert ending(at(" The second"), PAGE) == ending(at("\n\n| a"), PAGE) == ending(at("\n\nThe last"), PAGE) == "natural"
    assert ending(at("ends").replace("names", "nanes").replace("sentence ", "sentencc ", 2), PAGE) == "inside"
    assert ending(None, PAGE) == ending("", PAGE) == ending("x", "") == ending(" ", PAGE) == "none"
    assert ending("It stops in the mid", None) == ending("It stops …", None) == "open" and ending("It stops.", None) == ending("| a | b |", None) == "closed"
    assert ending("Something else entirely that isn't on it", PAGE) == "elsewhere" and ending("Something else, with its stop.", PAGE) == "closed"
    assert ending("古い契約より、この様式の方が順", "古い契約より、この様式の方が順序を守る。次の文。") == "inside"
    assert ending("古い契約より、この様式の方が順序を守る。", "古い契約より、この様式の方が順序を守る。次の文もここに続いている。") == "natural"


def test_near_place_against_brute_force():
    from folioscope.kernels.blocks import edit_distance

    rng = random.Random(16)
    for _ in range(40):
        page = "".join(rng.choices("abcdef", k=120))
        cut = rng.randint(60, 100)
        tail = list(page[cut - truncation.TAIL : cut])
        tail[rng.randrange(len(tail))] = "z"
        text = page[: cut - truncation.TAIL] + "".join(tail)
        at = truncation._near_place(text, page)
        assert at is not None and min(edit_distance(text[-truncation.TAIL :], page[s:at]) for s in range(at)) <= 1


def test_censoring():
    rng = np.random.default_rng(17)
    sizes = np.exp(rng.normal(5.5, 0.5, 4000)).astype(int)
    cut = np.minimum(sizes, 300)
    at, share = truncation.censoring(*np.unique(cut, return_counts=True))
    assert 300 in at and share[list(at).index(300)] > 0.97
    assert len(truncation.censoring(*np.unique(sizes, return_counts=True))[0]) <= 2
    assert len(truncation.censoring(np.array([0, 0, 5]), np.array([9, 9, 1]))[0]) == 0


RULES = [
    (None, PAGE, "p", "empty"), ("", PAGE, "p", "empty"), ("\u200b \n", PAGE, "p", "empty"), ("N/A", PAGE, "p", "empty"), ("(empty)", PAGE, "p", "empty"), ("-", PAGE, "p", "empty"), ("", "", "p", None), (None, None, None, None),
    ("HTTP 503 Bad Gateway", PAGE, "p", "error_text"), ('{"error": {"code": 509, "message": "rate limit reached"}}', PAGE, "p", "error_text"), ("[backend] worker crashed with exit code 3", PAGE, None, "error_text"),
    ("I'm sorry, but I can't read this image.", PAGE, "p", "refusal"), ("죄송하지만 이 사진은 읽을 수 없습니다.", PAGE, "p", "refusal"), ("申し訳ありませんが、この画像の転記はお断りします。", PAGE, "p", "refusal"),
    ("Q: READ THE PAGE\nline by line", PAGE, "Read the page line by line.", "copied_prompt"), ("Read the page line by line.\n\n" + PAGE, PAGE, "Read the page line by line.", None),
    ("古い契約より、この様式の方が順序を守る。倉庫では最終の様式を確認した。", PAGE, "p", "wrong_language"), (PAGE, PAGE, "p", None), ("We are sorry, we cannot accept forms.", "We are sorry, we cannot accept forms.", "p", None),
]


@pytest.mark.parametrize("text,page,prompt,defect", RULES)
def test_rules(text, page, prompt, defect):
    assert pairs.rule(text, page, prompt, ending(text, page, fold)) == defect


KOREAN = "<h4>공식 화면 현황</h4>\n\n" + "<p>접수처의 판독본은 지사의 요청으로 반려하였다. 임시 현황판은 서식에 따라 회의실에 보관된다.</p>\n" * 3
CLOSED = "\n<table>\n<tr><td>97.8%</td></tr>\n</TABLE>"


def test_an_end_of_mere_markup_is_no_proof_of_the_page():
    page = PAGE + "\n" + CLOSED
    for text in (KOREAN + CLOSED, KOREAN * 8 + CLOSED, KOREAN + CLOSED.replace("97.8", "82.0")):
        assert ending(text, page, fold) == "complete" and pairs.rule(text, page, "p", "complete") == "wrong_language"
    assert pairs.rule(KOREAN, page, "p", "natural") == pairs.rule(KOREAN * 8, page, "p", "inside") == "wrong_language"
    # The page itself, misread or with a loop in another language, is answered in its language.
    mixed = "<p>수정 안내</p>\n\n" + PAGE + CLOSED
    assert pairs.rule(mixed.replace("sentence", "sentencc"), mixed, "p", "complete") is None
    for stops in ("complete", "natural", "inside", "unaligned"):
        assert pairs.rule(mixed + "\n" + "수정 안내\n" * 400, mixed, "p", stops) is None


def test_long_messages_and_prompts():
    trace = "Traceback (most recent call last):\n" + "".join(f'  File "/srv/ocr/step_{i}.py", line {i}, in call\n' for i in range(30)) + "RuntimeError: no worker"
    sorry = "I'm sorry, but I can't transcribe this image. " + " ".join(f"Reason {i}: the rules of this service forbid it." for i in range(20))
    prompt = " ".join(f"Read block {i} line by line." for i in range(40))
    spaced = "".join(c + "\n" for c in prompt[:300])
    assert min(map(len, (trace, sorry, prompt, spaced))) > 300 and len(trace) > 600 < len(sorry)
    for page in (PAGE, KOREAN):
        for text, want in ((trace, "error_text"), (sorry, "refusal"), (prompt, "copied_prompt")):
            assert pairs.rule(text, page, prompt, ending(text, page, fold)) == want
    assert pairs.rule(spaced, PAGE, prompt[:300], "unaligned") == "copied_prompt"
    # Pages that hold such words: in another language, and with a loop.
    other = "Legible voucher\n\n" + "The keeper reads the ledger. We are sorry, we cannot accept unsigned forms.\n" * 12
    assert pairs.rule(other, KOREAN, "p", "unaligned") == "wrong_language"
    assert pairs.rule(other + "sorry, cannot accept\n" * 90, other, "p", "unaligned") is None


def table_of(spark):
    rows = [(i, "m", *r[:3]) for i, r in enumerate(RULES)]
    rows += [(90, None, PAGE[: PAGE.index("eper of")], PAGE, "p")] * 2 + [(91, "m", PAGE[: PAGE.index(" The second")], PAGE, "p"), (92, "m", "x" * 100_000, PAGE, None)]
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], "result_id long, model_id string, prediction string, ground_truth string, prompt string, page string, rule int").repartition(3)


def test_operators(spark):
    df = table_of(spark)
    got = sorted((r.result_id, r.defect) for r in pairs.defects(df).where("defect is not null").collect())
    want = [(i, d) for i, (*_, d) in enumerate(RULES) if d] + [(90, "truncated")] * 2
    assert got == sorted(want)
    assert sorted(r.result_id for r in truncation.truncation(df).where("cut").collect()) == [90, 90]
    share = {r.model_id: (r.rows, r.cut_rows) for r in truncation.truncated_share(df).collect()}
    assert share == {None: (2, 2), "m": (len(RULES) + 2, 0)}
    short = pairs.shortened(df, "prediction", "ground_truth").collect()
    assert len(short) == 2 and all(r.more in PAGE for r in short)
    none = df.limit(0)
    assert pairs.defects(none).count() == truncation.truncation(none).count() == truncation.truncated_share(none).count() == 0


def test_limits_by_source(spark):
    rng = random.Random(18)
    rows = [("a", "".join(rng.choices("xyz", k=min(rng.randint(100, 900), 400)))) for _ in range(300)] + [("b", "é" * rng.randint(20, 500)) for _ in range(200)]
    rows += [("b", None)] + [("b", "a stock phrase that is sent again and again")] * 200
    df = spark.createDataFrame([(i, s, t, None) for i, (s, t) in enumerate(rows)], "result_id long, model_id string, prediction string, ground_truth string")
    got = {(r.source, r.unit, r.length) for r in truncation.limits(df, "model_id", "prediction").where("posterior > 0.9").collect()}
    assert got == {("a", "chars", 400), ("a", "bytes", 400)}


def test_cuts_at_piled_lengths_are_found_without_a_reference(spark):
    """The censoring posterior alone: nine tenths of the cut texts of a source with a limit, and none of one without."""
    rng = random.Random(19)
    sentences = ["The keeper signed the ledger of unit {}. ", "Sheet {} was stored below the stairs. ", "Ink of type {} had faded. "]
    rows, cut = [], set()
    for i in range(600):
        whole = "".join(rng.choice(sentences).format(rng.randint(10, 99999)) for _ in range(rng.randint(3, 20))).rstrip()
        text = whole[:350].rstrip() if i % 2 else whole
        if text != whole and text[-1] != ".":
            cut.add(i)
        rows.append((i, "limited" if i % 2 else "free", text, None, "p"))
    df = spark.createDataFrame(rows, "result_id long, model_id string, prediction string, ground_truth string, prompt string")
    for page in ("ground_truth", None):
        found = {r.result_id for r in truncation.truncation(df, page=page).where("cut").collect()}
        assert len(found & cut) >= 0.9 * len(cut) and not found - cut
    pairs_found = {r.result_id for r in pairs.defects(df).where("defect = 'truncated'").collect()}
    assert len(pairs_found & cut) >= 0.9 * len(cut)
    # Switched off, that is without a pile at the limit, nothing is found.
    assert truncation.truncation(df.where("model_id = 'free'"), page=None).where("cut").count() == 0


def test_a_small_posterior_is_no_evidence_against_a_cut(spark):
    rows = spark.createDataFrame([(1, "m", 300, 300, "inside"), (2, "m", 301, 301, "inside"), (3, "m", 300, 300, "unaligned")], "key long, source string, chars int, bytes int, stops string")
    at = spark.createDataFrame([("m", "chars", 300, 6, 0.001)], "source string, unit string, length int, rows long, posterior double")
    assert [r.log_odds for r in truncation.with_limits(rows, at).orderBy("key").collect()] == [5.0, 5.0, -1.5]


def test_a_shortened_answer_is_found_by_its_neighbour_alone(spark):
    """The page tells nothing of the place where the answers stop; one of them is the beginning of the other."""
    page = "The keeper of the ledger signed sheet 12 and the clerk stored it. All pages were stored below the stairs by the keeper of the ledger."
    long = "The keeper of the ledger signed sheet 12 and the clerk stored the ledger keeper qqxz wwvk of Jundel quarter and more of it"
    short = long[:93]
    assert ending(short, page, fold) == "unaligned" and pairs.rule(short, page, "p", "unaligned") is None
    schema = "result_id long, model_id string, prediction string, ground_truth string, prompt string"
    alone = spark.createDataFrame([(1, "a", short, page, "p")], schema)
    both = alone.union(spark.createDataFrame([(2, "b", long, page, "p")], schema))
    assert alone.count() == 1 and pairs.defects(alone).where("defect is not null").count() == 0
    assert [(r.result_id, r.defect) for r in pairs.defects(both).where("defect is not null").collect()] == [(1, "truncated")]


def test_short_and_long_prefixes_against_brute_force(spark):
    rng = random.Random(20)
    texts = sorted({"".join(rng.choices("ab ", k=rng.choice([1, 3, 9, 15, 16, 17, 18, 19, 30]))).rstrip() for _ in range(60)} | {"abababababababab" + "a" * k for k in range(5)})
    page = "abababababababababbbab"
    df = spark.createDataFrame([(t, page) for t in texts], "prediction string, ground_truth string").repartition(4)
    got = pairs.shortened(df, "prediction", "ground_truth").count()
    assert got == sum(any(o != t and o.startswith(t) for o in [*texts, page]) for t in {*texts, page} - {""})


def test_ends_that_only_look_cut():
    page = "The clerk kept the ledger.\n\n<p>Then the narrow folder arrived.</p>"
    assert ending("The clerk kept the ledger.\n\nThen the narrow folder arrived.”", page.replace("<p>", "\\begin{quote}").replace("</p>", "\\end{quote}")) == "complete"
    assert ending("The clerk kept the ledger.\n\nroot of k, at most 36", "The clerk kept the ledger.\n\n<i>root of k, at most 36</i><sup>2</sup>") == "complete"
    code = "The clerk kept the ledger of the whole court.\n\n```\npages = load('sh-2490')\nrow = '[[' + key + ']]'\nlimit = 722\n```"
    assert ending("The clerk kept the ledger of the whole court.\n\nload pages, limit 82", code) != "inside"
