import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from folioscope.functions import distance, text
from folioscope.kernels.blocks import cer, edit_distance


def stats_of(spark, value):
    return spark.createDataFrame([(value,)], "t string").select(*text.text_stats(F.col("t"))).first().asDict()


def test_text_stats_by_hand(spark):
    s = stats_of(spark, "가나다 abc 123.!")
    n = 13
    assert s["chars_per_page"] == n
    assert [round(s[k] * n) for k in ("hangul_share", "latin_share", "digit_share", "punctuation_share", "whitespace_share")] == [3, 3, 3, 2, 2]
    s = stats_of(spark, "abcde\nab\n\nabcdefgh")
    assert (s["line_count"], s["mean_line_length"]) == (3, 5.0)
    assert set(stats_of(spark, "").values()) == {0.0}
    assert set(stats_of(spark, None).values()) == {None}


def brute_class(ch):
    code = ord(ch)
    if ch.isspace():
        return "whitespace"
    blocks = {"hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7A3), (0xD7B0, 0xD7FF)], "hanja": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)], "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)], "latin": [(65, 90), (97, 122), (0xC0, 0x24F), (0x1E00, 0x1EFF)]}
    for name, spans in blocks.items():
        if any(a <= code <= b for a, b in spans):
            return name
    kind = unicodedata.category(ch)
    if kind == "Nd":
        return "digit"
    if ch in text.AS_SYMBOL:
        return "symbol"
    return "punctuation" if kind[0] == "P" else "symbol" if kind[0] == "S" or kind == "No" else None


def test_character_classes_against_unicode_data(spark):
    rng = random.Random(1)
    pool = [chr(c) for c in (*range(32, 0x250), *range(0x2000, 0x2070), *range(0x2460, 0x2480), *range(0x3000, 0x3130), *range(0xAC00, 0xAC20), *range(0x4E00, 0x4E20))]
    rows = ["".join(rng.choices(pool, k=60)) for _ in range(40)] + ["가漢あカ□○※①·・"]
    out = spark.createDataFrame([(r,) for r in rows], "t string").select("t", *text.text_stats(F.col("t"))).collect()
    for row in out:
        kinds = [brute_class(c) for c in row.t]
        for name in text.CLASSES:
            assert round(row[f"{name}_share"] * len(row.t)) == kinds.count(name), (name, row.t)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_small_text_functions(spark):
    lit = F.lit
    assert one(spark, text.model_key(lit("lightonai/LightOnOCR-2-1B"))) == "lightonocr21b"
    assert one(spark, text.model_key(lit("  GPT-5 Mini  "))) == "gpt5mini"
    assert one(spark, text.model_key(lit(None).cast("string"))) == ""
    assert one(spark, text.wiki_clean(lit("스폴리아텔레(, )는 과자이다."))) == "스폴리아텔레는 과자이다."
    assert one(spark, text.language_of(lit(" "), lit("org/pages-ko"))) == "ko"
    assert one(spark, text.language_of(lit(None).cast("string"), lit(None).cast("string"))) == "unknown"
    assert one(spark, text.clip(lit("one two three four"), 10)) == "one two..."
    assert one(spark, text.neutral(lit("> - 1. word"))) == "word"
    assert one(spark, text.strip_markdown(lit("# A *b* **c** [d](e) ![f](g) `h`"))) == "A b c d   h"
    assert one(spark, text.formula_body(lit("$$ x $$"))) == "x"
    assert one(spark, text.page_label(lit(3), lit(9), "of_total")) == "3 / 9"
    assert one(spark, text.html_cells(lit("<table><tr><th>A</th></tr><tr><td><b>1</b></td><td>2</td></tr></table>"))) == [["A"], ["1", "2"]]
    assert one(spark, text.item_text(lit(" 12. **x"))) == "**x"
    assert one(spark, text.is_empty(lit("　\n"))) is True


def test_error_rates(spark):
    cases = [("kitten", "sitting", 0.5), ("", "a", 1.0), ("", "", 0.0), ("a", "bcd", 3.0), (None, None, 0.0), ("가나다", "가나라", 1 / 3)]
    df = spark.createDataFrame([c[:2] for c in cases], "r string, h string")
    for row, case in zip(df.select(distance.cer(F.col("r"), F.col("h")).alias("v")).collect(), cases, strict=True):
        assert row.v == pytest.approx(case[2]) and cer(*case[:2]) == pytest.approx(case[2])
    assert one(spark, distance.wer(F.lit("the cat sat down"), F.lit("the dog sat"))) == 0.5
    assert one(spark, distance.word_accuracy(F.lit("a b"), F.lit("b c"))) == 0.5
    assert one(spark, distance.exact(F.lit(" a\n"), F.lit("a"))) == 1.0
    assert one(spark, distance.ned(F.lit("x"), F.lit(""))) == 1.0
    assert one(spark, distance.iou(F.array(*map(F.lit, (0, 0, 2, 2))), F.array(*map(F.lit, (1, 1, 3, 3))))) == pytest.approx(1 / 7)


def test_word_error_rate_against_brute_force(spark):
    rng = random.Random(2)
    words = ["a", "bb", "c", "dé", "한글"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 9))), "  ".join(rng.choices(words, k=rng.randint(0, 9)))) for _ in range(60)]
    got = spark.createDataFrame(rows, "r string, h string").select(distance.wer(F.col("r"), F.col("h")).alias("v")).collect()
    for (r, h), row in zip(rows, got, strict=True):
        want = edit_distance(r.split(), h.split()) / len(r.split()) if r.split() else float(bool(h.split()))
        assert row.v == pytest.approx(want)
