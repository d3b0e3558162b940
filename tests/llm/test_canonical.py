import random
import unicodedata

from folioscope.llm import canonical

NORMAL = canonical.Normaliser(["minutes", "café", "fine", "가방", "2024-08-25"])


def test_same_look():
    same = [("ｔｅｍｐｌａｔｅ　８４", "template 84"), ("mіnutеs", "minutes"), ("cafe\u0301", "café"), ("가\u200b방", unicodedata.normalize("NFD", "가방")), ("a\u00a0b\u2009c", "a b c"), ("2024‐08‑25", "2024-08-25"), ("ﬁne", "fine"), ("ﾊﾞｽ", "バス"), ("⼝", "口"), ("x\u00ad", "x"), ("a\r\nb", "a\nb")]
    for a, b in same:
        assert NORMAL.text(a) == NORMAL.text(b), (a, b)
    seen = [("②", "2"), ("x²", "x2"), ("A", "a"), ("a  b", "a b"), ("a\n\nb", "a\nb"), ("**a**", "a"), ("O", "0"), ("“a”", '"a"')]
    for a, b in seen:
        assert NORMAL.text(a) != NORMAL.text(b), (a, b)
    assert NORMAL.text(None) is None and NORMAL.text("") == ""


def test_kanji_and_katakana_drawn_alike():
    bare = canonical.Normaliser()
    same = [("入力欄", "入カ欄"), ("窓口へ", "窓ロヘ"), ("工程表", "エ程表"), ("カタログ", "力夕口グ"), ("二次資料", "ニ次資料"), ("⼝座", "ロ座"), ("ﾛｸﾞ", "口グ"), ("八月分", "ハ月分")]
    for a, b in same:
        assert bare.text(a) == bare.text(b) == a.replace("⼝", "口").replace("ﾛｸﾞ", "ログ"), (a, b)
    assert bare.text("土") != bare.text("士") and bare.text("ー") != bare.text("一") and bare.text("ミ") != bare.text("三")
    spelt = canonical.Normaliser(["ニエ"])
    assert spelt.text("二工") == spelt.text("ニエ") == "ニエ" and bare.text("ニエ") == "二工"


def test_words_spelt_as_they_are_seen_dont_change_the_form():
    rng = random.Random(11)
    bare = canonical.Normaliser()
    pool = list("abcо еаﬁｆ１é\u0301\u200b\u00a0가ﾊﾞ-‐\n②")
    for _ in range(300):
        text = "".join(rng.choices(pool, k=rng.randint(0, 25)))
        form = bare.text(text)
        assert NORMAL.text(text) == form and bare.text(form) == form


def test_the_trie_decides_the_spelling():
    """Without the vocabulary a Cyrillic or full-width word would be torn into the letters of the table."""
    words = ["Москва", "оса", "ＡＢＣ", "oca"]
    normal, bare = canonical.Normaliser(words), canonical.Normaliser()
    for word, others in (("Москва", ["Mосква", "Mocква", "М\u200bосква"]), ("оса", ["oca", "oса"]), ("ＡＢＣ", ["ABC", "АВС", "AB\u00adC"])):
        assert {normal.text(x) for x in [word, *others]} == {word}
        assert bare.text(word) != word
    assert normal.text("oca ABC Mосква xyz") == "оса ＡＢＣ Москва xyz"
    rng = random.Random(13)
    pool = ["Москва", "Mocква", "оса", "oca", "oco", "ABC", "ＡＢＤ", "x\u200b", "x", "\u200b"]
    for _ in range(300):  # equal forms if and only if the texts look the same
        a, b = (" ".join(rng.choices(pool, k=3)) for _ in range(2))
        assert (normal.text(a) == normal.text(b)) == (bare.text(a) == bare.text(b))


def weighted(a, b):
    """Least cost between a token and a word: look-alikes and ignorables cost nothing."""
    a = [c for c in unicodedata.normalize("NFD", NORMAL.by_table(a))]
    b = list(unicodedata.normalize("NFD", b))
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_against_brute_force():
    rng = random.Random(12)
    words = sorted({"".join(rng.choices("abo", k=rng.randint(1, 5))) for _ in range(25)})
    for budget in (0, 1, 2):
        normal = canonical.Normaliser(words, budget)
        for _ in range(120):
            token = "".join(rng.choices("aаbоｂo\u200b", k=rng.randint(1, 6)))
            costs = [(weighted(token, w), w) for w in words]
            best = min(costs)
            assert normal.match(token) == (best[1] if best[0] <= budget else None), (token, budget)


def test_operators(spark):
    rows = [(1, "mіnutеs", "minutes"), (2, "same", "same"), (3, None, "x"), (4, "x", None), (5, "", ""), (6, "②", "2"), (1, "mіnutеs", "minutes"), (7, "ａ" * 50_000, "a" * 50_000), (None, "ｂ", "b"), (8, None, ""), (9, " \u200b", ""), (10, None, None), (11, "  ", "x")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "result_id long, prediction string, ground_truth string, key string").repartition(3)
    found = canonical.same_look(df, "result_id", "prediction", "ground_truth")
    assert sorted(r.result_id or 0 for r in found.collect()) == [0, 1, 1, 7]
    out = canonical.canonical(df, "result_id", ["prediction", "ground_truth"])
    assert {r.prediction for r in out.where("result_id = 1").collect()} == {"minutes"} and out.count() == len(rows)
    spelt = spark.createDataFrame([(i, "oca", "оса") for i in range(3)], "result_id long, prediction string, ground_truth string")
    assert {(r.prediction, r.ground_truth) for r in canonical.canonical(spelt, "result_id", ["prediction", "ground_truth"]).collect()} == {("оса", "оса")}
    assert canonical.same_look(df.limit(0), "result_id", "prediction", "ground_truth").count() == 0
