import random

from folioscope.llm import leakage


def brute(docs, items, min_words=12, min_chars=40):
    out = set()
    for d, text in docs:
        for i, passage, lang in items:
            unspaced = (lang or "").strip().lower()[:2] in leakage.UNSPACED
            a, b = leakage.words(passage), leakage.words(text)
            if unspaced:
                a, b = "".join(a), "".join(b)
            n = min_chars if unspaced else min_words
            if any(a[k : k + n] == b[j : j + n] for k in range(len(a) - n + 1) for j in range(len(b) - n + 1)):
                out.add((d, i))
    return out


def test_against_brute_force(spark):
    rng = random.Random(10)
    words = [f"w{i}" for i in range(14)]
    syllables = "가나다라마바사아자차카타파하"
    items = [(i, " ".join(rng.choices(words, k=25)), "en") for i in range(8)] + [(20 + i, "".join(rng.choices(syllables, k=70)), " KO") for i in range(5)]
    docs = []
    for d in range(60):
        own = " ".join(rng.choices(words, k=20)) + "".join(rng.choices(syllables, k=20))
        _, p, lang = rng.choice(items)
        if lang == "en":
            w = p.split()
            k = rng.randint(9, 15)
            s = rng.randint(0, 25 - k)
            cut = ", ".join(w[s : s + k]).upper().replace("W3", "<b>W3</b>").replace("W5", r"\emph{W5}")
        else:
            k = rng.randint(36, 44)
            s = rng.randint(0, 70 - k)
            cut = p[s : s + k // 2] + " \n**" + p[s + k // 2 : s + k] + "**"
        docs.append((d, f"{own} {cut} {own}"))
    docs += [(100, items[0][1]), (100, items[0][1]), (101, items[8][1]), (102, None), (103, ""), (None, items[1][1])]
    items += [(50, None, "en"), (51, "", "ko"), (52, "too short", None), (53, items[0][1], None)]
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in docs], "doc_id long, text string, term string, uid int").repartition(4)
    it = spark.createDataFrame(items, "item_id long, passage string, lang_code string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaked(df, it).collect()}
    assert got == brute(docs, items) and len(got) > 10


def test_report_and_empty_tables(spark):
    passage = " ".join(f"term{i}" for i in range(30))
    docs = spark.createDataFrame([(1, " ".join(f"term{i}" for i in range(12))), (2, " ".join(f"term{i} extra" if i == 6 else f"term{i}" for i in range(13)))], "doc_id long, text string")
    items = spark.createDataFrame([(7, passage, "en")], "item_id long, passage string, lang_code string")
    rows = {r.doc_id: r for r in leakage.find_leaks(docs, items, min_words=6).collect()}
    assert rows[1].longest_run == 12 and rows[1].passage_terms == 30
    assert rows[2].longest_run == 7 and rows[2].near_matches == 13
    assert [r.doc_id for r in leakage.leaked(docs, items).collect()] == [1]
    assert leakage.leaked(docs.limit(0), items).count() == leakage.leaked(docs, items.limit(0)).count() == 0


def test_stored_postings_serve_a_second_item_set(spark):
    texts = [" ".join(f"t{k}x{i}" for i in range(15)) for k in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = leakage.build_index(docs)
    for own in ([0], [1, 2], []):
        items = spark.createDataFrame([(10 + k, texts[k], "en") for k in own], "item_id long, passage string, lang_code string")
        assert sorted(tuple(r) for r in leakage.leaked(docs, items, index=index).collect()) == [(k, 10 + k) for k in own]
    assert leakage.leaked(docs, items, index=index.limit(0)).count() == 0


def test_every_run_posts_a_term_and_equal_runs_post_equal_terms():
    rng = random.Random(23)
    for unit, least, pool in (("w", 12, ["a", "bb", "c"]), ("c", 40, list("abcd")), ("w", 5, ["x"])):
        own = [[rng.choice(pool) for _ in range(rng.randint(0, 120))] for _ in range(9)]
        doc, at, term = leakage.posted(own, unit, least)
        length = leakage.SHINGLE if unit == "w" else leakage.GRAM
        for d, words in enumerate(own):
            size = len(words) if unit == "w" else len("".join(words))
            places = at[doc == d].tolist()
            for s in range(size - least + 1):
                assert sum(s <= p <= s + least - length for p in places) >= (2 if len(pool) > 1 else 1)
            cut = words[3:]
            _, at2, term2 = leakage.posted([cut], unit, least)
            shift = 3 if unit == "w" else len("".join(words[:3]))
            mine = dict(zip(places, term[doc == d].tolist()))
            assert all(mine.get(p + shift) == t for p, t in zip(at2.tolist(), term2.tolist()))


def test_a_passage_in_a_third_of_the_documents(spark):
    passage = " ".join(f"word{i}" for i in range(40))
    docs = spark.range(3000).selectExpr("id AS doc_id", f"CASE WHEN id % 3 = 0 THEN concat('{passage}', ' ', id) ELSE concat('other text ', id) END AS text")
    items = spark.createDataFrame([(1, passage, "en"), (1, "x " * 20, "en")], "item_id long, passage string, lang_code string")
    assert leakage.leaked(docs, items).count() == 1000


def test_places_are_joined_by_a_shuffle(spark):
    passage = " ".join(f"word{i}" for i in range(300))
    docs = spark.range(2000).selectExpr("id AS doc_id", f"concat('{passage}', ' ', id) AS text")
    items = spark.createDataFrame([(1, passage, "en"), (1, passage, "fr"), (2, passage, "en")], "item_id long, passage string, lang_code string")
    found = leakage.find_leaks(docs, items)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    joins = [x.split() for x in plan.replace("+-", " ").replace(":", " ").splitlines() if "Join " in x and "LeftSemi" not in x]
    assert [x[0] for x in joins if x[1].startswith("[uid")] == ["SortMergeJoin"]
    assert found.groupBy("item_id", "longest_run").count().orderBy("item_id").collect() == [(1, 300, 2000), (2, 300, 2000)]
