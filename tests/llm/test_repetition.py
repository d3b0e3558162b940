import random
import time

import pytest

from folioscope.llm import repetition

RNG = random.Random(13)
VOCABULARY = ["".join(RNG.choices("abcdefghijklmnopqrstuvwxyz", k=RNG.randint(3, 9))) for _ in range(400)]


def sentence(rng, n=11):
    return " ".join(rng.choices(VOCABULARY, k=n)).capitalize() + "."


def test_shares():
    rng = random.Random(14)
    a, b, c = (sentence(rng) for _ in range(3))
    share = repetition.repeated_share
    assert share(None) == share("") == share(" \n") == share("...") == 0.0
    assert share(f"{a} {b} {c}") == pytest.approx(0, abs=0.05)
    assert share(f"{a} {a}") == pytest.approx(0.5)
    assert share("\n".join(f"{i}) {a.upper() if i % 2 else a.rstrip('.')}" for i in range(9))) > 0.85
    assert share(f"{a} " + "the same words, " * 60) > 0.8
    assert share("新しい様式" * 40) > 0.9 and share("신청 " * 50) > 0.9
    assert share(f"<p>{a}</p>\n<p><b>{b}</b></p>\n<p>{c}</p>") < 0.05
    assert share(f"{a} {b} {c} {a}") == pytest.approx(len(a) / len(a + a + b + c), abs=0.05)
    assert share(f"**label**: {a}\n{a}\n{a}") == pytest.approx(2 * len(a) / (3 * len(a) + 5), abs=0.05)
    stock = [f"The {x} was copied at the {y} by hand." for x, y in zip(VOCABULARY[:20], VOCABULARY[20:40])]
    assert share(" ".join(stock)) < 0.5


def test_loops_of_any_length():
    rng = random.Random(19)
    share = repetition.repeated_share
    for words in (14, 25, 60, 300):
        phrase = " ".join(rng.choices(VOCABULARY, k=words))
        assert len(phrase.replace(" ", "")) > repetition.PERIOD and share(phrase) < 0.05
        assert share(" ".join([phrase] * 6)) == pytest.approx(5 / 6, abs=0.03)
        assert share(" ".join(f"{i} {phrase}" for i in range(6))) > 0.78
    phrase = "".join(rng.choices([chr(0xAC00 + i) for i in range(3000)], k=130))
    assert share(phrase) < 0.05 and share(phrase * 3) == pytest.approx(2 / 3, abs=0.02)


def test_no_repetitive_document_escapes_the_threshold(spark):
    rng = random.Random(15)
    rows = []
    for i in range(120):
        parts = [sentence(rng) for _ in range(rng.randint(2, 8))]
        if i % 3 == 0:
            parts += [rng.choice(parts)] * rng.randint(1, 12)
        rows.append((i, " ".join(parts), " ".join(parts[:8]), "k", 1.0))
    rows += [(200, None, None, "", None), (201, "", "", "", None), (202, "ab ab", "", "", None), (203, "na " * 20_000, "x", "", None), (0, rows[0][1], rows[0][2], "k", 1.0)]
    df = spark.createDataFrame(rows, "result_id long, prediction string, ground_truth string, key string, share double").repartition(4)
    out = {r.result_id: r for r in repetition.repetition(df).collect()}
    every = {r.result_id: r.share for r in repetition.repetition(df, all_shares=True).collect()}
    for i, share in every.items():
        assert share == pytest.approx(repetition.repeated_share(next(r[1] for r in rows if r[0] == i)))
        assert share < 0.5 or out[i].verdict != "sound", (i, share, out[i].score)
        assert share >= 0.5 or out[i].verdict != "repetitive", (i, share, out[i].score)
    found = sorted(r.result_id for r in repetition.repetitive(df).collect())
    assert found == sorted([i for i, s in every.items() if s >= 0.5] + [0] * (every[0] >= 0.5)) and 203 in found
    assert out[203].verdict == "repetitive" and sum(r.verdict == "sound" for r in out.values()) > 40
    assert repetition.repetitive(df.limit(0)).count() == 0


def test_running_numbers_pass_the_threshold(spark):
    rng = random.Random(20)
    rows = [(i, " ".join(sentence(rng) for _ in range(6))) for i in range(40)]
    running = ["\n".join(f"{unit} {i}" for i in range(40)) for unit in ("line", "no", "Zeile nr", "줄")] + ["Opening balance of the year\n" + "1234\n" * 60, "77 " * 40]
    rows += [(100 + i, text) for i, text in enumerate(running)]
    df = spark.createDataFrame([(i, t, t if i < 100 else "x") for i, t in rows], "result_id long, prediction string, ground_truth string").repartition(2)
    assert all(repetition.repeated_share(t) >= 0.5 for t in running)
    assert sorted(r.result_id for r in repetition.repetitive(df).collect()) == [100 + i for i in range(len(running))]
    assert repetition.repetition(df).where("verdict = 'borderline'").count() < 20


def test_the_ratio_decides(spark):
    """Loops are found by the score alone, and without the trusted counts, that is with raw ones in their place, they are not."""
    rng = random.Random(21)
    rows = [(i, " ".join(sentence(rng) for _ in range(6))) for i in range(60)]
    loops = [" ".join([sentence(rng)] * rng.randint(5, 30)) for _ in range(12)]
    df = spark.createDataFrame([(i, t, t) for i, t in rows] + [(100 + i, t, sentence(rng)) for i, t in enumerate(loops)], "result_id long, prediction string, ground_truth string").repartition(3)
    out = repetition.repetition(df)
    assert sorted(r.result_id for r in out.where("verdict = 'repetitive'").collect()) == [100 + i for i in range(12)]
    assert out.where("verdict = 'repetitive' and share is not null").count() == 0
    w, sure, _ = repetition.fit(df, "prediction", "ground_truth")
    none, *_ = repetition.fit(df, "prediction", "prediction")
    assert (repetition.scores(loops, w) <= sure).all() and (repetition.scores(loops, none) > sure).all()


def test_long_documents_take_linear_time():
    rng = random.Random(22)
    lines = [sentence(rng) + f" no {i}" for i in range(8000)]
    lines += [x[:10] + "q" + x[11:] for x in lines[:4000]]
    start = time.process_time()
    share = repetition.repeated_share("\n".join(lines))
    assert share == pytest.approx(1 / 3, abs=0.07) and time.process_time() - start < 20


def test_runs_against_counting():
    from collections import Counter

    texts = ["abc def ghi abc def ghi", "", "short", "Ａ" + "xyz" * 20]
    doc, _, counts = repetition._runs(texts)
    for i, t in enumerate(texts):
        s = repetition.signs(t)
        want = Counter(s[k : k + repetition.GRAM] for k in range(len(s) - repetition.GRAM + 1))
        assert sorted(counts[doc == i].tolist()) == sorted(want.values())
