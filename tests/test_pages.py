import math

import numpy as np
from pyspark.sql import functions as F

from folioscope.functions import text
from folioscope.kernels import pages
from folioscope.operators.measure import measure


def page(columns=1, lines=20, tilt=0.0, rule=False):
    a = np.full((1200, 900, 3), 255, np.uint8)
    for k in range(lines):
        for c in range(columns):
            wide = 700 // columns - (40 if columns > 1 else 0)
            x0 = 100 + c * (700 // columns + 20)
            for x in range(x0, x0 + wide):
                y = 100 + k * 50 - round((x - 450) * math.tan(math.radians(tilt)))
                a[y : y + 12, x] = 0
    if rule:
        a[1150:1153, 100:800] = 0
    return a


def test_layout():
    s = pages.layout_stats(page())
    assert (s["text_line_count"], s["column_count"], s["rule_count"]) == (20, 1, 0)
    assert abs(s["margin_left_frac"] - 100 / 900) < 0.01 and abs(s["margin_top_frac"] - 100 / 1200) < 0.01
    assert pages.layout_stats(page(columns=2))["column_count"] == 2
    assert pages.layout_stats(page(rule=True))["rule_count"] == 1
    blank = pages.layout_stats(np.full((50, 40, 3), 255, np.uint8))
    assert (blank["text_line_count"], blank["margin_top_frac"], blank["text_area_frac"]) == (0, 1, 0)


def test_image():
    s = pages.image_stats(page())
    assert (s["is_grayscale"], s["is_binary"], s["is_colored_background"]) == (1, 1, 0) and s["contrast"] == 255
    assert pages.image_stats(page(tilt=2.0))["skew_deg"] == 2.0 and abs(s["skew_deg"]) <= 0.1
    rng = np.random.default_rng(1)
    noisy = np.clip(128 + rng.normal(0, 8, (400, 400, 1)).repeat(3, 2), 0, 255).astype(np.uint8)
    assert abs(pages.noise(pages.luma(noisy)) - 8) < 0.5
    assert pages.reduced(page().repeat(2, 0).repeat(2, 1)).shape[1] == 1000
    red = page().copy()
    red[..., 2] //= 2
    assert pages.image_stats(red)["is_colored_background"] == 1 and pages.image_stats(red)["colorfulness"] > 20


def test_similarity():
    a = math.radians(3)
    m = np.array([[1.5 * math.cos(a), -1.5 * math.sin(a), 7], [1.5 * math.sin(a), 1.5 * math.cos(a), 9], [0, 0, 1]])
    got = pages.similarity_of(m, (600, 800))
    assert abs(abs(got["skew_deg"]) - 3) < 1e-6 and abs(got["scale"] - 1.5) < 1e-6 and got["perspective"] < 1e-9


def test_measure(spark):
    a = page(lines=5)
    df = spark.createDataFrame([("x", a.tobytes(), 900, 1200), ("bad", b"123", 900, 1200), ("none", None, 1, 1)], "path string, content binary, width int, height int")
    rows = measure(df).collect()
    assert [r.path for r in rows] == ["x"] and rows[0].text_line_count == 5
    assert measure(df.limit(0)).count() == 0


def test_pages_measured_together(spark):
    rng = np.random.default_rng(2)
    plain, inked, tall = np.full((18, 12, 3), 90, np.uint8), rng.integers(0, 256, (18, 12, 3)).astype(np.uint8), rng.integers(0, 256, (30, 5, 3)).astype(np.uint8)
    black = np.zeros((18, 12, 3), np.uint8)
    together = pages.page_columns(np.stack([plain, inked, black, plain]), np.array([[18, 12]] * 4))
    for i, a in enumerate((plain, inked, black, plain)):
        assert {k: v[i] for k, v in together.items()} == pages.image_stats(a) | pages.layout_stats(a)
    given = [("a", plain), ("b", tall), ("c", None), ("d", inked), ("e", page().repeat(2, 1)), ("f", page()), ("g", tall), ("h", plain)]
    df = spark.createDataFrame([(k, a.tobytes() if a is not None else b"1", a.shape[1] if a is not None else 1, a.shape[0] if a is not None else 1) for k, a in given], "path string, content binary, width int, height int").coalesce(1)
    rows = [r.asDict() for r in measure(df).collect()]
    assert rows == [{"path": k} | pages.image_stats(a) | pages.layout_stats(a) for k, a in given if a is not None]
    keyed = df.where("path in ('a', 'b')").selectExpr("ascii(path) AS width", "content", "width AS w", "height AS h")
    assert [(r.width_key, r.width) for r in measure(keyed, "width", columns=("content", "w", "h")).collect()] == [(97, 12.0), (98, 5.0)]


def test_pixels_of_one_file_on_all_cores(spark, tmp_path):
    from folioscope.plans.further import page_pixels

    spark.range(400).selectExpr("id AS p_partkey", "1 + id % 50 AS p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    out = page_pixels(spark, str(tmp_path))
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
    assert sorted((r.p_partkey, r.background_luma, r.ink_ratio) for r in out.collect()) == [(k, (1 + k % 50) * 5.0, 0.0) for k in range(400)]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_more_text(spark):
    lit = F.lit
    assert one(spark, text.fragment(lit("One, two three four."), 3, 8)) == "One, two"
    assert one(spark, text.shorten(lit("alpha beta gamma"), 11)) == "alpha beta"
    assert one(spark, text.math_aliases(lit(r"a \ge b \le c \leq d \left"))) == r"a \geq b \leq c \leq d \left"
    assert one(spark, text.without_grounding(lit("<|ref|>Title<|/ref|><|det|>[[1,2]]<|/det|>\n\n\n\nx"))) == "Title\n\nx"
    assert one(spark, text.repository_url(lit("git@host.org:me/repo.git"))) == "https://host.org/me/repo"
    assert one(spark, text.local_date(F.to_date(lit("2025-03-09")), "ko")) == "2025년 3월 9일"
    assert one(spark, text.wiki_prose(lit("== H ==\n[[A|link]] '''b''' http://x.y 漢"), "en")) == "H link b"
