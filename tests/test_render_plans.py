import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.kernels import pages
from folioscope.kernels.layout import correlation
from folioscope.operators import corpus, summary
from folioscope.operators import render_plans as plans
from folioscope.operators.tables_generation import with_typos


def seeds(spark, n=600):
    return spark.range(n).select(F.col("id").alias("i"), (F.col("id") * 7919 + 3).alias("sample_seed"), F.when(F.col("id") % 2 == 0, "academic").alias("family"))


def test_styles_stay_in_their_bounds(spark):
    for name, changes in plans.STYLES.items():
        rows = [r.s for r in seeds(spark).select(plans.style(F.col("sample_seed"), name).alias("s")).collect()]
        for field, (low, high, least, most) in changes.items():
            values = [r[field] for r in rows]
            assert len(set(values)) > 3
            assert min(values) >= (plans.BASE[field] + low if least is None else least) and max(values) <= (plans.BASE[field] + high if most is None else most)
        assert all(r.h1_font_size >= r.body_font_size + 6 for r in rows)
        assert all(r.code_font_size == plans.BASE["code_font_size"] for r in rows) == (name != "diverse")


def test_page_plans_by_family(spark):
    page = {"columns": {"default": 1, "by_family": {"academic": {"choices": [1, 2], "weights": [1, 3]}}}, "width_mm": [200, 210], "margins_mm": {"top": 20, "left": {"normal": [15, 2], "clip": [10, 20]}}}
    rows = plans.page_plans(seeds(spark), page, {"body_pt": {"uniform": [9, 12], "round": 1}}, family="family").collect()
    assert {r.page["columns"] for r in rows if r.family is None} == {1}
    two = sum(r.page["columns"] == 2 for r in rows if r.family)
    assert 0.65 < two / 300 < 0.85
    assert all(200 <= r.page.width_mm <= 210 and r.page.margins_mm.top == 20 and 10 <= r.page.margins_mm.left <= 20 and 9 <= r.typography.body_pt <= 12 for r in rows)


def test_fonts(spark):
    paths = ["/f/NotoSans.ttf", "/f/NotoSerif.ttf", "/f/Mono.ttf", "/f/Italic-Noto.ttf"]
    assert plans.kept_fonts(paths, ["italic"]) == paths[:3] and plans.kept_fonts(paths, ["."]) == paths
    drawn = Counter(r.f for r in seeds(spark).select(plans.font(F.col("sample_seed"), paths, {"noto": 3, "mono": 1, "none": 5}, ["italic"]).alias("f")).collect())
    assert set(drawn) == set(paths[:3]) and 0.15 < drawn["/f/Mono.ttf"] / 600 < 0.35
    assert seeds(spark).select(plans.font(F.col("sample_seed"), paths, {"none": 1}).alias("f")).where("f is not null").count() == 0


def test_templates(spark):
    catalog = spark.createDataFrame([("a", "forms", 1.0), ("b", "forms", 3.0), ("c", "letters", 1.0)], "template_id string, family string, weight double")
    rows = Counter((r.family, r.template_id) for r in plans.templates(seeds(spark).drop("family"), catalog, {"forms": 1, "letters": 3, "absent": 9}).collect())
    assert 0.65 < rows["letters", "c"] / 600 < 0.85 and rows["forms", "b"] > 1.5 * rows["forms", "a"]
    assert len(Counter(r.template_id for r in plans.templates(seeds(spark).drop("family"), catalog).collect())) == 3
    rng, choice = random.Random(1), plans.TemplateChoice([("a", "forms", 1.0), ("b", "letters", 1.0)], {"forms": 0.8})
    drawn = Counter(choice.draw(rng) for _ in range(300))
    assert drawn["a"] > drawn["b"] > 0 and choice.weight("a", "forms", 0.0) == 0.01
    plain = plans.TemplateChoice([("a", "f", 1.0), ("b", "f", 1.0)])
    plain.seen["a"] = 4
    assert plain.weight("b", "f", 1.0) / plain.weight("a", "f", 1.0) == pytest.approx(1 + 4 * 0.45)
    assert plans.coverage_targets("forms=0.3, letters:2,bad") == plans.coverage_targets([("forms", 0.3), "letters=2"]) == {"forms": 0.3, "letters": 1.0}
    assert plans.coverage_targets({"a": "-1", "b": None}) == {"a": 0.0}


def test_rotation_and_runs(spark):
    items = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "place long, item string")
    rows = {r.i: r.item for r in plans.rotated(spark.range(21).withColumnRenamed("id", "i"), items, "item", "i").collect()}
    assert [rows[i] for i in range(7)] == [f"t{i}" for i in range(7)]
    assert all(len({rows[7 * k + i] for i in range(7)}) == 7 for k in range(3))
    assert plans.rotated(spark.range(2).withColumnRenamed("id", "i"), items.limit(0), "item", "i").where("item is null").count() == 2
    runs = seeds(spark).select(plans.contiguous(F.array(*map(F.lit, range(6))), 3, F.col("sample_seed")).alias("r")).collect()
    assert {tuple(r.r) for r in runs} == {tuple(range(k, k + 3)) for k in range(4)}


def test_discriminator(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i < 40, float(rng.normal(2.0 * (i < 40))), float(rng.normal()), "x") for i in range(400)]
    df = spark.createDataFrame(rows, "k long, side boolean, a double, b double, path string")
    made = summary.Discriminator(df, "side", ["a", "b"])
    folds = made.folds().collect()
    assert len(folds) == 5 and np.mean([f.auc for f in folds]) > 0.8 and all(0 <= f.accuracy <= 1 for f in folds)
    assert made.sample.groupby(["fold", "side"]).size().tolist() == [8] * 10
    scored = made.scored().collect()
    assert len(scored) == 400 and sum(r.source == "held_out_fold" for r in scored) == 80 and all(0 < r.probability < 1 for r in scored)
    top = made.top_candidates("k", 5).collect()
    assert len(top) == 5 and all(r.k < 40 for r in top) and [r.probability for r in top] == sorted((r.probability for r in top), reverse=True)
    assert made.weights().first().feature == "a"
    assert summary.shared_features(df.withColumn("width", F.lit(1)), df.drop("b")) == ["a", "k", "side"]
    assert summary.Discriminator(df.where("side"), "side", ["a"]).folds().count() == 0


def test_permutations_typos_and_glyphs(spark):
    pairs = spark.createDataFrame([(float(i), float(i) + (i % 2)) for i in range(9)], "x double, y double")
    assert summary.permutation_p(pairs, "x", "y", correlation, 400) < 0.02
    assert summary.permutation_p(pairs.limit(2), "x", "y", correlation) is None
    rng = random.Random(2)
    text = "the quay was swept at 77 a"
    out = with_typos(text, {"a": ["á"], "e": ["é"], "7": ["1"]}, rng, 0.5)
    assert sum(x != y for x, y in zip(text.split(), out.split())) == 3 and out.endswith("77 a")
    assert with_typos("", {"a": ["b"]}, rng) == "" and with_typos("zz", {"a": ["b"]}, rng) == "zz"
    v = pages.glyph_vector(np.arange(256, dtype=np.uint8).reshape(16, 16))
    assert v.shape == (64,) and np.linalg.norm(v) == pytest.approx(1) and not pages.glyph_vector(np.zeros((8, 8))).any()
    chars = {r.char: r["count"] for r in corpus.valid_characters(spark.createDataFrame([("a b​ 가a",), (None,)], "t string"), "t").collect()}
    assert chars == {"a": 2, "b": 1, "가": 1}
