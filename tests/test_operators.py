import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.operators import corpus, evaluation, neighbours, scores, summary


def test_summary_against_numpy(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(size=501)
    df = spark.createDataFrame([(float(v), "path") for v in values] + [(None, "p")], "m double, path string")
    row = summary.summarise(df, ["m"]).first()
    assert row["count"] == 501
    for name, want in (("mean", values.mean()), ("std", values.std()), ("median", np.median(values)), ("p05", np.quantile(values, 0.05)), ("p95", np.quantile(values, 0.95))):
        assert row[name] == pytest.approx(want, rel=1e-9)
    assert row.quantiles == pytest.approx([round(float(v), 6) for v in np.quantile(values, np.linspace(0, 1, 101))], abs=1e-6)
    same = summary.gap(summary.summarise(df, ["m"]), summary.summarise(df, ["m"])).first()
    assert same.w1 == 0 and same.verdict == "close"
    assert summary.summarise(df.limit(0), ["m"]).count() == 0


def test_auc_and_ranks(spark):
    rows = [(1.0, True), (1.0, False), (2.0, True), (0.0, False), (3.0, True), (2.0, False)]
    df = spark.createDataFrame(rows, "s double, p boolean")
    wins = [(a > b) + (a == b) / 2 for a, x in rows if x for b, y in rows if not y]
    assert summary.auc(df, "s", "p").first().auc == pytest.approx(sum(wins) / len(wins))
    assert summary.auc(df.where("p"), "s", "p").first().auc == 0.5
    ranks = {r.s: r.k for r in df.select("s", summary.average_rank("s").alias("k")).collect()}
    assert ranks == {0.0: 1.0, 1.0: 2.5, 2.0: 4.5, 3.0: 6.0}


def test_rank_statistics(spark):
    df = spark.createDataFrame([(0.9, 88.0), (0.8, 75.0), (0.8, 79.0), (0.6, 65.0), (0.5, 50.0)], "x double, y double")
    row = summary.rank_statistics(df, "x", "y").first()
    assert row.spearman == pytest.approx(0.9746794344808963) and row.kendall_tau_b == pytest.approx(0.9486832980505138)
    none = summary.rank_statistics(df.limit(0), "x", "y").first()
    assert (none.n, none.spearman, none.kendall_tau_b) == (0, 0.0, 0.0)


def test_discriminator(spark):
    rng = np.random.default_rng(6)
    rows = [(bool(s), float(rng.normal(6 * s)), float(rng.normal())) for s in (0, 1) for _ in range(60)]
    df = spark.createDataFrame(rows, "side boolean, far double, noise double")
    quality, weights = summary.discriminate(df, "side", ["far", "noise"])
    assert all(r.auc > 0.9 for r in quality.collect())
    assert weights.first().feature == "far"


def test_evaluation(spark):
    df = spark.createDataFrame([(1, "a", None, 1.0), (2, " ", "", 2.0), (3, "b", "timeout", 3.0), (4, None, "None", None)], "i int, prediction string, error string, latency_ms double").withColumn("run", F.lit(1))
    assert [r.i for r in evaluation.valid(df).collect()] == [1]
    row = evaluation.run_summary(df, ["run"]).first()
    assert (row.total_samples, row.successful, row.failed, row.empty_count) == (4, 3, 1, 2) and row.avg_latency_ms == 2.0
    assert evaluation.remaining(df, df.where("i < 3"), ["i"]).count() == 2
    new = spark.createDataFrame([(1, "new"), (9, "x")], "i int, prediction string")
    merged = {r.i: r.prediction for r in evaluation.upsert(df.select("i", "prediction"), new, ["i"]).collect()}
    assert merged[1] == "new" and len(merged) == 5
    got = {r.i: (r.prediction, r.error) for r in evaluation.batch_results(df, df.where("i in (1, 2)"), df.where("i = 3"), "i").collect()}
    assert got == {1: ("a", None), 2: ("", evaluation.BLANK_RESPONSE), 3: ("", "timeout"), 4: ("", evaluation.NO_RESPONSE)}


def test_leaderboard(spark):
    rows = [("m/a", "ko", "d-ko", "r/1/report.json", 1, 0.3), ("m/a", "KO ", "d-ko", "r/2/report.json", 1, 0.9), ("m/b", None, "d-ja", "r/3/report.json", 1, 0.5), (None, "ko", "d-ko", "r/c/report.json", 2, None)]
    df = spark.createDataFrame(rows, "model_id string, lang_code string, dataset_id string, report_path string, run_at int, score double")
    last = evaluation.latest(df)
    got = {(r.language, r.model_id): (r["rank"], r.score) for r in evaluation.ranked(last, F.col("score"), "avg_x").collect()}
    assert got == {("ko", "m/a"): (1, 0.9), ("ko", "c"): (2, None), ("ja", "m/b"): (1, 0.5)}
    assert {r.language: r.best_model for r in evaluation.best(last, ["language"], F.col("score")).collect()} == {"ko": "m/a", "ja": "m/b"}


def test_rank_correlation(spark):
    a = spark.createDataFrame([("org/A-1", 3.0), ("B", 2.0), ("C", 1.0)], "model string, score double")
    b = spark.createDataFrame([("a1", 30.0), ("bee", 20.0), ("D", 5.0)], "model string, score double")
    alias = spark.createDataFrame([("bee", "B")], "alias string, canonical string")
    got = {r.match_key: (r.synthetic_model, r.real_model) for r in evaluation.match_models(a, b, alias).collect()}
    assert got == {"a1": ("org/A-1", "a1"), "b": ("B", "bee"), "c": ("C", None), "d": (None, "D")}
    with pytest.raises(Exception, match="share the key"):
        evaluation.match_models(a.union(spark.createDataFrame([("b!", 1.0)], a.schema)), b).collect()
    pairs = spark.createDataFrame([(float(i), i * 2.0) for i in range(8)], "x double, y double")
    row = evaluation.bootstrap_interval(pairs, "x", "y", lambda x, y: np.corrcoef(x, y)[0, 1], draws=50).first()
    assert row.low == pytest.approx(1) and row.high == pytest.approx(1)


def test_corpus(spark):
    lines = ["= 봉은사 =", " ", "분류: x", "= 분류:절 =", "== 역사 ==", "봉은사는 서울에 있는 절로 아주 오래된 절이다.", "봉은사는 서울에 있는 절로 아주 오래된 절이다.", "{| style=x 가나다라마바사아자차카타파하"]
    df = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    got = {(r.kind, r.item): r.first for r in corpus.wiki_parts(df, "line", "n", least=20).collect()}
    assert got == {("title", "봉은사"): 0, ("title", "역사"): 4, ("paragraph", "봉은사는 서울에 있는 절로 아주 오래된 절이다."): 5}
    items = spark.createDataFrame([(1, "1. a\n2) b\n\nc d", True), (2, "- a\n\n* b", False)], "id int, r string, p boolean")
    assert [(r.id, r.item) for r in corpus.response_items(items, "r", ["id"], F.col("p")).orderBy("id", "position").collect()] == [(1, "a b"), (1, "c d"), (2, "a"), (2, "b")]
    texts = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, None)], "id int, t string")
    assert [(r.t, r.first.id) for r in corpus.first_seen(texts, "t", ["id"]).orderBy("first").collect()] == [("x", 1), ("y", 2)]
    assert {(r.id, r.side) for r in corpus.symmetric_difference(texts.where("id < 3"), texts.where("id > 1"), "id").collect()} == {(1, "left"), (3, "right"), (4, "right")}
    parts = corpus.split_rows(spark.range(2000), "id", 0.25)
    assert 400 < parts.where("split = 'test'").count() < 600
    runs = corpus.runs(spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, "a")], "u int, n int, v string"), ["u"], ["n"], "v")
    assert sorted((r.v, r.start, r.rows) for r in runs.collect()) == [("a", 1, 2), ("a", 4, 1), ("b", 3, 1)]


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(7)
    m = rng.normal(size=(60, 8)).astype("float32")
    m[7] = m[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(None, m[0].tolist()), (99, None)], "vec_id long, embedding array<float>").repartition(5)
    got = neighbours.nearest(df, df.where("vec_id % 10 = 3"), 4, block=4).orderBy("query_id", "rank").collect()
    unit = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    for q in range(3, 60, 10):
        score = unit @ unit[q]
        want = sorted((i for i in range(60) if i != q), key=lambda i: (-round(score[i], 12), i))[:4]
        assert [r.neighbour_id for r in got if r.query_id == q] == want
    assert neighbours.nearest(df, df.limit(0)).count() == 0


def test_score_operators(spark):
    df = spark.createDataFrame([(1, "a\n\n$x$", "a\n\n$x$", None, "m"), (2, None, "b", None, "m"), (3, "c", "c", "err", "m")], "result_id int, prediction string, ground_truth string, error string, model_id string")
    got = scores.model_scores(df, ["model_id"], "result_id").first()
    assert (got.scored, got.avg_overall_score, got.std_overall_score) == (1, 1.0, 0.0)
    kinds = [(r.result_id, r.block_type) for r in scores.page_blocks(df, "result_id", "prediction").orderBy("result_id", "position").collect()]
    assert kinds == [(1, "text"), (1, "formula"), (3, "text")]
    rates = {r.result_id: r for r in scores.error_rates(df, "result_id").collect()}
    assert (rates[1].cer, rates[2].cer, rates[2].wer, rates[3].exact, rates[2].ned) == (0.0, 1.0, 1.0, 1.0, 1.0)
    maps = spark.createDataFrame([(1, {"a": "x", "b": "q"}, {"a": "x", "c": "z"}), (2, {}, {}), (3, None, {"a": "x"})], "k int, p map<string,string>, t map<string,string>")
    got = {r.k: (r.precision, r.recall, r.f1, r.avg_ned) for r in scores.entity_scores(maps, "k", "p", "t").collect()}
    assert got == {1: (0.5, 0.5, 0.5, 0.5), 2: (1.0, 1.0, 1.0, 0.0), 3: (0.0, 0.0, 0.0, 1.0)}
    pages = spark.createDataFrame([(1, "Head\nbody", {"header": "Head", "footer": "", "page_number": ""}), (2, "Head", None)], "k int, t string, f struct<header:string,footer:string,page_number:string>")
    assert [r.t for r in scores.without_furniture(pages, "t", "f").orderBy("k").collect()] == ["body", "Head"]
