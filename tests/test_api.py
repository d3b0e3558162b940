import json

import pytest
from pyspark.sql import functions as F

from folioscope import __main__ as cli
from folioscope import api
from folioscope.functions import text
from folioscope.operators import evaluation, ground_truth, profiling, scores, summary
from folioscope.sources import reports

PAGE = "# Ledger\n\nThe quay was swept.\n\n| a | b |\n|---|---|\n| 1 | 2 |\n"


@pytest.fixture
def run(tmp_path, spark):
    rows = [{"sample_index": i, "prediction": PAGE if i else None, "error": "timed out" if i == 1 else None, "latency_ms": 10.0 * i} for i in range(4)]
    (tmp_path / "results.jsonl").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "truths.jsonl").write_text("\n".join(json.dumps({"sample_index": i, "markdown": PAGE}) for i in range(5)))
    return tmp_path


def test_evaluate(run, spark):
    assert cli.main(["evaluate", f"{run}/results.jsonl", "--truths", f"{run}/truths.jsonl", "--model", "lab/m", "--out", f"{run}/out"]) == 0
    report = json.loads((run / "out/report.json").read_text())
    assert report["metrics"]["avg_markdown_overall_score"] == 1.0
    assert (report["summary"]["total_samples"], report["summary"]["failed"], report["summary"]["empty_count"]) == (4, 2, 1)
    assert [e["sample_index"] for e in report["errors"]] == [1]
    assert "timed out" in (run / "out/report.md").read_text() and "<h2>Metrics</h2>" in (run / "out/report.html").read_text()
    assert json.loads((run / "out/protocol.json").read_text())["command"] == "evaluate"
    assert spark.read.parquet(f"{run}/out/scores.parquet").count() == 2


def test_checkpoint_of_another_run_is_refused(run, spark):
    rows = spark.read.json(f"{run}/results.jsonl").join(spark.read.json(f"{run}/truths.jsonl").withColumnRenamed("markdown", "ground_truth"), "sample_index")
    own = {"dataset_id": "d's", "split": "test", "model_id": "m", "backend": "b"}
    rows.withColumns({k: F.lit(v) for k, v in own.items()}).write.parquet(f"{run}/cp")
    assert evaluation.checkpoint(spark, f"{run}/cp", own).count() == 4
    with pytest.raises(ValueError, match="another run"):
        evaluation.checkpoint(spark, f"{run}/cp", own | {"model_id": "other"})
    assert cli.main(["evaluate-checkpoint", f"{run}/cp", "--dataset", "d's", "--split", "test", "--model", "m", "--backend", "b", "--out", f"{run}/o"]) == 0


def test_leaderboard_compare_and_correlation(tmp_path, spark, capsys):
    for m, score in (("lab/a", 0.9), ("lab/b", 0.7), ("lab/c", 0.8)):
        folder = tmp_path / "reports" / m / "en"
        folder.mkdir(parents=True)
        config = {"dataset_id": "d-en", "split": "test", "language": "en", "format": "markdown", "model": {"model_id": m, "backend": "x"}}
        (folder / "report.json").write_text(json.dumps({"config": config, "metrics": {"avg_markdown_overall_score": score, "avg_cer": 1 - score}, "summary": {"total_samples": 4, "successful": 3, "failed": 1, "avg_latency_ms": 5.0}}))
    for command in ("leaderboard", "compare"):
        assert cli.main([command, f"{tmp_path}/reports", "--out", f"{tmp_path}/{command}"]) == 0
    board = json.loads((tmp_path / "leaderboard/leaderboard.json").read_text())
    assert [r["model_id"] for r in board[0]["rows"]] == ["lab/a", "lab/c", "lab/b"] and board[0]["count"] == 3
    by_error = api.leaderboard(api.runs_of(spark, f"{tmp_path}/reports"), "avg_cer")[0]
    assert [r.model_id for r in by_error.orderBy("rank").collect()] == ["lab/a", "lab/c", "lab/b"]
    assert len(json.loads((tmp_path / "compare/comparison.json").read_text())) == 3
    assert cli.main(["summary", f"{tmp_path}/reports"]) == 0 and "avg_markdown_overall_score" in capsys.readouterr().out
    (tmp_path / "real.csv").write_text("model,score\nA,3\nB,1\nC,2\nZ,9\n")
    (tmp_path / "syn.json").write_text(json.dumps({"lab/a": 0.9, "lab/b": 0.7, "lab/c": 0.8}))
    assert cli.main(["rank-correlation", f"{tmp_path}/syn.json", f"{tmp_path}/real.csv", "--draws", "50", "--out", f"{tmp_path}/rc"]) == 0
    page = (tmp_path / "rc/rank_correlation.md").read_text()
    assert "Models matched: 3" in page and "Spearman: 1.0000" in page and "Unmatched: Z" in page


def test_a_leaderboard_is_never_cut(spark):
    ranked = spark.range(1500).select(F.lit("en").alias("language"), (F.col("id") + 1).alias("rank"), F.format_string("m%05d", "id").alias("model_id"), F.lit(0.5).alias("score"))
    payload, page = reports.leaderboard(ranked, "score")
    assert json.loads(payload)[0]["count"] == 1500 and page.count("m0") == 1500


def test_distributions(tmp_path, spark):
    docs = [{"text": f"Page {i}. " + "Words of the harbour. " * (i % 7 + 1), "lang": "en"} for i in range(60)]
    other = [{"text": "항구의 일지 " * (i % 5 + 1), "lang": "ko"} for i in range(60)]
    for name, rows in (("a", docs), ("b", other)):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(map(json.dumps, rows)))
    a, b = f"{tmp_path}/a.jsonl", f"{tmp_path}/b.jsonl"
    assert cli.main(["text-stats", a, "--by", "lang", "--out", f"{tmp_path}/stats"]) == 0
    assert spark.read.json(f"{tmp_path}/stats").count() == len(text.STATS)
    assert cli.main(["gap", a, b, "--out", str(tmp_path)]) == cli.main(["discriminate", a, b, "--out", str(tmp_path)]) == cli.main(["profile", a, "--out", str(tmp_path)]) == 0
    assert "different" in (tmp_path / "gap.md").read_text() and "Mean AUC" in (tmp_path / "discriminate.md").read_text()
    card = api.publish(spark.read.json(a).withColumn("id", F.monotonically_increasing_id()), f"{tmp_path}/pub", "pages", "id", 0.3)
    assert "size_categories" in card and spark.read.parquet(f"{tmp_path}/pub/data").count() == 60
    (tmp_path / "words.txt").write_text("quay\nledger\n")
    assert cli.main(["generate", "--size", "6", "--shard-size", "3", "--words", f"{tmp_path}/words.txt", "--out", f"{tmp_path}/gen"]) == 0
    assert spark.read.parquet(f"{tmp_path}/gen").count() == 6
    (tmp_path / "wiki.txt").write_text("= Harbour =\n" + "The harbour of the town was built in stages over two hundred years. " * 2 + "\n")
    assert cli.main(["import-wikitext", f"{tmp_path}/wiki.txt", "--out", f"{tmp_path}/wiki"]) == 0
    assert {r.kind for r in spark.read.parquet(f"{tmp_path}/wiki").collect()} == {"title", "paragraph"}
    assert cli.main(["list-operators"]) == 0


def test_ground_truth(spark):
    rows = [("page", None, None, None, None), (None, "typo", None, None, None), (None, None, " <t/> ", '{"a": 1}', None), (None, None, "", "[1]", None), (None, None, None, "x", None), (None, None, None, None, '{"k": "v"}'), (None,) * 5]
    out = ground_truth.unified(spark.createDataFrame(rows, "GT_markdown string, typo_text string, html string, json string, ground_truth string").withColumn("format", F.lit("f"))).collect()
    assert [r.GT_markdown for r in out] == ["page", "typo", "<t/>", '```json\n{\n  "value": [\n    1\n  ]\n}\n```', '```json\n{\n  "raw": "x"\n}\n```', '```json\n{\n  "k": "v"\n}\n```', ""]
    assert [json.loads(r.GT_json) for r in out] == [{"markdown": "page"}, {"text": "typo", "original_text": ""}, {"a": 1}, {"value": [1]}, {"raw": "x"}, {"k": "v"}, {}]
    assert set(out[0].asDict()) == {"typo_text", "html", "GT_markdown", "GT_json"}
    none = spark.createDataFrame([(None, None, None, None)], "a string, b map<string,int>, c double, d array<int>")
    assert tuple(ground_truth.upload_records(none).first()) == ("", "{}", 0.0, "[]")
    assert profiling.record_profile(none.limit(0)).where("count > 0").count() == 0


def test_table_and_category_scores(spark):
    html = "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td></td></tr></table>"
    rows = [(1, html, html), (2, html.replace(">c<", ">cx<"), html), (3, None, html), (4, "", "no table"), (5, "| a | b |\n|---|---|\n| c | d |", html)]
    got = {r.k: r for r in scores.table_scores(spark.createDataFrame(rows, "k int, p string, t string"), "k", "p", "t").collect()}
    assert (got[1].teds, got[1].cell_accuracy, got[1].total_cells, got[1].structure_f1) == (1, 1, 3, 1)
    assert got[2].perfect_cells == 2 and got[2].avg_cer == pytest.approx(1 / 3)
    assert (got[3].teds, got[3].row_recall, got[4].teds, got[4].structure_f1) == (0, 0, 1, 0)
    assert got[5].structure_f1 == 1 and got[5].total_cells == 4
    maps = spark.createDataFrame([(1, {"date": "x", "total": "9"}, {"date": "x", "total": "1", "name": "n"})], "k int, p map<string,string>, t map<string,string>")
    cats = {r.category: (r.f1, r.field_count) for r in scores.category_scores(maps, "k", "p", "t").collect()}
    assert cats == {"header": (1.0, 1), "total": (0.0, 1), "customer": (0.0, 1), "personal": (0.0, 1)}


def test_ranks_and_quantiles_against_windows(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("g"), (F.hash("id") % 40).cast("double").alias("v"))
    want = sorted(rows.select("g", "v", summary.average_rank("v", ["g"], True).alias("r")).collect())
    assert sorted(summary.with_average_rank(rows, "v", "r", ["g"], True).select("g", "v", "r").collect()) == want
    exact = {r.g: r.q for r in rows.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.0), F.lit(0.05), F.lit(0.5), F.lit(1.0))).alias("q")).collect()}
    for r in summary.quantiles(rows, ["g"], "v", [0.0, 0.05, 0.5, 1.0]).collect():
        assert r.q == pytest.approx(exact[r.g])


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_text_forms(spark):
    lit = F.lit
    kinds = {"```\na\n```": "code", "$$x$$": "formula", "|a|b|\n|---|---|": "table", "![a](b.png)": "image", "---": "rule", "- [x] a\n- [ ] b": "checklist", "- a\n- b": "bullet_list", "1. a\n2. b": "numbered_list", "> q": "quote", "Plain words.": "paragraph", "Words\n- a": None, "```\nopen": None, " ": None}
    for chunk, kind in kinds.items():
        assert one(spark, text.chunk_kind(lit(chunk))) == kind, chunk
    assert tuple(one(spark, text.image_line(lit(" ![a](b.png) ")))) == ("a", "b.png") and one(spark, text.image_line(lit("x ![a](b)"))) is None
    assert one(spark, text.tagged_output(lit("<char> a </char>x<char>b</char>"))) == "a b"
    assert one(spark, text.tagged_output(lit("assistant\n<p>the page</p>"))) == one(spark, text.tagged_output(lit("q Assistant: the page"))) == "the page"
    assert one(spark, text.content_lines(lit("Evaluating: 1\nold\n=====================\nNO PATCHES\nthe text\n-----\nmore"))) == "the text\nmore"
    assert one(spark, text.tidy_formula(lit("$$ a \\le  b $$"))) == "a \\leq b"
    assert one(spark, text.header_candidates(lit("Old quay rules. New ledger today. old QUAY again."), 5)) == ["Old quay", "New ledger"]
    assert [one(spark, text.ratio(lit(v), 0.5)) for v in ("0.2", "7", "-1", "x", None)] == [0.2, 1, 0, 0.5, 0.5]
    assert one(spark, evaluation.normal_metric(lit("avg_cer"), lit(0.3))) == pytest.approx(0.7)
