"""One call for each job a user runs: evaluation, leaderboards, comparisons, correlations and distributions."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import text
from folioscope.kernels import blocks
from folioscope.operators import corpus, evaluation, ground_truth, profiling, scores, summary
from folioscope.sources import readers, reports


def read(spark: SparkSession, path: str) -> DataFrame:
    """A table by its suffix: json, jsonl, csv, tsv, else Parquet."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind in ("csv", "tsv"):
        return spark.read.option("header", True).option("inferSchema", True).option("sep", "\t" if kind == "tsv" else ",").csv(path)
    return spark.read.option("multiLine", kind == "json").json(path) if kind in ("json", "jsonl") else spark.read.parquet(path)


def evaluate(results: DataFrame, truths: DataFrame | None = None, key: str = "sample_index", furniture: str | None = None) -> tuple[DataFrame, dict, dict]:
    """(scores of every valid result, mean and deviation of each score, run summary).

    results: key, prediction, error, latency_ms[, ground_truth]; truths: key with the page, where results lack it.  Lines of
    the struct ``furniture`` are taken out of the predictions in every mode.
    """
    if truths is not None:
        page = ground_truth.truth_text(truths) if "ground_truth" not in truths.columns else truths["ground_truth"]
        columns = [c for c in results.columns if c != "ground_truth"]
        results = results.select(*columns).join(truths.select(key, page.alias("ground_truth")), key)
    if furniture:
        results = scores.without_furniture(results, "prediction", furniture)
    results = evaluation.after_retries(results)
    scored = scores.page_scores(evaluation.valid(results), key)
    stats = scored.agg(*(f(s).alias(f"{n}_markdown_{s}") for s in blocks.SCORES for n, f in (("avg", F.avg), ("std", F.stddev_pop)))).first().asDict()
    run = evaluation.run_summary(results.withColumn("_run", F.lit(1)), ["_run"]).drop("_run").first()
    return scored, stats, run.asDict() if run else {}


def evaluate_to(results: DataFrame, out: str, config: dict | None = None, **kw) -> dict:
    """``evaluate`` with its scores as Parquet, and report.json, report.md, report.html and protocol.json in the folder out."""
    scored, stats, run = evaluate(results, **kw)
    scored.write.mode("overwrite").parquet(f"{out}/scores.parquet")
    errors = evaluation.first_errors(results.withColumn("_run", F.lit(1)), ["_run"], kw.get("key", "sample_index")).select(kw.get("key", "sample_index"), "error")
    made = reports.run_report(config or {}, stats, run, [r.asDict() for r in errors.collect()])  # ten rows
    for kind, body in made.items():
        reports.save(Path(out) / f"report.{kind}", body)
    reports.save(Path(out) / "protocol.json", reports.protocol("evaluate", config or {}, run))
    return stats


def runs_of(spark: SparkSession, root: str) -> DataFrame:
    """The last run of each model and language below a folder of report.json files."""
    rows = readers.reports(spark, root)
    named = rows.select(
        F.col("config.model.model_id").alias("model_id"), F.col("config.model.backend").alias("backend"), F.col("config.dataset_id").alias("dataset_id"),
        F.col("config.language").alias("lang_code"), "metrics", "summary.*", "report_path", "run_at",
    )
    return evaluation.compare(evaluation.latest(named))


def leaderboard(runs: DataFrame, metric: str | None = None) -> tuple[DataFrame, str]:
    """(ranked runs, metric): by the metric given, or the one by which most runs are judged."""
    if metric is None:
        names = runs.select(evaluation.main_metric(F.col("metrics")).alias("m")).where("m is not null").groupBy("m").count().orderBy(F.desc("count"), "m").first()
        metric = names.m if names else evaluation.MAIN_METRICS[0]
    scored = runs.withColumn("score", F.col("metrics")[metric])
    return evaluation.ranked(scored, F.col("score"), metric), metric


def leaderboard_to(runs: DataFrame, out: str, metric: str | None = None) -> str:
    ranked, metric = leaderboard(runs, metric)
    payload, page = reports.leaderboard(ranked, metric, metric in evaluation.LOWER_IS_BETTER)
    reports.save(Path(out) / "leaderboard.json", payload)
    reports.save(Path(out) / "leaderboard.md", page)
    return page


def compare_to(runs: DataFrame, out: str) -> str:
    payload, page = reports.comparison(runs)
    reports.save(Path(out) / "comparison.json", payload)
    reports.save(Path(out) / "comparison.md", page)
    return page


def rank_correlation(synthetic: DataFrame, real: DataFrame, aliases: DataFrame | None = None, confidence: float = 0.95, draws: int = 2000) -> str:
    """The report on how well the scores (model, score) of one table order the models as those of the other do."""
    from folioscope.kernels.layout import correlation, ranks, tau_b

    matched = evaluation.match_models(synthetic, real, aliases)
    both = matched.where("synthetic_model is not null and real_model is not null")
    statistics = summary.rank_statistics(both, "synthetic_score", "real_score").first().asDict()
    interval = None
    if statistics["n"] > 2:
        row = evaluation.bootstrap_interval(both, "synthetic_score", "real_score", lambda a, b: correlation(ranks(a.tolist()), ranks(b.tolist())), draws, confidence).first()
        interval = (row.low, row.high) if row.low is not None else None
        statistics["spearman_p"] = summary.permutation_p(both, "synthetic_score", "real_score", lambda a, b: correlation(ranks(a), ranks(b)), draws)
        statistics["kendall_p"] = summary.permutation_p(both, "synthetic_score", "real_score", tau_b, draws)
    return reports.rank_correlation(statistics, interval, confidence, reports.every(matched, ["match_key"]))


def text_statistics(texts: DataFrame, column: str = "text", keys: list[str] = (), prose: bool = False) -> DataFrame:
    """Summary of the text statistics of a column, by keys; prose: of the pages without Markdown."""
    body = text.strip_markdown(F.col(column)) if prose else F.col(column)
    return summary.summarise(texts.where(F.col(column).isNotNull()).select(*keys, *text.text_stats(body)), list(text.STATS), list(keys))


def gap_report(reference: DataFrame, candidate: DataFrame, names: tuple[str, str] = ("reference", "candidate"), column: str = "text") -> str:
    """The gap of the text statistics of two tables."""
    return reports.gap(summary.gap(text_statistics(reference, column), text_statistics(candidate, column)), *names)


def discriminate(reference: DataFrame, candidate: DataFrame, names: tuple[str, str] = ("reference", "candidate"), column: str = "text") -> str:
    """How well a linear classifier tells the texts of two tables apart."""
    sides = [df.where(F.col(column).isNotNull()).select(F.lit(side).alias("side"), *text.text_stats(F.col(column))) for df, side in ((candidate, True), (reference, False))]
    both = sides[0].union(sides[1]).withColumn("row", F.monotonically_increasing_id())
    made = summary.Discriminator(both, "side", list(text.STATS))
    parts = (made.folds().orderBy("fold"), made.weights(), made.top_candidates("row"))
    return reports.discriminator(*([r.asDict() for r in p.collect()] for p in parts), *names)


def import_wikitext(lines: DataFrame, out: str, line: str = "value") -> None:
    """Titles and paragraphs of a wiki dump, each once, as Parquet by kind."""
    rows = lines.withColumn("_p", F.monotonically_increasing_id())
    corpus.wiki_parts(rows, line, "_p").write.mode("overwrite").partitionBy("kind").parquet(out)


def publish(samples: DataFrame, out: str, name: str, key: str, test_share: float = 0.1, dry_run: bool = False) -> str:
    """Samples in one form, parted into train and test, as Parquet with a card; dry_run returns the card alone."""
    rows = corpus.split_rows(ground_truth.upload_records(ground_truth.unified(samples)), key, test_share)
    sizes = {r.split: r["count"] for r in rows.groupBy("split").count().collect()}
    fields = [f.name for f in samples.schema if f.dataType.typeName() == "string" and f.name in ("document_family", "distribution_profile", "capture_channel", "visual_difficulty", "lang")]
    card = reports.dataset_card(name, sizes, reports.top(summary.value_shares(samples, fields), ["field", F.desc("count"), "value"]) if fields else [])
    if not dry_run:
        rows.write.mode("overwrite").partitionBy("split").parquet(f"{out}/data")
        reports.save(Path(out) / "README.md", card)
    return card


def profile(samples: DataFrame, out: str) -> str:
    """Presence, lengths and numbers of the fields of a table, as JSON."""
    body = json.dumps([r.asDict() for r in profiling.record_profile(samples).collect()], ensure_ascii=False, indent=1)  # a row or two for each column
    reports.save(Path(out) / "profile.json", body)
    return body
