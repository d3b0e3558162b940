"""Queries of the text problems over the tables of one directory, and their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import bpe, canonical, chunking, leakage, markup, pairs, quota_sample, repetition, truncation
from folioscope.sources.tables import table


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    return canonical.same_look(table(spark, directory, "report"), "result_id", "prediction", "ground_truth")


def p1_normalised(spark: SparkSession, directory: str) -> DataFrame:
    return canonical.canonical(table(spark, directory, "report"), "result_id", ["prediction", "ground_truth"])


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    return markup.found_kinds(table(spark, directory, "report"), "result_id", ["prediction", "ground_truth"])


def p2_clean(spark: SparkSession, directory: str) -> DataFrame:
    out = markup.markup(table(spark, directory, "report"), "result_id", ["prediction", "ground_truth"])
    return out.withColumn("kinds", F.array_join("kinds", "|"))


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    return repetition.repetitive(table(spark, directory, "report"))


def p3_shares(spark: SparkSession, directory: str) -> DataFrame:
    """The share of repeated content of every prediction, with its score."""
    out = repetition.repetition(table(spark, directory, "report"), all_shares=True)
    return out.withColumn("share", F.round("share", 6))


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    report = quota_sample.quota_report(table(spark, directory, "render_plan"), table(spark, directory, "sample_target"))
    return report.where("not met").select("request_id", "target_no")


def p5_report(spark: SparkSession, directory: str) -> DataFrame:
    return quota_sample.quota_report(table(spark, directory, "render_plan"), table(spark, directory, "sample_target"))


def p5_sample(spark: SparkSession, directory: str) -> DataFrame:
    return quota_sample.draw(table(spark, directory, "render_plan"), table(spark, directory, "sample_target"))


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    return pairs.defects(table(spark, directory, "report")).where("defect is not null").select("result_id", "defect")


def p6_by_model(spark: SparkSession, directory: str) -> DataFrame:
    """Defective rows of each model by defect."""
    return pairs.defects(table(spark, directory, "report")).where("defect is not null").groupBy("model_id", "defect").agg(F.count("*").alias("rows"))


def p7_found(spark: SparkSession, directory: str) -> DataFrame:
    return truncation.truncation(table(spark, directory, "report")).where("cut").select("result_id")


def p7_share(spark: SparkSession, directory: str) -> DataFrame:
    return truncation.truncated_share(table(spark, directory, "report"))


def p7_limits(spark: SparkSession, directory: str) -> DataFrame:
    """Candidate length limits of each model with their censoring posterior."""
    found = truncation.limits(table(spark, directory, "report"), "model_id", "prediction")
    return found.select(F.col("source").alias("model_id"), "unit", "length", "rows", F.round("posterior", 6).alias("posterior"))


def p8_ids(spark: SparkSession, directory: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, directory, "documents"))


def p8_round_trip(spark: SparkSession, directory: str) -> DataFrame:
    """Texts decoded from their ids: equal to the stored ones, '' for null."""
    return bpe.decode_corpus(p8_ids(spark, directory))


def p9_found(spark: SparkSession, directory: str) -> DataFrame:
    return leakage.leaked(table(spark, directory, "documents"), table(spark, directory, "eval_item"))


def p9_items(spark: SparkSession, directory: str) -> DataFrame:
    """Each test item with the number of documents it leaked into; 0 where none."""
    found = p9_found(spark, directory).groupBy("item_id").agg(F.count("*").alias("documents"))
    items = table(spark, directory, "eval_item").select("item_id", "lang_code")
    return items.join(found, "item_id", "left").fillna(0, ["documents"])


def p10_found(spark: SparkSession, directory: str) -> DataFrame:
    return chunking.oversized(table(spark, directory, "documents"))


def p10_pieces(spark: SparkSession, directory: str) -> DataFrame:
    return chunking.chunk_corpus(table(spark, directory, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_normalised, p2_found, p2_clean, p3_found, p3_shares, p5_found, p5_report, p5_sample, p6_found, p6_by_model, p7_found, p7_share, p7_limits,
        p8_ids, p8_round_trip, p9_found, p9_items, p10_found, p10_pieces,
    )
}

_LABEL = r"regexp_replace(lower(regexp_replace({0}, '^\s+|\s+$', '', 'g')), '[_\-\s]+', '_', 'g')"
_NAMES = ("capture_channel", "capture_scenario", "visual_difficulty")
_CELLS = "SELECT DISTINCT batch_id, plan_id, " + ", ".join(f"{_LABEL.format(c)} AS {c}" for c in _NAMES) + " FROM render_plan WHERE plan_id IS NOT NULL"
SQL = {
    "p5_found": f"""WITH p AS ({_CELLS}), t AS (SELECT request_id, target_no, batch_id, greatest(sample_size * target_percent / 100.0, min_rows) AS needed,
        {", ".join(f"{_LABEL.format(c)} AS {c}" for c in _NAMES)} FROM sample_target)
        SELECT t.request_id, t.target_no FROM t LEFT JOIN p ON p.batch_id = t.batch_id AND
        {" AND ".join(f"(t.{c} IS NULL OR t.{c} = p.{c})" for c in _NAMES)}
        GROUP BY t.request_id, t.target_no, t.needed HAVING count(DISTINCT p.plan_id) < t.needed""",
    "p8_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
