"""Queries of the core operators over the test tables, each with its SQL where SQL can state it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.functions import distance, text
from folioscope.operators import corpus, evaluation, neighbours, scores, summary
from folioscope.sources.shared import spread
from folioscope.sources.tables import table
from folioscope.streaming import events as windows

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, directory) under its name."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def _r(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)


# ---- texts ---------------------------------------------------------------------------------------------------------

_S = text.SPACE
_B = "".join(text.SCRIPTS.values())


def _removed(source: str, pattern: str) -> str:
    return f"(length({source}) - length(regexp_replace({source}, '{pattern}', '', 'g')))"


_REST = f"regexp_replace(text, '[{_S}{_B}]', '', 'g')"
_COUNTS = {
    "whitespace": _removed("text", f"[{_S}]"),
    **{n: _removed("text", f"[{b}]") for n, b in text.SCRIPTS.items()},
    "digit": _removed(_REST, r"\p{Nd}"),
    "symbol": _removed(_REST, rf"[{text.AS_SYMBOL}\p{{S}}\p{{No}}]"),
    "punctuation": _removed(f"regexp_replace({_REST}, '[{text.AS_SYMBOL}]', '', 'g')", r"\p{P}"),
}
_LINES = f"list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{_S}]'))"
_STATS_SQL = (
    "length(text)::DOUBLE AS chars_per_page, len(l)::DOUBLE AS line_count, "
    "CASE WHEN len(l) > 0 THEN list_sum(list_transform(l, lambda x: length(x)))::DOUBLE / len(l) ELSE 0 END AS mean_line_length, "
    + ", ".join(f"{_COUNTS[s.removesuffix('_share')]}::DOUBLE / greatest(length(text), 1) AS {s}" for s in text.STATS[3:])
)
_CODE = "nullif(regexp_extract(lower(trim(lang)), '^[a-z]+'), '')"
_PER_DOC = f"SELECT doc_id, lang, {_STATS_SQL} FROM (SELECT doc_id, {_CODE} AS lang, text, {_LINES} AS l FROM documents WHERE text IS NOT NULL)"


def _per_doc(spark: SparkSession, directory: str) -> DataFrame:
    docs = spread(table(spark, directory, "documents").where("text is not null").select("doc_id", text.language_code(F.col("lang")).alias("lang"), "text"))
    return docs.select("doc_id", "lang", *text.text_stats(F.col("text")))


@query(f"SELECT doc_id, {', '.join(f'round({s}, 6) AS {s}' for s in text.STATS)} FROM ({_PER_DOC})")
def text_stats(spark: SparkSession, directory: str) -> DataFrame:
    return _per_doc(spark, directory).select("doc_id", *(_r(F.col(s)).alias(s) for s in text.STATS))


@query(f"""SELECT lang, metric, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.5), 6) AS median,
    round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.95), 6) AS p95
    FROM (UNPIVOT (SELECT * EXCLUDE (doc_id) FROM ({_PER_DOC})) ON {', '.join(text.STATS)} INTO NAME metric VALUE value) GROUP BY lang, metric""")
def text_summary_by_lang(spark: SparkSession, directory: str) -> DataFrame:
    out = summary.summarise(_per_doc(spark, directory), list(text.STATS), ["lang"], quantiles_too=False)
    return out.select("lang", "metric", "count", *(_r(F.col(c)).alias(c) for c in ("mean", "std", "median", "p05", "p95")))


@query()
def prose_summary_by_family(spark: SparkSession, directory: str) -> DataFrame:
    """The same over prose, with Markdown taken out, by document family."""
    docs = table(spark, directory, "documents").where("text is not null")
    rows = docs.select("document_family", *text.text_stats(text.strip_markdown(F.col("text"))))
    out = summary.summarise(rows, list(text.STATS), ["document_family"], quantiles_too=False)
    return out.select("document_family", "metric", "count", *(_r(F.col(c)).alias(c) for c in ("mean", "std", "median", "p05", "p95")))


_Q = ", ".join(str(p) for p in summary.POINTS)


@query(f"""WITH m AS (SELECT lang, metric, quantile_cont(value, [{_Q}]) AS q, avg(value) AS mean FROM
    (UNPIVOT (SELECT * EXCLUDE (doc_id) FROM ({_PER_DOC}) WHERE lang IN ('en', 'ko')) ON {', '.join(text.STATS)} INTO NAME metric VALUE value) GROUP BY lang, metric),
    g AS (SELECT r.metric, r.q AS rq, c.q AS cq, list_avg(list_transform(list_zip(r.q, c.q), lambda z: abs(round(z[1], 6) - round(z[2], 6)))) AS w1
    FROM m r JOIN m c ON r.metric = c.metric AND r.lang = 'en' AND c.lang = 'ko'),
    n AS (SELECT metric, w1, w1 / greatest(rq[96] - rq[6], 0.05 * abs(rq[51]), 1e-6) AS w1_norm, cq[51] > rq[51] AS up FROM g)
    SELECT metric, round(w1, 6) AS w1, round(w1_norm, 6) AS w1_norm, CASE WHEN up THEN 'higher' ELSE 'lower' END AS candidate_is,
    CASE WHEN w1_norm < 0.1 THEN 'close' WHEN w1_norm < 0.3 THEN 'noticeable' ELSE 'different' END AS verdict FROM n""")
def language_gap(spark: SparkSession, directory: str) -> DataFrame:
    both = summary.summarise(_per_doc(spark, directory).where(F.col("lang").isin("en", "ko")), list(text.STATS), ["lang"])
    sides = [both.where(F.col("lang") == code) for code in ("en", "ko")]
    return summary.gap(*sides).select("metric", _r(F.col("w1")).alias("w1"), _r(F.col("w1_norm")).alias("w1_norm"), "candidate_is", "verdict")


@query(rf"""SELECT char, count(*) AS count FROM (SELECT unnest(string_split(regexp_replace(text, '[{_S}{_B}\p{{Nd}}]|[^\p{{P}}\p{{S}}\p{{No}}]', '', 'g'), '')) AS char FROM documents)
    WHERE char <> '' GROUP BY char ORDER BY count DESC, encode(char) LIMIT 20""")
def top_symbols(spark: SparkSession, directory: str) -> DataFrame:
    return summary.top_symbols(table(spark, directory, "documents"), "text")


@query(r"""SELECT result_id, length(s) AS clean_chars, md5(s) AS clean_hash FROM (SELECT result_id, regexp_replace(replace(replace(replace(replace(replace(replace(prediction,
    '\t', ''), '\n', ''), chr(9), ''), chr(10), ''), '/t', ''), '/n', ''), '[^\p{L}\p{N}_]', '', 'g') AS s FROM report WHERE prediction IS NOT NULL)""")
def score_texts(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "report").where("prediction is not null").select("result_id", text.clean_for_score(F.col("prediction")).alias("s"))
    return rows.select("result_id", F.char_length("s").cast("long").alias("clean_chars"), F.md5("s").alias("clean_hash"))


@query("SELECT run_id, regexp_replace(lower(list_extract(string_split(trim(coalesce(model_id, '')), '/'), -1)), '[^a-z0-9]+', '', 'g') AS model_key FROM report_run")
def model_keys(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "report_run").select("run_id", text.model_key(F.col("model_id")).alias("model_key"))


@query("""SELECT run_id, lower(coalesce(nullif(trim(lang_code), ''), CASE WHEN contains(dataset_id, '-') THEN nullif(trim(list_extract(string_split(dataset_id, '-'), -1)), '') END, 'unknown')) AS language FROM report_run""")
def run_languages(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "report_run").select("run_id", F.lower(text.language_of(F.col("lang_code"), F.col("dataset_id"))).alias("language"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '(\\[a-zA-Z]+|\\.|[A-Za-z0-9]+|[^\s])', 1)) AS tokens FROM documents WHERE text IS NOT NULL")
def formula_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").where("text is not null")
    return docs.select("doc_id", F.size(text.formula_tokens(F.col("text"))).cast("long").alias("tokens"))


@query("""SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part""")
def part_slugs(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))


@query((r"""SELECT doc_id, array_to_string(list_transform(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^[~]+|[~]+$', '', 'g')), lambda x: CASE WHEN x = '' THEN '_' WHEN regexp_matches(x, '^#{1,6} ') THEN 'h'
    WHEN regexp_matches(x, '^(```|~~~)') THEN 'c' WHEN regexp_matches(x, '^[|]') THEN 't' WHEN regexp_matches(x, '^>') THEN 'q' WHEN regexp_matches(x, '^[-*+] ') THEN 'b'
    WHEN regexp_matches(x, '^[0-9]+[.)] ') THEN 'n' WHEN regexp_matches(x, '^([$][$]|\\\[)') THEN 'm' WHEN regexp_matches(x, '^!\[') THEN 'i'
    WHEN regexp_matches(x, '^(-{3,}|={3,})$') THEN 'r' WHEN regexp_matches(x, '^<') THEN 'x' ELSE 'p' END), '|') AS signature FROM documents WHERE text IS NOT NULL""").replace("[~]", f"[{_S}]"))
def structure_signatures(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").where("text is not null")
    return docs.select("doc_id", text.structure_signature(F.col("text")).alias("signature"))


@query()
def wiki_parts(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").where("text is not null")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line")).withColumn("position", F.struct("doc_id", "n"))
    out = corpus.wiki_parts(lines, "line", "position")
    return out.select("kind", "item", F.col("first.doc_id").alias("first_doc"), F.col("first.n").alias("first_line"))


@query("""SELECT text, min(doc_id) AS first FROM documents WHERE text IS NOT NULL GROUP BY text""")
def first_seen_texts(spark: SparkSession, directory: str) -> DataFrame:
    return corpus.first_seen(table(spark, directory, "documents"), "text", ["doc_id"]).select("text", F.col("first.doc_id").alias("first"))


# ---- distances -----------------------------------------------------------------------------------------------------

_PLAIN = lambda c: F.regexp_replace(c, r"[^\x00-\x7F]", "")
_P, _T = (f"regexp_replace(coalesce({c}, ''), '[^\\x00-\\x7F]', '', 'g')" for c in ("prediction", "ground_truth"))


@query(f"SELECT result_id, round(CASE WHEN p = t THEN 0 WHEN length(t) = 0 THEN 1 ELSE levenshtein(p, t)::DOUBLE / length(t) END, 6) AS cer FROM (SELECT result_id, {_P} AS p, {_T} AS t FROM report)")
def ascii_cer(spark: SparkSession, directory: str) -> DataFrame:
    """Character error rate with a normalisation: characters beyond ASCII are left out."""
    out = scores.error_rates(table(spark, directory, "report"), "result_id", normalise=lambda c: _PLAIN(F.coalesce(c, F.lit(""))), rates=("cer",))
    return out.withColumn("cer", _r(F.col("cer")))


@query()
def error_rates(spark: SparkSession, directory: str) -> DataFrame:
    """Character and word error rates, accuracy and distance of every result."""
    out = scores.error_rates(table(spark, directory, "report"), "result_id")
    return out.withColumns({c: _r(F.col(c)) for c in ("cer", "wer", "char_accuracy", "ned")})


_W = lambda c: f"list_distinct(list_filter(regexp_split_to_array(coalesce({c}, ''), '[{_S}]+'), lambda w: w <> ''))"


@query(f"""SELECT result_id, round(CASE WHEN len(t) = 0 THEN (len(p) = 0)::INT ELSE len(list_intersect(t, p))::DOUBLE / len(t) END, 6) AS word_accuracy
    FROM (SELECT result_id, {_W('ground_truth')} AS t, {_W('prediction')} AS p FROM report)""")
def word_accuracy(spark: SparkSession, directory: str) -> DataFrame:
    report = spread(table(spark, directory, "report").select("result_id", "ground_truth", "prediction"))
    return report.select("result_id", _r(distance.word_accuracy(F.col("ground_truth"), F.col("prediction"))).alias("word_accuracy"))


@query(f"""SELECT model_id, count(*) AS samples, sum((regexp_replace(coalesce(prediction, ''), '^[{_S}]+|[{_S}]+$', '', 'g') = regexp_replace(coalesce(ground_truth, ''), '^[{_S}]+|[{_S}]+$', '', 'g'))::INT)::BIGINT AS exact
    FROM report GROUP BY model_id""")
def exact_matches(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "report").groupBy("model_id")
    return rows.agg(F.count("*").alias("samples"), F.sum(distance.exact(F.col("ground_truth"), F.col("prediction"))).cast("long").alias("exact"))


# ---- runs and leaderboards -----------------------------------------------------------------------------------------

_OK = "coalesce(trim(error) IN ('', 'None'), true)"
_BLANK = f"(prediction IS NULL OR NOT regexp_matches(prediction, '[^{_S}]'))"
_ONCE = "SELECT * FROM report QUALIFY row_number() OVER (PARTITION BY run_id, sample_index ORDER BY received_at, result_id) = 1"


def _once(spark: SparkSession, directory: str) -> DataFrame:
    return evaluation.first_delivery(table(spark, directory, "report"), ["run_id", "sample_index"], [F.col("received_at"), F.col("result_id")])


@query(f"""SELECT run_id, count(*) AS total_samples, count(*) FILTER ({_OK}) AS successful, count(*) FILTER (NOT {_OK}) AS failed, round(avg(latency_ms), 9) AS avg_latency_ms,
    count(*) FILTER ({_BLANK}) AS empty_count, round(count(*) FILTER ({_BLANK}) / count(*)::DOUBLE, 6) AS empty_rate FROM ({_ONCE}) GROUP BY run_id""")
def run_summaries(spark: SparkSession, directory: str) -> DataFrame:
    out = evaluation.run_summary(_once(spark, directory), ["run_id"])
    return out.withColumns({"avg_latency_ms": _r(F.col("avg_latency_ms"), 9), "empty_rate": _r(F.col("empty_rate"))})


@query(f"SELECT result_id FROM report WHERE {_OK} AND NOT {_BLANK}")
def valid_results(spark: SparkSession, directory: str) -> DataFrame:
    return evaluation.valid(table(spark, directory, "report")).select("result_id")


_LANGUAGE = "lower(coalesce(nullif(trim(lang_code), ''), CASE WHEN contains(dataset_id, '-') THEN nullif(trim(list_extract(string_split(dataset_id, '-'), -1)), '') END, 'unknown'))"
_LATEST = f"""SELECT * FROM (SELECT * REPLACE (coalesce(nullif(trim(model_id), ''), list_extract(string_split(report_path, '/'), -2)) AS model_id), {_LANGUAGE} AS language FROM report_run)
    QUALIFY row_number() OVER (PARTITION BY model_id, language ORDER BY run_at DESC NULLS LAST, report_path DESC) = 1"""
_MAIN = "avg_markdown_overall_score"


def _latest(spark: SparkSession, directory: str) -> DataFrame:
    return evaluation.latest(table(spark, directory, "report_run")).withColumn("score", F.col("metrics")[_MAIN])


@query(f"SELECT model_id, language, report_path, run_at FROM ({_LATEST})")
def latest_reports(spark: SparkSession, directory: str) -> DataFrame:
    return _latest(spark, directory).select("model_id", "language", "report_path", "run_at")


@query(f"""SELECT language, model_id, round(metrics['{_MAIN}'], 6) AS score, row_number() OVER (PARTITION BY language ORDER BY -metrics['{_MAIN}'] ASC NULLS LAST, model_id) AS rank FROM ({_LATEST})""")
def leaderboard(spark: SparkSession, directory: str) -> DataFrame:
    out = evaluation.ranked(_latest(spark, directory), F.col("score"), _MAIN)
    return out.select("language", "model_id", _r(F.col("score")).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(f"SELECT model_id, language, round(coalesce(successful / nullif(total_samples, 0)::DOUBLE, 0), 6) AS success_rate FROM ({_LATEST})")
def success_rates(spark: SparkSession, directory: str) -> DataFrame:
    return evaluation.compare(_latest(spark, directory)).select("model_id", "language", _r(F.col("success_rate")).alias("success_rate"))


@query(f"""SELECT language, (min(ROW(-s, model_id)) FILTER (s IS NOT NULL))[2] AS best_model, round(max(s), 6) AS best_value FROM (SELECT *, metrics['{_MAIN}'] AS s FROM ({_LATEST})) GROUP BY language""".replace("(min(ROW(-s, model_id)) FILTER (s IS NOT NULL))[2]", "arg_min(model_id, ROW(-s, model_id)) FILTER (s IS NOT NULL)"))
def best_models(spark: SparkSession, directory: str) -> DataFrame:
    return evaluation.best(_latest(spark, directory), ["language"], F.col("score")).withColumn("best_value", _r(F.col("best_value")))


@query(f"""WITH m AS (SELECT model_id, avg(metrics['{_MAIN}']) AS x, avg(avg_latency_ms) AS y FROM ({_LATEST}) GROUP BY model_id HAVING x IS NOT NULL AND y IS NOT NULL),
    k AS (SELECT *, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM m),
    p AS (SELECT sum(sign((b.x - a.x) * (b.y - a.y)))::DOUBLE AS s, sum(abs(sign(b.x - a.x)))::DOUBLE AS nx, sum(abs(sign(b.y - a.y)))::DOUBLE AS ny, sum(abs(sign((b.x - a.x) * (b.y - a.y))))::DOUBLE AS nn FROM m a JOIN m b ON a.model_id < b.model_id)
    SELECT (SELECT count(*) FROM m) AS n, round((SELECT corr(x, y) FROM m), 6) AS pearson, round((SELECT corr(rx, ry) FROM k), 6) AS spearman, round(s / sqrt(nx * ny), 6) AS kendall_tau_b, round(s / nn, 6) AS gamma FROM p""")
def score_latency_correlation(spark: SparkSession, directory: str) -> DataFrame:
    models = _latest(spark, directory).groupBy("model_id").agg(F.avg("score").alias("x"), F.avg("avg_latency_ms").alias("y"))
    out = summary.rank_statistics(models, "x", "y")
    return out.select("n", *(_r(F.col(c)).alias(c) for c in ("pearson", "spearman", "kendall_tau_b", "gamma")))


@query("""WITH s AS (SELECT regexp_replace(lower(list_extract(string_split(model_id, '/'), -1)), '[^a-z0-9]+', '', 'g') AS k, min(model_id) AS m, max(latency_ms) AS v FROM report WHERE model_id IS NOT NULL GROUP BY model_id),
    r AS (SELECT regexp_replace(lower(list_extract(string_split(stream_name, '/'), 1)), '[^a-z0-9]+', '', 'g') AS k, list_extract(string_split(stream_name, '/'), 1) AS m, max(file_no)::DOUBLE AS v FROM model_summary GROUP BY k, m)
    SELECT coalesce(s.k, r.k) AS match_key, s.m IS NOT NULL AS in_report, r.m IS NOT NULL AS in_summary FROM (SELECT DISTINCT k, k AS m FROM s) s FULL JOIN (SELECT DISTINCT k, k AS m FROM r) r ON s.k = r.k""")
def matched_models(spark: SparkSession, directory: str) -> DataFrame:
    """Models of the reports and of the summaries by normalised name, with the unmatched of either side."""
    a = table(spark, directory, "report").where("model_id is not null").groupBy(F.element_at(F.split("model_id", "/"), -1).alias("model")).agg(F.max("latency_ms").alias("score"))
    b = table(spark, directory, "model_summary").groupBy(F.split("stream_name", "/")[0].alias("model")).agg(F.max("file_no").alias("score"))
    out = evaluation.match_models(a, b)
    return out.select("match_key", F.col("synthetic_model").isNotNull().alias("in_report"), F.col("real_model").isNotNull().alias("in_summary"))


@query(f"SELECT DISTINCT run_id, sample_index FROM report EXCEPT SELECT run_id, sample_index FROM report WHERE {_OK} AND NOT {_BLANK}")
def samples_to_run_again(spark: SparkSession, directory: str) -> DataFrame:
    """Samples without a valid result in any delivery: what a resumed run has to do."""
    report = table(spark, directory, "report")
    return evaluation.remaining(report, evaluation.valid(report), ["run_id", "sample_index"])


@query(f"""WITH a AS (SELECT result_id, prediction FROM report WHERE NOT coalesce(error IN ('', 'None'), false)), e AS (SELECT result_id, error FROM report WHERE NOT {_OK})
    SELECT k.result_id, CASE WHEN x IS NULL THEN prediction ELSE '' END AS prediction, x AS error FROM (SELECT r.result_id, a.prediction,
    coalesce(e.error, CASE WHEN a.result_id IS NULL THEN 'Missing batch response' WHEN {_BLANK.replace('prediction', 'a.prediction')} THEN 'Empty prediction in batch response' END) AS x
    FROM report r LEFT JOIN a ON a.result_id = r.result_id LEFT JOIN e ON e.result_id = r.result_id) k""")
def batch_results(spark: SparkSession, directory: str) -> DataFrame:
    """Answers, missing answers and errors of a batch joined; rows with a blank error stand for missing answers."""
    report = table(spark, directory, "report")
    answers = report.where(~F.coalesce(F.col("error").isin("", "None"), F.lit(False))).select("result_id", "prediction")
    errors = report.where(~evaluation.succeeded(F.col("error"))).select("result_id", "error")
    return evaluation.batch_results(report, answers, errors, "result_id")


@query("""SELECT run_id, sample_index, arg_max(result_id, received_at) AS result_id FROM (SELECT * FROM report QUALIFY row_number() OVER (PARTITION BY run_id, sample_index ORDER BY received_at DESC, result_id DESC) = 1) GROUP BY run_id, sample_index""")
def merged_results(spark: SparkSession, directory: str) -> DataFrame:
    """Checkpointed results with later deliveries merged in: the later one wins."""
    report = table(spark, directory, "report").select("run_id", "sample_index", "result_id", "received_at")
    last = evaluation.first_delivery(report, ["run_id", "sample_index"], [F.desc("received_at"), F.desc("result_id")])
    first = evaluation.first_delivery(report, ["run_id", "sample_index"], [F.asc("received_at"), F.asc("result_id")])
    return evaluation.upsert(first, last, ["run_id", "sample_index"]).select("run_id", "sample_index", "result_id")


@query(f"""SELECT backend, language, count(*) AS models, round(avg(metrics['{_MAIN}']), 4) AS mean FROM ({_LATEST}) GROUP BY ROLLUP (backend, language)""")
def leaderboard_rollup(spark: SparkSession, directory: str) -> DataFrame:
    return _latest(spark, directory).rollup("backend", "language").agg(F.count("*").alias("models"), _r(F.avg("score"), 4).alias("mean"))


@query("""SELECT run_id, metric, round(value, 6) AS value FROM (SELECT run_id, unnest(map_keys(metrics)) AS metric, unnest(map_values(metrics)) AS value FROM report_run) WHERE NOT starts_with(metric, 'min_') AND NOT starts_with(metric, 'max_')""")
def run_metrics(spark: SparkSession, directory: str) -> DataFrame:
    kept = F.map_filter("metrics", lambda k, v: ~k.startswith("min_") & ~k.startswith("max_"))
    return table(spark, directory, "report_run").select("run_id", F.explode(kept).alias("metric", "value")).withColumn("value", _r(F.col("value")))


# ---- page scores ---------------------------------------------------------------------------------------------------


@query()
def page_scores(spark: SparkSession, directory: str) -> DataFrame:
    return scores.page_scores(evaluation.valid(table(spark, directory, "report")), "result_id")


@query()
def model_scores(spark: SparkSession, directory: str) -> DataFrame:
    return scores.model_scores(table(spark, directory, "report"), ["model_id"], "result_id")


@query()
def page_blocks(spark: SparkSession, directory: str) -> DataFrame:
    rows = scores.page_blocks(table(spark, directory, "documents"), "doc_id", "text")
    return rows.groupBy("doc_id", "block_type").agg(F.count("*").alias("blocks"), F.sum(F.char_length("content")).alias("chars"))


@query(r"""SELECT result_id, len(r) AS num_rows, coalesce(list_max(list_transform(r, lambda x: len(regexp_extract_all(x, '(?is)<t[hd]\b[^>]*>(.*?)</t[hd]>', 1)))), 0)::BIGINT AS num_cols
    FROM (SELECT result_id, regexp_extract_all(prediction, '(?is)<tr\b[^>]*>(.*?)</tr>', 1) AS r FROM report WHERE contains(lower(prediction), '<table'))""")
def html_tables(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "report").where(F.lower("prediction").contains("<table")).select("result_id", text.html_cells(F.col("prediction")).alias("r"))
    return rows.select("result_id", F.size("r").cast("long").alias("num_rows"), F.coalesce(F.array_max(F.transform("r", lambda x: F.size(x))), F.lit(0)).cast("long").alias("num_cols"))


@query("""WITH o AS (SELECT l_orderkey, count(*) AS p, count(*) FILTER (l_returnflag <> 'R') AS t FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, round(least(p, t) / p::DOUBLE, 6) AS precision, round(coalesce(least(p, t) / nullif(t, 0)::DOUBLE, 0), 6) AS recall,
    round(coalesce(2 * (least(p, t) / p::DOUBLE) * coalesce(least(p, t) / nullif(t, 0)::DOUBLE, 0) / nullif(least(p, t) / p::DOUBLE + coalesce(least(p, t) / nullif(t, 0)::DOUBLE, 0), 0), 0), 6) AS f1 FROM o""")
def row_detection(spark: SparkSession, directory: str) -> DataFrame:
    """Precision, recall and F1 of counted rows: all lines of an order against those that weren't returned."""
    rows = table(spark, directory, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("p"), F.count_if(F.col("l_returnflag") != "R").alias("t"))
    return rows.select("l_orderkey", *(_r(c).alias(n) for n, c in distance.detected(F.col("p"), F.col("t")).items()))


@query("""WITH g AS (SELECT * FROM lineitem), a AS (SELECT *, l_quantity - lag(l_quantity) OVER w AS d, datediff('day', lag(l_shipdate) OVER w, l_shipdate) AS e FROM g WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice, l_shipdate))
    SELECT l_orderkey, round(count(*) FILTER (d * e > 0) / nullif(count(*) FILTER (d IS NOT NULL), 0)::DOUBLE, 6) AS order_accuracy FROM a GROUP BY l_orderkey HAVING count(*) > 1""")
def order_accuracy(spark: SparkSession, directory: str) -> DataFrame:
    """Share of consecutive steps in which two orders move the same way: quantity and ship date of an order's lines."""
    line = F.struct("l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate", "l_quantity")
    lines = table(spark, directory, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("l"))
    same = distance.same_direction(F.transform("l", lambda x: x["l_quantity"]), F.transform("l", lambda x: F.unix_date(x["l_shipdate"].cast("date"))))
    return lines.select("l_orderkey", _r(same).alias("order_accuracy")).where("order_accuracy is not null")


@query("""WITH e AS (SELECT run_id, report_path, unnest(map_keys(metrics)) AS field, unnest(map_values(metrics)) AS v, row_number() OVER (PARTITION BY dataset_id, model_id ORDER BY run_at, run_id) AS n, dataset_id, model_id FROM report_run),
    j AS (SELECT coalesce(a.run_id, NULL) AS run_id FROM e a) SELECT dataset_id, field, count(*) AS runs, round(avg(v), 6) AS mean, round(min(v), 6) AS least, round(max(v), 6) AS most FROM e GROUP BY dataset_id, field""")
def metric_fields(spark: SparkSession, directory: str) -> DataFrame:
    """Mean, least and greatest value of every metric field by data set."""
    rows = table(spark, directory, "report_run").select("dataset_id", F.explode("metrics").alias("field", "v"))
    return rows.groupBy("dataset_id", "field").agg(F.count("*").alias("runs"), _r(F.avg("v")).alias("mean"), _r(F.min("v")).alias("least"), _r(F.max("v")).alias("most"))


# ---- distributions -------------------------------------------------------------------------------------------------

_FIELDS = ("distribution_profile", "capture_channel", "capture_scenario", "visual_difficulty", "target_dpi")
_CAST = ", ".join(f"{f}::VARCHAR AS {f}" for f in _FIELDS)


@query(f"""SELECT field, value, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY field), 6) AS share FROM
    (UNPIVOT (SELECT {_CAST} FROM render_plan) ON {', '.join(_FIELDS)} INTO NAME field VALUE value) WHERE value <> '' GROUP BY field, value""")
def plan_shares(spark: SparkSession, directory: str) -> DataFrame:
    return summary.value_shares(table(spark, directory, "render_plan"), list(_FIELDS)).withColumn("share", _r(F.col("share")))


@query("""SELECT key, count(*) AS plans, round(avg(try_cast(value AS DOUBLE)), 6) AS mean FROM (SELECT unnest(map_keys(degradation_params)) AS key, unnest(map_values(degradation_params)) AS value FROM render_plan) GROUP BY key""")
def degradation_fields(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "render_plan").select(F.explode("degradation_params").alias("key", "value"))
    return rows.groupBy("key").agg(F.count("*").alias("plans"), _r(F.avg(F.col("value").try_cast("double"))).alias("mean"))


@query("""WITH v AS (SELECT greatest(0, least(20000, latency_ms)) AS v FROM report WHERE latency_ms IS NOT NULL), e AS (SELECT min(v) AS lo, max(v) AS hi FROM v)
    SELECT least(floor((v - lo) / ((hi - lo) / 8)), 7)::INT AS bin, round(lo + (hi - lo) / 8 * least(floor((v - lo) / ((hi - lo) / 8)), 7), 3) AS low,
    round(lo + (hi - lo) / 8 * (least(floor((v - lo) / ((hi - lo) / 8)), 7) + 1), 3) AS high, count(*) AS weight FROM v, e GROUP BY 1, 2, 3""")
def latency_histogram(spark: SparkSession, directory: str) -> DataFrame:
    return summary.histogram(table(spark, directory, "report"), "latency_ms", 8, 0, 20000)


@query(f"""WITH s AS (SELECT length(prediction) AS s, NOT {_OK} AS p FROM report WHERE prediction IS NOT NULL), k AS (SELECT p, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM s)
    SELECT round((sum(r) FILTER (p) - count(*) FILTER (p) * (count(*) FILTER (p) + 1) / 2.0)::DOUBLE / (count(*) FILTER (p)::DOUBLE * count(*) FILTER (NOT p)), 6) AS auc FROM k""")
def length_auc(spark: SparkSession, directory: str) -> DataFrame:
    """How well a prediction's length tells failed rows from others."""
    rows = table(spark, directory, "report").where("prediction is not null").select(F.char_length("prediction").alias("s"), (~evaluation.succeeded(F.col("error"))).alias("p"))
    return summary.auc(rows, "s", "p").select(_r(F.col("auc")).alias("auc"))


@query("""SELECT run_id, rank() OVER (ORDER BY avg_latency_ms DESC) + (count(*) OVER (PARTITION BY avg_latency_ms) - 1) / 2.0::DOUBLE AS latency_rank FROM report_run WHERE avg_latency_ms IS NOT NULL""")
def latency_ranks(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "report_run").where("avg_latency_ms is not null").select("run_id", "avg_latency_ms")
    return summary.with_average_rank(rows, "avg_latency_ms", "latency_rank", descending=True).select("run_id", "latency_rank")


@query()
def synthetic_discriminator(spark: SparkSession, directory: str) -> DataFrame:
    """How well text statistics tell forms and receipts from the other documents: AUC of each held-out fold."""
    docs = table(spark, directory, "documents").where("text is not null and document_family is not null")
    rows = docs.select(F.col("document_family").isin("forms", "receipts").alias("side"), *text.text_stats(F.col("text")))
    return summary.discriminate(rows, "side", list(text.STATS))[0].select("fold", _r(F.col("auc")).alias("auc"))


# ---- sets, windows, neighbours -------------------------------------------------------------------------------------


@query("SELECT DISTINCT model_id FROM report INTERSECT SELECT DISTINCT model_id FROM report_run")
def models_in_both(spark: SparkSession, directory: str) -> DataFrame:
    return corpus.common(table(spark, directory, "report"), table(spark, directory, "report_run"), ["model_id"])


@query("SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def customers_with_closed_orders_alone(spark: SparkSession, directory: str) -> DataFrame:
    orders = table(spark, directory, "orders").withColumnRenamed("o_custkey", "custkey")
    return corpus.without(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'O'"), ["custkey"])


@query("""SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right' ELSE 'left' END AS side FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') a
    FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O') b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def customers_of_one_status(spark: SparkSession, directory: str) -> DataFrame:
    orders = table(spark, directory, "orders").withColumnRenamed("o_custkey", "k")
    return corpus.symmetric_difference(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'O'"), "k")


@query("SELECT DISTINCT trim(name) AS item FROM (SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region) WHERE trim(name) <> ''")
def merged_names(spark: SparkSession, directory: str) -> DataFrame:
    return corpus.merged(table(spark, directory, "nation").select(F.col("n_name").alias("item")), table(spark, directory, "region").select(F.col("r_name").alias("item")), "item")


@query("""WITH r AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS m FROM events)
    SELECT user_id, event_type, min(n) AS start, count(*) AS rows FROM r GROUP BY user_id, event_type, n - m""")
def event_runs(spark: SparkSession, directory: str) -> DataFrame:
    out = corpus.runs(table(spark, directory, "events"), ["user_id"], ["ts", "event_id"], "event_type")
    return out.select("user_id", "event_type", F.col("start").cast("long").alias("start"), "rows")


@query("""WITH s AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) SELECT (i // 4096)::BIGINT AS shard, min(i) AS start_index, count(*) AS num_rows FROM s GROUP BY 1""")
def order_shards(spark: SparkSession, directory: str) -> DataFrame:
    """A run of as many samples as there are orders, cut into shards of 4,096."""
    from folioscope.operators.generation import plan_shards

    total = table(spark, directory, "orders").count()
    return plan_shards(spark, total, 4096).select("shard", "start_index", F.col("num_samples").alias("num_rows"))


_NORM = "sqrt(list_sum(list_transform({0}, lambda x: x::DOUBLE * x)))"


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS l FROM v),
    s AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id, list_dot_product(q.e, r.e) / (q.l * r.l) AS score FROM n q JOIN n r ON q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0)
    SELECT query_id, neighbour_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, neighbour_id)::INT AS rank FROM s QUALIFY rank <= 5""")
def nearest_vectors(spark: SparkSession, directory: str) -> DataFrame:
    """The 5 nearest among all vectors of each vector whose id is divisible by 100."""
    rows = table(spark, directory, "embeddings")
    return neighbours.nearest(rows, rows.where("vec_id % 100 = 0")).withColumn("score", _r(F.col("score")))


@query("""SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def daily_events(spark: SparkSession, directory: str) -> DataFrame:
    return windows.tumbling(table(spark, directory, "events")).withColumn("total", _r(F.col("total"), 4))


@query("""SELECT window_start, count(*) AS events, round(avg(value), 6) AS mean FROM (SELECT value, unnest([time_bucket(INTERVAL '2 hours', ts), time_bucket(INTERVAL '2 hours', ts) - INTERVAL '2 hours', time_bucket(INTERVAL '2 hours', ts) - INTERVAL '4 hours']) AS window_start FROM events) GROUP BY 1""")
def sliding_events(spark: SparkSession, directory: str) -> DataFrame:
    return windows.sliding(table(spark, directory, "events")).withColumn("mean", _r(F.col("mean")))


@query("""WITH e AS (SELECT user_id, ts, (ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '30 minutes') AS same FROM events),
    s AS (SELECT user_id, ts, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM e)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS events FROM s GROUP BY user_id, n""")
def user_sessions(spark: SparkSession, directory: str) -> DataFrame:
    return windows.sessions(table(spark, directory, "events"))


# ---- generation ----------------------------------------------------------------------------------------------------

_SCORE = """least(abs(coalesce(try_cast(p['skew_deg'] AS DOUBLE), 0)) / 2, 1.5) + coalesce(try_cast(p['blur_sigma'] AS DOUBLE), 0) * 1.2 + coalesce(try_cast(p['noise_sigma'] AS DOUBLE), 0) / 6
    + coalesce(try_cast(p['perspective'] AS DOUBLE), 0) * 20 + CASE WHEN coalesce(try_cast(p['jpeg_quality'] AS DOUBLE), 0) <> 0 THEN greatest(0, (85 - try_cast(p['jpeg_quality'] AS DOUBLE)) / 25) ELSE 0 END
    + greatest(0, (150 - target_dpi) / 75.0) + CASE WHEN coalesce(p['binarize'] IN ('true', '1'), false) THEN 1 ELSE 0 END + coalesce(try_cast(p['shadow_strength'] AS DOUBLE), 0) * 2
    + coalesce(try_cast(p['page_curl'] AS DOUBLE), 0) * 30 + coalesce(try_cast(p['edge_crop'] AS DOUBLE), 0) * 15"""


@query(f"SELECT plan_row, CASE WHEN s < 1 THEN 'easy' WHEN s < 2.5 THEN 'medium' ELSE 'hard' END AS difficulty FROM (SELECT plan_row, {_SCORE} AS s FROM (SELECT *, degradation_params AS p FROM render_plan))")
def plan_difficulty(spark: SparkSession, directory: str) -> DataFrame:
    from folioscope.operators.generation import difficulty

    plans = table(spark, directory, "render_plan")
    return plans.select("plan_row", difficulty(F.coalesce("degradation_params", F.create_map().cast("map<string,string>")), F.coalesce("target_dpi", F.lit(150))).alias("difficulty"))


@query("SELECT o_orderkey, 42 + o_orderkey * 1009 + 9176 AS sample_seed FROM orders")
def sample_seeds(spark: SparkSession, directory: str) -> DataFrame:
    from folioscope.operators.generation import sample_seed

    return table(spark, directory, "orders").select("o_orderkey", sample_seed(42, F.col("o_orderkey"), 1).alias("sample_seed"))


@query("""SELECT plan_row, greatest(0.5, least(4.0, round(target_dpi / (794 / (210.0 / 25.4)), 6))) AS scale, greatest(8, round_even(body_font_pt / 72.0 * (794 / (210.0 / 25.4)), 0)::INT) AS font_px FROM render_plan""")
def plan_sizes(spark: SparkSession, directory: str) -> DataFrame:
    from folioscope.operators.generation import points_to_px, render_scale

    width = F.lit(794)
    plans = table(spark, directory, "render_plan")
    return plans.select("plan_row", _r(render_scale(F.col("target_dpi"), width)).alias("scale"), points_to_px(F.col("body_font_pt"), width).alias("font_px"))


#: Capture channels of the example profile.
CHANNELS = {
    "born_digital": {"weight": 4, "dpi": {"choices": [150, 200, 300], "weights": [1, 2, 1]}},
    "scanned": {
        "weight": 4, "dpi": {"normal": [220, 40], "clip": [100, 400], "round": 0}, "degradation": {"skew_deg": {"normal": [0, 0.6], "clip": [-3, 3], "round": 2}, "jpeg_quality": {"uniform": [60, 95], "round": 0}},
        "scenarios": {"feed_tray": {"weight": 3}, "line_fax": {"weight": 1, "degradation": {"binarize": True, "jpeg_quality": 0}}},
    },
    "photographed": {"weight": 2, "dpi": [120, 240], "degradation": {"blur_sigma": {"beta": [2, 5], "range": [0, 1.5], "round": 3}}, "scenarios": {"desk_phone": {"weight": 2}, "dim_room": {"weight": 1, "degradation": {"noise_sigma": {"lognormal": [1, 0.4], "round": 2}}}}},
}


@query()
def capture_plans(spark: SparkSession, directory: str) -> DataFrame:
    """A capture plan for every order, by its seed."""
    from folioscope.operators.generation import capture_plans as plans

    rows = sample_seeds(spark, directory)
    return plans(rows, CHANNELS).withColumn("degradation_params", F.to_json("degradation_params"))


#: Most distinct part names that are broadcast as the words of the generated pages; more raise an error.
MAX_NAMES = 1_000_000


@query()
def generated_pages(spark: SparkSession, directory: str) -> DataFrame:
    """A synthetic page for every supplier, its words from the part names."""
    from folioscope.operators.generation import generate_pages

    words = [r.p_name for r in table(spark, directory, "part").select("p_name").distinct().orderBy("p_name").limit(MAX_NAMES + 1).collect()]
    if len(words) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} distinct part names")
    pages = generate_pages(spark, table(spark, directory, "supplier").count(), words, shard_size=32)
    return pages.select("shard", "sample_index", F.array_join("block_types", "|").alias("block_types"), F.length("GT_markdown").alias("chars"), "selection_attempt")
