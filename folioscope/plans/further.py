"""Further queries of the core: tables, entities, ground truth, profiles, reports and text forms, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.functions import distance, text
from folioscope.operators import evaluation, ground_truth, profiling, scores, summary
from folioscope.plans.reference import _BLANK, _LATEST, _OK, _r, query
from folioscope.sources.shared import spread
from folioscope.sources.tables import table

# The SQL states white space and patterns on its own, not through the constants of the operators.
_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _stripped(source: str) -> str:
    return f"regexp_replace({source}, '^{_SPACES}+|{_SPACES}+$', '', 'g')"


def _squashed(source: str) -> str:
    return _stripped(f"regexp_replace({source}, '{_SPACES}+', ' ', 'g')")


# ---- tables --------------------------------------------------------------------------------------------------------

_FIRST = r"(?is)<table\b[^>]*>.*?</table>"
_F1 = "CASE WHEN {0}p + {0}r > 0 THEN 2 * {0}p * {0}r / ({0}p + {0}r) ELSE 0 END"


def _cells(rows: str) -> str:
    cell = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"
    texts = f"list_transform(regexp_extract_all(row, '{cell}', 1), lambda x: {_stripped("regexp_replace(x, '<[^>]+>', '', 'g')")})"
    return f"(SELECT result_id, i, unnest(c) AS v, generate_subscripts(c, 1) AS j FROM (SELECT result_id, i, {texts} AS c FROM (SELECT result_id, unnest({rows}) AS row, generate_subscripts({rows}, 1) AS i FROM r)))"


@query(rf"""WITH t AS (SELECT result_id, regexp_extract(prediction, '{_FIRST}') AS p, regexp_extract(ground_truth, '{_FIRST}') AS t FROM report WHERE regexp_matches(prediction, '{_FIRST}') AND regexp_matches(ground_truth, '{_FIRST}')),
    r AS (SELECT result_id, regexp_extract_all(p, '(?is)<tr\b[^>]*>(.*?)</tr>', 1) AS pr, regexp_extract_all(t, '(?is)<tr\b[^>]*>(.*?)</tr>', 1) AS tr FROM t),
    n AS (SELECT result_id, len(pr) AS pn, len(tr) AS tn FROM r), pc AS {_cells('pr')}, tc AS {_cells('tr')},
    w AS (SELECT n.*, coalesce((SELECT max(j) FROM pc WHERE pc.result_id = n.result_id), 0) AS pm, coalesce((SELECT max(j) FROM tc WHERE tc.result_id = n.result_id), 0) AS tm FROM n),
    c AS (SELECT result_id, count(*) AS total, count(*) FILTER (pc.v = tc.v) AS perfect FROM pc JOIN tc USING (result_id, i, j) WHERE pc.v <> '' OR tc.v <> '' GROUP BY result_id),
    s AS (SELECT w.*, coalesce(total, 0) AS total, coalesce(perfect, 0) AS perfect, coalesce(least(pn, tn) / nullif(pn, 0)::DOUBLE, 0) AS ap, coalesce(least(pn, tn) / nullif(tn, 0)::DOUBLE, 0) AS ar,
        coalesce(least(pm, tm) / nullif(pm, 0)::DOUBLE, 0) AS bp, coalesce(least(pm, tm) / nullif(tm, 0)::DOUBLE, 0) AS br FROM w LEFT JOIN c USING (result_id)),
    f AS (SELECT *, {_F1.format('a')} AS af, {_F1.format('b')} AS bf FROM s)
    SELECT result_id, round(ap, 6) AS row_precision, round(ar, 6) AS row_recall, round(af, 6) AS row_f1, round(bp, 6) AS column_precision, round(br, 6) AS column_recall, round(bf, 6) AS column_f1,
    round(CASE WHEN af + bf > 0 THEN 2 * af * bf / (af + bf) ELSE 0 END, 6) AS structure_f1, perfect::DOUBLE AS perfect_cells, total::DOUBLE AS total_cells, round(coalesce(perfect / nullif(total, 0)::DOUBLE, 0), 6) AS cell_accuracy FROM f""")
def table_structure(spark: SparkSession, directory: str) -> DataFrame:
    """Rows, columns and cells of the first HTML tables of predictions and pages that hold one."""
    both = table(spark, directory, "report").where(F.col("prediction").rlike(_FIRST) & F.col("ground_truth").rlike(_FIRST))
    names = [f"{a}_{b}" for a in ("row", "column") for b in ("precision", "recall", "f1")] + ["structure_f1", "perfect_cells", "total_cells", "cell_accuracy"]
    return scores.table_scores(both, "result_id").select("result_id", *(_r(F.col(n)).alias(n) for n in names))


# ---- entities ------------------------------------------------------------------------------------------------------

_ENTITIES = """l AS (SELECT plan_id, degradation_params AS p, lag(degradation_params) OVER (PARTITION BY batch_id ORDER BY plan_id) AS t FROM (SELECT * FROM render_plan QUALIFY row_number() OVER (PARTITION BY plan_id ORDER BY plan_row) = 1)),
    a AS (SELECT plan_id, unnest(map_keys(p)) AS field, unnest(map_values(p)) AS v FROM l), b AS (SELECT plan_id, unnest(map_keys(t)) AS field, unnest(map_values(t)) AS v FROM l),
    j AS (SELECT coalesce(a.plan_id, b.plan_id) AS plan_id, coalesce(a.field, b.field) AS field, a.field IS NOT NULL AS in_p, b.field IS NOT NULL AS in_t, coalesce(a.v, '') AS p, coalesce(b.v, '') AS t FROM a FULL JOIN b ON a.plan_id = b.plan_id AND a.field = b.field),
    e AS (SELECT *, CASE WHEN p = '' AND t = '' THEN 0 WHEN p = '' OR t = '' THEN 1 ELSE levenshtein(p, t) / length(t)::DOUBLE END AS ned FROM j)"""
_SUMS = f"""{_ENTITIES}, s AS (SELECT plan_id, count(*) FILTER (in_p) AS np, count(*) FILTER (in_t) AS nt, count(*) FILTER (in_p AND in_t AND ned <= 0.3) AS hp, count(*) FILTER (in_t AND ned <= 0.3) AS ht, coalesce(sum(ned) FILTER (in_t), 0) AS d FROM e GROUP BY plan_id),
    v AS (SELECT l.plan_id, coalesce(nt, 0) = 0 AS none, CASE WHEN coalesce(nt, 0) = 0 THEN (coalesce(np, 0) = 0)::INT ELSE coalesce(hp / nullif(np, 0)::DOUBLE, 0) END AS p, CASE WHEN coalesce(nt, 0) = 0 THEN 1 ELSE ht / nt::DOUBLE END AS r,
        CASE WHEN coalesce(nt, 0) = 0 THEN 0 ELSE d / nt END AS ned FROM l LEFT JOIN s USING (plan_id)),
    o AS (SELECT plan_id, p AS precision, r AS recall, CASE WHEN none THEN p WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1, ned AS avg_ned, CASE WHEN none THEN p ELSE 1 - ned END AS avg_accuracy FROM v)"""


def _plan_pairs(spark: SparkSession, directory: str) -> DataFrame:
    plans = evaluation.first_delivery(table(spark, directory, "render_plan"), ["plan_id"], [F.col("plan_row")])
    before = F.lag("degradation_params").over(Window.partitionBy("batch_id").orderBy("plan_id"))
    return plans.select("plan_id", F.col("degradation_params").alias("p"), before.alias("t"))


@query(f"WITH {_SUMS} SELECT plan_id, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(avg_ned, 6) AS avg_ned, round(avg_accuracy, 6) AS avg_accuracy FROM o")
def entity_scores(spark: SparkSession, directory: str) -> DataFrame:
    """Degradation parameters of a plan against those of the plan before it in its batch, as entities."""
    out = scores.entity_scores(_plan_pairs(spark, directory), "plan_id", "p", "t")
    return out.select("plan_id", *(_r(F.col(c)).alias(c) for c in out.columns[1:]))


@query(f"""WITH {_SUMS} SELECT count(*) AS samples, round(avg(f1), 6) AS avg_entity_f1, round(stddev_pop(f1), 6) AS std_entity_f1, round(avg(precision), 6) AS avg_entity_precision, round(avg(recall), 6) AS avg_entity_recall,
    round(avg(avg_accuracy), 6) AS avg_entity_accuracy, round(stddev_pop(avg_accuracy), 6) AS std_entity_accuracy, round(avg(f1), 6) AS avg_overall_f1, round(stddev_pop(f1), 6) AS std_overall_f1 FROM o""")
def entity_totals(spark: SparkSession, directory: str) -> DataFrame:
    out = scores.entity_summary(scores.entity_scores(_plan_pairs(spark, directory), "plan_id", "p", "t"))
    return out.select("samples", *(_r(F.col(c)).alias(c) for c in out.columns[1:]))


@query(f"WITH {_ENTITIES} SELECT field, round(avg(1 - ned), 6) AS avg_accuracy, count(*) AS sample_count FROM e WHERE in_t GROUP BY field")
def entity_fields(spark: SparkSession, directory: str) -> DataFrame:
    return scores.field_accuracy(_plan_pairs(spark, directory), "plan_id", "p", "t").withColumn("avg_accuracy", _r(F.col("avg_accuracy")))


_GROUPS = {"geometry": ("skew_deg", "perspective"), "quality": ("jpeg_quality", "skew_deg", "blur_sigma")}


@query(f"""WITH {_ENTITIES}, c AS (SELECT unnest(['geometry', 'geometry', 'quality', 'quality', 'quality']) AS category, unnest(['skew_deg', 'perspective', 'jpeg_quality', 'skew_deg', 'blur_sigma']) AS field),
    s AS (SELECT plan_id, category, count(*) AS n, count(*) FILTER (ned <= 0.3) AS h, sum(ned) AS d FROM e JOIN c USING (field) WHERE in_t GROUP BY plan_id, category)
    SELECT plan_id, category, round(h / n::DOUBLE, 6) AS precision, round(h / n::DOUBLE, 6) AS recall, round(h / n::DOUBLE, 6) AS f1, round(1 - d / n, 6) AS accuracy, n AS field_count FROM s""")
def entity_categories(spark: SparkSession, directory: str) -> DataFrame:
    out = scores.category_scores(_plan_pairs(spark, directory), "plan_id", "p", "t", _GROUPS)
    return out.select("plan_id", "category", *(_r(F.col(c)).alias(c) for c in ("precision", "recall", "f1", "accuracy")), "field_count")


# ---- ground truth and records --------------------------------------------------------------------------------------


@query("""SELECT result_id, md5(CASE WHEN prediction IS NOT NULL THEN prediction WHEN error IS NOT NULL AND trim(error) <> '' THEN '```json' || chr(10) || '{' || chr(10) || '  "raw": ' || to_json(error)::VARCHAR || chr(10) || '}' || chr(10) || '```'
    WHEN error IS NOT NULL THEN '```json' || chr(10) || '{}' || chr(10) || '```' ELSE '' END) AS page_hash, CASE WHEN prediction IS NOT NULL THEN 'page' WHEN error IS NOT NULL AND trim(error) <> '' THEN 'raw' ELSE 'none' END AS kind FROM report""")
def unified_truth(spark: SparkSession, directory: str) -> DataFrame:
    """Predictions as pages and, where there is none, errors as JSON, in the one form of a ground truth."""
    rows = table(spark, directory, "report").select("result_id", F.col("prediction").alias("markdown"), F.col("error").alias("json"), F.lit("markdown").alias("format"))
    kind = F.when(F.get_json_object("GT_json", "$.markdown").isNotNull(), "page").when(F.get_json_object("GT_json", "$.raw").isNotNull(), "raw").otherwise("none")
    return ground_truth.unified(rows).select("result_id", F.md5("GT_markdown").alias("page_hash"), kind.alias("kind"))


@query(f"SELECT result_id, coalesce(prediction, '') AS prediction, coalesce(error, '') AS error, coalesce(latency_ms, 0) AS latency_ms FROM report WHERE NOT {_OK}")
def published_records(spark: SparkSession, directory: str) -> DataFrame:
    """Failed results as they are published: no nulls."""
    report = table(spark, directory, "report").select("result_id", "prediction", "error", "latency_ms")
    return ground_truth.upload_records(report, report.where(~evaluation.succeeded(F.col("error"))), "result_id")


@query("""SELECT a.sample_index, a.run_id, a.n AS predictions, b.chars FROM (SELECT run_id, sample_index, count(*) AS n FROM report GROUP BY run_id, sample_index) a
    JOIN (SELECT run_id, sample_index, max(length(ground_truth)) AS chars FROM report GROUP BY run_id, sample_index) b USING (run_id, sample_index)""")
def paired_samples(spark: SparkSession, directory: str) -> DataFrame:
    """Predictions joined with the pages of their place."""
    report = table(spark, directory, "report").withColumn("place", F.struct("run_id", "sample_index"))
    pages = report.groupBy("place").agg(F.max(F.char_length("ground_truth")).cast("string").alias("ground_truth"))
    both = ground_truth.paired(report, pages, "place").groupBy("place", "ground_truth").agg(F.count("*").alias("predictions"))
    return both.select("place.sample_index", "place.run_id", "predictions", F.col("ground_truth").cast("long").alias("chars"))


def _profiled(kind: str, source: str, columns: tuple[str, ...]) -> str:
    size = {"length": "length({0})", "number": "{0}", "members": "cardinality({0})"}
    value = {c: size[kind].format(c) for c in columns}
    return " UNION ALL ".join(f"SELECT '{c}' AS field, '{'length' if kind == 'members' else kind}' AS kind, count({c}) AS count, min({v})::DOUBLE AS least, max({v})::DOUBLE AS greatest, avg({v})::DOUBLE AS mean FROM {source}" for c, v in value.items())


_PLAN_TEXTS = ("distribution_profile", "capture_channel", "capture_scenario", "visual_difficulty")
_PLAN_NUMBERS = ("plan_row", "target_dpi", "render_scale", "body_font_pt", "page_aspect_ratio", "page_columns")
_PLAN_ALL = ("plan_row", "plan_id", "batch_id", *_PLAN_TEXTS, "target_dpi", "render_scale", "colored_background", "body_font_pt", "page_aspect_ratio", "page_columns", "degradation_params", "planned_at", "received_at")


@query(f"""SELECT field, kind, count, round(least, 6) AS least, round(greatest, 6) AS greatest, round(mean, 6) AS mean FROM ({_profiled('length', 'render_plan', _PLAN_TEXTS)} UNION ALL {_profiled('number', 'render_plan', _PLAN_NUMBERS)}
    UNION ALL {_profiled('members', 'render_plan', ('degradation_params',))} UNION ALL {" UNION ALL ".join(f"SELECT '{c}', 'presence', count({c}), NULL, NULL, NULL FROM render_plan" for c in _PLAN_ALL)})""")
def plan_profile(spark: SparkSession, directory: str) -> DataFrame:
    out = profiling.record_profile(table(spark, directory, "render_plan"))
    return out.select("field", "kind", "count", *(_r(F.col(c)).alias(c) for c in ("least", "greatest", "mean")))


def _histogram(spec: str, value: str, bins: int, low: int, high: int) -> str:
    inner = f"SELECT greatest({low}, least({high}, {value})) AS v FROM render_plan WHERE {value} IS NOT NULL"
    return f"""SELECT '{spec}' AS spec, b AS bin, round(lo + w * b, 3) AS low, round(lo + w * (b + 1), 3) AS high, count(*) AS weight, NULL::DOUBLE AS p FROM
        (SELECT least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1})::INT AS b, lo, (hi - lo) / {bins} AS w FROM ({inner}), (SELECT min(v)::DOUBLE AS lo, max(v)::DOUBLE AS hi FROM ({inner}))) GROUP BY b, lo, w"""


@query(f"""{_histogram('dpi', 'target_dpi', 8, 60, 400)} UNION ALL {_histogram('skew_deg', "try_cast(degradation_params['skew_deg'] AS DOUBLE)", 12, -10, 10)}
    UNION ALL SELECT 'colored_background', NULL, NULL, NULL, NULL, round(avg(colored_background::INT), 3) FROM render_plan""")
def plan_specs(spark: SparkSession, directory: str) -> DataFrame:
    """Profile specs suggested by the plans, taken as measured pages."""
    plans = table(spark, directory, "render_plan")
    return profiling.suggested_specs(plans.select(F.col("target_dpi").alias("est_dpi_a4"), F.col("degradation_params")["skew_deg"].try_cast("double").alias("skew_deg"), F.col("colored_background").cast("double").alias("is_colored_background")))


@query("""SELECT capture_channel, param, value, count(*) AS rows FROM (SELECT capture_channel, unnest(map_keys(degradation_params)) AS param, unnest(map_values(degradation_params)) AS value FROM render_plan) WHERE value IS NOT NULL GROUP BY ALL""")
def param_marginals(spark: SparkSession, directory: str) -> DataFrame:
    return profiling.marginals(table(spark, directory, "render_plan"), "degradation_params", ["capture_channel"])


# ---- runs ----------------------------------------------------------------------------------------------------------


@query(f"SELECT run_id, sample_index, result_id, error FROM report WHERE NOT {_OK} QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY result_id) <= 10")
def first_errors(spark: SparkSession, directory: str) -> DataFrame:
    return evaluation.first_errors(table(spark, directory, "report"), ["run_id"], "result_id").select("run_id", "sample_index", "result_id", "error")


@query(f"SELECT result_id, CASE WHEN {_OK} AND {_BLANK} THEN 'Empty prediction after retries' ELSE error END AS error, length(coalesce(prediction, '')) AS chars FROM report")
def retried_results(spark: SparkSession, directory: str) -> DataFrame:
    out = evaluation.after_retries(table(spark, directory, "report"))
    return out.select("result_id", "error", F.char_length("prediction").cast("long").alias("chars"))


_WANTED = ("avg_markdown_overall_score", "avg_markdown_text_score", "avg_markdown_table_teds", "avg_markdown_formula_score", "avg_markdown_order_score")
_KEY = f"coalesce({', '.join(f"CASE WHEN metrics['{m}'] IS NOT NULL THEN '{m}' END" for m in _WANTED)}, list_min(list_filter(map_keys(metrics), lambda k: starts_with(k, 'avg_'))), list_min(map_keys(metrics)))"


@query(f"""SELECT model_id, language, dataset_id, k AS metric_key, round(v, 6) AS metric_value, round(CASE WHEN v IS NOT NULL THEN greatest(0, least(1, CASE WHEN k IN ('avg_cer', 'avg_wer') THEN 1 - v ELSE v END)) END, 6) AS normalized, total_samples, empty_rate
    FROM (SELECT *, metrics[k] AS v FROM (SELECT *, {_KEY} AS k FROM ({_LATEST})))""")
def summary_entries(spark: SparkSession, directory: str) -> DataFrame:
    out = evaluation.summary_entries(evaluation.latest(table(spark, directory, "report_run")))
    return out.withColumns({c: _r(F.col(c)) for c in ("metric_value", "normalized")})


@query("SELECT dataset_id, array_to_string(list_sort(list_distinct(flatten(list(map_keys(metrics))))), '|') AS metric_keys FROM report_run WHERE metrics IS NOT NULL GROUP BY dataset_id HAVING len(flatten(list(map_keys(metrics)))) > 0")
def metric_keys(spark: SparkSession, directory: str) -> DataFrame:
    return evaluation.metric_keys(table(spark, directory, "report_run"), ["dataset_id"]).withColumn("metric_keys", F.array_join("metric_keys", "|"))


@query("""SELECT backend, metric, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max FROM (SELECT backend, unnest(['avg_latency_ms', 'empty_rate']) AS metric, unnest([avg_latency_ms, empty_rate]) AS v FROM report_run) WHERE v IS NOT NULL GROUP BY backend, metric""")
def run_metric_table(spark: SparkSession, directory: str) -> DataFrame:
    out = scores.metric_table(table(spark, directory, "report_run"), ["avg_latency_ms", "empty_rate"], ["backend"])
    return out.select("backend", "metric", *(_r(F.col(c)).alias(c) for c in ("mean", "std", "min", "max")))


@query(f"""SELECT model_id AS model, round(arg_max(metrics['avg_markdown_overall_score'], language), 6) AS score FROM ({_LATEST}) WHERE metrics['avg_markdown_overall_score'] IS NOT NULL GROUP BY model_id""")
def leaderboard_scores(spark: SparkSession, directory: str) -> DataFrame:
    board = evaluation.latest(table(spark, directory, "report_run")).withColumn("score", F.col("metrics")["avg_markdown_overall_score"])
    return evaluation.leaderboard_scores(board).withColumn("score", _r(F.col("score")))


@query("""SELECT event_type, n, count(*) AS users FROM (SELECT event_type, user_id, dense_rank() OVER (PARTITION BY event_type ORDER BY c DESC) AS n FROM (SELECT event_type, user_id, count(*) AS c FROM events GROUP BY event_type, user_id)) WHERE n <= 3 GROUP BY event_type, n""")
def most_active_users(spark: SparkSession, directory: str) -> DataFrame:
    """Users of the three greatest numbers of events of each type; ties share a place."""
    counts = table(spark, directory, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("c"))
    ranked = summary.with_average_rank(counts.select("event_type", "c").distinct(), "c", "place", ["event_type"], descending=True)
    return counts.join(ranked.where("place <= 3"), ["event_type", "c"]).groupBy("event_type", F.col("place").cast("long").alias("n")).agg(F.count("*").alias("users"))


# ---- text forms ----------------------------------------------------------------------------------------------------

_SQ = _squashed("prompt")
_CUT = f"CASE WHEN contains(substr(s, 1, 40), ' ') AND 40 - instr(reverse(substr(s, 1, 40)), ' ') >= 24 THEN substr(s, 1, 40 - instr(reverse(substr(s, 1, 40)), ' ')) ELSE substr(s, 1, 40) END"


@query(rf"""SELECT prompt, CASE WHEN length(s) <= 40 THEN s ELSE regexp_replace({_CUT}, '[ ,;:]+$', '') || '...' END AS clipped,
    CASE WHEN length(s) <= 30 THEN s WHEN contains(substr(s, 1, 31), ' ') THEN rtrim(substr(s, 1, 31 - instr(reverse(substr(s, 1, 31)), ' '))) ELSE substr(s, 1, 30) END AS shortened,
    regexp_replace(substr(array_to_string(list_slice(string_split(regexp_replace(s, '[\p{{P}}\s]+$', ''), ' '), 1, 3), ' '), 1, 25), '[ \-_:,;]+$', '') AS fragment,
    translate(lower(trim(prompt)), '- ', '__') AS template_ref FROM (SELECT DISTINCT prompt, {_SQ} AS s FROM report WHERE prompt IS NOT NULL)""")
def prompt_forms(spark: SparkSession, directory: str) -> DataFrame:
    own = F.col("prompt")
    prompts = table(spark, directory, "report").where("prompt is not null").select("prompt").distinct()
    return prompts.select("prompt", text.clip(own, 40).alias("clipped"), text.shorten(own, 30).alias("shortened"), text.fragment(own, 3, 25).alias("fragment"), text.template_ref(own).alias("template_ref"))


_CH = r"regexp_split_to_array(text, '\n[ \t]*\n+')"
_LN = f"list_filter(list_transform(string_split(c, chr(10)), lambda x: {_stripped('x')}), lambda x: x <> '')"
_EV = "len(list_filter(l, lambda x: NOT ({0}))) = 0"


@query(rf"""WITH c AS (SELECT doc_id, unnest({_CH}) AS c FROM documents), l AS (SELECT doc_id, {_LN} AS l FROM c WHERE regexp_matches(c, '[^' || substr('{_SPACES}', 2))),
    k AS (SELECT doc_id, CASE WHEN len(list_filter(l, lambda x: starts_with(x, '```'))) > 0 THEN CASE WHEN len(list_filter(l, lambda x: starts_with(x, '```'))) = 2 AND starts_with(l[1], '```') AND starts_with(l[-1], '```') AND len(l) > 1 THEN 'code' END
        WHEN starts_with(array_to_string(l, chr(10)), '$$') AND ends_with(array_to_string(l, chr(10)), '$$') THEN 'formula'
        WHEN len(l) >= 2 AND {_EV.format("contains(x, '|')")} AND len(list_filter(l, lambda x: regexp_full_match(x, '\|?\s*:?-{{3,}}:?\s*(\|\s*:?-{{3,}}:?\s*)+\|?'))) > 0 OR regexp_matches(lower(array_to_string(l, chr(10))), '(?s)^<table\b.*</table>$') THEN 'table'
        WHEN len(l) = 1 AND regexp_full_match(l[1], '!\[[^\]]*\]\([^)]+\)') THEN 'image' WHEN len(l) = 1 AND l[1] IN ('---', '***') THEN 'rule' WHEN {_EV.format(r"regexp_matches(x, '^-\s+\[[ xX]\]\s+\S')")} THEN 'checklist'
        WHEN {_EV.format("starts_with(x, '- ')")} THEN 'bullet_list' WHEN {_EV.format(r"regexp_matches(x, '^[0-9]+\.\s+\S')")} THEN 'numbered_list' WHEN {_EV.format("starts_with(x, '> ')")} THEN 'quote'
        WHEN len(list_filter(l, lambda x: regexp_matches(x, '^(#|```|\||[$][$]|!\[|> |[-*+] )') OR regexp_matches(x, '^[0-9]+\.\s+\S') OR x IN ('---', '***'))) = 0 THEN 'paragraph' END AS kind FROM l)
    SELECT doc_id, kind, count(*) AS chunks FROM k GROUP BY doc_id, kind""")
def chunk_kinds(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "documents").select("doc_id", F.explode(text.chunks(F.col("text"))).alias("c"))
    return rows.select("doc_id", F.explode(F.array(text.chunk_kind(F.col("c")))).alias("kind")).groupBy("doc_id", "kind").agg(F.count("*").alias("chunks"))


@query(rf"""WITH s AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace({_squashed('text')}, '([.!?。！？])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents WHERE text IS NOT NULL),
    e AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS position FROM s) SELECT doc_id, position::INT AS position, sentence FROM e WHERE length(sentence) > 10 AND length(sentence) < 100""")
def sentence_items(spark: SparkSession, directory: str) -> DataFrame:
    from folioscope.operators import corpus

    return corpus.sentence_items(table(spark, directory, "documents"), "text", ["doc_id"])


@query("""SELECT l_orderkey, l_linenumber, round(CASE WHEN u > 0 THEN i / u ELSE 0 END, 6) AS iou FROM (SELECT l_orderkey, l_linenumber, i, (a + b - i) AS u FROM
    (SELECT *, greatest(0, least(l_quantity, 40) - greatest(0, 10)) * greatest(0, least(l_discount * 100, 8) - greatest(0, 2)) AS i, l_quantity * l_discount * 100 AS a, 30 * 6 AS b FROM
    (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS l_quantity, l_discount::DOUBLE AS l_discount FROM lineitem)))""")
def box_overlaps(spark: SparkSession, directory: str) -> DataFrame:
    """Boxes of quantity and discount against one fixed box."""
    lines = table(spark, directory, "lineitem")
    own = F.array(F.lit(0.0), F.lit(0.0), F.col("l_quantity").cast("double"), F.col("l_discount").cast("double") * 100)
    fixed = F.array(*(F.lit(float(v)) for v in (10, 2, 40, 8)))
    return lines.select("l_orderkey", "l_linenumber", _r(distance.iou(own, fixed)).alias("iou"))


@query("""SELECT run_id, round(CASE WHEN m = d THEN 0 WHEN length(d) = 0 THEN 1 ELSE levenshtein(m, d)::DOUBLE / length(d) END, 6) AS cer FROM (SELECT run_id, coalesce(model_id, '') AS m, coalesce(list_extract(string_split(report_path, '/'), -3), '') AS d FROM report_run)""")
def path_cer(spark: SparkSession, directory: str) -> DataFrame:
    """Error rate of the model's name against the folder of its report: the expression, on short texts."""
    runs = table(spark, directory, "report_run")
    folder = F.coalesce(F.try_element_at(F.split("report_path", "/"), F.lit(-3)), F.lit(""))
    return runs.select("run_id", _r(distance.cer(folder, F.col("model_id"))).alias("cer"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y년 ') || month(o_orderdate) || '월 ' || day(o_orderdate) || '일' AS ko, strftime(o_orderdate, '%Y年') || month(o_orderdate) || '月' || day(o_orderdate) || '日' AS ja,
    strftime(o_orderdate, '%B ') || day(o_orderdate) || strftime(o_orderdate, ', %Y') AS en FROM orders""")
def order_dates(spark: SparkSession, directory: str) -> DataFrame:
    at = F.col("o_orderdate").cast("date")
    return table(spark, directory, "orders").select("o_orderkey", *(text.local_date(at, c).alias(c) for c in ("ko", "ja", "en")))


@query("""SELECT p_partkey, array_to_string(names, '|') AS block_types FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN ['paragraph', 'quote'] WHEN p_size % 3 = 1 THEN ['table', 'bullet_list'] ELSE
    ['paragraph', 'bullet_list', 'numbered_list', 'checklist', 'table', 'formula', 'quote', 'code', 'command', 'image', 'rule'] END AS names FROM part)""")
def block_type_lists(spark: SparkSession, directory: str) -> DataFrame:
    """Lists of block types as users write them, in one form."""
    given = F.when(F.col("p_size") % 3 == 0, F.array(*map(F.lit, ("Text", " quote", "paragraph", "chart")))).when(F.col("p_size") % 3 == 1, F.array(*map(F.lit, ("TABLE", "bullet-list", "table")))).otherwise(F.array(F.lit("unknown")))
    return table(spark, directory, "part").select("p_partkey", F.array_join(text.block_types(given), "|").alias("block_types"))


@query(r"""SELECT char, count(*) AS count FROM (SELECT unnest(string_split(regexp_replace(text, '[\p{Cc}\p{Cf}\p{Co}\p{Z}\s]', '', 'g'), '')) AS char FROM documents) WHERE char <> '' GROUP BY char""")
def valid_characters(spark: SparkSession, directory: str) -> DataFrame:
    from folioscope.operators import corpus

    return corpus.valid_characters(table(spark, directory, "documents"), "text")


@query("""WITH c AS (SELECT n_nationkey AS place, n_name AS item FROM nation) SELECT o_orderkey AS i, item FROM (SELECT o_orderkey FROM orders WHERE o_orderkey < (SELECT count(*) FROM nation)) JOIN c ON place = o_orderkey""")
def rotated_names(spark: SparkSession, directory: str) -> DataFrame:
    """The first round of a rotation: orders take the nations' names in turn."""
    from folioscope.operators import render_plans

    nations = table(spark, directory, "nation").select(F.col("n_nationkey").cast("long").alias("place"), F.col("n_name").alias("item"))
    turns = table(spark, directory, "orders").select(F.col("o_orderkey").cast("long").alias("i"))
    return render_plans.rotated(turns, nations, "item", "i").where(F.col("i") < nations.count()).select("i", "item")


@query()
def styled_plans(spark: SparkSession, directory: str) -> DataFrame:
    """A style and a font for every order, by its seed."""
    from folioscope.operators import render_plans
    from folioscope.plans.reference import sample_seeds

    seed = F.col("sample_seed")
    rows = sample_seeds(spark, directory).select("o_orderkey", render_plans.style(seed, "diverse").alias("s"), render_plans.font(seed, ["NotoSans.ttf", "NotoSerif.ttf", "Mono.ttf"], {"noto": 3, "mono": 1}).alias("font"))
    return rows.select("o_orderkey", "s.content_width", F.round("s.line_spacing", 4).alias("line_spacing"), "s.body_font_size", "font")


@query(r"""SELECT p_partkey, 'https://host.org/' || replace(p_name, ' ', '-') AS repository, 'Title: ' || p_name AS ungrounded, '\geq ' || p_name || ' \leq' AS formula, p_name || ' ' || p_brand AS tagged,
    CASE p_size % 3 WHEN 0 THEN p_partkey::VARCHAR WHEN 1 THEN '- ' || p_partkey || ' -' ELSE p_partkey || ' / ' || p_size END AS page_label, translate(lower(trim(p_type)), '- ', '__') AS canonical_type, p_name AS neutral,
    p_size % 2 = 0 AS table_line, p_name AS item, CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_name || ' ' || p_brand END AS output FROM (SELECT *, trim(p_name) AS n FROM part)""")
def marked_names(spark: SparkSession, directory: str) -> DataFrame:
    """Part names inside the marks of remotes, models, pages and lists, and out of them again."""
    name, number = F.col("p_name"), F.col("p_partkey")
    join = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in parts))
    labels = [text.page_label(number, F.col("p_size"), s) for s in ("plain", "dashed", "of_total")]
    return table(spark, directory, "part").select(
        "p_partkey", text.repository_url(join("git@host.org:", F.replace(name, F.lit(" "), F.lit("-")), ".git")).alias("repository"),
        text.without_grounding(join("Title: <|ref|>", name, "<|/ref|><|det|>[[1,2]]<|/det|>")).alias("ungrounded"), text.tidy_formula(join("$\\ge  ", name, " \\le$")).alias("formula"),
        F.array_join(text.tagged(join("x<char>", name, "</char>y<char>", F.col("p_brand"), "</char>"), "char"), " ").alias("tagged"),
        F.when(F.col("p_size") % 3 == 0, labels[0]).when(F.col("p_size") % 3 == 1, labels[1]).otherwise(labels[2]).alias("page_label"), text.canonical_type(F.col("p_type")).alias("canonical_type"),
        text.neutral(join("> - 1. # ", name)).alias("neutral"), text.is_table_line(F.when(F.col("p_size") % 2 == 0, join("| ", name, " |")).otherwise(join("a | ", name))).alias("table_line"),
        text.item_text(join(" **12.** ", name, " ")).alias("item"),
        text.tagged_output(F.when(F.col("p_size") % 2 == 0, join("assistant\n<p>", name, "</p>")).otherwise(join("<char>", name, "</char> <char>", F.col("p_brand"), "</char>"))).alias("output"),
    )


@query("""SELECT p_partkey, greatest(0.0, least(1.0, coalesce(try_cast(p_type AS DOUBLE), 0.25))) AS ratio, greatest(0.0, least(1.0, (p_size - 10) / 20.0)) AS share FROM part""")
def coerced_ratios(spark: SparkSession, directory: str) -> DataFrame:
    """Ratios from 0 to 1, with a default where a text is no number."""
    return table(spark, directory, "part").select("p_partkey", text.ratio(F.col("p_type"), 0.25).alias("ratio"), text.ratio((F.col("p_size") - 10) / 20.0, 0).alias("share"))


@query(f"""WITH v AS (SELECT * FROM report WHERE {_OK} AND NOT {_BLANK}) SELECT run_id, count(*) AS valid, (SELECT count(*) FROM report r WHERE r.run_id = v.run_id) - count(*) AS left_out FROM v GROUP BY run_id""")
def valid_shares(spark: SparkSession, directory: str) -> DataFrame:
    """Results of each run that are scored, and those that are not."""
    report = table(spark, directory, "report")
    scored = evaluation.valid(report).groupBy("run_id").agg(F.count("*").alias("valid"))
    return scored.join(report.groupBy("run_id").agg(F.count("*").alias("n")), "run_id").select("run_id", "valid", (F.col("n") - F.col("valid")).alias("left_out"))


@query("""SELECT coalesce(nullif(regexp_extract(lower(trim(lang)), '^[a-z]+'), ''), 'unknown') AS language, count(*) AS documents, count(DISTINCT source) AS sources FROM documents GROUP BY 1""")
def document_languages(spark: SparkSession, directory: str) -> DataFrame:
    code = F.coalesce(text.language_code(F.col("lang")), F.lit("unknown"))
    return table(spark, directory, "documents").groupBy(code.alias("language")).agg(F.count("*").alias("documents"), F.countDistinct("source").alias("sources"))


# ---- elements and items --------------------------------------------------------------------------------------------

_LINES = """SELECT l_orderkey, l_linestatus AS kind, l_returnflag = 'R' AS moved, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice, l_shipdate) AS n, l_quantity FROM lineitem"""


def _numbered_lines(spark: SparkSession, directory: str) -> DataFrame:
    place = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    return table(spark, directory, "lineitem").withColumn("n", F.row_number().over(place))


@query(f"""WITH l AS ({_LINES}), k AS (SELECT l_orderkey, kind, count(*) AS n, count(*) FILTER (NOT moved) AS hit FROM l GROUP BY l_orderkey, kind),
    t AS (SELECT l_orderkey, sum(n)::DOUBLE AS n, sum(hit)::DOUBLE AS hit, avg(hit / n::DOUBLE) AS map FROM k GROUP BY l_orderkey)
    SELECT l_orderkey, round(hit / (2 * n - hit), 6) AS text_score, 1.0::DOUBLE AS table_teds, round(hit / (2 * n - hit), 6) AS overall_score, round(map, 6) AS layout_map, round(hit / n, 6) AS layout_precision, round(hit / n, 6) AS layout_recall,
    round(hit / n, 6) AS layout_f1, 1.0::DOUBLE AS kendall_tau, 1.0::DOUBLE AS spearman_rho, 1.0::DOUBLE AS order_accuracy FROM t WHERE n > 1""")
def page_elements(spark: SparkSession, directory: str) -> DataFrame:
    """Lines of an order as elements of a page; those that were returned stand elsewhere in the predicted page."""
    n = F.col("n").cast("double")
    box = lambda shift: F.array(shift, 10 * n, shift + 100, 10 * n + 9)
    moved = F.when(F.col("l_returnflag") == "R", 1000.0).otherwise(0.0)
    element = lambda b: F.struct(F.col("l_linestatus").alias("type"), F.format_string("line %d of the order", "n").alias("text"), b.alias("bounding_box"), F.col("n").alias("reading_order"))
    by_n = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("n", c.alias("e")))), lambda x: x["e"])
    pages = _numbered_lines(spark, directory).groupBy("l_orderkey").agg(by_n(element(box(moved))).alias("p"), by_n(element(box(F.lit(0.0)))).alias("t")).where(F.size("t") > 1)
    names = ("text_score", "table_teds", "overall_score", "layout_map", "layout_precision", "layout_recall", "layout_f1", "kendall_tau", "spearman_rho", "order_accuracy")
    return scores.document_scores(pages, "l_orderkey", "p", "t").select("l_orderkey", *(_r(F.col(c)).alias(c) for c in names))


@query(f"""WITH l AS (SELECT l_orderkey, n, l_quantity::DOUBLE AS q FROM ({_LINES})), r AS (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY q) + (count(*) OVER (PARTITION BY l_orderkey, q) - 1) / 2.0 AS rq FROM l),
    p AS (SELECT a.l_orderkey, sum(sign(b.q - a.q)) AS s, sum(abs(sign(b.q - a.q))) AS x, count(*) AS y FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.n < b.n GROUP BY a.l_orderkey),
    c AS (SELECT l_orderkey, corr(rq, n) AS rho FROM r GROUP BY l_orderkey), g AS (SELECT l_orderkey, count(*) FILTER (q > b) / count(*)::DOUBLE AS same FROM (SELECT l_orderkey, q, lag(q) OVER (PARTITION BY l_orderkey ORDER BY n) AS b FROM l) WHERE b IS NOT NULL GROUP BY l_orderkey)
    SELECT l_orderkey, round(coalesce(s / nullif(sqrt(x::DOUBLE * y), 0), 0), 6) AS kendall_tau, round(CASE WHEN isnan(coalesce(rho, 0)) THEN 0 ELSE coalesce(rho, 0) END, 6) AS spearman_rho, round(same, 6) AS order_accuracy FROM p JOIN c USING (l_orderkey) JOIN g USING (l_orderkey)""")
def reading_orders(spark: SparkSession, directory: str) -> DataFrame:
    """Quantities of the lines of an order as a predicted reading order, against the lines' numbers."""
    ordered = F.sort_array(F.collect_list(F.struct("n", F.col("l_quantity").cast("double").alias("q"))))
    rows = _numbered_lines(spark, directory).groupBy("l_orderkey").agg(ordered.alias("l")).where(F.size("l") > 1)
    rows = rows.select("l_orderkey", F.transform("l", lambda x: x["q"]).alias("p"), F.transform("l", lambda x: x["n"].cast("double")).alias("t"))
    out = scores.reading_orders(rows, "l_orderkey", "p", "t")
    return out.select("l_orderkey", *(_r(F.col(c)).alias(c) for c in out.columns[1:]))


@query(f"""WITH l AS (SELECT l_orderkey, count(*) AS p, count(*) FILTER (NOT moved) AS t, count(*) FILTER (NOT moved AND kind = 'F') AS changed FROM ({_LINES}) GROUP BY l_orderkey)
    SELECT l_orderkey, round(t / p::DOUBLE, 6) AS precision, CASE WHEN t = 0 THEN 1.0 ELSE 1.0 END::DOUBLE AS recall, round(2 * (t / p::DOUBLE) / (t / p::DOUBLE + 1), 6) AS f1, round(CASE WHEN t = 0 THEN 0 ELSE 1 - 0.5 * changed / t END, 6) AS item_accuracy FROM l""")
def order_items(spark: SparkSession, directory: str) -> DataFrame:
    """Lines of an order as receipt items, those that weren't returned as the truth; the quantity of finished lines is misread."""
    wrong = F.when(F.col("l_linestatus") == "F", F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    item = lambda quantity: F.struct(F.md5(F.concat_ws("/", "l_orderkey", "n")).alias("name"), quantity.cast("string").alias("quantity"), F.col("l_extendedprice").cast("string").alias("total_price"))
    lines = _numbered_lines(spark, directory).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(item(wrong))).alias("p"), F.sort_array(F.collect_list(F.when(F.col("l_returnflag") != "R", item(F.col("l_quantity"))))).alias("t"))
    out = scores.item_scores(lines, "l_orderkey", "p", "t")
    return out.select("l_orderkey", *(_r(F.col(c)).alias(c) for c in out.columns[1:]))


# ---- pages made of part names --------------------------------------------------------------------------------------

_LETTERS = "regexp_replace({0}, '[^A-Za-z0-9_]', '', 'g')"


@query(f"""WITH p AS (SELECT p_partkey, p_size % 4 AS c, {_LETTERS.format('p_name')} AS t, {_LETTERS.format('p_brand')} AS g FROM part),
    s AS (SELECT p_partkey, c, CASE WHEN c = 2 THEN greatest(0, 1 - levenshtein(t, g) / length(t)::DOUBLE) ELSE 1.0 END AS text_score, CASE WHEN c = 1 THEN 0.0 ELSE 1.0 END AS table_teds, 1.0 AS formula_score FROM p),
    o AS (SELECT *, CASE WHEN c = 1 OR c = 2 AND text_score = 0 THEN 2 / 3.0 WHEN c = 3 THEN 0.0 ELSE 1.0 END AS order_score FROM s)
    SELECT p_partkey, round(text_score, 6) AS text_score, table_teds::DOUBLE AS table_teds, formula_score::DOUBLE AS formula_score, round(order_score, 6)::DOUBLE AS order_score, round((text_score + table_teds + formula_score + order_score) / 4, 6)::DOUBLE AS overall_score FROM o""")
def part_pages(spark: SparkSession, directory: str) -> DataFrame:
    """Pages of a name, a table and a formula, against pages without the table, with another name, or in another order."""
    head = F.concat(F.lit("| key | size |\n|---|---|\n| "), F.col("p_partkey").cast("string"), F.lit(" | "), F.col("p_size").cast("string"), F.lit(" |"))
    formula = F.concat(F.lit("$$\\frac{x}{"), F.col("p_partkey").cast("string"), F.lit("}$$"))
    page = lambda *blocks: F.concat_ws("\n\n", *blocks)
    kind = F.col("p_size") % 4
    guess = F.when(kind == 1, page("p_name", formula)).when(kind == 2, page("p_brand", head, formula)).when(kind == 3, page(formula, head, F.col("p_name"))).otherwise(page("p_name", head, formula))
    rows = table(spark, directory, "part").select("p_partkey", guess.alias("prediction"), page("p_name", head, formula).alias("ground_truth"))
    return scores.page_scores(rows, "p_partkey").select("p_partkey", *(_r(F.col(c)).alias(c) for c in ("text_score", "table_teds", "formula_score", "order_score", "overall_score")))


@query("""SELECT p_partkey, t.position, t.block_type, length(t.content)::BIGINT AS chars FROM (SELECT p_partkey, unnest([{'position': 0, 'block_type': 'text', 'content': p_name || chr(10) || chr(10)}, {'position': 1, 'block_type': 'formula', 'content': 'x = ' || p_partkey},
    {'position': 2, 'block_type': 'text', 'content': chr(10) || p_brand || chr(10)}, {'position': 3, 'block_type': 'table', 'content': '<table><tr><td>' || p_size || '</td></tr></table>'}]) AS t FROM part)""")
def part_blocks(spark: SparkSession, directory: str) -> DataFrame:
    """Blocks of pages of a name, a formula, a brand and a table."""
    page = F.concat(F.col("p_name"), F.lit("\n\n\\[ x = "), F.col("p_partkey").cast("string"), F.lit(" \\]\n"), F.col("p_brand"), F.lit("\n<table><tr><td>"), F.col("p_size").cast("string"), F.lit("</td></tr></table>\n"))
    out = scores.page_blocks(table(spark, directory, "part").select("p_partkey", page.alias("page")), "p_partkey", "page")
    return out.select("p_partkey", "position", "block_type", F.char_length("content").cast("long").alias("chars"))


@query("""WITH d AS (SELECT p_partkey, p_name AS t, p_brand AS g, levenshtein(p_name, p_brand)::DOUBLE AS e FROM part)
    SELECT p_partkey, round(e / length(t), 6) AS cer, (t = g)::INT::DOUBLE AS exact, round(greatest(0, 1 - e / length(t)), 6) AS char_accuracy, round(e / length(t), 6) AS ned FROM d""")
def name_rates(spark: SparkSession, directory: str) -> DataFrame:
    out = scores.error_rates(table(spark, directory, "part"), "p_partkey", "p_brand", "p_name", rates=("cer", "exact", "char_accuracy", "ned"))
    return out.select("p_partkey", *(_r(F.col(c)).alias(c) for c in out.columns[1:]))


@query("""WITH d AS (SELECT p_partkey, replace(p_name, ' ', '') AS t, replace(p_brand, ' ', '') AS g FROM part) SELECT p_partkey, round(levenshtein(t, g) / length(t)::DOUBLE, 6) AS wer, round(levenshtein(t, g) / length(t)::DOUBLE, 6) AS native_wer FROM d""")
def letter_wer(spark: SparkSession, directory: str) -> DataFrame:
    """Word error rates of texts whose words are single letters, by the kernel and by the expression."""
    spaced = lambda c: F.array_join(F.filter(F.split(c, ""), lambda x: F.trim(x) != ""), " ")
    parts = table(spark, directory, "part").select("p_partkey", spaced("p_name").alias("t"), spaced("p_brand").alias("g"))
    rows = parts.select("p_partkey", "t", "g", _r(distance.wer(F.col("t"), F.col("g"))).alias("native_wer"))
    return scores.error_rates(rows, "p_partkey", "g", "t", rates=("wer",)).withColumn("wer", _r(F.col("wer"))).join(rows.select("p_partkey", "native_wer"), "p_partkey")


@query("""SELECT p_partkey, md5(p_name) || chr(10) || 'page ' || p_size AS page FROM part""")
def unfurnished_pages(spark: SparkSession, directory: str) -> DataFrame:
    """Pages freed of their header, footer and number."""
    body = F.concat_ws("\n", F.concat(F.lit("## "), F.upper("p_name")), F.md5("p_name"), F.concat(F.lit("page "), "p_size"), F.concat(F.lit("**"), F.col("p_brand"), F.lit(" ")), F.concat(F.lit(" "), F.col("p_partkey").cast("string")))
    furniture = F.struct(F.col("p_name").alias("header"), F.col("p_brand").alias("footer"), F.col("p_partkey").cast("string").alias("page_number"))
    rows = table(spark, directory, "part").select("p_partkey", body.alias("page"), furniture.alias("furniture"))
    return scores.without_furniture(rows, "page", "furniture").select("p_partkey", F.regexp_replace("page", "\n$", "").alias("page"))


@query("""SELECT p_partkey, 12.0::DOUBLE AS width, 18.0::DOUBLE AS height, 1.5::DOUBLE AS aspect_ratio, (p_size * 5)::DOUBLE AS background_luma, (p_size * 5)::DOUBLE AS ink_luma, 0.0::DOUBLE AS contrast, 0.0::DOUBLE AS skew_deg, 0.0::DOUBLE AS noise_sigma, 0.0::DOUBLE AS ink_ratio, 0.0::DOUBLE AS colorfulness,
    1.0::DOUBLE AS is_grayscale, (p_size * 5 < 20 OR p_size * 5 > 235)::INT::DOUBLE AS is_binary, (p_size * 5 < 200)::INT::DOUBLE AS is_colored_background, 0.0::DOUBLE AS text_line_count, 1.0::DOUBLE AS margin_top_frac, 1.0::DOUBLE AS column_count, 0.0::DOUBLE AS rule_count FROM part""")
def page_pixels(spark: SparkSession, directory: str) -> DataFrame:
    """Statistics of blank pages of one grey, a page for each part."""
    from folioscope.operators.measure import measure

    grey = F.unhex(F.repeat(F.lpad(F.hex((F.col("p_size") * 5).cast("long")), 2, "0"), 12 * 18 * 3))
    parts = spread(table(spark, directory, "part").select("p_partkey", "p_size"))  # keys are dealt out, not pixels
    out = measure(parts.select(F.col("p_partkey").cast("string").alias("path"), grey.alias("content"), F.lit(12).alias("width"), F.lit(18).alias("height")))
    names = ("width", "height", "aspect_ratio", "background_luma", "ink_luma", "contrast", "skew_deg", "noise_sigma", "ink_ratio", "colorfulness", "is_grayscale", "is_binary", "is_colored_background", "text_line_count", "margin_top_frac", "column_count", "rule_count")
    return out.select(F.col("path").cast("long").alias("p_partkey"), *(_r(F.col(c)).alias(c) for c in names))


_ITEM = rf"{_stripped("regexp_replace(" + _stripped('x') + r", '^(?:\*{0,2}\d+[.)]\*{0,2}|[-*•])\s*', '')")}"


@query(rf"""WITH p AS (SELECT doc_id, CASE WHEN coalesce(starts_with(lower(lang), 'en'), false) THEN list_transform(regexp_split_to_array(text, '\n\s*\n'), lambda g: array_to_string(list_filter(list_transform(string_split(g, chr(10)), lambda x: {_ITEM}), lambda x: x <> ''), ' '))
        ELSE list_transform(string_split(text, chr(10)), lambda x: {_ITEM}) END AS l FROM documents WHERE text IS NOT NULL),
    e AS (SELECT doc_id, unnest(l) AS item, generate_subscripts(l, 1) - 1 AS position FROM p) SELECT doc_id, position::INT AS position, md5(item) AS item_hash FROM e WHERE item <> ''""")
def generated_items(spark: SparkSession, directory: str) -> DataFrame:
    """Paragraphs of English pages, lines of the others, without numbers and bullets."""
    from folioscope.operators import corpus

    docs = table(spark, directory, "documents").where("text is not null")
    out = corpus.response_items(docs, "text", ["doc_id"], F.coalesce(F.lower("lang").startswith("en"), F.lit(False)))
    return out.select("doc_id", "position", F.md5("item").alias("item_hash"))
