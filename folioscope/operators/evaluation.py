"""Results of runs: filters, joins with ground truth, run summaries, resume logic and leaderboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.text import is_empty, language_of, model_key

#: Metrics of which less is better.
LOWER_IS_BETTER = ("avg_cer", "avg_wer", "avg_formula_edit_distance")
#: Messages of a batch without an answer.
NO_RESPONSE, BLANK_RESPONSE = "Missing batch response", "Empty prediction in batch response"


def succeeded(error: Column) -> Column:
    """No error: null, empty, or the word None."""
    return F.coalesce(F.trim(error).isin("", "None"), F.lit(True))


def first_delivery(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def valid(df: DataFrame, prediction: str = "prediction", error: str = "error") -> DataFrame:
    """Rows that are scored: no error and a prediction that isn't blank."""
    return df.where(succeeded(F.col(error)) & ~is_empty(F.col(prediction)))


def run_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, total_samples, successful, failed, avg_latency_ms, empty_count, empty_rate) over all rows."""
    ok, blank = succeeded(F.col("error")), is_empty(F.col("prediction"))
    out = df.groupBy(*keys).agg(
        F.count("*").alias("total_samples"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"),
        F.avg("latency_ms").alias("avg_latency_ms"), F.count_if(blank).alias("empty_count"),
    )
    return out.withColumn("empty_rate", F.col("empty_count") / F.col("total_samples"))


def remaining(all_rows: DataFrame, completed: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that aren't completed yet."""
    return all_rows.select(*keys).distinct().join(completed.select(*keys), keys, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both by key; the new row wins."""
    both = old.withColumn("_p", F.lit(1)).unionByName(new.withColumn("_p", F.lit(0)))
    return first_delivery(both, keys, [F.col("_p")]).drop("_p")


def batch_results(expected: DataFrame, answers: DataFrame, errors: DataFrame, key: str) -> DataFrame:
    """(key, prediction, error) of every expected key: an error report wins, then a missing answer, then a blank one."""
    j = expected.select(key).join(answers.select(key, F.col("prediction").alias("_a"), F.lit(True).alias("_has")), key, "left")
    j = j.join(errors.select(key, F.col("error").alias("_e")), key, "left")
    error = F.coalesce("_e", F.when(F.col("_has").isNull(), NO_RESPONSE), F.when(is_empty(F.col("_a")), BLANK_RESPONSE))
    return j.select(key, F.when(error.isNull(), F.col("_a")).otherwise("").alias("prediction"), error.alias("error"))


def latest(df: DataFrame, model: str = "model_id", path: str = "report_path", at: str = "run_at") -> DataFrame:
    """The last report of each model and language; equal times go to the later path."""
    rows = df.withColumn("language", F.lower(language_of(F.col("lang_code"), F.col("dataset_id"))))
    rows = rows.withColumn(model, F.coalesce(F.nullif(F.trim(model), F.lit("")), F.element_at(F.split(path, "/"), -2)))
    return first_delivery(rows, [model, "language"], [F.col(at).desc_nulls_last(), F.col(path).desc()])


def ranked(df: DataFrame, metric: Column, name: str, keys: list[str] = ("language",), model: str = "model_id") -> DataFrame:
    """df with rank: the best first, no value last, ties by model."""
    value = metric if name in LOWER_IS_BETTER else -metric
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(value.asc_nulls_last(), model)))


def compare(df: DataFrame) -> DataFrame:
    """df with success_rate: 0 where nothing was run."""
    return df.withColumn("success_rate", F.coalesce(F.try_divide(F.col("successful").cast("double"), F.col("total_samples")), F.lit(0.0)))


def best(df: DataFrame, keys: list[str], metric: Column, model: str = "model_id", lower_is_better: bool = False) -> DataFrame:
    """(keys, best_model, best_value): ties go to the smaller model name."""
    value = metric if lower_is_better else -metric
    pick = F.min(F.when(metric.isNotNull(), F.struct(value.alias("v"), F.col(model).alias("m"))))
    out = df.groupBy(*keys).agg(pick.alias("b"))
    return out.select(*keys, F.col("b.m").alias("best_model"), (F.col("b.v") if lower_is_better else -F.col("b.v")).alias("best_value"))


def match_models(synthetic: DataFrame, real: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(match_key, synthetic_model, synthetic_score, real_model, real_score): a full outer join by normalised name.

    Rows with one side null are the unmatched models; a key that two names of one side share raises when read.
    """
    sides = []
    for side, df in (("synthetic", synthetic), ("real", real)):
        rows = df.select(model_key(F.col("model")).alias("k"), F.col("model").alias(f"{side}_model"), F.col("score").cast("double").alias(f"{side}_score"))
        if aliases is not None:
            to = aliases.select(model_key(F.col("alias")).alias("k"), model_key(F.col("canonical")).alias("c")).dropDuplicates(["k"])
            rows = rows.join(to, "k", "left").withColumn("k", F.coalesce("c", "k")).drop("c")
        clash = F.countDistinct(f"{side}_model") > 1
        rows = rows.groupBy("k").agg(
            F.when(clash, F.raise_error(F.concat(F.lit(f"several {side} models share the key "), F.col("k"))).cast("string")).otherwise(F.min(f"{side}_model")).alias(f"{side}_model"),
            F.max(f"{side}_score").alias(f"{side}_score"),
        )
        sides.append(rows)
    return sides[0].join(sides[1], "k", "full").withColumnRenamed("k", "match_key")


#: Metrics by which models are compared, the first that a run has; the fields that name a run; the error of a sample that stayed empty.
MAIN_METRICS = ("avg_markdown_overall_score", "avg_markdown_text_score", "avg_markdown_table_teds", "avg_markdown_formula_score", "avg_markdown_order_score")
CONTEXT = ("dataset_id", "split", "model_id", "backend")
STILL_EMPTY = "Empty prediction after retries"


def main_metric(metrics: Column) -> Column:
    """Name of the metric of a map by which a run is judged: a preferred one, else the first avg_ in order of names, else the first."""
    names = F.array_sort(F.map_keys(metrics))
    preferred = F.filter(F.array(*map(F.lit, MAIN_METRICS)), lambda m: F.array_contains(names, m))
    averages = F.filter(names, lambda m: m.startswith("avg_"))
    return F.coalesce(*(F.try_element_at(c, F.lit(1)) for c in (preferred, averages, names)))


def normal_metric(name: Column, value: Column) -> Column:
    """A metric as a number from 0 to 1 of which more is better; null for null and NaN."""
    value = F.nanvl(value, F.lit(None).cast("double"))
    better = F.when(name.isin("avg_cer", "avg_wer"), 1 - value).otherwise(value)
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), better)))


def metric_keys(runs: DataFrame, keys: list[str], metrics: str = "metrics") -> DataFrame:
    """(keys, metric_keys): the sorted names of all metrics of the runs of each group."""
    return runs.select(*keys, F.explode(F.map_keys(metrics)).alias("m")).groupBy(*keys).agg(F.sort_array(F.collect_set("m")).alias("metric_keys"))


def first_samples(df: DataFrame, index: str, most: int | None = None) -> DataFrame:
    """Samples in the order of their index, at most ``most`` of them (the run's own limit)."""
    rows = df.orderBy(index)
    return rows if most is None else rows.limit(most)


def first_errors(df: DataFrame, keys: list[str], index: str, shown: int = 10, error: str = "error") -> DataFrame:
    """The first failed samples of each run, as its report shows them."""
    failed = df.where(~succeeded(F.col(error)))
    return failed.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(index))).where(F.col("_r") <= shown).drop("_r")


def after_retries(df: DataFrame, prediction: str = "prediction", error: str = "error") -> DataFrame:
    """df with an error for samples whose prediction stayed blank; predictions as text, null as ''."""
    text = F.coalesce(F.col(prediction).cast("string"), F.lit(""))
    return df.withColumns({prediction: text, error: F.when(succeeded(F.col(error)) & is_empty(text), F.lit(STILL_EMPTY)).otherwise(F.col(error))})


def checkpoint(spark, path: str, context: dict[str, str] | None = None, index: str = "sample_index") -> DataFrame:
    """Results of a checkpoint folder (Parquet, with the CONTEXT fields as columns), the later delivery of a sample first taken.

    A context that differs from the rows' raises: a run must not be scored on another run's results.
    """
    rows = spark.read.parquet(path)
    named = [c for c in CONTEXT if c in rows.columns]
    if context is not None and named:
        wrong = rows.select(*named).distinct().where(~F.coalesce(F.expr(" AND ".join(f"`{c}` <=> '{str(context.get(c, '')).replace(chr(39), chr(39) * 2)}'" for c in named)), F.lit(False))).limit(1).collect()
        if wrong:
            raise ValueError(f"the checkpoint at {path} belongs to another run: {wrong[0].asDict()}, not {context}")
    order = [F.col("received_at").desc_nulls_last()] if "received_at" in rows.columns else [F.lit(0)]
    return first_delivery(rows, [*named, index], order)


def leaderboard_scores(board: DataFrame, metric: str | None = None, language: str | None = None) -> DataFrame:
    """(model, score) of leaderboard rows (language, model_id, score[, metric_key]), the last of a model in the order of its languages."""
    rows = board if language is None else board.where(F.lower("language") == language.lower())
    if metric is not None and "metric_key" in board.columns:
        rows = rows.where(F.col("metric_key") == metric)
    last = F.max_by("score", "language")
    return rows.where("score is not null").groupBy(F.col("model_id").alias("model")).agg(last.alias("score"))


def summary_entries(latest_runs: DataFrame) -> DataFrame:
    """A flat row of each run: model, language, data set, its main metric, and that metric from 0 to 1."""
    name = main_metric(F.col("metrics"))
    rows = latest_runs.withColumn("metric_key", name).withColumn("metric_value", F.col("metrics")[F.col("metric_key")])
    return rows.select("model_id", "language", "dataset_id", "metric_key", "metric_value", normal_metric(F.col("metric_key"), F.col("metric_value")).alias("normalized"), "total_samples", "empty_rate")


def bootstrap_interval(pairs: DataFrame, x: str, y: str, statistic, draws: int = 2000, confidence: float = 0.95, seed: int = 42) -> DataFrame:
    """(low, high) of statistic(x, y) over resamples of the pairs, drawn in parallel; null with fewer than 2 pairs.

    The pairs are a matched score table (a row per model): they are sent to every draw.
    """
    import numpy as np
    import pandas as pd

    rows = pairs.select(F.col(x).cast("double"), F.col(y).cast("double")).na.drop().limit(100_001).toPandas()
    if len(rows) > 100_000:
        raise ValueError("a bootstrap over models expects a score table")
    a, b = rows.iloc[:, 0].to_numpy(), rows.iloc[:, 1].to_numpy()
    spark = pairs.sparkSession

    def run(batches):
        for pdf in batches:
            out = []
            for draw in pdf["id"]:
                at = np.random.default_rng([seed, int(draw)]).integers(0, len(a), len(a))
                out.append(float(statistic(a[at], b[at])))
            yield pd.DataFrame({"v": out})

    if len(a) < 2:
        return spark.range(1).select(F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))
    tail = (1 - confidence) / 2
    drawn = spark.range(draws).mapInPandas(run, "v double").where(~F.isnan("v"))
    return drawn.agg(F.percentile("v", tail).alias("low"), F.percentile("v", 1 - tail).alias("high"))
