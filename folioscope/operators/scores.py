"""Page scores as DataFrame operators: Arrow batches into the kernels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import distance
from folioscope.kernels import blocks, layout, outputs, tables
from folioscope.operators.evaluation import valid
from folioscope.sources.shared import spread

RATES = ("cer", "wer", "exact", "char_accuracy", "ned")


def page_scores(df: DataFrame, key: str, prediction: str = "prediction", truth: str = "ground_truth", keep: list[str] = ()) -> DataFrame:
    """(key, keep, text_score, table_teds, formula_score, order_score, overall_score) of every row; null texts count as empty.

    Pages that repeat within a batch are scored once.
    """
    own = [f"k{i}" for i in range(len(keep) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[tuple, tuple] = {}
            rows = []
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if pair not in known:
                    known[pair] = blocks.page_scores(*pair)
                rows.append(known[pair])
            columns = list(zip(*rows, strict=True)) or [()] * len(blocks.SCORES)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *(pa.array(c, pa.float64()) for c in columns)], [*own, *blocks.SCORES])

    kinds = [df.schema[c].dataType.simpleString() for c in (key, *keep)]
    out = spread(df.select(df[prediction].alias("p"), df[truth].alias("t"), *(df[c].alias(n) for c, n in zip((key, *keep), own, strict=True))))
    scored = out.mapInArrow(run, ", ".join([*(f"{n} {k}" for n, k in zip(own, kinds, strict=True)), *(f"{s} double" for s in blocks.SCORES)]))
    return scored.toDF(key, *keep, *blocks.SCORES)


def model_scores(df: DataFrame, keys: list[str], key: str) -> DataFrame:
    """(keys, scored, avg_* and std_* of each score) over valid rows."""
    stats = [f(s).alias(f"{n}_{s}") for s in blocks.SCORES for n, f in (("avg", F.avg), ("std", F.stddev_pop))]
    return page_scores(valid(df), key, keep=keys).groupBy(*keys).agg(F.count("*").alias("scored"), *stats)


def page_blocks(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, position, block_type, content) of the blocks of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, rows = [], []
            for i, page in enumerate(batch.column(1).to_pylist()):
                for n, (kind, content) in enumerate(blocks.split(page)):
                    source.append(i)
                    rows.append((n, kind, content))
            n, kind, content = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int64())), pa.array(n, pa.int32()), pa.array(kind, pa.string()), pa.array(content, pa.string())], ["key", "position", "block_type", "content"]
            )

    kind = df.schema[key].dataType.simpleString()
    out = spread(df.select(df[key].alias("key"), df[text].alias("t"))).mapInArrow(run, f"key {kind}, position int, block_type string, content string")
    return out.withColumnRenamed("key", key)


def _kernel(df: DataFrame, key: str, columns: list[str | Column], names: list[str], score) -> DataFrame:
    """(key, names): the numbers that score returns by name for the columns of each row."""
    width = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            args = [batch.column(i + 1).to_pylist() for i in range(width)]
            rows = [score(*x) for x in zip(*args, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[n] for r in rows], pa.float64()) for n in names)], ["key", *names])

    kind = df.schema[key].dataType.simpleString()
    out = spread(df.select(df[key].alias("key"), *((df[c] if isinstance(c, str) else c).alias(f"c{i}") for i, c in enumerate(columns))))
    return out.mapInArrow(run, f"key {kind}, " + ", ".join(f"{n} double" for n in names)).withColumnRenamed("key", key)


def document_scores(df: DataFrame, key: str, prediction: str, truth: str) -> DataFrame:
    """Layout scores of arrays of element structs; null arrays count as empty."""
    names = list(layout.document_scores([], []))
    return _kernel(df, key, [prediction, truth], names, lambda a, b: layout.document_scores(a or [], b or []))


def item_scores(df: DataFrame, key: str, prediction: str, truth: str) -> DataFrame:
    names = list(layout.item_scores([], []))
    return _kernel(df, key, [prediction, truth], names, layout.item_scores)


def error_rates(
    df: DataFrame, key: str, prediction: str = "prediction", truth: str = "ground_truth", normalise: Callable[[Column], Column] | None = None, rates: tuple[str, ...] = RATES
) -> DataFrame:
    """(key, rates) of whole texts, normalised first; bit-parallel, so long texts cost little more than short ones.  Null counts as ''."""
    sides = [df[c] if normalise is None else normalise(df[c]) for c in (prediction, truth)]
    need_cer = bool({"cer", "char_accuracy"} & set(rates))

    def score(guess: str | None, true: str | None) -> dict[str, float]:
        guess, true = guess or "", true or ""
        rate = blocks.cer(true, guess) if need_cer else 0.0
        made = {
            "cer": lambda: rate, "wer": lambda: blocks.wer(true, guess), "exact": lambda: float(guess.strip() == true.strip()),
            "char_accuracy": lambda: max(0.0, 1 - rate), "ned": lambda: layout.ned(guess, true),
        }
        return {r: made[r]() for r in rates}

    return _kernel(df, key, sides, list(rates), score)


def table_scores(df: DataFrame, key: str, prediction: str = "prediction", truth: str = "ground_truth") -> DataFrame:
    """(key, teds, cell scores, row and column detection) of the first table of two texts, whatever form it is written in."""
    return _kernel(df, key, [prediction, truth], list(tables.table_scores("", "")), lambda a, b: tables.table_scores(a or "", b or ""))


def without_furniture(df: DataFrame, text: str, furniture: str) -> DataFrame:
    """df with the column text freed of the lines of the struct furniture (header, footer, page_number); null furniture leaves it."""

    @F.pandas_udf("string")
    def clean(page: pd.Series, *parts: pd.Series) -> pd.Series:
        known: dict[tuple, outputs.Furniture] = {}  # pages of a document share their furniture
        out = []
        for p, given in zip(page, zip(*parts, strict=True), strict=True):
            if p is not None and any(given):
                if given not in known:
                    known[given] = outputs.Furniture(given)
                p = "".join(line for line in p.splitlines(keepends=True) if line not in known[given])
            out.append(p)
        return pd.Series(out, dtype=object)

    fields = [F.col(furniture)[f].cast("string") if f in df.schema[furniture].dataType.names else F.lit(None).cast("string") for f in outputs.FURNITURE]
    return df.withColumn(text, F.when(F.col(furniture).isNotNull(), clean(F.col(text), *fields)).otherwise(F.col(text)))


#: The categories of fields of receipts, forms and cards.
CATEGORIES = {
    "header": ("company", "address", "date", "time", "receipt_number", "invoice_number"),
    "customer": ("customer_name", "customer_address", "name", "phone", "email"),
    "total": ("subtotal", "tax", "total", "discount"),
    "payment": ("payment_method", "card_number"),
    "personal": ("name", "phone", "email", "address"),
    "organization": ("company", "department", "position"),
}


def entity_fields(df: DataFrame, key: str, prediction: str, truth: str) -> DataFrame:
    """(k, field, in_p, in_t, ned, accuracy): the fields of both maps with the distance of their values; a value that one side lacks is ''."""
    sides = [df.select(F.col(key).alias("k"), F.explode(F.map_entries(c)).alias("e")).select("k", F.col("e.key").alias("field"), F.col("e.value").cast("string").alias(n)) for c, n in ((prediction, "p"), (truth, "t"))]
    j = sides[0].withColumn("in_p", F.lit(True)).join(sides[1].withColumn("in_t", F.lit(True)), ["k", "field"], "full")
    d = distance.ned(F.coalesce("p", F.lit("")), F.coalesce("t", F.lit("")))
    return j.select("k", "field", F.coalesce("in_p", F.lit(False)).alias("in_p"), F.coalesce("in_t", F.lit(False)).alias("in_t"), d.alias("ned"), (1 - d).alias("accuracy"))


def _entity_sums(groups, most: float) -> DataFrame:
    hit = (F.col("ned") <= most) & F.col("in_t")
    return groups.agg(F.count_if("in_p").alias("np"), F.count_if("in_t").alias("nt"), F.count_if(hit & F.col("in_p")).alias("hp"), F.count_if(hit).alias("ht"), F.sum(F.when(F.col("in_t"), F.col("ned"))).alias("d"))


def entity_scores(df: DataFrame, key: str, prediction: str, truth: str, most: float = 0.3) -> DataFrame:
    """(key, precision, recall, f1, avg_ned, avg_accuracy) of two maps: a full outer join of their entries by field."""
    sums = _entity_sums(entity_fields(df, key, prediction, truth).groupBy("k"), most)
    all_rows = df.select(F.col(key).alias("k")).join(sums, "k", "left").fillna(0, ["np", "nt", "hp", "ht"]).fillna(0.0, ["d"])
    empty = F.col("nt") == 0
    p = F.when(empty, (F.col("np") == 0).cast("double")).otherwise(F.coalesce(F.try_divide(F.col("hp").cast("double"), F.col("np")), F.lit(0.0)))
    r = F.when(empty, 1.0).otherwise(F.col("ht") / F.col("nt"))
    out = all_rows.select(F.col("k").alias(key), p.alias("precision"), r.alias("recall"), F.when(empty, 0.0).otherwise(F.col("d") / F.col("nt")).alias("avg_ned"), empty.alias("e"))
    f1 = F.when(F.col("e"), F.col("precision")).otherwise(distance.f1(F.col("precision"), F.col("recall")))
    return out.select(key, "precision", "recall", f1.alias("f1"), "avg_ned", F.when(F.col("e"), F.col("precision")).otherwise(1 - F.col("avg_ned")).alias("avg_accuracy"))


def category_scores(df: DataFrame, key: str, prediction: str, truth: str, categories: dict[str, tuple[str, ...]] = CATEGORIES, most: float = 0.3) -> DataFrame:
    """(key, category, precision, recall, f1, accuracy, field_count) over the true fields of each category; a field may be in several."""
    listed = df.sparkSession.createDataFrame([(f, c) for c, fields in categories.items() for f in fields], "field string, category string")
    fields = entity_fields(df, key, prediction, truth).where("in_t").join(F.broadcast(listed), "field")  # the listed fields are a parameter
    sums = _entity_sums(fields.groupBy("k", "category"), most)
    p = r = F.col("ht") / F.col("nt")  # a field that isn't predicted counts as predicted empty
    return sums.select(F.col("k").alias(key), "category", p.alias("precision"), r.alias("recall"), distance.f1(p, r).alias("f1"), (1 - F.col("d") / F.col("nt")).alias("accuracy"), F.col("nt").alias("field_count"))


def entity_summary(scored: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Means, and deviations of F1 and accuracy, of entity scores over samples; avg_item_f1 and avg_overall_f1 with item_f1 (null where a sample has no items)."""
    stats = [F.count("*").alias("samples"), F.avg("f1").alias("avg_entity_f1"), F.stddev_pop("f1").alias("std_entity_f1"), F.avg("precision").alias("avg_entity_precision"), F.avg("recall").alias("avg_entity_recall"),
             F.avg("avg_accuracy").alias("avg_entity_accuracy"), F.stddev_pop("avg_accuracy").alias("std_entity_accuracy")]
    whole = F.col("f1")
    if "item_f1" in scored.columns:
        whole = F.coalesce((F.col("f1") + F.col("item_f1")) / 2, F.col("f1"))
        stats += [F.avg("item_f1").alias("avg_item_f1"), F.stddev_pop("item_f1").alias("std_item_f1")]
    return scored.groupBy(*keys).agg(*stats, F.avg(whole).alias("avg_overall_f1"), F.stddev_pop(whole).alias("std_overall_f1"))


def field_accuracy(df: DataFrame, key: str, prediction: str, truth: str) -> DataFrame:
    """(field, avg_accuracy, sample_count) of the true fields over all samples."""
    return entity_fields(df, key, prediction, truth).where("in_t").groupBy("field").agg(F.avg("accuracy").alias("avg_accuracy"), F.count("*").alias("sample_count"))


def metric_table(scored: DataFrame, metrics: list[str], keys: list[str] = ()) -> DataFrame:
    """(keys, metric, mean, std, min, max) of score columns; null and NaN are left out."""
    values = scored.select(*keys, *(F.nullif(F.col(m).cast("double"), F.lit(float("nan"))).alias(m) for m in metrics)).unpivot(list(keys), metrics, "metric", "v").where("v is not null")
    return values.groupBy(*keys, "metric").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))


def reading_orders(df: DataFrame, key: str, prediction: str, truth: str) -> DataFrame:
    """(key, kendall_tau, spearman_rho, order_accuracy) of two arrays of reading orders."""
    number = lambda values: [{"reading_order": v} for v in values or []]
    return _kernel(df, key, [prediction, truth], list(layout.reading_order([], [])), lambda a, b: layout.reading_order(number(a), number(b)))
