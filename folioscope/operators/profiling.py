"""Profiles of record tables: presence, lengths and numbers of fields, and profile specs suggested by measured pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields whose numbers are no measure.
NO_MEASURE = ("seed", "index")
#: Bins and clips of the suggested histograms, the flags, and the sides with the size of an A4 page in mm.
HISTOGRAMS = {"est_dpi_a4": ("dpi", 8, 60, 400), "skew_deg": ("skew_deg", 12, -10, 10)}
FLAGS = {"is_grayscale": "grayscale", "is_binary": "binarize", "is_colored_background": "colored_background"}
A4_MM = {"top": 297, "bottom": 297, "left": 210, "right": 210}
_NUMBERS = ("byte", "short", "integer", "long", "float", "double", "decimal")


def record_profile(df: DataFrame) -> DataFrame:
    """(field, kind, count, least, greatest, mean), in one pass over df and mergeable over its parts.

    kind: presence (values that aren't null), length (of texts in characters, of arrays and maps in members) or number (of
    numeric fields; not of ids, seeds and indexes).  Fields without a value have a presence of 0 and no other row.
    """
    measures: list[tuple[str, str, Column]] = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        measures.append((field.name, "presence", F.when(column.isNotNull(), F.lit(None).cast("double"))))
        if kind == "string":
            measures.append((field.name, "length", F.char_length(column).cast("double")))
        elif kind in ("array", "map"):
            measures.append((field.name, "length", F.when(column.isNotNull(), F.size(column)).cast("double")))
        elif kind in _NUMBERS and not field.name.endswith("_id") and field.name not in NO_MEASURE:
            measures.append((field.name, "number", column.cast("double")))
    sums = []
    for i, (name, kind, value) in enumerate(measures):
        own = F.col(f"`{name}`") if kind == "presence" else value
        sums += [F.count(own).alias(f"n{i}"), F.min(value).alias(f"a{i}"), F.max(value).alias(f"b{i}"), F.avg(value).alias(f"m{i}")]
    wide = df.agg(*sums)
    rows = F.array(*(F.struct(F.lit(n).alias("field"), F.lit(k).alias("kind"), F.col(f"n{i}").alias("count"), F.col(f"a{i}").alias("least"), F.col(f"b{i}").alias("greatest"), F.col(f"m{i}").alias("mean")) for i, (n, k, _) in enumerate(measures)))
    return wide.select(F.inline(rows)).where("count > 0 or kind = 'presence'")


def suggested_specs(stats: DataFrame) -> DataFrame:
    """(spec, bin, low, high, weight, p): histograms of resolution, skew and margins and probabilities of flags, from measured pages.

    A histogram whose values are all equal has one bin of no width.  Specs of columns that stats lacks are left out.
    """
    wanted = {c: v for c, v in HISTOGRAMS.items() if c in stats.columns}
    wanted |= {f"margin_{s}_frac": (f"margins_mm.{s}", 8, 0, 297) for s in A4_MM if f"margin_{s}_frac" in stats.columns}
    if wanted:
        scale = lambda c: A4_MM[c.split("_")[1]] if c.startswith("margin_") else 1
        held = lambda c, low, high: F.when(F.col(c).isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), F.col(c).cast("double") * scale(c))))
        values = F.array(*(F.struct(F.lit(name).alias("spec"), F.lit(bins).alias("bins"), held(c, low, high).alias("v")) for c, (name, bins, low, high) in wanted.items()))
        long = stats.select(F.inline(values)).where("v is not null")
        ends = long.groupBy("spec").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        width = (F.col("hi") - F.col("lo")) / F.col("bins")
        flat = F.col("hi") - F.col("lo") < 1e-6
        place = F.when(flat, 0).otherwise(F.least(F.floor((F.col("v") - F.col("lo")) / width), F.col("bins") - 1)).cast("int")
        counts = long.join(F.broadcast(ends), "spec").groupBy("spec", "bins", "lo", "hi", place.alias("bin")).agg(F.count("*").alias("weight"))  # a row per spec
        edge = lambda k: F.round(F.col("lo") + F.when(flat, 0.0).otherwise(width) * k, 3)
        out = counts.select("spec", "bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"), "weight", F.lit(None).cast("double").alias("p"))
    else:
        out = stats.sparkSession.createDataFrame([], "spec string, bin int, low double, high double, weight long, p double")
    flags = {c: n for c, n in FLAGS.items() if c in stats.columns}
    if flags:
        means = stats.agg(*(F.avg(F.col(c).cast("double")).alias(n) for c, n in flags.items()))
        none = lambda kind: F.lit(None).cast(kind)
        rows = F.array(*(F.struct(F.lit(n).alias("spec"), none("int").alias("bin"), none("double").alias("low"), none("double").alias("high"), none("bigint").alias("weight"), F.round(n, 3).alias("p")) for n in flags.values()))
        out = out.union(means.select(F.inline(rows)).where("p is not null"))
    return out


def marginals(fits: DataFrame, params: str, keys: list[str] = ()) -> DataFrame:
    """(keys, param, value, rows): how often each value of each fitted parameter occurs; nulls are left out."""
    rows = fits.select(*keys, F.explode(params).alias("param", "value")).where("value is not null")
    return rows.groupBy(*keys, "param", "value").agg(F.count("*").alias("rows"))
