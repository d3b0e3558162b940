"""Distribution summaries of metric rows and the gap between two sets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.text import SPACE, SCRIPTS
from folioscope.sources.shared import stored

#: The points at which quantiles are kept.
POINTS = [i / 100 for i in range(101)]


def long_form(df: DataFrame, metrics: list[str], keys: list[str] = ()) -> DataFrame:
    """(keys, metric, value): one row per metric that isn't null; booleans count as 0 and 1."""
    kept = df.select(*keys, *(F.col(m).cast("double").alias(m) for m in metrics))
    return kept.unpivot(list(keys), metrics, "metric", "value").where(F.col("value").isNotNull())


def running_totals(counts: DataFrame, keys: list[str], value: str, totals: list[str]) -> DataFrame:
    """counts, a row per keys and value, with before_<c> for each count c: its sum over the smaller values of the same keys.

    Rows are laid out by range and summed in two steps, so that no task holds a whole group: inside each part, and over the sums of the parts.
    """
    spark = counts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = stored(counts.repartitionByRange(parts, *keys, value).withColumn("_part", F.spark_partition_id()), "laid")
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = laid.groupBy(*keys, "_part").agg(*(F.sum(c).alias(c) for c in totals))
    sums = sums.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"), *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in totals))
    within = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    own = laid.withColumns({f"before_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in totals})
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return own.join(sums, same).select(*counts.columns, *((F.col(f"before_{c}") + F.col(f"_{c}")).alias(f"before_{c}") for c in totals))


def quantiles(values: DataFrame, keys: list[str], value: str, points: list[float] = POINTS) -> DataFrame:
    """(keys, q): exact linear quantiles at the points, from the counts of the different values; no group is held by one task."""
    counts = values.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    total = counts.groupBy(*(F.col(k).alias(f"_t{i}") for i, k in enumerate(keys))).agg(F.sum("_n").alias("_total"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_t{i}"))
    rows = running_totals(counts, keys, value, ["_n"]).join(F.broadcast(total) if not keys else total, same)
    # A point lies between two ranks; each value answers for the points whose ranks it holds, which are few of evenly spaced ones.
    last = len(points) - 1
    span, upto = F.greatest(F.col("_total") - 1, F.lit(1)), F.col("before__n") + F.col("_n")
    even = last > 0 and all(abs(p - i / last) < 1e-12 for i, p in enumerate(points))
    first = F.greatest(F.lit(0), F.floor((F.col("before__n") - 1) / span * last).cast("int") - 1) if even else F.lit(0)
    final = F.least(F.lit(last), F.ceil(upto / span * last).cast("int") + 1) if even else F.lit(last)
    rows = rows.select(*keys, value, F.col("before__n").alias("_b"), "_n", "_total", F.explode(F.sequence(first, final)).alias("i"))
    rows = rows.withColumn("at", F.array(*map(F.lit, points))[F.col("i")] * (F.col("_total") - 1))
    low, high = F.floor("at"), F.ceil("at")
    holds = lambda rank: (rank >= F.col("_b")) & (rank < F.col("_b") + F.col("_n"))
    rows = rows.where(holds(low) | holds(high))
    found = rows.groupBy(*keys, "i").agg(F.max(F.when(holds(low), F.col(value))).alias("lo"), F.max(F.when(holds(high), F.col(value))).alias("hi"), F.max(F.col("at") - low).alias("part"))
    q = F.transform(F.sort_array(F.collect_list(F.struct("i", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("v")))), lambda x: x["v"])
    return found.groupBy(*keys).agg(q.alias("q"))


def summarise(df: DataFrame, metrics: list[str], keys: list[str] = (), quantiles_too: bool = True) -> DataFrame:
    """(keys, metric, count, mean, std, median, p05, p95[, quantiles]) with the population's deviation and exact linear quantiles."""
    own = [*keys, "metric"]
    rows = stored(long_form(df, metrics, keys), "metrics")
    base = rows.groupBy(*own).agg(F.count("*").alias("count"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    points = POINTS if quantiles_too else [0.05, 0.5, 0.95]
    spots = [points.index(p) for p in (0.5, 0.05, 0.95)]
    q = quantiles(rows, own, "value", points).select(*(F.col(k).alias(f"_q{i}") for i, k in enumerate(own)), "q")
    same = F.lit(True)
    for i, k in enumerate(own):
        same &= F.col(k).eqNullSafe(F.col(f"_q{i}"))
    out = base.join(q, same).select(*own, "count", "mean", "std", *(F.col("q")[s].alias(n) for s, n in zip(spots, ("median", "p05", "p95"), strict=True)), F.transform("q", lambda v: F.round(v, 6)).alias("quantiles"))
    return out if quantiles_too else out.drop("quantiles")


def gap(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    """The first Wasserstein distance of each metric that both summaries have, and a verdict.

    It is divided by the reference's spread: p95 - p05, at least a twentieth of the median; 1 for is_* metrics.
    """
    r, c = reference.alias("r"), candidate.alias("c")
    j = r.join(c, F.col("r.metric") == F.col("c.metric"))
    flag = F.col("r.metric").startswith("is_")
    w1 = F.aggregate(F.zip_with("r.quantiles", "c.quantiles", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, v: s + v) / len(POINTS)
    spread = F.when(flag, 1.0).otherwise(F.greatest(F.col("r.p95") - F.col("r.p05"), 0.05 * F.abs(F.col("r.median")), F.lit(1e-6)))
    higher = F.when(flag, F.col("c.mean") > F.col("r.mean")).otherwise(F.col("c.median") > F.col("r.median"))
    out = j.select(
        F.col("r.metric").alias("metric"), F.col("r.median").alias("reference_median"), F.col("c.median").alias("candidate_median"),
        F.col("r.mean").alias("reference_mean"), F.col("c.mean").alias("candidate_mean"), w1.alias("w1"), (w1 / spread).alias("w1_norm"),
        F.when(higher, "higher").otherwise("lower").alias("candidate_is"),
    )
    return out.withColumn("verdict", F.when(F.col("w1_norm") < 0.1, "close").when(F.col("w1_norm") < 0.3, "noticeable").otherwise("different"))


def histogram(df: DataFrame, value: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """(bin, low, high, weight): equal bins from the least to the greatest value, the last one closed; values are clipped to [low, high]."""
    v = F.col(value).cast("double")
    if low is not None:
        v = F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), v))
    rows = df.where(F.col(value).isNotNull()).select(v.alias("v"))
    ends = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") - F.col("lo") < 1e-6, 0).otherwise(F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1)))
    counts = rows.crossJoin(F.broadcast(ends)).groupBy(place.cast("int").alias("bin"), "lo", "hi").agg(F.count("*").alias("weight"))  # ends is one row
    return counts.select("bin", F.round(F.col("lo") + width * F.col("bin"), 3).alias("low"), F.round(F.col("lo") + width * (F.col("bin") + 1), 3).alias("high"), "weight")


def top_symbols(df: DataFrame, text: str, k: int = 20) -> DataFrame:
    """The k most frequent punctuation marks and symbols; ties go to the smaller code point."""
    rest = F.regexp_replace(text, rf"[{SPACE}{''.join(SCRIPTS.values())}\p{{Nd}}]|[^\p{{P}}\p{{S}}\p{{No}}]", "")
    chars = df.select(F.explode(F.split(rest, "")).alias("char")).where("char <> ''")
    return chars.groupBy("char").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "char").limit(k)


def value_shares(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, count, share): how often each value of each field occurs; null and '' aren't counted."""
    rows = df.select(*(F.col(f).cast("string").alias(f) for f in fields)).unpivot([], fields, "field", "value").where("value <> ''")
    counts = rows.groupBy("field", "value").agg(F.count("*").alias("count"))
    return counts.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy("field")))


def average_rank(value: Column | str, keys: list[str] = (), descending: bool = False) -> Column:
    """1-based rank; ties share the mean of their places.  A window over each group: for groups the size of a leaderboard."""
    value = F.col(value) if isinstance(value, str) else value
    order = Window.partitionBy(*keys).orderBy(value.desc() if descending else value.asc())
    return F.rank().over(order) + (F.count("*").over(Window.partitionBy(*keys, value)) - 1) / 2.0


def with_average_rank(df: DataFrame, value: str, name: str, keys: list[str] = (), descending: bool = False) -> DataFrame:
    """df with the average rank of value (null for null), for groups of any size: ranks are taken from the counts of the different values."""
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranks = running_totals(counts.withColumn("_v", -F.col(value)) if descending else counts.withColumn("_v", F.col(value)), keys, "_v", ["_n"])
    ranks = ranks.select(*(F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)), F.col(value).alias("_x"), (F.col("before__n") + (F.col("_n") + 1) / 2.0).alias(name))
    same = F.col(value) == F.col("_x")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return df.join(ranks, same, "left").drop("_x", *(f"_r{i}" for i in range(len(keys))))


def auc(df: DataFrame, score: str, positive: str, keys: list[str] = ()) -> DataFrame:
    """(keys, auc): the Mann-Whitney statistic; 0.5 if a class is empty.

    Ranks come from the counts of the different scores, laid out by range, so no group is held by one task.
    """
    keys = list(keys)
    rows = df.where(F.col(score).isNotNull() & F.col(positive).isNotNull())
    own = rows.groupBy(*keys, score).agg(F.count_if(positive).alias("pos"), F.count_if(~F.col(positive)).alias("neg"))
    won = running_totals(own, keys, score, ["neg"]).withColumn("u", F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0))
    pairs = (F.sum("pos") * F.sum("neg")).cast("double")
    return won.groupBy(*keys).agg(F.coalesce(F.try_divide(F.sum("u"), pairs), F.lit(0.5)).alias("auc"))


#: Most different pairs of scores of which the rank statistics are taken; more raise an error.
MAX_MODELS = 50_000


def rank_statistics(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (n, pearson, spearman, kendall_tau_b, gamma) over the pairs of two columns; 0 where undefined.

    Concordant pairs are counted over the different values with their multiplicities: meant for score tables
    (models, metrics), whose size is that of a leaderboard; more than MAX_MODELS different pairs raise an error.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    ranked = rows.select("x", "y", average_rank("x").alias("rx"), average_rank("y").alias("ry"))
    zero = F.lit(0.0)
    basic = ranked.agg(F.count("*").alias("n"), F.coalesce(F.nanvl(F.corr("x", "y"), zero), zero).alias("pearson"), F.coalesce(F.nanvl(F.corr("rx", "ry"), zero), zero).alias("spearman"))
    cells = rows.groupBy("x", "y").agg(F.count("*").alias("m"))
    if cells.limit(MAX_MODELS + 1).count() > MAX_MODELS:
        raise ValueError(f"rank statistics expect a score table of at most {MAX_MODELS} rows")
    a, b = cells.alias("a"), cells.alias("b")
    pair = a.join(b, F.col("a.x") < F.col("b.x")).select((F.col("a.m") * F.col("b.m")).alias("w"), F.signum(F.col("b.y") - F.col("a.y")).alias("s"))
    signs = pair.agg(F.coalesce(F.sum(F.when(F.col("s") > 0, F.col("w"))), F.lit(0)).alias("c"), F.coalesce(F.sum(F.when(F.col("s") < 0, F.col("w"))), F.lit(0)).alias("d"))
    ties = [cells.groupBy(k).agg(F.sum("m").alias("m")).agg(F.sum(F.col("m") * (F.col("m") - 1) / 2.0).alias(f"t{k}")) for k in ("x", "y")]
    one = basic.crossJoin(signs).crossJoin(ties[0]).crossJoin(ties[1])  # each side is a single row
    n0 = F.col("n") * (F.col("n") - 1) / 2.0
    tau = F.try_divide((F.col("c") - F.col("d")).cast("double"), F.sqrt((n0 - F.col("tx")) * (n0 - F.col("ty"))))
    gamma = F.try_divide((F.col("c") - F.col("d")).cast("double"), (F.col("c") + F.col("d")).cast("double"))
    return one.select("n", "pearson", "spearman", F.coalesce(tau, zero).alias("kendall_tau_b"), F.coalesce(gamma, zero).alias("gamma"))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Intercept and weights of a ridge logistic regression by Newton's method; the intercept is free."""
    a = np.column_stack([np.ones(len(x)), x])
    ridge = np.diag([0.0] + [l2] * x.shape[1])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        bend = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.lstsq((a * bend[:, None]).T @ a + ridge, a.T @ (p - y) + ridge @ w, rcond=None)[0]
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return w


#: Rows of each side on which the discriminator is fitted; all rows are scored.
FIT_ROWS = 20_000


def shared_features(left: DataFrame, right: DataFrame, leave: tuple[str, ...] = ("path", "index", "width", "height")) -> list[str]:
    """Numeric columns that both tables have, without identifiers, by name."""
    kinds = ("byte", "short", "integer", "long", "float", "double", "decimal", "boolean")
    numeric = [{f.name for f in df.schema if f.dataType.typeName() in kinds} for df in (left, right)]
    return sorted((numeric[0] & numeric[1]) - set(leave))


class Discriminator:
    """A linear classifier that tells two sides (a boolean column) apart, with its held-out folds.

    Both sides give equally many rows, at most fit_rows, in the order of a seeded hash; the rows of a hash go to one of
    the folds, in turn on each side, so that the folds have equal shares of the sides.
    """

    def __init__(self, df: DataFrame, side: str, features: list[str], folds: int = 5, l2: float = 1.0, seed: int = 0, fit_rows: int = FIT_ROWS):
        self.features, self.spark = features, df.sparkSession
        rows = df.where(F.col(side).isNotNull()).withColumns({"side": F.col(side), **{f"_f{i}": F.col(f).cast("double") for i, f in enumerate(features)}}).na.drop(subset=[f"_f{i}" for i in range(len(features))])
        self.rows = rows.withColumn("h", F.xxhash64(F.lit(seed), *(f"_f{i}" for i in range(len(features)))))
        least = {r.side: r["count"] for r in rows.groupBy("side").count().collect()}
        take = min(least.get(True, 0), least.get(False, 0), fit_rows)
        own = self.rows.select("side", "h", *(f"_f{i}" for i in range(len(features))))
        sample = own.where("side").orderBy("h").limit(take).union(own.where("not side").orderBy("h").limit(take)).toPandas()  # 2 * fit_rows at most
        folds = max(2, min(folds, take))
        sample["fold"] = sample.groupby("side")["h"].transform(lambda h: pd.factorize(h)[0] % folds) if len(sample) else []
        self.sample, self.models, self.quality = sample, {}, []
        x, y = sample[[f"_f{i}" for i in range(len(features))]].to_numpy(float), sample["side"].to_numpy().astype(float)
        for k in [*range(folds), None]:
            train = (sample["fold"] != k).to_numpy() if k is not None else np.ones(len(sample), bool)
            if len(np.unique(y[train])) < 2:
                continue
            mean, dev = x[train].mean(0), np.where(x[train].std(0) < 1e-8, 1.0, x[train].std(0))
            self.models[k] = (mean, dev, fit_logistic((x[train] - mean) / dev, y[train], l2))
            if k is not None:
                z = self._linear(x[~train], k)
                self.quality.append((k, _area(y[~train] == 1, z), float(np.mean((z > 0) == (y[~train] == 1))) if len(z) else None))

    def _linear(self, x: np.ndarray, k: int | None) -> np.ndarray:
        mean, dev, w = self.models[k]
        return w[0] + (x - mean) / dev @ w[1:]

    def folds(self) -> DataFrame:
        """(fold, auc, accuracy) of the held-out folds."""
        return self.spark.createDataFrame(self.quality, "fold int, auc double, accuracy double")

    def weights(self) -> DataFrame:
        """(feature, coefficient) of the model of all folds, the largest first."""
        last = self.models.get(None)
        return self.spark.createDataFrame([(f, float(c)) for f, c in zip(self.features, last[2][1:] if last else [0.0] * len(self.features), strict=True)], "feature string, coefficient double").orderBy(F.desc(F.abs("coefficient")), "feature")

    def scored(self) -> DataFrame:
        """All rows with their probability of the side and whose it is: rows that were fitted on have that of the fold that held them out."""
        known = self.sample[["side", "h", "fold"]].drop_duplicates(["side", "h"])
        held = self.spark.createDataFrame(known, "side boolean, h long, fold long") if len(known) else self.spark.createDataFrame([], "side boolean, h long, fold long")
        rows = self.rows.join(F.broadcast(held), ["side", "h"], "left")  # 2 * FIT_ROWS rows at most
        z = F.lit(None).cast("double")
        for k, (mean, dev, w) in self.models.items():
            own = F.lit(float(w[0]))
            for i, (m, d, c) in enumerate(zip(mean, dev, w[1:], strict=True)):
                own = own + (F.col(f"_f{i}") - float(m)) / float(d) * float(c)
            z = F.when(F.col("fold").isNull() if k is None else F.col("fold") == k, own).otherwise(z)
        out = rows.withColumn("probability", 1 / (1 + F.exp(-z))).withColumn("source", F.when(F.col("fold").isNull(), "holdout").otherwise("held_out_fold"))
        return out.drop("h", "fold", *(f"_f{i}" for i in range(len(self.features))))

    def top_candidates(self, key: str, shown: int = 20) -> DataFrame:
        """(key, probability, source): the rows of the side that are told apart most surely."""
        return self.scored().where("side").select(key, F.round("probability", 6).alias("probability"), "source").orderBy(F.desc("probability"), key).limit(shown)


def _area(positive: np.ndarray, score: np.ndarray) -> float:
    """Mann-Whitney statistic of a bounded sample; 0.5 if a class is empty."""
    order = np.sort(score[~positive])
    if not positive.any() or not len(order):
        return 0.5
    own = score[positive]
    return float((np.searchsorted(order, own, "left") + np.searchsorted(order, own, "right")).sum() / 2 / len(order) / len(own))


def discriminate(df: DataFrame, side: str, features: list[str], **kw) -> tuple[DataFrame, DataFrame]:
    """((fold, auc, accuracy), (feature, coefficient)) of a Discriminator."""
    made = Discriminator(df, side, features, **kw)
    return made.folds(), made.weights()


def permutation_p(pairs: DataFrame, x: str, y: str, statistic, draws: int = 2000, seed: int = 42) -> float | None:
    """Two-sided probability of a statistic at least as large when y is dealt out anew; None for less than 3 pairs.  For score tables."""
    rows = pairs.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop().limit(MAX_MODELS + 1).toPandas()
    if len(rows) > MAX_MODELS:
        raise ValueError(f"a permutation test expects a score table of at most {MAX_MODELS} rows")
    if len(rows) < 3:
        return None
    rng, own = np.random.default_rng(seed), abs(statistic(rows["x"].tolist(), rows["y"].tolist()))
    hits = sum(abs(statistic(rows["x"].tolist(), rng.permutation(rows["y"]).tolist())) >= own - 1e-12 for _ in range(draws))
    return (hits + 1) / (draws + 1)
