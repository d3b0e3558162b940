"""Seeded generation of synthetic documents: shard plans, sampling specs, capture plans, pages and novelty."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Mapping
from difflib import SequenceMatcher
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.kernels import writing
from folioscope.operators import tables_generation

#: Width of an A4 page, and the steps from a base seed to that of a sample and of an attempt.
A4_MM, A4_INCH = 210.0, 210.0 / 25.4
SAMPLE_STEP, ATTEMPT_STEP = 1009, 9176
#: Signatures that a new page is compared with, and tries per page.
NOVELTY_WINDOW, ATTEMPTS = 80, 4


def plan_shards(spark: SparkSession, total: int, size: int | None = None, most: int | None = None) -> DataFrame:
    """(shard, start_index, num_samples); one shard if size is null or not positive; none for an empty run."""
    size = size if size and size > 0 else max(total, 1)
    count = math.ceil(max(total, 0) / size)
    rows = spark.range(count if most is None else min(count, most)).withColumnRenamed("id", "shard")
    start = F.col("shard") * size
    return rows.select("shard", start.alias("start_index"), F.least(F.lit(size), F.lit(total) - start).alias("num_samples"))


def sample_seed(base: int | None, index: Column, attempt: Column | int = 0) -> Column:
    """Seed of a sample; null without a base."""
    return F.lit(base).cast("long") + index * SAMPLE_STEP + F.lit(0) + attempt * ATTEMPT_STEP


def uniform(seed: Column, name: str) -> Column:
    """A number in [0, 1) that depends on the seed and the name alone, whatever the partitioning."""
    return F.pmod(F.xxhash64(seed, F.lit(name)), F.lit(1 << 52)) / float(1 << 52)


def _pick(u: Column, values: list, weights: list[float]) -> Column:
    """The value whose share of the weights holds u."""
    total, out = sum(weights), None
    for value, upto in zip(values, accumulate(weights), strict=True):
        hit = u * total < upto
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out.otherwise(F.lit(values[-1]))


def _checked(weights, count: int) -> list[float]:
    weights = [1.0] * count if weights is None else [max(0.0, float(w)) for w in weights]
    if len(weights) != count or sum(weights) <= 0:
        raise ValueError(f"{count} values need as many weights with a positive sum")
    return weights


#: Points of the inverse of a beta distribution between which it is drawn linearly.
BETA_POINTS = 513


def beta_quantiles(a: float, b: float) -> list[float]:
    """The inverse of the distribution function of Beta(a, b) at BETA_POINTS even points, by summing its density over a fine grid."""
    import numpy as np

    if a <= 0 or b <= 0:
        raise ValueError("a beta spec has two positive numbers")
    edge = (1 - np.cos(np.linspace(0, math.pi, 20_001))) / 2  # close to the ends, where the density may rise without bound
    middle, width = (edge[1:] + edge[:-1]) / 2, np.diff(edge)
    logs = (a - 1) * np.log(middle) + (b - 1) * np.log1p(-middle)
    mass = np.concatenate([[0.0], np.cumsum(np.exp(logs - logs.max()) * width)])
    return np.interp(np.linspace(0, 1, BETA_POINTS), mass / mass[-1], edge).tolist()


def spec_value(spec, seed: Column, name: str) -> Column:
    """A sampling spec as a Catalyst column.

    Scalars stand for themselves; [lo, hi] and uniform, normal, lognormal, beta (with range), choices (with weights),
    histogram (bins, weights), p and value are drawn; clip and round follow.  Unknown specs raise.
    """
    if spec is None or isinstance(spec, (bool, str, int, float)):
        return F.lit(spec)
    if isinstance(spec, (list, tuple)):
        if len(spec) != 2 or not all(isinstance(v, (int, float)) for v in spec):
            raise ValueError(f"a list spec has two numbers: {spec!r}")
        spec = {"uniform": spec}
    if not isinstance(spec, Mapping):
        raise ValueError(f"no sampling spec: {spec!r}")
    u, v = uniform(seed, name), uniform(seed, name + "/2")
    bell = F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * v)
    if "p" in spec:
        return u < float(spec["p"])
    if "choices" in spec:
        values = list(spec["choices"])
        return _pick(u, values, _checked(spec.get("weights"), len(values)))
    if "uniform" in spec:
        lo, hi = sorted(map(float, spec["uniform"]))
        out = lo + (hi - lo) * u
    elif "normal" in spec:
        out = float(spec["normal"][0]) + float(spec["normal"][1]) * bell
    elif "lognormal" in spec:
        out = F.exp(float(spec["lognormal"][0]) + float(spec["lognormal"][1]) * bell)
    elif "beta" in spec:
        a, b = map(float, spec["beta"])
        lo, hi = map(float, spec.get("range", (0.0, 1.0)))

        points = F.array(*map(F.lit, beta_quantiles(a, b)))
        at = u * (BETA_POINTS - 1)
        k = F.floor(at).cast("int")
        out = lo + (hi - lo) * (points[k] + (points[k + 1] - points[k]) * (at - k))
    elif "histogram" in spec:
        bins = list(map(float, spec["histogram"].get("bins", [])))
        if len(bins) < 2 or len(spec["histogram"].get("weights", [])) != len(bins) - 1:
            raise ValueError("a histogram has one weight less than edges")
        weights = _checked(spec["histogram"]["weights"], len(bins) - 1)
        k = _pick(u, list(range(len(weights))), weights)
        edges = F.array(*map(F.lit, bins))
        out = edges[k] + (edges[k + 1] - edges[k]) * v
    elif "value" in spec:
        out = F.lit(spec["value"])
    else:
        raise ValueError(f"unknown sampling spec: {sorted(spec)}")
    if spec.get("clip") is not None:
        out = F.least(F.lit(float(spec["clip"][1])), F.greatest(F.lit(float(spec["clip"][0])), out))
    if "round" in spec:
        out = F.bround(out, int(spec["round"]))
        out = out.cast("long") if int(spec["round"]) == 0 else out
    return out


def difficulty(params: Column, dpi: Column) -> Column:
    """easy, medium or hard by the weighted sum of a capture's parameters (a map of strings)."""
    p = lambda k: F.coalesce(params[k].try_cast("double"), F.lit(0.0))
    quality = p("jpeg_quality")
    # The weights of the parameters and the bounds of the classes.
    score = (
        F.least(F.abs(p("skew_deg")) / 2, F.lit(1.5)) + p("perspective") * 20 + p("blur_sigma") * 1.2 + p("noise_sigma") / 6
        + F.when(quality != 0, F.greatest(F.lit(0.0), (85 - quality) / 25)).otherwise(0.0) + F.greatest(F.lit(0.0), (150 - dpi) / 75.0)
        + F.when(F.coalesce(params["binarize"].isin("true", "1"), F.lit(False)), 1.0).otherwise(0.0) + p("shadow_strength") * 2 + p("page_curl") * 30 + p("edge_crop") * 15
    )
    return F.when(score < 1, "easy").when(score < 2.5, "medium").otherwise("hard")


def render_scale(dpi: Column, width_px: Column) -> Column:
    return F.when(width_px > 0, F.greatest(F.lit(0.5), F.least(F.lit(4.0), dpi / (width_px / A4_INCH)))).otherwise(1.0)


def points_to_px(points: Column, width_px: Column) -> Column:
    return F.greatest(F.lit(8), F.bround(points / 72.0 * (width_px / A4_INCH)).cast("int"))


def mm_to_px(mm: Column, width_px: Column) -> Column:
    return F.greatest(F.lit(0), F.bround(mm / A4_MM * width_px).cast("int"))


def capture_plans(samples: DataFrame, channels: Mapping[str, Mapping], seed: str = "sample_seed") -> DataFrame:
    """samples with capture_channel, capture_scenario, target_dpi, degradation_params and visual_difficulty.

    channels: name -> {weight, dpi, degradation: {name: spec}, scenarios: {name: {weight, degradation}}}; a scenario's
    settings win over its channel's.
    """
    s = F.col(seed)
    names = list(channels)
    out = samples.withColumn("capture_channel", _pick(uniform(s, "channel"), names, _checked([channels[n].get("weight", 1) for n in names], len(names))))
    scenario, dpi, params = F.lit(""), F.lit(200), F.create_map().cast("map<string,string>")
    as_map = lambda specs, tag: F.map_from_arrays(F.array(*map(F.lit, specs)), F.array(*(spec_value(v, s, f"{tag}/{k}").cast("string") for k, v in specs.items()))) if specs else F.create_map().cast("map<string,string>")
    for name in names:
        here = F.col("capture_channel") == name
        own = channels[name].get("scenarios") or {}
        if own:
            scenario = F.when(here, _pick(uniform(s, f"{name}/scenario"), list(own), _checked([x.get("weight", 1) for x in own.values()], len(own)))).otherwise(scenario)
        dpi = F.when(here, spec_value(channels[name].get("dpi", 200), s, f"{name}/dpi").cast("int")).otherwise(dpi)
    out = out.withColumn("capture_scenario", scenario).withColumn("target_dpi", dpi)
    for name in names:
        base = channels[name].get("degradation") or {}
        params = F.when(F.col("capture_channel") == name, as_map(base, name)).otherwise(params)
        for label, settings in (channels[name].get("scenarios") or {}).items():
            merged = {**base, **(settings.get("degradation") or {})}
            params = F.when((F.col("capture_channel") == name) & (F.col("capture_scenario") == label), as_map(merged, f"{name}/{label}")).otherwise(params)
    out = out.withColumn("degradation_params", params)
    return out.withColumn("visual_difficulty", difficulty(F.col("degradation_params"), F.col("target_dpi")))


def novelty(signature: str, before: list[str]) -> float:
    """1 less the greatest likeness to the signatures before; 1 if there is none."""
    return 1 - max((SequenceMatcher(None, signature, x).ratio() for x in before), default=0.0)


#: Block kinds with their weights when a page is filled, and the share of tables that are tried with merged cells.
BLOCKS = {"paragraph": 5, "bullet": 2, "numbered": 1, "checklist": 1, "table": 2, "formula": 1, "quote": 1, "code": 1, "command": 0.5, "image": 0.5, "rule": 1}
MERGED = 0.3


def compose_page(rng: random.Random, corpus: list[str], blocks: Mapping[str, float] = BLOCKS, required: tuple[str, ...] = ()) -> tuple[str, list[str]]:
    """A Markdown page of 3 to 6 sections with 1 to 3 blocks each, and its block kinds; required kinds come first."""
    text = lambda n: " ".join(rng.choice(corpus) for _ in range(n))
    sections = rng.randint(3, 6)
    slots = [rng.randint(1, 3) for _ in range(sections)]
    kinds = [*required, *rng.choices(list(blocks), list(blocks.values()), k=max(sum(slots) - len(required), 0))][: sum(slots)]
    rng.shuffle(kinds)
    build = {
        "paragraph": lambda: text(rng.randint(2, 4)),
        "bullet": lambda: "\n".join(f"- {text(1)}" for _ in range(rng.randint(2, 4))),
        "numbered": lambda: "\n".join(f"{i}. {text(1)}" for i in range(1, rng.randint(3, 5))),
        "checklist": lambda: "\n".join(f"- [{rng.choice(' x')}] {text(1)}" for _ in range(rng.randint(2, 4))),
        "table": lambda: _table(rng, corpus),
        "formula": lambda: f"$$\n{writing.merged_scripts(writing.formula(rng))}\n$$",
        "command": lambda: f"```bash\nconvert page_{rng.randint(1, 999)}.png --dpi {rng.choice((150, 200, 300))}\n```",
        "image": lambda: f"![{text(1)[:40]}](img/{rng.randint(1, 999)}.png)",
        "quote": lambda: f"> {text(1)}",
        "code": lambda: f"```\nload('{rng.randint(1, 999)}')\n```",
        "rule": lambda: "---",
    }
    out, at = [f"# {text(1)[:60]}"], 0
    for n, size in enumerate(slots, 1):
        out.append(f"## {n}. {text(1)[:40]}")
        out += [build[k]() for k in kinds[at : at + size]]
        at += size
    return "\n\n".join(out), kinds


def _table(rng: random.Random, words: list[str]) -> str:
    """A table of one of the kinds, with its invariants; plain, or with merged cells where its rows allow it."""
    kind = rng.choice(list(tables_generation.SCHEMAS))
    rows, columns = tables_generation.rows_of(kind, rng.randint(2, 5), rng, words), tables_generation.columns_of(kind, 5)
    if rng.random() < MERGED and (merged := tables_generation.merged_table(kind, rows, columns)):
        return tables_generation.html_table(merged)
    if rng.random() < MERGED and (grouped := tables_generation.grouped_table(kind, rows, columns, rng)):
        return tables_generation.html_table(*grouped)
    return tables_generation.markdown_table(kind, rows, columns)


def generate_pages(spark: SparkSession, total: int, corpus: list[str], seed: int = 42, shard_size: int = 100) -> DataFrame:
    """(shard, sample_index, sample_seed, GT_markdown, block_types, structure_signature, novelty_score, selection_attempt).

    A shard is generated in order, with its own novelty window: a page that is too like one of the last pages is tried
    again, up to ATTEMPTS times.  Every shard depends on its samples' seeds alone, so it can be made again anywhere.
    """
    if not corpus:
        raise ValueError("the corpus is empty")
    shared = spark.sparkContext.broadcast(list(corpus))
    shards = plan_shards(spark, total, shard_size).repartition(max(1, min(math.ceil(total / shard_size), 10_000)), "shard") if total > 0 else plan_shards(spark, 0)

    def signature(page: str) -> str:
        return "|".join(line[:1] or "_" for line in page.split("\n"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for plan in batches:
            for shard in plan.itertuples():
                last: list[str] = []
                out = []
                for index in range(shard.start_index, shard.start_index + shard.num_samples):
                    for attempt in range(ATTEMPTS):
                        own = seed + index * SAMPLE_STEP + attempt * ATTEMPT_STEP
                        page, kinds = compose_page(random.Random(own), shared.value)
                        sign = signature(page)
                        new = novelty(sign, last) if len(last) >= 5 else 1.0
                        if new >= 0.1:
                            break
                    last = [*last, sign][-NOVELTY_WINDOW:]
                    out.append((shard.shard, index, own, page, kinds, sign, new, attempt))
                yield pd.DataFrame(out, columns=names)

    names = ["shard", "sample_index", "sample_seed", "GT_markdown", "block_types", "structure_signature", "novelty_score", "selection_attempt"]
    return shards.mapInPandas(run, "shard long, sample_index long, sample_seed long, GT_markdown string, block_types array<string>, structure_signature string, novelty_score double, selection_attempt int")
