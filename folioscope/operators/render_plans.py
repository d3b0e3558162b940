"""What a page is rendered with: sizes, typography, fonts, styles and templates, drawn from a row's seed as columns."""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators.generation import _pick, spec_value, uniform

#: What the styles add to a base style at random, and the bounds of the sum: low, high, least, most.
STYLES = {
    "legacy": {"margin_top": (-8, 14, 16, None), "margin_bottom": (-8, 14, 16, None), "content_width": (-24, 24, 500, 720), "line_spacing": (-0.08, 0.1, 1.3, 1.7)},
    "balanced": {
        "margin_top": (-16, 24, 16, None), "margin_bottom": (-16, 24, 16, None), "margin_left": (-4, 18, 28, None), "margin_right": (-4, 18, 28, None), "content_width": (-36, 48, 500, 720),
        "line_spacing": (-0.2, 0.25, 1.2, 1.9),
    },
    "diverse": {
        "margin_top": (-24, 36, 16, None), "margin_bottom": (-24, 36, 16, None), "margin_left": (-18, 24, 28, None), "margin_right": (-18, 24, 28, None), "content_width": (-96, 108, 500, 720),
        "line_spacing": (-0.28, 0.35, 1.15, 2.0), "body_font_size": (-2, 3, 12, 18), "code_font_size": (-1, 3, 10, 16), "h1_font_size": (-4, 8, None, 40), "h2_font_size": (-3, 6, None, 34), "h3_font_size": (-2, 5, None, 28),
    },
}
#: By how much a heading is larger than the body at least, and the size of a base style.
ABOVE_BODY = {"h1_font_size": 6, "h2_font_size": 3, "h3_font_size": 1}
BASE = {
    "margin_top": 48, "margin_bottom": 48, "margin_left": 48, "margin_right": 48, "content_width": 640, "line_spacing": 1.5, "body_font_size": 15, "code_font_size": 13, "h1_font_size": 28, "h2_font_size": 22, "h3_font_size": 18,
}


def style(seed: Column, profile: str = "balanced", base: Mapping[str, float] = BASE) -> Column:
    """A struct of sizes: a base style with the profile's random changes, within their bounds."""
    changes, out = STYLES[profile], {}
    for name, start in base.items():
        value = F.lit(start)
        if name in changes:
            low, high, least, most = changes[name]
            u = uniform(seed, f"style/{name}")
            whole = isinstance(low, int) and isinstance(high, int)
            value = value + (F.floor(u * (high - low + 1)) + low if whole else low + (high - low) * u)
            value = value if most is None else F.least(value, F.lit(most))
            value = value if least is None else F.greatest(value, F.lit(least))
            if name in ABOVE_BODY:
                value = F.greatest(value, out["body_font_size"] + ABOVE_BODY[name])
        out[name] = value
    return F.struct(*(v.alias(n) for n, v in out.items()))


def by_family(spec, family: Column, value) -> Column:
    """The spec of a row's family, else the default one, else 1; a spec without families stands for itself."""
    if not (isinstance(spec, Mapping) and "by_family" in spec):
        return value(spec)
    out = None
    for name, own in spec["by_family"].items():
        out = F.when(family == name, value(own)) if out is None else out.when(family == name, value(own))
    other = value(spec.get("default", 1))
    return other if out is None else out.otherwise(other)


def page_plans(rows: DataFrame, page: Mapping, typography: Mapping, seed: str = "sample_seed", family: str | None = None) -> DataFrame:
    """rows with the structs page and typography, each field drawn from its spec; margins_mm has a spec for each side."""
    own = F.col(family) if family else F.lit(None).cast("string")
    fields = []
    for name, spec in page.items():
        if name == "margins_mm" and isinstance(spec, Mapping):
            fields.append(F.struct(*(spec_value(s, F.col(seed), f"page/margins_mm/{side}").cast("double").alias(side) for side, s in spec.items())).alias(name))
        else:
            fields.append(by_family(spec, own, lambda s, n=name: spec_value(s, F.col(seed), f"page/{n}")).alias(name))
    letters = [spec_value(spec, F.col(seed), f"typography/{name}").alias(name) for name, spec in typography.items()]
    out = rows.withColumn("page", F.struct(*fields)) if fields else rows
    return out.withColumn("typography", F.struct(*letters)) if letters else out


def kept_fonts(paths: list[str], exclude: list[str] = ()) -> list[str]:
    """Fonts whose file names hold none of the words; all of them if none would be left."""
    kept = [p for p in paths if not any(word.lower() in p.rsplit("/", 1)[-1].lower() for word in exclude)]
    return kept or list(paths)


def font(seed: Column, paths: list[str], groups: Mapping[str, float], exclude: list[str] = ()) -> Column:
    """A font of a group drawn by weight, a group being the fonts whose file names hold its word; null without a group that has fonts."""
    held = {g: [p for p in kept_fonts(paths, exclude) if g.lower() in p.rsplit("/", 1)[-1].lower()] for g, w in groups.items() if w > 0}
    held = {g: fonts for g, fonts in held.items() if fonts}
    if not held:
        return F.lit(None).cast("string")
    group = _pick(uniform(seed, "font/group"), list(held), [groups[g] for g in held])
    out = None
    for g, fonts in held.items():
        one = F.array(*map(F.lit, fonts))[F.floor(uniform(seed, "font/file") * len(fonts)).cast("int")]
        out = F.when(group == g, one) if out is None else out.when(group == g, one)
    return out


def templates(rows: DataFrame, catalog: DataFrame, mix: Mapping[str, float] | None = None, seed: str = "sample_seed") -> DataFrame:
    """rows with family and template_id drawn from a catalog (template_id, family, weight): the family by the mix, then the template by its weight.

    Without a mix, or with families that the catalog lacks, all templates are drawn by weight.  The catalog is a parameter of a
    run and is held by every task.
    """
    listed = [(r.template_id, r.family, max(float(r.weight or 0), 0.0)) for r in catalog.select("template_id", "family", "weight").orderBy("template_id").limit(10_001).collect()]
    if len(listed) > 10_000 or not listed:
        raise ValueError("a catalog holds 1 to 10,000 templates")
    present = {f for _, f, _ in listed}
    shares = {f: float(w) for f, w in (mix or {}).items() if f in present and w > 0}

    def drawn(own: list[tuple]) -> Column:
        weights = [w for *_, w in own]
        return _pick(uniform(F.col(seed), "template"), [t for t, *_ in own], weights if sum(weights) > 0 else [1.0] * len(own))

    family_of = F.create_map(*(F.lit(x) for t, f, _ in listed for x in (t, f)))
    if shares:
        family = _pick(uniform(F.col(seed), "family"), list(shares), list(shares.values()))
        chosen = None
        for f in shares:
            one = drawn([x for x in listed if x[1] == f])
            chosen = F.when(family == f, one) if chosen is None else chosen.when(family == f, one)
    else:
        chosen = drawn(listed)
    return rows.withColumn("template_id", chosen).withColumn("family", family_of[F.col("template_id")])


#: How much a template's and its family's earlier draws lower a weight, how much a family's lack of its target raises it, and the bounds.
TEMPLATE_SEEN, FAMILY_SEEN, LACK, FIRST_COVER, LEAST_COVER, LEAST_WEIGHT = 0.45, 0.2, 5.0, 1.5, 0.25, 0.01


class TemplateChoice:
    """Templates drawn one after the other, seldom seen ones and families below their target share preferred; a shard has its own."""

    def __init__(self, catalog: list[tuple[str, str, float]], targets: Mapping[str, float] | None = None):
        self.catalog, self.targets = catalog, targets or {}
        self.seen: Counter[str] = Counter()
        self.families: Counter[str] = Counter()

    def weight(self, template: str, family: str, own: float) -> float:
        total, cover = sum(self.families.values()), 1.0
        if family in self.targets:
            lack = self.targets[family] - self.families[family] / total if total else None
            cover = FIRST_COVER if lack is None else max(LEAST_COVER, 1 + LACK * lack)
        tired = (1 + TEMPLATE_SEEN * self.seen[template]) * (1 + FAMILY_SEEN * self.families[family])
        return max(LEAST_WEIGHT, own * cover / tired)

    def draw(self, rng: random.Random) -> str:
        template, family, _ = rng.choices(self.catalog, [self.weight(*t) for t in self.catalog])[0]
        self.seen[template] += 1
        self.families[family] += 1
        return template


def coverage_targets(given) -> dict[str, float]:
    """Target shares from 0 to 1 of families, from a mapping, from pairs, or from text such as "forms=0.3,letters:0.2"; what is no number is left out."""
    if isinstance(given, str):
        given = [part.replace(":", "=", 1).split("=", 1) for part in given.split(",") if part.strip()]
    elif isinstance(given, Mapping):
        given = list(given.items())
    out = {}
    for pair in given or ():
        if isinstance(pair, str):
            out |= coverage_targets(pair)
        elif len(pair) == 2:
            try:
                out[str(pair[0]).strip()] = min(1.0, max(0.0, float(pair[1])))
            except (TypeError, ValueError):
                continue
    return out


def rotated(rows: DataFrame, corpus: DataFrame, item: str, index: str, seed: int = 42) -> DataFrame:
    """rows with an item of the corpus each, in turn by index (from 0); every round through the corpus starts at another place.

    corpus: item with its place, from 0, without gaps.
    """
    n = corpus.count()
    if not n:
        return rows.withColumn(item, F.lit(None).cast(corpus.schema[item].dataType))
    turn = F.floor(F.col(index) / n)
    start = F.when(turn == 0, 0).otherwise(F.pmod(F.xxhash64(F.lit(seed), turn), F.lit(n)))
    return rows.withColumn("_place", F.pmod(F.col(index) + start, F.lit(n))).join(corpus.select(F.col("place").alias("_place"), item), "_place").drop("_place")


def contiguous(items: Column, count: Column | int, seed: Column, name: str = "run") -> Column:
    """A run of ``count`` members of an array, from a drawn place; the whole array if it isn't longer."""
    count = F.lit(count) if isinstance(count, int) else count
    start = F.floor(uniform(seed, name) * (F.size(items) - count + 1)).cast("int") + 1
    return F.when(F.size(items) <= count, items).otherwise(F.slice(items, start, count))
