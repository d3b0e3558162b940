"""Corpus building: parsing, first-seen deduplication, set operations, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.text import item_text, sentences, strip, wiki_clean

#: Signs of wiki tables, templates, links and signatures.
DEBRIS = r"style=|colspan|rowspan|class=|\{\{|\}\}|\[\[|\]\]|https?://|\(KST\)|\(UTC\)|\(토론\)|--\s*\S+\s*\("


def first_seen(df: DataFrame, item: str, position: list[str]) -> DataFrame:
    """(item, first): the different items with their first position; order by first for the order of appearance."""
    return df.where(F.col(item).isNotNull()).groupBy(item).agg(F.min(F.struct(*position)).alias("first"))


def wiki_parts(lines: DataFrame, line: str, position: str, least: int = 60, most: int = 700) -> DataFrame:
    """(kind, item, first): titles (2 to 40 characters, no name space) and paragraphs without debris, at their first place."""
    t = strip(F.col(line))
    head = F.regexp_extract(t, r"^\s*=+\s*(.*?)\s*=+\s*$", 1)
    rows = lines.where(t != "").select(F.when(t.rlike(r"^\s*=+\s*.*?\s*=+\s*$"), "title").otherwise("paragraph").alias("kind"), head.alias("h"), t.alias("t"), F.col(position).alias("position"))
    raw = F.when(F.col("kind") == "title", F.replace("h", F.lit("="), F.lit(" "))).otherwise(F.col("t"))
    # The explode of one value keeps the optimiser from copying the patterns into every filter.
    rows = rows.select("kind", "position", F.explode(F.array(wiki_clean(raw))).alias("item"))
    size = F.char_length("item")
    letters = size - F.char_length(F.regexp_replace("item", r"\p{L}", ""))
    title = (F.col("kind") == "title") & ~F.col("item").rlike(r"^[^\s:]{1,12}:") & size.between(2, 40)
    body = (F.col("kind") == "paragraph") & size.between(least, most) & ~F.col("item").rlike(DEBRIS) & (letters >= size * 0.5)
    return rows.where(title | body).groupBy("kind", "item").agg(F.min("position").alias("first"))


def sentence_items(df: DataFrame, text: str, keys: list[str], least: int = 10, most: int = 100) -> DataFrame:
    """(keys, position, sentence): sentences of more than least and fewer than most characters."""
    rows = df.select(*keys, F.posexplode(sentences(F.col(text))).alias("position", "sentence"))
    return rows.where((F.char_length("sentence") > least) & (F.char_length("sentence") < most))


def response_items(df: DataFrame, response: str, keys: list[str], paragraphs: Column) -> DataFrame:
    """(keys, position, item): paragraphs of a response (blank-line groups, joined) or its lines, without numbers and bullets."""
    groups = F.transform(F.split(response, r"\n\s*\n"), lambda g: F.array_join(F.filter(F.transform(F.split(g, "\n"), item_text), lambda x: x != ""), " "))
    lines = F.transform(F.split(response, "\n"), item_text)
    rows = df.select(*keys, F.posexplode(F.when(paragraphs, groups).otherwise(lines)).alias("position", "item"))
    return rows.where("item <> ''")


def merged(old: DataFrame, new: DataFrame, item: str) -> DataFrame:
    """The different items of both, without blanks at their ends."""
    clean = lambda df: df.select(strip(F.col(item)).alias(item)).where(f"{item} <> ''")
    return clean(old).union(clean(new)).distinct()


def common(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Different keys that both sides hold; null is a key."""
    return left.select(*keys).intersect(right.select(*keys))


def without(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Different keys of left that right doesn't hold; null is a key."""
    return left.select(*keys).subtract(right.select(*keys))


def symmetric_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): keys of one side alone."""
    a = left.select(key).distinct().withColumn("_a", F.lit(True))
    b = right.select(key).distinct().withColumn("_b", F.lit(True))
    j = a.join(b, key, "full").where(F.col("_a").isNull() | F.col("_b").isNull())
    return j.select(key, F.when(F.col("_a"), "left").otherwise("right").alias("side"))


def split_rows(df: DataFrame, key: str, test_share: float = 0.1, seed: int = 42) -> DataFrame:
    """df with split: 'test' for about the share of the keys, by hash; the same key always falls on the same side."""
    place = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) / 1e6
    return df.withColumn("split", F.when(place < test_share, "test").otherwise("train"))


def runs(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """(keys, value, start, rows): runs of equal values in order (gaps and islands)."""
    whole = Window.partitionBy(*keys).orderBy(*order)
    same = Window.partitionBy(*keys, value).orderBy(*order)
    island = df.withColumn("_i", F.row_number().over(whole) - F.row_number().over(same)).withColumn("_n", F.row_number().over(whole))
    return island.groupBy(*keys, value, "_i").agg(F.min("_n").alias("start"), F.count("*").alias("rows")).drop("_i")


def valid_characters(df: DataFrame, text: str) -> DataFrame:
    """(char, count) of the characters that are seen: no blanks, no control, format, private or unassigned ones."""
    shown = F.regexp_replace(text, r"[\p{C}\p{Z}\s]", "")
    return df.select(F.explode(F.split(shown, "")).alias("char")).where("char <> ''").groupBy("char").agg(F.count("*").alias("count"))
