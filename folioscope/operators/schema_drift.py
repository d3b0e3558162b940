"""JSON records whose layout drifts from file to file (problem 4).

Every file is read as rows of (path, raw JSON type, value), JVM-side, through
variants, to whatever depth its values nest.  Types and shapes of values are counted by
file and path, and each file becomes one row: a map of its fields.  The maps of consecutive
files of a stream are compared; and all entries are projected onto one typed table,
with the casts that failed listed.

A rename is a pair of a field that ends and one that begins between the same two
files with the same information: their names are the same words, or the values of
the two keys, over the whole table, have the same distribution of shapes.  Of competing
pairs the better one is taken first, until no pair of free fields is left.

Defined results: files delivered again under another id count once (the least id);
payloads that are no JSON, null or empty have no fields and are listed as broken;
a file without a predecessor has no changes; null values have no type, so a field
of nulls alone is never retyped; rows without a stream or a number have no changes.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.sources.shared import stored

#: Least similarity of two keys' values for a rename, and how much equal words of the names add to it.
SAME_VALUES = 0.6
NAME_WEIGHT = 0.5
#: Most distinct field names for which the names' links are resolved on the driver.
MAX_FIELDS = 10_000

KINDS = {"STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def json_type(value: Column) -> Column:
    """JSON type of a variant: string, number, boolean, array, object or null."""
    kind = F.schema_of_variant(value)
    out = F.when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object")
    for name, label in KINDS.items():
        out = out.when(kind == name, label)
    return out.otherwise("number")


def _files(df: DataFrame, stream: str, number: str, payload: str, file_id: str) -> DataFrame:
    """One row per (stream, number): the payload of the least id, as an array of entries."""
    rows = df.select(df[stream].alias("stream"), df[number].cast("int").alias("no"), df[file_id].alias("id"), df[payload].alias("payload"))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "payload"))
    # Parsing costs far more than the rows' bytes tell: a stated number of partitions keeps them from being merged into a few tasks.
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = rows.repartition(parts, "stream", "no").groupBy("stream", "no").agg(first.alias("f")).select("stream", "no", "f.payload")
    body = F.trim(F.regexp_replace("payload", r"^[\s﻿]+", ""))
    return rows.select("stream", "no", F.try_parse_json(F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)).alias("v"))


def _explode(df: DataFrame, column: str) -> DataFrame:
    """df with pos, key and value of the members of a variant; none for scalars."""
    return df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(column).outer()))


def _fields(files: DataFrame) -> DataFrame:
    """(stream, no, entry, field, kind, value) of the top-level fields of every entry."""
    entries = _explode(files, "v").select("stream", "no", F.col("pos").alias("entry"), F.col("value").alias("e"))
    entries = entries.where(json_type(F.col("e")) == "object")
    fields = _explode(entries, "e").select("stream", "no", "entry", F.col("key").alias("field"), "value")
    return fields.withColumn("kind", json_type(F.col("value")))


def _stored_fields(df: DataFrame, stream: str, number: str, payload: str, file_id: str) -> DataFrame:
    """(stream, no, entry, field, kind, text), parsed once."""
    fields = _fields(_files(df, stream, number, payload, file_id))
    text = F.when(F.col("kind").isin("array", "object"), F.to_json("value")).otherwise(F.col("value").cast("string"))
    return stored(fields.select("stream", "no", "entry", "field", "kind", text.alias("text")), "fields")


def _nesting(text: Column) -> Column:
    """How many containers lie within each other in a JSON text; strings don't count."""
    brackets = F.regexp_replace(F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(a: Column, c: Column) -> Column:
        now = a["now"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(a["most"], now).alias("most"))

    return F.aggregate(F.split(brackets, ""), start, step)["most"]


def _deepest(df: DataFrame, text: Column) -> int:
    return df.agg(F.max(_nesting(text))).first()[0] or 0


def path_values(
    df: DataFrame, stream: str = "stream_name", number: str = "file_no", payload: str = "payload", file_id: str = "file_id", depth: int | None = None
) -> DataFrame:
    """(stream, no, entry, path, kind, text): members of objects join the path with '.', those of arrays with '[]'; depth bounds the levels, by default to all there are."""
    fields = _fields(_files(df, stream, number, payload, file_id))
    if depth is None:
        depth = 1 + _deepest(fields.where("kind in ('array', 'object')"), F.to_json("value"))
    level = fields.withColumnRenamed("field", "path")
    out = level.select("stream", "no", "entry", "path", "kind", F.col("value").cast("string").alias("text"))
    for _ in range(depth - 1):
        below = _explode(level.where("kind in ('array', 'object')").withColumnRenamed("value", "up"), "up")
        name = F.when(F.col("key").isNull(), F.concat("path", F.lit("[]"))).otherwise(F.concat("path", F.lit("."), "key"))
        level = below.select("stream", "no", "entry", name.alias("path"), "value").withColumn("kind", json_type(F.col("value")))
        out = out.union(level.select("stream", "no", "entry", "path", "kind", F.col("value").cast("string").alias("text")))
    return out


def type_statistics(df: DataFrame, **kw) -> DataFrame:
    """(stream, no, path, kind, entries): how often each path has each type in each file."""
    return path_values(df, **kw).groupBy("stream", "no", "path", "kind").agg(F.countDistinct("entry").alias("entries"))


def _shape(text: Column) -> Column:
    """What kind of value a leaf is: itself for short names, a mask for codes, a range for numbers."""
    number = text.try_cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) >= 2)
    scale = F.when(whole & (F.abs(number) <= 1000), F.concat(F.lit("="), number.cast("bigint").cast("string")))
    scale = scale.when(F.abs(number) > 1, F.concat(F.lit("10^"), F.floor(F.log10(F.abs(number))).cast("string"), F.when(whole, "i").otherwise("f")))
    scale = scale.otherwise(F.concat(F.lit("<"), F.ceil(number * 4).cast("string")))
    mask = F.regexp_replace(F.regexp_replace(text, r"\d+", "9"), r"\p{L}+", "a")
    word = F.when(text.rlike(r"\S\s+\S+\s"), "text").when(text.rlike(r"\d") | (F.length(text) > 40), F.concat(F.lit("~"), F.when(F.length(mask) <= 60, mask).otherwise(F.md5(mask)))).otherwise(text)
    return F.when(number.isNotNull(), scale).otherwise(word)


def _words(name: Column) -> Column:
    """The words of a field name in snake or camel case."""
    split = F.regexp_replace(F.regexp_replace(name, r"([\p{Ll}\d])(\p{Lu})", "$1_$2"), r"[^\p{L}\d]+", "_")
    return F.array_distinct(F.filter(F.split(F.lower(split), "_"), lambda w: w != ""))


def _leaves(fields: DataFrame) -> DataFrame:
    """(stream, no, field, text) of the values inside arrays and objects, at any depth."""
    inner = fields.where("kind in ('array', 'object')")
    depth = _deepest(inner, F.col("text"))
    level, out = inner.select("stream", "no", "field", F.try_parse_json("text").alias("up")), None
    for _ in range(depth):
        below = _explode(level, "up").select("stream", "no", "field", "value").withColumn("kind", json_type(F.col("value")))
        ends = below.where(~F.col("kind").isin("array", "object", "null")).select("stream", "no", "field", F.col("value").cast("string").alias("text"))
        out = ends if out is None else out.union(ends)
        level = below.where(F.col("kind").isin("array", "object")).select("stream", "no", "field", F.col("value").alias("up"))
    return inner.limit(0).select("stream", "no", "field", "text") if out is None else out


def schema_changes(
    df: DataFrame, stream: str = "stream_name", number: str = "file_no", payload: str = "payload", file_id: str = "file_id"
) -> DataFrame:
    """(stream, number, field_name, change_kind, new_name, old_types, new_types): changes against the file before."""
    return _changes(df, _stored_fields(df, stream, number, payload, file_id), stream, number)


def _statistics(df: DataFrame, fields: DataFrame, stream: str, number: str) -> DataFrame:
    """(stream, no, field, kind, shape, word, n), counted by file; each file has a row without a field too, so that files without fields are seen."""
    scalar = ~F.col("kind").isin("array", "object", "null")
    own = fields.select("stream", "no", "field", F.when(F.col("kind") != "null", F.col("kind")).alias("kind"), F.when(scalar, F.col("text")).alias("text"))
    inner = _leaves(fields).select("stream", "no", "field", F.lit(None).cast("string").alias("kind"), "text")
    files = df.select(df[stream].alias("stream"), df[number].cast("int").alias("no"), *(F.lit(None).cast("string").alias(c) for c in ("field", "kind", "text")))
    rows = own.union(inner).union(files).where(F.col("stream").isNotNull() & F.col("no").isNotNull()).withColumn("shape", _shape(F.col("text")))
    # Numbers and masks agree too easily inside two files; words don't.
    word = F.col("text").try_cast("double").isNull() & (F.col("shape") == F.col("text"))
    return rows.withColumn("word", F.coalesce(word, F.lit(False))).groupBy("stream", "no", "field", "kind", "shape", "word").agg(F.count("*").alias("n"))


def _pairs_of_files(statistics: DataFrame) -> DataFrame:
    """(stream, no, old, new): the fields of consecutive files as maps, field -> (types, words -> count)."""
    words = F.map_from_entries(F.collect_list(F.when(F.col("word"), F.struct("shape", "n"))))
    by_shape = statistics.repartition("stream", "no").groupBy("stream", "no", "field", "shape", "word").agg(F.collect_set("kind").alias("kinds"), F.sum("n").alias("n"))
    by_field = by_shape.groupBy("stream", "no", "field").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("kinds")))).alias("types"), words.alias("words"))
    files = by_field.groupBy("stream", "no").agg(F.map_from_entries(F.collect_list(F.when(F.col("field").isNotNull(), F.struct("field", F.struct("types", "words"))))).alias("fields"))
    none = F.lit(None).cast(files.schema["fields"].dataType)
    roles = F.array(F.struct("no", F.col("fields").alias("new"), none.alias("old")), F.struct((F.col("no") + 1).alias("no"), none.alias("new"), F.col("fields").alias("old")))
    both = files.select("stream", F.inline(roles)).groupBy("stream", "no").agg(F.first("new", True).alias("new"), F.first("old", True).alias("old"))
    return both.where(F.col("new").isNotNull() & F.col("old").isNotNull())


def _over_all(pairs: DataFrame, statistics: DataFrame) -> DataFrame:
    """(gone, new_name, over_all): what the values of two keys have in common over the whole table."""
    rows = statistics.where(F.col("field").isNotNull() & F.col("shape").isNotNull())
    own = pairs.select(F.explode(F.array("gone", "new_name")).alias("field")).distinct()
    counts = rows.join(own, "field", "left_semi").groupBy("field", "shape").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("field").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, "field").select("field", "shape", (F.col("n") / F.col("total")).alias("share"))
    alike = pairs.join(shares.withColumnsRenamed({"field": "gone", "share": "a"}), "gone").join(shares.withColumnsRenamed({"field": "new_name", "share": "b"}), ["new_name", "shape"])
    return alike.groupBy("gone", "new_name").agg(F.sum(F.least("a", "b")).alias("over_all"))


def _changes(df: DataFrame, fields: DataFrame, stream: str, number: str) -> DataFrame:
    statistics = stored(_statistics(df, fields, stream, number), "statistics")
    keys = [F.map_keys(c) for c in ("old", "new")]
    files = _pairs_of_files(statistics).select(
        "*", F.array_except(*keys).alias("ended"), F.array_except(keys[1], keys[0]).alias("begun"),
        F.filter(F.array_intersect(*keys), lambda f: (F.size(F.col("old")[f]["types"]) > 0) & (F.size(F.col("new")[f]["types"]) > 0) & (F.col("old")[f]["types"] != F.col("new")[f]["types"])).alias("retyped"),
    )
    files = stored(files.where("size(ended) + size(begun) + size(retyped) > 0"), "files")

    pairs = files.where("size(ended) > 0 and size(begun) > 0").select("*", F.explode("ended").alias("gone")).select("*", F.explode("begun").alias("new_name"))
    one, two = _words(F.col("gone")), _words(F.col("new_name"))
    plain = [F.lower(F.regexp_replace(F.col(c), r"[^\p{L}\d]+", "")) for c in ("gone", "new_name")]
    same = F.when(plain[0] == plain[1], 1.0).otherwise(F.size(F.array_intersect(one, two)) / F.size(F.array_union(one, two)))

    def part(of: Column, other: Column) -> Column:
        """Share of one key's words that stand under the other key too."""
        total = lambda m: F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda s, n: s + n)
        return F.coalesce(F.try_divide(total(F.map_filter(of, lambda w, n: F.map_contains_key(other, w))).cast("double"), total(of)), F.lit(0.0))

    x, y = F.col("old")[F.col("gone")]["words"], F.col("new")[F.col("new_name")]["words"]
    pairs = pairs.select("stream", "no", "gone", "new_name", same.alias("w"), F.greatest(part(x, y), part(y, x)).alias("in_files"))
    scored = pairs.join(_over_all(pairs.select("gone", "new_name").distinct(), statistics), ["gone", "new_name"], "left").withColumn("v", F.greatest(F.coalesce("over_all", F.lit(0.0)), "in_files"))
    scored = scored.where((F.col("w") == 1) | (F.col("v") >= SAME_VALUES)).withColumn("score", F.col("v") + NAME_WEIGHT * F.col("w"))
    # The best pair first, then the best of the fields that are still free, until none is left.
    best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "gone", "new_name")))
    free = lambda taken, p: ~F.exists(taken, lambda t: (t["gone"] == p["gone"]) | (t["new_name"] == p["new_name"]))
    start = F.array().cast("array<struct<gone:string,new_name:string>>")
    chosen = F.aggregate(best, start, lambda taken, p: F.when(free(taken, p), F.concat(taken, F.array(F.struct(p["gone"].alias("gone"), p["new_name"].alias("new_name"))))).otherwise(taken))
    files = files.join(scored.groupBy("stream", "no").agg(chosen.alias("pairs")), ["stream", "no"], "left").withColumn("pairs", F.coalesce("pairs", start))

    none, empty = F.lit(None).cast("string"), F.array().cast("array<string>")
    types = lambda side, f: F.col(side)[f]["types"]

    def change(name: Column, kind: str, new: Column = none, old_types: Column = empty, new_types: Column = empty) -> Column:
        return F.struct(name.alias("field_name"), F.lit(kind).alias("change_kind"), new.alias("new_name"), old_types.alias("old_types"), new_types.alias("new_types"))

    out = F.concat(
        F.transform("pairs", lambda p: change(p["gone"], "renamed", p["new_name"], types("old", p["gone"]), types("new", p["new_name"]))),
        F.transform(F.array_except("ended", F.transform("pairs", lambda p: p["gone"])), lambda f: change(f, "removed", old_types=types("old", f))),
        F.transform(F.array_except("begun", F.transform("pairs", lambda p: p["new_name"])), lambda f: change(f, "added", new_types=types("new", f))),
        F.transform("retyped", lambda f: change(f, "retyped", old_types=types("old", f), new_types=types("new", f))),
    )
    return files.select(F.col("stream").alias(stream), F.col("no").alias(number), F.inline(out))


#: Column of the consistent table -> its type; other fields are kept as text in the map ``extra``.
ENTRY_COLUMNS = {
    "timestamp": "timestamp", "protocol_version": "string", "model_id": "string", "backend": "string", "dataset": "string",
    "split": "string", "language": "string", "format": "string", "metric_key": "string", "metric_value": "double",
    "empty_rate": "double", "parse_fail_rate": "double", "total_samples": "bigint",
}


def _names(changes: DataFrame, columns: dict[str, str]) -> dict[str, str]:
    """Field name -> column, following the renames seen anywhere in the table."""
    links = [(r.field_name, r.new_name) for r in changes.where("change_kind = 'renamed'").select("field_name", "new_name").distinct().limit(MAX_FIELDS + 1).collect()]
    if len(links) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} renames of distinct names: the keys look like data")
    return _followed(links, {c: c for c in columns})


def _followed(links: list[tuple[str, str]], name: dict[str, str]) -> dict[str, str]:
    """name with the names that links lead to from those it holds."""
    name, near = dict(name), {}
    for a, b in links:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    open_names = list(name)
    while open_names:
        x = open_names.pop(0)
        for y in near.get(x, ()):
            if y not in name:
                name[y] = name[x]
                open_names.append(y)
    return name


def _own_names(changes: DataFrame, columns: dict[str, str], stream: str) -> DataFrame:
    """(s, field, own): the column of a field by the renames of its own stream alone, for streams whose renames lead to a column."""
    links = F.collect_set(F.struct(F.col("field_name").alias("a"), F.col("new_name").alias("b")))
    rows = changes.where("change_kind = 'renamed'").groupBy(F.col(stream).alias("s")).agg(links.alias("links"))

    @F.pandas_udf("array<struct<field:string,own:string>>")
    def follow(given: pd.Series) -> pd.Series:
        start = {c: c for c in columns}
        return given.map(lambda pairs: [{"field": f, "own": c} for f, c in sorted(_followed([(p["a"], p["b"]) for p in pairs], start).items()) if f not in start])

    return rows.select("s", F.inline(follow("links")))


def consistent_entries(
    df: DataFrame, stream: str = "stream_name", number: str = "file_no", payload: str = "payload", file_id: str = "file_id", columns: dict[str, str] = ENTRY_COLUMNS
) -> DataFrame:
    """One row per entry: stream, number, entry_no, the typed columns, extra and failed_casts (columns whose value has no such type)."""
    fields = _stored_fields(df, stream, number, payload, file_id)
    changes = stored(_changes(df, fields, stream, number), "changes")
    name = _names(changes, columns)
    # A wrapped value stands for what it holds: the only or first member of an array, the code or key of an object.
    inside = F.try_parse_json("text")
    inner = F.coalesce(*(F.try_variant_get(inside, p, "string") for p in ("$.code", "$.key", "$.value", "$[0]")))
    text = F.when(F.col("kind").isin("array", "object"), F.coalesce(inner, F.col("text"))).when(F.col("kind") != "null", F.col("text"))
    # A stream's own renames come first: two streams may use one key differently.
    mapped = reduce(lambda c, x: c.when(F.col("field") == x[0], x[1]), sorted(name.items()), F.when(F.lit(False), "")).otherwise(F.col("field"))
    own = _own_names(changes, columns, stream).withColumnsRenamed({"s": "stream"})
    rows = fields.join(own, ["stream", "field"], "left").select("stream", "no", "entry", F.coalesce("own", mapped).alias("column"), text.alias("text"))
    known = F.col("column").isin(*columns)
    wide = rows.groupBy("stream", "no", "entry").agg(
        *(F.max(F.when(F.col("column") == c, F.col("text"))).alias(f"raw_{i}") for i, c in enumerate(columns)),
        F.map_from_entries(F.sort_array(F.collect_set(F.when(~known & F.col("text").isNotNull(), F.struct("column", "text"))))).alias("extra"),
    )
    cast = {c: F.col(f"raw_{i}").try_cast(kind) for i, (c, kind) in enumerate(columns.items())}
    failed = F.array_compact(F.array(*(F.when(F.col(f"raw_{i}").isNotNull() & cast[c].isNull(), F.lit(c)) for i, c in enumerate(columns))))
    return wide.select(
        F.col("stream").alias(stream), F.col("no").alias(number), F.col("entry").cast("int").alias("entry_no"), *(v.alias(c) for c, v in cast.items()), "extra", failed.alias("failed_casts")
    )


def broken_files(df: DataFrame, number: str = "file_no", stream: str = "stream_name", payload: str = "payload", file_id: str = "file_id") -> DataFrame:
    """Files whose payload is null, empty or no JSON list or object of entries."""
    files = _files(df, stream, number, payload, file_id)
    return files.where(F.col("v").isNull() | ~F.coalesce(json_type(F.col("v")) == "array", F.lit(False))).select(F.col("stream").alias(stream), F.col("no").alias(number))
