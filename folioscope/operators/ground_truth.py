"""Ground truth of generated samples in one form: a Markdown text and a JSON object, whatever fields a sample came with."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Older fields of the ground truth, and fields of the generator that aren't published.
LEGACY = ("ground_truth", "markdown", "json")
UNPUBLISHED = ("format", "similarity_db_path", "original_markdown", "similar_char_ratio", "add_noise", "add_blur")


def json_object(value: Column) -> Column:
    """A JSON object as text: the value itself if it is one, {"value": ...} for other JSON, {"raw": ...} for no JSON, {} for null and blank."""
    parsed = F.try_parse_json(value)
    kind = F.schema_of_variant(parsed)
    other = F.concat(F.lit('{"value":'), F.to_json(parsed), F.lit("}"))
    raw = F.to_json(F.struct(value.alias("raw")))
    return F.when(value.isNull() | (F.trim(value) == ""), "{}").when(parsed.isNull(), raw).when(kind.startswith("OBJECT"), F.to_json(parsed)).otherwise(other)


@F.pandas_udf(StringType())
def json_fence(value: pd.Series) -> pd.Series:
    """A fenced block of a JSON text, indented by two blanks."""
    return value.map(lambda v: None if v is None else "```json\n" + json.dumps(json.loads(v), ensure_ascii=False, indent=2) + "\n```")


def truth_text(df: DataFrame) -> Column:
    """The page a result is scored against: GT_markdown, or markdown where there is no such column, or ''."""
    name = next((c for c in ("GT_markdown", "markdown") if c in df.columns), None)
    return df[name] if name else F.lit("")


def _as_text(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string")
    kind = df.schema[name].dataType.typeName()
    return F.to_json(df[name]) if kind in ("struct", "map", "array", "variant") else df[name].cast("string")


def unified(df: DataFrame, syntax_tree: Callable[[Column], Column] | None = None) -> DataFrame:
    """df with GT_markdown and GT_json (text) made from what each row has, without the older and unpublished fields.

    The first that a row has counts: GT_markdown; typo_text (with original_text); html with json; ground_truth; markdown; json.
    syntax_tree makes the JSON of a page that has none; by default it holds the page alone.  Rows with nothing get '' and {}.
    """
    page, given, typo, html, truth, old, payload = (_as_text(df, c) for c in ("GT_markdown", "GT_json", "typo_text", "html", "ground_truth", "markdown", "json"))
    tree = syntax_tree or (lambda text: F.to_json(F.struct(text.alias("markdown"))))
    original = F.coalesce(_as_text(df, "original_text"), F.lit(""))
    pair = F.to_json(F.struct(typo.alias("text"), original.alias("original_text")))
    table = html.isNotNull() & payload.isNotNull()
    text = (
        F.when(page.isNotNull(), page).when(typo.isNotNull(), typo).when(table & (F.trim(html) != ""), F.trim(html)).when(table, json_fence(json_object(payload)))
        .when(truth.isNotNull(), json_fence(json_object(truth))).when(old.isNotNull(), old).when(payload.isNotNull(), json_fence(json_object(payload))).otherwise("")
    )
    value = (
        F.when(page.isNotNull(), F.coalesce(given, tree(page))).when(typo.isNotNull(), pair).when(table, json_object(payload))
        .when(truth.isNotNull(), json_object(truth)).when(old.isNotNull(), tree(old)).when(payload.isNotNull(), json_object(payload)).otherwise("{}")
    )
    kept = [df[c] for c in df.columns if c not in (*LEGACY, *UNPUBLISHED, "GT_markdown", "GT_json")]
    return df.select(*kept, text.alias("GT_markdown"), value.alias("GT_json"))


def upload_records(df: DataFrame, selected: DataFrame | None = None, key: str = "row_index") -> DataFrame:
    """Rows as they are published: nested values as JSON, missing ones as '', 0 or false by type; selected (key) keeps its rows alone."""
    rows = df if selected is None else df.join(selected.select(key).distinct(), key, "left_semi")
    out = []
    for field in rows.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("struct", "map", "array", "variant"):
            column = F.coalesce(F.to_json(column), F.lit("{}" if kind in ("struct", "map") else "[]" if kind == "array" else "null"))
        elif kind == "string":
            column = F.coalesce(column, F.lit(""))
        elif kind == "boolean":
            column = F.coalesce(column, F.lit(False))
        elif kind in ("byte", "short", "integer", "long", "float", "double", "decimal"):
            column = F.coalesce(column, F.lit(0).cast(field.dataType))
        out.append(column.alias(field.name))
    return rows.select(*out)


def paired(predictions: DataFrame, truths: DataFrame, index: str = "sample_index") -> DataFrame:
    """(index, prediction, ground_truth): predictions and truths of the same place; places that one side lacks are left out."""
    return predictions.select(index, "prediction").join(truths.select(index, "ground_truth"), index)
