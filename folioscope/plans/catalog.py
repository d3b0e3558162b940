"""All queries over the test tables, by name, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import schema_drift
from folioscope.plans import further, reference  # noqa: F401: the modules register their queries
from folioscope.sources.tables import table


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    changes = schema_drift.schema_changes(table(spark, directory, "model_summary"))
    return changes.select("stream_name", "file_no", "field_name", "change_kind")


def p4_changes(spark: SparkSession, directory: str) -> DataFrame:
    changes = schema_drift.schema_changes(table(spark, directory, "model_summary"))
    return changes.withColumns({c: F.array_join(c, "|") for c in ("old_types", "new_types")})


def p4_entries(spark: SparkSession, directory: str) -> DataFrame:
    out = schema_drift.consistent_entries(table(spark, directory, "model_summary"))
    return out.withColumns({"extra": F.to_json("extra"), "failed_casts": F.array_join("failed_casts", "|")})


def p4_types(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of each type by stream and path, over all files."""
    stats = schema_drift.type_statistics(table(spark, directory, "model_summary"))
    return stats.groupBy("stream", "path", "kind").agg(F.sum("entries").alias("entries"), F.min("no").alias("first_file"), F.max("no").alias("last_file"))


QUERIES: dict = reference.QUERIES | {f.__name__: f for f in (p4_found, p4_changes, p4_entries, p4_types)}

SQL: dict = dict(reference.SQL)
