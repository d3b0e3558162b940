import json

import pytest
from pyspark.sql import functions as F

from folioscope.operators import schema_drift

SCHEMA = "file_id long, stream_name string, file_no int, payload string, field string, stream string"


@pytest.fixture(scope="module")
def files(spark):
    rows = [
        ("s", 1, [{"language": "ko", "score": 0.5, "n": 10, "when": "2025-01-01T00:00:00Z", "note": None}, {"language": "ja", "score": 0.25, "n": 50}]),
        ("s", 2, {"lang_code": "ko", "score": "0.5", "n": 10, "when": "2025-01-02T00:00:00Z", "note": "some words to read"}),
        ("s", 3, [{"lang_code": ["ko"], "Score": 0.1, "n": 200, "startedAt": "2025-01-03T00:00:00Z", "seed": 71234}]),
        ("s", 5, [{"lang_code": "ko"}]),
        ("t", 1, [{"language": {"code": "en"}, "score": True, "n": 10}]),
        ("t", 2, [{"language": {"code": "en"}, "score": "x", "n": "ten"}, {}]),
        ("u", 1, "no list"),
    ]
    out = [(i, s, n, json.dumps(p), "clash", "clash") for i, (s, n, p) in enumerate(rows)]
    out.append((90, "s", 2, out[1][3], "", ""))  # delivered again
    out += [(91, "u", 2, None, "", ""), (92, "u", 3, "{broken", "", ""), (93, "u", 4, "", "", ""), (94, None, None, "[]", "", "")]
    return spark.createDataFrame(out, SCHEMA).repartition(3)


def test_changes(files):
    got = {(r.stream_name, r.file_no, r.field_name, r.change_kind, r.new_name) for r in schema_drift.schema_changes(files).collect()}
    assert got == {
        ("s", 2, "language", "renamed", "lang_code"), ("s", 2, "score", "retyped", None),
        ("s", 3, "lang_code", "retyped", None), ("s", 3, "score", "renamed", "Score"), ("s", 3, "when", "renamed", "startedAt"),
        ("s", 3, "note", "removed", None), ("s", 3, "seed", "added", None), ("t", 2, "score", "retyped", None), ("t", 2, "n", "retyped", None),
    }


def test_competing_renames_are_matched_to_the_last(spark):
    # All pairs are equally good, so each round takes one.
    names = {"alpha": "kilo", "bravo": "lima", "carol": "mike", "delta": "nova"}
    files = [(n, "s", n, json.dumps([{x: "words to compare" for x in fields}]), "", "") for n, fields in ((1, names), (2, names.values()))]
    got = {(r.field_name, r.change_kind, r.new_name) for r in schema_drift.schema_changes(spark.createDataFrame(files, SCHEMA)).collect()}
    assert got == {(a, "renamed", b) for a, b in names.items()}


def test_entries_and_broken_files(files):
    columns = {"language": "string", "score": "double", "n": "bigint", "when": "timestamp"}
    rows = {(r.stream_name, r.file_no, r.entry_no): r for r in schema_drift.consistent_entries(files, columns=columns).collect()}
    assert rows["s", 3, 0].language == "ko" and rows["s", 3, 0].score == 0.1 and rows["s", 3, 0].when is not None
    assert rows["t", 1, 0].language == "en" and rows["s", 3, 0].extra == {"seed": "71234"}
    assert rows["t", 2, 0].failed_casts == ["score", "n"] and rows["s", 1, 1].n == 50
    assert {(r.stream_name, r.file_no) for r in schema_drift.broken_files(files).collect()} == {("u", 1), ("u", 2), ("u", 3), ("u", 4)}
    paths = {(r.path, r.kind) for r in schema_drift.type_statistics(files).where(F.col("stream") == "t").collect()}
    assert ("language.code", "string") in paths and ("score", "boolean") in paths


def test_a_key_that_two_streams_use_differently(spark):
    # In stream a the key "val" is the former kind, in stream b the former tone.
    files = [
        ("a", 1, {"kind": "red", "tone": "soft", "k": "x"}), ("a", 2, {"val": "red", "tone": "soft", "k": "x"}),
        ("b", 1, {"kind": "red", "tone": "soft", "k": "x"}), ("b", 2, {"kind": "red", "val": "soft", "k": "x"}),
    ]
    rows = [(i, s, n, json.dumps([p] * 9), "", "") for i, (s, n, p) in enumerate(files)]
    out = schema_drift.consistent_entries(spark.createDataFrame(rows, SCHEMA), columns={"kind": "string", "tone": "string"})
    assert {(r.kind, r.tone) for r in out.collect()} == {("red", "soft")} and out.count() == 36


def test_values_of_any_depth(spark):
    deep = {"a": {"b": [{"c": {"d": [{"e": {"f": 7}}]}}]}, "s": "[{not nested}]"}
    rows = [(1, "s", 1, json.dumps(deep), "", ""), (2, "s", 2, json.dumps({"z": deep["a"], "s": "x"}), "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    paths = {(r.path, r.kind) for r in schema_drift.type_statistics(df).where("no = 1").collect()}
    assert ("a.b[].c.d[].e.f", "number") in paths and ("a.b[].c.d[].e", "object") in paths and ("s", "string") in paths
    assert {r.path for r in schema_drift.path_values(df, depth=2).where("no = 1").collect()} == {"a", "a.b", "s"}
    # The deep values are what tells that z is the former a.
    got = {(r.field_name, r.change_kind, r.new_name) for r in schema_drift.schema_changes(df).collect()}
    assert got == {("a", "renamed", "z")}


def test_empty_table(files):
    none = files.limit(0)
    assert schema_drift.schema_changes(none).count() == schema_drift.consistent_entries(none).count() == schema_drift.broken_files(none).count() == 0
