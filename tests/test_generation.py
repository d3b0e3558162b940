import json

import pytest
from pyspark.sql import functions as F

from folioscope.operators import generation
from folioscope.sources import readers
from folioscope.streaming import events


def values(spark, spec, n=2000):
    return [r.v for r in spark.range(n).select(generation.spec_value(spec, F.col("id"), "x").alias("v")).collect()]


def test_shards(spark):
    assert [tuple(r) for r in generation.plan_shards(spark, 11, 4, 2).collect()] == [(0, 0, 4), (1, 4, 4)]
    assert [tuple(r) for r in generation.plan_shards(spark, 11).collect()] == [(0, 0, 11)]
    assert generation.plan_shards(spark, 0, 4).count() == 0
    assert spark.range(1).select(generation.sample_seed(42, F.lit(3), 1).alias("s")).first().s == 12245


def test_specs(spark):
    assert set(values(spark, {"histogram": {"bins": [0, 1, 2], "weights": [0, 1]}}, 200)) and min(values(spark, {"histogram": {"bins": [0, 1, 2], "weights": [0, 1]}}, 200)) >= 1
    assert sum(values(spark, {"p": 0.3})) == pytest.approx(600, abs=80)
    normal = values(spark, {"normal": [5, 2]})
    assert sum(normal) / len(normal) == pytest.approx(5, abs=0.2)
    beta = values(spark, {"beta": [2, 2], "range": [10, 20]})
    assert min(beta) >= 10 and max(beta) <= 20 and sum(beta) / len(beta) == pytest.approx(15, abs=0.3)
    chosen = values(spark, {"choices": ["a", "b"], "weights": [1, 3]})
    assert chosen.count("b") == pytest.approx(1500, abs=90)
    assert set(values(spark, {"uniform": [0, 9], "clip": [3, 4], "round": 0}, 99)) == {3, 4}
    assert values(spark, [1, 2], 50) == values(spark, [2, 1], 50) and values(spark, "fixed", 1) == ["fixed"]
    for bad in ({"odd": 1}, {"histogram": {"bins": [0, 1], "weights": [1, 2]}}, [1, 2, 3], {"choices": []}):
        with pytest.raises(ValueError):
            generation.spec_value(bad, F.col("id"), "x")


def test_pages_do_not_depend_on_partitions(spark):
    corpus = [f"word{i} text" for i in range(50)]
    a = generation.generate_pages(spark, 23, corpus, shard_size=5).orderBy("sample_index").collect()
    b = generation.generate_pages(spark, 23, corpus, shard_size=5).repartition(1).orderBy("sample_index").collect()
    assert a == b and [r.sample_index for r in a] == list(range(23)) and {r.shard for r in a} == set(range(5))
    for r in a:
        for line in r.GT_markdown.split("\n"):
            cells = [c.strip() for c in line.strip("|").split("|")]
            if line.startswith("| item ") and cells[0] != "item":
                assert int(cells[1]) * int(cells[2]) == int(cells[3])


def test_pages_draw_from_all_names(spark, tmp_path, monkeypatch):
    from folioscope.plans import reference

    names = [f"name {i:05d}" for i in range(2600)]
    spark.createDataFrame([(n,) for n in names + names[:3]], "p_name string").write.parquet(str(tmp_path / "part.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "supplier.parquet"))
    given = []
    make = generation.generate_pages
    monkeypatch.setattr(generation, "generate_pages", lambda spark, total, words, **kw: given.extend(words) or make(spark, total, words, **kw))
    assert reference.generated_pages(spark, str(tmp_path)).count() == 3 and given == names
    monkeypatch.setattr(reference, "MAX_NAMES", 2599)
    with pytest.raises(ValueError):
        reference.generated_pages(spark, str(tmp_path))


def test_capture_plans(spark):
    from folioscope.plans.reference import CHANNELS

    rows = generation.capture_plans(spark.range(3000).withColumnRenamed("id", "sample_seed"), CHANNELS).collect()
    share = sum(r.capture_channel == "photographed" for r in rows) / len(rows)
    assert share == pytest.approx(0.2, abs=0.03)
    fax = [r for r in rows if r.capture_scenario == "line_fax"]
    assert fax and all(r.degradation_params["binarize"] == "true" and r.degradation_params["jpeg_quality"] == "0" for r in fax)
    assert {r.capture_scenario for r in rows if r.capture_channel == "born_digital"} == {""}


def test_readers_and_shards(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"text": "a **b**"}\n{"text": ""}\n{"other": 1}\n')
    assert [r.text for r in readers.jsonl_texts(spark, str(tmp_path / "t.jsonl"), markdown=True).collect()] == ["a b"]
    (tmp_path / "m.jsonl").write_text('{"file_name": "x.png", "k": 1}\n{"file_name": "y.png", "k": 2}\n{"k": 1}\n')
    assert [r.file_name for r in readers.metadata(spark, str(tmp_path / "m.jsonl"), {"k": "1"}).collect()] == ["x.png"]
    (tmp_path / "dir/sub").mkdir(parents=True)
    (tmp_path / "dir/sub/a.txt").write_text("hello")
    (tmp_path / "dir/b.txt").write_text(" \n")
    assert [r.text for r in readers.text_files(spark, str(tmp_path / "dir")).collect()] == ["hello"]
    (tmp_path / "s.csv").write_text("Model ,Score\nA,1.5\nB,none\n")
    assert [tuple(r) for r in readers.scores(spark, str(tmp_path / "s.csv")).collect()] == [("A", 1.5)]
    (tmp_path / "s.json").write_text('{"A": 1.5, "B": 2}')
    assert readers.scores(spark, str(tmp_path / "s.json")).count() == 2
    (tmp_path / "f.csv").write_text("id,latex\n1,x^2\n2,\n3,x^2\n")
    assert [r.formula for r in readers.formulas(spark, str(tmp_path / "f.csv")).collect()] == ["x^2"]
    run = tmp_path / "runs/m/ko"
    run.mkdir(parents=True)
    (run / "report.json").write_text(json.dumps({"config": {"dataset_id": "d-ko", "model": {"model_id": "m"}}, "metrics": {"avg_x": 0.5}, "summary": {"total_samples": 3}}))
    (run / "protocol.json").write_text('{"timestamp": "2025-03-01T00:00:00Z"}')
    row = readers.reports(spark, str(tmp_path / "runs")).first()
    assert row.config.model.model_id == "m" and row.metrics == {"avg_x": 0.5} and str(row.run_at).startswith("2025-03-01")
    plan = generation.plan_shards(spark, 10, 4)
    out = str(tmp_path / "out")
    assert readers.open_shards(plan, out).count() == 3
    pages = generation.generate_pages(spark, 10, ["a", "b"], shard_size=4)
    readers.write_shards(pages, out, only=F.col("shard") < 2)
    assert [r.shard for r in readers.open_shards(plan, out).collect()] == [2]
    readers.write_shards(pages, out, only=F.col("shard") == 2)
    assert spark.read.parquet(out).count() == 10 and readers.open_shards(plan, out).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"2024-01-0{1 + i % 3} 0{i % 10}:00:00", i % 4, "view" if i % 2 else "buy", float(i)) for i in range(40)]
    batch = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = events.read_stream(spark, str(tmp_path / "in"), batch)
    query = events.tumbling(stream, late="10 days").writeStream.format("memory").queryName("daily").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    assert sorted(spark.table("daily").collect()) == sorted(events.tumbling(batch).collect())
    target = str(tmp_path / "once")
    for batch_id in (0, 1, 1):  # the second batch runs again and replaces itself
        events.write_batch(batch.where(F.col("event_id") >= 10 * batch_id).union(batch.limit(3)), batch_id, target, ["event_id"])
    table = spark.read.parquet(target)
    assert {(r.batch, r["count"]) for r in table.groupBy("batch").count().collect()} == {(0, 40), (1, 33)}
    assert events.first_batches(table, ["event_id"]).count() == 40
    assert events.first_batches(table, ["event_id"]).columns == batch.columns


def test_running_novelty(spark, tmp_path):
    rows = spark.createDataFrame([("k", "abcd"), ("k", "abcd"), ("k", "wxyz")], "k string, sig string").coalesce(1)
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = events.running_novelty(stream, "k", "sig").writeStream.format("memory").queryName("novelty").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    assert [r.novelty for r in spark.table("novelty").collect()] == [1.0, 0.0, 1.0]
