"""Files and streams: round trips, broken input, missing paths, and a stream against the same batch."""

import json

import pytest
from pyspark.sql import functions as F

from docaudit.operators import windows as W
from docaudit.sources import files
from docaudit.streaming import stream


def test_json_files(spark, tmp_path):
    for i, body in enumerate(['{"id": "a", "n": 1}', "{broken", '{"id": "b", "n": 2}']):
        (tmp_path / f"{i}.json").write_text(body)
    got = files.read_documents(spark, f"{tmp_path}/*.json", "id string, n int").orderBy("source_file").collect()
    assert [r.id for r in got] == ["a", None, "b"] and got[1]._corrupt == "{broken"
    results = files.read_results(spark, str(tmp_path), "id string, n int", required=["id"]).collect()
    assert [r.id for r in results] == ["a", "b"]


def test_json_lines(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('﻿{"id": "a"}\n\n  \n{"id": "b"}\n')
    assert sorted(r.id for r in files.read_lines(spark, str(path), "id string").collect()) == ["a", "b"]
    assert files.read_lines(spark, str(tmp_path / "none.jsonl"), "id string").count() == 0


def test_manifests(spark, tmp_path):
    csv = tmp_path / "m.csv"
    csv.write_text("﻿id,html_path\n1,a.html\n2,b.html\n", encoding="utf-8")
    assert sorted((r.sample_id, r.path) for r in files.read_manifest(spark, str(csv)).collect()) == [("1", "a.html"), ("2", "b.html")]
    bad = tmp_path / "bad.jsonl"
    bad.write_text(json.dumps({"id": "1", "file_path": ""}) + "\n")
    with pytest.raises(Exception, match="without a path"):
        files.read_manifest(spark, str(bad)).collect()


def test_pages_and_round_trips(spark, tmp_path):
    (tmp_path / "p.html").write_bytes("<h1>标题</h1><p>正文</p>".encode("gb18030"))
    page = files.read_pages(spark, f"{tmp_path}/p.html").first()
    assert page.encoding == "gb18030" and page.page.headings == ["标题"]
    df = spark.createDataFrame([(1, ["a", "b"], {"k": 1.0})], "i int, l array<string>, m map<string,double>")
    files.write_csv(df, f"{tmp_path}/out.csv")
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/out.csv").first()
    assert back.l == "a;b"
    files.write_lines(df, f"{tmp_path}/out.jsonl")
    assert files.read_lines(spark, f"{tmp_path}/out.jsonl", "i int").count() == 1
    files.write_partitioned(spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string"), f"{tmp_path}/parts", ["s"])
    assert spark.read.parquet(f"{tmp_path}/parts").count() == 2
    files.write_markdown(df, f"{tmp_path}/r/report.md", "T")
    assert "a;b" in (tmp_path / "r" / "report.md").read_text()


def test_jobs_and_resume(spark):
    config = spark.createDataFrame([("i", "u1", "direct_pdf"), ("i", "land", "landing_page")], "institution string, url string, kind string")
    links = spark.createDataFrame([("land", "u2", 1), ("land", "u1", 2), ("land", "u3", 3)], "source_url string, url string, ordinal int")
    assert sorted(r.url for r in files.expand_jobs(config, links, 2).collect()) == ["u1", "u2"]
    rows = spark.createDataFrame([("a",), ("b",)], "id string")
    assert [r.id for r in files.pending(rows, rows.where("id = 'a'"), ["id"]).collect()] == ["b"]


def test_stream_equals_batch(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet")
    events.write.parquet(f"{tmp_path}/in")
    live = stream.arriving(spark, f"{tmp_path}/in", events.schema)
    counts = stream.windowed_counts(live, "ts", "event_type", "value")
    stream.run_available(counts, f"{tmp_path}/c1", table="counted", mode="complete")
    batch = events.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    assert spark.table("counted").agg(F.sum("n")).first()[0] == batch.agg(F.sum("n")).first()[0]
    assert spark.table("counted").count() == batch.count()
    costs = stream.arriving(spark, f"{tmp_path}/in", events.schema).withColumn("c", (F.col("event_type") != "view").cast("int"))
    stream.run_available(stream.running_budget(costs, "user_id", "event_id", "c", 20, "ts"), f"{tmp_path}/c2", table="budget")
    want = W.over_budget(events.withColumn("c", (F.col("event_type") != "view").cast("int")), ["user_id"], [F.col("ts"), F.col("event_id")], F.col("c"), 20)
    assert spark.table("budget").where("skipped").count() == want.where("skipped").count()
    once = stream.once_per_key(stream.arriving(spark, f"{tmp_path}/in", events.schema), "user_id", "ts", "400 days")
    stream.run_available(once, f"{tmp_path}/c3", table="once")
    assert spark.table("once").count() == events.select("user_id").distinct().count()
    seen = stream.sessions(stream.arriving(spark, f"{tmp_path}/in", events.schema), "ts", "user_id")
    stream.run_available(seen, f"{tmp_path}/c4", table="seen", mode="complete")
    assert spark.table("seen").agg(F.sum("n")).first()[0] == events.count()
