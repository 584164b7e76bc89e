import hashlib
import json
from pathlib import Path

from pyspark.sql import functions as F

from scorelake import catalogue
from scorelake.operators import silver
from scorelake.sources import synth
from scorelake.sources.documents import latest_snapshots


def test_parts_of_another_layout_follow_the_rows(spark, tmp_path, monkeypatch):
    """A fixed number of parts would let each grow with the table."""
    lines = spark.range(2000).select(F.col("id").alias("l_orderkey"), F.col("id").alias("l_suppkey"), F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("l_returnflag"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(catalogue, "PART_ROWS", 100, raising=False)
    found = catalogue.table_fingerprint(spark, str(tmp_path))
    assert ", 20), REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in found.collect()) == [("N", 1333, 1333), ("R", 667, 667)]


def test_snapshots_are_written_by_tasks_and_as_by_spark(spark, tmp_path):
    """A file per contest with its checksums, and nothing else; Spark's writer, for other stores, gives the same files."""
    events = spark.range(4000).select(F.col("id").alias("event_id"), F.timestamp_micros(F.col("id") * 1000).alias("ts"), (F.col("id") % 200).alias("user_id"), F.lit("view").alias("event_type"))
    docs = synth.event_documents(events)
    lines = [json.loads(x) for x in synth.write_folder(docs, tmp_path / "a b").read_text().splitlines()]
    assert [x["contest_id"] for x in lines] == list(range(200)) and {x["ingest_timestamp"] for x in lines} == {"20260101T000000Z"}
    paths = [Path(x["file_path"].removeprefix("file:")) for x in lines]
    assert sorted(p for p in (tmp_path / "a b").rglob("*") if p.is_file()) == sorted([*paths, *(p.with_name(".document.json.crc") for p in paths), tmp_path / "a b" / "ingest_manifest.jsonl"])
    assert [hashlib.sha256(p.read_bytes()[:-1]).hexdigest() for p in paths] == [x["sha256"] for x in lines]
    body = F.struct(F.struct(F.struct(F.col("contest_id").alias("contestId"), "title", "status", "teams", "periods").alias("playbyplay")).alias("data"))
    by_spark = synth._written_by_spark(docs.select("contest_id", "ingest_timestamp", F.to_json(body).alias("value")), f"file:{tmp_path}/c")
    assert sorted((r.contest_id, r.ingest_timestamp, r.sha256) for r in by_spark.collect()) == [(x["contest_id"], x["ingest_timestamp"], x["sha256"]) for x in lines]
    found = latest_snapshots(tmp_path / "a b" / "ingest_manifest.jsonl")
    assert len(found) == 200 and silver.silver_plays(spark, found).count() == 4000
