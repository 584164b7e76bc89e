"""Snapshots and replaced keys stay relations: the driver holds no list that grows with the contests."""

import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameReader

from scorelake import catalogue
from scorelake.plans import store
from scorelake.sources import files, synth
from scorelake.sources.documents import read_documents, snapshot_table

from .helpers import document

CONTESTS = 120


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("events")
    kinds = F.element_at(F.array(*map(F.lit, ("view", "click", "error", "signup", "purchase"))), (F.col("id") % 5 + 1).cast("int"))
    rows = spark.range(CONTESTS * 4).select(F.col("id").alias("event_id"), F.timestamp_micros(F.col("id") * 1000).alias("ts"), (F.col("id") % CONTESTS).alias("user_id"), kinds.alias("event_type"))
    rows.write.parquet(str(folder / "events.parquet"))
    return str(folder)


@pytest.fixture
def seen(monkeypatch, spark):
    """The longest lists that reach or leave the driver, by what brought them."""
    most = {"collect": 0, "createDataFrame": 0, "paths": 0, "text": 0}

    def watched(owner, name, what, size):
        inner = getattr(owner, name)

        def call(*arguments, **more):
            out = inner(*arguments, **more)
            most[what] = max(most[what], size(arguments, out))
            return out

        monkeypatch.setattr(owner, name, call)

    watched(DataFrame, "collect", "collect", lambda a, out: len(out))
    watched(type(spark), "createDataFrame", "createDataFrame", lambda a, out: len(a[1]) if isinstance(a[1], list) else 0)
    watched(DataFrameReader, "json", "paths", lambda a, out: len(a[1]) if isinstance(a[1], list) else 1)
    watched(files, "text", "text", lambda a, out: len(out.splitlines()))
    return most


@pytest.mark.parametrize("name", ["stored_plays", "published_plays", "refreshed_plays"])
def test_no_list_of_all_contests_reaches_the_driver(spark, events, seen, monkeypatch, name):
    monkeypatch.setattr(store, "INLINE", 10, raising=False)
    monkeypatch.setattr(store, "LISTED", 10)
    monkeypatch.setattr(synth, "BUCKETS", 8, raising=False)
    found = catalogue.QUERIES[name](spark, events)
    assert max(seen.values()) < CONTESTS / 3, seen
    want = catalogue.QUERIES["silver_plays" if name == "stored_plays" else "fact_plays"](spark, events)
    common = [c for c in want.columns if c in found.columns and c not in ("ingest_timestamp", "color")]
    assert found.count() == CONTESTS * 4 and found.select(common).exceptAll(want.select(common)).isEmpty()
    if name == "refreshed_plays":
        told = {r[0]: (r[1], r[2]) for r in found.select("contest_id", "ingest_timestamp", "title").distinct().collect()}
        assert told == {c: ("20260202T000000Z", f"Game {c} (again)") if c % 3 == 0 else ("20260101T000000Z", f"Game {c}") for c in range(CONTESTS)}


def rows(spark, keys, v):
    return spark.createDataFrame([(k, v) for k in keys], "contest_id long, v string")


def test_many_replaced_keys_are_a_table_beside_the_log(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "INLINE", 5, raising=False)
    table, log = tmp_path / "t", tmp_path / "t" / store.LOG
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "contest_id long")
    tables = lambda: {n for n in files.names(log) if n.startswith("keys-")}
    store.replace_keys(spark, table, rows(spark, range(40), "a"), "contest_id", None, files=4)
    store.replace_keys(spark, table, rows(spark, range(0, 9), "b"), "contest_id", keys(*range(10)), merge=False)
    entry = store._entry(table, 2)
    assert {entry["keys"]["table"]} == tables() and len(entry["removed"]) == 1  # of four files the one that holds them
    read = lambda: {r.contest_id: r.v for r in store.read_table(spark, table).collect()}
    assert read() == {k: "b" if k < 10 else "a" for k in range(40) if k != 9}
    with pytest.raises(ValueError, match="isn't replaced"):
        store.replace_keys(spark, table, rows(spark, [30], "x"), "contest_id", keys(*range(10)))
    for late in (keys(3), keys(*range(9, 20)), keys(*range(3, 4), 3)):
        with pytest.raises(store.Conflict):
            store.replace_keys(spark, table, late.limit(0).withColumn("v", F.lit("x")), "contest_id", late, since=1)
    assert len(tables()) == 1  # what wasn't committed has left nothing
    store.replace_keys(spark, table, rows(spark, range(20, 30), "c"), "contest_id", keys(*range(20, 30)), since=1, merge=False)
    store.replace_keys(spark, table, rows(spark, [39], "d"), "contest_id", keys(39), since=1, merge=False)
    assert store._entry(table, 4)["keys"] == [39] and len(tables()) == 2
    assert read() == {k: "b" if k < 10 else "c" if 20 <= k < 30 else "d" if k == 39 else "a" for k in range(40) if k != 9}
    store.vacuum(table, keep_seconds=0)
    assert tables() == set() and len(read()) == 39


def test_the_last_of_some_manifests_counts(spark, tmp_path):
    docs = lambda time, *contests: spark.createDataFrame([(c, time, "t") for c in contests], "contest_id long, ingest_timestamp string, title string")
    one, two = synth.write_parts(docs("t1", 1, 2, 3).repartition(3), tmp_path / "z"), synth.write_parts(docs("t2", 2), tmp_path / "a")
    assert one.is_dir() and len(list(one.glob("part-*"))) >= 1
    times = lambda m: sorted((r.contest_id, r.ingest_timestamp) for r in snapshot_table(spark, m).collect())
    assert times([one, two]) == [(1, "t1"), (2, "t2"), (3, "t1")] and times([two, one]) == [(1, "t1"), (2, "t1"), (3, "t1")]
    synth.remove_folder(spark, tmp_path / "z")
    assert not (tmp_path / "z").exists()


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_documents_as_sparks_reader_gives_them(spark, tmp_path, prefix, monkeypatch):
    text = json.dumps(document(1, [(None, "9:00", "Turnover by Zoë.")]), ensure_ascii=False, indent=1)
    bodies = {"a b.json": text.encode(), "bom.json": b"\xef\xbb\xbf" + text.encode(), "wide.json": text.encode("utf-16-le"), "packed.json.gz": gzip.compress(text.encode()), "two.json": f"[{text},{text}]".encode(), "broken.json": b'{"data": ', "odd.json": text.replace('"9:00"', "[9]").encode()}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    for name in bodies:
        path = f"{prefix}{tmp_path}/{name}"
        mine = read_documents(spark, [(1, "t", path)]).select("contestId", "title", "teams", "periods", "ingest_timestamp").collect()
        by_spark = spark.read.schema(read_documents_schema()).option("multiline", "true").json(path.replace("file://", "file:")).select("data.playbyplay.*").collect()
        assert [(r.contestId, r.title, r.teams, r.periods) for r in mine] == [(r.contestId, r.title, r.teams, r.periods) for r in by_spark], name
        assert {r.ingest_timestamp for r in mine} == {"t" if mine[0].contestId == 1 else None}, name
    assert [r.ingest_timestamp for r in read_documents(spark, [(2, "t", f"{tmp_path}/a b.json")]).collect()] == [None]  # of another contest


def read_documents_schema():
    from scorelake.sources.documents import DOCUMENT

    return DOCUMENT
