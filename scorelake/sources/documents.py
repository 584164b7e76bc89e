"""Nested play-by-play documents, their schemas, and the manifest of their snapshots."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


_long, _int, _text, _flag = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
PLAY = _struct(clock=_text, playText=_text, homeScore=_int, visitorScore=_int)
STAT = _struct(clock=_text, teamId=_long, plays=T.ArrayType(PLAY))
PERIOD = _struct(periodNumber=_int, periodDisplay=_text, playbyplayStats=T.ArrayType(STAT))
TEAM = _struct(teamId=_text, nameShort=_text, nameFull=_text, name6Char=_text, seoname=_text, color=_text, isHome=_flag)
_head = {"contestId": _long, "title": _text, "status": _text, "teams": T.ArrayType(TEAM)}
#: A whole document, and one without periods: with it the plays are never parsed.
DOCUMENT = _struct(data=_struct(playbyplay=_struct(**_head, periods=T.ArrayType(PERIOD))))
HEADER = _struct(data=_struct(playbyplay=_struct(**_head)))

#: A side of a join is broadcast only below this size.
BROADCAST_BYTES = 64 * 1024 * 1024
#: (contest_id, ingest_timestamp, path)
Snapshot = tuple[int, str, str]
#: Bytes counted for each snapshot of a broadcast, so that more than 65,536 are sent only where Spark finds them small.
TIME_BYTES = 1024
#: Snapshots that a task reads, and bytes of texts that it hands on together.
READ_AT_ONCE, BATCH_BYTES = 1000, 4 * 1024 * 1024


def bounded(df: DataFrame, rows: int, row_bytes: int = 64) -> DataFrame:
    """Mark df for broadcast if its known number of rows stays small, else leave the choice to Spark."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def listed(spark: SparkSession, snapshots: list[Snapshot] | DataFrame) -> DataFrame:
    """The snapshots as a relation of contest_id, ingest_timestamp and path."""
    if isinstance(snapshots, DataFrame):
        return snapshots
    return spark.createDataFrame([(int(c), t, str(p)) for c, t, p in snapshots], "contest_id long, ingest_timestamp string, path string")


def read_documents(spark: SparkSession, snapshots: list[Snapshot] | DataFrame, *, plays: bool = True) -> DataFrame:
    """One row per document of the snapshots, with the ingest_timestamp of its snapshot, null where the document is of another contest; plays=False leaves the periods out of the schema.

    Tasks open the files, so that no path passes through the driver. Files outside
    local disks are left to Spark's reader, which is given a list of all paths.
    """
    if isinstance(snapshots, list) and not snapshots:
        raise ValueError("there are no snapshots to read")
    shots, schema = listed(spark, snapshots), DOCUMENT if plays else HEADER
    if not shots.filter(F.col("path").rlike(_SCHEME) & ~F.col("path").startswith("file:")).isEmpty():
        return _read_by_spark(shots, schema)
    tasks = max(spark.sparkContext.defaultParallelism, -(-shots.count() // READ_AT_ONCE))
    texts = shots.select("contest_id", "ingest_timestamp", "path").repartition(tasks).mapInArrow(_texts(BATCH_BYTES), "_contest long, _time string, value string")
    found = texts.select("_contest", "_time", F.inline_outer(F.from_json("value", T.ArrayType(schema))))
    time = F.when(F.col("data.playbyplay.contestId") == F.col("_contest"), F.col("_time"))
    return found.select("data.playbyplay.*", time.alias("ingest_timestamp"))


def _texts(most: int):
    """For a task: the text of each snapshot's file, unpacked and decoded as Spark's reader would, some `most` bytes at once."""

    def run(batches):
        import json
        import re

        import pyarrow as pa

        names = ["_contest", "_time", "value"]
        for batch in batches:
            rows, size = [], 0
            for contest, time, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with pa.input_stream(re.sub("^file:/+", "/", path)) as f:
                    body = f.read()
                rows.append((contest, time, body.decode(json.detect_encoding(body), "replace")))
                size += len(body)
                if size >= most:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)], names=names)

    return run


def _read_by_spark(shots: DataFrame, schema: T.StructType) -> DataFrame:
    """The same by Spark's reader, in any store."""
    spark = shots.sparkSession
    paths = [r["path"] for r in shots.select("path").collect()]  # as the reader takes a list
    with discovery(spark):
        found = spark.read.schema(schema).option("multiline", "true").json(paths).select("data.playbyplay.*")
    times = shots.select(F.col("contest_id").alias("_c"), "ingest_timestamp")
    return found.join(bounded(times, len(paths), TIME_BYTES), F.col("contestId") == F.col("_c"), "left").drop("_c")


def snapshot_times(spark: SparkSession, snapshots: list[Snapshot] | DataFrame) -> DataFrame:
    """The snapshots as a relation of contest_id and ingest_timestamp."""
    return listed(spark, snapshots).select("contest_id", "ingest_timestamp")


#: Paths of a task that looks which files exist.
LOOKED_AT = 2000
_LINE = "contest_id string, ingest_timestamp string, file_path string, status string"
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]+:/"


def manifest_lines(spark: SparkSession, manifest: files.Place) -> DataFrame:
    """Lines of a manifest, a file or a folder of parts. A missing one raises FileNotFoundError, a line that isn't JSON a ValueError."""
    if not files.exists(manifest):
        raise FileNotFoundError(str(manifest))
    lines = spark.read.text(str(manifest)).filter(F.trim("value") != "")
    if not lines.filter(F.try_parse_json("value").isNull()).isEmpty():
        raise ValueError(f"{manifest} has a line that isn't JSON")
    return lines


def snapshot_table(spark: SparkSession, manifest: files.Place | list[files.Place]) -> DataFrame:
    """The manifest, or some of them one behind the other, as a relation: of each contest the last stored version in file order whose file exists.

    Returns contest_id, ingest_timestamp, path. A manifest is a file, or a folder
    of parts in the order of their names. It and its files may be
    in any store that Spark reads; a path without a scheme may be relative to the
    manifest's folder, or only be right in its last part. Tasks look which files
    exist; no path passes through the driver. A missing manifest raises
    FileNotFoundError, a line that isn't JSON a ValueError.
    """
    manifests = manifest if isinstance(manifest, list) else [manifest]
    told = reduce(DataFrame.unionByName, [_stored(spark, files.place(m), k) for k, m in enumerate(manifests)])
    last = F.max_by(F.struct("ingest_timestamp", "path"), "place").alias("last")
    return told.groupBy("contest_id").agg(last).select("contest_id", "last.*")


def _stored(spark: SparkSession, manifest: files.Place, nth: int) -> DataFrame:
    """Stored versions of the nth manifest whose files exist: place (where the line is), contest_id, ingest_timestamp, path."""
    lines = manifest_lines(spark, manifest)
    place = F.struct(F.lit(nth).alias("manifest"), F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    entry = lines.select(place.alias("place"), F.from_json("value", _LINE).alias("e")).filter("e.status = 'STORED_NEW_VERSION' AND e.file_path != ''")
    folder, path = str(files.parent(manifest)), F.col("e.file_path")
    local = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(f"{os.getcwd()}/"), path))
    known = F.when(path.rlike(_SCHEME), F.array(path)).otherwise(F.array(local, F.concat(F.lit(f"{folder}/"), path), F.concat(F.lit(f"{folder}/"), F.element_at(F.split(path, "/"), -1))))
    told = entry.select("place", F.col("e.contest_id").cast("long").alias("contest_id"), F.col("e.ingest_timestamp").alias("ingest_timestamp"), known.alias("known"))
    return _existing(told, folder)


def _existing(rows: DataFrame, folder: str) -> DataFrame:
    """Rows (known: paths) with path, the first of them that is a file; rows without one go."""
    spark = rows.sparkSession
    if re.match(_SCHEME, folder) and not folder.startswith("file:"):
        return _listed(rows, folder)

    def run(batches):
        import os
        import re

        import pyarrow as pa

        for batch in batches:
            there = [next((p for p in known if os.path.exists(re.sub("^file:/+", "/", p))), None) for known in batch.column("known").to_pylist()]
            columns = [batch.column(c) for c in batch.schema.names if c != "known"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(there, pa.string())], names=[*(c for c in batch.schema.names if c != "known"), "path"])

    schema = f"place {rows.schema['place'].dataType.simpleString()}, contest_id long, ingest_timestamp string, path string"
    spread = rows.repartition(spark.sparkContext.defaultParallelism) if rows.limit(LOOKED_AT + 1).count() > LOOKED_AT else rows
    return spread.mapInArrow(run, schema).filter("path IS NOT NULL")


def _listed(rows: DataFrame, folder: str) -> DataFrame:
    """The same by a listing of the manifest's folder, which Spark's tasks make in any store."""
    bare = lambda p: F.regexp_replace(p, "^[^:/]+:(//[^/]*)?", "")
    with discovery(rows.sparkSession):
        there = rows.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(bare(F.col("path")).alias("_bare")).distinct()
    tried = rows.select("place", "contest_id", "ingest_timestamp", F.posexplode("known").alias("nth", "path"))
    found = tried.join(there, bare(F.col("path")) == F.col("_bare"), "left_semi")
    return found.groupBy("place", "contest_id", "ingest_timestamp").agg(F.min_by("path", "nth").alias("path"))


@contextmanager
def discovery(spark: SparkSession) -> Iterator[None]:
    """Let listings of many paths take a few tasks per core; Spark's own choice is a task per path up to ten thousand."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def latest_snapshots(manifest: files.Place) -> list[Snapshot]:
    """snapshot_table as a list by contest, for few snapshots."""
    found = snapshot_table(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate(), manifest)
    return sorted(tuple(r) for r in found.select("contest_id", "ingest_timestamp", "path").collect())


def pending_snapshots(spark: SparkSession, snapshots: list[Snapshot] | DataFrame, present: DataFrame | None, *, full_refresh: bool = False) -> list[Snapshot] | DataFrame:
    """Snapshots whose contest and time are not in present (a table, or None if there is none yet); a relation if snapshots are one, else a list."""
    if isinstance(snapshots, DataFrame):
        if full_refresh or present is None:
            return snapshots
        return snapshots.join(present.select("contest_id", "ingest_timestamp").distinct(), ["contest_id", "ingest_timestamp"], "left_anti").select(*snapshots.columns)
    if full_refresh or present is None or not snapshots:
        return list(snapshots)
    left = {(r[0], r[1]) for r in pending_snapshots(spark, listed(spark, snapshots), present).collect()}  # no more than were listed
    return [s for s in snapshots if (s[0], s[1]) in left]
