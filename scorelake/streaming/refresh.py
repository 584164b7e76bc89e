"""Continuous refresh: new snapshot files become versions of the play table as they arrive."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.silver import plays_of
from ..plans import store
from ..sources.documents import DOCUMENT


def document_stream(spark: SparkSession, folder: str | Path) -> DataFrame:
    """Documents of a folder of snapshot files contest_id=<id>/ingest_timestamp=<time>.json, as they appear."""
    raw = spark.readStream.schema(DOCUMENT).option("multiline", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(str(folder))
    stamp = F.regexp_extract(F.col("_metadata.file_path"), r"ingest_timestamp=([^/]+)\.json$", 1)
    return raw.select("data.playbyplay.*", stamp.alias("ingest_timestamp")).withColumnRenamed("contestId", "contest_id")


def refresh_plays(spark: SparkSession, folder: str | Path, table: str | Path, checkpoint: str | Path, *, files: int | None = None) -> StreamingQuery:
    """Replace the plays of every contest that a batch brings; of several versions in a batch the latest counts.

    The table swaps whole versions, so a batch that is repeated after a failure
    gives the same table again.
    """

    def replace(batch: DataFrame, _: int) -> None:
        latest = batch.withColumn("_k", F.row_number().over(Window.partitionBy("contest_id").orderBy(F.col("ingest_timestamp").desc()))).filter("_k = 1").drop("_k")
        keys = [r[0] for r in latest.select("contest_id").distinct().collect()]  # as many as files in the batch
        if keys:
            fresh = plays_of(latest.select("contest_id", "ingest_timestamp", "teams", "periods"))
            store.replace_keys(batch.sparkSession, table, fresh, "contest_id", keys if store.has_table(table) else None, files=files)

    stream = document_stream(spark, folder)
    return stream.writeStream.foreachBatch(replace).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
