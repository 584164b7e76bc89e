"""Session factory and job labels."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import SparkSession

#: Settings of a session, each with the environment variable that overrides it.
SETTINGS = {
    "spark.driver.memory": ("SCORELAKE_DRIVER_MEMORY", "4g"),
    "spark.driver.maxResultSize": ("SCORELAKE_MAX_RESULT", "4g"),
    "spark.default.parallelism": ("SCORELAKE_PARALLELISM", "4"),
    "spark.sql.shuffle.partitions": ("SCORELAKE_SHUFFLE_PARTITIONS", "32"),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("SCORELAKE_PARTITION_BYTES", "128m"),
}
FIXED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def create_session(app_name: str = "scorelake", *, master: str | None = None, event_log_dir: str | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution; environment variables and extra settings come last."""
    builder = SparkSession.builder.appName(app_name)
    if master or os.environ.get("SCORELAKE_MASTER"):
        builder = builder.master(master or os.environ["SCORELAKE_MASTER"])
    conf = FIXED | {k: os.environ.get(env, default) for k, (env, default) in SETTINGS.items()} | extra
    if event_log_dir:
        conf |= {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log_dir}
    return builder.config(map=conf).getOrCreate()


_LABELS = ("spark.jobGroup.id", "spark.job.description")


@contextmanager
def labelled(sc: SparkContext, group: str, description: str) -> Iterator[None]:
    """Label the jobs within, and give the caller's labels back afterwards."""
    before = [sc.getLocalProperty(k) for k in _LABELS]
    sc.setLocalProperty(_LABELS[0], group)
    sc.setLocalProperty(_LABELS[1], description)
    try:
        yield
    finally:
        for k, v in zip(_LABELS, before, strict=True):
            sc.setLocalProperty(k, v)
