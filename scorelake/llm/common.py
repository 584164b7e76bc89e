"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch that goes to a Python worker: both sides hold a few batches for each task.
ARROW_ROWS, ARROW_BYTES = 2000, 4 << 20
#: A side is broadcast only when a count has shown that it stays below this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of our own only where it is unset and all runs on one machine, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="scorelake-checkpoint-"))
    return sc.getCheckpointDir()


def _placed(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any store that Spark reads."""
    store, place = _placed(spark, path)
    return store.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all that is in it."""
    store, place = _placed(spark, path)
    store.delete(place, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and cut its lineage; what is written survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def prepare_python(spark: SparkSession) -> None:
    """Make this subpackage importable by Python workers, and lower an Arrow batch to ARROW_ROWS and ARROW_BYTES.

    The modules are shipped once per application, so that the executors need no
    copy of the repository.
    """
    sc = spark.sparkContext
    if not getattr(sc, "_scorelake_shipped", False):
        here = Path(__file__).parent
        target = Path(tempfile.mkdtemp(prefix="scorelake-"), "scorelake_llm.zip")
        with zipfile.ZipFile(target, "w") as out:
            for path in [here.parent / "__init__.py", *sorted(here.glob("*.py"))]:
                out.write(path, path.relative_to(here.parent.parent))
        sc.addPyFile(str(target))
        sc._scorelake_shipped = True
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def bounded(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Mark df for broadcast if its counted rows stay below BROADCAST_BYTES, else leave the choice to Spark."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of a text; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
