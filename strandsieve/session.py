"""What a session needs for this package: its code on the workers, batches of bounded size, and a shared folder for cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROOT = str(Path(__file__).resolve().parent.parent)
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()
_made: list[tuple[SparkSession, str]] = []


def ready(spark: SparkSession) -> SparkSession:
    """Puts the package on the workers' path: by PYTHONPATH on one machine, by a shipped archive on a cluster.

    Rows here hold whole texts, so a batch of rows that goes to Python is made smaller where the default stands.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "2000")
    if _ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep) or sc.applicationId in _shipped:
        return spark
    if sc.master.startswith("local[") or sc.master == "local":
        old = sc.environment.get("PYTHONPATH", "")
        sc.environment["PYTHONPATH"] = os.pathsep.join([_ROOT, old]) if old else _ROOT
    else:
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/strandsieve", "zip", _ROOT, "strandsieve")
        sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all executors see; only on one machine, and only where it is unset, a local folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.gettempdir() + "/strandsieve-shared"
    return root


def fresh_path(spark: SparkSession, what: str) -> str:
    """A path of its own in the shared folder; what is there goes when the driver ends."""
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def settled(df: DataFrame) -> DataFrame:
    """The same rows from a Parquet table in the shared folder: plans stay short, and a lost executor loses nothing of it."""
    path = fresh_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(table: DataFrame, most: int = 32_000_000) -> DataFrame:
    """Marks a written table for broadcast if its rows are shown to take at most `most` bytes; else Spark shuffles it."""
    size = F.lit(16 * len(table.columns) + 16)
    for f in table.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
    taken = table.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(table) if taken <= most else table


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table wherever it is; a local one even when the session has ended."""
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001  the JVM may be gone
        if path.startswith("file://"):
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


@atexit.register
def _sweep() -> None:
    for spark, path in _made:
        remove(spark, path)
