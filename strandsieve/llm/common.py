"""What the text operators share: tables, shared storage, checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side of a join is broadcast only if its rows have been shown to take at most so many bytes.
BROADCAST_BYTES = 32_000_000
#: The six characters that separate words: space, tab, newline, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """A folder that the driver and all executors see.

    It is `spark.checkpoint.dir`; only where that is unset (one machine, tests) a local folder is taken.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.gettempdir() + "/strandsieve-shared"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


_made: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder; removed when the driver ends, or by `discard`."""
    path = f"{shared_root(spark)}/strandsieve-{uuid.uuid4().hex}/{what}"
    _made.append((spark, path))
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Removes a scratch table that no later read needs."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path.rsplit("/", 1)[0])
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _sweep() -> None:
    for spark, path in _made:
        try:
            discard(spark, path)
        except Exception:  # noqa: BLE001  the JVM may be gone already
            return


def written(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """The same rows from a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def bytes_of(df: DataFrame) -> int:
    """What the rows of a written table take: eight bytes a number, 16 a row, and strings and arrays by their lengths."""
    fixed, wide = 16, []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            element = f.dataType.elementType
            each = 16 + 8 * len(element.fields) if isinstance(element, T.StructType) else 8
            wide.append(F.greatest(F.size(f.name), F.lit(0)) * F.lit(each))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            wide.append(F.octet_length(f.name))
        fixed += 8 * (2 + len(f.dataType.fields) if isinstance(f.dataType, T.StructType) else 1)
    if not wide:
        return fixed * df.count()  # from the file footers
    n, more = df.agg(F.count(F.lit(1)), sum((F.coalesce(F.sum(w.cast("long")), F.lit(0)) for w in wide), F.lit(0))).first()
    return fixed * n + more


def bounded(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Marks `df`, a written table, for broadcast if its rows take at most `most` bytes; else Spark shuffles it."""
    return F.broadcast(df) if bytes_of(df) <= most else df


def tidy_documents(docs: DataFrame, *more: str) -> DataFrame:
    """`doc_id` as long and `text` with null as empty; whatever other columns there are is left out unless named."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def packed(df: DataFrame) -> DataFrame:
    """All columns in one struct `_row`, so that columns added beside it can clash with none."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)
