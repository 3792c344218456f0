"""Read counts kept up as files arrive: a file stream over a folder of read tables, each new file counted once.

A restart with the same checkpoint counts only what is new, as a cached run would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strandsieve.operators.reads import count_panel_kmers

ARRIVING = "design_id string, metagenome_id string, ordinal long, sequence string"


def stream_read_counts(spark: SparkSession, arriving: str, panel: DataFrame, k: int, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Starts the stream; `once`: takes what is there and ends. A source must arrive in one file, as its order is its identity."""
    stream = spark.readStream.schema(ARRIVING).option("maxFilesPerTrigger", 64).parquet(arriving)

    def count(batch: DataFrame, number: int) -> None:
        # A repeated batch writes the same folder again.
        count_panel_kmers(batch, panel, k).drop("sequence").write.mode("overwrite").parquet(f"{out}/batch={number:08d}")

    writer = stream.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
