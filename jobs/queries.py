"""The jobs as queries: each runs its function twice into one new folder under the shared one, and reads the output back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobs.refresh_panels import current, refresh_panels
from jobs.screen_reads import screen_reads, screened
from strandsieve.plans import suite
from strandsieve.session import shared_folder


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def job1_screen_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _folder(spark, "job1")
    suite.QUERIES["panel_ids"](spark, sf_dir).write.parquet(f"{out}/panel")
    for _ in range(2):
        # A pattern, as a file stream takes a folder or a pattern, and a table may be one file.
        screen_reads(spark, f"{sf_dir}/documents*.parquet", f"{out}/panel", f"{out}/screened", f"{out}/progress", kmer_size=suite.K)
    return screened(spark, f"{out}/screened")


def job2_refresh_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _folder(spark, "job2")
    for _ in range(2):
        refresh_panels(spark, f"{sf_dir}/benchmark.parquet", f"{sf_dir}/conversations.parquet", f"{sf_dir}/documents.parquet", out, kmer_size=suite.K)
    return current(spark, out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (job1_screen_reads, job2_refresh_panels)}
SQL: dict[str, str] = {"job1_screen_reads": suite.SCREENED_READS, "job2_refresh_panels": suite.SQL["manifest_transition"]}
