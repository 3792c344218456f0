"""What the jobs share: their config, their log, the session of a command line, and tables that may not be there yet."""

from __future__ import annotations

import argparse
import logging
import sys
import tomllib
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import Any

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from strandsieve.session import ready

log = logging.getLogger("jobs")


def settings(argv: list[str] | None, config: str, known: dict[str, type]) -> dict[str, Any]:
    """Values of the config file, overridden by options of the same names (`--batch-files 8`); unknown names are errors."""
    parser = argparse.ArgumentParser()
    parser.add_argument("--config", default=str(Path(__file__).with_name(config)))
    for name, kind in known.items():
        parser.add_argument(f"--{name.replace('_', '-')}", type=kind)
    given = vars(parser.parse_args(argv))
    values = tomllib.loads(Path(given.pop("config")).read_text())
    unknown = set(values) - set(known)
    if unknown:
        parser.error(f"unknown settings: {', '.join(sorted(unknown))}")
    values |= {name: v for name, v in given.items() if v is not None}
    missing = [name for name in known if name not in values]
    if missing:
        parser.error(f"settings without a value: {', '.join(missing)}")
    return {name: kind(values[name]) for name, kind in known.items()}


def session(name: str) -> SparkSession:
    """The session of a command line; where it runs and its shared folder come from spark-submit or the defaults file."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def prepared(spark: SparkSession) -> Iterator[None]:
    """The package on the workers and batches of a size for whole texts; the session's settings are as before at the end."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    ready(spark)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at a path, or None before anything was written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
