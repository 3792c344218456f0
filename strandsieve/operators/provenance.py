"""Provenance: which inputs, parameters and versions made a result, as sorted tables with unique keys."""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strandsieve import contracts

INPUTS = ("input_role", "input_id", "attribute", "value")
PARAMETERS = ("parameter", "value")
VERSIONS = ("component", "version")


def json_rows(text: str, keys: Sequence[str], what: str) -> list[tuple[str, ...]]:
    """Rows of a base64 JSON array of objects with exactly these keys and single-line, nonblank values."""
    try:
        rows = json.loads(base64.b64decode(text, validate=True))
    except ValueError as e:
        raise contracts.ContractError(f"{what}: not base64 JSON") from e
    if not isinstance(rows, list) or any(not isinstance(r, dict) or set(r) != set(keys) for r in rows):
        raise contracts.ContractError(f"{what}: every row needs exactly {list(keys)}")
    out = [tuple(r[k] for k in keys) for r in rows]
    if any(not isinstance(v, str) or not v.strip() or "\n" in v or "\r" in v for r in out for v in r):
        raise contracts.ContractError(f"{what}: values must be single-line text")
    return out


def file_facts(spark: SparkSession, files: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Facts of (role, id, kind, path): a file's name and SHA-256, a directory's name.

    A file is digested by one task, as a digest is sequential, but in pieces, so its size does not matter.
    """
    ddl = "input_role string, input_id string, attribute string, value string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for i in batch.column(0).to_pylist():
                role, name, kind, path = files[i]
                facts = [("directory" if kind == "directory" else "filename", path.rstrip("/").rsplit("/", 1)[-1])]
                if kind != "directory":
                    store, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
                    digest = hashlib.sha256()
                    with store.open_input_stream(at, compression=None) as stream:
                        while piece := stream.read(1 << 20):
                            digest.update(piece)
                    facts.append(("sha256", digest.hexdigest()))
                columns = [[role] * len(facts), [name] * len(facts), *zip(*facts, strict=True)]
                yield pa.record_batch([pa.array(c, pa.string()) for c in columns], names=list(INPUTS))

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(run, ddl)


def provenance(inputs: DataFrame, parameters: DataFrame, versions: DataFrame, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables, versions without repeats, with unique keys (within `keys`, such as design_id), sorted."""
    versions = versions.distinct()
    contracts.require_unique(inputs, [*keys, "input_role", "input_id", "attribute"], "input facts")
    contracts.require_unique(parameters, [*keys, "parameter"], "parameters")
    contracts.require_unique(versions, [*keys, "component"], "software versions")
    return inputs.orderBy(*keys, "input_role", "input_id", "attribute"), parameters.orderBy(*keys, "parameter"), versions.orderBy(*keys, "component")
