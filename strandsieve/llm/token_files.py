"""Documents to token files in ascending doc_id order, and back.

One range-partitioned shuffle brings the documents in order; each task streams its range into one file (first under a
name of its own attempt, then renamed, so that a repeated or lost task leaves nothing half-written in place). The
manifest, one row for each file, is all that reaches the driver. Reading decompresses and checks every frame.

Edge cases: null text is empty, so the document is its end id alone; null doc_id sorts first and is kept as null; rows
that share a doc_id are each written, ordered by a hash of their text; an empty table writes no file and reads as an
empty result; extra columns are ignored; very long texts take one frame of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandsieve.llm.bytescan import release_memory
from strandsieve.llm.common import partitions, scratch, tidy_documents
from strandsieve.llm.seekable import Reader, Writer
from strandsieve.llm.tokens import encoder


@dataclass(frozen=True)
class TokenFile:
    path: str
    n_docs: int
    n_tokens: int
    start: int


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, width: int | None = None, files: int | None = None) -> list[TokenFile]:
    """Writes `docs` below `folder` and returns the files in order; `start` counts the ids of all files before.

    `width`: bytes of an id; unset, two if all of the tokenizer's ids fit, else four.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        encode, writer, sink = encoder(tokenizer), None, None
        context = TaskContext.get()
        store, root = _store(folder)
        name = f"{root}/part-{context.partitionId():06d}.ids.zst"
        own = f"{name}.{context.taskAttemptId()}"
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), encode.ids(b.column(1)), strict=True):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    sink = store.open_output_stream(own)
                    writer = Writer(sink, width or (2 if max(encode.most, end_id) < 1 << 16 else 4))
                writer.add(doc_id, np.append(ids, np.uint32(end_id)))
        if writer is not None:
            writer.finish()
            sink.close()
            store.move(own, name)
            yield pa.record_batch({
                "part": pa.array([context.partitionId()], pa.int64()),
                "n_docs": pa.array([len(writer.ids)], pa.int64()),
                "n_tokens": pa.array([writer.tokens], pa.int64()),
            })

    n = files or partitions(docs.sparkSession)
    ordered = (
        tidy_documents(docs)
        .repartitionByRange(n, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )
    done = ordered.mapInArrow(run, "part long, n_docs long, n_tokens long").collect()  # a row for each file
    out, start = [], 0
    for r in sorted(done, key=lambda r: r.part):
        out.append(TokenFile(f"{folder}/part-{r.part:06d}.ids.zst", r.n_docs, r.n_tokens, start))
        start += r.n_tokens
    return out


def read_token_files(spark: SparkSession, listed: list[TokenFile]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files' frames; a task for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in b.column(0).to_pylist():
                store, path = _store(listed[k].path)
                with store.open_input_file(path) as source:
                    reader = Reader(source)
                    crc = [zlib.crc32(ids.tobytes()) for ids in reader]
                    n = reader.n_tokens
                    yield pa.record_batch({
                        "doc_id": pa.array(reader.doc_ids, pa.int64()),
                        "start": pa.array(np.concatenate([[0], np.cumsum(n)])[:-1].astype(np.int64) + listed[k].start),
                        "n_tokens": pa.array(n),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    })

    ids = spark.range(0, len(listed), 1, max(1, len(listed)))
    return ids.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digests(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Writes the documents and returns the digest of what the files then hold."""
    spark = docs.sparkSession
    listed = write_token_files(docs, tokenizer, folder or scratch(spark, "ids"))
    return read_token_files(spark, listed)
