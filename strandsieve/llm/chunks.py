"""Document fingerprints by content-defined chunking.

A gear hash of the last 32 bytes is taken at every byte. Chunk ends are normalised: up to the normal size only a rarer
hash value ends a chunk, beyond it a commoner one, and the largest size ends it anyway; so sizes gather around the normal
one and, since ends depend on nearby bytes only, chunks after an edit or a shift are found again. A fingerprint is the
set of distinct chunks, each a digest with the chunk's length as its weight, written as base64 of sorted 64-bit values
(48 bits of digest, 16 of length). The likeness of two fingerprints is their containment: the weight of the shared
chunks over the smaller of the two weights.

Edge cases: null and empty texts have the empty fingerprint; two empty fingerprints are alike (1), an empty and another
are not (0); rows that share a doc_id are ordered by a hash of their text; a null doc_id comes last in descending order;
a single document is its own neighbour; an empty table gives an empty result; extra columns are ignored; very long texts
are chunked whole.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve.llm.bytescan import U64, WordHasher, seeded
from strandsieve.llm.common import partitions, schema, tidy_documents

SMALLEST, NORMAL, LARGEST = 16, 48, 192
#: Leading zero bits of the hash that end a chunk before and after the normal size.
STRICT, LOOSE = 7, 4
_GEAR = (seeded(11, 256) >> U64(32)).astype(np.uint32)
_DIGEST = WordHasher(12)
_EMPTY = np.zeros(0, U64)


def chunk_ends(data: np.ndarray) -> list[int]:
    """The end (exclusive) of each chunk of the bytes `data`."""
    n = len(data)
    if n <= SMALLEST:
        return [n] if n else []
    h = _GEAR[data]
    for k in range(5):  # sums over 1, 2, 4, ... 32 bytes
        span = 1 << k
        h[span:] += h[:-span] << np.uint32(span) if span < len(h) else np.uint32(0)
    loose = np.flatnonzero(h < np.uint32(1 << (32 - LOOSE)))
    strict = loose[h[loose] < np.uint32(1 << (32 - STRICT))].tolist()
    loose = loose.tolist()
    strict.append(n)
    loose.append(n)
    ends, start = [], 0
    while n - start > SMALLEST:
        end = strict[bisect_left(strict, start + SMALLEST - 1)]
        if end >= start + NORMAL - 1:
            end = min(loose[bisect_left(loose, start + NORMAL - 1)], start + LARGEST - 1)
        start = min(end + 1, n)
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def chunk_set(text: bytes) -> np.ndarray:
    """Sorted distinct chunks of a text: 48 bits of digest, 16 bits of length."""
    data = np.frombuffer(text, np.uint8)
    ends = np.array(chunk_ends(data), np.int64)
    if not len(ends):
        return _EMPTY
    starts = np.concatenate([[0], ends[:-1]])
    digest = _DIGEST(data, starts, ends)
    return np.unique((digest & ~U64(0xFFFF)) | (ends - starts).astype(U64))


def weight(chunks: np.ndarray) -> int:
    return int((chunks & U64(0xFFFF)).sum())


def shared(a: np.ndarray, b: np.ndarray) -> int:
    return weight(np.intersect1d(a, b, assume_unique=True))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Containment: shared weight over the smaller weight."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    return shared(a, b) / min(weight(a), weight(b))


def encode(chunks: np.ndarray) -> str:
    return base64.b64encode(chunks.astype("<u8").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and n_chunks of each row of `docs`; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [chunk_set(t.as_buffer()) if t.is_valid else _EMPTY for t in b.column(1).cast(pa.large_binary())]
            yield pa.record_batch({"doc_id": b.column(0), "fingerprint": pa.array([encode(s) for s in sets], pa.string()), "n_chunks": pa.array([len(s) for s in sets], pa.int64())})

    return tidy_documents(docs).mapInArrow(run, schema("doc_id long, fingerprint string, n_chunks long"))


def with_neighbours(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Rows dealt so that each document meets the one after it (descending doc_id; after the last comes the first).

    doc_ids are cut into ranges at approximate quantiles; a range is one group, sorted in its task. The first row of each
    range is sent to the range before it as well, marked `_tail`. Texts are shuffled once, and what reaches the driver is
    one number for each range.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = tidy_documents(docs).withColumn("_order", F.coalesce("doc_id", F.lit(-(1 << 63))))
    ids = rows.select("_order")
    wanted = buckets or 4 * n
    cuts = ids.agg(F.percentile_approx("_order", [k / wanted for k in range(1, wanted)] or [0.5], 10 * wanted)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def bucket(order: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, order.to_numpy(np.int64), "right").astype(np.int32))

    heads = sorted((r._bucket, r._head) for r in ids.groupBy(bucket("_order").alias("_bucket")).agg(F.max("_order").alias("_head")).collect())
    above = [b for b, _ in heads[1:]] + [b for b, _ in heads[:1]]
    tails = spark.createDataFrame([(h, b) for (_, h), b in zip(heads, above, strict=True)], "_head long, _to int")
    own = F.struct(F.col("_own").alias("_bucket"), F.lit(False).alias("_tail"))
    extra = F.struct(F.col("_to").alias("_bucket"), F.lit(True).alias("_tail"))
    dealt = (
        rows.withColumn("_own", bucket("_order"))
        .join(F.broadcast(tails), F.col("_order") == F.col("_head"), "left")
        .select("doc_id", "text", "_order", F.explode(F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, extra))).alias("_at"))
        .select("doc_id", "text", "_order", "_at.*")
    )
    return dealt.repartition(n, "_bucket").sortWithinPartitions("_bucket", "_tail", F.desc("_order"), F.xxhash64("text"), "text").select("doc_id", "text", "_bucket", "_tail")


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_chunks long, next_doc_id long"
)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document with its edited text: its last third of code points gives way to the first as many of the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f.split()[0] for f in EDITED.split(", ")]
        out: list[tuple] = []
        last = None  # the row that waits for its next one

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
            return pa.record_batch([pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns, EDITED.split(", "), strict=True)], names=fields)

        size = 0
        for b in batches:
            for doc_id, text, at, tail in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if tail and (last is None or last[3] != at):
                    continue  # a second row that shares the head's doc_id
                own = chunk_set(text.encode())
                if last is not None and last[3] == at:
                    before_id, before, before_set, _ = last
                    n = len(before)
                    edited = (before[: n - n // 3] + text[: n // 3]).encode()
                    edited_set = chunk_set(edited)
                    out.append((
                        before_id, n, hashlib.sha256(edited).hexdigest(), encode(before_set), encode(edited_set),
                        likeness(before_set, edited_set), likeness(before_set, own), len(before_set), doc_id,
                    ))
                    size += len(own)
                last = None if tail else (doc_id, text, own, at)
                if size > 200_000 or len(out) >= 2000:
                    size = 0
                    if out:
                        yield flush()
        if out:
            yield flush()

    return with_neighbours(docs).mapInArrow(run, schema(EDITED))
