"""Duplicate passages: an exact join of 20-word windows to their first place, then a greedy parse of each document by it.

What decides is the join: every window that the collection holds earlier (smaller doc_ids, or the same document before) is
found with its first place. The parse that follows (`parse`) puts these windows together in the manner of relative Lempel-Ziv:
a factor starts at the first such window and goes on as long as the next window stands next in the reference too, the next
factor starts behind its last word, and windows that straddle a factor's end are added there. Its spans are those of all
windows, so the parse changes no result; as each window has one place only, a factor may be shorter than the longest match.

How the index stays small: of each window only its anchor is shared first, the least hash among its 8-word sequences
(about one anchor for seven words). Equal windows have equal anchors, so a window whose anchor occurs once in the whole
collection is new, and its hash is never shuffled. Only windows with a repeated anchor are looked up, by 96 bits of hash.
The first place of a window is the first of its key in order of place; keys under anchors that occur more than `HOT` times
are dealt out, by document, into as many parts as the root of their number, and the firsts of the parts are compared next,
so that no passage, however common, is gathered in one task.

Edge cases: null text has no words; windows are judged on the input; rows that repeat a doc_id are judged each by its own
windows, an equal word number in them counting as the same place; a null doc_id sorts before all others; texts under 20
words lose nothing; an empty table gives an empty result; extra columns are ignored; very long texts are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandsieve.llm.bytescan import U64, NgramHasher, WordHasher, hashed_words, mix
from strandsieve.llm.common import bounded, discard, partitions, tidy_documents, written

WINDOW, ANCHOR = 20, 8
#: Occurrences of an anchor beyond which its windows are dealt out in parts.
HOT = 2000
#: Bytes of documents' repeated anchors, or of their spans, that may be broadcast at once.
MOST_BYTES = 96_000_000
_LEAST = -(1 << 63)
_FIRST, _SECOND = WordHasher(71), WordHasher(72)
_ANCHOR, _WINDOW_A, _WINDOW_B = NgramHasher(ANCHOR, 73), NgramHasher(WINDOW, 74), NgramHasher(WINDOW, 75)
_SPREAD = WINDOW - ANCHOR + 1


def _keyed(docs: DataFrame) -> DataFrame:
    """doc, tag, doc_id and text of each row; tag tells apart the texts of rows that share a doc_id, and is 0 for all others."""
    rows = tidy_documents(docs).select(F.coalesce("doc_id", F.lit(_LEAST)).alias("doc"), "doc_id", "text")
    again, _ = written(rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc", F.lit(True).alias("again")), "again")
    if again.isEmpty():
        return rows.withColumn("tag", F.lit(0).cast("long"))
    tag = F.when(F.col("again"), F.xxhash64("text")).otherwise(0)
    return rows.join(bounded(again), "doc", "left").select("doc", "doc_id", "text", tag.alias("tag"))


def window_anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window of a document, and the hashes of all its 8-word sequences."""
    grams = _ANCHOR(words)
    least, span = grams, 1
    while span * 2 <= _SPREAD:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < _SPREAD:
        least = np.minimum(least[: len(least) - (_SPREAD - span)], least[_SPREAD - span :])
    return least, grams


def anchors(rows: DataFrame) -> DataFrame:
    """anchor, doc, tag and times (2 if it may occur more than once in the document) for each distinct anchor of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, tags = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            values, docs_of, tag_of, times = [np.zeros(0, U64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int8)]
            for i, (words,) in hashed_words(b.column(2), [_FIRST]):
                if len(words) < WINDOW:
                    continue
                least, grams = window_anchors(words)
                own = np.unique(least[np.concatenate([[True], least[1:] != least[:-1]])])
                grams.sort()
                again = np.unique(grams[1:][grams[1:] == grams[:-1]])
                twice = np.isin(own, again, assume_unique=True) if len(again) else np.zeros(len(own), bool)
                values.append(own)
                docs_of.append(np.full(len(own), ids[i]))
                tag_of.append(np.full(len(own), tags[i]))
                times.append(1 + twice.astype(np.int8))
            yield pa.record_batch({
                "anchor": pa.array(np.concatenate(values).view(np.int64)), "doc": pa.array(np.concatenate(docs_of)),
                "tag": pa.array(np.concatenate(tag_of)), "times": pa.array(np.concatenate(times)),
            })

    return rows.select("doc", "tag", "text").mapInArrow(run, "anchor long, doc long, tag long, times byte")


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """For each document with repeated anchors: doc, tag, its cold and hot ones, and the parts of the hot. A written table."""
    spark = rows.sparkSession
    all_anchors, path = written(anchors(rows), "anchors")
    counted = all_anchors.groupBy("anchor").agg(F.sum("times").alias("times")).where("times > 1")
    parts = F.when(F.col("times") > HOT, F.ceil(F.sqrt("times"))).otherwise(0).cast("int")
    counted, counted_path = written(counted.select("anchor", parts.alias("parts")), "repeated")
    hits = all_anchors.select("anchor", "doc", "tag").join(bounded(counted), "anchor")
    cold = F.collect_list(F.when(F.col("parts") == 0, F.col("anchor"))).alias("cold")
    hot = F.collect_list(F.when(F.col("parts") > 0, F.struct("anchor", "parts"))).alias("_hot")
    per, _ = written(hits.groupBy("doc", "tag").agg(cold, hot).select("doc", "tag", "cold", F.col("_hot.anchor").alias("hot"), F.col("_hot.parts").alias("parts")), "hits")
    discard(spark, path)
    discard(spark, counted_path)
    return per


def _windows(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """k1, k2, part, doc, tag, start of each window whose anchor is among the document's in `hits`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "part", "doc", "tag", "start"]
        for b in batches:
            ids, tags = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            spread = mix(ids.astype(np.int64).view(U64)) >> U64(1)
            cold, hot, parts_of_hot = b.column(3), b.column(4), b.column(5)
            out: list[tuple[np.ndarray, ...]] = []
            size = 0
            for i, (first, second) in hashed_words(b.column(2), [_FIRST, _SECOND]):
                if len(first) < WINDOW:
                    continue
                least, _ = window_anchors(first)
                few = np.asarray(hot[i].values, np.int64)
                anchor = np.concatenate([np.asarray(cold[i].values, np.int64), few]).view(U64)
                part_of = np.concatenate([np.zeros(len(anchor) - len(few), np.int64), np.asarray(parts_of_hot[i].values, np.int64)])
                order = np.argsort(anchor)
                at = order[np.minimum(np.searchsorted(anchor, least, sorter=order), len(anchor) - 1)]
                chosen = np.flatnonzero(anchor[at] == least)
                if len(chosen):
                    parts = part_of[at[chosen]]
                    k1 = _WINDOW_A(first)[chosen].view(np.int64)
                    k2 = (_WINDOW_B(second)[chosen] >> U64(32)).astype(np.uint32).view(np.int32)
                    part = np.where(parts > 0, np.int64(spread[i]) % np.maximum(parts, 1), -1).astype(np.int32)
                    out.append((k1, k2, part, np.full(len(chosen), ids[i]), np.full(len(chosen), tags[i]), chosen.astype(np.int32)))
                    size += len(chosen)
                if size > 200_000:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=names)
                    out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=names)

    return rows.join(bounded(hits, MOST_BYTES), ["doc", "tag"]).select("doc", "tag", "text", "cold", "hot", "parts").mapInArrow(run, "k1 long, k2 int, part int, doc long, tag long, start int")


def earlier_windows(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """doc, tag, start, ref_doc, ref_start of each window that starts earlier too, with an earlier place that it starts at.

    The first of a window's places within each part is found first, then the first of those.
    """
    place = F.struct("doc", "start")
    late = (F.col("first.doc") != F.col("doc")) | (F.col("first.start") != F.col("start"))

    def with_first(windows: DataFrame, *keys: str) -> DataFrame:
        return windows.withColumn("first", F.first(place).over(Window.partitionBy(*keys).orderBy("doc", "start")))

    found = with_first(_windows(rows, hits), "k1", "k2", "part").where(late)
    hot = hits.where(F.size("hot") > 0).withColumn("cold", F.array().cast("array<bigint>"))
    if not hot.isEmpty():
        leaders = with_first(_windows(rows, hot), "k1", "k2", "part").where(~late).drop("first")
        found = found.unionByName(with_first(leaders, "k1", "k2").where(late))
    return found.select("doc", "tag", "start", F.col("first.doc").alias("ref_doc"), F.col("first.start").alias("ref_start"))


def parse(starts: np.ndarray, ref_docs: np.ndarray, ref_starts: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
    """Duplicate spans of one document, and its factors (from, to, reference document, reference start), words, end exclusive.

    The arguments are the document's windows that the reference holds, in order, and where.
    """
    n = len(starts)
    follows = (starts[1:] == starts[:-1] + 1) & (ref_docs[1:] == ref_docs[:-1]) & (ref_starts[1:] == ref_starts[:-1] + 1)
    ends = np.append(np.flatnonzero(~follows), n - 1)  # of stretches that advance in step
    factors, covered, at = [], [], 0
    while at < n:
        last = int(ends[np.searchsorted(ends, at)])
        begin, end = int(starts[at]), int(starts[last]) + WINDOW
        factors.append((begin, end, int(ref_docs[at]), int(ref_starts[at])))
        after = int(np.searchsorted(starts, end))
        covered.append((begin, end))
        covered += [(x, x + WINDOW) for x in starts[last + 1 : after].tolist()]  # windows that straddle the factor's end
        at = after
    spans: list[tuple[int, int]] = []
    for begin, end in covered:  # begins ascend
        if spans and begin <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((begin, end))
    return spans, factors


def duplicate_spans(rows: DataFrame) -> DataFrame:
    """doc, tag, spans (array of first and end word) and n_factors of each row of `_keyed` that repeats something earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64) for _ in range(5)]

        def ends(rows: list[np.ndarray]) -> np.ndarray:
            return np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1

        def closed(rows: list[np.ndarray]) -> pa.RecordBatch:
            docs_of, tags, spans, n = [], [], [], []
            cuts = ends(rows).tolist()
            for a, z in zip([0, *cuts], [*cuts, len(rows[0])], strict=True):
                one = a + np.flatnonzero(np.diff(rows[2][a:z], prepend=-1))  # rows that are equal give their windows twice
                s, f = parse(rows[2][one], rows[3][one], rows[4][one])
                docs_of.append(int(rows[0][a]))
                tags.append(int(rows[1][a]))
                spans.append([x for pair in s for x in pair])
                n.append(len(f))
            return pa.record_batch({"doc": pa.array(docs_of, pa.int64()), "tag": pa.array(tags, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int32())), "n_factors": pa.array(n, pa.int64())})

        for b in batches:
            new = [b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
            held = [np.concatenate([h, x]) for h, x in zip(held, new, strict=True)]
            cuts = ends(held)
            if len(cuts):  # sorted by row: all but the last are complete
                yield closed([h[: cuts[-1]] for h in held])
                held = [h[cuts[-1] :] for h in held]
        if len(held[0]):
            yield closed(held)

    hits = repeated_anchors(rows)
    found = earlier_windows(rows, hits)
    met = found.repartition(partitions(rows.sparkSession), "doc", "tag").sortWithinPartitions("doc", "tag", "start")
    spans, _ = written(met.mapInArrow(run, "doc long, tag long, spans array<int>, n_factors long"), "spans")
    return spans


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and n_factors of each row."""
    rows = _keyed(docs)
    spans = duplicate_spans(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, sha = [], [], []
            for text, listed in zip(b.column(1).cast(pa.large_binary()), b.column(2).to_pylist(), strict=True):
                words = text.as_py().split()
                kept = words
                if listed:
                    kept, at = [], 0
                    for a, z in zip(listed[::2], listed[1::2], strict=True):
                        kept += words[at:a]
                        at = z
                    kept += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.record_batch(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()), b.column(3)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "n_factors"],
            )

    whole = rows.join(bounded(spans, MOST_BYTES), ["doc", "tag"], "left").select("doc_id", "text", "spans", F.coalesce("n_factors", F.lit(0)).cast("long").alias("n_factors"))
    return whole.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, n_factors long")


__all__ = ["anchors", "duplicate_spans", "earlier_windows", "parse", "without_repeats"]
