"""Benchmark decontamination: rare pairs of words as seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and characters beyond ASCII, lower-cased. Where enough seeds of an item lie near each
other in a document, the passage around them is aligned with the item, word by word: 4 for a match, -1 for a mismatch or a
gap. The score is the best local alignment over that of the whole item with itself; 0.75 and more is a leak, so about a
fifth of an item's words may be replaced or dropped, or about as many added as it has.

The seeds lose no such alignment. Seeds are ordered pairs of an item's words, next to each other or with one between them,
and are looked for at both distances in documents. An alignment of 0.75 over an item of n words has m <= n matches and at
most 4m - 3n other columns; of its m - 1 steps from match to match at most half as many have two others or more, so at least
ceil(n/2) - 1 steps are such pairs, at as many places of the document, within the 2n words that it can span. Every pair of the
items is counted over the whole corpus in one scan. Pairs that the corpus lacks are missed in any case; of the others each item
leaves out its most frequent ones, at most half of the steps that an alignment must have, and the rarer ones stay. A second
scan looks for the rest of those steps near each other. Words may be as common as they like: what is stored are meetings of
pairs. Two further bounds on the score, without regard to the words' order, come before the alignment.

The test items are the stated query set: they are taken in blocks of bounded bytes, each block a pass of its own, so that
what is sent to the tasks has a bound whatever the benchmark's size. Documents are never shuffled.

Edge cases: items of fewer than three words are no evidence and match nothing; null and empty texts on either side match
nothing; repeated documents and items are matched each; empty tables give an empty result; extra columns are ignored by
`leaks` and kept by `without_leaks`; very long texts are searched whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve.llm.bytescan import MARKS, U64, WordHasher, hashed_words, mix, released
from strandsieve.llm.common import tidy_documents

#: Words of the shortest item that is evidence.
LEAST_WORDS = 3
THRESHOLD = 0.75
MATCH, OTHER = 4, 1
BLOCK_BYTES = 4 << 20
_BITS = 22
_WORD, _PAIR = WordHasher(81), U64(0x9E6C63D0876A9A47)


def _words_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for i, (w,) in hashed_words(pc.utf8_lower(column), [_WORD], between=MARKS):
        yield i, w


def _pairs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ordered pairs of words one and two places apart, and the places of their first words."""
    first = words * _PAIR
    return np.concatenate([mix(first[:-d] + words[d:]) for d in (1, 2)]), np.concatenate([np.arange(max(len(words) - d, 0)) for d in (1, 2)])


def steps(n: int) -> int:
    """Pairs that every alignment of the threshold over n words has at least."""
    return -(-n // 2) - 1


@dataclass
class Items:
    """A block of test items: ids, words, and their distinct pairs with one bit for their leading bits for quick refusal."""

    ids: list[int]
    words: list[np.ndarray]
    distinct: np.ndarray
    bits: np.ndarray

    @classmethod
    def of(cls, ids: list[int], texts: list[str]) -> Items:
        words = [w for _, w in _words_of(pa.array(texts, pa.string()))]
        keep = [k for k, w in enumerate(words) if len(w) >= LEAST_WORDS]
        ids, words = [ids[k] for k in keep], [words[k] for k in keep]
        distinct = np.unique(np.concatenate([np.zeros(0, U64), *(_pairs(w)[0] for w in words)]))
        return cls(ids, words, distinct, _bits(distinct))


def _bits(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << _BITS, bool)
    bits[(hashes >> U64(64 - _BITS)).astype(np.int64)] = True
    return bits


def _lookup(hashes: np.ndarray, known: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the hashes that are among `known`, and their places there."""
    some = np.flatnonzero(bits[(hashes >> U64(64 - _BITS)).astype(np.int64)])
    if not len(known):
        return some, some
    at = np.minimum(np.searchsorted(known, hashes[some]), len(known) - 1)
    hit = known[at] == hashes[some]
    return some[hit], at[hit]


def corpus_counts(docs: DataFrame, items: Items) -> np.ndarray:
    """Occurrences of each of the items' pairs in the whole corpus; as many numbers as the block has distinct pairs."""
    shared = docs.sparkSession.sparkContext.broadcast((items.distinct, items.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct, bits = shared.value
        counts = np.zeros(len(distinct), np.int64)
        for b in batches:
            for _, w in _words_of(b.column(0)):
                if len(w) >= LEAST_WORDS:
                    np.add.at(counts, _lookup(_pairs(w)[0], distinct, bits)[1], 1)
        some = np.flatnonzero(counts)
        yield pa.record_batch({"pair": pa.array(some, pa.int64()), "n": pa.array(counts[some])})

    total = np.zeros(len(items.distinct), np.int64)
    found = docs.select("text").mapInArrow(released(run), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    total[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return total


@dataclass
class Seeds:
    """Seed pairs, the items that each stands for, and at how many places near each other an alignment must meet an item's seeds."""

    pairs: np.ndarray
    bits: np.ndarray
    first: np.ndarray
    item: np.ndarray
    least: np.ndarray
    span: np.ndarray

    @classmethod
    def of(cls, items: Items, counts: np.ndarray) -> Seeds:
        pairs, item = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        least = np.zeros(len(items.ids), np.int64)
        for k, own in enumerate(items.words):
            keys, times = np.unique(_pairs(own)[0], return_counts=True)
            n = counts[np.searchsorted(items.distinct, keys)]
            keys, times, n = keys[n > 0], times[n > 0], n[n > 0]
            need = steps(len(own))
            if times.sum() < need:
                continue  # the corpus lacks too many of its pairs
            common = np.lexsort((keys, -n))
            left = int(np.searchsorted(np.cumsum(times[common]), need // 2, "right"))
            pairs.append(keys[common[left:]])
            item.append(np.full(len(common) - left, k))
            least[k] = need - int(times[common[:left]].sum())
        all_pairs, all_items = np.concatenate(pairs), np.concatenate(item)
        order = np.argsort(all_pairs, kind="stable")
        own, first = np.unique(all_pairs[order], return_index=True)
        return cls(own, _bits(own), np.append(first, len(order)), all_items[order], least, np.array([2 * len(w) for w in items.words]))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and the end (exclusive) of its part of the passage."""
    ramp = np.arange(len(passage) + 1) * OTHER
    above = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = above - OTHER
        np.maximum(row[1:], above[:-1] + np.where(passage == word, MATCH, -OTHER), out=row[1:])
        np.maximum(row, 0, out=row)
        above = np.maximum.accumulate(row + ramp) - ramp  # gaps along the passage
        k = int(above.argmax())
        if above[k] > best:
            best, end = int(above[k]), k
    return best, end


def _bounded_below(own: np.ndarray, passage: np.ndarray) -> bool:
    """Whether no alignment can reach the threshold, whatever the order of the words."""
    if np.isin(own, passage).mean() < THRESHOLD:
        return True
    gain = np.concatenate([[0], np.cumsum(np.where(np.isin(passage, own), MATCH, -OTHER))])
    return bool((gain - np.minimum.accumulate(gain)).max() < THRESHOLD * MATCH * len(own))


def _found(words: np.ndarray, items: Items, seeds: Seeds) -> Iterator[tuple[int, float, int, int, int]]:
    """(item, score, first word, end word, seeds) of the best passage for each item that this document leaks."""
    keys, at = _pairs(words)
    some, place = _lookup(keys, seeds.pairs, seeds.bits)
    if not len(some):
        return
    position = at[some]
    n = seeds.first[place + 1] - seeds.first[place]
    entry = np.repeat(seeds.first[place] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    item, position = seeds.item[entry], np.repeat(position, n)
    order = np.lexsort((position, item))
    item, position = item[order], position[order]
    new = np.ones(len(item), bool)  # a place counts once
    new[1:] = (item[1:] != item[:-1]) | (position[1:] != position[:-1])
    item, position = item[new], position[new]
    last = np.arange(len(item)) + seeds.least[item] - 1
    within = np.minimum(last, len(item) - 1)
    met = np.flatnonzero((last < len(item)) & (item[within] == item) & (position[within] - position < seeds.span[item]))
    if not len(met):
        return
    whose, span = item[met], seeds.span[item[met]]
    low, high = np.maximum(position[met] - span, 0), position[last[met]] + span
    new = np.ones(len(met), bool)
    new[1:] = (whose[1:] != whose[:-1]) | (low[1:] > high[:-1])
    first = np.flatnonzero(new)
    best: dict[int, tuple[float, int, int, int]] = {}
    for a, z in zip(first.tolist(), [*first[1:].tolist(), len(met)], strict=True):
        k, start = int(whose[a]), int(low[a])
        own, passage = items.words[k], words[start : int(high[z - 1])]
        if _bounded_below(own, passage):
            continue
        score, end = align(own, passage)
        if score >= THRESHOLD * MATCH * len(own) and score / (MATCH * len(own)) > best.get(k, (0.0,))[0]:
            back = align(own[::-1], passage[:end][::-1])[1]
            found = slice(*np.searchsorted(item, [k, k + 1]))
            n_seeds = int(((position[found] >= start + end - back) & (position[found] < start + end)).sum())
            best[k] = (score / (MATCH * len(own)), start + end - back, start + end, n_seeds)
    for k, rest in sorted(best.items()):
        yield k, *rest


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks of about `most` bytes of text."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // most
    for k in range(n):
        block = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        items = Items.of([r.item_id for r in block], [r.text for r in block])
        if items.ids:
            yield items


def _finder(docs: DataFrame, benchmark: DataFrame) -> Iterator[Callable[[], tuple[Items, Seeds]]]:
    for items in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast((items, Seeds.of(items, corpus_counts(docs, items))))
        yield lambda shared=shared: shared.value


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, first_word, end_word and n_seeds of each leaked item of each document that leaks any."""
    ddl = "doc_id long, item_id long, score double, first_word long, end_word long, n_seeds long"
    out = docs.sparkSession.createDataFrame([], ddl)
    for get in _finder(docs, benchmark):

        def run(batches: Iterator[pa.RecordBatch], get=get) -> Iterator[pa.RecordBatch]:
            items, seeds = get()
            for b in batches:
                ids = b.column(0).to_pylist()
                rows = [(ids[i], items.ids[k], *rest) for i, w in _words_of(b.column(1)) if len(w) >= LEAST_WORDS for k, *rest in _found(w, items, seeds)]
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "score", "first_word", "end_word", "n_seeds"])

        out = out.unionByName(tidy_documents(docs).mapInArrow(released(run), ddl))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that leak no item, with all their columns."""
    at = docs.columns.index("text")
    out = docs
    for get in _finder(docs, benchmark):

        def run(batches: Iterator[pa.RecordBatch], get=get) -> Iterator[pa.RecordBatch]:
            items, seeds = get()
            for b in batches:
                clean = [len(w) < LEAST_WORDS or next(_found(w, items, seeds), None) is None for _, w in _words_of(b.column(at).cast(pa.string()))]
                yield b.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(released(run), docs.schema)
    return out
