"""Native gapped alignment: words joined by value, paired near a diagonal, then banded dynamic programming with affine gaps.

It stands in for an external aligner where no hits table is given. Three steps, each a Spark plan:

- `diagonals`: words of queries and subjects are joined by their canonical code, so one join serves both strands. Windows of
  subjects that no query has are left out while they are cut. What is kept of a pair of words is its diagonal (subject place of
  the query's start); equal diagonals are summed before they are shuffled on.
- `regions`: diagonals at most `BAND` apart are one region; it needs two word pairs (a stretch of word + 1 equal bases has
  two). Wide regions, as in tandem repeats, are parted into strips. `common`: words that occur at more places of the subjects
  than this pair no query by themselves, except for queries that have no other words.
- `local_alignments`: the region's part of the subject is fetched in tiles, and the batch's regions are aligned together: best
  local alignment within the band, then what is left before and after it, as long as the score is worth it.

Results are those of Smith-Waterman within the bands. Of alignments with a common start or end in the same pair and strand the
best is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import takewhile
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandsieve import schema as S
from strandsieve.functions import packed
from strandsieve.functions.sequence import normalize, tiles
from strandsieve.session import settled, small


@dataclass(frozen=True)
class Scoring:
    """Whole scores in `unit`s: match, mismatch, a gap's opening and each of its bases; then lambda and K of the statistics."""

    match: int
    mismatch: int
    opening: int
    base: int
    unit: int
    lam: float
    k: float

    def bits(self, score: F.Column) -> F.Column:
        return (score / F.lit(float(self.unit)) * self.lam - log(self.k)) / log(2.0)

    def least(self, evalue: float, space: float) -> int:
        """The least score whose expected number in a search space is at most `evalue`."""
        return ceil((log(space / evalue) + log(self.k)) / self.lam * self.unit - 1e-9)


# Published scores and statistics of gapped nucleotide search, for close (1, -2, 2.5 a base) and for wider kin.
CLOSE = Scoring(2, -4, 0, 5, 2, 1.28, 0.46)
WIDE = Scoring(2, -3, 5, 2, 1, 0.625, 0.41)

#: Diagonals that an alignment may leave its seeds by, and the widest strip of diagonals that is aligned at once.
BAND, STRIP = 16, 512
#: Places of a word in the subjects beyond which it pairs no query by itself.
COMMON = 1_000_000
#: Letters of a subject's tile, and diagonals of a part within which neighbours are looked for.
_TILE, _PART = 1 << 13, 1 << 16
#: Cells of the dynamic programming that are worked on, and remembered, together.
_CELLS = 4_000_000
_FAR = -(1 << 29)
_COMPLEMENT = bytes.maketrans(b"ACGTRYKMSWBDHVN", b"TGCAYRMKSWVHDBN")
_BASE = np.zeros(256, bool)
_BASE[[ord(b) for b in "ACGT"]] = True
_KEYS = ("design_id", "qseqid", "saccver", "sstrand")
_HSP = "design_id string, qseqid string, qlen long, saccver string, staxids string, stitle string, sstrand string, qstart long, qend long, sstart long, send long, length long, mismatch long, gapopen long, score long"


def _own(subjects: DataFrame) -> tuple[str, ...]:
    """Subjects belong to a design, or are shared by all."""
    return ("design_id",) if "design_id" in subjects.columns else ()


def diagonals(queries: DataFrame, subjects: DataFrame, word: int, common: int | None = COMMON) -> DataFrame:
    """design_id, qseqid, saccver, sstrand, qlen, diagonal, and the first and last query place of its words.

    `queries` has design_id, qseqid and sequence; `subjects` has saccver and sequence, and design_id unless they are shared.
    On the minus strand the query is the one that is turned, and its places are those of the turned query.
    """
    own = _own(subjects)
    q = queries.select("design_id", "qseqid", F.length("sequence").cast("long").alias("qlen"), "sequence")
    cut = lambda df, columns, only=None: packed.coded(df, word, columns, True, only).select(*columns, F.explode(F.arrays_zip("starts", "codes", "strands")).alias("w"))
    words = settled(cut(q, ("design_id", "qseqid", "qlen")).select("design_id", "qseqid", "qlen", F.col("w.starts").alias("qat"), F.col("w.codes").alias("code"), F.col("w.strands").alias("qdir")))
    places = cut(subjects.select(*own, "saccver", "sequence"), (*own, "saccver"), packed.wanted(words))
    places = places.select(*own, "saccver", F.col("w.starts").alias("sat"), F.col("w.codes").alias("code"), F.col("w.strands").alias("sdir"))
    if common is not None:
        places = settled(places)
        many = settled(places.groupBy(*own, "code").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > common).drop("n"))
        if not many.isEmpty():
            rare = words.join(small(many), [*own, "code"], "left_anti")
            alone = words.join(settled(rare.select("design_id", "qseqid").distinct()), ["design_id", "qseqid"], "left_anti")
            words = settled(rare.unionByName(alone.select(rare.columns)))
    met = places.join(small(words), [*own, "code"])
    plus, minus = F.lit("plus"), F.lit("minus")
    strands = F.when(F.col("qdir") == 3, F.array(plus, minus)).when(F.col("qdir") == F.col("sdir"), F.array(plus)).otherwise(F.array(minus))
    both = met.select("design_id", "qseqid", "saccver", "qlen", "qat", "sat", F.explode(strands).alias("sstrand"))
    at = F.when(F.col("sstrand") == "plus", F.col("qat")).otherwise(F.col("qlen") - word - F.col("qat"))
    return both.withColumn("at", at).groupBy(*_KEYS, "qlen", (F.col("sat") - F.col("at")).alias("diagonal")).agg(F.min("at").alias("first"), F.max("at").alias("last"))


def regions(found: DataFrame) -> DataFrame:
    """design_id, qseqid, saccver, sstrand, qlen, low and high: strips of neighbouring diagonals that hold two words.

    Neighbours are looked for within parts; a word alone at a part's border is kept, as its partner may lie beyond.
    """
    part = F.floor(F.col("diagonal") / _PART)
    w = Window.partitionBy(*_KEYS, "part").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(w) > BAND, F.lit(True)).cast("int")
    linked = found.withColumn("part", part).withColumn("new", new).withColumn("cluster", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    per = linked.groupBy(*_KEYS, "qlen", "part", "cluster").agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.min("first").alias("first"), F.max("last").alias("last"), F.count(F.lit(1)).alias("n"))
    border = (F.pmod("low", F.lit(_PART)) < BAND) | (F.pmod("high", F.lit(_PART)) >= _PART - BAND)
    kept = per.where((F.col("last") > F.col("first")) | (F.col("n") > 1) | border)
    strips = kept.select(*_KEYS, "qlen", "low", "high", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("high") - F.col("low")) / STRIP))).alias("strip"))
    low = F.col("low") + F.col("strip") * STRIP
    return strips.select(*_KEYS, "qlen", low.alias("low"), F.least("high", low + (STRIP - 1)).alias("high"))


def banded(pairs: list[tuple[np.ndarray, np.ndarray, int, int]], scoring: Scoring) -> list[tuple[int, int, int, int, int, int, int, int]]:
    """Best local alignment of each (query, subject, low, high): subject place minus query place stays within low to high.

    Gives score, query start and end, subject start and end (0-based, ends exclusive), columns, mismatches and gaps. Of equal
    scores the one that ends first in the query, then in the subject; on the way back a pair of bases comes before a gap in
    the subject, that before one in the query, and a longer gap before a new one.
    """
    n, length, width = len(pairs), max(len(p[0]) for p in pairs), max(p[3] - p[2] + 1 for p in pairs)
    query, subject = np.zeros((n, length), np.uint8), np.zeros((n, length + width), np.uint8)
    for r, (q, s, low, high) in enumerate(pairs):
        query[r, : len(q)] = q
        a, z = max(low, 0), min(len(s), high + len(q))
        if z > a:
            subject[r, a - low : z - low] = s[a:z]
    band = np.array([p[3] - p[2] + 1 for p in pairs])
    outside = np.arange(width)[None] >= band[:, None]  # columns of wider bands only
    ramp = (np.arange(width) * scoring.base).astype(np.int32)
    rows = np.arange(n)
    h, e = np.zeros((n, width), np.int32), np.full((n, width), _FAR, np.int32)
    trace = np.zeros((length, n, width), np.uint8)
    best, best_i, best_c = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    f, up, up_e = np.full((n, width), _FAR, np.int32), np.full((n, width), _FAR, np.int32), np.full((n, width), _FAR, np.int32)
    for i in range(length):
        base, there = query[:, i : i + 1], subject[:, i : i + width]
        d = h + np.where((base == there) & _BASE[base], np.int32(scoring.match), np.int32(scoring.mismatch))
        d[(there == 0) | (base == 0) | outside] = _FAR
        up[:, :-1], up_e[:, :-1] = h[:, 1:] - scoring.opening, e[:, 1:]
        opened = up > up_e
        e = np.maximum(up, up_e) - scoring.base
        best_so = np.maximum(np.maximum(d, e), 0)
        f[:, 1:] = (np.maximum.accumulate(best_so + ramp, axis=1) - scoring.opening)[:, :-1] - ramp[1:]
        h = np.maximum(best_so, f)
        h[outside], e[outside] = 0, _FAR
        f_opened = np.zeros((n, width), bool)
        f_opened[:, 1:] = f[:, 1:] > f[:, :-1] - scoring.base
        way = np.where(h <= 0, 0, np.where(d == h, 1, np.where(e == h, 2, 3))).astype(np.uint8)
        trace[i] = way | (opened.astype(np.uint8) << 2) | (f_opened.astype(np.uint8) << 3)
        c = h.argmax(1)
        top = h[rows, c]
        more = top > best
        best[more], best_i[more], best_c[more] = top[more], i, c[more]
    i, c, state = best_i.copy(), best_c.copy(), np.where(best > 0, 1, 0)  # 1: any, 2: gap in the subject, 3: gap in the query, 0: done
    columns, wrong, gaps = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    while state.any():
        at = np.maximum(i, 0)
        t = trace[at, rows, c]
        way = np.where(i < 0, 0, t & 3)
        state = np.where(state == 1, np.where(way == 0, 0, np.where(way == 1, 1, way + 2)), state)  # 4, 5: enters a gap
        pair, e_gap, f_gap = state == 1, (state == 4) | (state == 2), (state == 5) | (state == 3)
        same = (query[rows, at] == subject[rows, at + c]) & _BASE[query[rows, at]]
        columns += pair | e_gap | f_gap
        wrong += pair & ~same
        opens = (e_gap & (t & 4 > 0)) | (f_gap & (t & 8 > 0))
        gaps += opens
        i = i - (pair | e_gap)
        c = c + e_gap - f_gap
        state = np.where(pair | opens, 1, np.where(e_gap, 2, np.where(f_gap, 3, 0)))
        c = np.clip(c, 0, width - 1)
    low = np.array([p[2] for p in pairs])
    q0, q1, s0, s1 = i + 1, best_i + 1, i + 1 + low + c, best_i + 1 + low + best_c
    return [tuple(x) for x in np.stack([best, q0, q1, s0, s1, columns, wrong, gaps], 1).tolist()]


def best_scores(pairs: list[tuple[np.ndarray, np.ndarray, int, int]], scoring: Scoring) -> list[int]:
    """The score alone that `banded` gives each pair, without a way back: pairs side by side, in 16 bits where they fit."""
    n, length, width = len(pairs), max(len(p[0]) for p in pairs), max(p[3] - p[2] + 1 for p in pairs)
    kind = np.int16 if length * scoring.match + (width + 1) * scoring.base < 32_000 else np.int32
    query, subject = np.full((length, n), 1, np.uint8), np.zeros((length + width, n), np.uint8)  # what is no base equals nothing
    for r, (q, s, low, high) in enumerate(pairs):
        query[: len(q), r] = np.where(_BASE[q], q, 1)
        a, z = max(low, 0), min(len(s), high + len(q))
        if z > a:
            subject[a - low : z - low, r] = s[a:z]
    outside = np.arange(width)[:, None] >= np.array([p[3] - p[2] + 1 for p in pairs])[None]
    ragged = bool(outside.any())
    gain, mismatch, opening, base = (kind(x) for x in (scoring.match - scoring.mismatch, scoring.mismatch, scoring.opening, scoring.base))
    far = kind(-20_000)
    h, e, best = np.zeros((width, n), kind), np.full((width, n), far), np.zeros(n, kind)
    d, same, ramp = np.empty((width, n), kind), np.empty((width, n), bool), (np.arange(width)[:, None] * scoring.base).astype(kind)
    for i in range(length):
        np.equal(subject[i : i + width], query[i], out=same)
        np.multiply(same, gain, out=d)
        d += h
        d += mismatch
        h -= opening
        np.maximum(h[1:], e[1:], out=e[:-1])
        e[:-1] -= base
        np.maximum(d, e, out=h)
        np.maximum(h, 0, out=h)
        if ragged:
            h[outside], e[outside] = 0, far
        np.add(h, ramp, out=d)
        np.maximum.accumulate(d, axis=0, out=d)
        d[:-1] -= ramp[1:] + opening
        np.maximum(h[1:], d[:-1], out=h[1:])
        if ragged:
            h[outside] = 0
        np.maximum(best, h.max(0), out=best)
    return best.tolist()


def _tops(pairs: list[tuple[np.ndarray, np.ndarray, int, int]], scoring: Scoring) -> list[int]:
    """`best_scores` of any number of pairs, in groups of like sizes."""
    order = sorted(range(len(pairs)), key=lambda r: (pairs[r][3] - pairs[r][2], len(pairs[r][0])), reverse=True)
    tops, k = [0] * len(pairs), 0
    while k < len(order):
        q, _, low, high = pairs[order[k]]
        width = high - low + 1
        some = order[k : k + max(1, min(60_000 // width, 32_000_000 // (len(q) + width)))]
        # Neither much wider nor much longer ones beside it.
        some = list(takewhile(lambda r: 2 * (pairs[r][3] - pairs[r][2] + 1) >= width and 2 * len(pairs[r][0]) >= len(q), some))  # noqa: B023
        k += len(some)
        for r, score in zip(some, best_scores([pairs[r] for r in some], scoring), strict=True):
            tops[r] = score
    return tops


def _segments(pairs: list[tuple[np.ndarray, np.ndarray, int, int]], scoring: Scoring, least: int) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(number of the pair, alignment as `banded` gives it) of each alignment of at least the least score."""
    # number, query part, subject part: what is left of a pair
    open_ = [(n, 0, len(q), 0, len(s)) for n, (q, s, _, _) in enumerate(pairs)]
    while open_:
        # What the best possible score rules out needs no work; the others go in groups of like sizes.
        open_ = [o for o in open_ if min(o[2] - o[1], o[4] - o[3]) * scoring.match >= least]
        open_.sort(key=lambda o: (pairs[o[0]][3] - pairs[o[0]][2], o[2] - o[1]), reverse=True)
        left, k = [], 0
        while k < len(open_):
            cells = max(1, (open_[k][2] - open_[k][1]) * (pairs[open_[k][0]][3] - pairs[open_[k][0]][2] + 1))
            some = open_[k : k + max(1, _CELLS // cells)]
            while max(o[2] - o[1] for o in some) * len(some) * (pairs[some[0][0]][3] - pairs[some[0][0]][2] + 1) > 2 * _CELLS and len(some) > 1:
                some = some[: (len(some) + 1) // 2]
            k += len(some)
            cut = [(pairs[n][0][a:z], pairs[n][1][b:y], pairs[n][2] + a - b, pairs[n][3] + a - b) for n, a, z, b, y in some]
            for (n, a, z, b, y), (score, q0, q1, s0, s1, *rest) in zip(some, banded(cut, scoring), strict=True):
                if score >= least:
                    yield n, (score, a + q0, a + q1, b + s0, b + s1, *rest)
                    left += [(n, a, a + q0, b, b + s0), (n, a + q1, z, b + s1, y)]
        open_ = left


def local_alignments(queries: DataFrame, subjects: DataFrame, word: int = 28, scoring: Scoring = CLOSE, least: int | None = None, common: int | None = COMMON, subjects_of_each: int | None = None) -> DataFrame:
    """Alignments of each region, as raw scores of at least `least` (a word's, if not given); each is one row.

    `subjects_of_each`: of each query only the subjects with the best scores (then names), which are found by scores alone, so
    that only their regions are traced.
    """
    least = word * scoring.match if least is None else least
    own = _own(subjects)
    more = [c if c in subjects.columns else F.lit("").alias(c) for c in ("staxids", "stitle")]
    tidy = settled(queries.select("design_id", "qseqid", normalize(F.col("sequence")).alias("sequence")))
    stored = subjects.select(*own, "saccver", *more, normalize(F.col("sequence")).alias("sequence"))
    found = settled(regions(settled(diagonals(tidy, stored, word, common))))
    def fetched(regions_: DataFrame) -> DataFrame:
        begin, end = F.greatest(F.col("low") - BAND, F.lit(0)), F.col("high") + F.col("qlen") + BAND
        spread = regions_.select("*", F.explode(F.sequence(F.floor(begin / _TILE), F.floor(end / _TILE))).alias("tile"))
        # Tiles that no region touches go no further.
        pieces = stored.select(*own, "saccver", "staxids", "stitle", F.posexplode(tiles(F.col("sequence"), 1, _TILE)).alias("tile", "piece"))
        pieces = pieces.withColumn("tile", F.col("tile").cast("long")).join(small(settled(spread.select(*own, "saccver", "tile").distinct())), [*own, "saccver", "tile"], "left_semi")
        ordered = F.array_sort(F.collect_list(F.struct("tile", "piece")))
        whole = spread.join(pieces, [*own, "saccver", "tile"]).groupBy(*_KEYS, "qlen", "low", "high", "staxids", "stitle").agg(F.min("tile").alias("tile"), F.array_join(F.transform(ordered, lambda x: x["piece"]), "").alias("part"))
        return whole.join(small(tidy), ["design_id", "qseqid"]).select(*_KEYS, "qlen", "low", "high", "staxids", "stitle", (F.col("tile") * _TILE).alias("origin"), "part", "sequence")

    def pairs_of(given: list[dict]) -> list[tuple[np.ndarray, np.ndarray, int, int]]:
        pairs = []
        for r in given:
            q = r["sequence"].encode() if r["sstrand"] == "plus" else r["sequence"].encode()[::-1].translate(_COMPLEMENT)
            pairs.append((np.frombuffer(q, np.uint8), np.frombuffer(r["part"].encode(), np.uint8), r["low"] - r["origin"] - BAND, r["high"] - r["origin"] + BAND))
        return pairs

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = _tops(pairs_of(b.to_pylist()), scoring)
            yield pa.record_batch([*[b.column(c) for c in ("design_id", "qseqid", "saccver")], pa.array(score, pa.int64())], names=["design_id", "qseqid", "saccver", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [f.split() for f in _HSP.split(", ")]
        types = {"string": pa.string(), "long": pa.int64()}
        for b in batches:
            given = b.to_pylist()
            pairs = pairs_of(given)
            out = []
            for n, (score, q0, q1, s0, s1, columns, wrong, gaps) in _segments(pairs, scoring, least):
                r = given[n]
                s0, s1 = s0 + r["origin"], s1 + r["origin"]
                where = (q0 + 1, q1, s0 + 1, s1) if r["sstrand"] == "plus" else (r["qlen"] - q1 + 1, r["qlen"] - q0, s1, s0 + 1)
                out.append((r["design_id"], r["qseqid"], r["qlen"], r["saccver"], r["staxids"], r["stitle"], r["sstrand"], *where, columns, wrong, gaps, score))
            columns_ = list(zip(*out, strict=True)) or [[]] * len(kinds)
            yield pa.record_batch([pa.array(c, types[t]) for c, (_, t) in zip(columns_, kinds, strict=True)], names=[name for name, _ in kinds])

    if subjects_of_each is not None:
        score = settled(fetched(found).mapInArrow(tops, "design_id string, qseqid string, saccver string, score long"))
        best = score.where(F.col("score") >= least).groupBy("design_id", "qseqid", "saccver").agg(F.max("score").alias("_best"))
        rank = F.row_number().over(Window.partitionBy("design_id", "qseqid").orderBy(F.desc("_best"), "saccver"))
        kept = settled(best.withColumn("_rank", rank).where(F.col("_rank") <= subjects_of_each).select("design_id", "qseqid", "saccver"))
        found = settled(found.join(small(kept), ["design_id", "qseqid", "saccver"], "left_semi"))
    return _best_of_ends(settled(fetched(found).mapInArrow(run, _HSP).distinct()))


def _best_of_ends(hits: DataFrame) -> DataFrame:
    """Of alignments of a pair and strand that start or end at the same place, the best."""
    for ends in (("qstart", "sstart"), ("qend", "send")):
        rank = F.row_number().over(Window.partitionBy(*_KEYS, *ends).orderBy(F.desc("score"), "length", "qstart", "qend", "sstart", "send"))
        hits = hits.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return hits


def locus_hits(queries: DataFrame, assembly: DataFrame, word: int = 28) -> DataFrame:
    """Prepared queries against their design's assembly, in the columns of imported locus hits."""
    subjects = assembly.select("design_id", F.col("assembly_sequence_id").alias("saccver"), "sequence")
    found = local_alignments(queries.withColumnRenamed("query_id", "qseqid"), subjects, word, CLOSE)
    return found.select(
        "design_id", F.col("qseqid").alias("query_id"), F.col("qlen").alias("query_length"), F.col("qstart").alias("query_start"), F.col("qend").alias("query_end"),
        F.col("saccver").alias("assembly_sequence_id"), F.col("sstart").alias("assembly_start_raw"), F.col("send").alias("assembly_end_raw"),
        F.col("length").alias("alignment_length"), _identity().alias("percent_identity"),
    )


def _identity() -> F.Column:
    """Equal bases of all columns, gaps included. What is no mismatch and no equal base is a gap."""
    spans = (F.col("qend") - F.col("qstart") + 1) + (F.abs(F.col("send") - F.col("sstart")) + 1)
    return (spans - F.col("length") - F.col("mismatch")) / F.col("length") * 100


def read_hits(queries: DataFrame, reference: DataFrame, max_subjects: int = S.Defaults.max_subjects, max_evalue: float = S.Defaults.max_evalue, word: int = 11) -> DataFrame:
    """Read queries (design_id, representative_id, sequence) against the shared reference, in the columns of imported hits.

    Of each query the `max_subjects` best subjects are kept (by best score, then name), with all their segments.
    """
    space = float(reference.agg(F.sum(F.length("sequence"))).first()[0] or 1)
    shortest = queries.agg(F.min(F.length("sequence"))).first()[0] or 1
    found = local_alignments(queries.withColumnRenamed("representative_id", "qseqid"), reference, word, WIDE, max(word * WIDE.match, WIDE.least(max_evalue, space * max(shortest, 1))), subjects_of_each=max_subjects)
    scored = found.withColumn("_bits", WIDE.bits(F.col("score"))).withColumn("evalue", F.col("qlen") * F.lit(space) * F.pow(F.lit(2.0), -F.col("_bits"))).where(F.col("evalue") <= max_evalue)
    subject = scored.groupBy("design_id", "qseqid", "saccver").agg(F.max("_bits").alias("_best"))
    rank = F.row_number().over(Window.partitionBy("design_id", "qseqid").orderBy(F.desc("_best"), "saccver"))
    kept = subject.withColumn("_rank", rank).where(F.col("_rank") <= max_subjects).select("design_id", "qseqid", "saccver")
    return scored.join(kept, ["design_id", "qseqid", "saccver"], "left_semi").select(
        "design_id", "qseqid", "qlen", "saccver", "staxids", _identity().alias("pident"), "length", "mismatch",
        "gapopen", "qstart", "qend", "sstart", "send", "evalue", F.format_string("%.1f", F.col("_bits")).alias("bitscore"),
        ((F.col("qend") - F.col("qstart") + 1) / F.col("qlen") * 100).alias("qcovhsp"), "stitle",
    )


def keep_best_subjects(hits: DataFrame, max_subjects: int = S.Defaults.max_subjects) -> DataFrame:
    """The same limit on imported hits."""
    best = hits.groupBy("design_id", "qseqid", "saccver").agg(F.max(F.col("bitscore").try_cast("decimal(38,10)")).alias("_best"))
    rank = F.row_number().over(Window.partitionBy("design_id", "qseqid").orderBy(F.desc("_best"), "saccver"))
    return hits.join(best.withColumn("_rank", rank).where(F.col("_rank") <= max_subjects), ["design_id", "qseqid", "saccver"], "left_semi")
