"""Best alignment score of each query with each subject of a shared reference, where no alignment itself is asked for.

The scores are those of `align.local_alignments`: the same words, regions and bands, each band's Smith-Waterman score. Nothing
is left out for speed; what differs is where the work is done:

- Both sides are dealt into blocks of about `LETTERS` letters, two bits a base, and each pair of blocks is one task. Words are
  joined there in sorted arrays, and only the pair of words that begins a stretch of equal bases is kept, with the mark whether
  a second one follows on its diagonal. Neither names nor texts are copied to the pairs of words.
- Equal subjects are aligned once, and a band has only those rows in which it meets the subject.
- Bands are scored side by side along antidiagonals, where no cell needs another of its own step, in 8 bits a cell; those that
  come near the end of that range are scored again in 16 or 32.
- Of each query a task hands on its `most` best subjects, among which the best of all must be.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandsieve import schema as S
from strandsieve.functions import packed
from strandsieve.functions.sequence import BASES, normalize
from strandsieve.operators import align
from strandsieve.session import settled, small

#: Letters of a block, and of a subject or query beyond which `align.local_alignments` takes it, tile by tile.
LETTERS, LONG = 8_000_000, 4_000_000
#: Word pairs that are spread out together, and letters that are cut into words together.
_PAIRS, _CUT = 4_000_000, 1 << 21
#: Bands side by side, and letters of them; the score at which 8 bits are left.
_SIDE, _HELD, _CAP = 8192, 32_000_000, 110
#: Counts by which it is shown that no word is common, without counting words.
_SLOTS = 1 << 16
_COMPLEMENT = bytes.maketrans(b"ACGTRYKMSWBDHVN", b"TGCAYRMKSWVHDBN")
_LETTER = np.full(256, 4, np.uint8)
_LETTER[[ord(b) for b in BASES]] = range(4)
#: Bits of letters on either side: equal bases give 0, all other pairs 8 or more.
_QUERY, _SUBJECT = np.array([8, 16, 24, 32, 64], np.uint8), np.array([8, 16, 24, 32, 128], np.uint8)
_SCORES = "design_id string, qseqid string, name string, score long"


class Bands(NamedTuple):
    """Columns of equal length: query (turned ones after the others), subject, lowest and highest diagonal."""

    query: np.ndarray
    subject: np.ndarray
    low: np.ndarray
    high: np.ndarray


class Texts:
    """Sequences one after the other as digits of bases (4: none, also between them), with their begins and lengths."""

    def __init__(self, texts: list[bytes]) -> None:
        self.length = np.array([len(t) for t in texts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length + 1)])[:-1] + 1
        self.digits = _LETTER[np.frombuffer(b"\0" + b"".join(t + b"\0" for t in texts), np.uint8)]

    def words(self, word: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Code and place of each word of bases."""
        for a in range(0, len(self.digits), _CUT):
            d = self.digits[a : a + _CUT + word - 1]
            if len(d) < word:
                return
            bad = np.concatenate([[0], np.cumsum(d > 3)])
            start = np.flatnonzero(bad[word:] == bad[:-word])
            yield packed._rolled(d & 3, word, True)[start], start + a


def _turned(text: bytes) -> bytes:
    return text[::-1].translate(_COMPLEMENT)


def _slots(codes: np.ndarray, bits: int) -> np.ndarray:
    return ((codes.view(np.uint64) * packed._ODD) >> np.uint64(64 - bits)).astype(np.int64)


def _alike(queries: Texts, subjects: Texts, word: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes and places of the queries' words, sorted by code, then those of the subjects, by place, that may meet one another."""
    bits = min(26, max(12, int(np.log2(len(subjects.digits) + 1)) + 3))
    seen = np.zeros(1 << bits, bool)
    for code, _ in subjects.words(word):
        seen[_slots(code, bits)] = True
    codes, places = [], []
    for code, place in queries.words(word):
        some = np.flatnonzero(seen[_slots(code, bits)])
        codes.append(code[some])
        places.append(place[some])
    code, place = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (codes, places))
    if len(common):
        # A query's common words pair it only if it has no others: of all its words, not of those that meet.
        n = len(queries.length) // 2
        owner = lambda at: (np.searchsorted(queries.begin, at, "right") - 1) % n
        other = np.zeros(n, bool)
        for c, p in queries.words(word):
            other[owner(p[~np.isin(c, common)])] = True
        keep = ~np.isin(code, common) | ~other[owner(place)]
        code, place = code[keep], place[keep]
    order = np.argsort(code, kind="stable")
    code, place = code[order], place[order]
    seen[:] = False
    seen[_slots(code, bits)] = True
    met = [(c[some], p[some]) for c, p in subjects.words(word) for some in [np.flatnonzero(seen[_slots(c, bits)])]]
    return code, place, *(np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*met, strict=True) if met else ([], [])))


def bands(queries: Texts, subjects: Texts, word: int, common: np.ndarray) -> Bands:
    """What `align.regions` gives of `align.diagonals`; each query comes twice, the turned ones after all others."""
    code, place, scode, splace = _alike(queries, subjects, word, common)
    found = []
    if len(code) and len(scode):
        left, right = np.searchsorted(code, scode, "left"), np.searchsorted(code, scode, "right")
        n, owner = right - left, np.searchsorted(subjects.begin, splace, "right") - 1
        before, ends = np.concatenate([[0], np.cumsum(n)]), np.flatnonzero(np.diff(owner, append=-1)) + 1
        a = 0
        while a < len(n):  # whole subjects, as many as fit
            z = int(ends[max(np.searchsorted(before[ends], before[a] + _PAIRS, "right") - 1, np.searchsorted(ends, a, "right"))])
            count = n[a:z]
            at = np.repeat(left[a:z] - before[a:z], count) + np.arange(before[a], before[z])
            found.append(_clusters(queries, subjects, place[at], np.repeat(splace[a:z], count), np.repeat(owner[a:z], count), word, bool(len(common))))
            a = z
    return Bands(*(np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found, strict=True) if found else ([], [], [], []))))


def _clusters(queries: Texts, subjects: Texts, qat: np.ndarray, sat: np.ndarray, owner: np.ndarray, word: int, apart: bool) -> Bands:
    """Strips of neighbouring diagonals that hold two word pairs. `apart`: pairs are left out, so that none stands for its next."""
    same = lambda a, b: (queries.digits[a] == subjects.digits[b]) & (queries.digits[a] < 4)
    if not apart:
        first = ~same(qat - 1, sat - 1)
        qat, sat, owner = qat[first], sat[first], owner[first]
    two = np.zeros(len(qat), bool) if apart else same(qat + word, sat + word)
    query = np.searchsorted(queries.begin, qat, "right") - 1
    diagonal = (sat - subjects.begin[owner]) - (qat - queries.begin[query])
    order = np.lexsort((diagonal, query, owner))
    query, owner, diagonal, two = query[order], owner[order], diagonal[order], two[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (owner[1:] != owner[:-1]) | (diagonal[1:] // align._PART != diagonal[:-1] // align._PART) | (diagonal[1:] - diagonal[:-1] > align.BAND)
    head = np.flatnonzero(new)
    if not len(head):
        return Bands(query, owner, diagonal, diagonal)
    tail = np.append(head[1:], len(new)) - 1
    low, high = diagonal[head], diagonal[tail]
    border = (low % align._PART < align.BAND) | (high % align._PART >= align._PART - align.BAND)
    kept = np.flatnonzero((tail > head) | np.logical_or.reduceat(two, head) | border)
    strips = (high[kept] - low[kept]) // align.STRIP + 1
    strip = np.arange(strips.sum()) - np.repeat(np.cumsum(strips) - strips, strips)
    kept = np.repeat(kept, strips)
    begin = low[kept] + strip * align.STRIP
    return Bands(query[head[kept]], owner[head[kept]], begin, np.minimum(high[kept], begin + align.STRIP - 1))


def side_by_side(query: np.ndarray, subject: np.ndarray, width: np.ndarray, scoring: align.Scoring, kind: type, cap: int | None = None) -> np.ndarray:
    """Smith-Waterman score of each column's band; `cap`: scores of about this and more are given as some number of at least it.

    `query` holds the rows' letters backwards between widest // 2 rows of none, `subject` those from the lowest diagonal on.
    A step works on one row's cell of the lowest diagonal and on what lies on its antidiagonal: first the even diagonals, then
    the odd ones. Gaps' scores are never below 0, as an alignment that begins there is as good.
    """
    n, wide = len(width), int(width.max())
    even, odd = (wide + 1) // 2, wide // 2
    rows = len(query) - 2 * (even - 1)
    unsigned = query.dtype
    longer, base, match = kind(scoring.opening + scoring.base), kind(scoring.base), kind(scoring.match)
    numbers = lambda shape, value=0: np.full((shape, n), value, kind)
    sides = []
    for size, other, first in ((even, odd, 0), (odd, even, 1)):
        limit = None
        if int(width.min()) < wide:
            limit = np.where(np.arange(size)[:, None] * 2 + first < width[None], kind(np.iinfo(kind).max), kind(0))
        sides.append((size, numbers(size), numbers(size), numbers(size), np.empty((size, n), unsigned), limit))
    (_, he, be, ge, te, le), (_, ho, bo, go, to, lo) = sides
    # What leaves a diagonal by a gap, with the places beyond the band, which stay 0.
    ue, fe, uo, fo = numbers(max(even, odd + 1)), numbers(max(even, odd + 1)), numbers(even + 1), numbers(even + 1)
    most, none, top = np.full((even, n), scoring.match - scoring.mismatch, unsigned), numbers(even), None if cap is None else numbers(even, cap)
    often = max(1, 16 // scoring.match)

    def cells(q, s, h, g, t, best, limit, up, left, up_to, left_to):
        size = len(h)
        np.bitwise_xor(q, s, out=t)
        np.minimum(t, most[:size], out=t)
        np.subtract(h, t.view(kind), out=h)
        np.add(h, match, out=h)
        np.maximum(h, up, out=h)
        np.maximum(h, left, out=h)
        if limit is not None:
            np.minimum(h, limit, out=h)
        np.maximum(best, h, out=best)
        np.subtract(h, longer, out=g)
        np.maximum(g, none[:size], out=g)
        np.subtract(up, base, out=up_to)
        np.maximum(up_to, g, out=up_to)
        np.subtract(left, base, out=left_to)
        np.maximum(left_to, g, out=left_to)

    last = rows + even - 1
    for r in range(last):
        back = last - 1 - r
        cells(query[back : back + even], subject[r : r + even], he, ge, te, be, le, uo[1 : even + 1], fo[:even], ue[:even], fe[:even])
        if odd:
            cells(query[back : back + odd], subject[r + 1 : r + 1 + odd], ho, go, to, bo, lo, ue[1 : odd + 1], fe[:odd], uo[1 : odd + 1], fo[1 : odd + 1])
        if top is not None and r % often == often - 1:
            np.minimum(he, top, out=he)
            np.minimum(ho, top[:odd], out=ho)
    return np.maximum(be.max(0), bo.max(0)) if odd else be.max(0)


def _equal(queries: Texts, subjects: Texts, given: Bands) -> np.ndarray:
    """Whether the whole of the shorter one lies in the other along the lowest diagonal, as that of a read in its own subject."""
    out = np.zeros(len(given.low), bool)
    for r, (q, s, low) in enumerate(zip(given.query.tolist(), given.subject.tolist(), given.low.tolist(), strict=True)):
        begin, n = max(0, -low), min(int(queries.length[q]), int(subjects.length[s]))
        a, b = int(queries.begin[q]) + begin, int(subjects.begin[s]) + begin + low
        if begin + n <= queries.length[q] and begin + low + n <= subjects.length[s]:
            d = queries.digits[a : a + n]
            out[r] = bool((d == subjects.digits[b : b + n]).all() and (d < 4).all())
    return out


def scores(queries: Texts, subjects: Texts, given: Bands, scoring: align.Scoring, least: int = 1) -> np.ndarray:
    """Score of each band, `align.BAND` diagonals wider on both sides, as `align.best_scores` gives it; 0 if it cannot be `least`."""
    low, width = given.low - align.BAND, given.high - given.low + 1 + 2 * align.BAND
    qlen, slen = queries.length[given.query], subjects.length[given.subject]
    begin = np.maximum(0, -(low + width - 1))
    rows = np.maximum(np.minimum(qlen, slen - low) - begin, 0)
    out = np.zeros(len(low), np.int64)
    reach = np.minimum(np.minimum(rows, qlen), slen) * scoring.match
    letters, others = _QUERY[queries.digits], _SUBJECT[subjects.digits]

    def score(some: np.ndarray, kind: type, cap: int | None) -> None:
        unsigned = np.dtype(kind).str.replace("i", "u")
        order = some[np.lexsort((rows[some], width[some]))[::-1]]
        k, negative = 0, -rows[order]
        while k < len(order):
            wide = int(width[order[k]])
            # Neither much narrower nor much shorter ones beside it; the narrowest, which are most, by themselves.
            z = min(len(order), k + max(1, min(_SIDE * 33 // (wide * np.dtype(kind).itemsize), _HELD // int(rows[order[k]] + 2 * wide))))
            narrow = np.flatnonzero((2 * width[order[k:z]] < wide) | ((width[order[k:z]] == 2 * align.BAND + 1) & (wide > 2 * align.BAND + 1)))
            z = k + int(narrow[0]) if len(narrow) else z
            short = np.flatnonzero(2 * -negative[k:z] < rows[order[k]])
            z = k + int(short[0]) if len(short) else z
            r = order[k:z]
            k = z
            n, even = int(rows[r].max()), (wide + 1) // 2
            q, s = np.full((len(r), n), _QUERY[4]), np.full((len(r), n + 2 * even), _SUBJECT[4])
            first = begin[r] + low[r]
            for c, (m, qa, sa, at, end) in enumerate(zip(rows[r].tolist(), (queries.begin[given.query[r]] + begin[r]).tolist(), subjects.begin[given.subject[r]].tolist(), first.tolist(), np.minimum(slen[r], first + n + 2 * even).tolist(), strict=True)):
                q[c, :m] = letters[qa : qa + m]
                a = max(at, 0)
                s[c, a - at : end - at] = others[sa + a : sa + end]
            backwards, forwards = np.full((n + 2 * (even - 1), len(r)), _QUERY[4], unsigned), np.empty((n + 2 * even, len(r)), unsigned)
            for c in range(0, len(r), 64):  # turned by strips, as columns lie far apart
                backwards[even - 1 : even - 1 + n, c : c + 64] = q[c : c + 64, ::-1].T
                forwards[:, c : c + 64] = s[c : c + 64].T
            out[r] = side_by_side(backwards, forwards, width[r], scoring, kind, cap)

    score(np.flatnonzero((rows > 0) & (reach >= least)), np.int8, _CAP)
    again = np.flatnonzero(out >= _CAP)
    out[again] = np.where(_equal(queries, subjects, Bands(*(x[again] for x in given))), reach[again], -1)  # all that is possible
    again = again[out[again] < 0]
    fits = reach[again] < 32_000
    score(again[fits], np.int16, None)
    score(again[~fits], np.int32, None)
    return out


def _tasks(tidy: DataFrame, texts: DataFrame, cores: int) -> tuple[DataFrame, int]:
    """Queries and subjects as rows of packed texts, each in all tasks of its block, and the number of tasks."""
    size = lambda df: df.agg(F.sum(F.length("sequence")).alias("n")).first().n or 0
    across = -(-max(size(tidy), 1) // LETTERS)
    down = max(-(-max(size(texts), 1) // LETTERS), -(-2 * cores // across))
    q = tidy.select(F.pmod(F.xxhash64("design_id", "qseqid"), F.lit(across)).alias("block"), F.lit(0).alias("side"), "design_id", F.col("qseqid").alias("name"), "sequence")
    s = texts.select(F.pmod(F.xxhash64("name"), F.lit(down)).alias("block"), F.lit(1).alias("side"), F.lit("").alias("design_id"), "name", "sequence")
    schema = "block long, side int, design_id string, name string, n int, plain boolean, data binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, plain, data = [], [], []
            for text in b.column("sequence").to_pylist():
                d = _LETTER[np.frombuffer(text.encode(), np.uint8)]
                n.append(len(d))
                plain.append(bool((d < 4).all()))
                four = np.append(d, np.zeros(-len(d) % 4, np.uint8)).reshape(-1, 4) if plain[-1] else None
                data.append(text.encode() if four is None else (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes())
            yield pa.record_batch([*[b.column(c) for c in ("block", "side", "design_id", "name")], pa.array(n, pa.int32()), pa.array(plain), pa.array(data, pa.binary())], names=["block", "side", "design_id", "name", "n", "plain", "data"])

    both = q.unionByName(s).mapInArrow(pack, schema)
    every = F.when(F.col("side") == 0, F.transform(F.sequence(F.lit(0), F.lit(down - 1)), lambda x: F.col("block") * down + x)).otherwise(F.transform(F.sequence(F.lit(0), F.lit(across - 1)), lambda x: x * down + F.col("block")))
    return both.select(F.explode(every).alias("task"), "side", "design_id", "name", "n", "plain", "data"), across * down


_PLAIN = np.frombuffer(b"ACGT", np.uint8)


def _text(n: int, plain: bool, data: bytes) -> bytes:
    if not plain:
        return data
    d = np.frombuffer(data, np.uint8)
    return _PLAIN[np.stack([d & 3, d >> 2 & 3, d >> 4 & 3, d >> 6], 1).ravel()[:n]].tobytes()


def _common(texts: DataFrame, copies: DataFrame, word: int, common: int | None) -> np.ndarray:
    """Canonical and turned codes of words at more than `common` places; they are counted only if a sum over many words is as large."""
    if common is None:
        return np.zeros(0, np.int64)
    counted = texts.join(copies.groupBy("name").agg(F.count(F.lit(1)).alias("copies")), "name")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SLOTS, np.int64)
        for b in batches:
            for text, n in zip(b.column("sequence").to_pylist(), b.column("copies").to_pylist(), strict=True):
                _, code, _ = packed.codes(np.frombuffer(text.encode(), np.uint8), word, packed._STRICT)
                total += np.bincount(_slots(code, 16), minlength=_SLOTS) * n
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["slot", "n"])

    full = counted.select("sequence", "copies").mapInArrow(sums, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") > common)
    slots = np.array([r.slot for r in full.collect()], np.int64)
    if not len(slots):
        return slots

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(_SLOTS, bool)
        wanted[slots] = True
        for b in batches:
            for text, n in zip(b.column("sequence").to_pylist(), b.column("copies").to_pylist(), strict=True):
                _, code, _ = packed.codes(np.frombuffer(text.encode(), np.uint8), word, packed._STRICT)
                code, times = np.unique(code[wanted[_slots(code, 16)]], return_counts=True)
                yield pa.record_batch([pa.array(code), pa.array(times * n)], names=["code", "n"])

    many = counted.select("sequence", "copies").mapInArrow(words, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") > common)
    code = np.array([r.code for r in many.select("code").collect()], np.int64)
    turned = np.zeros_like(code)
    for i in range(word):
        turned |= (3 - (code >> np.int64(2 * i) & 3)) << np.int64(2 * (word - 1 - i))
    return np.unique(np.concatenate([code, turned]))


def subject_scores(queries: DataFrame, subjects: DataFrame, word: int, scoring: align.Scoring, least: int, most: int, common: int | None = align.COMMON) -> DataFrame:
    """design_id, qseqid, saccver, score: of each query the `most` subjects with the best scores of at least `least` (then names).

    `queries` has design_id, qseqid and sequence; `subjects` has saccver and sequence and belongs to all designs.
    """
    spark = queries.sparkSession
    tidy = settled(queries.select("design_id", "qseqid", normalize(F.col("sequence")).alias("sequence")).where(F.length("sequence") >= word))
    stored = settled(subjects.select("saccver", normalize(F.col("sequence")).alias("sequence")).where(F.length("sequence") >= word))
    longest = max(df.agg(F.max(F.length("sequence"))).first()[0] or 0 for df in (tidy, stored))
    if longest > LONG:
        found = align.local_alignments(tidy, stored, word, scoring, least, common, most)
        return _best(settled(found.groupBy("design_id", "qseqid", "saccver").agg(F.max("score").alias("score"))), most)
    # Equal texts have one name, which is ordered as the first of their subjects' names.
    key = F.sha2("sequence", 256)
    keyed = settled(stored.withColumn("name", F.concat_ws("\0", F.min("saccver").over(Window.partitionBy(key)), key)))
    copies, texts = keyed.select("name", "saccver"), settled(keyed.select("name", "sequence").dropDuplicates(["name"]))
    frequent = _common(texts, copies, word, common)
    blocks, n = _tasks(tidy, texts, spark.sparkContext.defaultParallelism)

    def task(table: pa.Table) -> pa.Table:
        rows = [[r for r in table.select(["side", "design_id", "name", "n", "plain", "data"]).to_pylist() if r["side"] == side] for side in (0, 1)]
        texts_ = [[_text(r["n"], r["plain"], r["data"]) for r in of] for of in rows]
        made = _task([(r["design_id"], r["name"]) for r in rows[0]], [r["name"] for r in rows[1]], *texts_, word, scoring, least, most, frequent)
        return pa.table([pa.array(c, t) for c, t in zip(made, (pa.string(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["design_id", "qseqid", "name", "score"])

    # Far more partitions than tasks, so that few of them share one.
    found = settled(blocks.repartition(min(4 * n, 4000), "task").groupBy("task").applyInArrow(task, _SCORES))
    each = found.join(small(settled(copies.distinct())), "name").groupBy("design_id", "qseqid", "saccver").agg(F.max("score").alias("score"))
    return _best(settled(each), most)


def _best(found: DataFrame, most: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("design_id", "qseqid").orderBy(F.desc("score"), "saccver"))
    return found.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")


def _task(keys: list[tuple[str, str]], names: list[str], queries: list[bytes], subjects: list[bytes], word: int, scoring: align.Scoring, least: int, most: int, common: np.ndarray) -> tuple[list, list, list, list]:
    """Columns of `_SCORES`: of each query the best subjects of this block."""
    if not queries or not subjects:
        return [], [], [], []
    q, s = Texts(queries + [_turned(t) for t in queries]), Texts(subjects)
    found = bands(q, s, word, common)
    score = scores(q, s, found, scoring, least)
    place = np.empty(len(names), np.int64)
    place[sorted(range(len(names)), key=lambda i: names[i])] = range(len(names))
    good = score >= least
    query, subject, score = found.query[good] % len(queries), found.subject[good], score[good]
    order = np.lexsort((-score, subject, query))
    query, subject, score = query[order], subject[order], score[order]
    one = np.ones(len(query), bool)
    one[1:] = (query[1:] != query[:-1]) | (subject[1:] != subject[:-1])
    query, subject, score = query[one], subject[one], score[one]
    order = np.lexsort((place[subject], -score, query))
    query, subject, score = query[order], subject[order], score[order]
    kept = np.arange(len(query)) - np.searchsorted(query, query) < most
    return [keys[i][0] for i in query[kept]], [keys[i][1] for i in query[kept]], [names[i] for i in subject[kept]], score[kept].tolist()


def read_scores(queries: DataFrame, reference: DataFrame, max_subjects: int = S.Defaults.max_subjects, max_evalue: float = S.Defaults.max_evalue, word: int = 11) -> DataFrame:
    """design_id, qseqid, saccver, staxids and bitscore of the best segment of each subject that `align.read_hits` keeps."""
    space = float(reference.agg(F.sum(F.length("sequence"))).first()[0] or 1)
    shortest = queries.agg(F.min(F.length("sequence"))).first()[0] or 1
    least = max(word * align.WIDE.match, align.WIDE.least(max_evalue, space * max(shortest, 1)))
    found = subject_scores(queries.withColumnRenamed("representative_id", "qseqid"), reference, word, align.WIDE, least, max_subjects)
    length = queries.select("design_id", F.col("representative_id").alias("qseqid"), F.length("sequence").cast("long").alias("qlen"))
    bits = align.WIDE.bits(F.col("score"))
    kept = found.join(length, ["design_id", "qseqid"]).where(F.col("qlen") * F.lit(space) * F.pow(F.lit(2.0), -bits) <= max_evalue)
    return kept.join(reference.select("saccver", "staxids").distinct(), "saccver").select("design_id", "qseqid", "saccver", "staxids", F.format_string("%.1f", bits).alias("bitscore"))
