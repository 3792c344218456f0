"""K-mers of up to 31 bases as one long each, two bits a base: cut and made canonical in arrays over Arrow batches.

A is 0, C 1, G 2 and T 3, so codes are ordered as their texts are, and shuffles and joins move eight bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandsieve.functions.sequence import BASES

MOST = 31
#: Window starts that one row of `coded` holds.
TILE = 1 << 16
#: Codes of a set that is sent to all executors: 32 MB.
MOST_WANTED = 4_000_000
#: Buckets that the k-mers of each key are dealt to when they are counted.
BUCKETS = 1024
#: Bases that a task sums up before it deals them out, bases worked on at once, and codes that are summed up together at least.
_HELD, _RUN, _MERGED = 8_000_000, 1 << 18, 2_000_000
#: An odd number, and what undoes a multiplication with it modulo any power of two up to 2**64.
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STRICT = np.full(256, 4, np.uint8)
_STRICT[[ord(b) for b in BASES]] = range(4)
_LENIENT = _STRICT.copy()
_LENIENT[[ord(b) for b in "acgtUu"]] = [0, 1, 2, 3, 3, 3]


def pack(kmer: Column) -> Column:
    """The code of a k-mer of A, C, G and T."""
    return F.conv(F.translate(kmer, BASES, "0123"), 4, 10).cast("long")


def unpack(code: Column, k: int) -> Column:
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), k, "0"), "0123", BASES)


def _rolled(digits: np.ndarray, k: int, first_is_high: bool) -> np.ndarray:
    """Codes of all runs of k digits, by doubling the span; the first digit is the highest, or the lowest."""

    def put(a: np.ndarray, n: int, b: np.ndarray, m: int) -> np.ndarray:
        a, b = a[: len(a) - m], b[n:]
        a, b = a[: len(b)], b[: len(a)]
        return (a << np.int64(2 * m)) | b if first_is_high else a | (b << np.int64(2 * n))

    span, have, done, at = 1, digits.astype(np.int64), None, 0
    n = k
    while n:
        if n & 1:
            done, at = (have, span) if done is None else (put(done, at, have, span), at + span)
        n >>= 1
        if n:
            have, span = put(have, span, have, span), span * 2
    return done[: len(digits) - k + 1]


def codes(sequence: np.ndarray, k: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, canonical code and strand (1: as it stands, 2: reversed, 3: both) of each window of k bases, of ASCII bytes."""
    none = np.zeros(0, np.int64)
    if len(sequence) < k:
        return none, none, np.zeros(0, np.int8)
    digits = table[sequence]
    bad = np.concatenate([[0], np.cumsum(digits > 3)])
    start = np.flatnonzero(bad[k:] == bad[:-k])
    if not len(start):
        return none, none, np.zeros(0, np.int8)
    digits = digits & 3
    one, two = _rolled(digits, k, True)[start], _rolled(3 - digits, k, False)[start]
    return start, np.minimum(one, two), np.where(one < two, 1, np.where(one > two, 2, 3)).astype(np.int8)


class Wanted:
    """A sorted set of codes on all executors, with a small bitmap that turns most other codes away."""

    def __init__(self, spark: SparkSession, codes_: np.ndarray) -> None:
        self.shared = spark.sparkContext.broadcast((codes_, _bitmap(codes_)))

    def among(self, codes_: np.ndarray) -> np.ndarray:
        """Places of the codes that are in the set."""
        known, bits = self.shared.value
        some = np.flatnonzero(bits[_slot(codes_)])
        if not len(known) or not len(some):
            return some[:0]
        at = np.minimum(np.searchsorted(known, codes_[some]), len(known) - 1)
        return some[known[at] == codes_[some]]


def _slot(codes_: np.ndarray) -> np.ndarray:
    return ((codes_.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)


def _bitmap(codes_: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 22, bool)
    bits[_slot(codes_)] = True
    return bits


def wanted(rows: DataFrame, most: int = MOST_WANTED) -> Wanted | None:
    """The distinct values of `code` as a set for all executors, if they are at most `most`; else None."""
    distinct = rows.select("code").where("code is not null").distinct().limit(most + 1).toArrow().column(0).to_numpy()
    return Wanted(rows.sparkSession, np.sort(distinct.astype(np.int64))) if len(distinct) <= most else None


def coded(sequences: DataFrame, k: int, columns: tuple[str, ...], lenient: bool = False, only: Wanted | None = None) -> DataFrame:
    """`columns` and arrays `starts` (0-based), `codes` and `strands` of the windows of A, C, G and T of `sequence`.

    A row for each 65,536 starts, so that a chromosome is not one row. `lenient`: lower case counts, and U as T.
    `only`: windows of other codes are left out here, before Spark sees them.
    """
    if not 0 < k <= MOST:
        raise ValueError(f"k must be from 1 to {MOST}")
    table = _LENIENT if lenient else _STRICT
    made = [T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("strands", T.ArrayType(T.ByteType()))]
    given = sequences.select(*columns, F.coalesce("sequence", F.lit("")).alias("sequence"))
    schema = T.StructType([*given.schema.fields[:-1], *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[int] = []
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            held = 0

            def out() -> pa.RecordBatch:
                ends = np.concatenate([[0], np.cumsum([len(f[0]) for f in found])]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(ends, np.concatenate([f[i] for f in found])) for i in range(3)]
                kept = [b.column(i).take(pa.array(rows)) for i in range(b.num_columns - 1)]
                return pa.record_batch([*kept, *lists], names=schema.names)

            for i, text in enumerate(b.column(b.num_columns - 1)):
                data = np.frombuffer(text.as_buffer() or b"", np.uint8)
                for at in range(0, max(len(data) - k + 1, 0), TILE):
                    start, code, strand = codes(data[at : at + TILE + k - 1], k, table)
                    if only is not None:
                        few = only.among(code)
                        start, code, strand = start[few], code[few], strand[few]
                    if len(start):
                        rows.append(i)
                        found.append((start + at, code, strand))
                        held += len(start)
                    if held > 500_000:
                        yield out()
                        rows, found, held = [], [], 0
            if found:
                yield out()

    return given.mapInArrow(run, schema)


def code_rows(sequences: DataFrame, k: int, columns: tuple[str, ...], lenient: bool = False, only: Wanted | None = None) -> DataFrame:
    """`columns` and `code`, a row for each window."""
    return coded(sequences, k, columns, lenient, only).select(*columns, F.explode("codes").alias("code"))


def distinct_windows(sequences: DataFrame, k: int, columns: tuple[str, ...] = ()) -> DataFrame:
    """`columns` and code of each distinct window of k bases as it stands, strands apart; made distinct in each task first."""
    given = sequences.select(*columns, F.coalesce("sequence", F.lit("")).alias("sequence"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("code", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []
        held: dict[tuple, list[np.ndarray]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for key, parts in held.items():
                code = np.unique(np.concatenate(parts))
                yield pa.record_batch([*[pa.array([v] * len(code), t) for v, t in zip(key, types, strict=True)], pa.array(code)], names=schema.names)

        for b in batches:
            types = [b.column(i).type for i in range(len(columns))]
            named = list(zip(*[b.column(i).to_pylist() for i in range(len(columns))], strict=True)) if columns else [()] * b.num_rows
            for key, text in zip(named, b.column(len(columns)), strict=True):
                digits = _STRICT[np.frombuffer(text.as_buffer() or b"", np.uint8)]
                for at in range(0, max(len(digits) - k + 1, 0), TILE):
                    part = digits[at : at + TILE + k - 1]
                    bad = np.concatenate([[0], np.cumsum(part > 3)])
                    code = _rolled(part & 3, k, True)[bad[k:] == bad[:-k]]
                    held.setdefault(key, []).append(code)
                    size += len(code)
                if size > 4_000_000:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    return given.mapInArrow(run, schema).distinct()


def _canonical(sequence: np.ndarray, k: int, table: np.ndarray) -> np.ndarray:
    """The codes alone, as `codes` gives them."""
    if len(sequence) < k:
        return np.zeros(0, np.int64)
    digits = table[sequence]
    bad = np.concatenate([[0], np.cumsum(digits > 3, dtype=np.int32)])
    digits &= 3
    least = np.minimum(_rolled(digits, k, True), _rolled(3 - digits, k, False))
    return least if not bad[-1] else least[bad[k:] == bad[:-k]]


def _summed(mixed: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and their sums; value and place are sorted as one number where both fit in 64 bits."""
    if not len(mixed):
        return mixed, n
    bits = int(len(mixed)).bit_length()
    if 2 * k + bits <= 64:
        both = np.sort((mixed << np.uint64(bits)) | np.arange(len(mixed), dtype=np.uint64))
        mixed, n = both >> np.uint64(bits), n[(both & np.uint64((1 << bits) - 1)).astype(np.int64)]
    else:
        order = np.argsort(mixed)
        mixed, n = mixed[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], mixed[1:] != mixed[:-1]]))
    return mixed[first], np.add.reduceat(n, first)


def dealt(sequences: DataFrame, k: int, keys: tuple[str, ...], buckets: int, lenient: bool = False) -> DataFrame:
    """`keys`, bucket, `codes` and `copies`: canonical k-mers, already summed over some millions of bases, dealt evenly.

    A k-mer's code times an odd number, modulo their number, is another code of the same width; buckets are ranges of it. So no
    bucket gets more for words that are alike, and each takes a like share of what is added. `codes` has the bytes of all
    values by place (all first bytes, then all second ones, ...), which makes sorted values compress well.
    """
    table, whole = _LENIENT if lenient else _STRICT, 1 << 2 * k
    width = 4 if k <= 16 else 8
    edges = np.array([-(-i * whole // buckets) for i in range(buckets)], np.uint64)
    given = sequences.select(*keys, F.coalesce("sequence", F.lit("")).alias("sequence"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("bucket", T.IntegerType()), T.StructField("codes", T.BinaryType()), T.StructField("copies", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []
        held: dict[tuple, list[bytes]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for key, parts in held.items():
                bases = np.frombuffer(b"N".join(parts), np.uint8)
                code = np.concatenate([_canonical(bases[at : at + _RUN + k - 1], k, table) for at in range(0, len(bases), _RUN)]).view(np.uint64)
                mixed = np.sort((code * _ODD) & np.uint64(whole - 1))
                if not len(mixed):
                    continue
                first = np.flatnonzero(np.concatenate([[True], mixed[1:] != mixed[:-1]]))
                n, mixed = np.diff(np.append(first, len(mixed))).astype(np.int32), mixed[first]
                at = np.append(np.searchsorted(mixed, edges), len(mixed)).tolist()
                some = [i for i in range(buckets) if at[i] < at[i + 1]]
                raw = mixed.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
                yield pa.record_batch([
                    *[pa.array([v] * len(some), t) for v, t in zip(key, types, strict=True)], pa.array(some, pa.int32()),
                    pa.array([raw[at[i] : at[i + 1]].T.tobytes() for i in some], pa.binary()), pa.array([n[at[i] : at[i + 1]].tobytes() for i in some], pa.binary()),
                ], names=schema.names)

        for b in batches:
            types = [b.column(i).type for i in range(len(keys))]
            named = list(zip(*[b.column(i).to_pylist() for i in range(len(keys))], strict=True)) if keys else [()] * b.num_rows
            for key, text in zip(named, b.column(b.num_columns - 1), strict=True):
                data = memoryview(text.as_buffer() or b"")
                for at in range(0, max(len(data) - k + 1, 0), TILE):
                    part = bytes(data[at : at + TILE + k - 1])
                    held.setdefault(key, []).append(part)
                    size += len(part)
                    if size > _HELD:
                        yield from out()
                        held, size = {}, 0
        yield from out()

    return given.mapInArrow(run, schema)


def _tallied(sequences: DataFrame, k: int, keys: tuple[str, ...], lenient: bool, buckets: int | None, made: list[T.StructField], tell: Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, ...]]]) -> DataFrame:
    """`keys` and what `tell` makes of the codes (in no order) and copies of each bucket.

    A bucket is summed where it lies, and its sums are final: what has come in is summed up whenever it has doubled, so the
    work is in proportion to it, and a task holds the distinct k-mers of one bucket at a time.
    """
    parts = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = dealt(sequences, k, keys, buckets or BUCKETS, lenient)
    ordered = rows.repartition(parts, *keys, "bucket").sortWithinPartitions(*keys, "bucket")
    schema = T.StructType([*rows.schema.fields[: len(keys)], *made])
    width = 4 if k <= 16 else 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        key, kept, fresh, size = None, none, [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _summed(np.concatenate([kept[0], *[f[0] for f in fresh]]), np.concatenate([kept[1], *[f[1] for f in fresh]]), k)

        def out() -> Iterator[pa.RecordBatch]:
            mixed, n = merged()
            for columns in tell(((mixed * _BACK) & np.uint64((1 << 2 * k) - 1)).view(np.int64), n):
                yield pa.record_batch([*[pa.array([v] * len(columns[0]), t) for v, t in zip(key[:-1], types, strict=True)], *map(pa.array, columns)], names=schema.names)

        for b in batches:
            types = [b.column(i).type for i in range(len(keys))]
            named = zip(*[b.column(i).to_pylist() for i in range(len(keys) + 1)], strict=True)
            for own, code, n in zip(named, b.column(len(keys) + 1), b.column(len(keys) + 2), strict=True):
                if own != key:
                    if key is not None:
                        yield from out()
                    key, kept, fresh, size = own, none, [], 0
                values = np.ascontiguousarray(np.frombuffer(code.as_buffer(), np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel()
                fresh.append((values.astype(np.uint64), np.frombuffer(n.as_buffer(), np.int32).astype(np.int64)))
                size += len(values)
                if size > max(_MERGED, len(kept[0])):
                    kept, fresh, size = merged(), [], 0
        if key is not None:
            yield from out()

    return ordered.mapInArrow(run, schema)


def counted(sequences: DataFrame, k: int, keys: tuple[str, ...], lenient: bool = False, buckets: int | None = None) -> DataFrame:
    """`keys`, code and `n` (copies) of each canonical k-mer of `sequence`."""

    def tell(code: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        for a in range(0, len(code), 1_000_000):
            yield code[a : a + 1_000_000], n[a : a + 1_000_000]

    return _tallied(sequences, k, keys, lenient, buckets, [T.StructField("code", T.LongType()), T.StructField("n", T.LongType())], tell)


def profiled(sequences: DataFrame, k: int, keys: tuple[str, ...], lenient: bool = False, buckets: int | None = None) -> DataFrame:
    """`keys`, windows, kmers (distinct canonical ones), first and last (code) of `sequence`; no k-mer leaves its bucket."""
    names = ("windows", "kmers", "first", "last")

    def tell(code: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        yield tuple(np.array([x], np.int64) for x in (n.sum(), len(code), code.min(), code.max()))

    rows = _tallied(sequences, k, keys, lenient, buckets, [T.StructField(c, T.LongType()) for c in names], tell)
    return rows.groupBy(*keys).agg(F.sum("windows").alias("windows"), F.sum("kmers").alias("kmers"), F.min("first").alias("first"), F.max("last").alias("last"))
