"""Hard negatives by a pivot table: for each anchor its best rows of the same label, and for each of those the rows of another
label that score almost as well.

A component is taken as floor(256 x), so scores are whole numbers. A row is augmented by one component that brings all rows to
the same length M, an anchor by a zero; then |row - anchor|^2 = |anchor|^2 + M^2 - 2 score, and a score has become a Euclidean
distance. Each row stores its distances to a few pivots. By the triangle inequality these bracket its distance to any anchor,
and so its score: rows, and whole batches of rows near one pivot, whose bracket cannot reach what an anchor still needs are
left out, and the scores of all others are computed exactly. What is needed rises as a task goes on, but rows are left out only
if they lose against rows already seen; results are those of all pairs.

The rows lie in a table that is dealt by range of (nearest pivot, distance, id), so that neighbours share batches and no pivot
fills one task. Anchors are a part of the rows and grow with them: they are taken in blocks of at most `BLOCK`, each sent to
all tasks as an array of bounded size, and each block makes two passes over the table (positives, then negatives). Tasks return
at most five rows for each anchor, or for each pair, and a window ranks them.

The pivots are chosen from at most `SAMPLE` rows (those with the smallest hashes of their id); they decide only how much is left
out. On vectors without any structure, where all pairs are about equally far, the brackets leave little out.

Edge cases: rows with a null label, a null vector, or a null or non-finite component take no part. Rows of other lengths than
the longest are continued by zeros. Rows that repeat an id are rows of their own, but never positives of an anchor of that id; an
id of null comes last among ties and is no anchor. Ties go to the smaller id. An empty table gives an empty result; extra
columns are ignored. Components so large that a score would leave the whole numbers of a double are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandsieve.llm.common import partitions, scratch, written

PIVOTS, SAMPLE = 8, 1024
#: Anchors of a block, and the lanes (anchors, or pairs of anchor and positive) that a task scores at once.
BLOCK, LANES = 8192, 512
N_POSITIVES = N_NEGATIVES = 5
#: Least share of the positive's score, in percent.
LEAST = 80
_NO_ID = np.iinfo(np.int64).max
_LOW, _HIGH = -(1 << 60), 1 << 60
_LANE = np.dtype([("anchor", "i8"), ("positive", "i8"), ("score", "i8"), ("label", "i8"), ("low", "i8"), ("high", "i8")])
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(embeddings: DataFrame, relabel: bool = True) -> DataFrame:
    """vec_id, label and v (whole numbers) of the rows that take part; `relabel`: labels as the contract shifts them."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label: Column = F.col("label").cast("long")
    if relabel:
        label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; short ones are continued by zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Points of the sample, each the farthest from those before it."""
    taken = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(taken) < min(n, len(sample)):
        taken.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[taken[-1]]) ** 2).sum(1))
    return sample[taken]


def augmented(x: np.ndarray, most: float) -> np.ndarray:
    """Rows continued by the component that gives all of them the square length `most`."""
    return np.concatenate([x, np.sqrt(np.maximum(most - (x**2).sum(1), 0))[:, None]], 1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * x @ pivots.T, 0))


class Best:
    """For each lane the best (score, id) rows so far: highest score first, then the smaller id."""

    def __init__(self, lanes: int, n: int) -> None:
        self.n = n
        self.score = np.full((lanes, n), _LOW, np.int64)
        self.id = np.full((lanes, n), _NO_ID, np.int64)

    def add(self, lane: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """More rows of lanes that are merged with what is there."""
        if not len(lane):
            return
        touched = np.unique(lane)
        lane = np.concatenate([lane, np.repeat(touched, self.n)])
        score = np.concatenate([score, self.score[touched].ravel()])
        ids = np.concatenate([ids, self.id[touched].ravel()])
        order = np.lexsort((ids, -score, lane))
        lane, score, ids = lane[order], score[order], ids[order]
        place = np.arange(len(lane)) - np.searchsorted(lane, lane)
        first = place < self.n
        self.score[lane[first], place[first]] = score[first]
        self.id[lane[first], place[first]] = ids[first]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lane, place = np.nonzero(self.score > _LOW)
        return lane, self.score[lane, place], self.id[lane, place]


def bracketed(dx: np.ndarray, da: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Which rows may lie between `near` and `far` of each lane, by distances to the pivots: row p of `dx` and `da`."""
    out = np.ones((dx.shape[0], da.shape[0]), bool)
    for p in range(dx.shape[1]):
        x, a = dx[:, p, None], da[None, :, p]
        out &= np.abs(x - a) <= far
        out &= x + a >= near
    return out


def _scan(table: DataFrame, lanes: Broadcast, width: int, most: float, same: bool, n: int) -> DataFrame:
    """The best `n` rows of each lane and task: of the lane's label (`same`) or of others, with low <= score <= high."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info, q, da = lanes.value
        best = Best(len(info), n)
        square = (q**2).sum(1)
        slack = 1e-5 * (1 + float(np.sqrt(most)))
        for b in batches:
            ids = b.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            labels, x, dx = b.column(1).to_numpy(zero_copy_only=False), _matrix(b.column(2), width), _matrix(b.column(3), da.shape[1])
            order = np.argsort(ids, kind="stable")  # so that a row's place breaks ties
            ids, labels, x, dx = ids[order], labels[order], x[order], dx[order]
            low_d, high_d = dx.min(0), dx.max(0)
            for i in range(0, len(info), LANES):
                part = slice(i, i + LANES)
                need = np.maximum(best.score[part, -1], info["low"][part])
                reach = square[part] + most
                far = np.sqrt(np.maximum(reach - 2.0 * need, 0)) + slack
                near = np.sqrt(np.maximum(reach - 2.0 * info["high"][part], 0)) - slack
                gap = np.maximum(low_d - da[part], da[part] - high_d).max(1)
                live = np.flatnonzero((gap <= far) & ((da[part] + high_d).min(1) >= near))
                if not len(live):
                    continue
                ok = bracketed(dx, da[part][live], near[live], far[live])
                ok &= (labels[:, None] == info["label"][part][live]) == same
                rows = np.flatnonzero(ok.any(1))
                if not len(rows):
                    continue
                live, ok = live + i, ok[rows]
                s = (x[rows] @ q[live].T).astype(np.int64)
                last, last_id = best.score[live, -1], best.id[live, -1]
                ok &= (s > last) | ((s == last) & (ids[rows, None] < last_id))
                ok &= (s >= info["low"][live]) & (s <= info["high"][live])
                if same:
                    ok &= ids[rows, None] != info["anchor"][live]
                if len(rows) > n and np.count_nonzero(ok) > 8 * len(live):
                    key = np.where(ok, s * len(rows) + np.arange(len(rows) - 1, -1, -1)[:, None], np.iinfo(np.int64).min)
                    ok &= key >= np.partition(key, len(rows) - n, axis=0)[len(rows) - n]
                r, c = np.nonzero(ok)
                best.add(live[c], s[r, c], ids[rows][r])
        lane, score, found = best.rows()
        out = info[lane]
        yield pa.record_batch(
            [pa.array(lane), pa.array(np.ascontiguousarray(out["anchor"])), pa.array(np.ascontiguousarray(out["positive"])), pa.array(np.ascontiguousarray(out["score"])), pa.array(score), pa.array(found)],
            names=["lane", "anchor_id", "positive_id", "positive_score", "score", "id"],
        )

    return table.mapInArrow(run, "lane long, anchor_id long, positive_id long, positive_score long, score long, id long")


def _ranked(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("lane").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def pivot_table(rows: DataFrame, pivots: np.ndarray, width: int, most: float) -> DataFrame:
    """The rows with their distances to the pivots, neighbours together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = distances(augmented(_matrix(b.column(2), width), most), pivots)
            region = d.argmin(1)
            flat = pa.ListArray.from_arrays(np.arange(len(d) + 1, dtype=np.int32) * d.shape[1], pa.array(d.ravel()))
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), flat, pa.array(region.astype(np.int32)), pa.array(d[np.arange(len(d)), region])], names=["vec_id", "label", "v", "d", "region", "nearest"])

    placed = rows.mapInArrow(run, "vec_id long, label long, v array<long>, d array<double>, region int, nearest double")
    order = ("region", "nearest", "vec_id")
    return placed.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)


def mine(rows: DataFrame, every: int = 100, n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """The first `n_negatives` hard negatives of each anchor (id divisible by `every`) and each of its first `n_positives` positives.

    `rows`: vec_id, label and v, as `quantised` gives them.
    """
    spark = rows.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    width, most = rows.agg(F.max(F.size("v")), F.max(square)).first()
    if width is None:
        return spark.createDataFrame([], RESULT)
    if most >= 2.0**53:
        raise ValueError(f"components are too large for whole scores: a vector's square is {most}")
    # Bounded: the sample of which pivots are chosen.
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).select("v").toArrow()
    pivots = choose_pivots(augmented(_matrix(sample.column(0), width), most))
    table, _ = written(pivot_table(rows, pivots, width, most), "pivots")
    anchors, _ = written(table.where(F.col("vec_id") % every == 0).select("vec_id", "label", "v", "d", F.monotonically_increasing_id().alias("n")), "anchors")
    total = anchors.count()
    blocks = _blocks(anchors, total, block)
    out = scratch(spark, "negatives")
    spark.createDataFrame([], RESULT).write.parquet(f"{out}/block=-1")
    for number in range(blocks):
        some = anchors.where(F.pmod(F.xxhash64("n"), F.lit(blocks)) == number).orderBy("n").toArrow()
        q, da = _matrix(some.column("v"), width), _matrix(some.column("d"), len(pivots))
        if not len(q):
            continue
        # An anchor's augmented component is zero, unlike that of the row it is.
        da = distances(np.concatenate([q, np.zeros((len(q), 1))], 1), pivots)
        info = np.zeros(len(q), _LANE)
        info["anchor"], info["label"], info["low"], info["high"] = some.column("vec_id").to_numpy(), some.column("label").to_numpy(), _LOW, _HIGH
        sent = spark.sparkContext.broadcast((info, q, da))
        found = _ranked(_scan(table, sent, width, most, True, n_positives), n_positives).orderBy("lane", "rank").toArrow()
        lane, score, ids = (found.column(c).to_numpy() for c in ("lane", "score", "id"))
        pairs = info[lane]
        pairs["positive"], pairs["score"], pairs["high"], pairs["low"] = ids, score, score, -((-least * score) // 100)
        again = spark.sparkContext.broadcast((pairs, q[lane], da[lane]))
        got = _ranked(_scan(table, again, width, most, False, n_negatives), n_negatives)
        named = lambda c: F.when(F.col(c) != int(_NO_ID), F.col(c)).alias(f"{c}")
        got = got.select("anchor_id", named("positive_id"), F.col("rank").cast("int").alias("rank"), named("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        got.write.parquet(f"{out}/block={number}")
        sent.destroy()
        again.destroy()
    return spark.read.schema(RESULT + ", block int").parquet(out).drop("block")


def _blocks(anchors: DataFrame, total: int, block: int) -> int:
    """How many blocks keep each of them within `block` anchors, shown by a count."""
    n = -(-total // block)
    while n:
        number = F.pmod(F.xxhash64("n"), F.lit(n))
        largest = anchors.groupBy(number.alias("b")).count().agg(F.max("count")).first()[0] if n > 1 else total
        if largest <= block:
            return n
        n += 1 + n // 8
    return 0


__all__ = ["Best", "augmented", "bracketed", "choose_pivots", "distances", "mine", "pivot_table", "quantised"]
