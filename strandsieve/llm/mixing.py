"""Mixing sources to target weights by entropy balancing.

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating; they share a multiple of all words, and none
gets more than a cap times its own words, the excess being shared anew by weight.

Rates: among all document rates r in [0, cap] the ones nearest to 1 in relative entropy whose token sums meet the
targets are r = min(cap, exp(lambda_s * size / mean_s)), with one dual variable for each source. The dual is convex;
safeguarded Newton iterations solve it for all sources at once, each iteration being one aggregation over the
(source, size) histogram, which is all that a rate depends on.

Copies: rates become whole copies by carrying the rounding error, in words, from large sizes to small ones in each
source, so a source's words end within about half a small document of its target. Within one (source, size) group the
documents that get the extra copy are those with the smallest hashes of doc_id, found in buckets of bounded size.

Edge cases: null or empty text has size 0 and gets one copy; null sources form one source; sources without words have
target 0; rows that repeat a doc_id are decided alike; an empty table gives an empty result; extra columns are ignored
by `mix_sizes` and kept by `mix_documents`.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandsieve.llm.common import WORD, bounded, discard, packed, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
#: Documents of one (source, size) group whose hashes one task orders.
BUCKET = 256
TOLERANCE = 1e-7
MOST_STEPS = 200

def with_size(docs: DataFrame) -> DataFrame:
    """Adds `_size`, the number of words, and `_key`, a source key that is never null."""
    return docs.withColumns({"_size": F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long"), "_key": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))})


def histogram(sized: DataFrame) -> DataFrame:
    """source, key, size and the number of documents; rows (pre-aggregated on the map side) are at most sources x sizes."""
    return sized.groupBy("_key", "source", "_size").agg(F.count(F.lit(1)).alias("_n"))


def source_targets(groups: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """_key, source_size and target of each source. Works on one row a source; its loop moves three numbers to the driver."""
    per = groups.groupBy("_key", "source").agg(F.sum(F.col("_size") * F.col("_n")).alias("source_size"), F.sum("_n").alias("_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") - 1) % len(weights) + 1)
    per, _ = written(per.withColumn("_rank", rank).withColumn("_weight", weight), "sources")
    want = share * (per.agg(F.sum("source_size")).first()[0] or 0)
    level = None
    while True:
        most = F.col("source_size") * F.lit(cap)
        full = F.lit(False) if level is None else F.lit(level) * F.col("_weight") >= most
        open_weight, held = per.agg(F.sum(F.when(~full, F.col("_weight"))), F.sum(F.when(full, most))).first()
        new = (want - (held or 0)) / open_weight if open_weight else level
        if new is None or new == level or (level is not None and new <= level):
            break
        level = new
    target = F.least(F.col("source_size") * F.lit(cap), F.lit(float(level or 0)) * F.col("_weight"))
    return per.select("_key", "source", "source_size", "_docs", target.alias("target"))


def _rate(cap: float) -> F.Column:
    z = F.col("_size") / F.col("_mean")
    return F.least(F.lit(cap), F.exp(F.least(F.col("_lambda") * z, F.lit(700.0))))


def solve_dual(groups: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """_key, source_size, target, _mean and the dual variable _lambda of each source."""
    state = targets.select(
        "_key",
        "source_size",
        F.col("target"),
        F.when(F.col("source_size") > 0, F.col("source_size") / F.col("_docs")).otherwise(1.0).alias("_mean"),
        F.lit(0.0).alias("_lambda"),
        F.lit(None).cast("double").alias("_low"),
        F.lit(None).cast("double").alias("_high"),
        (F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)).alias("_done"),
    )
    state = state.withColumn("_lambda", F.when(F.col("_done"), F.lit(1e9)).otherwise(0.0))
    state, path = written(state, "dual")
    for _ in range(MOST_STEPS):
        r, z = _rate(cap), F.col("_size") / F.col("_mean")
        sums = (
            groups.join(bounded(state), "_key")
            .where(~F.col("_done"))
            .groupBy("_key")
            .agg(
                F.sum(r * F.col("_size") * F.col("_n")).alias("_got"),
                F.sum(F.when(r < cap, r * z * F.col("_size") * F.col("_n")).otherwise(0.0)).alias("_slope"),
            )
        )
        over = F.col("_got") > F.col("target")
        # In logarithms the sums are nearly linear; a step that leaves the bracket is replaced by its middle or a doubling.
        newton = F.col("_lambda") - F.log(F.col("_got") / F.col("target")) * F.col("_got") / F.col("_slope")
        low = F.when(over, F.col("_low")).otherwise(F.col("_lambda"))
        high = F.when(over, F.col("_lambda")).otherwise(F.col("_high"))
        middle = F.when(low.isNull(), F.least(F.lit(-1.0), high * 2)).when(high.isNull(), F.greatest(F.lit(1.0), low * 2)).otherwise((low + high) / 2)
        inside = (F.col("_slope") > 0) & (low.isNull() | (newton > low)) & (high.isNull() | (newton < high)) & (F.abs(newton) < 1e6)
        met = F.col("_got").isNull() | (F.abs(F.col("_got") - F.col("target")) <= F.col("target") * TOLERANCE + 1e-9)
        done = F.col("_done") | met
        new, new_path = written(
            state.join(sums, "_key", "left").select(
                "_key",
                "source_size",
                "target",
                "_mean",
                F.when(done, F.col("_lambda")).when(F.col("target") <= 0, F.lit(-1e9)).when(inside, newton).otherwise(middle).alias("_lambda"),
                F.when(done, F.col("_low")).otherwise(low).alias("_low"),
                F.when(done, F.col("_high")).otherwise(high).alias("_high"),
                (done | (F.col("target") <= 0)).alias("_done"),
            ),
            "dual",
        )
        discard(state.sparkSession, path)
        state, path = new, new_path
        if state.where(~F.col("_done")).isEmpty():
            break
    else:
        raise RuntimeError("the dual was not solved")
    return state.select("_key", "source_size", "target", "_mean", "_lambda")


def _carry(frame: pd.DataFrame) -> pd.DataFrame:
    """For one source's sizes: how many documents of each size get one copy more than the whole part of the rate."""
    frame = frame.sort_values("_size", ascending=False)
    extra, carry = [], 0.0
    for size, n, part in zip(frame["_size"].tolist(), frame["_n"].tolist(), frame["_part"].tolist(), strict=True):
        want = n * part
        take = min(n, max(0, round(want + (carry / size if size else 0.0))))
        carry += (want - take) * size
        extra.append(take)
    return frame.assign(_extra=extra)[["_key", "_size", "_n", "_whole", "_extra", "_rate"]]


def allotment(groups: DataFrame, dual: DataFrame, cap: float = CAP) -> DataFrame:
    """For each (source, size): whole copies for all, and how many documents get one more."""
    rated = groups.join(bounded(dual), "_key").withColumn("_rate", _rate(cap))
    rated = rated.select("_key", "_size", "_n", "_rate", F.floor("_rate").alias("_whole"), (F.col("_rate") - F.floor("_rate")).alias("_part"))
    return rated.groupBy("_key").applyInPandas(_carry, "_key string, _size long, _n long, _whole long, _extra long, _rate double")


def _hashed() -> F.Column:
    return F.xxhash64(F.lit("copies"), F.col("doc_id"))


def thresholds(sized: DataFrame, allotted: DataFrame) -> DataFrame:
    """For each (source, size, bucket): copies of a document are _whole, and one more if its hash is at most _limit."""
    split = allotted.withColumn("_buckets", F.ceil(F.col("_n") / BUCKET).cast("int"))
    plain = split.where((F.col("_extra") == 0) | (F.col("_extra") == F.col("_n")))
    plain = plain.select("_key", "_size", "_buckets", F.lit(None).cast("int").alias("_bucket"), "_whole", "_rate", F.when(F.col("_extra") > 0, F.lit((1 << 63) - 1)).alias("_limit"))
    part = split.where((F.col("_extra") > 0) & (F.col("_extra") < F.col("_n")))
    bucket = F.pmod(F.xxhash64(F.lit("bucket"), F.col("doc_id")), F.col("_buckets")).cast("int")
    members = sized.join(bounded(part), ["_key", "_size"]).select("_key", "_size", "_n", "_buckets", "_whole", "_rate", "_extra", bucket.alias("_bucket"), _hashed().alias("_hash"))
    w = Window.partitionBy("_key", "_size", "_bucket")
    ranked = members.withColumn("_at", F.row_number().over(w.orderBy("_hash")))
    # A bucket's share of the extras is the difference of rounded running totals, so that the shares add up exactly.
    counts = members.groupBy("_key", "_size", "_n", "_extra", "_bucket").agg(F.count(F.lit(1)).alias("_in"))
    run = F.sum("_in").over(Window.partitionBy("_key", "_size").orderBy("_bucket"))
    upto = lambda x: F.floor(x * F.col("_extra") / F.col("_n"))
    shares = counts.select("_key", "_size", "_bucket", (upto(run) - upto(run - F.col("_in"))).alias("_share"))
    marked = ranked.join(shares, ["_key", "_size", "_bucket"]).where(F.col("_at") <= F.col("_share"))
    limits = marked.groupBy("_key", "_size", "_bucket").agg(F.max("_hash").alias("_limit"))
    empty = shares.join(part, ["_key", "_size"]).join(limits, ["_key", "_size", "_bucket"], "left")
    return plain.unionByName(empty.select("_key", "_size", "_buckets", "_bucket", "_whole", "_rate", "_limit"))


def plan_mix(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> tuple[DataFrame, DataFrame]:
    """Decisions for each (source, size, bucket), and the dual with the targets; both written tables.

    `sized` has doc_id, source, _key and _size and is read a few times: a written table without texts.
    """
    groups, _ = written(histogram(sized), "sizes")
    dual, _ = written(solve_dual(groups, source_targets(groups, weights, share, cap), cap), "dual")
    allotted, _ = written(allotment(groups, dual, cap), "allotment")
    decided, _ = written(thresholds(sized, allotted), "decisions")
    return decided, dual


def with_copies(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Adds `_copies` and `_rate` to rows that have doc_id, _key and _size."""
    d = bounded(decided.withColumnsRenamed({"_key": "_k", "_size": "_s"}))
    bucket = F.pmod(F.xxhash64(F.lit("bucket"), F.col("doc_id")), F.col("_buckets")).cast("int")
    on = (F.col("_key") == F.col("_k")) & (F.col("_size") == F.col("_s")) & (F.col("_bucket").isNull() | (F.col("_bucket") == bucket))
    joined = docs.join(d, on)
    copies = F.col("_whole") + F.when(F.col("_limit").isNotNull() & (_hashed() <= F.col("_limit")), 1).otherwise(0)
    return joined.withColumn("_copies", copies)


def mix_sizes(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and rate of each row of `docs`."""
    light = with_size(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")).select("doc_id", "source", "_key", "_size")
    sized, _ = written(light, "sized")
    decided, dual = plan_mix(sized, weights, share, cap)
    out = with_copies(sized, decided).join(bounded(dual.select("_key", "source_size", "target")), "_key")
    return out.select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_copies") * F.col("_size")).alias("taken"),
        F.col("_copies").alias("copies"),
        F.col("_rate").alias("rate"),
    )


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The rows of `docs`, each as many times as it has copies; texts are not shuffled while the decisions are small."""
    row, doc = packed(docs), F.col("_row.doc_id").cast("long").alias("doc_id")
    whole = with_size(row.select("_row", doc, F.col("_row.source").alias("source"), F.col("_row.text").alias("text")))
    sized, _ = written(whole.select("doc_id", "source", "_key", "_size"), "sized")
    decided, _ = plan_mix(sized, weights, share, cap)
    out = with_copies(whole, decided).where(F.col("_copies") > 0)
    return out.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).select("_row.*")
