"""Near-duplicate documents by a MinHash LSH forest, with links confirmed on full shingle sets.

A document's set is its distinct 5-word shingles (lower-cased A-Z); documents with equal sets are one class, represented
once. Each class gets a signature of 128 minimum hashes. A tree of the forest is one order of the signatures' values,
starting at another place; classes that share a prefix of that order are a region of the tree. Depth adapts: a region that
holds more than `CROWD` classes is split by twice as long a prefix, again and again, and only those. The members of every
other region are sorted by the rest of their order, and each is a candidate of its neighbour, weighed by the length of
their common prefix (`neighbours`). In every region the members are candidates of its first member as well (a sum, whatever
the region's size), and small regions are later searched for pairs between different components. What is left are the
crowded regions of the first depth: if one holds different components, its members are joined exactly (`crowd_links`), so
that no pair that shares a region is lost because the region is crowded.

A link is 100 * |A n B| >= 75 * |A u B| on the full sets, which are built again from the texts of the documents that need
it. Each round verifies what still joins different components: first each class's candidate of the longest prefixes, then
its other candidates, then the remaining pairs in small regions, then those of crowded regions. With 32 trees and prefix
length 4 a pair at similarity 0.75 shares no region with probability (1 - 0.75^4)^32, 5 in a million; at 0.8, 5 in ten
million.

Shuffled rows grow with documents and candidate pairs; a first member with very many candidates is dealt out in parts.
Nothing of size with the corpus reaches the driver.

Edge cases: null and empty texts, and texts without words, have empty sets and link with nothing; with fewer than five
words the whole sequence is the one shingle; rows that repeat a doc_id are separate documents that may link; component_id
is the smallest non-null doc_id of the component; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve.llm.bytescan import U64, NgramHasher, WordHasher, hashed_words, mix, released, seeded
from strandsieve.llm.common import BROADCAST_BYTES, bounded, bytes_of, discard, packed, partitions, tidy_documents, written
from strandsieve.llm.components import components

SHINGLE = 5
VALUES, TREES, DEPTH = 128, 32, 4
#: Classes in a region beyond which its prefix is doubled, and its pairs are found by shingles instead of all tried.
CROWD = 64
#: Candidates of one first member that are verified in one group, and such groups that one row asks for.
PART, ASKED = 128, 64
#: Sets that may share a shingle which joins them; more common ones wait for the next level, where so many times more may.
COMMON, GROWTH = 32, 16
#: Values of an order, after the region's prefix of at most half of them, by which its members are sorted.
SORTED = 28
_WORD = WordHasher(61)
_GRAMS = {n: NgramHasher(n, 62) for n in range(1, SHINGLE + 1)}
_XOR = (seeded(63, VALUES) >> U64(32)).astype(np.uint32)[:, None]
_MUL = ((seeded(64, VALUES) >> U64(32)).astype(np.uint32) | np.uint32(1))[:, None]
_A, _B = seeded(65, 2)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    n = min(len(words), SHINGLE)
    if not n:
        return np.zeros(0, U64)
    hashes = _GRAMS[n](words)
    return np.unique(hashes if n == SHINGLE else mix(hashes + U64(n)))


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the whole set."""
    a, b = mix(shingles ^ _A).sum(dtype=U64), mix(shingles ^ _B).sum(dtype=U64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def signature(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> U64(32)).astype(np.uint32)[None, :]
    best = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, x.shape[1], 2048):
        np.minimum(best, ((x[:, at : at + 2048] ^ _XOR) * _MUL).min(axis=1), out=best)
    return best.view(np.int32)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, d1, d2 and signature (null for an empty set) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, d1, d2, signs = [], [], [], []
            for _, (words,) in hashed_words(b.column(1), [_WORD], lower=True):
                s = shingle_set(words)
                x, y = digest(s)
                n.append(len(s))
                d1.append(x)
                d2.append(y)
                signs.append(signature(s) if len(s) else None)
            yield pa.record_batch(
                [b.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(signs, pa.list_(pa.int32()))],
                names=["doc_id", "n_shingles", "d1", "d2", "signature"],
            )

    return tidy_documents(docs).mapInArrow(released(run), "doc_id long, n_shingles long, d1 long, d2 long, signature array<int>")


def classes(signed: DataFrame) -> DataFrame:
    """node, doc_id, n, d1, d2, signature and least (smallest doc_id) of each class of equal sets."""
    first = F.min(F.struct(F.col("_row").alias("node"), "doc_id", "n_shingles", "signature"))
    return (
        signed.where("n_shingles > 0")
        .groupBy("d1", "d2")
        .agg(first.alias("c"), F.min("doc_id").alias("least"))
        .select("c.node", F.coalesce("c.doc_id", F.lit(-(1 << 63))).alias("at"), F.col("c.n_shingles").alias("n"), "d1", "d2", "c.signature", "least")
    )


def _prefix(depth: int) -> F.Column:
    twice = F.concat("signature", "signature")
    return F.xxhash64(F.col("tree"), F.lit(depth), F.slice(twice, F.col("tree") * DEPTH + 1, F.lit(depth)))


def regions(kinds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: candidates (node, hub) with weights, and members (key, node, n) of uncrowded regions and of the
    crowded ones of the first depth, which hold all others."""
    spark = kinds.sparkSession
    light = kinds.select("node", "n", "signature")
    rows = light.select("node", "n", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    depth, stars, leaves, crowds, old = DEPTH, [], [], None, None
    while True:
        keyed = rows.select("node", "n", "tree", _prefix(depth).alias("key"))
        groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "n")).alias("hub")).where("size > 1")
        groups, groups_path = written(groups, "groups")  # on its own, so that a hot key's rows can be split in the join
        members, _ = written(keyed.join(bounded(groups), "key").select("key", "node", "n", "tree", "size", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n")), "members")
        discard(spark, groups_path)
        small, large = F.col("size") <= CROWD, F.col("size") > CROWD
        stars.append(members.where("node <> hub").select("node", "hub", "n", "hub_n", F.lit(1).alias("weight")))
        leaves.append(members.where(small).select("key", "node", "n", "tree", F.lit(depth).alias("depth")))
        crowded = members.where(large).select("node", "tree")
        if crowds is None:
            crowds = members.where(large).select("key", "node", "n")
        if old:
            discard(spark, old)
        depth *= 2
        if depth > VALUES // 2 or crowded.isEmpty():
            break
        rows, old = written(crowded.join(light, "node").select("node", "n", "signature", "tree"), "crowded")
    leaves = _union(leaves)
    stars = _union([*stars, neighbours(leaves.select("key", "node", "tree", "depth"), light)]).where(_fit("n", "hub_n"))
    votes, _ = written(stars.groupBy("node", "hub").agg(F.sum("weight").alias("weight")), "votes")
    return votes, leaves.select("key", "node", "n"), crowds


def neighbours(members: DataFrame, light: DataFrame) -> DataFrame:
    """node, hub, n, hub_n and weight: neighbours in the sorted order of each region (key), by the values after the region's
    prefix (depth), weighed by their longest common prefix; `hub` is the smaller node."""
    twice = F.concat("signature", "signature")
    rest = F.slice(twice, F.col("tree") * DEPTH + 1 + F.col("depth"), F.lit(SORTED))
    ordered = members.join(light, "node").select("key", "node", "n", "depth", rest.alias("rest"))
    ordered = ordered.repartition(partitions(members.sparkSession), "key").sortWithinPartitions("key", "rest", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for b in batches:
            if not b.num_rows:
                continue
            key, node, n, depth = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            lists = b.column(4)
            rest = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(key), -1)
            if last is not None:
                key, node, n, depth, rest = (np.concatenate([x, y]) for x, y in zip(last, (key, node, n, depth, rest), strict=True))
            last = key[-1:], node[-1:], n[-1:], depth[-1:], rest[-1:]
            same = np.flatnonzero(key[1:] == key[:-1])
            differ = rest[same] != rest[same + 1]
            common = np.where(differ.any(axis=1), differ.argmax(axis=1), rest.shape[1]) + depth[same]
            u, v = node[same], node[same + 1]
            swap = u < v
            yield pa.record_batch({
                "node": pa.array(np.where(swap, v, u)), "hub": pa.array(np.where(swap, u, v)),
                "n": pa.array(np.where(swap, n[same + 1], n[same])), "hub_n": pa.array(np.where(swap, n[same], n[same + 1])),
                "weight": pa.array(common.astype(np.int32)),
            })

    return ordered.mapInArrow(released(run), "node long, hub long, n long, hub_n long, weight int")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _fit(a: str, b: str) -> F.Column:
    """Sizes that a similarity of 0.75 allows."""
    return 100 * F.least(a, b) >= 75 * F.greatest(a, b)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets link."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < 75 * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= 75 * (len(a) + len(b) - both)


def verify(docs: DataFrame, kinds: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of the pairs (node, hub), those that link. A written table.

    Every set is sent once for each pair in which its class is `node`, and once for each part of a hub's candidates, by
    as many rows as there are `ASKED` of those.
    """
    n = partitions(docs.sparkSession)
    dealt = pairs.select("node", "hub", F.pmod(F.xxhash64("node"), F.ceil(F.col("_of") / PART)).alias("part")) if "_of" in pairs.columns else pairs
    dealt, dealt_path = written(dealt, "pairs")
    asked = dealt.select("node", F.lit(0).cast("long").alias("chunk"), F.struct("hub", "part", F.lit(False).alias("own")).alias("to"))
    owned = dealt.select("hub", "part").distinct().select(F.col("hub").alias("node"), F.expr(f"part div {ASKED}").alias("chunk"), F.struct("hub", "part", F.lit(True).alias("own")).alias("to"))
    needs = asked.unionByName(owned).groupBy("node", "chunk").agg(F.collect_list("to").alias("to")).drop("chunk")
    needs, needs_path = written(needs.join(kinds.select("node", "at", "d1", "d2"), "node").select("node", "to", "at", "d1", "d2"), "needs")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, d1, d2, to = (b.column(i).to_pylist() for i in range(1, 5))
            out: list[tuple] = []
            size = 0
            for i, (words,) in hashed_words(b.column(0), [_WORD], lower=True):
                s = shingle_set(words)
                if digest(s) == (d1[i], d2[i]):  # else another row with the same doc_id
                    raw = s.tobytes()
                    out += [(t["hub"], t["part"], t["own"], nodes[i], raw) for t in to[i]]
                    size += len(raw) * len(to[i])
                if size > 8_000_000:
                    yield _sets(out)
                    out, size = [], 0
            if out:
                yield _sets(out)

    def _sets(rows: list[tuple]) -> pa.RecordBatch:
        hub, part, own, node, raw = zip(*rows, strict=True)
        return pa.record_batch({
            "hub": pa.array(hub, pa.int64()), "part": pa.array(part, pa.int64()), "own": pa.array(own, pa.bool_()),
            "node": pa.array(node, pa.int64()), "set": pa.array(raw, pa.binary()),
        })

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whose, hub_set = None, None
        for b in batches:
            u, v = [], []
            for hub, part, own, node, raw in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                s = np.frombuffer(raw, U64)
                if own:
                    whose, hub_set = (hub, part), s
                elif whose == (hub, part) and alike(hub_set, s):
                    u.append(node)
                    v.append(hub)
            yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    texts = tidy_documents(docs).withColumn("_at", F.coalesce("doc_id", F.lit(-(1 << 63))))
    chosen = texts.join(bounded(needs.withColumnRenamed("at", "_at")), "_at").select("text", "node", "d1", "d2", "to")
    sets = chosen.mapInArrow(released(build), "hub long, part long, own boolean, node long, set binary")
    met = sets.repartition(n, "hub", "part").sortWithinPartitions("hub", "part", F.desc("own"))
    links, _ = written(met.mapInArrow(released(compare), "u long, v long").distinct(), "links")
    discard(docs.sparkSession, dealt_path)
    discard(docs.sparkSession, needs_path)
    return links


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (key, node, n) of the regions that hold different components, with node_in."""
    placed = _labelled(members, labels, "node")
    mixed = placed.groupBy("key").agg(F.min("node_in").alias("a"), F.max("node_in").alias("b")).where("a <> b").select("key")
    return placed.join(bounded(mixed), "key", "left_semi")


def _full_sets(docs: DataFrame, kinds: DataFrame, members: DataFrame) -> DataFrame:
    """node and shingles of the classes in `members` (node), from the texts. A written table."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, d1, d2 = (b.column(i).to_pylist() for i in range(1, 4))
            out: list[tuple] = []
            size = 0
            for i, (words,) in hashed_words(b.column(0), [_WORD], lower=True):
                s = shingle_set(words)
                if digest(s) == (d1[i], d2[i]):  # else another row with the same doc_id
                    out.append((nodes[i], s.view(np.int64)))
                    size += len(s)
                if size > 1_000_000:
                    yield _rows(out)
                    out, size = [], 0
            if out:
                yield _rows(out)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        node, sets = zip(*rows, strict=True)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
        return pa.record_batch([pa.array(node, pa.int64()), pa.ListArray.from_arrays(ends, np.concatenate(sets))], names=["node", "shingles"])

    needs, needs_path = written(members.select("node").join(kinds.select("node", F.col("at").alias("_at"), "d1", "d2"), "node"), "needs")
    texts = tidy_documents(docs).withColumn("_at", F.coalesce("doc_id", F.lit(-(1 << 63))))
    chosen = texts.join(bounded(needs), "_at").select("text", "node", "d1", "d2")
    sets, _ = written(chosen.mapInArrow(released(build), "node long, shingles array<long>").groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")
    discard(docs.sparkSession, needs_path)
    return sets


def crowd_links(docs: DataFrame, kinds: DataFrame, members: DataFrame) -> DataFrame:
    """Links (u, v) that join all members (node, node_in) which link, directly or through others of them. A written table.

    Sets of sizes a and b link if 7 * |A n B| >= 3 * (a + b). Level by level, the shingles that at most so many sets hold
    join those sets pair by pair, and the pairs are checked on the whole sets (`_met`). Whatever is not found so has only
    commoner shingles in common, so for the next level every set is cut down to those, without what is then too small for
    any link, and sets that have become equal are one. Of one such set the members of sizes a and b link if 7 * |set| is
    3 * (a + b); they are then joined through the smallest, of each size the smallest node (`_equal`). So a template that
    thousands of texts share costs one set, not pairs of texts. Levels end when no shingle is held by more sets than may
    join, which grows sixteenfold each time.
    """
    spark = docs.sparkSession
    sets = _full_sets(docs, kinds, members)
    now = sets.select(F.col("node").alias("set"), "shingles", F.size("shingles").cast("long").alias("least"))
    homes = now.join(members.withColumnRenamed("node", "set"), "set").select("set", F.col("set").alias("node"), F.col("least").alias("n"), "node_in")
    homes, _ = written(homes, "homes")
    common, found = COMMON, [spark.range(0).select(F.col("id").alias("u"), F.col("id").alias("v"))]
    while True:
        held = _times(now).where("c > 1")
        held, held_path = written(held, "held")
        shared, shared_path = written(_shared(now, held), "shared")
        met = _met(now, shared, homes, common)
        found += [met] if met is not None else []
        left = shared.select("set", "least", F.array_sort(F.transform(F.filter("shared", lambda x: x["c"] > common), lambda x: x["shingle"])).alias("shingles"))
        left = left.where("4 * size(shingles) >= 3 * least").select("set", "least", "shingles", F.xxhash64("shingles", F.lit(1)).alias("k1"), F.xxhash64(F.lit(2), "shingles").alias("k2"))
        now, _ = written(left, "left")
        for path in (held_path, shared_path):
            discard(spark, path)
        if now.limit(2).count() < 2:
            break
        first, first_path = written(now.groupBy("k1", "k2").agg(F.min("set").alias("first")), "first")
        if first.count() < now.count():
            renamed, renamed_path = written(now.select("set", "k1", "k2").join(bounded(first), ["k1", "k2"]).select("set", "first"), "renamed")
            homes, _ = written(homes.join(bounded(renamed), "set").select(F.col("first").alias("set"), "node", "n", "node_in"), "homes")
            sized = homes.groupBy("set").agg(F.min("n").alias("least"))
            now, _ = written(now.select("set", "shingles").join(sized, "set"), "rest")
            found.append(_equal(now, homes))
            discard(spark, renamed_path)
        discard(spark, first_path)
        common *= GROWTH
    return written(_union(found).where("u <> v").distinct(), "crowd-links")[0]


def _times(now: DataFrame) -> DataFrame:
    """shingle and c, the number of sets that hold it; summed within each batch of sets before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, times = np.unique(b.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.record_batch({"shingle": pa.array(values, pa.int64()), "c": pa.array(times, pa.int64())})

    return now.select("shingles").mapInArrow(released(run), "shingle long, c long").groupBy("shingle").agg(F.sum("c").alias("c"))


def _shared(now: DataFrame, held: DataFrame) -> DataFrame:
    """set, least and shared: (c, shingle) of the set's shingles in `held` (shingle, c), the rarest first.

    A table of shingles that takes few bytes is looked up in each task; else sets and table are shuffled by shingle.
    """
    if bytes_of(held) > BROADCAST_BYTES:
        each = now.select("set", "least", F.explode("shingles").alias("shingle")).join(held, "shingle")
        return each.groupBy("set", "least").agg(F.sort_array(F.collect_list(F.struct("c", "shingle"))).alias("shared"))
    table = held.toPandas().sort_values("shingle")
    sent = now.sparkSession.sparkContext.broadcast((table["shingle"].to_numpy(np.int64), table["c"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = sent.value
        for b in batches:
            lists = b.column(2)
            shingles = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(known, shingles), max(len(known) - 1, 0))
            hit = known[at] == shingles if len(known) else np.zeros(len(shingles), bool)
            row, shingles, c = row[hit], shingles[hit], times[at[hit]] if len(known) else shingles[hit]
            order = np.lexsort((shingles, c, row))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b.num_rows))]).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(c[order]), pa.array(shingles[order])], names=["c", "shingle"])
            yield pa.record_batch([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(ends), pairs)], names=["set", "least", "shared"])

    return now.select("set", "least", "shingles").mapInArrow(released(run), "set long, least long, shared array<struct<c:long,shingle:long>>")


def _met(now: DataFrame, shared: DataFrame, homes: DataFrame, common: int) -> DataFrame | None:
    """u, v: members of two sets that share a shingle held by at most `common` sets, and enough others to link; None if none.

    With one order of all shingles, the rarest first, sets that link have in common one that stands so early in both that
    what follows it can still be enough. Sets whose members are all in one component are not paired. A written table.
    """
    spark = now.sparkSession
    inside = homes.groupBy("set").agg(F.when(F.min("node_in") == F.max("node_in"), F.min("node_in")).otherwise(-1 - F.col("set")).alias("inside"))
    k = F.size("shared").cast("long")  # from the i-th on, k - i shingles may be in common
    rare = F.slice("shared", F.lit(1), F.greatest(F.lit(0), F.least(k, k - F.expr("(3 * least + 3) div 4") + 1)).cast("int"))
    rare = F.filter(rare, lambda x: x["c"] <= common)
    early = shared.select("set", "least", k.alias("k"), F.posexplode(rare).alias("i", "x")).select("set", "least", "x.shingle", (F.col("k") - F.col("i")).alias("after"))
    early, early_path = written(early.join(inside, "set"), "early")
    one, two = (early.select("shingle", *[F.col(c).alias(f"{c}_{k}") for c in ("set", "least", "after", "inside")]) for k in (1, 2))
    fits = 7 * F.least("after_1", "after_2") >= 3 * (F.col("least_1") + F.col("least_2"))
    pairs = one.join(two, "shingle").where((F.col("set_1") > F.col("set_2")) & (F.col("inside_1") != F.col("inside_2")) & fits)
    pairs, pairs_path = written(pairs.select("set_1", "set_2", "least_1", "least_2").distinct(), "met")
    if pairs.isEmpty():
        return None
    whole = now.select("set", "shingles")
    both = pairs.join(whole.toDF("set_1", "all_1"), "set_1").join(whole.toDF("set_2", "all_2"), "set_2")
    both = both.withColumn("both", F.size(F.array_intersect("all_1", "all_2"))).where("7 * both >= 3 * (least_1 + least_2)")
    both, both_path = written(both.select("set_1", "set_2", "least_1", "least_2", "both"), "both")
    # Every member of one set that links with the smallest of the other.
    smallest = homes.groupBy("set").agg(F.min(F.struct("n", "node")).alias("s")).select(F.col("set").alias("to"), F.col("s.node").alias("v"))
    ways = both.select(F.col("set_1").alias("set"), F.col("set_2").alias("to"), F.col("least_2").alias("other"), "both")
    ways = ways.unionByName(both.select(F.col("set_2").alias("set"), F.col("set_1").alias("to"), F.col("least_1").alias("other"), "both"))
    out, _ = written(ways.join(homes, "set").where("7 * both >= 3 * (n + other)").join(smallest, "to").select(F.col("node").alias("u"), "v").distinct(), "joined")
    for path in (early_path, pairs_path, both_path):
        discard(spark, path)
    return out


def _equal(now: DataFrame, homes: DataFrame) -> DataFrame:
    """u, v: members of one set that link by it alone, each with the smallest. A written table."""
    smallest = homes.groupBy("set").agg(F.min(F.struct("n", "node")).alias("s")).select("set", F.col("s.node").alias("v"), F.col("s.n").alias("v_n"))
    sized = now.select("set", F.size("shingles").alias("k")).join(smallest, "set")
    return written(homes.join(sized, "set").where("7 * k >= 3 * (n + v_n) and node <> v").select(F.col("node").alias("u"), "v"), "equal")[0]


def _crowds(pairs: DataFrame) -> DataFrame:
    """Adds `_of`, the number of candidates of each hub that has more than `PART` of them (else 1)."""
    many = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("_of")).where(F.col("_of") > PART)
    many = F.broadcast(many) if 32 * (pairs.count() // PART) <= BROADCAST_BYTES else written(many, "many")[0]
    return pairs.join(many, "hub", "left").withColumn("_of", F.coalesce("_of", F.lit(1)))


def _labelled(frame: DataFrame, labels: DataFrame, *sides: str) -> DataFrame:
    """Adds `<side>_in`, the component of each side (itself where it has none)."""
    for side in sides:
        named = labels.select(F.col("node").alias(side), F.col("component").alias(f"{side}_in"))
        frame = frame.join(bounded(named), side, "left").withColumn(f"{side}_in", F.coalesce(f"{side}_in", side))
    return frame


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, d1, d2, component_id and node_in (its component; both null for an empty set) of each row of `docs`."""
    signed, _ = written(signatures(docs).withColumn("_row", F.monotonically_increasing_id()), "signatures")
    kinds, _ = written(classes(signed), "classes")
    votes, leaves, crowds = regions(kinds)

    best = votes.groupBy("node").agg(F.max(F.struct("weight", (-F.col("hub")).alias("less"))).alias("b")).select("node", (-F.col("b.less")).alias("hub"))
    tried, _ = written(best, "tried")
    links = verify(docs, kinds, _crowds(tried))
    labels = components(links)

    rest = _labelled(votes.select("node", "hub").join(tried, ["node", "hub"], "left_anti"), labels, "node", "hub").where("node_in <> hub_in")
    more, _ = written(rest.select("node", "hub"), "tried")
    if not more.isEmpty():
        links = links.unionByName(verify(docs, kinds, _crowds(more)))
        labels = components(links)

    placed, _ = written(_mixed(leaves, labels), "placed")
    other = placed.select("key", F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("node_in").alias("hub_in"))
    across = placed.join(other, "key").where((F.col("node") > F.col("hub")) & (F.col("node_in") != F.col("hub_in")) & _fit("n", "hub_n")).select("node", "hub").distinct()
    last, _ = written(across.join(votes, ["node", "hub"], "left_anti"), "tried")
    if not last.isEmpty():
        links = links.unionByName(verify(docs, kinds, _crowds(last)))
        labels = components(links)

    crowded, _ = written(_mixed(crowds, labels).select("node", "node_in").distinct(), "crowded")
    if not crowded.isEmpty():
        exact = crowd_links(docs, kinds, crowded)
        if not exact.isEmpty():
            links = links.unionByName(exact)
            labels = components(links)

    homes = _labelled(kinds.select("node", "d1", "d2", "least"), labels, "node")
    names, _ = written(homes.groupBy("node_in").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_all")).where("_all > 1").drop("_all"), "names")
    homes, _ = written(homes.join(bounded(names), "node_in", "left").withColumn("component_id", F.coalesce("component_id", "least")).select("d1", "d2", "component_id", "node_in"), "homes")
    return signed.select("doc_id", "n_shingles", "d1", "d2").join(bounded(homes), ["d1", "d2"], "left")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of `docs`."""
    out = _placed(docs)
    single = F.col("n_shingles") == 0
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(single, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (single | F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept: of each group of near duplicates one with the smallest doc_id.

    Where a doc_id names one row it decides; rows that share one (or have none) are looked at one by one. Rows go packed, so
    that no column of theirs clashes with those that are joined.
    """
    none = F.lit(-(1 << 63))
    placed, _ = written(_placed(docs).withColumn("_kept", F.coalesce("doc_id", none)), "placed")
    best = (F.col("n_shingles") == 0) | (F.col("_kept") == F.coalesce("component_id", none))
    ids, _ = written(placed.groupBy("_kept").agg(F.count(F.lit(1)).alias("rows"), F.max(best).alias("best")).where("best"), "kept")
    rows = packed(docs).withColumn("_kept", F.coalesce(F.col("_row.doc_id").cast("long"), none))
    named, shared = ids.where("rows = 1").select("_kept"), ids.where("rows > 1").select("_kept")
    out = rows.join(bounded(named, 3 * BROADCAST_BYTES), "_kept", "left_semi").select("_row.*")
    if shared.isEmpty():
        return out
    again, _ = written(rows.join(bounded(shared), "_kept", "left_semi").withColumn("_n", F.monotonically_increasing_id()), "shared")
    signed = signatures(again.select(F.col("_n").alias("doc_id"), F.col("_row.text").alias("text"))).select(F.col("doc_id").alias("_n"), "n_shingles", "d1", "d2")
    homes = placed.where("n_shingles > 0").join(bounded(shared), "_kept", "left_semi").select("d1", "d2", "node_in", "component_id").distinct()
    own = again.select("_n", "_kept")
    at = signed.join(own, "_n").join(homes, ["d1", "d2"], "left").where(best)
    chosen, _ = written(at.groupBy(F.coalesce("node_in", F.lit(-1)), F.when(F.col("n_shingles") == 0, F.col("_n"))).agg(F.min("_n").alias("_n")).select("_n"), "chosen")
    return out.unionAll(again.join(bounded(chosen), "_n", "left_semi").select("_row.*"))
