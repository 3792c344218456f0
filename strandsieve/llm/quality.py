"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 100 words. Every passage is described by shares of kinds of bytes and words, by how much it
repeats, and by its words and its runs of three bytes, each dealt by hash into `BUCKETS` buckets; a learned layer encodes that,
so that each bucket has an embedding, learned together with the attention, and a passage is the mean of them. Gated attention weighs the passages (tanh and sigmoid branches,
normalised within the document); the weighted mean of the encodings gives the score. All weights are learned together from
document labels alone, by Adam on the driver, over a bounded sample: the `SAMPLE` labelled documents with the smallest
hashes, those of more than `SAMPLE_PASSAGES` passages left out. Scoring reads every whole text and shuffles nothing.

Labels of a document that repeat are averaged. Labels, lang, source and doc_id are no inputs of a score.

Edge cases: null and empty texts, and texts without words, are one passage of zeros and get that passage's score; without
labels, or with labels of one kind only, the score is the labels' mean (0.5 without any); repeated rows score alike; an
empty table gives an empty result; extra columns are ignored by `score_quality` and kept by `keep_good`; very long texts
are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve.llm.bytescan import U64, WordHasher, groups, mix, released, utf8, words
from strandsieve.llm.common import tidy_documents

PASSAGE = 100
SAMPLE, SAMPLE_PASSAGES = 6000, 500
FOLDS = 5
THRESHOLD = 0.3
HIDDEN, GATES = 24, 12
EPOCHS, BATCH, RATE, DECAY = 40, 64, 0.01, 1e-4
#: Buckets of words, and as many of runs of three bytes; the encoder learns an embedding of each.
BUCKETS, CALM = 96, 6.0

_HASH = WordHasher(51)
_KINDS = 9


def _kind(b: int) -> int:
    c = chr(b)
    if b >= 128:
        return 0
    if c.islower():
        return 1
    if c.isupper():
        return 2
    if c.isdigit():
        return 3
    if c == "\n":
        return 4
    if c in " \t\r\v\f":
        return 5
    if c in ".,;:?'\"()-":
        return 6
    return 7 if c == "|" else 8


_KIND = np.array([_kind(b) for b in range(256)], np.uint8)
SHARES = _KINDS + 10
FEATURES = SHARES + 2 * BUCKETS


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of all rows, and for each row the number of its first passage (one more at the end)."""
    starts, ends, first = words(data, offsets)
    n_words = np.diff(first)
    n = np.maximum(1, -(-n_words // PASSAGE))
    bag = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(n)), n)
    out = np.zeros((bag[-1], FEATURES))
    if not len(starts):
        return out, bag
    within = np.arange(len(starts)) - np.repeat(first[:-1], n_words)
    of_word = np.repeat(bag[:-1], n_words) + within // PASSAGE
    # A passage's bytes run from its first word to the next passage of its text, or to the text's end.
    begin, end = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
    lead = np.flatnonzero(within % PASSAGE == 0)
    begin[of_word[lead]] = starts[lead]
    end[of_word[lead]] = offsets[row[of_word[lead]] + 1]
    more = np.flatnonzero(row[1:] == row[:-1])
    end[more] = begin[more + 1]
    size = end - begin
    at = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    of_byte = np.repeat(np.arange(len(begin)), size)
    kinds = np.bincount(of_byte * _KINDS + _KIND[data[at]], minlength=len(begin) * _KINDS).reshape(-1, _KINDS)
    out[:, :_KINDS] = kinds / np.maximum(size, 1)[:, None]

    length = (ends - starts).astype(float)
    count = np.bincount(of_word, minlength=len(begin))
    many = np.maximum(count, 1)
    mean = lambda x: np.bincount(of_word, x, len(begin)) / many
    caps = np.concatenate([[0], np.cumsum(_KIND[data] == 2)])
    marks = np.concatenate([[0], np.cumsum(_KIND[data] >= 7)])
    upper, marked = caps[ends] - caps[starts], marks[ends] - marks[starts]
    hashes = _HASH(data, starts, ends)
    same = np.zeros(len(starts))
    same[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    distinct, times = np.unique(hashes ^ mix(of_word.astype(U64)), return_index=True, return_counts=True)[1:]
    most = np.zeros(len(begin))
    np.maximum.at(most, of_word[distinct], times)
    average = mean(length)
    more = [
        np.log1p(count) / 5,
        average / 10,
        np.sqrt(np.maximum(mean(length**2) - average**2, 0)) / 10,
        np.bincount(of_word[distinct], minlength=len(begin)) / many,
        most / many,
        mean(same),
        mean((upper > 1) & (2 * upper > length)),
        mean(upper == 1),
        mean(marked > 0),
        mean(length <= 3),
    ]
    out[:, _KINDS:SHARES] = np.stack(more, axis=1)
    out[:, SHARES : SHARES + BUCKETS] = _bucketed(of_word, hashes, len(begin))
    # Runs of three bytes that lie in one passage.
    if len(at) > 2:
        b = data[at].astype(np.uint32)
        three = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        whole = np.flatnonzero(of_byte[2:] == of_byte[:-2])
        out[:, SHARES + BUCKETS :] = _bucketed(of_byte[whole], mix(three[whole].astype(U64) + U64(1)), len(begin))
    return out, bag


def _bucketed(of: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Shares of each bucket among the hashes of each of n passages."""
    counts = np.bincount(of * BUCKETS + ((hashes >> U64(32)) % U64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS).reshape(n, BUCKETS)
    return counts / np.maximum(counts.sum(1), 1)[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _times(rows: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A product whose rows do not depend, even in the last bit, on what other rows are in the batch."""
    return np.einsum("ij,jk->ik" if w.ndim == 2 else "ij,j->i", rows, w, optimize=False)


@dataclass
class Model:
    """Weights, or a constant score if there was nothing to learn from."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        x = (x - w["mean"]) / w["scale"]
        of = np.repeat(np.arange(len(bag) - 1), np.diff(bag))
        h = np.tanh(_times(x, w["encode"]) + w["encode0"])
        t, g = np.tanh(_times(h, w["tanh"])), _sigmoid(_times(h, w["gate"]))
        e = _times(t * g, w["attend"])
        a = np.exp(e - np.maximum.reduceat(e, bag[:-1])[of])
        a /= np.add.reduceat(a, bag[:-1])[of]
        z = np.add.reduceat(a[:, None] * h, bag[:-1])
        return {"x": x, "of": of, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(_times(z, w["out"]) + w["out0"])}

    def scores(self, x: np.ndarray, bag: np.ndarray) -> np.ndarray:
        if len(bag) < 2:
            return np.zeros(0)
        return np.full(len(bag) - 1, self.constant) if self.constant is not None else self.forward(x, bag)["p"]

    def gradients(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(x, bag)
        h, t, g, a, of = f["h"], f["t"], f["g"], f["a"], f["of"]
        ds = (f["p"] - y) / len(y)
        dz = ds[:, None] * w["out"][None, :]
        dh = a[:, None] * dz[of]
        da = (h * dz[of]).sum(1)
        de = a * (da - np.add.reduceat(a * da, bag[:-1])[of])
        both = de[:, None] * w["attend"][None, :]
        dt, dg = both * g * (1 - t * t), both * t * g * (1 - g)
        dh += dt @ w["tanh"].T + dg @ w["gate"].T
        pre = dh * (1 - h * h)
        return {
            "encode": f["x"].T @ pre, "encode0": pre.sum(0), "tanh": h.T @ dt, "gate": h.T @ dg,
            "attend": (t * g).T @ de, "out": f["z"].T @ ds, "out0": ds.sum(),
        }


def train(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """Learns from one array of passage features for each document; the same input gives the same model."""
    if not len(bags) or labels.min() >= 0.5 or labels.max() < 0.5:
        return Model({}, float(labels.mean()) if len(bags) else 0.5)
    rng = np.random.default_rng(5)
    every = np.concatenate(bags)
    scale = every.std(0)
    w: dict[str, np.ndarray] = {"mean": every.mean(0), "scale": np.where(scale > 1e-9, scale, 1.0)}
    w["scale"][SHARES:] *= CALM  # buckets are many and each says little; so they start out quiet
    shapes = {"encode": (FEATURES, HIDDEN), "encode0": (HIDDEN,), "tanh": (HIDDEN, GATES), "gate": (HIDDEN, GATES), "attend": (GATES,), "out": (HIDDEN,), "out0": ()}
    for name, shape in shapes.items():
        w[name] = np.zeros(shape) if name.endswith("0") else rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    model = Model(w)
    m, v = {k: np.zeros(s) for k, s in shapes.items()}, {k: np.zeros(s) for k, s in shapes.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            bag = np.concatenate([[0], np.cumsum([len(bags[i]) for i in some])])
            grads = model.gradients(np.concatenate([bags[i] for i in some]), bag, labels[some])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grads.items():
                g = g + DECAY * w[k] if k in ("encode", "out") else g
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - rate * m[k] / (np.sqrt(v[k]) + 1e-8)
    return model


def _held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model learned from the labelled documents whose doc_id is not held out."""
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~_held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()  # at most `sample` rows
    few = spark.createDataFrame([(r.doc_id, r.quality) for r in chosen], "_id long, quality double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(1))
            out = []
            for i, j in groups(offsets):
                x, bag = passages(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                out += [x[bag[k] : bag[k + 1]].astype("<f4").tobytes() if bag[k + 1] - bag[k] <= SAMPLE_PASSAGES else None for k in range(j - i)]
            yield pa.record_batch({"doc_id": b.column(0), "quality": b.column(2), "features": pa.array(out, pa.binary())})

    texts = tidy_documents(docs).join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "quality")
    rows = texts.mapInArrow(released(run), "doc_id long, quality double, features binary").where("features is not null")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(sample).collect()
    bags = [np.frombuffer(r.features, "<f4").reshape(-1, FEATURES).astype(float) for r in rows]
    return train(bags, np.array([r.quality for r in rows]))


def _scores(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(column)
    out, n = [np.zeros(0)], [np.zeros(0, np.int64)]
    for i, j in groups(offsets):
        x, bag = passages(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        out.append(model.scores(x.astype("<f4").astype(float), bag))
        n.append(np.diff(bag))
    return np.concatenate(out), np.concatenate(n)


def score_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and n_passages of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score, n = _scores(b.column(2), model)
            yield pa.record_batch({
                "doc_id": b.column(0), "held_out": b.column(1), "score": pa.array(score, pa.float64()),
                "predicted": pa.array((score >= threshold).astype(np.int32)), "n_passages": pa.array(n, pa.int64()),
            })

    rows = tidy_documents(docs).select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(released(run), "doc_id long, held_out boolean, score double, predicted int, n_passages long")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the model does not reject, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_scores(b.column(at), model)[0] >= threshold, pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)
