import math
import random
import zlib

import numpy as np
import pytest

from strandsieve.llm import quality

from .conftest import sentence


def test_gradients():
    rng = np.random.default_rng(3)
    model = quality.train([rng.normal(size=(n, quality.FEATURES)) for n in (1, 3, 2)], np.array([0.0, 1.0, 1.0]))
    x, bag, y = rng.normal(size=(6, quality.FEATURES)), np.array([0, 1, 4, 6]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.scores(x, bag)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads = model.gradients(x, bag, y)
    for name, g in grads.items():
        w = model.weights[name]
        for at in list(np.ndindex(w.shape))[:: max(1, w.size // 7)]:
            model.weights[name] = w + (np.arange(w.size).reshape(w.shape) == np.ravel_multi_index(at, w.shape) if w.shape else 1.0) * 1e-5
            up = loss()
            model.weights[name] = w - (np.arange(w.size).reshape(w.shape) == np.ravel_multi_index(at, w.shape) if w.shape else 1.0) * 1e-5
            down = loss()
            model.weights[name] = w
            assert (up - down) / 2e-5 == pytest.approx(np.asarray(g)[at], abs=1e-4)


def test_features_do_not_depend_on_neighbours():
    texts = ["a few words", "", "x " * 250, "é ñ!! | ###", None, " \n "]
    import pyarrow as pa

    from strandsieve.llm.bytescan import utf8

    whole, bag = quality.passages(*utf8(pa.array(texts, pa.string())))
    assert np.diff(bag).tolist() == [1, 1, 3, 1, 1, 1]
    for k, t in enumerate(texts):
        own, _ = quality.passages(*utf8(pa.array([t], pa.string())))
        assert np.allclose(own, whole[bag[k] : bag[k + 1]])


def documents(rng, n):
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = sentence(rng, rng.randint(5, 300)).split(" ")
        if not good:
            at = rng.randrange(len(words))
            words[at:at] = ["JUNK!!"] * 60 if i % 2 else [words[0]] * 80
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_repeatability(spark, make):
    rows, labels = documents(random.Random(8), 400)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    truth = dict((i, q) for i, q, _ in labels)
    docs = make(*rows)
    first = quality.score_quality(docs, quality.fit(docs, lab)).collect()
    held = [r for r in first if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in first)
    again = quality.score_quality(docs.repartition(1), quality.fit(docs.repartition(7), lab.repartition(5))).collect()
    assert {r.doc_id: r.score for r in first} == {r.doc_id: r.score for r in again}
    good = quality.keep_good(docs, quality.fit(docs, lab))
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in first if r.predicted}


def test_nothing_to_learn_from(spark, make, empty, nasty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make((1, "a"), (2, None))
    assert {r.score for r in quality.score_quality(docs, quality.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, None), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score_quality(docs, quality.fit(docs, one)).collect()} == {1.0}
    assert quality.score_quality(empty, quality.fit(empty, none)).count() == 0


def test_edge_cases(spark, make, nasty):
    rows, labels = documents(random.Random(8), 60)
    model = quality.fit(make(*rows), spark.createDataFrame(labels + labels[:5], "doc_id long, quality int, toxic int"))
    got = quality.score_quality(nasty, model).collect()
    assert len(got) == nasty.count()
    scores = {}
    for r in got:
        scores.setdefault(r.doc_id, []).append(r.score)
    assert scores[1] == scores[9]
    assert scores[3] == scores[4] == scores[5]
    kept = quality.keep_good(nasty, model, 0.0)
    assert kept.columns == nasty.columns
    assert kept.count() == nasty.count()


def plain_features(text):
    """Features of each passage of a text in plain loops over its words and bytes."""
    data = text.encode()
    kind = lambda b: 0 if b >= 128 else 1 if chr(b).islower() else 2 if chr(b).isupper() else 3 if chr(b).isdigit() else 4 if chr(b) == "\n" else 5 if chr(b) in " \t\r\v\f" else 6 if chr(b) in ".,;:?'\"()-" else 7 if chr(b) == "|" else 8
    spans, at = [], 0
    while at < len(data):
        if data[at] in b" \t\n\v\f\r":
            at += 1
            continue
        end = at
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        spans.append((at, end))
        at = end
    out = []
    for p in range(0, max(len(spans), 1), quality.PASSAGE):
        own = spans[p : p + quality.PASSAGE]
        if not own:
            out.append([0.0] * quality.FEATURES)
            continue
        begin = own[0][0]
        end = spans[p + quality.PASSAGE][0] if p + quality.PASSAGE < len(spans) else len(data)
        kinds = [kind(b) for b in data[begin:end]]
        words = [data[a:z] for a, z in own]
        n, lengths = len(words), [len(w) for w in words]
        mean = sum(lengths) / n
        upper = [sum(kind(b) == 2 for b in w) for w in words]
        out.append(
            [kinds.count(k) / len(kinds) for k in range(9)]
            + [math.log1p(n) / 5, mean / 10, math.sqrt(max(sum(x * x for x in lengths) / n - mean**2, 0)) / 10, len(set(words)) / n, max(words.count(w) for w in words) / n]
            + [sum(a == b for a, b in zip(words, words[1:])) / n, sum(u > 1 and 2 * u > x for u, x in zip(upper, lengths)) / n, sum(u == 1 for u in upper) / n]
            + [sum(any(kind(b) >= 7 for b in w) for w in words) / n, sum(x <= 3 for x in lengths) / n]
            + plain_buckets([int(quality._HASH(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in words])
            + plain_buckets([int(quality.mix(np.array([int.from_bytes(data[i : i + 3], "big") + 1], np.uint64))[0]) for i in range(begin, end - 2)])
        )
    return out


def plain_buckets(hashes):
    numbers = [(h >> 32) % quality.BUCKETS for h in hashes]
    return [numbers.count(k) / max(len(numbers), 1) for k in range(quality.BUCKETS)]


def plain_score(features, w):
    """Gated attention over the passages of one document, number by number."""
    sigmoid = lambda x: 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))
    hidden, marks = [], []
    for f in features:
        x = [(a - m) / s for a, m, s in zip(f, w["mean"], w["scale"])]
        h = [math.tanh(sum(x[i] * w["encode"][i][j] for i in range(len(x))) + w["encode0"][j]) for j in range(quality.HIDDEN)]
        gated = [math.tanh(sum(h[i] * w["tanh"][i][j] for i in range(len(h)))) * sigmoid(sum(h[i] * w["gate"][i][j] for i in range(len(h)))) for j in range(quality.GATES)]
        hidden.append(h)
        marks.append(sum(g * a for g, a in zip(gated, w["attend"])))
    share = [math.exp(m - max(marks)) for m in marks]
    z = [sum(s * h[j] for s, h in zip(share, hidden)) / sum(share) for j in range(quality.HIDDEN)]
    return sigmoid(sum(a * b for a, b in zip(z, w["out"])) + float(w["out0"]))


def test_scores_are_those_of_plain_loops(spark, make, rng):
    shout = lambda n: " ".join(rng.choice(["BUY", "NOW!!", "x|y", "1234", "aa", "aa"]) for _ in range(n))
    texts = [sentence(rng, rng.randint(1, 350)) if i % 2 else shout(rng.randint(1, 260)) for i in range(60)] + ["", None, " \n\t ", "one", "é ñ 日本\n\nÜber | x", "a " * 100, "a " * 101, sentence(rng, 100) + " \n "]
    docs = make(*enumerate(texts))
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    assert model.constant is None
    for r in quality.score_quality(docs, model).collect():
        features = np.array(plain_features(texts[r.doc_id] or "")).astype("<f4").astype(float)
        assert r.n_passages == len(features)
        assert r.score == pytest.approx(plain_score(features.tolist(), model.weights), abs=1e-7), texts[r.doc_id]
        assert r.predicted == (r.score >= 0.3)
