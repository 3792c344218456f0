import random

import corpus_pipeline
import pytest

from strandsieve.llm.common import written

from .conftest import DOCS, sentence


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with junk, copies, near copies and leaks planted by id."""
    rng = random.Random(21)
    item = sentence(rng, 25)
    rows, labels = [], []
    for i in range(240):
        words = sentence(rng, rng.randint(20, 120)).split(" ")
        kind = i % 12
        if kind == 3:
            words = ["JUNK!!"] * 50 + words[:10]
        if kind == 5:
            words = rows[-1][1].split(" ")  # an exact copy of the document before
        if kind == 6:
            words = [*rows[-2][1].split(" ")[:-1], "changed"]
        if kind == 7:
            words = words[:10] + item.split(" ") + words[10:]
        rows.append((i, " ".join(words), "en", f"s{i % 4}", 0))
        labels.append((i, int(kind != 3), 0))
    path = tmp_path_factory.mktemp("tables")
    for name, data, ddl in (("documents", rows, DOCS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", [(0, item)], "item_id long, text string")):
        spark.createDataFrame(data, ddl).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_stages_take_effect_and_keep_clean_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    have = {r.doc_id for r in docs.collect()}
    gone = []
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left = {r.doc_id for r in docs.collect()}
        gone.append({i % 12 for i in have - left})
        assert len(have - left) >= 20
        have = left
    assert gone == [{3}, {5, 6}, {7}]


def test_whole_run(spark, folder):
    assert len(corpus_pipeline.STAGES) == 5
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id % 12 for r in got} == {0, 1, 2, 4, 8, 9, 10, 11}
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))  # noqa: B905
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted(r.doc_id for r in got)


def tables(spark, path, docs, labels, items):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_nulls_repeats_long_texts_and_clashing_columns(spark, nasty, tmp_path):
    labels = [(i, int(i != 7), None) for i in range(1, 13)] + [(1, None, 0), (None, 1, 0)]
    folder = tables(spark, tmp_path, nasty, labels, [(0, "another text under the same id with quite a few words in it"), (1, None), (None, "")])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        before = docs.count()
        docs, _ = written(stage(spark, docs, folder), "stage")
        assert docs.columns == nasty.columns
        assert 0 < docs.count() <= before
    left = [(r.doc_id, r.text) for r in docs.collect()]
    assert not any(t and "quite a few words in it" in t for _, t in left)
    assert sum(len(t or "") > 20_000 for _, t in left) >= 2  # one of the long near copies, and the long word
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} <= {i for i, _ in left}


@pytest.mark.parametrize("n", [0, 1])
def test_tables_without_rows(spark, make, empty, tmp_path, n):
    docs = empty if n == 0 else make((5, "one document with a few words"))
    folder = tables(spark, tmp_path, docs, [], [])
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} <= {5}
    assert (len(got) > 0) == (n == 1)
