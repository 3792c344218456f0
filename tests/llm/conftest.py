from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, and other odd columns.
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, _row string, _key string, _size string, _copies string, anchor string, size string, node string, spans string, start string, _kept string, _n string, key string, part string, tag string, doc string, text_ string"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source)."""

    def put(*rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return put


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls, empty and long texts, repeated rows and doc_ids, odd characters, and clashing extra columns."""
    rng = random.Random(3)
    long = sentence(rng, 6000)
    near = long.split(" ")
    near[17] = "changed"
    rows = [
        (1, long), (2, " ".join(near)), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "one two three four"), (8, "ONE TWO three four"), (9, long), (10, "é ñ 日本 語  x  y z w v u t"),
        (10, "é ñ 日本 語  x  y z w v u t"), (10, "another text under the same id with quite a few words in it"), (None, "no id but text that is long enough to have a few shingles"), (None, None), (11, "x" * 50_000), (12, "a b " * 3000),
    ]
    full = [(i, t, None if i == 6 else "en", None if k % 4 == 3 else f"s{k % 3}", None, *["clash"] * 16) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, EXTRA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def rng():
    return random.Random(7)
