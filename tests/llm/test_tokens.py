import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strandsieve.llm import seekable, token_files, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(texts):
    t = Tokenizer.from_file(PATH)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def by_parts(texts, path=PATH):
    encode = tokens.PieceEncoder(path)
    column = pa.array(texts, pa.string())
    ids = [x.tolist() for x in encode.ids(column)]
    assert encode.counts(column) == [len(x) for x in ids]
    return ids


ODD = ["", " ", "  a  b", "a b ", "\n\n x \t y\n", "don't  '  s he'll I'd x's 's", "x  y  z", "日本 語 ñ", "a\x1c b \x1cc \x85 x  y 　z \xa0q", "<|endoftext|> hi<|endoftext|>", " ªº x² ½ ⅷ 3rd _a_ a_b", "\n", "\n\n\nabc", "tail. ", "A." * 50, "'s's 'tis ''s 're'x 'll", "a <|endoftext|> b", "\U0001f600 a\0b \ud7ff", None]


def mixed(n):
    rng = random.Random(1)
    return ODD + ["".join(rng.choice("abstdmlrev'. \n\t\xa0\u00e9\u65e51_\u2019\u201c") for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_parts_give_the_ids_of_the_whole_text():
    texts = mixed(2000)
    assert by_parts(texts) == plain(texts)


def test_every_character_in_every_neighbourhood():
    points = [c for c in range(0x10000) if tokens._classes()[c] != tokens._ODD]
    assert len(points) > 50_000
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}.{chr(c)}\n{chr(c)}'s" for c in points[i : i + 200]) for i in range(0, len(points), 200)]
    assert by_parts(texts) == plain(texts)


@pytest.mark.parametrize(("name", "value"), [("REMEMBERED", 3), ("GROUP", 50), ("JOINED", 1)])
def test_sizes_change_nothing(monkeypatch, name, value):
    monkeypatch.setattr(tokens, name, value)
    texts = [*mixed(100), "one two three four one two. five, one six two " * 30, "x" * 200 + " y", " ".join(x or "" for x in mixed(50))]
    assert by_parts(texts) == plain(texts)


def test_added_tokens_are_found_as_the_library_finds_them():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "no token", "<|endof", "text|>", "x<|endoftext|><|endoftext|>"]
    assert by_parts(texts) == plain(texts)
    assert 50256 in by_parts(texts)[0]


def test_other_tokenizers_are_called_on_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    assert by_parts(ODD, path) == [t.encode(x or "", add_special_tokens=False).ids for x in ODD]


def test_histogram_answers_every_limit(nasty, spark):
    lengths = [len(x) for x in plain([r.text for r in nasty.collect()])]
    hist = tokens.length_histogram(tokens.count_tokens(nasty, PATH), block=7).persist()
    rows = {r.n_tokens: r for r in hist.collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert r.n_docs == lengths.count(n)
        assert r.docs_at_least == sum(x >= n for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= n)
        assert r.truncated_total == sum(min(x, n) for x in lengths)
        assert r.quantile == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    for limit in (0, 1, 10, 100, 10**6):
        assert tuple(tokens.truncated_total(hist, limit).first()) == (sum(lengths), sum(min(x, limit) for x in lengths))
    assert tokens.quantile(hist, 0.5).first()[0] == sorted(lengths)[-(-len(lengths) // 2) - 1]


def test_empty_table_has_an_empty_histogram(empty):
    hist = tokens.length_histogram(tokens.count_tokens(empty, PATH))
    assert hist.count() == 0
    assert tuple(tokens.truncated_total(hist, 5).first()) == (0, 0)


class Source(io.BytesIO):
    reads = 0

    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        self.reads += n
        return self.getvalue()[at : at + n]


def test_file_format_round_trip_and_single_reads():
    rng = np.random.default_rng(1)
    docs = [(i if i != 3 else None, rng.integers(0, 50257, n).astype(np.uint32)) for i, n in enumerate((0, 1, 5, 3000, 2))]
    for width in (2, 4):
        s = Source()
        w = seekable.Writer(s, width)
        for i, ids in docs:
            w.add(i, ids)
        w.finish()
        r = seekable.Reader(s)
        assert r.doc_ids == [i for i, _ in docs]
        assert all((a == b).all() for a, (_, b) in zip(r, docs, strict=True))
        before = s.reads
        assert (r.read(2) == docs[2][1]).all()
        assert s.reads - before < 60
        assert [d for d, _ in r.wanted([1, 4])] == [1, 4]


def test_ids_that_do_not_fit_are_refused():
    w = seekable.Writer(Source(), 2)
    with pytest.raises(ValueError, match="does not fit"):
        w.add(1, np.array([70_000], np.uint32))


def test_damage_is_found():
    s = Source()
    w = seekable.Writer(s)
    w.add(1, np.arange(1000, dtype=np.uint32))
    w.finish()
    good = s.getvalue()
    for at in (40, len(good) - 3, len(good) - 12):
        bad = bytearray(good)
        bad[at] ^= 0xFF
        with pytest.raises(Exception, match=r"(?s).+"):
            list(seekable.Reader(Source(bytes(bad))))


def test_files_of_documents(nasty, tmp_path):
    folder = f"file://{tmp_path}/ids"
    got = token_files.token_file_digests(nasty, PATH, folder).collect()
    rows = sorted(nasty.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want = {}
    for r, ids in zip(rows, plain([r.text for r in rows]), strict=True):
        data = np.array([*ids, 0], "<u4")
        want.setdefault(r.doc_id, []).append((len(data), zlib.crc32(data.tobytes())))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [r.doc_id for r in rows]
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    assert all(p.name.endswith(".zst") for p in (tmp_path / "ids").iterdir())


def test_no_documents_no_files(empty, tmp_path):
    assert token_files.token_file_digests(empty, PATH, f"file://{tmp_path}/none").count() == 0
