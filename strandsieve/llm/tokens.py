"""Exact token counts: a histogram of encoded lengths whose suffix sums answer every context limit.

`count_tokens` encodes whole texts; `length_histogram` pre-aggregates them to one row for each distinct length and adds
suffix sums in two levels (blocks of lengths, then lengths within a block), so that no task orders the whole axis.

Edge cases: null and empty texts have length 0 and are counted; repeated rows count each time; an empty table gives an
empty histogram; columns other than those named are ignored; very long texts are encoded whole.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strandsieve.llm.bytescan import WordHasher, groups, utf8
from strandsieve.llm.common import written

#: Bytes of text whose parts are looked up together, distinct parts that go to the library in one string, and parts remembered.
GROUP, JOINED, REMEMBERED = 4 << 20, 256, 800_000
#: Classes of characters: none, letter, number, white space, the space itself, any other; `_ODD` leaves a text to the library.
_LETTER, _NUMBER, _WHITE, _BLANK, _OTHER, _ODD = range(1, 7)
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
_MARK = np.array([33 <= b < 127 for b in range(256)])
_ONE, _TWO = WordHasher(21), WordHasher(22)


@cache
def _classes() -> np.ndarray:
    """The class of each code point below 0x10000; those without an assigned character, and surrogates, are odd."""
    out = np.full(0x10000, _OTHER, np.uint8)
    points = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    for kind, expression in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_WHITE, r"\s")):
        out[[ord(c) for c in regex.findall(expression, "".join(map(chr, points)))]] = kind
    out[32] = _BLANK
    out[[c for c in range(0x10000) if unicodedata.category(chr(c)) in ("Cn", "Cs", "Co")]] = _ODD
    out[0] = _ODD
    return out


def kinds(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 text belongs to; bytes after a character's first one have 0."""
    table = _classes()
    out = table[data]
    if len(data) and data.max() >= 0x80:
        out[data >= 0x80] = 0
        two = np.flatnonzero((data >= 0xC0) & (data < 0xE0))
        out[two] = table[(data[two] & 0x1F).astype(np.int32) << 6 | data[two + 1] & 0x3F]
        three = np.flatnonzero((data >= 0xE0) & (data < 0xF0))
        out[three] = table[(data[three] & 0x0F).astype(np.int32) << 12 | (data[three + 1] & 0x3F).astype(np.int32) << 6 | data[three + 2] & 0x3F]
        out[data >= 0xF0] = _ODD
    return out


def part_starts(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray | None = None) -> np.ndarray:
    """Where the parts of each row start that the byte-level pattern cuts a text into before any merge (all bytes of `data`).

    The pattern: 's 't 're 've 'm 'll 'd; runs of letters, of numbers, or of other marks, each with one space before; white
    space up to the one before a mark; white space.
    """
    kind = kinds(data) if kind is None else kind
    at = np.flatnonzero(kind)  # characters
    kind = kind[at]
    n = len(at)
    row = np.zeros(n + 1, bool)
    row[np.searchsorted(at, offsets)] = True
    white = (kind == _WHITE) | (kind == _BLANK)
    before, gap = np.empty(n, np.uint8), np.empty(n, bool)
    before[:1], before[1:] = 0, kind[:-1]
    gap[:1], gap[1:] = False, white[:-1]
    follows = np.zeros(n, bool)  # by a mark of the same row
    follows[:-1] = ~white[1:] & ~row[1:-1]
    start = row[:-1] | np.where(white, ~gap | follows, (before == _WHITE) | (~gap & (before != kind)))
    sign = np.flatnonzero(start & (data[at] == 0x27))
    if len(sign):
        byte = at[sign]
        end = offsets[np.searchsorted(offsets, byte, "right")]
        for letters in _ENDINGS:
            fits = byte + len(letters) < end
            for k, letter in enumerate(letters):
                fits &= data[np.minimum(byte + 1 + k, len(data) - 1)] == letter
            start[sign[fits] + 1] = False
            over = sign[fits] + 1 + len(letters)
            start[over[over < n]] = True
    return at[start]


class _Memory:
    """Ids of parts by 128 bits of hash: sorted arrays over one pool of ids. Full, it forgets all but the last group's parts."""

    def __init__(self) -> None:
        self.one, self.two = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.head, self.count, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def find(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key is, or is to be put, and whether it is there; keys ascend."""
        at = np.searchsorted(self.one, one)
        near = np.minimum(at, max(len(self.one) - 1, 0))
        return at, (self.one[near] == one) & (self.two[near] == two) if len(self.one) else np.zeros(len(one), bool)

    def add(self, at: np.ndarray, one: np.ndarray, two: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        head = np.cumsum(count) - count + len(self.pool)
        self.pool = np.concatenate([self.pool, ids])
        self.one, self.two = np.insert(self.one, at, one), np.insert(self.two, at, two)
        self.head, self.count = np.insert(self.head, at, head), np.insert(self.count, at, count)


class PieceEncoder:
    """Whole texts to ids by the tokenizers library, encoding each distinct part once while it is remembered.

    A byte-level vocabulary cuts a text by a fixed pattern before any merge. The parts of all texts of a group are cut and
    told apart (by 128 bits of hash) at once, those not remembered go through the library's merges, and ids are dealt out to
    all places. These are exactly the ids that the library gives for the whole text with add_special_tokens=False. A text
    that holds one of the tokenizer's added tokens, a zero byte, or characters beyond those the pattern is known to class
    goes to the library whole, and so does every text if the tokenizer is of another kind.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        cut, model = described.get("pre_tokenizer") or {}, described["model"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        odd = [b for b in range(256) if b not in plain]
        letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)}
        self.shown = np.array([ord(letters[b]) for b in range(256)], "<u2")
        self.by_part = (
            (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
            and not any(described.get(k) for k in ("normalizer", "truncation", "padding"))
            and (described.get("post_processor") or {}).get("type") in (None, "ByteLevel")
            and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and letters[0] in model["vocab"]
            and not any(letters[0] in "".join(pair) for pair in model["merges"])  # so a zero byte keeps parts asunder
        )
        self.most = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
        self.added = [t["content"].encode() for t in described.get("added_tokens", []) if t["content"]]
        if self.by_part:
            self.zero = model["vocab"][letters[0]]
            self.merges = Tokenizer(self.tokenizer.model)
            self.known = _Memory()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _merged(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts in a row, and how many each has."""
        shown = [self.shown[np.frombuffer(b"\0".join([*parts[i : i + JOINED], b""]), np.uint8)].tobytes().decode("utf-16-le") for i in range(0, len(parts), JOINED)]
        ids = np.concatenate([np.zeros(0, np.uint32), *[np.array(e.ids, np.uint32) for e in map(self._fast, shown)]])
        ends = np.flatnonzero(ids == self.zero)
        return ids[ids != self.zero], np.diff(ends, prepend=-1) - 1

    def _fast(self, shown: str):
        return self.merges.encode_batch_fast([shown], add_special_tokens=False)[0]

    def _odd_rows(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Which rows go to the library whole."""
        out = np.zeros(len(offsets) - 1, bool)
        out[np.searchsorted(offsets, np.flatnonzero(kind == _ODD), "right") - 1] = True
        raw = data.tobytes() if self.added else b""
        for token in self.added:
            found = raw.find(token)
            while found >= 0:
                i = int(np.searchsorted(offsets, found, "right")) - 1
                out[i] = True  # a token across two rows' ends does no harm: the library decides
                found = raw.find(token, max(int(offsets[i + 1]), found + 1))
        return out

    def _group(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a group of rows: where in the memory's pool the ids of each part are, how many, and each row's first part."""
        starts = part_starts(data, offsets, kind)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        one, two = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):  # hashed in stretches that stay in the cache
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + (1 << 17))))
            a, z = int(starts[i]), int(ends[j - 1])
            one[i:j] = _ONE(data[a:z], starts[i:j] - a, ends[i:j] - a)
            two[i:j] = _TWO(data[a:z], starts[i:j] - a, ends[i:j] - a)
            i = j
        which, names = pd.factorize(one)
        first = np.empty(len(names), np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        if (two != two[first[which]]).any():  # two parts with one hash
            _, first, which = np.unique(np.stack([one, two], 1), axis=0, return_index=True, return_inverse=True)
        if len(self.known.one) + len(first) > REMEMBERED:
            self.known = _Memory()
        order = np.argsort(one[first])
        place = first[order]
        at, known = self.known.find(one[place], two[place])
        new = place[~known]
        if len(new):
            ids, count = self._merged([data[a:z].tobytes() for a, z in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            self.known.add(at[~known], one[new], two[new], ids, count)
            at = at + np.cumsum(~known) - ~known  # moved by those put in before
        slot = np.empty(len(first), np.int64)
        slot[order] = at
        slot = slot[which]
        return self.known.head[slot], self.known.count[slot], np.searchsorted(starts, offsets)

    def _rows(self, column: pa.Array, whole: bool) -> Iterator[list]:
        """Of each row in order a list of its pieces: arrays of ids if `whole`, else numbers of ids."""
        data, offsets = utf8(column)
        for i, j in groups(offsets, GROUP):
            part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            kind = kinds(part) if self.by_part else part[:0]
            odd = self._odd_rows(part, at, kind) if self.by_part else np.ones(j - i, bool)
            done: list[list] = [[] for _ in range(j - i)]
            for k in np.flatnonzero(odd).tolist():
                ids = self._whole(part[at[k] : at[k + 1]].tobytes().decode())
                done[k].append(ids if whole else len(ids))
            for rows, a, z in _stretches(part, at, odd):
                head, count, first = self._group(part[a:z], np.clip(at[rows.start : rows.stop + 1], a, z) - a, kind[a:z])
                total = np.concatenate([[0], np.cumsum(count)])
                marks = total[first].tolist()
                if whole:
                    here = self.known.pool[np.repeat(head - total[:-1], count) + np.arange(total[-1])]
                for m, k in enumerate(rows):
                    done[k].append(here[marks[m] : marks[m + 1]] if whole else marks[m + 1] - marks[m])
            yield from done

    def ids(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each row of a string column, unsigned 32-bit; null is empty."""
        for found in self._rows(column, True):
            yield found[0] if len(found) == 1 else np.concatenate([np.zeros(0, np.uint32), *found])

    def counts(self, column: pa.Array) -> list[int]:
        """How many ids each row has."""
        return [sum(found) for found in self._rows(column, False)]


def _stretches(data: np.ndarray, offsets: np.ndarray, left_out: np.ndarray) -> Iterator[tuple[range, int, int]]:
    """Runs of rows that are not left out, with their bytes; a single long row in stretches between which parts never reach."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], left_out, [True]])))
    for a, z in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        at, end = int(offsets[a]), int(offsets[z])
        if end - at > GROUP:  # groups() takes such a row alone
            cuts = at + 1 + np.flatnonzero((data[at + 1 : end - 1] == 0x20) & _MARK[data[at : end - 2]] & _MARK[data[at + 2 : end]])
            while end - at > GROUP and len(cuts) and cuts[-1] > at:
                cut = int(cuts[max(int(np.searchsorted(cuts, at + GROUP)) - 1, int(np.searchsorted(cuts, at, "right")))])
                yield range(a, z), at, cut
                at = cut
        yield range(a, z), at, end


@cache
def encoder(path: str) -> PieceEncoder:
    """This worker's encoder."""
    return PieceEncoder(path)


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """One row for each row of `docs`: the number of ids of its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for b in batches:
            yield pa.record_batch({into: pa.array(encode.counts(b.column(0)), pa.int64())})

    return docs.select(F.col(text)).mapInArrow(run, T.StructType([T.StructField(into, T.LongType())]))


def length_histogram(lengths: DataFrame, column: str = "n_tokens", block: int = 1024) -> DataFrame:
    """One row for each distinct length, with counts and sums at it, at or over it, and truncated to it."""
    # Written, as it is read twice below and every text would else be encoded twice.
    per, _ = written(lengths.groupBy(F.col(column).cast("long").alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
    per = per.withColumn("_block", F.floor(F.col("n_tokens") / block)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = per.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("tokens").alias("_t"))
    after = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_d_over"),
        F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_t_over"),
        F.sum("_d").over(total).alias("_d_all"),
        F.sum("_t").over(total).alias("_t_all"),
    )
    within = Window.partitionBy("_block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = per.join(blocks, "_block").withColumns({
        "docs_at_least": F.col("_d_over") + F.sum("n_docs").over(within),
        "tokens_at_least": F.col("_t_over") + F.sum("tokens").over(within),
    })
    return out.select(
        "n_tokens",
        "n_docs",
        "tokens",
        "docs_at_least",
        "tokens_at_least",
        (F.col("_t_all") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("_d_all") - F.col("docs_at_least") + F.col("n_docs")) / F.col("_d_all")).alias("quantile"),
    )


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row: all tokens, and the tokens that are left if every document is cut to `limit`."""
    return histogram.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("truncated"),
    )


def quantile(histogram: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length at which the share of documents not longer reaches `q`."""
    return histogram.where(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n_tokens"))
