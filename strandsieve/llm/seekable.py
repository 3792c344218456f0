"""Token files: independent zstandard frames, a document directory and a trailing seek table.

Layout, all integers little-endian:

* one zstandard frame for each document, holding its ids as unsigned 16-bit (or 32-bit) integers;
* a skippable frame with the documents' ids: width of a token id, then a zstandard frame of validity bytes and int64;
* a skippable frame with the seek table of the public zstandard seekable format: compressed size, decompressed size and
  the low 32 bits of XXH64 of each frame's content, then the number of frames, a descriptor byte and a magic number.

A reader takes the table from the file's end and decompresses only the frames of the documents asked for.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
import zstandard

# Fixed values of the public format.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80


class CorruptFile(ValueError):
    """A size, magic number or checksum does not hold."""


class Writer:
    def __init__(self, sink, width: int = 2, level: int = 3) -> None:
        self.sink, self.width = sink, width
        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self.table: list[bytes] = []
        self.ids: list[int | None] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> (8 * self.width):
            raise ValueError(f"an id does not fit into {self.width} bytes")
        raw = ids.astype(f"<u{self.width}").tobytes()
        frame = self.compress(raw)
        if max(len(frame), len(raw)) >= 1 << 32:
            raise ValueError("a document's frame must stay under 4 GiB")
        self.sink.write(frame)
        self.table.append(struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.tokens += len(ids)

    def finish(self) -> None:
        valid = np.array([i is not None for i in self.ids], np.uint8).tobytes()
        values = np.array([i or 0 for i in self.ids], "<i8").tobytes()
        body = struct.pack("<B", self.width) + self.compress(valid + values)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        tail = b"".join(self.table) + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        self.sink.write(struct.pack("<II", SEEK_TABLE, len(tail)) + tail)


class Reader:
    """`source` has `size()` and `read_at(n, offset)`, as Arrow's random-access files have."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        n, descriptor, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEKABLE or descriptor != CHECKSUMS:
            raise CorruptFile("no seek table at the end")
        table_at = size - 17 - 12 * n
        head = source.read_at(8, table_at)
        if struct.unpack("<II", head) != (SEEK_TABLE, 12 * n + 9):
            raise CorruptFile("the seek table's frame is damaged")
        table = np.frombuffer(source.read_at(12 * n, table_at + 8), "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.raw, self.sums = table[:, 0], table[:, 1], table[:, 2]
        self.at = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        magic, length = struct.unpack("<II", source.read_at(8, int(self.at[-1])))
        if magic != SKIPPABLE or int(self.at[-1]) + 8 + length != table_at:
            raise CorruptFile("the document directory is damaged")
        body = source.read_at(length, int(self.at[-1]) + 8)
        self.width = body[0]
        self.decompress = zstandard.ZstdDecompressor().decompress
        listed = self.decompress(body[1:])
        valid, values = np.frombuffer(listed[:n], np.uint8), np.frombuffer(listed[n:], "<i8")
        self.doc_ids = [int(v) if ok else None for ok, v in zip(valid, values, strict=True)]
        self.n_tokens = self.raw // self.width

    def __len__(self) -> int:
        return len(self.doc_ids)

    def _open(self, i: int, frame: bytes) -> np.ndarray:
        raw = self.decompress(frame)
        if len(raw) != self.raw[i] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
            raise CorruptFile(f"frame {i} does not match its checksum")
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def read(self, i: int) -> np.ndarray:
        """Ids of the i-th document of this file; no other frame is touched."""
        return self._open(i, self.source.read_at(int(self.sizes[i]), int(self.at[i])))

    def wanted(self, doc_ids: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        want = set(doc_ids)
        for i, d in enumerate(self.doc_ids):
            if d in want:
                yield d, self.read(i)

    def __iter__(self) -> Iterator[np.ndarray]:
        """All documents in order, read in spans of about 4 MB."""
        i = 0
        while i < len(self):
            j = max(i + 1, int(np.searchsorted(self.at, self.at[i] + (4 << 20), "right")) - 1)
            span = self.source.read_at(int(self.at[j] - self.at[i]), int(self.at[i]))
            for k in range(i, j):
                yield self._open(k, span[self.at[k] - self.at[i] : self.at[k + 1] - self.at[i]])
            i = j
