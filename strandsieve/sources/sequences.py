"""FASTA through Spark's text reader, reads as a stream through one task a file (their order is their identity)."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandsieve import contracts
from strandsieve.sources.order import in_file_order

READS = "design_id string, metagenome_id string, ordinal long, name string, sequence string"


def read_fasta(spark: SparkSession, path: str | list[str], strict: bool = False, ordered: bool = False) -> DataFrame:
    """id, description and sequence of each record; plain files are split between tasks, compressed ones are not.

    `strict`: text before the first record, records without an id or a sequence, and repeated ids are errors; of each check
    the first such record in file order is reported. `ordered`: adds `file` and `row`, the record's place from 0.
    """
    raw = spark.read.text(path, lineSep="\n>")
    if strict or ordered:
        raw = in_file_order(raw)
    kept = ["file", "row"] if strict or ordered else []
    raw = raw.select(*kept, F.regexp_replace("value", "\r", "").alias("value"))
    # The very first record keeps its sign; a later one lost it to the separator.
    body = F.regexp_replace("value", r"\A\s*>", "")
    parts = raw.where(F.trim("value") != "").withColumn("_body", body)
    header = F.regexp_extract("_body", r"\A([^\n]*)", 1)
    records = parts.select(
        F.regexp_extract(header, r"^(\S*)", 1).alias("id"),
        F.trim(F.regexp_extract(header, r"^\S*\s*(.*)$", 1)).alias("description"),
        F.regexp_replace(F.regexp_replace("_body", r"\A[^\n]*\n?", ""), r"\s", "").alias("sequence"),
        *kept, *(["value"] if strict else []),
    )
    if strict:
        contracts.require_rows(records, "FASTA")
        unsigned = (F.col("row") == 0) & ~F.ltrim("value").startswith(">")
        checks = [
            (unsigned, F.concat(F.lit("text before the first record: "), F.col("id"))),
            (F.col("id") == "", "record without id"),
            (F.col("sequence") == "", F.concat(F.lit("empty record "), F.col("id"))),
        ]
        contracts.require(records, checks, ["file", "row"], "FASTA")
        contracts.require_unique(records, ["id"], "FASTA")
        records = records.drop("value")
    return records if ordered else records.drop("file", "row")


def read_kmer_fasta(spark: SparkSession, path: str, k: int) -> DataFrame:
    """Strict FASTA of unique k-mers of A, C, G and T."""
    records = read_fasta(spark, path, strict=True, ordered=True)
    checks = [
        (~F.col("sequence").rlike("^[ACGT]+$"), F.concat(F.lit("not DNA: "), F.col("id"))),
        (F.length("sequence") != k, F.concat(F.lit("wrong length: "), F.col("id"))),
    ]
    contracts.require(records, checks, ["file", "row"], "k-mer FASTA")
    return contracts.require_unique(records, ["sequence"], "k-mer FASTA").drop("file", "row")


def read_names(spark: SparkSession, directory: str) -> list[str]:
    """Names of the directory's direct children, hidden ones too (Spark's file sources would drop those silently)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(directory)
    listed = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    names = sorted(s.getPath().getName() for s in listed if s.isFile())
    if not names:
        raise contracts.ContractError(f"no reads in {directory}")
    return names


def _pieces(stream, size: int) -> Iterator[bytes]:
    """Decoded pieces of a file that may be compressed, in one or many members, as its first bytes tell; never the whole of it."""
    piece = stream.read(size)
    while 0 < len(piece) < 2:
        more = stream.read(size)
        if not more:
            break
        piece += more
    if piece[:2] != b"\x1f\x8b":
        while piece:
            yield piece
            piece = stream.read(size)
        return
    member = zlib.decompressobj(31)
    while piece:
        out = member.decompress(piece, 4 * size)
        if out:
            yield out
        piece = member.unconsumed_tail
        if member.eof:
            piece = (member.unused_data or stream.read(size)).lstrip(b"\0")
            if piece:
                member = zlib.decompressobj(31)
        elif not piece:
            piece = stream.read(size)
            if not piece and not member.eof:
                piece = b""
    if not member.eof:
        raise contracts.ContractError("compressed reads end within a member")


def _lines(pieces: Iterator[bytes]) -> Iterator[str]:
    held: list[bytes] = []
    for piece in pieces:
        first, *rest = piece.split(b"\n")
        held.append(first)
        for line in rest:
            yield b"".join(held).decode("ascii", "replace").rstrip("\r")
            held = [line]
    last = b"".join(held)
    if last:
        yield last.decode("ascii", "replace").rstrip("\r")


def parse_reads(stream, size: int = 1 << 20) -> Iterator[tuple[str, str]]:
    """(name, sequence) of a FASTQ or FASTA file in file order, record by record.

    A FASTQ record has four lines, its quality as long as its sequence; a record that is cut short, or anything but blank
    lines behind the last one, is an error.
    """
    lines = enumerate(_lines(_pieces(stream, size)), 1)
    n, line = next(((n, x) for n, x in lines if x.strip()), (0, ""))
    if not line:
        return
    if line[0] == "@":
        while True:
            record = [line, *(x for _, x in itertools.islice(lines, 3))]
            if len(record) < 4 or record[0][:1] != "@" or record[2][:1] != "+" or len(record[3].strip()) != len(record[1].strip()):
                raise contracts.ContractError(f"malformed FASTQ record at line {n}")
            yield record[0][1:].split(" ")[0], record[1].strip()
            n, line = next(lines, (0, ""))
            if not line.strip():
                rest = next(((n, x) for n, x in lines if x.strip()), None)
                if rest is not None:
                    raise contracts.ContractError(f"blank line within FASTQ before line {rest[0]}")
                return
    if line[0] != ">":
        raise contracts.ContractError(f"text before the first record at line {n}")
    name, parts = line[1:].split(" ")[0], []
    for _, line in lines:
        if line[:1] == ">":
            yield name, "".join(parts)
            name, parts = line[1:].split(" ")[0], []
        elif line.strip():
            parts.append(line.strip())
    yield name, "".join(parts)


def read_reads(spark: SparkSession, files: list[tuple[str, str, str]], batch_bytes: int = 8 << 20) -> DataFrame:
    """Reads of (design_id, metagenome_id, path) files with their place in the file; headers are not identities.

    A file is one task's, as its order is the identity of its reads, but it goes through in batches of about `batch_bytes`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for i in batch.column(0).to_pylist():
                design, source, path = files[i]
                store, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

                def out(rows: list[tuple[int, str, str]], design: str = design, source: str = source) -> pa.RecordBatch:
                    columns = [pa.array([design] * len(rows)), pa.array([source] * len(rows)), *(pa.array(c) for c in zip(*rows, strict=True))]
                    return pa.record_batch(columns, names=[c.split()[0] for c in READS.split(", ")])

                with store.open_input_stream(name, compression=None) as stream:
                    rows, size = [], 0
                    for n, (read, sequence) in enumerate(parse_reads(stream)):
                        rows.append((n, read, sequence))
                        size += len(sequence) + 64
                        if size >= batch_bytes:
                            yield out(rows)
                            rows, size = [], 0
                    if rows:
                        yield out(rows)

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(run, READS)
