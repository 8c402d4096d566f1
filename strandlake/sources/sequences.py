"""FASTQ and FASTA as Spark data sources (`fastq`, `fasta`), gzip recognised by content.

Paths are local or shared file paths, or URIs that pyarrow's file systems open. Plain FASTQ is split
by byte ranges at proven record starts; gzip cannot be split and is one task a file.
"""

from __future__ import annotations

import gzip
import io
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strandlake.session import ship

# gzip's first bytes, and the suffixes tried for a mate in this order.
GZIP_MAGIC = b"\x1f\x8b"
MATE_SUFFIXES = (".fq", ".fastq", ".fq.gz", ".fastq.gz")

SPLIT_BYTES = 128 << 20
PROBE_LINES = 8
#: Files whose names are broadcast; more are joined by a shuffle.
BROADCAST_FILES = 100_000


def open_bytes(path: str):
    """A binary stream with seek."""
    if "://" in path:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path)
        return store.open_input_file(name)
    return open(path, "rb")


def file_size(path: str) -> int:
    if "://" in path:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path)
        return store.get_file_info(name).size
    return os.path.getsize(path)


def is_gzip(path: str) -> bool:
    with open_bytes(path) as f:
        return f.read(2) == GZIP_MAGIC


def lines_of(path: str, permissive: bool = False) -> Iterator[bytes]:
    """Lines without their newline. permissive: a broken gzip stream ends the file instead of failing."""
    with open_bytes(path) as raw:
        zipped = raw.read(2) == GZIP_MAGIC
        raw.seek(0)
        stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if zipped else io.BufferedReader(raw) if not isinstance(raw, io.BufferedReader) else raw
        try:
            for line in stream:
                yield line.rstrip(b"\n")
        except (EOFError, OSError, zlib.error):
            if not (permissive and zipped):
                raise


def record_name(header: bytes) -> str:
    return header[1:].decode("latin-1").split(" ", 1)[0].strip()


@dataclass
class Slice(InputPartition):
    path: str
    start: int = 0
    end: int | None = None


def record_start(stream, start: int) -> int | None:
    """Offset of the first FASTQ header at or after `start`: a line with @ whose second next begins with +.

    A quality line may begin with @, but the line two below it is a sequence, which never begins with +.
    """
    stream.seek(max(0, start - 1))
    if start:
        stream.readline()
    offsets, lines = [], []
    for _ in range(PROBE_LINES):
        offsets.append(stream.tell())
        lines.append(stream.readline())
    for i in range(PROBE_LINES - 2):
        if lines[i][:1] == b"@" and lines[i + 2][:1] == b"+":
            return offsets[i]
    return None


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options.get("paths", options.get("path", "")).split(",") if p]
        if not self.paths:
            raise ValueError("no path given")
        self.permissive = options.get("mode", "FAILFAST").upper() == "PERMISSIVE"
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.max_size = int(options.get("maxSize", 0))


class FastqReader(_Reader):
    def partitions(self):
        out = []
        for path in self.paths:
            with open_bytes(path) as f:
                first = f.read(2)
            size = file_size(path)
            if first[:1] == b"@" and size > self.split_bytes:
                cuts = list(range(0, size, self.split_bytes))
                out += [Slice(path, a, b) for a, b in zip(cuts, [*cuts[1:], size], strict=True)]
            else:
                out.append(Slice(path))
        return out

    def read(self, partition: Slice):
        path = partition.path
        if partition.end is not None:
            yield from self._slice(partition)
            return
        seen, name = False, ""
        for i, line in enumerate(lines_of(path, self.permissive)):
            seen = True
            if i == 0 and line[:1] not in (b"@", b">"):
                raise ValueError(f"{path} is neither FASTQ nor FASTA: its first line begins with {line[:1]!r}")
            if i == 0 and line[:1] == b">" and not self.permissive:
                raise ValueError(f"{path} is FASTA; read it with format('fasta'), or mode=PERMISSIVE to take every second line of four")
            if i % 4 == 0:
                name = record_name(line)
            elif i % 4 == 1:
                yield path, i // 4, name, self._cut(line)
        if not seen:
            raise ValueError(f"{path} is empty")

    def _cut(self, line: bytes) -> str:
        text = line.decode("latin-1")
        return text[: self.max_size] if self.max_size else text

    def _slice(self, part: Slice):
        with open_bytes(part.path) as raw:
            stream = io.BufferedReader(raw) if not isinstance(raw, io.BufferedReader) else raw
            at = record_start(stream, part.start)
            if at is None:
                return
            stream.seek(at)
            while (begin := stream.tell()) < part.end:
                header = stream.readline()
                seq = stream.readline()
                if not header or not seq:
                    return
                stream.readline()
                stream.readline()
                yield part.path, begin, record_name(header.rstrip(b"\n")), self._cut(seq.rstrip(b"\n"))


class FastqSource(DataSource):
    """(path, read_id, name, seq). read_id: the record's number in its file, or its byte offset in a split file; name: its
    header up to the first space."""

    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return "path string, read_id bigint, name string, seq string"

    def reader(self, schema):
        return FastqReader(self.options)


class FastaReader(_Reader):
    def partitions(self):
        return [Slice(p) for p in self.paths]

    def read(self, partition: Slice):
        name, parts, number = None, [], 0
        for line in lines_of(partition.path, self.permissive):
            if line[:1] == b">":
                if name is not None:
                    yield self._record(partition.path, number, name, parts)
                    number += 1
                name, parts = record_name(line), []
            elif line.strip():
                if name is None:
                    name = ""
                parts.append(line.strip().decode("latin-1"))
        if name is not None:
            yield self._record(partition.path, number, name, parts)

    def _record(self, path, number, name, parts):
        seq = "".join(parts)
        return path, number, name, seq[: self.max_size] if self.max_size else seq


class FastaSource(DataSource):
    """(path, read_id, name, seq): one row a record, its lines joined; name up to the first space."""

    @classmethod
    def name(cls):
        return "fasta"

    def schema(self):
        return "path string, read_id bigint, name string, seq string"

    def reader(self, schema):
        return FastaReader(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(FastqSource)
    spark.dataSource.register(FastaSource)


def read_fastq(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    register(spark)
    return spark.read.format("fastq").options(paths=",".join(paths), **options).load()


def read_fasta(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    register(spark)
    return spark.read.format("fasta").options(paths=",".join(paths), **options).load()


def mates(directory: str, accession: str) -> tuple[str, str]:
    """Paths of both mates; each is the first existing of the known suffixes."""
    found = []
    for mate in (1, 2):
        names = [os.path.join(directory, f"{accession}_{mate}{s}") for s in MATE_SUFFIXES]
        path = next((p for p in names if os.path.exists(p)), None)
        if path is None:
            raise FileNotFoundError(f"no reads of accession {accession}, mate {mate}, in {directory}")
        found.append(path)
    return found[0], found[1]


def read_accessions(spark: SparkSession, directory: str, accessions: list[str], **options) -> DataFrame:
    """reads(accession, mate, read_id, seq) of both mates of every accession, in one scan."""
    where = [(path, acc, mate) for acc in dict.fromkeys(accessions) for mate, path in enumerate(mates(directory, acc), start=1)]
    names = spark.createDataFrame(where, "path string, accession string, mate int")
    names = F.broadcast(names) if len(where) <= BROADCAST_FILES else names
    return read_fastq(spark, [p for p, _, _ in where], **options).join(names, "path").select("accession", "mate", "read_id", "seq")
