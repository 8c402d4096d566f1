"""Readers and writers of per-accession k-mer counts: Parquet, tab-separated text, packed 18-byte records, tar archives."""

from __future__ import annotations

import os
import struct
import tarfile
from collections.abc import Iterator
from decimal import Decimal
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.kmers import BASES, rolling_bin_id
from strandlake.session import ship
from strandlake.sources.sinks import committed

# The packed record is low 64 bits, high bits, uint16 count, little-endian.
RECORD = struct.Struct("<QQH")
RECORD_BYTES, COUNT_MASK = 18, 0xFFFF
#: Records decoded at once; files whose names are broadcast, a shuffle beyond.
BATCH_RECORDS, BROADCAST_FILES = 100_000, 100_000


def read_tsv(spark: SparkSession, path: str, accession: str | None = None) -> DataFrame:
    """kmer, cnt from `kmer<TAB>count` lines (also a text dump of an external counter); counts narrow to 16 bits.

    A line without exactly two fields, or whose count is no number, fails the query.
    """
    counts = _two_fields(spark.read.text(path))
    return counts if accession is None else counts.select(F.lit(accession).alias("accession"), "kmer", "cnt")


def _two_fields(lines: DataFrame, *keys: str) -> DataFrame:
    fields = F.split("value", "\t")
    checked = lines.select(*keys, F.when(F.size(fields) == 2, fields).otherwise(F.raise_error(F.concat(F.lit("expected two fields: "), F.col("value"))).cast("array<string>")).alias("f"))
    return checked.select(*keys, F.col("f")[0].alias("kmer"), F.col("f")[1].cast("bigint").bitwiseAND(F.lit(COUNT_MASK).cast("bigint")).alias("cnt"))


def write_tsv(counts: DataFrame, path: str) -> None:
    """One directory an accession and bin, lines `kmer<TAB>count`."""
    counts.select("accession", "bin", F.concat_ws("\t", "kmer", F.col("cnt").cast("string")).alias("value")).write.mode("overwrite").partitionBy("accession", "bin").text(path)


def pack(kmer: str, count: int) -> bytes:
    code = 0
    for base in kmer:
        code = code << 2 | BASES.index(base)
    return RECORD.pack(code & (1 << 64) - 1, code >> 64, count)


def unpack(record: bytes, k: int) -> tuple[str, int]:
    low, high, count = RECORD.unpack(record)
    code = high << 64 | low
    return "".join(BASES[code >> 2 * i & 3] for i in range(k - 1, -1, -1)), count


def read_packed(spark: SparkSession, path: str, k: int) -> DataFrame:
    """(path, kmer, cnt) of files of packed records; a trailing partial record fails.

    Records are decoded batch by batch in vectorised form; a task holds the bytes of one bin file and decodes BATCH_RECORDS at a time.
    """
    import numpy as np
    import pyarrow as pa

    letters = np.frombuffer(BASES.encode(), "u1")

    def decode(batches: Iterator[pa.RecordBatch]):
        kind = np.dtype([("low", "<u8"), ("high", "<u8"), ("cnt", "<u2")])
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if len(content) % RECORD_BYTES:
                    raise ValueError(f"{name} ends within a record")
                every = np.frombuffer(content, kind)
                for first in range(0, len(every), BATCH_RECORDS):
                    rows = every[first : first + BATCH_RECORDS]
                    out = np.empty((len(rows), k), "u1")
                    for i, s in enumerate(range(2 * k - 2, -1, -2)):
                        word = rows["low"] >> np.uint64(s) if s < 64 else rows["high"] >> np.uint64(s - 64)
                        out[:, i] = letters[(word & np.uint64(3)).astype(int)]
                    # Offsets over one buffer of letters: no object a k-mer is made.
                    kmers = pa.Array.from_buffers(pa.string(), len(rows), [None, pa.py_buffer(np.arange(0, k * (len(rows) + 1), k, dtype="<i4")), pa.py_buffer(out)])
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), kmers, pa.array(rows["cnt"].astype("i8"))], ["path", "kmer", "cnt"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*_nr.bin").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(decode, "path string, kmer string, cnt bigint")


def packed_records(counts: DataFrame) -> DataFrame:
    """(accession, bin, record): counts as packed binary records, JVM-side."""
    k = F.length("kmer")
    digits = F.translate("kmer", BASES, "0123")
    low = F.lpad(F.conv(F.conv(F.substring(digits, -32, 32), 4, 10), 10, 16), 16, "0")
    head = F.when(k > 32, F.substring(digits, F.lit(1), k - 32)).otherwise(F.lit("0"))
    high = F.lpad(F.conv(head, 4, 16), 16, "0")
    count = F.lpad(F.hex(F.col("cnt").bitwiseAND(F.lit(COUNT_MASK).cast("bigint"))), 4, "0")
    swapped = lambda h: F.reverse(F.regexp_replace(h, "(.)(.)", "$2$1"))  # noqa: E731  hex of the bytes in reverse order
    return counts.select("accession", "bin", F.unhex(F.concat(swapped(low), swapped(high), swapped(count))).alias("record"))


def write_packed(counts: DataFrame, directory: str) -> None:
    """`<accession>/<bin>_nr.bin` under a shared directory, each file streamed by one task and named when complete."""

    def write(rows):
        for (accession, number), records in groupby(rows, key=lambda r: (r.accession, r.bin)):
            os.makedirs(os.path.join(directory, accession), exist_ok=True)
            with committed(os.path.join(directory, accession, f"{number}_nr.bin")) as out:
                for r in records:
                    out.write(r.record)

    ship(counts.sparkSession)
    packed_records(counts).repartition("accession", "bin").sortWithinPartitions("accession", "bin").foreachPartition(write)


def read_vector(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(path, place, value) of files of fixed-size little-endian numbers; kind: a numpy type such as `<u4` or `<f8`.
    A trailing part of a number fails. Unsigned 64-bit values come as decimals."""
    import numpy as np
    import pyarrow as pa

    dtype = np.dtype(kind)
    wide = dtype.kind == "u" and dtype.itemsize == 8
    sql = "double" if dtype.kind == "f" else "decimal(20,0)" if wide else "bigint"
    arrow = pa.float64() if dtype.kind == "f" else pa.decimal128(20, 0) if wide else pa.int64()

    def decode(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if len(content) % dtype.itemsize:
                    raise ValueError(f"{name} ends within a value")
                values = np.frombuffer(content, dtype)
                for first in range(0, len(values), BATCH_RECORDS):
                    some = values[first : first + BATCH_RECORDS]
                    out = pa.array([Decimal(int(x)) for x in some] if wide else some.astype("f8" if dtype.kind == "f" else "i8"), arrow)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(np.arange(first, first + len(some))), out], ["path", "place", "value"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(decode, f"path string, place bigint, value {sql}")


def write_vector(path: str, values, kind: str) -> None:
    """Values as consecutive little-endian numbers, in the form that read_vector reads."""
    import numpy as np

    with committed(path) as out:
        out.write(np.asarray(values, kind).tobytes())


def import_counts(spark: SparkSession, dumps: list[str], accessions: list[str], num_bins: int = 50) -> DataFrame:
    """(accession, bin, kmer, cnt) of an external counter's text dumps, one a listed accession in the same order, in one
    scan; bins by the rolling hash of the first characters. Another number of dumps than of accessions, a name listed
    twice and two dumps of one file name raise."""
    if len(dumps) != len(accessions):
        raise ValueError(f"{len(dumps)} dumps for {len(accessions)} accessions")
    files = [os.path.basename(d) for d in dumps]
    if len(set(files)) < len(files) or len(set(accessions)) < len(accessions):
        raise ValueError("dumps need distinct file names, accessions distinct names")
    names = F.broadcast(spark.createDataFrame(list(zip(files, accessions, strict=True)), "file string, accession string")) if len(files) <= BROADCAST_FILES else spark.createDataFrame(list(zip(files, accessions, strict=True)), "file string, accession string")
    lines = spark.read.text(dumps).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "value")
    counts = _two_fields(lines, "file").join(names, "file")
    return counts.select("accession", rolling_bin_id("kmer", num_bins).alias("bin"), "kmer", "cnt")


def dump_info(counts: DataFrame) -> DataFrame:
    """(accession, k, total, least, most) of imported counts: the length of the k-mers, their number, the range of counts."""
    return counts.groupBy("accession").agg(F.max(F.length("kmer")).alias("k"), F.count(F.lit(1)).alias("total"), F.min("cnt").alias("least"), F.max("cnt").alias("most"))


def import_tars(directory: str, accessions: list[str], index: int, to: str) -> list[str]:
    """Extracts `<accession>/<index>_nr.bin` of every listed accession from the tars under `directory`;
    an accession without that member raises."""
    paths = []
    for name in dict.fromkeys(accessions):
        with tarfile.open(os.path.join(directory, f"{name}.tar")) as tar:
            tar.extract(f"{name}/{index}_nr.bin", to, filter="data")
        paths.append(os.path.join(to, name, f"{index}_nr.bin"))
    return paths


def write_parquet(counts: DataFrame, path: str) -> None:
    """Counts partitioned by bin, so that a merge of one bin reads one directory."""
    counts.write.mode("overwrite").partitionBy("bin").parquet(path)


def read_parquet(spark: SparkSession, path: str, bins: list[int] | None = None) -> DataFrame:
    counts = spark.read.parquet(path)
    return counts if bins is None else counts.where(F.col("bin").isin(bins))
