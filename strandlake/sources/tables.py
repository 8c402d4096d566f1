"""The `documents` table read as sequences, so that k-mer queries run on text tables.

Letters map onto A, C, G, T by their place in the alphabet, the space onto A; every other character
becomes N. A document is a read, its `source` (or `lang`) the accession.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.letters import one_a_character, text_of
from strandlake.session import ship

LETTERS = string.ascii_lowercase + string.ascii_uppercase + " "
MAPPED = "".join("ACGT"[i % 4] for i in range(26)) * 2 + "A"

#: What each first byte of a character becomes.
BASE_OF = np.full(256, ord("N"), "u1")
BASE_OF[list(LETTERS.encode())] = list(MAPPED.encode())


def sequences(texts: pa.Array) -> pa.Array:
    """Texts by letter, one base a character; null stays null."""
    letters, offsets = one_a_character(*text_of(texts))
    seq = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(offsets.astype("<i4")), pa.py_buffer(BASE_OF[letters])])
    return pc.if_else(texts.is_valid(), seq, None) if texts.null_count else seq


def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], sequences(batch.column("text"))], ["read_id", "accession", "seq"])


def document_reads(spark: SparkSession, sf_dir: str, accession: str = "source") -> DataFrame:
    """reads(read_id, accession, seq) of the whole table. The table may be one small file, so rows are
    dealt out over the default parallelism before windows are made of them."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("read_id"), F.col(accession).alias("accession"), "text")
    cores = spark.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() < cores:
        docs = docs.repartition(cores)
    fields = docs.schema
    return docs.mapInArrow(mapped, f"read_id {fields['read_id'].dataType.simpleString()}, accession {fields['accession'].dataType.simpleString()}, seq string")


def accession_names(spark: SparkSession, sf_dir: str, accession: str = "source") -> list[str]:
    """The accession list a run is given: distinct names in order (its length is the matrix width)."""
    names = spark.read.parquet(f"{sf_dir}/documents.parquet").select(accession).where(F.col(accession).isNotNull()).distinct()
    return sorted(r[0] for r in names.collect())
