"""Text outputs of the merge: `<bin>_matrix.tsv.gz` and `<bin>_core.txt.gz` in the run's directory, interval reports."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.config import MatrixConfig
from strandlake.operators.matrix import row_text
from strandlake.session import ship


def _move_into_place(spark: SparkSession, staged: str, target: str, suffix: str) -> list[str]:
    """Renames each bin's part file to `<bin><suffix>`; several parts (a session may bound the records of a file) are
    joined by part number, as gzip members may be."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = path(staged)
    fs = root.getFileSystem(conf)
    fs.mkdirs(path(target))
    names = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        folder = status.getPath().getName()
        if not folder.startswith("bin="):
            continue
        parts = sorted(p.getPath().toString() for p in fs.listStatus(status.getPath()) if p.getPath().getName().startswith("part-"))
        to = path(target, f"{folder[4:]}{suffix}")
        first = path(parts[0])
        if len(parts) > 1:
            first = path(status.getPath(), "_joined")
            out = fs.create(first, True)
            for part in parts:
                source = fs.open(path(part))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
                source.close()
            out.close()
        fs.delete(to, False)
        fs.rename(first, to)
        names.append(to.getName())
    return names


def write_matrix(rows: DataFrame, output_dir: str, accessions: int, cfg: MatrixConfig) -> str:
    """rows(bin, kmer, vals, in_core, in_matrix) -> gzip text under cfg.directory(accessions); returns that directory.

    One job writes both kinds. Rows of a bin are gathered so that each bin is one file, streamed by one task; bins are
    independent tasks. No header, no order. A repeated run replaces the files of its bins.
    """
    spark, target = rows.sparkSession, os.path.join(output_dir, cfg.directory(accessions))
    outputs = [F.when(F.col("in_matrix"), F.struct(F.lit("matrix").alias("kind"), row_text("kmer", "vals", cfg).alias("value")))]
    if cfg.core:
        outputs.append(F.when(F.col("in_core"), F.struct(F.lit("core").alias("kind"), F.col("kmer").alias("value"))))
    lines = rows.select("bin", F.explode(F.array_compact(F.array(*outputs))).alias("out")).select("out.kind", "bin", "out.value")
    staged = os.path.join(target, "_staged")
    lines.repartition("kind", "bin").write.mode("overwrite").partitionBy("kind", "bin").option("compression", "gzip").text(staged)
    for kind, suffix in (("matrix", "_matrix.tsv.gz"), ("core", "_core.txt.gz")):
        _move_into_place(spark, f"{staged}/kind={kind}", target, suffix)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return target


@contextmanager
def committed(path: str):
    """A binary file at a shared path that appears under its name only when it is complete, so that a task which is lost
    or run twice leaves no half of it."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    try:
        with open(draft, "wb") as f:
            yield f
        os.replace(draft, path)
    finally:
        if os.path.exists(draft):
            os.remove(draft)


def write_intervals(texts: DataFrame, directory: str) -> None:
    """`interval_<i>.txt` under a shared directory."""

    def write(rows):
        for r in rows:
            with committed(os.path.join(directory, f"interval_{r.interval}.txt")) as f:
                f.write(r.content.encode())

    ship(texts.sparkSession)
    os.makedirs(directory, exist_ok=True)
    texts.foreachPartition(write)
