"""Both stages as one run: reads -> stored counts -> matrix and core files."""

from __future__ import annotations

import logging
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.config import CountConfig, MatrixConfig, PipelineConfig
from strandlake.functions.kmers import bin_id
from strandlake.operators.counting import count_kmers, with_bins
from strandlake.operators.matrix import matrix_and_core, require_present
from strandlake.sources import counts as stored
from strandlake.sources.accessions import read_accession_list
from strandlake.sources.sequences import read_accessions
from strandlake.sources.sinks import write_matrix

log = logging.getLogger(__name__)


def count_stage(spark: SparkSession, reads: DataFrame, accessions: list[str], cfg: CountConfig, output: str) -> None:
    """Counts of all accessions in one job, stored by bin, with a manifest of what was ingested (an
    accession without any k-mer is still listed) and of the number of bins, of which some may be empty."""
    stored.write_parquet(with_bins(count_kmers(reads, cfg), cfg.num_bins), os.path.join(output, "counts"))
    names = spark.createDataFrame([(a, cfg.k, cfg.num_bins) for a in dict.fromkeys(accessions)], "accession string, k int, num_bins int")
    names.coalesce(1).write.mode("overwrite").parquet(os.path.join(output, "manifest"))


def merge_stage(spark: SparkSession, store: str, accessions: list[str], cfg: MatrixConfig, output: str) -> str:
    """Matrix (and core) of the stored counts, in the bins of the store; cfg.bins is only the directory's label.
    cfg.index: that bin only, by partition pruning; a bin without k-mers gives no file, one beyond the store's raises.
    on_missing: "fail" raises for an accession that was never counted, "zero" leaves its column zero."""
    manifest = spark.read.parquet(os.path.join(store, "manifest"))
    if cfg.on_missing == "fail":
        require_present(manifest, spark.createDataFrame([(a,) for a in accessions], "accession string"))
    bins = manifest.agg(F.max("num_bins")).first()[0]
    if cfg.index is not None and cfg.index >= bins:
        raise ValueError(f"bin {cfg.index} of a store of {bins} bins")
    counts = stored.read_parquet(spark, os.path.join(store, "counts"), None if cfg.index is None else [cfg.index])
    rows = matrix_and_core(counts.select("accession", "kmer", F.col("cnt")), accessions, cfg)
    return write_matrix(rows.withColumn("bin", bin_id("kmer", bins)), output, len(accessions), cfg)


def run(spark: SparkSession, cfg: PipelineConfig) -> dict:
    began = time.time()
    accessions = read_accession_list(spark, cfg.accessions_file)
    reads = read_accessions(spark, cfg.reads_dir, accessions)
    store = os.path.join(cfg.output_dir, "kmer_counts")
    count_stage(spark, reads, accessions, cfg.counting, store)
    merge = cfg.matrix if cfg.matrix.bins else MatrixConfig(**{**cfg.matrix.__dict__, "bins": cfg.counting.num_bins})
    target = merge_stage(spark, store, accessions, merge, cfg.output_dir)
    summary = {"accessions": len(accessions), "matrix_dir": target, "seconds": round(time.time() - began, 1)}
    log.info("done: %s", summary)
    return summary
