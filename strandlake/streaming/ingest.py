"""Optional: count new reads as they arrive as files and append them to a counts table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strandlake.config import CountConfig
from strandlake.operators.counting import count_kmers, with_bins


def stream_reads(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of reads(accession, seq) that appear under `path`."""
    return spark.readStream.schema("accession string, seq string").parquet(path)


def append_counts(reads: DataFrame, cfg: CountConfig, table: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch holds whole accessions; its counts replace the partition named after the batch,
    so that a batch run again after a failure leaves the same rows."""

    def write(batch: DataFrame, number: int) -> None:
        with_bins(count_kmers(batch, cfg), cfg.num_bins).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return reads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
