"""Stage 2: kmer_counts -> k-mer x accession matrix, core list and statistics."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.config import MatrixConfig

#: An accession list longer than this is joined by a shuffle instead of a broadcast.
BROADCAST_ACCESSIONS = 100_000


def accession_frame(spark: SparkSession, accessions: list[str]) -> DataFrame:
    """(acc_index, accession) in list order; a repeated name is a column of its own."""
    if not accessions:
        raise ValueError("the accession list is empty")
    return spark.createDataFrame(list(enumerate(accessions)), "acc_index int, accession string")


def require_present(counts_manifest: DataFrame, accessions: DataFrame) -> None:
    """Raise, naming up to ten accessions without an entry in manifest(accession)."""
    missing = [r[0] for r in accessions.join(counts_manifest, "accession", "left_anti").select("accession").distinct().orderBy("accession").take(10)]
    if missing:
        raise FileNotFoundError(f"no counts for accessions: {', '.join(missing)}")


def indexed(counts: DataFrame, accessions: list[str]) -> DataFrame:
    """(kmer, acc_index, cnt): counts of the listed accessions by column position.

    The list is a driver-side parameter with one entry a matrix column; it is broadcast up to
    BROADCAST_ACCESSIONS names and left to a shuffled join beyond.
    """
    names = accession_frame(counts.sparkSession, accessions)
    if len(accessions) <= BROADCAST_ACCESSIONS:
        names = F.broadcast(names)
    return counts.join(names, "accession").select("kmer", "acc_index", "cnt")


def occurrences(long: DataFrame) -> DataFrame:
    """(kmer, occ, cells): number of records (not of positive values) and the sparse row in column order."""
    return long.groupBy("kmer").agg(F.count(F.lit(1)).alias("occ"), F.array_sort(F.collect_list(F.struct("acc_index", "cnt"))).alias("cells"))


def band(occ: Column | str, n: int, threshold: int) -> Column:
    """Symmetric occurrence band: threshold <= occ <= n - threshold."""
    occ = F.col(occ) if isinstance(occ, str) else occ
    return (occ >= threshold) & (occ <= n - threshold)


def dense_values(cells: Column, n: int, count: bool) -> Column:
    """n values from cells(acc_index, cnt) in column order: zeros fill the gaps between them. Of repeated cells of a
    column the one with the largest count stays."""
    zero = F.lit(0).cast("long")
    value = lambda c: c["cnt"] if count else F.when(c["cnt"] > 0, 1).otherwise(0).cast("long")
    index = lambda i: F.coalesce(F.get(cells, i)["acc_index"], F.lit(-1))
    # A repeat count below one gives no zeros.
    own = lambda c, i: F.when(index(i + 1) != c["acc_index"], F.array(value(c))).otherwise(F.array().cast("array<bigint>"))
    parts = F.transform(cells, lambda c, i: F.concat(F.array_repeat(zero, c["acc_index"] - index(i - 1) - 1), own(c, i)))
    rest = F.array_repeat(zero, F.lit(n - 1) - F.coalesce(F.try_element_at(cells, F.lit(-1))["acc_index"], F.lit(-1)))
    return F.concat(F.flatten(parts), rest)


def matrix(counts: DataFrame, accessions: list[str], cfg: MatrixConfig = MatrixConfig()) -> DataFrame:
    """(kmer, occ, vals): dense rows within the occurrence band, values in accession order."""
    n = len(accessions)
    rows = occurrences(indexed(counts, accessions)).where(band("occ", n, cfg.threshold))
    return rows.select("kmer", "occ", dense_values(F.col("cells"), n, cfg.count).alias("vals"))


def core(counts: DataFrame, accessions: list[str]) -> DataFrame:
    """(kmer): present in every accession; the band does not apply."""
    n = len(accessions)
    return indexed(counts, accessions).groupBy("kmer").agg(F.count(F.lit(1)).alias("occ")).where(F.col("occ") == n).select("kmer")


def matrix_and_core(counts: DataFrame, accessions: list[str], cfg: MatrixConfig) -> DataFrame:
    """One aggregate for both outputs: (kmer, occ, vals, in_core, in_matrix)."""
    n = len(accessions)
    rows = occurrences(indexed(counts, accessions))
    flags = rows.select("kmer", "occ", dense_values(F.col("cells"), n, cfg.count).alias("vals"), (F.col("occ") == n).alias("in_core"), band("occ", n, cfg.threshold).alias("in_matrix"))
    return flags.where("in_core or in_matrix")


def row_text(kmer: Column | str, vals: Column | str, cfg: MatrixConfig) -> Column:
    """Text of a row. Standard: k-mer, tab, then separator and value for each accession (so `tab`
    puts two tabs after the k-mer); single_tab: no tab of its own after the k-mer."""
    kmer = F.col(kmer) if isinstance(kmer, str) else kmer
    vals = F.col(vals) if isinstance(vals, str) else vals
    cells = F.array_join(F.transform(vals, lambda v: F.concat(F.lit(cfg.separator), v.cast("string"))), "")
    return F.concat(kmer, F.lit("" if cfg.row_format == "single_tab" else "\t"), cells)


def wide(counts: DataFrame, accessions: list[str]) -> DataFrame:
    """One column an accession, zero-filled; for small lists without repeated names."""
    if max(Counter(accessions).values()) > 1:
        raise ValueError("a wide matrix needs distinct accession names")
    return counts.groupBy("kmer").pivot("accession", accessions).agg(F.first("cnt")).fillna(0)


def sparse(counts: DataFrame, accessions: list[str]) -> DataFrame:
    """(kmer, total, row): non-zero cells as `index:count` in index order; empty keys and zero counts are skipped."""
    long = indexed(counts.where((F.col("kmer") != "") & (F.col("cnt") != 0)), accessions)
    cells = F.array_sort(F.collect_list(F.struct("acc_index", "cnt")))
    text = F.array_join(F.transform(cells, lambda c: F.concat_ws(":", c["acc_index"].cast("string"), c["cnt"].cast("string"))), ",")
    return long.groupBy("kmer").agg(F.sum("cnt").alias("total"), text.alias("row"))


def occurrence_histogram(counts: DataFrame) -> DataFrame:
    """(occ, kmers, total): distinct k-mers and their summed counts by number of accessions."""
    per = counts.groupBy("kmer").agg(F.count(F.lit(1)).alias("occ"), F.sum("cnt").alias("total"))
    return per.groupBy("occ").agg(F.count(F.lit(1)).alias("kmers"), F.sum("total").alias("total"))


def merge_stats(counts: DataFrame, accessions: list[str], threshold: int) -> DataFrame:
    """One row: records read, distinct k-mers, core, filtered out, written."""
    n = len(accessions)
    per = indexed(counts, accessions).groupBy("kmer").agg(F.count(F.lit(1)).alias("occ"))
    inside = band("occ", n, threshold).cast("long")
    one = F.lit(1).cast("long")
    return per.agg(
        F.coalesce(F.sum("occ"), F.lit(0)).alias("records"),
        F.count(F.lit(1)).alias("kmers"),
        F.coalesce(F.sum((F.col("occ") == n).cast("long")), F.lit(0)).alias("core"),
        F.coalesce(F.sum(one - inside), F.lit(0)).alias("filtered"),
        F.coalesce(F.sum(inside), F.lit(0)).alias("written"),
    )


def accession_loads(counts: DataFrame) -> DataFrame:
    return counts.groupBy("accession").agg(F.count(F.lit(1)).alias("kmers"), F.sum("cnt").alias("total"))


def threshold_sweep(counts: DataFrame, accessions: list[str]) -> DataFrame:
    """(threshold, kept) for 0..n from one occurrence histogram."""
    n = len(accessions)
    hist = indexed(counts, accessions).groupBy("kmer").agg(F.count(F.lit(1)).alias("occ")).groupBy("occ").agg(F.count(F.lit(1)).alias("kmers"))
    # The histogram has at most n rows; every threshold is matched against it by an expanded list.
    kept = hist.select("kmers", "occ", F.explode(F.sequence(F.lit(0), F.lit(n))).alias("threshold"))
    inside = (F.col("occ") >= F.col("threshold")) & (F.col("occ") <= n - F.col("threshold"))
    return kept.groupBy("threshold").agg(F.sum(F.when(inside, F.col("kmers")).otherwise(0)).alias("kept"))


def hashed_matrix(counts: DataFrame, accessions: list[str], kmer_hash: Column) -> DataFrame:
    """(hash, occ, vals) keyed by a k-mer hash: colliding k-mers share a row, the largest value of an
    accession stays, every record counts in occ."""
    n = len(accessions)
    long = indexed(counts, accessions).withColumn("hash", kmer_hash)
    cell = long.groupBy("hash", "acc_index").agg(F.max("cnt").alias("cnt"), F.count(F.lit(1)).alias("records"))
    rows = cell.groupBy("hash").agg(F.sum("records").alias("occ"), F.array_sort(F.collect_list(F.struct("acc_index", "cnt"))).alias("cells"))
    return rows.select("hash", "occ", dense_values(F.col("cells"), n, True).alias("vals"))
