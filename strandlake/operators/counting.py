"""Stage 1: reads -> canonical k-mer counts per accession."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.config import COUNT_MODULUS, CountConfig
from strandlake.functions import kmers as K
from strandlake.operators import pieces as P


def canonical_windows(reads: DataFrame, k: int, keys: tuple[str, ...] = ("accession",)) -> DataFrame:
    """(keys, kmer): every valid window in canonical form.

    Runs of valid bases are cut into pieces, see K.strand_pieces, so that the time is linear in the length of a
    read and a window costs two copies of k bytes. Reads that are null or shorter than k, and windows over any byte but
    ACGT, give nothing.
    """
    # Within this projection no other column is carried, so that shuffles move keys and k-mers only.
    runs = reads.where(F.length("seq") >= k).select(*keys, F.explode(K.valid_runs("seq", k)).alias("run"))
    windows = K.strand_pieces(runs.select(*keys, F.col("run").cast("binary").alias("seq")), k, keys)
    return windows.select(*keys, F.least(*K.strand_windows(k)).alias("kmer"))


def wrapped(total: Column, cfg: CountConfig) -> Column:
    return F.pmod(total, F.lit(COUNT_MODULUS)) if cfg.uint16_compat else total


def count_windows(kmers: DataFrame, cfg: CountConfig, keys: tuple[str, ...] = ("accession",)) -> DataFrame:
    """(keys, kmer, cnt) with the poly-A, wrap and singleton rules of cfg."""
    if not cfg.keep_poly_a:
        kmers = kmers.where(F.col("kmer") != "A" * cfg.k)
    counts = kmers.groupBy(*keys, "kmer").agg(F.count(F.lit(1)).alias("cnt")).withColumn("cnt", wrapped(F.col("cnt"), cfg))
    if cfg.min_filter:
        counts = counts.where(F.col("cnt") != 1) if cfg.uint16_compat else counts.where(F.col("cnt") >= 2)
    return counts


def count_rule(cfg: CountConfig):
    """The poly-A, wrap and singleton rules of cfg on arrays: counts, and which k-mers stay."""
    modulus, poly_a, singletons = COUNT_MODULUS if cfg.uint16_compat else None, cfg.keep_poly_a, not cfg.min_filter

    def rule(words, total):
        cnt = total % modulus if modulus else total
        keep = (cnt != 1) | singletons
        if not poly_a:
            keep &= sum(w != 0 for w in words) > 0
        return cnt, keep

    return rule


def count_kmers(reads: DataFrame, cfg: CountConfig = CountConfig()) -> DataFrame:
    """kmer_counts(accession, kmer, cnt) of reads(accession, seq).

    A small k has few k-mers: one exchange with map-side combine on (accession, kmer). Otherwise hardly any window is combined
    before it is shuffled, so pieces of the reads are, see strandlake.operators.pieces.
    """
    if cfg.k < P.LEAST_K:
        return count_windows(canonical_windows(reads, cfg.k), cfg)
    return P.counts(reads, cfg.k, "accession", count_rule(cfg))


def spectrum(reads: DataFrame, cfg: CountConfig = CountConfig()) -> DataFrame:
    """(accession, cnt, kmers): how many k-mers of an accession have each count, by the rules of cfg."""
    if cfg.k < P.LEAST_K:
        return count_kmers(reads, cfg).groupBy("accession", "cnt").agg(F.count(F.lit(1)).alias("kmers"))
    parts = P.spectrum(reads, cfg.k, "accession", count_rule(cfg))
    return parts.groupBy("accession", "cnt").agg(F.sum("kmers").alias("kmers"))


def with_bins(counts: DataFrame, num_bins: int) -> DataFrame:
    return counts.withColumn("bin", K.bin_id("kmer", num_bins))


def merge_counts(*parts: DataFrame, modulus: int = COUNT_MODULUS) -> DataFrame:
    """Sum of partial, unfiltered counts of the same reads' chunks; the wrap composes over partial sums."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("accession", "kmer").agg(F.pmod(F.sum("cnt"), F.lit(modulus)).alias("cnt"))


def count_genomes(records: DataFrame, k: int) -> DataFrame:
    """Assembly records: nothing is filtered but invalid windows; counts still wrap."""
    return count_kmers(records, CountConfig(k=k, min_filter=False, keep_poly_a=True))


def chunk_document_frequency(reads: DataFrame, k: int, chunk: Column) -> DataFrame:
    """(kmer, chunks): in how many chunks of reads each canonical k-mer occurs."""
    windows = canonical_windows(reads.withColumn("chunk", chunk), k, ("chunk",))
    return windows.distinct().groupBy("kmer").agg(F.count(F.lit(1)).alias("chunks"))
