"""Reference-ordered binning: where canonical k-mers lie on chromosomes, and equal intervals of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions import kmers as K
from strandlake.operators import pieces as P

#: Letters of a chromosome whose k-mers are told apart in one group; the k-mers of a longer one are dealt out by minimizer.
PART = 1 << 22


def ref_index(records: DataFrame, k: int, invalid: str = "drop") -> DataFrame:
    """(kmer, chromosome, position, accession) of records(chromosome, accession, seq), 0-based.

    invalid: windows over other bytes are dropped, or with "poly_a" indexed as the all-A k-mer.
    A chromosome shorter than k gives nothing.
    """
    if invalid not in ("drop", "poly_a"):
        raise ValueError("invalid must be 'drop' or 'poly_a'")
    names = ("chromosome", "accession")
    # One letter a character, so that positions are byte offsets.
    usable = records.where(F.length("seq") >= k).select(*names, F.regexp_replace("seq", "[^ACGT]", "N").cast("binary").alias("seq"))
    some = F.col("forward").cast("string").rlike(f"[ACGT]{{{k}}}") if invalid == "drop" else None
    windows = K.strand_pieces(usable, k, names, some)
    forward, backward = K.strand_windows(k)
    valid, kmer = ~F.contains(forward, F.lit("N")), F.least(forward, backward)
    if invalid == "drop":
        windows = windows.where(valid)
    else:
        kmer = F.when(valid, kmer).otherwise(F.lit("A" * k))
    position = F.col("at").cast("long") + F.col("i") - 1
    return windows.select(kmer.alias("kmer"), "chromosome", position.alias("position"), "accession")


def shifted_labels(records: DataFrame, number: str) -> DataFrame:
    """records with the accession of the record that follows, as an index that renames the sequence before it is filed does;
    the last one keeps its own. `number` counts records consecutively."""
    following = records.select((F.col(number) - 1).alias(number), F.col("accession").alias("following"))
    return records.join(following, number, "left").withColumn("accession", F.coalesce("following", "accession")).drop("following")


def locate(kmers: DataFrame, index: DataFrame) -> DataFrame:
    """All positions of each k-mer (one to many)."""
    return kmers.join(index, "kmer")


def locate_in(kmers: DataFrame, records: DataFrame, k: int) -> DataFrame:
    """As locate over the index of records(.., seq), (kmer, other columns, position), without making the index: pieces of the records
    meet the k-mers of their minimizer. k is P.LEAST_K at least."""
    canonical = kmers.where(F.col("kmer") == K.canonical("kmer"))
    return P.located(canonical, P.placed_pieces(records, k), k)


def chromosomes(records: DataFrame, k: int) -> DataFrame:
    """(chromosome, positions, kmers, position_sum): windows of records(chromosome, seq), how many different k-mers, and their places added up;
    no row for a chromosome without any. k is P.LEAST_K at least."""
    records = records.select("chromosome", "seq")
    total = records.groupBy("chromosome").agg(F.sum(F.length("seq")).alias("letters"))
    # At most one name for each PART letters of the input.
    long = total.where(F.col("letters") > PART).select(F.col("chromosome").alias("name"), (1 + F.expr(f"letters div {PART}")).cast("long").alias("many"))
    parted = records.join(F.broadcast(long), F.col("chromosome").eqNullSafe(F.col("name")), "left").select("chromosome", "seq", F.coalesce("many", F.lit(1)).cast("long").alias("parts"))
    return P.summaries(P.placed_pieces(parted, k, "parts"), k, "chromosome").groupBy("chromosome").agg(*(F.sum(c).alias(c) for c in ("positions", "kmers", "position_sum")))


def with_intervals(index: DataFrame, num_bins: int) -> DataFrame:
    """Adds bin, start and end. A chromosome's length is its largest position L, intervals are L div
    num_bins wide, the last ends at L exclusive, so the k-mer at L itself is left out."""
    length = index.groupBy("chromosome").agg(F.max("position").alias("length"))
    size = F.expr(f"length div {num_bins}")
    last = F.lit(num_bins - 1).cast("long")
    binned = index.join(length, "chromosome").where(F.col("position") < F.col("length")).withColumn("size", size)
    number = F.when(F.col("size") == 0, last).otherwise(F.least(F.expr("position div nullif(size, 0)"), last))
    out = binned.withColumn("bin", number.cast("int"))
    end = F.when(F.col("bin") == num_bins - 1, F.col("length")).otherwise((F.col("bin") + 1) * F.col("size"))
    return out.withColumn("start", F.col("bin") * F.col("size")).withColumn("end", end).drop("size", "length")


def intervals(index: DataFrame, num_bins: int) -> DataFrame:
    """(interval, chromosome, bin, start, end, kmers, accessions): non-empty intervals numbered by
    (chromosome, bin); kmers in position order with repeats, accessions as a sorted set."""
    grouped = with_intervals(index, num_bins).groupBy("chromosome", "bin", "start", "end").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "kmer"))), lambda x: x["kmer"]).alias("kmers"),
        F.sort_array(F.collect_set("accession")).alias("accessions"),
    )
    # Numbered without their k-mers: at most chromosomes x num_bins narrow rows meet in one task.
    places = with_intervals(index, num_bins).select("chromosome", "bin").distinct()
    numbers = places.withColumn("interval", F.row_number().over(Window.orderBy("chromosome", "bin")) - 1)
    return grouped.join(numbers, ["chromosome", "bin"])


def interval_text(df: DataFrame) -> DataFrame:
    """(interval, content): the text report of each interval."""
    lines = F.concat(F.lit("Chromosome: "), F.col("chromosome"), F.lit("\nStart: "), F.col("start").cast("string"), F.lit("\nEnd: "), F.col("end").cast("string"), F.lit("\nAccessions: "), F.concat_ws("", F.transform("accessions", lambda a: F.concat(a, F.lit(" ")))), F.lit("\n\nK-mers:\n"), F.concat_ws("", F.transform("kmers", lambda m: F.concat(m, F.lit("\n")))))
    return df.select("interval", lines.alias("content"))
