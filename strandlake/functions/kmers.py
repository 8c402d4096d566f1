"""Column functions on k-mers. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The nucleotide alphabet in code order, its complement and base-4 digits.
BASES, COMPLEMENT, DIGITS = "ACGT", "TGCA", "0123"
# Chaos-game corners of A, C, G, T and the number of bits of a coordinate.
CORNER_X, CORNER_Y, CGR_BITS = "0011", "0110", 32
# Multipliers of the two polynomial hashes and the prefix the first one reads.
PREFIX_MULTIPLIER, PREFIX_LENGTH, LONG_MULTIPLIER = 131, 8, 31

#: Windows cut from one piece of a sequence.
STRIDE = 128

U64 = "decimal(20,0)"
WORD = 32


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reverse_complement(kmer: Column | str) -> Column:
    """Reverse complement of an ACGT string."""
    return F.reverse(F.translate(_c(kmer), BASES, COMPLEMENT))


def is_valid(kmer: Column | str) -> Column:
    """Only upper-case A, C, G, T."""
    return _c(kmer).rlike("^[ACGT]+$")


def canonical(kmer: Column | str) -> Column:
    """The smaller of a k-mer and its reverse complement; empty if any other byte occurs."""
    kmer = _c(kmer)
    return F.when(is_valid(kmer), F.least(kmer, reverse_complement(kmer))).otherwise(F.lit(""))


def valid_runs(seq: Column | str, k: int) -> Column:
    """Maximal ACGT runs of at least k bases; windows never cross another byte."""
    return F.regexp_extract_all(_c(seq), F.lit(f"([ACGT]{{{k},}})"), F.lit(1))


def windows(seq: Column | str, k: int) -> Column:
    """All substrings of length k in order; an empty array for a shorter sequence."""
    seq = _c(seq)
    n = F.length(seq)
    empty = F.array().cast("array<string>")
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(seq, i, F.lit(k)))).otherwise(empty)


def strand_pieces(seqs: DataFrame, k: int, keys: tuple[str, ...], only: Column | None = None) -> DataFrame:
    """(keys, at, forward, backward, i): a row for each window of seqs(keys, seq), seq in bytes of at least k letters.

    A sequence is cut into pieces of STRIDE windows, `at` bytes from its start. Both strands of a piece are made once
    (below the generator, as columns of their own) and each row refers to its window in them by i. only: a condition on `forward`.
    """
    cut = seqs.select(*keys, "seq", F.explode(F.sequence(F.lit(0), F.length("seq") - k, F.lit(STRIDE))).alias("at"))
    pieces = cut.select(*keys, "at", F.substring("seq", F.col("at") + 1, F.lit(STRIDE + k - 1)).alias("forward"))
    if only is not None:
        pieces = pieces.where(only)
    strands = pieces.select(*keys, "at", "forward", reverse_complement(F.col("forward").cast("string")).cast("binary").alias("backward"))
    return strands.select("*", F.explode(F.sequence(F.lit(1), F.length("forward") - k + 1)).alias("i"))


def strand_windows(k: int) -> tuple[Column, Column]:
    """The window of a row of strand_pieces on either strand."""
    forward = F.substring(F.col("forward"), F.col("i"), F.lit(k))
    backward = F.substring(F.col("backward"), F.length("backward") - F.col("i") - k + 2, F.lit(k))
    return forward.cast("string"), backward.cast("string")


def digits(kmer: Column | str) -> Column:
    return F.translate(_c(kmer), BASES, DIGITS)


def encode_word(kmer: Column | str) -> Column:
    """2 bits a base, as an unsigned 64-bit decimal; at most 32 bases."""
    return F.conv(digits(kmer), 4, 10).cast(U64)


def encode(kmer: Column | str, k: int) -> Column:
    """(hi, lo): the first k-32 bases and the last 32 (or all, when k <= 32) as unsigned 64-bit decimals."""
    kmer = _c(kmer)
    head = max(0, k - WORD)
    hi = encode_word(F.substring(kmer, 1, head)) if head else F.lit(0).cast(U64)
    return F.struct(hi.alias("hi"), encode_word(F.substring(kmer, head + 1, WORD)).alias("lo"))


def decode_word(word: Column, bases: int) -> Column:
    return F.translate(F.lpad(F.conv(word.cast("string"), 10, 4), bases, "0"), DIGITS, BASES)


def decode(code: Column | str, k: int) -> Column:
    """Inverse of encode."""
    code = _c(code)
    low = decode_word(code["lo"], min(k, WORD))
    return F.concat(decode_word(code["hi"], k - WORD), low) if k > WORD else low


def bin_id(kmer: Column | str, num_bins: int) -> Column:
    """Unsigned code of the first 32 bases (all of a shorter k-mer) modulo num_bins."""
    return (encode_word(F.substring(_c(kmer), 1, WORD)) % F.lit(num_bins).cast(U64)).cast("int")


def bin_id_lenient(kmer: Column | str, num_bins: int) -> Column:
    """As bin_id, but lower case counts as upper case and any other character as A."""
    return bin_id(F.regexp_replace(F.upper(_c(kmer)), "[^ACGT]", "A"), num_bins)


def _positions(kmer: Column, limit: int | None = None) -> Column:
    n = F.length(kmer) if limit is None else F.least(F.lit(limit), F.length(kmer))
    return F.sequence(F.lit(1), n)


def rolling_bin_id(kmer: Column | str, num_bins: int) -> Column:
    """Polynomial hash of the first 8 characters modulo num_bins."""
    kmer = _c(kmer)
    step = lambda h, i: h * F.lit(PREFIX_MULTIPLIER).cast("long") + F.ascii(F.substring(kmer, i, F.lit(1)))
    h = F.aggregate(_positions(kmer, PREFIX_LENGTH), F.lit(0).cast("long"), step)
    return F.when(F.length(kmer) == 0, F.lit(0)).otherwise((h % num_bins).cast("int"))


def shard_id(kmer: Column | str) -> Column:
    """Low 10 bits of the code: the last five bases."""
    return F.conv(digits(F.substring(_c(kmer), -5, 5)), 4, 10).cast("int")


def kmer_hash(kmer: Column | str) -> Column:
    """Direct 2-bit code up to 32 bases (lenient alphabet), else a polynomial hash modulo 2^64."""
    kmer = _c(kmer)
    short = encode_word(F.regexp_replace(F.upper(kmer), "[^ACGT]", "A"))
    modulus = F.lit(str(2**64)).cast("decimal(38,0)")
    step = lambda h, i: ((h.cast("decimal(30,0)") * F.lit(LONG_MULTIPLIER).cast("decimal(3,0)") + F.ascii(F.substring(kmer, i, F.lit(1))).cast("decimal(3,0)")) % modulus).cast(U64)
    return F.when(F.length(kmer) <= WORD, short).otherwise(F.aggregate(_positions(kmer), F.lit(0).cast(U64), step))


def hash_to_kmer(code: Column | str, k: int) -> Column:
    """Inverse of kmer_hash up to 32 bases; longer ones are named HASH_<n>."""
    code = _c(code)
    return decode_word(code, k) if k <= WORD else F.concat(F.lit("HASH_"), code.cast("string"))


def cgr_key(kmer: Column | str) -> Column:
    """Chaos-game key: both midpoint coordinates scaled to 32 bits and folded in double precision."""
    kmer = _c(kmer)
    half = F.lit(0.5)

    def walk(corners: str) -> Column:
        # Letter by letter: an expression on the whole k-mer within the lambda would be evaluated at every step.
        at = lambda i: F.translate(F.substring(kmer, i, F.lit(1)), BASES, corners).cast("int").cast("double")
        start = at(F.lit(1))
        rest = F.when(F.length(kmer) > 1, F.sequence(F.lit(2), F.length(kmer))).otherwise(F.array().cast("array<int>"))
        return F.floor(F.aggregate(rest, start, lambda v, i: (v + at(i)) * half) * F.lit(float(2**CGR_BITS)))

    folded = walk(CORNER_X).cast("double") + walk(CORNER_Y).cast("double") * F.lit(float(2**CGR_BITS))
    # A double is cast to decimal by its shortest text; its two 32-bit halves are exact as integers.
    high = F.floor(folded / F.lit(float(2**CGR_BITS)))
    low = (folded - high.cast("double") * F.lit(float(2**CGR_BITS))).cast("long")
    return high.cast("decimal(20,0)") * F.lit(2**CGR_BITS).cast("decimal(10,0)") + low.cast("decimal(20,0)")


def presence(value: Column | str) -> Column:
    return F.when(_c(value) > 0, 1).otherwise(0)
