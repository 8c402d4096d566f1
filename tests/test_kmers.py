"""Hand-checked values, a brute-force model on random reads, and invariants."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandlake.config import CountConfig, MatrixConfig, bytes_to_human, estimate_bins, parse_index
from strandlake.functions import kmers as K
from strandlake.operators.counting import canonical_windows, count_kmers
from strandlake.operators.matrix import core, matrix, require_present, row_text
from strandlake.operators.refbins import intervals, interval_text, ref_index, shifted_labels

U = "ACGGTCATTGCAAGCTTAGCACGGTCATTGCAAGCTTAGCACGGTCATTGC"


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def model(reads, k):
    counts = Counter()
    for acc, seq in reads:
        for i in range(len(seq or "") - k + 1):
            w = seq[i : i + k]
            if set(w) <= set("ACGT"):
                counts[acc, min(w, rc(w))] += 1
    return {key: n % 65536 for key, n in counts.items() if key[1] != "A" * k and n % 65536 != 1}


def counted(spark, reads, **cfg):
    df = spark.createDataFrame(reads, "accession string, seq string")
    return {(r.accession, r.kmer): r.cnt for r in count_kmers(df, CountConfig(**cfg)).collect()}


@pytest.mark.parametrize(
    ("reads", "expected"),
    [
        ([U], {}),
        ([U, rc(U)], {U: 2}),
        ([U + "N" + U], {U: 2}),
        (["A" * 60, "T" * 60], {}),
        ([U.lower()] * 2, {}),
        ([U + "G"] * 2, {U: 2, "CGCAATGACCGTGCTAAGCTTGCAATGACCGTGCTAAGCTTGCAATGACCG": 2}),
        (["ACGT"] * 5, {}),
        ([None, ""], {}),
    ],
)
def test_golden_counts(spark, reads, expected):
    assert counted(spark, [("a", s) for s in reads]) == {("a", m): n for m, n in expected.items()}


@pytest.mark.parametrize(("n", "expected"), [(65537, {}), (65536, {"C" * 51: 0}), (65538, {"C" * 51: 2})])
def test_counts_wrap(spark, n, expected):
    df = spark.range(n).select(F.lit("a").alias("accession"), F.lit("C" * 51).alias("seq"))
    assert {r.kmer: r.cnt for r in count_kmers(df).collect()} == expected


def test_random_reads_match_model(spark):
    rng = random.Random(7)
    reads = [(rng.choice("xyz"), "".join(rng.choices("ACGTNa", [6, 6, 6, 6, 0.4, 0.2], k=rng.randrange(0, 90)))) for _ in range(120)]
    assert counted(spark, reads, k=5) == model(reads, 5)
    flipped = [(a, rc(s)) for a, s in reads]
    assert counted(spark, flipped, k=5) == model(reads, 5)


def test_functions(spark):
    df = spark.createDataFrame([(U,), ("C" * 51,), ("A" * 50 + "C",)], "kmer string")
    got = df.select(K.bin_id("kmer", 1500), K.bin_id("kmer", 5), K.rolling_bin_id("kmer", 50), K.kmer_hash("kmer").cast("string"), K.decode(K.encode("kmer", 51), 51)).collect()
    assert [r[0] for r in got] == [1320, 1205, 0]
    assert [r[1] for r in got] == [0, 0, 0]
    assert [r[2] for r in got][:2] == [34, 16]
    assert [r[3] for r in got][:2] == ["15800799278765263714", "17215840785511971555"]
    assert [r[4] for r in got] == [U, "C" * 51, "A" * 50 + "C"]
    cgr = spark.createDataFrame([("ACGT",), (U,)], "kmer string").select(K.cgr_key("kmer").cast("string")).collect()
    assert [r[0] for r in cgr] == ["6917529030862307328", "14256369322183837696"]
    assert spark.range(1).select(F.size(K.windows(F.lit("AC"), 3)), K.canonical(F.lit("ANC"))).first()[:] == (0, "")


def test_thresholds_and_rows(spark):
    rows = [(f"k{n}", a, 5) for n in range(1, 5) for a in "abcd"[:n]]
    counts = spark.createDataFrame([(m, a, c) for m, a, c in rows], "kmer string, accession string, cnt long")
    for t, kept in enumerate([[1, 2, 3, 4], [1, 2, 3], [2], [], [], []]):
        got = matrix(counts, list("abcd"), MatrixConfig(threshold=t)).select("occ").collect()
        assert sorted(r.occ for r in got) == kept
    assert [r.kmer for r in core(counts, list("abcd")).collect()] == ["k4"]
    one = spark.createDataFrame([("K", "a", 3), ("K", "c", 7)], "kmer string, accession string, cnt long")
    for count, delimiter, text in (("y", "tab", "K\t\t3\t0\t7\t0"), ("n", "tab", "K\t\t1\t0\t1\t0"), ("y", "none", "K\t3070"), ("n", "none", "K\t1010")):
        cfg = MatrixConfig(count=count, delimiter=delimiter)
        assert matrix(one, list("abcd"), cfg).select(row_text("kmer", "vals", cfg)).first()[0] == text
    assert MatrixConfig(threshold=1, bins=1500).directory(4) == "matrix_acc4_bins1500_minOcc1_pres-abs_delim-tab"


def test_zero_valued_record_is_an_occurrence(spark):
    counts = spark.createDataFrame([("K", "a", 0), ("K", "b", 4)], "kmer string, accession string, cnt long")
    row = matrix(counts, ["a", "b"], MatrixConfig()).first()
    assert (row.occ, row.vals) == (2, [0, 1])


def test_validation(spark):
    for bad in ({"delimiter": "space"}, {"count": "yes"}, {"index": "3a"}, {"threshold": -1}):
        with pytest.raises(ValueError):
            MatrixConfig(**bad)
    with pytest.raises(ValueError):
        parse_index("-1")
    names = spark.createDataFrame([("a",), ("b",)], "accession string")
    with pytest.raises(FileNotFoundError, match="b"):
        require_present(names.where("accession = 'a'"), names)
    assert estimate_bins(10**9, 30, 10, 370) == {"ram_gb": 10**9 * 30 * 10 * 8 / 1024**3, "bins": 7}
    assert estimate_bins(None, 30, 10, 370) is None
    assert [bytes_to_human(x) for x in (1536, 5 << 20, 12)] == ["1.5K", "5.0M", "12B"]


def test_reference_intervals(spark):
    seqs = [("c1", "x", "ACGGTCATTGCAAGC"), ("c2", "y", "ACN"), ("c3", "y", "AC")]
    index = ref_index(spark.createDataFrame(seqs, "chromosome string, accession string, seq string"), 3)
    got = {(r.chromosome, r.position): r.kmer for r in index.collect()}
    assert got == {("c1", i): min(w, rc(w)) for i in range(13) for w in [seqs[0][2][i : i + 3]]}
    out = intervals(index, 4).orderBy("interval").collect()
    assert [(r.start, r.end, len(r.kmers)) for r in out] == [(0, 3, 3), (3, 6, 3), (6, 9, 3), (9, 12, 3)]
    text = interval_text(intervals(index, 4)).where("interval = 0").first().content
    assert text.startswith("Chromosome: c1\nStart: 0\nEnd: 3\nAccessions: x \n\nK-mers:\n")


def test_windows_of_long_reads(spark):
    """Pieces of a long read give each window once, at every length around the piece's."""
    rng = random.Random(4)
    for n in (51, 52, 50 + K.STRIDE, 51 + K.STRIDE, 3 * K.STRIDE + 77, 40_000):
        seq = "".join(rng.choices("ACGT", k=n))
        got = Counter(r.kmer for r in canonical_windows(spark.createDataFrame([("a", seq)], "accession string, seq string"), 51).collect())
        both = ((seq[i : i + 51], seq[i : i + 51][::-1].translate(str.maketrans("ACGT", "TGCA"))) for i in range(n - 50))
        assert got == Counter(min(x) for x in both)


def test_strands_are_made_once_a_piece(spark):
    """The reverse complement lies below the generator of windows in the plan."""
    plan = canonical_windows(spark.createDataFrame([("a", "ACGT" * 30)], "accession string, seq string"), 51)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(sequence(1") < plan.index("reverse(translate")


def test_repeated_cells_and_gaps(spark):
    rows = [("K", "b", 5), ("K", "b", 2), ("K", "d", 1), ("L", "a", 0)]
    counts = spark.createDataFrame(rows, "kmer string, accession string, cnt bigint")
    got = {r.kmer: (r.occ, r.vals) for r in matrix(counts, list("abcde"), MatrixConfig(count="y")).collect()}
    assert got == {"K": (3, [0, 5, 0, 1, 0]), "L": (1, [0, 0, 0, 0, 0])}


def test_shifted_labels_and_invalid_windows(spark):
    records = spark.createDataFrame([(1, "c1", "x", "ACGTA"), (2, "c2", "y", "AC"), (3, "c3", "z", "ANGTA")], "n int, chromosome string, accession string, seq string")
    got = sorted(tuple(r) for r in ref_index(shifted_labels(records, "n"), 3, "poly_a").collect())
    assert got == sorted([("ACG", "c1", 0, "y"), ("ACG", "c1", 1, "y"), ("GTA", "c1", 2, "y"), ("AAA", "c3", 0, "z"), ("AAA", "c3", 1, "z"), ("GTA", "c3", 2, "z")])
