"""Pieces of sequences: all windows, each once, in groups that hold every copy of a k-mer; and what queries shuffle."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandlake.config import CountConfig
from strandlake.operators import pieces as P
from strandlake.operators import refbins as R
from strandlake.operators.counting import count_kmers, spectrum


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def some_reads(rng, n, longest=200):
    base = "".join(rng.choices("ACGT", k=300))
    out = []
    for _ in range(n):
        a = rng.randrange(200)
        s = base[a : a + rng.randrange(100)] if rng.random() < 0.6 else "".join(rng.choices("ACGTN", [9, 9, 9, 9, 0.3], k=rng.randrange(longest)))
        out.append((rng.choice(["x", None, "y"]), rng.choice([s, rc(s.replace("N", "A")), "A" * 90]) if rng.random() < 0.3 else s))
    return out


def windows(reads, k):
    return Counter((a, min(w, rc(w))) for a, s in reads for i in range(len(s) - k + 1) for w in [s[i : i + k]] if set(w) <= set("ACGT"))


@pytest.mark.parametrize("k", [13, 21, 31, 33, 39, 51, 63, 65, 71])
def test_pieces_hold_each_window_once(monkeypatch, k):
    """At every size of slices, pieces, chunks and batches; groups that go over the end of a chunk included."""
    rng = random.Random(k)
    for _ in range(8):
        monkeypatch.setattr(P, "LONGEST", rng.choice([3, 50, 4096]))
        monkeypatch.setattr(P, "SLICE", rng.choice([70, 500, 1 << 21]))
        monkeypatch.setattr(P, "CHUNK", rng.choice([1, 250, 1 << 20]))
        reads = some_reads(rng, 40)
        rows = []
        for row, bins, at, pieces in P.cut(*P.text_of(pa.array([s for _, s in reads])), k):
            codes, starts, sizes = P.unpacked(pieces)
            for r, b, p, x, start, size in zip(row, bins, at, pieces.to_pylist(), starts, sizes, strict=True):
                assert reads[r][1][p : p + size] == P.LETTERS[codes[start : start + size]].tobytes().decode()
                rows.append((reads[r][0], int(b), x, 1))
        rows.sort(key=lambda r: (r[0] is not None, r[0] or "", r[1]))
        step = rng.choice([1, 7, 1000])
        kind = pa.schema([("accession", pa.string()), ("bin", pa.int64()), ("piece", pa.binary()), ("n", pa.int64())])
        batches = (pa.RecordBatch.from_pylist([dict(zip(kind.names, r, strict=True)) for r in rows[i : i + step]], kind) for i in range(0, len(rows), step))
        got = Counter()
        for names, group, words, total in P.counted(batches, k, ["accession", "bin"]):
            accessions = names.column("accession").to_pylist()
            for g, m, t in zip(group, P.kmer_text(words, k).to_pylist(), total, strict=True):
                assert (accessions[g], m) not in got
                got[accessions[g], m] = int(t)
        assert got == windows(reads, k)


def test_rows_that_agree_in_the_first_column_only():
    order, begins = P.in_order([P.np.array(x, "u8") for x in ([5, 1, 5, 5, 1], [2, 0, 1, 2, 0], [7, 3, 7, 7, 4])])
    got = [sorted(x.tolist()) for x in P.np.split(order, begins[1:])]
    assert sorted(got) == [[0, 3], [1], [2], [4]]


@pytest.mark.parametrize("k", [11, 21, 51])
def test_counts_equal_windows(spark, k):
    reads = some_reads(random.Random(k), 300)
    df = spark.createDataFrame(reads, "accession string, seq string").repartition(3)
    got = {(r.accession, r.kmer): r.cnt for r in count_kmers(df, CountConfig(k=k, uint16_compat=False, min_filter=False, keep_poly_a=True)).collect()}
    assert got == windows(reads, k)
    assert {(r.accession, r.kmer): r.cnt for r in count_kmers(df, CountConfig(k=k)).collect()} == {x: n for x, n in got.items() if n != 1 and x[1] != "A" * k}


def shuffled(df):
    """Bytes that the exchanges of an executed plan have written."""
    df.collect()
    plan, out = [df._jdf.queryExecution().executedPlan()], 0
    while plan:
        node = plan.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            plan.append(node.executedPlan())
        elif name in ("ShuffleQueryStage", "TableCacheQueryStage", "ResultQueryStage"):
            plan.append(node.plan())
        else:
            if name == "Exchange":
                out += node.metrics().apply("shuffleBytesWritten").value()
            plan.extend(node.children().apply(i) for i in range(node.children().size()))
    return out


def test_counting_shuffles_less_than_its_windows(spark):
    """Different windows: their letters were shuffled before, 51 bytes and keys each."""
    rng = random.Random(3)
    reads = spark.createDataFrame([("a", "".join(rng.choices("ACGT", k=5000))) for _ in range(100)], "accession string, seq string")
    assert 0 < shuffled(count_kmers(reads).select("kmer")) < 4 * 100 * 4950


def reference(rng):
    """Chromosomes with other letters, one in two records, one without a name, and one that is too short."""
    rows = [(f"c{i % 9}" if i != 4 else None, "x", s) for i, (_, s) in enumerate(some_reads(rng, 18, 400))]
    return [*rows, ("c1", "y", "é😀" + rows[1][2] + "é" + "ACGGT" * 30), ("short", "x", "ACGT")]


@pytest.mark.parametrize("part", [1 << 22, 100])
def test_chromosomes_equal_the_index(spark, monkeypatch, part):
    """Also where a chromosome's k-mers are dealt out, and its records differ in length."""
    monkeypatch.setattr(R, "PART", part)
    records = spark.createDataFrame(reference(random.Random(5)), "chromosome string, accession string, seq string").repartition(4)
    index = R.ref_index(records, 21).groupBy("chromosome").agg(F.count(F.lit(1)).alias("positions"), F.countDistinct("kmer").alias("kmers"), F.sum("position").alias("position_sum"))
    assert sorted(map(str, R.chromosomes(records, 21).collect())) == sorted(map(str, index.collect()))


def test_chromosomes_shuffle_less_than_their_windows(spark):
    """Different windows: each was shuffled with its chromosome before."""
    rng = random.Random(3)
    records = spark.createDataFrame([(f"c{i}", "a", "".join(rng.choices("ACGT", k=5000))) for i in range(100)], "chromosome string, accession string, seq string")
    assert 0 < shuffled(R.chromosomes(records, 51)) < 4 * 100 * 4950


def test_located_equal_the_index(spark):
    """One k-mer twice, one that is not in canonical form, one of another length, and some that are nowhere."""
    records = spark.createDataFrame(reference(random.Random(6)), "chromosome string, accession string, seq string").repartition(4)
    index = R.ref_index(records, 21)
    some = sorted({r.kmer for r in index.collect()})[::3]
    kmers = spark.createDataFrame([(m,) for m in [*some, some[0], rc(some[1]), some[2][:20], "ACGTT" * 4 + "A", None]], "kmer string").repartition(3)
    columns = ["kmer", "chromosome", "position", "accession"]
    got = R.locate_in(kmers, records, 21).select(columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, R.locate(kmers, index).select(columns).collect()))


@pytest.mark.parametrize("chunk", [1, 80])
def test_groups_over_the_end_of_a_chunk(monkeypatch, chunk):
    """Placed pieces come in chunks that end anywhere in a group."""
    monkeypatch.setattr(P, "CHUNK", chunk)
    records = [r for r in reference(random.Random(7)) if r[0]]
    table = pa.table({"chromosome": [r[0] for r in records], "seq": [r[2] for r in records]})
    rows = []
    for row, bins, at, pieces in P.cut(*P.one_a_character(*P.text_of(table.column("seq"))), 21):
        rows += [{"chromosome": records[r][0], "bin": int(b), "at": int(a), "piece": x} for r, b, a, x in zip(row, bins, at, pieces.to_pylist(), strict=True)]
    index = [(min(w, rc(w)), c, i) for c, _, s in records for i in range(len(s) - 20) for w in [s[i : i + 21]] if set(w) <= set("ACGT")]
    kind = pa.schema([("placed", pa.bool_()), ("chromosome", pa.string()), ("bin", pa.int64()), ("at", pa.int64()), ("piece", pa.binary())])
    batches = lambda rows: (pa.RecordBatch.from_pylist(rows[i : i + 3], kind) for i in range(0, len(rows), 3))

    parts = Counter()
    for b in P.summarised(batches(sorted(rows, key=lambda r: (r["chromosome"], r["bin"]))), 21, "chromosome"):
        for r in b.to_pylist():
            parts.update({(r["chromosome"], c): r[c] for c in ("positions", "kmers", "position_sum")})
    for c in {x[1] for x in index}:
        own = [x for x in index if x[1] == c]
        assert [parts[c, n] for n in ("positions", "kmers", "position_sum")] == [len(own), len({x[0] for x in own}), sum(x[2] for x in own)]

    some = sorted({x[0] for x in index})[::2]
    wanted = [{"bin": int(b), "at": 0, "piece": x, "placed": False} for _, bins, _, pieces in P.cut(*P.text_of(pa.array(some)), 21) for b, x in zip(bins, pieces.to_pylist(), strict=True)]
    both = sorted([*wanted, *({**r, "placed": True} for r in rows)], key=lambda r: (r["bin"], r["placed"]))
    got = Counter((r["kmer"], r["chromosome"], r["position"]) for b in P.matches(batches(both), 21, ["chromosome"]) for r in b.to_pylist())
    assert got == Counter(x for x in index if x[0] in set(some))


@pytest.mark.parametrize("k", [11, 21])
def test_spectrum_equals_windows(spark, k):
    reads = some_reads(random.Random(k), 200)
    df = spark.createDataFrame(reads, "accession string, seq string").repartition(3)
    every = CountConfig(k=k, uint16_compat=False, min_filter=False, keep_poly_a=True)
    assert {(r.accession, r.cnt): r.kmers for r in spectrum(df, every).collect()} == Counter((a, n) for (a, _), n in windows(reads, k).items())


def test_spectrum_keeps_kmers_in_their_task(spark):
    """Only pieces and a few sums are shuffled."""
    rng = random.Random(3)
    reads = spark.createDataFrame([("a", "".join(rng.choices("ACGT", k=5000))) for _ in range(100)], "accession string, seq string")
    assert 0 < shuffled(spectrum(reads, CountConfig(uint16_compat=False, min_filter=False, keep_poly_a=True))) < 4 * 100 * 4950
