"""Sequence files, accession lists, count formats and the whole pipeline on files."""

import gzip
import io
import os
import subprocess
import sys
import tarfile
from types import SimpleNamespace

import pyarrow as pa
import pytest

from strandlake.config import CountConfig, MatrixConfig, PipelineConfig
from strandlake.operators.counting import count_kmers, with_bins
from strandlake.plans.pipeline import count_stage, merge_stage, run
from strandlake.session import BATCH_BYTES, BYTES_SETTING, shared_folder, ship
from strandlake.sources import counts as stored
from strandlake.sources.accessions import read_accession_list
from strandlake.sources.sinks import committed, write_matrix
from strandlake.sources.sequences import mates, read_accessions, read_fasta, read_fastq
from strandlake.sources.tables import document_reads
from strandlake.streaming.ingest import append_counts, stream_reads

SEQS = ["ACGGTCATTGCAAGC", "GGGTTTACGNACG", "ACGGTCATTGCAAGC", "TTTTTTTT"]


def fastq(seqs):
    return "".join(f"@r{i}\n{s}\n+\n{'@' * len(s)}\n" for i, s in enumerate(seqs)).encode()


def test_fastq_plain_gzip_and_splits(spark, tmp_path):
    plain, zipped = tmp_path / "a_1.fq", tmp_path / "a_2.fq"
    plain.write_bytes(fastq(SEQS))
    zipped.write_bytes(gzip.compress(fastq(SEQS)))  # recognised by content
    for path in (plain, zipped):
        assert sorted(r.seq for r in read_fastq(spark, [str(path)]).collect()) == sorted(SEQS)
    for size in (7, 20, 45):
        assert sorted(r.seq for r in read_fastq(spark, [str(plain)], splitBytes=size).collect()) == sorted(SEQS)
    assert {r.seq for r in read_fastq(spark, [str(plain)], maxSize=3).collect()} == {s[:3] for s in SEQS}


def test_fastq_refuses_other_input(spark, tmp_path):
    for name, content in (("empty", b""), ("text", b"hello\n"), ("fasta", b">x\nACGT\n")):
        (tmp_path / name).write_bytes(content)
        with pytest.raises(Exception, match="empty|neither|FASTA"):
            read_fastq(spark, [str(tmp_path / name)]).collect()
    broken = tmp_path / "b.fq.gz"
    broken.write_bytes(gzip.compress(fastq(SEQS * 500))[:-20])
    with pytest.raises(Exception):
        read_fastq(spark, [str(broken)]).collect()
    assert read_fastq(spark, [str(broken)], mode="PERMISSIVE").count() > 0
    assert [r.seq for r in read_fastq(spark, [str(tmp_path / "fasta")], mode="PERMISSIVE").collect()] == ["ACGT"]


def test_fasta(spark, tmp_path):
    (tmp_path / "g.fa").write_bytes(b">chr1 a description\nACGT\n\nGG\n>chr2\nTTT\r\n")
    assert [(r.name, r.seq) for r in read_fasta(spark, [str(tmp_path / "g.fa")]).collect()] == [("chr1", "ACGTGG"), ("chr2", "TTT")]


def test_accession_lists(spark, tmp_path):
    (tmp_path / "acc.txt").write_text(" a \n\n#c\nb\nb\n")
    path = str(tmp_path / "acc.txt")
    assert read_accession_list(spark, path) == ["a", "#c", "b", "b"]
    assert read_accession_list(spark, path, comment="#") == ["a", "b", "b"]
    assert read_accession_list(spark, path, verbatim=True) == [" a ", "", "#c", "b", "b"]
    (tmp_path / "none.txt").write_text("\n")
    with pytest.raises(ValueError):
        read_accession_list(spark, str(tmp_path / "none.txt"))
    with pytest.raises(FileNotFoundError, match="zz"):
        mates(str(tmp_path), "zz")


def test_packed_and_text_counts(spark, tmp_path):
    assert stored.pack("C" * 51, 7).hex() == "555555555555555555555555150000000700"
    assert stored.pack("A" * 50 + "C", 2).hex() == "010000000000000000000000000000000200"
    rows = [("a", 3, "C" * 51, 7), ("a", 3, "A" * 50 + "C", 2), ("b", 4, "G" + "ACGTT" * 10, 65535)]
    counts = spark.createDataFrame(rows, "accession string, bin int, kmer string, cnt long")
    assert {bytes(r.record) for r in stored.packed_records(counts).collect()} == {stored.pack(m, c) for _, _, m, c in rows}
    stored.write_packed(counts, str(tmp_path / "bins"))
    back = {(os.path.relpath(r.path.removeprefix("file:"), tmp_path / "bins"), r.kmer, r.cnt) for r in stored.read_packed(spark, str(tmp_path / "bins"), 51).collect()}
    assert back == {(f"{a}/{b}_nr.bin", m, c) for a, b, m, c in rows}
    assert stored.unpack(stored.pack(rows[2][2], 65535), 51) == (rows[2][2], 65535)
    stored.write_tsv(counts, str(tmp_path / "tsv"))
    assert {(r.kmer, r.cnt) for r in stored.read_tsv(spark, str(tmp_path / "tsv/accession=a/bin=3"), "a").collect()} == {(m, c) for a, _, m, c in rows if a == "a"}
    (tmp_path / "bad.tsv").write_text("ACGT 3\n")
    with pytest.raises(Exception, match="two fields"):
        stored.read_tsv(spark, str(tmp_path / "bad.tsv")).collect()
    with tarfile.open(tmp_path / "a.tar", "w") as tar:
        info = tarfile.TarInfo("a/3_nr.bin")
        info.size = 18
        tar.addfile(info, io.BytesIO(stored.pack("C" * 51, 7)))
    paths = stored.import_tars(str(tmp_path), ["a"], 3, str(tmp_path / "out"))
    assert open(paths[0], "rb").read() == stored.pack("C" * 51, 7)


def test_pipeline_writes_every_bin(spark, tmp_path):
    for name, seqs in (("a", SEQS), ("b", SEQS[:2] * 2)):
        (tmp_path / f"{name}_1.fq").write_bytes(fastq(seqs))
        (tmp_path / f"{name}_2.fastq.gz").write_bytes(gzip.compress(fastq(seqs)))
    (tmp_path / "acc.txt").write_text("a\nb\n")
    cfg = PipelineConfig(str(tmp_path), str(tmp_path / "acc.txt"), str(tmp_path / "out"), CountConfig(k=5, num_bins=3), MatrixConfig(count="y", core="y"))
    target = run(spark, cfg)["matrix_dir"]
    assert target.endswith("matrix_acc2_bins3_minOcc0_count_delim-tab")
    lines = [x for f in os.listdir(target) if f.endswith("_matrix.tsv.gz") for x in gzip.open(os.path.join(target, f), "rt").read().splitlines()]
    reads = read_accessions(spark, str(tmp_path), ["a", "b"])
    expected = {}
    for r in with_bins(count_kmers(reads, CountConfig(k=5)), 3).collect():
        expected.setdefault(r.kmer, {})[r.accession] = r.cnt
    assert sorted(lines) == sorted(f"{m}\t\t{c.get('a', 0)}\t{c.get('b', 0)}" for m, c in expected.items())
    cores = [x for f in os.listdir(target) if f.endswith("_core.txt.gz") for x in gzip.open(os.path.join(target, f), "rt").read().splitlines()]
    assert sorted(cores) == sorted(m for m, c in expected.items() if len(c) == 2)


def test_streamed_counts(spark, tmp_path):
    spark.createDataFrame([("a", s) for s in SEQS], "accession string, seq string").write.parquet(str(tmp_path / "in"))
    append_counts(stream_reads(spark, str(tmp_path / "in")), CountConfig(k=5, num_bins=2), str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
    direct = count_kmers(spark.createDataFrame([("a", s) for s in SEQS], "accession string, seq string"), CountConfig(k=5))
    assert {(r.kmer, r.cnt) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {(r.kmer, r.cnt) for r in direct.collect()}


def test_merge_uses_the_bins_of_the_store(spark, tmp_path):
    """Most bins of the store are empty: files carry the store's bin numbers, whatever the label says."""
    reads = spark.createDataFrame([("a", "ACGGTCATTGCAAGC"), ("b", "GGGTTTACGAACG")] * 2, "accession string, seq string")
    cfg = CountConfig(k=5, num_bins=1500)
    count_stage(spark, reads, ["a", "b"], cfg, str(tmp_path))
    bins = {r.kmer: r.bin for r in stored.read_parquet(spark, str(tmp_path / "counts")).collect()}
    assert 1 < len(set(bins.values())) < 1500
    one = next(iter(bins.values()))
    target = merge_stage(spark, str(tmp_path), ["a", "b"], MatrixConfig(index=one, bins=7, count="y", core="y"), str(tmp_path / "one"))
    assert os.path.basename(target).startswith("matrix_acc2_bins7_")
    assert [f for f in sorted(os.listdir(target)) if f.endswith(".gz")] == [f"{one}_matrix.tsv.gz"]
    with gzip.open(os.path.join(target, f"{one}_matrix.tsv.gz"), "rt") as f:
        assert {line.split("\t")[0] for line in f} == {m for m, b in bins.items() if b == one}
    whole = merge_stage(spark, str(tmp_path), ["a", "b"], MatrixConfig(), str(tmp_path / "all"))
    assert {int(f.split("_")[0]) for f in os.listdir(whole) if f.endswith("_matrix.tsv.gz")} == set(bins.values())
    empty = next(i for i in range(1500) if i not in bins.values())
    assert not [f for f in os.listdir(merge_stage(spark, str(tmp_path), ["a", "b"], MatrixConfig(index=empty), str(tmp_path / "none"))) if f.endswith(".gz")]
    with pytest.raises(ValueError, match="1500 bins"):
        merge_stage(spark, str(tmp_path), ["a", "b"], MatrixConfig(index=1500), str(tmp_path / "bad"))


def test_parts_of_a_bin_are_joined(spark, tmp_path):
    """A bound on the records of a file makes several parts of a bin; one file is left, with every row."""
    rows = spark.createDataFrame([(3, f"K{i}", [1], True, True) for i in range(25)], "bin int, kmer string, vals array<bigint>, in_core boolean, in_matrix boolean")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        target = write_matrix(rows, str(tmp_path), 1, MatrixConfig(core="y"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted(f for f in os.listdir(target) if not f.startswith(".")) == ["3_core.txt.gz", "3_matrix.tsv.gz"]
    with gzip.open(os.path.join(target, "3_core.txt.gz"), "rt") as f:
        assert sorted(f.read().split()) == sorted(f"K{i}" for i in range(25))


def test_fastq_names(spark, tmp_path):
    path = tmp_path / "n.fq"
    path.write_bytes(b"@first one\nACGT\n+\nIIII\n@second\n\n+\n\n")
    assert sorted((r.name, r.seq) for r in read_fastq(spark, [str(path)]).collect()) == [("first", "ACGT"), ("second", "")]
    assert sorted((r.name, r.seq) for r in read_fastq(spark, [str(path)], splitBytes=10).collect()) == [("first", "ACGT"), ("second", "")]


def test_imported_dumps(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / f"{name}.txt").write_text("ACGTACGTA\t7\nCCCCCCCCC\t65537\n")
    dumps = [str(tmp_path / "y.txt"), str(tmp_path / "x.txt")]
    found = stored.import_counts(spark, dumps, ["b", "a"])
    want = {("ACGTACGTA", 7), ("CCCCCCCCC", 1)}
    assert {(r.accession, r.kmer, r.cnt) for r in found.collect()} == {(a, *w) for a in "ab" for w in want}
    assert [tuple(r) for r in stored.dump_info(found).orderBy("accession").collect()] == [("a", 9, 2, 1, 7), ("b", 9, 2, 1, 7)]
    with pytest.raises(ValueError, match="2 dumps for 1"):
        stored.import_counts(spark, dumps, ["a"])


def test_vectors(spark, tmp_path):
    for kind, values in (("<u4", [0, 1, 2**32 - 1]), ("<u8", [2**64 - 1, 5]), ("<f8", [0.5, -2.0])):
        path = tmp_path / kind[1:]
        stored.write_vector(str(path), values, kind)
        assert [r.value for r in stored.read_vector(spark, str(path), kind).orderBy("place").collect()] == values
    (tmp_path / "odd").write_bytes(b"12345")
    with pytest.raises(Exception, match="ends within a value"):
        stored.read_vector(spark, str(tmp_path / "odd"), "<u4").collect()


def test_a_failed_writer_leaves_nothing(tmp_path):
    with pytest.raises(RuntimeError), committed(str(tmp_path / "f")) as out:
        out.write(b"half")
        raise RuntimeError
    assert os.listdir(tmp_path) == []


def test_core_queries_without_what_llm_needs():
    """A missing dependency of the training-data operators leaves the other queries."""
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); assert 'kmer_counts' in q and 'op1_bpe' not in q and 'pipeline' not in q"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0


def test_a_cluster_needs_a_shared_folder():
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, other: other), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(unset)


def test_batches_are_bounded_by_bytes(spark):
    ship(spark)
    assert spark.conf.get(BYTES_SETTING) == str(BATCH_BYTES)
    long = spark.range(0, 30, 1, 1).selectExpr("repeat('x', 1000000) AS text")
    sizes = long.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"]) for b in batches), "size bigint").collect()
    assert len(sizes) > 1 and max(r["size"] for r in sizes) < 2 * BATCH_BYTES


def test_document_reads_are_one_base_a_character(spark, tmp_path):
    """Letters by their place in the alphabet, any other character, of however many bytes, one N; nulls and empty texts stay."""
    texts = ["abcd efgh\nXYZ", "naïve 😀 ж!", "", None, "a" * 70_000, "zź\x00"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'s' AS source").repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.read_id: r.seq for r in document_reads(spark, str(tmp_path)).collect()}
    place = {c: "ACGT"[i % 4] for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")} | {" ": "A"}
    assert got == {i: t if t is None else "".join(place.get(c.lower() if c.isascii() else c, "N") for c in t) for i, t in enumerate(texts)}
    assert "translate" not in document_reads(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
