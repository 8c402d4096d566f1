"""Command line: `python -m strandlake.cli count|merge|run|estimate ...`."""

from __future__ import annotations

import argparse
import json

from strandlake.config import CountConfig, MatrixConfig, PipelineConfig, estimate_bins


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandlake", description="k-mer x accession matrices on Spark")
    sub = top.add_subparsers(dest="command", required=True)
    count = sub.add_parser("count", help="reads -> k-mer counts")
    merge = sub.add_parser("merge", help="k-mer counts -> matrix")
    whole = sub.add_parser("run", help="both stages")
    for p in (count, whole):
        p.add_argument("--reads", required=True)
        p.add_argument("--k", type=int, default=51)
        p.add_argument("--num-bins", type=int, default=1500)
    for p in (merge, whole):
        p.add_argument("--threshold", type=int, default=0, help="keep k-mers in at least T and at most N-T accessions")
        p.add_argument("--delimiter", choices=["tab", "none"], default="tab")
        p.add_argument("--count", choices=["y", "n"], default="n", help="counts instead of presence")
        p.add_argument("--core", choices=["y", "n"], default="n", help="also list k-mers found in every accession")
        p.add_argument("--row-format", choices=["standard", "single_tab"], default="standard", help="single_tab: no tab of its own after the k-mer")
        p.add_argument("--on-missing", choices=["fail", "zero"], default="fail", help="an accession that was never counted")
        p.add_argument("--bins", type=int, default=0, help="label of the output directory")
    merge.add_argument("--input", required=True)
    merge.add_argument("--index", help="this bin only")
    for p in (count, merge, whole):
        p.add_argument("--accessions", required=True)
        p.add_argument("--output", required=True)
    est = sub.add_parser("estimate", help="memory without binning, and bins that fit")
    for name in ("genome-size", "depth", "accessions"):
        est.add_argument(f"--{name}", type=int, required=True)
    est.add_argument("--ram-gb", type=float, required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "estimate":
        print(json.dumps(estimate_bins(a.genome_size, a.depth, a.accessions, a.ram_gb)))
        return 0
    from pyspark.sql import SparkSession

    from strandlake.plans import pipeline
    from strandlake.sources.accessions import read_accession_list
    from strandlake.sources.sequences import read_accessions

    if a.command != "count":
        settings = MatrixConfig(a.threshold, a.delimiter, a.count, a.core, a.bins, getattr(a, "index", None), a.row_format, a.on_missing)
    spark = SparkSession.builder.appName("strandlake").getOrCreate()
    if a.command == "run":
        cfg = PipelineConfig(a.reads, a.accessions, a.output, CountConfig(k=a.k, num_bins=a.num_bins), settings)
        print(json.dumps(pipeline.run(spark, cfg)))
        return 0
    names = read_accession_list(spark, a.accessions, verbatim=a.command == "merge")
    if a.command == "count":
        pipeline.count_stage(spark, read_accessions(spark, a.reads, names), names, CountConfig(k=a.k, num_bins=a.num_bins), a.output)
    else:
        print(pipeline.merge_stage(spark, a.input, names, settings, a.output))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
