"""Accession lists: one name a line, in column order."""

from __future__ import annotations

from pyspark.sql import SparkSession


def read_accession_list(spark: SparkSession, path: str, verbatim: bool = False, comment: str | None = None) -> list[str]:
    """Names in file order. By default lines are trimmed and blank ones dropped; verbatim keeps every
    line as it is; comment drops lines that begin with it. An empty list raises."""
    content = spark.read.text(path, wholetext=True).collect()  # one small file
    lines = [line for row in content for line in row[0].split("\n")]
    if lines and lines[-1] == "":
        lines.pop()
    if not verbatim:
        lines = [x.strip() for x in lines if x.strip()]
    if comment:
        lines = [x for x in lines if not x.startswith(comment)]
    if not lines:
        raise ValueError(f"{path} names no accession")
    return lines
