"""From raw documents to token counts: language ID, near-duplicate removal, repeated-substring removal, benchmark
decontamination and tokenising, each stage on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import bpe, decontam, jaccard, langid, sadedup
from strandlake.llm.settle import settle
from strandlake.session import ship

#: The stages have no SQL form: profiles, similarity classes and byte-level merges are iterative.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter; sets lang to the identified language of the others.

    Null and empty texts are rejected. Documents without an id or lang take part; repeated rows stay; other columns come
    back as they are; an empty table gives an empty table.
    """
    ship(spark)
    trained = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2, F.lit(True))
    profiles = langid.learn(docs.where(trained))
    return langid.identify_rows(docs, profiles, "lang").where(F.col("lang") != langid.UNDETERMINED)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each class of near duplicates.

    Null and empty texts all stay, repeated ones too; of other repeated rows one stays; a null id comes last. Other
    columns, whatever their names, come back as they are; an empty table gives an empty table.
    """
    ship(spark)
    return jaccard.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that occur elsewhere too out of the texts: runs of repeated 200-byte strings that hold 50 words or
    400 bytes; partial characters at a cut go as well.

    All rows stay: a null text is null, an empty one empty, a repeated row of such a length loses what its copies hold too.
    n_chars is set anew, other columns come back as they are; an empty table gives an empty table.
    """
    ship(spark)
    return sadedup.cut_rows(docs, length=sadedup.PASSAGE, words=sadedup.WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item.

    Null and empty texts, null ids and repeated rows stay unless they hold one; all columns come back as they are; an
    empty table, or an empty benchmark, drops nothing.
    """
    ship(spark)
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256) of every document.

    A null text is the empty one, of no tokens. Null ids and repeated rows are rows of their own; other columns are left
    out; an empty table gives an empty table.
    """
    ship(spark)
    named = docs.select(F.struct("doc_id", "lang", "source").alias("doc"), "text")
    out = bpe.encode(named, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, id_col="doc", digest=True)
    return out.select("doc.*", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


STAGES = [
    ("language_id", language),
    ("jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeats),
    ("decontamination", decontaminate),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
