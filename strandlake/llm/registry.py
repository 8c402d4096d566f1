"""The registered opN queries: each operator on its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import bpe, chat, decontam, jaccard, langid, licenses, lmscore, media, quality, sadedup
from strandlake.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The extra conversation of op5.
PROBE = r"\### Assistant: </turn> ok"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, modulus: int):
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(modulus))


@query("op1_bpe")
def op1_bpe(spark, sf_dir):
    out = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digest=True)
    return out.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


@query("op2_media")
def op2_media(spark, sf_dir):
    return media.media_features(media.store_media(table(spark, sf_dir, "documents"))).drop("npy")


def held_out(modulus: int, remains: int):
    """A document without an id is not held out."""
    return F.coalesce(remainder("doc_id", modulus) == remains, F.lit(False))


@query("op4_langid")
def op4_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn(docs.where(~held_out(4, 2)))
    return langid.identify(docs, profiles).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


ESCAPED = r"regexp_replace({}, '\\|###|</turn>', '\\\0', 'g')"


@query(
    "op5_chat",
    f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}'))
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(13 + length({ESCAPED.format("role")}) + length({ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id""",
)
def op5_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    return chat.read_back(chat.format_conversations(rows.unionByName(probe)))


@query("op10_sadedup")
def op10_sadedup(spark, sf_dir):
    return sadedup.remove_repeats(table(spark, sf_dir, "documents"), form="digest", least=sadedup.PASSAGE).withColumnRenamed("kept", "kept_sha256")


@query("op8_jaccard")
def op8_jaccard(spark, sf_dir):
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


@query("op7_decontam")
def op7_decontam(spark, sf_dir):
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_lmscore")
def op3_lmscore(spark, sf_dir):
    return lmscore.score(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels").where(~held_out(5, 0)))
    return quality.score(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


@query("op9_licenses")
def op9_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))
