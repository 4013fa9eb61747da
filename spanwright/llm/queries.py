"""The registered queries of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwright.llm import langid, quality
from spanwright.llm.common import table
from spanwright.llm.decontam import CONTAINED_ITEMS, contained_items
from spanwright.llm.licenses import license_matches, license_sql
from spanwright.llm.mpeg import media_features
from spanwright.llm.neardup import near_duplicates
from spanwright.llm.neardup_sql import NEAR_DUPLICATES
from spanwright.llm.packing import conversation_examples, packed, share_after_prompt
from spanwright.llm.pseudonyms import pseudonymised
from spanwright.llm.secrets import secret_spans
from spanwright.llm.sharding import hilbert_shards

#: A key for the registered queries; production sets its own.
PSEUDONYM_KEY = "registered query"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(table(spark, sf_dir, "documents"))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymised(documents, PSEUDONYM_KEY, counts=True)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    names, model = langid.learn(documents)
    found = langid.predict(documents, names, model)
    return found.withColumn("held_out", langid.held_out(F.col("doc_id")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.learn(documents, table(spark, sf_dir, "labels"))
    scored = quality.quality_scores(documents, model)
    return scored.withColumn("held_out", langid.held_out(F.col("doc_id")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer_path(), share_after_prompt(F.col("text")))


def conversation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packing of op10 over conversations, of which the assistant's turns bear loss."""
    examples = conversation_examples(table(spark, sf_dir, "conversations"))
    return packed(examples, tokenizer_path(), F.col("loss_share"), loss=2048)


QUERIES = {
    f.__name__: f
    for f in (
        op1_media, op2_secrets, op3_licenses, op4_neardup, op5_decontamination,
        op6_sharding, op7_pseudonyms, op8_language, op9_quality, op10_packing, conversation_packing,
    )
}

ORACLE_SQL = {"op3_licenses": license_sql(), "op4_neardup": NEAR_DUPLICATES, "op5_decontamination": CONTAINED_ITEMS}
