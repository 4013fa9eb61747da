"""The operators as stages of a corpus pipeline: documents in, documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwright.llm import langid
from spanwright.llm.common import checked_broadcast, cut, table
from spanwright.llm.decontam import decontaminated
from spanwright.llm.neardup import near_duplicates
from spanwright.llm.packing import packed, share_after_prompt
from spanwright.llm.pseudonyms import pseudonymised
from spanwright.llm.queries import PSEUDONYM_KEY, tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; texts without one, or without a letter, go.

    A language is the main one with a share of 0.3 or more.  Each row by itself,
    so repeated rows go or stay together; an empty table gives none.
    """
    return langid.accepted(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest key.

    Rows that repeat a key and its text are one document, of which one row
    stays, an arbitrary one if their other columns differ.  Different texts of
    one key stay or go each for itself.  Null keys, null and blank texts stay;
    an empty table gives none, and columns may have any names.
    """
    found = near_duplicates(docs, text_hash=True)
    gone = found.filter("not kept").select(F.col("doc_id").alias("gone")).distinct()
    repeated = found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("again"))
    names, inner = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    key, text = (F.col(inner[names.index(c)]) for c in ("doc_id", "text"))
    rows = docs.toDF(*inner)
    if not repeated.limit(1).count():
        return rows.join(checked_broadcast(gone), key.cast("long") == F.col("gone"), "left_anti").toDF(*names)
    ids = checked_broadcast(cut(repeated))
    single = rows.join(ids, key.cast("long") == F.col("again"), "left_anti").join(checked_broadcast(gone), key.cast("long") == F.col("gone"), "left_anti")
    stay = found.filter("kept").select(F.col("doc_id").alias("stay"), "text_hash").distinct()
    hashed = rows.join(ids, key.cast("long") == F.col("again"), "left_semi").withColumn("hash", F.xxhash64(text))
    hashed = hashed.join(stay, (key.cast("long") == F.col("stay")) & (F.col("hash") == F.col("text_hash")), "left_semi")
    return single.unionByName(hashed.dropDuplicates([inner[names.index("doc_id")], "hash"]).drop("hash")).toDF(*names)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; of a repeated key, all rows or none.

    Null keys, null and blank texts stay; an empty table gives none.
    """
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data; n_chars follows the text.

    Each row by itself, so repeated rows stay equal; a null text stays null.
    """
    names, out = docs.columns, pseudonymised(docs, PSEUDONYM_KEY)
    if "n_chars" not in names:
        return out
    chars = F.when(F.col("n_chars").isNotNull(), F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return out.select(*(chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in names))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed sequences; repeated rows each by itself.

    A null or empty text is one piece with the end alone, a long one as many as
    it needs; an empty table gives none.
    """
    return packed(docs, tokenizer_path(), share_after_prompt(F.col("text")))
