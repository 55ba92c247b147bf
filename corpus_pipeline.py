"""Training-data pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.llm import byte_bpe, decontaminate, jaccard, language, pii
from seedloom.llm.queries import PSEUDONYM_KEY, scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told, and fill in a null ``lang``.

    Rejected are texts that are null, empty or without a letter, and those whose best language scores
    less than ``language.MIN_SCORE``. Repeated rows are judged alike; without any labelled row, or
    without rows, nothing is dropped. Other columns pass unread.
    """
    return language.with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies (five words, 0.8): the one of smallest id.

    Texts are told apart by id and text, so a clean text stays when another one has its id. A null
    id comes after all others; rows of one id go by hash of text, then of all columns, and of rows
    that are the same throughout one stays. Texts without a word are nobody's copies and all stay.
    """
    key = F.xxhash64("doc_id", F.col("doc_id").isNull(), F.sha2("text", 256))
    row = F.sha2(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}), 256)
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^ \t\n\x0B\f\r]")
    rows = docs.filter(worded).select(F.struct(*docs.columns).alias("doc"), key.alias("key"), row.alias("row"))
    groups = jaccard.similar_documents(rows.select("key", "doc.text"), words=5, percent=80, id_col="key")
    place = F.struct(F.col("doc.doc_id").isNull().alias("nameless"), "doc.doc_id", "key", "row")
    kept = (
        rows.select("key", place.alias("place"))
        .join(groups.select(F.col("doc_id").alias("key"), "component_id").distinct(), "key")
        .groupBy("component_id")
        .agg(F.min("place").alias("place"))
        .select("place.key", "place.row")
        .distinct()
    )
    chosen = rows.join(kept, ["key", "row"]).dropDuplicates(["key", "row"])
    return chosen.select("doc.*").unionAll(docs.filter(~worded))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark.

    Decided by text: null and repeated ids play no part, and all rows of a leaking text go. Null and
    empty texts hold no passage and stay; an empty table gives none.
    """
    key = F.sha2(F.col("text"), 256)
    texts = docs.select(key.alias("doc_id"), "text").filter("text IS NOT NULL")
    leaks = decontaminate.find_leaks(texts, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, F.coalesce(key, F.lit("")) == leaks["doc_id"], "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put pseudonyms for personal data; ``n_chars``, if there is one, follows the new text.

    Null texts stay null; every row stays, repeated ones too; other columns pass unread.
    """
    changed = pii.pseudonymize(docs, PSEUDONYM_KEY)
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left, and digests of ids and of the decoded bytes.

    Null and empty texts have no ids; every row stays, null and repeated ids too.
    """
    return byte_bpe.round_trip(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES: list[tuple[str, Stage]] = [
    ("language-id", language_id),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal-data", personal_data),
    ("tokens", tokens),
]

#: SQL expresses neither the trained language model nor the keyed pseudonyms.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        out = f"{path}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
