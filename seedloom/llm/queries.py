"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.llm import (
    alignment,
    byte_bpe,
    chat,
    conversation_repair,
    decontaminate,
    embeddings,
    jaccard,
    language,
    packing,
    pii,
    secret_scan,
    suffix_dedup,
    token_files,
)
from seedloom.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def op5_token_files(spark, sf_dir):
    path = scratch(spark, "token-files")
    token_files.encode_to_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_files(spark, path).drop("ids")


@query
def op6_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op4_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    fixed = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return chat.chat_digest(chat.format_conversations(rows.unionByName(fixed)))


@query
def op10_secret_scan(spark, sf_dir):
    return secret_scan.secret_digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


@query
def op3_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


#: Stands in for a secret that a job would read from its own store.
PSEUDONYM_KEY = "0f5c1d0b7a934e21"


@query
def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def _count(column: str, value: str) -> Column:
    return F.size(F.filter(column, lambda x: x == value))


@query
def op7_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.pseudonymize(docs, PSEUDONYM_KEY, found_col="kinds")
    return found.select("doc_id", *[_count("kinds", kind).alias(f"n_{kind}") for kind in pii.KINDS], "text")


@query
def op8_decontaminate(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_embeddings(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op2_jaccard(spark, sf_dir):
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


@query
def op13_packing(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op12_alignment(spark, sf_dir):
    return alignment.align_corpus(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query
def op11_conversation_repair(spark, sf_dir):
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.audit_conversations(damaged, absent="gone")
