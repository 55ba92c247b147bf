"""Pipeline inputs derived from the driver tables.

The tables hold no model replies or tuning runs, so those columns are computed from
whole rows. Expressions written as SQL text mean the same in Spark and in DuckDB and are
used by both sides; everything the engine itself computes is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.functions.jsontext import json_string

TASK = "Classify each document by language."
ROLE = "You are a careful language expert."
SEED = 7
NL = "chr(10)"

# --- seed rows with intake defects --------------------------------------------------

RAW_TEXT = (
    "CASE doc_id % 17 WHEN 0 THEN '   ' WHEN 1 THEN chr(9) || chr(160) || chr(10) WHEN 2 THEN '' "
    "WHEN 3 THEN NULL WHEN 4 THEN chr(160) || text || chr(9) ELSE text END"
)
RAW_LABEL = (
    "CASE doc_id % 19 WHEN 0 THEN '  ' WHEN 1 THEN NULL WHEN 2 THEN ' ' || upper(lang) || chr(9) ELSE lang END"
)

# --- classifier replies -------------------------------------------------------------

PREDICTED = "CASE doc_id % 5 WHEN 0 THEN 'en' WHEN 1 THEN 'klingon' ELSE lang END"


def reply(label: str, key: str) -> str:
    """A reply naming ``label`` in one of fourteen shapes picked by ``key``."""
    plain = f"""'{{"label": "' || {label} || '"}}'"""
    shapes = [
        plain,
        f"'```json' || {NL} || {plain} || {NL} || '```'",
        f"'Answer: ' || {plain} || ' done'",
        f"""'{{"label": "' || {label} || '",'""",
        "''",
        """'{"label": "   "}'""",
        f"""'{{"label": "' || upper({label}) || '"}}'""",
        f"""'"label": "' || {label} || '",' || {NL} || 'end'""",
        f"'  ' || {label} || '  '",
        "'[1, 2]'",
        f"'The label = ' || {label} || ' since the words look so'",
        "'I cannot decide what this long document is about'",
        """'{"answer": "none"}'""",
        f"""'{{"note": {{"a": 1}},' || {NL} || ' "label": "' || {label} || '"}}'""",
    ]
    cases = " ".join(f"WHEN {place} THEN {shape}" for place, shape in enumerate(shapes))
    return f"CASE {key} % {len(shapes)} {cases} END"


# --- judge replies ------------------------------------------------------------------


def judge_reply(key: str) -> str:
    """A judge reply; some lack a field, leave the range, add prose or are NULL."""

    def score(factor: int) -> str:
        return f"'0.' || CAST(60 + {key} * {factor} % 40 AS STRING)"

    def body(fidelity: str, tail: str = """, "reasoning": "fits"}'""") -> str:
        return (
            f"""'{{"fidelity": ' || {fidelity} || ', "naturalness": ' || {score(53)} """
            f"""|| ', "utility": ' || {score(71)} || '{tail}"""
        )

    return (
        f"CASE {key} % 13 WHEN 0 THEN {body(score(37), '''}' ''')} WHEN 1 THEN {body(chr(39) + '1.1' + chr(39))} "
        f"WHEN 2 THEN {body(score(37))} || ' thanks' WHEN 3 THEN NULL "
        f"""WHEN 4 THEN {body("'\"0.9\"'")} WHEN 5 THEN {body("'1'")} ELSE {body(score(37))} END"""
    )


# --- generator batches --------------------------------------------------------------


def batch_reply(quoted_text: str) -> str:
    """A generator reply; ``quoted_text`` is the whole document as a JSON string."""
    one = f"""'{{"results": [' || {quoted_text} || ']}}'"""
    return (
        f"""CASE doc_id % 8 WHEN 0 THEN '{{"results": [' || {quoted_text} || ', " second version of ' || doc_id || ' "]}}' """
        f"WHEN 1 THEN '<Think>a {{plan}}' || {NL} || '</Think>' || {NL} || {one} "
        f"WHEN 2 THEN '```json' || {NL} || {one} || {NL} || '```' "
        f"WHEN 3 THEN 'no braces at all in reply ' || doc_id "
        f"""WHEN 4 THEN '{{"results": ["broken candidate number ' || doc_id || '", "short", "another broken candidate"}}' """
        """WHEN 5 THEN '{"results": ["", " "]}' """
        f"WHEN 6 THEN 'Sure! ' || {one} || ' Hope this helps' "
        """ELSE '{"results": [1, "a numeric neighbour of ' || doc_id || '"]}' END"""
    )


# --- rule replies -------------------------------------------------------------------

RULES_REPLY = (
    f"""CASE doc_id % 4 WHEN 0 THEN '{{"diversity_rules": ["write as ' || source || '", "be formal"], "unknown_diversity_rules": ["small talk"]}}' """
    f"""WHEN 1 THEN '```json' || {NL} || '{{"diversity_rules": [], "unknown_diversity_rules": ["' || lang || '"]}}' || {NL} || '```' """
    """WHEN 2 THEN '{"diversity_rules": ["only one list"]}' ELSE 'no rules today' END"""
)

# --- tuning trials ------------------------------------------------------------------

TRIAL_COLUMNS = {
    "run_id": "'run_' || CAST(o_custkey % 20 AS STRING)",
    "row_idx": "o_orderkey",
    "number": "o_orderkey",
    "value": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE round(o_totalprice, -3) END",
    "state": "CASE o_orderstatus WHEN 'F' THEN 'FAIL' ELSE 'COMPLETE' END",
    "params_learning_rate": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '0.000' || CAST(o_orderkey % 9 + 1 AS STRING) END",
    "params_lora_r": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(4 + o_custkey % 4 AS STRING) END",
    "params_lora_dropout": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '0.' || CAST(1 + o_orderkey % 5 AS STRING) END",
}

# --- vector candidates --------------------------------------------------------------

VECTOR_LABEL = "CASE WHEN label = 9 THEN 'unknown' ELSE 'class_' || CAST(label AS STRING) END"
VECTOR_TEXT = (
    "CASE WHEN vec_id % 29 = 0 THEN 'None' WHEN vec_id % 31 = 0 THEN chr(160) || ' ' "
    "ELSE 'text of vector ' || CAST(vec_id AS STRING) END"
)
SEMANTIC_THRESHOLD = 0.35  # no pair of the test vectors reaches the production value
ACCEPT_TARGET = 120
#: Vectors of this class stand in for the seed index.
SEED_CLASS = "class_0"
#: Every third generated row has a label with a small quota.
GUARD_LABEL = "CASE WHEN doc_id % 3 = 2 THEN 'few' ELSE 'many' END"
GUARD_FEW = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that carry a quality mark, labelled by language."""
    marked = table(spark, sf_dir, "labels").select("doc_id")
    rows = documents(spark, sf_dir).join(marked, "doc_id", "left_semi")
    return rows.select("doc_id", "text", F.col("lang").alias("label"))


def synthetic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other documents, standing in for generated rows."""
    marked = table(spark, sf_dir, "labels").select("doc_id")
    rows = documents(spark, sf_dir).join(marked, "doc_id", "left_anti")
    return rows.select("doc_id", "text", F.col("lang").alias("label"))


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as raw intake rows with defects; every 23rd row is not an object."""
    rows = documents(spark, sf_dir)
    raw = F.map_from_arrays(
        F.array(F.lit("source"), F.lit("document_content"), F.lit("doc_class")),
        F.array(F.col("source"), F.expr(RAW_TEXT), F.expr(RAW_LABEL)),
    )
    is_object = F.expr("doc_id % 23 <> 7")
    return rows.select(
        F.col("doc_id").alias("row_idx"), F.when(is_object, raw).alias("raw"), is_object.alias("is_object")
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "doc_id", "lang", "source", F.expr(reply(f"({PREDICTED})", "doc_id")).alias("response")
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations (system, user, ground truth, prediction) over whole documents."""

    def turn(role: str, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    truth = F.expr("""'{"label": "' || lang || '"}'""")
    answer = F.expr(reply(f"({PREDICTED})", "(doc_id + 3)"))
    messages = F.array(
        turn("system", F.lit(ROLE)), turn("user", F.col("text")), turn("assistant", truth), turn("assistant", answer)
    )
    return documents(spark, sf_dir).select("doc_id", "source", messages.alias("messages"))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).withColumn("quoted", json_string(F.col("text")))
    return rows.select(
        F.col("doc_id").alias("request_id"),
        F.col("lang").alias("label"),
        F.expr(batch_reply("quoted")).alias("generated_text"),
    )


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    return rows.select(*[F.expr(text).alias(name) for name, text in TRIAL_COLUMNS.items()])


def vector_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq"),
        F.expr(VECTOR_LABEL).alias("label"),
        F.expr(VECTOR_TEXT).alias("cleaned_text"),
        F.expr(judge_reply("vec_id")).alias("judge_raw_output"),
        "embedding",
    )
