"""Generation planning: quotas per label and the few-shot request table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedloom.functions.text import key_slice, order_key
from seedloom.operators.ranking import dense_index
from seedloom.session import broadcast_if_small

UNKNOWN = "unknown"

# Planning constants and fallback rules.
UNKNOWN_SHARE = 0.10
CANDIDATES_PER_PROMPT = 4.0
PROMPT_HEADROOM = 1.5
EXAMPLES_PER_PROMPT = 3
MAX_LOOPS = 20
DIFFICULTIES = ("easy", "medium", "hard", "complex-structure")
FALLBACK_RULES = ("Focus on specific details.", "Use formal language.", "Consider different perspectives.")
FALLBACK_UNKNOWN_RULES = ("Generic chatter.", "Unrelated news snippets.")

_CHUNK = 10_000


def usable_examples(seed: DataFrame) -> DataFrame:
    return seed.filter((F.col("text") != "") & (F.col("label") != ""))


def quota_plan(seed: DataFrame, target: int, unknown_share: float = UNKNOWN_SHARE) -> DataFrame:
    """``label, target`` for every seed label plus ``unknown`` (left out at share 0).

    A seed label spelled ``unknown`` counts as a class but takes the unknown quota.
    """
    labels = usable_examples(seed).select("label").distinct()
    if labels.isEmpty():
        raise ValueError("no valid labels found in the seed rows")
    n_labels = labels.agg(F.count("*")).scalar()
    for_unknown = F.ceil(F.lit(float(target)) * F.lit(float(unknown_share)))
    for_each = F.ceil((F.lit(target) - for_unknown).cast("double") / n_labels)
    unknown = seed.sparkSession.range(1).select(F.lit(UNKNOWN).alias("label"))
    known = labels.filter(F.col("label") != UNKNOWN).select("label", for_each.alias("target"))
    return known if unknown_share == 0 else known.unionByName(unknown.select("label", for_unknown.alias("target")))


def quota_need(plan: DataFrame, collected: DataFrame) -> DataFrame:
    """Labels still short of their target and how many prompts to issue for each."""
    need = F.col("target") - F.coalesce("collected", F.lit(0))
    prompts = F.ceil(F.col("need") / F.lit(CANDIDATES_PER_PROMPT) * F.lit(PROMPT_HEADROOM))
    return (
        plan.join(collected.select("label", "collected"), "label", "left")
        .select("label", "target", need.alias("need"))
        .filter(F.col("need") > 0)
        .withColumn("n_prompts", F.greatest(F.lit(1).cast("bigint"), prompts))
    )


def examples_by_label(seed: DataFrame, id_col: str, seed_value: object) -> DataFrame:
    """Seed texts per label as flat rows ``label, example_idx, example_id, text``.

    Positions follow the seeded order, so a random pick is an equality on
    ``(label, example_idx)`` instead of a list of all texts of the label.
    """
    keyed = usable_examples(seed).select(
        "label",
        F.col(id_col).alias("example_id"),
        "text",
        F.concat_ws(":", order_key(seed_value, id_col), F.col(id_col).cast("string")).alias("_key"),
    )
    return dense_index(keyed, "label", "_key", "example_idx").select("label", "example_idx", "example_id", "text")


def request_slots(need: DataFrame, first_id: int = 0) -> DataFrame:
    """One row per prompt: ``request_id, label``. Ids run through the labels in order.

    Slots are expanded in chunks and respread, so no label's prompts form one array
    or one task.
    """
    earlier = Window.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n_prompts").over(earlier), F.lit(0)) + F.lit(first_id)
    chunks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n_prompts - 1) div {_CHUNK}"))
    start = F.col("chunk") * _CHUNK
    size = F.least(F.lit(_CHUNK).cast("bigint"), F.col("n_prompts") - start)
    return (
        need.select("label", "n_prompts", offset.alias("offset"))
        .select("label", "n_prompts", "offset", F.explode(chunks).alias("chunk"))
        .repartition("label", "chunk")
        .select("label", (F.col("offset") + start).alias("base"), size.alias("size"))
        .select("label", "base", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1)).alias("step"))
        .select((F.col("base") + F.col("step")).alias("request_id"), "label")
    )


def _distinct_picks(key: Column, n: Column) -> Column:
    """Up to three different positions in ``[0, n)`` drawn from the words of ``key``."""
    first = key_slice(key, 0) % F.greatest(n, F.lit(1))
    second = key_slice(key, 1) % F.greatest(n - 1, F.lit(1))
    second = second + F.when(second >= first, 1).otherwise(0)
    low, high = F.least(first, second), F.greatest(first, second)
    third = key_slice(key, 2) % F.greatest(n - 2, F.lit(1))
    third = third + F.when(third >= low, 1).otherwise(0)
    third = third + F.when(third >= high, 1).otherwise(0)
    size = F.least(n, F.lit(EXAMPLES_PER_PROMPT)).cast("int")
    return F.slice(F.array(first, second, third), F.lit(1), size)


def _choose(pool: tuple[str, ...] | list[str], key: Column, word: int) -> Column:
    return F.get(F.lit(list(pool)), (key_slice(key, word) % len(pool)).cast("int"))


def fewshot_requests(
    slots: DataFrame,
    examples: DataFrame,
    task_description: str,
    seed_value: object,
    rules: tuple[str, ...] | list[str] = FALLBACK_RULES,
    unknown_rules: tuple[str, ...] | list[str] = FALLBACK_UNKNOWN_RULES,
    loop: int = 1,
) -> DataFrame:
    """Requests with up to three different examples of their label, a rule and a difficulty.

    ``shuffle_key`` is the random order in which requests should be issued.
    """
    sizes = broadcast_if_small(examples.groupBy("label").agg(F.count("*").alias("_n")))
    draw = order_key(seed_value, F.lit(loop), "request_id", F.lit("examples"))
    style = order_key(seed_value, F.lit(loop), "request_id", F.lit("style"))
    is_unknown = F.col("label") == UNKNOWN
    picks = (
        slots.filter(~is_unknown)
        .join(sizes, "label")
        .select("request_id", "label", F.posexplode(_distinct_picks(draw, F.col("_n"))).alias("pick", "example_idx"))
        .join(examples, ["label", "example_idx"])
        .groupBy("request_id")
        .agg(F.array_sort(F.collect_list(F.struct("pick", "example_id", "text"))).alias("_picked"))
    )
    picked = F.coalesce("_picked", F.array().cast("array<struct<pick:int,example_id:bigint,text:string>>"))
    rule = F.when(is_unknown, _choose(unknown_rules, style, 0)).otherwise(_choose(rules, style, 0))
    return slots.join(picks, "request_id", "left").select(
        "request_id",
        F.lit(loop).alias("loop"),
        F.lit(task_description).alias("task_description"),
        "label",
        F.transform(picked, lambda item: item["text"]).alias("examples"),
        F.transform(picked, lambda item: item["example_id"]).alias("example_ids"),
        _choose(DIFFICULTIES, style, 1).alias("difficulty"),
        rule.alias("diversity_rule"),
        order_key(seed_value, F.lit(loop), "request_id", F.lit("shuffle")).alias("shuffle_key"),
    )
