"""Prompt rendering as column expressions over request, candidate and text tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.functions.jsontext import json_string
from seedloom.functions.text import is_blank

# Prompt texts. ``<<name>>`` marks a slot filled from a column.
GENERATOR_SYSTEM = """[Role]
You are a Senior Synthetic Data Engineer specializing in generating high-quality datasets for Small Language Model (SLM) fine-tuning.

[Task]
Your mission is to produce highly specific, diverse, and accurate text classifications that match a target label perfectly.

[Context]
High data fidelity is critical. The generated text must exhibit the nuances, vocabulary, and structural variations characteristic of authentic human-written content. Ensure maximum variation across multiple generated samples.

[Few-shot Guideline]
When provided with seed examples, capture their stylistic essence (tone, length, vocabulary) while ensuring all your generated outputs are 100% unique from the seeds and entirely distinct from one another.

[Output Instructions]
1. Brainstorm and generate EXACTLY 5 highly diverse candidate texts.
2. Ensure each candidate has a significantly different tone, perspective, professional terminology, length, or structure from the others.
3. Output ONLY a valid JSON object matching this exact schema:
{
  "results": [
    "diverse candidate text 1...",
    "diverse candidate text 2...",
    "diverse candidate text 3...",
    "diverse candidate text 4...",
    "diverse candidate text 5..."
  ]
}
DO NOT include any markdown formatting, <think> tags, explanations, or conversational text. Output only the pure JSON string.
"""

GENERATOR_USER = """Task Description: <<task_description>>
Target Category/Label: '<<label>>'

[Constraint: Diversity/Difficulty]
Rule: <<diversity_rule>>
Difficulty: <<difficulty>>

[Style Reference: Seed Examples (DO NOT COPY)]
<<example_block>>

Please provide EXACTLY 5 unique text examples that fulfill the requirements of the '<<label>>' label.
CRITICAL DIVERSITY CHECK: Each of the 5 examples MUST be drastically different from the others. Do not just change a few words. Create completely different scenarios, writing styles, or contexts for each one of them while strictly adhering to the Constraint and Label.

Output ONLY a raw JSON object containing an array of 5 strings under the "results" key.
DO NOT include any introductions, output candidate numbers, brainstorming, or internal evaluation. If you include any text outside the JSON structure, the entire output will be rejected."""

NO_EXAMPLES = """
No specific examples provided. Please generate highly creative and original examples for the '<<label>>' category that are distinct from the general task.
"""

JUDGE_USER = """Evaluate the following generated text for a classification task.
Task Description: <<task_description>>
Generated Text: <<cleaned_text>>
Target Label: <<label>>

# Definition of 'unknown' Label:
If the Target Label is 'unknown', it means the text should be irrelevant, out-of-scope, or nonsensical relative to the Task Description provided.

# Evaluation Metrics (0.0 to 1.0):
1. Fidelity: Does the core meaning of the text a perfect match for the category '<<label>>'?
2. Naturalness: Is the review fluent and realistic? (For 'unknown', it should just be coherent text unless it's intended to be gibberish).
3. Utility: Is this a high-quality example for training a classifier?

Output ONLY a JSON object matching this schema:
{
  "fidelity": float,
  "naturalness": float,
  "utility": float,
  "reasoning": "string"
}
Do not include any other text. Output scores MUST be a FLOAT between 0.0 and 1.0 (e.g., 0.85). DO NOT use fractions (like 9/10), strings, or negative values. Be extremely strict."""

RULES_SYSTEM = "You are a Senior Data Engineer. Return ONLY JSON."

RULES_USER = """You are a Senior Data Engineer. Your task is to brainstorm "Diversity Rules" for a Synthetic Data Generation pipeline.
These rules will be used to guide an LLM to generate high-quality, diverse, and realistic training data for a classification task.

[Task Description]
<<task_description>>

[Target Labels]
<<label_names>>

[Requirements]
1. Diversity Rules: These rules should encourage the generator to use different perspectives, professional jargon, tones, or focus on specific nuances of the task. (e.g., 'Write from the perspective of an expert', 'Focus on edge cases like X').
2. Unknown Rules: These rules should create 'out-of-distribution' data that is NOT related to the main task but might be common noise (e.g., 'General greetings', 'Unstructured chatter about weather', 'Technical manuals for unrelated items').

Please provide a JSON object following this schema:
{
  "diversity_rules": ["rule1", "rule2", ...],
  "unknown_diversity_rules": ["rule1", "rule2", ...]
}
Output ONLY the JSON object.
"""

DEFAULT_ROLE = "You are an expert document classifier."
DEFAULT_TASK = "Your task is to identify the most appropriate category for the provided text."
CLASSIFY_INSTRUCTION = (
    "<<task>> The available categories are: <<label_names>>. "
    "Return the result in a valid JSON format with a single 'label' key."
)
NO_INPUT = "No input provided."


def fill(template: str, **slots: Column) -> Column:
    """Concatenate the literal pieces of ``template`` with the slot columns."""
    pieces = re.split(r"<<(\w+)>>", template)
    parts = [slots[piece] if place % 2 else F.lit(piece) for place, piece in enumerate(pieces)]
    return F.concat(*[F.coalesce(part, F.lit("")) for part in parts])


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def generation_prompts(requests: DataFrame) -> DataFrame:
    """Add ``system_prompt`` and ``user_prompt`` to few-shot requests."""
    label = F.col("label")
    listed = F.transform("examples", lambda text: F.concat(F.lit("\n- "), text, F.lit("\n")))
    block = F.when(F.size("examples") > 0, F.concat(F.lit("\n"), F.array_join(listed, ""), F.lit("\n"))).otherwise(
        fill(NO_EXAMPLES, label=label)
    )
    user = fill(
        GENERATOR_USER,
        task_description=F.col("task_description"),
        label=label,
        diversity_rule=F.col("diversity_rule"),
        difficulty=F.col("difficulty"),
        example_block=block,
    )
    return requests.withColumns({"system_prompt": F.lit(GENERATOR_SYSTEM), "user_prompt": user})


def judge_prompts(candidates: DataFrame) -> DataFrame:
    """Add ``judge_prompt`` to candidate rows."""
    slots = {name: F.col(name) for name in ("task_description", "cleaned_text", "label")}
    return candidates.withColumn("judge_prompt", fill(JUDGE_USER, **slots))


def rule_prompt(labels: DataFrame, task_description: str) -> DataFrame:
    """One row with the rule-writing prompt; ``labels`` is the one-row label array.

    ``unknown`` is always a target label, listed after the seed's own labels.
    """
    known = F.filter("labels", lambda name: name != "unknown")
    names = F.array_join(F.concat(known, F.array(F.lit("unknown"))), ", ")
    user = fill(RULES_USER, task_description=F.lit(task_description), label_names=names)
    return labels.select(F.lit(RULES_SYSTEM).alias("system_prompt"), user.alias("user_prompt"))


def classify_user(text: Column, labels: list[str], task: str = DEFAULT_TASK) -> Column:
    """User turn shared by training, evaluation and inference."""
    return fill(
        CLASSIFY_INSTRUCTION + "\n\nText: <<text>>",
        task=F.lit(task),
        label_names=F.lit(", ".join(labels)),
        text=text,
    )


def label_target(label: Column) -> Column:
    """Assistant target ``{"label": "x"}`` with a blank after the colon."""
    return F.concat(F.lit('{"label": '), json_string(label), F.lit("}"))


def inference_requests(
    rows: DataFrame, labels: list[str], role: str = DEFAULT_ROLE, task: str = DEFAULT_TASK
) -> DataFrame:
    """Add the chat form (``messages``) and the single-string form (``prompt``) of a request."""
    user = classify_user(F.col("text"), labels, task)
    return rows.withColumns(
        {
            "messages": F.array(message("system", F.lit(role)), message("user", user)),
            "prompt": F.concat(F.lit(role + " "), user),
        }
    )


def guard_blank_requests(rows: DataFrame) -> DataFrame:
    """Answer blank requests right away: ``label, confidence, raw_output`` are set only for them."""
    blank = is_blank("text")
    return rows.withColumns(
        {
            "needs_model": ~blank,
            "label": F.when(blank, F.lit(NO_INPUT)),
            "confidence": F.when(blank, F.lit(0.0)),
            "raw_output": F.when(blank, F.lit("")),
        }
    )
