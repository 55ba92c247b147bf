"""Table-to-table parsers for generator, judge, rule and classifier responses.

Every parser adds a status column, so outcome rates are plain aggregations.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from seedloom.functions.columns import with_computed
from seedloom.functions.jsontext import (
    entries_for,
    is_json,
    parse_objects,
    parse_variants,
    sole_object,
    sole_variant,
    variant_type,
)
from seedloom.functions.text import as_column, is_blank, strip
from seedloom.operators.quota import FALLBACK_RULES, FALLBACK_UNKNOWN_RULES, UNKNOWN

# Patterns, weights and thresholds. ``[\s\x1c-\x1f]`` with (?U) is Unicode
# white space as str.strip knows it.
THINKING = r"(?is)<(think|reasoning)>.*?</\1>"
OPENING_FENCE = r"(?U)^```(?:json)?[\s\x1c-\x1f]*"
CLOSING_FENCE = r"(?U)[\s\x1c-\x1f]*```$"
QUOTED = r'"([^"]+)"'
BRACES = r"(?s)\{.*\}"
LABEL_PAIR = r"""(?iU)["']?label["']?[\s\x1c-\x1f]*[:=][\s\x1c-\x1f]*["']?([^"'\s\x1c-\x1f,{}]+)["']?"""
FIDELITY_WEIGHT, NATURALNESS_WEIGHT, UTILITY_WEIGHT = 0.4, 0.3, 0.3
JUDGE_THRESHOLD = 0.70
MIN_QUOTED_LENGTH = 10
SHORT_ANSWER_WORDS = 5
PARSE_FAILED = "ERROR: Parsing Failed"

#: Labels compared one by one inside an expression; longer lists are searched by automaton.
LISTED_LABELS = 100

_STRING_LISTS = ("ARRAY<STRING>", "ARRAY<VOID>")
_NO_TEXTS = "array<string>"


def _without_fence(text: Column) -> Column:
    inner = F.regexp_replace(F.regexp_replace(text, OPENING_FENCE, ""), CLOSING_FENCE, "")
    return F.when(text.startswith("```"), inner).otherwise(text)


def _string_list(document: Column, path: str) -> Column:
    """The array of strings at ``path``; NULL when absent or not purely strings."""
    values = F.try_variant_get(document, path, "array<string>")
    pure = variant_type(document, path).isin(*_STRING_LISTS) & ~F.exists(values, lambda item: item.isNull())
    return F.when(pure, values)


# --- generator batches ------------------------------------------------------------


def explode_candidates(responses: DataFrame, text_col: str = "generated_text") -> DataFrame:
    """One row per candidate text; a response without any keeps one row with ``''``.

    Adds ``candidate_pos, cleaned_text, batch_status`` (``json``, ``quoted``, ``empty``).
    """
    raw = F.coalesce(F.col(text_col), F.lit(""))
    staged = with_computed(responses, {"_clean": _without_fence(strip(F.regexp_replace(raw, THINKING, "")))})
    staged = with_computed(staged, {"_parsed": parse_variants(F.regexp_extract("_clean", BRACES, 0))})
    staged = with_computed(staged, {"_results": _string_list(sole_variant("_parsed"), "$.results")})
    has_braces = F.col("_clean").contains("{") & F.col("_clean").contains("}")
    from_json = F.filter(F.transform("_results", lambda item: strip(item)), lambda item: item != "")
    quoted = F.filter(
        F.regexp_extract_all("_clean", F.lit(QUOTED), F.lit(1)),
        lambda item: (item != "results") & (F.length(strip(item)) > MIN_QUOTED_LENGTH),
    )
    texts = (
        F.when(F.col("_results").isNotNull(), from_json)
        .when(has_braces, quoted)
        .otherwise(F.array().cast(_NO_TEXTS))
    )
    status = (
        F.when(F.size("_texts") == 0, "empty").when(F.col("_results").isNotNull(), "json").otherwise("quoted")
    )
    return (
        with_computed(staged, {"_texts": texts})
        .withColumn("batch_status", status)
        .select(
            *responses.columns,
            "batch_status",
            F.posexplode(
                F.when(F.size("_texts") > 0, F.col("_texts")).otherwise(F.array(F.lit("")))
            ).alias("candidate_pos", "cleaned_text"),
        )
    )


def is_valid_candidate(text: Column | str) -> Column:
    text = as_column(text)
    return ~is_blank(text) & (F.lower(text) != "none")


# --- judge ------------------------------------------------------------------------


def judge_scores(candidates: DataFrame, raw_col: str = "judge_raw_output") -> DataFrame:
    """Add ``fidelity, naturalness, utility, reasoning, overall_score, judge_status``.

    A reply counts only as a whole: an object with three numbers in [0, 1] and a
    string ``reasoning``. Status is ``ok``, ``low_score`` or ``judge_parse``.
    """
    metrics = ("fidelity", "naturalness", "utility")
    staged = with_computed(candidates, {"_parsed": parse_variants(F.coalesce(F.col(raw_col), F.lit("{}")))})
    staged = with_computed(staged, {"_judge": sole_variant("_parsed")})
    read = {f"_{name}": F.try_variant_get("_judge", f"$.{name}", "string").try_cast("double") for name in metrics}
    read["_typed"] = variant_type(F.col("_judge"), "$.reasoning") == "STRING"
    staged = with_computed(staged, read)
    complete = F.col("_typed")
    for name in metrics:
        complete = complete & F.col(f"_{name}").between(0.0, 1.0)
    overall = (
        F.col("_fidelity") * FIDELITY_WEIGHT
        + F.col("_naturalness") * NATURALNESS_WEIGHT
        + F.col("_utility") * UTILITY_WEIGHT
    )
    staged = with_computed(staged, {"overall_score": F.when(F.coalesce(complete, F.lit(False)), overall)})
    scored = F.col("overall_score").isNotNull()
    status = (
        F.when(~scored, "judge_parse").when(F.col("overall_score") < JUDGE_THRESHOLD, "low_score").otherwise("ok")
    )
    return staged.select(
        *candidates.columns,
        *[F.when(scored, F.col(f"_{name}")).alias(name) for name in metrics],
        F.when(scored, F.try_variant_get("_judge", "$.reasoning", "string")).alias("reasoning"),
        "overall_score",
        status.alias("judge_status"),
    )


# --- diversity rules --------------------------------------------------------------


def parse_rules(responses: DataFrame, raw_col: str = "raw_rules") -> DataFrame:
    """Add ``diversity_rules, unknown_diversity_rules, rules_status``; bad replies use the fallback."""
    body = _without_fence(strip(F.coalesce(F.col(raw_col), F.lit(""))))
    staged = with_computed(responses, {"_parsed": parse_variants(body)})
    staged = with_computed(staged, {"_doc": sole_variant("_parsed")})
    staged = with_computed(
        staged,
        {
            "_rules": _string_list(F.col("_doc"), "$.diversity_rules"),
            "_unknown_rules": _string_list(F.col("_doc"), "$.unknown_diversity_rules"),
        },
    )
    rules, unknown_rules = F.col("_rules"), F.col("_unknown_rules")
    good = rules.isNotNull() & unknown_rules.isNotNull()
    return staged.select(
        *responses.columns,
        F.when(good, rules).otherwise(F.lit(list(FALLBACK_RULES))).alias("diversity_rules"),
        F.when(good, unknown_rules).otherwise(F.lit(list(FALLBACK_UNKNOWN_RULES))).alias("unknown_diversity_rules"),
        F.when(good, "json").otherwise("fallback").alias("rules_status"),
    )


# --- classifier responses ---------------------------------------------------------


def snap_label(raw: Column | str, labels: list[str], compat: bool = False) -> Column:
    """Snap a raw label to the first valid label equal to it, else the first that contains
    it or is contained in it (case-insensitive), else ``unknown``.

    A white-space label is ``unknown``; ``compat=True`` snaps it to the first label,
    because the empty string is part of every label. Longer label lists than ``LISTED_LABELS``
    are searched by automaton in Arrow batches; shorter ones stay in one expression.
    """
    raw = as_column(raw)
    low = F.lower(strip(raw))
    if not labels:
        return F.lit(UNKNOWN)
    unusable = F.coalesce(raw, F.lit("")) == "" if compat else is_blank(raw)
    if len(labels) > LISTED_LABELS:
        snapped = F.coalesce(label_finder(labels)(low), F.lit(UNKNOWN))
        return F.when(unusable, F.lit(UNKNOWN)).otherwise(snapped)
    pairs = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(v.lower()).alias("low")) for v in labels])
    exact = F.get(F.filter(pairs, lambda p: p["low"] == low), F.lit(0))["v"]
    partial = F.get(F.filter(pairs, lambda p: F.contains(p["low"], low) | F.contains(low, p["low"])), F.lit(0))["v"]
    snapped = F.coalesce(exact, partial, F.lit(UNKNOWN))
    return F.when(unusable, F.lit(UNKNOWN)).otherwise(snapped)


class LabelSearch:
    """First label, in list order, equal to a text, else containing it or contained in it.

    Labels inside the text are found by one pass of an Aho-Corasick automaton over it. Labels
    around it: all labels stand one after the other in one string, so the first place where it
    occurs there is in the first such label. Texts are remembered up to a bound.
    """

    REMEMBERED = 100_000

    def __init__(self, labels: list[str]):
        import ahocorasick

        low = [label.lower() for label in labels]
        self.first = {}
        for number, label in enumerate(low):
            self.first.setdefault(label, number)
        used = set("".join(low))
        self.gap = next(chr(code) for code in range(0xE000, 0xF8FF) if chr(code) not in used)
        self.joined = self.gap.join(low)
        self.starts = list(accumulate((len(label) + 1 for label in low), initial=0))
        self.automaton = ahocorasick.Automaton()
        for label, number in self.first.items():
            if label:
                self.automaton.add_word(label, number)
        self.automaton.make_automaton()
        self.known: dict[str, int | None] = {}

    def find(self, text: str) -> int | None:
        if text in self.first:
            return self.first[text]
        if text not in self.known:
            if len(self.known) >= self.REMEMBERED:
                self.known.clear()
            inside = (number for _, number in self.automaton.iter(text)) if len(self.automaton) else ()
            found = min(inside, default=self.first.get(""))
            if "" in self.first and found is not None:
                found = min(found, self.first[""])
            at = -1 if self.gap in text else self.joined.find(text)
            if at >= 0:
                around = bisect_right(self.starts, at) - 1
                found = around if found is None else min(found, around)
            self.known[text] = found
        return self.known[text]


_searches: dict[int, LabelSearch] = {}


def label_finder(labels: list[str]):
    """Column function from a lower-case text to its label, or NULL."""
    key = hash(tuple(labels))

    @arrow_udf(StringType())
    def find(low: pa.Array) -> pa.Array:
        if key not in _searches:  # one list of labels per Python worker
            _searches.clear()
            _searches[key] = LabelSearch(labels)
        search = _searches[key]
        found = [None if text is None else search.find(text) for text in low.to_pylist()]
        return pa.array([None if number is None else labels[number] for number in found], pa.string())

    return find


def _label_of(obj: Column) -> Column:
    """Text of the object's ``label`` value; NULL when there is no such key."""
    entry = F.try_element_at(entries_for(obj, "label"), F.lit(-1))
    return F.when(entry.isNotNull(), F.coalesce(entry["value"], F.lit("None")))


def parse_evaluation_response(df: DataFrame, text_col: str, out: str = "raw_label") -> DataFrame:
    """Read a label from an evaluation response: fenced JSON, sliced JSON, then line scan.

    Adds ``out`` (``unknown`` when nothing is found) and ``{out}_status``:
    ``json``, ``no_label``, ``line`` or ``failed``.
    """
    staged = with_computed(df, {"_body": strip(F.coalesce(F.col(text_col), F.lit("")))})
    body = F.col("_body")
    fenced = F.get(F.split(F.get(F.split(body, "```json"), F.lit(1)), "```"), F.lit(0))
    sliced = (
        F.when(body.contains("```json"), strip(fenced))
        .when(body.contains("{"), F.regexp_extract(body, BRACES, 0))
        .otherwise(body)
    )
    staged = with_computed(staged, {"_body": sliced})
    staged = with_computed(staged, {"_maps": parse_objects("_body")})
    staged = with_computed(staged, {"_label": _label_of(sole_object("_maps"))})
    staged = with_computed(staged, {"_valid": F.col("_label").isNotNull() | is_json("_body")})
    line = F.get(F.filter(F.split("_body", "\n"), lambda row: F.contains(row, F.lit('"label":'))), F.lit(0))
    scanned = strip(F.translate(F.substring_index(line, '"label":', -1), '",', ""))
    staged = with_computed(staged, {"_scanned": F.when(~F.col("_valid"), scanned)})
    scanned = F.col("_scanned")
    status = (
        F.when(F.col("_label").isNotNull(), "json")
        .when(F.col("_valid"), "no_label")
        .when(scanned.isNotNull(), "line")
        .otherwise("failed")
    )
    return staged.withColumns(
        {out: F.coalesce("_label", scanned, F.lit(UNKNOWN)), f"{out}_status": status}
    ).drop("_body", "_maps", "_label", "_valid", "_scanned")


def parse_interactive_response(df: DataFrame, text_col: str, out: str = "raw_label") -> DataFrame:
    """Read a label from a free-form response through a cascade of looser readings.

    ``{out}_status`` names the stage that answered: ``json`` (whole text), ``block``
    (outermost braces), ``pair`` (``label: value``), ``short`` (under five words) or
    ``failed``. An object without a label answers ``unknown``.
    """
    staged = with_computed(df, {"_body": strip(F.coalesce(F.col(text_col), F.lit("")))})
    block = strip(F.translate(F.regexp_extract("_body", BRACES, 0), "\n", " "))
    staged = with_computed(staged, {"_whole_maps": parse_objects("_body"), "_block_text": block})
    staged = with_computed(
        staged,
        {
            "_whole": sole_object("_whole_maps"),
            "_block_maps": parse_objects("_block_text"),
        },
    )
    staged = with_computed(staged, {"_block": sole_object("_block_maps")})
    staged = with_computed(staged, {"_pair": F.regexp_extract("_body", LABEL_PAIR, 1)})
    words = F.regexp_count("_body", F.lit(r"(?U)[^\s\x1c-\x1f]+"))
    short = (words < SHORT_ANSWER_WORDS) & ~F.col("_body").contains("{")
    stages = [
        ("json", F.col("_whole").isNotNull(), F.coalesce(_label_of(F.col("_whole")), F.lit(UNKNOWN))),
        ("block", F.col("_block").isNotNull(), F.coalesce(_label_of(F.col("_block")), F.lit(UNKNOWN))),
        ("pair", F.col("_pair") != "", F.col("_pair")),
        ("short", short, F.col("_body")),
    ]
    label, status = F.lit(PARSE_FAILED), F.lit("failed")
    for name, applies, value in reversed(stages):
        label = F.when(applies, value).otherwise(label)
        status = F.when(applies, F.lit(name)).otherwise(status)
    found = with_computed(staged, {out: label, f"{out}_status": status})
    return found.drop("_body", "_whole_maps", "_block_text", "_whole", "_block_maps", "_block", "_pair")


def token_confidence(logprobs: Column | str) -> Column:
    """Mean token probability; missing or empty log-probabilities give 0.0."""
    logprobs = as_column(logprobs)
    total = F.aggregate(logprobs, F.lit(0.0), lambda acc, value: acc + F.exp(value))
    return F.when(F.size(logprobs) > 0, F.coalesce(total / F.size(logprobs), F.lit(0.0))).otherwise(0.0)


def inference_responses(
    df: DataFrame, labels: list[str], text_col: str = "generated_text", logprobs_col: str = "token_logprobs"
) -> DataFrame:
    """Add ``label, confidence, raw_output, error`` to raw model replies."""
    parsed = parse_interactive_response(df, text_col, "_raw")
    failed = F.col("_raw_status") == "failed"
    return parsed.withColumns(
        {
            "label": snap_label("_raw", labels),
            "confidence": token_confidence(logprobs_col),
            "raw_output": F.col(text_col),
            "error": F.when(failed, F.lit(PARSE_FAILED)),
        }
    ).drop("_raw", "_raw_status")


def parse_outcomes(parsed: DataFrame, run_col: str, status_col: str, label_col: str) -> DataFrame:
    """Responses, invalid-JSON rate and unknown-label rate per run."""
    return parsed.groupBy(run_col).agg(
        F.count("*").alias("n_responses"),
        F.avg(F.when(F.col(status_col) == "json", 0.0).otherwise(1.0)).alias("invalid_json_rate"),
        F.avg(F.when(F.col(label_col) == UNKNOWN, 1.0).otherwise(0.0)).alias("unknown_rate"),
    )
