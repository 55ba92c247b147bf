"""Order-exact greedy acceptance of candidates, with a ledger of every decision.

Candidates are taken in ``seq`` order: a row is accepted unless its label is full, its
text or judge reply is unusable, or it is too similar to a seed or to a row accepted
before it. What the loop would take one by one is decided in parallel rounds. Without
quotas, the accepted rows are the lexicographically first independent set of the
similarity relation: in a round every undecided row finds its first similar undecided
row before it; rows without one are accepted, rows whose first is accepted leave, and the
few others are compared with what the round accepted. No pair is a row anywhere: a row
keeps the smallest ``seq`` it meets, so a group of near copies, however large, is decided in
one round. Rounds grow with the longest chain of rows that only hold each other; the last
rows (``LAST_ROWS``) are decided in order.

Quotas cut labels at the place of their last accepted row, found by counts over prefixes of
``seq``. Rows that only a cut-off row had held come up again; the loop goes back to the first of
them, and all decisions before it stand. Work goes in windows of ``seq``, so rows behind a full
target are never compared. The driver sees counts per label and places, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seedloom.functions.shingles import jaccard_of, unpack_codes
from seedloom.operators import near_copies
from seedloom.operators.quota import MAX_LOOPS
from seedloom.operators.ranking import cutoff_keys
from seedloom.operators.responses import is_valid_candidate
from seedloom.operators.similarity import (
    JACCARD_THRESHOLD,
    SEMANTIC_THRESHOLD,
    VECTOR_INDEX,
    codes_of,
    first_similar,
    flagged,
    top_similarity,
)
from seedloom.operators.tiles import matrix
from seedloom.session import cut_lineage, spread_small, written

#: Undecided rows, about, that are taken up at a time: the earliest ones.
WINDOW_ROWS = 1_000_000
#: Rows of a window that are decided in order once rounds have left no more.
LAST_ROWS = 512

ACCEPTED, REJECTED = "accepted", "rejected"
QUOTA_FULL, INVALID_TEXT, JUDGE_PARSE, LOW_SCORE = "quota_full", "invalid_text", "judge_parse", "low_score"
EXACT_DUPLICATE, REDUNDANT, TARGET_REACHED = "exact_duplicate", "redundant", "target_reached"
NOT_REACHED = "not_reached"


@dataclass
class Progress:
    """Decisions so far: what was accepted, and where labels and the whole run got full."""

    quota: dict[str, int]
    target: int
    counts: dict[str, int] = field(default_factory=dict)
    cut: dict[str, int] = field(default_factory=dict)
    stop_seq: int | None = None
    #: Undecided and newly accepted rows of every round.
    rounds: list[tuple[int, int]] = field(default_factory=list)

    def full(self, label: str) -> bool:
        return self.counts.get(label, 0) >= self.quota.get(label, 0)

    def done(self) -> bool:
        return sum(self.counts.values()) >= self.target

    def open_labels(self) -> list[str]:
        return [label for label in self.quota if not self.full(label)]


def gate_reason(candidates: DataFrame) -> DataFrame:
    """Add ``gate``: why a candidate can never be accepted, or NULL.

    Needs ``cleaned_text, judge_status``; an ``is_copy`` column adds the guard against seed copies.
    """
    gate = F.when(~F.coalesce(is_valid_candidate("cleaned_text"), F.lit(False)), INVALID_TEXT).when(
        F.col("judge_status") != "ok", F.col("judge_status")
    )
    if "is_copy" in candidates.columns:
        gate = gate.when(F.col("is_copy"), EXACT_DUPLICATE)
    return candidates.withColumn("gate", gate)


def greedy_accept(
    candidates: DataFrame,
    quota: dict[str, int],
    target: int,
    seed_index: DataFrame | None = None,
    threshold: float = SEMANTIC_THRESHOLD,
    window: int = WINDOW_ROWS,
    collected: dict[str, int] | None = None,
    use_minhash: bool = False,
    seed_texts: DataFrame | None = None,
    exact_guard: bool = False,
) -> tuple[DataFrame, Progress]:
    """Decide every candidate. Returns ``seq, label, status, reason, max_similarity`` and the tally.

    ``candidates``: ``seq`` (unique order), ``label``, ``gate`` and ``embedding`` (unit vector;
    without that column vectors are not compared); with ``use_minhash`` or ``exact_guard`` also
    ``cleaned_text``. ``seed_index``: ``embedding`` of the seed texts and earlier accepted rows;
    ``seed_texts`` (``cleaned_text``) are their texts. ``exact_guard`` rejects copies of a seed
    text and of an accepted row. ``collected`` are rows accepted per label in earlier rounds.
    """
    progress = Progress(dict(quota), target, dict(collected or {}))
    kinds = _Kinds("embedding" in candidates.columns, use_minhash, exact_guard, threshold)
    # The narrow columns are read many times; the parsing and sketching behind them runs once.
    candidates = kinds.narrowed(candidates, ["seq", "label", "gate"])
    seeds = _seeds(kinds, seed_index, seed_texts)
    rows = candidates.filter(F.col("gate").isNull() & F.col("label").isin(progress.open_labels())).drop("gate")
    if seeds and not progress.done():
        rows = cut_lineage(kinds.unlike(rows, seeds))
    accepted: DataFrame = candidates.filter("false").select("seq", "label")
    while not progress.done():
        head, last = _earliest(rows, window)
        fresh = _decide_window(head, kinds, progress)
        _count(fresh, progress)
        accepted = accepted.unionByName(fresh.select("seq", "label"))
        if last is None or progress.done():
            break
        later = rows.filter((F.col("seq") > last) & F.col("label").isin(progress.open_labels()))
        rows = cut_lineage(kinds.unlike(later, [fresh]))
    return _ledger(candidates, accepted, progress, seeds, kinds), progress


def _earliest(rows: DataFrame, window: int) -> tuple[DataFrame, int | None]:
    """Rows up to a ``seq`` that about ``window`` rows reach, and that place (None: all rows)."""
    n = rows.count()
    if n <= window:
        return rows, None
    last = rows.agg(F.percentile_approx("seq", window / n, 1000)).first()[0]
    return rows.filter(F.col("seq") <= last), last


def _decide_window(rows: DataFrame, kinds: _Kinds, progress: Progress) -> DataFrame:
    """Rows that the loop accepts among ``rows``, given what was accepted before."""
    before: DataFrame | None = None
    while True:
        taken = kinds.independent(rows, progress)
        if before is not None:
            taken = before.unionByName(taken)
        cuts, stop = _cuts(taken, progress)
        if not cuts and stop is None:
            return taken
        open_place = F.lit(True)
        for label, place in cuts.items():  # a cut per category of the quota plan
            open_place = open_place & ((F.col("label") != label) | (F.col("seq") <= place))
        if stop is not None:
            open_place = open_place & (F.col("seq") <= stop)
        kept = taken.filter(open_place)
        cut_off = taken.filter(~open_place).agg(F.min("seq")).first()[0]
        if cut_off is None:
            return kept
        # Rows behind a cut-off row that were left out, and that no kept row before them holds.
        left_out = rows.filter((F.col("seq") > cut_off) & open_place).join(taken.select("seq"), "seq", "left_anti")
        left_out = cut_lineage(left_out)
        if left_out.isEmpty():
            return kept
        freed = kinds.free(left_out, kept).agg(F.min("seq")).first()[0]
        if freed is None:
            return kept
        before = cut_lineage(kept.filter(F.col("seq") < freed))
        counts = dict(progress.counts)
        for row in before.groupBy("label").count().collect():
            counts[row["label"]] = counts.get(row["label"], 0) + row["count"]
        open_labels = [label for label, n in progress.quota.items() if counts.get(label, 0) < n]
        rest = rows.filter((F.col("seq") >= freed) & F.col("label").isin(open_labels))
        rows = cut_lineage(kinds.unlike(rest, [before]))


def _cuts(taken: DataFrame, progress: Progress) -> tuple[dict[str, int], int | None]:
    """Place of the last row each overfull label may accept, and of the last one the target allows."""
    counts = {row["label"]: row["count"] for row in taken.groupBy("label").count().collect()}
    room = {label: progress.quota[label] - progress.counts.get(label, 0) for label in counts}
    cuts = _places(taken, {label: room[label] for label, n in counts.items() if n > room[label]})
    kept = sum(min(n, room[label]) for label, n in counts.items())
    left = progress.target - sum(progress.counts.values())
    if kept <= left:
        return cuts, None
    within = F.lit(True)
    for label, place in cuts.items():
        within = within & ((F.col("label") != label) | (F.col("seq") <= place))
    everything = taken.filter(within).withColumn("label", F.lit("all"))
    return cuts, _places(everything, {"all": left})["all"]


def _places(rows: DataFrame, ranks: dict[str, int]) -> dict[str, int]:
    """``seq`` of the n-th row of each label in ``ranks``."""
    if not ranks:
        return {}
    shift = 1 << 62
    keyed = rows.select("label", F.lpad(F.hex(F.col("seq") + shift), 16, "0").alias("key"))
    found = cutoff_keys(keyed, "label", "key", {label: [n] for label, n in ranks.items()}).collect()
    return {row["label"]: int(row["cutoff"], 16) - shift for row in found}


@dataclass
class _Kinds:
    """What makes two rows too similar: vectors, near-copied texts, equal texts."""

    vectors: bool
    near_texts: bool
    equal_texts: bool
    threshold: float
    #: Packed shingle sets of all rows (``id, digest, codes``), read where a pair is verified.
    codes: DataFrame | None = None

    def narrowed(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """A table of ``columns`` and what rows are compared by. Texts are read here only: digests and
        bitmaps stand for them, and packed sets go to ``codes``."""
        texts = "cleaned_text" in rows.columns
        kept = rows.select(
            *columns,
            *["embedding"] * (self.vectors and "embedding" in rows.columns),
            *[F.sha2("cleaned_text", 256).alias("text_digest")] * (self.equal_texts and texts),
            *[F.col("cleaned_text").alias("text"), F.col("seq").cast("long").alias("id")] * (self.near_texts and texts),
        )
        if not (self.near_texts and texts):
            return cut_lineage(kept)
        table = written(near_copies.sketched(spread_small(kept, "seq"), JACCARD_THRESHOLD), "candidate-sketches")
        codes = table.select("id", "digest", "codes")
        self.codes = codes if self.codes is None else self.codes.unionAll(codes)
        return table.drop("codes", "id")

    def first_like(self, rows: DataFrame, other: DataFrame | None = None) -> DataFrame | None:
        """``seq, first``: of rows that are like one of ``other``, the smallest ``seq`` of those; without
        ``other``, of rows that are like an earlier row. None if nothing can be compared."""
        found, against = [], rows if other is None else other
        if self.vectors and "embedding" in against.columns:
            own = rows.select("seq", "embedding")
            found.append(first_similar(own, None if other is None else other.select("seq", "embedding"), self.threshold))
        if self.near_texts and "bits" in against.columns:
            own, others = _sketches(rows), None if other is None else _sketches(other)
            flags = flagged(own, others, JACCARD_THRESHOLD, self.codes, self.codes).filter("status = 'near_dup'")
            found.append(flags.select(F.col("id").alias("seq"), F.col("dup_of").alias("first")))
        if self.equal_texts and "text_digest" in against.columns:
            firsts = against.groupBy("text_digest").agg(F.min("seq").alias("first"))
            met = rows.select("seq", "text_digest").join(firsts, "text_digest")
            found.append(met.filter("first < seq" if other is None else "true").select("seq", "first"))
        if not found:
            return None
        return _union(found[1:], found[0]).groupBy("seq").agg(F.min("first").alias("first"))

    def unlike(self, rows: DataFrame, others: list[DataFrame]) -> DataFrame:
        """Rows that are like none of ``others``, each with the columns it is compared by."""
        for other in others:
            like = self.first_like(rows, other)
            rows = rows if like is None else rows.join(like, "seq", "left_anti")
        return rows

    def free(self, rows: DataFrame, other: DataFrame) -> DataFrame:
        """Rows that are like none of ``other`` before them."""
        like = self.first_like(rows, other)
        return rows if like is None else rows.join(like.filter("first < seq"), "seq", "left_anti")

    def independent(self, rows: DataFrame, progress: Progress) -> DataFrame:
        """The rows that a loop without quotas accepts: like no accepted row before them."""
        accepted: list[DataFrame] = []
        while n := rows.count():
            if n <= LAST_ROWS:
                accepted.append(cut_lineage(self.in_order(rows)))
                progress.rounds.append((n, accepted[-1].count()))
                break
            held = self.first_like(rows)
            if held is None:
                accepted.append(rows)
                progress.rounds.append((n, n))
                break
            held = cut_lineage(held)
            fresh = cut_lineage(rows.join(held, "seq", "left_anti"))
            accepted.append(fresh)
            progress.rounds.append((n, n - held.count()))
            # Rows whose first is accepted are settled; the others may still be like another one.
            unsettled = cut_lineage(held.join(fresh.select(F.col("seq").alias("first")), "first", "left_anti").select("seq"))
            if unsettled.isEmpty():
                break
            rows = cut_lineage(self.unlike(rows.join(unsettled, "seq", "left_semi"), [fresh]))
        return _union(accepted, rows.filter("false"))

    def in_order(self, rows: DataFrame) -> DataFrame:
        """``independent`` of a bounded table, row by row in one task."""
        flags = (self.vectors, self.near_texts, self.equal_texts, self.threshold)
        schema = rows.schema
        if self.near_texts:
            own = _sketches(rows)
            codes = codes_of(own, (own, self.codes)).withColumnRenamed("id", "seq")
            rows = rows.join(codes, "seq").select(*schema.names, "codes")
        # One task for these few rows, and not for the tables they come from.
        return rows.repartition(1).sortWithinPartitions("seq").mapInArrow(_decider(flags), schema)


def _sketches(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("seq").cast("long").alias("id"), "n_shingles", "digest", "bits")


#: Digest of the empty text.
_EMPTY = hashlib.sha256(b"").hexdigest()


class _Accepted:
    """Rows accepted in order, and whether another is like one of them."""

    def __init__(self, by_vectors: bool, by_near_texts: bool, by_equal_texts: bool, threshold: float):
        self.by_vectors, self.by_near_texts, self.by_equal_texts = by_vectors, by_near_texts, by_equal_texts
        self.threshold, self.count = threshold, 0
        self.vectors: np.ndarray | None = None
        self.sets: list[np.ndarray] = []
        self.texts: set[str] = set()

    def take(self, vector: np.ndarray | None, codes: bytes | None, digest: str | None) -> bool:
        digest = digest or _EMPTY
        if self.by_equal_texts and digest in self.texts:
            return False
        if self.by_vectors and self.count and (self.vectors[: self.count] @ vector).max() >= self.threshold:
            return False
        if self.by_near_texts:
            codes = unpack_codes(codes)
            if any(jaccard_of(codes, other) >= JACCARD_THRESHOLD for other in self.sets):
                return False
            self.sets.append(codes)
        if self.by_equal_texts:
            self.texts.add(digest)
        if self.by_vectors:
            if self.vectors is None:
                self.vectors = np.empty((64, len(vector)))
            if self.count == len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
            self.vectors[self.count] = vector
        self.count += 1
        return True


def _decider(flags: tuple[bool, bool, bool, float]):
    """Function over the sorted batches of a bounded table; it holds nothing that belongs to a session."""
    by_vectors, by_near_texts, by_equal_texts, _ = flags

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Accepted(*flags)
        for batch in batches:
            vectors = matrix(batch.column("embedding")) if by_vectors else None
            codes = batch.column("codes").to_pylist() if by_near_texts else None
            digests = batch.column("text_digest").to_pylist() if by_equal_texts else None
            taken = [
                index.take(None if vectors is None else vectors[row], codes and codes[row], digests and digests[row])
                for row in range(batch.num_rows)
            ]
            kept = batch.filter(pa.array(taken, pa.bool_()))
            yield kept.select([name for name in kept.schema.names if name != "codes"])

    return run


def _union(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    for frame in frames:
        empty = empty.unionAll(frame)
    return empty


def _seeds(kinds: _Kinds, seed_index: DataFrame | None, seed_texts: DataFrame | None) -> list[DataFrame]:
    """Seed vectors and texts with numbers of their own below zero, which spread them over tiles."""
    number = (-1 - F.monotonically_increasing_id()).alias("seq")
    seeds = []
    if kinds.vectors and seed_index is not None:
        seeds.append(kinds.narrowed(seed_index.select(number, "embedding"), ["seq"]))
    if (kinds.near_texts or kinds.equal_texts) and seed_texts is not None:
        seeds.append(kinds.narrowed(seed_texts.select(number, "cleaned_text"), ["seq"]))
    return seeds


def _count(fresh: DataFrame, progress: Progress) -> None:
    """Add accepted rows to the tally; note where labels and the run got full."""
    for row in fresh.groupBy("label").agg(F.count("*").alias("n"), F.max("seq").alias("last")).collect():
        progress.counts[row["label"]] = progress.counts.get(row["label"], 0) + row["n"]
        if progress.full(row["label"]):
            progress.cut[row["label"]] = row["last"]
    if progress.done():
        progress.stop_seq = fresh.agg(F.max("seq")).first()[0]


def _ledger(
    candidates: DataFrame, accepted: DataFrame, progress: Progress, seeds: list[DataFrame], kinds: _Kinds
) -> DataFrame:
    spark = candidates.sparkSession
    # The label table has one row per category of the quota plan.
    limits = F.broadcast(
        spark.createDataFrame(
            [(label, progress.cut.get(label), n <= 0 or (label not in progress.cut and progress.full(label)))
             for label, n in progress.quota.items()],
            "label string, _cut bigint, _closed boolean",
        )
    )
    past_target = F.lit(False) if progress.stop_seq is None else F.col("seq") > progress.stop_seq
    if progress.stop_seq is None and progress.done():
        past_target = F.lit(True)  # the target had been reached before this round
    past_cut = F.coalesce(F.col("_closed"), F.lit(True)) | F.coalesce(F.col("seq") > F.col("_cut"), F.lit(False))
    marked = candidates.join(accepted.select("seq", F.lit(True).alias("_accepted")), "seq", "left")
    copied = F.lit(False)
    if kinds.equal_texts:
        marked = marked.withColumnRenamed("text_digest", "_digest")
        taken = marked.filter("_accepted").groupBy("_digest").agg(F.min("seq").alias("_first"))
        known = _union([s.select(F.col("text_digest").alias("_digest")) for s in seeds if "text_digest" in s.columns],
                       taken.select("_digest").filter("false"))
        known = known.distinct().withColumn("_seed", F.lit(True))
        marked = marked.join(taken, "_digest", "left").join(known, "_digest", "left")
        copied = F.coalesce(F.col("_seed"), F.col("seq") > F.col("_first"), F.lit(False))
    reason = (
        F.when(F.col("_accepted"), F.lit(None).cast("string"))
        .when(past_target, TARGET_REACHED)
        .when(past_cut, QUOTA_FULL)
        .when(F.col("gate").isNotNull(), F.col("gate"))
        .when(copied, EXACT_DUPLICATE)
        .otherwise(REDUNDANT)
    )
    status = F.when(F.col("_accepted"), ACCEPTED).otherwise(REJECTED)
    vectors = ["embedding"] * kinds.vectors
    decided = marked.join(limits, "label", "left").select(
        "seq", "label", *vectors, status.alias("status"), reason.alias("reason")
    )
    if not kinds.vectors:
        return decided.withColumn("max_similarity", F.lit(None).cast("double"))
    decided = cut_lineage(decided)
    compared = decided.filter((F.col("status") == ACCEPTED) | (F.col("reason") == REDUNDANT))
    index = _union(
        [s.select("seq", "embedding") for s in seeds if "embedding" in s.columns],
        decided.filter(F.col("status") == ACCEPTED).select("seq", "embedding"),
    )
    similarity = top_similarity(compared.select("seq", "embedding"), index, earlier_only=True)
    return decided.drop("embedding").join(similarity, "seq", "left")


def candidate_ledger(candidates: DataFrame, decisions: DataFrame, provenance: list[str]) -> DataFrame:
    """Decisions beside scores, raw replies that could not be parsed, and provenance columns."""
    raw = [F.when(F.col("judge_status") == JUDGE_PARSE, F.col("judge_raw_output")).alias("judge_raw_output")]
    if {"generated_text", "batch_status"} <= set(candidates.columns):
        unparsed = F.col("batch_status") == "empty"
        raw.append(F.when(unparsed, F.col("generated_text")).alias("generator_raw_output"))
    details = candidates.select("seq", F.col("cleaned_text").alias("text"), "overall_score", *raw, *provenance)
    return decisions.join(details, "seq")


def accepted_rows(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("status") == ACCEPTED).select("seq", "text", "label")


def manifest(ledger: DataFrame) -> DataFrame:
    """Counts by label and outcome with subtotals (NULL label or outcome = all)."""
    outcome = F.coalesce("reason", F.lit(ACCEPTED)).alias("outcome")
    return ledger.select("label", outcome).rollup("label", "outcome").agg(F.count("*").alias("n"))


def loop_progress(ledger: DataFrame) -> DataFrame:
    """Rows accepted per loop and label, with the running total of each label."""
    running = Window.partitionBy("label").orderBy("loop").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ledger.filter(F.col("status") == ACCEPTED)
        .groupBy("loop", "label")
        .agg(F.count("*").alias("added"))
        .withColumn("collected", F.sum("added").over(running))
    )


def accept_in_loops(
    batches: list[DataFrame],
    quota: dict[str, int],
    target: int,
    seed_index: DataFrame | None = None,
    threshold: float = SEMANTIC_THRESHOLD,
    window: int = WINDOW_ROWS,
    max_loops: int = MAX_LOOPS,
) -> DataFrame:
    """Decide successive response batches until the target is met or the loops run out.

    Each batch is gated candidates as for ``greedy_accept``; accepted rows join the index
    of later batches. Returns decisions of all batches, with ``loop``; rows of batches behind
    the target or ``max_loops`` are rejected as ``not_reached``.
    """
    collected: dict[str, int] = {}
    decisions: DataFrame | None = None
    spark = batches[0].sparkSession
    index = spark.createDataFrame([], VECTOR_INDEX) if seed_index is None else seed_index
    index = index.select("embedding")
    for loop, batch in enumerate(batches, start=1):
        if loop > max_loops or sum(collected.values()) >= target:
            decided = batch.select(
                "seq",
                "label",
                F.lit(REJECTED).alias("status"),
                F.lit(NOT_REACHED).alias("reason"),
                F.lit(None).cast("double").alias("max_similarity"),
                F.lit(loop).alias("loop"),
            )
        else:
            decided, progress = greedy_accept(batch, quota, target, index, threshold, window, collected)
            decided = cut_lineage(decided.withColumn("loop", F.lit(loop)))
            collected = progress.counts
            fresh = decided.filter(F.col("status") == ACCEPTED).select("seq")
            index = cut_lineage(index.unionByName(batch.join(fresh, "seq", "left_semi").select("embedding")))
        decisions = decided if decisions is None else decisions.unionByName(decided)
    return decisions
