"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

The network reads chunks of bytes (a word with the space after it; longer words in windows of
``CHUNK`` bytes) in both directions and gives every byte position a distribution over the
languages. A document's distribution is the normalised geometric mean over all its positions.
A chunk's labels do not depend on its surroundings, so each distinct word of a slice runs once.

``train`` learns by backpropagation through time on the driver, from a bounded sample:
at most ``PER_LANGUAGE`` documents a language, ``TRAIN_CHARS`` characters of each, taken by the
smallest hash of the id. The ``MAX_LANGUAGES`` most frequent labels are learned.
Prediction is one map over whole texts.

Defined cases: null text, or text without a letter, is ``und`` with score 0; with no labelled
row everything is ``und``; null languages and null ids never train; equal probabilities go to
the first language in alphabetical order; repeated rows are predicted one by one; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.llm.arrays import text_slices

CHUNK = 30
HIDDEN = 16
EPOCHS = 4
LEAST_STEPS = 400
PER_LANGUAGE = 150
TRAIN_CHARS = 1_000
MAX_LANGUAGES = 500
MEMO_WORDS = 200_000
#: Bytes of text looked at together; sums of its words are held several times over.
SLICE = 2_000_000
LONGEST_REMEMBERED = 64
UNDETERMINED = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def split_chunks(word: bytes) -> list[bytes]:
    word += b" "
    return [word[i : i + CHUNK] for i in range(0, len(word), CHUNK)]


class ByteGRU:
    """``x``: input weights by byte, ``u``: recurrent weights, per direction; gates z, r, n side by side."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.w = {}
        for way in "fb":
            self.w["x" + way] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.w["u" + way] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)
        self.w["o"] = rng.normal(0, 0.1, (2 * hidden, len(languages))).astype(np.float32)
        self.w["c"] = np.zeros(len(languages), np.float32)

    def _states(self, data: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """Hidden states, (length, rows, hidden), for rows of equal length; reads backwards for ``b``."""
        h_size, (rows, length) = self.hidden, data.shape
        x, u = self.w["x" + way], self.w["u" + way]
        states = np.empty((length, rows, h_size), np.float32)
        h = np.zeros((rows, h_size), np.float32)
        for t in range(length) if way == "f" else range(length - 1, -1, -1):
            a, b = x[data[:, t]], h @ u
            gates = _sigmoid(a[:, : 2 * h_size] + b[:, : 2 * h_size])
            z, r = gates[:, :h_size], gates[:, h_size:]
            n = np.tanh(a[:, 2 * h_size :] + r * b[:, 2 * h_size :])
            if keep is not None:
                keep.append((t, h, z, r, n, b[:, 2 * h_size :]))
            h = n + z * (h - n)
            states[t] = h
        return states

    def log_probabilities(self, data: np.ndarray) -> np.ndarray:
        """Label of every position: (length, rows, languages) log probabilities."""
        o, h_size = self.w["o"], self.hidden
        logits = self._states(data, "f") @ o[:h_size] + self._states(data, "b") @ o[h_size:] + self.w["c"]
        logits -= logits.max(axis=2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over positions and its gradients, by backpropagation through time."""
        h_size, (rows, length) = self.hidden, data.shape
        steps = {"f": [], "b": []}
        states = {way: self._states(data, way, steps[way]) for way in "fb"}
        both = np.concatenate([states["f"], states["b"]], axis=2)
        logits = both @ self.w["o"] + self.w["c"]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        loss = -float(np.log(p[:, np.arange(rows), labels] + 1e-12).mean())
        p[:, np.arange(rows), labels] -= 1
        p /= rows * length
        grads = {"o": np.tensordot(both, p, axes=([0, 1], [0, 1])), "c": p.sum(axis=(0, 1))}
        up, one_hot = p @ self.w["o"].T, np.eye(256, dtype=np.float32)
        for way, part in (("f", up[:, :, :h_size]), ("b", up[:, :, h_size:])):
            u = self.w["u" + way]
            dx, du = np.zeros_like(self.w["x" + way]), np.zeros_like(u)
            dh = np.zeros((rows, h_size), np.float32)
            for t, h, z, r, n, bn in reversed(steps[way]):
                dh = dh + part[t]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * bn * r * (1 - r)
                into_x = np.concatenate([dz, dr, dn], axis=1)
                into_u = np.concatenate([dz, dr, dn * r], axis=1)
                dx += one_hot[data[:, t]].T @ into_x
                du += h.T @ into_u
                dh = dh * z + into_u @ u.T
            grads["x" + way], grads["u" + way] = dx, du
        return loss, grads


def train(texts: list[str], labels: list[str], epochs: int = EPOCHS, seed: int = 1) -> ByteGRU:
    """Fit a network in ``epochs``, more for few batches; a word counts once per document."""
    languages = sorted(set(labels))
    model, number = ByteGRU(languages, seed=seed), {name: i for i, name in enumerate(languages)}
    by_length: dict[int, list[tuple[bytes, int]]] = {}
    for text, label in zip(texts, labels, strict=True):
        for word in dict.fromkeys(text.encode().split()):
            for chunk in split_chunks(word):
                by_length.setdefault(len(chunk), []).append((chunk, number[label]))
    batches = []
    for _, rows in sorted(by_length.items()):
        order = np.random.default_rng(seed).permutation(len(rows))
        for at in range(0, len(rows), 256):
            part = [rows[i] for i in order[at : at + 256]]
            data = np.frombuffer(b"".join(chunk for chunk, _ in part), np.uint8).reshape(len(part), -1)
            batches.append((data, np.array([label for _, label in part])))
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    rng, step = np.random.default_rng(seed), 0
    epochs = max(epochs, -(-LEAST_STEPS // max(1, len(batches))))
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        for at in rng.permutation(len(batches)):
            _, grads = model.gradients(*batches[at])
            step += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                scale = rate / (1 - 0.9**step)
                model.w[k] -= scale * first[k] / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


class Labeller:
    """Sums of log probabilities per word, remembered as long as the labeller lives."""

    def __init__(self, model: ByteGRU):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.sums = np.zeros((1024, len(self.model.languages)), np.float32)
        self.counts = np.zeros(1024, np.int64)

    def label(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities added over all positions of each word, and its number of positions."""
        chunks, owners = [], []
        for i, word in enumerate(words):
            parts = split_chunks(word)
            chunks += parts
            owners += [i] * len(parts)
        owner = np.array(owners, np.int64)
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        sums = np.zeros((len(words), len(self.model.languages)), np.float32)
        for length in np.unique(lengths):
            picked = np.flatnonzero(lengths == length)
            for at in range(0, len(picked), 8192):
                part = picked[at : at + 8192]
                data = np.frombuffer(b"".join([chunks[i] for i in part]), np.uint8).reshape(len(part), length)
                np.add.at(sums, owner[part], self.model.log_probabilities(data).sum(axis=0))
        return sums, np.bincount(owner, lengths, minlength=len(words)).astype(np.int64)

    def _look_up(self, words: list[str]) -> np.ndarray:
        rows = self.rows
        new = [word for word in words if word not in rows]
        if new:
            sums, counts = self.label([word.encode() for word in new])
            first = len(rows)
            need = first + len(new)
            if need > len(self.counts):
                more = max(need, 2 * len(self.counts)) - len(self.counts)
                self.sums = np.concatenate([self.sums, np.zeros((more, self.sums.shape[1]), np.float32)])
                self.counts = np.concatenate([self.counts, np.zeros(more, np.int64)])
            self.sums[first:need], self.counts[first:need] = sums, counts
            rows.update(zip(new, range(first, need), strict=True))
        return np.fromiter(map(rows.__getitem__, words), np.int64, len(words))

    def predict(self, text: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        if len(self.rows) > MEMO_WORDS:
            self._clear()
        plain = pc.replace_substring(pc.replace_substring(text, "\n", " "), "\t", " ")
        lists = pc.split_pattern(plain, " ")
        words = lists.flatten().dictionary_encode()
        distinct, codes = words.dictionary, np.asarray(words.indices, np.int64)
        long = np.asarray(pc.binary_length(distinct), np.int64) > LONGEST_REMEMBERED
        sums = np.zeros((len(distinct), len(self.model.languages)), np.float64)
        counts = np.zeros(len(distinct), np.int64)
        short = self._look_up(distinct.filter(pa.array(~long)).to_pylist())
        sums[~long], counts[~long] = self.sums[short], self.counts[short]
        if long.any():
            sums[long], counts[long] = self.label([w.encode() for w in distinct.filter(pa.array(long)).to_pylist()])
        stops = np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))
        running = np.concatenate([np.zeros((1, sums.shape[1])), np.cumsum(sums[codes], axis=0)])
        places = np.concatenate([[0], np.cumsum(counts[codes])])
        starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)
        total = np.maximum(places[stops] - places[starts], 1)
        mean = (running[stops] - running[starts]) / total[:, None]
        mean -= mean.max(axis=1, keepdims=True)
        p = np.exp(mean)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        lettered = np.asarray(pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False), bool)
        names = [self.model.languages[i] if ok else UNDETERMINED for i, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, p[np.arange(len(best)), best], 0.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """(text, lang) of at most ``per_language`` rows a language that are not held out.

    Labels are counted first (a narrow read), so that the second pass keeps about twice as
    many rows as wanted; the driver then takes those of smallest hash.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return []
    # Copies share a text, so the key is the id; 2^30 steps are enough for 1e12 rows a language.
    steps = 1 << 30
    shares = F.create_map(
        *[F.lit(v) for row in counts for v in (row["lang"], min(steps, (2 * per_language + 30) * steps // row["count"]))]
    )
    key = F.pmod(F.xxhash64("doc_id"), F.lit(steps))
    rows = (
        usable.filter(key < F.try_element_at(shares, F.col("lang")))
        .select("lang", F.xxhash64("doc_id").alias("key"), F.substring("text", 1, TRAIN_CHARS).alias("text"))
        .filter(F.col("text").rlike(r"\p{L}"))
        .collect()
    )
    taken: dict[str, int] = {}
    sample = []
    for row in sorted(rows, key=lambda r: (r["lang"], r["key"], r["text"])):
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= per_language:
            sample.append((row["text"], row["lang"]))
    return sample


def _predict(packed, carried: list[str]):
    """Columns ``carried``, language and score of every row, by the model in the broadcast ``packed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The memo goes with the task: the same worker serves later stages, which need the room.
        labeller = Labeller(pickle.loads(packed.value))
        for batch in batches:
            found, scores = [], []
            for part in text_slices([batch.select(["text"])], SLICE):
                languages, values = labeller.predict(part.column("text"))
                found += languages
                scores.append(values)
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in carried], pa.array(found, pa.string()), pa.array(scores)],
                [*carried, "lang_pred", "score"],
            )

    return run


def _predicted(docs: DataFrame, columns: list[str], per_language: int) -> DataFrame:
    """``columns`` of ``docs`` as ``c0``, ``c1``, ... with ``held_out, lang_pred, score``.

    Own names inside keep columns of any name apart; only ``text`` is read by the network.
    """
    sample = training_sample(docs.select("doc_id", "text", "lang"), per_language)
    names = [f"c{i}" for i in range(len(columns))]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)],
        F.col("text").cast("string").alias("text"),
        held_out(F.col("doc_id")).alias("held_out"),
    )
    if not sample:
        return rows.select(*names, "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    model = train([text for text, _ in sample], [lang for _, lang in sample])
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    carried = [*names, "held_out"]

    schema = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in carried)
    return rows.mapInArrow(_predict(packed, carried), f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for whole texts of ``doc_id, text, lang``."""
    return _predicted(docs, ["doc_id"], per_language).withColumnRenamed("c0", "doc_id")


#: Documents whose best language scores less are rejected by ``with_language``.
MIN_SCORE = 0.5


def with_language(docs: DataFrame, per_language: int = PER_LANGUAGE, min_score: float = MIN_SCORE) -> DataFrame:
    """Rows of ``docs`` whose language can be told, with ``lang`` filled in where it is null.

    A row goes if it has no letter or its best language scores less than ``min_score``. Where no row
    has a language to learn from, nothing can be told and all rows stay as they are. Columns stay.
    """
    if docs.filter("lang IS NOT NULL AND text IS NOT NULL").isEmpty():
        return docs
    told = _predicted(docs, docs.columns, per_language)
    kept = told.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
    names = {f"c{i}": name for i, name in enumerate(docs.columns)}
    filled = [
        F.coalesce(c, "lang_pred").alias(name) if name == "lang" else F.col(c).alias(name) for c, name in names.items()
    ]
    return kept.select(*filled)
