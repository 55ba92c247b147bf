import random
import zlib

import numpy as np
import pytest

from seedloom.llm import language as L

WORDS = {
    "aa": ["thon", "ther", "ing", "ed", "with"],
    "bb": ["ßer", "über", "schön", "ung", "keit"],
    "cc": ["qué", "año", "ción", "los", "más"],
}


def made(count, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        lang = rng.choice(sorted(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(3, 40))), lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double"
    )


def test_gradients_against_differences():
    model = L.ByteGRU(["a", "b", "c"], hidden=3, seed=2)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    rng = np.random.default_rng(1)
    data, labels = rng.integers(97, 100, (4, 5)).astype(np.uint8), rng.integers(0, 3, 4)
    _, grads = model.gradients(data, labels)
    for name, w in model.w.items():
        rows = list(np.ndindex(w.shape)) if w.size < 40 else [(97, 1), (98, 4), (99, 8)]
        for at in rows[:12]:
            kept = w[at]
            losses = []
            for step in (1e-3, -1e-3):
                w[at] = kept + step
                losses.append(model.gradients(data, labels)[0])
            w[at] = kept
            assert abs((losses[0] - losses[1]) / 2e-3 - grads[name][at]) < 2e-3


def test_held_out_accuracy(spark):
    rows = made(400)
    got = {r.doc_id: r for r in L.identify(frame(spark, rows), per_language=40).collect()}
    apart = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    right = sum(got[i].lang_pred == lang for i, _, lang in apart)
    assert right >= 0.97 * len(apart) and len(apart) > 50
    assert all(0 <= r.score <= 1 for r in got.values())


def test_sample_leaves_out_held_out_and_unlabelled(spark):
    rows = made(60)
    texts = {text for text, _ in L.training_sample(frame(spark, rows), 1000)}
    assert texts == {t[: L.TRAIN_CHARS] for i, t, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    bounded = L.training_sample(frame(spark, rows), 2)
    assert len(bounded) == 6


def test_defined_cases(spark):
    rows = made(80) + [(100, None, "aa"), (101, "", "bb"), (102, "12 %% 😀", None), (103, "thon " * 30_000, None)]
    rows += [(104, "x" * 100_000, None), (None, "über schön", "bb"), (105, rows[0][1], None)]
    got = {r.doc_id: r for r in L.identify(frame(spark, rows), per_language=20).collect()}
    assert len(got) == len(rows)
    assert [(got[i].lang_pred, got[i].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert got[103].lang_pred == "aa" and got[104].lang_pred in WORDS and got[None].lang_pred == "bb"
    assert (got[105].lang_pred, got[105].score) == (got[0].lang_pred, got[0].score)
    kept = L.with_language(frame(spark, rows), per_language=20)
    assert kept.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {100, 101, 102}


@pytest.mark.parametrize("rows", [[], [(1, "abc", None), (2, None, "aa")]])
def test_nothing_to_learn_from(spark, rows):
    got = L.identify(frame(spark, rows)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * len(rows)


def test_memo_does_not_change_results():
    model = L.train([t for _, t, _ in made(60)], [lang for _, _, lang in made(60)], epochs=1)
    import pyarrow as pa

    texts = [t for _, t, _ in made(30, seed=5)]
    together = L.Labeller(model).predict(pa.array(texts, pa.large_string()))
    for text, name, score in zip(texts, *together, strict=True):
        alone = L.Labeller(model).predict(pa.array([text], pa.large_string()))
        assert alone[0] == [name] and abs(alone[1][0] - score) < 1e-5


def test_memo_goes_with_the_task(monkeypatch):
    """A Python worker that goes on to other stages keeps nothing of the words it has looked up."""
    import gc
    import pickle
    import weakref
    from types import SimpleNamespace

    import pyarrow as pa

    model = L.train([t for _, t, _ in made(60)], [lang for _, _, lang in made(60)], epochs=1)
    seen = []

    class Watched(L.Labeller):
        def __init__(self, model):
            super().__init__(model)
            seen.append(weakref.ref(self))

    monkeypatch.setattr(L, "Labeller", Watched)
    batch = pa.RecordBatch.from_pydict({"c0": [1, 2], "text": ["some words", "some more"]})
    found = list(L._predict(SimpleNamespace(value=pickle.dumps(model)), ["c0"])(iter([batch, batch])))
    gc.collect()
    assert [b.num_rows for b in found] == [2, 2] and len(seen) == 1 and seen[0]() is None
