import numpy as np
import pytest

from seedloom.llm import embeddings as E
from seedloom.llm.components import connected_components
from tests.llm import brute


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<float>, label int, links string")


def expected(rows, threshold):
    usable = {}
    for i, v, label in rows:
        if label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v, np.float32).astype(float)
        usable[i] = (v / np.linalg.norm(v), label)
    ids, links = sorted(usable), {r[0]: 0 for r in rows}
    linked = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            (x, one), (y, other) = usable[a], usable[b]
            if one == other and len(x) == len(y) and x @ y >= threshold:
                links[a] += 1
                links[b] += 1
                linked.append((a, b))
    root = brute.least_of_groups([r[0] for r in rows], linked)
    return {i: (links[i], root[i], root[i] == i) for i in links}


def made():
    rng = np.random.default_rng(6)
    rows = []
    for label in range(3):
        for _ in range(40):
            base = rng.normal(size=8)
            for noise in (0, 0.05, 0.07, 0.2):
                rows.append(((base + noise * rng.normal(size=8)).astype(np.float32).tolist(), label))
    rows += [(rows[0][0], 0)] * 5 + [(rows[0][0], 1), ([2 * x for x in rows[0][0]], 0), ([-x for x in rows[0][0]], 0)]
    rows += [(None, 0), ([], 0), ([0.0] * 8, 0), ([float("nan")] + [1.0] * 7, 0), ([float("inf")] + [1.0] * 7, 0)]
    rows += [([None] + [1.0] * 7, 0), (rows[0][0], None), (rows[0][0][:4], 0), (rows[0][0][:4], 0), ([0.0, -0.0, 1.0], 2)]
    order = rng.permutation(len(rows))
    return [(int(i) * 3, *rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize(("tile", "threshold"), [(1024, 0.98), (16, 0.98), (9, 0.6)])
def test_against_brute_force(spark, tile, threshold):
    rows = made()
    got = {r[0]: tuple(r[1:]) for r in E.near_duplicates(frame(spark, rows), threshold, tile=tile).collect()}
    assert got == expected(rows, threshold)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(300, 64)) * rng.uniform(0, 1, (1, 64)) ** 4
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    q, s, e = E.quantise(unit)
    close = (q.astype(float) @ q.astype(float).T) / (s[:, None] * s)
    assert (np.abs(close - unit @ unit.T) <= e[:, None] + (1 + e[:, None]) * e + E.ROUNDING).all()


def test_repeated_rows_and_empty_table(spark):
    v = [1.0, 2.0]
    rows = frame(spark, [(5, v, 1), (5, v, 1), (7, v, 1), (None, v, 1)])
    got = sorted(map(tuple, E.near_duplicates(rows).collect()), key=repr)
    assert got == sorted([(5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (None, 0, None, True)], key=repr)
    assert E.near_duplicates(rows.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, i) for i in range(1001, 1200)]
    noise = [tuple(map(int, rng.integers(2000, 2300, 2))) for _ in range(200)]
    edges = [(b, a) if k % 2 else (a, b) for k, (a, b) in enumerate(path + star + noise)]
    got = {r.id: r.component_id for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = sorted({x for e in edges if e[0] != e[1] for x in e})
    assert got == brute.least_of_groups(ids, [e for e in edges if e[0] != e[1]])
