"""Near-duplicate vectors by int8 tile products with exact error bounds.

Only vectors with the same label are compared. Equal vectors fold into one with a count. The
distinct vectors are cut into tiles of about ``TILE``; large labels first by their nearest of at
most ``PIVOTS`` pivot vectors, so that tiles are narrow. A pair of tiles whose centres are
farther apart than their radii and the threshold's angle allow is never multiplied.

In a pair of tiles each unit vector is ``q / s + e`` with int8 ``q``; the length of ``e`` is
measured. The product of the int8 parts then misses the cosine by at most
``|e1| + (1 + |e1|) |e2|``. Pairs surely above or below the threshold are settled by that; only
the others are computed in double precision. A pair of tiles yields, per vector, its number of
links and the smallest id of its component there, so a group of n copies never makes n^2 rows.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite numbers, or whose
label is null, links with nothing; vectors of different lengths never link; repeated rows and ids
are vectors of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.llm.components import connected_components
from seedloom.session import cut_lineage

THRESHOLD = 0.98
TILE = 1024
PIVOTS = 64
#: Float32 rounding in scaling an exact integer product.
ROUNDING = 1e-5


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 parts, scales and lengths of the errors of unit row vectors."""
    scale = 127.0 / np.abs(unit).max(axis=1)
    parts = np.rint(unit * scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - parts / scale[:, None]) ** 2).sum(axis=1))
    return parts, scale, error


def linked_pairs(one: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix: cosine of rows of ``one`` and ``other`` (float64) at least ``threshold``."""
    lengths = [np.sqrt((m * m).sum(axis=1)) for m in (one, other)]
    (q1, s1, e1), (q2, s2, e2) = (quantise(m / n[:, None]) for m, n in zip((one, other), lengths, strict=True))
    # Products of int8 rows up to 2^24 are exact in float32.
    width = np.float32 if one.shape[1] * 127 * 127 < 1 << 24 else np.float64
    close = (q1.astype(width) @ q2.astype(width).T) / (s1[:, None] * s2[None, :])
    bound = e1[:, None] + (1 + e1[:, None]) * e2[None, :] + ROUNDING
    linked = close - bound >= threshold
    rows, columns = np.nonzero((close + bound >= threshold) & ~linked)
    for at in range(0, len(rows), 50_000):
        i, j = rows[at : at + 50_000], columns[at : at + 50_000]
        cosine = np.einsum("ij,ij->i", one[i], other[j]) / (lengths[0][i] * lengths[1][j])
        linked[i, j] = cosine >= threshold
    return linked


def _settle(linked: np.ndarray, ids: np.ndarray, mates: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id of the component of each row and column vector within one pair of tiles."""
    n = len(ids)
    names = np.concatenate([ids, ids if same else mates])
    label = names.copy()
    rows, columns = np.nonzero(linked)
    columns = columns + n
    while True:
        before = label.copy()
        np.minimum.at(label, rows, before[columns])
        np.minimum.at(label, columns, label[rows])
        if same:
            low = np.minimum(label[:n], label[n:])
            label = np.concatenate([low, low])
        if (label == before).all():
            return label[:n], label[n:]


def _usable(label: Column, vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return F.coalesce(
        label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0.0), F.lit(False)
    )


def _pivots(vectors: DataFrame) -> np.ndarray | None:
    """Unit vectors of at most ``PIVOTS`` rows (smallest hash); they only shape tiles."""
    rows = vectors.orderBy(F.xxhash64("rep_id"), "rep_id").limit(PIVOTS).select("vector").collect()
    longest = max((len(row[0]) for row in rows), default=0)
    found = [np.array(row[0], np.float64) for row in rows if len(row[0]) == longest]
    return np.stack([v / np.linalg.norm(v) for v in found]) if found else None


def _in_tiles(vectors: DataFrame, tile: int) -> DataFrame:
    """``label, size, cell, tile, rep_id, copies, vector``: tiles of about ``tile`` distinct vectors."""
    pivots = _pivots(vectors)
    counts = vectors.groupBy("label", "size").agg(F.count("*").alias("n"))
    rows = vectors.join(counts, ["label", "size"]).withColumn("large", F.col("n") > 4 * tile).drop("n")
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros(batch.num_rows, np.int32)
            size = np.asarray(batch.column("size"))
            large = np.asarray(batch.column("large").to_numpy(zero_copy_only=False), bool)
            picked = np.flatnonzero(large & (size == pivots.shape[1]))
            if len(picked):
                data = np.asarray(batch.column("vector").take(pa.array(picked)).flatten(), np.float64)
                cells[picked] = (data.reshape(len(picked), -1) @ pivots.T).argmax(axis=1)
            yield batch.append_column("cell", pa.array(cells))

    if pivots is None:
        placed = rows.withColumn("cell", F.lit(0))
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        placed = rows.mapInArrow(run, f"{columns}, cell int")
    cells = placed.groupBy("label", "size", "cell").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    return placed.join(cells, ["label", "size", "cell"]).withColumn(
        "tile", F.pmod(F.xxhash64("rep_id"), F.col("tiles")).cast("int")
    )


_TILE_SCHEMA = (
    "label string, size int, name string, ids array<long>, data binary, copies array<long>, centre array<double>, radius double"
)


def _pack(table: pa.Table) -> pa.Table:
    """One row for a tile: ids, vectors as float64 bytes, copies, centre and angular radius."""
    size = table.column("size")[0].as_py()
    data = np.asarray(table.column("vector").combine_chunks().flatten(), np.float64).reshape(-1, size)
    unit = data / np.sqrt((data * data).sum(axis=1))[:, None]
    centre = unit.sum(axis=0)
    length = np.linalg.norm(centre)
    centre = centre / length if length > 1e-9 else unit[0]
    radius = float(np.arccos(np.clip(unit @ centre, -1, 1)).max())
    name = f"{table.column('cell')[0].as_py()}.{table.column('tile')[0].as_py()}"
    return pa.table(
        {
            "label": pa.array([table.column("label")[0].as_py()], pa.string()),
            "size": pa.array([size], pa.int32()),
            "name": [name],
            "ids": pa.array([table.column("rep_id").to_pylist()], pa.list_(pa.int64())),
            "data": pa.array([data.tobytes()], pa.binary()),
            "copies": pa.array([table.column("copies").to_pylist()], pa.list_(pa.int64())),
            "centre": pa.array([centre.tolist()], pa.list_(pa.float64())),
            "radius": pa.array([radius]),
        }
    )


def _multiply(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield _one_pair({name: batch.column(name)[row].as_py() for name in batch.schema.names}, threshold)

    return run


def _one_pair(row: dict, threshold: float) -> pa.RecordBatch:
    same = row["name"] == row["name2"]
    one, other = (np.frombuffer(row[k]).reshape(-1, row["size"]) for k in ("data", "data2"))
    ids, mates = (np.array(row[k], np.int64) for k in ("ids", "ids2"))
    copies, mate_copies = (np.array(row[k], np.int64) for k in ("copies", "copies2"))
    linked = linked_pairs(one, other, threshold)
    if same:
        np.fill_diagonal(linked, False)
    roots, mate_roots = _settle(linked, ids, mates, same)
    parts = [(ids, linked @ mate_copies, roots)]
    if not same:
        parts.append((mates, linked.T @ copies, mate_roots))
    names, links, roots = (np.concatenate([part[k] for part in parts]) for k in range(3))
    some = links > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(names[some]), pa.array(links[some].astype(np.int64)), pa.array(roots[some])], ["rep_id", "links", "root"]
    )


def near_duplicates(
    table: DataFrame,
    threshold: float = THRESHOLD,
    tile: int = TILE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``table``; 0 < threshold <= 1."""
    rows = table.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.col(label_col).cast("string").alias("label"),
    ).withColumn("usable", _usable(F.col("label"), F.col("vector")) & F.col("vec_id").isNotNull())
    distinct = (
        rows.filter("usable")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("rep_id"), F.count("*").alias("copies"))
    )
    distinct = cut_lineage(distinct.withColumn("size", F.size("vector")))
    tiles = cut_lineage(
        _in_tiles(distinct, tile).groupBy("label", "size", "cell", "tile").applyInArrow(_pack, _TILE_SCHEMA)
    )
    narrow = tiles.select("label", "size", "name", "centre", "radius")
    mate = narrow.select("label", "size", *[F.col(c).alias(f"{c}2") for c in ("name", "centre", "radius")])
    dot = F.aggregate(F.zip_with("centre", "centre2", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
    apart = F.acos(F.least(F.greatest(dot, F.lit(-1.0)), F.lit(1.0)))
    reach = F.col("radius") + F.col("radius2") + float(np.arccos(threshold)) + 1e-6
    pairs = narrow.join(mate, ["label", "size"]).filter("name <= name2").filter(apart <= reach)
    heavy = tiles.select("label", "size", "name", "ids", "data", "copies")
    heavy2 = heavy.select("label", "size", *[F.col(c).alias(f"{c}2") for c in ("name", "ids", "data", "copies")])
    width = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = cut_lineage(
        pairs.select("label", "size", "name", "name2")
        .repartition(width, "label", "size", "name", "name2")
        .join(heavy, ["label", "size", "name"])
        .join(heavy2, ["label", "size", "name2"])
        .mapInArrow(_multiply(threshold), "rep_id long, links long, root long")
    )
    links = found.groupBy("rep_id").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "rep_id", "root").withColumnRenamed("id", "rep_id")
    settled = (
        distinct.join(links, "rep_id", "left")
        .join(roots, "rep_id", "left")
        .select(
            "label",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "rep_id").alias("component_id"),
        )
    )
    usable = rows.filter("usable").join(settled, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return usable.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
