"""Best inner products between two tables of vectors, as joins of vector tiles.

Rows are packed into tiles of ``TILE_ROWS`` vectors or, in large tables, of a part in ``PIVOTS`` of
them, up to ``TILE_BYTES``; so the bytes that pairs of tiles take grow with the table, not with its
square. Vectors keep the width of their column and are multiplied in double precision. They are
placed by their nearest of at most
``PIVOTS`` pivot vectors, then by a hash, so a crowded cell becomes many tiles. Pairs of
tiles meet in an equi-join on the tile's key and are multiplied in the tasks; only the best
product of a row leaves one. Neither table passes through the driver or is broadcast.

With ``at_least`` a tile only meets the cells whose angle it can reach, which loses nothing
for unit vectors; a tile that holds other vectors meets all cells. Without it, rows search best
first: each asks the cell that promises most, then more cells each round, while one of them can
still beat the best product found (angle to the cell's pivot less the cell's widest angle).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.session import cut_lineage, shuffle_width

TILE_ROWS = 4096
TILE_BYTES = 8 << 20
PIVOTS = 32
_TILE = "cell int, tile int, seqs array<bigint>, data binary, centre array<double>, radius double"


@dataclass
class Tiles:
    """Packed vectors and, per cell, its pivot, widest angle and number of tiles (at most ``PIVOTS`` rows)."""

    frame: DataFrame
    cells: list[tuple[int, list[float], float, int]]
    #: Rows of a tile, about, and the type of its packed vectors.
    rows: int = TILE_ROWS
    kind: str = "<f8"


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equal-length list column as a two-dimensional float64 array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _angles(vectors: np.ndarray, direction: np.ndarray) -> float:
    """Widest angle to ``direction``; all round if a vector is not of unit length."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    if np.abs(lengths - 1).max() > 1e-3:
        return math.pi
    return float(np.arccos(np.clip(vectors @ direction / lengths, -1, 1)).max())


def _unit(vector: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vector)
    return vector / length if length > 0 else vector


def pack(rows: DataFrame, tile_rows: int = TILE_ROWS) -> Tiles:
    """Tiles of ``rows`` (``seq, embedding``)."""
    rows = rows.select("seq", "embedding")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    n, kind = facts["n"], "<f4" if rows.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    widest = TILE_BYTES // (max(facts["width"] or 1, 1) * int(kind[-1]))
    tile_rows = max(tile_rows, min(-(-n // PIVOTS), widest))
    wanted = max(1, min(PIVOTS, -(-n // tile_rows)))
    if wanted == 1:
        placed, pivots = rows.withColumn("cell", F.lit(0)), None
    else:
        chosen = rows.orderBy(F.xxhash64("seq"), "seq").limit(wanted).toArrow()  # PIVOTS rows at most
        pivots = np.stack([_unit(v) for v in matrix(chosen["embedding"])])

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells = (matrix(batch.column("embedding")) @ pivots.T).argmax(axis=1) if batch.num_rows else []
                yield batch.append_column("cell", pa.array(cells, pa.int32()))

        column = rows.schema["embedding"].dataType.simpleString()
        placed = rows.mapInArrow(place, f"seq bigint, embedding {column}, cell int")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    numbered = placed.join(F.broadcast(sizes), "cell").withColumn(  # a row per pivot
        "tile", F.pmod(F.xxhash64("seq", F.lit(1)), F.col("tiles")).cast("int")
    )

    def pack_one(table: pa.Table) -> pa.Table:
        vectors = matrix(table["embedding"])
        centre = _unit(vectors.sum(axis=0))
        cell = table["cell"][0].as_py()
        return pa.table(
            {
                "cell": pa.array([cell], pa.int32()),
                "tile": pa.array([table["tile"][0].as_py()], pa.int32()),
                "seqs": pa.array([table["seq"].to_pylist()], pa.list_(pa.int64())),
                "data": pa.array([vectors.astype(kind).tobytes()], pa.binary()),
                "centre": pa.array([centre.tolist()], pa.list_(pa.float64())),
                "radius": pa.array([_angles(vectors, centre)]),
            }
        )

    frame = cut_lineage(numbered.drop("tiles").groupBy("cell", "tile").applyInArrow(pack_one, _TILE))
    cells = frame.groupBy("cell").agg(F.max("tile").alias("last"), F.max("radius").alias("radius"), F.first("centre").alias("c"))
    found = []
    if pivots is None:
        found = [(row["cell"], row["c"], row["radius"], row["last"] + 1) for row in cells.collect()]
        found = [(cell, centre, radius if count == 1 else math.pi, count) for cell, centre, radius, count in found]
    else:
        # A tile's vectors lie within its radius of its centre, hence this far from the pivot.
        for row in frame.select("cell", "tile", "centre", "radius").groupBy("cell").agg(
            F.max("tile").alias("last"), F.max(_from_pivot(pivots)).alias("radius")
        ).collect():
            found.append((row["cell"], pivots[row["cell"]].tolist(), row["radius"], row["last"] + 1))
    return Tiles(frame, found, tile_rows, kind)


def _dot(one, other):
    return F.aggregate(F.zip_with(one, other, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)


def _angle(one, other):
    return F.acos(F.least(F.greatest(_dot(one, other), F.lit(-1.0)), F.lit(1.0)))


def _from_pivot(pivots: np.ndarray):
    pivot = F.get(F.array(*[F.array(*map(F.lit, p.tolist())) for p in pivots]), F.col("cell"))
    return F.least(_angle(F.col("centre"), pivot) + F.col("radius"), F.lit(math.pi))


def best_products(one: Tiles, other: Tiles, earlier_only: bool = False, at_least: float | None = None) -> DataFrame:
    """``seq, max_similarity``: best inner product of rows of ``one`` with rows of ``other``.

    With ``earlier_only`` a row meets rows of smaller ``seq``. With ``at_least`` rows whose best
    is lower are left out; rows that meet nothing always are.
    """

    def best(dots: np.ndarray, seqs: np.ndarray, seqs2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if earlier_only:
            dots[seqs2[None, :] >= seqs[:, None]] = -np.inf
        found = dots.max(axis=1)
        keep = np.isfinite(found) if at_least is None else found >= at_least
        return seqs[keep], found[keep]

    if at_least is None and len(other.cells) > 1 and one.cells:
        return _best_first(one, other, best)
    found = _products(one, other, at_least, best, "max_similarity double")
    return found.groupBy("seq").agg(F.max("max_similarity").alias("max_similarity"))


_STATE = "seq bigint, vector binary, best double"
_ASKED = "seq bigint, vector binary, cell int"


def _rows_of(tiles: Tiles) -> DataFrame:
    """Rows of packed tiles, with no product yet."""
    tiles_kind = tiles.kind

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                seqs = batch.column("seqs")[row].values
                vectors = np.frombuffer(batch.column("data")[row].as_buffer(), tiles_kind).reshape(len(seqs), -1)
                columns = [seqs, pa.array([v.tobytes() for v in vectors], pa.binary()), pa.nulls(len(seqs), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["seq", "vector", "best"])

    return tiles.frame.select("seqs", "data").mapInArrow(unpack, _STATE)


def ask_cells(
    state: DataFrame, cells: list[tuple[int, list[float], float, int]], first: int, last: int, kind: str = "<f8"
) -> DataFrame:
    """Cells of ranks ``first .. last`` in each row's order of promise that can beat its best product."""
    numbers = np.array([cell for cell, *_ in cells], np.int32)
    pivots = np.array([pivot for _, pivot, *_ in cells])
    reach = np.array([radius for *_, radius, _ in cells])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.frombuffer(b"".join(batch.column("vector").to_pylist()), kind).reshape(batch.num_rows, -1).astype(float)
            lengths = np.sqrt((vectors * vectors).sum(axis=1))
            unit = np.abs(lengths - 1) <= 1e-3
            nearest = np.arccos(np.clip(vectors @ pivots.T / np.maximum(lengths, 1e-300)[:, None], -1, 1)) - reach
            nearest[~unit] = -math.pi  # promises hold for unit vectors; others ask every cell
            order = np.argsort(nearest, axis=1, kind="stable")[:, first:last]
            best = batch.column("best").to_numpy(zero_copy_only=False).astype(float)
            bound = np.where(np.isnan(best), math.inf, np.arccos(np.clip(best, -1, 1)) + 1e-3)
            row, rank = np.nonzero(np.take_along_axis(nearest, order, axis=1) <= bound[:, None])
            rows = pa.array(row)
            columns = [batch.column("seq").take(rows), batch.column("vector").take(rows), pa.array(numbers[order[row, rank]])]
            yield pa.RecordBatch.from_arrays(columns, ["seq", "vector", "cell"])

    return state.mapInArrow(ask, _ASKED)


def _best_first(one: Tiles, other: Tiles, reduce) -> DataFrame:
    """``best_products`` by rounds of 1, 2, 4, ... cells; rows that no cell can improve drop out."""

    def pack_asking(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1)
        seqs = pa.array([table["seq"].to_pylist()], pa.list_(pa.int64()))
        data = pa.array([b"".join(table["vector"].to_pylist())], pa.binary())
        return pa.table({"cell": first["cell"], "part": first["part"], "seqs": seqs, "data": data})

    state, first, done = cut_lineage(_rows_of(one)), 0, None
    while first < len(other.cells):
        last = 2 * first + 1
        asked = cut_lineage(ask_cells(state, other.cells, first, last, one.kind))
        if asked.isEmpty():
            break
        sizes = asked.groupBy("cell").agg(F.ceil(F.count("*") / max(TILE_ROWS, one.rows)).cast("int").alias("parts"))
        parts = asked.join(F.broadcast(sizes), "cell").withColumn(  # a row per pivot
            "part", F.pmod(F.xxhash64("seq", F.lit(2)), F.col("parts")).cast("int")
        )
        tiles = parts.drop("parts").groupBy("cell", "part").applyInArrow(
            pack_asking, "cell int, part int, seqs array<bigint>, data binary"
        )
        heavy2 = other.frame.select("cell", F.col("seqs").alias("seqs2"), F.col("data").alias("data2"))
        met = tiles.join(heavy2, "cell").select("seqs", "data", "seqs2", "data2")
        better = met.mapInArrow(_multiplier(reduce, ["seq", "max_similarity"], one.kind, other.kind), "seq bigint, max_similarity double")
        better = better.groupBy("seq").agg(F.max("max_similarity").alias("found"))
        joined = state.join(better, "seq", "left").select("seq", "vector", F.greatest("best", "found").alias("best"))
        asking = asked.select("seq").distinct().withColumn("asked", F.lit(True))
        marked = cut_lineage(joined.join(asking, "seq", "left"))
        settled = marked.filter("asked IS NULL").select("seq", "best")
        done = settled if done is None else done.unionByName(settled)
        state, first = marked.filter("asked").select("seq", "vector", "best"), last
    rest = state.select("seq", "best")
    found = rest if done is None else done.unionByName(rest)
    return found.filter("best IS NOT NULL").select("seq", F.col("best").alias("max_similarity"))


def first_alike(one: Tiles, other: Tiles, at_least: float, earlier_only: bool = False) -> DataFrame:
    """``seq, first``: smallest ``seq`` of ``other`` with an inner product of at least ``at_least``;
    rows without one are left out. With ``earlier_only`` only rows of smaller ``seq`` count."""
    nothing = np.iinfo(np.int64).max

    def first(dots: np.ndarray, seqs: np.ndarray, seqs2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = np.where(dots >= at_least, seqs2[None, :], nothing).min(axis=1)
        keep = found < (seqs if earlier_only else nothing)
        return seqs[keep], found[keep]

    return _products(one, other, at_least, first, "first bigint").groupBy("seq").agg(F.min("first").alias("first"))


def _products(one: Tiles, other: Tiles, at_least: float | None, reduce, column: str) -> DataFrame:
    """``reduce(products, seqs, seqs of other)`` of all pairs of tiles that can reach ``at_least``."""
    spark = one.frame.sparkSession
    if not one.cells or not other.cells:
        return spark.createDataFrame([], f"seq bigint, {column}")
    cells = F.array(
        *[
            F.struct(
                F.lit(cell).alias("cell"), F.array(*map(F.lit, pivot)).alias("pivot"), F.lit(radius).alias("radius"), F.lit(n).alias("n")
            )
            for cell, pivot, radius, n in other.cells
        ]
    )
    reached = one.frame.select("cell", "tile", "centre", "radius", F.explode(cells).alias("to"))
    if at_least is not None:
        reach = F.col("radius") + F.col("to.radius") + math.acos(max(-1.0, min(1.0, at_least))) + 1e-3
        reached = reached.filter(_angle(F.col("centre"), F.col("to.pivot")) <= reach)
    pairs = reached.select(
        "cell", "tile", F.col("to.cell").alias("cell2"), F.explode(F.sequence(F.lit(0), F.col("to.n") - 1)).alias("tile2")
    )
    heavy = one.frame.select("cell", "tile", "seqs", "data")
    heavy2 = other.frame.select(*[F.col(name).alias(f"{name}2") for name in ("cell", "tile", "seqs", "data")])
    names = ["seq", column.split()[0]]

    spread = pairs.repartition(shuffle_width(spark), "cell", "tile", "cell2", "tile2")
    products = spread.join(heavy, ["cell", "tile"]).join(heavy2, ["cell2", "tile2"])
    return products.select("seqs", "data", "seqs2", "data2").mapInArrow(
        _multiplier(reduce, names, one.kind, other.kind), f"seq bigint, {column}"
    )


def _multiplier(reduce, names: list[str], kind: str, kind2: str):
    """Products of the packed vectors of two tiles, reduced to values per row."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                seqs, seqs2 = (batch.column(c)[row].values.to_numpy() for c in ("seqs", "seqs2"))
                data = np.frombuffer(batch.column("data")[row].as_buffer(), kind)
                data2 = np.frombuffer(batch.column("data2")[row].as_buffer(), kind2)
                vectors, vectors2 = data.reshape(len(seqs), -1), data2.reshape(len(seqs2), -1).astype(float)
                step = max(1, min(1024, (1 << 22) // max(len(seqs2), 1)))  # products of 32 MB at a time
                for at in range(0, len(seqs), step):
                    part = slice(at, at + step)
                    reduced = reduce(vectors[part].astype(float) @ vectors2.T, seqs[part], seqs2)
                    yield pa.RecordBatch.from_arrays([pa.array(values) for values in reduced], names)

    return multiply
