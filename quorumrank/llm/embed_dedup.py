"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors of one label are compared tile by tile. A label's vectors are laid out along the leading principal components: a
cell that holds more than CELL_ROWS is cut along the next component, up to AXES of them, and beyond that dealt by a hash.
Two cells meet unless the gap between their boxes is wider than the cosine allows. In a tile the leading principal
dimensions are multiplied first; what the rest can add is at most the product of the suffix norms, so most tiles stop
after one block of dimensions, and the pairs that go on are dropped block by block as soon as the bound falls below the
threshold. What is left is decided by the cosine of the original vectors in double precision. Equal vectors form one
class and are compared once; a tile gives back counts and a forest of its components, never its pairs.
"""

from __future__ import annotations

import functools
import hashlib
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .components import connected_components, forest
from .ngram_join import by_key
from .shared import forget, pick, stored, tidy

THRESHOLD = 0.93
#: Vectors of a cell, and rows multiplied at once.
CELL_ROWS, CHUNK_ROWS = 8192, 1024
#: Components that cells are cut along.
AXES = 4
BLOCK_DIMS = 16
#: Leading dimensions that are rotated to principal axes; bounds what the driver gathers, not the result.
ROTATED_DIMS = 1024
_SLACK = 1e-9
_BANDS = [f"b{k}" for k in range(AXES)]


def _keys(dtype: type):
    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(vec_id, label, dims, d1, d2, key): a valid vector's bytes and their digest, null for those that link with nothing."""
        for batch in batches:
            ids, vectors, labels = batch.columns
            keys: list[bytes | None] = []
            for v, label in zip(vectors, labels, strict=True):
                key = None
                if v.is_valid and label.is_valid and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(dtype) + dtype(0)  # -0.0 becomes 0.0
                    if len(x) and np.isfinite(x).all() and x.any():
                        key = x.tobytes()
                keys.append(key)
            size = np.dtype(dtype).itemsize
            digests = [
                np.frombuffer(hashlib.blake2b(k, digest_size=16).digest(), np.int64).tolist() if k else (None, None) for k in keys
            ]
            more = [
                pa.array([len(k) // size if k else None for k in keys], pa.int32()),
                *[pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)], pa.array(keys, pa.binary())
            ]
            yield pa.RecordBatch.from_arrays([ids, labels, *more], ["vec_id", "label", "dims", "d1", "d2", "key"])

    return act


def _matrix(keys: pa.ChunkedArray | pa.Array, dtype: type) -> np.ndarray:
    return np.stack([np.frombuffer(k, dtype=dtype) for k in keys.to_pylist()]).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _rotated(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors with their leading dimensions turned to the axes."""
    x = _unit(x)
    x[:, : len(axes)] = x[:, : len(axes)] @ axes
    return x


def _moments(dims: int, dtype: type):
    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(batch.column(0), dtype))[:, :dims]
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], ["at", "s"])

    return act


def principal_axes(rows: DataFrame, dims: int, dtype: type) -> np.ndarray:
    """Orthonormal axes of the unit vectors by falling second moment, over all rows and the first ROTATED_DIMS dimensions."""
    dims = min(dims, ROTATED_DIMS)
    sums = rows.select("key").mapInArrow(
        tidy(_moments(dims, dtype)), "at long, s double"
    ).groupBy("at").agg(F.sum("s").alias("s")).toArrow()
    moment = np.zeros(dims * dims)
    moment[sums.column("at").to_numpy()] = sums.column("s").to_numpy()
    moment = moment.reshape(dims, dims)
    _, axes = np.linalg.eigh((moment + moment.T) / 2)
    return axes[:, ::-1]


def close_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i of a, j of b; i < j where both are ``same``) with cosine of at least ``threshold``."""
    ra, rb = _rotated(a, axes), _rotated(b, axes)

    def suffix(r: np.ndarray, k: int) -> np.ndarray:
        return np.sqrt((r[:, k:] ** 2).sum(axis=1))

    first = min(BLOCK_DIMS, ra.shape[1])
    tail_a, tail_b = suffix(ra, first), suffix(rb, first)
    norms = [np.sqrt((x * x).sum(axis=1)) for x in (a, b)]
    out = []
    for at in range(0, len(a), CHUNK_ROWS):
        rows = slice(at, at + CHUNK_ROWS)
        begin = at if same else 0  # rows of ``same`` meet those after them
        part = ra[rows, :first] @ rb[begin:, :first].T
        i, j = np.nonzero(part + np.outer(tail_a[rows], tail_b[begin:]) >= threshold - _SLACK)
        if same:
            i, j = i[i < j], j[i < j]
        part = part[i, j]
        i, j, k = i + at, j + begin, first
        while len(i) and k < ra.shape[1]:
            e = min(k + BLOCK_DIMS, ra.shape[1])
            part = part + np.einsum("ij,ij->i", ra[i, k:e], rb[j, k:e])
            k = e
            go = part + suffix(ra, k)[i] * suffix(rb, k)[j] >= threshold - _SLACK
            i, j, part = i[go], j[go], part[go]
        for s in range(0, len(i), 65536):
            x, y = i[s : s + 65536], j[s : s + 65536]
            exact = np.einsum("ij,ij->i", a[x], b[y]) / (norms[0][x] * norms[1][y])
            out.append((x[exact >= threshold], y[exact >= threshold]))
    none = np.zeros(0, np.int64)
    return (np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])) if out else (none, none)


def _tile_links(axes: np.ndarray, threshold: float, dtype: type):
    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in by_key(batches, ["label", "tile"]):
            if tile.num_rows < 2:
                continue
            side = tile.column("side").to_numpy()
            cls, copies = tile.column("cls").to_numpy(), tile.column("copies").to_numpy()
            x = _matrix(tile.column("key"), dtype)
            if (side == 0).all():
                i, j = close_pairs(x, x, axes, threshold, same=True)
            else:
                at_a, at_b = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
                if not len(at_a) or not len(at_b):
                    continue
                i, j = close_pairs(x[at_a], x[at_b], axes, threshold, same=False)
                i, j = at_a[i], at_b[j]
            if not len(i):
                continue
            links = np.bincount(i, weights=copies[j], minlength=len(cls)) + np.bincount(j, weights=copies[i], minlength=len(cls))
            low = forest(i, j, len(cls))
            touched = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[touched]), pa.array(cls[low[touched]]), pa.array(links[touched].astype(np.int64))],
                ["a", "b", "links"]
            )

    return act


def _tiled(tiles: DataFrame, axes: np.ndarray, threshold: float, dtype: type) -> DataFrame:
    """(a, b, links): links found by a tile, and a member of the component there."""
    return tiles.repartition("label", "tile").sortWithinPartitions("label", "tile").mapInArrow(
        tidy(_tile_links(axes, threshold, dtype)), "a long, b long, links long"
    )


def _cells(rows: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """(the cell of every place of the grid, the pairs of cells that meet).

    ``grid`` has label and bands, and depth (of how many components the bands say the cell), cell, blocks.
    """
    counts = stored(rows.groupBy("label", *_BANDS).agg(F.count(F.lit(1)).alias("n")), "grid")
    sums = [F.sum("n").over(Window.partitionBy("label", *_BANDS[:k])) for k in range(AXES + 1)]  # over places, 11 ** AXES for a label at most
    grid = counts.withColumn("sums", F.array(*sums))
    depth = functools.reduce(
        lambda rest, k: F.when(F.col("sums")[k] <= CELL_ROWS, k).otherwise(rest), reversed(range(AXES)), F.lit(AXES)
    )
    grid = grid.withColumn("depth", depth).withColumns({
        "cell": F.concat_ws(",", F.slice(F.array(*_BANDS), F.lit(1), F.col("depth"))),
        "blocks": F.ceil(F.element_at("sums", F.col("depth") + 1) / CELL_ROWS),
    })
    grid = stored(grid.drop("n", "sums"), "cells")
    every = grid.groupBy("label", "cell", "depth", "blocks").agg(*[F.first(b).alias(b) for b in _BANDS])
    every = stored(every.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))), "blocks")
    one, two = every.alias("x"), every.alias("y")
    gap = functools.reduce(operator.add, [  # bands are half as wide as the cosine reaches
        F.when(
            (F.col("x.depth") > k) & (F.col("y.depth") > k),
            F.pow(F.greatest(F.abs(F.col(f"x.{b}") - F.col(f"y.{b}")) - 1, F.lit(0)) * (reach / 2), F.lit(2))
        ).otherwise(F.lit(0.0))
        for k, b in enumerate(_BANDS)
    ])
    order = [F.struct(*[F.col(f"{s}.{c}") for c in ("cell", "at")]) for s in "xy"]
    meets = one.join(two, F.col("x.label") == F.col("y.label")).where((order[0] <= order[1]) & (gap <= reach * reach))
    tile = F.concat_ws("/", "x.cell", "x.at", "y.cell", "y.at")
    meets = meets.select(
        F.col("x.label").alias("label"), *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in ("cell", "at")],
        tile.alias("tile"), (order[0] == order[1]).alias("itself")
    )
    meets = stored(meets, "meets")
    sides = meets.select(
        "label", F.col("x_cell").alias("cell"), F.col("x_at").alias("at"), "tile",
        F.when(F.col("itself"), 0).otherwise(1).alias("side")
    ).unionByName(
        meets.where(~F.col("itself")).select(
            "label", F.col("y_cell").alias("cell"), F.col("y_at").alias("at"), "tile", F.lit(2).alias("side")
        )
    )
    return grid.select("label", *_BANDS, "cell", "blocks"), sides


def _class_links(rows: DataFrame, dims: int, threshold: float, dtype: type) -> DataFrame:
    """Links of the classes with ``dims`` dimensions."""
    axes = principal_axes(rows, dims, dtype)
    reach = float(np.sqrt(2 - 2 * threshold)) + _SLACK

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rotated(
                _matrix(batch.column(batch.schema.get_field_index("key")), dtype), axes
            ) if batch.num_rows else np.zeros((0, dims))
            bands = [
                np.floor(x[:, k] / reach * 2).astype(np.int32) if k < x.shape[1] else np.zeros(len(x), np.int32)
                for k in range(AXES)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, bands)], [*batch.schema.names, *_BANDS])

    rows = rows.select("label", "cls", "copies", "key")
    rows = stored(
        rows.mapInArrow(tidy(placed), T.StructType([*rows.schema.fields, *[T.StructField(b, T.IntegerType()) for b in _BANDS]])),
        "placed"
    )
    grid, sides = _cells(rows, reach)
    at = rows.join(grid, ["label", *_BANDS]).withColumn("at", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    return _tiled(
        at.join(sides, ["label", "cell", "at"]).select("label", "tile", "side", "cls", "copies", "key"), axes, threshold, dtype
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Vectors with a null label, null, empty or zero ones and those with null or non-finite components link with
    nothing. Only vectors of one label (of any type that can be text) and of equal length are compared. Repeated rows
    count as copies of each other; rows that share a vec_id and differ are vectors of their own. Rows with a null id are
    linked, but never name a component; they are kept where nothing names it. Other columns are ignored.
    """
    kind = vectors.schema["embedding"].dataType
    dtype = np.float32 if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else np.float64
    rows = pick(vectors, "vec_id", "embedding", "label").withColumn("label", F.col("label").cast("string"))
    table = stored(rows.mapInArrow(tidy(_keys(dtype)), "vec_id long, label string, dims int, d1 long, d2 long, key binary"), "vectors")
    classes = table.where("key is not null").groupBy("label", "d1", "d2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("dims").alias("dims"),
        F.first("key").alias("key")
    )
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    # Of lengths with more vectors than a cell holds there are few; all others are compared as they are, in one go.
    lengths = stored(classes.groupBy("dims").agg(F.count(F.lit(1)).alias("n")), "lengths")
    common = [r["dims"] for r in lengths.where(F.col("n") > CELL_ROWS).orderBy("dims").collect()]
    rare = classes.where(~F.col("dims").isin(common)) if common else classes
    rare = rare.select("label", F.col("dims").cast("string").alias("tile"), F.lit(0).alias("side"), "cls", "copies", "key")
    found = _tiled(rare, np.eye(0), threshold, dtype)
    for dims in common:
        found = found.unionByName(_class_links(classes.where(F.col("dims") == dims), dims, threshold, dtype))
    found = stored(found, "links")
    links = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "cls")
    components = stored(connected_components(found.select("a", "b")), "components")
    named = classes.select("label", "d1", "d2", "cls", "rep", "copies").join(
        components, F.col("cls") == F.col("node"), "left"
    ).join(links, "cls", "left")
    smallest = stored(named.where("component is not null").groupBy("component").agg(F.min("rep").alias("smallest")), "names")
    named = named.join(smallest, "component", "left").select(
        "label", "d1", "d2", "copies", "links", F.coalesce("smallest", "rep").alias("name"), F.lit(True).alias("valid")
    )
    out = table.select("vec_id", "label", "d1", "d2").join(stored(named, "named"), ["label", "d1", "d2"], "left")
    n = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    component = F.when(F.col("valid"), F.col("name")).otherwise(F.col("vec_id"))
    forget(vectors.sparkSession, found)
    return out.select(
        "vec_id", n.cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept")
    )
