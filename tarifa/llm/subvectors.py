"""Centroid clustering of integer vectors over dictionaries of their parts.

Vectors are encoded once, shard by shard: the dimensions are cut into blocks, and a block's distinct subvectors form a dictionary that
the rows of the shard point into. In a round the squared distance of every dictionary entry to its part of every centroid is computed
once per shard; a vector's distance is the sum of its codes' entries. Sums per cluster come from counts of codes in the same way. All
numbers are integers, so nothing depends on the order of rows, shards or tasks.

Narrow blocks have small dictionaries and many codes, wide ones the reverse. A shard starts with single dimensions and joins
neighbouring blocks for as long as that makes a round cheaper: vectors that are copied often end as one code each, unrelated ones stay
in narrow blocks. Dictionaries are kept with their shard, as the distances of an entry cost less than sending them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.session import save

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
# Components of a shard, which bounds the memory of a step.
SHARD_COMPONENTS = 1 << 20
# Components up to this size keep the squared distance of 64 dimensions within a long.
LARGEST = 1 << 26

Block = tuple[np.ndarray, np.ndarray]
"""The distinct subvectors as rows, and the row of each vector."""


def blocks(values: np.ndarray) -> list[Block]:
    """Dictionary-encode the columns of ``values`` (vectors as rows), in blocks as wide as makes a round cheapest."""

    def cost(parts: list[Block]) -> int:
        return sum(entries.size + len(codes) for entries, codes in parts)

    found: list[Block] = []
    for column in values.T:
        entries, codes = np.unique(column, return_inverse=True)
        found.append((entries[:, None], codes))
    while len(found) > 1:
        joined = [_joined(a, b) for a, b in zip(found[::2], found[1::2])] + found[len(found) // 2 * 2 :]
        if cost(joined) >= cost(found):
            break
        found = joined
    return found


def _joined(one: Block, two: Block) -> Block:
    pairs, codes = np.unique(one[1].astype(np.int64) * len(two[0]) + two[1], return_inverse=True)
    return np.hstack([one[0][pairs // len(two[0])], two[0][pairs % len(two[0])]]), codes


def distances(parts: list[Block], centroids: np.ndarray) -> np.ndarray:
    """The squared distance of every vector (row) to every centroid (column), exactly."""
    total, at = np.zeros((len(parts[0][1]), len(centroids)), np.int64), 0
    for entries, codes in parts:
        own = centroids[:, at : at + entries.shape[1]]
        table = np.stack([np.square(entries - c).sum(axis=1) for c in own], axis=1)
        total += table[codes]
        at += entries.shape[1]
    return total


def sums(parts: list[Block], chosen: np.ndarray, clusters: int) -> np.ndarray:
    """The sum of the vectors of every cluster, from counts of codes."""
    out = []
    for entries, codes in parts:
        counts = np.bincount(codes * clusters + chosen, minlength=len(entries) * clusters).reshape(-1, clusters)
        out.append(counts.T @ entries)
    return np.hstack(out)


def _packed(parts: list[Block]) -> tuple[list[int], list[bytes], list[bytes]]:
    widths = [entries.shape[1] for entries, _ in parts]
    codes = [c.astype(np.min_scalar_type(len(e))).tobytes() for e, c in parts]
    return widths, [e.astype("<i4").tobytes() for e, _ in parts], codes


def _unpacked(widths: list[int], entries: list[bytes], codes: list[bytes]) -> list[Block]:
    parts = []
    for width, e, c in zip(widths, entries, codes):
        own = np.frombuffer(e, "<i4").reshape(-1, width).astype(np.int64)
        parts.append((own, np.frombuffer(c, np.min_scalar_type(len(own))).astype(np.int64)))
    return parts


def _usable(vector: Column, dims: int) -> Column:
    """Right number of components, none null or non-finite; null counts as no."""
    return (F.size(vector) == dims) & F.forall(vector, lambda x: F.abs(x.cast("double")) < F.lit(float("inf")))


def encode(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, components: int = SHARD_COMPONENTS) -> DataFrame:
    """Shards of ``vectors`` (``id``, ``vector``): ``ids`` with ``widths``, ``entries`` and ``codes``, and ``apart``, the ids of vectors
    with a component too large to be squared. Every row has the right number of finite components."""
    most = max(1, components // dims)
    kind = vectors.schema["id"].dataType.simpleString()

    def shard(ids: pa.Array, values: np.ndarray) -> pa.RecordBatch:
        fits = np.abs(values).max(axis=1, initial=0) <= LARGEST
        widths, entries, codes = _packed(blocks(values[fits].astype(np.int64))) if fits.any() else ([], [], [])
        columns = [
            [ids.filter(pa.array(fits)).to_pylist()],
            [widths],
            [entries],
            [codes],
            [ids.filter(pa.array(~fits)).to_pylist()],
        ]
        types = [pa.list_(ids.type), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(ids.type)]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays(arrays, ["ids", "widths", "entries", "codes", "apart"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                piece = batch.slice(at, most)
                raw = piece.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                held.append((piece.column("id"), np.floor(scale * raw)))
                if sum(len(ids) for ids, _ in held) >= most:
                    yield shard(pa.concat_arrays([i for i, _ in held]), np.concatenate([v for _, v in held]))
                    held = []
        if held:
            yield shard(pa.concat_arrays([i for i, _ in held]), np.concatenate([v for _, v in held]))

    schema = f"ids array<{kind}>, widths array<int>, entries array<binary>, codes array<binary>, apart array<{kind}>"
    return vectors.mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch, row: int) -> list[Block]:
    return _unpacked(*(batch.column(c)[row].as_py() for c in ("widths", "entries", "codes")))


def totals(shards: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, component sums and squared distances of every cluster, as Python integers; one row per cluster and dimension arrives."""
    clusters, dims = centroids.shape
    known = shards.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Number, then sums, then distances.
        own = np.zeros((clusters, dims + 2), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                parts = _parts(batch, row)
                if parts:
                    far = distances(parts, known.value)
                    chosen = far.argmin(axis=1)
                    own[:, 0] += np.bincount(chosen, minlength=clusters)
                    own[:, 1:-1] += sums(parts, chosen, clusters)
                    np.add.at(own[:, -1], chosen, far.min(axis=1))
        place = np.arange(own.size)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(own.ravel())], ["place", "value"])

    summed = shards.mapInArrow(run, "place long, value long").groupBy("place").agg(F.sum(F.col("value").cast("decimal(19,0)")).alias("value"))
    out = np.zeros(clusters * (dims + 2), object)
    for place, value in summed.collect():
        out[place] = int(value)
    out = out.reshape(clusters, dims + 2)
    return out[:, 0], out[:, 1:-1], out[:, -1]


def first_centroids(vectors: DataFrame, clusters: int, scale: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the smallest SHA-256; ``clusters`` rows arrive at most."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    small = F.forall("vector", lambda x: (x * scale >= -LARGEST) & (x * scale < LARGEST + 1))
    order = F.sha2(name.cast("binary"), 256).alias("digest")
    rows = vectors.filter(small).select(order, "vector").orderBy("digest", "vector").limit(clusters).collect()
    return np.array([np.floor(scale * np.array(r["vector"])) for r in rows]).astype(np.int64)


def cluster(
    vectors: DataFrame,
    column: str = "embedding",
    name: str = "vec_id",
    dims: int = DIMS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
    components: int = SHARD_COMPONENTS,
) -> DataFrame:
    """Per vector: ``name``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Vectors with ``dims`` components, none null or non-finite, are kept; a component x counts as floor(``scale`` * x). The first
    centroids are those vectors whose ids have the smallest SHA-256 of ``seed:id``, equal ids by their components; fewer vectors
    start fewer clusters. Nearest means the smallest squared distance, then the smallest number. A cluster without vectors keeps its
    centroid; so equal first centroids, as of repeated rows, leave the later ones empty. Without an id a vector counts as having the
    empty one. Vectors with a component beyond 2 ** 26 after scaling take no part and have null in the new columns: their squared
    distances need not fit a long. Repeated rows and ids are vectors of their own; other columns are not read; without a kept vector
    the result is empty.
    """
    vector = F.col(column)
    source = vectors.filter(_usable(vector, dims)).select(F.col(name).alias("id"), vector.cast("array<double>").alias("vector"))
    kind = source.schema["id"].dataType.simpleString()
    shards = save(encode(source, dims, scale, components), "shards")
    centroids = first_centroids(source, clusters, scale, seed)
    if not len(centroids):
        centroids = np.zeros((1, dims), np.int64)
    for _ in range(rounds):
        counts, added, _ = totals(shards, centroids)
        moved = [a // n if n else c for a, n, c in zip(added, counts, centroids.astype(object))]
        moved = np.array(moved).astype(np.int64)
        # Later rounds would repeat this one.
        if (moved == centroids).all():
            break
        centroids = moved
    _, _, inertias = totals(shards, centroids)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = shards.sparkSession.sparkContext.broadcast((centroids, inertias.tolist(), digests))
    columns = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, own, digests = known.value
        everything = pa.scalar(sum(own), pa.int64())
        for batch in batches:
            for row in range(batch.num_rows):
                ids, apart = (batch.column(c)[row].values for c in ("ids", "apart"))
                if len(ids):
                    far = distances(_parts(batch, row), centroids)
                    chosen = pa.array(far.argmin(axis=1), pa.int32())
                    arrays = [
                        ids,
                        chosen,
                        pa.array(far.min(axis=1)),
                        pa.array(own, pa.int64()).take(chosen),
                        pa.array([everything] * len(ids), pa.int64()),
                        pa.array(digests, pa.string()).take(chosen),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, [name, *columns])
                if len(apart):
                    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([apart, *(pa.nulls(len(apart), k) for k in kinds)], [name, *columns])

    schema = f"`{name}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    return shards.mapInArrow(run, schema)
