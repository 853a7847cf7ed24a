"""Clusters around centroids by a vector-approximation file: few-bit cells first, vectors only where cells cannot tell.

Each dimension's range is cut into cells; a vector is stored as its cell numbers, a few bits each, beside its integers.
For a centroid, a table holds the least and greatest squared difference to each cell of each dimension, so the sums of
looked-up values bound the vector's distance. If one centroid's greatest distance is below all others' least, it is the
nearest, and the vector is not fetched; only where the intervals of several centroids overlap are exact distances taken,
and to those centroids alone.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm import common  # noqa: F401  ships this package with its tasks
from newslake.session import staged

LARGEST = 1 << 27  # of an integer component: squared distances of 64 of them fit a long


# ---- cells

class Cells:
    """For each dimension the bounds of its cells: cell ``c`` holds the integers ``edges[c] <= x < edges[c + 1]``."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int):
        """Equal cells where all but a thousandth of the ``sample`` lies at either end; the first and last reach to the
        least and greatest of all."""
        self.bits = bits
        ends = np.quantile(sample, [0.001, 0.999], axis=0, method="nearest")
        inner = np.ceil(np.linspace(ends[0], ends[1] + 1, (1 << bits) - 1, axis=1))
        self.edges = np.concatenate([low[:, None], inner, high[:, None] + 1], axis=1).astype(np.int64)

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Cell numbers, packed to ``bits`` bits each."""
        cells = np.empty(vectors.shape, np.uint8)
        for d, edges in enumerate(self.edges):
            cells[:, d] = np.searchsorted(edges[1:-1], vectors[:, d], "right")
        bits = np.unpackbits(cells[:, :, None], axis=2, count=self.bits, bitorder="little")
        return np.packbits(bits.reshape(len(vectors), -1), axis=1, bitorder="little")

    def decode(self, packed: np.ndarray) -> np.ndarray:
        dims = len(self.edges)
        bits = np.unpackbits(packed, axis=1, count=dims * self.bits, bitorder="little").reshape(-1, dims, self.bits)
        return np.packbits(bits, axis=2, bitorder="little")[:, :, 0]

    def tables(self, centroid: np.ndarray):
        """Least and greatest squared difference of the centroid to each cell: ``(dims, cells)`` each."""
        first, last = self.edges[:, :-1], np.maximum(self.edges[:, 1:] - 1, self.edges[:, :-1])
        to_first, to_last = first - centroid[:, None], last - centroid[:, None]
        nearest = np.where(to_first > 0, to_first, np.where(to_last < 0, to_last, 0))
        farthest = np.maximum(np.abs(to_first), np.abs(to_last))
        return nearest ** 2, farthest ** 2


class Assigner:
    """Nearest centroids of vectors given by their cells, with the vectors at hand for those that cells leave open."""

    def __init__(self, cells: Cells, centroids: np.ndarray):
        self.cells, self.centroids = cells, centroids
        self.tables = [cells.tables(c) for c in centroids]
        self.fetched = self.seen = 0

    def assign(self, packed: np.ndarray, fetch) -> np.ndarray:
        """The nearest centroid of each vector, ties to the smaller number; ``fetch(rows)`` gives their integers."""
        codes = self.cells.decode(packed)
        n, k = len(codes), len(self.centroids)
        places = codes + (np.arange(codes.shape[1]) << self.cells.bits)  # of each cell in the flat tables
        low, high = np.empty((k, n), np.int64), np.empty((k, n), np.int64)
        for c, (nearest, farthest) in enumerate(self.tables):
            low[c], high[c] = nearest.take(places).sum(axis=1), farthest.take(places).sum(axis=1)
        # A centroid stays in question if its interval reaches below the least of the greatest distances.
        open_ = low <= high.min(axis=0)
        cluster = open_.argmax(axis=0)
        rows = np.flatnonzero(open_.sum(axis=0) > 1)
        self.seen += n
        self.fetched += len(rows)
        if len(rows):
            vectors = fetch(rows)
            best = np.full(len(rows), np.iinfo(np.int64).max)
            for c in range(k):
                asked = np.flatnonzero(open_[c, rows])
                distance = squared(vectors[asked], self.centroids[c])
                nearer = distance < best[asked]
                best[asked[nearer]] = distance[nearer]
                cluster[rows[asked[nearer]]] = c
        return cluster


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    return ((vectors - centroid) ** 2).sum(axis=1)


# ---- the job

def _integers(rows: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    kept = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), vector.alias("v")).filter(F.size("v") == dims)
    whole = F.transform("v", lambda x: F.floor(x * scale))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) <= LARGEST))
    return kept.filter(fine).select("vec_id", whole.alias("v"))


def _matrix(column, dims) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _extent(whole: DataFrame, dims: int):
    """Least and greatest value of each dimension; a row for each batch goes to one more aggregate, not the vectors."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column(0), dims)
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.list_(pa.int64())) for x in (v.min(axis=0), v.max(axis=0))], ["low", "high"])

    ends = whole.select("v").mapInArrow(run, "low array<bigint>, high array<bigint>")
    ends = ends.agg(*[f(F.col(c)[d]).alias(f"{c}{d}") for c, f in (("low", F.min), ("high", F.max)) for d in range(dims)]).first()
    return (None, None) if ends[0] is None else (np.array(ends[:dims], np.int64), np.array(ends[dims:], np.int64))


def _sums(table: DataFrame, cells: Cells, centroids: np.ndarray, dims: int):
    """For each cluster the number of its vectors and their sum, added up in each task first."""
    def run(batches):
        assigner, k = Assigner(cells, centroids), len(centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(1), dims)
            cluster = assigner.assign(_packed(batch.column(0)), vectors.__getitem__)
            count += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] += vectors[cluster == c].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
                                         ["cluster", "n", "total"])

    parts = table.select("cells", "v").mapInArrow(run, "cluster bigint, n bigint, total array<bigint>")
    sums = [F.sum(F.col("total")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect()


def _packed(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1) if len(column) else np.empty((0, 0), np.uint8)


def cluster(rows: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, bits: int = 6,
            sample: int = 4_096, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Integer k-means on ``floor(scale * x)``: vectors start as centroids, ``rounds`` times each centroid becomes the floored
    mean of its vectors, then all vectors are assigned.

    Columns: ``vec_id, cluster, distance`` (squared), ``cluster_inertia, inertia`` (distances summed over the cluster and over
    all), ``centroid_sha256`` (of the final centroid's components, as decimals joined by commas). Centroids start as the
    ``k`` vectors with the smallest SHA-256 of ``seed:id``, a null id as no digits, ties by the vector; fewer vectors, fewer centroids. A cluster that
    is empty keeps its centroid. Vectors with another number of components, or with a null, non-finite or too large one
    (integers beyond 2^27, whose distances need not fit a long) are left out. Repeated rows count as often as they occur,
    an empty table gives an empty table, other columns are not read.

    Cells are fitted to the ``sample`` vectors that come first in the order of the hash, and bear on speed alone. What is gathered is that sample, the extent of each dimension, and a sum for each cluster.
    """
    whole = _integers(rows, dims, scale, id_col, vector_col)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = whole.select("v", digest.alias("hash")).orderBy("hash", "v").limit(max(k, sample)).select("v").collect()
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not first:
        return rows.sparkSession.createDataFrame([], schema)
    first = np.array([r.v for r in first], np.int64)
    low, high = _extent(whole, dims)
    cells, centroids = Cells(first, low, high, bits), first[:k]

    def encode(batches):
        for batch in batches:
            packed = cells.encode(_matrix(batch.column(1), dims))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p.tobytes() for p in packed], pa.binary()), batch.column(1)],
                                             ["vec_id", "cells", "v"])

    coded = whole.mapInArrow(encode, "vec_id bigint, cells binary, v array<bigint>")
    table = staged(coded.select("vec_id", "cells", F.col("v").cast("array<int>").alias("v")), "cells")
    for _ in range(rounds):
        centroids = centroids.copy()
        for row in _sums(table, cells, centroids, dims):
            centroids[row.cluster] = [int(row[2 + d]) // row.n for d in range(dims)]

    def assign(batches):
        assigner = Assigner(cells, centroids)
        for batch in batches:
            vectors = _matrix(batch.column(2), dims)
            found = assigner.assign(_packed(batch.column(1)), vectors.__getitem__)
            distance = ((vectors - centroids[found]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32()), pa.array(distance, pa.int64())],
                                             ["vec_id", "cluster", "distance"])

    found = staged(table.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), "assigned")
    inertia = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    about = {c: F.struct(F.lit(s).cast("bigint").alias("cluster_inertia"),
                         F.lit(hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()).alias("centroid_sha256"))
             for c, s in inertia.items()}
    about = F.create_map(*[x for c, s in about.items() for x in (F.lit(c), s)])
    return found.withColumn("about", about[F.col("cluster")]).select(
        "vec_id", "cluster", "distance", "about.cluster_inertia", F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        "about.centroid_sha256")
