"""Clusters of integer vectors by their nearest centroid (Walsh-Hadamard progressive search).

Vectors and centroids are transformed by the Walsh-Hadamard matrix, which is exact in integers and keeps squared
distances up to the factor 64. Coefficients are ordered from coarse (few changes of sign) to fine. The differences
are added up in steps of 1, 1, 2, 4, 8, 16 and 32 coefficients; a sum only grows, so a centroid whose sum is already greater
than a whole distance that is known cannot be nearest and is left out from then on. Those that stay are finished over all 64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.llm.common import stored

DIMS = 64
_STEPS = (0, 1, 2, 4, 8, 16, 32, 64)
_MOST = 1 << 60  # components beyond are set to it: their distances fit into no long
_SAFE = 1 << 24  # up to here 64 squared differences of coefficients add up below 2**63
_LONG = (1 << 63) - 1
_LOW = 40  # bits of the lower part of a sum
_ROWS = 4096


def _sequency() -> np.ndarray:
    """Rows of the matrix by their changes of sign."""
    h = walsh(np.eye(DIMS, dtype=np.int64))
    return np.argsort((np.diff(h, axis=1) != 0).sum(1), kind="stable")


def walsh(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows."""
    n, width = len(x), 1
    while width < DIMS:
        pairs = x.reshape(n, -1, 2, width)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(n, DIMS)
        width *= 2
    return x


_ORDER = _sequency()


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the number of the nearest centroid, of several the smallest, and the squared distance."""
    if max((int(np.abs(a).max()) for a in (vectors, centroids) if a.size), default=0) > _SAFE:
        vectors, centroids = vectors.astype(object), centroids.astype(object)  # integers of any size, by the same steps
    v, c = walsh(vectors)[:, _ORDER], walsh(centroids)[:, _ORDER]
    sums = np.zeros((len(v), len(c)), v.dtype)
    open_ = np.ones(sums.shape, bool)
    bound = None
    for low, high in zip(_STEPS, _STEPS[1:]):
        row, at = np.nonzero(open_)
        d = v[row, low:high] - c[at, low:high]
        sums[row, at] += (d * d).sum(1)
        if bound is None or high == 8:  # whole distance to the centroid that is nearest so far
            guess = np.where(open_, sums, sums.max() + 1 if sums.size else 0).argmin(1)
            whole = ((v - c[guess]) ** 2).sum(1)
            bound = whole if bound is None else np.minimum(bound, whole)
        open_ &= sums <= bound[:, None]
    best = np.where(open_, sums, sums.max() + 1 if sums.size else 0).argmin(1)
    return best, sums[np.arange(len(v)), best] // DIMS


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): floor(64 * x) of the vectors with exactly 64 finite components."""
    x = F.col(embedding).cast("array<double>")
    finite = F.forall(x, lambda y: F.coalesce(~F.isnan(y) & (F.abs(y) != float("inf")), F.lit(False)))
    whole = F.transform(x, lambda y: F.greatest(F.least(F.floor(y * DIMS), F.lit(_MOST)), F.lit(-_MOST)))
    return vectors.where(F.coalesce((F.size(x) == DIMS) & finite, F.lit(False))).select(F.col(vec_id).alias("vec_id"), whole.alias("v"))


def _numbers(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, _ROWS):
        part = batch.slice(at, _ROWS)
        yield part, part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMS)


def _means(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The floors of the means of each centroid's vectors; a centroid without vectors stays."""
    k = len(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.array(centroids, np.int64)
        counts, high, low = np.zeros(k, np.int64), np.zeros((k, DIMS), np.int64), np.zeros((k, DIMS), np.int64)
        for batch in batches:
            for _, v in _numbers(batch):
                best, _ = nearest(v, c)
                counts += np.bincount(best, minlength=k)
                for i in range(k):
                    own = v[best == i]
                    high[i] += (own >> _LOW).sum(0)
                    low[i] += (own & ((1 << _LOW) - 1)).sum(0)
        held = np.flatnonzero(counts)
        if len(held):
            columns = [np.repeat(held, DIMS), np.tile(np.arange(DIMS), len(held)), np.repeat(counts[held], DIMS), high[held].ravel(), low[held].ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["c", "dim", "n", "high", "low"])

    parts = kept.select("v").mapInArrow(add, "c long, dim long, n long, high long, low long")
    exact = lambda x: F.sum(F.col(x).cast("decimal(38,0)")).alias(x)
    # 64 numbers for each centroid
    found = parts.groupBy("c", "dim").agg(exact("n"), exact("high"), exact("low")).collect()
    means = [list(c) for c in centroids]
    for r in found:
        means[r["c"]][r["dim"]] = ((int(r["high"]) << _LOW) + int(r["low"])) // int(r["n"])
    return means


def _assigned(kept: DataFrame, centroids: list[list[int]]) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.array(centroids, np.int64)
        for batch in batches:
            for part, v in _numbers(batch):
                best, d = nearest(v, c)
                d = [min(int(x), _LONG) for x in d] if d.dtype == object else d
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(best, pa.int32()), pa.array(d, pa.int64())], ["vec_id", "cluster", "distance"])

    schema = T.StructType([kept.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    return kept.mapInArrow(assign, schema)


def cluster_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 16, rounds: int = 3, salt: str = "1:") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector of 64 finite components; others have no row.

    Centroids start as the ``k`` vectors with the smallest sha256 of ``salt`` and id, or all if there are fewer; of rows with one id the smaller
    vector comes first, and null ids last. Repeated rows are vectors of their own. Components are bounded to 2**60 either way; a distance
    or sum of distances that no long holds is given as the largest long. Without vectors the result is empty.
    """
    kept = stored(integer_vectors(vectors, vec_id, embedding), "vectors")
    name = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    centroids = [list(r["v"]) for r in kept.orderBy(name.asc_nulls_last(), "v").limit(k).collect()]
    if not centroids:
        columns = "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256"
        return kept.selectExpr("vec_id", *columns)
    for _ in range(rounds):
        centroids = _means(kept, centroids)
    assigned = stored(_assigned(kept, centroids), "assigned")
    sums = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    of_cluster = lambda values: F.array(*[F.lit(x) for x in values])[F.col("cluster")]
    bounded = lambda x: F.lit(min(x, _LONG)).cast("long")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia: Column = F.array(*[bounded(sums.get(i, 0)) for i in range(len(centroids))])[F.col("cluster")]
    return assigned.select("vec_id", "cluster", "distance", inertia.alias("cluster_inertia"), bounded(sum(sums.values())).alias("inertia"), of_cluster(digests).alias("centroid_sha256"))
