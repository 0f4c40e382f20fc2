"""Centroid clustering in whole numbers, with distances by lookup.

In every round each batch of vectors tabulates, for every dimension, the squared difference of each value that occurs
there to each centroid; a vector's distances are then gathered from the tables and added up. Tasks give sums per cluster and
dimension, as limbs of 60 bits that Spark adds as decimals, so centroids are exact whatever the values and the order of
rows. Only those sums, one per cluster, dimension and limb, reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import ship, staged
from citylake.llm.vectors import flat, whole_numbers

CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3
# Below this size squared differences of a thousand dimensions add up within a long.
SMALL = 2.0**25
LIMB = 60

ship(__name__)


def _matrix(column, dims: int, small: bool):
    """Vectors of a batch as rows: longs, or Python's integers where they may be large."""
    import numpy as np

    whole = flat(column)[0].reshape(-1, dims)
    if small and np.abs(whole).max(initial=0) < SMALL:
        return whole.astype("i8")
    return np.array([[int(x) for x in row] for row in whole], object).reshape(-1, dims)


def distances(vectors, centroids):
    """Squared Euclidean distance of every row to every centroid."""
    import numpy as np

    total = np.zeros((len(vectors), len(centroids)), vectors.dtype)
    for d in range(vectors.shape[1]):
        occurring, at = np.unique(vectors[:, d], return_inverse=True)
        table = (occurring[:, None] - centroids[None, :, d]) ** 2
        total += table[at]
    return total


def nearest(vectors, centroids):
    """The nearest centroid of every row, the smaller number of equally near ones, and its distance."""
    import numpy as np

    far = distances(vectors, centroids)
    at = far.argmin(axis=1) if len(far) else np.zeros(0, "i8")
    return at, far[np.arange(len(far)), at]


def _assigned(batches: Iterator, centroids: list[list[int]], dims: int) -> Iterator:
    """Each batch with its matrix, clusters and distances."""
    import numpy as np

    small = max((abs(x) for c in centroids for x in c), default=0) < SMALL and dims <= 1024
    for batch in batches:
        vectors = _matrix(batch.column("v"), dims, small)
        yield (batch, vectors, *nearest(vectors, np.array(centroids, vectors.dtype).reshape(-1, dims)))


def _sums(centroids: list[list[int]], dims: int):
    """Sums and counts of the clusters of a task, taken apart into limbs; the count is dimension ``dims``."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros((len(centroids), dims + 1), object)
        for _, vectors, at, _ in _assigned(batches, centroids, dims):
            for cluster in np.unique(at):
                own = vectors[at == cluster]
                total[cluster, :dims] += own.sum(axis=0).astype(object)
                total[cluster, dims] += len(own)
        rows = []
        for (cluster, d), value in np.ndenumerate(total):
            value, limb = int(value), 0
            while value:
                value, low = (value >> LIMB, value & ((1 << LIMB) - 1)) if abs(value) >> LIMB else (0, value)
                rows.append((cluster, d, limb, low))
                limb += 1
        columns = list(zip(*rows)) or [[], [], [], []]
        names, types = ["cluster", "d", "limb", "low"], [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def _assign(centroids: list[list[int]], dims: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch, _, at, far in _assigned(batches, centroids, dims):
            far = np.minimum(far, 2**63 - 1).astype("i8")
            columns = [batch.column("vec_id"), pa.array(at.astype("i4")), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return run


def first_centroids(rows: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors whose id, after the seed, has the smallest digests. Equal digests go by the vector's values."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(digest.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k)
    return [[int(x) for x in r["v"]] for r in first.collect()]


def move(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: every centroid becomes the floor of its vectors' mean; one without vectors stays."""
    dims = len(centroids[0])
    parts = rows.mapInArrow(_sums(centroids, dims), "cluster int, d int, limb int, low bigint")
    added = parts.groupBy("cluster", "d", "limb").agg(F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    total: dict[tuple[int, int], int] = {}
    for cluster, d, limb, low in added.collect():  # clusters x (dimensions + 1), a few limbs each
        total[cluster, d] = total.get((cluster, d), 0) + (int(low) << (LIMB * limb))
    counts = [total.get((c, dims), 0) for c in range(len(centroids))]
    return [
        [total.get((c, d), 0) // counts[c] for d in range(dims)] if counts[c] else old for c, old in enumerate(centroids)
    ]


def fit(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> list[list[int]]:
    """Centroids of whole vectors ``v`` after so many rounds; fewer than ``k`` where there are fewer rows."""
    centroids = first_centroids(rows, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = move(rows, centroids)
    return centroids


def assign(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``vec_id``, ``cluster`` and squared ``distance`` of every row."""
    return rows.mapInArrow(_assign(centroids, len(centroids[0])), "vec_id bigint, cluster int, distance bigint")


def cluster(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED
) -> DataFrame:
    """Every vector with its cluster, its distance, the inertia of its cluster and of all, and its centroid's digest.

    Vectors take part that have ``dims`` components, none null or non-finite, as floor(scale * x). The others
    have no row. Rows that repeat an id, or have none, are vectors each (the first centroids are taken from rows with an id
    first). Equally near centroids: the smaller number. Equal centroids are allowed; then the larger number stays empty. A
    distance or inertia beyond a long is given as the largest long. No vectors give no rows. Further columns are not read.
    """
    spark = vectors.sparkSession
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    rows = staged(whole_numbers(vectors, scale, dims).select("vec_id", "v"), "whole-vectors")
    centroids = fit(rows, k, rounds, seed)
    if not centroids:
        return spark.createDataFrame([], schema)
    assigned = staged(assign(rows, centroids), "clusters")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()  # one row a cluster
    own = {c: int(total) for c, total in sums}
    most = 2**63 - 1
    told = [
        (c, min(own[c], most), min(sum(own.values()), most), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c in sorted(own)
    ]
    clusters = spark.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
