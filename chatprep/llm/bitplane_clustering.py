"""Centroid clustering on packed bit planes.

A component x becomes the integer floor(1024 * x).  Bit plane j of a vector holds bit j of
all its 64 components in one 64-bit word, so a vector of integers of ``p`` bits is ``p``
words in two's complement: the last plane weighs -2^(p-1), plane j below it 2^j.  The inner
product of two vectors is then

    sum over planes i, j of weight(i) * weight(j) * popcount(a[i] & c[j])

and the squared distance |a|^2 + |c|^2 - 2 a.c is exact.  Column sums come from the planes
too: the count of set bits of each plane and component, times the weight of the plane.

The planes are stored once.  A round reads them, assigns every vector and adds the members
of each centroid up inside the task; only those sums (``k`` rows per batch at most) are
shuffled, and only the ``k`` centroids reach the driver, so no cluster is ever a group of a
task, whatever its share of the rows.  Rounds don't build on each other's lineage.

Vectors without exactly 64 components, or with a null, NaN or infinite one, are left out.
Repeated rows are vectors of their own; rows with a null id take part, but start no
centroid unless there are too few others.  Equal starts are ordered by their components.
With fewer than ``k`` vectors there are that many centroids; an empty table gives an empty
result.  Distances must fit a long: components of 2^27 / 1024 and more stop the job with a
message.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.llm.common import read_table, stage

WIDTH = 64  # components, one bit each in a plane
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
LARGEST = 1 << 27
PACKED = "vec_id bigint, planes binary, norm bigint"


def plane_weights(count: int) -> np.ndarray:
    weights = np.left_shift(np.int64(1), np.arange(count, dtype=np.int64))
    weights[-1] = -weights[-1]
    return weights


def pack(values: np.ndarray) -> np.ndarray:
    """Integers (rows, 64) to planes (rows, bits): as many as the largest of them needs."""
    reach = int(max(values.max(initial=0), -1 - values.min(initial=0)))
    shifts = np.arange(reach.bit_length() + 1, dtype=np.int64)
    bits = ((values[:, None, :] >> shifts[None, :, None]) & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def unpack(planes: np.ndarray) -> np.ndarray:
    """Planes (rows, bits) to integers (rows, 64)."""
    return np.tensordot(plane_bits(planes), plane_weights(planes.shape[1]), axes=([1], [0]))


def plane_bits(planes: np.ndarray) -> np.ndarray:
    """0 and 1 (rows, bits, 64) of packed planes."""
    flat = np.ascontiguousarray(planes)[:, :, None].view(np.uint8)
    return np.unpackbits(flat, axis=2, bitorder="little").astype(np.int64)


def inner_products(planes: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Inner product of each packed row with one packed vector."""
    total = np.zeros(len(planes), np.int64)
    outer = plane_weights(len(centre))
    for i, weight in enumerate(plane_weights(planes.shape[1])):
        ones = np.bitwise_count(planes[:, i, None] & centre[None, :]).astype(np.int64)
        total += weight * (ones @ outer)
    return total


def norms(planes: np.ndarray) -> np.ndarray:
    weights = plane_weights(planes.shape[1])
    total = np.zeros(len(planes), np.int64)
    for i, weight in enumerate(weights):
        total += weight * (np.bitwise_count(planes & planes[:, i, None]).astype(np.int64) @ weights)
    return total


def nearest(planes: np.ndarray, norm: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller of equals) and the squared distance to it."""
    packed = pack(centres)
    gaps = np.stack([norm + own - 2 * inner_products(planes, c) for c, own in zip(packed, norms(packed))], axis=1)
    cluster = gaps.argmin(axis=1)
    return cluster, gaps[np.arange(len(cluster)), cluster]


def member_sums(planes: np.ndarray, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Members per centroid, and their component sums (k, 64)."""
    counts = np.bincount(cluster, minlength=k)
    member = (cluster[None, :] == np.arange(k)[:, None]).astype(np.float64)
    sums = np.zeros((k, WIDTH), np.int64)
    for i, weight in enumerate(plane_weights(planes.shape[1])):
        ones = member @ plane_bits(planes[:, i : i + 1])[:, 0, :].astype(np.float64)  # exact: below 2^53
        sums += weight * ones.astype(np.int64)
    return counts, sums


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(1)
        sizes = np.asarray(column.value_lengths().fill_null(0))
        right = batch.filter(pa.array(sizes == WIDTH))
        if not right.num_rows:
            continue
        flat = right.column(1).flatten().cast(pa.float64())
        known = np.asarray(flat.is_valid()).reshape(-1, WIDTH).all(axis=1)
        x = np.asarray(flat.fill_null(0)).reshape(-1, WIDTH)
        keep = known & np.isfinite(x).all(axis=1)
        if not keep.any():
            continue
        whole = np.floor(x[keep] * SCALE)
        if (np.abs(whole) >= LARGEST).any():
            raise ValueError(f"a component of {LARGEST // SCALE} or more: distances would not fit a long")
        planes = pack(whole.astype(np.int64))
        width = planes.shape[1] * 8
        edges = np.arange(len(planes) + 1, dtype=np.int32) * width
        stored = pa.Array.from_buffers(pa.binary(), len(planes), [None, pa.py_buffer(edges), pa.py_buffer(planes.tobytes())])
        yield pa.RecordBatch.from_arrays(
            [right.column(0).filter(pa.array(keep)), stored, pa.array(norms(planes))], names=["vec_id", "planes", "norm"]
        )


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of a batch with their planes; rows of batches packed apart may differ in width."""
    sizes = np.asarray(pc.binary_length(batch.column("planes")))
    for size in np.unique(sizes):
        rows = batch.filter(pa.array(sizes == size))
        planes = np.frombuffer(b"".join(rows.column("planes").to_pylist()), np.uint64).reshape(rows.num_rows, -1)
        yield rows, planes


def _sum_members(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centres)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, WIDTH), np.int64)
        for batch in batches:
            for rows, planes in _by_width(batch):
                cluster, _ = nearest(planes, np.asarray(rows.column("norm")), centres)
                more, add = member_sums(planes, cluster, k)
                counts, sums = counts + more, sums + add
        seen = np.flatnonzero(counts)
        if len(seen):
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.int32()), pa.array(counts[seen]), pa.array(list(sums[seen]), pa.list_(pa.int64()))],
                names=["cluster", "members", "sums"],
            )

    return run


def _assign(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, planes in _by_width(batch):
                cluster, gap = nearest(planes, np.asarray(rows.column("norm")), centres)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(gap)], names=["vec_id", "cluster", "distance"]
                )

    return run


def packed_vectors(vectors: DataFrame, vec_id: Column, embedding: Column) -> DataFrame:
    """(vec_id, planes, norm) of every vector that is kept."""
    return vectors.select(vec_id.cast("bigint").alias("vec_id"), embedding.alias("embedding")).mapInArrow(_pack_rows, PACKED)


def first_centroids(packed: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the least hash of their ids, in that order."""
    draw = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = packed.select(draw.alias("draw"), "planes").orderBy(F.col("draw").asc_nulls_last(), "planes").limit(k).collect()
    centres = [unpack(np.frombuffer(bytes(r["planes"]), np.uint64)[None, :])[0] for r in rows]
    return np.array(centres, np.int64).reshape(-1, WIDTH)


def cluster_packed(packed: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = "3") -> tuple[np.ndarray, DataFrame]:
    """The final centroids, and (vec_id, cluster, distance) of every packed vector."""
    centres = first_centroids(packed, k, salt)
    for _ in range(rounds if len(centres) else 0):
        found = packed.mapInArrow(_sum_members(centres), "cluster int, members bigint, sums array<bigint>")
        # One row per task and centroid, added up per centroid and component: k * 64 rows at most.
        parts = found.select("cluster", "members", F.posexplode("sums").alias("at", "part"))
        totals = parts.groupBy("cluster", "at").agg(F.sum("members").alias("members"), F.sum("part").alias("total"))
        moved = centres.copy()
        for r in totals.collect():
            moved[r["cluster"], r["at"]] = r["total"] // r["members"]
        if (moved == centres).all():
            break  # every further round would give the same
        centres = moved
    return centres, packed.mapInArrow(_assign(centres), "vec_id bigint, cluster int, distance bigint")


def cluster_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid of every kept vector.

    Sums beyond a long are null.
    """
    packed = stage(packed_vectors(vectors, F.col(vec_id), F.col(embedding)), "bit-planes")
    centres, assigned = cluster_packed(packed, k, rounds)
    assigned = stage(assigned, "assigned-vectors")
    spark = vectors.sparkSession
    names = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest(), c) for i, c in enumerate(centres.tolist())]
    ends = spark.createDataFrame(names, "cluster int, centroid_sha256 string, centroid array<bigint>")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))  # k rows
    whole = sums.agg(F.sum("own").alias("every"))
    told = sums.join(ends, "cluster").crossJoin(whole).select(
        "cluster",
        F.expr("try_cast(own AS bigint)").alias("cluster_inertia"),
        F.expr("try_cast(every AS bigint)").alias("inertia"),
        "centroid_sha256",
        "centroid",
    )
    return assigned.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )


def op13_bitplane_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read_table(spark, sf_dir, "embeddings")).drop("centroid")


def oracle(k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The same clustering in SQL, one common table expression per round."""
    nearest = """
SELECT rn, cluster, distance FROM (
  SELECT v.rn, c.cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance,
    row_number() OVER (PARTITION BY v.rn ORDER BY sum((v.x - c.x) * (v.x - c.x)), c.cluster) AS nth
  FROM parts v JOIN c{0} c USING (pos) GROUP BY v.rn, c.cluster
) WHERE nth = 1"""
    steps = []
    for n in range(rounds):
        steps.append(f"a{n} AS MATERIALIZED ({nearest.format(n)})")
        steps.append(
            f"""c{n + 1} AS MATERIALIZED (
SELECT c.cluster, c.pos, CASE WHEN m.n IS NULL THEN c.x ELSE CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS BIGINT) END AS x
FROM c{n} c LEFT JOIN (
  SELECT cluster, pos, sum(x) AS s, count(*) AS n FROM a{n} JOIN parts USING (rn) GROUP BY cluster, pos
) m ON m.cluster = c.cluster AND m.pos = c.pos)"""
        )
    between = ",\n".join(steps)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * {SCALE}) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {WIDTH}
), parts AS MATERIALIZED (
  SELECT rn, unnest(range(1, {WIDTH + 1})) AS pos, unnest(x) AS x FROM kept
), c0 AS MATERIALIZED (
  SELECT cluster, unnest(range(1, {WIDTH + 1})) AS pos, unnest(x) AS x
  FROM (SELECT x, row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) - 1 AS cluster FROM kept)
  WHERE cluster < {k}
), {between}, last AS MATERIALIZED ({nearest.format(rounds)}
), ends AS (
  SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM last JOIN kept USING (rn) JOIN ends USING (cluster)
"""


ORACLE = oracle()
