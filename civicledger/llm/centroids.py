"""Lloyd's clustering of integer vectors, sharded by dimension.

A vector is cut into blocks of neighbouring components. A block's task knows only its own columns and the matching
slices of all centroids: it computes exact partial squared distances, which are added up per vector (reduce by key,
then the nearest centroid), and it sums its columns per cluster, from which each slice of a centroid is made anew.
No task ever holds whole vectors and whole centroids; what reaches the driver is one number per centroid and component.

Arithmetic is on integers throughout, so results depend neither on the order of sums nor on the partitioning.

A vector is kept if it has exactly ``dims`` components, none null or not finite. Components are ``floor(scale * x)``,
clipped to +-``LIMIT`` so that a distance fits into a long. Null and repeated ids are rows like any other (a null id
comes last where starting centroids are chosen; rows equal in id are taken in order of their components). With fewer
kept vectors than centroids there are as many centroids as vectors; without any the result is empty. Ties go to the
centroid with the smaller number. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.session import scratch_dir

DIMS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
WIDTH = 32
SEED = 1
LIMIT = 1 << 22


def quantised(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and the integer components ``q`` of the vectors that are kept."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    floor = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    whole = (F.size("embedding") == dims) & ~bad
    return vectors.filter(F.coalesce(whole, F.lit(False))).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", floor).alias("q"))


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.q) for r in kept.orderBy(name.asc_nulls_last(), "q").limit(clusters).collect()]


def write_shards(kept: DataFrame, path: str, dims: int, width: int) -> None:
    """One folder per block of columns; ``row`` numbers the vectors."""
    blocks = F.array(*[F.struct(F.lit(b).alias("block"), F.slice("q", b * width + 1, width).alias("part")) for b in range(-(-dims // width))])
    numbered = kept.withColumn("row", F.monotonically_increasing_id())
    numbered.select("row", "vec_id", F.inline(blocks)).write.partitionBy("block").parquet(path)


def _of_block(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The block, its row places in the batch and their columns, for each block in a batch."""
    block, parts = batch.column("block").to_numpy(), batch.column("part")
    for b in np.unique(block).tolist():
        at = np.flatnonzero(block == b)
        flat = parts.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        yield b, at, flat.reshape(len(at), -1)


def _partial_distances(centroids: np.ndarray, width: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "vec_id", *[f"d{k}" for k in range(len(centroids))]]
        for batch in stream:
            for b, at, x in _of_block(batch):
                slices = centroids[:, b * width : (b + 1) * width]
                apart = (x * x).sum(axis=1)[:, None] - 2 * (x @ slices.T) + (slices * slices).sum(axis=1)
                own = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([own.column("row"), own.column("vec_id"), *[pa.array(np.ascontiguousarray(c)) for c in apart.T]], names=names)

    return run


def nearest(shards: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    """``row``, ``vec_id``, ``cluster`` and squared ``distance`` of every vector, from partial distances by block."""
    columns = [f"d{k}" for k in range(len(centroids))]
    schema = "row bigint, vec_id bigint, " + ", ".join(f"{c} bigint" for c in columns)
    added = shards.mapInArrow(_partial_distances(centroids, width), schema).groupBy("row").agg(F.max("vec_id").alias("vec_id"), *[F.sum(c).alias(c) for c in columns])
    each = [F.struct(F.col(c).alias("distance"), F.lit(k).alias("cluster")) for k, c in enumerate(columns)]
    return added.select("row", "vec_id", (F.least(*each) if len(each) > 1 else each[0]).alias("best")).select("row", "vec_id", "best.*")


def _partial_sums(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for b, at, x in _of_block(batch):
            clusters, which, counts = np.unique(batch.column("cluster").to_numpy()[at], return_inverse=True, return_counts=True)
            sums = np.zeros((len(clusters), x.shape[1]), np.int64)
            np.add.at(sums, which, x)
            n = len(clusters)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, b, np.int32)), pa.array(clusters.astype(np.int32)), pa.array(counts), pa.array(list(sums), pa.list_(pa.int64()))], names=["block", "cluster", "n", "sums"]
            )


def moved(shards: DataFrame, assigned: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """Each block's slice of every centroid: the floor of the mean of its vectors' columns; without vectors it stays."""
    parts = shards.join(assigned.select("row", "cluster"), "row").select("block", "part", "cluster")
    sums = parts.mapInArrow(_partial_sums, "block int, cluster int, n bigint, sums array<bigint>").select("block", "cluster", "n", F.posexplode("sums").alias("place", "sum"))
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    slices = sums.groupBy("block", "cluster", "place").agg(exact("n"), exact("sum"))
    out = centroids.copy()
    for r in slices.select("block", "cluster", "place", F.expr("cast((sum - pmod(sum, n)) div n as bigint)").alias("mean")).collect():
        out[r.cluster, r.block * width + r.place] = r.mean
    return out


def clustered(spark: SparkSession, vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """Assignment of every kept vector to the final centroids, written in the shared folder, and these centroids."""
    base = scratch_dir(spark, "centroids")
    write_shards(quantised(vectors, dims, scale), f"{base}/shards", dims, width)
    shards = spark.read.schema("row bigint, vec_id bigint, part array<int>, block int").parquet(f"{base}/shards")
    centroids = np.array(first_centroids(quantised(vectors, dims, scale), clusters, seed), np.int64).reshape(-1, dims)
    if not len(centroids):
        return spark.createDataFrame([], "row bigint, vec_id bigint, distance bigint, cluster int"), centroids
    for _ in range(rounds):
        centroids = moved(shards, nearest(shards, centroids, width), centroids, width)
    nearest(shards, centroids, width).write.parquet(f"{base}/assigned")
    return spark.read.schema("row bigint, vec_id bigint, distance bigint, cluster int").parquet(f"{base}/assigned"), centroids


def digests(spark: SparkSession, vectors: DataFrame, **parameters) -> DataFrame:
    """Per kept vector: ``cluster``, ``distance``, the inertia of its cluster and of all, and a hash of its centroid."""
    assigned, centroids = clustered(spark, vectors, **parameters)
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(k, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest()) for k, s in sums.items()]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
