"""Centroid clustering of integer vectors in Spark's own expressions: no Python in any task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import written

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, "3"
#: Components beyond this count as this: squared distances of 64 components then fit a bigint.
LARGEST = 2**27


def integer_vectors(table: DataFrame, vector: str = "embedding", size: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``table`` with the integer vector ``v`` in place of ``vector``: floor(scale * x) of each component as double.

    Vectors that are null, of another size, or with a null or non-finite component go. Integers beyond
    ``LARGEST`` (components beyond 131,072 at a scale of 1024) are set to it, since their squared distances fit no bigint.
    """
    whole = F.col(vector).cast("array<double>")
    bad = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    bound = lambda x: F.greatest(F.least(x, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))
    kept = table.filter((F.size(F.col(vector)) == size) & ~F.coalesce(bad, F.lit(True)))
    integers = F.transform(whole, lambda x: F.floor(bound(x * F.lit(float(scale)))).cast("long"))
    return kept.select(*[F.col(c) for c in table.columns if c not in (vector, "v")], integers.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: str, vec_id: str = "vec_id") -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of ``seed:vec_id``, ties by components; a missing vec_id is written ``null``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(vec_id).cast("string"), F.lit("null")))
    return [list(r["v"]) for r in vectors.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()]


def _literal(centroid: list[int]) -> Column:
    return F.array(*[F.lit(x).cast("long") for x in centroid])


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """(distance, cluster) of the nearest centroid: squared Euclidean, ties to the smaller number."""
    square = lambda a, b: (a - b) * (a - b)
    each = [
        F.struct(F.aggregate(F.zip_with(v, _literal(c), square), F.lit(0).cast("long"), lambda s, x: s + x).alias("distance"), F.lit(i).alias("cluster"))
        for i, c in enumerate(centroids)]
    return F.array_min(F.array(*each))


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid replaced by its vectors' componentwise floor(sum / count); those without vectors stay.

    Sums combine on the map side, so a round shuffles one row for each task and cluster.
    """
    size = len(centroids[0])
    own = vectors.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v")
    sums = own.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(size)])
    new = list(centroids)
    for row in sums.collect():  # one row for each cluster
        new[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(size)]
    return new


def clusters(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Columns of ``vectors`` but ``v``, with cluster, distance, cluster_inertia, inertia and centroid_sha256."""
    found = vectors.withColumn("_near", nearest(F.col("v"), centroids))
    sums = found.groupBy(F.col("_near.cluster").alias("_c")).agg(F.sum(F.col("_near.distance").cast("decimal(38,0)")).alias("d")).collect()  # one row for each cluster
    text = [",".join(map(str, c)) for c in centroids]
    # Sums that no bigint holds give null, not an error.
    known = {r["_c"]: int(r["d"]) for r in sums}
    total = sum(known.values())
    number = lambda x: F.lit(x if x < 2**63 else None).cast("long")
    pick = lambda of: F.get(F.array(*[of(i) for i in range(len(centroids))]), F.col("_near.cluster"))
    names = [F.col(c) for c in vectors.columns if c not in ("v", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")]
    return found.select(
        *names, F.col("_near.cluster").alias("cluster"), F.col("_near.distance").alias("distance"),
        pick(lambda i: number(known.get(i, 0))).alias("cluster_inertia"), number(total).alias("inertia"), pick(lambda i: F.sha2(F.lit(text[i]), 256)).alias("centroid_sha256"))


def centroid_clusters(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
    size: int = DIMENSIONS, scale: int = SCALE, seed: str = SEED,
) -> DataFrame:
    """Lloyd's rounds over integer vectors; one row for each kept vector: its columns but the vector, and those of ``clusters``.

    ``zip_with`` and ``aggregate`` compute exact integer distances to literal centroid arrays, ``array_min`` of structs takes the
    nearest. All that reaches the driver are k centroids and their sums. Fewer than k kept vectors make as many
    centroids; an empty table gives an empty one. Rows that repeat a vec_id are vectors of their own, rows without one too. Columns of
    ``table`` named like an added one (``v`` too) are replaced.
    """
    vectors = written(integer_vectors(table, vector, size, scale), "vectors")
    centroids = first_centroids(vectors, k, seed, vec_id)
    if not centroids:
        nothing = [[0] * size]
        return clusters(vectors, nothing)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return clusters(vectors, centroids)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return centroid_clusters(table).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
