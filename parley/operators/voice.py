"""Voice vectors: centroids and the target speaker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import cosine, norm


def mean_vector(rows: DataFrame, keys: list[str], vector: str = "embedding") -> DataFrame:
    dims = rows.select(*keys, F.posexplode(vector).alias("d", "x")).groupBy(*keys, "d").agg(F.avg("x").alias("x"))
    return dims.groupBy(*keys).agg(F.expr("transform(array_sort(collect_list(struct(d, x))), y -> y.x)").alias(vector))


def scaled(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Length 1; null and zero vectors are dropped."""
    v = rows.withColumn(vector, F.col(vector).cast("array<double>")).withColumn("n_", norm(F.col(vector))).filter("n_ > 0")
    return v.withColumn(vector, F.transform(vector, lambda x: x / F.col("n_"))).drop("n_")


def centroids(rows: DataFrame, keys: list[str], vector: str = "embedding") -> DataFrame:
    """Per key: vectors scaled to length 1, averaged, scaled again."""
    return scaled(mean_vector(scaled(rows, vector), keys, vector), vector)


def long_enough(rows: DataFrame, seconds: float = 1.0) -> DataFrame:
    return rows.filter(F.col("end") - F.col("start") >= seconds)


def reference_centroid(samples: DataFrame) -> DataFrame:
    """One row: the mean of the raw vectors."""
    return mean_vector(samples.withColumn("k", F.lit(0)), ["k"]).select(F.col("embedding").alias("reference"))


def similar(speakers: DataFrame, reference: DataFrame) -> DataFrame:
    """Adds `similarity` to the one reference vector, which is broadcast."""
    both = speakers.join(F.broadcast(reference))
    return both.withColumn("similarity", cosine(F.col("embedding").cast("array<double>"), F.col("reference").cast("array<double>"))).drop("reference")


def rank_speakers(speakers: DataFrame, reference: DataFrame, keys=(), order: str = "speaker", top: int = 1000) -> DataFrame:
    """Adds `similarity` and `rank`, ties in the given order: within the keys, or without keys of the `top` of all."""
    s = similar(speakers, reference)
    by = [F.desc_nulls_last("similarity"), order]
    if keys:
        return s.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*by)))
    return s.orderBy(*by).limit(top).withColumn("rank", F.row_number().over(W.orderBy(*by)))


def identify(speakers: DataFrame, reference: DataFrame, threshold: float = 0.70, keys=("file_id",)) -> DataFrame:
    """The best speaker of each file if it is at least that similar, the first by name of equals; files without one have no row."""
    row = F.struct(*[c for c in speakers.columns if c not in keys], "similarity")
    best = similar(speakers, reference).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("s"), "speaker", row.alias("row")))).alias("all"))
    first = F.filter("all", lambda x: x["s"].isNotNull())[0]["row"]
    return best.select(*keys, first.alias("row")).select(*keys, "row.*").filter(F.col("similarity") >= threshold)


def top_similar(rows: DataFrame, reference: DataFrame, k: int, order: str) -> DataFrame:
    return similar(rows, reference).orderBy(F.desc_nulls_last("similarity"), order).limit(k)
