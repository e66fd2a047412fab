"""Clustering: k-means, k-medians, mixtures, hierarchies, and visual-word histograms."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vectors import nearest_center
from tidemark.operators import selection
from tidemark.operators.ordered import exact_median
from tidemark.plans import mixture


def points(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """(key, vec): the columns bound into one array<double> per row."""
    vec = F.array(*[F.col(c).cast("double") for c in columns]).alias("vec")
    return df.select(key, vec) if key else df.select(vec)


def features(df: DataFrame, vec: str = "vec") -> DataFrame:
    return df.withColumn("features", array_to_vector(vec))


def fit_kmeans(vectors: DataFrame, k: int, iters: int = 20, seed: int = 1):
    return KMeans(k=k, maxIter=iters, seed=seed).fit(features(vectors))


def cluster_report(model, vectors: DataFrame) -> DataFrame:
    """(cluster, size, center) from the training summary and (cost) from the fit."""
    spark = vectors.sparkSession
    sizes = model.summary.clusterSizes
    rows = [
        (i, int(sizes[i]), [float(x) for x in center], float(model.summary.trainingCost))
        for i, center in enumerate(model.clusterCenters())
    ]
    return spark.createDataFrame(rows, "cluster int, size bigint, center array<double>, cost double")


PART_ROWS = 1 << 20  # of a table that is kept between rounds: a task reads a whole part in every round


def in_parts(vectors: DataFrame) -> DataFrame:
    """The rows in parts of at most about PART_ROWS, whatever the splits of their files; few rows stay as they are."""
    parts = -(-vectors.count() // PART_ROWS)
    return vectors.repartition(max(parts, vectors.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else vectors


def fit_bisecting(vectors: DataFrame, k: int = 4, seed: int = 1):
    """Divisive hierarchy: each level splits the clusters of the level above."""
    data = features(in_parts(vectors)).persist()
    model = BisectingKMeans(k=k, seed=seed).fit(data)
    data.unpersist()
    return model


class Fitted(NamedTuple):
    mixture: mixture.Mixture
    log_likelihood: float


def fit_mixture(vectors: DataFrame, k: int = 10, seed: int = 1, iters: int = 100) -> Fitted:
    """A Gaussian mixture from the library's random start; its rounds work on matrices of rows."""
    data = features(vectors).persist()
    drawn = GaussianMixture(k=k, seed=seed, maxIter=0).fit(data)
    normals = drawn.gaussians
    start = mixture.Mixture(
        np.array(drawn.weights), np.array([g.mean.toArray() for g in normals]), np.array([g.cov.toArray() for g in normals])
    )
    blocks = mixture.matrices(data.select(vector_to_array("features").alias("vec")))
    found = Fitted(*mixture.fit_from(blocks, start, iters))
    blocks.unpersist()
    data.unpersist()
    return found


def mixture_report(model: Fitted, vectors: DataFrame) -> DataFrame:
    spark = vectors.sparkSession
    parts = zip(model.mixture.weights, model.mixture.means, strict=True)
    rows = [(i, float(weight), [float(x) for x in mean], float(model.log_likelihood)) for i, (weight, mean) in enumerate(parts)]
    return spark.createDataFrame(rows, "component int, weight double, mean array<double>, log_likelihood double")


MAX_CENTERS = 100_000  # a codebook is known to every task


def label_centers(vectors: DataFrame, label: str) -> list[list[float]]:
    """Mean vector per label, in label order: one small row per label; more than MAX_CENTERS labels are an error."""
    width = vectors.agg(F.max(F.size("vec"))).first()[0] or 0
    means = vectors.groupBy(label).agg(F.array(*[F.avg(F.get("vec", i)) for i in range(width)]).alias("c"))
    rows = means.orderBy(label).limit(MAX_CENTERS + 1).collect()
    if len(rows) > MAX_CENTERS:
        raise ValueError(f"more than {MAX_CENTERS} labels to make centers of")
    return [list(row.c) for row in rows]


def assigned(vectors: DataFrame, centers, metric: str = "l2") -> DataFrame:
    """Add word and dist: the nearest center of each vector."""
    return vectors.withColumn("_a", nearest_center(F.col("vec"), centers, metric)).select(
        *vectors.columns, F.col("_a.word").alias("word"), F.col("_a.dist").alias("dist")
    )


def wssse(vectors: DataFrame, centers) -> DataFrame:
    """Within-set sum of squared errors."""
    return assigned(vectors, centers).agg(F.count("*").alias("n"), F.sum(F.col("dist") * F.col("dist")).alias("wssse"))


def word_shares(descriptors: DataFrame, centers, image: str) -> DataFrame:
    """(image, vec): share of every word of the codebook among an image's descriptors, in order of the words."""
    usable = descriptors.filter(F.size("vec") > 0)
    counts = assigned(usable, centers).groupBy(image, "word").agg(F.count("*").alias("n"))
    per_image = counts.groupBy(image).agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("by_word")
    )
    words = F.sequence(F.lit(0), F.lit(len(centers) - 1))
    share = lambda word: F.coalesce(F.try_element_at("by_word", word), F.lit(0)) / F.col("total")
    return per_image.select(image, F.transform(words, share).alias("vec"))


def word_histogram(descriptors: DataFrame, centers, image: str = "image_id") -> DataFrame:
    """(image, word, share) with a row for every word of the codebook; shares of an image sum to 1.

    Images without descriptors have no histogram.
    """
    return word_shares(descriptors, centers, image).select(image, F.posexplode("vec").alias("word", "share"))


def histogram_vectors(descriptors: DataFrame, centers, image: str = "image_id") -> DataFrame:
    """(image, vec): the histograms as dense vectors."""
    return word_shares(descriptors, centers, image)


def kmedians_step(vectors: DataFrame, centers) -> DataFrame:
    """(word, i, median): assign by L1 distance, then the median of every coordinate."""
    long = assigned(vectors.select("vec"), centers, "l1").select("word", F.posexplode("vec").alias("i", "x"))
    return exact_median(long, ["word", "i"], "x")


def spread_seeds(vectors: DataFrame, key: str, k: int, seed: int = 1) -> list[list[float]]:
    """k-means++ start: each next center is drawn with probability proportional to its distance.

    A draw is an exponential race, -ln(u) / weight with a repeatable u per row, so it is
    one aggregate over the whole table and nothing is sampled or collected.
    """
    centers: list[list[float]] = []
    for draw in range(k):
        u = (F.pmod(F.xxhash64(key, F.lit(seed), F.lit(draw)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        rows = assigned(vectors, centers, "l1") if centers else vectors.withColumn("dist", F.lit(1.0))
        race = F.when(F.col("dist") > 0, -F.log(u) / F.col("dist"))
        picked = rows.agg(F.min_by("vec", race).alias("vec")).first().vec
        if picked is None:
            break
        centers.append(list(picked))
    return centers


def fit_kmedians(vectors: DataFrame, key: str, k: int = 4, iters: int = 25, seed: int = 1) -> list[list[float]]:
    """Centers of k-medians. The rows are packed once; only counts of fixed size reach the driver between rounds."""
    centers = spread_seeds(vectors, key, k, seed)
    if not centers:
        return centers
    blocks = mixture.matrices(vectors.where("vec IS NOT NULL"))
    bounds = selection.limits(blocks)
    for _ in range(iters):
        moved = [list(c) for c in centers]
        for (word, i), median in selection.cluster_medians(blocks, centers, bounds).items():
            moved[word][i] = median
        if moved == centers:
            break
        centers = moved
    blocks.unpersist()
    return centers
