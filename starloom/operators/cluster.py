"""Clusters of embeddings and the colours of points: a hue by cluster, a lightness by degree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import hsluv_to_rgb


def kmeans(points: DataFrame, clusters: int, seed: int = 0, steps: int = 20) -> tuple[DataFrame, np.ndarray]:
    """((idx, label), centers) of points (idx, embedding); fewer points than clusters give fewer centers."""
    data = points.select("idx", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=clusters, seed=seed, maxIter=steps, featuresCol="features", predictionCol="label").fit(data)
    return model.transform(data).select("idx", F.col("label").cast("int").alias("label")), np.array(model.clusterCenters())


def center_table(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centers)], "label int, center array<float>")


def cluster_hues(centers: np.ndarray, n_cycles: float = 1.0) -> np.ndarray:
    """Hues in [0, 1): the leading eigenvector of the double-centred Gaussian similarity, stretched over n_cycles turns.

    The scale is the median distance to the nearest other center. The sign makes the largest component positive.
    """
    c = len(centers)
    if c < 2:
        return np.zeros(c)
    d = np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(2))
    sigma = np.median(np.where(np.eye(c, dtype=bool), np.inf, d).min(1)) or 1.0
    s = np.exp(-(d**2) / (2 * sigma**2))
    h = np.eye(c) - 1 / c
    _, vectors = np.linalg.eigh(h @ s @ h)
    v = vectors[:, -1]
    v = v * np.sign(v[np.abs(v).argmax()])
    span = v.max() - v.min()
    return ((v - v.min()) / span * n_cycles) % 1.0 if span else np.zeros(c)


def point_hues(points: np.ndarray, centers: np.ndarray, hues: np.ndarray, n_cycles: float = 1.0, k: int = 3, period: float | None = None) -> np.ndarray:
    """Inverse-distance mean of the k nearest centers' hues, unwrapped around the nearest; a point on a center has its hue."""
    period = 1 / n_cycles if period is None else period
    d = np.sqrt(((points[:, None] - centers[None]) ** 2).sum(2))
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    dist, hue = np.take_along_axis(d, near, 1), hues[near]
    w = 1 / (dist + 1e-8)
    w /= w.sum(1, keepdims=True)
    gap = hue - hue[:, :1]
    gap = np.where(gap > period / 2, gap - period, np.where(gap < -period / 2, gap + period, gap))
    mean = (hue[:, 0] + (w * gap).sum(1)) % 1.0
    return np.where(dist[:, 0] == 0, hue[:, 0], mean)


def colours(points: DataFrame, degrees: DataFrame, centers: np.ndarray, n_cycles: float = 5.0, saturation: float = 85.0, light: tuple[float, float] = (40.0, 90.0)) -> DataFrame:
    """(idx, color) for points (idx, embedding) and (idx, degree): packed b << 16 | g << 8 | r. Centers, a bounded few, travel to every task."""
    hues = cluster_hues(centers, n_cycles=n_cycles)
    top = degrees.agg(F.max(F.log1p("degree"))).first()[0] or 1.0
    sent = points.sparkSession.sparkContext.broadcast((centers, hues))

    def paint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, h = sent.value
        for x in batches:
            if not len(x):
                continue
            hue = point_hues(np.stack(x["embedding"].to_numpy()).astype(float), c, h, n_cycles)
            bright = light[0] + (light[1] - light[0]) * np.log1p(x["degree"].to_numpy(float)) / top
            rgb = np.clip(hsluv_to_rgb(hue * 360, np.full(len(x), saturation), bright) * 255, 0, 255).astype(np.int64)
            yield pd.DataFrame({"idx": x["idx"], "color": (rgb[:, 2] << 16 | rgb[:, 1] << 8 | rgb[:, 0]).astype(np.int32)})

    joined = points.select("idx", "embedding").join(degrees.select("idx", "degree"), "idx", "left").na.fill(0, ["degree"])
    return joined.mapInPandas(paint, "idx long, color int")
