"""Reconstruction-error detector: a linear autoencoder, that is, the leading principal components."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.selection import exact_quantiles


class ReconstructionDetector:
    """Rows whose mean squared reconstruction error exceeds a quantile of the fit rows' errors."""

    def __init__(self, pca: PCAModel, mean: list[float], threshold: float = 0.0):
        self.pca, self.mean, self.threshold = pca, mean, threshold

    @classmethod
    def fit(cls, df: DataFrame, k: int = 8, quantile: float = 0.99, features: str = "features") -> "ReconstructionDetector":
        mean = df.select(Summarizer.mean(F.col(features))).first()[0].toArray().tolist()
        pca = PCA(k=min(k, len(mean)), inputCol=features, outputCol="__code").fit(df)
        model = cls(pca, mean)
        _, at = exact_quantiles(model.with_error(df, features), ["error"], [quantile])
        model.threshold = at["error"][0]
        return model

    def with_error(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Add ``error``. The components are orthonormal, so the squared error is the squared
        length of the centred row less that of its centred code."""
        center = self.pca.pc.toArray().T @ np.array(self.mean)

        def squared(vector: str, shift) -> Column:
            steps = F.zip_with(
                vector_to_array(vector), F.array(*[F.lit(float(m)) for m in shift]), lambda x, m: (x - m) * (x - m)
            )
            return F.aggregate(steps, F.lit(0.0), lambda acc, v: acc + v)

        coded = self.pca.transform(df)
        residual = (squared(features, self.mean) - squared("__code", center)) / len(self.mean)
        return coded.withColumn("error", F.greatest(residual, F.lit(0.0))).drop("__code")

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Add ``raw`` (higher is more anomalous) and ``outlier``."""
        return self.with_error(df, features).withColumns({
            "raw": F.col("error") - F.lit(self.threshold), "outlier": F.col("error") > F.lit(self.threshold),
        }).drop("error")
