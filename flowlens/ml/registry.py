"""Model versions as rows: the champion is the newest promoted version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.sources.tables import VERSIONS, Store

MODEL_NAME = "flow_classifier"


def champion(versions: DataFrame, model_name: str = MODEL_NAME) -> DataFrame:
    """At most one row: the promoted version with the highest number."""
    return (
        versions.where((F.col("model_name") == model_name) & F.col("promoted"))
        .orderBy(F.desc("version")).limit(1)
    )


def current(store: Store, model_name: str = MODEL_NAME) -> dict | None:
    row = champion(store.read(VERSIONS), model_name).first()
    return row.asDict() if row else None


def next_version(store: Store, model_name: str = MODEL_NAME) -> int:
    top = store.read(VERSIONS).where(F.col("model_name") == model_name).agg(F.max("version")).first()[0]
    return (top or 0) + 1


def record(store: Store, path: str, run_id: str, metrics: dict, promoted: bool, notes: str,
           model_name: str = MODEL_NAME) -> int:
    """Append a version row and return its number."""
    version = next_version(store, model_name)
    row = store.spark.createDataFrame(
        [(model_name, version, path, run_id, metrics["f1"], metrics["precision"], metrics["recall"], promoted, notes)],
        "model_name string, version long, path string, run_id string, f1 double, precision double, "
        "recall double, promoted boolean, notes string",
    )
    store.append(row.withColumn("created_at", F.current_timestamp()), VERSIONS)
    return version
