"""Monitoring reports over the prediction, drift and audit tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import pretty_label


def from_source(predictions: DataFrame, source: str = "all") -> DataFrame:
    return predictions if source == "all" else predictions.where(F.col("source") == source)


def _kpi_columns() -> list[Column]:
    total, hits = F.count(F.lit(1)), F.count_if("is_anomaly")
    rate = F.when(total > 0, hits / F.greatest(total, F.lit(1))).otherwise(F.lit(0.0))
    return [
        total.alias("total_traffic"), hits.alias("anomalies"), (total - hits).alias("normal_traffic"),
        rate.alias("anomaly_rate"),
    ]


def kpis(predictions: DataFrame, *keys) -> DataFrame:
    """(keys, total_traffic, anomalies, normal_traffic, anomaly_rate); the rate of nothing is 0."""
    return predictions.groupBy(*keys).agg(*_kpi_columns())


def kpis_by_source(predictions: DataFrame) -> DataFrame:
    """KPIs of every source and of ``all``, from one pass."""
    grouped = predictions.rollup("source").agg(F.grouping("source").alias("whole"), *_kpi_columns())
    name = F.when(F.col("whole") == 1, "all").otherwise(F.col("source"))
    return grouped.withColumn("source", name).drop("whole")


def threat_types(predictions: DataFrame) -> DataFrame:
    """(threat, count) of anomalies, most frequent first."""
    return (
        predictions.where("is_anomaly").groupBy(F.col("attack_type").alias("threat"))
        .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "threat")
    )


def threat_display(predictions: DataFrame) -> DataFrame:
    """Threat counts with display names and shares of all threats."""
    counts = threat_types(predictions)
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(
        pretty_label("threat").alias("threat"), "count",
        F.format_string("%.1f%%", 100.0 * F.col("count") / total).alias("share"),
    )


def sources(predictions: DataFrame) -> DataFrame:
    return predictions.select("source").distinct().orderBy("source")


def drift_latest(reports: DataFrame) -> DataFrame:
    """The newest drift report, as one row."""
    return reports.orderBy(F.desc("created_at")).limit(1)


def retrain_log(events: DataFrame, n: int = 15) -> DataFrame:
    return (
        events.select("created_at", "trigger", "promoted", "new_model_version", "new_f1")
        .orderBy(F.desc("created_at")).limit(n)
    )


def retrain_display(events: DataFrame, n: int = 15) -> DataFrame:
    """The log with dates, marks, versions and percentages as text; a dash where unknown."""
    dash = F.lit("—")
    return retrain_log(events, n).select(
        F.date_format("created_at", "MM-dd HH:mm").alias("created_at"), "trigger",
        F.when(F.coalesce("promoted", F.lit(False)), "✅").otherwise(dash).alias("promoted"),
        F.coalesce(F.concat(F.lit("v"), F.col("new_model_version")), dash).alias("new_model_version"),
        F.when(F.col("new_f1").isNull(), dash)
        .otherwise(F.format_string("%.1f%%", F.col("new_f1") * 100.0)).alias("new_f1"),
    )


def drift_history(reports: DataFrame, n: int = 200) -> DataFrame:
    """The oldest ``n`` reports, oldest first."""
    return (
        reports.select("created_at", "feature_drift_share").orderBy("created_at").limit(n)
    )
