"""External labelled connection rows mapped onto the flow schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens import schemas as S
from flowlens.functions import lookups as L
from flowlens.functions.columns import (
    MIN_DURATION, NEUTRAL_ENTROPY, clamp, fold, number, outside,
)
from flowlens.operators.sampling import class_size, stratified_downsample

LABEL_CLASS = {name: cls for cls, names in L.ATTACK_FAMILIES.items() for name in names}
MAPPED = {c: L.RANGES[c] for c in L.MAPPED_RANGES}


def mapped_label(column: str = "label") -> Column:
    """Attack name to class; NULL for names that are not known."""
    return fold(F.lower(F.trim(F.col(column))), LABEL_CLASS, F.lit(None).cast("string"))


def map_rows(raw: DataFrame, *keep: str) -> DataFrame:
    """Flow columns (unclipped) and the mapped label, NULL where unknown. A projection only."""
    base = raw.select(
        *keep,
        number("duration", 0.0).alias("duration"), number("src_bytes", 0.0).alias("src_bytes"),
        number("dst_bytes", 0.0).alias("dst_bytes"),
        F.greatest(number("count", 1.0), F.lit(1.0)).alias("count"),
        F.greatest(number("srv_count", 1.0), F.lit(1.0)).alias("srv_count"),
        number("same_srv_rate", 0.0).alias("same_srv_rate"),
        number("diff_srv_rate", 0.0).alias("diff_srv_rate"),
        number("num_failed_logins", 0.0).alias("failed_logins"),
        F.when(F.lower("protocol_type").isin(L.DOMAINS["protocol"]), F.lower("protocol_type"))
        .otherwise("tcp").alias("protocol"),
        fold(F.lower("service"), L.SERVICE_FOLD, F.lit(L.SERVICE_DEFAULT)).alias("service"),
        fold(F.upper("flag"), L.FLAG_FOLD, F.lit(L.FLAG_DEFAULT)).alias("flag"),
        mapped_label().alias(S.LABEL),
    )
    return base.withColumns({
        "packet_rate": F.col("count") / F.greatest("duration", F.lit(MIN_DURATION)),
        "bytes_per_packet": (F.col("src_bytes") + F.col("dst_bytes")) / F.col("count"),
        "src_port_entropy": F.lit(NEUTRAL_ENTROPY),
        "connection_duration_std": F.lit(0.0),
    }).select(*keep, *S.EXPECTED)


def class_sizes(mapped: DataFrame, min_class_count: int) -> DataFrame:
    """(attack_type, n, rare) of mapped rows: at most one row per class."""
    return (
        mapped.where(F.col(S.LABEL).isNotNull()).groupBy(S.LABEL).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rare", F.col("n") < min_class_count)
    )


def clip_counts(mapped: DataFrame, rules: dict[str, tuple[float, float]] = MAPPED) -> list[Column]:
    return [F.count_if(outside(F.col(c), *rules[c])).alias(c) for c in rules]


def map_flows(raw: DataFrame, min_class_count: int = 30) -> tuple[DataFrame, dict]:
    """Mapped, filtered and clipped rows with the counts of what was dropped or clipped.

    One aggregation by class yields every statistic; the rows themselves are a narrow projection
    with a filter on the kept classes (at most five names).
    """
    mapped = map_rows(raw)
    by_class = {
        r[S.LABEL]: r.asDict() for r in
        mapped.groupBy(S.LABEL).agg(F.count(F.lit(1)).alias("__n"), *clip_counts(mapped)).collect()
    }
    known = {c: r for c, r in by_class.items() if c is not None}
    rare = {c: r["__n"] for c, r in known.items() if r["__n"] < min_class_count}
    kept = sorted(c for c in known if c not in rare)
    stats: dict = {
        "rows_in": sum(r["__n"] for r in by_class.values()),
        "unknown_labels_dropped": by_class[None]["__n"] if None in by_class else 0,
    }
    if rare:
        stats["rare_classes_dropped"] = rare
    clipped = {c: sum(known[k][c] for k in kept) for c in MAPPED}
    stats["clipped"] = {c: n for c, n in clipped.items() if n}
    stats["rows_out"] = sum(known[k]["__n"] for k in kept)
    stats["label_counts"] = {k: known[k]["__n"] for k in kept}
    rows = mapped.where(F.col(S.LABEL).isin(kept))
    rows = rows.withColumns({c: clamp(F.col(c), *MAPPED[c]) for c in MAPPED})
    return rows, stats


def ingest(
    raw: DataFrame, min_class_count: int = 30, max_rows: int | None = None
) -> tuple[DataFrame, dict]:
    """Map, then downsample every class by the same share when there are more than ``max_rows``."""
    rows, stats = map_flows(raw, min_class_count)
    if max_rows and stats["rows_out"] > max_rows:
        share = max_rows / stats["rows_out"]
        rows = stratified_downsample(rows, share)
        stats["downsampled_to"] = sum(class_size(n, share) for n in stats["label_counts"].values())
    return rows, stats
