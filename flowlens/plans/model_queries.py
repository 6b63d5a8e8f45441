"""Queries for splits, preprocessing, scoring, metrics, gate, adaptation and reports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from flowlens import schemas as S
from flowlens.config import AdaptConfig, GateConfig
from flowlens.ml.preprocess import FlowPreprocessor
from flowlens.operators import adapt, gate, metrics, reports, sampling, scoring
from flowlens.operators.selection import exact_quantiles
from flowlens.plans.catalog import (
    SQL_DERIVED, SQL_ORDER, flows, register, rounded, row_order, views,
)
from flowlens.plans.drift_queries import PRED_SQL, macro_sql
from flowlens.session import scratch_path
from flowlens.sources.tables import AUDIT, VERSIONS, Store

FLOWS_SQL = views.with_views("flows_v")


def predictions(spark, sf_dir):
    return views.view(spark, sf_dir, "predictions_v")


# --- splits and samples --------------------------------------------------------------------------

RANKED_SQL = f"""ranked AS (SELECT *, rank() OVER (PARTITION BY attack_type ORDER BY {SQL_ORDER}) - 1 AS r,
 count(*) OVER (PARTITION BY attack_type) AS n FROM flows_v)"""


@register("stratified_split", f"""{FLOWS_SQL}, {RANKED_SQL}
SELECT ok, ln, pk, attack_type, CASE WHEN r < floor(n * 0.7 + 0.5) THEN 'train' WHEN r < floor(n * 0.85 + 0.5)
 THEN 'validation' ELSE 'test' END AS split FROM ranked""")
def stratified_split(spark, sf_dir):
    rows = sampling.stratified_split(flows(spark, sf_dir), order=row_order())
    return rows.select("ok", "ln", "pk", "attack_type", "split")


@register("stratified_downsample", f"""{FLOWS_SQL}, {RANKED_SQL}
SELECT ok, ln, pk, attack_type FROM ranked WHERE r < floor(n * 0.25 + 0.5)""")
def stratified_downsample(spark, sf_dir):
    rows = sampling.stratified_downsample(flows(spark, sf_dir), 0.25, order=row_order())
    return rows.select("ok", "ln", "pk", "attack_type")


@register("prediction_sample", f"""{PRED_SQL}
SELECT ok, ln, pk, sk, true_label, attack_type AS prediction FROM predictions_v
ORDER BY {SQL_ORDER}, ok, ln, pk, sk LIMIT 200""")
def prediction_sample(spark, sf_dir):
    rows = sampling.seeded_sample(predictions(spark, sf_dir), 200, row_order(), 42, "ok", "ln", "pk", "sk")
    return rows.select("ok", "ln", "pk", "sk", "true_label", F.col("attack_type").alias("prediction"))


# --- preprocessing -------------------------------------------------------------------------------

HOLES = "CASE WHEN (ok + pk) % 97 = 0 THEN NULL ELSE {c} END AS {c}"
HOLED_SQL = f"""holed AS (SELECT ok, ln, pk, sk, {HOLES.format(c='duration')}, {HOLES.format(c='src_bytes')},
 {HOLES.format(c='service')} FROM flows_v)"""


def _holed(spark, sf_dir):
    hole = (F.col("ok") + F.col("pk")) % 97 == 0
    return flows(spark, sf_dir).withColumns({
        c: F.when(~hole, F.col(c)) for c in ("duration", "src_bytes", "service")
    })


@register("preprocess", f"""{FLOWS_SQL}, {HOLED_SQL},
med AS (SELECT quantile_cont(duration, 0.5) AS md, quantile_cont(src_bytes, 0.5) AS ms FROM holed),
filled AS (SELECT ok, ln, pk, coalesce(duration, md) AS duration, coalesce(src_bytes, ms) AS src_bytes, service, md, ms FROM holed, med),
q AS (SELECT quantile_cont(duration, 0.75) - quantile_cont(duration, 0.25) AS qd,
 quantile_cont(src_bytes, 0.75) - quantile_cont(src_bytes, 0.25) AS qs FROM filled),
top AS (SELECT service AS mode FROM holed WHERE service IS NOT NULL GROUP BY service ORDER BY count(*) DESC, service LIMIT 1)
SELECT ok, ln, pk, round((duration - md) / qd, 6) AS duration, round((src_bytes - ms) / qs, 6) AS src_bytes,
 CASE WHEN coalesce(service, mode) = 'http' THEN 1e0 ELSE 0e0 END AS service_http FROM filled, q, top""")
def preprocess(spark, sf_dir):
    """Fit and apply with missing values in two numeric columns and one category."""
    df = _holed(spark, sf_dir)
    model = FlowPreprocessor(numericCols=["duration", "src_bytes"], categoricalCols=["service"]).fit(df)
    return rounded(df.select(
        "ok", "ln", "pk", *[c.alias(n) for n, c in model.scaled().items()],
        model.indicators()["service_http"].alias("service_http"),
    ))


@register("robust_scale", f"""{FLOWS_SQL}, x AS (SELECT *, {SQL_DERIVED} FROM flows_v),
q AS (SELECT {", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}" for c in S.MODEL_NUMERIC)} FROM x)
SELECT ok, ln, pk, """ + ", ".join(
    f"round(({c} - q_{c}[2]) / CASE WHEN q_{c}[3] = q_{c}[1] THEN 1 ELSE q_{c}[3] - q_{c}[1] END, 6) AS {c}"
    for c in S.MODEL_NUMERIC
) + " FROM x, q")
def robust_scale(spark, sf_dir):
    from flowlens.functions.columns import with_derived

    df = with_derived(flows(spark, sf_dir))
    model = FlowPreprocessor(categoricalCols=["flag"]).fit(df)
    return rounded(df.select("ok", "ln", "pk", *[c.alias(n) for n, c in model.scaled().items()]))


ONE_HOT = {"protocol": ["icmp", "tcp", "udp"], "flag": ["REJ", "S0", "SF"]}


@register("one_hot", f"{FLOWS_SQL} SELECT ok, ln, pk, " + ", ".join(
    f"CASE WHEN {c} = '{v}' AND pk % 3 <> 0 THEN 1e0 ELSE 0e0 END AS {c}_{v}" for c, vs in ONE_HOT.items() for v in vs
) + " FROM flows_v")
def one_hot(spark, sf_dir):
    """Encode rows of which a third carry a value that was not seen at fit time."""
    df = flows(spark, sf_dir)
    model = FlowPreprocessor(numericCols=["duration"], categoricalCols=list(ONE_HOT)).fit(df)
    unseen = df.withColumns({c: F.when(F.col("pk") % 3 == 0, "new").otherwise(F.col(c)) for c in ONE_HOT})
    return unseen.select("ok", "ln", "pk", *[c.alias(n) for n, c in model.indicators().items()])


@register("class_weights", f"""{FLOWS_SQL}, c AS (SELECT attack_type, count(*) AS n FROM flows_v GROUP BY 1)
SELECT attack_type, CAST(n AS BIGINT) AS n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c""")
def class_weights(spark, sf_dir):
    return rounded(scoring.class_weights(flows(spark, sf_dir)))


@register("recon_threshold", f"""{FLOWS_SQL}, e AS (SELECT attack_type, abs(src_bytes - dst_bytes) / duration AS err FROM flows_v),
t AS (SELECT quantile_cont(err, 0.99) AS th FROM e WHERE attack_type = 'normal')
SELECT attack_type, round(th, 6) AS threshold, CAST(count(*) FILTER (WHERE err > th) AS BIGINT) AS anomalies,
 CAST(count(*) AS BIGINT) AS n FROM e, t GROUP BY attack_type, th""")
def recon_threshold(spark, sf_dir):
    """The 99th percentile of an error over benign rows, and the rows of each class above it."""
    errors = flows(spark, sf_dir).select(
        S.LABEL, (F.abs(F.col("src_bytes") - F.col("dst_bytes")) / F.col("duration")).alias("err")
    )
    _, at = exact_quantiles(errors.where(F.col(S.LABEL) == S.BENIGN), ["err"], [0.99])
    threshold = at["err"][0]
    return rounded(errors.groupBy(S.LABEL).agg(
        F.lit(threshold).alias("threshold"), F.count_if(F.col("err") > threshold).alias("anomalies"),
        F.count(F.lit(1)).alias("n"),
    ))


@register("cluster_majority", f"""{FLOWS_SQL},
c AS (SELECT (pk + ok) % 9 AS cluster, attack_type, count(*) AS n FROM flows_v WHERE NOT ((pk + ok) % 9 = 4 AND attack_type <> 'normal') GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, attack_type) AS p FROM c WHERE attack_type <> 'normal')
SELECT k.cluster, coalesce(r.attack_type, (SELECT min(attack_type) FROM c WHERE attack_type <> 'normal'), 'ddos') AS attack_type
FROM (SELECT DISTINCT cluster FROM c) k LEFT JOIN r ON r.cluster = k.cluster AND p = 1""")
def cluster_majority(spark, sf_dir):
    """Majority class per cluster, one cluster having no attack at all."""
    rows = flows(spark, sf_dir).withColumn("cluster", (F.col("pk") + F.col("ok")) % 9)
    rows = rows.where(~((F.col("cluster") == 4) & (F.col(S.LABEL) != S.BENIGN)))
    return scoring.majority_classes(rows)


# --- scoring -------------------------------------------------------------------------------------

HALF = "CAST((ok * 13 + pk * 7 + ln) % 1000 AS DOUBLE) / 1000"


def _probabilities():
    """Rule-derived class probabilities in label order."""
    s = ((F.col("ok") * 13 + F.col("pk") * 7 + F.col("ln")) % 1000).cast("double") / 1000
    rest = 1 - s
    return F.array(s, rest * 0.4, rest * 0.3, rest * 0.2, rest * 0.1)


PROB_SQL = f"""prob AS (SELECT *, [s, (1 - s) * CAST(0.4 AS DOUBLE), (1 - s) * CAST(0.3 AS DOUBLE), (1 - s) * CAST(0.2 AS DOUBLE),
  (1 - s) * CAST(0.1 AS DOUBLE)] AS p FROM (SELECT *, {HALF} AS s FROM flows_v) t),
scored AS (SELECT *, list_max(p) AS top, ['normal', 'ddos', 'port_scan', 'brute_force', 'botnet'][list_position(p, list_max(p))] AS label FROM prob)"""


def _scored(spark, sf_dir):
    p = _probabilities()
    return flows(spark, sf_dir).withColumns({
        "prediction": scoring.label_of(p, S.LABELS), "anomaly_score": scoring.uncertainty(p),
    })


@register("score_batch", f"""{FLOWS_SQL}, {PROB_SQL}
SELECT 'b1' AS batch_id, 'api' AS source, label AS attack_type, round(1 - top, 6) AS anomaly_score, label <> 'normal' AS is_anomaly,
 attack_type AS true_label, round(1 - (1 - top), 6) AS confidence FROM scored""")
def score_batch(spark, sf_dir):
    rows = scoring.prediction_rows(_scored(spark, sf_dir), "b1", "api", "rule", "1")
    return rounded(rows.drop("model_name", "model_version", "run_id", "created_at"))


@register("score_summary", f"""{FLOWS_SQL}, {PROB_SQL}
SELECT CAST(count(*) AS BIGINT) AS scored_rows, CAST(count(*) FILTER (WHERE label <> 'normal') AS BIGINT) AS anomalies,
 round(count(*) FILTER (WHERE label <> 'normal') / count(*), 6) AS anomaly_rate FROM scored""")
def score_summary(spark, sf_dir):
    return rounded(scoring.score_summary(_scored(spark, sf_dir), "prediction"))


@register("score_normalise", f"""{FLOWS_SQL}, d AS (SELECT ok, ln, pk, src_bytes / dst_bytes - duration AS raw FROM flows_v)
SELECT ok, ln, pk, round((raw - (SELECT min(raw) FROM d)) / ((SELECT max(raw) - min(raw) FROM d) + 1e-9), 6) AS anomaly_score FROM d""")
def score_normalise(spark, sf_dir):
    raw = flows(spark, sf_dir).select(
        "ok", "ln", "pk", (F.col("src_bytes") / F.col("dst_bytes") - F.col("duration")).alias("raw")
    )
    return rounded(scoring.normalise(raw).drop("raw"))


# --- metrics and gate ----------------------------------------------------------------------------

@register("macro_metrics", f"""{PRED_SQL}, {macro_sql("source")}
SELECT source, n AS rows, round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall,
 round(accuracy, 6) AS accuracy FROM macro""")
def macro_metrics(spark, sf_dir):
    return rounded(metrics.macro_metrics(predictions(spark, sf_dir), "true_label", "attack_type", "source"))


@register("binary_metrics", f"""{PRED_SQL}, b AS (SELECT source, count(*) FILTER (WHERE true_label <> 'normal' AND attack_type <> 'normal') AS tp,
 count(*) FILTER (WHERE true_label <> 'normal') AS a, count(*) FILTER (WHERE attack_type <> 'normal') AS p FROM predictions_v GROUP BY 1)
SELECT source, round(2 * tp / (a + p), 6) AS anomaly_f1, round(tp / p, 6) AS anomaly_precision, round(tp / a, 6) AS anomaly_recall FROM b""")
def binary_metrics(spark, sf_dir):
    return rounded(metrics.binary_metrics(predictions(spark, sf_dir), "true_label", "attack_type", "source"))


@register("promotion_gate", f"""{PRED_SQL}, {macro_sql("source")},
g AS (SELECT *, (SELECT f1 FROM macro WHERE source = 'api') AS champion_f1 FROM macro)
SELECT source, round(f1, 6) AS f1, f1 >= 0.6 AND precision >= 0.85 AND recall >= 0.85 AS gate_passed,
 f1 - champion_f1 >= 0.002 AS beats_champion,
 CASE WHEN f1 - champion_f1 >= 0.002 THEN concat('F1 gain ', format('{{:+.4f}}', f1 - champion_f1))
  ELSE concat('F1 gain ', format('{{:+.4f}}', f1 - champion_f1), ', wanted 0.002') END AS compare_note,
 f1 >= 0.6 AND precision >= 0.85 AND recall >= 0.85 AND f1 - champion_f1 >= 0.002 AS promoted,
 concat_ws('; ', CASE WHEN f1 < 0.6 THEN format('f1 is {{:.4f}}, the floor is 0.6', f1) END,
  CASE WHEN precision < 0.85 THEN format('precision is {{:.4f}}, the floor is 0.85', precision) END,
  CASE WHEN recall < 0.85 THEN format('recall is {{:.4f}}, the floor is 0.85', recall) END) AS reasons FROM g""")
def promotion_gate(spark, sf_dir):
    """Every source's scores as a candidate against those of source api."""
    scored = metrics.macro_metrics(predictions(spark, sf_dir), "true_label", "attack_type", "source")
    champion = scored.where(F.col("source") == "api").select("f1").scalar()
    judged = gate.with_gate(scored.withColumn("champion_f1", champion), GateConfig(min_f1=0.6))
    return rounded(judged.select(
        "source", "f1", "gate_passed", "beats_champion", "compare_note", "promoted",
        F.array_join("reasons", "; ").alias("reasons"),
    ))


@register("model_versions", f"""{PRED_SQL}, {macro_sql("source")}
SELECT 'flow_classifier' AS model_name, CAST(length(source) AS BIGINT) AS version, source AS run_id, round(f1, 6) AS f1
FROM macro WHERE f1 > 0.5 ORDER BY length(source) DESC LIMIT 1""")
def model_versions(spark, sf_dir):
    """Register each source's scores as a version and read the champion: the latest promoted one."""
    from flowlens.ml.registry import champion

    store = Store(spark, scratch_path(spark, "store"))
    scored = metrics.macro_metrics(predictions(spark, sf_dir), "true_label", "attack_type", "source")
    rows = scored.select(
        F.lit("flow_classifier").alias("model_name"), F.length("source").cast("bigint").alias("version"),
        F.concat(F.lit("models/"), F.col("source")).alias("path"), F.col("source").alias("run_id"),
        "f1", "precision", "recall", (F.col("f1") > 0.5).alias("promoted"),
        F.current_timestamp().alias("created_at"),
    )
    store.append(rows, VERSIONS)
    return rounded(champion(store.read(VERSIONS)).select("model_name", "version", "run_id", "f1"))


@register("audit_event", f"""{PRED_SQL}, {macro_sql()}
SELECT 'manual' AS trigger, round(f1, 6) AS new_f1, f1 >= 0.9 AS promoted FROM macro""")
def audit_event(spark, sf_dir):
    """Write one audit row for the overall macro F1 and read it back."""
    store = Store(spark, scratch_path(spark, "store"))
    f1 = metrics.macro_metrics(predictions(spark, sf_dir), "true_label", "attack_type").first()["f1"]
    store.audit("manual", new_f1=f1, promoted=f1 >= GateConfig().min_f1, notes="written by the query")
    return rounded(store.read(AUDIT).select("trigger", "new_f1", "promoted"))


# --- adaptation ----------------------------------------------------------------------------------

@register("adapt_status", f"""{PRED_SQL}
SELECT CAST(count(*) AS BIGINT) AS capture_rows, CAST(3000 AS BIGINT) AS min_rows, count(*) >= 3000 AS ready,
 CAST(greatest(3000 - count(*), 0) AS BIGINT) AS needed FROM predictions_v WHERE source = 'capture'""")
def adapt_status(spark, sf_dir):
    return adapt.adapt_status(predictions(spark, sf_dir))


TAGGED_SQL = f"""tagged AS (SELECT *, CASE WHEN sk % 3 = 0 THEN 'capture' WHEN sk % 3 = 1 THEN 'api' ELSE 'live' END AS source FROM flows_v)"""


def _tagged(spark, sf_dir):
    return flows(spark, sf_dir).withColumn(
        "source", F.when(F.col("sk") % 3 == 0, "capture").when(F.col("sk") % 3 == 1, "api").otherwise("live")
    )


@register("capture_corpus", f"""{FLOWS_SQL}, {TAGGED_SQL}
SELECT ok, ln, pk, sk, duration, src_bytes, protocol, service, flag FROM tagged WHERE source = 'capture'""")
def capture_corpus(spark, sf_dir):
    rows = adapt.capture_corpus(_tagged(spark, sf_dir))
    return rows.select("ok", "ln", "pk", "sk", "duration", "src_bytes", "protocol", "service", "flag")


@register("pseudo_label", f"""{PRED_SQL}
SELECT attack_type AS label, CAST(count(*) AS BIGINT) AS captured, CAST(count(*) FILTER (WHERE confidence >= 0.85) AS BIGINT) AS confident
FROM predictions_v WHERE source = 'capture' GROUP BY 1""")
def pseudo_label(spark, sf_dir):
    captured = adapt.capture_rows(predictions(spark, sf_dir))
    return adapt.pseudo_label_info(captured, label="attack_type")


@register("blend_corpus", f"""{FLOWS_SQL}, {TAGGED_SQL},
pseudo AS (SELECT * REPLACE (CASE WHEN (ok + pk) % 10 < 8 THEN attack_type WHEN (ok + pk) % 10 = 8 THEN 'normal' ELSE 'ddos' END AS attack_type)
 FROM tagged WHERE source = 'capture' AND 1 - {HALF} >= 0.85),
corpus AS (SELECT src_bytes, attack_type, 'anchor' AS part FROM tagged WHERE source <> 'capture' UNION ALL SELECT src_bytes, attack_type, 'anchor' FROM pseudo)
SELECT attack_type, CAST(count(*) AS BIGINT) AS n, round(sum(src_bytes), 2) AS src_bytes,
 round((SELECT count(*) FROM pseudo) / (SELECT count(*) FROM corpus), 3) AS pseudo_share FROM corpus GROUP BY 1""")
def blend_corpus(spark, sf_dir):
    """All labelled rows as anchors, together with the confident pseudo-labelled captured rows."""
    rows = _tagged(spark, sf_dir)
    bucket = (F.col("ok") + F.col("pk")) % 10
    s = ((F.col("ok") * 13 + F.col("pk") * 7 + F.col("ln")) % 1000).cast("double") / 1000
    scored = adapt.capture_rows(rows).withColumns({
        "confidence": 1 - s,
        S.LABEL: F.when(bucket < 8, F.col(S.LABEL)).when(bucket == 8, "normal").otherwise("ddos"),
    })
    pseudo = adapt.confident(scored, AdaptConfig().min_confidence)
    corpus = adapt.blend(rows.where(F.col("source") != "capture"), pseudo)
    share = F.round(pseudo.agg(F.count(F.lit(1))).scalar() / corpus.agg(F.count(F.lit(1))).scalar(), 3)
    return corpus.groupBy(S.LABEL).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("src_bytes"), 2).alias("src_bytes")
    ).withColumn("pseudo_share", share)


@register("adapted_corpus", f"""{FLOWS_SQL}, {TAGGED_SQL},
scored AS (SELECT *, 1 - {HALF} AS confidence FROM tagged WHERE source = 'capture'),
status AS (SELECT CAST(count(*) AS BIGINT) AS captured, CAST(count(*) FILTER (WHERE confidence >= 0.85) AS BIGINT) AS confident FROM scored),
parts AS (
 SELECT attack_type, least(count(*), 40) AS anchors, 0 AS pseudo FROM tagged WHERE source <> 'capture' GROUP BY 1
 UNION ALL SELECT 'port_scan', 0, count(*) FROM scored WHERE confidence >= 0.85)
SELECT attack_type, CAST(sum(anchors + pseudo) AS BIGINT) AS n, captured, confident, CAST(NULL AS VARCHAR) AS blocked_by,
 'captured' AS blocked_above, 'confident' AS blocked_strict
FROM parts, status GROUP BY attack_type, captured, confident""")
def adapted_corpus(spark, sf_dir):
    """Class-balanced anchors with confident captured rows, by class, and both guards of the corpus."""
    rows = _tagged(spark, sf_dir)
    s = ((F.col("ok") * 13 + F.col("pk") * 7 + F.col("ln")) % 1000).cast("double") / 1000
    scored = adapt.capture_rows(rows).withColumns({"confidence": 1 - s, "prediction": F.lit("port_scan")})
    n_classes = rows.where(F.col("source") != "capture").select(S.LABEL).distinct().count()
    cfg = AdaptConfig(min_rows=50, min_confidence=0.85, anchor_rows=40 * n_classes)
    corpus = adapt.adapted_corpus(scored, rows.where(F.col("source") != "capture"), cfg)
    status = adapt.corpus_status(scored, cfg).crossJoin(adapt.corpus_status(
        scored, replace(cfg, min_rows=10**9)).select(F.col("blocked_by").alias("blocked_above"))).crossJoin(
        adapt.corpus_status(scored, replace(cfg, min_confidence=2.0)).select(F.col("blocked_by").alias("blocked_strict")))
    return corpus.groupBy(S.LABEL).agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(status))  # one row


@register("whatif_shift", f"""{FLOWS_SQL}
SELECT ok, ln, pk, CASE WHEN attack_type = 'normal' THEN least(greatest(src_bytes * 2.8, 40), 2e6) ELSE src_bytes END AS src_bytes,
 CASE WHEN attack_type = 'normal' THEN least(greatest(duration * 9.0, 0), 300) ELSE duration END AS duration,
 CASE WHEN attack_type <> 'normal' THEN service WHEN {SQL_ORDER} % 1000000 / 1000000 < 0.5 THEN 'dns'
  WHEN {SQL_ORDER} % 1000000 / 1000000 < 0.8 THEN 'ssh' ELSE 'http' END AS service FROM flows_v""")
def whatif_shift(spark, sf_dir):
    shifted = adapt.apply_shift(
        flows(spark, sf_dir), {"src_bytes": 2.8, "duration": 9.0},
        {"dns": 0.5, "ssh": 0.3, "http": 0.2}, order=row_order().cast("bigint"),
    )
    return shifted.select("ok", "ln", "pk", "src_bytes", "duration", "service")


# --- reports -------------------------------------------------------------------------------------

def _flagged(spark, sf_dir):
    return predictions(spark, sf_dir).withColumn("is_anomaly", F.col(S.LABEL) != S.BENIGN)


KPI_SQL = """CAST(count(*) AS BIGINT) AS total_traffic, CAST(count(*) FILTER (WHERE attack_type <> 'normal') AS BIGINT) AS anomalies,
 CAST(count(*) FILTER (WHERE attack_type = 'normal') AS BIGINT) AS normal_traffic,
 round(count(*) FILTER (WHERE attack_type <> 'normal') / count(*), 6) AS anomaly_rate"""


@register("kpis", f"""{PRED_SQL} SELECT 'all' AS source, {KPI_SQL} FROM predictions_v
UNION ALL SELECT source, {KPI_SQL} FROM predictions_v GROUP BY source""")
def kpis(spark, sf_dir):
    return rounded(reports.kpis_by_source(_flagged(spark, sf_dir)))


@register("threat_types", f"""{PRED_SQL}
SELECT attack_type AS threat, CAST(count(*) AS BIGINT) AS count FROM predictions_v
WHERE attack_type <> 'normal' AND source = 'api' GROUP BY 1""")
def threat_types(spark, sf_dir):
    return reports.threat_types(reports.from_source(_flagged(spark, sf_dir), "api"))


@register("threat_pretty", f"""{PRED_SQL}, t AS (SELECT attack_type, count(*) AS n FROM predictions_v WHERE attack_type <> 'normal' GROUP BY 1)
SELECT CASE attack_type WHEN 'ddos' THEN 'Ddos' WHEN 'port_scan' THEN 'Port Scan' WHEN 'brute_force' THEN 'Brute Force' ELSE 'Botnet' END AS threat,
 CAST(n AS BIGINT) AS count, format('{{:.1f}}%', 100.0 * n / (SELECT sum(n) FROM t)) AS share FROM t""")
def threat_pretty(spark, sf_dir):
    return reports.threat_display(_flagged(spark, sf_dir))


@register("sources", f"{PRED_SQL} SELECT DISTINCT source FROM predictions_v")
def sources(spark, sf_dir):
    return reports.sources(predictions(spark, sf_dir))


