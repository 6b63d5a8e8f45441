"""Queries for drift, verdicts and their history."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens import schemas as S
from flowlens.config import DriftConfig
from flowlens.operators import drift as O
from flowlens.operators import reports
from flowlens.operators.adapt import apply_shift
from flowlens.operators.ks import ks_statistic
from flowlens.operators.metrics import macro_metrics
from flowlens.operators.selection import newest
from flowlens.plans.catalog import (
    SHIFT, SQL_SIDES, flows, register, rounded, split_by_time, views, with_derived,
)

CFG = DriftConfig()
BASE_SQL = f"{views.with_views('flows_v')}, {SQL_SIDES}"
DECILES = "[" + ", ".join(f"{k / 10}" for k in range(1, 10)) + "]"

EDGES_SQL = f"""
edges AS (SELECT feature, list_distinct(quantile_cont(value, {DECILES})) AS e FROM long WHERE is_ref GROUP BY feature),
binned AS (SELECT l.*, len(list_filter(e, lambda x: x <= value)) AS bin FROM long l JOIN edges USING (feature))
"""

PSI_SQL = f"""{EDGES_SQL},
cells AS (SELECT feature, bin, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c
  FROM binned GROUP BY feature, bin),
totals AS (SELECT feature, CAST(sum(r) AS BIGINT) AS n_ref, CAST(sum(c) AS BIGINT) AS n_cur FROM cells GROUP BY feature),
psi_num AS (SELECT feature, n_ref, n_cur, CASE WHEN n_ref < 50 OR n_cur < 50 THEN 0.0 ELSE
  sum((greatest(c / n_cur, 1e-4) - greatest(r / n_ref, 1e-4)) * ln(greatest(c / n_cur, 1e-4) / greatest(r / n_ref, 1e-4)))
  END AS psi FROM cells JOIN totals USING (feature) GROUP BY feature, n_ref, n_cur)
"""

CAT_SQL = f"""
cat_long AS (UNPIVOT (SELECT is_ref, {", ".join(f"coalesce({c}, 'missing') AS {c}" for c in S.CATEGORICAL)} FROM sides)
  ON {", ".join(S.CATEGORICAL)} INTO NAME feature VALUE value),
cat_tot AS (SELECT feature, CAST(count(*) FILTER (WHERE is_ref) AS BIGINT) AS n_ref,
  CAST(count(*) FILTER (WHERE NOT is_ref) AS BIGINT) AS n_cur FROM cat_long GROUP BY feature),
cat_ref AS (SELECT feature, value, count(*) AS r FROM cat_long WHERE is_ref GROUP BY 1, 2),
cat_cur AS (SELECT feature, value, count(*) AS c FROM cat_long WHERE NOT is_ref GROUP BY 1, 2),
cat_cells AS (SELECT feature, value, coalesce(r, 0) AS r, coalesce(c, 0) AS c
  FROM cat_ref FULL OUTER JOIN cat_cur USING (feature, value)),
psi_cat AS (SELECT feature, n_ref, n_cur,
  sum((greatest(c / n_cur, 1e-4) - greatest(r / n_ref, 1e-4)) * ln(greatest(c / n_cur, 1e-4) / greatest(r / n_ref, 1e-4))) AS psi
  FROM cat_cells JOIN cat_tot USING (feature) GROUP BY feature, n_ref, n_cur)
"""

KS_SQL = """
steps AS (SELECT feature,
  count(*) FILTER (WHERE is_ref) OVER (PARTITION BY feature ORDER BY value) AS r,
  count(*) FILTER (WHERE NOT is_ref) OVER (PARTITION BY feature ORDER BY value) AS c,
  count(*) FILTER (WHERE is_ref) OVER (PARTITION BY feature) AS n_ref,
  count(*) FILTER (WHERE NOT is_ref) OVER (PARTITION BY feature) AS n_cur FROM long),
ks AS (SELECT feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, max(abs(r / n_ref - c / n_cur)) AS d
  FROM steps GROUP BY feature, n_ref, n_cur),
lam AS (SELECT feature, sqrt(n_ref / (n_ref + n_cur) * n_cur) * d AS l FROM ks),
pval AS (SELECT feature, CASE WHEN l < 0.2 THEN 1.0 ELSE least(greatest(2 * (SELECT sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END
  * exp(-2.0 * k * k * l * l)) FROM generate_series(1, 30) g(k)), 0), 1) END AS p FROM lam)
"""

STATUS_SQL = f"""{PSI_SQL}, {CAT_SQL}, {KS_SQL},
status AS (SELECT feature, 'numeric' AS kind, n_ref, n_cur, psi, p AS ks_p_value,
  CASE WHEN psi >= 0.2 OR (p < 0.01 AND psi >= 0.1) THEN 'drift' WHEN psi >= 0.1 THEN 'warn' ELSE 'ok' END AS status
  FROM psi_num JOIN pval USING (feature)
 UNION ALL SELECT feature, 'categorical', n_ref, n_cur, psi, NULL,
  CASE WHEN psi >= 0.2 THEN 'drift' WHEN psi >= 0.1 THEN 'warn' ELSE 'ok' END FROM psi_cat)
"""


def sides(spark, sf_dir):
    """Reference rows, and live rows under the what-if shift."""
    reference, live = split_by_time(flows(spark, sf_dir))
    return with_derived(reference), with_derived(apply_shift(live, SHIFT))


@register("psi_numeric", f"{BASE_SQL}, {PSI_SQL} SELECT feature, n_ref, n_cur, round(psi, 6) AS psi FROM psi_num")
def psi_numeric(spark, sf_dir):
    return rounded(O.psi_numeric(*sides(spark, sf_dir), S.MODEL_NUMERIC))


@register("psi_without_values", f"""{BASE_SQL}
SELECT feature, kind, n_ref, n_cur, 0e0 AS psi, CASE WHEN kind = 'numeric' THEN 1e0 END AS ks_p_value, 'ok' AS status FROM (
 SELECT 'packet_rate' AS feature, 'numeric' AS kind, CAST(0 AS BIGINT) AS n_ref, CAST(0 AS BIGINT) AS n_cur
 UNION ALL SELECT 'src_port_entropy', 'numeric', CAST(count(src_port_entropy) FILTER (WHERE is_ref) AS BIGINT), 0 FROM sides
 UNION ALL SELECT 'failed_logins', 'numeric', 0, CAST(count(failed_logins) FILTER (WHERE NOT is_ref) AS BIGINT) FROM sides)""")
def psi_without_values(spark, sf_dir):
    """Numeric features without any value on both sides, on the live side, and on the reference side: they count as
    analysed and have not drifted."""
    reference, live = sides(spark, sf_dir)
    none = F.lit(None).cast("double")
    keep = ["packet_rate", "src_port_entropy", "failed_logins"]
    reference = reference.select(*keep).withColumns({"packet_rate": none, "failed_logins": none})
    live = live.select(*keep).withColumns({"packet_rate": none, "src_port_entropy": none})
    return O.report_rows(O.feature_drift(reference, live))


@register("psi_categorical", f"{BASE_SQL}, {CAT_SQL} SELECT feature, n_ref, n_cur, round(psi, 6) AS psi FROM psi_cat")
def psi_categorical(spark, sf_dir):
    return rounded(O.psi_categorical(*sides(spark, sf_dir), S.CATEGORICAL))


@register("ks_statistic", f"{BASE_SQL}, {KS_SQL} SELECT feature, n_ref, n_cur, round(d, 6) AS d FROM ks")
def ks(spark, sf_dir):
    both = O.sides(*sides(spark, sf_dir), S.MODEL_NUMERIC)
    return rounded(ks_statistic(both, S.MODEL_NUMERIC))


@register("drift_status", f"""{BASE_SQL}, {STATUS_SQL}
SELECT feature, kind, n_ref, n_cur, round(psi, 4) AS psi, round(ks_p_value, 6) AS ks_p_value, status FROM status""")
def drift_status(spark, sf_dir):
    return O.report_rows(O.feature_drift(*sides(spark, sf_dir)))


def _verdict(spark, sf_dir):
    reference, live = sides(spark, sf_dir)
    return O.drift_verdict(O.feature_drift(reference, live), live.count())


VERDICT_SQL = f"""{BASE_SQL}, {STATUS_SQL},
agg AS (SELECT count(*) FILTER (WHERE status = 'drift') / count(*) AS share,
  coalesce(string_agg(CASE WHEN status = 'drift' THEN feature END, ',' ORDER BY feature), '') AS drifted,
  coalesce(string_agg(CASE WHEN status = 'warn' THEN feature END, ',' ORDER BY feature), '') AS warned FROM status),
live AS (SELECT CAST(count(*) AS BIGINT) AS window_rows FROM sides WHERE NOT is_ref)
"""


@register("drift_verdict", f"""{VERDICT_SQL}, j AS (SELECT *, window_rows >= 5000 AS enough FROM agg, live)
SELECT enough AND share >= 0.2 AS overall_drift, enough AND share >= 0.2 AS retrain_recommended,
 CASE WHEN enough THEN concat(format('{{:.2f}}', share), ' of the features drifted, performance drift: false')
  ELSE concat('too few live rows: ', window_rows, ' of 5000') END AS reason, window_rows,
 CASE WHEN enough THEN drifted ELSE '' END AS drifted_features, CASE WHEN enough THEN warned ELSE '' END AS warned_features,
 CASE WHEN enough THEN round(share, 4) ELSE 0e0 END AS feature_drift_share, false AS performance_drift FROM j""")
def drift_verdict(spark, sf_dir):
    return _verdict(spark, sf_dir).select(
        "overall_drift", "retrain_recommended", "reason", "window_rows",
        F.array_join("drifted_features", ",").alias("drifted_features"),
        F.array_join("warned_features", ",").alias("warned_features"),
        "feature_drift_share", "performance_drift",
    )


@register("drift_verdict_small", f"""{BASE_SQL}
SELECT false AS overall_drift, false AS retrain_recommended, 0e0 AS feature_drift_share, CAST(count(*) AS BIGINT) AS window_rows,
 CASE WHEN count(*) = 0 THEN 'no live rows' ELSE concat('too few live rows: ', count(*), ' of 5000') END AS reason,
 '' AS drifted_features FROM sides WHERE ship >= (SELECT max(ship) FROM sides) - INTERVAL 1 DAY""")
def drift_verdict_small(spark, sf_dir):
    """The verdict on the last day alone, a window that is too small to judge."""
    reference, live = sides(spark, sf_dir)
    recent = live.where(F.col("ship") >= live.agg(F.max("ship") - F.expr("INTERVAL 1 DAY")).scalar())
    return O.drift_verdict(O.feature_drift(reference, recent), recent.count()).select(
        "overall_drift", "retrain_recommended", "feature_drift_share", "window_rows", "reason",
        F.array_join("drifted_features", ",").alias("drifted_features"))


@register("drift_report", f"""{VERDICT_SQL}, j AS (SELECT *, window_rows >= 5000 AS enough FROM agg, live)
SELECT window_rows, CASE WHEN enough THEN drifted ELSE '' END AS drifted_features,
 CASE WHEN enough THEN round(share, 4) ELSE 0e0 END AS feature_drift_share, false AS performance_drift,
 enough AND share >= 0.2 AS overall_drift,
 CASE WHEN enough THEN (SELECT CAST(count(*) AS BIGINT) FROM status) ELSE 0 END AS reported_features FROM j""")
def drift_report(spark, sf_dir):
    """Stored report row; the JSON details are read back as a check that they are complete."""
    report = O.drift_report(_verdict(spark, sf_dir))
    details = F.from_json("report_json", "feature_results array<struct<feature:string>>")
    return report.select(
        "window_rows", "drifted_features", "feature_drift_share", "performance_drift", "overall_drift",
        F.size(details["feature_results"]).cast("bigint").alias("reported_features"),
    )


MACRO_SQL = """
cells AS (SELECT {keys} true_label AS t, attack_type AS p, count(*) AS n FROM predictions_v GROUP BY ALL),
classes AS (SELECT {keys} t AS cls FROM cells UNION SELECT {keys} p FROM cells),
per_class AS (SELECT {qkeys} k.cls, coalesce(sum(n) FILTER (WHERE t = cls AND p = cls), 0) AS tp,
  coalesce(sum(n) FILTER (WHERE t = cls), 0) AS actual, coalesce(sum(n) FILTER (WHERE p = cls), 0) AS predicted
  FROM classes k JOIN cells c ON (c.t = k.cls OR c.p = k.cls) {on} GROUP BY ALL),
macro AS (SELECT {keys} CAST(sum(actual) AS BIGINT) AS n, avg(CASE WHEN actual + predicted = 0 THEN 0 ELSE 2 * tp / (actual + predicted) END) AS f1,
  avg(CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END) AS precision,
  avg(CASE WHEN actual = 0 THEN 0 ELSE tp / actual END) AS recall, sum(tp) / sum(actual) AS accuracy FROM per_class GROUP BY ALL)
"""


def macro_sql(key: str = "") -> str:
    return MACRO_SQL.format(
        keys=f"{key}, " if key else "", qkeys=f"k.{key}, " if key else "", on=f"AND c.{key} = k.{key}" if key else ""
    )


PRED_SQL = views.with_views("predictions_v")


@register("perf_drift", f"""{PRED_SQL}, {macro_sql()}
SELECT n AS scored_rows, round(f1, 6) AS live_f1, round(precision, 6) AS live_precision, round(recall, 6) AS live_recall,
 f1 < 0.85 AS performance_drift FROM macro""")
def perf_drift(spark, sf_dir):
    scored = views.view(spark, sf_dir, "predictions_v")
    return rounded(O.performance_drift(scored, 0.96, CFG, truth="true_label", prediction="attack_type"))


def _by_month(spark, sf_dir):
    """PSI of every live month against the reference."""
    reference, live = sides(spark, sf_dir)
    live = live.withColumn("month", F.date_trunc("month", F.col("ship").cast("timestamp")))
    return O.psi_by_window(reference, live, S.MODEL_NUMERIC, "month")


MONTHLY_SQL = f"""{BASE_SQL}, {EDGES_SQL},
ref_cells AS (SELECT feature, bin, count(*) AS r FROM binned WHERE is_ref GROUP BY 1, 2),
ref_tot AS (SELECT feature, sum(r) AS n_ref FROM ref_cells GROUP BY 1),
cur_cells AS (SELECT month, feature, bin, count(*) AS c FROM binned WHERE NOT is_ref GROUP BY 1, 2, 3),
cur_tot AS (SELECT month, feature, sum(c) AS n_cur FROM cur_cells GROUP BY 1, 2),
grid AS (SELECT t.month, t.feature, b.bin, t.n_cur, n_ref, e FROM cur_tot t JOIN ref_tot USING (feature) JOIN edges USING (feature),
  generate_series(0, 9) b(bin) WHERE b.bin <= len(e)),
monthly AS (SELECT g.month, g.feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
  CASE WHEN n_ref < 50 OR n_cur < 50 THEN 0.0 ELSE sum(
  (greatest(coalesce(c, 0) / n_cur, 1e-4) - greatest(coalesce(r, 0) / n_ref, 1e-4))
  * ln(greatest(coalesce(c, 0) / n_cur, 1e-4) / greatest(coalesce(r, 0) / n_ref, 1e-4))) END AS psi
  FROM grid g LEFT JOIN ref_cells r ON r.feature = g.feature AND r.bin = g.bin
  LEFT JOIN cur_cells c ON c.feature = g.feature AND c.bin = g.bin AND c.month = g.month GROUP BY 1, 2, n_ref, n_cur),
history AS (SELECT month, count(*) FILTER (WHERE psi >= 0.1) / count(*) AS share FROM monthly GROUP BY month)
"""


def _day(column: str = "created_at"):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


@register("drift_by_window", f"""{MONTHLY_SQL}
SELECT strftime(month, '%Y-%m-%d') AS month, feature, n_ref, n_cur, round(psi, 6) AS psi FROM monthly""")
def drift_by_window(spark, sf_dir):
    return rounded(_by_month(spark, sf_dir).withColumn("month", F.date_format("month", "yyyy-MM-dd")))


def _reports(spark, sf_dir):
    """One report row per live month, from the share of features at or above the warning level."""
    return _by_month(spark, sf_dir).groupBy(F.col("month").alias("created_at")).agg(
        (F.count_if(F.col("psi") >= CFG.psi_warn) / F.count(F.lit(1))).alias("feature_drift_share"),
        F.array_join(F.array_sort(F.collect_list(
            F.when(F.col("psi") >= CFG.psi_warn, F.col("feature")))), ",").alias("drifted_features"),
    )


@register("drift_history", f"""{MONTHLY_SQL}
SELECT strftime(month, '%Y-%m-%d') AS created_at, round(share, 6) AS feature_drift_share FROM history ORDER BY month LIMIT 200""")
def drift_history(spark, sf_dir):
    return rounded(reports.drift_history(_reports(spark, sf_dir)).withColumn("created_at", _day()))


@register("drift_latest", f"""{MONTHLY_SQL}
SELECT strftime(month, '%Y-%m-%d') AS created_at, round(share, 6) AS feature_drift_share,
 (SELECT coalesce(string_agg(feature, ',' ORDER BY feature), '') FROM monthly m WHERE m.month = h.month AND psi >= 0.1) AS drifted_features
FROM history h ORDER BY month DESC LIMIT 1""")
def drift_latest(spark, sf_dir):
    return rounded(reports.drift_latest(_reports(spark, sf_dir)).withColumn("created_at", _day()))


def _events(spark, sf_dir):
    """One audit row per month of predictions, from the month's macro F1."""
    scored = views.view(spark, sf_dir, "predictions_v").withColumn(
        "created_at", F.date_trunc("month", F.col("ship").cast("timestamp"))
    )
    metrics = macro_metrics(scored, "true_label", "attack_type", "created_at")
    return metrics.select(
        "created_at", F.lit("monitoring_cycle").alias("trigger"), (F.col("f1") >= 0.6).alias("promoted"),
        F.date_format("created_at", "yyyyMM").alias("new_model_version"), F.col("f1").alias("new_f1"),
    )


EVENTS_SQL = f"""{PRED_SQL.replace("SELECT ok, ln, pk, sk, ship,", "SELECT ok, ln, pk, sk, ship, date_trunc('month', ship) AS created_at,")},
 {macro_sql("created_at")}"""


@register("retrain_log", f"""{EVENTS_SQL}
SELECT strftime(created_at, '%Y-%m-%d') AS created_at, 'monitoring_cycle' AS trigger, f1 >= 0.6 AS promoted,
 strftime(created_at, '%Y%m') AS new_model_version, round(f1, 6) AS new_f1 FROM macro ORDER BY 1 DESC LIMIT 15""")
def retrain_log(spark, sf_dir):
    return rounded(reports.retrain_log(_events(spark, sf_dir)).withColumn("created_at", _day()))


@register("retrain_display", f"""{EVENTS_SQL}
SELECT strftime(created_at, '%m-%d %H:%M') AS created_at, 'monitoring_cycle' AS trigger,
 CASE WHEN f1 >= 0.6 THEN '✅' ELSE '—' END AS promoted, concat('v', strftime(created_at, '%Y%m')) AS new_model_version,
 format('{{:.1f}}%', f1 * 100) AS new_f1 FROM (SELECT * FROM macro ORDER BY created_at DESC LIMIT 15) t""")
def retrain_display(spark, sf_dir):
    return reports.retrain_display(_events(spark, sf_dir))


@register("latest_window", f"""{views.with_views("flows_v")}
SELECT ok, ln, pk, sk, duration, src_bytes FROM flows_v
ORDER BY ship DESC, ok DESC, ln DESC, pk DESC, sk DESC, duration DESC, src_bytes DESC LIMIT 5000""")
def latest_window(spark, sf_dir):
    rows = newest(flows(spark, sf_dir), "ship", 5000, "ok", "ln", "pk", "sk", "duration", "src_bytes")
    return rows.select("ok", "ln", "pk", "sk", "duration", "src_bytes")
