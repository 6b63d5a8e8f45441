"""Queries over sources, mapping, features and the quality gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens import schemas as S
from flowlens.functions import columns as C
from flowlens.functions import lookups as L
from flowlens.operators import nsl, quality
from flowlens.plans.catalog import SQL_DERIVED, flows, register, rounded, views
from flowlens.session import scratch_path
from flowlens.sources import files
from flowlens.sources.tables import FLOWS, Store

FLOWS_SQL = views.with_views("flows_v")
DIRTY_SQL = views.with_views("flows_dirty_v")
NSL_SQL = views.with_views("nsl_v")


# --- sources and sinks ---------------------------------------------------------------------------

@register("scan_flows", f"""{FLOWS_SQL}
SELECT {", ".join(S.EXPECTED)} FROM flows_v""")
def scan_flows(spark, sf_dir):
    root = scratch_path(spark, "csv")
    path = files.write_batch_csv(flows(spark, sf_dir).select(*S.EXPECTED), root, "day1")
    return files.read_flows_csv(spark, path).select(*S.EXPECTED)


NSL_USED = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "num_failed_logins",
    "count", "srv_count", "same_srv_rate", "diff_srv_rate", "label",
]


@register("nsl_load", f"""{NSL_SQL}
SELECT {", ".join(NSL_USED)}, '0' AS land, '20' AS difficulty FROM nsl_v""")
def nsl_load(spark, sf_dir):
    """Write headerless 43-column rows and load them back."""
    raw = views.view(spark, sf_dir, "nsl_v")
    wide = raw.select(*[
        F.col(c) if c in raw.columns else F.lit("20" if c == "difficulty" else "0").alias(c)
        for c in [*S.NSL_COLUMNS, "label", "difficulty"]
    ])
    path = scratch_path(spark, "nsl")
    wide.write.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.read_nsl_csv(spark, path).select(*NSL_USED, "land", "difficulty")


@register("sink_append", f"""{views.with_views("predictions_v")}
SELECT source, attack_type, CAST(count(*) AS BIGINT) AS n FROM predictions_v GROUP BY source, attack_type""")
def sink_append(spark, sf_dir):
    """Append two batches to the flow table, then read it by partition."""
    store = Store(spark, scratch_path(spark, "store"))
    rows = views.view(spark, sf_dir, "predictions_v").select(
        "attack_type", "source", F.lit("b1").alias("batch_id"), F.current_timestamp().alias("created_at"),
    )
    for batch in ("capture", "rest"):
        part = F.col("source") == "capture"
        store.append(rows.where(part if batch == "capture" else ~part), FLOWS)
    return store.read(FLOWS).groupBy("source", "attack_type").agg(F.count(F.lit(1)).alias("n"))


RECORDS_SQL = """
SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk,
 CASE WHEN l_partkey % 101 = 0 THEN '{"duration": ' ELSE
 concat('{"duration": ', CAST(l_quantity AS VARCHAR(20)),
  CASE WHEN l_partkey % 7 = 0 THEN '' ELSE concat(', "src_bytes": ',
   CAST(CASE WHEN l_partkey % 53 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS VARCHAR(30))) END,
  CASE WHEN l_partkey % 5 = 0 THEN '' ELSE concat(', "same_srv_rate": ',
   CAST(CASE WHEN l_partkey % 47 = 0 THEN 1.5 ELSE l_discount END AS VARCHAR(20))) END,
  CASE WHEN l_partkey % 43 = 0 THEN ', "count": "many"' ELSE concat(', "count": ', CAST(l_linenumber AS VARCHAR(20))) END,
  CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE ', "protocol": "udp"' END, '}') END AS body
FROM lineitem
"""


@register("json_records", f"""WITH records AS ({RECORDS_SQL}),
parsed AS (SELECT ok, ln, pk, json_valid(body) AS good, CASE WHEN json_valid(body) THEN body ELSE '{{}}' END AS j FROM records),
vals AS (SELECT *, TRY_CAST(json_extract_string(j, '$.duration') AS DOUBLE) AS d,
  TRY_CAST(json_extract_string(j, '$.src_bytes') AS DOUBLE) AS sb,
  TRY_CAST(json_extract_string(j, '$.same_srv_rate') AS DOUBLE) AS ssr,
  TRY_CAST(json_extract_string(j, '$.count') AS DOUBLE) AS cnt,
  json_extract_string(j, '$.protocol') AS proto FROM parsed)
SELECT ok, ln, pk, coalesce(d, 0.0) AS duration, coalesce(sb, 0.0) AS src_bytes,
 coalesce(ssr, 0.0) AS same_srv_rate, coalesce(cnt, 0.0) AS count, coalesce(proto, 'tcp') AS protocol,
 'http' AS service,
 good AND (cnt IS NOT NULL OR json_extract_string(j, '$.count') IS NULL)
  AND coalesce(sb, 0.0) >= 0 AND coalesce(ssr, 0.0) <= 1 AS valid
FROM vals""")
def json_records(spark, sf_dir):
    records = spark.sql(
        RECORDS_SQL.replace("FROM lineitem", "FROM {lineitem}").replace("'{\"duration\": '", "'{{\"duration\": '")
        .replace("', '}')", "', '}}')").replace("END, '}')", "END, '}}')"),
        lineitem=views.table(spark, sf_dir, "lineitem"),
    )
    return files.parse_records(records, "body", "ok", "ln", "pk").select(
        "ok", "ln", "pk", "duration", "src_bytes", "same_srv_rate", "count", "protocol", "service", "valid"
    )


@register("label_counts", f"""{FLOWS_SQL}
SELECT attack_type, CAST(count(*) AS BIGINT) AS n FROM flows_v GROUP BY attack_type""")
def label_counts(spark, sf_dir):
    return quality.label_counts(flows(spark, sf_dir))


# --- projections ---------------------------------------------------------------------------------

@register("engineered_features", f"""{FLOWS_SQL}
SELECT ok, ln, pk, round(bytes_ratio, 6) AS bytes_ratio, round(src_bytes_log, 6) AS src_bytes_log,
 round(duration_log, 6) AS duration_log FROM (SELECT *, {SQL_DERIVED} FROM flows_v) t""")
def engineered_features(spark, sf_dir):
    return rounded(C.with_derived(flows(spark, sf_dir)).select("ok", "ln", "pk", *S.DERIVED))


@register("bytes_per_packet_fallback", f"""{FLOWS_SQL}
SELECT ok, ln, pk, coalesce(least(greatest((src_bytes + dst_bytes) / nullif(count * pr, 0), 0), 5000), 0) AS bytes_per_packet
FROM (SELECT *, CASE WHEN pk % 13 = 0 THEN 0.0 ELSE packet_rate END AS pr FROM flows_v) t""")
def bytes_per_packet_fallback(spark, sf_dir):
    bare = flows(spark, sf_dir).drop("bytes_per_packet").withColumn(
        "packet_rate", F.when(F.col("pk") % 13 == 0, 0.0).otherwise(F.col("packet_rate"))
    )
    return C.with_derived(bare).select("ok", "ln", "pk", "bytes_per_packet")


def _values(pairs) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in pairs.items())


DIMS_SQL = f"""
dim_label(raw, cls) AS (VALUES {_values(nsl.LABEL_CLASS)}),
dim_service(raw, cls) AS (VALUES {_values(L.SERVICE_FOLD)}),
dim_flag(raw, cls) AS (VALUES {_values(L.FLAG_FOLD)}),
base AS (SELECT n.ok, n.ln, coalesce(TRY_CAST(n.duration AS DOUBLE), 0.0) AS duration,
  coalesce(TRY_CAST(n.src_bytes AS DOUBLE), 0.0) AS src_bytes, coalesce(TRY_CAST(n.dst_bytes AS DOUBLE), 0.0) AS dst_bytes,
  greatest(coalesce(TRY_CAST(n.count AS DOUBLE), 1.0), 1.0) AS count,
  greatest(coalesce(TRY_CAST(n.srv_count AS DOUBLE), 1.0), 1.0) AS srv_count,
  coalesce(TRY_CAST(n.same_srv_rate AS DOUBLE), 0.0) AS same_srv_rate,
  coalesce(TRY_CAST(n.diff_srv_rate AS DOUBLE), 0.0) AS diff_srv_rate,
  coalesce(TRY_CAST(n.num_failed_logins AS DOUBLE), 0.0) AS failed_logins,
  CASE WHEN lower(n.protocol_type) IN ('tcp', 'udp', 'icmp') THEN lower(n.protocol_type) ELSE 'tcp' END AS protocol,
  coalesce(s.cls, 'other') AS service, coalesce(f.cls, 'SF') AS flag, d.cls AS attack_type
  FROM nsl_v n LEFT JOIN dim_service s ON lower(n.service) = s.raw LEFT JOIN dim_flag f ON upper(n.flag) = f.raw
  LEFT JOIN dim_label d ON lower(trim(n.label)) = d.raw),
mapped AS (SELECT *, count / greatest(duration, 0.001) AS packet_rate, (src_bytes + dst_bytes) / count AS bytes_per_packet,
  ln(CAST(2.0 AS DOUBLE)) AS src_port_entropy, CAST(0.0 AS DOUBLE) AS connection_duration_std FROM base)
"""


@register("nsl_map", f"""{NSL_SQL}, {DIMS_SQL}
SELECT ok, ln, {", ".join(S.EXPECTED)} FROM mapped""")
def nsl_map(spark, sf_dir):
    return nsl.map_rows(views.view(spark, sf_dir, "nsl_v"), "ok", "ln")


@register("nsl_labels", f"""{NSL_SQL}, {DIMS_SQL}
SELECT coalesce(attack_type, 'dropped') AS attack_type, CAST(count(*) AS BIGINT) AS n FROM mapped GROUP BY 1""")
def nsl_labels(spark, sf_dir):
    raw = views.view(spark, sf_dir, "nsl_v")
    return raw.groupBy(F.coalesce(nsl.mapped_label(), F.lit("dropped")).alias("attack_type")).agg(
        F.count(F.lit(1)).alias("n")
    )


MIN_CLASS = 1000


@register("rare_classes", f"""{NSL_SQL}, {DIMS_SQL}
SELECT attack_type, CAST(count(*) AS BIGINT) AS n, count(*) < {MIN_CLASS} AS rare FROM mapped
WHERE attack_type IS NOT NULL GROUP BY attack_type""")
def rare_classes(spark, sf_dir):
    return nsl.class_sizes(nsl.map_rows(views.view(spark, sf_dir, "nsl_v")), MIN_CLASS)


@register("nsl_clip_stats", f"""{NSL_SQL}, {DIMS_SQL},
kept AS (SELECT * FROM mapped WHERE attack_type IN
  (SELECT attack_type FROM mapped WHERE attack_type IS NOT NULL GROUP BY attack_type HAVING count(*) >= {MIN_CLASS}))
SELECT attack_type, CAST(count(*) AS BIGINT) AS n, """ + ", ".join(
    f"round(max(least(greatest({c}, {lo}), {hi})), 6) AS max_{c}, "
    f"CAST(sum(CASE WHEN {c} < {lo} OR {c} > {hi} THEN 1 ELSE 0 END) AS BIGINT) AS clipped_{c}"
    for c, (lo, hi) in nsl.MAPPED.items()
) + " FROM kept GROUP BY attack_type")
def nsl_clip_stats(spark, sf_dir):
    raw = views.view(spark, sf_dir, "nsl_v")
    rows, stats = nsl.map_flows(raw, MIN_CLASS)
    unclipped = nsl.map_rows(raw).where(F.col(S.LABEL).isin(list(stats["label_counts"])))
    counts = unclipped.groupBy(S.LABEL).agg(*[c for c in nsl.clip_counts(unclipped)])
    counts = counts.select(S.LABEL, *[F.col(c).alias(f"clipped_{c}") for c in nsl.MAPPED])
    tops = rows.groupBy(S.LABEL).agg(
        F.count(F.lit(1)).alias("n"), *[F.max(c).alias(f"max_{c}") for c in nsl.MAPPED]
    )
    return rounded(tops.join(F.broadcast(counts), S.LABEL))  # one row per class


# --- quality gate --------------------------------------------------------------------------------

ABSENT = [
    "diff_srv_rate", "src_port_entropy", "packet_rate", "connection_duration_std", "failed_logins",
    "bytes_per_packet", "protocol",
]


@register("dq_schema", f"{DIRTY_SQL} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {'false' if c in ABSENT else 'true'} AS present,
    CAST({'0' if c in ABSENT else f'count({c})'} AS BIGINT) AS filled FROM
    {'(SELECT 1) one' if c in ABSENT else 'flows_dirty_v'}""" for c in S.EXPECTED
))
def dq_schema(spark, sf_dir):
    return quality.schema_check(views.view(spark, sf_dir, "flows_dirty_v"))


DIRTY_COLUMNS = ["duration", "src_bytes", "dst_bytes", "count", "srv_count", "same_srv_rate", "service", "flag", "attack_type"]


@register("dq_nulls", f"{DIRTY_SQL} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS n_null,
    round((count(*) - count({c})) / count(*), 6) AS share FROM flows_dirty_v""" for c in DIRTY_COLUMNS
))
def dq_nulls(spark, sf_dir):
    return rounded(quality.null_counts(views.view(spark, sf_dir, "flows_dirty_v"), DIRTY_COLUMNS))


REPAIRED_SQL = """
labelled AS (SELECT * FROM flows_dirty_v WHERE attack_type IS NOT NULL),
med AS (SELECT quantile_cont(duration, 0.5) AS md, quantile_cont(src_bytes, 0.5) AS ms FROM labelled),
repaired AS (SELECT ok, ln, pk, coalesce(duration, md) AS duration, coalesce(src_bytes, ms) AS src_bytes, dst_bytes,
  count, srv_count, same_srv_rate, coalesce(service, 'unknown') AS service, flag, attack_type FROM labelled, med)
"""


def _repaired(spark, sf_dir):
    return quality.repair_nulls(
        views.view(spark, sf_dir, "flows_dirty_v"), ["duration", "src_bytes"], ["service"]
    )


@register("dq_repair", f"""{DIRTY_SQL}, {REPAIRED_SQL}
SELECT ok, ln, pk, round(duration, 6) AS duration, round(src_bytes, 6) AS src_bytes, service, attack_type FROM repaired""")
def dq_repair(spark, sf_dir):
    return rounded(_repaired(spark, sf_dir).select("ok", "ln", "pk", "duration", "src_bytes", "service", "attack_type"))


@register("dq_duplicates", f"""{DIRTY_SQL}
SELECT CAST(count(*) AS BIGINT) AS n_rows, (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT * FROM flows_dirty_v) d)
 AS n_distinct, CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flows_dirty_v) d) AS BIGINT) AS n_duplicate_rows
FROM flows_dirty_v""")
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_counts(views.view(spark, sf_dir, "flows_dirty_v"))


def _range_sql(source: str, rules) -> str:
    parts = []
    for c, (lo, hi) in rules.items():
        out = f"sum(CASE WHEN {c} < {lo} OR {c} > {hi} THEN 1 ELSE 0 END)"
        parts.append(f"""SELECT '{c}' AS "column", CAST({out} AS BIGINT) AS n_out, CAST(count({c}) AS BIGINT) AS n_values,
        round({out} / count({c}), 6) AS share, CASE WHEN {out} / count({c}) > 0.05 THEN 'failure'
        WHEN {out} > 0 THEN 'warning' ELSE 'ok' END AS severity FROM {source}""")
    return " UNION ALL ".join(parts)


@register("dq_ranges", f"{FLOWS_SQL} " + _range_sql("flows_v", L.RANGES))
def dq_ranges(spark, sf_dir):
    return rounded(quality.range_counts(flows(spark, sf_dir)))


@register("dq_clip", f"""{DIRTY_SQL}
SELECT ok, ln, pk, CASE WHEN same_srv_rate > 1 THEN 1.0 ELSE round(same_srv_rate, 6) END AS same_srv_rate,
 CASE WHEN service IN ('http', 'https', 'dns', 'smtp', 'ssh', 'ftp') THEN service ELSE 'other' END AS service
FROM (SELECT DISTINCT * FROM flows_dirty_v) d""")
def dq_clip(spark, sf_dir):
    distinct = quality.clean_rows(views.view(spark, sf_dir, "flows_dirty_v"))
    clipped = quality.clip_ranges(distinct, {"same_srv_rate": L.RANGES["same_srv_rate"]})
    folded = quality.fold_domains(clipped, {"service": L.DOMAINS["service"]})
    return rounded(folded.select("ok", "ln", "pk", "same_srv_rate", "service"))


@register("dq_domains", f"{DIRTY_SQL} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c} AS value, CAST(count(*) AS BIGINT) AS n FROM flows_dirty_v
    WHERE {c} NOT IN ({", ".join(f"'{v}'" for v in L.DOMAINS[c])}) GROUP BY {c}""" for c in ("service", "flag")
))
def dq_domains(spark, sf_dir):
    return quality.unknown_values(views.view(spark, sf_dir, "flows_dirty_v"))


@register("dq_labels", f"""{DIRTY_SQL}
SELECT attack_type, CAST(count(*) AS BIGINT) AS n FROM flows_dirty_v
WHERE attack_type IS NULL OR attack_type NOT IN ({", ".join(f"'{c}'" for c in S.LABELS)}) GROUP BY attack_type""")
def dq_labels(spark, sf_dir):
    return quality.unknown_labels(views.view(spark, sf_dir, "flows_dirty_v"))


@register("dq_balance", f"""{FLOWS_SQL},
counts AS (SELECT attack_type, count(*) AS n FROM flows_v GROUP BY attack_type), total AS (SELECT sum(n) AS t FROM counts)
SELECT 'attack_class' AS "check", attack_type AS label, CAST(n AS BIGINT) AS n, round(n / t, 6) AS share,
 CASE WHEN n / t < 0.002 THEN 'warning' ELSE 'ok' END AS severity FROM counts, total WHERE attack_type <> 'normal'
UNION ALL SELECT 'benign_share', 'normal', CAST(n AS BIGINT), round(n / t, 6),
 CASE WHEN n / t < 0.1 THEN 'warning' ELSE 'ok' END FROM counts, total WHERE attack_type = 'normal'
UNION ALL SELECT 'attack_present', NULL, CAST(count(*) FILTER (WHERE attack_type <> 'normal') AS BIGINT),
 round(1 - sum(n) FILTER (WHERE attack_type = 'normal') / sum(n), 6),
 CASE WHEN count(*) FILTER (WHERE attack_type <> 'normal') = 0 THEN 'failure' ELSE 'ok' END FROM counts""")
def dq_balance(spark, sf_dir):
    return rounded(quality.balance(flows(spark, sf_dir)))


@register("dq_summary", f"""{FLOWS_SQL}
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE attack_type = 'normal') AS BIGINT) AS normal,
 CAST(count(*) FILTER (WHERE attack_type <> 'normal') AS BIGINT) AS attacks,
 round(1 - count(*) FILTER (WHERE attack_type = 'normal') / count(*), 6) AS attack_rate FROM flows_v""")
def dq_summary(spark, sf_dir):
    return rounded(quality.summary_row(flows(spark, sf_dir)))


@register("dq_gate", f"""{FLOWS_SQL},
feats AS (SELECT DISTINCT {", ".join(S.EXPECTED)} FROM flows_v),
fixed AS (SELECT * REPLACE (CASE WHEN service IN ('http', 'https', 'dns', 'smtp', 'ssh', 'ftp') THEN service ELSE 'other' END AS service) FROM feats)
SELECT service, attack_type, CAST(count(*) AS BIGINT) AS n, round(sum(bytes_per_packet), 2) AS bytes_per_packet,
 false AS passed, (SELECT CAST(count(*) - (SELECT count(*) FROM feats) AS BIGINT) FROM flows_v) AS duplicate_rows
FROM fixed GROUP BY service, attack_type""")
def dq_gate(spark, sf_dir):
    """The whole gate: cleaned rows by service and class, with the verdict."""
    clean, gate = quality.validate(flows(spark, sf_dir).select(*S.EXPECTED), fail_on_error=False)
    return clean.groupBy("service", S.LABEL).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("bytes_per_packet"), 2).alias("bytes_per_packet"),
        F.lit(gate.accepted).alias("passed"), F.lit(gate.copies).cast("bigint").alias("duplicate_rows"),
    )
