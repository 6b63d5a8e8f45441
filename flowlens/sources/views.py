"""Flow, packet, prediction and external-row views over the given tables.

The text is in the subset of SQL that Spark and DuckDB share, so the same rule feeds the Spark
queries and the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FLOWS = """
SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_shipdate AS ship,
 l_quantity AS duration, l_extendedprice AS src_bytes,
 l_extendedprice * (1 - l_discount) * (1 + l_tax) AS dst_bytes,
 CAST(1 + (l_partkey % 40) AS DOUBLE) AS count, CAST(1 + (l_suppkey % 20) AS DOUBLE) AS srv_count,
 1 - l_discount AS same_srv_rate, l_discount AS diff_srv_rate, l_tax * 50 AS src_port_entropy,
 CAST(1 + (l_partkey % 40) AS DOUBLE) / l_quantity AS packet_rate,
 l_tax * 100 AS connection_duration_std,
 CAST(CASE WHEN l_returnflag = 'R' THEN l_orderkey % 4 ELSE 0 END AS DOUBLE) AS failed_logins,
 l_extendedprice / (1 + (l_partkey % 40)) AS bytes_per_packet,
 CASE l_suppkey % 10 WHEN 0 THEN 'icmp' WHEN 1 THEN 'udp' WHEN 2 THEN 'udp' ELSE 'tcp' END AS protocol,
 CASE l_partkey % 8 WHEN 0 THEN 'dns' WHEN 1 THEN 'ssh' WHEN 2 THEN 'smtp' WHEN 3 THEN 'ftp'
  WHEN 4 THEN 'https' WHEN 5 THEN 'telnet' ELSE 'http' END AS service,
 CASE l_returnflag WHEN 'A' THEN 'S0' WHEN 'R' THEN 'REJ' ELSE 'SF' END AS flag,
 CASE WHEN (l_orderkey * 7 + l_linenumber) % 20 = 0 THEN 'ddos'
  WHEN (l_orderkey * 7 + l_linenumber) % 20 = 1 THEN 'port_scan'
  WHEN (l_orderkey * 7 + l_linenumber) % 40 = 2 THEN 'brute_force'
  WHEN (l_orderkey * 7 + l_linenumber) % 40 = 3 THEN 'botnet'
  ELSE 'normal' END AS attack_type
FROM lineitem
"""

DIRTY = """
SELECT ok, ln, pk, CASE WHEN (ok + ln) % 400 = 0 THEN NULL ELSE duration END AS duration,
 CASE WHEN (ok + pk) % 97 = 0 THEN NULL ELSE src_bytes END AS src_bytes, dst_bytes, count, srv_count,
 CASE WHEN (ok + pk) % 50 = 0 THEN 1.5 ELSE same_srv_rate END AS same_srv_rate,
 CASE WHEN pk % 89 = 0 THEN NULL ELSE service END AS service, flag,
 CASE WHEN (ok + pk) % 300 = 0 THEN 'zero_day' WHEN (ok + pk) % 301 = 0 THEN NULL
  ELSE attack_type END AS attack_type
FROM (SELECT * FROM flows_v UNION ALL SELECT * FROM flows_v WHERE pk % 50 = 3) u
"""

PREDICTIONS = """
SELECT ok, ln, pk, sk, ship,
 CASE WHEN sk % 3 = 0 THEN 'capture' WHEN sk % 3 = 1 THEN 'api' ELSE 'live' END AS source,
 attack_type AS true_label,
 CASE WHEN (ok + pk) % 10 < 8 THEN attack_type WHEN (ok + pk) % 10 = 8 THEN 'normal'
  ELSE 'ddos' END AS attack_type,
 CAST((ok * 13 + pk * 7 + ln) % 1000 AS DOUBLE) / 1000 AS anomaly_score,
 1 - CAST((ok * 13 + pk * 7 + ln) % 1000 AS DOUBLE) / 1000 AS confidence
FROM flows_v
"""

PACKETS = """
SELECT event_id, ts, proto, CASE WHEN fwd THEN c ELSE sv END AS src, CASE WHEN fwd THEN sv ELSE c END AS dst,
 CASE WHEN proto = 'icmp' THEN 0 WHEN fwd THEN cp ELSE sp END AS sport,
 CASE WHEN proto = 'icmp' THEN 0 WHEN fwd THEN sp ELSE cp END AS dport,
 len, CASE WHEN proto = 'tcp' THEN fl ELSE 0 END AS tcp_flags
FROM (SELECT event_id, ts, event_id % 3 <> 1 AS fwd,
 concat('10.0.0.', CAST(user_id AS VARCHAR(10))) AS c,
 concat('93.0.0.', CAST(user_id % 5 AS VARCHAR(10))) AS sv,
 50000 + user_id AS cp,
 CASE user_id % 7 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 53 WHEN 3 THEN 22 WHEN 4 THEN 25
  WHEN 5 THEN 21 ELSE 2323 END AS sp,
 CASE WHEN user_id % 15 = 0 THEN 'icmp' WHEN user_id % 7 = 2 THEN 'udp' ELSE 'tcp' END AS proto,
 40 + CAST(floor(value * 10) AS BIGINT) AS len,
 CASE event_type WHEN 'signup' THEN 2 WHEN 'purchase' THEN 17 WHEN 'error' THEN 4
  WHEN 'click' THEN 24 ELSE 16 END AS fl
 FROM events) e
"""

NSL = """
SELECT l_orderkey AS ok, l_linenumber AS ln,
 CASE WHEN l_partkey % 211 = 0 THEN 'bad'
  ELSE CAST(CAST(l_quantity AS BIGINT) * (1 + (l_orderkey % 30)) AS VARCHAR(20)) END AS duration,
 CASE l_suppkey % 6 WHEN 0 THEN 'UDP' WHEN 1 THEN 'icmp' WHEN 2 THEN 'sctp' ELSE 'tcp' END AS protocol_type,
 CASE l_partkey % 9 WHEN 0 THEN 'http' WHEN 1 THEN 'domain_u' WHEN 2 THEN 'http_443' WHEN 3 THEN 'pop_3'
  WHEN 4 THEN 'telnet' WHEN 5 THEN 'ftp_data' WHEN 6 THEN 'ssh' WHEN 7 THEN 'private'
  ELSE 'HTTP_8001' END AS service,
 CASE l_orderkey % 8 WHEN 0 THEN 'S3' WHEN 1 THEN 'RSTR' WHEN 2 THEN 'REJ' WHEN 3 THEN 'sh'
  WHEN 4 THEN 'OTH' WHEN 5 THEN 'XYZ' ELSE 'SF' END AS flag,
 CAST(CAST(floor(l_extendedprice) AS BIGINT) * (1 + (l_partkey % 70)) AS VARCHAR(20)) AS src_bytes,
 CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR(20)) AS dst_bytes,
 CAST(l_linenumber - 1 AS VARCHAR(20)) AS count, CAST(l_suppkey % 4 AS VARCHAR(20)) AS srv_count,
 CAST(1 - l_discount AS VARCHAR(20)) AS same_srv_rate, CAST(l_discount AS VARCHAR(20)) AS diff_srv_rate,
 CAST(l_orderkey % 5 AS VARCHAR(20)) AS num_failed_logins,
 CASE (l_orderkey + l_partkey) % 12 WHEN 0 THEN 'neptune' WHEN 1 THEN ' Smurf ' WHEN 2 THEN 'satan'
  WHEN 3 THEN 'guess_passwd' WHEN 4 THEN 'warezclient' WHEN 5 THEN 'zero_day_xyz'
  WHEN 6 THEN CASE WHEN l_partkey % 150 = 0 THEN 'rootkit' ELSE 'normal' END ELSE 'normal' END AS label
FROM lineitem
"""

VIEWS = {
    "flows_v": FLOWS, "flows_dirty_v": DIRTY, "predictions_v": PREDICTIONS,
    "packets_v": PACKETS, "nsl_v": NSL,
}
NEEDS = {
    "flows_v": ["lineitem"], "flows_dirty_v": ["flows_v"], "predictions_v": ["flows_v"],
    "packets_v": ["events"], "nsl_v": ["lineitem"],
}

REFERENCE_END = "1998-06-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view; inputs are passed as query arguments, so no session state is touched."""
    inputs = {
        need: view(spark, sf_dir, need) if need in VIEWS else table(spark, sf_dir, need)
        for need in NEEDS[name]
    }
    text = VIEWS[name]
    for need in inputs:
        text = text.replace(f"FROM {need}", f"FROM {{{need}}}")
    return spark.sql(text, **inputs)


def with_views(*names: str) -> str:
    """``WITH`` prefix that defines the named views and what they need, for the checks."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            if need in VIEWS:
                add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in ordered)
