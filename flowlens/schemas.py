"""Column names and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The flow schema.
NUMERIC = [
    "duration", "src_bytes", "dst_bytes", "count", "srv_count", "same_srv_rate",
    "diff_srv_rate", "src_port_entropy", "packet_rate", "connection_duration_std",
    "failed_logins", "bytes_per_packet",
]
CATEGORICAL = ["protocol", "service", "flag"]
LABEL = "attack_type"
DERIVED = ["bytes_ratio", "src_bytes_log", "duration_log"]
LABELS = ["normal", "ddos", "port_scan", "brute_force", "botnet"]
ATTACKS = LABELS[1:]
BENIGN = "normal"

MODEL_NUMERIC = NUMERIC + DERIVED
FEATURES = NUMERIC + CATEGORICAL
EXPECTED = FEATURES + [LABEL]
LINEAGE = ["batch_id", "source", "created_at"]


def _fields(pairs: list[tuple[str, T.DataType]]) -> list[T.StructField]:
    return [T.StructField(name, dtype, True) for name, dtype in pairs]


_FLOW_PAIRS = [(c, T.DoubleType()) for c in NUMERIC] + [(c, T.StringType()) for c in CATEGORICAL]

FLOW = T.StructType(_fields(_FLOW_PAIRS + [(LABEL, T.StringType())]))

# Columns of the five stored tables.
FLOW_TABLE = T.StructType(FLOW.fields + _fields([
    ("batch_id", T.StringType()), ("source", T.StringType()), ("created_at", T.TimestampType()),
]))

PREDICTION_TABLE = T.StructType(_fields([
    ("batch_id", T.StringType()), ("source", T.StringType()), ("model_name", T.StringType()),
    ("model_version", T.StringType()), ("run_id", T.StringType()), ("attack_type", T.StringType()),
    ("anomaly_score", T.DoubleType()), ("is_anomaly", T.BooleanType()),
    ("true_label", T.StringType()), ("confidence", T.DoubleType()),
    ("created_at", T.TimestampType()),
]))

DRIFT_TABLE = T.StructType(_fields([
    ("run_id", T.StringType()), ("model_version", T.StringType()), ("window_rows", T.LongType()),
    ("drifted_features", T.StringType()), ("feature_drift_share", T.DoubleType()),
    ("live_f1", T.DoubleType()), ("live_precision", T.DoubleType()),
    ("live_recall", T.DoubleType()), ("performance_drift", T.BooleanType()),
    ("overall_drift", T.BooleanType()), ("retrain_recommended", T.BooleanType()),
    ("report_json", T.StringType()), ("created_at", T.TimestampType()),
]))

AUDIT_TABLE = T.StructType(_fields([
    ("trigger", T.StringType()), ("old_model_version", T.StringType()),
    ("new_model_version", T.StringType()), ("new_run_id", T.StringType()),
    ("new_f1", T.DoubleType()), ("old_f1", T.DoubleType()), ("promoted", T.BooleanType()),
    ("notes", T.StringType()), ("created_at", T.TimestampType()),
]))

VERSION_TABLE = T.StructType(_fields([
    ("model_name", T.StringType()), ("version", T.LongType()), ("path", T.StringType()),
    ("run_id", T.StringType()), ("f1", T.DoubleType()), ("precision", T.DoubleType()),
    ("recall", T.DoubleType()), ("promoted", T.BooleanType()), ("notes", T.StringType()),
    ("created_at", T.TimestampType()),
]))

PACKET = T.StructType(_fields([
    ("event_id", T.LongType()), ("ts", T.TimestampType()), ("proto", T.StringType()),
    ("src", T.StringType()), ("dst", T.StringType()), ("sport", T.IntegerType()),
    ("dport", T.IntegerType()), ("len", T.LongType()), ("tcp_flags", T.IntegerType()),
]))

# Column order of the public labelled connection dataset.
NSL_COLUMNS = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "land",
    "wrong_fragment", "urgent", "hot", "num_failed_logins", "logged_in", "num_compromised",
    "root_shell", "su_attempted", "num_root", "num_file_creations", "num_shells",
    "num_access_files", "num_outbound_cmds", "is_host_login", "is_guest_login", "count",
    "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate", "srv_rerror_rate",
    "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate", "dst_host_count",
    "dst_host_srv_count", "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate", "dst_host_serror_rate",
    "dst_host_srv_serror_rate", "dst_host_rerror_rate", "dst_host_srv_rerror_rate",
]
