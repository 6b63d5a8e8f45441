from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from flowlens import schemas as S  # noqa: E402
from flowlens.session import build_session, scratch_path  # noqa: E402
from flowlens.sources.tables import Store  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def store(spark):
    return Store(spark, scratch_path(spark, "test-store"))


def make_flows(spark, n: int, start: int = 0, attack_every: int = 4):
    """Separable flows: every ``attack_every``-th row is an attack of one of the four kinds."""
    def unit(salt):
        return F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(1_000_000)) / 1e6

    kind = F.when(F.col("id") % attack_every != 0, 0).otherwise(1 + (F.col("id") / attack_every).cast("long") % 4)
    base = spark.range(start, start + n, numPartitions=4).withColumn("k", kind)
    pick = lambda *values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("k") + 1).cast("int"))
    return base.select(
        (pick(1.0, 0.05, 0.01, 8.0, 40.0) * (0.5 + unit(1))).alias("duration"),
        (pick(400.0, 60.0, 45.0, 900.0, 90.0) * (0.5 + unit(2))).alias("src_bytes"),
        (pick(1100.0, 50.0, 45.0, 700.0, 60.0) * (0.5 + unit(3))).alias("dst_bytes"),
        F.floor(pick(6.0, 300.0, 80.0, 20.0, 5.0) * (0.5 + unit(4))).alias("count"),
        F.floor(pick(4.0, 200.0, 3.0, 30.0, 4.0) * (0.5 + unit(5))).cast("double").alias("srv_count"),
        (0.5 + 0.4 * unit(6)).alias("same_srv_rate"), (0.3 * unit(7)).alias("diff_srv_rate"),
        (pick(3.0, 1.0, 5.5, 3.0, 4.6) + 0.3 * unit(8)).alias("src_port_entropy"),
        (pick(9.0, 4000.0, 400.0, 40.0, 5.0) * (0.5 + unit(9))).alias("packet_rate"),
        (pick(0.6, 0.1, 0.1, 0.5, 9.0) * (0.5 + unit(10))).alias("connection_duration_std"),
        pick(0.0, 0.0, 0.0, 6.0, 0.0).alias("failed_logins"),
        (pick(500.0, 80.0, 50.0, 180.0, 200.0) * (0.7 + 0.6 * unit(11))).alias("bytes_per_packet"),
        F.when(F.col("id") % 5 == 0, "udp").otherwise("tcp").alias("protocol"),
        pick("http", "http", "dns", "ssh", "https").alias("service"),
        pick("SF", "S0", "REJ", "REJ", "SF").alias("flag"),
        pick(*S.LABELS).alias(S.LABEL),
    ).withColumn("count", F.col("count").cast("double"))


@pytest.fixture(scope="session")
def small_flows(spark):
    df = make_flows(spark, 4000).cache()
    df.count()
    return df
