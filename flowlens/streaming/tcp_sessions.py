"""Flows of a packet stream that end on a reset, on an opening and a closing flag, or when idle.

A stateful processor per conversation. Packets wait in a list until the watermark has passed them, so that they are taken in the order
of time whatever order they came in; then they are folded into the open flow, which is a row of counters, with the gaps as number,
mean and squared deviations. So the state of a conversation is one row and the packets of the last watermark delay, however long the
flow is. An event-time timer stands at the next moment at which the watermark can settle a packet or end the flow by idleness.

Packets later than the watermark are dropped. Packets at one time are taken in the order of ``event_id``. The state needs the RocksDB
provider, see ``use_rocksdb``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowlens.functions import lookups as L
from flowlens.operators.flows import scan_packets, with_conversation

KEY = ["proto", "a_ip", "a_port", "b_ip", "b_port"]
PACKET = "us long, event_id long, from_a boolean, size long, flags int"
OPEN = ("first_us long, last_us long, from_a boolean, packets long, forward_packets long, src_bytes long, dst_bytes long, "
        "syn long, fin long, rst long, gap_mean double, gap_m2 double")
FLOW = ("proto string, src string, sport int, dst string, dport int, packets long, forward_packets long, src_bytes long, "
        "dst_bytes long, first_us long, last_us long, syn long, fin long, rst long, gap_std double")
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def use_rocksdb(spark: SparkSession):
    """The state store that a stateful processor needs, for streams that are started inside."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def folded(flow: tuple | None, packet: tuple) -> tuple:
    """The open flow with one more packet."""
    us, _, from_a, size, flags = packet
    syn, fin, rst = (int(bool(flags & mask)) for mask in (L.TCP_SYN, L.TCP_FIN, L.TCP_RST))
    if flow is None:
        return us, us, from_a, 1, 1, size, 0, syn, fin, rst, 0.0, 0.0
    first, last, own, n, ahead, sent, got, syns, fins, rsts, mean, m2 = flow
    step = (us - last) - mean
    mean += step / n  # the n-th gap
    m2 += step * ((us - last) - mean)
    forward = from_a == own
    return (first, us, own, n + 1, ahead + forward, sent + size * forward, got + size * (not forward), syns + syn, fins + fin,
            rsts + rst, mean, m2)


def is_done(flow: tuple) -> bool:
    return flow[9] > 0 or (flow[7] > 0 and flow[8] > 0)


def flow_row(key: tuple, flow: tuple) -> tuple:
    proto, a_ip, a_port, b_ip, b_port = key
    first, last, own, n, ahead, sent, got, syn, fin, rst, _, m2 = flow
    ends = (a_ip, a_port, b_ip, b_port) if own else (b_ip, b_port, a_ip, a_port)
    return proto, *ends, n, ahead, sent, got, first, last, syn, fin, rst, (m2 / (n - 1)) ** 0.5 / 1e6 if n > 2 else 0.0


class TcpSessions(StatefulProcessor):
    def __init__(self, idle_us: int):
        self.idle_us = idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)
        self.waiting = handle.getListState("waiting", PACKET)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        settled = timerValues.getCurrentWatermarkInMs() * 1000
        fresh = [p for part in rows for p in part[["us", "event_id", "from_a", "size", "flags"]].itertuples(index=False, name=None)]
        return self._settle(key, [p for p in fresh if p[0] >= settled], settled)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._settle(key, [], timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass

    def _settle(self, key: tuple, fresh: list[tuple], settled: int) -> Iterator[pd.DataFrame]:
        """Fold the packets that the watermark has passed, and end the flow that it has left behind."""
        waiting = [tuple(p) for p in self.waiting.get()] + [(int(us), int(e), bool(a), int(n), int(f)) for us, e, a, n, f in fresh]
        ready = sorted(p for p in waiting if p[0] < settled)
        flow = tuple(self.open.get()) if self.open.exists() else None
        out = []
        for packet in ready:
            if flow is not None and packet[0] - flow[1] >= self.idle_us:
                out.append(flow_row(key, flow))
                flow = None
            flow = folded(flow, packet)
            if is_done(flow):
                out.append(flow_row(key, flow))
                flow = None
        if flow is not None and flow[1] + self.idle_us <= settled:
            out.append(flow_row(key, flow))
            flow = None
        rest = [p for p in waiting if p[0] >= settled]
        if fresh or ready:
            self.waiting.put(rest) if rest else self.waiting.clear()
        if flow is not None:
            self.open.update(flow)
        elif self.open.exists():
            self.open.clear()
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        ends = [min(p[0] for p in rest) + 1] if rest else []
        ends += [flow[1] + self.idle_us] if flow is not None else []
        if ends:
            self.handle.registerTimer(-(-min(ends) // 1000))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FLOW.split(", ")])


def tcp_session_flows(packets: DataFrame, idle_seconds: float = 5.0, watermark: str = "10 seconds") -> DataFrame:
    """One row per closed flow; start the stream inside ``use_rocksdb``."""
    timed = packets.withColumn("ts", F.col("ts").cast("timestamp"))
    keyed = with_conversation(scan_packets(timed)).withWatermark("ts", watermark)
    flags = F.when(F.col("proto") == "tcp", F.coalesce(F.col("tcp_flags"), F.lit(0))).otherwise(0).cast("int")
    rows = keyed.select(
        "ts", "proto", F.col("a.ip").alias("a_ip"), F.col("a.port").alias("a_port"), F.col("b.ip").alias("b_ip"),
        F.col("b.port").alias("b_port"), "us", F.col("event_id").cast("long").alias("event_id"), "from_a",
        F.col("len").cast("long").alias("size"), flags.alias("flags"))
    return rows.groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=TcpSessions(int(idle_seconds * 1e6)), outputStructType=FLOW, outputMode="append", timeMode="EventTime")
