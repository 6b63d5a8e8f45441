"""Flows that end on a reset, on an opening and a closing flag, or when idle, over stored packets.

Whether a packet begins a flow depends on all packets of its conversation before it. That is an automaton of four states: the
flags seen in the open flow (none, syn, fin), or closed. A stretch of packets is a map from the state before it to the state
after it, and maps of neighbouring stretches compose, so no conversation has to be one task:

1. packets are sorted by range over all tasks, whatever conversation they belong to, and numbered;
2. every chunk of at most ``CHUNK`` packets of a conversation becomes one map, with its first and last time;
3. maps are composed in groups of ``CHUNK``, those again, until one is left for each conversation; then the states
   before each chunk are handed down the same way;
4. each chunk marks where its flows begin; a flow is named by its first packet, which may lie chunks before.

Counters of a flow combine within chunks first. The spread of gaps is merged from chunks: a flow of n packets has n / ``CHUNK`` of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions import lookups as L
from flowlens.functions.columns import flag_set
from flowlens.operators.flows import CONVERSATION, merge_counters, orient, scan_packets, slice_counters, with_conversation
from flowlens.session import staged

CHUNK_BITS = 10
#: States: flags seen in the open flow as bits (1 syn, 2 fin); 3 is closed.
CLOSED = 3
KEY = ["proto", "a", "b"]


def _after(state: Column, packet: Column) -> Column:
    """State after a packet; it opens a flow if the last one is closed or idle for too long."""
    seen = F.when((state == CLOSED) | packet["idle"], 0).otherwise(state).bitwiseOR(packet["bits"])
    return F.when(packet["rst"], CLOSED).otherwise(seen)


def numbered(packets: DataFrame) -> DataFrame:
    """Packets with ``at``, their place in the order of conversation and time, and ``chunk``; written, so that it stays."""
    keyed = with_conversation(scan_packets(packets))
    order = [*CONVERSATION, "us", "event_id"]
    placed = staged(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("at", F.monotonically_increasing_id()), "packets")
    return placed.withColumn("chunk", F.shiftright("at", CHUNK_BITS))


def _chunks(placed: DataFrame, idle_us: int) -> DataFrame:
    """(key, chunk, packets): the packets of a chunk in order, of which there is a fixed number at most."""
    tcp, flags = F.col("proto") == "tcp", F.col("tcp_flags").cast("int")
    bit = lambda mask, value: F.when(tcp & flag_set(flags, mask), value).otherwise(0)
    packet = F.struct(
        "at", "us", bit(L.TCP_SYN, 1).bitwiseOR(bit(L.TCP_FIN, 2)).alias("bits"),
        F.coalesce(tcp & flag_set(flags, L.TCP_RST), F.lit(False)).alias("rst"))
    gathered = placed.groupBy(*KEY, "chunk").agg(F.array_sort(F.collect_list(packet)).alias("p"))
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice(F.transform("p", lambda x: x["us"]), F.lit(1), F.size("p") - 1))
    idle = F.zip_with("p", before, lambda x, us: F.struct(
        x["at"].alias("at"), x["bits"].alias("bits"), x["rst"].alias("rst"),
        F.coalesce(x["us"] - us >= idle_us, F.lit(False)).alias("idle")))
    return gathered.select(*KEY, "chunk", idle.alias("packets"), F.element_at("p", 1)["us"].alias("first_us"),
                           F.element_at("p", -1)["us"].alias("last_us"))


def _map_of(entry: int) -> Column:
    """(state, begun): state after a chunk that is entered in ``entry``, and the last packet that begins a flow in it."""
    start = F.struct(F.lit(entry).alias("state"), F.lit(None).cast("long").alias("begun"))
    return F.aggregate("packets", start, lambda acc, x: F.struct(
        _after(acc["state"], x).alias("state"),
        F.when((acc["state"] == CLOSED) | x["idle"], x["at"]).otherwise(acc["begun"]).alias("begun")))


def _entered(state: Column, last_us: Column, first_us: Column, idle_us: int) -> Column:
    """State in which a stretch is entered: closed after an idle time."""
    return F.when(first_us - last_us >= idle_us, CLOSED).otherwise(state)


def _composed(idle_us: int, entry: int) -> Column:
    """Map of the stretches in ``parts``, in order, entered in ``entry``; the first one's own gap is not known here."""
    head = F.element_at("parts", 1)
    start = F.struct(head["maps"][entry]["state"].alias("state"), head["maps"][entry]["begun"].alias("begun"), head["last_us"].alias("us"))

    def step(acc, part):
        to = part["maps"][_entered(acc["state"], acc["us"], part["first_us"], idle_us)]
        return F.struct(to["state"].alias("state"), F.coalesce(to["begun"], acc["begun"]).alias("begun"), part["last_us"].alias("us"))

    done = F.aggregate(F.slice("parts", F.lit(2), F.size("parts")), start, step)
    return F.struct(done["state"].alias("state"), done["begun"].alias("begun"))


def _walk(idle_us: int) -> Column:
    """What each stretch of ``parts`` is entered with, given ``state``, ``begun`` and ``us`` before the first."""
    start = F.struct(F.col("state").alias("state"), F.col("begun").alias("begun"), F.col("us").alias("us"),
                     F.array().cast("array<struct<chunk:bigint,state:int,begun:bigint,us:bigint>>").alias("out"))

    def step(acc, part):
        state = _entered(acc["state"], acc["us"], part["first_us"], idle_us)
        to = part["maps"][state]
        line = F.struct(part["chunk"].alias("chunk"), state.alias("state"), acc["begun"].alias("begun"), acc["us"].alias("us"))
        return F.struct(to["state"].alias("state"), F.coalesce(to["begun"], acc["begun"]).alias("begun"), part["last_us"].alias("us"),
                        F.concat(acc["out"], F.array(line)).alias("out"))

    return F.aggregate("parts", start, step)["out"]


def entries(maps: DataFrame, idle_us: int) -> DataFrame:
    """(key, chunk, state, begun): how each stretch is entered, from (key, chunk, maps, first_us, last_us)."""
    maps = staged(maps, "maps")
    part = F.struct("chunk", "maps", "first_us", "last_us")
    grouped = maps.groupBy(*KEY, F.shiftright("chunk", CHUNK_BITS).alias("above")).agg(F.array_sort(F.collect_list(part)).alias("parts"))
    several = grouped.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if several.isEmpty():
        outer = grouped.select(*KEY, "above", "parts", F.lit(CLOSED).alias("state"), F.lit(None).cast("long").alias("begun"),
                               F.lit(None).cast("long").alias("us"))
    else:
        upper = grouped.select(
            *KEY, F.col("above").alias("chunk"), F.array(*[_composed(idle_us, s) for s in range(4)]).alias("maps"),
            F.element_at("parts", 1)["first_us"].alias("first_us"), F.element_at("parts", -1)["last_us"].alias("last_us"))
        known = entries(upper, idle_us).withColumnRenamed("chunk", "above")
        outer = grouped.join(known, [*KEY, "above"])
    lines = outer.select(*KEY, F.explode(_walk(idle_us)).alias("e"))
    return lines.select(*KEY, "e.chunk", "e.state", "e.begun", "e.us")


def tcp_session_flows(packets: DataFrame, idle_seconds: float = 5.0) -> DataFrame:
    """One row per flow; a flow without packets after its close is closed too, the last one of a conversation may be open.

    A null key column is a conversation of its own; packets at one time are taken in the order of ``event_id``."""
    idle_us = int(idle_seconds * 1e6)
    placed = numbered(packets)
    # Keys without nulls, for the joins; the endpoints come back with the counters.
    placed = placed.withColumns({k: F.coalesce(F.to_json(F.col(k)), F.lit("null")) if k != "proto" else F.col(k) for k in KEY}
                                | {"ends": F.struct("a", "b")})
    chunks = staged(_chunks(placed, idle_us), "chunks")
    maps = chunks.select(*KEY, "chunk", F.array(*[_map_of(s) for s in range(4)]).alias("maps"), "first_us", "last_us")
    entered = chunks.join(entries(maps, idle_us), [*KEY, "chunk"])
    start = F.struct(F.col("state").alias("state"), F.col("begun").alias("begun"),
                     F.array().cast("array<struct<at:bigint,flow:bigint>>").alias("out"))

    def step(acc, x):
        flow = F.when((acc["state"] == CLOSED) | x["idle"], x["at"]).otherwise(acc["begun"])
        return F.struct(_after(acc["state"], x).alias("state"), flow.alias("begun"),
                        F.concat(acc["out"], F.array(F.struct(x["at"].alias("at"), flow.alias("flow")))).alias("out"))

    named = entered.select(F.explode(F.aggregate("packets", start, step)["out"]).alias("x")).select("x.at", "x.flow")
    rows = placed.join(named, "at")
    # Gaps within a chunk; merge_counters adds those between the chunks of a flow.
    lines = F.array_sort(F.collect_list("us"))
    gaps = F.transform(F.sequence(F.lit(2), F.size("times")), lambda i: (F.element_at("times", i) - F.element_at("times", i - 1)).cast("double"))
    mean = (F.element_at("times", -1) - F.element_at("times", 1)) / (F.size("times") - 1)
    m2 = F.when(F.size("times") > 1, F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + (g - mean) * (g - mean))).otherwise(0.0)
    pieces = (rows.groupBy("proto", "flow", "chunk", F.col("ends.a").alias("a"), F.col("ends.b").alias("b"))
              .agg(*slice_counters(), lines.alias("times")).withColumn("gap_m2", m2).drop("times"))
    return orient(pieces.groupBy("proto", "a", "b", "flow").agg(*merge_counters()))
