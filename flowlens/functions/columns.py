"""Column expressions shared by batch, streaming and model jobs."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens import schemas as S
from flowlens.functions import lookups as L

RATIO_EPS = 1e-6
MIN_DURATION = 1e-3
NEUTRAL_ENTROPY = math.log1p(1)


def null_if_nan(column: Column | str) -> Column:
    """NaN becomes NULL, so both count as missing."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(c), c)


def clamp(column: Column, low: float, high: float) -> Column:
    """Clip to [low, high]; NULL stays NULL (least/greatest alone would replace it)."""
    return F.when(column < low, F.lit(low)).when(column > high, F.lit(high)).otherwise(column)


def outside(column: Column, low: float, high: float) -> Column:
    return (column < low) | (column > high)


def fold(column: Column, mapping: Mapping, default: Column) -> Column:
    """Look a key up in a small fixed table; one branch per target value, not per key."""
    targets: dict = {}
    for key, value in mapping.items():
        targets.setdefault(value, []).append(key)
    result = None
    for value, keys in targets.items():
        test = column.isin(keys)
        result = F.when(test, value) if result is None else result.when(test, value)
    return result.otherwise(default)


def with_derived(df: DataFrame) -> DataFrame:
    """Add the ratio and log features that are absent; columns already present are kept."""
    if "bytes_per_packet" not in df.columns:
        df = df.withColumn("bytes_per_packet", bytes_per_packet_fallback())
    rules = {
        "bytes_ratio": F.col("src_bytes") / (F.col("dst_bytes") + F.lit(RATIO_EPS)),
        "src_bytes_log": F.log1p(F.when(F.col("src_bytes") < 0, 0.0).otherwise(F.col("src_bytes"))),
        "duration_log": F.log1p(F.when(F.col("duration") < 0, 0.0).otherwise(F.col("duration"))),
    }
    return df.withColumns({name: c for name, c in rules.items() if name not in df.columns})


def bytes_per_packet_fallback() -> Column:
    packets = F.nullif(F.col("count") * F.col("packet_rate"), F.lit(0.0))
    return F.coalesce(
        clamp((F.col("src_bytes") + F.col("dst_bytes")) / packets, 0.0, 5000.0), F.lit(0.0)
    )


def number(column: str, default: float) -> Column:
    """Text to double; anything that is not a number takes the default."""
    return F.coalesce(null_if_nan(F.col(column).try_cast("double")), F.lit(default))


def is_attack(column: str = S.LABEL) -> Column:
    return F.col(column) != S.BENIGN


def flow_flag(packets: Column, syn: Column, fin: Column, rst: Column) -> Column:
    """Connection state from the counts of TCP control bits."""
    return (
        F.when(rst > 0, F.when(packets <= 2, "REJ").otherwise("RSTO"))
        .when((syn >= 1) & (fin >= 1), "SF")
        .when(syn >= 1, "S0")
        .otherwise("SF")
    )


def flag_set(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(F.lit(bit)) != 0


def port_service(port: Column) -> Column:
    return fold(port, L.PORT_SERVICE, F.lit(L.PORT_DEFAULT))


def hash_unit(columns: Sequence[str], seed: int = 42) -> Column:
    """Repeatable pseudo-random integer in [0, 2^52) per row content (exact as a double)."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52))


def pretty_label(column: str = S.LABEL) -> Column:
    return F.initcap(F.replace(F.col(column), F.lit("_"), F.lit(" ")))


def split_list(column: str) -> Column:
    """Stored comma list back to an array; empty or NULL is an empty array."""
    c = F.col(column)
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.split(c, ","))
