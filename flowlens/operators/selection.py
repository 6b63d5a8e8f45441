"""Exact order statistics and quantiles of many columns without a global sort.

``percentile`` keeps every distinct value of a column in one buffer, which does not survive a
large table. Here one pass of mergeable sketches brackets each wanted rank, one pass counts the
values around the brackets (everything outside collapses to one row per gap and task), and only
the values inside the brackets are sorted, per bracket. A bracket that still holds too many
distinct values is narrowed with another sketch, so no task sorts an unbounded group.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from flowlens.functions.columns import null_if_nan

INF = float("inf")
Interval = tuple[float, float]


def _above(x: float) -> float:
    return math.nextafter(x, INF)


def _merge(intervals: Sequence[Interval]) -> list[Interval]:
    """Union of closed intervals, disjoint and sorted; touching ones are joined."""
    merged: list[Interval] = []
    for low, high in sorted(intervals):
        if merged and low <= _above(merged[-1][1]):
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged


def _bounds(intervals: Sequence[Interval]) -> list[float]:
    """Cut points so that odd cells are the intervals and even cells the gaps between them. Nothing
    lies above infinity, so an interval up to there has no closing cut."""
    return [e for low, high in intervals for e in ((low,) if high == INF else (low, _above(high)))]


def bucket_index(df: DataFrame, cuts: Mapping[str, Sequence[float]], suffix: str) -> DataFrame:
    """Add ``column + suffix``: how many of the column's cut points are <= the value.

    Values equal to a cut fall to its right; NULL stays NULL. Binary search on the JVM side.
    """
    names = [c for c in cuts if any(-INF < e < INF for e in cuts[c])]
    base = {c: sum(e == -INF for e in cuts[c]) for c in cuts}
    top = {c: sum(e == INF for e in cuts[c]) for c in cuts}
    if names:
        df = Bucketizer(
            splitsArray=[[-INF] + [e for e in cuts[c] if -INF < e < INF] + [INF] for c in names],
            inputCols=names, outputCols=[c + suffix for c in names], handleInvalid="keep",
        ).transform(df)
    indexes = {
        c + suffix: F.when(
            F.col(c).isNotNull(),
            (F.col(c + suffix).cast("int") if c in names else F.lit(0)) + F.lit(base[c])
            + (F.when(F.col(c) == INF, top[c]).otherwise(0) if top[c] else F.lit(0)),
        )
        for c in cuts
    }
    return df.withColumns(indexes)


def long_form(values: Mapping[str, Sequence[Column]], names: Sequence[str]) -> Column:
    """One struct per column in an array, for ``inline``: (feature, *names)."""
    return F.inline(F.array(*[
        F.struct(F.lit(key).alias("feature"), *[c.alias(n) for c, n in zip(cells, names)])
        for key, cells in values.items()
    ]))


def _literals(values: Sequence[float]) -> str:
    return ", ".join(f"{v!r}D" for v in values)


def sketch(
    df: DataFrame, requests: Mapping[str, tuple[str, Sequence[float]]], accuracy: int
) -> tuple[dict[str, int], dict[str, list[float]]]:
    """Non-null counts and approximate quantiles of every (column, fractions) request, in one
    aggregation."""
    aggs = []
    for i, (column, fractions) in enumerate(requests.values()):
        aggs.append(f"count(`{column}`) AS n{i}")
        if fractions:
            aggs.append(f"percentile_approx(`{column}`, array({_literals(fractions)}), {accuracy}) AS q{i}")
    row = df.selectExpr(*aggs).first().asDict()
    return (
        {key: row[f"n{i}"] for i, key in enumerate(requests)},
        {key: list(row.get(f"q{i}") or []) for i, key in enumerate(requests)},
    )


def _around(fraction: float, accuracy: int) -> list[float]:
    slack = 2.0 / accuracy
    return [max(0.0, fraction - slack), min(1.0, fraction + slack)]


def _brackets(fractions: Sequence[float], values: Sequence[float], accuracy: int) -> list[Interval]:
    slack = 2.0 / accuracy
    out = []
    for i, fraction in enumerate(fractions):
        low, high = values[2 * i], values[2 * i + 1]
        out.append((
            -INF if fraction - slack <= 0.0 else low,
            INF if fraction + slack >= 1.0 else high,
        ))
    return out


def order_statistics(
    df: DataFrame,
    columns: Mapping[str, Column],
    fractions: Sequence[float] | Mapping[str, Sequence[float]],
    ranks: Callable[[int, float], Sequence[int]],
    accuracy: int = 10_000,
    max_distinct: int = 1_000_000,
) -> tuple[dict[str, int], dict[str, dict[int, float]]]:
    """Non-null counts and exact values at 0-based ranks ``ranks(n, fraction)`` of every column."""
    per_column = {
        c: list(fractions[c] if isinstance(fractions, Mapping) else fractions) for c in columns
    }
    flat = df.select(*[null_if_nan(columns[c].cast("double")).alias(c) for c in columns])
    names = list(per_column)
    counts, approx = sketch(
        flat,
        {c: (c, [q for f in per_column[c] for q in _around(f, accuracy)]) for c in names},
        accuracy,
    )
    wanted = {
        c: sorted({r for f in per_column[c] for r in ranks(counts[c], f)})
        for c in names if counts[c]
    }
    wanted = {c: rs for c, rs in wanted.items() if rs}
    intervals = {
        c: _merge(_brackets(per_column[c], approx[c], accuracy)) for c in wanted
    }
    found: dict[str, dict[int, float]] = {c: {} for c in names}
    # Finer sketches each round, so that brackets shrink down to neighbouring values in the end.
    max_distinct = max(max_distinct, 8)
    while wanted:
        cells = _count_cells(flat, intervals)
        cells.persist(StorageLevel.MEMORY_AND_DISK)
        totals = _cell_totals(cells, wanted)
        ready, again = _locate(wanted, intervals, totals, max_distinct)
        for c, rank, value in _pick(cells, ready):
            found[c][rank] = value
        cells.unpersist()
        accuracy = min(accuracy * 8, 10_000_000)
        wanted, intervals = _narrow(flat, again, accuracy)
    return counts, found


def _count_cells(flat: DataFrame, intervals: Mapping[str, list[Interval]]) -> DataFrame:
    """(feature, cell, value or NULL outside the brackets, n), combined before the shuffle."""
    cuts = {c: _bounds(iv) for c, iv in intervals.items()}
    indexed = bucket_index(flat.select(*cuts), cuts, "__cell")
    cells = {
        c: (F.col(c + "__cell"), F.when(F.col(c + "__cell") % 2 == 1, F.col(c))) for c in cuts
    }
    return (
        indexed.select(long_form(cells, ["cell", "value"]))
        .where(F.col("cell").isNotNull())
        .groupBy("feature", "cell", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def _cell_totals(cells: DataFrame, wanted: Mapping) -> dict[str, dict[int, tuple[int, int]]]:
    rows = (
        cells.groupBy("feature", "cell")
        .agg(F.sum("n").alias("n"), F.count("value").alias("distinct")).collect()
    )
    totals: dict[str, dict[int, tuple[int, int]]] = {c: {} for c in wanted}
    for row in rows:
        totals[row["feature"]][row["cell"]] = (row["n"], row["distinct"])
    return totals


def _locate(wanted, intervals, totals, max_distinct):
    """Split the wanted ranks into (feature, cell, rank, rank within the cell) and those that
    need a narrower bracket, as (feature, rank, interval, rank within it, rows in it)."""
    ready, again = [], []
    for c, rs in wanted.items():
        ordered = sorted(totals[c])
        starts, running = [], 0
        for cell in ordered:
            starts.append(running)
            running += totals[c][cell][0]
        edges = [-INF] + _bounds(intervals[c]) + [INF]
        for rank in rs:
            i = bisect_right(starts, rank) - 1
            cell, local = ordered[i], rank - starts[i]
            n, distinct = totals[c][cell]
            if cell % 2 == 1 and distinct <= max_distinct:
                ready.append((c, cell, rank, local))
            else:
                high = edges[cell + 1]
                high = high if high == INF else math.nextafter(high, -INF)
                again.append((c, rank, (edges[cell], high), local, n))
    return ready, again


def _pick(cells: DataFrame, ready) -> list[tuple[str, int, float]]:
    if not ready:
        return []
    spark = cells.sparkSession
    targets = spark.createDataFrame(ready, "feature string, cell int, rank long, local long")
    order = Window.partitionBy("feature", "cell").orderBy("value")
    placed = (
        cells.join(F.broadcast(targets.select("feature", "cell").distinct()), ["feature", "cell"], "left_semi")
        .withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    hits = placed.join(F.broadcast(targets), ["feature", "cell"]).where(
        (F.col("upto") > F.col("local")) & (F.col("upto") - F.col("n") <= F.col("local"))
    )
    return [(r["feature"], r["rank"], r["value"]) for r in hits.select("feature", "rank", "value").collect()]


def _narrow(flat: DataFrame, again, accuracy: int):
    """Sketch inside the intervals that are still too wide and bracket their ranks tighter."""
    if not again:
        return {}, {}
    requests, inner, local_fraction = {}, {}, {}
    for i, (c, rank, (low, high), local, n) in enumerate(again):
        fraction = (local + 0.5) / n
        inner[f"inner{i}"] = F.when((F.col(c) >= low) & (F.col(c) <= high), F.col(c))
        requests[str(i)] = (f"inner{i}", _around(fraction, accuracy))
        local_fraction[str(i)] = fraction
    _, approx = sketch(flat.select(*[c.alias(k) for k, c in inner.items()]), requests, accuracy)
    wanted: dict[str, list[int]] = {}
    intervals: dict[str, list[Interval]] = {}
    for i, (c, rank, (low, high), _, _) in enumerate(again):
        key = str(i)
        inner_low, inner_high = _brackets([local_fraction[key]], approx[key], accuracy)[0]
        wanted.setdefault(c, []).append(rank)
        intervals.setdefault(c, []).append((max(low, inner_low), min(high, inner_high)))
    return (
        {c: sorted(rs) for c, rs in wanted.items()},
        {c: _merge(iv) for c, iv in intervals.items()},
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    fractions: Sequence[float],
    **options,
) -> tuple[dict[str, int], dict[str, list[float | None]]]:
    """Non-null counts and linearly interpolated quantiles of every column (NULL and NaN skipped)."""
    if not isinstance(columns, Mapping):
        columns = {c: F.col(c) for c in columns}

    def neighbours(n: int, f: float) -> list[int]:
        low = min(int(math.floor(f * (n - 1))), n - 1)
        return [low, min(low + 1, n - 1)]

    counts, values = order_statistics(df, columns, fractions, neighbours, **options)
    out: dict[str, list[float | None]] = {}
    for c in columns:
        n, at = counts[c], values[c]
        out[c] = []
        for f in fractions:
            if not n:
                out[c].append(None)
                continue
            low, high = (at[r] for r in neighbours(n, f))
            position = f * (n - 1)
            out[c].append(low + (high - low) * (position - math.floor(position)))
    return counts, out


def newest(df: DataFrame, time_column: str, n: int, *tie_break: str) -> DataFrame:
    """The ``n`` rows with the latest time; of rows with the same time those with the largest ``tie_break``, then a hash
    of the row. The cutoff is found first, in time and then among the rows of that time, so the final
    top-k sees ``n`` rows and the cutoff can prune files."""
    micros = F.unix_micros(F.col(time_column).cast("timestamp"))
    tie = F.shiftrightunsigned(F.xxhash64(*sorted(df.columns)), 12)
    total = df.count()
    if total > n > 0:
        _, at = order_statistics(df, {"t": micros}, [1.0 - n / total], lambda rows, _: [max(rows - n, 0)])
        kept = at["t"]
        if kept:
            cutoff = F.lit(int(next(iter(kept.values()))))
            if not tie_break:
                later = df.where(micros > cutoff).count()
                same = df.where(micros == cutoff)
                ties, room = same.count(), n - later
                if ties > room > 0:
                    _, at = order_statistics(same, {"h": tie}, [1.0 - room / ties], lambda rows, _: [max(rows - room, 0)])
                    least = F.lit(int(next(iter(at["h"].values()))))
                    df = df.where((micros != cutoff) | (tie >= least))
            bound = F.timestamp_micros(cutoff).cast(df.schema[time_column].dataType)
            df = df.where(F.col(time_column) >= bound)
    return df.orderBy(F.col(time_column).desc(), *[F.col(c).desc() for c in tie_break], tie.desc()).limit(n)
