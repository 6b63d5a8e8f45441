"""Fixity audit of WARC replicas by Merkle trees.

A replica is a table of records: archive file, place in it (``seq``), and record. The leaves of a file's tree are its
records' hashes; leaves are gathered by ranges of ``RANGE_BYTES`` of the first replica's offsets, and ``FANOUT`` neighbours
at a time above that, up to one root per file; files are gathered the same way up to the root of the replica. The audit
compares the roots and goes down level by level, only into branches that differ, to the records that are changed, missing
or extra.

The second replica takes its ranges from the first one's: the first ``seq`` and hash of every range mark where it begins, so
a record that is longer, shorter, lost or inserted moves no later record into another range. What a replica holds beyond
``RANGE_BYTES`` of a range counts to the ranges after it, so a range stays small if much was inserted. Ranges that agree hold
the same records; those of the others are compared by file, ``seq`` and hash, wherever they stand.

Records are hashed where they are read; only hashes and offsets are shuffled. A node has at most ``FANOUT`` children, the
lowest one as many as records start in its range of bytes, so no group grows with the input.

Offsets are those of the first replica. An extra record is put behind the record before it there, and behind other extra
ones at that place.

Edge cases: an empty replica has no nodes, and all records of the other are missing or extra; two empty replicas agree. A
null record counts as one without bytes. Records that repeat a ``seq`` are leaves in the order of their hashes: equal ones
are paired first, the rest in order. A null ``seq`` counts as one value, before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.session import staged

RANGE_BYTES, FANOUT = 1 << 17, 16


def response_record(url: Column, html: Column, key: Column) -> Column:
    """Bytes of a WARC response record; nulls are written as empty."""
    body = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    head = F.concat_ws("\r\n", F.lit("WARC/1.0"), F.lit("WARC-Type: response"),
                       F.concat(F.lit("WARC-Target-URI: "), F.coalesce(url, F.lit(""))),
                       F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">")),
                       F.concat(F.lit("Content-Length: "), F.length(body).cast("string")), F.lit("\r\n"))
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def leaves(records: DataFrame, marks: DataFrame | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """File, seq, offset, end, hash and range (``node``) of every record, from ``file``, ``seq`` and ``record`` (bytes): a
    record starts where the one before it in its file ends. Ranges are those of the offsets, or begin at ``marks``; ``anchor``
    is the number of the last mark."""
    narrow = records.select(F.coalesce("file", F.lit(-1)).cast("long").alias("file"), "seq", F.length(F.coalesce("record", F.lit(b""))).cast("long").alias("size"),
                            F.sha2(F.coalesce("record", F.lit(b"")), 256).alias("hash"), F.lit(None).cast("long").alias("mark"))
    rows = narrow if marks is None else narrow.unionByName(marks.withColumn("size", F.lit(0).cast("long")))
    order = (Window.partitionBy("file").orderBy("seq", "hash", F.col("mark").isNull(), "mark")
             .rowsBetween(Window.unboundedPreceding, 0))
    end = F.sum("size").over(order)
    placed = rows.select("file", "seq", (end - F.col("size")).alias("at"), end.alias("end"), "hash", "mark")
    if marks is None:
        node = F.expr(f"at div {range_bytes}")
        return placed.select("file", "seq", "at", "end", "hash", node.alias("anchor"), node.alias("node"))
    # A mark stands at the offset of the record behind it.
    begun = F.last(F.when(F.col("mark").isNotNull(), F.struct("mark", "at")), ignorenulls=True).over(order)
    behind = F.col("at") - F.coalesce("begun.at", F.lit(0))
    return (placed.withColumn("begun", begun).where("mark IS NULL")
            .select("file", "seq", "at", "end", "hash", F.col("begun.mark").alias("anchor"), behind.alias("behind"))
            .withColumn("node", F.coalesce("anchor", F.lit(0)) + F.expr(f"behind div {range_bytes}")).drop("behind"))


def range_marks(leaf: DataFrame) -> DataFrame:
    """The first seq and hash of every range of the first replica."""
    first = leaf.groupBy("file", "node").agg(F.min(F.struct("seq", "hash")).alias("least"))
    return first.select("file", "least.seq", "least.hash", F.col("node").alias("mark"))


def parents(nodes: DataFrame, node: Column, file: Column) -> DataFrame:
    """Nodes of the next level: the hash of the children's places and hashes in order."""
    child = F.struct("file", "place", "hash")
    return nodes.groupBy(file.alias("up_file"), node.alias("up")).agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda c: F.concat_ws(
            ":", c["file"].cast("string"), F.coalesce(c["place"].cast("string"), F.lit("")), c["hash"])), "\n"), 256)
        .alias("hash")).select(F.col("up_file").alias("file"), F.col("up").alias("node"), F.col("up").alias("place"), "hash")


def levels_for(top: int, fanout: int) -> int:
    """Levels above the lowest until one node is left of the numbers 0 to ``top``."""
    n = 0
    while top > 0:
        top //= fanout
        n += 1
    return n


def tree(leaf: DataFrame, within: int, across: int, fanout: int) -> list[DataFrame]:
    """Levels of nodes (file, node, place, hash) from the records up: ``within`` files, then ``across`` them."""
    levels = [leaf.select("file", "node", F.col("seq").alias("place"), "hash")]
    up = F.col("node")
    for _ in range(within + 1):
        levels.append(staged(parents(levels[-1], up, F.col("file")), "fixity-level"))
        up = F.expr(f"node div {fanout}")
    for _ in range(across):
        levels.append(staged(parents(levels[-1], F.lit(0).cast("long"), F.floor(F.col("file") / fanout)), "fixity-level"))
    return levels


def unpaired(a: DataFrame, b: DataFrame) -> DataFrame:
    """Leaves of two replicas that have no equal one in the other, paired by file and seq: ``a`` and ``b``, one may be null."""
    fields = ("at", "end", "hash", "anchor")
    both = (a.select("file", "seq", "hash", F.struct(*fields).alias("a"), F.lit(None).alias("b"), F.lit(0).alias("side"))
            .unionByName(b.select("file", "seq", "hash", F.lit(None).alias("a"), F.struct(*fields).alias("b"), F.lit(1).alias("side"))))
    at = F.coalesce("a.at", "b.at")
    copies = both.withColumn("copy", F.row_number().over(Window.partitionBy("file", "seq", "hash", "side").orderBy(at)))
    alone = copies.withColumn("n", F.count("*").over(Window.partitionBy("file", "seq", "hash", "copy"))).where("n = 1")
    nth = F.row_number().over(Window.partitionBy("file", "seq", "side").orderBy("hash", "copy"))
    return alone.withColumn("nth", nth).groupBy("file", "seq", "nth").agg(
        F.first("a", ignorenulls=True).alias("a"), F.first("b", ignorenulls=True).alias("b"))


def placed_extras(extra: DataFrame, first: DataFrame) -> DataFrame:
    """Offsets in the first replica of extra records (file, seq, hash, anchor, size)."""
    near = first.join(extra.select("file", F.col("anchor").alias("node")).distinct(), ["file", "node"], "left_semi")
    rows = extra.withColumn("end", F.lit(None).cast("long")).unionByName(near.select(
        "file", "seq", "hash", F.col("node").alias("anchor"), F.lit(None).cast("long").alias("size"), "end"))
    before = (Window.partitionBy("file", "anchor").orderBy("seq", F.col("end").isNull(), "hash")
              .rowsBetween(Window.unboundedPreceding, 0))
    behind = Window.partitionBy("file", "point").orderBy("seq", "hash").rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("point", F.coalesce(F.max("end").over(before), F.lit(0))).where("end IS NULL")
            .withColumn("end_byte", F.col("point") + F.sum("size").over(behind))
            .select("file", "seq", (F.col("end_byte") - F.col("size")).alias("begin_byte"), "end_byte", F.lit("extra").alias("damage")))


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Records in which the replicas differ: file, seq, offset range, and ``changed``, ``missing`` (in the second) or
    ``extra`` (only in the second)."""
    leaf = staged(leaves(first, range_bytes=range_bytes), "fixity-leaves")
    sides = [leaf, staged(leaves(second, range_marks(leaf), range_bytes), "fixity-leaves")]
    # Two numbers size the trees: the last range of a file and the largest file number.
    tops = [s.agg(F.max("node").alias("node"), F.max("file").alias("hi"), F.min("file").alias("lo")).first() for s in sides]
    within = levels_for(max((t["node"] or 0) for t in tops), fanout)
    lowest = min((t["lo"] or 0) for t in tops)
    across = levels_for(max((t["hi"] or 0) for t in tops), fanout) + (1 if lowest < 0 else 0)
    trees = [tree(s, within, across, fanout) for s in sides]
    differing = None
    for level in range(len(trees[0]) - 1, 0, -1):
        a, b = (t[level].select("file", "node", "hash") for t in trees)
        if differing is not None:
            a, b = (below(x, level, differing, within, fanout) for x in (a, b))
        found = (a.join(b.withColumnRenamed("hash", "other"), ["file", "node"], "full")
                 .where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node"))
        differing = staged(found, "fixity-differing")
        if not differing.limit(1).count():
            break
    found = staged(unpaired(*(below(s, 0, differing, within, fanout) for s in sides)), "fixity-unpaired")
    extra = found.where("a IS NULL").select("file", "seq", "b.hash", "b.anchor", (F.col("b.end") - F.col("b.at")).alias("size"))
    return found.where("a IS NOT NULL").select(
        "file", "seq", F.col("a.at").alias("begin_byte"), F.col("a.end").alias("end_byte"),
        F.when(F.col("b").isNull(), "missing").otherwise("changed").alias("damage")).unionByName(placed_extras(extra, leaf))


def below(nodes: DataFrame, level: int, differing: DataFrame, within: int, fanout: int) -> DataFrame:
    """Nodes of a level whose parent differs."""
    if level == 0:
        up, file = F.col("node"), F.col("file")
    elif level <= within:
        up, file = F.expr(f"node div {fanout}"), F.col("file")
    else:
        up, file = F.lit(0).cast("long"), F.floor(F.col("file") / fanout)
    parent = differing.select(F.col("file").alias("up_file"), F.col("node").alias("up"))
    return (nodes.withColumns({"up_file": file, "up": up}).join(parent, ["up_file", "up"], "left_semi")
            .drop("up_file", "up"))
