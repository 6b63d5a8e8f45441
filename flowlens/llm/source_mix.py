"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Texts are cut into blocks of words. A source's target is its share of the mix by weight, at most ``max_repeats``
times its own words; what a full source leaves is shared out among the others by weight. The source's blocks are
read in permuted order, whole epochs first, and the last epoch as far as the target goes. That gives an exact
number of blocks per source. The tree starts with these quotas and halves them level by level among the output
shards: the left half of a node draws its blocks without replacement, source by source, from a hypergeometric
distribution. A leaf holds exact quotas of one shard, which are disjoint ranges of the permuted blocks, and a
shard shuffles its own blocks.

Everything is DataFrame expressions. The permuted order is never sorted as a whole: a hash deals the blocks of a
source into bins of about ``BIN_BLOCKS``, sums of bins are accumulated in two levels, and only bins are sorted, so
a source with a third of all rows is split like any other. Tables of the tree have shards x sources numbers.

Edge cases: a null or blank text has size 0, yields no blocks and is kept with 0 words taken; a null source is a
source of its own, last in order; repeated rows are separate documents; a null ``doc_id`` is a key as any other. An
empty table yields empty results. Other columns are ignored. The same input gives the same mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.session import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE, MAX_REPEATS = 1.5, 2.0
BLOCK_WORDS = 256
BLOCKS_PER_SHARD = 8192
BIN_BLOCKS = 1024
SUPER_BINS = 1024
SEED = 20240229
#: Rejections in a row after which the mean is taken; each attempt succeeds with a chance of over one half.
ATTEMPTS = 200


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unit(*parts) -> Column:
    """Uniform number in (0, 1) from a hash."""
    hashed = F.shiftrightunsigned(F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), 11)
    return (hashed + 0.5) / float(1 << 53)


def log_factorial(n: Column) -> Column:
    """A table for small numbers, else Stirling's series."""
    table = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(10)])
    x = n.cast("double")
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 - (1 / 30 - 1 / (105 * x * x)) / (x * x)) / (12 * x)
    return F.when(n < 10, F.element_at(table, n.cast("int") + 1)).otherwise(series)


def hypergeometric(good: Column, bad: Column, draws: Column, *seed: Column) -> Column:
    """Good ones among ``draws`` without replacement: one by one for few draws, else by the ratio of uniforms."""
    total = good + bad
    few = F.least(draws, total - draws)
    small, large = F.least(good, bad), F.greatest(good, bad)

    def one_by_one(p: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), p["few"].cast("int")), F.lit(0).cast("long"),
            lambda hit, i: hit + F.when(
                unit(*seed, i, F.lit(2)) * (p["total"] - i + 1) < p["small"] - hit, F.lit(1)).otherwise(F.lit(0)).cast("long"))

    def log_odds(p: Column, k: Column) -> Column:
        return (log_factorial(k) + log_factorial(p["small"] - k) + log_factorial(p["few"] - k)
                + log_factorial(p["large"] - p["few"] + k))

    def attempt(p: Column, i: Column) -> Column:
        u, v = unit(*seed, i, F.lit(0)), unit(*seed, i, F.lit(1))
        x = p["a"] + p["h"] * (v - 0.5) / u
        k = F.floor(x)
        t = p["g"] - log_odds(p, k)
        inside = (x >= 0) & (x < p["b"])
        return F.when(inside & ((u * (4 - u) - 3 <= t) | ((u * (u - t) < 1) & (2 * F.log(u) <= t))), k)

    def by_ratio(p: Column) -> Column:
        return F.coalesce(
            F.aggregate(F.sequence(F.lit(0), F.lit(ATTEMPTS - 1)), F.lit(None).cast("long"),
                        lambda found, i: F.when(found.isNotNull(), found).otherwise(attempt(p, i))),
            F.floor(p["a"]))

    def prepared(p: Column) -> Column:
        share = p["small"] / p["total"]
        variance = (p["total"] - p["few"]) * p["few"] * share * (1 - share) / (p["total"] - 1)
        spread = F.sqrt(variance + 0.5)
        mode = F.floor((p["few"] + 1) * ((p["small"] + 1) / (p["total"] + 2)))
        a = p["few"] * share + 0.5
        return F.struct(
            p["few"].alias("few"), p["small"].alias("small"), p["large"].alias("large"), p["total"].alias("total"),
            a.alias("a"), (2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)).alias("h"),
            log_odds(p, mode).alias("g"),
            F.least((F.least(p["few"], p["small"]) + 1).cast("double"), F.floor(a + 16 * spread).cast("double")).alias("b"))

    drawn = let(
        F.struct(few.alias("few"), small.alias("small"), large.alias("large"), total.alias("total")),
        lambda p: F.when(p["few"] <= 10, one_by_one(p)).otherwise(let(prepared(p), by_ratio)))
    of_good = let(drawn, lambda k: F.when(good > bad, few - k).otherwise(k))
    return (F.when((draws <= 0) | (good <= 0), F.lit(0).cast("long")).when(bad <= 0, draws).when(draws >= total, good)
            .otherwise(let(of_good, lambda k: F.when(few < draws, good - k).otherwise(k))).cast("long"))


def word_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, key of the text and size in words, staged with a row number, so texts are read once."""
    return staged(docs.select(
        "doc_id", "source", F.xxhash64("text").alias("text_key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row")), "mix-sizes")


def targets(sizes: DataFrame, weights=WEIGHTS, total_share=TOTAL_SHARE, max_repeats=MAX_REPEATS) -> DataFrame:
    """One row per source: number, size and target in words. Windows without partitions hold a row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = per_source.withColumn("source_no", F.row_number().over(by_name) - 1)
    fill = Window.orderBy("ratio", "source_no")
    all_rows = Window.partitionBy(F.lit(1))
    return (numbered
            .withColumn("weight", F.element_at(cycle, F.col("source_no") % len(weights) + 1))
            .withColumn("cap", F.col("source_size") * float(max_repeats))
            .withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("wanted", F.sum("source_size").over(all_rows) * float(total_share))
            # Sources are full in the order of cap / weight; the first that is not sets the level for the rest.
            .withColumn("level", (F.col("wanted") - F.coalesce(F.sum("cap").over(
                fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
                / F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("first_open", F.min(F.when(
                F.col("cap") > F.col("level") * F.col("weight"), F.struct("ratio", "source_no", "level"))).over(all_rows))
            .withColumn("target", F.least(
                F.col("cap"), F.coalesce(F.col("first_open.level") * F.col("weight"), F.col("cap"))))
            .select("source", "source_no", "source_size", "target"))


def accumulated(bins: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Sums of the bins before each bin, in two levels so that no window holds all bins of a source."""
    upper = bins.groupBy(*keys, F.expr(f"bin div {SUPER_BINS}").alias("super")).agg(*[F.sum(v).alias(v) for v in values])
    over = Window.partitionBy(*keys).orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    before = upper.select(*keys, "super", *[F.coalesce(F.sum(v).over(over), F.lit(0)).alias(f"{v}_upper") for v in values])
    inner = Window.partitionBy(*keys, "super").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return (bins.withColumn("super", F.expr(f"bin div {SUPER_BINS}")).join(before, [*keys, "super"])
            .select(*keys, "bin", *[(F.col(f"{v}_upper") + F.coalesce(F.sum(v).over(inner), F.lit(0))).alias(f"{v}_before")
                                    for v in values]))


def drawn_blocks(sizes: DataFrame, plan: DataFrame, block_words: int | None, seed: int) -> DataFrame:
    """Blocks that the mix takes, with their rank in their source's permuted epochs."""
    width = F.lit(block_words).cast("long") if block_words else F.greatest(F.col("size"), F.lit(1).cast("long"))
    blocks = F.ceil(F.col("size") / width)
    per_source = (sizes.groupBy("source").agg(F.sum(blocks).alias("n_blocks"))
                  .withColumn("n_bins", F.ceil(F.col("n_blocks") / BIN_BLOCKS)))
    plan = (plan.join(per_source, plan["source"].eqNullSafe(per_source["source"])).drop(per_source["source"])
            .where("target > 0")
            .withColumn("whole", F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(1 << 30)))
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    # A row per source is joined to the rows; Spark broadcasts it when it is small, else it shuffles and splits skew.
    named = plan.withColumnRenamed("source", "of")
    rows = sizes.where("size > 0").join(named, F.col("source").eqNullSafe(F.col("of")))
    block = (rows.select("row", "doc_id", "text_key", "size", "source_no", "n_blocks", "n_bins", "whole", "rest",
                         width.alias("width"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"))
             .withColumn("words", F.least(F.col("width"), F.col("size") - F.col("block") * F.col("width")))
             .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - F.when(
                 F.col("rest") > 0, F.lit(0)).otherwise(F.lit(1)))))
             .withColumn("order", unit(seed, F.col("epoch"), F.col("doc_id"), F.col("text_key"), F.col("block")))
             .withColumn("bin", F.floor(F.col("order") * F.col("n_bins"))))
    keys = ["source_no", "epoch"]
    bins = block.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    before = accumulated(bins, keys, ["n", "w"])
    inside = Window.partitionBy(*keys, "bin").orderBy("order", "row", "block")
    ranked = (block.join(before, [*keys, "bin"])
              .withColumn("rank", F.col("epoch") * F.col("n_blocks") + F.col("n_before") + F.row_number().over(inside) - 1)
              .withColumn("reached", F.col("w_before") + F.sum("words").over(
                  inside.rowsBetween(Window.unboundedPreceding, 0))))
    # The last block is taken when at least half of it is within the target.
    taken = ranked.where((F.col("epoch") < F.col("whole")) | (F.col("reached") - F.col("words") / 2 < F.col("rest")))
    return staged(taken.select("row", "doc_id", "text_key", "source_no", "block", (F.col("block") * F.col("width")).alias(
        "first_word"), "words", "epoch", "rank"), "mix-drawn")


def split_quotas(quotas: DataFrame, n_sources: int, levels: int, seed: int) -> DataFrame:
    """Leaves of the splitting tree: shard and its number of blocks per source."""
    node = staged(quotas.select(F.lit(0).cast("long").alias("node"), "quota"), "mix-tree")

    def left_half(level: int) -> Column:
        total = F.aggregate("quota", F.lit(0).cast("long"), lambda a, q: a + q)
        start = F.struct(F.floor(total / 2).cast("long").alias("draws"), total.alias("left"),
                         F.array().cast("array<long>").alias("taken"))

        def of_source(state: Column, s: Column) -> Column:
            own = F.element_at("quota", s + 1)
            return let(hypergeometric(own, state["left"] - own, state["draws"], F.lit(seed + level), F.col("node"), s),
                       lambda k: F.struct((state["draws"] - k).alias("draws"), (state["left"] - own).alias("left"),
                                          F.concat(state["taken"], F.array(k)).alias("taken")))

        return F.aggregate(F.sequence(F.lit(0), F.lit(n_sources - 1)), start, of_source)["taken"]

    for level in range(levels):
        halves = node.select("node", "quota", left_half(level).alias("taken"))
        node = halves.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("taken").alias("quota")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("quota", "taken", lambda q, t: q - t).alias("quota")),
        )).alias("half")).select("half.*")
        node = staged(node, "mix-tree")  # plans stay as small as one level
    return node.select(F.col("node").alias("shard"), F.posexplode("quota").alias("source_no", "n"))


def mix(docs: DataFrame, block_words: int | None = BLOCK_WORDS, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
        max_repeats: float = MAX_REPEATS, blocks_per_shard: int = BLOCKS_PER_SHARD, seed: int = SEED,
        ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes of the documents, targets of the sources, and the mix: one row per block taken, with its shard and its
    position in the shard. ``block_words=None`` takes whole documents."""
    sizes = word_counts(docs)
    plan = staged(targets(sizes, weights, total_share, max_repeats), "mix-targets")
    drawn = drawn_blocks(sizes, plan, block_words, seed)
    counted = drawn.groupBy("source_no").agg(F.count("*").alias("n"))
    # Two numbers come to the driver: how many sources there are, and how many blocks the mix has.
    n_sources, total = plan.count(), drawn.count()
    levels = max(0, math.ceil(math.log2(max(total, 1) / blocks_per_shard)))
    quotas = (plan.select("source_no").join(counted, "source_no", "left").groupBy().agg(F.transform(
        F.array_sort(F.collect_list(F.struct("source_no", F.coalesce("n", F.lit(0).cast("long")).alias("n")))),
        lambda s: s["n"]).alias("quota")))
    leaves = split_quotas(quotas, max(n_sources, 1), levels, seed)
    sources_before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    width = F.greatest(F.expr(f"n_source div {1 << levels}"), F.lit(1).cast("long"))
    ranges = (leaves.where("n > 0").withColumn("start", F.coalesce(F.sum("n").over(sources_before), F.lit(0).cast("long")))
              .withColumn("n_source", F.sum("n").over(Window.partitionBy("source_no"))).withColumn("width", width)
              .select("source_no", "shard", "start", (F.col("start") + F.col("n")).alias("end"), "width", F.explode(F.sequence(
                  F.expr("start div width"), F.expr("(start + n - 1) div width"))).alias("chunk")))
    # Draws keep their rank among those taken: full epochs and the start of the last one leave no gaps.
    widths = counted.select("source_no", F.greatest(F.expr(f"n div {1 << levels}"), F.lit(1).cast("long")).alias("own_width"))
    placed = (drawn.join(widths, "source_no").withColumn("chunk", F.expr("rank div own_width"))
              .join(ranges.drop("width"), ["source_no", "chunk"])
              .where("rank >= start AND rank < end"))
    local = Window.partitionBy("shard").orderBy(
        unit(seed, F.lit(-1), F.col("doc_id"), F.col("text_key"), F.col("block"), F.col("epoch")), "row", "block", "epoch")
    blocks = placed.select("row", "doc_id", "text_key", "source_no", "block", "first_word", "words", "epoch", "shard",
                           (F.row_number().over(local) - 1).alias("position"))
    return sizes, plan, blocks


def taken_rows(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as a mix of whole documents takes them.

    Rows meet their draws by a hash of key and text; of repeated rows each gets the draws of one of them."""
    key = F.xxhash64("doc_id", "text_key").alias("mix_key")
    copies = (blocks.groupBy("row", key).agg(F.count("*").cast("int").alias("copies"))
              .groupBy("mix_key").agg(F.sort_array(F.collect_list("copies"), asc=False).alias("copies")))
    nth = F.row_number().over(Window.partitionBy("mix_key").orderBy(F.lit(1)))
    return (docs.withColumn("mix_key", F.xxhash64("doc_id", F.xxhash64("text"))).join(copies, "mix_key")
            .withColumn("copies", F.coalesce(F.get("copies", nth - 1), F.lit(0)))
            .withColumn("copies", F.explode(F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies")))))
            .select(docs.columns))
