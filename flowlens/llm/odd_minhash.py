"""Near-duplicate documents by MinHash bands and odd sketches.

A document's set holds the distinct runs of ``k`` words. MinHash bands propose pairs; the MinHash samples of a document
are also folded into a bitmap of parities (an odd sketch), and the bits in which two sketches differ estimate the
similarity, so that hopeless pairs go before any text is read. What is left is confirmed on the full sets.

Documents with equal sets are one class from the start. A band's bucket is not paired out: first every class is compared
with the first class of its bucket, and confirmed links are merged into components. Buckets that still hold several
components compare each class with one other class drawn for the bucket. What is then still open, classes that share a
bucket across components, is joined by an exact prefix index over their sets. So no proposed link that changes a component
is missed, while near copies of one text do not meet in pairs.

With 32 bands of 5 rows a pair of similarity 0.8 is proposed with probability 1 - 3e-6, and the sketch drops it with a
probability below 1e-6; more similar pairs do better.

Edge cases: null, empty and blank texts have an empty set and are linked with nothing; a text of fewer than ``k`` words is
one run. Rows without a key are linked with nothing and have no component; a key in several rows with
different texts links what its rows link. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.worker_cache import clear, tidy, tidy_group
from flowlens.session import staged

BANDS, ROWS = 32, 5
#: 64-bit numbers of a sketch.
SKETCH_LONGS = 8
SIMILARITY = 80
#: Estimates below this are not confirmed; six standard deviations of the estimate under 0.8.
LEAST_ESTIMATE = 0.6
SEED = 7
_ODD, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _STEP
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and hashes of the distinct runs of ``k`` words, by document and hash."""
    # Lower-cased first: a slice that is cast keeps offsets that the kernel does not take.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts).cast(pa.large_string()))
    words, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    filled = pc.not_equal(words, "")
    numbered = words.filter(filled).dictionary_encode()
    doc = doc.filter(filled).to_numpy()
    digests = np.array([xxhash.xxh3_64_intdigest(w) for w in numbered.dictionary.to_pylist()], np.uint64)
    word = digests[numbered.indices.to_numpy()] if len(doc) else np.zeros(0, np.uint64)
    lengths = np.bincount(doc, minlength=len(texts))
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(len(doc))  # words from here to the end
    total = mixed(word + _ODD)
    for j in range(1, k):
        there = left > j
        total[there] = mixed(total[there] * _STEP + word[np.flatnonzero(there) + j])
    # A short text is one run from its first word on.
    first = np.repeat(ends - lengths, lengths) == np.arange(len(doc))
    keep = (left >= k) | (first & (np.repeat(lengths, lengths) < k))
    doc, total = doc[keep], total[keep]
    order = np.lexsort((total, doc))
    doc, total = doc[order], total[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (total[1:] != total[:-1])) if len(doc) else np.zeros(0, bool)
    return doc[new], total[new]


class Hashes:
    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(SEED)
        self.bands, self.rows = bands, rows
        self.factor = rng.integers(1, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.shift = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)

    def samples(self, hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Smallest value under every hash function, a row per document."""
        small = (hashes >> np.uint64(32)).astype(np.uint32)
        return np.stack([np.minimum.reduceat(small * f + s, begins) for f, s in zip(self.factor, self.shift)], axis=1)

    def keys(self, samples: np.ndarray) -> np.ndarray:
        """A hash for each band."""
        cells = samples.reshape(len(samples), self.bands, self.rows).astype(np.uint64)
        total = np.broadcast_to(np.arange(self.bands, dtype=np.uint64) * _ODD, cells.shape[:2]).copy()
        for r in range(self.rows):
            total = mixed(total * _STEP + cells[:, :, r])
        return total

    def sketches(self, samples: np.ndarray, longs: int) -> np.ndarray:
        """Parity of the samples that fall on each bit."""
        n, m = samples.shape
        bit = mixed(samples.astype(np.uint64) + np.arange(m, dtype=np.uint64) * _ODD) % np.uint64(64 * longs)
        parity = np.zeros((n, 64 * longs), np.uint8)
        np.bitwise_xor.at(parity, (np.arange(n)[:, None], bit.astype(np.int64)), 1)
        return np.packbits(parity, axis=1, bitorder="little").view(np.uint64)


def _fixed(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]),
                                    pa.array(np.ascontiguousarray(rows).view(np.int64).ravel()))


SIGNED = "key long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"


def signatures(docs: DataFrame, key: str, text: str, k: int, bands: int, rows: int) -> DataFrame:
    """A row per document: size and hash of its set, band hashes and odd sketch (null for an empty set)."""
    @tidy
    def signed(batches):
        clear()
        hashes = Hashes(bands, rows)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                doc, total = shingles(batch.column(1), k)
                sizes = np.bincount(doc, minlength=batch.num_rows)
                begins = (np.cumsum(sizes) - sizes)[sizes > 0]
                found = [np.zeros(batch.num_rows, np.uint64) for _ in range(2)]
                none = pa.array([None] * int((sizes == 0).sum()), pa.list_(pa.int64()))
                order = np.argsort(np.argsort(sizes == 0, kind="stable"), kind="stable")
                lists = [none, none]
                if len(begins):
                    for i, salt in enumerate((_ODD, _STEP)):
                        found[i][sizes > 0] = np.add.reduceat(mixed(total * salt + salt), begins)
                    samples = hashes.samples(total, begins)
                    lists = [pa.concat_arrays([_fixed(x), none])
                             for x in (hashes.keys(samples), hashes.sketches(samples, SKETCH_LONGS))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes.astype(np.int64)), *[pa.array(f.view(np.int64)) for f in found],
                     *[x.take(pa.array(order)) for x in lists]],
                    names=["key", "n_shingles", "set_a", "set_b", "bands", "sketch"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(signed, SIGNED)


def estimate(a: str, b: str, samples: int) -> Column:
    """Similarity from the bits in which two odd sketches differ: -n/2 ln(1 - 2z/n) samples are in one set only."""
    n = 64.0 * SKETCH_LONGS
    z = reduce(lambda x, y: x + y, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SKETCH_LONGS)])
    room = F.greatest(1 - 2 * z / n, F.lit(1e-9))
    return 1 - (-n / 2 * F.log(room)) / (2.0 * samples)


def confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, k: int, similarity: int) -> DataFrame:
    """Pairs ``a < b`` whose full sets are similar enough."""
    pairs = staged(pairs, "near-pairs")
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct().coalesce(8), "near-ids")
    # The ids are a table of known size: Spark sends them to the scan of the texts when they are few, else it shuffles.
    texts = staged(docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(ids, "key", "left_semi"),
                   "near-texts")

    @F.arrow_udf("boolean")
    @tidy_group
    def similar(first: pa.Array, second: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(first), 512):
            sides = [shingles(x.slice(at, 512), k) for x in (first, second)]
            n = len(first.slice(at, 512))
            sizes = [np.bincount(doc, minlength=n) for doc, _ in sides]
            doc, total = (np.concatenate([sides[0][i], sides[1][i]]) for i in (0, 1))
            order = np.lexsort((total, doc))
            doc, total = doc[order], total[order]
            both = np.bincount(doc[1:][(doc[1:] == doc[:-1]) & (total[1:] == total[:-1])], minlength=n)
            out.append((100 * both >= similarity * (sizes[0] + sizes[1] - both)) & (both > 0))
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    return staged(pairs.join(left, "a").join(right, "b").where(similar("text_a", "text_b")).select("a", "b").distinct(), "near-links")


def prefix_pairs(open_: DataFrame, docs: DataFrame, key: str, text: str, k: int, similarity: int) -> DataFrame:
    """Pairs (a, b) of rows of ``open_`` (key, component) from different components that can still be similar enough.

    The runs of a set are put in the order of how many open documents have them, rarest first. Similar sets share a
    run near the start of both, and what follows it must be long enough on both sides. In a group of near copies the start
    holds each copy's own edits, so only copies that share edits meet."""
    def least(n: Column, m: Column) -> Column:
        """Runs that sets of these sizes must share."""
        return F.floor((similarity * (n + m) + 99 + similarity) / (100 + similarity))

    @F.arrow_udf("array<long>")
    @tidy_group
    def runs(texts: pa.Array) -> pa.Array:
        doc, total = shingles(texts, k)
        ends = np.append(0, np.cumsum(np.bincount(doc, minlength=len(texts)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(total.view(np.int64)))

    ids = staged(open_.select("key", "component").distinct().coalesce(8), "near-open-ids")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(ids, "key")
    sets = staged(rows.select("key", "component", runs("text").alias("runs")), "near-sets")
    token = sets.select("key", "component", F.size("runs").alias("n"), F.explode("runs").alias("run"))
    spread = staged(token.groupBy("run").agg(F.count("*").alias("df"), F.min("component").alias("lo"), F.max("component").alias("hi"))
                    .where("df > 1"), "near-runs")
    order = Window.partitionBy("key").orderBy(F.coalesce("df", F.lit(1)), "run")
    start = (token.join(spread, "run", "left").withColumn("at", F.row_number().over(order) - 1)
             .where((F.col("at") <= F.col("n") - F.ceil(F.col("n") * similarity / 100)) & (F.col("lo") < F.col("hi")))
             .select("key", "component", "n", "run", "at"))
    # What is left of a row after the run must do for the smallest partner that the run has.
    start = staged(start, "near-starts")
    for _ in range(2):
        size = start.groupBy("run").agg(F.min("n").alias("small"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        start = (start.join(size.where("lo < hi"), "run")
                 .where(F.col("n") - F.col("at") >= least(F.col("n"), F.greatest("small", F.ceil(F.col("n") * similarity / 100))))
                 .select("key", "component", "n", "run", "at"))
    start = staged(start, "near-starts")
    # The component with most rows of a run is not compared with itself.
    most = start.groupBy("run", "component").agg(F.count("*").alias("rows")).groupBy("run").agg(
        F.max(F.struct("rows", "component"))["component"].alias("main"))
    sides = start.join(most, "run").where("component <> main").select(
        "run", F.col("key").alias("a"), F.col("component").alias("of_a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"))
    bound = least(F.col("n"), F.col("n_a"))
    return (start.join(sides, "run").where(
        (F.col("component") != F.col("of_a")) & (F.col("n") - F.col("at") >= bound) & (F.col("n_a") - F.col("at_a") >= bound))
        .select("a", F.col("key").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """Key and smallest key reachable, for keys with links: large and small stars in turn until nothing changes.
    Each round is a pre-aggregated minimum and a join, so a key with many links is no single task's work."""
    edges, before = staged(links.select("a", "b").distinct(), "near-edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "near-least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = staged(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-large")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "near-least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).where("a <> b")
        edges = staged(small.distinct(), "near-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("key"), F.col("b").alias("component"))
        before = now


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, similarity: int = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS, least_estimate: float = LEAST_ESTIMATE) -> DataFrame:
    """Per row: key, size of its set, and component (smallest key reachable by links)."""
    signed = staged(signatures(docs, key, text, k, bands, rows), "near-signed")
    usable = signed.where("key IS NOT NULL AND n_shingles > 0")
    classes = staged(usable.groupBy("set_a", "set_b").agg(F.min("key").alias("rep")), "near-classes")
    heads = staged(usable.join(classes.select(F.col("rep").alias("key")).distinct(), "key", "left_semi")
                   .dropDuplicates(["key", "set_a", "set_b"]), "near-heads")
    sketches = heads.select("key", "sketch")
    banded = heads.select("key", F.explode("bands").alias("band"))
    firsts = staged(banded.groupBy("band").agg(F.min("key").alias("first"), F.max("key").alias("last"))
                    .where("first < last").select("band", "first"), "near-firsts")
    # Rows of buckets with more than one class.
    mates = staged(banded.join(firsts, "band"), "near-mates")

    def promising(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        left = sketches.select(F.col("key").alias("a"), F.col("sketch").alias("sketch_a"))
        right = sketches.select(F.col("key").alias("b"), F.col("sketch").alias("sketch_b"))
        return (pairs.join(left, "a").join(right, "b")
                .where(estimate("sketch_a", "sketch_b", bands * rows) >= least_estimate).select("a", "b"))

    def check(pairs: DataFrame) -> DataFrame:
        return confirmed(promising(pairs), docs, key, text, k, similarity)

    links = check(mates.where("key > first").select(F.col("first").alias("a"), F.col("key").alias("b")))
    found = components(links)
    for last in (False, True):
        named = mates.join(found, "key", "left").select("band", "key", F.coalesce("component", "key").alias("component"))
        several = named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        open_ = staged(named.join(several.select("band"), "band", "left_semi"), "near-open")
        if last:
            pairs = prefix_pairs(open_, docs, key, text, k, similarity)
        else:
            # One class per bucket, another one in each bucket, so that a class meets several.
            order = F.struct(F.xxhash64("key", "band").alias("order"), "key", "component")
            drawn = staged(open_.groupBy("band").agg(F.min(order).alias("drawn")).select(
                "band", F.col("drawn.key").alias("a"), F.col("drawn.component").alias("of_a")), "near-drawn")
            pairs = open_.join(drawn, "band").where("component <> of_a").select("a", F.col("key").alias("b"))
        more = check(pairs)
        links = links.unionByName(more)
        if more.limit(1).count():
            found = components(links)
    named = classes.join(found.withColumnRenamed("key", "rep"), "rep", "left").select(
        "set_a", "set_b", F.coalesce("component", "rep").alias("component"))
    out = usable.join(staged(named, "near-named"), ["set_a", "set_b"]).select("key", "n_shingles", "component")
    rest = signed.where("key IS NULL OR n_shingles = 0").select("key", "n_shingles", F.col("key").alias("component"))
    return out.unionByName(rest).withColumnRenamed("key", key)
