"""Order MinHash fingerprints of whole texts.

A text is a sequence of words; its k-mers are runs of ``K`` words, numbered by occurrence, so that repeats count.
Every numbered k-mer has one hash. The hash range is cut into ``VECTORS`` parts, as in one-permutation hashing, and of
each part the ``TUPLE`` smallest k-mers are selected, put back in text order and hashed as a tuple. The tuple hashes
are the signature: moving k-mers changes it although their set stays the same. The likeness of two signatures is the
share of parts with equal tuples among the parts that either one has.

All steps are array functions within a row. Hashes and positions share a number of 63 bits, so arrays of plain
longs are sorted. Occurrence numbers are found for repeated k-mers only, by doubling the reach of a running maximum.

Edge cases: null, empty and blank texts have no k-mers, an empty signature, and likeness 1 with each other and 0
with any other; texts of fewer than ``K`` words are one k-mer. Equal texts have equal signatures wherever they are.
Rows without a key have no next text. Rows with equal keys follow each other by a hash of their text. A single row
follows itself. Columns other than key and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, VECTORS, TUPLE = 2, 64, 2
#: Bits of a hash and of a position; a text below 2 GB has fewer than 2**30 words.
HASH_BITS, POSITION_BITS = 33, 30
SPACE = r"[\x20\x09-\x0D]+"
#: Documents of a bucket of neighbours, and the most buckets.
BUCKET_DOCS, MAX_BUCKETS = 64, 40_000


def packed(hash_: Column, position: Column) -> Column:
    return hash_.bitwiseAND((1 << HASH_BITS) - 1) * F.lit(1 << POSITION_BITS) + position


def hash_in(x: Column) -> Column:
    return F.shiftright(x, POSITION_BITS)


def position_in(x: Column) -> Column:
    return x.bitwiseAND((1 << POSITION_BITS) - 1)


def same_hash(x: Column, other: Column) -> Column:
    return hash_in(x) == hash_in(other)


def longs() -> Column:
    return F.array().cast("array<long>")


def with_signature(df: DataFrame, text: str, out: str, k: int = K, vectors: int = VECTORS, size: int = TUPLE) -> DataFrame:
    """``df`` with a column of tuple hashes (array of long), each with its part of the hash range above 32 bits."""
    bits = vectors.bit_length() - 1
    if 1 << bits != vectors:
        raise ValueError("vectors must be a power of two")

    def part(x: Column) -> Column:
        return F.shiftright(x, POSITION_BITS + HASH_BITS - bits)

    words, kmers, extra, keyed, chosen = (f"__{out}_{step}" for step in ("words", "kmers", "extra", "keyed", "chosen"))
    df = df.withColumn(words, F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), lambda w: w != ""))
    # Sorted by hash, then position: repeats are neighbours in text order.
    df = df.withColumn(kmers, F.when(F.size(words) == 0, longs()).otherwise(F.sort_array(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0))),
        lambda i: packed(F.xxhash64(*[F.get(F.col(words), i + j) for j in range(k)]), i)))))
    df = df.withColumn(extra, F.filter(kmers, lambda x, i: (i > 0) & same_hash(x, F.get(F.col(kmers), i - 1))))
    # Where the run of a repeated k-mer starts among the repeats: the running maximum of starts.
    starts = F.transform(extra, lambda x, j: F.when(
        (j == 0) | ~same_hash(x, F.get(F.col(extra), j - 1)), j).otherwise(F.lit(0)))
    reached = F.aggregate(
        F.sequence(F.lit(0), F.ceil(F.log2(F.size(extra).cast("double"))).cast("int")), starts,
        lambda a, t: F.transform(a, lambda r, j: F.greatest(r, F.get(a, j - F.pow(F.lit(2.0), t).cast("int")))))
    occurrence = F.transform(reached, lambda r, j: (j - r + 1).cast("long"))
    numbered = F.zip_with(F.col(extra), occurrence, lambda x, n: packed(F.xxhash64(hash_in(x), n), position_in(x)))
    firsts = F.filter(kmers, lambda x, i: (i == 0) | ~same_hash(x, F.get(F.col(kmers), i - 1)))
    df = df.withColumn(keyed, F.when(F.size(extra) == 0, F.col(kmers)).otherwise(F.sort_array(F.concat(firsts, numbered))))
    df = df.withColumn(chosen, F.filter(
        keyed, lambda x, i: (i < size) | (part(x) != part(F.get(F.col(keyed), i - size)))))

    def tuple_hash(x: Column, i: Column) -> Column:
        own = F.filter(F.slice(F.col(chosen), i + 1, size), lambda y: part(y) == part(x))
        in_text_order = F.sort_array(F.transform(own, lambda y: position_in(y) * F.lit(1 << HASH_BITS) + hash_in(y)))
        folded = F.aggregate(in_text_order, F.lit(0).cast("long"),
                             lambda a, y: F.xxhash64(a, y.bitwiseAND((1 << HASH_BITS) - 1)))
        return part(x) * F.lit(1 << 32) + folded.bitwiseAND((1 << 32) - 1)

    df = df.withColumn(out, F.array_compact(F.transform(chosen, lambda x, i: F.when(
        (i == 0) | (part(x) != part(F.get(F.col(chosen), i - 1))), tuple_hash(x, i)))))
    return df.drop(words, kmers, extra, keyed, chosen)


def likeness(a: str, b: str) -> Column:
    """Share of parts with equal tuples among the parts that either signature has."""
    def parts(c: str) -> Column:
        return F.transform(c, lambda x: F.shiftright(x, 32))

    either = F.size(F.array_union(parts(a), parts(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_text(signature: str) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lower(F.hex(x))), ".")


def bucketed(docs: DataFrame, key: str, bucket_docs: int) -> tuple[DataFrame, list]:
    """``docs`` with a bucket of neighbours by key, and the first row of every bucket a second time, with ``copy`` 1,
    in the bucket before (that of the very first in the last bucket)."""
    stats = docs.agg(F.count("*").alias("n"), F.min(key).alias("first")).first()
    n_buckets = int(min(MAX_BUCKETS, max(1, stats["n"] // bucket_docs)))
    shares = [i / n_buckets for i in range(1, n_buckets)]
    found = docs.agg(F.percentile_approx(key, shares, 20 * n_buckets).alias("cuts")).first()["cuts"] if shares else None
    cuts = sorted({stats["first"], *(found or [])} - {None})
    # Keys that cut the table, at most MAX_BUCKETS: found by a look at every per-th cut, then at the cuts from there.
    per = max(1, int(len(cuts) ** 0.5))

    def literal(numbers: list) -> Column:
        return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<long>") if numbers else longs()

    group = F.size(F.filter(literal(cuts[per::per]), lambda c: c <= F.col(key)))
    own = F.slice(literal(cuts), F.col("__group") * per + 1, per)
    placed = (docs.withColumn("__group", group)
              .withColumn("bucket", F.col("__group") * per + F.size(F.filter(own, lambda c: c <= F.col(key))) - 1))
    before = F.when(F.col("bucket") == 0, F.lit(max(len(cuts) - 1, 0))).otherwise(F.col("bucket") - 1)
    is_first = F.array_contains(own, F.col(key))
    places = F.when(is_first, F.array(F.struct(F.lit(0).alias("copy"), F.col("bucket")),
                                      F.struct(F.lit(1).alias("copy"), before.alias("bucket"))))
    return placed.withColumn("place", F.explode(F.coalesce(
        places, F.array(F.struct(F.lit(0).alias("copy"), F.col("bucket")))))).drop("bucket", "__group").select(
            "*", "place.copy", "place.bucket").drop("place"), cuts


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_docs: int = BUCKET_DOCS,
                 k: int = K, vectors: int = VECTORS, size: int = TUPLE) -> DataFrame:
    """Key, text length, edited text, and signatures of the text, of its edited text and of the next text.

    The texts are shuffled once: rows are dealt into buckets of neighbours by quantiles of the key, so the next row is in
    the same bucket."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed, _ = bucketed(rows.where("key IS NOT NULL"), "key", bucket_docs)
    lost = rows.where("key IS NULL").withColumns(
        {"copy": F.lit(0), "bucket": (-1 - F.pmod(F.xxhash64("text"), F.lit(1000))).cast("int")})
    dealt = keyed.unionByName(lost).withColumn("tie", F.xxhash64("text"))
    follow = Window.partitionBy("bucket").orderBy("copy", "key", "tie")

    def following(column: str) -> Column:
        return F.when(F.col("key").isNotNull(), F.lead(column).over(follow))

    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = (dealt.withColumn("next", following("text"))
              .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                                             F.substring(F.coalesce("next", F.lit("")), F.lit(1), half)))
              .withColumn("n_chars", n.cast("long")).drop("next"))
    signed = with_signature(with_signature(edited, "text", "signature", k, vectors, size).drop("text"),
                            "edited", "edited_signature", k, vectors, size)
    return signed.withColumn("next_signature", F.coalesce(following("signature"), longs())).where("copy = 0").select(
        F.col("key").alias(key), "n_chars", "edited", "signature", "edited_signature", "next_signature")
