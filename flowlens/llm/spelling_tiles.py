"""Spelling variants: words at one inserted, deleted or replaced code point from each other, by dense tiles.

Two distinct words whose lengths differ by one at most are a single edit apart exactly when common prefix and common suffix
together reach the longer length less one. A tile compares a block of words with another: two left-aligned matrices of code
points, padded with values that are equal to nothing, give all common prefixes in one comparison, and two right-aligned ones
all suffixes.

Only words that can be near meet in a tile. Let L be the longer length of a pair. The positions 0..L-1 are cut in windows;
the edit falls in one of them, and outside it both words are equal. So a word is sent, for L its own length and one more, to
one bucket a window: the window and a hash of what the word has outside it. A bucket with more than ``BUCKET`` words has its
windows cut in half and its words sent on, and so on; with a window of one position a bucket holds one word for each
letter at most. So no bucket grows with the vocabulary, and no pair is lost. A pair may share several buckets; it counts in
the one whose window has the smallest position at which the edit can be.

Edge cases. Null text has no words; a null id is an empty text in the hash. Words are counted over all rows, repeated ones
included. Long texts are read in one go, and what a task has counted is handed on whenever it has ``HELD`` words.
Ties of the largest count go to the word that is smallest in code point order. Other columns are ignored; an empty table
has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.arrow_runs import whole_groups
from flowlens.session import staged

RUNS = re.compile("[A-Za-zÀ-ÿ]+").findall
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
HELD = 200_000
#: Words of a bucket that is compared as it is, rows of a tile, and bytes of its matrices.
BUCKET, TILE, TILE_BYTES = 2048, 256, 1 << 23


def words_of(doc_id: int | None, text: str, damage: int | None) -> Iterator[tuple[str, int]]:
    """Words of a text and how often they come. With ``damage``, a run whose crc32 with the id is divisible by it loses the
    code point at crc32 % length."""
    found = Counter(RUNS(text.translate(LOWER) if not text.isascii() else text.lower()))
    if damage is None:
        return iter(found.items())
    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode(), begin)
        if h % damage == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return iter(out.items())


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, damage: int | None = None) -> DataFrame:
    """(word, n) of all texts."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def emitted():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                text = text.as_py()
                if text is not None:
                    for word, n in words_of(doc_id.as_py(), text, damage):
                        if len(word) >= least_length:
                            held[word] += n
                if len(held) > HELD:
                    yield emitted()
        yield emitted()

    parts = docs.select("doc_id", "text").mapInArrow(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _outside(window: Column, longer: Column) -> Column:
    """Hash of what a word has outside the window of positions of the longer word."""
    low, high = window["low"], window["high"]
    size = F.length("word")
    return F.xxhash64(F.substring(F.col("word"), F.lit(1), low), F.substring(F.col("word"), size - (longer - high) + 1, longer - high))


def _sent(df: DataFrame, windows: Column) -> DataFrame:
    """(word, n, longer, low, high, outside): one row for each window of ``windows``."""
    spread = df.select("word", "n", "longer", F.explode(windows).alias("w"))
    return spread.select("word", "n", "longer", F.col("w.low").alias("low"), F.col("w.high").alias("high"),
                         _outside(F.col("w"), F.col("longer")).alias("outside"))


def _halves(low: Column, high: Column) -> Column:
    middle = (low + F.ceil((high - low) / 2)).cast("int")
    both = F.array(F.struct(low.alias("low"), middle.alias("high")), F.struct(middle.alias("low"), high.alias("high")))
    return F.filter(both, lambda w: w["low"] < w["high"])


KEY = ["longer", "low", "high", "outside"]


def buckets(words: DataFrame, limit: int = BUCKET) -> DataFrame:
    """(word, n, longer, low, high, outside) of all buckets of two words or more, each of ``limit`` words at most unless its
    window is one position."""
    each = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer"))
    open_ = _sent(each, _halves(F.lit(0), F.col("longer")))
    done: list[DataFrame] = []
    while True:
        # Sizes are counted on the keys; only hot ones, of which there are few, are looked up.
        open_ = staged(open_, "buckets")
        sizes = open_.groupBy(*KEY).agg(F.count(F.lit(1)).alias("size"))
        hot = staged(sizes.where((F.col("size") > limit) & (F.col("high") - F.col("low") > 1)).select(*KEY), "hot-buckets")
        if hot.isEmpty():
            done.append(open_)
            break
        done.append(open_.join(hot, KEY, "left_anti"))
        again = open_.join(hot, KEY, "left_semi")
        open_ = _sent(again, _halves(F.col("low"), F.col("high")))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, aligned left and right, 0 elsewhere."""
    lengths = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    kind = np.uint8 if len(points) and points.max() < 256 else np.uint32
    rows = np.repeat(np.arange(len(words)), lengths)
    columns = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left, right = np.zeros((2, len(words), width), kind)
    left[rows, columns] = points
    right[rows, columns + np.repeat(width - lengths, lengths)] = points
    return left, right


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common begin of every row of ``a`` and ``b``; padding equals nothing."""
    same = a[:, None, :] == b[None, :, :]
    same &= (a != 0)[:, None, :]
    ends = np.argmin(same, axis=2)
    return np.where(same[:, :, 0] & (ends == 0), a.shape[1], ends)


def tile(left, right, lengths, rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
    """(near, position): pairs of a block of rows and one of columns, and the least place of the edit in the longer word."""
    prefix = _common(left[rows], left[columns])
    suffix = _common(right[rows, ::-1], right[columns, ::-1])
    longer = np.maximum(lengths[rows, None], lengths[None, columns])
    shorter = np.minimum(lengths[rows, None], lengths[None, columns])
    near = (prefix + suffix >= longer - 1) & (longer - shorter <= 1) & ~((prefix == longer) & (longer == shorter))
    return near, longer - 1 - suffix


def compare(words: list[str], longer: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(partners, best): for every word of a bucket, sorted by preference, how many others are near with the edit first
    placed in [low, high) of ``longer`` positions, and the first of them (or the number of words)."""
    m, width = len(words), max(map(len, words))
    left, right = matrices(words, width)
    lengths = np.array([len(w) for w in words])
    partners, best = np.zeros(m, np.int64), np.full(m, m)
    step = int(max(1, min(TILE, (TILE_BYTES / (width * left.itemsize)) ** 0.5)))
    for i in range(0, m, step):
        for j in range(i, m, step):
            rows, columns = slice(i, min(i + step, m)), slice(j, min(j + step, m))
            near, at = tile(left, right, lengths, rows, columns)
            pair_longer = np.maximum(lengths[rows, None], lengths[None, columns])
            near &= (at >= low) & (at < high) & (pair_longer == longer)
            if not near.any():
                continue
            for matrix, base, place in ((near, i, j), (near.T, j, i)) if i != j else ((near, i, j),):
                n = matrix.sum(axis=1)
                partners[base:base + len(n)] += n
                first = np.where(n > 0, matrix.argmax(axis=1) + place, m)
                best[base:base + len(n)] = np.minimum(best[base:base + len(n)], first)
    return partners, best


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.string()), ("partners", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])
    for table, cuts in whole_groups(batches, KEY):
        words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        longer, low, high = (table.column(c).to_numpy() for c in ("longer", "low", "high"))
        out: tuple[list, list, list, list] = ([], [], [], [])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a < 2:
                continue
            partners, best = compare(words[a:b], int(longer[a]), int(low[a]), int(high[a]))
            for i in np.flatnonzero(partners).tolist():
                out[0].append(words[a + i])
                out[1].append(int(partners[i]))
                out[2].append(words[a + int(best[i])])
                out[3].append(int(n[a + int(best[i])]))
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)


def neighbours(words: DataFrame, limit: int = BUCKET) -> DataFrame:
    """(word, n_near, best): number of near words of every word that has any, and the one of largest count."""
    sorted_ = buckets(words, limit).repartition(*KEY).sortWithinPartitions(*KEY, F.desc("n"), "word")
    found = sorted_.mapInArrow(_compared, "word string, partners long, form string, form_n long")
    return found.groupBy("word").agg(
        F.sum("partners").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. A form comes at least twice as often as its word, so chains end after a
    logarithm of the counts, and each round halves what is left of them."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = staged(now.join(ahead, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(words: DataFrame, limit: int = BUCKET) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n)."""
    words = staged(words, "vocabulary")
    near = neighbours(words, limit)
    better = -F.col("best.less") >= 2 * F.col("n")
    known = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(better, F.col("best.form")).alias("form"),
        F.when(better, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
