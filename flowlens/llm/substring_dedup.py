"""Removal of long repeated passages by recompression.

A text is a sequence of words. In rounds, runs of equal symbols and then pairs of neighbours become one symbol. A
symbol's name is a hash of what it stands for, and which symbols pair up is decided by their names, so all tasks give
equal passages the same names without a shared dictionary. With each symbol goes the stretch of words that its making
looked at; wherever that stretch occurs, the symbol occurs.

1. Names of symbols whose stretch fits into a window are dealt into ranges; names in more than one document are shared.
2. A window can only repeat if every such symbol in it is shared. Windows that pass, and those that hold no such symbol,
   are compared by a 96-bit hash of their words with the smallest document that has the window.
3. Words covered by a window that a smaller document has are removed.

Documents are grouped in chunks by a hash of the key and shuffled once; names and windows travel as packed numbers, sent
once per chunk however often they occur in it, and the answers are bits in the same order. So a passage that a third of
all documents share costs each chunk one entry, and no group holds more than a range of names.

Edge cases: null, empty and blank texts have no words; texts shorter than a window keep all words; a null key counts as
the largest; rows with equal keys do not remove each other's words, as neither key is smaller. Passages repeated
within one document stay. Other columns are ignored, unless they are asked to be carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.chunk_mail import SCHEMA, answers, mail, range_cuts
from flowlens.llm.worker_cache import clear, tidy_group

WINDOW = 50
ROUNDS = 5
CHUNK_DOCS = 512
LEAST_RANGES = 64

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASES = (0x5851F42D4C957F2D, 0xD1342543DE82EF95)
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Chunk:
    """Words of some documents, one after another, as numbers."""

    def __init__(self, keys: pa.ChunkedArray, texts: pa.ChunkedArray):
        self.keys = keys.combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        lists = pc.ascii_split_whitespace(texts.combine_chunks().cast(pa.large_string()))
        words, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
        filled = pc.not_equal(words, "")
        self.words = words.filter(filled)
        self.doc = doc.filter(filled).to_numpy()
        lengths = np.bincount(self.doc, minlength=len(self.keys))
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        numbered = self.words.dictionary_encode()
        digests = np.frombuffer(b"".join(
            [xxhash.xxh3_128_digest(w) for w in numbered.dictionary.to_pylist()]), "<u8").reshape(-1, 2)
        numbers = numbered.indices.to_numpy()
        self.low, self.high = digests[numbers, 0], digests[numbers, 1]

    def symbols(self, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Names, documents, and the stretches [from, to) of words that decided them, in text order."""
        name, doc = self.low, self.doc
        at = np.arange(len(name))
        frm, to = at, at + 1
        if not len(name):
            return name, doc, frm, to
        for round_ in range(rounds):
            # Runs. Their ends are known from the neighbours; what lies outside a document is never known.
            new = np.concatenate([[True], (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])])
            first = np.flatnonzero(new)
            last = np.concatenate([first[1:], [len(name)]]) - 1
            length = (last - first + 1).astype(np.uint64)
            left_in = np.concatenate([[False], doc[first[1:]] == doc[first[1:] - 1]])
            right_in = np.concatenate([doc[last[:-1]] == doc[last[:-1] + 1], [False]])
            outer_from = np.where(left_in, frm[np.maximum(first - 1, 0)], self.begins[doc[first]] - 1)
            outer_to = np.where(right_in, to[np.minimum(last + 1, len(name) - 1)], self.ends[doc[first]] + 1)
            name = np.where(length > 1, mixed(name[first] * _ODD + length), name[first])
            doc, frm, to = doc[first], outer_from, outer_to
            # Pairs of a left and a right symbol.
            salt = np.uint64((round_ + 1) * int(_ODD) & _MASK)
            right = (mixed(name + salt) >> np.uint64(63)).astype(bool)
            pair = np.zeros(len(name), bool)
            same = doc[1:] == doc[:-1]
            pair[:-1] = ~right[:-1] & right[1:] & same
            second = np.concatenate([[False], pair[:-1]])
            follows = np.concatenate([same, [False]])
            led = np.concatenate([[False], same])
            next_to = np.concatenate([to[1:], to[-1:]])
            prior_from = np.concatenate([frm[:1], frm[:-1]])
            next_name = np.concatenate([name[1:], name[-1:]])
            new_to = np.where(pair, next_to, np.where(~right, np.where(follows, next_to, self.ends[doc] + 1), to))
            new_from = np.where(right & ~second, np.where(led, prior_from, self.begins[doc] - 1), frm)
            name = np.where(pair, mixed(mixed(name) * _ODD + next_name), name)
            keep = ~second
            name, doc, frm, to = name[keep], doc[keep], new_from[keep], new_to[keep]
        return name, doc, frm, to

    def window_starts(self, window: int) -> np.ndarray:
        fits = np.arange(len(self.doc)) + window <= self.ends[self.doc] if len(self.doc) else np.zeros(0, bool)
        return np.flatnonzero(fits)

    def window_keys(self, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 bits of the words in each window."""
        out = []
        for numbers, base in zip((self.low, self.high), _BASES):
            total = np.zeros(len(starts), np.uint64)
            for j in range(window):
                total = total * np.uint64(base) + numbers[starts + j]
            out.append(mixed(total))
        return out[0], (out[1] >> np.uint64(32)).astype(np.uint32)


class Work:
    """The three passes over a chunk; each builds on the answers to the one before."""

    def __init__(self, table: pa.Table, window: int, rounds: int, n_ranges: int):
        clear()
        self.chunk = Chunk(table.column("key"), table.column("text"))
        self.window, self.n_ranges = window, n_ranges
        name, doc, frm, to = self.chunk.symbols(rounds)
        self.all_frm, self.all_to, self.all_name = frm, to, name
        self.fits = to - frm <= window
        names, docs = name[self.fits], doc[self.fits]
        order = np.lexsort((docs, names))
        names, docs = names[order], docs[order]
        new = np.append(True, names[1:] != names[:-1]) if len(names) else np.zeros(0, bool)
        self.names = names[new]
        # A name in two documents of the chunk is shared whatever the others have.
        number = np.cumsum(new) - 1
        self.local = np.zeros(len(self.names), bool)
        self.local[number[1:][(~new[1:]) & (docs[1:] != docs[:-1])]] = True

    def name_rows(self):
        cuts = range_cuts(self.names, self.n_ranges)
        return [(r, self.names[a:b].tobytes()) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]

    def candidates(self, bits: np.ndarray) -> None:
        """Windows all of whose symbols are shared, with their keys sorted and the smallest document of each."""
        shared = self.local | bits
        known = np.ones(len(self.all_name), bool)
        known[self.fits] = shared[np.searchsorted(self.names, self.all_name[self.fits])]
        unshared = np.append(0, np.cumsum(~known))
        starts = self.chunk.window_starts(self.window)
        low = np.searchsorted(self.all_frm, starts)
        high = np.searchsorted(self.all_to, starts + self.window, side="right")
        self.starts = starts[(high <= low) | (unshared[np.maximum(high, low)] == unshared[low])]
        first, second = self.chunk.window_keys(self.starts, self.window)
        keys = self.chunk.keys[self.chunk.doc[self.starts]] if len(self.starts) else np.zeros(0, np.int64)
        order = np.lexsort((keys, second, first))
        first, second = first[order], second[order]
        new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])) if len(first) else np.zeros(0, bool)
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.own_keys, self.first, self.second, self.smallest = keys, first[new], second[new], keys[order][new]

    def window_rows(self):
        cuts = range_cuts(self.first, self.n_ranges)
        return [(r, self.first[a:b].tobytes() + self.second[a:b].tobytes() + self.smallest[a:b].tobytes())
                for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]

    def kept(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Words, removed words and kept text of each document. ``bits``: a smaller document elsewhere has the window."""
        chunk, n = self.chunk, len(self.chunk.doc)
        hit = self.starts
        if len(hit):
            hit = hit[bits[self.number] | (self.own_keys > self.smallest[self.number])]
        depth = np.cumsum(np.bincount(hit, minlength=n + 1)[:n] - np.bincount(hit + self.window, minlength=n + 1)[:n])
        stay = depth == 0
        total = chunk.ends - chunk.begins
        left = np.bincount(chunk.doc[stay], minlength=len(chunk.keys))
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(left))), chunk.words.filter(pa.array(stay)))
        return total, total - left, pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def _bits(heard: pa.Table, kind: int, n: int) -> np.ndarray:
    """Answers of all ranges in order, as one flag per number sent."""
    flags = [np.frombuffer(data, bool) for _, data in answers(heard, kind)]
    out = np.concatenate(flags) if flags else np.zeros(0, bool)
    if len(out) != n:
        raise RuntimeError("answers do not match what the chunk sent")
    return out


@tidy_group
def _shared_names(table: pa.Table) -> pa.Table:
    """Per chunk, a flag for each name of a range: another chunk has it too."""
    blobs = [np.frombuffer(d, np.uint64) for d in table.column("data").to_pylist()]
    names = np.concatenate(blobs)
    order = np.argsort(names, kind="stable")
    ordered = names[order]
    again = ordered[1:] == ordered[:-1]
    flags = np.zeros(len(names), bool)
    flags[order] = np.append(False, again) | np.append(again, False)
    return _answered(table, flags, [len(b) for b in blobs])


@tidy_group
def _earlier_windows(table: pa.Table) -> pa.Table:
    """Per chunk, a flag for each window of a range: another chunk has it in a smaller document."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for data in table.column("data").to_pylist():
        n = len(data) // 20
        parts.append((np.frombuffer(data, np.uint64, n), np.frombuffer(data, np.uint32, n, 8 * n),
                      np.frombuffer(data[12 * n:], np.int64, n)))
    first, second, smallest = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.lexsort((smallest, second, first))
    f, s = first[order], second[order]
    new = np.append(True, (f[1:] != f[:-1]) | (s[1:] != s[:-1]))
    least = smallest[order][new][np.cumsum(new) - 1]
    flags = np.zeros(len(first), bool)
    flags[order] = smallest[order] > least
    return _answered(table, flags, [len(p[0]) for p in parts])


def _answered(table: pa.Table, flags: np.ndarray, lengths: list[int]) -> pa.Table:
    ends = np.cumsum(lengths)
    return table.select(["chunk", "part", "kind"]).append_column(
        "data", pa.array([flags[e - n:e].tobytes() for e, n in zip(ends, lengths)], pa.binary()))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, rounds: int = ROUNDS,
                    chunk_docs: int = CHUNK_DOCS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: key, number of words, number removed, and the kept words joined by a space; then the columns to carry."""
    n_chunks = max(1, -(-docs.count() // chunk_docs))
    n_ranges = max(LEAST_RANGES, n_chunks // 4)
    keyed = docs.select(F.pmod(F.xxhash64(key, text), F.lit(n_chunks)).alias("chunk"), F.col(key).cast("long").alias("key"),
                        F.col(text).alias("text"), *[F.col(c).alias(f"carry_{c}") for c in carry])

    @tidy_group
    def send_names(of: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return mail(of[0].as_py(), Work(table, window, rounds, n_ranges).name_rows(), 0)

    @tidy_group
    def send_windows(of: tuple[pa.Scalar, ...], table: pa.Table, heard: pa.Table) -> pa.Table:
        work = Work(table, window, rounds, n_ranges)
        work.candidates(_bits(heard, 0, len(work.names)))
        return mail(of[0].as_py(), work.window_rows(), 1)

    @tidy_group
    def keep(of: tuple[pa.Scalar, ...], table: pa.Table, heard: pa.Table) -> pa.Table:
        work = Work(table, window, rounds, n_ranges)
        work.candidates(_bits(heard, 0, len(work.names)))
        total, removed, texts = work.kept(_bits(heard, 1, len(work.first)))
        return pa.table({"key": table.column("key"), "n_words": pa.array(total, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()), "kept": texts.cast(pa.string()),
                         **{c: table.column(f"carry_{c}") for c in carry}})

    by_chunk = keyed.groupBy("chunk")
    names = by_chunk.applyInArrow(send_names, SCHEMA)
    shared = names.groupBy("part").applyInArrow(_shared_names, SCHEMA)
    windows = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(send_windows, SCHEMA)
    earlier = windows.groupBy("part").applyInArrow(_earlier_windows, SCHEMA)
    done = by_chunk.cogroup(shared.unionByName(earlier).groupBy("chunk")).applyInArrow(
        keep, ", ".join(["key long, n_words long, n_removed long, kept string",
                         *[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]]))
    return done.withColumnRenamed("key", key)
