"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a bigram model over words and an end token, smoothed towards word frequencies:
``P(w | v) = b(v, w) + a(v) P(w)`` with ``b = c(v, w) / (c(v) + PRIOR)``, ``a = PRIOR / (c(v) + PRIOR)`` and
``P(w) = (c(w) + 1) / (N + V + 1)``. The start of a text is a context of its own.

A trie holds the contexts of a shard, monotone pointers to the ranges of their successors, the successors, and their
quantised probabilities ``b``. Pointers and successors are Elias-Fano sequences: a successor is stored relative to
its context, on top of the last successor of the context before, so the whole level is monotone, and a look-up finds it
there by the position of its high bits. All levels lie in one flat buffer that can be memory-mapped as it is.

Documents are grouped in chunks by a hash of the key and shuffled once. Chunks send their distinct words to ranges,
which answer with corpus counts and numbers; then their distinct pairs of words to shards, which sum the training counts,
build the trie and answer with the probabilities found in it. So a word or pair costs each chunk one entry however
frequent it is. A context with more than ``HOT`` tokens is spread over several shards by the successor.

Edge cases: a null, empty or blank text has only its end token; a null key counts as its own chunk key; rows are scored
one by one, so repeated rows count as often as they occur; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.chunk_mail import SCHEMA, answers, mail, range_cuts, squeezed, steps, unsqueezed
from flowlens.llm.worker_cache import clear

PRIOR = 1000.0
HOT = 1 << 18
CHUNK_DOCS = 1024
LEAST_SHARDS = 64
#: Probabilities are kept on a scale of 65 535 equal steps of log10 from -16 to 0; 0 stands for an unseen pair.
LEVELS, LOWEST = 65535, -16.0
_END = np.uint64(xxhash.xxh3_64_intdigest(b" end"))  # no word holds a space
_START = np.uint64((1 << 64) - 1)


class EliasFano:
    """A monotone sequence: low bits in whole bytes, high bits in unary, with counts per 64 bits for selection."""

    def __init__(self, size: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.size, self.high, self.ones = size, high, ones
        self.planes = low.reshape(-1, size) if size else low.reshape(0, 0)
        self.low_bits = 8 * len(self.planes)

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        planes = -(-max(0, ((top + 1) // max(n, 1)).bit_length() - 1) // 8)
        low = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :planes].T)
        at = (values >> np.uint64(8 * planes)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(int(at[-1]) + 2 if n else 1) // 64) * 64, np.uint8)
        bits[at] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.append(0, np.cumsum(np.bitwise_count(high))).astype(np.int64)
        return EliasFano(n, low.ravel(), high, ones)

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th one or zero in the high bits."""
        before = self.ones if ones else np.arange(len(self.ones)) * 64 - self.ones
        word = np.searchsorted(before, k, side="right") - 1
        rest = (k - before[word]).astype(np.uint64)
        bits = self.high[np.minimum(word, len(self.high) - 1)]
        bits = bits if ones else ~bits
        at = np.zeros(len(k), np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            w = np.uint64(width)
            here = np.bitwise_count((bits >> at) & np.uint64((1 << width) - 1)).astype(np.uint64)
            beyond = rest >= here
            rest = np.where(beyond, rest - here, rest)
            at = np.where(beyond, at + w, at)
        return word * 64 + at.astype(np.int64)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for j, plane in enumerate(self.planes):
            out |= plane[i].astype(np.uint64) << np.uint64(8 * j)
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        i = i.astype(np.int64)
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._lows(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of each value, or -1."""
        out = np.full(len(values), -1, np.int64)
        if not self.size:
            return out
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        zeros = len(self.high) * 64 - int(self.ones[-1])
        inside = high < zeros
        at = np.zeros(len(values), np.int64)
        later = inside & (high > 0)
        at[later] = self._select(high[later] - 1, False) + 1 - high[later]
        end = np.zeros(len(values), np.int64)
        end[inside] = self._select(high[inside], False) - high[inside]
        # Binary search by the low bits among the positions with these high bits.
        low = values & np.uint64((1 << self.low_bits) - 1)
        stop, open_ = end.copy(), np.flatnonzero(inside & (at < end))
        while len(open_):
            middle = (at[open_] + end[open_]) >> 1
            less = self._lows(middle) < low[open_]
            at[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
            open_ = open_[at[open_] < end[open_]]
        there = np.flatnonzero(inside & (at < stop))
        hit = there[self._lows(at[there]) == low[there]]
        out[hit] = at[hit]
        return out

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.size], np.int64), self.planes.ravel(), self.high, self.ones]

    @staticmethod
    def from_arrays(size: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> EliasFano:
        return EliasFano(int(size[0]), low, high, ones)


_TYPES = [np.uint64, np.uint64, np.int64, np.uint8, np.uint64, np.int64, np.int64, np.uint8, np.uint64, np.int64, np.uint16]


class Trie:
    """Two levels: contexts and successors, over a buffer of arrays that are read in place."""

    def __init__(self, buffer: bytes | np.ndarray):
        self.buffer = np.frombuffer(buffer, np.uint8) if isinstance(buffer, bytes) else buffer
        sizes = self.buffer[:8 * len(_TYPES)].view(np.int64)
        parts, at = [], 8 * len(_TYPES)
        for kind, size in zip(_TYPES, sizes.tolist()):
            parts.append(self.buffer[at:at + size].view(kind))
            at += -(-size // 8) * 8
        self.contexts, self.words = parts[:2]
        self.pointers, self.successors = EliasFano.from_arrays(*parts[2:6]), EliasFano.from_arrays(*parts[6:10])
        self.codes = parts[10]

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, share: np.ndarray) -> Trie:
        """From pairs sorted by context and word, and their probabilities."""
        contexts, begin = np.unique(context, return_index=True)
        words, relative = np.unique(word, return_inverse=True)
        relative = relative.astype(np.uint64) + np.uint64(1)
        ends = np.append(begin[1:], len(context))
        last = relative[ends - 1] if len(context) else relative
        base = np.append(np.uint64(0), np.cumsum(last)[:-1]).astype(np.uint64) if len(context) else last
        level = relative + np.repeat(base, ends - begin)
        codes = np.clip(np.rint((np.log10(share) - LOWEST) / -LOWEST * (LEVELS - 1)) + 1, 1, LEVELS).astype(np.uint16)
        parts = [contexts, words, *EliasFano.of(np.append(begin, len(context))).arrays(), *EliasFano.of(level).arrays(), codes]
        head = np.array([p.nbytes for p in parts], np.int64).tobytes()
        return Trie(head + b"".join(p.tobytes() + bytes(-p.nbytes % 8) for p in parts))

    @staticmethod
    def open(path: str | Path) -> Trie:
        return Trie(np.memmap(path, np.uint8, mode="r"))

    def save(self, path: str | Path) -> None:
        Path(path).write_bytes(self.buffer.tobytes())

    def look_up(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of pairs; 0 for a pair that is not in the trie."""
        out = np.zeros(len(context), np.uint16)
        if not len(self.codes):
            return out
        row = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        column = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        known = np.flatnonzero((self.contexts[row] == context) & (self.words[column] == word))
        # Pointers, and where each context's stretch of the level starts, are read once for each context asked for.
        asked, place = np.unique(row[known], return_inverse=True)
        begin, end = self.pointers.get(asked).astype(np.int64), self.pointers.get(asked + 1).astype(np.int64)
        base = np.where(begin > 0, self.successors.get(np.maximum(begin - 1, 0)), np.uint64(0))
        at = self.successors.find(base[place] + column[known].astype(np.uint64) + np.uint64(1))
        found = (at >= begin[place]) & (at < end[place])
        out[known[found]] = self.codes[at[found]]
        return out


def shares(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (LOWEST - LOWEST * (codes.astype(float) - 1) / (LEVELS - 1)), 0.0)


class Chunk:
    """Tokens of some documents as numbers of the chunk's sorted distinct words, the end token included."""

    def __init__(self, table: pa.Table):
        clear()
        texts = pc.ascii_lower(table.column("text")).cast(pa.large_string()).combine_chunks()
        held = table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        lists = pc.ascii_split_whitespace(texts)
        words, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
        filled = pc.not_equal(words, "")
        coded = words.filter(filled).dictionary_encode()
        doc = doc.filter(filled).to_numpy()
        self.lengths = np.bincount(doc, minlength=len(held)) + 1
        ends = np.cumsum(self.lengths) - 1
        hashes = np.array([*map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist())] + [int(_END)], np.uint64)
        # Words with one hash are one word from here on.
        self.words, number = np.unique(hashes, return_inverse=True)
        self.token = np.full(self.lengths.sum(), number[-1])
        self.token[np.arange(len(doc)) + doc] = number[coded.indices.to_numpy()]
        self.begin = ends - self.lengths + 1
        self.learned = np.repeat(~held, self.lengths)
        n = len(self.words)
        before = np.append(n, self.token[:-1])
        before[self.begin] = n  # the start of a text
        pair, self.pair = np.unique(before * (n + 1) + self.token, return_inverse=True)
        self.before, self.after = pair // (n + 1), pair % (n + 1)
        self.pair_count = np.bincount(self.pair, weights=self.learned, minlength=len(pair)).astype(np.uint32)
        self.word_count = np.bincount(self.token, weights=self.learned, minlength=n).astype(np.uint64)
        self.docs_learned = int((~held).sum())

    def word_mail(self, n_ranges: int) -> list[tuple[int, bytes]]:
        cuts = range_cuts(self.words, n_ranges)
        return [(r, squeezed(self.words[a:b], self.word_count[a:b])) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]

    def hear_words(self, table: pa.Table) -> None:
        """Corpus counts and numbers of the chunk's words; ``totals`` go with every answer."""
        parts = [(part, *unsqueezed(data)) for part, data in answers(table, 1)]
        self.count = np.concatenate([p[1] for p in parts]).astype(np.int64)
        self.ids = np.concatenate([p[2].astype(np.uint64) | np.uint64(p[0] << 32) for p in parts])
        self.n, self.v, self.docs = (pc.max(table.column(c)).as_py() for c in ("n", "v", "docs"))
        if len(self.count) != len(self.words):
            raise RuntimeError("answers do not match what the chunk sent")

    def pair_mail(self, n_shards: int) -> list[tuple[int, bytes]]:
        ids, counts = np.append(self.ids, _START), np.append(self.count, self.docs)
        context, word = ids[self.before], self.ids[self.after]
        # A hot context has several shards, chosen by the successor.
        spread = (counts[self.before] // HOT + 1).astype(np.uint64)
        shard = (_mixed(context + _mixed(word) % spread) % np.uint64(n_shards)).astype(np.int64)
        self.order = np.lexsort((word, context, shard))
        shard, context, word = shard[self.order], context[self.order], word[self.order]
        total, count = counts[self.before][self.order], self.pair_count[self.order]
        cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
        return [(int(shard[a]), squeezed(steps(context[a:b]), steps(word[a:b]), count[a:b], total[a:b].astype(np.uint64)))
                for a, b in zip(cuts[:-1], cuts[1:])]

    def scored(self, table: pa.Table, prior: float) -> dict[str, np.ndarray]:
        found = np.concatenate([unsqueezed(data)[0] for _, data in answers(table, 2)])
        codes = np.empty(len(found), np.uint16)
        codes[self.order] = found
        plain = (self.count + 1) / (self.n + self.v + 1)
        of_context = np.append(self.count, self.docs)[self.before]
        log_pair = np.log10(shares(codes) + prior / (of_context + prior) * plain[self.after])
        return {
            "n_tokens": self.lengths, "n_known": np.add.reduceat((self.count > 0)[self.token].astype(np.int64), self.begin),
            "train_tokens": np.full(len(self.lengths), self.n),
            "base_score": np.add.reduceat(np.log10(plain)[self.token], self.begin),
            "score": np.add.reduceat(log_pair[self.pair], self.begin)}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _count_words(table: pa.Table) -> pa.Table:
    """Answers of a word range, and one row (chunk -1) with its tokens, distinct words and documents."""
    rows = [unsqueezed(d) for d in table.column("data").to_pylist()]
    sizes = np.cumsum([len(r[0]) for r in rows])
    words, number = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
    counts = np.bincount(number, weights=np.concatenate([r[1] for r in rows]).astype(float), minlength=len(words)).astype(np.int64)
    part = table.column("part")[0].as_py()
    out = [(part, squeezed(counts[own], own.astype(np.uint32))) for own in np.split(number, sizes[:-1])]
    done = mail([*table.column("chunk").to_pylist(), -1], [*out, (part, b"")], 1)
    summary = {"n": counts.sum(), "v": (counts > 0).sum(), "docs": counts[words == _END].sum()}
    for name, total in summary.items():
        done = done.append_column(name, pa.array([None] * len(out) + [int(total)], pa.int64()))
    return done


def _shard(prior: float):
    def look_up(table: pa.Table) -> pa.Table:
        """Sum the counts of a shard's pairs, build its trie, and look up every pair sent."""
        rows = [unsqueezed(d) for d in table.column("data").to_pylist()]
        context, word = (np.concatenate([np.cumsum(r[i], dtype=np.uint64) for r in rows]) for i in (0, 1))
        count, total = (np.concatenate([r[i] for r in rows]).astype(np.int64) for i in (2, 3))
        order = np.lexsort((word, context))
        c, w = context[order], word[order]
        new = np.append(True, (c[1:] != c[:-1]) | (w[1:] != w[:-1]))
        pair = np.empty(len(order), np.int64)
        pair[order] = np.cumsum(new) - 1
        c, w, total = c[new], w[new], total[order][new]
        summed = np.add.reduceat(count[order], np.flatnonzero(new))
        seen = summed > 0
        trie = Trie.build(c[seen], w[seen], summed[seen] / (total[seen] + prior))
        codes = trie.look_up(c, w)[pair]  # every pair that was sent, learned from or not, once
        ends = np.cumsum([len(r[0]) for r in rows])
        parts = [(p, squeezed(own)) for p, own in zip(table.column("part").to_pylist(), np.split(codes, ends[:-1]))]
        return mail(table.column("chunk").to_pylist(), parts, 2)

    return look_up


COUNTED = SCHEMA + ", n long, v long, docs long"
SCORED = "key long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", prior: float = PRIOR,
          chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """Learn from the rows that are not held out and score all rows. Per row: key, ``held_out`` and the scores."""
    n_chunks = max(1, -(-docs.count() // chunk_docs))
    n_shards = max(LEAST_SHARDS, n_chunks // 4)
    keyed = docs.select(F.pmod(F.xxhash64(key, text), F.lit(n_chunks)).alias("chunk"), F.col(key).cast("long").alias("key"),
                        held_out.alias("held_out"), F.col(text).alias("text"))

    def send_words(of: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return mail(of[0].as_py(), Chunk(table).word_mail(n_shards), 0)

    def send_pairs(of: tuple[pa.Scalar, ...], table: pa.Table, heard: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        chunk.hear_words(heard)
        return mail(of[0].as_py(), chunk.pair_mail(n_shards), 1)

    def scored(of: tuple[pa.Scalar, ...], table: pa.Table, heard: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        chunk.hear_words(heard)
        chunk.pair_mail(n_shards)
        return pa.table({"key": table.column("key"), "held_out": table.column("held_out"), **chunk.scored(heard, prior)})

    by_chunk = keyed.groupBy("chunk")
    counted = by_chunk.applyInArrow(send_words, SCHEMA).groupBy("part").applyInArrow(_count_words, COUNTED)
    # One row: tokens, distinct words and documents learned from.
    totals = counted.where("chunk < 0").agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("docs").alias("docs"))
    heard = counted.where("chunk >= 0").drop("n", "v", "docs").crossJoin(F.broadcast(totals))
    found = (by_chunk.cogroup(heard.groupBy("chunk")).applyInArrow(send_pairs, SCHEMA)
             .groupBy("part").applyInArrow(_shard(prior), SCHEMA))
    both = heard.unionByName(found, allowMissingColumns=True)
    return by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(scored, SCORED).withColumnRenamed("key", key)
