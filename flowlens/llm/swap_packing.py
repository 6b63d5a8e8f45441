"""Best-fit packing of token sequences with a local search of swaps.

Documents are tokenised and cut in pieces of at most ``CAPACITY`` tokens, of which only the last of a document is shorter. Pieces
are packed in shards of ``SHARD`` pieces, spread by a hash: largest first, each into the fullest sequence that still takes
it. Then the emptiest sequences are emptied: a piece moves to another sequence, or changes place with a smaller
one, or two pieces with one, or one with two, whenever the sum of the squared fills grows; the fuller sequence gets fuller each
time, so the search ends, and a sequence without pieces is gone.

What a shard cannot fill goes on: the emptiest eighth of its sequences (one at least) is packed again, in shards of the same
size over all that is left, until one shard holds it all. Every round has an eighth of the rows of the last one, so no task and no
round grows beyond its shard, and the waste of the shards is undone.

Edge cases. Null and empty texts have the end token only. Rows with equal or null ids are documents of their own. Equal texts
are packed one by one; ties of fill go to the oldest sequence, ties of length to the smallest piece number, so a rerun over the
same written pieces gives the same packing. Long texts are encoded word by word, and a word without white space as a whole by
the library. Other columns are ignored. A table without rows has no pieces.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from flowlens.llm.arrow_runs import whole_groups
from flowlens.llm.worker_cache import kept
from flowlens.session import staged

CAPACITY, END_ID = 4096, 1
SHARD = 4_000
#: Bytes of words that a worker remembers, and the longest of these words.
REMEMBERED, LONGEST = 160 << 20, 48
#: Bytes that Python takes for an entry besides its contents, and marks that may follow a word.
ENTRY, MARKS = 190, ".,;:!?"


class Words(dict):
    """Ids of words, little-endian, from the library for those not seen yet.

    When the memory is half full it becomes the old one; words found there are taken over, the others go with the next turn."""

    def __init__(self, raw: bytes):
        super().__init__()
        self.library = Tokenizer.from_buffer(raw)
        self.merges = self.library.model
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = str.maketrans({c: as_bytes(c)[0][0] for c in map(chr, range(128, 256)) if c.isalpha()})
        self.bytes, self.old = 0, {"": b""}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            # Letters and the marks after them are apart in the library, too, and case is dropped there.
            letters = word.rstrip(MARKS)
            if letters.isalpha() and (letters.isascii() or max(letters) <= "ÿ"):
                lower = letters.lower()
                if lower != word:
                    ids = self[lower] + (self[word[len(letters):]] if len(letters) < len(word) else b"")
                else:  # one run of letters that no rule changes: straight to the merges
                    ids = array("I", [t.id for t in self.merges.tokenize(word.translate(self.letters))]).tobytes()
            else:
                ids = array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()
        if len(word) <= LONGEST:
            self.bytes += len(ids) + len(word) + ENTRY
            if self.bytes > REMEMBERED // 2:
                self.old = dict(self)
                self.clear()
                self.bytes = 0
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a text, with the end id. White space separates words in the library, too, and is dropped there."""
        if text:
            for blank in "\n\t\r\v\f":
                if blank in text:
                    text = text.replace(blank, " ")
        return b"".join(map(self.__getitem__, (text or "").split(" "))) + END_ID.to_bytes(4, "little")


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) of all documents, written; ``row`` is a number of its own for each."""
    with open(tokenizer_path, "rb") as file:
        raw = file.read()  # some MB, read on the driver and sent with the tasks

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept(("words", zlib.crc32(raw)), lambda: Words(raw))
        for batch in batches:
            ids, numbers = batch.column("doc_id"), ([], [], [], [], [])
            for i, text in enumerate(batch.column("text")):
                packed = words.encode(text.as_py())
                for k, at in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[at:at + 4 * capacity]
                    for values, value in zip(numbers, (i, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        values.append(value)
            rows = pa.array(numbers[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(rows), pa.array(numbers[1], pa.int32()), *(pa.array(v, pa.int64()) for v in numbers[2:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    return staged(made.withColumn("row", F.monotonically_increasing_id()), "pieces")


class Bins:
    """Sequences of one shard: the pieces of each, by number, and those with room, by fill."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.held: list[list[int]] = []
        self.fill: list[int] = []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms: list[int] = []  # rooms that some sequence has, in order

    def _enter(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        if not self.by_room[room]:
            insort(self.rooms, room)
        insort(self.by_room[room], b)

    def _leave(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        self.by_room[room].remove(b)
        if not self.by_room[room]:
            del self.rooms[bisect_left(self.rooms, room)]

    def best_fit(self) -> None:
        for i in sorted(range(len(self.sizes)), key=lambda i: (-self.sizes[i], i)):
            size = self.sizes[i]
            at = bisect_left(self.rooms, size)
            if at < len(self.rooms):
                b = self.by_room[self.rooms[at]][0]
                self._leave(b)
                self.held[b].append(i)
                self.fill[b] += size
            else:
                b = len(self.held)
                self.held.append([i])
                self.fill.append(size)
            if self.fill[b] < self.capacity:  # a full sequence is done with
                self._enter(b)

    def exchange(self, a: int, out: list[int], b: int, back: list[int]) -> None:
        """``out`` goes from ``a`` to ``b``, ``back`` the other way."""
        gain = sum(self.sizes[i] for i in out) - sum(self.sizes[i] for i in back)
        for one, less, more, change in ((a, out, back, -gain), (b, back, out, gain)):
            if self.fill[one] < self.capacity:
                self._leave(one)
            self.held[one] = [i for i in self.held[one] if i not in less] + more
            self.fill[one] += change
            if 0 < self.fill[one] < self.capacity:
                self._enter(one)

    def _moved(self, a: int) -> bool:
        """A piece of ``a`` goes to the fullest other sequence that takes it, if that one is then fuller than ``a`` was."""
        for i in sorted(self.held[a], key=lambda i: -self.sizes[i]):
            for at in range(bisect_left(self.rooms, self.sizes[i]), len(self.rooms)):
                b = next((b for b in self.by_room[self.rooms[at]] if b != a), None)
                if b is not None:
                    if self.fill[b] + self.sizes[i] > self.fill[a]:
                        self.exchange(a, [i], b, [])
                        return True
                    break
        return False

    def _swapped(self, a: int) -> bool:
        """Pieces of ``a`` change place with smaller ones of a sequence that is not emptier, so that it gets fuller."""
        sizes = self.sizes
        own = sorted(self.held[a], key=lambda i: sizes[i])
        single = [sizes[i] for i in own]
        pairs = sorted((sizes[i] + sizes[j], i, j) for k, i in enumerate(own) for j in own[:k]) if len(own) <= 64 else []
        double = [p[0] for p in pairs]
        for room in self.rooms:
            for b in self.by_room[room]:
                if b == a or self.fill[b] < self.fill[a]:
                    continue
                best, change = 0, None
                theirs = self.held[b]
                backs = [(sizes[i], [i]) for i in theirs]
                for size, back in backs:
                    for have, items in ((single, own), (double, pairs)):
                        at = bisect_right(have, size + room) - 1
                        if at >= 0 and have[at] - size > best:
                            best = have[at] - size
                            change = ([items[at]] if have is single else list(items[at][1:]), back)
                    if best == room:
                        break
                if best < room and len(theirs) <= 64:
                    for k, i in enumerate(theirs):
                        for j in theirs[:k]:
                            size = sizes[i] + sizes[j]
                            at = bisect_right(single, size + room) - 1
                            if at >= 0 and single[at] - size > best:
                                best, change = single[at] - size, ([own[at]], [i, j])
                if change is not None:
                    self.exchange(a, change[0], b, change[1])
                    return True
        return False

    def search(self) -> int:
        """Empty what can be emptied, the emptiest sequence first; the number of exchanges. Nothing is left to do when there
        are no more sequences than the tokens need."""
        done = 0
        stuck: set[int] = set()
        least = -(-sum(self.sizes) // self.capacity)
        while sum(map(bool, self.held)) > least:
            open_ = [b for room in reversed(self.rooms) for b in self.by_room[room] if b not in stuck]
            if not open_:
                break
            a = open_[0]
            before = done
            while self.held[a] and (self._moved(a) or self._swapped(a)):
                done += 1
            if not self.held[a]:
                stuck.clear()  # what is freed may be of use to another one
            elif done == before:
                stuck.add(a)
        return done


def pack(sizes: list[int], capacity: int = CAPACITY) -> Bins:
    bins = Bins(sizes, capacity)
    bins.best_fit()
    bins.search()
    return bins


def _packed(capacity: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in whole_groups(batches, ["shard"]):
            shard, rows, sizes = (table.column(c).to_numpy() for c in ("shard", "row", "length"))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                bins = pack(sizes[a:b].tolist(), capacity)
                used = sorted((x for x in range(len(bins.held)) if bins.held[x]), key=lambda x: (bins.fill[x], x))
                open_ = set() if last else {x for x in used[:max(1, len(used) // 8)] if bins.fill[x] < capacity}
                at, number, offset = [], [], []
                for x in used:
                    place = 0
                    for i in sorted(bins.held[x]):
                        at.append(a + i)
                        number.append(-1 if x in open_ else x)
                        offset.append(place)
                        place += int(sizes[a + i])
                at = np.array(at, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[at]), pa.array(sizes[at]), pa.array(shard[at]), pa.array(number, pa.int64()),
                     pa.array(offset, pa.int64())], ["row", "length", "shard", "number", "offset"])
    return run


def sequences(cut: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """(row, sequence_id, offset) for every piece of (row, length)."""
    left, found, first = cut.where(F.col("length") < capacity).select("row", "length"), [], 0
    n = left.count()
    while True:
        shards = max(1, -(-n // shard))
        dealt = left.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(len(found))), F.lit(shards)))
        dealt = dealt.repartition("shard").sortWithinPartitions("shard", "row")
        packed = staged(dealt.mapInArrow(_packed(capacity, shards == 1), "row long, length long, shard long, number long, offset long"),
                        "packed")
        # A shard has no more sequences than pieces; hashing may give it some more than planned.
        wide = packed.where("number >= 0").withColumn("sequence_id", (first + F.col("shard")) * (1 << 24) + F.col("number"))
        found.append(wide.select("row", "sequence_id", "offset"))
        first += shards
        left = packed.where("number < 0").select("row", "length")
        if shards == 1:
            break
        n = left.count()
        if not n:
            break
    full = cut.where(F.col("length") >= capacity)
    out = full.select("row", (F.col("row") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for part in found:
        out = out.unionByName(part)
    return out


def packed_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    cut = pieces(docs, tokenizer_path, capacity)
    return cut.join(sequences(cut, capacity, shard), "row").drop("row")
