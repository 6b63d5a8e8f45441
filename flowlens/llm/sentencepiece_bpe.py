"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

A sequence of pieces is what greedy merging of a text yields exactly when every two neighbours are: merging
their joined characters again gives the same two pieces. So a text is encoded from left to right. An
Aho-Corasick automaton gives the longest piece at each position; a piece that does not go with its left
neighbour is shortened to the next shorter piece with the same start, and when none is left the neighbour is
taken back and the position marked in a bitfield, so that no position fails twice. Characters without a piece
become byte pieces, and nothing merges across them.

Supported are models of type BPE with identity normalisation and without user-defined or unused pieces; any
other model raises ``ValueError``.

Edge cases: a null or empty text has no pieces and decodes to an empty text; no piece is added at the begin or
end; U+2581 in a text is the library's white space mark and decodes to a space, as the library does it.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from sentencepiece import sentencepiece_model_pb2

from flowlens.llm.arrow_runs import slices
from flowlens.llm.worker_cache import kept, tidy

SPACE = "▁"
#: Bytes of chunks and of pair checks that a worker remembers, the longest chunk, and what an entry takes besides its contents.
REMEMBERED, LONGEST, ENTRY = 48 << 20, 48, 190
#: Bytes of text that are encoded and decoded before they are handed on.
SLICE = 2 << 20
#: Groups of characters that chunks are split by.
GROUPS = 8
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class Model:
    """Vocabulary with the memory of pair checks and of chunks seen, one for each worker."""

    def __init__(self, raw: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(raw)
        norm = proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces \
                or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix \
                or not proto.trainer_spec.byte_fallback or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with identity normalisation, byte pieces and no own symbols are supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        letters = {c for piece in self.ids for c in piece}
        if letters - self.ids.keys() or len(self.byte_ids) != 256 or any(
                SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("the vocabulary lacks single characters, or has pieces with inner white space")
        self.letters = letters
        # Nothing merges across a line end without a piece, from a word into following white space, nor from one group of
        # characters to another if no piece holds characters of both.
        ends = "" if "\n" in letters else "\n"
        groups = ["".join(map(re.escape, group)) for group in _groups(self.ids)]
        runs = "|".join([*(f"[{group}]+" for group in groups), f"[^{SPACE}{ends}{''.join(groups)}]+"])
        self.chunks = re.compile(f"{SPACE}*(?:{runs})|{SPACE}+" + (f"|{ends}+" if ends else "")).findall
        self.pairs: dict[int, bool] = {}
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.seen_bytes = 0
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == [piece]:  # else merging never makes it
                self.automaton.add_word(piece, (len(piece) - 1, i))
        self.automaton.make_automaton()
        self.sizes = [len(piece) for piece in self.pieces]
        # Of each piece the longest proper start that is a piece of the automaton; -1 if there is none.
        self.shorter = [next((self.ids[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.automaton), -1)
                        if piece in self.ids else -1 for piece in self.pieces]
        # Text of each id, with the white space mark resolved; byte pieces are resolved in runs, controls are silent.
        self.text = ["" if p.type == CONTROL else proto.trainer_spec.unk_surface if p.type == UNKNOWN
                     else p.piece.replace(SPACE, " ") for p in proto.pieces]
        self.is_byte = np.array([p.type == BYTE for p in proto.pieces])

    def merged(self, text: str) -> list[str]:
        """Greedy merging of a few characters: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.scores[k] > best):
                    best, at = self.scores[k], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the characters of both pieces again gives these two pieces."""
        if len(self.pairs) * ENTRY > REMEMBERED:
            self.pairs.clear()
        a, b = self.pieces[left], self.pieces[right]
        known = self.pairs[left << 20 | right] = self.merged(a + b) == [a, b]
        return known

    def backtracked(self, text: str) -> list[int]:
        """Piece ids of a text all of whose characters have a piece."""
        longest = [0] * len(text)
        for end, (before, i) in self.automaton.iter(text):
            longest[end - before] = i  # of matches with one start, the longest ends last
        sizes, pairs, fits, shorter = self.sizes, self.pairs.get, self.fits, self.shorter
        failed = bytearray()  # made when the first position fails
        out: list[int] = []
        at, last, piece, length = 0, -1, longest[0], len(text)
        while True:
            end = at + sizes[piece]
            if not failed or not failed[end >> 3] >> (end & 7) & 1:
                fit = last < 0 or pairs(last << 20 | piece)
                if fit is None:
                    fit = fits(last, piece)
                if fit:
                    out.append(piece)
                    if end == length:
                        return out
                    at, last, piece = end, piece, longest[end]
                    continue
            piece = shorter[piece]
            while piece < 0:  # no piece is left here: take the left neighbour back
                failed = failed or bytearray(length // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= sizes[last]
                piece = shorter[out.pop()]
                last = out[-1] if out else -1

    def chunk(self, text: str) -> bytes:
        """Ids of a chunk as packed 32-bit numbers. Of two memories the older one is let go when the newer one is full; what is
        asked for again moves to the newer one."""
        if text in self.seen:
            return self.seen[text]
        packed = self.older.get(text)
        if packed is None:
            ids = array("i")
            for known, part in _by(text, self.letters):
                if known:
                    ids.extend(self.backtracked(part))
                else:
                    ids.extend(self.byte_ids[b] for b in part.encode())
            packed = ids.tobytes()
        if len(text) <= LONGEST:
            if 2 * self.seen_bytes > REMEMBERED:
                self.older, self.seen = self.seen, {}
                self.seen_bytes = 0
            self.seen_bytes += ENTRY + 2 * len(text) + len(packed)
            self.seen[text] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        seen, chunk = self.seen.get, self.chunk
        return b"".join([seen(c) or chunk(c) for c in self.chunks(self.prefix + text.replace(" ", SPACE))])

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        marks = self.is_byte[ids]
        if not marks.any():
            out = "".join(map(self.text.__getitem__, ids.tolist()))
        else:
            # Neighbouring bytes are decoded together.
            cuts = np.flatnonzero(np.diff(marks)) + 1
            parts = []
            for group in np.split(ids, cuts):
                if self.is_byte[group[0]]:
                    parts.append(bytes(map(self.bytes_of.__getitem__, group.tolist())).decode(errors="replace"))
                else:
                    parts.append("".join(map(self.text.__getitem__, group.tolist())))
            out = "".join(parts)
        return out[1:] if self.prefix and self.pieces[ids[0]].startswith(SPACE) else out


def _groups(pieces: Iterable[str]) -> list[list[str]]:
    """The ``GROUPS`` largest groups of characters, where neighbours in a piece are of one group; the white space mark has none."""
    beside: dict[str, set[str]] = {}
    for piece in pieces:
        own = piece.lstrip(SPACE)
        for a, b in zip(own, own[1:]):
            beside.setdefault(a, set()).add(b)
            beside.setdefault(b, set()).add(a)
    groups, free = [], set(beside)
    while free:
        group, edge = set(), {free.pop()}
        while edge:
            group |= edge
            edge = set().union(*(beside[c] for c in edge)) - group
        free -= group
        groups.append(sorted(group))
    return sorted(groups, key=lambda g: (-len(g), g))[:GROUPS]


def _by(text: str, letters: set[str]) -> list[tuple[bool, str]]:
    """Stretches of characters that have a piece and of those that have none."""
    if letters.issuperset(text):
        return [(True, text)]
    out: list[tuple[bool, str]] = []
    begin = 0
    for i in range(1, len(text) + 1):
        if i == len(text) or (text[i] in letters) != (text[begin] in letters):
            out.append((text[begin] in letters, text[begin:i]))
            begin = i
    return out


def model(raw: bytes) -> Model:
    return kept(("pieces", hashlib.sha1(raw).hexdigest()), lambda: Model(raw))


def _read(model_path: str) -> bytes:
    """The model file (bounded, some hundred KB) is read on the driver and travels with the tasks."""
    with open(model_path, "rb") as file:
        raw = file.read()
    model(raw)
    return raw


def _lists(packed: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int64).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32), pa.int32()))


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a column of piece ids (array of int) for every whole text."""
    raw = _read(model_path)

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        own = model(raw)
        return _lists([own.encode(t.as_py()) for t in texts])

    return df.withColumn(ids, encoded(F.col(text)))


def decode(df: DataFrame, model_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for; a null list decodes to an empty text."""
    raw = _read(model_path)

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        own = model(raw)
        values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        return pa.array([own.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string())

    return df.withColumn(decoded, texts(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def round_trip(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` with one pass of the rows through Python. Texts are worked on and handed back in slices of
    ``SLICE`` bytes, so a worker holds ids and decoded texts of a slice (or of one longer text) beside its input."""
    raw = _read(model_path)
    carried = [f for f in df.schema if f.name not in (ids, decoded)]
    names = [f.name for f in carried]
    of = names.index(text)
    schema = StructType([*carried, StructField(ids, ArrayType(IntegerType())), StructField(decoded, StringType())])

    @tidy
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(raw)
        for batch in batches:
            for part in slices(batch, of, SLICE):
                packed = [own.encode(t.as_py()) for t in part.column(of)]
                back = pa.array((own.decode(np.frombuffer(p, dtype=np.int32)) for p in packed), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(packed), back], [*names, ids, decoded])

    return df.select(*names).mapInArrow(both, schema)
