"""Language identification of mixed-language texts.

Every word gets a score per language: the log-probability of its letter n-grams in that language. The script of
a word, from ranges of code points, first narrows the languages to those that use the script. Over the words of
a text, a Viterbi path with a penalty for each change of language labels spans; the language with most words
wins, and its share of the words is the score.

The n-gram counts are learned from a sample of labelled rows, of ``sample_docs`` rows on average, drawn by a
hash of the key. They go into ``BUCKETS`` hashed buckets a language, so the model is as large for any input. All rows
and whole texts are labelled.

Edge cases: a null text, and a text without letters, is ``und`` with score 0 and no spans; so is every text when
there are no labelled rows. Rows with a null text or language are not learned from. Of languages with equally
many words the first by code point wins. Rows are labelled one by one, so copies get the same label; other columns stay.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from flowlens.llm.arrow_runs import slices
from flowlens.llm.worker_cache import clear, kept, tidy

#: A power of two, at most 2 ** 16.
BUCKETS = 1 << 15
SAMPLE_DOCS = 16_000
SWITCH_PENALTY = 9.0
#: A language uses a script when it has at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Words that a worker remembers.
REMEMBERED = 300_000
#: New words whose n-grams are hashed at once.
HASHED_WORDS = 1 << 15
#: Words labelled at once.
BLOCK_WORDS = 1_000_000
#: Bytes of text that are labelled before they are handed on.
SLICE = 6 << 20
UNKNOWN = "und"

# First code points of Unicode ranges and the script from there on.
SCRIPT_RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x30000, "other"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})
_STARTS = [start for start, _ in SCRIPT_RANGES]
_SCRIPT_OF = [SCRIPTS.index(name) for _, name in SCRIPT_RANGES]


def letters_of(word: str) -> str:
    return word.lower() if word.isalpha() else "".join(filter(str.isalpha, word)).lower()


@cache
def _tables() -> tuple[list[np.ndarray], list[int], np.ndarray]:
    """For every code point what it adds to the CRC-32 of an n-gram when 0 to 3 code points follow, and its script; for every
    n the CRC-32 of n zeros. A CRC of a fixed length is the exclusive or of what its bytes add; buckets are its low bits."""
    points, zeros, adds = np.arange(0x110000), [zlib.crc32(bytes(4 * n)) % BUCKETS for n in range(5)], []
    for after in range(4):
        own = np.zeros(len(points), np.uint16)
        for byte in range(3):
            of_value = [zlib.crc32(bytes(byte) + bytes([v]) + bytes(3 - byte + 4 * after)) % BUCKETS ^ zeros[after + 1]
                        for v in range(256)]
            own ^= np.array(of_value, np.uint16)[points >> 8 * byte & 255]
        adds.append(own)
    return adds, zeros, np.array(_SCRIPT_OF, np.uint8)[np.searchsorted(_STARTS, points, side="right") - 1]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words of letters: buckets of their n-grams of two to four letters, with marks at both ends, three for each letter
    and shorter ones first; where each word's buckets begin; and the script of most of its letters."""
    adds, zeros, script = _tables()
    marked = np.frombuffer(f"_{'__'.join(words)}_".encode("utf-32-le"), np.uint32)
    size = np.array([len(w) for w in words])
    begins, first = 3 * (np.cumsum(size) - size), np.cumsum(size + 2) - size - 2
    added = [own[marked] for own in adds]
    buckets = np.empty(3 * size.sum(), np.intp)
    for n, shorter in ((2, 0), (3, size + 1), (4, 2 * size + 1)):
        many = size + 3 - n
        before, run = np.cumsum(many) - many, np.arange(many.sum())
        at = run + np.repeat(first - before, many)
        found = added[n - 1][at] ^ zeros[n]
        for i in range(1, n):
            found ^= added[n - 1 - i][at + i]
        buckets[run + np.repeat(begins + shorter - before, many)] = found
    letters = np.bincount(np.repeat(np.arange(len(words)) * len(SCRIPTS), size + 2) + script[marked],
                          minlength=len(words) * len(SCRIPTS)).reshape(-1, len(SCRIPTS))
    letters[:, SCRIPTS.index("latin")] -= 2  # the marks
    return buckets, begins, letters.argmax(1)


@tidy
def _counts(batches):
    """Dense counts per language of a task's rows: buckets, then scripts."""
    clear()
    words: dict[str, Counter] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            words.setdefault(lang, Counter()).update(text.split())
    for lang, seen in words.items():
        own = np.zeros(BUCKETS + len(SCRIPTS), np.int64)
        pairs = iter(seen.items())
        while some := list(islice(pairs, HASHED_WORDS)):
            if not (lettered := [(letters, n) for word, n in some if (letters := letters_of(word))]):
                continue
            buckets, _, scripts = features([letters for letters, _ in lettered])
            size, times = np.array([(len(letters), n) for letters, n in lettered]).T
            # Sums of whole numbers below 2 ** 53 are exact in doubles.
            own[:BUCKETS] += np.bincount(buckets, np.repeat(times, 3 * size), BUCKETS).astype(np.int64)
            own[BUCKETS:] += np.bincount(scripts, times * size, len(SCRIPTS)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"lang": [lang], "counts": [own.tobytes()]})


def _summed(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"lang": [key[0]], "counts": [sum(np.frombuffer(c, np.int64) for c in rows["counts"]).tobytes()]})


class Model:
    """Log-probabilities per bucket and language, and which scripts a language uses."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        own = counts[:, :BUCKETS].astype(float)
        self.logp = np.log((own + 0.5) / (own.sum(1, keepdims=True) + 0.5 * BUCKETS)).T.astype(np.float32)
        scripts = counts[:, BUCKETS:].astype(float)
        self.uses = (scripts / np.maximum(scripts.sum(1, keepdims=True), 1) >= SCRIPT_SHARE).T
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1, len(langs)), np.float32)

    def scores(self, words: list[str]) -> np.ndarray:
        """Row number of every word in ``self.rows``; 0 is a word without letters."""
        if len(self.index) > REMEMBERED:
            self.index, self.rows = {}, self.rows[:1]
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        at, parts = len(self.rows), [self.rows]
        for begin in range(0, len(new), HASHED_WORDS):
            lettered = []
            for word in new[begin:begin + HASHED_WORDS]:
                if letters := letters_of(word):
                    self.index[word] = at + len(lettered)
                    lettered.append(letters)
                else:
                    self.index[word] = 0
            if lettered:
                buckets, begins, scripts = features(lettered)
                rows = np.add.reduceat(self.logp[buckets], begins, axis=0)
                allowed = self.uses[scripts]
                rows[~allowed & allowed.any(1, keepdims=True)] = -1e6
                parts.append(rows - rows.max(1, keepdims=True))
                at += len(lettered)
        if len(parts) > 1:
            self.rows = np.concatenate(parts)
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Language number of each word. ``scores`` holds the words of all texts one after another; the texts
    advance together, one word a step, longest first."""
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    long = lengths[order]
    active = np.searchsorted(-long, -np.arange(1, long[0] + 1), side="right") if len(long) else np.zeros(0, int)
    own = np.arange(scores.shape[1], dtype=np.int8)
    came = np.zeros(scores.shape, np.int8)
    best = np.zeros((len(long), scores.shape[1]), np.float32)
    for step, n in enumerate(active):
        at, now = begin[:n] + step, best[:n]
        top = now.argmax(1)
        switched = now[np.arange(n), top] - penalty
        stay = now >= switched[:, None]
        came[at] = np.where(stay, own, top[:, None].astype(np.int8))
        best[:n] = np.where(stay, now, switched[:, None]) + scores[at]
    labels = np.zeros(len(scores), np.int8)
    state = best.argmax(1).astype(np.int8)
    for step in range(len(active) - 1, -1, -1):
        n = active[step]
        at = begin[:n] + step
        labels[at] = state[:n]
        state[:n] = came[at, state[:n]]
    return labels


LABELLED = "struct<lang:string,score:double,spans:array<struct<first:int,last:int,lang:string>>>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))


def label_texts(model: Model, texts: Iterable[str | None], penalty: float) -> tuple[list, list, list]:
    langs, shares, spans = [], [], []
    block: list[np.ndarray] = []  # numbers of words
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__

    def flush():
        lengths = np.array([len(w) for w in block], dtype=np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *block])
        rows = model.scores(list(number))[flat] if model.langs else np.zeros(len(flat), np.int64)
        labels = viterbi(model.rows[rows], lengths, penalty) if model.langs else rows
        for end, n in zip(np.cumsum(lengths), lengths):
            own, has = labels[end - n:end], rows[end - n:end] > 0
            if not has.any():
                langs.append(UNKNOWN), shares.append(0.0), spans.append([])
                continue
            votes = np.bincount(own[has], minlength=len(model.langs))
            winner = int(votes.argmax())
            langs.append(model.langs[winner]), shares.append(float(votes[winner] / votes.sum()))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [n]])
            spans.append([{"first": int(a), "last": int(b) - 1, "lang": model.langs[own[a]]}
                          for a, b in zip(cuts[:-1], cuts[1:])])
        block.clear(), number.clear()

    words = 0
    for text in texts:
        own = text.split() if text else []
        block.append(np.fromiter(map(number.__getitem__, own), np.int32, len(own)))
        words += len(block[-1])
        if words >= BLOCK_WORDS:
            flush()
            words = 0
    flush()
    return langs, shares, spans


def fit(labelled: DataFrame, key: Column, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """Counts learned from ``text`` and ``lang`` of a sample by the hash of ``key``; one row per language comes back."""
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    rows = labelled.where("lang IS NOT NULL").count()
    share = min(1.0, sample_docs / max(rows, 1))
    if share < 1:
        usable = usable.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = (usable.select("text", "lang").mapInArrow(_counts, "lang string, counts binary")
           .groupBy("lang").applyInPandas(_summed, "lang string, counts binary").collect())
    got.sort(key=lambda r: r["lang"])
    counts = [np.frombuffer(r["counts"], np.int64) for r in got]
    return [r["lang"] for r in got], np.array(counts).reshape(len(got), BUCKETS + len(SCRIPTS))


def label(df: DataFrame, fitted: tuple[list[str], np.ndarray], text: str = "text", out: str = "language",
          penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``df`` with a struct of language, score and labelled word spans for every whole text."""
    langs, counts = fitted
    stamp = zlib.crc32(counts.tobytes() + repr(langs).encode())
    shipped = df.sparkSession.sparkContext.broadcast((langs, counts))  # languages x (BUCKETS + scripts) numbers
    carried = [f for f in df.schema if f.name != out]
    columns = [f.name for f in carried]
    of = columns.index(text)

    @tidy
    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(("languages", stamp), lambda: Model(*shipped.value))
        for batch in batches:
            for part in slices(batch, of, SLICE):  # so that a worker holds words and spans of a slice
                names, shares, spans = label_texts(model, (t.as_py() for t in part.column(of)), penalty)
                found = pa.StructArray.from_arrays(
                    [pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, _SPANS)],
                    names=["lang", "score", "spans"])
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*columns, out])

    schema = StructType([*carried, StructField(out, DataType.fromDDL(LABELLED))])
    return df.select(*columns).mapInArrow(labelled, schema)
