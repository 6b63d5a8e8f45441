"""Packed numbers that chunks of documents send to ranges of keys, and the answers that come back.

A chunk of documents sends every key once, as one binary row per range. A range sees a key at most once per chunk,
whatever number of documents share it, and answers each row with as many values, in the same order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

SCHEMA = "chunk long, part long, kind int, data binary"


def mail(chunk: list[int] | int, rows: list[tuple[int, bytes]], kind: int) -> pa.Table:
    chunks = chunk if isinstance(chunk, list) else [chunk] * len(rows)
    return pa.table({
        "chunk": pa.array(chunks, pa.int64()), "part": pa.array([r for r, _ in rows], pa.int64()),
        "kind": pa.array([kind] * len(rows), pa.int32()), "data": pa.array([d for _, d in rows], pa.binary())})


def answers(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    """Answers of one kind by range."""
    return sorted((part, data) for part, own, data in zip(
        table.column("part").to_pylist(), table.column("kind").to_pylist(), table.column("data").to_pylist()) if own == kind)


def range_cuts(ordered: np.ndarray, n_ranges: int) -> np.ndarray:
    """Where the keys of each of ``n_ranges`` equal ranges of 64-bit numbers begin, and the end."""
    edges = np.array([(i << 64) // n_ranges for i in range(n_ranges)], dtype=np.uint64)
    return np.append(np.searchsorted(ordered, edges), len(ordered))


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays with their types and lengths, compressed byte plane by byte plane."""
    head = [len(arrays)]
    body = []
    for a in arrays:
        head += [a.itemsize, len(a)]
        body.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(np.array(head, np.int64).tobytes() + b"".join(body))


def unsqueezed(data: bytes) -> list[np.ndarray]:
    """The arrays again, as unsigned numbers of their size."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8).reshape(n, 2)
    at, out = 8 + 16 * n, []
    for size, length in head.tolist():
        planes = np.frombuffer(raw, np.uint8, size * length, at).reshape(size, length)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{size}").reshape(length))
        at += size * length
    return out


def steps(ordered: np.ndarray) -> np.ndarray:
    """First value and differences of unsigned numbers."""
    return np.diff(ordered, prepend=np.zeros(1, ordered.dtype))
