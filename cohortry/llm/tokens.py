"""Words of whole texts as 64-bit hashes, with numpy over many documents at once.  Runs inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

ODD = np.uint64(0x9E3779B97F4A7C15)
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def spans_hash(values: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """A hash of each ``values[begin:end]`` that does not depend on where the span lies."""
    up = powers(base, len(values))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up, dtype=np.uint64, out=total[1:])
    down = powers(pow(base, -1, 1 << 64), len(values) + 1)
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * ODD)


def chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch of about a megabyte of text, at least one row each; NULL counts as empty."""
    texts = [(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column(column)]
    first, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > CHUNK_BYTES:
            yield batch.slice(first, i - first), texts[first:i]
            first, held = i, 0
        held += len(t)
    if len(texts) > first:
        yield batch.slice(first), texts[first:]


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin (one entry more).

    Words are the runs between space and U+0009 to U+000D; ``lower`` folds A to Z.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    word = np.concatenate(([False], ~gap, [False]))
    begin = np.flatnonzero(word[1:-1] & ~word[:-2])
    end = np.flatnonzero(word[1:-1] & ~word[2:]) + 1
    table = mix(np.arange(1, 257, dtype=np.uint64) * ODD)
    hashes = spans_hash(table[data], begin, end, 0xD1342543DE82EF95)
    edges = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return hashes, np.searchsorted(begin, edges)


def windows_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words of one text."""
    at = np.arange(max(0, len(hashes) - n + 1))
    return spans_hash(hashes, at, at + n, 0xA0761D6478BD642F)
