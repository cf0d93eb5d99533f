"""Words of many texts at once, as 64-bit numbers, with numpy over whole Arrow batches.

A word is a run of bytes other than space and ``\\x09-\\x0D``; A-Z are lower-cased.  The number of a word is a polynomial in its
bytes modulo 2^64, mixed with its length, so it does not depend on where the word stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
BATCH_BYTES = 1 << 21
BASE = 0x9E3779B97F4A7C15 | 1
MASK64 = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^0 ... BASE^n modulo 2^64, and the same of its inverse."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        n = max(n, SEGMENT)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            out = np.full(n + 1, base & MASK64, dtype=np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"], _powers["down"]


def word_numbers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, starts and ends of the words in bytes that end with a space."""
    numbers, starts, ends = [], [], []
    at = 0
    while at < len(data):
        stop = min(at + SEGMENT, len(data))
        if stop < len(data):
            gaps = np.flatnonzero(SPACE[data[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:  # one word longer than a segment
                while stop < len(data) and not SPACE[data[stop - 1]]:
                    rest = np.flatnonzero(SPACE[data[stop:stop + SEGMENT]])
                    stop = stop + int(rest[0]) + 1 if len(rest) else min(stop + SEGMENT, len(data))
        part = LOWER[data[at:stop]]
        space = SPACE[part]
        edge = np.diff(space.view(np.int8), prepend=np.int8(1), append=np.int8(1))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = powers(len(part))
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=total[1:])
        number = (total[end] - total[start]) * down[start]
        numbers.append(mix(number + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
        starts.append(start + at)
        ends.append(end + at)
        at = stop
    if not numbers:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    return np.concatenate(numbers), np.concatenate(starts), np.concatenate(ends)


def text_parts(ids: pa.Array, texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and UTF-8 texts (null: empty) of a batch, in parts of about ``most`` bytes."""
    some_ids, some, size = [], [], 0
    for key, text in zip(ids.to_pylist(), texts.cast(pa.binary()), strict=True):
        raw = text.as_py() or b""
        some_ids.append(key)
        some.append(raw)
        size += len(raw)
        if size >= most:
            yield some_ids, some
            some_ids, some, size = [], [], 0
    if some:
        yield some_ids, some


class Words:
    """The words of several texts: ``numbers``, byte ``starts`` and ``ends`` in ``data``, and per text its first word
    (``first[i]`` to ``first[i + 1]``)."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        self.numbers, self.starts, self.ends = word_numbers(self.data)
        self.first = np.searchsorted(self.starts, self.offsets)

    def shingles(self, width: int) -> np.ndarray:
        """A number for each run of ``width`` words (of the whole batch; the caller cuts at the texts' ends)."""
        n = len(self.numbers) - width + 1
        return shingle_numbers(self.numbers, width) if n > 0 else np.zeros(0, dtype=np.uint64)


def shingle_numbers(numbers: np.ndarray, width: int) -> np.ndarray:
    """A number for each run of ``width`` words."""
    n = len(numbers) - width + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + numbers[i:i + n]
    return mix(out)
