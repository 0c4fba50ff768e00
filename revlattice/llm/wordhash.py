"""Words of many texts at once: boundaries and 64-bit hashes by prefix sums over the bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEGMENT = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)


class _Powers:
    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < size:
            for name, base in (("up", BASE), ("down", _INVERSE)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up, cls.down


def mixed_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Hashed:
    """Prefix sums of a byte array, from which any range's hash follows."""

    def __init__(self, data: np.ndarray):
        up, self.down = _Powers.of(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each range's bytes that does not depend on its place."""
        return mixed_bits((self.sums[ends] - self.sums[starts]) * self.down[starts])


def words(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of bytes with ``inside`` (a table of 256 booleans)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside[data], [False]))))
    return edges[::2], edges[1::2]


def segments(texts: list[bytes], size: int = SEGMENT) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """The texts in joined pieces of about ``size`` bytes: bytes, text numbers, and where each text begins in the piece.

    Texts are followed by a line break each. A longer text is cut at line breaks or blanks, so that memory does not
    follow the longest text; a single word is never cut.
    """
    parts, numbers, starts, total = [], [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while True:
            end = len(text)
            if end - at > size:
                cut = max(text.rfind(b"\n", at, at + size), text.rfind(b" ", at, at + size))
                if cut <= at:
                    later = [x for x in (text.find(b"\n", at + size), text.find(b" ", at + size)) if x > 0]
                    cut = min(later, default=end)
                end = cut
            parts.append(text[at:end])
            numbers.append(i)
            starts.append(total)
            total += end - at + 1
            if total >= size:
                yield b"\n".join(parts) + b"\n", np.array(numbers), np.array(starts)
                parts, numbers, starts, total = [], [], [], 0
            at = end
            if at >= len(text):
                break
    if parts:
        yield b"\n".join(parts) + b"\n", np.array(numbers), np.array(starts)
