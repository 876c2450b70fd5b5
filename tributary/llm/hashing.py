"""64-bit word hashes of whole texts, computed from prefix sums over bytes."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class Powers:
    """Powers of an odd multiplier and of its inverse modulo 2^64, as far as they were needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 2 ** 64)
        self.up, self.down = np.ones(1, U64), np.ones(1, U64)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << max(16, n.bit_length())
            for name, step in (("up", self.base), ("down", self.inverse)):
                factors = np.full(n, step, U64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up, self.down


_POWERS = Powers(0x9E3779B97F4A7C15)


def word_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and hashes of the words; A-Z count as lower case.

    A word's hash comes from the difference of two prefix sums of byte * power, shifted back by the
    inverse power, so all words of a text are hashed at once (``span_hashes``).
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, ends, np.empty(0, U64)
    return starts, ends, span_hashes(_LOWER[data], starts, ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of some bytes."""
    with np.errstate(over="ignore"):
        up, down = _POWERS.reach(len(data) + 1)
        sums = np.concatenate((np.zeros(1, U64), np.cumsum((data.astype(U64) + U64(1)) * up[:len(data)])))
        return mixed((sums[ends] - sums[starts]) * down[starts]
                     + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))
