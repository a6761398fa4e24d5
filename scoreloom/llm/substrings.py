"""Hashes of any substrings of some bytes, by polynomial prefix sums modulo 2^64."""

import numpy as np

ROOT = 0x2545F4914F6CDD1D
BYTE = np.random.default_rng(9).integers(0, 2**64, 256, np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ROOT and of its inverse modulo 2^64."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        both = []
        for base in (ROOT, pow(ROOT, -1, 2**64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[size] = (both[0], both[1])
    return _powers[size]


class Hasher:
    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE[data] * up[:len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])
