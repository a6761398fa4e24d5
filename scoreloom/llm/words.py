"""Words of texts as 64-bit hashes: ASCII lower case, split at ASCII white space."""

from collections.abc import Sequence

import numpy as np

from scoreloom.llm.substrings import Hasher, mix

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words of some texts: hashes, byte places in `data`, and counts by text."""

    def __init__(self, texts: Sequence[bytes]):
        self.data = b"\n".join([t.lower() for t in texts]) + b"\n"
        data = np.frombuffer(self.data, np.uint8)
        space = SPACE[data]
        before = np.empty_like(space)
        before[0], before[1:] = True, space[:-1]
        self.start = np.flatnonzero(before & ~space)
        self.end = np.flatnonzero(space & ~before)
        self.hashes = Hasher(data)(self.start, self.end)
        lasts = np.cumsum([len(t) + 1 for t in texts]) if len(texts) else np.zeros(0, np.int64)
        self.counts = np.diff(np.searchsorted(self.start, lasts, "left"), prepend=0)

    def __getitem__(self, k: int) -> bytes:
        return self.data[self.start[k]:self.end[k]]


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words end to end, and each text's number of words."""
    words = Words(texts)
    return words.hashes, words.counts


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the `size` words from each word on; the last ones run over the end and are of no use."""
    total = hashes.copy()
    for k in range(1, size):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total[:max(len(hashes) - k, 0)] += hashes[k:]
    return mix(total)
