"""Merging front-coded sorted runs with a loser tree that never compares a known common prefix again.

A run lists its strings in order, each as the length of the prefix it shares with the one before and the rest.  Every contender
carries the length it shares with the string that left the tree last.  Of two contenders the one that shares more is the
smaller; only at equal lengths are bytes compared, from there on.
"""

from collections.abc import Iterator

import numpy as np


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix, given that the first `known` bytes agree."""
    most = min(len(a), len(b))
    low, high = known, most
    while low < high:  # bytes before low agree; a difference lies at high or before it
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def front_code(strings: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Shared lengths and rests of sorted strings."""
    before, lengths, rests = b"", [], []
    for s in strings:
        n = shared_prefix(before, s, 0)
        lengths.append(n)
        rests.append(s[n:])
        before = s
    return np.array(lengths, np.int32), b"".join(rests)


def merge(runs: list[tuple[np.ndarray, bytes]], width: int) -> Iterator[tuple[int, int]]:
    """(length shared with the string before, run) for all strings of all runs in order; every string is `width` long.

    Equal strings come one after another, the later with a shared length of `width`.
    """
    size = 1 << max(0, (len(runs) - 1).bit_length())
    lengths = [r[0].tolist() for r in runs] + [[]] * (size - len(runs))
    rests, used, place = [r[1] for r in runs], [0] * len(runs), [0] * size
    text: list[bytes | None] = [b""] * len(runs) + [None] * (size - len(runs))
    common = [0] * size

    def step(run: int) -> None:
        if place[run] == len(lengths[run]):
            text[run] = None
            return
        n = common[run] = lengths[run][place[run]]
        start = used[run]
        used[run] = start + width - n
        text[run] = text[run][:n] + rests[run][start:used[run]]
        place[run] += 1

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared length becomes that with the winner, if they had to be compared."""
        x, y = text[a], text[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if common[a] != common[b]:
            return (a, b) if common[a] > common[b] else (b, a)
        n = shared_prefix(x, y, common[a])
        if n == width or x[n] < y[n]:
            common[b] = n
            return a, b
        common[a] = n
        return b, a

    for run in range(len(runs)):
        step(run)
    losers, winners = [0] * size, [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1]
    while text[top] is not None:
        yield common[top], top
        step(top)
        node = (top + size) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2
