"""Front-coded sorted suffix runs and their merge by a loser tree that keeps known prefixes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix; the first ``known`` bytes are not looked at."""
    n = min(len(a), len(b))
    step = 16
    while known < n:
        stop = min(known + step, n)
        x, y = a[known:stop], b[known:stop]
        if x != y:
            differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return known + (stop - known) - (differ.bit_length() + 7) // 8
        known = stop
        step *= 4
    return n


@dataclass
class Run:
    """Sorted suffixes; each keeps only what its predecessor doesn't begin with."""

    shared: np.ndarray  # length of the prefix shared with the predecessor
    ends: np.ndarray  # ends of the rests in ``rests``
    rests: bytes
    payload: np.ndarray  # one number per suffix

    @classmethod
    def of(cls, suffixes: list[bytes]) -> tuple[Run, list[int]]:
        """The run of ``suffixes``, and their places in sorted order."""
        order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
        shared, rests, before = [], [], b""
        for i in order:
            now = suffixes[i]
            same = common_prefix(before, now)
            shared.append(same)
            rests.append(now[same:])
            before = now
        ends = np.cumsum([len(r) for r in rests], dtype=np.int64)
        return cls(np.array(shared, np.int32), ends, b"".join(rests), np.arange(len(order))), order

    def decoded(self) -> Iterator[tuple[bytes, int, int]]:
        """Suffix, prefix shared with the one before, payload."""
        before, start = b"", 0
        for same, end, load in zip(self.shared.tolist(), self.ends.tolist(), self.payload.tolist()):
            before = before[:same] + self.rests[start:end]
            start = end
            yield before, same, load


def merge(runs: list[Run]) -> Iterator[tuple[int, int]]:
    """All payloads in the order of their suffixes, each with the prefix shared with the last.

    Every loser in the tree knows how much it shares with the suffix that beat it. If the
    next suffix and the loser share different lengths with the last output, the longer one
    is the smaller and nothing is compared; if equal, they are compared from there on.
    """
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    streams = [r.decoded() for r in runs]
    # A player is (suffix or None at the end, shared, payload, leaf).
    players = []
    for leaf in range(leaves):
        head = next(streams[leaf], None) if leaf < len(runs) else None
        players.append((None, -1, 0, leaf) if head is None else (head[0], 0, head[2], leaf))
    losers: list[tuple | None] = [None] * leaves

    def play(one: tuple, other: tuple) -> tuple[tuple, tuple]:
        """Winner and loser; the loser's shared length becomes that with the winner."""
        if other[0] is None:
            return one, other
        if one[0] is None:
            return other, one
        if one[1] != other[1]:
            return (one, other) if one[1] > other[1] else (other, one)
        a, b = one[0], other[0]
        same = common_prefix(a, b, one[1])
        first = len(a) <= len(b) if same == min(len(a), len(b)) else a[same] < b[same]
        if first:
            return one, (b, same, other[2], other[3])
        return other, (a, same, one[2], one[3])

    def build(node: int) -> tuple:
        if node >= leaves:
            return players[node - leaves]
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while winner[0] is not None:
        yield winner[2], winner[1]
        leaf = winner[3]
        head = next(streams[leaf], None)
        now = (None, -1, 0, leaf) if head is None else (head[0], head[1], head[2], leaf)
        node = (leaf + leaves) // 2
        while node:
            now, losers[node] = play(now, losers[node])
            node //= 2
        winner = now
