"""A suffix automaton over word sequences, with matching statistics."""

from __future__ import annotations

from collections.abc import Iterator


class SuffixAutomaton:
    """All substrings of the sequences added so far; sequences don't run into each other."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, state: int, word) -> int:
        """The state of exactly what ``state`` followed by ``word`` spells."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, sequence: list) -> None:
        last = 0
        for word in sequence:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            new = self._state(self.length[last] + 1, {}, 0)
            state = last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._split(state, word)
            last = new

    def matches(self, sequence: list) -> Iterator[int]:
        """For each position how long a suffix of what was read occurs in the automaton."""
        state, size = 0, 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            else:
                size = 0
            yield size
