"""Suffix automaton of one or more sequences."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class SuffixAutomaton:
    """Accepts every substring of the sequences added; state 0 is the root."""

    def __init__(self, sequences: Iterable[Sequence[Hashable]] = ()):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        for x in sequences:
            self.add(x)

    def _state(self, length: int, step: dict, link: int) -> int:
        self.next.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _copy(self, p: int, c: Hashable, q: int) -> int:
        """Splits q so that its part reached from p by c has a state of its own."""
        new = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def add(self, sequence: Sequence[Hashable]) -> None:
        last = 0
        for c in sequence:
            q = self.next[last].get(c)
            if q is not None:  # an earlier sequence holds this substring
                last = q if self.length[q] == self.length[last] + 1 else self._copy(last, c, q)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._copy(p, c, q)
            last = new

    def step(self, state: int, matched: int, c: Hashable) -> tuple[int, int]:
        """State and length of the longest match that ends with c, after one of ``matched`` symbols at ``state``."""
        while state and c not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        return (self.next[state][c], matched + 1) if c in self.next[state] else (0, 0)
