"""Generalised suffix automata over words, and matching statistics of texts against them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from airshed.llm.common import ship_by_value

ship_by_value(__name__)


class SuffixAutomaton:
    """All substrings of a set of word sequences; each state keeps the smallest owner of its places.

    ``add`` may be called any number of times, then ``seal`` once."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner = [None]

    def _state(self, length: int, moves: dict, link: int, owner) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.owner.append(owner)
        return len(self.link) - 1

    def _split(self, p: int, q: int, word) -> int:
        """A copy of q for the substrings that end at p's followed by word."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], None)
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _own(self, state: int, owner: int) -> None:
        if self.owner[state] is None or owner < self.owner[state]:
            self.owner[state] = owner

    def add(self, words: Sequence, owner: int) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:  # the prefix so far is known already
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
                self._own(last, owner)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0, owner), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
            last = new

    def seal(self) -> None:
        """Give every state the smallest owner of the states that end in its substrings."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.owner[s] is not None and self.link[s] > 0:
                self._own(self.link[s], self.owner[s])

    def walk(self, words: Sequence) -> Iterator[tuple[int, int]]:
        """At each word its matching statistic: the state and length of the longest suffix up to
        there that the automaton knows."""
        state, known = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                known = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                known += 1
            yield state, known

    def owners(self, words: Sequence, span: int) -> list:
        """For each window of ``span`` words the smallest owner of its occurrences, or None."""
        out = []
        for i, (state, known) in enumerate(self.walk(words)):
            if i + 1 < span:
                continue
            if known < span:
                out.append(None)
                continue
            while self.length[self.link[state]] >= span:
                state = self.link[state]
            out.append(self.owner[state])
        return out
