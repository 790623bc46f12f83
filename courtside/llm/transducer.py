"""Minimal acyclic transducers that number a sorted vocabulary.

``build`` adds the terms in ascending byte order; as soon as a branch cannot
grow any more, its states are merged with equal ones (equal: as final, with
the same transitions), so the automaton is minimal when the last term is in.
Every transition then gets an output: how many terms come before those that
go on through it.  The outputs along a term's path add up to its ordinal in
lexicographic order.

The transitions are stored as sorted numbers (state * 256 + byte), so a whole
batch of tokens advances by one byte with one search.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np


class Transducer(NamedTuple):
    """Transitions by (state << 8 | byte), several automata one after the other where ``join`` made it."""

    key: np.ndarray     # int64, ascending
    target: np.ndarray  # int32
    output: np.ndarray  # int32: terms before the ones through this transition
    final: np.ndarray   # bool by state
    start: int
    terms: int

    def to_bytes(self) -> bytes:
        head = np.array([len(self.key), len(self.final), self.start, self.terms], np.int64)
        return b"".join(a.tobytes() for a in (head, self.key, self.target, self.output, self.final))

    @staticmethod
    def from_bytes(raw: bytes) -> Transducer:
        n, states, start, terms = np.frombuffer(raw, np.int64, 4).tolist()
        at = 32
        key = np.frombuffer(raw, np.int64, n, at)
        target = np.frombuffer(raw, np.int32, n, at + 8 * n)
        output = np.frombuffer(raw, np.int32, n, at + 12 * n)
        return Transducer(key, target, output, np.frombuffer(raw, bool, states, at + 16 * n), start, terms)

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal: at each state the last transition whose output does not exceed what is left."""
        state, out = self.start, bytearray()
        while not (ordinal == 0 and self.final[state]):
            low, high = np.searchsorted(self.key, [state << 8, (state + 1) << 8])
            k = low + int(np.searchsorted(self.output[low:high], ordinal, "right")) - 1
            out.append(int(self.key[k]) & 255)
            ordinal -= int(self.output[k])
            state = int(self.target[k])
        return bytes(out)

    def ordinals(self, data: np.ndarray, first: np.ndarray, last: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """Ordinals of the tokens ``data[first:last]`` (each at least one byte), -1 for those that are no terms.

        All tokens run in step, from ``start`` or the start state; one that
        finds no transition is out.
        """
        found = np.full(len(first), -1, np.int64)
        alive = np.arange(len(first))
        at, end = first.astype(np.int64), last
        state, total = np.full(len(first), self.start, np.int64) if start is None else start, np.zeros(len(first), np.int64)
        while len(alive) and len(self.key):
            want = state << 8 | data[at]
            k = np.searchsorted(self.key, want)
            k[k == len(self.key)] = 0
            hit = self.key[k] == want
            alive, at, end, k, total = alive[hit], at[hit] + 1, end[hit], k[hit], total[hit]
            state = self.target[k].astype(np.int64)
            total += self.output[k]
            over = at == end
            if over.any():
                done = over & self.final[state]
                found[alive[done]] = total[done]
                on = ~over
                alive, at, end, state, total = alive[on], at[on], end[on], state[on], total[on]
        return found


def join(parts: list[Transducer]) -> tuple[Transducer, np.ndarray]:
    """One set of arrays for several transducers, and the start state of each; its own start and terms mean nothing."""
    size = [len(p.final) for p in parts]
    base = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    whole = Transducer(np.concatenate([p.key + (b << 8) for p, b in zip(parts, base)]), np.concatenate([p.target + np.int32(b) for p, b in zip(parts, base)]),
                       np.concatenate([p.output for p in parts]), np.concatenate([p.final for p in parts]), 0, 0)
    return whole, np.array([p.start for p in parts], np.int64) + base[:-1]


def build(terms: Iterable[bytes]) -> Transducer:
    """The transducer of distinct non-empty terms in ascending order."""
    register: dict[tuple, int] = {}
    # states that are merged: (final, ((byte, state), ...)), and how many terms each accepts
    kept: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    accepts: list[int] = []
    # the open path of the last term: [final, transitions that are merged]; byte k of the term leads from k to k + 1
    path: list[list] = [[False, []]]
    last, count = b"", 0

    def close(down_to: int) -> None:
        while len(path) > down_to + 1:
            final, moves = path.pop()
            state = (final, tuple(moves))
            number = register.get(state)
            if number is None:
                register[state] = number = len(kept)
                kept.append(state)
                accepts.append(final + sum(accepts[t] for _, t in moves))
            path[-1][1].append((last[len(path) - 1], number))

    for term in terms:
        if term <= last:
            raise ValueError("terms must be distinct, not empty and ascending")
        common = 0
        for x, y in zip(last, term):
            if x != y:
                break
            common += 1
        close(common)
        path.extend([False, []] for _ in range(len(term) - common))
        path[-1][0] = True
        last, count = term, count + 1
    close(0)
    kept.append((False, tuple(path[0][1])))

    key, target, output = [], [], []
    for state, (final, moves) in enumerate(kept):
        before = int(final)
        for byte, to in moves:
            key.append(state << 8 | byte)
            target.append(to)
            output.append(before)
            before += accepts[to]
    return Transducer(np.array(key, np.int64), np.array(target, np.int32), np.array(output, np.int32), np.array([f for f, _ in kept], bool), len(kept) - 1, count)
