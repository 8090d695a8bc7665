"""A minimal acyclic transducer that maps the terms of a sorted list to their ordinals.

States with the same continuations are one state, so that common endings are stored once. An arc's output
is the number of terms that precede all of its own below its state; the outputs along a path add up to the
ordinal of the term in the list.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Arcs as arrays, sorted by ``state << 8 | byte``: keys, target states, outputs; then the final states.
Arrays = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class _Builder:
    """Incremental construction from sorted byte strings.

    The path of the last term is still open: one list of arcs for each of its bytes. When the next term
    leaves that path, what lies beyond the common prefix can change no more and is merged with an equal
    state if there is one.
    """

    def __init__(self) -> None:
        self.known: dict[tuple, int] = {}
        self.states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        self.path: list[tuple[list[tuple[int, int]], bool]] = [([], False)]
        self.last = b""

    def add(self, term: bytes) -> None:
        if self.states or len(self.path) > 1 or self.path[0][1]:
            if term <= self.last:
                raise ValueError("terms must be sorted and distinct")
        shared = 0
        for a, b in zip(term, self.last, strict=False):
            if a != b:
                break
            shared += 1
        self._close(shared)
        self.path += [([], False) for _ in range(len(term) - shared)]
        arcs, _ = self.path[-1]
        self.path[-1] = (arcs, True)
        self.last = term

    def _close(self, keep: int) -> None:
        while len(self.path) > keep + 1:
            arcs, final = self.path.pop()
            self.path[-1][0].append((self.last[len(self.path) - 1], self._state(arcs, final)))

    def _state(self, arcs: list[tuple[int, int]], final: bool) -> int:
        key = (final, tuple(arcs))
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.states)
            self.states.append(key)
        return found

    def finish(self) -> Arrays:
        self._close(0)
        arcs, final = self.path[0]
        root = self._state(arcs, final)
        # Targets are numbered before their sources, so one walk in order knows all counts below.
        below = np.zeros(len(self.states), dtype=np.int64)
        keys, targets, outputs = [], [], []
        for state, (ends, leaving) in enumerate(self.states):
            before = int(ends)
            for byte, target in leaving:
                keys.append(state << 8 | byte)
                targets.append(target)
                outputs.append(before)
                before += int(below[target])
            below[state] = before
        finals = np.array([ends for ends, _ in self.states], dtype=bool)
        assert root == len(self.states) - 1
        return np.array(keys, np.int64), np.array(targets, np.int64), np.array(outputs, np.int64), finals


def build(terms: Iterable[bytes]) -> Arrays:
    """The transducer of ``terms``, which must be sorted and distinct. Its root is the last state."""
    builder = _Builder()
    for term in terms:
        builder.add(term)
    return builder.finish()


def dump(arrays: Arrays) -> bytes:
    keys, targets, outputs, finals = arrays
    head = np.array([len(keys), len(finals)], dtype=np.int64)
    return b"".join([head.tobytes(), keys.tobytes(), targets.astype(np.int32).tobytes(), outputs.astype(np.int32).tobytes(), finals.tobytes()])


def load(data: bytes) -> Arrays:
    arcs, states = (int(n) for n in np.frombuffer(data, np.int64, 2))
    at = 16
    keys = np.frombuffer(data, np.int64, arcs, at)
    targets = np.frombuffer(data, np.int32, arcs, at + 8 * arcs)
    outputs = np.frombuffer(data, np.int32, arcs, at + 12 * arcs)
    return keys, targets, outputs, np.frombuffer(data, bool, states, at + 16 * arcs)


def ordinals(arrays: Arrays, tokens: list[bytes]) -> np.ndarray:
    """The ordinal of each token, -1 for those that are no term. All tokens advance byte by byte together."""
    keys, targets, outputs, finals = arrays
    found = np.full(len(tokens), -1, dtype=np.int64)
    if not len(tokens):
        return found
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    text = np.frombuffer(b"".join(tokens) + b"\0", np.uint8)
    starts = np.cumsum(lengths) - lengths
    alive = np.arange(len(tokens))
    state = np.full(len(tokens), len(finals) - 1, dtype=np.int64)
    total = np.zeros(len(tokens), dtype=np.int64)
    depth = 0
    while len(alive):
        ended = lengths[alive] == depth
        done = alive[ended]
        found[done] = np.where(finals[state[done]], total[done], -1)
        alive = alive[~ended]
        if not len(alive) or not len(keys):
            break
        wanted = state[alive] << 8 | text[starts[alive] + depth]
        arc = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        there = keys[arc] == wanted
        alive, arc = alive[there], arc[there]
        state[alive] = targets[arc]
        total[alive] += outputs[arc]
        depth += 1
    return found
