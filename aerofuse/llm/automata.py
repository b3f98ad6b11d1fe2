"""Weighted acyclic automata over short sequences of words, built from sorted sequences, as numpy arrays."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

DEPTH = 4  # words of the longest sequence


def _smallest(array: np.ndarray) -> np.ndarray:
    top = int(array.max(initial=0))
    return array.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


@dataclass
class Layer:
    """States that are reached by equally many words, each with its transitions, one after the other."""

    first: np.ndarray  # where the transitions of each state begin, one entry more than states
    label: np.ndarray  # words by their number, from 1, ascending within a state
    weight: np.ndarray  # weight of the sequence that ends with this transition, 0 if none does
    target: np.ndarray  # state of the next layer, from 1; 0 if no sequence goes on


@dataclass
class Automaton:
    """Sequences of up to DEPTH words with weights. Equal endings are stored once: no two states of a layer are alike.

    ``words`` are sorted and numbered from 1; ``layers[0]`` has the one state that all sequences begin in.
    """

    words: list[bytes]
    layers: list[Layer]

    @classmethod
    def of_sorted(cls, words: list[bytes], sequences: np.ndarray, weights: np.ndarray) -> Automaton:
        """From distinct sequences in ascending order, one row each, shorter ones filled with 0 at the end."""
        layers: list = []
        state_of = np.zeros(len(sequences), np.int64)  # state, from 1, that each sequence goes on from
        for depth in range(DEPTH, 0, -1):
            # Each prefix of this many words is a transition. A sequence stands before the longer ones that it
            # begins, so it is the first row of its prefix, and the last row goes on if any does.
            rows = np.flatnonzero(sequences[:, depth - 1] > 0)
            new = _changes(sequences[rows, :depth])
            first, last = rows[new], rows[np.append(new[1:], len(rows)) - 1] if len(rows) else rows
            ends = sequences[first, depth] == 0 if depth < DEPTH else np.ones(len(first), bool)
            owner = _changes(sequences[first, : depth - 1])
            layer, number = _register(
                owner, sequences[first, depth - 1].astype(np.int64), np.where(ends, weights[first], 0), state_of[last])
            layers.append(layer)
            state_of = np.zeros(len(sequences), np.int64)
            state_of[rows] = number[_group(owner, len(first))[_group(new, len(rows))]] + 1
        return cls(words, layers[::-1])

    def sequences(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences in ascending order, and their weights."""
        path, state = np.zeros((1, DEPTH), np.int64), np.zeros(1, np.int64)
        rows, weights = [path[:0]], [state[:0]]
        for depth, layer in enumerate(self.layers):
            if not len(layer.label):
                break
            size = layer.first[state + 1] - layer.first[state]
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(layer.first[state], size)
            path = np.repeat(path, size, axis=0)
            path[:, depth] = layer.label[at]
            ends = layer.weight[at] > 0
            rows.append(path[ends])
            weights.append(layer.weight[at][ends])
            on = layer.target[at] > 0
            path, state = path[on], layer.target[at][on] - 1
        found, weight = np.concatenate(rows), np.concatenate(weights)
        order = np.lexsort(found.T[::-1])
        return found[order], weight[order]

    def compose(self, sequences: np.ndarray) -> np.ndarray:
        """Weights of sequences of this automaton's word numbers (0 after the last; unknown words: -1), 0 if absent."""
        state = np.zeros(len(sequences), np.int64)
        weight = np.zeros(len(sequences), np.int64)
        going = np.arange(len(sequences))
        for depth, layer in enumerate(self.layers):
            going = going[sequences[going, depth] != 0]
            if not len(going) or not len(layer.label):
                weight[going] = 0
                break
            width = len(self.words) + 2
            known = np.repeat(np.arange(len(layer.first) - 1), np.diff(layer.first)) * width + layer.label
            wanted = state[going] * width + sequences[going, depth]
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            met = known[at] == wanted
            weight[going] = np.where(met, layer.weight[at], 0)
            on = met & (layer.target[at] > 0)
            # A sequence that goes on where this automaton does not is absent.
            lost = going[~on]
            weight[lost[sequences[lost, depth + 1] != 0] if depth + 1 < DEPTH else lost[:0]] = 0
            state[going[on]] = layer.target[at][on] - 1
            going = going[on]
        return weight

    def dump(self) -> bytes:
        arrays = [_smallest(a) for x in self.layers for a in (np.diff(x.first), x.label, x.weight, x.target)]
        head = np.array([[a.itemsize, len(a)] for a in arrays], np.int64)
        return b"".join([head.tobytes(), *(a.tobytes() for a in arrays), b"\n".join(self.words)])

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        head = np.frombuffer(data, np.int64, 8 * DEPTH).reshape(-1, 2)
        at, arrays = head.nbytes, []
        for width, n in head.tolist():
            arrays.append(np.frombuffer(data, f"<u{width}", n, at).astype(np.int64))
            at += width * n
        layers = [Layer(np.concatenate([[0], np.cumsum(arrays[k])]), *arrays[k + 1 : k + 4]) for k in range(0, len(arrays), 4)]
        return cls(data[at:].split(b"\n") if at < len(data) else [], layers)


def _changes(rows: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it; the first row does."""
    if not len(rows):
        return np.zeros(0, np.int64)
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return np.flatnonzero(fresh)


def _group(begin: np.ndarray, n: int) -> np.ndarray:
    """Which of the groups that begin there each of ``n`` rows is in."""
    return np.repeat(np.arange(len(begin)), np.diff(np.append(begin, n)))


def _register(owner: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray) -> tuple[Layer, np.ndarray]:
    """The distinct states whose transitions begin at ``owner``, and the number of each among them."""
    table = np.stack([label, weight, target], axis=1)
    size = np.diff(np.append(owner, len(label)))
    number = np.zeros(len(owner), np.int64)
    single = np.flatnonzero(size == 1)
    alone = np.zeros(0, np.int64)
    if len(single):
        order = np.lexsort(table[owner[single]].T)
        new = _changes(table[owner[single]][order])
        alone = single[order[new]]
        number[single[order]] = _group(new, len(order))
    seen: dict = {}
    several: list = []
    for k in np.flatnonzero(size > 1).tolist():
        key = table[owner[k] : owner[k] + size[k]].tobytes()
        at = seen.get(key)
        if at is None:
            at = seen[key] = len(alone) + len(several)
            several.append(k)
        number[k] = at
    kept = np.concatenate([alone, np.array(several, np.int64)])
    n = size[kept]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(owner[kept], n)
    return Layer(np.concatenate([[0], np.cumsum(n)]), label[at], weight[at], target[at]), number


def summed(sequences: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sequences in ascending order with the sums of their weights."""
    if not len(sequences):
        return sequences, weights
    pairs = []
    for k in (0, 2):  # two words become one number that keeps their order
        both = sequences[:, k].astype(np.uint64) << np.uint64(32) | sequences[:, k + 1].astype(np.uint64)
        pairs.append(both)
    order = np.lexsort((pairs[1], pairs[0]))
    first, second = pairs[0][order], pairs[1][order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    begin = np.flatnonzero(fresh)
    return sequences[order[begin]], np.add.reduceat(weights[order], begin)


def prefix_weights(sequences: np.ndarray, weights: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The prefixes of ``depth`` words of sorted sequences, and the weight of all that begin with each."""
    rows = np.flatnonzero(sequences[:, depth - 1] > 0)
    if not len(rows):
        return sequences[:0, :depth], weights[:0]
    some = sequences[rows, :depth]
    begin = _changes(some)
    return some[begin], np.add.reduceat(weights[rows], begin)


def united(automata: Sequence[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, sequences (ascending) and summed weights of all the dumped automata, which are loaded one at a time."""
    words = sorted(set().union(*(Automaton.load(a).words for a in automata)))
    number = {w: k + 1 for k, w in enumerate(words)}
    rows, weights = [np.zeros((0, DEPTH), np.int32)], [np.zeros(0, np.int64)]
    for data in automata:
        automaton = Automaton.load(data)
        own = np.array([0, *(number[w] for w in automaton.words)], np.int32)
        some, weight = automaton.sequences()
        rows.append(own[some])
        weights.append(weight)
    return words, *summed(np.concatenate(rows), np.concatenate(weights))
