"""Weighted acyclic automata of word n-grams in numpy arrays.

A count transducer reads words; the weight of an arc is how often the words up to and including it were seen. It is built from sorted
n-grams, where each shares a prefix with the one before; states with a single way out are registered and shared, which folds the long
tails of rare n-grams. Several transducers are united level by level, weights summed, and states below a least weight are not followed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Longest n-gram.
DEPTH = 5


@dataclass
class Transducer:
    """Arcs grouped by state: ``arcs`` of each state, then label, weight and target state of each arc. State 0 has no arcs, the last is the root."""

    words: pa.Array
    arcs: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray

    def pack(self) -> bytes:
        names = ("arcs", "label", "weight", "target")
        columns = [pa.ListArray.from_arrays([0, len(self.words)], self.words)]
        columns += [pa.ListArray.from_arrays([0, len(x)], pa.array(x.astype(np.int32))) for x in (getattr(self, n) for n in names)]
        batch = pa.RecordBatch.from_arrays(columns, ["words", *names])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @classmethod
    def unpack(cls, blob: bytes) -> Transducer:
        with pa.ipc.open_stream(blob) as stream:
            batch = stream.read_next_batch()
        words, *numbers = (batch.column(k).flatten() for k in range(5))
        return cls(words, *(x.to_numpy() for x in numbers))


def sorted_grams(grams: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of a matrix of labels (0: no word) in order, and how often each occurs."""
    bits = max(int(vocabulary).bit_length(), 1)
    if 3 * bits <= 62:
        wide = grams.astype(np.int64)
        keys = [wide[:, 0] << 2 * bits | wide[:, 1] << bits | wide[:, 2], wide[:, 3] << bits | wide[:, 4]]
    else:
        keys = list(grams.T)
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for key in keys:
            ranked = key[order]
            new[1:] |= ranked[1:] != ranked[:-1]
    at = np.flatnonzero(new)
    return grams[order[at]], np.diff(np.append(at, len(order)))


def build(grams: np.ndarray, counts: np.ndarray, vocabulary: list[bytes]) -> Transducer:
    """Transducer of n-grams in order (rows of labels from 1, 0 for no word) and their counts; at least one row."""
    rows = len(grams)
    new = np.zeros(rows, bool)
    new[0] = True
    node, levels = np.zeros(rows, np.int64), []
    for d in range(DEPTH):
        new = new.copy()
        new[1:] |= grams[1:, d] != grams[:-1, d]
        at = np.flatnonzero(new)
        real = grams[at, d] > 0
        weight = np.add.reduceat(counts, at)[real]
        levels.append((node[at][real], grams[at, d][real].astype(np.int64), weight))
        # Rows that have ended keep a number that no deeper row looks at.
        node = (np.cumsum(real) - 1)[np.cumsum(new) - 1]
    arcs, label, weight, target = [np.zeros(1, np.int64)], [], [], []
    states = 1
    below = np.zeros(len(levels[-1][0]), np.int64)
    for d in range(DEPTH - 1, -1, -1):
        parent, lab, wei = levels[d]
        parents = len(levels[d - 1][0]) if d else 1
        ways = np.bincount(parent, minlength=parents)
        first = np.cumsum(ways) - ways
        state = np.zeros(parents, np.int64)
        one = np.flatnonzero(ways == 1) if d else np.zeros(0, np.int64)
        child = first[one]
        order = np.lexsort((below[child], wei[child], lab[child]))
        child = child[order]
        fresh = np.ones(len(child), bool)
        fresh[1:] = (lab[child][1:] != lab[child][:-1]) | (wei[child][1:] != wei[child][:-1]) | (below[child][1:] != below[child][:-1])
        state[one[order]] = states + np.cumsum(fresh) - 1
        more = np.flatnonzero(ways > 1) if d else np.arange(1)
        state[more] = states + fresh.sum() + np.arange(len(more))
        kept = np.isin(parent, more) if d else np.ones(len(parent), bool)
        for column, values in ((label, lab), (weight, wei), (target, below)):
            column += [values[child[fresh]], values[kept]]
        arcs += [np.ones(fresh.sum(), np.int64), ways[more]]
        states += int(fresh.sum()) + len(more)
        below = state
    labels = np.concatenate(label)
    used = np.unique(labels)
    return Transducer(pa.array([vocabulary[k - 1] for k in used.tolist()], pa.binary()), np.concatenate(arcs),
                      np.searchsorted(used, labels), np.concatenate(weight), np.concatenate(target))


def unite(parts: list[Transducer], least: int, ends: list[list[bytes]]) -> tuple[int, list[tuple[bytes, int]]]:
    """Weight of all, and the n-grams (words joined by a space) that have at least ``least`` together, with their weights.

    ``ends`` are n-grams at which the range of the transducers ends: their prefixes may go on in other ranges and are given, and followed,
    whatever their weight. The list of transducers is emptied, so that they are not held beside the arrays made of them.
    """
    words = pa.chunked_array([p.words for p in parts], pa.binary()).combine_chunks().dictionary_encode()
    known, index = words.dictionary.to_pylist(), words.indices.to_numpy()
    number = {w: k for k, w in enumerate(known)} if ends else {}
    states = np.cumsum([0, *(len(p.arcs) for p in parts)])
    vocab = np.cumsum([0, *(len(p.words) for p in parts)])
    arcs = np.concatenate([p.arcs for p in parts])
    first = np.cumsum(arcs, dtype=np.int64) - arcs
    label = np.concatenate([index[v + p.label] for v, p in zip(vocab, parts)])
    weight = np.concatenate([p.weight for p in parts])
    # Leaves of all transducers are one state: nothing to follow.
    target = np.concatenate([np.where(p.target > 0, p.target + s, 0) for s, p in zip(states, parts)])
    parts.clear()
    group, state = np.zeros(len(states) - 1, np.int64), states[1:] - 1
    paths, on_end = [b""], [np.ones(1, bool) for _ in ends]
    total, found = 0, []
    for d in range(DEPTH):
        ways = arcs[state]
        at = np.repeat(first[state] - (np.cumsum(ways) - ways), ways) + np.arange(ways.sum())
        asked = np.repeat(group, ways) * len(known) + label[at]
        key, place = np.unique(asked, return_inverse=True)
        # Exact below 2**53.
        summed = np.bincount(place, weights=weight[at], minlength=len(key)).astype(np.int64)
        total = int(summed.sum()) if d == 0 else total
        above, word = key // max(len(known), 1), key % max(len(known), 1)
        on_end = [was[above] & (word == number.get(end[d], -1)) if d < len(end) else np.zeros(len(key), bool) for was, end in zip(on_end, ends)]
        kept = summed >= least
        for flags in on_end:
            kept = kept | flags
        chosen = np.flatnonzero(kept)
        paths = [known[w] if d == 0 else paths[a] + b" " + known[w] for a, w in zip(above[chosen].tolist(), word[chosen].tolist())]
        found += zip(paths, summed[chosen].tolist())
        on_end = [flags[chosen] for flags in on_end]
        follow = kept[place] & (target[at] > 0)
        group, state = (np.cumsum(kept) - 1)[place[follow]], target[at[follow]]
    return total, found


class Counts:
    """Transducer of a prefix-closed set of n-grams, each of known weight, for composition with n-grams asked for."""

    def __init__(self, grams: np.ndarray, weights: np.ndarray, vocabulary: int) -> None:
        self.base = vocabulary + 1
        length = (grams > 0).sum(axis=1)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for d in range(1, DEPTH + 1):
            own = length == d
            keys = self._states(grams[own], d - 1) * self.base + grams[own, d - 1]
            order = np.argsort(keys)
            self.levels.append((keys[order], weights[own][order]))

    def _states(self, grams: np.ndarray, depth: int) -> np.ndarray:
        state = np.zeros(len(grams), np.int64)
        for d in range(depth):
            state = np.searchsorted(self.levels[d][0], state * self.base + grams[:, d])
        return state

    def compose(self, grams: np.ndarray) -> np.ndarray:
        """Weights along the path of every n-gram: column d is that of its first d + 1 words, 0 past its end."""
        out = np.zeros((len(grams), DEPTH), np.int64)
        state, alive = np.zeros(len(grams), np.int64), np.ones(len(grams), bool)
        for d in range(DEPTH):
            keys, weights = self.levels[d]
            alive &= grams[:, d] > 0
            asked = state * self.base + grams[:, d]
            state = np.searchsorted(keys, asked)
            if alive.any() and not (keys[np.minimum(state[alive], len(keys) - 1)] == asked[alive]).all():
                raise ValueError("an n-gram asked for has a prefix that is not in the transducer")
            out[alive, d] = weights[state[alive]]
        return out
