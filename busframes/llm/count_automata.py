"""Weighted acyclic automata over sequences of 64-bit labels, as arrays.

An automaton holds counts of label sequences (paths from the root). It is
deterministic and layered by depth: the arcs of layer d leave the states that
the arcs of layer d - 1 reach, sorted by (state, label); an arc's weight is the
count of the sequence that ends with it, 0 where none does. Stored, states of
equal futures (labels, weights and futures of their arcs) share one arc list.
"""

from __future__ import annotations

import numpy as np

from busframes.llm import bytesops as B

U = np.uint64


def _future(layers, d: int, child: np.ndarray | None) -> np.ndarray:
    """A 64-bit hash of what follows each state of layer d."""
    offs, _, label, weight = layers[d]
    arcs = B.mix(label + B.mix(weight.astype(U) + U(1)))
    if child is not None:
        arcs = B.mix(arcs + child)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(arcs)])
    return sums[offs[1:]] - sums[offs[:-1]]


class CountAutomaton:
    """``layers``: (arc offsets by state, parent state, label, weight)."""

    def __init__(self, layers: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        self.layers = layers

    @property
    def arcs(self) -> int:
        return sum(len(x[2]) for x in self.layers)

    @classmethod
    def build(cls, columns: list[np.ndarray], length: np.ndarray, count: np.ndarray) -> "CountAutomaton":
        """From sequences in sorted order (shorter ones padded with 0 behind,
        before what they begin): a sequence makes new states only past the
        prefix it shares with the one before it."""
        layers, states = [], 1
        own = np.zeros(len(count), np.int64)  # each sequence's state
        fresh = np.zeros(len(count), bool)
        fresh[:1] = True
        for d, column in enumerate(columns):
            fresh[1:] |= column[1:] != column[:-1]
            on = np.flatnonzero(length > d)
            if not len(on):
                break
            new = fresh[on]
            arc = np.cumsum(new) - 1
            first = on[new]
            weight = np.zeros(len(first), np.int64)
            end = length[on] == d + 1
            np.add.at(weight, arc[end], count[on[end]])
            parent = own[first]
            offs = np.searchsorted(parent, np.arange(states + 1))
            layers.append((offs, parent, column[first], weight))
            own[on], states = arc, len(first)
        return cls(layers)

    @classmethod
    def union(cls, parts: list["CountAutomaton"]) -> "CountAutomaton":
        """Layer by layer: arcs of one state and label become one, their
        weights added."""
        layers, states = [], 1
        maps = [np.zeros(1, np.int64) for _ in parts]
        for d in range(max((len(p.layers) for p in parts), default=0)):
            with_arcs = [k for k, p in enumerate(parts) if len(p.layers) > d]
            parent = np.concatenate([maps[k][parts[k].layers[d][1]] for k in with_arcs])
            label = np.concatenate([parts[k].layers[d][2] for k in with_arcs])
            weight = np.concatenate([parts[k].layers[d][3] for k in with_arcs])
            order = np.lexsort((label, parent))
            parent, label, weight = parent[order], label[order], weight[order]
            new = np.ones(len(order), bool)
            new[1:] = (parent[1:] != parent[:-1]) | (label[1:] != label[:-1])
            first = np.flatnonzero(new)
            back = np.empty(len(order), np.int64)
            back[order] = np.cumsum(new) - 1
            at = 0
            for k in with_arcs:
                n = len(parts[k].layers[d][2])
                maps[k], at = back[at:at + n], at + n
            parent = parent[first]
            layers.append((np.searchsorted(parent, np.arange(states + 1)), parent, label[first], np.add.reduceat(weight, first) if len(first) else weight))
            states = len(first)
        return cls(layers)

    def sequences(self, depth: int, least: int) -> tuple[list[np.ndarray], np.ndarray]:
        """(label columns, counts) of the sequences of ``depth`` labels that
        occur ``least`` times or more, sorted."""
        if len(self.layers) < depth:
            return [np.zeros(0, U)] * depth, np.zeros(0, np.int64)
        at = np.flatnonzero(self.layers[depth - 1][3] >= max(least, 1))
        count, columns = self.layers[depth - 1][3][at], []
        for d in range(depth - 1, -1, -1):
            columns.append(self.layers[d][2][at])
            at = self.layers[d][1][at]
        return columns[::-1], count

    def compose(self, columns: list[np.ndarray], length: np.ndarray) -> np.ndarray:
        """Counts of the asked sequences (0 where there is none)."""
        n = len(length)
        state, out = np.zeros(n, np.int64), np.zeros(n, np.int64)
        alive = np.ones(n, bool)
        for d, (offs, _, label, weight) in enumerate(self.layers):
            on = np.flatnonzero(alive & (length > d))
            if not len(on):
                break
            want = columns[d][on]
            lo, end = offs[state[on]], offs[state[on] + 1]
            hi = end.copy()
            while (open_ := lo < hi).any():  # first label not below the one asked for
                mid = (lo + hi) // 2
                less = open_ & (label[np.minimum(mid, len(label) - 1)] < want)
                lo = np.where(less, mid + 1, lo)
                hi = np.where(open_ & ~less, mid, hi)
            hit = (lo < end) & (label[np.minimum(lo, len(label) - 1)] == want)
            state[on] = lo
            alive[on] = hit
            ends = hit & (length[on] == d + 1)
            out[on[ends]] = weight[lo[ends]]
        return out

    def to_bytes(self) -> bytes:
        depth = len(self.layers)
        stored, pointer = [], None  # pointer: of each state of the layer below to its shared arc list
        for d in range(depth - 1, -1, -1):
            offs, _, label, weight = self.layers[d]
            future = _future(self.layers, d, None if pointer is None else pointer[1][pointer[0]])
            kept, first, back = np.unique(future, return_index=True, return_inverse=True)
            degree = offs[first + 1] - offs[first]
            arcs = B.expand(offs[first], degree)
            wide = "<u8" if len(arcs) and weight[arcs].max() >= 2**32 else "<u4"
            child = np.zeros(0, "<u4") if pointer is None else pointer[0][arcs].astype("<u4")
            stored.append((len(first), len(arcs), wide == "<u8", degree.astype("<u4"), label[arcs].astype("<u8"), weight[arcs].astype(wide), child))
            pointer = (back, kept)
        out = [np.array([depth], "<u4").tobytes()]
        for states, arcs, wide, *arrays in reversed(stored):
            out.append(np.array([states, arcs, wide, len(arrays[3])], "<u4").tobytes())
            out += [a.tobytes() for a in arrays]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> "CountAutomaton":
        at = 4

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            a = np.frombuffer(data, kind, n, at)
            at += a.nbytes
            return a

        layers, state = [], np.zeros(1, np.int64)
        for _ in range(int(np.frombuffer(data, "<u4", 1)[0])):
            states, arcs, wide, children = take("<u4", 4).tolist()
            degree, label, weight, child = take("<u4", states), take("<u8", arcs), take("<u8" if wide else "<u4", arcs), take("<u4", children)
            begin = np.concatenate([[0], np.cumsum(degree, dtype=np.int64)])
            n = degree[state].astype(np.int64)
            arc = B.expand(begin[state], n)
            layers.append((np.concatenate([[0], np.cumsum(n)]), np.repeat(np.arange(len(state)), n), label[arc], weight[arc].astype(np.int64)))
            state = child[arc].astype(np.int64) if children else arc
        return cls(layers)
