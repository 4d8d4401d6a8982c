"""A minimal acyclic transducer: sorted words to sequences of numbers, as flat arrays that can be mapped from a file."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

MARK = b"acyclic1"


class _State:
    __slots__ = ("arcs", "final", "output")

    def __init__(self):
        # Label -> [target, output]; words come sorted, so labels do too.
        self.arcs: dict[int, list] = {}
        self.final = False
        self.output: tuple[int, ...] = ()


def compile_words(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The file of a transducer for distinct words in byte order, each with its numbers.

    Words are added one by one. Where a word leaves the previous one, the states of the previous word beyond that place
    can change no more: each is replaced by an equal one if there is one (same arcs, outputs and end), so words share
    endings as well as beginnings. Numbers stand as early on a path as the words that share it allow.
    """
    register: dict[tuple, int] = {}
    frozen: list[_State] = []

    def freeze(state: _State) -> int:
        key = (state.final, state.output, tuple((label, to, out) for label, (to, out) in state.arcs.items()))
        if key not in register:
            register[key] = len(frozen)
            frozen.append(state)
        return register[key]

    path, before = [_State()], b""

    def close(length: int) -> None:
        for i in range(len(path) - 1, length, -1):
            path[i - 1].arcs[before[i - 1]][0] = freeze(path[i])
        del path[length + 1 :]

    for word, numbers in entries:
        if word <= before and (before or path[0].final):
            raise ValueError("words must be distinct and sorted")
        common = next((i for i, (a, b) in enumerate(zip(word, before)) if a != b), min(len(word), len(before)))
        close(common)
        rest = tuple(numbers)
        for i in range(common):
            arc = path[i].arcs[word[i]]
            out = arc[1]
            same = next((k for k, (a, b) in enumerate(zip(out, rest)) if a != b), min(len(out), len(rest)))
            pushed, rest = out[same:], rest[same:]
            if pushed:
                arc[1] = out[:same]
                following = path[i + 1]
                for later in following.arcs.values():
                    later[1] = pushed + later[1]
                if following.final:
                    following.output = pushed + following.output
        for i in range(common, len(word)):
            path[i].arcs[word[i]] = [-1, ()]
            path.append(_State())
        if len(word) > common:
            path[common].arcs[word[common]][1] = rest
            rest = ()
        path[-1].final = True
        path[-1].output = rest
        before = word
    close(0)
    root = freeze(path[0])
    return _packed(frozen, root)


def _packed(states: list[_State], root: int) -> bytes:
    outputs: dict[tuple[int, ...], int] = {}
    numbers: list[int] = []

    def place(output: tuple[int, ...]) -> int:
        if output not in outputs:
            outputs[output] = len(numbers)
            numbers.extend(output)
        return outputs[output]

    arcs = [(s << 8 | label, to, place(out), len(out)) for s, state in enumerate(states) for label, (to, out) in sorted(state.arcs.items())]
    ends = [(state.final, place(state.output), len(state.output)) for state in states]
    arc_table = np.array(arcs, np.int64).reshape(-1, 4)
    end_table = np.array(ends, np.int64).reshape(-1, 3)
    parts = [
        arc_table[:, 0],
        arc_table[:, 1].astype(np.int32),
        arc_table[:, 2].astype(np.int32),
        arc_table[:, 3].astype(np.int32),
        end_table[:, 0].astype(np.int32),
        end_table[:, 1].astype(np.int32),
        end_table[:, 2].astype(np.int32),
        np.array(numbers, np.int32),
    ]
    head = np.array([root, len(arcs), len(ends), len(numbers)], np.int64)
    return MARK + head.tobytes() + b"".join(p.tobytes() for p in parts)


class Transducer:
    """A compiled transducer; with ``path`` its arrays stay in the file and are mapped, so processes share them."""

    def __init__(self, path: str | None = None, data: bytes | None = None):
        raw = np.memmap(path, np.uint8, "r") if path else np.frombuffer(data, np.uint8)
        if raw[: len(MARK)].tobytes() != MARK:
            raise ValueError("not a transducer file")
        at = len(MARK)
        self.root, arcs, states, numbers = (int(x) for x in np.frombuffer(raw[at : at + 32].tobytes(), np.int64))
        at += 32
        found = []
        for kind, count in [(np.int64, arcs), *[(np.int32, arcs)] * 3, *[(np.int32, states)] * 3, (np.int32, numbers)]:
            size = count * np.dtype(kind).itemsize
            found.append(raw[at : at + size].view(kind))
            at += size
        self.keys, self.targets, self.out_at, self.out_len, self.final, self.end_at, self.end_len, self.numbers = found

    @property
    def states(self) -> int:
        return len(self.final)

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, numbers, lengths): which words are in the lexicon, and the numbers of those, one after the other.

        All words walk together: step k takes the k-th byte of every word that is still on a path.
        """
        n = len(words)
        if not n or not len(self.keys):
            # Only the empty word can be known without arcs; it is not a word here.
            return np.zeros(n, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        word, state = np.arange(n), np.full(n, self.root, np.int64)
        last = np.full(n, -1, np.int64)
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        step = 0
        while len(word):
            done = lengths[word] == step
            if done.any():
                last[word[done]] = state[done]
                word, state = word[~done], state[~done]
            key = state << 8 | flat[begin[word] + step]
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            on = self.keys[arc] == key
            word, arc = word[on], arc[on]
            state = self.targets[arc].astype(np.int64)
            some = self.out_len[arc] > 0
            met.append((word[some], self.out_at[arc[some]], self.out_len[arc[some]]))
            step += 1
        known = last >= 0
        known[known] = self.final[last[known]] > 0
        ended = np.flatnonzero(known)
        met.append((ended, self.end_at[last[ended]], self.end_len[last[ended]]))
        owner, at, size = (np.concatenate([m[i] for m in met]).astype(np.int64) for i in range(3))
        kept = known[owner]
        owner, at, size = owner[kept], at[kept], size[kept]
        # Steps were added in order, so a stable sort by word puts a word's outputs in the order of its path.
        order = np.argsort(owner, kind="stable")
        owner, at, size = owner[order], at[order], size[order]
        counts = np.bincount(owner, size, n).astype(np.int64)[known]
        return known, np.asarray(self.numbers[spread(at, size)], np.int64), counts


def spread(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places at, at + 1, ... of ``size`` items each, one after the other."""
    total = int(size.sum())
    before = np.cumsum(size) - size
    return np.arange(total) + np.repeat(at - before, size)
