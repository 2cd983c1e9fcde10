"""A minimal acyclic transducer: words with id sequences in a shared-suffix automaton that workers map into memory."""

from __future__ import annotations

import numpy as np

_MAGIC = np.int32(0x4C585431)


def compile_lexicon(words: dict[bytes, tuple[int, ...]]) -> bytes:
    """One blob: automaton and id table.

    Words are added in byte order; states whose right language equals that of an earlier one are merged, so suffixes
    are shared. An edge carries the number of words that come before it in its state; the sum along a path is the
    word's place in the id table.
    """
    order = sorted(words)
    register: dict[tuple, int] = {}
    final, edges, size = [], [], []  # of each state: accepting, ((label, target), ...), words below it

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        at = register.get(key)
        if at is None:
            at = register[key] = len(final)
            final.append(node[0])
            edges.append(key[1])
            size.append(node[0] + sum(size[t] for _, t in key[1]))
        return at

    path: list[list] = [[0, []]]  # the states of the last word, not yet settled
    last = b""
    for w in order:
        common = 0
        while common < min(len(w), len(last)) and w[common] == last[common]:
            common += 1
        for i in range(len(path) - 1, common, -1):
            target = settle(path.pop())
            path[-1][1].append((last[i - 1], target))
        path.extend([0, []] for _ in range(common, len(w)))
        path[-1][0] = 1
        last = w
    for i in range(len(path) - 1, 0, -1):
        target = settle(path.pop())
        path[-1][1].append((last[i - 1], target))
    root = settle(path[0])

    first = np.zeros(len(final) + 1, np.int32)
    first[1:] = np.cumsum([len(e) for e in edges])
    label, target, skip = (np.zeros(first[-1], np.int32) for _ in range(3))
    for s, out in enumerate(edges):
        before = final[s]
        for k, (b, t) in enumerate(out, first[s]):
            label[k], target[k], skip[k] = b, t, before
            before += size[t]
    offsets = np.zeros(len(order) + 1, np.int32)
    offsets[1:] = np.cumsum([len(words[w]) for w in order])
    ids = np.fromiter((i for w in order for i in words[w]), np.int32, offsets[-1])
    parts = [first, np.array(final, np.int32), label, target, skip, offsets, ids]
    head = np.array([_MAGIC, root, *[len(p) for p in parts]], np.int32)
    return b"".join(p.astype("<i4").tobytes() for p in [head, *parts])


class Lexicon:
    """Look-up in a compiled blob or memory map."""

    def __init__(self, data: np.ndarray):
        head = [int(x) for x in data[:9]]
        if head[0] != int(_MAGIC):
            raise ValueError("no lexicon")
        self.root, at, parts = head[1], 9, []
        for n in head[2:]:
            parts.append(data[at : at + n])
            at += n
        self.first, self.final, self.label, self.target, self.skip, self.offsets, self.ids = parts

    @classmethod
    def open(cls, source: str | bytes) -> Lexicon:
        return cls(np.frombuffer(source, "<i4") if isinstance(source, bytes) else np.memmap(source, "<i4", "r"))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def packed(self, word: bytes) -> bytes | None:
        """The ids of a word as little-endian int32; None if it isn't there."""
        state, place = self.root, 0
        for b in word:
            lo, hi = int(self.first[state]), int(self.first[state + 1])
            k = lo + int(np.searchsorted(self.label[lo:hi], b)) if hi - lo > 4 else next((i for i in range(lo, hi) if self.label[i] >= b), hi)
            if k >= hi or self.label[k] != b:
                return None
            place += int(self.skip[k])
            state = int(self.target[k])
        return self.ids[self.offsets[place] : self.offsets[place + 1]].tobytes() if self.final[state] else None
