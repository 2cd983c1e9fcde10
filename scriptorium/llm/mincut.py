"""Minimum cut of small labelling graphs by augmenting paths in levels."""

from __future__ import annotations

from collections import deque


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that minimise the cost of a binary labelling.

    gain[i] > 0 is the cost of labelling i False, -gain[i] that of True; an edge (i, j, w) costs w if its ends differ.
    The source side of the minimum cut is True. Parts whose gains have one sign are cut without flow: it is zero there.
    """
    n = len(gain)
    near: list[list[int]] = [[] for _ in range(n)]
    for i, j, _ in edges:
        near[i].append(j)
        near[j].append(i)
    label, part = [g > 0 for g in gain], [-1] * n
    parts = 0
    mixed = []
    for s in range(n):
        if part[s] < 0:
            part[s] = parts
            stack, members = [s], [s]
            while stack:
                for j in near[stack.pop()]:
                    if part[j] < 0:
                        part[j] = parts
                        stack.append(j)
                        members.append(j)
            if any(label[i] != label[s] for i in members):
                mixed.append(members)
            parts += 1
    for members in mixed:
        at = {i: k for k, i in enumerate(members)}
        inner = [(at[i], at[j], w) for i, j, w in edges if i in at]
        for k, side in zip(members, _flow([gain[i] for i in members], inner)):
            label[k] = side
    return label


def _flow(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    n = len(gain)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(forth)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, g in enumerate(gain):
        if g > 0:
            arc(s, i, g, 0.0)
        elif g < 0:
            arc(i, t, -g, 0.0)
    for i, j, w in edges:
        arc(i, j, w, w)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                path, a = [], s
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if cap[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(out[a]):
                path.append(out[a][turn[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                turn[a] += 1
            else:
                break
