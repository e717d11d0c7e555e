"""Suffix trees of number sequences and constant-time longest common extensions over them."""

from __future__ import annotations

from array import array

import numpy as np


class SuffixTree:
    """Ukkonen's tree of a sequence of numbers above 0, ended by a 0 that occurs nowhere else.

    Edges are one dictionary from parent and first symbol to child; nodes are numbers, the root 0.
    """

    def __init__(self, symbols: list[int]):
        self.symbols = text = [*symbols, 0]
        n, width = len(text), max(symbols, default=0) + 1
        start, end, link, to = array("q", [0]), array("q", [0]), array("q", [0]), {}
        node, edge, length, waiting = 0, 0, 0, 0
        for i, symbol in enumerate(text):
            unlinked = 0
            waiting += 1
            while waiting:
                if not length:
                    edge = i
                key = node * width + text[edge]
                child = to.get(key)
                if child is None:
                    to[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    first = start[child]
                    span = end[child] - first
                    if length >= span:
                        node, edge, length = child, edge + span, length - span
                        continue
                    if text[first + length] == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    split = len(start)
                    start.extend((first, i))
                    end.extend((first + length, n))
                    link.extend((0, 0))
                    to[key] = split
                    start[child] = first + length
                    to[split * width + text[first + length]] = child
                    to[split * width + symbol] = split + 1
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.start = np.frombuffer(start, np.int64)
        self.end = np.frombuffer(end, np.int64)
        keys = np.fromiter(to.keys(), np.int64, len(to))
        children = np.fromiter(to.values(), np.int64, len(to))
        order = np.argsort(keys)
        self.parents, self.firsts = np.divmod(keys[order], width)
        self.children = children[order]

    def leaves(self, backwards: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Euler tour at its leaves: suffixes in order, and the depth of the ancestor between neighbours.

        ``backwards`` reverses the order of symbols, the end still coming first.
        """
        n, nodes = len(self.symbols), len(self.start)
        # On the stack the last child is on top, so children lie in falling order of their symbols.
        rank = np.where(self.firsts == 0, np.iinfo(np.int64).max, self.firsts if backwards else -self.firsts)
        children = self.children[np.lexsort((rank, self.parents))].tolist()
        since = np.searchsorted(self.parents, np.arange(nodes + 1)).tolist()
        span = (self.end - self.start).tolist()
        suffixes, between = array("q"), array("q")
        low, stack, depths = 0, [0], [0]  # of each node on the stack, the depth of its parent
        while stack:
            node, above = stack.pop(), depths.pop()
            if above < low:
                low = above
            since_node, upto = since[node], since[node + 1]
            depth = above + span[node]
            if since_node == upto:
                suffixes.append(n - depth)
                between.append(low)
                low = n
            else:
                stack += children[since_node:upto]
                depths += [depth] * (upto - since_node)
        return np.frombuffer(suffixes, np.int64), np.frombuffer(between, np.int64)


class Extensions:
    """Longest common extensions of suffixes: the least depth between two leaves of the tour.

    Minima of stretches of a power of two of blocks, and of the ends of blocks, answer in constant time.
    """

    BLOCK = 16

    def __init__(self, suffixes: np.ndarray, between: np.ndarray):
        n, size = len(suffixes), self.BLOCK
        self.place = np.empty(n, np.int64)
        self.place[suffixes] = np.arange(n)
        blocks = -(-n // size)
        padded = np.full(blocks * size, np.iinfo(np.int64).max)
        padded[:n] = between
        grid = padded.reshape(blocks, size)
        self.depth = padded
        self.upto = np.minimum.accumulate(grid, axis=1).reshape(-1)
        self.since = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.levels = [grid.min(axis=1)]
        while 2 << len(self.levels) - 1 <= blocks:
            last, step = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common length of the suffixes at ``a`` and ``b``, arrays of different positions each."""
        one, two = self.place[a], self.place[b]
        left, right = np.minimum(one, two) + 1, np.maximum(one, two)  # the depths between, ends included
        first, last = left // self.BLOCK, right // self.BLOCK
        found = np.minimum(self.since[left], self.upto[right])
        far = last - first > 1
        width = np.where(far, last - first - 1, 1)
        level = np.log2(width).astype(np.int64)
        for k in np.unique(level[far]).tolist():
            rows = np.flatnonzero(far & (level == k))
            table = self.levels[k]
            found[rows] = np.minimum(found[rows], np.minimum(table[first[rows] + 1], table[last[rows] - (1 << k)]))
        same = np.flatnonzero(first == last)  # within a block: look at each depth between
        if len(same):
            low = self.depth[left[same]]
            for step in range(1, self.BLOCK):
                at = np.minimum(left[same] + step, right[same])
                low = np.minimum(low, self.depth[at])
            found[same] = low
        return found
