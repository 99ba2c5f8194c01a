"""A hierarchical navigable small-world graph over unit vectors, in flat neighbour arrays."""

from __future__ import annotations

import heapq

import numpy as np

LINKS = 12
BREADTH_BUILD = 64


class SmallWorld:
    """Vectors of length one, `links[level]` (node, slot; -1 is free) and each node's level.

    Nearness is the inner product. Level 0 has 2 * `LINKS` slots per node, the others `LINKS`.
    """

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, links: list[np.ndarray], entry: int):
        self.vectors, self.levels, self.links, self.entry = vectors, levels, links, entry

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int) -> SmallWorld:
        size = len(vectors)
        random = np.random.Generator(np.random.PCG64(seed))
        levels = np.floor(-np.log(1 - random.random(size)) / np.log(LINKS)).astype(np.int8)
        links = [
            np.full((size, (2 if level == 0 else 1) * LINKS), -1, np.int32)
            for level in range(int(levels.max(initial=0)) + 1)
        ]
        graph = cls(vectors, levels, links, 0)
        for node in range(1, size):
            graph._insert(node)
        return graph

    def _insert(self, node: int) -> None:
        vector, top = self.vectors[node], int(self.levels[node])
        highest = int(self.levels[self.entry])
        near = [(float(self.vectors[self.entry] @ vector), self.entry)]
        for level in range(highest, top, -1):
            near = self._search(vector, near, 1, level)
        for level in range(min(top, highest), -1, -1):
            near = self._search(vector, near, BREADTH_BUILD, level)
            chosen = self._spread(near, LINKS)
            self.links[level][node, : len(chosen)] = chosen
            for other in chosen:
                self._link(other, node, level)
        if top > highest:
            self.entry = node

    def _link(self, node: int, other: int, level: int) -> None:
        row = self.links[level][node]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = other
            return
        # a full row keeps three quarters, so that it is not sorted again for every link
        everyone = np.append(row, other)
        nearness = self.vectors[everyone] @ self.vectors[node]
        ranked = sorted(zip(nearness.tolist(), everyone.tolist(), strict=True), reverse=True)
        chosen = self._spread(ranked, 3 * len(row) // 4)
        row[:] = -1
        row[: len(chosen)] = chosen

    def _spread(self, ranked: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours that are nearer to the node than to any one chosen before, then the rest."""
        nodes = [n for _, n in ranked]
        own = self.vectors[nodes]
        nearest = np.full(len(nodes), -2.0, np.float32)
        chosen: list[int] = []
        rest: list[int] = []
        for at, (nearness, _) in enumerate(ranked):
            if len(chosen) == most:
                break
            if nearest[at] > nearness:
                rest.append(at)
            else:
                chosen.append(at)
                np.maximum(nearest, own @ own[at], out=nearest)
        return [nodes[at] for at in (chosen + rest)[:most]]

    def _search(
        self, vector: np.ndarray, start: list[tuple[float, int]], breadth: int, level: int
    ) -> list[tuple[float, int]]:
        """The nearest nodes found from `start`, nearest first."""
        links, vectors = self.links[level], self.vectors
        seen = {node for _, node in start}
        ahead = [(-nearness, node) for nearness, node in start]
        heapq.heapify(ahead)
        best = heapq.nlargest(breadth, start)
        heapq.heapify(best)
        while ahead:
            far, node = heapq.heappop(ahead)
            if len(best) >= breadth and -far < best[0][0]:
                break
            fresh = [n for n in links[node].tolist() if n >= 0 and n not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for nearness, other in zip((vectors[fresh] @ vector).tolist(), fresh, strict=True):
                if len(best) < breadth:
                    heapq.heappush(best, (nearness, other))
                elif nearness > best[0][0]:
                    heapq.heapreplace(best, (nearness, other))
                else:
                    continue
                heapq.heappush(ahead, (-nearness, other))
        return sorted(best, reverse=True)

    def nearest(self, vector: np.ndarray, breadth: int) -> list[int]:
        """Up to `breadth` nodes found near the vector."""
        near = [(float(self.vectors[self.entry] @ vector), self.entry)]
        for level in range(int(self.levels[self.entry]), 0, -1):
            near = self._search(vector, near, 1, level)
        return [node for _, node in self._search(vector, near, breadth, 0)]
