"""A bidirectional gated recurrent network with attention pooling, in numpy.

Each word's input is its word embedding and the elementwise maximum of the embeddings of its
byte n-grams. Both directions run together: arrays carry a leading axis of two.
"""

from __future__ import annotations

import numpy as np

WORD_SIZE = 8
GRAM_SIZE = 8
HIDDEN = 8
BUCKETS = 1 << 17
GRAMS = (3, 5, 7)
#: Share of words that a training step reads by their bytes alone.
UNKNOWN_SHARE = 0.4
#: Bytes of new words whose n-grams are looked up at a time.
GRAM_BYTES = 200_000


def gram_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-grams at every byte of `<word>` (rows: n) and each word's first byte.

    Where an n-gram doesn't fit the bucket is `BUCKETS`, the row that never wins.
    """
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    left = np.repeat(first + sizes, sizes) - np.arange(len(data))
    padded = np.concatenate([data, np.zeros(max(GRAMS), np.uint32)])
    rows = []
    for n in GRAMS:
        mixed = np.full(len(data), n, np.uint32)
        for place in range(n):
            mixed = (mixed ^ padded[place : place + len(data)]) * np.uint32(0x01000193)
            mixed ^= mixed >> np.uint32(15)
        rows.append(np.where(left >= n, mixed % np.uint32(BUCKETS), BUCKETS))
    return np.stack(rows).astype(np.int64), first


def sliding_sums(values: np.ndarray, window: int) -> np.ndarray:
    """Sums of `window` rows (fewer at the end) from every row on, by doubling: a sum holds
    only its own rows, so nothing cancels."""
    total, run = np.zeros_like(values), values
    taken, width = 0, 1
    while width <= window:
        if window & width:
            if taken < len(values):
                total[: len(values) - taken] += run[taken:]
            taken += width
        longer = run.copy()
        if width < len(values):
            longer[:-width] += run[width:]
        run, width = longer, 2 * width
    return total


def _squash(a: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * a) + 0.5


class Network:
    """Parameters, forward pass with its gradient, and the fast forward pass of scoring."""

    def __init__(self, words: dict[bytes, int], seed: int = 7):
        """`words`: rows of the known words, from 1; row 0 is for all others."""
        random = np.random.Generator(np.random.PCG64(seed))
        inputs = WORD_SIZE + GRAM_SIZE

        def draw(*shape: int, scale: float) -> np.ndarray:
            return random.normal(0, scale, shape)

        self.words = words
        self.p = {
            "word": draw(len(words) + 1, WORD_SIZE, scale=0.1),
            "gram": draw(BUCKETS + 1, GRAM_SIZE, scale=0.1),
            "w": draw(2, inputs, 3 * HIDDEN, scale=0.3),
            "u": draw(2, HIDDEN, 3 * HIDDEN, scale=0.3),
            "b": np.zeros((2, 1, 3 * HIDDEN)),
            "attend": draw(2 * HIDDEN, scale=0.3),
            "out": draw(2 * HIDDEN, scale=0.3),
            "bias": np.zeros(1),
        }
        self.p["word"][0] = 0
        self.p["gram"][BUCKETS] = -1e3
        self.cut, self.slope = 0.0, 1.0

    # inputs

    def _grams(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Largest n-gram embeddings of each word, and the buckets they come from."""
        buckets, first = gram_buckets(words)
        values = self.p["gram"][buckets]
        best_n = values.argmax(axis=0)
        best = np.take_along_axis(values, best_n[None], axis=0)[0]
        top = np.maximum.reduceat(best, first, axis=0)
        sizes = np.diff(np.append(first, len(best)))
        is_top = best == np.repeat(top, sizes, axis=0)
        place = np.where(is_top, np.arange(len(best))[:, None], len(best))
        place = np.minimum.reduceat(place, first, axis=0)
        return top, buckets[np.take_along_axis(best_n, place, axis=0), place]

    def inputs(
        self, words: list[bytes], known: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, word rows and n-gram buckets; words that are not `known` are read as new."""
        rows = np.array([self.words.get(w, 0) for w in words], np.int64)
        if known is not None:
            rows *= known
        top, source = self._grams(words)
        return np.concatenate([self.p["word"][rows], top], axis=1), rows, source

    # training

    def forward(self, x: np.ndarray, real: np.ndarray, pooled: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Logits of windows within runs of words; `x`: run, step, input; `real`: which steps
        hold a word; `pooled`: which of them are the window's, one at least."""
        p, (size, steps, _) = self.p, x.shape
        order = [np.arange(steps), np.arange(steps)[::-1]]
        gates = np.stack([x[:, order[d]] @ p["w"][d] + p["b"][d] for d in (0, 1)])
        mask = np.stack([real[:, order[d]] for d in (0, 1)])[..., None]
        h = np.zeros((2, size, HIDDEN))
        trail, states = [], np.zeros((2, size, steps, HIDDEN))
        for t in range(steps):
            a, v = gates[:, :, t], h @ p["u"]
            z = _squash(a[..., :HIDDEN] + v[..., :HIDDEN])
            r = _squash(a[..., HIDDEN : 2 * HIDDEN] + v[..., HIDDEN : 2 * HIDDEN])
            n = np.tanh(a[..., 2 * HIDDEN :] + r * v[..., 2 * HIDDEN :])
            new = np.where(mask[:, :, t], (1 - z) * n + z * h, h)
            trail.append((h, z, r, n, v[..., 2 * HIDDEN :]))
            states[:, :, t] = h = new
        both = np.concatenate([states[0], states[1][:, ::-1]], axis=2)
        weight = np.where(pooled, both @ p["attend"], -1e9)
        weight = np.exp(weight - weight.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        mean = (weight[..., None] * both).sum(axis=1)
        return mean @ p["out"] + p["bias"], (x, mask, order, trail, both, weight, mean)

    def backward(self, slope: np.ndarray, kept: tuple) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the parameters above the inputs, and of the inputs."""
        p, (x, mask, order, trail, both, weight, mean) = self.p, kept
        g = {"out": mean.T @ slope, "bias": slope.sum(keepdims=True)}
        d_mean = slope[:, None] * p["out"]
        d_weight = (both * d_mean[:, None]).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        g["attend"] = np.einsum("st,sth->h", d_score, both)
        d_both = weight[..., None] * d_mean[:, None] + d_score[..., None] * p["attend"]
        d_states = np.stack([d_both[..., :HIDDEN], d_both[:, ::-1, HIDDEN:]])
        g |= {k: np.zeros_like(p[k]) for k in ("w", "u", "b")}
        d_x, d_h = np.zeros_like(x), np.zeros_like(trail[0][0])
        for t in reversed(range(len(trail))):
            h, z, r, n, vn = trail[t]
            d_h = d_h + d_states[:, :, t]
            d_new = np.where(mask[:, :, t], d_h, 0)
            d_n = d_new * (1 - z) * (1 - n * n)
            d_z = d_new * (h - n) * z * (1 - z)
            d_r = d_n * vn * r * (1 - r)
            d_gate = np.concatenate([d_z, d_r, d_n], axis=2)
            d_v = np.concatenate([d_z, d_r, d_n * r], axis=2)
            g["u"] += np.swapaxes(h, 1, 2) @ d_v
            g["b"] += d_gate.sum(axis=1, keepdims=True)
            for d in (0, 1):
                step = order[d][t]
                g["w"][d] += x[:, step].T @ d_gate[d]
                d_x[:, step] += d_gate[d] @ p["w"][d].T
            d_h = np.where(mask[:, :, t], d_new * z, d_h) + d_v @ np.swapaxes(p["u"], 1, 2)
        return g, d_x

    def learn(
        self,
        runs: list[list[bytes]],
        windows: list[slice],
        labels: np.ndarray,
        epochs: int,
        rate: float,
        seed: int = 11,
    ) -> None:
        """Cross-entropy by Adam on one window of each run; both classes weigh the same in total."""
        random = np.random.Generator(np.random.PCG64(seed))
        share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
        share = share * len(labels)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(runs))
            for start in range(0, len(order), 128):
                some = order[start : start + 128]
                batch = [runs[i] for i in some]
                words = sorted({w for run in batch for w in run})
                place = {w: i for i, w in enumerate(words)}
                steps = max(map(len, batch))
                index = np.zeros((len(batch), steps), np.int64)
                real = np.zeros((len(batch), steps), bool)
                pooled = np.zeros((len(batch), steps), bool)
                for row, run in enumerate(batch):
                    index[row, : len(run)] = [place[w] for w in run]
                    real[row, : len(run)] = True
                    pooled[row, windows[some[row]]] = True
                pooled &= real
                table, rows, source = self.inputs(words, random.random(len(words)) >= UNKNOWN_SHARE)
                logits, kept = self.forward(table[index], real, pooled)
                slope = (_squash(logits) - labels[some]) * share[some] / len(some)
                g, d_x = self.backward(slope, kept)
                d_x[~real] = 0
                d_table = np.zeros_like(table)
                np.add.at(d_table, index, d_x)
                g["word"], g["gram"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["gram"])
                np.add.at(g["word"], rows, d_table[:, :WORD_SIZE])
                for dim in range(GRAM_SIZE):
                    np.add.at(g["gram"][:, dim], source[:, dim], d_table[:, WORD_SIZE + dim])
                g["word"][0] = g["gram"][BUCKETS] = 0
                step += 1
                for name, value in g.items():
                    mean, square = moments[name]
                    mean += 0.1 * (value - mean)
                    square += 0.01 * (value * value - square)
                    fast = mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
                    self.p[name] -= rate * fast

    # scoring

    def gates(self, words: list[bytes]) -> np.ndarray:
        """What each word adds to the gates of both directions, in single precision."""
        out = np.empty((len(words), 2, 3 * HIDDEN), np.float32)
        start = size = 0
        for at, word in enumerate(words):
            size += len(word) + 2
            if size >= GRAM_BYTES or at + 1 == len(words):
                x = self.inputs(words[start : at + 1])[0]
                for d in (0, 1):
                    out[start : at + 1, d] = x @ self.p["w"][d] + self.p["b"][d]
                start, size = at + 1, 0
        return out

    @staticmethod
    def padding() -> np.ndarray:
        """The gates of a step without a word: the state stays as it is."""
        row = np.zeros((1, 2, 3 * HIDDEN), np.float32)
        row[..., :HIDDEN] = 60
        return row

    def logits(self, table: np.ndarray, index: np.ndarray, window: int) -> np.ndarray:
        """Logits of the `window` words (fewer at the end) from every step of runs on.

        `index`: run, step; rows of `table`, whose row 0 is `padding()` and stands after a run's
        words. The result has the steps first. A window without words has the logit of no input.
        """
        u = self.p["u"].astype(np.float32)
        size, steps = index.shape
        h = np.zeros((2, size, HIDDEN), np.float32)
        states = np.empty((steps, size, 2 * HIDDEN), np.float32)
        a = np.empty((2, size, 3 * HIDDEN), np.float32)
        for t in range(steps):
            a[0] = table[index[:, t], 0]
            a[1] = table[index[:, steps - 1 - t], 1]
            v = h @ u
            zr = np.tanh(np.float32(0.5) * (a[..., : 2 * HIDDEN] + v[..., : 2 * HIDDEN]))
            zr = np.float32(0.5) * zr + np.float32(0.5)
            n = np.tanh(a[..., 2 * HIDDEN :] + zr[..., HIDDEN:] * v[..., 2 * HIDDEN :])
            h = n + zr[..., :HIDDEN] * (h - n)
            states[t, :, :HIDDEN] = h[0]
            states[steps - 1 - t, :, HIDDEN:] = h[1]
        real = (index != 0).T
        weight = states @ self.p["attend"].astype(np.float32)
        top = np.where(real, weight, -np.inf).max(axis=0, initial=-1e9)
        weight = np.where(real, np.exp(np.clip(weight - top, -80, 0)), 0)
        each = states @ self.p["out"].astype(np.float32)
        total = sliding_sums(weight, window)
        found = np.zeros_like(total)
        np.divide(sliding_sums(weight * each, window), total, out=found, where=total > 0)
        return found + np.float32(self.p["bias"][0])
