"""A small byte-level convolutional network, trained and applied in numpy.

Bytes are embedded, filters of several widths slide over a window, each filter's
largest response in the window is kept, and a dense layer follows. Gradients reach
only the winning positions, so a training step costs little more than scoring.
"""

from __future__ import annotations

import dataclasses

import numpy as np


@dataclasses.dataclass
class Shape:
    window: int = 256
    step: int = 224          # windows overlap by window - step bytes
    dim: int = 8
    widths: tuple[int, ...] = (3, 5)
    filters: int = 24        # of each width
    classes: int = 1
    pools: int = 1           # 2: mean and maximum over a document's windows


class Net:
    def __init__(self, shape: Shape, seed: int = 7):
        r = np.random.default_rng(seed)
        s = self.shape = shape
        n = s.filters * len(s.widths)
        self.p = {"emb": r.normal(0, 0.5, (257, s.dim)).astype(np.float32)}
        for w in s.widths:
            self.p[f"w{w}"] = r.normal(0, (w * s.dim) ** -0.5, (w * s.dim, s.filters)).astype(np.float32)
        self.p["cb"] = np.zeros(n, np.float32)
        self.p["out"] = r.normal(0, (n * s.pools) ** -0.5, (n * s.pools, s.classes)).astype(np.float32)
        self.p["ob"] = np.zeros(s.classes, np.float32)

    def cut(self, data: bytes) -> np.ndarray:
        """Windows over all bytes, the last one padded; one padded window for no bytes."""
        s = self.shape
        count = max(1, -(-(len(data) - s.window) // s.step) + 1) if len(data) > s.window else 1
        flat = np.full((count - 1) * s.step + s.window, 256, np.int16)
        flat[:len(data)] = np.frombuffer(data, np.uint8)
        return np.lib.stride_tricks.sliding_window_view(flat, s.window)[::s.step]

    def pooled(self, x: np.ndarray, keep: bool = False):
        """Largest response of every filter in every window (and where it was)."""
        s, parts, wins = self.shape, [], []
        e = self.p["emb"][x].reshape(len(x), -1)
        for w in s.widths:
            m = s.window - w + 1
            v = np.lib.stride_tricks.as_strided(e, (len(x), m, w * s.dim), (e.strides[0], 4 * s.dim, 4))
            z = v.reshape(-1, w * s.dim) @ self.p[f"w{w}"]
            z = z.reshape(len(x), m, -1)
            if keep:
                at = z.argmax(axis=1)
                wins.append(at)
                parts.append(np.take_along_axis(z, at[:, None], 1)[:, 0])
            else:
                parts.append(z.max(axis=1))
        h = np.maximum(np.concatenate(parts, axis=1) + self.p["cb"], 0)
        return (h, wins) if keep else h

    def features(self, windows: list[np.ndarray], chunk: int = 256) -> np.ndarray:
        """One row per document: the pooled responses of its windows, combined."""
        x = np.concatenate(windows)
        h = np.concatenate([self.pooled(x[i:i + chunk]) for i in range(0, len(x), chunk)])
        return self.combine(h, np.cumsum([0, *map(len, windows)]))

    def combine(self, h: np.ndarray, edge: np.ndarray) -> np.ndarray:
        mean = np.add.reduceat(h, edge[:-1], axis=0) / np.diff(edge)[:, None]
        return mean if self.shape.pools == 1 else np.concatenate([mean, np.maximum.reduceat(h, edge[:-1], axis=0)], axis=1)

    def probabilities(self, windows: list[np.ndarray]) -> np.ndarray:
        z = self.features(windows) @ self.p["out"] + self.p["ob"]
        if self.shape.classes == 1:
            return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def fit(self, docs: list[bytes], y: np.ndarray, epochs: int = 6, batch: int = 32, rate: float = 4e-3, weight: np.ndarray | None = None, seed: int = 3) -> None:
        """Adam on the cross entropy; ``y`` is 0/1 for one class, else class numbers."""
        r = np.random.default_rng(seed)
        s, windows = self.shape, [self.cut(d) for d in docs]
        weight = np.ones(len(y)) if weight is None else weight
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        t, total = 0, max(1, epochs * -(-len(docs) // batch))
        for _ in range(epochs):
            order = r.permutation(len(docs))
            for i in range(0, len(order), batch):
                pick = order[i:i + batch]
                w = [windows[k] for k in pick]
                g = self._gradient(w, y[pick], weight[pick])
                t += 1
                step = rate * min(1.0, 2 * (1 - t / (total + 1)))
                for k, d in g.items():
                    m1[k] = 0.9 * m1[k] + 0.1 * d
                    m2[k] = 0.99 * m2[k] + 0.01 * d * d
                    self.p[k] -= (step * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.99 ** t)) + 1e-7)).astype(np.float32)

    def _gradient(self, windows, y, weight) -> dict[str, np.ndarray]:
        s = self.shape
        x = np.concatenate(windows)
        edge = np.cumsum([0, *map(len, windows)])
        h, wins = self.pooled(x, keep=True)
        f = self.combine(h, edge)
        z = f @ self.p["out"] + self.p["ob"]
        if s.classes == 1:
            dz = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[:, None]
        else:
            dz = np.exp(z - z.max(axis=1, keepdims=True))
            dz /= dz.sum(axis=1, keepdims=True)
            dz[np.arange(len(y)), y] -= 1
        dz = (dz * weight[:, None] / len(y)).astype(np.float32)
        g = {"out": f.T @ dz + 1e-4 * self.p["out"], "ob": dz.sum(axis=0)}
        df = dz @ self.p["out"].T
        n = h.shape[1]
        doc = np.repeat(np.arange(len(y)), np.diff(edge))
        dh = df[doc, :n] / np.diff(edge)[doc][:, None]
        if s.pools == 2:
            top = h == f[doc, n:]
            first = np.cumsum(top, axis=0) - np.concatenate([np.zeros((1, n), int), np.cumsum(top, axis=0)])[edge[:-1]][doc] == 1
            dh = dh + df[doc, n:] * (top & first)
        dh = (dh * (h > 0)).astype(np.float32)
        g["cb"] = dh.sum(axis=0)
        g["emb"] = np.zeros_like(self.p["emb"])
        row = np.arange(len(x))[:, None]
        for k, (w, at) in enumerate(zip(s.widths, wins)):
            d = dh[:, k * s.filters:(k + 1) * s.filters]
            filt = self.p[f"w{w}"]
            gw = np.zeros_like(filt)
            for o in range(w):
                b = x[row, at + o]                     # the byte under tap o of each winner
                e = self.p["emb"][b]
                gw[o * s.dim:(o + 1) * s.dim] = np.einsum("nfd,nf->df", e, d)
                np.add.at(g["emb"], b.ravel(), (d[:, :, None] * filt[o * s.dim:(o + 1) * s.dim].T[None]).reshape(-1, s.dim))
            g[f"w{w}"] = gw
        return g
