"""A character tagger: bidirectional LSTM with CRF transitions, in numpy, trained from labelled spans.

Tags are one outside tag and a begin and an inside tag for each kind. Training maximises the CRF's log-likelihood
with Adam on windows of invented text; decoding finds the best path and the posterior of each character's tag.
"""

from __future__ import annotations

import numpy as np

EMBED, HIDDEN, CLASSES = 12, 20, 128


def char_classes(text: str) -> np.ndarray:
    """ASCII characters are their own class; other letters share one, other digits and the rest one each."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = points.astype(np.int64)
    for i in np.flatnonzero(points >= 127):
        out[i] = 127 if chr(points[i]).isalpha() else 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Tagger:
    def __init__(self, kinds: tuple[str, ...], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.kinds, n = kinds, 1 + 2 * len(kinds)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.w = {"embed": rng.normal(0, 0.5, (CLASSES, EMBED)).astype(np.float32), "out": draw(2 * HIDDEN, n), "bias": np.zeros(n, np.float32), "move": np.zeros((n, n), np.float32), "start": np.zeros(n, np.float32)}
        for d in "fb":
            self.w |= {f"x{d}": draw(EMBED, 4 * HIDDEN), f"h{d}": draw(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.w[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1
        self.banned = np.zeros((n, n), np.float32)  # an inside tag follows only its own kind's tags
        for i in range(2, n, 2):
            self.banned[[j for j in range(n) if j not in (i, i - 1)], i] = -1e4
        self.first = np.where(np.arange(n) % 2 == 0, np.float32(-1e4), np.float32(0)) * (np.arange(n) > 0)

    def _lstm(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """x: steps, rows, features. Hidden states, and what the gradient needs."""
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        pre, out, kept = x @ self.w[f"x{d}"] + self.w[f"c{d}"], [], []
        for t in range(len(x)):
            z = pre[t] + h @ self.w[f"h{d}"]
            s = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g, before, last = np.tanh(z[:, 3 * HIDDEN :]), c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out.append(h)
            kept.append((i, f, o, g, before, tc, last))
        return np.stack(out), kept

    def _lstm_gradient(self, x: np.ndarray, kept: list, dh_out: np.ndarray, d: str, grad: dict) -> np.ndarray:
        dh = dc = np.zeros(dh_out.shape[1:], np.float32)
        dz_all = np.empty((*dh_out.shape[:2], 4 * HIDDEN), np.float32)
        for t in reversed(range(len(x))):
            i, f, o, g, before, tc, last = kept[t]
            dh = dh + dh_out[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)), 1)
            dz_all[t] = dz
            grad[f"h{d}"] += last.T @ dz
            dh, dc = dz @ self.w[f"h{d}"].T, dc * f
        grad[f"x{d}"] += np.einsum("tne,tnz->ez", x, dz_all)
        grad[f"c{d}"] += dz_all.sum((0, 1))
        return dz_all @ self.w[f"x{d}"].T

    def _scores(self, ids: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Tag scores (steps, rows, tags) of windows (rows, steps)."""
        x = self.w["embed"][ids.T]
        hf, kf = self._lstm(x, "f")
        hb, kb = self._lstm(x[::-1], "b")
        h = np.concatenate((hf, hb[::-1]), 2)
        return h @ self.w["out"] + self.w["bias"], (x, kf, kb, h)

    def _forward(self, s: np.ndarray) -> np.ndarray:
        move, a = self.w["move"] + self.banned, [self.w["start"] + self.first + s[0]]
        for t in range(1, len(s)):
            z = a[-1][:, :, None] + move
            m = z.max(1)
            a.append(m + np.log(np.exp(z - m[:, None]).sum(1)) + s[t])
        return np.stack(a)

    def _backward(self, s: np.ndarray) -> np.ndarray:
        move, b = self.w["move"] + self.banned, [np.zeros(s.shape[1:], np.float32)]
        for t in range(len(s) - 1, 0, -1):
            z = move + (b[-1] + s[t])[:, None, :]
            m = z.max(2)
            b.append(m + np.log(np.exp(z - m[:, :, None]).sum(2)))
        return np.stack(b[::-1])

    def _gradient(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        s, (x, kf, kb, h) = self._scores(ids)
        a, b = self._forward(s), self._backward(s)
        last = a[-1].max(1)
        total = last + np.log(np.exp(a[-1] - last[:, None]).sum(1))
        rows, y = np.arange(len(ids)), tags.T
        gold = (self.w["start"] + self.first)[y[0]] + sum(s[t, rows, y[t]] for t in range(len(s))) + sum((self.w["move"] + self.banned)[y[t - 1], y[t]] for t in range(1, len(s)))
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        n = len(ids)
        ds = np.exp(a + b - total[None, :, None])
        grad["start"] += ds[0].sum(0) / n
        move = self.w["move"] + self.banned
        for t in range(1, len(s)):
            p = np.exp(a[t - 1][:, :, None] + move + (s[t] + b[t])[:, None, :] - total[:, None, None])
            grad["move"] += p.sum(0) / n
            np.subtract.at(grad["move"], (y[t - 1], y[t]), 1 / n)
        np.subtract.at(grad["start"], y[0], 1 / n)
        for t in range(len(s)):
            ds[t, rows, y[t]] -= 1
        ds = (ds / n).astype(np.float32)
        grad["out"] += np.einsum("tnh,tnk->hk", h, ds)
        grad["bias"] += ds.sum((0, 1))
        dh = ds @ self.w["out"].T
        dx = self._lstm_gradient(x, kf, dh[:, :, :HIDDEN], "f", grad)
        dx += self._lstm_gradient(x[::-1], kb, dh[::-1, :, HIDDEN:], "b", grad)[::-1]
        np.add.at(grad["embed"], ids.T, dx)
        return float((total - gold).mean()), grad

    def train(self, ids: np.ndarray, tags: np.ndarray, steps: int, batch: int = 48, rate: float = 0.012, seed: int = 1) -> list[float]:
        """Adam on random batches of windows (rows, steps); the losses."""
        rng, losses = np.random.default_rng(seed), []
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        for step in range(1, steps + 1):
            some = rng.integers(0, len(ids), batch)
            loss, grad = self._gradient(ids[some], tags[some])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            pace = rate * min(1, 2 * (1 - (step - 1) / steps))
            for k, g in grad.items():
                g = g * min(1.0, 5 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.w[k] -= (pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return losses

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of windows (rows, steps), and the posterior probability of each."""
        return self.best(self.scores(ids))

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores (steps, rows, tags) of windows (rows, steps)."""
        return self._scores(ids)[0]

    def best(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (rows, steps) for tag scores (steps, rows, tags), and the posterior probability of each."""
        a, b = self._forward(s), self._backward(s)
        last = a[-1].max(1)
        total = last + np.log(np.exp(a[-1] - last[:, None]).sum(1))
        move, best, back = self.w["move"] + self.banned, self.w["start"] + self.first + s[0], []
        for t in range(1, len(s)):
            z = best[:, :, None] + move
            back.append(z.argmax(1))
            best = z.max(1) + s[t]
        rows, path = np.arange(s.shape[1]), [best.argmax(1)]
        for k in reversed(back):
            path.append(k[rows, path[-1]])
        tags = np.stack(path[::-1], 1)
        return tags, np.exp(np.take_along_axis(np.moveaxis(a + b - total[None, :, None], 0, 1), tags[:, :, None], 2)[:, :, 0])
