"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np

#: Character classes: 0 pads, 1 to 95 are printable ASCII, then the rest by kind.
CLASSES = 100


def classes(texts: list[str], length: int) -> np.ndarray:
    """Class of every character, padded or cut to ``length``."""
    out = np.zeros((len(texts), length), np.int64)
    for i, text in enumerate(texts):
        points = np.frombuffer(text[:length].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        own = np.where((points >= 32) & (points < 127), points - 31, 97)
        own[points < 32] = 96
        own[points >= 0x3000] = 98
        own[points >= 0x10000] = 99
        out[i, : len(own)] = own
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Tagger:
    """Weights: input and recurrent of both directions, output, transitions."""

    wx_f: np.ndarray
    wh_f: np.ndarray
    wx_b: np.ndarray
    wh_b: np.ndarray
    wo: np.ndarray
    bo: np.ndarray
    trans: np.ndarray
    allowed: np.ndarray

    @staticmethod
    def new(hidden: int, allowed: np.ndarray, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        tags = len(allowed)

        def weights(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(hidden), shape).astype(np.float32)

        wx = [weights(CLASSES, 4 * hidden) for _ in range(2)]
        for w in wx:
            w[:, hidden : 2 * hidden] += 1  # Remember at first.
        return Tagger(
            wx[0], weights(hidden, 4 * hidden), wx[1], weights(hidden, 4 * hidden),
            weights(2 * hidden, tags), np.zeros(tags, np.float32),
            np.zeros((tags, tags), np.float32), allowed.astype(np.float32),
        )

    def _run(self, x: np.ndarray, wx: np.ndarray, wh: np.ndarray, keep: list | None) -> np.ndarray:
        n, steps = x.shape
        hidden = len(wh)
        h = np.zeros((n, hidden), np.float32)
        c = np.zeros((n, hidden), np.float32)
        out = np.empty((n, steps, hidden), np.float32)
        for t in range(steps):
            z = wx[x[:, t]] + h @ wh
            gates = _sigmoid(z[:, : 3 * hidden])
            g = np.tanh(z[:, 3 * hidden :])
            i, f, o = np.split(gates, 3, axis=1)
            before = c
            c = f * c + i * g
            u = np.tanh(c)
            if keep is not None:
                keep.append((i, f, o, g, before, u, h))
            h = o * u
            out[:, t] = h
        return out

    def scores(self, x: np.ndarray, keep: tuple[list, list] | None = None) -> np.ndarray:
        """Score of every tag at every character."""
        forward = self._run(x, self.wx_f, self.wh_f, keep and keep[0])
        backward = self._run(x[:, ::-1], self.wx_b, self.wh_b, keep and keep[1])[:, ::-1]
        both = np.concatenate([forward, backward], axis=2)
        if keep is not None:
            keep[0].insert(0, both)
        return both @ self.wo + self.bo

    def _steps(self) -> np.ndarray:
        return np.where(self.allowed > 0, self.trans, np.float32(-1e4))

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of every window (Viterbi), and how far each beats tag 0."""
        e = self.scores(x)
        n, steps, tags = e.shape
        trans = self._steps()
        best = e[:, 0] + trans[0]  # A window starts as if after tag 0.
        back = np.empty((n, steps, tags), np.int64)
        for t in range(1, steps):
            total = best[:, :, None] + trans
            back[:, t] = total.argmax(1)
            best = np.take_along_axis(total, back[:, t][:, None], 1)[:, 0] + e[:, t]
        out = np.empty((n, steps), np.int64)
        out[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            out[:, t - 1] = back[np.arange(n), t, out[:, t]]
        margin = np.take_along_axis(e, out[:, :, None], 2)[:, :, 0] - e[:, :, 0]
        return out, margin

    def _crf_gradient(self, e: np.ndarray, gold: np.ndarray):
        """Gradients of the negative log likelihood by scores and transitions."""
        n, steps, tags = e.shape
        trans = self._steps()
        peak = trans.max()
        step = np.exp(trans - peak)
        alpha = np.empty_like(e)
        beta = np.ones_like(e)
        local = np.exp(e - e.max(2, keepdims=True))
        alpha[:, 0] = local[:, 0] * step[0]
        alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
        for t in range(1, steps):
            a = (alpha[:, t - 1] @ step) * local[:, t]
            alpha[:, t] = a / a.sum(1, keepdims=True)
        pairs = np.zeros_like(trans)
        for t in range(steps - 1, 0, -1):
            b = (local[:, t] * beta[:, t]) @ step.T
            joint = alpha[:, t - 1][:, :, None] * step * (local[:, t] * beta[:, t])[:, None]
            pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            beta[:, t - 1] = b / b.sum(1, keepdims=True)
        de = alpha * beta
        de /= de.sum(2, keepdims=True)
        pairs[0] += de[:, 0].sum(0)
        de[np.arange(n)[:, None], np.arange(steps), gold] -= 1
        np.add.at(pairs, (gold[:, :-1], gold[:, 1:]), -1)
        np.add.at(pairs[0], gold[:, 0], -1)
        return de / n, pairs * (self.allowed > 0) / n

    def _back(self, x, dh_all, wx, wh, kept):
        n, steps, hidden = dh_all.shape
        dz_all = np.empty((n, steps, 4 * hidden), np.float32)
        dwh = np.zeros_like(wh)
        dh = np.zeros((n, hidden), np.float32)
        dc = np.zeros((n, hidden), np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, o, g, before, u, h_before = kept[t]
            dh = dh + dh_all[:, t]
            dc = dc + dh * o * (1 - u * u)
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * u * o * (1 - o),
                 dc * i * (1 - g * g)], axis=1,
            )
            dz_all[:, t] = dz
            dwh += h_before.T @ dz
            dh = dz @ wh.T
            dc = dc * f
        order = np.argsort(x.ravel(), kind="stable")
        own = x.ravel()[order]
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        dwx = np.zeros_like(wx)
        dwx[own[start]] = np.add.reduceat(dz_all.reshape(-1, 4 * hidden)[order], start, axis=0)
        return dwx, dwh

    def gradients(self, x: np.ndarray, gold: np.ndarray) -> dict[str, np.ndarray]:
        keep: tuple[list, list] = ([], [])
        e = self.scores(x, keep)
        both = keep[0].pop(0)
        de, dtrans = self._crf_gradient(e, gold)
        dboth = de @ self.wo.T
        hidden = len(self.wh_f)
        f = self._back(x, dboth[:, :, :hidden], self.wx_f, self.wh_f, keep[0])
        b = self._back(x[:, ::-1], dboth[:, ::-1, hidden:], self.wx_b, self.wh_b, keep[1])
        return {
            "wx_f": f[0], "wh_f": f[1], "wx_b": b[0], "wh_b": b[1],
            "wo": both.reshape(-1, 2 * hidden).T @ de.reshape(-1, de.shape[2]),
            "bo": de.sum((0, 1)), "trans": dtrans,
        }


def train(
    x: np.ndarray, gold: np.ndarray, allowed: np.ndarray, hidden: int = 16, epochs: int = 6,
    batch: int = 64, rate: float = 0.01, seed: int = 0,
) -> Tagger:
    """A tagger fitted by Adam to windows ``x`` and their tags."""
    tagger = Tagger.new(hidden, allowed, seed)
    rng = np.random.default_rng(seed)
    names = [f.name for f in fields(Tagger) if f.name != "allowed"]
    mean = {k: np.zeros_like(getattr(tagger, k)) for k in names}
    square = {k: np.zeros_like(getattr(tagger, k)) for k in names}
    step, total = 0, epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            part = order[at : at + batch]
            step += 1
            now = rate * min(1, 2 * (1 - step / (total + 1)))
            for k, g in tagger.gradients(x[part], gold[part]).items():
                g = np.clip(g, -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                m, v = mean[k] / (1 - 0.9**step), square[k] / (1 - 0.99**step)
                setattr(tagger, k, (getattr(tagger, k) - now * m / (np.sqrt(v) + 1e-8)).astype(np.float32))
    return tagger
