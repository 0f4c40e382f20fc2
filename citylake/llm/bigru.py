"""Bidirectional gated recurrent network over bytes, in numpy, trained by backpropagation through time.

A byte's share in the gates is a table lookup, so a step is one small matrix product per direction. The first axis
of all weights and states is the direction; the second direction reads a window from its end. Every position of a
window gets the probabilities of all classes from the states of both directions there.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from citylake.llm.common import ship

# Probabilities (positions of windows times classes) that a worker holds at once.
BLOCK_CELLS = 4 * 1024 * 1024

ship(__name__)


@dataclass
class Weights:
    """``table`` (2, 256, 3H), ``hidden`` (2, H, 3H), ``bias`` (2, H), ``out`` (2, H, K), ``out_bias`` (K)."""

    table: object
    hidden: object
    bias: object
    out: object
    out_bias: object

    @classmethod
    def random(cls, size: int, classes: int, seed: int) -> Weights:
        import numpy as np

        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype("f4")
        return cls(draw(2, 256, 3 * size), draw(2, size, 3 * size), draw(2, size), draw(2, size, classes), draw(classes))

    def arrays(self) -> list:
        return [getattr(self, f.name) for f in fields(self)]


def _both_ways(windows):
    """(2, T, B) bytes: forward and from the end."""
    import numpy as np

    steps = windows.T
    return np.stack([steps, steps[::-1]])


def loss_and_gradients(w: Weights, windows, labels) -> tuple:
    """Mean cross-entropy over all positions of full windows (B, T), and its gradients."""
    import numpy as np

    x = _both_ways(windows)
    _, t_max, b = x.shape
    size = w.bias.shape[1]
    way = np.arange(2)[:, None]
    h = np.zeros((2, b, size), w.bias.dtype)
    kept, states = [], np.empty((2, t_max, b, size), w.bias.dtype)
    for t in range(t_max):
        a, g = w.table[way, x[:, t]], h @ w.hidden
        zr = 1 / (1 + np.exp(-(a[..., : 2 * size] + g[..., : 2 * size])))
        z, r = zr[..., :size], zr[..., size:]
        q = g[..., 2 * size :] + w.bias[:, None]
        n = np.tanh(a[..., 2 * size :] + r * q)
        kept.append((h, z, r, q, n))
        h = n + z * (h - n)
        states[:, t] = h
    back = states[1, ::-1]
    logits = states[0] @ w.out[0] + back @ w.out[1] + w.out_bias
    p = np.exp(logits - logits.max(-1, keepdims=True))
    p /= p.sum(-1, keepdims=True)
    at = np.arange(b)
    loss = -np.log(p[:, at, labels] + 1e-12).mean()

    p[:, at, labels] -= 1
    p /= t_max * b
    gradients = Weights(*[np.zeros_like(v) for v in w.arrays()])
    gradients.out_bias[:] = p.sum((0, 1))
    gradients.out[0] = np.einsum("tbh,tbk->hk", states[0], p)
    gradients.out[1] = np.einsum("tbh,tbk->hk", back, p)
    from_out = np.stack([p @ w.out[0].T, (p @ w.out[1].T)[::-1]])
    d_inputs = np.empty((2, t_max, b, 3 * size), w.bias.dtype)
    dh = np.zeros_like(h)
    for t in reversed(range(t_max)):
        before, z, r, q, n = kept[t]
        dh = dh + from_out[:, t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (before - n) * z * (1 - z)
        dr = dn * q * r * (1 - r)
        dq = dn * r
        d_inputs[:, t] = np.concatenate([dz, dr, dn], -1)
        dg = np.concatenate([dz, dr, dq], -1)
        gradients.hidden += before.transpose(0, 2, 1) @ dg
        gradients.bias += dq.sum(1)
        dh = dh * z + dg @ w.hidden.transpose(0, 2, 1)
    for d in range(2):
        flat, rows = x[d].ravel(), d_inputs[d].reshape(-1, 3 * size)
        order = np.argsort(flat, kind="stable")
        used, first = np.unique(flat[order], return_index=True)
        gradients.table[d][used] = np.add.reduceat(rows[order], first, axis=0)
    return loss, gradients


def train(windows, labels, classes: int, size: int = 8, steps: int = 400, batch: int = 256, rate: float = 0.03, seed: int = 7) -> Weights:
    """Fit by Adam on windows (N, T) of bytes; every batch draws the classes evenly."""
    import numpy as np

    rng, w = np.random.default_rng(seed), Weights.random(size, classes, seed)
    members = [np.flatnonzero(labels == k) for k in range(classes)]
    moment = [[np.zeros_like(v), np.zeros_like(v)] for v in w.arrays()]
    for step in range(1, steps + 1):
        chosen = np.array([rng.choice(members[k]) for k in rng.integers(0, classes, batch)])
        _, gradients = loss_and_gradients(w, windows[chosen], labels[chosen])
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradients.arrays()))
        now = rate * (1 - 0.95 * step / steps)
        for v, g, m in zip(w.arrays(), gradients.arrays(), moment):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            v -= now * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return w


class Reader:
    """Class probabilities of every position of windows of up to ``t_max`` bytes, many windows at a time."""

    def __init__(self, w: Weights):
        import numpy as np

        self.np = np
        size = w.bias.shape[1]
        # With signs and factors folded in, every gate is 1 / (1 + exp(s)); tanh(x) is 2 / (1 + exp(-2 x)) - 1.
        factor = np.r_[-np.ones(2 * size), -2 * np.ones(size)].astype("f4")
        self.table = np.ascontiguousarray(w.table * factor)
        self.hidden = np.ascontiguousarray(w.hidden * factor)
        self.bias, self.out, self.out_bias, self.size = -2 * w.bias, w.out, w.out_bias, size

    def _logits(self, d: int, steps, active):
        """(T, B, K) share of one direction; ``active[t]`` windows, the longest first, have a byte at step t."""
        np, size = self.np, self.size
        t_max, b = steps.shape
        result = np.zeros((t_max, b, self.out.shape[2]), "f4")
        h = np.zeros((b, size), "f4")
        a, g = np.empty((b, 3 * size), "f4"), np.empty((b, 3 * size), "f4")
        q, n = np.empty((b, size), "f4"), np.empty((b, size), "f4")
        for t in range(t_max):
            k = active[t]
            if not k:
                break
            ak, gk, hk, qk, nk = a[:k], g[:k], h[:k], q[:k], n[:k]
            np.take(self.table[d], steps[t, :k], axis=0, out=ak, mode="clip")
            np.matmul(hk, self.hidden[d], out=gk)
            gates = ak[:, : 2 * size]
            gates += gk[:, : 2 * size]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            np.add(gk[:, 2 * size :], self.bias[d], out=qk)
            qk *= gates[:, size:]
            qk += ak[:, 2 * size :]
            np.exp(qk, out=nk)
            nk += 1
            np.divide(2, nk, out=nk)
            nk -= 1
            hk -= nk
            hk *= gates[:, :size]
            hk += nk
            np.matmul(hk, self.out[d], out=result[t, :k])
        return result

    def positions(self, windows, lengths):
        """(T, B, K) probabilities for windows (B, T), longest first; past a window's length they mean nothing."""
        np = self.np
        t_max = windows.shape[1]
        at = np.arange(t_max)[:, None]
        active = (lengths[None, :] > at).sum(1)
        from_end = np.maximum(lengths[None, :] - 1 - at, 0)
        steps = np.ascontiguousarray(windows.T)
        with np.errstate(over="ignore"):
            p = self._logits(0, steps, active)
            backward = self._logits(1, np.take_along_axis(steps, from_end, 0), active)
        p += np.take_along_axis(backward, from_end[..., None], 0)
        p += self.out_bias
        p -= p.max(-1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(-1, keepdims=True)
        return p

    def pooled(self, texts: list[bytes], t_max: int = 256, block: int = 1024):
        """(N, K) mean over all positions of each text; texts are cut into windows that are read by themselves."""
        np = self.np
        block = max(1, min(block, BLOCK_CELLS // (t_max * len(self.out_bias))))
        sums = np.zeros((len(texts), len(self.out_bias)))
        sizes = np.array([len(x) for x in texts], "i8")
        counts = -(-sizes // t_max)
        owner = np.repeat(np.arange(len(texts)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        lengths = np.minimum(sizes[owner] - nth * t_max, t_max)
        data = np.frombuffer(b"".join(texts) + b"\0" * t_max, "u1")
        starts = (np.cumsum(sizes) - sizes)[owner] + nth * t_max
        order = np.argsort(-lengths, kind="stable")
        for i in range(0, len(order), block):
            some = order[i : i + block]
            n = lengths[some]
            windows = data[starts[some][:, None] + np.arange(n[0])]
            p = self.positions(windows, n)
            p[np.arange(n[0])[:, None] >= n[None, :]] = 0
            np.add.at(sums, owner[some], p.sum(0, dtype="f8"))
        return sums / np.maximum(sizes, 1)[:, None]
