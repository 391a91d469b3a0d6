"""A bidirectional gated recurrent network over bytes, in numpy.

It labels every byte of a text with class probabilities. Training is plain
backpropagation through time with Adam; labelling runs both directions in one
batched product a step, over sequences sorted by length so that no step touches
padding.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

F32 = np.float32


@dataclass
class Net:
    """Weights: inp (2, 256, 3H) gate inputs by direction and byte, rec (2, H, 3H), out (2H, C), bias (C). Gates in the order update, reset, new."""

    inp: np.ndarray
    rec: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @property
    def hidden(self) -> int:
        return self.rec.shape[1]

    def arrays(self) -> list[np.ndarray]:
        return [self.inp, self.rec, self.out, self.bias]


def fresh(hidden: int, classes: int, seed: int) -> Net:
    rng = np.random.default_rng(seed)
    inp = rng.normal(0, 0.5, (2, 256, 3 * hidden)).astype(F32)
    inp[:, :, :hidden] += 1.0  # update gates begin half closed, so that memory lasts
    rec = (rng.normal(0, 1, (2, hidden, 3 * hidden)) / np.sqrt(hidden)).astype(F32)
    return Net(inp, rec, rng.normal(0, 0.1, (2 * hidden, classes)).astype(F32), np.zeros(classes, F32))


class Batch:
    """Byte sequences, longest first, one after another in a flat array."""

    def __init__(self, texts: list[bytes]):
        self.order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        self.lengths = np.array([len(texts[i]) for i in self.order], np.int64)
        self.flat = np.frombuffer(b"".join(texts[i] for i in self.order), np.uint8)
        self.start = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64) if texts else np.zeros(0, np.int64)
        self.steps = int(self.lengths[0]) if texts else 0
        # sequences still running at each step
        self.live = np.searchsorted(-self.lengths, -np.arange(self.steps), side="left").tolist()

    def places(self, t: int, n: int) -> np.ndarray:
        """Flat positions read at step t by the n live sequences, forwards and backwards."""
        s = self.start[:n]
        return np.stack([s + t, s + self.lengths[:n] - 1 - t])


def states(net: Net, b: Batch, keep: bool = False) -> tuple[np.ndarray, list]:
    """(bytes, 2H) states of both directions at every byte; with keep, what the way back needs of every step."""
    hid = net.hidden
    flat = np.empty((2, len(b.flat), hid), F32)
    h = np.zeros((2, len(b.lengths), hid), F32)
    inp, rec = net.inp.copy(), net.rec.copy()
    inp[:, :, : 2 * hid] *= 0.5  # sigmoid(x) = (1 + tanh(x / 2)) / 2
    rec[:, :, : 2 * hid] *= 0.5
    trail = []
    for t in range(b.steps):
        n = b.live[t]
        at = b.places(t, n)
        byte = b.flat[at]
        x = np.stack([inp[0].take(byte[0], 0), inp[1].take(byte[1], 0)])
        prev = h[:, :n]
        g = np.matmul(prev, rec)
        zr = np.tanh(x[:, :, : 2 * hid] + g[:, :, : 2 * hid])
        zr += 1
        zr *= 0.5
        z, r = zr[:, :, :hid], zr[:, :, hid:]
        new = np.tanh(x[:, :, 2 * hid :] + r * g[:, :, 2 * hid :])
        if keep:
            trail.append((at, byte, prev.copy(), z, r, g[:, :, 2 * hid :], new))
        now = new + z * (prev - new)
        h[:, :n] = now
        flat[0, at[0]] = now[0]
        flat[1, at[1]] = now[1]
    return np.concatenate([flat[0], flat[1]], axis=1), trail


def softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def label_bytes(net: Net, texts: list[bytes]) -> list[np.ndarray]:
    """Class probabilities of every byte of every text."""
    b = Batch(texts)
    if not len(b.flat):
        return [np.zeros((0, len(net.bias)), F32) for _ in texts]
    p = softmax(states(net, b)[0] @ net.out + net.bias)
    out: list = [None] * len(texts)
    for i, s, n in zip(b.order, b.start.tolist(), b.lengths.tolist(), strict=True):
        out[i] = p[s : s + n]
    return out


def pool_bytes(net: Net, texts: list[bytes]) -> np.ndarray:
    """(texts, classes): the class probabilities of each text's bytes, summed."""
    b = Batch(texts)
    total = np.zeros((len(texts), len(net.bias)), F32)
    full = int((b.lengths > 0).sum())
    if full:
        p = softmax(states(net, b)[0] @ net.out + net.bias)
        total[np.array(b.order[:full])] = np.add.reduceat(p, b.start[:full], axis=0)
    return total


def gradients(net: Net, texts: list[bytes], labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all bytes and its gradients, by backpropagation through time."""
    b = Batch(texts)
    hid, n_bytes = net.hidden, len(b.flat)
    s, trail = states(net, b, keep=True)
    p = softmax(s @ net.out + net.bias)
    want = np.repeat(labels[np.array(b.order)], b.lengths)
    rows = np.arange(n_bytes)
    loss = float(-np.log(np.maximum(p[rows, want], 1e-9)).mean())
    p[rows, want] -= 1
    p /= n_bytes
    d_out, d_bias = s.T @ p, p.sum(axis=0)
    ds = p @ net.out.T
    ds = np.stack([ds[:, :hid], ds[:, hid:]])
    d_inp, d_rec = np.zeros_like(net.inp), np.zeros_like(net.rec)
    dh = np.zeros((2, len(b.lengths), hid), F32)
    back = net.rec.transpose(0, 2, 1).copy()
    all_gates, all_bytes = [], []
    for at, byte, prev, z, r, g_new, new in reversed(trail):
        n = prev.shape[1]
        d = dh[:, :n] + np.stack([ds[0, at[0]], ds[1, at[1]]])
        d_new = d * (1 - z) * (1 - new * new)
        d_z = d * (prev - new) * z * (1 - z)
        d_r = d_new * g_new * r * (1 - r)
        d_g = np.concatenate([d_z, d_r, d_new * r], axis=2)
        d_rec += np.matmul(prev.transpose(0, 2, 1), d_g)
        dh[:, :n] = d * z + np.matmul(d_g, back)
        all_gates.append(np.concatenate([d_z, d_r, d_new], axis=2))
        all_bytes.append(byte)
    for k in range(2):
        np.add.at(d_inp[k], np.concatenate([x[k] for x in all_bytes]), np.concatenate([x[k] for x in all_gates]))
    return loss, [d_inp, d_rec, d_out, d_bias]


def train(texts: list[bytes], labels: list[int], classes: int, hidden: int = 16, epochs: int = 6, batch: int = 64, rate: float = 0.02, seed: int = 7, net: Net | None = None) -> Net:
    """Adam with a linearly falling rate; every gradient is clipped to norm 1. The same input gives the same net."""
    net = net or fresh(hidden, classes, seed)
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.int64)
    m = [np.zeros_like(a) for a in net.arrays()]
    v = [np.zeros_like(a) for a in net.arrays()]
    total, step = max(1, epochs * -(-len(texts) // batch)), 0
    for _ in range(epochs):
        # sequences of like length share a batch, and the batches come in random order
        ids = np.array(sorted(rng.permutation(len(texts)).tolist(), key=lambda i: len(texts[i]) // 16))
        groups = [ids[i : i + batch] for i in range(0, len(ids), batch)]
        for k in rng.permutation(len(groups)):
            g = groups[k]
            _, grads = gradients(net, [texts[i] for i in g], y[g])
            norm = np.sqrt(sum(float((x * x).sum()) for x in grads))
            step += 1
            lr = rate * (1 - (step - 1) / total) + 1e-4
            for a, x, mm, vv in zip(net.arrays(), grads, m, v, strict=True):
                x = x * min(1.0, 1.0 / (norm + 1e-9))
                mm += 0.1 * (x - mm)
                vv += 0.01 * (x * x - vv)
                a -= (lr * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-6)).astype(F32)
    return net
