"""A small causal self-attention model over subword ids, in numpy.

The inputs are ids 0 .. V (V: padding); each predicts the next.  One head attends
to the window's earlier inputs and the input itself, with a learned bias for each
distance.  What it gathers shifts the logits of a two-level softmax, first over
classes of ids, then over the ids of the class; the logits start from the
input's row of a table of log bigram probabilities.

For scoring, windows overlap: each has CONTEXT inputs that only give context, then
STRIDE inputs whose next ids are scored, so each id is scored once.  Training
windows lie side by side and score all their ids.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

CONTEXT, STRIDE = 8, 24
WINDOW = CONTEXT + STRIDE
CLASSES = MEMBERS = 56
VOCABULARY = CLASSES * MEMBERS
PAD = VOCABULARY
WIDTH = 16
MASKED = -1e4
FLOAT = np.float32


@dataclass
class Weights:
    """Tables by id for queries, keys and values, biases by distance, and the
    maps from what is gathered to classes and to members of each class."""

    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    near: np.ndarray
    to_class: np.ndarray
    to_member: np.ndarray

    @staticmethod
    def fresh(seed: int = 11) -> Weights:
        rng = np.random.default_rng(seed)
        table = lambda: rng.normal(0, 0.3, (VOCABULARY + 1, WIDTH)).astype(FLOAT)
        return Weights(table(), table(), table(), np.zeros(WINDOW, FLOAT), np.zeros((WIDTH, CLASSES), FLOAT), np.zeros((CLASSES, WIDTH, MEMBERS), FLOAT))

    def arrays(self) -> list[np.ndarray]:
        return [self.query, self.key, self.value, self.near, self.to_class, self.to_member]


def bigram_tables(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of the next id's class (V + 1, CLASSES), and of the id
    within its class (V + 1, CLASSES, MEMBERS), from counts of pairs (V, V).
    Each row backs off to single counts by its number of different successors."""
    single = pairs.sum(0).astype(np.float64) + 0.5
    single /= single.sum()
    total, kinds = pairs.sum(1, dtype=np.float64), (pairs > 0).sum(1)
    out = np.empty((VOCABULARY + 1, VOCABULARY), FLOAT)
    for i in range(VOCABULARY):
        out[i] = (pairs[i] + (kinds[i] + 1) * single) / (total[i] + kinds[i] + 1)
    out[VOCABULARY] = single
    out = out.reshape(-1, CLASSES, MEMBERS)
    classes = out.sum(2)
    members = out
    members /= classes[:, :, None]
    return np.log(classes), np.log(members, out=members)


def windows(sequences: list[np.ndarray], context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sequences of ids, each ended by id 0: the windows' inputs, the ids to
    score (-1: none) after ``context`` others, and each window's sequence.  A
    sequence's first input is id 0; before it comes padding."""
    stride = WINDOW - context
    counts = np.array([-(-len(s) // stride) for s in sequences], np.int64)
    size = np.where(counts > 0, counts * stride + context, 0)
    start = np.cumsum(size) - size
    x, y = np.full(int(size.sum()), PAD, np.int32), np.full(int(size.sum()), -1, np.int32)
    for s, a in zip(sequences, start + context):
        if len(s):
            x[a] = 0
            x[a + 1 : a + len(s)] = s[:-1]
            y[a : a + len(s)] = s
    owner = np.repeat(np.arange(len(sequences)), counts)
    first = np.repeat(start, counts) + stride * (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts))
    at = first[:, None] + np.arange(WINDOW)
    return x[at], y[at[:, context:]], owner


def distance_bias(near: np.ndarray, context: int = CONTEXT) -> np.ndarray:
    """(WINDOW - context, WINDOW): the bias of each input for each scored place;
    later inputs are masked."""
    d = np.arange(context, WINDOW)[:, None] - np.arange(WINDOW)
    return np.where(d >= 0, near[np.maximum(d, 0)], MASKED).astype(FLOAT)


def steady(w: Weights) -> bool:
    """Whether no logit can be so large that its exponential overflows, so that
    maxima need not be taken off."""
    top = lambda a: float(np.abs(a).max(initial=0))
    scores = WIDTH**0.5 * top(w.query) * top(w.key) + top(w.near)
    shift = top(w.value) * max(float(np.abs(w.to_class).sum(0).max()), float(np.abs(w.to_member).sum(1).max()))
    return max(scores, shift) < 60


def exponentials(z: np.ndarray, calm: bool) -> np.ndarray:
    """exp(z) in place, up to a factor for each row of the last axis."""
    if not calm:
        z -= z.max(-1, keepdims=True)
    return np.exp(z, out=z)


def fused(w: Weights) -> np.ndarray:
    """The three tables side by side, and a column of ones, so that one matrix
    product gives both what is gathered and the sum of weights.  Padding has
    zeros there and so counts for nothing."""
    value = np.concatenate((w.value, np.ones((VOCABULARY + 1, 1), FLOAT)), 1)
    value[PAD] = 0
    return np.concatenate((w.query * FLOAT(WIDTH**-0.5), w.key, value), 1)


def gathered(table: np.ndarray, bias: np.ndarray, x: np.ndarray, calm: bool) -> np.ndarray:
    """What each scored place gathers."""
    g = table.take(x, 0)
    s = g[:, CONTEXT:, :WIDTH] @ g[:, :, WIDTH : 2 * WIDTH].transpose(0, 2, 1)
    s += bias
    if not calm:
        s[np.broadcast_to((x == PAD)[:, None, :], s.shape)] = -np.inf  # its key must not set the maximum
    with np.errstate(invalid="ignore"):  # places without an id to score
        exponentials(s, calm)
    h = (s @ g[:, :, 2 * WIDTH :]).reshape(-1, WIDTH + 1)
    return h[:, :WIDTH] / h[:, WIDTH:]


def log_probabilities(w: Weights, table: np.ndarray, bias: np.ndarray, log_class: np.ndarray, log_member: np.ndarray, x: np.ndarray, y: np.ndarray, calm: bool | None = None) -> np.ndarray:
    """Natural log of the probability of each id to score; 0 where there is
    none.  ``table``: the weights fused."""
    calm = steady(w) if calm is None else calm
    h = gathered(table, bias, x, calm)
    flat, last = y.ravel(), x[:, CONTEXT:].ravel()
    out = np.zeros(len(flat))
    which, member = np.divmod(flat, MEMBERS)
    # Both levels are done class by class of the target, rows in that order; places without one come first.
    order = np.argsort(which.astype(np.int8), kind="stable")[np.count_nonzero(flat < 0) :]
    which, member, last, h = which[order], member[order], last[order], h.take(order, 0)
    ones_c, ones_m = np.ones(CLASSES, FLOAT), np.ones(MEMBERS, FLOAT)
    z = h @ w.to_class
    z += log_class.take(last, 0)
    if not calm:
        z -= z.max(1, keepdims=True)
    lp = z[np.arange(len(z)), which].astype(np.float64)
    np.exp(z, out=z)
    lp -= np.log(z @ ones_c)
    rows = log_member.reshape(-1, MEMBERS)
    ends = np.searchsorted(which, np.arange(CLASSES + 1))
    for c in np.flatnonzero(np.diff(ends)):
        a, b = ends[c], ends[c + 1]
        z = h[a:b] @ w.to_member[c]
        z += rows.take(last[a:b] * CLASSES + c, 0)
        if not calm:
            z -= z.max(1, keepdims=True)
        lp[a:b] += z[np.arange(b - a), member[a:b]]
        np.exp(z, out=z)
        lp[a:b] -= np.log(z @ ones_m)
    out[order] = lp
    return out.reshape(y.shape)


def gradients(w: Weights, bias: np.ndarray, log_class: np.ndarray, log_member: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss of the ids to score and its gradient, as ``Weights.arrays``."""
    calm, scale, context = steady(w), FLOAT(WIDTH**-0.5), WINDOW - y.shape[1]
    table = np.concatenate((w.query * scale, w.key, w.value), 1)
    g = table.take(x, 0)
    q, k, v = g[:, context:, :WIDTH], g[:, :, WIDTH : 2 * WIDTH], g[:, :, 2 * WIDTH :]
    s = q @ k.transpose(0, 2, 1)
    s += bias
    if context:
        s[:, :, :context] += np.where(x[:, None, :context] == PAD, FLOAT(MASKED), FLOAT(0))
    exponentials(s, calm)
    s /= (s @ np.ones(WINDOW, FLOAT))[:, :, None]
    h3 = s @ v
    flat, last = y.ravel(), x[:, context:].ravel()
    # Both levels are done class by class of the target, rows in that order; places without one come first.
    which = np.floor_divide(flat, MEMBERS)
    order = np.argsort(which.astype(np.int8), kind="stable")[np.count_nonzero(flat < 0) :]
    n = max(1, len(order))
    which, member, last, h = which[order], flat[order] % MEMBERS, last[order], h3.reshape(-1, WIDTH).take(order, 0)
    ones_c, ones_m, at = np.ones(CLASSES, FLOAT), np.ones(MEMBERS, FLOAT), np.arange(len(order))
    z = h @ w.to_class
    z += log_class.take(last, 0)
    exponentials(z, calm)
    total = z @ ones_c
    loss = np.log(total).sum() - np.log(z[at, which]).sum()
    z /= (total * n)[:, None]
    z[at, which] -= FLOAT(1 / n)
    g_class, dh = h.T @ z, z @ w.to_class.T
    g_member, rows = np.zeros_like(w.to_member), log_member.reshape(-1, MEMBERS)
    ends = np.searchsorted(which, np.arange(CLASSES + 1))
    for c in np.flatnonzero(np.diff(ends)):
        a, b = ends[c], ends[c + 1]
        z = h[a:b] @ w.to_member[c]
        z += rows.take(last[a:b] * CLASSES + c, 0)
        exponentials(z, calm)
        total = z @ ones_m
        mine = (at[: b - a], member[a:b])
        loss += np.log(total).sum() - np.log(z[mine]).sum()
        z /= (total * n)[:, None]
        z[mine] -= FLOAT(1 / n)
        g_member[c] = h[a:b].T @ z
        dh[a:b] += z @ w.to_member[c].T
    full = np.zeros((len(flat), WIDTH), FLOAT)
    full[order] = dh
    full = full.reshape(h3.shape)
    back = np.zeros((*x.shape, 3 * WIDTH), FLOAT)
    back[:, :, 2 * WIDTH :] = s.transpose(0, 2, 1) @ full
    ds = full @ v.transpose(0, 2, 1)
    ds -= (full * h3).sum(2, keepdims=True)
    ds *= s
    back[:, context:, :WIDTH] = (ds @ k) * scale
    back[:, :, WIDTH : 2 * WIDTH] = ds.transpose(0, 2, 1) @ q
    d = np.arange(context, WINDOW)[:, None] - np.arange(WINDOW)
    g_near = np.bincount(np.maximum(d, 0).ravel(), (ds.sum(0) * (d >= 0)).ravel(), WINDOW).astype(FLOAT)
    # Rows of one id are added up next to each other.
    by_id = np.argsort(x.ravel().astype(np.uint16), kind="stable")
    ids = x.ravel()[by_id]
    starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    out = np.zeros((VOCABULARY + 1, 3 * WIDTH), FLOAT)
    out[ids[starts]] = np.add.reduceat(back.reshape(-1, 3 * WIDTH).take(by_id, 0), starts, 0)
    return float(loss) / n, [*(np.ascontiguousarray(out[:, i * WIDTH : (i + 1) * WIDTH]) for i in range(3)), g_near, g_class, g_member]


def batches_of(runs: Iterable[tuple[np.ndarray, np.ndarray]], batch: int, most: int, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of each run in a shuffled order; what is left of one goes on with
    the next.  A batch has ``batch`` windows, and as many more after each ten, up to
    ``most``."""
    rng, number, held = np.random.default_rng(seed), 0, None
    for x, y in runs:
        order, at = rng.permutation(len(x)), 0
        x, y = x[order], y[order]
        if held is not None:
            x, y = np.concatenate((held[0], x)), np.concatenate((held[1], y))
        while len(x) - at >= (size := min(max(batch, most), batch * (1 + number // 10)) if most else batch):
            yield x[at : at + size], y[at : at + size]
            at, number = at + size, number + 1
        held = x[at:].copy(), y[at:].copy()
    if held is not None and len(held[0]):
        yield held


def train_runs(w: Weights, log_class: np.ndarray, log_member: np.ndarray, runs: Iterable[tuple[np.ndarray, np.ndarray]], rate: float = 0.02, batch: int = 96, most: int = 0, seed: int = 1) -> tuple[Weights, float]:
    """One pass of Adam over the windows of all runs, one run in memory at a time."""
    values = [a.copy() for a in w.arrays()]
    first, second = [np.zeros_like(a) for a in values], [np.zeros_like(a) for a in values]
    losses = []
    for t, (x, y) in enumerate(batches_of(runs, batch, most, seed), 1):
        now = Weights(*values)
        loss, grads = gradients(now, distance_bias(now.near, WINDOW - y.shape[1]), log_class, log_member, x, y)
        losses.append(loss)
        step = rate * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        for a, g, m, s in zip(values, grads, first, second):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            a -= FLOAT(step) * m / (np.sqrt(s) + FLOAT(1e-6))
    return Weights(*values), float(np.mean(losses or [0.0]))


def train(w: Weights, log_class: np.ndarray, log_member: np.ndarray, x: np.ndarray, y: np.ndarray, rate: float = 0.02, batch: int = 96, seed: int = 1) -> tuple[Weights, float]:
    """One pass of Adam over the windows in a shuffled order."""
    return train_runs(w, log_class, log_member, [(x, y)], rate, batch, seed=seed)
