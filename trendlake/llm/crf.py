"""Two-state linear-chain conditional random fields in numpy: marginals of many
chains at once, training by Adam on the conditional log-likelihood, Viterbi."""

from __future__ import annotations

import numpy as np

def marginals(state: np.ndarray, starts: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward of many chains at once.

    ``state`` (items, 2) scores, chain c is rows starts[c]..starts[c+1];
    ``trans`` (2, 2).  Returns log-normalisers (chains), marginals (items, 2)
    and summed pair marginals (2, 2).  Chains advance together, longest first,
    so a step costs the chains that still have items."""
    lens = np.diff(starts)
    order = np.argsort(-lens, kind="stable")
    first, sizes = starts[:-1][order], lens[order]
    alive = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    fwd, bwd = np.zeros_like(state), np.zeros_like(state)
    for t, k in enumerate(alive):
        at = first[:k] + t
        if t == 0:
            fwd[at] = state[at]
        else:
            p = fwd[at - 1]
            fwd[at] = state[at] + np.stack([np.logaddexp(p[:, 0] + trans[0, y], p[:, 1] + trans[1, y]) for y in (0, 1)], 1)
    for t in range(len(alive) - 1, 0, -1):
        at = first[:alive[t]] + t
        q = state[at] + bwd[at]
        bwd[at - 1] = np.stack([np.logaddexp(trans[y, 0] + q[:, 0], trans[y, 1] + q[:, 1]) for y in (0, 1)], 1)
    some = lens > 0
    log_z = np.zeros(len(lens))
    ends = starts[1:][some] - 1
    log_z[some] = np.logaddexp(fwd[ends, 0], fwd[ends, 1])
    z = np.repeat(log_z, lens)[:, None]
    node = np.exp(fwd + bwd - z)
    inner = np.ones(len(state), bool)
    inner[starts[:-1][some]] = False
    i = np.flatnonzero(inner)
    pair = np.zeros((2, 2))
    for y in (0, 1):
        for v in (0, 1):
            pair[y, v] = np.exp(fwd[i - 1, y] + trans[y, v] + state[i, v] + bwd[i, v] - z[i, 0]).sum()
    return log_z, node, pair


def _walk(state: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Forward scores (items, 2) of one chain in about 2 sqrt(n) vector steps: the
    items after the first are cut into blocks that advance side by side, first as
    transfer matrices (entered in y, now in v), then from their true entries."""
    rest = state[1:]
    width = max(1, int(np.ceil(np.sqrt(len(rest)))))
    blocks = -(-len(rest) // width)
    grid = np.zeros((blocks * width, 2))
    grid[:len(rest)] = rest
    grid = grid.reshape(blocks, width, 2)
    matrix = np.repeat(np.where(np.eye(2, dtype=bool), 0.0, -np.inf)[None], blocks, 0)
    for t in range(width):
        matrix = np.stack([np.logaddexp(matrix[:, :, 0] + trans[0, v], matrix[:, :, 1] + trans[1, v])
                           + grid[:, t, None, v] for v in (0, 1)], 2)
    now, at = np.empty((blocks, 2)), state[0]
    for b in range(blocks):
        now[b] = at
        at = np.logaddexp(at[0] + matrix[b, 0], at[1] + matrix[b, 1])
    out = np.empty((blocks, width, 2))
    for t in range(width):
        now = np.stack([np.logaddexp(now[:, 0] + trans[0, v], now[:, 1] + trans[1, v]) + grid[:, t, v] for v in (0, 1)], 1)
        out[:, t] = now
    return np.concatenate([state[:1], out.reshape(-1, 2)[:len(rest)]])


def long_marginals(state: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Marginals (items, 2) of one chain, as ``marginals`` gives them, for chains of many items."""
    total = _walk(state, trans) + _walk(state[::-1], trans.T)[::-1] - state
    return np.exp(total - np.logaddexp(total[:, 0], total[:, 1])[:, None])


def climb(x: np.ndarray, starts: np.ndarray, gold: np.ndarray, gold_pair: np.ndarray, steps: int, rate: float,
          l2: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights (features, 2), transitions (2, 2)) by Adam on the mean
    conditional log-likelihood of labelled chains."""
    w, tr = np.zeros((x.shape[1], 2)), np.zeros((2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(tr), np.zeros_like(tr)]
    for t in range(1, steps + 1):
        _, node, pair = marginals(x @ w, starts, tr)
        gw = x.T @ (gold - node) / len(x) - l2 * w
        gt = (gold_pair - pair) / len(x) - l2 * tr
        for k, g in ((0, gw), (2, gt)):
            state[k] = 0.9 * state[k] + 0.1 * g
            state[k + 1] = 0.999 * state[k + 1] + 0.001 * g * g
        w = w + rate * state[0] / (1 - 0.9 ** t) / (np.sqrt(state[1] / (1 - 0.999 ** t)) + 1e-8)
        tr = tr + rate * state[2] / (1 - 0.9 ** t) / (np.sqrt(state[3] / (1 - 0.999 ** t)) + 1e-8)
    return w, tr


def train(chains: list[tuple[np.ndarray, int]], steps: int = 600, rate: float = 0.1, l2: float = 1e-4,
          run_items: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Parameters from (features, label of all items) chains, long ones cut
    into runs of ``run_items``."""
    runs = [(x[k:k + run_items], y) for x, y in chains for k in range(0, len(x), run_items)]
    x = np.concatenate([r[0] for r in runs]).astype(np.float64)
    lens, labels = np.array([len(r[0]) for r in runs]), np.array([r[1] for r in runs])
    starts = np.concatenate([[0], np.cumsum(lens)])
    gold_pair = np.diag([float((lens[labels == k] - 1).sum()) for k in (0, 1)])
    return climb(x, starts, np.eye(2)[np.repeat(labels, lens)], gold_pair, steps, rate, l2)


def viterbi(state: np.ndarray, trans: np.ndarray) -> list[int]:
    """The most probable labels of one chain; ties go to label 0."""
    if not len(state):
        return []
    (a, b), back = state[0].tolist(), []
    t00, t01, t10, t11 = trans.ravel().tolist()
    for s0, s1 in state[1:].tolist():
        to0, to1 = (0 if a + t00 >= b + t10 else 1), (0 if a + t01 >= b + t11 else 1)
        back.append((to0, to1))
        a, b = (b + t10 if to0 else a + t00) + s0, (b + t11 if to1 else a + t01) + s1
    y = [0 if a >= b else 1]
    for step in reversed(back):
        y.append(step[y[-1]])
    return y[::-1]
