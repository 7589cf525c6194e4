"""The fitted model against a slow optimiser of the same objective."""

import numpy as np

from addrflow.llm import quality as Q


def _objective(w, t, x, y, weight):
    """Weighted mean negative log-likelihood of cumulative logits, and the L1 penalty; y in 0..GRADES-1."""
    s = x @ w
    tail = 1 / (1 + np.exp(-(s[:, None] - t[None, :])))
    tail = np.concatenate([np.ones((len(y), 1)), tail, np.zeros((len(y), 1))], 1)
    n = np.arange(len(y))
    return (weight * -np.log(np.maximum(tail[n, y] - tail[n, y + 1], 1e-12))).mean() + Q.SPARSE * np.abs(w).sum()


def _slow(x, y, weight):
    """Coordinate search with shrinking steps: no gradients, nothing in common with the fit."""
    w, t = np.zeros(x.shape[1]), np.sort(np.linspace(-1, 1, Q.GRADES - 1))
    best, step = _objective(w, t, x, y, weight), 1.0
    while step > 1e-4:
        moved = False
        for k in range(len(w) + len(t)):
            for d in (-step, step):
                v, u = w.copy(), t.copy()
                (v if k < len(w) else u)[k if k < len(w) else k - len(w)] += d
                if (np.diff(u) >= 1e-2).all() and (f := _objective(v, u, x, y, weight)) < best - 1e-12:
                    w, t, best, moved = v, u, f, True
        step = step if moved else step / 2
    return w, t, best


def test_the_fit_is_near_the_optimum():
    rng = np.random.default_rng(3)
    n, d = 900, 6
    x = rng.random((n, d)) < 0.35
    truth = np.array([2.0, -2.0, 1.2, -1.5, 0.9, 0.0])
    s = x @ truth + rng.logistic(size=n)
    y = (s > -0.8).astype(int) + (s > 0.7)
    keys = np.sort(rng.integers(1, 2**62, d)).astype(np.uint64)
    rows = [keys[r] for r in x]
    model = Q.fit(y, rows, sigmas=0.0)
    rare = np.bincount(y, minlength=Q.GRADES)
    rare = np.sqrt(rare.max() / np.maximum(1, rare))
    w, t, best = _slow(x.astype(float), y, rare[y])

    assert (np.diff(model.thresholds) > 0).all() and (np.diff(t) > 0).all()
    got = np.zeros(d)
    got[np.searchsorted(keys, model.keys)] = model.weights
    assert _objective(got, model.thresholds, x.astype(float), y, rare[y]) <= best + 0.02
    own = model.tails(np.array([model.score(r) for r in rows]))
    tail = 1 / (1 + np.exp(-((x @ w)[:, None] - t[None, :])))
    # The fit's last steps are still noisy.
    assert np.abs(own - tail).mean() < 0.04 and np.abs(own - tail).max() < 0.2
    assert ((own[:, -1] >= Q.KEEP) == (tail[:, -1] >= Q.KEEP)).mean() > 0.9


def test_ratings_without_a_telling_feature():
    """No weights: every document gets the same tails, and the thresholds keep their order."""
    y = np.array([0, 1, 1, 2, 2, 2, 2, 2])
    model = Q.fit(y, [np.zeros(0, np.uint64)] * len(y))
    assert not len(model.keys) and (np.diff(model.thresholds) >= 0).all()
