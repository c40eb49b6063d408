"""Weak supervision: a generative model of overlapping voters, a linear model.

Votes are 0 (abstain), 1 (class 0) or 2 (class 1). Documents with equal votes
are interchangeable, so the model is fitted on the counted vote patterns: a
table whose size depends on the voters and not on the number of documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EM_ROUNDS = 60
#: Pseudo-votes that keep estimated probabilities away from 0 and 1.
SMOOTH = 1.0


@dataclass
class LabelModel:
    prior: float  # of class 1
    tables: np.ndarray  # voters x classes x votes: P(vote | class)
    weight: np.ndarray  # voters: 1 if independent of the rest, less if correlated

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(class 1) for rows of votes."""
        logs = np.zeros((len(votes), 2)) + np.log([1 - self.prior, self.prior])
        for v in range(votes.shape[1]):
            says = np.log(self.tables[v] / self.tables[v][:, 1:].sum(axis=1, keepdims=True))
            says[:, 0] = 0  # to abstain is no evidence
            logs += self.weight[v] * says[:, votes[:, v]].T
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -60, 60)))

    def accuracy(self) -> np.ndarray:
        """Of each voter where it votes."""
        share = np.array([1 - self.prior, self.prior])
        right = share[0] * self.tables[:, 0, 1] + share[1] * self.tables[:, 1, 2]
        return right / np.maximum((share[None, :, None] * self.tables[:, :, 1:]).sum(axis=(1, 2)), 1e-12)


def _maximise(votes: np.ndarray, counts: np.ndarray, q: np.ndarray) -> np.ndarray:
    tables = np.empty((votes.shape[1], 2, 3))
    for c, weight in ((0, counts * (1 - q)), (1, counts * q)):
        for v in range(votes.shape[1]):
            n = np.bincount(votes[:, v], weight, 3) + SMOOTH
            tables[v, c] = n / n.sum()
    return tables


def _weights(votes: np.ndarray, counts: np.ndarray, q: np.ndarray) -> np.ndarray:
    """1 / (1 + sum of a voter's correlations with the others within classes),
    in parts of the largest."""
    signs, total = np.array([0.0, -1.0, 1.0])[votes], np.zeros((votes.shape[1],) * 2)
    for weight in (counts * (1 - q), counts * q):
        if weight.sum() < 2:
            continue
        centred = signs - np.average(signs, axis=0, weights=weight)
        cov = (centred * weight[:, None]).T @ centred / weight.sum()
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        total += weight.sum() * np.abs(cov / np.outer(sd, sd))
    corr = total / max(counts.sum(), 1e-9)
    np.fill_diagonal(corr, 0)
    weight = 1 / (1 + corr.sum(axis=1))
    return weight / weight.max()


def fit_label_model(votes: np.ndarray, counts: np.ndarray, prior: float, correlated: bool = False, start: tuple[float, float] = (0.8, 0.8), fixed_prior: bool = False, most_false: float = 1.0) -> LabelModel:
    """EM over counted patterns. It starts from voters that give class 0 and
    class 1 their votes with the two probabilities of ``start``.

    With ``correlated``, all voters count for less at first; then correlations
    within the classes are estimated from the posteriors and discount voters
    that repeat each other, and EM goes on with those weights. ``most_false`` is
    the largest share of its votes that a voter may give to class 0 on documents
    of class 1: without it, documents with one kind of fault can make up a class
    and those with another kind fall to the rest. No pattern at all gives the
    starting model.
    """
    n_voters = votes.shape[1]
    of_zero, of_one = start
    tables = np.tile(np.array([[[0.2, 0.8 * of_zero, 0.8 * (1 - of_zero)], [0.2, 0.8 * (1 - of_one), 0.8 * of_one]]]), (n_voters, 1, 1))
    model = LabelModel(min(max(prior, 1e-3), 1 - 1e-3), tables, np.full(n_voters, 1 / np.sqrt(n_voters)) if correlated else np.ones(n_voters))
    if not len(votes) or not counts.sum():
        return model
    for k in range(EM_ROUNDS):
        q = model.posterior(votes)
        if correlated and k == EM_ROUNDS * 2 // 3:
            model.weight = _weights(votes, counts, q)
        model.tables = _maximise(votes, counts, q)
        if most_false < 1:
            voting = model.tables[:, 1, 1:].sum(axis=1)
            zero = np.minimum(model.tables[:, 1, 1], voting * most_false)
            model.tables[:, 1, 1], model.tables[:, 1, 2] = zero, voting - zero
        if not fixed_prior:
            model.prior = float(np.clip((counts * q).sum() / counts.sum(), 1e-3, 1 - 1e-3))
    return model


def fit_linear(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, target: np.ndarray, size: int, l2: float = 1e-4, rounds: int = 300, rate: float = 0.2) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse rows with soft targets (Adam, full batch)."""
    w, bias = np.zeros(size), 0.0
    n = len(target)
    if not n:
        return w, bias
    m, s, mb, sb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = bias + np.bincount(rows, values * w[cols], n)
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / n
        g = np.bincount(cols, values * error[rows], size) + l2 * w / max(1, n) ** 0.5
        gb = error.sum()
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        mb, sb = 0.9 * mb + 0.1 * gb, 0.99 * sb + 0.01 * gb * gb
        fix, fix2 = 1 - 0.9**t, 1 - 0.99**t
        w -= rate * (m / fix) / (np.sqrt(s / fix2) + 1e-8)
        bias -= rate * (mb / fix) / (np.sqrt(sb / fix2) + 1e-8)
    return w, float(bias)
