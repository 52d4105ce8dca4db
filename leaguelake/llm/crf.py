"""A linear-chain conditional random field with two labels, over many sequences at once."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_LIMIT = 30.0


@dataclass
class Chains:
    """Sequences laid end to end in flat arrays, the longest first."""

    lengths: np.ndarray
    starts: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)

    def steps(self):
        """For each position: how many sequences are that long."""
        longest = int(self.lengths[0]) if len(self.lengths) else 0
        return enumerate(np.searchsorted(-self.lengths, -np.arange(1, longest + 1), "right"))


def odds(scores: np.ndarray, between: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds of label 1 at each token; their product is the marginal odds.

    scores: log-potential of label 1 against 0; between: 2 x 2 log-potentials from label to label.
    """
    rise = np.exp(np.clip(scores, -_LIMIT, _LIMIT))
    (t00, t01), (t10, t11) = np.exp(between)
    ahead, back = np.empty_like(rise), np.empty_like(rise)
    ends = chains.starts + chains.lengths - 1
    now = future = np.empty(0)
    for step, n in chains.steps():
        at = chains.starts[:n] + step
        now = rise[at] if step == 0 else rise[at] * (t01 + t11 * now[:n]) / (t00 + t10 * now[:n])
        ahead[at] = now
        at = ends[:n] - step
        if step == 0:
            future = np.ones(n)
        else:
            later = rise[at + 1] * future[:n]
            future = (t10 + t11 * later) / (t00 + t01 * later)
        back[at] = future
    return ahead, back


def marginals(scores: np.ndarray, between: np.ndarray, chains: Chains) -> np.ndarray:
    """Probability of label 1 at each token."""
    ahead, back = odds(scores, between, chains)
    both = ahead * back
    return both / (1 + both)


def _pairs(scores: np.ndarray, between: np.ndarray, ahead: np.ndarray, back: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Expected number of neighbours with each pair of labels. inner: tokens with one after them."""
    rise = np.exp(np.clip(scores, -_LIMIT, _LIMIT))[inner + 1] * back[inner + 1]
    table = np.empty((2, 2, len(inner)))
    for a, left in enumerate((1.0, ahead[inner])):
        for b, right in enumerate((1.0, rise)):
            table[a, b] = np.exp(between[a, b]) * left * right
    return (table / table.sum(axis=(0, 1))).sum(axis=2)


@dataclass
class Field:
    """Weights of hashed features of a token and of the words beside it, and of label changes."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    bias: float
    between: np.ndarray


def fit(
    features: np.ndarray, words: np.ndarray, labels: np.ndarray, chains: Chains, size: int,
    rounds: int = 80, step: float = 0.25, decay: float = 1e-3,
) -> Field:
    """Maximises the penalised likelihood by full-batch Adam.

    features: hashed features of each distinct word, the word itself first (below size); words: the distinct
    word at each token; labels: 0 or 1 at each token.
    """
    first = np.zeros(len(words), bool)
    first[chains.starts] = True
    inner = np.flatnonzero(~np.concatenate([first[1:], [True]]))
    y = labels.astype(np.float64)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (labels[inner], labels[inner + 1]), 1)
    weights = np.zeros(3 * size + 5)
    weights[3 * size] = -4.0
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    n, width = len(features), features.shape[1]
    for turn in range(1, rounds + 1):
        own, before, after = weights[:size], weights[size : 2 * size], weights[2 * size : 3 * size]
        between = weights[3 * size + 1 :].reshape(2, 2)
        scores = own[features].sum(axis=1)[words] + weights[3 * size]
        scores[inner + 1] += before[features[words[inner], 0]]
        scores[inner] += after[features[words[inner + 1], 0]]
        ahead, back = odds(scores, between, chains)
        both = ahead * back
        miss = both / (1 + both) - y
        slope = np.zeros_like(weights)
        by_word = np.bincount(words, miss, n)
        slope[:size] = np.bincount(features.ravel(), np.repeat(by_word, width), size)
        slope[size : 2 * size] = np.bincount(features[words[inner], 0], miss[inner + 1], size)
        slope[2 * size : 3 * size] = np.bincount(features[words[inner + 1], 0], miss[inner], size)
        slope[3 * size] = miss.sum()
        slope[3 * size + 1 :] = (_pairs(scores, between, ahead, back, inner) - seen_pairs).ravel()
        slope = slope / max(y.sum(), 1.0) + decay * weights
        mean += 0.1 * (slope - mean)
        square += 0.01 * (slope * slope - square)
        weights -= step * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-6)
    f32 = weights.astype(np.float32)
    return Field(
        f32[:size], f32[size : 2 * size], f32[2 * size : 3 * size], float(weights[3 * size]),
        weights[3 * size + 1 :].reshape(2, 2).copy(),
    )
