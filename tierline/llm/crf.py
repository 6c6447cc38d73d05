"""Linear-chain conditional random fields in NumPy: fitted on a few labelled rows, decoded in batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Weight of the squared parameters against all rows, steps of the fit, and length of the first steps.
PENALTY, STEPS, RATE = 0.3, 150, 0.2


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Batch:
    """Labelled rows side by side, as long as the longest: labels, and the features of all places in one list."""

    def __init__(self, rows: Sequence[tuple[list[list[int]], list[int]]]):
        places = max((len(names) for names, _ in rows), default=1)
        self.length = np.array([len(names) for names, _ in rows])
        self.labels = np.zeros((len(rows), places), int)
        for i, (_, labels) in enumerate(rows):
            self.labels[i, : len(labels)] = labels
        each = [(i * places + j, x) for i, (names, _) in enumerate(rows) for j, x in enumerate(names) if x]
        self.place = np.array([at for at, _ in each])
        counts = np.array([len(x) for _, x in each])
        self.first = np.cumsum(counts) - counts
        self.owner = np.repeat(self.place, counts)
        self.features = np.array([f for _, x in each for f in x])
        self.inside = np.arange(places) < self.length[:, None]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        score = np.zeros((self.labels.size, weights.shape[1]))
        score[self.place] = np.add.reduceat(weights[self.features], self.first, axis=0)
        return score.reshape(*self.labels.shape, -1)

    def spread(self, by_score: np.ndarray, count: int) -> np.ndarray:
        """The slopes by the scores of places as slopes by the weights of features."""
        flat = by_score.reshape(-1, by_score.shape[2])[self.owner]
        return np.stack([np.bincount(self.features, column, count) for column in flat.T], axis=1)


def objective(batch: Batch, weights: np.ndarray, steps: np.ndarray, starts: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean log-likelihood of the labels, and its gradient by ``weights`` (feature, label), ``steps``
    (label, next label) and ``starts`` (first label)."""
    n, places = batch.labels.shape
    kinds = len(starts)
    score = batch.scores(weights)
    ahead = np.zeros((n, places, kinds))
    ahead[:, 0] = starts + score[:, 0]
    for t in range(1, places):
        ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + steps, 1) + score[:, t]
    back = np.zeros((n, places, kinds))
    for t in range(places - 2, -1, -1):
        after = _log_sum(steps + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where((t + 1 < batch.length)[:, None], after, 0)
    rows = np.arange(n)
    total = _log_sum(ahead[rows, batch.length - 1], 1)

    own = np.exp(ahead + back - total[:, None, None]) * batch.inside[:, :, None]
    given = np.eye(kinds)[batch.labels] * batch.inside[:, :, None]
    both = batch.inside[:, 1:]
    pairs = np.exp(ahead[:, :-1, :, None] + steps + (score + back)[:, 1:, None, :] - total[:, None, None, None])
    pairs = (pairs * both[:, :, None, None]).sum(axis=(0, 1))
    given_pairs = np.zeros((kinds, kinds))
    np.add.at(given_pairs, (batch.labels[:, :-1][both], batch.labels[:, 1:][both]), 1)

    given_score = (score * given).sum() + (given_pairs * steps).sum() + starts[batch.labels[:, 0]].sum()
    by_start = (given - own)[:, 0].sum(axis=0)
    by_weight = batch.spread(given - own, len(weights))
    return (given_score - total.sum()) / n, [by_weight / n, (given_pairs - pairs) / n, by_start / n]


class Chain:
    """Labels, the weights of named features for each, and those of steps between labels."""

    def __init__(self, labels: Sequence[str], rows: Sequence[tuple[list[list[str]], list[str]]]):
        """``rows``: for each row the feature names of each place, and its labels."""
        self.labels = list(labels)
        self.index: dict[str, int] = {}
        numbered = [
            ([[self.index.setdefault(f, len(self.index)) for f in place] for place in names], [self.labels.index(x) for x in own])
            for names, own in rows
            if names
        ]
        kinds = len(self.labels)
        self.parts = [np.zeros((len(self.index), kinds)), np.zeros((kinds, kinds)), np.zeros(kinds)]
        if numbered:
            self._fit(Batch(numbered))

    @property
    def steps(self) -> np.ndarray:
        return self.parts[1]

    @property
    def starts(self) -> np.ndarray:
        return self.parts[2]

    def _fit(self, batch: Batch) -> None:
        """Ascent by Adam over all rows at once, from zero: the same rows give the same weights."""
        means = [np.zeros_like(p) for p in self.parts]
        squares = [np.zeros_like(p) for p in self.parts]
        for step in range(1, STEPS + 1):
            _, slopes = objective(batch, *self.parts)
            rate = RATE * (1 - step / (STEPS + 1))
            for p, g, m, s in zip(self.parts, slopes, means, squares):
                g = g - PENALTY * p / len(batch.length)
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)

    def weight(self, features: Sequence[str]) -> np.ndarray:
        """The sum of the features' weights for each label; unknown features weigh nothing."""
        known = [self.index[f] for f in features if f in self.index]
        return self.parts[0][known].sum(axis=0)

    def likeliest(self, score: np.ndarray, first: np.ndarray, row: np.ndarray, begins: np.ndarray, closes: np.ndarray) -> np.ndarray:
        """Viterbi: the likeliest labels of sequences lying one behind the other in ``score``.

        Sequence ``i`` begins at place ``first[i]`` and ends where the next begins (``row`` has the
        sequence of each place); ``begins[i]`` and ``closes[i]`` are added to its first and last label.
        """
        kinds, count = len(self.labels), len(first)
        length = np.bincount(row, minlength=count)
        order = np.argsort(-length, kind="stable")
        first, length, begins, closes = first[order], length[order], begins[order], closes[order]
        best = score[first] + begins
        came = np.zeros((len(score), kinds), np.int8)
        for t in range(1, int(length.max(initial=1))):
            active = int(np.searchsorted(-length, -t, "left"))  # sequences longer than t come first
            options = best[:active, :, None] + self.steps
            came[first[:active] + t] = options.argmax(axis=1)
            best[:active] = options.max(axis=1) + score[first[:active] + t]
        labels = np.zeros(len(score), np.int8)
        now = (best + closes).argmax(axis=1)
        for t in range(int(length.max(initial=1)) - 1, -1, -1):
            active = int(np.searchsorted(-length, -t, "left"))
            place = first[:active] + t
            labels[place] = now[:active]
            now[:active] = np.where(t > 0, came[place, now[:active]], now[:active])
        return labels

    def settled(self, label: int) -> np.ndarray:
        """For each label by how much its score may exceed that of ``label`` and still not be chosen, whatever
        stands before and behind: what steps can make up for."""
        before = np.vstack((self.steps, self.starts))
        behind = np.hstack((self.steps, np.zeros((len(self.labels), 1))))
        made_up = (before - before[:, [label]]).max(axis=0) + (behind - behind[label]).max(axis=1)
        return -made_up
