"""The gap-weighted subsequence kernel on short strings, and a Nyström support vector machine."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Length of the common subsequences that are counted, and the weight of each character they span.
SUBSEQUENCE, DECAY = 3, 0.75

#: Strings handled at a time.
_BATCH = 512


def _codes(strings: list[str], fill: int) -> np.ndarray:
    """Characters as numbers, one row per string, ``fill`` after its end."""
    width = max([1, *map(len, strings)])
    padded = np.full((len(strings), width), fill, dtype=np.int32)
    for row, string in enumerate(strings):
        padded[row, : len(string)] = np.frombuffer(string.encode("utf-32-le"), dtype=np.int32)
    return padded


def _matches(left: np.ndarray, right: np.ndarray, cross: bool) -> tuple:
    """Result shape, and a function (i, j) -> equality of characters i and j."""
    if cross:
        shape = (len(left), len(right))
        return shape, lambda i, j: left[:, i, None] == right[None, :, j]
    return (len(left),), lambda i, j: left[:, i] == right[:, j]


def _raw(left: np.ndarray, right: np.ndarray, cross: bool) -> np.ndarray:
    """Unnormalised kernel of all pairs (``cross``) or of equal rows."""
    shape, equal = _matches(left, right, cross)
    total = np.zeros(shape, dtype=np.float32)
    columns = right.shape[1]
    # open_[i][j]: weight of common subsequences of length i that are carried to the present ends.
    open_ = np.zeros((SUBSEQUENCE, columns + 1, *shape), dtype=np.float32)
    open_[0] = 1
    for i in range(left.shape[1]):
        both = [np.where(equal(i, j), np.float32(DECAY**2), np.float32(0)) for j in range(columns)]
        for j in range(columns):
            total += both[j] * open_[SUBSEQUENCE - 1, j]
        for size in range(SUBSEQUENCE - 1, 0, -1):
            carried = np.zeros(shape, dtype=np.float32)
            for j in range(columns):
                carried *= np.float32(DECAY)
                carried += both[j] * open_[size - 1, j]
                open_[size, j + 1] *= np.float32(DECAY)
                open_[size, j + 1] += carried
    return total


def kernel(strings: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of every string with every landmark; 0 where a string is too short."""
    found = np.zeros((len(strings), len(landmarks)), dtype=np.float32)
    right = _codes(landmarks, -1)
    own_right = np.sqrt(_raw(right, _codes(landmarks, -2), cross=False))
    order = sorted(range(len(strings)), key=lambda at: len(strings[at]))
    for start in range(0, len(order), _BATCH):
        rows = order[start : start + _BATCH]
        some = [strings[at] for at in rows]
        left = _codes(some, 0)
        own = np.sqrt(_raw(left, _codes(some, -3), cross=False))
        scale = np.maximum(own[:, None] * own_right[None, :], 1e-12)
        found[rows] = _raw(left, right, cross=True) / scale
    return found


@dataclass(frozen=True)
class Machine:
    """A linear machine over the kernel's Nyström features, folded into landmark weights."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float

    def decide(self, strings: list[str]) -> np.ndarray:
        return kernel(strings, self.landmarks) @ self.weights + self.bias


def fit(
    strings: list[str],
    labels: np.ndarray,
    landmarks: list[str],
    cost: float = 10.0,
    rounds: int = 50,
) -> Machine:
    """Squared-hinge support vector machine, solved by Newton steps on its active rows.

    ``labels`` are +1 and -1; both classes weigh the same in total.
    """
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    kept = values > 1e-6 * max(values.max(), 1e-12)
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    features = np.column_stack([kernel(strings, landmarks) @ whiten, np.ones(len(strings))])
    share = np.where(labels > 0, 1 / max(1, (labels > 0).sum()), 1 / max(1, (labels < 0).sum()))
    share = cost * share * len(labels) / 2
    ridge = np.eye(features.shape[1])
    ridge[-1, -1] = 1e-6
    weights = np.zeros(features.shape[1])
    for _ in range(rounds):
        active = labels * (features @ weights) < 1
        some = features[active]
        updated = np.linalg.solve(
            ridge + some.T @ (share[active, None] * some), some.T @ (share[active] * labels[active])
        )
        if np.allclose(updated, weights, atol=1e-8):
            break
        weights = updated
    return Machine(landmarks, (whiten @ weights[:-1]).astype(np.float32), float(weights[-1]))
