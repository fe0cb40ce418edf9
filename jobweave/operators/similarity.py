"""Cosines and products of matrices, and the best of them in a fixed order."""

from __future__ import annotations

import numpy as np

SCORE_DIGITS = 6


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


#: Columns of which only the largest is looked at first.
_SPAN = 64


def best_pairs(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_columns`` of all rows as row numbers, column numbers and rounded scores.

    The k-th largest of the spans' maxima bounds the k-th score from below, so only what comes near to it is rounded and sorted.
    """
    n = scores.shape[1]
    spans = -(-n // _SPAN)
    if k < spans:
        most = np.maximum.reduceat(scores, np.arange(0, n, _SPAN), axis=1)
        if not np.isnan(most).any():
            least = np.partition(most, spans - k, axis=1)[:, spans - k] - 2 * 10.0**-SCORE_DIGITS
            rows, columns = np.nonzero(scores >= least[:, None])
            rounded = np.round(scores[rows, columns], SCORE_DIGITS) + 0.0
            order = np.lexsort((columns, -rounded, rows))
            rows, columns, rounded = rows[order], columns[order], rounded[order]
            first = np.searchsorted(rows, np.arange(len(scores)))
            kept = np.arange(len(rows)) - first[rows] < k
            return rows[kept], columns[kept], rounded[kept]
    rounded, picks = best_columns(scores, k)
    rows = np.repeat(np.arange(len(picks)), [len(p) for p in picks])
    columns = np.concatenate([*picks, np.empty(0, dtype=np.int64)]).astype(np.int64)
    return rows, columns, rounded[rows, columns]


def best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The k best columns of every row: by rounded score, then by column number."""
    rounded = np.round(scores, SCORE_DIGITS) + 0.0
    n = rounded.shape[1]
    if n == 0:
        return rounded, [np.empty(0, dtype=int)] * len(rounded)
    k = min(k, n)
    kth = np.partition(rounded, n - k, axis=1)[:, n - k]
    picks = []
    for row, least in zip(rounded, kth):
        candidates = np.flatnonzero(row >= least)
        picks.append(candidates[np.argsort(-row[candidates], kind="stable")][:k])
    return rounded, picks
