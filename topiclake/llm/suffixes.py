"""Suffix order of a sequence of symbols, by doubling ranks."""

from __future__ import annotations

import numpy as np


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of ``keys`` and the rank of each; equal keys have equal ranks."""
    order = np.argsort(keys, kind="stable")
    rank = np.zeros(len(keys), np.int64)
    rank[order[1:]] = np.cumsum(keys[order][1:] != keys[order][:-1])
    return order, rank


def suffix_order(keys: np.ndarray, width: int = 1, depth: int | None = None) -> np.ndarray:
    """The positions in the order of their suffixes.

    ``keys`` stand for the ``width`` symbols from each position on.  Suffixes that agree on
    ``depth`` symbols may come in any order.
    """
    n = len(keys)
    order, rank = ranked(keys)
    while n and rank[order[-1]] < n - 1 and width < (depth or n):
        key = rank * (n + 1)
        if width < n:
            key[: n - width] += rank[width:] + 1
        order, rank = ranked(key)
        width *= 2
    return order
