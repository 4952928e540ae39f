"""Keyed permutations of [0, n): a balanced Feistel network over the next even power of two, walked back into range."""

from __future__ import annotations

import numpy as np

ROUNDS = 4


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def round_keys(*seed: int) -> np.ndarray:
    """One key for each round, from any integers."""
    return np.random.default_rng([int(s) & 0xFFFFFFFF for s in seed]).integers(0, 1 << 63, ROUNDS, dtype=np.uint64)


def _network(x: np.ndarray, half: np.uint64, keys: np.ndarray) -> np.ndarray:
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = x >> half, x & mask
    for key in keys:
        left, right = right, left ^ (mix64(right + key) & mask)
    return (left << half) | right


def permute(x: np.ndarray, n: int, keys: np.ndarray) -> np.ndarray:
    """Images of x (all in [0, n)) under the permutation of [0, n) that `keys` select."""
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    out = _network(np.asarray(x, np.uint64), half, keys)
    while len(beyond := np.nonzero(out >= np.uint64(n))[0]):
        out[beyond] = _network(out[beyond], half, keys)
    return out.astype(np.int64)
