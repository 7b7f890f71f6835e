"""A linear-chain conditional random field over tokens with hashed indicator features."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from zlib import crc32

import numpy as np

BUCKETS = 1 << 14
TAGS = "OBI"
# I follows B or I only.
_ALLOWED = np.array([[0, 0, -1e9], [0, 0, 0], [0, 0, 0]], np.float64)
_FIRST = np.array([0, 0, -1e9])


def bucket(feature: str) -> int:
    return crc32(feature.encode()) % BUCKETS


class ChainField:
    """Weights of state features (a row per bucket) and of transitions between the tags O, B, I."""

    def __init__(self) -> None:
        self.state = np.zeros((BUCKETS, 3))
        self.step = np.zeros((3, 3))

    def fit(self, chains: Sequence[list[list[int]]], tags: Sequence[list[int]], *, turns: int = 120, l2: float = 1e-3):
        """Maximum likelihood by gradient steps over all chains; chains of like lengths are padded to the longest of them."""
        wide = max(len(f) for c in chains for f in c)
        groups = []
        for low, high in ((1, 1), (2, 4), (5, 16), (17, max(map(len, chains)))):
            own = [i for i, c in enumerate(chains) if low <= len(c) <= high]
            if not own:
                continue
            lengths = np.array([len(chains[i]) for i in own])
            real = np.arange(lengths.max()) < lengths[:, None]
            gold = np.zeros(real.shape, np.int64)
            gold[real] = [t for i in own for t in tags[i]]
            flat = np.full((lengths.sum(), wide), BUCKETS, np.int32)
            for row, features in zip(flat, (f for i in own for f in chains[i])):
                row[: len(features)] = features
            seen_steps = np.zeros((3, 3))
            np.add.at(seen_steps, (gold[:, :-1][real[:, 1:]], gold[:, 1:][real[:, 1:]]), 1)
            groups.append((flat, real, gold, seen_steps))
        ones = np.eye(3)
        moments = [np.zeros((BUCKETS + 1, 3)), np.zeros((BUCKETS + 1, 3)), np.zeros((3, 3)), np.zeros((3, 3))]
        state = np.vstack([self.state, np.zeros((1, 3))])
        for turn in range(1, turns + 1):
            by_state, by_step = np.zeros_like(state), np.zeros((3, 3))
            for flat, real, gold, seen_steps in groups:
                scores = np.zeros((*real.shape, 3))
                scores[real] = state[flat].sum(axis=1)
                marginal, steps = self._marginals(scores, real)
                off = ones[gold[real]] - marginal[real]
                for k in range(3):
                    by_state[:, k] += np.bincount(flat.ravel(), np.repeat(off[:, k], wide), BUCKETS + 1)
                by_step += seen_steps - steps
            by_state[-1] = 0
            by_state = by_state / len(chains) - l2 * state
            by_step = by_step / len(chains) - l2 * self.step
            for k, (weights, gradient) in enumerate(((state, by_state), (self.step, by_step))):
                m, v = moments[2 * k], moments[2 * k + 1]
                m += 0.1 * (gradient - m)
                v += 0.01 * (gradient * gradient - v)
                weights += 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
        self.state = state[:-1]
        return self

    def _marginals(self, scores: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward sums: of each token's tags, and of steps over all chains."""
        moves = self.step + _ALLOWED
        n, length, _ = scores.shape
        ahead = np.zeros((n, length, 3))
        back = np.zeros((n, length, 3))
        ahead[:, 0] = scores[:, 0] + _FIRST
        for t in range(1, length):
            reached = _log_sum(ahead[:, t - 1, :, None] + moves, 1) + scores[:, t]
            ahead[:, t] = np.where(real[:, t, None], reached, ahead[:, t - 1])
        for t in range(length - 2, -1, -1):
            after = _log_sum(moves[None] + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(real[:, t + 1, None], after, 0)
        total = _log_sum(ahead[:, -1], 1)
        marginal = np.exp(ahead + back - total[:, None, None])
        joint = ahead[:, :-1, :, None] + moves + (scores[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
        steps = (np.exp(np.minimum(joint, 0)) * real[:, 1:, None, None]).sum(axis=(0, 1))
        return marginal, steps

    def decode(self, chain: list[list[int]]) -> list[int]:
        """The best tags (Viterbi)."""
        return list(self.best_tags(self.state[features].sum(axis=0).tolist() for features in chain))

    def best_tags(self, scores: Iterable[Sequence[float]]) -> bytearray:
        """The best tags of tokens that come one by one, with their scores under each tag; a byte a token is kept."""
        (o_o, o_b, o_i), (b_o, b_b, b_i), (i_o, i_b, i_i) = (self.step + _ALLOWED).tolist()
        trail = bytearray()
        o = b = i = 0.0
        for s_o, s_b, s_i in scores:
            if not trail:
                o, b, i = s_o, s_b, s_i + float(_FIRST[2])
                trail.append(0)
                continue
            # Where the best way to O, B and I came from; the first of equals.
            x, y, z = o + o_o, b + b_o, i + i_o
            to_o, from_o = (x, 0) if x >= y and x >= z else (y, 1) if y >= z else (z, 2)
            x, y, z = o + o_b, b + b_b, i + i_b
            to_b, from_b = (x, 0) if x >= y and x >= z else (y, 1) if y >= z else (z, 2)
            x, y, z = o + o_i, b + b_i, i + i_i
            to_i, from_i = (x, 0) if x >= y and x >= z else (y, 1) if y >= z else (z, 2)
            o, b, i = to_o + s_o, to_b + s_b, to_i + s_i
            trail.append(from_o + 3 * from_b + 9 * from_i)
        if not trail:
            return trail
        tag = max(range(3), key=(o, b, i).__getitem__)
        for t in range(len(trail) - 1, -1, -1):
            came = trail[t] // 3**tag % 3
            trail[t] = tag
            tag = came
        return trail


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)
