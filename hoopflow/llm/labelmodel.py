"""A generative model of votes: what many fallible voting functions say about pairs, explained by an unseen match.

Each function has its own accuracy, and functions that repeat each other are tied in a tree of dependences, so their agreement counts
once. The model is fitted by expectation maximisation on the counts of vote patterns over all pairs; its posterior is a pair's
confidence. What a vote is worth before anything is learnt is a prior of ``PRIOR`` pairs, so few pairs change little and many much.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIED = 0.02
PRIOR = 20.0


class LabelModel:
    """Class-conditional vote tables with at most one parent per function, learnt without labels.

    levels: what each function can vote, for (above 0), against (below 0) or nothing. start: what a step of a vote weighs before
    anything is learnt; even: the sum at which a match is an even bet then.
    """

    def __init__(self, levels: dict[str, tuple[int, ...]], start: dict[str, float], even: float, patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> None:
        self.levels, self.sizes = levels, [len(v) for v in levels.values()]
        self.x, self.n = patterns, counts.astype("float64")
        worth = [start[k] * np.array(v) for k, v in levels.items()]
        self.q = 1 / (1 + np.exp(-(sum(w[patterns[:, k]] for k, w in enumerate(worth)) - even)))
        own = [np.bincount(patterns[:, k], self.n, size) + 1.0 for k, size in enumerate(self.sizes)]
        self.before = [[p / p.sum() for p in (o * np.exp(sign * w / 2) for o, w in zip(own, worth))] for sign in (-1, 1)]
        self.parent = [-1] * len(self.sizes)
        self._fit(rounds)
        self.parent = self._tree()
        self._fit(rounds)

    def _table(self, k: int, weight: np.ndarray, match: int) -> np.ndarray:
        """P(vote k | parent's vote), smoothed towards the vote's own distribution so rare parents don't speak for themselves."""
        own = np.bincount(self.x[:, k], weight, self.sizes[k]) + PRIOR * self.before[match][k]
        own /= own.sum()
        p = self.parent[k]
        if p < 0:
            return own[None, :]
        t = np.zeros((self.sizes[p], self.sizes[k]))
        np.add.at(t, (self.x[:, p], self.x[:, k]), weight)
        t += PRIOR * own
        return t / t.sum(axis=1, keepdims=True)

    def _fit(self, rounds: int) -> None:
        for _ in range(rounds):
            score = []
            for match, w in enumerate((self.n * (1 - self.q), self.n * self.q)):
                s = np.full(len(self.n), np.log((w.sum() + 1) / (self.n.sum() + 2)))
                for k in range(len(self.sizes)):
                    t, p = np.log(self._table(k, w, match)), self.parent[k]
                    s += t[self.x[:, p] if p >= 0 else 0, self.x[:, k]]
                score.append(s)
            q = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
            change = np.abs(q - self.q).max()
            self.q = q
            if change < 1e-6:
                break

    def _information(self, j: int, k: int) -> float:
        """Mutual information of two functions' votes given the match."""
        total = 0.0
        for w in (self.n * (1 - self.q), self.n * self.q):
            t = np.zeros((self.sizes[j], self.sizes[k]))
            np.add.at(t, (self.x[:, j], self.x[:, k]), w)
            if t.sum() <= 0:
                continue
            share = t.sum() / self.n.sum()
            t /= t.sum()
            free = t.sum(1, keepdims=True) @ t.sum(0, keepdims=True)
            on = t > 0
            total += share * float((t[on] * np.log(t[on] / free[on])).sum())
        return total

    def _tree(self) -> list[int]:
        """A forest over the most dependent pairs of functions."""
        k = len(self.sizes)
        edges = sorted(((self._information(i, j), i, j) for i in range(k) for j in range(i)), reverse=True)
        group, near = list(range(k)), {i: [] for i in range(k)}
        for strength, i, j in edges:
            if strength > TIED and group[i] != group[j]:
                old = group[j]
                group = [group[i] if g == old else g for g in group]
                near[i].append(j)
                near[j].append(i)
        parent, seen = [-1] * k, set()
        for root in range(k):
            stack = [] if root in seen else [root]
            while stack:
                at = stack.pop()
                seen.add(at)
                for to in near[at]:
                    if to not in seen:
                        parent[to] = at
                        stack.append(to)
        return parent

    def accuracies(self) -> dict[str, float]:
        """How often a function that votes votes as the match has it."""
        out = {}
        for k, (name, values) in enumerate(self.levels.items()):
            v = np.array(values)[self.x[:, k]]
            said = v != 0
            right = np.where(v > 0, self.q, 1 - self.q)
            out[name] = float((self.n * right)[said].sum() / max(1e-9, self.n[said].sum()))
        return out


def posterior(pairs: DataFrame, levels: dict[str, tuple[int, ...]], start: dict[str, float], even: float) -> DataFrame:
    """The pairs with their ``confidence``. Vote patterns, at most the product of the levels, come to the driver; pairs never."""
    rows = pairs.groupBy(*levels).count().orderBy(*levels).collect()
    if not rows:
        return pairs.withColumn("confidence", F.lit(0.0))
    place = [{v: i for i, v in enumerate(values)} for values in levels.values()]
    x = np.array([[p[r[k]] for p, k in zip(place, levels)] for r in rows])
    model = LabelModel(levels, start, even, x, np.array([r["count"] for r in rows]))
    learnt = pairs.sparkSession.createDataFrame([(*[int(r[k]) for k in levels], float(q)) for r, q in zip(rows, model.q)], ", ".join(f"{k} int" for k in levels) + ", confidence double")
    return pairs.join(F.broadcast(learnt), list(levels))
