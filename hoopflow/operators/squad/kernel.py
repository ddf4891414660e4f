"""The exact squad kernel: dynamic programming in whole cost units, one solve at a time, in numpy.

A squad has 4 G, 4 F and 2 C; five starters (1-3 G, 1-3 F, 1-2 C), a sixth man, a captain among the starters, four on the bench.
What is bought and sold follows from the final squad, so the budget is ``sum of prices <= cash + prices of the current squad`` and
the trade limit counts new members. The six active players (starters and sixth man) may have any split in ACTIVE: then one of them
can be the sixth man so that the other five form a legal line-up that keeps the best scorer as captain.
Per position a table holds the best value by (squad count, active count, captain taken, new members, counters, cost); the three
tables are joined over the splits. Limits on clubs are added only if the optimum breaks them.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np

SQUAD = {"G": 4, "F": 4, "C": 2}
ACTIVE = ((4, 1, 1), (3, 2, 1), (2, 3, 1), (1, 4, 1), (3, 1, 2), (2, 2, 2), (1, 3, 2))
FORMATIONS = ((1, 3), (1, 3), (1, 2))
CLUB_CAP = 6
NONE = -np.inf


@dataclass
class Rules:
    cash: float
    max_trades: int | None = None
    credit_value: float = 0.0
    turn_minimums: tuple[int, ...] = ()
    must: frozenset[str] = frozenset()
    avoid: frozenset[str] = frozenset()


@dataclass
class Pool:
    """Candidates, sorted by player so the order of rows doesn't matter."""

    player: list[str]
    team: list[str]
    position: list[str]
    turn: list[int]
    price: np.ndarray
    prev: np.ndarray
    score: np.ndarray
    growth: np.ndarray


@dataclass
class Counter:
    """A number of squad members to be kept between bounds: a turn's minimum (counted up to it) or a club's maximum (counted in full)."""

    member: np.ndarray
    least: int = 0
    most: int = 10

    @property
    def capped(self) -> bool:
        return self.most >= 10

    def size(self, need: int) -> int:
        return (min(self.least, need) if self.capped else need) + 1

    def steps(self, i: int, size: int) -> list[tuple[slice, slice]]:
        """From where to where the count moves when candidate i joins."""
        if not self.member[i] or size == 1:
            return [(slice(0, size), slice(0, size))]
        up = [(slice(0, size - 1), slice(1, size))]
        return [*up, (slice(size - 1, size), slice(size - 1, size))] if self.capped else up

    def add(self, u: int, v: int) -> int:
        return min(self.least, u + v) if self.capped else u + v

    def broken(self, n: int, final: bool) -> bool:
        return (final and n < self.least) if self.capped else n > self.most


class Infeasible(RuntimeError):
    """No legal squad fits."""


def cost_units(price: np.ndarray) -> tuple[np.ndarray, int]:
    """Prices as whole numbers of the coarsest unit that is exact."""
    for scale in (1, 10, 100, 1000):
        units = np.rint(price * scale)
        if np.allclose(units, price * scale, atol=1e-6):
            return units.astype(np.int64), scale
    raise ValueError("prices with more than three decimals have no whole cost unit")


class _Position:
    """The table of one position, with the choice that led to each cell: mode + 4 * way, the way being how the counters moved."""

    def __init__(self, rows: list[int], need: int, pool: Pool, unit: np.ndarray, budget: int, buys: int, rules: Rules, counters: list[Counter]) -> None:
        self.rows, self.counters, self.pool, self.unit = rows, counters, pool, unit
        self.sizes = [c.size(need) for c in counters]
        self.shape = (need + 1, need + 1, 2, buys + 1, *self.sizes, budget + 1)
        best = np.full(self.shape, NONE)
        best[(0,) * len(self.shape)] = 0.0
        self.choice = []
        for i in rows:
            nxt = np.full(self.shape, NONE) if pool.player[i] in rules.must else best.copy()
            pick = np.zeros(self.shape, dtype=np.int8)
            if pool.player[i] not in rules.avoid:
                s, g = pool.score[i], rules.credit_value * pool.growth[i]
                for mode, (value, active, captain) in enumerate(((0.5 * s + g, 0, 0), (s + g, 1, 0), (2 * s + g, 1, 1)), start=1):
                    self._take(best, nxt, pick, i, mode, value, active, captain)
            best = nxt
            self.choice.append(pick)
        self.best = best

    def _ways(self, i: int) -> list[tuple]:
        return list(product(*[c.steps(i, n) for c, n in zip(self.counters, self.sizes)]))

    def _take(self, best: np.ndarray, nxt: np.ndarray, pick: np.ndarray, i: int, mode: int, value: float, active: int, captain: int) -> None:
        cost, new = int(self.unit[i]), int(not self.pool.prev[i])
        if cost >= self.shape[-1]:
            return
        src = (slice(0, -1), slice(0, self.shape[1] - active), slice(0, 2 - captain), slice(0, self.shape[3] - new))
        dst = (slice(1, None), slice(active, None), slice(captain, None), slice(new, None))
        for way, steps in enumerate(self._ways(i)):
            a = (*src, *[x for x, _ in steps], slice(0, self.shape[-1] - cost))
            b = (*dst, *[y for _, y in steps], slice(cost, None))
            offer = best[a] + value
            better = offer > nxt[b]
            nxt[b] = np.where(better, offer, nxt[b])
            pick[b] = np.where(better, mode + 4 * way, pick[b])

    def trace(self, cell: tuple[int, ...]) -> list[tuple[int, int]]:
        """(row, mode) of the members behind a cell."""
        out, at = [], list(cell)
        for i, choice in zip(reversed(self.rows), reversed(self.choice)):
            way, mode = divmod(int(choice[tuple(at)]), 4)
            if not mode:
                continue
            out.append((i, mode))
            moved = [y.start - x.start for x, y in self._ways(i)[way]]
            back = (1, int(mode > 1), int(mode == 3), int(not self.pool.prev[i]), *moved, int(self.unit[i]))
            at = [v - d for v, d in zip(at, back)]
        return out


def prune(pool: Pool, rules: Rules, keep_all: bool) -> list[int]:
    """Rows worth keeping: a candidate that as many others of his kind beat in score, growth and price as his position needs can go."""
    alive = []
    for i in range(len(pool.player)):
        if pool.player[i] in rules.must or keep_all:
            alive.append(i)
            continue
        if pool.player[i] in rules.avoid:
            continue
        same = [
            j for j in range(len(pool.player))
            if j != i and pool.position[j] == pool.position[i] and pool.turn[j] == pool.turn[i] and pool.prev[j] == pool.prev[i] and pool.player[j] not in rules.avoid
            and pool.score[j] >= pool.score[i] and pool.growth[j] >= pool.growth[i] and pool.price[j] <= pool.price[i]
            and ((pool.score[j], pool.growth[j], -pool.price[j]) != (pool.score[i], pool.growth[i], -pool.price[i]) or pool.player[j] < pool.player[i])
        ]
        if len(same) < SQUAD[pool.position[i]]:
            alive.append(i)
    return alive


def solve(pool: Pool, rules: Rules) -> tuple[float, list[tuple[int, str, bool]]]:
    """The best objective and (row, role, captain) of each squad member; raises Infeasible.

    Turn minimums and club limits enter only once an optimum without them breaks them, so most solves never carry their counters.
    """
    clubs: list[str] = []
    turns: list[int] = []
    while True:
        held = Rules(rules.cash, rules.max_trades, rules.credit_value, tuple(k if t in turns else 0 for t, k in enumerate(rules.turn_minimums)), rules.must, rules.avoid)
        value, members = _solve(pool, held, clubs)
        squad = [i for i, _ in members]
        over = sorted({c for c in (pool.team[i] for i in squad) if sum(pool.team[i] == c for i in squad) > CLUB_CAP})
        under = [t for t, k in enumerate(rules.turn_minimums) if sum(pool.turn[i] == t + 1 for i in squad) < k]
        if not over and not under:
            return value, _roles(pool, members)
        clubs += over
        turns += under


def _solve(pool: Pool, rules: Rules, clubs: list[str]) -> tuple[float, list[tuple[int, int]]]:
    unit, scale = cost_units(pool.price)
    budget = int(np.floor((rules.cash + float((pool.price * pool.prev).sum())) * scale + 1e-6))
    dearest = sum(int(np.sort([unit[i] for i in range(len(unit)) if pool.position[i] == p])[::-1][:n].sum()) for p, n in SQUAD.items())
    budget = min(budget, dearest)
    limit = 10 if rules.max_trades is None else min(10, rules.max_trades)
    free = rules.max_trades is None or rules.max_trades >= 10
    prev = np.ones_like(pool.prev) if free else pool.prev
    held = Pool(pool.player, pool.team, pool.position, pool.turn, pool.price, prev, pool.score, pool.growth)
    alive = prune(held, rules, bool(clubs))
    turn = np.array(pool.turn)
    counters = [Counter(turn == t, least=k) for t, k in enumerate(rules.turn_minimums, start=1) if k > 0]
    counters += [Counter(np.array([x == c for x in pool.team]), most=CLUB_CAP) for c in clubs]
    tables = {
        p: _Position([i for i in alive if pool.position[i] == p], need, held, unit, budget, 0 if free else min(need, limit), rules, counters) for p, need in SQUAD.items()
    }
    found = _join(tables, counters, budget, limit, free)
    if found is None:
        raise Infeasible("no legal squad fits the budget, trades, turns, clubs and named players")
    value, cells = found
    return value, [m for p, cell in zip(SQUAD, cells) for m in tables[p].trace(cell)]


def _states(t: _Position) -> dict[tuple, np.ndarray]:
    """(active, captain, new, counters...) -> value by cost, for full position squads only."""
    full = t.best[-1]
    return {k: full[k] for k in np.ndindex(full.shape[:-1]) if np.isfinite(full[k]).any()}


def _join(tables: dict[str, _Position], counters: list[Counter], budget: int, limit: int, free: bool):
    """The best combination of the three positions' tables."""
    g, f, c = (_states(tables[p]) for p in SQUAD)
    two: dict[tuple, tuple[np.ndarray, np.ndarray, list]] = {}
    for a, x in g.items():
        on = np.flatnonzero(np.isfinite(x))
        for b, y in f.items():
            if a[1] + b[1] > 1 or (not free and a[2] + b[2] > limit) or not any(s[0] == a[0] and s[1] == b[0] for s in ACTIVE):
                continue
            rest = tuple(k.add(u, v) for k, u, v in zip(counters, a[3:], b[3:]))
            if any(k.broken(r, False) for k, r in zip(counters, rest)):
                continue
            key = (a[0], b[0], a[1] + b[1], a[2] + b[2], *rest)
            z, w, who = two.setdefault(key, (np.full(budget + 1, NONE), np.full(budget + 1, -1, dtype=np.int64), []))
            who.append((a, b))
            for cost in on:  # sparse: only the costs that a full squad of guards can have
                offer = x[cost] + y[: budget + 1 - cost]
                part = z[cost:]
                better = offer > part
                part[better] = offer[better]
                w[cost:][better] = (len(who) - 1) * (budget + 1) + cost
    best = (NONE, None)
    for key, (z, w, who) in two.items():
        upto = np.maximum.accumulate(z)
        for b, y in c.items():
            if (key[0], key[1], b[0]) not in ACTIVE or key[2] + b[1] != 1 or (not free and key[3] + b[2] > limit):
                continue
            rest = [k.add(u, v) for k, u, v in zip(counters, key[4:], b[3:])]
            if any(k.broken(r, True) for k, r in zip(counters, rest)):
                continue
            total = y + upto[::-1][: len(y)]
            k = int(np.argmax(total))
            if total[k] > best[0] + 1e-12:
                best = (float(total[k]), (key, b, k))
    if best[1] is None:
        return None
    value, (key, b, cost_c) = best
    z, w, who = two[key]
    cost_two = int(np.argmax(z[: budget + 1 - cost_c]))
    pair, cost_g = divmod(int(w[cost_two]), budget + 1)
    a, bb = who[pair]
    return value, ((SQUAD["G"], *a, cost_g), (SQUAD["F"], *bb, cost_two - cost_g), (SQUAD["C"], *b, cost_c))


def _roles(pool: Pool, members: list[tuple[int, int]]) -> list[tuple[int, str, bool]]:
    """Names the sixth man among the active players: the weakest one (not the captain) whose absence leaves a legal five."""
    active = [i for i, m in members if m > 1]
    captain = next(i for i, m in members if m == 3)
    for sixth in sorted((i for i in active if i != captain), key=lambda i: (pool.score[i], pool.player[i])):
        five = [pool.position[i] for i in active if i != sixth]
        if all(lo <= five.count(p) <= hi for p, (lo, hi) in zip("GFC", FORMATIONS)):
            break
    return [(i, "bench" if m == 1 else "sixth" if i == sixth else "starter", i == captain) for i, m in members]
