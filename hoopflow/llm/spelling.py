"""Names typed by people: folding, neighbourhood keys and token alignment. Plain functions, used inside Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from itertools import permutations

#: Letters without a decomposition, and two-letter spellings of one letter.
LETTERS = str.maketrans({"Ł": "L", "Đ": "D", "Ø": "O", "Æ": "AE", "Œ": "OE", "ẞ": "SS", "ß": "SS", "Þ": "TH", "Ð": "D", "ı": "I", "İ": "I"})
DIGRAPHS = (("SCH", "S"), ("SH", "S"), ("CH", "C"), ("ZH", "Z"), ("GH", "G"), ("DJ", "D"), ("KH", "H"), ("OE", "O"), ("UE", "U"), ("AE", "A"), ("OO", "U"), ("NY", "N"))
SUFFIXES = {"JR", "SR", "II", "III", "IV"}
#: From these lengths of the shorter token on, one and two edits still leave the same token.
ONE_EDIT, TWO_EDITS = 4, 7
#: A token pair with at least SAME is one token spelled twice; one below LIKE is two different tokens.
SAME, LIKE = 0.8, 0.4
#: What a learnt short form counts.
LEARNT = 0.75


@lru_cache(maxsize=200_000)
def fold(text: str) -> str:
    """Upper-case ASCII letters and single blanks; accents, digraph spellings and marks are gone."""
    s = unicodedata.normalize("NFKD", text.translate(LETTERS).upper().translate(LETTERS))
    s = "".join(c for c in s if not unicodedata.combining(c)).replace("'", "").replace("’", "")
    s = re.sub(r"[^A-Z0-9]+", " ", s).strip()
    for two, one in DIGRAPHS:
        s = s.replace(two, one)
    return s


def tokens(text: str | None) -> tuple[str, ...]:
    """Folded tokens in order, without generation suffixes (unless nothing else is there)."""
    t = fold(text or "").split()
    return tuple(x for x in t if x not in SUFFIXES) or tuple(t)


def deletes(token: str, depth: int = 1) -> set[str]:
    """The token and all strings left after deleting up to ``depth`` letters: tokens that many edits (or swaps) apart share one."""
    found = {token}
    layer = {token}
    for _ in range(depth):
        layer = {t[:i] + t[i + 1 :] for t in layer for i in range(len(t))}
        found |= layer
    return found


def keys(token: str) -> set[str]:
    """Index keys of a token. Any two tokens that ``token_score`` takes for the same share one; single letters have none."""
    if len(token) < 2:
        return set()
    return deletes(token, 2 if len(token) >= TWO_EDITS else 1 if len(token) >= ONE_EDIT else 0)


@lru_cache(maxsize=500_000)
def distance(a: str, b: str, most: int = 2) -> int:
    """Edit distance with swaps of neighbours, cut off above ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, prev = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        before, prev = prev, row
    return prev[-1]


@lru_cache(maxsize=500_000)
def token_score(a: str, b: str) -> float:
    """1: equal; 0.9 and 0.8: one or two edits; 0.4 to 0.7: an initial or abbreviation, perhaps with a slip; below 0: other tokens.

    Two edits that leave nothing of the first two letters make other tokens.
    """
    if a == b:
        return 1.0 if len(a) > 1 else 0.55
    s, l = sorted((a, b), key=len)
    d = distance(a, b)
    if len(s) >= ONE_EDIT and d == 1:
        return 0.9
    if len(s) >= TWO_EDITS and d == 2 and set(s[:2]) & set(l[:2]):
        return SAME
    if l.startswith(s):
        return 0.55 if len(s) == 1 else 0.62 if len(s) == 2 else 0.7
    if 3 <= len(s) < len(l) and distance(s, l[: len(s)], 1) <= 1 and s[0] == l[0]:
        return 0.5
    if len(s) >= 5 and d == 2 and s[0] == l[0]:
        return LIKE
    return -1.0


def assign(cost: list[list[float]]) -> list[int]:
    """The column of each row in the cheapest assignment of all rows (no more rows than columns), by shortest augmenting paths."""
    n, m = len(cost), len(cost[0])
    row_at, u, v = [-1] * m, [0.0] * n, [0.0] * m
    for start in range(n):
        near, came, done = [float("inf")] * m, [-1] * m, [False] * m
        row, at = start, -1
        while True:
            for j in range(m):
                if not done[j] and (c := cost[row][j] - u[row] - v[j]) < near[j]:
                    near[j], came[j] = c, at
            best = min((j for j in range(m) if not done[j]), key=lambda j: near[j])
            step = near[best]
            u[start] += step
            for j in range(m):
                if done[j]:
                    u[row_at[j]] += step
                    v[j] -= step
                else:
                    near[j] -= step
            done[best], at = True, best
            if row_at[best] < 0:
                break
            row = row_at[best]
        while at >= 0:
            back = came[at]
            row_at[at] = row_at[back] if back >= 0 else start
            at = back
    out = [0] * n
    for j, i in enumerate(row_at):
        if i >= 0:
            out[i] = j
    return out


@lru_cache(maxsize=500_000)
def align(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[float, float, int, str, str]:
    """The best assignment of the shorter name's tokens to the longer one's.

    Gives the score of the longest matched token (the family name, as a rule), the lowest score of the other matched tokens, how many
    tokens of the longer name stay unmatched, where exactly one other pair is made of different tokens that pair as ``x|y``, and the
    longest matched token itself.
    """
    if not a or not b:
        return -1.0, -1.0, max(len(a), len(b)), "", ""
    if len(a) > len(b):
        a, b = b, a
    if len(b) <= 3:
        best = max(permutations(range(len(b)), len(a)), key=lambda p: sum(token_score(x, b[j]) for x, j in zip(a, p)))
    else:
        best = assign([[-token_score(x, y) for y in b] for x in a])
    pairs = [(token_score(x, b[j]), min(len(x), len(b[j])), x, b[j]) for x, j in zip(a, best)]
    top = max(range(len(pairs)), key=lambda i: (pairs[i][0] >= SAME, pairs[i][1]))
    rest = [p for i, p in enumerate(pairs) if i != top]
    odd = [p for p in rest if p[0] < LIKE]
    pair = "|".join(sorted(odd[0][2:])) if len(odd) == 1 and min(len(odd[0][2]), len(odd[0][3])) > 1 else ""
    return pairs[top][0], min((p[0] for p in rest), default=0.5), len(b) - len(a), pair, pairs[top][2]


def classes(name: tuple[str, ...], i: int) -> set[str]:
    """What the other tokens of a name begin with: two aligned names agree in one of these for some token they share."""
    others = {c for j, t in enumerate(name) if j != i for c in t[:2]}
    return others or set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
