"""Bounded edit distances of many pairs of texts at once.

A pair's state is how far along each diagonal a number of edits gets. One more edit moves every diagonal on by itself or
its neighbours, then equal characters carry it further, eight at a time. So a pair costs about the square of its bound, not of its length.
An edit takes away or adds at most two pairs of neighbouring characters, so their counts tell most texts that have little in common.
"""

from __future__ import annotations

import numpy as np

#: States that are moved on together, about.
_CELLS = 60_000
#: Kinds of pairs of neighbouring characters: the values of a byte.
_KINDS = 256
_FAR = -(1 << 30)


def _codes(a: str, b: str) -> tuple[bytes, bytes] | None:
    """A byte per character, nothing if the two have too many different ones."""
    try:
        return a.encode("latin-1"), b.encode("latin-1")
    except UnicodeEncodeError:
        code = {c: i for i, c in enumerate(dict.fromkeys(a + b))}
        return (bytes(map(code.get, a)), bytes(map(code.get, b))) if len(code) <= 256 else None


def distance(a: str, b: str) -> int:
    """The edit distance by rows of one bit per character of ``a``."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    more, less, found = full, 0, len(a)  # where a row grows and falls
    last = 1 << len(a) - 1 if a else 0
    if not a:
        return len(b)
    for c in b:
        eq = at.get(c, 0)
        diagonal = (((eq & more) + more) ^ more) | eq | less
        up, down = less | ~(diagonal | more) & full, more & diagonal
        found += bool(up & last) - bool(down & last)
        up, down = (up << 1 | 1) & full, down << 1 & full
        more, less = down | ~(diagonal | up) & full, up & diagonal
    return found


def within(left: list[str], right: list[str], most: np.ndarray) -> np.ndarray:
    """Whether each pair's edit distance is at most its bound."""
    out = np.zeros(len(left), bool)
    coded = [_codes(a, b) for a, b in zip(left, right, strict=True)]
    for i in [i for i, x in enumerate(coded) if x is None]:
        out[i] = distance(left[i], right[i]) <= most[i]
    sizes = np.array([(len(x[0]), len(x[1])) if x else (0, 1 << 20) for x in coded], np.int64).reshape(-1, 2)
    order = np.flatnonzero(np.abs(sizes[:, 0] - sizes[:, 1]) <= most)
    order = order[np.argsort(most[order], kind="stable")]
    while len(order):
        n = max(1, _CELLS // (2 * int(most[order[0]]) + 3))
        some, order = order[:n], order[n:]
        counts = [_neighbours([coded[i][c] for i in some.tolist()], sizes[some, c]) for c in (0, 1)]
        apart = counts[0] - counts[1]
        some = some[np.maximum(np.maximum(apart, 0).sum(1), np.maximum(-apart, 0).sum(1)) <= 2 * most[some]]
        if len(some):
            out[some] = _group([coded[i] for i in some.tolist()], sizes[some], most[some])
    return out


def _neighbours(texts: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """How many pairs of neighbouring characters of each kind a text has, a row per text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    kind = data[:-1] * np.uint8(37) + data[1:] + np.repeat(np.arange(len(texts)) * _KINDS, sizes)[:-1]
    inside = np.ones(len(data), bool)
    ends = np.cumsum(sizes) - 1
    inside[ends[sizes > 0]] = False
    return np.bincount(kind[inside[:-1]], minlength=len(texts) * _KINDS).reshape(-1, _KINDS).astype(np.int32)


def _joined(texts: list[bytes]) -> np.ndarray:
    """The eight bytes from every place on."""
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def _group(pairs: list[tuple[bytes, bytes]], sizes: np.ndarray, most: np.ndarray) -> np.ndarray:
    a8, b8 = _joined([x[0] for x in pairs]), _joined([x[1] for x in pairs])
    a0, b0 = (np.cumsum(sizes[:, c]) - sizes[:, c] for c in (0, 1))
    out, rows, zero = np.zeros(len(pairs), bool), np.arange(len(pairs)), int(most.max()) + 1
    na, nb, goal = sizes[:, 0], sizes[:, 1], sizes[:, 1] - sizes[:, 0]
    far = np.full((len(pairs), 2 * zero + 1), _FAR)
    for e in range(zero):
        # Diagonals that e edits reach and from which the rest reaches the goal.
        lo, hi = max(-e, int((goal - most).min()) + e), min(e, int((goal + most).max()) - e)
        d = np.arange(lo, hi + 1)
        c = slice(lo + zero, hi + zero + 1)
        if e:
            now = np.maximum(far[:, c], far[:, lo + zero + 1 : hi + zero + 2]) + 1
            now = np.maximum(now, far[:, lo + zero - 1 : hi + zero])
        else:
            now = np.zeros((len(rows), 1), np.int64)
        end = np.minimum(na[:, None], nb[:, None] - d)
        now = np.minimum(now, end)
        r, k = np.nonzero((now >= 0) & (now + d >= 0) & (np.abs(d - goal[:, None]) <= (most - e)[:, None]))
        i, left = now[r, k], (end - now)[r, k]
        x, y = a0[r] + i, b0[r] + i + d[k]
        going = np.flatnonzero(left > 0)
        while len(going):
            differ = a8[x[going]] ^ b8[y[going]]
            equal = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3
            equal = np.minimum(equal, left[going])
            for v in (i, x, y):
                v[going] += equal
            left[going] -= equal
            going = going[(equal == 8) & (left[going] > 0)]
        now[:] = _FAR
        now[r, k] = i
        far[:, c] = now
        there = far[np.arange(len(rows)), goal + zero] >= na
        out[rows[there]] = True
        keep = np.flatnonzero(~there & (most > e))
        if not len(keep):
            break
        if len(keep) < len(rows):
            rows, a0, b0, na, nb, goal, most, far = (v[keep] for v in (rows, a0, b0, na, nb, goal, most, far))
    return out
