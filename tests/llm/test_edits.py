"""Bounded edit distances against the plain table."""

import numpy as np

from firmweave.llm import edits


def table(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(rng, text, n, letters):
    out = list(text)
    for _ in range(n):
        at, kind = int(rng.integers(0, len(out) + 1)), int(rng.integers(0, 3))
        out[at : at + (kind > 0)] = [] if kind == 1 else [str(rng.choice(letters))]
    return "".join(out)


def test_pairs_are_within_the_bound_as_by_the_table():
    rng = np.random.default_rng(12)
    wide = [chr(0x4E00 + i) for i in range(400)]
    pairs = [("", ""), ("", "a"), ("a", ""), ("ab", "ba"), ("x" * 40, "x" * 44), ("ab" * 30, "ba" * 30), ("日本" + "a" * 20, "a" * 20)]
    for letters in (list("ab"), list("abcdefgh é"), ["ß", "日", "本", "a"], wide):
        for _ in range(60):
            a = "".join(rng.choice(letters, int(rng.integers(0, 260 if letters is wide else 90))))
            pairs.append((a, changed(rng, a, int(rng.integers(0, 14)), letters)))
            pairs.append((a, "".join(rng.choice(letters, len(a)))))
    true = np.array([table(a, b) for a, b in pairs])
    assert [edits.distance(a, b) for a, b in pairs] == true.tolist()
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    for shift in (-1, 0, 1):
        most = np.maximum(true + shift, 0)
        assert (edits.within(left, right, most) == (true <= most)).all()
    most = rng.integers(0, 20, len(pairs))
    assert (edits.within(left, right, most) == (true <= most)).all()
    assert edits.within([], [], np.zeros(0, np.int64)).tolist() == []
