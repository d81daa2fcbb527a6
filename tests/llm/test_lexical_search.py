"""The K2-treap and the search over it against plain loops."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from firmweave.llm.lexical_search import K2Treap, search
from tests.llm.conftest import ODD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    """item_id, rank, doc_id, score by loops over all pairs."""
    counts = [(doc, Counter(terms(text))) for doc, text in docs if terms(text)]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    texts = defaultdict(list)
    for item, text in items:
        texts[item].append(text)
    out = []
    for item, found in texts.items():
        text = min((t for t in found if t is not None), default=None, key=lambda t: t.encode())
        scores = []
        for doc, c in counts:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return out


def frames(spark, docs, items):
    """With columns whose names clash with the operator's own."""
    d = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, n long, terms string, score long")
    q = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in items], "item_id long, text string, rank long, tfs string, doc_id long")
    return d, q


@pytest.mark.parametrize(("rows", "columns", "points"), [(1, 1, 1), (1, 50, 20), (300, 5, 400), (64, 64, 900), (33, 700, 4000)])
def test_treap_finds_the_best_columns(rows, columns, points):
    rng = np.random.default_rng(points)
    at = rng.choice(rows * columns, min(points, rows * columns), replace=False)
    r, c, v = at // columns, at % columns, rng.integers(1, 1000, len(at))
    tree = K2Treap.of(r, c, v)
    again = K2Treap.restored(tree.depth, *tree.compressed())
    assert (again.masks == tree.masks).all() and (again.maxima == tree.maxima).all()
    grid = np.zeros((rows, columns), np.int64)
    grid[r, c] = v
    for _ in range(20):
        own = rng.choice(np.unique(r), min(7, len(np.unique(r))), replace=False)
        weights = rng.integers(1, 50, len(own))
        scores = weights @ grid[own]
        order = lambda c, s: np.lexsort((c, -s))
        found, got = again.top(own, weights, 5, 1, order)
        best = [(s, -c) for c, s in enumerate(scores) if s > 0]
        best.sort(reverse=True)
        by = order(found, got)[:5]
        assert [(s, -c) for c, s in zip(found[by].tolist(), got[by].tolist(), strict=True)] == best[:5]


@pytest.mark.parametrize(("chunk", "block"), [(8192, 100_000), (7, 10)])
def test_against_all_pairs(spark, chunk, block):
    rng = np.random.default_rng(chunk)
    words = [f"w{i}" for i in range(120)] + ["ß", "É", "été", "日本"]
    p = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(rng.choice(words, n, p=p / p.sum()))
    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(150)] + [(500 + i, "W1 w2-w3") for i in range(40)] + ODD + [(900, "w1 " * 50_000)]
    items = [(i, text(int(rng.integers(1, 30)))) for i in range(12)] + [(20, "w1"), (21, ""), (22, None), (23, "unheardof"), (24, "w5 W5,w5/w7"), (25, "b"), (25, "w9"), (None, "w3 w4")]
    d, q = frames(spark, docs, items)
    found = [tuple(r) for r in search(d.repartition(3), q, 20, chunk, block).collect()]
    assert sorted(found, key=repr) == sorted(plain(docs, items, 20), key=repr)


def test_no_documents_and_no_items(spark):
    for docs, items in (([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (2, " ")], [(1, "a")]), ([(1, "b")], [(1, "a")])):
        out = search(*frames(spark, docs, items))
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
