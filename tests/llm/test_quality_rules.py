"""Features against a plain rendering of their definitions; the estimate against votes of known accuracy."""

import re

import numpy as np

from firmweave.llm import quality_rules as q
from tests.llm.conftest import ODD, invented


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_base_features():
    rng = np.random.default_rng(1)
    texts = ["a b c a b c", "a a a a", "x\ny\nx\n\n \n ", "#a <b>|\nc &%$*", "a b c d", " ".join("ab"[i % 2] for i in range(9))]
    texts += [invented(rng, 80, "ab") for _ in range(20)] + [t for d, t in ODD if d != 55]
    for text in texts:
        assert q.text_features(text)[:5] == plain(text)


def test_estimate_finds_the_accuracy_of_rules():
    rng = np.random.default_rng(2)
    good = rng.random(20000) < 0.8
    catch, false = np.array([0.7, 0.5, 0.6]), np.array([0.01, 0.02, 0.005])
    bad_vote = rng.random((20000, 3)) < np.where(good[:, None], false, catch)
    votes = np.where(bad_vote, -1, np.where(rng.random((20000, 3)) < 0.5, 1, 0))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, tables = q.estimate(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.05
    assert np.abs(tables[:, 0, 0] - catch).max() < 0.1 and np.abs(tables[:, 1, 0] - false).max() < 0.03
    found = q.posterior(patterns, share, tables)
    assert (found[(patterns < 0).all(1)] < 0.01).all() and (found[(patterns >= 0).all(1)] > 0.9).all()


def test_clean_documents_stay_and_junk_goes(docs):
    rng = np.random.default_rng(3)
    rows = ODD + [(i, invented(rng, 120)) for i in range(100, 160)]
    junk = {300 + i: " ".join(w.upper() + "!!" for w in invented(rng, 90).split()) for i in range(12)}
    junk |= {400 + i: " ".join(w + "$$$" for w in invented(rng, 90).split()) for i in range(12)}
    found = q.score_quality(docs(rows + list(junk.items()))).collect()
    assert len(found) == len(rows) + len(junk)
    kept = {r.doc_id for r in found if r.kept}
    assert kept == set(range(100, 160))
    assert all(r.base_failed for r in found if r.n_words < 50 or r.doc_id == 55)
    assert all(0 <= r.quality <= 1 for r in found)


def test_no_documents(docs):
    assert q.score_quality(docs([])).count() == 0
