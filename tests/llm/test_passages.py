"""Repeated passages: planted anywhere in lines, with their places, and clean documents left alone."""

import re

import numpy as np

from firmweave.llm import substring_dedup
from tests.llm.conftest import ODD, invented

WORD = re.compile(r"[^\W_]+")


def words(text):
    return [w.lower() for w in WORD.findall(text or "")]


def shares(a, b, n=50):
    """Whether two word lists have a run of n words in common."""
    runs = {tuple(a[i : i + n]) for i in range(len(a) - n + 1)}
    return any(tuple(b[i : i + n]) in runs for i in range(len(b) - n + 1))


def flat(rng, n):
    """Words with commas and full stops, and no line break at the ends."""
    return " ".join(invented(rng, n, "abcdefghij").split()).rstrip(".")


def test_passages_within_lines_are_found_with_their_place(spark, docs):
    rng = np.random.default_rng(1)
    passages = [flat(rng, n) for n in (52, 60, 90)]
    rows, planted = [], {}
    for i in range(60):
        own = flat(rng, int(rng.integers(30, 120))).split(" ")
        if i % 3 == 0:
            k, at = int(rng.integers(0, 3)), int(rng.integers(1, len(own)))
            p = passages[k] if i % 2 else passages[k].upper().replace(",", " -")
            text = " ".join(own[:at]).rstrip(".") + " " + p + " " + " ".join(own[at:])
            planted[i] = k
        else:
            text = " ".join(own)
        rows.append((i, text))
    order = rng.permutation(len(rows)).tolist()
    found = {}
    for r in substring_dedup.repeated_passages(docs([rows[k] for k in order] + ODD)).collect():
        found.setdefault(r.doc_id, []).append(r)
    firsts = {min(d for d, k in planted.items() if k == kk): kk for kk in set(planted.values())}
    texts = dict(rows)
    for doc, k in planted.items():
        if doc in firsts:
            assert doc not in found
            continue
        (r,) = found.pop(doc)
        assert words(texts[doc][r.start : r.end]) == words(passages[k]) and r.n_words == len(words(passages[k]))
        assert firsts[r.kept_doc_id] == k
    assert set(found) <= {55}  # clean documents are left alone; "word " over and over repeats within itself


def test_copies_keep_the_earliest_and_short_repeats_stay(docs):
    rng = np.random.default_rng(2)
    text = invented(rng, 200)
    short = flat(rng, 30)
    rows = [(9, text), (4, text), (None, text), (4, text), (1, short + ". " + flat(rng, 60)), (2, flat(rng, 40) + ". " + short), (3, None), (5, "")]
    found = substring_dedup.repeated_passages(docs(rows)).collect()
    assert sorted(((r.doc_id, r.start, r.end, r.kept_doc_id) for r in found), key=repr) == sorted(
        [(9, 0, len(text.rstrip(" .\n")), 4), (None, 0, len(text.rstrip(" .\n")), 4)], key=repr
    )
    out = substring_dedup.remove_passages(docs(rows))
    assert out.columns == [*docs([]).columns, "kept_spans"]
    left = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    rest = text[len(text.rstrip(" .\n")) :]
    assert left == sorted([(9, rest), (4, text), (None, rest), (4, text), *rows[4:]], key=repr)
    for r in out.collect():
        original = text if r.doc_id in (9, 4, None) else dict(rows)[r.doc_id]
        assert r.text is None and not r.kept_spans or r.text == "".join(original[s.start : s.end] for s in r.kept_spans)
    assert substring_dedup.repeated_passages(docs([])).count() == 0 and substring_dedup.remove_passages(docs([])).count() == 0


def test_recall_against_all_runs_of_words(spark, docs):
    """Near copies with changed words: reported are only documents that share 50 words with an earlier one, and nearly all of them."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        if i < 10 or rng.random() < 0.3:
            text = invented(rng, 150)
        else:
            parts = rows[int(rng.integers(0, len(rows)))][1].split(" ")
            for _ in range(int(rng.integers(1, 6))):
                parts[int(rng.integers(0, len(parts)))] = "changed"
            text = " ".join(parts)
        rows.append((i, text))
    found = {r.doc_id for r in substring_dedup.repeated_passages(docs(rows)).collect()}
    true = {i for i, t in rows if any(shares(words(t), words(u)) for j, u in rows if j < i)}
    assert found <= true and len(found) >= 0.9 * len(true) > 5
