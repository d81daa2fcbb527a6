"""The language models against counting by hand, and what they learn from."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from firmweave.llm import language_id
from firmweave.llm.common import Stages
from tests.llm.conftest import invented


def plain_model(texts):
    """Kneser-Ney probabilities by dictionaries: a function of (characters before, character)."""
    grams = {k: Counter() for k in range(1, 5)}
    for text in texts:
        units = [" "] * (language_id.ORDER - 2) + [chr(u) for u in language_id.characters(text).tolist()]
        for i in range(len(units) - 3):
            grams[4]["".join(units[i : i + 4])] += 1
    for k in (3, 2, 1):
        for g in grams[k + 1]:
            grams[k][g[1:]] += 1
    contexts = {k: defaultdict(list) for k in grams}
    for k, counter in grams.items():
        for g, n in counter.items():
            contexts[k][g[:-1]].append(n)

    def probability(before, char, kinds, k=4):
        if k == 0:
            return 1 / (kinds + 1)
        context = before[len(before) - k + 1 :]
        lower = probability(before, char, kinds, k - 1)
        counts = contexts[k].get(context)
        if not counts:
            return lower
        total, d = sum(counts), language_id.DISCOUNT
        return max(grams[k][context + char] - d, 0) / total + d * len(counts) / total * lower

    return grams, probability


def test_cross_entropies_are_those_of_dictionaries(spark):
    rng = np.random.default_rng(3)
    rows = [(i, invented(rng, 40, letters), lang) for lang, letters in (("a", "abcdeé"), ("b", "defgh"), ("c", "xyz日")) for i in range(5)]
    docs = spark.createDataFrame([*rows, (90, None, "a"), (91, "12 !", "b"), (92, "text", None)], "doc_id long, text string, lang string")
    with Stages(spark) as st:
        model = language_id.fit(st, docs)
    assert model.languages == ["a", "b", "c"]
    models = {x: plain_model([t for _, t, y in rows if y == x]) for x in model.languages}
    kinds = len(set().union(*(m[0][1] for m in models.values())))
    texts = [invented(rng, 20, "abcdefghxyz"), "µ", "ª ℂ", "日本語 é", rows[0][1]]
    found, sizes = model.entropies(texts)
    for text, row, size in zip(texts, found, sizes, strict=True):
        units = [" "] * (language_id.ORDER - 2) + [chr(u) for u in language_id.characters(text).tolist()]
        assert size == len(units) - 3
        for x, value in zip(model.languages, row, strict=True):
            expected = -sum(math.log(models[x][1]("".join(units[i : i + 3]), units[i + 3], kinds)) for i in range(size)) / size
            assert value == pytest.approx(expected, rel=1e-4)


ODD_LETTERS = ["ª", "µ", "µ ℂ", "ℂ ª", "\U0001d400", "ǅ", "ﬀ"]


def test_single_odd_letters_anywhere_in_a_chunk(spark):
    rng = np.random.default_rng(4)
    known = [(i, invented(rng, 40, "abcdefgh"), "p") for i in range(40)]
    for place in ("alone", "first", "last", "among"):
        odd = [(100 + i, t, None) for i, t in enumerate(ODD_LETTERS)] + [(200, "!! 12", None), (201, "", None), (202, None, None)]
        rows = {"alone": odd[:1], "first": odd + known, "last": known + odd, "among": known[:20] + odd + known[20:]}[place]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
        training = spark.createDataFrame(known, "doc_id long, text string, lang string")
        found = {r.doc_id: r for r in language_id.identify(docs, training).collect()}
        assert len(found) == len(rows)
        for r in found.values():
            has = r.doc_id < 200
            assert r.lang_pred == ("p" if has else "und") and 0 <= r.score <= 1 and (has or r.rejected)


def test_every_language_has_its_share_of_the_sample(spark):
    rng = np.random.default_rng(7)
    rows = [(i, invented(rng, 60, "abcdefgh"), "large") for i in range(300)] + [(1000 + i, invented(rng, 20, "stuvwxyz"), "rare") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with Stages(spark) as st:
        taught = language_id.sample(st, docs, 40)
        assert {r.lang: r["count"] for r in taught.groupBy("lang").count().collect()} == {"large": 20, "rare": 3}
        assert sorted(map(tuple, language_id.sample(st, docs.repartition(3), 40).collect())) == sorted(map(tuple, taught.collect()))
        model = language_id.fit(st, taught)
    found, _ = model.entropies([invented(rng, 30, "stuvwxyz"), invented(rng, 30, "abcdefgh")])
    assert found.argmin(1).tolist() == [1, 0]


def test_columns_of_the_results_names_are_kept(spark):
    rng = np.random.default_rng(8)
    rows = [(i, invented(rng, 30, "abcdefgh"), "p", "theirs", -1.0, "x", True, 7, 8.0) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double, limit string, rejected boolean, size_class int, any_limit double")
    out = language_id.identify(docs, docs, keep_text=True)
    names = language_id.result_names(docs.columns)
    assert names["rejected"] == "_rejected" and out.columns == [*docs.columns, *[names[c] for c in ("lang_pred", "score", "cross_entropy", "rejected")]]
    assert sorted(map(tuple, out.select(docs.columns).collect())) == sorted(rows)
    assert {r._lang_pred for r in out.collect()} == {"p"}
