"""All labelled texts are learnt from, wherever their n-grams are looked up."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmweave.llm import language_id
from firmweave.llm.common import Stages
from tests.llm.conftest import invented


def test_texts_of_any_hash_are_learnt_from(spark):
    rng = np.random.default_rng(5)
    # 21,000 texts of one language, and some of the largest hashes in letters that no other text has.
    common = spark.range(21_000, numPartitions=4).select(F.translate(F.sha1(F.col("id").cast("string")), "0123456789", "ghij kl mn").alias("text"))
    greek = spark.createDataFrame([(invented(rng, 12, "αβγδεζ"),) for _ in range(400)], "text string").where("xxhash64(text) > 9e18")
    other = spark.createDataFrame([(invented(rng, 12, "opqrstuvw"), "q") for _ in range(20)], "text string, lang string")
    training = common.union(greek).withColumn("lang", F.lit("p")).union(other)
    texts = [r.text for r in greek.take(3)] + [invented(rng, 12, "αβγδεζ"), invented(rng, 12, "opqrstuvw"), "abc gh"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in language_id.identify(docs, training).collect()}
    with Stages(spark) as st:
        model = language_id.fit(st, training)
    entropies, _ = model.entropies(texts)
    assert [found[i].lang_pred for i in range(len(texts))] == ["p", "p", "p", "p", "q", "p"]
    assert [found[i].cross_entropy for i in range(len(texts))] == pytest.approx(entropies.min(1).tolist(), rel=1e-4)


def test_results_do_not_hang_on_where_grams_are_looked_up(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, invented(rng, 30, letters), lang) for lang, letters in (("a", "abcdeé"), ("b", "defgh"), ("c", "xyz日")) for i in range(40)]
    rows += [(200, "µ", None), (201, "ª ℂ é 日本語", None), (202, None, "a"), (203, "12 !", "b"), (204, "", None), (205, "defg" * 500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = []
    for held, hot in ((1_000_000, 16_000_000), (50, 4_000), (1_000_000, 0)):
        monkeypatch.setattr(language_id, "HELD_GRAMS", held)
        monkeypatch.setattr(language_id, "HOT_BYTES", hot)
        out.append(sorted(map(repr, language_id.identify(docs, docs).collect())))
    assert out[0] == out[1] == out[2]
    with Stages(spark) as st:
        texts = docs.withColumn("fold", F.when(F.col("lang").isNotNull(), language_id.fold(F.col("text"))))
        learnt = language_id.learn(st, texts)  # all are looked up by joins
        found = learnt.rare.collect()
        assert not len(learnt.grams) and found and not learnt.absent.any()
        for m in (0, 1, language_id.FOLDS):  # of all texts, without the first fold, without the last one
            model = language_id.fit(st, texts.where(F.col("fold") != m - 1))
            expected = model.log_probabilities(np.array([r.gram for r in found], np.int64).view(np.uint64))
            assert np.allclose([[r[f"q{3 * m + j}"] / language_id.UNIT for j in range(3)] for r in found], expected, rtol=1e-4)


def test_labelled_texts_are_not_known_by_heart(spark):
    rng = np.random.default_rng(8)
    rows = [(i, invented(rng, 60, "abcdefgh"), "p") for i in range(200)]
    rows += [(900, " ".join(chr(0x4E00 + int(k)) for k in rng.integers(0, 3000, 60)), "p"), (901, invented(rng, 60, "stuvwxyz"), "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language_id.identify(docs, docs).collect()}
    assert [i for i, r in found.items() if r.rejected] == [900]
    assert found[901].lang_pred == "alone"  # no other text has its language
    seen = {r.doc_id: r for r in language_id.identify(docs, docs.where("doc_id < 900")).collect()}
    assert [i for i, r in seen.items() if r.rejected and i != 901] == [900]
