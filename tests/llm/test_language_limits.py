"""Rejection does not hang on the share of foreign texts."""

import numpy as np

from firmweave.llm import language_id
from tests.llm.conftest import invented


def test_foreign_texts_are_rejected_at_any_share(spark):
    rng = np.random.default_rng(9)
    letters = {"p": "abcdefgh", "q": "stuvwxyz"}
    known = [(i, invented(rng, 60, letters["pq"[i % 2]]), "pq"[i % 2]) for i in range(160)]
    foreign = [(1000 + i, " ".join(chr(0x4E00 + int(k)) for k in rng.integers(0, 3000, 60)), None) for i in range(80)]
    docs = spark.createDataFrame(known + foreign, "doc_id long, text string, lang string")  # a third in an unlearned script
    found = {r.doc_id: r.rejected for r in language_id.identify(docs, docs.where("doc_id < 100")).collect()}
    assert all(found[i] for i, _, _ in foreign)
    assert not any(found[i] for i, _, _ in known)
