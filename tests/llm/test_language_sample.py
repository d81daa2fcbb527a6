"""The labelled texts that language models are fitted on."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmweave.llm import language_id
from firmweave.llm.common import Stages
from tests.llm.conftest import invented


@pytest.mark.parametrize("texts", [2, 60, 1000])
def test_sample_is_of_the_least_hashes_and_shuffles_no_text(spark, monkeypatch, texts):
    rng = np.random.default_rng(4)
    made = [(invented(rng, 12), "pq"[i % 3 == 0]) for i in range(300)]
    docs = spark.createDataFrame([*made, *made[:40], (None, "p"), ("no label", None)], "text string, lang string")
    plans, save = [], Stages.save

    def noted(st, df, purpose, keep=False):
        if purpose == "sample":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return save(st, df, purpose, keep)

    monkeypatch.setattr(Stages, "save", noted)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with Stages(spark) as st:
            found = sorted(map(tuple, language_id.sample(st, docs, texts).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    labelled = docs.where("text is not null and lang is not null").withColumn("hash", F.xxhash64("text")).collect()
    last = {x: sorted({r.hash for r in labelled if r.lang == x})[: texts // 2][-1] for x in "pq"}
    assert found == sorted((r.text, r.lang) for r in labelled if r.hash <= last[r.lang])
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0] and "hashpartitioning" not in plans[0]
