"""Every stage of the pipeline gives back the columns that it does not make, whatever their names."""

import numpy as np

import corpus_pipeline
from tests.llm.conftest import invented

NAMES = (
    "row _row gone spans h size id key label a b line line_no d1 d2 simhash first n keys lang_pred score cross_entropy rejected size_class "
    "limit class_limit any_limit n_units kept component_id from length taken start source_no hash rank"
).split()


def test_columns_of_inner_names_keep_their_values(spark):
    rng = np.random.default_rng(1)
    shared = invented(rng, 30)
    rows = []
    for i in range(40):
        text = invented(rng, 60) + "\n" + (shared if i % 4 == 0 else invented(rng, 20)) if i % 10 else rows[0][1] if rows else invented(rng, 90)
        rows.append((i, text, "en" if i % 3 else None, f"s{i % 3}", len(text), *[f"{name} {i}" for name in NAMES]))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == spark.createDataFrame([], schema).columns, name
        found = docs.select("doc_id", "source", *[f"`{n}`" for n in NAMES]).collect()
        assert len(found) >= 30, name
        for r in found:
            assert r.source == f"s{r.doc_id % 3}" and all(r[n] == f"{n} {r.doc_id}" for n in NAMES), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0
