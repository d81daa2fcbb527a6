"""Buckets of lines that have nothing to do with each other."""

import numpy as np

from firmweave.llm import line_dedup


def test_lines_that_are_not_alike_rarely_share_a_key(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(9)
    common = ["of", "the", "a", "in", "to", "and", "is", "it"]
    words = ["".join(rng.choice(list("aeiourstnl"), int(rng.integers(4, 9)))) for _ in range(3000)]
    lines = [" ".join(str(rng.choice(common)) if rng.random() < 0.5 else str(rng.choice(words)) for _ in range(40)) for _ in range(1500)]
    lines = [line_dedup.normal_line(x) for x in lines]
    rows = [(i, int(h), len(x), k) for i, (x, h, k) in enumerate(zip(lines, line_dedup.simhashes(lines).view(np.int64), line_dedup.text_keys(lines), strict=True))]
    frame = spark.createDataFrame(rows, "id int, simhash long, size int, keys array<long>")
    keys = frame.select("id", F.explode(F.concat(line_dedup.block_keys(F.col("simhash"), F.col("size")), "keys")).alias("key"))
    met = keys.groupBy("key").count().where("count > 1").agg(F.sum("count").alias("n")).first().n or 0
    assert met < 0.1 * keys.count()


def test_a_common_line_is_met_once_per_chunk(docs):
    rows = [(i, "the very same line in all of them\nand line number " + "abcdefghij"[i % 10] * 30) for i in range(200)]
    found = line_dedup.removed_lines(docs(rows)).collect()
    assert len(found) == 199 + 190
    assert {(r.kept_doc_id, r.occurrences) for r in found if r.line_no == 0} == {(0, 200)}
    assert {(r.kept_doc_id, r.occurrences) for r in found if r.line_no == 1} == {(k, 20) for k in range(10)}


def test_near_copies_in_a_bucket_give_a_link_each(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(line_dedup, "BLOCK", 16)
    n, base = 60, "a line that all of them have in common but for the letters at its end, "
    lines = [base + chr(97 + i % 26) + chr(97 + i // 26) for i in range(n)] + ["nothing that the others have " * 2]
    n += 1
    rows = {
        "key": [5] * n, "i": [0] * n, "j": [0] * n, "left": [True] * n, "right": [True] * n, "id": list(range(n)), "label": list(range(n)),
        "simhash": [0] * n, "size": [len(x) for x in lines], "parity": line_dedup.parities(lines).view(np.int64), "keys": [[5, 9]] * n, "line": lines,
    }
    again = rows | {"key": [9] * n}  # their other key: every pair was compared under the first
    batches = [b for r in (rows, again) for b in pa.table(r).to_batches(max_chunksize=25)]
    links = [(a, b) for out in line_dedup._tied(0.9)(iter(batches)) for a, b in zip(*out.to_pydict().values(), strict=True)]
    assert len(links) == n - 2 and {x for link in links for x in link} == set(range(n - 1))


def test_an_edit_changes_four_parities_at_most():
    rng = np.random.default_rng(3)
    for _ in range(300):
        line = "".join(rng.choice(list("abc é日"), int(rng.integers(1, 70))))
        at, kind = int(rng.integers(0, len(line))), int(rng.integers(0, 3))
        other = line[:at] + ("x" if kind else "") + line[at + (kind < 2) :]
        p, q = line_dedup.parities([line, other])
        assert int(np.bitwise_count(p ^ q)) <= 4


def test_copies_are_found_across_chunks(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "CHUNK", 4)
    monkeypatch.setattr(line_dedup, "PENDING", 10)
    rng = np.random.default_rng(6)
    text = "".join(rng.choice(list("abcdefgh "), 600))
    rows = [(i, text[:20] + "".join(rng.choice(list("xyz"), 5)) + text[25:]) for i in range(40)]
    found = line_dedup.removed_lines(docs(rows)).collect()
    assert {(r.kept_doc_id, r.occurrences) for r in found} == {(0, 40)} and len(found) == 39


def test_texts_are_joined_alike_at_any_size(docs, monkeypatch):
    plans, save = [], line_dedup.Stages.save

    def saved(self, df, purpose, keep=False):
        if purpose == "line-deduplicated":
            plans.append(df._jdf.queryExecution().toString())
        return save(self, df, purpose, keep)

    monkeypatch.setattr(line_dedup.Stages, "save", saved)
    left = line_dedup.dedup_lines(docs([(1, "one line here\nand another"), (2, "one line here"), (3, None)]))
    assert {r.doc_id: r.text for r in left.collect()} == {1: "one line here\nand another", 2: "", 3: None}
    assert "ShuffledHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
