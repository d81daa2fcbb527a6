"""Mixing, language identification, licence scans and the pipeline."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from firmweave.llm import language_id, license_scan, mixing
from tests.llm.conftest import ODD, invented


def test_targets_share_the_excess():
    assert mixing.targets([100, 100], [5, 1], 150) == [125.0, 25.0]
    found = mixing.targets([10, 100, 100, 0], [5, 2, 1, 5], 315)
    assert found[0] == 20 and found[3] == 0 and math.isclose(found[1] / found[2], 2, rel_tol=0.01) and math.isclose(sum(found), 315)
    assert mixing.targets([10], [5], 15) == [15.0] and mixing.targets([], [], 0) == []
    assert mixing.targets([10, 10], [1, 1], 100) == [20, 20]


def test_permutations_hit_every_place_once():
    for count in (1, 2, 3, 10, 1000, 4097):
        for seed in (1, 2):
            assert sorted(mixing._permuted(np.arange(count), count, seed).tolist()) == list(range(count))


def test_shards_share_out_the_slots(monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 10)
    slots, regions = np.array([1234, 57, 0, 301]), 3
    taken = []
    for region in range(regions):
        for shard in range(60):
            counts, start = mixing._shard_counts(slots, region, regions, shard, 5)
            assert counts.sum() in (0, 10) or counts.sum() < 10
            taken += [(s, int(start[s]) + k) for s in range(4) for k in range(int(counts[s]))]
    assert Counter(taken) == Counter((s, i) for s in range(4) for i in range(int(slots[s])))


def rows_of(rng, n=90):
    rows = [(i, invented(rng, int(rng.integers(0, 60))), ["a", "b", "c", "é", None][min(int(rng.exponential(1)), 4)]) for i in range(n)]
    return rows + [(*r, "odd") for r in ODD if r[0] != 55]


def test_the_mix_meets_its_targets(docs):
    rng = np.random.default_rng(1)
    rows = rows_of(rng)
    size = Counter()
    for _, text, source in rows:
        size[source] += len((text or "").encode().split())
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    goals = mixing.targets([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(size.values()))
    found = mixing.word_counts_taken(docs(rows), block=16).collect()
    assert len(found) == len(rows)
    sources, taken = defaultdict(set), Counter()
    for r in found:
        assert r.taken <= 2 * r.size
        taken[r.source_size, round(r.target, 6)] += r.taken
    assert taken == Counter({(size[s], round(g, 6)): round(g) for s, g in zip(names, goals, strict=True)})
    again = mixing.word_counts_taken(docs(rows).repartition(5), block=16).collect()
    assert sorted(found, key=repr) == sorted(again, key=repr)
    assert not sources


def test_mixed_documents_hold_the_words_taken(docs):
    rng = np.random.default_rng(2)
    rows = rows_of(rng)
    frame = docs(rows)
    out = mixing.mix_documents(frame, block=16)
    assert out.columns == frame.columns
    words, texts = Counter(), {(d, s): t for d, t, s in rows}
    for r in out.collect():
        words[r.doc_id] += len(r.text.encode().split())
        assert r.n_chars == len(r.text) and r.text in texts[r.doc_id, r.source]
    taken = Counter()
    for r in mixing.word_counts_taken(frame, block=16).collect():
        taken[r.doc_id] += r.taken
    assert +words == +taken
    assert mixing.mix_documents(docs([])).count() == 0 and mixing.word_counts_taken(docs([])).count() == 0


def test_smoothed_probabilities_add_up():
    grams = np.concatenate([language_id.grams(language_id.characters(t), 4) for t in ("abra kadabra abra", "aba")])
    keys, counts = np.unique(grams, return_counts=True)
    model = language_id.Model(["x"], np.zeros(len(keys), int), keys, counts.astype(float))
    alphabet = sorted({int(k) & 0xFFFF for k in keys})
    for context in ("abr", "  a", "zzz", "ab "):
        base = 0
        for c in context:
            base = base << 16 | ord(c)
        codes = np.array([base << 16 | c for c in alphabet], np.uint64)
        total = float(np.exp(model.log_probabilities(codes)).sum())
        unseen = float(np.exp(model.log_probabilities(np.array([base << 16 | 0x263A], np.uint64)))[0, 0])
        assert abs(total + unseen - 1) < 1e-3


def test_languages_are_told_apart_and_odd_texts_rejected(spark):
    rng = np.random.default_rng(3)
    letters = {"p": "abcdefgh", "q": "stuvwxyzé"}
    rows = [(i, invented(rng, 60, letters["pq"[i % 2]]), "pq"[i % 2]) for i in range(160)]
    rows += [(None, None, "p"), (900, "", "q"), (901, "12 34 !", None), (902, "stuv" * 20000, None), (903, "abc", None)]
    rows += [(904, " ".join(chr(0x4E00 + int(k)) for k in rng.integers(0, 3000, 60)), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.identify(docs, docs.where("doc_id < 100")).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert all(by[i].lang_pred == "pq"[i % 2] and by[i].score > 0.99 and not by[i].rejected for i in range(100, 160))
    for i in (None, 900, 901):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[902].lang_pred == "q" and by[903].lang_pred == "p" and by[904].rejected
    nothing = language_id.identify(docs, docs.limit(0)).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and language_id.identify(docs.limit(0), docs).count() == 0


def test_licences_by_text_and_by_line(docs):
    mit = "The MIT License (MIT)\n\nCopyright (c) 2020 A. Body\n\n" + license_scan.TEXTS["MIT"][2].upper()
    rows = [
        (1, mit),
        (2, "prose\nThis work is licenced under the GNU General Public Licence, v3\nmore\nCopyright 2020 me"),
        (3, "Licensed under CC BY-NC 4.0.\n(c) x\nReleased under the MIT licence"),
        (4, "a licence is needed, he said"),
        *ODD,
    ]
    found = {r.doc_id: r for r in license_scan.scan_licenses(docs(rows)).collect()}
    assert (found[1].text_license, found[1].n_copyright_lines) == ("MIT", 1)
    assert (found[2].line_licenses, found[2].n_license_lines, found[2].n_copyright_lines) == ("GPL-3.0", 1, 1)
    assert (found[3].line_licenses, found[3].n_copyright_lines) == ("CC-BY-NC-4.0,MIT", 1)
    for i in (4, None, 50, 55):
        assert (found[i].text_license, found[i].line_licenses, found[i].n_license_lines) == (None, "", 0)
    assert license_scan.scan_licenses(docs([])).count() == 0


def test_licence_lines_are_found_in_every_spelling(docs):
    """Each known statement as it is, in SPDX form and with other white space: nothing is left out before it is normalised."""
    spdx = ["CC-BY-4.0", "Released under the CC-BY-SA 4.0", "CC\tBY  4.0", "MPL-2.0", "Distributed under the MPL-2.0.", "(cc0)"]
    plain = [form for forms in license_scan.NAMES.values() for form in forms]
    short = {form: name for name, forms in license_scan.NAMES.items() for form in forms if form.startswith(("CC", "MPL"))}
    lines = spdx + plain + [form.replace(" ", "-") for form in short] + [form.replace(" ", " \t ").upper() for form in short]
    found = {r.doc_id: r for r in license_scan.scan_licenses(docs([*enumerate(lines), (9999, "\n".join(lines))])).collect()}
    names = [name for name, forms in license_scan.NAMES.items() for _ in forms]
    expected = ["CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-4.0", "MPL-2.0", "MPL-2.0", "CC0-1.0"] + names + 2 * [*short.values()]
    assert [found[i].line_licenses for i in range(len(lines))] == expected
    assert found[9999].n_license_lines == len(lines)


def test_entire_texts_beyond_two_and_those_of_a_caller(spark, docs):
    from pathlib import Path

    folder = Path(license_scan.__file__).parent / "licenses"
    long = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC-BY-SA-4.0", "CC0-1.0"]
    bsd = "Copyright (c) 2020, A. Body\nAll rights reserved.\n\n" + license_scan._BSD_TERMS.replace("1.", "*").replace("2.", "*")
    rows = [(i, (folder / f"{name}.txt").read_text().replace("\n", "  \r\n")) for i, name in enumerate(long)]
    rows += [(20, bsd.replace("*", "1.", 1).replace("*", "2.", 1).lower() + license_scan._BSD_END.format("COPYRIGHT HOLDERS", "COPYRIGHT HOLDER"))]
    rows += [(21, "BSD 3-Clause License\n\n" + license_scan._BSD_TERMS + license_scan._BSD_NAMES.format("copyright holder") + license_scan._BSD_END.format("COPYRIGHT HOLDERS", "COPYRIGHT OWNER"))]
    rows += [(22, license_scan._APACHE_NOTICE), (23, "Our own terms:  do as you like."), (24, ""), (25, None)]
    own = spark.createDataFrame([("Own-1", "Our own terms: do as you like."), ("Own-2", "our own terms do as you like"), (None, "x"), ("Blank", "")], "license string, text string")
    found = {r.doc_id: r.text_license for r in license_scan.scan_licenses(docs(rows), own).collect()}
    assert len(found) == len(rows)
    assert [found[i] for i in range(len(long))] == long
    assert [found[i] for i in range(20, 26)] == ["BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "Own-1", None, None]


@pytest.mark.parametrize("name", ["op6_exact_top_k", "op7_substring_dedup", "op9_license_scan"])
def test_queries_agree_with_their_sql(spark, name):
    import duckdb

    from firmweave.llm.queries import ORACLE_SQL, QUERIES
    from tests.conftest import SF_DIR

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = con.execute(ORACLE_SQL[name])
    names = sorted(d[0] for d in cursor.description)
    expected = Counter(tuple(dict(zip([d[0] for d in cursor.description], r, strict=True))[n] for n in names) for r in cursor.fetchall())
    out = QUERIES[name](spark, SF_DIR)
    assert sorted(out.columns) == names
    assert Counter(tuple(r[n] for n in names) for r in out.collect()) == expected


def test_the_pipeline_keeps_the_columns_and_ends_in_sequences(spark):
    import corpus_pipeline
    from tests.conftest import SF_DIR

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and out.count() > 0, name
        docs = out
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(packed.columns) and packed.count() > 0
