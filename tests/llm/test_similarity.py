"""Near documents, near lines, repeated units and exact search against brute force."""

from collections import defaultdict

import numpy as np
import pytest

from firmweave.llm import line_dedup, linking, near_dedup, substring_dedup, topk_search
from firmweave.llm.common import Stages, word_hashes
from tests.llm.conftest import ODD, invented


def grouped(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


def changed(rng, text, share):
    words = text.split(" ")
    return " ".join(w if rng.random() > share else "zq" + w[::-1] for w in words)


def copies(rng, base, n, share):
    return [changed(rng, base, share * rng.random()) for _ in range(n)]


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


@pytest.mark.parametrize("small", [24, 3])
def test_near_documents_are_those_of_all_pairs(docs, monkeypatch, small):
    monkeypatch.setattr(linking, "SMALL", small)  # 3: what is left is compared in chunks
    monkeypatch.setattr(near_dedup, "CHUNK_SHINGLES", 400)
    rng = np.random.default_rng(1)
    texts = [t for k in range(4) for t in copies(rng, invented(rng, 80 + 10 * k), 25, 0.09)]
    rows = ODD[2:] + [(100 + i, t) for i, t in enumerate(texts)] + [(300 + i, texts[i]) for i in range(0, 60, 7)]
    sets = [shingles(t, 4) for _, t in rows]
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    group = grouped(len(rows), pairs)
    least = defaultdict(lambda: 10**9)
    for (d, _), g in zip(rows, group, strict=True):
        least[g] = min(least[g], d)
    expected = sorted((d, len(s), least[g], d == least[g]) for (d, _), s, g in zip(rows, sets, group, strict=True))
    found = near_dedup.near_duplicates(docs(rows), 4, 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == expected


def test_near_documents_without_ids_or_rows(docs):
    found = near_dedup.near_duplicates(docs([(None, "a b c d e"), (None, "a b c d e"), (7, "a b c d e"), (None, None)])).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in found), key=repr) == sorted(
        [(None, 7, False), (None, 7, False), (7, 7, True), (None, None, True)], key=repr
    )
    assert near_dedup.near_duplicates(docs([])).count() == 0
    left = near_dedup.drop_near_duplicates(docs([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)]))
    assert left.columns == docs([]).columns and sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_the_estimate_is_near_the_truth():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.8, 0.95):
        a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
        b = np.concatenate((a[: int(4000 * 2 * share / (1 + share))], rng.integers(0, 2**63, int(4000 - 4000 * 2 * share / (1 + share)), dtype=np.uint64)))
        registers = near_dedup.sketch([np.sort(a), np.sort(b)]).astype(int)
        both = near_dedup.sketch([np.union1d(a, b)]).astype(int)
        assert (registers.max(0) == both[0]).all()  # mergeable
        sizes = np.array([4000.0]), np.array([float(len(b))])
        assert abs(near_dedup.estimate(registers[:1], registers[1:], *sizes)[0] - share) < 0.17


def test_components_of_long_chains_and_stars(spark):
    rng = np.random.default_rng(3)
    order = rng.permutation(60).tolist()
    pairs = list(zip(order[:40], order[1:40], strict=False)) + [(order[45], x) for x in order[46:]]
    with Stages(spark) as st:
        found = linking.components(st, spark.createDataFrame([(min(p), max(p)) for p in pairs], "a long, b long"))
        labels = {r.id: r.label for r in found.collect()}
    group = grouped(60, pairs)
    assert labels == {x: group[x] for p in pairs for x in p}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def limit(a, b):
    size = max(len(a.decode()), len(b.decode()))
    return next((d for bound, d in line_dedup.DISTANCES if size < bound), line_dedup.DISTANCE)


@pytest.mark.parametrize("small", [24, 3])
def test_near_documents_are_those_of_all_pairs(docs, monkeypatch, small):
    monkeypatch.setattr(linking, "SMALL", small)  # 3: what is left is compared in chunks
    monkeypatch.setattr(near_dedup, "CHUNK_SHINGLES", 400)
    rng = np.random.default_rng(1)
    texts = [t for k in range(4) for t in copies(rng, invented(rng, 80 + 10 * k), 25, 0.09)]
    rows = ODD[2:] + [(100 + i, t) for i, t in enumerate(texts)] + [(300 + i, texts[i]) for i in range(0, 60, 7)]
    sets = [shingles(t, 4) for _, t in rows]
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    group = grouped(len(rows), pairs)
    least = defaultdict(lambda: 10**9)
    for (d, _), g in zip(rows, group, strict=True):
        least[g] = min(least[g], d)
    expected = sorted((d, len(s), least[g], d == least[g]) for (d, _), s, g in zip(rows, sets, group, strict=True))
    found = near_dedup.near_duplicates(docs(rows), 4, 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == expected


def test_near_documents_without_ids_or_rows(docs):
    found = near_dedup.near_duplicates(docs([(None, "a b c d e"), (None, "a b c d e"), (7, "a b c d e"), (None, None)])).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in found), key=repr) == sorted(
        [(None, 7, False), (None, 7, False), (7, 7, True), (None, None, True)], key=repr
    )
    assert near_dedup.near_duplicates(docs([])).count() == 0
    left = near_dedup.drop_near_duplicates(docs([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)]))
    assert left.columns == docs([]).columns and sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_the_estimate_is_near_the_truth():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.8, 0.95):
        a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
        b = np.concatenate((a[: int(4000 * 2 * share / (1 + share))], rng.integers(0, 2**63, int(4000 - 4000 * 2 * share / (1 + share)), dtype=np.uint64)))
        registers = near_dedup.sketch([np.sort(a), np.sort(b)]).astype(int)
        both = near_dedup.sketch([np.union1d(a, b)]).astype(int)
        assert (registers.max(0) == both[0]).all()  # mergeable
        sizes = np.array([4000.0]), np.array([float(len(b))])
        assert abs(near_dedup.estimate(registers[:1], registers[1:], *sizes)[0] - share) < 0.17


def test_components_of_long_chains_and_stars(spark):
    rng = np.random.default_rng(3)
    order = rng.permutation(60).tolist()
    pairs = list(zip(order[:40], order[1:40], strict=False)) + [(order[45], x) for x in order[46:]]
    with Stages(spark) as st:
        found = linking.components(st, spark.createDataFrame([(min(p), max(p)) for p in pairs], "a long, b long"))
        labels = {r.id: r.label for r in found.collect()}
    group = grouped(60, pairs)
    assert labels == {x: group[x] for p in pairs for x in p}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def limit(a, b):
    size = max(len(a.decode()), len(b.decode()))
    return next((d for bound, d in line_dedup.DISTANCES if size < bound), line_dedup.DISTANCE)


def agree(x, y, a, b):
    """Whether two sketches agree enough for their lines to be compared."""
    same = sum((int(x) >> 8 * k & 255) == (int(y) >> 8 * k & 255) for k in range(8))
    return same >= line_dedup.AGREE or max(len(a.decode()), len(b.decode())) < line_dedup.FEW


@pytest.mark.parametrize("small", [24, 3])
def test_near_lines_are_those_of_all_pairs(docs, monkeypatch, small):
    monkeypatch.setattr(linking, "SMALL", small)
    monkeypatch.setattr(line_dedup, "SMALL", small)
    rng = np.random.default_rng(4)
    lines = [x for _ in range(3) for x in copies(rng, " ".join(invented(rng, 60).split()), 14, 0.06)]
    lines += ["Short one.", "short  ONE", "page 12 of 90", "Page 37 of 11", "!!!", ""]
    order = rng.permutation(len(lines)).tolist()
    rows = [(i, "\n".join(lines[k] for k in order[i * 4 : i * 4 + 4])) for i in range(len(order) // 4 + 1)] + ODD[:5]
    flat = [(d, k, line_dedup.normal_line(x)) for d, t in rows for k, x in enumerate((t or "").split("\n"))]
    flat = sorted((x for x in flat if x[2]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    hashes = line_dedup.simhashes([x[2] for x in flat])
    pairs = []
    for i, (_, _, a) in enumerate(flat):
        for j in range(i):
            b = flat[j][2]
            near = int(np.bitwise_count(hashes[i] ^ hashes[j])) <= limit(a, b)
            if a == b or near and edits(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-9):
                pairs.append((i, j))
    group = grouped(len(flat), pairs)
    expected = sorted((flat[i][0] if flat[i][0] is not None else -1, flat[i][1], flat[g][0], flat[g][1], group.count(g)) for i, g in enumerate(group) if i != g)
    found = line_dedup.removed_lines(docs(rows), 0.9).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.line_no, r.kept_doc_id, r.kept_line_no, r.occurrences) for r in found) == expected
    assert any(a != b for a, b in pairs if flat[a][2] != flat[b][2])


def candidates(line, other):
    """Whether two normalised lines share a key: of their text, or a block of their SimHashes (lengths are alike)."""
    x, y = line_dedup.text_keys([line, other])
    p, q = (int(h) for h in line_dedup.simhashes([line, other]))
    width = 64 // line_dedup.BLOCKS
    blocks = any((p >> width * k) % 2**width == (q >> width * k) % 2**width for k in range(line_dedup.BLOCKS))
    return bool(set(x) & set(y)) or blocks


@pytest.mark.parametrize("words", [2, 4, 6, 8, 15, 30, 80])
def test_lines_with_a_changed_word_or_letters_are_candidates(words):
    """Recall of the candidates against edit similarity alone."""
    rng = np.random.default_rng(words)
    met = within = total = 0
    for _ in range(60):
        line = " ".join(" ".join(invented(rng, words, "abcdefghijklmnop").split()).replace(".", "").split())
        at = int(rng.integers(0, len(line)))
        spelt = line[:at] + ("", "z", "zq")[int(rng.integers(0, 3))] + line[at + int(rng.integers(0, 2)) :]
        cut = line.split(" ")
        for _ in range(int(rng.integers(1, max(2, words // 15)))):
            cut[int(rng.integers(0, len(cut)))] = "".join(rng.choice(list("qrstuvw"), 4))
        for other in (spelt, " ".join(cut)):
            a, b = line_dedup.normal_line(line), line_dedup.normal_line(other)
            if a != b and edits(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-9):
                total += 1
                met += candidates(a, b)
                x, y = line_dedup.simhashes([a, b])
                within += int(np.bitwise_count(x ^ y)) <= limit(a, b)
    assert total and met >= 0.95 * total and within >= 0.95 * total
    assert words > 5 or met == total


def test_normal_lines_and_hashes_are_those_of_single_lines():
    rng = np.random.default_rng(8)
    texts = [t for _, t in ODD if t] + ["ÀÉß ²½ª_x\x85y\xa0z  10%\r\n\n 9.9", "İ Σς\n日本 12", invented(rng, 300, "abcdefghÄé")]
    for text in texts:
        assert line_dedup.normal_lines(text) == [line_dedup.normal_line(x) for x in text.split("\n")]
    lines = [x for t in texts for x in line_dedup.normal_lines(t)] + [b"w" * 400 + b" a b", b"ab cd " * 12_000, b"x" * 70_000]
    together = line_dedup.simhashes(lines)
    for line, found in zip(lines, together, strict=True):
        assert line_dedup.simhashes([line])[0] == found
        total = np.zeros(64, np.int64)
        for w in line.split():
            h = word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))
            bits = np.unpackbits(line_dedup.mix64(h + line_dedup._STEP).view(np.uint8)).astype(np.int64)
            total += (2 * bits - 1) * len(w)
        assert np.packbits(total > 0).view(np.uint64)[0] == found


def test_documents_lose_their_repeated_lines_only(docs):
    rows = [(2, "first line here\nsecond\n\nFIRST line, here"), (1, "second\nthird"), (3, None), (4, "second"), (4, "second")]
    out = line_dedup.dedup_lines(docs(rows))
    assert out.columns == docs([]).columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect() if r.doc_id != 3) == [
        (1, "second\nthird", 12), (2, "first line here\n", 16), (4, "", 0), (4, "", 0),
    ]
    assert line_dedup.dedup_lines(docs([])).count() == 0


def test_hashes_of_like_lengths_within_the_blocks_reach_share_a_key(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63 - 1, 300)
    near = [int(np.bitwise_xor(x, np.bitwise_or.reduce(np.int64(1) << rng.choice(63, line_dedup.BLOCKS - 1, replace=False)))) for x in base]
    sizes = rng.integers(1, 3000, 300)
    rows = [(int(a), int(n), int(b), int(m)) for a, b, n in zip(base, near, sizes, strict=True) for m in (n, -(-9 * n // 10))]
    frame = spark.createDataFrame(rows, "a long, n int, b long, m int")
    met = frame.select(F.arrays_overlap(line_dedup.block_keys(F.col("a"), F.col("n")), line_dedup.block_keys(F.col("b"), F.col("m"))).alias("met"))
    assert met.where("met").count() == len(rows)


def test_repeated_units_carry_their_place(docs):
    rows = [
        (5, "Alpha beta, gamma delta\nother words that stay here"),
        (3, "x\n  alpha BETA gamma: delta!  \ntoo few words"),
        (9, "too few words\nalpha beta gamma delta\nalpha beta gamma delta"),
        (None, "ALPHA BETA GAMMA DELTA"),
        *ODD,
    ]
    found = substring_dedup.repeated_units(docs(rows)).collect()
    texts = dict(rows)
    mine = sorted((-1 if r.doc_id is None else r.doc_id, r.unit_no, r.kept_doc_id, r.kept_unit_no, r.occurrences) for r in found)
    assert mine == [(-1, 0, 3, 1, 5), (5, 0, 3, 1, 5), (9, 1, 3, 1, 5), (9, 2, 3, 1, 5)]
    for r in found:
        if r.doc_id is not None:
            assert substring_dedup.normal_unit(texts[r.doc_id][r.start : r.end]) == "alpha beta gamma delta"
    assert substring_dedup.repeated_units(docs([])).count() == 0


@pytest.mark.parametrize(("scale", "spread"), [(64, 1.0), (64, 1e5), (3, 0.4)])
def test_top_k_is_that_of_all_products(spark, monkeypatch, scale, spread):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk_search, "TILE_QUERIES", 7)
    rng = np.random.default_rng(6)
    vectors = [(i, (spread * rng.normal(size=9)).round(3).tolist()) for i in range(300)]
    vectors += [(i, vectors[i % 5][1]) for i in range(300, 420)]  # ties
    odd = [(900, None), (None, vectors[0][1]), (920, [1.0] * 8 + [None]), (940, [float("nan")] * 9), (960, []), (980, [1.0, 2.0]), (981, [2.0, 1.0])]
    rows = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").repartition(3)
    found = topk_search.top_k(rows, rows.where("vec_id % 20 = 0"), k=6, scale=scale).collect()
    held = {i: np.floor(scale * np.array(v)).astype(np.int64) for i, v in vectors + odd[5:]}
    expected = []
    for q in held:
        if q % 20 == 0:
            scores = sorted((-int(held[q] @ v), i) for i, v in held.items() if i != q and len(v) == len(held[q]))
            expected += [(q, k, i, -s) for k, (s, i) in enumerate(scores[:6], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == sorted(expected)


def test_top_k_of_few_or_no_rows(spark):
    rows = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id, r.score) for r in topk_search.top_k(rows, rows.where("vec_id = 0")).collect()] == [(0, 1, 64 * 128)]
    assert topk_search.top_k(rows.limit(0), rows.limit(0)).count() == 0
