"""The manifest against a plain Merkle tree, and what tampering does to it."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from firmweave.llm import merkle
from firmweave.llm.merkle import sha


def text_of(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of (doc_id, source, lang, n_chars, text) rows."""
    by_source = {}
    for row in rows:
        doc, source, lang, n, text = row
        seen = text
        if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 5 == 0:
            seen = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf, now = (sha("".join(map(text_of, (doc, source, lang, n, t)))) for t in (text, seen))
        by_source.setdefault(source, []).append(((doc is not None, doc or 0), leaf, now, doc))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        by_source[source].sort()
        trees.append(plain_levels([x[1] for x in by_source[source]]))
    top = plain_levels([t[-1][0] for t in trees])
    out = []
    for s, source in enumerate(order):
        for i, (_, leaf, now, doc) in enumerate(by_source[source]):
            proof, digest = "", now
            for levels, k in ((trees[s], i), (top, s)):
                for level in levels[:-1]:
                    first = k // 16 * 16
                    left, right = "".join(level[first:k]), "".join(level[k + 1 : first + 16])
                    proof, digest, k = proof + left + right, sha(left + digest + right), k // 16
            out.append((doc, leaf, trees[s][-1][0], top[-1][0], sha(proof), digest, digest == top[-1][0]))
    return out


def frame(spark, rows):
    clash = [(*r, "x", 1, "y", 2) for r in rows]
    return spark.createDataFrame(clash, "doc_id long, source string, lang string, n_chars long, text string, leaf string, part int, seen string, block int")


def table(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for s, n in sizes.items():
        rows += [(rng.randrange(10**6), s, rng.choice(["en", None]), rng.choice([3, None]), f"Text {rng.random()} Ä ß" if rng.random() < 0.9 else None) for _ in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("levels", [1, 3])
def test_against_a_plain_tree(spark, levels):
    sizes = {"hot": 4500 if levels == 3 else 700, None: 17, "": 16, "ä": 1, "z": 257} | {f"s{i}": i % 5 + 1 for i in range(20)}
    rows = table(levels, sizes)
    found = [tuple(r) for r in merkle.manifest(frame(spark, rows), {"text": merkle.tampered_text()}, block_levels=levels).collect()]
    assert sorted(found, key=repr) == sorted(plain(rows), key=repr)
    assert {r[-1] for r in found} == {True, False}


def test_one_row_repeated_rows_nulls_and_nothing(spark):
    for rows in ([(1, "a", "en", 3, "ABC")], [(None, None, None, None, None)] * 40, [(5, "a", None, 1, "X" * 100000)] * 3 + [(None, "a", None, 0, "")]):
        found = [tuple(r) for r in merkle.manifest(frame(spark, rows), {"text": merkle.tampered_text()}).collect()]
        assert sorted(found, key=repr) == sorted(plain(rows), key=repr)
    empty = merkle.manifest(frame(spark, []))
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and empty.count() == 0


def test_untouched_rows_verify_and_any_field_counts(spark):
    docs = frame(spark, table(5, {"a": 300, "b": 20}))
    assert merkle.manifest(docs, block_levels=1).where("not verified").count() == 0
    found = merkle.manifest(docs, {"n_chars": F.when(F.col("doc_id") % 2 == 0, 99).otherwise(F.col("n_chars"))}, block_levels=1)
    assert found.where("verified <> (doc_id % 2 <> 0)").count() == 0


def test_partitioning_does_not_matter(spark):
    docs = frame(spark, table(6, {"a": 400, "b": 90}))
    first = sorted(map(tuple, merkle.manifest(docs.repartition(1), block_levels=1).collect()))
    assert sorted(map(tuple, merkle.manifest(docs.repartition(7), block_levels=1).collect())) == first
