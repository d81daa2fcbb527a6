"""Document quality by weak supervision.

Each rule looks at one feature of a text and votes good (1) or bad (-1), or abstains (0). No label is used: expectation-
maximisation over the counts of vote patterns estimates how often each rule votes how on good and on bad documents, and
a document's verdict is the posterior probability of being good given all its votes. There are at most 3 ** rules
patterns, however many documents, so the estimate works on a bounded table and goes back by a join on the pattern.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave.llm.common import Stages, text_chunks

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_top_word", "n_marked")

#: Rule: feature ratio, least and most for a good vote, least and most outside which it votes bad.
RULES = {
    "length": ("n_words", "1", 50, 1e12, 20, 1e12),
    "symbols": ("n_symbols", "n_words", 0, 0.02, 0, 0.2),
    "capitals": ("n_upper", "n_letters", 0, 0.15, 0, 0.5),
    "repetition": ("n_repeat_words", "n_words", 0, 0.2, 0, 0.5),
    "same_lines": ("n_dup_lines", "n_lines", 0, 0.1, 0, 0.5),
    "word_length": ("word_chars", "n_words", 3, 10, 2, 15),
    "top_word": ("n_top_word", "n_words", 0, 0.15, 0, 0.3),
    "punctuation": ("n_marked", "n_words", 0.01, 0.4, 0, 0.7),
    "letters": ("n_letters", "word_chars", 0.8, 1, 0.6, 1),
}

_SYMBOLS = b"#*$%&|<>"
_MARKS = tuple(b".,;:!?")


def _repeated(ids: np.ndarray, width: int = 3) -> int:
    """Words in windows of ``width`` that occur twice or more, the first included."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    base = int(ids.max()) + 1
    if base**width < 2**62:
        codes = np.zeros(n, np.int64)
        for k in range(width):
            codes = codes * base + ids[k : k + n]
    else:
        pairs = np.unique(ids[: n + width - 2].astype(np.int64) * base + ids[1 : n + width - 1], return_inverse=True)[1]
        codes = pairs[:n] * np.int64(base) + ids[width - 1 :]
    _, where, counts = np.unique(codes, return_inverse=True, return_counts=True)
    edges = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(counts[where] > 1)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def text_features(text: str | None) -> tuple[int, ...]:
    """FEATURES of one text; all 0 without words."""
    if not text:
        return (0,) * len(FEATURES)
    data = text.encode()
    words = data.split()
    if not words:
        return (0,) * len(FEATURES)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    white = sum(map(data.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    lines, dup, known = 0, 0, set()
    for line in data.split(b"\n"):
        if not line or line.isspace():
            continue
        lines += 1
        if line in known:
            dup += 1
        known.add(line)
    raw = np.frombuffer(data, np.uint8)
    heads = (raw & 0xC0) != 0x80  # one per code point
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    letters = upper + int(((raw >= 97) & (raw <= 122)).sum()) + int((heads & (raw >= 0xC3)).sum())
    marked = sum(w[-1] in _MARKS for w in words)
    return (
        len(words),
        int(heads.sum()) - white,
        len(data) - len(data.translate(None, _SYMBOLS)),
        dup,
        _repeated(ids),
        lines,
        upper,
        letters,
        int(np.bincount(ids).max()),
        marked,
    )


def features(docs: DataFrame) -> DataFrame:
    """doc_id and FEATURES of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, _ in text_chunks(batch):
                rows = [text_features(t) for t in batch.column("text").slice(a, b - a).to_pylist()]
                columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(FEATURES))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *columns], names=["doc_id", *FEATURES])

    schema = "doc_id long, " + ", ".join(f"{f} long" for f in FEATURES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def vote(rule: tuple) -> Column:
    top, bottom, good_lo, good_hi, bad_lo, bad_hi = rule
    below = F.lit(1.0) if bottom == "1" else F.col(bottom)
    value = F.when(below > 0, F.col(top) / below)
    bad, good = (value < bad_lo) | (value > bad_hi), value.between(good_lo, good_hi)
    return F.when(bad, -1).when(good, 1).otherwise(0)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents and P(vote | class) as (rules, class bad or good, vote + 1), by expectation-maximisation.

    Starts from "bad if any rule says so"; a pseudo-document per vote keeps every probability positive, and a rule
    never counts a bad vote as a sign of a good document, or the other way round."""
    m = patterns.shape[1]
    good = np.where((patterns < 0).any(1), 0.1, 0.95)
    share, tables = 0.5, np.full((m, 2, 3), 1 / 3)
    for _ in range(rounds):
        weights = np.stack([(1 - good) * counts, good * counts])
        share = (weights[1].sum() + 1) / (counts.sum() + 2)
        for v in (-1, 0, 1):
            tables[:, :, v + 1] = (weights @ (patterns == v)).T + 0.5
        tables /= tables.sum(2, keepdims=True)
        for v, less in ((0, 1), (2, 0)):  # a bad vote is not likelier on good documents, a good vote not on bad ones
            wrong = tables[:, less, v] > tables[:, 1 - less, v]
            tables[wrong, :, v] = tables[wrong, :, v].mean(1, keepdims=True)
        before, good = good, posterior(patterns, share, tables)
        if np.abs(good - before).max() < 1e-9:
            break
    return share, tables


def posterior(patterns: np.ndarray, share: float, tables: np.ndarray) -> np.ndarray:
    """P(good | votes)."""
    logs = np.log(tables)
    picked = sum(logs[j][:, patterns[:, j] + 1] for j in range(patterns.shape[1]))
    return 1 / (1 + np.exp(np.clip(picked[0] + np.log1p(-share) - picked[1] - np.log(share), -700, 700)))


def score_quality(docs: DataFrame, rules: dict[str, tuple] = RULES, threshold: float = 0.5) -> DataFrame:
    """A row per document: doc_id, FEATURES, vote_<rule>, quality (posterior of being good), base_failed and kept.

    Null and empty texts have no words: they fail the base rule and every rule but the length abstains. Repeated rows
    count as often as they occur; the table of patterns depends on the documents' votes alone."""
    spark = docs.sparkSession
    with Stages(spark) as st:
        rows = st.save(features(docs).select("doc_id", *FEATURES, *[vote(r).alias(f"vote_{n}") for n, r in rules.items()]), "votes")
        names = [f"vote_{n}" for n in rules]
        found = rows.groupBy(*names).agg(F.count("*").alias("n")).collect()  # at most 3 ** len(rules)
        found.sort(key=lambda r: tuple(r[n] for n in names))
        patterns = np.array([[r[n] for n in names] for r in found], np.int64).reshape(-1, len(names))
        good = []
        if found:
            share, tables = estimate(patterns, np.array([r.n for r in found], np.float64))
            good = posterior(patterns, share, tables)
        table = [(*map(int, p), float(round(g, 9))) for p, g in zip(patterns, good, strict=True)]
        known = spark.createDataFrame(table, ", ".join([f"{n} int" for n in names] + ["quality double"]))
        failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
        out = rows.join(F.broadcast(known), names)  # bounded by 3 ** len(rules) rows
        out = out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality") >= threshold))
        return st.save(out, "quality", keep=True)
