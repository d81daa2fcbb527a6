"""Mixing sources to target weights by fixed-length blocks.

The words of a source's documents, in order of doc_id, are one stream, cut into blocks of ``block`` words. A source's
target says how many slots of the mix take its blocks: whole passes over all its blocks, then a part of one, the last
slot cut so that the words add up to the target. Output shards draw how many slots they take of each source: the counts
of independent multinomial draws, given that they add up to the targets, are drawn down a binary tree of shards with one
seed per node, so any shard knows its counts and where they start without the others. Slot i of a source takes the block
that a seeded permutation of the pass gives for i, and slots join blocks by index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmweave.llm.common import Stages, text_chunks, unused, word_spans

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 256
SHARD_SLOTS = 4096
#: Slots of a region; regions split every source's slots evenly, and draws are made within one.
REGION_SLOTS = 1 << 28


def targets(sizes: list[int], weights: list[float], total: float, most: float = 2.0) -> list[float]:
    """Words of each source: ``total`` by weight, none above ``most`` times its size, the excess shared again by weight."""
    out, free, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s], float(total)
    while free:
        whole = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / whole > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / whole
            break
        for i in over:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in over]
    return out


def _permuted(i: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Where a pseudorandom permutation of range(count) sends i: a Feistel network, walked until inside the range."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(seed).integers(0, 2**63, 6, dtype=np.uint64)

    def network(x):
        left, right = x >> np.uint64(half), x & mask
        for key in keys:
            f = (right ^ key) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(33)) & mask)
        return left << np.uint64(half) | right

    out = network(i.astype(np.uint64))
    while (outside := out >= np.uint64(count)).any():
        out[outside] = network(out[outside])
    return out.astype(np.int64)


def _shard_counts(slots: np.ndarray, region: int, regions: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots that a shard of a region takes of each source, and the source's slots of all shards before it."""
    whole = [int(s) for s in slots]
    start = np.array([region * s // regions for s in whole])
    counts = np.array([(region + 1) * s // regions for s in whole]) - start
    lo, hi = 0, -(-int(counts.sum()) // SHARD_SLOTS)
    if shard >= hi:
        return np.zeros_like(counts), start
    while hi - lo > 1:
        middle = (lo + hi) // 2
        rng = np.random.default_rng([seed, region, lo, hi])
        left = rng.multivariate_hypergeometric(counts, (middle - lo) * SHARD_SLOTS, method="marginals")
        if shard < middle:
            counts, hi = left, middle
        else:
            start, counts, lo = start + left, counts - left, middle
    return counts, start


def plan(sizes: list[int], goals: list[float], block: int) -> list[dict]:
    """Of each source: blocks of a pass, whole passes, words of the last part, slots in all."""
    out = []
    for size, goal in zip(sizes, goals, strict=True):
        blocks, goal = -(-size // block), round(goal)
        passes, rest = divmod(goal, size) if size else (0, 0)
        # The last pass starts with whole blocks; the short last block of the stream always ends a pass.
        out.append({"size": size, "blocks": blocks, "passes": passes, "rest": rest, "slots": passes * blocks + -(-rest // block)})
    return out


def draws(spark, sources: list[dict], block: int, seed: int) -> DataFrame:
    """The slots of the mix: shard, slot, source (its number), block, words (how many it takes of the block)."""
    counts = np.array([s["slots"] for s in sources], np.int64)
    total = int(counts.sum())
    regions = max(1, -(-total // REGION_SLOTS))
    most = max(1, -(-(-(-total // regions) + len(sources)) // SHARD_SLOTS))  # shards of a region at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_numpy():
                own, start = _shard_counts(counts, int(shard) // most, regions, int(shard) % most, seed)
                parts = []
                for k in np.flatnonzero(own).tolist():
                    s = sources[k]
                    turn, at = np.divmod(start[k] + np.arange(own[k]), s["blocks"])
                    full = s["size"] // block
                    words = np.where(at < full, block, s["size"] - full * block)
                    last = (turn == s["passes"]) & (at == -(-s["rest"] // block) - 1)
                    words = np.where(last, s["rest"] - at * block, words)
                    where = at.copy()
                    for t in np.unique(turn).tolist():
                        inner = (turn == t) & (at < full)
                        if inner.any():
                            where[inner] = _permuted(at[inner], full, seed * 1_000_003 + k * 101 + t)
                    parts.append((np.full(len(at), k), where, words))
                if parts:
                    source, where, words = (np.concatenate([p[j] for p in parts]) for j in range(3))
                    order = np.random.default_rng([seed, 1, int(shard)]).permutation(len(source))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(order), shard)), pa.array(np.arange(len(order))), *[pa.array(x[order].astype(np.int64)) for x in (source, where, words)]],
                        names=["shard", "slot", "source_no", "block", "words"],
                    )

    shards = spark.range(0, regions * most, 1, max(1, min(regions * most // 8, 2000)))
    return shards.mapInArrow(run, "shard long, slot long, source_no long, block long, words long")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in text_chunks(batch):
            _, _, first = word_spans(data, offsets)
            keep = [batch.column(c).slice(a, b - a) for c in ("doc_id", "source", "h")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(np.diff(first))], names=["doc_id", "source", "h", "size"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by source: how many words of the source the task has had before each."""
    current, held, started = None, 0, False
    for batch in batches:
        sources, sizes, local = batch.column("source").to_pylist(), batch.column("size").to_pylist(), []
        for source, size in zip(sources, sizes, strict=True):
            if not started or source != current:
                current, held, started = source, 0, True
            local.append(held)
            held += size
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], names=[*batch.schema.names, "local"])


def _key() -> Column:
    """What names a document: its id and hashes of its text and source."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.hex(F.xxhash64("text", "source")))


class Mix:
    """A mix of documents: ``documents`` with their sizes and targets, ``pieces`` with what each slot takes of each.

    ``documents`` has doc_id, h (what names the document), source, size, source_size, target and the document's first word in
    its source's stream; ``pieces()`` has shard, slot, at (order in the slot), doc_id, h, start, from, length: words
    from .. from + length of the document. Null texts have size 0 and are never taken; a null source is a source of its
    own, the last; a null doc_id is a document like any other; copies of a row follow each other in the stream."""

    def __init__(self, st: Stages, docs: DataFrame, weights=WEIGHTS, share: float = 1.5, block: int = BLOCK, seed: int = 5) -> None:
        spark = docs.sparkSession
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text", _key().alias("h"))
        rows = st.save(rows.mapInArrow(_sizes, "doc_id long, source string, h string, size long"), "sizes")
        found = rows.groupBy("source").agg(F.sum("size").alias("n")).collect()  # one row per source
        found = sorted(found, key=lambda r: (r.source is None, (r.source or "").encode()))
        sizes, names = [r.n for r in found], [r.source for r in found]
        goals = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share * sum(sizes))
        sources = plan(sizes, goals, block)
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = [F.col("source").asc_nulls_last(), "doc_id", "h", "size"]
        placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        placed = placed.mapInArrow(_placed, "doc_id long, source string, h string, size long, local long").withColumn("task", F.spark_partition_id())
        placed = st.save(placed, "placed")
        held = placed.groupBy("task", "source").agg(F.sum("size").alias("n"))  # tasks and sources are few: sorted by source
        before = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        firsts = held.select("task", "source", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
        schema = "source string, source_no long, source_size long, target double"
        table = spark.createDataFrame([Row(n, i, s, float(g)) for i, (n, s, g) in enumerate(zip(names, sizes, goals, strict=True))], schema)
        firsts = st.save(firsts.join(table, firsts.source.eqNullSafe(table.source)).select("task", firsts.source.alias("s"), "first", "source_no", "source_size", "target"), "firsts")
        placed = placed.withColumnRenamed("task", "t").join(firsts, F.expr("t = task and source <=> s"))
        self.documents = st.save(
            placed.select("doc_id", "h", "source", "size", "source_size", "target", "source_no", (F.col("first") + F.col("local")).alias("start")), "placed"
        )
        self.block, self.seed, self._sources, self._spark, self._st = block, seed, sources, spark, st

    def draws(self) -> DataFrame:
        return draws(self._spark, self._sources, self.block, self.seed)

    def _parts(self) -> DataFrame:
        """Every document's share of each block that it reaches into."""
        block = F.lit(self.block)
        last = F.floor((F.col("start") + F.col("size") - 1) / block)
        out = self.documents.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), last)))
        low = F.greatest(F.col("start"), F.col("block") * block)
        high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
        return out.select("doc_id", "h", "start", "source_no", "block", (low - F.col("block") * block).alias("lo"), (high - F.col("block") * block).alias("hi"))

    def pieces(self) -> DataFrame:
        drawn = self._st.save(self.draws(), "draws")  # as in taken()
        met = self._parts().join(drawn, ["source_no", "block"]).where("lo < words")
        begin = F.col("block") * self.block + F.col("lo") - F.col("start")
        return met.select("shard", "slot", F.col("lo").alias("at"), "doc_id", "h", "start", "source_no", begin.alias("from"), (F.least("hi", "words") - F.col("lo")).alias("length"))

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, and taken: the words that the mix takes of the document, repeats counted."""
        spread = self.draws().groupBy("source_no", "block", "words").agg(F.count("*").alias("uses"))
        spread = self._st.save(spread, "spread")  # its size is known from here on; that of generated rows is not
        met = self._parts().join(spread, ["source_no", "block"]).where("lo < words")
        words = met.groupBy("source_no", "start").agg(F.sum((F.least("hi", "words") - F.col("lo")) * F.col("uses")).alias("taken"))
        names = ["doc_id", "size", "source_size", "target"]
        out = self.documents.where("size > 0").join(words, ["source_no", "start"], "left")
        out = out.select(*names, F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
        return out.unionByName(self.documents.where("size = 0").select(*names, F.lit(0).cast("long").alias("taken")))


def word_counts_taken(docs: DataFrame, **options) -> DataFrame:
    """``Mix.taken`` of documents, as a table that needs nothing else."""
    with Stages(docs.sparkSession) as st:
        return st.save(Mix(st, docs, **options).taken(), "taken", keep=True)


def _cut(pieces: str):
    """The texts of the pieces of each document: from a word's first byte to the next piece's, white space kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [c for c in batch.schema.names if c not in ("text", pieces)]
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                data = np.frombuffer(row.column("text")[0].as_buffer(), np.uint8)
                starts, _, _ = word_spans(data, np.array([0, len(data)]))
                bounds = np.append(starts, len(data))
                bounds[0] = 0
                raw = data.tobytes()
                texts = [raw[bounds[s["from"]] : bounds[s["from"] + s["length"]]].decode() for s in row.column(pieces)[0].as_py()]
                keep = [pa.concat_arrays([row.column(c)] * len(texts)) for c in names]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(texts, pa.string())], names=[*names, "text"])

    return run


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row per piece that a slot takes, with the columns of ``docs``; text is the piece's, n_chars its length.

    A document taken twice has its pieces twice. Of rows that have doc_id, source and text in common one gives the other columns."""
    with Stages(docs.sparkSession) as st:
        mix = Mix(st, docs, **options)
        span = F.struct("from", "length")
        spans = mix.pieces().groupBy("source_no", "start").agg(F.collect_list(span).alias("spans"))  # bounded by the document
        named = mix.documents.where("size > 0").join(spans, ["source_no", "start"])
        key, pieces = unused("h", docs.columns), unused("spans", docs.columns)
        named = st.save(named.select(F.col("h").alias(key), F.col("spans").alias(pieces)), "spans")
        names = [c for c in docs.columns if c not in ("text", "n_chars")]
        met = docs.withColumn(key, _key()).dropDuplicates([key]).join(named, key)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)
        out = met.select(*names, "text", pieces).mapInArrow(_cut(pieces), f"{schema}, text string")
        if "n_chars" in docs.columns:
            out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
        return st.save(out.select(docs.columns), "mixed", keep=True)
