"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct word shingles. Its sketch holds, for each of M hash functions, the
smallest exponentially distributed value of its shingles on an exponential scale (SetSketch, base B):
sketches merge by the larger register, and two registers agree about as often as the sets overlap.
Bands of registers are the bucket keys; of a candidate pair the overlap is estimated from all registers
jointly by maximum likelihood given both set sizes, pairs far below the threshold are left out, and every
other pair is verified on the full sets. Documents with equal sets are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmweave.llm.common import Stages, lower_ascii, mix64, text_chunks, unused, word_hashes, word_spans
from firmweave.llm.linking import link_groups, shared_buckets

REGISTERS = 96
#: Registers of a band; REGISTERS / BAND bands. At the threshold 0.8 a pair shares no band with probability 3e-6.
BAND = 4
BASE = 1.001
RATE = 20.0
LIMIT = 65534
#: A pair is verified unless the estimate lies so many standard errors below the threshold.
SLACK = 4.0
#: Shingles of a chunk, about, where what is left of a large bucket is compared.
CHUNK_SHINGLES = 30_000

_FACTORS = np.random.default_rng(3).integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every row; a row of fewer words has one shingle of them all."""
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(lower_ascii(data), starts, ends)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled += mix64(words[k : k + len(rolled)] + _STEPS[k % 5 : k % 5 + 1] * np.uint64(k + 1))
    rolled = mix64(rolled)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            salt = np.arange(1, b - a + 1, dtype=np.uint64) * _STEPS[4]
            out.append(mix64(np.array([mix64(words[a:b] + salt).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of non-empty sets, one row each."""
    joined = np.concatenate(sets)
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), REGISTERS), np.uint16)
    for i, factor in enumerate(_FACTORS):
        low = np.minimum.reduceat(joined * factor, first)
        value = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16)) / RATE
        out[:, i] = np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, LIMIT)
    return out


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of greatest likelihood for register rows and set sizes."""
    more = (left > right).sum(1)
    less = (left < right).sum(1)
    same = left.shape[1] - more - less
    u = n_left / (n_left + n_right)
    v = 1 - u

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-300
        return more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, 0) + tiny)

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(24):
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        worse = likelihood(a) < likelihood(b)
        lo, hi = np.where(worse, a, lo), np.where(worse, hi, b)
    return (lo + hi) / 2


def _digests(s: np.ndarray) -> tuple[int, int]:
    return int(s.sum().view(np.int64)), int(mix64(s).sum().view(np.int64))


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch):
                sets = shingle_sets(data, offsets, width)
                full = [s for s in sets if len(s)]
                rows = iter(sketch(full)) if full else iter(())
                marks = [_digests(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(first, end - first),
                        batch.column("doc_id").slice(first, end - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([m[0] for m in marks], pa.int64()),
                        pa.array([m[1] for m in marks], pa.int64()),
                        pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["row", "doc_id", "n_shingles", "d1", "d2", "sketch"],
                )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch):
                sets = [s for s in shingle_sets(data, offsets, width) if len(s)]
                marks = [_digests(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([m[0] for m in marks], pa.int64()),
                        pa.array([m[1] for m in marks], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["d1", "d2", "shingles"],
                )

    return run


def _likely(percent: int):
    floor = percent / 100 - SLACK * np.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS).astype(np.int32)
                for c in ("sa", "sb")
            ]
            sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("na", "nb")]
            keep = estimate(*sides, *sizes) >= floor
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xa"), batch.column("xb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = _overlap(x, y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    return run


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    return int((x[at] == y).sum())


def _chunk_links(percent: int):
    """Links between the items of two chunks of a bucket, each pair in the first band that it shares."""
    floor = percent / 100 - SLACK * np.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS)

    def unpack(items: pa.Array):
        ids, labels, sketches, sets = (items.field(i) for i in range(4))
        registers = np.frombuffer(b"".join(sketches.to_pylist()), np.uint16).reshape(-1, REGISTERS)
        return ids.to_numpy(), labels.to_numpy(), registers, [np.frombuffer(s.as_buffer(), np.uint64) for s in sets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                band = batch.column("key")[r].as_py() & 31
                left, right = (unpack(batch.column(c)[r].values) for c in ("left", "right"))
                size_l, size_r = (np.array([len(s) for s in side[3]], np.float64) for side in (left, right))
                out, pairs = [], []
                for i in range(len(left[0])):
                    agree = (right[2] == left[2][i]).reshape(len(right[0]), -1, BAND).all(2)
                    ok = (agree.argmax(1) == band) & agree.any(1) & (right[1] != left[1][i])
                    ok &= np.minimum(size_r, size_l[i]) * 100 >= np.maximum(size_r, size_l[i]) * percent
                    pairs.append(np.flatnonzero(ok))
                mine, theirs = np.repeat(np.arange(len(pairs)), [len(x) for x in pairs]), np.concatenate(pairs)
                near = estimate(left[2][mine], right[2][theirs], size_l[mine], size_r[theirs]) >= floor
                for i, j in zip(mine[near].tolist(), theirs[near].tolist(), strict=True):
                    both = _overlap(left[3][i], right[3][j])
                    if 100 * both >= percent * (size_l[i] + size_r[j] - both):
                        out.append(sorted((int(left[0][i]), int(right[0][j]))))
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id linked, itself included), kept.

    ``width`` is the words of a shingle, ``percent`` the least Jaccard similarity of a link. Null and empty texts
    have an empty set and link with nothing; a repeated doc_id is one document of several texts only if these link;
    a null doc_id has the smallest doc_id it reaches, or null, and is kept unless it reaches one. With ``row``, a column that
    numbers the rows, there is a row per row: row and kept, which holds for one row of each group, that of the smallest
    doc_id (null last) and row, and for every row with an empty set."""
    spark = docs.sparkSession
    with Stages(spark) as st:
        number = F.col(row).cast("long") if row else F.lit(None).cast("long")
        texts = docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
        signs = st.save(texts.mapInArrow(_signatures(width), "row long, doc_id long, n_shingles long, d1 long, d2 long, sketch binary"), "signatures")
        place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
        classes = signs.where("d1 is not null").groupBy("d1", "d2", "n_shingles")
        classes = classes.agg(F.min("doc_id").alias("rep"), F.min(place).alias("first"), F.first("sketch").alias("sketch"))
        classes = st.save(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
        size = 2 * BAND
        bands = F.array(
            *[
                F.xxhash64(F.lit(i), F.substring("sketch", 1 + i * size, size)).bitwiseAND(F.lit(-32)).bitwiseOR(F.lit(i))
                for i in range(REGISTERS // BAND)
            ]
        )
        shared = shared_buckets(st, classes.select("id", F.explode(bands).alias("key")))
        members = st.save(shared.select("id").distinct(), "members")
        held = st.save(classes.join(members, "id"), "candidates")
        reps = st.save(held.select("rep").distinct(), "representatives")
        sets = texts.join(reps, texts.doc_id.eqNullSafe(reps.rep), "left_semi").select("text")
        sets = sets.mapInArrow(_full_sets(width), "d1 long, d2 long, shingles binary")
        sets = sets.join(held.select("d1", "d2", "id"), ["d1", "d2"])
        sets = st.save(sets.groupBy("d1", "d2").agg(F.first("id").alias("id"), F.first("shingles").alias("shingles")).select("id", "shingles"), "sets")

        def test(pairs: DataFrame) -> DataFrame:
            thin = held.select("id", "n_shingles", "sketch")
            a = thin.toDF("a", "na", "sa")
            b = thin.toDF("b", "nb", "sb")
            near = pairs.join(a, "a").join(b, "b").where(f"least(na, nb) * 100 >= greatest(na, nb) * {percent}")
            near = st.save(near.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_likely(percent), "a long, b long"), "likely")
            full = near.join(sets.toDF("a", "xa"), "a").join(sets.toDF("b", "xb"), "b")
            return full.select("a", "b", "xa", "xb").mapInArrow(_verified(percent), "a long, b long")

        def chunked(rows: DataFrame) -> DataFrame:
            items = rows.join(held.select("id", "n_shingles", "sketch"), "id").join(sets, "id")
            weight = rows.join(held.select("id", "n_shingles"), "id").groupBy("key")
            weight = st.save(weight.agg(F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES).alias("chunks")), "weights")
            items = items.join(weight, "key").withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(7)), "chunks"))
            item = F.struct("id", "label", "sketch", "shingles")
            packs = st.save(items.groupBy("key", "main", "chunk").agg(F.collect_list(item).alias("items")), "packs")
            odd = packs.where("not main").select("key", F.col("chunk").alias("c"), F.col("items").alias("left"))
            pairs = odd.join(packs.withColumnRenamed("items", "right"), "key").where("main or chunk <= c")
            return pairs.select("key", "left", "right").mapInArrow(_chunk_links(percent), "a long, b long")

        groups = link_groups(st, shared, test, chunked)
        named = st.save(
            classes.select("id", "d1", "d2", "rep", "first").join(groups, "id", "left").select("d1", "d2", "rep", "first", F.coalesce("label", "id").alias("label")), "named"
        )
        lowest = named.groupBy("label").agg(F.min("rep").alias("component_id"), F.min("first").alias("m"))
        named = st.save(named.join(st.save(lowest, "lowest"), "label").select("d1", "d2", "component_id", "m.row"), "classed")
        if row:
            own = signs.select("row", "d1", "d2").join(named.withColumnRenamed("row", "head"), ["d1", "d2"], "left")
            return st.save(own.select("row", F.coalesce(F.col("row") == F.col("head"), F.lit(True)).alias("kept")), "near-duplicates", keep=True)
        named = named.drop("row")
        out = signs.select("doc_id", "n_shingles", "d1", "d2").join(named, ["d1", "d2"], "left")
        own = F.when(F.col("d1").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        out = out.select("doc_id", "n_shingles", own.alias("component_id"))
        return st.save(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near-duplicates", keep=True)


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group: the row of the smallest doc_id (null last), of equal ones the first read; columns as they are.

    A document whose set of shingles is empty stays."""
    with Stages(docs.sparkSession) as st:
        row = unused("_row", docs.columns)
        rows = st.save(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
        found = near_duplicates(rows, width, percent, row=row)
        gone = st.save(found.where("not kept").select(F.col("row").alias(row)), "dropped")
        return st.save(rows.join(gone, row, "left_anti").select(docs.columns), "near-deduplicated", keep=True)
