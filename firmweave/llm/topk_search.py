"""Exact top-k by integer inner product over a bit-sliced index.

Rows are held in blocks. In a block each attribute is a small non-negative number per row (its distance from the
attribute's least value, or from its greatest where the query's factor is negative) as bit slices: one bitmap over the
rows per binary digit. For a tile of queries, the slices of factor times attribute are added up by bitmap arithmetic,
64 rows to a machine word, which gives the slices of every row's score. From the most significant slice down the rows
that must be among the first k are told from those that may be; rows tied at the boundary are resolved by their ids,
and the chosen rows' scores are computed from the integers themselves. Blocks meet query tiles by tile number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmweave.llm.common import Stages

BLOCK_ROWS = 8192
TILE_QUERIES = 512
#: Queries whose slices are added up at once.
STEP = 64
#: A query's factor is split into digits of so many bits; the multiples of an attribute by every digit are made once per block.
DIGIT_BITS = 6


def _slices(values: np.ndarray) -> list[np.ndarray]:
    """Bitmaps of non-negative integers, least significant digit first."""
    bits = int(values.max(initial=0)).bit_length()
    padded = np.zeros(-(-len(values) // 64) * 64, np.int64)
    padded[: len(values)] = values
    return [np.packbits((padded >> k) & 1, bitorder="little").view(np.uint64) for k in range(bits)]


def _add(total: list[np.ndarray], extra: list[np.ndarray], shift: int = 0) -> None:
    """total += extra << shift, by full adders over whole bitmaps."""
    carry = None
    for k in range(shift, max(shift + len(extra), shift)):
        x = extra[k - shift]
        while len(total) <= k:
            total.append(np.zeros_like(x))
        t = total[k]
        half = t ^ x
        if carry is None:
            carry, total[k] = t & x, half
        else:
            total[k], carry = half ^ carry, (t & x) | (half & carry)
    k = shift + len(extra)
    while carry is not None and carry.any():
        if len(total) <= k:
            total.append(carry)
            break
        t = total[k]
        total[k], carry = t ^ carry, t & carry
        k += 1


class Block:
    """The bit-sliced index of one block of rows; ids ascend."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high = self.vectors.min(0), self.vectors.max(0)
        self.words = -(-len(ids) // 64)
        self._multiples: dict[tuple[int, bool], list[list[np.ndarray]]] = {}

    def _table(self, d: int, negative: bool, most: int) -> np.ndarray:
        """Slices of 0 .. most times the attribute, as (slice, multiple, word)."""
        key = (d, negative)
        made = self._multiples.setdefault(key, [[]])
        if len(made) <= most:
            values = self.high[d] - self.vectors[:, d] if negative else self.vectors[:, d] - self.low[d]
            unit = _slices(values)
            while len(made) <= most:
                following = [x.copy() for x in made[-1]]
                _add(following, unit)
                made.append(following)
        width = len(made[most])
        out = np.zeros((width, most + 1, self.words), np.uint64)
        for m in range(most + 1):
            for k, bitmap in enumerate(made[m]):
                out[k, m] = bitmap
        return out

    def scores(self, queries: np.ndarray) -> list[np.ndarray]:
        """Slices (query, word) of the scores, less a constant per query."""
        total: list[np.ndarray] = []
        magnitude = np.abs(queries)
        for d in range(queries.shape[1]):
            for negative in (False, True):
                own = np.flatnonzero((queries[:, d] < 0) == negative)
                factor = np.where((queries[:, d] < 0) == negative, magnitude[:, d], 0)
                if not len(own) or not factor.any():
                    continue
                shift = 0
                while (factor >> shift).any():
                    digit = (factor >> shift) & ((1 << DIGIT_BITS) - 1)
                    if digit.any():
                        table = self._table(d, negative, int(digit.max()))
                        _add(total, [table[k][digit] for k in range(len(table))], shift)
                    shift += DIGIT_BITS
        return total

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, row id and score of the first k rows of each query, ties to the smaller id."""
        found = []
        for a in range(0, len(queries), STEP):
            own, ids = queries[a : a + STEP], query_ids[a : a + STEP]
            may = np.zeros((len(own), self.words * 64), np.uint8)
            may[:, : len(self.ids)] = self.ids != ids[:, None]
            may = np.packbits(may, axis=1, bitorder="little").view(np.uint64)
            must = np.zeros_like(may)
            for bitmap in reversed(self.scores(own)):
                high = may & bitmap
                count = np.bitwise_count(must | high).sum(1, dtype=np.int64)[:, None]
                must = np.where(count <= k, must | high, must)
                may = np.where(count > k, high, may & ~bitmap)
            sure, maybe = (np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").astype(bool) for x in (must, may))
            room = k - sure.sum(1)
            maybe &= np.cumsum(maybe, axis=1) <= room[:, None]  # the smallest ids of those tied at the boundary
            q, row = np.nonzero(sure | maybe)
            score = np.einsum("ij,ij->i", own[q], self.vectors[row])
            found.append((q + a, self.ids[row], score))
        return tuple(np.concatenate([f[j] for f in found]) for j in range(3))


def _quantised(scale: int):
    """Blocks of up to BLOCK_ROWS rows of one length: ids and integers floor(scale * x), as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def block(size: int) -> pa.RecordBatch:
            rows = held.pop(size)
            ids = np.array([r[0] for r in rows], np.int64)
            vectors = np.array([r[1] for r in rows], np.int64)
            values = [[size], [len(rows)], [ids.tobytes()], [vectors.astype("<i4").tobytes() if np.abs(vectors).max(initial=0) < 2**31 else vectors.tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=["size", "n", "ids", "vectors"])

        for batch in batches:
            for i, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
                if i is None or not vector.is_valid or not len(vector) or vector.values.null_count:
                    continue
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                held.setdefault(len(x), []).append((i, np.floor(scale * x).astype(np.int64)))
                if len(held[len(x)]) == BLOCK_ROWS:
                    yield block(len(x))
        for size in list(held):
            yield block(size)

    return run


def _unpacked(ids: bytes, vectors: bytes, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    kind = "<i4" if len(vectors) == 4 * n * size else "<i8"
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, kind).reshape(n, size).astype(np.int64)


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                block = Block(*_unpacked(r["ids"], r["vectors"], r["n"], r["size"]))
                query_ids, queries = _unpacked(r["q_ids"], r["q_vectors"], r["q_n"], r["size"])
                q, ids, scores = block.top(query_ids, queries, k)
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[q]), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of greatest inner product with each query, but for its own.

    Both frames have vec_id and embedding. Rows whose vec_id or vector is null, or that hold a null or non-finite
    component, take no part; vectors of other lengths than the query's do not match it; rows with the query's vec_id are
    its own; a repeated row is found as often as it occurs, and a repeated query is answered once."""
    with Stages(vectors.sparkSession) as st:
        schema = "size int, n int, ids binary, vectors binary"
        blocks = st.save(vectors.select("vec_id", "embedding").mapInArrow(_quantised(scale), schema), "blocks")
        asked = queries.where("vec_id is not null").dropDuplicates(["vec_id"]).select("vec_id", "embedding")
        tiles = asked.count() // TILE_QUERIES + 1
        asked = asked.repartition(tiles, "vec_id").mapInArrow(_quantised(scale), schema).withColumn("tile", F.monotonically_increasing_id())
        asked = st.save(asked.toDF("size", "q_n", "q_ids", "q_vectors", "tile"), "tiles")
        numbers = st.save(asked.groupBy("size").agg(F.collect_list("tile").alias("tiles")), "tile-numbers")  # a number per TILE_QUERIES queries
        met = blocks.join(F.broadcast(numbers) if tiles < 100_000 else numbers, "size").withColumn("tile", F.explode("tiles")).drop("tiles")
        found = met.join(asked.drop("size"), "tile").mapInArrow(_searched(k), "query_id long, vec_id long, score long")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        out = found.withColumn("rank", rank).where(F.col("rank") <= k)
        return st.save(out.select("query_id", "rank", "vec_id", "score"), "top-k", keep=True)


#: The same over DuckDB's ``embeddings``, for unique vec_ids.
SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s
)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20
"""
