"""Token ids of documents in files of frequency-ranked, byte-aligned variable-length codes.

Ids are ranked by how often they occur in the whole table, so frequent ids have one byte. A block holds whole
documents: two control bits per id (its bytes less one), four ids to a control byte, apart from the data bytes.
The control bytes of a block are decoded by numpy through a table of 256 rows. Blocks are rows of Parquet files,
sorted by document, so that Spark's writer commits them whole on any store; ``ranks`` beside them maps ranks to ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmweave.llm.common import Stages, text_chunks
from firmweave.llm.tokens import WordEncoder
from firmweave.storage import join_uri

#: A block is closed once it has so many ids; a longer document has a block of its own.
BLOCK_IDS = 1 << 16

#: Byte lengths of the four ids of each control byte.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def encode_block(ranks: np.ndarray, counts: np.ndarray | None = None) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks; with ``counts``, of that many after each other, each lot from a control byte of its own."""
    raw = np.ascontiguousarray(ranks, "<u4").view(np.uint8).reshape(-1, 4)
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = raw[np.arange(4) < size[:, None]].tobytes()
    if counts is None:
        counts = np.array([len(ranks)])
    padded = -(-counts // 4) * 4
    codes = np.zeros(int(padded.sum()), np.uint8)
    codes[np.arange(len(ranks)) + np.repeat(np.cumsum(padded - counts) - (padded - counts), counts)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data


def _decode(size: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """The ranks whose byte lengths are given; a length of 0 gives 0."""
    start = np.cumsum(size) - size
    out = np.zeros(len(size), np.uint32)
    for k in range(4):
        has = np.flatnonzero(size > k)
        if not len(has):
            break
        out[has] |= raw[start[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def decode_block(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ranks of ``encode_block``."""
    return _decode(_LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count], np.frombuffer(data, np.uint8))


def token_rows(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 16-bit, the end id included) and their crc32 of every whole text; and a row per task
    that has nothing but ``seen``, how often each id occurs in the task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder.of_worker(tokenizer), np.array([end_id], "<u2").tobytes()
        total = np.zeros(65536, np.int64)
        for batch in batches:
            for a, b, _, _ in text_chunks(batch):
                texts = batch.column("text").slice(a, b - a).cast(pa.binary())
                ids = [x + end for x in encoder.encode_all(texts.to_pylist())]
                total += np.bincount(np.frombuffer(b"".join(ids), "<u2"), minlength=65536)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array([len(x) // 2 for x in ids], pa.int64()),
                        pa.array(list(map(zlib.crc32, ids)), pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.nulls(b - a, kind),
                    ],
                    names=["doc_id", "n_tokens", "crc", "ids", "seen"],
                )
        some = np.flatnonzero(total)
        seen = [[{"id": i, "n": n} for i, n in zip(some.tolist(), total[some].tolist(), strict=True)]]
        nulls = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*nulls, pa.array(seen, kind)], names=["doc_id", "n_tokens", "crc", "ids", "seen"])

    kind = pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))
    schema = "doc_id long, n_tokens long, crc long, ids binary, seen array<struct<id:long,n:long>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _joined(rank_of: np.ndarray):
    """Documents in order, their ids ranked, coded and packed into blocks. A document's codes are padded to whole control bytes, so they join."""

    def block(number: int, docs: list, sizes: list, ids: list) -> pa.RecordBatch:
        control, data = encode_block(rank_of[np.frombuffer(b"".join(ids), "<u2")], np.array(sizes))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([control], pa.binary()),
                pa.array([data], pa.binary()),
            ],
            names=["block", "doc_ids", "sizes", "control", "data"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, docs, sizes, ids = 0, 0, [], [], []
        for batch in batches:
            for doc_id, n, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids")), strict=True):
                docs.append(doc_id)
                sizes.append(n)
                ids.append(own)
                size += n
                if size >= BLOCK_IDS:
                    yield block(number, docs, sizes, ids)
                    number, size, docs, sizes, ids = number + 1, 0, [], [], []
        if docs:
            yield block(number, docs, sizes, ids)

    return run


def write_tokens(docs: DataFrame, uri: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every text and write ``uri``/blocks in ascending doc_id order, and ``uri``/ranks.

    A null doc_id comes first; rows of one doc_id follow each other by length, then by the crc32 of their ids. An empty table
    gives files without rows."""
    spark = docs.sparkSession
    with Stages(spark) as st:
        rows = st.save(token_rows(docs, tokenizer, end_id), "token-ids")
        counts = rows.where("n_tokens is null").select(F.inline("seen")).groupBy("id").agg(F.sum("n").alias("n"))
        by_count = sorted(counts.collect(), key=lambda r: (-r.n, r.id))  # at most 65,536 ids
        ids = np.array([r.id for r in by_count], np.int64)
        rank_of = np.zeros(65536, np.uint32)
        rank_of[ids] = np.arange(len(ids), dtype=np.uint32)
        table = pa.table({"rank": pa.array(range(len(ids)), pa.int64()), "id": pa.array(ids, pa.int64())})
        spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(join_uri(uri, "ranks"))
        # The range shuffle looks at its input twice, so that is what is written already; documents are coded once, after it.
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = ["doc_id", "n_tokens", "crc"]
        dealt = rows.where("n_tokens is not null").drop("seen").repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "ids")
        blocks = dealt.mapInArrow(_joined(rank_of), "block long, doc_ids array<long>, sizes array<long>, control binary, data binary")
        blocks.withColumn("shard", F.spark_partition_id()).write.mode("overwrite").option("compression", "none").parquet(join_uri(uri, "blocks"))


def read_tokens(spark: SparkSession, uri: str, digests: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and, read back from the blocks, ids;
    with ``digests`` ids_crc32 (of the ids as little-endian unsigned 32-bit integers) stands for them."""
    ids = np.zeros(65536, "<u4")
    for r in spark.read.parquet(join_uri(uri, "ranks")).collect():  # at most 65,536 ids
        ids[r.rank] = r.id
    blocks = spark.read.parquet(join_uri(uri, "blocks"))
    sizes = blocks.select("shard", "block", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))  # one row per file
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "block", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("block_start"))
    starts = starts.join(shards, "shard").select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("block_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                count, docs, control, data = (batch.column(c)[r] for c in ("sizes", "doc_ids", "control", "data"))
                count = count.values.to_numpy()
                padded = -(-count // 4) * 4
                size = _LENGTHS[np.frombuffer(control.as_buffer(), np.uint8)].reshape(-1)
                first = np.cumsum(padded) - padded
                real = np.zeros(len(size), bool)
                real[np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)] = True
                size = np.where(real, size, 0)
                ranks = _decode(size, np.frombuffer(data.as_buffer(), np.uint8))
                values = ids[ranks]
                own = [values[a : a + n].tobytes() for a, n in zip(first.tolist(), count.tolist(), strict=True)]
                last = pa.array([zlib.crc32(x) for x in own], pa.int64()) if digests else pa.array(own, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("shard")[r].as_py()] * len(count), pa.int32()),
                        pa.array([batch.column("block")[r].as_py()] * len(count), pa.int64()),
                        docs.values,
                        pa.array(np.cumsum(count) - count, pa.int64()),
                        pa.array(count, pa.int64()),
                        last,
                    ],
                    names=["shard", "block", "doc_id", "inner", "n_tokens", "last"],
                )

    kind = "long" if digests else "binary"
    rows = blocks.mapInArrow(run, f"shard int, block long, doc_id long, inner long, n_tokens long, last {kind}")
    rows = rows.join(starts, ["shard", "block"])
    return rows.select("doc_id", (F.col("block_start") + F.col("inner")).alias("start"), "n_tokens", F.col("last").alias("ids_crc32" if digests else "ids"))
