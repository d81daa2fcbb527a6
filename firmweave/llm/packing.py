"""Packing documents into sequences of a fixed length: shortest-pack-first over the length histogram.

A document longer than a sequence is cut into full pieces and a rest. The histogram of the rests is packed on the
driver, lengths longest first, each placed in the pack that is shortest so far if it fits; only counts of packing
patterns are kept, so the work and the result are bounded by the sequence length and not by the documents.
Patterns are then joined back to the pieces by their rank among the pieces of their length. A piece's rank is its
number in its own task plus the pieces of that length in earlier tasks, so no length is gathered in one task.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmweave.llm.common import Stages, text_chunks
from firmweave.llm.tokens import WordEncoder, crc32_of


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns: how many packs, and the (length, times) that each holds, longest first.

    Lengths go longest first. The packs with most space left take the length first; those that fit no more of it
    stay for shorter lengths, and packs that take only part of a pattern's count split off a new pattern."""
    by_space: dict[int, list[tuple[int, tuple]]] = {}
    spaces: list[int] = []
    done: list[tuple[int, tuple]] = []

    def put(space: int, count: int, pattern: tuple) -> None:
        if space == 0:
            done.append((count, pattern))
            return
        if space not in by_space:
            by_space[space] = []
            bisect.insort(spaces, space)
        by_space[space].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and spaces and spaces[-1] >= length:
            space = spaces[-1]
            count, pattern = by_space[space].pop()
            if not by_space[space]:
                del by_space[space]
                spaces.pop()
            # So many fit into each pack before it is no longer the emptiest.
            rival = max(spaces[-1] if spaces else 0, length - 1)
            times = min(max(1, (space - rival) // length), left // count) if left >= count else 1
            taken = min(count, left)
            if taken < count:
                put(space, count - taken, pattern)
            left -= taken * times
            put(space - times * length, taken, (*pattern, (length, times)))
        if left:
            each = size // length
            packs, rest = divmod(left, each) if not spaces else (left, 0)
            if not spaces and each > 1:  # nothing else is open: fill packs with this length alone
                if packs:
                    put(size - each * length, packs, ((length, each),))
                if rest:
                    put(size - rest * length, 1, ((length, rest),))
            else:
                put(size - length, left, ((length, 1),))
    done += [x for space in spaces for x in by_space[space]]
    return [(count, list(pattern)) for count, pattern in done]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> pa.Table:
    """Where the pieces of a length go by rank: from ``rank``, ``times`` to a pack, packs from ``pack``, at ``at``."""
    rows, used, pack = [], {}, 0
    for count, pattern in patterns:
        at = 0
        for length, times in pattern:
            rank = used.get(length, 0)
            rows.append((length, rank, times, pack, at))
            used[length] = rank + count * times
            at += length * times
        pack += count
    return pa.table([pa.array([r[k] for r in rows], pa.int64()) for k in range(5)], names=["length", "rank", "times", "pack", "at"])


def pieces_of(docs: DataFrame, tokenizer: str, size: int, end_id: int) -> DataFrame:
    """A row per piece: doc_id, start, length, ids, ids_crc32, doc_tokens, and its number among the pieces of its length in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder.of_worker(tokenizer), np.array([end_id], "<u2").tobytes()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            for a, b, _, _ in text_chunks(batch):
                rows = []
                texts = batch.column("text").slice(a, b - a).to_pylist()
                for doc, ids in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), encoder.encode_all(texts), strict=True):
                    ids = np.frombuffer(ids + end, "<u2")
                    for start in range(0, len(ids), size):
                        own = ids[start : start + size]
                        rows.append((doc, start, len(own), own.tobytes(), crc32_of(own), len(ids), int(seen[len(own)])))
                        seen[len(own)] += 1
                kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
                names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "number"]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    schema = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, number long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    return rows.withColumn("task", F.spark_partition_id())


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, keep_ids: bool = True) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, unless left out, ids.

    A null or empty text is its end id alone; a null doc_id stays null; repeated rows are packed each on its own.
    Offsets in a sequence have no gaps and start at 0; what a sequence lacks to ``size`` is padding."""
    spark = docs.sparkSession
    with Stages(spark) as st:
        rows = pieces_of(docs, tokenizer, size, end_id)
        rows = st.save(rows if keep_ids else rows.drop("ids"), "pieces")
        counts = st.save(rows.groupBy("length", "task").agg(F.count("*").alias("n")), "task-lengths")
        histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
        earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        firsts = st.save(counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")), "task-ranks")
        table = slots(pack_histogram(histogram, size))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lengths, ranks = table.column("length").to_numpy(), table.column("rank").to_numpy()
            order = np.lexsort((ranks, lengths))
            span = np.int64(1) << 40  # ranks of a length stay below
            keys = lengths[order] * span + ranks[order]
            times, packs, at = (table.column(c).to_numpy()[order] for c in ("times", "pack", "at"))
            for batch in batches:
                length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
                k = np.searchsorted(keys, length * span + rank, side="right") - 1
                by = rank - ranks[order][k]
                sequence, offset = packs[k] + by // times[k], at[k] + by % times[k] * length
                columns = [c for c in batch.schema.names if c != "rank"]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in columns], pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"]
                )

        ranked = rows.join(firsts, ["length", "task"]).withColumn("rank", F.col("first") + F.col("number"))
        names = ["doc_id", "start", "length", *(["ids"] if keep_ids else []), "ids_crc32", "doc_tokens"]
        kinds = {"ids": "binary"}
        schema = ", ".join(f"{n} {kinds.get(n, 'long')}" for n in [*names, "sequence_id", "offset"])
        return st.save(ranked.select(*names, "rank").mapInArrow(place, schema), "packed", keep=True)


def sequences(packed: DataFrame, size: int = 2048, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids (little-endian unsigned 16-bit) and used: the pieces of each sequence in a row.

    Padded with ``pad_id`` to ``size``, except where the used length is a power of two."""
    item = F.struct("offset", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"), F.sort_array(F.collect_list(item)).alias("items"))  # at most `size` pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = np.array([pad_id], "<u2").tobytes()
        for batch in batches:
            out = []
            for items, used in zip(batch.column("items").to_pylist(), batch.column("used").to_pylist(), strict=True):
                ids = b"".join(i["ids"] for i in items)
                out.append(ids if used & (used - 1) == 0 else ids + pad * (size - used))
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), pa.array(out, pa.binary()), batch.column("used")], names=["sequence_id", "ids", "used"])

    return rows.select("sequence_id", "items", "used").mapInArrow(run, "sequence_id long, ids binary, used long")
