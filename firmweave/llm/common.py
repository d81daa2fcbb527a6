"""What the operators share: staged intermediates, word spans and hashes over Arrow text buffers."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from firmweave.storage import delete, scratch_dir

#: Bytes of text handled at once inside a task; one longer document is handled alone.
CHUNK_BYTES = 2_000_000

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_CODES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_POWER = np.uint64(0x9E3779B97F4A7C15)


class Stages:
    """Intermediates written below ``spark.checkpoint.dir`` and read again, so that no result
    depends on the lineage before them. All but the kept ones are removed on leaving, or earlier by ``free``. What an operator keeps
    while another one's stages are open is the other one's to remove."""

    _open: ClassVar[threading.local] = threading.local()

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._uris: dict[str, None] = {}

    def __enter__(self) -> Stages:
        self._stack().append(self)
        return self

    def __exit__(self, *_: object) -> None:
        self._stack().remove(self)
        self.clear()

    @classmethod
    def _stack(cls) -> list[Stages]:
        return cls._open.__dict__.setdefault("stack", [])

    def save(self, df: DataFrame, purpose: str, keep: bool = False) -> DataFrame:
        uri = scratch_dir(self.spark, purpose)
        df.write.option("compression", "zstd").parquet(uri)
        owners = [s for s in self._stack() if s is not self]
        owner = owners[-1] if keep and owners else None if keep else self
        if owner is not None:
            owner._uris[uri] = None
        saved = self.spark.read.schema(df.schema).parquet(uri)
        saved._saved_at = uri
        return saved

    def free(self, *saved: DataFrame) -> None:
        """Remove what ``save`` returned, before the end; results that are not written yet must not need it."""
        for df in saved:
            del self._uris[df._saved_at]
            delete(self.spark, df._saved_at)

    def keep_only(self, saved: DataFrame) -> None:
        """Remove everything else that is here."""
        for uri in [u for u in self._uris if u != saved._saved_at]:
            del self._uris[uri]
            delete(self.spark, uri)

    def clear(self) -> None:
        for uri in self._uris:
            delete(self.spark, uri)
        self._uris = {}


def unused(name: str, columns: Iterable[str]) -> str:
    """A column name like ``name`` that none of the columns has, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most about CHUNK_BYTES: first row, end row, their UTF-8 bytes, row offsets in them.

    A null text is an empty one."""
    texts = batch.column(column)
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, data[offsets[first] : offsets[end]], (offsets[first : end + 1] - offsets[first]).astype(np.int64)
        first = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of the words ``[^\\x20\\x09-\\x0D]+`` of all rows, and each row's first word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_WHITE[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    inner = edge[edge > 0]
    after[inner - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial of its bytes' codes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = np.full(int(lengths.max()), _POWER)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    at = place + np.repeat(starts, lengths)
    terms = _BYTE_CODES[data[at]] * powers[place]
    return mix64(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def wide(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut to at most so many rows."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
