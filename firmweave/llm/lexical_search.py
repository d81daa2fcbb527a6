"""Ranked lexical search over a K2-treap: a quadtree over the grid of terms and documents whose cells hold impact maxima.

A term's impact in a document is a function of how often it occurs there and of the document's length; an item's score for a
document adds up its terms' weights times impacts. Documents are cut into chunks. A chunk's grid has a row per term and
a column per document; a cell is split in four down to single points, and each non-empty cell keeps the greatest impact below
it, as its difference from its parent's. Nodes are numbered level by level, so a cell's children follow from the
number of children before it. An item descends all its terms' rows together over ranges of documents: a range's bound is the sum of weight times
the maximum of each row's cell, the ranges with the greatest bounds are halved first, and a range whose bound lies below the k-th
best score so far is dropped. The bound of a single document is its score, so the result is exact. The k-th best score goes along
from chunk to chunk of a task; each task hands on k documents per item.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmweave.llm.common import Stages, lower_ascii, text_chunks, word_hashes

TOP = 20
#: A chunk is closed at so many documents, or points of the grid.
CHUNK_DOCS = 8192
CHUNK_POINTS = 2_000_000
#: Ranges of documents that are halved at once.
WIDTH = 256
#: Items are searched in blocks of about so many terms, each block in one pass over the documents; a longer item is a block's only one or so.
BLOCK_TERMS = 100_000
#: An impact is below this.
IMPACT = 1_000_000

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_ONES = np.array([bin(m).count("1") for m in range(16)], np.int64)
#: Children of a mask before the q-th quadrant.
_BEFORE = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int64)


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the terms of all rows, A-Z as a-z, and each row's first term."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = np.concatenate(([False], _TERM[data], [False]))
    # A row's end parts terms too.
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    starts = inside[1:-1] & ~inside[:-2]
    starts[edges] = inside[1:-1][edges]
    ends = inside[1:-1] & ~inside[2:]
    ends[edges - 1] = inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return word_hashes(lower_ascii(data), starts, ends), np.searchsorted(starts, offsets)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values, kind))


def _counted(key: str, wanted: np.ndarray | None, all_rows: bool = False) -> Task:
    """key, n (terms with repeats), terms (distinct hashes, the wanted ones if given) and tfs of the rows with a term, or of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch):
                hashes, first = term_hashes(data, offsets)
                n = np.diff(first)
                row = np.repeat(np.arange(b - a), n)
                if wanted is None:
                    vocabulary, at = np.unique(hashes, return_inverse=True)
                else:
                    vocabulary = wanted
                    at = np.minimum(np.searchsorted(wanted, hashes), max(len(wanted) - 1, 0))
                    hit = wanted[at] == hashes if len(wanted) else np.zeros(len(hashes), bool)
                    row, at = row[hit], at[hit]
                found, tfs = np.unique(row * max(len(vocabulary), 1) + at, return_counts=True)
                row, at = np.divmod(found, max(len(vocabulary), 1))
                sizes = np.bincount(row, minlength=b - a)
                columns = [
                    batch.column(key).slice(a, b - a), pa.array(n, pa.int64()),
                    _lists(vocabulary[at].view(np.int64) if len(at) else np.zeros(0, np.int64), sizes, pa.int64()), _lists(tfs, sizes, pa.int64()),
                ]
                out = pa.RecordBatch.from_arrays(columns, names=[key, "n", "terms", "tfs"])
                yield out if all_rows else out.filter(pa.array(n > 0))

    return run


class K2Treap:
    """Points (row, column, value) of a square grid of side 2 ** depth, with the greatest value of every non-empty cell."""

    def __init__(self, depth: int, masks: np.ndarray, maxima: np.ndarray) -> None:
        """``masks``: the four children of each inner node; ``maxima`` of all nodes; both level by level from the root."""
        self.depth, self.masks, self.maxima = depth, masks, maxima
        ones = np.cumsum(_ONES[masks])
        self.nothing = len(maxima)  # stands for an empty cell
        self._first = np.concatenate(([1], ones[:-1] + 1, np.zeros(len(maxima) - len(masks) + 1, np.int64))) if len(masks) else np.zeros(len(maxima) + 1, np.int64)
        self._mask = np.concatenate((masks, np.zeros(len(maxima) - len(masks) + 1, np.uint8)))
        self._max = np.concatenate((maxima, [0]))

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> K2Treap:
        """Of at least one point, no two at one place."""
        depth = int(max(rows.max(), columns.max())).bit_length()
        code = np.zeros(len(rows), np.int64)
        for k in range(depth):
            code |= ((rows >> k) & 1) << (2 * k + 1) | ((columns >> k) & 1) << (2 * k)
        by = np.argsort(code, kind="stable")
        code, values = code[by], values[by].astype(np.int64)
        masks, maxima = [], [values]
        for _ in range(depth):
            up = code >> 2
            first = np.flatnonzero(np.concatenate(([True], up[1:] != up[:-1])))
            masks.append(np.bitwise_or.reduceat(np.uint8(1) << (code & 3).astype(np.uint8), first))
            values = np.maximum.reduceat(values, first)
            maxima.append(values)
            code = up[first]
        return cls(depth, np.concatenate(masks[::-1]) if masks else np.zeros(0, np.uint8), np.concatenate(maxima[::-1]))

    def compressed(self) -> tuple[bytes, bytes]:
        """Two masks a byte, and each maximum's difference from its parent's; ``K2Treap.restored`` reads them."""
        above = np.concatenate((self.maxima[:1], np.repeat(self.maxima[: len(self.masks)], _ONES[self.masks])))
        drops = above - self.maxima
        drops[0] = self.maxima[0]
        pairs = np.concatenate((self.masks, np.zeros(len(self.masks) % 2, np.uint8))).reshape(-1, 2)
        return (pairs[:, 0] | pairs[:, 1] << 4).astype(np.uint8).tobytes(), drops.astype("<u4").tobytes()

    @classmethod
    def restored(cls, depth: int, masks: bytes, drops: bytes) -> K2Treap:
        packed, maxima = np.frombuffer(masks, np.uint8), np.frombuffer(drops, "<u4").astype(np.int64)
        masks = np.stack((packed & 15, packed >> 4), axis=1).reshape(-1)
        if len(masks) and not masks[-1]:
            masks = masks[:-1]
        start, end = 0, 1
        for _ in range(depth):
            ones = _ONES[masks[start:end]]
            after = end + int(ones.sum())
            maxima[end:after] = np.repeat(maxima[start:end], ones) - maxima[end:after]
            start, end = end, after
        return cls(depth, masks, maxima)

    def top(self, rows: np.ndarray, weights: np.ndarray, k: int, least: int, order: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of, at least, the k best of those that score ``least`` or more (and above 0).

        A column's score is the sum of weights times values over ``rows``. ``order`` ranks (columns, scores), the best first."""
        exact = float(weights.sum()) * IMPACT < 2**53
        weights = weights.astype(np.float64 if exact else np.int64)
        values = self._max.astype(weights.dtype)
        columns, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        nodes, level, prefix = np.zeros((1, len(rows)), np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        bounds = (values[nodes] @ weights).astype(np.int64)
        if self.depth == 0:
            return prefix, bounds
        while len(bounds):
            if len(bounds) > WIDTH:
                best = np.argpartition(-bounds, WIDTH)
                pick, rest = best[:WIDTH], best[WIDTH:]
            else:
                pick, rest = np.arange(len(bounds)), np.zeros(0, np.int64)
            ids, at = nodes[pick], level[pick]
            mask, first = self._mask[ids], self._first[ids]
            high = ((rows >> (self.depth - 1 - at)[:, None]) & 1) << 1
            new = [(nodes[rest], level[rest], prefix[rest], bounds[rest])]
            for half in (0, 1):
                child = np.where((mask >> (high | half)) & 1, first + _BEFORE[mask, high | half], self.nothing)
                bound = (values[child] @ weights).astype(np.int64)
                place = prefix[pick] * 2 + half
                stays = (bound > 0) & (bound >= least)
                done = stays & (at + 1 == self.depth)
                columns, scores = np.concatenate((columns, place[done])), np.concatenate((scores, bound[done]))
                stays &= ~done
                new.append((child[stays], at[stays] + 1, place[stays], bound[stays]))
            if len(scores) >= k:
                by = order(columns, scores)[:k]
                columns, scores = columns[by], scores[by]
                least = max(least, int(scores[-1]))
            nodes, level, prefix, bounds = (np.concatenate(x) for x in zip(*new, strict=True))
            open_ = bounds >= least
            if not open_.all():
                nodes, level, prefix, bounds = nodes[open_], level[open_], prefix[open_], bounds[open_]
        return columns, scores


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Impact of a term that occurs ``tf`` times in a document of ``n`` terms, among so many documents with so many terms in all."""
    m = 100 - 25 + 25 * n * documents // terms
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _chunk(ids: pa.Array, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, documents: int, total: int) -> pa.RecordBatch:
    """The index row of a run of documents. Documents with the same most frequent term stand together, by length, and rare terms come first:
    cells so hold alike impacts."""
    document = np.repeat(np.arange(len(n)), sizes)
    vocabulary, at, spread = np.unique(terms, return_inverse=True, return_counts=True)
    main = np.zeros(len(n), np.int64)
    by = np.lexsort((at, -tfs, document))
    lead = by[np.searchsorted(document, np.flatnonzero(sizes))]
    main[sizes > 0] = at[lead] + 1
    columns = np.lexsort((n, main))
    place = np.empty(len(n), np.int64)
    place[columns] = np.arange(len(n))
    rows = np.lexsort((vocabulary, spread))
    row_of = np.empty(len(rows), np.int64)
    row_of[rows] = np.arange(len(rows))
    tree = K2Treap.of(row_of[at], place[document], impacts(tfs, n[document], documents, total))
    masks, drops = tree.compressed()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids.take(pa.array(columns)).to_pylist()], pa.list_(pa.int64())), pa.array([vocabulary[rows]], pa.list_(pa.int64())),
            pa.array([tree.depth], pa.int32()), pa.array([masks], pa.binary()), pa.array([drops], pa.binary()),
        ],
        names=["doc_ids", "terms", "depth", "masks", "drops"],
    )


def _indexed(documents: int, total: int, chunk_docs: int) -> Task:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, points = [], 0, 0

        def close() -> pa.RecordBatch | None:
            if not points:
                return None
            ids, n, sizes, terms, tfs = zip(*held, strict=True)
            return _chunk(pa.concat_arrays(ids), *(np.concatenate(x) for x in (n, sizes, terms, tfs)), documents, total)

        for batch in batches:
            first = 0
            sizes = np.diff(batch.column("terms").offsets.to_numpy()).astype(np.int64)
            while first < batch.num_rows:
                take = min(chunk_docs - docs, batch.num_rows - first)
                fits = int(np.searchsorted(np.cumsum(sizes[first : first + take]), CHUNK_POINTS - points, side="right"))
                take = min(take, max(fits, 0 if points else 1))
                part = batch.slice(first, take)
                if take:
                    terms, tfs = (part.column(c).flatten().to_numpy() for c in ("terms", "tfs"))
                    held.append((part.column("doc_id"), part.column("n").to_numpy(), sizes[first : first + take], terms, tfs))
                first, docs, points = first + take, docs + take, points + int(sizes[first : first + take].sum())
                if docs >= chunk_docs or first < batch.num_rows:
                    if (row := close()) is not None:
                        yield row
                    held, docs, points = [], 0, 0
        if (row := close()) is not None:
            yield row

    return run


def build_index(st: Stages, docs: DataFrame, wanted: np.ndarray | None = None, chunk_docs: int = CHUNK_DOCS) -> tuple[DataFrame, DataFrame, int, int]:
    """The chunks' K2-treaps, (term, df), N and L. With ``wanted`` (sorted hashes) the grid has those terms' rows only."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n long, terms array<long>, tfs array<long>"
    counted = st.save(texts.mapInArrow(_counted("doc_id", wanted), schema), "term-counts")
    documents, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).head()  # two numbers
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    chunks = counted.where("size(terms) > 0").mapInArrow(_indexed(documents, max(total, 1), chunk_docs), "doc_ids array<long>, terms array<long>, depth int, masks binary, drops binary")
    return st.save(chunks, "treaps"), st.save(df, "document-frequencies"), documents, total


def _searched(items: list[tuple[int | None, np.ndarray, np.ndarray]], k: int) -> Task:
    """The best k of a task's chunks for each item (id, sorted term hashes, weights times repeats)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in items]
        for batch in batches:
            for r in range(batch.num_rows):
                docs = batch.column("doc_ids")[r].values
                ids, missing = docs.fill_null(0).to_numpy(), docs.is_null().to_numpy(zero_copy_only=False)
                terms = batch.column("terms")[r].values.to_numpy()
                by = np.argsort(terms)
                tree = K2Treap.restored(batch.column("depth")[r].as_py(), batch.column("masks")[r].as_py(), batch.column("drops")[r].as_py())

                def order(columns: np.ndarray, scores: np.ndarray) -> np.ndarray:
                    return np.lexsort((ids[columns], missing[columns], -scores))  # noqa: B023

                for i, (_, own, weights) in enumerate(items):
                    at = np.minimum(np.searchsorted(terms, own, sorter=by), len(terms) - 1)
                    has = terms[by[at]] == own
                    if not has.any():
                        continue
                    old_ids, old_missing, old_scores = best[i]
                    least = int(old_scores[-1]) if len(old_scores) == k else 1
                    columns, scores = tree.top(by[at[has]], weights[has], k, least, order)
                    if len(columns):
                        a, m, s = np.concatenate((old_ids, ids[columns])), np.concatenate((old_missing, missing[columns])), np.concatenate((old_scores, scores))
                        keep = np.lexsort((a, m, -s))[:k]
                        keep = keep[s[keep] > 0]
                        best[i] = a[keep], m[keep], s[keep]
        for (item, _, _), (ids, missing, scores) in zip(items, best, strict=True):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(scores), pa.int64()), pa.array(ids, pa.int64(), mask=missing), pa.array(scores, pa.int64())],
                    names=["item_id", "doc_id", "score"],
                )

    return run


def search(docs: DataFrame, items: DataFrame, k: int = TOP, chunk_docs: int = CHUNK_DOCS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k documents of highest score above 0; equal scores by doc_id, null last.

    Documents without terms are not counted and never found, items without terms (null or empty texts) have no rows. Repeated rows of
    documents are documents of their own. Of rows with one item_id the first text by bytes counts. Terms are told apart by 64-bit hashes."""
    spark = docs.sparkSession
    with Stages(spark) as st:
        texts = items.groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
        schema = "item_id long, n long, terms array<long>, tfs array<long>"
        asked = st.save(texts.mapInArrow(_counted("item_id", None), schema), "items")
        size = asked.agg(F.sum(F.size("terms"))).head()[0] or 0  # one number
        blocks = max(1, -(-size // block_terms))
        found = None
        for number in range(blocks):
            rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()  # a block of items, about block_terms terms
            wanted = np.unique(np.array([t for r in rows for t in r.terms], np.int64).view(np.uint64))
            index, frequencies, documents, _ = build_index(st, docs, wanted, chunk_docs)
            df = {r.term: r.df for r in frequencies.collect()}  # the block's terms at most
            queries = []
            for r in rows:
                known = [(t, weight(documents, df[t]) * tf) for t, tf in zip(r.terms, r.tfs, strict=True) if t in df]
                if known:
                    queries.append((r.item_id, np.array([t for t, _ in known], np.int64), np.array([w for _, w in known], np.int64)))
            some = st.save(index.mapInArrow(_searched(queries, k), "item_id long, doc_id long, score long"), "found")
            found = some if found is None else found.unionByName(some)
        best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return st.save(ranked.select("item_id", "rank", "doc_id", "score"), "ranked", keep=True)


#: The same over DuckDB's ``documents`` and ``benchmark``, for unique ids.
SQL = f"""
WITH doc_terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents
), item_terms AS (
  SELECT item_id, term, count(*) AS qf FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term
), sizes AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
corpus AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM sizes),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms SEMI JOIN item_terms USING (term) GROUP BY doc_id, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, corpus GROUP BY term, nn),
scores AS (
  SELECT item_id, doc_id, CAST(sum(qf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // l)))) AS BIGINT) AS score
  FROM item_terms JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id) CROSS JOIN corpus GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
