"""Repeated passages by unit hashing, with the places of what is to go in the original text.

The words of a text are its runs of letters and digits in lower case; marks and line breaks cut it into clauses. A unit begins at a
clause and takes in whole clauses until it has UNIT_WORDS words, so two texts that share a passage share units wherever the passage
begins and ends in their lines. Digests of all units are grouped over the whole table; the earliest occurrence by doc_id and place is kept.
Units that follow each other in a document as their kept occurrences do are a chain. A chain is extended word by word on both sides
as far as the texts agree, by up to LEAST_WORDS - UNIT_WORDS words, which is all that a passage of LEAST_WORDS words can need. Chains of at
least LEAST_WORDS words are reported, those of a document that overlap as one span.

``repeated_units`` is the plain form: whole lines, each reported by itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmweave.llm.common import Stages, text_chunks

#: Lines of fewer words are left alone by ``repeated_units``.
LEAST_UNIT = 4
#: Words that a unit of clauses has at least.
UNIT_WORDS = 20
#: Shorter passages are left alone.
LEAST_WORDS = 50

_GAPS = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile(r"[.!?,;:\n]+")


def normal_unit(line: str) -> str:
    """Lower case, letters and digits only, one blank between words."""
    return _GAPS.sub(" ", line.lower()).strip()


def units(docs: DataFrame, least_words: int = LEAST_UNIT) -> DataFrame:
    """A row per unit of at least so many words: row, doc_id, unit_no, start and end (in code points), n_words, d1, d2 (128-bit digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, _ in text_chunks(batch):
                at, number, start, end, words, digests = [], [], [], [], [], []
                for i, text in enumerate(batch.column("text").slice(a, b - a).to_pylist()):
                    place = 0
                    for k, line in enumerate(text.split("\n") if text else ()):
                        unit = normal_unit(line)
                        n = unit.count(" ") + 1 if unit else 0
                        if n >= least_words:
                            at.append(a + i)
                            number.append(k)
                            start.append(place)
                            end.append(place + len(line))
                            words.append(n)
                            digests.append(hashlib.blake2b(unit.encode(), digest_size=16).digest())
                        place += len(line) + 1
                digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                picked = batch.select(["row", "doc_id"]).take(pa.array(at, pa.int64()))
                columns = [*picked.columns, *[pa.array(x, pa.int64()) for x in (number, start, end, words, digest[:, 0], digest[:, 1])]]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "unit_no", "start", "end", "n_words", "d1", "d2"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = ("row", "doc_id", "unit_no", "start", "end", "n_words", "d1", "d2")
    return rows.mapInArrow(run, ", ".join(f"`{n}` long" for n in names))


def repeated_units(docs: DataFrame, least_words: int = LEAST_UNIT) -> DataFrame:
    """A row per unit to remove: doc_id, unit_no, start, end, n_words, kept_doc_id, kept_unit_no, occurrences.

    The kept occurrence is the earliest by doc_id (null last), row and place; that may be in the same document.
    Null and empty texts have no units; of rows with one doc_id the first read comes first."""
    with Stages(docs.sparkSession) as st:
        rows = st.save(units(docs, least_words), "units")
        place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "unit_no")
        firsts = rows.groupBy("d1", "d2").agg(F.min(place).alias("m"), F.count("*").alias("occurrences")).where("occurrences > 1")
        firsts = st.save(
            firsts.select("d1", "d2", F.col("m.doc_id").alias("kept_doc_id"), F.col("m.row").alias("kept_row"), F.col("m.unit_no").alias("kept_unit_no"), "occurrences"),
            "first-units",
        )
        out = rows.join(firsts, ["d1", "d2"]).where("row <> kept_row or unit_no <> kept_unit_no")
        return st.save(out.select("doc_id", "unit_no", "start", "end", "n_words", "kept_doc_id", "kept_unit_no", "occurrences"), "repeated-units", keep=True)


# --- passages ----------------------------------------------------------------------------------


def clause_units(text: str, least: int) -> tuple[list[int], list[int], list[int]]:
    """First word, end word and 64-bit digest of the units of a text."""
    words, ends, starts = [], [], []
    for piece in _MARKS.split(text):
        found = _WORD.findall(piece)
        if found:
            starts.append(len(words))
            words += found
            ends.append(len(words))
    if len(words) < least:
        return [], [], []
    low = " ".join(words).lower().split(" ")
    a, b, digests, k = [], [], [], 0
    for start in starts:
        while k < len(ends) and ends[k] < start + least:
            k += 1
        if k == len(ends):
            break
        a.append(start)
        b.append(ends[k])
        digests.append(xxhash.xxh3_64_intdigest(" ".join(low[start : ends[k]])))
    return a, b, digests


def _document(docs: DataFrame) -> DataFrame:
    """doc_id, body (a hash of the text) and text: together the first two name a document."""
    return docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("body"), "text")


def _units(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, _ in text_chunks(batch):
                at, first, end, digests = [], [], [], []
                for i, text in enumerate(batch.column("text").slice(a, b - a).to_pylist(), a):
                    x, y, d = clause_units(text, least)
                    at += [i] * len(x)
                    first += x
                    end += y
                    digests += d
                picked = batch.select(["doc_id", "body"]).take(pa.array(at, pa.int64()))
                columns = [*picked.columns, pa.array(first, pa.int32()), pa.array(end, pa.int32()), pa.array(np.array(digests, np.uint64).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "body", "a", "b", "digest"])

    return run


def _surroundings(reach: int):
    """For each asked (a, b) of a document: the ``reach`` words before word a and from word b on, and where the words from a - reach
    to a start and those from b - 1 to b + reach - 1 end, in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                text, asked = batch.column("text")[r].as_py(), batch.column("asked")[r].as_py()
                spans = [m.span() for m in _WORD.finditer(text)]
                before, after, starts, ends = [], [], [], []
                for x in asked:
                    a, b = x["a"], x["b"]
                    before.append([text[p:q].lower() for p, q in spans[max(a - reach, 0) : a]][::-1])
                    after.append([text[p:q].lower() for p, q in spans[b : b + reach]])
                    starts.append([p for p, _ in spans[max(a - reach, 0) : a + 1]][::-1])
                    ends.append([q for _, q in spans[b - 1 : b + reach]])
                n = len(asked)
                columns = [batch.column(c)[r].as_py() for c in ("doc_id", "body")]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array([x] * n, pa.int64()) for x in columns], *[pa.array([x[c] for x in asked], pa.int32()) for c in ("a", "b")],
                        *[pa.array(x, pa.list_(pa.string())) for x in (before, after)], *[pa.array(x, pa.list_(pa.int64())) for x in (starts, ends)],
                    ],
                    names=["doc_id", "body", "a", "b", "before", "after", "starts", "ends"],
                )

    return run


_AROUND = "doc_id long, body long, a int, b int, before array<string>, after array<string>, starts array<long>, ends array<long>"


def _agreeing(left: Column, right: Column) -> Column:
    """Leading elements that two lists have in common."""
    differs = F.array_position(F.zip_with(left, right, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(left), F.size(right))).cast("int")


def _islands(rows: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Rows of equal keys with ``island``, a number that those share whose [start, end) overlap or touch, directly or by others."""
    order = Window.partitionBy(*keys).orderBy(start, end)
    seen = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col(start) > seen).cast("int"), F.lit(1))
    return rows.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("fresh")


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS, unit_words: int = UNIT_WORDS) -> DataFrame:
    """A row per span of a text to remove: doc_id, body (xxhash64 of the text), start, end (code points), n_words, kept_doc_id (the earliest document
    that keeps a part of it; may be the same, with an earlier place), parts (chains that the span is made of).

    Earliest is by doc_id (null last), body and place. Rows with one doc_id and one text are one document. Null and empty texts have no
    units. Units are told apart by 64 bits; a chance meeting of two is no passage, because the words around them are compared. A passage of ``least_words`` words is found if whole clauses of it have ``unit_words`` words together."""
    reach = least_words - unit_words
    with Stages(docs.sparkSession) as st:
        texts = _document(docs)
        units = st.save(texts.mapInArrow(_units(unit_words), "doc_id long, body long, a int, b int, digest long"), "units")
        place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "body", "a")
        firsts = units.groupBy("digest").agg(F.min(place).alias("m"), F.count("*").alias("n")).where("n > 1")
        firsts = st.save(firsts.select("digest", F.col("m.doc_id").alias("k_doc"), F.col("m.body").alias("k_body"), F.col("m.a").alias("k_a")), "first-units")
        itself = F.col("doc_id").eqNullSafe(F.col("k_doc")) & (F.col("body") == F.col("k_body")) & (F.col("a") == F.col("k_a"))
        met = units.join(firsts, "digest").where(~itself).select("doc_id", "body", "a", "b", "k_doc", "k_body", (F.col("a") - F.col("k_a")).alias("shift"))
        line = ["doc_id", "body", "k_doc", "k_body", "shift"]
        chains = _islands(st.save(met, "matches"), line, "a", "b").groupBy(*line, "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
        chains = st.save(chains.withColumns({"k_a": F.col("a") - F.col("shift"), "k_b": F.col("b") - F.col("shift")}).drop("shift", "island"), "chains")
        own = chains.select("doc_id", "body", "a", "b")
        asked = own.unionByName(chains.select(F.col("k_doc").alias("doc_id"), F.col("k_body").alias("body"), F.col("k_a").alias("a"), F.col("k_b").alias("b")))
        # Of one document, distinct pairs of clause bounds: as many as its text can hold.
        asked = asked.distinct().groupBy(F.col("doc_id").alias("q_doc"), F.col("body").alias("q_body")).agg(F.collect_list(F.struct("a", "b")).alias("asked"))
        asked = st.save(asked, "asked")
        same = (F.col("body") == F.col("q_body")) & F.col("doc_id").eqNullSafe(F.col("q_doc"))
        around = texts.join(asked, same).select("doc_id", "body", "text", "asked").mapInArrow(_surroundings(reach), _AROUND)
        around = st.save(around, "surroundings")
        mine = around.select(F.col("doc_id").alias("x"), "body", "a", "b", "before", "after", "starts", "ends")
        theirs = around.select(
            F.col("doc_id").alias("y"), F.col("body").alias("k_body"), F.col("a").alias("k_a"), F.col("b").alias("k_b"), F.col("before").alias("k_before"), F.col("after").alias("k_after")
        )
        both = chains.join(mine, ["body", "a", "b"]).where("doc_id <=> x").join(theirs, ["k_body", "k_a", "k_b"]).where("k_doc <=> y")
        both = both.withColumns({"more": _agreeing(F.col("before"), F.col("k_before")), "on": _agreeing(F.col("after"), F.col("k_after"))})
        spans = both.select(
            "doc_id", "body", "k_doc", "k_body", "k_a", (F.col("a") - F.col("more")).alias("first"), (F.col("b") + F.col("on")).alias("past"),
            F.get("starts", F.col("more")).alias("start"), F.get("ends", F.col("on")).alias("end"),
        ).where(F.col("past") - F.col("first") >= least_words)
        kept = F.min(F.struct(F.col("k_doc").isNull().alias("last"), "k_doc")).alias("kept")
        spans = spans.distinct()  # a row that is there twice has met itself
        spans = _islands(st.save(spans, "spans"), ["doc_id", "body"], "first", "past").groupBy("doc_id", "body", "island").agg(
            F.min("start").alias("start"), F.max("end").alias("end"), (F.max("past") - F.min("first")).cast("long").alias("n_words"), kept, F.count("*").alias("parts")
        )
        return st.save(spans.select("doc_id", "body", "start", "end", "n_words", F.col("kept.k_doc").alias("kept_doc_id"), "parts"), "passages", keep=True)


def remove_passages(docs: DataFrame, least_words: int = LEAST_WORDS, unit_words: int = UNIT_WORDS) -> DataFrame:
    """The documents without their repeated passages, and ``kept_spans``, where in the original text what is left stood: (start, end) in code points.

    The name must not be a column of ``docs``. Null texts stay null, with no spans."""
    names = docs.columns
    with Stages(docs.sparkSession) as st:
        spans = repeated_passages(docs, least_words, unit_words)
        cut = spans.groupBy("doc_id", "body").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cut"))  # bounded by the text
        cut = st.save(cut.toDF("_cut_doc", "_cut_body", "_cut"), "cuts")
        met = docs.join(cut, (F.xxhash64("text") == F.col("_cut_body")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_cut_doc")), "left")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, spans = [], []
                for text, cuts in zip(batch.column("text"), batch.column("_cut"), strict=True):
                    text, at, left = text.as_py(), 0, []
                    for x in cuts.as_py() or ():
                        left.append((at, x["start"]))
                        at = x["end"]
                    left = [x for x in [*left, (at, len(text))] if x[0] < x[1]] if text is not None else []
                    texts.append("".join(text[p:q] for p, q in left) if text is not None else None)
                    spans.append([{"start": p, "end": q} for p, q in left])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=[*names, "kept_spans"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        return st.save(met.select(*names, "_cut").mapInArrow(run, f"{schema}, kept_spans array<struct<start:long,end:long>>"), "without-passages", keep=True)


def _sql_common(left: str, right: str) -> str:
    same = f"list_transform(range(least(len({left}), len({right}))), lambda i: {left}[i + 1] = {right}[i + 1])"
    return f"CAST(coalesce(nullif(list_position({same}, false), 0) - 1, least(len({left}), len({right}))) AS INTEGER)"


_REACH = LEAST_WORDS - UNIT_WORDS

#: ``repeated_passages`` over DuckDB's ``documents``, for unique doc_ids.
SQL = f"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(text, '[^.!?,;:\\n]*[.!?,;:\\n]?') AS l FROM documents WHERE text IS NOT NULL
), pieces AS (
  SELECT doc_id, unnest(range(len(l))) AS p, unnest(l) AS piece FROM cut
), placed AS (
  SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY p) - length(piece) AS pos, regexp_extract_all(piece, '[^\\p{{L}}\\p{{N}}]*[\\p{{L}}\\p{{N}}]+') AS g FROM pieces
), gapped AS (
  SELECT doc_id, p, pos, unnest(range(len(g))) AS k, unnest(g) AS gw FROM placed
), ended AS (
  SELECT doc_id, p, k, lower(regexp_extract(gw, '[\\p{{L}}\\p{{N}}]+$')) AS w, length(regexp_extract(gw, '[\\p{{L}}\\p{{N}}]+$')) AS size,
    pos + sum(length(gw)) OVER (PARTITION BY doc_id, p ORDER BY k) AS past
  FROM gapped
), words AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p, k) - 1 AS i FROM ended
), texts AS (
  SELECT doc_id, list(w ORDER BY i) AS wl, list(CAST(past - size AS BIGINT) ORDER BY i) AS s, list(CAST(past AS BIGINT) ORDER BY i) AS e FROM words GROUP BY doc_id
), clauses AS (
  SELECT doc_id, min(i) AS a, max(i) + 1 AS b FROM words GROUP BY doc_id, p
), units AS (
  SELECT doc_id, x.a, min(y.b) AS b FROM clauses x JOIN clauses y USING (doc_id) WHERE y.b >= x.a + {UNIT_WORDS} GROUP BY doc_id, x.a
), named AS (
  SELECT doc_id, a, b, array_to_string(wl[a + 1:b], ' ') AS u FROM units JOIN texts USING (doc_id)
), met AS (
  SELECT *, first_value(doc_id) OVER w AS kd, first_value(a) OVER w AS ka FROM named WINDOW w AS (PARTITION BY u ORDER BY doc_id, a)
), marked AS (
  SELECT *, a - ka AS shift, coalesce(a > max(b) OVER (PARTITION BY doc_id, kd, a - ka ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh
  FROM met WHERE doc_id <> kd OR a <> ka
), numbered AS (
  SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id, kd, shift ORDER BY a) AS island FROM marked
), chains AS (
  SELECT doc_id, kd, shift, min(a) AS a, max(b) AS b FROM numbered GROUP BY doc_id, kd, shift, island
), sides AS (
  SELECT c.doc_id, c.kd, c.a, c.b, x.s, x.e, list_reverse(x.wl[greatest(a - {_REACH}, 0) + 1:a]) AS l, list_reverse(y.wl[greatest(a - shift - {_REACH}, 0) + 1:a - shift]) AS kl,
    x.wl[b + 1:b + {_REACH}] AS r, y.wl[b - shift + 1:b - shift + {_REACH}] AS kr
  FROM chains c JOIN texts x ON x.doc_id = c.doc_id JOIN texts y ON y.doc_id = c.kd
), spans AS (
  SELECT doc_id, kd, a - {_sql_common("l", "kl")} AS first, b + {_sql_common("r", "kr")} AS past, s, e FROM sides
), long AS (
  SELECT doc_id, kd, first, past, s[first + 1] AS start, e[past] AS "end" FROM spans WHERE past - first >= {LEAST_WORDS}
), opened AS (
  SELECT *, coalesce(first > max(past) OVER (PARTITION BY doc_id ORDER BY first, past ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh FROM long
), counted AS (
  SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY first, past ROWS UNBOUNDED PRECEDING) AS island FROM opened
)
SELECT doc_id, min(start) AS "start", max("end") AS "end", CAST(max(past) - min(first) AS BIGINT) AS n_words, min(kd) AS kept_doc_id, count(*) AS parts
FROM counted GROUP BY doc_id, island
"""
