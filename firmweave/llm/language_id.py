"""Language identification by character language models with interpolated Kneser-Ney smoothing.

For each language the n-grams of ORDER characters of all its labelled texts are counted; the lower orders count in how many
contexts an n-gram is seen. The counts and the smoothed log-probabilities, of a gram's last character after the others and
for each language, stay tables with a row per n-gram, also of those that only the texts to be judged have. The rows of the most frequent ones
go along with the tasks that read the texts, as many as HOT_BYTES hold; what a text has of the others is joined with their rows. Log-probabilities are
whole multiples of 1 / UNIT, so sums are the same wherever an n-gram is looked up. The language of least cross-entropy per
character wins. A model knows the texts it has learnt by heart, so labelled texts are also learnt without one of FOLDS folds, and a
text to be judged that is a labelled one is judged by the models without its fold, others by those of all. A text is rejected if its cross-entropy
is far beyond what labelled texts of its language and length have under models without them, judged by their quartiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmweave.llm.common import Stages, mix64, text_chunks, unused, wide

ORDER = 4
DISCOUNT = 0.75
#: Log-probabilities are rounded to multiples of 1 / UNIT.
UNIT = 1 << 22
#: Bytes of n-grams and log-probabilities that go along with the tasks.
HOT_BYTES = 32_000_000
#: Distinct n-grams that a task counts before it passes the counts on.
HELD_GRAMS = 1_000_000
#: All hashes are counted in slices by so many leading bits, to find where the shares end.
SLICE_BITS = 12
#: Deviations (from the quartiles, LEAST_SPREAD at least) beyond the median at which a text is rejected, and held-out training texts that
#: a language's length class, or a language, needs for a limit of its own; below, that of the language or of all of them holds.
REJECT_AT = 12.0
LEAST_SPREAD = 0.08
REJECT_LEAST = 30
REJECT_LEAST_LANGUAGE = 8
#: Folds of the labelled texts; those of the first one, under the models without it, give the limits.
FOLDS = 4

_SPACE = ord(" ")
#: UTF-16 units that are letters: whatever Python calls one, halves of characters beyond 16 bits, and the marks of scripts that write vowels so.
_LETTER = np.array([
    chr(u).isalpha() or 0x61 <= u <= 0x7A or 0xC0 <= u < 0x2000 and u not in (0xD7, 0xF7) or u >= 0x2C00 for u in range(1 << 16)
])


def characters(text: str) -> np.ndarray:
    """UTF-16 units of the lower-case text, each run of what is no letter a blank; one blank at either end."""
    units = np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), np.uint16)
    units = np.where(_LETTER[units], units, _SPACE)
    units = np.concatenate(([_SPACE], units, [_SPACE])).astype(np.uint64)
    keep = np.ones(len(units), bool)
    keep[1:] = (units[1:] != _SPACE) | (units[:-1] != _SPACE)
    return units[keep]


def grams(units: np.ndarray, order: int) -> np.ndarray:
    """The n-grams of ``order`` units ending at each unit but the first, shorter ones at the start padded with blanks."""
    padded = np.concatenate((np.full(order - 2, _SPACE, np.uint64), units)) if order > 1 else units[1:]
    n = len(padded) - order + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(order):
        out = out << np.uint64(16) | padded[k : k + n]
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


class Model:
    """The models of few texts in memory: sorted hash arrays and smoothed log-probabilities, made from counts (language, gram, n) of
    order ORDER. ``learn`` makes the same of any number of texts."""

    def __init__(self, languages: list[str], language: np.ndarray, gram: np.ndarray, count: np.ndarray) -> None:
        self.languages = languages
        width = len(languages)
        counts, codes = [], []
        for order in range(ORDER, 0, -1):
            keys, where = np.unique(gram, return_inverse=True)
            table = np.zeros((len(keys), width))
            np.add.at(table, (where, language), count)
            codes.append(keys)
            counts.append(table)
            # Next order: an n-gram counts once for each distinct character before it.
            shorter = np.uint64((1 << (16 * (order - 1))) - 1)
            row, language = np.nonzero(table)
            gram, count = keys[row] & shorter, np.ones(len(row))
        base = np.full(width, -np.log(len(codes[-1]) + 1))
        self.unseen = base
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        lower_codes = lower = None
        self._contexts: list[tuple[np.ndarray, np.ndarray]] = []
        for order in range(1, ORDER + 1):
            keys, table = codes[ORDER - order], counts[ORDER - order]
            context, where = np.unique(keys >> np.uint64(16), return_inverse=True)
            total, kinds = np.zeros((len(context), width)), np.zeros((len(context), width))
            np.add.at(total, where, table)
            np.add.at(kinds, where, table > 0)
            held = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1e-12), 1.0)
            if lower is None:
                below = np.exp(base)[None, :]
            else:
                below = np.exp(lower[np.searchsorted(lower_codes, keys & np.uint64((1 << (16 * (order - 1))) - 1))])
            seen = np.where(total[where] > 0, np.maximum(table - DISCOUNT, 0) / np.maximum(total[where], 1e-12), 0)
            logs = np.log(seen + held[where] * below)
            hashes = mix64(keys + np.uint64(order))
            by = np.argsort(hashes)
            self.tables.append((hashes[by], logs[by].astype(np.float32)))
            context_hashes = mix64(context + np.uint64(order))
            by = np.argsort(context_hashes)
            self._contexts.append((context_hashes[by], np.log(held[by]).astype(np.float32)))
            lower_codes, lower = keys, logs

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """(n-gram, language): log-probability of each n-gram's last character, by the longest order that any language has seen."""
        out = np.zeros((len(codes), len(self.languages)), np.float32)
        left = np.arange(len(codes))
        for order in range(ORDER, 0, -1):
            own = codes[left] & np.uint64((1 << (16 * order)) - 1)
            hashes, logs = self.tables[order - 1]
            key = mix64(own + np.uint64(order))
            at = np.minimum(np.searchsorted(hashes, key), len(hashes) - 1)
            hit = hashes[at] == key
            out[left[hit]] += logs[at[hit]]
            left, own = left[~hit], own[~hit]
            if not len(left):
                return out
            hashes, logs = self._contexts[order - 1]  # what the context holds back for unseen characters
            key = mix64((own >> np.uint64(16)) + np.uint64(order))
            at = np.minimum(np.searchsorted(hashes, key), len(hashes) - 1)
            met = hashes[at] == key
            out[left[met]] += logs[at[met]]
        out[left] += self.unseen.astype(np.float32)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (text, language), and characters."""
        codes = [grams(characters(t), ORDER) for t in texts]
        sizes = np.array([len(c) for c in codes], np.int64)
        found, where = np.unique(np.concatenate(codes), return_inverse=True)
        logs = self.log_probabilities(found)[where]
        first = np.cumsum(sizes) - sizes
        return -np.add.reduceat(logs.astype(np.float64), first, axis=0) / sizes[:, None], sizes


def fold(text: Column) -> Column:
    """The fold of a labelled text; equal texts go together."""
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, fold, gram, n over the whole texts of ``docs`` (text, lang, fold); lang and fold may be null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[str | None, int | None], list[tuple[np.ndarray, np.ndarray]]] = {}

        def settle() -> int:
            for key, parts in waiting.items():
                grams_met, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(where, np.concatenate([n for _, n in parts]), len(grams_met)).astype(np.int64)
                waiting[key] = [(grams_met, n)]
            return sum(len(parts[0][0]) for parts in waiting.values())

        def passed_on() -> Iterator[pa.RecordBatch]:
            for key, [(grams_met, n)] in waiting.items():
                columns = [pa.repeat(pa.scalar(x, kind), len(n)) for x, kind in zip(key, (pa.string(), pa.int32()), strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(grams_met.view(np.int64)), pa.array(n)], names=["lang", "fold", "gram", "n"])
            waiting.clear()

        size = 0
        for batch in batches:
            for a, b, _, _ in text_chunks(batch):
                fresh: dict[tuple[str | None, int | None], list[np.ndarray]] = {}
                for text, *key in zip(*[batch.column(c).slice(a, b - a).to_pylist() for c in ("text", "lang", "fold")], strict=True):
                    if has_letter(text):
                        fresh.setdefault(tuple(key), []).append(grams(characters(text), ORDER))
                for key, codes in fresh.items():
                    part = np.unique(np.concatenate(codes), return_counts=True)
                    waiting.setdefault(key, []).append(part)
                    size += len(part[0])
                if size > 2 * HELD_GRAMS:
                    size = settle()
                    if size > HELD_GRAMS:
                        yield from wide(passed_on(), 100_000)
                        size = 0
        settle()
        yield from wide(passed_on(), 100_000)

    met = docs.select("text", "lang", "fold").mapInArrow(run, "lang string, fold int, gram long, n long")
    return met.groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n"))


def sample(st: Stages, docs: DataFrame, texts: int) -> DataFrame:
    """(text, lang) of at most ``texts`` labelled rows with letters, a language's share being those of the smallest hashes. Rows without
    text or lang are left out; equal texts go together, so a share may be exceeded by copies of one text."""
    rows = docs.select("text", "lang").where("lang is not null and text is not null").withColumn("hash", F.xxhash64("text"))
    hashes = st.save(rows.groupBy("lang", "hash").agg(F.count("*").alias("n")), "text-hashes")
    languages = hashes.select("lang").distinct().count()
    share = max(1, texts // max(1, languages))
    # Only hashes up to the slice in which a language's share ends are ranked, and no text is shuffled.
    slices = hashes.groupBy("lang", F.shiftright("hash", 64 - SLICE_BITS).alias("slice")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("lang").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < share)
    ends = slices.groupBy("lang").agg(F.max("slice").alias("end"))  # a row per language, as below
    low = hashes.join(F.broadcast(ends), "lang").where(F.shiftright("hash", 64 - SLICE_BITS) <= F.col("end"))
    by_hash = Window.partitionBy("lang").orderBy("hash")
    ranked = low.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= share)
    least = st.save(ranked.groupBy("lang").agg(F.max("hash").alias("last")), "least-hashes")
    return st.save(rows.join(F.broadcast(least), "lang").where("hash <= last").select("text", "lang"), "sample")


def fit(st: Stages, taught: DataFrame) -> Model | None:
    """A model of the languages of ``taught`` (text, lang), few texts; texts without letters teach nothing."""
    rows = taught.select("text", "lang", F.lit(0).alias("fold")).where("lang is not null and text is not null")
    found = st.save(gram_counts(rows), "gram-counts").select("lang", "gram", "n").toArrow()
    names = found.column("lang").to_pylist()
    languages = sorted(set(names), key=str.encode)
    if not languages:
        return None
    number = {x: i for i, x in enumerate(languages)}
    language = np.array([number[x] for x in names], np.int64)
    return Model(languages, language, found.column("gram").to_numpy().view(np.uint64), found.column("n").to_numpy().astype(np.float64))


@dataclass
class Learnt:
    """Log-probabilities of n-grams, as multiples of 1 / UNIT: a column for each language by code point under models of all labelled texts, then
    so many under models without the first fold, and so on."""

    languages: list[str]
    #: (models, language): whether the models lack the language.
    absent: np.ndarray
    #: gram and q0, q1, ..; without the rows of the arrays below.
    rare: DataFrame | None
    #: Sorted, the most frequent n-grams, and a row of log-probabilities for each column.
    grams: np.ndarray
    logs: np.ndarray

    def folds_without(self, lang: Column, own: Column) -> Column:
        """The fold, or null if no other one has texts of its language."""
        lacking = [(lang == self.languages[j]) & (own == m - 1) for m, j in np.argwhere(self.absent).tolist()]
        return F.when(reduce(or_, lacking, F.lit(False)), None).otherwise(own)


def learn(st: Stages, texts: DataFrame) -> Learnt:
    """Models of the languages of ``texts`` (text, lang, fold), for the n-grams of all of them. Texts with lang null teach nothing but
    have their n-grams in the tables, so every text of ``texts`` can be looked up whole."""
    counts = st.save(gram_counts(texts), "gram-counts")
    found = counts.where("lang is not null").groupBy("lang").agg(F.collect_set("fold").alias("folds")).collect()  # a row per language
    found.sort(key=lambda r: r.lang.encode())
    languages = [r.lang for r in found]
    absent = np.array([[set(r.folds) <= {m - 1} for r in found] for m in range(FOLDS + 1)])
    if not languages:
        return Learnt([], absent, None, np.zeros(0, np.uint64), np.zeros((0, 0), np.int32))
    models = [(m, x) for m in range(FOLDS + 1) for x in languages]
    width = range(len(models))
    counted = [F.sum(F.when((F.col("lang") == x) & (F.col("fold") != m - 1), F.col("n")).otherwise(0)).alias(f"c{i}") for i, (m, x) in enumerate(models)]
    tables = {ORDER: st.save(counts.groupBy("gram").agg(F.sum("n").alias("n"), *counted), "grams")}
    st.free(counts)
    for order in range(ORDER - 1, 0, -1):  # an n-gram counts once for each distinct character before it
        preceding = [F.count_if(F.col(f"c{i}") > 0).alias(f"c{i}") for i in width]
        tables[order] = st.save(tables[order + 1].groupBy(_shorter(order).alias("gram")).agg(*preceding), "grams")
    sums = [x for i in width for x in (F.sum(f"c{i}").alias(f"total{i}"), F.count_if(F.col(f"c{i}") > 0).alias(f"kinds{i}"))]
    kinds = [F.count_if(reduce(or_, [F.col(f"c{m * len(languages) + j}") > 0 for j in range(len(languages))])) for m in range(FOLDS + 1)]
    first = list(tables[1].agg(*sums, *kinds).first())
    named = zip([c for i in width for c in (f"total{i}", f"kinds{i}")], first[: 2 * len(models)], strict=True)
    rows = tables[1].select("*", *[F.lit(n).alias(c) for c, n in named])
    rows = rows.select("*", *[F.lit(1 / (1 + first[2 * len(models) + m])).alias(f"p{i}") for i, (m, _) in enumerate(models)])
    for order in range(1, ORDER + 1):
        if order > 1:
            totals = tables[order].groupBy(F.shiftrightunsigned("gram", 16).alias("context")).agg(*sums)
            rows = tables[order].withColumns({"context": F.shiftrightunsigned("gram", 16), "shorter": _shorter(order - 1)})
            rows = rows.join(totals, "context").join(below.withColumnRenamed("gram", "shorter"), "shorter")
        smoothed = [_smoothed(*[F.col(f"{c}{i}") for c in ("c", "total", "kinds", "p")]) for i in width]
        if order < ORDER:
            below = st.save(rows.select("gram", *[p.alias(f"p{i}") for i, p in enumerate(smoothed)]), "probabilities")
    logs = [F.round(F.log(p) * UNIT).cast("int").alias(f"q{i}") for i, p in enumerate(smoothed)]
    table = st.save(rows.select("gram", F.floor(F.log2("n") * 4).alias("weight"), *logs), "probabilities")
    # Whole classes of weight, the heaviest first.
    room, least = HOT_BYTES // (8 + 4 * len(models)), np.inf
    for weight, n in sorted(((r["weight"], r["count"]) for r in table.groupBy("weight").count().collect()), reverse=True):
        room -= n
        if room < 0:
            break
        least = weight
    hot = table.where(F.col("weight") >= F.lit(float(least))).drop("weight").toArrow()
    keys = hot.column("gram").to_numpy().view(np.uint64)
    by = np.argsort(keys)
    values = np.array([hot.column(f"q{i}").to_numpy()[by] for i in width], np.int32)
    return Learnt(languages, absent, table.where(F.col("weight") < F.lit(float(least))).drop("weight"), keys[by], values)


def _shorter(order: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << (16 * order)) - 1))


def _smoothed(count: Column, total: Column, kinds: Column, below: Column) -> Column:
    """Kneser-Ney probability: what is left of the count, and of what the context holds back, the share of the lower order."""
    return F.when(total > 0, F.greatest(count - F.lit(DISCOUNT), F.lit(0.0)) / total + DISCOUNT * kinds / total * below).otherwise(below)


def _scored(st: Stages, docs: DataFrame, learnt: Learnt, without: Column, extra: list[str], names: dict[str, str]) -> DataFrame:
    """Each row's ``extra`` columns, and under the ``names`` lang_pred, score, cross_entropy and size_class, the power of two of its length; by the
    models without the fold that ``without`` gives, or by those of all labelled texts where it is null."""
    width = len(learnt.languages)
    keys, logs, absent = learnt.grams, learnt.logs, learnt.absent
    row, model = names["row"], names["model"]
    own = [names[c] for c in ("sums", "n_units", "rare", "times")]

    def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, _ in text_chunks(batch):
                texts = batch.column("text").slice(a, b - a).to_pylist()
                models = batch.column(model).slice(a, b - a).to_numpy()
                sums, length = np.zeros((len(texts), width), np.int64), np.zeros(len(texts), np.int64)
                codes = {i: grams(characters(t), ORDER) for i, t in enumerate(texts) if width and has_letter(t)}
                known = np.array(list(codes), np.int64)
                missed = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
                for m in np.unique(models[known]).tolist():
                    mine = known[models[known] == m]
                    sizes = np.array([len(codes[i]) for i in mine], np.int64)
                    found, where = np.unique(np.concatenate([codes[i] for i in mine]), return_inverse=True)
                    at = np.searchsorted(keys, found)
                    hit = at < len(keys)
                    hit[hit] = keys[at[hit]] == found[hit]
                    first = np.cumsum(sizes) - sizes
                    for j in range(width):
                        value = np.zeros(len(found), np.int64)
                        value[hit] = logs[m * width + j, at[hit]]
                        sums[mine, j] = np.add.reduceat(value[where], first) if not absent[m, j] else -(1 << 60)
                    length[mine] = sizes
                    far = ~hit[where]
                    pairs, n = np.unique(np.repeat(mine, sizes)[far] * len(found) + where[far], return_counts=True)
                    missed.append((pairs // len(found), found[pairs % len(found)], n))
                rows, rare, times = (np.concatenate(x) for x in zip(*missed, strict=True))
                by = np.argsort(rows, kind="stable")
                ends = np.searchsorted(rows[by], np.arange(len(texts) + 1))
                columns = [batch.column(c).slice(a, b - a) for c in [*extra, row, model]]
                columns += [lists(sums.ravel(), np.arange(len(texts) + 1) * width), pa.array(length)]
                columns += [lists(rare[by].view(np.int64), ends), lists(times[by], ends)]
                yield pa.RecordBatch.from_arrays(columns, names=[*extra, row, model, *own])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name in extra) + f"`{row}` long, `{model}` int, "
    schema += ", ".join(f"`{c}` {kind}" for c, kind in zip(own, ("array<long>", "long", "array<long>", "array<long>"), strict=True))
    numbered = docs.select(*dict.fromkeys([*extra, "text"]), F.monotonically_increasing_id().alias(row), F.coalesce(without + 1, F.lit(0)).alias(model))
    rows = st.save(numbered.mapInArrow(run, schema), "sums")
    sums, n, rare, times = [F.col(f"`{c}`") for c in own]
    left = [names[c] for c in ("lang_pred", "score", "cross_entropy", "size_class")]
    if not width:
        found = [F.lit("und"), F.lit(0.0), F.lit(None).cast("double")]
    else:
        each = rows.where(F.size(rare) > 0).select(row, (F.col(f"`{model}`") * width).alias("first"), rare.alias("gram"), times.alias("times"))
        each = each.select(row, "first", F.explode(F.arrays_zip("gram", "times")).alias("each")).select(row, "first", "each.*")
        logs_met = F.array(*[f"q{i}" for i in range(len(logs))])
        share = [F.sum(F.col("times") * F.element_at(logs_met, F.col("first") + (i + 1))).alias(f"q{i}") for i in range(width)]
        shares = each.join(learnt.rare, "gram").groupBy(row).agg(*share)
        shares = st.save(shares.select(row, F.array(*[f"q{i}" for i in range(width)]).alias(names["shares"])), "rare-sums")
        rows = rows.join(shares, row, "left")
        more = F.col(f"`{names['shares']}`")
        sums = F.when(more.isNull(), sums).otherwise(F.zip_with(sums, more, lambda x, y: x + y))
        rows = rows.withColumn(names["sums"], sums).withColumn(names["most"], F.array_max(F.col(own[0])))
        sums, most = F.col(f"`{own[0]}`"), F.col(f"`{names['most']}`")
        best = F.element_at(F.array(*[F.lit(x) for x in learnt.languages]), F.array_position(sums, most).cast("int"))
        odds = F.aggregate(sums, F.lit(0.0), lambda total, x: total + F.exp((x - most) / UNIT / n * F.least(n, F.lit(200))))
        found = [F.when(n > 0, best).otherwise("und"), F.when(n > 0, 1 / odds).otherwise(0.0), F.when(n > 0, -most / UNIT / n)]
    shown = [F.col(f"`{c}`") for c in extra]
    return rows.select(*shown, *[x.alias(c) for x, c in zip([*found, F.floor(F.log2(n + 1))], left, strict=True)])


def _limits(texts: GroupedData, name: str, least: int) -> DataFrame:
    quarters = F.percentile_approx("cross_entropy", [0.25, 0.5, 0.75], 1000)
    found = texts.agg(F.count("*").alias("n"), quarters.alias("q")).where(F.col("n") >= least)
    spread = F.greatest((F.col("q")[2] - F.col("q")[0]) / 1.35, F.lit(LEAST_SPREAD))
    return found.withColumn(name, F.col("q")[1] + REJECT_AT * spread).drop("n", "q")


_COLUMNS = ("lang_pred", "score", "cross_entropy", "n_units", "size_class", "class_limit", "limit", "any_limit", "rejected")
_COLUMNS += ("row", "model", "sums", "rare", "times", "shares", "most")


def result_names(columns: list[str]) -> dict[str, str]:
    """The names of the result's columns beside ``columns``: their own, or with underscores before where one is taken."""
    names: dict[str, str] = {}
    for c in _COLUMNS:
        names[c] = unused(c, [*columns, *names.values()])
    return names


def identify(docs: DataFrame, training: DataFrame, keep_text: bool = False, texts: int | None = None, among: Column | None = None) -> DataFrame:
    """A row per document: doc_id, lang_pred, score (posterior, 0 to 1), cross_entropy, rejected, and the other columns
    of ``docs``; text and lang only if ``keep_text``. Where ``docs`` has a column of such a name, see ``result_names``.

    lang_pred is ``und`` with score 0, and rejected, where the text is null or has no letter, or where no language was learnt.
    Equal cross-entropies go to the language first by code point. Repeated rows get equal results. All labelled texts of ``training`` are
    learnt from, or the ``sample`` of so many ``texts``. ``among`` tells which rows of ``docs`` are rows of ``training``, by default
    none or, if both are one, all."""
    spark = docs.sparkSession
    with Stages(spark) as st:
        taught = training if texts is None else sample(st, training, texts)
        its_fold = F.when(F.col("lang").isNotNull() & F.col("text").isNotNull(), fold(F.col("text")))
        rows = taught.select("text", "lang")
        if taught is not docs:  # else its rows are those to be judged as well
            rows = rows.union(docs.select("text", F.lit(None).cast("string")))
        learnt = learn(st, rows.withColumn("fold", its_fold))
        extra = [c for c in docs.columns if keep_text or c not in ("text", "lang")]
        names = result_names(extra)
        its_fold = learnt.folds_without(F.col("lang"), its_fold)
        if among is None:
            among = F.lit(training is docs)
        rows = _scored(st, docs, learnt, F.when(among, its_fold) if "lang" in docs.columns else F.lit(None).cast("int"), extra, names)
        # Limits by labelled texts that their models have not seen, under their own language's name.
        plain = {c: c for c in _COLUMNS}
        own = _scored(st, taught.where(its_fold == 0), learnt, its_fold, ["lang"], plain)
        own = st.save(own.where("cross_entropy is not null and lang_pred = lang").select("lang_pred", "size_class", "cross_entropy"), "held-out")
        classes = _limits(own.groupBy("lang_pred", "size_class"), "class_limit", REJECT_LEAST).withColumnsRenamed(names)
        whole = _limits(own.groupBy("lang_pred"), "limit", REJECT_LEAST_LANGUAGE).withColumnsRenamed(names)
        every = _limits(own.groupBy(), "any_limit", 1).withColumnsRenamed(names)
        # A row per language, or per language and power of two of the length, or one.
        out = rows.join(F.broadcast(st.save(classes, "limits")), [names["lang_pred"], names["size_class"]], "left")
        out = out.join(F.broadcast(st.save(whole, "limits")), names["lang_pred"], "left").join(F.broadcast(st.save(every, "limits")), F.lit(True), "left")
        limit = F.coalesce(*[F.col(f"`{names[c]}`") for c in ("class_limit", "limit", "any_limit")])
        entropy = F.col(f"`{names['cross_entropy']}`")
        rejected = entropy.isNull() | F.coalesce(entropy > limit, F.lit(False))
        shown = [*extra, *[names[c] for c in ("lang_pred", "score", "cross_entropy")]]
        return st.save(out.select(*[F.col(f"`{c}`") for c in shown], rejected.alias(names["rejected"])), "languages", keep=True)
