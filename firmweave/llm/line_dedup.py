"""Fuzzy duplicate lines by SimHash.

A line is normalised (case, punctuation, digits to 0) and lines with one digest are one class. Each class has a 64-bit
SimHash of its words, weighted by their lengths, so that the short words which all lines of a language share do not make them alike.
The SimHash is cut into BLOCKS blocks; classes of like length that share one are candidates, and by the pigeonhole principle that is
every pair within BLOCKS - 1 bits. Blocks are long, since lines that meet by chance grow with the square of all lines. A tenth of a line's
characters moves more bits than blocks can bear, so most pairs are met
by their text: longer lines by the least of their runs of words, lines under SHORT characters by pieces of characters.
Candidates within a wider distance are linked if the edit similarity of the normalised lines is at least the threshold. Shorter lines
also have the parities of their pairs of neighbouring characters, of which an edit changes four at most, so that few of the
candidates that have nothing in common but a key have to be compared.
Of every connected group of classes the earliest line stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave.llm.common import Stages, mix64, text_chunks, unused, word_hashes, word_spans
from firmweave.llm.edits import within
from firmweave.llm.linking import SMALL, components, find_links

SIMILARITY = 0.9
#: Blocks of a SimHash: all pairs within BLOCKS - 1 bits share one.
BLOCKS = 2
#: Bits within which a candidate's text is compared, by the longer line's characters: below the bound, so many.
DISTANCES = ((40, 64), (80, 26))
DISTANCE = 14
#: Lengths of a class of lengths differ by less than this factor; a line is looked up in its own and, near the edge, in the next one.
SIZE_STEP = 1.6
#: Words of a run: RUN, or so many more, up to RUN_MOST, that it has RUN_BYTES, as runs of short words are in any line.
RUN = 2
RUN_MOST = 6
RUN_BYTES = 16
#: Runs (the least in each of so many parts of all hashes) by which a line is met; up to ALL_RUNS words, by all of them.
RUN_KEYS = 6
ALL_RUNS = 8
#: Lines of fewer characters have keys by pieces of characters, such that no pair within a tenth of the longer one is missed.
SHORT = 40
#: Lines of fewer characters have parities; those of longer ones are as different by chance as they may be by edits.
PARITIES = 80
#: Classes of a chunk, about, where what is left of a large bucket is compared.
CHUNK = 2048
#: Rows of a chunk that are held against another chunk, and candidates that are compared together, about.
BLOCK = 256
PENDING = 50_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_GAPS = re.compile(r"[\W_]+")
_TEXT_GAPS = re.compile(r"(?:[^\w\n]|_)+")
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
#: Lower case, digits to 0, anything but letters, digits and line breaks to a blank, for texts of Latin-1 characters.
_LATIN = "".join("\n" if c == "\n" else "0" if c in "123456789" else c.lower() if c.isalnum() else " " for c in map(chr, range(256))).encode("latin-1")


def normal_line(line: str) -> bytes:
    return _GAPS.sub(" ", line.lower()).strip().encode().translate(_DIGITS)


def normal_lines(text: str) -> list[bytes]:
    """``normal_line`` of every line of a text."""
    try:
        lines = text.encode("latin-1").translate(_LATIN).split(b"\n")
    except UnicodeEncodeError:
        return [x.strip() for x in _TEXT_GAPS.sub(" ", text.lower()).encode().translate(_DIGITS).split(b"\n")]
    lines = [b" ".join(x.split(b" ")) if b"  " not in x else b" ".join(filter(None, x.split(b" "))) for x in lines]
    return [(x if x.isascii() else x.decode("latin-1").encode()).strip(b" ") for x in lines]


def simhashes(lines: list[bytes]) -> np.ndarray:
    """64-bit SimHash of each line's words, weighted by their bytes; a tie of a bit is 0, as for a line without words."""
    return _hashed(lines)[0]


def _hashed(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """SimHashes, and the keys by runs of words: line numbers and keys."""
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lines], dtype=np.int64)))
    data = np.frombuffer(b"".join(lines), np.uint8)
    starts, ends, first = word_spans(data, offsets)
    out = np.zeros(len(lines), np.uint64)
    full = np.flatnonzero(np.diff(first))
    if not len(full):
        return out, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = word_hashes(data, starts, ends)
    kinds, at, word = np.unique(words, return_index=True, return_inverse=True)
    sizes = ends[at] - starts[at]
    bits = np.unpackbits(mix64(kinds + _STEP).view(np.uint8).reshape(-1, 8), axis=1)
    of_word = bits * np.minimum(sizes, 65535).astype(np.uint16)[:, None]
    # Sums of 64 lengths, four to a machine word.
    weights = np.add.reduceat(sizes[word], first[full])
    ones = np.add.reduceat(of_word.view(np.uint64)[word], first[full], axis=0).view(np.uint16).astype(np.int64)
    for i in np.flatnonzero(weights > 65535):  # more than four sums to a machine word can hold
        a, b = first[full[i]], first[full[i] + 1]
        ones[i] = sum((bits[word[c : min(c + 10_000, b)]] * sizes[word[c : min(c + 10_000, b)], None]).sum(0) for c in range(a, b, 10_000))
    out[full] = np.packbits(2 * ones > weights[:, None], axis=1).view(np.uint64).reshape(-1)
    # Runs of words of one line; a line without one is one run of what it has.
    counts = np.diff(first)[full]
    size, line = np.repeat(counts, counts), np.repeat(full, counts)
    left = np.repeat(first[1:][full], counts) - np.arange(len(words))
    none = np.uint64(2**64 - 1)
    run, own = words.copy(), ends - starts
    letters, whole = own.copy(), np.zeros(len(words), bool)
    for k in range(1, RUN_MOST):
        at = np.flatnonzero(~whole & (left > k))
        run[at] = mix64(run[at]) + words[at + k]
        letters[at] += own[at + k]
        if k + 1 >= RUN:
            whole[at] = letters[at] >= RUN_BYTES
    whole |= left >= RUN_MOST
    whole |= (left == size) & ~np.repeat(np.logical_or.reduceat(whole, first[full]), counts)
    run = mix64(run + _STEP)
    every = whole & (size <= ALL_RUNS)
    numbers, keys = [line[every]], [run[every]]
    part = run % np.uint64(RUN_KEYS)
    for k in range(RUN_KEYS):
        least = np.minimum.reduceat(np.where(whole & (part == k), run, none), first[full])
        has = (least != none) & (counts > ALL_RUNS)
        numbers.append(full[has])
        keys.append(least[has])
    return out, np.concatenate(numbers), np.concatenate(keys)


def _pieces(line: str) -> Iterator[int]:
    """Keys of a short line, such that two lines within a tenth of the longer one's characters share one.

    With one edit each line without one of its characters, else the longer line's pieces, one more than edits, of which one
    is whole in the other line, not far from its place."""

    def key(kind: int, part: str) -> int:
        return xxhash.xxh3_64_intdigest(part, kind)

    size = len(line)
    if 9 <= size < 20:
        yield key(0, line)
        yield from (key(0, line[:i] + line[i + 1 :]) for i in range(size))
    for long in range(max(size, 20), min(size + 3, SHORT - 1) + 1):
        most, shift = long // 10, size - long
        if -shift > most:
            continue
        edges = [long * i // (most + 1) for i in range(most + 2)]
        for i in range(most + 1):
            a, n = edges[i], edges[i + 1] - edges[i]
            for p in range(max(0, a - i, a + shift - (most - i)), min(size - n, a + i, a + shift + most - i) + 1):
                yield key(100 * long + i, line[p : p + n])


def text_keys(lines: list[bytes]) -> list[list[int]]:
    """The distinct keys of each normalised line that are made of its text."""
    return _key_lists([x.decode() for x in lines], *_hashed(lines)[1:]).to_pylist()


def _key_lists(lines: list[str], numbers: np.ndarray, keys: np.ndarray) -> pa.Array:
    """Run keys of the lines that are not too short for them, and the pieces of short lines, as a list per line."""
    sizes = np.array([len(x) for x in lines], np.int64)
    has = sizes[numbers] >= SHORT * 9 // 10
    short, own = [], []
    for i in np.flatnonzero(sizes < SHORT).tolist():
        found = list(_pieces(lines[i]))
        short += [i] * len(found)
        own += found
    numbers = np.concatenate((numbers[has], np.array(short, np.int64)))
    keys = np.concatenate((keys[has], np.array(own, np.uint64)))
    by = np.lexsort((keys, numbers))
    numbers, keys = numbers[by], keys[by]
    if len(keys):
        fresh = np.concatenate(([True], (numbers[1:] != numbers[:-1]) | (keys[1:] != keys[:-1])))
        numbers, keys = numbers[fresh], keys[fresh]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(numbers, minlength=len(lines)))))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.view(np.int64), pa.int64()))


def size_classes(size: Column, similarity: float) -> Column:
    """The class of a length and that of the greatest length which may be similar to it: two similar lengths share one."""
    step = F.lit(float(np.log(SIZE_STEP)))
    return F.array_distinct(F.array(F.floor(F.log(size) / step), F.floor(F.log(size / similarity) / step)))


def block_keys(simhash: Column, size: Column, similarity: float = SIMILARITY) -> Column:
    """A key per block of the SimHash and class of lengths: within BLOCKS - 1 bits a pair of similar lengths shares one."""
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [F.shiftrightunsigned(simhash, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    named = F.array(*[b * BLOCKS + k for k, b in enumerate(blocks)])
    return F.flatten(F.transform(size_classes(size, similarity), lambda c: F.transform(named, lambda b: F.xxhash64(c, b))))


def parities(lines: list[str]) -> np.ndarray:
    """64 bits of each line of under PARITIES characters: which kinds of pairs of neighbouring characters it has an odd number of. Others: 0."""
    sizes = np.array([len(x) for x in lines], np.int64)
    out, own = np.zeros(len(lines), np.uint64), np.flatnonzero((sizes > 0) & (sizes < PARITIES))
    if len(own):
        codes = np.frombuffer("".join([lines[i] for i in own.tolist()]).encode("utf-32-le"), np.uint32).astype(np.uint64)
        ends = np.cumsum(sizes[own])
        bits = np.zeros(len(codes), np.uint64)
        bits[:-1] = np.uint64(1) << ((codes[:-1] << np.uint64(21) | codes[1:]) * _STEP >> np.uint64(58))
        bits[ends - 1] = 0
        out[own] = np.bitwise_xor.reduceat(bits, ends - sizes[own])
    return out


def _near(one: tuple[np.ndarray, ...], other: tuple[np.ndarray, ...], similarity: float) -> np.ndarray:
    """Whether lines may be similar by their SimHashes, lengths and parities."""
    (h1, n1, p1), (h2, n2, p2) = one, other
    longer = np.maximum(n1, n2)
    most = (1 - similarity) * longer + 1e-9
    bits = np.full(np.shape(longer), DISTANCE)
    for bound, distance in DISTANCES[::-1]:
        bits[longer < bound] = distance
    within = np.bitwise_count((h1 ^ h2).view(np.uint64)) <= bits
    within &= (longer >= PARITIES) | (np.bitwise_count((p1 ^ p2).view(np.uint64)) <= 4 * most.astype(np.int64))
    return (np.abs(n1 - n2) <= most) & within


def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All there is to know of every line, from one pass over the texts; what its class shares, of the class's first line in a chunk only."""
    for batch in batches:
        for a, b, _, _ in text_chunks(batch):
            at, number, own, classes = [], [], [], {}
            for i, text in enumerate(batch.column("text").slice(a, b - a).to_pylist(), a):
                if text:
                    for k, line in enumerate(normal_lines(text)):
                        if line:
                            at.append(i)
                            number.append(k)
                            own.append(classes.setdefault(line, len(classes)))
            lines, own = list(classes), np.array(own, np.int64)
            hashes, numbers, keys = _hashed(lines)
            texts = [x.decode() for x in lines]
            digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(x) for x in lines]), np.int64).reshape(-1, 2)[own]
            seen = np.ones(len(own), bool)
            seen[np.unique(own, return_index=True)[1]] = False
            known = pa.array(own, mask=seen)
            shared = (pa.array([len(x) for x in texts], pa.int32()), pa.array(hashes.view(np.int64)), pa.array(parities(texts).view(np.int64)), _key_lists(texts, numbers, keys), pa.array(texts, pa.string()))
            columns = [
                *batch.select(["row", "doc_id"]).take(pa.array(at, pa.int64())).columns, pa.array(number, pa.int32()),
                pa.array(digests[:, 0]), pa.array(digests[:, 1]), *[x.take(known) for x in shared],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "line_no", "id", "rest", "size", "simhash", "parity", "keys", "line"])


def _near_pairs(similarity: float):
    """Near pairs (a, b) of small buckets, all buckets of a batch at once: each item against the one 1, 2, 3 ... places on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column("items")
            sizes = np.diff(items.offsets.to_numpy())
            ids, *known = (items.flatten().field(k).to_numpy() for k in range(4))
            left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(ids))  # items of the bucket from here on
            for shift in range(1, int(sizes.max(initial=1))):
                i = np.flatnonzero(left > shift)
                j = i + shift
                i = i[_near([v[i] for v in known], [v[j] for v in known], similarity)]
                x, y = ids[i], ids[i + shift]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return run


def _first_met(keys: np.ndarray, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of rows share no key (a row of ``keys`` each, 0 where there is none) below the one under which they meet here."""
    out = np.zeros(len(a), bool)
    step = max(1, 4_000_000 // keys.shape[1] ** 2)
    for k in range(0, len(a), step):
        x, y = keys[a[k : k + step]], keys[b[k : k + step]]
        below = (x < key[a[k : k + step]][:, None]) & (x != 0)
        out[k : k + step] = ~((x[:, :, None] == y[:, None, :]) & below[:, :, None]).any((1, 2))
    return out


def _tied(similarity: float):
    """Links (a, b) that bring rows of different labels together, out of rows that are sorted by (key, i, j): left ones against right ones.

    Every pair that may be similar is compared unless other links tie its labels by then. So near copies of each other cost about
    a comparison each, the likeliest first, and the links are at most as many as the labels."""

    def compared(rows: pa.Table) -> pa.RecordBatch:
        key, i, j, id_, simhash, size, parity = (rows.column(c).to_numpy() for c in ("key", "i", "j", "id", "simhash", "size", "parity"))
        left, right = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right"))
        lines, known = rows.column("line").combine_chunks(), (simhash, size, parity)
        lists = rows.column("keys").combine_chunks()
        counts = np.diff(lists.offsets.to_numpy())
        keys = np.zeros((len(key), int(counts.max())), np.int64)
        keys[np.arange(keys.shape[1]) < counts[:, None]] = lists.flatten().to_numpy()
        labels, label = np.unique(rows.column("label").to_numpy(), return_inverse=True)
        root, links = np.arange(len(labels)), []

        def settle(a: np.ndarray, b: np.ndarray) -> None:
            nonlocal root
            by = np.lexsort((np.bitwise_count((simhash[a] ^ simhash[b]).view(np.uint64)), a))
            a, b, most = a[by], b[by], 1
            while len(a):
                apart = root[label[a]] != root[label[b]]
                a, b = a[apart], b[apart]
                rank = np.arange(len(a)) - np.searchsorted(a, a)
                x, y = a[rank < most], b[rank < most]
                a, b, most = a[rank >= most], b[rank >= most], 2 * most
                bound = ((1 - similarity) * np.maximum(size[x], size[y]) + 1e-9).astype(np.int64)
                near = within(lines.take(pa.array(x)).to_pylist(), lines.take(pa.array(y)).to_pylist(), bound)
                for p, q in zip(x[near].tolist(), y[near].tolist(), strict=True):
                    r, t = label[p], label[q]
                    while root[r] != r:
                        r = root[r]
                    while root[t] != t:
                        t = root[t]
                    if r != t:
                        root[max(r, t)] = min(r, t)
                        links.append((p, q))
                while (root[root] != root).any():
                    root = root[root]

        starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for start, end in zip(starts, np.append(starts[1:], len(key)), strict=True):
            ours, theirs = (start + np.flatnonzero(side[start:end]) for side in (left, right))
            for k in range(0, len(ours), BLOCK):
                x, y = ours[k : k + BLOCK, None], theirs[None]
                fits = (root[label[x]] != root[label[y]]) & ((x < y) | ~(right[x] & left[y]))
                fits &= _near([v[x] for v in known], [v[y] for v in known], similarity)
                a, b = np.nonzero(fits)
                a, b = ours[k : k + BLOCK][a], theirs[b]
                first = _first_met(keys, key, a, b)
                held.append((a[first], b[first]))
                if sum(len(v) for v, _ in held) >= PENDING:
                    settle(*(np.concatenate(v) for v in zip(*held, strict=True)))
                    held = []
        if held:
            settle(*(np.concatenate(v) for v in zip(*held, strict=True)))
        a, b = (id_[np.array([link[c] for link in links], np.int64)] for c in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if kept is None else [*kept.to_batches(), batch])
            if not rows.num_rows:
                continue
            # The last group may go on in the next batch.
            other = np.zeros(rows.num_rows, bool)
            for c in ("key", "i", "j"):
                value = rows.column(c).to_numpy()
                other |= value != value[-1]
            last = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if last:
                yield compared(rows.slice(0, last))
            kept = rows.slice(last)
        if kept is not None and kept.num_rows:
            yield compared(kept)

    return run


def _similar(similarity: float):
    """The pairs whose lines are similar by edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("la").to_pylist(), batch.column("lb").to_pylist()
            longer = np.array([max(len(x), len(y)) for x, y in zip(left, right, strict=True)], np.int64)
            near = within(left, right, ((1 - similarity) * longer + 1e-9).astype(np.int64))
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def removed_lines(docs: DataFrame, similarity: float = SIMILARITY, row: str = "row") -> DataFrame:
    """A row per line to remove: row, doc_id, line_no, kept_doc_id, kept_line_no, occurrences (lines of the group).

    If ``docs`` has a long column of the name ``row`` it numbers its rows; else rows are numbered as they are read. The kept
    line is the earliest of the group by doc_id (null last), row and place. Lines without letters or digits, null and
    empty texts take no part."""
    spark = docs.sparkSession
    with Stages(spark) as st:
        numbered = dict(docs.dtypes).get(row) == "bigint"
        texts = docs.select((F.col(row) if numbered else F.monotonically_increasing_id()).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
        # A class goes by the first half of its digest; lines that are not linked to others are told apart by both halves.
        schema = "row long, doc_id long, line_no int, id long, rest long, size int, simhash long, parity long, keys array<long>, line string"
        lines = st.save(texts.mapInArrow(_classed, schema), "lines")
        firsts = lines.where("size is not null")
        # Keys are shuffled once, for their counts and for the rows of those that two classes have.
        keyed = firsts.select("id", F.explode(F.concat(block_keys(F.col("simhash"), F.col("size"), similarity), "keys")).alias("key")).repartition("key")
        met = keyed.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("key")
        shared = st.save(keyed.join(met.hint("shuffle_hash"), "key").select("key", "id").distinct(), "shared")
        held = firsts.select("id", "size", "simhash", "parity").join(shared.select("id").distinct(), "id").dropDuplicates(["id"])
        held = st.save(held, "candidates")
        counted = st.save(shared.join(shared.groupBy("key").agg(F.count("*").alias("k")), "key"), "counted")
        # A small bucket is a row; a large one stays as rows, since a key may be in any share of all lines.
        few = counted.where(f"k <= {SMALL}").join(held, "id").groupBy("key").agg(F.collect_list(F.struct("id", "simhash", "size", "parity")).alias("items"))
        near = st.save(few.select("items").mapInArrow(_near_pairs(similarity), "a long, b long").distinct(), "near")
        large = counted.where(f"k > {SMALL}").select("key", "id")
        members = near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).unionByName(large.select("id")).distinct()
        words = firsts.select("id", "line").join(st.save(members, "members"), "id").dropDuplicates(["id"])
        words = st.save(words, "candidate-lines")

        def test(pairs: DataFrame) -> DataFrame:
            """The pairs (a, b) whose lines are similar."""
            full = pairs.join(words.toDF("a", "la"), "a").join(words.toDF("b", "lb"), "b")
            return full.select("a", "b", "la", "lb").mapInArrow(_similar(similarity), "a long, b long")

        def close(pairs: DataFrame) -> DataFrame:
            """The same of pairs that are not known to be near."""
            hashes = held.select("id", "size", "simhash", "parity")
            longer = F.greatest("na", "nb")
            edits = (1 - similarity) * longer + 1e-9
            within = F.abs(F.col("na") - F.col("nb")) <= edits
            most = F.lit(DISTANCE)
            for bound, distance in DISTANCES[::-1]:
                most = F.when(longer < bound, distance).otherwise(most)
            bits = F.bit_count(F.col("ha").bitwiseXOR(F.col("hb"))) <= most
            odd = (longer >= PARITIES) | (F.bit_count(F.col("pa").bitwiseXOR(F.col("pb"))) <= 4 * F.floor(edits))
            pairs = pairs.join(hashes.toDF("a", "na", "ha", "pa"), "a").join(hashes.toDF("b", "nb", "hb", "pb"), "b").where(within & bits & odd).select("a", "b")
            return test(st.save(pairs, "within"))

        def chunked(rows: DataFrame) -> DataFrame:
            """Links between rows of one key that differ in label. The rows that are not main are cut into chunks, and so are the main ones; each chunk of
            the first meets itself, those before it and all of the second, unless all rows of a key are few enough to meet at once."""
            sizes = rows.groupBy("key").agg(*[F.greatest(F.ceil(F.count(F.when(c, 1)) / CHUNK), F.lit(1)).cast("int").alias(n) for c, n in ((~F.col("main"), "odd"), (F.col("main"), "most"))], (F.count("*") <= CHUNK).alias("once"))
            known = rows.groupBy("id").agg(F.collect_set("key").alias("keys"))
            items = rows.join(st.save(sizes, "chunks"), "key")
            items = items.withColumn("own", F.pmod(F.xxhash64("id", F.lit(7)), F.when(F.col("main"), F.col("most")).otherwise(F.col("odd"))).cast("int"))
            meets = F.expr(
                """case when once then array(struct(0 as i, 0 as j, not main as left, true as right))
                when main then transform(sequence(0, odd - 1), i -> struct(i, -1 - own as j, false as left, true as right))
                else concat(transform(sequence(0, odd - 1), o -> struct(greatest(own, o) as i, least(own, o) as j, own >= o as left, own <= o as right)),
                    transform(sequence(1, most), m -> struct(own as i, -m as j, true as left, false as right))) end"""
            )
            items = items.select("key", "id", "label", F.explode(meets).alias("m")).select("key", "m.*", "id", "label")
            items = items.join(held.select("id", "size", "simhash", "parity"), "id").join(known, "id").join(words, "id")
            return items.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_tied(similarity), "a long, b long")

        # First each class with one near one; then what is still apart.
        one = st.save(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "one-near")
        links = st.save(test(one), "links")
        labels = st.save(components(st, links), "labels")
        la, lb = (labels.toDF(c, f"label_{c}") for c in "ab")
        apart = near.join(la, "a", "left").join(lb, "b", "left").where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")
        links = links.unionByName(st.save(test(apart.join(one, ["a", "b"], "left_anti")), "links"))
        others = find_links(st, large, close, chunked)
        groups = components(st, links if others is None else links.unionByName(others))
        named = lines.select("row", "doc_id", "line_no", "id", "rest").join(groups, "id", "left").withColumn("rest", F.when(F.col("label").isNull(), F.col("rest")))
        named = named.select("row", "doc_id", "line_no", F.coalesce("label", "id").alias("label"), F.coalesce("rest", F.lit(0)).alias("rest"))
        named = st.save(named, "named")
        several = named.groupBy("label", "rest").agg(F.count("*").alias("occurrences")).where("occurrences > 1")
        repeated = st.save(named.join(several, ["label", "rest"]), "repeated")
        place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "line_no")
        out = repeated.join(repeated.groupBy("label", "rest").agg(F.min(place).alias("m")), ["label", "rest"])
        out = out.where("row <> m.row or line_no <> m.line_no")
        number = F.col("line_no").cast("long").alias("line_no")
        return st.save(
            out.select("row", "doc_id", number, F.col("m.doc_id").alias("kept_doc_id"), F.col("m.line_no").cast("long").alias("kept_line_no"), "occurrences"),
            "removed-lines",
            keep=True,
        )


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, each without the lines to remove; the other columns as they are, but for n_chars if there is one.

    A document may be left with an empty text; it stays a row."""
    row = unused("row", docs.columns)
    with Stages(docs.sparkSession) as st:
        rows = st.save(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
        found = removed_lines(rows, similarity, row)
        gone = unused("gone", [*docs.columns, row])
        numbers = found.groupBy(F.col("row").alias(row)).agg(F.collect_list("line_no").alias(gone))  # bounded by the document
        names = [c for c in docs.columns if c != "text"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for text, numbers in zip(batch.column("text"), batch.column(gone), strict=True):
                    text, numbers = text.as_py(), numbers.as_py()
                    if text and numbers:
                        numbers = set(numbers)
                        text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in numbers)
                    out.append(text)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(out, pa.string())], names=[*names, "text"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
        # The texts are shuffled at any size, so that what is moved grows with them alone, and are not sorted.
        out = rows.join(st.save(numbers, "gone").hint("shuffle_hash"), row, "left").select(*names, "text", gone).mapInArrow(run, f"{schema}, text string")
        if "n_chars" in docs.columns:
            out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
        return st.save(out.select(docs.columns), "line-deduplicated", keep=True)
