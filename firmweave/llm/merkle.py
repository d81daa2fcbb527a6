"""A Merkle manifest of a dataset: a digest per row, a tree of them per source, a tree of the sources, and a proof per row.

Rows are put in order by one range shuffle and numbered within their source. A block is an aligned run of FANOUT ** BLOCK_LEVELS
leaves and makes its own subtree inside one task. Blocks then exchange what they hold, butterfly fashion: in each round
every block meets the holders of the (at most FANOUT) neighbouring nodes below the same parent, one holder per node, takes
their digests as a step of its proof, and hashes the parent itself, as all of them do. After one round per level each block holds
the root and its whole upper proof, without a pass back down. No task ever holds more than a block or FANOUT messages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmweave.llm.common import Stages

FANOUT = 16
#: A block has FANOUT to this power leaves.
BLOCK_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_STEPS = "array<struct<left:string,right:string>>"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value; numbers in decimals."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(x) for x in fields]), 256)


def fold(digest: str, steps: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf's digest and its proof, (left, right) siblings per level, lead to."""
    for left, right in steps:
        digest = sha(left + digest + right)
    return digest


def subtree(leaves: list[str], whole: bool, block_levels: int = BLOCK_LEVELS) -> list[list[str]]:
    """Nodes level by level, the leaves first. The ``whole`` tree ends in one node; a block of a larger one has ``block_levels`` levels above."""
    levels = [leaves]
    while len(levels[-1]) > 1 if whole else len(levels) <= block_levels:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return levels


def _siblings(level: list[str], i: int) -> tuple[str, str]:
    first = i // FANOUT * FANOUT
    return "".join(level[first:i]), "".join(level[i + 1 : first + FANOUT])


def _roots(block_levels: int) -> Task:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["source_no", "block", "blocks"]
        for batch in batches:
            items, blocks = batch.column("items"), batch.column("blocks").to_pylist()
            out = [subtree(items[r].values.field("leaf").to_pylist(), blocks[r] == 1, block_levels)[-1][0] for r in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(out, pa.string())], names=[*names, "digest"])

    return run


def _proved(block_levels: int) -> Task:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per leaf: what the block's own levels and its upper steps say of it."""
        for batch in batches:
            for r in range(batch.num_rows):
                items, blocks, upper, subroot, root = (batch.column(c)[r].as_py() for c in ("items", "blocks", "steps", "subroot", "root"))
                upper = [(s["left"], s["right"]) for s in upper]
                levels = subtree([x["leaf"] for x in items], blocks == 1, block_levels)
                # From the top down, each node's proof text and the root it folds to.
                tails = [["".join(a + b for a, b in upper)]]
                folded = [[fold(levels[-1][0], upper)]]
                for k in range(len(levels) - 2, 0, -1):
                    steps = [_siblings(levels[k], i) for i in range(len(levels[k]))]
                    tails.append([a + b + tails[-1][i // FANOUT] for i, (a, b) in enumerate(steps)])
                    ups = [sha(a + x + b) for x, (a, b) in zip(levels[k], steps, strict=True)]
                    folded.append([folded[-1][i // FANOUT] if up == levels[k + 1][i // FANOUT] else "" for i, up in enumerate(ups)])
                rows = []
                for i, item in enumerate(items):
                    if len(levels) == 1:
                        left = right = ""
                        own, proof = [], tails[0][0]
                    else:
                        left, right = _siblings(levels[0], i)
                        own, proof = [(left, right)], left + right + tails[-1][i // FANOUT]
                    seen = item["seen"] or item["leaf"]
                    up = sha(left + seen + right) if own else seen
                    if own and up == levels[1][i // FANOUT]:
                        found = folded[-1][i // FANOUT]
                    else:  # another leaf than the tree was made of: all the way up
                        k = i // FANOUT
                        for level in levels[1:-1]:
                            a, b = _siblings(level, k)
                            up, k = sha(a + up + b), k // FANOUT
                        found = fold(up, upper)
                    rows.append((item["doc_id"], item["leaf"], sha(proof), found))
                ids, leaves, proofs, found = zip(*rows, strict=True)
                n = len(rows)
                columns = [pa.array(ids, pa.int64()), pa.array(leaves), pa.array([subroot] * n), pa.array([root] * n), pa.array(proofs), pa.array(found), pa.array([x == root for x in found])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return run


def placed(st: Stages, leaves: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, seen) with source_no, the source's place (null first, by bytes), its number of leaves ``total``
    and the leaf's ``place`` in it, without a window over the rows of a source.

    One range shuffle puts all rows in order; the rows of a source in each partition are a span, and only spans (as many as
    partitions and sources together) are added up. Equal rows are dealt by their row number, so they cannot all meet in one task."""
    rows = leaves.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    order = ["source", "doc_id", "leaf", "seen", "tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    rows = st.save(rows.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "ordered")
    spans = st.save(rows.groupBy("part", "source").agg(F.min("at").alias("first"), F.count("*").alias("n")), "spans")
    by_part = Window.partitionBy("source").orderBy("part")
    before = F.coalesce(F.sum("n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.withColumn("before", before).withColumn("total", F.sum("n").over(Window.partitionBy("source")))
    spans = st.save(spans.withColumn("starts", (F.col("before") == 0).cast("long")), "spans")
    parts = spans.groupBy("part").agg(F.sum("starts").alias("starts"))  # a row per partition
    earlier = F.coalesce(F.sum("starts").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("part").alias("p"), earlier.alias("earlier"))
    upto = F.sum("starts").over(Window.partitionBy("part").orderBy("source").rowsBetween(Window.unboundedPreceding, 0))
    spans = spans.withColumn("upto", upto).join(parts, F.col("part") == F.col("p"))
    spans = spans.select(F.col("part").alias("p"), F.col("source").alias("s"), "first", "before", "total", (F.col("earlier") + F.col("upto") - 1).alias("source_no"))
    met = rows.join(st.save(spans, "spans"), (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    return met.select("doc_id", "leaf", "seen", "source_no", "total", (F.col("at") - F.col("first") + F.col("before")).alias("place"))


def exchange(st: Stages, parts: DataFrame) -> DataFrame:
    """One round: every holder of a node of a tree that has more than one node on its level gets the parent and a step of its proof.

    ``parts``: source_no, block (the holder); tree, pos (its node), lane of holders (0 to holders - 1, those of one node), width (nodes on the
    level), digest, steps. A node with fewer holders than another below the same parent speaks to several lanes."""
    busy = parts.where("width > 1").withColumn("parent", F.expr(f"pos div {FANOUT}"))
    nodes = busy.where("lane = 0").groupBy("tree", "parent").agg(
        F.max("holders").alias("most"), F.collect_list(F.struct("pos", "holders")).alias("nodes")
    )
    sent = busy.join(nodes, ["tree", "parent"]).withColumn("to", F.explode(F.sequence(F.col("lane"), F.col("most") - 1, F.col("holders"))))
    home = F.when(F.col("to") == F.col("lane"), F.struct("source_no", "block", "lane", "holders", "width", "nodes", "steps"))
    met = sent.select("tree", "parent", "to", F.struct("pos", "digest", home.alias("home")).alias("m"))
    met = met.groupBy("tree", "parent", "to").agg(F.array_sort(F.collect_list("m"), _by_pos).alias("ms"))  # FANOUT messages at most
    met = met.withColumn("digest", F.sha2(F.concat_ws("", F.transform("ms", lambda m: m["digest"])), 256)).withColumn("m", F.explode("ms")).where("m.home is not null")
    side = {
        name: F.concat_ws("", F.transform(F.filter("ms", keep), lambda m: m["digest"]))
        for name, keep in (("left", lambda m: m["pos"] < F.col("m.pos")), ("right", lambda m: m["pos"] > F.col("m.pos")))
    }
    step = F.struct(side["left"].alias("left"), side["right"].alias("right"))
    added = F.aggregate(F.filter("m.home.nodes", lambda n: n["pos"] < F.col("m.pos")), F.lit(0).cast("long"), lambda a, n: a + n["holders"])
    every = F.aggregate("m.home.nodes", F.lit(0).cast("long"), lambda a, n: a + n["holders"])
    after = met.select(
        "m.home.source_no", "m.home.block", "tree", F.col("parent").alias("pos"), (F.col("m.home.lane") + added).alias("lane"), every.alias("holders"),
        F.expr(f"(m.home.width + {FANOUT - 1}) div {FANOUT}").alias("width"), "digest", F.concat("m.home.steps", F.array(step)).cast(_STEPS).alias("steps"),
    )
    rest = [c for c in parts.columns if c not in after.columns]
    if rest:  # what the holder knew before
        after = after.join(parts.select("source_no", "block", *rest), ["source_no", "block"])
    return st.save(after.select(parts.columns).unionByName(parts.where("width <= 1")), "exchange")


def _by_pos(a: Column, b: Column) -> Column:
    return F.when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0)


def _rounds(width: int) -> int:
    n = 0
    while width > 1:
        width, n = -(-width // FANOUT), n + 1
    return n


def climb(st: Stages, parts: DataFrame) -> DataFrame:
    """Rounds until every tree has one node."""
    width = parts.agg(F.max("width")).head()[0] or 0  # one number
    for _ in range(_rounds(width)):
        parts = exchange(st, parts)
    return parts


def manifest(docs: DataFrame, seen: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """A row per row of ``docs``: doc_id, leaf, subroot (of its source), root, proof_sha256, folded_root, verified.

    ``seen`` gives other values for some fields, as a reader finds them now: folded_root starts from their digest, and
    verified tells whether it still leads to the root. Without it the rows themselves are verified. ``fields`` go into the digest in that order;
    doc_id, source and they must be columns, others play no part. Rows of a source are ordered by doc_id (null first), then by
    digest, so repeated rows are leaves of their own and reruns agree. An empty table has no rows and no root."""
    spark = docs.sparkSession
    values = {c: F.col(c) for c in fields}
    leaf = leaf_digest(list(values.values()))
    if seen:
        now = leaf_digest(list((values | seen).values()))
        changed = F.lit(False)
        for name, value in seen.items():
            changed = changed | ~value.eqNullSafe(values[name])
        now = F.when(changed, now)
    else:
        now = F.lit(None).cast("string")
    with Stages(spark) as st:
        leaves = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"), now.alias("seen"))
        size = FANOUT**block_levels
        rows = placed(st, st.save(leaves, "leaves"))
        rows = rows.withColumn("block", F.expr(f"place div {size}")).withColumn("blocks", F.expr(f"(total + {size - 1}) div {size}"))
        items = F.array_sort(F.collect_list(F.struct("place", "doc_id", "leaf", "seen"))).alias("items")  # a block's at most
        blocks = st.save(rows.groupBy("source_no", "block", "blocks").agg(items), "blocks")
        few = blocks.select("source_no", "block", "blocks", "items")
        roots = few.mapInArrow(_roots(block_levels), "source_no long, block long, blocks long, digest string")
        zero = F.lit(0).cast("long")
        parts = roots.select(
            "source_no", "block", F.col("source_no").alias("tree"), F.col("block").alias("pos"), zero.alias("lane"), F.lit(1).cast("long").alias("holders"),
            F.col("blocks").alias("width"), "digest", F.array().cast(_STEPS).alias("steps"),
        )
        parts = climb(st, st.save(parts, "block-roots"))
        sources = (parts.agg(F.max("source_no")).head()[0] or 0) + 1
        parts = parts.withColumns({"subroot": F.col("digest"), "tree": zero, "pos": F.col("source_no"), "width": F.lit(sources).cast("long")})
        parts = climb(st, parts).select("source_no", "block", "steps", "subroot", F.col("digest").alias("root"))
        proved = blocks.join(parts, ["source_no", "block"]).select("items", "blocks", "steps", "subroot", "root")
        schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return st.save(proved.mapInArrow(_proved(block_levels), schema), "manifest", keep=True)


def tampered_text() -> Column:
    """The text with A-Z in lower case where 5 divides the crc32 of the doc_id in decimals."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def _sql_level(name: str, below: str, key: str, out: str) -> str:
    """From nodes (key, i, h) the runs (key, p, l, alone) and the next level's nodes."""
    return f"""
{name} AS (
  SELECT {key}, i // {FANOUT} AS p, list(h ORDER BY i) AS l, any_value(c) = 1 AS alone
  FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS c FROM {below}) GROUP BY {key}, i // {FANOUT}
), {out} AS (SELECT {key}, p AS i, CASE WHEN alone THEN l[1] ELSE sha256(array_to_string(l, '')) END AS h FROM {name}),"""


def _sql() -> str:
    """The same over DuckDB's ``documents``, for unique doc_ids, up to FANOUT ** 5 of a source and FANOUT ** 3 sources."""
    depth, top = 5, 3
    text = "CASE WHEN crc % 5 = 0 THEN translate(text, '" + UPPER + "', '" + LOWER + "') ELSE text END"

    def digest(last: str) -> str:
        values = [f"CAST({c} AS VARCHAR)" for c in FIELDS[:-1]] + [last]
        return "sha256(concat(" + ", ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE concat(strlen({v}), ':', {v}) END" for v in values) + "))"

    parts = [
        f"""WITH bits AS (
  SELECT list(list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY x) AS t
  FROM range(256) r(x)
), coded AS (
  SELECT documents.*, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
  FROM documents, bits
), leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
    {digest("text")} AS h, {digest(f"({text})")} AS seen
  FROM coded
),"""
    ]
    below = "leaves"
    for k in range(depth):
        parts.append(_sql_level(f"run{k}", below, "s", f"level{k + 1}"))
        below = f"level{k + 1}"
    parts.append(f"roots AS (SELECT s AS i, h, 0 AS z FROM {below}),")
    below = "roots"
    for k in range(top):
        parts.append(_sql_level(f"top{k}", below, "z", f"above{k + 1}"))
        below = f"above{k + 1}"
    inner = f"SELECT f.*, r.h AS subroot, g.h AS root, seen AS x0, '' AS q0 FROM leaves f JOIN roots r ON r.i = f.s CROSS JOIN {below} g"
    for k in range(depth + top):
        j = k if k < depth else k - depth
        runs, at, on = (f"run{j}", f"(i // {FANOUT**j})", "r.s = x.s") if k < depth else (f"top{j}", f"(x.s // {FANOUT**j})", "TRUE")
        left, right = f"array_to_string(l[1:{at} % {FANOUT}], '')", f"array_to_string(l[{at} % {FANOUT} + 2:], '')"
        inner = f"""SELECT x.*, CASE WHEN alone THEN x{k} ELSE sha256(concat({left}, x{k}, {right})) END AS x{k + 1}, CASE WHEN alone THEN q{k} ELSE concat(q{k}, {left}, {right}) END AS q{k + 1}
FROM ({inner}) x JOIN {runs} r ON {on} AND r.p = {at} // {FANOUT}"""
    last = depth + top
    parts.append(f"folded AS ({inner})\nSELECT doc_id, h AS leaf, subroot, root, sha256(q{last}) AS proof_sha256, x{last} AS folded_root, x{last} = root AS verified FROM folded")
    return "\n".join(parts)


SQL = _sql()
