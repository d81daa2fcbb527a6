"""Groups of similar items out of shared bucket keys, without forming all pairs of a bucket.

Items that share a key are candidates. Each round picks one item per bucket as its centre and every
other item is tested against the one centre it shares most keys with; links merge groups, and buckets
whose items are all in one group are done. A group of n near copies so costs about n tests a round
rather than n squared. After a few rounds the rest is settled exhaustively: every pair of a bucket
that still lies in different groups and was not tested is tested, so the groups are those that testing
all pairs of all buckets gives. Small buckets form these pairs as rows. Large ones are packed into chunks of
bounded size, and whoever is outside the main group of the bucket is compared chunk by chunk inside tasks.
Only item ids and keys move here; the caller's tests fetch what they compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmweave.llm.common import Stages

#: Rounds of centres before the rest is tested pair by pair.
ROUNDS = 2
#: Up to so many items, what is left of a bucket is paired as rows.
SMALL = 24

Test = Callable[[DataFrame], DataFrame]


def components(st: Stages, edges: DataFrame) -> DataFrame:
    """(id, label) for every end of an edge (a, b): label is the smallest id that it reaches.

    Each pass gives a node the smallest id next to it, then that node's own choice, and contracts
    the graph to the labels; it ends when no edge is left between labels."""
    labels = None
    left = edges.where("a <> b").select("a", "b").distinct()
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("n")).select("a", F.least("a", "n").alias("p"))
        up = near.select(F.col("a").alias("p"), F.col("p").alias("q"))
        parent = st.save(near.join(up, "p").select(F.col("a").alias("id"), F.least("p", "q").alias("label")), "parent")
        if labels is None:
            labels = parent
        else:
            step = parent.select(F.col("id").alias("label"), F.col("label").alias("to"))
            labels = labels.join(step, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
        pa = parent.select(F.col("id").alias("a"), F.col("label").alias("la"))
        pb = parent.select(F.col("id").alias("b"), F.col("label").alias("lb"))
        left = st.save(
            left.join(pa, "a").join(pb, "b").where("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(),
            "edges",
        )
        if left.isEmpty():
            return labels


def shared_buckets(st: Stages, keys: DataFrame, save_keys: bool = True) -> DataFrame:
    """(key, id) of the keys that at least two items have. Keys that are cheap to make need not be saved first."""
    keys = st.save(keys.select("key", "id"), "keys") if save_keys else keys.select("key", "id")
    multiple = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return st.save(keys.join(st.save(multiple, "multiple"), "key"), "shared")


def link_groups(st: Stages, shared: DataFrame, test: Test, chunked: Test, rounds: int = ROUNDS) -> DataFrame:
    """(id, label) of the items of ``shared`` that are linked with another; label is the smallest id of the group."""
    links = find_links(st, shared, test, chunked, rounds)
    if links is None:
        return shared.select("id", F.col("id").alias("label")).limit(0)
    return components(st, links)


def find_links(st: Stages, shared: DataFrame, test: Test, chunked: Test, rounds: int = ROUNDS) -> DataFrame | None:
    """Links (a, b) that make the groups which all links between items of one key would make; nothing if there is no pair to test.

    ``test`` takes distinct pairs (a, b), a < b, and returns those linked. ``chunked`` takes (key, id, main, label)
    and returns the links (a, b) between items of one key that differ in label, at least one of them not main."""
    links = tested = None
    open_rows = shared.withColumn("label", F.col("id"))
    for turn in range(rounds + 1):
        centre = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), F.col("id").alias("c"), F.col("label").alias("lc")))
        centres = st.save(open_rows.groupBy("key").agg(F.count("*").alias("size"), centre.alias("m")).select("key", "size", "m.c", "m.lc"), "centres")
        met = open_rows.join(centres, "key")
        found = None
        if turn < rounds:
            pairs = met.where("label <> lc").groupBy("id", "c").agg(F.count("*").alias("n"))
            if tested is not None:
                seen = tested.select(F.col("a").alias("x"), F.col("b").alias("y"))
                pairs = pairs.join(seen, (F.least("id", "c") == F.col("x")) & (F.greatest("id", "c") == F.col("y")), "left_anti")
            pairs = pairs.groupBy("id").agg(F.max(F.struct("n", "c")).alias("m")).select("id", "m.c")
            pairs = pairs.select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()
        else:
            few = st.save(met.where(f"size <= {SMALL}").select("key", "id", "label"), "few")
            other = few.select("key", F.col("id").alias("x"), F.col("label").alias("lx"))
            pairs = few.join(other, "key").where("id < x and label <> lx").select(F.col("id").alias("a"), F.col("x").alias("b")).distinct()
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            many = st.save(met.where(f"size > {SMALL}").select("key", "id", "label", (F.col("label") == F.col("lc")).alias("main")), "many")
            if not many.isEmpty():
                found = st.save(chunked(many).select("a", "b").distinct(), "links")
        pairs = st.save(pairs, "pairs")
        if not pairs.isEmpty():
            tested = pairs if tested is None else tested.unionByName(pairs)
            linked = st.save(test(pairs).select("a", "b"), "links")
            found = linked if found is None else found.unionByName(linked)
        if found is None:
            continue
        links = found if links is None else links.unionByName(found)
        if turn == rounds:
            break
        labels = st.save(components(st, links), "labels")
        named = open_rows.drop("label").join(labels, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
        mixed = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
        open_rows = st.save(named.join(mixed, "key"), "open")
        if open_rows.isEmpty():
            break
    return links
