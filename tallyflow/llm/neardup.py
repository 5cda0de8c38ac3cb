"""MinHash near-duplicates: many universal hash minima, banding, verification on
signatures and full shingle sets, and connected components by alternating stars.

1. Each text becomes the set of its hashed word shingles; texts with the same set
   are one *representative* (the smallest doc_id), so copies never meet in pairs.
2. Representatives with an equal band of minima share a bucket. Each bucket links
   its members to its smallest member (a star, not all pairs). A link holds if the
   signatures agree well enough and the full sets' similarity reaches the limit.
3. Verified links give components. Where a bucket still holds more than one
   component, a second star with another centre runs, then an exact prefix filter
   over the members of these buckets: two sets that are similar enough share one
   of their few rarest shingles. Only members of *different* components that do are
   compared, so no link is lost to the stars, and no bucket is expanded into pairs.

A pair of similarity 0.8 shares no band with probability (1 - 0.8**5)**32 = 3e-6.

Defined results: null and empty texts, and texts of blanks only, have an empty
set, are linked with nothing and are their own component; equal texts share a
component; rows with a null doc_id are left out; a doc_id that comes twice
has a row for each of its texts, and the links of all of them; no rows: no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import arrow_map, text_chunks, written
from tallyflow.llm.components import connected_components
from tallyflow.llm.shingles import MinHash, set_digest, shingle_sets

BANDS, ROWS = 32, 5
CHUNK_BYTES = 4_000_000
STAR_ROUNDS = 1


def fingerprints(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, band keys (none for an empty set)."""
    hashes = MinHash(bands, rows)

    def run(batches):
        for batch in text_chunks(batches, CHUNK_BYTES):
            sets = shingle_sets(batch.column("text").to_pylist(), k)
            keys = hashes.band_keys(np.array([hashes.signature(s) for s in sets]))
            yield {
                "doc_id": batch.column("doc_id"),
                "n_shingles": [len(s) for s in sets],
                "digest": [set_digest(s) for s in sets],
                "keys": [x if len(s) else [] for x, s in zip(keys, sets)],
            }

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, n_shingles long, digest binary, keys array<long>")


def full_sets(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, signature and the whole sorted shingle set, as bytes."""
    hashes = MinHash(bands, rows)

    def run(batches):
        for batch in text_chunks(batches, CHUNK_BYTES):
            sets = shingle_sets(batch.column("text").to_pylist(), k)
            yield {
                "id": batch.column("doc_id"),
                "signature": [hashes.signature(s).tobytes() for s in sets],
                "shingles": [s.tobytes() for s in sets],
            }

    return arrow_map(docs.select("doc_id", "text"), run, "id long, signature binary, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    limit = percent / 100
    a = sets.select(F.col("id").alias("a"), F.col("signature").alias("a_signature"), F.col("shingles").alias("a_shingles"))
    b = sets.select(F.col("id").alias("b"), F.col("signature").alias("b_signature"), F.col("shingles").alias("b_shingles"))

    def run(batches):
        for batch in batches:
            keep = []
            for xs, ys, xb, yb in zip(*(batch.column(c).to_pylist() for c in ("a_signature", "b_signature", "a_shingles", "b_shingles"))):
                x, y = np.frombuffer(xs, np.uint32), np.frombuffer(ys, np.uint32)
                # five standard errors below the limit: the estimate alone drops no true link
                if (x == y).mean() < limit - 5 * (limit * (1 - limit) / len(x)) ** 0.5:
                    keep.append(False)
                    continue
                x, y = np.frombuffer(xb, np.uint64), np.frombuffer(yb, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield {c: [v for v, k in zip(batch.column(c).to_pylist(), keep) if k] for c in ("a", "b")}

    return arrow_map(pairs.select("a", "b").join(b, "b").join(a, "a"), run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (the first of its component)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    marks = written(spark, fingerprints(docs, k, bands, rows), "fingerprints")
    reps = marks.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    entries = marks.join(reps.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi").select(
        F.explode("keys").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n")
    )
    buckets = entries.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("centre")).where("size > 1").drop("size")
    entries = written(spark, entries.join(buckets, "key"), "buckets")

    def close(n: str, m: str):  # sets of such sizes can be similar enough
        return (F.col(n) * 100 >= F.col(m) * percent) & (F.col(m) * 100 >= F.col(n) * percent)

    wanted = entries.select("id").distinct()
    sets = written(spark, full_sets(docs.join(wanted, docs.doc_id == wanted.id, "left_semi"), k, bands, rows), "sets")

    # stars around the smallest member
    pairs = entries.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    tested = written(spark, pairs, "pairs")
    links = written(spark, verified(tested, sets, percent), "links")
    components = connected_components(spark, links)
    for turn in range(STAR_ROUNDS + 1):
        mixed = entries.join(components.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        order = F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "component", "n")
        split = mixed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min(order).alias("c")).where("low < high")
        mixed = written(spark, mixed.join(split.select("key", "c"), "key").select("id", "component", "n", "c"), "mixed")
        if turn < STAR_ROUNDS:
            pairs = mixed.where((F.col("component") != F.col("c.component")) & close("n", "c.n")).select(
                F.least("c.id", "id").alias("a"), F.greatest("c.id", "id").alias("b")
            )
        else:
            pairs = across(mixed.select("id", "component", "n").distinct(), sets, percent, close)
        pairs = written(spark, pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionAll(pairs)
        more = written(spark, verified(pairs, sets, percent), "links")
        if more.isEmpty():
            continue
        links = links.unionAll(more)
        components = connected_components(spark, links)

    out = marks.join(reps, "digest", "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    out = out.join(components.select(F.col("node").alias("rep"), "component"), "rep", "left")
    component = F.coalesce("component", "rep")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def without_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest
    doc_id. All columns stay. Rows without a set (no words) all stay.

    Where ids are null or come again, rows are told apart by id and text: each pair gets a
    number of its own, the groups are found over these, and of equal rows one stays. Null
    ids come last. Tables with sound ids need none of that."""
    spark = docs.sparkSession
    row_id, own = F.col("doc_id").cast("long"), "__own"
    odd = docs.groupBy(row_id.alias("id")).count().where("count > 1 or id is null")
    if odd.isEmpty():
        found = near_duplicates(docs, k, percent).where("not kept").select(F.col("doc_id").alias("__copy"))
        # sorted and merged at every size: the copies grow with the documents
        return docs.join(found.hint("merge"), row_id == found["__copy"], "left_anti")
    marks = [F.xxhash64("text").alias("__a"), F.xxhash64(F.lit(1), "text").alias("__b")]
    pairs = docs.select(row_id.alias("__id"), *marks).distinct().withColumn(own, F.monotonically_increasing_id())
    pairs = written(spark, pairs, "row_numbers")
    same = row_id.eqNullSafe(pairs["__id"]) & (marks[0] == pairs["__a"]) & (marks[1] == pairs["__b"])
    numbered = written(spark, docs.join(pairs, same).select(*(docs[c] for c in docs.columns), own), "numbered")
    found = near_duplicates(numbered.select(F.col(own).alias("doc_id"), "text"), k, percent).distinct()
    groups = found.join(pairs, found["doc_id"] == pairs[own])
    first = F.min(F.struct(F.col("__id").isNull().alias("last"), F.col("__id"), F.col(own).alias("own"))).alias("first")
    stay = groups.groupBy("component_id").agg(first, F.max("n_shingles").alias("n")).select(F.col("first.own").alias("__stay"), "n")
    kept = numbered.join(stay, numbered[own] == stay["__stay"])
    place = F.row_number().over(Window.partitionBy(own).orderBy(own))
    return kept.withColumn("__place", place).where("__place = 1 or n = 0").select(*docs.columns)


def across(members: DataFrame, sets: DataFrame, percent: int, close) -> DataFrame:
    """All pairs of members (id, component, n) of different components that can
    reach the limit: in one order of all shingles, rarest first, they share one of
    the first ``n - ceil(limit * n) + 1``, where enough of both sets is still to come.
    Shingles of a single member come first in that order and are only counted."""

    def run(batches):
        for batch in batches:
            yield {c: batch.column(c) for c in ("id", "component", "n")} | {
                "shingles": [np.frombuffer(s, np.int64) for s in batch.column("shingles").to_pylist()]
            }

    whole = members.join(sets.select("id", "shingles"), "id")
    flat = arrow_map(whole.select("id", "component", "n", "shingles"), run, "id long, component long, n long, shingles array<long>")
    flat = flat.select("id", "component", "n", F.explode("shingles").alias("shingle"))
    shared = flat.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    lists = flat.join(shared, "shingle").groupBy("id", "component", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("list"))
    lists = lists.select("id", "component", "n", (F.col("n") - F.size("list")).alias("alone"), F.posexplode("list").alias("at", "x"))
    # place in the order, from 1; the smaller set of a pair needs fewer of its first shingles than the larger
    heads = lists.select("id", "component", "n", (F.col("alone") + F.col("at") + 1).alias("at"), F.col("x.shingle").alias("shingle"))
    heads = heads.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    left = heads.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent)) + 1)
    left = left.select("shingle", F.col("id").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("at").alias("pa"))
    right = heads.select("shingle", F.col("id").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("at").alias("pb"))
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    # what can still be common from the first common shingle on
    enough = (1 + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))) * (100 + percent) >= percent * (F.col("na") + F.col("nb"))
    pairs = left.join(right, "shingle").where(smaller & enough & (F.col("ca") != F.col("cb")) & close("na", "nb"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
