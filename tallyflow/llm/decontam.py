"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A mask such as ``11101011`` names the token places of a window that count; the
others are ignored, so a hash survives substitutions there. Every window of every
benchmark item and of every document is hashed under each mask, and equal hashes
are hits. A hit puts item and document on one diagonal; each (document, item,
diagonal) is verified once, token by token: some stretch of ``STRETCH`` places of
the item (all of a shorter item) must agree in ``percent`` of its places. ``MASKS``
are chosen so that whatever agrees in 80 % shares a seed (by enumeration, in the
tests). Items shorter than the masks have their own ones: whole windows of their
length, without each choice of as many places as may differ.

The hashes of the benchmark are broadcast only if they are counted to be at most
``BROADCAST_SEEDS`` rows. Then the documents' windows stay inside one projection and one
generator, and only hits leave the scan. Beyond that number windows are shuffled, each
as a hash, its place and its document's key alone; the tokens of documents with hits
are fetched afterwards. Both ways give the same rows.

A row is known by its id and a hash of its text, so that of rows with equal or null ids
each is judged by its own text.

Defined results: tokens are runs of letters and digits in lower case; null and
empty texts have none and match nothing; equal item texts stand for the smallest
item_id; items with a null id are left out; ``contaminated`` leaves out rows with a
null doc_id and gives one row for a doc_id and an item, however many rows have that id;
``without_contaminated`` judges every row; a very long text takes time and windows in
proportion to its length; empty tables: no rows, or all documents kept. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASKS = ("11010011", "10011101", "11111000", "01101110")
STRETCH = 16
PERCENT = 80
BROADCAST_SEEDS = 500_000


def tokens(text: str | Column) -> Column:
    """Hashes of the text's runs of letters and digits, in lower case."""
    column = F.col(text) if isinstance(text, str) else text
    words = F.array_remove(F.split(F.lower(column), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(ids: Column, masks: tuple[str, ...]) -> Column:
    """Hashes of all windows: first those of the first mask by place, and so on."""

    def under(number: int, mask: str) -> Column:
        places = [i for i, c in enumerate(mask) if c == "1"]
        return lambda at: F.xxhash64(F.lit(number), *(F.get(ids, at + p) for p in places))

    span = max(map(len, masks))
    starts = F.sequence(F.lit(0), F.size(ids) - span)
    arrays = [F.transform(starts, under(n, m)) for n, m in enumerate(masks)]
    return F.when(F.size(ids) >= span, F.concat(*arrays))


def windows(rows: DataFrame, masks: tuple[str, ...], *keep: str) -> DataFrame:
    """One row for each window and mask: ``keep``, place, seed. ``rows`` has ids."""
    span = max(map(len, masks))
    # the outer form: for the plain one the optimizer adds a filter that works out all seeds once more
    out = rows.select(*keep, (F.size("ids") - (span - 1)).alias("each"), seeds(F.col("ids"), masks).alias("seeds"))
    out = out.select(*keep, "each", F.posexplode_outer("seeds").alias("at", "seed"))
    return out.select(*keep, (F.col("at") % F.col("each")).alias("place"), "seed")


def short_masks(size: int, percent: int) -> tuple[str, ...]:
    """Masks of a whole item of ``size`` tokens, without as many places as may differ."""
    free = size - -(-size * percent // 100)
    return tuple("".join("01"[i not in left] for i in range(size)) for left in combinations(range(size), free))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, mark (a hash of the text) and text."""
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text")


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    percent: int = PERCENT,
    stretch: int = STRETCH,
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """(doc_id, mark, item_id, at, matched, item_tokens) of every diagonal that holds."""
    items = benchmark.select(F.col("item_id").cast("long"), tokens("text").alias("ids")).where("item_id is not null")
    items = items.groupBy("ids").agg(F.min("item_id").alias("item_id")).withColumn("n", F.size("ids"))
    texts = keyed(docs)
    rows = texts.select("doc_id", "mark", tokens("text").alias("ids"))
    at = (F.col("place") - F.col("item_place")).alias("at")

    def part(ids: Column, at: Column, n: Column) -> Column:  # of the document, where the item lies
        low = F.greatest(at, F.lit(0))
        return F.slice(ids, low + 1, F.greatest(F.least(at + n, F.size(ids)) - low, F.lit(0)))

    def diagonals_of(some: DataFrame, masks: tuple[str, ...]) -> DataFrame:
        marks = windows(some, masks, "item_id", "n").select("item_id", "n", F.col("place").alias("item_place"), "seed").distinct()
        if marks.count() <= broadcast_seeds:
            hits = windows(rows, masks, "doc_id", "mark", "ids").join(F.broadcast(marks), "seed").select("*", at)
            hits = hits.select("doc_id", "mark", "item_id", "at", part(F.col("ids"), F.col("at"), F.col("n")).alias("part"))
            return hits.groupBy("doc_id", "mark", "item_id", "at").agg(F.first("part").alias("part"))
        hits = windows(rows, masks, "doc_id", "mark").join(marks, "seed").select("doc_id", "mark", "item_id", "n", at).distinct()
        # a document's diagonals, at most its own windows times the items
        found = hits.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("item_id", "at", "n")).alias("found"))
        found = found.select(F.col("doc_id").alias("hit_id"), F.col("mark").alias("hit_mark"), "found")
        both = texts.distinct().join(found, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("mark") == F.col("hit_mark")))
        both = both.select("doc_id", "mark", tokens("text").alias("ids"), "found")
        cut = F.transform("found", lambda d: F.struct(d["item_id"].alias("item_id"), d["at"].alias("at"), part(F.col("ids"), d["at"], d["n"]).alias("part")))
        return both.select("doc_id", "mark", F.explode(cut).alias("d")).select("doc_id", "mark", "d.item_id", "d.at", "d.part")

    diagonals = diagonals_of(items, masks)
    # fewer lengths than the masks' span; a benchmark without such items costs nothing more
    for (size,) in items.where(F.col("n").between(1, max(map(len, masks)) - 1)).select("n").distinct().collect():
        diagonals = diagonals.unionByName(diagonals_of(items.where(F.col("n") == size), short_masks(size, percent)))
    both = diagonals.join(items, "item_id")
    own = F.slice("ids", F.greatest(-F.col("at"), F.lit(0)) + 1, F.size("part"))
    both = both.withColumn("same", F.zip_with("part", own, lambda x, y: (x == y).cast("int")))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    size = F.least(F.col("n"), F.lit(stretch))
    # filters may be tried in any order: a stretch that is too short must not fail here
    starts = F.sequence(F.lit(1), F.greatest(F.size("same") - size + 1, F.lit(1)))
    good = F.exists(starts, lambda s: total(F.slice("same", s, size)) * 100 >= size * percent)
    both = both.where(F.size("same") >= size).where(good)
    return both.select("doc_id", "mark", "item_id", "at", total(F.col("same")).alias("matched"), F.col("n").alias("item_tokens"))


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """(doc_id, item_id, at, matched, item_tokens) for each benchmark item that a
    document holds: the token where its best diagonal begins (negative if cut off)
    and the number of the item's tokens that agree there. ``how`` as for ``matches``."""
    best = F.max(F.struct(F.col("matched"), (-F.col("at")).alias("back"), F.col("item_tokens"))).alias("best")
    found = matches(docs, benchmark, **how).where("doc_id is not null").groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", (-F.col("best.back")).alias("at"), "best.matched", "best.item_tokens")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns stay."""
    hit = matches(docs, benchmark, **how).select(F.col("doc_id").alias("__hit_id"), F.col("mark").alias("__hit_mark")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(hit["__hit_id"]) & (F.xxhash64(docs["text"]) == hit["__hit_mark"])
    return docs.join(hit, same, "left_anti")
