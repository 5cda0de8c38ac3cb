"""Periodic runs of words: every maximal stretch that repeats itself at least three times.

Words ``q`` apart are equal all along a run of period ``q``: in *match space* it is the
stretch of places ``i`` with word ``i`` = word ``i + q``, which is ``length - q`` long.
The work is tiled by scale, an octave of periods at a time:

1. A run is at least ``max(24, 3 * q)`` words long, so for the periods ``B <= q < 2 * B``
   (1 to 7 with ``B`` = 8) its match stretch covers a whole block ``[b, b + B)`` where
   ``b`` is a multiple of ``B``. Each such border is one tile, which overlaps its
   neighbours: the words ``[b - B, b + 4 * B)``. Tiles are independent of each other.
2. In a tile, hashes of ``B`` words (each doubled from those of the octave below) show at
   which distances ``q`` the block comes again. For those, the boundary Z-values are
   found by halving steps over the smaller hashes: how far the words right of the border
   and left of it go on agreeing at that distance, up to the tile's ends. Distances that
   are multiples of a smaller period there are dropped. What remains are fragments of
   match stretches.
3. Fragments are shuffled by document and period and stitched where they touch; stretches
   that are long enough are the runs. Their words are checked once more, one by one.

A text of up to ``TILE_WORDS`` words is solved where it is read, all its tiles at once, and
its fragments are merged before the shuffle. Longer texts are exploded into rows of
neighbouring tiles (several octaves in one row while they are small) that are dealt to
other tasks as word numbers. Work is n log n in a text's words, memory about 150 bytes
a word of one such row.

``collapsed`` texts keep the first period of each run.

Defined results: null, empty and blank texts have no words, no run, and the hash of an
empty text; repeated rows each get their row; a null doc_id is kept and its text taken
as it is; other columns are ignored; no rows: no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import arrow_map, text_chunks, written

MIN_WORDS, TIMES = 24, 3
FIRST_BLOCK = 8
TILE_WORDS = 1 << 16
CHUNK_BYTES = 1_000_000
_MUL, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_ABSENT = np.uint64(0x1234567890ABCDEF)
_factors = np.arange(2)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The places that stand in for words 0 .. n - 1 of the ids that get a periodic tail."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((np.arange(a), a + np.arange(n - a) % p))


def as_they_are(doc_id: int | None, n: int) -> None:
    return None


# tiles


def octaves(words: int) -> list[tuple[int, int, int]]:
    """(first period, last period, block) for texts of so many words."""
    out, first = [], 1
    while max(MIN_WORDS, TIMES * first) <= words:
        block = max(first, FIRST_BLOCK)
        last = block - 1 if first == 1 else 2 * block - 1
        out.append((first, last, block))
        first = last + 1
    return out


def tile_rows(words: int, tile_words: int) -> list[tuple[int, int, int, int]]:
    """(first octave, last octave, start, end) of the rows that a long text is cut into;
    all of them together hold every tile of every octave whole."""
    plan = octaves(words)
    small = max([i for i, (_, _, block) in enumerate(plan) if 8 * block <= tile_words], default=0)
    rows = []
    for low, high in [(0, small)] + [(i, i) for i in range(small + 1, len(plan))]:
        block = plan[high][2]
        core = -(-max(tile_words, 4 * block) // block) * block
        for start in range(0, words, core):
            rows.append((low, high, max(0, start - block), min(words, start + core + 4 * block)))
    return rows


# solving


def doubled(hashes: np.ndarray, step: int) -> np.ndarray:
    """Hashes of twice as many words from those of ``step`` words."""
    with np.errstate(over="ignore"):
        x = (hashes[: max(0, len(hashes) - step)] + _ADD) * _MUL + hashes[step:]
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def smallest_factors(limit: int) -> np.ndarray:
    """Smallest prime factor of every number up to ``limit`` (kept for the next call)."""
    global _factors
    if len(_factors) <= limit:
        limit = max(limit, 2 * len(_factors))
        found = np.arange(limit + 1)
        for p in range(2, int(limit**0.5) + 1):
            if found[p] == p:
                found[p * p :: p] = np.minimum(found[p * p :: p], p)
        _factors = found
    return _factors


def agree(level: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the hashes at x and y (x < y) are equal; outside the text they aren't."""
    inside = (x >= 0) & (y < len(level))
    out = np.zeros(len(x), bool)
    out[inside] = level[x[inside]] == level[y[inside]]
    return out


def primitive(levels: list[np.ndarray], b: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the ``q`` words from ``b`` are no repetition of a shorter part."""
    keep = np.ones(len(q), bool)
    rest = q.copy()
    factors = smallest_factors(int(q.max(initial=1)))
    while (todo := np.flatnonzero(keep & (rest > 1))).size:
        prime = factors[rest[todo]]
        part = q[todo] // prime
        size = q[todo] - part
        power = np.frexp(size)[1] - 1  # two hashes of 2**power words cover the stretch
        same = np.zeros(len(todo), bool)
        for t in np.unique(power).tolist():
            at = np.flatnonzero(power == t)
            x, shift = b[todo[at]], size[at] - (1 << t)
            same[at] = agree(levels[t], x, x + part[at]) & agree(levels[t], x + shift, x + part[at] + shift)
        keep[todo[same]] = False
        rest[todo] //= prime
    return keep


def fragments(ids: np.ndarray, plan: list[tuple[int, int, int]], active) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, start, end) of match stretches, cut at the tiles' ends. ``ids`` are word
    numbers; ``active(first)`` says how many of them, from the start, to look at for
    periods from ``first`` on."""
    levels = [ids.astype(np.uint64)]
    found = [(np.zeros(0, np.int64),) * 3]
    for first, last, block in plan:
        while 1 << (len(levels) - 1) < block:
            levels.append(doubled(levels[-1], 1 << (len(levels) - 1)))
        n = active(first)
        top = len(levels) - 1
        levels = [level[: max(0, n - (1 << t) + 1)] for t, level in enumerate(levels)]
        whole = levels[top]
        rows = -(-len(whole) // block) + 1
        grid = np.concatenate((whole, np.full(rows * block - len(whole), _ABSENT))).reshape(rows, block)
        same = grid[:, first : last + 1] == grid[:, :1] if first == 1 else grid[1:] == grid[:-1, :1]
        tile, shift = np.nonzero(same)
        b, q = tile * block, shift + first
        inside = b + q < len(whole)
        b, q = b[inside], q[inside]
        own = primitive(levels, b, q)
        b, q = b[own], q[own]
        right, left = np.full(len(b), block), np.zeros(len(b), np.int64)
        for t in range(top - 1, -1, -1):
            size = 1 << t
            right += size * agree(levels[t], b + right, b + right + q)
            left += size * agree(levels[t], b - left - size, b - left - size + q)
        # both ends seen, and too short
        settled = (left < block - 1) & (right < 2 * block - 1) & (left + right + q < np.maximum(MIN_WORDS, TIMES * q))
        found.append((q[~settled], (b - left)[~settled], (b + right)[~settled]))
    return tuple(np.concatenate(x) for x in zip(*found))


def merged(keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments joined where they touch; ``keys`` has a row (text, period) for each."""
    order = np.lexsort((end, start, keys[:, 1], keys[:, 0]))
    keys, start, end = keys[order], start[order], end[order]
    if not len(start):
        return keys, start, end
    new = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1) | (start[1:] > end[:-1])))
    at = np.flatnonzero(new)
    return keys[at], start[at], np.maximum.reduceat(end, at)


def solve_texts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, period, start, end) of the merged fragments of several texts of word numbers."""
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= MIN_WORDS]
    if not len(order):
        return (np.zeros(0, np.int64),) * 4
    # longest first, so that the texts of an octave are a prefix; a number of its own between two texts
    pieces = [p for i in order for p in (texts[i], [-1 - i])]
    ids = np.concatenate(pieces).astype(np.int64)
    ends = np.cumsum(sizes[order] + 1)

    def active(first: int) -> int:
        many = np.searchsorted(-sizes[order], -max(MIN_WORDS, TIMES * first), side="right")
        return int(ends[many - 1]) if many else 0

    q, start, end = fragments(ids, octaves(int(sizes.max())), active)
    text = np.searchsorted(ends, start, side="right")
    begin = ends[text] - sizes[order][text] - 1
    keys, start, end = merged(np.stack((order[text], q), axis=1), start - begin, end - begin)
    return keys[:, 0], keys[:, 1], start, end


def numbered(lists: list[list[bytes]]) -> list[np.ndarray]:
    """Word numbers (equal words, equal numbers) of several texts."""
    flat = np.empty(sum(map(len, lists)), dtype=object)
    at = 0
    for words in lists:
        flat[at : at + len(words)] = words
        at += len(words)
    ids = pd.factorize(flat)[0].astype(np.int64) if len(flat) else np.zeros(0, np.int64)
    return np.split(ids, np.cumsum([len(w) for w in lists])[:-1])


def runs_of(docs: DataFrame, place=as_they_are, tile_words: int = TILE_WORDS) -> DataFrame:
    """(doc_id, mark, start, length, period) of every run of the texts; ``mark`` is
    xxhash64(text). ``place(doc_id, n)`` may name the words that stand in for a text's."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").where("text is not null")

    def find(batches):
        for batch in text_chunks(batches, CHUNK_BYTES):
            doc_ids, marks = batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist()
            ids = numbered([words_of(t) for t in batch.column("text").to_pylist()])
            places = [place(i, len(x)) for i, x in zip(doc_ids, ids)]
            ids = [x if p is None else x[p] for x, p in zip(ids, places)]
            long = [i for i, x in enumerate(ids) if len(x) > tile_words]
            text, q, start, end = solve_texts([x if len(x) <= tile_words else x[:0] for x in ids])
            out = {
                "doc_id": [doc_ids[i] for i in text], "mark": [marks[i] for i in text], "period": q, "start": start, "end": end,
                "low": [None] * len(q), "high": [None] * len(q), "words": [None] * len(q),
            }
            yield out
            for i in long:
                for low, high, first, last in tile_rows(len(ids[i]), tile_words):
                    words = ids[i][first:last].astype("<i4").tobytes()
                    yield {"doc_id": [doc_ids[i]], "mark": [marks[i]], "period": [None], "start": [first], "end": [last], "low": [low], "high": [high], "words": [words]}

    columns = f"doc_id {kind}, mark long, period long, start long, end long"
    cut = written(spark, arrow_map(docs, find, f"{columns}, low int, high int, words binary"), "tiles")

    def solve(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["words"], "<i4").astype(np.int64)
                plan = octaves(1 << 62)[row["low"] : row["high"] + 1]
                q, start, end = fragments(ids, plan, lambda first, n=len(ids): n)
                keys, start, end = merged(np.stack((q * 0, q), axis=1), start + row["start"], end + row["start"])
                yield {"doc_id": [row["doc_id"]] * len(start), "mark": [row["mark"]] * len(start), "period": keys[:, 1], "start": start, "end": end}

    dealt = cut.where("words is not null").repartition("doc_id", "mark", "low", "start")
    pieces = cut.where("words is null").select("doc_id", "mark", "period", "start", "end").unionAll(arrow_map(dealt, solve, columns)).distinct()

    key = ("doc_id", "mark", "period")
    before = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("new", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int"))
    pieces = pieces.withColumn("part", F.sum("new").over(Window.partitionBy(*key).orderBy("start", "end")))
    whole = pieces.groupBy(*key, "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    whole = whole.select("doc_id", "mark", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), "period")
    return whole.where((F.col("length") >= MIN_WORDS) & (F.col("length") >= TIMES * F.col("period")))


def described(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """n_runs, the greatest run's start, length, period and exponent, and both hashes."""
    for start, length, period in runs:
        if words[start : start + length - period] != words[start + period : start + length]:
            raise ValueError("a hash of blocks of words is ambiguous")
    shown = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if runs else None
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        words = [w for w, d in zip(words, np.cumsum(drop)) if not d]
    return len(runs), *best, milli, hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()


def describe(docs: DataFrame, place=as_they_are, tile_words: int = TILE_WORDS) -> DataFrame:
    """Per row: doc_id, n_runs, start, length, period and exponent_milli of the run with
    the greatest exponent, runs_sha256, collapsed_sha256."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    # as many runs as a text has, fewer than half its words
    runs = runs_of(docs, place, tile_words).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    runs = runs.select(F.col("doc_id").alias("run_id"), F.col("mark").alias("run_mark"), "runs")
    both = docs.join(runs, docs["doc_id"].eqNullSafe(runs["run_id"]) & (docs["mark"] == runs["run_mark"]), "left").select("doc_id", "text", "runs")

    def run(batches):
        for batch in text_chunks(batches, CHUNK_BYTES):
            out = []
            for doc_id, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "runs"))):
                words = words_of(text)
                places = place(doc_id, len(words))
                words = words if places is None else [words[i] for i in places]
                out.append((doc_id, *described(words, [(r["start"], r["length"], r["period"]) for r in found or ()])))
            names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
            yield dict(zip(names, zip(*out)))

    return arrow_map(both, run, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
