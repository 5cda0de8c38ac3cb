"""Line dedup by winnowing over line hashes.

A *gram* is the shortest run of consecutive lines, from some line on, that has
``gram_words`` words. A *window* is the shortest run of lines from some line on
with ``window_words`` words; from each window the gram with the smallest hash
among those wholly inside it is a fingerprint. So no repeat shorter than
``gram_words`` words is ever touched, and every run of lines with at least
``window_words`` words that repeats has a common fingerprint: winnowing's two
thresholds, in words, since lines differ in length.

A common gram alone may have its first place in an unrelated text and agree with it
for less than the repeated run. So the windows themselves, from each line on and up
to each line, are fingerprints too: a repeated run of ``window_words`` words or more
goes as a whole, since windows inside it cover all its lines.

Every fingerprint is joined with the first place (doc_id, line) of its hash. The
match is extended by equal lines both ways, and the later run is deleted. A
deleted line always has an equal earlier line, so the first copy of everything
stays. Only first places are joined: a line with a million copies gives a million
rows, not pairs.

Defined results: a null text stays null and an empty one empty (0 lines: null
text; an empty text is one empty line); rows with a null doc_id are returned
unchanged; rows with the same doc_id and text are one document's copies and lose
the same lines; other columns are kept; no rows: no rows.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm.common import arrow_map, text_chunks, written

GRAM_WORDS = 10
WINDOW_WORDS = 20
CHUNK_BYTES = 4_000_000


def line_hashes(text: str) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(line.encode("utf-8", "replace")) for line in text.split("\n")], np.uint64).astype(np.int64)


def word_counts(text: str) -> list[int]:
    return [len(line.split()) for line in text.split("\n")]


def run_ends(words: list[int], least: int) -> list[int]:
    """For each line the end (exclusive) of the shortest run from it with at least
    ``least`` words; -1 where the text ends before."""
    ends, end, total = [], 0, 0
    for start in range(len(words)):
        while total < least and end < len(words):
            total += words[end]
            end += 1
        ends.append(end if total >= least else -1)
        total -= words[start]
    return ends


def fingerprints(text: str, gram_words: int, window_words: int) -> list[tuple[int, int]]:
    """(hash, first line) of the windows and of the grams selected from them."""
    words = word_counts(text)
    grams = run_ends(words, gram_words)
    if grams[0] < 0:
        return []
    hashes = line_hashes(text).tobytes()

    def value(start: int, end: int) -> int:
        return xxhash.xxh3_64_intdigest(hashes[8 * start : 8 * end]) - (1 << 63)

    windows = run_ends(words, window_words)
    if windows[0] < 0:  # shorter than a window: the whole text is one
        windows[0] = len(words)
    gram_values = [value(i, end) if end > 0 else None for i, end in enumerate(grams)]
    chosen, inside, entered = set(), deque(), 0  # inside: grams of the window, values rising
    for start, end in enumerate(windows):
        if end < 0:
            break
        chosen.add((start, end))
        while entered < len(grams) and 0 < grams[entered] <= end:
            while inside and gram_values[inside[-1]] >= gram_values[entered]:
                inside.pop()
            inside.append(entered)
            entered += 1
        while inside and inside[0] < start:
            inside.popleft()
        if inside:
            chosen.add((inside[0], grams[inside[0]]))
    for i, end in enumerate(run_ends(words[::-1], window_words)):  # windows up to each line
        if end > 0:
            chosen.add((len(words) - end, len(words) - i))
    return [(value(start, end), start) for start, end in sorted(chosen)]


def matched_lines(lines: np.ndarray, at: int, first: np.ndarray, first_at: int) -> tuple[int, int]:
    """The run (start, end) around line ``at`` that equals the run around ``first_at``."""
    back = min(at, first_at)
    same = lines[at - back : at] == first[first_at - back : first_at]
    start = at - (back if same.all() else int(np.argmin(same[::-1])))
    ahead = min(len(lines) - at, len(first) - first_at)
    same = lines[at : at + ahead] == first[first_at : first_at + ahead]
    return start, at + (ahead if same.all() else int(np.argmin(same)))


def repeated_runs(docs: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, text_hash, lines): the lines to delete of each text that repeats earlier ones."""
    spark = docs.sparkSession

    def mark(batches):
        for batch in text_chunks(batches, CHUNK_BYTES):
            out = {"doc_id": [], "text_hash": [], "hashes": [], "marks": []}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = fingerprints(text, gram_words, window_words)
                if found:
                    out["doc_id"].append(doc_id)
                    out["text_hash"].append(text_hash(text))
                    out["hashes"].append(line_hashes(text).tobytes())
                    out["marks"].append([{"gram": g, "line": i} for g, i in found])
            yield out

    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")
    schema = "doc_id long, text_hash long, hashes binary, marks array<struct<gram: long, line: int>>"
    marked = written(spark, arrow_map(texts, mark, schema), "line_marks")
    grams = marked.select("doc_id", "text_hash", F.explode("marks").alias("m")).select("doc_id", "text_hash", "m.gram", "m.line")
    first = grams.groupBy("gram").agg(F.min(F.struct("doc_id", "line", "text_hash")).alias("first"), F.count("*").alias("n")).where("n > 1")
    # written, so that the joins below read plain shuffles that can be split where a key is hot
    first = written(spark, first.select("gram", "first"), "line_firsts")
    arrays = written(spark, marked.select("doc_id", "text_hash", "hashes").dropDuplicates(["doc_id", "text_hash"]), "line_arrays")
    later = grams.join(first, "gram").where(
        (F.col("doc_id") != F.col("first.doc_id")) | (F.col("line") != F.col("first.line")) | (F.col("text_hash") != F.col("first.text_hash"))
    )
    pairs = later.select("doc_id", "text_hash", "line", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"), F.col("first.line").alias("first_line"))
    pairs = pairs.groupBy("doc_id", "text_hash", "first_id", "first_hash").agg(F.collect_list(F.struct("line", "first_line")).alias("places"))
    early = arrays.toDF("first_id", "first_hash", "first_hashes")
    pairs = pairs.join(arrays, ["doc_id", "text_hash"]).join(early, ["first_id", "first_hash"])

    def extend(batches):
        for batch in batches:
            out = {"doc_id": [], "text_hash": [], "runs": []}
            for row in batch.to_pylist():
                lines, first = np.frombuffer(row["hashes"], np.int64), np.frombuffer(row["first_hashes"], np.int64)
                runs, seen = [], {}
                for place in sorted(row["places"], key=lambda p: (p["line"], p["first_line"])):
                    at, first_at = place["line"], place["first_line"]
                    if seen.get(at - first_at, -1) > at:
                        continue
                    start, end = matched_lines(lines, at, first, first_at)
                    seen[at - first_at] = end
                    runs.append({"start": start, "end": end})
                out["doc_id"].append(row["doc_id"])
                out["text_hash"].append(row["text_hash"])
                out["runs"].append(runs)
            yield out

    runs = arrow_map(pairs, extend, "doc_id long, text_hash long, runs array<struct<start: int, end: int>>")
    return runs.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def drop_repeated_lines(docs: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with the later copies of repeated runs deleted from ``text``, plus
    n_lines and n_removed (columns of these names in the input are replaced)."""
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_removed")
    runs = written(spark, repeated_runs(docs, gram_words, window_words), "line_runs")
    runs = runs.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("runs").alias("__runs"))
    # a document's runs, by the hash of the text they belong to: doc_id alone decides the partition
    runs = runs.groupBy("__id").agg(F.collect_list(F.struct("__hash", "__runs")).alias("__runs"))
    # sorted and merged at every size: the runs grow with the documents
    joined = docs.join(runs.hint("merge"), docs["doc_id"].cast("long") == runs["__id"], "left").drop("__id")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.IntegerType()), T.StructField("n_removed", T.IntegerType())])
    arrow = to_arrow_schema(schema)
    place = docs.columns.index("text")

    def delete(batches):
        for batch in text_chunks(batches, CHUNK_BYTES):
            texts, n_lines, n_removed = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("__runs").to_pylist()):
                gone = set()
                if found:
                    mine = text_hash(text) if text is not None else None
                    gone = {i for f in found if f["__hash"] == mine for r in f["__runs"] for i in range(r["start"], r["end"])}
                if gone:
                    lines = text.split("\n")
                    n_lines.append(len(lines))
                    text = "\n".join(x for i, x in enumerate(lines) if i not in gone)
                else:
                    n_lines.append(text.count("\n") + 1 if text is not None else 0)
                texts.append(text)
                n_removed.append(len(gone))
            columns = [c.cast(f.type) for c, f in zip(batch.columns[:-1], arrow)]
            columns[place] = pa.array(texts, arrow.field("text").type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int32()), pa.array(n_removed, pa.int32())], schema=arrow)

    return joined.mapInArrow(delete, schema)
