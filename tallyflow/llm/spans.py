"""Spans of a text as columns: shared by the scans for personal data and secrets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import arrow_map, text_chunks

CHUNK_BYTES = 4_000_000

#: (start, end, kind) in code points, the end exclusive
Span = tuple[int, int, str]


def ordered(spans: list[Span], kinds: tuple[str, ...]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], kinds.index(s[2]), s[1]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, make: Callable[[], Callable[[str], tuple[list[Span], list[Span]]]], kinds: tuple[str, ...], base: tuple[str, ...]) -> DataFrame:
    """Per document: doc_id, spans (base ones and the method's) as an array of
    structs, and base_spans. ``make`` builds the scanner once a task; a null text
    has no spans."""

    def run(batches):
        scanner = make()
        for batch in text_chunks(batches, CHUNK_BYTES):
            found = [scanner(t) if t else ([], []) for t in batch.column("text").to_pylist()]
            rows = [ordered(b + more, kinds) for b, more in found]
            yield {
                "doc_id": batch.column("doc_id"),
                "spans": [[{"start": s, "end": e, "kind": k} for s, e, k in row] for row in rows],
                "base_spans": [listed(ordered(b, kinds)) for b, _ in found],
                "all_spans": [listed(row) for row in rows],
                **{f"n_{k}": [sum(s[2] == k for s in b) for b, _ in found] for k in base},
            }

    counts = ", ".join(f"n_{k} long" for k in base)
    schema = f"doc_id long, spans array<struct<start: int, end: int, kind: string>>, base_spans string, all_spans string, {counts}"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def digest(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """The contract's columns of a scan's result."""
    return found.select("doc_id", *(f"n_{k}" for k in base), F.sha2("base_spans", 256).alias("base_sha256"), F.col("all_spans").alias("spans"))


