"""S5 + S16: what a table of batch folders holds, as a log of small entries.

Each batch has a folder of its own. Before it is written an entry says which folder is
*open*, afterwards another one books its rows (``sources.commits``: numbered, never
overwritten). After ``COMPACT`` entries the folded state is written as a checkpoint,
and entries before the checkpoint before that one go.

The folders are the truth, the log only saves counting them: a folder that is still
open (its writer died, or the booking is lost), or that no entry names, is counted
anew when the state is asked for, and a table without any log is counted whole, in one
job. So losing entries changes neither rows nor totals.
"""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass, field
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.session import list_names
from tallyflow.sources import commits

LOG = "_ledger"
INGEST = "ingest"
COMPACT = 32
_FOLDER = r"^(stream|run)-(.*)-(\d+)$"


@dataclass
class State:
    """``streams``: last batch of each stream and its rows (only that one can come
    again); ``runs``: rows of each named delivery; ``open``: folders being written."""

    total: int = 0
    streams: dict[str, list[int]] = field(default_factory=dict)
    runs: dict[str, int] = field(default_factory=dict)
    open: dict[str, bool] = field(default_factory=dict)
    #: entries of the log since the checkpoint that this state began with
    tail: int = 0

    def booked(self, kind: str, name: str, batch: int) -> int:
        """Rows that the total already has for this batch."""
        if kind == "run":
            return self.runs.get(name, 0)
        last, rows = self.streams.get(name, [-1, 0])
        return rows if last == batch else 0

    def knows(self, kind: str, name: str, batch: int) -> bool:
        return name in self.runs if kind == "run" else batch <= self.streams.get(name, [-1, 0])[0]

    def book(self, kind: str, name: str, batch: int, rows: int) -> None:
        self.total += rows - self.booked(kind, name, batch)
        if kind == "run":
            self.runs[name] = rows
        elif batch >= self.streams.get(name, [-1, 0])[0]:
            self.streams[name] = [batch, rows]

    def apply(self, entry: dict) -> None:
        if "open" in entry:
            self.open[entry["open"]] = True
        else:
            self.book(entry["kind"], entry["name"], entry["batch"], entry["rows"])
            self.open.pop(folder(entry["kind"], entry["name"], entry["batch"]), None)


def folder(kind: str, name: str, batch: int) -> str:
    return f"{INGEST}={kind}-{quote(name, safe='')}-{batch}"


def _parsed(folder_name: str) -> tuple[str, str, int] | None:
    found = re.match(_FOLDER, unquote(folder_name.partition("=")[2]))
    return (found[1], found[2], int(found[3])) if found else None


def folders(spark: SparkSession, table_path: str) -> list[str]:
    """The batch folders that are there (one listing of the table's folder)."""
    return [n for n in list_names(spark, table_path) if n.startswith(f"{INGEST}=")]


def folded(spark: SparkSession, table_path: str) -> State:
    """The state as the log has it."""
    log = f"{table_path}/{LOG}"
    state, tail = State(), []
    for number in reversed(commits.numbers(spark, log)):
        entry = commits.load(spark, log, number)
        if entry is not None and "state" in entry:
            state = State(**entry["state"])
            break
        tail.append(entry)
    for entry in reversed(tail):
        if entry is not None:
            state.apply(entry)
    state.tail = len(tail)
    return state


def _rows_of(spark: SparkSession, table_path: str, names: list[str], fmt: str) -> DataFrame:
    """kind, name, batch and rows of batch folders."""
    rows = spark.read.format(fmt).option("basePath", table_path).load([f"{table_path}/{n}" for n in names])
    counted = rows.groupBy(F.col(INGEST).cast("string").alias("folder")).count()
    part = [F.regexp_extract("folder", _FOLDER, i) for i in (1, 2, 3)]
    return counted.select(part[0].alias("kind"), part[1].alias("name"), part[2].cast("long").alias("batch"), F.col("count").alias("rows"))


def state(spark: SparkSession, table_path: str, fmt: str = "parquet") -> State:
    """The state of the table: the log's, with the folders it is not sure of counted."""
    found = folded(spark, table_path)
    names = folders(spark, table_path)
    parsed = {n: p for n in names if (p := _parsed(n))}
    unsure = [n for n, p in parsed.items() if n in found.open or not found.knows(*p)]
    for n in found.open:  # opened, and nothing is there: never written, or cleared by a retry that died
        if n not in parsed and (p := _parsed(n)):
            found.book(*p, 0)
    if not unsure:
        return found
    counted = _rows_of(spark, table_path, unsure, fmt)
    # one row for each delivery, and for each stream: earlier batches only count
    streams = counted.where("kind = 'stream'").groupBy("name").agg(F.max("batch").alias("batch"), F.max_by("rows", "batch").alias("rows"), F.sum("rows").alias("all"))
    for r in streams.collect():
        before = sum(found.booked("stream", r["name"], p[2]) for n, p in parsed.items() if n in unsure and p[:2] == ("stream", r["name"]))
        found.total += r["all"] - before
        if r["batch"] >= found.streams.get(r["name"], [-1, 0])[0]:
            found.streams[r["name"]] = [r["batch"], r["rows"]]
    for r in counted.where("kind = 'run'").collect():
        found.book("run", r["name"], r["batch"], r["rows"])
    empty = {p for n, p in parsed.items() if n in unsure and p[0] == "run"} - {("run", r["name"], r["batch"]) for r in counted.where("kind = 'run'").collect()}
    for p in empty:
        found.book(*p, 0)
    return found


def begin(spark: SparkSession, table_path: str, kind: str, name: str, batch: int) -> None:
    commits.append(spark, f"{table_path}/{LOG}", {"open": folder(kind, name, batch)})


def book(spark: SparkSession, table_path: str, kind: str, name: str, batch: int, rows: int) -> None:
    commits.append(spark, f"{table_path}/{LOG}", {"kind": kind, "name": name, "batch": batch, "rows": rows})


def compact(spark: SparkSession, table_path: str) -> None:
    """Write the folded state as a checkpoint; entries before the one before it go."""
    log = f"{table_path}/{LOG}"
    taken = commits.numbers(spark, log)
    earlier = next((n for n in reversed(taken) if "state" in (commits.load(spark, log, n) or {})), 0)
    commits.append(spark, log, lambda _: {"state": asdict(folded(spark, table_path))})
    commits.drop(spark, log, [n for n in taken if n < earlier])
