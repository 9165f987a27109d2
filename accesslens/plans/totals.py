"""Totals of all batches that are kept up to date by adding the newer ones.

Partial counts of batches are added up to runs. An update reads the batches that were
committed since the last one, by the log, and adds them up to a run of their own; runs of
about equally many batches are put together, so their number stays small and a count is
added up again about as often as the number of batches doubles. A batch that was written again
retracts the run that has it, which is added up again from its batches: smallest and
largest sizes, and hosts that are gone, come out right where subtracting would not do. As
a stream repeats its last batch only, that is a small run.

The list of runs is one small file for each update with how far the log was counted. A
reader takes the last one; what it lists stays until the update after the next.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, fields as members
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from accesslens.plans.partials import KEYS, Partials, added_up
from accesslens.sources import commits
from accesslens.sources.tables import delete, read_place, read_snapshot

FOLDER, LISTS = "totals", "totals/lists"


@dataclass(frozen=True)
class Run:
    """Counts of some batches: where they are, and the places that the batches came from.

    ``compacted`` says that there are others among them, which had been put together.
    """

    place: str
    batches: dict[int, str]
    compacted: bool = False

    def size(self) -> float:
        return float("inf") if self.compacted else len(self.batches)


@dataclass(frozen=True)
class Totals:
    """Runs with all batches up to a version of the log; ``number`` counts updates."""

    number: int
    version: int
    runs: tuple[Run, ...]


def last_totals(spark: SparkSession, root: str) -> Totals | None:
    """The totals of the last update, by one listing and one file."""
    lists = commits.Files(spark, f"{root}/{LISTS}")
    numbers = [int(name.removesuffix(".json")) for name in lists.names() if name[0] != "."]
    if not numbers:
        return None
    found = json.loads(lists.read(_name(max(numbers))))
    runs = tuple(
        Run(r["place"], {int(n): p for n, p in r["batches"].items()}, r["compacted"])
        for r in found["runs"]
    )
    return Totals(found["number"], found["version"], runs)


def _name(number: int) -> str:
    return f"{number:020d}.json"


def _write_run(
    spark: SparkSession, root: str, batches: dict[int, str], runs: Sequence[Run] = ()
) -> Run:
    """A run of batches and of runs; of the batches, only their folders are read."""

    def rows(table: str) -> DataFrame:
        parts = [
            read_place(spark, root, place, table, [n for n in batches if batches[n] == place])
            for place in sorted(set(batches.values()))
        ]
        parts += [spark.read.parquet(f"{root}/{run.place}/{table}") for run in runs]
        return reduce(DataFrame.unionByName, parts)

    place = _write_tables(spark, root, {table: rows(table) for table in KEYS})
    everything = {n: at for run in runs for n, at in run.batches.items()} | batches
    return Run(place, everything, any(run.compacted for run in runs))


def _write_tables(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> str:
    """Add up the rows of each table, all at the same time; returns their place."""
    place = f"{FOLDER}/runs/{uuid.uuid4().hex}"

    def write(table: str) -> None:
        counts = added_up(tables[table], KEYS[table])
        counts.hint("rebalance").write.parquet(f"{root}/{place}/{table}")

    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), tables))
    return place


def _changed(
    spark: SparkSession, root: str, now: commits.Snapshot, last: Totals
) -> tuple[dict[int, str], list[Run]] | None:
    """Batches to be added up and the runs that stay; None if folders are gone that it takes."""
    try:
        entries = commits.commits_after(spark, root, last.version)
    except ValueError:
        return None
    entries = [e for e in entries if e["version"] <= now.version and "batch" in e]
    counted = {n: place for run in last.runs for n, place in run.batches.items()}
    new = {e["batch"]: e["place"] for e in entries}
    new = {n: place for n, place in new.items() if counted.get(n) != place}
    stale = [run for run in last.runs if run.batches.keys() & new.keys()]
    again = {n: place for run in stale for n, place in run.batches.items()} | new
    gone = now.gone is not None and any(n <= now.gone for n in again)
    if gone or any(run.compacted for run in stale):
        return None
    return again, [run for run in last.runs if run not in stale]


def update_totals(spark: SparkSession, root: str) -> Totals | None:
    """Add what was committed since the last update; None if nothing ever was.

    Everything is counted anew if the log or folders that are needed were deleted by
    compactions since, and if a compacted batch would have to be taken out.
    """
    now = commits.snapshot(spark, root)
    last = last_totals(spark, root)
    if now.version < 0 or (last is not None and last.version == now.version):
        return last
    found = _changed(spark, root, now, last) if last else None
    if found is None:
        tables = {table: read_snapshot(spark, now, table) for table in KEYS}
        place = _write_tables(spark, root, tables)
        runs = [Run(place, now.batches, now.compacted is not None)]
    else:
        batches, runs = found
        if batches:
            runs = _with_batches(spark, root, runs, batches)
    totals = Totals(last.number + 1 if last else 0, now.version, tuple(runs))
    lists = commits.Files(spark, f"{root}/{LISTS}")
    if not lists.create(_name(totals.number), json.dumps(asdict(totals))):
        return last_totals(spark, root)  # another update came first
    _delete_old(spark, root, lists, totals, last)
    return totals


def _with_batches(
    spark: SparkSession, root: str, runs: list[Run], batches: dict[int, str]
) -> list[Run]:
    """Runs from large to small; batches and runs no larger than what follows become one.

    These are added up once, together with the batches, without a run of the batches alone.
    """
    runs = sorted(runs, key=Run.size, reverse=True)
    small, size = [], float(len(batches))
    while runs and runs[-1].size() <= size:
        small.append(runs.pop())
        size += small[-1].size()
    return [*runs, _write_run(spark, root, batches, small)]


def _delete_old(spark: SparkSession, root: str, lists, totals: Totals, last: Totals | None) -> None:
    """Delete runs that neither these totals nor those before list, and older lists."""
    kept = {run.place.rsplit("/")[-1] for t in (totals, last) if t for run in t.runs}
    runs = commits.Files(spark, f"{root}/{FOLDER}/runs")
    old_lists = [name for name in lists.names() if name < _name(totals.number - 1) and name[0] != "."]
    if last is not None:
        delete(spark, [f"{runs.folder}/{name}" for name in runs.names() if name not in kept])
        lists.delete(old_lists)


def read_totals(spark: SparkSession, root: str, totals: Totals | None = None) -> Partials:
    """Counts of all batches as of the last update, for the results of ``plans.partials``."""
    totals = totals or last_totals(spark, root)
    if totals is None:
        raise ValueError(f"no totals below {root}")

    def rows(table: str) -> DataFrame:
        return spark.read.parquet(*[f"{root}/{run.place}/{table}" for run in totals.runs])

    return Partials(*[rows(member.name) for member in members(Partials)])
