"""Snapshots of result tables, and totals that are kept up to date."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from accesslens.catalog import QUERIES, lines
from accesslens.functions.parse import parse_logs
from accesslens.operators import traffic
from accesslens.plans import partials as exact
from accesslens.plans import host_bitmaps, sketches, totals
from accesslens.session import new_folder
from accesslens.sources import commits
from accesslens.sources.tables import (
    batch_ids,
    commit_batch,
    compact,
    read_as_of,
    read_committed,
    read_snapshot,
    write_batch,
)
from accesslens.streaming import results


def _rows(df):
    return Counter(map(tuple, df.collect()))


def _write(spark, root, batch_id, *values, table="t"):
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    write_batch(rows, root, table, batch_id)


def _values(df):
    return sorted(r.v for r in df.collect())


@pytest.fixture(scope="module")
def slices(spark, sf_dir):
    """Parsed logs of eight ranges of events."""
    all_lines = lines(spark, sf_dir, "iso")
    logs = parse_logs(all_lines, "iso", keep=["event_id"]).persist()
    parts = [logs.filter(F.col("event_id") % 8 == n).drop("event_id") for n in range(8)]
    yield parts
    logs.unpersist()


def test_a_commit_between_two_reads_changes_neither(spark):
    root = new_folder(spark, "snapshot")
    for table in ("t", "u"):
        _write(spark, root, 0, 1, table=table)
    commit_batch(spark, root, 0)
    now = commits.snapshot(spark, root)
    first = _values(read_snapshot(spark, now, "t"))
    for table in ("t", "u"):
        _write(spark, root, 1, 2, table=table)
    commit_batch(spark, root, 1)
    assert first == _values(read_snapshot(spark, now, "u")) == [1]
    assert _values(read_committed(spark, root, "u")) == [1, 2]


def test_partials_are_of_one_snapshot(spark, slices, monkeypatch):
    """A batch that is committed while its tables are read is in none of them."""
    root = new_folder(spark, "one")
    results.write_results(slices[0], root, 0)
    real = exact.read_snapshot
    written = []

    def commits_first(*args):
        found = real(*args)
        if not written:
            written.append(results.write_results(slices[1], root, 1))
        return found

    monkeypatch.setattr(exact, "read_snapshot", commits_first)
    p = exact.read_partials(spark, root)
    counts = [t.agg(F.sum("requests")).first()[0] for t in (p.hours, p.host_days, p.endpoints)]
    assert counts == [slices[0].count()] * 3 and written


def test_a_batch_written_again_leaves_snapshots_alone(spark, slices):
    root = new_folder(spark, "again")
    for n in range(2):
        results.write_results(slices[n], root, n)
    before = commits.snapshot(spark, root)
    old = _rows(exact.statuses(exact.read_partials(spark, root, before)))
    results.write_results(slices[2], root, 1)
    both = slices[0].unionByName(slices[2])
    assert _rows(exact.statuses(exact.read_partials(spark, root))) == _rows(
        both.groupBy("status").count()
    )
    assert _rows(exact.statuses(exact.read_partials(spark, root, before))) == old
    assert batch_ids(spark, root) == [0, 1]
    exact.compact_results(spark, root)
    assert _rows(exact.statuses(exact.read_partials(spark, root, before))) == old
    # it can't be taken out any more
    results.write_results(slices[3], root, 1)
    assert _rows(exact.statuses(exact.read_partials(spark, root))) == _rows(
        both.groupBy("status").count()
    )


def test_reading_as_of(spark):
    root = new_folder(spark, "asof")
    for n in range(4):
        _write(spark, root, n, n)
        commit_batch(spark, root, n)
    assert _values(read_as_of(spark, root, "t", batch_id=1)) == [0, 1]
    assert _values(read_as_of(spark, root, "t", version=2)) == [0, 1, 2]
    assert _values(read_as_of(spark, root, "t", batch_id=-1)) == []
    for missing in (4, 99):
        with pytest.raises(ValueError, match="no commit"):
            read_as_of(spark, root, "t", version=missing)
    compact(spark, root, {"t": lambda rows: rows}, upto=2)
    assert _values(read_as_of(spark, root, "t", batch_id=2)) == [0, 1, 2]
    assert _values(read_as_of(spark, root, "t", version=1)) == [0, 1]
    with pytest.raises(ValueError, match="compacted"):
        read_as_of(spark, root, "t", batch_id=1)


def test_states_make_up_for_a_long_log(spark, monkeypatch):
    monkeypatch.setattr(commits, "CHECKPOINT_EVERY", 4)
    root = new_folder(spark, "long")
    for n in range(10):
        commit_batch(spark, root, n, "place" if n == 3 else "")
    log = commits.Files(spark, f"{root}/{commits.LOG}")
    assert sum(name.endswith(".state.json") for name in log.names()) == 2
    read = []
    monkeypatch.setattr(
        commits.Files, "read", lambda self, name, real=commits.Files.read: (
            read.append(name), real(self, name))[1],
    )
    now = commits.snapshot(spark, root)
    assert now.version == 9 and now.ids() == list(range(10)) and now.batches[3] == "place"
    assert len(read) == 3  # a state and two commits
    assert commits.snapshot(spark, root, 5).ids() == list(range(6))
    commits.forget(spark, root, 8)
    assert commits.snapshot(spark, root) == now
    with pytest.raises(ValueError):
        commits.snapshot(spark, root, 5)
    with pytest.raises(ValueError):
        commits.commits_after(spark, root, 3)
    assert [e["batch"] for e in commits.commits_after(spark, root, 7)] == [8, 9]


def test_two_writers_take_different_versions(spark, monkeypatch):
    root = new_folder(spark, "race")
    commit_batch(spark, root, 0)
    real = commits.Files.create
    raced = []

    def slow(self, name, text):
        if not raced:
            raced.append(name)
            commit_batch(spark, root, 7)
        return real(self, name, text)

    monkeypatch.setattr(commits.Files, "create", slow)
    assert commits.commit(spark, root, {"batch": 1, "place": ""}).version == 2
    assert commits.snapshot(spark, root).ids() == [0, 1, 7]


def test_a_compaction_gives_way_to_a_batch_written_again(spark):
    root = new_folder(spark, "conflict")
    for n in range(2):
        _write(spark, root, n, n)
        commit_batch(spark, root, n)

    def meanwhile(rows):
        _write(spark, f"{root}/again/1-x", 1, 5)
        commit_batch(spark, root, 1, "again/1-x")
        return rows

    assert compact(spark, root, {"t": meanwhile}) is None
    assert _values(read_committed(spark, root, "t")) == [0, 5]
    assert compact(spark, root, {"t": lambda rows: rows}) == 1
    assert _values(read_committed(spark, root, "t")) == [0, 5]


# -- totals -----------------------------------------------------------------


def _all(p):
    return {name: _rows(make(p)) for name, make in exact.RESULT_TABLES.items()}


def test_totals_are_those_of_a_recount(spark, slices, monkeypatch):
    root = new_folder(spark, "totals")
    read = []
    real = totals.read_place
    monkeypatch.setattr(
        totals, "read_place", lambda s, r, place, table, ids: (
            read.append((table, place, tuple(ids))), real(s, r, place, table, ids))[1],
    )
    assert totals.update_totals(spark, root) is None
    sizes = []
    for n in range(6):
        results.write_results(slices[n], root, n)
        read.clear()
        found = totals.update_totals(spark, root)
        assert {ids for _, _, ids in read} == ({(n,)} if n else set())  # newer batches only
        sizes.append(len(found.runs))
        assert totals.update_totals(spark, root) == found  # nothing to do
    assert max(sizes) <= 3
    assert _all(totals.read_totals(spark, root)) == _all(exact.read_partials(spark, root))

    # the last batch comes again with other rows: hosts and sizes of the first are gone
    results.write_results(slices[6], root, 5)
    read.clear()
    found = totals.update_totals(spark, root)
    assert {n for _, _, ids in read for n in ids} == {4, 5}  # its run
    counted = slices[6]
    for n in range(5):
        counted = counted.unionByName(slices[n])
    recount = _all(exact.partial_counts(counted))
    assert _all(totals.read_totals(spark, root)) == recount
    # the same again: the run is retracted once more
    results.write_results(slices[6], root, 5)
    totals.update_totals(spark, root)
    assert _all(totals.read_totals(spark, root)) == recount


def test_totals_go_on_after_compactions(spark, slices):
    root = new_folder(spark, "compacted")

    def equal():
        totals.update_totals(spark, root)
        return _all(totals.read_totals(spark, root)) == _all(exact.read_partials(spark, root))

    results.write_results(slices[0], root, 0)
    assert equal()
    results.write_results(slices[1], root, 1)
    exact.compact_results(spark, root)  # batch 1 was not counted yet
    assert equal()
    results.write_results(slices[2], root, 2)
    exact.compact_results(spark, root)
    results.write_results(slices[3], root, 3)
    exact.compact_results(spark, root)  # the folder of batch 2 is gone before it was counted
    assert equal()
    results.write_results(slices[4], root, 4)
    assert equal()
    results.write_results(slices[5], root, 4)
    assert equal()
    fresh = totals.last_totals(spark, root)
    assert len(fresh.runs) <= 2


def test_batches_and_runs_become_one_at_once(spark, slices, monkeypatch):
    """A batch isn't written as a run of its own first."""
    root = new_folder(spark, "at_once")
    added, real = [], totals.added_up
    monkeypatch.setattr(totals, "added_up", lambda rows, by: (added.append(by), real(rows, by))[1])
    for n in range(2):
        results.write_results(slices[n], root, n)
        added.clear()
        found = totals.update_totals(spark, root)
        assert sorted(added) == sorted(exact.KEYS.values())
    assert [set(run.batches) for run in found.runs] == [{0, 1}]
    assert _all(totals.read_totals(spark, root)) == _all(exact.read_partials(spark, root))


def test_lines_of_a_batch_are_parsed_once_by_all_tasks(spark, sf_dir, monkeypatch):
    batches, real = [], results.write_results

    def write(logs, root, batch_id, keep=True):
        tasks = {r[0] for r in logs.select(F.spark_partition_id()).distinct().collect()}
        batches.append((keep, len(tasks)))
        real(logs, root, batch_id, keep)

    monkeypatch.setattr(results, "write_results", write)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # so little would be one task
    spark.conf.set(merging, False)
    try:
        QUERIES["daily_hosts_incremental"](spark, sf_dir)
    finally:
        spark.conf.unset(merging)
    assert len(batches) == 5
    assert all(keep and tasks > 1 for keep, tasks in batches)


def test_old_runs_are_deleted(spark, slices):
    root = new_folder(spark, "old")
    for n in range(4):
        results.write_results(slices[n].limit(50), root, n)
        before = totals.last_totals(spark, root)
        now = totals.update_totals(spark, root)
        if before:  # its reader has the time until the next update
            assert totals.read_totals(spark, root, before).hours.count()
    runs = commits.Files(spark, f"{root}/totals/runs").names()
    assert set(runs) == {r.place.split("/")[-1] for t in (before, now) for r in t.runs}
    assert len(commits.Files(spark, f"{root}/totals/lists").names()) == 2


# -- bitmaps ----------------------------------------------------------------


def test_bitmaps_count_hosts_exactly(spark, slices):
    root = new_folder(spark, "bits")
    for n in range(3):
        host_bitmaps.add_hosts(slices[n].filter("host <> ''"), root, n)
    before = _rows(host_bitmaps.dictionary(spark, root))
    ids = sorted(i for _, i in before)
    assert ids == list(range(len(ids)))  # no gaps
    # the last comes again with others, among them a missing host
    other = slices[3].withColumn("host", F.nullif("host", F.lit("")))
    host_bitmaps.add_hosts(other, root, 2)
    after = _rows(host_bitmaps.dictionary(spark, root))
    assert not before - after  # no host has another number
    ids = sorted(i for _, i in after)
    assert ids == list(range(len(ids)))
    counted = other
    for n in range(2):
        counted = counted.unionByName(slices[n].filter("host <> ''"))
    for grain in ("day_of_month", "date"):
        expected = _rows(traffic.daily_unique_hosts(counted, grain))
        assert _rows(host_bitmaps.daily_hosts(spark, root, grain)) == expected
    assert _rows(host_bitmaps.unique_hosts(spark, root)) == _rows(traffic.unique_host_count(counted))


def test_bitmaps_of_no_hosts(spark, slices):
    root = new_folder(spark, "nobits")
    host_bitmaps.add_hosts(slices[0].filter("false"), root, 0)
    assert host_bitmaps.unique_hosts(spark, root).first()[0] == 0
    host_bitmaps.add_hosts(slices[0].filter("host <> ''").limit(1), root, 1)
    assert host_bitmaps.unique_hosts(spark, root).first()[0] == 1


def test_numbers_of_many_partitions(spark):
    """Hosts of many tasks, beyond one bitmap's 32,768 bits."""
    root = new_folder(spark, "manybits")
    logs = spark.range(0, 70_000, 1, 13).select(
        F.concat(F.lit("h"), F.col("id") % 40_000).alias("host"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 2 as int))").alias("time"),
    )
    host_bitmaps.add_hosts(logs, root, 0)
    assert host_bitmaps.unique_hosts(spark, root).first()[0] == 40_000
    ids = host_bitmaps.dictionary(spark, root)
    assert ids.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first() == (0, 39_999, 40_000)


def test_quantiles_of_merged_sketches(spark):
    rows = spark.range(100_000).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 48 as int))").alias("time"),
        F.when(F.col("id") % 10 > 0, F.col("id") * 50_000).alias("content_size"),
    )
    hourly = sketches.hourly_size_sketches(rows)
    assert hourly.count() == 48
    for quantile, size in sketches.size_quantiles(hourly, (0.0, 0.25, 0.5, 0.99, 1.0)).collect():
        assert size == pytest.approx(quantile * 5e9, abs=sketches.RANK_ERROR * 5e9)
    by_day = sketches.size_quantiles(hourly, [0.5], "date").collect()
    assert len(by_day) == 2
    none = sketches.hourly_size_sketches(rows.filter("content_size IS NULL"))
    assert sketches.size_quantiles(none, [0.5]).collect() == []
