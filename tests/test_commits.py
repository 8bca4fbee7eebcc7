"""Committed folders: whole batches, replaced days, readers during compaction, two writers, retention."""

import datetime

import pytest
from pyspark.sql import functions as F, types as T

from sparklogs.sources import commits, folders, sinks, store
from test_jobs import parsed_frame, parsed_row

SCHEMA = T.StructType([T.StructField("v", T.LongType()), T.StructField("day", T.StringType())])


def rows(spark, *values):
    return spark.createDataFrame([(v, f"d{v % 3}") for v in values], "v bigint, day string")


def seen(spark, path):
    return sorted(r.v for r in commits.read(spark, path, SCHEMA).collect())


def test_a_batch_replaces_all_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    assert seen(spark, path) == []
    commits.write(rows(spark, 0, 1, 2), path, "a", ["day"])
    commits.write(rows(spark, 4), path, "b", ["day"])
    commits.write(rows(spark, 3), path, "a", ["day"])
    assert seen(spark, path) == [3, 4]
    commits.write(rows(spark, 3).limit(0), path, "a", ["day"])
    assert seen(spark, path) == [4]
    with pytest.raises(ValueError):
        commits.write(rows(spark, 1), path, "a/b", ["day"])


def test_a_write_that_fails_leaves_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    commits.write(rows(spark, 1), path, "a", ["day"])

    def lost(*_, **__):
        raise OSError("driver lost")

    monkeypatch.setattr(commits, "_commit", lost)
    with pytest.raises(OSError):
        commits.write(rows(spark, 7, 8), path, "a", ["day"])
    monkeypatch.undo()
    assert seen(spark, path) == [1]
    assert len(commits.vacuum(spark, path, older_than=-60)) == 1
    assert seen(spark, path) == [1] and len(folders.matching(spark, path, "batch=*/attempt=*")) == 1


def test_readers_outlive_a_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        commits.write(rows(spark, i, i + 10), path, str(i), ["day"])
    reader = commits.read(spark, path, SCHEMA)
    old = commits.entries(spark, path)
    commits.merge(commits.read(spark, path, SCHEMA, only=old).coalesce(1), path, old, ["day"])
    assert len(commits.entries(spark, path)) == 3 and reader.count() == 8 and len(seen(spark, path)) == 8
    assert commits.vacuum(spark, path) == []  # too young to go
    assert len(commits.vacuum(spark, path, older_than=-60)) == len(old) and len(seen(spark, path)) == 8
    # A merged batch: repeated rows are there already, other rows cannot replace them.
    commits.write(rows(spark, 0, 10), path, "0", ["day"], repeated=True)
    assert len(seen(spark, path)) == 8
    with pytest.raises(ValueError):
        commits.write(rows(spark, 5), path, "0", ["day"])


def test_compaction_gives_way_to_a_writer(spark, tmp_path):
    path = str(tmp_path / "t")
    commits.write(rows(spark, 1), path, "a", ["day"])
    commits.write(rows(spark, 2), path, "b", ["day"])
    old = commits.entries(spark, path)
    frame = commits.read(spark, path, SCHEMA, only=old).persist()
    frame.count()
    commits.write(rows(spark, 3), path, "a", ["day"])
    with pytest.raises(commits.Conflict):
        commits.merge(frame, path, old, ["day"])
    assert seen(spark, path) == [2, 3]


def test_two_commits_at_once_and_snapshots(spark, tmp_path, monkeypatch):
    path, write_new = str(tmp_path / "t"), folders.write_new
    commits.write(rows(spark, 100), path, "first", ["day"])

    def late(session, name, text):
        monkeypatch.setattr(folders, "write_new", write_new)
        commits.write(rows(spark, 200), path, "other", ["day"])  # takes the number in between
        return write_new(session, name, text)

    monkeypatch.setattr(folders, "write_new", late)
    commits.write(rows(spark, 300), path, "third", ["day"])
    assert seen(spark, path) == [100, 200, 300]
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 3)
    for i in range(8):
        commits.write(rows(spark, i), path, f"x{i % 5}", ["day"])
    assert seen(spark, path) == [3, 4, 5, 6, 7, 100, 200, 300]
    assert not folders.write_new(spark, f"{path}/{commits.LOG}/{1:012d}.json", "{}")


def test_a_rewritten_hot_batch_leaves_no_day_behind(spark, tmp_path):
    root = str(tmp_path / "store")
    store.append_hot(parsed_frame(spark, parsed_row(1, 1)), root, batch="x")
    store.append_hot(parsed_frame(spark, parsed_row(1, 2)), root, batch="x")
    assert store.days(spark, f"{root}/hot") == ["2026-01-02"]
    assert [str(r.event_date) for r in store.read_store(spark, root).collect()] == ["2026-01-02"]


def test_a_batch_rewritten_during_a_move_stays(spark, tmp_path, monkeypatch):
    root, write = str(tmp_path / "store"), store._write_days
    store.append_hot(parsed_frame(spark, parsed_row(1, 1), parsed_row(2, 2)), root, batch="x")

    def meanwhile(frame, path, batch):
        write(frame, path, batch)
        if path.endswith("/cold"):
            monkeypatch.setattr(store, "_write_days", write)
            store.append_hot(parsed_frame(spark, parsed_row(3, 1)), root, batch="x")

    monkeypatch.setattr(store, "_write_days", meanwhile)
    store.move_to_cold(spark, root, "2026-01-20")
    assert {(r.event_id, r.tier) for r in store.read_store(spark, root).collect()} == {
        ("event-00001", "cold"), ("event-00002", "cold"), ("event-00003", "hot")}


def test_outputs_expire_by_route_and_compact(spark, tmp_path):
    path = str(tmp_path / "routes")

    def batch(day, route, n):
        moment = F.lit(datetime.datetime(2026, 1, day))
        columns = [F.lit(None).cast("string").alias(c) for c in sinks._COMBINED if c not in ("route", "processed_at", "event_id")]
        frame = spark.range(n).select(F.concat(F.lit(f"{route}-"), "id").alias("event_id"), moment.alias("processed_at"), F.lit(route).alias("route"), *columns)
        kinds = {f.name: f.dataType for f in sinks._COMBINED_SCHEMA}
        return frame.select(*[F.col(c).cast(kinds[c]).alias(c) for c in sinks._COMBINED])

    for i, day in enumerate((1, 10, 20, 20, 24)):
        sinks.write_routes(batch(day, "parsed", 2).unionByName(batch(day, "errors", 1)).unionByName(batch(day, "dlq", 1)), path, str(i))
    assert sinks.expire_routes(spark, path, "2026-01-24") == ["errors/2026-01-01", "parsed/2026-01-01", "parsed/2026-01-10"]
    before = sinks.read_routes(spark, path)
    sinks.compact_routes(spark, path, "2026-01-20", but="3")
    sinks.compact_routes(spark, path, "2026-01-20")
    counts = {r.route: r.n for r in sinks.read_routes(spark, path).groupBy("route").agg(F.count("*").alias("n")).collect()}
    assert counts == {"parsed": 6, "errors": 4, "dlq": 5} and before.count() == 15
    days = sinks.read_parsed(spark, path).select(F.to_date("processed_at").cast("string").alias("d")).distinct().collect()
    assert {r.d for r in days} == {"2026-01-20", "2026-01-24"}


def test_the_log_does_not_grow_with_history(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(6):
        commits.write(rows(spark, i), path, "same", ["day"])
        if i % 2:
            commits.vacuum(spark, path, older_than=-60)
    commits.write(rows(spark, 77), path, "b", ["day"])
    old = commits.entries(spark, path)
    commits.merge(commits.read(spark, path, SCHEMA, only=old), path, old, ["day"])
    commits.vacuum(spark, path, older_than=-60)
    names = sorted(n for n in folders.children(spark, f"{path}/{commits.LOG}") if n.endswith(".json"))
    _, live, gone, merged = commits._load(spark, path)
    assert len(names) <= 4 and not gone and set(merged) == {"same", "b"} and seen(spark, path) == [5, 77]
    commits.vacuum(spark, path, older_than=-60, forget=-60)
    assert not commits._load(spark, path)[3] and seen(spark, path) == [5, 77]
    assert commits.vacuum(spark, str(tmp_path / "nothing"), older_than=-60) == []
