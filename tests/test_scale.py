"""That work is dealt to many tasks, done once, and bounded where tables grow."""

from pyspark.sql import functions as F

from sparklogs import session
from sparklogs.operators import intake, recon
from sparklogs.plans import catalog
from sparklogs.sources import files, folders


def test_rows_of_one_row_group_are_dealt_to_bounded_tasks(spark, tmp_path, monkeypatch):
    spark.range(4000).coalesce(1).write.parquet(f"{tmp_path}/rows")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")  # many splits, and the rows in one of them
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = spark.read.parquet(f"{tmp_path}/rows")
        assert rows.rdd.getNumPartitions() > 8
        monkeypatch.setattr(session, "ROWS_A_TASK", 250)
        held = [n for n in session.dealt(rows).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(held) == 4000 and len(held) == 16 and max(held) <= 300


def test_a_stream_of_one_file_is_parsed_by_all_cores(spark, tmp_path):
    spark.range(1000).selectExpr("id AS event_id").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    parts = []
    stream = catalog._dealt_stream(spark, str(tmp_path))
    stream.writeStream.foreachBatch(lambda batch, n: parts.extend(
        batch.groupBy(F.spark_partition_id()).count().toPandas()["count"])).option(
        "checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert sum(parts) == 1000 and len(parts) == spark.sparkContext.defaultParallelism


def test_batches_of_many_files_are_still_one_part_each(spark, tmp_path):
    rows = spark.range(50).selectExpr("id AS event_id")
    # The middle part has fewer rows than there are tasks, the last one none.
    parts = [F.col("event_id") < 47, F.col("event_id") >= 47, F.col("event_id") < 0]
    stream = catalog._batches(spark, f"{tmp_path}/events", rows, parts)
    seen = {}

    def note(batch, number):
        own = batch.groupBy(F.spark_partition_id().alias("task")).count().collect()
        seen[number] = (sum(r["count"] for r in own), len(own))

    stream.writeStream.foreachBatch(note).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert [seen[n][0] for n in sorted(seen)] == [47, 3, 0]
    assert seen[0][1] > 1


def test_error_trace_looks_at_each_side_once(spark):
    errors = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "event_id string")
    parsed = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "event_id string")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    assert tuple(recon.error_trace(*[f.mapInArrow(counted, f.schema) for f in (errors, parsed)]).first()) == (4, 2, 2)
    assert seen.value == 8


def test_lines_of_a_long_body_stay_in_their_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = spark.range(900).select(F.when(F.col("id") > 0, F.lit("long")).otherwise("short").alias("body"), F.lit("{}").alias("value"))
        sized = intake.check_bodies(lines.repartition(9), "body", 10)
        held = {(r.task, r.too_many): r["count"] for r in sized.groupBy(F.spark_partition_id().alias("task"), "too_many").count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(n for (_, many), n in held.items() if many) == 899
    assert max(held.values()) <= 200


def test_numbers_go_on_over_bodies_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "_BODY_IDS", 40)
    events = spark.range(100).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "1.0D AS value", "'{\"k\": 1}' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    rows = catalog.QUERIES["large_bodies"](spark, str(tmp_path)).collect()
    lines = sorted((r.line, r.id) for r in rows if r.body == "lines")
    assert lines == [(n + 1, n) for n in range(100)]
    whole = [n for n in range(100) if n % 40 != 1]
    assert sorted((r.line, r.id) for r in rows if r.body == "array") == list(enumerate(whole, 1))


def test_arrays_are_scanned_once_per_pass(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": "x,[y"}, 2]')
    rows = files.read_large_arrays(spark, str(tmp_path))
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 4
    assert sorted((r.line, r.value) for r in rows.collect()) == [(1, '{"a": "x,[y"}'), (2, "2")]


def _events(spark, path):
    spark.range(600).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "1.0D AS value",
        "'{\"k\": 1}' AS props").write.parquet(f"{path}/events.parquet")


def test_the_large_body_is_no_larger_than_it_needs_to_be(spark, tmp_path, monkeypatch):
    _events(spark, tmp_path)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    rows = {r.reason: r.lines for r in catalog.QUERIES["body_rejects"](spark, str(tmp_path)).collect()}
    assert rows["too_large"] == 1 and rows["empty_body"] == 1
    sizes = sorted(folders.sizes(spark, f"{tmp_path}/rejects").values())
    assert 1.2 * sizes[-2] < sizes[-1] < 6 * sizes[-2]


def test_topic_records_are_made_once(spark, tmp_path):
    _events(spark, tmp_path)
    rows = catalog.QUERIES["topic_roundtrip"](spark, str(tmp_path))
    assert "events.parquet" not in rows._jdf.queryExecution().executedPlan().toString()
    assert {r.topic for r in rows.collect()} >= {"parsed-logs", "dead-letter-queue"}
