"""Alerts and lag on streams: silence, timers over restarts, positions from progress reports."""

import datetime
import json

from pyspark.sql import functions as F

from sparklogs.operators import alerts, metrics
from sparklogs.sources import files
from sparklogs.streaming import alert_state, jobs, progress
from test_jobs import RULE

START = datetime.datetime(2026, 1, 1)
EVENTS = "service string, timestamp timestamp, is_error boolean"


def put(spark, path, seconds, service="s", error=True):
    rows = [(service, START + datetime.timedelta(seconds=s), error) for s in seconds]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)


def states(spark, path, rule=RULE):
    stream = files.read_stream_files(spark, f"{path}/in", EVENTS)
    windows = jobs.error_rate_windows(stream, rule, 30)
    jobs.run_append(alert_state.stateful_alerts(windows, rule), f"{path}/out", f"{path}/ck", trigger=None).awaitTermination()
    rows = spark.read.parquet(f"{path}/out").filter("service = 's'").orderBy("eval_s").collect()
    return [(r.eval_s - 1767225600, r.state) for r in rows]


def test_silence_over_a_restart(spark, tmp_path):
    """The alert fires, the service says nothing, and the timer outlives the run that set it."""
    path = str(tmp_path)
    put(spark, f"{path}/in", range(5, 100, 10))
    put(spark, f"{path}/in", [145], "other", False)
    first = states(spark, path)
    assert first == [(30, "Pending"), (60, "Pending"), (90, "Firing")]  # 30 s of grace behind 145 s
    put(spark, f"{path}/in", [600], "other", False)
    second = states(spark, path)
    assert second == [*first, (120, "Firing"), (150, "Firing"), (180, "Normal")]
    put(spark, f"{path}/in", [610, 640], error=True)
    put(spark, f"{path}/in", [2000], "other", False)
    assert states(spark, path)[len(second):] == [(630, "Pending"), (660, "Pending"), (690, "Firing"), (720, "Normal")]


def test_silence_and_changes_in_batch(spark):
    values = [("r", "s", t, v) for t, v in ((0, 9.0), (30, 9.0), (60, 9.0), (180, 9.0), (210, 1.0), (240, 1.0), (300, 9.0))]
    frame = spark.createDataFrame(values, "rule string, service string, eval_s long, value double")
    every = alerts.with_silence(alerts.alert_states(frame, RULE))
    got = [(r.eval_s, r.state) for r in every.orderBy("eval_s").collect()]
    assert got == [(0, "Pending"), (30, "Pending"), (60, "Firing"), (90, "Normal"), (180, "Pending"), (210, "Normal"), (240, "Normal"),
                   (300, "Pending"), (330, "Normal")]
    assert [r.eval_s for r in alerts.state_changes(every).orderBy("eval_s").collect()] == [0, 60, 90, 180, 210, 300, 330]


def report(batch, end, latest, rows=7, name="reader"):
    return {"runId": "run", "name": name, "batchId": batch, "timestamp": f"2026-01-01T00:0{batch}:00.000Z", "stateOperators": [],
            "sources": [{"description": "topic source", "startOffset": None, "endOffset": end, "latestOffset": latest, "numInputRows": rows}]}


def test_positions_by_partition(spark, tmp_path):
    table = progress.ProgressTable(spark, str(tmp_path / "p"))
    table.add([json.dumps(report(0, {"raw": {"0": 5, "1": 2}}, {"raw": {"0": 9, "1": 2}})),
               json.dumps(report(1, json.dumps({"raw": {"0": 9, "1": 2}}), None))])
    table.flush()
    rows = progress.positions(progress.read_progress(spark, str(tmp_path / "p"))).orderBy("ts", "partition").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("reader", "raw", 0, 5, 9), ("reader", "raw", 1, 2, 2), ("reader", "raw", 0, 9, None), ("reader", "raw", 1, 2, None)]
    assert len(list((tmp_path / "p").glob("*.json"))) == 1  # many rows to a file


def test_positions_of_counted_sources(spark, tmp_path):
    table = progress.ProgressTable(spark, str(tmp_path / "p"))
    table.add([json.dumps(report(i, {"logOffset": i}, None, rows=10 + i, name=None)) for i in range(3)])
    table.flush()
    rows = progress.positions(progress.read_progress(spark, str(tmp_path / "p"))).orderBy("ts").collect()
    assert [(r.consumergroup, r.partition, r.committed, r.latest) for r in rows] == [("run", 0, 10, None), ("run", 0, 21, None), ("run", 0, 33, None)]


def test_positions_as_of(spark):
    def moment(second):
        return START + datetime.timedelta(seconds=second)

    ours = spark.createDataFrame([(moment(1), "g", "t", 0, 5), (moment(4), "g", "t", 0, 8), (moment(9), "h", "t", 0, 1)],
                                 "ts timestamp, consumergroup string, topic string, partition int, committed long")
    theirs = spark.createDataFrame([(moment(2), "t", 0, 10), (moment(4), "t", 0, 12), (moment(3), "t", 7, 99)],
                                   "ts timestamp, topic string, partition int, latest long")
    rows = metrics.positions_as_of(ours, theirs).orderBy("consumergroup", "ts").collect()
    assert [(r.ts.second, r.consumergroup, r.committed, r.latest) for r in rows] == [(2, "g", 5, 10), (4, "g", 8, 12), (9, "h", 1, 12)]
    lag = metrics.consumer_lag(rows and metrics.positions_as_of(ours, theirs), spark.createDataFrame([("g",)], "consumergroup string"))
    assert lag.first().lag == 4
