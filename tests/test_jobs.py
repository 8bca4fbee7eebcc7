import datetime
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from sparklogs import fixed
from sparklogs.functions import envelope
from sparklogs.operators.pipeline import Options
from sparklogs.operators import alerts, intake, lookup, metrics, reports, sequences, wiki
from sparklogs.schemas import CHANGE_SCHEMA
from sparklogs.sources import files, kafka, sinks, store
from sparklogs.streaming import alert_state, jobs, progress

CLIENT = "client-9.example.net"
ACCESS = CLIENT + ' - - [05/Mar/2024:01:02:03 -0400] "GET /images/a.png HTTP/1.1" 200 12'


def at(text):
    return F.lit(text).cast("timestamp")


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


# ---- intake ---------------------------------------------------------------------------------

def test_envelope_of_access_lines(spark):
    built = intake.build_envelope(
        lines(spark, ACCESS + "\r\n", "   \n", "garbage with no request line"), "nginx_combined", at("2026-07-30 18:40:55"),
        tags={"run": "7"}).collect()
    first, second = sorted(built, key=lambda r: r.service)
    want = ACCESS.replace("05/Mar/2024:01:02:03 -0400", "30/Jul/2026:18:40:55 +0000")
    assert first.raw_message == want and first.service == "image-service" and first.run == "7"
    host = fixed.HOSTS[int.from_bytes(hashlib.md5(CLIENT.encode()).digest()[:4], "big") % 6]
    assert first.host == host
    assert first.event_id == hashlib.sha256(f"{host}|image-service|{want}".encode()).hexdigest()[:32]
    assert second.service == "portal-web" and second.raw_message == "garbage with no request line"


def test_service_by_path(spark):
    cases = {"/": fixed.ROOT_SERVICE}
    for segment, service in fixed.SERVICE_BY_SEGMENT.items():
        for path in (f"/{segment}", f"/{segment}/a/b", f"/{segment.upper()}/", f"//{segment.title()}?a=/b"):
            cases[path] = service
    number = int.from_bytes(hashlib.md5(b"elsewhere").digest()[:4], "big")
    cases["/Elsewhere/a"] = fixed.FALLBACK_SERVICES[number % len(fixed.FALLBACK_SERVICES)]
    frame = spark.createDataFrame([(p,) for p in cases], "p string")
    assert [r.s for r in frame.select(envelope.derive_service(F.col("p")).alias("s")).collect()] == list(cases.values())


def test_json_lines_name_themselves(spark):
    cases = {
        '{"service":"checkout-api","host":"api-07"}': ("checkout-api", "api-07"),
        '{"app":"billing","hostname":"node-3"}': ("billing", "node-3"),
        '{"service":"","service_name":7,"host":null,"node":true}': ("7", "True"),
        "not json": None, "[1,2,3]": None, '"scalar"': None, '{"other":"field"}': None, '{"service":1.5}': None,
    }
    rows = {r.raw_message: r for r in intake.build_envelope(lines(spark, *cases), "json_app", at("2026-01-01")).collect()}
    for text, names in cases.items():
        row = rows[text]
        if names:
            assert (row.service, row.host) == names
        else:
            assert row.service == "portal-web" and row.host in fixed.HOSTS
    named = intake.build_envelope(lines(spark, '{"service":"a"}'), "json_app", at("2026-01-01"), service="b", host="c").first()
    assert (named.service, named.host) == ("b", "c")


def test_bulk_body_keeps_the_good_lines(spark, tmp_path):
    body = '﻿{"service":"a","timestamp":"2026-08-07T07:00:00Z"}\n\n{ this is not json\n{"service" : "b"}\n[1]\n'
    (tmp_path / "one.ndjson").write_text(body, encoding="utf-8")
    judged = intake.judge_json(files.read_bodies(spark, str(tmp_path)), as_of=at("2026-08-07 08:00:00"))
    report = intake.intake_report(judged, "body").first()
    assert (report.accepted, report.rejected, report.timestamp_defaulted) == (2, 2, 1)
    errors = intake.intake_errors(judged, "body", "line").orderBy("line").collect()
    assert [(e.line, e.error) for e in errors] == [(2, "invalid JSON"), (4, "not a JSON object")]
    kept = [json.loads(r.value) for r in intake.accepted_lines(judged).orderBy("line").collect()]
    assert kept == [{"service": "a", "timestamp": "2026-08-07T07:00:00Z"},
                    {"service": "b", "timestamp": "2026-08-07T08:00:00.000000Z"}]
    counts = {r.reason: r.lines for r in intake.rejects_by_reason(judged).collect()}
    assert counts == {"invalid_json": 1, "not_an_object": 1}
    assert files.read_bodies(spark, str(tmp_path), largest=10).count() == 0
    assert files.oversized_bodies(spark, str(tmp_path), largest=10).count() == 1


@pytest.mark.parametrize("key", ["timestamp", "time", "@timestamp", "ts", "eventTime"])
def test_a_time_that_is_there_stays(spark, key):
    text = json.dumps({"service": "a", key: "2021-06-05T04:03:02Z"})
    row = intake.judge_json(lines(spark, text), as_of=at("2026-01-01")).first()
    assert not row.timestamp_defaulted and json.loads(row.value) == json.loads(text)


def test_lines_of_a_body_with_too_many_are_rejected_in_every_report(spark):
    rows = [("long", n, json.dumps({"ts": "2025-03-05", "n": n})) for n in range(5)] + [("short", 0, '{"n":1}')]
    sized = intake.check_bodies(spark.createDataFrame(rows, "body string, line int, value string"), "body", 3)
    judged = intake.judge_json(sized, as_of=at("2026-01-01"))
    report = {r.body: (r.accepted, r.rejected, r.timestamp_defaulted) for r in intake.intake_report(judged, "body").collect()}
    assert report == {"long": (0, 5, 0), "short": (1, 0, 1)}
    assert {r.reason: r.lines for r in intake.rejects_by_reason(judged).collect()} == {"too_many_lines": 5}
    assert [r.body for r in intake.accepted_lines(judged).collect()] == ["short"]
    assert intake.intake_errors(judged, "body", "line").count() == 5
    assert intake.intake_errors(judged, "body", "line", most=2).count() == 2


def test_a_body_beyond_ten_megabytes_is_read_whole(spark, tmp_path):
    (tmp_path / "big.ndjson").write_text("\n".join('{"n":"%s"}' % ("x" * 1000) for _ in range(12_000)))
    assert files.read_bodies(spark, str(tmp_path)).agg(F.count("*"), F.max("line")).first()[:] == (12_000, 12_000)


def test_a_broken_array_is_one_reject_and_no_file_is_read_twice(spark, tmp_path):
    texts = {"cut": '\t\n[{"a":1}, ', "empty": "[]", "array": '\n\n[{"a":1}]', "lines": '\n{"a":1}'}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows = files.read_json_array(spark, str(tmp_path)).unionByName(files.read_bodies(spark, str(tmp_path)))
    judged = intake.judge_json(rows, as_of=at("2026-01-01"))
    got = {r.body.rsplit("/", 1)[1]: (r.accepted, r.rejected) for r in intake.intake_report(judged, "body").collect()}
    assert got == {"cut": (0, 1), "array": (1, 0), "lines": (1, 0)}
    assert [r.reason for r in intake.rejects_by_reason(judged).collect()] == ["invalid_json"]


def test_json_array_bodies(spark, tmp_path):
    (tmp_path / "array.json").write_text('\n[{"a": 1}, 2,\n {"b": "x"}]\n')
    (tmp_path / "lines.json").write_text('{"a":1}\n')
    rows = files.read_json_array(spark, str(tmp_path)).orderBy("line").collect()
    assert [(r.line, r.value) for r in rows] == [(1, '{"a":1}'), (2, "2"), (3, '{"b":"x"}')]


def test_latin1_lines(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"caf\xe9\n\n  \n\x80\xff bad\n")
    assert {r.value for r in files.read_log_lines(spark, str(tmp_path)).collect()} == {"café", "\x80ÿ bad"}


# ---- topics ---------------------------------------------------------------------------------

def test_security_options():
    assert kafka.security_options({}) == {}
    with pytest.raises(ValueError, match="not one of"):
        kafka.security_options({"KAFKA_SECURITY_PROTOCOL": "TELNET"})
    with pytest.raises(ValueError, match="KAFKA_SASL_USERNAME"):
        kafka.security_options({"KAFKA_SECURITY_PROTOCOL": "SASL_SSL"})
    options = kafka.security_options({
        "KAFKA_SECURITY_PROTOCOL": "sasl_ssl", "KAFKA_SASL_USERNAME": "u", "KAFKA_SASL_PASSWORD": "p",
        "KAFKA_SSL_CA_LOCATION": "/ca.pem", "KAFKA_SSL_SKIP_VERIFY": "1"})
    assert options["kafka.security.protocol"] == "SASL_SSL" and 'username="u"' in options["kafka.sasl.jaas.config"]
    assert options["kafka.ssl.truststore.location"] == "/ca.pem"
    source = kafka.source_options("raw-logs", "b:9092", env={})
    assert source["startingOffsets"] == "earliest" and source["subscribe"] == "raw-logs"
    assert kafka.sink_options("t", "b:9092", env={})["kafka.acks"] == "all"


def test_broken_messages_are_skipped_and_counted(spark):
    frame = lines(spark, '{"event_id":"abcdefgh","service":"s","extra":1}', "{nope", "[]")
    assert [r.event_id for r in kafka.parse_rows(frame).collect()] == ["abcdefgh"]
    assert kafka.parse_rows(frame, skipped=True).filter("_broken").count() == 2


# ---- lookups, sequences ---------------------------------------------------------------------

def test_range_join_both_ways(spark):
    ranges = spark.createDataFrame([(134744064, 134877183, "US"), (134877184, 167772160, "DE")], "start long, end long, country string")
    clients = spark.createDataFrame([("8.8.8.8",), ("8.10.15.255",), ("8.10.16.0",), ("9.9.9.9",), ("11.0.0.1",), ("10.0.0.1",), (None,)], "client_ip string")
    for most in (1_000_000, 0):
        got = {r.client_ip: (r.geo_country, r.geo_source) for r in lookup.with_country(clients, ranges, most_rows=most).collect()}
        assert got == {"8.8.8.8": ("US", "maxmind"), "8.10.15.255": ("US", "maxmind"), "8.10.16.0": ("DE", "maxmind"),
                       "9.9.9.9": ("DE", "maxmind"), "11.0.0.1": (None, "unresolved"), "10.0.0.1": (None, "private"),
                       None: (None, "unresolved")}
    with pytest.raises(ValueError, match="overlap"):
        lookup.check_ranges(ranges.unionByName(ranges))


def events(spark, n=3000, hot=0.5, seed=5):
    rng = random.Random(seed)
    start = datetime.datetime(2026, 1, 1)
    rows = [(f"event-{i:06d}", "hot" if rng.random() < hot else f"s{rng.randrange(4)}",
             start + datetime.timedelta(seconds=rng.randrange(7200)), rng.choice([None, 0, 5, 17, 230])) for i in range(n)]
    return spark.createDataFrame(rows, "event_id string, service string, timestamp timestamp, response_time_ms long"), rows


def test_rolling_mean_across_blocks(spark):
    frame, rows = events(spark)
    want = {}
    for service in {r[1] for r in rows}:
        kept = sorted((r[2], r[0], r[3]) for r in rows if r[1] == service and r[3])
        for i, (_, key, _) in enumerate(kept):
            part = [v for *_, v in kept[max(0, i - 6):i + 1]]
            want[key] = sum(part) / len(part)
    got = sequences.rolling_mean(frame, ["service"], rows=7, slice_size="10 minutes", block=50)
    assert {r.event_id: pytest.approx(r.rolling_mean) for r in got.collect()} == want


def test_newest_and_capped(spark):
    frame, rows = events(spark)
    got = {r.event_id for r in sequences.newest_n(frame, ["service"], 20).collect()}
    want = {r[0] for s in {r[1] for r in rows} for r in sorted((r for r in rows if r[1] == s), key=lambda r: (r[2], r[0]))[-20:]}
    assert got == want
    capped = sequences.rate_capped(frame, per_second=1).count()
    totals = sequences.sampled_out(frame, per_second=1).agg(F.sum("kept"), F.sum("sampled_out")).first()
    assert capped == totals[0] == len({r[2] for r in rows}) and sum(totals) == len(rows)


def test_service_order(spark):
    frame, rows = events(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = sequences.in_service_order(frame).select("service", "timestamp", "event_id", F.spark_partition_id().alias("p"))
    got = [tuple(r)[:3] for r in sorted(parts.collect(), key=lambda r: r.p)]
    assert got == sorted((r[1], r[2], r[0]) for r in rows)
    assert parts.filter("service = 'hot'").select("p").distinct().count() > 1
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_share_reads_the_table_once(spark):
    frame, _ = events(spark)
    shares = reports.with_share(frame.groupBy("service").agg(F.count("*").alias("n")))
    assert sum(r.share_pct for r in shares.collect()) == pytest.approx(100, abs=0.01)


# ---- metrics, alerts ------------------------------------------------------------------------

def samples(spark, values):
    start = datetime.datetime(2026, 1, 1)
    rows = [(start + datetime.timedelta(seconds=s), "m", {"a": "x"}, float(v)) for s, v in values]
    return spark.createDataFrame(rows, "ts timestamp, metric string, labels map<string,string>, value double")


def test_counter_restart(spark):
    grown = metrics.counter_increase(samples(spark, [(10, 5), (20, 9), (50, 2), (70, 4), (130, 1)]), 60, "a")
    assert [(r.window_end.minute, r.increase) for r in grown.orderBy("window_end").collect()] == [(1, 6.0), (2, 2.0), (3, 1.0)]


def test_histogram_quantile(spark):
    frame = spark.createDataFrame([("a", v) for v in (0.01, 0.06, 0.06, 0.2, 99.0)] + [("b", 50.0)], "k string, v double")
    buckets = metrics.histogram(frame, "v", [0.05, 0.1, 0.25], "k")
    first = {r.le: r["count"] for r in buckets.filter("k = 'a'").collect()}
    assert first == {0.05: 1, 0.1: 3, 0.25: 4, None: 5}
    half = {r.k: r.quantile for r in metrics.histogram_quantile(buckets, 0.5, "k").collect()}
    assert half == {"a": pytest.approx(0.05 + 0.05 * (2.5 - 1) / 2), "b": 0.25}
    assert metrics.histogram_quantile(buckets, 0.99, "k").filter("k = 'a'").first().quantile == 0.25


def test_unknown_lag_is_null(spark):
    start = datetime.datetime(2026, 1, 1)
    rows = [(start + datetime.timedelta(minutes=i), "g", "t", 0, 10 * i, 10 * i + 5 - i) for i in range(6)]
    offsets = spark.createDataFrame(rows, "ts timestamp, consumergroup string, topic string, partition int, committed long, latest long")
    groups = spark.createDataFrame([("g",), ("idle",)], "consumergroup string")
    assert {r.consumergroup: r.lag for r in metrics.consumer_lag(offsets, groups).collect()} == {"g": 0, "idle": None}
    report = metrics.burst_report(metrics.lag_over_time(offsets, 60), at("2026-01-01 00:04:30")).first()
    assert (report.peak_lag, report.drain_seconds, report.passed) == (5, 30, True)


RULE = {"rule": "r", "threshold": 5.0, "window_seconds": 60, "min_rows": 1, "hold_seconds": 60}
EVALUATIONS = [(0, 9.0), (30, 9.0), (60, 9.0), (90, 1.0), (120, 9.0), (180, 9.0), (210, 9.0), (240, 9.0), (270, 5.0)]
STATES = ["Pending", "Pending", "Firing", "Normal", "Pending", "Pending", "Pending", "Firing", "Normal"]


def test_alert_states_batch_and_stream(spark, tmp_path):
    frame = spark.createDataFrame([("r", "s", t, v) for t, v in EVALUATIONS], "rule string, service string, eval_s long, value double")
    got = alerts.alert_states(frame, RULE).orderBy("eval_s").collect()
    assert [r.state for r in got] == STATES
    # One file per micro-batch: the state has to survive from batch to batch.
    for i in range(3):
        part = frame.filter(F.col("eval_s").between(i * 100, i * 100 + 99)).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
    stream = files.read_stream_files(spark, str(tmp_path / "in"), frame.schema, files_per_batch=1)
    run = jobs.run_append(alert_state.stateful_alerts(stream, RULE), str(tmp_path / "out"), str(tmp_path / "ck"), trigger=None)
    run.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).orderBy("eval_s").collect()
    assert [r.state for r in streamed] == STATES


# ---- store, streams -------------------------------------------------------------------------

def parsed_row(i, day, second=0, client="1.2.3.4"):
    moment = datetime.datetime(2026, 1, day, 0, 0, second)
    return {**{n: None for n in store.PARSED_COLUMNS}, "event_id": f"event-{i:05d}", "timestamp": moment, "ingested_at": moment,
            "processed_at": moment, "host": "h", "service": "s", "client_ip": client, "is_error": False, "log_level": "INFO"}


def parsed_frame(spark, *rows):
    return spark.createDataFrame([tuple(r[n] for n in store.PARSED_COLUMNS) for r in rows], store.PARSED_SCHEMA)


def test_a_batch_that_lands_during_the_move_stays(spark, tmp_path, monkeypatch):
    root, write = str(tmp_path / "store"), store._write_days
    store.append_hot(parsed_frame(spark, {**parsed_row(1, 1), "processed_at": None}), root, batch="1")

    def meanwhile(frame, path, batch):
        write(frame, path, batch)
        if path.endswith("/cold"):
            monkeypatch.setattr(store, "_write_days", write)
            store.append_hot(parsed_frame(spark, parsed_row(2, 1), {**parsed_row(1, 1), "processed_at": None}), root, batch="2")

    monkeypatch.setattr(store, "_write_days", meanwhile)
    assert store.move_to_cold(spark, root, "2026-01-20") == ["2026-01-01"]
    assert sorted(r.tier for r in store.read_store(spark, root).collect()) == ["cold", "hot", "hot"]
    # The copy without a processing time is known in cold already.
    store.move_to_cold(spark, root, "2026-01-20")
    assert [r.tier for r in store.read_store(spark, root).collect()] == ["cold", "cold"]
    assert store.days(spark, f"{root}/hot") == []


def test_day_filters_reach_the_scan(spark, tmp_path, capsys):
    root = str(tmp_path / "store")
    store.append_hot(parsed_frame(spark, parsed_row(1, 1)), root, batch="1")
    as_of = F.lit("2026-01-02").cast("timestamp")
    final = store.read_store(spark, root, final=True)
    for frame in (reports.time_filter(final, as_of), alerts.error_rate_now(final, as_of), store.kept(final, "parsed", as_of)):
        frame.explain("formatted")
        assert "event_date" in capsys.readouterr().out.split("PartitionFilters: [")[1].split("\n")[0]


def test_store_repeats_tiers_and_compacts(spark, tmp_path):
    root = str(tmp_path / "store")
    frame = parsed_frame(spark, *[parsed_row(i, 1 + i % 20) for i in range(40)])
    for _ in range(2):
        store.append_hot(frame, root, batch="1")
    assert store.read_store(spark, root).count() == 40
    assert store.move_to_cold(spark, root, "2026-01-20") == [f"2026-01-{d:02d}" for d in range(1, 13)]
    tiers = {r.tier: (r.n, r.c) for r in store.read_store(spark, root).groupBy("tier").agg(
        F.count("*").alias("n"), F.count("client_ip").alias("c")).collect()}
    assert tiers == {"cold": (24, 0), "hot": (16, 16)}
    # A late copy of a tiered day: it joins the cold day, and the same copy does not join twice.
    store.append_hot(parsed_frame(spark, parsed_row(0, 1), parsed_row(99, 1)), root, batch="2")
    assert store.move_to_cold(spark, root, "2026-01-20") == ["2026-01-01"]
    assert store.read_store(spark, root).count() == 41
    store.append_hot(parsed_frame(spark, *[{**parsed_row(14, 15), "processed_at": datetime.datetime(2026, 2, 1)}]), root, batch="3")
    store.compact_day(spark, root, "2026-01-15")
    rows = store.read_store(spark, root).filter("event_date = '2026-01-15' and event_id = 'event-00014'").collect()
    assert [r.processed_at.month for r in rows] == [2]
    assert store.drop_expired_days(spark, f"{root}/hot", "parsed", "2026-01-24") == [f"2026-01-{d:02d}" for d in range(13, 17)]


def test_day_pruning(spark, tmp_path):
    root = str(tmp_path / "store")
    store.append_hot(parsed_frame(spark, *[parsed_row(i, 1 + i % 5) for i in range(10)]), root, batch="1")
    recent = reports.time_filter(store.read_tier(spark, root, "hot"), at("2026-01-03 12:00:00"))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date" in plan.split("PartitionFilters")[1][:120]
    assert recent.count() == 4


def raw_values(spark, n, start=0):
    line = 'h.jp - - [30/Jul/2026:18:40:%02d +0000] "GET /a HTTP/1.0" %d 10'
    rows = [(json.dumps({"event_id": f"event-{i:05d}", "ingested_at": "2026-07-30T10:15:32Z", "host": "h", "service": f"s{i % 2}",
                         "source_format": "nginx_combined", "raw_message": line % (i % 60, 500 if i % 5 == 0 else 200)})
             if i % 7 else "{cut",) for i in range(start, start + n)]
    return spark.createDataFrame(rows, "value string")


def test_stream_pipeline_replaces_repeated_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        raw_values(spark, 20, i * 20).coalesce(1).write.mode("append").parquet(source)
    rows = []
    listener = progress.ProgressTable(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)

    def once(checkpoint):
        stream = files.read_stream_files(spark, source, "value string", files_per_batch=1)
        run = jobs.run_pipeline(stream, out, str(tmp_path / checkpoint), Options(salt="s"), at("2026-08-01"), trigger=None)
        run.awaitTermination()
        rows.extend(r for p in run.recentProgress for r in progress.progress_rows(json.loads(p.json)))

    once("first")
    # A lost checkpoint makes every batch come again: each replaces its own output.
    once("second")
    spark.streams.removeListener(listener)
    counts = {r.route: r.n for r in sinks.read_routes(spark, out).groupBy("route").agg(F.count("*").alias("n")).collect()}
    assert counts == {"parsed": 51, "errors": 10, "dlq": 9}
    assert sinks.read_parsed(spark, out).select("event_id").distinct().count() == 51
    assert [r.parsed + r.dlq for r in jobs.batch_ratio(spark, out).collect()] == [20, 20, 20]
    assert sum(r[3] for r in rows) == 120


def window_input(spark, path, batches):
    schema = "service string, timestamp timestamp, is_error boolean, response_time_ms long"
    for batch in batches:
        rows = [("s", datetime.datetime(2026, 1, 1, 0, m, s), False, 1) for m, s in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return files.read_stream_files(spark, path, spark.read.parquet(path).schema, files_per_batch=1)


def test_late_rows_within_grace_and_beyond(spark, tmp_path):
    # 00:20 arrives 10 s behind the newest time and counts; once the watermark is past minute 0, 00:30 does not.
    stream = window_input(spark, str(tmp_path / "in"), [[(0, 10), (0, 30)], [(0, 20)], [(5, 0)], [(5, 1)], [(0, 30)]])
    run = jobs.run_windowed_metrics(stream, str(tmp_path / "out"), str(tmp_path / "ck"), trigger=None)
    run.awaitTermination()
    got = sinks.latest_windows(spark, str(tmp_path / "out"), "service", "window_start").orderBy("window_start").collect()
    assert [(r.window_start.minute, r.request_count) for r in got] == [(0, 3), (5, 2)]


def test_streamed_evaluations_equal_batch(spark, tmp_path):
    frame, _ = events(spark, n=2000)
    frame = frame.withColumn("is_error", F.col("response_time_ms") == 230)
    rule = {**RULE, "window_seconds": 300, "min_rows": 5}
    want = {(r.service, r.eval_s, r.value) for r in alerts.error_rate_evaluations(frame, rule).collect()}
    frame.unionByName(frame.limit(1).withColumn("timestamp", at("2026-01-02 00:00:00"))).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = files.read_stream_files(spark, str(tmp_path / "in"), frame.schema)
    windows = jobs.error_rate_windows(stream, rule, 30)
    run = jobs.run_append(windows, str(tmp_path / "out"), str(tmp_path / "ck"), trigger=None)
    run.awaitTermination()
    got = {(r.service, r.eval_s, r.value) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == want


# ---- page edits -----------------------------------------------------------------------------

EDIT = {
    "meta": {"uri": "https://example.org/17", "dt": "2025-03-05T07:08:09Z", "id": "change-17", "domain": "de.wiki.example"},
    "type": "edit", "title": "Lake Constance", "user": "Ada", "bot": False, "minor": False, "server_name": "de.wiki.example",
    "wiki": "dewiki", "length": {"old": 100, "new": 140}, "comment": "corrected the depth", "timestamp": 1741158489,
}


def test_page_edits(spark, tmp_path):
    from urllib.parse import quote

    changes = [
        {}, {"meta": {"id": "x", "domain": "d"}}, {"title": "Café & Bar/a:b~c*d+e"}, {"type": "new"}, {"type": "log"},
        {"type": "categorize"}, {"comment": "Undo revision 1"}, {"bot": True, "comment": "rvv"}, {"bot": True, "comment": "x"},
        {"user": "~2026-43591-61"}, {"server_name": None, "meta": {}}, {"meta": {}, "timestamp": None}, {"length": None},
        {"comment": ""}, {"comment": "x" * 5000}, {"type": None},
    ]
    path = tmp_path / "c.json"
    path.write_text("\n".join(json.dumps({**EDIT, **c}) for c in changes))
    frame = files.read_changes(spark, str(tmp_path))
    assert frame.schema == T.StructType(CHANGE_SCHEMA.fields)
    logs = wiki.map_changes(frame, include_bots=True).collect()
    assert len(logs) == 14
    first = logs[0]
    assert (first.service, first.host, first.timestamp, first.path) == (
        "de.wiki.example", "dewiki", "2025-03-05T07:08:09Z", "/wiki/Lake_Constance")
    assert (first.response_bytes, first.wiki_bytes_delta, first.status_code, first.http_method, first.level) == (140, 40, 200, "POST", "INFO")
    assert logs[1].timestamp == "2025-03-05T07:08:09Z"
    assert logs[2].path == "/wiki/" + quote("Café_&_Bar/a:b~c*d+e", safe="/:")
    assert [(r.status_code, r.http_method) for r in logs[3:6]] == [(201, "POST"), (204, "GET"), (304, "GET")]
    assert [r.level for r in logs[6:9]] == ["WARN", "WARN", "DEBUG"]
    assert logs[9].client_ip == "~2026-43591-61"
    assert (logs[10].response_bytes, logs[10].wiki_bytes_delta) == (None, None)
    assert logs[11].message == "edit on Lake Constance" and len(logs[12].message) == 5000
    assert logs[13].wiki_change_type == "unknown"
    assert {r.reason: r.n for r in wiki.skipped_by_reason(frame).collect()} == {"bot": 2, "unmappable": 2}
    assert wiki.map_changes(frame, server_names=["other.org"]).count() == 0
