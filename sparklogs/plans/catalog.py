"""Every operator as a query over the driver tables, next to the same question in SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .. import fixed
from ..functions import enrich, envelope, jsonvalue as J, redact
from ..functions.parsers import json_app_parser, parse
from ..functions.text import iso_text
from ..functions.validate import unknown_json_fields
from ..operators import alerts, dedupe, intake, lookup, metrics, pipeline, recon, reports, sequences, wiki
from ..session import configure, scratch_path, spread, tasks_for
from ..sources import commits, files, folders, kafka, sinks, store
from ..streaming import alert_state, jobs, progress
from . import fixtures as X, oracle as O

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_AS_OF_SQL = f"TIMESTAMP '{X.AS_OF}'"


def as_of():
    return X.time(X.AS_OF)


def query(name: str, sql: str | None = None):
    """Register a query; its times come out without a zone, as UTC wall clock."""
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            frame = build(configure(spark), sf_dir)
            return frame.select(*[
                F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
                else F.col(f"`{f.name}`")
                for f in frame.schema
            ])

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return build

    return register


# ---- parse, route, dead letters -------------------------------------------------------------

_SECOND = "date_trunc('second', timestamp)"


@query("parse_access_log", f"""WITH {O.LOG_LINES}
SELECT id, id % 20 <> 0 AS ok, CASE WHEN id % 20 <> 0 THEN {_SECOND} END AS timestamp,
  CASE WHEN id % 20 <> 0 THEN coalesce(client_ip, 'unknown') END AS client_ip,
  CASE WHEN id % 20 <> 0 THEN 'GET' END AS http_method, CASE WHEN id % 20 <> 0 THEN path END AS path,
  CAST(CASE WHEN id % 20 <> 0 THEN CASE WHEN id % 97 = 5 THEN 700 ELSE status_code END END AS BIGINT) AS status_code,
  CASE WHEN id % 20 <> 0 THEN response_bytes END AS response_bytes,
  CASE WHEN id % 20 <> 0 THEN response_time_ms END AS response_time_ms,
  CASE WHEN id % 20 <> 0 THEN CASE WHEN id % 97 = 5 THEN 'ERROR' ELSE log_level END END AS log_level
FROM log_lines""")
def parse_access_log(spark, sf_dir):
    return _parsed_fields(X.log_lines(spark, sf_dir))


def _parsed_fields(lines: DataFrame, *more: str) -> DataFrame:
    p = F.col("_parse")
    fields = ["timestamp", "client_ip", "http_method", "path", "status_code", "response_bytes", "response_time_ms",
              "log_level", *more]
    ok = p["error"].isNull()
    return parse(lines).select("id", ok.alias("ok"), *[F.when(ok, p[f]).alias(f) for f in fields])


@query("parse_json_app", f"""WITH {O.JSON_LINES}, flagged AS (SELECT *, NOT cut AND NOT untimed AS ok FROM json_lines)
SELECT id, ok, CASE WHEN ok THEN {_SECOND} END AS timestamp, CASE WHEN ok THEN client_ip END AS client_ip,
  CASE WHEN ok THEN 'get' END AS http_method, CASE WHEN ok THEN path END AS path,
  CAST(CASE WHEN ok THEN status_code END AS BIGINT) AS status_code, CASE WHEN ok THEN response_bytes END AS response_bytes,
  CASE WHEN ok THEN response_time_ms END AS response_time_ms, CASE WHEN ok THEN log_level END AS log_level,
  CASE WHEN ok THEN 'call ' || id || ' by user' || id || '@example.com' END AS message,
  CASE WHEN ok THEN 't-' || id END AS trace_id
FROM flagged""")
def parse_json_app(spark, sf_dir):
    return _parsed_fields(X.json_lines(spark, sf_dir), "message", "trace_id")


@query("process_events", f"""WITH {O.RAW_JSON}
SELECT id, event_id, {_SECOND} AS timestamp, ingested_at, host, service, coalesce(client_ip, 'unknown') AS client_ip,
  substr(sha256('{X.OPTIONS.salt}|' || coalesce(client_ip, 'unknown')), 1, 32) AS client_ip_hash,
  CASE id % 6 WHEN 2 THEN 'JP' WHEN 4 THEN 'US' END AS geo_country,
  CASE id % 6 WHEN 0 THEN 'private' WHEN 2 THEN 'tld' WHEN 4 THEN 'tld' ELSE 'unresolved' END AS geo_source,
  path, status_code, response_bytes, response_time_ms, log_level, is_error
FROM raw_json WHERE stage IS NULL""")
def process_events(spark, sf_dir):
    rows = pipeline.parsed_rows(_routed_json(spark, sf_dir), extra=("id",))
    return rows.select(
        "id", "event_id", "timestamp", "ingested_at", "host", "service", "client_ip", "client_ip_hash", "geo_country",
        "geo_source", "path", "status_code", "response_bytes", "response_time_ms", "log_level", "is_error")


def _routed_json(spark, sf_dir):
    return pipeline.route(pipeline.process(pipeline.decode(X.raw_json(spark, sf_dir)), as_of(), X.OPTIONS))


def _routed_lines(spark, sf_dir):
    return pipeline.route(pipeline.process(X.log_lines(spark, sf_dir), as_of(), X.OPTIONS))


@query("process_without_client", f"""WITH {O.LOG_LINES}
SELECT id, CAST(NULL AS VARCHAR) AS client_ip, substr(sha256('{X.OPTIONS.salt}|' || coalesce(client_ip, 'unknown')), 1, 32) AS client_ip_hash
FROM log_lines WHERE stage IS NULL""")
def process_without_client(spark, sf_dir):
    options = pipeline.Options(salt=X.OPTIONS.salt, keep_client=False)
    routed = pipeline.route(pipeline.process(X.log_lines(spark, sf_dir), as_of(), options))
    return pipeline.parsed_rows(routed, extra=("id",)).select("id", "client_ip", "client_ip_hash")


@query("decode_validate_dlq", f"""WITH {O.RAW_JSON}
SELECT id, CASE WHEN stage <> 'decode' THEN event_id END AS event_id, stage AS error_stage,
  CASE WHEN stage <> 'decode' THEN service END AS service,
  CASE WHEN id % 60 IN (31, 34) THEN 'invalid JSON envelope' WHEN id % 60 = 32 THEN 'envelope is not an object'
    WHEN id % 60 = 33 THEN 'envelope missing required field(s): host'
    WHEN stage = 'decode' THEN 'envelope missing required field(s): raw_message'
    WHEN stage = 'validate' THEN 'status_code: is greater than 599'
    WHEN (id // 20) % {len(X.BROKEN_LINES)} = 2 THEN 'malformed request line ''/depot/7'''
    ELSE 'does not match access-log format' END AS error_reason,
  {_AS_OF_SQL} AS failed_at
FROM raw_json WHERE stage IS NOT NULL""")
def decode_validate_dlq(spark, sf_dir):
    dead = pipeline.dead_letters(_routed_json(spark, sf_dir), extra=("id",))
    return dead.select("id", "event_id", "error_stage", "service", "error_reason", "failed_at")


_ROUTES_SQL = """
SELECT 'parsed' AS route, CAST(NULL AS VARCHAR) AS stage, count(*) AS n FROM {t} WHERE stage IS NULL HAVING count(*) > 0
UNION ALL SELECT 'errors', NULL, count(*) FROM {t} WHERE stage IS NULL AND is_error HAVING count(*) > 0
UNION ALL SELECT 'dlq', stage, count(*) FROM {t} WHERE stage IS NOT NULL GROUP BY stage"""


def _count_routes(routed):
    return routed.groupBy("route", F.col("_stage").alias("stage")).agg(F.count("*").alias("n"))


@query("route_counts", f"WITH {O.LOG_LINES} {_ROUTES_SQL.format(t='log_lines')}")
def route_counts(spark, sf_dir):
    return _count_routes(_routed_lines(spark, sf_dir))


@query("sink_routes", f"WITH {O.LOG_LINES} {_ROUTES_SQL.format(t='log_lines')}")
def sink_routes(spark, sf_dir):
    """The three outputs written in one pass and read back."""
    path = scratch_path(spark, "routes")
    sinks.write_routes(_routed_lines(spark, sf_dir), path)
    return _count_routes(sinks.read_routes(spark, path))


_TOTALS = f"""WITH {O.LOG_LINES}
SELECT count(*) AS consumed, count(*) FILTER (stage IS NULL) AS parsed,
  count(*) FILTER (stage IS NULL AND is_error) AS errors, count(*) FILTER (stage IS NOT NULL) AS dlq,
  round(count(*) FILTER (stage IS NOT NULL) / count(*)::DOUBLE, 6) AS dlq_ratio FROM log_lines"""


@query("run_totals", _TOTALS)
def run_totals(spark, sf_dir):
    return metrics.run_totals(_routed_lines(spark, sf_dir))


@query("observed_totals", _TOTALS)
def observed_totals(spark, sf_dir):
    """The totals as counters of the job that writes the outputs."""
    processed, counters = metrics.observed(pipeline.process(X.log_lines(spark, sf_dir), as_of(), X.OPTIONS))
    sinks.write_routes(pipeline.route(processed), scratch_path(spark, "observed"))
    return metrics.observed_totals(spark, counters.get)


@query("conservation", f"""WITH {O.LOG_LINES}
SELECT count(*) AS consumed, count(*) FILTER (stage IS NULL) AS parsed,
  count(*) FILTER (stage IS NOT NULL) AS dead_lettered, true AS balanced FROM log_lines""")
def conservation(spark, sf_dir):
    return recon.conservation(X.table(spark, sf_dir, "events"), _routed_lines(spark, sf_dir))


@query("failures_over_time", f"""WITH {O.LOG_LINES}
SELECT date_trunc('hour', ingested_at) AS time, stage AS error_stage, count(*) AS n
FROM log_lines WHERE stage IS NOT NULL GROUP BY 1, 2""")
def failures_over_time(spark, sf_dir):
    """Dead letters by hour of arrival and stage."""
    lines = X.log_lines(spark, sf_dir)
    dead = pipeline.dead_letters(pipeline.route(pipeline.process(lines, F.col("ingested_at").cast("timestamp"), X.OPTIONS)))
    return metrics.failures_over_time(dead, "1 hour")


@query("failures_by_stage", f"""WITH {O.LOG_LINES}
SELECT stage AS error_stage, count(*) AS n FROM log_lines WHERE stage IS NOT NULL GROUP BY 1""")
def failures_by_stage(spark, sf_dir):
    return metrics.failures_by_stage(pipeline.dead_letters(_routed_lines(spark, sf_dir)))


@query("topic_roundtrip", f"""WITH {O.LOG_LINES}, good AS (SELECT * FROM log_lines WHERE stage IS NULL), parsed_rows AS (
  SELECT event_id, service, {_SECOND} AS timestamp, status_code, response_time_ms, is_error, CAST(NULL AS VARCHAR) AS error_stage FROM good)
SELECT '{kafka.TOPICS["parsed"]}' AS topic, * FROM parsed_rows UNION ALL SELECT '{kafka.TOPICS["errors"]}', * FROM parsed_rows WHERE is_error
UNION ALL SELECT '{kafka.TOPICS["dlq"]}', event_id, service, NULL, NULL, NULL, NULL, stage FROM log_lines WHERE stage IS NOT NULL""")
def topic_roundtrip(spark, sf_dir):
    """All outputs as topic records and back into typed rows. The records are written once, as a topic has them, and read by two readers."""
    path = scratch_path(spark, "topics")
    sinks.topic_records(_routed_lines(spark, sf_dir)).write.partitionBy("topic").parquet(path)
    records = spark.read.schema("key string, value string, topic string").parquet(path)
    is_letter = F.col("topic") == kafka.TOPICS["dlq"]
    rows = kafka.parse_rows(records.filter(~is_letter), extra=("topic",))
    typed = store.typed_rows(rows, as_of(), keep=("topic",)).select(
        "topic", "event_id", "service", "timestamp", "status_code", "response_time_ms", "is_error")
    letters = kafka.parse_dead_letters(records.filter(is_letter), extra=("topic",)).select("topic", "event_id", "service", "error_stage")
    return typed.unionByName(letters, allowMissingColumns=True)


@query("broken_messages", f"""WITH {O.LOG_LINES}, good AS (SELECT *, id % 60 AS m FROM log_lines WHERE stage IS NULL),
judged AS (SELECT *, m BETWEEN 31 AND 36 AS broken FROM good)
SELECT id, broken, CASE WHEN NOT broken THEN event_id END AS event_id, CASE WHEN NOT broken THEN status_code END AS status_code,
  CASE WHEN NOT broken THEN is_error END AS is_error, broken AS rescued, CAST(CASE WHEN m = 37 THEN 1 ELSE 0 END AS INTEGER) AS unknown FROM judged""")
def broken_messages(spark, sf_dir):
    """Records with a member of another type, trailing text, cut short, in a list or without an id are broken; others are whole."""
    routed = _routed_lines(spark, sf_dir)
    rows = pipeline.parsed_rows(routed, extra=("id",))
    value, m = F.col("value"), F.col("id") % 60
    records = rows.select("id", kafka.record_text({c: F.col(c) for c in store.PARSED_COLUMNS}).alias("value"))
    status = r'"status_code":\d+'
    spoiled = (F.when(m == 31, F.regexp_replace(value, status, '"status_code":"abc"')).when(m == 32, F.concat(value, F.lit(" trailing")))
               .when(m == 33, F.expr("left(value, length(value) - 1)")).when(m == 34, F.concat(F.lit("["), value, F.lit("]")))
               .when(m == 35, F.regexp_replace(value, '"event_id":"[^"]*",', "")).when(m == 36, F.regexp_replace(value, status, '"status_code":2.5'))
               .when(m == 37, F.regexp_replace(value, r"\}$", ',"color":"red"}')).otherwise(value))
    messages = kafka.parse_rows(records.select("id", spoiled.alias("value")), extra=("id",), skipped=True)
    return messages.select("id", F.col("_broken").alias("broken"), "event_id", "status_code", "is_error",
                           F.col("_rescued").isNotNull().alias("rescued"), F.col("_unknown").alias("unknown"))


@query("unknown_fields", f"""WITH {O.JSON_LINES}
SELECT id, CASE WHEN cut THEN NULL WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN
    concat_ws(',', CASE WHEN NOT untimed THEN '@timestamp' END, 'bytes', CASE WHEN id % 11 <> 0 THEN 'duration_ms' END,
      'hostname', 'method', 'msg', CASE WHEN id % 6 <> 5 THEN 'remote_addr' END, 'service_name', 'severity', 'status',
      'traceId', 'uri')
  ELSE concat_ws(',', 'app', 'bytes_sent', 'correlation_id', CASE WHEN id % 11 <> 0 THEN 'elapsed_ms' END, 'event',
      'http_status', CASE WHEN id % 6 <> 5 THEN 'ip' END, 'loglevel', 'node', CASE WHEN NOT untimed THEN 'ts' END, 'url', 'verb')
  END AS unknown FROM json_lines""")
def unknown_fields(spark, sf_dir):
    surplus = unknown_json_fields(F.col("raw_message"), X.JSON_NAMES[0])
    # A line that is cut short is no object, so it has no fields.
    return X.json_lines(spark, sf_dir).select("id", F.array_join(surplus, ",").alias("unknown"))


# ---- intake ---------------------------------------------------------------------------------

_INDEX = "CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT) % {n}"
_HOSTS = ", ".join(f"'{h}'" for h in fixed.HOSTS)
_FALLBACK = ", ".join(f"'{s}'" for s in fixed.FALLBACK_SERVICES)


def _envelope_sql(stamp: str) -> str:
    return rf"""
lines AS (
  SELECT id, regexp_replace(raw_message, '\[\d\d/[A-Za-z]+/\d+:\d\d:\d\d:\d\d \+0000\]', '[{stamp}]') AS raw_message,
    CASE WHEN id % 20 = 0 OR path = '/' THEN '' WHEN id % 5 = 1 THEN 'images' WHEN id % 5 = 2 THEN 'shuttle'
      WHEN id % 5 = 3 THEN 'search' ELSE 'misc-' || k END AS segment,
    regexp_extract(raw_message, '^(\S+)', 1) AS client
  FROM log_lines WHERE raw_message <> ''
), named AS (
  SELECT id, raw_message,
    CASE segment WHEN '' THEN 'portal-web' WHEN 'images' THEN 'image-service' WHEN 'shuttle' THEN 'shuttle-api'
      ELSE list_extract([{_FALLBACK}], 1 + {_INDEX.format(x='segment', n=3)}) END AS service,
    list_extract([{_HOSTS}], 1 + {_INDEX.format(x='client', n=6)}) AS host
  FROM lines
)"""


@query("envelope_ids", f"""WITH {O.LOG_LINES}, {_envelope_sql('31/Jan/2024:00:00:00 +0000')}
SELECT id, substr(sha256(host || '|' || service || '|' || raw_message), 1, 32) AS event_id, host, service, raw_message
FROM named""")
def envelope_ids(spark, sf_dir):
    lines = X.log_lines(spark, sf_dir).select("id", F.col("raw_message").alias("value"))
    built = intake.build_envelope(lines, "nginx_combined", as_of())
    return built.select("id", "event_id", "host", "service", "raw_message")


@query("json_identity", f"""WITH {O.JSON_LINES}
SELECT id, CASE WHEN cut THEN 'portal-web' ELSE service END AS service FROM json_lines""")
def json_identity(spark, sf_dir):
    lines = X.json_lines(spark, sf_dir).select("id", F.col("raw_message").alias("value"))
    return intake.build_envelope(lines, "json_app", as_of(), rewrite=False).select("id", "service")


def _judged(spark, sf_dir):
    lines = X.json_lines(spark, sf_dir).select(
        "id", F.floor(F.col("id") / 1000).alias("body"), (F.col("id") % 1000 + 1).alias("line"),
        F.col("raw_message").alias("value"))
    return intake.judge_json(lines, as_of=as_of())


@query("intake_report", f"""WITH {O.JSON_LINES}
SELECT id // 1000 AS body, count(*) FILTER (NOT cut) AS accepted, count(*) FILTER (cut) AS rejected,
  count(*) FILTER (untimed AND NOT cut) AS timestamp_defaulted FROM json_lines GROUP BY 1""")
def intake_report(spark, sf_dir):
    return intake.intake_report(_judged(spark, sf_dir), "body")


@query("intake_errors", f"""WITH {O.JSON_LINES}
SELECT id // 1000 AS body, id % 1000 + 1 AS line, 'invalid JSON' AS error FROM json_lines WHERE cut""")
def intake_errors(spark, sf_dir):
    return intake.intake_errors(_judged(spark, sf_dir), "body", "line")


@query("rejects_by_reason", f"""WITH {O.JSON_LINES}, sized AS (
  SELECT cut, count(*) OVER (PARTITION BY host) > 1600 AS too_many FROM json_lines),
reasons AS (SELECT CASE WHEN too_many THEN 'too_many_lines' WHEN cut THEN 'invalid_json' END AS reason FROM sized)
SELECT reason, count(*) AS lines FROM reasons WHERE reason IS NOT NULL GROUP BY 1""")
def rejects_by_reason(spark, sf_dir):
    lines = X.json_lines(spark, sf_dir).select(F.col("host").alias("body"), F.col("raw_message").alias("value"))
    return intake.rejects_by_reason(intake.judge_json(intake.check_bodies(lines, "body", 1600), as_of=as_of()))


@query("default_timestamp", f"""WITH {O.JSON_LINES}
SELECT id, untimed AS timestamp_defaulted, CASE WHEN untimed THEN {_AS_OF_SQL} ELSE {_SECOND} END AS timestamp
FROM json_lines WHERE NOT cut""")
def default_timestamp(spark, sf_dir):
    good = _judged(spark, sf_dir).filter(F.col("reject").isNull())
    lines = good.select("id", "timestamp_defaulted", F.col("value").alias("raw_message"), F.lit("json_app").alias("source_format"))
    return parse(lines).select("id", "timestamp_defaulted", F.col("_parse.timestamp").alias("timestamp"))


@query("intake_union", f"""WITH {O.LOG_LINES}
SELECT 'nginx_combined' AS source_format, 'raw' AS shape, count(*) FILTER (raw_message <> '') AS n FROM log_lines
UNION ALL SELECT 'json_app', 'bulk', count(*) FILTER (id % 40 <> 1) FROM log_lines""")
def intake_union(spark, sf_dir):
    raw = intake.raw_intake(X.log_lines(spark, sf_dir).select(F.col("raw_message").alias("value")), as_of(), tags={"shape": "raw"})
    lines = intake.accepted_lines(_judged(spark, sf_dir)).select("value")
    bulk = intake.build_envelope(lines, "json_app", as_of(), rewrite=False, tags={"shape": "bulk"})
    return intake.one_stream(raw, bulk).groupBy("source_format", "shape").agg(F.count("*").alias("n"))


@query("read_lines", f"""WITH {O.LOG_LINES}
SELECT count(*) AS lines, CAST(sum(length(raw_message)) AS BIGINT) AS chars FROM log_lines WHERE raw_message <> ''""")
def read_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    X.log_lines(spark, sf_dir).select("raw_message").write.text(path)
    return files.read_log_lines(spark, path).agg(F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars"))


@query("read_ndjson", f"""WITH {O.JSON_LINES}
SELECT count(*) AS lines, count(*) FILTER (NOT cut) AS accepted FROM json_lines""")
def read_ndjson(spark, sf_dir):
    path = scratch_path(spark, "ndjson")
    X.json_lines(spark, sf_dir).select("raw_message").write.text(path)
    judged = intake.judge_json(files.read_ndjson(spark, path), as_of=as_of())
    return judged.agg(F.count("*").alias("lines"), F.count_if(F.col("reject").isNull()).alias("accepted"))


@query("json_array_items", f"""WITH {O.JSON_LINES}, items AS (
  SELECT id, CAST(1 AS INTEGER) AS line, 'object' AS kind FROM json_lines WHERE NOT cut
  UNION ALL SELECT id, 2, 'number' FROM json_lines WHERE NOT cut
  UNION ALL SELECT id, 1, 'broken' FROM json_lines WHERE cut)
SELECT id, line, kind FROM items""")
def json_array_items(spark, sf_dir):
    text = F.concat(F.lit("["), F.col("raw_message"), F.lit(", "), F.col("id"), F.lit("]"))
    arrays = X.json_lines(spark, sf_dir).select("id", text.alias("text"))
    value = F.col("value")
    kind = F.when(value.startswith("{"), "object").when(value.startswith("["), "broken").otherwise("number")
    return files.json_array_items(arrays, "text").select("id", "line", kind.alias("kind"))


#: Ids of a body: more than a split, and no more than a task can write.
_BODY_IDS = 1_000_000


def _write_bodies(spark, sf_dir, path):
    """Bodies that are each one file, by ranges of ids: all lines as they are, and the whole ones as one array over many lines.

    Returns part, lines_before, items_before: what the bodies of earlier parts hold.
    """
    part = F.floor(F.col("id") / _BODY_IDS).alias("part")
    lines = X.json_lines(spark, sf_dir).select("id", part, "raw_message")
    whole = F.col("id") % 40 != 1
    parts = lookup.stored(lines.groupBy("part").agg(
        F.count("*").alias("lines"), F.count_if(whole).alias("items"), F.min(F.when(whole, F.col("id"))).alias("first"), F.max(F.when(whole, F.col("id"))).alias("last")), "parts")
    bodies = max(1, parts.count())

    def write(rows, name):
        rows.repartition(bodies, "part").sortWithinPartitions("part", "id").drop("id").write.partitionBy("part").text(f"{path}/{name}")

    write(lines, "lines")
    item = F.concat(F.when(F.col("id") == F.col("first"), "[").otherwise(" "), "raw_message", F.when(F.col("id") == F.col("last"), "]").otherwise(","))
    write(lines.filter(whole).join(F.broadcast(parts), "part").select("part", "id", item.alias("value")), "array")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in ("lines", "items")])


_CALL_ID = r"call (\d+) by user"


@query("large_bodies", f"""WITH {O.JSON_LINES}
SELECT 'lines' AS body, row_number() OVER (ORDER BY id) AS line, id, cut FROM json_lines
UNION ALL SELECT 'array', row_number() OVER (ORDER BY id), id, false FROM json_lines WHERE NOT cut""")
def large_bodies(spark, sf_dir):
    """Lines and array elements of bodies that are read from all their splits, with their numbers, which go on over bodies."""
    path = scratch_path(spark, "bodies")
    parts = F.broadcast(_write_bodies(spark, sf_dir, path))  # a row for so many lines that a task can write

    def numbered(rows, before):
        part = F.regexp_extract("body", r"/part=(-?\d+)/[^/]*$", 1).cast("bigint")
        return rows.withColumn("part", part).join(parts, "part").select((F.col("line") + F.col(before)).alias("line"), "value")

    lines = numbered(files.read_large_bodies(spark, f"{path}/lines"), "lines_before").withColumn("body", F.lit("lines"))
    items = numbered(files.read_large_arrays(spark, f"{path}/array").filter("not broken"), "items_before").withColumn("body", F.lit("array"))
    both = lines.unionByName(items)
    return both.select("body", "line", F.regexp_extract("value", _CALL_ID, 1).cast("bigint").alias("id"), (~J.is_json(F.col("value"))).alias("cut"))


@query("body_rejects", f"""WITH {O.JSON_LINES}
SELECT 'invalid_json' AS reason, count(*) AS lines FROM json_lines WHERE cut AND host <> 'web-01' HAVING count(*) > 0
UNION ALL SELECT 'too_large', 1 UNION ALL SELECT 'empty_body', 1""")
def body_rejects(spark, sf_dir):
    """Rejects of bodies by reason: refused lines, and bodies refused whole for being empty or too large."""
    path = scratch_path(spark, "rejects")
    lines = X.json_lines(spark, sf_dir).select("host", "raw_message")
    sent = {r.host: r.n for r in lines.groupBy("host").agg(F.count("*").alias("n")).collect() if r.host in fixed.HOSTS[:6]}
    others = max([n for host, n in sent.items() if host != "web-01"], default=0)
    for host in fixed.HOSTS[:6]:
        # The lines are made in all tasks; only their file is one task's work.
        own = lines.filter(F.col("host") == host).select("raw_message").repartition(1)
        # One host sends everything it has so often that its body is the largest: lines differ in length by less than a factor of two.
        times = max(3, -(-3 * others // sent.get(host, 1)))
        copies = own.select(F.explode(F.array_repeat("raw_message", times))) if host == "web-01" else own
        copies.write.mode("append").text(path)
    folders.write_new(spark, f"{path}/empty.txt", "")
    sizes = spark.read.format("binaryFile").load(path).select("length").orderBy("length").collect()
    largest = (sizes[-1].length + sizes[-2].length) // 2
    judged = intake.judge_json(files.read_large_bodies(spark, path, largest), as_of=as_of())
    return intake.rejects_by_reason(judged, files.rejected_bodies(spark, path, largest))


# ---- enrich, redact -------------------------------------------------------------------------

@query("geo_source", f"""WITH {O.PARSED}
SELECT id, CASE id % 6 WHEN 2 THEN 'JP' WHEN 4 THEN 'US' END AS country,
  CASE id % 6 WHEN 0 THEN 'private' WHEN 2 THEN 'tld' WHEN 4 THEN 'tld' ELSE 'unresolved' END AS source FROM parsed""")
def geo_source(spark, sf_dir):
    return enrich.with_geo(X.parsed(spark, sf_dir), F.col("client_ip")).select("id", "_geo.country", "_geo.source")


@query("geo_range_join", f"""WITH {O.PARSED}, placed AS (
  SELECT *, CASE WHEN id % 6 = 1 THEN CASE WHEN (id // 6) % 256 <= 127 THEN 'US'
      WHEN (id // 6) % 256 <= 200 THEN 'DE' END END AS found FROM parsed)
SELECT id, coalesce(found, CASE id % 6 WHEN 2 THEN 'JP' WHEN 4 THEN 'US' END) AS geo_country,
  CASE WHEN found IS NOT NULL THEN 'maxmind' WHEN id % 6 = 0 THEN 'private' WHEN id % 6 IN (2, 4) THEN 'tld'
    ELSE 'unresolved' END AS geo_source FROM placed""")
def geo_range_join(spark, sf_dir):
    return lookup.with_country(X.parsed(spark, sf_dir), lookup.load_ranges(X.ranges(spark))).select("id", "geo_country", "geo_source")


@query("process_events_geo", f"""WITH {O.LOG_LINES}, addressed AS (
  SELECT *, id * 7919 % 65536 AS n, CASE WHEN id % 6 = 5 THEN 10 + id // 6 % 4 ELSE id % 6 END AS kind, id // 6 % 256 AS third FROM log_lines
), placed AS (
  SELECT *, kind = 1 AND third < 192 OR kind IN (10, 11) AS found, CASE kind
    WHEN 1 THEN CASE WHEN third < 128 THEN 'US' WHEN third BETWEEN 160 AND 175 THEN 'FR' WHEN third < 192 THEN 'DE' END
    WHEN 10 THEN CASE WHEN n < 32768 THEN 'NL' WHEN n BETWEEN 36864 AND 40959 THEN NULL ELSE 'SE' END
    WHEN 11 THEN 'GB' WHEN 2 THEN 'JP' WHEN 4 THEN 'US' END AS geo_country FROM addressed
) SELECT id, CASE kind WHEN 10 THEN '2a02:26f0:' || format('{{:x}}', n) || '::1' WHEN 11 THEN '2A05:' || format('{{:x}}', n) || ':0:0:0:0:0:9'
    WHEN 12 THEN 'fe80::' || format('{{:x}}', n) WHEN 13 THEN '2600:' || format('{{:x}}', n) || '::' ELSE coalesce(client_ip, 'unknown') END AS client_ip,
  geo_country, CASE WHEN found THEN 'maxmind' WHEN kind IN (0, 12) THEN 'private' WHEN kind IN (2, 4) THEN 'tld' ELSE 'unresolved' END AS geo_source
FROM placed WHERE stage IS NULL""")
def process_events_geo(spark, sf_dir):
    """The chain with a network index: the longest network of an address of either family names its country."""
    lines = X.log_lines_from(X.table(spark, sf_dir, "events"), X.client_of_both_families())
    options = pipeline.Options(salt=X.OPTIONS.salt, networks=lookup.load_networks(X.networks(spark)))
    rows = pipeline.parsed_rows(pipeline.route(pipeline.process(lines, as_of(), options)), extra=("id",))
    return rows.select("id", "client_ip", "geo_country", "geo_source")


@query("dimension_lookup", f"""WITH {O.PARSED}
SELECT id, CASE id % 5 WHEN 1 THEN 'image-service' WHEN 2 THEN 'shuttle-api' END AS service_name,
  CASE id % 6 WHEN 2 THEN 'JP' WHEN 4 THEN 'US' END AS country FROM parsed""")
def dimension_lookup(spark, sf_dir):
    rows = X.parsed(spark, sf_dir).select(
        "id", F.regexp_extract("path", "^/+([^/?]*)", 1).alias("segment"),
        F.lower(F.substring_index("client_ip", ".", -1)).alias("tld"))
    named = lookup.lookup(rows, lookup.service_dimension(spark), "segment")
    return lookup.lookup(named, lookup.country_dimension(spark), "tld").select("id", "service_name", "country")


@query("path_group", rf"""WITH {O.PARSED}, paths AS (
  SELECT 'event' AS kind, id, path FROM parsed
  UNION ALL SELECT 'page', page_id, nullif(regexp_extract(url, '^https?://[^/]+(/[^#]*)', 1), '') FROM pages)
SELECT kind, id, CASE WHEN path LIKE '/%' THEN '/' || regexp_extract(path, '^/+([^/?]*)', 1) END AS path_group FROM paths""")
def path_group(spark, sf_dir):
    pages = X.table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"),
        F.nullif(F.regexp_extract("url", "^https?://[^/]+(/[^#]*)", 1), F.lit("")).alias("path"))
    events = X.parsed(spark, sf_dir).select(F.lit("event").alias("kind"), "id", "path")
    return events.unionByName(pages).select("kind", "id", enrich.path_group(F.col("path")).alias("path_group"))


@query("client_hash", f"""WITH {O.PARSED}
SELECT id, substr(sha256('{X.OPTIONS.salt}|' || client_ip), 1, 32) AS client_ip_hash FROM parsed""")
def client_hash(spark, sf_dir):
    return X.parsed(spark, sf_dir).select("id", redact.client_hash(F.col("client_ip"), X.OPTIONS.salt).alias("client_ip_hash"))


# The word boundary of DuckDB's patterns knows ASCII letters only: letters beyond them that touch a
# number are marked with an underscore for the number pattern, and unmarked after it.
@query("scrub_text", r"""WITH a AS (
  SELECT doc_id, regexp_replace(text, '\b[\w.+-]+@[\w-]+\.[\w.-]+\b', '[email]', 'g') AS t FROM documents
), b AS (
  SELECT doc_id, regexp_replace(t, '\b(?:Bearer|token|api[_-]?key)\s*[=:]?\s*\S{8,}', '[redacted-credential]', 'gi') AS t FROM a
), c AS (
  SELECT doc_id, regexp_replace(regexp_replace(t, '([0-9 -])([^\x00-\x7f])', '\1_' || chr(1) || '\2', 'g'),
    '([^\x00-\x7f])([0-9])', '\1' || chr(1) || '_\2', 'g') AS t FROM b
), d AS (SELECT doc_id, regexp_replace(t, '\b(?:\d[ -]?){13,19}\b', '[redacted-number]', 'g') AS t FROM c)
SELECT doc_id, replace(replace(t, '_' || chr(1), ''), chr(1) || '_', '') AS text FROM d""")
def scrub_text(spark, sf_dir):
    return spread(X.table(spark, sf_dir, "documents")).select("doc_id", redact.scrub_text(F.col("text")).alias("text"))


@query("live_class", f"""WITH {O.LOG_LINES}
SELECT CASE WHEN stage IS NOT NULL THEN 'dead_letter' WHEN is_error OR log_level IN ('ERROR', 'FATAL') OR status_code >= 500
    THEN 'error' WHEN log_level = 'WARN' THEN 'warn' ELSE 'info' END AS class, count(*) AS n FROM log_lines GROUP BY 1""")
def live_class(spark, sf_dir):
    rows = pipeline.process(X.log_lines(spark, sf_dir), as_of(), X.OPTIONS)
    kind = enrich.live_class(F.col("_stage"), F.col("log_level"), F.col("is_error"), F.col("status_code"))
    return rows.groupBy(kind.alias("class")).agg(F.count("*").alias("n"))


# ---- reports --------------------------------------------------------------------------------

_METRICS_1M = f"""WITH {O.PARSED}
SELECT service, service AS service_name, date_trunc('minute', timestamp) AS window_start,
  date_trunc('minute', timestamp) + INTERVAL 1 MINUTE AS window_end, count(*) AS request_count,
  CAST(count(*) FILTER (is_error) AS BIGINT) AS error_count,
  round(100 * (count(*) FILTER (is_error))::DOUBLE / count(*), 3) AS error_rate_pct,
  avg(response_time_ms::DOUBLE) AS avg_response_ms, max(response_time_ms) AS max_response_ms
FROM parsed GROUP BY service, date_trunc('minute', timestamp)"""


@query("service_metrics_1m", _METRICS_1M)
def service_metrics_1m(spark, sf_dir):
    return reports.service_metrics_1m(X.parsed(spark, sf_dir))


@query("flagship", f"""WITH {O.LOG_LINES}
SELECT service, service AS service_name, date_trunc('minute', timestamp) AS window_start,
  date_trunc('minute', timestamp) + INTERVAL 1 MINUTE AS window_end, count(*) AS request_count,
  CAST(count(*) FILTER (is_error) AS BIGINT) AS error_count,
  round(100 * (count(*) FILTER (is_error))::DOUBLE / count(*), 3) AS error_rate_pct,
  avg(response_time_ms::DOUBLE) AS avg_response_ms, max(response_time_ms) AS max_response_ms
FROM log_lines WHERE stage IS NULL GROUP BY service, date_trunc('minute', timestamp)""")
def flagship(spark, sf_dir):
    """Raw lines to per-minute service metrics."""
    return reports.service_metrics_1m(pipeline.parsed_rows(_routed_lines(spark, sf_dir)))


@query("minute_service", f"""WITH {O.PARSED}
SELECT date_trunc('minute', timestamp) AS minute, service, count(*) AS requests, count(*) FILTER (is_error) AS errors,
  round(100 * (count(*) FILTER (is_error))::DOUBLE / count(*), 3) AS error_rate_pct,
  round(quantile_cont(response_time_ms, 0.95)) AS p95_ms FROM parsed GROUP BY 1, 2""")
def minute_service(spark, sf_dir):
    return reports.ordered_minutes(X.parsed(spark, sf_dir))


@query("service_health", f"""WITH {O.PARSED}, health AS (
  SELECT service, count(*) AS requests, count(*) FILTER (is_error) AS errors,
    round(100 * (count(*) FILTER (is_error))::DOUBLE / count(*), 2) AS err_pct,
    round(quantile_cont(response_time_ms, 0.95)) AS p95_ms FROM parsed GROUP BY 1)
SELECT *, CASE WHEN err_pct >= 5 THEN 'red' WHEN err_pct >= 1 THEN 'yellow' ELSE 'green' END AS band FROM health""")
def service_health(spark, sf_dir):
    return reports.service_health(X.parsed(spark, sf_dir)).withColumn("band", enrich.band(F.col("err_pct"), "error_pct"))


@query("stat_tiles", f"""WITH {O.PARSED}
SELECT count(*) AS events, round(100 * (count(*) FILTER (is_error))::DOUBLE / greatest(count(*), 1), 2) AS error_rate,
  round(quantile_cont(response_time_ms, 0.95)) AS p95_ms, count(DISTINCT service) AS services
FROM parsed WHERE timestamp > TIMESTAMP '2024-01-05' AND timestamp <= TIMESTAMP '2024-01-25'
  AND service IN ('svc-1', 'svc-2', 'svc-3')""")
def stat_tiles(spark, sf_dir):
    rows = reports.time_filter(X.parsed(spark, sf_dir), X.time("2024-01-05"), X.time("2024-01-25"))
    return reports.stat_tiles(reports.services_filter(rows, ["svc-1", "svc-2", "svc-3"]))


@query("volume_ts", f"""WITH {O.PARSED}
SELECT date_trunc('hour', timestamp) AS time, service, count(*) AS requests FROM parsed GROUP BY 1, 2""")
def volume_ts(spark, sf_dir):
    return reports.volume_over_time(X.parsed(spark, sf_dir), "1 hour")


@query("error_ts", f"""WITH {O.PARSED}
SELECT date_trunc('hour', timestamp) AS time, service,
  round(100 * (count(*) FILTER (is_error))::DOUBLE / count(*), 3) AS error_rate FROM parsed GROUP BY 1, 2""")
def error_ts(spark, sf_dir):
    return reports.errors_over_time(X.parsed(spark, sf_dir), "1 hour")


@query("p95_ts", f"""WITH {O.PARSED}
SELECT date_trunc('day', timestamp) AS time, service, round(quantile_cont(response_time_ms, 0.95)) AS p95_ms
FROM parsed WHERE response_time_ms IS NOT NULL GROUP BY 1, 2""")
def p95_ts(spark, sf_dir):
    return reports.p95_over_time(X.parsed(spark, sf_dir), "1 day")


_SERVICES = [f"svc-{i}" for i in range(7)]


@query("wide_ts", f"""WITH {O.PARSED}
SELECT date_trunc('hour', timestamp) AS time,
  {", ".join(f'''count(*) FILTER (service = '{s}') AS "{s}"''' for s in _SERVICES)} FROM parsed GROUP BY 1""")
def wide_ts(spark, sf_dir):
    return reports.wide_over_time(X.parsed(spark, sf_dir), "1 hour", _SERVICES)


@query("ingest_latency", f"""WITH {O.PARSED}, lags AS (
  SELECT epoch_ms(stored_at) - epoch_ms(ingested_at) AS lag FROM parsed WHERE stored_at > {_AS_OF_SQL} - INTERVAL 20 DAY)
SELECT count(*) AS events, round(quantile_cont(lag, 0.5) / 1000, 2) AS p50_s, round(quantile_cont(lag, 0.95) / 1000, 2) AS p95_s,
  round(quantile_cont(lag, 0.99) / 1000, 2) AS p99_s, round(max(lag)::DOUBLE / 1000, 2) AS max_s FROM lags""")
def ingest_latency(spark, sf_dir):
    return reports.ingest_latency(reports.stored_since(X.parsed(spark, sf_dir), as_of(), "20 DAYS"))


@query("incident_search", f"""WITH {O.PARSED}
SELECT timestamp, event_id, service, status_code, log_level, path, response_time_ms FROM parsed
WHERE timestamp > TIMESTAMP '2024-01-10' AND service = 'svc-3' AND status_code >= 500 AND log_level = 'ERROR'
ORDER BY timestamp DESC, event_id DESC LIMIT 50""")
def incident_search(spark, sf_dir):
    found = reports.incident_search(X.parsed(spark, sf_dir), "svc-3", X.time("2024-01-10"))
    return found.select("timestamp", "event_id", "service", "status_code", "log_level", "path", "response_time_ms")


@query("recent_errors", f"""WITH {O.PARSED}
SELECT timestamp, event_id, service, status_code, path, response_time_ms FROM parsed WHERE is_error
ORDER BY timestamp DESC, event_id DESC LIMIT 100""")
def recent_errors(spark, sf_dir):
    return reports.recent_errors(X.parsed(spark, sf_dir)).select(
        "timestamp", "event_id", "service", "status_code", "path", "response_time_ms")


@query("services_24h", f"""WITH {O.PARSED}
SELECT DISTINCT service FROM parsed WHERE timestamp > {_AS_OF_SQL} - INTERVAL 24 HOUR AND timestamp <= {_AS_OF_SQL}""")
def services_24h(spark, sf_dir):
    return reports.recent_services(X.parsed(spark, sf_dir), as_of())


@query("message_search", "SELECT doc_id, n_chars FROM documents WHERE contains(text, 'the ')")
def message_search(spark, sf_dir):
    return reports.message_search(X.table(spark, sf_dir, "documents"), "the ", "text").select("doc_id", "n_chars")


@query("status_share", f"""WITH {O.PARSED}, c AS (SELECT status_code, count(*) AS n FROM parsed GROUP BY 1)
SELECT status_code, n, round(100 * n::DOUBLE / (SELECT sum(n)::DOUBLE FROM c), 3) AS share_pct FROM c""")
def status_share(spark, sf_dir):
    return reports.status_share(X.parsed(spark, sf_dir))


@query("service_skew", f"""WITH {O.PARSED}, c AS (
  SELECT service, count(*) AS n, CAST({_INDEX.format(x='service', n=6)} AS INTEGER) AS partition FROM parsed GROUP BY 1),
p AS (SELECT partition, CAST(sum(n) AS BIGINT) AS partition_n FROM c GROUP BY 1), t AS (SELECT sum(n)::DOUBLE AS total FROM c)
SELECT service, partition, n, round(100 * n::DOUBLE / total, 3) AS share_pct, partition_n,
  round(100 * partition_n::DOUBLE / total, 3) AS partition_share_pct FROM c JOIN p USING (partition), t""")
def service_skew(spark, sf_dir):
    return reports.service_skew(X.parsed(spark, sf_dir))


# ---- copies, loss, replay -------------------------------------------------------------------

@query("dedupe_final", f"""WITH {O.DUP}
SELECT id, max(processed_at) AS processed_at FROM dup GROUP BY id""")
def dedupe_final(spark, sf_dir):
    return dedupe.latest_copy(X.dup(spark, sf_dir)).select("id", "processed_at")


@query("duplicate_check", f"""WITH {O.DUP}
SELECT event_id, count(*) AS copies FROM dup GROUP BY 1 HAVING count(*) > 1 ORDER BY copies DESC, event_id LIMIT 10""")
def duplicate_check(spark, sf_dir):
    return dedupe.repeated_ids(X.dup(spark, sf_dir))


@query("duplicate_totals", f"""WITH {O.DUP}
SELECT count(*) AS total_rows, count(DISTINCT id) AS unique_rows, count(*) - count(DISTINCT id) AS duplicates FROM dup""")
def duplicate_totals(spark, sf_dir):
    return dedupe.duplicate_totals(X.dup(spark, sf_dir))


_ACKED = "acked AS (SELECT o_custkey % 5 AS run_id, o_orderkey AS seq FROM orders), " \
    "seen AS (SELECT DISTINCT l_orderkey AS seq FROM lineitem WHERE l_returnflag = 'N')"


@query("loss_recon", f"""WITH {_ACKED}
SELECT run_id, seq FROM acked WHERE seq NOT IN (SELECT seq FROM seen)""")
def loss_recon(spark, sf_dir):
    return recon.lost_records(*_acked_and_seen(spark, sf_dir), ["run_id", "seq"])


def _acked_and_seen(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 5).alias("run_id"), F.col("o_orderkey").alias("seq"))
    read = X.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'N'").select(F.col("l_orderkey").alias("seq")).distinct()
    return orders, orders.join(read, "seq", "left_semi")


@query("loss_report", f"""WITH {_ACKED}
SELECT run_id, count(*) AS acknowledged, count(*) FILTER (seq NOT IN (SELECT seq FROM seen)) AS lost FROM acked GROUP BY 1""")
def loss_report(spark, sf_dir):
    return recon.loss_report(*_acked_and_seen(spark, sf_dir), ["run_id", "seq"])


@query("dlq_replay", f"""WITH {O.JSON_LINES}
SELECT event_id, {_SECOND} AS timestamp, service FROM json_lines WHERE id % 3 = 2 AND NOT cut AND NOT untimed AND id % 2 = 0""")
def dlq_replay(spark, sf_dir):
    """A third of the clients call their time `when`, which no parser knew; odd ids were replayed before."""
    lines = X.json_lines(spark, sf_dir).withColumn("raw_message", F.replace("raw_message", F.lit('"ts":'), F.lit('"when":')))
    dead = pipeline.dead_letters(pipeline.route(pipeline.process(lines, as_of(), X.OPTIONS)))
    stored = X.parsed(spark, sf_dir).filter("id % 2 = 1").select("event_id")
    knows_when = json_app_parser(timestamp=[*fixed.TIMESTAMP_KEYS, "when"])
    again = recon.replay(dead, stored, as_of(), pipeline.Options(salt=X.OPTIONS.salt, parsers={"json_app": knows_when}))
    return again.select("event_id", "timestamp", "service")


@query("error_trace", f"""WITH {O.LOG_LINES}
SELECT count(*) AS error_copies, count(*) AS also_parsed, CAST(0 AS BIGINT) AS orphans
FROM log_lines WHERE stage IS NULL AND is_error""")
def error_trace(spark, sf_dir):
    """The stored outputs of one pass against each other."""
    path = scratch_path(spark, "trace")
    sinks.write_routes(_routed_lines(spark, sf_dir), path)
    return recon.error_trace(sinks.read_errors(spark, path), sinks.read_parsed(spark, path))


# ---- store ----------------------------------------------------------------------------------

_TIER = f"CASE WHEN timestamp < {_AS_OF_SQL} - INTERVAL 7 DAY THEN 'cold' ELSE 'hot' END"


@query("tier_report", f"""WITH {O.PARSED}
SELECT CAST(timestamp AS DATE) AS event_date, {_TIER} AS tier, count(*) AS rows, min(timestamp) AS min_time,
  max(timestamp) AS max_time FROM parsed GROUP BY 1, 2""")
def tier_report(spark, sf_dir):
    rows = X.parsed(spark, sf_dir).withColumn("event_date", F.to_date("timestamp"))
    return metrics.tier_report(store.tiered(rows, as_of()))


@query("cold_redaction", f"""WITH {O.PARSED}
SELECT id, {_TIER} AS tier, CASE WHEN {_TIER} = 'hot' THEN client_ip END AS client_ip FROM parsed""")
def cold_redaction(spark, sf_dir):
    return store.tiered(X.parsed(spark, sf_dir), as_of()).select("id", "tier", "client_ip")


@query("retention", f"WITH {O.PARSED} " + " UNION ALL ".join(
    f"SELECT '{name}' AS stream, count(*) AS rows FROM parsed WHERE timestamp >= {_AS_OF_SQL} - INTERVAL {hours} HOUR"
    for name, hours in fixed.RETENTION_HOURS.items()))
def retention(spark, sf_dir):
    rows = X.parsed(spark, sf_dir)
    return metrics.rows_per_stream(**{name: store.kept(rows, name, as_of()) for name in fixed.RETENTION_HOURS})


def _store_rows(spark, sf_dir, events=None):
    """Parsed rows as they leave the pipeline, times as ISO text, every fiftieth of them unreadable."""
    text = iso_text(F.col("timestamp"))
    rows = X.parsed_from(X.table(spark, sf_dir, "events") if events is None else events)
    broken = {"timestamp": F.when(F.col("id") % 50 == 0, "soon").otherwise(text), "ingested_at": iso_text(F.col("ingested_at"))}
    missing = [n for n in store.PARSED_COLUMNS if n not in rows.columns]
    return rows.withColumns({**{n: F.lit(None).cast("string") for n in missing}, **broken})


_HOT_SQL = f"""WITH {O.PARSED}
SELECT event_id, CASE WHEN id % 50 = 0 THEN TIMESTAMP '1970-01-01' ELSE timestamp END AS timestamp, ingested_at, service,
  host, status_code, response_time_ms, is_error, CAST(CASE WHEN id % 50 = 0 THEN DATE '1970-01-01' ELSE timestamp END AS DATE)
  AS event_date FROM parsed"""


def _hot_rows(frame):
    return frame.select(
        "event_id", "timestamp", "ingested_at", "service", "host", "status_code", "response_time_ms", "is_error", "event_date")


@query("hot_roundtrip", _HOT_SQL)
def hot_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "store")
    store.append_hot(_store_rows(spark, sf_dir), root, as_of(), batch="1")
    return _hot_rows(store.read_store(spark, root))


@query("rewrite_hot_batch", f"""WITH {O.PARSED}, moved AS (SELECT *, timestamp + INTERVAL 3 DAY AS t FROM parsed WHERE id % 3 = 0 OR id % 7 = 0)
SELECT event_id, CASE WHEN id % 7 = 0 THEN timestamp ELSE t END AS timestamp, CAST(CASE WHEN id % 7 = 0 THEN timestamp ELSE t END AS DATE) AS event_date,
  CASE WHEN id % 7 = 0 THEN 'other' ELSE 'again' END AS written FROM moved""")
def rewrite_hot_batch(spark, sf_dir):
    """A batch written again with other rows on other days replaces all it wrote, and nothing of another batch."""
    root, parsed = scratch_path(spark, "store"), X.parsed(spark, sf_dir)
    rows = _store_rows(spark, sf_dir).drop("timestamp").join(parsed.select("event_id", "timestamp"), "event_id")
    store.append_hot(rows.filter("id % 7 <> 0").withColumn("host", F.lit("first")), root, as_of(), batch="1")
    store.append_hot(rows.filter("id % 7 = 0").withColumn("host", F.lit("other")), root, as_of(), batch="2")
    later = rows.filter("id % 3 = 0 and id % 7 <> 0").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 3 DAYS"))
    store.append_hot(later.withColumn("host", F.lit("again")), root, as_of(), batch="1")
    return store.read_store(spark, root).select("event_id", "timestamp", "event_date", F.col("host").alias("written"))


@query("move_to_cold", f"""WITH {O.PARSED}, moved AS (
  SELECT *, CASE WHEN id % 50 = 0 THEN TIMESTAMP '1970-01-01' ELSE timestamp END AS t FROM parsed)
SELECT CASE WHEN CAST(t AS DATE) < DATE '2024-01-24' THEN 'cold' ELSE 'hot' END AS tier, count(*) AS rows,
  count(CASE WHEN CAST(t AS DATE) >= DATE '2024-01-24' THEN client_ip END) AS clients FROM moved GROUP BY 1""")
def move_to_cold(spark, sf_dir):
    """Whole days moved to the cold tier, then both tiers read as one table."""
    root = scratch_path(spark, "tiers")
    store.append_hot(_store_rows(spark, sf_dir), root, as_of(), batch="1")
    store.move_to_cold(spark, root, X.AS_OF[:10])
    return store.read_store(spark, root, final=True).groupBy("tier").agg(
        F.count("*").alias("rows"), F.count("client_ip").alias("clients"))


@query("storage_order", f"""WITH {O.PARSED}
SELECT service, CAST(timestamp AS DATE) AS event_date, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM parsed GROUP BY 1, 2""")
def storage_order(spark, sf_dir):
    """The files of the hot tier, read back in the order they were written in."""
    root = scratch_path(spark, "ordered")
    store.append_hot(X.parsed(spark, sf_dir).select(*[
        F.col(c) if c in X.parsed(spark, sf_dir).columns else F.lit(None).cast("string").alias(c) for c in store.PARSED_COLUMNS]), root, as_of())
    rows = store.read_tier(spark, root, "hot").select("service", "event_date", "timestamp", "event_id", F.input_file_name().alias("file"))
    found = sequences.out_of_order(rows, "file", ["timestamp", "event_id"], ["service", "event_date"])
    return found.select("service", "event_date", "rows", "out_of_order")


@query("stream_skew", f"""WITH {O.PARSED}, skewed AS (SELECT CASE WHEN id % 2 = 0 THEN 'svc-hot' ELSE service END AS service FROM parsed)
SELECT service, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order, service = 'svc-hot' AS spread FROM skewed GROUP BY 1""")
def stream_skew(spark, sf_dir):
    """One service with half of all rows is spread over tasks, and every service stays in order within them."""
    name = F.when(F.col("id") % 2 == 0, "svc-hot").otherwise(F.col("service"))
    rows = X.parsed(spark, sf_dir).withColumn("service", name).select("service", "timestamp", "event_id")
    order = ["service", "timestamp", "event_id"]
    parts = rows.repartitionByRange(8, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    found = sequences.out_of_order(parts, "part", ["timestamp", "event_id"], ["service"])
    return found.select("service", "rows", "out_of_order", (F.col("units") > 2).alias("spread"))


@query("retier", f"""WITH {O.PARSED}, aged AS (SELECT *, CASE WHEN id % 50 = 0 THEN TIMESTAMP '1970-01-01' ELSE timestamp END AS t FROM parsed)
SELECT CASE WHEN CAST(t AS DATE) < DATE '2024-01-28' THEN 'cold' ELSE 'hot' END AS tier, CAST(t AS DATE) AS event_date, count(*) AS rows,
  count(CASE WHEN CAST(t AS DATE) >= DATE '2024-01-28' THEN client_ip END) AS clients
FROM aged WHERE CAST(t AS DATE) <> DATE '2024-01-30' GROUP BY 1, 2""")
def retier(spark, sf_dir):
    """Days moved at the usual age, then once more at a lower one, and one day dropped."""
    root = scratch_path(spark, "retier")
    store.append_hot(_store_rows(spark, sf_dir), root, as_of(), batch="1")
    store.move_to_cold(spark, root, X.AS_OF[:10])
    store.move_to_cold(spark, root, X.AS_OF[:10], hot_days=3)
    store.drop_day(spark, f"{root}/hot", "2024-01-30")
    return store.read_store(spark, root).groupBy("tier", "event_date").agg(
        F.count("*").alias("rows"), F.count("client_ip").alias("clients"))


@query("stream_counts", f"""WITH {O.LOG_LINES}
SELECT 'raw' AS stream, count(*) AS rows FROM log_lines UNION ALL
SELECT 'parsed', count(*) FROM log_lines WHERE stage IS NULL UNION ALL
SELECT 'errors', count(*) FROM log_lines WHERE stage IS NULL AND is_error UNION ALL
SELECT 'dlq', count(*) FROM log_lines WHERE stage IS NOT NULL""")
def stream_counts(spark, sf_dir):
    path = scratch_path(spark, "counts")
    sinks.write_routes(_routed_lines(spark, sf_dir), path)
    return metrics.rows_per_stream(
        raw=X.log_lines(spark, sf_dir), parsed=sinks.read_parsed(spark, path), errors=sinks.read_errors(spark, path),
        dlq=sinks.read_dead_letters(spark, path))


@query("peek", f"""WITH {O.LOG_LINES}
SELECT event_id, stage AS error_stage, ingested_at AS failed_at FROM log_lines WHERE stage IS NOT NULL
ORDER BY ingested_at DESC LIMIT 20""")
def peek(spark, sf_dir):
    lines = X.log_lines(spark, sf_dir)
    dead = pipeline.dead_letters(pipeline.route(pipeline.process(lines, F.col("ingested_at").cast("timestamp"), X.OPTIONS)))
    return metrics.peek(dead.select("event_id", "error_stage", "failed_at"), 20, "failed_at")


# ---- sequences ------------------------------------------------------------------------------

@query("rolling_mean", f"""WITH {O.PARSED}
SELECT id, round(avg(response_time_ms::DOUBLE) OVER (PARTITION BY service ORDER BY timestamp, event_id
  ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 6) AS rolling_mean
FROM parsed WHERE response_time_ms IS NOT NULL AND response_time_ms <> 0""")
def rolling_mean(spark, sf_dir):
    rows = X.parsed(spark, sf_dir).select("id", "service", "timestamp", "event_id", "response_time_ms")
    return sequences.rolling_mean(rows, ["service"], slice_size="1 day", block=1000).select(
        "id", F.round("rolling_mean", 6).alias("rolling_mean"))


@query("rate_capped", f"""WITH {O.DENSE}, numbered AS (
  SELECT id, row_number() OVER (PARTITION BY timestamp ORDER BY event_id) AS n FROM dense)
SELECT id FROM numbered WHERE n <= 3""")
def rate_capped(spark, sf_dir):
    return sequences.rate_capped(X.dense(spark, sf_dir), per_second=3).select("id")


@query("sampled_out", f"""WITH {O.DENSE}
SELECT timestamp AS second, least(count(*), 3) AS kept, count(*) - least(count(*), 3) AS sampled_out FROM dense GROUP BY 1""")
def sampled_out(spark, sf_dir):
    return sequences.sampled_out(X.dense(spark, sf_dir), per_second=3)


@query("newest_n", f"""WITH {O.PARSED}, numbered AS (
  SELECT id, service, row_number() OVER (PARTITION BY service ORDER BY timestamp DESC, event_id DESC) AS n FROM parsed)
SELECT id, service FROM numbered WHERE n <= 50""")
def newest_n(spark, sf_dir):
    return sequences.newest_n(X.parsed(spark, sf_dir), ["service"], 50).select("id", "service")


@query("service_order", f"""WITH {O.PARSED}
SELECT service, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM parsed GROUP BY 1""")
def service_order(spark, sf_dir):
    """Rows of a service that come before an earlier one of the same partition: none."""
    ordered = sequences.in_service_order(X.parsed(spark, sf_dir).select("service", "timestamp", "event_id"))
    placed = ordered.select("service", "timestamp", F.monotonically_increasing_id().alias("place"))
    by_place = placed.groupBy("service", F.window("timestamp", "1 day").alias("w")).agg(
        F.count("*").alias("rows"), F.min("place").alias("first"), F.max("place").alias("last"))
    before = F.lag("last").over(Window.partitionBy("service").orderBy("w"))
    late = by_place.withColumn("late", F.coalesce(before > F.col("first"), F.lit(False)))
    return late.groupBy("service").agg(F.sum("rows").alias("rows"), F.count_if("late").alias("out_of_order"))


@query("throughput_2s", f"""WITH {O.DENSE}
SELECT time_bucket(INTERVAL 2 SECOND, timestamp) AS time, count(*) AS events, count(*) FILTER (is_error) AS failures,
  round(count(*) / 2.0::DOUBLE, 1) AS per_second,
  CAST(round(100 * (count(*) - count(*) FILTER (is_error)) / count(*)::DOUBLE) AS BIGINT) AS success_pct
FROM dense GROUP BY 1""")
def throughput_2s(spark, sf_dir):
    return metrics.throughput(X.dense(spark, sf_dir), failed="is_error")


# ---- metrics --------------------------------------------------------------------------------

@query("counters", f"""WITH {O.PARSED}
SELECT service, log_level, count(*) AS n FROM parsed GROUP BY 1, 2""")
def counters(spark, sf_dir):
    return metrics.counters_by(X.parsed(spark, sf_dir), "service", "log_level")


@query("counter_rate", f"""WITH {O.COUNTERS}, steps AS (
  SELECT event_type, {O.pane('ts', 3600)} AS end_s,
    CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY ts) = 1 THEN 0 ELSE n END AS step FROM minutes)
SELECT 'events_total' AS metric, event_type AS type, make_timestamp(end_s * 1000000) AS window_end,
  round(sum(step)::DOUBLE / 3600, 9) AS rate FROM steps GROUP BY 2, 3""")
def counter_rate(spark, sf_dir):
    rates = metrics.counter_rate(X.counter_samples(spark, sf_dir), 3600, "type")
    return rates.withColumn("rate", F.round("rate", 9))


@query("gauge_sum", f"""WITH {O.COUNTERS}
SELECT 'events_total' AS metric, event_type AS type, CAST(arg_max(value, ts) AS DOUBLE) AS value FROM samples GROUP BY 2""")
def gauge_sum(spark, sf_dir):
    return metrics.gauge_sum(X.counter_samples(spark, sf_dir), "type")


def _buckets_sql(bounds: list[float]) -> str:
    rows = [f"SELECT service, {b!r}::DOUBLE AS le, count(*) FILTER (lag <= {b!r}::DOUBLE) AS count FROM lags GROUP BY 1" for b in bounds]
    rows.append("SELECT service, NULL, count(*) FROM lags GROUP BY 1")
    return f"""lags AS (SELECT service, (epoch_us(stored_at) - epoch_us(ingested_at)) / 1000000.0::DOUBLE AS lag FROM parsed),
totals AS (SELECT service, count(*) AS total_count, round(sum(lag), 3) AS total_sum FROM lags GROUP BY 1),
buckets AS ({' UNION ALL '.join(rows)})"""


def _lag_histogram(spark, sf_dir):
    lag = reports.ingest_lag_seconds(F.col("ingested_at"), F.col("stored_at"))
    return metrics.histogram(X.parsed(spark, sf_dir), lag, fixed.INGEST_LAG_BOUNDS, "service")


@query("hist_buckets", f"""WITH {O.PARSED}, {_buckets_sql(fixed.INGEST_LAG_BOUNDS)}
SELECT service, le, count, total_count, total_sum FROM buckets JOIN totals USING (service)""")
def hist_buckets(spark, sf_dir):
    return _lag_histogram(spark, sf_dir).withColumn("total_sum", F.round("total_sum", 3))


_LISTS = {"event_seconds": (fixed.EVENT_SECONDS_BOUNDS, 100_000), "batch_seconds": (fixed.BATCH_SECONDS_BOUNDS, 100), "ingest_lag_seconds": (fixed.INGEST_LAG_BOUNDS, 25)}
_LISTS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS metric, service, {bound!r}::DOUBLE AS le, count(*) FILTER (response_time_ms / {by}.0::DOUBLE <= {bound!r}::DOUBLE) AS count FROM timed GROUP BY 2"
    if bound is not None else f"SELECT '{name}', service, NULL, count(*) FROM timed GROUP BY 2"
    for name, (bounds, by) in _LISTS.items() for bound in (*bounds, None))


@query("hist_bucket_lists", f"WITH {O.PARSED}, timed AS (SELECT * FROM parsed WHERE response_time_ms IS NOT NULL) {_LISTS_SQL}")
def hist_bucket_lists(spark, sf_dir):
    """The three histograms of a job, each over its own bounds."""
    rows, out = X.parsed(spark, sf_dir), []
    for name, (bounds, by) in _LISTS.items():
        buckets = metrics.histogram(rows, F.col("response_time_ms") / float(by), bounds, "service")
        out.append(buckets.select(F.lit(name).alias("metric"), "service", "le", "count"))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("threshold_bands", f"""WITH {O.PARSED}, minutes AS (
  SELECT service, date_trunc('day', timestamp) AS day, round(100 * (count(*) FILTER (is_error))::DOUBLE / count(*), 2) AS err_pct,
    max(response_time_ms) / 100.0::DOUBLE AS lag FROM parsed GROUP BY 1, 2)
SELECT service, day, err_pct, lag, CASE WHEN err_pct >= 5 THEN 'red' ELSE 'green' END AS line,
  CASE WHEN lag >= 10 THEN 'red' WHEN lag IS NOT NULL THEN 'green' END AS lag_band FROM minutes""")
def threshold_bands(spark, sf_dir):
    """Scales without yellow: the line of the error panel and the one of the latency panel."""
    day = F.date_trunc("day", F.col("timestamp")).alias("day")
    rows = X.parsed(spark, sf_dir).groupBy("service", day).agg(
        reports.error_pct(2).alias("err_pct"), (F.max("response_time_ms") / 100.0).alias("lag"))
    return rows.withColumns({"line": enrich.band(F.col("err_pct"), "error_pct_line"), "lag_band": enrich.band(F.col("lag"), "ingest_lag_seconds")})


@query("hist_quantile", f"""WITH {O.PARSED}, {_buckets_sql(fixed.INGEST_LAG_BOUNDS)}, ranked AS (
  SELECT *, 0.95::DOUBLE * max(count) OVER (PARTITION BY service) AS rank,
    coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(count) OVER w, 0) AS below
  FROM buckets WINDOW w AS (PARTITION BY service ORDER BY le NULLS LAST)
), hit AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY le NULLS LAST) AS n FROM ranked WHERE count >= rank)
SELECT service, round(CASE WHEN le IS NULL THEN low ELSE low + (le - low) * (rank - below) / (count - below) END, 6) AS quantile
FROM hit WHERE n = 1""")
def hist_quantile(spark, sf_dir):
    found = metrics.histogram_quantile(_lag_histogram(spark, sf_dir), 0.95, "service")
    return found.withColumn("quantile", F.round("quantile", 6))


@query("label_filter", f"""WITH {O.OFFSETS}
SELECT consumergroup, count(*) AS n FROM offsets WHERE consumergroup NOT LIKE '\\_%' ESCAPE '\\' GROUP BY 1""")
def label_filter(spark, sf_dir):
    visible = metrics.label_matches(X.offset_samples(spark, sf_dir), "consumergroup", "_.*", exclude=True)
    return metrics.counters_by(visible, "consumergroup")


def _groups(spark):
    return spark.createDataFrame([(g,) for g in X.CONSUMER_GROUPS], "consumergroup string")


@query("lag_by_group", f"""WITH {O.OFFSETS}, last AS (
  SELECT consumergroup, partition, arg_max(latest - committed, ts) AS lag FROM offsets GROUP BY 1, 2)
SELECT g AS consumergroup, (SELECT CAST(sum(lag) AS BIGINT) FROM last WHERE consumergroup = g) AS lag
FROM (VALUES ('parser'), ('store'), ('idle')) AS x(g)""")
def lag_by_group(spark, sf_dir):
    return metrics.consumer_lag(X.offset_samples(spark, sf_dir), _groups(spark))


@query("burst_drain", f"""WITH {O.OFFSETS}, last AS (
  SELECT consumergroup, partition, {O.pane('ts', 3600)} AS end_s, arg_max(latest - committed, ts) AS lag FROM offsets GROUP BY 1, 2, 3),
lags AS (SELECT consumergroup, end_s, CAST(sum(lag) AS BIGINT) AS lag FROM last GROUP BY 1, 2),
r AS (SELECT consumergroup, max(lag) AS peak_lag,
  min(CASE WHEN lag <= 0 AND end_s >= 1704499200 THEN end_s END) - 1704499200 AS drain_seconds FROM lags GROUP BY 1)
SELECT *, coalesce(drain_seconds < 86400, false) AS passed FROM r""")
def burst_drain(spark, sf_dir):
    lags = metrics.lag_over_time(X.offset_samples(spark, sf_dir), 3600)
    return metrics.burst_report(lags, X.time("2024-01-06 00:00:00"), 86400)


# ---- alerts ---------------------------------------------------------------------------------

_ERROR_EVALS = f"""panes AS (
  SELECT service, {O.pane()} AS pane, count(*) AS n, count(*) FILTER (is_error) AS e FROM dense GROUP BY 1, 2
), spread AS (SELECT service, pane + i * 30 AS eval_s, n, e FROM panes, range(0, 10) AS r(i)
), evals AS (
  SELECT service, eval_s, round(100 * sum(e)::DOUBLE / sum(n), 3) AS value FROM spread GROUP BY 1, 2 HAVING sum(n) >= 20
)"""


@query("alert_input", f"""WITH {O.DENSE}
SELECT service, round(100 * (count(*) FILTER (is_error))::DOUBLE / count(*), 3) AS error_rate, count(*) AS requests FROM dense
WHERE timestamp > TIMESTAMP '2024-01-01 00:15:00' AND timestamp <= TIMESTAMP '2024-01-01 00:20:00' GROUP BY 1 HAVING count(*) >= 20""")
def alert_input(spark, sf_dir):
    return alerts.error_rate_now(X.dense(spark, sf_dir), X.time("2024-01-01 00:20:00"))


_STATES = f"WITH {O.DENSE}, {_ERROR_EVALS}, {O.states(5, 60)} SELECT service, eval_s, value, held_seconds, state FROM states"


def _state_columns(states):
    return states.select("service", "eval_s", "value", "held_seconds", "state")


@query("alert_state", _STATES)
def alert_state_query(spark, sf_dir):
    rule = fixed.ERROR_RATE_RULE
    return _state_columns(alerts.alert_states(alerts.error_rate_evaluations(X.dense(spark, sf_dir), rule), rule))


_LAG_RULE = {**fixed.LAG_RULE, "threshold": 12}


# Changes of state only: a lagging group has an evaluation every 30 seconds for as long as it is looked at.
_LAG_CHANGES = f"""WITH {O.OFFSETS}, panes AS (
  SELECT consumergroup, partition, {O.pane('ts')} AS pane, arg_max(latest - committed, ts) AS lag FROM offsets
  WHERE consumergroup <> '_internal' GROUP BY 1, 2, 3
), spread AS (SELECT consumergroup, partition, pane + i * 30 AS eval_s, pane, lag FROM panes, range(0, 10) AS r(i)
), known AS (SELECT consumergroup, partition, eval_s, arg_max(lag, pane) AS lag FROM spread GROUP BY 1, 2, 3
), evals AS (SELECT consumergroup AS service, eval_s, CAST(sum(lag) AS DOUBLE) AS value FROM known GROUP BY 1, 2
), {O.states(12, 180)}, follow AS (
  SELECT *, lead(eval_s) OVER (PARTITION BY service ORDER BY eval_s) AS next_s FROM states
), every AS (SELECT service, eval_s, value, held_seconds, state FROM states UNION ALL
  SELECT service, eval_s + 30, NULL, 0, 'Normal' FROM follow WHERE state <> 'Normal' AND next_s IS DISTINCT FROM eval_s + 30
), changes AS (SELECT *, lag(state) OVER w AS last, lag(eval_s) OVER w AS last_s FROM every WINDOW w AS (PARTITION BY service ORDER BY eval_s))
SELECT service, eval_s, value, held_seconds, state FROM changes
WHERE state <> CASE WHEN last_s = eval_s - 30 THEN last ELSE 'Normal' END"""


@query("lag_alert", _LAG_CHANGES)
def lag_alert(spark, sf_dir):
    states = alerts.alert_states(alerts.lag_evaluations(X.offset_samples(spark, sf_dir), _LAG_RULE), _LAG_RULE)
    return _state_columns(alerts.state_changes(alerts.with_silence(states)))


_DLQ_RULE = {**fixed.DLQ_RULE, "threshold": 1.0}


_DLQ_STATES = f"""WITH {O.DENSE}, panes AS (
  SELECT {O.pane()} AS pane, count(*) AS n FROM dense WHERE id % 20 = 0 OR (id // 2000 % 3 = 1 AND id % 2 = 0) GROUP BY 1
), spread AS (SELECT pane + i * 30 AS eval_s, n FROM panes, range(0, 10) AS r(i)
), evals AS (SELECT 'all' AS service, eval_s, sum(n)::DOUBLE / 300 AS value FROM spread GROUP BY 2
), {O.states(1.0, 120)} SELECT service, eval_s, value, held_seconds, state FROM states"""


def _dense_dead(rows):
    burst = (F.floor(F.col("id") / 2000) % 3 == 1) & (F.col("id") % 2 == 0)
    return rows.filter((F.col("id") % 20 == 0) | burst)


@query("dlq_alert", _DLQ_STATES)
def dlq_alert(spark, sf_dir):
    dead = _dense_dead(X.dense(spark, sf_dir))
    return _state_columns(alerts.alert_states(alerts.dlq_evaluations(dead, "timestamp", _DLQ_RULE), _DLQ_RULE))


# ---- page edits -----------------------------------------------------------------------------

@query("wiki_map", f"""WITH {O.CHANGES}
SELECT p AS page_id, strftime(make_timestamp((p * 60 + 1704067200) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
  server_name AS service, coalesce(wiki, 'wikimedia') AS host, level,
  CASE WHEN coalesce(comment, '') <> '' THEN comment ELSE kind || ' on ' || title END AS message,
  usr AS client_ip, CASE WHEN kind IN ('edit', 'new') THEN 'POST' ELSE 'GET' END AS http_method,
  '/wiki/' || replace(replace(url_encode(replace(title, ' ', '_')), '%2F', '/'), '%3A', ':') AS path,
  CAST(CASE kind WHEN 'new' THEN 201 WHEN 'log' THEN 204 WHEN 'categorize' THEN 304 ELSE 200 END AS INTEGER) AS status_code,
  CASE WHEN has_length THEN p * 10 + p % 13 - 6 END AS response_bytes, 'm-' || p AS trace_id, kind AS wiki_change_type,
  bot AS wiki_is_bot, p % 2 = 0 AS wiki_is_minor, CASE WHEN has_length THEN p % 13 - 6 END AS wiki_bytes_delta
FROM mapped""")
def wiki_map(spark, sf_dir):
    return wiki.map_changes(X.changes(spark, sf_dir), extra=("page_id",), include_bots=True)


@query("wiki_skips", f"""WITH {O.CHANGES}, reasons AS (
  SELECT CASE WHEN bot THEN 'bot' WHEN server_name IS NULL OR NOT timed THEN 'unmappable' END AS reason FROM changes)
SELECT reason, count(*) AS n FROM reasons WHERE reason IS NOT NULL GROUP BY 1""")
def wiki_skips(spark, sf_dir):
    return wiki.skipped_by_reason(X.changes(spark, sf_dir))


@query("wiki_summary", f"""WITH {O.CHANGES}
SELECT server_name AS service, count(*) AS edits, count(*) FILTER (level = 'WARN') AS reverts, count(DISTINCT usr) AS editors
FROM mapped WHERE NOT bot GROUP BY 1""")
def wiki_summary(spark, sf_dir):
    return wiki.summary(wiki.map_changes(X.changes(spark, sf_dir)))


@query("editor_kinds", f"""WITH {O.CHANGES}
SELECT CASE p % 4 WHEN 0 THEN 'named' WHEN 1 THEN 'temporary' WHEN 2 THEN 'ipv4' ELSE 'hidden' END AS kind, count(*) AS n
FROM mapped GROUP BY 1""")
def editor_kinds(spark, sf_dir):
    return wiki.editor_kinds(wiki.map_changes(X.changes(spark, sf_dir), include_bots=True))


@query("wiki_parsed", f"""WITH {O.CHANGES}
SELECT p AS page_id, server_name AS service, make_timestamp((p * 60 + 1704067200) * 1000000) AS timestamp, level AS log_level
FROM mapped WHERE NOT bot""")
def wiki_parsed(spark, sf_dir):
    """Page edits through intake and pipeline."""
    lines = wiki.as_json_lines(wiki.map_changes(X.changes(spark, sf_dir), extra=("page_id",)), extra=("page_id",))
    raw = intake.build_envelope(lines, "json_app", as_of(), rewrite=False)
    rows = pipeline.parsed_rows(pipeline.route(pipeline.process(raw, as_of(), X.OPTIONS)), extra=("page_id",))
    return rows.select("page_id", "service", "timestamp", "log_level")


@query("wiki_source", f"""WITH {O.CHANGES} SELECT count(*) AS n, count(server_name) AS named FROM changes""")
def wiki_source(spark, sf_dir):
    path = scratch_path(spark, "changes")
    X.changes(spark, sf_dir).drop("page_id").write.json(path)
    return files.read_changes(spark, path).agg(F.count("*").alias("n"), F.count("server_name").alias("named"))


# ---- streams --------------------------------------------------------------------------------

def _event_stream(spark, sf_dir):
    # A stream watches folders; a pattern also takes a table that is a single file.
    schema = X.table(spark, sf_dir, "events").schema
    return files.read_stream_files(spark, f"{sf_dir}/events.parque[t]", schema)


def _dealt_stream(spark, sf_dir):
    """The stream of events for work that is bound by the processor; splits of its files do not tell where the rows are."""
    return _event_stream(spark, sf_dir).repartition(tasks_for(X.table(spark, sf_dir, "events")))


def _finish(running) -> None:
    running.awaitTermination()


@query("service_metrics_1m_stream", _METRICS_1M)
def service_metrics_1m_stream(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    _finish(jobs.run_windowed_metrics(
        X.parsed_from(_event_stream(spark, sf_dir)), f"{path}/out", f"{path}/checkpoint", trigger=None))
    return sinks.latest_windows(spark, f"{path}/out", "service", "window_start")


@query("hot_stream", _HOT_SQL)
def hot_stream(spark, sf_dir):
    """Topic records into the hot table by a stream, then read as one table."""
    path = scratch_path(spark, "hot-stream")
    rows = _store_rows(spark, sf_dir, _dealt_stream(spark, sf_dir))
    records = rows.select(F.col("service").alias("key"), F.to_json(F.struct(*store.PARSED_COLUMNS)).alias("value"))
    _finish(jobs.run_hot_store(records, f"{path}/store", f"{path}/checkpoint", as_of(), trigger=None))
    return _hot_rows(store.read_store(spark, f"{path}/store"))


_KEPT_SQL = " UNION ALL ".join(
    f"SELECT '{route}' AS route, day AS event_date FROM arrived WHERE {which} "
    f"AND day >= DATE '{X.AS_OF[:10]}' - {fixed.RETENTION_HOURS[stream] // 24}"
    for route, stream, which in (("parsed", "parsed", "stage IS NULL"), ("errors", "errors", "stage IS NULL AND is_error"),
                                 ("dlq", "dead_letters", "stage IS NOT NULL")))


@query("stream_retention", f"""WITH {O.LOG_LINES}, arrived AS (
  SELECT *, CASE WHEN stage = 'decode' THEN DATE '{X.AS_OF[:10]}' ELSE CAST(ingested_at AS DATE) END AS day FROM log_lines),
kept AS ({_KEPT_SQL}) SELECT route, event_date, count(*) AS rows FROM kept GROUP BY 1, 2""")
def stream_retention(spark, sf_dir):
    """The outputs of a stream after their expired days were dropped and one day was compacted."""
    path = scratch_path(spark, "retention")
    arrived = F.coalesce(F.col("ingested_at").cast("timestamp"), as_of())  # not known where decoding fails
    lines = X.log_lines_from(_dealt_stream(spark, sf_dir)).select(F.to_json(F.struct(
        "event_id", "ingested_at", "host", "service", "source_format", "raw_message")).alias("value"))
    _finish(jobs.run_pipeline(lines, f"{path}/out", f"{path}/checkpoint", X.OPTIONS, arrived, trigger=None))
    sinks.expire_routes(spark, f"{path}/out", X.AS_OF[:10])
    sinks.compact_routes(spark, f"{path}/out", "2024-01-29")
    rows = sinks.read_routes(spark, f"{path}/out")
    return rows.groupBy("route", F.to_date("processed_at").alias("event_date")).agg(F.count("*").alias("rows"))


@query("compacted_windows", _METRICS_1M)
def compacted_windows(spark, sf_dir):
    """The windowed metrics over a restart of their stream, compacted before and after it."""
    path, keys = scratch_path(spark, "compacted"), ("service", "window_start")
    events = X.table(spark, sf_dir, "events")
    # The cut is within a minute, so that windows have versions on both sides of the restart.
    cut = F.col("ts").cast("timestamp") < X.time("2024-01-15 12:30:30")
    for part in (cut, ~cut):
        events.filter(part).write.mode("append").parquet(f"{path}/events")
        stream = files.read_stream_files(spark, f"{path}/events", events.schema)
        _finish(jobs.run_windowed_metrics(X.parsed_from(stream), f"{path}/out", f"{path}/checkpoint", trigger=None))
        before = sinks.latest_windows(spark, f"{path}/out", *keys)
        sinks.compact_windows(spark, f"{path}/out", *keys)
        if before.count() != sinks.latest_windows(spark, f"{path}/out", *keys).count():
            raise ValueError("a reader that began before the compaction sees other windows")
    commits.vacuum(spark, f"{path}/out", older_than=0)
    return sinks.latest_windows(spark, f"{path}/out", *keys)


@query("stream_parse", f"WITH {O.RAW_JSON} {_ROUTES_SQL.format(t='raw_json')}")
def stream_parse(spark, sf_dir):
    path = scratch_path(spark, "pipeline")
    _finish(jobs.run_pipeline(
        X.raw_json_from(_dealt_stream(spark, sf_dir)).select("value"), f"{path}/out", f"{path}/checkpoint", X.OPTIONS,
        as_of(), trigger=None))
    return _count_routes(sinks.read_routes(spark, f"{path}/out"))


_ARRIVAL_1M = _METRICS_1M.replace("date_trunc('minute', timestamp)", "date_trunc('minute', ingested_at)")


@query("metrics_by_arrival", _ARRIVAL_1M)
def metrics_by_arrival(spark, sf_dir):
    """The windowed metrics by the time of arrival instead of the event's own."""
    path = scratch_path(spark, "arrival")
    _finish(jobs.run_windowed_metrics(
        X.parsed_from(_event_stream(spark, sf_dir)), f"{path}/out", f"{path}/checkpoint", time_col="ingested_at", trigger=None))
    return sinks.latest_windows(spark, f"{path}/out", "service", "window_start")


def _batches(spark, path, frame, parts):
    """The rows as a folder of files, part after part, for a stream that takes the files of one part per batch."""
    tasks, total = tasks_for(frame), 0
    for part in parts:
        frame.filter(part).repartition(tasks).write.mode("append").parquet(path)
        total += tasks
        # Tasks without rows write no file; empty ones in their place keep the number of files the same.
        for _ in range(total - len(folders.sizes(spark, path))):
            frame.limit(0).coalesce(1).write.mode("append").parquet(path)
    return files.read_stream_files(spark, path, frame.schema, files_per_batch=tasks)


@query("late_rows", """SELECT count(*) FILTER (ts >= TIMESTAMP '2024-01-10') AS admitted, count(*) FILTER (ts < TIMESTAMP '2024-01-10') AS dropped,
  count(*) AS read FROM events""")
def late_rows(spark, sf_dir):
    """Rows of earlier days that come after later ones are dropped, and the run says how many it read."""
    path, events = scratch_path(spark, "late"), X.table(spark, sf_dir, "events")
    late = F.col("ts").cast("timestamp") < X.time("2024-01-10 00:00:00")
    # The watermark moves between batches, so the first two are admitted whole.
    odd = F.col("event_id") % 2 == 1
    stream = _batches(spark, f"{path}/events", events, (~late & odd, ~late & ~odd, late))
    run = jobs.run_windowed_metrics(X.parsed_from(stream), f"{path}/out", f"{path}/checkpoint", trigger=None)
    _finish(run)
    table = progress.ProgressTable(spark, f"{path}/progress")
    table.add([p.json for p in run.recentProgress])
    table.flush()
    read = progress.read_progress(spark, f"{path}/progress").agg(F.sum("input_rows")).scalar()
    admitted = sinks.latest_windows(spark, f"{path}/out", "service", "window_start").agg(
        F.coalesce(F.sum("request_count"), F.lit(0)).cast("bigint").alias("admitted"))
    return admitted.select("admitted", (read - F.col("admitted")).alias("dropped"), read.alias("read"))


@query("batch_dlq_ratio", f"""WITH {O.RAW_JSON}, b AS (SELECT CAST(id % 3 AS VARCHAR) AS batch, stage FROM raw_json)
SELECT batch, count(*) FILTER (stage IS NULL) AS parsed, count(*) FILTER (stage IS NOT NULL) AS dlq,
  round((count(*) FILTER (stage IS NOT NULL))::DOUBLE / count(*), 6) AS dlq_ratio FROM b GROUP BY 1""")
def batch_dlq_ratio(spark, sf_dir):
    """Dead letters as a share of each micro-batch of the pipeline."""
    path, events = scratch_path(spark, "ratio"), X.table(spark, sf_dir, "events")
    stream = _batches(spark, f"{path}/events", events, [F.col("event_id") % 3 == i for i in range(3)])
    _finish(jobs.run_pipeline(X.raw_json_from(stream).select("value"), f"{path}/out", f"{path}/checkpoint", X.OPTIONS, as_of(), trigger=None))
    return jobs.batch_ratio(spark, f"{path}/out")


@query("stream_dedupe", f"WITH {O.PARSED} SELECT event_id, service FROM parsed")
def stream_dedupe(spark, sf_dir):
    path = scratch_path(spark, "dedupe")
    rows = X.dup_from(_event_stream(spark, sf_dir))
    distinct = jobs.distinct_events(rows).select("event_id", "service")
    _finish(jobs.run_append(distinct, f"{path}/out", f"{path}/checkpoint", trigger=None))
    return spark.read.parquet(f"{path}/out")


def _with_end(spark, path, rows, *times):
    """A stream and, after it, one row long after all others, so that the last windows close, too."""
    end = {t: F.timestamp_micros(F.unix_micros(X.time(X.AS_OF)) + F.lit(366 * 86_400_000_000)) for t in times}
    last = spark.range(1).select(*[end.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema])
    last.write.parquet(path)
    return rows.unionByName(files.read_stream_files(spark, path, last.schema))


def _stream_states(spark, evaluations, path, rule):
    _finish(jobs.run_append(alert_state.stateful_alerts(evaluations, rule), f"{path}/out", f"{path}/checkpoint", trigger=None))
    return _state_columns(spark.read.parquet(f"{path}/out"))


@query("alert_state_stream", _STATES)
def alert_state_stream(spark, sf_dir):
    """From events to states in one stream: panes, trailing windows, states with timers."""
    path, rule = scratch_path(spark, "alerts"), fixed.ERROR_RATE_RULE
    rows = X.dense_from(_event_stream(spark, sf_dir)).select("service", "timestamp", "is_error")
    windows = jobs.error_rate_windows(_with_end(spark, f"{path}/end", rows, "timestamp"), rule, alerts.STEP)
    # What silence ended has no value.
    return _stream_states(spark, windows, path, rule).filter("value is not null")


_SILENT = "NOT (service = 'svc-3' AND id // 2000 % 2 = 1)"
_SILENCE_SQL = f"""WITH {O.DENSE.replace("FROM parsed" + chr(10) + ")", f"FROM parsed WHERE {_SILENT}" + chr(10) + ")")}, {_ERROR_EVALS}, {O.states(5, 60)},
follow AS (SELECT *, lead(eval_s) OVER (PARTITION BY service ORDER BY eval_s) AS next_s FROM states)
SELECT service, eval_s, value, held_seconds, state FROM states UNION ALL
SELECT service, eval_s + 30, NULL, 0, 'Normal' FROM follow WHERE state <> 'Normal' AND next_s IS DISTINCT FROM eval_s + 30"""


def _silent(rows):
    """One service says nothing for 500 seconds of every 1,000, and in one of these its alert was firing before."""
    return rows.filter(~((F.col("service") == "svc-3") & (F.floor(F.col("id") / 2000) % 2 == 1)))


@query("alert_silence", _SILENCE_SQL)
def alert_silence(spark, sf_dir):
    rule = fixed.ERROR_RATE_RULE
    states = alerts.alert_states(alerts.error_rate_evaluations(_silent(X.dense(spark, sf_dir)), rule), rule)
    return _state_columns(alerts.with_silence(states))


@query("alert_silence_stream", _SILENCE_SQL)
def alert_silence_stream(spark, sf_dir):
    """A service that falls silent while its alert fires becomes Normal."""
    path, rule = scratch_path(spark, "silence"), fixed.ERROR_RATE_RULE
    rows = _silent(X.dense_from(_event_stream(spark, sf_dir))).select("service", "timestamp", "is_error")
    windows = jobs.error_rate_windows(_with_end(spark, f"{path}/end", rows, "timestamp"), rule, alerts.STEP)
    return _stream_states(spark, windows, path, rule)


@query("dlq_alert_stream", _DLQ_STATES)
def dlq_alert_stream(spark, sf_dir):
    path = scratch_path(spark, "dlq-alerts")
    dead = _dense_dead(X.dense_from(_event_stream(spark, sf_dir))).select(F.col("timestamp").alias("failed_at"))
    windows = jobs.dlq_windows(_with_end(spark, f"{path}/end", dead, "failed_at"), _DLQ_RULE, alerts.STEP)
    end_s = F.unix_seconds(X.time(X.AS_OF))  # the last row is no dead letter
    return _stream_states(spark, windows, path, _DLQ_RULE).filter((F.col("eval_s") < end_s) & F.col("value").isNotNull())


@query("lag_alert_stream", _LAG_CHANGES)
def lag_alert_stream(spark, sf_dir):
    """Offset rows to alert states in one stream, read for changes."""
    path, samples = scratch_path(spark, "lag-alerts"), X.offset_samples(spark, sf_dir)
    samples.write.parquet(f"{path}/offsets")
    rows = files.read_stream_files(spark, f"{path}/offsets", samples.schema)
    rows = _with_end(spark, f"{path}/end", rows, "ts").withColumn("consumergroup", F.coalesce("consumergroup", F.lit("end")))
    states = _stream_states(spark, jobs.lag_windows(rows, _LAG_RULE, alerts.STEP), path, _LAG_RULE).filter("service <> 'end'")
    return _state_columns(alerts.state_changes(states.withColumn("rule", F.lit(_LAG_RULE["rule"]))))


@query("stream_lag", """WITH files AS (SELECT event_id % 5 AS file, count(*) AS n FROM events GROUP BY 1)
SELECT file AS batch, CAST(sum(n) OVER (ORDER BY file) AS BIGINT) AS committed, CAST(sum(n) OVER () AS BIGINT) AS latest,
  CAST(sum(n) OVER () - sum(n) OVER (ORDER BY file) AS BIGINT) AS lag FROM files""")
def stream_lag(spark, sf_dir):
    """How far a running stream is behind, batch by batch: its own reports as of what its producer reported."""
    path, events = scratch_path(spark, "lag"), X.table(spark, sf_dir, "events")
    for i in range(5):
        events.filter(F.col("event_id") % 5 == i).coalesce(1).write.mode("append").parquet(f"{path}/topic")
    produced = events.agg(F.current_timestamp().alias("ts"), F.count("*").alias("latest")).withColumn("partition", F.lit(0))
    produced.write.parquet(f"{path}/produced")
    listener = progress.ProgressTable(spark, f"{path}/progress")
    stream = files.read_stream_files(spark, f"{path}/topic", events.schema, files_per_batch=1)
    run = stream.writeStream.queryName("reader").format("noop").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    _finish(run)
    listener.add([p.json for p in run.recentProgress])
    listener.flush()
    committed = progress.positions(progress.read_progress(spark, f"{path}/progress")).filter("committed > 0")
    topics = committed.select("topic").distinct()
    known = metrics.positions_as_of(committed, spark.read.parquet(f"{path}/produced").join(topics))
    batch = (F.row_number().over(Window.partitionBy("consumergroup").orderBy("ts")) - 1).cast("bigint")
    return known.select(batch.alias("batch"), "committed", "latest", (F.col("latest") - F.col("committed")).alias("lag"))


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(SQL)
