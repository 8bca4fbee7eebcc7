"""The driver tables read as log data.

Every function is a projection of a whole table, written with integers and text only, so that the same
projection in SQL (see `oracle.py`) gives the same values to the last digit.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.enrich import is_error
from ..functions.parsers import level_from_status
from ..operators.pipeline import Options
from ..schemas import CHANGE_SCHEMA
from ..session import dealt

START = "2024-01-01 00:00:00"
AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def time(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def plus_millis(start: Column, millis: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(start) + millis * 1000)


def _div(number: Column, by: int) -> Column:
    return F.floor(number / by).cast("bigint")


def _by_remainder(number: Column, choices: list[Column]) -> Column:
    remainder = number % len(choices)
    chosen = F.when(remainder == 0, choices[0])
    for i, choice in enumerate(choices[1:], start=1):
        chosen = chosen.when(remainder == i, choice)
    return chosen


def parsed_from(events: DataFrame) -> DataFrame:
    """Events as parsed rows; `id` stays for reports that need a short key."""
    i = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    status = (
        F.when(F.col("event_type") == "error", F.lit(500) + i % 4)
        .when(F.col("event_type") == "click", 304)
        .when(F.col("event_type") == "signup", 201)
        .when(i % 50 == 7, 404)
        .otherwise(200)
        .cast("int")
    )
    net = F.concat_ws(".", _div(i, 6) % 256, _div(i, 1536) % 256)
    client = _by_remainder(i, [
        F.concat(F.lit("10.0."), net), F.concat(F.lit("8.8."), net),
        F.concat(F.lit("h"), i, F.lit(".example.jp")), F.concat(F.lit("h"), i, F.lit(".example.com")),
        F.concat(F.lit("h"), i, F.lit(".nasa.gov")), F.lit(None).cast("string"),
    ])
    path = _by_remainder(i, [
        F.lit("/"), F.concat(F.lit("/images/"), k, F.lit(".gif")), F.concat(F.lit("/shuttle/m/"), k),
        F.concat(F.lit("/search?q=a/"), k), F.concat(F.lit("/misc-"), k, F.lit("/x")),
    ])
    timestamp = F.col("ts").cast("timestamp")
    ingested = plus_millis(timestamp, i % 900)
    return events.select(
        i.alias("id"),
        F.concat(F.lit("event-id-"), i).alias("event_id"),
        timestamp.alias("timestamp"),
        ingested.alias("ingested_at"),
        plus_millis(ingested, i % 1700).alias("stored_at"),
        F.concat(F.lit("web-0"), F.col("user_id") % 6 + 1).alias("host"),
        F.concat(F.lit("svc-"), F.col("user_id") % 7).alias("service"),
        client.alias("client_ip"),
        path.alias("path"),
        status.alias("status_code"),
        (k * 512).alias("response_bytes"),
        F.when(i % 11 != 0, F.floor(F.col("value") * 10)).alias("response_time_ms"),
        level_from_status(status).alias("log_level"),
        is_error(status, level_from_status(status)).alias("is_error"),
    )


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_from(table(spark, sf_dir, "events"))


# The fields of a good access line, and for each that can be wrong a value that makes the line unreadable.
_FIELDS = {
    "client": "192.0.2.7", "ident": "-", "user": "-", "stamp": "[{stamp}]", "request": '"PUT /depot/7 HTTP/1.1"',
    "status": "202", "size": "31",
}
_WRONG = {"ident": "", "stamp": "[{stamp}", "request": '"/depot/7"', "status": "2x2", "size": "much"}
# One line per wrong field, one that ends after its stamp, and one without anything, which has no payload to decode.
BROKEN_LINES = [
    *[" ".join({**_FIELDS, name: value}.values()) for name, value in _WRONG.items()],
    " ".join(list(_FIELDS.values())[:4]),
    "",
]
# The salt of client hashes in the queries.
OPTIONS = Options(salt="salt of the query tables")


def log_lines_from(events: DataFrame, client: Column | None = None) -> DataFrame:
    """Access-log lines as raw records, a twentieth of them broken, a 97th with an impossible status."""
    frame = parsed_from(events)
    if client is not None:
        frame = frame.withColumn("client_ip", client)
    i, ms = F.col("id"), F.col("response_time_ms")
    stamp = F.date_format("timestamp", "dd/MMM/yyyy:HH:mm:ss")
    status = F.when(i % 97 == 5, 700).otherwise(F.col("status_code"))
    seconds = F.concat(F.lit(" "), _div(ms, 1000), F.lit("."), F.lpad((ms % 1000).cast("string"), 3, "0"))
    good = F.concat(
        F.coalesce("client_ip", F.lit("unknown")), F.lit(" - - ["), stamp, F.lit(' +0000] "GET '), F.col("path"),
        F.lit(' HTTP/1.1" '), status, F.lit(" "), F.col("response_bytes"), F.coalesce(seconds, F.lit("")),
    )
    broken = _by_remainder(_div(i, 20), [F.lit(line.format(stamp="01/Jan/2024:00:00:00 +0000")) for line in BROKEN_LINES])
    return frame.select(
        "id", "event_id",
        F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingested_at"),
        "host", "service", F.lit("nginx_combined").alias("source_format"),
        F.when(i % 20 == 0, broken).otherwise(good).alias("raw_message"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines_from(dealt(table(spark, sf_dir, "events")))


# Names the same fields go by, one list per kind of client.
JSON_NAMES = [
    ["timestamp", "level", "message", "status_code", "http_method", "path", "client_ip", "response_time_ms",
     "trace_id", "response_bytes", "service", "host"],
    ["@timestamp", "severity", "msg", "status", "method", "uri", "remote_addr", "duration_ms", "traceId", "bytes",
     "service_name", "hostname"],
    ["ts", "loglevel", "event", "http_status", "verb", "url", "ip", "elapsed_ms", "correlation_id", "bytes_sent",
     "app", "node"],
]


def json_lines_from(events: DataFrame) -> DataFrame:
    """JSON application logs under three naming habits; some without a time, some cut short."""
    frame = parsed_from(events)
    i = F.col("id")
    values = [
        F.when(i % 25 != 0, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.lower("log_level"), F.concat(F.lit("call "), i, F.lit(" by user"), i, F.lit("@example.com")),
        F.col("status_code"), F.lit("get"), F.col("path"), F.col("client_ip"), F.col("response_time_ms"),
        F.concat(F.lit("t-"), i), F.col("response_bytes"), F.col("service"), F.col("host"),
    ]
    line = _by_remainder(i, [
        F.to_json(F.struct(*[value.alias(name) for value, name in zip(values, names)])) for names in JSON_NAMES
    ])
    cut = F.when(i % 40 == 1, F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    return frame.select("*", line.alias("line")).select(
        "id", "event_id",
        F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingested_at"),
        "host", "service", F.lit("json_app").alias("source_format"), cut.alias("raw_message"),
    )


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_lines_from(dealt(table(spark, sf_dir, "events")))


def raw_json_from(events: DataFrame) -> DataFrame:
    """The access-log records as JSON envelopes, four in sixty of them broken."""
    i = F.col("id")
    names = ["event_id", "ingested_at", "host", "service", "source_format", "raw_message"]
    whole = F.to_json(F.struct(*names))
    hostless = F.to_json(F.struct(*[n for n in names if n != "host"]))
    value = (
        F.when(i % 60 == 31, F.expr("left(whole, length(whole) - 1)"))
        .when(i % 60 == 32, F.concat(F.lit("["), F.col("whole"), F.lit("]")))
        .when(i % 60 == 33, hostless)
        .when(i % 60 == 34, F.concat("whole", F.lit(" x")))
        .otherwise(F.col("whole"))
    )
    return log_lines_from(events).withColumn("whole", whole).select("id", value.alias("value"))


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_json_from(dealt(table(spark, sf_dir, "events")))


def dup_from(events: DataFrame) -> DataFrame:
    """Parsed rows, a tenth of them once more with a later processing time."""
    copies = F.when(F.col("id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return parsed_from(events).withColumn("copy", F.explode(copies)).withColumn(
        "processed_at", plus_millis(F.col("stored_at"), F.col("copy") * 1000))


def dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dup_from(table(spark, sf_dir, "events"))


def dense_from(events: DataFrame) -> DataFrame:
    """Parsed rows on a compressed clock of four rows a second, with one burst of errors in svc-3."""
    i = F.col("id")
    burst = (F.col("service") == "svc-3") & (_div(i, 2000) == 2) & (i % 3 == 0)
    return parsed_from(events).withColumns({
        "timestamp": F.timestamp_seconds(F.unix_seconds(time(START)) + _div(i, 4)),
        "is_error": (i % 250 == 0) | burst,
    })


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_from(table(spark, sf_dir, "events"))


def ranges(spark: SparkSession) -> DataFrame:
    """Country by IPv4 range."""
    def number(a, b, c, d):
        return ((a * 256 + b) * 256 + c) * 256 + d

    return spark.createDataFrame(
        [(number(8, 8, 0, 0), number(8, 8, 127, 255), "US"), (number(8, 8, 128, 0), number(8, 8, 200, 255), "DE")],
        "start bigint, end bigint, country string",
    )


NETWORKS = [
    ("8.8.0.0/17", "US"), ("8.8.128.0/18", "DE"), ("8.8.160.0/20", "FR"), ("2a02:26f0::/32", "NL"), ("2a02:26f0:8000::/33", "SE"),
    ("2a00::/12", "GB"), ("2a02:26f0:9000::/36", None),
]


def networks(spark: SparkSession) -> DataFrame:
    """Country by network of either family; some lie inside others, one has no country."""
    return spark.createDataFrame(NETWORKS, "network string, country string")


def client_of_both_families() -> Column:
    """The client of a row, with IPv6 addresses in place of those that have none."""
    i, digits = F.col("id"), F.lower(F.hex(F.col("id") * 7919 % 65536))
    address = _by_remainder(_div(i, 6), [
        F.concat(F.lit("2a02:26f0:"), digits, F.lit("::1")), F.concat(F.lit("2A05:"), digits, F.lit(":0:0:0:0:0:9")),
        F.concat(F.lit("fe80::"), digits), F.concat(F.lit("2600:"), digits, F.lit("::"))])
    return F.when(i % 6 == 5, address).otherwise(F.col("client_ip"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page edits, one per page."""
    p = F.col("page_id")
    title = F.regexp_extract("url", r"/([^/]*)$", 1)
    lengths = F.struct((p * 10).alias("old"), (p * 10 + p % 13 - 6).alias("new"))
    built = {
        "meta": F.struct(
            F.col("url").alias("uri"),
            F.when(p % 6 != 0, F.date_format(F.timestamp_seconds(p * 60 + 1704067200), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .alias("dt"),
            F.concat(F.lit("m-"), p).alias("id"),
            F.lit(None).cast("string").alias("domain"),
        ),
        "type": _by_remainder(p, [F.lit(x) for x in ("edit", "new", "log", "categorize", "other")]),
        "title": F.concat(title, F.lit(" é+*~")),
        "user": _by_remainder(p, [
            F.concat(F.lit("Editor"), p % 50), F.concat(F.lit("~2026-"), p % 40),
            F.concat(F.lit("198.51.100."), p % 256), F.lit(None).cast("string"),
        ]),
        "server_name": F.when(p % 17 != 0, F.regexp_extract("url", r"^https?://([^/]+)", 1)),
        "wiki": F.when(p % 5 != 1, F.concat(F.lit("wiki"), p % 9)),
        "comment": _by_remainder(p, [
            F.lit("Reverted edit"), F.lit(""), F.repeat(F.lit("long "), 150), F.lit("plain words"),
            F.lit("undo 7"), F.lit("revertible"), F.lit(None).cast("string"),
        ]),
        "bot": p % 3 == 0,
        "minor": p % 2 == 0,
        "length": F.when(p % 8 != 3, lengths),
        "timestamp": F.when(p % 12 != 0, p * 60 + 1704067200),
    }
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", *[built[f.name].cast(f.dataType).alias(f.name) for f in CHANGE_SCHEMA])


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter per event type, sampled every minute with events; it starts again on the 16th day."""
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    counts = table(spark, sf_dir, "events").groupBy("event_type", minute.alias("ts")).agg(F.count("*").alias("n"))
    life = Window.partitionBy("event_type", F.col("ts") >= time("2024-01-16 00:00:00")).orderBy("ts")
    return counts.select(
        "ts", F.lit("events_total").alias("metric"), F.create_map(F.lit("type"), F.col("event_type")).alias("labels"),
        F.sum("n").over(life).cast("double").alias("value"),
    )


def offset_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of two consumer groups, and of a hidden one, per minute with events."""
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    partition = (F.col("user_id") % 6).cast("int")
    counts = table(spark, sf_dir, "events").groupBy(
        partition.alias("partition"), minute.alias("ts")).agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("partition").orderBy("ts")
    index = F.floor(F.unix_seconds("ts") / 60)
    groups = F.explode(F.array(F.lit("parser"), F.lit("store"), F.lit("_internal")))
    positions = counts.select("ts", "partition", F.sum("n").over(so_far).alias("latest"))
    return positions.select("*", groups.alias("consumergroup")).select(
        "ts", "consumergroup", F.lit("raw").alias("topic"), "partition",
        F.greatest(
            F.lit(0), F.col("latest") - F.when(F.col("consumergroup") == "store", index % 13).otherwise(index % 5)
        ).cast("bigint").alias("committed"),
        F.col("latest").cast("bigint"),
    )


CONSUMER_GROUPS = ["parser", "store", "idle"]
