"""Where routed rows go: folders by route and day from one pass, or topics; and windows that change."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .. import fixed
from ..operators.pipeline import dead_letter_columns, dead_letters, error_rows, parsed_rows
from ..schemas import DLQ_COLUMNS, METRICS_1M_SCHEMA, PARSED_COLUMNS, PARSED_SCHEMA
from . import commits
from .kafka import TOPICS, record_text, sink_options
from .store import _day, _day_before

# Columns of the combined table the three outputs are written to in one pass.
_COMBINED = [*PARSED_COLUMNS, "_stage", "_reason", "_original", "route"]


_COMBINED_SCHEMA = T.StructType([*PARSED_SCHEMA, *[T.StructField(c, T.StringType()) for c in (*_COMBINED[len(PARSED_COLUMNS):], "batch")]])
# Which retention holds for a route.
_STREAM_OF = {"parsed": "parsed", "errors": "errors", "dlq": "dead_letters"}


def write_routes(routed: DataFrame, path: str, batch: str = "0", repeated: bool = False) -> None:
    """Write all outputs of a batch in one pass, as folders by route and day of processing.

    Writing the same batch again replaces it with all its routes, so a batch that is repeated after a failure
    counts once, and a record that has changed its route since is not left in the old one.
    """
    day = F.coalesce(F.to_date("processed_at"), F.current_date())
    commits.write(routed.select(*_COMBINED, day.alias("event_date")), path, batch, ["route", "event_date"], repeated)


def read_routes(spark: SparkSession, path: str, route: str | None = None) -> DataFrame:
    """All outputs, or one of them, whose folders alone are looked at then."""
    frame = commits.read(spark, path, _COMBINED_SCHEMA, lambda parts: route in (None, parts["route"]))
    return frame.select("batch", *_COMBINED)


def expire_routes(spark: SparkSession, path: str, as_of_day: str) -> list[str]:
    """Drop the days of each output that are past its retention; returns route/day."""
    limits = {r: _day_before(as_of_day, fixed.RETENTION_HOURS[s] // 24) for r, s in _STREAM_OF.items()}
    gone = commits.drop(spark, path, lambda parts: _day(parts) < limits[parts["route"]])
    return sorted({f"{p['route']}/{_day(p)}" for p in map(commits.parts_of, gone)})


def compact_routes(spark: SparkSession, path: str, day: str, but: str | None = None) -> None:
    """Rewrite the batches of one day as one; the batch `but`, which a stream may still repeat, stays apart."""
    old = [e for e in commits.entries(spark, path) if _day(commits.parts_of(e)) == day and commits.parts_of(e)["batch"] != but]
    if len(old) > 1:
        rows = commits.read(spark, path, _COMBINED_SCHEMA, only=old).drop("batch").withColumn("event_date", F.lit(day).cast("date"))
        commits.merge(rows.hint("rebalance", "route"), path, old, ["route", "event_date"])


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    return parsed_rows(read_routes(spark, path, "parsed"))


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    return error_rows(read_routes(spark, path, "errors"))


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return dead_letters(read_routes(spark, path, "dlq"))


def topic_records(routed: DataFrame) -> DataFrame:
    """Every output row as (topic, key, value): parsed rows keyed by service, dead letters likewise."""
    rows = routed.select("route", *PARSED_COLUMNS, F.struct(*dead_letter_columns()).alias("_letter"))
    letter = record_text({c: F.col(f"_letter.{c}") for c in DLQ_COLUMNS})
    whole = record_text({c: F.col(c) for c in PARSED_COLUMNS})
    topic = F.col("route")
    for name in ("parsed", "errors", "dlq"):
        topic = F.when(F.col("route") == name, TOPICS[name]).otherwise(topic)
    return rows.select(topic.alias("topic"), F.col("service").cast("string").alias("key"),
                       F.when(F.col("route") == "dlq", letter).otherwise(whole).alias("value"))


def write_topics(routed: DataFrame, servers: str) -> None:
    """Write all outputs to their topics; the topic column names the destination of each row."""
    options = {k: v for k, v in sink_options("", servers).items() if k != "topic"}
    topic_records(routed).write.format("kafka").options(**options).save()


_WINDOWS_SCHEMA = T.StructType([*METRICS_1M_SCHEMA, T.StructField("_version", T.LongType()), T.StructField("event_date", T.DateType())])


def upsert_windows(changed: DataFrame, path: str, batch: int) -> None:
    """Keep the rows an update-mode aggregate changed in this batch, by day and under the batch's own name."""
    rows = changed.select(*METRICS_1M_SCHEMA.names, F.lit(batch).cast("bigint").alias("_version"), F.to_date("window_start").alias("event_date"))
    commits.write(rows, path, str(batch), ["event_date"], repeated=True)


def latest_windows(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """Current version of every window: the one from its last batch."""
    return _latest(commits.read(spark, path, _WINDOWS_SCHEMA), *keys).drop("_version", "event_date")


def _latest(rows: DataFrame, *keys: str) -> DataFrame:
    # The day follows from the window; in the key it lets day filters reach the scan.
    last = Window.partitionBy("event_date", *keys).orderBy(F.desc("_version"))
    return rows.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def compact_windows(spark: SparkSession, path: str, *keys: str) -> None:
    """Put one version of every window in the place of all batches but the newest, which may still be repeated.

    Readers that began before go on with the files they know; `commits.vacuum` removes those later.
    """
    live = commits.entries(spark, path)
    numbers = [int(b) for b in (commits.parts_of(e)["batch"] for e in live) if b.isdigit()]
    old = [e for e in live if commits.parts_of(e)["batch"] != str(max(numbers, default=-1))]
    if len(old) > 1:
        rows = _latest(commits.read(spark, path, _WINDOWS_SCHEMA, only=old), *keys)
        commits.merge(rows.hint("rebalance", "event_date"), path, old, ["event_date"])


def expire_windows(spark: SparkSession, path: str, as_of_day: str) -> list[str]:
    """Drop the days of the windowed metrics that are past their retention."""
    limit = _day_before(as_of_day, fixed.RETENTION_HOURS["service_metrics_1m"] // 24)
    return sorted({_day(commits.parts_of(e)) for e in commits.drop(spark, path, lambda parts: _day(parts) < limit)})
