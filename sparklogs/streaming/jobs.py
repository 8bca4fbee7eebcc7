"""The same operators on streams."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import alerts, metrics, reports
from ..operators.pipeline import Options, decode, process, route
from ..sources import kafka
from ..sources.sinks import read_routes, upsert_windows, write_routes
from ..sources.store import append_hot

GRACE = "30 seconds"
TRIGGER = "1 second"


def _start(writer, trigger: str | None) -> StreamingQuery:
    """A cadence, or everything that is there and then stop."""
    return writer.trigger(processingTime=trigger).start() if trigger else writer.trigger(availableNow=True).start()


def windowed_metrics(parsed: DataFrame, time_col: str = "timestamp", grace: str = GRACE) -> DataFrame:
    """Per-minute service metrics; rows later than `grace` behind the newest time seen are dropped.

    `time_col` is the event's own time; pass ingested_at to go by arrival instead.
    """
    return reports.service_metrics_1m(parsed.withWatermark(time_col, grace), time_col)


def run_windowed_metrics(
    parsed: DataFrame, out: str, checkpoint: str, time_col: str = "timestamp", trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Keep `out` up to date with every change of a window; read it with sinks.latest_windows."""
    writer = windowed_metrics(parsed, time_col).writeStream.outputMode("update").foreachBatch(
        lambda changed, batch: upsert_windows(changed, out, batch)
    ).option("checkpointLocation", checkpoint)
    return _start(writer, trigger)


def run_pipeline(
    values: DataFrame, out: str, checkpoint: str, options: Options, as_of: Column | None = None,
    trigger: str | None = TRIGGER, write: Callable[[DataFrame, str, str, bool], None] = write_routes,
) -> StreamingQuery:
    """Envelopes to outputs, at least once: a batch is done when its write is, and a batch that is
    repeated replaces what it wrote before. With trigger=None it works off the backlog and stops."""
    stamp = F.current_timestamp() if as_of is None else as_of

    def one_batch(batch: DataFrame, number: int) -> None:
        write(route(process(decode(batch), stamp, options)), out, str(number), True)

    writer = values.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return _start(writer, trigger)


def run_hot_store(
    records: DataFrame, root: str, checkpoint: str, stored_at: Column | None = None, name: str = "stream",
    trigger: str | None = TRIGGER, watch: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Parsed rows from topic records into the hot tier, by day; rows that are no good records are left to the topic.

    `watch` is told, per batch, how many messages came, how many were broken and how many had unknown members.

    A batch has one name, made of the stream's and its number, so one that is repeated after a failure replaces all
    its days, and readers see a batch whole or not at all.
    """
    def one_batch(batch: DataFrame, number: int) -> None:
        rows, counters = metrics.watched(kafka.parse_rows(batch, skipped=True), f"{name}-{number}")
        append_hot(rows, root, stored_at, f"{name}-{number}", repeated=True)
        if watch:
            watch(number, counters.get)

    return _start(records.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint), trigger)


def distinct_events(parsed: DataFrame, delay: str = "10 minutes", time_col: str = "timestamp") -> DataFrame:
    """Drop further copies of an event that arrive within `delay`; state older than that is let go."""
    return parsed.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["event_id"])


def run_append(rows: DataFrame, out: str, checkpoint: str, trigger: str | None = TRIGGER) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", out).option(
        "checkpointLocation", checkpoint)
    return _start(writer, trigger)


def _trailing(panes: DataFrame, rule: dict, step: int, *keys: str) -> DataFrame:
    """Sums of 30-second panes over the trailing window (end - length, end] of every evaluation, with its time.

    The panes are repeated for the windows they are in, never the events behind them.
    """
    windows = F.window(F.window_time("_pane"), f"{rule['window_seconds']} seconds", f"{step} seconds")
    sums = [F.sum(c).alias(c) for c in panes.columns if c not in ("_pane", *keys)]
    return panes.groupBy(windows.alias("_w"), *keys).agg(*sums).select(
        "*", F.lit(rule["rule"]).alias("rule"), F.unix_seconds("_w.end").alias("eval_s"), F.window_time("_w").alias("eval_time"))


def _panes(rows: DataFrame, time: str, step: int, grace: str):
    """The rows with a watermark, and the pane each is in. Windows close at their start; one microsecond moves that to their end."""
    shifted = rows.withColumn("_at", F.timestamp_micros(F.unix_micros(time) - 1)).withWatermark("_at", grace)
    return shifted, F.window("_at", f"{step} seconds").alias("_pane")


def error_rate_windows(parsed: DataFrame, rule: dict, step: int, grace: str = GRACE) -> DataFrame:
    """Evaluations of the error-rate rule on a stream of parsed rows, every `step` seconds."""
    rows, pane = _panes(parsed, "timestamp", step, grace)
    panes = rows.groupBy(pane, "service").agg(F.count("*").alias("requests"), F.count_if("is_error").alias("errors"))
    return _trailing(panes, rule, step, "service").filter(F.col("requests") >= rule["min_rows"]).select(
        "rule", "service", "eval_s", F.round(100 * F.col("errors").cast("double") / F.col("requests"), 3).alias("value"), "eval_time")


def dlq_windows(dead: DataFrame, rule: dict, step: int, time: str = "failed_at", grace: str = GRACE) -> DataFrame:
    """Evaluations of the dead-letter rule on a stream of dead letters: letters a second over the trailing window."""
    rows, pane = _panes(dead, time, step, grace)
    panes = rows.groupBy(pane).agg(F.count("*").alias("_n"))
    return _trailing(panes, rule, step).select(
        "rule", F.lit("all").alias("service"), "eval_s", (F.col("_n") / rule["window_seconds"]).alias("value"), "eval_time")


def lag_windows(offsets: DataFrame, rule: dict, step: int, grace: str = GRACE) -> DataFrame:
    """Evaluations of the lag rule on a stream of offset rows: the last known lag of each partition, summed by group."""
    visible = alerts.visible_groups(offsets)
    rows, pane = _panes(visible, "ts", step, grace)
    keys = ["consumergroup", "topic", "partition"]
    panes = rows.groupBy(pane, *keys).agg(F.max_by(F.col("latest") - F.col("committed"), "ts").alias("_lag"))
    windows = F.window(F.window_time("_pane"), f"{rule['window_seconds']} seconds", f"{step} seconds")
    known = panes.groupBy(windows.alias("_w"), *keys).agg(F.max_by("_lag", "_pane.end").alias("_lag"))
    return known.groupBy("_w", "consumergroup").agg(F.sum("_lag").cast("double").alias("value")).select(
        F.lit(rule["rule"]).alias("rule"), F.col("consumergroup").alias("service"), F.unix_seconds("_w.end").alias("eval_s"),
        "value", F.window_time("_w").alias("eval_time"))


def batch_ratio(spark: SparkSession, path: str) -> DataFrame:
    """Dead letters as a share of each micro-batch."""
    rows = read_routes(spark, path)
    return rows.groupBy("batch").agg(
        F.count_if(F.col("route") == "parsed").alias("parsed"), F.count_if(F.col("route") == "dlq").alias("dlq"),
    ).select("batch", "parsed", "dlq", F.round(F.try_divide("dlq", F.col("parsed") + F.col("dlq")), 6).alias("dlq_ratio"))
