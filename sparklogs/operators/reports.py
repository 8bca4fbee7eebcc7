"""Questions asked of the parsed table: filters, aggregates over time and service, lists, shares."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.envelope import stable_index
from .. import fixed
from .sequences import exact_quantiles


# ---- filters --------------------------------------------------------------------------------

def time_filter(frame: DataFrame, start: Column | None = None, end: Column | None = None, by: str = "timestamp") -> DataFrame:
    """`start < by <= end`. On a table partitioned by event_date the same bounds also prune days:
    Spark does not derive the day predicate from the time predicate."""
    days = by == "timestamp" and "event_date" in frame.columns
    if start is not None:
        frame = frame.filter(F.col(by) > start)
        if days:
            frame = frame.filter(F.col("event_date") >= F.to_date(start))
    if end is not None:
        frame = frame.filter(F.col(by) <= end)
        if days:
            frame = frame.filter(F.col("event_date") <= F.to_date(end))
    return frame


def services_filter(frame: DataFrame, services: list[str] | None = None) -> DataFrame:
    """Rows of the chosen services; None means all and adds no predicate."""
    return frame.filter(F.col("service").isin(services)) if services else frame


def stored_since(frame: DataFrame, as_of: Column, interval: str) -> DataFrame:
    """Rows stored in the `interval` before `as_of`."""
    return frame.filter(F.col("stored_at") > as_of - F.expr(f"INTERVAL {interval}"))


def error_subset(frame: DataFrame) -> DataFrame:
    return frame.filter("is_error")


def message_search(frame: DataFrame, text: str, column: str = "message") -> DataFrame:
    """Rows whose message contains `text`, taken literally."""
    return frame.filter(F.col(column).contains(text))


def incident_search(
    frame: DataFrame, service: str, start: Column, end: Column | None = None,
    min_status: int = 500, level: str = "ERROR", newest: int = 50,
) -> DataFrame:
    """The newest failing requests of one service in a time range."""
    found = time_filter(frame, start, end).filter(
        (F.col("service") == service) & (F.col("status_code") >= min_status) & (F.col("log_level") == level))
    return newest_first(found, newest)


def recent_errors(frame: DataFrame, services: list[str] | None = None, newest: int = 100) -> DataFrame:
    return newest_first(error_subset(services_filter(frame, services)), newest)


def newest_first(frame: DataFrame, rows: int) -> DataFrame:
    """The newest rows; ids break ties. Each task keeps only its own newest ones."""
    return frame.orderBy(F.desc("timestamp"), F.desc("event_id")).limit(rows)


# ---- aggregates -----------------------------------------------------------------------------

def _errors() -> Column:
    return F.count_if("is_error")


def error_pct(digits: int = 3) -> Column:
    """Error share in per cent, from doubles: decimals would overflow in division."""
    return F.round(100 * _errors().cast("double") / F.count("*"), digits)


def quantile(column: Column | str, q: float, exact: bool = True) -> Column:
    """Exact quantile by default: its state is one counter per distinct value, so whole milliseconds
    stay small however many rows there are. For columns with unbounded distinct values pass exact=False."""
    return F.percentile(column, F.lit(q)) if exact else F.percentile_approx(column, q, 10_000)


def service_metrics_1m(frame: DataFrame, time_col: str = "timestamp", size: str = "1 minute") -> DataFrame:
    """Requests, errors and response times per service and tumbling window.

    Works on batches and, with a watermark on `time_col`, on streams.
    """
    response = F.col("response_time_ms")
    return frame.groupBy(F.window(time_col, size), "service").agg(
        F.count("*").alias("request_count"),
        F.sum(F.when(F.col("is_error"), 1).otherwise(0)).alias("error_count"),
        error_pct().alias("error_rate_pct"),
        F.avg(response.cast("double")).alias("avg_response_ms"),
        F.max(response).alias("max_response_ms"),
    ).select(
        "service", F.col("service").alias("service_name"),
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "request_count", "error_count", "error_rate_pct", "avg_response_ms", "max_response_ms",
    )


def minute_service(frame: DataFrame) -> DataFrame:
    """Requests, errors, error share and p95 per minute and service."""
    return frame.groupBy(F.date_trunc("minute", F.col("timestamp")).alias("minute"), "service").agg(
        F.count("*").alias("requests"), _errors().alias("errors"), error_pct().alias("error_rate_pct"),
        F.round(quantile("response_time_ms", 0.95)).alias("p95_ms"),
    )


def ordered_minutes(frame: DataFrame) -> DataFrame:
    return minute_service(frame).orderBy(F.desc("minute"), F.desc("requests"), "service")


def ingest_latency(frame: DataFrame) -> DataFrame:
    """Events and p50, p95, p99 and longest time from intake to storage, in seconds."""
    lag = (F.unix_millis("stored_at") - F.unix_millis("ingested_at")).alias("lag")
    shares = {"p50_s": 0.5, "p95_s": 0.95, "p99_s": 0.99, "max_s": 1.0}
    found = exact_quantiles(frame.select(lag), "lag", shares)
    return found.select(F.col("rows").alias("events"), *[F.round(F.col(n) / 1000, 2).alias(n) for n in shares])


def ingest_lag_seconds(ingested_at: Column, done_at: Column) -> Column:
    """Seconds from intake to completion; null when negative or unknown."""
    seconds = (F.unix_micros(done_at) - F.unix_micros(ingested_at)) / 1_000_000
    return F.when(seconds >= 0, seconds)


def service_health(frame: DataFrame) -> DataFrame:
    """One row per service, worst first."""
    return frame.groupBy("service").agg(
        F.count("*").alias("requests"), _errors().alias("errors"), error_pct(2).alias("err_pct"),
        F.round(quantile("response_time_ms", 0.95)).alias("p95_ms"),
    ).orderBy(F.desc("err_pct"), F.desc("requests"), "service")


def stat_tiles(frame: DataFrame) -> DataFrame:
    """One row: events, error share (0 when empty), p95, active services."""
    found = exact_quantiles(frame, "response_time_ms", {"p95": 0.95}, _errors())
    tiles = found.select(
        F.col("rows").alias("events"),
        F.round(100 * F.coalesce("_sum0", F.lit(0)).cast("double") / F.greatest("rows", F.lit(1)), 2).alias("error_rate"),
        F.round("p95").alias("p95_ms"), F.lit(None).cast("bigint").alias("services"))
    services = frame.agg(F.count_distinct("service").alias("services"))
    both = tiles.unionByName(services, allowMissingColumns=True)  # each column is known in one of the two rows
    return both.agg(*[F.max(c).alias(c) for c in tiles.columns])


def _over_time(frame: DataFrame, interval: str, *measures: Column) -> DataFrame:
    return frame.groupBy(F.window("timestamp", interval).alias("_w"), "service").agg(*measures).withColumn(
        "time", F.col("_w.start")).drop("_w")


def volume_over_time(frame: DataFrame, interval: str) -> DataFrame:
    return _over_time(frame, interval, F.count("*").alias("requests"))


def errors_over_time(frame: DataFrame, interval: str) -> DataFrame:
    return _over_time(frame, interval, error_pct().alias("error_rate"))


def p95_over_time(frame: DataFrame, interval: str) -> DataFrame:
    timed = frame.filter(F.col("response_time_ms").isNotNull())
    return _over_time(timed, interval, F.round(quantile("response_time_ms", 0.95)).alias("p95_ms"))


def wide_over_time(frame: DataFrame, interval: str, services: list[str]) -> DataFrame:
    """Requests over time with one column per service; 0 where a service was silent."""
    wide = frame.groupBy(F.window("timestamp", interval).alias("_w")).pivot("service", services).count()
    return wide.select(F.col("_w.start").alias("time"), *[F.coalesce(F.col(f"`{s}`"), F.lit(0)).alias(s) for s in services])


def recent_services(frame: DataFrame, as_of: Column, interval: str = "24 HOURS") -> DataFrame:
    start = as_of - F.expr(f"INTERVAL {interval}")
    return time_filter(frame, start, as_of).select("service").distinct().orderBy("service")


def with_share(counts: DataFrame, count: str = "n", out: str = "share_pct") -> DataFrame:
    """Share of each row in the total. The total is a scalar subquery over the same aggregate, whose
    shuffle Spark reuses, so no row has to visit a single task."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(out, F.round(100 * F.col(count).cast("double") / total, 3))


def status_share(frame: DataFrame) -> DataFrame:
    return with_share(frame.groupBy("status_code").agg(F.count("*").alias("n")))


def service_skew(frame: DataFrame, partitions: int = fixed.STREAM_PARTITIONS) -> DataFrame:
    """Share of each service, and of the stream partition its key falls into."""
    per_service = frame.groupBy("service").agg(F.count("*").alias("n")).withColumn(
        "partition", stable_index(F.col("service"), partitions))
    per_partition = per_service.groupBy("partition").agg(F.sum("n").alias("partition_n"))
    joined = with_share(per_service).join(with_share(per_partition, "partition_n", "partition_share_pct"), "partition")
    return joined.select("service", "partition", "n", "share_pct", "partition_n", "partition_share_pct")
