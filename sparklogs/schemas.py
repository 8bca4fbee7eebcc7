"""Record types. Nothing is inferred anywhere; every reader gets one of these."""

from pyspark.sql import types as T


def _struct(**fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


S, I, L, D, B, TS = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType(),
)

RAW_SCHEMA = _struct(event_id=S, ingested_at=S, host=S, service=S, source_format=S, raw_message=S)

PARSED_SCHEMA = _struct(
    event_id=S, timestamp=TS, ingested_at=TS, processed_at=TS, host=S, service=S, source_format=S,
    client_ip=S, client_ip_hash=S, geo_country=S, geo_source=S, http_method=S, path=S, path_group=S,
    status_code=I, response_bytes=L, response_time_ms=L, log_level=S, is_error=B, message=S,
    user_agent=S, referer=S, trace_id=S,
)
PARSED_COLUMNS = PARSED_SCHEMA.fieldNames()
TIME_COLUMNS = ["timestamp", "ingested_at", "processed_at"]

# Parsed rows as they travel on a stream: times are ISO text.
PARSED_TEXT_SCHEMA = T.StructType(
    [T.StructField(f.name, S if f.name in TIME_COLUMNS else f.dataType) for f in PARSED_SCHEMA]
)

DLQ_SCHEMA = _struct(event_id=S, failed_at=TS, error_reason=S, error_stage=S, service=S, original=S)
DLQ_COLUMNS = DLQ_SCHEMA.fieldNames()

METRICS_1M_SCHEMA = _struct(
    service=S, service_name=S, window_start=TS, window_end=TS, request_count=L, error_count=L,
    error_rate_pct=D, avg_response_ms=D, max_response_ms=L,
)

CHANGE_SCHEMA = T.StructType([
    T.StructField("meta", _struct(uri=S, dt=S, id=S, domain=S)),
    T.StructField("type", S), T.StructField("title", S), T.StructField("user", S),
    T.StructField("server_name", S), T.StructField("wiki", S), T.StructField("comment", S),
    T.StructField("bot", B), T.StructField("minor", B),
    T.StructField("length", T.StructType([T.StructField("old", L), T.StructField("new", L)])),
    T.StructField("timestamp", L),
])

METRIC_SCHEMA = _struct(ts=TS, metric=S, labels=T.MapType(S, S), value=D)
OFFSET_SCHEMA = _struct(ts=TS, consumergroup=S, topic=S, partition=I, committed=L, latest=L)
