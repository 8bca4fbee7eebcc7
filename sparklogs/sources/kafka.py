"""Options and frames for topics. The connector itself is a package of the cluster."""

import os
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import jsonvalue as J
from ..functions.text import iso_text, settled
from ..functions.validate import unknown_json_fields
from ..schemas import DLQ_SCHEMA, PARSED_TEXT_SCHEMA, TIME_COLUMNS

_SECURITY = "org.apache.kafka.common.security"
LOGIN_MODULES = {
    "PLAIN": f"{_SECURITY}.plain.PlainLoginModule",
    "SCRAM-SHA-256": f"{_SECURITY}.scram.ScramLoginModule",
    "SCRAM-SHA-512": f"{_SECURITY}.scram.ScramLoginModule",
}
# A trigger takes at most this many records; raise it with the size of the cluster.
MAX_OFFSETS_PER_TRIGGER = 65_536
TOPICS = {
    "raw": "raw-logs", "parsed": "parsed-logs", "errors": "error-logs", "dlq": "dead-letter-queue",
    "metrics": "service-metrics-1m",
}
WINDOW_COLUMNS = [
    "event_id", "service", "host", "status_code", "log_level", "is_error", "response_time_ms", "path_group",
]


def _login(env: Mapping[str, str]) -> dict[str, str]:
    names = ["KAFKA_SASL_USERNAME", "KAFKA_SASL_PASSWORD"]
    missing = [name for name in names if not env.get(name)]
    if missing:
        raise ValueError(f"a login needs {' and '.join(missing)}")
    # Quoted, so that no character of a credential can end its value or add an option.
    user, password = (re.sub(r'([\\"])', r"\\\1", env[name]) for name in names)
    mechanism = env.get("KAFKA_SASL_MECHANISM", "PLAIN")
    module = LOGIN_MODULES.get(mechanism)
    if module is None:
        raise ValueError(f"no login module for mechanism {mechanism!r}")
    return {
        "kafka.sasl.mechanism": mechanism,
        "kafka.sasl.jaas.config": f'{module} required username="{user}" password="{password}";',
    }


def _certificate(env: Mapping[str, str]) -> dict[str, str]:
    authority, unchecked = env.get("KAFKA_SSL_CA_LOCATION"), env.get("KAFKA_SSL_SKIP_VERIFY") == "1"
    return ({"kafka.ssl.truststore.type": "PEM", "kafka.ssl.truststore.location": authority} if authority else {}) | (
        {"kafka.ssl.endpoint.identification.algorithm": ""} if unchecked else {})


# What a protocol adds to a plain connection.
PROTOCOLS = {"PLAINTEXT": [], "SSL": [_certificate], "SASL_PLAINTEXT": [_login], "SASL_SSL": [_login, _certificate]}


def security_options(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Connection options from the environment; unknown protocols and missing credentials are refused."""
    env = os.environ if env is None else env
    protocol = env.get("KAFKA_SECURITY_PROTOCOL", "PLAINTEXT").upper()
    if protocol not in PROTOCOLS:
        raise ValueError(f"KAFKA_SECURITY_PROTOCOL {protocol!r} is not one of {list(PROTOCOLS)}")
    parts = PROTOCOLS[protocol]
    options = {"kafka.security.protocol": protocol} if parts else {}
    for part in parts:
        options |= part(env)
    return options


def source_options(
    topic: str, servers: str, starting: str = "earliest", per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER,
    env: Mapping[str, str] | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
        # Records that age out unread are an error, not a gap.
        "failOnDataLoss": "true",
        **security_options(env),
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def sink_options(topic: str, servers: str, env: Mapping[str, str] | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": "true",
        "kafka.compression.type": "lz4", "kafka.linger.ms": "20", "kafka.batch.size": "262144",
        **security_options(env),
    }


def read_raw_stream(spark: SparkSession, servers: str, topic: str = TOPICS["raw"], **choice) -> DataFrame:
    """Raw envelopes from their first offset, `value` as bytes for `pipeline.decode`."""
    return spark.readStream.format("kafka").options(**source_options(topic, servers, **choice)).load()


def read_window_stream(spark: SparkSession, servers: str, topic: str = TOPICS["parsed"]) -> DataFrame:
    """Parsed rows for the windowed aggregate: from now on, eight columns and the record time."""
    stream = spark.readStream.format("kafka").options(**source_options(topic, servers, starting="latest")).load()
    rows = parse_rows(stream, extra=("timestamp AS record_time",))
    return rows.select("record_time", *WINDOW_COLUMNS)


def parse_rows(stream: DataFrame, value: str = "value", extra: tuple[str, ...] = (), skipped: bool = False) -> DataFrame:
    """Parsed rows from JSON text; unknown members are ignored and broken messages dropped.

    A message is broken unless it is exactly one JSON object whose members have the types of the record and
    that has an event id: nothing of it is taken then. With `skipped`, broken messages stay as rows of nulls with `_broken` true and
    their text in `_rescued`; `_unknown` counts the members that the record type does not have.
    """
    return _typed_messages(stream, PARSED_TEXT_SCHEMA, value, extra, skipped)


def parse_dead_letters(stream: DataFrame, value: str = "value", extra: tuple[str, ...] = (), skipped: bool = False) -> DataFrame:
    """Dead letters from JSON text, as strictly; their event id may be unknown, their stage may not. Times are ISO text."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in DLQ_SCHEMA])
    return _typed_messages(stream, text, value, extra, skipped, required="error_stage")


def _typed_messages(stream: DataFrame, schema: T.StructType, value: str, extra: tuple[str, ...], skipped: bool, required: str = "event_id") -> DataFrame:
    text, names = F.col(value).cast("string"), [e.split(" AS ")[-1] for e in extra]
    # The reader notes a message with a member of another type, but stops at the end of the first value.
    noted = T.StructType([*schema, T.StructField("_wrong", T.StringType())])
    row = F.from_json("_text", noted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_wrong"})
    frame = stream.select(*[F.expr(e) for e in extra], text.alias("_text"))
    frame = frame.select(settled(*names, "_text", row.alias("_row"), J.is_json(F.col("_text")).alias("_json")))
    good = F.col("_json") & F.col("_row").isNotNull() & F.col("_row._wrong").isNull() & F.col(f"_row.{required}").isNotNull()
    frame = frame.select(*names, "_text", "_row", F.coalesce(~good, F.lit(True)).alias("_broken"))
    fields = [F.when(~F.col("_broken"), F.col(f"_row.{f.name}")).alias(f.name) for f in schema]
    if not skipped:
        return frame.filter(~F.col("_broken")).select(*names, *[F.col(f"_row.{f.name}") for f in schema])
    unknown = F.size(unknown_json_fields(F.col("_text"), schema.names))
    return frame.select(*names, *fields, "_broken", F.when(F.col("_broken"), F.col("_text")).alias("_rescued"),
                        F.when(F.col("_broken"), 0).otherwise(unknown).alias("_unknown"))


def to_records(rows: DataFrame, key: str = "service") -> DataFrame:
    """(key, value) for a topic: the row as JSON with times as ISO text, keyed by service."""
    return rows.select(F.col(key).cast("string").alias("key"), record_text({c: F.col(c) for c in rows.columns}).alias("value"))


def record_text(columns: dict[str, Column]) -> Column:
    """The columns as one JSON object, times as ISO text."""
    return F.to_json(F.struct(*[
        (iso_text(c) if name in TIME_COLUMNS or name in ("failed_at", "window_start", "window_end") else c).alias(name)
        for name, c in columns.items()]))


