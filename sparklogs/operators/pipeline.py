"""Raw records to parsed events, error copies and dead letters.

All stages are projections over one row, so a batch or a stream passes through them without a shuffle.
The first failure decides: later stages do not look at a row that has one.
"""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions import enrich, jsonvalue as J, redact
from ..functions.parsers import Parser, parse
from ..functions.text import best_effort_time, settled
from ..functions.validate import first_problem
from ..schemas import DLQ_COLUMNS, DLQ_SCHEMA, PARSED_COLUMNS, PARSED_SCHEMA, RAW_SCHEMA
from .lookup import Networks, located

RAW_COLUMNS = RAW_SCHEMA.fieldNames()
_WORK = ["_stage", "_reason", "_bad_types", "_original"]


@dataclass(frozen=True)
class Options:
    # Secret of the deployment; client hashes can be guessed by whoever knows it.
    salt: str
    keep_client: bool = True
    # Parsers by source format, in place of or besides the registered ones.
    parsers: Mapping[str, Parser] | None = None
    # Networks and their countries (see lookup.load_networks); without them public addresses stay unresolved.
    networks: Networks | None = None


def decode(frame: DataFrame, value: str = "value") -> DataFrame:
    """JSON envelopes in column `value` (text or bytes) to raw columns plus the failure, if any."""
    payload = F.col(value)
    if dict(frame.dtypes)[value] == "binary":
        valid = F.is_valid_utf8(payload.cast("string"))
        shown = F.make_valid_utf8(payload.cast("string"))
    else:
        valid, shown = F.is_valid_utf8(payload), F.make_valid_utf8(payload)
    others = [c for c in frame.columns if c != value]
    frame = frame.select(*others, shown.alias("_text"), F.coalesce(valid, F.lit(False)).alias("_valid"))
    text = F.col("_text")
    bare = F.btrim(text, F.lit(J.WHITESPACE))
    frame = frame.withColumn("_json", F.when(F.col("_valid") & bare.startswith("{"), J.members(text, RAW_COLUMNS)))
    frame = frame.withColumn("_is_object", J.is_object(F.col("_json")))
    member = {name: J.member(F.col("_json"), name) for name in RAW_COLUMNS}
    missing = F.concat_ws(", ", *[
        F.when(~J.is_truthy(member[name]), name) for name in fixed.REQUIRED_RAW_FIELDS
    ])
    frame = frame.withColumn("_missing", F.when(F.col("_is_object"), missing))
    reason = (
        F.when(text.isNull(), "no payload")
        .when(~F.col("_valid"), "payload is not valid UTF-8")
        .when(
            ~F.col("_is_object"),
            F.when(J.is_json(text), "envelope is not an object").otherwise("invalid JSON envelope"),
        )
        .when(
            F.col("_missing") != "",
            F.concat(F.lit("envelope missing required field(s): "), F.col("_missing")),
        )
    )
    # Text fields must be text, but only validation says so; the raw line is read as text either way.
    wrong = F.array_compact(F.array(*[
        F.when(~J.kind(member[n]).isin("STRING", "VOID"), n) for n in ("event_id", "host", "ingested_at", "service")
    ]))
    frame = frame.withColumn("_reason", reason)
    failed = F.col("_reason").isNotNull()
    return frame.select(
        *others,
        # After a failed decode nothing in the payload is trusted.
        *[F.when(~failed, J.text_of(member[name])).alias(name) for name in RAW_COLUMNS],
        F.when(failed, "decode").alias("_stage"),
        "_reason",
        F.when(~failed, wrong).otherwise(F.array().cast("array<string>")).alias("_bad_types"),
        # Whole, so that it can be replayed.
        text.alias("_original"),
    )


def accept(raw: DataFrame) -> DataFrame:
    """Raw columns that never were JSON text, put in the form `process` takes."""
    missing = F.concat_ws(", ", *[
        F.when(F.coalesce(F.col(name) == "", F.lit(True)), name) for name in fixed.REQUIRED_RAW_FIELDS
    ])
    failed = missing != ""
    return raw.select(
        "*",
        F.when(failed, "decode").alias("_stage"),
        F.when(failed, F.concat(F.lit("envelope missing required field(s): "), missing)).alias("_reason"),
        F.array().cast("array<string>").alias("_bad_types"),
        F.lit(None).cast("string").alias("_original"),
    )


def process(raw: DataFrame, as_of: Column, options: Options) -> DataFrame:
    """Parse, enrich, redact and validate. Takes `decode` or `accept` output, or plain raw columns.

    The result has the parsed columns, `_stage` and `_reason` of the first failure (null: none) and the
    original record; other input columns stay.
    """
    if "_stage" not in raw.columns:
        raw = accept(raw)
    extra = [c for c in raw.columns if c not in RAW_COLUMNS and c not in _WORK]
    fine = F.col("_stage").isNull()
    # A row that failed already is given no format, so that no parser works on it.
    frame = raw.withColumn("_format", F.col("source_format")).withColumn(
        "source_format", F.when(fine, F.col("source_format")))
    frame = parse(frame, parsers=options.parsers)
    p = {name: F.col(f"_parse.{name}") for name in (
        "timestamp client_ip http_method path status_code response_bytes response_time_ms log_level "
        "message user_agent referer trace_id").split()}

    # A client that is not text has no place and no hash; validation rejects its row anyway.
    client = F.when(~F.array_contains("_parse.bad_types", "client_ip"), p["client_ip"])
    if options.networks:
        frame = located(enrich.with_geo(frame, client, address="_address"), options.networks)
    else:
        frame = enrich.with_geo(frame, client)
    fields = {
        "event_id": F.col("event_id"),
        "timestamp": p["timestamp"],
        "ingested_at": F.col("ingested_at"),
        "processed_at": as_of,
        "host": F.col("host"),
        "service": F.col("service"),
        "source_format": F.col("_format"),
        "client_ip": p["client_ip"] if options.keep_client else F.lit(None).cast("string"),
        "client_ip_hash": redact.client_hash(client, options.salt),
        "geo_country": F.col("_geo.country"),
        "geo_source": F.col("_geo.source"),
        "http_method": p["http_method"],
        "path": p["path"],
        "path_group": enrich.path_group(p["path"]),
        "status_code": p["status_code"],
        "response_bytes": p["response_bytes"],
        "response_time_ms": p["response_time_ms"],
        "log_level": p["log_level"],
        "is_error": enrich.is_error(p["status_code"], p["log_level"]),
        "message": redact.scrub_text(p["message"]),
        "user_agent": p["user_agent"],
        "referer": p["referer"],
        "trace_id": p["trace_id"],
    }
    frame = frame.select(
        *extra,
        *[fields[name].alias(name) for name in PARSED_COLUMNS],
        "_stage", "_reason", "_bad_types", "_original", "raw_message", F.col("ingested_at").alias("_ingested_at"),
        F.col("_parse.error").alias("_parse_error"), F.col("_parse.bad_types").alias("_parse_bad_types"),
    )
    bad = F.concat("_bad_types", "_parse_bad_types")
    if not options.keep_client:
        # With the raw client dropped its type is no longer looked at.
        bad = F.array_remove(bad, "client_ip")
    frame = frame.withColumn("_bad", bad).withColumn(
        "_problem", F.when(F.col("_stage").isNull() & F.col("_parse_error").isNull(), first_problem("_bad"))
    )
    failed_parse, failed_check = F.col("_parse_error").isNotNull(), F.col("_problem").isNotNull()
    typed = {
        f.name: F.col(f.name).try_cast(f.dataType) if f.name != "ingested_at" else best_effort_time(F.col(f.name))
        for f in PARSED_SCHEMA
    }
    # The record as it came, for replay; written out only for rows that failed.
    whole = F.to_json(F.struct(
        "event_id", F.col("_ingested_at").alias("ingested_at"), "host", "service", "source_format", "raw_message"))
    original = F.coalesce(
        "_original", F.when(F.col("_stage").isNotNull() | failed_parse | failed_check, F.nullif(whole, F.lit("{}"))))
    return frame.select(settled(
        *extra,
        *[typed[name].alias(name) for name in PARSED_COLUMNS],
        F.coalesce("_stage", F.when(failed_parse, "parse"), F.when(failed_check, "validate")).alias("_stage"),
        F.coalesce("_reason", "_parse_error", "_problem").alias("_reason"),
        original.alias("_original"),
    ))


def route(processed: DataFrame) -> DataFrame:
    """One row per output: `parsed`, a further copy under `errors`, or `dlq`, in column `route`.

    One pass serves all three outputs; they are not filtered out of three runs of the same plan.
    """
    outputs = F.when(F.col("_stage").isNotNull(), F.array(F.lit("dlq"))).when(
        F.col("is_error"), F.array(F.lit("parsed"), F.lit("errors"))
    ).otherwise(F.array(F.lit("parsed")))
    return processed.select("*", F.explode(outputs).alias("route"))


def parsed_rows(routed: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return routed.filter(F.col("route") == "parsed").select(*extra, *PARSED_COLUMNS)


def error_rows(routed: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return routed.filter(F.col("route") == "errors").select(*extra, *PARSED_COLUMNS)


def dead_letter_columns() -> list[Column]:
    """The columns of a dead-letter record, from a routed row."""
    build = {
        "event_id": F.col("event_id"),
        "failed_at": F.col("processed_at"),
        "error_reason": F.col("_reason"),
        "error_stage": F.col("_stage"),
        "service": F.col("service"),
        "original": F.col("_original"),
    }
    return [build[n].cast(DLQ_SCHEMA[n].dataType).alias(n) for n in DLQ_COLUMNS]


def dead_letters(routed: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Dead-letter records: id and service are known unless decoding failed."""
    return routed.filter(F.col("route") == "dlq").select(*extra, *dead_letter_columns())
