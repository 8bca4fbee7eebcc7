"""Page-edit feed as JSON application logs."""

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions.text import constant_map

LOG_FIELDS = [
    "timestamp", "service", "host", "level", "message", "client_ip", "http_method", "path", "status_code",
    "response_bytes", "trace_id", "wiki_change_type", "wiki_is_bot", "wiki_is_minor", "wiki_bytes_delta",
]


def is_revert(comment: Column) -> Column:
    return F.coalesce(comment.rlike(r"(?i)\b(?:" + "|".join(fixed.REVERT_WORDS) + r")\b"), F.lit(False))


def quoted_path(title: Column) -> Column:
    """Title as a URL path: spaces become `_`; `/`, `:` and unreserved characters stay as they are."""
    path = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for encoded, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/"), ("%3A", ":")):
        path = F.replace(path, F.lit(encoded), F.lit(plain))
    return F.concat(F.lit("/wiki/"), path)


def filled(column: str) -> Column:
    """The column, an empty text as null."""
    return F.nullif(F.col(column), F.lit(""))


def skip_reason(server_names: list[str] | None = None, include_bots: bool = False) -> Column:
    """Why a change is not forwarded: wiki_filtered, bot, unmappable; null when it is."""
    reason = F.lit(None).cast("string")
    unmappable = F.coalesce(filled("server_name"), filled("meta.domain")).isNull()
    untimed = F.coalesce("meta.dt", F.lit("")).isin("") & F.col("timestamp").isNull()
    reason = F.when(unmappable | untimed, "unmappable")
    if not include_bots:
        reason = F.when(F.coalesce("bot", F.lit(False)), "bot").otherwise(reason)
    if server_names:
        wanted = F.coalesce(F.col("server_name").isin(server_names), F.lit(False))
        reason = F.when(~wanted, "wiki_filtered").otherwise(reason)
    return reason


def skipped_by_reason(changes: DataFrame, **choice) -> DataFrame:
    reasons = changes.select(skip_reason(**choice).alias("reason")).filter(F.col("reason").isNotNull())
    return reasons.groupBy("reason").agg(F.count("*").alias("n"))


def map_changes(changes: DataFrame, extra: tuple[str, ...] = (), **choice) -> DataFrame:
    """Changes as application-log fields, comments whole; those with a skip reason are left out."""
    kind = F.coalesce("type", F.lit("unknown"))
    comment, title = F.coalesce("comment", F.lit("")), F.coalesce("title", F.lit(""))
    epoch = F.date_format(F.timestamp_seconds("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    bot = F.coalesce("bot", F.lit(False))
    built = {
        "timestamp": F.coalesce(filled("meta.dt"), epoch),
        "service": F.coalesce(filled("server_name"), filled("meta.domain")),
        "host": F.coalesce(filled("wiki"), F.lit("wikimedia")),
        "level": F.when(is_revert(comment), "WARN").when(bot, "DEBUG").otherwise("INFO"),
        "message": F.when(comment != "", comment).otherwise(
            F.concat(kind, F.lit(" on "), title)),
        "client_ip": F.col("user"),
        "http_method": F.when(kind.isin("edit", "new"), "POST").otherwise("GET"),
        "path": quoted_path(title),
        "status_code": F.coalesce(F.try_element_at(constant_map(fixed.STATUS_BY_CHANGE), kind), F.lit(200)),
        "response_bytes": F.col("length.new"),
        "trace_id": filled("meta.id"),
        "wiki_change_type": kind,
        "wiki_is_bot": bot,
        "wiki_is_minor": F.coalesce("minor", F.lit(False)),
        "wiki_bytes_delta": F.col("length.new") - F.col("length.old"),
    }
    kept = changes.filter(skip_reason(**choice).isNull())
    return kept.select(*extra, *[built[name].alias(name) for name in LOG_FIELDS])


def as_json_lines(logs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Log fields as JSON text in column `value`, ready for the intake."""
    return logs.select(*extra, F.to_json(F.struct(*LOG_FIELDS)).alias("value"))


def summary(logs: DataFrame) -> DataFrame:
    """Edits, reverts and distinct editors per server."""
    return logs.groupBy("service").agg(
        F.count("*").alias("edits"), F.count_if(F.col("level") == "WARN").alias("reverts"),
        F.count_distinct("client_ip").alias("editors"))


def editor_kind(user: Column) -> Column:
    return (
        F.when(user.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ipv4")
        .when(user.contains(":") & user.rlike("^[0-9A-Fa-f:.]+$"), "ipv6")
        .when(user.startswith("~"), "temporary")
        .when(user.isNotNull(), "named")
        .otherwise("hidden")
    )


def editor_kinds(logs: DataFrame) -> DataFrame:
    return logs.groupBy(editor_kind(F.col("client_ip")).alias("kind")).agg(F.count("*").alias("n"))
