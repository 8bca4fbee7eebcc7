"""Lines and request bodies to raw records."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed
from ..functions import envelope as E, jsonvalue as J
from ..functions.text import iso_text, settled
from ..schemas import RAW_SCHEMA
from . import lookup


def build_envelope(
    lines: DataFrame,
    source_format: str,
    as_of: Column,
    line: str = "value",
    service: str | None = None,
    host: str | None = None,
    tags: dict[str, str] | None = None,
    rewrite: bool = True,
) -> DataFrame:
    """Raw records from text lines; blank lines are dropped, other columns of `lines` stay.

    A service or host given here beats the one a JSON line names, which beats the one derived from the
    line. `rewrite` moves access-log stamps to `as_of`; `tags` become further columns.
    """
    extra = [c for c in lines.columns if c != line]
    frame = lines.filter(~E.is_blank(F.col(line)))
    text = E.chop(F.col(line))
    if rewrite:
        text = E.rewrite_timestamp(text, as_of)
    frame = frame.select(*extra, text.alias("raw_message"))
    raw = F.col("raw_message")
    path, derived_host = E.extract_path(raw), E.derive_host(raw)
    if source_format == "json_app":
        frame = frame.withColumn("_json", J.members(raw, fixed.SERVICE_KEYS + fixed.HOST_KEYS))
        named = F.when(J.is_object(F.col("_json")), F.struct(
            E.json_identity(F.col("_json"), fixed.SERVICE_KEYS).alias("service"),
            E.json_identity(F.col("_json"), fixed.HOST_KEYS).alias("host"),
        ))
        frame = frame.withColumn("_named", named)
        found_service = F.coalesce("_named.service", E.derive_service(path))
        found_host = F.coalesce("_named.host", derived_host)
    else:
        found_service, found_host = E.derive_service(path), derived_host
    frame = frame.withColumns({
        "service": F.lit(service) if service else found_service,
        "host": F.lit(host) if host else found_host,
    })
    built = {
        "event_id": E.event_id(F.col("host"), F.col("service"), raw),
        "ingested_at": iso_text(as_of),
        "host": F.col("host"),
        "service": F.col("service"),
        "source_format": F.lit(source_format),
        "raw_message": raw,
    }
    return frame.select(settled(
        *extra,
        *[built[name].alias(name) for name in RAW_SCHEMA.fieldNames()],
        *[F.lit(value).alias(name) for name, value in (tags or {}).items()],
    ))


def check_bodies(lines: DataFrame, body: str, longest: int) -> DataFrame:
    """Add `too_many`: true for every line of a body with more lines than allowed; `judge_json` rejects these.

    Lines per body are counted with partial aggregation; only the bodies above the limit come back, by a broadcast up to
    a number of them, so that no task is given the lines of a whole body.
    """
    sizes = lines.groupBy(body).agg(F.count("*").alias("_size")).filter(F.col("_size") > longest)
    sizes = lookup.bounded(sizes, "long-bodies")
    return lines.join(sizes, body, "left").withColumn("too_many", F.col("_size").isNotNull()).drop("_size")


def judge_json(lines: DataFrame, line: str = "value", as_of: Column | None = None) -> DataFrame:
    """JSON application logs at the door: `reject` (null: accepted), `error`, and the line to forward.

    Accepted lines are minified; one without a usable time gets `as_of` as its timestamp and is flagged
    in `timestamp_defaulted`. A time that is there is never touched. Lines marked `too_many` by `check_bodies` are
    rejected whatever they hold, so that every report tells the same.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    extra = [c for c in lines.columns if c != line]
    bare = F.btrim(F.col(line), F.lit(J.WHITESPACE))
    frame = lines.select(*extra, bare.alias("_line")).filter(F.col("_line") != "")
    text = F.col("_line")
    frame = frame.withColumn("_json", F.when(text.startswith("{"), J.members(text, fixed.TIMESTAMP_KEYS)))
    frame = frame.withColumn("_ok", J.is_object(F.col("_json")))
    frame = frame.withColumn("_timed", F.when(
        F.col("_ok"), J.first_truthy(F.col("_json"), fixed.TIMESTAMP_KEYS).isNotNull()))
    reject = F.when(~F.col("_ok"), F.when(J.is_json(text), "not_an_object").otherwise("invalid_json"))
    if "too_many" in extra:
        reject = F.when(F.col("too_many"), "too_many_lines").otherwise(reject)
    reason = F.when(F.col("_reject") == "not_an_object", "not a JSON object").when(
        F.col("_reject") == "invalid_json", "invalid JSON").when(F.col("_reject") == "too_many_lines", "too many lines")
    stamped = F.concat(
        F.regexp_replace(F.col("_short"), r"\}$", ""),
        F.when(F.col("_short") == "{}", "").otherwise(","),
        F.lit('"timestamp":"'), iso_text(as_of), F.lit('"}'),
    )
    return (
        frame.withColumn("_reject", reject)
        .withColumn("_short", F.when(F.col("_ok"), J.minify(text)))
        .select(settled(
            *extra,
            F.when(F.col("_ok"), F.when(F.col("_timed"), F.col("_short")).otherwise(stamped)).otherwise(text).alias(line),
            F.col("_reject").alias("reject"),
            reason.alias("error"),
            F.coalesce(~F.col("_timed") & F.col("_reject").isNull(), F.lit(False)).alias("timestamp_defaulted"),
        ))
    )


def accepted_lines(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject").isNull()).drop("reject", "error", "timestamp_defaulted", "too_many")


def intake_report(judged: DataFrame, body: str) -> DataFrame:
    """Accepted, rejected and time-stamped lines of each body."""
    return judged.groupBy(body).agg(
        F.count_if(F.col("reject").isNull()).alias("accepted"),
        F.count_if(F.col("reject").isNotNull()).alias("rejected"),
        F.count_if("timestamp_defaulted").alias("timestamp_defaulted"),
    )


def intake_errors(judged: DataFrame, body: str, line: str, most: int | None = None) -> DataFrame:
    """The rejected lines of each body; with `most`, only so many from its start."""
    first = F.row_number().over(Window.partitionBy(body).orderBy(line))
    bad = judged.filter(F.col("reject").isNotNull()).select(body, line, "error")
    if most is None:
        return bad
    return bad.withColumn("_n", first).filter(F.col("_n") <= most).drop("_n")


def rejects_by_reason(judged: DataFrame, bodies: DataFrame | None = None) -> DataFrame:
    """Rejected lines by reason; `bodies` (see files.rejected_bodies) adds those refused whole, each counted once."""
    reasons = judged.select(F.col("reject").alias("reason")).filter(F.col("reason").isNotNull())
    if bodies is not None:
        reasons = reasons.unionByName(bodies.select("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("lines"))


def raw_intake(lines: DataFrame, as_of: Column, source_format: str = "nginx_combined", **names: str) -> DataFrame:
    """Lines taken as they are: nothing is parsed or rejected, only blank lines go."""
    return build_envelope(lines, source_format, as_of, rewrite=False, **names)


def one_stream(*envelopes: DataFrame) -> DataFrame:
    """Envelopes of every intake shape as one frame; tags that only some have are null elsewhere."""
    whole = envelopes[0]
    for more in envelopes[1:]:
        whole = whole.unionByName(more, allowMissingColumns=True)
    return whole
