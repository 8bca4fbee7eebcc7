"""Raw line to typed fields.

A parser adds helper columns to a frame and returns one struct column of PARSE_FIELDS. `error` is null
on success; `bad_types` names text fields that held something else, for validation to reject.
Helper columns keep costly expressions (one regular expression, one JSON parse) evaluated once per row.
"""

from collections.abc import Callable, Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from . import jsonvalue as J
from .text import ASCII_SPACE, SPACE, constant_map, is_ascii, iso_timestamp, strip

PARSE_FIELDS = {
    "error": "string", "timestamp": "timestamp", "client_ip": "string", "http_method": "string",
    "path": "string", "status_code": "bigint", "response_bytes": "bigint", "response_time_ms": "bigint",
    "log_level": "string", "message": "string", "user_agent": "string", "referer": "string",
    "trace_id": "string", "bad_types": "array<string>",
}
PARSE_TYPE = "struct<" + ",".join(f"{name}:{kind}" for name, kind in PARSE_FIELDS.items()) + ">"

Parser = Callable[[DataFrame, Column, Column], tuple[DataFrame, Column]]
_PARSERS: dict[str, Parser] = {}


def register_parser(source_format: str, parser: Parser) -> None:
    """Make `parse` use `parser(frame, line, is_mine)` for rows of this source format."""
    _PARSERS[source_format] = parser


def parse_struct(**fields: Column) -> Column:
    """Struct of PARSE_FIELDS; fields not given are null (`bad_types`: empty)."""
    fields.setdefault("bad_types", F.array().cast("array<string>"))
    return F.struct(*[
        fields.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in PARSE_FIELDS.items()
    ])


def parse(raw: DataFrame, out: str = "_parse", parsers: Mapping[str, Parser] | None = None) -> DataFrame:
    """Add column `out`: the parse struct of `raw_message` under its `source_format`.

    `parsers` replaces or adds parsers for this call only.
    """
    frame, columns = raw, raw.columns
    failed = parse_struct(error=F.concat(
        F.lit("unknown source_format '"), F.coalesce(F.col("source_format"), F.lit("")), F.lit("'")
    ))
    chosen = None
    for source_format, parser in {**_PARSERS, **(parsers or {})}.items():
        mine = F.coalesce(F.col("source_format") == source_format, F.lit(False))
        frame, parsed = parser(frame, F.col("raw_message"), mine)
        chosen = F.when(mine, parsed) if chosen is None else chosen.when(mine, parsed)
    return frame.select(*columns, chosen.otherwise(failed).alias(out))


# ---- access logs ----------------------------------------------------------------------------

# Common and Combined log format, either followed by the request time in seconds. Groups: client,
# time, request, status, bytes, (referer and agent together), referer, agent, request time.
def _access_line(space: str) -> str:
    s, n = f"[{space}]", f"[^{space}]"
    return (
        rf'^({n}+){s}+{n}+{s}+{n}+{s}+\[([^\]]+)\]{s}+"([^"]*)"{s}+(\d{{3}}){s}+(\d+|-)'
        rf'({s}+"([^"]*)"{s}+"([^"]*)")?(?:{s}+(\d+(?:\.\d+)?))?{s}*$'
    )


ACCESS_LINE, ACCESS_LINE_ASCII = _access_line(SPACE), _access_line(ASCII_SPACE)
_GROUPS = 9
_CUT = "\x01"


def level_from_status(status: Column) -> Column:
    return F.when(status >= 500, "ERROR").when(status >= 400, "WARN").otherwise("INFO")


def clf_timestamp(text: Column) -> Column:
    """`30/Jul/2026:18:40:55 +0000` to TIMESTAMP, or null. `+00:00` and `Z` offsets are accepted."""
    usual = text.rlike(r"^\d{1,2}/[A-Za-z]{3}/\d{4}:\d{1,2}:\d{1,2}:\d{1,2} [+-]\d{4}$")
    offset = F.regexp_replace(F.regexp_replace(text, rf"[{SPACE}]+Z$", " +0000"), r"([+-]\d{2}):(\d{2})$", "$1$2")
    tidy = F.when(usual, text).otherwise(F.regexp_replace(offset, rf"[{SPACE}]+(?=[+-]\d{{4}}$)", " "))
    return F.try_to_timestamp(tidy, F.lit("d/MMM/yyyy:H:m:s Z"))


def millis(seconds: Column) -> Column:
    """Seconds to whole milliseconds, half to even; out of range becomes -1, which validation rejects."""
    rounded = F.bround(seconds * 1000, 0)
    return F.when(seconds.isNotNull(), F.coalesce(rounded.try_cast("bigint"), F.lit(-1).cast("bigint")))


def parse_access_log(frame: DataFrame, line: Column, mine: Column) -> tuple[DataFrame, Column]:
    frame = frame.withColumn("_line", F.when(mine, strip(line)))
    text = F.col("_line")
    # One pass of the pattern: on a match the line becomes its nine groups, else it stays whole.
    cut = _CUT.join(f"${i}" for i in range(1, _GROUPS + 1))
    joined = F.when(is_ascii(text), F.regexp_replace(text, ACCESS_LINE_ASCII, cut)).otherwise(
        F.regexp_replace(text, ACCESS_LINE, cut))
    by_group = F.array(*[F.regexp_extract(text, ACCESS_LINE, i) for i in range(1, _GROUPS + 1)])
    groups = F.when(
        text.contains(_CUT), F.when(text.rlike(ACCESS_LINE), by_group).otherwise(F.array(text))
    ).otherwise(F.split(joined, _CUT))
    frame = frame.withColumn("_g", groups)
    g = [F.get(F.col("_g"), i) for i in range(_GROUPS)]
    request = rf"^[{SPACE}]*([^{SPACE}]+)[{SPACE}]+([^{SPACE}]+)"
    frame = frame.withColumns({
        "_access_time": clf_timestamp(g[1]),
        "_method": F.regexp_extract(g[2], request, 1),
        "_path": F.regexp_extract(g[2], request, 2),
    })
    method, path = F.col("_method"), F.col("_path")
    matched = F.size("_g") == _GROUPS
    status = g[3].try_cast("bigint")
    both = g[5] != ""
    error = (
        F.when(F.col("_line") == "", "empty line")
        .when(~matched, "does not match access-log format")
        .when(F.col("_access_time").isNull(), F.concat(F.lit("unparseable timestamp '"), g[1], F.lit("'")))
        .when(path == "", F.concat(F.lit("malformed request line '"), g[2], F.lit("'")))
        .when(~method.rlike(r"^\p{L}+$"), F.concat(F.lit("invalid HTTP method '"), method, F.lit("'")))
    )
    return frame, parse_struct(
        error=error,
        timestamp=F.col("_access_time"),
        client_ip=g[0],
        http_method=F.upper(method),
        path=path,
        status_code=status,
        response_bytes=F.when(g[4] == "-", 0).otherwise(
            F.coalesce(g[4].try_cast("bigint"), F.lit(-1).cast("bigint"))),
        response_time_ms=F.when(g[8] != "", millis(g[8].try_cast("double"))),
        log_level=level_from_status(status),
        user_agent=F.when(both, g[7]),
        referer=F.when(both, g[6]),
    )


# ---- JSON application logs ------------------------------------------------------------------


def json_timestamp(value: Column) -> Column:
    """Epoch seconds, epoch milliseconds (above 1e11) or ISO-8601 text; null when neither."""
    number = J.real_number(value)
    seconds = F.when(number > 1e11, number / 1000).otherwise(number)
    in_range = seconds.between(-62135596800, 253402300799)
    return F.when(J.kind(value) == "STRING", iso_timestamp(J.text_of(value))).when(
        in_range, F.timestamp_micros(F.bround(seconds * 1_000_000, 0).try_cast("bigint"))
    )


def json_level_name(value: Column) -> Column:
    """Upper-case level text under its usual name; null when the value is not text."""
    name = F.when(J.kind(value) == "STRING", F.upper(strip(J.text_of(value))))
    return F.coalesce(F.try_element_at(constant_map(fixed.LEVEL_SYNONYMS), name), name)


def json_app_parser(**aliases: list[str]) -> Parser:
    """A parser of JSON application logs; any alias list may be replaced by keyword."""
    keys = {
        "timestamp": fixed.TIMESTAMP_KEYS, "client_ip": fixed.CLIENT_KEYS, "http_method": fixed.METHOD_KEYS,
        "path": fixed.PATH_KEYS, "status_code": fixed.STATUS_KEYS, "response_bytes": fixed.BYTES_KEYS,
        "duration_ms": fixed.DURATION_MS_KEYS, "duration_s": fixed.DURATION_S_KEYS,
        "level": fixed.LEVEL_KEYS, "message": fixed.MESSAGE_KEYS, "trace_id": fixed.TRACE_KEYS,
        **aliases,
    }

    def parser(frame: DataFrame, line: Column, mine: Column) -> tuple[DataFrame, Column]:
        frame = frame.withColumn("_json_line", F.when(mine, strip(line)))
        text = F.col("_json_line")
        names = list(dict.fromkeys(chain(*keys.values(), ("user_agent", "referer"))))
        frame = frame.withColumn("_json", F.when(text.startswith("{"), J.members(text, names)))
        parsed = F.col("_json")
        picked = [J.first_present("_json", names).alias(field) for field, names in keys.items()]
        picked += [J.member(parsed, name).alias(name) for name in ("user_agent", "referer")]
        frame = frame.withColumn("_v", F.when(J.is_object(parsed), F.struct(*picked)))
        v = {name: F.col(f"_v.{name}") for name in [*keys, "user_agent", "referer"]}

        frame = frame.withColumns({
            "_json_time": json_timestamp(v["timestamp"]),
            "_status": J.whole_number(v["status_code"]),
            "_ms": J.whole_number(v["duration_ms"]),
            "_level": json_level_name(v["level"]),
        })
        method = F.when(J.is_truthy(v["http_method"]), v["http_method"])
        texts = {
            "client_ip": v["client_ip"], "http_method": method, "path": v["path"], "message": v["message"],
            "trace_id": v["trace_id"], "user_agent": v["user_agent"], "referer": v["referer"],
        }
        bad_types = F.array_compact(F.array(*[
            F.when(~J.kind(value).isin("STRING", "VOID"), name) for name, value in texts.items()
        ]))
        error = (
            F.when(text == "", "empty line")
            .when(F.col("_v").isNull(), F.when(J.is_json(text), "expected a JSON object").otherwise("invalid JSON"))
            .when(v["timestamp"].isNull(), "no timestamp field (looked for " + ", ".join(keys["timestamp"]) + ")")
            .when(
                F.col("_json_time").isNull(),
                F.concat(F.lit("unparseable timestamp '"), J.text_of(v["timestamp"]), F.lit("'")),
            )
        )
        return frame, parse_struct(
            error=error,
            timestamp=F.col("_json_time"),
            status_code=F.col("_status"),
            response_bytes=J.whole_number(v["response_bytes"]),
            response_time_ms=F.coalesce(F.col("_ms"), millis(J.real_number(v["duration_s"]))),
            log_level=F.when(F.col("_level").isin(fixed.LEVELS), F.col("_level")).otherwise(
                level_from_status(F.col("_status"))),
            bad_types=bad_types,
            **{name: J.text_of(value) for name, value in texts.items()},
        )

    return parser


parse_json_app = json_app_parser()
register_parser("nginx_combined", parse_access_log)
register_parser("json_app", parse_json_app)
