import datetime
import json

import pytest
from pyspark.sql import functions as F

from sparklogs import fixed
from sparklogs.functions.parsers import parse, parse_access_log, register_parser
from sparklogs.functions.text import iso_timestamp

NGINX, JSON = "nginx_combined", "json_app"
SEEN = datetime.datetime(2025, 3, 5, 7, 8, 9)
FIELDS = {"client": "192.0.2.7", "ident": "-", "user": "-", "stamp": "[05/Mar/2025:07:08:09 +0000]",
          "request": '"PUT /depot/7?full=1 HTTP/1.1"', "status": "202", "size": "31"}


def access(tail="", **changed):
    """An access line with some of its fields changed."""
    return " ".join({**FIELDS, **changed}.values()) + tail


def app(**members):
    return json.dumps({"time": "2025-03-05T07:08:09Z", **members})


def run(spark, cases):
    """Parse (format, line) pairs; one struct per case, in order."""
    frame = spark.createDataFrame(
        [(i, f, line) for i, (f, line) in enumerate(cases)], "i int, source_format string, raw_message string")
    return [r["_parse"] for r in sorted(parse(frame).collect(), key=lambda r: r["i"])]


def test_good_access_lines(spark):
    agent = ' "https://shop.example/cart?a=b" "probe/2 (ü; \x01)"'
    plain, timed, combined, both, odd = run(spark, [(NGINX, line) for line in (
        access(), access(" 2.5"), access(agent, user="ada"), access(agent + " 0.031"),
        "\t" + access(' "" "-"', stamp="[05/Mar/2025:07:08:09 -0730]", request='"put / HTTP/1.1"', size="-", client="host-1.example") + "\u3000",
    )])
    assert all(r.error is None for r in (plain, timed, combined, both, odd))
    assert (plain.client_ip, plain.http_method, plain.path) == ("192.0.2.7", "PUT", "/depot/7?full=1")
    assert (plain.status_code, plain.response_bytes, plain.timestamp) == (202, 31, SEEN)
    assert [r.response_time_ms for r in (plain, timed, combined, both)] == [None, 2500, None, 31]
    assert plain.referer is None and plain.user_agent is None
    for row in (combined, both):
        assert (row.referer, row.user_agent) == ("https://shop.example/cart?a=b", "probe/2 (ü; \x01)")
    assert (odd.client_ip, odd.http_method, odd.response_bytes, odd.referer, odd.user_agent) == ("host-1.example", "PUT", 0, "", "-")
    assert odd.timestamp == SEEN + datetime.timedelta(hours=7, minutes=30)


def test_level_from_status(spark):
    statuses = range(100, 600, 33)
    rows = run(spark, [(NGINX, access(status=str(s))) for s in statuses] + [(JSON, app(status=s)) for s in statuses])
    assert [r.log_level for r in rows] == 2 * ["ERROR" if s >= 500 else "WARN" if s >= 400 else "INFO" for s in statuses]


def test_bad_access_lines(spark):
    wrong = {
        "ident": [""], "stamp": ["[05/Mar/2025:07:08:09 +0000", "05/Mar/2025:07:08:09", "[05/Mrz/2025:07:08:09 +0000]", "[]"],
        "request": ['""', '"/depot"', '"7 /depot HTTP/1.1"', '"PUT'], "status": ["20", "2x2", "-"], "size": ["much", "-1"],
    }
    lines = [access(**{name: value}) for name, values in wrong.items() for value in values]
    words = access().split(" ")
    lines += [" ".join(words[:n]) for n in range(len(words) - 1)]
    lines += ["\t ", app(), "\x00\x7f"]
    assert [r.error is not None for r in run(spark, [(NGINX, line) for line in lines])] == [True] * len(lines)


def test_good_json_lines(spark):
    names = {
        "status_code": ("status_code", "status"), "path": ("path", "uri"), "client_ip": ("client_ip", "remote_addr"),
        "message": ("message", "msg"), "log_level": ("level", "severity"), "trace_id": ("trace_id", "traceId"),
    }
    values = {"status_code": 418, "path": "/tea", "client_ip": "192.0.2.7", "message": "short", "log_level": "FATAL", "trace_id": "t-1"}
    rows = run(spark, [(JSON, app(**{names[field][i]: value for field, value in values.items()})) for i in (0, 1)])
    for row in rows:
        assert row.error is None and row.timestamp == SEEN
        assert {field: row[field] for field in values} == values
    seconds = int(SEEN.replace(tzinfo=datetime.timezone.utc).timestamp())
    times = run(spark, [(JSON, json.dumps({key: value})) for key in fixed.TIMESTAMP_KEYS
                        for value in (seconds, seconds * 1000, SEEN.isoformat() + "Z", "2025-03-05T08:08:09+01:00")])
    assert [r.timestamp for r in times] == [SEEN] * len(times)
    spans = run(spark, [(JSON, app(response_time_ms=7)), (JSON, app(duration_ms=7)), (JSON, app(duration=0.007))])
    assert [r.response_time_ms for r in spans] == [7] * 3


def test_bad_json_lines(spark):
    good = app(status=200, nested={"a": [1]})
    lines = [good[:n] for n in range(len(good))]  # no beginning of an object is one
    lines += [good + tail for tail in ("]", " x", "," + good)] + [f"[{good}]", json.dumps(good), good.replace('"', "'")]
    lines += [json.dumps({"message": "when?"})] + [json.dumps({"time": t}) for t in (None, "", "soon", [1], {}, "2025")]
    assert [r.error is not None for r in run(spark, [(JSON, line) for line in lines])] == [True] * len(lines)


def test_json_oddities(spark):
    lines = {
        '{"time":1,"time":1741158489}': ("timestamp", SEEN),
        '{"time":1,"status":"404"}': ("status_code", 404),
        '{"time":1,"status":"4_04"}': ("status_code", 404),
        '{"time":1,"status":"4.5"}': ("status_code", None),
        '{"time":1,"bytes":3.9}': ("response_bytes", 3),
        '{"time":1,"bytes":true}': ("response_bytes", 1),
        '{"time":1,"bytes":123456789012345678901234567890}': ("response_bytes", -1),
        '{"time":1,"duration":"0.0005"}': ("response_time_ms", 0),
        '{"time":1,"duration":"nope"}': ("response_time_ms", None),
        '{"time":1,"duration_ms":"nope","duration":2}': ("response_time_ms", 2000),
        '{"time":1,"level":"err"}': ("log_level", "ERROR"),
        '{"time":1,"level":" critical "}': ("log_level", "FATAL"),
        '{"time":1,"level":"loud","status":500}': ("log_level", "ERROR"),
        '{"time":1,"traceId":"","traceID":"b"}': ("trace_id", "b"),
        '{"time":1,"message":"","msg":"m"}': ("message", "m"),
        '{"time":1,"user_agent":""}': ("user_agent", ""),
        '{"time":1,"message":5}': ("bad_types", ["message"]),
        '{"time":1,"client_ip":{"a":1},"referer":1}': ("bad_types", ["client_ip", "referer"]),
        '{"time":1,"x":NaN}': ("error", None),
    }
    for (line, (field, value)), row in zip(lines.items(), run(spark, [(JSON, line) for line in lines])):
        assert row.error is None, line
        assert row[field] == value, line


def test_unknown_format_and_own_parser(spark):
    (unknown,) = run(spark, [("no_such_format", access())])
    assert unknown.error == "unknown source_format 'no_such_format'"
    register_parser("apache", parse_access_log)
    try:
        (row,) = run(spark, [("apache", access())])
        assert row.error is None and row.status_code == 202
    finally:
        from sparklogs.functions import parsers

        del parsers._PARSERS["apache"]


DAYS = ["2025-03-05", "20250305", "2025-13-05", "2025-0305", "2025-03", "2025", "soon", ""]
CLOCKS = ["", "T07", "T07:08", "T070809", " 07:08:09", "T07:08:09.25", "T07:08:09,5", "T07:08:09.1234567", "T25:00"]
ZONES = ["", "Z", "+05:30", "-03", "+0200", " UTC"]


@pytest.mark.parametrize("day", DAYS)
def test_iso_times_as_in_python(spark, day):
    def expected(text):
        try:
            moment = datetime.datetime.fromisoformat(text.replace("Z", "+00:00"))
        except ValueError:
            return None
        return moment.astimezone(datetime.timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment

    texts = [day + clock + zone for clock in CLOCKS for zone in ZONES]
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", iso_timestamp(F.col("s")).alias("t")).collect()
    assert {r.s: r.t for r in rows} == {t: expected(t) for t in texts}
