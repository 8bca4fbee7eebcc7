import hashlib
import ipaddress
import itertools
import random
import re

from pyspark.sql import functions as F

from sparklogs import fixed
from sparklogs.functions import enrich, redact
from sparklogs.functions.validate import check_columns, first_problem
from sparklogs.operators import dedupe, pipeline, recon
from sparklogs.schemas import PARSED_COLUMNS

import pytest

AS_OF = "2026-08-01 00:00:00"
LINE = 'host.jp - - [30/Jul/2026:18:40:55 +0000] "GET /a/b HTTP/1.0" 200 10'


def at(text):
    return F.lit(text).cast("timestamp")


def geo(spark, clients):
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(clients)], "i int, c string")
    rows = enrich.with_geo(frame, F.col("c")).orderBy("i").collect()
    return [tuple(r["_geo"]) for r in rows]


def test_private_addresses(spark):
    ends = [str(address) for block in fixed.PRIVATE_IPV4 for address in (ipaddress.ip_network(block)[0], ipaddress.ip_network(block)[-1])]
    clients = [c for c in ends if c not in fixed.GLOBAL_IPV4]
    assert geo(spark, clients) == [(None, "private")] * len(clients)
    assert geo(spark, fixed.GLOBAL_IPV4) == [(None, "unresolved")] * len(fixed.GLOBAL_IPV4)


def test_countries(spark):
    known = {**fixed.COUNTRY_BY_TLD, **{tld: "US" for tld in fixed.US_ONLY_TLDS}}
    cases = {form.format(tld): country for tld, country in known.items() if len(tld) == 2 or country == "US"
             for form in ("{}", "host.{}", "a-1.b.c.{}")}
    cases |= {name.upper(): country for name, country in cases.items()}
    cases |= {"host.invalid": None, "host": None, "host.": None, "": None, None: None, "1.1.1.1": None}
    assert geo(spark, list(cases)) == [(c, "tld" if c else "unresolved") for c in cases.values()]


def test_addresses_as_in_the_standard_library(spark):
    rng = random.Random(7)
    texts = ["::", "::1", "1::", ":::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "12345::",
             "::ffff:8.8.8.8", "64:ff9b::8.8.8.8", "::8.8.8.256", "1.2.3.4::", "fe80::1%eth0", "fe80::1%", "2001:1::1", "2001:1::3",
             "2001:3::9", "2001:4:112::1", "2001:20::1", "2001:db8::1", "2002::1", "fec0::1", "ff02::1", "2606:4700::1111", "g::1",
             "01.2.3.4", "1.2.3", "192.0.0.9", "192.0.0.10", "192.0.0.11", "100.64.0.1", "224.0.0.1", "240.0.0.1", "2A00::ABCD", "1:::2"]
    texts += [str(ipaddress.IPv6Address(rng.getrandbits(128) >> rng.choice([0, 0, 3, 64, 100]))) for _ in range(300)]
    texts += [ipaddress.IPv6Address(rng.getrandbits(128)).exploded for _ in range(50)]
    texts += [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(300)]

    def expected(text):
        try:
            a = ipaddress.ip_address(text)
        except ValueError:
            return "name"
        return "private" if a.is_private or a.is_loopback or a.is_link_local or a.is_reserved else "unresolved"

    for text, (_, source) in zip(texts, geo(spark, texts)):
        want = expected(text)
        assert (source if want != "name" else source in ("tld", "unresolved")) == (want if want != "name" else True), text


def test_path_group(spark):
    tails = ["", "/", "/x", "/x/y.txt", "?k=/v", "/?k"]
    cases = {start + name + tail: "/" + name for start in ("/", "//") for name in ("depot", "a.b", "ü") for tail in tails}
    cases |= {"/": "/", "depot/x": None, "": None, None: None}
    frame = spark.createDataFrame([(p,) for p in cases], "p string")
    assert [r.g for r in frame.select(enrich.path_group(F.col("p")).alias("g")).collect()] == list(cases.values())


def test_error_flag(spark):
    cases = list(itertools.product([None, 100, 499, 500, 599], [None, "DEBUG", "WARN", "ERROR", "FATAL"]))
    frame = spark.createDataFrame(cases, "s int, l string")
    got = [r.e for r in frame.select(enrich.is_error(F.col("s"), F.col("l")).alias("e")).collect()]
    assert got == [(s or 0) >= 500 or level == "ERROR" for s, level in cases]


def test_scrub_as_in_python(spark):
    email = re.compile(r"\b[\w.+-]+@[\w-]+\.[\w.-]+\b")
    credential = re.compile(r"\b(?:Bearer|token|api[_-]?key)\s*[=:]?\s*\S{8,}", re.IGNORECASE)
    number = re.compile(r"\b(?:\d[ -]?){13,19}\b")
    rng = random.Random(3)
    texts = ["", None]
    texts += ["".join(rng.choice("ab1 @.-é_ token9") for _ in range(60)) for _ in range(200)]
    # Each kind of value, whole and nearly so, between each kind of neighbour.
    values = ["q.r+s@mail.example.org", "q@ü.example", "bearer ZYXW9876vuts", "Token=ZYXW9876", "API_KEY: ZYXW9876", "token ZYX",
              *["".join(str(n % 10) + gap for n in range(length)) for length in (12, 13, 19, 20) for gap in ("", " ", "-")]]
    texts += [left + value + right for value in values for left in ("", "x", "é", "= ") for right in ("", "é", ".", " x")]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.s for r in frame.select("i", redact.scrub_text(F.col("t")).alias("s")).orderBy("i").collect()]
    for text, out in zip(texts, got):
        want = text
        if text:
            want = number.sub("[redacted-number]", credential.sub("[redacted-credential]", email.sub("[email]", text)))
        assert out == want


def test_client_hash(spark):
    row = spark.createDataFrame([("203.0.113.9", "", None)], "a string, b string, c string").select(
        *[redact.client_hash(F.col(c), "pinch").alias(c) for c in "abc"]).first()
    assert row.a == hashlib.sha256(b"pinch|203.0.113.9").hexdigest()[:32]
    assert row.b is None and row.c is None


OPTIONS = pipeline.Options(salt="pinch")


def raw(spark, rows):
    names = "event_id string, ingested_at string, host string, service string, source_format string, raw_message string"
    return spark.createDataFrame(rows, names)


def test_validation_names_the_first_field(spark):
    base = {n: None for n in PARSED_COLUMNS} | {
        "event_id": "a3f5c1d2e3f4", "ingested_at": "2026-07-30T10:15:32Z", "host": "web-03", "service": "checkout-api",
        "source_format": "json_app", "log_level": "ERROR", "status_code": 500, "geo_source": "private", "timestamp": "x"}
    kinds = {"status_code": "bigint", "response_bytes": "bigint", "response_time_ms": "bigint"}
    cases = [({}, None), ({"log_level": "SEVERE"}, "log_level"), ({"status_code": 999}, "status_code"),
             ({"geo_country": "IND"}, "geo_country"), ({"geo_source": "guess"}, "geo_source"),
             ({"response_bytes": -1}, "response_bytes"), ({"event_id": "short"}, "event_id"),
             ({"host": ""}, "host"), ({"status_code": 10, "event_id": "x"}, "event_id"),
             *[({f: None}, f) for f in ("event_id", "timestamp", "host", "service", "log_level")]]
    columns = [n for n in PARSED_COLUMNS if n not in ("processed_at", "is_error")]
    frame = spark.createDataFrame(
        [(i, *[(base | change)[n] for n in columns]) for i, (change, _) in enumerate(cases)],
        "i int, " + ", ".join(f"{n} {kinds.get(n, 'string')}" for n in columns))
    got = [r.p for r in frame.select("i", first_problem().alias("p")).orderBy("i").collect()]
    assert [g and g.split(":")[0] for g in got] == [f for _, f in cases]
    with pytest.raises(ValueError, match="surprise"):
        check_columns(frame.withColumn("surprise", F.lit(1)), frame.columns)


def test_decode_failures(spark):
    good = ('{"event_id":"abcdefgh","ingested_at":"2026-07-30T10:15:32Z","host":"h","service":"s",'
            '"source_format":"nginx_combined","raw_message":%s,"tag":1}' % ('"' + LINE.replace('"', '\\"') + '"'))
    payloads = [
        (good.encode(), None), (b"\xff\xfe", "payload is not valid UTF-8"), (None, "no payload"), (b"nope", "invalid JSON envelope"),
        (b"[1]", "envelope is not an object"), (good.encode() + b" x", "invalid JSON envelope"),
        (b'{"event_id":"abcdefgh","host":"","service":0,"source_format":"json_app","raw_message":[]}',
         "envelope missing required field(s): host, service, raw_message"),
        (good.replace('"host":"h"', '"host":5').encode(), "host: is not text"),
        (good.replace('"ingested_at":"2026-07-30T10:15:32Z",', "").encode(), "ingested_at: is missing"),
        (good.replace("abcdefgh", "abc").encode(), "event_id: is shorter than 8"),
    ]
    frame = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(payloads)], "i int, value binary")
    rows = pipeline.process(pipeline.decode(frame), at(AS_OF), OPTIONS).orderBy("i").collect()
    assert [r["_reason"] for r in rows] == [reason for _, reason in payloads]
    assert [r["_stage"] for r in rows] == [None] + ["decode"] * 6 + ["validate"] * 3
    assert rows[0].event_id == "abcdefgh" and rows[0].geo_country == "JP" and rows[0].path_group == "/a"


def test_dead_letters_keep_the_original(spark):
    rows = [("event-0001", "2026", "h", "s", "nginx_combined", "x" * 20000), ("event-0002", "2026", "h", "s", "odd", "y")]
    dead = pipeline.dead_letters(pipeline.route(pipeline.process(raw(spark, rows), at(AS_OF), OPTIONS))).orderBy("event_id").collect()
    assert [d.error_stage for d in dead] == ["parse", "parse"]
    assert "x" * 20000 in dead[0].original and dead[1].service == "s"
    text = spark.createDataFrame([("z" * 20000,)], "value string")
    (letter,) = pipeline.dead_letters(pipeline.route(pipeline.process(pipeline.decode(text), at(AS_OF), OPTIONS))).collect()
    assert letter.original == "z" * 20000 and letter.event_id is None and letter.service is None


def test_client_can_be_dropped(spark):
    rows = [("event-0001", "2026-07-30T10:15:32Z", "h", "s", "nginx_combined", LINE)]
    out = pipeline.process(raw(spark, rows), at(AS_OF), pipeline.Options(salt="pinch", keep_client=False)).first()
    assert out.client_ip is None and out.client_ip_hash and out.geo_country == "JP" and out["_stage"] is None


def test_nothing_is_lost_and_reruns_change_nothing(spark):
    rng = random.Random(11)
    lines = [LINE, LINE.replace("200", "503"), LINE.replace("200", "700"), "junk", '{"time":1}', ""]
    rows = [(f"event-{i:05d}", "2026-07-30T10:15:32Z", "h", f"s{i % 3}", rng.choice(["nginx_combined", "json_app", "odd"]),
             rng.choice(lines)) for i in range(400)]
    frame = raw(spark, rows).withColumn("id", F.col("event_id"))
    once = pipeline.route(pipeline.process(frame, at(AS_OF), OPTIONS))
    balance = recon.conservation(frame, once).first()
    assert balance.balanced and balance.consumed == 400
    parsed = pipeline.parsed_rows(once)
    again = pipeline.parsed_rows(pipeline.route(pipeline.process(frame, at("2026-08-02"), OPTIONS)))
    final = dedupe.latest_copy(parsed.unionByName(again))
    assert final.count() == parsed.count()
    assert {str(r.processed_at) for r in final.select("processed_at").distinct().collect()} == {"2026-08-02 00:00:00"}


def test_later_filters_do_not_repeat_the_parser(spark):
    frame = raw(spark, [("event-0001", "2026", "h", "s", "nginx_combined", LINE)])
    plan = pipeline.parsed_rows(pipeline.route(pipeline.process(frame, at(AS_OF), OPTIONS))).filter("timestamp > '2026-01-01'")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in text.splitlines() if line.strip(" +-:").startswith("Filter")]
    assert filters and not any("regexp_replace" in line for line in filters)
