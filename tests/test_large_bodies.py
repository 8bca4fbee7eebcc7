"""Bodies read from many splits against whole-text readers, strict messages, and counters of running jobs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sparklogs.operators import intake
from sparklogs.sources import files, kafka, store
from sparklogs.streaming import jobs


@pytest.fixture(params=["7", "64", "100000"])
def split(spark, request):
    """Splits of a few bytes, so that lines, texts and elements lie across them."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def value_of(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return "".join(rng.choice('a,"[]{}\\\n é漢') for _ in range(rng.randrange(9)))
    if kind < 4:
        return [None, True, rng.randrange(10 ** 6), 1.5][kind]
    if kind == 4:
        return [value_of(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i},": value_of(rng, depth + 1) for i in range(rng.randrange(4))}


def test_arrays_of_any_layout(spark, tmp_path, split):
    rng = random.Random(6)
    for i, count in enumerate((0, 1, 2, 40)):
        items = [value_of(rng) for _ in range(count)]
        text = json.dumps(items, indent=rng.choice([None, 2]), ensure_ascii=False)
        (tmp_path / f"{i}.json").write_text(rng.choice(["", "﻿", " \n"]) + text + rng.choice(["", "\n", " "]))
    want = {(r.body, r.line): json.loads(r.value) for r in files.read_json_array(spark, str(tmp_path)).collect()}
    rows = files.read_large_arrays(spark, str(tmp_path)).collect()
    assert not any(r.broken for r in rows)
    assert {(r.body, r.line): json.loads(r.value) for r in rows} == want


@pytest.mark.parametrize("text", ['[1, 2', '[1, "a]', '[1] 2', '[1]]', '[{"a": [1]}', '[1],[2]'])
def test_broken_arrays(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    rows = files.read_large_arrays(spark, str(tmp_path)).collect()
    assert rows and all(r.broken or not json_like(r.value) for r in rows)


def json_like(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def test_lines_of_any_length(spark, tmp_path, split):
    rng = random.Random(7)
    for i in range(4):
        lines = ["".join(rng.choice("ab {}é") for _ in range(rng.randrange(30))) + rng.choice(["", "\x0b", " x", "\x85"]) for _ in range(rng.randrange(40))]
        (tmp_path / f"{i}.txt").write_bytes(("﻿" * (i % 2) + rng.choice(["\n", "\r\n"]).join(["start", *lines])).encode())
    (tmp_path / "array.txt").write_text(" [1,\n2]")
    want = {(r.body, r.line): r.value for r in files.read_bodies(spark, str(tmp_path)).collect()}
    got = {(r.body, r.line): r.value for r in files.read_large_bodies(spark, str(tmp_path)).collect()}
    assert got == want and len(want) > 20


def test_bodies_refused_whole(spark, tmp_path):
    (tmp_path / "empty").write_text("")
    (tmp_path / "big").write_text('{"a": 1}\n' * 100)
    (tmp_path / "good").write_text('{"timestamp": 1}\n[1]\n{"x"')
    refused = files.rejected_bodies(spark, str(tmp_path), 500)
    judged = intake.judge_json(files.read_large_bodies(spark, str(tmp_path), 500), as_of=F.lit("2026-01-01").cast("timestamp"))
    assert {r.reason: r.lines for r in intake.rejects_by_reason(judged, refused).collect()} == {
        "empty_body": 1, "too_large": 1, "not_an_object": 1, "invalid_json": 1}


GOOD = {"event_id": "event-00001", "timestamp": "2026-01-01T00:00:00Z", "service": "s", "status_code": 200, "is_error": False}
BROKEN = ['{"event_id": "a", "status_code": "abc"}', json.dumps(GOOD) + " trailing", json.dumps(GOOD) + json.dumps(GOOD), "[" + json.dumps(GOOD) + "]",
          json.dumps({**GOOD, "status_code": 1.5}), json.dumps({**GOOD, "status_code": 10 ** 12}), json.dumps({**GOOD, "is_error": "yes"}), "{", "", "null", "7", None,
          json.dumps({**GOOD, "event_id": None})]


def test_strict_messages(spark):
    texts = [json.dumps(GOOD), json.dumps({**GOOD, "color": 1, "size": 2}), " " + json.dumps(GOOD) + "\n", *BROKEN]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    assert sorted(r.n for r in kafka.parse_rows(frame, extra=("n",)).collect()) == [0, 1, 2]
    rows = {r.n: r for r in kafka.parse_rows(frame, extra=("n",), skipped=True).collect()}
    assert [rows[i]._unknown for i in range(3)] == [0, 2, 0] and not any(rows[i]._broken for i in range(3))
    for i in range(3, len(texts)):
        assert rows[i]._broken and rows[i].status_code is None and rows[i]._rescued == texts[i]


def test_the_hot_stream_counts_what_it_leaves(spark, tmp_path):
    texts = [json.dumps(GOOD), json.dumps({**GOOD, "event_id": "event-00002", "color": 1}), *[t for t in BROKEN if t is not None]]
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.parquet(f"{tmp_path}/in")
    told = []
    stream = files.read_stream_files(spark, f"{tmp_path}/in", "value string")
    for checkpoint in ("a", "b"):  # a lost checkpoint makes the batch come again
        jobs.run_hot_store(stream, f"{tmp_path}/store", f"{tmp_path}/{checkpoint}", trigger=None,
                           watch=lambda n, counts: told.append((n, dict(counts)))).awaitTermination()
    assert sorted(r.event_id for r in store.read_store(spark, f"{tmp_path}/store").collect()) == ["event-00001", "event-00002"]
    assert told == [(0, {"messages": len(texts), "broken": len(BROKEN) - 1, "unknown": 1})] * 2
