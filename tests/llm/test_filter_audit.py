"""The filter audit against a plain count over all orders, and its transducer against regular expressions."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

from sparklogs.llm import filter_audit

LETTERS = " \t\n\x0b\x0c\rABab#$%&*|é漢𝄞\x00\x1c\x85\xa0"


def stats_of(text: str) -> list[int]:
    words = re.findall("[^\x20\x09-\x0D]+", text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall("[#$%&*|]", text))]


@pytest.mark.parametrize("piece", [16, 100, 1 << 20])
def test_transducer(piece, monkeypatch):
    monkeypatch.setattr(filter_audit, "PIECE", piece)
    rng = random.Random(3)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.choice([0, 1, 2, 5, 30, 200, 3000]))) for _ in range(300)]
    texts += ["", "a" * 5000, "ab " * 4000, " ", "Aé"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    assert filter_audit.text_stats(data, offsets, filter_audit.Powers()).T.tolist() == [stats_of(t) for t in texts]


def test_equal_hashes_are_told_apart():
    data = np.frombuffer(b"ab cd ab", np.uint8)
    table = filter_audit.SpanTable(data)
    same = np.full(3, 7, np.uint64)
    new = table.insert(same, np.array([0, 3, 6]), np.array([2, 2, 2]), np.zeros(3, np.int64))
    assert new.sum() == 2 and new[1]
    assert not table.insert(same[:1], np.array([6]), np.array([2]), np.zeros(1, np.int64))[0]
    assert table.insert(same[:1], np.array([6]), np.array([2]), np.ones(1, np.int64))[0]


def brute_audit(docs: list, labels: list) -> dict:
    fails, least = [], {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    for doc_id, text, _ in docs:
        text = text or ""
        n, distinct, capitals, points, symbols = stats_of(text)
        tests = {"A": n < 50, "B": 100 * distinct < 65 * n, "C": 100 * capitals > 5 * points, "D": symbols > 0,
                 "E": doc_id is not None and doc_id > least[text]}
        fails.append({f for f, t in tests.items() if t})
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    out = {}
    for part in {d[2] or "" for d in docs}:
        own = [(d[0], f) for d, f in zip(docs, fails) if (d[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before = set(order[:step - 1])
                here = [i for i, f in own if letter in f and not f & before]
                out[part, order, step] = [
                    sum(not f & (before | {letter}) for _, f in own), len(here), sum(letter in f and bool(f & before) for _, f in own),
                    sum(f == {letter} for _, f in own), sum(i in good for i in here), sum(i in toxic for i in here)]
    shares = {}
    for (part, order, step), row in out.items():
        shares[part, order[step - 1]] = shares.get((part, order[step - 1]), 0) + row[1]
    return {k: (*row, shares[k[0], k[1][k[2] - 1]]) for k, row in out.items()}


def test_audit(spark):
    rng = random.Random(5)
    pool = [None, "", "short", "word " * 60, " ".join(f"w{i}" for i in range(60)), "HELLO " + " ".join(f"W{i}" for i in range(70)),
            "cost $5 " + " ".join(f"v{i}" for i in range(80)), "x" * 200_000, " ".join(f"long{i}" for i in range(30_000))]
    docs = [(rng.choice([None, *range(40)]), rng.choice(pool), rng.choice([None, "", "a", "b"])) for _ in range(120)]
    labels = [(rng.choice([None, *range(50)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, source string, part string, fails int")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = filter_audit.audit(filter_audit.failures(frame), marks).collect()
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in rows} == brute_audit(docs, labels)
    assert len(rows) == 3 * 600


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string, source string")
    marks = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(filter_audit.failures(frame), marks).collect() == []
    one = spark.createDataFrame([(1, "a b", None)], frame.schema)
    assert len(filter_audit.audit(filter_audit.failures(one), marks).collect()) == 600
