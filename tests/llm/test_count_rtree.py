"""The Jaccard join against all pairs: searches of the tree, and the components of hand-made and random texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from sparklogs.llm import count_rtree


def brute(docs: list) -> dict:
    sets = []
    for _, text in docs:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    label = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and label[i] != label[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for (doc_id, _), x in zip(docs, label):
        if doc_id is not None:
            least[x] = min(least.get(x, doc_id), doc_id)
    return sorted(((d[0], len(s), least.get(x)) for d, s, x in zip(docs, sets, label)), key=str)


def texts(rng: random.Random) -> list[str]:
    """Near copies by scattered words, by blocks at either end, chains, and unlike texts that share a passage."""
    def fresh(n):
        return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]

    out, passage = [], fresh(70)
    for _ in range(6):
        base = fresh(rng.choice([6, 30, 200]))
        out.append(base)
        for _ in range(8):
            copy = base[:]
            for _ in range(rng.randrange(1 + len(base) // 40)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(999))
            out.append(copy)
        for share in (0.05, 0.1, 0.11, 0.2):
            out += [base + fresh(int(share * len(base))), fresh(int(share * len(base))) + base]
    out += [fresh(40)[:rng.randrange(40)] + passage + fresh(rng.randrange(30)) for _ in range(40)]
    chain = fresh(300)
    out += [chain[i * 20:i * 20 + 150] for i in range(8)] + [chain[i * 8:i * 8 + 150] for i in range(10)]
    return [" ".join(t) for t in out]


@pytest.mark.parametrize("block, points", [(2_000_000, 4096), (700, 7)])
def test_components(spark, monkeypatch, block, points):
    """Also with trees so small that groups are dealt into blocks and settled key by key."""
    monkeypatch.setattr(count_rtree, "BLOCK", block)
    monkeypatch.setattr(count_rtree, "POINTS", points)
    rng = random.Random(11)
    rows = [None, "", " \n", "a b", "A b", "a  b\n", "a b c d e", "b a", "x " * 50, "x " * 60, "É é", *texts(rng)]
    docs = list(enumerate(rows)) + [(3, "a b"), (None, rows[-1]), (None, "alone without id"), (2000, rows[20].upper())]
    rng.shuffle(docs)
    frame = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id bigint, text string, digest string, row int, n int")
    got = sorted((tuple(r) for r in count_rtree.jaccard_components(frame).collect()), key=str)
    assert got == brute(docs)


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert count_rtree.jaccard_components(frame).collect() == []


def test_long_text(spark):
    long = " ".join(f"v{i}" for i in range(200_000))
    docs = [(1, long), (2, long + " and more"), (3, "other " * 10)]
    got = {tuple(r) for r in count_rtree.jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == {(1, 199_996, 1), (2, 199_998, 1), (3, 1, 3)}


def test_tree_finds_all():
    """A search returns every point that its bound allows, and so every linked set."""
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 62, 3000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool[:rng.integers(40, 400)], rng.integers(5, 200))) for _ in range(300)]
    at, sizes = count_rtree.points(sets), np.array([len(s) for s in sets])
    tree = count_rtree.RTree(at, sizes)
    for x in range(0, 300, 7):
        bound = np.minimum(at, at[x]).sum(axis=1)
        fit = count_rtree.linked(bound, sizes, sizes[x]) & (100 * sizes >= 80 * sizes[x]) & (80 * sizes <= 100 * sizes[x])
        found = tree.search(at[x], int(sizes[x]))
        assert set(found.tolist()) == set(np.flatnonzero(fit).tolist())
        assert {y for y in range(300) if count_rtree.linked(count_rtree.overlap(sets[x], sets[y]), sizes[x], sizes[y])} <= set(found.tolist())


@pytest.mark.parametrize("block, points", [(2_000_000, 4096), (700, 7)])
def test_dealt_keys(spark, monkeypatch, block, points):
    """Keys above MOST rows are dealt to parts, whose nodes meet again; sizes lie at the edges of bands and of what links."""
    monkeypatch.setattr(count_rtree, "MOST", 2)
    monkeypatch.setattr(count_rtree, "BLOCK", block)
    monkeypatch.setattr(count_rtree, "POINTS", points)
    rng = random.Random(12)
    words = [f"w{i}" for i in range(500)]
    rows = [" ".join(words[:n]) for n in (84, 104, 105, 129, 130, 131, 204, 254, 255, 318, 319, 397, 398, 399, 499)]
    rows += [" ".join([*words[:100], *(f"own{i}-{j}" for j in range(i))]) for i in range(40)] + texts(rng) + rows[:3]
    docs = list(enumerate(rows))
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = sorted((tuple(r) for r in count_rtree.jaccard_components(frame).collect()), key=str)
    assert got == brute(docs)


def test_keys_of_one_node_are_not_stored(spark, monkeypatch):
    """Nearly all keys are of one text only; they go in the one exchange and are in no table."""
    tables, stored = {}, count_rtree.stored

    def counted(frame, name):
        out = stored(frame, name)
        tables[name] = out
        return out

    monkeypatch.setattr(count_rtree, "stored", counted)
    docs = [(i, " ".join(f"t{i}w{j}" for j in range(500 + i))) for i in range(40)] + [(99, "a b c d e"), (100, "A b c d e")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(2)
    assert {tuple(r) for r in count_rtree.jaccard_components(frame).collect()} == {(i, 496 + i, i) for i in range(40)} | {(99, 1, 99), (100, 1, 99)}
    named = tables.pop("rtree-rows")
    assert all(t.count() <= len(docs) for t in tables.values())
    # Counters of a task: a byte and a half per hit at most, where places and counts took six.
    sent = named.filter("slice is not null").agg({"slice": "count"}).first()[0], sum(len(r[0]) for r in named.filter("slice is not null").select("counts").collect())
    assert 256 <= sent[0] <= 512 and sent[1] < 512 * 400


def test_counters_return():
    rng = np.random.default_rng(6)
    own = rng.poisson(0.2, 1 << count_rtree.SLICE_BITS).astype(np.uint32)
    own[[3, 77, 65535]] = 255, 256, 4_000_000_000
    packed = count_rtree._packed(own)
    assert len(packed) < 1.5 * np.count_nonzero(own)
    assert (count_rtree._unpacked(pa.py_buffer(packed)) == own).all()


def test_sets_are_sent_short():
    """As packed texts, or as sets where a text is long and has few shingles."""
    powers, rng = count_rtree.Powers(), random.Random(7)
    prose = " ".join(rng.choice(["the", "River", "house", "Ünder", "walked", "old", "and", "stone"]) for _ in range(3000))
    for text in ("a", "a b c d e f", "x " * 100_000, " ".join(f"{rng.getrandbits(4000):x}" for _ in range(20)), prose):
        own = count_rtree.shingles(text, powers)
        sent = count_rtree.sent(text, len(own), powers)
        assert (count_rtree.received(pa.py_buffer(sent), powers) == own).all()
        assert len(sent) <= 8 + 8 * len(own)
    assert len(sent) < 3 * len(own)
