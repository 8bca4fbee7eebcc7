"""The prefix trie against a dictionary of prefixes, and tree contraction against recursion."""

import hashlib
import random
import zlib

from sparklogs.llm import prefix_trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute(rows: list) -> list:
    """The trie of rebuilt conversations; ties of a turn must be equal rows."""
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    members, ends = {}, {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        path = own.get(conv - conv % 100, [])[:h] + turns[h:]
        ends.setdefault(tuple(path), []).append(conv)
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out, sums = [], {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[c] for c in children.get(node, [])]
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        sums[node] = (max(1, sum(b[0] for b in below)), saved + sum(b[1] for b in below))
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                    len(children.get(node, [])), *sums[node], digest))
    return sorted(out, key=str)


def test_trie(spark):
    rng = random.Random(2)
    rows = []
    for conv in [*range(130), 205, 399, 1000, 1001]:
        for turn in range(rng.randrange(9)):
            rows.append((conv, turn or None, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "é漢", "x" * 50])))
    rows += [(7, 20, "user", "tie")] * 3 + [(None, 0, "user", "nobody")] * 3
    rows += [(500, t, "user", f"t{t % 7}") for t in range(400)] + [(501, t, "user", f"t{t % 7}") for t in range(300)] + [(502, 0, "user", "y" * 300_000)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], TURNS + ", depth int, length string")
    got = prefix_trie.trie(*prefix_trie.rebuilt(frame))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_contraction(spark):
    """Long chains, a star, and a forest."""
    rng = random.Random(9)
    parent = {0: None, 1: None, 2: 0}
    parent.update({i: i - 1 for i in range(3, 120)})
    parent.update({i: 60 for i in range(120, 200)})
    parent.update({i: rng.randrange(i) for i in range(200, 400)})
    value = {i: rng.randrange(-5, 9) for i in parent}
    total = dict(value)
    for i in sorted(parent, reverse=True):
        if parent[i] is not None:
            total[parent[i]] += total[i]
    tree = spark.createDataFrame([(i, p, value[i], 1) for i, p in parent.items()], "id bigint, parent bigint, v bigint, w bigint")
    got = {r.id: (r.v, r.w) for r in prefix_trie.subtree_totals(tree, ["v", "w"]).collect()}
    size = {i: 1 for i in parent}
    for i in sorted(parent, reverse=True):
        if parent[i] is not None:
            size[parent[i]] += size[i]
    assert got == {i: (total[i], size[i]) for i in parent}


def test_empty(spark):
    assert prefix_trie.trie(*prefix_trie.rebuilt(spark.createDataFrame([], TURNS))).collect() == []
    only_null = spark.createDataFrame([(None, 0, "user", "x")], TURNS)
    assert prefix_trie.trie(*prefix_trie.rebuilt(only_null)).collect() == []
