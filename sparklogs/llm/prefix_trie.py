"""The trie of conversation prefixes, with subtree totals by parallel tree contraction.

Turns are reduced to a digest and a length in one pass over the texts. A node is a distinct sequence of first turns; its
key is the exclusive-or of 128-bit hashes of (place, digest), which grows from turn to turn without a look at the
others, so a conversation of any length is scanned in slices: rows are range-partitioned by (conversation, place), each
slice is scanned by itself, and what lies before a slice is carried over for the conversations that cross a
border, at most one a border.

Totals over subtrees come from contraction. In each round all leaves are raked: their totals are known and go into their
parents, summed in tasks before the shuffle. Then unary chains are compressed: of neighbours with one child each the one with
the larger hash is taken out; its child gets its parent, and what the node would have added goes along the edge. A
round takes all leaves and, expected, a third of each chain, so the number of rounds is logarithmic in the number of nodes,
however deep the trie is. At last the compressed nodes are put back in reverse order: a node's total is its child's
plus what was noted when it was taken out. All joins of the contraction are one to one.

Nulls and odd rows: a null role or text is empty; a null turn comes first; turns of one number are ordered by their digests;
repeated rows are turns of their own. Rows without a conversation id belong to none and are left out. Very long texts
are only hashed and measured. Further columns are ignored. An empty table gives an empty result (not even a root).
"""

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bounded, stored

KEY = ["x", "y"]


def digested(turns: DataFrame) -> DataFrame:
    """conv_id, turn, a, b (halves of a digest of role and text), length in code points, of each turn with an id."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.filter("conv_id is not null").select("conv_id", "turn", whole.alias("md5"), F.length(text).cast("bigint").alias("length"))
    halves = [F.xxhash64(F.lit(name), F.substr("md5", F.lit(start), F.lit(16))).alias(name) for name, start in (("a", 1), ("b", 17))]
    return rows.select("conv_id", "turn", *halves, "length")


def _ranged(frame: DataFrame, order: list[Column]) -> DataFrame:
    """Rows in order over the tasks, with their task as `part`; equal rows may be dealt to several."""
    parts = frame.repartitionByRange(F.col("conv_id"), *order, F.rand(7))
    return stored(parts.select("*", F.spark_partition_id().alias("part")), "trie-ranged")


def _carried(slices: DataFrame, value: Callable[[Column], Column], column: str) -> DataFrame:
    """What the slices before a slice of the same conversation come to; only for slices that have any, one a border at most."""
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("conv_id", "part", value(F.col(column)).over(before).alias("carried"))
    return F.broadcast(stored(carried.filter("carried is not null"), "trie-carried"))


def placed(turns: DataFrame) -> DataFrame:
    """The digested turns with their place in the conversation, from 1."""
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    rows = _ranged(turns, order)
    carried = _carried(rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")), F.sum, "n")
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    rows = rows.withColumn("inside", inside).join(carried, ["conv_id", "part"], "left")
    return rows.select("conv_id", (F.col("inside") + F.coalesce("carried", F.lit(0))).cast("bigint").alias("place"), "a", "b", "length")


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, place, length, key (x, y) of the prefix that ends here and (above_x, above_y) of the one before."""
    own = [F.xxhash64(F.lit(name), "place", "a", "b").alias(f"own_{name}") for name in KEY]
    rows = _ranged(turns.select("conv_id", "place", "length", *own), [F.col("place")])
    within = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = rows.groupBy("conv_id", "part").agg(*[F.bit_xor(f"own_{n}").alias(n) for n in KEY])
    for name in KEY:
        carried = _carried(slices, F.bit_xor, name).withColumnRenamed("carried", "before")
        running = F.bit_xor(f"own_{name}").over(within).alias(name)
        rows = rows.select("*", running).join(carried, ["conv_id", "part"], "left")
        rows = rows.withColumn(name, F.col(name).bitwiseXOR(F.coalesce("before", F.lit(0)))).drop("before")
    above = [F.col(n).bitwiseXOR(F.col(f"own_{n}")).alias(f"above_{n}") for n in KEY]
    return rows.select("conv_id", "place", "length", *KEY, *above)


def _joined_ids(ends: DataFrame) -> DataFrame:
    """Per node key the SHA-256 of its decimal ids in numerical order, comma-joined.

    The ids of a node are sorted and joined in as many tasks as they need; the digest of one node is one stream of bytes
    by definition, so one task reads the joined pieces, and keeps none of them.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, batch in enumerate(batches):
            rows = zip(*(batch.column(c).to_pylist() for c in ("x", "y", "place", "part", "conv_id")))
            out, last = [], None
            for x, y, place, part, conv in rows:
                if (x, y, place) != last:
                    last = (x, y, place)
                    out.append([x, y, place, part, i, []])
                out[-1][5].append(str(conv))
            columns = list(zip(*[(*r[:5], ",".join(r[5])) for r in out])) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.string()])],
                                             ["x", "y", "place", "part", "seq", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def row(keys: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*keys)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])],
                                              ["x", "y", "place", "ends_sha256"])

        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "place", "ids"))):
                if key != last:
                    if last:
                        out.append((*last, state.hexdigest()))
                    last, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield row(out)
        if last:
            yield row([(*last, state.hexdigest())])

    order = ["x", "y", "place"]
    rows = ends.select(*order, F.col("conv_id").cast("bigint").alias("conv_id"))
    ranged = rows.repartitionByRange(*order, "conv_id").sortWithinPartitions(*order, "conv_id").withColumn(
        "part", F.spark_partition_id().cast("bigint"))
    joined = ranged.mapInArrow(pieces, "x bigint, y bigint, place bigint, part bigint, seq bigint, ids string")
    dealt = joined.repartition(*order).sortWithinPartitions(*order, "part", "seq")
    return dealt.mapInArrow(digest, "x bigint, y bigint, place bigint, ends_sha256 string")


def nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes, written: id, parent (null: root), conv_id, parent_conv_id, depth, n_convs, length, ends_sha256.

    `convs` has the conv_id of every conversation, with or without turns; `turns` conv_id, place, a, b, length.
    """
    rows = stored(paths(turns), "trie-paths")
    inner = rows.groupBy(*KEY, F.col("place").alias("depth")).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("length").alias("length"),
        *[F.first(f"above_{n}").alias(f"above_{n}") for n in KEY])
    zero = F.lit(0).cast("bigint")
    everyone = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = everyone.select(*[zero.alias(n) for n in KEY], zero.alias("depth"), "conv_id", "n_convs", zero.alias("length"),
                           *[F.lit(None).cast("bigint").alias(f"above_{n}") for n in KEY])
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct(*KEY, "place"), "place").alias("end"))
    ends = convs.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col("end")[n], zero).alias(n) for n in (*KEY, "place")])
    digests = _joined_ids(ends).withColumnRenamed("place", "depth")
    every = inner.unionByName(root).join(digests, [*KEY, "depth"], "left")
    every = every.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    numbered = stored(every.withColumn("id", F.monotonically_increasing_id()), "trie-numbered")
    # A node with very many children is a skewed key here, which Spark splits.
    above = numbered.select(*[F.col(n).alias(f"above_{n}") for n in KEY], (F.col("depth") + 1).alias("depth"),
                            F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return stored(numbered.join(above, [*[f"above_{n}" for n in KEY], "depth"], "left").select(
        "id", "parent", "conv_id", "parent_conv_id", "depth", "n_convs", "length", "ends_sha256"), "trie-nodes")


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """id and, under the same names, the sums of the values over each node's subtree.

    `tree` has id, parent (null for roots) and the values (bigint, not null).
    """
    edges = [f"edge_{v}" for v in values]
    active = stored(tree.select("id", "parent", *values, *[F.lit(0).cast("bigint").alias(e) for e in edges]), "trie-active")
    raked, compressed = [], []  # per round: (id, totals) and (id, child, what to add to the child's totals)
    while not active.isEmpty():
        inner = active.filter("parent is not null").select(F.col("parent").alias("id")).distinct()
        leaves = stored(active.join(inner, "id", "left_anti"), "trie-leaves")
        raked.append(leaves.select("id", *values))
        gained = leaves.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(
            *[F.sum(F.col(v) + F.col(e)).alias(f"gained_{v}") for v, e in zip(values, edges)])
        rest = active.join(inner, "id", "left_semi").join(gained, "id", "left")
        rest = stored(rest.select("id", "parent", *[(F.col(v) + F.coalesce(f"gained_{v}", F.lit(0))).alias(v) for v in values], *edges), "trie-rest")

        only = rest.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(
            F.count("*").alias("n"), F.min("id").alias("child"), *[F.min(e).alias(f"child_{e}") for e in edges]).filter("n = 1")
        unary = stored(rest.filter("parent is not null").join(only.drop("n"), "id"), "trie-unary")
        # Of two neighbours in a chain the one with the smaller hash stays for now.
        lower = unary.select(F.col("id").alias("child"), F.xxhash64("id").alias("low"))
        pairs = unary.select("id", "child", F.xxhash64("id").alias("high")).join(lower, "child")
        stays = pairs.select(F.when(F.col("high") < F.col("low"), F.col("id")).otherwise(F.col("child")).alias("id")).distinct()
        out = unary.join(stays, "id", "left_anti").select(
            "id", "parent", "child", *[(F.col(v) + F.col(f"child_{e}")).alias(v) for v, e in zip(values, edges)],
            *[(F.col(v) + F.col(f"child_{e}") + F.col(e)).alias(e) for v, e in zip(values, edges)])
        out = stored(out, "trie-compressed")
        compressed.append(out.select("id", "child", *values))
        moved = out.select(F.col("child").alias("id"), F.col("parent").alias("up"), *[F.col(e).alias(f"new_{e}") for e in edges])
        active = rest.join(out.select("id"), "id", "left_anti").join(moved, "id", "left")
        active = stored(active.select("id", F.coalesce("up", "parent").alias("parent"), *values,
                                      *[F.coalesce(f"new_{e}", e).alias(e) for e in edges]), "trie-active")
    totals = None
    for leaves, out in zip(reversed(raked), reversed(compressed)):
        if totals is not None:
            below = totals.select(F.col("id").alias("child"), *[F.col(v).alias(f"below_{v}") for v in values])
            back = out.join(below, "child").select("id", *[(F.col(v) + F.col(f"below_{v}")).alias(v) for v in values])
            leaves = leaves.unionByName(totals).unionByName(back)
        totals = stored(leaves, "trie-totals")
    return totals if totals is not None else tree.select("id", *values)


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `convs` names the conversations; `turns` has conv_id, place (from 1, without gaps), a, b and length, as `placed` gives
    them. saved_tokens sums over the subtree what sharing a prefix saves: (n_convs - 1) times the length of the last turn.
    """
    tree = nodes(convs, turns)
    children = tree.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    tree = stored(tree.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-counted")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves")
    saved = ((F.col("n_convs") - 1) * F.col("length")).cast("bigint").alias("saved_tokens")
    totals = subtree_totals(tree.select("id", "parent", leaf, saved), ["n_leaves", "saved_tokens"])
    return tree.join(totals, "id").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(turns: DataFrame, group: int = 100, longest: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that start like the first of their group: (conv_id of all, turns with place, a, b, length).

    Conversation c takes the first h turns of conversation c - c % group (all if it has fewer) and then its own after
    its first h, with h = crc32(c in decimal) % longest. At most `longest` rows of a conversation are lent, each to at most
    `group` others.
    """
    rows = stored(placed(digested(turns)), "trie-placed")
    convs = stored(rows.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).alias("h")), "trie-convs")
    heads = rows.filter(F.col("place") < longest).select(F.col("conv_id").alias("base"), "place", "a", "b", "length")
    heads = heads.join(convs.select("base").distinct(), "base", "left_semi")
    lent = stored(convs.join(heads, "base").filter("place <= h").select("conv_id", "place", "a", "b", "length"), "trie-lent")
    counts = lent.groupBy("conv_id").agg(F.count("*").alias("k"))
    shifts = convs.join(counts, "conv_id", "left").select("conv_id", "h", F.coalesce("k", F.lit(0)).alias("k"))
    own = rows.join(bounded(stored(shifts, "trie-shifts")), "conv_id").filter("place > h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("k")).alias("place"), "a", "b", "length")
    return convs.select("conv_id"), lent.unionByName(own)
