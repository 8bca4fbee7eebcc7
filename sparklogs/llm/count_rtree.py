"""Jaccard join of texts on word n-grams with an R-tree over count vectors.

A text is the set of its distinct shingles of five words, as 64-bit numbers; texts with equal sets are one node. Two
nodes link when 100 * intersection >= 80 * union; groups are connected components, named by the smallest id. Sets are larger than
texts, so they are made anew from the texts where they are needed, and trees get packed texts where these are shorter.

The tokens (shingles) are hashed into GROUPS groups, and the counts per group are a text's point. For two points the sum of
the coordinate minima bounds the intersection from above, and so it does for a point and the upper corner of a rectangle.
Points are packed into rectangles level by level (an R-tree, bulk-loaded); a search goes down where bound and sizes allow
a link, best bounds first, and what survives is verified on the sets.

One tree over all texts would have to be searched by all texts, and rectangles of unlike texts prune nothing. So texts first
get the trees in which they have partners. All shingles have one order, by how often their counter (one of 2 ** COUNTER_BITS, a
table of fixed size) was hit, then by number: linked sets share one of their first n - ceil(0.8 n) + 1 shingles, so nodes
without a path of such shared keys never link. Sizes of linked sets differ by a quarter at most, so a key counts only within a
run of its nodes by size without a greater step. The components of those paths are the candidates' groups, found
in tables of numbers without any set. Nearly all keys are of one node, so they cross the network once, to a window that drops them.
The rows of a key whose counter passes MOST are dealt to parts, joined again by the first rows of each part's bands of sizes.

1. Each group is a tree; groups above BLOCK shingles are dealt into blocks by hash, twice with different hashes, the
   second time with what is linked so far. Within a tree, nodes already connected are not compared.
2. What is left of dealt groups is settled key by key: for each key with members of several components, the points of the
   heaviest one meet those of the others, and these each other, in blocks of POINTS points, each a tree. Surviving pairs
   are written as ids; their sets are fetched, verified and linked.

So every linked pair is either compared or already connected, no group is collected, and one of W near copies costs about W.

Nulls and odd rows: a null text and one without words have no shingles and link with nothing; fewer than five words are
one shingle, which no longer text has. Rows with equal ids or texts are rows of one component each; a null id is named
by its component's smallest id, or null. Very long texts are one set in one task, 8 bytes a word. Further columns are
ignored. An empty table gives an empty result.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from . import graph
from .common import BLANKS, BROADCAST_ROWS, bounded, stored
from .filter_audit import BLANK, CLASS, Powers, span_hashes

K, PERCENT = 5, 80
GROUPS, FAN = 64, 16
COUNTER_BITS, SLICE_BITS = 24, 16
#: Shingles in one tree, and points in one tree of keys.
BLOCK, POINTS = 2_000_000, 4_096
#: Rows of a key that one task gets, by its counter.
MOST = 20_000
_BAND = 1.26  # above 100 / PERCENT, so linked sizes lie in one band or in two neighbours

_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PIECE = 1 << 20
_NAMED = [T.StructField(n, t) for n, t in (("mark", T.LongType()), ("n", T.IntegerType()), ("id", T.LongType()), ("digest", T.BinaryType()), ("slice", T.IntegerType()),
                                           ("counts", T.BinaryType()))]


def word_numbers(text: str | None, powers: Powers) -> np.ndarray:
    """The lower-cased words of a text as 64-bit numbers, in pieces that end between words."""
    data = np.frombuffer((text or "").encode().translate(_LOWER), np.uint8)
    found, start = [np.zeros(0, np.uint64)], 0
    while start < len(data):
        end = min(len(data), start + _PIECE)
        while end < len(data) and CLASS[data[end]] != BLANK:
            end += 1
        inside = np.concatenate(([False], CLASS[data[start:end]] != BLANK, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        found.append(span_hashes(data[start:end], edges[::2], edges[1::2], powers))
        start = end
    return np.concatenate(found)


def shingles(text: str | None, powers: Powers) -> np.ndarray:
    """The distinct shingles of a text as sorted numbers."""
    own = word_numbers(text, powers)
    if not len(own):
        return own
    size = min(K, len(own))
    n = len(own) - size + 1
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out ^= out >> np.uint64(29)
        out *= _MIX
        out += own[j:n + j]
    out ^= out >> np.uint64(31)
    out *= _MIX2
    out ^= out >> np.uint64(33)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


_NAMES = [f.name for f in _NAMED]


def _packed(counts: np.ndarray) -> bytes:
    """The counters of a slice byte by byte, as most are 0 or 1: the first bytes of all, then the second ones."""
    return pa.compress(counts.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: pa.Buffer) -> np.ndarray:
    data = pa.decompress(packed, 4 << SLICE_BITS, codec="zstd")
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view(np.uint32).reshape(-1)


def _named(seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per text the size of its set, a number that names it, and a digest to tell whether the number is its own.

        At last the counters that this task's shingles hit, in slices, as rows without a name.
        """
        powers, counts, own_type = Powers(), np.zeros(1 << COUNTER_BITS, np.uint32), None
        for batch in batches:
            own_type, rows = batch.schema.field("doc_id").type, []
            for text in batch.column("text"):
                own = shingles(text.as_py(), powers)
                np.add.at(counts, (own >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), 1)
                mers = own.tobytes()
                rows.append((len(own), xxhash.xxh64_intdigest(mers, seed), xxhash.xxh128_digest(mers)))
            sizes, ids, digests = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int32()), pa.array(np.array(ids, np.uint64).view(np.int64)),
                pa.array(digests, pa.binary()), pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())],
                ["doc_id", *_NAMES])
        for i, own in enumerate(counts.reshape(-1, 1 << SLICE_BITS)):
            if own.any():
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(1, own_type), *[pa.nulls(1, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.binary())], pa.array([i], pa.int32()),
                    pa.array([_packed(own)], pa.binary())], ["doc_id", *_NAMES])

    return name


@arrow_udf(T.BinaryType())
def _sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    powers = Powers()
    for texts in batches:
        yield pa.array([shingles(t.as_py(), powers).tobytes() for t in texts], pa.binary())


@arrow_udf(T.BinaryType())
def _sent(texts: pa.Array, sizes: pa.Array) -> pa.Array:
    powers = Powers()
    return pa.array([sent(t.as_py(), n.as_py(), powers) for t, n in zip(texts, sizes)], pa.binary())


def sent(text: str, n: int, powers: Powers) -> bytes:
    """The set of n shingles of a text, or the text packed where that is shorter; before it the bytes of the text, or 0."""
    data = text.encode()
    packed = pa.compress(data, codec="zstd", asbytes=True)
    if len(packed) < 8 * n:
        return len(data).to_bytes(8, "little") + packed
    return bytes(8) + shingles(text, powers).tobytes()


def received(data: pa.Buffer, powers: Powers) -> np.ndarray:
    size, rest = int.from_bytes(data[:8].to_pybytes(), "little"), data[8:]
    return shingles(pa.decompress(rest, size, codec="zstd", asbytes=True).decode(), powers) if size else _of(rest)


def _of(mers: bytes) -> np.ndarray:
    return np.frombuffer(mers, np.uint64)


def prefix_length(n: int) -> int:
    """How many first shingles of a set of n share one with those of any linked set."""
    return n - -(-PERCENT * n // 100) + 1


def linked(overlap, a, b):
    """Whether sets of sizes a and b with this overlap (or a bound of it) link."""
    return 100 * overlap >= PERCENT * (a + b - overlap)


def points(sets: list[np.ndarray]) -> np.ndarray:
    """The count vectors of sets."""
    return np.stack([np.bincount((s % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS) for s in sets])


class RTree:
    """Points in rectangles: `order` deals them to leaves of FAN, FAN nodes to one above, up to one root."""

    def __init__(self, at: np.ndarray, sizes: np.ndarray):
        wide = np.column_stack((at, sizes))
        self.order = np.concatenate(self._packed(wide, np.arange(len(at))))
        # Per level from the points up: upper corners, least and greatest size.
        self.levels = [(at[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > 1:
            upper, least, most = self.levels[-1]
            edges = np.arange(0, len(upper), FAN)
            self.levels.append((np.maximum.reduceat(upper, edges), np.minimum.reduceat(least, edges), np.maximum.reduceat(most, edges)))

    @classmethod
    def _packed(cls, wide: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        """Halves along the widest coordinate, at multiples of leaves."""
        if len(rows) <= FAN:
            return [rows]
        own = wide[rows]
        along = own[:, (own.max(axis=0) - own.min(axis=0)).argmax()]
        leaves = -(-len(rows) // FAN)
        half = leaves // 2 * FAN
        order = np.argpartition(along, half - 1)
        return cls._packed(wide, rows[order[:half]]) + cls._packed(wide, rows[order[half:]])

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the points whose bound and size allow a link, best bounds first."""
        found = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            upper, least, most = (v[found] for v in self.levels[level])
            bound = np.minimum(upper, point).sum(axis=1)
            # Of the sizes in a node the least allows most.
            fit = linked(bound, size, least) & (100 * most >= PERCENT * size) & (PERCENT * least <= 100 * size)
            found, bound = found[fit], bound[fit]
            if level:
                found = (found[:, None] * FAN + np.arange(FAN)).reshape(-1)
                found = found[found < len(self.levels[level - 1][0])]
        return self.order[found[np.argsort(-bound, kind="stable")]]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def links(ids: np.ndarray, roots: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Enough links between the sets that those which link, directly or by others here, are connected."""
    at, sizes = points(sets), np.array([len(s) for s in sets])
    tree, labels, out = RTree(at, sizes), roots.copy(), []
    for x in range(len(sets)):
        found = tree.search(at[x], int(sizes[x]))
        found = found[(found > x) & (labels[found] != labels[x])]
        while len(found):
            y = found[0]
            if linked(overlap(sets[x], sets[y]), sizes[x], sizes[y]):
                out.append((int(ids[x]), int(ids[y])))
                labels[labels == labels[y]] = labels[x]
                found = found[labels[found] != labels[x]]
            else:
                found = found[1:]
    return out


def _edges(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})


def _runs(*keys: np.ndarray) -> Iterator[np.ndarray]:
    """The rows of each distinct key."""
    order = np.lexsort(keys)
    changed = np.zeros(max(len(order) - 1, 0), bool)
    for key in keys:
        changed |= key[order][1:] != key[order][:-1]
    yield from np.split(order, np.flatnonzero(changed) + 1)


def _trees(block: pa.Table) -> pa.Table:
    """The links of the groups in one block, each a tree."""
    group, ids, roots = (block[c].to_numpy() for c in ("group", "id", "root"))
    sets, powers, out = block["sent"], Powers(), []
    for rows in _runs(group):
        if len(rows) > 1:
            out += links(ids[rows], roots[rows], [received(sets[r].as_buffer(), powers) for r in rows.tolist()])
    return _edges(out)


def _survivors(block: pa.Table) -> pa.Table:
    """Pairs of different components within blocks of keys whose bound allows a link."""
    ids, roots, part, sizes = (block[c].to_numpy() for c in ("id", "root", "part", "n"))
    at = np.array([np.frombuffer(p.as_buffer(), np.int32) for p in block["point"]])
    out = set()
    for rows in _runs(*[block[c].to_numpy() for c in ("j", "i", "key")]):
        i, j = block["i"][int(rows[0])].as_py(), block["j"][int(rows[0])].as_py()
        left, right = rows[part[rows] == i], rows[part[rows] == j]
        if len(left) and len(right):
            tree = RTree(at[right], sizes[right])
            for x in left.tolist():
                found = right[tree.search(at[x], int(sizes[x]))]
                found = found[(roots[found] != roots[x]) & ((ids[found] > ids[x]) if i == j else True)]
                out.update((min(int(ids[x]), y), max(int(ids[x]), y)) for y in ids[found].tolist())
    return _edges(sorted(out))


@arrow_udf(T.BooleanType())
def _verified(a: pa.Array, b: pa.Array) -> pa.Array:
    both = ((_of(x.as_buffer()), _of(y.as_buffer())) for x, y in zip(a, b))
    return pa.array([bool(linked(overlap(x, y), len(x), len(y))) for x, y in both], pa.bool_())


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counters of a slice as levels of one byte; tasks' counts are added one by one."""
    total, number = np.zeros(1 << SLICE_BITS, np.int64), None
    for batch in batches:
        for number, counts in zip(batch.column("slice"), batch.column("counts")):
            total += _unpacked(counts.as_buffer())
    if number is not None:
        levels = np.minimum(np.floor(8 * np.log2(total + 1)), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([number.as_py()], pa.int32()), pa.array([levels.tobytes()], pa.binary())], ["slice", "levels"])


def _prefixes(levels, parts: np.ndarray, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first shingles of each set in the common order, rare ones first, and the part of a key that is dealt (else 0)."""
        table, powers = np.frombuffer(levels.value, np.uint8), Powers()
        for batch in batches:
            keys, ids, sizes, dealt = [], [], [], []
            for text in batch.column("text"):
                own = shingles(text.as_py(), powers)
                if not len(own):
                    continue
                level = table[(own >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
                order = np.argsort(level, kind="stable")[:prefix_length(len(own))]
                number, among = xxhash.xxh64_intdigest(own.tobytes(), seed), parts[level[order]]
                keys.append(own[order])
                ids.append(np.full(len(order), number, np.uint64))
                sizes.append(np.full(len(order), len(own), np.int32))
                dealt.append(np.where(among > 1, 1 + np.uint64(number) % among, 0).astype(np.int32))
                if sum(map(len, keys)) > 1 << 18:
                    yield _posted(keys, ids, sizes, dealt)
                    keys, ids, sizes, dealt = [], [], [], []
            yield _posted(keys, ids, sizes, dealt)

    return prefixes


def _posted(keys: list[np.ndarray], ids: list[np.ndarray], sizes: list[np.ndarray], dealt: list[np.ndarray]) -> pa.RecordBatch:
    long = [np.concatenate([np.zeros(0, np.uint64), *v]).view(np.int64) for v in (keys, ids)]
    short = [np.concatenate([np.zeros(0, np.int32), *v]) for v in (sizes, dealt)]
    return pa.RecordBatch.from_arrays([pa.array(v) for v in long + short], ["key", "id", "n", "part"])


def _pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The count vectors of sets."""
    for batch in batches:
        own = [points([_of(m.as_buffer())])[0].astype(np.int32).tobytes() for m in batch.column("mers")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), pa.array(own, pa.binary())], ["id", "n", "point"])


class Nodes:
    """The distinct sets of a table of texts: `rows` (doc_id, mark, n, id) and the texts behind them."""

    def __init__(self, docs: DataFrame):
        # A text is found again by its id and mark; rows that agree in both are copies.
        self.docs = docs.filter("text is not null").select("doc_id", F.xxhash64("text").alias("mark"), "text")
        self.seed, clash = -1, True
        while clash:
            self.seed += 1
            named = stored(self.docs.mapInArrow(_named(self.seed), T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *_NAMED])), "rtree-rows")
            rows = named.filter("n > 0")
            first = F.min_by(F.struct("doc_id", "mark"), F.struct(F.col("doc_id").isNull(), "doc_id", "mark"))
            nodes = stored(rows.groupBy("id").agg(first.alias("first"), F.first("n").alias("n"), F.min("doc_id").alias("least"),
                                                  (F.min("digest") != F.max("digest")).alias("clash")), "rtree-nodes")
            clash = not nodes.filter("clash").isEmpty()  # two sets of one name: all names are made again
        self.rows = rows.select("doc_id", "mark", "n", "id")
        self.counts = named.filter("slice is not null").select("slice", "counts")
        self.nodes = nodes.select("id", "first.doc_id", "first.mark", "n", "least")

    def _picked(self, names: DataFrame, how: str) -> DataFrame:
        same = [self.docs["doc_id"].eqNullSafe(names["doc_id"]), self.docs["mark"] == names["mark"]]
        return self.docs.join(names, same, how)

    def texts(self) -> DataFrame:
        """`text` of every node; copies go if a table of them can be broadcast, and otherwise only repeat what is done."""
        own = self.nodes.select(F.col("id").alias("own"), F.col("doc_id").alias("own_id"), F.col("mark").alias("own_mark"))
        copies = self.rows.join(bounded(own), F.col("id") == F.col("own")).filter(
            ~(F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark"))))
        copies = stored(copies.select("doc_id", "mark").distinct(), "rtree-copies")
        return (self._picked(F.broadcast(copies), "left_anti") if copies.count() <= BROADCAST_ROWS else self.docs).select("text")

    def _found(self, wanted: DataFrame, *made: Column) -> DataFrame:
        names = stored(wanted.join(bounded(self.nodes.select("id", "doc_id", "mark", "n")), "id"), "rtree-wanted")
        found = self._picked(bounded(names), "inner")
        return found.select(*[names[c] for c in wanted.columns], names["n"], *made)

    def sets(self, wanted: DataFrame) -> DataFrame:
        """The wanted nodes (id, further columns) with n and their sets."""
        return self._found(wanted, _sets("text").alias("mers"))

    def packed(self, wanted: DataFrame) -> DataFrame:
        """The same with what `received` makes their sets from."""
        return self._found(wanted, _sent("text", "n").alias("sent"))


def _band(size: str) -> Column:
    return F.floor(F.log(F.col(size).cast("double")) / F.log(F.lit(_BAND))).cast("int")


def _postings(nodes: Nodes) -> DataFrame:
    """key and id of the keys that several nodes share; written.

    `head` is the first node of the run of sizes in which the node stands, `band` is told by the first row of each band of
    sizes in a key's part. The keys of parts may be of one node only.
    """
    texts = nodes.texts()
    spark = texts.sparkSession
    slices = nodes.counts.groupBy("slice").applyInArrow(_summed, "slice int, levels binary").collect()  # 2 ** COUNTER_BITS bytes at most
    levels = np.zeros((1 << COUNTER_BITS - SLICE_BITS, 1 << SLICE_BITS), np.uint8)
    for row in slices:
        levels[row["slice"]] = np.frombuffer(row["levels"], np.uint8)
    hits = np.exp2(np.arange(256) / 8) - 1
    # Where counters are full of unlike shingles, only what stands out is dealt.
    most = max(MOST, 4 * np.average(hits, weights=np.bincount(levels.reshape(-1), minlength=256)))
    parts = np.maximum(np.ceil(hits / most), 1).astype(np.uint64)
    prefixes = _prefixes(spark.sparkContext.broadcast(levels.tobytes()), parts, nodes.seed)
    posted = texts.mapInArrow(prefixes, "key bigint, id bigint, n int, part int")
    by = Window.partitionBy("key", "part").orderBy("n", "id")
    every = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = posted.select("key", "id", "n", "part", F.lag("id").over(by).alias("last"), F.lag("n").over(by).alias("last_n"),
                         F.first("id").over(every).alias("least"), F.last("id").over(every).alias("greatest"))
    seen = seen.filter("(least <> greatest or part > 0) and (last is null or last <> id)")
    new_band = F.col("last").isNull() | (_band("last_n") < _band("n"))
    new_run = F.col("last").isNull() | (new_band & (100 * F.col("last_n").cast("bigint") < PERCENT * F.col("n").cast("bigint")))
    seen = seen.withColumns({"starts": F.when(new_run, F.col("id")), "band": F.when((F.col("part") > 0) & new_band, _band("n"))})
    head = F.last("starts", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return stored(seen.select("key", "id", head.alias("head"), "band"), "rtree-postings")


def _paths(postings: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the nodes which share a key within a run of sizes; written."""
    by = Window.partitionBy("key").orderBy("band", "id")
    gates = postings.filter("band is not null").select(
        F.lag("id").over(by).alias("a"), F.col("id").alias("b"), (F.col("band") - F.lag("band").over(by)).alias("step"))
    edges = postings.select(F.col("head").alias("a"), F.col("id").alias("b")).unionByName(gates.filter("step <= 1").select("a", "b"))
    return stored(edges.filter("a <> b").distinct(), "rtree-edges")


def _rest(postings: DataFrame, nodes: Nodes, roots: DataFrame, dealt: DataFrame) -> DataFrame:
    """Links between the components of dealt groups that share a key, every pair of them being compared."""
    live = postings.select("key", "id").join(bounded(stored(dealt.select("id"), "rtree-dealt")), "id")
    live = stored(graph.rooted(live.withColumn("root", F.col("id")), "root", roots), "rtree-live")
    each = live.groupBy("key", "root").agg(F.count("*").alias("n"))
    mixed = each.groupBy("key").agg(F.count("*").alias("roots"), F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("top")).filter("roots > 1")
    mixed = mixed.select("key", F.col("top.root").alias("top"), F.ceil((F.col("all") - F.col("top.n")) / POINTS).alias("others"),
                         F.ceil(F.col("top.n") / POINTS).alias("tops"), "all")
    live = stored(live.join(bounded(stored(mixed, "rtree-mixed")), "key"), "rtree-mixed-live")
    pointed = stored(nodes.sets(live.select("id").distinct()).mapInArrow(_pointed, "id bigint, n int, point binary"), "rtree-points")
    # A member meets every block of the others; a member of the heaviest component only those.
    is_other, place = F.col("root") != F.col("top"), F.xxhash64("id")
    part = F.when(is_other, F.pmod(place, "others")).otherwise(F.col("others") + F.pmod(place, "tops"))
    meets = F.sequence(F.lit(0).cast("bigint"), F.when(is_other, F.col("others") + F.col("tops")).otherwise(F.col("others")) - 1)
    placed = live.select("key", "id", "root", "all", part.alias("part"), F.explode(meets).alias("met"))
    placed = placed.withColumns({"i": F.least("part", "met"), "j": F.greatest("part", "met")}).join(bounded(pointed), "id")
    # Small keys share a group of rows.
    bins = F.lit(max(1, -(-live.count() // POINTS)))
    bin_of = F.when(F.col("all") > POINTS, F.xxhash64("key", "i", "j")).otherwise(F.pmod(F.xxhash64("key"), bins))
    pairs = placed.select("key", "id", "root", "n", "part", "i", "j", "point", bin_of.alias("bin")).groupBy("bin").applyInArrow(
        _survivors, "a bigint, b bigint")
    pairs = stored(pairs.distinct(), "rtree-survivors")
    both = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = stored(nodes.sets(both).dropDuplicates(["id"]), "rtree-fetched")
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("mers").alias(f"mers_{side}")), side)
    return stored(pairs.select("a", "b", _verified("mers_a", "mers_b").alias("near")).filter("near").select("a", "b"), "rtree-late")


def _roots(nodes: Nodes) -> DataFrame | None:
    """node and root of the nodes that link with others; None if none do."""
    postings = _postings(nodes)
    edges = _paths(postings)
    if edges.isEmpty():
        return None
    sizes = nodes.nodes.select("id", "n")
    groups = graph.components(edges).select(F.col("node").alias("id"), F.col("root").alias("group"))
    groups = stored(groups.join(sizes, "id"), "rtree-groups")
    weights = stored(groups.groupBy("group").agg(F.sum(F.col("n").cast("bigint") + GROUPS).alias("weight")), "rtree-weights")
    bins = max(1, -(-(weights.agg(F.sum("weight")).first()[0]) // BLOCK))
    weights = weights.select("group", F.ceil(F.col("weight") / BLOCK).alias("blocks"))
    placed = stored(groups.join(bounded(weights), "group").select("id", "group", "blocks"), "rtree-placed")
    dealt = placed.filter("blocks > 1")

    def joined(members: DataFrame, salt: int) -> DataFrame:
        """Links within the trees of the groups; members are id, group, blocks, root."""
        block = F.when(F.col("blocks") > 1, F.xxhash64("group", F.pmod(F.xxhash64("id", F.lit(salt)), "blocks"))).otherwise(
            F.pmod(F.xxhash64("group"), F.lit(bins)))
        rows = nodes.packed(members.withColumn("block", block).select("id", "group", "root", "block"))
        found = rows.select("block", "group", "id", "root", "sent").groupBy("block").applyInArrow(_trees, "a bigint, b bigint")
        return stored(found, "rtree-links")

    found = joined(placed.withColumn("root", F.col("id")), 0)
    if dealt.isEmpty():
        return None if found.isEmpty() else graph.components(found)
    for settle in (lambda roots: joined(graph.rooted(dealt.withColumn("root", F.col("id")), "root", roots), 1),
                   lambda roots: _rest(postings, nodes, roots, dealt)):
        roots = graph.components(found) if not found.isEmpty() else placed.select(F.col("id").alias("node"), F.col("id").alias("root"))
        found = stored(found.unionByName(settle(roots)), "rtree-links")
    return None if found.isEmpty() else graph.components(found)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    nodes = Nodes(docs)
    roots = _roots(nodes)
    every = nodes.nodes.select("id", "least")
    if roots is None:
        named = every.select("id", F.col("least").alias("component_id"))
    else:
        members = stored(every.join(bounded(roots.withColumnRenamed("node", "id")), "id"), "rtree-linked")
        smallest = stored(members.groupBy("root").agg(F.min("least").alias("component_id")), "rtree-smallest")
        linked_ids = members.join(bounded(smallest), "root").select("id", F.col("component_id").alias("linked_id"), F.lit(True).alias("is_linked"))
        named = every.join(bounded(stored(linked_ids, "rtree-named")), "id", "left").select(
            "id", F.when(F.col("is_linked"), F.col("linked_id")).otherwise(F.col("least")).alias("component_id"))
    named = bounded(stored(named, "rtree-components"))
    with_set = nodes.rows.join(named, "id").select("doc_id", "n", "component_id")
    # Rows without words are in no table of sets; blanks alone tell them.
    alone = docs.filter(F.length(F.btrim(F.coalesce("text", F.lit("")), F.lit(BLANKS))) == 0)
    alone = alone.select("doc_id", F.lit(0).alias("n"), F.col("doc_id").alias("component_id"))
    return with_set.unionByName(alone).select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")
