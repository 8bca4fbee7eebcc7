"""Near-duplicates by Order MinHash, with candidates verified by banded alignment.

A text is its sequence of lower-case words; its k-mers of five words are labelled with their occurrence number.
Each of ROWS * BANDS hash functions picks the two smallest labelled k-mers and keeps them in text order, so that a sketch
agrees when the texts share those k-mers in the same order; ROWS sketches form a band, and texts that agree
in a band share a bucket. With k-mer overlap J a pair meets in a band with about J ** (2 * ROWS).

Two texts are near-duplicates when 1 - edits / length of the longer >= 0.8, in words, or when their k-mers
overlap by 0.8 or more in order, which takes up to 2/9 of the longer text in edits (own blocks at different places). The latter
meet with probability over 0.999. Pairs that only the edits admit meet less often the more evenly their edits are
spread; README has measured shares. The edit distance is banded: lengths and shared words rule
most pairs out, anchors (k-mers in common, in increasing order) usually prove the rest, and what is left is aligned diagonal by
diagonal, exactly, up to the distance allowed.

Groups: equal texts are one node, found by digest. In a bucket one pivot is compared with all members, and
components are formed. Buckets that still hold several are dealt into blocks of bounded size by hash, and
one group of rows compares two blocks: members of different components, except those within the
heaviest one. So every pair of a bucket is compared or connected and no link is lost; no pairs are written, and a
bucket of near copies costs its size, not its square.

Nulls and odd rows: equal texts (also empty ones) form a class; a null text is alone. Texts without words or
with fewer than five are one k-mer. Classes are named by the smallest id of their rows, nulls last; repeated rows share a
class, and one row of a class is kept: smallest id, then smallest row as JSON. Empty tables give empty results.
"""

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from . import graph
from .common import bounded, free, quoted, stored

K, PICKED, ROWS, BANDS, SIMILARITY = 5, 2, 3, 32, 0.8
#: Texts compared with one another in one group have about so many words in all; each counts BASE_WORDS more.
BLOCK_WORDS, BASE_WORDS = 60_000, 50
_SHARES = 1024  # classes of words whose counts rule pairs out

_rng = np.random.default_rng(20240101)
_ODD = _rng.integers(1 << 62, 1 << 63, (ROWS * BANDS, 1), dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, (ROWS * BANDS, 1), dtype=np.uint64)
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_CHUNK = 4096
_SKETCH = T.StructType([T.StructField("n_words", T.IntegerType()), T.StructField("bands", T.ArrayType(T.LongType()))])
_SKETCH_ARROW = pa.struct([("n_words", pa.int32()), ("bands", pa.list_(pa.int64()))])


class _Numbers(dict):
    """Words to 64-bit numbers, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_numbers(text: str, numbers: _Numbers) -> np.ndarray:
    words = text.lower().encode().split()
    return np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))


def kmers(words: np.ndarray, k: int = K) -> np.ndarray:
    """One number per k-mer and occurrence, in text order; fewer than k words are one k-mer."""
    size = min(k, len(words))
    n = len(words) - size + 1
    if not size:
        return np.zeros(1, np.uint64)
    out = words[:n].copy()
    for j in range(1, size):
        out *= _MIX
        out += words[j:n + j]
    out ^= out >> np.uint64(29)
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    if len(starts) < n:
        occurrence = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        out[order] = ranked + occurrence.astype(np.uint64) * _MIX2
    return out


def sketch(mers: np.ndarray) -> np.ndarray:
    """The bands of a text: per function its two smallest k-mers in text order; long texts go in chunks."""
    m, picked = len(_ODD), min(PICKED, len(mers))
    best = np.full((m, 2), np.iinfo(np.uint64).max, np.uint64)
    place = np.zeros((m, 2), np.int64)
    rows = np.arange(m)
    for start in range(0, len(mers), _CHUNK):
        values = mers[None, start:start + _CHUNK] * _ODD + _ADD
        for _ in range(picked):
            at = values.argmin(axis=1)
            value = values[rows, at]
            values[rows, at] = np.iinfo(np.uint64).max
            first, second = value < best[:, 0], (value < best[:, 1]) & (value >= best[:, 0])
            best[first, 1], place[first, 1] = best[first, 0], place[first, 0]
            best[first, 0], place[first, 0] = value[first], at[first] + start
            best[second, 1], place[second, 1] = value[second], at[second] + start
    if picked < 2:
        place[:, 1] = place[:, 0]
    place.sort(axis=1)
    pairs = mers[place[:, 0]] * _MIX + mers[place[:, 1]] * _MIX2
    bands = np.zeros(BANDS, np.uint64)
    for r in range(ROWS):
        bands = (bands ^ (bands >> np.uint64(31))) * _MIX + pairs.reshape(BANDS, ROWS)[:, r]
    return (bands + np.arange(BANDS, dtype=np.uint64) * _MIX2).view(np.int64)


@arrow_udf(_SKETCH)
def _sketches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    numbers = _Numbers()
    for texts in batches:
        rows = []
        for text in texts:
            words = word_numbers(text.as_py(), numbers)
            rows.append({"n_words": len(words), "bands": sketch(kmers(words))})
        yield pa.array(rows, _SKETCH_ARROW)


def _increasing(values: np.ndarray) -> np.ndarray:
    """Places of a longest increasing subsequence."""
    if len(values) < 2 or (np.diff(values) > 0).all():
        return np.arange(len(values))
    tails, at, before = [], [], []
    for i, v in enumerate(values.tolist()):
        j = bisect_left(tails, v)
        before.append(at[j - 1] if j else -1)
        if j == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[j], at[j] = v, i
    out, i = [], at[-1]
    while i >= 0:
        out.append(i)
        i = before[i]
    return np.array(out[::-1])


def within(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two sequences of words need at most (1 - similarity) * length of the longer edits, or keep that overlap of k-mers in order.

    An overlap also implies what the lengths and the words in common are tested for.
    """
    longer = max(len(a), len(b))
    allowed = int((1 - similarity) * longer + 1e-9)
    if longer - min(len(a), len(b)) > allowed:
        return False
    if not longer:
        return True
    values_a, counts_a = np.unique(a, return_counts=True)
    values_b, counts_b = np.unique(b, return_counts=True)
    _, at_a, at_b = np.intersect1d(values_a, values_b, assume_unique=True, return_indices=True)
    if longer - np.minimum(counts_a[at_a], counts_b[at_b]).sum() > allowed:
        return False
    return _anchored(a, b, allowed) <= allowed or ordered_overlap(a, b) >= similarity or edit_distance(a, b, allowed) <= allowed


def ordered_overlap(a: np.ndarray, b: np.ndarray) -> float:
    """The share of all k-mers that both sequences have, in one order."""
    mers_a, mers_b = kmers(a), kmers(b)
    _, i, j = np.intersect1d(mers_a, mers_b, assume_unique=True, return_indices=True)
    common = len(_increasing(j[np.argsort(i)]))
    return common / (len(mers_a) + len(mers_b) - common)


def _anchored(a: np.ndarray, b: np.ndarray, allowed: int) -> int:
    """The edits of one alignment: k-mers in common near the diagonal, in increasing order, and gaps between."""
    if min(len(a), len(b)) < K:
        return max(len(a), len(b)) + 1
    _, i, j = np.intersect1d(kmers(a), kmers(b), assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= allowed
    i, j = i[near], j[near]
    order = np.argsort(i)
    i, j = i[order], j[order]
    chain = _increasing(j)
    if not len(chain):
        return max(len(a), len(b)) + 1
    i, j = i[chain], j[chain]
    di, dj = np.diff(i), np.diff(j)
    # Between two anchors: nothing on one diagonal that stays within the k-mer, else the longer gap.
    gap_i, gap_j = np.maximum(di - K, 0), np.maximum(dj - K, 0)
    inner = np.where((di == dj) & (di <= K), 0, np.maximum(np.maximum(gap_i, gap_j), np.abs(di - dj)))
    return int(max(i[0], j[0]) + max(len(a) - K - i[-1], len(b) - K - j[-1]) + inner.sum())


def edit_distance(a: np.ndarray, b: np.ndarray, allowed: int) -> int:
    """Edit distance up to `allowed`, else allowed + 1: furthest places per diagonal, diagonals at once."""
    n, m = len(a), len(b)
    if abs(n - m) > allowed:
        return allowed + 1
    width = 2 * allowed + 3
    middle = allowed + 1
    diagonals = np.arange(width) - middle  # column of b minus row of a
    far = np.full(width, -10**9, np.int64)  # furthest row reached
    far[middle] = 0
    for edits in range(allowed + 1):
        if edits:
            step = np.maximum(far + 1, np.maximum(np.append(far[1:] + 1, -10**9), np.append(-10**9, far[:-1])))
            far = np.where(np.abs(diagonals) <= edits, step, -10**9)
        far = np.minimum(far, np.minimum(n, m - diagonals))
        active = np.flatnonzero(far >= 0)
        rows = far[active]
        while len(active):  # slide along equal words
            columns = rows + diagonals[active]
            inside = (rows < n) & (columns < m) & (columns >= 0)
            same = inside.copy()
            same[inside] = a[rows[inside]] == b[columns[inside]]
            active, rows = active[same], rows[same] + 1
            far[active] = rows
        if far[middle + m - n] >= n:
            return edits
    return allowed + 1


@arrow_udf(T.BooleanType())
def _verified(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    numbers = _Numbers()
    for lefts, rights in batches:
        out, last, words = [], None, None
        for left, right in zip(lefts, rights):
            left = left.as_py()
            if left != last:
                last, words = left, word_numbers(left, numbers)
            out.append(within(words, word_numbers(right.as_py(), numbers)))
        yield pa.array(out, pa.bool_())


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, near for distinct pairs of nodes, written."""
    joined = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return stored(joined.select("a", "b", _verified("text_a", "text_b").alias("near")), "omh-verified")


def _compared(block: pa.Table) -> pa.Table:
    """Links (a, b) between the roots of one block, or of two, that are not yet connected.

    A pair is compared in the first bucket it shares. The counts of words per class bound the words in common from above, so
    what they rule out is no near-duplicate; the rest is aligned.
    """
    bucket, i, j = (block[c][0].as_py() for c in ("bucket", "i", "j"))
    part, roots = block["part"].to_numpy(), block["root"].to_numpy()
    bands = np.array(block["bands"].to_pylist(), np.int64)
    numbers = _Numbers()
    words = [word_numbers(t, numbers) for t in block["text"].to_pylist()]
    lengths = np.array([len(w) for w in words])
    shares = np.stack([np.bincount((w % np.uint64(_SHARES)).astype(np.int64), minlength=_SHARES) for w in words]).astype(np.int32)
    above = {r: r for r in roots.tolist()}

    def top(r: int) -> int:
        while above[r] != r:
            r = above[r]
        return r

    links, right = [], np.flatnonzero(part == j)
    for x in np.flatnonzero(part == i).tolist():
        others = right[right > x] if i == j else right
        others = others[roots[others] != roots[x]]
        longer = np.maximum(lengths[others], lengths[x])
        allowed = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
        fit = longer - np.minimum(lengths[others], lengths[x]) <= allowed
        others, longer, allowed = others[fit], longer[fit], allowed[fit]
        first = (bands[others] == bands[x]).argmax(axis=1)
        fit = bands[x][first] == bucket
        others, longer, allowed = others[fit], longer[fit], allowed[fit]
        others = others[longer - np.minimum(shares[others], shares[x]).sum(axis=1) <= allowed]
        for y in others.tolist():
            a, b = top(int(roots[x])), top(int(roots[y]))
            if a != b and within(words[x], words[y]):
                above[max(a, b)] = min(a, b)
                links.append((int(roots[x]), int(roots[y])))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _roots(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node and root of the nodes that are linked to others of a bucket, all pairs being compared or connected."""
    buckets = nodes.select("id", "n_words", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct("id", "n_words")).alias("pivot")).filter("n > 1")
    members = stored(buckets.join(shared.select("bucket", "pivot"), "bucket"), "omh-members")
    names = stored(members.select("id").distinct().join(nodes.select("id", "node"), "id"), "omh-names")
    texts = docs.filter("text is not null").select(F.unhex(F.md5("text")).alias("node"), "text").join(bounded(names), "node")
    texts = stored(texts.groupBy("id").agg(F.first("text").alias("text")), "omh-texts")
    longer, shorter = F.greatest("n_words", "pivot.n_words"), F.least("n_words", "pivot.n_words")
    first = members.filter((F.col("id") != F.col("pivot.id")) & (longer - shorter <= (1 - SIMILARITY) * longer + 1e-9))
    tried = _verify(first.select(F.col("pivot.id").alias("a"), F.col("id").alias("b")).distinct(), texts)
    roots = graph.components(tried.filter("near"))

    # Buckets that hold several components: the heaviest is compared with the others, they also with each other.
    live = graph.rooted(members.select("id", "n_words", "bucket", F.col("id").alias("root")), "root", roots)
    live = stored(live, "omh-rooted")
    each = live.groupBy("bucket", "root").agg(F.sum(F.col("n_words").cast("bigint") + BASE_WORDS).alias("weight"))
    mixed = each.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("weight").alias("all"),
                                       F.max(F.struct("weight", "root")).alias("top")).filter("n > 1")
    mixed = mixed.select("bucket", F.col("top.root").alias("top"), F.ceil((F.col("all") - F.col("top.weight")) / BLOCK_WORDS).alias("others"),
                         F.ceil(F.col("top.weight") / BLOCK_WORDS).alias("tops"))
    live = stored(live.join(mixed, "bucket"), "omh-live")
    wanted = bounded(stored(live.select("id").distinct(), "omh-wanted"))
    known = texts.join(wanted, "id", "left_semi").join(nodes.select("id", "bands").join(wanted, "id", "left_semi"), "id")
    # A member meets every block of the others; a member of the heaviest component only those.
    is_other, place = F.col("root") != F.col("top"), F.xxhash64("id")
    part = F.when(is_other, F.pmod(place, "others")).otherwise(F.col("others") + F.pmod(place, "tops"))
    meets = F.sequence(F.lit(0).cast("bigint"), F.when(is_other, F.col("others") + F.col("tops")).otherwise(F.col("others")) - 1)
    placed = live.select("id", "root", "bucket", part.alias("part"), meets.alias("meets")).join(known, "id")
    placed = placed.select("root", "bucket", "bands", "text", "part", F.explode("meets").alias("met"))
    placed = placed.withColumns({"i": F.least("part", "met"), "j": F.greatest("part", "met")}).drop("met")
    links = placed.groupBy("bucket", "i", "j").applyInArrow(_compared, "a bigint, b bigint")
    links = stored(links.distinct(), "omh-links")
    if links.isEmpty():
        return roots
    later = graph.components(links)
    # Roots without links so far are nodes of the later round only.
    new = later.join(bounded(roots.select("node")), "node", "left_anti")
    return graph.rooted(roots, "root", later).unionByName(new)


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, node, bands of every row with a text, written: the one pass over all texts."""
    rows = docs.filter("text is not null").select("doc_id", F.unhex(F.md5("text")).alias("node"), _sketches("text").alias("s"))
    return stored(rows.select("doc_id", "node", "s.n_words", "s.bands"), "omh-sketches")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketched rows, and (node, class_id, keeper) of every distinct text."""
    rows = sketched(docs)
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("n_words").alias("n_words"), F.first("bands").alias("bands"))
    # Numbers instead of digests from here on; written with the table, so they stay.
    nodes = stored(nodes.withColumn("id", F.monotonically_increasing_id()), "omh-nodes")
    roots = stored(_roots(nodes, docs).withColumnRenamed("node", "id"), "omh-roots")
    members = stored(nodes.select("id", "node", "least").join(bounded(roots), "id"), "omh-grouped")
    smallest = members.groupBy("root").agg(F.min("least").alias("class_id"),
                                           F.min_by("node", F.struct(F.col("least").isNull(), "least", "node")).alias("keeper"))
    # The classes of several texts are far fewer than texts; a hot one is no key of a shuffle while they are broadcast.
    named = members.join(bounded(stored(smallest, "omh-smallest")), "root").select("node", "class_id", "keeper")
    alone = nodes.join(bounded(roots.select("id")), "id", "left_anti").select("node", F.col("least").alias("class_id"), F.col("node").alias("keeper"))
    return rows, stored(named.unionByName(alone), "omh-classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and class_id (the smallest doc_id of its near-duplicates) of every row."""
    rows, classes = _classes(docs)
    alone = docs.filter("text is null").select("doc_id", F.col("doc_id").alias("class_id"))
    return rows.select("doc_id", "node").join(classes.select("node", "class_id"), "node").select("doc_id", "class_id").unionByName(alone)


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each class, with the columns of the input.

    What goes is named by (text digest, id): the texts of the others stay where they are unless a table of
    names outgrows a broadcast. Rows that repeat the kept id and text are rare and are settled apart.
    """
    rows, classes = _classes(docs)
    counts = rows.groupBy("node", "doc_id").agg(F.count("*").alias("copies"))
    kept = counts.join(classes, "node").filter((F.col("node") == F.col("keeper")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = stored(kept.select("node", "doc_id", "copies"), "omh-kept")
    gone = stored(counts.join(kept, (counts["node"] == kept["node"]) & counts["doc_id"].eqNullSafe(kept["doc_id"]), "left_anti")
                  .select("node", "doc_id"), "omh-gone")
    repeated = stored(kept.filter("copies > 1").select("node", "doc_id"), "omh-again")
    node, name, number = (free(docs, n) for n in ("_node", "_name", "_number"))
    named = docs.withColumn(node, F.unhex(F.md5("text")))

    def drop(frame: DataFrame, names: DataFrame, how: str) -> DataFrame:
        names = names.select(F.col("node").alias(name), F.col("doc_id").alias(number))
        return frame.join(bounded(names), (F.col(node) == F.col(name)) & F.col("doc_id").eqNullSafe(F.col(number)), how)

    left = drop(named, gone, "left_anti")
    once = drop(left, repeated, "left_anti")
    if not repeated.isEmpty():
        again = drop(left, repeated, "left_semi")
        rank = free(docs, "_rank")
        order = Window.partitionBy(node, "doc_id").orderBy(F.to_json(F.struct(*quoted(docs.columns))))
        once = once.unionByName(again.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(rank))
    return once.select(*quoted(docs.columns))
