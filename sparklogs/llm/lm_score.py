"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to levels: count c has level 1 + floor(log_BASE c). The filter
holds (n-gram, 1) ... (n-gram, level); a count is read by probing level after level until one is missing, so
false positives fall off geometrically. P(word | previous) is WEIGHT times the pair's share of the previous word's count,
plus the rest of the weight times the word's own frequency (smoothed by one, with one unknown word); after a word not seen it is that
frequency alone. With exact counts it sums to one in every context; levels shift it by their rounding.

Texts are cut into parts of about PART_TOKENS tokens, written as numbers. A part sends each of its distinct n-grams once,
with its count in the training texts, to the shard of that n-gram, so a frequent n-gram is one row per part. A shard is
one group: it sums the counts, fills its own filter and answers each part with levels, in the order asked, and with the
exact counts of words, which the base score needs. All words and pairs are admitted; shards hold about SHARD_GRAMS requests,
and their number grows with the tokens. One filter broadcast whole would outgrow every worker, and blocks broadcast in turn
would need passes over all texts in proportion to their size; so n-grams travel to the filter's shards, not shards to the texts.
Words are named by 64-bit digests. Sorted numbers travel as gaps, in planes of bytes, which compress well.

Nulls and odd rows: a null or empty text has the end token only. A null id is that of the empty text for the split. Repeated rows
count each. With no training rows all counts are 0; an empty table gives an empty result. A text is in one part however long it
is: its tokens take 8 bytes each in the task. Further columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stored

BASE = 1.5
WEIGHT = 0.6
BITS_PER_ENTRY, PROBES = 10, 5
BLOCK_BITS = 1 << 19
PART_TOKENS, SHARD_GRAMS = 1 << 18, 1 << 20
FOLDS, HELD_OUT = 7, 2

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_END = xxhash.xxh64_intdigest(b" ") & ~1  # no word holds a blank
_PAIR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_INSIDE = np.uint64(BLOCK_BITS - 1)
_CHUNK = 1 << 20


class _Numbers(dict):
    """Words to even 64-bit numbers, remembered; pairs have odd ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 60_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) & ~1
        return value


def tokens(text: str | None, numbers: _Numbers) -> np.ndarray:
    """The words of a text as numbers, then the end. Long texts are split in slices."""
    data = (text or "").encode().translate(_LOWER)
    found, start = [], 0
    while start < len(data):
        end = len(data)
        if end - start > _CHUNK:
            cut = max(data.rfind(b, start, start + _CHUNK) for b in (b" ", b"\n", b"\t"))
            end = cut if cut > start else end
        words = data[start:end].split()
        found.append(np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words)))
        start = end
    return np.concatenate([*found, np.array([_END], np.uint64)])


def pairs(own: np.ndarray) -> np.ndarray:
    """The pairs that end at each token; the first token follows an end."""
    before = np.concatenate((np.array([_END], np.uint64), own[:-1]))
    mixed = (before * _PAIR) ^ (own * _MIX)
    mixed ^= mixed >> np.uint64(31)
    return mixed | np.uint64(1)


def packed(values: np.ndarray) -> bytes:
    """Numbers as planes of bytes; the planes of zeros compress to nothing."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return planes.T.copy().view(kind).reshape(-1)


def packed_sorted(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def level_of(count: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(count, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """The middle of the counts with this level; 0 for level 0."""
    return np.where(level > 0, (np.ceil(BASE ** (level - 1.0)) + np.ceil(BASE ** level) - 1) / 2, 0.0)


def _blocks(grams: np.ndarray, blocks: int) -> np.ndarray:
    return (grams >> np.uint64(20)) % np.uint64(blocks)


def _places(grams: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The first bit within its block that (gram, level) has, and the step to the next ones."""
    mixed = (grams + np.uint64(level * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * _PAIR
    mixed ^= mixed >> np.uint64(29)
    return mixed >> np.uint64(20), (mixed * _MIX) >> np.uint64(40) | np.uint64(1)


class Filter:
    """The bits, read only."""

    def __init__(self, blocks: int):
        self.blocks, self.bits = blocks, np.zeros((blocks, BLOCK_BITS // 8), np.uint8)

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """Probe level after level; n-grams drop out at their first missing bit."""
        found = np.zeros(len(grams), np.int64)
        bits, size = self.bits.reshape(-1), np.uint64(BLOCK_BITS // 8)
        active, left, start, level = np.arange(len(grams)), grams, _blocks(grams, self.blocks) * size, 1
        while len(active):
            at, step = _places(left, level)
            alive = np.arange(len(left))
            for _ in range(PROBES):
                place = at & _INSIDE
                hit = (bits[start[alive] + (place >> np.uint64(3))] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                alive, step = alive[hit], step[hit]
                at = at[hit] + step
            active, left, start = active[alive], left[alive], start[alive]
            found[active] = level
            level += 1
        return found


def _fill(blocks: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            grams = batch.column(0).to_numpy().view(np.uint64)
            levels, own = level_of(batch.column(1).to_numpy()), _blocks(grams, blocks).astype(np.int64)
            for block in np.unique(own).tolist():
                bits = made.setdefault(block, np.zeros(BLOCK_BITS, bool))
                inside = own == block
                g, top = grams[inside], levels[inside]
                level = 1
                while len(g):
                    at, step = _places(g, level)
                    for probe in range(PROBES):
                        bits[at & _INSIDE] = True
                        at = at + step
                    level += 1
                    g, top = g[top >= level], top[top >= level]
        for block, bits in made.items():
            packed = np.packbits(bits, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed], pa.binary())], ["block", "bits"])

    return fill


def _parter(size: int, schema: pa.Schema):
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of whole texts: ids, folds and lengths, tokens as places in the sorted words, the words."""
        numbers, number = _Numbers(), TaskContext.get().partitionId() << 32
        for batch in batches:
            start, group, n = 0, [], 0
            for i, text in enumerate(batch.column("text")):
                group.append(tokens(text.as_py(), numbers))
                n += len(group[-1])
                if n >= size or i + 1 == batch.num_rows:
                    words, codes = np.unique(np.concatenate(group), return_inverse=True)
                    offsets = pa.array([0, len(group)], pa.int32())
                    lists = [pa.ListArray.from_arrays(offsets, pa.concat_arrays([c])) for c in (
                        batch.column("doc_id").slice(start, len(group)), batch.column("held_out").slice(start, len(group)),
                        pa.array(map(len, group), pa.int64()))]
                    own = [pa.array([number]), *lists, pa.array([packed(codes.astype(np.uint32))]), pa.array([packed_sorted(words)])]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(own, schema)], schema=schema)
                    start, group, n, number = i + 1, [], 0, number + 1

    return part


def _grams(codes: bytes, words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of a part in increasing order, and the places of each token's word and pair."""
    own = unpacked_sorted(words)[unpacked(codes, np.uint32)]
    grams, at = np.unique(np.concatenate((own, pairs(own))), return_inverse=True)
    return grams, at[:len(own)], at[len(own):]


def _asker(bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per part and shard (the first bits of an n-gram) the n-grams and their counts in training texts."""
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                grams, word, pair = _grams(row["codes"].as_buffer(), row["words"].as_buffer())
                trained = np.repeat(~np.array(row["held_out"].as_py(), bool), row["lengths"].as_py())
                n = np.bincount(word[trained], minlength=len(grams)) + np.bincount(pair[trained], minlength=len(grams))
                edges = np.searchsorted(grams >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                cells = [(i, a, b) for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if b > a]
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i, _, _ in cells], pa.int64()), pa.array([row["part"].as_py()] * len(cells), pa.int64()),
                    pa.array([packed_sorted(grams[a:b]) for _, a, b in cells], pa.binary()),
                    pa.array([packed(n[a:b].astype(np.uint32)) for _, a, b in cells], pa.binary())], ["shard", "part", "grams", "n"])

    return ask


def _answered(cells: pa.Table) -> pa.Table:
    """Levels and counts of words for each part that asks one shard; its totals are in the first row."""
    asked = [unpacked_sorted(g.as_buffer()) for g in cells["grams"]]
    grams, at = np.unique(np.concatenate(asked), return_inverse=True)
    counts = np.bincount(at, np.concatenate([unpacked(n.as_buffer(), np.uint32) for n in cells["n"]])).astype(np.int64)
    trained, word = counts > 0, grams & np.uint64(1) == 0
    blocks = max(1, -(-int(level_of(counts[trained]).sum()) * BITS_PER_ENTRY // BLOCK_BITS))
    made = Filter(blocks)
    batch = pa.RecordBatch.from_arrays([pa.array(grams[trained].view(np.int64)), pa.array(counts[trained])], ["gram", "n"])
    for out in _fill(blocks)([batch]):
        made.bits[out.column(0)[0].as_py()] |= np.frombuffer(out.column(1)[0].as_py(), np.uint8)
    levels = np.minimum(made.levels(grams), 255).astype(np.uint8)
    answers, exact, start = [], [], 0
    for cell in asked:
        own = at[start:start + len(cell)]
        answers.append(levels[own].tobytes())
        exact.append(packed(counts[own][word[own]]))
        start += len(cell)
    totals = [int(counts[word].sum()), int((word & trained).sum())]
    pa.default_memory_pool().release_unused()  # what the group took goes back before the next one
    return pa.table([cells["shard"], cells["part"], pa.array(answers, pa.binary()), pa.array(exact, pa.binary()),
                     *[pa.array([t] + [0] * (len(asked) - 1), pa.int64()) for t in totals]],
                    ["shard", "part", "levels", "counts", "tokens", "words"])


def probability(together: np.ndarray, previous: np.ndarray, one: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """P(word | previous) from the counts of the pair, of the previous word and of the word."""
    own = (one + 1) / (total + distinct + 1)
    return np.where(previous > 0, WEIGHT * together / np.maximum(previous, 1) + (1 - WEIGHT) * own, own)


def _finisher(total: int, distinct: int, schema: pa.Schema):
    log_total = float(np.log10(total + distinct + 1))

    def finish(part: pa.Table, answers: pa.Table) -> pa.Table:
        """The scores of the texts of one part."""
        answers = answers.sort_by("shard")
        grams, word, pair = _grams(part["codes"][0].as_py(), part["words"][0].as_py())
        middle = count_of(np.frombuffer(b"".join(answers["levels"].to_pylist()), np.uint8).astype(np.int64))
        is_word = grams & np.uint64(1) == 0
        exact = np.zeros(len(grams), np.int64)
        exact[is_word] = np.concatenate([np.zeros(0, np.int64), *[unpacked(c.as_buffer(), np.int64) for c in answers["counts"]]])
        base = np.log10(exact[word] + 1.0) - log_total
        one = middle[word]
        previous = np.concatenate((middle[np.searchsorted(grams, np.array([_END], np.uint64))], one[:-1]))
        together = np.minimum(middle[pair], np.minimum(previous, one))
        logs = np.log10(probability(together, previous, one, total, distinct))
        lengths = part["lengths"].combine_chunks().flatten()
        starts = np.concatenate(([0], np.cumsum(lengths.to_numpy())[:-1]))
        sums = [np.add.reduceat(v, starts) for v in ((exact[word] > 0).astype(np.int64), base, logs)]
        own = [part["doc_id"].combine_chunks().flatten(), part["held_out"].combine_chunks().flatten(), lengths, pa.array(sums[0]),
               pa.array(np.full(len(starts), total, np.int64)), pa.array(sums[1]), pa.array(sums[2])]
        return pa.table([c.cast(f.type) for c, f in zip(own, schema)], schema=schema)

    return finish


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT
    kind = docs.schema["doc_id"].dataType
    cut = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("doc_id", T.ArrayType(kind)), T.StructField("held_out", T.ArrayType(T.BooleanType())),
        T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("codes", T.BinaryType()), T.StructField("words", T.BinaryType())])
    parter = _parter(PART_TOKENS, to_arrow_schema(cut))
    # Written, so that the parts stay what they are when a task is repeated.
    parts = stored(docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(parter, cut), "lm-parts")
    size = parts.agg(F.sum(F.octet_length("codes") / 2)).first()[0] or 0  # 4 bytes and two n-grams a token
    bits = max(1, int(np.ceil(np.log2(max(size / SHARD_GRAMS, 1)))))
    asked = parts.select("part", "held_out", "lengths", "codes", "words").mapInArrow(
        _asker(bits), "shard bigint, part bigint, grams binary, n binary")
    answers = stored(asked.groupBy("shard").applyInArrow(
        _answered, "shard bigint, part bigint, levels binary, counts binary, tokens bigint, words bigint"), "lm-levels")
    total, distinct = (n or 0 for n in answers.agg(F.sum("tokens"), F.sum("words")).first())
    scored = T.StructType([
        T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType())])
    finish = _finisher(total, distinct, to_arrow_schema(scored))
    return parts.groupBy("part").cogroup(answers.select("part", "shard", "levels", "counts").groupBy("part")).applyInArrow(finish, scored)
