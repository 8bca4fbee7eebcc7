"""How quality filters interact: what each removes, in every order, by itself and in Shapley's sum.

One pass over the bytes of the texts feeds five filters. A transducer with two states (between words, in a word) reads
byte classes: its tables say which state follows and what a byte puts out (a word starts, a word ends, a
capital, a symbol, a code point). The next state depends on the byte alone, so the states of a buffer are its classes
shifted by one byte, and whole Arrow buffers run through the tables at once. Each word span goes into a hash
table of its text with open addressing, where spans of equal hash are compared byte by byte: the entries are the distinct
words. Exact copies are found by digest, with the smallest id of each digest.

A document is then the set of filters that it fails. Per part (source) the documents of each such set are counted, and all
orders, steps and sums follow from at most 32 counts a part.

Texts are taken in pieces of about a mebibyte that end between words; small texts share a piece. Memory is that of an
Arrow batch, a piece (longer if one word is) and the distinct words of one text.

Nulls and odd rows: a null text is empty (no words: it fails A and no other but E). A null source is the empty string, and
the same part as an empty one. A null id has no smaller one and is none: such rows fail E only beside a smaller id. Repeated
rows of one id are not copies of each other. A document is good, or toxic, if any label with its id says so; labels
without an id, or whose id no document has, are ignored. Further columns are ignored. An empty table gives an empty result.
"""

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from .common import bounded, stored

# Fixed values of the query contract.
SYMBOLS = b"#$%&*|"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 50, 65, 5
LETTERS = "ABCDE"

# Byte classes, states and outputs of the transducer.
BLANK, PLAIN, CAPITAL, SYMBOL, INNER = range(5)  # INNER: a byte within a code point
BETWEEN, WORD = range(2)
STARTS, ENDS, UPPER, MARK, POINT = 1, 2, 4, 8, 16
CLASS = np.full(256, PLAIN, np.uint8)
CLASS[0x80:0xC0] = INNER
CLASS[ord("A"):ord("Z") + 1] = CAPITAL
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[list(b" \t\n\x0b\x0c\r")] = BLANK
NEXT = np.array([BETWEEN, WORD, WORD, WORD, WORD], np.uint8)
OUTPUT = np.array([
    [POINT, POINT | STARTS, POINT | STARTS | UPPER, POINT | STARTS | MARK, STARTS],
    [POINT | ENDS, POINT, POINT | UPPER, POINT | MARK, 0],
], np.uint8)

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_MIX = np.uint64(0xBF58476D1CE4E5B9)
STATS = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")])


def transduce(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The outputs of all bytes; a text starts between words at each place of `starts`."""
    classes = CLASS[data]
    states = np.empty(len(data), np.uint8)
    states[1:] = NEXT[classes[:-1]]
    states[starts[starts < len(data)]] = BETWEEN
    return OUTPUT[states, classes]


class Powers:
    """Powers of the base and of its inverse, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of spans as differences of one running polynomial, shifted to the same power."""
    powers.reach(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[:len(data)], out=running[1:])
    mixed = (running[ends] - running[starts]) * powers.down[starts]
    return (mixed ^ (mixed >> np.uint64(32))) * _MIX


class SpanTable:
    """The distinct words of texts in one buffer: open addressing, equal hashes verified byte by byte."""

    def __init__(self, data: np.ndarray):
        self.data, self.slots = data, np.full(1 << 10, -1, np.int64)
        self.hashes = np.zeros(0, np.uint64)
        self.spans = np.zeros((3, 0), np.int64)  # start, length, text

    def _same(self, spans: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans a and b are the same bytes of the same text, their hashes being equal."""
        same = (spans[1, a] == spans[1, b]) & (spans[2, a] == spans[2, b])
        left = np.flatnonzero(same)
        if len(left):
            lengths = spans[1, a[left]]
            before = np.cumsum(lengths) - lengths
            inside = np.arange(lengths.sum()) - np.repeat(before, lengths)
            equal = self.data[np.repeat(spans[0, a[left]], lengths) + inside] == self.data[np.repeat(spans[0, b[left]], lengths) + inside]
            same[left] = np.logical_and.reduceat(equal, before)
        return same

    def _grow(self, entries: int) -> None:
        if len(self.slots) < 2 * entries:
            self.slots = np.full(1 << (2 * entries - 1).bit_length(), -1, np.int64)
            mask, left = np.uint64(len(self.slots) - 1), np.arange(len(self.hashes))
            at = (self.hashes & mask).astype(np.int64)
            while len(left):
                empty = self.slots[at] < 0
                self.slots[at[empty]] = left[empty]
                other = self.slots[at] != left
                left, at = left[other], (at[other] + 1) & int(mask)

    def insert(self, hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Which of the words are new to their text (one of several equal ones)."""
        known = len(self.hashes)
        every, spans = np.concatenate((self.hashes, hashes)), np.hstack((self.spans, np.stack((starts, lengths, texts))))
        self._grow(len(every))
        mask, new = len(self.slots) - 1, np.zeros(len(hashes), bool)
        left = known + np.arange(len(hashes))
        at = (hashes & np.uint64(mask)).astype(np.int64)
        while len(left):
            empty = self.slots[at] < 0
            self.slots[at[empty]] = left[empty]  # one of several wins
            held = self.slots[at]
            mine = held == left
            new[left[mine] - known] = True
            left, held, at = left[~mine], held[~mine], at[~mine]
            same = every[left] == every[held]
            same[same] = self._same(spans, left[same], held[same])
            left, at = left[~same], (at[~same] + 1) & mask
        numbers = known + np.cumsum(new) - 1
        late = self.slots >= known
        self.slots[late] = numbers[self.slots[late] - known]
        kept = np.concatenate((np.ones(known, bool), new))
        self.hashes, self.spans = every[kept], spans[:, kept]
        return new


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text + 1, start, end): several whole texts, or a part of one that ends between words."""
    text, n = 0, len(offsets) - 1
    while text < n:
        last = max(text + 1, int(np.searchsorted(offsets, offsets[text] + PIECE, "right")) - 1)
        start, end = int(offsets[text]), int(offsets[last])
        while end - start > PIECE:
            cut = start + PIECE
            while cut < end and CLASS[data[cut]] != BLANK:
                cut += int(np.argmax(np.append(CLASS[data[cut:min(end, cut + 4096)]] == BLANK, True)))
            yield text, last, start, cut
            start = cut
        yield text, last, start, end
        text = last


def text_stats(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> np.ndarray:
    """Words, distinct words, capitals, code points and symbols of each text between two offsets."""
    n = len(offsets) - 1
    counts, table, of = np.zeros((5, n), np.int64), None, -1
    for first, last, a, b in _pieces(data, offsets):
        if first != of:
            table, of = SpanTable(data), first
        borders = np.clip(offsets[first:last + 1], a, b)
        out = transduce(data[a:b], borders[:-1] - a)

        def texts_of(places: np.ndarray) -> np.ndarray:
            return np.searchsorted(borders, places + a, "right") - 1

        def count(row: int, places: np.ndarray) -> None:
            counts[row, first:last] += np.bincount(texts_of(places), minlength=last - first)

        starts = np.flatnonzero(out & STARTS)
        # A word also ends where its text does.
        open_at = borders[1:][borders[1:] > borders[:-1]] - a
        open_at = open_at[CLASS[data[a + open_at - 1]] != BLANK]
        ends = np.sort(np.concatenate((np.flatnonzero(out & ENDS), open_at)))
        owners = texts_of(starts)
        counts[0, first:last] += np.bincount(owners, minlength=last - first)
        hashes = span_hashes(data[a:b], starts, ends, powers) + owners.astype(np.uint64) * _MIX
        new = table.insert(hashes, starts + a, ends - starts, owners)
        counts[1, first:last] += np.bincount(owners[new], minlength=last - first)
        count(2, np.flatnonzero(out & UPPER))
        counts[3, first:last] += np.diff(borders) - np.bincount(texts_of(np.flatnonzero((out & POINT) == 0)), minlength=last - first)
        count(4, np.flatnonzero(out & MARK))
    return counts


@arrow_udf(STATS)
def _stats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    powers = Powers()
    for texts in batches:
        texts = texts.cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        counts = text_stats(data, offsets, powers)
        yield pa.StructArray.from_arrays([pa.array(c) for c in counts], STATS.names)


def own_failures() -> Column:
    """The filters A to D that a row of STATS fails, as bits in this order."""
    fails = [F.col("n_words") < MIN_WORDS, 100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"),
             100 * F.col("n_capitals") > MAX_CAPITAL_PERCENT * F.col("n_points"), F.col("n_symbols") > 0]
    bits = F.lit(0)
    for i, fail in enumerate(fails):
        bits = bits + F.when(fail, 1 << i).otherwise(0)
    return bits


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part, the STATS columns, and `fails`: the bits of the filters A to E, of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), _stats(text).alias("s"))
    rows = stored(rows.select("doc_id", "part", "digest", "s.*").withColumn("own", own_failures()), "audit-rows")
    # Only texts that several rows have; summed up in tasks before the shuffle, so a hot text is a row per task.
    first = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).filter("n > 1")
    first = stored(first.select("digest", "first_id"), "audit-copies")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    joined = rows.join(bounded(first), "digest", "left")
    return joined.select("doc_id", "part", *STATS.names, (F.col("own") + F.when(copy, 16).otherwise(0)).alias("fails"))


def marks(labels: DataFrame) -> DataFrame:
    """doc_id, good, toxic: one row per labelled document."""
    any_of = {"good": "quality", "toxic": "toxic"}
    return labels.filter("doc_id is not null").groupBy("doc_id").agg(
        *[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(n) for n, c in any_of.items()])


def _total(value: str, where) -> Column:
    """Sum of a value over the cells of a part whose set of failed filters fits."""
    return F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, c: a + F.when(where(c["fails"]), c[value]).otherwise(0))


def _shapley(letter: int) -> Column:
    """What a filter removes, summed over all orders: each cell times the orders that put none of its other filters first."""
    others = range(1 << len(LETTERS))
    ways = [sum(factorial(s.bit_count()) * factorial(len(LETTERS) - 1 - s.bit_count()) for s in others if not s >> letter & 1 and not s & fails)
            for fails in others]
    weights = F.array(*[F.lit(w) for w in ways])
    return F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, c: a + F.when(
        c["fails"].bitwiseAND(F.lit(1 << letter)) != 0, c["n"] * F.element_at(weights, c["fails"] + 1)).otherwise(0))


def audit(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step: see the module; all counts are long."""
    known = stored(marks(labels), "audit-marks")
    rows = failed.select("doc_id", "part", "fails").join(bounded(known), "doc_id", "left")
    cells = rows.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.count_if(F.coalesce("good", F.lit(False))).alias("good"),
        F.count_if(F.coalesce("toxic", F.lit(False))).alias("toxic"))
    # At most one cell per set of filters, so 32 a part.
    parts = stored(cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells")), "audit-cells")

    orders = [(o, i) for o in permutations(range(len(LETTERS))) for i in range(len(LETTERS))]
    steps = F.array(*[F.struct(F.lit("".join(LETTERS[f] for f in o)).alias("filter_order"), F.lit(i + 1).alias("step"),
                               F.lit(sum(1 << f for f in o[:i])).alias("before"), F.lit(1 << o[i]).alias("own")) for o, i in orders])
    shares = F.map_from_arrays(F.array(*[F.lit(1 << f) for f in range(len(LETTERS))]),
                               F.array(*[_shapley(f) for f in range(len(LETTERS))]))
    parts = parts.select("part", "cells", shares.alias("shares")).select("part", "cells", "shares", F.explode(steps).alias("s")).select(
        "part", "cells", "shares", "s.*")
    before, own = F.col("before"), F.col("own")

    def fits(all_of: Column, none_of: Column):
        return lambda fails: (fails.bitwiseAND(all_of) == all_of) & (fails.bitwiseAND(none_of) == 0)

    here, nothing = fits(own, before), F.lit(0)
    return parts.select(
        "part", "filter_order", "step",
        _total("n", fits(nothing, before.bitwiseOR(own))).alias("kept"), _total("n", here).alias("removed"),
        _total("n", lambda fails: (fails.bitwiseAND(own) != 0) & (fails.bitwiseAND(before) != 0)).alias("redundant"),
        _total("n", lambda fails: fails == own).alias("unique_fails"),
        _total("good", here).alias("good_lost"), _total("toxic", here).alias("toxic_lost"),
        F.element_at("shares", own).alias("shapley"))
