"""Benchmark decontamination by n-grams of words.

The items are cut into windows of n words (an item with fewer is one window). Their words get numbers and the
windows a rolling hash; both are broadcast. A document is scanned once: its words become numbers, all window hashes come
from one vectorised pass, a bit table discards most, and the rest are verified word by word against the
windows. Hits give spans of words, the items they come from, and either cut spans or dropped documents.

The index is built from blocks of at most INDEX_BYTES of item text, so what is broadcast has a bound; with
more text than that, further blocks are scanned in turn, with the findings so far written in between, and
the result is the same.

Nulls and odd rows: null and empty texts have no words; items without words have no windows; repeated items and
rows are found as often as they occur; null item ids are named "null". An empty table of items marks nothing.
Columns of the input that clash with the finding's name are replaced by it.
"""

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from .common import free, quoted, stored

N = 10
INDEX_BYTES = 32 << 20
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", _SPANS)])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Lower case for A-Z, blanks for everything that is no word byte; bytes of other scripts stay.
_BYTES = bytearray(b" " * 256)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _BYTES[_b] = _b
for _b in range(0x41, 0x5B):
    _BYTES[_b] = _b + 32
_BYTES = bytes(_BYTES)
_SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normal_words(text: str) -> list[bytes]:
    return text.encode().translate(_BYTES).split()


class Index:
    """Windows of items, grouped by their length in words."""

    def __init__(self, items: list[tuple[str, str]], n: int = N):
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        self.windows: dict[int, dict[bytes, tuple[int, ...]]] = {}
        for name, text in items:
            tokens = normal_words(text)
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens], np.int32)
            size = min(n, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                own = self.windows.setdefault(size, {})
                key = ids[i:i + size].tobytes()
                own[key] = tuple(sorted({*own.get(key, ()), number[name]}))
        self.tables = {}
        for size, own in self.windows.items():
            bits = max(16, int(len(own) * 64).bit_length())
            table = np.zeros(1 << bits, bool)
            hashes = np.array([_hashes(np.frombuffer(key, np.int32), size)[0] for key in own], np.uint64)
            table[hashes >> np.uint64(64 - bits)] = True
            self.tables[size] = (np.uint64(64 - bits), table)

    def numbers(self, text: str) -> np.ndarray:
        """The words of a text as numbers, 0 for those of no item; long texts go in slices."""
        data, found, start = text.encode().translate(_BYTES), [], 0
        while start < len(data):
            end = len(data) if start + _SLICE >= len(data) else data.rfind(b" ", start, start + _SLICE) + 1 or len(data)
            if end <= start:  # one word longer than a slice
                end = (data.find(b" ", start + _SLICE) + 1) or len(data)
            tokens = data[start:end].split()
            found.append(np.fromiter(map(self.vocabulary.get, tokens, repeat(0)), np.int32, len(tokens)))
            start = end
        return np.concatenate(found) if found else np.empty(0, np.int32)

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and the items."""
        edges, items = np.zeros(len(ids) + 1, np.int64), set()
        for size, own in self.windows.items():
            if len(ids) < size:
                continue
            shift, table = self.tables[size]
            for i in np.flatnonzero(table[_hashes(ids, size) >> shift]):
                if (names := own.get(ids[i:i + size].tobytes())) is not None:
                    edges[i] += 1
                    edges[i + size] -= 1
                    items.update(names)
        return np.cumsum(edges[:-1]) > 0, items


def _hashes(ids: np.ndarray, size: int) -> np.ndarray:
    values, n = ids.astype(np.uint64), len(ids) - size + 1
    out = values[:n].copy()
    for j in range(1, size):
        out *= _BASE
        out += values[j:n + j]
    return out * np.uint64(0xD6E8FEB86659FD93)


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    turns = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist()))


def _scanner(index) -> Column:
    """A column function (text, finding so far) -> finding; spans are in words here."""
    @arrow_udf(FOUND)
    def scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own: Index = index.value
        for texts, before in batches:
            rows = []
            for text, old in zip(texts, before):
                ids = own.numbers(text.as_py() or "")
                hit, items = own.find(ids)
                names, old = {own.names[i] for i in items}, old.as_py()
                if old:
                    names.update(old["items"])
                    for span in old["spans"]:
                        hit[span["start"]:span["end"]] = True
                spans = [{"start": a, "end": b} for a, b in _runs(hit)] if hit.any() else []
                rows.append({"n_words": len(ids), "n_hit": int(hit.sum()), "items": sorted(names), "spans": spans})
            yield pa.array(rows, FOUND_ARROW)

    return scan


FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                         ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def find_leaks(docs: DataFrame, items: DataFrame, n: int = N, name: str = "leak") -> DataFrame:
    """The documents with a struct `name`: n_words, n_hit, items (sorted as text), spans (first word, word after the last)."""
    spark = docs.sparkSession
    items = items.filter("text is not null").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // INDEX_BYTES) or 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    found = docs.drop(name).withColumn(name, F.lit(None).cast(FOUND))
    for i in range(blocks):
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in items.filter(block == i).toLocalIterator()], n))
        scan = _scanner(index).asNondeterministic()  # evaluated once, never copied into a filter
        found = found.withColumn(name, scan(F.col("text"), F.col(name)))
        if i + 1 < blocks:
            found = stored(found, "leaks")
    return found


@arrow_udf(T.StringType())
def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """The text without the spans of words, cut from the first character of a span to the last."""
    kept = []
    for text, own in zip(texts.to_pylist(), spans.to_pylist()):
        if text and own:
            places = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
            parts, start = [], 0
            for span in own:
                parts.append(text[start:places[span["start"]][0]])
                start = places[span["end"] - 1][1]
            text = "".join(parts) + text[start:]
        kept.append(text)
    return pa.array(kept, pa.string())


_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def decontaminate(docs: DataFrame, items: DataFrame, n: int = N, remove: str = "documents") -> DataFrame:
    """The documents without contaminated ones (remove="documents") or without the hit words ("spans")."""
    name = free(docs, "_leak")
    found = find_leaks(docs, items, n, name)
    if remove == "documents":
        return found.filter(F.col(name)["n_hit"] == 0).select(*quoted(docs.columns))
    clean = F.when(F.col(name)["n_hit"] > 0, _cut(F.col("text"), F.col(name)["spans"])).otherwise(F.col("text"))
    return found.withColumn("text", clean).select(*quoted(docs.columns))
