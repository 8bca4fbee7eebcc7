"""Mix sources to target weights.

Tokens are summed per source, targets and repetition rates follow from the sums, and every document is
emitted floor(rate) times plus once more with probability rate - floor(rate), decided by a keyed hash of its
id, so reruns and retried tasks agree.

A target never exceeds `repeat_limit` times its source; what is cut is shared out again by weight among the
rest until no target is above. That fixed point is min(limit * size, level * weight), and each round finds
the level from two sums over the table of sources.

Nulls and odd rows: a null text has size 0; null is a source of its own, after all others in the order of
weights; a source of size 0 has target and rate 0. Repeated rows share their id and so their decision. An
empty table gives an empty result. In `mix`, columns that clash with `copy` are replaced by it.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .common import free, ordinals, quoted, stored, words

SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def chance(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that follows from the key: 52 bits of its keyed digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple = (5, 2, 1), repeat_limit: int = 3) -> DataFrame:
    """source, source_size, target of each source of a frame (source, size)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Text order in Spark is the order of UTF-8 bytes, which is that of code points.
    sources = ordinals(sources, F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = stored(sources.withColumn("weight", cycle[(F.col("ordinal") % len(weights)).cast("int")]), "mix-sources")
    limit = (repeat_limit * F.col("source_size")).cast("double")
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (total / weight if weight else 0.0), -1
    while True:
        above = limit < level * F.col("weight")
        count, cut, rest = sources.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        if count == capped or not rest:
            break
        level, capped = (total - cut) / rest, count
    return sources.select("source", "source_size",
                          F.when(limit < level * F.col("weight"), limit).otherwise(level * F.col("weight")).alias("target"))


def copies(target: Column, source_size: Column, key: Column, seed: str = SEED) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(0.0)
    return (F.floor(rate) + F.when(chance(key, seed) < rate - F.floor(rate), 1).otherwise(0)).cast("bigint")


def with_copies(docs: DataFrame, key: str = "doc_id", weights: tuple = (5, 2, 1), repeat_limit: int = 3,
                seed: str = SEED) -> DataFrame:
    """A frame with (key, source, size) and `source_size`, `target`, `copies` beside them.

    The table of sources is written, so that Spark broadcasts it only below its own size threshold.
    """
    targets = stored(source_targets(docs.select("source", "size"), weights, repeat_limit), "mix-targets")
    targets = targets.select(F.col("source").alias("_mixed"), "source_size", "target")
    joined = docs.join(targets, F.col("source").eqNullSafe(F.col("_mixed")), "left").drop("_mixed")
    return joined.withColumn("copies", copies(F.col("target"), F.col("source_size"), F.col(key), seed))


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), repeat_limit: int = 3, seed: str = SEED) -> DataFrame:
    """The documents as often as the mixture takes them; `copy` counts each one's copies from 1."""
    docs = docs.drop("copy")
    names = {n: free(docs, f"_mix_{n}") for n in ("source", "size", "target")}
    sizes = docs.select("source", size_of(F.col("text")).alias("size"))
    targets = stored(source_targets(sizes, weights, repeat_limit), "mix-targets").select(
        *[F.col(a).alias(names[b]) for a, b in (("source", "source"), ("source_size", "size"), ("target", "target"))])
    n = copies(F.col(names["target"]), F.col(names["size"]), F.col("doc_id"), seed)
    joined = docs.join(targets, F.col("source").eqNullSafe(F.col(names["source"])), "left")
    return joined.filter(n > 0).select(*quoted(docs.columns), F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("copy"))
