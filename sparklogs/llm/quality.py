"""Quality rules with risk-controlled cutoffs.

Each rule says: reject a document whose feature is above a cutoff. For every stratum (language) and feature
the cutoffs of a fixed grid are tested on a labelled holdout: a cutoff passes if, were its true rate of
falsely rejected good documents as high as allowed, so few false rejections among the n good documents would
be seen with probability `delta / (strata * features)` at most. That is the exact binomial (Clopper-Pearson)
bound with Bonferroni's correction over strata and features; along the grid the tests form a fixed sequence from
the highest cutoff down (a lower cutoff rejects more), which needs none. The lowest passing cutoff is taken. The allowed
rate `alpha` is shared evenly among the features, so with probability 1 - delta no stratum falsely rejects
more than alpha of its good documents. A stratum with too few labels gets no cutoffs and rejects nothing.

Two base rules come first: fewer than 50 words, or over half of the words in repeated 3-word windows. Their
rejections are not part of the risk statement; the holdout is made of labelled documents that pass them.

Nulls and odd rows: a null text has no words, so it fails the base rules; a null stratum is a stratum of its own; null labels
and labels without a document are ignored; of several labels of a document each counts. Repeated rows get equal verdicts.
Empty tables give empty results; without labels only the base rules reject. In
`filter_quality`, all columns of the input are kept and nothing is added.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import settled
from .common import BLANKS, free, quoted, stored, words

# Fixed values of the query contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

GRID = 64
# Highest cutoff of each feature's grid; the grid divides it evenly.
FEATURES = {
    "symbols_per_word": 2.0, "repeat_share": 0.5, "dup_line_share": 1.0, "chars_per_word": 32.0, "upper_share": 1.0,
}
ALPHA, DELTA = 0.02, 0.05
#: A table of cutoffs up to so many rows (a few dozen bytes each) is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 100_000
#: Labels (12 bytes each) up to so many rows are broadcast to the texts; beyond it the measured numbers are joined.
LABEL_ROWS = 500_000


def removed(text: Column, characters: str) -> Column:
    """How many characters of the text are in the set."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def with_base(frame: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """`keep` plus n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_upper, n_repeat_words (all long).

    Each step is its own projection behind a one-row generator, so nothing is evaluated twice. The windows of
    three words are hashed to 64 bits and sorted with their places; equal neighbours are repeats, and each
    repeat covers three words or as many as lie before the next one.
    """
    kept = quoted(keep)
    t = F.coalesce(text, F.lit(""))
    lines = F.array_remove(F.split(t, "\n", -1), "")
    frame = frame.select(*kept, settled(t.alias("_t"), words(t).alias("_w"), F.filter(
        lines, lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0).alias("_l")))
    n = F.size("_w")
    windows = F.arrays_zip(*[F.slice("_w", F.lit(i + 1), F.greatest(n - 2, F.lit(0))).alias(f"w{i}") for i in range(3)])
    hashes = F.transform(windows, lambda x: F.xxhash64(x))
    frame = frame.select(*kept, "_t", "_l", settled(
        n.cast("bigint").alias("n_words"), hashes.alias("_h"),
        (F.length("_t") - removed(F.col("_t"), BLANKS)).cast("bigint").alias("word_chars")))
    places = F.sequence(F.lit(0), F.size("_h") - 1)
    pairs = F.when(F.size(F.array_distinct("_h")) < F.size("_h"),
                   F.sort_array(F.arrays_zip(F.col("_h").alias("h"), places.alias("p"))))
    frame = frame.select(*kept, "_t", "n_words", "word_chars", settled(
        pairs.alias("_s"), F.size("_l").cast("bigint").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        removed(F.col("_t"), SYMBOLS).cast("bigint").alias("n_symbols"),
        removed(F.col("_t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("bigint").alias("n_upper")))
    h, one = F.col("_s.h"), F.array(F.lit(None).cast("bigint"))
    last = F.size("_s") - 1
    neighbours = F.arrays_zip(h.alias("h"), F.col("_s.p").alias("p"), F.concat(one, F.slice(h, F.lit(1), last)).alias("a"),
                              F.concat(F.slice(h, F.lit(2), last), one).alias("b"))
    repeats = F.sort_array(F.transform(F.filter(neighbours, lambda x: F.coalesce(x["h"] == x["a"], F.lit(False))
                                                | F.coalesce(x["h"] == x["b"], F.lit(False))), lambda x: x["p"]))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_upper"]
    frame = frame.select(*kept, *base, settled(F.when(F.col("_s").isNotNull(), repeats).alias("_r")))
    steps = F.arrays_zip(F.col("_r").alias("p"), F.slice("_r", F.lit(2), F.size("_r")).alias("q"))
    covered = F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + F.least(F.lit(3), F.coalesce(x["q"] - x["p"], F.lit(3))))
    return frame.select(*kept, *base, settled(F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words")))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def feature_values() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / n, "repeat_share": F.col("n_repeat_words") / n,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "chars_per_word": F.col("word_chars") / n,
        "upper_share": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
    }


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series at x + 8."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5)))
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    return series - F.log(product)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p): the term at k times the falling series of the ratios below it.

    From the mean on the result is not small, and 1 is returned, which no test passes. Below it the terms fall; beyond ten
    standard deviations and a hundred terms what is left is under 1e-16 of the sum.
    """
    n, k = n.cast("double"), k.cast("double")
    term = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    terms = F.least(k, F.ceil(10 * F.sqrt(n * p)) + 100).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(state: Column, i: Column) -> Column:
        ratio = (k - i + 1) * (1 - p) / ((n - k + i) * p)
        return F.struct((state["term"] * ratio).alias("term"), (state["sum"] + state["term"] * ratio).alias("sum"))

    series = F.when(terms > 0, F.aggregate(F.sequence(F.lit(1), terms), start, step)["sum"]).otherwise(1.0)
    return F.when(k >= n * p, 1.0).otherwise(F.least(F.lit(1.0), term * series))


def fit_cutoffs(measured: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum, one cutoff column per feature (null: no cutoff), from rows (stratum, quality, base columns).

    Per stratum, feature and grid cell one count of good documents, summed in tasks before the shuffle; the
    number falsely rejected by a cutoff is the sum over the cells above it.
    """
    values = feature_values()
    good = measured.filter((F.col("quality") == 1) & ~base_failed())
    cells = F.array(*[F.struct(F.lit(name).alias("feature"), F.least(F.floor(values[name] / (top / GRID)), F.lit(GRID)).cast("int").alias("cell"))
                      for name, top in FEATURES.items()])
    counts = good.select("stratum", F.inline(cells)).groupBy("stratum", "feature", "cell").agg(F.count("*").alias("n"))
    counts = stored(counts, "quality-counts")
    # A document in the cell of cutoff j (lower edge j * top / GRID) may be above it, so it counts as rejected.
    by_feature = counts.groupBy("stratum", "feature").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("cells"))
    above = F.transform(F.sequence(F.lit(0), F.lit(GRID - 1)), lambda j: F.aggregate(
        F.map_entries("cells"), F.lit(0).cast("bigint"), lambda a, e: a + F.when(e["key"] >= j, e["value"]).otherwise(0)))
    by_feature = by_feature.select("stratum", "feature", "total", F.posexplode(above).alias("cell", "rejected"))
    strata = max(1, counts.select("stratum").distinct().count())
    share = alpha / len(FEATURES)
    passed = binomial_tail(F.col("total"), F.col("rejected"), share) <= delta / (strata * len(FEATURES))
    lowest = by_feature.groupBy("stratum", "feature").agg(F.min(F.when(passed, F.col("cell"))).alias("cell"))
    return lowest.groupBy("stratum").agg(*[
        F.max(F.when(F.col("feature") == name, F.col("cell") * (top / GRID))).alias(f"max_{name}") for name, top in FEATURES.items()])


def labelled(docs: DataFrame, labels: DataFrame, stratum: str) -> DataFrame:
    """stratum, quality and the base columns of the documents that have a label.

    Texts are never shuffled: few labels are broadcast and only labelled texts are measured; otherwise all are, and their
    numbers are joined.
    """
    marks = stored(labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select("doc_id", "quality"), "quality-marks")
    rows = docs.select("doc_id", F.col(f"`{stratum}`").cast("string").alias("stratum"), "text")
    if marks.count() <= LABEL_ROWS:
        return with_base(rows.join(F.broadcast(marks), "doc_id"), F.col("text"), ["stratum", "quality"])
    return stored(with_base(rows, F.col("text"), ["doc_id", "stratum"]), "quality-base").join(marks, "doc_id").drop("doc_id")


def judged(frame: DataFrame, cutoffs: DataFrame, stratum: Column) -> DataFrame:
    """Add `base_failed` and `kept` to a frame with the base columns."""
    limits = stored(cutoffs, "quality-cutoffs").withColumnRenamed("stratum", "_stratum")
    if limits.count() <= BROADCAST_ROWS:
        limits = F.broadcast(limits)
    frame = frame.withColumn("_own_stratum", stratum.cast("string"))
    joined = frame.join(limits, F.col("_own_stratum").eqNullSafe(F.col("_stratum")), "left").drop("_stratum", "_own_stratum")
    values = feature_values()
    broken = F.lit(False)
    for name in FEATURES:
        broken = broken | F.coalesce(values[name] > F.col(f"max_{name}"), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & ~broken)


def measure(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, base columns, base_failed and kept of every document. Texts are read once."""
    own = docs.select("doc_id", F.col(f"`{stratum}`").cast("string").alias("stratum"), "text")
    base = stored(with_base(own, F.col("text"), ["doc_id", "stratum"]), "quality-base")
    marks = labels.filter(F.col("quality").isNotNull()).select("doc_id", "quality")
    return judged(base, fit_cutoffs(base.join(marks, "doc_id")), F.col("stratum"))


def filter_quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that pass the base rules and the cutoffs fitted on the labelled ones among them."""
    cutoffs = fit_cutoffs(labelled(docs, labels, stratum))
    row = free(docs, "_row")
    packed = docs.select(F.struct(*quoted(docs.columns)).alias(row))
    base = with_base(packed, F.col(f"{row}.text"), [row])
    kept = judged(base, cutoffs, F.col(f"{row}.`{stratum}`")).filter("kept")
    return kept.select(*[F.col(row)[c].alias(c) for c in docs.columns])
