"""URL verdicts from rules and, where no rule fits, from a tree of path templates per host.

Rules are (host, path prefix, verdict); one fits its host and all subdomains, and the longest wins. The tree
is built level by level from counts: below a host (and below each template prefix) a path segment that looks
variable (digits, hex, dates) or is rarer than `min_support` becomes the wildcard `*`. Sibling branches whose
labelled bad share does not differ significantly from that of their siblings together (two-proportion z-test)
are merged into one branch `~`. A template is rejected when its bad share, smoothed by `prior_weight` urls at the
overall share, reaches `max_bad`; how many of its urls have no label does not matter.

The labels of the tree are whatever the caller passes; the query uses the verdicts of the rules. A template
without labels has the overall share, and unlabelled branches are not merged into labelled ones.

Nulls and odd rows: a null url or one without `://` has an empty host and path; empty segments are skipped;
every path goes through the tree to its own depth. A path alone in its branch cannot branch further and is settled at once.
Repeated rows are counted each and get equal verdicts. An empty table gives an empty result. Further columns are ignored.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

MIN_SUPPORT, Z, PRIOR_WEIGHT, MAX_BAD = 8, 2.58, 5.0, 0.8
VARIABLE = r"^(?:[0-9][0-9_.-]*(?:\.[A-Za-z0-9]{1,5})?|[0-9a-fA-F-]{8,}(?:\.[A-Za-z0-9]{1,5})?|.*[0-9]{4,}.*)$"
END = "."  # no segment left; a segment of this name is a relative step and means the same


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*(/[^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, from a short list of (verdict, host/path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def segments(path: Column, depth: int | None = None) -> Column:
    """The segments, variable ones as `*`, then END; with `depth` the first `depth` of them, padded with END."""
    parts = F.array_remove(F.split(path, "/", -1), "")
    parts = parts if depth is None else F.slice(parts, F.lit(1), F.lit(depth))
    shown = F.transform(parts, lambda s: F.when(s.rlike(VARIABLE), F.lit("*")).otherwise(s))
    return F.concat(shown, F.array_repeat(F.lit(END), 1 if depth is None else depth - F.size(shown)))


def template_tree(urls: DataFrame, min_support: int = MIN_SUPPORT, z: float = Z,
                  prior_weight: float = PRIOR_WEIGHT, max_bad: float = MAX_BAD) -> tuple[DataFrame, DataFrame]:
    """From (host, segs, bad: true, false or null): the map (host, segs) -> template, and the templates with
    n, labelled, bad, bad_share, rejected.

    Everything works on counts per distinct (host, segs), summed in tasks before the shuffle.
    """
    counts = stored(urls.groupBy("host", "segs").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.count_if("bad").alias("n_bad")), "url-counts")
    columns = ["host", "segs", "template", "n", "labelled", "n_bad"]
    tree = counts.withColumn("template", F.array().cast("array<string>")).select(*columns)
    done, level = [], 0
    while True:
        # What has ended, and what is alone in its branch: all its further branches have this one path.
        done.append(tree.filter(F.size("segs") <= level))
        tree = tree.filter(F.size("segs") > level)
        groups = tree.groupBy("host", "template").agg(F.count("*").alias("paths"), *[F.first(c).alias(c) for c in ("segs", "n", "labelled", "n_bad")])
        alone = stored(groups.filter("paths = 1").drop("paths"), "url-alone")
        rest_segs = F.slice("segs", level + 1, F.size("segs") - level)
        kept = F.transform(rest_segs, lambda s: F.when(s.isin("*", END) | (F.col("n") >= min_support), s).otherwise("*"))
        done.append(alone.withColumn("template", F.concat("template", kept)).select(*columns))
        tree = tree.join(alone.select("host", "segs"), ["host", "segs"], "left_anti")
        if tree.isEmpty():
            break
        seg, key = F.col("segs")[level], ["host", "template", "seg"]
        tree = tree.withColumn("seg", seg)
        branches = tree.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "n_bad")])
        literal = F.col("seg").isin("*", END) | (F.col("n") >= min_support)
        branches = branches.withColumn("kept", F.when(literal, F.col("seg")).otherwise("*"))
        # Rare branches are one wildcard branch before shares are compared.
        merged = branches.groupBy("host", "template", "kept").agg(*[F.sum(c).alias(c) for c in ("labelled", "n_bad")])
        pool = merged.groupBy("host", "template").agg(F.sum("labelled").alias("all"), F.sum("n_bad").alias("all_bad"))
        rest, rest_bad = F.col("all") - F.col("labelled"), F.col("all_bad") - F.col("n_bad")
        share = F.try_divide("all_bad", "all")
        error = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1), F.col("labelled")) + F.try_divide(F.lit(1), rest)))
        gap = F.abs(F.try_divide("n_bad", "labelled") - F.try_divide(rest_bad, rest))
        similar = (F.col("labelled") > 0) & (rest > 0) & (gap <= z * error)
        named = merged.join(pool, ["host", "template"]).select(
            "host", "template", "kept", F.when(similar & (F.col("kept") != END), "~").otherwise(F.col("kept")).alias("branch"))
        step = branches.select(*key, "kept").join(named, ["host", "template", "kept"]).select(*key, "branch")
        tree = tree.join(step, key).withColumn("template", F.concat("template", F.array("branch")))
        # Written per level: each level's counts are read three times.
        tree = stored(tree.select(*columns), "url-tree")
        level += 1
    tree = reduce(DataFrame.unionByName, done)
    labelled, bad = tree.agg(F.sum("labelled"), F.sum("n_bad")).first()
    prior = bad / labelled if labelled else 0.0
    templates = tree.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "n_bad")])
    templates = templates.withColumn("bad_share", (F.col("n_bad") + prior_weight * prior) / (F.col("labelled") + prior_weight))
    templates = templates.withColumn("rejected", (F.col("labelled") > 0) & (F.col("bad_share") >= max_bad))
    return tree.select("host", "segs", "template"), templates


def judge(pages: DataFrame, rules: list[tuple[str, str]], depth: int | None = None, **options) -> DataFrame:
    """page_id, host, path, rule, verdict, template of every row."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"), segments(F.col("path"), depth).alias("segs"))
    places, templates = template_tree(rows.select("host", "segs", (F.col("ruled") == "block").alias("bad")), **options)
    verdicts = stored(places.join(templates.select("host", "template", "rejected"), ["host", "template"]), "url-verdicts")
    judged = rows.join(verdicts, ["host", "segs"], "left")
    own = F.when(F.col("rejected"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "template")
