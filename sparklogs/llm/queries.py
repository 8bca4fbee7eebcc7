"""One query per operator over its whole table, and the same in SQL where SQL can express it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, count_rtree, decontaminate, filter_audit, html_extract, lm_score, mixing, order_minhash, pii, prefix_trie, quality, url_filter, warc
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Fixed values of the query contracts.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
CONTROL = "<|im_end|><|im_start|>assistant ok"


def query(name: str, sql: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op1_decontaminate", rf"""
WITH b AS (SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
f AS (SELECT r, dw.k, i, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM f) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM f) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)""")
def op1_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "leak.*")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op2_html")
def op2_html(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html_extract.extract("html").alias("text"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query("op3_lm_score")
def op3_lm_score(spark, sf_dir):
    return lm_score.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_url_filter")
def op4_url_filter(spark, sf_dir):
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op5_mix", r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS o FROM d GROUP BY source),
s AS (SELECT *, CASE o % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, CAST(3 * source_size AS DOUBLE) AS lim FROM s0),
l AS (SELECT 0 AS step, -1::BIGINT AS capped, (SELECT sum(source_size) / sum(weight) FROM s) AS level
  UNION ALL SELECT step + 1, x.n, x.level FROM (SELECT l.step, l.capped, count(*) FILTER (lim < level * weight) AS n,
    ((SELECT sum(source_size) FROM s) - coalesce(sum(lim) FILTER (lim < level * weight), 0)) / sum(weight) FILTER (lim >= level * weight) AS level
    FROM l, s GROUP BY l.step, l.capped, l.level) x WHERE x.n <> x.capped AND x.level IS NOT NULL),
t AS (SELECT source, source_size, CASE WHEN lim < level * weight THEN lim ELSE level * weight END AS target
  FROM s, (SELECT level FROM l ORDER BY step DESC LIMIT 1)),
r AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r""")
def op5_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    mixed = mixing.with_copies(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def _escaped(column: str) -> str:
    return rf"replace(replace(coalesce({column}, ''), '\', '\\'), '<|', '<\|')"


@query("op6_chat", rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(replace({_escaped('role')}, chr(10), '\n')) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""")
def op6_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], turns.schema)
    return chat.digests(chat.read_back(chat.format_conversations(turns.unionByName(control))))


@query("op7_pii")
def op7_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, count="n_replaced")


@query("op8_near_duplicates")
def op8_near_duplicates(spark, sf_dir):
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


_BASE32 = " || ".join(
    f"substr('{warc.ALPHABET}', 1 + ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31)::INTEGER, 1)" for g in range(8) for s in (15, 10, 5, 0))


@query("op9_warc", f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS n,
  min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN n = 1 OR first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n > 1 THEN first_id END AS refers_to FROM r""")
def op9_warc(spark, sf_dir):
    return warc.archive_and_read(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op10_quality")
def op10_quality(spark, sf_dir):
    measured = quality.measure(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), table(spark, sf_dir, "labels"))
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op11_jaccard_join", rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM u GROUP BY r),
o AS (SELECT a.r AS x, b.r AS y, count(*) AS o FROM u a JOIN u b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
l AS (SELECT x, y FROM o JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * o >= 80 * (a.n + b.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
c AS (SELECT r AS x, r AS y FROM d UNION SELECT c.x, e.y FROM c JOIN e ON e.x = c.y)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(t.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) JOIN c ON c.x = d.r JOIN d t ON t.r = c.y GROUP BY d.r, d.doc_id""")
def op11_jaccard_join(spark, sf_dir):
    return count_rtree.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ord(substr({0}, i::INT, 1))::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


@query("op12_prefix_trie", f"""
WITH t AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
c AS (SELECT *, conv_id - conv_id % 100 AS base, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM t),
b AS (SELECT c.conv_id, list_concat(coalesce(t.own[1:h], []), c.own[h + 1:]) AS w FROM c LEFT JOIN t ON t.conv_id = c.base),
p AS (SELECT conv_id, d, len(w) = d AS is_end, w[1:d] AS pre, coalesce(length(w[d].x), 0) AS last FROM b, (SELECT unnest(range(0, (SELECT max(len(w)) FROM b) + 1)) AS d) WHERE d <= len(w)),
n AS (SELECT pre, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(last) AS last,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256 FROM p GROUP BY pre, d),
k AS (SELECT p.conv_id, p.d, n.conv_id AS id FROM p JOIN n ON p.pre = n.pre AND p.d = n.d),
e AS (SELECT n.*, k.id AS parent FROM n LEFT JOIN k ON k.conv_id = n.conv_id AND k.d = n.d - 1),
g AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM e WHERE parent IS NOT NULL GROUP BY parent, d),
m AS (SELECT e.*, coalesce(n_children, 0) AS n_children FROM e LEFT JOIN g ON g.parent = e.conv_id AND g.d = e.d),
s AS (SELECT k.id, k.d, count(*) FILTER (m.n_children = 0) AS n_leaves, CAST(sum((m.n_convs - 1) * m.last) AS BIGINT) AS saved_tokens
  FROM m JOIN k ON k.conv_id = m.conv_id AND k.d <= m.d GROUP BY k.id, k.d)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, m.parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM m JOIN s ON s.id = m.conv_id AND s.d = m.d""")
def op12_prefix_trie(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.trie(*prefix_trie.rebuilt(turns))


@query("op13_filter_audit", rf"""
WITH d AS (SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS t, {_SPACE_WORDS} AS w FROM documents),
s AS (SELECT doc_id, part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
  100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d),
m AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM s LEFT JOIN m USING (doc_id)),
l AS (SELECT i, substr('ABCDE', i + 1, 1) AS letter FROM range(5) r(i)),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS ids FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
p AS (SELECT filter_order, n AS step, CAST(1 << ids[n] AS INT) AS own, CAST(coalesce(list_sum([1 << x for x in ids[1:n - 1]]), 0) AS INT) AS before
  FROM o, range(1, 6) r(n)),
g AS (SELECT part, filter_order, step, own,
  count(*) FILTER (fails & (own | before) = 0) AS kept, count(*) FILTER (fails & own <> 0 AND fails & before = 0) AS removed,
  count(*) FILTER (fails & own <> 0 AND fails & before <> 0) AS redundant, count(*) FILTER (fails = own) AS unique_fails,
  count(*) FILTER (fails & own <> 0 AND fails & before = 0 AND good) AS good_lost,
  count(*) FILTER (fails & own <> 0 AND fails & before = 0 AND toxic) AS toxic_lost
  FROM f, p GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM g""")
def op13_filter_audit(spark, sf_dir):
    failed = filter_audit.failures(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return filter_audit.audit(failed, table(spark, sf_dir, "labels"))
