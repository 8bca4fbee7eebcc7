"""Each operator on small tables: brute force, exact round trips, and nulls, empty and odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklogs.llm import chat, decontaminate, html_extract, lm_score, mixing, order_minhash, pii, quality, url_filter, warc
from sparklogs.llm.common import ordinals

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, texts, **more):
    rows = [(i, t, more.get("lang", "en"), more.get("source", f"s{i % 3}"), len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


ODD = [None, "", " \n\t", "one", "one", "two two two two", "x" * 300_000, "é ü ñ ß"]


# ---- 1 ----

def brute_leaks(text, items, n=10):
    words = re.findall(decontaminate.WORD, (text or "").translate(decontaminate._LOWER))
    hit, found = set(), set()
    for item, content in items:
        own = re.findall(decontaminate.WORD, (content or "").translate(decontaminate._LOWER))
        size = min(n, len(own))
        for w in {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if size else ():
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) == w:
                    hit.update(range(i, i + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_decontaminate(spark, monkeypatch):
    items = [(1, prose(1, 30)), (2, "short item here"), (3, None), (3, "..."), (None, prose(2, 10)), (1, prose(1, 30))]
    texts = ODD + [prose(3, 50) + " " + " ".join(items[0][1].split()[4:19]).upper() + ", " + prose(4, 9), "a SHORT, item here", prose(2, 10), prose(5, 40)]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    wanted = [brute_leaks(t, [("null" if i is None else i, c) for i, c in items]) for t in texts]
    for limit in (1 << 20, 100):  # one block, then several
        monkeypatch.setattr(decontaminate, "INDEX_BYTES", limit)
        found = decontaminate.find_leaks(docs_of(spark, texts), table).orderBy("doc_id").collect()
        assert [(r.leak.n_words, r.leak.n_hit, sorted(r.leak["items"])) for r in found] == wanted
    kept = {r.doc_id for r in decontaminate.decontaminate(docs_of(spark, texts), table).collect()}
    assert kept == {i for i, w in enumerate(wanted) if not w[1]}
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs_of(spark, texts), table, remove="spans").collect()}
    assert cut[9] == "a " and cut[8].startswith(prose(3, 50)) and cut[0] is None and cut[11] == texts[11]
    assert decontaminate.find_leaks(docs_of(spark, []), table).count() == 0
    none = table.filter("false")
    assert decontaminate.decontaminate(docs_of(spark, texts).withColumn("LEAK", F.lit(1)), none).count() == len(texts)


# ---- 2 ----

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><!-- <p>no</p> --><header>Site</header><nav><a href=x>Menu</a></nav>
<div id="wrap"><div class="story"><h1>Head &amp; line</h1><p>First   para, with <b>bold</b>, commas, and <a href="y">a link</a>.<p>Second
one.<ul><li>point<li>next</ul><script>if (a<b) x="</p>"</script><div class="ad-box">Buy, buy, buy, now, please, more.</div></div>
<aside>Side</aside><section id="comments"><p>Great, nice, lovely, long comment, with, commas.</p></section></div>
<form><p>Sign up, now, please, here</p></form><div class="cookie-notice">We use cookies, yes, many.</div><footer>Foot</footer></body></html>"""


def test_html(spark):
    assert html_extract.main_text(PAGE) == "Head & line\nFirst para, with bold, commas, and a link.\nSecond one.\npoint\nnext"
    odd = [None, "", "plain &lt;text&gt;", "<p>unclosed <b>bold", "<script>var a", "<!-- never closed <p>x</p>", "<div><nav><p>only menu</p></nav></div>",
           "<p>" + "word, " * 50_000 + "</p>", "<div>" * 5000 + "deep" + "</div>" * 5000, '<p title="never closed>text</p>']
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(odd)], "page_id bigint, html string")
    out = [r.text for r in frame.select("page_id", html_extract.extract("html").alias("text")).orderBy("page_id").collect()]
    assert out[:7] == ["", "", "plain <text>", "unclosed bold", "", "", ""]
    assert len(out[7]) == len(("word, " * 50_000).strip()) and out[8] == "deep" and out[9] == "text"
    assert frame.filter("false").select(html_extract.extract("html")).count() == 0


@pytest.mark.parametrize("wrapper", ["form", 'div class="page-with-sidebar"', 'div id="nav-open"', 'div class="social-post"',
                                     'div class="trending-story"', 'section class="comment-on-law article"'])
def test_html_keeps_wrapped_articles(wrapper):
    inner = ("<h1>Head</h1><p>First words of a text, with commas, that goes on for a while.</p><div class='social share'>Tell all</div>"
             "<p>Second paragraph, as long as the first one or a little longer than that.</p>")
    page = f"<body><p>Site title</p><{wrapper}>{inner}</{wrapper.split()[0]}><div class='comments'><p>{'Nice one, thanks. ' * 40}</p></div></body>"
    got = html_extract.main_text(page)
    assert "First words" in got and "Second paragraph" in got and "Head" in got
    assert "Tell all" not in got and "Nice one" not in got


def test_html_titles_and_topics():
    page = ("<body><header><p>The site, its motto, and more</p></header><article><header><h1>Title</h1></header><p class='related'>A related matter, told at "
            "some length, with commas.</p><p>More of it, in full, and to the end.</p><p class='ad'>Buy now, cheap, today.</p></article></body>")
    assert html_extract.main_text(page) == "Title\nA related matter, told at some length, with commas.\nMore of it, in full, and to the end."


def test_html_wrapped():
    body = "<h1>Head</h1><p>First, with commas, and words.</p><p>Second one.</p>"
    for wrapper in ("form", 'div class="page-with-sidebar"', 'div class="layout-sidebar-right"', 'div id="nav-open"'):
        page = f"<html><body><{wrapper}><nav><a href=x>menu</a></nav>{body}</{wrapper.split()[0]}></body></html>"
        assert html_extract.main_text(page) == "Head\nFirst, with commas, and words.\nSecond one."
    assert html_extract.main_text('<div class="menu"><a href=x>one</a> <a href=y>two</a></div>') == ""
    listed = f"<article>{body}<ul><li><a href=x>A reference</a></li></ul></article>"
    assert html_extract.main_text(listed).endswith("Second one.\nA reference")


# ---- 3 ----

def test_lm_base_and_score(spark):
    texts = [prose(i % 7, 30 + i) + " The THE the" for i in range(60)] + ODD
    rows = {r.doc_id: r for r in lm_score.score_documents(docs_of(spark, texts)).collect()}
    import zlib
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) + [None] for i, t in enumerate(texts)}
    counts = Counter(w for i in own if not held[i] for w in own[i])
    pairs = Counter(p for i in own if not held[i] for p in zip([None] + own[i][:-1], own[i]))
    total, distinct = sum(counts.values()), len(counts)

    def level(count):
        return float(lm_score.count_of(lm_score.level_of(np.array([count])) * (count > 0))[0])

    # Probabilities sum to one with exact counts, and to one up to the rounding of levels with theirs.
    for exact, slack in ((float, 1e-9), (level, 0.25)):
        for b in [None, "the", "unseen", *list(counts)[:20]]:
            every = np.array([(pairs[b, w], counts[b], counts[w]) for w in [*counts, "unknown"]])
            values = np.array([[exact(v) for v in row] for row in every.tolist()])
            assert lm_score.probability(*values.T, total, distinct).sum() == pytest.approx(1, abs=slack)
    for i, tokens in own.items():
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        assert rows[i].held_out == held[i] and rows[i].n_tokens == len(tokens) and rows[i].train_tokens == total
        assert rows[i].n_known == sum(counts[w] > 0 for w in tokens)
        assert rows[i].base_score == pytest.approx(base)
        # The score by its definition, on quantised counts.
        before = [None] + tokens[:-1]
        logs = [math.log10(lm_score.probability(*(np.float64(v) for v in (min(level(pairs[b, w]), level(counts[b]), level(counts[w])),
                                                level(counts[b]), level(counts[w]))), total, distinct)) for b, w in zip(before, tokens)]
        assert rows[i].score == pytest.approx(sum(logs))
    assert lm_score.score_documents(docs_of(spark, texts[:3]).filter("false")).count() == 0


def test_lm_keeps_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "PART_TOKENS", 100)
    import zlib
    texts = [prose(1000 + i, 40) for i in range(60)]
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    seen = next(i for i in range(60) if i not in held)
    texts[held[0]], texts[held[1]] = texts[seen], " ".join(texts[seen].split()[::-1])
    rows = {r.doc_id: r for r in lm_score.score_documents(docs_of(spark, texts)).collect()}
    # Pairs seen once count: the text in its order is likelier than the same words backwards.
    assert rows[held[0]].score == pytest.approx(rows[seen].score)
    assert rows[held[0]].score > rows[held[1]].score + 10
    # Neither the size of parts nor that of shards changes a score.
    monkeypatch.setattr(lm_score, "PART_TOKENS", 7)
    monkeypatch.setattr(lm_score, "SHARD_GRAMS", 500)
    again = {r.doc_id: r.score for r in lm_score.score_documents(docs_of(spark, texts)).collect()}
    assert again == pytest.approx({i: r.score for i, r in rows.items()})


def test_bloom_levels():
    grams = np.arange(1, 40_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.random.default_rng(1).zipf(1.6, 20_000).clip(1, 10**6)
    levels = lm_score.level_of(counts)
    blocks = int(-(-levels.sum() * lm_score.BITS_PER_ENTRY // lm_score.BLOCK_BITS))
    made = lm_score.Filter(blocks)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(grams[:20_000].view(np.int64)), pa.array(counts)], ["gram", "n"])
    for out in lm_score._fill(blocks)([batch]):
        made.bits[out.column(0)[0].as_py()] |= np.frombuffer(out.column(1)[0].as_py(), np.uint8)
    seen = made.levels(grams)
    assert (seen[:20_000] >= levels).all() and (seen[:20_000] == levels).mean() > 0.97
    assert (seen[20_000:] == 0).mean() > 0.97  # never inserted
    middle = lm_score.count_of(levels)
    assert (np.abs(middle - counts) <= 0.5 * counts + 1).all()


# ---- 4 ----

def test_url_filter(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "bad.net/x/")]
    urls = [None, "", "nothing", "http://EXAMPLE.com/en/1?q#f", "https://www.example.com/en/1", "http://a.example.com/de/", "http://myexample.com/en/",
            "http://example.com", "ftp://x:80?y=/z", "http://bad.net/x/1", "http://bad.net/y/1"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(100 + i, f"http://bad.net/x/{i}") for i in range(40)]
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string"), rules).collect()}
    assert out[0] == out[1] == out[2] == ("", "", None, "allow")
    assert out[3] == ("example.com", "/en/1", "example.com/en/", "block") and out[4][2:] == ("www.example.com/en/", "allow")
    assert out[5][2] == "com/" and out[6][2] == "com/" and out[7] == ("example.com", "", None, "allow")
    assert out[8][:2] == ("x:80", "") and out[9][3] == "block" and len(out) == len(rows)
    # Most of the host is labelled bad, but the other branch is not merged with it for want of labels.
    assert out[10][2:] == (None, "allow")
    labelled = [("h", f"/spam/{i}", True) for i in range(30)] + [("h", f"/junk/{i}", True) for i in range(30)] + [("h", f"/good/{i}", False) for i in range(60)]
    frame = spark.createDataFrame(labelled, "host string, path string, bad boolean")
    _, templates = url_filter.template_tree(frame.select("host", url_filter.segments(F.col("path"), 3).alias("segs"), "bad"))
    assert {r.template[0]: r.rejected for r in templates.collect()}["good"] is False
    assert any(r.rejected for r in templates.collect())
    assert url_filter.judge(spark.createDataFrame([], "page_id bigint, url string"), rules).count() == 0


def test_url_few_labels(spark):
    rows = [("h", f"/a/{i}", True if i < 40 else None) for i in range(100)] + [("h", f"/b/{i}", False if i < 40 else None) for i in range(100)]
    frame = spark.createDataFrame(rows, "host string, path string, bad boolean")
    _, templates = url_filter.template_tree(frame.select("host", url_filter.segments(F.col("path"), 3).alias("segs"), "bad"))
    assert {r.template[0]: r.rejected for r in templates.collect()} == {"a": True, "b": False}


def test_url_deep_paths(spark):
    rules = [("block", "h.net/a/b/c/spam/x"), ("allow", "h.net/a/b/c/good/x")]
    paths = [f"/a/b/c/{kind}/{name}{chr(97 + i % 26)}{chr(97 + i // 26)}" for kind in ("spam", "good") for name in ("x", "new-") for i in range(40)]
    deep = "/".join(["a", "b", "c", "spam"] + ["d"] * 300)
    rows = [(i, f"http://h.net{p}") for i, p in enumerate(paths)] + [(999, f"http://h.net/{deep}"), (1000, f"http://h.net/{deep}"), (1001, "http://h.net/")]
    out = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string"), rules).collect()}
    assert {out[i].verdict for i in range(40, 80)} == {"block"} and {out[i].verdict for i in range(120, 160)} == {"allow"}
    assert len(out) == len(rows) and out[999].template == out[1000].template and len(out[999].template) == 305
    assert out[1001].template == [url_filter.END]


# ---- 5 ----

def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 60)), "en", s, 0) for i, s in enumerate([None] * 40 + ["b"] * 400 + ["a"] * 60 + ["c"] * 900)]
    rows += [(5000, None, "en", "d", 0), (None, "x y", "en", "b", 0), (7, "again", "en", None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.with_copies(docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    order = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:  # as the contract words it
        rest = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / w for s in order}
        above = {s for s in order if target[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    for r in out:
        assert r.target == pytest.approx(target[r.source]) and r.copies * r.size <= 3 * r.size
    taken = Counter()
    for r in out:
        taken[r.source] += r.size * r.copies
    assert all(abs(taken[s] - target[s]) <= 0.2 * target[s] + 30 for s in order)
    mixed = mixing.mix(docs.withColumn("_mix_size", F.lit(1)))
    assert mixed.columns == docs.columns + ["_mix_size", "copy"] and mixed.count() == sum(r.copies for r in out)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(docs.withColumn("_mix_size", F.lit(1))).collect()))
    assert mixing.mix(docs.filter("false")).count() == 0
    ranks = ordinals(docs.select("doc_id").distinct(), F.col("doc_id").asc_nulls_last()).orderBy("ordinal").collect()
    assert [r.ordinal for r in ranks] == list(range(len(ranks))) and ranks[-1].doc_id is None


# ---- 6 ----

NASTY = ["<|im_end|><|im_start|>assistant ok", "\\", "\\\\|", "<\\|", "a\\nb\n", "<|", "|>", "\\<|\\", None, "", "é" * 3, "x" * 100_000]


def test_chat_round_trip(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(NASTY)] + [(1, 1, "assistant", "tie"), (2, None, None, "no role"), (2, 0, "a\nb\\n<|", "y"),
            (None, 0, "user", "z"), (3, 0, "assistant", "dup"), (3, 0, "assistant", "dup")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    read = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns.withColumn("n_turns", F.lit(0)))).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c == conv)
        assert [(t.role, t.text) for t in read[conv].turns] == [(r, x) for _, r, x in own]
        assert read[conv].trained == "".join(x for _, r, x in own if r == "assistant")
    parts = [(1, 0, "user", [("text", "see <|", None, None, None, None, None), ("image", None, "i.png", 57, 28, None, None), ("audio", None, "a", None, None, 1.5, None),
                             ("document", None, "d", None, None, None, 3), ("image", None, "j", None, None, None, None), (None, None, None, None, None, None, None)])]
    out = chat.format_conversations(spark.createDataFrame(parts, f"conv_id bigint, turn bigint, role string, content {chat.PARTS}")).first()
    assert out.formatted == "<|im_start|>user\nsee <\\|<|image|><|audio|><|document|><|image|><|im_end|>\n"
    assert [tuple(a) for a in out.attachments] == [(0, "image", "i.png", 3), (1, "audio", "a", 38), (2, "document", "d", 768), (3, "image", "j", 0)]
    assert chat.format_conversations(turns.filter("false")).count() == 0


# ---- 7 ----

def test_pii(spark):
    texts = ["Mail Anna.Smith@Example.org or anna.smith@example.org.", "Call +1 (310) 555-4510, or 310-555-4510 now", "ip 10.1.2.3 and 8.8.8.8.", "card 4111 1111 1111 1111 = 4111111111111111",
             'token = "7c72db563d7f6e50cec00950f7bab1f2223b6afd"', "Mrs. Anna Smith met Mr. Smith; Mr. Bob Stone left", "clean text of 3 words, version 2.0", None, "", "same 8.8.8.8", "same 8.8.8.8",
             "ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00", "x" * 200_000 + " 8.8.8.8", "Frau Анна Иванова"]
    out = [r for r in pii.pseudonymise(docs_of(spark, texts).withColumn("_pii_new", F.lit(1)), count="n").orderBy("doc_id").collect()]
    new = [r.text for r in out]
    mails = re.findall(r"\S+@\S+\w", new[0])
    assert mails[0].lower() == mails[1] and not mails[1].startswith("anna") and mails[1].endswith(".org")
    a, b = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\d{3}-\d{3}-\d{4}", new[1])
    assert re.sub(r"\D", "", a)[1:] == re.sub(r"\D", "", b) and "4510" not in new[1]
    assert re.search(r"ip 10\.\d+\.\d+\.\d+ and ", new[2]) and "8.8.8.8" not in new[2]
    c, d = new[3].removeprefix("card ").split(" = ")
    digits = [int(x) for x in d][::-1]
    assert c.replace(" ", "") == d and sum(digits[::2]) % 10 == -sum(sum(divmod(2 * x, 10)) for x in digits[1::2]) % 10 and d != "4111111111111111"
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', new[4]) and new[4] != texts[4]
    m = re.fullmatch(r"Mrs\. (\w+) (\w+) met Mr\. (\w+); Mr\. (\w+) (\w+) left", new[5])
    assert m and m[2] == m[3] and m[2] != m[5] and m[1].endswith("na") and "Smith" not in new[5]
    assert new[6:9] == texts[6:9] and new[9] == new[10] != texts[9] and [r.n for r in out[6:9]] == [0, 0, 0]
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4} iban DE\d\d( \d{4}){4} \d\d", new[11]) and new[11] != texts[11]
    assert new[12].startswith("x" * 200_000) and new[12].split()[1] == new[9].split()[1]
    assert re.fullmatch(r"Frau [А-Яа-я]+ [А-Яа-я]+", new[13]) and new[13] != texts[13]
    assert pii.pseudonymise(docs_of(spark, texts).filter("false")).count() == 0


def test_pii_distinct(spark):
    values = spark.range(250).select(F.lit("ssn").alias("kind"), F.lpad(F.col("id").cast("string"), 3, "0").alias("canon"))
    rows = pii.assign(values).collect()  # 1,000 possible surrogates, 250 taken by real values
    got = {r.surrogate for r in rows}
    assert len(rows) == len(got) == 250 and not got & {r.canon for r in rows}


# ---- 8 ----

def brute_classes(texts):
    words = [None if t is None else t.lower().split() for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for i, a in enumerate(words):
        for j in range(i):
            b = words[j]
            if a is not None and b is not None and find(i) != find(j) and (
                    a == b or max(len(a), len(b)) and max(len(a), len(b)) - sum((Counter(a) & Counter(b)).values()) <= 0.2 * max(len(a), len(b))
                    and edits(a, b) <= 0.2 * max(len(a), len(b))):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def edited(text, every, seed):
    rng, words = random.Random(seed), text.split()
    for i in range(rng.randrange(every), len(words), every):
        words[i] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates(spark):
    base = [prose(i, 150) for i in range(8)]
    texts = base + [edited(b, 60, i) for i, b in enumerate(base)] + [base[0], base[1]] * 10
    texts += [edited(base[2], 40, 100 + i) for i in range(40)]  # a group of near copies
    passage = prose(99, 60)
    texts += [prose(200 + i, 90) + " " + passage for i in range(30)]  # a passage in common is not enough
    texts += [None, None, "", "", "one two", "one two", "one three", "é " * 4000]
    docs = docs_of(spark, texts)
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs.withColumn("class_id", F.lit(9))).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)
    kept = order_minhash.deduplicate(docs.unionAll(docs.filter("doc_id in (0, 5)")).withColumn("_node", F.lit("x")))
    assert kept.columns == docs.columns + ["_node"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))
    assert order_minhash.near_duplicates(docs.filter("false")).count() == 0 == order_minhash.deduplicate(docs.filter("false")).count()


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(150):
        a = np.array([rng.randrange(4) for _ in range(rng.randrange(1, 40))], np.uint64)
        b = a.tolist()
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = [rng.randrange(4)] * rng.randrange(2)
        b = np.array(b, np.uint64)
        row = list(range(len(b) + 1))
        for i, x in enumerate(a.tolist(), 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b.tolist(), 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        assert order_minhash.edit_distance(a, b, 60) == row[-1]
        assert order_minhash.within(a, b) == (row[-1] <= int(0.2 * max(len(a), len(b)) + 1e-9))
        assert order_minhash._anchored(a, b, 60) >= row[-1]


def test_overlap_with_own_blocks(spark):
    # Overlap from 0.80 to 0.82 with an own head on one side and an own foot on the other: up to 2/9 of the words are edits.
    shared, texts = prose(90, 804).split(), []
    for i, own in enumerate((100, 95, 89)):
        words = [f"s{i}{w}" for w in shared]
        texts += [" ".join([*(f"h{i}x{k}" for k in range(own)), *words]), " ".join([*words, *(f"f{i}x{k}" for k in range(own))])]
        a, b = (order_minhash.word_numbers(t, order_minhash._Numbers()) for t in texts[-2:])
        assert 0.8 <= order_minhash.ordered_overlap(a, b) < 0.825 and order_minhash.within(a, b) and order_minhash.within(b, a)
    a, b = np.arange(904, dtype=np.uint64), np.arange(110, 1014, dtype=np.uint64)
    assert order_minhash.ordered_overlap(a, b) < 0.8 and not order_minhash.within(a, b)
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(6)] == [0, 0, 2, 2, 4, 4]


# ---- 9 ----

def test_warc(spark):
    fake = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(3, "http://a/ b\n", "same"), (1, "u1", "same"), (2, None, fake), (5, "u5", None), (4, "u4", ""), (6, "u6", "ü" * 100_000), (7, "u7", "twice"), (7, "u7", "twice"),
            (None, "n", "same"), (None, "n", "lone")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = warc.archive_and_read(pages.withColumn("copy", F.lit(1))).collect()
    assert len(out) == len(rows)
    import base64
    for r in out:
        if r.page_id not in (None, 7):
            html = next(h for p, _, h in rows if p == r.page_id) or ""
            assert r.payload_bytes == len(html.encode()) and r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in out) == Counter([
        (1, "response", None), (2, "response", None), (3, "revisit", 1), (4, "response", None), (5, "revisit", 4), (6, "response", None),
        (7, "response", None), (7, "revisit", 7), (None, "revisit", 1), (None, "response", None)])
    assert {r.record_type for r in warc.archive_and_read(pages, min_bytes=10**6).collect()} == {"response"}
    assert warc.archive_and_read(pages.filter("false")).count() == 0


# ---- 10 ----

def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_base(spark):
    rng = random.Random(4)
    texts = ODD + [" ".join(rng.choice("abc") for _ in range(n)) for n in (2, 3, 4, 5, 60)] + ["a b\n\na b\n \t\na b \nx#|<" * 5, prose(1, 300), "a b c " * 50]
    rows = quality.measure(docs_of(spark, texts), spark.createDataFrame([], "doc_id bigint, quality int")).orderBy("doc_id").collect()
    for r, text in zip(rows, texts):
        base = brute_base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base, text and text[:50]
        assert r.base_failed == (base[0] < 50 or 2 * base[4] > base[0]) and r.kept == (not r.base_failed)


def test_quality_cutoffs(spark):
    good, bad = [prose(i, 60) for i in range(1300)], [" ".join(w + "###" for w in prose(5000 + i, 60).split()) for i in range(100)]
    docs = docs_of(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 1300)) for i in range(1400)] + [(None, 1), (9999, 0), (3, None)], "doc_id bigint, quality int")
    kept = {r.doc_id: r.kept for r in quality.measure(docs, labels).collect()}
    assert sum(kept[i] for i in range(1300)) >= 1274 and not any(kept[i] for i in range(1300, 1400))
    left = quality.filter_quality(docs.withColumn("kept", F.lit("x")), labels)
    assert left.columns == docs.columns + ["kept"] and {r.doc_id for r in left.collect()} == {i for i in kept if kept[i]}
    # Too few labels for the bound: nothing but the base rules rejects.
    assert all(r.kept for r in quality.measure(docs, labels.filter("doc_id < 700")).collect())
    assert quality.filter_quality(docs.filter("false"), labels).count() == 0


def test_binomial_tail(spark):
    cases = [(n, k, p) for n in (1, 10, 300, 5000) for k in (0, 1, 3, n // 200) for p in (0.004, 0.02) if k < n * p] + [(10**6, 3800, 0.004), (10**6, 0, 0.02)]
    for n, k, p in cases:
        got = spark.range(1).select(quality.binomial_tail(F.lit(n), F.lit(k), p)).first()[0]
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p) for i in range(k + 1)]
        assert got == pytest.approx(math.fsum(math.exp(x) for x in logs), rel=1e-6, abs=1e-300)
