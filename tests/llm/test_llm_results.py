"""Operators against SQL, other libraries and brute force."""

import base64
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import tiktoken
from conftest import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from quarry.llm import bpe, components, html_extract, minhash, mixing, quality_classifier, secrets, suffixes, textstats, token_files, vptree
from quarry.llm.queries import SQL, W
from quarry.session import scratch_path

duckdb = pytest.importorskip("duckdb")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark, name, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    from quarry.sources.tables import TABLES
    from tools.oracle_check import digest
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = W[name](spark, SF_SMALL)
    rel = con.sql(SQL[name])
    expected = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, expected)[0]


def test_repeated_words_by_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(150)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    for r in rows.select("t", textstats.repeated_words(textstats.words(F.col("t"))).alias("n")).collect():
        w = r.t.split()
        where = {}
        for i in range(len(w) - 7):
            where.setdefault(tuple(w[i:i + 8]), []).append(i)
        assert r.n == len({i + k for v in where.values() if len(v) > 1 for i in v for k in range(8)})


# ---------------------------------------------------------------- pages

PAGE = """<html><head><title>no</title><style>p{}</style></head><body class="home page">
<div id="cookie-notice"><p>We use cookies on this site, please accept all of them now.</p></div>
<header><a href="/">Home</a></header><div class="menu"><a href="a">Sport</a> <a href="b">News</a></div>
<div class="post-content"><h1>Big &amp; new</h1><p>It was a long&nbsp;day for
 everybody in the town, said the &eacute;lu.<br>So it&#8217;s over.</p><p>Short one.<div class="ad">Buy now, it is very cheap today!</div>
<ul><li>The first point of the list is here.<li>The second one as well.</ul><table><tr><td>A cell of the table.<td>Another cell.</table></div>
<aside><p>Another story that you may like to read, it is good.</p></aside><section class="comments"><p>I really liked this, thank you very much.</p></section>
<form><p>Send us your name, please, and the form will be sent.</p></form><footer>&copy; 2024 Us</footer><script>var a = "<p>no</p>";</script>"""


def test_main_text_of_a_page():
    assert html_extract.main_text(PAGE)[0].split("\n\n") == [
        "Big & new", "It was a long day for everybody in the town, said the élu. So it’s over.", "Short one.",
        "The first point of the list is here.", "The second one as well.", "A cell of the table.", "Another cell."]


@pytest.mark.parametrize("attribute", [
    'href="/the-hidden-valley"', 'title="hidden gems"', 'aria-label="hidden costs"', "data-hidden='no'", "data-style='display:none'", 'data-id="footer"',
    'title="class=footer id=menu role=navigation"', 'aria-hidden="false"', "data-class=sidebar", 'alt="a > b hidden"', 'title="style=\'display:none\'"'])
def test_other_attributes_are_no_marks(attribute):
    text = "The river runs to the sea, and all of the town was there."
    assert html_extract.main_text(f"<article {attribute}><p>{text}</p></article>")[0] == text
    assert html_extract.main_text(f"<article><p>The <a {attribute}>river</a> runs to the sea, and all of the town was there.</p></article>")[0] == text


@pytest.mark.parametrize("attribute", ["hidden", "HIDDEN=''", "a=b hidden", 'x="y"hidden', "aria-hidden = true", "style='color:red; display : none'", "class='a' hidden/"])
def test_hidden_elements_are_skipped(attribute):
    assert html_extract.main_text(f"<article><div {attribute} ><p>The river runs to the sea, and all of it.</p></div></article>")[0] == ""


PROSE = ("The river of the valley is long and it runs to the sea.", "All of the town went out to see the boats that are on it, and so did we.")


def article(attribute, tag="div", around="", inside=""):
    page = f"<body><nav><a href=a>Home</a></nav><{tag} {attribute}>{inside}<p>{PROSE[0]}</p><p>{PROSE[1]}</p></{tag}><footer>Us</footer>"
    return html_extract.main_text(f"<div class='{around}'>{page}</div>")[0]


@pytest.mark.parametrize("names", [
    "content has-sidebar", "main no-sidebar", "post-12 hentry tag-search", "article-with-comments", "layout-side-by-side", "post category-legal menu-open",
    "content with-widget", "search-engines-explained", "entry format-aside comments-open", "page--with-footer", "sidebar-layout", "navy"])
@pytest.mark.parametrize("tag", ["div", "article", "main", "section"])
def test_modifier_classes_are_no_verdict(names, tag):
    assert article(f'class="{names}"', tag) == "\n\n".join(PROSE)
    assert article("", "article", around=names) == article("", "main", around=names) == "\n\n".join(PROSE)


@pytest.mark.parametrize("names", ["sidebar", "content-sidebar", "site-footer", "comments-area", "comment-body", "ad", "cookie-notice", "main-nav", "related-posts",
                                   "share-buttons", "ad--large", "search", "search-box", "post-comments", "widget text", "newsletter_signup"])
def test_boilerplate_classes_still_count(names):
    assert article(f'class="{names}"') == article(f'id="{names.split()[0]}"') == ""
    assert article("", "article", inside=f'<div class="{names}"><p>I liked this, thank you very much for it.</p></div>') == "\n\n".join(PROSE)


def test_nested_article_or_main_begins_anew():
    for names in ("sidebar", "content search", "widget-area"):
        assert article("", "article", around=names) == article("", "main", around=names) == article("role=main", around=names) == "\n\n".join(PROSE)
    assert html_extract.main_text(f"<aside><article><p>{PROSE[0]}</p></article></aside>")[0] == ""


@pytest.mark.parametrize("around", ['<section id="comments">{}</section>', '<div class="responses">{}</div>', '<div class="response">{}</div>',
                                    '<section class="comments-area"><ol><li>{}</li></ol></section>', "{}"])
@pytest.mark.parametrize("outside", [False, True])
def test_articles_of_readers_are_no_main_text(around, outside):
    """Comments as articles inside the article, as the HTML specification has them, or after it."""
    if outside and around == "{}":
        return  # articles side by side are all articles of the page
    readers = around.format("".join(f"<article><p>{x}</p></article>" for x in (
        "I liked this piece very much, thank you for it.", "The river I know does not run that way, as far as I can tell.")))
    body = "".join(f"<p>{x}</p>" for x in PROSE)
    page = f"<article>{body}</article>{readers}" if outside else f"<article>{body}{readers}</article>"
    assert html_extract.main_text(f"<body>{page}</body>")[0] == "\n\n".join(PROSE)


def test_articles_in_a_mere_wrapper_and_the_only_article_stay():
    body = "".join(f"<p>{x}</p>" for x in PROSE)
    for page in (f"<article><article>{body}</article></article>", f"<div class='responses'><article>{body}</article></div>",
                 f"<div class='feed'><article>{body}</article></div>"):
        assert html_extract.main_text(page)[0] == "\n\n".join(PROSE), page


@pytest.mark.parametrize("names", ["modal-verbs", "widget-review", "menu-of-the-day", "banner-making", "cookie-recipes", "login-history", "overlay-networks-explained"])
def test_names_that_only_begin_like_boilerplate(names):
    for tag in ("div", "section", "article", "main"):
        assert article(f'class="{names}"', tag) == "\n\n".join(PROSE)
    assert html_extract.main_text(f"<main><div id='{names}'>{''.join(f'<p>{x}</p>' for x in PROSE)}</div></main>")[0] == "\n\n".join(PROSE)


def test_formulas_stay_in_the_text():
    page = ("<article><p>So <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding='application/x-tex'>x = 1"
            "</annotation></semantics></math> holds for every case of it.</p></article>")
    assert html_extract.main_text(page)[0] == "So x=1 holds for every case of it."


def test_main_text_of_the_pages_table(spark):
    for r in W["op2_html"](spark, SF_SMALL).join(table(spark, "pages").select("page_id", "html"), "page_id").collect():
        inside = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        from html import unescape
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:h1|p)>", inside)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(1, 8)
        odds = [rng.uniform(-2, 2) for _ in range(n)]
        edges = {(i, j): rng.uniform(0, 1.5) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}

        def cost(labels):
            return sum(-z for z, x in zip(odds, labels) if x) + sum(w for (i, j), w in edges.items() if labels[i] != labels[j])
        best = min(cost(x) for x in itertools.product((False, True), repeat=n))
        assert cost(html_extract.minimum_cut(odds, edges)) == pytest.approx(best, abs=1e-9)


def test_hostile_pages_take_linear_time():
    import time
    for part in ("<nav>", "<p title='", "<!--", "</div>", '<a b="', "<", "<script>", "<li><b>", "<p>a b"):
        began = time.time()
        html_extract.main_text(part * 20_000)
        assert time.time() - began < 5, part


# -------------------------------------------------------------- secrets

def test_secrets_of_the_documents(spark):
    found = {r.doc_id: r.secrets for r in W["op3_secrets"](spark, SF_ORACLE).collect()}
    for r in table(spark, "documents", SF_ORACLE).collect():
        assert found[r.doc_id] == re.findall('token = "([0-9a-f]{40})"', r.text), r.doc_id


def test_secrets_and_look_alikes(spark):
    hx = hashlib.sha256(b"1").hexdigest()
    rows = [(f'api_key = "{hx[:40]}"', 1), (f"use AKIA{hx[:16].upper()} as the key", 1), (f"commit {hx[:40]} fixed it", 0),
            (f"sha256: {hx}", 0), ('password = "YOUR_PASSWORD_HERE"', 0), ("call 4539 4445 5555 1234567890123456", 0),
            ("a-very-long-hyphenated-word", 0), ("-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----", 1)]
    docs = spark.createDataFrame([(i, t, "src/app", n) for i, (t, n) in enumerate(rows)], "doc_id long, text string, source string, n int")
    forest = secrets.train(secrets.labelled_findings(spark))
    for r in secrets.scan(docs, forest).collect():
        assert len(r.secrets) == r.n, (r.text, r.secrets)
    clean = {r.doc_id: r.text for r in secrets.redact(docs, forest).collect()}
    assert clean[0] == 'api_key = "[SECRET]"' and clean[2] == rows[2][0] and clean[7] == "[SECRET]"


def test_secrets_anywhere_in_a_word(spark):
    def b64(text):
        return base64.b64encode(hashlib.sha256(text.encode()).digest()).decode()
    padded, plain = b64("2"), b64("3").translate(str.maketrans("+/=", "aB3"))
    gh, sk, hx = "ghp_" + plain[:36], "sk-" + plain[:40], hashlib.sha256(b"1").hexdigest()[:40]
    pem = (f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-256-CBC,{hx[:32].upper()}\n\n"
           f"{padded}\n-----END RSA PRIVATE KEY-----")
    rows = [(f"api_key={padded}", "api_key=[SECRET]"), (f'api_key = "{padded}"', 'api_key = "[SECRET]"'),
            ('{"api_key":"%s","user":"bob"}' % sk, '{"api_key":"[SECRET]","user":"bob"}'),
            ('{"api_key":"%s","username":"bobby_brown","id":"%s"}' % (sk, hx), '{"api_key":"[SECRET]","username":"bobby_brown","id":"%s"}' % hx),
            (f"token={gh};path=/", "token=[SECRET];path=/"), (f"https://x/cb?token={gh}&lang=en", "https://x/cb?token=[SECRET]&lang=en"),
            (f'{{"token":"{hx}","secret":"{sk}"}}', '{"token":"[SECRET]","secret":"[SECRET]"}'),
            (f"token={gh}&password=hZ7!qk2Lw9", "token=[SECRET]&password=[SECRET]"), (f"a {pem} z", "a [SECRET] z")]
    docs = spark.createDataFrame([(i, t, "src/app") for i, (t, _) in enumerate(rows)], "doc_id long, text string, source string")
    forest = secrets.train(secrets.labelled_findings(spark))
    clean = {r.doc_id: r.text for r in secrets.redact(docs, forest).collect()}
    assert [clean[i] for i in range(len(rows))] == [c for _, c in rows]
    found = {r.doc_id: [s.value for s in r.secrets] for r in secrets.scan(docs, forest).collect()}
    assert found[0] == found[1] == [padded] and found[2] == [sk] and found[6] == [hx, sk] and found[8][0] == pem


# ------------------------------------------------------------------ BPE

@pytest.mark.parametrize("form", ["arrow", "native"])
def test_bpe_equals_the_library(spark, form):
    rng = random.Random(5)
    letters = "ab é́ \t\n\x1c\x1f\x85  ​'strevmlld1٣⅓Ⅷ²%$😀漢字ß\r\x0b\x00-_"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += ["a" * 3000, "abc" * 500, " " * 300 + "x", "", None] + [r.text for r in table(spark, "documents").limit(40).collect()]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    if form == "arrow":
        out = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, cache_pieces=50)
    else:
        out = bpe.encode_native(docs, RANKS, public_tokenizers.PATTERN, hot_words=100)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    for r in out.withColumn("back", bpe.decode(F.col("ids"), RANKS)).collect():
        assert r.ids == library.encode_ordinary(r.text or ""), r.text
        assert bytes(r.back) == (r.text or "").encode()


def test_long_pieces_fold_like_short_ones():
    ranks = bpe.read_ranks(RANKS)
    rng = random.Random(1)
    library = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    for _ in range(200):
        piece = "".join(rng.choice("abeinrst") for _ in range(rng.randint(1, 150)))
        assert bpe.fold_bytes(piece.encode(), ranks) == library.encode_ordinary(piece)


# -------------------------------------------------------- near duplicates

def shingles(text, k):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_by_brute_force(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for x, y in itertools.combinations(range(len(sets)), 2):
        a, b = sets[x][1], sets[y][1]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            up[max(root(x), root(y))] = min(root(x), root(y))
    least = {}
    for x, (i, _) in enumerate(sets):
        least[root(x)] = min(least.get(root(x), i), i)
    return {i: (len(s), least[root(x)]) for x, (i, s) in enumerate(sets)}


def chains(n, seed):
    """Copies, and chains in which each text is like the one before only."""
    rng = random.Random(seed)
    out, base = [], []
    for i in range(n):
        if i % 12 == 0 or not base:
            base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(2, 120))]
        elif i % 5:
            base = list(base)
            base[rng.randrange(len(base))] = f"n{i}"
        out.append((i * 7 % n, " ".join(base) if i % 7 else " \n".join(base).upper()))
    return out


@pytest.mark.parametrize("options", [{}, {"block_rows": 2, "block_shingles": 300}, {"group_most": 3, "block_rows": 4}])
def test_near_duplicates_by_brute_force(spark, options):
    rows = chains(240, 9)
    expected = near_by_brute_force(rows, 3, 85)
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85, **options).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    assert len({v[1] for v in expected.values()}) < 200


def test_pruning_limits_follow_the_posterior():
    plan = minhash.Plan(85, 1e-6)
    assert (1 - 0.85 ** plan.rows) ** plan.bands <= 1e-6
    assert all(0 < least <= n for least, n in zip(plan.least, plan.stops))
    rng = np.random.default_rng(0)
    for share in (0.85, 0.9):  # of similar pairs hardly any is dropped
        equal = rng.random((20_000, plan.n)) < share
        lost = np.zeros(20_000, dtype=bool)
        for stop, least in zip(plan.stops, plan.least):
            lost |= equal[:, :stop].sum(axis=1) < least
        assert lost.mean() < 1e-3


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500 + i, 500) for i in range(1, 60)] + [(900, 901), (901, 900), (7, 7)]
    out = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(out) == 201 + 60 + 2
    assert {r.root for r in out if r.node <= 200} == {0} and {r.root for r in out if 500 <= r.node < 600} == {500}


# --------------------------------------------------------------- mixing

def targets_by_hand(sizes):
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda x: (x is None, x or "")))}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        open_ = [s for s in sizes if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else share[s] for s in sizes}
        capped |= over


def test_mixing_by_hand(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 300))), rng.choice(["b", "a", "a", "a", "ä", None, "z", "B"])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, block_words=16).collect()
    again = mixing.mix(docs.repartition(7), block_words=16).collect()
    assert sorted(map(str, [(r.doc_id, r.taken, r.pieces) for r in out])) == sorted(map(str, [(r.doc_id, r.taken, r.pieces) for r in again]))
    sizes, taken = {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r["size"] == len(r.text.split()) and r.taken <= 2 * r["size"]
    expected = targets_by_hand(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
    assert all(abs(taken[s] - expected[s]) <= 16 for s in sizes)
    # a block of a pass is read at one slot, and its pieces join up to whole blocks
    slots = {}
    for r in out:
        for p in r.pieces:
            slots.setdefault((r.source, p.slot), []).append((p.shard, p["pass"], p.block, p.n))
    for pieces in slots.values():
        assert len({x[:3] for x in pieces}) == 1 and sum(x[3] for x in pieces) <= 16
    assert len({x[0] for v in slots.values() for x in v}) >= 1


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 64, 1000):
        out = spark.range(n).select(mixing._unpermute(F.col("id"), F.lit(n).cast("long"), F.lit(12345).cast("long"), 8).alias("p")).collect()
        assert sorted(r.p for r in out) == list(range(n))
    assert [r.p for r in out] != list(range(1000))


# -------------------------------------------------------- repeated bytes

def kept_by_brute_force(texts, length):
    where = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            where.setdefault(t[s:s + length], []).append((i, s))
    gone = [np.zeros(len(t), dtype=bool) for t in texts]
    for found in where.values():
        if len(found) > 1:
            for i, s in found:
                gone[i][s:s + length] = True
    return [bytes(np.frombuffer(t, np.uint8)[~g]) for t, g in zip(texts, gone)], [int(g.sum()) for g in gone]


@pytest.mark.parametrize("options", [{}, {"group_most": 2}, {"round_rows": 3}])
def test_repeats_by_brute_force(spark, options):
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcé ") for _ in range(rng.randint(20, 120))) for _ in range(12)]
    texts = ["".join(rng.choice([rng.choice(pool), "".join(rng.choice("xyz") for _ in range(25))]) for _ in range(rng.randint(0, 9))) for _ in range(80)]
    texts += ["q" * 300, "pq" * 100 + "r", texts[3], ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    expected, removed = kept_by_brute_force([t.encode() for t in texts], 40)
    out = suffixes.remove_repeats(docs, length=40, gram=8, **options).collect()
    assert [bytes(r.kept) for r in sorted(out, key=lambda r: r.doc_id)] == expected
    assert all(sum(x["end"] - x["start"] for x in r.removed) == removed[r.doc_id] for r in out)
    assert all(a["end"] < b["start"] for r in out for a, b in zip(r.removed, r.removed[1:]))


# ---------------------------------------------------- nearest neighbours

def test_search_and_relaxed_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    x[100:140] = x[100]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    index = vptree.build_index(df, shard_rows=300)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosine = unit @ unit.T
    expected = {}
    for q in range(0, 3000, 50):
        order = sorted((j for j in range(3000) if j != q), key=lambda j: (-round(cosine[q, j], 12), j))
        expected[q] = order[:5]
    for factor, least in ((1.0, 1.0), (1.5, 0.9)):
        found = {}
        for r in vptree.search(index, df.filter("vec_id % 50 = 0"), factor=factor, block_queries=17, group_shards=4).collect():
            found.setdefault(r.query_id, {})[r.rank] = r.vec_id
        right = sum(len(set(expected[q]) & set(found[q].values())) for q in expected)
        assert right >= least * 5 * len(expected)
        if factor == 1.0:
            assert {q: [f[i] for i in range(1, 6)] for q, f in found.items()} == expected
    assert index.count() >= 10


@pytest.mark.parametrize("copies, others", [(3, [51, 52, 53, 54, 55]), (8, [51, 52, 53, 54, 55, 56]), (3, [48, 49, 51, 51, 52, 53]), (7, [])])
def test_query_row_stored_several_times_among_copies(spark, copies, others):
    same, far = [1.0, 2.0, 3.0], [[1.0, 0.0, float(i)] for i in range(4)]
    rows = [(50, same)] * copies + [(i, same) for i in others] + [(100 + i, v) for i, v in enumerate(far)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    for shard_rows in (4096, 4):
        out = vptree.search(vptree.build_index(df, shard_rows=shard_rows), df.filter("vec_id = 50"), k=5).orderBy("rank").collect()
        expected = sorted((i for i, _ in rows if i != 50), key=lambda i: (-round(float(unit[i] @ unit[50]), 12), i))[:5]
        assert [r.vec_id for r in out] == expected


# ------------------------------------------------------------ classifier

def test_held_out_accuracy(spark):
    out = W["op9_quality_classifier"](spark, SF_ORACLE).collect()
    assert len(out) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    labels = {r.doc_id: r.quality for r in table(spark, "labels", SF_ORACLE).collect()}
    held = [r for r in out if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.predicted == 1 for r in held if labels[r.doc_id] == 1)


def test_models_without_two_classes(spark):
    docs = table(spark, "documents").limit(10)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_classifier.fit(docs, none).rules == ()
    for label in (0, 1):
        model = quality_classifier.fit(docs, docs.select("doc_id", F.lit(label).alias("quality")))
        assert {round(r.score) for r in quality_classifier.score(docs, model).collect()} == {label}


# ----------------------------------------------------------- token files

def test_coder_round_trips():
    rng = np.random.default_rng(1)
    cases = [[rng.integers(0, 50_257, n) for n in (5, 4096, 1, 0, 300)], [np.array([7])], [],
             [np.array([1, 2, 3] * 500), np.zeros(1000, int), np.full(700, (1 << 18) - 2), rng.zipf(1.2, 3000) % 50_000]]
    for blocks in cases:
        coded = token_files.encode_blocks(blocks)
        back = token_files.decode_blocks(coded, [len(b) for b in blocks])
        assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
    assert len(coded[1]) < 100  # a constant block needs almost nothing


def test_damage_is_found():
    blocks = [np.arange(50), np.arange(90)]
    coded = token_files.encode_blocks(blocks)
    data = bytearray(token_files.pack([50, 90], coded))
    assert token_files.unpack(bytes(data))[0] == [50, 90]
    data[-3] ^= 1
    with pytest.raises(ValueError, match="block 1"):
        token_files.unpack(bytes(data))
    with pytest.raises(ValueError, match="damaged"):
        token_files.unpack(bytes(data[:-10]))


def test_token_files_equal_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    docs = sorted((r.doc_id, r.text) for r in table(spark, "documents").collect())
    docs += [(10_000, "<|endoftext|> 's   \t x　y  "), (10_001, "\x1c\x1d a b")]
    path = scratch_path(spark, "t-files")
    token_files.write(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), path,
                      public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    at = 0
    for (doc, text), r in zip(docs, token_files.read(spark, path).orderBy("start").collect(), strict=True):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (doc, at, len(ids), ids.tobytes())
        at += len(ids)
