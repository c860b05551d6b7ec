import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trialmart.llm import queries
from trialmart.llm import decontaminate as tiling
from trialmart.llm.decontaminate import Items, decontaminate, tile, tile_dense
from trialmart.llm.html_text import Page, best_path, extract_main_text
from trialmart.llm.pieces import LOCKSTEP, Pieces, decode, encode
from trialmart.llm.quality import fit_quality, score_quality
from trialmart.llm.toxicity import fit_toxicity, score_toxicity
from trialmart.llm.url_filter import split_url, url_filter

from ..compare import compare, duck_connection
from .conftest import SF, table

SF2 = "/root/testdata/sf0.01"


# -- url filter -----------------------------------------------------------
URLS = ["https://WWW.Example.com/en/1?x#y", "http://example.com", "ftp://a.b.net/es/2", "b.net/es/2", "://", "", None, "http://net/fr/",
        "http://xnet/fr/", "http://a.example.com?/en/", "https://notexample.com/en/", "http://u@example.com:80/en/", "http://É.com/#",
        "http://.com/", "http://com./", "x://y://example.com/en/", "http://a..net/es/é", "http://a.net/es"]


def test_url_hard(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string")
    rules = spark.createDataFrame([*queries.URL_RULES, ("net/es/", "block"), ("a..net/es/é", "allow"), (None, "block"), ("com/", "block")],
                                  "rule string, verdict string")
    key = lambda df: sorted(map(tuple, df.select("page_id", "host", "path", "rule", "verdict").collect()))
    packed, joined = key(url_filter(pages, rules)), key(url_filter(pages, rules, max_image_bytes=0))
    assert packed == joined and len(packed) == 2 * len(URLS)
    by = {r[0]: r[1:] for r in packed}
    assert by[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert by[1] == ("example.com", "", None, "allow")
    assert by[2][2:] == ("net/es/", "block") and by[16][2:] == ("a..net/es/é", "allow")
    assert by[6] == by[5] == by[3] == ("", "", None, "allow")
    assert by[13][2:] == ("com/", "block")
    deep = "a." * 1500 + "deep.org"
    hosts = spark.createDataFrame([(k, u) for k, u in enumerate(
        ["http://x.com/a", "http://com", "http://com/en/b", "http://y.net/", f"http://{deep}/p", "http://b." + deep, "http://deep.orgs/"])], "page_id long, url string")
    host_rules = spark.createDataFrame([("com", "block"), ("com/en/", "allow"), ("net/", "block"), (deep, "block"), ("deep.org", "block")], "rule string, verdict string")
    plain = [key(url_filter(hosts, host_rules, max_image_bytes=n)) for n in (1 << 20, 0)]
    assert plain[0] == plain[1]
    assert [r[3:] for r in plain[0]] == [("com", "block"), ("com", "block"), ("com/en/", "allow"), ("net/", "block"), (deep, "block"), (deep, "block"), (None, "allow")]
    none = spark.createDataFrame([], "rule string, verdict string")
    assert {r.verdict for r in url_filter(pages, none, default="block").collect()} == {"block"}
    assert url_filter(pages.limit(0), rules).collect() == []


def test_url_oracle(spark):
    n, problems = compare(queries.op1_url_filter(spark, SF), duck_connection(SF), queries.ORACLES["op1_url_filter"])
    assert n > 0 and not problems
    assert split_url("http://a/b?c") == ("a", "/b")


# -- classifiers ----------------------------------------------------------
def test_quality(spark, hard_docs, hard_rows, no_docs):
    docs, labels = table(spark, "documents", SF2), table(spark, "labels", SF2)
    got = queries.op2_quality(spark, SF2).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) >= 0.97
    model = fit_quality(docs, labels)
    hard = score_quality(hard_docs, model, ["doc_id"]).collect()
    assert len(hard) == len(hard_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in hard)
    empty = {r.score for r in hard if r.doc_id in (19, 22, 200)}
    assert len(empty) == 1 and empty.pop() == pytest.approx(model.base)
    assert score_quality(no_docs, model, ["doc_id"]).collect() == []
    for odd in (labels.limit(0), labels.withColumn("quality", F.lit(1)), labels.withColumn("quality", F.lit(None).cast("int"))):
        assert {r.predicted for r in score_quality(hard_docs, fit_quality(docs, odd), ["doc_id"]).collect()} == {1}


def test_toxicity(spark, hard_docs, hard_rows, no_docs):
    docs, labels = table(spark, "documents", SF2), table(spark, "labels", SF2)
    got = queries.op3_toxicity(spark, SF2).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) >= 0.97
    assert all(r.severity >= 0 and r.severity <= 3 and r.predicted == (r.grade > 0) for r in got)
    model = fit_toxicity(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    hard = score_toxicity(hard_docs, model, ["doc_id"]).collect()
    assert len(hard) == len(hard_rows) and {r.predicted for r in hard} == {0}
    assert score_toxicity(no_docs, model, ["doc_id"]).collect() == []
    for odd, want in ((labels.limit(0), 0), (labels.withColumn("toxic", F.lit(1)), 1), (labels.withColumn("toxic", F.lit(None).cast("int")), 0)):
        assert {r.predicted for r in score_toxicity(hard_docs, fit_toxicity(docs, odd), ["doc_id"]).collect()} == {want}


def test_toxicity_rare_markers_and_small_samples(spark, hard_docs):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeioubcdfglmnprst") for _ in range(9))
    plain, insults = [word() for _ in range(300)], [word() for _ in range(150)]
    rows = []
    for i in range(900):
        text = [rng.choice(plain) for _ in range(60)]
        if i % 3 == 0:  # an insult is in about 2% of the toxic texts
            text[10:13] = rng.sample(insults, 3)
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_toxicity(docs, docs.select("doc_id", "toxic"), train="doc_id < 720")
    got = score_toxicity(docs.where("doc_id >= 720"), model, ["toxic"]).collect()
    caught = [r.predicted for r in got if r.toxic]
    assert np.mean(caught) >= 0.9 and np.mean([r.predicted for r in got if not r.toxic]) <= 0.05
    small = queries.op3_toxicity(spark, SF).join(table(spark, "labels"), "doc_id").collect()  # 6 toxic training rows
    assert len(small) and all(r.severity >= 0 for r in small)
    assert np.mean([r.predicted == r.toxic for r in small if r.toxic is not None]) >= 0.9
    blank = docs.withColumn("text", F.lit("12 34"))
    assert {r.predicted for r in score_toxicity(hard_docs, fit_toxicity(blank, docs.select("doc_id", "toxic")), ["doc_id"]).collect()} == {0}


# -- tokens ---------------------------------------------------------------
@pytest.fixture(scope="module")
def pieces():
    return Pieces(queries.PIECES_MODEL)


def brute_viterbi(p, text):
    """Best score and ids over the whole text, character by character, with a dictionary of pieces."""
    data = b" " + text.encode() if text else b""
    spell = {bytes(p.spell[p.spell_at[i]: p.spell_at[i + 1]]): (int(i), s) for i, s in zip(p.piece_id, p.score)}
    best = [(0.0, None, ())] + [(-np.inf, None, ())] * len(data)
    for i in range(len(data)):
        if best[i][0] == -np.inf or data[i] & 0xC0 == 0x80:
            continue
        unit = 1 + (data[i] >= 0xC0) + (data[i] >= 0xE0) + (data[i] >= 0xF0)
        options = [(j, spell[data[i:j]]) for j in range(i + 1, min(len(data), i + p.longest) + 1) if data[i:j] in spell]
        if not any(j == i + unit for j, _ in options):
            options.append((i + unit, (None, p.unknown)))
        for j, (piece, score) in sorted(options, key=lambda o: o[0]):
            if best[i][0] + score > best[j][0]:
                best[j] = (best[i][0] + score, i, (piece,) if piece is not None else tuple(p.byte_id[b] for b in data[i:j]))
    out, at = [], len(data)
    while at:
        _, before, ids = best[at]
        out[:0], at = map(int, ids), before
    return out


def test_pieces_brute(spark, pieces, hard_rows):
    texts = [r.text for r in table(spark, "documents").limit(40).collect()] + [r[1] for r in hard_rows if len(r[1] or "") < 9000]
    texts += ["  lead and trail  ", "▁ marker", "x" * (LOCKSTEP + 5), "é" * LOCKSTEP, "\n\n", "a\tb\r\nc", "😀"]
    ids, counts, text, size = pieces.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for t, e, c in zip(texts, ends, counts):
        assert ids[e - c:e].tolist() == brute_viterbi(pieces, t or ""), (t or "")[:40]


def test_pieces_round_trip(spark, pieces, hard_docs, hard_rows, no_docs):
    tokens = encode(hard_docs, pieces, ["doc_id", "text"])
    rows = decode(tokens.withColumnRenamed("text", "was"), pieces, ["doc_id", "was", "n_tokens", "token_ids", "round_trip"]).collect()
    assert len(rows) == len(hard_rows)
    assert all(r.text == (r.was or "") and r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)
    assert encode(no_docs, pieces, ["doc_id"]).collect() == []
    got = queries.op5_sentencepiece(spark, SF).collect()
    assert all(r.round_trip for r in got) and len(got) == table(spark, "documents").count()


# -- decontamination ------------------------------------------------------
def test_tile_is_greedy():
    # item 0..9 stands in the document as 6..9 then 0..5: two tiles, the longer first
    doc, item = np.array([0, 1, 4, 5, 6, 7]), np.array([6, 7, 0, 1, 2, 3])
    assert tile(doc, item, 3) == [(4, 0, 6), (0, 6, 4)]
    assert tile(np.zeros(0, np.int64), np.zeros(0, np.int64), 3) == []


def brute_tiles(doc, item, width):
    """Greedy string tiling by trying every pair of positions."""
    doc_free, item_free, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        best, found = width, []
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and doc_free[d + n] and item_free[i + n]:
                    n += 1
                if n > best:
                    best, found = n, [(d, i)]
                elif n == best:
                    found.append((d, i))
        if not found:
            return tiles
        for d, i in found:
            if all(doc_free[d:d + best]) and all(item_free[i:i + best]):
                doc_free[d:d + best] = item_free[i:i + best] = [False] * best
                tiles.append((d, i, best))


def test_tiles_brute(monkeypatch):
    rng = random.Random(6)
    for letters in (1, 2, 3, 30):
        for _ in range(25):
            item = [rng.randrange(letters) for _ in range(rng.randrange(0, 25))]
            doc = [rng.randrange(letters) for _ in range(rng.randrange(0, 10))]
            for _ in range(rng.randrange(0, 4)):
                a = rng.randrange(0, len(item) + 1)
                doc += item[a:a + rng.randrange(0, 12)] + [rng.randrange(letters)]
            want = brute_tiles(doc, item, 3)
            assert tile_dense(np.array(doc, np.uint64), np.array(item, np.uint64), 3) == want
            seeds = [(d, i) for d in range(len(doc) - 2) for i in range(len(item) - 2) if doc[d:d + 3] == item[i:i + 3]]
            assert tile(*np.array(seeds, np.int64).reshape(-1, 2).T, 3) == want
    texts = pa.array([" ".join(f"t{rng.randrange(4)}" for _ in range(60)) for _ in range(30)])
    items = Items(list(range(5)), [" ".join(f"t{rng.randrange(4)}" for _ in range(20)) for _ in range(5)], 3)
    whole = sorted(zip(*items.coverage(texts)))
    for bound in (1, 50, 400):  # more and fewer documents that are tiled token by token
        monkeypatch.setattr(tiling, "MAX_SEEDS", bound)
        assert sorted(zip(*items.coverage(texts))) == whole and len(whole) > 50


def test_repetitive_texts_stay_small():
    import tracemalloc

    items = Items([1], ["the " * 2000], 5)
    tracemalloc.start()
    got = items.coverage(pa.array(["the " * 8000, "the " * 30]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x.tolist() for x in got] == [[0, 1], [0, 0], [1.0, 30 / 2000]] and peak < 60e6


def test_very_short_items(spark):
    bench = spark.createDataFrame([(1, "Yes"), (2, "oh no"), (3, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "yes, it is"), (2, "YES!"), (3, "oh no no"), (4, "Oh, no."), (5, "zero one, two three four")], "doc_id long, text string")
    assert {r.doc_id: r.item_id for r in decontaminate(docs, bench, ["doc_id"]).collect() if r.contaminated} == {2: 1, 4: 2, 5: 3}


def test_decontaminate(spark, hard_docs, hard_rows, no_docs):
    bench = table(spark, "benchmark")
    items = {r.item_id: r.text for r in bench.collect()}
    docs = table(spark, "documents").select("doc_id", "text")
    got = {r.doc_id: r for r in decontaminate(docs, bench, ["doc_id"]).collect()}
    for r in docs.collect():
        assert got[r.doc_id].contaminated == any(t in (r.text or "") for t in items.values()), r.doc_id
    first = items[min(items)]
    w = first.split()
    half = len(w) // 2
    rows = [(1, " ".join(w[half:] + ["between"] + w[:half])), (2, " ".join(w[: len(w) // 4])), (3, first.upper() + "!"), (4, None), (5, ""),
            (1, "clean"), (None, first)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, _n int")
    out = decontaminate(df, bench, ["doc_id", "text"])
    assert {(r.doc_id, r.text): r.contaminated for r in out.collect()} == {r: int(k in (0, 2, 6)) for k, r in enumerate(rows)}
    blocks = decontaminate(df, bench, ["doc_id", "text"], max_items_bytes=2000)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, out.collect()))
    odd = spark.createDataFrame([(1, None), (None, "x"), (2, "two words"), (3, ""), (7, first), (7, first)], "item_id long, text string")
    assert sorted(r.contaminated for r in decontaminate(df, odd, ["doc_id"]).collect()) == [0, 0, 0, 0, 1, 1, 1]
    assert {r.contaminated for r in decontaminate(df, odd.limit(0), ["doc_id"]).collect()} == {0}
    assert decontaminate(hard_docs, bench, ["doc_id"]).count() == len(hard_rows)
    assert decontaminate(no_docs, bench, ["doc_id"]).collect() == []


def test_decontaminate_scripts_without_blanks_and_short_items(spark):
    han, kana, thai = "机器学习是人工智能的一个重要分支。", "今日は東京で、カレーを食べました", "ประเทศไทยมีเมืองหลวงชื่อกรุงเทพ"
    items = [(1, han), (2, kana), (3, thai), (4, "Zanzibar quixotic flugelhorn"), (5, "𠀀𠀁𠀂𠀃𠀄𠀅"), (6, "!?")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, "前言，" + han[:12] + "，后记"), (2, "序" + kana + "終"), (3, "คำ" + thai), (4, "a Zanzibar, QUIXOTIC flugelhorn b"),
            (5, "x𠀀𠀁𠀂𠀃𠀄𠀅y"), (10, "今天天气很好，我们去公园散步吧"), (11, "Zanzibar flugelhorn quixotic"), (12, "é à ü naïve"), (13, "机器学习")]
    got = {r.doc_id: (r.contaminated, r.item_id) for r in
           decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench, ["doc_id"]).collect()}
    assert {k: got[k] for k in range(1, 6)} == {k: (1, k) for k in range(1, 6)}
    assert {got[k][0] for k in range(10, 14)} == {0}


# -- html -----------------------------------------------------------------
def wrap(article, k):
    return (f'<!DOCTYPE html><html><head><title>T{k}</title><script>var a="<p>no</p>";</script></head><body><header class="site"><h1>Site</h1>'
            f'<nav><a href="/">Home</a></nav></header><div id="cookie-notice-{k}">We use cookies for all kinds of things, dear reader.</div>'
            f'<div class="page wrap{k}"><div class="post-body entry">{article}</div><div class="sidebar"><p>Read this long text about other '
            f'things that stand beside the article, it is quite long</p></div><section id="comments"><p>A reader wrote a comment that is '
            f'rather long, longer than the article, and it goes on and on and on.</p></section></div><form><label>Mail</label></form>'
            f'<footer>&copy; Site</footer></body></html>')


def test_html_cases(spark):
    article = "<h2>Head &amp; tail</h2><p>First  <b>bold\n</b>text&nbsp;here, a &lt; b.<p>Second one<ul><li>x<li>y</ul><!-- gone --><div class='ad'>Buy</div>"
    want = "Head & tail\n\nFirst bold text here, a < b.\n\nSecond one\n\nx\n\ny"
    rows = [(k, f"http://H.example.com/{k}", wrap(article, k)) for k in range(6)]
    rows += [(10, "http://h.example.com/short", wrap("<p>Tiny.", 3)), (11, None, None), (12, "x", ""), (13, "http://h.example.com/", "plain < text & more"),
             (14, "http://h.example.com/", "<div"), (15, None, "<p>a<p>b</div></p></body>" * 3), (16, "u", "<nav>only menu</nav>"),
             (17, "u", "<script>never closed <p>x"), (None, "http://h.example.com/1", wrap(article, 1)), rows[0]]
    pages = spark.createDataFrame([(*r, "t", 3) for r in rows], "page_id long, url string, html string, text string, _host int")
    got = extract_main_text(pages).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    by = {r.page_id: r.text for r in got}
    assert all(by[k] == want for k in (*range(6), None))
    assert by[10] == "Tiny." and by[11] == by[12] == by[16] == by[17] == ""
    assert by[13] == "plain < text & more" and by[14] == "<div" and by[15].startswith("a\n\nb")
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract_main_text(pages.limit(0)).collect() == []


def test_html_generated(spark):
    got = {r.page_id: r.text for r in queries.op10_html_text(spark, SF).collect()}
    for r in table(spark, "pages").collect():
        import html as entities
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_html_nothing_of_own_container_lost(spark):
    lead, body = "Lead " * 80, "Body " * 120
    split = f"<html><body><main><div class=lead><p>{lead}</p></div><div class=body><p>{body}</p></div></main></body></html>"
    narrow = f"<html><body><main><div class=body><p>{body * 3}</p></div></main></body></html>"
    comments = f"<main><h1>Heading</h1><div class=body><p>{body}</p></div><div class=comments><p>{'Said ' * 150}</p></div></main>"
    rows = [(0, "http://a.net/0", split), *((k, f"http://a.net/{k}", narrow) for k in range(1, 5)), (9, "http://b.net/", comments)]
    by = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert by[0] == f"{lead.strip()}\n\n{body.strip()}" and by[1] == (body * 3).strip()
    assert by[9] == f"Heading\n\n{body.strip()}"


def test_html_marks_on_wrappers():
    def text(source):
        page = Page(source)
        best = best_path(page.scores())
        return "" if best is None else page.text(best)

    body, aside = "Body " * 100, "<div class='sidebar-left'><p>Beside the article.</p></div>"
    for name in ("has-sidebar", "elementor-widget-container", "content-with-comments", "ad-free", "widget", "overlay page"):
        assert text(f"<body><div class='{name}'><div class=x><p>{body}</p></div>{aside}</div></body>") == body.strip(), name
    assert text(f"<body><form id=all><div><p>{body}</p></div>{aside}</form></body>") == body.strip()
    assert text(f"<body><div class=social><article><p>{body}</p></article><p>Share</p></div><p>{body}</p></body>").count("Body") == 200
    assert text(f"<body><div><p>{body}</p></div><div class=comments><p>{body * 3}</p></div></body>") == body.strip()
    assert text(f"<body><div hidden><article><p>{body}</p></article></div></body>") == ""


def page_text(source):
    page = Page(source)
    best = best_path(page.scores())
    return "" if best is None else page.text(best)


def test_html_noise_beside_short_articles():
    short, long = "A short article of some fifty characters, it is.", "Noise " * 170
    for noise in (f"<div class=comments><p>{long}</p></div>", f"<form><p>{long}</p></form>", f"<div class=cookie-notice><p>{long}</p></div>",
                  f"<div id=sidebar><p>{long}</p></div>", f"<div class=menu><p>{long}</p></div>"):
        assert page_text(f"<body><div class=post><p>{short}</p></div>{noise}</body>") == short, noise
    assert page_text(f"<body><div class=comments><p>{long}</p></div></body>") == ""
    assert page_text(f"<body><div class=cookie><p>{long}</p></div></body>") == ""
    assert page_text("<body><form><label>Mail</label>Text</form></body>") == ""


def test_html_compound_marks():
    text = "<p>" + "Body " * 50 + "</p>"
    for name in ("post-comments", "user-comments", "reader_comments", "post__comments", "userComments", "site-footer", "main-nav", "top-menu",
                 "page-sidebar", "article-share", "entry-related", "google-ad", "entry-comments-area", "comments-container", "siteFooter", "ad-2"):
        for attribute in (f"class='{name}'", f"id='{name}'", f"class='x {name} y'"):
            source = f"<body><article>{text}<div {attribute}><p>Noise of its own</p></div>{text}</article></body>"
            assert page_text(source) == "\n\n".join([("Body " * 50).strip()] * 2), attribute
    for name in ("has-sidebar", "with-comments", "no-ads", "post-without-comments", "ad-free", "elementor-widget", "commentary", "adagio"):
        source = f"<body><article>{text}<div class='{name}'><p>Part of it</p></div></article></body>"
        assert page_text(source).endswith("Part of it"), name


def test_html_articles_that_are_comments():
    body, long = "Body " * 30, "Said " * 200
    post = f"<div class=post><p>{body}</p></div>"
    for noise in (f"<div class=comments><article><p>{long}</p></article></div>", f"<aside><article><p>{long}</p></article></aside>",
                  f"<article class=comment><p>{long}</p></article>", f"<section id=post-comments><article class='comment odd'><p>{long}</p></article></section>"):
        assert page_text(f"<body>{post}{noise}</body>") == body.strip(), noise
        assert page_text(f"<body><article><p>{body}</p>{noise}</article></body>") == body.strip(), noise


def test_html_vote_corrects_a_page(spark):
    post, rail = "Post text " * 60, "Rail text " * 80
    page = lambda extra="": f"<html><body><div class=post><p>{post}</p></div>{extra}</body></html>"
    side = f"<div class=rail><p>{rail}</p></div>"
    rows = [(k, f"http://a.net/{k}", page()) for k in range(9)] + [(9, "http://a.net/9", page(side))]
    rows += [(20, "http://alone.net/", page(side))]  # no other page votes: nothing is given up
    # another layout: the article is not where the host's path is
    rows += [(30, "http://a.net/30", f"<html><body><div class=story><p>{post * 9}</p></div><div class=post><p>Short.</p></div></body></html>")]
    by = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {by[k] for k in range(10)} == {post.strip()}
    assert by[20] == f"{post.strip()}\n\n{rail.strip()}" and by[30].startswith((post * 9).strip())


def test_html_long_unclosed():
    page = Page("<div class=x>" * 2000 + "<a href='" * 500 + "deep text " * 1000)
    assert best_path(page.scores()) is not None or page.scores() is not None
