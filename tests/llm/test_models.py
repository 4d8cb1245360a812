"""Quality, personal data, exact search, page text and the whole pipeline."""

import hashlib
import math
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from facetry.llm import exact_topk, html_extract, pii, quality
from tests.llm.fixtures import SF, TEXTS, docs


# --- quality


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train, held = lab.where("doc_id % 2 = 0"), {r.doc_id: r.quality for r in lab.where("doc_id % 2 = 1").collect()}
    kept = {r.doc_id for r in quality.draw(d, train).select("doc_id").collect()}
    good = [i for i, q in held.items() if q == 1]
    bad = [i for i, q in held.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.98 * len(good)
    assert sum(i not in kept for i in bad) >= 0.85 * len(bad)


def test_gumbel_top_k(spark):
    d, lab = docs(spark, [f"good words here {i}" for i in range(200)]), _labels(spark, [(10 + i, 1, 0) for i in range(50)])
    model = quality.fit(d, lab)
    assert quality.draw(d, lab, k=37, model=model).count() == 37
    a, b = (sorted(r.doc_id for r in quality.draw(x, lab, k=37, model=model).collect()) for x in (d, d.repartition(5)))
    assert a == b
    assert quality.draw(d, lab, k=0, model=model).count() == 0 and quality.draw(d, lab, k=10**6, model=model).count() == 200


def brute_draw(rows, target, k=None, buckets=1 << 14):
    """Ids drawn, and those that a hard line would keep, by plain counting."""
    mask = (1 << 64) - 1

    def grams(t):
        h = [int.from_bytes(xxhash.xxh64_digest(w, 7), "little") for w in re.findall(r"[^\W_]+|[^\w\s]+|_+", t or "")]
        two = [0 if a == b else ((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) & mask) >> 50 for a, b in zip(h, h[1:])]
        return [((a * 0x9E3779B97F4A7C15) & mask) >> 50 for a in h] + two

    raw, good = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i in target:
            good.update(grams(t))
    r, g = sum(raw.values()), sum(good.values())
    ratio = lambda x: math.log((good[x] + 0.5) / (g + 0.5 * buckets)) - math.log((raw[x] + 0.5) / (r + 0.5 * buckets))
    keyed = []
    for i, t in rows:
        x = grams(t)
        weight = sum(map(ratio, x)) + 0.2 * (len(x) + 20)
        h = xxhash.xxh64_intdigest(struct.pack("<i", 17), xxhash.xxh64_intdigest(struct.pack("<q", i), 42))
        keyed.append((weight - math.log(-math.log((h % (1 << 52) + 0.5) / (1 << 52))), weight, i))
    line = {i for _, w, i in keyed if w >= 0}
    return {i for _, _, i in sorted(keyed, reverse=True)[: len(line) if k is None else k]}, line


def test_draw_against_brute_force(spark):
    rng = random.Random(7)
    clean = [" ".join(rng.choice(("the", "sun", "was", "low", "and", "we", "went", "home", ",", f"by{rng.randint(0, 30)}")) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    junk = [" ".join(rng.choice(("buy", "now!!!", "$$$", "free", "the", "we", f"x{rng.randint(0, 30)}")) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    rows = list(enumerate([x for pair in zip(clean, junk) for x in pair], 100)) + [(1, None), (2, ""), (3, "\x1c_ a__b")]
    target = {i for i, t in rows if t in clean and i % 3 == 0}
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = quality.draw(d, _labels(spark, [(i, 1, 0) for i in target]))
    want, line = brute_draw(rows, target)
    assert {r.doc_id for r in got.collect()} == want and want != line and len(want) == len(line)
    assert {r.doc_id for r in quality.draw(d, _labels(spark, [(i, 1, 0) for i in target]), k=100, keep_text=False).collect()} == brute_draw(rows, target, 100)[0]


def test_ties_and_clashing_columns(spark):
    d = docs(spark, ["same text here"] * 5, [7] * 5).withColumns({"log_ratio": F.lit("x"), "gumbel_key": F.lit("y"), "log_weight": F.lit(1)})
    got = quality.draw(d, _labels(spark, [(7, 1, 0)]), k=2).collect()
    assert len(got) == 5 and all(isinstance(r.gumbel_key, float) and r.keep is True for r in got)  # equal keys at the line all stay


def test_kth_largest(spark):
    rng = random.Random(1)
    for values in ([rng.gauss(0, 1) for _ in range(3000)], [1.0] * 50 + [2.0] * 50, [1e-300 * i for i in range(100)], [5.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        for k in {1, 2, len(values) // 2, len(values)} - {0}:
            assert quality.kth_largest(df, "v", k, cells=64) == sorted(values, reverse=True)[min(k, len(values)) - 1]


def test_quality_edges(spark):
    d = docs(spark, TEXTS + [TEXTS[4]], [*range(10, 10 + len(TEXTS)), None])
    none = quality.draw(d, _labels(spark, []))
    assert none.count() == len(TEXTS) + 1 and set(d.columns) <= set(none.columns)
    assert quality.draw(docs(spark, []), _labels(spark, [(1, 1, 0)])).count() == 0
    assert quality.draw(d, _labels(spark, [(14, 1, 0), (14, 0, 0), (None, 1, 0), (15, None, None)])).count() == len(TEXTS) + 1


# --- personal data


def base_pii(t):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_personal_data(spark):
    rng = random.Random(2)
    parts = list("a1.@-+ 04(") + ["4111 1111 1111 1111", "a@b.co", "10.0.0.256", "1.2.3.4", "+1 (918) 555-2370", "٣", "..", "é", "0001.2.3.4", "\n"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(600)] + ["call 918-555-2370 now", "write to bob (at) mail (dot) com please", "9" * 50_000 + "." * 100 + "1." * 20_000]
    got = {r.doc_id: r for r in pii.detect(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts, 10):
        want = base_pii(t or "") if len(t or "") < 20_000 or "9" * 50 not in t else []
        said = ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        if len(t or "") < 20_000 or "9" * 50 not in t:
            assert got[i].base_sha256 == hashlib.sha256(said.encode()).hexdigest(), t
            assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(x[2] == k for x in want) for k in pii.BASE]
            assert set(said.split(",")) - {""} <= set(got[i].spans.split(","))
    long = got[12 + len(TEXTS) + 600]
    assert (long.n_email, long.n_ip, long.n_card, long.n_phone) == (0, 5000, 0, 0)
    assert got[10 + len(TEXTS) + 600].spans == "national:5:17" and got[11 + len(TEXTS) + 600].spans == "spelled:9:32"
    assert pii.detect(docs(spark, [])).count() == 0 and pii.detect(docs(spark, ["plain", None])).count() == 2


def planted_pii(rng, n):
    """Texts, and for each the added kind that truly stands there; decoys have its form and nothing else of it."""
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    out = []
    for _ in range(n):
        area = rng.choice("23456789") + d(2)
        true = {
            "national": (rng.choice(["call", "phone", "tel"]), f"{area}-{rng.choice('23456789')}{d(2)}-{d(4)}"),
            "ssn": (rng.choice(["ssn", "social security"]), f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"),
            "spelled": (rng.choice(["write to", "mail"]), f"{rng.choice(['ann', 'bob', 'eve'])}{d(1)} (at) host{d(1)} (dot) {rng.choice(['com', 'org', 'de'])}"),
        }
        decoy = {
            "national": (rng.choice(["order", "invoice", "sku"]), f"{rng.choice('01')}{d(2)}-{rng.choice('01')}{d(2)}-{d(4)}"),
            "ssn": (rng.choice(["serial", "ref", "version"]), f"{rng.choice(['000', '666', '9' + d(2)])}-{d(2)}-{d(4)}"),
            "spelled": (rng.choice(["look", "stay", "we met"]), f"{rng.choice(['noon', 'home'])} at {rng.choice(['the', 'this'])} dot {rng.choice(['line', 'mark'])}"),
        }
        kind, real = rng.choice(list(true)), rng.random() < 0.5
        cue, s = (true if real else decoy)[kind]
        cue = cue if rng.random() < 0.7 else rng.choice(["so", "and then", "well"])  # the context labeler is often silent
        out.append((f"{rng.choice(['Now', 'Please', 'Then'])} {cue} {s} today", kind if real else None))
    return out


def test_held_out_precision_and_recall(spark):
    train, held = planted_pii(random.Random(21), 800), planted_pii(random.Random(22), 400)
    model = pii.fit(docs(spark, [t for t, _ in train]))
    got = {r.doc_id - 10: r.spans for r in pii.detect(docs(spark, [t for t, _ in held]), model=model).collect()}
    said = [{x.split(":")[0] for x in got[i].split(",") if x} for i in range(len(held))]
    hits = sum(k is not None and k in s for s, (_, k) in zip(said, held))
    precision, recall = hits / sum(map(len, said)), hits / sum(k is not None for _, k in held)
    assert precision >= 0.95 and recall >= 0.95, (precision, recall, model["reliability"])


def test_reliabilities_are_found():
    rng = np.random.default_rng(3)
    truth, acc = rng.random(4000) < 0.7, np.array([0.95, 0.9, 0.7, 0.6, 0.8])
    v = np.where(rng.random((4000, 5)) < acc, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None]) * (rng.random((4000, 5)) < 0.7)
    post, right, _ = pii.expectation_maximisation([(0, tuple(x), 1) for x in v.tolist()])
    assert np.abs(right - acc).max() < 0.08 and ((post > 0.5) == truth).mean() > 0.85
    x = rng.random((4000, 3)) < 0.5
    w = pii.train(x.astype(float), (x[:, 0] & ~x[:, 1]).astype(float), np.ones(4000))
    assert w[0] > 1 and w[1] < -1


# --- exact search


def brute_topk(rows, k=10):
    ok = [(i, [int(np.floor(np.float64(x) * 1024)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, qv in ok:
        if q % 100 == 0:
            s = sorted(((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q))[:k]
            out += [(q, r, i, -x) for r, (x, i) in enumerate(s, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,rows_in_block", [(16, 4096), (3, 7)])
def test_exact_topk(spark, block, rows_in_block):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 0.2, (260, 12)).astype(np.float32)
    rows = [(i, base[i % 200].tolist()) for i in range(260)]  # copies: ties
    rows += [(1000, None), (1001, [None] * 12), (1100, [float("nan")] * 12), (1200, [float("inf")] * 12), (1300, [0.5] * 5), (1400, []), (1500, [3e5] * 12), (7, base[7].tolist()), (None, [0.1] * 12)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, rank int").repartition(5)
    for size in (1 << 20, 200):  # one pass, and many
        got = exact_topk.top_k(df, F.col("vec_id") % 100 == 0, block=block, rows_in_block=rows_in_block, query_bytes=size).collect()
        assert sorted(map(tuple, got)) == brute_topk(rows)


def test_bounds_leave_out_work():
    rng = np.random.default_rng(5)
    for spread, most in ((np.ones(64), 0.9), (0.9 ** np.arange(64), 0.45)):
        x = rng.normal(0, 1, (8192, 64)) * spread
        x = np.floor(1024 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64).T
        q, ids = x[:, :40].copy(), np.arange(8192)
        exact = q.T @ x
        exact[np.arange(40), np.arange(40)] = -(1 << 40)
        best, took = exact_topk.Best(40, 10), []
        for at in range(0, 8192, 2048):
            row, col, score, done = exact_topk.search_block(ids[:40], q, ids[at : at + 2048], x[:, at : at + 2048], 10, 8, best.floor)
            best.add(row, ids[at : at + 2048][col], score)
            took.append(done / (40 * 2048 * 64))
        want = np.sort(exact, axis=1)[:, ::-1][:, :10]
        assert (best.score.reshape(40, 10) == want).all()
        assert took[-1] < most, took


def test_topk_edges(spark):
    e = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert exact_topk.top_k(e, F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert exact_topk.top_k(one, F.col("vec_id") % 100 == 0).count() == 0


# --- pages

NAV = '<nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div>'


def test_marks():
    h = f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{NAV}<header>Site</header><article><h1>A &amp; B</h1><p>one <b>two<br><p>three&nbsp; four<script>var x='</p>'</script></p><aside>ad</aside><form>f</form><ul><li>x<li>y</ul><div class='comments'><p>first!</p></div></article><div class=\"sidebar\">s</div><footer>f</footer>"
    assert html_extract.page_text(h) == "A & B\none two\nthree four\nx\ny"
    assert html_extract.page_text(None) == html_extract.page_text("") == ""
    assert html_extract.page_text("plain &lt;text&gt; <b>here</b") == "plain <text> here"
    assert html_extract.page_text("<article><p>cut &am") == "cut &am"
    assert html_extract.page_text("<main><p>m</p></main><p>out</p>") == "m"
    assert html_extract.page_text('<p a="' * 3000 + "x") is not None


def test_tree_matching():
    a = html_extract.parse("<body><div><p>1</p><p>2</p></div><ul><li>x</li></ul><footer>f</footer></body>")
    b = html_extract.parse("<body><h1>new</h1><div><p>1</p></div><footer>f</footer></body>")
    tags = [p.tag for p, q in html_extract.simple_tree_matching(a, b) if p.tag == q.tag]
    assert sorted(tags) == sorted(["#root", "body", "div", "p", "footer"])


def test_tree_matching_of_uniform_lists():
    page = lambda n, more: html_extract.parse("<body>" + more + "".join(f"<div><p>{more}{i}</p></div>" for i in range(n)) + "<div><b>foot</b></div></body>")
    for n in (3, 600):
        pairs = html_extract.simple_tree_matching(page(n, ""), page(n + 2, "<div><i>ad</i></div>"))
        assert [q.own for p, q in pairs if p.own == "foot"] == ["foot"]
    long = lambda n, more: html_extract.parse("<body>" + "".join(f"<p>{more}{i}</p>" for i in range(n)) + "<p>foot</p></body>")
    assert [q.own for p, q in html_extract.simple_tree_matching(long(2100, "a"), long(2300, "b")) if p.own == "foot"] == ["foot"]


def test_wrappers_without_marks(spark):
    page = lambda i: f'<html><body><div><a href="/a">Start</a> <a href="/b">News</a></div><div><p>Story number {i} tells {i * 7} things.</p><p>And then {i}.</p></div><div><p>Copyright by us, all rights reserved.</p></div></body></html>'
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(8)] + [(100, "http://h.example/0", page(0)), (101, None, page(3)), (102, "http://alone.example/x", page(4)), (103, "http://h.example/n", None)]
    got = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))).collect()}
    assert len(got) == len(rows)
    for i in range(8):
        assert got[i].text == f"Story number {i} tells {i * 7} things.\nAnd then {i}." and got[i].n_chars == len(got[i].text)
    assert got[103].text == "" and "Story number 4" in got[102].text and got[100].text == got[0].text
    small = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), broadcast_bytes=0).collect()}
    assert small == {k: r.text for k, r in got.items()}
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_template_inside_articles(spark):
    story = lambda i: "".join(f"<p>Part {j} of story {i} tells {i * 7 + j} things.</p>" for j in range(2 + i % 3))
    page = lambda i: f'<html><body><nav>menu</nav><article><h1>Title {i}</h1><div class="line">Pass this on to friends</div>{story(i)}<p>Get our paper every day.</p></article><footer>f</footer></body></html>'
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(8)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert got[i] == "\n".join([f"Title {i}", *[f"Part {j} of story {i} tells {i * 7 + j} things." for j in range(2 + i % 3)]])


def test_words_in_classes_and_ids():
    h = '<article><h1 id="search-for-meaning">T</h1><div id="comment-on-war"><p>a</p></div><p class="lead related-work">b</p><span class="share-price">c</span><p class="search-results">d</p><div class="post-comments">no</div><p class="notice">no</p><div id="comments">no</div><div class="cookie-notice-2">no</div></article>'
    assert html_extract.page_text(h) == "T\na\nb\nc\nd"
    assert html_extract.page_text('<div class="site-header">no</div><div><p>x</p></div>') == "x"


def test_deep_pages(spark):
    deep = lambda i, n: f"<html><body><article><h1>T{i}</h1>" + "<div>" * n + f"<p>text {i}</p>" + "</div>" * n + "</article></body></html>"
    rows = [(i, "http://deep.example/x", deep(i, 10_000 - 7 * i)) for i in range(3)] + [(9, "http://deep.example/y", "<b>" * 9000 + "z" + "</i>" * 20_000)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "T0\ntext 0", 1: "T1\ntext 1", 2: "T2\ntext 2", 9: "z"}


def test_two_pages_and_region(spark):
    page = lambda i: f'<html><body><table><tr><td><a href="/">Start</a></td><td>Archive of all we wrote and of all that we will ever write, by the year and by the month, since we began.</td></tr></table><div class="x{i}"><p>Title of {i}</p></div><div class="story"><p>Story {i} has much to say about {i * 7} things, and it says so in many words.</p><p>It ends with {i}, as others do, after all has been said on it.</p></div></body></html>'
    rows = [(i, "http://two.example/", page(i)) for i in (1, 2)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in (1, 2):
        assert got[i] == f"Story {i} has much to say about {i * 7} things, and it says so in many words.\nIt ends with {i}, as others do, after all has been said on it."


def test_copies_of_a_short_article_do_not_count(spark):
    # menus and notices are most of each page; a third of the pages are copies of the reference
    page = lambda i: f"<html><body><article><h1>T{i}</h1><p>Short text {i}.</p><div><p>Read more of us, day by day, in our paper, at home and on the road.</p></div></article><nav>{'menu ' * 300}</nav></body></html>"
    rows = [(i, "http://c.example/", page(0 if i < 4 else i)) for i in range(12)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == got[3] and all(got[i].startswith(f"T{i}\nShort text {i}.") for i in range(4, 12)) and "Short text 0." in got[0]


def test_pages_of_table(spark):
    from html import unescape

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        a = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        want = [" ".join(unescape(re.sub(r"<[^>]*(>|\Z)", "", x)).split()) for x in re.split(r"<p>|</p>|</?h1>", a)]
        assert got[r.page_id] == "\n".join(x for x in want if x)


# --- pipeline


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from facetry.llm.common import written

    d = spark.read.parquet(f"{SF}/documents.parquet")
    before = d
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, before, SF), name)
        assert after.columns == d.columns and 0 < after.count() <= before.count()
        assert after.where("n_chars <> char_length(text)").count() == 0
        before = after
    out = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in before.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, SF).count() == out.count()
