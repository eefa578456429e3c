"""Archives, extraction and nearest neighbours against brute force."""

import base64
import gzip
import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from gustolake.llm import _shared as S
from gustolake.llm import ann, extract, warc

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    S.prepare(spark)
    rows = [
        (1, "http://a/", "<p>same</p>"), (2, None, "<p>same</p>"), (9, "http://c/ü x%\n", "<p>same</p>"), (9, "http://c/", "<p>same</p>"),
        (3, "u", ""), (4, "u", None), (5, "u", "WARC/1.1\r\n\r\nlike a header\r\n\r\n"), (None, "n", "<p>same</p>"), (None, "n", "only null"),
        (6, "u", "é" * 300_000), (7, "u", "é" * 300_000), (8, "u", "x\r\n\r\n"),
    ]
    return spark.createDataFrame([(*r, "clash", b"c") for r in rows], "page_id long, url string, html string, payload string, data binary").repartition(3)


def brute_records(rows, least=0):
    latest = {}
    for i, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            latest[h or ""] = max(latest.get(h or "", i), i)
    n = Counter((h or "") for _, h in rows)
    out = Counter()
    for i, h in rows:
        b, to = (h or "").encode(), latest.get(h or "")
        revisit = n[h or ""] > 1 and to is not None and to != i
        out[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", to if revisit else None] += 1
    return out


@pytest.mark.parametrize("least,chunk", [(0, 1 << 20), (100, 1000)])
def test_archives_round_trip(pages, least, chunk):
    rows = [tuple(r) for r in pages.select("page_id", "html").collect()]
    got = warc.round_trip(pages, min_revisit_bytes=least, chunk_bytes=chunk)
    assert Counter(map(tuple, got.collect())) == brute_records(rows, least)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_chunks_carry_payloads_and_running_digests(spark, pages):
    folder = S.shared_path(spark, "test-warc")
    manifest = S.staged(warc.write_archives(warc.to_chunks(warc.decided(pages, "page_id", "url", "html", 0), 50_000), folder, archive_bytes=1), "m")
    chunks = warc.read_archives(manifest, chunk_bytes=70_000).where("record_type = 'response'").collect()
    assert max(len(c["data"]) for c in chunks) <= 70_000
    by = {}
    for c in sorted(chunks, key=lambda c: (c["archive"], c["at"], c["chunk_no"])):
        by.setdefault((c["archive"], c["at"], c["page_id"], c["url"]), []).append(c)
    payloads = Counter()
    for (_, _, page, url), cs in by.items():
        so_far = b""
        for k, c in enumerate(cs):
            so_far += bytes(c["data"])
            assert c["chunk_no"] == k and c["last"] == (k == len(cs) - 1) and c["bytes_so_far"] == len(so_far)
            assert c["digest_so_far"] == base64.b32encode(hashlib.sha1(so_far).digest()).decode()
        payloads[page, url, so_far.decode()] += 1
    want = {(9, "http://c/ü x%\n", "<p>same</p>"), (5, "u", "WARC/1.1\r\n\r\nlike a header\r\n\r\n"), (7, "u", "é" * 300_000)}
    assert want <= set(payloads)
    first = manifest.select("path").first()[0].removeprefix("file:")
    with gzip.open(first) as f:  # any reader of gzip members can read them
        assert f.readline() == b"WARC/1.1\r\n"


# --- extraction ------------------------------------------------------------------------------
PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">Home</a> Welcome to the site</header>
<div id="cookie-notice">We use cookies. Accept?</div><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div class="wrapper"><main><h1>A   title &amp; more</h1><p>First paragraph of the text,<br>with&nbsp;a line break and <b>bold <i>words</b>.
<p>Second one &lt;b&gt; &#233;.<script>if (a<b) "</p>"</script><div class="ad">Buy cheap things now!</div>
<blockquote>A quoted sentence stands here.</blockquote><ul><li>An item of the article.</li></ul>
<form><label>Mail</label><input><button>Send</button></form></main><aside class=sidebar><p>Related stories you may like.</p></aside>
<section id="comments"><article class="comment"><p>I liked this article a lot, thank you very much for it.</p></article></section></div>
<footer>&copy; 2020 All rights reserved.</footer></body></html>"""


def test_page_parts():
    assert extract.main_text(PAGE).split("\n\n") == [
        "A title & more", "First paragraph of the text, with a line break and bold words.", "Second one <b> é.",
        "A quoted sentence stands here.", "An item of the article.",
    ]


@pytest.mark.parametrize("before,after", [
    ("<body><div id=page class=site><div class=site-content><main class=site-main><article>", "</article></main></div></div>"),
    ("<body class='has-sidebar single'><article>", "</article>"), ("<body><article class='post category-legal'>", "</article>"),
    ("<body><form action=x><div id=wrap><article>", "</article></div></form>"), ("<body><form><div>", "</div></form>"),
    ("<body><div class='content-sidebar'><div>", "</div></div>"), ("<body><div class=no-banner><main>", "</main></div>"),
])
def test_wrappers_of_a_page_are_no_boilerplate(before, after):
    text = ["A title", *["A paragraph with many words of text that goes on for a while, until it ends like a sentence does."] * 6]
    boxes = "<div class='{}'><p>This box has a sentence with several words of its own, but it is not the text.</p></div>"
    menu = "<div class=main-menu><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>"
    inner = f"<h1>{text[0]}</h1>" + "".join(f"<p>{t}</p>" for t in text[1:])
    ends = "".join(boxes.format(c) for c in ("comment-list", "page-sidebar", "cookie-notice", "ad")) + "<footer>All rights reserved.</footer>"
    assert extract.main_text(f"{before}{menu}{inner}{ends}{after}").split("\n\n") == text
    assert extract.main_text(f"{before}{inner}{after}{menu}{ends}").split("\n\n") == text


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></div>", "<!-- open", "<script>x", "<div " * 50, "a" * 100_000, "<p>" * 5000, "&#xZZ; &bogus; &"])
def test_broken_pages_do_not_fail(page):
    assert isinstance(extract.main_text(page), str)


SENTENCE = "A paragraph with many words of text that goes on for a while, until it ends like a sentence does."


@pytest.mark.parametrize("tag", "canvas svg object select iframe title textarea noscript math template video details".split())
def test_an_element_without_end_tag_takes_no_text_with_it(tag):
    got = extract.main_text(f"<article><p>{SENTENCE}</p><{tag}><p>{SENTENCE} Again.</p></article>").split("\n\n")
    assert got == [SENTENCE, f"{SENTENCE} Again."]


@pytest.mark.parametrize("tag", ["noscript", "math", "object", "canvas", "svg"])
def test_fallback_and_formula_text_stays(tag):
    assert extract.main_text(f"<article><p>So it is <{tag}>x + y</{tag}> in all. {SENTENCE}</p></article>") == f"So it is x + y in all. {SENTENCE}"


@pytest.mark.parametrize("tag", ["script", "style", "template", "textarea", "select", "iframe"])
def test_what_is_not_text_goes(tag):
    assert extract.main_text(f"<article><p>{SENTENCE}</p><{tag}>var x = 1</{tag}><p>{SENTENCE}</p></article>").split("\n\n") == [SENTENCE] * 2


def test_hidden_inline_elements_end_where_they_do():
    inner = "<span hidden>x<span>y</span>leak</span>"
    assert extract.main_text(f"<article><p>{inner}{SENTENCE}</p></article>") == SENTENCE
    assert extract.main_text(f"<article><p><span hidden>{SENTENCE}</p></article>") == SENTENCE  # without an end it hides nothing


PARAGRAPHS = [f"{SENTENCE} Number {i}." for i in range(4)]


def plain(*blocks):
    """A page of nothing but div elements."""
    return "<html><body><div>" + "".join(f"<div>{b}</div>" for b in blocks) + "</div></body></html>"


def test_short_list_items_of_an_article_stay_and_menus_go():
    points = "<ul><li>First point</li><li>Second point</li></ul>"
    menu = "<ul><li><a href=1>One</a></li><li><a href=2>Two of these</a></li></ul>"
    page = f"<div>{menu}</div><div><p>{PARAGRAPHS[0]}</p>{points}<p>{PARAGRAPHS[1]}</p></div><div>{menu}</div>"
    assert extract.main_text(page).split("\n\n") == [PARAGRAPHS[0], "First point", "Second point", PARAGRAPHS[1]]


@pytest.mark.parametrize("foot", ["© 2024 Example Press", "Example Press. All rights reserved.", "Privacy policy and terms of use", "Tous droits réservés"])
def test_an_unnamed_footer_goes(foot):
    assert extract.main_text(plain(*PARAGRAPHS, foot)).split("\n\n") == PARAGRAPHS
    assert extract.main_text(f"<body><p>{PARAGRAPHS[0]}</p><p>{PARAGRAPHS[1]}</p><div><p>{foot}</p></div></body>").split("\n\n") == PARAGRAPHS[:2]
    topic = f"{SENTENCE} It is about the privacy policy of a press, which has all rights reserved for itself and says so."
    assert extract.main_text(plain(topic)) == topic


@pytest.mark.parametrize("name", ["user-feedback", "comments", "reader-responses", "post-comments-list"])
def test_comments_go_by_any_of_their_names(name):
    box = f"<div class={name}><p>{SENTENCE} I think so too.</p><p>{SENTENCE} I do not.</p></div>"
    assert extract.main_text(f"<div><p>{SENTENCE}</p></div>{box}") == SENTENCE
    assert extract.main_text(f"<html><body>{box}</body></html>") == ""


def test_the_cut_decides_where_markup_says_nothing():
    # a short line between paragraphs is one of them; alone among links it is not, nor is a sentence there
    line = "Meanwhile, elsewhere"
    link = "<a href=1>One of the many other pages here</a>"
    middle, end = plain(PARAGRAPHS[0], line, PARAGRAPHS[1]), plain(*PARAGRAPHS[:2], link, line, link, link)
    teaser = plain(*PARAGRAPHS, link, "Read this too. ", link, link)
    want = {middle: [PARAGRAPHS[0], line, PARAGRAPHS[1]], end: PARAGRAPHS[:2], teaser: PARAGRAPHS}

    def texts(page, smoothness):
        blocks = extract.blocks_of(page)
        return [b.text for b, keep in zip(blocks, extract.label(blocks, smoothness=smoothness), strict=True) if keep]

    assert all(texts(page, 0.8) == kept for page, kept in want.items())
    assert texts(middle, 0.0) != want[middle]  # without the edges the block's own cost would decide


def test_minimum_cut_equals_all_labellings():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = 7
        lean = [float(round(x, 2)) for x in rng.normal(0, 2, n)]
        edges = [(i, i + 1, float(round(rng.random() * 2, 2))) for i in range(n - 1)] + [(0, 4, 0.5), (2, 6, 0.7)]

        def cost(keep):
            return sum(x for x, k in zip(lean, keep, strict=True) if x > 0 and not k) - sum(x for x, k in zip(lean, keep, strict=True) if x <= 0 and k) + sum(
                w for a, b, w in edges if keep[a] != keep[b])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(extract.min_cut(lean, edges)) == pytest.approx(best, abs=0.02)


def test_extraction_of_given_pages(spark, pages):
    import html
    import re

    given = S.read_table(spark, SF, "pages")
    got = {r["page_id"]: r for r in extract.extract(given).collect()}
    for r in given.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(x for x in parts if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]
    odd = extract.extract(pages)
    assert odd.count() == pages.count() and odd.where("text is null").count() == 0 and extract.extract(pages.limit(0)).count() == 0


# --- nearest neighbours ----------------------------------------------------------------------
def brute_neighbours(rows, k, every):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in np.lexsort((ids, d)) if j != i][:k]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("window", [4, 64])
def test_neighbours_equal_brute_force(spark, window):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)).astype(np.float32)
    x[100:180] = x[7]  # many copies, among them queries
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(1000, None), (1010, [0.0] * 6), (1020, [float("nan")] * 6), (1030, [None] * 6), (1040, [1.0, 2.0]), (None, [1.0] * 6),
           (1050, [float("inf")] * 6), rows[20], rows[20]]
    df = spark.createDataFrame([(i, v, "q") for i, v in rows + odd], "vec_id long, embedding array<float>, query string")
    got = by_query(ann.search(df, k=5, query_every=10, window=window, curves=2))
    want = brute_neighbours(rows, 5, 10)
    assert got.keys() == want.keys()
    for q, found in want.items():
        assert [v for v, _ in got[q]] == [v for v, _ in found]
        assert all(math.isclose(a, b, abs_tol=1e-12) for (_, a), (_, b) in zip(got[q], found, strict=True))


def test_exact_step_in_blocks_larger_than_windows(spark, monkeypatch):
    monkeypatch.setattr(ann, "MAX_CHUNKS", 10)
    monkeypatch.setattr(ann, "SCAN_ROWS", 30)
    monkeypatch.setattr(ann, "QUERY_GROUP", 7)
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(600, 8)).astype(np.float32))]
    got = by_query(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=4, query_every=9, window=5, curves=2))
    want = brute_neighbours(rows, 4, 9)
    assert {q: [v for v, _ in f] for q, f in got.items()} == {q: [v for v, _ in f] for q, f in want.items()}


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert by_query(ann.search(df)) == {0: [(1, math.sqrt(2))]}
    assert ann.search(df.limit(0)).count() == 0


def test_windows_alone_find_clustered_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16)) * 10
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = by_query(ann.search(df, exact=False, window=200, curves=6))
    want = brute_neighbours([(i, tuple(map(float, r))) for i, r in enumerate(x)], 10, 100)
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in f}) / 10 for q, f in want.items()]) >= 0.9


def test_hilbert_keys_step_to_neighbours():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    path = cells[np.argsort(ann.hilbert_keys(cells, 3))]
    assert len(set(ann.hilbert_keys(cells, 3).tolist())) == 512
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_given_embeddings_have_full_recall(spark):
    e = S.read_table(spark, SF, "embeddings")
    got = by_query(ann.search(e, window=32))
    want = brute_neighbours([(r["vec_id"], tuple(r["embedding"])) for r in e.collect()], 10, 100)
    assert {q: [v for v, _ in f] for q, f in got.items()} == {q: [v for v, _ in f] for q, f in want.items()}


@pytest.mark.parametrize("key", ["op3_nearest_neighbours", "op4_warc_round_trip"])
def test_query_equals_sql(spark, key):
    from oracle_compare import compare

    status, _, detail = compare(spark, SF, [key], verbose=False)[key]
    assert status == "OK", detail


def test_text_weights_are_trained_on_sure_blocks(spark):
    menu = "<nav>" + "<li><a href=1>Many words stand in this menu entry</a>" * 3 + "</nav>"
    rows = [(i, "u", f"<body>{menu}<article><p>Some words of article {i}.<p>More of them</article></body>") for i in range(40)]
    df = spark.createDataFrame([*rows, (None, "u", menu), (41, "u", None), (42, "u", "")], "page_id long, url string, html string").repartition(3)
    seen = Counter()
    for _, _, page in rows:
        for b in extract.blocks_of(page):
            seen[(int(b.weight > 0), *extract.binned(b))] += 1
    want = extract.fit([(*k, n) for k, n in seen.items()])
    got = extract.learn(df)
    assert got == want != extract.START
    assert got[2] < extract.START[2]  # links speak against content
    assert extract.learn(df.limit(0)) == extract.START == extract.learn(df.where("page_id > 40"))
    assert extract.learn(df, max_train_pages=1) != extract.START
    texts = {r["page_id"]: r["text"] for r in extract.extract(df).collect()}
    assert texts == {r[0]: extract.main_text(r[2], want) for r in rows} | {None: "", 41: "", 42: ""}
    assert texts[7] == "Some words of article 7.\n\nMore of them"


def test_fit_is_a_minimum():
    counts = [(1, 20, 0, 1, 0, 50), (1, 5, 1, 0, 1, 9), (0, 2, 8, 0, 0, 30), (0, 12, 0, 1, 0, 4)]

    def loss(w):
        total = {c: sum(r[-1] for r in counts if r[0] == c) for c in (0, 1)}
        out = extract.PULL / 2 * sum((a - b) ** 2 for a, b in zip(w, extract.START, strict=True))
        for c, *bins, n in counts:
            z = sum(a * x for a, x in zip(w, extract.features(*bins), strict=True))
            out += n / total[c] / 2 * math.log1p(math.exp(-z if c else z))
        return out

    w = extract.fit(counts)
    assert w == extract.fit(counts[::-1])
    for k in range(len(w)):
        for d in (-0.01, 0.01):
            assert loss(w) < loss([x + d * (i == k) for i, x in enumerate(w)])
