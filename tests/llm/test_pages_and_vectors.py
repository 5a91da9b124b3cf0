"""Operators on pages and vectors against brute-force versions, and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
from html import unescape

import numpy as np
import pytest

import corpus_pipeline
from sluice.llm import html_text, warc
from sluice.llm.components import local_components
from sluice.llm.html_blocks import blocks, divide
from sluice.llm.vectors import near_duplicates
from tests.llm.test_text_operators import check_packing


def page_table(spark, sf_dir):
    big = "payload " * 500
    extra = [(10**6 + i, f"http://a/{i}", big) for i in range(5)] + [(2 * 10**6, None, None), (2 * 10**6 + 1, "u\r\nX: y", "short"), (2 * 10**6 + 2, "v", "short")]
    extra += [(None, "w", big), (77_777_777, "r", "q" * 200_000), (77_777_777, "r", "q" * 200_000), (5 * 10**6, "s", "é" * 400), (5 * 10**6 + 1, "s", "é" * 600), (5 * 10**6 + 2, "s", "é" * 600)]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.unionByName(spark.createDataFrame(extra, pages.schema))


@pytest.mark.parametrize("segment_bytes", [1200, 64 << 10])
def test_warc_round_trip(spark, sf_dir, segment_bytes):
    pages = page_table(spark, sf_dir)
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    last = {}
    for i, p in rows:
        if len(p) >= 1000:
            last[p] = max(last.get(p, -1), -1 if i is None else i)
    want = []
    for i, p in rows:
        revisit = p in last and i != last[p]
        want.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", last[p] if revisit else None))
    got = warc.digest(warc.round_trip(pages, segment_bytes)).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    assert warc.digest(warc.round_trip(pages.limit(0))).count() == 0


def test_warc_segments(spark):
    import gzip
    import io

    body = bytes(range(256)) * 40
    members = list(warc.page_records(5, "http://x", body, None, "2024-01-01T00:00:00Z", 1000))
    assert len(members) > 5
    found = list(warc.records(io.BytesIO(b"".join(members))))
    assert [h["warc-type"] for h, _ in found] == ["response"] + ["continuation"] * (len(members) - 1)
    assert {h["warc-segment-origin-id"] for h, _ in found[1:]} == {found[0][0]["warc-record-id"]}
    block = b"".join(b for _, b in found)
    assert int(found[-1][0]["warc-segment-total-length"]) == len(block) and warc.payload_of(block) == body
    plain = gzip.decompress(b"".join(members))
    assert [h for h, _ in warc.records(io.BytesIO(plain))] == [h for h, _ in found]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(plain[:-500])))


def test_warc_lost_segment_is_an_error(spark, tmp_path):
    members = list(warc.page_records(5, "http://x", b"z" * 5000, None, "2024-01-01T00:00:00Z", 1000))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(members[:2] + members[3:]))
    with pytest.raises(Exception, match="missing|doubled"):
        warc.read(spark.createDataFrame([(str(path),)], "path string")).collect()


def test_chunks():
    for size in (0, 1, 7, 16384, 50_000):
        body = b"\r\n0" * size
        assert warc.unchunked(warc.chunked(body, 1000)) == body
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: z\r\n\r\n") == b"abc"


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>x</article>";</script><style>p{}</style></head>
<body><header>Top</header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use</div><aside>Side</aside>
<article><h1>Head &amp; more</h1><p>First <b>bold<br>line</b>&nbsp;two<!-- no --><p>Second &lt;x&gt;</p><ul><li>one<li>two</ul>
<div class="share">Tweet</div><form>Mail <input></form><div id="comments"><article>Reader</article></div></article>
<footer>&copy; x</footer></body></html>"""


def test_html_structure():
    texts, states, words, owner = divide(PAGE)
    assert texts == ["Head & more", "First bold line two", "Second <x>", "one", "two", "Tweet"] and states == [0] * 5 + [2]
    assert "Home" in words and "Reader" in words and "Head" not in words
    assert [w for w, o in zip(words, owner) if o == 5] == ["Tweet"] and "T" not in words
    assert divide(None) == divide("") == ([], [], [], [])
    assert [t for _, t, _ in blocks("plain <i>text</i> a &lt b < c")] == ["plain text a < b < c"]


def test_html_keeps_passages_that_articles_share(spark):
    passage = "this passage of many words stands in every article of the host and stays there"
    rows = [(i, f"http://h/{i}", f"<body><div>menu of the site with a run of many words</div><article><p>{passage}</p><p>own {i}</p></article></body>") for i in range(8)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{passage}\nown {i}" for i in range(8)}


def brute(rows, run, least):
    """Every page's text, by comparing all runs and all blocks of a host with each other."""
    streams = collections.defaultdict(set)
    bodies = collections.defaultdict(set)
    parsed = {}
    for i, url, html in rows:
        host = (url or "").partition("://")[2].split("/")[0].lower()
        texts, states, words, owner = divide(html)
        parsed[i] = host, texts, states, words, owner
        body = tuple(texts), tuple(words)
        bodies[host].add(body)
        for k in range(len(words) - run + 1):
            streams[host, tuple(words[k : k + run])].add(body)
        for k, state in enumerate(states):
            short = " ".join(w for w, o in zip(words, owner) if o == k)
            if state and len(short.split(" ")) < run:
                streams[host, short].add(body)
    out = {}
    for i, (host, texts, states, words, owner) in parsed.items():
        covered = {k + j for k in range(len(words) - run + 1) if len(streams[host, tuple(words[k : k + run])]) >= least for j in range(run)}
        kept = []
        for k, (text, state) in enumerate(zip(texts, states)):
            if not state:
                kept.append(text)
                continue
            own = [j for j, o in enumerate(owner) if o == k]
            gone = len(own) < run and len(streams[host, " ".join(words[j] for j in own)]) >= least
            gone = gone or state == 2 and len(bodies[host]) < least
            kept.append("" if gone else " ".join(words[j] for j in own if j not in covered))
        out[i] = "\n".join(t for t in kept if t)
    return out


def texts_of(spark, rows):
    return {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_html_host_decides_doubtful_blocks(spark):
    share, advice = "share this page with all of your friends today", "this notice tells what only this one article is about and no other"
    footer = "write to the editors of this site for any reason at all"
    rows = []
    for i in range(6):
        inner = f"<p>own text of page {i} here</p><div class='share'>{share}</div><div class='notice'>{advice} {i} {'x' * i}</div>"
        inner += f"<p>{footer}</p>" if i < 3 else ""
        rows.append((i, f"http://h/{i}", f"<head><title>own text of page {i} here</title></head><body><article>{inner}</article><div>{footer}</div></body>"))
    rows.append((9, "http://alone/", "<body><article><p>a</p><div class='share'>b</div></article></body>"))
    got = texts_of(spark, rows)
    assert got == brute(rows, html_text.RUN, html_text.PAGES)
    assert share not in "".join(got.values()) and all(footer in got[i] for i in range(3)) and got[9] == "a"
    assert all(got[i].startswith(f"own text of page {i} here") for i in range(6))


#: Class names of blocks that belong to an article (the first five begin like boilerplate) and of blocks that do not,
#: on a host that has no other page.
KEPT_NAMES = ["search-theory", "comment-on-law", "newsletter-history", "form-factor", "ad-hoc", "adjacent", "story", "lead text"]
LEFT_OUT_NAMES = ["share", "share-buttons", "cookie-notice", "comment-12", "comments", "ad-300x250", "story sidebar-left", "search_box", "notice"]


def random_tree(rng, depth, word):
    """``(tag, class, children)`` of block elements; leaves are texts."""
    if depth == 0 or rng.random() < 0.25:
        return (rng.choice(["p", "h2", "li"]), "", [" ".join(f"w{next(word)}" for _ in range(rng.integers(1, 12)))])
    tag = rng.choice(["div", "section", "blockquote", "article", "header", "nav", "aside", "footer", "form"], p=[0.3, 0.15, 0.1, 0.1, 0.1, 0.05, 0.05, 0.05, 0.1])
    name = rng.choice(["", *KEPT_NAMES, *LEFT_OUT_NAMES], p=[0.5, *[0.25 / len(KEPT_NAMES)] * len(KEPT_NAMES), *[0.25 / len(LEFT_OUT_NAMES)] * len(LEFT_OUT_NAMES)])
    return (tag, "" if tag == "article" else name, [random_tree(rng, depth - 1, word) for _ in range(rng.integers(1, 4))])


def as_html(node):
    return node if isinstance(node, str) else f"<{node[0]}" + (f' class="{node[1]}"' if node[1] else "") + f">{''.join(map(as_html, node[2]))}</{node[0]}>"


def main_texts(node, in_article):
    """Texts of the tree that stand in an article and under nothing that is left out."""
    if isinstance(node, str):
        return [node] if in_article else []
    tag, name, children = node
    if tag in ("nav", "aside", "footer", "form") or tag == "header" and not in_article or name in LEFT_OUT_NAMES:
        return []
    if name in KEPT_NAMES[:5] and not in_article:  # an article under a name that begins like boilerplate is no mark
        return []
    return [t for child in children for t in main_texts(child, in_article or tag == "article")]


def test_html_markup_equals_the_tree():
    rng = np.random.default_rng(12)
    for _ in range(400):
        word = itertools.count()
        body = [random_tree(rng, 4, word) for _ in range(3)]
        body.insert(int(rng.integers(0, 4)), ("article", "", [("p", "", ["always here"]), random_tree(rng, 4, word)]))
        texts, states, _, _ = divide("<html><body>" + "".join(map(as_html, body)) + "</body></html>")
        assert [t for t, state in zip(texts, states) if state != 2] == [t for node in body for t in main_texts(node, False)]


def test_html_no_word_of_a_name_drops_main_text(spark):
    def page(name, i, text):
        own = " ".join(f"own{i}x{k}" for k in range(30))
        return own, f"<body><article><p>{own}</p><div class='{name}'>{text}</div></article></body>"

    repeated, alone = "get our letter every day of the week for free", "a text that only this page of the host has in it"
    cases = [(i, f"http://h{i}/", name, alone, True) for i, name in enumerate(KEPT_NAMES)]
    cases += [(100 + i, "http://three/", "newsletter-plus", repeated, False) for i in range(3)] + [(103, "http://three/", "newsletter-plus", alone, True)]
    cases += [(200 + i, "http://two/", "newsletter-plus", repeated, True) for i in range(2)]
    rows, want = [], {}
    for i, url, name, text, stays in cases:
        own, html = page(name, i, text)
        rows.append((i, url, html))
        want[i] = f"{own}\n{text}" if stays else own
    got = texts_of(spark, rows)
    assert got == want and got == brute(rows, html_text.RUN, html_text.PAGES)


def test_html_near_copies_without_marks_stay(spark):
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(5000)]
    body = list(rng.choice(words, 200))
    rows = [(i, f"http://h/{i}", "<body><p>" + " ".join([*body[:150], f"n{i}", *body[150:]]) + "</p></body>") for i in range(6)]
    got = texts_of(spark, rows)
    assert all(got[i].split(" ") == [*body[:150], f"n{i}", *body[150:]] for i in range(6))


def test_html_repeated_runs_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(400)]
    boiler = [" ".join(rng.choice(words, 15)) for _ in range(3)]
    rows = []
    for i in range(40):
        own = [" ".join(rng.choice(words, rng.integers(5, 30))) for _ in range(3)]
        parts = [f"<p>{p}</p>" for p in (boiler[i % 3], own[0], own[1], boiler[(i + 1) % 3][: 60], own[2])]
        rows.append((i, f"http://host{i % 2}.x/{i}", "<body>" + "".join(parts) + "</body>"))
    rows += [(100, None, None), (101, "http://host0.x/", "")]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == brute(rows, html_text.RUN, html_text.PAGES)


def test_html_odd_pages(spark):
    long = " ".join(f"t{k}" for k in range(60_000))
    rows = [(1, "http://h/", f"<article><p>{long}</p></article>"), (1, "http://h/", f"<article><p>{long}</p></article>"), (2, "x", "<p>a<p>b</div></p><b>c"), (3, "x", "<article><ul><li>a<li>b</article>c")]
    schema = "page_id long, url string, html string, row long, host string, text string, page string"
    got = html_text.extract(spark.createDataFrame([(*r, 1, "h", "t", "p") for r in rows], schema)).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(1, long), (1, long), (2, "a\nb\nc"), (3, "a\nb")]
    assert got[0].__fields__ == ["page_id", "url", "text", "n_chars"]


def test_html_on_the_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = html_text.extract(pages).collect()
    want = brute([(r.page_id, r.url, r.html) for r in pages.collect()], html_text.RUN, html_text.PAGES)
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
    for r in pages.collect():  # what these pages mark, taken out by hand
        marked = re.sub(r"</?b>", "", re.search("(?s)<article>(.*)</article>", r.html)[1]).replace("<br>", " ")
        blocks_ = (" ".join(unescape(x).split()) for x in re.split("</?(?:p|h1)>", marked))
        assert want[r.page_id] == "\n".join(x for x in blocks_ if x)
    assert html_text.extract(pages.limit(0)).count() == 0


def linked(ids, x, threshold):
    x = np.asarray(x, dtype=np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    a = x @ x.T >= threshold
    np.fill_diagonal(a, False)
    label = local_components(len(x), *np.nonzero(a))
    return {i: (int(n), ids[c]) for i, n, c in zip(ids, a.sum(axis=1), label)}


@pytest.mark.parametrize("threshold, cell_rows", [(0.9, 12_000), (0.8, 60), (0.7, 25)])
def test_vectors_equal_all_pairs(spark, threshold, cell_rows):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((80, 40))
    x = np.vstack([centre + 0.4 * rng.standard_normal(centre.shape) for _ in range(4)] + [centre[:5]] * 3).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, threshold, cell_rows).collect()}
    assert got == linked(list(range(len(x))), x, threshold)


def test_vectors_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (7, [1.0, 0.0]), (8, [3.0, 0.0]), (8, [2.0, 0.0]), (None, [1.0, 0.0]), (9, [1.0]), (10, [1e-30, 0.0]), (11, [3e38, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, n_links string")
    got = near_duplicates(df).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.vec_id].append((r.n_links, r.component_id))
    assert all(by[k] == [(0, k)] for k in (1, 2, 3, 4, 5, 6, 9)) and by[None] == [(0, None)]
    assert by[7] == [(4, 7)] and by[8] == [(4, 7), (4, 7)] and by[10] == [(4, 7)] and by[11] == [(4, 7)]
    assert near_duplicates(df.limit(0)).count() == 0


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, now = docs.columns, docs
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == columns, name
        counts.append(now.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > counts[0] / 2
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).collect()
    check_packing(now.collect(), packed)
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    key = lambda r: (r.doc_id, r.start, r.length, bytes(r.ids))
    assert sorted(r.doc_id for r in whole) and {k[0] for k in map(key, whole)} == {k[0] for k in map(key, packed)}
