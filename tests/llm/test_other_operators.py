"""Vectors, pages, conversations, the registry and the pipeline."""

import time

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm import chat, html_text, packing, queries, srs


def brute_nearest(rows, size, k):
    ok = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and len(v) == size and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    for i, q in ok:
        if i % 20 == 0:
            scores = sorted((-float(np.dot(np.array(q, float), np.array(v, float))), j) for j, v in ok if j != i)
            yield i, [(j, -s) for s, j in scores[:k]]


@pytest.mark.parametrize(("shard", "sample", "block"), [(2048, 4096, 8192), (40, 64, 4)])
def test_nearest(spark, monkeypatch, shard, sample, block):
    monkeypatch.setattr(srs, "SHARD", shard)
    monkeypatch.setattr(srs, "SAMPLE", sample)
    monkeypatch.setattr(srs, "QUERIES", block)
    r = np.random.default_rng(2)
    x = r.standard_normal((300, 8)).astype(np.float32) * r.uniform(0.2, 3, size=(300, 1)).astype(np.float32)
    rows = [(k, [float(v) for v in x[k]]) for k in range(300)]
    rows += [(300 + k, rows[5][1]) for k in range(60)] + [rows[0], (400, None), (420, [0.0] * 8), (440, [1.0, None] + [0.0] * 6), (460, [float("nan")] * 8), (480, [1.0] * 5), (None, rows[1][1]), (500, [float("inf")] * 8), (520, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for g in srs.nearest(df, F.col("id") % 20 == 0, k=20).collect():
        got.setdefault(g.query_id, []).append((g["rank"], g.vec_id, g.score))
    want = dict(brute_nearest(rows, 8, 20))
    assert set(got) == set(want)
    hits = 0
    for q, top in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        assert all(a[2] > b[2] - 1e-12 and (a[2] != b[2] or a[1] < b[1]) for a, b in zip(mine, mine[1:]))
        hits += len({m[1] for m in mine} & {t[0] for t in top})
    assert hits >= 0.95 * 20 * len(want)


@pytest.mark.parametrize("clustered", [True, False])
def test_nearest_verifies_few_of_clustered_vectors(spark, small, clustered):
    """Share of pairs verified, and recall: on clusters most are pruned, on the test table's vectors few can be."""
    r = np.random.default_rng(3)
    if clustered:
        x = (r.standard_normal((40, 64))[r.integers(0, 40, size=4000)] + 0.1 * r.standard_normal((4000, 64))).astype(np.float32)
    else:
        x = np.array([v.embedding for v in spark.read.parquet(f"{small}/../sf0.1/embeddings.parquet").orderBy("vec_id").collect()], dtype=np.float32)
    projection = srs.Projection(64, float(np.linalg.norm(x.astype(float), axis=1).max()), 8, 11)
    rows = pd.DataFrame({"id": np.arange(len(x)), "vec": [v.tobytes() for v in x], "kth": -np.inf})
    counted = []
    got = srs.search_shard(rows[::20], rows, projection, 21, srs.chi_square_bound(8, 0.9), counted)
    share = sum(counted) / (len(rows[::20]) * len(rows))
    scores = x[::20].astype(float) @ x.T.astype(float)
    hits = sum(len(set(g.vec_id) & set(np.argsort(-scores[q // 20], kind="stable")[:21].tolist())) for q, g in got.groupby("query_id"))
    recall = hits / (21 * len(scores))
    assert recall >= 0.9 and (share < 0.2 if clustered else share <= 1), (share, recall)


def test_ids_with_several_vectors_count_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.0]), (1, [1.0, 1.0]), (2, [3.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0])]
    got = srs.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 2, 1.0), (0, 2, 1, 0.5)]


def test_nearest_with_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert srs.nearest(spark.createDataFrame([], schema), F.col("id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0])], schema)
    assert [(r["rank"], r.vec_id, r.score) for r in srs.nearest(few, F.col("id") % 20 == 0).orderBy("rank").collect()] == [(1, 2, 1.0), (2, 1, 0.5)]
    assert srs.nearest(few.limit(1), F.col("id") % 20 == 0).count() == 0


def test_chi_square_bound():
    r = np.random.default_rng(0)
    assert np.mean((r.standard_normal((100_000, 16)) ** 2).sum(axis=1) <= srs.chi_square_bound(16, 0.95)) == pytest.approx(0.95, abs=0.005)


PAGE = """<!DOCTYPE html><html><head><title>No &amp; no</title><style>p{}</style><script>var t="<p>no</p>";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href="/a">One</a></li><li>Two</li></ul></nav><!-- ad > --><div class="ad">Buy these twelve wonderful things now before all of them are gone for ever.</div>
<article><h1>A&nbsp;title &amp; more</h1><p>First <b>bold</b>  para\ngraph.<br>Second line.<p>Short<p>Tail &lt;x&gt; 1 &#38; 2</p>
<div class="comments"><p>I think that this article is really very good and everyone should read it.</p></div></article>
<aside>Related things to read and more of them here too</aside><form><input name=q><p>Search our whole archive of pages</p></form><footer>&copy; 2024 Nobody at all in this small town</footer></body></html>"""


def test_main_text(spark):
    long = "<article>" + "<p>" + "word " * 50_000 + "</p></article>"
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<p", "x"), (5, "u", long, "x"), (1, "u", PAGE, "x"), (None, "u", "<div class='ad'>only", "x")]
    out = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    got = {r.page_id: r for r in out.collect()}
    assert out.count() == 7 and out.columns == ["page_id", "url", "text", "n_chars"]
    assert got[1].text == "A title & more First bold para graph. Second line. Short Tail <x> 1 & 2"
    assert got[1].n_chars == len(got[1].text) and [got[k].text for k in (2, 3, 4, None)] == ["", "", "", ""] and got[5].n_chars == 249_999
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_unmarked_pages(spark):
    body = "<div><a href=a>Home</a> <a href=b>News</a></div><h2>The headline</h2><p>" + "plain words of an article " * 12 + "</p><p>" + "and yet more of them here " * 9 + "</p><div><a href=x>Next page</a></div>"
    text = html_text.main_text(spark.createDataFrame([(1, "u", body)], "page_id long, url string, html string")).first().text
    assert text.startswith("The headline plain words") and text.endswith("of them here") and "Next" not in text


def test_named_elements(spark):
    body = """<body class="page-sidebar"><div class="site-header"><p>The daily news of our small town</p></div><div id="content" class="has-sidebar no-comments">
    <h1>Title</h1><p>A short line.<p class="ad">Buy it now and pay much later than you think<p>Goes on.<br>And on.</p><ul><li>One item of it<li class='promo-box'>Join us</ul>
    <div hidden><p>Unseen words that nobody reads</p></div><section role="complementary"><p>Elsewhere on this site there is more</p></section><p>The end.</p></div>
    <div class="cookie-consent"><p>We use cookies to make this site better for all of you</p></div></body>"""
    text = html_text.main_text(spark.createDataFrame([(1, "u", body)], "page_id long, url string, html string")).first().text
    assert text == "Title A short line. Goes on. And on. One item of it The end."


def test_words_and_links_decide_where_no_name_does(spark):
    pages = {
        1: "<body><p>One short para.</p><p>Two short para.</p><p>Three short.</p></body>",
        2: "<article><h1><a href=a>A linked heading</a></h1><p><a href=b>A wholly linked paragraph of the text</a></p><p>And one without.</p></article>",
        3: "<article><p>Before it.</p><div class='search-results-story'><p>A block of the article that has an odd name</p></div></article><div class='search-box'>Type here</div>",
        4: "<ul><li><a href=a>Home</a><li><a href=b>News</a></ul><h2>Short news</h2><p>It rains.</p><p>It has rained for three days now.</p><ul><li><a href=c>More</a></ul>",
        5: "<div><a href=a>One</a> <a href=b>Two</a></div><div><a href=c>Three</a></div><div><a href=d>Four of it</a></div>",
        6: "<div class='entry-title'>A title</div>" + "<p>" + "many words of the article " * 9 + "</p><p>Few words.</p>",
    }
    want = {
        1: "One short para. Two short para. Three short.", 2: "A linked heading A wholly linked paragraph of the text And one without.",
        3: "Before it. A block of the article that has an odd name", 4: "Short news It rains. It has rained for three days now.", 5: "",
        6: "A title " + ("many words of the article " * 9) + "Few words.",
    }
    got = html_text.main_text(spark.createDataFrame(list(pages.items()), "page_id long, html string"))
    assert {r.page_id: r.text for r in got.collect()} == want


def test_dropped_elements_end_with_their_containers():
    said = lambda html: [b[0] for b in html_text.blocks(html)]
    two = "<p>Two long paragraph</p>"
    assert said(f'<p>One</p><svg class="i"/>{two}') == ["One", "Two long paragraph"]
    assert said(f'<p>One<svg class="i"/> more</p>{two}<svg><path d="M0"/></svg>') == ["One more", "Two long paragraph"]
    assert said(f'<p>One</p><div><svg class=i/><path d="M0"></div>{two}') == ["One", "Two long paragraph"]
    assert said(f"<p>One</p><svg><title/><g><text>no</text></g></svg>{two}<title>no</title>") == ["One", "Two long paragraph"]
    for name in ("button", "select", "canvas", "object", "noscript", "template", "svg"):
        assert said(f"<p>One</p><div><{name}>no<g>no</g></div>{two}") == ["One", "Two long paragraph"], name
        assert said(f"<p>One <{name} x>no</p>{two}<div><{name}>no</{name}> end</div>") == ["One", "Two long paragraph", "end"], name
        assert said(f"<p>One <{name}><div><p>no</p></div>no</{name}>more</p>{two}") == (["One more", "Two long paragraph"] if name != "svg" else ["One", "no", "no", "more", "Two long paragraph"]), name
    assert said(f"<p>One <span><button>no</span> more</p>{two}<button>no<button>no</button>") == ["One more", "Two long paragraph"]
    assert said("<p>One</p><!-- > no") == said("<p>One</p><!-- no") == ["One"] and said("<p>One</p> a <b") == ["One", "a <b"]
    assert said(f"<p>One</p><script>if (a < b) '</div>'{two}") == ["One"]


def test_articles_are_whole_and_comments_go(spark):
    """Readers' comments, articles themselves or not, go; lists, short last blocks and linked items of an article stay."""
    words = "plain words of the article " * 6
    pages = {
        f"<article><p>{words}</p><article class='comment'><p>I think that this is very good</p></article><div class='user-review'><p>Five stars of five from me</p></div><p>The end.</p></article>": f"{words}The end.",
        f"<article class='post has-comments'><p>{words}</p><section itemprop='comment'><p>Well said by all of you</p></section></article>": words.strip(),
        f"<article><p>{words}</p><ul><li>One entry of it</li><li>x</li></ul></article>": f"{words}One entry of it x",
        f"<article><p>{words}</p><ul><li><a href=a>First linked entry</a></li><li><a href=b>Second linked entry</a></li></ul><p>More of it.</p></article>": f"{words}First linked entry Second linked entry More of it.",
        f"<div>{words}</div><div>The second of these three paragraphs.</div><div>Third one short.</div>": f"{words}The second of these three paragraphs. Third one short.",
        f"<div>{words}</div><div>{words}</div><div>&copy; 2024 Example Press</div>": f"{words}{words}".strip(),
        "<div id='content'>Hi.</div>": "Hi.", f"<main><h1>T</h1><div>{words}</div><p>End</p></main><div>Made in a small town</div>": f"T {words}End",
        f"<nav><li><a href=a>Home</a></nav><div class='post-content'><blockquote>{words}</blockquote><table><tr><td>1</td><td><a href=q>two</a></td></tr></table></div><div class='comments'><article><p>{words}</p></article></div>": f"{words}1 two",
    }
    got = html_text.main_text(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")).orderBy("page_id").collect()
    assert [r.text for r in got] == list(pages.values())


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</section>" * 100_000, "<div>" * 100_000 + "<button>" + "</x>" * 100_000, "<svg>" + "<g>" * 100_000 + "</p>" * 100_000, "<div><b>" * 100_000 + "<button>" + "</i>" * 100_000, "<div><b>" * 50_000 + "</b>" * 50_000 + "</div>" * 50_000])
def test_deep_pages_take_linear_time(page):
    began = time.process_time()
    html_text.blocks(page)
    assert time.process_time() - began < 8


def test_pages_as_a_plain_parser_reads_them(spark, small):
    """The standard library's parser on the whole table: what an article holds outside of scripts and styles, block by block."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.deep, self.off, self.blocks = 0, 0, [""]

        def handle_starttag(self, tag, attrs):
            self.deep += tag == "article"
            self.off += tag in ("script", "style")
            if tag not in ("a", "b", "i", "em", "strong", "span"):
                self.blocks.append("")

        def handle_endtag(self, tag):
            self.deep -= tag == "article"
            self.off -= tag in ("script", "style")
            if tag not in ("a", "b", "i", "em", "strong", "span"):
                self.blocks.append("")

        def handle_data(self, data):
            if self.deep and not self.off:
                self.blocks[-1] += data

    rows = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in queries.op7_html(spark, small).collect()}
    assert got.keys() == rows.keys() and rows
    for page_id, page in rows.items():
        plain = Plain()
        plain.feed(page)
        assert got[page_id] == " ".join(" ".join(b.split()) for b in plain.blocks if b.strip())


def test_long_attributes_stay_out_of_the_text():
    said = lambda html: [b[0] for b in html_text.blocks(html)]
    value = "a > b " * 2000
    assert said(f"""<p>One</p><p data-x="{value}" id='{value}'>Two</p>""") == ["One", "Two"]
    assert said("<p title=5\" wide>One</p><p title=\"6\" wide\">Two \"said\" of it</p>") == ["One", 'Two "said" of it']


def chats():
    turns = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", None), (None, "<|im_end|> x")]
    rows = [(c, t, *turns[t]) for c, n in ((1, 2), (2, 5), (3, 5), (4, 1), (5, 3)) for t in range(n)]
    rows += [(6, 0, "user", "hi"), (6, 1, "assistant", "different"), (7, None, "user", "first"), (7, 3, "user", "hi"), (None, 0, "user", "lost"), rows[0], rows[0]]
    rows += [(8, t, "user", f"long {t}") for t in range(600)] + [(9, t, "user", f"long {t}") for t in range(599)]
    return rows


def test_chat(spark, tmp_path):
    df = spark.createDataFrame(chats(), "conv_id long, turn long, role string, text string").repartition(3)
    assert {r.conv_id for r in chat.maximal(df).collect()} == {2, 6, 7, 8}
    df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(tmp_path / "chats.parquet")
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/chats.parquet'")
        want = c.execute(f"SELECT conv_id, chunk, n_turns, rendered FROM ({chat.ORACLE_SQL})").fetchall()
    got = [(r.conv_id, r.chunk, r.n_turns, r.rendered) for r in chat.chat_format(df.withColumn("chunk", F.lit("x"))).collect()]
    assert sorted(got) == sorted(want)
    assert chat.chat_format(df.limit(0)).count() == 0
    rendered = {r[0]: r[3] for r in got}
    assert rendered[2].endswith("<|im_start|>user\n< |im_end|> x<|im_end|>\n")


def test_native_operators_run_no_python(spark, small):
    for name in ("op5_decontaminate", "op9_chat"):
        plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_registry(spark, small):
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    out = queries.QUERIES["op1_srs"](spark, small)
    assert out.columns[:4] == ["query_id", "rank", "vec_id", "score"] and out.count() == 500


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept, columns, counts = docs, docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, small).cache()
        assert kept.columns == columns, name
        counts.append(kept.count())
    assert counts == sorted(counts, reverse=True) and counts[0] < docs.count() and counts[2] == counts[3]
    packed = corpus_pipeline.run(spark, small)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
    text = kept.agg(F.count_if(F.col("text").rlike('(?i)token = "[0-9a-f]{40}"'))).first()[0]
    assert text == 0
    assert packing.pack(kept, queries.tokenizer_path()).count() == packed.count()
