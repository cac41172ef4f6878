"""Page text and exact top-k against plain Python and SQL."""
import html as entities
import random

import numpy as np
import pytest
from llm_samples import SF, folder, table  # noqa: F401
from pyspark.sql import functions as F
from test_text_operators import same_as_sql

from haulmark.llm import page_dom, page_text, topk


def kept(html):
    blocks, _ = page_dom.parse(html)
    best = max((b[1] for b in blocks), default=0)
    return [b[2] for b in blocks if b[1] == best]


@pytest.mark.parametrize("html, expected", [
    (None, []), ("", []), ("plain  text\n only", ["plain text only"]), ("<p>a<p>b", ["a", "b"]), ("<p>a &lt;b&gt; &amp;amp; &#233; &copy</p>", ["a <b> &amp; é ©"]),
    ("<article><h1>T</h1><p>x<br>y</p></article>", ["T", "x y"]),
    ("<article><p>a <b>b</b>c<i>d</i></p><aside>no</aside><p>e</p></article><p>out</p>", ["a bcd", "e"]),
    ("<nav>m</nav><div class='ad'>x</div><main><p>in</p><form><input><label>f</label></form></main><footer>f</footer>", ["in"]),
    ("<article>a<div class='comments'><article>c</article></div></article>", ["a"]),
    ("<form id=f><article><p>page-wide form</p></article></form>", ["page-wide form"]),
    ("<nav>menu<article><p>unclosed menu</p></article>", ["unclosed menu"]),
    ("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>", ["one", "two", "a", "b", "c"]),
    ("<script>if (a < b) '<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", ["yes"]),
    ("<div hidden>no</div><div style='display: none'>no</div><div role='dialog'>no</div><div aria-hidden=true>no</div><p>yes</p>", ["yes"]),
    ("<header>site</header><article><header><h1>T</h1></header>x</article>", ["T", "x"]),
    ("<div class='cookieNotice'>no</div><div id='site-sidebar2'>no</div><div class='post-content'>yes</div><div>else</div>", ["yes"]),
    ("<div class='has-sidebar with-comments'><p>yes</p></div><div class='side-bar'>no</div><div id='sideBar'>no</div>", ["yes"]),
    ("<p>a<script>x</script>b <span class='ad'>no</span>c</p>", ["ab c"]), ("<article><p>open", ["open"]), ("</div></p><p>x</b></p>", ["x"]),
])
def test_blocks(html, expected):
    assert kept(html) == expected


@pytest.mark.parametrize("html, expected", [
    ("<article class='post tag-social category-notices'><p>a</p></article><div>no</div>", ["a"]),
    ("<article id='comments'><p>a</p></article>", ["a"]), ("<div role='main' class='widget'><p>a</p></div><p>no</p>", ["a"]),
    ("<div class='content-sidebar-wrap'><main><article><p>a</p></article></main></div><footer>no</footer>", ["a"]),
    ("<div class='sidebar'><main><article><p>a</p></article></main></div><div>no</div>", ["a"]),
    ("<a id='skip'><main class='notice'><p>a</p></main>", ["a"]), ("<form class='search'>no<article>a</article></form>", ["a"]),
    ("<div class='page-header'><h1>no</h1><article><p>a</p></article></div>", ["a"]),
    ("<article><h2 id='discussion'>a</h2><h2 id='social-media'>b</h2><section id='discussion'><p>c</p></section></article>", ["a", "b", "c"]),
    ("<main><p class='notice'>a</p><ul><li id='related'>b</ul><blockquote class='reply'>c</blockquote><table><tr><td class='comment'>d</table></main>", list("abcd")),
    ("<article><div class='social-history'><p>a</p></div><div class='share-buttons'>no</div><p>b</p></article>", ["a", "b"]),
    ("<article><p>a</p><div class='related'><article>no</article></div></article>", ["a"]),
    ("<article>a</article><div class='related-posts'><article>no</article></div>", ["a"]),
    ("<div class='post-content'><h3 id='discussion'>a</h3>b</div>", ["a", "b"]), ("<div id='sidebar'><p>all there is</p></div>", ["all there is"]),
])
def test_names_do_not_take_the_article(html, expected):
    assert kept(html) == expected


def page(i, rng, host, article=True):
    text = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta".split()) + str(rng.randrange(99)) for _ in range(rng.randrange(3, 30))) for _ in range(4)]
    body = "".join(f"<p>{t}</p>" for t in text)
    body = f"<article>{body}<div class='box{i}'><p>The same words on all pages of this site.</p></div></article>" if article else \
        f"<div class='x'>{body}</div><div class='y'><p>The same words on all pages of this site.</p></div>"
    return i, f"http://{host}/{i}", f"<html><head><title>t</title></head><body><nav><a>m{i}</a></nav>{body}<footer>&copy; {i}</footer></body></html>", text


@pytest.mark.parametrize("article", [True, False])
def test_repeated_branches_go(spark, folder, article):  # noqa: F811
    rng = random.Random(2)
    pages = [page(i, rng, "a.example", article) for i in range(12)] + [page(50, rng, "rare.example", article)]
    out = {r.page_id: r.text for r in page_text.main_text(spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")).collect()}
    for i, _, _, text in pages[:12]:
        assert out[i] == "\n".join(text)
    assert out[50] == "\n".join([*pages[-1][3], "The same words on all pages of this site."])  # one page tells nothing


def test_entropy_decides_doubtful_names(spark, folder):  # noqa: F811
    rows = [(i, "http://n.example/", f"<article><p>story {i}</p><div class='social-history'><p>part {i}</p></div>"
             f"<div class='my-sidebar-text'><p>same</p></div></article>") for i in range(6)]
    out = page_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {i: f"story {i}\npart {i}" for i, _, _ in rows}


@pytest.mark.parametrize("note", ["<p>Share this story.</p>", "<ul><li>Share this story.</li></ul>"])
@pytest.mark.parametrize("around", ["article", "main", "div"])
def test_repeated_lines_of_articles_go(spark, folder, note, around):  # noqa: F811
    rows = [(i, "http://lines.example/", f"<{around}><h1>Title {i}</h1><p>first words of {i}</p>{note if i else ''}<p>more words of {i}</p></{around}>")
            for i in range(20)]
    rows += [(100 + i, "http://lines.example/", rows[5][2]) for i in range(30)]  # one story copied whole, with its line
    rows += [(200 + i, "http://quotes.example/", f"<article><p>own {i}</p>{'<p>a quoted line</p>' if i < 5 else ''}</article>") for i in range(20)]
    out = {r.page_id: r.text for r in page_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in [*range(20), *range(100, 130)]:
        n = i if i < 100 else 5
        assert out[i] == f"Title {n}\nfirst words of {n}\nmore words of {n}"
    assert all(out[200 + i] == f"own {i}" + ("\na quoted line" if i < 5 else "") for i in range(20))  # few pages share it


def test_short_pages_lose_long_notices(spark, folder):  # noqa: F811
    notice = " ".join(f"n{k}" for k in range(100))
    own = {i: " ".join(f"w{i}x{k}" for k in range(60 if i % 2 else 300)) for i in range(10)}
    rows = [(i, "http://short.example/", f"<body><div class='x'><p>{t}</p></div><div class='y'><p>{notice}</p></div></body>") for i, t in own.items()]
    rows += [(20, "http://short.example/", f"<body><div class='y'><p>{notice}</p></div></body>")]  # nothing of its own
    out = {r.page_id: r.text for r in page_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {**own, 20: ""}


def test_shared_articles_stay(spark, folder):  # noqa: F811
    html = "<body><article><p>A story that ten pages carry.</p></article></body>"
    rows = [(i, "http://copies.example/x", html) for i in range(10)]
    out = page_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r.text for r in out] == ["A story that ten pages carry."] * 10


def test_page_odd_rows(spark, folder):  # noqa: F811
    rows = [(1, None, None), (None, "u", ""), (2, "http://x", "<p>a</p>"), (2, "http://x", "<p>a</p>"), (3, "no url", "<p>" + "word " * 50000 + "</p>"), (4, "HTTPS://U:p@Host.Example:8/x", "<b>\U0001f600")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("text", "host", "blocks", "branches", "cut", "best")})
    out = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in page_text.main_text(df).collect()), key=repr)
    expected = [(i, u, "\n".join(kept(h)), len("\n".join(kept(h)))) for i, u, h in rows]
    assert out == sorted(expected, key=repr)
    assert page_text.main_text(df.limit(0)).collect() == []
    assert df.select(page_text.host_of(F.col("url")).alias("h")).filter("page_id = 4").collect()[0].h == "host.example"


def test_pages_hold_their_articles(spark, folder):  # noqa: F811
    rows = {r["page_id"]: r["html"] for r in table("pages")}
    for r in page_text.main_text(spark.read.parquet(f"{SF}/pages.parquet")).collect():
        article = rows[r.page_id].split("<article>")[1].split("</article>")[0]
        for tag in ("h1", "p", "b", "br", "/h1", "/p", "/b"):
            article = article.replace(f"<{tag}>", " " if tag != "b" and tag != "/b" else "")
        assert r.text.split() == entities.unescape(article).split()


def test_pages_equal_sql(spark, folder):  # noqa: F811
    same_as_sql(page_text.main_text(spark.read.parquet(f"{SF}/pages.parquet")), page_text.SQL)


# ---------------------------------------------------------------- vectors
def test_topk_equals_sql(spark, folder):  # noqa: F811
    v = topk.quantised(spark.read.parquet(f"{SF}/embeddings.parquet"), "vec_id", "embedding")
    same_as_sql(topk.top_k(v, v.filter(F.col("vec_id") % 100 == 0)), topk.brute_sql())


def brute(rows, asked, k):
    out = []
    for q, x in asked:
        best = {}
        for i, y in rows:
            if i != q and len(x) == len(y):
                best[i] = max(best.get(i, -10**30), sum(a * b for a, b in zip(x, y)))
        out += [(q, n + 1, i, s) for n, (i, s) in enumerate(sorted(best.items(), key=lambda t: (-t[1], t[0]))[:k])]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_topk_equals_brute_force(spark, folder, seed, monkeypatch):  # noqa: F811
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(topk, "BUCKET_ROWS", 50)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    centres = rng.normal(size=(5, 8))
    rows = []
    for i in range(300):
        x = (centres[i % 5] + 0.2 * rng.normal(size=8)) * rng.choice([0.01, 1, 1, 30])
        rows.append((i, (x if i % 11 else centres[0]).tolist()))
    rows += [(300, [0.0] * 8), (301, [-1.0] * 8), (302, [1.0] * 3), (303, [0.5] * 3)]
    v = topk.quantised(spark.createDataFrame(rows, "id long, e array<double>"), "id", "e")
    ints = [(i, [int(np.floor(1024 * a)) for a in x]) for i, x in rows]
    asked = [r for r in ints if r[0] % 10 == 0 or r[0] > 299]
    out = topk.top_k(v, v.filter((F.col("vec_id") % 10 == 0) | (F.col("vec_id") > 299)), k=4)
    assert sorted(map(tuple, out.collect())) == sorted(brute(ints, asked, 4))


def test_topk_odd_rows(spark, folder):  # noqa: F811
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [None, 1.0]), (None, [9.0, 9.0]), (6, [1e12, 1e12]),
            (7, [1e17, 1.0]), (8, []), (9, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("v", "dim", "norm", "score", "rank", "label")})
    v = topk.quantised(df, "vec_id", "embedding")
    out = sorted(map(tuple, topk.top_k(v, v.filter("vec_id = 0"), k=3).collect()))
    top = 2**63 - 1
    assert out == [(0, 1, 7, int(np.floor(1024 * 1e17)) * 1024 + 1024 * 2048 if 1024e17 * 1024 < top else top), (0, 2, 6, 1024 * 10**12 * 3072), (0, 3, 1, 4 * 1024**2)]
    assert topk.top_k(v.limit(0), v.limit(0)).collect() == []
