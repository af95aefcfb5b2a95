"""Page, vector and graph operators, and the pipeline's stages."""

import collections
import random

import numpy as np
import pytest

from marisnow.llm import html, topk, urlfilter
from marisnow.llm.components import connected_components


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(1000 + i, 2000) for i in range(50)] + [
        (5000 + i, 5001 + i) for i in range(40)] + [(7, 7), (None, 3)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == {(x, find(x)) for x in up} and len(got) == len(up)
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("skew", [False, True])
def test_top_k_brute_force(spark, skew):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 12)) * (np.r_[8, 4, np.full(10, 0.2)] if skew else 1) * rng.uniform(0.2, 2, (600, 1))
    x[50:120] = x[50]  # ties
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(700, None), (701, [1.0, None]), (702, [float("nan")]),
                                                                    (703, [float("inf")]), (704, []), (705, [0.5]), (None, [1.0])]
    df = spark.createDataFrame([(i, v, "z") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = topk.top_k(df, df.filter("vec_id % 20 = 0"), k=7).collect()
    whole = {i: np.array([*np.floor(1024 * np.array(v)), *[0] * (12 - len(v))]).astype(np.int64) for i, v in rows
             if i is not None and v is not None and all(y is not None and np.isfinite(y) for y in v)}
    want = set()
    for q in (i for i in whole if i % 20 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:7]
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_cells_skip_but_lose_nothing():
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(400, 8)) * [900, 300, 20, 20, 9, 9, 5, 5]).astype(np.int64)
    order = np.argsort(-np.linalg.norm(x, axis=1))
    ids = np.arange(400)[order]
    blocks = [(ids[i:i + 50], x[order][i:i + 50], float(np.linalg.norm(x[order][i]))) for i in range(0, 400, 50)]
    basis = np.linalg.eigh((x.T @ x).astype(float))[1][:, ::-1]
    n, vec, score = topk.cell(np.array([3, 9]), x[[3, 9]], np.full(2, -np.inf), blocks, basis, 5)
    for k, q in enumerate((3, 9)):
        want = sorted((-int(x[q] @ x[i]), i) for i in range(400) if i != q)[:5]
        assert [(-s, i) for s, i in zip(score[n == k].tolist(), vec[n == k].tolist())] == want


PAGE = ("<html><head><title>T</title><style>x</style></head><body><nav><ul><li><a>Home</a></li></ul></nav>"
        "<div class='ad'>Buy now, a long advert that is longer than the rest of the page, buy it now now now.</div>"
        "{open}<h1>Head &amp; line</h1><p><b>First</b>  part<br>second&nbsp;part {long}</p><script>var t='</p>';</script>"
        "<p>Last.</p><div id='comments'><p>I like it, I like it very much indeed, all of it.</p></div>{close}"
        "<footer>&copy; us</footer>")


def test_main_text(spark):
    long = "word " * 40
    body = f"Head & line First part second part {long.strip()} Last."
    marked = PAGE.format(open="<article>", close="</article>", long=long)
    plain = PAGE.format(open="<div>", close="</div>", long=long)
    assert html.main_text(marked) == body
    assert html.main_text(plain).startswith("Head & line First part") and "like it" not in html.main_text(plain)
    rows = [(1, marked, "u"), (2, None, "u"), (3, "", "u"), (4, "<nav>x</nav>", "u"), (5, marked, "u"), (5, marked, "u"),
            (6, "<article><p>" + "long text " * 50000, "u"), (7, "<p <a href=\"x <!-- y", "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract(df).collect()}
    assert got[1] == (body, len(body)) == got[5] and got[2] == got[3] == got[4] == ("", 0) and got[6][1] > 400000
    assert html.extract(df).columns == ["page_id", "text", "n_chars"] and html.extract(df.limit(0)).count() == 0


def test_an_article_element_does_not_replace_the_windows():
    body = "A paragraph of the body that is long enough to make the window's sum surge over the threshold. " * 3
    card = "<div class='cards'><article><p>Another story</p></article></div>"
    text = html.main_text(f"<nav>x</nav><div><h1>Title</h1><p>{body}</p><p>{body}</p></div>{card}<footer>f</footer>")
    assert text.startswith(" ".join(f"Title {body} {body}".split()))
    # a kept line of an article brings the article's other lines, furniture excepted
    gap = "<nav><p>a</p><p>b</p><p>c</p><p>d</p></nav>"
    page = f"<article><p>{body}</p>{gap}<p>End.</p></article>{gap}<p>Off.</p>{gap}"
    assert html.main_text(page) == " ".join(f"{body} End.".split())


def test_short_lines_beside_the_text_stay():
    long = "word " * 40
    plain = PAGE.format(open="<div>", close="</div>", long=long)
    assert html.main_text(plain) == f"Head & line First part second part {long.strip()} Last."
    page = "<div><p>" + "</p><p>".join(["x" * 11, "x" * 230, "x" * 5]) + "</p></div><footer>f</footer><footer>g</footer>"
    assert [len(x) for x in html.main_text(page).split()] == [11, 230, 5]
    assert html.main_text("<nav>n</nav><p>One.</p><p>Two.</p><footer>f</footer>") == "One. Two."
    assert html.kept_lines([9, 0, 0, 0, 90, 0, 0, 4, 4, 0, 0, 0, 4], 3, 86) == [
        False, False, False, False, True, False, False, True, True, False, False, False, False]
    assert html.kept_lines([], 3, 86) == [] and html.kept_lines([0, 0], 3, 86) == [False, False]


def test_url_verdicts_and_aliases(spark):
    page = lambda to: f'<html><link rel="canonical" href="{to}"><p>x</p>'
    rows = [(1, "http://a.example.net/es/1", None), (2, "http://b.example.org/x", page("http://a.example.net/es/1#f")),
            (3, "http://c.example.org/y/z", '<meta http-equiv="refresh" content="0; url=http://b.example.org/x">'),
            (4, "http://www.example.com/en/1", page("http://a.example.net/es/1")), (5, "http://d.example.org/", "<p>x</p>"),
            (6, None, None), (7, "no scheme", ""), (8, "HTTP://EXAMPLE.com/en/?q", None), (9, "http://example.com/x#y", None),
            (10, "http://e.example.org/k/", "<script>window.location = '/m'</script>"), (11, "http://e.example.org/m", ""),
            (11, "http://e.example.org/m", ""), (12, "http://x.com", None), (13, "http://f.org/", None)]
    df = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, rule string")
    extra = spark.createDataFrame([("http://f.org", "http://g.net/fr/9")], "src string, dst string")
    got = collections.Counter((r.page_id, r.host, r.rule, r.verdict) for r in urlfilter.judge(df, extra).collect())
    want = [(1, "a.example.net", "net/es/", "block"), (2, "b.example.org", None, "block"), (3, "c.example.org", None, "block"),
            (4, "www.example.com", "www.example.com/en/", "allow"), (5, "d.example.org", None, "allow"), (6, "", None, "allow"),
            (7, "", None, "allow"), (8, "example.com", "example.com/en/", "block"), (9, "example.com", "com/", "allow"),
            (10, "e.example.org", None, "allow"), (11, "e.example.org", None, "allow"), (11, "e.example.org", None, "allow"),
            (12, "x.com", None, "allow"), (13, "f.org", None, "block")]
    assert got == collections.Counter(want)
    assert urlfilter.judge(df.limit(0)).count() == 0


def test_pipeline_stages_on_a_small_table(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES[1:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf).count() == 0
    last = P.encode(spark, docs, sf)
    assert last.filter("not lossless").count() == 0 and last.count() == docs.count()
    assert P.drop_toxic(spark, docs, sf).columns == docs.columns
