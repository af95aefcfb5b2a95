"""Columns named like those the operators work with, url resolution and long
texts of span removal."""

import collections
import random
import time

import numpy as np
from pyspark.sql import functions as F

from marisnow.llm import decontam, linededup, secrets, simhash, urlfilter

NAMES = ("_row", "_ROW2", "_doc", "met_row", "met_doc", "line_doc", "line_all", "text_key", "place", "spans", "items", "fp", "utf8")


def clashing(df):
    for c in NAMES:
        df = df.withColumn(c, F.lit("mine"))
    return df.withColumn("N_WORDS", F.lit(1)).withColumn("N_Lines", F.lit(1))


def test_columns_of_the_same_names_pass_through(spark):
    long = "this very line is shared by all of them"
    rows = [(i, f"own words number {i} go here and there\n{long}") for i in range(5)] + [(None, None), (3, "own words number 3 go here and there")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    items = spark.createDataFrame([("a", "words number 2 go here"), ("b", "")], "item_id string, text string")
    for out in (decontam.contamination(docs, items), decontam.decontaminate(docs, items), decontam.decontaminate(docs, items, mode="spans"),
                linededup.dedup_lines(docs), simhash.one_per_group(docs)):
        got = out.collect()
        assert got and all(r[c] == "mine" for r in got for c in NAMES)
        assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert decontam.decontaminate(docs, items).columns == docs.columns
    ledger = secrets.Ledger(spark, urlfilter_path(spark))
    assert all(r["_row"] == "mine" for r in secrets.scan(docs, ledger).collect())


def urlfilter_path(spark):
    from marisnow.session import scratch_path
    return scratch_path(spark, "ledger-test")


def cut_spans(text, hit_words):
    """Cut runs of hit words out of a text, word by word."""
    import re
    word = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
    out, last, before = [], 0, False
    for i, m in enumerate(word.finditer(text)):
        here = i in hit_words
        out.append("" if here and before else text[last:m.start()])
        out.append("" if here else m.group())
        last, before = m.end(), here
    return "".join(out) + text[last:]


def test_span_removal_equals_word_by_word_and_stays_linear(spark):
    rng = random.Random(4)
    items = [("a", " ".join(f"w{i}" for i in range(12))), ("b", "short one")]
    texts = ["Pre W0, w1 w2 w3 w4 w5 w6 w7 w8 w9! W10 w11 -- tail", "Short  ONE, short one. x", "", None, "nothing here"]
    texts += [" ".join(rng.choice(["short", "one", "Other", "é"]) + rng.choice(["", ",", "  "]) for _ in range(60)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    spans = {r.doc_id: r.hit_spans for r in decontam.contamination(docs, bench).collect()}
    for r in decontam.decontaminate(docs, bench, mode="spans").collect():
        t = texts[r.doc_id]
        hit = {w for s in spans[r.doc_id] or [] for w in range(s["at"], s["at"] + s["n"])}
        assert r.text == (cut_spans(t, hit) if hit else t)
    long = spark.createDataFrame([(1, "short one and " * 20_000)], "doc_id long, text string")
    began = time.time()
    assert decontam.decontaminate(long, bench, mode="spans").first().text == " and " * 20_000
    assert time.time() - began < 30


def test_targets_are_decoded_and_resolved(spark):
    cases = [("http://a.org/x/y", "../z?a=1&amp;b=2", "http://a.org/z?a=1&b=2"), ("http://a.org/x/y", "?q=1", "http://a.org/x/y?q=1"),
             ("http://a.org/x/y?o=2#f", "?q=1", "http://a.org/x/y?q=1"), ("http://a.org/x/y", "./z/", "http://a.org/x/z/"),
             ("http://a.org", "z", "http://a.org/z"), ("http://a.org/x/", "../../..", "http://a.org/"), ("https://a.org/x", "//b.org/./q", "https://b.org/q"),
             ("http://a.org/x/y", "/p/../r", "http://a.org/r"), ("http://a.org/x", "https://c.org/a/../b", "https://c.org/b"),
             ("http://a.org/x/y", "z&#47;w&#x3F;k&#61;1", "http://a.org/x/z/w?k=1"), ("http://a.org/x", "#top", "http://a.org/x#top"),
             ("http://a.org/a/b/c", "../d/./e/..", "http://a.org/a/d/")]
    pages = spark.createDataFrame([(i, u, f'<link rel="canonical" href="{t}">') for i, (u, t, _) in enumerate(cases)], "page_id long, url string, html string")
    got = collections.Counter((r.src, r.dst) for r in urlfilter.link_edges(pages).collect())
    assert got == collections.Counter((u, w) for u, _, w in cases)
    # a block reaches the alias, urls without a host stay apart
    rows = [(1, "http://other.org/x/y", '<link rel=canonical href="../en/?a=1&amp;b=2"><meta http-equiv=refresh content="0; url=http://shop.net/es/q?a=1&amp;b=2">'),
            (2, "http://shop.net/es/q?a=1&b=2", ""), (3, "none", ""), (4, None, None), (5, "http://other.org/en/?a=1&b=2", "")]
    out = {r.page_id: r.verdict for r in urlfilter.judge(clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()}
    assert out == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block"}


# ------------------------------------------------------------------- html --

def kept_by_definition(lengths, window, threshold):
    """Stretches and surges looked up line by line."""
    n = len(lengths)
    text = [i for i in range(n) if lengths[i]]
    groups = []
    for i in text:
        if groups and i - groups[-1][-1] <= window:
            groups[-1].append(i)
        else:
            groups.append([i])
    keep = [False] * n
    for g in groups:
        around = [sum(lengths[j] for j in range(n) if abs(j - i) < window) for i in g]
        if max(around) >= threshold:
            for i in range(g[0], g[-1] + 1):
                keep[i] = True
    return keep if any(keep) else [x > 0 for x in lengths]


def test_kept_lines_equal_their_definition():
    from marisnow.llm.html import in_stretches
    rng = random.Random(11)
    for _ in range(400):
        lengths = [rng.choice([0, 0, 0, 5, 12, 40, 90]) for _ in range(rng.randint(0, 25))]
        window, threshold = rng.randint(1, 4), rng.choice([1, 20, 60, 130])
        assert in_stretches(lengths, window, threshold) == kept_by_definition(lengths, window, threshold)


def test_names_and_tags_of_furniture():
    from marisnow.llm.html import main_text
    body = "<p>" + "word " * 40 + "</p>"
    text = ("word " * 40).strip()
    for furniture in ('<div class="main-nav">m</div>', '<div class="footer-text">f</div>', '<div id=sidebar-content>s</div>',
                      '<div class="share-buttons">s</div>', '<section class="comments"><p>' + "nice " * 60 + "</p></section>",
                      '<p class="cookie-notice">c</p>', "<noscript>n</noscript>", "<select><option>o</select>"):
        assert main_text(f"{furniture}<article>{body}</article>{furniture}") == text, furniture
    for content in ('<p class="share-price">It rose.</p>', '<div class="social-history"><p>It rose.</p></div>',
                    '<div class="notice-board">It rose.</div>', "<noscript>It rose.</noscript>", '<header class="header"><h1>It rose.</h1></header>'):
        assert main_text(f"<nav>x</nav><article>{content}{body}</article>") == f"It rose. {text}", content


def test_pages_without_helpful_names():
    """Menus, teasers and footers of neutral divs go by their links."""
    from marisnow.llm.html import main_text
    rng = random.Random(5)

    def words(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(n))

    def menu(n):
        return '<div class="k1"><ul>' + "".join(f'<li><a href="#">{words(rng.randint(1, 9))}</a></li>' for _ in range(n)) + "</ul></div>"

    for _ in range(40):
        paragraphs = [words(rng.randint(25, 60)) for _ in range(rng.randint(2, 6))]
        inside = [f"<p>{p}</p>" for p in paragraphs]
        wanted = list(paragraphs)
        if rng.random() < 0.5:  # one short line and one link between paragraphs stay
            at = rng.randint(1, len(inside) - 1)
            inside.insert(at, '<p>See <a href="#">more of it</a> here.</p>')
            wanted.insert(at, "See more of it here.")
        page = f'<body>{menu(rng.randint(4, 12))}<div class="k2">{"".join(inside)}</div>{menu(rng.randint(4, 12))}</body>'
        assert main_text(page) == " ".join(wanted)


def test_broken_pages_take_linear_time():
    from marisnow.llm.html import main_text
    for bad in ("<button>x" * 8000, "<div>" * 8000 + "</b>" * 8000 + "x", "<p></span>" * 20_000, "<svg><a>" * 8000 + "</svg>"):
        began = time.time()
        main_text(bad)
        assert time.time() - began < 2.0


def test_exact_topk_meets_only_groups_that_can_hold_a_hit(spark, monkeypatch):
    from marisnow.llm import topk
    for name, value in (("BLOCK", 8), ("GROUP", 2), ("QUERIES", 4)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((400, 5)) * np.r_[np.full(60, 3.0), np.full(340, 0.02)][:, None]  # few long ones
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    met = []
    real = topk.last_groups

    def counted(marks, n_groups):
        until = real(marks, n_groups)
        met.append((n_groups, marks, until))
        return until

    monkeypatch.setattr(topk, "last_groups", counted)
    got = {}
    for r in topk.top_k(df, df.filter("vec_id % 10 = 0 and vec_id < 60"), k=3, scale=64).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    v = np.floor(64 * x).astype(np.int64)
    for q in range(0, 60, 10):
        score = v @ v[q]
        order = [i for i in np.lexsort((np.arange(400), -score)) if i != q][:3]
        assert sorted(got[q]) == [(n, int(i), int(score[i])) for n, i in enumerate(order, 1)]
    n_groups, marks, until = met[0]
    length = np.sqrt((v[:60:10].astype(float) ** 2).sum(1)).max()
    assert n_groups > 20 and until(length, min(s[2] for g in got.values() for s in g)) <= 6
    assert until(length, float("-inf")) == n_groups and until(0.0, 1.0) <= 1
    assert all(a[1] >= b[1] for a, b in zip(marks, marks[1:]))
