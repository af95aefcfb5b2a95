"""Registered queries of the operators and, where SQL can state them, the
DuckDB SQL for the same rows.  Each query applies its operator with production
parameters to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marisnow.llm import (decontam, hardneg, html, langid, linededup, quality, secrets, simhash, spiece, topk, toxicity,
                          urlfilter, whitening)
from marisnow.llm.common import UPPER, table
from marisnow.session import ensure_checkpoint_dir, scratch_path, ship_package

_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First scan of the table: a new ledger, so every blob is unseen."""
    ledger = secrets.Ledger(spark, scratch_path(spark, "secret-ledger"))
    out = secrets.scan(table(spark, sf_dir, "documents", "doc_id", "text"), ledger)
    base = F.filter("found", lambda s: s["place"] <= len(secrets.BASE))
    count = lambda k: F.size(F.filter("found", lambda s: s["place"] == k)).cast("long")
    return out.select("doc_id", count(1).alias("n_assign"), count(2).alias("n_access"), count(3).alias("n_hex"),
                      F.sha2(secrets.as_string(base), 256).alias("base_sha256"),
                      secrets.as_string(F.col("found")).alias("spans"))


def _op1_sql() -> str:
    kinds = []
    for place, r in enumerate(secrets.RULES, 1):
        pattern = f"(?s)(.*?)({r.pattern}|\\z)".replace("'", "''")
        value = r.group + 2
        kinds.append(f"""
select doc_id, {place} place, '{r.kind}' kind, size, val, sum(gap + size) over (partition by doc_id order by i) stop
from (select doc_id, unnest(range(len(g))) i, unnest(list_transform(g, lambda x: length(x))) gap,
        unnest(list_transform(m, lambda x: length(x))) size, unnest(list_transform(v, lambda x: length(x))) val
      from (select doc_id, regexp_extract_all(t, '{pattern}', 1) g, regexp_extract_all(t, '{pattern}', 2) m,
              regexp_extract_all(t, '{pattern}', {value}) v from d))
qualify size >= {r.min_total} and val >= {r.min_value}""")
    return f"""
with d as (select doc_id, coalesce(text, '') t from documents),
s as ({" union all ".join(kinds)}),
j as (select doc_id, count(*) filter (place = 1) n_assign, count(*) filter (place = 2) n_access,
        count(*) filter (place = 3) n_hex,
        string_agg(concat_ws(':', kind, cast(stop - size as bigint), cast(stop as bigint)), ',' order by stop - size, place)
          filter (place <= 3) base,
        string_agg(concat_ws(':', kind, cast(stop - size as bigint), cast(stop as bigint)), ',' order by stop - size, place) spans
      from s group by doc_id)
select doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex,
  sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
from d left join j using (doc_id)
"""


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                                 table(spark, sf_dir, "benchmark", "item_id", "text"))
    return out.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = f"""
with w as (select doc_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') ws from documents),
b as (select cast(item_id as varchar) item, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') ws
      from benchmark),
g as (select distinct item, least(len(ws), 10) n,
        unnest(list_transform(range(1, len(ws) - least(len(ws), 10) + 2),
                              lambda i: array_to_string(ws[i:i + least(len(ws), 10) - 1], ' '))) win
      from b where len(ws) > 0),
sizes as (select distinct n from g),
d as (select doc_id, n, unnest(list_transform(range(1, len(ws) - n + 2),
        lambda i: struct_pack(fst := i, win := array_to_string(ws[i:i + n - 1], ' ')))) s
      from w, sizes where len(ws) >= n),
h as (select doc_id, s.fst fst, g.n, item from d join g on d.s.win = g.win and d.n = g.n),
p as (select doc_id, count(distinct pos) n_hit from (select doc_id, unnest(range(fst, fst + n)) pos from h) group by 1),
i as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) items
      from (select distinct doc_id, item from h) group by 1)
select w.doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit,
  cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(items, '')) items_sha256,
  coalesce(n_hit, 0) > 0 contaminated
from w left join p using (doc_id) left join i using (doc_id)
"""


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = f"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) no from documents),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        '{UPPER}', '{UPPER.lower()}') as key from l),
s as (select key, max(doc_id) keep from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
m as (select k.*, s.key is not null and doc_id <> keep as gone from k left join s using (key))
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by no) filter (not gone), '')) kept_sha256
from m group by doc_id
"""


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "url", "text", "n_chars")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    out = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's sampled piece ids, and whether they decode to its
    very text (null for a null text)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = spiece.encode(docs, F.col("doc_id"), check="lossless")
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "lossless")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                                              "score", "predicted")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0")).select("query_id", "rank", "vec_id", "score")


OP5_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) e
  from embeddings where embedding is not null
    and not list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(x)))),
s as (select q.vec_id query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) score
  from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
  vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
"""


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "host", "path", "rule", "verdict")


#: the pages of the given tables name no redirects, so a url without a rule is allowed; tests/llm has the aliases
OP10_SQL = """
with u as (select page_id, coalesce(url, '') url from pages),
p as (select page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
      regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) path from u),
r(rh, rp, verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
select page_id, host, path, arg_max(rh || rp, length(rh || rp)) as rule,
  coalesce(arg_max(verdict, length(rh || rp)), 'allow') verdict
from p left join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
group by page_id, host, path
"""

def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"),
                                             "score", "predicted")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(rows.withColumn("label", noisy), F.col("vec_id") % 100 == 0)


OP13_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) e
  from embeddings where label is not null and embedding is not null
    and not list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(x)))),
s as (select a.vec_id anchor_id, a.l al, c.vec_id, c.l,
    cast(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) as bigint) score
  from v a join v c on a.vec_id % 100 = 0 and c.vec_id <> a.vec_id),
p as (select anchor_id, vec_id positive_id, score positive_score from s where al = l
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
  vec_id negative_id, positive_score, score negative_score
from p join s using (anchor_id)
where l <> al and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 10
"""

QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_topk": op5_exact_topk,
    "op6_html_extraction": op6_html_extraction,
    "op7_language_id": op7_language_id,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_toxicity": op9_toxicity,
    "op10_url_filters": op10_url_filters,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE = {
    "op1_secret_scans": _op1_sql(),
    "op2_benchmark_decontamination": OP2_SQL,
    "op4_line_dedup": OP4_SQL,
    "op5_exact_topk": OP5_SQL,
    "op10_url_filters": OP10_SQL,
    "op13_hard_negatives": OP13_SQL,
}


def _prepared(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries():
    return {k: _prepared(f) for k, f in QUERIES.items()}


def oracle_sql():
    return dict(ORACLE)
