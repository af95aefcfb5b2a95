"""Registered queries for graphs, density clustering, reduction, KMeans
and bundle planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from marisnow.operators import bundles as BU
from marisnow.operators import graph as GR
from marisnow.operators import hdbscan as HD
from marisnow.operators import reduce as RD
from marisnow.operators.cluster import kmeans_fallback
from marisnow.plans.registry import register
from marisnow.sources.tables import load

SUPP_OFFSET = 1_000_000_000_000
#: pictures that a task encodes, about
ENCODED_ROWS = 16_384


@register("connected_components", f"""
with recursive e as (
  select l_partkey as src, l_suppkey + {SUPP_OFFSET} as dst from lineitem
  union select l_suppkey + {SUPP_OFFSET}, l_partkey from lineitem),
nodes as (select distinct src as node from e),
reach(node, comp) as (select node, node from nodes
  union select e.dst, r.comp from reach r join e on r.node = e.src)
select node as id, min(comp) as component from reach group by node""")
def q_connected_components(spark, d):
    li = load(spark, d, "lineitem")
    e = li.select(F.col("l_partkey").alias("src"), (F.col("l_suppkey") + F.lit(SUPP_OFFSET)).alias("dst"))
    return GR.connected_components(e)


def _mr_sql(ms: int, k: int) -> str:
    return f"""
with x as (select vec_id as id, cast(unnest(embedding) as double) as v,
                  generate_subscripts(embedding, 1) as pos from embeddings),
n as (select id, sum(v * v) as sq from x group by id),
dot as (select a.id as a, b.id as b, sum(a.v * b.v) as dp from x a join x b on a.pos = b.pos group by a.id, b.id),
d as (select dot.a, dot.b, case when dot.a = dot.b then 0.0 else sqrt(greatest(na.sq + nb.sq - 2 * dp, 0)) end as dist
      from dot join n na on na.id = dot.a join n nb on nb.id = dot.b),
r as (select a, b, dist, row_number() over (partition by a order by round(dist, 9), b) as rk from d),
core as (select a as id, max(dist) as core from r where rk <= {ms} group by a),
nn as (select a, b, dist from (select a, b, dist, row_number() over (partition by a order by round(dist, 9), b) as rk
       from d where a <> b) q where rk <= {k})
select nn.a, nn.b, round(nn.dist, 6) as d, round(greatest(ca.core, cb.core, nn.dist), 6) as w
from nn join core ca on ca.id = nn.a join core cb on cb.id = nn.b"""


@register("mutual_reachability", _mr_sql(5, 5))
def q_mutual_reachability(spark, d):
    e = load(spark, d, "embeddings")
    r = HD.mutual_reachability(e, "vec_id", "embedding", min_samples=5, k=5)
    return r.select("a", "b", F.round("d", 6).alias("d"), F.round("w", 6).alias("w"))


@register("mst_edges")
def q_mst_edges(spark, d):
    """Exact MST of the mutual-reachability graph (min_samples 5): rows-only
    (tree weight checked against Prim's algorithm in tests)."""
    e = load(spark, d, "embeddings")
    return HD.reachability_tree(e, "vec_id", "embedding", 5).select("a", "b", F.round("w", 6).alias("w"))


@register("hdbscan")
def q_hdbscan(spark, d):
    """Exact HDBSCAN on the embeddings (min cluster size 5), cross-checked
    against a sequential implementation in tests."""
    e = load(spark, d, "embeddings")
    return HD.hdbscan(e, "vec_id", "embedding", min_cluster_size=5) \
        .select(F.col("id").alias("vec_id"), "cluster_raw")


@register("kmeans_fallback")
def q_kmeans_fallback(spark, d):
    e = load(spark, d, "embeddings")
    return kmeans_fallback(e, "embedding", k=10, seed=42).select("vec_id", "cluster_final")


@register("pca_reduce")
def q_pca_reduce(spark, d):
    e = load(spark, d, "embeddings")
    r = RD.pca_reduce(e, "embedding", 8, "reduced")
    return r.select("vec_id", F.size("reduced").alias("dims"))


@register("fuzzy_graph")
def q_fuzzy_graph(spark, d):
    from marisnow.operators.knn import knn
    e = load(spark, d, "embeddings")
    nn = knn(e, "vec_id", "embedding", 15, "cosine")
    return RD.fuzzy_graph(nn, 15).select("a", "b", F.round("w", 6).alias("w"))


MAX_CENTS = 20_000_000_000
_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("bundle_plan", f"""
with recursive c as (
  select cast(round(l_extendedprice * 100) as bigint) as sz,
    row_number() over (order by {", ".join(_ORDER)}) as rn,
    sum(cast(round(l_extendedprice * 100) as bigint)) over (order by {", ".join(_ORDER)}
      rows between unbounded preceding and current row) as cum
  from lineitem),
parts(part, start_rn, base) as (
  select 1, 1::bigint, 0::hugeint
  union all
  select part + 1, nr, (select c2.cum - c2.sz from c c2 where c2.rn = nr) from (
    select p.part, (select min(c1.rn) from c c1 where c1.rn > p.start_rn and c1.cum - p.base > {MAX_CENTS}
                      and c1.cum - c1.sz - p.base > 0) as nr from parts p) q
  where nr is not null)
select part, count(*) as n_rows, sum(sz) as bytes
from c asof join parts on c.rn >= parts.start_rn group by part""")
def q_bundle_plan(spark, d):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    plan = BU.bundle_plan(load(spark, d, "lineitem").select(*_ORDER), cents, _ORDER, MAX_CENTS, keep=["l_extendedprice"]).withColumn("_cents", cents)
    return plan.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_cents").alias("bytes"))


@register("cluster_features")
def q_cluster_features(spark, d):
    """PCA to 8 dims, HDBSCAN (min size 5), stats (rows-only)."""
    from marisnow.plans.cluster_run import RunConfig, cluster_features
    e = load(spark, d, "embeddings")
    cfg = RunConfig(umap_dims=8, min_cluster_size=5)
    out, _info = cluster_features(e, "vec_id", "embedding", cfg)
    return out.select(F.col("id").alias("vec_id"), "cluster_raw")


@register("cluster_run")
def q_cluster_run(spark, d):
    """Whole run on the particles view: a picture and features for every
    particle, augmentation, sample, reduce, cluster, labels (rows-only)."""
    from marisnow.operators.imageprep import extract_features
    from marisnow.plans.cluster_run import RunConfig, cluster_run
    from marisnow.plans.q_images import render_particles
    from marisnow.session import scratch_path
    from marisnow.sources import runs as RN
    from marisnow.sources.tables import particles
    rows = particles(spark, d)
    # pictures are rendered and encoded by many tasks, however few files the tables are
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // ENCODED_ROWS))
    store = RN.write_features(extract_features(render_particles(rows.repartition(tasks)), input_size=32),
                              scratch_path(spark, "features"))
    feats = RN.read_features(spark, store)
    cfg = RunConfig(min_cluster_size=5, umap_dims=8, size_feature_mode="append_log_area",
                    size_feature_weight=0.5)
    res = cluster_run(spark, particles(spark, d), feats, cfg)
    return res["assignments"]


@register("umap_reduce")
def q_umap_reduce(spark, d):
    """Neighbour-graph layout of the embeddings to 8 dims (the operator's
    neighbours, min_dist, metric and epochs) — rows-only; neighbour
    preservation and determinism are tested."""
    from marisnow.operators.umap import umap_reduce
    e = load(spark, d, "embeddings")
    y = umap_reduce(e, "vec_id", "embedding", n_components=8)
    return y.select(F.col("id").alias("vec_id"), "embedding")


@register("umap_2d")
def q_umap_2d(spark, d):
    """Second, independent 2-D layout for viewing (min_dist 0.1, seed 0)."""
    from marisnow.operators.umap import umap_reduce
    e = load(spark, d, "embeddings")
    y = umap_reduce(e, "vec_id", "embedding", n_components=2, min_dist=0.1, seed=0)
    return y.select(F.col("id").alias("vec_id"), F.col("embedding")[0].alias("umap_x"),
                    F.col("embedding")[1].alias("umap_y"))
