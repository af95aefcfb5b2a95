"""Registered queries for vector analytics over the ``embeddings`` table
(64-d unit vectors with planted labels; every 7th vector marked noise)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marisnow.operators import knn as KN
from marisnow.operators import labels as LB
from marisnow.operators import vectors as V
from marisnow.plans import oracle as O
from marisnow.plans.registry import register
from marisnow.sources.tables import load, particles

NOISY = "(select vec_id, embedding, case when vec_id % 7 = 0 then -1 else label end as lbl from embeddings)"
X = ("(select vec_id, lbl, cast(unnest(embedding) as double) as v, "
     f"generate_subscripts(embedding, 1) - 1 as pos from {NOISY} n0)")
CENT = f"(select lbl, pos, avg(v) as c from {X} x0 where lbl <> -1 group by lbl, pos)"


def noisy(spark, d):
    e = load(spark, d, "embeddings")
    return e.select("vec_id", "embedding",
                    F.when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label")).alias("lbl"))


def _explode(df, key, arr):
    return df.select(key, F.posexplode(arr).alias("pos", "value")).select(
        key, "pos", F.round("value", 6).alias("value"))


@register("l2_normalize", f"""
with x as {X}, n as (select vec_id, greatest(sqrt(sum(v * v)), 1e-12) as nn from x group by vec_id)
select x.vec_id, x.pos, round(x.v / n.nn, 6) as value from x join n using (vec_id)""")
def q_l2_normalize(spark, d):
    e = load(spark, d, "embeddings")
    return _explode(e.select("vec_id", V.l2_normalize("embedding").alias("u")), "vec_id", "u")


@register("centroids", f"select lbl, pos, round(c, 6) as value from {CENT} c0")
def q_centroids(spark, d):
    c = V.centroids(noisy(spark, d), "lbl", "embedding")
    return _explode(c, "lbl", "centroid")


_NOISE_DIST = f"""
with x as {X}, c as {CENT},
nd as (select x.vec_id, c.lbl as cid, sum((x.v - c.c) * (x.v - c.c)) as d2
       from x join c on x.pos = c.pos where x.lbl = -1 group by x.vec_id, c.lbl),
best as (select vec_id, arg_min(cid, (d2, cid)) as cid from nd group by vec_id)"""


@register("assign_noise", f"""{_NOISE_DIST}
select n.vec_id, coalesce(best.cid, n.lbl) as cluster_final from {NOISY} n left join best using (vec_id)""")
def q_assign_noise(spark, d):
    return V.assign_noise(noisy(spark, d), "lbl", "embedding").select("vec_id", "cluster_final")


@register("final_labels", f"""{_NOISE_DIST}
select n.vec_id, n.lbl as cluster_raw, coalesce(best.cid, n.lbl) as cluster_final,
  {O.clabel('coalesce(best.cid, n.lbl)')} as cluster_label
from {NOISY} n left join best using (vec_id)""")
def q_final_labels(spark, d):
    from marisnow.operators.cluster import final_labels
    r = final_labels(noisy(spark, d).withColumnRenamed("lbl", "cluster_raw"), "embedding")
    return r.select("vec_id", "cluster_raw", "cluster_final", "cluster_label")


@register("nearest_centroid_join", f"""{_NOISE_DIST}
select vec_id, cid as nearest from best""")
def q_nearest_centroid_join(spark, d):
    pts = noisy(spark, d)
    cents = V.centroids(pts, "lbl", "embedding")
    r = KN.nearest(pts.filter(F.col("lbl") == -1), "vec_id", "embedding", cents, "lbl", "centroid")
    return r.select(F.col("id").alias("vec_id"), F.col("nbr").cast("int").alias("nearest"))


@register("closest_pair", f"""
with c as {CENT}, d as (select a.lbl as a, b.lbl as b, sqrt(sum((a.c - b.c) * (a.c - b.c))) as dist
  from c a join c b on a.pos = b.pos and a.lbl < b.lbl group by a.lbl, b.lbl)
select a, b, round(dist, 6) as dist from d order by dist, a, b limit 1""")
def q_closest_pair(spark, d):
    cents = V.centroids(noisy(spark, d), "lbl", "embedding")
    r = V.closest_pair(cents, "lbl")
    return r.select("a", "b", F.round("dist", 6).alias("dist"))


def merge_sql(max_clusters: int, steps: int) -> str:
    """SQL unrolling ``steps`` greedy merges (labels 0..9 -> max_clusters)."""
    ctes = [f"x as {X}", "s0 as (select vec_id, lbl as l from x where pos = 0)"]
    for i in range(1, steps + 1):
        p = f"s{i-1}"
        ctes.append(f"c{i} as (select s.l, x.pos, avg(x.v) as c from {p} s join x using (vec_id) "
                    f"where s.l <> -1 group by s.l, x.pos)")
        ctes.append(f"d{i} as (select a.l as la, b.l as lb, sqrt(sum((a.c - b.c) * (a.c - b.c))) as d "
                    f"from c{i} a join c{i} b on a.pos = b.pos and a.l < b.l group by a.l, b.l)")
        ctes.append(f"p{i} as (select la, lb from d{i} order by d, la, lb limit 1)")
        ctes.append(f"s{i} as (select vec_id, case when l = (select lb from p{i}) then (select la from p{i}) "
                    f"else l end as l from {p})")
    last = f"s{steps}"
    return (f"with {', '.join(ctes)}, r as (select l, dense_rank() over (order by l) - 1 as nl "
            f"from (select distinct l from {last} where l <> -1) q) "
            f"select s.vec_id, case when s.l = -1 then -1 else r.nl end as cluster "
            f"from {last} s left join r using (l)")


@register("merge_clusters", merge_sql(8, 2))
def q_merge_clusters(spark, d):
    r = V.merge_clusters(noisy(spark, d), "lbl", "embedding", max_clusters=8, out="cluster")
    return r.select("vec_id", "cluster")


@register("append_log_area", f"""
with f as (select e.vec_id, len(e.embedding) as d0, p.area from embeddings e
           left join ({O.PARTICLES}) p on cast(e.vec_id as varchar) = p.object_id),
v as (select vec_id, d0, case when area > 0 and isfinite(area) then area end as a from f),
m as (select median(a) as med from v),
l as (select vec_id, d0, ln(1 + coalesce(a, med)) as lg from v, m),
s as (select avg(lg) as mu, stddev_pop(lg) as sd from l)
select vec_id, d0 + 1 as dim, round(cast(cast(1.5 * (lg - mu) / sd as float) as double), 6) as size_z
from l, s""")
def q_append_log_area(spark, d):
    e = load(spark, d, "embeddings").select("vec_id", F.col("vec_id").cast("string").alias("object_id"),
                                            F.col("embedding").alias("features"))
    f = LB.lookup_area(e, particles(spark, d), "area")
    r = V.append_log_area(f, "area", "features", "append_log_area", 1.5)
    return r.select("vec_id", F.size("features").alias("dim"),
                    F.round(F.element_at("features", -1).cast("double"), 6).alias("size_z"))


def knn_sql(k: int, metric: str) -> str:
    if metric == "cosine":
        dist = "1 - dp / (na.nn * nb.nn)"
    else:
        dist = "sqrt(greatest(na.sq + nb.sq - 2 * dp, 0))"
    return f"""
with x as (select vec_id as id, cast(unnest(embedding) as double) as v,
                  generate_subscripts(embedding, 1) as pos from embeddings),
n as (select id, greatest(sqrt(sum(v * v)), 1e-12) as nn, sum(v * v) as sq from x group by id),
dot as (select a.id as a, b.id as b, sum(a.v * b.v) as dp from x a join x b on a.pos = b.pos and a.id <> b.id
        group by a.id, b.id),
d as (select dot.a, dot.b, {dist} as dist from dot join n na on na.id = dot.a join n nb on nb.id = dot.b),
r as (select a, b, dist, row_number() over (partition by a order by round(dist, 9), b) as rk from d)
select a as vec_id, b as nbr_id, rk as rank, round(dist, 6) as dist from r where rk <= {k}"""


def _knn_query(k, metric):
    def q(spark, d):
        e = load(spark, d, "embeddings")
        r = KN.knn(e, "vec_id", "embedding", k, metric)
        return r.select(F.col("id").alias("vec_id"), F.col("nbr").alias("nbr_id"),
                        F.col("rank").cast("long").alias("rank"), F.round("dist", 6).alias("dist"))
    return q


register("knn_cosine", knn_sql(10, "cosine"))(_knn_query(10, "cosine"))
register("knn_euclidean", knn_sql(5, "euclidean"))(_knn_query(5, "euclidean"))


@register("cluster_medoids", f"""
with x as {X},
d as (select a.vec_id as a, b.vec_id as b, a.lbl, sqrt(sum((a.v - b.v) * (a.v - b.v))) as dist
      from x a join x b on a.pos = b.pos and a.lbl = b.lbl and a.lbl <> -1 group by a.vec_id, b.vec_id, a.lbl),
s as (select a, lbl, sum(dist) as s from d group by a, lbl)
select lbl, arg_min(a, (round(s, 9), a)) as medoid_id from s group by lbl""")
def q_cluster_medoids(spark, d):
    r = KN.cluster_medoids(noisy(spark, d), "vec_id", "embedding", "lbl")
    return r.select("lbl", "medoid_id")
