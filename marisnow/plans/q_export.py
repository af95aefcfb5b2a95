"""Registered queries: scalar functions, predicates, lookups, aggregates,
sampling and the export table — over the ``particles`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from marisnow.functions import paths as PF
from marisnow.functions import text as T
from marisnow.operators import aggregates as AG
from marisnow.operators import export as EX
from marisnow.operators import labels as LB
from marisnow.operators import rows as RW
from marisnow.plans import oracle as O
from marisnow.plans.registry import register
from marisnow.sources.tables import load, particles

NL = ("non_living", "detritus")
P = f"({O.PARTICLES})"


def labels_from_embeddings(spark, d):
    """Cluster label map from the planted classes, every 7th vector noise."""
    e = load(spark, d, "embeddings")
    lab = F.when(F.col("vec_id") % 7 == 0, F.lit(-1)).otherwise(F.col("label"))
    return e.select(F.col("vec_id").cast("string").alias("object_id"),
                    T.cluster_label(lab).alias("cluster_label"))


# ---------------------------------------------------------------- 2.3 -------
@register("valid_path", f"select object_id, full_path from {P} p "
                        f"where full_path is not null and full_path <> ''")
def q_valid_path(spark, d):
    return particles(spark, d).filter(PF.valid_path("full_path")).select("object_id", "full_path")


@register("rewrite_paths", f"""
select object_id, regexp_replace(full_path, '([/\\\\])Crops([/\\\\])', '\\1Deconv_crops\\2', 'g') as image_path,
  regexp_replace(full_path, '([/\\\\])Crops([/\\\\])', '\\1Deconv_crops\\2', 'g') <> full_path as rewritten
from {P} p""")
def q_rewrite_paths(spark, d):
    p = particles(spark, d)
    new = PF.rewrite_crops("full_path")
    return p.select("object_id", new.alias("image_path"), (new != F.col("full_path")).alias("rewritten"))


_REWRITTEN = (f"(select object_id, regexp_replace(full_path, '([/\\\\])Crops([/\\\\])', "
              f"'\\1Deconv_crops\\2', 'g') as full_path, top1 from {P} p0)")


@register("path_token_filter", f"""
with r as {_REWRITTEN},
f as (select max(case when regexp_matches(lower(full_path), 'deconv_crops') then 1 else 0 end) hd,
             max(case when regexp_matches(lower(full_path), '(?:^|[\\\\/])crops(?:[\\\\/])') then 1 else 0 end) hc
      from r)
select r.object_id, r.full_path from r, f
where case when f.hd = 1 then regexp_matches(lower(r.full_path), 'deconv_crops')
           when f.hc = 1 then regexp_matches(lower(r.full_path), '(?:^|[\\\\/])crops(?:[\\\\/])')
           else true end""")
def q_path_token_filter(spark, d):
    p = particles(spark, d).withColumn("full_path", PF.rewrite_crops("full_path"))
    return RW.path_token_filter(p, "full_path", "auto").select("object_id", "full_path")


@register("normalize_category", f"select object_id, {O.norm_cat('top1')} as category_norm from {P} p")
def q_normalize_category(spark, d):
    return particles(spark, d).select("object_id", T.normalize_category("top1").alias("category_norm"))


@register("non_living_mask", f"select object_id, {O.nl_sql('top1')} as non_living from {P} p")
def q_non_living_mask(spark, d):
    return particles(spark, d).select("object_id", T.non_living("top1", NL).alias("non_living"))


_AUG_BASE = r"(?i)(aggregate)"
_AUG_FULL = r"(?i)(aggregate|not\s+living)"


@register("augment_classes", f"""
with p as {P},
f as (select max(case when {O.nl_sql('top1', _AUG_BASE)} then 1 else 0 end) hb,
             max(case when regexp_matches({O.norm_cat('top1')}, '\\bnot\\s+living\\b') then 1 else 0 end) hv
      from p)
select p.object_id,
  case when f.hb = 0 and f.hv = 1 then {O.nl_sql('p.top1', _AUG_FULL)} else {O.nl_sql('p.top1', _AUG_BASE)} end
    as non_living
from p, f""")
def q_augment_classes(spark, d):
    p = particles(spark, d)
    return RW.augmented_non_living(p, "top1", ("aggregate",)).select("object_id", "non_living")


@register("rename_export_columns", f"""
select object_id, full_path as object_full_path, top1 as object_annotation_category, area as object_area,
  esd as object_esd, cruise as sample_cruise, date as object_date, time as object_time,
  "depth [m]" as object_depth_min, lat as object_lat, lon as object_lon from {P} p""")
def q_rename_export_columns(spark, d):
    return EX.rename_export_columns(particles(spark, d))


@register("export_defaults", f"""
select object_id, full_path as object_full_path, top1 as object_annotation_category, area as object_area,
  esd as object_esd, cruise as sample_cruise, date as object_date, time as object_time,
  "depth [m]" as object_depth_min, lat as object_lat, lon as object_lon,
  'predicted' as object_annotation_status, "depth [m]" as object_depth_max, cruise as sample_id
from {P} p""")
def q_export_defaults(spark, d):
    return EX.export_defaults(EX.rename_export_columns(particles(spark, d)))


@register("clean_category", f"select object_id, replace(coalesce(top1, 'nan'), '_', ' ') as category from {P} p")
def q_clean_category(spark, d):
    return particles(spark, d).select("object_id", T.clean_category("top1").alias("category"))


@register("image_file_name", f"""
select object_id, case when full_path is null then '' else regexp_extract(full_path, '[^/]*$', 0) end
  as img_file_name from {P} p""")
def q_image_file_name(spark, d):
    return particles(spark, d).select(
        "object_id", F.when(F.col("full_path").isNull(), "").otherwise(T.base_name("full_path"))
        .alias("img_file_name"))


@register("normalize_date", f"select object_id, {O.date_sql('date')} as object_date from {P} p")
def q_normalize_date(spark, d):
    p = particles(spark, d)
    return p.select("object_id", T.normalize_date("date", p.schema["date"].dataType).alias("object_date"))


@register("normalize_time", f"select object_id, {O.time_num_sql('time')} as object_time from {P} p")
def q_normalize_time(spark, d):
    p = particles(spark, d)
    return p.select("object_id", T.normalize_time("time", p.schema["time"].dataType).alias("object_time"))


_EXPORT_NO_LABELS = O.EXPORT.replace("coalesce(lab.cluster_label, ", "coalesce(null, ")


@register("select_export_columns", _EXPORT_NO_LABELS)
def q_select_export_columns(spark, d):
    return EX.build_export_table(particles(spark, d))


@register("build_export_table", O.EXPORT)
def q_build_export_table(spark, d):
    return EX.build_export_table(particles(spark, d), labels_from_embeddings(spark, d))


@register("category_filter", f"select * from ({O.EXPORT}) e where {O.nl_sql('object_annotation_category')}")
def q_category_filter(spark, d):
    et = EX.build_export_table(particles(spark, d), labels_from_embeddings(spark, d))
    return EX.category_filter(et, "non_living", NL)


@register("esd_range_filter", f"""select * from ({O.EXPORT}) e
where try_cast(object_esd as double) >= 100.0 and try_cast(object_esd as double) <= 300.0""")
def q_esd_range_filter(spark, d):
    et = EX.build_export_table(particles(spark, d), labels_from_embeddings(spark, d))
    return EX.esd_range_filter(et, 100.0, 300.0)


@register("export_filters", f"""select * from ({O.EXPORT}) e
where not {O.nl_sql('object_annotation_category')} and try_cast(object_esd as double) >= 50.0""")
def q_export_filters(spark, d):
    et = EX.build_export_table(particles(spark, d), labels_from_embeddings(spark, d))
    return EX.export_filters(et, NL, "living", esd_min=50.0)


COUNT_EXPORT_SQL = f"""
select count(*) as total,
  coalesce(sum(case when {O.nl_sql('object_annotation_category')} then 0 else 1 end), 0) as living,
  coalesce(sum(case when {O.nl_sql('object_annotation_category')} then 1 else 0 end), 0) as non_living
from ({O.EXPORT}) e where try_cast(object_esd as double) >= 20.0 and try_cast(object_esd as double) <= 400.0"""


@register("count_export", COUNT_EXPORT_SQL)
def q_count_export(spark, d):
    return EX.count_export(particles(spark, d), labels_from_embeddings(spark, d), NL, "all",
                           esd_min=20.0, esd_max=400.0)


@register("cluster_label", f"select vec_id, {O.clabel('(case when vec_id % 7 = 0 then -1 else label end)')} "
                           f"as cluster_label from embeddings")
def q_cluster_label(spark, d):
    e = load(spark, d, "embeddings")
    lab = F.when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label"))
    return e.select("vec_id", T.cluster_label(lab).alias("cluster_label"))


@register("color_default_label", """
select vec_id, case when (case when vec_id % 5 = 0 then null when vec_id % 7 = 0 then -1 else label end) is null
  then 'unknown' else 'non_living/cluster_' ||
  printf('%02d', (case when vec_id % 5 = 0 then null when vec_id % 7 = 0 then -1 else label end)) end
  as cluster_label from embeddings""")
def q_color_default_label(spark, d):
    e = load(spark, d, "embeddings")
    final = (F.when(F.col("vec_id") % 5 == 0, F.lit(None).cast("int"))
             .when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label")))
    return e.select("vec_id", AG.default_view_label(final).alias("cluster_label"))


# ---------------------------------------------------------------- 2.4 -------
_DUP_LABELS = """(select cast(vec_id % 300 as varchar) as object_id,
   'non_living/cluster_' || printf('%02d', label) as cluster_label, vec_id as ord from embeddings)"""


@register("apply_labels", f"""
with p as {P}, lab as (select object_id, arg_max(cluster_label, ord) as cluster_label
                       from {_DUP_LABELS} x group by object_id)
select p.object_id, coalesce(lab.cluster_label, replace(coalesce(p.top1, 'nan'), '_', ' ')) as category
from p left join lab on p.object_id = lab.object_id""")
def q_apply_labels(spark, d):
    e = load(spark, d, "embeddings")
    lab = e.select((F.col("vec_id") % 300).cast("string").alias("object_id"),
                   F.format_string("non_living/cluster_%02d", "label").alias("cluster_label"),
                   F.col("vec_id").alias("ord"))
    p = particles(spark, d).withColumn("category", T.clean_category("top1"))
    return LB.apply_labels(p, lab, target="category", order_col="ord").select("object_id", "category")


@register("lookup_area", f"""
select e.vec_id, p.area from embeddings e left join {P} p on cast(e.vec_id as varchar) = p.object_id""")
def q_lookup_area(spark, d):
    e = load(spark, d, "embeddings").select("vec_id", F.col("vec_id").cast("string").alias("object_id"))
    return LB.lookup_area(e, particles(spark, d), "area").select("vec_id", "area")


@register("path_to_object_id", f"""
with r as {_REWRITTEN},
m as (select full_path, arg_max(object_id, cast(object_id as bigint)) as oid from r group by full_path),
paths as (select distinct full_path as image_path from r)
select paths.image_path, m.oid as object_id from paths left join m on paths.image_path = m.full_path""")
def q_path_to_object_id(spark, d):
    p = particles(spark, d).withColumn("full_path", PF.rewrite_crops("full_path")) \
        .withColumn("_ord", F.col("object_id").cast("bigint"))
    paths = p.select(F.col("full_path").alias("image_path")).distinct()
    return LB.path_to_object_id(paths, p, "image_path", "full_path", "_ord")


# ---------------------------------------------------------------- 2.5 -------
@register("dedup_by_path", f"""
with r as {_REWRITTEN}
select full_path, object_id from (
  select *, row_number() over (partition by full_path order by cast(object_id as bigint)) rn from r) x
where rn = 1""")
def q_dedup_by_path(spark, d):
    p = particles(spark, d).withColumn("full_path", PF.rewrite_crops("full_path"))
    p = p.select("full_path", "object_id", F.col("object_id").cast("bigint").alias("_row"))
    return RW.dedup_first(p, ["full_path"], ["_row"]).select("full_path", "object_id")


@register("dedup_keep_first", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
    order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
             l_linestatus, l_shipdate) rn from lineitem) x where rn = 1""")
def q_dedup_keep_first(spark, d):
    li = load(spark, d, "lineitem")
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    return RW.dedup_first(li, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", *order)


@register("count_by_cruise", f"select cruise, count(*) as n from {P} p where cruise is not null group by cruise")
def q_count_by_cruise(spark, d):
    return AG.count_by(particles(spark, d), "cruise")


@register("non_living_share", f"""
select sum(case when {O.nl_sql('top1')} then 1 else 0 end) as hits, count(*) as total,
  round(100.0 * sum(case when {O.nl_sql('top1')} then 1 else 0 end) / count(*), 6) as pct from {P} p""")
def q_non_living_share(spark, d):
    p = particles(spark, d).withColumn("nl", T.non_living("top1", NL))
    return AG.share(p, "nl")


@register("split_by_category", f"""
select case when {O.nl_sql('object_annotation_category')} then 'non_living' else 'living' end as _group,
  count(*) as n from ({O.EXPORT}) e group by 1""")
def q_split_by_category(spark, d):
    et = EX.build_export_table(particles(spark, d), labels_from_embeddings(spark, d))
    return EX.split_by_category(et, "living_non_living", NL).groupBy("_group").agg(F.count(F.lit(1)).alias("n"))


_NOISY = "(select vec_id, case when vec_id % 7 = 0 then -1 else label end as lbl from embeddings)"


def _noisy(spark, d):
    e = load(spark, d, "embeddings")
    return e.select("vec_id", F.when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label")).alias("lbl"))


@register("cluster_stats", f"""
select count(distinct case when lbl <> -1 then lbl end) as n_clusters,
  sum(case when lbl = -1 then 1 else 0 end) as n_noise,
  round(100.0 * sum(case when lbl = -1 then 1 else 0 end) / greatest(count(*), 1), 6) as noise_pct,
  count(distinct case when lbl <> -1 then lbl end) = 0 as all_noise
from {_NOISY} x""")
def q_cluster_stats(spark, d):
    return AG.cluster_stats(_noisy(spark, d), "lbl")


@register("cluster_histogram", f"""
select {O.clabel('lbl')} as cluster_label, count(*) as n from {_NOISY} x group by 1""")
def q_cluster_histogram(spark, d):
    return AG.cluster_histogram(_noisy(spark, d), "lbl")


@register("run_summary", f"select count(*) as points, count(distinct lbl) as labels from {_NOISY} x")
def q_run_summary(spark, d):
    return AG.run_summary(_noisy(spark, d), "lbl")


@register("random_sample", f"""
select object_id, full_path from {P} p order by md5('42:' || object_id), object_id limit 1000""")
def q_random_sample(spark, d):
    return RW.random_sample(particles(spark, d), 1000, seed=42).select("object_id", "full_path")


@register("train_subset", f"""
with r as {_REWRITTEN}
select object_id, full_path from r where {O.nl_sql('top1')} and full_path is not null
""")
def q_train_subset(spark, d):
    p = particles(spark, d).withColumn("full_path", PF.rewrite_crops("full_path"))
    return AG.train_subset(p, "top1", "full_path", NL, seed=7).select("object_id", "full_path")


@register("plot_downsample", """
select vec_id, label from embeddings order by md5('42:' || cast(vec_id as varchar)), cast(vec_id as varchar)
limit 40000""")
def q_plot_downsample(spark, d):
    e = load(spark, d, "embeddings").select("vec_id", "label")
    return RW.random_sample(e, 40_000, seed=42, key="vec_id")
