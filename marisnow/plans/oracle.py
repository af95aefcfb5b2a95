"""DuckDB SQL for the independent oracle: the same questions as the Spark
queries in ``registry.py``, written directly in SQL over the driver tables.

Conventions: every column aliased to the Spark name; doubles rounded to 6
places wherever summation order could differ; ids as text or BIGINT exactly
as in Spark."""

from __future__ import annotations


def norm_cat(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower(coalesce(cast({x} as varchar), 'nan')), "
            f"'[_\\-]+', ' ', 'g'), '\\s+', ' ', 'g'))")


def nl_sql(x: str, pattern: str = r"(?i)(non\s+living|detritus)") -> str:
    return f"coalesce(regexp_matches({norm_cat(x)}, '{pattern}'), false)"


def clabel(x: str) -> str:
    return f"(case when {x} = -1 then 'non_living/noise' else printf('non_living/cluster_%02d', {x}) end)"


def date_sql(x: str) -> str:
    d = f"regexp_replace(trim(cast({x} as varchar)), '[^0-9]', '', 'g')"
    return (f"(case when {x} is null then '' when length({d}) = 0 then '' "
            f"when length({d}) >= 8 then substr({d}, 1, 8) else lpad({d}, 8, '0') end)")


def time_num_sql(x: str) -> str:
    d = (f"(case when {x} is null or not isfinite(cast({x} as double)) or {x} < 0 then '' "
         f"else cast(cast(floor(cast({x} as double)) as bigint) as varchar) end)")
    return (f"(case when length({d}) = 0 then '' when length({d}) <= 6 then lpad({d}, 6, '0') || '00' "
            f"when length({d}) = 7 then '0' || {d} else substr({d}, 1, 8) end)")


PARTICLES = """
select cast(o_orderkey as varchar) as object_id,
  '/data/' || n_name || '/' || n_name || '_Results/' ||
    (case o_orderkey % 3 when 0 then 'Deconv_crops' when 1 then 'Crops' else 'other' end) ||
    '/' || cast(o_orderkey // 2 as varchar) || '.png' as full_path,
  case o_orderkey % 8 when 0 then 'non_living' when 1 then 'Non-Living  fiber' when 2 then 'detritus'
    when 3 then 'copepod' when 4 then 'not_living' when 5 then null when 6 then 'radiolaria'
    else 'NON_LIVING__bubble' end as top1,
  o_totalprice as area, o_totalprice / 1000 as esd, n_name as cruise,
  strftime(o_orderdate, '%Y-%m-%d') as date,
  (o_orderkey * 37) % 10000000 as time,
  cast(o_orderkey % 200 as double) * 1.5::double as "depth [m]",
  cast(n_regionkey as double) * 10.0::double + 0.25::double as lat,
  c_acctbal / 100 as lon
from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
"""

# Cluster labels derived from the embeddings table (planted class, every
# 7th vector noise) — the label map the export reads.
LABELS = f"""
select cast(vec_id as varchar) as object_id,
  {clabel('(case when vec_id % 7 = 0 then -1 else label end)')} as cluster_label
from embeddings
"""

EXPORT = f"""
with p as ({PARTICLES}), lab as ({LABELS})
select
  case when p.full_path is null then '' else regexp_extract(p.full_path, '[^/]*$', 0) end as img_file_name,
  p.object_id,
  coalesce(lab.cluster_label, replace(coalesce(p.top1, 'nan'), '_', ' ')) as object_annotation_category,
  'predicted' as object_annotation_status,
  p.lat as object_lat, p.lon as object_lon,
  {date_sql('p.date')} as object_date,
  {time_num_sql('p.time')} as object_time,
  p."depth [m]" as object_depth_min, p."depth [m]" as object_depth_max,
  p.area as object_area, p.esd as object_esd,
  p.cruise as sample_cruise, p.cruise as sample_id
from p left join lab on p.object_id = lab.object_id
"""
