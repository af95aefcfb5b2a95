"""Size-bounded export bundles.

``bundle_plan`` reproduces the greedy, order-preserving cut exactly: a new
part starts before row i when running + size(i) > max and running > 0.  The
rows are sorted into ranges; a range follows its cuts by itself, and only the
rows whose part goes on behind their range are linked from range to range.
Nothing passes through the driver.  Ranges have about ``graph.RANGE_ROWS`` rows
and a task has one, so a task's memory does not grow with the table or with a
group.

``bundle_export`` writes one ZIP per part from a grouped pandas function:
rows of a part (bounded by the part's byte budget) arrive in one task, which
writes the metadata TSV (with its [f]/[t] type row) and the image bytes."""

from __future__ import annotations

import io
import logging
import os
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from marisnow.operators import graph
from marisnow.operators.graph import _cut, _whole, followed, ranges_for

log = logging.getLogger(__name__)

MB = 1024 * 1024


def dtype_tags(df: DataFrame, cols: list[str] | None = None) -> dict[str, str]:
    """'[f]' for numeric columns, '[t]' otherwise."""
    cols = cols or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return {c: "[f]" if isinstance(types[c], NumericType) else "[t]" for c in cols}


def _tsv_cell(c: str):
    """A cell as text, quoted (quotes doubled) where it holds a tab, a quote
    or a line break; null is empty."""
    text = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return F.when(F.rlike(text, F.lit('[\t\n\r"]')), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def write_tagged_tsv(df: DataFrame, path: str, file_col: str, order: list[str] | None = None) -> str:
    """One tab-separated file per value of ``file_col`` (``<path>/_f=<v>/part-*``,
    pieces in order): header line, the type-tag line, then the rows in
    ``order`` (default: as read).  Rows are dealt by ranges of (file, order),
    so a large file is written by many tasks and only its first piece begins
    with the header."""
    cols = [c for c in df.columns if c != file_col and not c.startswith("_")]
    tags = dtype_tags(df, cols)
    place = [F.struct(*order)] if order else [F.monotonically_increasing_id()]
    data = df.select(F.col(file_col).alias("_f"), F.lit(2).alias("_k"), place[0].alias("_o"),
                     F.concat_ws("\t", *[_tsv_cell(c) for c in cols]).alias("value"))
    files = df.select(F.col(file_col).alias("_f")).distinct()
    first = lambda k, line: files.select("_f", F.lit(k).alias("_k"), F.lit(None).cast(data.schema["_o"].dataType).alias("_o"),
                                         F.lit("\t".join(line)).alias("value"))
    out = first(0, cols).union(first(1, [tags[c] for c in cols])).union(data)
    keys = ("_f", "_k", "_o")
    out.repartitionByRange(*keys).sortWithinPartitions(*keys).select("_f", "value").write.mode("overwrite").partitionBy("_f") \
        .option("lineSep", "\n").text(path)
    return path


#: bits of a row's place (``_at``) that hold its number in its range
PLACE_BITS = 33


def _range_of(at: str) -> Column:
    return F.shiftright(at, PLACE_BITS).cast("int")


def _place(at: str) -> Column:
    return F.col(at).bitwiseAND((1 << PLACE_BITS) - 1)


#: stretches of one part that are sent to every task that numbers rows; more are left to the join's plan
BROADCAST_MARKS = 1 << 18

PACKED = "_pid int, n long, total double, sizes binary, inner binary"


def _packs(tagged: DataFrame, size, group: str | None, ranges: int) -> DataFrame:
    """A row for each range of ``tagged``: rows, total, the sizes, the places
    where a group begins inside the range, its first and last group."""
    own = F.col(group) if group else F.lit(0)
    rows = tagged.select(_range_of("_at").alias("_pid"), "_at", size.alias("_sz"), own.alias("_g"))

    def pack(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("_at")
        g, sizes = x["_g"], x["_sz"].to_numpy(float)
        before = g.shift(1)
        inner = np.flatnonzero(~((g == before) | (g.isna() & before.isna())).to_numpy(bool)[1:]) + 1
        return pd.DataFrame({"_pid": [x["_pid"].iloc[0]], "n": [len(x)], "total": [sizes.sum()], "sizes": [sizes.tobytes()],
                             "inner": [inner.astype(np.int64).tobytes()], "head": g.iloc[:1].to_numpy(), "last": g.iloc[-1:].to_numpy()})

    kind = rows.schema["_g"].dataType.simpleString()
    return _cut(rows.repartitionById(ranges, F.col("_pid")).groupBy("_pid").applyInPandas(pack, f"{PACKED}, head {kind}, last {kind}"))


def _heads(packs: DataFrame) -> DataFrame:
    """(_pid, before, start, gf, gl, more): a range's rows and total before it,
    the numbers of its first and last group, and whether the first is that of
    the rows before."""
    w = Window.orderBy("_pid")  # one row per range
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    known = packs.select("_pid", "n", "total", "head", "last", (F.length("inner") / 8).cast("long").alias("inner"))
    known = known.withColumn("more", F.lag("_pid").over(w).isNotNull() & F.col("head").eqNullSafe(F.lag("last").over(w)))
    known = known.withColumn("new", F.col("inner") + (~F.col("more")).cast("long"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return _cut(known.select(
        "_pid", zero(F.sum("n").over(before)).alias("before"), zero(F.sum("total").over(before)).cast("double").alias("start"),
        (zero(F.sum("new").over(before)) + (~F.col("more")).cast("long")).alias("gf"),
        F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("gl"), "more"))


class _Range:
    """The rows of a range: ``next``, where a part from each row is cut (the
    row itself if not before its group or the range ends), and ``open``, which
    rows' parts go on behind the range."""

    def __init__(self, row, limit: float):
        sizes = np.frombuffer(row.sizes, np.float64)
        self.n, self.limit, self.start, self.more = len(sizes), limit, row.start, row.more
        self.inner = np.frombuffer(row.inner, np.int64)
        self.cum = row.start + np.cumsum(sizes)
        self.prev = np.r_[row.start, self.cum[:-1]]
        ends = np.r_[self.inner, self.n]
        end = ends[np.searchsorted(ends, np.arange(self.n), side="right")]
        self.first_end = int(ends[0])
        to = self.cut(self.prev)
        inside = to < end
        self.next = np.where(inside, to, np.arange(self.n))
        self.open = ~inside & (end == self.n)

    def cut(self, base: np.ndarray) -> np.ndarray:
        """The first row that exceeds the limit of a part whose rows begin
        after ``base``, and has rows of some size before it in the part; n: none."""
        over = np.searchsorted(self.cum, base + self.limit, side="right")
        some = np.searchsorted(self.cum, base, side="right") + 1
        return np.minimum(np.where(base < self.start, over, np.maximum(over, some)), self.n)

    @property
    def starts(self) -> np.ndarray:
        """Where parts begin for certain: with a group."""
        return self.inner if self.more else np.r_[0, self.inner]

    def entries(self) -> np.ndarray:
        """Rows where a part of the rows before may be cut first."""
        if not self.more:
            return np.zeros(0, dtype=np.int64)
        last = int(self.cut(np.array([self.start]))[0])
        return np.arange(min(last + 1, self.first_end))


def _reached(first: DataFrame, step: DataFrame, ranges: int) -> DataFrame:
    """(rn): the rows ``first`` and all that follow them by the pointers
    (rn, to), which lead to greater rows.  Pointers double from round to
    round, so rounds are the logarithm of the longest way."""
    seen, jump = _cut(first.select("rn")), _cut(step)
    while not jump.isEmpty():
        seen = _cut(seen.unionByName(seen.join(jump.repartition(ranges, "rn"), "rn").select(F.col("to").alias("rn"))).distinct())
        far = jump.select(F.col("rn").alias("to"), F.col("to").alias("far"))
        jump = _cut(jump.repartition(ranges, "to").join(far.repartition(ranges, "to"), "to").select("rn", F.col("far").alias("to")))
    return seen


def _ends(packs: DataFrame, heads: DataFrame) -> DataFrame:
    """One row: the ranges' numbers, totals up to their ends, and first groups."""

    def fold(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("_pid")
        return pd.DataFrame({"pids": [x["_pid"].to_numpy(np.int64).tobytes()], "ends": [x["end"].to_numpy(float).tobytes()],
                             "firsts": [x["gf"].to_numpy(np.int64).tobytes()]})

    rows = _cut(packs.select("_pid", "total").join(F.broadcast(heads), "_pid").select("_pid", (F.col("start") + F.col("total")).alias("end"), "gf"))
    return _whole(rows, fold, "pids binary, ends binary, firsts binary")


NODES = "rn long, base double, sure boolean, target int, within long"


def _nodes(packs: DataFrame, heads: DataFrame, limit: float) -> DataFrame:
    """The rows whose part may go on behind their range: the sum before them,
    whether they are cuts for certain, and the range where that part ends at
    the earliest (null: nowhere).  A range's first row, where it is none of
    them, with the one ``within`` the range that its cuts lead to."""

    def leave(batches):
        for x in batches:
            for row in x.itertuples():
                here, own = _Range(row, limit), row.pid << PLACE_BITS
                pids, ends, firsts = (np.frombuffer(c, t) for c, t in ((row.pids, np.int64), (row.ends, float), (row.firsts, np.int64)))
                last = followed(np.arange(here.n), here.next)
                out = np.unique(last[np.r_[here.entries(), here.starts]])
                out = out[here.open[out]]
                at = np.maximum(np.searchsorted(ends, here.prev[out] + limit, side="right"), np.searchsorted(pids, row.pid) + 1)
                target = [int(pids[t]) if t < len(pids) and firsts[t] == row.gl else None for t in at]
                rows = list(zip((own + out).tolist(), here.prev[out].tolist(), np.isin(out, last[here.starts]).tolist(), target, [None] * len(out)))
                if here.more and last[0] != 0 and here.open[last[0]]:
                    rows.append((own, here.start, False, None, own + int(last[0])))
                yield pd.DataFrame(rows, columns=["rn", "base", "sure", "target", "within"]).astype({"target": "Int32", "within": "Int64"})

    rows = packs.select("_pid", "sizes", "inner").join(F.broadcast(heads), "_pid").join(F.broadcast(_ends(packs, heads)), how="cross")
    return _cut(rows.select(F.col("_pid").alias("pid"), "sizes", "inner", "start", "more", "gl", "pids", "ends", "firsts").mapInPandas(leave, NODES))


def _led(nodes: DataFrame, packs: DataFrame, heads: DataFrame, limit: float) -> DataFrame:
    """(rn, entry, to): the first row of a later range where the part of a
    node is cut, and the node that the cuts from there lead to (null: none)."""
    asked = nodes.filter("target is not null").groupBy(F.col("target").alias("_pid"), _range_of("rn").alias("_from")).agg(
        F.collect_list("rn").alias("rns"), F.collect_list("base").alias("bases"))

    def lead(batches):
        for x in batches:
            for row in x.itertuples():
                here = _Range(row, limit)
                last, rn, to = followed(np.arange(here.n), here.next), np.asarray(row.rns, np.int64), here.cut(np.asarray(row.bases, float))
                at = np.flatnonzero(to < here.first_end)
                end, own = last[to[at]], row.pid << PLACE_BITS
                yield pd.DataFrame({"rn": rn[at], "entry": own + to[at], "to": pd.Series(own + end, dtype="Int64").mask(~here.open[end])})
                if row.after >= 0 and here.first_end == here.n:  # its last row alone exceeds the limit: cut behind it
                    at, first = np.flatnonzero(to == here.n), row.after << PLACE_BITS
                    yield pd.DataFrame({"rn": rn[at], "entry": first, "to": pd.Series(first, index=range(len(at)), dtype="Int64")})

    w = Window.orderBy("_pid")
    after = heads.select("_pid", "start", "more", F.when(F.lead("more").over(w), F.lead("_pid").over(w)).otherwise(F.lit(-1)).alias("after"))
    rows = packs.select("_pid", "sizes", "inner").join(F.broadcast(after), "_pid").join(asked, "_pid")
    rows = rows.select(F.col("_pid").alias("pid"), "sizes", "inner", "start", "more", "after", "rns", "bases")
    inside = nodes.filter("within is not null").select("rn", F.lit(None).cast("long").alias("entry"), F.col("within").alias("to"))
    return _cut(rows.mapInPandas(lead, "rn long, entry long, to long").unionByName(inside))


def _real(sure: DataFrame, step: DataFrame) -> DataFrame:
    """(rn): the rows ``sure`` and all that the pointers ``step`` (rn, to)
    lead to from them."""
    n = step.count()
    if n > graph.LOCAL_POINTS:
        return _reached(sure, step, ranges_for(n))

    def walk(x: pd.DataFrame) -> pd.DataFrame:
        go = x["to"] >= 0
        to, seen = dict(zip(x.loc[go, "rn"].tolist(), x.loc[go, "to"].tolist())), set()
        for at in x.loc[~go, "rn"].tolist():
            while at is not None and at not in seen:
                seen.add(at)
                at = to.get(at)
        return pd.DataFrame({"rn": sorted(seen)}, dtype="int64")

    return _cut(_whole(step.unionByName(sure.select("rn", F.lit(-1).cast("long").alias("to"))), walk, "rn long"))


def _marks(packs: DataFrame, heads: DataFrame, entries: DataFrame, limit: float) -> DataFrame:
    """(_pid, _from, _to, _part, _before): the places of a range from a cut, or
    its first row, to the next one, with the number of their part; ``_before``
    is the rows before the range."""

    def cuts(batches):
        for x in batches:
            for row in x.itertuples():
                here = _Range(row, limit)
                follow, cut = here.next.tolist(), set()
                for at in [*here.starts.tolist(), *([] if row.at is None else row.at)]:
                    while at not in cut:
                        cut.add(at)
                        at = follow[at]
                at = np.array(sorted(cut | {0}), dtype=np.int64)
                real = np.array([i in cut for i in at.tolist()])
                group = np.searchsorted(here.inner, at, side="right")
                place = np.cumsum(real)
                head = np.searchsorted(group, group)  # the first of each one's group
                yield pd.DataFrame({"_pid": row.pid, "_from": at, "_to": np.r_[at[1:], here.n], "own": place - place[head] + real[head],
                                    "on": (group == 0) & here.more, "last": int((real & (group == len(here.inner))).sum())})

    at = entries.select(_range_of("entry").alias("_pid"), _place("entry").alias("at")) \
        .distinct().groupBy("_pid").agg(F.collect_list("at").alias("at"))
    rows = packs.select("_pid", "sizes", "inner").join(F.broadcast(heads), "_pid").join(at, "_pid", "left")
    rows = rows.select(F.col("_pid").alias("pid"), "sizes", "inner", "start", "more", "at")
    marks = _cut(rows.mapInPandas(cuts, "_pid int, _from long, _to long, own long, on boolean, last long"))
    w = Window.orderBy("_pid")
    upto = F.sum("last").over(Window.partitionBy("gl").orderBy("_pid"))  # one row per range
    carry = heads.join(marks.groupBy("_pid").agg(F.max("last").alias("last")), "_pid").withColumn("upto", upto)
    carry = carry.select("_pid", "before", F.when(F.col("more"), F.lag("upto").over(w)).otherwise(F.lit(0)).alias("carry"))
    part = F.col("own") + F.when(F.col("on"), F.col("carry")).otherwise(F.lit(0))
    return _cut(marks.join(F.broadcast(carry), "_pid").select("_pid", "_from", "_to", part.cast("int").alias("_part"), F.col("before").alias("_before")))


def bundle_plan(df: DataFrame, size_col: str | Column, order: list[str], max_bytes: float,
                group_col: str | None = None, part_col: str = "part", keep: list[str] | None = None) -> DataFrame:
    """Adds ``part`` (1-based, per group) by the exact greedy size cut, and
    ``_row``, the row's number in (group, order); ``keep``: the columns that
    are wanted besides, if not all (a ``size_col`` that is an expression is of
    these).

    The rows are sorted into ranges and written once; of each range the sizes
    are packed into one row.  From a part that starts at row s the next one
    starts at the first row of the group whose running total exceeds that
    before s by more than ``max_bytes`` and that has rows of some size before
    it in the part.  Inside a range these cuts follow at once.  Between ranges
    only those rows count whose part goes on behind their range: each leads to
    one of a later range, and the real ones are those reached from the groups'
    first rows.  A row's part is that of the stretch from cut to cut that it
    lies in, found without a shuffle of the rows up to BROADCAST_MARKS of them.
    Null and negative sizes count as 0; ``order`` has to be total, a null group
    is a group."""
    limit, ranges = float(max_bytes), ranges_for(df.count())
    by = [*([group_col] if group_col else []), *order]
    rows = df.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    if keep is not None:
        rows = rows.select(*dict.fromkeys([*keep, *([group_col] if group_col else [])]), "_at")
    rows = _cut(rows)
    size = F.col(size_col) if isinstance(size_col, str) else size_col
    packs = _packs(rows, F.greatest(F.coalesce(size.cast("double"), F.lit(0.0)), F.lit(0.0)), group_col, ranges)
    heads = _heads(packs)
    nodes = _nodes(packs, heads, limit)
    step = _led(nodes, packs, heads, limit)
    real = _real(nodes.filter("sure").select("rn"), step.filter("to is not null").select("rn", "to"))
    marks = _marks(packs, heads, step.join(real, "rn", "left_semi").filter("entry is not null").select("entry"), limit)
    # a stretch meets the rows of its steps, of as many rows as a stretch has on average
    n = marks.count()
    wide = max(1, ranges * graph.RANGE_ROWS // max(n, 1))
    marks = marks.withColumn("_step", F.explode(F.sequence(F.floor(F.col("_from") / wide), F.floor((F.col("_to") - 1) / wide))))
    marks = marks.select(*[F.col(c).alias(f"_m{c}") for c in marks.columns])
    on = ((_range_of("_at") == F.col("_m_pid")) & (F.floor(_place("_at") / wide) == F.col("_m_step"))
          & (_place("_at") >= F.col("_m_from")) & (_place("_at") < F.col("_m_to")))
    done = rows.join(F.broadcast(marks) if n <= BROADCAST_MARKS else marks, on)
    return done.select(*[F.col(f"`{c}`") for c in rows.columns if c != "_at"], (F.col("_m_before") + _place("_at") + 1).alias("_row"),
                       F.col("_m_part").alias(part_col))


def bundle_names(group: str, part: int) -> tuple[str, str]:
    prefix = "validation" if group == "all" else f"validation_{group}"
    return f"{prefix}_part_{part:02d}.zip", f"ecotaxa_{prefix}_part_{part:02d}.tsv"


def _zip_writer(out_dir: str, meta_cols: list[str], tags: dict[str, str]):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row")
        group, part = str(pdf["_group"].iloc[0]), int(pdf["part"].iloc[0])
        zname, tname = bundle_names(group, part)
        buf = io.StringIO()
        buf.write("\t".join(meta_cols) + "\n")
        buf.write("\t".join(tags[c] for c in meta_cols) + "\n")
        meta = pdf[meta_cols].astype(object).where(pdf[meta_cols].notna(), "")
        meta.to_csv(buf, sep="\t", header=False, index=False)
        images = {}
        for name, content in zip(pdf["img_file_name"], pdf["_content"]):
            if content is not None:
                images[str(name)] = bytes(content)  # same basename: last copy wins
        path = os.path.join(out_dir, zname)
        tmp = path + ".tmp"
        with zipfile.ZipFile(tmp, "w", compression=zipfile.ZIP_DEFLATED) as zf:
            zf.writestr(tname, buf.getvalue())
            for name, content in images.items():
                zf.writestr(name, content)
        os.replace(tmp, path)  # atomic: a retried task overwrites, never half-writes
        return pd.DataFrame({"zip_path": [path], "group": [group], "part": [part],
                             "rows": [len(pdf)], "images": [len(images)],
                             "bytes": [os.path.getsize(path)]})
    return fn


def bundle_export(export_table: DataFrame, images: DataFrame, out_dir: str, max_mb: float = 500.0,
                  split_mode: str = "none", classes=("non_living", "detritus"),
                  order: list[str] | None = None) -> DataFrame:
    """Write ZIP bundles; returns (zip_path, group, part, rows, images, bytes).

    ``export_table`` must carry ``_src`` (source image path); ``images`` is a
    ``binaryFile`` DataFrame (path, length, content).  Rows whose image is
    missing are dropped (semi-join on the listing); sizes come from the
    listing, so only bundled images' bytes are ever read."""
    from marisnow.operators.export import split_by_category
    os.makedirs(out_dir, exist_ok=True)
    imgs = images.select(F.col("path").alias("_src"), F.col("length").alias("_len"), F.col("content").alias("_content"))
    sizes = imgs.select("_src", "_len")
    et = export_table.join(sizes, "_src")  # inner: missing images excluded
    et = split_by_category(et, split_mode, classes)
    meta_cols = [c for c in export_table.columns if not c.startswith("_")]
    order = order or ["_src"]
    plan = bundle_plan(et, "_len", order, max_mb * MB, group_col="_group")
    tags = dtype_tags(export_table, meta_cols)
    withbytes = plan.join(imgs.select("_src", "_content"), "_src", "left")
    schema = "zip_path string, group string, part int, rows long, images long, bytes long"
    return withbytes.groupBy("_group", "part").applyInPandas(_zip_writer(out_dir, meta_cols, tags), schema)
