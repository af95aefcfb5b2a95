"""Exact top-k inner products over norm-sorted vectors.

Plan
----
1. Vectors are rotated into the eigenbasis of their Gram matrix (the right
   singular vectors; the matrix is a sum of small per-task matrices), so the
   first coordinates carry most of the length.
2. Vectors are sorted by range of descending length and packed into blocks;
   ties in length are split by id.
3. Query blocks meet the first group of blocks - the longest vectors - and
   each query gets the k-th best score so far as its floor.
4. Query blocks meet the other groups up to the one from which on
   |q| max|x| is below every floor of the block; only these pairs are
   shuffled.  A block whose Cauchy-Schwarz bound
   |q| max|x| is below a query's floor is skipped; inside a block partial
   sums over the leading rotated coordinates plus the bound on the residual
   prune most vectors, and the survivors get their exact integer score.
5. The groups' best scores are merged per query.

Both sides of a cell (a group of blocks and a block of queries) are bounded,
whatever the number of vectors or queries."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marisnow.llm.common import partitions, written

SCALE = 1024
K = 10
#: vectors in a block, blocks in a group, queries in a block
BLOCK, GROUP, QUERIES = 2048, 8, 1024
#: share of the rotated coordinates in the partial sums
HEAD = 0.25
#: group numbers at which the lengths are looked up, at most
MARKS = 4096
#: relative slack for rounding in the bounds
SLACK = 1e-9

PACKED = "block long, n int, high double, ids binary, vecs binary"


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """``(id, v, length)``: components floor(scale * x) as longs.  Vectors
    that are null or hold null or non-finite components take no part."""
    good = F.col(vec_col).isNotNull() & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x)
                                                 & (F.abs(x) < float("inf")))
    v = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return df.filter(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).withColumn(
        "length", length)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of an Arrow column as rows, shorter ones filled up with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), dims), dtype=np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(dims)[None, :] < size[:, None]] = flat
    return out


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all vectors, the strongest direction first
    (dims x dims; only this matrix comes to the driver)."""

    def grams(batches):
        total = np.zeros((dims, dims))
        for b in batches:
            m = _matrix(b.column(0), dims).astype(float)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(dims), dims)), pa.array(np.tile(np.arange(dims), dims)),
                                          pa.array(total.ravel())], ["i", "j", "x"])

    got = vectors.select("v").mapInArrow(grams, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    gram = np.zeros((dims, dims))
    gram[got["i"], got["j"]] = got["x"]
    _, basis = np.linalg.eigh(gram)
    return np.ascontiguousarray(basis[:, ::-1])


def _packed(dims: int, rows: int, start_at: int):
    """Kernel: a task's (id, v, length, part) rows as blocks of ``rows``."""

    def run(batches):
        held_ids, held, high, count = [], [], 0.0, 0
        number = None

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([count], pa.int32()), pa.array([high]),
                 pa.array([np.concatenate(held_ids).tobytes()], pa.binary()),
                 pa.array([np.concatenate(held).tobytes()], pa.binary())], ["block", "n", "high", "ids", "vecs"])

        for b in batches:
            ids, m = b.column(0).to_numpy(), _matrix(b.column(1), dims)
            length, part = b.column(2).to_numpy(), b.column(3).to_numpy()
            at = 0
            while at < len(ids):
                if number is None:
                    number = (int(part[0]) << 32) + start_at
                take = min(rows - count, len(ids) - at)
                held_ids.append(ids[at:at + take])
                held.append(m[at:at + take])
                high = max(high, float(length[at:at + take].max()))
                count, at = count + take, at + take
                if count == rows:
                    yield out()
                    held_ids, held, high, count, number = [], [], 0.0, 0, number + 1
        if count:
            yield out()

    return run


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: by float64 where that is exact."""
    dims = max(q.shape[1], 1)
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * dims < 2.0 ** 52:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return q @ x.T


def cell(q_ids, q, floor, blocks, basis: np.ndarray, k: int):
    """Best ``k`` (score, id) of each query among the blocks, given by
    descending length; ``floor``: scores below can't be among a query's best
    (-inf: none yet).  Returns query number, id and score arrays."""
    head = max(1, int(basis.shape[0] * HEAD)) if basis.shape[0] else 0
    turned = q.astype(float) @ basis
    length = np.sqrt((turned ** 2).sum(1))
    rest = np.sqrt((turned[:, head:] ** 2).sum(1))
    floor = floor.copy()
    best: list[list[tuple[int, int]]] = [[] for _ in q_ids]  # (-score, id), sorted
    for ids, x, high in blocks:
        bound = length * high
        live = np.flatnonzero(bound * (1 + SLACK) + SLACK >= floor)
        if not len(live):
            continue
        tx = x.astype(float) @ basis
        part = turned[live, :head] @ tx[:, :head].T
        x_rest = np.sqrt((tx[:, head:] ** 2).sum(1))
        reach = part + rest[live, None] * x_rest[None, :]
        reach += SLACK * (1 + bound[live, None])
        may = reach >= floor[live, None]
        for j in np.flatnonzero(may.any(1)):
            i = live[j]
            at = np.flatnonzero(may[j])
            at = at[ids[at] != q_ids[i]]
            if not len(at):
                continue
            score = _exact(q[i:i + 1], x[at])[0]
            if len(at) > k:  # all that reach the k-th best of the block, ties included
                keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                at, score = at[keep], score[keep]
            order = np.lexsort((ids[at], -score))[:k]
            best[i] = sorted([*best[i], *zip((-score[order]).tolist(), ids[at[order]].tolist())])[:k]
            if len(best[i]) == k:
                floor[i] = max(floor[i], -best[i][-1][0])
    number = np.repeat(np.arange(len(q_ids)), [len(b) for b in best])
    flat = [p for b in best for p in b]
    return number, np.array([p[1] for p in flat], dtype=np.int64), np.array([-p[0] for p in flat], dtype=np.int64)


FOUND = "query_id long, vec_id long, score long"


def _numbered(blocks: DataFrame, name: str, each: int) -> tuple[DataFrame, int]:
    """Blocks with the number of their group of ``each`` in block order, and
    how many groups there are.  A block's number holds its part (the task
    that packed it) and its place there, so only the parts' totals, one row a
    part, are summed up."""
    part = F.shiftright("block", 32)
    totals = blocks.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offset = totals.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    place = F.col("offset") + F.col("block").bitwiseAND(F.lit((1 << 32) - 1))
    count = -(-blocks.count() // each)
    out = blocks.withColumn("part", part).join(F.broadcast(offset), "part").withColumn(name, F.floor(place / each))
    return out.drop("part", "offset"), count


def last_groups(marks: list[tuple[int, float]], n_groups: int):
    """Function of (longest query, least floor): the number of groups, in
    their order of descending length, that may reach the floor.  ``marks``:
    (group, its greatest length) of some groups in order."""
    at = [m[0] for m in marks]
    high = np.array([m[1] for m in marks])

    def groups(longest: float, least: float) -> int:
        if not np.isfinite(least):
            return n_groups
        fails = np.flatnonzero(longest * high * (1 + SLACK) + SLACK < least)
        return at[int(fails[0])] if len(fails) else n_groups

    return groups


def _met(blocks: DataFrame, queries: DataFrame, groups: tuple[int, int], n_queries: int, basis: np.ndarray, dims: int,
         k: int, until=None) -> DataFrame:
    """Best of every cell: groups lo..hi-1 of blocks against each query
    block.  ``queries`` has the packed columns, its number ``qb`` and
    ``floors``; with ``until`` (see :func:`last_groups`) and ``least``, a
    block's least floor, only the groups that it allows."""
    lo, hi = groups
    if hi <= lo or not n_queries:
        return blocks.sparkSession.createDataFrame([], FOUND)
    end = F.lit(hi).cast("long") if until is None else F.udf(lambda q, f: max(lo, min(hi, until(q, f))), "long")("high", "least")
    right = (queries.withColumn("end", end).filter(F.col("end") > lo)
             .withColumn("group", F.explode(F.sequence(F.lit(lo).cast("long"), F.col("end") - 1))).drop("end"))
    if until is None:
        left = blocks.filter(F.col("group").between(lo, hi - 1)).withColumn(
            "qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_queries - 1).cast("long"))))
    else:
        left = blocks.join(right.select("group", F.col("qb").alias("q")), "group").withColumnRenamed("q", "qb")

    def run(key, x, q):
        x = x.sort_values(["high", "block"], ascending=[False, True])
        parts = [(np.frombuffer(i, np.int64), np.frombuffer(v, np.int64).reshape(-1, dims), h)
                 for i, v, h in zip(x["ids"], x["vecs"], x["high"])]
        out = []
        for i, v, f in zip(q["ids"], q["vecs"], q["floors"]):
            ids = np.frombuffer(i, np.int64)
            n, vec, score = cell(ids, np.frombuffer(v, np.int64).reshape(-1, dims), np.frombuffer(f, float), parts, basis, k)
            out.append(pd.DataFrame({"query_id": ids[n], "vec_id": vec, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    return left.groupBy("group", "qb").cogroup(right.groupBy("group", "qb")).applyInPandas(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
          scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of ``vectors`` with
    the highest integer inner product for each row of ``queries`` (a subset
    by id), itself excepted; ties go to the smaller id; all, if fewer.

    Shorter vectors are filled up with zeros (an empty one scores 0 with
    all).  Null ids take no part; of rows that share an id each is a
    candidate, and the id's query is that of any one of them.  Scores are
    exact while they fit a long.  Extra columns are not read; without queries
    or other vectors there are no rows."""
    spark = vectors.sparkSession
    n = partitions(spark)
    all_v = written(whole_vectors(vectors, id_col, vec_col, scale).filter("id is not null"), "topk-vectors")
    want = whole_vectors(queries, id_col, vec_col, scale).filter("id is not null").dropDuplicates(["id"])
    dims = all_v.agg(F.max(F.size("v")).alias("d")).first()["d"] or 0
    basis = rotation(all_v, dims) if dims else np.zeros((0, 0))
    cols = ("id", "v", "length", "part")
    blocks = (all_v.repartitionByRange(n, F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id")
              .withColumn("part", F.spark_partition_id()).select(*cols).mapInArrow(_packed(dims, BLOCK, 0), PACKED))
    blocks = written(blocks, "topk-blocks")
    numbered, n_groups = _numbered(blocks, "group", GROUP)
    q = want.repartition(max(1, -(-want.count() // QUERIES)), "id").withColumn("part", F.spark_partition_id())
    q = written(q.select(*cols).mapInArrow(_packed(dims, QUERIES, 0), PACKED), "topk-queries")
    asked, n_asked = _numbered(q, "qb", 1)
    none = F.udf(lambda m: np.full(m, -np.inf).tobytes(), "binary")
    first = written(_met(numbered, asked.withColumn("floors", none("n")), (0, min(1, n_groups)), n_asked, basis, dims, k), "topk-first")
    low = _best(first, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
    step = -(-n_groups // MARKS) or 1
    marks = (numbered.filter((F.col("group") % step == 0) & (F.col("group") > 0)).groupBy("group").agg(F.max("high").alias("high"))
             .orderBy("group").collect())  # MARKS rows at most
    until = last_groups([(int(m["group"]), float(m["high"])) for m in marks], n_groups)
    rest = _met(numbered, written(_floors(asked, low), "topk-asked"), (1, n_groups), n_asked, basis, dims, k, until)
    return _best(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def _floors(q: DataFrame, low: DataFrame) -> DataFrame:
    """The query blocks with ``floors`` in the order of their ids, and
    ``least``, the smallest of them."""
    ids = q.select("block", "ids").mapInPandas(
        lambda it: (pd.concat([pd.DataFrame({"block": b, "id": np.frombuffer(i, np.int64),
                                             "at": np.arange(len(i) // 8)}) for b, i in zip(p["block"], p["ids"])])
                    for p in it if len(p)), "block long, id long, at long")
    packed = (ids.join(low, "id", "left").groupBy("block")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "floor"))), lambda s: s["floor"]).alias("f"),
                   F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("least")))
    pack = F.udf(lambda f: np.array([-np.inf if x is None else x for x in f]).tobytes(), "binary")
    return q.join(packed, "block").withColumn("floors", pack("f")).drop("f")
