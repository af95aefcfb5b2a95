"""Hard-negative mining over an inverted multi-index.

Plan
----
1. Two codebooks, one for each half of the dimensions, are trained on a
   bounded sample.  Every row goes into the cell of its two nearest codewords;
   the cells' sizes and radii (over all rows) are one row per cell.
2. A cell's rows are packed into matrices; a large cell is dealt into parts.
3. A search asks, for each query, for the best rows of one or several score
   windows.  The bound of a cell is the sum of two half scores, each query .
   codeword plus the query's length times the radius.  The multi-sequence heap
   yields cells by falling bound from the two sorted lists of half scores.
4. A first round visits the cells up to a budget of rows.  Its k-th best
   score in a window is that window's floor, and the second round goes on
   through the heap until no window can gain: the next bound is below every
   floor.  So windows are certified, and results exact.
5. The first search finds each anchor's positives (same label, any score),
   the second one its negatives in the positives' windows.

Visited (query, cell) pairs alone are shuffled: a cell's part meets the
queries of a bounded group that asked for it."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marisnow.llm.common import discard, partitions, whole_vectors, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: negatives score between these percentages of the positive's score
LOW, HIGH = 30, 90
#: rows that the codebooks are trained on, in the order of a hash of the id
SAMPLE = 16_384
#: rows in a cell on average, and codewords of a half at most
CELL_ROWS, MAX_WORDS = 256, 256
#: vectors in a matrix, rows in a part of a cell, queries in a group
BLOCK, PART, GROUP = 2048, 8192, 512
#: rows that a query visits in the first round
BUDGET = 2048
#: relative slack for rounding in the bounds
SLACK = 1e-9
NONE, ALL = -(2 ** 62), 2 ** 62


@dataclass
class Codebooks:
    """Codewords of both halves and, by cell (first word * words + second
    word), the number of rows and their largest distance to the words."""

    dims: int
    first: np.ndarray
    second: np.ndarray
    count: np.ndarray
    reach: np.ndarray  # (2, words, words)

    @property
    def half(self) -> int:
        return self.first.shape[1]

    @property
    def words(self) -> int:
        return len(self.first)

    def parts(self) -> np.ndarray:
        return np.maximum(1, -(-self.count // PART))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of an Arrow column as rows, shorter ones filled up with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), dims), dtype=np.int64)
    out[np.arange(dims)[None, :] < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def nearest(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's nearest word and its distance."""
    d2 = (words ** 2).sum(1)[None, :] - 2.0 * (x @ words.T)
    at = d2.argmin(1)
    return at, np.sqrt(((x - words[at]) ** 2).sum(1))


def train(x: np.ndarray, words: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Codewords by k-means; a word that loses all rows takes the row
    farthest from its own."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:words]].astype(float)
    for _ in range(rounds):
        at, far = nearest(x, c)
        size = np.bincount(at, minlength=len(c))
        c = np.stack([np.bincount(at, x[:, j], len(c)) for j in range(x.shape[1])], axis=1) / np.maximum(size, 1)[:, None] \
            if x.shape[1] else c
        empty = np.flatnonzero(size == 0)
        c[empty] = x[np.argsort(-far, kind="stable")[:len(empty)]]
    return c


def bounds(books: Codebooks, q: np.ndarray):
    """For one query: half scores, their slacks by word, and per cell the
    least and largest score that a row may have."""
    head, tail = q[:books.half], q[books.half:]
    a, b = books.first @ head, books.second @ tail
    n1, n2 = float(np.linalg.norm(head)), float(np.linalg.norm(tail))
    loose = SLACK * (1.0 + n1 * (np.linalg.norm(books.first, axis=1).max(initial=0.0) + books.reach[0].max(initial=0.0))
                     + n2 * (np.linalg.norm(books.second, axis=1).max(initial=0.0) + books.reach[1].max(initial=0.0)))
    middle = a[:, None] + b[None, :]
    width = n1 * books.reach[0] + n2 * books.reach[1] + loose
    return a + n1 * books.reach[0].max(1) + loose, b + n2 * books.reach[1].max(0), middle - width, middle + width


def multi_sequence(u: np.ndarray, v: np.ndarray):
    """``(bound, i, j)`` of all cells by falling ``u[i] + v[j]``: a heap over
    the two sorted lists, where a cell enters once both of its neighbours
    towards the front have left."""
    su, sv = np.argsort(-u, kind="stable"), np.argsort(-v, kind="stable")
    us, vs = u[su].tolist(), v[sv].tolist()
    left = [0] * len(us)  # how many cells of a row of the grid have left
    heap = [(-(us[0] + vs[0]), 0, 0)]
    while heap:
        bound, r, c = heapq.heappop(heap)
        yield -bound, int(su[r]), int(sv[c])
        left[r] = c + 1
        if c + 1 < len(vs) and (r == 0 or left[r - 1] > c + 1):
            heapq.heappush(heap, (-(us[r] + vs[c + 1]), r, c + 1))
        if r + 1 < len(us) and left[r + 1] == c:
            heapq.heappush(heap, (-(us[r + 1] + vs[c]), r + 1, c))


def visits(books: Codebooks, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, floor: np.ndarray | None, budget: int) -> list[int]:
    """Cells that a query visits in a round: without ``floor`` the first
    ones, up to the budget of rows; with it the rest that some window
    [max(lo, floor), hi] can still gain from."""
    u, v, least, most = bounds(books, q)
    first, rest = [], []
    seen = 0
    high = hi.max()
    start = float(lo.min())
    need = None if floor is None else np.maximum(lo, floor)
    end = start if need is None else float(need.min())
    for bound, i, j in multi_sequence(u, v):
        if seen < budget:
            if bound < start:
                break
            if books.count[i * books.words + j] and most[i, j] >= start and least[i, j] <= high:
                first.append(i * books.words + j)
                seen += int(books.count[first[-1]])
            continue
        if need is None or bound < end:
            break
        cell = i * books.words + j
        if books.count[cell] and ((most[i, j] >= need) & (least[i, j] <= hi)).any():
            rest.append(cell)
    return first if need is None else rest


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: by float64 where that is exact."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(q.shape[1], 1) < 2.0 ** 52:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return q @ x.T


def best_in_windows(score, keep, ids, lo, hi, k: int):
    """``(window, place)`` of a query's ``k`` best kept rows in each window,
    ties to the smaller id."""
    out = []
    for w, (a, b) in enumerate(zip(lo, hi)):
        at = np.flatnonzero(keep & (score >= a) & (score <= b))
        if len(at) > k:
            s = score[at]
            at = at[s >= np.partition(s, len(s) - k)[len(s) - k]]
            at = at[np.lexsort((ids[at], -score[at]))[:k]]
        out += [(w, int(p)) for p in at]
    return out


INDEXED = "id long, label long, cell int, d1 double, d2 double, vec binary"
PACKED = "cell int, part int, ids binary, labels binary, vecs binary"
ASKED = "qg long, cell int, part int, n int, windows int, ids binary, labels binary, vecs binary, lo binary, hi binary"
FOUND = "query_id long, w int, vec_id long, score long"


class Index:
    """Inverted multi-index of ``(id, label, v)`` rows."""

    def __init__(self, rows: DataFrame, dims: int, sample: int | None = None, cell_rows: int | None = None, max_words: int | None = None):
        sample, cell_rows, max_words = sample or SAMPLE, cell_rows or CELL_ROWS, max_words or MAX_WORDS
        self.spark, self.dims = rows.sparkSession, dims
        half = (dims + 1) // 2
        n = rows.count()
        words = int(np.clip(round((n / cell_rows) ** 0.5), 1, max_words))
        taken = rows.orderBy(F.xxhash64("id"), "id", "v").limit(sample).select("v").toPandas()["v"]
        x = np.zeros((len(taken), dims))
        for r, t in zip(x, taken):
            r[:len(t)] = t
        first, second = train(x[:, :half], words, 1), train(x[:, half:], words, 2)
        words = len(first)

        def assign(batches):
            for b in batches:
                m = _matrix(b.column(2), dims)
                c1, d1 = nearest(m[:, :half].astype(float), first)
                c2, d2 = nearest(m[:, half:].astype(float), second)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array((c1 * words + c2).astype(np.int32)), pa.array(d1), pa.array(d2),
                     pa.array([r.tobytes() for r in m], pa.binary())], ["id", "label", "cell", "d1", "d2", "vec"])

        self.rows = written(rows.select("id", "label", "v").mapInArrow(assign, INDEXED), "hardneg-rows")
        count = np.zeros(words * words, dtype=np.int64)
        reach = np.zeros((2, words, words))
        # one row per cell, words * words at most
        for r in self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).collect():
            at = divmod(r["cell"], words)
            count[r["cell"]] = r["n"]
            reach[0][at], reach[1][at] = r["d1"] * (1 + SLACK), r["d2"] * (1 + SLACK)
        self.books = Codebooks(dims, first, second, count, reach)
        self.blocks = written(self._pack(), "hardneg-blocks")

    def _pack(self) -> DataFrame:
        parts = self.books.parts()

        def run(batches):
            cell, held, task, number = None, [], None, 0

            def out():
                nonlocal number, held
                number += 1
                part = int((number + task * 7919) % parts[cell])
                block = pa.RecordBatch.from_arrays(
                    [pa.array([cell], pa.int32()), pa.array([part], pa.int32()), *(pa.array([b"".join(h)], pa.binary()) for h in zip(*held))],
                    ["cell", "part", "ids", "labels", "vecs"])
                held = []
                return block

            for b in batches:
                ids, labels, cells = (b.column(i).to_numpy() for i in (0, 1, 2))
                vecs = b.column(3)
                task = int(b.column(4)[0].as_py()) if b.num_rows else task
                for i, c in enumerate(cells.tolist()):
                    if held and (c != cell or len(held) == BLOCK):
                        yield out()
                    cell = c
                    held.append((ids[i:i + 1].tobytes(), labels[i:i + 1].tobytes(), vecs[i].as_py()))
            if held:
                yield out()

        dealt = self.rows.repartitionByRange(partitions(self.spark), "cell", "id").sortWithinPartitions("cell", "id")
        return dealt.select("id", "label", "cell", "vec", F.spark_partition_id().alias("task")).mapInArrow(run, PACKED)

    def grouped(self, anchors: DataFrame) -> DataFrame:
        """``(id, label, vec, qg)``: one row per id of ``anchors`` (rows with
        ``id`` and ``asked``), like ones in groups of at most GROUP."""
        rows = (anchors.groupBy("id").agg(F.min(F.struct("cell", "vec", "label")).alias("r"))
                .select("id", "r.cell", "r.vec", "r.label"))

        def run(batches):
            at = 0
            for b in batches:
                place = at + np.arange(b.num_rows)
                at += b.num_rows
                qg = (b.column(4).to_numpy().astype(np.int64) << 32) + place // GROUP
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), b.column(2), pa.array(qg)], ["id", "label", "vec", "qg"])

        dealt = rows.repartitionByRange(partitions(self.spark), "cell", "id").sortWithinPartitions("cell", "id")
        return written(dealt.select("id", "cell", "vec", "label", F.spark_partition_id().alias("task"))
                       .mapInArrow(run, "id long, label long, vec binary, qg long"), "hardneg-queries")

    def _round(self, queries: DataFrame, same: bool, k: int, last: bool) -> DataFrame:
        """Best rows of the cells that a round visits.  ``queries``: (id,
        label, vec, qg, windows array<struct<w, lo, hi, floor>>)."""
        books, dims, budget = self.books, self.dims, BUDGET
        parts = books.parts()

        def plan(pdf: pd.DataFrame) -> pd.DataFrame:
            vecs = np.stack([np.frombuffer(v, np.int64) for v in pdf["vec"]])
            ids, labels = pdf["id"].to_numpy(np.int64), pdf["label"].to_numpy(np.int64)
            widest = max(len(w) for w in pdf["windows"])
            lo, hi = np.full((len(pdf), widest), ALL), np.full((len(pdf), widest), NONE)  # unused: empty windows
            wanted: dict[int, list[int]] = {}
            for i, windows in enumerate(pdf["windows"]):
                a, b, f = (np.array([w[c] for w in windows], dtype=np.int64) for c in ("lo", "hi", "floor"))
                for cell in visits(books, vecs[i].astype(float), a, b, f if last else None, budget):
                    wanted.setdefault(cell, []).append(i)
                lo[i, [w["w"] for w in windows]], hi[i, [w["w"] for w in windows]] = np.maximum(a, f), b
            out = []
            for cell, at in wanted.items():
                for part in range(int(parts[cell])):
                    out.append((int(pdf["qg"].iloc[0]), cell, part, len(at), widest, ids[at].tobytes(), labels[at].tobytes(),
                                vecs[at].tobytes(), lo[at].tobytes(), hi[at].tobytes()))
            return pd.DataFrame(out, columns=[c.split()[0] for c in ASKED.split(", ")])

        def meet(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            found = []
            for row in q.itertuples():
                q_ids, q_labels = np.frombuffer(row.ids, np.int64), np.frombuffer(row.labels, np.int64)
                q_vecs = np.frombuffer(row.vecs, np.int64).reshape(-1, dims)
                lo, hi = (np.frombuffer(c, np.int64).reshape(row.n, row.windows) for c in (row.lo, row.hi))
                for block in x.itertuples():
                    ids, labels = np.frombuffer(block.ids, np.int64), np.frombuffer(block.labels, np.int64)
                    score = _scores(q_vecs, np.frombuffer(block.vecs, np.int64).reshape(-1, dims))
                    for i in np.flatnonzero((score.max(1) >= lo.min(1)) & (score.min(1) <= hi.max(1))).tolist():
                        keep = (labels == q_labels[i]) == same
                        keep &= ids != q_ids[i]
                        for w, p in best_in_windows(score[i], keep, ids, lo[i].tolist(), hi[i].tolist(), k):
                            found.append((int(q_ids[i]), w, int(ids[p]), int(score[i, p])))
            return pd.DataFrame(found, columns=["query_id", "w", "vec_id", "score"])

        asked = written(queries.groupBy("qg").applyInPandas(plan, ASKED), "hardneg-asked")
        visited = self.blocks.join(asked.select("cell", "part", F.col("qg").alias("group")), ["cell", "part"])
        return written(_first(visited.groupBy("cell", "part", "group").cogroup(asked.groupBy("cell", "part", "qg"))
                              .applyInPandas(meet, FOUND), k), "hardneg-found")

    def search(self, queries: DataFrame, windows: DataFrame, same: bool, k: int) -> DataFrame:
        """``(query_id, w, vec_id, score, rank)``: the ``k`` best rows of each
        window (``windows``: id, w, lo, hi), with the query's label if
        ``same``, else with another one; exact."""
        entry = lambda floor: F.struct(F.col("w"), F.col("lo"), F.col("hi"), floor.cast("long").alias("floor"))
        asked = queries.join(windows.groupBy("id").agg(F.sort_array(F.collect_list(entry(F.lit(NONE)))).alias("windows")), "id")
        early = self._round(asked, same, k, False)
        low = early.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), "w", F.col("score").alias("floor"))
        now = windows.join(low, ["id", "w"], "left")
        asked = queries.join(now.groupBy("id").agg(F.sort_array(F.collect_list(entry(F.coalesce("floor", F.lit(NONE))))).alias("windows")), "id")
        late = self._round(asked, same, k, True)
        return _first(early.drop("rank").unionByName(late.drop("rank")), k)

    def close(self) -> None:
        discard(self.rows)
        discard(self.blocks)


def _first(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id", "w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _share(percent: int, up: bool) -> Column:
    """Least or largest whole score s with 100 * s beyond percent * positive."""
    x = F.lit(percent).cast("decimal(10,0)") * F.col("positive_score").cast("decimal(19,0)") / F.lit(100).cast("decimal(3,0)")
    return (F.ceil(x) if up else F.floor(x)).cast("long")


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``: for each anchor (rows where ``is_anchor`` holds) its
    best ``positives`` other rows of the same label, and for each of them the
    first ``negatives`` rows of other labels that score between ``low`` and
    ``high`` percent of the positive's score; all, if fewer.

    Rows with a null id, label or vector, or with null or non-finite
    components take no part.  Shorter vectors are filled up with zeros.  Ties
    go to the smaller id.  Of rows that share an id each is a candidate, none
    of them for an anchor of that id; the anchor is the least of them by cell
    and vector.  A negative positive score has an empty window, one of 0 takes
    scores of 0.  Labels are integers, or text told apart by a 64-bit hash.
    An anchor without positives or negatives has no rows, an empty table
    none.  Other columns are not read, whatever their names."""
    label = F.col(label_col)
    kind = df.schema[label_col].dataType.typeName()
    code = label.cast("long") if kind in ("byte", "short", "integer", "long") else F.xxhash64(label)
    src = df.select(F.col(id_col).cast("long").alias("id"), F.when(label.isNotNull(), code).alias("label"),
                    F.col(vec_col).alias("_e"), F.coalesce(is_anchor, F.lit(False)).alias("asked"))
    src = whole_vectors(src, "_e", scale, "v").filter("id is not null and label is not null").select("id", "label", "v", "asked")
    spark = df.sparkSession
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    widest = src.agg(F.max(F.size("v"))).first()[0]
    if widest is None:
        return spark.createDataFrame([], empty)
    index = Index(src, max(1, widest))
    anchors = src.filter("asked").select("id").distinct()
    queries = index.grouped(index.rows.join(anchors, "id", "left_semi"))
    whole = queries.select("id", F.lit(0).alias("w"), F.lit(NONE).cast("long").alias("lo"), F.lit(ALL).cast("long").alias("hi"))
    near = written(index.search(queries, whole, True, positives)
                   .select("query_id", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"),
                           F.col("score").alias("positive_score")), "hardneg-positives")
    windows = (near.select(F.col("query_id").alias("id"), "w", _share(low, True).alias("lo"), _share(high, False).alias("hi"))
               .filter("lo <= hi"))
    hard = index.search(queries, windows, False, negatives)
    return (hard.join(near, ["query_id", "w"])
            .select(F.col("query_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
                    F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
