"""Line deduplication against sharded minimal perfect hash indexes.

Plan
----
1. Every line's key is hashed to 128 bits; (document, line number, hash) rows
   are written once.  Distinct documents per hash are counted by partial
   aggregates, so a line that a third of all documents share is combined
   before it is shuffled.
2. The hashes found in enough documents are cut into shards of bounded size.
   Per shard a minimal perfect hash is built, which indexes three dense
   arrays: fingerprint (the other 64 bits), number of documents, and the
   document that keeps the line.
3. The line rows are dealt to (shard, salt) and probe the arrays; the arrays
   are copied to every salt, so no shard is hot and no task holds more than
   one shard's arrays.  Lines are never joined by their text or hash.
4. The dropped line numbers return to their document by one join.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marisnow.llm.common import BLANKS, free_name, lower_ascii, partitions, written

MIN_CHARS = 20
MIN_DOCS = 3
#: entries of one shard's arrays
SHARD_ROWS = 200_000
#: smallest number of copies of each shard
SALTS = 4
#: slots per remaining key in a level of the perfect hash
GAMMA = 1.5


def _mix(x: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash of the keys for each level."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: in each level a key that
    has a slot for itself takes it, the others go on to the next level."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []  # slots, packed taken bits, rank of the first
        rest, rank = keys, 0
        while len(rest):
            slots = int(len(rest) * GAMMA) + 1
            at = (_mix(rest, len(self.levels)) % np.uint64(slots)).astype(np.int64)
            alone = np.bincount(at, minlength=slots) == 1
            self.levels.append((slots, np.packbits(alone), rank))
            rank += int(alone.sum())
            rest = rest[~alone[at]]
        self.size = rank
        self._open()

    def _open(self) -> None:
        self._ranks = []
        for slots, packed, rank in self.levels:
            taken = np.unpackbits(packed, count=slots).astype(bool)
            self._ranks.append((taken, (np.cumsum(taken) - 1 + rank).astype(np.int64)))

    def __getstate__(self):
        return {"levels": self.levels, "size": self.size}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._open()

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, or of some other key if it is foreign; -1 where
        no level has a slot for it."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for level, (taken, ranks) in enumerate(self._ranks):
            at = (_mix(keys[todo], level) % np.uint64(len(taken))).astype(np.int64)
            hit = taken[at]
            out[todo[hit]] = ranks[at[hit]]
            todo = todo[~hit]
        return out


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _build(pdf):
    """One shard's hash rows -> its perfect hash and arrays, packed."""
    import pandas as pd

    h = pdf["h1"].to_numpy(np.int64).view(np.uint64)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    # the same first half for two lines: the arrays hold one, the others ride along as a short list
    extra = np.setdiff1d(np.arange(len(h)), first)
    mph = PerfectHash(h[first])
    at = mph(h[first])
    arrays = {}
    for name, kind in (("h2", np.int64), ("n_docs", np.int64), ("keep", np.int64)):
        arrays[name] = np.empty(mph.size, dtype=kind)
        arrays[name][at] = pdf[name].to_numpy(kind)[first]
    more = {(int(pdf["h1"].iloc[i]), int(pdf["h2"].iloc[i])): (int(pdf["n_docs"].iloc[i]), int(pdf["keep"].iloc[i]))
            for i in extra}
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "packed": [pickle.dumps((mph, arrays, more))]})


def _probe(batches):
    """Rows of (shard, salt) sorted so that a shard's arrays come before its
    lines; returns the line rows whose line is kept by another document."""
    mph = arrays = more = None
    for b in batches:
        shard, packed = b.column("shard").to_numpy(), b.column("packed")
        heads = np.flatnonzero(packed.is_valid().to_numpy(zero_copy_only=False))
        edges = [*heads.tolist(), b.num_rows]
        if not heads.size or heads[0]:
            edges.insert(0, 0)
        for s, e in zip(edges, edges[1:]):
            if packed[s].is_valid:
                mph, arrays, more = pickle.loads(packed[s].as_py())
                s += 1
            if s == e or mph is None:
                continue
            part = b.slice(s, e - s)
            h1, h2, doc = (part.column(c).to_numpy() for c in ("h1", "h2", "doc"))
            at = mph(h1.view(np.uint64))
            known = (at >= 0) & (arrays["h2"][at] == h2)
            drop = known & (arrays["keep"][at] != doc)
            if more:
                for i in np.flatnonzero(~known):
                    if hit := more.get((int(h1[i]), int(h2[i]))):
                        drop[i] = hit[1] != doc[i]
            if drop.any():
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).filter(pa.array(drop)) for c in ("doc", "row", "line")], ["doc", "row", "line"])


def shared_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """``(h1, h2, n_docs, keep)`` of the hashes found in ``min_docs`` or more
    documents; ``keep`` is the largest document."""
    return (rows.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
            .groupBy("h1", "h2").agg(F.count("one").alias("n_docs"), F.max("doc").alias("keep"))
            .filter(F.col("n_docs") >= min_docs))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                  min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc, row, lines)``: per document the numbers (from 0) of the lines
    it loses.  ``doc`` is the id (a null id counts as one document below all
    others), ``row`` a hash of the text, so rows that share an id but not a
    text stay apart."""
    spark = docs.sparkSession
    rows = (docs.select(_doc(F.col(id_col)).alias("doc"), F.xxhash64(text_col).alias("row"),
                        F.posexplode(_lines(F.col(text_col))).alias("line", "text"))
            .withColumn("key", line_key(F.col("text"))).filter(F.length("key") >= min_chars)
            .select("doc", "row", "line", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("second half"), "key").alias("h2")))
    rows = written(rows, "line-rows")
    shared = written(shared_lines(rows, min_docs), "line-shared")
    shards = max(1, -(-shared.count() // SHARD_ROWS))
    n = partitions(spark)
    salts = max(SALTS, -(-n // shards))
    shard = F.pmod(F.col("h1"), F.lit(shards)).cast("int")
    index = (shared.withColumn("shard", shard).groupBy("shard").applyInPandas(_build, "shard int, packed binary")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    lines = rows.select(shard.alias("shard"), F.pmod(F.xxhash64("doc", "row", "line"), F.lit(salts)).cast("int").alias("salt"),
                        F.lit(None).cast("binary").alias("packed"), "h1", "h2", "doc", "row", "line")
    both = index.unionByName(lines, allowMissingColumns=True)
    hit = (both.repartition(n, "shard", "salt")
           .sortWithinPartitions("shard", "salt", F.col("packed").isNull())
           .select("shard", "packed", "h1", "h2", "doc", "row", "line")
           .mapInArrow(_probe, "doc long, row long, line int"))
    return hit.groupBy("doc", "row").agg(F.collect_set("line").alias("lines"))


def _doc(col: Column) -> Column:
    return F.coalesce(col.cast("long"), F.lit(-(1 << 63)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of ``docs`` with the text less its dropped lines, plus
    ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without [\\x20\\x09-\\x0D] at both ends and A-Z
    lower-cased.  Keys of at least ``min_chars`` code points found in at least
    ``min_docs`` documents stay only in the largest id that holds them; there
    every line with the key stays.  Null and empty texts are one empty line;
    a null text stays null.  Rows with the same id are one document; a null
    id counts as an id below all others.  An empty table gives no rows; other
    columns pass through unless they are named like the two new ones, which
    then replace them."""
    doc, row, gone, every = (free_name(c, docs.columns) for c in ("line_doc", "line_row", "line_gone", "line_all"))
    drops = dropped_lines(docs, id_col, text_col, min_chars, min_docs).select(
        F.col("doc").alias(doc), F.col("row").alias(row), F.col("lines").alias(gone))
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    src = docs.select(*names, _doc(F.col(id_col)).alias(doc), F.xxhash64(text_col).alias(row))
    out = src.join(drops, [doc, row], "left").withColumn(every, _lines(F.col(text_col)))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(gone)),
                       lambda i: F.get(F.col(every), i))
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return out.select(*[text.alias(c) if c == text_col else F.col(c) for c in names],
                      F.size(every).cast("long").alias("n_lines"),
                      F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"))
