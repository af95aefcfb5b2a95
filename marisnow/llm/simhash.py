"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by
bit-sliced distance comparison.

Plan
----
1. Fingerprints in Arrow batches (only id and fingerprint leave the task).
2. The 64 bits are cut into six pieces.  Two fingerprints that differ in at
   most four bits agree in at least two pieces, so each distinct fingerprint
   is filed under the 15 pairs of pieces; no link is lost.
3. The filed rows are sorted by range, which splits any over-full bucket
   among tasks.  Inside a task whole batches of buckets are compared at once:
   bit planes are stored vertically (64 rows to a machine word), the planes
   are moved by 1, 2, 3 ... rows, and carry-save adders count the differing
   bits of 64 pairs together; a block is abandoned once all its pairs exceed
   the radius.
4. Buckets that touch a task's edge or are very large leave as packed blocks
   of at most 4096 fingerprints, and pairs of blocks are compared the same
   way.
5. Only links that join two groups (a spanning forest) are emitted, so a
   group of near copies never becomes all its pairs.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marisnow.llm.common import as_text, free_name, partitions, written
from marisnow.llm.components import connected_components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: widths of the six pieces; any four differing bits leave two pieces alike
PIECES = (11, 11, 11, 11, 10, 10)
BLOCK = 4096
PLANES_AT_ONCE = 16


# --------------------------------------------------------------- fingerprints

def simhash(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint of a UTF-8 text; 0 for a text without words."""
    words = data.lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    flat = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    ones = np.zeros(64, dtype=np.int64)
    step = 1 << 15
    for at in range(0, n, step):
        h = [digest(flat[s:e - 1], seed) for s, e in
             zip(starts[at:min(at + step, n)], ends[at + k - 1:at + k - 1 + step])]
        bits = np.unpackbits(np.array(h, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """``(id_col, _row, fp)`` for every row: a hash of the text and the 64
    bits of the fingerprint, as longs."""
    src = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("_row"), as_text(F.col(text_col)).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = np.array([simhash(t.as_py(), shingle, seed) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             ["id", "_row", "fp"])

    return src.mapInArrow(run, f"id {kind}, _row long, fp long").withColumnRenamed("id", id_col)


# ------------------------------------------------------------ bit-sliced parts

def planes_of(fp: np.ndarray) -> np.ndarray:
    """(64, words) bit planes of the fingerprints, padded to whole words."""
    n = -(-len(fp) // 64) * 64
    padded = np.zeros(n, dtype="<u8")
    padded[:len(fp)] = fp
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _moved(rows: np.ndarray, by: int) -> np.ndarray:
    """Packed rows moved down by ``by`` positions (position i gets i + by)."""
    q, r = divmod(by, 64)
    out = np.zeros_like(rows)
    w = rows.shape[-1]
    if q < w:
        out[..., :w - q] = rows[..., q:]
        if r:
            out >>= np.uint64(r)
            out[..., :w - q - 1] |= rows[..., q + 1:] << np.uint64(64 - r)
    return out


def _add(rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Carry-save sum of rows of one weight: the sum bit and the carries."""
    carries = []
    while len(rows) > 1:
        k = len(rows) // 3
        if k:
            a, b, c = rows[:k], rows[k:2 * k], rows[2 * k:3 * k]
            half = a ^ b
            carries.append((a & b) | (c & half))
            rows = np.concatenate([half ^ c, rows[3 * k:]])
        else:
            carries.append((rows[0] & rows[1])[None])
            rows = (rows[0] ^ rows[1])[None]
    return rows, carries


def within(differs, valid: np.ndarray, radius: int) -> np.ndarray | None:
    """Lanes of ``valid`` whose count of set bits over all 64 planes is at
    most ``radius``; None once every lane has exceeded it.

    ``differs(lo, hi)`` gives the XOR of planes lo..hi.  Counters are kept bit
    by bit (units, twos, fours, ...), as many as the radius needs, and a last
    sticky row notes an overflow."""
    top = radius.bit_length()
    count = np.zeros((top, *valid.shape), dtype=np.uint64)
    over = np.zeros_like(valid)
    for lo in range(0, 64, PLANES_AT_ONCE):
        rows = differs(lo, lo + PLANES_AT_ONCE)
        for bit in range(top):
            total, carries = _add(np.concatenate([count[bit][None], rows]))
            count[bit] = total[0]
            rows = np.concatenate(carries)
        over |= np.bitwise_or.reduce(rows, axis=0)
        far = over.copy()
        # count > radius, compared from the highest bit down
        same = ~over
        for bit in range(top - 1, -1, -1):
            if radius >> bit & 1:
                same = same & count[bit]
            else:
                far |= same & count[bit]
                same = same & ~count[bit]
        alive = valid & ~far
        if not alive.any():
            return None
    return alive


class _Forest:
    """Groups of row positions; keeps the links that joined two groups."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def flat(self) -> np.ndarray:
        up = self.up
        while True:
            nxt = up[up]
            if np.array_equal(nxt, up):
                self.up = up
                return up
            up = nxt

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        root = self.flat()
        new = root[left] != root[right]
        for a, b in zip(left[new].tolist(), right[new].tolist()):
            ra, rb = self.find(a), self.find(b)
            if ra != rb:
                self.up[max(ra, rb)] = min(ra, rb)
                self.links.append((a, b))


def _positions(lanes: np.ndarray, limit: int) -> np.ndarray:
    bits = np.unpackbits(lanes.view(np.uint8), bitorder="little")
    return np.flatnonzero(bits[:limit])


def links_in_buckets(fp: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Spanning links between rows of one bucket (rows sorted by bucket)."""
    forest = _Forest(len(fp))
    at = np.arange(len(fp))
    by = 1
    while True:
        # keep rows whose bucket still reaches `by` positions further
        _, inverse, size = np.unique(bucket, return_inverse=True, return_counts=True)
        stay = size[inverse] > by
        fp, bucket, at = fp[stay], bucket[stay], at[stay]
        if not len(fp):
            return forest.links
        planes = planes_of(fp)
        until = 2 * by
        while by < until and by < len(fp):
            valid = np.zeros(planes.shape[1] * 64, dtype=np.uint8)
            valid[:len(fp) - by] = bucket[by:] == bucket[:-by]
            lanes = np.packbits(valid, bitorder="little").view("<u8")
            if not lanes.any():
                return forest.links
            got = within(lambda lo, hi, s=by: planes[lo:hi] ^ _moved(planes[lo:hi], s), lanes, radius)
            if got is not None:
                i = _positions(got, len(fp))
                forest.join(at[i], at[i + by])
            by += 1


def links_of_blocks(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Spanning links between two blocks: position in left, then in right
    counted on from the end of left."""
    n = len(left)
    forest = _Forest(n + len(right))
    planes = planes_of(right)
    ones = np.full(planes.shape[1] * 64, 0, dtype=np.uint8)
    ones[:len(right)] = 1
    whole = np.packbits(ones, bitorder="little").view("<u8")
    sign = np.unpackbits(left.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    flip = np.where(sign == 1, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    for q in range(n):
        got = within(lambda lo, hi: planes[lo:hi] ^ flip[q, lo:hi, None], whole, radius)
        if got is not None:
            i = _positions(got, len(right))
            forest.join(np.full(len(i), q), n + i)
    return forest.links


# --------------------------------------------------------------------- linking

def _masks() -> list[int]:
    masks, low = [], 0
    for width in PIECES:
        masks.append(((1 << width) - 1) << low)
        low += width
    return [a | b for a, b in combinations(masks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int32()), ("m", pa.int64()),
                  ("block", pa.int64()), ("fps", pa.binary())])
LINK_DDL = "a long, b long, c int, m long, block long, fps binary"


def _links_batch(fp: np.ndarray, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    i = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    none = pa.nulls(len(i))
    return pa.RecordBatch.from_arrays(
        [pa.array(fp[i[:, 0]].view(np.int64)), pa.array(fp[i[:, 1]].view(np.int64)), none.cast(pa.int32()),
         none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary())], schema=LINK)


def _open_batch(c: int, m: int, fp: np.ndarray) -> pa.RecordBatch:
    parts = [fp[i:i + BLOCK] for i in range(0, len(fp), BLOCK)]
    k = len(parts)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array([c] * k, pa.int32()), pa.array([m] * k, pa.int64()),
         pa.array([int(p[0].view(np.int64)) for p in parts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
        schema=LINK)


def _scan_sorted(radius: int):
    """Kernel over a task's sorted ``(c, m, fp)`` rows: links of the buckets
    it holds whole, packed blocks of its first, its last and very large ones."""

    def run(batches):
        first = True
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # the bucket at the end of what was read

        def done(c, m, fp, last):
            nonlocal first
            if not len(fp):
                return
            cut = np.flatnonzero((c[1:] != c[:-1]) | (m[1:] != m[:-1])) + 1
            start, end = np.r_[0, cut], np.r_[cut, len(fp)]
            size = end - start
            loose = size > 2 * BLOCK
            loose[0] |= first
            loose[-1] |= last
            first = False
            for s, e in zip(start[loose], end[loose]):
                yield _open_batch(int(c[s]), int(m[s]), fp[s:e])
            keep = np.repeat(~loose & (size > 1), size)
            if keep.any():
                bucket = np.repeat(np.arange(len(size)), size)[keep]
                inside = fp[keep]
                if pairs := links_in_buckets(inside, bucket, radius):
                    yield _links_batch(inside, pairs)

        for b in batches:
            if not b.num_rows:
                continue
            c, m, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = fp.view(np.uint64)
            if held and (held[0][0][0], held[0][1][0]) == (c[-1], m[-1]) and (c[0], m[0]) == (c[-1], m[-1]):
                held.append((c, m, fp))  # the whole batch belongs to the held bucket
                if sum(len(x[2]) for x in held) > 16 * BLOCK:  # it can't be compared here anyway: pass it on in blocks
                    yield _open_batch(int(c[0]), int(m[0]), np.concatenate([x[2] for x in held[:-1]]))
                    held = held[-1:]
                    first = True  # the rest of this bucket has to meet what was passed on
                continue
            c, m, fp = (np.concatenate([*(x[i] for x in held), y]) for i, y in enumerate((c, m, fp)))
            tail = int(np.flatnonzero((c != c[-1]) | (m != m[-1]))[-1]) + 1 if (c[0], m[0]) != (c[-1], m[-1]) else 0
            yield from done(c[:tail], m[:tail], fp[:tail], False)
            held = [(c[tail:], m[tail:], fp[tail:])]
        if held:
            yield from done(*(np.concatenate([x[i] for x in held]) for i in range(3)), True)

    return run


def _scan_tiles(radius: int):
    def run(batches):
        for b in batches:
            for mine, left, right in zip(*(b.column(i).to_pylist() for i in range(3))):
                x, y = np.frombuffer(left, dtype="<u8"), np.frombuffer(right, dtype="<u8")
                if mine:
                    pairs, fp = links_in_buckets(x, np.zeros(len(x), dtype=np.int8), radius), x
                else:
                    pairs, fp = links_of_blocks(x, y, radius), np.concatenate([x, y])
                i = np.array(pairs, dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[i[:, 0]].view(np.int64)), pa.array(fp[i[:, 1]].view(np.int64))], ["a", "b"])

    return run


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)`` fingerprints at most ``radius`` (<= 4) bits apart: a
    spanning forest of the links between distinct values of ``fps.fp``."""
    if radius > 4:
        raise ValueError("six pieces prove completeness up to four differing bits")
    spark = fps.sparkSession
    n = partitions(spark)
    filed = (fps.select("fp").distinct()
             .select("fp", F.explode(F.array(*[
                 F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("m"))
                 for i, m in enumerate(_masks())])).alias("k"))
             .select("k.c", "k.m", "fp"))
    found = written(filed.repartitionByRange(n, "c", "m", "fp").sortWithinPartitions("c", "m", "fp")
                    .mapInArrow(_scan_sorted(radius), LINK_DDL), "simhash-links")
    blocks = found.filter("fps is not null").select("c", "m", "block", "fps")
    other = blocks.select("c", "m", F.col("block").alias("block2"), F.col("fps").alias("fps2"))
    tiles = (blocks.join(other, ["c", "m"]).filter("block <= block2")
             .select((F.col("block") == F.col("block2")).alias("mine"), "fps", "fps2"))
    return found.filter("fps is null").select("a", "b").unionByName(
        tiles.mapInArrow(_scan_tiles(radius), "a long, b long"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """``(id_col, fingerprint, component_id)``, one row per row of ``df``.

    Texts: A-Z lower-cased, words split at [\\x20\\x09-\\x0D], shingles of
    ``shingle`` words with repeats (a shorter text is one shingle).  Null and
    empty texts have fingerprint zero and are linked like any other, to each
    other and to whatever is within the radius.  ``component_id`` is the
    smallest id reachable over links; a null id is never chosen while the
    component has another.  Repeated rows come back as often as they came.
    Other columns are not read; an empty table gives no rows."""
    fps, member = _grouped(df, id_col, text_col, shingle, radius, seed)
    low = member.groupBy("component").agg(F.min("low").alias("component_id"))
    named = member.join(low, "component").select("fp", "component_id")
    return fps.join(named, "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _grouped(df: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, seed: int):
    """The rows with their fingerprints, and ``(fp, low, component)``: each
    distinct fingerprint with its smallest id and its component's least
    fingerprint."""
    fps = written(fingerprints(df, id_col, text_col, shingle, seed), "simhash-fps")
    groups = connected_components(links(fps, radius))
    least = fps.groupBy("fp").agg(F.min(id_col).alias("low"))
    member = least.join(groups, least["fp"] == groups["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    return fps, written(member, "simhash-members")


def one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """The rows of ``df`` less near copies: one row of each component of
    :func:`near_duplicates` stays, that of the smallest id (null after all
    others, then the smallest text hash; of repeated rows any one)."""
    fps, member = _grouped(df, id_col, text_col, shingle, radius, seed)
    row = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("_id"), F.col("_row"))
    best = (fps.groupBy("fp").agg(F.min(row).alias("best"))
            .join(member.select("fp", "component"), "fp")
            .groupBy("component").agg(F.min("best").alias("best")).select("best._id", F.col("best._row").alias("_best")))
    row_, place = free_name("text_key", df.columns), free_name("place", df.columns)
    src = df.withColumn(row_, F.xxhash64(text_col))
    kept = src.join(best, src[id_col].eqNullSafe(best["_id"]) & (src[row_] == best["_best"]), "left_semi")
    return kept.withColumn(place, F.row_number().over(Window.partitionBy(id_col, row_).orderBy(row_))).filter(
        F.col(place) == 1).select(*df.columns)
