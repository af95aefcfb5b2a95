"""Benchmark decontamination: documents that hold word windows of test items.

The items' windows (a hash and the window's words) form a broadcast hash set,
behind a check of its size; larger sets are joined by shuffle.  A window of n
words that occurs in a document covers a whole block of (n + 1) // 2 words
that starts at a multiple of that length, so the scan hashes only these blocks,
tests a small bitmap and matches what is left with a set of all the items'
blocks of that length.  Around a match every window is built, matched by hash and verified by the words
themselves, so a hash collision is no hit.  Only hits are shuffled.  DataFrame
functions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marisnow.llm.common import free_name, lower_ascii, written

WINDOW = 10
#: windows up to which the set is broadcast (about 150 bytes each)
BROADCAST_WINDOWS = 200_000
#: words of the bitmap (64 block hashes each) that spares most blocks the join
BITMAP = 4096
#: between words: all of ASCII but digits and lower-case letters
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of digits, a-z and non-ASCII."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP, -1), lambda w: w != "")


def _windows(ws: Column, length: Column | int) -> Column:
    """Structs (at, n, hash, win) of all windows of ``length`` words."""
    n = F.lit(length) if isinstance(length, int) else length
    starts = F.when(F.size(ws) >= n, F.sequence(F.lit(0), F.size(ws) - n)).otherwise(
        F.array().cast("array<int>"))

    def one(i):
        win = F.array_join(F.slice(ws, i + 1, n), " ")
        return F.struct(i.alias("at"), n.cast("int").alias("n"), F.xxhash64(win).alias("hash"), win.alias("win"))

    return F.transform(starts, one)


def _block(n: int) -> int:
    """Longest block length that every run of ``n`` words covers one of."""
    return (n + 1) // 2


def _bitmap(blocks: DataFrame) -> Column:
    """Bitmap of the block hashes as a constant array of longs."""
    word = F.pmod(F.shiftright("hash", 6), F.lit(BITMAP))
    got = (blocks.select(word.alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("hash", F.lit(64)).cast("int")).alias("bit"))
           .groupBy("w").agg(F.bit_or("bit").alias("bits")).collect())  # at most BITMAP rows
    bits = {r["w"]: r["bits"] for r in got}
    return F.from_json(F.lit(str([bits.get(i, 0) for i in range(BITMAP)])), "array<bigint>")


def _maybe(bitmap: Column, hash_: Column) -> Column:
    word = F.get(bitmap, F.pmod(F.shiftright(hash_, 6), F.lit(BITMAP)).cast("int"))
    return F.getbit(word, F.pmod(hash_, F.lit(64)).cast("int")) == 1


def _blocks(ws: Column, n: int, bitmap: Column) -> Column:
    """Structs (n, hash, lo, near) of the blocks at multiples of their length
    that the bitmap lets pass; ``near`` are the words, from number ``lo`` on,
    of all windows of ``n`` words that cover the block."""
    b = _block(n)
    starts = F.when(F.size(ws) >= n, F.sequence(F.lit(0), F.size(ws) - b, F.lit(b))).otherwise(
        F.array().cast("array<int>"))

    def one(q):
        lo = F.greatest(q + (b - n), F.lit(0))
        return F.struct(F.lit(n).alias("n"), F.xxhash64(F.slice(ws, q + 1, b)).alias("hash"), lo.alias("lo"),
                        F.slice(ws, lo + 1, q + n - lo).alias("near"))

    return F.transform(F.filter(starts, lambda q: _maybe(bitmap, F.xxhash64(F.slice(ws, q + 1, b)))), one)


def _item_words(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``(item, ws, n)`` of the items with words; ``n`` their window length."""
    ws = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("ws")).filter(
        F.size("ws") > 0)
    return ws.withColumn("n", F.least(F.size("ws"), F.lit(window)))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """``(hash, win, n, items)``: each distinct window and the ids (as text)
    of the items that hold it."""
    return (_item_words(items, id_col, text_col, window)
            .select("item", F.inline(_windows(F.col("ws"), F.col("n"))).alias("at", "n", "hash", "win"))
            .groupBy("hash", "win", "n").agg(F.collect_set("item").alias("items")))


def benchmark_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                     window: int = WINDOW) -> DataFrame:
    """``(n, hash)`` of all runs of words that may be the block of a window
    of ``n`` words."""
    b = F.floor((F.col("n") + 1) / 2).cast("int")
    starts = F.sequence(F.lit(1), F.size("ws") - b + 1)
    return (_item_words(items, id_col, text_col, window)
            .select("n", F.explode(F.transform(starts, lambda i: F.xxhash64(F.slice("ws", i, b)))).alias("hash")).distinct())


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW) -> DataFrame:
    """``(doc, row, spans, items)`` of the documents with a hit: ``spans`` the
    distinct (at, n) word windows in order, ``items`` the sorted item ids;
    ``row`` is a hash of the text (see :func:`contamination`)."""
    grams = written(benchmark_windows(items, window=window), "benchmark-windows")
    sizes = sorted(r["n"] for r in grams.select("n").distinct().collect())  # at most `window` values
    small = grams.count() <= BROADCAST_WINDOWS
    tokens = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("row"),
                         words(F.col(text_col)).alias("ws"))
    blocks = benchmark_blocks(items, window=window)
    bitmap = _bitmap(blocks)
    each = [_blocks(F.col("ws"), n, bitmap) for n in sizes or [window]]
    put = F.broadcast if small else (lambda df: df)
    near = (tokens.select("doc", "row", F.inline(each[0] if len(each) == 1 else F.concat(*each)))
            .join(put(blocks), ["n", "hash"])
            .select("doc", "row", "lo", F.col("n").alias("size"), "near"))
    found = near.select("doc", "row", "lo", F.inline(_windows(F.col("near"), F.col("size"))))
    right = grams.select("hash", F.col("win").alias("win2"), F.col("n").alias("n2"), "items")
    met = found.join(put(right), "hash").filter("win = win2 and n = n2").withColumn("at", F.col("lo") + F.col("at"))
    return met.groupBy("doc", "row").agg(
        F.sort_array(F.collect_set(F.struct("at", "n"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def covered(spans: Column) -> Column:
    """Number of words inside the union of sorted (at, n) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))

    def step(acc, s):
        end = F.greatest(acc["end"], s["at"] + s["n"])
        return F.struct(end.alias("end"), (acc["sum"] + end - F.greatest(acc["end"], F.least(s["at"], end))).alias("sum"))

    return F.aggregate(spans, zero, step, lambda acc: acc["sum"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` plus ``n_words``, ``n_hit``, ``hit_spans``
    (word windows) and ``hit_items`` (ids as text, sorted).

    A window is ``window`` consecutive words of an item; an item of fewer
    words, but not none, is one window; null and empty texts have no words
    and hit nothing.  Repeated rows are judged each for itself and rows that
    share an id but not a text stay apart; a null id is an id like others.
    Empty tables work on either side.  Columns named like the new ones are
    replaced, other extra columns pass through."""
    new = ("n_words", "n_hit", "hit_spans", "hit_items")
    names = [c for c in docs.columns if c.lower() not in new]
    doc, row, spans, ids = (free_name(c, docs.columns) for c in ("met_doc", "met_row", "met_spans", "met_items"))
    found = hits(docs, items, id_col, text_col, window).select(
        F.col("doc").alias(doc), F.col("row").alias(row), F.col("spans").alias(spans), F.col("items").alias(ids))
    src = docs.select(*names, F.xxhash64(text_col).alias(row), F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    out = src.join(found, src[id_col].eqNullSafe(found[doc]) & (src[row] == found[row]), "left")
    empty = F.array().cast("array<string>")
    return out.select(*[src[c] for c in names], "n_words",
                      F.coalesce(covered(F.col(spans)), F.lit(0)).cast("long").alias("n_hit"),
                      F.col(spans).alias("hit_spans"), F.coalesce(ids, empty).alias("hit_items"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, mode: str = "documents") -> DataFrame:
    """``docs`` without contamination, in its own columns.

    ``mode="documents"`` drops documents with a hit; ``mode="spans"`` keeps
    them and cuts from the first to the last character of each run of hit
    words out of their text."""
    if mode not in ("documents", "spans"):
        raise ValueError("mode is 'documents' or 'spans'")
    if mode == "documents":
        doc, row = (free_name(c, docs.columns) for c in ("met_doc", "met_row"))
        met = hits(docs, items, id_col, text_col, window).select(F.col("doc").alias(doc), F.col("row").alias(row))
        src = docs.withColumn(row, F.xxhash64(text_col))
        return src.join(met, src[id_col].eqNullSafe(met[doc]) & (src[row] == met[row]), "left_anti").select(*docs.columns)
    found = contamination(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*docs.columns).alias("all")), items,
                          "id", "text", window)
    # the text as alternating gaps and words, in its own case; a gap after a hit word goes if the next word is hit too
    word = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    mark = lambda kind: lambda i: F.struct(i.alias("i"), F.lit(kind).alias("hit"))
    inside = F.array_distinct(F.flatten(F.transform("hit_spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1))))
    # every word's number, a hit one's twice: sorted, a number that is followed by its own mark is hit
    found = found.withColumn("marks", F.array_sort(F.concat(
        F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int")), mark(0)), F.transform(inside, mark(1)))))
    pairs = F.arrays_zip(F.col("marks").alias("x"), F.slice("marks", 2, F.greatest(F.size("marks") - 1, F.lit(1))).alias("next"))
    flags = F.transform(F.filter(pairs, lambda p: p["x"]["hit"] == 0),
                        lambda p: F.coalesce((p["next"]["hit"] == 1) & (p["next"]["i"] == p["x"]["i"]), F.lit(False)))
    found = found.withColumn("flags", flags)
    pieces = F.arrays_zip(F.split("text", word, -1).alias("gap"), F.regexp_extract_all("text", F.lit(word), F.lit(0)).alias("word"),
                          F.col("flags").alias("here"), F.concat(F.array(F.lit(False)), "flags").alias("before"))
    kept = F.transform(F.filter(pieces, lambda p: p["gap"].isNotNull()), lambda p: F.concat(
        F.when(p["here"] & p["before"], F.lit("")).otherwise(p["gap"]),
        F.when(p["here"], F.lit("")).otherwise(F.coalesce(p["word"], F.lit("")))))
    cut = F.when(F.col("n_hit") > 0, F.array_join(kept, "")).otherwise(F.col("text"))
    return found.select(*[cut.alias(c) if c == text_col else F.col("all").getField(c).alias(c) for c in docs.columns])
