"""Incremental secret scans over content-addressed blobs.

Every version of every path is a blob, addressed by the SHA-256 of its text.
A ledger holds which rule versions have read which blob, with the spans they
found.  A scan reads only unseen (blob, rule version) pairs - one text per
blob, however many paths and versions share it -, appends what it found to
the ledger, and joins the ledger's findings back to all paths.  DataFrame
functions throughout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


@dataclass(frozen=True)
class Rule:
    """``pattern`` (Java syntax) matched leftmost and non-overlapping over
    the whole text; a match counts if it has ``min_total`` and its group
    ``group`` (0: none) ``min_value`` code points.  ``quick`` is a pattern or,
    if ``literal``, a substring that every text with a match holds."""

    kind: str
    pattern: str
    quick: str
    version: int = 1
    min_total: int = 1
    group: int = 0
    min_value: int = 0
    literal: bool = False

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


#: the base rules, in the order of their kinds
BASE = (
    Rule("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         "(?i)(?:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]", group=2, min_value=8),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA", min_total=16, literal=True),
    Rule("hex", "[0-9a-f]{32,}", "[0-9a-f]{32}", min_total=32),
)
#: rules beyond the base: code-host tokens, signed web tokens, private keys
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", "eyJ", literal=True),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN ", literal=True),
)
RULES = BASE + MORE

SCANS = "array<struct<rule:string,spans:array<struct<start:int,stop:int>>>>"
LEDGER = f"blob string, scans {SCANS}"


def find_spans(text: Column, rule: Rule) -> Column:
    """``array<struct<start,stop>>`` of a rule's matches in code points.

    The text is taken apart into (gap, match) pieces, of which the lengths
    give the positions; the last piece ends the text with an empty match."""
    whole = F.lit(f"(?s)(.*?)({rule.pattern}|\\z)")
    part = lambda group: F.transform(F.regexp_extract_all(text, whole, F.lit(group)), lambda x: F.length(x))
    pieces = F.arrays_zip(part(1).alias("gap"), part(2).alias("size"),
                          (part(rule.group + 2) if rule.group else part(2)).alias("value"))
    kind = "array<struct<start:int,stop:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc, p):
        start = acc["at"] + p["gap"]
        stop = start + p["size"]
        good = (p["size"] >= rule.min_total) & (p["value"] >= rule.min_value)
        one = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct(stop.alias("at"), F.when(good, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    maybe = F.contains(text, F.lit(rule.quick)) if rule.literal else F.rlike(text, F.lit(rule.quick))
    return F.when(maybe, F.aggregate(pieces, zero, step, lambda acc: acc["out"])).otherwise(F.array().cast(kind))


class Ledger:
    """The table of scanned blobs at ``path`` (any store Spark reads)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], LEDGER)

    def update(self, versions: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
        """Scan the unseen (blob, rule version) pairs of ``versions`` and
        append them; nothing unseen appends no rows.  A run that dies before
        its rows are committed leaves the ledger as it was."""
        ids = F.array(*[F.lit(r.id) for r in rules])
        seen = self.read().groupBy("blob").agg(
            F.flatten(F.collect_list(F.transform("scans", lambda s: s["rule"]))).alias("seen"))
        # copies fall together in each task before any text travels
        blobs = with_blob(versions.select(F.coalesce(text_col, F.lit("")).alias("text")), "text").dropDuplicates(["blob"])
        todo = (blobs.join(seen, "blob", "left")
                .withColumn("todo", F.array_except(ids, F.coalesce("seen", F.array().cast("array<string>"))))
                .filter(F.size("todo") > 0).select("blob", "todo", "text"))
        scans = F.filter(F.array(*[
            F.when(F.array_contains("todo", r.id), F.struct(
                F.lit(r.id).alias("rule"), find_spans(F.col("text"), r).alias("spans"))) for r in rules]),
            lambda s: s.isNotNull())
        todo.select("blob", scans.cast(SCANS).alias("scans")).write.mode("append").parquet(self.path)

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """``(blob, found)`` of the blobs in which these rule versions found
        anything: spans by start, then in the rules' order."""
        ids = F.array(*[F.lit(r.id) for r in rules])
        one = F.explode("scans").alias("s")
        return (self.read().filter(F.exists("scans", lambda s: F.size(s["spans"]) > 0)).select("blob", one)
                .filter(F.array_contains(ids, F.col("s.rule")))
                .select("blob", F.explode("s.spans").alias("p"), F.array_position(ids, F.col("s.rule")).cast("int").alias("place"))
                .groupBy("blob").agg(F.sort_array(F.collect_set(F.struct(
                    F.col("p.start").alias("start"), "place", F.col("p.stop").alias("stop")))).alias("found")))


def with_blob(versions: DataFrame, text_col: str = "text") -> DataFrame:
    """``versions`` plus ``blob``, the lowercase SHA-256 of the text."""
    return versions.withColumn("blob", F.sha2(F.coalesce(text_col, F.lit("")).cast("binary"), 256))


def scan(versions: DataFrame, ledger: Ledger, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` without its text, plus ``blob`` and ``found``: spans
    (start, place, stop) with ``place`` the rule's number from 1.

    Null texts are empty ones; both are a blob in which nothing is found.
    Each row, repeated or not and whatever its path, gets its blob's
    findings; an empty table gives no rows.  Columns named blob or found are
    replaced, others pass through."""
    ledger.update(versions, text_col, rules)
    keep = [c for c in versions.columns if c.lower() not in ("blob", "found", text_col.lower())]
    paths = with_blob(versions, text_col).select(*keep, "blob")
    none = F.array().cast("array<struct<start:int,place:int,stop:int>>")
    return paths.join(ledger.findings(rules), "blob", "left").select(
        *keep, "blob", F.coalesce("found", none).alias("found"))


def as_string(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of the spans, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(kinds, s["place"] - 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")
