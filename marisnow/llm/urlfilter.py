"""URL filters: rules, and block decisions spread over redirects.

A url's own rule decides first, so an explicit allow always takes
precedence.  Urls without a rule take part in the redirect equivalence:
connected components over redirect and canonical-link edges between urls; if
any url of a component is blocked by a rule, its aliases without a rule are
blocked too, everything else is allowed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marisnow.llm.common import free_name, lower_ascii, written
from marisnow.llm.components import connected_components


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: the production rules
RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched(host_col: Column, path_col: Column, rules=RULES) -> Column:
    """The longest fitting rule (host plus path; a block before an allow of
    the same length) as struct (name, verdict); null if none fits."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block")):
        at_host = (host_col == r.host) | F.endswith(host_col, F.lit("." + r.host))
        fits = at_host & F.startswith(path_col, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def node(url: Column) -> Column:
    """What names a resource: host, path and query, without scheme, fragment
    and a final slash; null where the url has no host."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host(url) != "", F.concat(host(url), F.regexp_replace(rest, "/$", "")))


def decoded(target: Column) -> Column:
    """A target with the character references of marks that urls hold
    decoded, the ampersand last."""
    for c, name in (("<", "lt"), (">", "gt"), ('"', "quot"), ("'", "apos"), ("/", "sol"), (":", "colon"), ("?", "quest"),
                    ("=", "equals"), (".", "period"), ("-", "hyphen"), ("_", "lowbar"), ("%", "percnt"), ("#", "num"),
                    ("+", "plus"), ("~", "tilde"), ("&", "amp")):
        target = F.regexp_replace(target, f"(?i)&(?:{name}|#0*{ord(c)}|#x0*{ord(c):x});", c)
    return target


def resolved(base: Column, target: Column) -> Column:
    """The url that ``target`` names on the page ``base``: absolute, of the
    same scheme (//), rooted, query or fragment only, or relative to the
    folder; dot segments are removed."""
    root = F.regexp_extract(base, "(?s)^(.*?://[^/?#]*)", 1)
    page = F.regexp_extract(base, "(?s)^(.*?://[^?#]*)", 1)
    folder = F.regexp_replace(page, "(?<=[^/])/[^/]*$", "")
    url = (F.when(F.rlike(target, F.lit("^[A-Za-z][A-Za-z0-9+.-]*://")), target)
           .when(F.startswith(target, F.lit("//")), F.concat(F.regexp_extract(base, "(?s)^(.*?:)//", 1), target))
           .when(F.startswith(target, F.lit("/")), F.concat(root, target))
           .when(F.startswith(target, F.lit("?")) | F.startswith(target, F.lit("#")), F.concat(page, target))
           .otherwise(F.concat(folder, F.lit("/"), target)))
    at = F.regexp_extract(url, "(?s)^(.*?://[^/?#]*)", 1)
    place = F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(url, "(?s)^.*?://[^?#]*(.*)$", 1)

    def step(done, part):
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    parts = F.filter(F.split(place, "/", -1), lambda p: p != "")
    clean = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    dots = F.rlike(place, F.lit("(?:^|/)\\.{1,2}(?:/|$)"))
    slash = F.when(F.rlike(place, F.lit("/(?:\\.{1,2})?$")) & (clean != ""), F.lit("/")).otherwise(F.lit(""))
    return F.when(dots, F.concat(at, F.lit("/"), clean, slash, rest)).otherwise(url)


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst)`` urls of canonical links, meta refreshes and script
    redirects found in the pages; references in targets are decoded, relative
    targets resolved."""
    tag = "(?is)<(?:link|meta)\\b[^>]*>"
    tags = F.regexp_extract_all(F.coalesce(html_col, F.lit("")), F.lit(tag), F.lit(0))
    canonical = F.transform(F.filter(tags, lambda t: F.rlike(t, F.lit("(?i)\\brel\\s*=\\s*[\"']?canonical\\b"))),
                            lambda t: F.regexp_extract(t, "(?is)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)", 1))
    refresh = F.transform(F.filter(tags, lambda t: F.rlike(t, F.lit("(?i)http-equiv\\s*=\\s*[\"']?refresh\\b"))),
                          lambda t: F.regexp_extract(t, "(?is)\\burl\\s*=\\s*[\"']?([^\"'\\s>]+)", 1))
    script = F.regexp_extract_all(F.coalesce(html_col, F.lit("")), F.lit(
        "(?i)\\blocation(?:\\.href\\s*=|\\s*=|\\.replace\\()\\s*[\"']([^\"']+)[\"']"), F.lit(1))
    out = pages.select(F.col(url_col).alias("src"), F.explode(F.concat(F.transform(F.concat(canonical, refresh), decoded), script)).alias("to"))
    return out.filter("to != ''").select("src", resolved(F.col("src"), F.col("to")).alias("dst"))


def judge(pages: DataFrame, edges: DataFrame | None = None, url_col: str = "url", html_col: str = "html",
          rules=RULES) -> DataFrame:
    """``pages`` without its html, plus ``host``, ``path``, ``rule`` (null if
    none fits) and ``verdict``.

    ``edges`` adds known redirects ``(src, dst)`` to those found in the
    pages.  Urls that are null or have no ``://`` have empty host and path,
    no aliases, and are allowed.  Repeated rows and urls get equal verdicts;
    urls that only occur in an edge pass a block on as well.  An empty table
    gives no rows; columns named like new ones are replaced."""
    found = link_edges(pages, url_col, html_col)
    if edges is not None:
        found = found.unionByName(edges.select("src", "dst"))
    found = written(found.distinct(), "url-edges")
    groups = connected_components(found.select(node(F.col("src")).alias("a"), node(F.col("dst")).alias("b")))
    ends = found.select(F.explode(F.array("src", "dst")).alias("url"))
    urls = ends.unionByName(pages.select(F.col(url_col).alias("url")))
    blocked = (urls.filter(matched(host(F.col("url")), path(F.col("url")), rules)["verdict"] == "block")
               .select(node(F.col("url")).alias("node")).distinct())
    bad = groups.join(blocked, "node").select("component").distinct()
    alias = groups.join(bad, "component", "left_semi").select(F.col("node").alias("_node"))
    new = ("host", "path", "rule", "verdict")
    keep = [c for c in pages.columns if c.lower() not in (*new, html_col.lower())]
    url = F.col(url_col)
    at, fit, bad_at = (free_name(c, pages.columns) for c in ("url_node", "url_rule", "alias_node"))
    # no node begins with a slash: urls without a host are spread over the tasks instead of meeting as nulls
    nowhere = F.concat(F.lit("/"), F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("string"))
    src = pages.select(*keep, host(url).alias("host"), path(url).alias("path"), F.coalesce(node(url), nowhere).alias(at))
    src = src.withColumn(fit, matched(F.col("host"), F.col("path"), rules))
    alias = alias.withColumnRenamed("_node", bad_at)
    out = src.join(alias, src[at] == alias[bad_at], "left")
    verdict = F.coalesce(F.col(fit)["verdict"], F.when(F.col(bad_at).isNotNull(), "block").otherwise("allow"))
    return out.select(*keep, "host", "path", F.col(fit)["name"].alias("rule"), verdict.alias("verdict"))
