"""URL filter: rules by host and path, and block decisions carried over redirects and canonical links to aliases.

DataFrame operations only: no Python on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.llm.common import store
from respira.llm.components import components

# Fixed values: (verdict, host, path) of the rules.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AFTER = r"(?s)^.*?://(.*)$"
# A link element that names the page's canonical address, and a refresh that names where it redirects.
_CANONICAL = r"""(?i)<link\b(?=[^<>]*\brel\s*=\s*["']?canonical\b)[^<>]*?\bhref\s*=\s*["']?([^"'\s<>]+)"""
_REFRESH = r"""(?i)<meta\b(?=[^<>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^<>]*?\burl\s*=\s*['"]?([^"'\s<>;]+(?:(?<=&amp|&#38|&#x26);[^"'\s<>;]*)*)"""
# Entities in the two, ``&`` last: what it makes is not decoded again.
_ENTITIES = [(r"(?i)&(quot|#34|#x22);", '"'), (r"(?i)&(apos|#39|#x27);", "'"), (r"(?i)&(sol|#47|#x2f);", "/"), (r"(?i)&(amp|#38|#x26);", "&")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII lower case; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def alias_of(url: Column) -> Column:
    """Address without what leaves the page the same: scheme, ``www.``, a default port, fragment, ``utm_`` parameters and
    a final slash; null where a url has no ``://`` or no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.startswith("utm_"))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def _absolute(link: Column, url: Column) -> Column:
    """A link as an address: absolute, scheme-relative, from the root, or relative to the page's path or query.

    Null for fragments, schemes without ``//`` and relative links of pages without a host.
    """
    origin, path = F.concat(F.lit("http://"), host_of(url)), path_of(url)
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    whole = F.when(link.startswith("/"), link).otherwise(F.concat(folder, link))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("#") | link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:") | (host_of(url) == ""), F.lit(None))
        .when(link.startswith("?"), F.concat(origin, path, link))
        .otherwise(F.concat(origin, _folded(F.regexp_extract(whole, r"^[^?#]*", 0)), F.regexp_extract(whole, r"^[^?#]*(.*)$", 1)))
    )


def _folded(path: Column) -> Column:
    """A path from the root without ``.`` and ``..``."""
    up = lambda a: F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(1)))
    step = lambda a, x: F.when(x == ".", a).when(x == "..", up(a)).otherwise(F.concat(a, F.array(x)))
    return F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/")


def _rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Longest fitting rule and its verdict; of equally long ones an allowing one."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in order]
    pick = lambda k: reduce(lambda c, x: c.when(x[0], x[1]), zip(fits, k, strict=True), F)
    if not order:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return pick([F.lit(h + p) for _, h, p in order]), pick([F.lit(v) for v, _, _ in order])


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, component_rule`` for every page.

    A page with a fitting rule keeps that rule's verdict. Any other takes it from its redirect class: pages with the
    same alias address, and addresses joined by all their canonical links and refreshes, over any number of steps. If a page of
    the class is allowed by a rule the class is allowed, else blocked if one is blocked, else allowed. ``rules`` is a
    short list (expressions of the plan). Null urls have empty host and path, belong to no class and are allowed unless
    a rule fits; null html has no links; repeated rows each get their row; other columns are ignored.
    """
    u = F.col("url")
    d = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    host, path = host_of(u), path_of(u)
    rule, verdict = _rule(F.col("host"), F.col("path"), rules)
    links = F.concat(*[F.regexp_extract_all("html", F.lit(p), 1) for p in (_CANONICAL, _REFRESH)])
    links = F.transform(links, lambda x: reduce(lambda c, e: F.regexp_replace(c, *e), _ENTITIES, x))
    d = d.select("page_id", host.alias("host"), path.alias("path"), alias_of(u).alias("alias"),
                 F.transform(F.coalesce(links, F.array().cast("array<string>")), lambda x: alias_of(_absolute(x, u))).alias("to"))
    d = store(d.withColumns({"rule": rule, "own": verdict, "node": F.when(F.col("alias").isNotNull(), F.xxhash64("alias"))}).drop("alias"))
    to = d.filter("node is not null").select(F.col("node").alias("a"), F.explode("to").alias("t")).filter("t is not null")
    comp = store(components(to.select("a", F.xxhash64("t").alias("b"))))
    # Every class is summed up by address first; a page that needs no other's decision never meets them.
    said = d.filter("own is not null and node is not null").groupBy("node").agg(
        F.max(F.col("own") == "allow").alias("allow"), F.max(F.col("own") == "block").alias("block")
    )
    said = said.join(comp, "node", "left").groupBy(F.coalesce("component", "node").alias("component")).agg(
        F.max("allow").alias("allow"), F.max("block").alias("block")
    )
    need = d.filter("own is null and node is not null").select("node").distinct()
    found = need.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")).join(said, "component")
    found = store(found.select("node", F.when(F.col("allow"), "allow").otherwise("block").alias("class_verdict")))
    out = d.filter("own is not null or node is null").withColumn("class_verdict", F.lit(None).cast("string"))
    rest = d.filter("own is null and node is not null").join(found, "node", "left")
    cols = ["page_id", "host", "path", "rule", F.coalesce("own", "class_verdict", F.lit("allow")).alias("verdict")]
    return out.select(*cols).unionByName(rest.select(*cols))


def op4_url_filter(spark, sf: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf}/pages.parquet"))


SQL = r"""
WITH RECURSIVE base AS (
  SELECT page_id, url, html,
         CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, html, rest,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM base),
links AS (
  SELECT page_id, host, unnest([
    regexp_extract(regexp_extract(html, '(?i)<link[^<>]*rel\s*=\s*["'']?canonical[^<>]*>'), '(?i)href\s*=\s*["'']?([^"''\s<>]+)', 1),
    regexp_extract(regexp_extract(html, '(?i)<meta[^<>]*http-equiv\s*=\s*["'']?refresh[^<>]*>'), '(?i)url\s*=\s*["'']?([^"''\s<>;]+)', 1)]) AS link
  FROM parts),
targets AS (
  SELECT page_id,
         CASE WHEN instr(link, '://') > 0 THEN substr(link, instr(link, '://') + 3) WHEN link LIKE '//%' THEN substr(link, 3)
              WHEN link LIKE '/%' AND host <> '' THEN host || link END AS rest
  FROM links WHERE coalesce(link, '') <> ''),
every AS (
  SELECT page_id, false AS is_link, rest FROM parts UNION ALL SELECT page_id, true, rest FROM targets WHERE rest IS NOT NULL),
alias AS (
  SELECT page_id, is_link, CASE WHEN h <> '' THEN h || p || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS node
  FROM (SELECT page_id, is_link,
               regexp_replace(regexp_replace(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)$', ''), '^www\.', '') AS h,
               regexp_replace(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '/+$', '') AS p,
               list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_')) AS q
        FROM every)),
edges AS (
  SELECT DISTINCT a.node AS x, b.node AS y FROM alias a JOIN alias b USING (page_id)
  WHERE NOT a.is_link AND b.is_link AND a.node IS NOT NULL AND b.node IS NOT NULL),
both_ways AS (SELECT x, y FROM edges UNION SELECT y, x FROM edges),
reach(node, other) AS (
  SELECT x, x FROM both_ways UNION SELECT r.node, e.y FROM reach r JOIN both_ways e ON r.other = e.x),
comp AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
ruled AS (
  SELECT p.page_id, p.host, p.path, a.node,
    CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts p JOIN (SELECT * FROM alias WHERE NOT is_link) a USING (page_id)),
judged AS (
  SELECT r.*, coalesce(c.component, r.node) AS component,
         CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS own
  FROM ruled r LEFT JOIN comp c ON r.node = c.node),
class AS (
  SELECT component, CASE WHEN bool_or(own = 'allow') THEN 'allow' WHEN bool_or(own = 'block') THEN 'block' END AS said
  FROM judged WHERE component IS NOT NULL AND own IS NOT NULL GROUP BY component)
SELECT page_id, host, path, rule, coalesce(own, said, 'allow') AS verdict
FROM judged LEFT JOIN class USING (component)
"""
