"""Blocking urls by rules on host and path, and by what their pages redirect to.

A rule is a host with a path. It fits its host and all subdomains where the url's path starts with
the rule's; of the rules that fit, the longest decides. Pages that are the same resource under other
urls share a decision: a page's canonical link and its immediate redirect (``meta`` refresh)
are edges between urls, connected components of these edges are the resources, and a component
with a blocked url blocks its urls that no rule fits, unless one of its urls is allowed by
rule. A rule's own verdict always stands, so an explicit allow takes precedence.

A url is a node by host and path: scheme, query and fragment make no difference to rules. Only
edges and the rules' verdicts on their ends are shuffled; pages that have no edge are judged where
they are. Only DataFrame expressions run.

Defined results: a url that is null or has no ``://`` has an empty host and path, fits no rule and
is allowed. Edges to urls without a host count for nothing; relative links are resolved against
the page's host and folder. An html of null has no edges. Repeated rows are judged alike, and an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from emberlink.llm.common import cut_lineage, fresh, table
from emberlink.llm.components import connected_components

#: Fixed values: (verdict, rule), a rule being host, then path from the first slash on.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
_TAGS_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?[^"'>]*\bcanonical\b)[^>]*>"""
_TAGS_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh\b)[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_TO = r"""(?is)\bcontent\s*=\s*["']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*["']?([^"'>\s]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def decide(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, start = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _target(link: Column, host: Column, path: Column) -> Column:
    """A link's host and path as one string; null if it names no host."""
    link = F.trim(F.replace(link, F.lit("&amp;"), F.lit("&")))
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    whole = (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(F.lit("x:"), link))
        .when(link.startswith("/"), F.concat(F.lit("x://"), host, link))
        .when((link == "") | link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | link.startswith("#"), F.lit(None))
        .otherwise(F.concat(F.lit("x://"), host, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )
    return F.when(host_of(whole) != "", F.concat(host_of(whole), path_of(whole)))


def page_edges(pages: DataFrame) -> DataFrame:
    """(``a``, ``b``): a page's url and what it redirects to or calls canonical, as host and path."""
    linked = pages.where(F.col("html").rlike(r"(?i)canonical|refresh"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    found = linked.select(
        host.alias("host"), path.alias("path"),
        F.expr("regexp_extract_all(html, '" + _TAGS_CANONICAL.replace("\\", "\\\\").replace("'", "\\'") + "', 0)").alias("links"),
        F.expr("regexp_extract_all(html, '" + _TAGS_REFRESH.replace("\\", "\\\\").replace("'", "\\'") + "', 0)").alias("metas"),
    ).where("host <> ''")
    href = lambda tag: F.concat(*[F.regexp_extract(tag, _HREF, i) for i in (1, 2, 3)])
    named = F.concat(F.transform("links", href), F.transform("metas", lambda tag: F.regexp_extract(tag, _TO, 1)))
    each = found.select("host", "path", F.explode(named).alias("link"))
    return each.select(F.concat("host", "path").alias("a"), _target(F.col("link"), F.col("host"), F.col("path")).alias("b")).where("a <> b").distinct()


def blocked_aliases(edges: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Nodes (``node``) whose component holds a blocked url and no allowed one."""
    parts = connected_components(edges, "urls")
    slash = F.locate("/", "node")
    host = F.when(slash > 0, F.expr("substring(node, 1, locate('/', node) - 1)")).otherwise(F.col("node"))
    path = F.when(slash > 0, F.expr("substring(node, locate('/', node))")).otherwise(F.lit(""))
    judged = parts.withColumn("verdict", decide(host, path, rules)[1])
    bad = judged.groupBy("component").agg(F.max((F.col("verdict") == "block").cast("int")).alias("blocked"), F.max((F.col("verdict") == "allow").cast("int")).alias("allowed"))
    return judged.join(bad.where("blocked = 1 and coalesce(allowed, 0) = 0"), "component", "left_semi").select("node")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to pages (``url``, ``html``)."""
    edges = cut_lineage(page_edges(pages), "url-edges")
    aliases = cut_lineage(blocked_aliases(edges, rules).distinct(), "url-aliases")
    node, hit = fresh(pages.columns, "node"), fresh(pages.columns, "hit")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    named = pages.drop("html", "host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    rule, verdict = decide(F.col("host"), F.col("path"), rules)
    ruled = named.withColumns({"rule": rule, "verdict": verdict, node: F.concat("host", "path")})
    marked = ruled.join(aliases.select(F.col("node").alias(node), F.lit(True).alias(hit)), node, "left")
    by_method = F.when(F.col(hit), F.lit("block")).otherwise(F.lit("allow"))
    return marked.withColumn("verdict", F.coalesce("verdict", by_method)).drop(node, hit)


def op6_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every url of ``pages``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH RECURSIVE rules AS (
  SELECT * FROM (VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')) AS r(verdict, rule)
),
p AS (
  SELECT page_id, coalesce(html, '') AS html,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
tags AS (
  SELECT host, path, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS tag, 'link' AS kind FROM p WHERE host <> ''
  UNION ALL SELECT host, path, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')), 'meta' FROM p WHERE host <> ''
),
links AS (
  SELECT host, path, trim(replace(CASE kind
    WHEN 'link' THEN concat(regexp_extract(tag, '(?is)\bhref\s*=\s*"([^"]*)"', 1), regexp_extract(tag, '(?is)\bhref\s*=\s*''([^'']*)''', 1),
                            regexp_extract(tag, '(?is)\bhref\s*=\s*([^\s"''>]+)', 1))
    ELSE regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*["'']?([^"''>\s]+)', 1) END, '&amp;', '&')) AS link
  FROM tags
  WHERE kind = 'link' AND regexp_matches(tag, '(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')
     OR kind = 'meta' AND regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')
),
whole AS (
  SELECT host || path AS a, CASE
    WHEN contains(link, '://') THEN link
    WHEN starts_with(link, '//') THEN 'x:' || link
    WHEN starts_with(link, '/') THEN 'x://' || host || link
    WHEN link = '' OR starts_with(link, '#') OR regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE 'x://' || host || coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') || link END AS url
  FROM links
),
edges AS (
  SELECT DISTINCT a, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS b
  FROM whole WHERE regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) <> ''
),
both_ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
reach AS (SELECT a AS node, a AS seen FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.seen),
judged AS (
  SELECT seen, arg_max(verdict, len(rule)) AS verdict
  FROM (SELECT DISTINCT seen, regexp_extract(seen, '(?s)^([^/]*)', 1) AS host, regexp_extract(seen, '(?s)^[^/]*(.*)$', 1) AS path FROM reach)
  JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, rule[strpos(rule, '/'):])
  GROUP BY seen
),
aliases AS (
  SELECT node FROM reach JOIN judged USING (seen) GROUP BY node HAVING bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow')
),
ruled AS (
  SELECT page_id, host, path, arg_max(rule, len(rule)) AS rule, arg_max(verdict, len(rule)) AS verdict
  FROM p LEFT JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, rule[strpos(rule, '/'):])
  GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN aliases ON node = host || path
"""
