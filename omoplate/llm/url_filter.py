"""URL filter with redirect equivalence.

A rule names a host and a path prefix and allows or blocks it; it holds for
the host's subdomains too, and the longest rule that fits a URL decides.
URLs that redirect to each other, by a canonical link or a refresh in the
page or by a given table of redirects, are aliases: connected components of
that graph, found by distributed star rounds. A URL that no rule fits takes
the decision of its aliases. An explicit allow takes precedence: a URL that
a rule allows stays allowed whatever its aliases are, and aliases of an
allowed URL are allowed even if another alias is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omoplate.llm.common import broadcast_if_small, cut_lineage, ready, table
from omoplate.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"
TRACKING = r"(?i)(^|&)utm_[^&]*"
#: What is no markup of the page, though it may look so: comments, scripts and styles, closed or not.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
AMPERSAND = r"(?i)&(?:amp|#38|#x26);"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """What identifies a URL in the alias graph: host, path and query without utm_ parameters; null for
    what is not a URL. Scheme and fragment do not count."""
    query = F.regexp_replace(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), TRACKING, "")
    query = F.regexp_replace(query, "^&", "")
    node = F.concat(host_of(url), path_of(url), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(F.instr(url, "://") > 0, node)


def _absolute(target: Column) -> Column:
    """``target`` as a link of the page with the columns ``scheme``, ``host`` and ``path``."""
    site = F.concat("scheme", F.lit("://"), "host")
    folder = F.regexp_replace("path", r"[^/]*$", "")
    return (F.when(target.contains("://"), target)
            .when(target.startswith("//"), F.concat(F.col("scheme"), F.lit(":"), target))
            .when(target.startswith("/"), F.concat(site, target))
            .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), target)))


def page_links(pages: DataFrame) -> DataFrame:
    """``a, b``: URLs that a page declares to be the same, as nodes. Links in comments, scripts and styles are
    none, and a character reference for an ampersand is one."""
    url, html = F.col("url"), F.col("html").cast("string")
    named = pages.select(url.alias("url"), html.alias("html")).filter(html.rlike("(?i)canonical|refresh"))
    shown = named.select("url", F.regexp_replace("html", HIDDEN, " ").alias("shown"))
    found = lambda tag, attribute: F.regexp_extract(F.regexp_extract("shown", tag, 0), attribute, 1)
    targets = F.array(found(CANONICAL, HREF), found(REFRESH, TARGET))
    found_links = shown.select("url", F.explode(targets).alias("raw")).filter("raw <> ''").select(
        "url", F.regexp_replace("raw", AMPERSAND, "&").alias("t"))
    # one step at a time: in one expression the URL's parts would be cut out over and over
    steps = found_links.select("t", node_of(url).alias("a"), F.regexp_extract(url, r"^(.*?)://", 1).alias("scheme"),
                               host_of(url).alias("host"), path_of(url).alias("path")).filter("a is not null")
    return steps.select("a", F.explode(F.array(_absolute(F.col("t")))).alias("to")).select("a", node_of(F.col("to")).alias("b"))


def match_rules(sites: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``host, path, rule, verdict``: the longest rule that fits, for the distinct sites that one fits. Of
    equally long ones an allowing rule wins, then the first in the alphabet."""
    spark = sites.sparkSession
    split = [(v, r, r.partition("/")[0], "/" + r.partition("/")[2] if "/" in r else "", len(r)) for v, r in rules]
    known = spark.createDataFrame(split, "verdict string, rule string, rule_host string, rule_path string, size int")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (sites.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes))
            .join(broadcast_if_small(known), "rule_host").filter(F.col("path").startswith(F.col("rule_path"))))
    best = F.min(F.struct((-F.col("size")).alias("size"), (F.col("verdict") != "allow").alias("blocks"), "rule", "verdict"))
    return fits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict``.

    ``redirects`` (from_url, to_url) adds edges. A URL without a rule and
    without a judged alias is allowed; so is a null URL or text without
    ``://``, whose host and path are empty and which has no aliases. Null
    html has no links; html of any length is searched whole. Rows repeat as they come. An empty table gives no
    rows; other columns are ignored.
    """
    ready(pages.sparkSession)
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select(node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b")))
    groups = connected_components(links)
    node_host = F.regexp_extract("node", r"^([^/?]*)", 1)
    node_path = F.regexp_extract("node", r"^[^/?]*([^?]*)", 1)
    nodes = groups.withColumns({"host": node_host, "path": node_path})
    judged = pages.select("page_id", F.col("url"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                          node_of(F.col("url")).alias("node"))
    ruled = cut_lineage(match_rules(judged.select("host", "path").unionByName(nodes.select("host", "path")), rules))
    told = nodes.join(ruled, ["host", "path"]).groupBy("component").agg(
        F.min("verdict").alias("alias_verdict"))  # "allow" sorts before "block"
    aliases = groups.join(told, "component").select("node", "alias_verdict")
    return judged.join(ruled, ["host", "path"], "left").join(aliases, "node", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", "alias_verdict", F.lit("allow")).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


_PARTS = r"""
    SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
"""
ORACLE_SQL = {
    "op8_url_filter": rf"""
        WITH RECURSIVE cut AS ({_PARTS}),
        p AS (SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                     regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1),
                                                   '(?i)(^|&)utm_[^&]*', '', 'g'), '^&', '') AS query
              FROM cut),
        n AS (SELECT *, CASE WHEN instr(url, '://') > 0
                        THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS node FROM p),
        shown AS (SELECT node, host, path, regexp_replace(html, '{HIDDEN}', ' ', 'g') AS html
                  FROM n WHERE node IS NOT NULL AND regexp_matches(html, '(?i)canonical|refresh')),
        links AS (
            SELECT node AS a, host, path, regexp_replace(unnest([
                regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
                               '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
                regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
                               '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]), '{AMPERSAND}', '&', 'g') AS t
            FROM shown),
        ends AS (SELECT a, CASE WHEN instr(t, '://') > 0 THEN substr(t, instr(t, '://') + 3)
                                WHEN starts_with(t, '//') THEN substr(t, 3)
                                WHEN starts_with(t, '/') THEN host || t
                                ELSE host || CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || t
                           END AS r
                 FROM links WHERE t <> ''),
        parts AS (SELECT a, translate(regexp_extract(r, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}')
                            || regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS b,
                         regexp_replace(regexp_replace(regexp_extract(r, '^[^?#]*\?([^#]*)', 1),
                                                       '(?i)(^|&)utm_[^&]*', '', 'g'), '^&', '') AS query FROM ends),
        pairs AS (SELECT a, b || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS b FROM parts),
        edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
        reach AS (SELECT a AS node, a AS other FROM edges UNION
                  SELECT reach.node, edges.b FROM reach JOIN edges ON reach.other = edges.a),
        rules(verdict, rule, rule_host, rule_path) AS (VALUES
            ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
            ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
        sites AS (SELECT host, path FROM p UNION
                  SELECT regexp_extract(other, '^([^/?]*)', 1), regexp_extract(other, '^[^/?]*([^?]*)', 1) FROM reach),
        ruled AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
                  FROM sites JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                                           AND starts_with(path, rule_path)
                  GROUP BY host, path),
        aliases AS (SELECT node, min(verdict) AS alias_verdict FROM reach
                    JOIN ruled ON ruled.host = regexp_extract(other, '^([^/?]*)', 1)
                              AND ruled.path = regexp_extract(other, '^[^/?]*([^?]*)', 1)
                    GROUP BY node)
        SELECT page_id, coalesce(n.host, '') AS host, coalesce(n.path, '') AS path, rule,
               coalesce(verdict, alias_verdict, 'allow') AS verdict
        FROM n LEFT JOIN ruled ON n.host = ruled.host AND n.path = ruled.path LEFT JOIN aliases ON n.node = aliases.node
    """,
}
