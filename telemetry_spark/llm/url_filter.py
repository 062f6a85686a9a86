"""URL verdicts from rules and, where no rule fits, from each host's path-template tree.

Rules are ``host/path`` prefixes with a verdict.  A rule fits its host and all subdomains when the
path starts with the rule's; the longest fitting rule wins.  URLs a rule fits are the labelled
ones.  The tree of a host is built from its paths:

1. digits and long hexadecimal runs become ``*``, and equal shapes of a host are counted once, so
   what follows works on shapes, not on pages;
2. from the root down, a node with at least ``variable`` children keeps those that hold a ``share``
   of its pages by themselves, and its other children become one ``*``; a level is one step over all
   hosts, a branch with one shape left is finished as it stands, and the descent ends where no
   branch goes on;
3. the templates below one parent are merged where their labelled block rates are alike (within
   1.96 standard errors of the rate of all of them; a template without labels is like any other),
   the others stand alone;
4. a branch is rejected if its smoothed purity (blocked + weight * prior) / (labelled + weight)
   exceeds one half, the prior being the block rate of all labelled URLs.

Everything is joins and aggregations on (host, template) or (host, shape): a host with a third of
all pages is combined map-side, and where pages meet their host's shapes adaptive execution can
split it.

Defined results: a null URL or one without ``://`` has an empty host and path, which no rule
fits, and gets the method's verdict for the empty host; repeated rows are judged alike; with no
labelled URL everything is allowed; a purity of just one half is allowed; URLs may be of any length
and depth; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import materialise, quoted, table

# Fixed values of the query's contract.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
VARYING = "[0-9a-fA-F]{12,}|[0-9]+"


def fitting_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    best, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        best, verdict = F.when(fits, F.lit(rule)).otherwise(best), F.when(fits, F.lit(what)).otherwise(verdict)
    return best, verdict


def host_templates(shapes: DataFrame, variable: int, share: float) -> DataFrame:
    """(host, shape, n, labelled, blocked) with ``parent`` and ``template``."""
    kept = ["host", "shape", "n", "labelled", "blocked"]
    rows = shapes.withColumn("segments", F.split("shape", "/")).withColumns({"parent": F.lit(""), "template": F.lit("")})
    done = rows.where(F.size("segments") == 1).select(*kept, "parent", "template")
    going, level, more = rows.where(F.size("segments") > 1), 1, True
    while more:
        segment = F.element_at("segments", level + 1)
        kids = going.groupBy("host", "template", segment.alias("segment")).agg(F.sum("n").alias("pages"), F.count(F.lit(1)).alias("shapes"))
        kids, _ = materialise(kids, "url-kids")       # stored, so that the joins can split a hot host
        nodes = kids.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("children"), F.sum("pages").alias("total"), F.sum("shapes").alias("inside"))
        varies = (F.col("children") >= variable) & (F.col("pages") < share * F.col("total"))
        named = kids.join(nodes, ["host", "template"]).select(
            "host", "template", "segment", F.when(varies, F.lit("*")).otherwise(F.col("segment")).alias("named"),
            (F.col("inside") == 1).alias("alone"))
        named, _ = materialise(named, "url-nodes")
        below = going.withColumn("segment", segment).join(named, ["host", "template", "segment"])
        last = F.size("segments") == level + 1
        rest = lambda ends: F.concat_ws("/", "template", F.array_join(F.slice("segments", level + 1, F.size("segments") - ends), "/"))
        below = below.select(
            *kept, "segments", (F.col("alone") | last).alias("ended"),
            F.when(F.col("alone") & ~last, rest(level + 1)).otherwise(F.col("template")).alias("parent"),
            F.when(F.col("alone"), rest(level)).otherwise(F.concat("template", F.lit("/"), "named")).alias("template"))
        below, seen = materialise(below, "url-level", {"more": F.count_if(~F.col("ended"))})
        done = done.unionByName(below.where("ended").select(*kept, "parent", "template"))
        going, level, more = below.where("not ended").drop("ended"), level + 1, seen["more"]
    return done


def judged_templates(tree: DataFrame, weight: float) -> DataFrame:
    """(host, template, purity): each template's smoothed block rate, after merging."""
    leaves = tree.groupBy("host", "parent", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    totals = tree.agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")).first()
    prior = totals["blocked"] / totals["labelled"] if totals["labelled"] else 0.0
    pools = leaves.groupBy("host", "parent").agg(F.sum("labelled").alias("pool"), F.sum("blocked").alias("pool_blocked"))
    rate = F.try_divide("pool_blocked", "pool")
    gap = F.try_divide("blocked", "labelled") - rate
    alike = (F.col("labelled") == 0) | (gap * gap * F.col("labelled") <= 1.96 * 1.96 * rate * (1 - rate))
    branches = leaves.join(pools, ["host", "parent"]).withColumn(
        "branch", F.when(alike, F.lit("")).otherwise(F.col("template")))
    merged = branches.groupBy("host", "parent", "branch").agg(F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))
    return branches.join(merged, ["host", "parent", "branch"]).select(
        "host", "template", ((F.col("all_blocked") + weight * prior) / (F.col("all_labelled") + weight)).alias("purity"))


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
               variable: int = 20, share: float = 0.05, weight: float = 4.0) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) for every row of ``pages``."""
    url = quoted(url_col).cast("string")
    part = lambda k: F.coalesce(F.regexp_extract(url, PARTS, k), F.lit(""))
    rows = pages.select(quoted(id_col).alias("id"), F.translate(part(1), UPPER, LOWER).alias("host"), part(2).alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"), F.regexp_replace("path", VARYING, "*").alias("shape"))
    shapes = rows.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("ruled").alias("labelled"), F.count_if(F.col("ruled") == "block").alias("blocked"))
    shapes, _ = materialise(shapes, "url-shapes")
    tree, _ = materialise(host_templates(shapes, variable, share), "url-templates")
    found = tree.select("host", "shape", "template").join(judged_templates(tree, weight), ["host", "template"])
    method = F.when(F.col("purity") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(found, ["host", "shape"]).select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "purity")


def op6_url_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages")).drop("purity")


def oracle(variable: int = 20, share: float = 0.05, weight: float = 4.0) -> str:
    """The same judgement in DuckDB: rules as a table, the tree by recursion over window functions."""
    values = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in RULES)
    return rf"""
WITH RECURSIVE rules(verdict, rule, h, p) AS (VALUES {values}),
u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
hit AS (SELECT DISTINCT host, path, first_value(rule) OVER w AS rule, first_value(verdict) OVER w AS ruled
        FROM (SELECT DISTINCT host, path FROM u) d JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        WINDOW w AS (PARTITION BY host, path ORDER BY length(rule) DESC)),
r AS (SELECT u.page_id, u.host, u.path, hit.rule, hit.ruled, regexp_replace(u.path, '{VARYING}', '*', 'g') AS shape
      FROM u LEFT JOIN hit ON u.host = hit.host AND u.path = hit.path),
t AS (
  SELECT host, shape, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (WHERE ruled = 'block') AS blocked,
         string_split(shape, '/') AS seg, 1 AS level, '' AS parent, '' AS template FROM r GROUP BY host, shape
  UNION ALL
  SELECT host, shape, n, labelled, blocked, seg, level + 1, template,
         template || '/' || CASE WHEN children >= {variable} AND pages < {share} * total THEN '*' ELSE s END
  FROM (SELECT *, count(DISTINCT s) OVER (PARTITION BY host, template) AS children, sum(n) OVER (PARTITION BY host, template, s) AS pages,
               sum(n) OVER (PARTITION BY host, template) AS total
        FROM (SELECT *, seg[level + 1] AS s FROM t WHERE len(seg) > level))),
tree AS (SELECT host, shape, labelled, blocked, parent, template FROM t WHERE len(seg) = level),
leaf AS (SELECT host, parent, template, sum(labelled) AS l, sum(blocked) AS b FROM tree GROUP BY ALL),
prior AS (SELECT coalesce(sum(b) / nullif(sum(l), 0), 0) AS q FROM leaf),
pool AS (SELECT *, sum(l) OVER w AS pl, sum(b) OVER w AS pb FROM leaf WINDOW w AS (PARTITION BY host, parent)),
branch AS (SELECT *, CASE WHEN l = 0 OR (b / l - pb / pl) * (b / l - pb / pl) * l <= 1.96::DOUBLE * 1.96::DOUBLE * (pb / pl) * (1 - pb / pl)
                          THEN '' ELSE template END AS br FROM pool),
judged AS (SELECT host, template, (sum(b) OVER w + {weight}::DOUBLE * q) / (sum(l) OVER w + {weight}::DOUBLE) AS purity
           FROM branch, prior WINDOW w AS (PARTITION BY host, parent, br))
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.ruled, CASE WHEN j.purity > 0.5 THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM r JOIN tree t ON r.host = t.host AND r.shape = t.shape JOIN judged j ON j.host = t.host AND j.template = t.template
"""
