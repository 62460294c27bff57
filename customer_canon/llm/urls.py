"""URL filters by a sort-merge range join.

A host becomes its labels in reverse, each closed by a dot (``com.example.``). The keys below a rule's host are
then exactly those that begin with the rule's key: an interval of the sort order, and intervals of two rules are
nested or apart. Urls and rules are sorted together. Whatever rules cover a url, the last rule that starts at or
before it lies inside all of them, so that rule's stack (itself and the rules around it) holds them; those the
sweep has left again are dropped by comparing prefixes. A second sweep does the same for paths, below each host
rule that is active.

Urls are dealt by hash into ``runs``, each sorted and swept alone with all rules, so that neither a hot host nor
a hot url grows a task. A row costs one place in a run, a rule one in every run: keep runs below urls / rules for
long lists. Equal rows are counted before they are dealt.

Nulls: a url that is null or has no ``://`` has an empty host and path, which no rule fits. Null ids are ids.
Repeated rows come out as often as they came in. Two rules of the same text: block wins. Rules without a slash
fit every path. An empty table gives an empty result, no rules the default verdict everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from customer_canon.llm.common import shuffle_partitions

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def _rules_by_key(rules: DataFrame) -> DataFrame:
    """``rule, verdict`` rows as ``node, route, rule, verdict``: key of the host, and path."""
    host = F.translate(F.regexp_extract("rule", "^[^/]*", 0), _UPPER, _UPPER.lower())
    return (
        rules.groupBy("rule")
        .agg(F.max("verdict").alias("verdict"))
        .select(host_key(host).alias("node"), F.regexp_extract("rule", "/.*$", 0).alias("route"), "rule", "verdict")
    )


def _host_stacks(rules: DataFrame) -> DataFrame:
    """``node, stack``: each host that has rules, and the hosts with rules around it."""
    nodes = rules.select("node").distinct()
    labels = F.split("node", "\\.")
    outer = nodes.withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(labels) - 1))).withColumn(
        "outer", F.concat(F.array_join(F.slice(labels, F.lit(1), F.col("depth")), "."), F.lit("."))
    )
    return outer.join(nodes.toDF("outer"), "outer").groupBy("node").agg(F.collect_set("outer").alias("stack"))


def _route_stacks(rules: DataFrame) -> DataFrame:
    """``node, route, rule_stack``: each rule, and the rules of its host whose path begins its own, longest first."""
    prefix = rules.select("node", "route", F.explode(F.sequence(F.lit(0), F.length("route"))).alias("n")).select(
        "node", "route", F.expr("substring(route, 1, n)").alias("outer")
    )
    outer = rules.select("node", F.col("route").alias("outer"), "rule", "verdict")
    entry = F.struct(
        F.length("outer").alias("n"), F.col("outer").alias("route"), F.col("rule"), F.col("verdict"), F.col("node")
    )
    return (
        prefix.join(outer, ["node", "outer"])
        .groupBy("node", "route")
        .agg(F.sort_array(F.collect_set(entry), asc=False).alias("rule_stack"))
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    runs: int | None = None,
) -> DataFrame:
    """``<id_col>, url, host, path, rule, verdict`` for every row: the longest fitting rule's verdict, else ``default``.

    ``rules`` has the columns ``rule`` (``host/path``) and ``verdict`` (``allow`` or ``block``).
    """
    runs = runs or shuffle_partitions(pages)
    rules = _rules_by_key(rules)
    in_runs = F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")

    urls = (
        pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
        .groupBy("id", "url")
        .agg(F.count("*").alias("copies"))
        .withColumn("host", host_of(F.col("url")))
        .withColumn("path", path_of(F.col("url")))
        .withColumn("run", F.pmod(F.xxhash64("id", "url"), F.lit(runs)).cast("int"))
        .withColumn("node", host_key(F.col("host")))
    )

    # first sweep: hosts; a rule sorts before the urls of the same key
    started = Window.partitionBy("run").orderBy("node", "is_url")
    hosts = _host_stacks(rules).select(in_runs, "node", "stack").withColumn("is_url", F.lit(False))
    active = F.filter("stack", lambda outer: F.startswith(F.col("node"), outer))
    on_hosts = (
        urls.withColumn("is_url", F.lit(True))
        .unionByName(hosts, allowMissingColumns=True)
        .withColumn("stack", F.last("stack", ignorenulls=True).over(started))
        .where("is_url")
        .select("run", "id", "url", "copies", "host", "path", F.explode_outer(active).alias("node"))
    )

    # second sweep: paths below each active host
    started = Window.partitionBy("run").orderBy("node", "route", "is_url")
    routes = _route_stacks(rules).select(in_runs, "node", "route", "rule_stack").withColumn("is_url", F.lit(False))
    covers = F.filter(
        "rule_stack", lambda r: (r["node"] == F.col("node")) & F.startswith(F.col("path"), r["route"])
    )
    on_routes = (
        on_hosts.withColumn("is_url", F.lit(True))
        .withColumn("route", F.col("path"))
        .unionByName(routes, allowMissingColumns=True)
        .withColumn("rule_stack", F.last("rule_stack", ignorenulls=True).over(started))
        .where("is_url")
        .withColumn("best", F.get(covers, F.lit(0)))
    )
    longest = F.struct(F.length("best.rule"), F.length("node"))
    won = F.max_by(F.struct("best.rule", "best.verdict"), F.when(F.col("best").isNotNull(), longest))
    return (
        on_routes.groupBy("run", "id", "url", "copies", "host", "path")
        .agg(won.alias("won"))
        .select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            F.col("id").alias(id_col),
            "url",
            "host",
            "path",
            F.col("won.rule").alias("rule"),
            F.coalesce("won.verdict", F.lit(default)).alias("verdict"),
        )
    )


#: Rules of the registered query: fixed values.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

_VALUES = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in RULES)
RULES_SQL = f"SELECT verdict, rule FROM VALUES {_VALUES} AS rules(verdict, rule)"

#: DuckDB's version: every rule against every url.
URLS_SQL = rf"""
WITH urls AS (
  SELECT row_number() OVER () AS row_id, page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_UPPER.lower()}') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules AS (SELECT verdict, rule, split_part(rule, '/', 1) AS of_host, substr(rule, strpos(rule, '/')) AS of_path
          FROM (VALUES {_VALUES}) AS r(verdict, rule)),
fits AS (
  SELECT u.row_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM urls u JOIN rules r ON (u.host = r.of_host OR ends_with(u.host, '.' || r.of_host)) AND starts_with(u.path, r.of_path)
  GROUP BY u.row_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (row_id)
"""
