"""URL filters: host and path rules looked up by hashed expressions.

Each URL is expanded into host-suffix and path-prefix expressions (the host and
its parent domains, each with the beginnings of the path that are as long as some
rule's path).  Expressions meet the rules in an equi-join on a short hash
prefix, as in a client that holds short prefixes only; the full SHA-256 digests
then confirm the match, and of a URL's rules the longest wins.  URLs that no
rule fits get the method's verdict, ``allow``.

Only what decides is expanded: hosts with the beginning of the path up to the
longest rule path, each once however many pages share it.  The rules'
digests are broadcast when they are few (``BROADCAST_RULES``, counted before) and
shuffled otherwise; verdicts return to the pages by a join that splits hot hosts.
DataFrame functions only.

Defined results: a null url, or one without ``://``, has an empty host and path,
no rule and the verdict ``allow``.  Repeated rows and ids are rows of their own;
rules given twice count once, and of equal expressions with both verdicts ``block``
wins.  Rules with a null part are ignored; extra columns are ignored; an empty
table gives no rows, and without rules every verdict is ``allow``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Rules up to which they are sent to every task (about 100 bytes each).
BROADCAST_RULES = 100_000
PREFIX_HEX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, url.substr(F.locate("://", url) + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id",
               url_column: str = "url") -> DataFrame:
    """``id_column, host, path, rule, verdict`` for every page; ``rules`` has
    ``host, path, verdict``."""
    rules = cut(rules.where("host is not null and path is not null and verdict is not null")
                .select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict")
                .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
                .withColumn("digest", _digest(F.col("host"), F.col("path"))))
    lengths = rules.agg(F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
                        F.count("*").alias("n")).first()
    longest = max(lengths["lengths"], default=0)
    listed = rules.select(F.substring("digest", 1, PREFIX_HEX).alias("short"), F.col("digest").alias("full"),
                          F.concat("host", "path").alias("rule"), F.col("verdict").alias("ruled"))
    if lengths["n"] <= BROADCAST_RULES:
        listed = F.broadcast(listed)

    url = F.col("url")
    host, path = host_and_path(url)
    pages = (pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").cast("string").alias("url"))
             .select("id", host.alias("host"), path.alias("path"))
             .withColumn("head", F.substring("path", 1, longest)))
    keys = pages.select("host", "head").where("host <> ''").distinct()
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size("labels")),
                           lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    known = F.array(*[F.lit(n) for n in lengths["lengths"]]) if lengths["lengths"] else F.array().cast("array<int>")
    beginnings = F.transform(F.filter(known, lambda n: n <= F.length("head")),
                             lambda n: F.substring(F.col("head"), F.lit(1), n))
    matched = (keys.withColumn("labels", labels)
               .select("host", "head", F.explode(suffixes).alias("suffix"), beginnings.alias("beginnings"))
               .select("host", "head", "suffix", F.explode("beginnings").alias("beginning"))
               .withColumn("digest", _digest(F.col("suffix"), F.col("beginning")))
               .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
               .join(listed, "short").where("digest = full"))
    rank = F.struct(F.length("rule").alias("length"), F.length("suffix").alias("host_length"), "rule", "ruled")
    # Written, so that the join deals both sides out by key and can split a hot one.
    best = cut(matched.groupBy("host", "head").agg(F.max(rank).alias("best"))
               .select("host", "head", F.col("best.rule").alias("rule"), F.col("best.ruled").alias("ruled")))
    return (pages.join(best, ["host", "head"], "left")
            .select(F.col("id").alias(id_column), "host", "path", "rule",
                    F.coalesce("ruled", F.lit("allow")).alias("verdict")))


#: The rules of the registered query: host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: DuckDB: every page with every rule.
URL_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
pages_split AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
),
rules(rule_host, rule_path, ruled) AS (VALUES
""" + ",\n".join(f"  ('{h}', '{p}', '{v}')" for h, p, v in RULES) + """
),
verdicts AS (
  SELECT row_number() OVER () AS row_no, page_id, host, path FROM pages_split
),
fitting AS (
  SELECT row_no, max({'length': length(rule_host || rule_path), 'rule': rule_host || rule_path, 'ruled': ruled})
         AS best
  FROM verdicts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  WHERE host <> ''
  GROUP BY row_no
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.ruled, 'allow') AS verdict
FROM verdicts LEFT JOIN fitting USING (row_no)
"""
