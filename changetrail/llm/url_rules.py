"""URL rules by a sorted sweep over reversed-host keys.

A rule is a host and a path. It fits its host and all subdomains, where the url's path starts
with the rule's. Hosts are turned around (``org,example``), so that the urls under a rule are an
interval of keys: its host's key, then its path up to the same path followed by the byte FF,
which no UTF-8 text has. A url stands in the key order once for each of its domains that any
rule names. Rules that start, rules that end and urls are sorted together; nested rules form a
stack, of which the sweep needs only the top: a start puts the rule there, an end brings back
the rule that encloses it. The longest rule of a url's domains wins (host and path together; of
equal ones that with the longer host). Of several rules with the same host and path, ``block``
wins. Urls without a rule get the default verdict.

Each domain is swept by itself, and a domain with many urls in several shares by a hash, each
with the domain's rules; equal urls are judged once. Null urls and urls without ``://`` have an
empty host and path. Repeated rows are each judged; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Urls of one domain that are swept together, at least.
SHARE = 256

_PARTS = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _key(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ",")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page; ``rules`` has host, path, verdict."""
    dots = F.lit(r"\.")
    rules = (
        rules.select(
            F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("rule_host"),
            F.coalesce("path", F.lit("")).alias("rule_path"),
            "verdict",
        )
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            _key(F.split("rule_host", dots)).alias("domain"),
            F.size(F.split("rule_host", dots)).alias("n_labels"),
            "rule_path",
            F.struct(
                F.char_length(F.concat("rule_host", "rule_path")).alias("size"),
                F.char_length("rule_host").alias("host_size"),
                F.concat("rule_host", "rule_path").alias("rule"),
                "verdict",
            ).alias("top"),
        )
    )
    rules = saved(rules, "url-rules")
    deepest = rules.agg(F.max("n_labels")).first()[0] or 0

    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = judged.select("host", "path").distinct()
    # only domains of as many labels as some rule has
    labels = F.split("host", dots)
    own = urls.withColumn("labels", F.slice(labels, F.greatest(F.size(labels) - deepest + 1, F.lit(1)), deepest + 1))
    sizes = F.sequence(F.lit(1), F.size("labels")) if deepest else F.array().cast("array<int>")
    domains = own.select(
        "host",
        "path",
        F.explode(F.transform(sizes, lambda i: _key(F.slice("labels", i, F.size("labels"))))).alias("domain"),
    )
    swept = rules.groupBy("domain").agg(F.count("*").alias("n_rules"))
    counts = domains.join(swept, "domain", "left_semi").groupBy("domain").count()
    shares = swept.join(counts, "domain").select(
        "domain",
        F.ceil(F.col("count") / F.greatest(F.lit(SHARE), 4 * F.col("n_rules"))).cast("int").alias("n_shares"),
    )
    shares = saved(shares, "url-shares")

    # the rule that encloses each rule: the longest of its path's proper prefixes that is a rule
    prefixes = rules.select(
        "domain",
        "rule_path",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.char_length("rule_path") - 1, F.lit(0))),
                lambda i: F.substring(F.col("rule_path"), F.lit(1), i),
            )
        ).alias("prefix"),
    ).filter(F.col("prefix") != F.col("rule_path"))
    outer = rules.select("domain", F.col("rule_path").alias("prefix"), F.col("top").alias("outer"))
    enclosing = prefixes.join(outer, ["domain", "prefix"]).groupBy("domain", "rule_path").agg(
        F.max("outer").alias("outer")
    )
    nested = rules.join(enclosing, ["domain", "rule_path"], "left")
    none = F.lit(None).cast(rules.schema["top"].dataType)
    start = F.col("rule_path").cast("binary")
    marks = F.array(
        F.struct(start.alias("key"), F.lit(0).alias("kind"), F.struct(F.col("top").alias("rule")).alias("change")),
        F.struct(
            F.concat(start, F.lit(b"\xff")).alias("key"),
            F.lit(0).alias("kind"),
            F.struct(F.col("outer").alias("rule")).alias("change"),
        ),
    )
    changes = (
        nested.join(shares, "domain")
        .select("domain", F.explode(F.sequence(F.lit(0), F.col("n_shares") - 1)).alias("share"), "rule_path", "top", "outer")
        .select("domain", "share", F.explode(marks).alias("mark"))
        .select("domain", "share", "mark.key", "mark.kind", F.lit(None).cast("string").alias("host"),
                F.lit(None).cast("string").alias("path"), "mark.change")
    )
    stops = domains.join(shares, "domain").select(
        "domain",
        F.pmod(F.xxhash64("host", "path"), F.col("n_shares").cast("long")).cast("int").alias("share"),
        F.col("path").cast("binary").alias("key"),
        F.lit(1).alias("kind"),
        "host",
        "path",
        F.struct(none.alias("rule")).alias("change"),
    )
    sweep = Window.partitionBy("domain", "share").orderBy("key", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    top = F.last(F.when(F.col("kind") == 0, F.col("change")), ignorenulls=True).over(sweep)
    longest = (
        changes.unionByName(stops)
        .withColumn("top", top)
        .filter((F.col("kind") == 1) & F.col("top.rule").isNotNull())
        .groupBy("host", "path")
        .agg(F.max("top.rule").alias("top"))
    )
    return judged.join(longest, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("top.rule").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )


def oracle(rules: list[tuple[str, str, str]], default: str = "allow") -> str:
    """The same in SQL for a fixed list of rules with distinct host and path."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for h, p, v in rules)
    pattern = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    return f"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {values}),
judged AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '{pattern}', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '{pattern}', 2), '') AS path
  FROM pages
), urls AS (SELECT DISTINCT host, path FROM judged),
fits AS (
  SELECT u.host, u.path, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.host, u.path
           ORDER BY length(r.rule_host || r.rule_path) DESC, length(r.rule_host) DESC) AS place
  FROM urls u JOIN rules r
    ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path)
)
SELECT j.page_id, j.host, j.path, f.rule, coalesce(f.verdict, '{default}') AS verdict
FROM judged j LEFT JOIN fits f ON f.place = 1 AND f.host = j.host AND f.path = j.path
"""
