"""URL filters: fixed host and path rules, then association rules mined from labels.

URLs are cut into tokens (domain suffixes, sub-domain, path segments without
their digits, file ending, names of query parameters, scheme). FP-growth over
the labelled pages' tokens and their label gives rules "these tokens -> bad";
rules below the least confidence or support are pruned. An inverted index from
token to rules matches the rest: a rule holds where all its tokens are met.

Defined results: a NULL URL or one without "://" has an empty host and path, no
token, no rule, and is allowed. Verdicts depend on the URL alone, so copies are
matched once and repeated rows each give a row. Without labels no rule is
mined. Only the id and the URL are read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, small

# Fixed values: (verdict, host, path).
BASE_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BAD = "label=bad"
SUPPORT, LEAST_PAGES, CONFIDENCE = 0.001, 20, 0.8


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=BASE_RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL, in lower case; none if it has no "://"."""
    host, path = host_and_path(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    segments = F.transform(
        F.array_remove(F.split(F.lower(path), "/"), ""),
        lambda s: F.concat(F.lit("path="), F.regexp_replace(s, r"[0-9]+", "0")),
    )
    ending = F.regexp_extract(F.lower(path), r"\.([a-z0-9]{1,5})$", 1)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    names = F.transform(F.array_remove(F.split(query, "&"), ""), lambda q: F.concat(F.lit("query="), F.lower(F.substring_index(q, "=", 1))))
    scheme = F.lower(F.substring_index(url, "://", 1))
    tokens = F.array_distinct(
        F.concat(
            suffixes, segments, names,
            F.array(F.concat(F.lit("sub="), F.get(labels, F.lit(0))), F.concat(F.lit("ending="), ending), F.concat(F.lit("scheme="), scheme)),
        )
    )
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(F.instr(url, "://") > 0, tokens), none)


def mine_rules(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST_PAGES) -> DataFrame:
    """(rule_id, tokens, confidence, support) of the rules that say bad.

    ``pages`` (page_id, url); ``labels`` (doc_id, quality, toxic) are joined by
    id. A page is bad if a label says quality 0 or toxic 1. A rule needs
    ``support`` of the labelled pages and ``least`` of them.
    """
    bad = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")).alias("bad")
    )
    known = pages.join(bad, "page_id").select(url_tokens(F.col("url")).alias("tokens"), "bad").where(F.size("tokens") > 0)
    baskets = known.select(F.when(F.col("bad") == 1, F.array_append("tokens", BAD)).otherwise(F.col("tokens")).alias("items"))
    baskets = materialize(baskets, "baskets")
    share = min(1.0, max(support, least / max(1, baskets.count())))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
    return rules.select(
        F.xxhash64(F.array_sort("antecedent")).alias("rule_id"), F.array_sort("antecedent").alias("tokens"), "confidence", "support"
    )


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (url, rule_id) of the rules whose tokens a URL all holds. ``urls`` has no repeats, ``rules`` is written."""
    index = rules.select(F.explode("tokens").alias("token"), "rule_id", F.size("tokens").alias("all"))
    if small(rules):
        index = F.broadcast(index)
    held = urls.select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
    met = held.join(index, "token").groupBy("url", "rule_id", "all").agg(F.count(F.lit(1)).alias("n"))
    return met.where(F.col("n") == F.col("all")).select("url", "rule_id")


def judge_urls(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST_PAGES, id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every page row, and how many mined rules it meets."""
    pages = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"))
    rules = materialize(mine_rules(pages, labels, support, confidence, least), "rules")
    urls = pages.where(F.col("url").isNotNull()).select("url").distinct()
    bad = match_rules(urls, rules).groupBy("url").agg(F.count(F.lit(1)).alias("n_mined"))
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fixed", fixed_rule(F.col("host"), F.col("path"))).join(materialize(bad, "matched"), "url", "left")
    mined = F.when(F.col("n_mined") > 0, "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", mined).alias("verdict"), F.coalesce("n_mined", F.lit(0)).alias("n_mined"),
    )
