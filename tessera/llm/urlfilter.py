"""URL filtering by association rules: Spark's FP-growth mines token combinations that go
with a label; pruned rules are matched through an inverted index.  DataFrame functions and
Spark ML (JVM) only.

Fixed host and path rules come first (``apply_host_rules``).  The URLs they decide are the
labelled rows; the mined rules judge all the others.
"""
from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (host, path, verdict); fixed values of the contract.
HOST_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
              ("com", "/fr/", "allow"), ("com", "/de/", "block"))
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, _URL, 1)), F.regexp_extract(url, _URL, 2)


def apply_host_rules(df: DataFrame, rules=HOST_RULES) -> DataFrame:
    """Add ``rule`` (host + path of the longest fitting rule, else null) and ``rule_verdict``.

    A rule fits its host and all subdomains if ``path`` starts with the rule's path.
    ``rules`` is a short parameter list; it becomes one CASE expression.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) \
            & F.startswith(F.col("path"), F.lit(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return df.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: scheme, top domain, host words, path words, query keys.
    Numbers become ``<n>``, as page numbers carry no meaning of their own."""
    plain = lower_ascii(F.coalesce(url, F.lit("")))
    top = F.concat(F.lit("t:"), F.substring_index(host, ".", -1))
    words = F.transform(F.regexp_extract_all(host, F.lit(r"[^.\-]+"), F.lit(0)), lambda x: F.concat(F.lit("w:"), x))
    segments = F.filter(F.split(lower_ascii(path), "/"), lambda x: x != "")
    paths = F.transform(segments, lambda x: F.concat(
        F.lit("p:"), F.regexp_replace(x, r"[0-9]+", "<n>")))
    query = F.regexp_extract(plain, r"\?([^#]*)", 1)
    keys = F.transform(F.regexp_extract_all(query, F.lit(r"(?:^|&)([^=&]+)"), F.lit(1)),
                       lambda x: F.concat(F.lit("q:"), x))
    scheme = F.regexp_extract(plain, r"^([a-z0-9+.\-]*)://", 1)
    return F.array_sort(F.array_distinct(F.concat(
        words, paths, keys, F.array(F.concat(F.lit("s:"), scheme), top))))


def mine_rules(labelled: DataFrame, label: str = "label", tokens: str = "tokens", target: str = "block",
               min_support: float = 0.002, min_confidence: float = 0.8, max_tokens: int = 3,
               min_rows: int = 20) -> DataFrame:
    """Association rules ``antecedent`` (array of tokens) -> ``target`` over all labelled rows.

    FP-growth runs over the tokens plus the label; rules are those with the label as
    consequent, at most ``max_tokens`` tokens, ``confidence`` and ``support`` at or above the
    limits.  Support is a share of the labelled rows (and at least ``min_rows`` of them, as
    a share of a few rows proves nothing), so the number of rules does not grow with the
    data.  Empty input gives no rules.
    """
    n = labelled.count()
    min_support = min(1.0, max(min_support, min_rows / max(n, 1)))
    mark = "label=" + target
    baskets = labelled.select(F.when(F.col(label) == target, F.array_append(tokens, F.lit(mark)))
                              .otherwise(F.col(tokens)).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = (model.associationRules
             .where((F.size("consequent") == 1) & (F.element_at("consequent", 1) == mark)
                    & (F.size("antecedent") <= max_tokens) & (F.col("support") >= min_support))
             .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"))
    return rules


def prune_rules(rules: DataFrame) -> DataFrame:
    """Drop a rule when a part of its antecedent is at least as confident, and number the rest.

    Parts are found by looking up every proper subset (at most 6 for 3 tokens) by equality.
    """
    a = F.col("antecedent")
    n = F.size(a)
    singles = F.transform(a, lambda x: F.array(x))
    pairs = F.when(n == 3, F.array(F.array(a[0], a[1]), F.array(a[0], a[2]), F.array(a[1], a[2]))) \
        .otherwise(F.array().cast("array<array<string>>"))
    parts = F.when(n > 1, F.concat(singles, pairs)).otherwise(F.array().cast("array<array<string>>"))
    sub = rules.select("antecedent", "confidence", F.explode(parts).alias("part"))
    known = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("part_confidence"))
    beaten = sub.join(known, "part").where(F.col("part_confidence") >= F.col("confidence")).select("antecedent").distinct()
    kept = rules.join(beaten, "antecedent", "left_anti")
    return kept.withColumn("rule_id", F.xxhash64(F.array_join("antecedent", "\x01")))


def match_rules(urls: DataFrame, key: list[str], rules: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Rows of ``urls`` (``key`` columns) that satisfy a rule, by inverted index.

    The index has one posting per rule, under its alphabetically last token; a url looks
    up its own tokens and keeps postings whose whole antecedent it contains.  Returns the
    key columns with ``n_rules`` and ``best_confidence``.
    """
    index = rules.select(F.element_at("antecedent", -1).alias("token"), "antecedent", "confidence")
    looked_up = urls.select(*key, F.col(tokens).alias("tokens"), F.explode(tokens).alias("token"))
    hits = looked_up.join(index, "token").where(
        F.size(F.array_intersect("tokens", "antecedent")) == F.size("antecedent"))
    return hits.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rules"), F.max("confidence").alias("best_confidence"))


def judge_urls(pages: DataFrame, page: str = "page_id", url: str = "url", rules=HOST_RULES,
               min_support: float = 0.002, min_confidence: float = 0.8) -> DataFrame:
    """Verdict for every row of ``pages``: ``page_id, host, path, rule, verdict, n_rules, best_confidence``.

    Urls that a host rule fits take its verdict and are the labelled rows; the others are
    blocked if at least one mined rule for ``block`` matches, and allowed otherwise.  Null
    urls and urls without ``://`` have empty host and path and are allowed unless a mined
    rule matches; null and repeated page ids are kept row by row; other columns are
    ignored; empty tables give empty results.

    Urls repeat heavily in tokens, so rules are matched once per distinct token set and the
    verdict is joined back on that set.
    """
    host, path = url_parts(F.col(url))
    rows = pages.select(F.col(page).alias("page_id"), F.col(url).alias("url"),
                        host.alias("host"), path.alias("path"))
    rows = apply_host_rules(rows, rules)
    rows = rows.withColumn("tokens", url_tokens(F.col("url"), F.col("host"), F.col("path")))
    found = prune_rules(mine_rules(rows.where(F.col("rule_verdict").isNotNull()), "rule_verdict",
                                   min_support=min_support, min_confidence=min_confidence))
    sets = rows.where(F.col("rule_verdict").isNull()).select("tokens").distinct()
    hits = match_rules(sets.withColumn("set_key", F.col("tokens")), ["set_key"], found)
    out = rows.join(hits, (rows["tokens"] == hits["set_key"]) & rows["rule_verdict"].isNull(), "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("n_rules") > 0, F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"),
                      F.coalesce("n_rules", F.lit(0)).alias("n_rules"), "best_confidence")
