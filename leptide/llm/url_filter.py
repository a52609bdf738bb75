"""URL filtering: fixed host and path rules first, then mined association rules.

Spark's FP-growth mines combinations of URL tokens that go with bad labels.
Rules that pass the support and confidence limits are posted in an inverted
index under their rarest token, so a URL meets only rules that share it.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label:bad"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first `://`: host up to / ? # (A-Z lower-cased), then path up to ? or #; both empty without it."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Longest rule (verdict, host + path) that fits; equally long ones in the order given."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda x: len(x[1])):
        at = rule.index("/")
        h, p = rule[:at], rule[at:]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL, marked by where they stand; numbers fold into one token."""
    url = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)
    host, path = host_and_path(url)
    part = lambda mark, text, cut: F.transform(
        F.filter(F.split(text, cut), lambda x: F.length(x) > 0), lambda x: F.concat(F.lit(mark), F.when(x.rlike("^[0-9]+$"), "#").otherwise(x))
    )
    return F.array_distinct(
        F.concat(
            part("host:", host, r"\."),
            part("path:", F.regexp_replace(path, r"\.[a-z0-9]+$", ""), r"[/_.-]"),
            part("type:", F.regexp_extract(path, r"\.([a-z]+)$", 1), "/"),
            part("key:", F.regexp_replace(F.regexp_extract(url, r"\?([^#]*)", 1), "=[^&]*", ""), "&"),
        )
    )


def mine_rules(labelled: DataFrame, *, min_support: float, min_rows: int, min_confidence: float) -> DataFrame:
    """Rules (rule, tokens, confidence, support, rarest) from rows (url, bad boolean).

    Every labelled row counts; rows whose label is null do not. A combination
    must hold the share min_support of the rows and min_rows of them. The number
    of frequent ones is bounded by the share, not by the rows.
    """
    spark = labelled.sparkSession
    baskets = labelled.where("bad is not null").select(
        F.concat(url_tokens(F.col("url")), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items")
    ).where("size(items) > 0")
    schema = "rule long, tokens array<string>, confidence double, support double, rarest string"
    n = baskets.count()
    if n < min_rows:  # no combination can be frequent
        return spark.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=max(min_support, min_rows / n), minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD))).select(
        F.xxhash64(F.array_sort("antecedent")).alias("rule"), F.array_sort("antecedent").alias("tokens"), "confidence", "support"
    )
    single = model.freqItemsets.where("size(items) = 1").select(F.col("items")[0].alias("token"), "freq")
    rarest = (
        rules.select("rule", F.explode("tokens").alias("token")).join(single, "token").groupBy("rule").agg(F.min_by("token", F.struct("freq", "token")).alias("rarest"))
    )
    return rules.join(rarest, "rule").select("rule", "tokens", "confidence", "support", "rarest")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, best confidence, number of matching rules) for urls that contain all tokens of a rule."""
    posted = rules.select(F.col("rarest").alias("token"), "tokens", "confidence")
    hits = urls.select("url", url_tokens(F.col("url")).alias("items")).select("url", "items", F.explode("items").alias("token")).join(posted, "token")
    return (
        hits.where(F.size(F.array_except("tokens", "items")) == 0).groupBy("url").agg(F.max("confidence").alias("confidence"), F.count("*").alias("n_rules"))
    )


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], *, min_support: float = 0.005, min_rows: int = 20, min_confidence: float = 0.6
) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, confidence, n_rules) for every page.

    `labels` has (url, bad). A URL that no fixed rule and no mined rule
    touches is allowed; so are null URLs and those without `://`. Repeated
    pages and null ids keep their rows; without labels nothing is mined.
    Other columns are ignored.
    """
    mined = match_rules(pages.select("url").where("url is not null").distinct(), mine_rules(labels, min_support=min_support, min_rows=min_rows, min_confidence=min_confidence))
    host, path = host_and_path(F.col("url"))
    base = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return base.join(mined, "url", "left").select(
        "page_id", "url", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("n_rules") > 0, "block").otherwise("allow")).alias("verdict"), "confidence", F.coalesce("n_rules", F.lit(0)).alias("n_rules"),
    )
