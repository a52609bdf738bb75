"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees are grown on a bounded sample of labelled rows, their paths become
conjunctive rules, lasso logistic regression keeps a few of them, and those
are compiled into one Spark column expression, so scoring is a plain scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


DIGITS = "0123456789"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SHOUTS, STOPS = "!?", ".;:"
#: Runs of characters that no statistic counts one by one. Written out: ranges make the regex engine nine times slower here.
UNCOUNTED = f"[^{SYMBOLS}{SHOUTS}{STOPS}{UPPER}{DIGITS}]++"


def _let(value: Column, then) -> Column:
    """then(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def pieces(text: Column) -> Column:
    """What the statistics of a text (null counts as empty) share: its words, lines, counted characters and sizes."""
    text = F.coalesce(text, F.lit(""))
    inner = F.btrim(text, F.lit(SPACE))
    words = F.when(inner != "", F.split(inner, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))
    return F.struct(
        words.alias("words"), F.split(text, "\n").alias("lines"), F.regexp_replace(text, UNCOUNTED, "").alias("marks"),
        F.length(text).alias("chars"), F.octet_length(text).alias("bytes"),
    )


def statistics(p: Column) -> dict[str, Column]:
    """Numbers about a whole text by its pieces; every one is finite."""
    n, chars, n_lines = F.size(p["words"]), p["chars"], F.size(p["lines"])
    per = lambda x, y: x / F.greatest(y, F.lit(1)).cast("double")
    of = lambda counted: F.length(p["marks"]) - F.length(F.translate(p["marks"], counted, ""))
    return {
        "n_words": n.cast("double"),
        "word_length": per(chars, n),
        "line_words": per(n, n_lines),
        "symbols_a_word": per(of(SYMBOLS), n),
        "bars_a_word": per(of("|"), n),
        "shouts_a_word": per(of(SHOUTS), n),
        "stops_a_word": per(of(STOPS), n),
        "upper_share": per(of(UPPER), chars),
        "digit_share": per(of(DIGITS), chars),
        "wide_share": per(p["bytes"] - chars, chars),
        "distinct_words": per(F.size(F.array_distinct(p["words"])), n),
        "distinct_lines": per(F.size(F.array_distinct(p["lines"])), n_lines),
    }


def statistic_names() -> list[str]:
    return list(statistics(F.struct()))


@dataclass
class Condition:
    feature: str
    at_most: bool
    value: float

    def column(self, stats: dict[str, Column]) -> Column:
        x = stats[self.feature]
        return x <= F.lit(self.value) if self.at_most else x > F.lit(self.value)


@dataclass
class RuleModel:
    """bias and (weight, conditions) of each kept rule."""

    bias: float
    rules: list[tuple[float, list[Condition]]]



def score_from(model: RuleModel, stats: dict[str, Column]) -> Column:
    margin = F.lit(float(model.bias))
    for weight, conditions in model.rules:
        holds = F.lit(True)
        for c in conditions:
            holds = holds & c.column(stats)
        margin = margin + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def stats_struct(text: Column) -> Column:
    return _let(pieces(text), lambda p: F.struct(*[c.alias(k) for k, c in statistics(p).items()]))


def tree_paths(debug: str, names: list[str]) -> list[list[Condition]]:
    """Every path from a root to a node (leaf or not), merged to one bound a side and feature."""
    paths: dict[tuple, list[Condition]] = {}
    stack: list[tuple[int, Condition]] = []
    for line in debug.splitlines():
        m = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-0-9.E]+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        stack = [x for x in stack if x[0] < depth] + [(depth, Condition(names[int(m[3])], m[4] == "<=", float(m[5])))]
        merged: dict[tuple[str, bool], Condition] = {}
        for _, c in stack:
            k = (c.feature, c.at_most)
            tighter = k not in merged or (c.value < merged[k].value) == c.at_most
            merged[k] = c if tighter else merged[k]
        rule = [merged[k] for k in sorted(merged)]
        paths[tuple((c.feature, c.at_most, c.value) for c in rule)] = rule
    return list(paths.values())


def fit_rules(
    docs: DataFrame, labels: DataFrame, *, sample: int = 20_000, trees: int = 20, depth: int = 3, lasso: float = 0.002, seed: int = 7
) -> RuleModel:
    """Model from docs (doc_id, text) and labels (doc_id, label 0 or 1).

    At most `sample` labelled ids are used: those lowest by a hash of the id.
    Null ids, null labels and ids with both labels are not learned from.
    Without both labels the model is the share of label 1 (0.5 if none).
    """
    picked = (
        labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other").select(F.col("doc_id"), F.col("label").cast("double").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    picked = saved(picked, "labelled")  # bounded by `sample`
    learn = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("label", stats_struct(F.col("text")).alias("stats"))
    names = statistic_names()
    learn = saved(learn.select("label", "stats.*").coalesce(8), "statistics")
    share = learn.agg(F.avg("label")).first()[0]
    if share is None or share in (0.0, 1.0):
        share = min(max(0.5 if share is None else share, 1e-3), 1 - 1e-3)
        import math

        return RuleModel(math.log(share / (1 - share)), [])
    learn = learn.coalesce(2).cache()
    try:
        table = learn.select("label", array_to_vector(F.array(*names)).alias("features"))
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="0.5", subsamplingRate=0.7, minInstancesPerNode=5, maxBins=64).fit(table)
        rules = tree_paths(forest.toDebugString, names)
        columns = {k: F.col(k) for k in names}
        held = []
        for r in rules:
            c = F.lit(True)
            for x in r:
                c = c & x.column(columns)
            held.append(c.cast("double"))
        if not rules:
            held = [F.lit(0.0)]
        fitted = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=True).fit(learn.select("label", array_to_vector(F.array(*held)).alias("features")))
    finally:
        learn.unpersist()
    weights = [float(w) for w in fitted.coefficients.toArray()]
    return RuleModel(float(fitted.intercept), [(w, r) for w, r in zip(weights, rules) if w != 0.0])


def score(model: RuleModel, text: Column) -> Column:
    """Probability of label 1 as one expression."""
    return _let(stats_struct(text), lambda s: score_from(model, {k: s[k] for k in statistic_names()}))


def score_documents(docs: DataFrame, model: RuleModel) -> DataFrame:
    """(doc_id, score, predicted) for every row: null and empty texts score as empty ones; repeated rows stay.

    An empty table gives no rows. Other columns are ignored.
    """
    scored = docs.select("doc_id", score(model, F.col("text")).alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
