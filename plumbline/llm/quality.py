"""Quality classifier: a sparse ensemble of rules, compiled into Spark column expressions.

Statistics of the whole text are column expressions. A random forest is grown on labelled rows, each
path from its roots becomes a conjunctive rule, and a lasso logistic regression gives most rules the
weight 0 (Friedman and Popescu, "Predictive Learning via Rule Ensembles", 2008). What is left is one
column expression, so scoring is a scan without Python.

The model is fitted on at most about ``max_rows`` labelled rows, a stated bound.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut, fresh

Rule = tuple[tuple[str, str, float], ...]  # (statistic, "<=" or ">", threshold), ...


def statistics(text: Column) -> dict[str, Column]:
    """Column expressions over a non-null text. Shares are of its characters, 0 for an empty text."""
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")
    lines = F.split(text, "\n")
    n_words = F.size(words).cast("double")

    def share(letters: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, letters, ""))) / chars

    return {
        "log_chars": F.log(chars + 1.0),
        "log_words": F.log(n_words + 1.0),
        "word_length": chars / n_words,
        "upper": share(r"\p{Lu}+"),
        "digits": share(r"[0-9]+"),
        "ends": share(r"[.,;:?]+"),
        "marks": share(r"[^\p{L}\p{M}0-9\s.,;:?]+"),
        "new_words": F.size(F.array_distinct(words)) / n_words,
        "new_lines": F.size(F.array_distinct(lines)) / F.size(lines).cast("double"),
        "line_length": F.log(chars / F.size(lines) + 1.0),
    }


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are kept from learning: crc32 of the id as text, modulo 3, is 1. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def with_statistics(docs: DataFrame, text: str = "text", into: str = "_stats") -> tuple[DataFrame, list[str]]:
    """``docs`` with a struct ``into``; a null text counts as an empty one."""
    found = statistics(F.coalesce(F.col(text), F.lit("")))
    return docs.withColumn(into, F.struct(*[c.alias(k) for k, c in found.items()])), list(found)


def paths(forest: str, names: list[str]) -> list[Rule]:
    """The conjunctions along all paths of a forest's printed trees, from each root to each node, without repeats.

    Of several conditions on one statistic and side only the tightest counts; an "else" ends what its "if" opened.
    """
    rules: dict[Rule, None] = {}
    stack: list[tuple[int, str, str, float]] = []
    line = re.compile(r"^(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)")
    for text in forest.splitlines():
        if "Tree " in text:
            stack = []
        if not (m := line.match(text)):
            continue
        depth = len(m[1])
        stack = [s for s in stack if s[0] < depth] + [(depth, names[int(m[2])], m[3], float(m[4]))]
        tight: dict[tuple[str, str], float] = {}
        for _, name, op, at in stack:
            now = tight.get((name, op))
            tight[name, op] = at if now is None else min(now, at) if op == "<=" else max(now, at)
        rules[tuple(sorted((n, o, a) for (n, o), a in tight.items()))] = None
    return list(rules)


def holds(rule: Rule, stats: Column) -> Column:
    """The rule as a Boolean column."""
    out = F.lit(True)
    for name, op, at in rule:
        out = out & (stats[name] <= at if op == "<=" else stats[name] > at)
    return out


class Ensemble:
    """intercept and weights of rules; ``score`` is the compiled column."""

    def __init__(self, intercept: float, weights: dict[Rule, float]):
        self.intercept, self.weights = intercept, weights

    def score(self, stats: Column) -> Column:
        """Probability of label 1: a logistic of the weights of the rules that hold."""
        total = F.lit(self.intercept)
        for rule, w in self.weights.items():
            total = total + F.when(holds(rule, stats), F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000, trees: int = 20, depth: int = 4,
    penalty: float = 0.002, seed: int = 11,
) -> Ensemble:
    """Learn from the documents of ``labels`` (doc_id, ``label`` 0 or 1) that aren't held out.

    Above ``max_rows`` labelled ids, those of the smallest hashes count, about that many. Rows with a null id or
    label teach nothing; of several labels of one id the largest counts. If only one class (or none) is there, or no
    statistic tells the classes apart, the answer is the share of label 1, 0.5 without rows.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).cast("double").alias("_y"))
    share = int(min(1.0, max_rows / max(1, known.count())) * (1 << 30))
    known = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("quality")), F.lit(1 << 30)) < share)
    # the sample is bounded by max_rows, some 16 bytes each
    met = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    met, names = with_statistics(met)
    one = met.groupBy("doc_id").agg(F.max("_y").alias("_y"), F.min_by("_stats", F.xxhash64("text")).alias("_stats"))
    rows = cut(one.repartition(4, "doc_id").sortWithinPartitions("doc_id"))
    n = {r["_y"]: r["count"] for r in rows.groupBy("_y").count().collect()}
    p = (n.get(1.0, 0) + 0.5) / (sum(n.values()) + 1.0)
    share_only = Ensemble(math.log(p / (1 - p)), {})
    if len(n) < 2:
        return share_only
    vectors = VectorAssembler(inputCols=names, outputCol="x").transform(rows.select("doc_id", "_y", "_stats", "_stats.*"))
    forest = RandomForestClassifier(featuresCol="x", labelCol="_y", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird")
    rules = paths(forest.fit(vectors).toDebugString, names)  # all of them: the lasso chooses
    if not rules:  # no statistic tells the classes apart
        return share_only
    fired = F.array(*[holds(r, F.col("_stats")).cast("double") for r in rules])
    table = rows.select("_y", array_to_vector(fired).alias("x"))
    lasso = LogisticRegression(featuresCol="x", labelCol="_y", regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=60)
    model = lasso.fit(table)
    weights = {r: float(w) for r, w in zip(rules, model.coefficients.toArray(), strict=True) if abs(w) > 1e-6}
    return Ensemble(float(model.intercept), weights)


def score(docs: DataFrame, model: Ensemble, into: str = "_score") -> DataFrame:
    """``docs`` with a probability column, in place of one of its name. Null texts are scored as empty ones. Repeated rows get equal
    scores; extra columns pass through; an empty table gives an empty one."""
    stats = fresh(docs, "_stats")
    found, _ = with_statistics(docs, into=stats)
    return found.withColumn(into, model.score(F.col(stats))).drop(stats)
