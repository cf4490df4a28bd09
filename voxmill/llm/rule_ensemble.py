"""Operator 1: a quality classifier of sparse rules.

Statistics of the whole text, shallow trees grown on them, every path of a tree as one rule (a
conjunction of bounds), a lasso logistic regression over the rules, and the rules that keep
a weight compiled to one column expression. Trees and weights are fitted by Spark ML on at most
``max_rows`` labelled rows, chosen by a hash of the id; the score itself is a native expression.

Cases. Null and empty texts have statistics of 0 and get a score. Rows are scored one by one,
so ties and repeats need no rule. Labels of unknown documents, null labels and labels that
disagree evenly are left out. Without labels of both kinds the score is the smoothed share of
label 1 (0.5 with no labels at all). Other columns are passed on by ``with_statistics``; those
named like a statistic are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch
from .host_rules import SYMBOLS, repeated_line_count
from .words import words_of

#: The rows that the trees and weights are fitted on, at most.
MAX_ROWS = 20_000
TREES, DEPTH, LASSO, SEED = 24, 3, 0.002, 7
THRESHOLD = 0.7
STATISTICS = ("n_words", "word_length", "symbols", "upper", "digits", "exclaims", "pipes", "stops", "distinct", "repeated_lines", "line_words")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with STATISTICS of the whole text: counts of words, else shares."""
    others = [c for c in docs.columns if c.lower() not in STATISTICS]
    held = docs.select(F.struct(*others).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    held = held.withColumn("_w", words_of(F.col("_t"))).withColumns({"_n": F.size("_w").cast("double"), "_c": F.length(F.array_join("_w", "")).cast("double")})

    def share(part: Column, of: str = "_c") -> Column:
        return F.when(F.col(of) > 0, part.cast("double") / F.col(of)).otherwise(F.lit(0.0))

    def only(chars: str) -> Column:
        return F.length(F.regexp_replace("_t", f"[^{chars}]+", ""))

    lines = F.size(F.split("_t", "\n"))
    held = held.withColumns({
        "n_words": F.col("_n"),
        "word_length": share(F.col("_c"), "_n"),
        "symbols": share(only(SYMBOLS)),
        "upper": share(only(r"\p{Lu}")),
        "digits": share(only("0-9")),
        "exclaims": share(only("!")),
        "pipes": share(only("|")),
        "stops": share(only("."), "_n"),
        "distinct": share(F.size(F.array_distinct("_w")), "_n"),
        "repeated_lines": repeated_line_count(F.col("_t")).cast("double") / lines,
        "line_words": F.col("_n") / lines,
    })
    return held.select("_row.*", *STATISTICS)


@dataclass(frozen=True)
class Rule:
    """Bounds that hold together: (statistic, is an upper bound, value)."""

    bounds: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        held = F.lit(True)
        for name, upper, value in self.bounds:
            held = held & ((F.col(name) <= value) if upper else (F.col(name) > value))
        return held

    def __str__(self) -> str:
        return " and ".join(f"{n} {'<=' if u else '>'} {v:.4g}" for n, u, v in self.bounds)


def tightened(bounds: list[tuple[str, bool, float]]) -> Rule:
    """The tightest bound of each side of each statistic."""
    best: dict[tuple[str, bool], float] = {}
    for name, upper, value in bounds:
        old = best.get((name, upper))
        best[name, upper] = value if old is None else (min if upper else max)(old, value)
    return Rule(tuple(sorted((n, u, v) for (n, u), v in best.items())))


def paths_of(node, names: tuple[str, ...], bounds: list | None = None) -> list[Rule]:
    """A rule for every node below ``node``."""
    bounds = bounds or []
    found = [tightened(bounds)] if bounds else []
    if node.subtreeDepth():
        split = node.split()
        name, value = names[split.featureIndex()], float(split.threshold())
        found += paths_of(node.leftChild(), names, [*bounds, (name, True, value)])
        found += paths_of(node.rightChild(), names, [*bounds, (name, False, value)])
    return found


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules and a constant."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...] = ()

    def score(self) -> Column:
        """The probability of label 1, as an expression over STATISTICS."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(labelled: DataFrame, max_rows: int = MAX_ROWS) -> Ensemble:
    """Fit to ``doc_id``, ``label`` (0 or 1) and STATISTICS."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    rows = labelled.orderBy(*order).limit(max_rows)
    rows = scratch.save(rows.coalesce(1).sortWithinPartitions(*order, *STATISTICS), "training")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = (ones + 1) / (n + 2)
    constant = Ensemble(math.log(share / (1 - share)))
    if ones in (0, n):
        return constant
    names = F.array(*[F.col(c).cast("double") for c in STATISTICS])
    train = rows.select("doc_id", F.col("label").cast("double").alias("label"), *STATISTICS, array_to_vector(names).alias("x")).coalesce(1)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=max(3, min(50, n // 100)), seed=SEED, subsamplingRate=0.8).fit(train)
    rules = sorted({r for tree in forest.trees for r in paths_of(tree._java_obj.rootNode(), STATISTICS)}, key=str)
    if not rules:
        return constant
    hits = F.array(*[F.when(r.column(), 1.0).otherwise(0.0) for r in rules])
    lasso = LogisticRegression(featuresCol="z", labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(train.select("label", array_to_vector(hits).alias("z")))
    weights = [float(w) for w in lasso.coefficients.toArray()]
    return Ensemble(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights, strict=True) if w))


def known_labels(labels: DataFrame, column: str = "quality") -> DataFrame:
    """doc_id and label: the majority of a document's labels."""
    mean = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg(column).alias("m"))
    return mean.filter("m <> 0.5").select("doc_id", (F.col("m") > 0.5).cast("int").alias("label"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    stats = scratch.save(with_statistics(docs).drop("text"), "statistics")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    labels = known_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")).filter(~held_out)
    model = fit(stats.join(labels, "doc_id").select("doc_id", "label", *STATISTICS))
    scored = stats.select("doc_id", held_out.alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
