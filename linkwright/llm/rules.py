"""A sparse rule ensemble for document quality.

A forest of shallow trees over text statistics proposes rules: every path from a root to a node is a conjunction of
thresholds. Lasso logistic regression over the 0/1 values of all rules keeps a few of them with a weight. What is left is
compiled into one Spark column expression over the text, so scoring needs neither Python nor a model object in the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.session import written

#: Labelled rows to fit on at most (those with the smallest hash of their id).
FIT_ROWS = 20_000

TREES, DEPTH, LASSO, SEED = 24, 4, 0.002, 7

#: Marks that text in prose has no use for.
TAGS = r"[<>{}\[\]\\]"

#: Statistics of a text, from the text, its words and its lines (fields of a struct); all are 0 for an empty text.
STATISTICS = {
    "n_words": lambda t: F.size(t["words"]),
    "chars_per_word": lambda t: _per(F.char_length(t["text"]), F.size(t["words"])),
    "distinct_words": lambda t: _per(F.size(F.array_distinct(t["words"])), F.size(t["words"])),
    "capital_words": lambda t: _per(_count(t, "[A-Z]{2,}"), F.size(t["words"])),
    "symbol_runs": lambda t: _per(_count(t, r"[^\p{L}\p{N}\s.,;:'\"()-]+"), F.size(t["words"])),
    "stops": lambda t: _per(_count(t, "[.,;:?]"), F.size(t["words"])),
    "numbers": lambda t: _per(_count(t, "[0-9]+"), F.size(t["words"])),
    "words_per_line": lambda t: _per(F.size(t["words"]), F.size(t["lines"])),
    "distinct_lines": lambda t: _per(F.size(F.array_distinct(t["lines"])), F.size(t["lines"])),
    "links": lambda t: _per(_count(t, "https?://|www[.]|@"), F.size(t["words"])),
    "tags": lambda t: _per(_count(t, TAGS), F.size(t["words"])),
}


def _per(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def _count(t: Column, pattern: str) -> Column:
    return F.regexp_count(t["text"], F.lit(pattern))


def with_statistics(text: Column, use) -> Column:
    """``use(statistics)`` for a text, where the statistics are a struct that is computed once.

    A lambda variable holds them, so that no rewrite of the plan can copy the scan of the text into every rule.
    """
    whole = F.coalesce(text, F.lit(""))
    split = F.array(F.struct(
        whole.alias("text"), F.filter(F.split(whole, r"\s+"), lambda w: w != "").alias("words"),
        F.filter(F.split(whole, "\n"), lambda x: x != "").alias("lines")))
    measured = F.transform(split, lambda t: F.struct(*(make(t).cast("double").alias(n) for n, make in STATISTICS.items())))
    return F.transform(measured, use)[0]


@dataclass(frozen=True)
class Rule:
    """All of ``parts`` hold: (statistic, whether it must be over the bound, bound)."""

    parts: tuple[tuple[str, bool, float], ...]

    def column(self, statistics: Column) -> Column:
        tests = [statistics[name] > bound if over else statistics[name] <= bound for name, over, bound in self.parts]
        return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class RuleModel:
    """Log-odds of label 1: ``bias`` plus the weights of the rules that hold."""

    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, text: Column) -> Column:
        """Probability of label 1 as a column expression."""
        def odds(statistics: Column) -> Column:
            parts = [F.when(rule.column(statistics), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
            return reduce(lambda a, b: a + b, parts, F.lit(self.bias))

        return F.lit(1.0) / (F.lit(1.0) + F.exp(-with_statistics(text, odds)))


def _paths(node, parts: tuple = ()) -> Iterator[Rule]:
    """Rules of all nodes below the root of a fitted tree; of two bounds on one side the tighter one stays."""
    if parts:
        tight: dict[tuple[str, bool], float] = {}
        for name, over, bound in parts:
            old = tight.get((name, over), bound)
            tight[name, over] = max(old, bound) if over else min(old, bound)
        yield Rule(tuple(sorted((name, over, bound) for (name, over), bound in tight.items())))
    if node.subtreeDepth():
        split = node.split()
        name, bound = list(STATISTICS)[split.featureIndex()], split.threshold()
        yield from _paths(node.leftChild(), (*parts, (name, False, bound)))
        yield from _paths(node.rightChild(), (*parts, (name, True, bound)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> RuleModel:
    """Learn ``label`` (1 or 0) from at most FIT_ROWS labelled documents, and from their texts only.

    Rows whose doc_id has a crc32 divisible by 5 are never learnt from. A document with several labels counts with the
    smallest; null ids and labels are left out. Without labels, or with one kind of label only, the model is a constant:
    a half, or near that label.
    """
    wanted = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    )
    rows = written(docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
                   .select("doc_id", "label", with_statistics(F.col("text"), lambda s: s).alias("s")), "sample")
    rows = rows.select("doc_id", "label", "s.*").repartition(1).sortWithinPartitions("doc_id", *STATISTICS).cache()
    ones, total = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
    if not total or ones in (0, total):
        return RuleModel({None: 0.0, 0: -3.0}.get(ones, 3.0) if total else 0.0, ())
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.5, maxBins=64,
                                    minInstancesPerNode=max(1, min(20, total // 50)), featureSubsetStrategy="onethird").fit(vectors)
    found = dict.fromkeys(rule for tree in forest._call_java("trees") for rule in _paths(tree.rootNode()))
    if not found:
        return RuleModel(math.log(ones / (total - ones)), ())
    statistics = F.struct(*STATISTICS)
    one = rows.withColumn("s", statistics)
    values = F.array(*(rule.column(F.col("s")).cast("double") for rule in found))
    fitted = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, standardization=False, maxIter=60).fit(
        one.select("label", array_to_vector(values).alias("features")))
    rows.unpersist()
    weights = fitted.coefficients.toArray()
    return RuleModel(float(fitted.intercept), tuple((r, float(w)) for r, w in zip(found, weights, strict=True) if w))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def report(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (1 from ``least`` on) of every row.

    A null text counts as empty, and an empty one gets the score of its statistics like any other. A row with a null
    doc_id is scored and not held out; repeated rows get equal scores. No column but the text is an input.
    """
    score = fit(docs, labels).score(F.col("text").cast("string"))
    return (docs.select("doc_id", held_out().alias("held_out"), score.alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= least, 1).otherwise(0)))


def accepted(docs: DataFrame, labels: DataFrame, known: DataFrame | None = None, least: float = 0.3) -> DataFrame:
    """``docs`` whose score is at least ``least``; columns stay as they are. ``known`` has the texts to learn from."""
    score = fit(docs if known is None else known, labels).score(F.col("text").cast("string"))
    return docs.filter(score >= least)
