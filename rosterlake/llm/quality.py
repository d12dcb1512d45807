"""Quality classifier: a sparse rule ensemble.

A forest of shallow trees is grown over statistics of the text. The path to every node below a root is a rule, a
conjunction of thresholds; a logistic regression with an L1 term over the rules keeps few of them, and these are
compiled into one Spark column over the statistics' columns.

Trees and weights are fitted on at most ``rows`` labelled documents (a bound, not a share), of which statistics only are kept;
every document is scored whole. Null and empty texts have statistics of 0 and are scored like any other. Repeated rows
score alike, other columns are carried along, an empty table stays empty. Where all labels are the same, or there is none,
the score is the share of label 1, or 0.5.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.carry import computed
from rosterlake.llm.keys import stage
from rosterlake.llm.labelled import held_out, in_turn, training_texts
from rosterlake.llm.words import Texts, grams, mix, sequence

ROWS = 20_000

_ALL = np.arange(256)
_KINDS = {
    "capitals": (_ALL >= 0x41) & (_ALL <= 0x5A),
    "digits": (_ALL >= 0x30) & (_ALL <= 0x39),
    "symbols": np.isin(_ALL, list(b"#*$%&|<>{}[]\\^~=_@+/")),
    "bars": _ALL == ord("|"),
    "shouts": np.isin(_ALL, list(b"!?")),
    "stops": np.isin(_ALL, list(b".,;:")),
    "beyond_ascii": (_ALL >= 0xC0),
    "lines": _ALL == 0x0A,
}
STATISTICS = [*_KINDS, "words", "word_length", "distinct_words", "repeats_next", "distinct_fours", "longest_word"]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(part)), where=whole > 0)


def _distinct(texts: Texts, docs: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Distinct values by text."""
    _, at = np.unique(mix(values ^ mix(docs.astype(np.uint64))), return_index=True)
    return np.bincount(docs[at], minlength=len(texts)).astype(float)


def statistics(texts: Texts) -> list[np.ndarray]:
    """Numbers per text in the order of ``STATISTICS``: kinds of characters and distinct things as shares of the words,
    mean and longest word in bytes, the number of words as a logarithm."""
    n_words = texts.per_text(np.ones(len(texts.start))).astype(float)
    words, lengths = texts.hashes(), texts.end - texts.start
    found = [_share(texts.bytes_per_text(kind[texts.data]), n_words) for kind in _KINDS.values()]
    next_same = np.zeros(len(words), bool)
    next_same[:-1] = (words[1:] == words[:-1]) & (texts.doc[1:] == texts.doc[:-1])
    fours, inside = grams(sequence(words), len(words), 4), texts.within(4)
    longest = np.zeros(len(texts))
    np.maximum.at(longest, texts.doc, lengths)
    return [
        *found,
        np.log1p(n_words),
        _share(texts.per_text(lengths), n_words),
        _share(_distinct(texts, texts.doc, words), n_words),
        _share(texts.per_text(next_same), n_words),
        _share(_distinct(texts, texts.doc[: len(fours)][inside], fours[inside]), np.maximum(0, n_words - 3)),
        longest,
    ]


def with_statistics(docs: DataFrame, *, carry: Sequence[str] | None = None) -> DataFrame:
    """Per document ``row`` (the columns ``carry``, or all) and its statistics, a double each."""

    def compute(part: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(x) for x in statistics(Texts(part.column("text")))]

    return computed(docs, compute, ", ".join(f"{s} double" for s in STATISTICS), carry=carry)


@dataclass(frozen=True)
class Rule:
    """All of some (statistic, whether above, threshold)."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        return reduce(and_, (F.col(s) > t if above else F.col(s) <= t for s, above, t in self.terms))

    def __str__(self) -> str:
        return " and ".join(f"{s} {'>' if above else '<='} {t:.4g}" for s, above, t in self.terms)


@dataclass(frozen=True)
class Ensemble:
    """Rules and their weights in the log odds."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The probability as a column over the statistics."""
        odds = sum((F.when(rule.column(), weight).otherwise(0.0) for rule, weight in self.rules), F.lit(self.intercept))
        return 1 / (1 + F.exp(-odds))


_BRANCH = re.compile(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def _paths(described: str) -> set[Rule]:
    """The rules of a tree as Spark describes it, one condition a line, deeper ones further in. Of several thresholds of
    one statistic in one direction the tightest counts."""
    found, held = set(), []
    for line in described.splitlines():
        if not (m := _BRANCH.match(line)):
            continue
        depth = len(m[1])
        held = [h for h in held if h[0] < depth]
        held.append((depth, STATISTICS[int(m[2])], m[3] == ">", float(m[4])))
        tight: dict[tuple[str, bool], float] = {}
        for _, s, above, t in held:
            tight[s, above] = (max if above else min)(t, tight.get((s, above), t))
        found.add(Rule(tuple(sorted((s, above, t) for (s, above), t in tight.items()))))
    return found


def fit(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", rows: int = ROWS, trees: int = 12, depth: int = 3, penalty: float = 0.002
) -> Ensemble:
    sample = with_statistics(training_texts(docs, labels, label, rows), carry=["turn", "label"])
    table = stage(in_turn(sample.select("row.*", *STATISTICS), rows).drop("turn"), "quality-sample")
    n, ones = table.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        share = (ones + 0.5) / (n + 1) if n else 0.5
        return Ensemble(math.log(share / (1 - share)), ())
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="statistics").transform(table)
    forest = RandomForestClassifier(
        featuresCol="statistics", labelCol="label", numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="onethird", minInstancesPerNode=5
    ).fit(vectors)
    rules = sorted(set().union(*(_paths(t.toDebugString) for t in forest.trees)), key=str)
    if not rules:
        return Ensemble(math.log(ones / (n - ones)), ())
    held = table.select("label", F.array(*(r.column().cast("double") for r in rules)).alias("held"))
    from pyspark.ml.functions import array_to_vector

    lasso = LogisticRegression(
        featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60
    ).fit(held.select("label", array_to_vector("held").alias("rules")))
    weights = lasso.coefficients.toArray()
    return Ensemble(float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if w))


def scored(docs: DataFrame, ensemble: Ensemble, *, carry: Sequence[str] | None = None) -> DataFrame:
    """Per document ``row`` (the columns ``carry``, or all) and ``score``, the probability of label 1."""
    return with_statistics(docs, carry=carry).select("row", ensemble.score().alias("score"))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = scored(docs, fit(docs, labels), carry=["doc_id"])
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
