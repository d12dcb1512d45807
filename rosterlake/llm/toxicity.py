"""Toxicity by FTRL-proximal logistic regression over hashed n-grams.

Features are the presence of a word, of two neighbouring words, and of two words with one or two skipped between, hashed into
2^22 coordinates. Each coordinate has its own learning rate, and the L1 term leaves most weights at exactly 0, so the
model is a short list of coordinates and weights that every task gets.

Coordinates of at most ``rows`` labelled documents (a bound, not a share) are taken where the documents are and learnt
from in one task, which gets them once per epoch and keeps none; every document is scored whole.
Null and empty texts have no features and the score of the intercept. Repeated rows score alike, other columns are
carried along, an empty table stays empty. Without any labelled row every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.carry import computed
from rosterlake.llm.labelled import held_out, training_texts
from rosterlake.llm.words import LETTERS, Texts, mix

BITS = 22
ROWS = 12_000
#: Places of the words of a feature after its first word.
SHAPES = ((0,), (0, 1), (0, 2), (0, 3))


def features(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each shape the text and the coordinate of every occurrence."""
    words = texts.hashes()
    for shape in SHAPES:
        reach, n = shape[-1] + 1, len(words) - shape[-1]
        if n <= 0:
            continue
        value = np.full(n, mix(np.array([sum(1 << s for s in shape)], np.uint64))[0])
        for s in shape:
            value = mix(value ^ words[s : s + n])
        inside = texts.within(reach)
        yield texts.doc[:n][inside], (value[inside] >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Ftrl:
    """The optimiser of McMahan et al. (2013) for examples whose features are 0 or 1."""

    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.1

    def __post_init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(0.0, np.abs(z) - np.where(at == 1 << BITS, 0.0, self.l1))
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: int) -> None:
        """``at``: distinct coordinates, the last of all being the intercept, which has no L1 term."""
        weights, n = self.weights(at), self.n[at]
        gradient = 1 / (1 + np.exp(-weights.sum())) - label
        self.z[at] += gradient - (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / self.alpha * weights
        self.n[at] = n + gradient * gradient


def _examples(part: pa.RecordBatch) -> list[pa.Array]:
    """By text its distinct coordinates, four bytes each, the intercept last."""
    texts = Texts(part.column("text"), LETTERS, lower=True)
    found = list(features(texts))
    docs, places = (np.concatenate([np.zeros(0, np.int64), *(x[i] for x in found)]) for i in (0, 1))
    pairs = np.unique(docs << BITS | places)
    cuts = np.searchsorted(pairs >> BITS, np.arange(len(texts) + 1))
    places = (pairs & ((1 << BITS) - 1)).astype("<i4")
    return [pa.array([np.append(places[a:b], np.int32(1 << BITS)).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())]


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = Ftrl()
    for batch in batches:
        for places, label in zip(batch.column("places"), batch.column("label").to_pylist(), strict=True):
            model.learn(np.frombuffer(places.as_py(), "<i4"), label)
    weights = model.weights(np.arange((1 << BITS) + 1))
    used = np.flatnonzero(weights)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], ["place", "weight"])


@dataclass(frozen=True)
class Model:
    """Coordinates and their weights; coordinate 2^22 is the intercept."""

    places: np.ndarray
    weights: np.ndarray

    def score(self, texts: Texts) -> np.ndarray:
        table = np.zeros((1 << BITS) + 1, np.float64)
        table[self.places] = self.weights
        total = np.full(len(texts), table[1 << BITS])
        seen: list[np.ndarray] = []
        for docs, at in features(texts):
            hit = np.flatnonzero(table[at])
            seen.append(docs[hit] << BITS | at[hit])
        once = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
        np.add.at(total, once >> BITS, table[once & ((1 << BITS) - 1)])
        return 1 / (1 + np.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", rows: int = ROWS, epochs: int = 6) -> Model:
    texts = training_texts(docs, labels, label, rows)
    examples = computed(texts, _examples, "places binary", carry=["turn", "label"]).select("row.*", "places")
    # The first ``rows`` of every task, then of all in one partition, which Spark sorts and spills: the task that learns holds the
    # model and a batch of examples. The low 33 bits of the id number the rows of a task.
    of_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    first = examples.sortWithinPartitions("turn").where(of_task < rows).repartition(1).sortWithinPartitions("turn").limit(rows)
    again = first.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).sortWithinPartitions("epoch", "turn")
    found = again.select("places", "label").mapInArrow(_trained, "place bigint, weight double").toPandas()
    return Model(found["place"].to_numpy(), found["weight"].to_numpy())


def scored(docs: DataFrame, model: Model, *, carry: Sequence[str] | None = None) -> DataFrame:
    """Per document ``row`` (the columns ``carry``, or all) and ``score``, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(part: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(shared.value.score(Texts(part.column("text"), LETTERS, lower=True)))]

    return computed(docs, compute, "score double", carry=carry)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = scored(docs, fit(docs, labels), carry=["doc_id"])
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
