"""Bounded samples of labelled documents, and who is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``turn``, ``text`` and ``label`` (0 or 1) of the documents of at most ``rows`` labelled ids that are not held out,
    those with the smallest hashes, spread as ``docs`` is. :func:`in_turn` bounds the rows as well.

    An id that is labelled more than once has its largest label; null ids and labels are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("of_doc")).agg(F.max(label).alias("label"))
    # At most ``rows`` ids of some bytes each are broadcast, so few texts move.
    chosen = F.broadcast(known.orderBy(F.xxhash64("of_doc"), "of_doc").limit(rows))
    found = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("of_doc"))
    turn = F.struct(F.xxhash64("of_doc").alias("h"), F.col("of_doc").alias("id"), F.xxhash64("text").alias("t"))
    return found.select(turn.alias("turn"), "text", F.col("label").cast("int").alias("label"))


def in_turn(df: DataFrame, rows: int) -> DataFrame:
    """The first ``rows`` rows in order of ``turn``, in one partition."""
    return df.orderBy("turn").limit(rows)
