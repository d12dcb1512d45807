"""Equi-joins in which neither null keys nor keys that are often repeated weigh down one task.

A key with many rows on the left needs nothing here: adaptive execution splits such a partition of a left, semi or anti
join by itself. It can neither split the right side of a left join nor know that null matches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left``, ``left_semi`` or ``left_anti`` join on equal column names; nothing else is done to its two sides.

    Left rows with a null key match nothing. They go round the join and come back by a union, so they are neither
    shuffled nor meet in one task. Spark broadcasts a right side by itself when its measured size allows it.
    """
    if how not in ("left", "left_semi", "left_anti"):
        raise ValueError(f"keyed_join does not do {how!r}")
    keys, added = list(keys), [c for c in right.columns if c not in keys] if how == "left" else []
    a, b = left.alias("a"), right.alias("b")
    without_key = reduce(or_, (F.col(f"a.`{k}`").isNull() for k in keys))
    on = [F.col(f"a.`{k}`") == F.col(f"b.`{k}`") for k in keys]
    nullable = any(left.schema[k].nullable for k in keys)
    joined = a.where(~without_key) if nullable else a
    joined = joined.join(b, on, how).select([F.col(f"a.`{c}`") for c in left.columns] + [F.col(f"b.`{c}`") for c in added])
    if not nullable or how == "left_semi":
        return joined
    absent = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in added]
    return joined.unionAll(a.where(without_key).select([F.col(f"a.`{c}`") for c in left.columns] + absent))


def repeated_right_join(left: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: Sequence[Column] = ()) -> DataFrame:
    """Left join in which a key may hold any share of the right rows.

    Keys with at least as many right rows as an even partition would hold are kept as a table, which is broadcast: there
    can't be more of them than shuffle partitions. Their right rows are dealt out by the hash of the row, over four times as
    many salts as they would fill partitions (some salts always meet in a partition), and the left rows of these keys alone
    are repeated under every salt. All other rows take the plain join. No job runs while the plan is built.

    ``spread_by``: further columns for the hash, so that rows that are equal in all columns spread too; they have to be the
    same when a task is retried, as ``_metadata.file_path`` and ``_metadata.row_index`` of a parquet scan are.
    """
    keys, added = list(keys), [c for c in right.columns if c not in keys]
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_hash = F.xxhash64(*right.columns, *spread_by)
    right = right.withColumn("__hash", row_hash).select(*right.columns, "__hash")
    total = right.select((F.count(F.lit(1)) / partitions).alias("even")).scalar()
    counts = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).dropna(subset=keys)
    hot = counts.where((F.col("__n") > 1) & (F.col("__n") >= total))
    salts = F.ceil(4 * F.col("__n") / F.greatest(total, F.lit(1.0))).cast("int")
    hot = F.broadcast(hot.select(*[F.col(k).alias(f"__{k}") for k in keys], salts.alias("__salts")))

    def marked(df: DataFrame) -> DataFrame:
        on = [F.col(k) == F.col(f"__{k}") for k in keys]
        return df.join(hot, on, "left").drop(*[f"__{k}" for k in keys])

    left_marked, right_marked = marked(left), marked(right)
    cold = keyed_join(
        left_marked.where("__salts is null").drop("__salts"), right_marked.where("__salts is null").select(*keys, *added), keys, "left"
    )
    repeated = left_marked.where("__salts is not null").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
    dealt = right_marked.where("__salts is not null").withColumn("__salt", F.pmod("__hash", F.col("__salts")).cast("int"))
    a, b = repeated.alias("a"), dealt.select(*keys, *added, "__salt").alias("b")
    met = a.join(b, [F.col(f"a.`{k}`") == F.col(f"b.`{k}`") for k in [*keys, "__salt"]])
    return cold.unionAll(met.select([F.col(f"a.`{c}`") for c in left.columns] + [F.col(f"b.`{c}`") for c in added]))
