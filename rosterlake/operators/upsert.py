"""Upsert in which a manual override outranks the incoming value."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from rosterlake.fixed_values import OVERRIDE_SUFFIX
from rosterlake.operators.dedupe import keep_one
from rosterlake.operators.joins import keyed_join, repeated_right_join
from rosterlake.operators.shape import align_schema, require_schema
from rosterlake.sources.tables import stage


def updated_rows(
    master: DataFrame,
    incoming: DataFrame,
    key: str,
    *,
    suffix: str = OVERRIDE_SUFFIX,
    repeated: bool = False,
) -> DataFrame:
    """Every master row with the columns it shares with ``incoming`` brought up to date.

    Order of precedence: the row's own ``<column><suffix>``, the incoming value, the present value. The
    override counts on all rows, matched or not. Several incoming rows of one key each yield a row; ``repeated``
    says that one key may have very many.
    """
    shared = [c for c in incoming.columns if c != key and c in master.columns]
    update = incoming.select(key, *[F.col(c).alias(f"{c}__new") for c in shared])
    joined = repeated_right_join(master, update, [key]) if repeated else keyed_join(master, update, [key], "left")

    def current(column: str):
        if column not in shared:
            return F.col(column)
        ranked = [f"{column}{suffix}"] if f"{column}{suffix}" in master.columns else []
        return F.coalesce(*ranked, f"{column}__new", column).alias(column)

    return joined.select([current(c) for c in master.columns])


def new_rows(master: DataFrame, incoming: DataFrame, key: str, schema: T.StructType) -> DataFrame:
    """Incoming rows whose key the master lacks, as ``schema``; a null key is always new.

    Columns that ``incoming`` lacks become typed nulls; a column of another type is an error. The master is
    read for its key alone and cut down to the incoming keys first, without a shuffle of the master when
    those are small enough to broadcast.
    """
    wanted = incoming.select(key).where(F.col(key).isNotNull()).distinct()
    keys = master.select(key).where(F.col(key).isNotNull())
    return rows_of_new_keys(incoming, keyed_join(keys, wanted, [key], "left_semi").distinct(), key, schema)


def rows_of_new_keys(incoming: DataFrame, known: DataFrame, key: str, schema: T.StructType) -> DataFrame:
    """Incoming rows whose key is not among ``known``, as ``schema``."""
    fresh = keyed_join(incoming, known, [key], "left_anti")
    fresh = fresh.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in incoming.columns}
    )
    require_schema(fresh, schema, "incoming rows")
    return fresh.select(schema.names)


def incoming_rows(incoming: DataFrame, key: str, schema: T.StructType, *, one_per_key: bool = False) -> DataFrame:
    """``incoming`` under the types of ``schema``, with ``one_per_key`` reduced to a row for each key that is not null."""
    shared = T.StructType([f for f in schema if f.name in incoming.columns])
    incoming = align_schema(incoming, shared, "incoming rows")
    if not one_per_key:
        return incoming
    unkeyed = incoming.where(F.col(key).isNull())
    return keep_one(incoming.where(F.col(key).isNotNull()), [key]).unionByName(unkeyed)


def has_hot_key(incoming: DataFrame, key: str) -> bool:
    """Whether a key of a stored table has more than one row and as many as an even partition would hold. A job over the key."""
    partitions = int(incoming.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    # A null key matches nothing and weighs nothing.
    most = counts.agg(F.sum("n").alias("all"), F.max(F.when(F.col(key).isNotNull(), F.col("n"))).alias("most")).first()
    return (most["most"] or 0) > 1 and most["most"] * partitions >= most["all"]


def upsert_with_overrides(
    master: DataFrame,
    incoming: DataFrame,
    key: str,
    schema: T.StructType,
    *,
    suffix: str = OVERRIDE_SUFFIX,
    one_per_key: bool = False,
    repeated: bool = False,
) -> DataFrame:
    """Updated master rows followed by new rows, all under ``schema``.

    ``incoming`` is aligned first: columns of ``schema`` take its types, values that do not fit become null, further columns
    go. It is read several times, so hand in a stored or staged table.

    A left join and an anti join rather than one full outer join: the master then needs no shuffle at all
    when ``incoming`` is small enough to broadcast.

    ``one_per_key`` first reduces ``incoming`` to one row per key, so that no master row is multiplied, and stages the
    reduced rows, which starts a job. ``repeated`` is for an ``incoming`` in which one key may hold very many rows, see
    ``has_hot_key``.
    """
    require_schema(master, schema, "master")
    incoming = incoming_rows(incoming, key, schema, one_per_key=one_per_key)
    if one_per_key:
        incoming = stage(incoming, "one-per-key")
    updated = updated_rows(master.select(schema.names), incoming, key, suffix=suffix, repeated=repeated and not one_per_key)
    return updated.unionByName(new_rows(master, incoming, key, schema))
