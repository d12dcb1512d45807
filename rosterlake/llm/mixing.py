"""Mixing sources to target weights.

Sizes are summed per source, every source gets a target, and a document is repeated by its source's rate (target through
size): the whole part of the rate, and once more with the rest as probability, drawn from a hash of its id and text.

Null texts have size 0, null sources are one source of their own, last in order. Rows that are equal in id and text draw
alike. An empty table, and one without words, gives targets of 0 and no copies. Other columns are carried along
whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.keys import in_order, stage

WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``sizes`` (source, source_size; one row each) with ``target``.

    Sources in order of code points, null last, weigh ``weights`` in turn and split ``share`` times all sizes by weight. None
    gets more than ``cap`` times its size: the excess goes to the others by weight, round by round, until none is above.
    A round is one aggregate over the table of sources; only its two sums reach the driver.
    """
    ordered = in_order(sizes, [F.col("source").asc_nulls_last()], "sources")
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("_place") % len(weights) + 1).cast("int"))
    table = stage(ordered.select("source", "source_size", weight.alias("weight"), (cap * F.col("source_size")).alias("most")), "weights")
    everything = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = F.col("most") < level * F.col("weight")
        taken, rest, n = table.agg(
            F.sum(F.when(above, F.col("most")).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.count_if(above)
        ).first()
        if n == full or not rest:
            break
        level, full = (share * everything - taken) / rest, n
    return table.select("source", "source_size", F.least("most", level * F.col("weight")).alias("target"))


def planned(
    docs: DataFrame, *, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 1
) -> DataFrame:
    """Per document ``row`` (all its columns), ``size``, ``source_size``, ``target`` of its source and ``copies``."""
    sized = docs.select(F.struct("*").alias("row"), F.col("source"), words("text").alias("size"))
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    # The table of sources is staged, so its size is known: Spark broadcasts it below its threshold, and above joins by
    # shuffle and splits hot sources.
    targets = stage(targets, "targets").withColumnRenamed("source", "of_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("row.text", F.lit(""))))
    drawn = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("rate", rate)
        .withColumn("copies", (F.floor("rate") + F.when(drawn < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("long"))
        .select("row", "size", "source_size", "target", "copies")
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The documents, each as often as the mix takes it. Settings as for :func:`planned`."""
    times = F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    return planned(docs, **settings).where("copies > 0").select("row", F.explode(times)).select("row.*")


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return planned(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "row.doc_id", "size", "source_size", "target", taken, "copies"
    )


ORACLE = r"""
with sized as (
  select doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents
), totals as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as place
  from sized group by source
), weighed as (
  select source, source_size, case place % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as weight,
         2.0::double * source_size as most
  from totals
), filled as (
  select *, coalesce(sum(most) over w - most, 0) as full_before, sum(weight) over (order by most / weight desc, source rows unbounded preceding) as open_weight
  from weighed window w as (order by most / weight, source desc rows unbounded preceding)
), levels as (
  select (1.5::double * (select sum(source_size) from totals) - full_before) / open_weight as level, most / weight as full_at from filled
), level as (
  select level from levels where level <= full_at order by full_at limit 1
), targets as (
  select source, source_size, least(most, (select level from level) * weight) as target from weighed
), rated as (
  select doc_id, size, source_size, target, case when source_size > 0 then target / source_size else 0.0 end as rate,
         ('0x' || substr(md5(concat_ws(':', '1', coalesce(doc_id::varchar, ''), md5(coalesce(text, '')))), 1, 13))::bigint / 4503599627370496.0::double as drawn
  from sized join targets on sized.source is not distinct from targets.source
), repeated as (
  select *, (floor(rate) + case when drawn < rate - floor(rate) then 1 else 0 end)::bigint as copies from rated
)
select doc_id, size, source_size, target, (copies * size)::bigint as taken, copies from repeated
"""
