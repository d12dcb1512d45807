"""One row per key of a wide stored table: rows are chosen by key and rank alone and fetched afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rosterlake.operators.dedupe import keep_one
from rosterlake.sources.tables import stage

_FILE, _ROW, _TIED = "__file", "__row", "__tied"


def keep_one_late(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = (), *, nulls_win: bool = False) -> DataFrame:
    """``keep_one`` of a table that is read from Parquet files, at most projected and filtered; they must not change meanwhile.

    What is sorted and reduced holds the key, the columns ``prefer`` and a locator (file and row in it), never the other columns: rows
    are first counted by key and rank, then each key's greatest rank is taken with its count. Where one row has it, its locator is
    the choice. Where several have it, all of these are located, and ``keep_one`` settles the tie by the other columns.
    Rows are fetched by a hash join with the locators, which are different for all rows, so a hot key is spread evenly
    there and no wide row is sorted; a task's share of the locators has to fit in its memory, some 100 bytes each.

    The table is read two times by key and rank and once whole. That pays where rows are wide and most of them are not chosen;
    otherwise ``keep_one`` is the better one. Chosen rows are staged.
    """
    keys, prefer = list(keys), list(prefer)
    located = df.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))
    rank = [p for c in prefer for p in ([F.col(c).isNull().alias(f"{c}__null")] if nulls_win else []) + [F.col(c)]]
    at = F.struct(_FILE, _ROW)
    counted = located.groupBy(*keys, *prefer).agg(F.count(F.lit(1)).alias("__n"), F.min(at).alias("__at"))
    best = counted.groupBy(*keys).agg(F.max(F.struct(*rank, "__n", "__at")).alias("__best"))
    best = stage(best.select(*keys, *(F.col("__best").getField(c).alias(c) for c in prefer), "__best.__n", "__best.__at"), "best")
    alone = best.where("__n = 1").select("__at.*", F.lit(False).alias(_TIED))
    tied = best.where("__n > 1").select(*keys, *prefer)
    same = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in [*keys, *prefer]]
    several = located.select(*keys, *prefer, _FILE, _ROW).alias("a").join(tied.alias("b"), same, "left_semi")
    locators = alone.unionByName(several.select(_FILE, _ROW, F.lit(True).alias(_TIED)))
    fetched = stage(located.join(locators.hint("shuffle_hash"), [_FILE, _ROW]).select(*df.columns, _TIED), "fetched")
    settled = keep_one(fetched.where(_TIED).select(df.columns), keys, prefer, nulls_win=nulls_win)
    return fetched.where(~F.col(_TIED)).select(df.columns).unionByName(settled)
