"""Upsert of an update into a versioned table, in which only files that hold a key of the update are rewritten."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from rosterlake.fixed_values import OVERRIDE_SUFFIX
from rosterlake.operators.joins import keyed_join
from rosterlake.operators.shape import align_schema
from rosterlake.operators.upsert import has_hot_key, incoming_rows, rows_of_new_keys, updated_rows, upsert_with_overrides
from rosterlake.sinks import versions
from rosterlake.sinks.versions import Version
from rosterlake.sources.tables import stage


def merge_table(
    incoming: DataFrame, path: str, key: str, schema: T.StructType, *, suffix: str = OVERRIDE_SUFFIX, one_per_key: bool = False,
    notes: Mapping[str, Any] | None = None,
) -> Version:
    """Bring the table at ``path`` up to date with ``incoming``, as ``upsert_with_overrides`` would; the version made.

    The keys of the update are looked up in the table's key column alone, with the file of each. Files that hold one are
    rewritten, new rows make files of their own, and the version names these beside the files left as they were.

    An override counts on all rows. It is settled in a file once the file has been rewritten with the column among the
    incoming ones; the version notes for which columns that is so of all files, and the table is rewritten whole where an
    update brings a further one, and always by its first merge.
    """
    spark = incoming.sparkSession
    base = versions.current_version(spark, path)
    if base is None:
        raise FileNotFoundError(f"no version of table {path}")
    incoming = stage(incoming_rows(incoming, key, schema, one_per_key=one_per_key), "incoming")
    settled, overridden = set(base.notes.get("settled", ())), {c for c in incoming.columns if c != key and f"{c}{suffix}" in schema.names}
    repeated = has_hot_key(incoming, key)

    def read(files=None) -> DataFrame:
        some = base if files is None else base._replace(paths=tuple(files))
        return align_schema(versions.read_version(spark, path, some), schema, "table")

    if "settled" not in base.notes or not overridden <= settled:
        rows, kept = upsert_with_overrides(read(), incoming, key, schema, suffix=suffix, repeated=repeated), []
    else:
        master = versions.read_version(spark, path, base)
        keys = master.select(F.col(key).cast(schema[key].dataType).alias(key), F.col("_metadata.file_path").alias("file"))
        wanted = incoming.select(key).where(F.col(key).isNotNull()).distinct()
        held = stage(keyed_join(keys.where(F.col(key).isNotNull()), wanted, [key], "left_semi").distinct(), "held-keys")
        # One name for each file, as the driver has of any table that it reads.
        touched = {versions.relative_file(r["file"]) for r in held.select("file").distinct().collect()}
        kept = [f for f in versions.files_of(spark, path, base) if f not in touched]
        rows = rows_of_new_keys(incoming, held.select(key).distinct(), key, schema)
        if touched:
            rows = updated_rows(read(sorted(touched)).select(schema.names), incoming, key, suffix=suffix, repeated=repeated).unionByName(rows)
    written = versions.write_data(rows, path, base)
    return versions.commit(spark, path, [*kept, written], base, {**(notes or {}), "settled": sorted(settled | overridden)})
