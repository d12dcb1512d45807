"""Column selection and schema alignment. Plan-time work only: no operator here starts a job."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rosterlake.functions.casts import lenient_cast

log = logging.getLogger(__name__)


def select_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The mapped columns that exist, under their new names, in the order of the map."""
    return df.select([F.col(f"`{old}`").alias(new) for old, new in names.items() if old in df.columns])


def select_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Those of ``columns`` that exist, in the order given."""
    return df.select([c for c in columns if c in df.columns])


def align_schema(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """``df`` in the layout ``schema`` and nothing else. What cannot be read as the type wanted, and what ``df`` does not
    have at all, is null."""
    given = df.schema

    def fitted(field: T.StructField) -> Column:
        if field.name in given.names:
            return lenient_cast(F.col(field.name), given[field.name].dataType, field.dataType)
        return F.lit(None).cast(field.dataType)

    if unknown := sorted(set(schema.names).difference(given.names)):
        log.warning("%s has no %s: null throughout", name, ", ".join(unknown))
    return df.select(*(fitted(field).alias(field.name) for field in schema))


def cast_strict(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` that exist, in its order; a value that does not fit fails the job."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns])


def require_columns(df: DataFrame, columns: Iterable[str], name: str = "input") -> None:
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        raise ValueError(f"{name}: missing required columns {absent}")


def require_schema(df: DataFrame, schema: T.StructType, name: str = "input") -> None:
    """Fail unless ``df`` has every field of ``schema`` under its type; it may have others."""
    fields = {(field.name, field.dataType.simpleString()) for field in df.schema}
    needed = {(field.name, field.dataType.simpleString()) for field in schema}
    if needed - fields:
        found = dict(fields)
        faults = [f"{c} is {found.get(c, 'absent')} instead of {kind}" for c, kind in sorted(needed - fields)]
        raise ValueError(f"{name} has the wrong layout: {'; '.join(faults)}")
