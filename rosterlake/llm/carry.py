"""Columns computed from whole texts in Arrow batches, with other columns carried along whatever their names."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rosterlake.llm.words import passes


def computed(
    docs: DataFrame,
    compute: Callable[[pa.RecordBatch], Sequence[pa.Array]],
    fields: str,
    *,
    carry: Sequence[str] | None = None,
    given: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row of ``docs`` ``row``, a struct of the columns ``carry`` (all, if not given), and ``fields``.

    ``compute`` gets some MB of rows at a time, ``text`` and the columns ``given``, and returns an array for each field.
    The text goes to Python once, and comes back only if it is carried.
    """
    carry = list(docs.columns if carry is None else carry)
    rest, with_text = [c for c in carry if c != "text"], "text" in carry
    given = given or {}
    inputs = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in rest) if rest else [F.lit(None).cast("int").alias("none")]).alias("rest"),
        F.col("text").alias("text"),
        *(c.alias(name) for name, c in given.items()),
    )
    kept = ["rest", "text"] if with_text else ["rest"]
    new = docs.sparkSession.createDataFrame([], fields).schema.fields
    schema = StructType([*(inputs.schema[c] for c in kept), *(StructField(f.name, f.dataType) for f in new)])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                yield pa.RecordBatch.from_arrays([*map(part.column, kept), *compute(part)], names)

    row = F.struct(*((F.col("text") if c == "text" else F.col("rest").getField(c)).alias(c) for c in carry))
    return inputs.mapInArrow(run, schema).select(row.alias("row"), *(f.name for f in new))
