"""Run all stages: ``spark-submit --py-files ... -m rosterlake`` or ``python -m rosterlake LANDING OUT``."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from rosterlake import fixed_values as fv
from rosterlake.operators.shape import align_schema
from rosterlake.plans import full_run
from rosterlake.session import HUGE_METHOD
from rosterlake.sinks import tables as sinks

log = logging.getLogger("rosterlake")


def main(arguments: Sequence[str] | None = None) -> dict[str, DataFrame]:
    parser = argparse.ArgumentParser(prog="rosterlake", description="Recruiting exports to analytical tables.")
    parser.add_argument("landing", help="folder with the report drops")
    parser.add_argument("out", help="folder of the tables")
    add = parser.add_argument
    add("--historical", help="folder with the headcount drops, if it is another")
    add("--as-of", type=date.fromisoformat, default=date.today(), help="reference date, today if left out")
    add("--scope-years", type=int, default=fv.REQUISITION_SCOPE_YEARS, help="years of requisitions before the feed's")
    add("--one-per-key", action="store_true", help="one update per position, so that no master row is multiplied")
    add("--first-master", help="parquet table of master hires to begin with; only for a first run")
    args = parser.parse_args(arguments)

    builder = SparkSession.builder.appName("rosterlake").config("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)
    spark = builder.getOrCreate()
    master = f"{args.out}/{full_run.MASTER}"
    if args.first_master:
        if sinks.current_version(spark, master):
            parser.error(f"{master} exists already")
        first = align_schema(spark.read.parquet(args.first_master), fv.MASTER_HIRES, "first master")
        sinks.replace_table(first, master)
    reports = full_run.read_reports(spark, args.landing, args.historical)
    tables = full_run.run(spark, reports, args.out, args.as_of, args.scope_years, one_per_key=args.one_per_key)
    log.info("published %s under %s", ", ".join(tables), args.out)
    return tables


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
