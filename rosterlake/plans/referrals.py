"""Referrals: prospects and the referred part of the stage funnel, one row per referral."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from rosterlake import fixed_values as fv
from rosterlake.functions.dates import as_date, year_month
from rosterlake.functions.keys import composite_id
from rosterlake.functions.text import name_without_id
from rosterlake.operators.dedupe import distinct_flag, keep_one
from rosterlake.operators.shape import align_schema, select_rename

REFERRER_COLUMNS = ["referred_by_employee_id", "referred_by"]

# Where a row comes from; of several rows of one referral the highest origin holds.
FUNNEL, PROSPECT, REVIEW = 0, 1, 2
ORIGIN_NAMES = {FUNNEL: "funnel", PROSPECT: "prospect", REVIEW: "review"}

_RANKED = T.StructType(fv.REFERRALS.fields + fv.layout(stage_number="short").fields)


def read_prospects(report: DataFrame) -> DataFrame:
    """Prospect report under column names, with its date parsed, at the stage before the first."""
    named = select_rename(report, fv.PROSPECT_NAMES)
    if "added_date" in named.columns:
        named = named.withColumn("added_date", as_date(named, "added_date"))
    return named.withColumn("last_stage_number", F.lit(fv.PROSPECT_STAGE).cast("short"))


def referred_only(df: DataFrame) -> DataFrame:
    """Rows whose source names a referral, by the exports' own loose pattern."""
    return df.where(F.col("source").rlike(fv.REFERRAL_SOURCE))


def normalise(df: DataFrame, schema: T.StructType = fv.REFERRALS) -> DataFrame:
    """Referral layout, referrer's name without the id, key columns empty instead of null."""
    keys = ("job_requisition_id", "referred_by_employee_id", "candidate_id")
    return align_schema(df, schema, "referrals").withColumns(
        {"referred_by": name_without_id(F.col("referred_by")), **{k: F.coalesce(k, F.lit("")) for k in keys}}
    )


def referral_rows(prospects: DataFrame, funnel: DataFrame) -> DataFrame:
    """All rows a referral can be taken from, with ``origin``.

    Funnel rows stand for themselves; those that ended in review stand a second time among the prospects.
    The second copy is an explode, so the funnel is read once. Prospects and review copies are put at the
    prospect stage.
    """

    def taken(origin: int, stage) -> F.Column:
        return F.struct(F.lit(origin).alias("origin"), stage.cast("short").alias("last_stage_number"))

    own_stage, prospect_stage = F.col("last_stage_number"), F.lit(fv.PROSPECT_STAGE)
    in_funnel = F.array(taken(FUNNEL, own_stage))
    in_review = F.array(taken(FUNNEL, own_stage), taken(REVIEW, prospect_stage))
    from_funnel = F.when(own_stage == fv.REVIEW_STAGE, in_review).otherwise(in_funnel)
    from_prospects = F.array(taken(PROSPECT, prospect_stage))

    columns = [c for c in _RANKED.names if c != "last_stage_number"]
    prospects = prospects.withColumn("stage_number", F.lit(None).cast("short"))
    parts = [
        normalise(df, _RANKED).withColumn("__taken", F.explode(takes)).select(*columns, "__taken.*")
        for df, takes in ((funnel, from_funnel), (prospects, from_prospects))
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def referral_funnel(prospects: DataFrame, funnel: DataFrame) -> DataFrame:
    """One row per requisition, referrer and candidate, from prospect to ready for hire.

    Review copies hold over prospects and those over funnel rows; within the funnel the furthest stage
    holds. Rows without any id share one key; the reduction before the shuffle keeps that harmless.
    """
    keyed = referral_rows(prospects, funnel).withColumns(
        {
            "erp_id": composite_id("job_requisition_id", "referred_by_employee_id", "candidate_id"),
            "headcount_id": composite_id("referred_by_employee_id", year_month(F.col("added_date"))),
        }
    )
    chosen = keep_one(keyed, ["erp_id"], ["origin", "stage_number"])
    return chosen.select(*fv.REFERRALS.names, "erp_id", "headcount_id")


def unique_referrals(referrals: DataFrame) -> DataFrame:
    """Each referrer and month once, flagged, for the headcount."""
    return distinct_flag(referrals, "headcount_id", "has_referral")


def referral_counts(prospects: DataFrame, funnel: DataFrame) -> DataFrame:
    """Rows by origin, before one is chosen per referral."""
    names = F.create_map(*[F.lit(x) for pair in ORIGIN_NAMES.items() for x in pair])
    counts = referral_rows(prospects, funnel).groupBy("origin").agg(F.count(F.lit(1)).alias("referral_rows"))
    return counts.select(names[F.col("origin")].alias("origin"), "referral_rows")
