"""Roll-up of the analyses and the recommendations drawn from it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent, ratio, rounded
from ..functions.text import contains_any
from . import stages
from .actors import whole_days
from .facts import ALL
from .ordering import CREATE
from .skew import LARGE_GROUP_ROWS

# Fields that are signals when more than half of the cases have them.
SIGNAL_FIELDS = (
    "stepname", "statuscode", "statecode", "msdyn_forecastcategory",
    "ownerid", "estimatedclosedate", "the000g_revenuetype",
)
# Words and coverage limit for noise candidates.
NOISE_WORDS = ("discount", "base", "currency", "exchange", "price", "total")
NOISE_BELOW_PCT = 30
# Fields and words of the recommended buckets.
STRATEGY_FIELDS = {
    "L1_STAGE": ("stepname", "statecode", "statuscode", "msdyn_forecastcategory"),
    "L3_ADMIN": (
        "ownerid", "owningbusinessunit", "customerid", "estimatedclosedate",
        "actualclosedate", "closeprobability", "new_contractterm", "pricelevelid",
    ),
}
STRATEGY_WORDS = (
    "proposal", "develop", "qualify", "identify", "complete", "review", "decision",
)
# Shares in per cent above which a recommendation changes.
FILTER_ABOVE_PCT = 20
PREFIX_ABOVE_PCT = 90
# What a recommendation says if its condition holds, and if not.
RECOMMENDED = {
    "timestamp_handler": ("dual_format_required", "single_format"),
    "case_filtering": ("filter_2plus_events_recommended", "keep_all_cases"),
    "sequence_tiebreaker": ("prefix_primary_with_timestamp_fallback", "timestamp_only"),
}


def overview(
    timed: DataFrame,
    events: DataFrame,
    *,
    create: str = CREATE,
    limit: int = LARGE_GROUP_ROWS,
) -> DataFrame:
    """One row with the headline numbers.

    timed: all rows, ts null where it could not be read; events: those with ts.
    One read, melted to cases, actors and fields, gives all counts; another one the
    steps back.
    """
    valid = F.col("ts").isNotNull()
    step = valid & (F.col("field") == "stepname")
    prefixed = step & F.regexp_extract("new_value", r"^(\d+)-", 1).try_cast("bigint").isNotNull()
    flags = {
        "rows": valid, "creates": valid & (F.col("operation") == create), "steps": step, "prefixed": prefixed,
    }
    kinds = {"case": F.col("case_id"), "actor": F.when(valid, F.col("actor")), "field": F.when(valid, F.col("field"))}
    melted = timed.select(
        "ts", *[F.coalesce(flag, F.lit(False)).cast("int").alias(name) for name, flag in flags.items()],
        F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("value")) for k, c in kinds.items()])),
    )
    counted = melted.groupBy("kind", "value").agg(
        F.count("*").alias("read"), F.min("ts").alias("first"), F.max("ts").alias("last"),
        *[F.sum(name).alias(name) for name in flags],
    )
    case = F.col("kind") == "case"
    single = case & (F.col("rows") == 1)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(case, F.col(name))), F.lit(0).cast("bigint"))

    def distinct(kind: str) -> Column:
        return F.count_if((F.col("kind") == kind) & F.col("value").isNotNull())

    heads = counted.agg(
        total("rows").alias("total_events"),
        F.count_if(case & (F.col("rows") > 0)).alias("total_cases"),
        F.count_if(single).alias("single_event_cases"),
        F.count_if(single & (F.col("creates") == 1)).alias("single_event_creations"),
        F.min("first").alias("min_timestamp"),
        F.max("last").alias("max_timestamp"),
        (total("read") - total("rows")).alias("rows_dropped_invalid"),
        percent(total("prefixed"), total("steps")).alias("_prefix"),
        F.struct(distinct("actor").alias("total_actors"), distinct("field").alias("total_fields")).alias("_kinds"),
    )
    steps = stages.violation_summary(stages.stage_violations(events, limit, timed)).select(F.struct("*"))
    return headline(heads.withColumn("_steps", steps.scalar()))


def overview_of(
    values: Callable[[str], DataFrame], steps: DataFrame, violations: DataFrame, singles: DataFrame,
    parsed: DataFrame, create: str = CREATE,
) -> DataFrame:
    """``overview`` from facts.

    values: the facts of a subject; steps: the rows of the stage field; violations,
    singles: the steps back and the single-event rows; parsed: ``timestamp_summary``.
    """
    cases = values("cases")
    heads = cases.where(F.col("kind") == ALL).agg(
        F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("total_events"),
        F.count("*").alias("total_cases"),
        F.count_if(F.col("rows") == 1).alias("single_event_cases"),
        F.min("first").alias("min_timestamp"),
        F.max("last").alias("max_timestamp"),
    )
    totals = stages.stepname_totals(steps)
    creations = singles.agg(F.count_if(F.col("operation") == create))

    def keys(subject: str) -> Column:
        return values(subject).where(F.col("kind") == "operation").agg(F.countDistinct("key")).scalar()

    return headline(heads.withColumns({
        "single_event_creations": creations.scalar(),
        "rows_dropped_invalid": parsed.select("rows_dropped_invalid").scalar(),
        "_prefix": totals.select("prefix_coverage_pct").scalar(),
        "_kinds": F.struct(keys("actors").alias("total_actors"), keys("fields").alias("total_fields")),
        "_steps": stages.violation_summary(violations).select(F.struct("*")).scalar(),
    }))


def headline(one: DataFrame) -> DataFrame:
    """The row of ``overview`` with what follows from its counts."""
    kept, dropped = F.col("total_events"), F.col("rows_dropped_invalid")
    singles, created = F.col("single_event_cases"), F.col("single_event_creations")
    days = whole_days("min_timestamp", "max_timestamp")
    return one.select(
        "total_events", "total_cases", "single_event_cases", "single_event_creations",
        "_kinds.total_actors", "_kinds.total_fields",
        F.coalesce(days, F.lit(0).cast("bigint")).alias("timespan_days"),
        "min_timestamp", "max_timestamp", "rows_dropped_invalid",
        rounded((1 - ratio(dropped, dropped + kept)) * 100).alias("parse_success_rate"),
        F.coalesce("_prefix", F.lit(0.0)).alias("prefix_coverage"),
        "_steps.violation_count", F.col("_steps.cases_affected").alias("violation_cases"),
        percent(singles, F.col("total_cases")).alias("single_event_pct"),
        (singles - created).alias("single_event_non_creations"),
    )


def noise_candidates(
    semantics: DataFrame,
    words: Sequence[str] = NOISE_WORDS,
    below_pct: float = NOISE_BELOW_PCT,
    among: int | None = None,
) -> DataFrame:
    """Fields that sound like noise and are rare by case; with ``among`` only of so many frequent ones."""
    frequent = _first(semantics, among, F.desc("occurrence_count"), "field")
    noisy = contains_any(F.col("field"), words) & (F.col("percentage_of_cases") < below_pct)
    return frequent.where(noisy).select("field", "occurrence_count", "percentage_of_cases")


def high_signal_fields(
    coverage: DataFrame, signals: Sequence[str] = SIGNAL_FIELDS
) -> DataFrame:
    """Known signal fields that more than half of the cases have."""
    wide = coverage.where(F.col("band") == "fields_above_50pct")
    return wide.where(F.col("field").isin(*signals)).select("field", "case_pct")


def recommendations(overview: DataFrame) -> DataFrame:
    """Pipeline settings that follow from the headline numbers, as (setting, value)."""
    share = ratio(F.col("single_event_cases"), F.col("total_cases")) * 100
    conditions = {
        "timestamp_handler": F.col("rows_dropped_invalid") > 0,
        "case_filtering": share > FILTER_ABOVE_PCT,
        "sequence_tiebreaker": F.col("prefix_coverage") > PREFIX_ABOVE_PCT,
    }
    row = overview.select(*[
        F.when(holds, RECOMMENDED[name][0]).otherwise(RECOMMENDED[name][1]).alias(name)
        for name, holds in conditions.items()
    ])
    return row.unpivot([], list(conditions), "setting", "value")


def _first(rows: DataFrame, n: int | None, *order: Column | str) -> DataFrame:
    """The first n rows, or all."""
    return rows if n is None else rows.orderBy(*order).limit(n)


def bucket_strategy(
    coverage: DataFrame,
    noise: DataFrame,
    named: Mapping[str, Sequence[str]] = STRATEGY_FIELDS,
    milestones_among: int | None = None,
    noise_fields: int | None = None,
) -> DataFrame:
    """Recommended fields per bucket: fixed lists, milestones by words, noise candidates.

    milestones_among, noise_fields: look at the first fields only, by name and by rows.
    """
    middle = coverage.where(F.col("band") == "fields_25_to_50pct")
    milestones = _first(middle, milestones_among, "field").where(
        contains_any(F.col("field"), STRATEGY_WORDS)
    )
    kills = _first(noise, noise_fields, F.desc("occurrence_count"), "field")
    fixed = [
        F.struct(F.lit(bucket).alias("bucket"), F.lit(name).alias("field"))
        for bucket, names in named.items()
        for name in names
    ]
    spark = coverage.sparkSession
    return (
        spark.range(1)
        .select(F.inline(F.array(*fixed)))
        .unionByName(milestones.select(F.lit("L2_MILESTONE").alias("bucket"), "field"))
        .unionByName(kills.select(F.lit("KILL_NOISE").alias("bucket"), "field"))
    )
