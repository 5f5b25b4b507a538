"""Rule tables: which field belongs where and how its changes are named.

All rules are data. The defaults below can be replaced by tables of your own
with the same columns; they are joined without hints, so Spark broadcasts them
while they stay below its broadcast threshold and shuffles them beyond it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields by bucket.
BUCKET_FIELDS = {
    "L1_STAGE": (
        "estimatedclosedate", "msdyn_forecastcategory", "statuscode", "statecode",
        "stepname", "processid", "salesstagecode", "actualclosedate", "salesstage",
        "closeprobability", "the000g_purchaseorderstatus",
    ),
    "L2_MILESTONE": (
        "the000g_revenuetype", "completefinalproposal", "developproposal",
        "adx_readyfordistribution", "completeinternalreview",
        "identifycustomercontacts", "identifypursuitteam", "msdyn_ordertype",
        "new_oppotunitytype", "presentfinalproposal", "presentproposal",
        "adx_feedbackyet", "adx_partnercollaboration", "adx_partnercreated",
        "captureproposalfeedback", "confirminterest", "decisionmaker",
        "evaluatefit", "filedebrief", "identifycompetitors", "li_isinfluenced",
        "msdyn_gdproptout", "new_evaluatefit2", "opportunityratingcode",
        "pursuitdecision", "resolvefeedback", "the000g__revenuetype",
        "purchasetimeframe", "purchaseprocess", "new_contracttermmonths",
        "new_contractterm",
    ),
    "L3_ADMIN": (
        "ownerid", "owningbusinessunit", "the000g_isrenewal", "customerid",
        "parentaccountid", "participatesinworkflow", "prioritycode",
        "sendthankyounote", "parentcontactid",
    ),
    "KILL_NOISE": (
        "finaldecisiondate", "originatingleadid", "pricelevelid", "exchangerate",
        "pricingerrorcode", "skippricecalculation", "totaldiscountamount",
        "totaldiscountamount_base", "totallineitemdiscountamount",
        "totallineitemdiscountamount_base", "transactioncurrencyid",
        "isrevenuesystemcalculated",
    ),
}
# The level of each bucket and the levels that are exported.
BUCKET_LEVELS = {
    "L1_STAGE": "L1",
    "L2_MILESTONE": "L2",
    "L3_ADMIN": "L3",
    "KILL_NOISE": "KILL",
}
UNKNOWN = "UNKNOWN"
EXPORT_LEVELS = ("L1", "L2", "L3")
# Milestone flags, named "<field> completed".
MILESTONE_FLAGS = (
    "developproposal", "completefinalproposal", "completeinternalreview",
    "identifycustomercontacts", "identifypursuitteam", "presentfinalproposal",
    "presentproposal", "confirminterest", "decisionmaker", "evaluatefit",
    "filedebrief", "pursuitdecision", "captureproposalfeedback",
    "resolvefeedback", "identifycompetitors",
)
# Activities with a name of their own.
FIXED_LABELS = {"ownerid": "Owner changed"}
# Labels of option codes.
CODE_LABELS = {
    "statecode": {"0": "Open", "1": "Won", "2": "Lost"},
    "statuscode": {
        "1": "In Progress", "2": "On Hold", "3": "Won", "4": "Canceled",
        "5": "Out-Sold",
    },
}
# Fields dropped before classification (exact spelling).
KILL_FIELDS = BUCKET_FIELDS["KILL_NOISE"]

# How an activity is named.
SHOW_VALUE, COMPLETED, CHANGED = "value", "completed", "changed"


@dataclass(frozen=True)
class Rules:
    """The rule tables of one installation.

    buckets: field (lower case), bucket, level, style, label
    codes:   field (lower case), code, label
    unique:  whether the keys (field; field and code) are known to occur once. If not, the
             first rule of a key counts, by ``rule_order`` where a table has that column.
    """

    buckets: DataFrame
    codes: DataFrame
    kill_fields: Sequence[str] = KILL_FIELDS
    unique: bool = False

    def table(self, name: str, keys: Sequence[str]) -> DataFrame:
        """A rule table with one row per key: a doubled rule must not double events."""
        rules = getattr(self, name)
        return rules if self.unique else first_rules(rules, keys)


def rule_table(
    spark: SparkSession, columns: Sequence[str], keys: int, rows: Iterable[Sequence]
) -> DataFrame:
    """A local table of strings whose first ``keys`` columns must be unique."""
    rows = [tuple(row) for row in rows]
    names = [row[:keys] for row in rows]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"rule keys occur twice: {twice}")
    fields = pa.schema([(name, pa.string()) for name in columns])
    data = [dict(zip(columns, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(data, schema=fields))


def first_rules(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first rule of each key, by ``rule_order`` or else as the rows come."""
    order = F.col("rule_order") if "rule_order" in table.columns else F.monotonically_increasing_id()
    rest = [c for c in table.columns if c not in keys]
    first = table.withColumn("_order", order).groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct("_order", *rest)).alias("_rule"))
    return first.select(*keys, "_rule.*")


def bucket_rules(
    spark: SparkSession,
    fields: Mapping[str, Sequence[str]] = BUCKET_FIELDS,
    levels: Mapping[str, str] = BUCKET_LEVELS,
    milestone_flags: Sequence[str] = MILESTONE_FLAGS,
    labels: Mapping[str, str] = FIXED_LABELS,
) -> DataFrame:
    """Bucket rules from lists of field names; a field's first bucket counts."""

    def style(bucket: str, field: str) -> str:
        if bucket == "L2_MILESTONE" and field in milestone_flags:
            return COMPLETED
        return CHANGED if bucket == "L3_ADMIN" else SHOW_VALUE

    first = {}
    for bucket, names in fields.items():
        for name in names:
            first.setdefault(name.lower(), bucket)
    return rule_table(
        spark, ("field", "bucket", "level", "style", "label"), 1,
        (
            (name, bucket, levels[bucket], style(bucket, name), labels.get(name))
            for name, bucket in first.items()
        ),
    )


def code_rules(
    spark: SparkSession, labels: Mapping[str, Mapping[str, str]] = CODE_LABELS
) -> DataFrame:
    """Code rules from nested dicts: field, code, label."""
    return rule_table(
        spark, ("field", "code", "label"), 2,
        (
            (field.lower(), code, label)
            for field, codes in labels.items()
            for code, label in codes.items()
        ),
    )


def default_rules(spark: SparkSession) -> Rules:
    return Rules(bucket_rules(spark), code_rules(spark), unique=True)


def classified(events: DataFrame, rules: Rules) -> DataFrame:
    """Add bucket and level (UNKNOWN where no rule fits) plus the naming style."""
    table = rules.table("buckets", ["field"]).select(
        F.col("field").alias("_field"), "bucket", "level",
        F.col("style").alias("_style"), F.col("label").alias("_label"),
    )
    return (
        events.join(table, F.lower("field") == F.col("_field"), "left")
        .drop("_field")
        .withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in ("bucket", "level")})
    )


def bucketed(events: DataFrame, rules: Rules) -> DataFrame:
    """Add bucket and level only."""
    return classified(events, rules).drop("_style", "_label")


def translated(events: DataFrame, rules: Rules) -> DataFrame:
    """Add translated_value: the code's label, or the new value unchanged."""
    table = rules.table("codes", ["field", "code"]).select(
        F.col("field").alias("_field"), F.col("code").alias("_code"),
        F.col("label").alias("_text"),
    )
    match = (F.lower("field") == F.col("_field")) & (F.col("new_value") == F.col("_code"))
    return (
        events.join(table, match, "left")
        .withColumn("translated_value", F.coalesce("_text", "new_value"))
        .drop("_field", "_code", "_text")
    )


def sequenced(events: DataFrame, field: str = "stepname") -> DataFrame:
    """Add sequence: the number before the first hyphen of a stage value."""
    number = F.regexp_extract("new_value", r"^(\d+)-", 1).try_cast("bigint")
    return events.withColumn("sequence", F.when(F.lower("field") == field, number))


def activity_name() -> Column:
    """Name of an event from its naming style, field and translated value."""
    return (
        F.when(F.col("_label").isNotNull(), F.col("_label"))
        .when(F.col("_style") == COMPLETED, F.concat("field", F.lit(" completed")))
        .when(F.col("_style") == CHANGED, F.concat("field", F.lit(" changed")))
        .otherwise(
            F.concat(
                F.coalesce("field", F.lit("")), F.lit(" → "),
                F.coalesce("translated_value", F.lit("")),
            )
        )
    )


def named(events: DataFrame, rules: Rules) -> DataFrame:
    """Add bucket, level, translated_value, sequence and activity_name."""
    events = sequenced(translated(classified(events, rules), rules))
    return events.withColumn("activity_name", activity_name()).drop("_style", "_label")


def without_kill_fields(
    events: DataFrame, rules: Rules, *, case_insensitive: bool = False
) -> DataFrame:
    """Drop noise fields. Spelling counts by default, unlike in classification."""
    if not rules.kill_fields:
        return events
    field = F.coalesce("field", F.lit(""))
    if case_insensitive:
        return events.where(~F.lower(field).isin([f.lower() for f in rules.kill_fields]))
    return events.where(~field.isin(list(rules.kill_fields)))
