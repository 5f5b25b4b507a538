"""An audit log derived from the ``events`` test table (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields by event type, picked by k.
_FIELDS = {
    "signup": ("statecode", "statuscode", "ownerid", "exchangerate", "stepname"),
    "click": ("stepname",),
    "view": (
        "statuscode", "statecode", "msdyn_forecastcategory", "estimatedclosedate", "actualclosedate",
    ),
    "purchase": ("developproposal", "the000g_revenuetype", "purchaseprocess"),
    "error": ("ownerid", "customerid", "exchangerate", "ExchangeRate", "zz_unmapped"),
}
_STAGES = ("14-Qualify", "15-Develop", "16-Propose", "17-Close", "Qualify", "")
# Ways to write the time, picked by the last digit of the event id.
_TIMES = (
    "DD/MM/YYYY HH:00", "YYYY/MM/DD HH:00:00", "DD/MM/YYYY hh:00:00 PP",
    "DD/MM/YYYY hh:00 PP", "DD/MM/YYYY HH:00:00", "MM/DD/YY HH:00",
    "YYYY-MM-DDTHH:00:00Z", "YYYY-MM-DDTHH:00:00+05:30", "YYYY-MM-DDTHH:00:00",
)
_NO_TIMES = ("", "null", "garbage", "31/02/2024 10:00")
_FORENSIC_TIMES = ("DD/MM/YYYY HH:00", "DD/MM/YY HH:00", "MM/DD/YY HH:00", "day/month/YY HH:00")


def _pick(place: Column, values: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), place)


def _field() -> Column:
    names = [name for fields in _FIELDS.values() for name in fields]
    place, start = None, 0
    for kind, fields in _FIELDS.items():
        here = start + F.col("k") % len(fields)
        match = F.col("event_type") == kind
        place = F.when(match, here) if place is None else place.when(match, here)
        start += len(fields)
    return _pick(place, tuple(names))


def _written(template: Column) -> Column:
    """Fill a template; the time is cut to six hours, which makes ties and duplicates."""
    slot = F.floor(F.hour("ts") / 6).cast("int")
    parts = {
        "YYYY": F.substring("date", 1, 4),
        "YY": F.substring("date", 3, 2),
        "MM": F.substring("date", 6, 2),
        "DD": F.substring("date", 9, 2),
        "day": F.substring("date", 9, 2).cast("int").cast("string"),
        "month": F.substring("date", 6, 2).cast("int").cast("string"),
        "HH": _pick(slot, ("00", "06", "12", "18")),
        "hh": _pick(slot, ("12", "06", "12", "06")),
        "PP": _pick(slot, ("AM", "AM", "PM", "PM")),
    }
    for name, value in parts.items():
        template = F.replace(template, F.lit(name), value)
    return template


def audit_log(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """One audit row per event; every column follows from the event alone.

    grain: ``"day"`` makes one case per user and day, ``"user"`` one per user.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("bigint"),
            "date": F.to_date("ts").cast("string"),
        }
    )
    k, signup = F.col("k"), F.col("event_type") == "signup"
    field = F.col("field")
    value = (
        F.when(field == "stepname", _pick(k % 6, _STAGES))
        .when(field == "statecode", (k % 4).cast("string"))
        .when(field == "statuscode", (k % 7).cast("string"))
        .otherwise(k.cast("string"))
    )
    former = F.when(field == "stepname", _pick((k + 1) % 3, _STAGES)).otherwise(
        (k % 5).cast("string")
    )
    form = F.col("event_id") % 10
    template = F.when(form < 9, _pick(form, _TIMES)).otherwise(_pick(k % 4, _NO_TIMES))
    case_key = F.concat(F.lit("ITEM-"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
    if grain == "day":
        case_key = F.concat(case_key, F.lit("-"), F.substring("date", 9, 2))
    return events.withColumn("field", _field()).select(
        F.col("event_id").alias("ingest_ord"),
        case_key.alias("case_key"),
        F.when(signup, "Create").otherwise("Update").alias("operation"),
        "field",
        F.when(~signup & (k % 3 > 0), former).alias("old_value"),
        value.alias("new_value"),
        F.concat(F.lit("ACTOR-000"), (k % 9).cast("string")).alias("actor"),
        _written(template).alias("logged_at"),
        _written(_pick(F.col("event_id") % 4, _FORENSIC_TIMES)).alias("logged_at_forensic"),
    )


# Files of the rendered log and what makes a line broken, by event id.
CSV_FILES, CUT_EVERY, LONG_EVERY, OPEN_EVERY = 6, 97, 89, 83
# Headers of even and of odd files.
CSV_HEADERS = (
    "Anon Item ID,Operation,Field,Previous value,New value,Anon Actor,Date logged,Event,Note",
    "Event,Timestamp,Old value,NEW VALUE,Field Name,Action,Item ID,Anon Actor,Note",
)


def audit_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, event_id, value): the log as lines of CSV files, some of them broken; event -1 is the header."""
    rows = audit_log(spark, sf_dir)
    text = {c: F.coalesce(c, F.lit("")) for c in rows.columns if c not in ("ingest_ord", "logged_at_forensic")}
    event = F.col("ingest_ord").cast("string")
    note = F.concat(F.lit('"a ""b"", '), event, F.lit('"'))
    names = ("case_key", "operation", "field", "old_value", "new_value", "actor", "logged_at")
    even = [*[text[c] for c in names], event, note]
    odd = [event, *[text[c] for c in ("logged_at", "old_value", "new_value", "field", "operation", "case_key", "actor")], note]
    line = F.when(F.col("file") % 2 == 0, F.concat_ws(",", *even)).otherwise(F.concat_ws(",", *odd))
    event_id = F.col("ingest_ord")
    broken = (
        F.when(event_id % CUT_EVERY == 0, F.concat_ws(",", text["case_key"], text["field"], event))
        .when(event_id % LONG_EVERY == 0, F.concat(line, F.lit(",surplus")))
        .when(event_id % OPEN_EVERY == 0, F.concat(F.lit('"open '), line))
        .otherwise(line)
    )
    lines = rows.withColumn("file", event_id % CSV_FILES).select(
        "file", event_id.alias("event_id"), broken.alias("value"))
    heads = spark.range(CSV_FILES).select(
        F.col("id").alias("file"), F.lit(-1).cast("bigint").alias("event_id"),
        F.when(F.col("id") % 2 == 0, CSV_HEADERS[0]).otherwise(CSV_HEADERS[1]).alias("value"))
    return lines.unionByName(heads)


def write_audit_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write the lines as files, one folder each, sorted by event behind the header."""
    lines = audit_csv_lines(spark, sf_dir).repartition("file").sortWithinPartitions("file", "event_id")
    lines.select("file", "value").write.partitionBy("file").text(path)
    return path
