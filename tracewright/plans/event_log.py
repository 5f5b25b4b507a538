"""Audit log to event log: ordered, named, deduplicated events per case."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.timestamps import PIPELINE_FORMATS, utc_parser
from ..operators import classify, events as ev, ordering
from ..operators.classify import EXPORT_LEVELS, Rules
from ..operators.skew import LARGE_GROUP_ROWS, by_group_size, positions
from ..sources.audit import audit_rows, event_sources


def timed_events(
    audit: DataFrame, *, formats: Sequence[str] = PIPELINE_FORMATS, timezone: str = "UTC"
) -> DataFrame:
    """Audit rows with a readable time and a clean case id."""
    return ev.with_case_ids(ev.valid_time(audit, utc_parser(formats, timezone)))


def named_events(
    rows: DataFrame, rules: Rules, *, create: str = ordering.CREATE, large: bool = False
) -> DataFrame:
    """Rows of multi-event cases without noise fields, classified and named."""
    rows = ordering.with_create_flag(rows, create)
    kept = ev.multi_event(rows, large=large, order=ordering.CREATE_ORDER)
    return classify.named(classify.without_kill_fields(kept, rules), rules)


def by_case_size(
    audit: DataFrame, build: Callable[[DataFrame, bool], DataFrame], limit: int,
    loaded: Callable[[DataFrame], DataFrame] = lambda rows: rows, **parsing: Sequence[str] | str,
) -> DataFrame:
    """Run the steps on the timed rows of ordinary and of large cases.

    Cases are told apart before their times are read, so each row is parsed once.
    loaded: what to do with the rows before that.
    """
    rows = ev.with_case_ids(audit)

    def parsed(part: DataFrame, large: bool) -> DataFrame:
        return build(timed_events(loaded(part.drop("case_id")), **parsing), large)

    return by_group_size(rows, ["case_id"], parsed, limit)


def event_log(
    audit: DataFrame,
    rules: Rules,
    *,
    formats: Sequence[str] = PIPELINE_FORMATS,
    timezone: str = "UTC",
    limit: int = LARGE_GROUP_ROWS,
) -> DataFrame:
    """The cleaned event log of all levels; event_pos is the place in the case.

    Ordinary cases are shuffled once, by case, and every step runs on that one
    partitioning. Cases above ``limit`` rows take a second branch of the same plan in
    which each step reduces its rows before they are shuffled by a finer key.

    The single-event filter looks at the rows before noise fields, create rows
    and duplicates go; a case may therefore end with one event or none.
    """

    def build(rows: DataFrame, large: bool) -> DataFrame:
        named = named_events(rows, rules, large=large)
        log = ordering.deduplicated(ordering.collapse_creates(named, large=large))
        order = [*ordering.order_keys().values()]
        return positions(log, ["case_id"], order, "event_pos", large=large).drop("is_create")

    return by_case_size(audit, build, limit, formats=formats, timezone=timezone)


class StepMetrics:
    """Counts that a job makes on its way, by ``DataFrame.observe``.

    They cost no read and no job of their own. Rows that Spark computes again after a
    lost executor may count again; ``step_counts`` gives the exact figures then.
    """

    def __init__(self) -> None:
        self._parts: list[tuple[tuple[str, ...], Observation]] = []

    def on(self, rows: DataFrame, **counts: Column) -> DataFrame:
        """Count the rows that pass here."""
        part = Observation()
        self._parts.append((tuple(counts), part))
        return rows.observe(part, *[count.alias(name) for name, count in counts.items()])

    def get(self) -> dict[str, int]:
        """The sums over all places, once the job has run."""
        found: dict[str, int] = {}
        for names, part in self._parts:
            try:
                counts = part.get
            except Py4JJavaError:
                # Spark has dropped a branch that no row reaches, and its counts with it.
                counts = dict.fromkeys(names, 0)
            for name, count in counts.items():
                found[name] = found.get(name, 0) + (count or 0)
        return found


def cleaned_rows(
    audit: DataFrame, rules: Rules, *, limit: int = LARGE_GROUP_ROWS, metrics: StepMetrics | None = None,
    **parsing: Sequence[str] | str,
) -> DataFrame:
    """The event log and, marked as ``removed``, the rows of single-event cases, from one read and one shuffle.

    A removed row is named like the others and has the place 1. ``removed`` is the
    last column; the rest are those of ``event_log``.
    """
    metrics = metrics or StepMetrics()
    stays = ~F.col("removed")

    def build(rows: DataFrame, large: bool) -> DataFrame:
        rows = metrics.on(ordering.with_create_flag(rows), rows_with_time=F.count(F.lit(1)))
        sized = ev.case_sized(rows, large=large, order=ordering.CREATE_ORDER).withColumnRenamed("single", "removed")
        sized = metrics.on(sized, cases_removed=F.count_if("removed"), rows_multi_event=F.count_if(stays))
        noise = F.coalesce("field", F.lit("")).isin(list(rules.kill_fields))
        kept = sized.where(F.col("removed") | ~noise) if rules.kill_fields else sized
        named = metrics.on(
            classify.named(kept, rules),
            rows_without_noise=F.count_if(stays), rows_with_sequence=F.count_if(stays & F.col("sequence").isNotNull()))
        collapsed = metrics.on(
            ordering.collapse_creates(named, large=large), rows_creates_collapsed=F.count_if(stays))
        log = metrics.on(ordering.deduplicated(collapsed), rows_deduplicated=F.count_if(stays))
        order = [*ordering.order_keys().values()]
        return positions(log, ["case_id"], order, "event_pos", large=large).drop("is_create")

    def loaded(rows: DataFrame) -> DataFrame:
        return metrics.on(rows, rows_loaded=F.count(F.lit(1)))

    found = by_case_size(audit, build, limit, loaded, **parsing)
    return found.select(*[c for c in found.columns if c != "removed"], "removed")


def clean(
    audit: DataFrame, rules: Rules, path: str, *, limit: int = LARGE_GROUP_ROWS, **parsing: Sequence[str] | str
) -> dict[str, int]:
    """Write ``cleaned_rows`` as Parquet by removed and level, and return the step counts of that very job.

    The input is read and parsed once for the log, the removed cases and the counts.
    ``cleaned_log`` and ``removed_cases`` read the two halves.
    """
    metrics = StepMetrics()
    rows = cleaned_rows(audit, rules, limit=limit, metrics=metrics, **parsing)
    rows.write.mode("overwrite").partitionBy("removed", "level").parquet(path)
    return metrics.get()


def cleaned_log(spark: SparkSession, path: str) -> DataFrame:
    """The event log that ``clean`` wrote."""
    return spark.read.parquet(path).where(F.col("removed") == "false").drop("removed")


def removed_cases(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the single-event cases that ``clean`` wrote, with the columns of the audit log."""
    made = ("removed", "level", "bucket", "translated_value", "sequence", "activity_name", "event_pos")
    return spark.read.parquet(path).where(F.col("removed") == "true").drop(*made)


def event_log_of(sources: Mapping[str, DataFrame], rules: Rules, **options) -> DataFrame:
    """The event log of a set of named sources, of which the audit log is used.

    The sources are checked by ``event_sources``; the audit log may be raw, with its
    own headers, or already have the canonical columns.
    """
    audit = event_sources(sources)
    return event_log(audit if "case_key" in audit.columns else audit_rows(audit), rules, **options)


def exported_events(
    audit: DataFrame, rules: Rules, *, limit: int = LARGE_GROUP_ROWS, **options
) -> DataFrame:
    """The events of the exported levels with their place in the level's trace, the last one marked (is_last)."""

    def build(rows: DataFrame, large: bool) -> DataFrame:
        named = named_events(rows, rules, large=large)
        log = ordering.deduplicated(ordering.collapse_creates(named, large=large))
        return positions(
            log.where(F.col("level").isin(*EXPORT_LEVELS)),
            ["case_id", "level"],
            [*ordering.order_keys().values()],
            "event_pos",
            large=large,
            last="is_last",
        )

    return by_case_size(audit, build, limit, **options)


def step_counts(
    audit: DataFrame, rules: Rules, *, limit: int = LARGE_GROUP_ROWS, **options
) -> DataFrame:
    """Rows after each step plus the step metrics, as (step, rows).

    All counts up to the create aggregation follow from one row per case, which
    is one aggregation with map-side partial sums.
    """
    parsed = ev.with_case_ids(ev.with_time(audit, utc_parser(**options)))
    parsed = classify.sequenced(parsed)
    noise = F.coalesce(F.col("field").isin(list(rules.kill_fields)), F.lit(False))
    create = F.col("operation").eqNullSafe(F.lit(ordering.CREATE))
    valid = F.col("ts").isNotNull()
    cases = parsed.groupBy("case_id").agg(
        F.count("*").alias("loaded"),
        F.count_if(valid).alias("valid"),
        F.count_if(valid & ~noise).alias("kept"),
        F.count_if(valid & ~noise & create).alias("creates"),
        F.count_if(valid & ~noise & F.col("sequence").isNotNull()).alias("sequences"),
    )
    multi = F.col("valid") >= 2

    def total(rows: Column | str, condition: Column | None = None) -> Column:
        counted = F.col(rows) if isinstance(rows, str) else rows
        if condition is not None:
            counted = F.when(condition, counted)
        return F.coalesce(F.sum(counted), F.lit(0)).cast("bigint")

    collapsed = F.col("kept") - F.col("creates") + F.least("creates", F.lit(1))
    early = cases.agg(
        total("loaded").alias("rows_loaded"),
        total("valid").alias("rows_with_time"),
        F.count_if(F.col("valid") == 1).alias("cases_removed"),
        total("valid", multi).alias("rows_multi_event"),
        total("kept", multi).alias("rows_without_noise"),
        total("sequences", multi).alias("rows_with_sequence"),
        total(collapsed, multi).alias("rows_creates_collapsed"),
    )
    # The names of all events before creates collapse, and the finished log.

    def named(rows: DataFrame, large: bool) -> DataFrame:
        return named_events(rows, rules, large=large)

    names = by_case_size(audit, named, limit, **options)
    middle = names.agg(F.countDistinct("activity_name").alias("distinct_activities"))
    log = event_log(audit, rules, limit=limit, **options)
    late = log.agg(F.count("*").alias("rows_deduplicated"))
    parts = [part.unpivot([], part.columns, "step", "rows") for part in (early, middle, late)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
