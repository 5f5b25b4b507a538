"""Reading audit logs: one row = actor changed field of item from old to new value."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import trimmed

# Accepted headers per column role, in order of preference.
COLUMN_ALIASES = {
    "timestamp": ("Timestamp", "Date logged", "Date", "Logged At", "Created On"),
    "case_id": ("Anon Item ID", "Item ID", "Case ID", "CaseId"),
    "field": ("Field", "Field Name", "Attribute"),
    "previous_value": ("Previous value", "Old value", "Previous Value"),
    "new_value": ("New value", "New Value"),
    "operation": ("Operation", "Action", "Change Type"),
}
# Headers of the actor column, which only the analyses need.
ACTOR_ALIASES = ("Anon Actor",)
# Cells that count as null when a CSV is read.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan",
    "null",
)
# Kinds of source that carry events.
EVENT_KINDS = ("activity_table", "audit_log", "transaction_table")

# Canonical column of each role.
CANONICAL = {
    "case_id": "case_key",
    "operation": "operation",
    "field": "field",
    "previous_value": "old_value",
    "new_value": "new_value",
    "actor": "actor",
    "timestamp": "logged_at",
}


def clean_header(name: str) -> str:
    """A header without byte-order mark and surplus white space."""
    return re.sub(r"\s+", " ", name.replace("\ufeff", "")).strip()


def _likeness(header: str, alias: str) -> int:
    """2 for the alias itself, 1 if only case, blanks or punctuation differ, else 0."""
    if clean_header(header) == clean_header(alias):
        return 2
    letters = [re.findall("[a-z0-9]", text.lower()) for text in (header, alias)]
    return int(letters[0] == letters[1])


def _best(columns: Sequence[str], names: Sequence[str]) -> str | None:
    """The column of the first alias that any column resembles, the closest of them."""
    scores = [
        (-rank, _likeness(column, name), place, column)
        for rank, name in enumerate(names)
        for place, column in enumerate(columns)
    ]
    found = [score for score in scores if score[1]]
    return max(found)[-1] if found else None


def resolve_columns(
    columns: Sequence[str], aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES
) -> dict[str, str]:
    """Map each role to the column that plays it; works on the header alone.

    Earlier aliases come first; of the columns that resemble one, an exact header
    wins. A timestamp without an alias is the one header that speaks of a date and
    a log, if there is only one.
    """
    roles = {role: _best(columns, names) for role, names in aliases.items()}
    if roles.get("timestamp", "") is None:
        spoken = {clean_header(c).lower(): c for c in columns}
        dated = [c for text, c in spoken.items() if all(word in text for word in ("date", "log"))]
        roles["timestamp"] = dated[0] if len(dated) == 1 else None
    missing = [role for role, column in roles.items() if column is None]
    if missing:
        raise ValueError(f"no column found for {missing}; the table has {list(columns)}")
    return roles


def _cell(column: Column, nulls: str, null_words: Sequence[str]) -> Column:
    known = F.when(~column.isin(list(null_words)), column) if null_words else column
    text = trimmed(known)
    return F.coalesce(text, F.lit("")) if nulls == "empty" else text


def audit_rows(
    table: DataFrame,
    *,
    aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES,
    actor_aliases: Sequence[str] = ACTOR_ALIASES,
    nulls: str = "empty",
    null_words: Sequence[str] = NULL_WORDS,
    ingest_ord: Column | None = None,
) -> DataFrame:
    """Bring a raw table of strings to the canonical audit columns.

    nulls: ``"empty"`` turns null cells into empty strings; ``"keep"`` keeps
    them except in the old and new value.
    ingest_ord: the row's place in the input, by default a number given at the
    scan. Pass a column of your own if the table has an id.
    Other columns are carried along.
    """
    if nulls not in ("empty", "keep"):
        raise ValueError("nulls must be 'empty' or 'keep'")
    roles = resolve_columns(table.columns, aliases)
    headers = {clean_header(c): c for c in table.columns}
    actor = next((headers[a] for a in actor_aliases if a in headers), None)
    if actor is not None:
        roles["actor"] = actor
    targets = {column: CANONICAL[role] for role, column in roles.items()}
    order = F.monotonically_increasing_id() if ingest_ord is None else ingest_ord
    cells = [order.alias("ingest_ord")]
    for column, kind in table.dtypes:
        if column == "ingest_ord":
            continue
        target = targets.get(column, clean_header(column))
        cell = F.col("`" + column.replace("`", "``") + "`")
        if kind == "string":
            policy = "empty" if target in ("old_value", "new_value") else nulls
            cell = _cell(cell, policy, null_words)
        cells.append(cell.alias(target))
    if actor is None:
        cells.append(F.lit(None).cast("string").alias("actor"))
    return table.select(*cells)


def _headers(spark: SparkSession, paths: Sequence[str]) -> tuple[dict[str, list[str]], int]:
    """Files by their first line, and the size of the largest, found in one pass over the text."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    first = lines.where("block = 0").groupBy("file").agg(
        F.min_by("value", "row").alias("header"), F.first("size").alias("size"))
    found: dict[str, list[str]] = {}
    largest = 0
    # One row per file; Spark's own listing of the files is on the driver as well.
    for file, header, size in first.orderBy("file").toLocalIterator():
        found.setdefault(header.lstrip("\ufeff").rstrip("\r"), []).append(file)
        largest = max(largest, size)
    return found, largest


def _largest(spark: SparkSession, files: Sequence[str]) -> int:
    """Size of the largest file."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    places = (path(spark._jvm.java.net.URI(file)) for file in files)
    return max(p.getFileSystem(conf).getFileStatus(p).getLen() for p in places)


# Bits of a place number for the rows of 1 KiB, and those for a file when there are few files.
_ROW_BITS, _FILE_BITS = 20, 48


def file_ranks(spark: SparkSession, files: Sequence[str], largest: int | None = None) -> DataFrame:
    """(_file, _start): the place number at which each file starts, the files by name.

    A table to join with, so that any number of files will do; Spark broadcasts it if
    it is small. A block of n KiB leaves n << 20 numbers free, far more than a task,
    which is no larger, has rows. Up to 32768 files each has room for 2^28 KiB; with
    more of them the room follows from the largest file.
    """
    # Rows name local files with one slash, Spark's listing with three.
    files = sorted(re.sub("^file:/+", "file:/", file) for file in files)
    bits = _FILE_BITS
    if len(files) > 1 << (63 - bits):
        size = _largest(spark, files) if largest is None else largest
        bits = _ROW_BITS + max(1, (size >> 10).bit_length())
        if len(files) > 1 << (63 - bits):
            raise ValueError(f"{len(files)} files of up to {size} bytes have no common place numbers")
    table = pa.table({
        "_file": pa.array(files, pa.string()), "_start": pa.array((i << bits for i in range(len(files))), pa.int64())})
    return spark.createDataFrame(table)


def _placed(raw: DataFrame, ranks: DataFrame) -> DataFrame:
    """Add _place, the row's place among all files: file, block (in units of 1 KiB), row."""
    block = F.shiftright(F.col("_metadata.file_block_start"), 10)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    inside = F.shiftleft(block, _ROW_BITS) + row
    file = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
    lines = raw.withColumns({"_inside": inside, "_file": file})
    placed = lines.join(ranks, "_file").withColumn("_place", F.col("_start") + F.col("_inside"))
    return placed.select(*raw.columns, "_file", "_place")


# Name of the column that holds a line that could not be read.
BAD_LINE = "_bad_line"
BAD_LINES = ("fail", "drop", "keep")


def _scanned(
    spark: SparkSession, path: str | Sequence[str], multi_line: bool, headers: str
) -> list[DataFrame]:
    """The files by header: cells as strings, _bad_line, _file and _place."""
    if headers not in ("each", "same"):
        raise ValueError("headers must be 'each' or 'same'")
    paths = [path] if isinstance(path, str) else list(path)

    def table(names: Sequence[str]) -> DataFrame:
        reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
        reader = reader.option("enforceSchema", False)
        # Only the first line of a file is read for the names.
        schema = reader.csv(list(names)).schema
        # All cells must be read for a line to be known as broken.
        checked = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", BAD_LINE)
        return checked.schema(T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])).csv(list(names))

    if headers == "same":
        raws, largest = [table(paths)], None
        files = raws[0].inputFiles()
    else:
        groups, largest = _headers(spark, paths)
        raws = [table([unquote(file) for file in group]) for group in groups.values()]
        files = [file for group in groups.values() for file in group]
    if not raws or not files:
        raise ValueError(f"no rows in {paths}")
    ranks = file_ranks(spark, files, largest)
    return [_placed(raw, ranks) for raw in raws]


def _broken(raw: DataFrame) -> Column:
    """Whether a line could not be read. Spark wants a cell to be looked at besides."""
    cell = F.length(F.col("`" + raw.columns[0].replace("`", "``") + "`"))
    return F.col(BAD_LINE).isNotNull() & (cell.isNull() | (cell >= 0))


def read_audit_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    nulls: str = "empty",
    null_words: Sequence[str] = NULL_WORDS,
    multi_line: bool = False,
    headers: str = "each",
    bad_lines: str = "fail",
    **options: Mapping[str, Sequence[str]] | Sequence[str],
) -> DataFrame:
    """Scan audit-log CSV files, all columns as strings.

    headers: ``"each"`` lets files differ in their headers and resolves the roles for
    each of them, at the price of one more pass over the text. ``"same"`` reads the
    files once and fails if a header differs from the first.
    bad_lines: what happens to a line with more or fewer cells than its header, which
    is also what an open quote leads to. ``"fail"`` ends the job at the first one,
    ``"drop"`` leaves them to ``read_bad_lines``, ``"keep"`` fills up or cuts the row.
    Large files are split. Give ``multi_line=True`` if quoted cells hold line
    breaks; a file is then read by one task. ingest_ord is the row's place in the
    input, the files by name.
    """
    if bad_lines not in BAD_LINES:
        raise ValueError(f"bad_lines must be one of {BAD_LINES}")
    parts = []
    for raw in _scanned(spark, path, multi_line, headers):
        good = ~_broken(raw)
        if bad_lines == "fail":
            message = F.concat(F.lit("broken line in "), F.col("_file"), F.lit(": "), F.col(BAD_LINE))
            raw = raw.where(F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
        elif bad_lines == "drop":
            raw = raw.where(good)
        place = raw["_place"]
        rows = audit_rows(
            raw.drop(BAD_LINE, "_file"), nulls=nulls, null_words=null_words, ingest_ord=place, **options)
        parts.append(rows.drop("_place"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_bad_lines(
    spark: SparkSession, path: str | Sequence[str], *, multi_line: bool = False, headers: str = "each"
) -> DataFrame:
    """(file, ingest_ord, line): the lines that ``read_audit_csv`` calls broken, as they are."""
    parts = [
        raw.where(_broken(raw)).select(
            F.col("_file").alias("file"), F.col("_place").alias("ingest_ord"), F.col(BAD_LINE).alias("line"))
        for raw in _scanned(spark, path, multi_line, headers)
    ]
    return reduce(DataFrame.unionByName, parts)


def event_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Pick the audit log among the sources of an event log.

    No main case table is needed, but an audit log must be there and must show
    its case-id and timestamp columns.
    """
    unknown = [kind for kind in sources if kind not in (*EVENT_KINDS, "main_case_table")]
    if unknown:
        raise ValueError(f"unknown kinds of source: {unknown}")
    if not any(kind in EVENT_KINDS for kind in sources):
        raise ValueError(f"no event source given; one of {list(EVENT_KINDS)} is needed")
    if "audit_log" not in sources:
        raise ValueError("event logs are built from an audit_log")
    columns = sources["audit_log"].columns
    if not {"case_key", "logged_at"} <= set(columns):
        resolve_columns(columns, {role: COLUMN_ALIASES[role] for role in ("case_id", "timestamp")})
    return sources["audit_log"]
