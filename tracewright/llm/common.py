"""Helpers that the operators share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from weakref import WeakKeyDictionary

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# Rows that travel to a Python worker at once. Texts are large and their lengths differ.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Sets the session's Arrow batches to at most BATCH_ROWS rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only with a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="staged-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _new_place(spark: SparkSession, label: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}")
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def staged_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one. Its files go when the application ends."""
    place, files = _new_place(spark, label)
    files.mkdirs(place)
    files.deleteOnExit(place)
    return place.toString()


def staged(frame: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them from there.

    Cuts the lineage: a lost executor costs only the tasks it ran. The files go
    when the application ends. by: a column whose values get a folder each.
    """
    spark = frame.sparkSession
    place, files = _new_place(spark, label)
    (frame.write.partitionBy(by) if by else frame.write).parquet(place.toString())
    files.deleteOnExit(place)
    found = spark.read.schema(frame.schema).parquet(place.toString())
    _PLACES[found] = place
    return found


def staged_rows(frame: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``staged`` with the number of rows, counted while they are written.

    Rows that Spark computes again after a lost executor may count again.
    """
    seen = Observation()
    found = staged(frame.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    rows = seen.get.get("rows")
    return found, found.count() if rows is None else rows


# Where staged frames are, for ``discard``.
_PLACES: WeakKeyDictionary = WeakKeyDictionary()


def discard(frame: DataFrame) -> None:
    """Delete the files of a staged frame that nothing reads any more."""
    place = _PLACES.pop(frame, None)
    if place is not None:
        place.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def trim_memory() -> None:
    """Give memory that this process has freed back to the system, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def whole_text(column: Column | str) -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def partitions(spark: SparkSession, size: float, each: float) -> int:
    """Partitions so that each holds about ``each`` of ``size``, not fewer than the session's."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, int(-(-size // each)))


class WordHashes(dict):
    """64-bit hashes of words, computed once each; forgets all beyond a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value."""
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], dtype=np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head.tobytes(), *[a.tobytes() for a in arrays]]))


def unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, dtype=np.int64, count=len(kinds) + 1)[1:]
    ends = np.cumsum(sizes) + 8 * (len(kinds) + 1)
    return [np.frombuffer(raw, dtype=k, count=int(s) // np.dtype(k).itemsize, offset=int(e - s))
            for k, s, e in zip(kinds, sizes, ends)]
