"""Writing bars and features, and checking what was written."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.calendar import calendar_columns
from barloom.schema import KEYS, SERIES, TABLE_SCHEMA

log = logging.getLogger(__name__)

FORMATS = ("parquet", "csv")
# A month of the finest bars is half a megabyte, a year makes a reasonable file.
PARTITIONS = ("product_id", "granularity", "year")


def checked_format(name: str) -> str:
    """The format's name in lower case; only Parquet and CSV are written."""
    if name.lower() not in FORMATS:
        raise ValueError(f"cannot write {name!r}: the formats are {', '.join(FORMATS)}")
    return name.lower()


def save(df: DataFrame, path: str, output_format: str = "parquet") -> None:
    """Overwrite ``path`` with an unpartitioned dataset."""
    writer = df.write.mode("overwrite")
    if checked_format(output_format) == "parquet":
        writer.option("compression", "snappy").parquet(path)
    else:
        writer.option("header", True).csv(path)


def with_partition_columns(df: DataFrame, by: Sequence[str] = PARTITIONS) -> DataFrame:
    """Add the calendar columns the layout needs and the frame lacks."""
    calendar = calendar_columns()
    return df.withColumns(
        {name: calendar[name] for name in by if name in calendar and name not in df.columns}
    )


def save_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = PARTITIONS,
    mode: str = "overwrite",
    whole: bool = False,
    seen: Observation | None = None,
) -> None:
    """Write a partitioned Parquet table.

    ``overwrite`` replaces the partitions present in ``df``, or with ``whole``
    everything at ``path``. ``seen`` observes the number of ``rows`` as they are written.

    The rebalance hint lets Spark size the files from what the shuffle measured:
    small partitions share a task and a huge one is split over several. Rows are
    sorted inside files, so a reader can skip row groups by product and time.
    With many products leave ``product_id`` out of ``by``: the sort still prunes.
    """
    laid = with_partition_columns(df, by).hint("rebalance", *by)
    if seen is not None:
        laid = laid.observe(seen, F.count(F.lit(1)).alias("rows"))
    (
        laid.sortWithinPartitions(*by, *[name for name in KEYS if name not in by])
        .write.mode(mode)
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("compression", "snappy")
        .partitionBy(*by)
        .parquet(path)
    )


def candle_table(
    spark: SparkSession,
    path: str,
    first: int | None = None,
    last: int | None = None,
    like: DataFrame | None = None,
) -> DataFrame | None:
    """The stored bars, or None while there is no table yet.

    With ``first`` and ``last`` (bar starts) only that stretch is read: folders
    of other years and row groups of other times are skipped. With ``like`` only
    folders of the series and years that it has are read.
    """
    try:
        table = spark.read.schema(TABLE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if first is not None and last is not None:
        if "year" in table.columns:
            years = (_utc_year(first), _utc_year(last))
            table = table.filter(F.col("year").between(*years))
            if like is not None and set(PARTITIONS) <= set(table.columns):
                folders = with_partition_columns(like).select(*PARTITIONS).distinct()
                table = table.join(folders, list(PARTITIONS), "left_semi")
        table = table.filter(F.col("start").between(first, last))
    return table.select(*TABLE_SCHEMA.names)


def stored_folders(spark: SparkSession, path: str) -> DataFrame | None:
    """(series, year, folder) of every folder of a table with the default layout; None while there is no table.

    From the listing of its files: none is opened. Folder names are read as text.
    """
    try:
        files = spark.read.format("binaryFile").load(path).select("path")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # Folders have %XX for what a path cannot hold; a plus sign stands for itself.
    name = "url_decode(replace(regexp_extract(path, '/{0}=([^/]*)/', 1), '+', '%2B')) AS {0}"
    year = "try_cast(regexp_extract(path, '/year=([^/]*)/', 1) as int) AS year"
    folder = "regexp_extract(path, '^(.*/year=[^/]*)/', 1) AS folder"
    return files.selectExpr(*[name.format(column) for column in SERIES], year, folder).distinct()


def newest_starts(spark: SparkSession, path: str) -> DataFrame | None:
    """Last bar start of every stored series, from the folders of its newest year alone.

    As ``start`` decides the year, the last bar lies there. The driver gets a path per series, of
    the folders that its file index lists anyway, and only these are read. A table that is not laid out
    by series and year is read as a whole.
    """
    folders = stored_folders(spark, path)
    if folders is None:
        return None
    table = spark.read.schema(TABLE_SCHEMA).parquet(path)
    if not set(PARTITIONS) <= set(table.columns):
        return table.groupBy(*SERIES).agg(F.max("start").alias("last_start"))
    newest = folders.filter("year is not null").groupBy(*SERIES).agg(F.max_by("folder", "year").alias("folder"))
    paths = [row["folder"] for row in newest.select("folder").collect()]
    table = spark.read.schema(TABLE_SCHEMA).option("basePath", path).parquet(*paths) if paths else table.limit(0)
    return table.groupBy(*SERIES).agg(F.max("start").alias("last_start"))


def _utc_year(epoch: int) -> int:
    return (datetime(1970, 1, 1) + timedelta(seconds=epoch)).year


def rewrite_partitions(
    spark: SparkSession,
    table: DataFrame,
    path: str,
    staging: str,
    by: Sequence[str] = PARTITIONS,
) -> None:
    """Replace the partitions of ``path`` that ``table`` has, even if it reads ``path``.

    Spark cannot overwrite what it is reading, so the rows are first written to
    ``staging`` (an empty folder on shared storage) and moved over from there.
    """
    whole = with_partition_columns(table, by)
    save_partitioned(whole, staging, by)
    # Declared types: folder names like 007 would be read as numbers.
    save_partitioned(spark.read.schema(whole.schema).parquet(staging), path, by)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and a row count that is filled in when it is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _digest(df: DataFrame) -> list:
    """Rows, and the sum and the exclusive or of their hashes: the same in any order of rows and columns."""
    row = F.xxhash64(*[F.col(f"`{name}`") for name in sorted(df.columns)])
    total = F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
    return [F.count(F.lit(1)).alias("rows"), total.alias("total"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("mix")]


def content_digest(df: DataFrame) -> dict:
    """What two frames with the same rows have in common, whatever the order."""
    return df.agg(*_digest(df)).first().asDict()


def digested(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and its digest, filled in by the job that writes it."""
    seen = Observation()
    return df.observe(seen, *_digest(df)), seen


def _found(spark: SparkSession, path: str, output_format: str, columns: list[str]) -> dict:
    """The digest of what is stored; of a CSV file, whose cells have lost their types, the row count."""
    stored = read_back(spark, path, output_format)
    if checked_format(output_format) == "csv":
        return {"rows": stored.count()}
    return content_digest(stored.select(*[F.col(f"`{name}`") for name in columns]))


def same_content(spark: SparkSession, source: str, target: str, output_format: str = "parquet") -> bool:
    """Whether two stored datasets have the same rows (CSV: as many)."""
    columns = read_back(spark, source, output_format).columns
    try:
        copy = read_back(spark, target, output_format)
    except AnalysisException:
        return False
    if sorted(copy.columns) != sorted(columns):
        return False
    one, other = (_found(spark, path, output_format, columns) for path in (source, target))
    return one == other


def folder_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a dataset, outermost first, from the path of one of its files."""
    row = spark.read.format("binaryFile").load(path).select("path").first()
    return re.findall(r"/([^/=]+)=[^/]*(?=/)", row["path"][len(path.rstrip("/")) :]) if row else []


def read_back(spark: SparkSession, path: str, output_format: str = "parquet") -> DataFrame:
    """A dataset as it was written; names of products and granularities stay text."""
    if checked_format(output_format) == "csv":
        return spark.read.option("header", True).csv(path)
    found = spark.read.parquet(path)
    text = [T.StructField(f.name, T.StringType()) if f.name in SERIES else f for f in found.schema]
    return spark.read.schema(T.StructType(text)).parquet(path)


def save_verified(
    df: DataFrame, path: str, output_format: str = "parquet", partitioned: bool = False
) -> int:
    """Save, then compare what is stored with the rows that were written, value by value but for CSV."""
    whole = with_partition_columns(df) if partitioned else df
    frame, seen = digested(whole)
    if partitioned:
        save_partitioned(frame, path, whole=True)
    else:
        save(frame, path, output_format)
    written = seen.get
    stored = _found(df.sparkSession, path, output_format, whole.columns)
    if stored["rows"] != written["rows"]:
        raise ValueError(f"{path}: wrote {written['rows']} rows, found {stored['rows']}")
    if any(stored[name] != written[name] for name in stored):
        raise ValueError(f"{path}: the {written['rows']} rows found are not those that were written")
    return written["rows"]


def publish(spark: SparkSession, source: str, target: str, output_format: str = "parquet") -> bool:
    """Copy a dataset with its folders to another location (any file system Spark can write).

    A failing copy raises. A target that is missing, short or (Parquet) has other values
    afterwards is reported and answered with False.
    """
    data = read_back(spark, source, output_format)
    frame, seen = digested(data)
    folders = [name for name in folder_columns(spark, source) if name in data.columns]
    if folders:
        save_partitioned(frame, target, folders, whole=True)
    else:
        save(frame, target, output_format)
    try:
        found = _found(spark, target, output_format, data.columns)
    except AnalysisException:
        found = {"rows": -1}
    copied = seen.get
    if any(found[name] != copied[name] for name in found):
        log.warning("%s: %d rows were copied, %d found, or with other values", target, copied["rows"], found["rows"])
        return False
    return True


def beside(path: str) -> str:
    """A new place on the same storage."""
    return f"{path.rstrip('/')}-{uuid.uuid4().hex}"


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """Make a checked dataset the one at ``path``; an older one goes only when the new one stands."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, target, old = (hadoop(x) for x in (staged, path.rstrip("/"), beside(path)))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    replaced = files.exists(target)
    if replaced and not files.rename(target, old):
        raise OSError(f"{path} cannot be moved aside")
    if not files.rename(new, target):
        if replaced:
            files.rename(old, target)
        raise OSError(f"{staged} cannot be moved to {path}")
    if replaced:
        files.delete(old, True)
