"""Candle files: CSV with a fixed schema, many series per directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.calendar import series_name
from barloom.functions.cleaning import nan_to_null
from barloom.schema import CANDLE_COLUMNS, CANDLE_SCHEMA, PERIOD_SECONDS, SERIES

_STEM = r"regexp_extract({path}, '([^/]+?)([.][^./]*)?$', 1)"


def read_candle_csv(
    spark: SparkSession,
    path: str,
    catalog: DataFrame | None = None,
    product_id: str | None = None,
    granularity: str | None = None,
) -> DataFrame:
    """Candle CSV with header; cells that do not fit the schema become null.

    The series is taken from ``product_id=.../granularity=...`` folders if there
    are any, or named by the caller, or found for each file by matching its name
    with the storage names of the catalog's series.
    """
    bars = nan_to_null(spark.read.schema(CANDLE_SCHEMA).option("header", True).csv(path))
    if set(SERIES) <= set(bars.columns):
        keys = {name: F.col(name).cast("string") for name in SERIES}
        return bars.withColumns(keys).select(*SERIES, *CANDLE_COLUMNS)
    if catalog is None:
        if product_id is None or granularity is None:
            raise ValueError("name the series, or give a catalog to find it by file name")
        keys = {"product_id": F.lit(product_id), "granularity": F.lit(granularity)}
        return bars.withColumns(keys).select(*SERIES, *CANDLE_COLUMNS)
    names = catalog.select(*SERIES, F.lower(series_name()).alias("_name")).distinct()
    stem = F.expr(f"lower({_STEM.format(path='_metadata.file_path')}) AS _name")
    found = bars.select(*CANDLE_COLUMNS, stem)
    files = list_files(spark, path).selectExpr(f"lower({_STEM.format(path='path')}) AS _name").distinct()
    counts = files.join(names, "_name", "left").groupBy("_name").agg(F.count("product_id").alias("_n"))
    _require_series(counts)
    return found.join(names, "_name").select(*SERIES, *CANDLE_COLUMNS)


def _require_series(counts: DataFrame) -> None:
    """Fails for files (``_name``) whose name fits no series or several (``_n``)."""
    n, name = counts.filter("_n <> 1").agg(F.count(F.lit(1)), F.min("_name")).first()
    if n:
        raise ValueError(f"{n} candle files fit no series or several by their name, such as {name}")


def read_candle_files(
    spark: SparkSession, path: str, product_id: str | None = None, granularity: str | None = None
) -> DataFrame:
    """Candle CSV of every series there is: by folders, or by the names of the files.

    A file name is a storage name, perhaps with more after an underscore. A
    single file whose name is none belongs to the series given, if one is. Files
    that fit no series are an error.
    """
    bars = spark.read.schema(CANDLE_SCHEMA).option("header", True).csv(path)
    if set(SERIES) <= set(bars.columns):
        return read_candle_csv(spark, path)
    grains = "|".join(name.lower() for name in PERIOD_SECONDS)
    parts = rf"'^(.+?)_({grains})(?:_.*)?$'"
    stem = f"lower({_STEM.format(path='{0}')})"
    told = f"{stem} rlike {parts}"
    files = list_files(spark, path).filter("not name rlike '^[_.]'")
    count, unnamed = files.agg(
        F.count(F.lit(1)), F.coalesce(F.expr(f"count_if(not {told.format('path')})"), F.lit(0))
    ).first()
    if unnamed and count == 1 and product_id is not None and granularity is not None:
        return read_candle_csv(spark, path, product_id=product_id, granularity=granularity)
    if unnamed:
        raise ValueError(f"the names of {unnamed} of {count} candle files tell no series")
    own = _STEM.format(path="_metadata.file_path")
    return nan_to_null(bars).select(
        F.expr(f"replace(regexp_extract({own}, '(?i)' || {parts}, 1), '_', '-') AS product_id"),
        F.expr(f"upper(regexp_extract({own}, '(?i)' || {parts}, 2)) AS granularity"),
        *CANDLE_COLUMNS,
    )


def csv_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The records of candle CSV with a cell that does not fit, as they stand in the files.

    ``failed`` names the columns that the scan makes null for it; ``file``, ``record``, and the
    series if folders tell it. A record with too few or too many cells has the column ``cells``
    among them. An empty cell is missing, not unfit. One pass over the files.
    """
    corrupt = "_record"
    schema = T.StructType([*CANDLE_SCHEMA.fields, T.StructField(corrupt, T.StringType())])
    options = {"header": True, "columnNameOfCorruptRecord": corrupt, "mode": "PERMISSIVE"}
    bars = spark.read.schema(schema).options(**options).csv(path)
    series = [F.col(name).cast("string").alias(name) for name in SERIES if name in bars.columns]
    text = T.StructType([T.StructField(name, T.StringType()) for name in CANDLE_COLUMNS])
    cells = F.from_csv(corrupt, text.simpleString()[len("struct<") : -1].replace(":", " "))
    # The reader looks for unfit cells only in the columns that are asked for, so all are.
    every = F.xxhash64(*CANDLE_COLUMNS) >= F.lit(-(1 << 63))
    rows = bars.filter(F.col(corrupt).isNotNull() & every)
    found = rows.select(
        *series,
        F.col("_metadata.file_path").alias("file"),
        F.col(corrupt).alias("record"),
        cells.alias("_cell"),
        *[F.col(name).alias(f"_{name}") for name in CANDLE_COLUMNS],
    )
    unfit = [
        F.when((F.col(f"_cell.{name}") != "") & F.col(f"_{name}").isNull(), F.lit(name))
        for name in CANDLE_COLUMNS
    ]
    named = F.array_compact(F.array(*unfit))
    failed = F.when(F.size(named) > 0, named).otherwise(F.array(F.lit("cells")))
    kept = [name for name in SERIES if name in bars.columns]
    return found.select(*kept, "file", "record", "_cell.start", failed.alias("failed"))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """How many records failed in each column, per series if it is known."""
    keys = [name for name in SERIES if name in rejects.columns]
    each = rejects.select(*keys, F.explode("failed").alias("column"))
    return each.groupBy(*keys, "column").agg(F.count(F.lit(1)).alias("records"))


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """``path`` and ``name`` of every file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(directory)
        .selectExpr("path", "element_at(split(path, '/'), -1) AS name")
    )


def latest_files(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """For every series the file whose name starts with its storage name and sorts last.

    Every prefix of a file name is looked up with an equi-join: names are short,
    catalogs can be long.
    """
    prefixes = files.selectExpr(
        "path", "name", "explode(sequence(1, length(name))) AS _n"
    ).selectExpr("path", "name", "substring(name, 1, _n) AS _name")
    names = catalog.select(*SERIES, series_name().alias("_name"))
    return (
        names.join(prefixes, "_name")
        .groupBy(*SERIES)
        .agg(F.max_by("path", "name").alias("path"), F.max("name").alias("name"))
    )
