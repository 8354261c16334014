"""The feature job: scan, check, compute, check, write."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.quality import (
    observed,
    quality_report,
    report_totals,
    require_same_count,
    warn_of_findings,
)
from barloom.plans.features import feature_table
from barloom.sinks.tables import beside, candle_table, checked_format, put_in_place, save_verified
from barloom.sources.candles import read_candle_files

log = logging.getLogger(__name__)


INPUT_FORMATS = ("parquet", "csv")


def load_bars(
    spark: SparkSession,
    input_path: str,
    products: Sequence[str] | None = None,
    granularities: Sequence[str] | None = None,
    input_format: str = "parquet",
) -> DataFrame:
    """A stored candle table, or candle CSV files, held to the products and granularities named.

    The series of a CSV come from its folders or from the names of its files. A
    single file whose name tells none is that of the one product and granularity
    given.
    """
    if input_format not in INPUT_FORMATS:
        raise ValueError(f"cannot read {input_format!r}: the formats are {', '.join(INPUT_FORMATS)}")
    if input_format == "parquet":
        bars = candle_table(spark, input_path)
        if bars is None:
            raise ValueError(f"there is no table at {input_path}")
    else:
        one = [names[0] if names and len(names) == 1 else None for names in (products, granularities)]
        bars = read_candle_files(spark, input_path, *one)
    if products:
        bars = bars.filter(F.col("product_id").isin(*products))
    if granularities:
        bars = bars.filter(F.col("granularity").isin(*granularities))
    return bars


def process(
    bars: DataFrame, output_path: str, output_format: str = "parquet", partitioned: bool = True
) -> int:
    """Put the feature table of ``bars`` at ``output_path``; returns its row count.

    Two passes: the input report, and the write, which counts rows and null cells
    as they pass. It goes to a place beside the output and takes over only when
    all rows are there, so a failing run leaves an earlier result as it was.
    """
    spark = bars.sparkSession
    checked_format(output_format)
    before = report_totals(quality_report(bars, "INPUT"))
    warn_of_findings(before, "INPUT")
    staged = beside(output_path)
    frame, seen = observed(feature_table(bars))
    written = save_verified(
        frame, staged, output_format, partitioned and output_format == "parquet"
    )
    require_same_count(before["total"], written, "features")
    warn_of_findings(seen.get, "PROCESSED")
    put_in_place(spark, staged, output_path)
    return written


def run_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    products: Sequence[str] | None = None,
    granularities: Sequence[str] | None = None,
    output_format: str = "parquet",
    partitioned: bool = True,
    input_format: str = "parquet",
) -> int:
    """Features of every series found at ``input_path``."""
    bars = load_bars(spark, input_path, products, granularities, input_format)
    return process(bars, output_path, output_format, partitioned)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Compute indicator features of price bars")
    parser.add_argument("--product_id", action="append", help="may be repeated; default all")
    parser.add_argument("--granularity", action="append", help="may be repeated; default all")
    parser.add_argument("--input_path", required=True)
    parser.add_argument("--output_path", required=True)
    parser.add_argument("--input_format", default="parquet", choices=INPUT_FORMATS)
    parser.add_argument("--output_format", default="parquet")
    parser.add_argument("--unpartitioned", action="store_true")
    options = parser.parse_args(arguments)
    spark = (
        SparkSession.builder.appName("barloom-features")
        # The last stage has more generated classes than the default cache holds;
        # without room every task would compile them again.
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .getOrCreate()
    )
    try:
        rows = run_job(
            spark,
            options.input_path,
            options.output_path,
            options.product_id,
            options.granularity,
            options.output_format,
            not options.unpartitioned,
            options.input_format,
        )
        log.info("%d feature rows written to %s", rows, options.output_path)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
