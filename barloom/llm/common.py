"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Texts turned into Python strings at once.
SLICE = 256


def by_text(make: Callable[[list[str | None]], pa.Array], kind: str):
    """A column function of a text: make(texts) gives an array of as many values of a SQL type.

    A batch of rows is worked through in slices, so that a worker holds few texts
    as Python strings.
    """

    def batches(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            starts = range(0, max(len(texts), 1), SLICE)
            yield pa.concat_arrays([make(texts.slice(at, SLICE).to_pylist()) for at in starts])

    return F.arrow_udf(batches, kind)


def with_small_batches(spark: SparkSession) -> None:
    """Lets Python receive 1,000 rows at once instead of Spark's 10,000, unless the session says otherwise.

    A row is a whole text here, and both sides hold a batch in memory.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results: the session's spark.checkpoint.dir.

    Only a local session that names none gets one of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", "") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="barloom-"))
        folder = context.getCheckpointDir()
    return folder


def settled(frame: DataFrame) -> DataFrame:
    """The frame, computed once and read from the shared checkpoint folder."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def inner(frame: DataFrame, name: str) -> str:
    """The name, with underscores before it until the frame has no such column."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Scratch:
    """Written tables in the shared folder, which can go as soon as nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
        self.places: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, frame: DataFrame) -> DataFrame:
        """The frame, computed once and read from its table."""
        place = f"{self.root}/{len(self.places)}"
        frame.write.parquet(place)
        read = self.spark.read.schema(frame.schema).parquet(place)
        self.places[id(read)] = (read, place)
        return read

    def drop(self, *frames: DataFrame) -> None:
        """Deletes tables that keep() gave. What was made of them must have been kept before."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for frame in frames:
            target = path(self.places[id(frame)][1])
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def spread(column: Column, kind: str) -> Column:
    """A hash of a key in [0, 1), to draw a sample that depends on nothing else.

    A null key counts as a key of its own.
    """
    mixed = F.xxhash64(F.lit(kind), column.cast("string"))
    return F.shiftrightunsigned(mixed, 11) / F.lit(float(1 << 53))


def sampled(frame: DataFrame, key: str, rows: int, kind: str) -> DataFrame:
    """About `rows` rows chosen by a hash of their key (all, if there are fewer)."""
    total = frame.count()
    if total <= rows:
        return frame
    return frame.where(spread(F.col(key), kind) < rows / total)
