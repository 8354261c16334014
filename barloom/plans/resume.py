"""Features of a top-up from stored state, without the history.

The state of a feature table is small: the last bars of each series that the
indicators look back on, and a row of sums per series. A top-up reads it and the new
bars, appends their features, and puts the new state in its place. The state is
replaced last, so a run that fails can simply be done again: rows that it has
already written are left out then.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.chunks import PLACED, State
from barloom.operators.indicators import standard_indicators, state_after
from barloom.plans.features import feature_table
from barloom.schema import KEYS, SERIES
from barloom.sinks.tables import PARTITIONS, beside, put_in_place, save_partitioned

log = logging.getLogger(__name__)


def feature_state(bars: DataFrame, before: State | None = None) -> State:
    """The state of the feature table after ``bars``, which follow ``before`` if given."""
    return state_after(bars, *standard_indicators(), before=before)


def save_state(state: State, path: str) -> None:
    """Replace the state at ``path``; it is written beside and renamed when whole."""
    spark = state.sums.sparkSession
    staged = beside(path)
    state.tail.write.parquet(f"{staged}/tail")
    state.sums.write.parquet(f"{staged}/sums")
    put_in_place(spark, staged, path)


def load_state(spark: SparkSession, path: str) -> State | None:
    """The stored state, or None if there is none yet."""
    try:
        return State(spark.read.parquet(f"{path}/tail"), spark.read.parquet(f"{path}/sums"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def after_state(bars: DataFrame, state: State | None) -> tuple[DataFrame, DataFrame]:
    """(bars that go on after the state, those that come too late).

    A bar is late if it is not after the last one of its series in the state: it is stored already,
    or it fills a gap, which changes what follows and needs a whole run. Bars without a key
    are in neither.
    """
    placed = bars.filter(PLACED)
    if state is None:
        return placed, placed.limit(0)
    until = state.sums.select(*SERIES, "_until")
    known = placed.join(until, [*SERIES], "left")
    late = F.coalesce(F.col("start") <= F.col("_until"), F.lit(False))
    return known.filter(~late).drop("_until"), known.filter(late).drop("_until")


def top_up_features(
    spark: SparkSession,
    bars: DataFrame,
    state_path: str,
    features_path: str,
    by: Sequence[str] = PARTITIONS,
) -> dict[str, int]:
    """Append the features of new bars and move the state on; (added, late) counts of bars.

    The first call makes the state. Keys of ``bars`` are unique. Of the stored features only
    keys from the first new start on are read, to leave out what a failed run has written. Late
    bars get no features; they are counted and warned of.
    """
    state = load_state(spark, state_path)
    fresh, late = after_state(bars, state)
    fresh = fresh.persist()
    try:
        first, n = fresh.agg(F.min("start"), F.count("*")).first()
        n_late = late.count()
        if n_late:
            log.warning("%d bars are not after the last one of their series and get no features", n_late)
        if first is None:
            return {"added": 0, "late": n_late}
        made = feature_table(fresh, before=state)
        save_partitioned(_unwritten(spark, made, features_path, first), features_path, by=by, mode="append")
        save_state(feature_state(fresh, state), state_path)
        return {"added": n, "late": n_late}
    finally:
        fresh.unpersist()


def _unwritten(spark: SparkSession, made: DataFrame, path: str, first: int) -> DataFrame:
    """The rows whose keys are not at ``path`` yet."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return made
    stored = stored.filter(F.col("start") >= first)
    if "year" in stored.columns:
        stored = stored.filter(F.col("year") >= datetime.fromtimestamp(first, timezone.utc).year)
    return made.join(stored.select(*KEYS), [*KEYS], "left_anti")
