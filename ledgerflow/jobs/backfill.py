"""Catch-up backfill of the intervals of a weekday schedule.

The scheduled original runs ``0 9 * * 1-5`` with catch-up from a start date,
one interval at a time. Here the intervals are a generated table; the ones
without recorded output are computed in one distributed job: every event is
assigned arithmetically to the interval that contains it (no range join),
joined with the missing intervals (a table bounded by the calendar, not by the
data) and aggregated. Output partitions are written per interval with
dynamic overwrite, so re-running a failed backfill rewrites only its own
intervals; the finished intervals are then appended to the done table.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalars import money_sum
from ledgerflow.operators.incremental import missing_intervals, schedule_starts
from ledgerflow.operators.relational import where_between
from ledgerflow.sources.tables import read_or_empty

DONE_SCHEMA = T.StructType([T.StructField("run_date", T.DateType())])


def interval_of(ts: Column, hour: int = 9) -> Column:
    """``run_date`` of the weekday interval ``[d hour:00, next weekday hour:00)`` containing ``ts``.

    Shift by the start hour, take the date, and move Saturday/Sunday back to
    Friday (whose interval runs until Monday).
    """
    d = F.to_date(ts - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(hour)))
    wd = F.weekday(d)  # 0 = Monday
    return F.when(wd == 5, F.date_sub(d, 1)).when(wd == 6, F.date_sub(d, 2)).otherwise(d)


def interval_totals(events: DataFrame, ts_col: str = "ts", value_col: str = "value", hour: int = 9) -> DataFrame:
    """Events and value per schedule interval (partial aggregation before the shuffle)."""
    return (
        events.where(F.col(ts_col).isNotNull())
        .select(interval_of(F.col(ts_col), hour).alias("run_date"), F.col(value_col))
        .groupBy("run_date")
        .agg(F.count(F.lit(1)).alias("n_events"), money_sum(value_col).alias("total_value"))
    )


def run(
    spark: SparkSession,
    events: DataFrame,
    out_root: str,
    start: dt.date,
    end: dt.date,
    hour: int = 9,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Backfill every missing interval between ``start`` and ``end``; returns them.

    As a schedule runs an interval only after it has ended, intervals that end
    after ``as_of`` (default: now, UTC) are left for a later call.
    """
    done_path = os.path.join(out_root, "done_intervals")
    out_path = os.path.join(out_root, "interval_totals")
    schedule = schedule_starts(spark, start, end, hour)
    done = read_or_empty(spark, done_path, DONE_SCHEMA)
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    schedule = schedule.where(F.col("interval_end") <= F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"))
    todo = missing_intervals(schedule, done).select("run_date", "interval_start", "interval_end")
    todo = todo.checkpoint(eager=True)  # bounded by the calendar; fixes the set for both writes
    bounds = todo.agg(F.min("interval_start").alias("lo"), F.max("interval_end").alias("hi")).first()
    if bounds["lo"] is None:  # nothing is missing: the events are not read
        return todo
    # The missing intervals' time range reaches the scan as a pushed filter.
    events = where_between(events, "ts", bounds["lo"].isoformat(sep=" "), bounds["hi"].isoformat(sep=" "))
    totals = interval_totals(events, hour=hour).join(F.broadcast(todo.select("run_date")), "run_date", "inner")
    (
        totals.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(out_path)
    )
    todo.select("run_date").write.mode("append").parquet(done_path)
    return todo
