"""Watermarks, late-data cutoff and catch-up intervals.

The job state (``job_name -> last_success_ts``) is a tiny table; the
watermark is read as one scalar on the driver (like the ``RETURNING`` value of
the original job) and becomes a literal in the scan filter, which Catalyst
pushes into the Parquet reader.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions import scalars as X
from ledgerflow.operators.merge import upsert

STATE_SCHEMA = T.StructType(
    [T.StructField("job_name", T.StringType()), T.StructField("last_success_ts", T.TimestampType())]
)


def state_frame(spark: SparkSession, job_name: str, ts, ts_type: str = "timestamp") -> DataFrame:
    """A one-row state table (or an empty one when ``ts`` is None).

    ``ts`` may be text (``'2024-01-20 00:00:00'``, offsets allowed) or a
    datetime; it is cast to ``ts_type`` in the session time zone.
    """
    if ts is None:
        return spark.createDataFrame([], STATE_SCHEMA)
    text = ts.isoformat(sep=" ") if isinstance(ts, (dt.datetime, dt.date)) else str(ts)
    return spark.range(1).select(
        F.lit(job_name).alias("job_name"), F.lit(text).cast(ts_type).alias("last_success_ts")
    )


def get_watermark(state: DataFrame, job_name: str) -> dt.datetime | None:
    """The stored watermark of a job; None on the first run."""
    row = state.where(F.col("job_name") == job_name).agg(F.max("last_success_ts").alias("wm")).first()
    return None if row is None else row["wm"]


def set_watermark(state: DataFrame, job_name: str, ts, monotonic: bool = False) -> DataFrame:
    """New state table with the job's watermark replaced (last write wins).

    The original job may move the watermark backwards; ``monotonic=True``
    keeps the greater of old and new instead.
    """
    spark = state.sparkSession
    new = spark.createDataFrame([(job_name, ts)], STATE_SCHEMA)
    if monotonic:
        old = state.where(F.col("job_name") == job_name).select(
            F.col("job_name"), F.col("last_success_ts").alias("_old")
        )
        new = new.join(old, "job_name", "left").select(
            "job_name", F.greatest("last_success_ts", "_old").alias("last_success_ts")
        )
    return upsert(state, new, ["job_name"])


def compute_cutoff(watermark, lookback_hours: int):
    """``watermark - lookback``; None stays None."""
    if watermark is None:
        return None
    return watermark - dt.timedelta(hours=lookback_hours)


def late_data_filter(df: DataFrame, ts_col: str, cutoff, ts_type: str = "timestamp") -> DataFrame:
    """Keep a row if there is no cutoff, its time is blank or does not
    parse (validation quarantines it later), or it is at/after the cutoff.

    ``ts_type`` is the type text times are parsed to (``timestamp`` for
    instants with offsets, ``timestamp_ntz`` for wall-clock times).
    """
    if cutoff is None:
        return df
    dtype = df.schema[ts_col].dataType
    if isinstance(dtype, T.StringType):
        ts = X.to_instant(ts_col, ts_type)
        target = T.TimestampNTZType() if ts_type == "timestamp_ntz" else T.TimestampType()
    else:
        ts = F.col(ts_col)
        target = dtype
    return df.where(ts.isNull() | (ts >= ts_literal(cutoff, target)))


def ts_literal(value, target: T.DataType) -> Column:
    """A timestamp literal of the target type.

    Python datetimes from ``collect`` are naive local times for ``TIMESTAMP``
    (PySpark converts with the local zone both ways) and plain wall-clock
    values for ``TIMESTAMP_NTZ``; text is cast in the session time zone.
    """
    if isinstance(value, dt.datetime):
        if isinstance(target, T.TimestampNTZType):
            return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast(target)
        return F.lit(value).cast(target)
    return F.lit(str(value)).cast(target)


def next_watermark(df: DataFrame, ts_col: str) -> DataFrame:
    """``max(ts)`` of the accepted rows (NULL when there are none)."""
    return df.agg(F.max(ts_col).alias("watermark"))


# --- I9: catch-up schedule ----------------------------------------------------------

def schedule_starts(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    hour: int = 9,
    weekdays_only: bool = True,
) -> DataFrame:
    """Start instants of a ``0 <hour> * * 1-5`` schedule between two dates (inclusive).

    Generated with ``sequence``; its size is bounded by the date range (one row
    per day), not by the data.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("run_date")
    )
    if weekdays_only:
        days = days.where(F.weekday("run_date") < 5)  # 0 = Monday
    return days.select(
        "run_date",
        F.make_timestamp_ntz(
            F.year("run_date"), F.month("run_date"), F.dayofmonth("run_date"), F.lit(hour), F.lit(0), F.lit(0)
        ).alias("interval_start"),
        _next_start(F.col("run_date"), hour, weekdays_only).alias("interval_end"),
    )


def _next_start(day: Column, hour: int, weekdays_only: bool) -> Column:
    step = F.when(F.weekday(day) == 4, F.lit(3)).when(F.weekday(day) == 5, F.lit(2)).otherwise(F.lit(1))
    nxt = F.date_add(day, step if weekdays_only else F.lit(1))
    return F.make_timestamp_ntz(F.year(nxt), F.month(nxt), F.dayofmonth(nxt), F.lit(hour), F.lit(0), F.lit(0))


def missing_intervals(schedule: DataFrame, done_days: DataFrame, day_col: str = "run_date") -> DataFrame:
    """Scheduled intervals with no finished work, oldest first.

    ``done_days`` is derived from the data (or from the run ledger); the anti
    join keeps the schedule rows without a partner.
    """
    return schedule.join(done_days.select(F.col(day_col)).distinct(), day_col, "left_anti").orderBy(
        "interval_start"
    )
