"""Fetch windows of feeds that hand out at most so many rows per request."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# How a window is labelled.
WHOLE_DAY, FIRST_HALF, SECOND_HALF, HOUR, MINUTE = 1, 2, 3, 4, 5
#: Ours, beyond the labels of the feed: a part of a minute.
PART = 6
#: A minute halved so often has parts of less than a microsecond.
HALVINGS = 26
MINUTE_MICROS = 60_000_000


def label_windows(df: DataFrame, ts: str, cap: int = 1000) -> DataFrame:
    """Every row with the window to fetch it by, so that windows stay below ``cap`` rows.

    A day with fewer than ``cap`` rows is one window (``time_zone`` 1). Otherwise it is
    its halves, 00:00 to 12:00 (2) and 12:01 to 23:59 (3), if both are below the cap,
    else its hours (4), else its minutes (5). A minute is never split, so one above the cap is
    a window as it is. ``window_start`` is where the window begins. No row is dropped; one
    without time has no window.

    Rows are counted per minute, map-side first, and the choice is made on those counts:
    at most 1,440 rows per day, which are then joined back by day.
    """
    stamp = F.col(ts)
    minutes = (
        df.where(stamp.isNotNull())
        .groupBy(F.date_trunc("minute", stamp).alias("_minute"))
        .agg(F.count("*").alias("_n"))
    )
    morning = F.date_format("_minute", "HH:mm") <= "12:00"
    hours = minutes.groupBy(F.date_trunc("hour", "_minute").alias("_hour")).agg(
        F.sum("_n").alias("_n"), F.sum(F.when(morning, F.col("_n")).otherwise(0)).alias("_am")
    )
    days = hours.groupBy(F.to_date("_hour").alias("base_date")).agg(
        F.sum("_n").alias("_day"), F.sum("_am").alias("_am"), F.max("_n").alias("_hour")
    )
    grain = (
        F.when(F.col("_day") < cap, WHOLE_DAY)
        .when(F.greatest("_am", F.col("_day") - F.col("_am")) < cap, FIRST_HALF)
        .when(F.col("_hour") < cap, HOUR)
        .otherwise(MINUTE)
    )
    chosen = days.select("base_date", grain.alias("_grain"))
    joined = df.withColumn("base_date", F.to_date(stamp)).join(chosen, "base_date", "left")
    first_half = F.date_format(stamp, "HH:mm") <= "12:00"
    day = F.date_trunc("day", stamp)
    start = (
        F.when(F.col("_grain") == MINUTE, F.date_trunc("minute", stamp))
        .when(F.col("_grain") == HOUR, F.date_trunc("hour", stamp))
        .when((F.col("_grain") == FIRST_HALF) & ~first_half, day + F.expr("interval 721 minutes"))
        .otherwise(day)
    )
    half = F.when(first_half, FIRST_HALF).otherwise(SECOND_HALF)
    label = F.when(F.col("_grain") == FIRST_HALF, half).otherwise(F.col("_grain"))
    return joined.select(*df.columns, "base_date", label.alias("time_zone"), start.alias("window_start"))


def halve_minutes(df: DataFrame, ts: str, cap: int = 1000) -> DataFrame:
    """``label_windows``, with the minutes that reach the cap cut further.

    Such a minute is halved, and each half again, until a part has fewer than ``cap``
    rows; so each row gets the widest part around it that is below the cap, and only rows
    of one and the same time can exceed it. ``window_start`` is the first microsecond of
    the part, ``halvings`` how often the minute was halved (0 for all other windows) and
    ``time_zone`` 6.

    A part is full if ``cap`` rows that follow each other in time lie in it. So the times of
    a minute are put in order, each up to ``cap`` times; the bits that the finest parts of the
    first and the last of ``cap`` rows have in common name the deepest part around them, and a
    time's deepest full part is the deepest of those around the ``cap`` runs it is in. Rows
    meet only the number of halvings of their own time.
    """
    labelled = label_windows(df, ts, cap)
    minute = F.unix_micros(F.col("window_start").cast("timestamp"))
    rows = labelled.withColumns(
        {
            "_minute": F.when(F.col("time_zone") == MINUTE, minute),
            "_at": F.unix_micros(F.col(ts).cast("timestamp")) - minute,
        }
    )
    times = rows.where("_minute is not null").groupBy("_minute", "_at").agg(F.count("*").alias("_n"))
    copies = F.sequence(F.lit(1).cast("long"), F.least(F.col("_n"), F.lit(cap).cast("long")))
    each = times.select("_minute", "_at", F.explode(copies)).drop("col")
    in_order = Window.partitionBy("_minute").orderBy("_at")
    finest = _part(F.col("_at"), F.lit(HALVINGS))
    apart = finest.bitwiseXOR(F.lead(finest, cap - 1).over(in_order))
    level = HALVINGS - F.when(apart == 0, 0).otherwise(F.length(F.bin(apart)))
    around = F.max("_level").over(in_order.rowsBetween(1 - cap, 0))
    levels = each.withColumn("_level", level).withColumn("_level", around)
    deepest = levels.groupBy("_minute", "_at").agg(F.max("_level").alias("_deepest"))
    found = rows.join(deepest, ["_minute", "_at"], "left")
    deeper = F.least(F.col("_deepest") + 1, F.lit(HALVINGS))
    halvings = F.when(F.col("_deepest").isNull(), 0).otherwise(deeper)
    found = found.withColumn("halvings", halvings)
    part = _part(F.col("_at"), F.col("halvings"))
    # The first microsecond that is not before the part's exact beginning.
    parts_now = _parts(F.col("halvings"))
    offset = F.call_function("div", part * MINUTE_MICROS + parts_now - 1, parts_now)
    cut = F.col("halvings") > 0
    return found.select(
        *df.columns,
        "base_date",
        F.when(cut, PART).otherwise(F.col("time_zone")).alias("time_zone"),
        F.when(cut, F.timestamp_micros(F.col("_minute") + offset)).otherwise(F.col("window_start").cast("timestamp")).alias("window_start"),
        "halvings",
    )


def _part(at, level):
    """Which of the ``2**level`` parts of its minute a microsecond lies in."""
    return F.call_function("div", at * _parts(level), F.lit(MINUTE_MICROS))


def _parts(level):
    return F.call_function("shiftleft", F.lit(1).cast("long"), level)
