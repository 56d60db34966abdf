"""Instant vectors, rates and sums over labelled series.

A vector has one row for each series at one time; sums and counts are taken over
vectors, never over the samples of all times."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.operators.match import Matcher, matching
from tagloom.operators.series import labels_of


def instant(df: DataFrame, matchers: list[Matcher], at_ms: int, stale_ms: int = 300_000) -> DataFrame:
    """(series_id, labels, ts_ms, value): the latest sample in (t - stale, t]; no
    matchers: of every series."""
    near = df.where(F.col("ts_ms").between(at_ms - stale_ms + 1, at_ms))
    if matchers:
        near = near.where(matching(F.col("labels"), matchers))
    found = near.groupBy("series_id").agg(F.max("ts_ms").alias("ts_ms"), F.max_by("value", "ts_ms").alias("value"))
    return found.withColumn("labels", labels_of(F.col("series_id")))


def rate(df: DataFrame, window_ms: int, step_ms: int | None = None, at_ms: tuple[int, int] | None = None) -> DataFrame:
    """(series_id, labels, window_ms, rate): at each step t, a multiple of `step_ms`
    (the window's length if none, of which it is a divisor), between the two ends
    of `at_ms` if given, the increase between the samples of (t - w, t] over w in
    seconds; a fall is a counter's reset; without extrapolation to the window's
    ends. Windows of one sample have none. A sample is in w / step windows."""
    step = step_ms or window_ms
    if window_ms % step:
        raise ValueError("the window is no multiple of the step")
    if at_ms:
        df = df.where(F.col("ts_ms").between(at_ms[0] - window_ms + 1, at_ms[1]))
    first = F.ceil(F.col("ts_ms") / step).cast("bigint") * step
    ends = F.sequence(first, first + (window_ms - step), F.lit(step).cast("bigint")) if step < window_ms else F.array(first)
    # the increase to a sample is the same in all windows that hold it and the one before
    by_time = Window.partitionBy("series_id").orderBy("ts_ms")
    before, value = F.lag("value").over(by_time), F.col("value")
    grown = F.when(before.isNotNull(), F.when(value >= before, value - before).otherwise(value))
    rows = df.select("series_id", "ts_ms", grown.alias("grown"), F.lag("ts_ms").over(by_time).alias("before")).where("before is not null")
    rows = rows.select("series_id", "grown", "before", F.explode(ends).alias("window_ms")).where((F.col("before") > F.col("window_ms") - window_ms) & (F.col("window_ms").between(*at_ms) if at_ms else F.lit(True)))
    found = rows.groupBy("series_id", "window_ms").agg((F.sum("grown") / (window_ms / 1000)).alias("rate"))
    return found.withColumn("labels", labels_of(F.col("series_id")))


def sum_by(vector: DataFrame, label: str, value: str = "value", extra: tuple[str, ...] = ()) -> DataFrame:
    """Sums of a vector's values for each value of a label, '' where it is absent."""
    return vector.groupBy(F.coalesce(F.col("labels")[label], F.lit("")).alias(label), *extra).agg(F.sum(value).alias("total"))


def count_series(vector: DataFrame) -> DataFrame:
    """How many series a vector has."""
    return vector.agg(F.count("*").alias("series"))


def series_by(df: DataFrame, label: str) -> DataFrame:
    """How many different series there are for each value of a label."""
    one = df.select("series_id").distinct().withColumn("labels", labels_of(F.col("series_id")))
    return one.groupBy(F.coalesce(F.col("labels")[label], F.lit("")).alias(label)).agg(F.count("*").alias("series"))
