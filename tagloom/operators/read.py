"""Series discovery, label values, ranges, and labels back to tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.config import DISCOVERY_BATCH, LOOKBACK_SECONDS, PHASE_TWO_CALLS
from tagloom.operators.labels import EXTERNAL, META, keep_first
from tagloom.operators.match import Matcher, matching
from tagloom.operators.order import numbered
from tagloom.operators.series import labels_of


def lookback(df: DataFrame, now_ms: int, seconds: int = LOOKBACK_SECONDS) -> DataFrame:
    return df.where(F.col("ts_ms") >= now_ms - 1000 * seconds)


def time_range(df: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Both ends are cut to seconds and belong to the range."""
    return df.where(F.col("ts_ms").between(start_ms // 1000 * 1000, end_ms // 1000 * 1000))


def find_series(df: DataFrame, matchers: list[Matcher]) -> DataFrame:
    """(series_id, labels) of the matching series, each once."""
    return _distinct(df.where(matching(F.col("labels"), matchers)))


def _distinct(df: DataFrame) -> DataFrame:
    return df.select("series_id").distinct().withColumn("labels", labels_of(F.col("series_id")))


def label_values(df: DataFrame, label: str) -> DataFrame:
    value = F.col("labels")[label]
    return df.select(value.alias("value")).where("value <> ''").distinct()


def find_series_two_phase(df: DataFrame, matchers: list[Matcher], compat: bool = False) -> DataFrame:
    """Find the resource identifiers first, then the series that have one of
    them: a semi-join. The identifiers are matched in full; with compat their
    matchers are dropped as soon as the values are known."""
    others = [m for m in matchers if m.key != "resourceId"]
    base = df.where(matching(F.col("labels"), others)) if others else df
    own = [m for m in matchers if m.key == "resourceId"]
    # distinct series come first, so that samples are mapped and shuffled once for both
    # phases; the list of one keeps the second phase's filter above what they share
    found = _distinct(base).withColumn("labels", F.explode_outer(F.array("labels")))
    ids = label_values(found if compat or not own else found.where(matching(F.col("labels"), own)), "resourceId")
    return found.withColumn("value", F.col("labels")["resourceId"]).join(ids, "value", "left_semi").drop("value")


def discovery_batches(ids: DataFrame, size: int = DISCOVERY_BATCH) -> DataFrame:
    """(value, batch): ordered identifiers in chunks."""
    return numbered(ids.select("value"), "value").select("value", F.floor((F.col("ordinal") - 1) / size).cast("bigint").alias("batch"))


def check_calls(count: int, size: int = DISCOVERY_BATCH, most: int = PHASE_TWO_CALLS) -> int:
    calls = -(-count // size)
    if calls > most:
        raise ValueError(f"{count} identifiers need {calls} calls, over {most}")
    return calls


def partitions(labels: Column) -> Column:
    """struct(intrinsic, meta, external) that labels came from. A prefix with
    nothing behind it stays a meta tag."""
    external = lambda k: k.startswith(EXTERNAL) & (F.length(k) > len(EXTERNAL))
    attribute = lambda k: k.startswith(META) & (F.length(k) > len(META))
    own = lambda k: k.isin("__name__", "resourceId")
    intrinsic = F.transform_keys(F.map_filter(labels, lambda k, _: own(k)), lambda k, _: F.when(k == "__name__", "name").otherwise(k))
    stripped = F.transform_keys(F.map_filter(labels, lambda k, _: attribute(k)), lambda k, _: F.substr(k, F.lit(len(META) + 1)))
    plain = F.map_filter(labels, lambda k, _: ~own(k) & ~external(k) & ~attribute(k))
    outside = F.transform_keys(F.map_filter(labels, lambda k, _: external(k)), lambda k, _: F.substr(k, F.lit(len(EXTERNAL) + 1)))
    return F.struct(intrinsic.alias("intrinsic"), keep_first(plain, stripped).alias("meta"), outside.alias("external"))


def with_mtype(meta: Column) -> Column:
    """A missing or empty mtype becomes gauge."""
    return F.when(F.coalesce(meta["mtype"], F.lit("")) == "", keep_first(F.create_map(F.lit("mtype"), F.lit("gauge")), meta)).otherwise(meta)


def distinct_metrics(df: DataFrame) -> DataFrame:
    """(name, resource_id, labels): one for each identity, the first series."""
    return df.groupBy(F.col("labels")["__name__"].alias("name"), F.col("labels")["resourceId"].alias("resource_id")).agg(
        F.min_by("labels", "series_id").alias("labels"))


def merge_ranges(df: DataFrame) -> DataFrame:
    """(ts_ms, value) over several series (series_ord, idx, ts_ms, value): of
    equal timestamps the last series' last value."""
    return df.groupBy("ts_ms").agg(F.max_by("value", F.struct("series_ord", "idx")).alias("value"))


def merged_range(df: DataFrame, asked: Column | None = None) -> DataFrame:
    """One row (labels, points) for the series (series_ord, labels, idx, ts_ms,
    value) of a range answer: the first series' labels, or those asked for if it
    has none, and the merged points by time. An answer has RANGE_POINTS points a
    series at most, so they fit a row."""
    points = merge_ranges(df).agg(F.sort_array(F.collect_list(F.struct("ts_ms", "value"))).alias("points"))
    first = df.agg(F.min_by("labels", "series_ord").alias("labels"))
    empty = F.coalesce(F.size("labels"), F.lit(0)) < 1
    labels = F.when(empty, asked).otherwise(F.col("labels")) if asked is not None else F.col("labels")
    return first.select(labels.alias("labels"), F.lit(1).alias("_one")).join(F.broadcast(points.withColumn("_one", F.lit(1))), "_one").drop("_one")


def on_grid(df: DataFrame, start_ms: int, end_ms: int, step_ms: int, stale_ms: int = 300_000) -> DataFrame:
    """(series_id, ts_ms, value): at each step the latest sample of the window
    (t - stale, t]. A sample answers the steps up to its successor or the end of
    its window, so it is spread over those alone and nothing is sorted but each
    series' samples."""
    near = df.where(F.col("ts_ms").between(start_ms - stale_ms + 1, end_ms))
    succ = F.lead("ts_ms").over(Window.partitionBy("series_id").orderBy("ts_ms"))
    near = near.withColumn("until", F.least(F.coalesce(succ, F.lit(end_ms + 1)), F.col("ts_ms") + stale_ms, F.lit(end_ms + 1)) - 1)
    ceil = lambda c: F.ceil((c - start_ms) / step_ms)
    first, last = F.greatest(F.lit(0).cast("bigint"), ceil(F.col("ts_ms"))), F.floor((F.col("until") - start_ms) / step_ms)
    steps = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return near.select("series_id", F.explode(steps).alias("k"), "value").select("series_id", (F.col("k") * step_ms + start_ms).alias("ts_ms"), "value")


def capped(df: DataFrame, most: int) -> DataFrame:
    """df, or an error if it has more rows; never a part of it."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows")
    return df


def supports_aggregation(kind: str) -> bool:
    return kind == "NONE"


def delete(_) -> int:
    """Deleting is not supported by the store; it is only counted."""
    return 1
