"""Series identity, non-finite values, last write wins, batch summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.operators.order import numbered


def sorted_entries(labels: Column) -> Column:
    return F.sort_array(F.map_entries(labels))


def series_id(labels: Column) -> Column:
    """Canonical text of a label set: equal sets, equal texts."""
    return F.to_json(F.map_from_entries(sorted_entries(labels)))


def labels_of(series: Column) -> Column:
    """The label set of a series_id. Aggregates are keyed by the text alone and
    take the labels from it afterwards: a map in their buffers would make them
    sort, and travel beside the text."""
    return F.from_json(series, "map<string,string>")


def series_key(labels: Column) -> Column:
    """The same for reading: name=value in order of names."""
    return F.array_join(F.transform(sorted_entries(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")


def with_series(df: DataFrame) -> DataFrame:
    return df.withColumn("series_id", series_id(F.col("labels")))


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != float("inf"))


def drop_nonfinite(df: DataFrame) -> DataFrame:
    return df.where(finite(F.col("value")))


def last_write_wins(df: DataFrame, by: tuple[str, ...] = (), ts: str = "ts_ms") -> DataFrame:
    """(by, series_id, ts, value, labels, copies): of the samples of a series
    with equal timestamps the last to arrive. Aggregates combine before the
    shuffle, so a hot series sends one row for each timestamp and task."""
    kept = df.groupBy(*by, "series_id", ts).agg(F.max_by("value", "seq").alias("value"), F.count("*").alias("copies"))
    return kept.withColumn("labels", labels_of(F.col("series_id")))


def last_write_wins_by_lead(df: DataFrame, ts: str = "ts_ms") -> DataFrame:
    """The same by a window: a row goes if the next one has its timestamp."""
    after = F.lead(ts).over(Window.partitionBy("series_id").orderBy(ts, "seq"))
    return df.withColumn("_next", after).where(F.col("_next").isNull() | (F.col("_next") != F.col(ts))).drop("_next")


def batch_number(df: DataFrame, size: int) -> DataFrame:
    """Batches by arrival number; deterministic, unlike batches by time."""
    return df.withColumn("batch_id", F.floor(F.col("seq") / size).cast("bigint"))


def batch_summary(df: DataFrame, by: tuple[str, ...] = (), ts: str = "ts_ms") -> DataFrame:
    """series, written, dropped_nonfinite, dropped_duplicate for each batch."""
    good = finite(F.col("value"))
    per = df.groupBy(*by, "series_id", ts).agg(F.sum(good.cast("bigint")).alias("good"), F.sum((~good).cast("bigint")).alias("bad"))
    one = per.groupBy(*by, "series_id").agg(
        F.sum((F.col("good") > 0).cast("bigint")).alias("written"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    return one.groupBy(*by).agg(
        F.sum((F.col("good") > 0).cast("bigint")).alias("series"), F.sum("written").alias("written"),
        F.sum("bad").alias("dropped_nonfinite"), F.sum(F.col("good") - F.col("written")).alias("dropped_duplicate"))


def wire_series(df: DataFrame, ts: str = "ts_ms") -> DataFrame:
    """(series_id, labels, samples): sorted labels, samples by time, last write
    wins; the logical form of a wire message."""
    kept = last_write_wins(drop_nonfinite(df), ts=ts)
    return kept.groupBy("series_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col(ts).alias("ts_ms"), "value"))).alias("samples"),
        F.sum(F.col("copies") - 1).alias("duplicates")).withColumn("labels", labels_of(F.col("series_id")))


def symbols(series: DataFrame) -> DataFrame:
    """(symbol, ref) of the dictionary over series in order of series_id: the
    empty text is 0, each name and value is numbered where it first appears.
    Only distinct texts with their first places are ordered."""
    parts = series.select("series_id", F.posexplode(F.flatten(F.transform(sorted_entries(F.col("labels")), lambda e: F.array(e["key"], e["value"])))).alias("pos", "symbol"))
    first = parts.where("symbol <> ''").groupBy("symbol").agg(F.min(F.struct("series_id", "pos")).alias("at"))
    placed = numbered(first.select("symbol", "at", F.col("at.series_id").alias("series_id")), "series_id", "at", "ref").select("symbol", "ref")
    return placed.unionByName(series.sparkSession.range(1).select(F.lit("").alias("symbol"), F.lit(0).cast("bigint").alias("ref")))
