"""How rows lie over tasks: spreading few input splits, and row numbers over a
whole table without moving it into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Keys sampled for each partition, to place the cuts.
SAMPLE = 64


def spread(df: DataFrame, key: str) -> DataFrame:
    """df over as many partitions as there are cores, if its input has fewer
    (small files, or one row group): work on a row is then worth its move. Inputs
    with more splits than cores are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def numbered(df: DataFrame, key: str, order: str | None = None, name: str = "ordinal") -> DataFrame:
    """df with `name`, the row's number from 1 in order of the column `order`
    (`key` if none), of which `key` is the leading part; nulls come first, ties
    in no defined order, an empty table stays empty.

    Cuts of the key are taken from a hash sample of SAMPLE keys a partition (its
    bound on the driver); rows are numbered between cuts, and the counts before
    each cut, one row a partition, are added. Only equal keys need one task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = df.select(key, F.xxhash64(*df.columns).alias("_h")).where(F.col(key).isNotNull()).orderBy("_h", key).limit(SAMPLE * parts)
    keys = sorted({r[0] for r in some.collect()})
    cuts = sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(key))) if cuts else F.lit(0)
    rows = df.withColumn("_part", part)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(order or key).asc_nulls_first()))
    return rows.withColumn("_at", within).join(F.broadcast(counts), "_part").withColumn(name, (F.col("_before") + F.col("_at")).cast("bigint")).drop("_part", "_at", "_before")
