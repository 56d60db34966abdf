"""Samples derived from the events, customer and nation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.labels import map_labels, settle
from tagloom.operators.order import spread
from tagloom.operators.series import with_series


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, intrinsic, meta, external, ts_ms, ts_day_ms, value."""
    settle(spark)
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    customer = read("customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read("nation").select("n_nationkey", "n_name")
    df = spread(read("events").select("event_id", "user_id", "event_type", "ts", "value", "props"), "event_id").join(customer, F.col("user_id") == F.col("c_custkey"), "left").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    e, u = F.col("event_id"), F.col("user_id")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    name = F.when(e % 97 == 3, "").when(e % 50 == 7, text("9", F.col("event_type"), ".rate")).otherwise(F.col("event_type"))
    rid = (
        F.when(e % 101 == 5, None)
        .when(u % 5 == 0, text("node[", u, "].interfaceSnmp[eth", e % 4, "]"))
        .when(u % 5 == 1, text("nodeSource[FS", u % 7, ":", u, "].hrStorageIndex[", e % 3, "]"))
        .when(u % 5 == 2, text("snmp/fs/FS", u % 7, "/", u, "/", F.when(e % 2 == 0, "opennms-jvm").otherwise("jmx-minion"), "/", F.col("event_type")))
        .when(u % 5 == 3, text("snmp/", u, "/hrStorageIndex/", e % 3))
        .otherwise(text("weird:", u))
    )
    pick = lambda by, values: F.get(F.array(*[F.lit(v).cast("string") for v in values]), (by % len(values)).cast("int"))
    external = {
        "foreignSource": F.when(u % 3 != 0, text("FS", u % 7)),
        "foreignId": F.when(u % 4 == 0, "").otherwise(u.cast("string")),
        "nodeLabel": F.col("c_name"),
        "location": F.col("n_name"),
        "ifName": text("eth", e % 4),
        "ifHighSpeed": pick(e, ["1000", "0", None, "abc", " 40 ", "-1"]),
        "ifSpeed": pick(e, ["100000000", "4294967295", None, "   "]),
        "categories": pick(F.col("c_nationkey"), ["ProductionSites,Routers", "Server Room-B", "", None]),
        "rack-unit": F.get_json_object("props", "$.k"),
        "dbPassword": F.lit("hunter2"),
        "siteCode": text("S", u % 9),
    }
    meta = {
        "mtype": pick(e, ["gauge", "counter", None]),
        "customNote": text("n", e % 3),
        "requisition:assetTag": text("A", u % 11),
        "requisition:apiKey": F.lit("k"),
    }
    tags = lambda d: F.map_filter(F.create_map(*[x for k, v in d.items() for x in (F.lit(k), v.cast("string"))]), lambda _, v: v.isNotNull())
    ts = F.col("ts").cast("timestamp")
    return df.select(
        e.alias("seq"), tags({"name": name, "resourceId": rid}).alias("intrinsic"), tags(meta).alias("meta"), tags(external).alias("external"),
        F.unix_millis(ts).alias("ts_ms"), F.unix_millis(F.date_trunc("DAY", ts)).alias("ts_day_ms"),
        F.when(e % 89 == 0, F.lit("NaN").cast("double")).when(e % 89 == 1, F.lit("Infinity").cast("double")).otherwise(F.col("value")).alias("value"))


def mapped(spark: SparkSession, sf_dir: str, cfg=None, matchers=None) -> DataFrame:
    """The samples' labels by the settings, with series_id."""
    return with_series(map_labels(samples(spark, sf_dir), cfg, matchers))
