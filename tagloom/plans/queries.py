"""One query for each capability, over samples derived from the driver tables.
Outputs are scalar columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import Config
from tagloom.functions import scalars as S
from tagloom.functions.resource import derive_job, parse_resource
from tagloom.operators import labels as L
from tagloom.operators import promql as P
from tagloom.operators import read as R
from tagloom.operators import series as T
from tagloom.operators.match import Matcher, intrinsic_matchers, matching
from tagloom.plans.fixtures import mapped, samples
from tagloom.sources import json_api
from tagloom.streaming.pipeline import retained

#: Leaves the labels of the metric, the job and the node, so that series repeat.
NARROW = Config(labels_exclude="onms_*, if_*, mtype, resource*")
NOW, DAY = 1_706_000_000_000, 86_400_000
START, END, STEP = 1_704_067_200_000 + 9 * DAY, 1_704_067_200_000 + 10 * DAY, 600_000
STALE = 6 * 3_600_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _series() -> Column:
    """A series for reading, from its canonical text."""
    return T.series_key(T.labels_of(F.col("series_id"))).alias("series")


def _tagged(spark, d) -> DataFrame:
    return L.merge_tags(samples(spark, d))


def _labels(df: DataFrame, like: Column | None = None) -> DataFrame:
    rows = L.long_form(df)
    return rows if like is None else rows.where(like)


def _rounded(c) -> Column:
    return F.round(c, 6)


# ---------------------------------------------------------------- slice

@query
def series_group(spark, d):
    found = mapped(spark, d, NARROW).groupBy("series_id").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
    return found.select(_series(), "n", "first_seq")


@query
def lww_dedup(spark, d):
    kept = T.last_write_wins(T.drop_nonfinite(mapped(spark, d, NARROW)), ts="ts_day_ms")
    return kept.select(_series(), "ts_day_ms", "value", "copies")


@query
def lww_dedup_lead(spark, d):
    rows = T.drop_nonfinite(mapped(spark, d, NARROW)).select("series_id", "ts_day_ms", "value", "seq")
    return T.last_write_wins_by_lead(rows, ts="ts_day_ms").select(_series(), "ts_day_ms", "value", "seq")


@query
def job_derivation(spark, d):
    rid = F.col("tags")["resourceId"]
    return _tagged(spark, d).select("seq", derive_job(rid, parse_resource(rid)).alias("job"))


@query
def node_identity(spark, d):
    return mapped(spark, d).select("seq", F.col("labels")["node"].alias("node"), F.col("labels")["instance"].alias("instance"))


@query
def resource_parse(spark, d):
    rid = F.col("tags")["resourceId"]
    return _tagged(spark, d).select("seq", rid.alias("resource_id"), parse_resource(rid).alias("r")).select("seq", "resource_id", "r.node_id", "r.resource_type", "r.resource_instance")


# ---------------------------------------------------------------- scalars

def _texts(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")


@query
def sanitize_metric(spark, d):
    return _texts(spark, d).select("doc_id", S.metric_name(F.col("text")).alias("name"))


@query
def sanitize_label(spark, d):
    return _texts(spark, d).select("doc_id", S.label_name(F.col("text")).alias("name"))


@query
def label_truncate(spark, d):
    cut = S.label_value(F.col("text"))
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.octet_length(cut).alias("bytes"), F.sha2(cut, 256).alias("sha256"))


def _tag_texts(spark, d) -> DataFrame:
    """Keys and values of all tags, each text once."""
    x = _tagged(spark, d).select(F.explode("tags").alias("key", "value"))
    return x.select(F.explode(F.array("key", "value")).alias("key")).where("key is not null").distinct()


@query
def snake_case(spark, d):
    return _tag_texts(spark, d).select("key", S.snake_case(F.col("key")).alias("snake"))


@query
def glob_match(spark, d):
    return _tag_texts(spark, d).select("key", S.glob_match(F.col("key"), ["if*", "*:*", "?th1"]).alias("matched"), S.glob_match(F.col("key"), ["*NODE*"], True).alias("any_case"))


@query
def if_speed_normalized(spark, d):
    t = F.col("tags")
    return _tagged(spark, d).select("seq", S.if_speed(t["ifHighSpeed"], t["ifSpeed"]).alias("if_speed"))


@query
def if_speed_raw(spark, d):
    return _labels(mapped(spark, d, Config(if_speed_mode="RAW")), F.col("label").isin("ifSpeed", "ifHighSpeed"))


def _value_texts(spark, d) -> DataFrame:
    """Every event's value as a text of the query API; some are not finite."""
    e = F.col("event_id")
    text = F.when(e % 89 == 0, "NaN").when(e % 89 == 1, "+Inf").when(e % 89 == 2, "-Inf").when(e % 89 == 3, "Inf").otherwise(
        F.concat(F.floor(F.col("value") * 100).cast("bigint").cast("string"), F.lit("e-2")))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), text.alias("text"))


def _parsed(value: Column) -> list[Column]:
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    kind = F.when(finite, "finite").when(F.isnan(value), "nan").when(value > 0, "+").otherwise("-")
    return [kind.alias("kind"), F.when(finite, value).alias("value")]


@query
def parse_value(spark, d):
    return _value_texts(spark, d).select("event_id", *_parsed(S.parse_value(F.col("text"))))


@query
def step_derivation(spark, d):
    e = F.col("event_id")
    rows = spark.read.parquet(f"{d}/events.parquet").select("event_id", (e % 86_400).alias("start"), (e % 86_400 + e * 7919).alias("end"), F.when(e % 3 == 0, e % 17).alias("step"))
    return rows.select("event_id", S.step_seconds(F.col("start"), F.col("end"), F.col("step")).alias("step_s"))


@query
def backoff_schedule(spark, d):
    k = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")
    return spark.range(1).select(k).select("k", F.least(F.lit(100).cast("bigint") * F.pow(F.lit(2), F.col("k")).cast("bigint"), F.lit(5000).cast("bigint")).alias("pause_ms"))


# ---------------------------------------------------------------- labels

@query
def enriched_samples(spark, d):
    x = F.col("external")
    return samples(spark, d).select(
        "seq", F.col("intrinsic")["name"].alias("name"), F.col("intrinsic")["resourceId"].alias("resource_id"), x["nodeLabel"].alias("node_label"),
        x["location"].alias("location"), x["categories"].alias("categories"), F.col("meta")["mtype"].alias("mtype"), "ts_ms")


@query
def tag_merge(spark, d):
    return _tagged(spark, d).select("seq", F.explode_outer("tags").alias("key", "value")).where("key is not null")


@query
def drop_nameless(spark, d):
    return L.drop_nameless(_tagged(spark, d)).select("seq", F.col("tags")["name"].alias("name"))


@query
def metric_prefix(spark, d):
    return mapped(spark, d, Config(metric_prefix="9my.")).select("seq", F.col("labels")["__name__"].alias("name"))


@query
def default_labels(spark, d):
    return _labels(L.default_labels(L.drop_nameless(_tagged(spark, d)), Config()))


@query
def categories_exploded(spark, d):
    return _labels(mapped(spark, d), F.col("label").startswith("onms_cat_"))


@query
def categories_raw(spark, d):
    return _labels(mapped(spark, d, Config(categories_mode="BOTH")), (F.col("label") == "categories") | F.col("label").startswith("onms_cat_"))


@query
def attr_meta(spark, d):
    return _labels(mapped(spark, d), F.col("label").startswith("onms_attr_"))


@query
def attr_external(spark, d):
    return _labels(mapped(spark, d), F.col("label").startswith("onms_extattr_"))


@query
def labels_exclude(spark, d):
    return _labels(mapped(spark, d, Config(labels_exclude="onms_*attr_*, if_?????, mtype")))


@query
def labels_include(spark, d):
    return _labels(mapped(spark, d, Config(labels_include="site*, *Password, custom*, ifName")), F.col("label").isin("site_code", "db_password", "custom_note", "if_name"))


@query
def labels_copy(spark, d):
    return _labels(mapped(spark, d, Config(labels_copy="node -> host, node -> target, if_speed -> bandwidth")), F.col("label").isin("node", "host", "target", "bandwidth", "if_speed"))


@query
def labels_rename(spark, d):
    return _labels(mapped(spark, d, Config(labels_rename="node -> host, location -> site_code", labels_include="siteCode")), F.col("label").isin("node", "host", "location", "site_code"))


_META = Config(metadata_enabled=True, metadata_include="*:*", metadata_case="SNAKE_CASE")


@query
def metadata_passthrough(spark, d):
    return _labels(mapped(spark, d, _META), F.col("label").startswith("onms_meta_"))


@query
def metadata_denylist(spark, d):
    return mapped(spark, d, _META).agg(F.sum("denied").alias("denied"), F.count("*").alias("n"))


@query
def ingest_mapped(spark, d):
    return mapped(spark, d).select("seq", T.series_key(F.col("labels")).alias("series"), "ts_ms", F.when(T.finite(F.col("value")), F.col("value")).alias("value"))


# ---------------------------------------------------------------- series

@query
def nonfinite_filter(spark, d):
    return T.drop_nonfinite(samples(spark, d)).select("seq", "value")


@query
def batch_summary(spark, d):
    rows = T.batch_number(mapped(spark, d, NARROW), 1000)
    return T.batch_summary(rows, by=("batch_id",), ts="ts_day_ms")


@query
def batch_scoped_dedup(spark, d):
    rows = T.drop_nonfinite(T.batch_number(mapped(spark, d, NARROW), 1000))
    return T.last_write_wins(rows, by=("batch_id",), ts="ts_day_ms").select("batch_id", _series(), "ts_day_ms", "value", "copies")


@query
def wire_v1_series(spark, d):
    rows = T.wire_series(mapped(spark, d, NARROW), ts="ts_day_ms")
    text = F.array_join(F.transform("samples", lambda s: F.concat_ws(":", s["ts_ms"].cast("string"), F.round(s["value"] * 100).cast("bigint").cast("string"))), ",")
    return rows.select(T.series_key(F.col("labels")).alias("series"), text.alias("samples"), "duplicates")


@query
def wire_v2_symbols(spark, d):
    rows = T.wire_series(mapped(spark, d, NARROW), ts="ts_day_ms").withColumn("series_id", T.series_key(F.col("labels")))
    return T.symbols(rows).select("symbol", "ref")


def _one_row(*tables: DataFrame) -> DataFrame:
    """The columns of tables of one row each, side by side."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


@query
def drop_accounting(spark, d):
    raw = samples(spark, d)
    name = F.coalesce(F.col("intrinsic")["name"], F.lit(""))
    counts = raw.agg(F.count("*").alias("received"), F.sum((name == "").cast("bigint")).alias("nameless"))
    return _one_row(counts, T.batch_summary(mapped(spark, d, NARROW), ts="ts_day_ms"))


@query
def unparseable_count(spark, d):
    return mapped(spark, d).agg(F.sum(F.col("unparseable").cast("bigint")).alias("samples"))


# ---------------------------------------------------------------- reads

def _matched(spark, d, *matchers):
    return mapped(spark, d, matchers=list(matchers)).select("seq")


@query
def match_eq(spark, d):
    return _matched(spark, d, Matcher("name", "=", "click"), Matcher("absent", "=", ""))


@query
def match_neq(spark, d):
    return _matched(spark, d, Matcher("mtype", "!=", "gauge"), Matcher("job", "!=", "snmp"))


@query
def match_re(spark, d):
    return _matched(spark, d, Matcher("name", "=~", "cl.*|view"), Matcher("node", "=~", "FS[0-3]:.+"))


@query
def match_nre(spark, d):
    return _matched(spark, d, Matcher("resourceId", "!~", "node.*"))


@query
def select_intrinsic(spark, d):
    return _matched(spark, d, *intrinsic_matchers("view", "snmp/3/hrStorageIndex/1"))


@query
def lookback_filter(spark, d):
    return R.lookback(samples(spark, d), NOW, 7 * 86_400).select("seq", "ts_ms")


@query
def find_metrics_eq(spark, d):
    asked = [Matcher("name", "=", "view")]
    return R.find_series(mapped(spark, d, NARROW, asked), asked).select(_series())


_WIDE = Config(labels_exclude="onms_*, if_*, mtype")


@query
def find_metrics_two_phase(spark, d):
    asked = [Matcher("resourceId", "=~", "snmp/.*"), Matcher("name", "=", "view")]
    return R.find_series_two_phase(mapped(spark, d, _WIDE, asked[1:]), asked).select(_series())


@query
def discovery_batches(spark, d):
    ids = R.discovery_batches(R.label_values(mapped(spark, d), "resourceId"))
    return ids.groupBy("batch").agg(F.count("*").alias("n"), F.min("value").alias("first"), F.max("value").alias("last"))


@query
def label_values(spark, d):
    return R.label_values(mapped(spark, d), "location")


@query
def metrics_dedup_intrinsic(spark, d):
    rows = mapped(spark, d, _WIDE).withColumn("series_id", T.series_key(F.col("labels")))
    return R.distinct_metrics(rows).select("name", "resource_id", T.series_key(F.col("labels")).alias("series"))


@query
def reconstruct_partitions(spark, d):
    rows = mapped(spark, d).select("seq", R.partitions(F.col("labels")).alias("p"))
    parts = [rows.select("seq", F.lit(n).alias("part"), F.explode(f"p.{n}").alias("key", "value")) for n in ("intrinsic", "meta", "external")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def mtype_fallback(spark, d):
    return mapped(spark, d).select("seq", R.with_mtype(R.partitions(F.col("labels"))["meta"])["mtype"].alias("mtype"))


def _finite_series(spark, d) -> DataFrame:
    return T.last_write_wins(T.drop_nonfinite(mapped(spark, d, NARROW)))


@query
def range_merge(spark, d):
    rows = T.drop_nonfinite(mapped(spark, d, NARROW, [Matcher("name", "=", "click")]))
    return R.merge_ranges(rows.select(_series().alias("series_ord"), F.col("seq").alias("idx"), F.col("ts_day_ms").alias("ts_ms"), "value"))


@query
def fetch_range_grid(spark, d):
    return R.on_grid(_finite_series(spark, d), START, END, STEP, STALE).select(_series(), "ts_ms", "value")


@query
def fetch_range_samples(spark, d):
    rows = R.time_range(_finite_series(spark, d), START, END)
    return rows.select(F.col("labels")["__name__"].alias("name"), _series(), "ts_ms", "value")


@query
def parse_series_json(spark, d):
    """Answers with the customers of a nation each."""
    one = F.to_json(F.create_map(F.lit("__name__"), F.lit("up"), F.lit("customer"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment")))
    rows = spark.read.parquet(f"{d}/customer.parquet").groupBy("c_nationkey").agg(F.concat_ws(",", F.sort_array(F.collect_list(one))).alias("all"))
    body = F.concat(F.lit('{"status":"success","data":['), "all", F.lit("]}")).alias("body")
    return json_api.parse_series(rows.select("c_nationkey", body), keep=["c_nationkey"]).select("c_nationkey", "pos", F.explode("labels").alias("label", "value"))


@query
def parse_matrix_json(spark, d):
    """Range answers with all events of a user and type each."""
    point = F.concat(F.lit("["), F.floor(F.col("ts_ms") / 1000).cast("bigint").cast("string"), F.lit('.5,"'), "text", F.lit('"]'))
    rows = _value_texts(spark, d).groupBy("user_id", "event_type").agg(F.concat_ws(",", F.sort_array(F.collect_list(point))).alias("all"))
    head, mid = '{"status":"success","data":{"resultType":"matrix","result":[{"metric":{"__name__":"', '"},"values":['
    body = F.concat(F.lit(head), "event_type", F.lit(mid), "all", F.lit("]}]}}")).alias("body")
    return json_api.parse_matrix(rows.select("user_id", body), keep=["user_id"]).select(
        "user_id", F.col("labels")["__name__"].alias("name"), "series_ord", "idx", "ts_ms", *_parsed(F.col("value")))


@query
def request_paths(spark, d):
    """The paths that ask for every node's series."""
    from tagloom.sources.http import series_path

    rows = mapped(spark, d, NARROW).select(F.col("labels")["node"].alias("node")).where("node is not null").distinct()
    match = F.concat(F.lit('{node="'), "node", F.lit('",job=~"snmp|jmx + x"}'))
    return rows.select("node", series_path(match, 1_700_000_000).alias("path"))


# ---------------------------------------------------------------- analytics

@query
def instant_select(spark, d):
    asked = [Matcher("name", "=~", "view|click")]
    rows = P.instant(_matching_series(spark, d, asked), asked, END, DAY)
    return rows.select(_series(), "ts_ms", "value")


def _matching_series(spark, d, asked) -> DataFrame:
    return T.last_write_wins(T.drop_nonfinite(mapped(spark, d, NARROW, asked)))


@query
def rate_5m(spark, d):
    rows = P.rate(_finite_series(spark, d), 300_000, 60_000)
    return rows.select(_series(), "window_ms", F.round(F.col("rate") * 1e6).cast("bigint").alias("micro_rate"))


@query
def rate_day(spark, d):
    rows = P.rate(_finite_series(spark, d), DAY, DAY // 4)
    return rows.select(_series(), "window_ms", F.round(F.col("rate") * 1e6).cast("bigint").alias("micro_rate"))


@query
def sum_by_label(spark, d):
    rows = P.instant(_finite_series(spark, d), [], END, DAY)
    return P.sum_by(rows, "location").select("location", F.round("total", 2).alias("total"))


@query
def count_series(spark, d):
    asked = [Matcher("name", "=", "view")]
    return P.count_series(P.instant(_matching_series(spark, d, asked), asked, END, DAY))


@query
def failure_ratio(spark, d):
    name = F.col("labels")["__name__"]
    rows = P.rate(_matching_series(spark, d, [Matcher("name", "=~", "error|view")]), DAY, at_ms=(END, END))
    part = lambda n: F.when(name == n, F.col("rate"))
    rows = rows.withColumn("bad", part("error")).withColumn("good", part("view"))
    sums = rows.groupBy(F.col("labels")["job"].alias("job")).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    return sums.where("bad is not null and good is not null").select("job", F.round(F.col("bad") / F.col("good"), 4).alias("ratio"))


@query
def series_by_job(spark, d):
    return P.series_by(mapped(spark, d, NARROW), "job")


@query
def category_membership(spark, d):
    rows = mapped(spark, d, Config(categories_mode="BOTH"))
    a = [Matcher("onms_cat_ProductionSites", "=", "true"), Matcher("onms_cat_Routers", "=", "true")]
    b = [Matcher("categories", "=~", ".*Server.*")]
    return rows.select("seq", matching(F.col("labels"), a).alias("both"), matching(F.col("labels"), b).alias("server"))


# ---------------------------------------------------------------- streaming policies, stats

@query
def overflow_backpressure(spark, d):
    from tagloom.streaming.pipeline import accepted

    return accepted(samples(spark, d), 500).groupBy("accepted").agg(F.count("*").alias("n"))


@query
def overflow_drop_oldest(spark, d):
    rows = samples(spark, d).groupBy(F.floor(F.col("seq") / 100).cast("bigint").alias("segment")).agg((F.count("*") * 60).alias("bytes"))
    return retained(rows, 30_000)


@query
def pipeline_stats(spark, d):
    one = _one_row(drop_accounting(spark, d), unparseable_count(spark, d).withColumnRenamed("samples", "unparseable"))
    names = ["received", "nameless", "series", "written", "dropped_nonfinite", "dropped_duplicate", "unparseable"]
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("bigint").alias("value")) for n in names])).alias("x")).select("x.*")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated series with job, node, number of points and last value."""
    rows = T.last_write_wins(T.drop_nonfinite(mapped(spark, sf_dir, NARROW)), ts="ts_day_ms")
    return rows.groupBy("series_id").agg(
        F.first(F.col("labels")["__name__"]).alias("name"), F.first(F.col("labels")["job"]).alias("job"), F.first(F.col("labels")["node"]).alias("node"),
        F.count("*").alias("points"), F.max_by("value", "ts_day_ms").alias("last_value"))
