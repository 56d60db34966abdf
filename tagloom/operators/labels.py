"""Tags to labels: a chain of DataFrame transforms over `labels`, a map.

Order: merged tags, name check, prefix, defaults, meta attributes, external
attributes, exclude, include, copy, rename, metadata.
"""

from __future__ import annotations

from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.config import Config, parse_csv
from tagloom.functions import scalars as S
from tagloom.functions.resource import derive_job, parse_resource
from tagloom.operators.match import Matcher, matching

# Source keys that the default labels stand for.
CONSUMED = (
    "name", "resourceId", "foreignSource", "foreignId", "nodeId", "nodeLabel", "location", "ifName", "ifDescr", "mtype", "ifHighSpeed", "ifSpeed", "categories",
)
# Labels copied from a source key as they are.
DIRECT = {
    "node_label": "nodeLabel", "foreign_source": "foreignSource", "foreign_id": "foreignId",
    "location": "location", "if_name": "ifName", "if_descr": "ifDescr", "mtype": "mtype",
}
# Keys whose values never become labels.
DENIED_CONTEXT = ["*:*password*", "*:*secret*", "*:*token*", "*:*key*", "*:snmp-community"]
DENIED_PLAIN = ["*password*", "*secret*", "*token*", "snmp-community"]
META, EXTERNAL, CATEGORY = "onms_attr_", "onms_extattr_", "onms_cat_"

_MAP, _ENTRIES = "map<string,string>", "array<struct<key:string,value:string>>"


# ------------------------------------------------------------ map helpers

def settle(spark: SparkSession) -> None:
    """The session settings that label maps rely on: of equal keys the last one
    counts, times are UTC. Checks of duplicate keys by hand would name each map
    several times, and expressions would grow with every stage."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def keep_first(upper: Column, lower: Column) -> Column:
    """Both maps; where both have a key, upper's value."""
    return F.map_concat(lower, upper)


def map_of_last(entries: Column) -> Column:
    """A map of (key, value) entries; of equal keys the last counts, entries
    without a key or value none."""
    return F.map_from_entries(F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull()))


def entry(key: str | Column, value: Column) -> Column:
    return F.struct((F.lit(key) if isinstance(key, str) else key).alias("key"), value.cast("string").alias("value"))


def rewritten(tags: Column, keep, name) -> Column:
    """Labels of the tags that keep(key) holds for, in key order, named by
    name(key); the first of equal names counts."""
    chosen = F.sort_array(F.map_entries(F.map_filter(tags, lambda k, _: keep(k))), asc=False)
    return map_of_last(F.transform(chosen, lambda e: entry(name(e["key"]), S.label_value(e["value"]))))


# ------------------------------------------------------------ stages

def merge_tags(df: DataFrame) -> DataFrame:
    """`tags`: intrinsic before meta before external, for each key."""
    settle(df.sparkSession)
    return df.withColumn("tags", keep_first(F.col("intrinsic"), keep_first(F.col("meta"), F.col("external"))))


def drop_nameless(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce(F.col("tags")["name"], F.lit("")) != "")


def categories(value: Column) -> Column:
    """Label names of a comma-separated list."""
    names = F.transform(F.split(value, ","), lambda x: F.regexp_replace(x, r"\A[\x00-\x20]+|[\x00-\x20]+\z", ""))
    return F.array_distinct(F.transform(F.filter(names, lambda x: x != ""), lambda x: F.concat(F.lit(CATEGORY), S.label_name(x))))


def default_labels(df: DataFrame, cfg: Config) -> DataFrame:
    """`labels` by the default list, and `unparseable`: no grammar matches the
    resource identifier, or there is none."""
    t = lambda k: F.col("tags")[k]
    full = lambda c: F.when(c != "", c)
    df = df.withColumn("_r", parse_resource(t("resourceId")))
    df = df.withColumn("_node", F.coalesce(_pair(t("foreignSource"), t("foreignId")), F.col("_r.node_id"), full(t("nodeId"))))
    job = F.lit(cfg.job_name) if cfg.job_name else derive_job(t("resourceId"), F.col("_r"))
    found = [
        entry("resourceId", t("resourceId")),
        entry("resource_type", F.col("_r.resource_type")),
        entry("resource_instance", F.col("_r.resource_instance")),
        entry("job", job),
        entry("node", F.col("_node")),
        entry("instance", F.col("_node")),
        *[entry(label, full(t(key))) for label, key in DIRECT.items()],
    ]
    if cfg.instance_id:
        found.insert(0, entry("onms_instance_id", F.lit(cfg.instance_id)))
    if cfg.if_speed_mode == "RAW":
        found += [entry(k, F.when(S.speed(t(k)).isNotNull(), t(k))) for k in ("ifSpeed", "ifHighSpeed")]
    else:
        found.append(entry("if_speed", S.if_speed(t("ifHighSpeed"), t("ifSpeed"))))
    listed = t("categories").rlike(r"[^\x00-\x20]")
    if cfg.categories_mode in ("RAW", "BOTH"):
        found.append(entry("categories", F.when(listed, t("categories"))))
    # names differ within a list; over the lists the first one counts, so it stands last
    entries = [F.transform(F.array(*found), lambda e: entry(e["key"], S.label_value(e["value"])))]
    if cfg.categories_mode in ("PER_CATEGORY", "BOTH"):
        each = F.transform(categories(t("categories")), lambda n: entry(n, F.lit("true")))
        entries.insert(0, F.when(listed, each).otherwise(F.array()).cast(_ENTRIES))
    entries.append(F.array(entry("__name__", S.metric_name(F.concat(F.lit(cfg.metric_prefix or ""), t("name"))))))
    return df.withColumn("labels", map_of_last(F.concat(*entries))).withColumn("unparseable", F.col("_r").isNull()).drop("_r", "_node")


def _pair(source: Column, number: Column) -> Column:
    return F.when((F.coalesce(source, F.lit("")) != "") & (F.coalesce(number, F.lit("")) != ""), F.concat_ws(":", source, number))


def narrowed(df: DataFrame, cfg: Config, matchers: list[Matcher]) -> DataFrame:
    """The samples less those that matchers on the metric's name or the resource
    identifier rule out, by the source tags alone: what stays is still to be
    matched, but the rest is never mapped. Labels that the settings take away or
    replace are not looked at."""
    touched = [*cfg.rename, *[t for ts in cfg.copy.values() for t in ts], *cfg.rename.values()]
    source = lambda k: F.coalesce(*[F.col(part)[k] for part in ("intrinsic", "meta", "external")])
    made = {"__name__": S.metric_name(F.concat(F.lit(cfg.metric_prefix or ""), source("name"))), "resourceId": S.label_value(source("resourceId"))}
    for m in matchers:
        if m.label in made and m.label not in touched and not any(fnmatchcase(m.label, g) for g in parse_csv(cfg.labels_exclude)):
            df = df.where(m.test(made[m.label]))
    return df


def attribute_labels(df: DataFrame) -> DataFrame:
    """String attributes of the meta and external partitions, under prefixes
    that keep the partitions apart."""
    plain = lambda k: (k != "") & ~k.contains(":") & (k != "mtype") & ~S.glob_match(k, DENIED_PLAIN, ignore_case=True)
    taken = [k for k in CONSUMED if k not in ("name", "resourceId")]
    meta = rewritten(F.col("meta"), plain, lambda k: F.concat(F.lit(META), S.label_name(k)))
    external = rewritten(F.col("external"), lambda k: plain(k) & ~k.isin(taken), lambda k: F.concat(F.lit(EXTERNAL), S.label_name(k)))
    return df.withColumn("labels", keep_first(keep_first(F.col("labels"), meta), external))


def exclude(df: DataFrame, globs: list[str]) -> DataFrame:
    return df.withColumn("labels", F.map_filter("labels", lambda k, _: ~S.glob_match(k, globs))) if globs else df


def include(df: DataFrame, globs: list[str], compat: bool = False) -> DataFrame:
    """Further source tags by key. Denied keys stay out unless compat."""
    if not globs:
        return df
    denied = lambda k: S.glob_match(k, DENIED_CONTEXT + DENIED_PLAIN, ignore_case=True)
    keep = lambda k: ~k.isin(*CONSUMED) & S.glob_match(k, globs) & (F.lit(compat) | ~denied(k))
    return df.withColumn("labels", keep_first(F.col("labels"), rewritten(F.col("tags"), keep, lambda k: S.label_name(S.snake_case(k)))))


def copy(df: DataFrame, targets: dict[str, list[str]]) -> DataFrame:
    """Copies read the labels as they come in; a copy replaces its target."""
    if not targets:
        return df
    made = [entry(t, F.when(F.col("labels")[s] != "", F.col("labels")[s])) for s, ts in targets.items() for t in ts]
    return df.withColumn("labels", keep_first(map_of_last(F.array(*made)), F.col("labels")))


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """A renamed label replaces one that has the new name already."""
    if not names:
        return df
    old = F.col("labels")
    moved = map_of_last(F.array(*[entry(S.label_name(F.lit(n)), old[o]) for o, n in names.items()]))
    rest = F.map_filter(old, lambda k, _: ~k.isin(*names))
    return df.withColumn("labels", keep_first(moved, rest))


def metadata(df: DataFrame, cfg: Config) -> DataFrame:
    """Tags with a context (a colon in the key) under the metadata prefix, and
    `denied`: how many of them the denylist kept out."""
    context = lambda k: k.contains(":")
    denied = lambda k: S.glob_match(k, DENIED_CONTEXT, ignore_case=True)
    if not cfg.metadata_enabled:
        return df.withColumn("denied", F.lit(0))
    inside, outside = parse_csv(cfg.metadata_include), parse_csv(cfg.metadata_exclude)
    keep = lambda k: context(k) & ~denied(k) & ~S.glob_match(k, outside) & S.glob_match(k, inside)
    named = lambda k: F.concat(F.lit(cfg.metadata_prefix), S.label_name(S.snake_case(k) if cfg.metadata_case == "SNAKE_CASE" else k))
    made = rewritten(F.col("tags"), keep, named)
    count = F.size(F.map_filter("tags", lambda k, _: context(k) & denied(k)))
    return df.withColumn("denied", count).withColumn("labels", keep_first(F.col("labels"), made))


def map_labels(df: DataFrame, cfg: Config | None = None, matchers: list[Matcher] | None = None) -> DataFrame:
    """Samples (seq, intrinsic, meta, external, ...) to rows with `labels`; with
    matchers, only those that match them, sorted out before the mapping as far as
    the source tags tell."""
    cfg = (cfg or Config()).validate()
    df = narrowed(df, cfg, matchers or [])
    df = attribute_labels(default_labels(drop_nameless(merge_tags(df)), cfg))
    df = include(exclude(df, parse_csv(cfg.labels_exclude)), parse_csv(cfg.labels_include))
    df = metadata(rename(copy(df, cfg.copy), cfg.rename), cfg)
    # a list of one, exploded: predicates on labels are not pushed below the
    # projection, where they would work the whole mapping out again
    df = df.withColumn("labels", F.explode_outer(F.array("labels")))
    return df.where(matching(F.col("labels"), matchers)) if matchers else df


def valid(df: DataFrame) -> DataFrame:
    """Fails on a row whose labels lack a metric name."""
    named = F.map_contains_key("labels", F.lit("__name__"))
    return df.withColumn("labels", F.when(named, F.col("labels")).otherwise(F.raise_error(F.lit("labels without __name__")).cast(_MAP)))


def long_form(df: DataFrame) -> DataFrame:
    """(seq, label, value), one row for each label."""
    return df.select("seq", F.explode_outer("labels").alias("label", "value")).where("label is not null")
