"""Answers of the query API: series, label values, matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.scalars import parse_value, to_millis

_SERIES = "status string, error string, data array<map<string,string>>"
_VALUES = "status string, error string, data array<string>"
_MATRIX = "status string, error string, data struct<resultType:string,result:array<struct<metric:map<string,string>,values:array<array<string>>>>>"
MOST_BYTES = 8 << 20


def _checked(body: Column, schema: str) -> Column:
    """The parsed answer; an error unless its status is success and its size
    within bounds."""
    parsed = F.from_json(body, schema)
    wrong = F.concat(F.lit("query failed: "), F.coalesce(parsed["error"], parsed["status"], F.lit("no status")))
    return (
        F.when(F.octet_length(body) > MOST_BYTES, F.raise_error(F.lit("the answer is too large")).cast(_as_type(schema)))
        .when(F.coalesce(parsed["status"], F.lit("")) != "success", F.raise_error(wrong).cast(_as_type(schema)))
        .otherwise(parsed)
    )


def _as_type(schema: str) -> str:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).simpleString()


def parse_series(df: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """(pos, labels) of a series answer, behind the columns to keep."""
    return df.select(*keep, F.posexplode(_checked(F.col(body), _SERIES)["data"]).alias("pos", "labels"))


def parse_label_values(df: DataFrame, body: str = "body") -> DataFrame:
    return df.select(F.explode(_checked(F.col(body), _VALUES)["data"]).alias("value")).where("value <> ''")


def parse_matrix(df: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """(series_ord, labels, idx, ts_ms, value) of a range answer, behind the
    columns to keep."""
    result = df.select(*keep, _checked(F.col(body), _MATRIX)["data"]["result"].alias("r"))
    series = result.select(*keep, F.posexplode("r").alias("series_ord", "s")).select(
        *keep, "series_ord", F.col("s.metric").alias("labels"), F.posexplode("s.values").alias("idx", "p"))
    return series.select(*keep, "series_ord", "labels", "idx", to_millis(F.col("p")[0].cast("double")).alias("ts_ms"), parse_value(F.col("p")[1]).alias("value"))
