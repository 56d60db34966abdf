"""Chunk table: documents packed in rows of some megabytes, and the exchange of
questions and answers between chunks and hash buckets.

A chunk asks each bucket in one row, with what it has in common already
combined, and gets one row back. The chunk table is bucketed by chunk, so the
answers are joined to it without moving the texts.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import fresh_path, parts_of, ship, tidy, utf8_column

_LEAST = -(1 << 63)
#: Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK = 8 << 20


def chunk_table(docs: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """(chunk, n, ids, lengths, data): rows of docs (doc_id, text) in chunks, as
    little-endian int64 arrays and the texts' bytes. Null text is empty, null
    doc_id is the least integer."""
    spark = docs.sparkSession
    ship(spark)

    def run(batches):
        from pyspark import TaskContext

        number, ids, parts, lengths, size = TaskContext.get().partitionId() << 24, [], [], [], 0
        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            key = batch.column(0).to_numpy(zero_copy_only=False)
            a = 0
            while a < len(key):
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + chunk_bytes - size, "right")) - 1)
                ids.append(key[a:b])
                lengths.append(np.diff(offsets[a : b + 1]))
                parts.append(data[offsets[a] : offsets[b]].tobytes())
                size += len(parts[-1])
                a = b
                if size >= chunk_bytes or a < len(key):
                    yield one(number, ids, lengths, parts)
                    number, ids, parts, lengths, size = number + 1, [], [], [], 0
        if ids:
            yield one(number, ids, lengths, parts)

    def one(number, ids, lengths, parts):
        data = b"".join(parts)
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([len(data)]), pa.array([np.concatenate(ids).astype("<i8").tobytes()], pa.binary()),
             pa.array([np.concatenate(lengths).astype("<i8").tobytes()], pa.binary()), pa.array([data], pa.binary())],
            names=["chunk", "n", "ids", "lengths", "data"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    table = rows.mapInArrow(tidy(run), "chunk long, n long, ids binary, lengths binary, data binary")
    return bucketed(table, "chunk", 2 * parts_of(spark))


def bucketed(df: DataFrame, key: str, count: int) -> DataFrame:
    """df as a table in the shared folder, bucketed by key."""
    spark = df.sparkSession
    name = f"t_{uuid.uuid4().hex}"
    df.write.format("parquet").option("compression", "zstd").option("path", fresh_path(spark, "bucketed")).bucketBy(count, key).saveAsTable(name)
    return spark.table(name)


class Chunk:
    def __init__(self, number: int, ids: bytes, lengths: bytes, data: bytes):
        self.number = number
        self.ids = np.frombuffer(ids, "<i8")
        self.offsets = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, "<i8"))]).astype(np.int64)
        self.data = np.frombuffer(data, np.uint8)


def chunks_of(batches):
    """(chunk, row as a dict) of every row; the row has the other columns."""
    for batch in batches:
        for i in range(len(batch)):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            yield Chunk(row["chunk"], row["ids"], row["lengths"], row.pop("data")), row


def answers(df: DataFrame, name: str) -> DataFrame:
    """One row for each chunk: its answers, an array of (bucket, blob)."""
    return df.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "blob")).alias(name))


def by_bucket(df: DataFrame) -> DataFrame:
    return df.repartition(parts_of(df.sparkSession), "bucket").sortWithinPartitions("bucket", "chunk")


def bucket_rows(batches):
    """(bucket, its rows as dicts), one bucket at a time, of sorted batches."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != at:
                if held:
                    yield at, held
                at, held = row["bucket"], []
            held.append(row)
    if held:
        yield at, held


def buckets_for(table: DataFrame, bytes_each: int) -> int:
    """A power of two, in proportion to the chunk table's bytes."""
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return 1 << max(4, int(total // bytes_each).bit_length())


def rows_batch(chunk: int, items: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    """Rows (bucket, blob...) of one chunk."""
    columns = list(zip(*items, strict=True)) if items else [()] * len(names)
    arrays = [pa.array([chunk] * len(items), pa.int64()), pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]]
    return pa.RecordBatch.from_arrays(arrays, names=["chunk", *names])
