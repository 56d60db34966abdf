"""Shared pieces of the corpus operators: durable intermediate tables, Arrow
text buffers, vectorised word hashing and the chunk table."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word pattern [^\x20\x09-\x0D]+ .
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes worked on at once inside a task; a longer document is taken alone.
SLICE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- tables

def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where the setting is absent (tests),
    a local folder in local mode and the warehouse on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.startswith("local["):
            found = "file://" + tempfile.mkdtemp(prefix="shared-")
        else:
            found = spark.conf.get("spark.sql.warehouse.dir")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends
    here, so a lost executor costs no recomputation of what stands above."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    # shuffle files that nothing needs any more go with the driver's garbage
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Send the package's modules to the executors' Python workers, once."""
    sc = spark.sparkContext
    if getattr(sc, "_tagloom_sent", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="modules-")) / "tagloom_modules.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(target))
    sc._tagloom_sent = True


# ---------------------------------------------------------------- buffers

def utf8_column(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE):
    """Row ranges [a, b) of at most so many bytes, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b
        a = b


def tidy(run):
    """run as a task's function that hands freed memory back to the system at
    its end: workers live on, and the next stage's memory comes on top."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)

    return task


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser over uint64: spreads every input bit; one to one."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """p^i and p^-i modulo 2^64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        base = 0x5851F42D4C957F2D
        for key, b in (("up", base), ("down", pow(base, -1, 1 << 64))):
            steps = np.full(max(n, SLICE + 1), b, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


#: The first bytes of eight.
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


class Words:
    """Words [^\x20\x09-\x0D]+ of some documents, A-Z lowered: `start`, `end`
    (byte positions in the slice), `doc` (row), `hash` (64 bits)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n, rows = len(data), len(offsets) - 1
        self.rows, self.data = rows, LOWER[data]
        solid = ~SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets[:-1]] = True
        edge[n] = True
        before = np.zeros(n, bool)
        before[1:] = solid[:-1]
        self.start = np.flatnonzero(solid & (~before | edge[:-1]))
        after = np.zeros(n, bool)
        after[:-1] = solid[1:]
        self.end = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        held = np.concatenate([self.data, np.zeros(8, np.uint8)])
        self._word = np.ndarray((n + 1,), "<u8", held, strides=(1,))
        self.hash = self.span_hash(self.start, self.end)
        #: first word of each document, and the end
        self.first = np.searchsorted(self.doc, np.arange(rows + 1))

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of spans of a byte at least: of the length and the sum of its
        blocks of eight bytes, each mixed with its place."""
        size = end - start
        blocks = (size + 7) >> 3
        first = np.cumsum(blocks) - blocks
        place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
        part = self._word[np.repeat(start, blocks) + 8 * place] & _MASK[np.minimum(np.repeat(size, blocks) - 8 * place, 8)]
        part = mix(part + mix((place + 1).astype(np.uint64) * _ODD))
        return mix((np.add.reduceat(part, first) if len(first) else part) + size.astype(np.uint64) * _ODD)

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, document, first word) of every run of `width` words; documents
        with fewer words, one at least, give their whole sequence as one."""
        counts = np.diff(self.first)
        n = len(self.hash)
        h = np.zeros(max(0, n - width + 1), np.uint64)
        for i in range(width if len(h) else 0):
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + self.hash[i : n - width + 1 + i] + np.uint64(i + 1))
        whole = self.doc[: len(h)] == self.doc[width - 1 :] if len(h) else np.zeros(0, bool)
        at = np.flatnonzero(whole)
        h, doc = h[at], self.doc[at]
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            extra = np.zeros(len(short), np.uint64)
            for i in range(width):
                has = counts[short] > i
                word = self.hash[np.minimum(self.first[short] + i, n - 1)]
                extra = np.where(has, mix(extra * np.uint64(0xD6E8FEB86659FD93) + word + np.uint64(i + 1)), extra)
            h = np.concatenate([h, mix(extra + counts[short].astype(np.uint64))])
            doc = np.concatenate([doc, short])
            at = np.concatenate([at, self.first[short]])
            order = np.argsort(doc, kind="stable")
            h, doc, at = h[order], doc[order], at[order]
        return h, doc, at


# ---------------------------------------------------------------- ordering

def range_bounds(df: DataFrame, key: str, parts: int, sample: int = 4000) -> list[int]:
    """At most parts-1 cut points of an integer key, from a deterministic hash
    sample of about `sample` rows (the bound of what reaches the driver)."""
    n = df.count()
    every = max(1, n // sample)
    kept = df.where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(every)) == 0))
    keys = sorted({r[0] for r in kept.select(key).orderBy(F.xxhash64(key), key).limit(4 * sample).collect()})
    cuts = [keys[i * len(keys) // parts] for i in range(1, parts)] if keys else []
    return sorted(set(cuts))


def range_part(key: str, bounds: list[int]):
    """Column: the number of bounds at or below the key; null keys go to 0."""
    if not bounds:
        return F.lit(0)
    cuts = F.array(*[F.lit(int(b)).cast("long") for b in bounds])
    # bounded by the number of partitions; a search tree of CASE would not be shorter
    return F.coalesce(F.size(F.filter(cuts, lambda b: b <= F.col(key))), F.lit(0))
