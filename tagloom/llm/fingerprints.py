"""Closed-syncmer fingerprints and their positional likeness."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import mix, parts_of, range_bounds, range_part, ship, tidy

#: Bytes of an anchor and of its inner substrings.
K, S = 32, 8
_LEAST = -(1 << 63)


def syncmers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, position, hash) of the closed syncmers: the K-byte strings
    whose least S-byte substring (by hash) is their first or their last. Whether
    a string is chosen depends on its own bytes alone."""
    n, window = len(data) - K + 1, K - S + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64)
    held = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.ndarray((len(data) - S + 1,), "<u8", held, strides=(1,))
    v = mix(word + np.uint64(0x9E3779B97F4A7C15))
    low, size = v, 1
    while size * 2 <= window:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:n], low[window - size : window - size + n])
    at = np.flatnonzero((low == v[:n]) | (low == v[window - 1 : window - 1 + n]))
    doc = np.searchsorted(offsets, at, "right") - 1
    inside = at + K <= offsets[doc + 1]
    at, doc = at[inside], doc[inside]
    h = np.zeros(len(at), np.uint64)
    for i in range(0, K, S):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + word[at + i])
    return doc, at - offsets[doc], h


class Print:
    """A document's anchors: `text` has all of them, as base64 of four bytes of
    hash for each and then, for each, the step from the one before (a byte: no
    K bytes in a row are without a syncmer). `hash` and `pos` are the distinct
    hashes with their first positions. A text too short for any is one anchor of
    its own, its whole self."""

    __slots__ = ("hash", "pos", "text")

    def __init__(self, pos: np.ndarray, h: np.ndarray, text: str):
        self.hash, first = np.unique(h, return_index=True)
        self.pos, self.text = pos[first], text

    @classmethod
    def of(cls, raw: bytes, pos: np.ndarray, h: np.ndarray) -> Print:
        if not len(h):
            h = np.frombuffer(hashlib.blake2b(raw, digest_size=8, person=b"short").digest(), np.uint64)
            pos = np.zeros(1, np.int64)
        h = (h >> np.uint64(32)).astype("<u4")
        return cls(pos, h, base64.b64encode(h.tobytes() + np.diff(pos, prepend=0).astype(np.uint8).tobytes()).decode())

    @classmethod
    def read(cls, text: str) -> Print:
        """A fingerprint again from its text."""
        raw = base64.b64decode(text)
        n = len(raw) // 5
        return cls(np.cumsum(np.frombuffer(raw, np.uint8, n, 4 * n), dtype=np.int64), np.frombuffer(raw, "<u4", n), text)

    def likeness(self, other: Print) -> float:
        """Jaccard over anchors, of which a common one counts if another common
        one moved by as many bytes (a lone anchor needs no second)."""
        _, i, j = np.intersect1d(self.hash, other.hash, assume_unique=True, return_indices=True)
        if not len(i):
            return 0.0
        _, n = np.unique(other.pos[j] - self.pos[i], return_counts=True)
        most = min(len(self.hash), len(other.hash))
        matched = len(i) if most == 1 else int(n[n > 1].sum())
        return matched / (len(self.hash) + len(other.hash) - matched)


def likeness(a: str, b: str) -> float:
    """Likeness of two published fingerprints, 0 to 1."""
    return Print.read(a).likeness(Print.read(b))


def prints(texts: list[bytes]) -> list[Print]:
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    doc, pos, h = syncmers(np.frombuffer(b"".join(texts), np.uint8), offsets)
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [Print.of(t, pos[a:b], h[a:b]) for t, a, b in zip(texts, cut[:-1], cut[1:], strict=True)]


def _rows(keys: list, texts: list[str]) -> pa.RecordBatch:
    """Results for all rows but the last, which is only the next of the one before."""
    raw = [t.encode("utf-8") for t in texts]
    own = prints(raw)
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts[:-1], texts[1:], strict=True)]
    raw = [t.encode("utf-8") for t in edited]
    other = prints(raw)
    n = len(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()),
            pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
            pa.array([p.text for p in own[:n]], pa.string()), pa.array([p.text for p in other], pa.string()),
            pa.array([own[i].likeness(other[i]) for i in range(n)], pa.float64()),
            pa.array([own[i].likeness(own[i + 1]) for i in range(n)], pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_neighbours(docs: DataFrame, slice_chars: int = 1 << 20) -> DataFrame:
    """For each row of docs (doc_id, text), its fingerprint, that of its edited
    text (the last half of its characters replaced by the start of the next
    document) and the likeness to that and to the next document.

    Rows are dealt into contiguous ranges of doc_id, each of which borrows the
    first document of the next range (the last one borrows the very first), so
    the next document is always at hand and no ordering passes through one
    task. What reaches the driver is a bounded sample of ids and the first id of
    each range. Null text is empty, null doc_id comes first, rows with equal
    doc_id follow by text; a lone document is its own next; an empty table gives
    no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("k"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    bounds = range_bounds(rows, "k", 4 * parts_of(spark))
    part = range_part("k", bounds)
    firsts = sorted((r["part"], r["k"]) for r in rows.groupBy(part.alias("part")).agg(F.min("k").alias("k")).collect())
    own = rows.withColumn("part", part).withColumn("lent", F.lit(0))
    if firsts:
        lent_to = {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}
        table = F.create_map(*[F.lit(x) for k, p in lent_to.items() for x in (k, p)])
        lent = rows.where(F.col("k").isin(list(lent_to))).withColumn("part", table[F.col("k")]).withColumn("lent", F.lit(1))
        own = own.unionByName(lent)
    dealt = own.repartition(parts_of(spark), "part").sortWithinPartitions("part", "lent", "k", "text")

    def run(batches):
        keys, texts, size, at, closed = [], [], 0, None, False
        for batch in batches:
            for part, doc_id, text, lent in zip(*(batch.column(n).to_pylist() for n in ("part", "doc_id", "text", "lent")), strict=True):
                if part != at:
                    keys, texts, size, at, closed = [], [], 0, part, False
                if closed:
                    continue
                keys.append(doc_id)
                texts.append(text)
                size += len(text)
                closed = bool(lent)
                if len(texts) > 1 and (closed or size > slice_chars):
                    yield _rows(keys, texts)
                    keys, texts, size = keys[-1:], texts[-1:], len(texts[-1])

    return dealt.select("part", "doc_id", "text", "lent").mapInArrow(tidy(run), SCHEMA)
