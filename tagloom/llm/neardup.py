"""MinHash near-duplicates: banding, signature verification, confirmation on
full sets, connected components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import Words, materialize, mix, parts_of, ship, slices, tidy, utf8_column
from tagloom.llm.components import components

_LEAST = -(1 << 63)
#: Hashes of the signatures by which pairs between components are chosen.
WIDE = 640
#: Members of a bucket that are compared in one block.
BLOCK = 1024
#: Rows of two numbers that may be broadcast.
SMALL = 1_000_000


@dataclass(frozen=True)
class Settings:
    """Documents whose sets of `width`-word shingles have 100 * intersection >=
    percent * union are linked. A pair at the limit shares a band of `rows`
    minima out of `bands` with a chance of 1 - (1 - s^rows)^bands, over 0.999999
    with the settings below; its 8-bit signature agrees within four standard
    deviations but for 3 in 100,000."""

    width: int
    percent: int
    rows: int
    bands: int

    @property
    def hashes(self) -> int:
        return self.rows * self.bands

    def least(self, hashes: int) -> float:
        s = self.percent / 100
        return s - 4 * (s * (1 - s) / hashes) ** 0.5


THREE_85 = Settings(width=3, percent=85, rows=5, bands=26)
FIVE_80 = Settings(width=5, percent=80, rows=4, bands=32)


def _sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each document's distinct shingles, ascending."""
    h, doc, _ = words.shingles(width)
    cut = np.searchsorted(doc, np.arange(words.rows + 1))
    out = []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        x = np.sort(h[a:b])
        out.append(x[np.concatenate([[True], x[1:] != x[:-1]])] if b > a else x)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), offsets


def _class_of(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64 bits that depend on the set alone; 0 for the empty one."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = mix(np.add.reduceat(mix(h + np.uint64(0x632BE59BD9B4E019)), offsets[full]) + np.diff(offsets)[full].astype(np.uint64))
    return out.view(np.int64)


def _minima(h: np.ndarray, offsets: np.ndarray, count: int, seed: int = 0) -> np.ndarray:
    """For each non-empty set, the minima of `count` universal hashes."""
    rng = np.random.default_rng(20240101 + seed)
    a = rng.integers(1 << 62, size=count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(1 << 63, size=count, dtype=np.uint64)
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(starts), count), np.uint64)
    x, buffer = mix(h), np.empty_like(h)
    for i in range(count):
        np.multiply(x, a[i], out=buffer)
        np.add(buffer, b[i], out=buffer)
        out[:, i] = np.minimum.reduceat(buffer, starts) if len(starts) else 0
    return out >> np.uint64(32)


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n (set size), cid (class of equal sets), keys (of the bands; null
    for empty sets), sig (8 bits of each minimum),
    marks (32 bits of each key)."""
    ship(docs.sparkSession)
    schema = "doc_id long, n long, cid long, keys array<long>, sig binary, marks binary"

    def run(batches):
        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            for a, b in slices(offsets, 1 << 20):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                h, at = _sets(words, s.width)
                n = np.diff(at)
                m = _minima(h, at, s.hashes)
                keys = np.zeros((len(m), s.bands), np.uint64)
                for i in range(s.rows):
                    keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + m[:, i :: s.rows] + np.uint64(1))
                keys = mix(keys + np.arange(s.bands, dtype=np.uint64))
                full = n > 0
                rows = np.cumsum(np.concatenate([[0], full])).astype(np.int32)
                sig = (m & np.uint64(0xFF)).astype(np.uint8)
                lists = pa.ListArray.from_arrays(pa.array(rows * s.bands, pa.int32()), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(n), pa.array(_class_of(h, at)), lists,
                     *(pa.array([x[r].tobytes() if f else None for r, f in zip(rows[:-1], full, strict=True)], pa.binary()) for x in (sig, keys.astype("<u4")))],
                    names=["doc_id", "n", "cid", "keys", "sig", "marks"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(tidy(run), schema)


# ------------------------------------------------------------ pairs in buckets

def _likely(sig: np.ndarray, n: np.ndarray, own: np.ndarray, s: Settings) -> np.ndarray:
    """Estimated similarity of the members of a block, 0 where it is too low for
    a link, or where the pair belongs to another block."""
    agree = np.zeros((len(sig), len(sig)), np.uint16)
    for column in sig.T:
        agree += column[:, None] == column[None, :]
    est = (agree / sig.shape[1] - 1 / 256) / (1 - 1 / 256)
    fits = est >= s.least(sig.shape[1])
    fits &= 100 * np.minimum(n[:, None], n[None, :]) >= s.percent * np.maximum(n[:, None], n[None, :])
    if own.min() != own.max():
        fits &= own[:, None] != own[None, :]
    np.fill_diagonal(fits, False)
    return np.where(fits, est.astype(np.float32), np.float32(0))


def _forest(est: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the likely pairs, of the greatest estimates."""
    m = len(est)
    if m == 2:
        return [(0, 1)] if est[0, 1] else []
    left, best, by, out = np.ones(m, bool), np.zeros(m, np.float32), np.zeros(m, int), []
    for _ in range(m):
        i = int(np.argmax(np.where(left, best, -1)))
        if best[i] > 0:
            out.append((int(by[i]), i))
        left[i] = False
        better = left & (est[i] > best)
        best[better], by[better] = est[i][better], i
    return out


def _new_here(i: np.ndarray, j: np.ndarray, marks: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows whose first common band is that of the key."""
    own, keep = np.uint32(key & 0xFFFFFFFF), np.zeros(len(i), bool)
    for a in range(0, len(i), 1 << 16):
        x, y = marks[i[a : a + (1 << 16)]], marks[j[a : a + (1 << 16)]]
        first = np.argmax(x == y, axis=1)
        keep[a : a + len(x)] = x[np.arange(len(x)), first] == own
    return i[keep], j[keep]


def _pairs(cand: DataFrame, s: Settings, across: bool) -> DataFrame:
    """(x, y), x < y: pairs of classes that share a bucket and are likely links:
    of each block a spanning forest, or, with across, every one between
    different components (columns root, and marks: a pair counts in the first
    band that it shares, once). A bucket beyond BLOCK members is dealt by blocks
    over as many groups, so none has to fit in a task. For forests each block
    meets itself and the bucket's first block; across components the blocks of
    the bucket's largest component meet those of the others alone: in both the
    work grows with a group of near copies, not with its square."""
    place = F.xxhash64("cid")
    if across:
        counts = cand.where(F.col("size") > BLOCK).groupBy("key", "root").agg(F.count("*").alias("c"))
        mains = counts.groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.max("c").alias("most"), F.sum("c").alias("all"))
        cand = cand.join(mains, "key", "left_outer")
        others = F.coalesce(F.ceil((F.col("all") - F.col("most")) / F.lit(BLOCK)), F.lit(1))
        inside = F.col("root").eqNullSafe(F.col("main"))
        own = F.when(inside, others + F.pmod(place, F.ceil(F.col("most") / F.lit(BLOCK)))).otherwise(F.pmod(place, others))
        last = F.when(inside, others - 1).otherwise(others + F.coalesce(F.ceil(F.col("most") / F.lit(BLOCK)), F.lit(0)) - 1)
        meets = F.sequence(F.lit(0).cast("long"), last.cast("long"))
    else:
        blocks = F.ceil(F.col("size") / F.lit(BLOCK))
        own = F.pmod(place, blocks)
        meets = F.when(own == 0, F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)).otherwise(F.array(F.lit(0).cast("long"), own.cast("long")))
    wide = cand.withColumn("own", own.cast("long")).withColumn("o", F.explode(meets))
    wide = wide.select("key", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "own", "cid", "n", "sig", *(["root", "marks"] if across else []))
    dealt = wide.repartition(parts_of(cand.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j", "cid")

    def of_group(part: pa.Table):
        if len(part) < 2:
            return
        cid = part["cid"].to_numpy()
        sig = np.frombuffer(utf8_column(part["sig"])[0], np.uint8).reshape(len(part), -1)
        est = _likely(sig, part["n"].to_numpy(), part["own"].to_numpy(), s)
        if across:
            root = part["root"].to_numpy()
            est[root[:, None] == root[None, :]] = 0
            i, j = _new_here(*np.nonzero(np.triu(est)), np.frombuffer(utf8_column(part["marks"])[0], "<u4").reshape(len(part), -1), part["key"][0].as_py())
        else:
            i, j = (np.array(x, int) for x in (zip(*_forest(est), strict=True) if est.any() else ((), ())))
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(cid[i], cid[j])), pa.array(np.maximum(cid[i], cid[j]))], names=["x", "y"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            k, i, j = (held[c].to_numpy() for c in ("key", "i", "j"))
            cut = np.flatnonzero((k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for a, b in zip([0, *cut[:-1]], cut, strict=False):
                yield from of_group(held.slice(a, b - a))
            if len(cut):
                held = held.slice(cut[-1])
        if held is not None:
            yield from of_group(held)

    return dealt.mapInArrow(tidy(run), "x long, y long").distinct()


# ------------------------------------------------------------ confirmation

def _pack(h: np.ndarray) -> bytes:
    """A set's hashes, ascending, whole."""
    return h.astype("<u8").tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def _full_sets(docs: DataFrame, wanted: DataFrame, s: Settings, wide: bool = False) -> DataFrame:
    """(cid, set) of the wanted classes (cid, doc_id), each once; with wide, 8
    bits of each of WIDE further minima instead of the set."""

    def blobs(h, at):
        if not wide:
            return [_pack(h[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
        rows = iter((_minima(h, at, WIDE, 1) & np.uint64(0xFF)).astype(np.uint8))
        return [next(rows).tobytes() if n else b"" for n in np.diff(at)]

    def run(batches):
        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            for a, b in slices(offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                h, at = _sets(words, s.width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(_class_of(h, at)), pa.array(blobs(h, at), pa.binary())],
                    names=["doc_id", "cid", "set"])

    ids = wanted.select("doc_id").distinct()
    if ids.count() <= SMALL:
        ids = F.broadcast(ids)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.join(ids, "doc_id", "left_semi").mapInArrow(tidy(run), "doc_id long, cid long, set binary")
    return found.select("cid", "set").dropDuplicates(["cid"])


def _confirmed(pairs: DataFrame, docs: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """(u, v): the pairs whose full sets are similar enough."""
    ends = pairs.select(F.col("x").alias("cid")).unionByName(pairs.select(F.col("y").alias("cid"))).distinct()
    wanted = materialize(ends.join(reps.select("cid", F.col("rep").alias("doc_id")), "cid"), "dup-wanted")
    sets = materialize(_full_sets(docs, wanted, s), "dup-sets")

    def run(batches):
        for batch in batches:
            ok = np.zeros(len(batch), bool)
            for i, (a, b) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                a, b = _unpack(a.as_py()), _unpack(b.as_py())
                both = np.concatenate([a, b])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                ok[i] = 100 * common >= s.percent * (len(a) + len(b) - common)
            yield batch.select(["x", "y"]).filter(pa.array(ok)).rename_columns(["u", "v"])

    full = pairs.join(sets.select(F.col("cid").alias("x"), F.col("set").alias("a")), "x").join(
        sets.select(F.col("cid").alias("y"), F.col("set").alias("b")), "y")
    return full.select("x", "y", "a", "b").mapInArrow(tidy(run), "u long, v long")


def near_duplicates(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id that links lead to),
    kept (doc_id = component_id) of each row of docs (doc_id, text).

    Rows with equal sets are one class from the start. Classes meet in buckets
    of equal bands; signatures leave the likely pairs. Of each bucket a spanning
    forest of them is confirmed on full sets and gives components; then every
    pair between different components of a bucket that longer signatures leave
    likely is confirmed as well, so a chain missing in a forest is found while the pairs inside a component
    are never listed. Components come from large-star and small-star steps.

    Null text is empty; empty texts and those of white space have no shingles
    and no links; rows that repeat a doc_id with other text are rows of their
    own and share only the number; a null doc_id is the least; no rows give no
    rows; other columns are ignored.
    """
    table, classes = _classes(docs, s)
    lost = lambda c: F.when(F.col(c) != _LEAST, F.col(c))
    joined = table.join(classes, "cid", "left_outer")
    component = F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n", component.alias("component_id")).select(
        lost("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), lost("component_id").alias("component_id"),
        (F.col("doc_id") == F.col("component_id")).alias("kept"))


def _classes(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, n, cid), (classes: cid, component_id)."""
    table = materialize(signatures(docs, s), "dup-rows")
    reps = materialize(
        table.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sig").alias("sig"), F.first("marks").alias("marks")),
        "dup-classes")
    bands = reps.select("cid", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    cand = materialize(bands.join(shared, "key").join(reps.select("cid", "n", "sig"), "cid").select("key", "size", "cid", "n", "sig"), "dup-buckets")

    first = materialize(_pairs(cand, s, across=False), "dup-pairs")
    links = materialize(_confirmed(first, docs, reps, s), "dup-links")
    roots = components(links)
    with_root = cand.join(roots, F.col("cid") == F.col("node"), "left_outer").withColumn("root", F.coalesce("root", "cid")).drop("node")
    open_keys = with_root.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    with_root = materialize(with_root.join(open_keys, "key", "left_semi").drop("sig"), "dup-open")
    in_open = materialize(with_root.select("cid").distinct().join(reps.select("cid", F.col("rep").alias("doc_id"), "marks"), "cid"), "dup-wanted")
    wide = _full_sets(docs, in_open, s, wide=True).withColumnRenamed("set", "sig")
    with_root = with_root.join(in_open.select("cid", "marks").join(wide, "cid"), "cid")
    rest = _pairs(with_root, s, across=True).join(first, ["x", "y"], "left_anti")
    rest = materialize(rest, "dup-pairs")
    if not rest.isEmpty():
        more = materialize(_confirmed(rest, docs, reps, s), "dup-links")
        if not more.isEmpty():
            roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))
    known = reps.select("cid", "rep").join(roots, F.col("cid") == F.col("node"), "left_outer").select("cid", "rep", F.coalesce("root", "cid").alias("root"))
    least = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = known.join(least, "root").select("cid", "component_id")
    return table.select("doc_id", "n", "cid"), materialize(classes, "dup-components")


def drop_near_duplicates(docs: DataFrame, s: Settings = FIVE_80) -> DataFrame:
    """The rows of docs but one of each group of near-duplicates: the one with
    the least doc_id stays, of rows that repeat it with the same text one.
    Texts without words stay, null ones too; a null doc_id is the least; an empty
    table gives no rows; other columns are kept, whatever their names."""
    table, classes = _classes(docs, s)
    gone = table.where("n > 0").join(classes, "cid").where("doc_id <> component_id").select("doc_id", "cid")
    again = table.where("n > 0").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    gone = materialize(gone.select("doc_id").distinct(), "dup-gone")
    again = materialize(again, "dup-again")
    if not again.isEmpty():
        return _drop_repeated(docs, table, classes, s)
    small = gone.count() <= SMALL
    return _rows(docs).join(F.broadcast(gone) if small else gone, "doc_id", "left_anti").select("doc.*")


def _rows(docs: DataFrame) -> DataFrame:
    """(doc: the whole row, doc_id): apart, so that no column's name is in the way."""
    return docs.select(F.struct("*").alias("doc"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("doc_id"))


def _drop_repeated(docs: DataFrame, table: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Where ids repeat: rows are told apart by the class of their set."""
    from pyspark.sql import Window

    kept = table.join(classes, "cid", "left_outer").where("n = 0 or doc_id = component_id")
    # one line for each kept (doc_id, class); a text leads to its class through its own signature
    lines = kept.select("doc_id", "cid").distinct()
    rows = _rows(docs).withColumn("sha", F.sha2(F.coalesce("doc.text", F.lit("")), 256))
    rows = rows.join(_text_classes(docs, s), ["doc_id", "sha"]).join(lines, ["doc_id", "cid"], "left_semi")
    order = Window.partitionBy("doc_id", "cid").orderBy("sha")
    return rows.withColumn("place", F.row_number().over(order)).where("place = 1 or cid = 0").select("doc.*")


def _text_classes(docs: DataFrame, s: Settings) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = utf8_column(batch.column(2))
            for a, b in slices(offsets):
                h, at = _sets(Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), s.width)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(1)[a:b], pa.array(_class_of(h, at))], names=["doc_id", "sha", "cid"])

    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("doc_id"), F.sha2(text, 256).alias("sha"), text.alias("text")).mapInArrow(tidy(run), "doc_id long, sha string, cid long").distinct()
