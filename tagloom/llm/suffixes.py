"""Repeated passages by blockwise suffix sorting with a difference cover."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagloom.llm.chunks import answers, bucket_rows, buckets_for, by_bucket, chunk_table, chunks_of, rows_batch
from tagloom.llm.common import _BYTE, _powers, materialize, mix, tidy

#: Bytes of a repeated string.
WIDTH = 50
#: Bytes of the substrings among which a window's anchor is the least.
GRAM = 24
STEP = 1 << 19
#: Bytes of text for each bucket.
BUCKET = 1 << 20
#: Fixed value: a difference cover modulo 7. Every difference of two residues
#: is one of two members.
COVER, PERIOD = (0, 1, 3), 7
#: Suffixes sorted at once.
BLOCK = 1 << 17
_LEAST = -(1 << 63)


# ------------------------------------------------------------ suffix sorting

def _shift(r: int, s: int) -> int:
    """The least d for which r + d and s + d are both in the cover."""
    return next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER and (s + d) % PERIOD in COVER)


SHIFT = [[_shift(r, s) for s in range(PERIOD)] for r in range(PERIOD)]


def _dense(keys: np.ndarray) -> np.ndarray:
    """Ranks from 1, equal keys alike."""
    order = np.argsort(keys)
    k = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else 0
    return rank


class SuffixSorter:
    """Sorts suffixes of a text, one block at a time, to a depth of `depth`
    bytes at least (beyond it, equal ones stay side by side).

    The suffixes at cover positions (three of each seven) are ranked first, by
    doubling over their seven-byte names. Any two suffixes that agree in seven
    bytes meet two cover positions within six, whose ranks decide: ties of any
    length cost one look, and a block needs memory for its own suffixes alone.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.n = len(text)
        self.text = np.concatenate([text, np.zeros(depth + 2 * PERIOD + 16, np.uint8)])
        word = np.ndarray((len(self.text) - 7,), ">u8", self.text, strides=(1,))
        self.name = lambda p: word[p].astype(np.uint64) >> np.uint64(8)  # seven bytes
        p = np.arange(self.n + PERIOD)
        p = p[np.isin(p % PERIOD, COVER)]
        self.rank = np.zeros(len(self.text), np.int64)
        own = _dense(self.name(p))
        size = PERIOD
        while size < depth + PERIOD and len(own) and own.max() < len(own):
            self.rank[p] = own
            after = np.where(p + size < len(self.rank), self.rank[np.minimum(p + size, len(self.rank) - 1)], 0)
            own = _dense((own.astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64))
            size *= 2
        self.rank[p] = own

    def blocks(self, starts: np.ndarray):
        """The starts in suffix order, in blocks that end between different
        seven-byte names."""
        names = self.name(starts)
        ends = np.sort(names)[BLOCK - 1 :: BLOCK]
        block = np.searchsorted(np.unique(ends), names)
        order = np.argsort(block, kind="stable")
        cut = np.flatnonzero(np.diff(block[order])) + 1
        for part in np.split(order, cut) if len(order) else []:
            yield starts[part][self._sorted(starts[part], names[part])]

    def _sorted(self, p: np.ndarray, names: np.ndarray) -> np.ndarray:
        order = np.argsort(names, kind="stable")
        k = names[order]
        new = np.concatenate([[True], k[1:] != k[:-1]])
        group = np.empty(len(p), np.int64)
        group[order] = np.cumsum(new) - 1
        classes = []
        for r in range(PERIOD):
            own = np.flatnonzero(p % PERIOD == r)
            key = (group[own] << 32) | self.rank[p[own] + SHIFT[r][r]]
            classes.append(own[np.argsort(key, kind="stable")])
        at = np.zeros(len(p), np.int64)
        for r, own in enumerate(classes):
            for s, other in enumerate(classes):
                if len(own) and len(other):
                    d = SHIFT[r][s]
                    mine = (group[own] << 32) | self.rank[p[own] + d]
                    at[own] += np.searchsorted((group[other] << 32) | self.rank[p[other] + d], mine)
        return np.argsort(at, kind="stable")

    def same(self, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
        """Whether the strings of `width` bytes at a and b are equal."""
        word = np.ndarray((len(self.text) - 7,), "<u8", self.text, strides=(1,))
        ok = np.ones(len(a), bool)
        for i in [*range(0, width - 7, 8), width - 8]:
            ok &= word[a + i] == word[b + i]
        return ok


def earliest(text: np.ndarray, starts: np.ndarray, owner: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """For each start, the least owner among the starts of equal strings of
    `width` bytes."""
    sorter, out = SuffixSorter(text, width), owner.copy()
    place = np.argsort(starts, kind="stable")
    for block in sorter.blocks(starts):
        i = place[np.searchsorted(starts, block, sorter=place)]
        head = np.flatnonzero(np.concatenate([[True], ~sorter.same(block[:-1], block[1:], width)]))
        out[i] = np.repeat(np.minimum.reduceat(owner[i], head), np.diff(np.append(head, len(i))))
    return out


# ------------------------------------------------------------ runs of windows

class Runs:
    """The windows of WIDTH bytes of a chunk's documents, in runs of neighbours
    that have the same anchor, the least GRAM-byte substring by hash (the last of
    equal ones). Equal windows have equal anchors. `start`, `count` (windows),
    `key` (the anchor's hash), `context` (hash of all the run's bytes), `doc`."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, contexts: bool = True):
        parts = []
        for a in range(0, max(0, len(data) - WIDTH + 1), STEP):
            parts.append(self._part(data, offsets, a, min(a + STEP, len(data) - WIDTH + 1), contexts))
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64)]
        self.start, self.count, self.key, self.context, self.doc = columns

    @staticmethod
    def _part(data, offsets, a, b, contexts):
        piece = np.concatenate([data[a : b + WIDTH - 1], np.zeros(8, np.uint8)])
        word = np.ndarray((len(piece) - 7,), "<u8", piece, strides=(1,))
        n = len(piece) - 8 - GRAM + 1
        h = mix(mix(word[:n] * np.uint64(0xD6E8FEB86659FD93) + word[8 : n + 8]) + word[16 : n + 16])
        span = WIDTH - GRAM + 1
        low, size = h, 1
        while size * 2 <= span:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[: b - a], low[span - size : span - size + b - a])
        at = np.arange(a, b)
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + WIDTH <= offsets[doc + 1]
        new = np.ones(b - a, bool)
        new[1:] = (low[1:] != low[:-1]) | (h[span : span + b - a - 1] == low[1:]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new & inside)
        bound = np.flatnonzero(new | ~inside)
        end = np.append(bound, b - a)[np.searchsorted(bound, head, "right")]
        count = end - head
        if not contexts:
            return head + a, count, low[head], low[head], doc[head]
        up, down = _powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[piece] * up[: len(piece)], out=sums[1:])
        context = mix((sums[end + WIDTH - 1] - sums[head]) * down[head] + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return head + a, count, low[head], context, doc[head]


def _fingerprints(runs: Runs, ids: np.ndarray, bits: int):
    """(bucket, rest, in several documents) of the chunk's distinct anchors, by
    bucket and rest; 32 bits of rest suffice as buckets grow with the corpus,
    and a false agreement only lets a run through to the exact step."""
    top = runs.key >> np.uint64(32 - bits)
    order = np.argsort(top, kind="stable")
    t, owner = top[order], ids[runs.doc[order]]
    head = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, int)
    several = np.minimum.reduceat(owner, head) != np.maximum.reduceat(owner, head) if len(t) else np.zeros(0, bool)
    return t[head], several


def _per_bucket(top: np.ndarray, bits: int):
    bucket = (top >> np.uint64(32)).astype(np.int64)
    return np.searchsorted(bucket, np.arange((1 << bits) + 1))


class Shared:
    """The chunk's runs whose anchors other documents have too, each context
    once. The first document of a context answers for the chunk: in the others
    its windows repeat a smaller doc_id already."""

    def __init__(self, chunk, bits: int, said: list[dict]):
        runs = Runs(chunk.data, chunk.offsets)
        top, _ = _fingerprints(runs, chunk.ids, bits)
        cut = _per_bucket(top, bits)
        known = np.zeros(len(top), bool)
        for x in said or []:
            a, b = cut[x["bucket"]], cut[x["bucket"] + 1]
            known[a:b] = np.unpackbits(np.frombuffer(x["blob"], np.uint8), count=b - a).astype(bool)
        own = runs.key >> np.uint64(32 - bits)
        take = np.flatnonzero(known[np.searchsorted(top, own)]) if len(top) else np.zeros(0, int)
        order = take[np.lexsort((runs.context[take], runs.key[take]))]
        context, key, owner = runs.context[order], runs.key[order], chunk.ids[runs.doc[order]]
        head = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (key[1:] != key[:-1])])) if len(order) else np.zeros(0, int)
        self.start, self.count = runs.start[order], runs.count[order]
        self.unique = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(order))))
        self.owner = np.minimum.reduceat(owner, head) if len(head) else owner[:0]
        self.repeats = owner > self.owner[self.unique] if len(head) else np.zeros(0, bool)
        self.u_start, self.u_count, self.u_key = self.start[head], self.count[head], key[head]
        bucket = (self.u_key >> np.uint64(64 - bits)).astype(np.int64)
        self.cut = np.searchsorted(bucket, np.arange((1 << bits) + 1))


def _spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)


def _join_bucket(rows: list[dict]):
    """(chunk, blob) answers of a bucket: for each chunk (index, first window,
    end window) of the windows that a smaller doc_id has as well."""
    keys, owner, count, origin, index, texts = [], [], [], [], [], []
    for i, row in enumerate(rows):
        n = row["n"]
        raw = pa.decompress(row["blob"], decompressed_size=row["size"], codec="zstd", asbytes=True)
        keys.append(np.frombuffer(raw, "<u8", n))
        owner.append(np.frombuffer(raw, "<i8", n, 8 * n))
        count.append(np.frombuffer(raw, np.uint8, n, 16 * n).astype(np.int64))
        texts.append(np.frombuffer(raw, np.uint8, -1, 17 * n))
        origin.append(np.full(n, i))
        index.append(np.arange(n))
    keys, owner, count, origin, index, text = (np.concatenate(x) for x in (keys, owner, count, origin, index, texts))
    length = count + WIDTH - 1
    start = np.cumsum(length) - length
    # equal contexts of different chunks: all windows but the first owner's are repeated
    context = _span_hashes(text, start, length)
    order = np.lexsort((owner, context, keys))
    k, c = keys[order], context[order]
    head = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]))
    unique = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(order))))
    first = order[head]
    # contexts alone under their anchor have nothing to share
    ku = keys[first]
    alone = np.ones(len(first), bool)
    alone[1:] &= ku[1:] != ku[:-1]
    alone[:-1] &= ku[:-1] != ku[1:]
    some = np.flatnonzero(~alone)
    window_owner = np.repeat(owner[first], count[first])
    if len(some):
        f = first[some]
        joined = text[_spread(start[f], length[f])]
        at = np.cumsum(length[f]) - length[f]
        found = earliest(joined, _spread(at, count[f]), np.repeat(owner[f], count[f]))
        window_owner[_spread((np.cumsum(count[first]) - count[first])[some], count[f])] = found
    base = np.cumsum(count[first]) - count[first]
    # for each asked context, its windows with a smaller owner than its own
    asked = np.empty(len(order), np.int64)
    asked[order] = unique
    where = _spread(base[asked], count)
    hit = window_owner[where] < np.repeat(owner, count)
    which = np.repeat(np.arange(len(asked)), count)
    offset = _spread(np.zeros(len(count), np.int64), count)
    begins = np.flatnonzero(hit & ~(np.concatenate([[False], hit[:-1]]) & (offset > 0)))
    ends = np.flatnonzero(hit & ~(np.concatenate([hit[1:], [False]]) & np.concatenate([offset[1:] > 0, [False]]))) + 1
    item = which[begins]
    low, high = offset[begins], offset[ends - 1] + 1
    cut = np.searchsorted(origin[item], np.arange(len(rows) + 1))
    for i, row in enumerate(rows):
        a, b = cut[i], cut[i + 1]
        if b > a:
            yield row["chunk"], index[item[a:b]].astype("<i4").tobytes() + low[a:b].astype(np.uint8).tobytes() + high[a:b].astype(np.uint8).tobytes()


def _span_hashes(text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hashes of consecutive spans of the text, some at a time."""
    out, a = np.zeros(len(start), np.uint64), 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(start, start[a] + STEP, "right")) - 1)
        piece = text[start[a] : start[b - 1] + length[b - 1]]
        up, down = _powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[piece] * up[: len(piece)], out=sums[1:])
        s = start[a:b] - start[a]
        out[a:b] = mix((sums[s + length[a:b]] - sums[s]) * down[s] + length[a:b].astype(np.uint64))
        a = b
    return out


def remove_repeats(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and (with_kept) kept, the
    bytes that stay, of each row of docs (doc_id, text), less every byte covered by a
    50-byte string that also starts in a document with a smaller doc_id.

    Texts are packed in chunks. Every window of 50 bytes is known by its anchor;
    chunks ask the anchors' buckets which of them several documents have (a
    filter without misses), and send the runs of windows with such anchors,
    equal contexts once, to the buckets again. A bucket holds the suffixes of its
    anchors with the bytes that they reach, sorts them block by block with cover
    ranks, and tells the chunks which windows a smaller doc_id has as well.

    Null text is empty, null doc_id is the least; rows with equal doc_id don't
    remove from each other; documents below 50 bytes lose nothing; an empty
    table gives no rows; other columns are ignored.
    """
    table = chunk_table(docs)
    bits = min(20, buckets_for(table, BUCKET).bit_length() - 1)

    def ask(batches):
        for chunk, _ in chunks_of(batches):
            top, several = _fingerprints(Runs(chunk.data, chunk.offsets, contexts=False), chunk.ids, bits)
            cut = _per_bucket(top, bits)
            rest = (top & np.uint64(0xFFFFFFFF)).astype("<u4")
            yield rows_batch(chunk.number, [
                (i, rest[a:b].tobytes(), np.packbits(several[a:b]).tobytes()) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a
            ], ("bucket", "rest", "several"))

    def tell(batches):
        for bucket, rows in bucket_rows(batches):
            rest = [np.frombuffer(r["rest"], "<u4") for r in rows]
            flat = np.concatenate(rest)
            known = np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(x)) for r, x in zip(rows, rest, strict=True)]).astype(bool)
            s = np.sort(flat)
            twice = np.unique(s[1:][s[1:] == s[:-1]])
            if len(twice):
                known |= twice[np.minimum(np.searchsorted(twice, flat), len(twice) - 1)] == flat
            cut = np.concatenate([[0], np.cumsum([len(x) for x in rest])])
            out = [(r["chunk"], bucket, np.packbits(known[a:b]).tobytes()) for r, a, b in zip(rows, cut[:-1], cut[1:], strict=True) if known[a:b].any()]
            yield _answer_batch(out)

    asked = table.select("chunk", "ids", "lengths", "data").mapInArrow(tidy(ask), "chunk long, bucket long, rest binary, several binary")
    told = materialize(by_bucket(asked).mapInArrow(tidy(tell), "chunk long, bucket long, blob binary"), "suffix-shared")
    with_told = table.select("chunk", "ids", "lengths", "data").join(answers(told, "told"), "chunk", "left_outer")

    def send(batches):
        for chunk, row in chunks_of(batches):
            x, out = Shared(chunk, bits, row["told"]), []
            for i in np.flatnonzero(np.diff(x.cut)):
                a, b = x.cut[i], x.cut[i + 1]
                text = chunk.data[_spread(x.u_start[a:b], x.u_count[a:b] + WIDTH - 1)]
                raw = x.u_key[a:b].astype("<u8").tobytes() + x.owner[a:b].astype("<i8").tobytes() + x.u_count[a:b].astype(np.uint8).tobytes() + text.tobytes()
                out.append((int(i), pa.compress(raw, codec="zstd", asbytes=True), int(b - a), len(raw)))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk.number] * len(out), pa.int64()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())],
                names=["chunk", "bucket", "blob", "n", "size"])

    def sort(batches):
        for bucket, rows in bucket_rows(batches):
            yield _answer_batch([(c, bucket, blob) for c, blob in _join_bucket(rows)])

    sent = with_told.mapInArrow(tidy(send), "chunk long, bucket long, blob binary, n long, size long")
    found = materialize(by_bucket(sent).mapInArrow(tidy(sort), "chunk long, bucket long, blob binary"), "suffix-found")

    def finish(batches):
        for chunk, row in chunks_of(batches):
            x, n = Shared(chunk, bits, row["told"]), len(chunk.data)
            marks = np.zeros(n + 1, np.int32)
            np.add.at(marks, x.start[x.repeats], 1)
            np.add.at(marks, (x.start + x.count + WIDTH - 1)[x.repeats], -1)
            parts = []
            for said in row["found"] or []:
                k = len(said["blob"]) // 6
                parts.append((x.cut[said["bucket"]] + np.frombuffer(said["blob"], "<i4", k), np.frombuffer(said["blob"], np.uint8, k, 4 * k), np.frombuffer(said["blob"], np.uint8, k, 5 * k)))
            if parts:
                u, lo, hi = (np.concatenate(p).astype(np.int64) for p in zip(*parts, strict=True))
                # a context's first owner may have it in several places
                pending = np.flatnonzero(~x.repeats)
                a, b = (np.searchsorted(x.unique[pending], u, side) for side in ("left", "right"))
                each = np.repeat(np.arange(len(u)), b - a)
                place = pending[_spread(a, b - a)]
                np.add.at(marks, x.start[place] + lo[each], 1)
                np.add.at(marks, x.start[place] + hi[each] + WIDTH - 1, -1)
            gone = np.cumsum(marks[:-1], dtype=np.int32) > 0
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            inner = chunk.offsets[:-1][chunk.offsets[:-1] < n]
            first[inner] = gone[inner]
            removed, spans = (np.concatenate([[0], np.cumsum(v, dtype=np.int64)])[chunk.offsets] for v in (gone, first))
            kept = chunk.data[~gone].tobytes()
            at = chunk.offsets - removed
            pieces = [kept[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if i == _LEAST else int(i) for i in chunk.ids], pa.int64()), pa.array(np.diff(chunk.offsets)), pa.array(np.diff(removed)), pa.array(np.diff(spans)),
                 pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string()), *([pa.array(pieces, pa.binary())] if with_kept else [])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_kept else [])])

    whole = with_told.join(answers(found, "found"), "chunk", "left_outer")
    return whole.mapInArrow(tidy(finish), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_kept else ""))


def _answer_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=["chunk", "bucket", "blob"])
