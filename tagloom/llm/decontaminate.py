"""Benchmark decontamination: rare words near each other, then Smith-Waterman."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import Words, ship, slices, tidy, utf8_column

SIMILARITY = 0.8
#: Scores of the alignment: an equal word, another word, a word left out.
MATCH, OTHER, GAP = 1.0, -0.25, -0.25
#: Benchmark words that one pass over the documents takes along.
PASS_WORDS = 2_000_000
#: Seeds of an item that any copy at the limit holds, at least.
NEAR = 3
#: Places of hits that are worked on at once; a longer document is taken alone.
PLACES = 1 << 20


@dataclass
class Items:
    """Benchmark items of one pass: word hashes of each, and the seeds."""

    ids: np.ndarray
    words: np.ndarray  # of all items, one after the other
    first: np.ndarray  # offsets
    grams: np.ndarray  # distinct seeds, ascending
    at: np.ndarray  # (gram, item, position) for every place of a seed, by gram
    item: np.ndarray
    pos: np.ndarray

    def keep(self, good: np.ndarray) -> Items:
        """With those places alone."""
        grams = np.unique(self.at[good])
        return Items(self.ids, self.words, self.first, grams, self.at[good], self.item[good], self.pos[good])


def load_items(rows: list[tuple[int, str]]) -> Items:
    """The items with every word as a seed."""
    data, offsets = utf8_column(pa.array([t or "" for _, t in rows], pa.string()))
    words = Words(data, offsets)
    order = np.argsort(words.hash, kind="stable")
    pos = np.arange(len(words.hash)) - words.first[words.doc]
    return Items(np.array([i for i, _ in rows], np.int64), words.hash, words.first, np.unique(words.hash), words.hash[order], words.doc[order], pos[order])


def hits(words: Words, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(gram's index, word) of every seed in the documents."""
    if not len(items.grams):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = np.minimum(np.searchsorted(items.grams, words.hash), len(items.grams) - 1)
    found = np.flatnonzero(items.grams[k] == words.hash)
    return k[found], found


def missing(length):
    """How many of an item's words a copy at the limit may lack: each costs its
    own point at least, whatever the edit. Inserted words take none away."""
    return np.floor((1 - SIMILARITY) * np.asarray(length) + 1e-9).astype(np.int64)


def inserted(length):
    """How many words a copy at the limit may have between the item's words."""
    return np.floor((1 - SIMILARITY) / -GAP * np.asarray(length) + 1e-9).astype(np.int64)


def least_near(length):
    """How many seeds of an item any copy at the limit holds."""
    return np.minimum(NEAR, length - missing(length))


def rare_seeds(items: Items, frequency: np.ndarray) -> Items:
    """The rarest words of each item, so many that any copy at the limit holds
    least_near() of them."""
    f = frequency[np.searchsorted(items.grams, items.at)] if len(items.at) else np.zeros(0)
    order = np.lexsort((items.pos, f, items.item))
    size = np.diff(items.first)
    rank = np.arange(len(order)) - items.first[items.item[order]]
    good = np.zeros(len(order), bool)
    good[order] = rank < (missing(size) + least_near(size))[items.item[order]]
    return items.keep(good)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment (Smith-Waterman): score over the item's words, and
    the passage's words [start, end) that it takes."""
    n, m = len(item), len(passage)
    row, origin = np.zeros(m + 1), np.arange(m + 1)
    best = (0.0, 0, 0)
    index = np.arange(m + 1)
    for w in item:
        step = np.where(passage == w, MATCH, OTHER)
        diagonal, above = row[:-1] + step, row[1:] + GAP
        new = np.maximum(0, np.maximum(diagonal, above))
        start = np.where(new == 0, index[1:], np.where(diagonal >= above, origin[:-1], origin[1:]))
        # gaps in the item: the best cell to the left, less a gap for each word
        lifted = np.concatenate([[0.0], new]) - GAP * index
        from_left = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == from_left, index, 0))
        score = from_left + GAP * index
        begin = np.concatenate([[0], start])[source]
        row, origin = score, np.where(score > 0, begin, index)
        j = int(np.argmax(row))
        if row[j] > best[0] + 1e-9:
            best = (float(row[j]), int(origin[j]), j)
    return best[0] / max(1, n), best[1], best[2]


def leaks_in(words: Words, items: Items) -> list[tuple[int, int, float, int, int]]:
    """(document, item's index, similarity, first word, end word) of the best
    copy of each item in each document, at SIMILARITY or more."""
    k, at = hits(words, items)
    lo, hi = np.searchsorted(items.at, items.grams[k]), np.searchsorted(items.at, items.grams[k], "right")
    # documents by the places of their hits: a common word stands in many items
    ends = np.cumsum(hi - lo)
    cut = np.searchsorted(at, words.first)
    total = np.concatenate([[0], ends])[cut]
    out, a = [], 0
    while a < words.rows:
        b = max(a + 1, int(np.searchsorted(total, total[a] + PLACES, "right")) - 1)
        out += _leaks(words, items, at[cut[a] : cut[b]], lo[cut[a] : cut[b]], hi[cut[a] : cut[b]])
        a = b
    return out


def _near(doc: np.ndarray, item: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which hits, ordered by (doc, item, at), stand with as many of the same
    item as a copy holds, within the words that a copy may span."""
    near = np.zeros(len(at) + 1, np.int64)
    need = least_near(size)
    span = size + inserted(size)
    for n in range(1, NEAR + 1):
        i = np.flatnonzero(need == n)
        i = i[i + n <= len(at)]
        j = i + n - 1
        i = i[(doc[i] == doc[j]) & (item[i] == item[j]) & (at[j] - at[i] < span[i])]
        np.add.at(near, i, 1)
        np.add.at(near, i + n, -1)
    return np.cumsum(near[:-1]) > 0


def _leaks(words: Words, items: Items, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int, float, int, int]]:
    """leaks_in for the hits of some documents, each with its places [lo, hi).
    Hits of an item that stand near each other share a region, which is aligned
    once; a region spans all words of any copy that has its hit."""
    each = np.repeat(np.arange(len(at)), hi - lo)
    place = np.arange(len(each)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[each]
    item, pos, at = items.item[place], items.pos[place], at[each]
    doc = words.doc[at]
    order = np.lexsort((at, item, doc))
    item, pos, at, doc = item[order], pos[order], at[order], doc[order]
    size = np.diff(items.first)[item]
    good = _near(doc, item, at, size)
    item, pos, at, doc, size = item[good], pos[good], at[good], doc[good], size[good]
    slack = inserted(size)
    start = np.maximum(words.first[doc], at - pos - slack)
    end = np.minimum(words.first[doc + 1], at - pos + size + slack)
    order = np.lexsort((start, item, doc))
    doc, item, start, end = doc[order], item[order], start[order], end[order]
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    known: dict[tuple[int, bytes], tuple[float, int, int]] = {}
    i = 0
    while i < len(doc):
        j, stop = i + 1, end[i]
        # regions that overlap become one, up to four times the item's length
        while j < len(doc) and doc[j] == doc[i] and item[j] == item[i] and start[j] < stop and end[j] - start[i] <= 4 * len_of(items, item[i]) + 8:
            stop = max(stop, end[j])
            j += 1
        passage = words.hash[start[i] : stop]
        key = (int(item[i]), passage.tobytes())
        if key not in known:
            if len(known) > 50_000:
                known.clear()
            own = items.words[items.first[item[i]] : items.first[item[i] + 1]]
            some = np.isin(own, passage).sum() >= len(own) - missing(len(own))
            known[key] = align(own, passage) if some else (0.0, 0, 0)
        s, a, b = known[key]
        pair = (int(doc[i]), int(item[i]))
        if s >= SIMILARITY - 1e-9 and s > best.get(pair, (0.0,))[0]:
            base = int(start[i] - words.first[doc[i]])
            best[pair] = (s, base + a, base + b)
        i = j
    return [(d, it, *v) for (d, it), v in best.items()]


def len_of(items: Items, i: int) -> int:
    return int(items.first[i + 1] - items.first[i])


def _each_slice(batch, column: str):
    data, offsets = utf8_column(batch.column(column))
    for a, b in slices(offsets):
        yield a, b, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def _passes(docs: DataFrame, benchmark: DataFrame) -> list:
    """The benchmark as broadcast seeds, in as many passes as its words need: a
    pass never takes more than PASS_WORDS words (and one item at least)."""
    spark = docs.sparkSession
    ship(spark)
    texts = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text", F.size(F.split("text", r"[\x20\x09-\x0D]+")).cast("long").alias("n"))
    total = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    count = max(1, -(-total // PASS_WORDS))
    out = []
    for p in range(count):
        rows = [(r[0], r[1]) for r in texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == p).select("item_id", "text").distinct().orderBy("item_id", "text").toLocalIterator()]
        items = load_items(rows)
        shared = spark.sparkContext.broadcast(items)

        def count_seeds(batches, shared=shared):
            items = shared.value
            total = np.zeros(len(items.grams), np.int64)
            for batch in batches:
                for _, _, words in _each_slice(batch, "text"):
                    total += np.bincount(hits(words, items)[0], minlength=len(total))
            k = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], names=["k", "n"])

        counted = docs.select("text").mapInArrow(tidy(count_seeds), "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
        frequency = np.zeros(len(items.grams), np.int64)
        for k, n in counted.collect():  # as many as the pass has seeds, at most
            frequency[k] = n
        out.append(spark.sparkContext.broadcast(rare_seeds(items, frequency)))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, end_word): the best copy of each
    benchmark item (item_id, text) in each document (doc_id, text) that holds
    one at a similarity of 0.8 or more, positions in words of the document.

    Similarity is the best local alignment of an item's words over their number,
    with 1 for an equal word and -0.25 for a substituted, added or missing one.
    Seeds are single words. A copy at the limit may lack a fifth of the item's
    words, so of the item's rarest words among the documents, a fifth and three
    more, it holds three within the words that it can span (an item of fewer
    words: all that it must hold). Alignment sees every region with so many, so
    the result is that of aligning each item with each whole document.

    The benchmark is broadcast in passes of bounded size, documents are not
    shuffled. Null texts are empty, an empty item or one without words matches
    nothing, null item_id is left out; repeated items and rows give a row each,
    empty tables none; other columns are ignored.
    """
    schema = "doc_id long, item_id long, similarity double, start_word long, end_word long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for shared in _passes(docs, benchmark):

        def run(batches, shared=shared):
            items = shared.value
            for batch in batches:
                ids = batch.column("doc_id")
                for a, _, words in _each_slice(batch, "text"):
                    found = leaks_in(words, items)
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array([a + f[0] for f in found])), pa.array([int(items.ids[f[1]]) for f in found]), pa.array([f[2] for f in found]),
                             pa.array([f[3] for f in found]), pa.array([f[4] for f in found])],
                            names=["doc_id", "item_id", "similarity", "start_word", "end_word"])

        part = rows.mapInArrow(tidy(run), schema)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that hold no copy of a benchmark item."""
    for shared in _passes(docs, benchmark):

        def run(batches, shared=shared):
            items = shared.value
            for batch in batches:
                keep = np.ones(len(batch), bool)
                for a, _, words in _each_slice(batch, "text"):
                    for f in leaks_in(words, items):
                        keep[a + f[0]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(tidy(run), docs.schema)
    return docs
