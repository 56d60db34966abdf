"""Counterfactual-regularised toxicity classifier."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import Words, materialize, ship, slices, tidy, utf8_column

BITS = 20
PREFIXES = (4, 5, 6)
#: Terms for groups of people; those of one line are exchanged.
IDENTITY = [
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic"],
    ["gay", "straight", "lesbian", "bisexual", "transgender"],
    ["woman", "man", "girl", "boy"],
    ["women", "men", "girls", "boys"],
    ["black", "white", "asian", "latino", "african", "european"],
    ["deaf", "blind", "disabled", "autistic"],
    ["immigrant", "refugee", "foreigner", "native"],
]
#: Labelled rows that are fitted on, at most: the bound of what reaches the driver.
MOST_ROWS = 8000
#: Neutral terms that are found in the labelled rows, at most, beside the fixed ones.
MOST_TERMS = 32


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature), each pair once: hashes of words and of the words'
    first bytes."""
    width = words.end - words.start
    doc, index = [words.doc], [words.hash >> np.uint64(64 - BITS)]
    for n in PREFIXES:
        at = np.flatnonzero(width > n)
        doc.append(words.doc[at])
        index.append(words.span_hash(words.start[at], words.start[at] + n) >> np.uint64(64 - BITS))
    pairs = np.unique((np.concatenate(doc).astype(np.uint64) << np.uint64(BITS)) | np.concatenate(index))
    return (pairs >> np.uint64(BITS)).astype(np.int64), (pairs & np.uint64((1 << BITS) - 1)).astype(np.int64)


class Swap:
    """Replaces each identity term by the next of its line, whatever its case."""

    def __init__(self, lines: list[list[str]]):
        self.next = {t: line[(i + 1) % len(line)] for line in lines for i, t in enumerate(line) if len(line) > 1}
        terms = sorted(self.next, key=len, reverse=True)
        self.term = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, terms)) + r")(?!\w)", re.IGNORECASE) if terms else None

    def __call__(self, text: str) -> str | None:
        """The counterpart of a text; None if it has no term."""
        if self.term is None:
            return None
        new, n = self.term.subn(lambda m: self.next.get(m[0].lower(), m[0]), text)
        return new if n else None


def neutral_terms(texts: DataFrame, most: int = MOST_TERMS) -> list[list[str]]:
    """Lines of two terms that a score should not depend on, from labelled texts
    (text, toxic): the words that mark a group of speakers rather than an insult
    are common, and as frequent among toxic texts as among others (a chi-square
    below 1). Of the words of letters in a hundredth of the texts at least, `most`
    of the most frequent ones, neighbours in frequency paired. The driver sees
    `most` words."""
    total = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    if not total["n"] or not 0 < total["t"] < total["n"]:
        return []
    words = texts.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{2,}"), F.lit(0)))).alias("word"))
    share = total["t"] / total["n"]
    gap = F.col("t") - F.col("n") * share
    found = words.groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).where(
        (F.col("n") * 100 >= total["n"]) & (F.col("n") >= 10) & (gap * gap < F.col("n") * (share * (1 - share))))
    kept = [x["word"] for x in found.orderBy(F.desc("n"), "word").limit(most).collect()]
    return [kept[i : i + 2] for i in range(0, len(kept) - 1, 2)]


@dataclass
class Model:
    """log-odds = bias + the sum of the weights of a text's distinct features.
    `pairs` counterfactual pairs were fitted, of terms in these `lines`."""

    weights: np.ndarray
    bias: float
    pairs: int = 0
    lines: tuple = ()

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, index = features(Words(data, offsets))
        z = self.bias + np.bincount(doc, self.weights[index], minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _feature_rows(texts: list[str]) -> list[list[int]]:
    out: list[list[int]] = []
    data, offsets = utf8_column(pa.array(texts, pa.string()))
    for a, b in slices(offsets):
        doc, index = features(Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
        cut = np.searchsorted(doc, np.arange(b - a + 1))
        out += [index[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]
    return out


def fit(rows: list[np.ndarray], labels: np.ndarray, deltas: list[tuple[np.ndarray, np.ndarray]], *, sparsity: float = 2e-5, fairness: float = 1.0, rounds: int = 300) -> Model:
    """Logistic loss with an L1 term, and `fairness` times the mean squared
    change of the log-odds between a text and its counterpart with identity
    terms exchanged. Full batches, so the same rows give the same weights."""
    weights = np.zeros(1 << BITS)
    share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.0
    bias = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))) if len(labels) else -10.0
    if not len(labels) or labels.min() == labels.max():
        return Model(weights, float(np.clip(bias, -10, -1) if share < 0.5 else bias))
    flat, size = np.concatenate(rows), np.array([len(r) for r in rows])
    doc = np.repeat(np.arange(len(rows)), size)
    n1 = np.bincount(flat, labels[doc], minlength=1 << BITS)
    n = np.bincount(flat, minlength=1 << BITS)
    # features that say something: a chi-square of label against presence
    expect = n * labels.mean()
    chi = (n1 - expect) ** 2 / np.maximum(expect * (1 - labels.mean()), 1e-9)
    used = np.flatnonzero((n >= 3) & (chi > 15))
    if not len(used):
        return Model(weights, bias, len(deltas))
    place = np.full(1 << BITS, -1)
    place[used] = np.arange(len(used))
    keep = place[flat] >= 0
    col, row = place[flat[keep]], doc[keep]
    changes = [(np.setdiff1d(b, a), np.setdiff1d(a, b)) for a, b in deltas]
    parts = [(np.full(len(x), i), place[x], np.full(len(x), s)) for i, pair in enumerate(changes) for x, s in zip(pair, (1.0, -1.0), strict=True)]
    d_row, d_col, d_val = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(3))
    ok = d_col >= 0
    d_row, d_col, d_val = d_row[ok].astype(int), d_col[ok].astype(int), d_val[ok]
    w, m, v = (np.zeros(len(used)) for _ in range(3))
    mb = vb = 0.0
    for t in range(1, rounds + 1):
        z = bias + np.bincount(row, w[col], minlength=len(rows))
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / len(rows)
        g = np.bincount(col, err[row], minlength=len(used))
        if len(changes):
            moved = np.bincount(d_row, d_val * w[d_col], minlength=len(changes))
            g += 2 * fairness / len(changes) * np.bincount(d_col, moved[d_row] * d_val, minlength=len(used))
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1
        scale = np.sqrt(v / (1 - 0.99**t)) + 1e-6
        w -= rate * (m / (1 - 0.9**t)) / scale
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * sparsity / scale.clip(2e-3))
        bias -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-6)
    weights[used] = w
    return Model(weights, float(bias), len(changes))


def train(docs: DataFrame, labels: DataFrame, held_out=None, most_rows: int = MOST_ROWS, lines: list[list[str]] | None = None, fairness: float = 1.0) -> Model:
    """Fit on at most `most_rows` labelled documents outside held_out (a Column
    over doc_id), the first in the order of a hash of doc_id. Only text and
    labels.toxic are used. Each document that has a term of `lines` (IDENTITY and
    the corpus's own neutral terms, if not given) has a counterpart with the
    terms exchanged. Labels that are null or not 0 or 1 don't count; of
    conflicting labels the higher holds; of rows that repeat a labelled doc_id the
    least text. Without both classes, or without rows, the model is a low
    constant."""
    ship(docs.sparkSession)
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    if held_out is not None:
        known = known.where(~held_out)
    sample = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    # at most most_rows rows of two numbers, whatever the tables; one text for each
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = materialize(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxic-sample")
    lines = [*IDENTITY, *neutral_terms(texts)] if lines is None else lines

    def run(batches):
        swap = Swap(lines)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            own = _feature_rows(texts)
            other = [swap(t) for t in texts]
            changed = iter(_feature_rows([t for t in other if t is not None]))
            moved = [(None, None) if t is None else (np.setdiff1d(a, b := next(changed)), np.setdiff1d(b, a)) for a, t in zip(own, other, strict=True)]
            lists = lambda rows: pa.array([None if x is None else x.astype(np.int32) for x in rows], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2).cast(pa.int32()), lists(own), *map(lists, zip(*moved, strict=True))], names=["doc_id", "toxic", "own", "less", "more"])

    got = texts.select("doc_id", "text", "toxic").mapInArrow(tidy(run), "doc_id long, toxic int, own array<int>, less array<int>, more array<int>").toArrow()
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable")
    numbers = lambda r: r.values.to_numpy().astype(np.int64)
    own = [numbers(r) for r in got["own"]]
    deltas = [(numbers(got["less"][int(i)]), numbers(got["more"][int(i)])) for i in order if got["less"][int(i)].is_valid]
    model = fit([own[i] for i in order], got["toxic"].to_numpy()[order].astype(float), deltas, fairness=fairness)
    model.lines = tuple(map(tuple, lines))
    return model


def score(docs: DataFrame, model: Model, keep_below: float | None = None) -> DataFrame:
    """The rows of docs with `score`, a double in 0 to 1 (a column of that name
    is replaced); with keep_below, only the rows scored below it, without the
    column. Null or empty text has the score of no words; repeated rows are scored
    each; an empty table gives no rows; other columns are kept."""
    spark = docs.sparkSession
    ship(spark)
    names = [c for c in docs.columns if c != "score" or keep_below is not None]
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))  # 4 MB, whatever the data
    schema = docs.select(*names).schema
    out = schema if keep_below is not None else schema.__class__(list(schema.fields)).add("score", "double")

    def run(batches):
        weights, bias = shared.value
        own = Model(weights, bias)
        for batch in batches:
            data, offsets = utf8_column(batch.column(names.index("text")))
            s = np.concatenate([own.score(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)] or [np.zeros(0)])
            if keep_below is not None:
                yield batch.filter(pa.array(s < keep_below))
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*names, "score"])

    return docs.select(*names).mapInArrow(tidy(run), out)
