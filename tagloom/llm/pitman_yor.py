"""Hierarchical Pitman-Yor language model over a distributed corpus."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.chunks import _LEAST, answers, bucket_rows, bucketed, buckets_for, by_bucket, chunk_table, chunks_of, rows_batch
from tagloom.llm.common import Words, materialize, parts_of, slices, tidy

#: Contexts that one row of an exchange holds at most.
CONTEXTS = 1 << 14
#: Discounts and strengths of the context restaurants and of their parent.
DISCOUNT, STRENGTH = 0.75, 5.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.8, 10.0
#: Sweeps before a round's samples, and samples that the scores are averaged over.
BURN, SAMPLES = 2, 3
#: Customers of a dish up to which its tables are drawn from the listed law, and
#: up to which the seating numbers are tabled; steps of the chain beyond.
LISTED, TABLED, STEPS = 64, 1024, 4
CHUNK = 9 << 20
BUCKET = 8 << 20
#: Steps in a power of ten to which a token's log10 probability is rounded when it
#: is sent back to the texts.
FINE = 1 << 16
END = np.uint64(0x3C6EF372FE94F82B)


# ------------------------------------------------------------------ seating

def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function, for positive x."""
    y = x + 8
    low = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    r = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y - np.log(low)


class Seatings:
    """log S(c, t): ways to seat c customers of a dish at t tables, each weighed
    by its discounted seating probabilities; S(c+1, t) = S(c, t-1) + (c - d t) S(c, t).

    Up to TABLED customers by this rule. Beyond, with few tables (t below some
    c^d) by the finite sum over j of (-1)^j C(t, j) Gamma(c - j d) / Gamma(-j d),
    which then ends early; with many by the saddle point of the generating
    function ((1 - (1 - z)^d) / d)^t, to about a hundredth."""

    FEW, TERMS = 2.2, 128

    def __init__(self, discount: float):
        self.d = discount
        s = np.full((TABLED + 1, TABLED + 1), -np.inf)
        s[1, 1] = 0.0
        for c in range(1, TABLED):
            t = np.arange(1, c + 2)
            with np.errstate(divide="ignore"):
                stay = np.where(t <= c, np.log(np.maximum(c - discount * t, 1e-300)) + s[c, t], -np.inf)
            s[c + 1, t] = np.logaddexp(s[c, t - 1], stay)
        self.table = s
        j = np.arange(1, self.TERMS + 1)
        # -(-1)^j Gamma(1 + j d) sin(pi j d) / pi / j!, from 1 / Gamma(-x) = -Gamma(1 + x) sin(pi x) / pi
        self.sign = -((-1.0) ** j) * np.sin(np.pi * j * discount)
        self.sign[np.abs(self.sign) < 1e-9] = 0
        self.fixed = np.array([math.lgamma(1 + k * discount) - math.lgamma(1 + k) - math.log(math.pi) for k in j]) + np.log(np.maximum(np.abs(self.sign), 1e-300))

    def log(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        out = np.empty(len(c))
        small = c <= TABLED
        out[small] = self.table[c[small].astype(int), t[small].astype(int)]
        few = ~small & (t < self.FEW * c**self.d)
        out[few] = self._sum(c[few], t[few])
        many = ~small & ~few
        out[many] = self._saddle(c[many], t[many])
        return out

    def _sum(self, c, t):
        total, top = np.zeros(len(c)), log_gamma(c - self.d)
        alive = np.arange(len(c))
        for k in range(1, self.TERMS + 1):
            alive = alive[(t[alive] >= k) & (self.d * k < c[alive])]
            if not len(alive):
                break
            n, m = t[alive], c[alive]
            # t! / (t - k)! stands for the binomial's upper part
            size = self.fixed[k - 1] + log_gamma(n + 1) - log_gamma(n - k + 1) + log_gamma(m - self.d * k) - top[alive]
            term = np.sign(self.sign[k - 1]) * np.exp(size)
            total[alive] += term
            if k > 4 and self.sign[k - 1]:
                alive = alive[np.exp(size) > 1e-13 * np.abs(total[alive])]
        return np.log(np.maximum(total, 1e-300)) + top - t * math.log(self.d) - log_gamma(t + 1)

    def _saddle(self, c, t):
        d, ratio = self.d, np.maximum(c / t, 1 + 1e-9)
        low, high = np.full(len(c), -60.0), np.full(len(c), -1e-12)
        for _ in range(60):
            x = (low + high) / 2
            u = np.exp(x)
            over = d * -np.expm1(x) * u ** (d - 1) > ratio * -np.expm1(d * x)
            low, high = np.where(over, x, low), np.where(over, high, x)
        u, z, g = np.exp(x), -np.expm1(x), -np.expm1(d * x) / d
        mean = z * u ** (d - 1) / g
        spread = mean + z * z * (1 - d) * u ** (d - 2) / g - mean * mean
        return log_gamma(c + 1) - log_gamma(t + 1) + t * np.log(g) - c * np.log(z) - 0.5 * np.log(2 * np.pi * t * np.maximum(spread, 1e-12))


_SEATINGS: dict[float, Seatings] = {}


def seatings(discount: float) -> Seatings:
    if discount not in _SEATINGS:
        _SEATINGS[discount] = Seatings(discount)
    return _SEATINGS[discount]


def draw_tables(rng, customers: np.ndarray, new_weight: np.ndarray, others: np.ndarray, discount: float, strength: float, start=None, guide=None) -> np.ndarray:
    """Gibbs step for each dish of a restaurant: its customers leave and are
    seated anew, given the tables of the other dishes (`others`) and the parent's
    probability of the dish (`new_weight`). The seating of a dish matters through
    its number of tables alone, whose law is the product of the seating weights
    S(c, t), of opening t tables and of the parent serving the dish t times.

    The law is the same for any number of customers. Up to LISTED it is written
    out and drawn from; beyond, an independence chain of STEPS proposals from a
    logistic law about the weights' mode, accepted by the exact ratio of the
    weights, draws from it. The chain begins at `start` (at the mode if none);
    `guide`, an array of two rows, keeps place and width of the proposals from one
    sweep for the next (NaN: not known yet)."""
    s = seatings(discount)
    tables = np.ones(len(customers))
    order = np.argsort(customers, kind="stable")
    cut = np.searchsorted(customers[order], np.arange(LISTED + 2))
    log_new = np.log(new_weight)
    for c in range(2, LISTED + 1):
        i = order[cut[c] : cut[c + 1]]
        for part in np.array_split(i, max(1, len(i) * c >> 20)) if len(i) else []:
            t = np.arange(1, c + 1)
            opened = np.cumsum(np.log(strength + discount * (others[part, None] + np.arange(c)[None, :])), axis=1)
            weight = s.table[c, 1 : c + 1] + opened + t * log_new[part, None]
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            tables[part] = 1 + (weight < rng.random(len(part))[:, None] * weight[:, -1:]).sum(axis=1)
    big = order[cut[LISTED + 1] :]
    if len(big):
        c, opened = customers[big], strength / discount + others[big]
        guide = np.full((2, len(customers)), np.nan) if guide is None else guide
        new = np.isnan(guide[0, big])
        guide[:, big[new]] = _about(discount, c[new], log_new[big[new]], opened[new])
        mode, width = np.clip(guide[0, big], 1, c), guide[1, big]
        tables[big] = _chain(rng, s, c, log_new[big], opened, np.round(mode) if start is None else np.where(new, np.round(mode), start[big]), mode, width)
    return tables


def _about(d: float, c: np.ndarray, log_new: np.ndarray, opened: np.ndarray) -> np.ndarray:
    """Place and width of the law of tables, about: where another table is as
    likely as not, by the slope of the saddle point's log S."""

    def at(x):
        u = np.exp(x)
        t = np.clip(c * -np.expm1(d * x) / (d * -np.expm1(x) * u ** (d - 1)), 1e-3, c)
        return t, np.log(-np.expm1(d * x) * (opened + t) / t) + log_new

    low, high = np.full(len(c), -60.0), np.full(len(c), -1e-9)
    for _ in range(40):
        x = (low + high) / 2
        rising = at(x)[1] > 0
        low, high = np.where(rising, x, low), np.where(rising, high, x)
    t, _ = at(x)
    (t1, h1), (t2, h2) = at(x * 1.01), at(x * 0.99)
    bend = np.abs(h2 - h1) / np.maximum(np.abs(t2 - t1), 1e-9)
    mode = np.clip(t + 1, 1, c)  # the slope is that from t to t + 1, and the law leans to the right
    return np.stack([mode, np.clip(0.75 / np.sqrt(np.maximum(bend, 1e-9)), 0.6, np.maximum(2.0, 2 * np.sqrt(mode)))])


def _chain(rng, s: Seatings, c, log_new, opened, start, mode, width) -> np.ndarray:
    base = log_gamma(opened)
    law = lambda t: s.log(c, t) + log_gamma(opened + t) - base + t * (log_new + math.log(s.d))
    edge = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    def mass(t):
        # of the logistic law between t - 1/2 and t + 1/2, on the side where it does not cancel
        x, h = np.abs(t - mode) / width, 0.5 / width
        return np.log(np.maximum(edge(h - x) - edge(-h - x), 1e-300))

    t = np.clip(start, 1, c)
    weight = law(t) - mass(t)
    for _ in range(STEPS):
        u = np.maximum(rng.random(len(c)), 1e-16)
        found = np.round(mode + width * np.log(u / np.maximum(1 - u, 1e-16)))
        inside = (found >= 1) & (found <= c)
        found = np.where(inside, found, t)
        other = law(found) - mass(found)
        taken = inside & (np.log(np.maximum(rng.random(len(c)), 1e-300)) < other - weight)
        t, weight = np.where(taken, found, t), np.where(taken, other, weight)
    return t


# ------------------------------------------------------------------ blobs

def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays in a compressed blob, each by the bytes' places: of ascending or
    small numbers most of the upper ones are zeros."""
    raw = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"" for a in arrays)
    return np.array([len(raw)], "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


class _Reader:
    """The arrays of a blob, one after the other."""

    def __init__(self, blob: bytes):
        size = int(np.frombuffer(blob, "<i8", 1)[0])
        self.raw, self.at = pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True), 0

    def take(self, kind: str, n: int) -> np.ndarray:
        width = np.dtype(kind).itemsize
        out = np.frombuffer(self.raw, np.uint8, n * width, self.at).reshape(width, n).T
        self.at += n * width
        return np.ascontiguousarray(out).view(kind).reshape(n)


class Bucket:
    """The dishes (words) of a hash bucket, by rank, and the pairs (word, context)
    with their customers: words ascending, contexts ascending within. `context` is
    a place in `contexts`, the numbers of all preceding words here, ascending.
    Pairs of held-out documents alone have no customers."""

    def __init__(self, blob: bytes):
        r = _Reader(blob)
        n, m, k = (int(x) for x in r.take("<i8", 3))
        self.size = r.take("<i8", n)
        self.contexts = np.cumsum(r.take("<u8", k), dtype=np.uint64)
        self.count = r.take("<i8", m).astype(np.float64)
        self.context = r.take("<u4", m).astype(np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.of = np.repeat(np.arange(n), self.size)

    @staticmethod
    def pack(size, count, context, contexts) -> bytes:
        head = np.array([len(size), len(context), len(contexts)], "<i8")
        return _packed(head, size.astype("<i8"), np.diff(contexts.astype("<u8"), prepend=np.uint64(0)), count.astype("<i8"), context.astype("<u4"))

    def by_context(self, values) -> np.ndarray:
        """Sums of the pairs' values for each of `contexts`."""
        return np.bincount(self.context, values, minlength=len(self.contexts))

    def by_word(self, values) -> np.ndarray:
        return np.add.reduceat(values, self.first) if len(self.first) else np.zeros(0)


class Totals:
    """What a bucket needs to know of the others: the customers and tables of
    its context restaurants, of the root, tokens and distinct words."""

    def __init__(self, customers, tables, root_customers, root_tables, tokens, words):
        self.customers, self.tables = customers, tables
        self.root_customers, self.root_tables = root_customers, root_tables
        self.tokens, self.words = tokens, words

    def root(self, customers, tables) -> np.ndarray:
        """The parent's probability of dishes with so many customers and tables."""
        back = (ROOT_STRENGTH + ROOT_DISCOUNT * self.root_tables) / (self.words + 1)
        return (customers - ROOT_DISCOUNT * tables + back) / (ROOT_STRENGTH + self.root_customers)

    def pair(self, count, tables, context, root) -> np.ndarray:
        back = (STRENGTH + DISCOUNT * self.tables[context]) * root
        return (count - DISCOUNT * tables + back) / (STRENGTH + self.customers[context])


def opening(bucket: Bucket) -> tuple[np.ndarray, np.ndarray]:
    """The first seating: one table for each pair and each word."""
    tables = np.minimum(bucket.count, 1)
    return tables, np.minimum(bucket.by_word(tables), 1)


def sample(seed: tuple[int, int], bucket: Bucket, totals: Totals, state: tuple[np.ndarray, np.ndarray], burn: int, samples: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tables of the pairs, customers and tables of the root's dishes) of each of
    `samples` sweeps after `burn`, going on from the seating `state` (tables of
    pairs and of words) that the totals hold. Seeded by bucket and round: a task
    that runs again draws the same. Restaurants that reach over buckets count the
    tables elsewhere as they were when the round began."""
    rng = np.random.default_rng([20240229, *seed])
    tables, root_tables = state[0].copy(), state[1].copy()
    root_customers = bucket.by_word(tables)
    away = totals.tables - bucket.by_context(tables)
    away_customers, away_tables = totals.root_customers - root_customers.sum(), totals.root_tables - root_tables.sum()
    more, kept = np.flatnonzero(bucket.count > 1), []
    guide, root_guide = np.full((2, len(more)), np.nan), np.full((2, len(root_tables)), np.nan)
    for sweep in range(burn + samples):
        now = Totals(totals.customers, None, away_customers + root_customers.sum(), away_tables + root_tables.sum(), totals.tokens, totals.words)
        p = now.root(root_customers, root_tables)
        others = np.maximum(0, (away + bucket.by_context(tables))[bucket.context[more]] - tables[more])
        tables[more] = draw_tables(rng, bucket.count[more], p[bucket.of[more]], others, DISCOUNT, STRENGTH, tables[more], guide)
        root_customers = bucket.by_word(tables)
        some = np.flatnonzero(root_customers > 1)
        others = np.maximum(0.0, away_tables + root_tables.sum() - root_tables[some])
        before, root_tables, own = root_tables[some], np.minimum(root_customers, 1), root_guide[:, some]
        root_tables[some] = draw_tables(rng, root_customers[some], np.full(len(some), 1 / (totals.words + 1)), others, ROOT_DISCOUNT, ROOT_STRENGTH, before, own)
        root_guide[:, some] = own
        if sweep >= burn:
            kept.append((tables.copy(), root_customers, root_tables))
    return kept


# ------------------------------------------------------------------ tokens

def held_out_id(doc_id: int) -> bool:
    return doc_id != _LEAST and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Tokens:
    """A chunk's tokens, an END after each document: `word` (hash), `doc`; its
    distinct `words` by hash with training `counts`, and `which` of them a token is."""

    def __init__(self, chunk, bits: int):
        parts, docs = [], []
        for a, b in slices(chunk.offsets):
            w = Words(chunk.data[chunk.offsets[a] : chunk.offsets[b]], chunk.offsets[a : b + 1] - chunk.offsets[a])
            parts.append(w.hash)
            docs.append(w.doc + a)
        hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        rows = len(chunk.ids)
        word = np.full(len(hashes) + rows, END)
        word[np.arange(len(hashes)) + doc] = hashes
        self.sizes = np.bincount(doc, minlength=rows) + 1
        self.doc = np.repeat(np.arange(rows), self.sizes)
        self.words, which = np.unique(word, return_inverse=True)
        self.which = which.astype(np.int64)
        self.held_out = np.array([held_out_id(int(i)) for i in chunk.ids], bool)
        self.learnt = ~self.held_out[self.doc]
        self.counts = np.bincount(self.which, self.learnt, minlength=len(self.words)).astype(np.int64)
        self.bucket = (self.words >> np.uint64(64 - bits)).astype(np.int64)
        #: where each bucket's words begin
        self.cut = np.searchsorted(self.bucket, np.arange((1 << bits) + 1))


class Pairs:
    """The distinct pairs of a chunk, by word and number of the preceding word: a
    word's number is its bucket and its rank there. `index` is the pair of every
    token."""

    def __init__(self, t: Tokens, told: list[dict]):
        self.rank, self.known = np.zeros(len(t.words), np.int64), np.zeros(len(t.words), np.int64)
        for x in told or []:
            a, b = t.cut[x["bucket"]], t.cut[x["bucket"] + 1]
            r = _Reader(x["blob"])
            self.rank[a:b] = np.cumsum(r.take("<u4", b - a), dtype=np.int64)
            self.known[a:b] = r.take("<i8", b - a)
        # words are in order of their hashes, and so are their numbers
        before = np.concatenate([np.searchsorted(t.words, [END]), t.which[:-1]]) if len(t.which) else t.which
        pairs, self.index = np.unique((t.which << 32) | before, return_inverse=True)
        self.word, context = pairs >> 32, pairs & 0xFFFFFFFF
        self.context = (t.bucket[context].astype(np.uint64) << np.uint64(32)) | self.rank[context].astype(np.uint64)
        self.counts = np.bincount(self.index, t.learnt, minlength=len(pairs)).astype(np.int64)
        self.cut = np.searchsorted(self.word, t.cut)


def _words_of(rows: list[dict]) -> list[bytes]:
    """For each question (words, training counts) of a bucket: the words' ranks
    among all words of the bucket, as steps, and their counts everywhere."""
    words, counts = [], []
    for row in rows:
        r = _Reader(row["blob"])
        n = int(r.take("<i8", 1)[0])
        words.append(np.cumsum(r.take("<u8", n), dtype=np.uint64))
        counts.append(r.take("<i8", n))
    every, rank = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(rank, np.concatenate(counts), minlength=len(every)).astype("<i8")
    cuts = np.cumsum([len(w) for w in words])[:-1]
    return [_packed(np.diff(x, prepend=0).astype("<u4"), total[x]) for x in np.split(rank, cuts)]


def _question(rank, sizes, contexts, counts) -> bytes:
    head = np.array([len(rank), len(contexts)], "<i8")
    return _packed(head, np.diff(rank, prepend=0).astype("<u4"), sizes.astype("<i8"), contexts.astype("<u8"), counts.astype("<i8"))


def _merged(questions: list[bytes]) -> tuple[bytes, list[bytes]]:
    """A bucket's pairs over all chunks with their training counts, and the pairs
    of each question: ascending places among them, as steps."""
    word, context, count = [], [], []
    for q in questions:
        r = _Reader(q)
        n, m = (int(x) for x in r.take("<i8", 2))
        rank = np.cumsum(r.take("<u4", n), dtype=np.int64)
        word.append(np.repeat(rank, r.take("<i8", n)))
        context.append(r.take("<u8", m))
        count.append(r.take("<i8", m))
    ends = np.cumsum([len(c) for c in context])
    word = np.concatenate(word)
    contexts, at = np.unique(np.concatenate(context), return_inverse=True)
    pairs, index = np.unique((word << 32) | at, return_inverse=True)
    counts = np.bincount(index, np.concatenate(count), minlength=len(pairs)).astype(np.int64)
    # every word of the bucket stands in some question: ranks have no gaps
    merged = Bucket.pack(np.bincount(pairs >> 32), counts, pairs & 0xFFFFFFFF, contexts)
    return merged, [_packed(np.diff(x, prepend=0).astype("<u4")) for x in np.split(index, ends[:-1])]


# ------------------------------------------------------------------ the job

def _exchange(rows: DataFrame, bits: int, per_bucket) -> tuple[DataFrame, np.ndarray]:
    """Totals of the context restaurants over all buckets: per_bucket(row, Bucket)
    gives the tables of the pairs in some samples, the sums of the root's customers
    and tables in each, two further numbers, and the bucket's seating. Each context
    belongs to a range of buckets' numbers, which adds up what the buckets send and
    gives each its own contexts' customers and tables back. Returns (bucket,
    totals: its seating and the pieces in order), and the sum of the numbers, which
    is all that the driver sees."""
    parts = max(16, 1 << bits >> 5)
    shift = np.uint64(32 + bits - (parts.bit_length() - 1)) if parts <= 1 << bits else np.uint64(32)

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Bucket(row["merged"])
                samples, rest, state = per_bucket(row, b)
                sums = [b.by_context(v).astype("<i8") for v in (b.count, *samples)]
                cut = np.searchsorted((b.contexts >> shift).astype(np.int64), np.arange(parts + 1))
                to, at, blobs = [parts, row["bucket"] % parts], [0, -1], [_packed(np.asarray(rest, "<f8")), _packed(*[x.astype("<i8") for x in state])]
                for p in range(parts):
                    for i in range(cut[p], cut[p + 1], CONTEXTS):
                        own = slice(i, min(i + CONTEXTS, cut[p + 1]))
                        to.append(p)
                        at.append(i)
                        contexts = b.contexts[own]
                        blobs.append(_packed(np.array([len(contexts), len(sums)], "<i8"), np.diff(contexts, prepend=np.uint64(0)), *[s[own] for s in sums]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["bucket"]] * len(to)), pa.array(to), pa.array(at, pa.int64()), pa.array(blobs, pa.binary())], names=["chunk", "bucket", "at", "blob"])

    def add(batches):
        for part, got in bucket_rows(batches):
            if part == parts:
                raw = [_Reader(r["blob"]) for r in got]
                to, at, blobs = [-1], [0], [_packed(np.sum([r.take("<f8", len(r.raw) // 8) for r in raw], axis=0))]
            else:
                held, got = [r for r in got if r["at"] < 0], [r for r in got if r["at"] >= 0]
                to, at, blobs = [r["chunk"] for r in held], [-1] * len(held), [r["blob"] for r in held]
                contexts, sums = [], []
                for row in got:
                    r = _Reader(row["blob"])
                    n, k = (int(x) for x in r.take("<i8", 2))
                    contexts.append(np.cumsum(r.take("<u8", n), dtype=np.uint64))
                    sums.append([r.take("<i8", n) for _ in range(k)])
                if got:
                    every, which = np.unique(np.concatenate(contexts), return_inverse=True)
                    total = [np.bincount(which, np.concatenate([s[i] for s in sums]), minlength=len(every)).astype("<i8") for i in range(len(sums[0]))]
                    for row, x in zip(got, np.split(which, np.cumsum([len(c) for c in contexts])[:-1]), strict=True):
                        to.append(row["chunk"])
                        at.append(row["at"])
                        blobs.append(_packed(np.array([len(x), len(total)], "<i8"), *[t[x] for t in total]))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(at, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "at", "blob"])

    sent = rows.mapInArrow(tidy(send), "chunk long, bucket long, at long, blob binary")
    found = materialize(by_bucket(sent).mapInArrow(tidy(add), "bucket long, at long, blob binary"), "totals")
    rest = [_Reader(bytes(r["blob"])) for r in found.where("bucket < 0").collect()]  # one row
    given = found.where("bucket >= 0").groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("at", "blob"))).alias("totals"))
    return given, rest[0].take("<f8", len(rest[0].raw) // 8) if rest else np.zeros(2 + 2 * SAMPLES)


def _totals(pieces: list[dict], b: Bucket, samples: int = 0):
    """A bucket's seating (with samples, what it drew in each), and the customers
    and tables (in each sample) of its contexts."""
    r = _Reader(pieces[0]["blob"])
    pairs, words = (lambda: r.take("<i8", len(b.count)).astype(np.float64)), (lambda: r.take("<i8", len(b.size)).astype(np.float64))
    state = [(pairs(), words(), words()) for _ in range(samples)] if samples else (pairs(), words())
    sums = []
    for x in pieces[1:]:
        r = _Reader(x["blob"])
        n, k = (int(y) for y in r.take("<i8", 2))
        sums.append([r.take("<i8", n).astype(np.float64) for _ in range(k)])
    customers, *tables = (np.concatenate(x) for x in zip(*sums, strict=True))
    return state, customers, tables


def score_documents(docs: DataFrame, chunk_bytes: int = CHUNK, bucket_bytes: int = BUCKET) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    each row of docs (doc_id, text); the model learns from the rows outside
    held_out (crc32(doc_id as text) mod 7 is 2).

    Two levels: a restaurant for each preceding word, whose new tables are
    customers of one common parent over words, whose new tables are drawn from
    1 / (V + 1). Chunks of texts send their distinct words to hash buckets and
    learn each word's rank there, so that a pair travels as two small numbers; then
    their distinct pairs go to the buckets of the second word. A bucket holds every
    restaurant's seating for its words, so Gibbs sweeps run in all buckets at once.
    Between rounds (one to settle, one to sample, which goes on from the seating of
    the first) the restaurants' totals are added up in ranges of contexts and joined
    to the buckets that have the context. Each sample gives every pair a predictive
    probability, with that sample's totals, so that a context's sum to one; scores
    take their mean over the samples. Buckets answer each chunk's own questions.
    The driver sees sums of eight numbers; nothing is broadcast. A frequent word's
    pairs stay in one bucket.

    Null text is empty (its END is scored); null doc_id is never held out;
    repeated rows count and are scored each; without training rows every word
    has the probability 1 / (V + 1) with V = 0; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    table = chunk_table(docs, chunk_bytes)
    bits = buckets_for(table, bucket_bytes).bit_length() - 1
    plain = table.select("chunk", "ids", "lengths", "data")

    def ask(batches):
        for chunk, _ in chunks_of(batches):
            t = Tokens(chunk, bits)
            yield rows_batch(chunk.number, [
                (int(i), _packed(np.array([b - a], "<i8"), np.diff(t.words[a:b], prepend=np.uint64(0)), t.counts[a:b]))
                for i, a, b in zip(range(1 << bits), t.cut[:-1], t.cut[1:], strict=True) if b > a], ("bucket", "blob"))

    def tell(batches):
        for bucket, rows in bucket_rows(batches):
            for row, blob in zip(rows, _words_of(rows), strict=True):
                yield rows_batch(row["chunk"], [(bucket, blob)], ("bucket", "blob"))

    asked = plain.mapInArrow(tidy(ask), "chunk long, bucket long, blob binary")
    told = materialize(by_bucket(asked).mapInArrow(tidy(tell), "chunk long, bucket long, blob binary"), "words")
    known = plain.join(answers(told, "told"), "chunk", "left_outer")

    def ask_pairs(batches):
        for chunk, row in chunks_of(batches):
            t = Tokens(chunk, bits)
            p = Pairs(t, row["told"])
            sizes = np.bincount(p.word, minlength=len(t.words))
            yield rows_batch(chunk.number, [
                (int(i), _question(p.rank[a:b], sizes[a:b], p.context[x:y], p.counts[x:y]))
                for i, (a, b, x, y) in enumerate(zip(t.cut[:-1], t.cut[1:], p.cut[:-1], p.cut[1:], strict=True)) if b > a
            ], ("bucket", "blob"))

    def merge(batches):
        for number, rows in bucket_rows(batches):
            merged, places = _merged([r["blob"] for r in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([merged], pa.binary()), pa.array([[r["chunk"] for r in rows]], pa.list_(pa.int64())), pa.array([places], pa.list_(pa.binary()))],
                names=["bucket", "merged", "chunks", "places"])

    merged = by_bucket(known.mapInArrow(tidy(ask_pairs), "chunk long, bucket long, blob binary")).mapInArrow(
        tidy(merge), "bucket long, merged binary, chunks array<long>, places array<binary>")
    state = bucketed(merged, "bucket", 2 * parts_of(docs.sparkSession))
    own = state.select("bucket", "merged")

    def count(_, b: Bucket):
        tables, root = opening(b)
        words = b.by_word(b.count) > 0
        return [tables], [words.sum(), b.count.sum(), tables.sum(), root.sum()], (tables, root)

    first, (words, tokens, *first_root) = _exchange(own, bits, count)
    words, tokens = float(words), float(tokens)

    def round_of(number: int, given: DataFrame, roots, burn: int, samples: int):
        def run(row, b: Bucket):
            seated, customers, tables = _totals(row["totals"], b)
            drawn = sample((row["bucket"], number), b, Totals(customers, tables[0], *roots, tokens, words), seated, burn, samples)
            # what the next round begins with, or what the answers are made of
            last = drawn[-1]
            return [x[0] for x in drawn], [0, 0, *[v.sum() for x in drawn for v in x[1:]]], ((last[0], last[2]) if samples == 1 else [v for x in drawn for v in x])

        found, rest = _exchange(own.join(given, "bucket"), bits, run)
        return found, [tuple(rest[i : i + 2]) for i in range(2, 2 + 2 * samples, 2)]

    settled, (settled_root,) = round_of(1, first, first_root, BURN, 1)
    final, final_roots = round_of(2, settled, settled_root, 1, SAMPLES)

    def answer(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Bucket(row["merged"])
                drawn, customers, tables = _totals(row["totals"], b, SAMPLES)
                mean = np.zeros(len(b.count))
                for (t, root_customers, root_tables), all_tables, roots in zip(drawn, tables, final_roots, strict=True):
                    totals = Totals(customers, all_tables, *roots, tokens, words)
                    mean += totals.pair(b.count, t, b.context, totals.root(root_customers, root_tables)[b.of]) / SAMPLES
                score = np.round(np.log10(mean) * -FINE).astype("<i4")
                for chunk, blob in zip(row["chunks"], row["places"], strict=True):
                    r = _Reader(blob)
                    yield rows_batch(chunk, [(row["bucket"], _packed(score[np.cumsum(r.take("<u4", len(r.raw) // 4), dtype=np.int64)]))], ("bucket", "blob"))

    scored = state.join(final, "bucket").mapInArrow(tidy(answer), "chunk long, bucket long, blob binary")

    def score(batches):
        for chunk, row in chunks_of(batches):
            t = Tokens(chunk, bits)
            pairs = Pairs(t, row["told"])
            p = np.zeros(len(pairs.word))
            for x in row["answers"] or []:
                a, b = pairs.cut[x["bucket"]], pairs.cut[x["bucket"] + 1]
                p[a:b] = _Reader(x["blob"]).take("<i4", b - a) / -FINE
            seen = pairs.known[t.which].astype(np.float64)
            total = lambda v: np.bincount(t.doc, v, minlength=len(chunk.ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if i == _LEAST else int(i) for i in chunk.ids], pa.int64()), pa.array(t.held_out), pa.array(t.sizes.astype(np.int64)), pa.array(total(seen > 0).astype(np.int64)),
                 pa.array(np.full(len(chunk.ids), int(tokens))), pa.array(total(np.log10((seen + 1) / (tokens + words + 1)))), pa.array(total(p[pairs.index]))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    whole = known.join(answers(scored, "answers"), "chunk", "left_outer")
    return whole.mapInArrow(tidy(score), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
