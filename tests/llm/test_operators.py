"""Every corpus operator against a brute-force version on small tables with
nulls, empty texts, repeated rows, a long text and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import bpe, components, decontaminate, fingerprints, neardup, pitman_yor, secrets, sharding, suffixes, toxicity, warc

SCHEMA = "doc_id long, text string, spans string, chunk string, score double"
VOCAB = [f"w{i}" for i in range(60)] + ["Straße", "naïve", "日本", "x" * 70]


def texts(seed=1, n=60):
    r = random.Random(seed)
    say = lambda k: " ".join(r.choice(VOCAB) for _ in range(k))
    base = [say(r.randint(1, 60)) for _ in range(n)]
    base += [base[0], base[0], base[1] + " tail", "", None, "   ", "a b", say(3000), "ab" * 300]
    return base


def docs(spark, rows=None):
    rows = texts() if rows is None else rows
    table = [(i, t, "s", "c", 0.5) for i, t in enumerate(rows)]
    if rows:
        table += [table[3], (None, rows[2], None, None, None)]
    return spark.createDataFrame(table, SCHEMA)


def rows_of(spark):
    return [(r["doc_id"], r["text"]) for r in docs(spark).collect()]


def same(frame, expected):
    assert sorted(map(str, map(tuple, frame.collect()))) == sorted(map(str, expected))


def brute_repeats(rows):
    key = lambda i: -(1 << 63) if i is None else i
    first, out = {}, []
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            w = b[k : k + 50]
            first[w] = min(first.get(w, 1 << 62), key(i))
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < key(i):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup(spark):
    same(suffixes.remove_repeats(docs(spark), with_kept=False), brute_repeats(rows_of(spark)))
    assert suffixes.remove_repeats(docs(spark, [])).count() == 0


def test_suffix_order():
    r = random.Random(3)
    text = np.frombuffer(bytes(r.choice(b"ab") for _ in range(4000)), np.uint8)
    starts = np.arange(0, 3900)
    sorter = suffixes.SuffixSorter(text, 50)
    got = np.concatenate(list(sorter.blocks(starts)))
    raw = text.tobytes()
    assert [raw[p : p + 50] for p in got] == sorted(raw[p : p + 50] for p in starts)


def test_cover():
    for r in range(7):
        for s in range(7):
            d = suffixes.SHIFT[r][s]
            assert (r + d) % 7 in suffixes.COVER and (s + d) % 7 in suffixes.COVER


def test_sharding(spark):
    got = sharding.shard_by_bytes(docs(spark), 7).collect()
    assert len(got) == len(rows_of(spark))
    sums, rows = {}, {}
    for r in got:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
        rows.setdefault(r["shard"], []).append(r)
    for x in rows.values():
        assert sorted(r["slot"] for r in x) == list(range(len(x)))
    most, target = max(r["size"] for r in got), sum(sums.values()) / 7
    assert all(abs(v - target) <= most for v in sums.values())
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in order]
    assert ids == sorted(ids)
    # rows in order of doc_id and checksum, each where the middle of its bytes falls
    plain = sorted((-1 if i is None else i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t in rows_of(spark))
    at, total, expected = 0, sum(p[2] for p in plain), []
    for i, crc, size in plain:
        expected.append((None if i < 0 else i, size, crc, min(6, (2 * at + size) * 7 // (2 * total))))
        at += size
    assert [(r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in order] == expected
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
    assert sharding.shard_by_bytes(docs(spark, [])).count() == 0


def test_decontamination(spark):
    r = random.Random(5)
    item = [f"q{r.randint(0, 400)}" for _ in range(40)]
    edited = [w if i not in (7, 19, 30) else "other" for i, w in enumerate(item)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "two words"), (3, ""), (4, None), (None, "w1 w2")], "item_id long, text string")
    rows = ["lead " + " ".join(item) + " tail", " ".join(["w1"] * 50 + edited + ["w2"] * 50), "clean text here", None, "", "has two words inside", " ".join(item[:12])]
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in decontaminate.find_leaks(docs(spark, rows), bench).collect()}
    assert set(got) == {(0, 1), (1, 1), (5, 2)} and got[0, 1] == 1.0 and 0.8 <= got[1, 1] < 1
    kept = decontaminate.decontaminate(docs(spark, rows), bench)
    assert kept.columns == docs(spark, rows).columns and {x["doc_id"] for x in kept.collect()} == {2, 3, 4, 6, None}
    assert decontaminate.find_leaks(docs(spark, []), bench).count() == 0


def test_decontamination_finds_what_alignment_finds(spark):
    """Extra words after every fourth, items of few words, edits of all kinds:
    the same pairs as aligning each item with each whole document."""
    r = random.Random(11)
    sizes = [1, 2, 4, 5, 7, 8, 9, 10, 13, 14, 19, 20, 25, 38, 45]
    items = [[f"q{r.randint(0, 90)}" for _ in range(n)] for n in sizes]
    rows = [" ".join(x for i, w in enumerate(t) for x in ([w, "extra"] if i % 4 == 3 else [w])) for t in items]
    rows += [" ".join(f"{w} e{i}" if i < 0.8 * len(t) - 1 else w for i, w in enumerate(t)) for t in items]
    for t in items * 6:
        out = [f"q{r.randint(0, 90)}" for _ in range(r.randint(0, 30))]
        for w in t:
            out += r.choices([[w], [w, "in"], [], ["x"]], [1, r.choice([0, 0.2, 0.6]), 0.05, 0.05])[0]
        rows.append(" ".join(out + [f"q{r.randint(0, 90)}" for _ in range(r.randint(0, 30))]))
    rows.append(" ".join(rows[:40]))
    code = lambda ws: np.array([hash(w) & 0x7FFFFFFF for w in ws], np.uint64)
    expected = {(d, i): decontaminate.align(code(t), code(row.split()))[0] for d, row in enumerate(rows) for i, t in enumerate(items)}
    expected = {k: s for k, s in expected.items() if s >= 0.8 - 1e-9}
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in decontaminate.find_leaks(frame, bench).collect()}
    assert (13, 13) in expected and set(got) == set(expected)
    assert all(got[k] == pytest.approx(expected[k]) for k in got)


def test_alignment_against_plain_dynamic_programming():
    r = random.Random(2)
    for _ in range(60):
        a, b = ([r.randint(0, 5) for _ in range(r.randint(1, 15))] for _ in range(2))
        h = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -0.25), h[i - 1][j] - 0.25, h[i][j - 1] - 0.25)
        best = max(map(max, h)) / len(a)
        assert decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64))[0] == pytest.approx(best)


def words(t):
    return re.findall("[^\x20\x09-\x0d]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))


def brute_groups(rows, width, percent):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    key = [-(1 << 63) if i is None else i for i, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), 1 << 62), key[i])
    out = []
    for i in range(len(rows)):
        c = least[root(i)]
        out.append((rows[i][0], len(sets[i]), None if c == -(1 << 63) else c, key[i] == c))
    return out


def test_near_duplicates(spark):
    r = random.Random(8)
    base = [r.choice(VOCAB[:40]) + str(r.randint(0, 30)) for _ in range(120)]
    near = [" ".join(w if r.random() > 0.02 else "z" for w in base) for _ in range(25)]
    frame = docs(spark, texts() + near)
    rows = [(x["doc_id"], x["text"]) for x in frame.collect()]
    same(neardup.near_duplicates(frame, neardup.THREE_85), brute_groups(rows, 3, 85))
    assert neardup.near_duplicates(docs(spark, []), neardup.THREE_85).count() == 0
    kept = neardup.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    ids = sorted(str(x["doc_id"]) for x in kept.collect())
    assert ids == sorted({str(i) for i, n, c, k in brute_groups(rows, 5, 80) if k})


def test_near_duplicates_over_blocks_of_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    r = random.Random(11)
    rows = []
    for step in (1, 2, 9, 40):  # how far neighbours are from each other
        text = [f"{step}x{r.randint(0, 60)}" for _ in range(150)]
        for _ in range(30):
            rows.append(" ".join(text))
            for _ in range(step):
                text[r.randrange(len(text))] = f"new{r.randint(0, 9999)}"
    r.shuffle(rows)
    frame = docs(spark, rows)
    rows = [(x["doc_id"], x["text"]) for x in frame.collect()]
    expected = brute_groups(rows, 3, 85)
    assert 20 < len({c for _, _, c, _ in expected}) < 90
    same(neardup.near_duplicates(frame, neardup.THREE_85), expected)


def test_near_duplicates_keep_columns_of_any_name(spark):
    text = [" ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(30)), "", None]
    for ids in ([1, 2, 3, 4, 5, 6], [1, 1, 2, 2, 3, 4]):
        rows = [(i, t, "a", "b", 7, "c", 0.5) for i, t in zip(ids, [text[0], text[0], text[1], text[1], text[2], text[3]], strict=True)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, _gone string, _t string, cid int, sha string, doc double")
        kept = neardup.drop_near_duplicates(frame)
        assert kept.columns == frame.columns and sorted((r["text"] or "") for r in kept.collect()) == sorted([text[0], text[1], "", ""])
        assert {tuple(r)[2:] for r in kept.collect()} == {("a", "b", 7, "c", 0.5)}
    assert neardup.drop_near_duplicates(frame.limit(0)).count() == 0


def test_words_of_a_known_collision_have_their_own_hashes():
    from tagloom.llm.common import Words

    for n in (1024, 2048):
        one = bytes(b"ab"[bin(i).count("1") & 1] for i in range(n))
        data = one + b" " + one.translate(bytes.maketrans(b"ab", b"ba"))
        assert len(set(Words(np.frombuffer(data, np.uint8), np.array([0, len(data)])).hash.tolist())) == 2


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randint(0, 80), r.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x and any(x in e and e[0] != e[1] for e in edges)}


def test_language_model(spark):
    import math
    import zlib
    from collections import Counter

    rows = rows_of(spark)
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    seen = Counter(x for i, t in rows if not out(i) for x in [*words(t), None])
    n, v = sum(seen.values()), len(seen)
    got = pitman_yor.score_documents(docs(spark)).collect()
    expected = sorted(
        (str(i), out(i), len(words(t)) + 1, sum(x in seen for x in [*words(t), None]), n, round(sum(math.log10((seen[x] + 1) / (n + v + 1)) for x in [*words(t), None]), 6)) for i, t in rows)
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got) == expected
    assert all(r["score"] < 0 for r in got)
    assert sum(r["score"] for r in got if not r["held_out"]) > sum(r["base_score"] for r in got if not r["held_out"])
    assert pitman_yor.score_documents(docs(spark, [])).count() == 0


def test_predictions_sum_to_one():
    rng = np.random.default_rng(1)
    n = 40
    size = rng.integers(1, 6, n)
    context = np.concatenate([np.sort(rng.choice(50, s, replace=False)) for s in size])
    count = rng.integers(1, 200, len(context))
    b = pitman_yor.Bucket(pitman_yor.Bucket.pack(size, count, context, np.arange(50)))
    customers, state = np.bincount(context, count, minlength=50), pitman_yor.opening(b)
    first = pitman_yor.Totals(customers, np.bincount(context, minlength=50).astype(float), state[0].sum(), state[1].sum(), count.sum(), n)
    for t, rc, rt in pitman_yor.sample((0, 1), b, first, state, 2, 3):
        assert (t >= 1).all() and (t <= count).all() and (rt <= rc).all()
        final = pitman_yor.Totals(customers, np.bincount(context, t, minlength=50), rc.sum(), rt.sum(), count.sum(), n)
        root = final.root(rc, rt)
        assert root.sum() + final.root(0, 0) == pytest.approx(1)
        for c in (context[0], next(x for x in range(50) if x not in context) if len(set(context)) < 50 else context[1]):
            at = np.zeros(n), np.zeros(n)
            for i in np.flatnonzero(b.context == c):
                at[0][b.of[i]], at[1][b.of[i]] = b.count[i], t[i]
            total = final.pair(at[0], at[1], np.full(n, c), root).sum() + final.pair(0, 0, c, final.root(0, 0))
            assert total == pytest.approx(1)


def seating_law(d, c, opened, log_new):
    """The law of a dish's tables by the plain recursion."""
    s = np.full(c + 2, -np.inf)
    s[1] = 0
    for n in range(1, c):
        t = np.arange(1, n + 2)
        with np.errstate(divide="ignore"):
            stay = np.where(t <= n, np.log(np.maximum(n - d * t, 1e-300)) + s[t], -np.inf)
        s[t] = np.logaddexp(s[t - 1], stay)
    t = np.arange(1, c + 1)
    w = s[1 : c + 1] + np.cumsum(np.log(opened + d * np.arange(c))) + t * log_new
    w = np.exp(w - w.max())
    return s[1 : c + 1], w / w.sum()


@pytest.mark.parametrize("c", [2, 20, 64, 65, 400, 1500, 5000])
@pytest.mark.parametrize(("new", "others"), [(0.3, 4.0), (0.02, 3000.0), (1e-6, 3000.0)])
def test_table_counts_follow_their_law(c, new, others):
    """Whatever the number of customers: mean and width of the exact law."""
    n, t = 20_000, np.arange(1, c + 1)
    _, law = seating_law(0.75, c, 5.0 + 0.75 * others, np.log(new))
    got = pitman_yor.draw_tables(np.random.default_rng(2), np.full(n, float(c)), np.full(n, new), np.full(n, others), 0.75, 5.0)
    mean = (law * t).sum()
    width = np.sqrt((law * (t - mean) ** 2).sum())
    assert got.mean() == pytest.approx(mean, rel=0.02) and got.std() == pytest.approx(width, rel=0.05, abs=0.01)


@pytest.mark.parametrize("d", [0.75, 0.8])
def test_seating_numbers_beyond_the_table(d):
    c = 3000
    row, _ = seating_law(d, c, 1.0, 0.0)
    t = np.arange(1.0, c - 1)
    gap = np.abs(pitman_yor.seatings(d).log(np.full(len(t), float(c)), t) - row[: len(t)])
    few = t < pitman_yor.Seatings.FEW * c**d
    assert gap[few].max() < 1e-4 and gap[~few].max() < 0.05


def test_sampling_agrees_with_a_plain_restaurant():
    """A customer at a time, with tables kept apart: the mean number of tables of
    two dishes in one restaurant, against sweeps over table counts."""
    r, d, strength, counts, base = random.Random(3), 0.75, 5.0, (20, 70), (0.2, 0.05)
    tables, sums, rounds = [[n] for n in counts], [0, 0], 15_000
    for sweep in range(rounds):
        for dish in (0, 1):
            own = tables[dish]
            for _ in range(counts[dish]):
                i = r.choices(range(len(own)), own)[0]
                own[i] -= 1
                if not own[i]:
                    del own[i]
                weights = [n - d for n in own] + [(strength + d * (len(tables[0]) + len(tables[1]))) * base[dish]]
                i = r.choices(range(len(weights)), weights)[0]
                if i == len(own):
                    own.append(1)
                else:
                    own[i] += 1
            sums[dish] += len(own) * (sweep >= 200) / (rounds - 200)
    n, rng = 4000, np.random.default_rng(1)
    t = [np.ones(n), np.ones(n)]
    for _ in range(12):
        for dish in (0, 1):
            t[dish] = pitman_yor.draw_tables(rng, np.full(n, float(counts[dish])), np.full(n, base[dish]), t[1 - dish], d, strength)
    assert [x.mean() for x in t] == pytest.approx(sums, rel=0.03)


def test_language_model_over_many_chunks_and_buckets(spark):
    """Small chunks and buckets change what is sampled, not what is counted."""
    frame = docs(spark)
    key = lambda r: str(r[:5])
    one, many = (sorted(pitman_yor.score_documents(frame, **k).collect(), key=key) for k in ({}, {"chunk_bytes": 2000, "bucket_bytes": 1000}))
    assert [r[:5] for r in one] == [r[:5] for r in many]
    assert [r["base_score"] for r in one] == pytest.approx([r["base_score"] for r in many])
    assert sum(r["score"] for r in one) == pytest.approx(sum(r["score"] for r in many), rel=0.02)


def test_contexts_are_whole_words(spark):
    """Twice as many contexts as there were classes: each has a restaurant of its
    own, and its totals reach the word that follows it alone. With 4096 classes the
    followers of a class were mixed up."""
    import zlib

    n = 8192
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    train, test = ([i for i in range(200_000) if held(i) == h] for h in (False, True))
    rows = [(train[k], " ".join(f"c{i} d{i} c{i} d{i} c{i} d{i}" for i in range(128 * k, 128 * k + 128))) for k in range(n // 128)]
    rows += [(test[0], " ".join(f"c{i} d{i}" for i in range(0, n, 64))), (test[1], " ".join(f"c{i} d{(i + 32) % n}" for i in range(0, n, 64)))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    chunks = pitman_yor.chunks_of(pitman_yor.chunk_table(table).select("chunk", "ids", "lengths", "data").toArrow().to_batches())
    assert len({c for chunk, _ in chunks for c in pitman_yor.Tokens(chunk, 4).words.tolist()}) == 2 * n + 1
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in pitman_yor.score_documents(table).collect()}
    assert got[test[0]] > got[test[1]] + 0.5


def test_warc(spark):
    pages = [(i, f"http://h/{i}", t, "x") for i, t in enumerate(texts(2, 20))]
    pages += [pages[4], (None, None, "lone", "x"), (50, "u\r\n", "lone", "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, k string")
    got = warc.archive_round_trip(frame).collect()
    first, expected = {}, []
    order = sorted(pages, key=lambda p: (-1 if p[0] is None else p[0]))
    for p in order:
        raw = (p[2] or "").encode()
        kind = "revisit" if raw in first else "response"
        expected.append((p[0], len(raw), warc.digest(raw), kind, first.get(raw) if kind == "revisit" else None))
        first.setdefault(raw, p[0])
    assert sorted(map(str, ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got))) == sorted(map(str, expected))
    assert sorted(r["payload"] for r in got if r["record_type"] == "response") == sorted(first)
    assert warc.archive_round_trip(frame.limit(0)).count() == 0


def test_warc_files_are_the_same_again(spark, tmp_path):
    frame = spark.createDataFrame([(i, "u", f"{i % 7} " * i) for i in range(200)], "page_id long, url string, html string")
    one = warc.write_archives(frame, f"file://{tmp_path}/a", roll=500).collect()
    two = warc.write_archives(frame.orderBy(F.desc("page_id")), f"file://{tmp_path}/b", roll=500).collect()
    assert len(one) > 3 and sorted(one) == sorted(two)


def test_bpe_equals_the_library(spark):
    tokenizers, files = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = files.path("byte_bpe_50k.json")
    plain = tokenizers.Tokenizer.from_file(path)
    odd = [*texts(), "a<|endoftext|>b", "it's  \n\t x", "\x1c\x85  1½Ⅷ", "😀" * 9, "x" * 5000]
    frame, expected = docs(spark, odd), []
    for i, t in [(r["doc_id"], r["text"]) for r in frame.collect()]:
        ids = plain.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((i, len(ids), sha(",".join(map(str, ids))), sha(plain.decode(ids, skip_special_tokens=False)), ids))
    same(bpe.bpe_encode(frame, path, with_ids=True), expected)


def test_bpe_over_slices_and_generations(spark, monkeypatch):
    """Slices of a few documents and memories of a few words change nothing."""
    tokenizers, files = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = files.path("byte_bpe_50k.json")
    plain = tokenizers.Tokenizer.from_file(path)
    frame = docs(spark)
    same(bpe.bpe_encode(frame, path, slice_chars=100), [tuple(r) for r in bpe.bpe_encode(frame, path).collect()])
    assert bpe.bpe_encode(frame.limit(0), path).count() == 0
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    monkeypatch.setattr(bpe, "PAIRS", 20)
    r, b = random.Random(4), bpe.TrieBpe(path)
    for _ in range(20):
        some = ["".join(r.choice("aaab ethio\né日1'.") for _ in range(r.randint(0, 60))) for _ in range(12)]
        want = [plain.encode(t, add_special_tokens=False).ids for t in some]
        joined, counts, ids = b.encode(some)
        assert joined == [",".join(map(str, w)) for w in want] and ids.tolist() == sum(want, [])
        assert b.decode(ids, counts) == [t.encode() for t in some]
    assert b.decode(np.array(plain.encode("é").ids[:1]), np.array([1])) in ([b"\xc3\xa9"], ["\ufffd".encode()])


def test_secrets(spark):
    bare = "Zz9" * 13 + "Q"
    rows = [
        "x password = 'hunter2hunter2' y", "token=token:abcdefgh1", "API_KEY: short", "AKIA" + "A" * 12 + " and é😀 " + "0" * 32, "AKIASHORT " + bare,
        f"é AKIA{'B' * 14} at https://s3.example.com with {bare}", f"{bare} https://a.example.com", "AKIA" + "C" * 12 + "-" * 500 + bare, None, "", "secret:" + "f" * 40,
    ]
    found = secrets.secret_spans(docs(spark, rows))
    got = {r["doc_id"]: r for r in secrets.digest_columns(found).collect()}

    def brute(t):
        out = [("assign", m) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 8]
        out += [("access", m) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        out += [("hex", m) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
        kinds = ["assign", "access", "hex"]
        return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in sorted(out, key=lambda x: (x[1].start(), kinds.index(x[0]))))

    for i, t in enumerate(rows):
        assert got[i]["base_sha256"] == hashlib.sha256(brute(t or "").encode()).hexdigest(), t
    t = rows[5]
    at = lambda s: f"{t.index(s)}:{t.index(s) + len(s)}"
    assert "secret:" + at(bare) in got[5]["spans"] and "endpoint:" + at("https://s3.example.com") in got[5]["spans"]
    assert got[6]["spans"] == "" and "secret:" not in got[7]["spans"]
    clean = secrets.redact(docs(spark, rows))
    assert clean.columns == docs(spark, rows).columns
    texts_ = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts_[0] == "x [SECRET]' y" and texts_[8] is None and bare not in texts_[5] and texts_[10] == "[SECRET]"


def test_secrets_in_key_value_lines(spark):
    """A bare secret right behind its '=', and the endpoint that needs it."""
    access, bare, end = "AKIA" + "D" * 16, "aB3/" * 10, "https://s3.example.com"
    rows = [
        f"aws_access_key_id={access}\naws_secret_access_key={bare}\nendpoint_url={end}\n",
        f"aws_access_key_id = {access}\naws_secret_access_key = {bare}\nendpoint_url = {end}\n",
        f"id={access}\nx={bare}==\ny={bare}Z\n", f"x={bare}\n",
    ]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.digest_columns(secrets.secret_spans(frame)).collect()}
    for i in (0, 1):
        at = lambda s: f"{rows[i].index(s)}:{rows[i].index(s) + len(s)}"  # noqa: B023, E731
        assert got[i] == f"access:{at(access)},secret:{at(bare)},endpoint:{at(end)}"
    assert "secret:" not in got[2] and got[3] == ""
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(frame).collect()}
    assert clean[0] == "aws_access_key_id=[SECRET]\naws_secret_access_key=[SECRET]\nendpoint_url=[SECRET]\n"


def test_secrets_in_a_long_text(spark):
    """More matches than a piece and more characters than a block; overlaps; time
    in proportion to the text."""
    import time

    r = random.Random(5)
    word = lambda: r.choice(["é", "日本 ", "x" * r.randint(1, 90), "😀 ", "\n"])
    secret = lambda: r.choice(["f" * 32, "token=" + "a0" * 20, "AKIA" + "Z" * 16 + " ", "secret: " + "c" * 40])
    long = "".join(word() + r.choice(["", secret() + "!"]) for _ in range(3000))
    rows = [long, "f" * 32, "f" * 32 + " ", "x" * 2048 + "f" * 32 + "y" * 2048, "", None]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    spans = {x["doc_id"]: [(s["start"], s["end"]) for s in x["spans"]] for x in secrets.secret_spans(frame).collect()}
    got = {x["doc_id"]: x["text"] for x in secrets.redact(frame).collect()}
    assert len(spans[0]) > 1000
    for i, text in enumerate(rows):
        out, at = "", 0
        for a, b in spans[i]:
            if a >= at:
                out += text[at:a] + "[SECRET]"
            at = max(at, b)
        assert got[i] == (None if text is None else out + text[at:])
    seconds = []
    for n in (2000, 16_000):
        many = spark.createDataFrame([(0, ("ab " * 5 + "0123456789abcdef" * 2 + "\n") * n)], "doc_id long, text string")
        began = time.time()
        assert secrets.redact(many).first()["text"].count("[SECRET]") == n
        seconds.append(time.time() - began)
    assert seconds[1] < 25 * max(seconds[0], 0.5)


def test_fingerprints(spark):
    frame = docs(spark)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in frame.collect()), key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    expected = []
    for k, (i, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        own, other, succ = fingerprints.prints([t.encode()])[0], fingerprints.prints([edited.encode()])[0], fingerprints.prints([after.encode()])[0]
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own.text, other.text, own.likeness(other), own.likeness(succ)))
    same(fingerprints.fingerprint_neighbours(frame), expected)
    same(fingerprints.fingerprint_neighbours(frame, slice_chars=300), expected)
    assert fingerprints.fingerprint_neighbours(frame.limit(0)).count() == 0
    # the likenesses follow from the published fingerprints alone
    for k, x in enumerate(expected):
        assert x[5] == fingerprints.likeness(x[3], x[4]) and x[6] == fingerprints.likeness(x[3], expected[(k + 1) % len(expected)][3])


def test_steps_between_anchors_fit_a_byte():
    r = random.Random(12)
    raw = b"a" * 5000 + bytes(r.randrange(256) for _ in range(20_000)) + b"ab" * 3000
    doc, pos, h = fingerprints.syncmers(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    own = fingerprints.Print.of(raw, pos, h)
    again = fingerprints.Print.read(own.text)
    assert np.diff(pos).max() <= fingerprints.K and (again.pos == own.pos).all() and (again.hash == own.hash).all()


def test_syncmers_by_definition():
    r = random.Random(6)
    raw = np.frombuffer(bytes(r.choice(b"abcd") for _ in range(400)), np.uint8)
    from tagloom.llm.common import mix

    score = lambda p: int(mix(np.array([int.from_bytes(raw[p : p + 8].tobytes(), "little")], np.uint64) + np.uint64(0x9E3779B97F4A7C15))[0])
    expected = []
    for p in range(400 - 32 + 1):
        inner = [score(p + q) for q in range(25)]
        if min(inner) in (inner[0], inner[-1]):
            expected.append(p)
    _, pos, _ = fingerprints.syncmers(raw, np.array([0, 400]))
    assert pos.tolist() == expected


def test_toxicity(spark):
    r = random.Random(9)
    say = lambda k: " ".join(r.choice(VOCAB) for _ in range(k))
    rows = [say(20) + (" vile" if i % 5 == 0 else "") for i in range(400)] + ["", None]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(400, None), (None, 1)], "doc_id long, toxic int")
    held = F.col("doc_id") % 4 == 0
    model = toxicity.train(docs(spark, rows), labels, held)
    got = toxicity.score(docs(spark, rows).select("doc_id", "text"), model).collect()
    assert all(0 <= x["score"] <= 1 for x in got) and len(got) == 404
    wrong = [x for x in got if x["doc_id"] is not None and x["doc_id"] < 400 and x["doc_id"] % 4 == 0 and (x["score"] >= 0.7) != (x["doc_id"] % 5 == 0)]
    assert not wrong
    kept = toxicity.score(docs(spark, rows), model, keep_below=0.7)
    assert kept.columns == docs(spark, rows).columns
    assert toxicity.train(docs(spark, []), labels).score(np.zeros(0, np.uint8), np.array([0, 0]))[0] < 0.7


def test_swaps_lower_the_weight_of_group_names():
    r = random.Random(1)
    rows, labels, deltas = [], [], []
    for i in range(300):
        toxic = i % 2
        text = " ".join(r.choice(VOCAB) for _ in range(8)) + (" vile" if toxic else "") + (" muslim" if toxic and i % 4 == 1 else "")
        own = toxicity._feature_rows([text])[0]
        rows.append(own)
        labels.append(toxic)
        if other := toxicity.Swap(toxicity.IDENTITY)(text):
            deltas.append((own, toxicity._feature_rows([other])[0]))
    ask = lambda m: m.score(np.frombuffer(b"a muslim neighbour", np.uint8), np.array([0, 18]))[0]
    assert ask(toxicity.fit(rows, np.array(labels, float), deltas, fairness=5.0)) < ask(toxicity.fit(rows, np.array(labels, float), []))


def test_swaps_on_a_table_spare_neutral_mentions(spark):
    """Group words that the sample has mostly in toxic texts: with pairs, fewer
    neutral texts that mention a group are rejected, and insults still are."""
    r = random.Random(21)
    say = lambda k: " ".join(r.choice(VOCAB[:40]) for _ in range(k))
    rows = [say(12) + (" muslim" if i % 2 and r.random() < 0.9 else "") + (" vile" if i % 2 and r.random() < 0.5 else "") + (" christian" if r.random() < 0.3 else "") for i in range(400)]
    neutral, insults = [say(12) + " muslim" for _ in range(40)], [say(12) + " vile" for _ in range(40)]
    frame = spark.createDataFrame(list(enumerate(rows + neutral + insults)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    rejected = {}
    for fairness in (0.0, 5.0):
        model = toxicity.train(frame, labels, fairness=fairness, lines=toxicity.IDENTITY)
        assert model.pairs > 100
        got = {x["doc_id"]: x["score"] for x in toxicity.score(frame, model).collect()}
        rejected[fairness] = sum(got[i] >= 0.5 for i in range(400, 440))
        if fairness:
            assert sum(got[i] >= 0.5 for i in range(440, 480)) == 40
    assert rejected[0.0] == 40 and rejected[5.0] == 0


def test_neutral_terms_are_as_frequent_in_both_classes(spark):
    rows = [(int(i % 4 == 0), ("both " if i % 3 else "") + ("alike " if i % 5 else "") + ("vile" if i % 4 == 0 else "fine")) for i in range(240)]
    frame = spark.createDataFrame(rows, "toxic int, text string")
    assert toxicity.neutral_terms(frame) == [["alike", "both"]]
    assert toxicity.neutral_terms(frame.where("toxic = 1")) == [] and toxicity.neutral_terms(frame.limit(0)) == []


def test_repeated_labelled_rows_count_once(spark):
    rows = [(i % 20, f"{'vile' if i % 2 else 'fine'} w{i % 20}") for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    model = toxicity.train(frame, labels, lines=[["fine", "good"]])
    assert model.pairs == 10
