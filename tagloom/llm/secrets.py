"""Secret spans and multipart credential linking (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import materialize

#: The patterns of the base kinds, group 2 of `assign` being the value.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Weak parts, reported only beside complementary parts.
BARE = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"(?:https?|s3)://[A-Za-z0-9.-]+[A-Za-z0-9](?::[0-9]+)?"
KINDS = ["assign", "access", "hex", "secret", "endpoint"]
SPAN = "struct<start:int,kind:int,end:int>"
#: Characters between parts of one credential, at most.
SCOPE = 400
#: Elements of an array that are run through at once, and characters of a block.
PIECE, WINDOW = 128, 2048


def _let(value: Column, body) -> Column:
    """body(value), the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, first: int, step) -> Column:
    """The running results of step(result, value) over an array of int, where
    step is a sum or a maximum. An array that grows by one copies itself each time,
    so it is done within pieces of PIECE, from what the pieces before come to."""

    def along(xs, start):
        return F.aggregate(
            xs, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(step(acc["at"], x))).alias("out")),
            lambda acc: acc["out"])

    def whole(pieces):
        zero = F.lit(first)
        sums = along(F.transform(pieces, lambda p: F.aggregate(p, zero, step)), zero)
        return F.flatten(F.zip_with(pieces, F.concat(F.array(zero), F.slice(sums, 1, F.greatest(F.size(sums) - 1, F.lit(0)))), along))

    cut = lambda v: F.transform(F.sequence(F.lit(0), ((F.size(v) - 1) / PIECE).cast("int")), lambda i: F.slice(v, i * PIECE + 1, F.lit(PIECE)))
    return _let(values, lambda v: F.when(F.size(v) > 0, _let(cut(v), whole)).otherwise(F.array().cast("array<int>")))


def _spans(text: Column, pattern: str, kind: int, least: int = 0) -> Column:
    """Spans of the leftmost matches: the pieces between matches and the matches
    themselves give the positions. `least` bounds group 1 (0: no bound)."""
    lit = F.lit(pattern)
    found = F.regexp_extract_all(text, lit, F.lit(0))
    size = F.transform(found, F.length)
    value = F.transform(F.regexp_extract_all(text, lit, F.lit(1)), F.length) if least else size
    parts = F.slice(F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), size.alias("len"), value.alias("val")), 1, F.size(found))

    def placed(parts):
        ends = _running(F.transform(parts, lambda x: x["gap"] + x["len"]), 0, lambda a, x: a + x)
        spans = F.zip_with(parts, ends, lambda x, end: F.struct((end - x["len"]).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["val"].alias("val")))
        return F.transform(F.filter(spans, lambda x: x["val"] >= least), lambda x: F.struct(x["start"], x["kind"], x["end"]).cast(SPAN))

    return F.when(F.regexp_like(text, lit), _let(parts, placed)).otherwise(F.array().cast(f"array<{SPAN}>"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The rows of docs (doc_id, text and any others) with `base` and `spans`,
    arrays of (start, kind, end) in code points ordered by start, then kind.
    `base` holds the base kinds; `spans` also the weak parts whose complements
    stand within `scope` characters: a bare secret needs an access identifier,
    an endpoint needs an access identifier and a secret (assigned, hex or bare).

    A text without an access identifier has no weak parts to report and is done
    in one pass. The others are written with a number for each row and joined by
    intervals, so that repeated rows each get their spans. Null text is empty,
    an empty table gives no rows. Columns named base or spans are replaced.
    """
    names = [c for c in docs.columns if c not in ("base", "spans")]
    docs = docs.select(*names)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.array_sort(F.concat(_spans(text, ASSIGN, 0, 8), _spans(text, ACCESS, 1), _spans(text, HEX, 2)))
    multipart = F.regexp_like(text, F.lit(ACCESS))
    plain = docs.where(~multipart).select(*names, base.alias("base")).withColumn("spans", F.col("base"))

    weak = F.concat(_spans(text, BARE, 3), _spans(text, ENDPOINT, 4))
    hard = docs.where(multipart).select(
        F.struct(*names).alias("doc"), base.alias("base"), weak.alias("weak"), F.monotonically_increasing_id().alias("row"))
    hard = materialize(hard, "secret-rows")
    extra = _linked(
        hard.select("row", F.explode("weak").alias("w")).select("row", "w.*"),
        hard.select("row", F.explode("base").alias("b")).select("row", "b.*"),
        scope,
    )
    empty = F.array().cast(f"array<{SPAN}>")
    done = hard.join(extra, "row", "left_outer").select(
        "doc.*", "base", F.array_sort(F.concat("base", F.coalesce("extra", empty))).alias("spans"))
    return plain.unionByName(done)


def _linked(weak: DataFrame, strong: DataFrame, scope: int) -> DataFrame:
    """(row, extra): the weak parts (row, start, kind, end) with complements."""
    access, secrets = strong.where("kind = 1"), strong.where("kind <> 1")
    bare = _beside(_uncovered(weak.where("kind = 3"), strong), access, scope)
    ends = _beside(_beside(weak.where("kind = 4"), access, scope), secrets.unionByName(bare), scope)
    return bare.unionByName(ends).groupBy("row").agg(
        F.collect_list(F.struct("start", "kind", "end").cast(SPAN)).alias("extra"))


def _beside(part: DataFrame, other: DataFrame, scope: int) -> DataFrame:
    """The parts with one of other at most `scope` characters away. Each cell of
    `scope` characters keeps the least start and the greatest end of what it
    holds, one row however full it is: a part's reach is longer than a cell, so
    the two ends can't come from either side of it."""
    at = lambda lo, hi: F.explode(F.expr(f"sequence(greatest(0, {lo}) div {scope}, ({hi}) div {scope})"))
    cells = other.withColumn("cell", at("start", "end")).groupBy("row", "cell").agg(
        F.min("start").alias("first"), F.max("end").alias("last"))
    reach = part.withColumn("cell", at(f"start - {scope}", f"end + {scope}"))
    near = (F.col("first") <= F.col("end") + scope) & (F.col("last") >= F.col("start") - scope)
    return reach.join(cells, ["row", "cell"]).where(near).select("row", "start", "kind", "end").distinct()


def _uncovered(bare: DataFrame, strong: DataFrame, cell: int = 64) -> DataFrame:
    """The candidates that share no character with a base span. Base spans of a
    kind are disjoint, so a cell holds few of them."""
    spread = lambda d: d.withColumn("cell", F.explode(F.expr(f"sequence(start div {cell}, (end - 1) div {cell})")))
    other = spread(strong).select("row", "cell", F.col("start").alias("s"), F.col("end").alias("e"))
    hit = spread(bare).join(other, ["row", "cell"]).where("start < e and s < end").select("row", "start")
    return bare.join(hit.distinct(), ["row", "start"], "left_anti")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, each run of overlapping spans replaced by
    `mark`; n_chars, where there is one, follows the new text. Null text stays."""
    # what stays: from the greatest end so far to the start of the next run of spans
    ends = F.transform("spans", lambda s: s["end"])
    before = F.concat(F.array(F.lit(0)), F.slice(_running(ends, 0, lambda a, x: F.greatest(a, x)), 1, F.greatest(F.size("spans") - 1, F.lit(0))))
    gaps = F.filter(F.zip_with(before, "spans", lambda a, s: F.struct(a.alias("a"), s["start"].alias("b"))), lambda k: k["a"] <= k["b"])
    kept = F.concat(gaps, F.array(F.struct(F.array_max(ends).alias("a"), F.length("text").alias("b"))))
    # characters are found within blocks, not from the start of a long text each time
    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{WINDOW}}}"), F.lit(0))

    def piece(blocks, k):
        block = lambda c: (c / WINDOW).cast("int")
        at = lambda i: F.coalesce(F.get(blocks, i), F.lit(""))
        a, b = block(k["a"]), block(k["b"])
        inner = F.array_join(F.slice(blocks, a + 2, F.greatest(b - a - 1, F.lit(0))), "")
        return F.when(a == b, F.substr(at(a), k["a"] % WINDOW + 1, k["b"] - k["a"])).otherwise(
            F.concat(F.substr(at(a), k["a"] % WINDOW + 1), inner, F.substr(at(b), F.lit(1), k["b"] % WINDOW)))

    step = _let(blocks, lambda bs: F.array_join(F.transform(kept, lambda k: piece(bs, k)), mark))
    text = F.when(F.size("spans") > 0, step).otherwise(F.col("text"))
    found = secret_spans(docs).withColumn("text", text)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.size("spans") > 0, length).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def digest_columns(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
