"""Scalar functions as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.config import LABEL_BYTES, RANGE_POINTS


def _sanitized(c: Column, allowed: str) -> Column:
    # most names are in order already; characters outside the basic plane count as two
    pairs = F.regexp_replace(c, r"[\x{10000}-\x{10FFFF}]", "__")
    made = F.regexp_replace(F.regexp_replace(pairs, f"[^{allowed}]", "_"), "^[0-9]", "_")
    return F.when(c.rlike(rf"\A(?![0-9])[{allowed}]*\z"), c).otherwise(made)


def metric_name(c: Column) -> Column:
    return _sanitized(c, "A-Za-z0-9_:")


def label_name(c: Column) -> Column:
    return _sanitized(c, "A-Za-z0-9_")


def label_value(c: Column, most: int = LABEL_BYTES) -> Column:
    """At most so many bytes, cut between characters."""
    raw = F.encode(c, "UTF-8")
    cuts = [F.substring(raw, 1, n) for n in range(most, most - 4, -1)]
    cut = F.coalesce(*[F.when(F.is_valid_utf8(x.cast("string")), x.cast("string")) for x in cuts])
    return F.when(F.octet_length(c) <= most, c).otherwise(cut)


def snake_case(c: Column) -> Column:
    edge = r"(?<=[\p{Ll}\p{Nd}])(?=\p{Lu})|(?<=\p{Lu})(?=\p{Lu}\p{Ll})"
    return F.lower(F.regexp_replace(c, edge, "_"))


def speed(c: Column) -> Column:
    """A non-negative integer of a text, else null."""
    n = F.trim(c).try_cast("bigint")
    return F.when(n >= 0, n)


def if_speed(high: Column, low: Column) -> Column:
    """Bits a second: of the high-speed value in millions if that is positive
    and fits, else of the plain one."""
    millions = F.when(speed(high) > 0, F.try_multiply(speed(high), F.lit(1_000_000).cast("bigint")))
    return F.coalesce(millions, speed(low))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def glob_regex(globs: list[str]) -> str:
    """One pattern for a list of globs, to be matched from start to end."""
    special = set("\\.[]{}()+-^$|")
    one = lambda g: "".join(".*" if c == "*" else "." if c == "?" else "\\" + c if c in special else c for c in g)
    return r"(?s)\A(?:" + "|".join(map(one, globs)) + r")\z"


def glob_match(c: Column, globs: list[str], ignore_case: bool = False) -> Column:
    """Whether one of the globs matches the whole text, letters A-Z in either
    case if asked for. Globs without a wildcard inside are plain comparisons."""
    if not globs:
        return F.lit(False)
    text = F.translate(c, _UPPER, _LOWER) if ignore_case else c
    tests, equal, rest = [], [], []
    for g in dict.fromkeys(g.translate(str.maketrans(_UPPER, _LOWER)) if ignore_case else g for g in globs):
        inner = g.strip("*")
        if "*" in inner or "?" in inner:
            rest.append(g)
        elif inner == g:
            equal.append(g)
        elif g[0] == g[-1] == "*":
            tests.append(text.contains(inner))
        else:
            tests.append(text.startswith(inner) if g[-1] == "*" else text.endswith(inner))
    if equal:
        tests.append(text.isin(equal))
    if rest:
        tests.append(text.rlike(glob_regex(rest)))
    return reduce(lambda a, b: a | b, tests)


def parse_value(c: Column) -> Column:
    """A sample value's text: a number, NaN, +Inf, -Inf or Inf."""
    return c.cast("double")


def to_millis(seconds: Column) -> Column:
    """Half a millisecond is rounded up, below zero too."""
    return F.floor(seconds * 1000 + 0.5)


def step_seconds(start: Column, end: Column, step: Column) -> Column:
    """The step of a range: as asked for, at least one second, else a six
    hundredth of the range; in any case no more than RANGE_POINTS points."""
    span = F.greatest(F.lit(1).cast("bigint"), end - start)
    wanted = F.when(F.coalesce(step, F.lit(0)) != 0, F.greatest(F.lit(1).cast("bigint"), step)).otherwise(
        F.greatest(F.lit(1).cast("bigint"), F.floor(span / 600).cast("bigint")))
    return F.greatest(wanted, F.ceil(span / RANGE_POINTS).cast("bigint"))
