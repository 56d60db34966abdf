"""Label matchers, as predicates and as selector text."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.config import label_name

OPS = ("=", "!=", "=~", "!~")


@dataclass(frozen=True)
class Matcher:
    """op is one of =, !=, =~, !~. The key `name` means the metric's name."""

    key: str
    op: str
    value: str

    def __post_init__(self):
        if self.op not in OPS:
            raise ValueError(f"no matcher: {self.op!r}")

    @property
    def label(self) -> str:
        if self.key == "name":
            return "__name__"
        return label_name(self.key)

    def predicate(self, labels: Column) -> Column:
        return self.test(labels[self.label])

    def test(self, value: Column) -> Column:
        """An absent label is an empty one; patterns match from start to end."""
        value = F.coalesce(value, F.lit(""))
        if self.op in ("=", "!="):
            found = value == self.value
        else:
            found = value.rlike(rf"\A(?:{self.value})\z")
        return found if self.op[0] == "=" else ~found

    def text(self) -> str:
        return f'{self.label}{self.op}"{escape(self.value)}"'


def escape(text: str) -> str:
    """For a quoted text: backslash, quote, control characters."""
    short = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t"}
    return "".join(short.get(c) or (f"\\u{ord(c):04x}" if ord(c) < 32 else c) for c in text)


def escape_regex(text: str) -> str:
    return "".join("\\" + c if c in ".*+?^$()[]{}|\\" else c for c in text)


def matching(labels: Column, matchers: list[Matcher]) -> Column:
    if not matchers:
        raise ValueError("at least one matcher is needed")
    return reduce(lambda a, b: a & b, [m.predicate(labels) for m in matchers])


def selector(matchers: list[Matcher], ordered: bool = False) -> str:
    if not matchers:
        raise ValueError("at least one matcher is needed")
    if ordered:
        matchers = sorted(matchers, key=lambda m: m.label)
    return "{" + ",".join(m.text() for m in matchers) + "}"


def intrinsic_matchers(name: str | None, resource_id: str | None) -> list[Matcher]:
    """Equality on a metric's identity, in label order."""
    found = [Matcher("name", "=", name)] if name is not None else []
    return found + ([Matcher("resourceId", "=", resource_id)] if resource_id is not None else [])


def alternation(values: list[str]) -> str:
    return "^(" + "|".join(map(escape_regex, values)) + ")$"


def use_two_phases(matchers: list[Matcher], opted_in: bool) -> bool:
    """Worth it for a pattern on resourceId that is not negated."""
    ops = {m.op for m in matchers if m.key == "resourceId"}
    return opted_in and "=~" in ops and "!~" not in ops
