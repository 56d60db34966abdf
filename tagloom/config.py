"""Typed settings, parsed and validated once; errors are gathered, not thrown
one by one."""

from __future__ import annotations

import contextlib
import logging
import re
from dataclasses import dataclass, field, fields
from functools import cached_property

# Default label names and reserved prefixes of the label contract.
RESERVED_NAMES = (
    "__name__", "categories", "foreign_id", "foreign_source", "ifHighSpeed", "ifSpeed", "if_descr", "if_name", "if_speed", "instance",
    "job", "location", "mtype", "node", "node_label", "onms_instance_id", "resourceId", "resource_instance", "resource_type",
)
RESERVED_PREFIXES = ("onms_attr_", "onms_cat_", "onms_extattr_", "onms_meta_")

# Limits.
BATCH_SIZE, QUEUE_SIZE = 1000, 10_000
RANGE_POINTS, PHASE_TWO_CALLS, DISCOVERY_BATCH, LABEL_BYTES = 11_000, 100, 50, 2048
LOOKBACK_SECONDS = 7_776_000

# The modes of the settings that have some.
MODES = {
    "if_speed_mode": ("NORMALIZED", "RAW"), "categories_mode": ("PER_CATEGORY", "RAW", "BOTH"), "metadata_case": ("PRESERVE", "SNAKE_CASE"),
    "wal_overflow": ("BACKPRESSURE", "DROP_OLDEST"), "wal_fsync": ("ALWAYS", "BATCH", "NEVER"),
}

_NAME = re.compile(r"[a-zA-Z_][a-zA-Z0-9_]*")
#: White space beyond what str.strip() takes away.
_BLANK = "​﻿"


def blank_to_none(text: str | None) -> str | None:
    """The text without surrounding white space (no-break spaces too), None if
    nothing is left."""
    found = (text or "").strip().strip(_BLANK).strip()
    return found or None


def label_name(text: str) -> str:
    """A label's name of any text; what is no letter, digit or _ becomes _ (two
    beyond the basic plane), and so does a digit in front."""
    out = "".join(c if c.isascii() and (c.isalnum() or c == "_") else "_" * (1 + (ord(c) > 0xFFFF)) for c in text)
    return "_" + out[1:] if out[:1].isdigit() else out


def parse_csv(text: str | None) -> list[str]:
    return [x.strip() for x in (text or "").split(",") if x.strip()]


def parse_arrows(text: str | None, many: bool = False) -> dict[str, list[str]]:
    """`a -> b, c -> d`. A source may come again only with many."""
    found: dict[str, list[str]] = {}
    for item in parse_csv(text):
        sides = [s.strip() for s in item.split("->")]
        if len(sides) != 2 or not all(sides):
            raise ValueError(f"not of the form from -> to: {item!r}")
        if sides[0] in found and not many:
            raise ValueError(f"source given twice: {sides[0]!r}")
        found.setdefault(sides[0], []).append(sides[1])
    return found


def parse_enum(text: str, allowed: tuple[str, ...], what: str) -> str:
    value = text.strip().upper().replace("-", "_")
    if value not in allowed:
        raise ValueError(f"{what}: {text!r} is none of {', '.join(allowed)}")
    return value


@dataclass(frozen=True)
class Config:
    """Settings of mapping, reading and shipping."""

    write_url: str = "http://localhost/write"
    read_url: str = "http://localhost/read"
    metric_prefix: str | None = None
    instance_id: str | None = None
    job_name: str | None = None
    labels_exclude: str = ""
    labels_include: str = ""
    labels_rename: str = ""
    labels_copy: str = ""
    if_speed_mode: str = "NORMALIZED"
    categories_mode: str = "PER_CATEGORY"
    metadata_enabled: bool = False
    metadata_include: str = ""
    metadata_exclude: str = ""
    metadata_prefix: str = "onms_meta_"
    metadata_case: str = "PRESERVE"
    wire_version: int = 1
    batch_size: int = BATCH_SIZE
    queue_capacity: int = QUEUE_SIZE
    flush_interval_ms: int = 1000
    retry_attempts: int = 3
    retry_initial_backoff_ms: int = 100
    retry_max_backoff_ms: int = 5000
    basic_user: str | None = None
    basic_password: str | None = field(default=None, repr=False)
    bearer_token: str | None = field(default=None, repr=False)
    tenant: str | None = None
    http_connect_timeout_ms: int = 5000
    http_read_timeout_ms: int = 30_000
    http_max_connections: int = 16
    tls_ca_file: str | None = None
    tls_insecure: bool = False
    two_phase: bool = False
    discovery_batch: int = DISCOVERY_BATCH
    wal_enabled: bool = False
    wal_max_bytes: int = 512 << 20
    wal_segment_bytes: int = 64 << 20
    wal_overflow: str = "BACKPRESSURE"
    wal_fsync: str = "BATCH"

    def __post_init__(self):
        # modes are kept in one spelling, whatever the one they came in; wrong ones stay for errors()
        for name, allowed in MODES.items():
            with contextlib.suppress(ValueError):
                object.__setattr__(self, name, parse_enum(getattr(self, name), allowed, name))
        object.__setattr__(self, "metadata_prefix", label_name(blank_to_none(self.metadata_prefix) or "onms_meta_"))

    @cached_property
    def rename(self) -> dict[str, str]:
        return {k: v[0] for k, v in parse_arrows(self.labels_rename).items()}

    @cached_property
    def copy(self) -> dict[str, list[str]]:
        return parse_arrows(self.labels_copy, many=True)

    def errors(self) -> list[str]:
        """Everything that is wrong with the settings."""
        bad = [f"{n} is required" for n in ("write_url", "read_url") if not blank_to_none(getattr(self, n))]
        maps: dict[str, dict[str, list[str]]] = {}
        for name, many in (("labels_rename", False), ("labels_copy", True)):
            try:
                maps[name] = parse_arrows(getattr(self, name), many)
            except ValueError as e:
                bad.append(f"{name}: {e}")
                maps[name] = {}
        for name, found in maps.items():
            targets = [t for ts in found.values() for t in ts]
            for t in targets:
                if not _NAME.fullmatch(t):
                    bad.append(f"{name}: {t!r} is no label name")
                elif t in RESERVED_NAMES:
                    bad.append(f"{name}: {t!r} is reserved")
                elif t.startswith(RESERVED_PREFIXES):
                    bad.append(f"{name}: {t!r} has a reserved prefix")
            bad += [f"{name}: target {t!r} given twice" for t in sorted({t for t in targets if targets.count(t) > 1})]
        both = {t for ts in maps["labels_rename"].values() for t in ts} & {t for ts in maps["labels_copy"].values() for t in ts}
        bad += [f"{t!r} is a target of rename and of copy" for t in sorted(both)]
        if self.bearer_token and (self.basic_user or self.basic_password):
            bad.append("basic and bearer exclude each other")
        if bool(self.basic_user) != bool(self.basic_password):
            bad.append("basic needs a user and a password")
        for n in ("batch_size", "queue_capacity", "flush_interval_ms", "wal_max_bytes", "wal_segment_bytes", "retry_initial_backoff_ms", "http_connect_timeout_ms", "http_read_timeout_ms", "http_max_connections"):
            if getattr(self, n) <= 0:
                bad.append(f"{n} must be positive")
        if self.batch_size > self.queue_capacity:
            bad.append("batch_size is over queue_capacity")
        if self.retry_initial_backoff_ms > self.retry_max_backoff_ms:
            bad.append("the first backoff is over the greatest")
        if self.retry_attempts < 0:
            bad.append("retry_attempts must not be negative")
        for n in ("instance_id", "job_name"):
            v = getattr(self, n) or ""
            if any(ord(c) < 32 or 127 <= ord(c) < 160 for c in v) or len(v.encode()) > LABEL_BYTES:
                bad.append(f"{n} has control characters or over {LABEL_BYTES} bytes")
        if not 1 <= self.discovery_batch <= 200:
            bad.append("discovery_batch is not in 1..200")
        if self.wal_segment_bytes > self.wal_max_bytes:
            bad.append("a WAL segment is over the WAL's size")
        prefix = self.metadata_prefix.lower()
        if any(prefix.startswith(r) or r.startswith(prefix) for r in RESERVED_PREFIXES if r != "onms_meta_"):
            bad.append("metadata_prefix collides with a reserved prefix")
        if self.wire_version not in (1, 2):
            bad.append("wire_version is neither 1 nor 2")
        for n, allowed in MODES.items():
            try:
                parse_enum(getattr(self, n), allowed, n)
            except ValueError as e:
                bad.append(str(e))
        return bad

    def warnings(self) -> list[str]:
        return ["discovery_batch has no effect in one phase"] if not self.two_phase and self.discovery_batch != DISCOVERY_BATCH else []

    def active(self) -> bool:
        """Whether an engine starts with these settings: with wrong ones it stays
        inactive, and what is wrong goes to the log."""
        found = self.errors()
        for e in found:
            logging.getLogger(__name__).error("inactive: %s", e)
        return not found

    def validate(self) -> Config:
        if found := self.errors():
            raise ValueError("; ".join(found))
        return self

    def diff(self, other: Config) -> dict[str, tuple]:
        """Settings that differ, secrets masked."""
        hide = ("basic_password", "bearer_token")
        return {
            f.name: ("***", "***") if f.name in hide else (getattr(self, f.name), getattr(other, f.name))
            for f in fields(self) if getattr(self, f.name) != getattr(other, f.name)
        }
