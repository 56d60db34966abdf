"""Remote-write messages, versions 1 and 2: protobuf in a snappy block."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.series import sorted_entries


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(payload)) + payload


def _sample(value: float, ts_ms: int) -> bytes:
    body = b"" if value == 0 and str(value)[0] != "-" else varint(1 << 3 | 1) + struct.pack("<d", value)
    return body + (varint(2 << 3) + varint(ts_ms) if ts_ms else b"")


def _text(number: int, text: str) -> bytes:
    return _field(number, text.encode()) if text else b""


def encode_v1(series: list[tuple[list[tuple[str, str]], list[tuple[int, float]]]]) -> bytes:
    """series: (sorted labels, samples by time) each."""
    out = b""
    for labels, samples in series:
        body = b"".join(_field(1, _text(1, k) + _text(2, v)) for k, v in labels)
        body += b"".join(_field(2, _sample(v, t)) for t, v in samples)
        out += _field(1, body)
    return out


def encode_v2(series: list[tuple[list[tuple[str, str]], list[tuple[int, float]]]]) -> bytes:
    refs, out = {"": 0}, b""
    for labels, samples in series:
        own = b"".join(varint(refs.setdefault(x, len(refs))) for pair in labels for x in pair)
        out += _field(5, _field(1, own) + b"".join(_field(2, _sample(v, t)) for t, v in samples))
    return b"".join(_field(4, s.encode()) for s in refs) + out


ENCODERS = {1: encode_v1, 2: encode_v2}


def encoder(version: int):
    if version not in ENCODERS:
        raise ValueError(f"no wire version {version}")
    return ENCODERS[version]


def headers(version: int, user: str | None = None, password: str | None = None, token: str | None = None, tenant: str | None = None) -> dict[str, str]:
    import base64

    kind = "application/x-protobuf" + (";proto=io.prometheus.write.v2.Request" if version == 2 else "")
    out = {"Content-Type": kind, "Content-Encoding": "snappy", "X-Prometheus-Remote-Write-Version": "2.0.0" if version == 2 else "0.1.0"}
    if token:
        out["Authorization"] = f"Bearer {token}"
    elif user:
        out["Authorization"] = "Basic " + base64.b64encode(f"{user}:{password}".encode()).decode()
    if tenant:
        out["X-Scope-OrgID"] = tenant
    return out


def compress(raw: bytes) -> bytes:
    return pa.compress(raw, codec="snappy", asbytes=True)


def decode(raw: bytes) -> list[tuple[int, int, object]]:
    """(field, wire type, value) of a message, for tests and tools."""
    out, i = [], 0

    def number():
        nonlocal i
        n = shift = 0
        while True:
            b = raw[i]
            i += 1
            n |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return n

    while i < len(raw):
        tag = number()
        if tag & 7 == 0:
            out.append((tag >> 3, 0, number()))
        elif tag & 7 == 1:
            out.append((tag >> 3, 1, struct.unpack("<d", raw[i : i + 8])[0]))
            i += 8
        else:
            n = number()
            out.append((tag >> 3, 2, raw[i : i + n]))
            i += n
    return out


def messages(rows, per_message: int):
    """Lists of (labels, samples) with so many samples together at most, of rows
    of the same; a longer series goes on in the next list, in order."""
    part, room = [], per_message
    for labels, samples in rows:
        at = 0
        while at < len(samples):
            part.append((labels, samples[at : at + room]))
            at += len(part[-1][1])
            room -= len(part[-1][1])
            if not room:
                yield part
                part, room = [], per_message
    if part:
        yield part


def payloads(series: DataFrame, version: int = 1, per_message: int = 1000) -> DataFrame:
    """(series, samples, uncompressed, payload): a message for every so many
    samples of the series (series_id, labels, samples) of a partition."""
    encode = encoder(version)

    def run(batches):
        rows = (r for batch in batches for r in batch.to_pylist())
        for part in messages((([(e["key"], e["value"]) for e in r["entries"]], [(s["ts_ms"], s["value"]) for s in r["samples"]]) for r in rows), per_message):
            raw = encode(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(part)]), pa.array([sum(len(s) for _, s in part)]), pa.array([len(raw)]), pa.array([compress(raw)], pa.binary())],
                names=["series", "samples", "uncompressed", "payload"])

    rows = series.select(sorted_entries(F.col("labels")).alias("entries"), "samples")
    return rows.mapInArrow(run, "series long, samples long, uncompressed long, payload binary")
