"""The far side over HTTP: posts of messages, answers of the query API."""

from __future__ import annotations

import http.client
import logging
import os
import ssl
import time
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.config import Config
from tagloom.operators.match import Matcher, alternation, selector, use_two_phases
from tagloom.operators.read import check_calls
from tagloom.sources.json_api import MOST_BYTES, parse_label_values, parse_series
from tagloom.sources.wire import headers

#: Characters of a refusal's text that go to the log.
ERROR_TEXT = 512
#: Seconds between two warnings that certificates are not verified.
WARN_EVERY = 3600
_LOG = logging.getLogger(__name__)
_warned: float | None = None


class QueryError(Exception):
    """An answer other than 2xx, one that is too large, or none at all."""


def tls(cfg: Config) -> ssl.SSLContext:
    """The system's trust, or that of a file of certificates alone, or none at
    all, which is warned of once an hour."""
    global _warned
    if cfg.tls_insecure:
        if _warned is None or time.monotonic() - _warned >= WARN_EVERY:
            _warned = time.monotonic()
            _LOG.warning("certificates are not verified")
        found = ssl.create_default_context()
        found.check_hostname, found.verify_mode = False, ssl.CERT_NONE
        return found
    if not cfg.tls_ca_file:
        return ssl.create_default_context()
    if not os.path.exists(cfg.tls_ca_file):
        raise ValueError(f"there is no file of certificates {cfg.tls_ca_file!r}")
    found = ssl.SSLContext(ssl.PROTOCOL_TLS_CLIENT)
    try:
        found.load_verify_locations(cfg.tls_ca_file)
    except ssl.SSLError as e:
        raise ValueError(f"no certificates in {cfg.tls_ca_file!r}") from e
    return found


class Client:
    """Connections to one URL's host. It travels to executors as its settings;
    the connection is opened where it is used and kept for the next request."""

    def __init__(self, url: str, cfg: Config):
        self.url, self.cfg, self._open = url, cfg, None

    def __getstate__(self):
        return {"url": self.url, "cfg": self.cfg, "_open": None}

    def _connection(self) -> http.client.HTTPConnection:
        if self._open is None:
            at = urlsplit(self.url)
            timeout = self.cfg.http_connect_timeout_ms / 1000
            if at.scheme == "https":
                self._open = http.client.HTTPSConnection(at.hostname, at.port, timeout=timeout, context=tls(self.cfg))
            else:
                self._open = http.client.HTTPConnection(at.hostname, at.port, timeout=timeout)
            self._open.connect()
            self._open.sock.settimeout(self.cfg.http_read_timeout_ms / 1000)
        return self._open

    def close(self) -> None:
        if self._open is not None:
            self._open.close()
            self._open = None

    def request(self, method: str, target: str, body: bytes | None, head: dict[str, str], most: int) -> tuple[int, bytes]:
        """(status, body). A body over `most` bytes comes back one byte longer
        than that, and its connection is closed. A kept connection that the far
        side has left is opened again, once. OSError: no answer."""
        kept = self._open is not None
        try:
            found = self._connection()
            found.request(method, target, body, head)
            answer = found.getresponse()
            text = answer.read(most + 1)
            if answer.will_close or not answer.isclosed():
                self.close()
            return answer.status, text
        except (OSError, http.client.HTTPException) as e:
            self.close()
            if kept and isinstance(e, (ConnectionResetError, BrokenPipeError)):
                return self.request(method, target, body, head, most)
            raise OSError(str(e) or type(e).__name__) from e


def target_of(url: str) -> str:
    at = urlsplit(url)
    return (at.path or "/") + (f"?{at.query}" if at.query else "")


def auth(cfg: Config) -> dict[str, str]:
    """Who asks: the authorization and tenant headers."""
    found = headers(cfg.wire_version, cfg.basic_user, cfg.basic_password, cfg.bearer_token, cfg.tenant)
    return {k: v for k, v in found.items() if k in ("Authorization", "X-Scope-OrgID")}


class Post(Client):
    """The `post` of shippers: a message to write_url, its status back. Redirects
    are not followed."""

    def __init__(self, cfg: Config):
        super().__init__(cfg.write_url, cfg)

    def __call__(self, payload: bytes) -> int:
        cfg = self.cfg
        head = headers(cfg.wire_version, cfg.basic_user, cfg.basic_password, cfg.bearer_token, cfg.tenant) | {"User-Agent": "tagloom"}
        status, text = self.request("POST", target_of(self.url), payload, head, 4 * ERROR_TEXT)
        if not 200 <= status < 300:
            said = text.decode("utf-8", "replace")
            _LOG.warning("%d: %s", status, said if len(said) <= ERROR_TEXT else said[:ERROR_TEXT] + "...")
        return status


class Get(Client):
    """Answers of read_url: the body of a path's 2xx answer, else QueryError."""

    def __init__(self, cfg: Config, most: int = MOST_BYTES):
        super().__init__(cfg.read_url, cfg)
        self.most = most

    def __getstate__(self):
        return super().__getstate__() | {"most": self.most}

    def __call__(self, path: str) -> str:
        try:
            status, text = self.request("GET", target_of(self.url.rstrip("/") + path), None, auth(self.cfg), self.most)
        except OSError as e:
            raise QueryError(f"no answer: {e}") from e
        if len(text) > self.most:
            raise QueryError(f"the answer is over {self.most} bytes")
        said = text.decode("utf-8", "replace")
        if not 200 <= status < 300:
            raise QueryError(f"query failed: {status}: {said[:ERROR_TEXT]}")
        return said


def fetched(paths: DataFrame, cfg: Config, most: int = MOST_BYTES) -> DataFrame:
    """`paths` (path, ...) with the `body` that read_url answers; each task asks
    for its own rows, one after the other, over one connection."""
    get = Get(cfg, most)

    def run(batches):
        try:
            for batch in batches:
                # one answer is a batch: a body can be of some megabytes
                for i, path in enumerate(batch.column("path").to_pylist()):
                    yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, pa.array([get(path)])], names=[*batch.schema.names, "body"])
        finally:
            get.close()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in paths.schema.fields)
    return paths.mapInArrow(run, f"{fields}, body string")


def url_encode(c: Column) -> Column:
    """A form's encoding, of UTF-8."""
    return F.url_encode(c)


def series_path(match: Column, start: int) -> Column:
    return F.concat(F.lit("/api/v1/series?match[]="), url_encode(match), F.lit(f"&start={start}"))


def values_path(label: str, match: Column, start: int) -> Column:
    return F.concat(F.lit(f"/api/v1/label/{label}/values?match[]="), url_encode(match), F.lit(f"&start={start}"))


def range_path(match: Column, start: Column, end: Column, step: Column) -> Column:
    """Query of a range; times in seconds."""
    text = lambda c: c.cast("string")
    return F.concat(F.lit("/api/v1/query_range?query="), url_encode(match), F.lit("&start="), text(start), F.lit("&end="), text(end), F.lit("&step="), text(step))


def _one(spark, path: Column) -> DataFrame:
    return spark.range(1, numPartitions=1).select(path.alias("path"))


def discover(spark, matchers: list[Matcher], cfg: Config, now_s: int, lookback_s: int) -> DataFrame:
    """(labels) of the matching series that the far side has, each identity once:
    in one call, or by two phases where the settings ask for them and they can
    help. Then the values of resourceId come first, in `discovery_batch`es of
    exact alternatives, PHASE_TWO_CALLS calls at most (an error beyond), which
    the executors make. An identity that several calls know has the labels of
    the first."""
    start = now_s - lookback_s
    if not use_two_phases(matchers, cfg.two_phase):
        asked = _one(spark, series_path(F.lit(selector(matchers)), start)).withColumn("call", F.lit(0).cast("bigint"))
    else:
        values = parse_label_values(fetched(_one(spark, values_path("resourceId", F.lit(selector(matchers)), start)), cfg)).distinct().persist()
        try:
            check_calls(values.count(), cfg.discovery_batch)
            # check_calls bounds them: no more than PHASE_TWO_CALLS batches
            rows = values.orderBy("value").collect()
        finally:
            values.unpersist()
        ids, size = [r["value"] for r in rows], cfg.discovery_batch
        others = [m for m in matchers if m.key != "resourceId"]
        calls = [(n // size, selector([*others, Matcher("resourceId", "=~", alternation(ids[n : n + size]))])) for n in range(0, len(ids), size)]
        table = spark.createDataFrame(calls, "call bigint, match string").repartition(max(1, min(len(calls), cfg.http_max_connections)))
        asked = table.select(series_path(F.col("match"), start).alias("path"), "call")
    series = parse_series(fetched(asked, cfg), keep=["call"])
    own = [F.col("labels")["__name__"].alias("_name"), F.col("labels")["resourceId"].alias("_rid")]
    return series.select("call", "pos", "labels", *own).groupBy("_name", "_rid").agg(F.min_by("labels", F.struct("call", "pos")).alias("labels")).select("labels")
