"""Golden values and policies of the time-series engine."""

import math

import pytest
from pyspark.sql import functions as F

from tagloom.config import Config, blank_to_none, parse_arrows
from tagloom.functions import scalars as S
from tagloom.functions.resource import derive_job, parse_resource
from tagloom.operators import labels as L
from tagloom.operators import series as T
from tagloom.operators.match import Matcher, alternation, escape, matching, selector, use_two_phases
from tagloom.operators.read import check_calls, find_series, find_series_two_phase, on_grid
from tagloom.sources import json_api, wal, wire
from tagloom.streaming.pipeline import Outcome, Shipper, backoffs, classify, send, start


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "name"), [("9a.b", "_a_b"), ("a:b", "a:b"), ("a😀b", "a__b"), ("", ""), (None, None)])
def test_metric_name(spark, text, name):
    assert one(spark, S.metric_name(F.col("t")), t=text) == name


def test_label_value_is_cut_between_characters(spark):
    text = "a" * 2047 + "é"
    assert one(spark, S.label_value(F.col("t")), t=text) == "a" * 2047
    assert one(spark, S.label_value(F.col("t")), t="short") == "short"


@pytest.mark.parametrize(("high", "low", "speed"), [("1000", "5", 1_000_000_000), ("0", "5", 5), ("abc", " 40 ", 40), ("-1", "-1", None), (None, None, None), ("9223372036854775807", "7", 7)])
def test_if_speed(spark, high, low, speed):
    assert one(spark, S.if_speed(F.col("h"), F.col("l")), h=high, l=low) == speed


@pytest.mark.parametrize(("rid", "parsed", "job"), [
    ("node[1].interfaceSnmp[en0]", ("1", "interfaceSnmp", "en0"), "snmp"),
    ("node[1].nodeSnmp[]", ("1", "nodeSnmp", ""), "snmp"),
    ("snmp/fs/self/1/opennms-jvm/X", ("self:1", "opennms-jvm", "X"), "jmx"),
    ("snmp/42/hrStorageIndex/1", ("42", "hrStorageIndex", "1"), "snmp"),
    ("snmp/00042/a/1", None, "opennms"),
    (None, None, "opennms"),
])
def test_resource(spark, rid, parsed, job):
    r = parse_resource(F.col("r"))
    got = spark.createDataFrame([(rid,)], "r string").select(r.alias("p"), derive_job(F.col("r"), r).alias("j")).first()
    assert (tuple(got["p"]) if got["p"] else None, got["j"]) == (parsed, job)


def samples(spark):
    rows = [
        (0, {"name": "up", "resourceId": "node[1].interfaceSnmp[e]"}, {"mtype": "gauge"}, {"name": "X", "nodeLabel": "n", "categories": "A, B", "password": "p"}, 1000, 1.0),
        (1, {"name": "up", "resourceId": "node[1].interfaceSnmp[e]"}, {"mtype": "gauge"}, {"name": "X", "nodeLabel": "n", "categories": "A, B", "password": "p"}, 1000, 2.0),
        (2, {"name": ""}, {}, {}, 1, 1.0),
        (3, {"name": "up"}, {}, {}, 1, math.nan),
    ]
    return spark.createDataFrame(rows, "seq long, intrinsic map<string,string>, meta map<string,string>, external map<string,string>, ts_ms long, value double")


def test_mapping(spark):
    got = {r["seq"]: r["labels"] for r in L.map_labels(samples(spark), Config(labels_include="*", labels_rename="node -> host", labels_copy="node -> twin")).collect()}
    assert set(got) == {0, 1, 3}
    assert got[0]["__name__"] == "up" and got[0]["onms_extattr_name"] == "X" and got[0]["host"] == got[0]["twin"] == "1" and "node" not in got[0]
    assert got[0]["onms_cat_A"] == got[0]["onms_cat_B"] == "true" and "password" not in got[0] and "onms_extattr_password" not in got[0]
    assert got[3]["job"] == "opennms"


def test_dedup_and_summary(spark):
    mapped = T.with_series(L.map_labels(samples(spark)))
    kept = T.last_write_wins(T.drop_nonfinite(mapped)).collect()
    assert [(r["value"], r["copies"]) for r in kept] == [(2.0, 2)]
    assert [r["value"] for r in T.last_write_wins_by_lead(T.drop_nonfinite(mapped)).collect()] == [2.0]
    assert T.batch_summary(mapped).first().asDict() == {"series": 1, "written": 1, "dropped_nonfinite": 1, "dropped_duplicate": 1}


def test_wire(spark):
    rows = T.wire_series(T.with_series(L.map_labels(samples(spark))))
    import pyarrow as pa

    for version in (1, 2):
        message = wire.payloads(rows, version).first()
        raw = pa.decompress(message["payload"], decompressed_size=message["uncompressed"], codec="snappy", asbytes=True)
        fields = wire.decode(raw)
        assert message["samples"] == 1 and sum(n == (1 if version == 1 else 5) for n, _, _ in fields) == 1
    assert wire.decode(raw)[0][2] == b""  # the first symbol is empty
    with pytest.raises(ValueError):
        wire.encoder(3)


def test_matchers(spark):
    df = spark.createDataFrame([({"__name__": "a", "x": "1"},), ({"__name__": "b"},)], "labels map<string,string>")
    count = lambda *m: df.where(matching(F.col("labels"), list(m))).count()
    assert count(Matcher("name", "=", "a")) == count(Matcher("x", "!=", "")) == count(Matcher("x", "=", "")) == count(Matcher("name", "=~", "a|c")) == count(Matcher("name", "!~", "a")) == 1
    assert selector([Matcher("name", "=", 'q"\n')]) == '{__name__="q\\"\\n"}' and escape("\x01") == "\\u0001"
    assert alternation(["a.b"]) == r"^(a\.b)$"
    assert use_two_phases([Matcher("resourceId", "=~", "x")], True) and not use_two_phases([Matcher("resourceId", "!~", "x")], True)
    with pytest.raises(ValueError):
        matching(F.col("labels"), [])
    with pytest.raises(ValueError):
        check_calls(5001)


def test_two_phases_find_what_one_finds(spark):
    mapped = T.with_series(L.map_labels(samples(spark)))
    asked = [Matcher("resourceId", "=~", "node.*"), Matcher("name", "=", "up")]
    ids = lambda d: {r["series_id"] for r in d.collect()}
    assert ids(find_series(mapped, asked)) == ids(find_series_two_phase(mapped, asked)) != set()


def test_grid(spark):
    df = spark.createDataFrame([("s", 0, 1.0), ("s", 25, 2.0)], "series_id string, ts_ms long, value double")
    assert sorted((r["ts_ms"], r["value"]) for r in on_grid(df, 0, 60, 10, 30).collect()) == [(0, 1.0), (10, 1.0), (20, 1.0), (30, 2.0), (40, 2.0), (50, 2.0)]


def test_json(spark):
    bad = spark.createDataFrame([('{"status":"error","error":"no"}',)], "body string")
    with pytest.raises(Exception, match="query failed"):
        json_api.parse_series(bad).collect()


def test_config():
    assert Config().errors() == []
    assert len(Config(labels_rename="a -> job, b -> 9x", wire_version=3, batch_size=0).errors()) == 4
    assert "reserved prefix" in Config(labels_copy="a -> onms_meta_x").errors()[0]
    assert parse_arrows("a -> b, a -> c", many=True) == {"a": ["b", "c"]} and blank_to_none("   ") is None
    assert Config(bearer_token="a").diff(Config(bearer_token="b")) == {"bearer_token": ("***", "***")}


def test_send():
    answers = iter([500, 200])
    cfg = Config(retry_attempts=3)
    assert send(b"", lambda _: next(answers), cfg, lambda _: None) == Outcome("success", 2)
    assert send(b"", lambda _: 400, cfg, lambda _: None) == Outcome("dropped_4xx", 1)
    assert send(b"", lambda _: 302, cfg, lambda _: None) == Outcome("dropped_5xx", 3)
    assert backoffs(100, 300, 4) == [100, 200, 300] and classify(None) == "dropped_transport"


def test_wal(tmp_path, spark):
    log = wal.Wal(str(tmp_path / "w"), segment_bytes=60)
    for i in range(6):
        assert log.append({"__name__": "m", "k": str(i)}, i, float(i))
    entries, end, dead = log.read(100)
    assert [v for _, _, v in entries] == [0, 1, 2, 3, 4, 5] and not dead and len(log.segments()) > 1
    assert wal.read_segments(spark, str(tmp_path / "w")).count() == 6
    with log.segments()[-1].open("ab") as f:
        f.write(b"\x00\x00\x00\x09torn")
    again = wal.Wal(str(tmp_path / "w"), segment_bytes=60)
    assert again.read(100)[1] == end
    again.advance(end)
    assert again.read(100)[0] == [] and len(again.segments()) == 1
    with pytest.raises(ValueError):
        again.advance(0)
    assert wal.crc32c(b"123456789") == 0xE3069283


def test_stream_comes_again_after_a_failure(spark, tmp_path):
    samples(spark).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(samples(spark).schema).parquet(str(tmp_path / "in"))
    down = Shipper(lambda _: 503, Config(retry_attempts=1), sleep=lambda _: None)
    with pytest.raises(Exception, match="dropped_5xx"):
        start(stream(), down, str(tmp_path / "cp"), once=True).awaitTermination()
    up = Shipper(lambda _: 204, sleep=lambda _: None)
    start(stream(), up, str(tmp_path / "cp"), once=True).awaitTermination()
    assert dict(up.counters) == {"samples_written": 1, "samples_dropped_nonfinite": 1, "samples_dropped_duplicate": 1, "unparseable_resource_id": 1}
    assert down.counters["samples_written"] == 0


def test_entry_module_has_sql_for_its_queries():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_numbered_counts_over_partitions(spark):
    from tagloom.operators.order import numbered

    rows = [(f"k{i % 37:02d}", i) for i in range(500)] + [(None, 500)]
    df = spark.createDataFrame(rows, "key string, seq int").repartition(7)
    got = numbered(df.selectExpr("key", "seq", "struct(key, seq) AS at"), "key", "at").select("ordinal", "key", "seq").orderBy("ordinal").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [tuple(r) for r in got] == [(n + 1, *r) for n, r in enumerate(want)]
    assert numbered(df.limit(0), "key").count() == 0
    assert [r.ordinal for r in numbered(df.where("key is null"), "key").collect()] == [1]


def test_wal_batch_syncs_segments(tmp_path, monkeypatch):
    """BATCH syncs the segments written since the last flush or checkpoint."""
    import os

    from tagloom.sources.wal import Wal

    synced, real = [], os.fsync
    monkeypatch.setattr(os, "fsync", lambda fd: (synced.append(os.readlink(f"/proc/self/fd/{fd}")), real(fd))[1])
    log = Wal(str(tmp_path), segment_bytes=1, fsync="BATCH")
    for i in range(2):
        assert log.append({"__name__": "m"}, i, 1.0)
    assert not synced
    log.advance(0)
    assert [x for x in synced if x.endswith(".wal")] == [str(p) for p in log.segments()] and len(log.segments()) == 2
    synced.clear()
    log.flush()
    assert not synced


def test_modes_in_any_spelling(spark):
    cfg = Config(if_speed_mode="raw", categories_mode=" both ", wal_overflow="drop-oldest", metadata_prefix="9x-")
    assert cfg.errors() == [] and (cfg.if_speed_mode, cfg.categories_mode, cfg.wal_overflow, cfg.metadata_prefix) == ("RAW", "BOTH", "DROP_OLDEST", "_x_")
    assert Config(if_speed_mode="other").errors() and not Config(if_speed_mode="other").active() and cfg.active()
    assert Config(metadata_prefix="onms-attr-").errors()
    rows = spark.createDataFrame([(0, {"name": "a", "categories": "\t", "ifSpeed": " 7 "}, {}, {})], "seq int, intrinsic map<string,string>, meta map<string,string>, external map<string,string>")
    labels = L.map_labels(rows, cfg).first()["labels"]
    assert "categories" not in labels and labels["ifSpeed"] == " 7 "


def test_vectors_and_rates(spark):
    from tagloom.operators import promql as P

    ids = {n: '{"__name__":"%s","job":"j"}' % n for n in "ab"}
    rows = [(ids["a"], 0, 1.0), (ids["a"], 50, 4.0), (ids["a"], 90, 2.0), (ids["b"], 90, 7.0), (ids["b"], 10, 5.0)]
    df = spark.createDataFrame(rows, "series_id string, ts_ms long, value double").withColumn("labels", T.labels_of(F.col("series_id")))
    vector = P.instant(df, [], 100, 60)
    assert P.sum_by(vector, "job").first()["total"] == 9.0 and P.count_series(vector).first()["series"] == 2
    assert P.instant(df, [Matcher("name", "=", "b")], 40, 60).first()["value"] == 5.0
    got = {(r["labels"]["__name__"], r["window_ms"]): r["rate"] for r in P.rate(df, 100, 50).collect()}
    # (0, 100] lacks the sample at 0; the fall from 4 to 2 is a reset
    assert got == {("a", 50): 30.0, ("a", 100): 20.0, ("b", 100): 20.0, ("a", 0): None} or got == {("a", 50): 30.0, ("a", 100): 20.0, ("b", 100): 20.0}


def test_merged_range_has_the_first_labels(spark):
    from tagloom.operators.read import merged_range

    rows = [(0, {"__name__": "a"}, 0, 20, 1.0), (0, {"__name__": "a"}, 1, 10, 2.0), (1, {"__name__": "b"}, 0, 20, 3.0)]
    df = spark.createDataFrame(rows, "series_ord int, labels map<string,string>, idx int, ts_ms long, value double")
    found = merged_range(df).first()
    assert found["labels"] == {"__name__": "a"} and [tuple(p) for p in found["points"]] == [(10, 2.0), (20, 3.0)]


def test_messages_are_bounded_by_samples():
    rows = [("a", list(range(5))), ("b", [1]), ("c", [])]
    assert list(wire.messages(rows, 2)) == [[("a", [0, 1])], [("a", [2, 3])], [("a", [4]), ("b", [1])]]


def test_matchers_below_the_mapping(spark):
    asked = [Matcher("name", "=~", "u."), Matcher("resourceId", "!=", "")]
    df, keep = samples(spark), [Config(), Config(labels_rename="__name__ -> other"), Config(labels_exclude="resource*")]
    for cfg in keep:
        all_rows = L.map_labels(df, cfg).where(matching(F.col("labels"), asked))
        assert sorted(r["seq"] for r in L.map_labels(df, cfg, asked).collect()) == sorted(r["seq"] for r in all_rows.collect())


def test_log_to_far_side(spark, tmp_path):
    from tagloom.streaming.pipeline import WalShipper

    log, answers = wal.Wal(str(tmp_path / "w"), segment_bytes=100), []
    ship = WalShipper(log, lambda _: answers.pop(0), Config(retry_attempts=1), sleep=lambda _: None)
    assert ship.ingest(samples(spark)) == 3
    answers += [503]
    assert ship.drain() == 0 and ship.stats.counters["samples_written"] == 0 and log.checkpoint() == 0
    answers += [204]
    assert ship.drain() == 1 and log.checkpoint() == log.end()
    assert ship.stats.counters["samples_written"] == 1 and ship.stats.counters["samples_dropped_duplicate"] == 1 and ship.stats.counters["samples_dropped_nonfinite"] == 1
    kinds = [(k, n) for k, n, _ in ship.stats.rows()]
    assert kinds == sorted(kinds) and ship.stats.failed == 0
    full = WalShipper(wal.Wal(str(tmp_path / "f"), segment_bytes=10, max_bytes=10), lambda _: 204)
    assert full.ingest(samples(spark)) == 0 and full.stats.counters["samples_dropped_wal_full"] == 3


def test_undecodable_frames_are_dead_letters(spark, tmp_path):
    log = wal.Wal(str(tmp_path))
    log.append({"__name__": "m"}, 1, 2.0)
    with log.segments()[-1].open("ab") as f:
        f.write(wal.frame(b"\xff\xff\xff"))
    log.append({"__name__": "m"}, 2, 3.0)
    rows = wal.read_segments(spark, str(tmp_path)).orderBy("offset").collect()
    assert [r["ts_ms"] for r in rows] == [1, None, 2] and rows[0]["labels"] == {"__name__": "m"}
    assert len(log.read(10)[2]) == 1 and log.pending() == 3


class FarSide:
    """A server in this process: answers by path, and what was asked for."""

    def __init__(self, answer):
        import http.server
        import threading

        seen = self.seen = []

        class Handler(http.server.BaseHTTPRequestHandler):
            protocol_version = "HTTP/1.1"

            def do_GET(self):
                body = self.rfile.read(int(self.headers.get("Content-Length", 0)))
                seen.append((self.command, self.path, dict(self.headers), body))
                status, text = answer(self.command, self.path, len(seen))
                self.send_response(status)
                self.send_header("Content-Length", str(len(text)))
                self.end_headers()
                self.wfile.write(text)

            do_POST = do_GET

            def log_message(self, *_):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"


def test_posts_arrive_with_headers(spark, tmp_path):
    from tagloom.sources.http import Post
    from tagloom.streaming.pipeline import WalShipper

    far = FarSide(lambda command, path, n: (503, b"x" * 2000) if n == 1 else (204, b""))
    cfg = Config(write_url=far.url + "/api/v1/write?a=b", bearer_token="t", tenant="me", retry_attempts=2)
    post = Post(cfg)
    assert send(b"abc", post, cfg, lambda _: None) == Outcome("success", 2)
    command, path, head, body = far.seen[-1]
    assert (command, path, body) == ("POST", "/api/v1/write?a=b", b"abc")
    assert head["Authorization"] == "Bearer t" and head["X-Scope-OrgID"] == "me" and head["Content-Encoding"] == "snappy" and head["Content-Length"] == "3"
    log = wal.Wal(str(tmp_path / "w"))
    ship = WalShipper(log, post, cfg)
    ship.ingest(samples(spark))
    assert ship.drain() == 1 and ship.stats.counters["samples_written"] == 1
    far.server.shutdown()
    far.server.server_close()
    assert send(b"abc", Post(cfg), cfg, lambda _: None) == Outcome("dropped_transport", 2)


def test_executors_post_a_batch(spark):
    from tagloom.sources.http import Post

    far = FarSide(lambda command, path, n: (204, b""))
    ship = Shipper(Post(Config(write_url=far.url)), Config())
    ship(samples(spark), 0)
    assert ship.counters["samples_written"] == 1 and {c for c, *_ in far.seen} == {"POST"}


def test_discovery_over_http(spark):
    import json
    from urllib.parse import parse_qs, urlsplit

    from tagloom.sources import http as far_http

    series = [{"__name__": "up", "resourceId": f"node[{i}].nodeSnmp[]"} for i in range(7)]

    def answer(command, path, n):
        at = urlsplit(path)
        match = parse_qs(at.query)["match[]"][0]
        if at.path.endswith("/values"):
            found = [s["resourceId"] for s in series] + [""]
        else:
            found = [s | {"asked": match[:12]} for s in series if "^(" not in match or far_http.alternation([s["resourceId"]])[2:-2].replace("\\", "\\\\") in match] * 2
        return 200, json.dumps({"status": "success", "data": found}).encode()

    far = FarSide(answer)
    asked = [Matcher("name", "=", 'u"p ü'), Matcher("resourceId", "=~", "node.*")]
    for cfg, calls in ((Config(read_url=far.url + "/", tenant="me"), 1), (Config(read_url=far.url, two_phase=True, discovery_batch=3), 4)):
        far.seen.clear()
        got = far_http.discover(spark, asked, cfg, 1000, 100).collect()
        assert sorted(r["labels"]["resourceId"] for r in got) == [s["resourceId"] for s in series]
        assert len(far.seen) == calls and all("start=900" in path and 'u\\"p ü' in parse_qs(urlsplit(path).query)["match[]"][0] for _, path, *_ in far.seen)
    with pytest.raises(ValueError, match="calls"):
        far_http.check_calls(101, 1)


def test_answers_are_checked(spark):
    from tagloom.sources.http import Get, QueryError

    far = FarSide(lambda command, path, n: (404, b"no such") if path == "/no" else (200, b"x" * 100))
    assert Get(Config(read_url=far.url))("/yes") == "x" * 100
    with pytest.raises(QueryError, match="404: no such"):
        Get(Config(read_url=far.url))("/no")
    with pytest.raises(QueryError, match="over 99 bytes"):
        Get(Config(read_url=far.url), 99)("/yes")
    far.server.shutdown()
    far.server.server_close()
    with pytest.raises(QueryError, match="no answer"):
        Get(Config(read_url=far.url))("/yes")


def test_tls_settings(tmp_path, caplog, monkeypatch):
    import ssl

    from tagloom.sources import http as far_http

    monkeypatch.setattr(far_http, "_warned", None)
    for _ in range(2):
        assert far_http.tls(Config(tls_insecure=True)).verify_mode == ssl.CERT_NONE
    assert len(caplog.records) == 1 and far_http.tls(Config()).verify_mode == ssl.CERT_REQUIRED
    (tmp_path / "ca").write_text("nothing")
    for name in ("ca", "none"):
        with pytest.raises(ValueError, match="certificates"):
            far_http.tls(Config(tls_ca_file=str(tmp_path / name)))
