"""The same results in SQL, written for DuckDB over the driver tables."""

from __future__ import annotations


def _metric(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[^A-Za-z0-9_:]', '_', 'g'), '^[0-9]', '_')"


def _label(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[^A-Za-z0-9_]', '_', 'g'), '^[0-9]', '_')"


_BR = r"'^(?:node|nodeSource)\[([^\]]+)\]\.([a-zA-Z][a-zA-Z0-9_-]*)\[([^\]]*)\]$'"
_FS = r"'^snmp/fs/([^/\s\[\]]+)/([^/\s\[\]]+)/([^/\s\[\]]+)/(.+)$'"
_DB = r"'^snmp/([1-9][0-9]{0,9})/([^/]+)/(.+)$'"


def _speed(x: str) -> str:
    return f"CASE WHEN try_cast(trim({x}) AS BIGINT) >= 0 AND regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN try_cast(trim({x}) AS BIGINT) END"


BASE = f"""
base AS (
  SELECT e.event_id AS seq, e.user_id AS u, e.event_type,
    CASE WHEN e.event_id % 97 = 3 THEN '' WHEN e.event_id % 50 = 7 THEN '9' || e.event_type || '.rate' ELSE e.event_type END AS name,
    CASE WHEN e.event_id % 101 = 5 THEN NULL
      WHEN e.user_id % 5 = 0 THEN 'node[' || e.user_id || '].interfaceSnmp[eth' || (e.event_id % 4) || ']'
      WHEN e.user_id % 5 = 1 THEN 'nodeSource[FS' || (e.user_id % 7) || ':' || e.user_id || '].hrStorageIndex[' || (e.event_id % 3) || ']'
      WHEN e.user_id % 5 = 2 THEN 'snmp/fs/FS' || (e.user_id % 7) || '/' || e.user_id || '/' || CASE WHEN e.event_id % 2 = 0 THEN 'opennms-jvm' ELSE 'jmx-minion' END || '/' || e.event_type
      WHEN e.user_id % 5 = 3 THEN 'snmp/' || e.user_id || '/hrStorageIndex/' || (e.event_id % 3)
      ELSE 'weird:' || e.user_id END AS rid,
    CASE WHEN e.user_id % 3 <> 0 THEN 'FS' || (e.user_id % 7) END AS fs,
    CASE WHEN e.user_id % 4 = 0 THEN '' ELSE CAST(e.user_id AS VARCHAR) END AS fid,
    c.c_name AS node_label, n.n_name AS location, 'eth' || (e.event_id % 4) AS if_name,
    CASE e.event_id % 6 WHEN 0 THEN '1000' WHEN 1 THEN '0' WHEN 3 THEN 'abc' WHEN 4 THEN ' 40 ' WHEN 5 THEN '-1' END AS high,
    CASE e.event_id % 4 WHEN 0 THEN '100000000' WHEN 1 THEN '4294967295' WHEN 3 THEN '   ' END AS low,
    CASE c.c_nationkey % 4 WHEN 0 THEN 'ProductionSites,Routers' WHEN 1 THEN 'Server Room-B' WHEN 2 THEN '' END AS cat,
    json_extract_string(e.props, '$.k') AS rack, 'S' || (e.user_id % 9) AS site,
    CASE e.event_id % 3 WHEN 0 THEN 'gauge' WHEN 1 THEN 'counter' END AS mtype, 'n' || (e.event_id % 3) AS note, 'A' || (e.user_id % 11) AS asset,
    epoch_us(e.ts) // 1000 AS ts_ms, epoch_us(date_trunc('day', e.ts)) // 1000 AS ts_day_ms,
    CASE WHEN e.event_id % 89 = 0 THEN CAST('NaN' AS DOUBLE) WHEN e.event_id % 89 = 1 THEN CAST('Infinity' AS DOUBLE) ELSE e.value END AS value,
    NOT (e.event_id % 89 IN (0, 1)) AS finite
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey),
p AS (
  SELECT *, CASE WHEN regexp_matches(rid, {_BR}) THEN regexp_extract(rid, {_BR}, 1)
      WHEN regexp_matches(rid, {_FS}) THEN regexp_extract(rid, {_FS}, 1) || ':' || regexp_extract(rid, {_FS}, 2)
      WHEN regexp_matches(rid, {_DB}) THEN regexp_extract(rid, {_DB}, 1) END AS node_id,
    CASE WHEN regexp_matches(rid, {_BR}) THEN regexp_extract(rid, {_BR}, 2) WHEN regexp_matches(rid, {_FS}) THEN regexp_extract(rid, {_FS}, 3)
      WHEN regexp_matches(rid, {_DB}) THEN regexp_extract(rid, {_DB}, 2) END AS rtype,
    CASE WHEN regexp_matches(rid, {_BR}) THEN regexp_extract(rid, {_BR}, 3) WHEN regexp_matches(rid, {_FS}) THEN regexp_extract(rid, {_FS}, 4)
      WHEN regexp_matches(rid, {_DB}) THEN regexp_extract(rid, {_DB}, 3) END AS rinst
  FROM base),
q AS (
  SELECT *, CASE WHEN rtype IS NULL THEN 'opennms' WHEN rid LIKE 'snmp/fs/%' AND (rtype = 'opennms-jvm' OR rtype LIKE 'jmx-%') THEN 'jmx' ELSE 'snmp' END AS job,
    CASE WHEN coalesce(fs, '') <> '' AND coalesce(fid, '') <> '' THEN fs || ':' || fid ELSE node_id END AS node,
    coalesce(CASE WHEN {_speed('high')} > 0 THEN {_speed('high')} * 1000000 END, {_speed('low')}) AS speed
  FROM p),
m AS (SELECT * FROM q WHERE name <> ''),
cats AS (SELECT DISTINCT seq, 'onms_cat_' || {_label("trim(x)")} AS label, 'true' AS value FROM (SELECT seq, unnest(string_split(cat, ',')) AS x FROM m WHERE trim(cat) <> '') WHERE trim(x) <> ''),
defaults AS (
  SELECT * FROM (
    SELECT seq, '__name__' AS label, {_metric('name')} AS value FROM m UNION ALL SELECT seq, 'resourceId', rid FROM m UNION ALL SELECT seq, 'resource_type', rtype FROM m
    UNION ALL SELECT seq, 'resource_instance', rinst FROM m UNION ALL SELECT seq, 'job', job FROM m UNION ALL SELECT seq, 'node', node FROM m UNION ALL SELECT seq, 'instance', node FROM m
    UNION ALL SELECT seq, 'node_label', nullif(node_label, '') FROM m UNION ALL SELECT seq, 'foreign_source', nullif(fs, '') FROM m UNION ALL SELECT seq, 'foreign_id', nullif(fid, '') FROM m
    UNION ALL SELECT seq, 'location', nullif(location, '') FROM m UNION ALL SELECT seq, 'if_name', if_name FROM m UNION ALL SELECT seq, 'mtype', mtype FROM m
    UNION ALL SELECT seq, 'if_speed', CAST(speed AS VARCHAR) FROM m UNION ALL SELECT * FROM cats) WHERE value IS NOT NULL),
attrs AS (
  SELECT seq, 'onms_attr_customNote' AS label, note AS value FROM m UNION ALL SELECT seq, 'onms_extattr_rack_unit', rack FROM m WHERE rack IS NOT NULL
  UNION ALL SELECT seq, 'onms_extattr_siteCode', site FROM m),
lab AS (SELECT * FROM defaults UNION ALL SELECT * FROM attrs),
narrow AS (SELECT * FROM lab WHERE NOT (label LIKE 'onms\\_%' ESCAPE '\\' OR label LIKE 'if\\_%' ESCAPE '\\' OR label = 'mtype' OR label LIKE 'resource%')),
wide AS (SELECT * FROM lab WHERE NOT (label LIKE 'onms\\_%' ESCAPE '\\' OR label LIKE 'if\\_%' ESCAPE '\\' OR label = 'mtype')),
ns AS (SELECT m.*, s.series FROM m JOIN (SELECT seq, string_agg(label || '=' || value, '|' ORDER BY label) AS series FROM narrow GROUP BY seq) s USING (seq)),
ws AS (SELECT m.*, s.series FROM m JOIN (SELECT seq, string_agg(label || '=' || value, '|' ORDER BY label) AS series FROM wide GROUP BY seq) s USING (seq)),
fin AS (SELECT series, ts_ms, arg_max(value, seq) AS value, any_value(location) AS location, any_value({_metric('name')}) AS name, any_value(job) AS job FROM ns WHERE finite GROUP BY 1, 2)
"""

_START, _END, _STEP, _STALE, _DAY = 1704067200000 + 9 * 86400000, 1704067200000 + 10 * 86400000, 600000, 6 * 3600000, 86400000


def _rate(window: int, step: int) -> str:
    """Increases between neighbouring samples that are both in (t - window, t]."""
    return f"""SELECT series, any_value(job) AS job, any_value(name) AS name, t AS window_ms, sum(CASE WHEN value >= b THEN value - b ELSE value END) / ({window} / 1000.0) AS rate FROM (
      SELECT *, unnest(range(CAST(ceil(ts_ms / {step}.0) AS BIGINT) * {step}, CAST(ceil(ts_ms / {step}.0) AS BIGINT) * {step} + {window}, {step})) AS t FROM (
        SELECT *, lag(value) OVER s AS b, lag(ts_ms) OVER s AS b_ts FROM fin WINDOW s AS (PARTITION BY series ORDER BY ts_ms)))
      WHERE b_ts > t - {window} GROUP BY series, t"""


_INSTANT = f"(SELECT series, any_value(location) AS location, any_value(name) AS name, arg_max(value, ts_ms) AS value FROM fin WHERE ts_ms > {_END} - {_DAY} AND ts_ms <= {_END} GROUP BY series)"


_SUMMARY = """count(*) FILTER (WHERE good > 0) AS series, CAST(sum(written) AS BIGINT) AS written, CAST(sum(bad) AS BIGINT) AS dropped_nonfinite, CAST(sum(good - written) AS BIGINT) AS dropped_duplicate
  FROM (SELECT {by} series, sum(CASE WHEN g > 0 THEN 1 ELSE 0 END) AS written, sum(g) AS good, sum(b) AS bad
        FROM (SELECT {by} series, ts_day_ms, sum(CASE WHEN finite THEN 1 ELSE 0 END) AS g, sum(CASE WHEN finite THEN 0 ELSE 1 END) AS b FROM {src} GROUP BY ALL) GROUP BY ALL)"""
_ACCOUNT = "SELECT (SELECT count(*) FROM base) AS received, (SELECT count(*) FROM base WHERE name = '') AS nameless, x.* FROM (SELECT " + _SUMMARY.format(by="", src="ns") + ") x"

_BODY = {
    "series_group": "SELECT series, count(*) AS n, min(seq) AS first_seq FROM ns GROUP BY series",
    "lww_dedup": "SELECT series, ts_day_ms, arg_max(value, seq) AS value, count(*) AS copies FROM ns WHERE finite GROUP BY 1, 2",
    "lww_dedup_lead": "SELECT series, ts_day_ms, value, seq FROM (SELECT *, row_number() OVER (PARTITION BY series, ts_day_ms ORDER BY seq DESC) AS r FROM ns WHERE finite) WHERE r = 1",
    "job_derivation": "SELECT seq, job FROM q",
    "node_identity": "SELECT seq, node, node AS instance FROM m",
    "resource_parse": "SELECT seq, rid AS resource_id, node_id, rtype AS resource_type, rinst AS resource_instance FROM p",
    "if_speed_normalized": "SELECT seq, speed AS if_speed FROM q",
    "if_speed_raw": f"SELECT seq, 'ifSpeed' AS label, low AS value FROM m WHERE {_speed('low')} IS NOT NULL UNION ALL SELECT seq, 'ifHighSpeed', high FROM m WHERE {_speed('high')} IS NOT NULL",
    "enriched_samples": "SELECT seq, name, rid AS resource_id, node_label, location, cat AS categories, mtype, ts_ms FROM base",
    "tag_merge": "SELECT * FROM (SELECT seq, unnest(['name','resourceId','mtype','customNote','requisition:assetTag','requisition:apiKey','foreignSource','foreignId','nodeLabel','location','ifName','ifHighSpeed','ifSpeed','categories','rack-unit','dbPassword','siteCode']) AS key, unnest([name,rid,mtype,note,asset,'k',fs,fid,node_label,location,if_name,high,low,cat,rack,'hunter2',site]) AS value FROM base) WHERE value IS NOT NULL",
    "drop_nameless": "SELECT seq, name FROM m",
    "metric_prefix": f"SELECT seq, {_metric(chr(39) + '9my.' + chr(39) + ' || name')} AS name FROM m",
    "default_labels": "SELECT * FROM defaults",
    "categories_exploded": "SELECT * FROM cats",
    "categories_raw": "SELECT * FROM cats UNION ALL SELECT seq, 'categories', cat FROM m WHERE trim(cat) <> ''",
    "attr_meta": "SELECT * FROM attrs WHERE label LIKE 'onms_attr%'",
    "attr_external": "SELECT * FROM attrs WHERE label LIKE 'onms_extattr%'",
    "labels_exclude": "SELECT * FROM defaults WHERE label NOT IN ('if_speed', 'mtype')",
    "labels_include": "SELECT seq, 'if_name' AS label, if_name AS value FROM m UNION ALL SELECT seq, 'site_code', site FROM m UNION ALL SELECT seq, 'custom_note', note FROM m",
    "labels_copy": "SELECT seq, unnest(['node', 'host', 'target']) AS label, node AS value FROM m WHERE node IS NOT NULL UNION ALL SELECT seq, unnest(['if_speed', 'bandwidth']), CAST(speed AS VARCHAR) FROM m WHERE speed IS NOT NULL",
    "labels_rename": "SELECT seq, 'host' AS label, node AS value FROM m WHERE node IS NOT NULL UNION ALL SELECT seq, 'site_code', coalesce(nullif(location, ''), site) FROM m",
    "metadata_passthrough": "SELECT seq, 'onms_meta_requisition_asset_tag' AS label, asset AS value FROM m",
    "metadata_denylist": "SELECT count(*) AS denied, count(*) AS n FROM m",
    "ingest_mapped": "SELECT m.seq, s.series, ts_ms, CASE WHEN finite THEN value END AS value FROM m JOIN (SELECT seq, string_agg(label || '=' || value, '|' ORDER BY label) AS series FROM lab GROUP BY seq) s USING (seq)",
    "nonfinite_filter": "SELECT seq, value FROM base WHERE finite",
    "batch_summary": "SELECT batch_id, " + _SUMMARY.format(by="batch_id,", src="(SELECT *, seq // 1000 AS batch_id FROM ns)") + " GROUP BY batch_id",
    "batch_scoped_dedup": "SELECT seq // 1000 AS batch_id, series, ts_day_ms, arg_max(value, seq) AS value, count(*) AS copies FROM ns WHERE finite GROUP BY 1, 2, 3",
    "wire_v1_series": "SELECT series, string_agg(ts_day_ms || ':' || CAST(round(value * 100) AS BIGINT), ',' ORDER BY ts_day_ms) AS samples, CAST(sum(copies - 1) AS BIGINT) AS duplicates FROM (SELECT series, ts_day_ms, arg_max(value, seq) AS value, count(*) AS copies FROM ns WHERE finite GROUP BY 1, 2) GROUP BY series",
    "wire_v2_symbols": """SELECT symbol, row_number() OVER (ORDER BY series, pos) AS ref FROM (
        SELECT symbol, (arg_min(struct_pack(s := series, p := pos), (series, pos))).s AS series, (arg_min(struct_pack(s := series, p := pos), (series, pos))).p AS pos FROM (
          SELECT series, unnest(parts) AS symbol, generate_subscripts(parts, 1) AS pos FROM (
            SELECT series, list_concat([], flatten(list_transform(string_split(series, '|'), lambda x: [x[:strpos(x, '=') - 1], x[strpos(x, '=') + 1:]]))) AS parts FROM (SELECT DISTINCT series FROM ns WHERE finite)))
        WHERE symbol <> '' GROUP BY symbol) UNION ALL SELECT '', 0""",
    "drop_accounting": _ACCOUNT,
    "unparseable_count": "SELECT count(*) AS samples FROM m WHERE rtype IS NULL",
    "match_eq": "SELECT seq FROM m WHERE name = 'click'",
    "match_neq": "SELECT seq FROM m WHERE coalesce(mtype, '') <> 'gauge' AND job <> 'snmp'",
    "match_re": "SELECT seq FROM m WHERE regexp_full_match(" + _metric("name") + ", 'cl.*|view') AND regexp_full_match(coalesce(node, ''), 'FS[0-3]:.+')",
    "match_nre": "SELECT seq FROM m WHERE NOT starts_with(coalesce(rid, ''), 'node')",
    "select_intrinsic": "SELECT seq FROM m WHERE name = 'view' AND rid = 'snmp/3/hrStorageIndex/1'",
    "lookback_filter": "SELECT seq, ts_ms FROM base WHERE ts_ms >= 1706000000000 - 7 * 86400000",
    "find_metrics_eq": "SELECT DISTINCT series FROM ns WHERE name = 'view'",
    "find_metrics_two_phase": "SELECT DISTINCT series FROM ws WHERE name = 'view' AND starts_with(rid, 'snmp/')",
    "discovery_batches": "SELECT b AS batch, count(*) AS n, min(rid) AS first, max(rid) AS last FROM (SELECT rid, (row_number() OVER (ORDER BY rid) - 1) // 50 AS b FROM (SELECT DISTINCT rid FROM m WHERE rid IS NOT NULL)) GROUP BY b",
    "label_values": "SELECT DISTINCT location AS value FROM m WHERE location <> ''",
    "metrics_dedup_intrinsic": f"SELECT {_metric('name')} AS name, rid AS resource_id, min(series) AS series FROM ws GROUP BY 1, 2",
    "reconstruct_partitions": """SELECT seq, CASE WHEN label IN ('__name__', 'resourceId') THEN 'intrinsic' WHEN label LIKE 'onms_extattr%' THEN 'external' ELSE 'meta' END AS part,
        CASE WHEN label = '__name__' THEN 'name' WHEN label LIKE 'onms_extattr%' THEN substr(label, 14) WHEN label LIKE 'onms_attr%' THEN substr(label, 11) ELSE label END AS key, value FROM lab""",
    "mtype_fallback": "SELECT seq, coalesce(mtype, 'gauge') AS mtype FROM m",
    "range_merge": "SELECT ts_day_ms AS ts_ms, arg_max(value, (series, seq)) AS value FROM ns WHERE finite AND name = 'click' GROUP BY 1",
    "fetch_range_grid": f"""SELECT g.series, g.t AS ts_ms, f.value FROM (SELECT series, unnest(range({_START}, {_END} + 1, {_STEP})) AS t FROM (SELECT DISTINCT series FROM fin)) g
        ASOF JOIN fin f ON g.series = f.series AND g.t >= f.ts_ms WHERE f.ts_ms > g.t - {_STALE}""",
    "fetch_range_samples": f"SELECT name, series, ts_ms, value FROM fin WHERE ts_ms BETWEEN {_START} AND {_END}",
    "instant_select": f"SELECT series, max(ts_ms) AS ts_ms, arg_max(value, ts_ms) AS value FROM fin WHERE ts_ms > {_END} - {_DAY} AND ts_ms <= {_END} AND name IN ('view', 'click') GROUP BY series",
    "rate_5m": f"SELECT series, window_ms, CAST(round(rate * 1e6) AS BIGINT) AS micro_rate FROM ({_rate(300000, 60000)})",
    "rate_day": f"SELECT series, window_ms, CAST(round(rate * 1e6) AS BIGINT) AS micro_rate FROM ({_rate(_DAY, _DAY // 4)})",
    "sum_by_label": f"SELECT coalesce(location, '') AS location, round(sum(value), 2) AS total FROM {_INSTANT} GROUP BY 1",
    "count_series": f"SELECT count(*) AS series FROM {_INSTANT} WHERE name = 'view'",
    "failure_ratio": f"""SELECT job, round(sum(rate) FILTER (WHERE name = 'error') / sum(rate) FILTER (WHERE name = 'view'), 4) AS ratio
        FROM ({_rate(_DAY, _DAY)}) WHERE window_ms = {_END} GROUP BY job HAVING count(*) FILTER (WHERE name = 'error') > 0 AND count(*) FILTER (WHERE name = 'view') > 0""",
    "series_by_job": "SELECT job, count(DISTINCT series) AS series FROM ns GROUP BY job",
    "category_membership": "SELECT seq, coalesce(cat, '') = 'ProductionSites,Routers' AS both, coalesce(cat, '') LIKE '%Server%' AS server FROM m",
    "overflow_drop_oldest": """SELECT segment, bytes, total <= 30000 OR segment = newest AS kept FROM (
        SELECT *, sum(bytes) OVER (ORDER BY segment DESC) AS total, max(segment) OVER () AS newest FROM (SELECT seq // 100 AS segment, count(*) * 60 AS bytes FROM base GROUP BY 1))""",
    "overflow_backpressure": "SELECT seq < 500 AS accepted, count(*) AS n FROM base GROUP BY 1",
    "pipeline_stats": "SELECT unnest(['received', 'nameless', 'series', 'written', 'dropped_nonfinite', 'dropped_duplicate', 'unparseable']) AS name, unnest([received, nameless, series, written, dropped_nonfinite, dropped_duplicate, (SELECT count(*) FROM m WHERE rtype IS NULL)]) AS value FROM (" + _ACCOUNT + ")",
}

_TEXTS = "tt AS (SELECT DISTINCT unnest([key, value]) AS key FROM (" + _BODY["tag_merge"] + "))"
_VALUE_TEXTS = """(SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ts_ms, CASE event_id % 89 WHEN 0 THEN 'NaN' WHEN 1 THEN '+Inf' WHEN 2 THEN '-Inf' WHEN 3 THEN 'Inf'
    ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) || 'e-2' END AS text FROM events)"""
_PARSED = "CASE text WHEN 'NaN' THEN 'nan' WHEN '-Inf' THEN '-' WHEN '+Inf' THEN '+' WHEN 'Inf' THEN '+' ELSE 'finite' END AS kind, CASE WHEN text NOT LIKE '%N%' AND text NOT LIKE '%I%' THEN CAST(text AS DOUBLE) END AS value"

ORACLES = {k: f"WITH {BASE} {v}" for k, v in _BODY.items()} | {
    "sanitize_metric": f"SELECT doc_id, {_metric('text')} AS name FROM documents",
    "sanitize_label": f"SELECT doc_id, {_label('text')} AS name FROM documents",
    "snake_case": f"WITH {BASE}, {_TEXTS} SELECT key, lower(regexp_replace(regexp_replace(key, '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g'), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS snake FROM tt",
    "glob_match": f"WITH {BASE}, {_TEXTS} SELECT key, regexp_full_match(key, 'if.*|.*:.*|.th1') AS matched, lower(key) LIKE '%node%' AS any_case FROM tt",
    "label_truncate": """SELECT doc_id, CAST(n AS INTEGER) AS bytes, CASE WHEN h IS NOT NULL THEN sha256(unhex(substr(h, 1, 2 * n))) END AS sha256 FROM (
        SELECT doc_id, h, CASE WHEN len(h) <= 4096 THEN len(h) // 2 ELSE (SELECT max(k) FROM range(2045, 2049) t(k) WHERE substr(h, 2 * k + 1, 1) NOT IN ('8', '9', 'A', 'B')) END AS n
        FROM (SELECT doc_id, hex(encode(text)) AS h FROM documents))""",
    "parse_value": f"SELECT event_id, {_PARSED} FROM {_VALUE_TEXTS}",
    "parse_series_json": """SELECT c_nationkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name, c_mktsegment) - 1 AS INTEGER) AS pos,
        unnest(['__name__', 'customer', 'segment']) AS label, unnest(['up', c_name, c_mktsegment]) AS value FROM customer""",
    "parse_matrix_json": f"""SELECT user_id, event_type AS name, 0 AS series_ord, CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts_ms // 1000 || '.5,"' || text || '"]') - 1 AS INTEGER) AS idx,
        ts_ms // 1000 * 1000 + 500 AS ts_ms, {_PARSED} FROM {_VALUE_TEXTS}""",
    "request_paths": f"""WITH {BASE} SELECT DISTINCT node, '/api/v1/series?match[]=%7Bnode%3D%22' || replace(replace(node, ':', '%3A'), ' ', '+') || '%22%2Cjob%3D%7E%22snmp%7Cjmx+%2B+x%22%7D&start=1700000000' AS path
        FROM m WHERE node IS NOT NULL""",
    "backoff_schedule": "SELECT CAST(k AS INTEGER) AS k, CAST(least(100 * pow(2, k), 5000) AS BIGINT) AS pause_ms FROM range(10) t(k)",
    "step_derivation": """SELECT event_id, greatest(CASE WHEN coalesce(s, 0) <> 0 THEN greatest(1, s) ELSE greatest(1, span // 600) END, CAST(ceil(span / 11000.0) AS BIGINT)) AS step_s
        FROM (SELECT event_id, greatest(1, event_id * 7919) AS span, CASE WHEN event_id % 3 = 0 THEN event_id % 17 END AS s FROM events)""",
}
