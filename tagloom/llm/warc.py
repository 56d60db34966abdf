"""Deterministic sharded WARC archives: writer and reader."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import fresh_path, materialize, parts_of, range_bounds, range_part, ship, tidy

_LEAST = -(1 << 63)
#: Compressed bytes at which a file is closed.
ROLL = 32 << 20
#: Fixed values of the format.
VERSION, DATE = "WARC/1.1", "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: int, copy: int, url: str | None, payload: bytes, refers: int | None) -> bytes:
    """One record. Its id is made of the page's number, and of how many records
    of that number came before."""
    head = [
        VERSION, f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{key}:{copy}>",
        f"WARC-Date: {DATE}", "WARC-Payload-Digest: sha1:" + digest(payload), f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers}:0>", "WARC-Profile: " + PROFILE]
    body = payload if refers is None else b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode("utf-8") + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict((k.lower(), v) for k, v in (x.split(": ", 1) for x in lines[1:]))
    body = rest[: int(fields["content-length"])]
    if rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("a record ends early")
    return fields, body


def _member(raw: bytes) -> bytes:
    """A gzip member with no time in it: equal records give equal bytes."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def members(data: bytes, step: int = 1 << 16):
    """The contents of the gzip members of a file, one after the other."""
    at = 0
    while at < len(data):
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if at >= len(data):
                raise ValueError("the file ends inside a record")
            out.append(z.decompress(data[at : at + step]))
            at = min(at + step, len(data)) - len(z.unused_data)
        yield b"".join(out)


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, path: str, least: int = 0, roll: int = ROLL) -> DataFrame:
    """Write a record for each row of pages (page_id, url, html) under `path` (a
    URI that all executors reach) and return the manifest (file, records, bytes,
    sha256), which is also kept there.

    Of equal payloads of at least `least` bytes the one with the smallest page_id
    is a response and the others revisit it; smaller ones are all responses.
    Rows are range-sorted by page_id; cuts come from a hash sample, so they
    depend on the rows alone, and so do the files: each range rolls to a new
    file at `roll` compressed bytes. Tasks write under names of their own
    attempt; the manifest lists what the attempts that count wrote; only then
    are those files moved to their names, which can be done again safely. Pages
    travel once; revisits reach the writer as slim rows sorted before them.

    Null html is empty, null page_id comes first and is kept, repeated rows are
    revisits of the first of them, an empty table gives an empty manifest. Other
    columns are ignored.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(_LEAST)).alias("k"), "url",
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    slim = rows.select("k", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n"))
    firsts = slim.where(F.col("n") >= least).groupBy("sha").agg(F.min("k").alias("first"), F.count("*").alias("copies"))
    firsts = materialize(firsts.where("copies > 1").drop("copies"), "warc-firsts")
    repeats = slim.join(firsts, "sha").groupBy("k", "sha", "first").count()

    part = range_part("k", range_bounds(rows, "k", 2 * parts_of(spark)))
    none = lambda t: F.lit(None).cast(t)
    marks = repeats.select(part.alias("part"), "k", F.lit(0).alias("page"), none("string").alias("url"), none("binary").alias("payload"), "sha", "first")
    whole = rows.select(part.alias("part"), "k", F.lit(1).alias("page"), "url", "payload", none("string").alias("sha"), none("long").alias("first"))
    dealt = marks.unionByName(whole).repartition(parts_of(spark), "part").sortWithinPartitions("part", "k", "page", "url", "payload")
    temp = path + "/_temporary"

    def write(batches):
        fs, base = _filesystem(temp)
        fs.create_dir(base, recursive=True)
        attempt, made = uuid.uuid4().hex, []
        sink = name = at = key = None
        count = size = roll_no = copy = 0
        check, firsts = hashlib.sha256(), {}

        def close():
            nonlocal sink
            if sink is not None:
                sink.close()
                made.append((f"{name}.{attempt}", name, count, size, check.hexdigest()))
                sink = None

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != at:
                    close()
                    at, roll_no = row["part"], 0
                if row["k"] != key:
                    key, copy, firsts = row["k"], 0, {}
                if not row["page"]:
                    firsts[row["sha"]] = row["first"]
                    continue
                payload = row["payload"]
                sha = hashlib.sha1(payload).hexdigest() if firsts else None
                first = firsts.get(sha)
                refers = None if first is None or first == key else first
                if first == key:
                    firsts[sha] = ("written", copy)
                elif isinstance(first, tuple):
                    refers = key
                raw = _member(record(key, copy, row["url"], payload, None if refers is None else refers))
                copy += 1
                if sink is not None and size >= roll:
                    close()
                    roll_no += 1
                if sink is None:
                    name = f"part-{at:05d}-{roll_no:05d}.warc.gz"
                    sink, count, size, check = fs.open_output_stream(f"{base}/{name}.{attempt}", compression=None), 0, 0, hashlib.sha256()
                sink.write(raw)
                check.update(raw)
                count, size = count + 1, size + len(raw)
        close()
        columns = list(zip(*made, strict=True)) or [()] * 5
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["temp", "file", "records", "bytes", "sha256"])

    made = materialize(dealt.mapInArrow(tidy(write), "temp string, file string, records long, bytes long, sha256 string"), "warc-made")

    def commit(batches):
        from pyarrow import fs as arrow_fs

        for batch in batches:
            fs, base = _filesystem(path)
            for source, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if fs.get_file_info(f"{base}/_temporary/{source}").type != arrow_fs.FileType.NotFound:
                    fs.move(f"{base}/_temporary/{source}", f"{base}/{name}")
                elif fs.get_file_info(f"{base}/{name}").type == arrow_fs.FileType.NotFound:
                    raise FileNotFoundError(f"{base}/{name}")
            yield batch.select(["file", "records", "bytes", "sha256"])

    manifest = path + "/manifest"
    made.repartition(parts_of(spark)).mapInArrow(tidy(commit), "file string, records long, bytes long, sha256 string").write.parquet(manifest)
    return spark.read.schema("file string, records long, bytes long, sha256 string").parquet(manifest)


def read_archives(spark, path: str) -> DataFrame:
    """The records of the archives that the manifest under `path` lists: page_id,
    copy, url, record_type, payload_bytes, payload_digest, refers_to, payload
    (null for revisits). Files and payloads are held against their digests."""
    ship(spark)
    manifest = spark.read.schema("file string, records long, bytes long, sha256 string").parquet(path + "/manifest")

    def number(urn: str) -> int | None:
        found = int(urn.removeprefix("<urn:page:").split(":")[0])
        return None if found == _LEAST else found

    def read(batches):
        fs, base = _filesystem(path)
        for batch in batches:
            for entry in batch.to_pylist():
                with fs.open_input_stream(f"{base}/{entry['file']}", compression=None) as f:
                    data = f.read()
                if hashlib.sha256(data).hexdigest() != entry["sha256"]:
                    raise ValueError(f"{entry['file']} is not what the manifest lists")
                rows, size = [], 0
                for raw in members(data):
                    head, body = parse(raw)
                    named = head["warc-payload-digest"].removeprefix("sha1:")
                    response = head["warc-type"] == "response"
                    if response and (digest(body) != named or len(body) != int(head["x-payload-length"])):
                        raise ValueError(f"{head['warc-record-id']} has another payload than its digest says")
                    rows.append((
                        number(head["warc-record-id"]), int(head["warc-record-id"].rstrip(">").split(":")[-1]), head.get("warc-target-uri"),
                        head["warc-type"], int(head["x-payload-length"]), named,
                        None if response else number(head["warc-refers-to"]), body if response else None))
                    size += len(body)
                    if size > 8 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), KINDS, strict=True)], names=NAMES)

    return manifest.select("file", "sha256").repartition(parts_of(spark), "file").mapInArrow(tidy(read), "page_id long, copy long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


NAMES = ["page_id", "copy", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write pages under the shared folder and read the archives back."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
