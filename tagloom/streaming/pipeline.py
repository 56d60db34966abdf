"""Shipping: retries, outcomes, overflow policies, and the streaming job."""

from __future__ import annotations

import math
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.config import Config
from tagloom.operators.labels import map_labels, valid
from tagloom.operators.series import batch_summary, wire_series, with_series
from tagloom.sources.wal import Wal
from tagloom.sources.wire import compress, encoder, payloads

SUCCESS, CLIENT, SERVER, TRANSPORT = "success", "dropped_4xx", "dropped_5xx", "dropped_transport"


@dataclass(frozen=True)
class Outcome:
    kind: str
    attempts: int


def classify(status: int | None) -> str:
    """None: no answer came. What is neither success nor 4xx counts as 5xx."""
    if status is None:
        return TRANSPORT
    return SUCCESS if 200 <= status < 300 else CLIENT if 400 <= status < 500 else SERVER


def backoffs(first_ms: int, most_ms: int, attempts: int) -> list[int]:
    """Pauses between the attempts: doubled, up to the most."""
    return [min(first_ms * 2**k, most_ms) for k in range(max(1, attempts) - 1)]


def send(payload: bytes, post: Callable[[bytes], int], cfg: Config, sleep: Callable[[float], None] = time.sleep) -> Outcome:
    """Post until it succeeds, is refused (4xx), or the attempts are used up;
    the last attempt decides."""
    pauses, kind = backoffs(cfg.retry_initial_backoff_ms, cfg.retry_max_backoff_ms, cfg.retry_attempts), TRANSPORT
    for n in range(len(pauses) + 1):
        try:
            kind = classify(post(payload))
        except OSError:
            kind = TRANSPORT
        if kind in (SUCCESS, CLIENT):
            return Outcome(kind, n + 1)
        if n < len(pauses):
            sleep(pauses[n] / 1000)
    return Outcome(kind, len(pauses) + 1)


def accepted(df: DataFrame, capacity: int) -> DataFrame:
    """Backpressure: arrivals beyond the capacity are refused (`accepted`)."""
    return df.withColumn("accepted", F.col("seq") < capacity)


def retained(segments: DataFrame, most_bytes: int) -> DataFrame:
    """Drop oldest: (segment, bytes) with `kept`, true for the newest segments
    whose sizes add up to the cap at most, and always for the newest."""
    newer = Window.orderBy(F.col("segment").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return segments.withColumn("total", F.sum("bytes").over(newer)).withColumn(
        "kept", (F.col("total") <= most_bytes) | (F.row_number().over(Window.orderBy(F.col("segment").desc())) == 1)).drop("total")


# Names of counters and gauges.
COUNTERS = (
    "samples_written", "samples_dropped_4xx", "samples_dropped_5xx", "samples_dropped_transport", "samples_dropped_nonfinite", "samples_dropped_duplicate",
    "samples_dropped_wal_full", "unparseable_resource_id", "synthesized_mtype", "wal_bytes_written", "wal_bytes_checkpointed", "wal_replay_samples",
    "wal_batches_dropped_4xx", "wal_frames_dropped_corrupted", "find_metrics_single_pass", "find_metrics_two_phase", "find_metrics_phase2_batches",
)
GAUGES = ("queue_depth", "delete_noop", "metadata_denylist_blocked", "dropped_queue_full", "wal_disk_usage_bytes", "wal_segments_active", "wal_pending_samples")


class Stats:
    """Counters, which only grow, and gauges, which are asked for."""

    def __init__(self):
        self.counters: Counter[str] = Counter()
        self.gauges: dict[str, Callable[[], float]] = {}

    def add(self, found: dict[str, int]) -> None:
        self.counters.update({k: v for k, v in found.items() if v})

    @property
    def failed(self) -> int:
        """Samples that never arrived: refused, or given up."""
        return sum(self.counters["samples_" + k] for k in (CLIENT, SERVER, TRANSPORT))

    def rows(self) -> list[tuple[str, str, float]]:
        """(kind, name, value): counters by name, then gauges by name."""
        counted = [("counter", n, float(self.counters[n])) for n in sorted({*COUNTERS, *self.counters})]
        return counted + [("gauge", n, float(self.gauges[n]() if n in self.gauges else 0)) for n in sorted({*GAUGES, *self.gauges})]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "kind string, name string, value double")


class Shipper:
    """foreachBatch sink. In durable mode a batch that the far side could not
    take raises, is not committed and comes again; a refused one (4xx) is
    dropped. Otherwise every failure drops the batch. Messages are posted where
    their series are, by the executors, in order within a partition; the driver
    sees sums of samples for each outcome. Counters move only when a batch is
    through: one that raises, and comes again, has counted nothing. `post` has to
    be a function that can be sent to executors."""

    def __init__(self, post: Callable[[bytes], int], cfg: Config | None = None, durable: bool = True, sleep: Callable[[float], None] = time.sleep):
        self.post, self.cfg, self.durable, self.sleep = post, (cfg or Config()).validate(), durable, sleep
        self.stats = Stats()

    @property
    def counters(self) -> Counter[str]:
        return self.stats.counters

    def __call__(self, batch: DataFrame, number: int) -> None:
        mapped = with_series(valid(map_labels(batch, self.cfg))).persist()
        try:
            summary = batch_summary(mapped).first()
            outcomes = posted(payloads(wire_series(mapped), self.cfg.wire_version, self.cfg.batch_size), self.post, self.cfg, self.durable, self.sleep)
            sums = {r["kind"]: r["samples"] for r in outcomes.groupBy("kind").agg(F.sum("samples").alias("samples")).collect()}  # a row for each outcome
            unparseable = mapped.where("unparseable").count()
        finally:
            mapped.unpersist()
        failed = [k for k in (SERVER, TRANSPORT) if sums.get(k)]
        if self.durable and failed:
            raise ConnectionError(f"batch {number}: {failed[0]}, {sum(sums[k] for k in failed)} samples")
        found = {"samples_written" if k == SUCCESS else "samples_" + k: v for k, v in sums.items()}
        found |= {"samples_" + k: summary[k] or 0 for k in ("dropped_nonfinite", "dropped_duplicate")}
        self.stats.add(found | {"unparseable_resource_id": unparseable})


def posted(messages: DataFrame, post: Callable[[bytes], int], cfg: Config, durable: bool, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(kind, samples) of every message (samples, payload), posted by the tasks
    that hold them; in durable mode a partition stops at its first failure."""

    def run(batches):
        for batch in batches:
            kinds = []
            for payload in batch.column(1).to_pylist():
                kinds.append(send(payload, post, cfg, sleep).kind)
                if durable and kinds[-1] in (SERVER, TRANSPORT):
                    break
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), batch.column(0)[: len(kinds)]], names=["kind", "samples"])
            if durable and kinds and kinds[-1] in (SERVER, TRANSPORT):
                return

    return messages.select("samples", "payload").mapInArrow(run, "kind string, samples long")


class WalShipper:
    """Ingest through a write-ahead log: what is mapped is appended, and what the
    log holds is sent in batches. Success and refusal (4xx) move the checkpoint;
    any other failure leaves it, and the same entries come again. Counters move
    after the checkpoint is on disk."""

    def __init__(self, log: Wal, post: Callable[[bytes], int], cfg: Config | None = None, sleep: Callable[[float], None] = time.sleep):
        self.log, self.post, self.cfg, self.sleep, self.stats = log, post, (cfg or Config()).validate(), sleep, Stats()
        self.stats.gauges |= {"wal_disk_usage_bytes": log.size, "wal_segments_active": lambda: len(log.segments()), "wal_pending_samples": log.pending}

    def ingest(self, batch: DataFrame, number: int = 0) -> int:
        """Appends a micro-batch; how many entries the log took. A full log
        refuses one entry and all behind it. One log is one node's: its entries
        pass through the driver one at a time."""
        took, rest, size = 0, 0, self.log.end()
        for row in valid(map_labels(batch, self.cfg)).select("labels", "ts_ms", "value").toLocalIterator():
            if rest or not self.log.append(row["labels"], row["ts_ms"], row["value"]):
                rest += 1
            else:
                took += 1
        self.log.flush()
        self.stats.add({"samples_dropped_wal_full": rest, "wal_bytes_written": self.log.end() - size})
        return took

    def flush(self) -> bool:
        """Sends one batch; False if nothing was there or the far side failed."""
        start = self.log.checkpoint()
        entries, end, dead = self.log.read(self.cfg.batch_size)
        if end <= start:
            return False
        series, nonfinite, duplicate = grouped(entries)
        kept = sum(len(s) for _, s in series)
        kind = send(compress(encoder(self.cfg.wire_version)(series)), self.post, self.cfg, self.sleep).kind if series else SUCCESS
        if kind in (SERVER, TRANSPORT):
            return False
        self.log.advance(end)
        self.stats.add({
            "samples_written" if kind == SUCCESS else "samples_" + kind: kept, "wal_batches_dropped_4xx": int(kind == CLIENT), "samples_dropped_nonfinite": nonfinite,
            "samples_dropped_duplicate": duplicate, "wal_frames_dropped_corrupted": len(dead), "wal_bytes_checkpointed": end - start})
        return True

    def drain(self) -> int:
        """Sends all that is there; how many batches went through."""
        n = 0
        while self.flush():
            n += 1
        return n


def grouped(entries: list[tuple[dict[str, str], int, float]]) -> tuple[list, int, int]:
    """Series (sorted labels, samples by time) of a batch of log entries, the last
    write of equal times, and how many were not finite or overwritten."""
    found: dict[tuple, dict[int, float]] = {}
    nonfinite = duplicate = 0
    for labels, ts_ms, value in entries:
        if not math.isfinite(value):
            nonfinite += 1
            continue
        own = found.setdefault(tuple(sorted(labels.items())), {})
        duplicate += ts_ms in own
        own[ts_ms] = value
    return [(list(k), sorted(v.items())) for k, v in found.items()], nonfinite, duplicate


def start(stream: DataFrame, shipper: Shipper, checkpoint: str, once: bool = False):
    """Run the sink over a stream of samples: every flush interval, or over what
    is there and no more (once)."""
    writer = stream.writeStream.foreachBatch(shipper).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{shipper.cfg.flush_interval_ms} milliseconds")
    return writer.start()


def dedup_stream(stream: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Last write wins over a stream (series_id, ts, seq, value), with state
    bounded by the watermark."""
    return stream.withWatermark("ts", watermark).groupBy("series_id", "ts").agg(F.max_by("value", "seq").alias("value"), F.count("*").alias("copies"))
