"""Job completion tracking with Structured Streaming.

Instead of one polling thread per job, a stream of
status events ``(job_id, event_id, ts, phase)`` is keyed by job; a job emits
exactly one row the first time it leaves Pending/Running, and the keyed state
remembers that it did, across micro-batches and restarts (checkpointed state,
file sink with its own commit log).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lineark.functions.text import log_default
from lineark.session import scratch_path

TERMINAL = ("Succeeded", "Failed")
STATE_SCHEMA = "done boolean"
COLUMNS = ("job_id", "event_id", "ts", "phase")
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _schema(stream: DataFrame) -> str:
    """DDL of the output rows: the stream's own types, so job and event IDs may be numbers or text."""
    types = dict(stream.dtypes)
    return ", ".join(f"`{c}` {types[c]}" for c in COLUMNS)


def _earliest(pdf: pd.DataFrame) -> pd.DataFrame:
    """The row with the smallest ``(ts, event_id)``, NULLs last, as a frame."""
    if len(pdf) == 1:
        return pdf
    ts, event = pdf["ts"].to_numpy(), pdf["event_id"].to_numpy()
    if ts.dtype == object or event.dtype == object:
        return pdf.sort_values(["ts", "event_id"]).head(1)
    i = int(np.lexsort((event, ts))[0])
    return pdf.iloc[i:i + 1]


def _first_terminal(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Per job: emit the earliest terminal event once; later ones are ignored.

    The group's rows arrive as Arrow batches; only the running earliest row is
    kept, so a job with a very long feed never sits in memory at once."""
    best = None
    for pdf in pdfs:
        if state.exists or not len(pdf):
            continue
        top = _earliest(pdf)
        if best is None or (top["ts"].iloc[0], top["event_id"].iloc[0]) < (best["ts"].iloc[0], best["event_id"].iloc[0]):
            best = top
    if best is None:
        return
    state.update((True,))
    yield best if tuple(best.columns) == COLUMNS else best[list(COLUMNS)]


def _ended_rows(spark: SparkSession, batch: DataFrame) -> DataFrame:
    """A micro-batch's rows, written once and read in ``spark``: the keyed state runs once however often
    they are used, and what follows is planned by that session, adaptively, not by the stream's."""
    path = scratch_path(batch.sparkSession, "ended")
    batch.write.parquet(path)
    return spark.read.schema(batch.schema).parquet(path)


def completion_events(stream: DataFrame, job: str = "job_id") -> DataFrame:
    """Keyed-state form: one output row per job, at its first terminal phase.
    Needs no watermark, so event times keep their type (no time-zone cast)."""
    terminal = stream.where(F.col("phase").isin(*TERMINAL))
    return terminal.groupBy(job).applyInPandasWithState(
        _first_terminal, _schema(stream), STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


SILENT = "Silent"


class Tracker(StatefulProcessor):
    """Keyed state of one job that ends.

    A job emits one row: its first terminal event, or ``Silent`` when ``silent_us`` of event time
    have passed (by the watermark) since its last event.  An event-time timer then keeps the
    state for ``keep_us`` more, so that repeats are known, and clears it; so the state holds
    the jobs that are running or have ended lately, not every job there ever was."""

    def __init__(self, silent_us: int, keep_us: int):
        self.silent_us, self.keep_us = silent_us, keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("job", "done boolean, last_us long, timer_ms long")

    def _remember(self, done: bool, last_us: int, old_timer: int | None, wait_us: int) -> None:
        timer = (last_us + wait_us) // 1000
        if old_timer != timer:
            if old_timer is not None:
                self.handle.deleteTimer(old_timer)
            self.handle.registerTimer(timer)
        self.state.update((done, last_us, timer))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done, last_us, timer = self.state.get() if self.state.exists() else (False, None, None)
        best = None
        for pdf in rows:
            if not len(pdf):
                continue
            stamp = int(pdf["ts"].max().value // 1000)
            last_us = stamp if last_us is None else max(last_us, stamp)
            ended = pdf[pdf["phase"].isin(TERMINAL)]
            if len(ended) and not done:
                top = ended.sort_values(["ts", "event_id"]).head(1)
                if best is None or (top["ts"].iloc[0], top["event_id"].iloc[0]) < (best["ts"].iloc[0], best["event_id"].iloc[0]):
                    best = top
        if last_us is None:
            return
        over = done or best is not None
        self._remember(over, last_us, timer, self.keep_us if over else self.silent_us)
        if best is not None:
            yield best[list(COLUMNS)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        done, last_us, timer = self.state.get()
        if timer is not None and expiredTimerInfo.getExpiryTimeInMs() < timer:
            return                  # a later event has moved the timer
        if done:
            self.state.clear()
            return
        self._remember(True, last_us, None, self.silent_us + self.keep_us)
        yield pd.DataFrame({"job_id": [key[0]], "event_id": [None], "ts": [pd.Timestamp(last_us, unit="us")], "phase": [SILENT]})[list(COLUMNS)]

    def close(self) -> None:
        pass


def completion_events_timed(stream: DataFrame, silent_after_s: int, delay: str = "10 minutes", keep_s: int = 86_400) -> DataFrame:
    """Like :func:`completion_events`, but every event counts as a sign of life and
    a job silent for ``silent_after_s`` seconds of event time is closed with a ``Silent``
    row; ``keep_s`` seconds after that, or after its last event once it ended, its state goes.  An event of the
    job that comes later begins a new life.  Start the query with :func:`with_rocksdb`."""
    events = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return events.groupBy("job_id").transformWithStateInPandas(
        Tracker(silent_after_s * 1_000_000, keep_s * 1_000_000), _schema(events), "append", "EventTime")


@contextmanager
def with_rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which timers need."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def completion_events_light(stream: DataFrame, job: str = "job_id", delay: str = "1 hour") -> DataFrame:
    """Watermark form: drop repeated terminal rows of a job within ``delay``
    (state is bounded by the watermark; a duplicate later than that re-emits).
    Watermarks need TIMESTAMP, so event times are read in the session time
    zone (keep it UTC)."""
    terminal = stream.where(F.col("phase").isin(*TERMINAL)).withColumn("ts", F.col("ts").cast("timestamp"))
    return terminal.withWatermark("ts", delay).dropDuplicatesWithinWatermark([job])


def run_available(spark: SparkSession, source_dir: str, schema, out_dir: str, checkpoint: str,
                  light: bool = False) -> None:
    """Process everything now in ``source_dir`` (``availableNow``) into ``out_dir``."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    events = completion_events_light(stream) if light else completion_events(stream)
    q = (events.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def with_logs(completions: DataFrame, logs: DataFrame | None = None, job: str = "job_id") -> DataFrame:
    """Attach pod logs (empty when unknown) with the default text for failures."""
    out = completions if logs is None else completions.join(logs.select(job, "log"), job, "left")
    log = F.col("log") if logs is not None else F.lit("")
    return out.withColumn("logs", log_default(F.col("phase"), F.coalesce(log, F.lit(""))))


def finalise_batch_writer(outputs: DataFrame, table_dir: str, store_url: str, root: str, id_prefix: str):
    """``foreachBatch`` body: for the jobs completed in a batch, list their
    outputs, mint the records and write the finished job rows.  A job's record ID is
    ``id_prefix`` and its job ID; ``store_url`` and ``root`` say where outputs lie.  Each
    batch overwrites its own folder, so a replayed batch writes the same rows."""
    from lineark.operators import records

    def write(batch: DataFrame, batch_id: int) -> None:
        ended = _ended_rows(outputs.sparkSession, batch)
        done = ended.select(F.concat(F.lit(id_prefix), F.col("job_id").cast("string")).alias("job"),
                            "phase", "ts")
        outs = outputs.join(done.select(F.col("job").alias("job_id")), "job_id", "left_semi")
        minted = records.mint_outputs(outs, store_url, root)
        sup = records.ordered_list(minted, "job_id", "path", "dataset_id", "supports")
        rows = (done.join(sup, done["job"] == sup["job_id"], "left")
                .select(F.col("job").alias("job_id"), F.col("phase").alias("status"),
                        F.col("ts").alias("end_ts"),
                        F.coalesce(F.size("supports"), F.lit(0)).alias("n_outputs"),
                        F.coalesce(F.array_join("supports", ","), F.lit("")).alias("supports")))
        if ended.isEmpty():
            rows = rows.limit(0)        # no outputs are listed for a batch without ended jobs
        rows.write.mode("overwrite").parquet(f"{table_dir}/batch={batch_id}")

    return write


def run_finalise(spark: SparkSession, source_dir: str, schema, outputs: DataFrame, table_dir: str,
                 checkpoint: str, store_url: str, root: str, id_prefix: str) -> None:
    stream = spark.readStream.schema(schema).parquet(source_dir)
    q = (completion_events(stream).writeStream.foreachBatch(finalise_batch_writer(outputs, table_dir, store_url, root, id_prefix))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def record_writer(listing: Callable[[SparkSession], DataFrame], table_dir: str, ledger_dir: str, store_url: str, root: str,
                  id_prefix: str, other_type: str = "unknown", session: SparkSession | None = None):
    """``foreachBatch`` body that lists, mints and updates in one chain.

    For the jobs that ended in a batch: ``listing`` (such as ``list_objects``) gives the files with
    ``job_id, path``; ``mint_outputs`` names them; ``upsert_table`` finishes the jobs' records
    in the table at ``table_dir``, which is partitioned by ``job_type``, and rewrites only the
    partitions it touches.  A job without a record gets one of type ``other_type``.  The work is done in
    ``session`` (default: the batch's own, in which adaptive execution is off).

    The ledger has one row per batch and partition, written first as begun and, after the table, as
    done.  A batch that is done is not applied again, and one that broke off is applied as a
    whole: it sets the same values, so the table is the same however often it ran."""
    from lineark.operators import records

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = session or batch.sparkSession
        states = {r.state for r in spark.read.schema(LEDGER).json(ledger_dir).where(F.col("batch_id") == batch_id).select("state").distinct().collect()}
        if "done" in states:
            return
        ended = _ended_rows(spark, batch)
        if ended.isEmpty():
            return
        ended = ended.select(F.concat(F.lit(id_prefix), F.col("job_id").cast("string")).alias("job_id"), "phase", "ts")
        # only the records of the ended jobs, not the whole table, are looked up
        known = spark.read.parquet(table_dir).select("job_id", "job_type").join(ended.select("job_id"), "job_id", "left_semi")
        ended = with_logs(ended.join(known, "job_id", "left").withColumn("job_type", F.coalesce("job_type", F.lit(other_type))))
        files = listing(spark).join(ended.select("job_id"), "job_id", "left_semi")
        made = records.ordered_list(records.mint_outputs(files, store_url, root), "job_id", "path", "dataset_id", "supports")
        updates = ended.join(made, "job_id", "left").select("job_id", "job_type", F.col("phase").alias("status"), "logs", F.col("ts").alias("end_ts"), "supports")
        # written once: listed, minted and joined to their records only here
        path = scratch_path(spark, "updates")
        updates.write.parquet(path)
        updates = spark.read.schema(updates.schema).parquet(path)
        parts = updates.groupBy("job_type").agg(F.count("*").alias("rows")).withColumn("batch_id", F.lit(batch_id).cast("long"))
        parts = parts.checkpoint()
        parts.withColumn("state", F.lit("begun")).select("batch_id", "job_type", "rows", "state").write.mode("append").json(ledger_dir)
        records.upsert_table(spark, table_dir, updates, "job_id", ["job_type"])
        parts.withColumn("state", F.lit("done")).select("batch_id", "job_type", "rows", "state").write.mode("append").json(ledger_dir)

    return write


LEDGER = "batch_id long, job_type string, rows long, state string"


def run_records(spark: SparkSession, source_dir: str, schema, checkpoint: str, write) -> None:
    """Apply ``write`` (see :func:`record_writer`) to everything now in ``source_dir``."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    (completion_events(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
