"""Streaming queries.  The status feed is written in two parts in
time order; the stream runs ``availableNow`` after each part with the same
checkpoint, so state carried between runs decides what is emitted."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineark.operators import records
from lineark.plans.fixtures import fixture, with_views
from lineark.plans.q_records import STORE
from lineark.plans.registry import query
from lineark.session import scratch_path
from lineark.streaming import completion


def _feed(spark, sf_dir):
    """Status events split at the median time into two appended parts."""
    st = fixture(spark, sf_dir, "f_status").select("job_id", "event_id", "ts", "phase")
    cut = st.agg(F.percentile_approx("ts", 0.5)).scalar()
    return st.where(F.col("ts") < cut), st.where(F.col("ts") >= cut), st.schema


def _run(spark, sf_dir, light=False):
    first, second, schema = _feed(spark, sf_dir)
    src, out, ckpt = scratch_path(spark, "status"), scratch_path(spark, "done"), scratch_path(spark, "ckpt")
    first.write.mode("append").parquet(src)
    completion.run_available(spark, src, schema, out, ckpt, light=light)
    second.write.mode("append").parquet(src)
    completion.run_available(spark, src, schema, out, ckpt, light=light)
    return spark.read.parquet(out)


_FIRST = with_views(["f_status"], """
SELECT job_id, event_id, ts, phase,
       CASE WHEN phase = 'Failed' THEN 'Command Unrecognized.' ELSE '' END AS logs
FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts, event_id) AS rn
      FROM f_status WHERE phase IN ('Succeeded', 'Failed')) t WHERE rn = 1""")


@query("completion_stream", oracle=_FIRST)
def q_completion_stream(spark, sf_dir):
    """One row per job when it first reaches a terminal phase (keyed state, two stream runs)."""
    out = completion.with_logs(_run(spark, sf_dir))
    return out.select("job_id", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "phase", "logs")


@query("finalise_batch", oracle=with_views(["f_status", "f_outputs"], """,
first AS (SELECT job_id, ts, phase FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts, event_id) AS rn
  FROM f_status WHERE phase IN ('Succeeded', 'Failed')) t WHERE rn = 1),
o AS (SELECT 'ark:99999/' || split_part(path, '/', 2) AS job_id, path FROM f_outputs),
sup AS (SELECT job_id, COUNT(*) AS n,
               string_agg('ark:99999/' || substr(sha256('Dataset|' || job_id || '|' || path), 1, 32), ',' ORDER BY path) AS s
        FROM o GROUP BY job_id)
SELECT 'ark:99999/job-' || CAST(f.job_id AS VARCHAR) AS job_id, f.phase AS status, f.ts AS end_ts,
       CAST(coalesce(sup.n, 0) AS INTEGER) AS n_outputs, coalesce(sup.s, '') AS supports
FROM first f LEFT JOIN sup ON sup.job_id = 'ark:99999/job-' || CAST(f.job_id AS VARCHAR)"""))
def q_finalise_batch(spark, sf_dir):
    """Completed jobs finalised per micro-batch: outputs listed, records minted, rows written."""
    first, second, schema = _feed(spark, sf_dir)
    src, table_dir, ckpt = scratch_path(spark, "status"), scratch_path(spark, "final"), scratch_path(spark, "ckpt")
    outputs = fixture(spark, sf_dir, "f_outputs").select(
        F.concat(F.lit("ark:99999/"), F.split_part("path", F.lit("/"), F.lit(2))).alias("job_id"), "path")
    first.write.mode("append").parquet(src)
    completion.run_finalise(spark, src, schema, outputs, table_dir, ckpt, id_prefix="ark:99999/job-", **STORE)
    second.write.mode("append").parquet(src)
    completion.run_finalise(spark, src, schema, outputs, table_dir, ckpt, id_prefix="ark:99999/job-", **STORE)
    out = spark.read.parquet(table_dir).drop("batch")
    return out.withColumn("end_ts", F.col("end_ts").cast("timestamp_ntz"))


@query("finalise_records", oracle=with_views(["f_status", "f_outputs", "f_jobs"], """,
first AS (SELECT 'ark:99999/job-' || CAST(job_id AS VARCHAR) AS job_id, ts, phase FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts, event_id) AS rn
  FROM f_status WHERE phase IN ('Succeeded', 'Failed')) t WHERE rn = 1),
o AS (SELECT 'ark:99999/' || split_part(path, '/', 2) AS job_id, path FROM f_outputs),
sup AS (SELECT job_id, string_agg('ark:99999/' || substr(sha256('Dataset|' || job_id || '|' || path), 1, 32), ',' ORDER BY path) AS s
        FROM o GROUP BY job_id)
SELECT coalesce(j.job_id, f.job_id) AS job_id, coalesce(j.job_type, 'unknown') AS job_type, coalesce(f.phase, j.phase) AS status,
       CASE WHEN f.phase = 'Failed' THEN 'Command Unrecognized.' WHEN f.phase IS NOT NULL THEN '' END AS logs, f.ts AS end_ts,
       CASE WHEN f.job_id IS NOT NULL THEN sup.s END AS supports
FROM f_jobs j FULL JOIN first f ON f.job_id = j.job_id LEFT JOIN sup ON sup.job_id = f.job_id"""))
def q_finalise_records(spark, sf_dir):
    """The stored job records after two stream runs: outputs listed, minted, and the records updated in place."""
    first, second, schema = _feed(spark, sf_dir)
    src, table_dir, ckpt, ledger = (scratch_path(spark, x) for x in ("status", "records", "ckpt", "ledger"))
    base = fixture(spark, sf_dir, "f_jobs").select("job_id", "job_type", F.col("phase").alias("status"), F.lit(None).cast("string").alias("logs"),
                                                   F.lit(None).cast("timestamp_ntz").alias("end_ts"), F.lit(None).cast("array<string>").alias("supports"))
    records.write_records(base, table_dir, ["job_type"])
    spark.createDataFrame([], completion.LEDGER).write.json(ledger)
    listing = lambda s: fixture(s, sf_dir, "f_outputs").select(
        F.concat(F.lit("ark:99999/"), F.split_part("path", F.lit("/"), F.lit(2))).alias("job_id"), "path")
    write = completion.record_writer(listing, table_dir, ledger, id_prefix="ark:99999/job-", session=spark, **STORE)
    for part in (first, second):
        part.write.mode("append").parquet(src)
        completion.run_records(spark, src, schema, ckpt, write)
    out = spark.read.parquet(table_dir)
    return out.select("job_id", "job_type", "status", "logs", "end_ts", F.array_join("supports", ",").alias("supports"))
