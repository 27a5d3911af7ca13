"""Completion stream: one row per job, across runs, and the silence timer."""

from pyspark.sql import functions as F

from lineark.operators import records
from lineark.session import scratch_path
from lineark.sources.files import list_objects
from lineark.streaming import completion

SCHEMA = "job_id long, event_id long, ts timestamp_ntz, phase string"


def _run(spark, src, out, ckpt, timed, schema=SCHEMA, keep=86_400):
    stream = spark.readStream.schema(schema).parquet(src)
    ev = completion.completion_events_timed(stream, 60, "1 second", keep) if timed else completion.completion_events(stream)
    q = (ev.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True))
    with completion.with_rocksdb(spark):
        q.start().awaitTermination()


def _events(spark, rows):
    return spark.createDataFrame(rows, "job_id long, event_id long, t long, phase string") \
        .select("job_id", "event_id", F.timestamp_seconds("t").cast("timestamp_ntz").alias("ts"), "phase")


def test_exactly_once_across_runs(spark):
    src, out, ckpt = (scratch_path(spark, x) for x in ("s", "o", "c"))
    _events(spark, [(1, 1, 10, "Running"), (1, 2, 20, "Failed"), (2, 3, 15, "Pending")]).write.parquet(src)
    _run(spark, src, out, ckpt, False)
    _events(spark, [(1, 4, 30, "Succeeded"), (2, 5, 40, "Succeeded"), (2, 6, 50, "Failed")]) \
        .write.mode("append").parquet(src)
    _run(spark, src, out, ckpt, False)
    got = sorted((r.job_id, r.event_id, r.phase) for r in spark.read.parquet(out).collect())
    assert got == [(1, 2, "Failed"), (2, 5, "Succeeded")]


def test_silent_job_is_closed(spark):
    src, out, ckpt = (scratch_path(spark, x) for x in ("s", "o", "c"))
    _events(spark, [(1, 1, 10, "Running"), (2, 2, 12, "Running")]).write.parquet(src)
    _run(spark, src, out, ckpt, True)
    # job 2 finishes; much later job 3 moves event time (and the watermark) on
    _events(spark, [(2, 3, 30, "Succeeded"), (3, 4, 1000, "Running")]).write.mode("append").parquet(src)
    _run(spark, src, out, ckpt, True)
    _events(spark, [(3, 5, 1001, "Running")]).write.mode("append").parquet(src)
    _run(spark, src, out, ckpt, True)
    got = sorted((r.job_id, r.phase) for r in spark.read.parquet(out).collect())
    assert got == [(1, "Silent"), (2, "Succeeded")]


def test_state_ends(spark):
    src, out, ckpt = (scratch_path(spark, x) for x in ("s", "o", "c"))
    text = "job_id string, event_id string, ts timestamp_ntz, phase string"
    rows = lambda r: spark.createDataFrame(r, "job_id string, event_id string, t long, phase string").select(
        "job_id", "event_id", F.timestamp_seconds("t").cast("timestamp_ntz").alias("ts"), "phase")
    held = []
    for start in range(0, 5000, 1000):         # 20 new jobs at a time; the earlier ones are long over
        rows([(f"job{start}-{i}", "a", start + i, "Running") for i in range(20)] + [(f"job{start}-{i}", "b", start + 30 + i, "Succeeded") for i in range(10)]) \
            .write.mode("append").parquet(src)
        _run(spark, src, out, ckpt, True, text, keep=100)
        held.append(spark.read.format("statestore").option("stateVarName", "job").load(ckpt).count())
    # a restart each time; repeats within the time that an ended job is kept give nothing
    rows([("job4000-1", "c", 4040, "Failed")]).write.mode("append").parquet(src)
    _run(spark, src, out, ckpt, True, text, keep=100)
    got = sorted((r.job_id, r.phase) for r in spark.read.parquet(out).collect())
    assert len(got) == len({j for j, _ in got}) and {j for j, p in got if p == "Succeeded"} == {f"job{s}-{i}" for s in range(0, 5000, 1000) for i in range(10)}
    assert {j for j, p in got if p == "Silent"} >= {f"job{s}-{i}" for s in range(0, 3000, 1000) for i in range(10, 20)}
    assert max(held) <= 60                  # 100 jobs in all


def test_records_are_equal_however_often_a_batch_runs(spark):
    import datetime
    import os
    root = scratch_path(spark, "store").removeprefix("file:")
    for job, names in {"1": ["b.csv", "a.csv"], "2": [], "3": ["x.nii"]}.items():
        os.makedirs(f"{root}/{job}")
        for n in names:
            open(f"{root}/{job}/{n}", "w").write("x")
    listing = lambda s: list_objects(s, root).select(
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("job_id"), F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("path"))
    at = lambda t: datetime.datetime(2024, 1, 1, 0, 0, t)
    base = spark.createDataFrame([("1", "custom", "Running", None, None, None), ("2", "nipype", "Running", None, None, ["old"]), ("9", "custom", "Running", None, None, None)],
                                 "job_id string, job_type string, status string, logs string, end_ts timestamp_ntz, supports array<string>")
    batches = [spark.createDataFrame([(1, "Succeeded", at(1)), (3, "Failed", at(2))], "job_id long, phase string, ts timestamp_ntz"),
               spark.createDataFrame([(2, "Succeeded", at(3))], "job_id long, phase string, ts timestamp_ntz")]
    tables = []
    for order in ([0, 1], [0, 0, 1, 1, 0], "broken"):
        table_dir, ledger = scratch_path(spark, "records"), scratch_path(spark, "ledger")
        records.write_records(base, table_dir, ["job_type"])
        spark.createDataFrame([], completion.LEDGER).write.json(ledger)
        write = completion.record_writer(listing, table_dir, ledger, "http://store/", "bucket/", "")
        if order == "broken":               # the table was written, the ledger's last row was not
            write(batches[0], 0)
            begun = spark.read.schema(completion.LEDGER).json(ledger).where("state = 'begun'").collect()
            ledger = scratch_path(spark, "ledger")
            spark.createDataFrame(begun, completion.LEDGER).write.json(ledger)
            write = completion.record_writer(listing, table_dir, ledger, "http://store/", "bucket/", "")
            order = [0, 1]
        for b in order:
            write(batches[b], b)
        tables.append(sorted(map(str, spark.read.parquet(table_dir).select(*base.columns).collect())))
        done = spark.read.schema(completion.LEDGER).json(ledger).where("state = 'done'").groupBy("batch_id").count().count()
        assert done == 2
    assert tables[0] == tables[1] == tables[2]
    got = {r.job_id: r for r in spark.read.parquet(table_dir).collect()}
    assert got["1"].status == "Succeeded" and len(got["1"].supports) == 2 and got["2"].supports == ["old"]
    assert got["3"].job_type == "unknown" and got["3"].status == "Failed" and got["9"].status == "Running"


def test_a_batch_is_computed_once(spark, tmp_path):
    """The keyed state of a batch runs once, however often the finalising body uses its rows."""
    from lineark.operators import records
    seen = spark.sparkContext.accumulator(0)

    def count(pdfs):
        for pdf in pdfs:
            seen.add(len(pdf))
            yield pdf

    rows = [(1, 10, "Succeeded"), (2, 11, "Failed"), (7, 12, "Succeeded")]
    batch = spark.createDataFrame(rows, "job_id long, ts long, phase string").mapInPandas(count, "job_id long, ts long, phase string")
    outputs = spark.createDataFrame([("j1", "a/x.csv"), ("j1", "a/y.csv"), ("j9", "b/z.csv"), (None, "c")], "job_id string, path string")
    completion.finalise_batch_writer(outputs, str(tmp_path / "final"), "s", "/r/", "j")(batch, 0)
    got = {r.job_id: (r.status, r.end_ts, r.n_outputs) for r in spark.read.parquet(str(tmp_path / "final")).collect()}
    assert got == {"j1": ("Succeeded", 10, 2), "j2": ("Failed", 11, 0), "j7": ("Succeeded", 12, 0)}
    assert seen.value == len(rows)
    completion.finalise_batch_writer(outputs, str(tmp_path / "none"), "s", "/r/", "j")(batch.where("job_id > 7"), 0)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0

    table, ledger = str(tmp_path / "records"), str(tmp_path / "ledger")
    base = spark.createDataFrame([("j1", "a", "Running", None, None, None), ("j3", "b", "Running", None, None, ["o"])],
                                 "job_id string, job_type string, status string, logs string, end_ts long, supports array<string>")
    records.write_records(base, table, ["job_type"])
    spark.createDataFrame([], completion.LEDGER).write.json(ledger)
    seen.value = 0
    completion.record_writer(lambda s: outputs, table, ledger, "s", "/r/", "j")(batch, 0)
    got = {r.job_id: (r.job_type, r.status, r.end_ts, len(r.supports or [])) for r in spark.read.parquet(table).collect()}
    assert got == {"j1": ("a", "Succeeded", 10, 2), "j2": ("unknown", "Failed", 11, 0), "j3": ("b", "Running", None, 1),
                   "j7": ("unknown", "Succeeded", 12, 0)}
    assert seen.value == len(rows)


def test_earliest_row_is_that_of_a_sort():
    import pandas as pd
    t = pd.to_datetime(["2024-01-02", None, "2024-01-01", "2024-01-01"])
    for event in ([1, 2, 9, 3], [1.0, 2.0, None, 3.0], ["a", "b", None, "c"], ["a", "b", "d", "c"]):
        pdf = pd.DataFrame({"job_id": 1, "event_id": event, "ts": t, "phase": "Failed"})
        assert completion._earliest(pdf).index[0] == pdf.sort_values(["ts", "event_id"]).index[0] == 3
