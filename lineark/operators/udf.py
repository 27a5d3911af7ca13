"""User-function surface: grouped map, per-partition map, the job contract, demo column."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scale_column(df: DataFrame, src: str, dst: str, factor) -> DataFrame:
    """``dst = src * factor`` (a scaled copy of one column)."""
    return df.withColumn(dst, F.col(src) * F.lit(factor))


def grouped_map(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
                schema, single_row_groups: bool = False) -> DataFrame:
    """Run ``fn(pandas frame) -> pandas frame`` per group with a declared schema.

    General groups go through ``groupBy(keys).applyInPandas`` (one shuffle;
    each group is one pandas frame, so groups must fit a task).  When every
    group is a single row by construction (a job that groups by a
    generated row key), say ``single_row_groups=True``: ``fn`` is then applied
    to whole Arrow batches with ``mapInPandas``, no shuffle and no per-row
    call.  That form requires ``fn`` to treat rows independently, so that
    ``fn(batch)`` equals ``fn`` applied row by row and concatenated.
    """
    if single_row_groups:
        def per_batch(batches):
            for pdf in batches:
                if len(pdf):
                    yield fn(pdf)
        return df.mapInPandas(per_batch, schema)
    return df.groupBy(*keys).applyInPandas(fn, schema)


def run_job(spark: SparkSession, fn: Callable[[DataFrame, dict], DataFrame], inputs: list[str],
            output: str, params: dict | None = None, fmt: str = "csv", header: bool = False,
            out_fmt: str = "csv") -> DataFrame:
    """The user-job contract: read the inputs, call ``fn(df, params)``, write the
    result to ``output`` (which must not exist yet) and return what was written."""
    from lineark.sources.files import scan_files, sink_result
    df = scan_files(spark, inputs, fmt=fmt, header=header)
    result = fn(df, dict(params or {}))
    sink_result(result, output, fmt=out_fmt)
    return spark.read.format(out_fmt).schema(result.schema).load(output)


def run_recorded_job(spark: SparkSession, fn: Callable[[DataFrame, dict], DataFrame], inputs: dict[str, str], output: str,
                     job_id: str, script_id: str, records_dir: str, params: dict | None = None, fmt: str = "csv",
                     out_fmt: str = "csv", store_url: str = "", job_type: str = "spark") -> DataFrame | None:
    """:func:`run_job` that leaves its record.  ``inputs`` maps dataset IDs to paths.

    Under ``records_dir`` it writes, each as one folder per job so that a repeated run replaces it:
    ``runs`` (``job_id, job_type, start_ts, end_ts, status, logs, parameters``), ``used`` (``job_id, role, pos,
    ref_id``, as :func:`records.used_datasets`) and, after success, ``outputs`` (the minted records of the files
    written).  The run and what it uses are written as ``Running`` before it begins; a
    failing ``fn`` or write leaves ``Failed`` with the error as the log, and None is returned."""
    from datetime import datetime, timezone
    from urllib.parse import quote

    from lineark.operators import records
    from lineark.sources.files import list_objects
    folder = lambda name: f"{records_dir.rstrip('/')}/{name}/job={quote(job_id, safe='')}"
    began = datetime.now(timezone.utc).replace(tzinfo=None)

    def run_row(status: str, logs: str | None, end) -> None:
        spark.createDataFrame([(job_id, job_type, began, end, status, logs, dict(params or {}))],
                              "job_id string, job_type string, start_ts timestamp_ntz, end_ts timestamp_ntz, status string, logs string, "
                              "parameters map<string,string>").coalesce(1).write.mode("overwrite").parquet(folder("runs"))

    items = spark.createDataFrame([(job_id, i, d) for i, d in enumerate(inputs)], "job_id string, pos long, dataset_id string")
    job = spark.createDataFrame([(job_id, script_id, None, job_type)], "job_id string, script_id string, container_id string, job_type string")
    records.used_datasets(items, job).write.mode("overwrite").parquet(folder("used"))
    run_row("Running", None, None)
    try:
        result = run_job(spark, fn, list(inputs.values()), output, params, fmt=fmt, out_fmt=out_fmt)
    except Exception as e:          # whatever the user's function raises belongs in the record
        run_row("Failed", str(e) or type(e).__name__, datetime.now(timezone.utc).replace(tzinfo=None))
        return None
    base = output.rstrip("/")
    files = list_objects(spark, base).select(F.lit(job_id).alias("job_id"), F.element_at(F.split("path", "/"), -1).alias("path"))
    records.mint_outputs(files, store_url, base + "/").write.mode("overwrite").parquet(folder("outputs"))
    run_row("Finished", None, datetime.now(timezone.utc).replace(tzinfo=None))
    return result
