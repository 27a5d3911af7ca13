"""User-function queries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lineark.operators import series, udf
from lineark.plans.fixtures import table
from lineark.plans.q_series import _S, _tc3_sql, DIGITS, TAU_USER, user_series
from lineark.plans.registry import query
from lineark.session import scratch_path
from lineark.sources import files

_FEATURE_SCHEMA = "vec_id long, raw double, abs double, num double, absnum double, denom double"


def _tc3_numpy(y: np.ndarray, tau: int) -> tuple[float, float, float, float, float]:
    """tc3 of one series with numpy (NaN when there is no complete triple)."""
    m = len(y) - 2 * tau
    if m <= 0:
        return (np.nan,) * 5
    a, b, c = y[:m], y[tau:tau + m], y[2 * tau:2 * tau + m]
    num = float(np.mean(a * b * c))
    denom = float(abs(np.mean(a * b)) ** 1.5)
    raw = num / denom if denom != 0 else np.nan
    return raw, abs(raw), num, abs(num), denom


def tc3_frame(pdf: pd.DataFrame) -> pd.DataFrame:
    """Grouped-map body: one series per group (one array column)."""
    rows = []    # row by row: each row is its own series
    for vid, emb in zip(pdf["vec_id"], pdf["embedding"]):
        raw, ab, num, absnum, denom = _tc3_numpy(np.asarray(emb, dtype=np.float64), 10)
        rows.append((vid, raw, ab, num, absnum, denom))
    out = pd.DataFrame(rows, columns=["vec_id", "raw", "abs", "num", "absnum", "denom"])
    return out.round(6)


@query("grouped_map", oracle="""WITH e AS (
  SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS y,
         unnest(generate_series(0, len(embedding) - 1)) AS i
  FROM embeddings),
g AS (
  SELECT a.vec_id, COUNT(*) AS n, SUM(a.y * b.y * c.y) AS s3, SUM(a.y * b.y) AS s2
  FROM e a JOIN e b ON b.vec_id = a.vec_id AND b.i = a.i + 10
           JOIN e c ON c.vec_id = a.vec_id AND c.i = a.i + 20
  GROUP BY a.vec_id),
f AS (SELECT vec_id, s3 / n AS num, pow(abs(s2 / n), 1.5) AS denom FROM g)
SELECT vec_id, round(num / NULLIF(denom, 0), 6) + 0.0 AS raw, round(abs(num / NULLIF(denom, 0)), 6) AS abs,
       round(num, 6) + 0.0 AS num, round(abs(num), 6) AS absnum, round(denom, 6) AS denom FROM f""")
def q_grouped_map(spark, sf_dir):
    """tc3 of every embedding through a pandas grouped map, grouped like the sample
    job by a generated row key; single-row groups run as mapInPandas."""
    emb = series.row_key(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "id2")
    out = udf.grouped_map(emb, ["id2"], tc3_frame, _FEATURE_SCHEMA, single_row_groups=True)
    return out.select("vec_id", *[(F.col(c) + F.lit(0.0)).alias(c) for c in ("raw", "abs", "num", "absnum", "denom")])


def tc3_of_series(pdf: pd.DataFrame) -> pd.DataFrame:
    """Grouped-map body: one series per group, a row per value."""
    y = pdf.sort_values(["ts", "event_id"])["y"].to_numpy(dtype=np.float64)
    raw, ab, num, absnum, denom = _tc3_numpy(y, TAU_USER)
    return pd.DataFrame({"series_id": pdf["series_id"].iloc[:1], "n_triples": max(len(y) - 2 * TAU_USER, 0), "raw": round(raw, DIGITS),
                         "abs": round(ab, DIGITS), "num": round(num, DIGITS - 4), "absnum": round(absnum, DIGITS - 4), "denom": round(denom, DIGITS - 4)})


@query("grouped_map_series", oracle=_tc3_sql(f"WITH {_S}", str(TAU_USER), str(2 * TAU_USER)))
def q_grouped_map_series(spark, sf_dir):
    """tc3 of every user series through a pandas grouped map with real groups (``applyInPandas``); a user's
    series is one pandas frame, so this form is for series that fit a task, and ``tc3`` for any."""
    rows = user_series(spark, sf_dir).withColumn("y", F.col("y").cast("double"))
    out = udf.grouped_map(rows, ["series_id"], tc3_of_series,
                          "series_id long, n_triples long, raw double, abs double, num double, absnum double, denom double")
    return out.select("series_id", "n_triples", *[(F.col(c) + F.lit(0.0)).alias(c) for c in ("raw", "abs", "num", "absnum", "denom")])


@query("job_record", oracle="""
SELECT 'ark:99999/job-1' AS job_id, 'Finished' AS status, 'usedDataset' AS role, pos, 'ark:99999/lines-' || CAST(l_linenumber AS VARCHAR) AS ref_id
FROM (SELECT l_linenumber, row_number() OVER (ORDER BY l_linenumber) - 1 AS pos FROM (SELECT DISTINCT l_linenumber FROM lineitem) t) u
UNION ALL SELECT 'ark:99999/job-1', 'Finished', 'usedSoftware', 1, 'ark:99999/script-1'
UNION ALL SELECT 'ark:99999/job-1', 'Finished', 'rows written', count(*), 'true' FROM lineitem""")
def q_job_record(spark, sf_dir):
    """A user job over seven input datasets (the line items by line number) run through the contract: its record
    with what it used, and the rows in its output files, all of which have records that name the job."""
    li = table(spark, sf_dir, "lineitem")
    src = scratch_path(spark, "job-src")
    files.sink_result(li.select("l_orderkey", "l_quantity", F.col("l_linenumber").alias("part")), src, fmt="csv", partition_by=["part"])
    numbers = sorted(r[0] for r in li.select("l_linenumber").distinct().collect())      # 1 to 7
    parts = {f"ark:99999/lines-{i}": f"{src}/part={i}" for i in numbers}
    home, out, job = scratch_path(spark, "job-records"), scratch_path(spark, "job-result"), "ark:99999/job-1"
    done = udf.run_recorded_job(spark, lambda df, p: df.select(F.col("_c0").alias("order"), (F.col("_c1").cast("double") * float(p["factor"])).alias("q")),
                                parts, out, job, "ark:99999/script-1", home, {"factor": "2"}, out_fmt="parquet")
    runs, used, minted = (spark.read.parquet(f"{home}/{name}") for name in ("runs", "used", "outputs"))
    written = done.agg(F.lit("rows written").alias("role"), F.count(F.lit(1)).alias("pos"))
    linked = minted.agg(F.bool_and((F.col("generated_by") == job) & F.col("error").isNull())).scalar()
    rows = used.select("role", "pos", "ref_id").unionByName(written.withColumn("ref_id", linked.cast("string")))
    return rows.withColumn("job_id", F.lit(job)).join(runs.select("job_id", "status"), "job_id").select("job_id", "status", "role", "pos", "ref_id")


@query("row_key", oracle="""
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                   l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS row_key,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem""")
def q_row_key(spark, sf_dir):
    """A stable row key for every line item (declared order, ties broken on all columns)."""
    li = table(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return series.row_key(li, "row_key", order).select(
        "row_key", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("job_contract", oracle="""WITH e AS (
  SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS y,
         unnest(generate_series(0, len(embedding) - 1)) AS i
  FROM embeddings),
g AS (
  SELECT a.vec_id, COUNT(*) AS n, SUM(a.y * b.y * c.y) AS s3, SUM(a.y * b.y) AS s2
  FROM e a JOIN e b ON b.vec_id = a.vec_id AND b.i = a.i + 10
           JOIN e c ON c.vec_id = a.vec_id AND c.i = a.i + 20
  GROUP BY a.vec_id),
f AS (
  SELECT v.vec_id, CAST(COALESCE(g.n, 0) AS INTEGER) AS n_triples, g.s3 / g.n AS num,
         pow(abs(g.s2 / g.n), 1.5) AS denom
  FROM embeddings v LEFT JOIN g ON g.vec_id = v.vec_id)
SELECT CAST(vec_id AS VARCHAR) AS series_id, n_triples, round(num / NULLIF(denom, 0), 6) + 0.0 AS raw,
       round(abs(num / NULLIF(denom, 0)), 6) AS abs, round(num, 6) + 0.0 AS num,
       round(abs(num), 6) AS absnum, round(denom, 6) AS denom
FROM f""")
def q_job_contract(spark, sf_dir):
    """A user job run through the contract: wide series in, tc3 features out, result written."""
    emb = table(spark, sf_dir, "embeddings").withColumn("time", F.concat(F.lit("label"), F.col("label").cast("string")))
    src = scratch_path(spark, "job-in")
    files.wide_series_text(emb, "vec_id", "time", "embedding").write.text(src)

    def features(df, params):
        tau = int(params.get("tau", 10))
        y = F.split("value", ",")
        wide = df.select(F.element_at(y, -1).alias("series_id"),
                         F.transform(F.slice(y, 1, F.size(y) - 2), lambda x: x.try_cast("double")).alias("y"))
        return series.tc3_array(wide, "series_id", "y", tau, digits=6)

    out = udf.run_job(spark, features, [src], scratch_path(spark, "job-out"), {"tau": 10}, fmt="text",
                      out_fmt="parquet")
    return out.select("series_id", "n_triples", *[(F.col(c) + F.lit(0.0)).alias(c)
                                                 for c in ("raw", "abs", "num", "absnum", "denom")])
