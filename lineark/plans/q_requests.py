"""Request and job-state queries and request-side look-ups (§2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineark.operators import requests, resolve
from lineark.plans.fixtures import fixture, with_views
from lineark.plans.registry import query

_RULE = """CASE WHEN raw IS NULL OR raw = '' THEN 'empty_body'
     WHEN NOT json_valid(raw) THEN 'not_json'
     WHEN NOT coalesce(json_exists(raw, '$.datasetID'), false) THEN 'no_datasetID'
     WHEN NOT coalesce(json_exists(raw, '$.scriptID'), false) THEN 'no_scriptID'
     WHEN job_type = 'custom' AND NOT coalesce(json_exists(raw, '$.containerID'), false) THEN 'no_containerID'
END"""


def _typed_requests(spark, sf_dir):
    req = fixture(spark, sf_dir, "f_requests")
    jobs = fixture(spark, sf_dir, "f_jobs").select("k", "job_type")
    return requests.validate_requests(req.join(jobs, "k"), "raw", "job_type")


@query("validate_requests", oracle=with_views(["f_requests", "f_jobs"], f"""
SELECT k, job_type, rule,
  CASE WHEN rule IN ('empty_body', 'not_json') THEN 'Post json with keys datasetID and scriptID'
       WHEN rule = 'no_datasetID' THEN 'JSON missing required key datasetID'
       WHEN rule = 'no_scriptID' THEN 'JSON missing required key scriptID'
       WHEN rule = 'no_containerID' THEN 'Missing required input containerID' END AS error,
  rule IS NULL AS valid
FROM (SELECT r.k, j.job_type, {_RULE.replace('raw', 'r.raw').replace('job_type', 'j.job_type')} AS rule
      FROM f_requests r JOIN f_jobs j ON j.k = r.k) t"""))
def q_validate_requests(spark, sf_dir):
    """First failing rule and message for every job request."""
    return _typed_requests(spark, sf_dir).select("k", "job_type", "rule", "error", "valid")


@query("request_defaults", oracle=with_views(["f_requests", "f_jobs"], f"""
SELECT r.k, json_extract_string(raw, '$.scriptID') AS script_id,
  json_extract_string(raw, '$.containerID') AS container_id,
  coalesce(json_extract_string(raw, '$.command'), 'python3') AS command,
  coalesce(json_extract_string(raw, '$.prefix'), 'breakfast/') AS prefix,
  coalesce(json_extract_string(raw, '$.namespace'), '99999') AS namespace,
  json_extract_string(raw, '$.qualifer') AS qualifer,
  coalesce(json_extract_string(raw, '$.node'), '') AS node,
  CASE WHEN json_exists(raw, '$.parameters') THEN CAST(json_extract(raw, '$.parameters') AS VARCHAR) ELSE '{{}}' END AS parameters,
  coalesce(json_extract_string(raw, '$."executor-memory"'), '5g') AS executor_memory,
  coalesce(json_extract_string(raw, '$.executors'), '1') AS executors,
  CAST(CASE WHEN json_type(raw, '$.datasetID') = 'ARRAY' THEN json_array_length(raw, '$.datasetID') ELSE 1 END AS INTEGER) AS n_datasets
FROM f_requests r JOIN f_jobs j ON j.k = r.k
WHERE ({_RULE.replace('raw', 'r.raw').replace('job_type', 'j.job_type')}) IS NULL"""))
def q_request_defaults(spark, sf_dir):
    """Typed fields with defaults for every accepted request."""
    ok = _typed_requests(spark, sf_dir).where("valid")
    d = requests.request_defaults(ok)
    return d.select("k", "script_id", "container_id", "command", "prefix", "namespace", "qualifer",
                    "node", "parameters", "executor_memory", "executors",
                    F.size("dataset_ids").alias("n_datasets"))


@query("running_jobs", oracle=with_views(["f_jobs"], """
SELECT DISTINCT name FROM (
  SELECT job_type || '-' || CAST(k AS VARCHAR) AS name FROM f_jobs
  UNION ALL SELECT job_type || 'driver' || CAST(k AS VARCHAR) AS name FROM f_jobs) p
WHERE regexp_matches(name, 'sparkjob-|custom-|nipype-')"""))
def q_running_jobs(spark, sf_dir):
    """Job pods among all pods (each job pod plus a driver pod that must not match)."""
    j = fixture(spark, sf_dir, "f_jobs")
    pods = j.select(F.explode(F.array(
        F.concat("job_type", F.lit("-"), F.col("k").cast("string")),
        F.concat("job_type", F.lit("driver"), F.col("k").cast("string")))).alias("name"))
    return requests.running_jobs(pods, "name")


@query("active_filter", oracle=with_views(["f_asked", "f_jobs"], """
SELECT a.job_id, j.phase, coalesce(j.phase IN ('Running', 'Pending'), false) AS active
FROM f_asked a LEFT JOIN f_jobs j ON j.job_id = a.job_id"""))
def q_active_filter(spark, sf_dir):
    """Is each asked job still active (unknown jobs are not)?"""
    return requests.active_filter(fixture(spark, sf_dir, "f_asked"),
                                  fixture(spark, sf_dir, "f_jobs")).select("job_id", "phase", "active")


@query("failure_stage", oracle=with_views(["f_stages", "f_logs"], """
SELECT s.job_id,
  CASE WHEN n_stages = 1 THEN 'Download' WHEN job_ready THEN 'WriteOutputs' ELSE 'JobRunner' END AS failed_stage,
  CASE WHEN n_stages = 1 THEN init_message WHEN job_ready THEN pod_message
       ELSE 'runner ' || init_message END AS message
FROM f_stages s JOIN f_logs l ON l.job_id = s.job_id WHERE l.status = 'Failed'"""))
def q_failure_stage(spark, sf_dir):
    """Which step broke, for every failed job."""
    failed = fixture(spark, sf_dir, "f_logs").where("status = 'Failed'").select("job_id")
    st = fixture(spark, sf_dir, "f_stages").withColumn(
        "init_message_2", F.concat(F.lit("runner "), F.col("init_message")))
    out = requests.failure_stage(st.join(failed, "job_id"))
    return out.select("job_id", "failed_stage", "message")


@query("job_status", oracle=with_views(["f_asked", "f_logs"], """
SELECT a.job_id, l.status,
  CASE WHEN l.status IS NULL THEN '""" + requests.MSG_NO_JOB + """' END AS error
FROM f_asked a LEFT JOIN f_logs l ON l.job_id = a.job_id"""))
def q_job_status(spark, sf_dir):
    """Status of each asked job, or the error for unknown ones."""
    return requests.job_status(fixture(spark, sf_dir, "f_asked"),
                               fixture(spark, sf_dir, "f_logs")).select("job_id", "status", "error")


@query("image_lookup", oracle=with_views(["f_job_containers", "f_container_docs"], """
SELECT a.job_id, a.container_id, json_extract_string(d.doc, '$.image') AS image,
  CASE WHEN d.container_id IS NULL THEN 'Identifier Doesn''t Exist.'
       WHEN json_extract_string(d.doc, '$.image') IS NULL THEN 'image tag not found in metadata.'
       ELSE 'ok' END AS status
FROM f_job_containers a LEFT JOIN f_container_docs d ON d.container_id = a.container_id"""))
def q_image_lookup(spark, sf_dir):
    """Container image for every job, with the two error outcomes."""
    return resolve.image_lookup(fixture(spark, sf_dir, "f_job_containers"),
                                fixture(spark, sf_dir, "f_container_docs"))
