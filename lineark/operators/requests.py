"""Job requests and job state: validation, defaults, activity, failure stage, status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineark.operators.records import RUN_TYPE

# Request messages and defaults.
MSG_NOT_JSON = "Post json with keys datasetID and scriptID"
MSG_NO_DATASET = "JSON missing required key datasetID"
MSG_NO_SCRIPT = "JSON missing required key scriptID"
MSG_NO_CONTAINER = "Missing required input containerID"
MSG_NO_JOB = f"Given ark either does not exist or is not a {RUN_TYPE.lower()}"
DEFAULTS = {
    "prefix": "breakfast/",
    "namespace": "99999",
    "node": "",
    "parameters": "{}",
    "executor-memory": "5g",
    "executors": "1",
    "command": "python3",
}
JOB_NAME_PATTERN = "sparkjob-|custom-|nipype-"
ACTIVE_PHASES = ("Running", "Pending")


def _has(doc, key: str):
    """Key present in a JSON object (a JSON null value counts as present)."""
    return F.try_variant_get(doc, f"$['{key}']", "variant").isNotNull()


def validate_requests(df: DataFrame, raw: str = "raw", job_type: str | None = None) -> DataFrame:
    """Parse request bodies and give each the first failing rule, in order:
    empty body, not JSON, no ``datasetID``, no ``scriptID``, and (custom jobs
    only) no ``containerID``.  Adds ``doc`` (VARIANT), ``rule``, ``error`` and
    ``valid``; split with ``valid`` into accepted and rejected requests."""
    r = F.col(raw)
    doc = F.try_parse_json(r)
    is_custom = (F.col(job_type) == "custom") if job_type else F.lit(False)
    out = df.withColumn("doc", doc)
    rule = (F.when(r.isNull() | (r == ""), "empty_body")
            .when(F.col("doc").isNull(), "not_json")
            .when(~_has(F.col("doc"), "datasetID"), "no_datasetID")
            .when(~_has(F.col("doc"), "scriptID"), "no_scriptID")
            .when(is_custom & ~_has(F.col("doc"), "containerID"), "no_containerID"))
    msg = (F.when(F.col("rule").isin("empty_body", "not_json"), MSG_NOT_JSON)
           .when(F.col("rule") == "no_datasetID", MSG_NO_DATASET)
           .when(F.col("rule") == "no_scriptID", MSG_NO_SCRIPT)
           .when(F.col("rule") == "no_containerID", MSG_NO_CONTAINER))
    return (out.withColumn("rule", rule).withColumn("error", msg)
            .withColumn("valid", F.col("rule").isNull()))


def request_defaults(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Typed request fields with the defaults filled in.

    ``datasetID`` may be one ID or a list and always comes out as an array.
    Missing and JSON-null fields are treated alike; ``qualifer`` stays NULL
    when not given (no qualifier)."""
    from lineark.functions.ids import scalar_or_list
    d = F.col(doc)

    def s(key):
        return F.try_variant_get(d, f"$['{key}']", "string")

    params = F.when(F.try_variant_get(d, "$['parameters']", "variant").isNull(),
                    F.lit(DEFAULTS["parameters"])).otherwise(
        F.to_json(F.try_variant_get(d, "$['parameters']", "variant")))
    return df.select(
        "*",
        scalar_or_list(F.try_variant_get(d, "$['datasetID']", "variant")).alias("dataset_ids"),
        s("scriptID").alias("script_id"),
        s("containerID").alias("container_id"),
        F.coalesce(s("command"), F.lit(DEFAULTS["command"])).alias("command"),
        F.coalesce(s("prefix"), F.lit(DEFAULTS["prefix"])).alias("prefix"),
        F.coalesce(s("namespace"), F.lit(DEFAULTS["namespace"])).alias("namespace"),
        s("qualifer").alias("qualifer"),
        F.coalesce(s("node"), F.lit(DEFAULTS["node"])).alias("node"),
        params.alias("parameters"),
        F.coalesce(s("executor-memory"), F.lit(DEFAULTS["executor-memory"])).alias("executor_memory"),
        F.coalesce(s("executors"), F.lit(DEFAULTS["executors"])).alias("executors"),
    )


def running_jobs(pods: DataFrame, name: str = "name") -> DataFrame:
    """Pods that belong to jobs (name contains ``sparkjob-``, ``custom-`` or ``nipype-``),
    each listed once."""
    return pods.where(F.col(name).rlike(JOB_NAME_PATTERN)).dropDuplicates([name])


def active_filter(asked: DataFrame, jobs: DataFrame, key: str = "job_id",
                  phase: str = "phase") -> DataFrame:
    """``active`` = phase is Running or Pending; an unknown job is not active."""
    # a job listed twice counts once: active if any of its rows is
    live = F.max(F.struct(F.col(phase).isin(*ACTIVE_PHASES).alias("_on"), F.col(phase).alias("_phase")))
    state = jobs.groupBy(key).agg(live.alias("_p")).select(key, F.col("_p._phase").alias(phase))
    return (asked.join(state, key, "left")
            .withColumn("active", F.coalesce(F.col(phase).isin(*ACTIVE_PHASES), F.lit(False))))


def failure_stage(df: DataFrame, n_stages: str = "n_stages", job_ready: str = "job_ready",
                  first_message: str = "init_message", second_message: str = "init_message_2",
                  pod_message: str = "pod_message") -> DataFrame:
    """Which step of a failed job broke.  Only the download step ran -> ``Download``
    (its message); the job step finished -> ``WriteOutputs`` (pod message);
    otherwise ``JobRunner`` (message of the job step)."""
    stage = (F.when(F.col(n_stages) == 1, "Download")
             .when(F.col(job_ready), "WriteOutputs").otherwise("JobRunner"))
    msg = (F.when(F.col(n_stages) == 1, F.col(first_message))
           .when(F.col(job_ready), F.col(pod_message)).otherwise(F.col(second_message)))
    return df.withColumn("failed_stage", stage).withColumn("message", msg)


def job_status(asked: DataFrame, runs: DataFrame, key: str = "job_id",
               status: str = "status") -> DataFrame:
    """Status of each asked job; unknown job or record without status -> error text."""
    # a record stored twice answers once, with a status if any row has one
    st = runs.groupBy(key).agg(F.max(status).alias(status))
    return (asked.join(st, key, "left")
            .withColumn("error", F.when(F.col(status).isNull(), F.lit(MSG_NO_JOB))))
