"""Record-building queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineark.functions import text
from lineark.operators import params, records, resolve, series
from lineark.plans.fixtures import fixture, table, with_views
from lineark.plans.q_resolve import _items, _resolved, _sql
from lineark.plans.q_workflow import _REPORT
from lineark.plans.registry import query


#: where the example jobs keep their files
STORE = {"store_url": "objects:9000", "root": "/results/"}


def _mint_sql(kind: str, *parts: str) -> str:
    return "'ark:99999/' || substr(sha256('" + kind + "|' || " + " || '|' || ".join(parts) + "), 1, 32)"


@query("used_datasets", oracle=with_views(["f_used", "f_jobs", "f_scripts", "f_job_containers"], """
SELECT job_id, 'usedDataset' AS role, CAST(pos AS BIGINT) AS pos, dataset_id AS ref_id FROM f_used
UNION ALL
SELECT s.job_id, 'usedSoftware', CAST(1 AS BIGINT), s.script_id FROM f_scripts s
UNION ALL
SELECT c.job_id, 'usedSoftware', CAST(2 AS BIGINT), c.container_id
FROM f_job_containers c JOIN f_jobs j ON j.job_id = c.job_id WHERE j.job_type = 'custom'"""))
def q_used_datasets(spark, sf_dir):
    """What every run used: datasets in request order, then script (and container)."""
    jobs = (fixture(spark, sf_dir, "f_jobs").select("job_id", "job_type")
            .join(fixture(spark, sf_dir, "f_scripts").select("job_id", "script_id"), "job_id")
            .join(fixture(spark, sf_dir, "f_job_containers"), "job_id"))
    return records.used_datasets(_items(spark, sf_dir), jobs)


@query("location_list", oracle=_sql("""
SELECT job_id, string_agg('s3a://' || location, ',' ORDER BY pos) AS locations
FROM r WHERE location IS NOT NULL GROUP BY job_id"""))
def q_location_list(spark, sf_dir):
    """Every job's input locations as the ``s3a://a,s3a://b`` argument."""
    return records.location_list(_resolved(spark, sf_dir, "last"))


def _outputs(spark, sf_dir):
    o = fixture(spark, sf_dir, "f_outputs")
    return o.select(F.concat(F.lit("ark:99999/"), F.split_part("path", F.lit("/"), F.lit(2))).alias("job_id"), "path")


_OUT_SQL = """,
o AS (SELECT 'ark:99999/' || split_part(path, '/', 2) AS job_id, path FROM f_outputs)"""


@query("mint_outputs", oracle=with_views(["f_outputs"], _OUT_SQL + f"""
SELECT job_id, path, {_mint_sql('Download', 'job_id', 'path')} AS download_id,
       {_mint_sql('Dataset', 'job_id', 'path')} AS dataset_id,
       job_id AS generated_by, '/results/' || path AS download_name, regexp_extract(path, '([^/]*)$', 1) AS name,
       regexp_extract(regexp_extract(path, '([^/]*)$', 1), '([^.]*)$', 1) AS file_format,
       'objects:9000/results/' || path AS content_url, CAST(NULL AS VARCHAR) AS error
FROM o"""))
def q_mint_outputs(spark, sf_dir):
    """Download and Dataset records for every file in every job's output folder."""
    return records.mint_outputs(_outputs(spark, sf_dir), **STORE)


def _finished(spark, sf_dir):
    jobs = fixture(spark, sf_dir, "f_jobs")
    logs = fixture(spark, sf_dir, "f_logs")
    fin = jobs.where(F.col("phase").isin("Succeeded", "Failed")).select("job_id", "start_ts")
    minted = records.mint_outputs(_outputs(spark, sf_dir), **STORE)
    sup = records.ordered_list(minted, "job_id", "path", "dataset_id", "supports")
    return (fin.join(logs, "job_id")
            .select("job_id", "status", text.log_default("status", "log").alias("logs"),
                    (F.col("start_ts") + F.expr("INTERVAL 1 DAY")).alias("end_ts"))
            .join(sup, "job_id", "left"))


@query("upsert_record", oracle=with_views(["f_jobs", "f_logs", "f_outputs"], _OUT_SQL + f""",
sup AS (SELECT job_id, string_agg({_mint_sql('Dataset', 'job_id', 'path')}, ',' ORDER BY path) AS s,
               COUNT(*) AS n FROM o GROUP BY job_id),
u AS (SELECT j.job_id, l.status,
             CASE WHEN l.status = 'Failed' AND l.log = '' THEN 'Command Unrecognized.' ELSE l.log END AS logs,
             j.start_ts + INTERVAL 1 DAY AS end_ts, sup.s, sup.n
      FROM f_jobs j JOIN f_logs l ON l.job_id = j.job_id LEFT JOIN sup ON sup.job_id = j.job_id
      WHERE j.phase IN ('Succeeded', 'Failed'))
SELECT j.job_id, j.job_type, j.start_ts, coalesce(u.status, j.phase) AS status, u.logs, u.end_ts,
       CAST(coalesce(u.n, 0) AS INTEGER) AS n_supports, coalesce(u.s, '') AS supports
FROM f_jobs j LEFT JOIN u ON u.job_id = j.job_id"""))
def q_upsert_record(spark, sf_dir):
    """Run records finished with status, logs, end time and what they support."""
    base = fixture(spark, sf_dir, "f_jobs").select(
        "job_id", "job_type", "start_ts", F.col("phase").alias("status"),
        F.lit(None).cast("string").alias("logs"), F.lit(None).cast("timestamp_ntz").alias("end_ts"),
        F.array().cast("array<string>").alias("supports"))
    merged = records.upsert_record(base, _finished(spark, sf_dir))
    return merged.select("job_id", "job_type", "start_ts", "status", "logs", "end_ts",
                         F.size("supports").alias("n_supports"),
                         F.array_join("supports", ",").alias("supports"))


@query("delete_records", oracle=with_views(["f_jobs", "f_logs"], """
SELECT job_id, job_type, phase FROM f_jobs j
WHERE NOT EXISTS (SELECT 1 FROM f_logs l WHERE l.job_id = j.job_id AND l.status = 'Failed')"""))
def q_delete_records(spark, sf_dir):
    """Job records left after removing those of failed submissions."""
    gone = fixture(spark, sf_dir, "f_logs").where("status = 'Failed'")
    return records.delete_records(fixture(spark, sf_dir, "f_jobs").select("job_id", "job_type", "phase"), gone)


@query("record_json", oracle=with_views(["f_jobs", "f_used", "f_scripts", "f_job_containers"], """,
ds AS (SELECT job_id, to_json(list(json_object('@id', dataset_id) ORDER BY pos)) AS l FROM f_used GROUP BY job_id)
SELECT j.job_id, CAST(json_object(
  '@type', 'evi:""" + records.RUN_TYPE + """', 'name', '""" + records.RUN_TYPE + """',
  'startTime', strftime(j.start_ts, '%A, %B %d, %Y %I:%M:%S'),
  'evi:usedDataset', coalesce(ds.l, CAST('[]' AS JSON)),
  'evi:usedSoftware', CASE WHEN j.job_type = 'custom'
      THEN json_array(json_object('@id', s.script_id), json_object('@id', c.container_id))
      ELSE json_object('@id', s.script_id) END,
  'status', j.phase) AS VARCHAR) AS doc
FROM f_jobs j JOIN f_scripts s ON s.job_id = j.job_id JOIN f_job_containers c ON c.job_id = j.job_id
LEFT JOIN ds ON ds.job_id = j.job_id"""))
def q_record_json(spark, sf_dir):
    """JSON-LD document of every job."""
    jobs = (fixture(spark, sf_dir, "f_jobs").select("job_id", "job_type", "start_ts", F.col("phase").alias("status"))
            .join(fixture(spark, sf_dir, "f_scripts").select("job_id", "script_id"), "job_id")
            .join(fixture(spark, sf_dir, "f_job_containers"), "job_id"))
    used = records.used_datasets(_items(spark, sf_dir), jobs)
    return records.job_json(jobs.select("job_id", "start_ts", "status"), used)


_FILES = """,
m AS (SELECT 'ark:99999/' || split_part(path, '/', 2) AS job_id, path, regexp_extract(path, '([^/]*)$', 1) AS name FROM f_outputs),
r AS (SELECT job_id, path, name, 'ark:99999/' || substr(sha256('Download|' || job_id || '|' || path), 1, 32) AS download_id,
             'ark:99999/' || substr(sha256('Dataset|' || job_id || '|' || path), 1, 32) AS dataset_id,
             json_object('@id', 'ark:99999/' || substr(sha256('Download|' || job_id || '|' || path), 1, 32), '@type', 'Download',
                         'name', '/results/' || path, 'fileFormat', regexp_extract(name, '([^.]*)$', 1),
                         'contentUrl', 'objects:9000/results/' || path) AS part FROM m)"""


def _minted_files(spark, sf_dir):
    o = fixture(spark, sf_dir, "f_outputs")
    return records.mint_outputs(o.select(
        F.concat(F.lit("ark:99999/"), F.split_part("path", F.lit("/"), F.lit(2))).alias("job_id"), "path"), **STORE)


@query("record_json_files", oracle=with_views(["f_outputs"], _FILES + """
SELECT download_id AS id, CAST(part AS VARCHAR) AS doc FROM r
UNION ALL
SELECT dataset_id, CAST(json_object('@id', dataset_id, '@type', 'Dataset', 'name', name,
                                    'evi:generatedBy', json_object('@id', job_id), 'distribution', json_array(part)) AS VARCHAR) FROM r"""))
def q_record_json_files(spark, sf_dir):
    """JSON-LD documents of the Download and the Dataset of every output file."""
    minted = _minted_files(spark, sf_dir)
    return records.download_json(minted).unionByName(records.dataset_json(minted))


@query("record_json_software", oracle="""
SELECT 'part-' || CAST(p_partkey AS VARCHAR) AS id, 'SoftwareSourceCode' AS type, p_name AS name, p_type AS interface,
       CASE p_partkey % 3 WHEN 1 THEN CAST(p_partkey AS VARCHAR) WHEN 2 THEN CAST(p_partkey AS VARCHAR) || ';' || p_name END AS citation
FROM part""")
def q_record_json_software(spark, sf_dir):
    """JSON-LD documents of software entries with no, one or two citations, read back as flat columns."""
    part = table(spark, sf_dir, "part").select(
        F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("interface"),
        F.slice(F.array(F.col("p_partkey").cast("string"), "p_name"), 1, (F.col("p_partkey") % 3).cast("int")).alias("cites"))
    back = records.read_documents(records.software_json(part, citation="cites"))
    return back.select("id", "type", "name", "interface", F.array_join("citation", ";").alias("citation"))


@query("open_fields", oracle=with_views(["f_dataset_docs"], """
SELECT id, field, CASE WHEN NOT contains(value, '{') THEN value END AS value, length(value) AS n_chars
FROM (SELECT dataset_id AS id, field, CAST(json_extract(doc, '$."' || field || '"') AS VARCHAR) AS value
      FROM (SELECT dataset_id, doc, unnest(json_keys(doc)) AS field FROM f_dataset_docs) t WHERE field <> 'name') u"""))
def q_open_fields(spark, sf_dir):
    """The fields of every dataset document beside its name, one row each (objects by their text's length,
    since a VARIANT sorts their keys)."""
    out = records.open_fields(fixture(spark, sf_dir, "f_dataset_docs"), ["name"], id_col="dataset_id")
    return out.select("id", "field", F.when(~F.contains("value", F.lit("{")), F.col("value")).alias("value"),
                      F.length("value").cast("bigint").alias("n_chars"))


@query("lookup_or_insert", oracle=with_views(["f_interfaces", "f_catalogue"], f"""
SELECT i.node, i.interface, coalesce(c.id, {_mint_sql('Software', 'i.interface')}) AS id, c.id IS NULL AS is_new
FROM f_interfaces i LEFT JOIN f_catalogue c ON c.interface = i.interface"""))
def q_lookup_or_insert(spark, sf_dir):
    """Software ID of every node's interface: catalogue hit or minted once per new interface."""
    out, _new = records.lookup_or_insert(fixture(spark, sf_dir, "f_interfaces"), fixture(spark, sf_dir, "f_catalogue"))
    return out.select("node", "interface", "id", "is_new")


def _report_files(spark, sf_dir):
    r = params.parse_port_report(fixture(spark, sf_dir, "f_port_text"), "k", "report",
                                 fixture(spark, sf_dir, "f_objects"))
    return r.where(F.col("value") != params.NOT_A_FILE).select("k", "port", F.col("value").alias("path"))


@query("known_path_outputs", oracle=with_views(["f_port_text", "f_objects", "f_location_ids"], _REPORT + f"""
SELECT rep.k, rep.port, rep.value AS path, coalesce(l.id, {_mint_sql('Dataset', 'CAST(rep.k AS VARCHAR)', 'rep.value')}) AS id,
       l.id IS NOT NULL AS is_known
FROM rep LEFT JOIN f_location_ids l ON l.path = rep.value WHERE rep.value <> 'Not A File'"""))
def q_known_path_outputs(spark, sf_dir):
    """Node outputs at known paths reuse their ID; the others are minted."""
    return records.known_path_outputs(_report_files(spark, sf_dir), fixture(spark, sf_dir, "f_location_ids"), "k")


@query("id_map_merge", oracle=with_views(["f_port_text", "f_objects", "f_location_ids"], _REPORT + f""",
n AS (SELECT value AS path, min({_mint_sql('Dataset', 'CAST(k AS VARCHAR)', 'value')}) AS id FROM rep WHERE value <> 'Not A File' GROUP BY value)
SELECT coalesce(n.path, l.path) AS path, coalesce(n.id, l.id) AS id
FROM f_location_ids l FULL OUTER JOIN n ON n.path = l.path"""))
def q_id_map_merge(spark, sf_dir):
    """Known and newly minted ``path -> id`` entries merged; the new entry wins."""
    new = _report_files(spark, sf_dir).select("path", records.file_id("k", "path").alias("id"))
    return records.id_map_merge(fixture(spark, sf_dir, "f_location_ids"), new)


@query("outputs_minus_inputs", oracle=with_views(["f_used", "f_scripts", "f_outputs"], _OUT_SQL + f""",
known AS (SELECT job_id, dataset_id AS id FROM f_used UNION SELECT job_id, script_id FROM f_scripts
          UNION SELECT job_id, {_mint_sql('Dataset', 'job_id', 'path')} FROM o),
listed AS (SELECT job_id, {_mint_sql('Dataset', 'job_id', 'path')} AS id FROM o)
SELECT job_id, id FROM known k
WHERE NOT EXISTS (SELECT 1 FROM f_used u WHERE u.job_id = k.job_id AND u.dataset_id = k.id)
  AND NOT EXISTS (SELECT 1 FROM listed s WHERE s.job_id = k.job_id AND s.id = k.id)"""))
def q_outputs_minus_inputs(spark, sf_dir):
    """Known IDs of each job that are neither its inputs nor its listed outputs."""
    used = _items(spark, sf_dir).select("job_id", F.col("dataset_id").alias("id"))
    minted = records.mint_outputs(_outputs(spark, sf_dir), **STORE).select("job_id", F.col("dataset_id").alias("id"))
    scripts = fixture(spark, sf_dir, "f_scripts").select("job_id", F.col("script_id").alias("id"))
    known = used.unionByName(scripts).unionByName(minted)
    return records.outputs_minus_inputs(known, used, minted)


@query("supports_list", oracle=with_views(["f_used", "f_scripts", "f_outputs"], _OUT_SQL + f""",
known AS (SELECT job_id, path, 'ark:99999/pre-' || path AS id FROM o WHERE path LIKE '%/out1.%'
          UNION ALL SELECT job_id, '/scripts/' || script_id, script_id FROM f_scripts
          UNION ALL SELECT job_id, '/data/' || dataset_id, dataset_id FROM f_used),
outs AS (SELECT DISTINCT o.job_id, coalesce(k.id, {_mint_sql('Dataset', 'o.job_id', 'o.path')}) AS id
         FROM o LEFT JOIN known k ON k.job_id = o.job_id AND k.path = o.path)
SELECT job_id, id, 'output' AS kind FROM outs
UNION ALL
SELECT DISTINCT job_id, id, 'other' FROM known k
WHERE NOT EXISTS (SELECT 1 FROM f_used u WHERE u.job_id = k.job_id AND u.dataset_id = k.id)
  AND NOT EXISTS (SELECT 1 FROM outs s WHERE s.job_id = k.job_id AND s.id = k.id)"""))
def q_supports_list(spark, sf_dir):
    """Everything each job supports: its output files' IDs, then other known non-input IDs."""
    outs = _outputs(spark, sf_dir)
    pre = outs.where(F.col("path").contains("/out1.")).select(
        "job_id", "path", F.concat(F.lit("ark:99999/pre-"), "path").alias("id"))
    scripts = fixture(spark, sf_dir, "f_scripts").select(
        "job_id", F.concat(F.lit("/scripts/"), "script_id").alias("path"), F.col("script_id").alias("id"))
    inputs = _items(spark, sf_dir).select("job_id", F.concat(F.lit("/data/"), "dataset_id").alias("path"),
                                          F.col("dataset_id").alias("id"))
    known = pre.unionByName(scripts).unionByName(inputs)
    return records.supports_list(outs, known, inputs.select("job_id", "id"))


@query("status_changes", oracle=with_views(["f_status"], """
SELECT job_id, ts, phase, prev_phase, next_change_ts,
       (epoch_us(next_change_ts) - epoch_us(ts)) AS micros_in_phase
FROM (SELECT job_id, ts, phase, prev_phase, lead(ts) OVER (PARTITION BY job_id ORDER BY ts, event_id) AS next_change_ts
      FROM (SELECT job_id, ts, event_id, phase,
                   lag(phase) OVER (PARTITION BY job_id ORDER BY ts, event_id) AS prev_phase FROM f_status) a
      WHERE prev_phase IS NULL OR prev_phase <> phase) b"""))
def q_status_changes(spark, sf_dir):
    """Phase changes of every job's status feed and the time spent in each phase."""
    return series.status_changes(fixture(spark, sf_dir, "f_status"), "job_id", "phase", ["ts", "event_id"], "ts")


@query("first_error", oracle=_sql("""
, fb AS (SELECT job_id, min(pos) AS bp FROM r WHERE status <> 'ok' GROUP BY job_id)
SELECT r.job_id, r.pos, r.dataset_id, r.status FROM r JOIN fb ON fb.job_id = r.job_id AND fb.bp = r.pos"""))
def q_first_error(spark, sf_dir):
    """The first failing dataset of each job, in request order."""
    return resolve.first_error(_resolved(spark, sf_dir, "last"), "job_id", "pos", ["dataset_id", "status"])

