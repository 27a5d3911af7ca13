"""Input views derived from the driver tables.

The same SQL text is used by Spark (as temp views) and by the DuckDB oracle
(as CTEs), so both engines start from identical rows.  These views only put
table rows into the schemas the operators expect; all of the work happens in
the operators.  The first group is fixed by FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lineark.session import bound_tasks

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# View texts as given in FIXTURES.md section 4.
VIEWS: dict[str, str] = {
    "f_jobs": """
  SELECT 'ark:99999/job-' || CAST(o_orderkey AS STRING) AS job_id, o_orderkey AS k,
         o_custkey AS user_id,
         CASE o_orderkey % 3 WHEN 0 THEN 'sparkjob' WHEN 1 THEN 'custom' ELSE 'nipype' END AS job_type,
         CASE o_orderstatus WHEN 'F' THEN 'Succeeded' WHEN 'O' THEN 'Running'
              ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Failed' ELSE 'Pending' END END AS phase,
         o_orderdate AS start_ts
  FROM orders""",
    "f_requests": """
  SELECT o_orderkey AS k,
         CASE o_orderkey % 6
           WHEN 0 THEN '' WHEN 1 THEN 'not json'
           WHEN 2 THEN '{"scriptID":"ark:99999/s"}'
           WHEN 3 THEN '{"datasetID":"ark:99999/d"}'
           WHEN 4 THEN '{"datasetID":"ark:99999/d","scriptID":"ark:99999/s"}'
           ELSE '{"datasetID":["ark:99999/d","ark:99999/e"],"scriptID":"ark:99999/s","containerID":"ark:99999/c","prefix":"mine/"}'
         END AS raw
  FROM orders""",
    "f_used": """
  SELECT 'ark:99999/job-' || CAST(l_orderkey AS STRING) AS job_id,
         'ark:99999/part-' || CAST(l_partkey AS STRING) AS dataset_id,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS pos
  FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) d""",
    "f_dataset_docs": """
  SELECT 'ark:99999/part-' || CAST(p_partkey AS STRING) AS dataset_id,
         CASE p_partkey % 5
           WHEN 0 THEN '{"name":"p","distribution":[{"@type":"Old","@id":"x"},{"@type":"DataDownload","contentUrl":"minio/breakfast/p' || CAST(p_partkey AS STRING) || '.csv"}]}'
           WHEN 1 THEN '{"name":"p","distribution":[{"@id":"dist-' || CAST(p_partkey AS STRING) || '"}]}'
           WHEN 2 THEN '{"name":"p","distribution":{"@type":"DataDownload","contentUrl":"minio/breakfast/p' || CAST(p_partkey AS STRING) || '.csv"}}'
           WHEN 3 THEN '{"name":"p","distribution":{"@id":"dist-' || CAST(p_partkey AS STRING) || '"}}'
           ELSE '{"name":"p"}' END AS doc
  FROM part WHERE p_partkey % 11 <> 0""",
    "f_pointers": """
  SELECT 'dist-' || CAST(p_partkey AS STRING) AS dist_id,
         'breakfast/q' || CAST(p_partkey AS STRING) || '.csv' AS name
  FROM part WHERE p_partkey % 5 IN (1, 3) AND p_partkey % 7 <> 0""",
    "f_owner_group": """
  SELECT 'ark:99999/part-' || CAST(p_partkey AS STRING) AS object_id, p_partkey % 3 AS group_id FROM part""",
    "f_members": """
  SELECT c_custkey AS user_id, c_nationkey % 3 AS group_id,
         CASE WHEN c_custkey % 10 = 0 THEN 'admin' ELSE 'user' END AS role FROM customer""",
    "f_dag": """
  SELECT DISTINCT o_orderkey AS dst, CAST(FLOOR(o_orderkey / 2.0) AS BIGINT) AS src FROM orders WHERE o_orderkey >= 2
  UNION
  SELECT DISTINCT o_orderkey AS dst, CAST(FLOOR(o_orderkey / 3.0) AS BIGINT) AS src FROM orders WHERE o_orderkey >= 3""",
    "f_flow_edges": """
  SELECT DISTINCT 'supp' || CAST(l_suppkey AS STRING) AS src, l_returnflag AS src_port,
         'part' || CAST(l_partkey AS STRING) AS dst, l_linestatus || CAST(l_linenumber AS STRING) AS dst_port
  FROM lineitem""",
    "f_containment": """
  SELECT 'region' || CAST(n_regionkey AS STRING) AS parent, 'nation' || CAST(n_nationkey AS STRING) AS node FROM nation
  UNION ALL
  SELECT 'nation' || CAST(c_nationkey AS STRING) AS parent, 'cust' || CAST(c_custkey AS STRING) AS node FROM customer""",
    "f_status": """
  SELECT user_id AS job_id, event_id, ts,
         CASE event_type WHEN 'signup' THEN 'Pending' WHEN 'purchase' THEN 'Succeeded'
              WHEN 'error' THEN 'Failed' ELSE 'Running' END AS phase
  FROM events""",
    "f_port_text": """
  SELECT o_orderkey AS k,
         'out_file = /work/' || CAST(o_orderkey AS STRING) || '.nii' || CHR(10) ||
         'parts = [''/work/a' || CAST(o_orderkey AS STRING) || ''', ''/work/b' || CAST(o_orderkey AS STRING) || ''']' || CHR(10) ||
         'skipped = <undefined>' || CHR(10) || 'bad line' AS report
  FROM orders""",
    "f_objects": """
  SELECT '/work/a' || CAST(o_orderkey AS STRING) AS path FROM orders WHERE o_orderkey % 2 = 0
  UNION ALL
  SELECT '/work/b' || CAST(o_orderkey AS STRING) AS path FROM orders""",
    "f_container_edges": """
  SELECT 'nation' || CAST(c_nationkey AS STRING) AS src, 'cust' || CAST(c_custkey AS STRING) || '.out' AS src_port,
         'report' AS dst, 'in' || CAST(c_custkey AS STRING) AS dst_port FROM customer""",
    "f_params": """
  SELECT 'ark:99999/job-' || CAST(o_orderkey AS STRING) AS job_id,
         '{"x":' || CAST(o_orderkey AS STRING) || ',"opt":{"y":' || CAST(o_orderkey % 7 AS STRING) ||
         ',"z":"s"},"vals":[1,' || CAST(o_orderkey % 5 AS STRING) || ',[8,9],{"w":2},"text"]}' AS params
  FROM orders""",
    "f_interfaces": """
  SELECT p_partkey AS node, p_type AS interface FROM part""",
    "f_catalogue": """
  SELECT DISTINCT p_type AS interface, 'ark:99999/sw-' || p_type AS id FROM part WHERE p_type < 'M'""",
}

# Further input views of our own, in the same spirit: rows shaped like the
# records that the operators take, built from the driver tables.
VIEWS.update({
    # container documents (image look-up): one per supplier, some without image
    "f_container_docs": """
  SELECT 'ark:99999/ctr-' || CAST(s_suppkey AS STRING) AS container_id,
         CASE WHEN s_suppkey % 4 = 0 THEN '{"name":"c"}'
              ELSE '{"name":"c","image":"reg/img' || CAST(s_suppkey % 9 AS STRING) || ':1"}' END AS doc
  FROM supplier""",
    # container each job asks for (some unknown)
    "f_job_containers": """
  SELECT 'ark:99999/job-' || CAST(o_orderkey AS STRING) AS job_id,
         'ark:99999/ctr-' || CAST(o_custkey % 13 AS STRING) AS container_id
  FROM orders""",
    # pod logs of finished jobs
    "f_logs": """
  SELECT 'ark:99999/job-' || CAST(o_orderkey AS STRING) AS job_id,
         CASE WHEN o_orderstatus = 'F' THEN 'Succeeded'
              WHEN o_orderkey % 2 = 0 THEN 'Failed' ELSE 'Succeeded' END AS status,
         CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'exit ' || CAST(o_orderkey % 5 AS STRING) END AS log
  FROM orders""",
    # init-container states of a failed pod: count and readiness of stage 2
    "f_stages": """
  SELECT 'ark:99999/job-' || CAST(o_orderkey AS STRING) AS job_id,
         1 + CAST(o_orderkey % 3 AS INT) AS n_stages,
         o_orderkey % 2 = 0 AS job_ready,
         'init ' || o_orderpriority AS init_message,
         'pod ' || o_orderstatus AS pod_message
  FROM orders""",
    # who owns which object
    "f_owners": """
  SELECT 'ark:99999/part-' || CAST(c_custkey * 3 AS STRING) AS object_id, c_custkey AS user_id FROM customer""",
    # script each job runs (scripts are catalogued objects too)
    "f_scripts": """
  SELECT 'ark:99999/job-' || CAST(o_orderkey AS STRING) AS job_id, o_custkey AS user_id,
         'ark:99999/part-' || CAST(o_orderkey % 97 AS STRING) AS script_id
  FROM orders""",
    # IDs asked about (about one in five is unknown)
    "f_asked": """
  SELECT DISTINCT 'ark:99999/job-' || CAST(c_custkey * 5 AS STRING) AS job_id FROM customer""",
    # object listing of job output folders
    "f_outputs": """
  SELECT 'breakfast/job-' || CAST(l_orderkey AS STRING) || '/out' ||
         CAST(l_linenumber AS STRING) || '.' || ext AS path
  FROM (SELECT DISTINCT l_orderkey, l_linenumber,
               CASE l_returnflag WHEN 'R' THEN 'csv' WHEN 'A' THEN 'nii.gz' ELSE 'txt' END AS ext
        FROM lineitem) d""",
    # path templates per job, filled from the job's parameters
    "f_templates": """
  SELECT 'ark:99999/job-' || CAST(o_orderkey AS STRING) AS job_id,
         '/work/{side}{k}' AS template,
         CASE o_orderkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS side,
         CAST(o_orderkey AS STRING) AS k
  FROM orders""",
    # declared ports of workflow nodes (some used ports are not declared)
    "f_ports": """
  SELECT DISTINCT 'part' || CAST(l_partkey AS STRING) AS node,
         l_linestatus || CAST(l_linenumber AS STRING) AS port, 'in' AS direction
  FROM lineitem WHERE l_quantity < 45
  UNION
  SELECT DISTINCT 'part' || CAST(l_partkey AS STRING) AS node,
         'F' || CAST(l_linenumber + 4 AS STRING) AS port, 'in' AS direction
  FROM lineitem WHERE l_tax < 0.02
  UNION
  SELECT DISTINCT 'supp' || CAST(l_suppkey AS STRING) AS node, l_returnflag AS port, 'out' AS direction
  FROM lineitem WHERE l_discount < 0.09""",
    # node interfaces; some supplier nodes are I/O nodes
    "f_node_info": """
  SELECT 'part' || CAST(p_partkey AS STRING) AS node,
         'nipype.interfaces.utility.' || replace(lower(p_type), ' ', '_') AS interface FROM part
  UNION ALL
  SELECT 'supp' || CAST(s_suppkey AS STRING) AS node,
         CASE WHEN s_suppkey % 5 = 0 THEN 'nipype.interfaces.io.DataSink'
              ELSE 'nipype.interfaces.fsl.BET' END AS interface FROM supplier""",
    # outputs that already have IDs (node.port -> several IDs)
    "f_output_ids": """
  SELECT DISTINCT 'supp' || CAST(l_suppkey AS STRING) || '.' || l_returnflag AS port,
         l_linenumber AS seq,
         'ark:99999/out-' || CAST(l_suppkey AS STRING) || '-' || l_returnflag || '-' || CAST(l_linenumber AS STRING) AS id
  FROM lineitem WHERE l_discount < 0.03""",
    # file inputs of nodes
    "f_file_inputs": """
  SELECT DISTINCT 'part' || CAST(l_partkey AS STRING) AS node,
         '/work/' || CASE WHEN l_orderkey % 3 = 0 THEN 'c' ELSE 'b' END || CAST(l_orderkey AS STRING) AS input
  FROM lineitem""",
    # two runs of one workflow: nodes, reported outputs (some at known paths), files named as inputs
    "f_run_nodes": """
  SELECT run, node, interface FROM (
    SELECT 'part' || CAST(p_partkey AS STRING) AS node,
           'nipype.interfaces.utility.' || replace(lower(p_type), ' ', '_') AS interface FROM part
    UNION ALL
    SELECT 'supp' || CAST(s_suppkey AS STRING) AS node, 'nipype.interfaces.fsl.BET' AS interface FROM supplier) n
  CROSS JOIN (SELECT DISTINCT 'run' || CAST(r_regionkey % 2 AS STRING) AS run FROM region) r""",
    "f_run_reports": """
  SELECT DISTINCT 'run' || CAST(l_orderkey % 2 AS STRING) AS run, 'supp' || CAST(l_suppkey AS STRING) AS node,
         l_returnflag AS port, l_linenumber AS seq,
         CASE WHEN l_linenumber = 3 AND l_suppkey % 2 = 0 THEN '/work/b' || CAST(l_suppkey AS STRING)
              ELSE '/work/s' || CAST(l_suppkey AS STRING) || '_' || l_returnflag || CAST(l_linenumber AS STRING) || '.nii'
         END AS value
  FROM lineitem""",
    "f_run_inputs": """
  SELECT DISTINCT 'run' || CAST(l_orderkey % 2 AS STRING) AS run, 'part' || CAST(l_partkey AS STRING) AS node,
         '/work/' || CASE WHEN l_orderkey % 3 = 0 THEN 'c' ELSE 'b' END || CAST(l_orderkey AS STRING) AS input
  FROM lineitem""",
    # path -> id of files that were inputs
    "f_location_ids": """
  SELECT path, 'ark:99999/loc' || substr(path, 6) AS id FROM (
    SELECT '/work/a' || CAST(o_orderkey AS STRING) AS path FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL
    SELECT '/work/b' || CAST(o_orderkey AS STRING) AS path FROM orders) t""",
    # iterable inputs of nodes (long form)
    "f_sweep": """
  SELECT 'part' || CAST(p_partkey AS STRING) AS node, 'fwhm' AS param, 1 AS pos,
         CAST(p_size % 4 + 1 AS STRING) AS value FROM part
  UNION ALL
  SELECT 'part' || CAST(p_partkey AS STRING), 'fwhm', 2, CAST(p_size % 4 + 5 AS STRING) FROM part
  UNION ALL
  SELECT 'part' || CAST(p_partkey AS STRING), 'thresh', 1, 'lo' FROM part
  UNION ALL
  SELECT 'part' || CAST(p_partkey AS STRING), 'thresh', 2, 'hi' FROM part
  UNION ALL
  SELECT 'part' || CAST(p_partkey AS STRING), 'thresh', 3, 'mid' FROM part WHERE p_size > 25""",
    # workflow-level and node-level settings
    "f_wf_settings": """
  SELECT DISTINCT p_brand AS workflow, 'crash_dump' AS key,
         CASE WHEN p_brand < 'Brand#3' THEN 'true' ELSE 'false' END AS value FROM part
  UNION ALL
  SELECT DISTINCT p_brand AS workflow, 'stop_on_first_crash' AS key, 'true' AS value FROM part
  WHERE p_brand > 'Brand#2'""",
    "f_node_settings": """
  SELECT 'part' || CAST(p_partkey AS STRING) AS node, 'mem_gb' AS key, CAST(p_size AS STRING) AS value
  FROM part WHERE p_size % 3 = 0
  UNION ALL
  SELECT 'part' || CAST(p_partkey AS STRING) AS node, 'crash_dump' AS key, 'false' AS value
  FROM part WHERE p_size % 5 = 0""",
    # node input dicts with file paths, numbers and nesting
    "f_node_params": """
  SELECT 'ark:99999/job-' || CAST(o_orderkey AS STRING) AS job_id,
         '{"in_file":"/work/a' || CAST(o_orderkey AS STRING) || '","opt":{"ref":"/work/b' ||
         CAST(o_orderkey AS STRING) || '","n":' || CAST(o_orderkey % 4 AS STRING) ||
         '},"files":["/work/a' || CAST(o_orderkey AS STRING) || '","/work/c' || CAST(o_orderkey AS STRING) ||
         '",3,null],"x":' || CAST(o_orderkey AS STRING) || ',"none":null}' AS params
  FROM orders""",
    # ports already fed by an edge
    "f_found": """
  SELECT 'ark:99999/job-' || CAST(o_orderkey AS STRING) AS job_id, 'x' AS key FROM orders WHERE o_orderkey % 4 = 0""",
})

_registered: dict[int, str] = {}


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Expose the driver tables as temp views (re-pointed if the folder changes)."""
    key = id(spark)
    if _registered.get(key) == sf_dir:
        return
    bound_tasks(spark)
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    _registered[key] = sf_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_tables(spark, sf_dir)
    return spark.table(name)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived input view as a DataFrame."""
    register_tables(spark, sf_dir)
    return spark.sql(VIEWS[name])


def with_views(names: list[str] | tuple[str, ...], body: str, recursive: bool = False) -> str:
    """Oracle text: the named views as CTEs in front of ``body``.  A body that
    starts with ``,`` continues the WITH list with its own CTEs."""
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    head = "WITH RECURSIVE" if recursive else "WITH"
    body = body.lstrip("\n")
    if body.startswith(","):
        return f"{head} {ctes}{body}"
    return f"{head} {ctes}\n{body}" if names else body
