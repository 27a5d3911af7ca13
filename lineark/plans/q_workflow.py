"""Workflow-graph, parameter and port-report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineark.operators import params, workflow
from lineark.plans.fixtures import fixture, with_views
from lineark.plans.registry import query


def _edges(spark, sf_dir):
    return fixture(spark, sf_dir, "f_flow_edges")


@query("edge_input_match", oracle=with_views(["f_flow_edges", "f_output_ids"], """
SELECT e.dst, e.dst_port, e.src || '.' || e.src_port AS input FROM f_flow_edges e
WHERE EXISTS (SELECT 1 FROM f_output_ids o WHERE o.port = e.src || '.' || e.src_port)"""))
def q_edge_input_match(spark, sf_dir):
    """Inputs of every node fed by an upstream output that already has an ID."""
    return workflow.edge_input_match(_edges(spark, sf_dir), fixture(spark, sf_dir, "f_output_ids"))


def _node_inputs(spark, sf_dir):
    e = _edges(spark, sf_dir).select(F.col("dst").alias("node"),
                                     workflow.output_name().alias("input"))
    return e.unionByName(fixture(spark, sf_dir, "f_file_inputs")).distinct()


_INPUTS = """,
i AS (SELECT DISTINCT node, input FROM (
  SELECT dst AS node, src || '.' || src_port AS input FROM f_flow_edges
  UNION ALL SELECT node, input FROM f_file_inputs) t)"""


@query("input_id_precedence", oracle=with_views(
    ["f_flow_edges", "f_file_inputs", "f_output_ids", "f_location_ids"], _INPUTS + """
SELECT i.node, i.input, o.id, 'output' AS source FROM i JOIN f_output_ids o ON o.port = i.input
UNION ALL
SELECT i.node, i.input, l.id, 'location' AS source FROM i JOIN f_location_ids l ON l.path = i.input
WHERE NOT EXISTS (SELECT 1 FROM f_output_ids o WHERE o.port = i.input)"""))
def q_input_id_precedence(spark, sf_dir):
    """IDs of every node input: upstream outputs first (all their IDs), then known paths."""
    return workflow.input_id_precedence(_node_inputs(spark, sf_dir), fixture(spark, sf_dir, "f_output_ids"),
                                        fixture(spark, sf_dir, "f_location_ids"))


@query("unresolved_inputs", oracle=with_views(
    ["f_flow_edges", "f_file_inputs", "f_output_ids", "f_location_ids"], _INPUTS + """
SELECT node, input FROM i
WHERE NOT EXISTS (SELECT 1 FROM f_output_ids o WHERE o.port = i.input)
  AND NOT EXISTS (SELECT 1 FROM f_location_ids l WHERE l.path = i.input)"""))
def q_unresolved_inputs(spark, sf_dir):
    """Node inputs found in neither ID map."""
    return workflow.unresolved_inputs(_node_inputs(spark, sf_dir), fixture(spark, sf_dir, "f_output_ids"),
                                      fixture(spark, sf_dir, "f_location_ids"))


# Port report oracle: parse "name = value" lines, lists kept only for existing files.
_REPORT = """,
l AS (SELECT k, unnest(string_split(report, chr(10))) AS line,
             unnest(generate_series(1, len(string_split(report, chr(10))))) AS ln FROM f_port_text),
kv AS (SELECT k, ln, regexp_replace(split_part(line, '=', 1), '\\s+$', '') AS port,
              regexp_replace(split_part(line, '=', 2), '^\\s+', '') AS result
       FROM l WHERE len(string_split(line, '=')) = 2),
lastv AS (SELECT k, port, arg_max(result, ln) AS result FROM kv
          WHERE result <> '' AND result <> '<undefined>' GROUP BY k, port),
items AS (SELECT k, port,
            unnest(string_split(replace(regexp_replace(result, '^[\\[\\]]+|[\\[\\]]+$', '', 'g'), '''', ''), ', ')) AS value,
            unnest(generate_series(0, len(string_split(replace(regexp_replace(result, '^[\\[\\]]+|[\\[\\]]+$', '', 'g'), '''', ''), ', ')) - 1)) AS seq
          FROM lastv WHERE result LIKE '[%' AND result LIKE '%]'),
rep AS (
  SELECT k, port, CAST(0 AS INTEGER) AS seq, result AS value FROM lastv WHERE NOT (result LIKE '[%' AND result LIKE '%]')
  UNION ALL
  SELECT k, port, CAST(seq AS INTEGER), value FROM items WHERE value IN (SELECT path FROM f_objects)
  UNION ALL
  SELECT k, port, CAST(0 AS INTEGER), 'Not A File' FROM items GROUP BY k, port
  HAVING NOT bool_or(value IN (SELECT path FROM f_objects)))"""


def _report(spark, sf_dir):
    return params.parse_port_report(fixture(spark, sf_dir, "f_port_text"), "k", "report",
                                    fixture(spark, sf_dir, "f_objects"))


@query("parse_port_report", oracle=with_views(["f_port_text", "f_objects"], _REPORT + """
SELECT k, port, seq, value FROM rep"""))
def q_parse_port_report(spark, sf_dir):
    """Output ports and files read out of every node's port report text."""
    return _report(spark, sf_dir)


@query("node_outputs", oracle=with_views(["f_port_text", "f_objects"], _REPORT + """
SELECT 'node' || CAST(k AS VARCHAR) AS node, 'node' || CAST(k AS VARCHAR) || '.' || port AS output_name,
       value AS file_path, seq FROM rep"""))
def q_node_outputs(spark, sf_dir):
    """One row per output file named ``node.port``."""
    r = _report(spark, sf_dir).select(F.concat(F.lit("node"), F.col("k").cast("string")).alias("node"),
                                       "port", "seq", "value")
    return workflow.node_outputs(r)


@query("edge_function", oracle=with_views(["f_port_text", "f_objects"], _REPORT + """
SELECT k, port, seq, fn, CASE fn WHEN 'basename' THEN regexp_extract(value, '([^/]*)$', 1)
                                 WHEN 'upper' THEN upper(value) ELSE value END AS value_in
FROM (SELECT *, CASE k % 3 WHEN 0 THEN 'basename' WHEN 1 THEN 'upper' END AS fn FROM rep) t"""))
def q_edge_function(spark, sf_dir):
    """Named edge functions applied to the upstream values of every port of every node."""
    r = _report(spark, sf_dir)
    e = r.select("k", "port", "seq", F.when(F.col("k") % 3 == 0, "basename").when(F.col("k") % 3 == 1, "upper")
                 .alias("fn"), "value")
    return params.edge_function(e, "value", "fn").select("k", "port", "seq", "fn", "value_in")


@query("output_id_accumulate", oracle="""
SELECT port, row_number() OVER (PARTITION BY port ORDER BY l_orderkey, l_linenumber) - 1 AS pos, id
FROM (SELECT DISTINCT 'supp' || CAST(l_suppkey AS VARCHAR) || '.' || l_returnflag AS port, l_orderkey, l_linenumber,
             'ark:99999/o-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id
      FROM lineitem) t""")
def q_output_id_accumulate(spark, sf_dir):
    """All IDs each ``node.port`` produced, in order."""
    from lineark.plans.fixtures import table
    li = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("supp"), F.col("l_suppkey").cast("string"), F.lit("."), "l_returnflag").alias("port"),
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("ark:99999/o-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("id")).distinct()
    return workflow.output_id_accumulate(li, "port", ["l_orderkey", "l_linenumber"], "id")


@query("unconnected_inputs", oracle=with_views(["f_ports", "f_flow_edges"], """
SELECT node, port FROM f_ports p WHERE direction = 'in'
AND NOT EXISTS (SELECT 1 FROM f_flow_edges e WHERE e.dst = p.node AND e.dst_port = p.port)"""))
def q_unconnected_inputs(spark, sf_dir):
    """Declared input ports nothing feeds."""
    return workflow.unconnected_inputs(fixture(spark, sf_dir, "f_ports"), _edges(spark, sf_dir))


@query("input_bindings", oracle=with_views(["f_flow_edges", "f_node_info"], """
SELECT dst, dst_port, src || '.' || src_port AS source, CAST(NULL AS VARCHAR) AS fn FROM f_flow_edges e
WHERE EXISTS (SELECT 1 FROM f_node_info n WHERE n.node = e.dst)"""))
def q_input_bindings(spark, sf_dir):
    """The upstream result each connected port of an existing node reads."""
    return workflow.input_bindings(_edges(spark, sf_dir), fixture(spark, sf_dir, "f_node_info"))


@query("unknown_ports", oracle=with_views(["f_flow_edges", "f_ports", "f_node_info"], """
SELECT src, src_port, dst, dst_port, 'input' AS side FROM f_flow_edges e
WHERE NOT EXISTS (SELECT 1 FROM f_ports p WHERE p.direction = 'in' AND p.node = e.dst AND p.port = e.dst_port)
  AND NOT EXISTS (SELECT 1 FROM f_node_info n WHERE n.node = e.dst AND n.interface LIKE '%.io%')
UNION ALL
SELECT src, src_port, dst, dst_port, 'output' AS side FROM f_flow_edges e
WHERE NOT EXISTS (SELECT 1 FROM f_ports p WHERE p.direction = 'out' AND p.node = e.src AND p.port = e.src_port)
  AND NOT EXISTS (SELECT 1 FROM f_node_info n WHERE n.node = e.src AND n.interface LIKE '%.io%')"""))
def q_unknown_ports(spark, sf_dir):
    """Edges that name a port the node does not declare (I/O nodes exempt)."""
    return workflow.unknown_ports(_edges(spark, sf_dir), fixture(spark, sf_dir, "f_ports"),
                                  fixture(spark, sf_dir, "f_node_info"))


@query("needed_outputs", oracle=with_views(["f_flow_edges"], """
SELECT node, string_agg(port, ',' ORDER BY port) AS needed
FROM (SELECT DISTINCT src AS node, src_port AS port FROM f_flow_edges) t GROUP BY node"""))
def q_needed_outputs(spark, sf_dir):
    """Output ports each node must keep because something downstream reads them."""
    return workflow.needed_outputs(_edges(spark, sf_dir))


_NAME = "regexp_extract(node, '^[a-z]+', 0) || CAST(CAST(regexp_extract(node, '[0-9]+$', 0) AS BIGINT) % 97 AS VARCHAR)"


@query("duplicate_nodes", oracle=with_views(["f_containment"], f"""
SELECT parent, name, COUNT(*) AS n FROM (SELECT parent, {_NAME} AS name FROM f_containment) t
GROUP BY parent, name HAVING COUNT(*) > 1"""))
def q_duplicate_nodes(spark, sf_dir):
    """Node names used twice under the same parent (names keep the number mod 97)."""
    c = fixture(spark, sf_dir, "f_containment")
    named = c.select("parent", F.concat(F.regexp_extract("node", "^[a-z]+", 0),
                                        (F.regexp_extract("node", "[0-9]+$", 0).cast("bigint") % 97)
                                        .cast("string")).alias("name"))
    return workflow.duplicate_nodes(named)


@query("duplicate_ports", oracle=with_views(["f_flow_edges"], """
SELECT dst, dst_port, COUNT(*) AS n_edges FROM (SELECT DISTINCT src, src_port, dst, dst_port FROM f_flow_edges) t
GROUP BY dst, dst_port HAVING COUNT(*) > 1"""))
def q_duplicate_ports(spark, sf_dir):
    """Input ports fed by more than one edge."""
    return workflow.duplicate_ports(_edges(spark, sf_dir))


@query("group_widths", oracle=with_views(["f_containment"], """,
w AS (SELECT parent, COUNT(*) AS width FROM f_containment GROUP BY parent)
SELECT parent, width, width = (SELECT max(width) FROM w) AS widest FROM w"""))
def q_group_widths(spark, sf_dir):
    """Nodes per group and the widest group."""
    return workflow.group_widths(fixture(spark, sf_dir, "f_containment"))


@query("node_imports", oracle=with_views(["f_flow_edges"], "SELECT DISTINCT dst, src FROM f_flow_edges"))
def q_node_imports(spark, sf_dir):
    """Which nodes each node reads from."""
    return workflow.node_imports(_edges(spark, sf_dir))


_FLAT = """,
fl AS (
  SELECT owner, k, v, t FROM (
    SELECT p.owner, e.key AS k, e.value AS v, e.type AS t FROM src p, json_each(p.doc) e) x
  WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.owner = x.owner AND f.key = x.k)),
arr AS (
  SELECT fl.owner, fl.k, e.value AS v, e.type AS t,
         row_number() OVER (PARTITION BY fl.owner, fl.k ORDER BY CAST(e.key AS INTEGER)) - 1 AS i
  FROM fl, json_each(fl.v) e WHERE fl.t = 'ARRAY' AND e.type <> 'ARRAY'),
leaf AS (
  SELECT owner, k AS key, v, t, false AS in_list FROM fl WHERE t NOT IN ('OBJECT', 'ARRAY')
  UNION ALL
  SELECT fl.owner, fl.k || '_' || e.key, e.value, e.type, false FROM fl, json_each(fl.v) e
  WHERE fl.t = 'OBJECT' AND e.type NOT IN ('OBJECT', 'ARRAY')
    AND NOT EXISTS (SELECT 1 FROM found f WHERE f.owner = fl.owner AND f.key = e.key)
  UNION ALL
  SELECT owner, k || '_' || CAST(i AS VARCHAR), v, t, true FROM arr WHERE t NOT IN ('OBJECT', 'NULL')
  UNION ALL
  SELECT a.owner, a.k || '_' || e.key || '_' || CAST(a.i AS VARCHAR), e.value, e.type, false
  FROM arr a, json_each(a.v) e WHERE a.t = 'OBJECT' AND e.type NOT IN ('OBJECT', 'ARRAY')
    AND NOT EXISTS (SELECT 1 FROM found f WHERE f.owner = a.owner AND f.key = e.key)),
typed AS (
  SELECT owner, key,
    CASE WHEN t = 'VARCHAR' THEN json_extract_string(v, '$') WHEN t = 'NULL' THEN NULL ELSE CAST(v AS VARCHAR) END AS value,
    CASE WHEN t IN ('UBIGINT', 'BIGINT', 'INTEGER') THEN 'int' WHEN t = 'DOUBLE' THEN 'float'
         WHEN t = 'BOOLEAN' THEN 'bool' WHEN t = 'VARCHAR' THEN 'string' WHEN t = 'NULL' THEN 'null' END AS vtype,
    in_list
  FROM leaf)"""


@query("flatten_params", oracle=with_views(["f_params"], """,
src AS (SELECT job_id AS owner, params AS doc FROM f_params),
found AS (SELECT CAST(NULL AS VARCHAR) AS owner, CAST(NULL AS VARCHAR) AS key WHERE false)""" + _FLAT + """
SELECT owner AS job_id, key, value, vtype FROM typed WHERE NOT (in_list AND vtype = 'string')"""))
def q_flatten_params(spark, sf_dir):
    """Nested node parameters flattened to ``(key, value)`` per job."""
    leaves = params.flatten_params(fixture(spark, sf_dir, "f_params"), "job_id", "params")
    return params.parameters_only(leaves).select("job_id", "key", "value", "vtype")


@query("split_params_files", oracle=with_views(["f_node_params", "f_found", "f_objects"], """,
src AS (SELECT job_id AS owner, params AS doc FROM f_node_params),
found AS (SELECT job_id AS owner, key FROM f_found)""" + _FLAT + """
SELECT owner AS job_id, key, value,
       CASE WHEN vtype = 'string' AND value IN (SELECT path FROM f_objects) THEN 'input_file' ELSE 'parameter' END AS kind
FROM typed
WHERE (vtype = 'string' AND value IN (SELECT path FROM f_objects)) OR NOT (in_list AND vtype = 'string')"""))
def q_split_params_files(spark, sf_dir):
    """Node inputs routed to input files or parameters; ports fed by edges skipped."""
    leaves = params.flatten_params(fixture(spark, sf_dir, "f_node_params"), "job_id", "params",
                                   found=fixture(spark, sf_dir, "f_found"))
    out = params.split_params_files(leaves, fixture(spark, sf_dir, "f_objects"))
    return out.select("job_id", "key", "value", "kind")


@query("select_files", oracle=with_views(["f_templates", "f_objects"], """
SELECT job_id, path FROM (
  SELECT job_id, replace(replace(template, '{k}', k), '{side}', side) AS path FROM f_templates) t
WHERE path IN (SELECT path FROM f_objects)"""))
def q_select_files(spark, sf_dir):
    """Path templates filled from each job's parameters; existing files kept."""
    t = fixture(spark, sf_dir, "f_templates").select(
        "job_id", "template", F.create_map(F.lit("side"), F.col("side"), F.lit("k"), F.col("k")).alias("params"))
    return params.select_files(t, "template", "params", fixture(spark, sf_dir, "f_objects")).select("job_id", "path")


_GLOBAL = {"crash_dump": "false", "mem_gb": "4", "stop_on_first_crash": "false", "hash_method": "timestamp"}


@query("config_merge", oracle=with_views(["f_wf_settings", "f_node_settings"], """,
nodes AS (SELECT 'part' || CAST(p_partkey AS VARCHAR) AS node, p_brand AS workflow FROM part),
g(key, value) AS (VALUES ('crash_dump', 'false'), ('hash_method', 'timestamp'), ('mem_gb', '4'),
                         ('stop_on_first_crash', 'false')),
cand AS (
  SELECT n.node, g.key, g.value, 0 AS lvl FROM nodes n CROSS JOIN g
  UNION ALL SELECT n.node, w.key, w.value, 1 FROM nodes n JOIN f_wf_settings w ON w.workflow = n.workflow
  UNION ALL SELECT node, key, value, 2 FROM f_node_settings)
SELECT node, key, arg_max(value, lvl) AS value FROM cand GROUP BY node, key"""))
def q_config_merge(spark, sf_dir):
    """Effective settings per node: global <- workflow <- node, later wins."""
    from lineark.plans.fixtures import table
    nodes = table(spark, sf_dir, "part").select(
        F.concat(F.lit("part"), F.col("p_partkey").cast("string")).alias("node"), F.col("p_brand").alias("workflow"))
    return params.config_merge(nodes, fixture(spark, sf_dir, "f_node_settings"),
                               fixture(spark, sf_dir, "f_wf_settings"), _GLOBAL)


@query("param_sweep", oracle=with_views(["f_sweep"], """
SELECT f.node, 'fwhm=' || f.value || ',thresh=' || t.value AS instance, p.param, p.value
FROM f_sweep f JOIN f_sweep t ON t.node = f.node AND t.param = 'thresh'
CROSS JOIN LATERAL (SELECT 'fwhm' AS param, f.value AS value UNION ALL SELECT 'thresh', t.value) p
WHERE f.param = 'fwhm'"""))
def q_param_sweep(spark, sf_dir):
    """Nodes with iterable inputs expanded into one instance per value combination."""
    return params.param_sweep(fixture(spark, sf_dir, "f_sweep"))
