"""Dataset resolution and access queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lineark.operators import resolve
from lineark.plans.fixtures import fixture, table, with_views
from lineark.plans.registry import query

_LOC = "CASE WHEN instr({u}, '/') = 0 THEN '' ELSE substr({u}, instr({u}, '/') + 1) END"

# Oracle building blocks: the picked entry per document and its location.
_D = """d AS (
  SELECT dataset_id,
    CASE json_type(doc, '$.distribution') WHEN 'ARRAY' THEN json_extract(doc, '$.distribution[#-1]')
         WHEN 'OBJECT' THEN json_extract(doc, '$.distribution') END AS e_last,
    CASE json_type(doc, '$.distribution') WHEN 'ARRAY' THEN json_extract(doc, '$.distribution[0]')
         WHEN 'OBJECT' THEN json_extract(doc, '$.distribution') END AS e_first
  FROM f_dataset_docs)"""
_RES_LAST = """res AS (
  SELECT d.dataset_id,
    coalesce(CASE WHEN json_extract_string(e_last, '$."@type"') = 'DataDownload'
                  THEN {loc} END, p.name) AS location
  FROM d LEFT JOIN f_pointers p
    ON p.dist_id = CASE WHEN coalesce(json_extract_string(e_last, '$."@type"'), '') <> 'DataDownload'
                        THEN json_extract_string(e_last, '$."@id"') END)""".format(
    loc=_LOC.format(u="json_extract_string(e_last, '$.contentUrl')"))
_RES_FIRST = """res AS (
  SELECT d.dataset_id,
    CASE WHEN json_extract_string(e_first, '$."@type"') = 'DataDownload' THEN {loc} END AS location
  FROM d)""".format(loc=_LOC.format(u="json_extract_string(e_first, '$.contentUrl')"))


def _resolved_sql(res: str) -> str:
    return f""",
{_D},
{res},
r AS (
  SELECT u.job_id, CAST(u.pos AS BIGINT) AS pos, u.dataset_id, res.location,
    CASE WHEN k.dataset_id IS NULL THEN 'Identifier Doesn''t Exist.'
         WHEN res.location IS NULL THEN 'Distribution not found. Or distribution formatting different than expected.'
         ELSE 'ok' END AS status
  FROM f_used u LEFT JOIN f_dataset_docs k ON k.dataset_id = u.dataset_id
  LEFT JOIN res ON res.dataset_id = u.dataset_id)"""


def _sql(body: str, res: str = _RES_LAST) -> str:
    return with_views(["f_used", "f_dataset_docs", "f_pointers"], _resolved_sql(res) + "\n" + body) \
        .replace(")\n,\nd AS", "),\nd AS")


def _items(spark, sf_dir):
    """The rows of ``f_used``, with one shuffle by order for both its DISTINCT and its ROW_NUMBER: equal lines have
    one dense rank."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    pos = F.dense_rank().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey"))
    lines = lines.withColumn("pos", pos.cast("bigint")).distinct()
    return lines.select(F.concat(F.lit("ark:99999/job-"), F.col("l_orderkey").cast("string")).alias("job_id"), "pos",
                        F.concat(F.lit("ark:99999/part-"), F.col("l_partkey").cast("string")).alias("dataset_id"))


def _resolved(spark, sf_dir, mode):
    return resolve.resolve_distribution(_items(spark, sf_dir), fixture(spark, sf_dir, "f_dataset_docs"),
                                        fixture(spark, sf_dir, "f_pointers"), mode=mode)


@query("resolve_distribution", oracle=_sql("SELECT job_id, pos, dataset_id, location, status FROM r"))
def q_resolve_distribution(spark, sf_dir):
    """Location of every dataset every job uses (last distribution, pointers followed)."""
    return _resolved(spark, sf_dir, "last").select("job_id", "pos", "dataset_id", "location", "status")


@query("resolve_distribution_first",
       oracle=_sql("SELECT job_id, pos, dataset_id, location, status FROM r", _RES_FIRST))
def q_resolve_distribution_first(spark, sf_dir):
    """The earlier rule: first distribution, inline downloads only."""
    return _resolved(spark, sf_dir, "first").select("job_id", "pos", "dataset_id", "location", "status")


@query("resolve_all_or_fail", oracle=_sql("""
, fb AS (SELECT job_id, min(pos) AS bp FROM r WHERE status <> 'ok' GROUP BY job_id)
SELECT r.job_id, bool_and(r.status = 'ok') AS resolved,
  max(CASE WHEN r.pos = fb.bp THEN r.dataset_id || ' ' || r.status END) AS error,
  COUNT(*) AS n_ids
FROM r LEFT JOIN fb ON fb.job_id = r.job_id GROUP BY r.job_id""").replace(")\n\n, fb AS", "),\nfb AS"))
def q_resolve_all_or_fail(spark, sf_dir):
    """Per job: all IDs resolve, or the first failing one in request order."""
    out = resolve.resolve_all_or_fail(_items(spark, sf_dir), fixture(spark, sf_dir, "f_dataset_docs"),
                                      fixture(spark, sf_dir, "f_pointers"))
    return out.select("job_id", "resolved", "error", "n_ids")


@query("resolve_skip_missing", oracle=_sql(
    "SELECT job_id, pos, dataset_id, location FROM r WHERE status = 'ok'", _RES_FIRST))
def q_resolve_skip_missing(spark, sf_dir):
    """Lenient resolution: unresolvable IDs dropped, the rest kept in order and paired by key."""
    r = resolve.resolve_skip_missing(_items(spark, sf_dir), fixture(spark, sf_dir, "f_dataset_docs"),
                                     fixture(spark, sf_dir, "f_pointers"))
    return r.select("job_id", "pos", "dataset_id", "location")


@query("input_manifest", oracle=_sql("""
SELECT job_id, dataset_id, '/data/' || regexp_extract(location, '([^/]*)$', 1) AS path
FROM r WHERE status = 'ok'"""))
def q_input_manifest(spark, sf_dir):
    """``/data/<file>`` -> dataset ID for every input a job fetches."""
    return resolve.input_manifest(_resolved(spark, sf_dir, "last").where("ok"))


@query("last_distribution", oracle=with_views(["f_dataset_docs"], """,
e AS (
  SELECT dataset_id AS id,
    CASE json_type(doc, '$.distribution') WHEN 'ARRAY' THEN json_array_length(doc, '$.distribution')
         WHEN 'OBJECT' THEN 1 ELSE 0 END AS n,
    CASE json_type(doc, '$.distribution') WHEN 'ARRAY' THEN json_extract(doc, '$.distribution[#-1]')
         WHEN 'OBJECT' THEN json_extract(doc, '$.distribution') END AS e
  FROM f_dataset_docs)
SELECT id, CAST(n AS BIGINT) AS pos, CAST(n AS BIGINT) AS n, json_extract_string(e, '$."@type"') AS dist_type,
  json_extract_string(e, '$.contentUrl') AS content_url, json_extract_string(e, '$."@id"') AS dist_ref
FROM e WHERE n > 0""").replace(")\n,\ne AS", "),\ne AS"))
def q_last_distribution(spark, sf_dir):
    """Last distribution entry of every dataset document, from the long form."""
    dist = resolve.distributions(fixture(spark, sf_dir, "f_dataset_docs"))
    long = dist.where(F.col("pos").isNotNull()).select(
        "id", F.col("pos").cast("bigint").alias("pos"), F.col("n").cast("bigint").alias("n"),
        "dist_type", "content_url", "dist_ref")
    return resolve.last_distribution(long, "id", "pos")


@query("access_filter", oracle=with_views(
    ["f_used", "f_scripts", "f_owners", "f_owner_group", "f_members"], """,
o AS (
  SELECT u.job_id, s.user_id, CAST(u.pos AS BIGINT) AS pos, u.dataset_id AS object_id
  FROM f_used u JOIN f_scripts s ON s.job_id = u.job_id
  UNION ALL SELECT job_id, user_id, CAST(1000000 AS BIGINT) AS pos, script_id FROM f_scripts),
c AS (
  SELECT o.*, (EXISTS (SELECT 1 FROM f_members m WHERE m.user_id = o.user_id AND m.role = 'admin')
     OR EXISTS (SELECT 1 FROM f_owners w WHERE w.object_id = o.object_id AND w.user_id = o.user_id)
     OR EXISTS (SELECT 1 FROM f_owner_group g JOIN f_members m ON m.group_id = g.group_id
                WHERE g.object_id = o.object_id AND m.user_id = o.user_id)) AS ok
  FROM o),
fb AS (SELECT job_id, min(pos) AS bp FROM c WHERE NOT ok GROUP BY job_id)
SELECT c.job_id, bool_and(c.ok) AS allowed,
  max(CASE WHEN c.pos = fb.bp THEN c.object_id END) AS first_denied,
  CASE WHEN NOT bool_and(c.ok) THEN 'Must be object owner' END AS error
FROM c LEFT JOIN fb ON fb.job_id = c.job_id GROUP BY c.job_id""").replace(")\n,\no AS", "),\no AS"))
def q_access_filter(spark, sf_dir):
    """May each job run: owner, group or admin for every dataset and the script."""
    used = fixture(spark, sf_dir, "f_used")
    scripts = fixture(spark, sf_dir, "f_scripts")
    objects = (used.join(scripts.select("job_id", "user_id"), "job_id")
               .select("job_id", "user_id", F.col("pos").cast("bigint").alias("pos"),
                       F.col("dataset_id").alias("object_id"))
               .unionByName(scripts.select("job_id", "user_id", F.lit(1000000).cast("bigint").alias("pos"),
                                           F.col("script_id").alias("object_id"))))
    return resolve.access_filter(objects, fixture(spark, sf_dir, "f_owners"),
                                 fixture(spark, sf_dir, "f_owner_group"), fixture(spark, sf_dir, "f_members"))
