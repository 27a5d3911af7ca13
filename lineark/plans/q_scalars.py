"""Scalar function queries over ``pages``, ``part`` and the job views."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineark.functions import ids, paths, text
from lineark.operators import requests, series
from lineark.plans.fixtures import fixture, table, with_views
from lineark.plans.registry import query

_LOC = "CASE WHEN instr({u}, '/') = 0 THEN '' ELSE substr({u}, instr({u}, '/') + 1) END"
_SCHEME = r"regexp_matches({u}, '^[A-Za-z][A-Za-z0-9+.\-]*://')"


@query("url_location", oracle=f"SELECT page_id, {_LOC.format(u='url')} AS location FROM pages")
def q_url_location(spark, sf_dir):
    """Every page URL with its first segment dropped."""
    return table(spark, sf_dir, "pages").select("page_id", paths.url_location("url").alias("location"))


@query("bucket_key", oracle=f"""SELECT page_id,
  CASE WHEN {_SCHEME.format(u='url')} THEN split_part(url, '/', 3) ELSE split_part(url, '/', 1) END AS bucket,
  CASE WHEN {_SCHEME.format(u='url')} THEN array_to_string((string_split(url, '/'))[4:], '/')
       ELSE {_LOC.format(u='url')} END AS key
FROM pages""")
def q_bucket_key(spark, sf_dir):
    """Bucket and key of every page URL (scheme form ``s3a://b/k`` included)."""
    bk = paths.bucket_key("url")
    return table(spark, sf_dir, "pages").select("page_id", bk.bucket.alias("bucket"), bk.key.alias("key"))


@query("file_name_ext", oracle="""SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS name,
  regexp_extract(regexp_extract(url, '([^/]*)$', 1), '([^.]*)$', 1) AS fmt FROM pages""")
def q_file_name_ext(spark, sf_dir):
    """File name and format of every page URL."""
    return table(spark, sf_dir, "pages").select(
        "page_id", paths.file_name("url").alias("name"), paths.file_format("url").alias("fmt"))


@query("split_id_list", oracle=with_views(
    ["f_used"], "SELECT job_id, CAST(pos AS BIGINT) AS pos, dataset_id FROM f_used"))
def q_split_id_list(spark, sf_dir):
    """Round trip: each job's IDs joined to the ``a,b,`` text the job receives, then
    split back into an ordered list."""
    used = fixture(spark, sf_dir, "f_used")
    per_job = used.groupBy("job_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "dataset_id"))).alias("_l"))
    as_text = per_job.select("job_id", F.concat(
        F.lit("["), ids.join_id_list(F.col("_l.dataset_id")), F.lit("]")).alias("data"))
    return as_text.select("job_id", F.posexplode(ids.split_id_list("data")).alias("pos", "dataset_id")) \
        .select("job_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "dataset_id")


@query("scalar_or_list", oracle=with_views(["f_requests"], """,
r AS (SELECT k, raw FROM f_requests WHERE raw <> '' AND json_valid(raw) AND json_exists(raw, '$.datasetID'))
SELECT k, CAST(1 AS BIGINT) AS pos, json_extract_string(raw, '$.datasetID') AS dataset_id
FROM r WHERE json_type(raw, '$.datasetID') = 'VARCHAR'
UNION ALL
SELECT k, CAST(unnest(generate_series(1, CAST(json_array_length(raw, '$.datasetID') AS BIGINT))) AS BIGINT) AS pos,
       unnest(json_extract_string(raw, '$.datasetID[*]')) AS dataset_id
FROM r WHERE json_type(raw, '$.datasetID') = 'ARRAY'""").replace(")\n,\nr AS", "),\nr AS"))
def q_scalar_or_list(spark, sf_dir):
    """``datasetID`` given as one ID or a list, always read as an ordered list."""
    req = requests.validate_requests(fixture(spark, sf_dir, "f_requests"))
    v = F.try_variant_get("doc", "$['datasetID']", "variant")
    return (req.where(v.isNotNull())
            .select("k", F.posexplode(ids.scalar_or_list(v)).alias("pos", "dataset_id"))
            .select("k", (F.col("pos") + 1).cast("bigint").alias("pos"), "dataset_id"))


def _ark_base(spark, sf_dir):
    return fixture(spark, sf_dir, "f_jobs").withColumn("short_id", ids.strip_ark("job_id"))


@query("ark_compose", oracle=with_views(["f_jobs"], f"""
SELECT job_id, {_LOC.format(u='job_id')} AS short_id,
       'ark:99999/' || {_LOC.format(u='job_id')} AS full_id,
       'ark:99999/' || job_type || '/' || {_LOC.format(u='job_id')} AS qualified_id
FROM f_jobs"""))
def q_ark_compose(spark, sf_dir):
    """Strip minted IDs to their local part and rebuild plain and qualified arks."""
    j = _ark_base(spark, sf_dir)
    return j.select("job_id", "short_id", ids.ark_id(F.lit("99999"), "short_id").alias("full_id"),
                    ids.ark_qualified(F.lit("99999"), "job_type", "short_id").alias("qualified_id"))


@query("mint_id", oracle=with_views(["f_jobs"], """
SELECT job_id, 'ark:99999/' || substr(sha256('Job|' || job_id || '|' || job_type), 1, 32) AS minted
FROM f_jobs"""))
def q_mint_id(spark, sf_dir):
    """A deterministic new ID per job record (same input, same ID on every retry)."""
    return fixture(spark, sf_dir, "f_jobs").select(
        "job_id", ids.mint_id("Job", "job_id", "job_type").alias("minted"))


@query("job_names", oracle=with_views(["f_jobs"], f"""
SELECT job_id, job_type || '-' || {_LOC.format(u='job_id')} AS pod_name,
       'breakfast/' || {_LOC.format(u='job_id')} AS output_folder
FROM f_jobs"""))
def q_job_names(spark, sf_dir):
    """Pod name ``<type>-<id>`` and output folder ``<prefix><id>`` per job."""
    j = _ark_base(spark, sf_dir)
    return j.select("job_id", ids.job_pod_name("job_type", "short_id").alias("pod_name"),
                    ids.job_output_folder(F.lit("breakfast/"), "short_id").alias("output_folder"))


@query("time_format", oracle=with_views(["f_jobs"], """
SELECT job_id, start_text,
       -- no AM/PM marker: the hour is read as AM, so 12 means 0
       p - CASE WHEN hour(p) = 12 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS parsed_back
FROM (SELECT job_id, strftime(start_ts, '%A, %B %d, %Y %I:%M:%S') AS start_text,
             strptime(regexp_replace(strftime(start_ts, '%A, %B %d, %Y %I:%M:%S'), '^[^,]*,\\s*', ''),
                      '%B %d, %Y %I:%M:%S') AS p
      FROM f_jobs) t"""))
def q_time_format(spark, sf_dir):
    """Job start times in the record text format, and read back from it."""
    j = fixture(spark, sf_dir, "f_jobs").select("job_id", text.to_record_time("start_ts").alias("start_text"))
    return j.select("job_id", "start_text", text.from_record_time("start_text").alias("parsed_back"))


@query("log_default", oracle=with_views(["f_logs"], """
SELECT job_id, status,
       CASE WHEN status = 'Failed' AND log = '' THEN 'Command Unrecognized.' ELSE log END AS logs
FROM f_logs"""))
def q_log_default(spark, sf_dir):
    """Logs per finished job with the default text for failed jobs without output."""
    return fixture(spark, sf_dir, "f_logs").select(
        "job_id", "status", text.log_default("status", "log").alias("logs"))


@query("interface_name", oracle=with_views(["f_interfaces"], """
SELECT node, 'iface.' || interface AS interface_name FROM f_interfaces"""))
def q_interface_name(spark, sf_dir):
    """Dotted interface names read out of ``<class '...'>`` type texts."""
    f = fixture(spark, sf_dir, "f_interfaces").select(
        "node", F.concat(F.lit("<class 'iface."), F.col("interface"), F.lit("'>")).alias("type_text"))
    return f.select("node", text.interface_name("type_text").alias("interface_name"))


@query("scale_column", oracle="""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
  l_quantity * 2 AS column2 FROM lineitem""")
def q_scale_column(spark, sf_dir):
    """Derived column ``column2 = column1 * 2`` on every line item."""
    from lineark.operators.udf import scale_column
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return scale_column(li, "l_quantity", "column2", 2)


_FEAT_SQL = """WITH e AS (
  SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS y,
         unnest(generate_series(0, len(embedding) - 1)) AS i
  FROM embeddings),
g AS (
  SELECT a.vec_id, COUNT(*) AS n, SUM(a.y * b.y * c.y) AS s3, SUM(a.y * b.y) AS s2
  FROM e a JOIN e b ON b.vec_id = a.vec_id AND b.i = a.i + 10
           JOIN e c ON c.vec_id = a.vec_id AND c.i = a.i + 20
  GROUP BY a.vec_id),
f AS (
  SELECT v.vec_id, g.s3 / g.n AS num, pow(abs(g.s2 / g.n), 1.5) AS denom
  FROM embeddings v LEFT JOIN g ON g.vec_id = v.vec_id)
SELECT vec_id AS id, round(num / NULLIF(denom, 0), 6) + 0.0 AS CO_tc3_10__raw,
       round(abs(num / NULLIF(denom, 0)), 6) AS CO_tc3_10__abs, round(num, 6) + 0.0 AS CO_tc3_10__num,
       round(abs(num), 6) AS CO_tc3_10__absnum, round(denom, 6) AS CO_tc3_10__denom
FROM f"""


@query("flatten_features", oracle=_FEAT_SQL)
def q_flatten_features(spark, sf_dir):
    """tc3 results of each embedding flattened to ``CO_tc3_10__<key>`` columns."""
    feats = series.tc3_array(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 10, digits=6)
    packed = feats.select(F.col("vec_id").alias("id"),
                          F.struct("raw", "abs", "num", "absnum", "denom").alias("out"))
    return series.flatten_features(packed, "out", "CO_tc3_10_")
