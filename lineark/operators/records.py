"""Provenance records as tables: runs, minted outputs, catalogue upserts, ID maps.

Records are long tables keyed by ID.  Per-record lists (used datasets,
supports) are built with ``collect_list`` only where one request or one job's
output folder bounds them; otherwise results stay one row per item.
IDs come from :func:`lineark.functions.ids.mint_id`, so re-running a step
writes the same records and every step can be repeated safely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineark.functions.ids import DEFAULT_NS, mint_id
from lineark.functions.paths import file_format, file_name
from lineark.functions.text import to_record_time
from lineark.session import scratch_path

# Record vocabulary.
EVI = "evi:"
RUN_TYPE = "Computation"


def file_id(run, path, ns: str = DEFAULT_NS) -> Column:
    """ID of the file that ``run`` (a job or a workflow run) wrote at ``path``: the one rule
    by which every operator names a file, so their results join."""
    return mint_id("Dataset", run, path, ns=ns)


def used_datasets(items: DataFrame, jobs: DataFrame, job: str = "job_id", pos: str = "pos",
                  dataset: str = "dataset_id", script: str = "script_id",
                  container: str = "container_id", job_type: str = "job_type") -> DataFrame:
    """What each run used, one row per reference: ``(job, role, pos, ref_id)``.

    ``usedDataset`` rows keep request order; ``usedSoftware`` is the script, and
    for custom jobs the container as a second entry."""
    ds = items.select(job, F.lit("usedDataset").alias("role"), F.col(pos).cast("bigint").alias("pos"),
                      F.col(dataset).alias("ref_id"))
    sw = jobs.select(job, F.explode(F.array(
        F.struct(F.lit(1).cast("bigint").alias("pos"), F.col(script).alias("ref_id")),
        F.when(F.col(job_type) == "custom",
               F.struct(F.lit(2).cast("bigint").alias("pos"), F.col(container).alias("ref_id"))),
    )).alias("_s")).where(F.col("_s").isNotNull()).select(
        job, F.lit("usedSoftware").alias("role"), "_s.pos", "_s.ref_id")
    return ds.unionByName(sw)


def ordered_list(df: DataFrame, group: str, pos: str, value: str, name: str) -> DataFrame:
    """``group -> ARRAY`` of ``value`` in ``pos`` order (for lists one record bounds)."""
    return df.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(value)))),
                    lambda s: s[value]).alias(name))


def location_list(resolved: DataFrame, job: str = "job_id", pos: str = "pos",
                  location: str = "location") -> DataFrame:
    """All input locations of a job as ``s3a://a,s3a://b`` (each item prefixed)."""
    lists = ordered_list(resolved.where(F.col(location).isNotNull()), job, pos, location, "_l")
    return lists.select(job, F.concat_ws(",", F.transform("_l", lambda x: F.concat(F.lit("s3a://"), x)))
                        .alias("locations"))


def mint_outputs(outputs: DataFrame, store_url: str, root: str, job: str = "job_id", path: str = "path",
                 ns: str = DEFAULT_NS) -> DataFrame:
    """Two linked records per output file: a ``Download`` (where the bytes are, under
    ``root`` of the store at ``store_url``) and a ``Dataset`` that points at it, with the
    job in ``generated_by``.  Deterministic IDs make a repeated finalisation write the
    same rows.  ``error`` is set, and the IDs and ``generated_by`` are NULL, for rows that
    cannot be minted (no path)."""
    name = F.concat(F.lit(root), F.col(path))
    ok = F.col(path).isNotNull() & (F.col(path) != "")
    return outputs.select(
        job, path,
        F.when(ok, mint_id("Download", job, path, ns=ns)).alias("download_id"),
        F.when(ok, file_id(job, path, ns)).alias("dataset_id"),
        F.when(ok, F.col(job)).alias("generated_by"),
        name.alias("download_name"),
        file_name(F.col(path)).alias("name"),
        file_format(F.col(path)).alias("file_format"),
        F.concat(F.lit(store_url), name).alias("content_url"),
        F.when(~ok, F.concat(F.lit("Failed minting id for "), F.coalesce(F.col(path), F.lit("")))).alias("error"))


def all_minted(minted: DataFrame, job: str = "job_id") -> DataFrame:
    """Job-level flag: every output got both records."""
    return minted.groupBy(job).agg(F.bool_and(F.col("error").isNull()).alias("all_minted"),
                                   F.count(F.lit(1)).alias("n_outputs"))


def upsert_record(base: DataFrame, updates: DataFrame, key: str = "job_id") -> DataFrame:
    """Finish run records: ``status``, ``logs`` and ``end_ts`` come from
    the update; ``supports`` is replaced only when the update lists outputs
    (non-empty), otherwise the old value stays.  Other fields are kept; updates
    for unknown jobs become new rows.  Of several updates of one job the one
    that ended last counts."""
    fields = ("status", "logs", "end_ts", "supports")
    newest = F.max_by(F.struct(*fields), F.struct("end_ts", "status", "logs"))      # of several updates of one job
    u = (updates.groupBy(key).agg(newest.alias("_u"))
         .select(key, *[F.col(f"_u.{c}").alias(f"_u_{c}") for c in fields]))
    j = base.join(u, key, "full_outer")
    has_out = F.coalesce(F.size(F.col("_u_supports")) > 0, F.lit(False))
    cols = []
    for c in base.columns:
        if c == key:
            cols.append(F.col(key))
        elif c in ("status", "logs", "end_ts"):
            cols.append(F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c))
        elif c == "supports":
            cols.append(F.when(has_out, F.col("_u_supports")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def delete_records(records: DataFrame, ids: DataFrame, key: str = "job_id") -> DataFrame:
    """Remove records by ID (undo of a failed submit)."""
    return records.join(ids.select(key), key, "left_anti")


def job_json(jobs: DataFrame, used: DataFrame, job: str = "job_id") -> DataFrame:
    """JSON-LD document per job (``@type``, name, startTime,
    usedDataset, usedSoftware, status)."""
    ds = ordered_list(used.where(F.col("role") == "usedDataset"), job, "pos", "ref_id", "_ds")
    sw = ordered_list(used.where(F.col("role") == "usedSoftware"), job, "pos", "ref_id", "_sw")
    ref = lambda x: F.struct(x.alias("@id"))
    j = jobs.join(ds, job, "left").join(sw, job, "left")
    # usedSoftware is one object, or a list for custom jobs: a VARIANT holds either
    software = F.when(F.size("_sw") > 1, F.parse_json(F.to_json(F.transform("_sw", ref)))) \
        .otherwise(F.parse_json(F.to_json(ref(F.col("_sw")[0]))))
    doc = F.struct(
        F.lit(EVI + RUN_TYPE).alias("@type"),
        F.lit(RUN_TYPE).alias("name"),
        to_record_time(F.col("start_ts")).alias("startTime"),
        F.transform(F.coalesce("_ds", F.array().cast("array<string>")), ref).alias(f"{EVI}usedDataset"),
        software.alias(f"{EVI}usedSoftware"),
        F.col("status").alias("status"))
    return j.select(job, F.to_json(doc).alias("doc"))


def download_json(minted: DataFrame) -> DataFrame:
    """JSON-LD document ``(id, doc)`` of each output file's Download, from the rows of :func:`mint_outputs`."""
    doc = F.struct(F.col("download_id").alias("@id"), F.lit("Download").alias("@type"), F.col("download_name").alias("name"),
                   F.col("file_format").alias("fileFormat"), F.col("content_url").alias("contentUrl"))
    return minted.where(F.col("error").isNull()).select(F.col("download_id").alias("id"), F.to_json(doc).alias("doc"))


def dataset_json(minted: DataFrame) -> DataFrame:
    """JSON-LD document ``(id, doc)`` of each output file's Dataset, its Download inside as the distribution."""
    part = F.struct(F.col("download_id").alias("@id"), F.lit("Download").alias("@type"), F.col("download_name").alias("name"),
                    F.col("file_format").alias("fileFormat"), F.col("content_url").alias("contentUrl"))
    doc = F.struct(F.col("dataset_id").alias("@id"), F.lit("Dataset").alias("@type"), "name",
                   F.struct(F.col("generated_by").alias("@id")).alias(f"{EVI}generatedBy"), F.array(part).alias("distribution"))
    return minted.where(F.col("error").isNull()).select(F.col("dataset_id").alias("id"), F.to_json(doc).alias("doc"))


def software_json(catalogue: DataFrame, key: str = "interface", id_col: str = "id", name: str = "name",
                  citation: str | None = None) -> DataFrame:
    """JSON-LD document ``(id, doc)`` of each software entry.  ``citation`` names an ``ARRAY<STRING>`` column: one
    entry is written as text, several as a list, none not at all."""
    fields = [F.col(id_col).alias("@id"), F.lit("SoftwareSourceCode").alias("@type"), F.col(name).alias("name"), F.col(key).alias("interface")]
    if citation:
        many = F.to_variant_object(F.col(citation))
        one = F.to_variant_object(F.array(F.get(citation, 0)))
        fields.append(F.when(F.size(citation) > 1, many).when(F.size(citation) == 1, F.variant_get(one, "$[0]", "variant")).alias("citation"))
    return catalogue.select(F.col(id_col).alias("id"), F.to_json(F.struct(*fields)).alias("doc"))


def read_documents(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Documents of any kind as flat columns, one row each: ``id, type, name, interface, citation`` (a list),
    ``generated_by, used`` (a list), ``software`` (a list), ``status, distribution`` (a list of
    ``id, name, file_format, content_url``).  What may be one object or a list is always a list here."""
    v = F.try_parse_json(doc)
    text = lambda path: F.try_variant_get(v, path, "string")

    def ids(path):
        many = F.try_variant_get(v, path, "array<struct<`@id`: string>>")
        one = F.try_variant_get(v, path, "struct<`@id`: string>")
        return F.transform(F.coalesce(many, F.when(one.isNotNull(), F.array(one))), lambda x: x["@id"])

    cites = F.coalesce(F.try_variant_get(v, "$.citation", "array<string>"), F.when(text("$.citation").isNotNull(), F.array(text("$.citation"))))
    part = "struct<`@id`: string, name: string, fileFormat: string, contentUrl: string>"
    parts = F.coalesce(F.try_variant_get(v, "$.distribution", f"array<{part}>"),
                       F.when(F.try_variant_get(v, "$.distribution", part).isNotNull(), F.array(F.try_variant_get(v, "$.distribution", part))))
    return docs.select(
        text("$['@id']").alias("id"), text("$['@type']").alias("type"), text("$.name").alias("name"), text("$.interface").alias("interface"),
        cites.alias("citation"), text(f"$['{EVI}generatedBy']['@id']").alias("generated_by"), ids(f"$['{EVI}usedDataset']").alias("used"),
        ids(f"$['{EVI}usedSoftware']").alias("software"), text("$.status").alias("status"),
        F.transform(parts, lambda x: F.struct(x["@id"].alias("id"), x["name"].alias("name"), x["fileFormat"].alias("file_format"),
                                              x["contentUrl"].alias("content_url"))).alias("distribution"))


def open_fields(docs: DataFrame, known: list[str], id_col: str = "id", doc: str = "doc") -> DataFrame:
    """The open remainder of documents: one row ``(id, field, value)`` per top-level field that is not in ``known``,
    the value as JSON text.  The documents' fields are exploded beside their row (a lateral join)."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.try_parse_json(doc).alias("_v")).where(F.schema_of_variant("_v").startswith("OBJECT"))
    out = spark.sql("SELECT d.id, f.key AS field, to_json(f.value) AS value FROM {d} AS d, LATERAL variant_explode(d._v) AS f", d=src)
    return out.where(~F.col("field").isin(list(known)))


def lookup_or_insert(keys: DataFrame, catalogue: DataFrame, key: str = "interface",
                     id_col: str = "id", kind: str = "Software") -> tuple[DataFrame, DataFrame]:
    """Reuse the catalogue ID of each key or mint one (once per distinct key).

    Returns ``(resolved keys, new catalogue rows)``; the new rows are what a
    caller appends to the catalogue table."""
    distinct = keys.select(key).distinct()
    # a catalogue may list an interface twice: keep one ID per key (the smallest)
    cat = catalogue.groupBy(key).agg(F.min(id_col).alias(id_col))
    new = (distinct.join(cat.select(key), key, "left_anti")
           .select(key, mint_id(kind, key).alias(id_col)))
    full = cat.withColumn("is_new", F.lit(False)).unionByName(
        new.withColumn("is_new", F.lit(True)))
    return keys.join(full, key, "left"), new


def known_path_outputs(outputs: DataFrame, location_ids: DataFrame, run: str, path: str = "path",
                       id_col: str = "id") -> DataFrame:
    """Outputs whose path already has an ID reuse it (not minted again); the
    rest get new IDs from their ``run`` column and path.  Adds ``id`` and ``is_known``."""
    known = location_ids.groupBy(path).agg(F.min(id_col).alias("_known_id"))
    j = outputs.join(known, path, "left")
    return j.select(*outputs.columns,
                    F.coalesce("_known_id", file_id(run, path)).alias(id_col),
                    F.col("_known_id").isNotNull().alias("is_known"))


def id_map_merge(known: DataFrame, new: DataFrame, path: str = "path", id_col: str = "id") -> DataFrame:
    """Union of the known and the newly minted ``path -> id`` entries; the new
    entry wins on the same path (full outer join, no ranking window)."""
    k = known.groupBy(path).agg(F.min(id_col).alias("_k"))
    n = new.groupBy(path).agg(F.min(id_col).alias("_n"))
    return k.join(n, path, "full_outer").select(path, F.coalesce("_n", "_k").alias(id_col))


def outputs_minus_inputs(known: DataFrame, inputs: DataFrame, listed: DataFrame,
                         job: str = "job_id", id_col: str = "id") -> DataFrame:
    """Known IDs of a job that are neither its inputs nor already listed."""
    marked = _marked(known, inputs, listed, job, id_col)
    return marked.where(marked["_other"]).select(job, id_col)


def _marked(known: DataFrame, inputs: DataFrame, listed: DataFrame, job: str, id_col: str) -> DataFrame:
    """Every ``(job, id)`` once, with ``_listed`` and ``_other`` (known, but neither an input nor listed): one shuffle
    of all three sides.  A NULL job or ID equals none, so such a known row is always another."""
    rows = [df.select(job, id_col, *[F.lit(k == i).alias(c) for k, c in enumerate(("_k", "_i", "_l"))])
            for i, df in enumerate((known, inputs, listed))]
    sides = rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy(job, id_col).agg(
        F.bool_or("_k").alias("_k"), F.bool_or("_i").alias("_i"), F.bool_or("_l").alias("_listed"))
    alone = F.col(job).isNull() | F.col(id_col).isNull() | ~(F.col("_i") | F.col("_listed"))
    return sides.select(job, id_col, "_listed", (F.col("_k") & alone).alias("_other"))


def supports_list(outputs: DataFrame, known: DataFrame, inputs: DataFrame, job: str = "job_id",
                  path: str = "path", id_col: str = "id") -> DataFrame:
    """Everything a job supports: the IDs of the files in its output folder
    (reused when the path is known, minted otherwise), then every other known
    ID that is not an input.  ``(job, id, kind)`` with kind ``output``/``other``."""
    kn = known.select(job, path, F.col(id_col).alias("_kid"))
    outs = (outputs.select(job, path).join(kn, [job, path], "left")
            .select(job, F.coalesce("_kid", file_id(job, path)).alias(id_col)))
    # a row is both only where its job or ID is NULL
    kinds = F.array_compact(F.array(F.when(F.col("_listed"), F.lit("output")), F.when(F.col("_other"), F.lit("other"))))
    return _marked(known, inputs, outs, job, id_col).select(job, id_col, F.explode(kinds).alias("kind"))


def write_records(df: DataFrame, path: str, partition_by: list[str], mode: str = "overwrite") -> None:
    """Write a record table partitioned by ``partition_by``.  With
    ``mode='overwrite'`` only the partitions present in ``df`` are replaced
    (dynamic partition overwrite), so an upsert rewrites little."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def upsert_table(spark, path: str, updates: DataFrame, key: str = "job_id",
                 partition_by: list[str] | None = None) -> DataFrame:
    """Apply :func:`upsert_record` to the record table at ``path``.

    Only the partitions the updates touch are read (a semi join on the
    partition columns, which partition pruning turns into a directory filter)
    and rewritten; the merged rows are written to the shared folder first, so the table is
    never overwritten while it is being read.  Updates must carry the
    partition columns.  Returns the rewritten rows."""
    parts = partition_by or ["job_type"]
    base = spark.read.parquet(path)
    touched = updates.select(*parts).distinct()
    affected = base.join(touched, parts, "left_semi")
    upd = updates.select(key, *parts, *[c for c in ("status", "logs", "end_ts", "supports") if c in updates.columns])
    # the stored keys that are updated, not all stored keys, are what the updates are told apart by
    there_path = scratch_path(spark, "there")
    affected.select(key).join(upd.select(key), key, "left_semi").distinct().write.parquet(there_path)
    there = spark.read.schema(affected.select(key).schema).parquet(there_path)
    known = upd.join(there, key, "left_semi").drop(*parts)
    merged = upsert_record(affected, known, key)
    # unknown jobs become new rows, in the partition their update names
    new_rows = upd.join(there, key, "left_anti")
    if new_rows.take(1):
        fill = [F.lit(None).cast(f.dataType).alias(f.name) for f in base.schema.fields
                if f.name not in new_rows.columns]
        merged = merged.unionByName(new_rows.select(*new_rows.columns, *fill).select(*merged.columns))
    merged_path = scratch_path(spark, "merged")
    merged.write.parquet(merged_path)
    merged = spark.read.schema(merged.schema).parquet(merged_path)
    write_records(merged, path, parts)
    return merged
