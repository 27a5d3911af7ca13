"""Identifier resolution as joins: dataset -> location, container -> image, access checks.

Instead of one metadata request per ID, the distinct IDs are
resolved in one join against the identifier documents, and the answers are
joined back to the (possibly much larger and skewed) request side.  Catalogue
sides are small per key; AQE turns the joins into broadcasts when their
measured size allows and splits hot keys of the big side otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineark.functions.paths import file_name, url_location

# Resolution outcomes.
MSG_NO_ID = "Identifier Doesn't Exist."
MSG_NO_DIST = "Distribution not found. Or distribution formatting different than expected."
MSG_NO_IMAGE = "image tag not found in metadata."
MSG_NOT_OWNER = "Must be object owner"
OK = "ok"


def distributions(docs: DataFrame, id_col: str = "dataset_id", doc_col: str = "doc") -> DataFrame:
    """Identifier documents -> one row per distribution entry, normalised.

    ``distribution`` may be a list or one object, and an entry is either an
    inline ``DataDownload`` with ``contentUrl`` or a pointer ``{"@id": ...}``.
    Gives ``(id, pos, n, dist_type, content_url, dist_ref)``; documents without
    any entry give one row with ``pos`` NULL.
    """
    v = F.try_parse_json(F.col(doc_col))
    d = F.try_variant_get(v, "$.distribution", "variant")
    arr = F.coalesce(F.try_variant_get(d, "$", "array<variant>"),
                     F.when(F.try_variant_get(d, "$", "map<string,variant>").isNotNull(), F.array(d)))
    base = docs.select(F.col(id_col).alias("id"), arr.alias("_arr"))
    ex = base.select("id", F.size(F.coalesce("_arr", F.array())).alias("n"),
                     F.posexplode_outer("_arr").alias("pos", "_e"))
    return ex.select(
        "id", (F.col("pos") + 1).alias("pos"), "n",
        F.try_variant_get("_e", "$['@type']", "string").alias("dist_type"),
        F.try_variant_get("_e", "$.contentUrl", "string").alias("content_url"),
        F.try_variant_get("_e", "$['@id']", "string").alias("dist_ref"))


def resolve_distribution(ids: DataFrame, docs: DataFrame, pointers: DataFrame,
                         mode: str = "last", key: str = "dataset_id",
                         doc_col: str = "doc") -> DataFrame:
    """Dataset ID -> file location, with an outcome per ID.

    ``mode='last'``: the last distribution entry; inline ``DataDownload`` gives
    ``url_location(contentUrl)``, a pointer gives the ``name`` of the pointed
    record.  ``mode='first'``: the first entry, inline only.  Outcomes: ``ok``,
    ``Identifier Doesn't Exist.`` or ``Distribution not found...``.
    Adds ``location``, ``status`` and ``ok`` to ``ids``.
    """
    dist = distributions(docs, key, doc_col)
    want = F.col("pos") == (F.col("n") if mode == "last" else F.lit(1))
    inline = F.col("dist_type") == "DataDownload"
    entry = dist.select("id", F.when(want, F.struct(
        F.when(inline, url_location(F.col("content_url"))).alias("_inline"),
        (F.when(~inline | F.col("dist_type").isNull(), F.col("dist_ref")) if mode == "last"
         else F.lit(None).cast("string")).alias("_ref"))).alias("_e"))
    # one answer per known ID: of a document or pointer stored twice the smallest counts
    found = entry.groupBy("id").agg(F.min("_e").alias("_e")).select("id", "_e._inline", "_e._ref")
    ptr = pointers.groupBy(F.col("dist_id").alias("_ref")).agg(F.min("name").alias("_ptr_name"))
    # inline entries have no pointer: they stay out of the join, where they would be one hot NULL key.
    pointed = found.where(F.col("_ref").isNotNull()).join(ptr, "_ref", "left").select(
        "id", F.coalesce("_inline", "_ptr_name").alias("location"))
    known = pointed.unionByName(found.where(F.col("_ref").isNull()).select("id", F.col("_inline").alias("location")))
    # each ID that is asked for is resolved once, however many requests name it
    asked = ids.select(F.col(key).alias("id")).distinct()
    answers = asked.join(known.withColumn("_known", F.lit(True)), "id", "left").select(
        F.col("id").alias(key), "location",
        F.when(F.col("_known").isNull(), F.lit(MSG_NO_ID))
         .when(F.col("location").isNull(), F.lit(MSG_NO_DIST)).otherwise(F.lit(OK)).alias("status"))
    # the answers are hashed partition by partition: their files' size says little of the rows that a broadcast
    # would put into every task, and sorting would compare long IDs that begin alike
    return ids.join(answers.hint("shuffle_hash"), key, "left").withColumn("ok", F.col("status") == OK)


def resolve_all_or_fail(items: DataFrame, docs: DataFrame, pointers: DataFrame,
                        job: str = "job_id", pos: str = "pos", key: str = "dataset_id",
                        mode: str = "last") -> DataFrame:
    """A job resolves only if every one of its IDs does; otherwise the first bad
    ID in request order gives ``'<id> <reason>'``.  One row per job with
    ``resolved``, ``error`` and ``n_ids`` (partial aggregation, so a job with
    very many IDs does not land in one task), and ``locations`` of a resolved job in
    request order, a list that one request bounds; it is only gathered where it is read."""
    r = resolve_distribution(items, docs, pointers, mode=mode, key=key)
    bad = F.when(~F.col("ok"), F.struct(F.col(pos), F.concat_ws(" ", F.col(key), F.col("status"))))
    # the text needs an aggregate that sorts: by a number first, since job IDs begin alike
    agg = r.groupBy(F.xxhash64(job).alias("_hash"), job).agg(
        F.bool_and("ok").alias("resolved"),
        F.min(bad).alias("_first_bad"),
        F.count(F.lit(1)).alias("n_ids"),
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("_pos"), "location"))).alias("_found"))
    return agg.select(job, "resolved", F.col("_first_bad.col2").alias("error"), "n_ids",
                      F.when(F.col("resolved"), F.transform("_found", lambda x: x["location"])).alias("locations"))


def resolve_skip_missing(items: DataFrame, docs: DataFrame, pointers: DataFrame,
                         key: str = "dataset_id", mode: str = "first") -> DataFrame:
    """Lenient form: IDs that do not resolve are dropped; the rest keep their
    position, and location and ID stay paired by key (not by list index)."""
    r = resolve_distribution(items, docs, pointers, mode=mode, key=key)
    return r.where(F.col("ok")).drop("status", "ok")


def image_lookup(asked: DataFrame, container_docs: DataFrame, key: str = "container_id",
                 doc_col: str = "doc") -> DataFrame:
    """Container ID -> ``image``; unknown ID or document without image -> error text."""
    docs = container_docs.select(
        F.col(key), F.try_variant_get(F.try_parse_json(F.col(doc_col)), "$.image", "string").alias("image"))
    docs = docs.groupBy(key).agg(F.lit(True).alias("_known"), F.min("image").alias("image"))    # one answer per ID
    out = asked.join(docs, key, "left")
    return out.select(
        *asked.columns, "image",
        F.when(F.col("_known").isNull(), F.lit(MSG_NO_ID))
         .when(F.col("image").isNull(), F.lit(MSG_NO_IMAGE)).otherwise(F.lit(OK)).alias("status"))


def input_manifest(resolved: DataFrame, job: str = "job_id", key: str = "dataset_id",
                   location: str = "location") -> DataFrame:
    """Where each fetched input lands (``/data/<file name>``) and which ID it came from:
    the ``path -> id`` map a job starts with."""
    return (resolved.where(F.col(location).isNotNull())
            .select(job, key, F.concat(F.lit("/data/"), file_name(F.col(location))).alias("path")))


def access_filter(objects: DataFrame, owners: DataFrame, grants: DataFrame, members: DataFrame,
                  job: str = "job_id", user: str = "user_id", pos: str = "pos",
                  obj: str = "object_id") -> DataFrame:
    """May each job run?  Allowed iff the user is admin or, for every object the
    job uses (datasets, then the script), the user owns it or is in a group
    that has it.  ``objects`` is ``(job, user, pos, object)``; ``owners`` is
    ``(object_id, user_id)``, ``grants`` ``(object_id, group_id)``,
    ``members`` ``(user_id, group_id, role)``.  One row per job with
    ``allowed``, ``first_denied`` and ``error``."""
    admins = members.where(F.col("role") == "admin").select(user).distinct().withColumn("_admin", F.lit(True))
    owned = owners.select(obj, user).distinct().withColumn("_owner", F.lit(True))
    # group route: (job object) -> groups holding it -> is this user in one?
    # Joined per requested object, never groups x members.
    mem = members.select(user, "group_id").distinct()
    via_group = (objects.select(job, pos, obj, user)
                 .join(grants.select(obj, "group_id").distinct(), obj)
                 .join(mem, [user, "group_id"], "left_semi")
                 .select(job, pos).distinct().withColumn("_group", F.lit(True)))
    checked = (objects.join(owned, [obj, user], "left")
               .join(via_group, [job, pos], "left")
               .join(admins, user, "left"))
    ok = F.coalesce(F.col("_admin"), F.lit(False)) | F.coalesce(F.col("_owner"), F.lit(False)) \
        | F.coalesce(F.col("_group"), F.lit(False))
    agg = checked.groupBy(job).agg(
        F.bool_and(ok).alias("allowed"),
        F.min(F.when(~ok, F.struct(F.col(pos), F.col(obj)))).alias("_d"))
    return agg.select(job, "allowed", F.col(f"_d.{obj}").alias("first_denied"),
                      F.when(~F.col("allowed"), F.lit(MSG_NOT_OWNER)).alias("error"))


def last_distribution(dist_long: DataFrame, id_col: str = "id", pos: str = "pos") -> DataFrame:
    """Last entry per dataset when distributions are stored one row per entry
    (``max_by`` with partial aggregation, no per-dataset window)."""
    rest = [c for c in dist_long.columns if c != id_col]
    agg = dist_long.groupBy(id_col).agg(F.max_by(F.struct(*rest), F.col(pos)).alias("_last"))
    return agg.select(id_col, *[F.col(f"_last.{c}").alias(c) for c in rest])


def first_error(resolved: DataFrame, job: str = "job_id", pos: str = "pos",
                carry: list[str] | None = None, ok: str = "ok") -> DataFrame:
    """First failing item per job in request order (``min`` over ``(pos, ...)``
    with partial aggregation)."""
    carry = carry or []
    first = resolved.where(~F.col(ok)).groupBy(job).agg(F.min(F.struct(pos, *carry)).alias("_f"))
    return first.select(job, *[F.col(f"_f.{c}").alias(c) for c in [pos, *carry]])
