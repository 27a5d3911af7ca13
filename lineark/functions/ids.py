"""Identifier helpers: ark composition, deterministic minting, ID lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lineark.functions.paths import url_location

DEFAULT_NS = "99999"
_SEP = "|"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ark_id(ns, local) -> Column:
    """``ark:<ns>/<local>``."""
    return F.concat(F.lit("ark:"), _c(ns), F.lit("/"), _c(local))


def ark_qualified(ns, qualifer, suffix) -> Column:
    """``ark:<ns>/<qualifer>/<suffix>``."""
    return F.concat(F.lit("ark:"), _c(ns), F.lit("/"), _c(qualifer), F.lit("/"), _c(suffix))


def strip_ark(full_id) -> Column:
    """Minted ``ark:<ns>/<rest>`` -> ``<rest>`` (first segment dropped)."""
    return url_location(full_id)


def _escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit(_SEP), F.lit("\\" + _SEP))


def mint_id(kind: str, *natural_key, ns: str = DEFAULT_NS) -> Column:
    """A new identifier that is the same every time for the same record.

    ``ark:<ns>/`` + the first 32 hex digits of ``sha256(kind|key1|key2...)``.  A
    retried or repeated job therefore writes the same IDs instead of new ones.
    ``\\`` and ``|`` inside a key are escaped and NULL has an encoding of its
    own, so different keys never share one.
    """
    parts = [F.lit(kind)] + [F.coalesce(_escape(_c(k).cast("string")), F.lit("\\0")) for k in natural_key]
    digest = F.sha2(F.concat_ws(_SEP, *parts), 256)
    return F.concat(F.lit(f"ark:{ns}/"), F.substring(digest, 1, 32))


def job_pod_name(job_type, short_id) -> Column:
    """``<job_type>-<job id>`` (pod, service and app label name)."""
    return F.concat(_c(job_type), F.lit("-"), _c(short_id))


def job_output_folder(prefix, short_id) -> Column:
    """``<prefix><job id>``: where a job writes its outputs."""
    return F.concat(_c(prefix), _c(short_id))


def split_id_list(text) -> Column:
    """``'[a,b,]' -> ['a', 'b']``: brackets removed, split on commas, empties dropped."""
    parts = F.split(F.regexp_replace(_c(text), r"[\[\]]", ""), ",")
    return F.filter(parts, lambda x: x != F.lit(""))


def join_id_list(ids) -> Column:
    """``['a', 'b'] -> 'a,b,'`` (each ID followed by a comma)."""
    return F.aggregate(_c(ids), F.lit(""), lambda acc, x: F.concat(acc, x, F.lit(",")))


def scalar_or_list(variant_field) -> Column:
    """A VARIANT field holding a string or an array of strings -> ARRAY<STRING>."""
    v = _c(variant_field)
    as_list = F.try_variant_get(v, "$", "array<string>")
    as_one = F.try_variant_get(v, "$", "string")
    return F.when(v.isNull(), F.lit(None)).otherwise(F.coalesce(as_list, F.array(as_one)))
