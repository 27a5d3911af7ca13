"""Location strings: content URL -> location, bucket/key split, file name and format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_location(url) -> Column:
    """Drop the first ``/`` segment (``'minio/b/k' -> 'b/k'``); no slash gives ``''``."""
    return F.regexp_replace(_c(url), r"^[^/]*(/|$)", "")


def bucket_key(loc) -> Column:
    """``struct(bucket, key)``: ``'b/k/x' -> (b, 'k/x')``; ``'s3a://b/k' -> (b, 'k')``."""
    c = _c(loc)
    scheme = c.rlike(_SCHEME)
    bucket = F.when(scheme, F.split_part(c, F.lit("/"), F.lit(3))).otherwise(
        F.split_part(c, F.lit("/"), F.lit(1)))
    key = F.when(scheme, F.regexp_replace(c, r"^[^/]*/[^/]*/[^/]*(/|$)", "")).otherwise(
        url_location(c))
    return F.struct(bucket.alias("bucket"), key.alias("key"))


def file_name(path) -> Column:
    """Text after the last ``/``."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def file_format(path) -> Column:
    """Text after the last ``.`` of the file name; the whole name when it has no dot."""
    return F.substring_index(file_name(path), ".", -1)
