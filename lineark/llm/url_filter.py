"""URL filter: fixed rules, then gradient-boosted trees on lexical features, with
DataFrame functions and Spark's own trees only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineark.llm.common import ascii_lower, per_label, stored

#: most labelled URLs that training reads; those of each label with the smallest hashes
TRAIN_ROWS = 20_000
TREES, DEPTH = 20, 4

Rule = tuple[str, str, str]     # verdict, host, path prefix


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host stands between the first ``://`` and the next ``/ ? #``, A-Z
    lower-cased; the path goes on up to ``?`` or ``#``.  Both are empty without ``://`` or url."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1)
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host equals the url's or is a parent domain of it
    and whose path starts the url's path; nulls if none fits.  Of equally long rules the later one
    in text order wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _count(s: Column, pattern: str) -> Column:
    return (F.length(s) - F.length(F.regexp_replace(s, pattern, ""))).cast("double")


def _lexical(url: Column, host: Column, path: Column) -> list[Column]:
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    chars = F.filter(F.split(url, ""), lambda c: c != "")
    share = F.transform(F.array_distinct(chars), lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n)
    entropy = F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    word = F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(0)
    return [n, F.length(host).cast("double"), F.length(path).cast("double"), _count(path, "/"),
            _count(url, "[0-9]") / n, _count(host, "[0-9]"), _count(url, "[-_%]"), entropy, word.cast("double"),
            F.size(labels).cast("double"), F.startswith(url, F.lit("https")).cast("double"),
            F.contains(url, F.lit("#")).cast("double"), F.endswith(path, F.lit("/")).cast("double"),
            F.length(F.element_at(labels, -1)).cast("double"),
            # the path's first part (often a language or section), as four hashed flags
            *((F.pmod(F.shiftright(F.xxhash64(F.regexp_extract(path, "^/([^/]*)", 1)), 8 * k), F.lit(2))).cast("double") for k in range(6))]


def url_filter(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, id_col: str = "page_id",
               url_col: str = "url", rows: int = TRAIN_ROWS) -> DataFrame:
    """Judge every url.

    ``labelled`` has ``url`` and ``label`` (1: block, 0: allow); if it is None, the urls of ``pages``
    that a rule decides are the labelled ones, with that rule's verdict.  Training reads at most
    ``rows`` distinct labelled urls, up to half of them of the rarer label; suffix statistics (how often a host's last label was
    labelled, and blocked) come from all of them.

    Returns one row per input row: the id column, ``host``, ``path``, ``rule`` (null if none
    fits), ``verdict`` (``allow`` or ``block``: the rule's, else that of the trees) and ``score``
    DOUBLE (the trees' probability of block; 0 if no labels of both kinds exist, so such urls are
    allowed).  A null url, or one without ``://``, has an empty host and path, fits no rule and
    is left to the trees.  Other columns are ignored.
    """
    host, path = url_parts(F.col("url"))
    base = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"))
    base = base.select("id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.select("*", rule.alias("rule"), verdict.alias("fixed"))

    if labelled is None:
        known = base.where("fixed is not null").select("url", "host", "path", (F.col("fixed") == "block").cast("double").alias("label"))
    else:
        known = labelled.select(F.coalesce("url", F.lit("")).alias("url"), F.col("label").cast("double").alias("label")).where("label in (0, 1)")
        known = known.select("url", host.alias("host"), path.alias("path"), "label")
    known = known.withColumn("suffix", F.element_at(F.split("host", r"\."), -1))
    suffixes = stored(known.groupBy("suffix").agg(F.count("*").alias("seen"), F.avg("label").alias("blocked")), "suffixes")
    mean = F.coalesce(F.col("blocked"), F.lit(0.5))
    distinct = known.groupBy("url", "host", "path", "suffix").agg(F.max("label").alias("label")).withColumn("h", F.xxhash64("url"))
    first = [distinct.where(F.col("label") == label).orderBy("h", "url").limit(rows) for label in (0.0, 1.0)]
    first = stored(first[0].unionByName(first[1]), "first")          # a label is missing here only if none has it
    counts = {r["label"]: r["count"] for r in first.groupBy("label").count().collect()}
    sample = per_label(first, counts, rows, "h", "url")

    def vector(df: DataFrame, *keep: str) -> DataFrame:
        joined = df.join(suffixes, "suffix", "left")
        return joined.select(*keep, array_to_vector(F.array(
            *_lexical(F.col("url"), F.col("host"), F.col("path")), F.log1p(F.coalesce("seen", F.lit(0)).cast("double")), mean)).alias("x"))

    sample = stored(vector(sample, "url", "label"), "labelled")
    if len(counts) < 2:
        scored = base.withColumn("score", F.lit(0.0))
    else:
        ordered = sample.repartition(4, "url").sortWithinPartitions("url").persist()
        model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7, stepSize=0.2).fit(ordered)
        ordered.unpersist()
        wide = base.withColumn("suffix", F.element_at(F.split("host", r"\."), -1))
        scored = model.transform(vector(wide, "id", "host", "path", "rule", "fixed")).withColumn("score", vector_to_array("probability")[1])
    judged = F.coalesce("fixed", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", judged.alias("verdict"), "score")
