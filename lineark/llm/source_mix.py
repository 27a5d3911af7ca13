"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Each source is a queue of its documents in a shuffled order.  A document's virtual finish
time is the words that its source has sent when it ends, divided by the source's target, so
a source that should give twice as much sends twice as fast, and at time 1 every source has
sent exactly its target.  A source whose target is above its size starts its queue again.
The finish times are range-sorted over all sources and the order is cut at the budget.

No source is one task's work: a queue is cut into about sqrt(documents) pieces by the first
digits of its shuffle key, and the pieces' sums give each piece its start.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineark.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
REPEATS = 3


def _running(df: DataFrame, order: Sequence[Column], sums: dict[str, str], name: str) -> DataFrame:
    """``df`` with, for each ``sums`` entry (new column: summed column), the sum over all rows up to and
    with its own in ``order``, which must tell all rows apart or leave equal rows alike.

    Rows are range-partitioned once; one row per partition carries the sums from task to task."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = stored(df.repartitionByRange(parts, *order).withColumn("piece", F.spark_partition_id()), name)
    before = Window.partitionBy(F.lit(0)).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)    # one row a partition
    start = rows.groupBy("piece").agg(*(F.sum(c).alias(f"{new}_all") for new, c in sums.items())).select(
        "piece", *(F.coalesce(F.sum(f"{new}_all").over(before), F.lit(0)).alias(f"{new}_start") for new in sums))
    own = Window.partitionBy("piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(F.broadcast(start), "piece").withColumns({new: F.sum(c).over(own) + F.col(f"{new}_start") for new, c in sums.items()})
    return summed.drop("piece", *(f"{new}_start" for new in sums))


def targets(sizes: DataFrame, budget: int, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sizes`` (source, source_size; a row per source) with ``target`` DOUBLE.

    Sources in code-point order, null last, take ``weights`` in turn and share ``budget`` by them.
    No target is above ``repeats`` times the source's size; the excess is shared by weight among the
    others until none is above.  That is a water level: the targets are min(repeats * size,
    level * weight), and the level follows from sums over the sources in the order of size / weight.
    """
    ranked = _running(sizes.withColumn("one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], {"nth": "one"}, "mix-sources")
    weight = F.get(F.array(*(F.lit(int(w)) for w in weights)), F.pmod(F.col("nth") - 1, F.lit(len(weights))).cast("int")).cast("long")
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * repeats)
    ranked = stored(ranked.withColumn("ratio", F.col("most").cast("double") / F.col("weight")).drop("one"), "mix-weights")
    total = F.lit(ranked.agg(F.sum("weight")).first()[0] or 0)
    filled = _running(ranked, [F.col("ratio").asc(), F.col("nth").asc()], {"weight_up": "weight", "most_up": "most"}, "mix-levels")
    level = (F.lit(budget) - (F.col("most_up") - F.col("most"))).cast("double") / (total - F.col("weight_up") + F.col("weight")).cast("double")
    free = filled.select("ratio", "nth", level.alias("level")).where(F.col("level") <= F.col("ratio"))
    found = free.agg(F.min_by("level", F.struct("ratio", "nth"))).first()[0]
    target = F.col("most").cast("double")
    if found is not None:
        target = F.least(target, F.lit(float(found)) * F.col("weight"))
    return ranked.select("source", "source_size", "nth", target.alias("target"))


def queue(docs: DataFrame, share: float = 1.0, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, seed: str = "mix",
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, int]:
    """All documents' places in the queue, and the budget in words (``share`` of all words).

    One row per document and round of its source that may be taken, the first round always:
    ``row`` (names an input row), ``doc_id, size, source, source_size, target, round`` (from 0), ``finish``
    (virtual finish time) and ``sent`` (words of the mix with this document).  The mix is the rows
    with ``sent`` up to the budget, in the order of ``sent``.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    doc_id = F.col(id_col)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    slim = stored(docs.select(doc_id.alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), key.alias("key"),
                              F.monotonically_increasing_id().alias("row")), "mix-sizes")
    n, words = slim.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget = math.floor(share * words)
    sizes = stored(slim.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-totals")
    aims = targets(sizes, budget, weights, repeats)

    # a source's running sum: its pieces' sums first, then the rows of each piece
    digits = max(1, math.ceil(math.log(max(n, 1), 16) / 2))
    cut = slim.withColumn("piece", F.left("key", F.lit(digits)))
    before = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = cut.groupBy("source", "piece").agg(F.sum("size").alias("sum")).withColumn("start", F.coalesce(F.sum("sum").over(before), F.lit(0))).drop("sum")
    aimed = pieces.alias("p").join(aims.alias("a"), F.col("p.source").eqNullSafe(F.col("a.source"))).select(
        F.col("p.source").alias("of"), F.col("piece").alias("at"), "start", "source_size", "nth", "target")
    own = Window.partitionBy("source", "piece").orderBy("key", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = cut.withColumn("up", F.sum("size").over(own)).join(
        aimed, F.col("source").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("at")))
    some = F.col("target") > 0
    times = F.when(some, F.greatest(F.ceil(F.col("target") / F.col("source_size")), F.lit(1))).otherwise(1).cast("int")
    each = placed.select("row", "doc_id", "size", "source", "source_size", "nth", "target", "key", (F.col("start") + F.col("up")).alias("up"),
                         F.explode(F.sequence(F.lit(0), times - 1)).alias("round"))
    finish = F.when(some, (F.col("round") * F.col("source_size") + F.col("up")).cast("double") / F.col("target")).otherwise(0.0)
    sent = _running(each.withColumn("finish", finish).drop("up"),
                    [F.col(c).asc() for c in ("finish", "nth", "round", "key", "doc_id", "size", "row")], {"sent": "size"}, "mix-queue")
    return sent.select("row", "doc_id", "size", "source", "source_size", "target", "round", "finish", "sent"), budget


def mix(docs: DataFrame, share: float = 1.0, **options) -> DataFrame:
    """The mix itself: a row per document taken, ``sent`` its place (words up to and with it); a document
    that is taken more than once has a row for each ``round``.  See ``queue``."""
    rows, budget = queue(docs, share, **options)
    return rows.where(F.col("sent") <= budget)


def taken(docs: DataFrame, share: float = 1.0, **options) -> DataFrame:
    """What the mix takes of each document: ``doc_id, size, source_size, target, taken, rounds``.

    One row per input row, whether taken or not.  ``size`` is the number of words (null text: 0),
    ``taken`` the words that the mix takes of it with repeats, at most ``repeats`` times its size.
    Each source's taken words differ from its target by less than its longest document, or the last
    document at the cut.  The order is a function of ids and sizes, so a rerun gives the same rows;
    repeated rows are documents of their own, and of equal ones any may come first, with equal
    results as a whole.  A null source is a source, the last one; ids may be null; documents
    without words take part with size 0; an empty table gives no rows; other columns are ignored.
    """
    rows, budget = queue(docs, share, **options)
    inside = F.col("sent") <= budget
    return rows.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum(F.when(inside, F.col("size")).otherwise(0)).alias("taken"), F.count_if(inside).alias("rounds")).drop("row")
