"""Exact top-k search on binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension (1 where the value is positive).  Every task indexes
its rows in shards of bounded size: codes are cut into ``m`` segments of about log2(number of
codes) bits, and each segment has a table from its value to the codes that hold it.  One
segment's radius grows at a time: step s = m*r + j looks up, in segment j's table, the values
at Hamming distance exactly r from the query's segment.  After step s every code at distance s
or less has been seen, since such a code has one of the segments 0..j at distance r or less, or
one of the others at r-1 or less.  A query is finished in a shard when its k-th best verified
distance, over this shard and the task's earlier ones, is within that; only the others go on to
the next step.

Queries are a stated part of all rows (every ``every``-th id).  They are broadcast in blocks of
bounded size, and every task hands on its best k for each.  Equal codes are one entry, with the
smallest ids of its rows, so a vector that a third of all rows share costs one look-up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineark.llm.common import stored
from lineark.session import scratch_path

#: rows of a shard; queries of a block; look-ups of one step made at a time
SHARD, BLOCK, LOOKUPS = 1 << 18, 1 << 13, 1 << 18


def _masks(width: int, radius: int) -> np.ndarray:
    """All ``width``-bit numbers with ``radius`` bits set."""
    every = np.arange(1 << width, dtype=np.int64)
    return every[np.bitwise_count(every) == radius]


class Shard:
    """Distinct codes (rows of bits) with their smallest ids, and a table for each segment."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray, keep: int):
        packed = np.packbits(bits, axis=1)
        _, code = np.unique(packed.view([("", packed.dtype)] * packed.shape[1]).ravel(), return_inverse=True)
        order = np.lexsort((ids, code))
        ids, code, bits = ids[order], code[order], bits[order]
        once = np.concatenate(([True], (code[1:] != code[:-1]) | (ids[1:] != ids[:-1])))
        ids, code, bits = ids[once], code[once], bits[once]
        self.first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        self.held = np.minimum(np.diff(np.append(self.first, len(code))), keep)      # ids of each code that can matter
        self.ids, codes = ids, bits[self.first]
        self.width = min(bits.shape[1], 18, max(1, round(math.log2(max(len(codes), 2)))))
        self.segments = self.cut(codes)
        self.order, self.start = [], []
        for j in range(self.segments.shape[1]):
            self.order.append(np.argsort(self.segments[:, j], kind="stable"))
            self.start.append(np.searchsorted(self.segments[self.order[j], j], np.arange((1 << self.width) + 1)))

    def cut(self, bits: np.ndarray) -> np.ndarray:
        """Segment values (rows, m) of rows of bits."""
        ends = range(0, bits.shape[1], self.width)
        return np.stack([bits[:, s:s + self.width].astype(np.int64) @ (1 << np.arange(min(self.width, bits.shape[1] - s))) for s in ends], axis=1)

    def search(self, queries: np.ndarray, best: "Best") -> None:
        """Improve ``best`` until it is sure of every query."""
        q = self.cut(queries)
        m, bits = q.shape[1], queries.shape[1]
        active = np.arange(len(q))
        for step in range(m * (self.width + 1)):
            radius, j = divmod(step, m)
            masks = _masks(min(self.width, bits - j * self.width), radius)
            found = []
            group = max(1, LOOKUPS // max(len(masks), 1))
            for s in range(0, len(active) if len(masks) else 0, group):
                at = active[s:s + group]
                value = (q[at, j, None] ^ masks).ravel()
                low, n = self.start[j][value], self.start[j][value + 1] - self.start[j][value]
                who = np.repeat(np.repeat(at, len(masks)), n)
                entry = self.order[j][np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
                apart = np.bitwise_count(q[who] ^ self.segments[entry]).astype(np.int64)
                # a code is taken at the first step that meets it, and only if it can be among the best
                new = (apart * m + np.arange(m)).min(axis=1) == step
                new &= apart.sum(axis=1) <= best.kth[who]
                who, entry, distance = who[new], entry[new], apart[new].sum(axis=1)
                held = self.held[entry]
                place = np.repeat(self.first[entry] - np.cumsum(held) + held, held) + np.arange(held.sum())
                found.append((np.repeat(who, held), np.repeat(distance, held), self.ids[place]))
            best.add(found)
            active = active[best.kth[active] > step]
            if not len(active):
                return


class Best:
    """The first ``k`` ids of each query by (distance, id), an id once."""

    def __init__(self, queries: int, k: int):
        self.k, self.rows = k, [np.zeros(0, np.int64) for _ in range(3)]     # query, distance, id
        self.kth = np.full(queries, np.iinfo(np.int64).max)

    def add(self, found: list[tuple]) -> None:
        found = [x for x in found if len(x[0])]
        if not found:
            return
        q, d, ident = (np.concatenate(x) for x in zip(self.rows, *found))
        order = np.lexsort((d, ident, q))
        q, d, ident = q[order], d[order], ident[order]
        once = np.concatenate(([True], (q[1:] != q[:-1]) | (ident[1:] != ident[:-1])))
        q, d, ident = q[once], d[once], ident[once]
        order = np.lexsort((ident, d, q))
        q, d, ident = q[order], d[order], ident[order]
        first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        self.rows = [x[nth < self.k] for x in (q, d, ident)]
        last = nth == self.k - 1
        self.kth[q[last]] = d[last]


def _search(shared, k: int):
    """mapInArrow function: of rows (id, code), the best ``k`` of each query of the block: (query, distance, id)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        queries = shared.value
        best = Best(len(queries), k)
        ids, codes, size = [], [], 0

        def shard():
            if size:
                Shard(np.concatenate(ids), np.concatenate(codes), k).search(queries, best)
                ids.clear()
                codes.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, SHARD // 4):
                part = batch.slice(at, SHARD // 4)
                ids.append(part.column("id").to_numpy())
                codes.append(part.column("code").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1).astype(bool))
                size += part.num_rows
                if size >= SHARD:
                    shard()
                    size = 0
        shard()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best.rows], ["query", "distance", "id"])
    return run


def top_k(vectors: DataFrame, k: int = 10, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows, by Hamming distance, of every row whose id is divisible by ``every``.

    Returns ``query_id, rank, neighbour_id, distance`` with ranks from 1, ties by the smaller id,
    the query's own id left out; fewer ranks only if fewer other ids exist.  Rows with a null id or
    vector take no part; a null or missing value is a 0 bit; a repeated row counts once; an id with
    several vectors is a query for each, with the nearer rows first and an id once.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    full = vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    bits = full.agg(F.max(F.size("v"))).first()[0] or 0
    schema = "query_id long, rank int, neighbour_id long, distance int"
    if bits < 1:
        return spark.createDataFrame([], schema)
    positive = F.transform("v", lambda x: F.coalesce(x > 0, F.lit(False)))
    rows = stored(full.select("id", F.concat(positive, F.array_repeat(F.lit(False), F.lit(bits) - F.size("v"))).alias("code")), "codes")

    queries = rows.where(F.pmod("id", F.lit(every)) == 0)
    distinct = stored(queries.select("code").distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    n = distinct.count()
    blocks = max(1, -(-n // BLOCK))
    out = scratch_path(spark, "nearest")
    spark.createDataFrame([], "code array<boolean>, distance long, id long").write.parquet(out)
    for b in range(blocks):
        # distinct rows, dealt evenly by their hash: a block is of bounded size
        mine = distinct.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).select("code").toArrow()
        if not mine.num_rows:
            continue
        codes = mine.column("code").combine_chunks()
        shared = spark.sparkContext.broadcast(codes.flatten().to_numpy(zero_copy_only=False).reshape(-1, bits))
        # the query itself may be among its nearest, so one more
        found = rows.mapInArrow(_search(shared, k + 1), "query long, distance long, id long")
        place = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
        once = found.groupBy("query", "id").agg(F.min("distance").alias("distance"))
        best = once.withColumn("place", place).where(F.col("place") <= k + 1)
        names = spark.createDataFrame(mine.append_column("query", _numbers(mine.num_rows)))
        best.join(F.broadcast(names), "query").select("code", "distance", "id").write.mode("append").parquet(out)
        shared.destroy()
    best = spark.read.schema("code array<boolean>, distance long, id long").parquet(out)
    found = queries.select(F.col("id").alias("query_id"), "code").distinct().join(best, "code").where("id <> query_id")
    found = found.groupBy("query_id", F.col("id").alias("neighbour_id")).agg(F.min("distance").alias("distance"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbour_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "neighbour_id", F.col("distance").cast("int").alias("distance"))


def _numbers(n: int):
    import pyarrow as pa
    return pa.array(np.arange(n, dtype=np.int64))
