"""Hard-negative mining with rotated one-bit codes and deterministic intervals.

A vector o is coded by the signs of its rotated components: with x the unit vector of those
signs (turned back), o = t*x + r, where t = <o, x> (the alignment of code and vector, stored)
and r is orthogonal to x.  The rest r is coded again under another rotation, ``LEVELS`` times in
all; the last rest's length is stored.  For a query q, <q, o> = sum of t_l * <q, x_l> + <q, r>.
The query's rotated components are rounded to a few bits, so that <q, x_l> comes from
popcounts of the code against the query's bit planes; the rounding errs by at most the
1-norm of what was rounded off, and by Cauchy-Schwarz |<q, r>| <= |q|*|r|.  So each estimate
has an interval that surely holds the score.  A row whose interval cannot reach what an anchor
still needs is dropped; the others are scored with integers.  The result is exact.

Anchors are a stated part of all rows (every ``every``-th id).  They are taken in blocks of
bounded size; each block is broadcast and meets all rows where these lie, and every task
hands on at most ``k`` rows for each thing that is sought.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineark.llm.common import stored
from lineark.session import scratch_path

#: bits of the query's rounding at each level; one level each
PLANES = (6, 5, 4, 4)
#: most vector components in one block of anchors, and most pairs looked at in one step
BLOCK_VALUES = 1 << 18
PAIRS = 1 << 17
SEED = 20240501


def rotations(dims: int, levels: int) -> np.ndarray:
    """``levels`` orthogonal matrices, the same for the same arguments."""
    rng = np.random.RandomState(SEED)
    return np.stack([np.linalg.qr(rng.normal(size=(dims, dims)))[0] for _ in range(levels)])


def encode(v: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words) uint64, alignments (rows, levels) and the lengths of the rests."""
    n, dims = v.shape
    words = -(-dims // 64)
    codes, t, rest = np.zeros((n, len(turns), words), np.uint64), np.zeros((n, len(turns))), v.astype(np.float64)
    for level, turn in enumerate(turns):
        signs = rest @ turn.T >= 0
        bits = np.zeros((n, words * 64), bool)
        bits[:, :dims] = signs
        codes[:, level] = np.packbits(bits, axis=1, bitorder="little").view("<u8")
        unit = np.where(signs, 1.0, -1.0) @ turn / np.sqrt(dims)
        t[:, level] = np.einsum("ij,ij->i", rest, unit)
        rest = rest - t[:, level, None] * unit
    return codes, t, np.linalg.norm(rest, axis=1)


class Queries:
    """A block of query vectors, ready to be compared with codes."""

    def __init__(self, v: np.ndarray, turns: np.ndarray):
        self.v, self.dims, self.levels = v, v.shape[1], len(turns)
        self.norm = np.linalg.norm(v.astype(np.float64), axis=1)
        words = -(-self.dims // 64)
        self.planes, self.step, self.low, self.base, self.err = [], [], [], [], []
        root = np.sqrt(self.dims)
        for turn, bits in zip(turns, PLANES):
            q = v.astype(np.float64) @ turn.T
            low = q.min(axis=1, initial=0.0)
            step = (q.max(axis=1, initial=0.0) - low) / ((1 << bits) - 1)
            u = np.rint((q - low[:, None]) / np.where(step > 0, step, 1)[:, None]).astype(np.int64)
            self.err.append(np.abs(q - low[:, None] - step[:, None] * u).sum(axis=1) / root)
            planes = np.zeros((bits, len(v), words * 64), bool)
            for b in range(bits):
                planes[b, :, :self.dims] = u >> b & 1
            self.planes.append(np.packbits(planes, axis=2, bitorder="little").view("<u8"))
            self.step.append(2 * step / root)
            self.low.append(2 * low / root)
            self.base.append(-(self.dims * low + step * u.sum(axis=1)) / root)

    def interval(self, at: np.ndarray, codes: np.ndarray, t: np.ndarray, rest: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimate and half width of the scores of queries ``at`` with the coded rows."""
        mid = np.zeros((len(at), len(codes)))
        for level in range(self.levels):
            count = np.zeros(mid.shape, np.int32)
            for b, plane in enumerate(self.planes[level]):
                for w in range(codes.shape[2]):
                    count += np.bitwise_count(plane[at, w, None] & codes[None, :, level, w]).astype(np.int32) << b
            ones = np.bitwise_count(codes[:, level]).sum(axis=1, dtype=np.int64)
            own = t[:, level]
            mid += self.step[level][at, None] * count * own
            mid += np.outer(self.low[level][at], own * ones) + np.outer(self.base[level][at], own)
        wide = np.stack([*(e[at] for e in self.err), self.norm[at]], axis=1) @ np.abs(np.column_stack([t, rest])).T
        return mid, wide + 1e-9 * np.outer(self.norm[at], norm) + 1e-6      # float rounding is far below this


class Best:
    """The first ``k`` (score downwards, id, mark upwards) of each key."""

    def __init__(self, keys: int, k: int):
        self.k, self.rows = k, [np.zeros(0, np.int64) for _ in range(4)]    # key, score, id, mark
        self.kth = np.full(keys, np.iinfo(np.int64).min)

    def add(self, found: list[tuple]) -> None:
        if not found:
            return
        rows = [np.concatenate(x) for x in zip(self.rows, *found)]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        rows = [x[order] for x in rows]
        first = np.flatnonzero(np.concatenate(([True], rows[0][1:] != rows[0][:-1])))
        nth = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        self.rows = [x[nth < self.k] for x in rows]
        last = nth == self.k - 1
        self.kth[rows[0][last]] = rows[1][last]


def _search(block: dict, k: int, same: bool):
    """mapInArrow function: of the rows (id, mark, label, v, codes, t, rest), the best ``k`` for each anchor
    of the block and each of its score windows ``low..high``: (a, j, score, id, mark)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        own = block.value if hasattr(block, "value") else block
        queries, label, low, high = own["queries"], own["label"], own["low"], own["high"]
        windows = low.shape[1]
        best = Best(low.size, k)
        lows, highs = low.ravel(), high.ravel()
        by_label = {int(x): np.flatnonzero(label == x) for x in np.unique(label)}
        every = np.flatnonzero((low <= high).any(axis=1))
        fresh, found = True, []

        def meet(at, cols):
            group = max(1, PAIRS // len(cols["id"]))
            for s in range(0, len(at), group):
                step(at[s:s + group], cols)

        def step(at, cols):
            mid, wide = queries.interval(at, cols["codes"], cols["t"], cols["rest"], cols["norm"])
            up, down = mid + wide, mid - wide
            need = np.maximum(lows, best.kth).reshape(low.shape)[at]
            keep = np.zeros(mid.shape, bool)
            for j in range(windows):
                keep |= (up >= need[:, j, None]) & (down <= high[at, j, None])
            keep &= (label[at, None] == cols["label"]) == same
            a, c = np.nonzero(keep)
            a = at[a]
            other = (own["id"][a] != cols["id"][c]) | (own["mark"][a] != cols["mark"][c])
            a, c = a[other], c[other]
            score = np.zeros(len(a), np.int64)
            for s in range(0, len(a), PAIRS // 4):
                e = slice(s, s + PAIRS // 4)
                score[e] = np.einsum("ij,ij->i", queries.v[a[e]], cols["v"][c[e]])
            for j in range(windows):
                key = a * windows + j
                hit = (score >= np.maximum(lows, best.kth)[key]) & (score <= highs[key])
                found.append((key[hit], score[hit], cols["id"][c[hit]], cols["mark"][c[hit]]))

        for batch in batches:
            n, at = batch.num_rows, 0
            if not n:
                continue
            flat = lambda name: batch.column(name).flatten().to_numpy(zero_copy_only=False)
            v = flat("v").reshape(n, -1).astype(np.int64)
            words = -(-v.shape[1] // 64)
            cols = {"id": batch.column("id").to_numpy(), "mark": batch.column("mark").to_numpy(), "label": batch.column("label").to_numpy(),
                    "v": v, "codes": flat("codes").view(np.uint64).reshape(n, -1, words), "t": flat("t").reshape(n, -1),
                    "rest": batch.column("rest").to_numpy(), "norm": np.linalg.norm(v.astype(np.float64), axis=1)}
            while at < n:
                # a few rows first: they tell what the others must reach
                take = 128 if fresh else 1024
                part = {c: x[at:at + take] for c, x in cols.items()}
                at, fresh = at + take, False
                if same:
                    for value in np.unique(part["label"]):
                        mine = part["label"] == value
                        meet(by_label.get(int(value), every[:0]), {c: x[mine] for c, x in part.items()})
                else:
                    meet(every, part)
                best.add(found)
                found.clear()
        key, score, ident, mark = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in ((key // windows).astype(np.int32), (key % windows).astype(np.int32), score, ident, mark)],
                                         ["a", "j", "score", "id", "mark"])
    return run


_FOUND = "a int, j int, score long, id long, mark long"


def _first(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("a", "j").orderBy(F.desc("score"), "id", "mark"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def coded(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, mark, label, v, codes, t, rest): the rows that take part, once each, with their codes."""
    x = F.col(vector_col)
    fine = x.isNotNull() & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
    fine &= ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("v"))
    rows = stored(rows.select("id", F.xxhash64("label", "v").alias("mark"), "label", "v").distinct(), "vectors")
    most = rows.agg(F.max(F.size("v")).alias("dims"), F.max(F.array_max(F.transform("v", lambda c: F.abs(c)))).alias("top")).first()
    dims, top = max(most["dims"] or 1, 1), most["top"] or 0
    if dims * top * top >= 1 << 62:
        raise ValueError(f"components up to {top} in {dims} dimensions: inner products would not fit a LONG")
    turns = rotations(dims, len(PLANES))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                v = np.zeros((part.num_rows, dims), np.int64)
                lists = part.column("v")
                size = np.diff(lists.offsets.to_numpy())
                v[np.arange(dims) < size[:, None]] = lists.flatten().to_numpy()
                codes, t, rest = encode(v, turns)
                rows_of = lambda x: pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x[0].size, x.reshape(-1))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("mark"), part.column("label"), rows_of(v),
                                                  rows_of(codes.view(np.int64)), rows_of(t), pa.array(rest)],
                                                 ["id", "mark", "label", "v", "codes", "t", "rest"])
    return stored(rows.mapInArrow(run, "id long, mark long, label long, v array<long>, codes array<long>, t array<double>, rest double"), "coded")


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Hard negatives of every row whose id is divisible by ``every``.

    Components become floor(``scale`` * x); scores are integer inner products with the anchor,
    higher first, ties by the smaller id.  An anchor's positives are its first ``positives`` other rows
    of its label; for each of them the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score are returned:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows with a null id, label or vector or a component that is null or not finite take no part.  A
    row that repeats (same id, label and vector) counts once; rows that share an id and differ
    are rows of their own.  Shorter vectors end in zeros.  Components so large that an inner product
    would not fit a LONG raise an error.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = coded(vectors, scale, id_col, vector_col, label_col)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    anchors = rows.where(F.pmod("id", F.lit(every)) == 0).select("id", "mark", "label", "v")
    n, dims = anchors.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], schema)
    turns = rotations(dims, len(PLANES))
    # blocks of bounded size: the hash deals distinct rows evenly
    blocks = -(-n // max(1, BLOCK_VALUES // dims))
    dealt = scratch_path(spark, "anchors")
    anchors.withColumn("block", F.pmod(F.xxhash64("id", "mark"), F.lit(blocks)).cast("int")).write.partitionBy("block").parquet(dealt)
    dealt_rows = spark.read.schema("id long, mark long, label long, v array<long>, block int").parquet(dealt)
    out = scratch_path(spark, "negatives")
    spark.createDataFrame([], schema).write.parquet(out)
    for b in range(blocks):
        mine = dealt_rows.where(F.col("block") == b).select("id", "mark", "label", "v").toArrow()
        a = mine.num_rows
        if not a:
            continue
        name = lambda c: mine.column(c).to_numpy()
        own = {"id": name("id"), "mark": name("mark"), "label": name("label"),
               "queries": Queries(mine.column("v").combine_chunks().flatten().to_numpy().reshape(a, dims), turns),
               "low": np.full((a, 1), np.iinfo(np.int64).min), "high": np.full((a, 1), np.iinfo(np.int64).max)}
        shared = spark.sparkContext.broadcast(own)
        near = _first(rows.mapInArrow(_search(shared, positives, True), _FOUND), positives).select("a", "rank", "score", "id").toArrow()
        shared.destroy()
        # a score window for each positive; without one, a window that holds nothing
        at, j, p, pid = (near.column(c).to_numpy() for c in ("a", "rank", "score", "id"))
        pos, names = np.zeros((a, positives), np.int64), np.zeros((a, positives), np.int64)
        lows, highs = np.full((a, positives), np.iinfo(np.int64).max), np.zeros((a, positives), np.int64)
        pos[at, j - 1], names[at, j - 1] = p, pid
        lows[at, j - 1], highs[at, j - 1] = -(-low * p // 100), high * p // 100
        shared = spark.sparkContext.broadcast(own | {"low": lows, "high": highs})
        far = _first(rows.mapInArrow(_search(shared, negatives, False), _FOUND), negatives)
        keys = spark.createDataFrame(_table(own["id"], pos, names))     # at most positives rows for each anchor of the block
        (far.join(F.broadcast(keys), ["a", "j"])
         .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
                 F.col("score").alias("negative_score")).write.mode("append").parquet(out))
        shared.destroy()
    return spark.read.schema(schema).parquet(out)


def _table(ids: np.ndarray, score: np.ndarray, name: np.ndarray):
    import pyarrow as pa
    a, j = np.indices(score.shape)
    return pa.table({"a": a.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "anchor_id": np.repeat(ids, score.shape[1]),
                     "positive_id": name.ravel(), "positive_score": score.ravel()})
