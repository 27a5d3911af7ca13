"""Time-series features: lag alignment, third-order autocovariance (tc3), first zero of the ACF.

Long form input is ``(key, order..., value)``.  A single series may hold a large
share of all rows, so no unbounded series is put into one task: rows are
range-partitioned (a hot series spans many partitions).  ``tc3`` and ``status_changes`` carry
what stands at the partitions' borders; where positions are needed, they are computed from the
partitions' counts and lagged values are brought together by an equi-shuffle on
``(key, position)``.  The same route serves series of every length.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, IntegralType

from lineark.operators.blocks import lagged_sums, sliding, triples

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the in-partition row number in the low 33 bits


def _cols(x):
    return [x] if isinstance(x, (str, Column)) else list(x)


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", hint: str | None = None) -> DataFrame:
    """Join on ``keys`` with NULL-safe equality (a NULL series key is a series too);
    the key columns appear once, from the left side.  ``hint`` is for the right side."""
    r = right.select(*[F.col(c).alias(f"_rk_{c}") if c in keys else F.col(c) for c in right.columns])
    r = r.hint(hint) if hint else r
    cond = [left[k].eqNullSafe(r[f"_rk_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_rk_{k}" for k in keys])


def with_series_index(df: DataFrame, key, order, name: str = "idx",
                      partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row inside its series (ordered by ``order``).

    ``key`` + ``order`` must be a total order (break ties with a unique column).
    Rows are range-partitioned on ``(key, order)``, numbered inside each
    partition, and shifted by the row counts of the same series in earlier
    partitions.  The per-(partition, series) count table has at most
    ``#series + #partitions`` rows; it is the build side of a hash join on
    ``(partition, key)``, balanced because a hot series is split over many
    partitions.  (Left to itself, Spark may broadcast the rows and keep the
    partitions of the counts, all of a hot series' in one.)
    """
    keys, ords = _cols(key), _cols(order)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Range bounds come from a seeded sample, so two evaluations of the same
    # plan may cut the partitions differently.  The numbered rows are written
    # once to the shared checkpoint folder; counts and rows below read the same
    # partitions, and a lost executor re-reads them instead of re-sampling.
    ranged = (df.repartitionByRange(n, *keys, *ords)
              .sortWithinPartitions(*keys, *ords)
              .withColumn("_rid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright(F.col("_rid"), _LOCAL_BITS))
              .withColumn("_loc", F.col("_rid").bitwiseAND((1 << _LOCAL_BITS) - 1))
              .drop("_rid")
              .checkpoint(eager=True))
    chunks = ranged.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_cnt"),
                                               F.min("_loc").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0))) \
        .select("_pid", *keys, "_first", "_off")
    out = (_join(ranged, chunks, ["_pid", *keys], hint="shuffle_hash")
           .withColumn(name, F.col("_loc") - F.col("_first") + F.col("_off"))
           .drop("_pid", "_loc", "_first", "_off"))
    return out


def row_key(df: DataFrame, name: str = "row_key", order=None) -> DataFrame:
    """A unique ID per row, usable as a grouping key.

    Without ``order`` it is ``monotonically_increasing_id()`` (unique, not
    stable across reruns).  With ``order`` (a total order) it is the stable
    0-based position from :func:`with_series_index`, computed without a
    global window."""
    if order is None:
        return df.withColumn(name, F.monotonically_increasing_id())
    return with_series_index(df, [], _cols(order), name=name)


def _triple_slots(indexed: DataFrame, key: list[str], value: str, tau) -> DataFrame:
    """Group the values at positions i, i+tau, i+2tau under the triple start i.

    Each row contributes to three triples (as member 0, 1 or 2); one shuffle on
    ``(key, i)`` collects them.  ``tau`` is a number or a column name.
    """
    t = F.lit(tau) if isinstance(tau, int) else F.col(tau)
    slots = F.array(
        F.struct(F.col("_ix").alias("_i"), F.lit(0).alias("_r")),
        F.struct((F.col("_ix") - t).alias("_i"), F.lit(1).alias("_r")),
        F.struct((F.col("_ix") - 2 * t).alias("_i"), F.lit(2).alias("_r")),
    )
    exploded = (indexed.select(*key, F.col(value).alias("_y"), F.explode(slots).alias("_s"))
                .select(*key, "_y", F.col("_s._i").alias("_i"), F.col("_s._r").alias("_r"))
                .where(F.col("_i") >= 0))
    return exploded.groupBy(*key, "_i").agg(
        F.max(F.when(F.col("_r") == 0, F.col("_y"))).alias("y0"),
        F.max(F.when(F.col("_r") == 1, F.col("_y"))).alias("y1"),
        F.max(F.when(F.col("_r") == 2, F.col("_y"))).alias("y2"),
    )


def lag_triples(df: DataFrame, key, value: str, order, tau: int) -> DataFrame:
    """Aligned values ``(y_i, y_{i+tau}, y_{i+2tau})`` for every complete triple (no value
    NULL), with ``i`` (no key may have that name) the position of the first.  Positions run in
    blocks with a halo (:mod:`blocks`), so each value is shuffled about once after the numbering."""
    keys, ords = _cols(key), _cols(order)
    rows = with_series_index(df.select(*keys, *ords, value), keys, ords, name="_ix").select(*keys, "_ix", F.col(value).alias("_y"))
    kind = rows.schema["_y"].dataType.simpleString()
    return sliding(rows, keys, "_ix", {"y": F.max("_y")}, 0, 2 * tau, triples(tau), f"i long, y0 {kind}, y1 {kind}, y2 {kind}")


def _tc3_from_slots(slots: DataFrame, key: list[str], digits: int | None) -> DataFrame:
    full = F.col("y0").isNotNull() & F.col("y1").isNotNull() & F.col("y2").isNotNull()
    agg = slots.groupBy(*key).agg(
        F.count(F.when(full, F.lit(1))).alias("n_triples"),
        F.sum(F.when(full, F.col("y0") * F.col("y1") * F.col("y2"))).alias("_s3"),
        F.sum(F.when(full, F.col("y0") * F.col("y1"))).alias("_s2"),
    )
    return _tc3_from_sums(agg, key, digits)


def _tc3_from_sums(agg: DataFrame, key: list[str], digits: int | None) -> DataFrame:
    """Features from the sums ``(key, n_triples, _s3, _s2)``."""
    n = F.col("n_triples").cast("double")
    num = F.when(F.col("n_triples") > 0, F.col("_s3").cast("double") / n)
    denom = F.when(F.col("n_triples") > 0,
                   F.pow(F.abs(F.col("_s2").cast("double") / n), F.lit(1.5)))
    out = agg.select(*key, "n_triples", num.alias("num"), denom.alias("denom"))
    out = out.select(*key, "n_triples",
                     F.try_divide("num", "denom").alias("raw"), "num", "denom")
    out = out.select(*key, "n_triples", "raw", F.abs("raw").alias("abs"), "num",
                     F.abs("num").alias("absnum"), "denom")
    if digits is not None:
        out = out.select(*key, "n_triples",
                         *[F.round(c, d).alias(c) for c, d in
                           (("raw", digits), ("abs", digits), ("num", digits - 4),
                            ("absnum", digits - 4), ("denom", digits - 4))])
    return out


def _carried(keys: list[str], tau: int):
    """mapInArrow function over rows sorted by ``(keys, order)``, all of a partition: one row per series and
    partition with the sums over the triples that lie in it, and, for the first and the last
    series, which may go on in other partitions, the values at its borders: all of them, or the
    first and the last ``2 tau``; behind them as many marks, NaN where a value is NULL."""
    edge = 2 * tau

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        pid = None
        carry, count, head = None, 0, None       # the last series so far: its last values, their number, its first values
        open_key, sums, first = None, None, True

        def row(last):
            nonlocal first
            border = first or last
            whole = count <= 2 * edge
            out = {**{f"_k{i}": [v] for i, v in enumerate(open_key)}, "_pid": [pid], "_n": [int(sums[0])], "_s3": [float(sums[1])], "_s2": [float(sums[2])], "_len": [count],
                   "_head": [np.concatenate(head).tolist() if border else None],
                   "_tail": [np.concatenate([x[len(x) - edge:] for x in carry]).tolist() if border and not whole else None]}
            first = False
            return out

        def record(rows):
            cols = {c: sum((r[c] for r in rows), []) for c in rows[0]}
            types = {**{f"_k{i}": t for i, t in enumerate(key_types)}, "_pid": pa.int64(), "_n": pa.int64(), "_s3": pa.float64(), "_s2": pa.float64(),
                     "_len": pa.int64(), "_head": pa.list_(pa.float64()), "_tail": pa.list_(pa.float64())}
            return pa.RecordBatch.from_arrays([pa.array(cols[c], type=t) for c, t in types.items()], list(types))

        for batch in batches:
            if not batch.num_rows:
                continue
            key_types = [batch.column(k).type for k in keys]
            pid = batch.column("_pid")[0].as_py()
            y = batch.column("_y")
            value, mark = y.to_numpy(zero_copy_only=False).astype(float), np.where(y.is_null().to_numpy(zero_copy_only=False), np.nan, 0.0)
            changes = np.zeros(batch.num_rows, bool)
            for k in keys:
                c = batch.column(k)
                a, b = c.slice(1), c.slice(0, len(c) - 1)
                differ = pc.if_else(pc.and_(pc.is_null(a), pc.is_null(b)), False, pc.fill_null(pc.not_equal(a, b), True))
                changes[1:] |= differ.to_numpy(zero_copy_only=False).astype(bool)
            starts = np.append(np.flatnonzero(np.concatenate(([True], changes[1:]))), batch.num_rows)
            rows = []
            for s, e in zip(starts, starts[1:]):
                key = tuple(batch.column(k)[int(s)].as_py() for k in keys)
                if open_key is not None and key != open_key:
                    rows.append(row(False))
                    open_key = None
                if open_key is None:
                    open_key, sums, count = key, np.zeros(3), 0
                    carry, head = (np.zeros(0),) * 2, (np.zeros(0),) * 2
                own = value[s:e], mark[s:e]
                if len(head[0]) < 2 * edge:
                    head = tuple(np.concatenate((h, x[:2 * edge - len(h)])) for h, x in zip(head, own))
                v, m = (np.concatenate((c, x)) for c, x in zip(carry, own))
                sums = sums + _triple_sums(v, m, len(carry[0]), tau)
                carry = v[max(0, len(v) - edge):], m[max(0, len(m) - edge):]
                count += int(e - s)
            if rows:
                yield record(rows)
        if open_key is not None:
            yield record([row(True)])
    return run


def _triple_sums(v, m, known: int, tau: int):
    """(count, sum of threes, sum of twos) of the complete triples of ``v`` that end at ``known`` or later; ``m``
    is NaN where a value is missing."""
    import numpy as np
    at = np.arange(max(0, known - 2 * tau), len(v) - 2 * tau)
    if not len(at):
        return np.zeros(3)
    at = at[~np.isnan(m[at] + m[at + tau] + m[at + 2 * tau])]
    two = v[at] * v[at + tau]
    return np.array([len(at), (two * v[at + 2 * tau]).sum(), two.sum()])


def _across(tau: int):
    """Pandas UDF: sums over the triples that cross partitions, from a series' borders in the order of partitions."""
    edge = 2 * tau

    @F.pandas_udf("struct<n: long, s3: double, s2: double>")
    def sums(borders: pd.Series) -> pd.DataFrame:
        import numpy as np
        out = []
        for parts in borders:
            total = np.zeros(3)
            before = np.zeros(0), np.zeros(0)
            for p in parts:
                both = [np.array(p[c] if p[c] is not None else [], float) for c in ("head", "tail")]
                own, gone = [x[:len(x) // 2] for x in both], [x[len(x) // 2:] for x in both]
                v, m = np.concatenate((before[0], own[0][:edge])), np.concatenate((before[1], gone[0][:edge]))
                # of these, the triples that begin before this partition and end in it
                inside = _triple_sums(own[0][:edge], gone[0][:edge], 0, tau)
                total += _triple_sums(v, m, len(before[0]), tau) - inside
                v, m = (own[1], gone[1]) if p["tail"] is not None else (np.concatenate((before[0], own[0])), np.concatenate((before[1], gone[0])))
                before = v[max(0, len(v) - edge):], m[max(0, len(m) - edge):]
            out.append(total)
        n, s3, s2 = zip(*out) if out else ((), (), ())
        return pd.DataFrame({"n": np.array(n, np.int64), "s3": np.array(s3, float), "s2": np.array(s2, float)})
    return sums


def tc3(df: DataFrame, key, value: str, order, tau: int,
        digits: int | None = None) -> DataFrame:
    """Normalised third-order autocovariance at lag ``tau``, one row per series.

    ``num = mean(y_i y_{i+tau} y_{i+2tau})``, ``denom = |mean(y_i y_{i+tau})|^1.5``,
    ``raw = num / denom``, plus ``abs`` and ``absnum``, over the triples of which no value is
    NULL.  Series with no such triple (N <= 2 tau) give NULL features.  Values are
    taken as DOUBLE.  ``digits`` rounds raw/abs to that many decimals and the
    large-magnitude num/absnum/denom to ``digits - 4``.

    Rows are range-partitioned on ``(key, order)``, so a hot series spans many partitions, and
    read once as sorted streams.  Each partition hands on one row per series, with the values at
    its borders where the series may go on; these few rows are all that is shuffled again.
    """
    keys, ords = _cols(key), _cols(order)
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*(F.col(k).alias(a) for k, a in zip(keys, names)), *(F.col(o).alias(f"_o{i}") for i, o in enumerate(ords)), F.col(value).cast("double").alias("_y"))
    by = [*names, *(f"_o{i}" for i in range(len(ords)))]
    sorted_rows = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).select(*names, F.spark_partition_id().cast("long").alias("_pid"), "_y")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    parts = sorted_rows.mapInArrow(_carried(names, tau), (kinds + ", " if kinds else "") + "_pid long, _n long, _s3 double, _s2 double, _len long, _head array<double>, _tail array<double>")
    border = F.when(F.col("_head").isNotNull(), F.struct("_pid", F.col("_head").alias("head"), F.col("_tail").alias("tail")))
    # a series has one row in each partition that it spans, and only then borders
    sums = parts.groupBy(*names).agg(F.sum("_n").alias("_n"), F.sum("_s3").alias("_s3"), F.sum("_s2").alias("_s2"), F.array_sort(F.collect_list(border)).alias("_b"))
    crossed = sums.withColumn("_x", _across(tau)("_b"))
    total = crossed.select(*(F.col(a).alias(k) for k, a in zip(keys, names)), (F.col("_n") + F.col("_x.n")).alias("n_triples"),
                           (F.col("_s3") + F.col("_x.s3")).alias("_s3"), (F.col("_s2") + F.col("_x.s2")).alias("_s2"))
    return _tc3_from_sums(total, keys, digits)


def tc3_array(df: DataFrame, id_col: str, arr_col: str, tau: int,
              digits: int | None = None) -> DataFrame:
    """tc3 per row of an array column: one series per row, no shuffle at all; triples
    with a NULL do not count.
    Higher-order functions sum the triples in place; ``digits`` rounds every
    output to that many decimals."""
    y = f"transform({arr_col}, x -> CAST(x AS DOUBLE))"
    m = f"(size({arr_col}) - {2 * tau})"
    seq = f"sequence(0, {m} - 1)"
    three = f"_y[i] * _y[i + {tau}] * _y[i + {2 * tau}]"         # NULL unless the triple is complete
    full = f"size(filter({seq}, i -> {three} IS NOT NULL))"
    s3 = f"aggregate({seq}, CAST(0 AS DOUBLE), (a, i) -> a + coalesce({three}, 0))"
    s2 = f"aggregate({seq}, CAST(0 AS DOUBLE), (a, i) -> a + if({three} IS NULL, 0, _y[i] * _y[i + {tau}]))"
    base = df.select(id_col, F.expr(y).alias("_y"), F.expr(m).alias("_m"))
    sums = base.select(
        id_col,
        F.when(F.col("_m") > 0, F.expr(full.replace(m, "_m"))).otherwise(0).alias("n_triples"),
        F.when(F.col("_m") > 0, F.expr(s3.replace(m, "_m"))).alias("_s3"),
        F.when(F.col("_m") > 0, F.expr(s2.replace(m, "_m"))).alias("_s2"),
    )
    n = F.when(F.col("n_triples") > 0, F.col("n_triples").cast("double"))
    out = sums.select(id_col, "n_triples", (F.col("_s3") / n).alias("num"),
                      F.pow(F.abs(F.col("_s2") / n), F.lit(1.5)).alias("denom"))
    out = out.select(id_col, "n_triples", F.try_divide("num", "denom").alias("raw"),
                     "num", "denom")
    out = out.select(id_col, "n_triples", "raw", F.abs("raw").alias("abs"), "num",
                     F.abs("num").alias("absnum"), "denom")
    if digits is not None:
        out = out.select(id_col, "n_triples",
                         *[F.round(c, digits).alias(c) for c in ("raw", "abs", "num", "absnum", "denom")])
    return out


def first_zero_lag(df: DataFrame, key, value: str, order, max_lag: int = 16) -> DataFrame:
    """Per series, the first lag whose autocorrelation is <= 0 (``tau='ac'``).

    Lags are tried in blocks, ``max_lag`` of them first and twice as many each next time,
    and only series without an answer go on to the next block, so the result is exact for
    every series; a series with no such lag below N (its number of rows) gets N.  The mean is of
    the values that are not NULL, and pairs with a NULL count nothing.  For DECIMAL and whole
    numbers the sign is decided by exact integers.

    Products are summed where the rows lie, in blocks of positions with the next lags' rows as
    halo (:mod:`blocks`); only one row per series, block and lag moves on.
    """
    keys, ords = _cols(key), _cols(order)
    base = with_series_index(df.select(*keys, *ords, value), keys, ords, name="_ix")
    return _first_zero(base, keys, value, max_lag)


def _first_zero(base: DataFrame, keys: list[str], value: str, max_lag: int) -> DataFrame:
    kind = base.schema[value].dataType
    exact = isinstance(kind, (DecimalType, IntegralType))
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    # the values as whole numbers, or as differences from the mean
    rows = base.select(*keys, "_ix", (F.col(value).cast("decimal(38,0)") if not scale else
                                      (F.col(value) * F.lit(Decimal(10) ** scale)).cast("decimal(38,0)")).alias("_y") if exact
                       else F.col(value).cast("double").alias("_y"))
    stats = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count("_y").alias("_c"), F.sum("_y").alias("_S")).checkpoint()
    if not exact:
        rows = _join(rows, stats, keys).select(*keys, "_ix", (F.col("_y") - F.col("_S") / F.col("_c")).alias("_y"))
    number = "decimal(38,0)" if exact else "double"
    found, pending, lo, width = [], stats, 1, max_lag
    while True:
        hi = lo + width - 1
        live = rows if lo == 1 else _join(rows, pending.select(*keys), keys, "left_semi")
        sums = sliding(live, keys, "_ix", {"y": F.max("_y")}, 0, hi, lagged_sums(lo, hi, exact),
                       f"lag long, m long, p {number}, a {number}, b {number}")
        acf = sums.groupBy(*keys, "lag").agg(*(F.sum(c).alias(c) for c in ("m", "p", "a", "b")))
        # a lag without pairs has no sign
        if exact:
            signed = _join(acf, stats.select(*keys, "_c", "_S"), keys).withColumn("_up", _above_zero("_c", "_S", "m", "p", "a", "b"))
        else:
            signed = acf.withColumn("_up", F.col("p") > 0)
        # one row per answered series: small, fixed once so the loop test below is cheap
        hit = signed.where(~F.col("_up")).groupBy(*keys).agg(F.min("lag").alias("tau")).checkpoint()
        found.append(hit)
        pending = _join(pending, hit.select(*keys), keys, "left_anti").where(F.col("n") - 1 > hi)
        if not pending.take(1):
            break
        pending = pending.checkpoint()
        lo, width = hi + 1, 2 * width
    hits = found[0]
    for h in found[1:]:
        hits = hits.unionByName(h)
    return (_join(stats.select(*keys, "n"), hits, keys, "left")
            .select(*keys, F.coalesce(F.col("tau"), F.col("n")).cast("bigint").alias("tau")))


@F.pandas_udf(BooleanType())
def _above_zero(c: pd.Series, s: pd.Series, m: pd.Series, p: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    """Is the sum of ``(c*y_i - s)(c*y_j - s)`` over ``m`` pairs above zero, from the sums of the products, firsts and seconds."""
    return pd.Series([int(c) ** 2 * int(p) - int(c) * int(s) * (int(a) + int(b)) + int(m) * int(s) ** 2 > 0
                      for c, s, m, p, a, b in zip(c, s, m, p, a, b)], dtype=bool)


def tc3_auto(df: DataFrame, key, value: str, order, max_lag: int = 16,
             digits: int | None = None) -> DataFrame:
    """tc3 where each series uses its own ``tau`` from :func:`first_zero_lag`."""
    keys, ords = _cols(key), _cols(order)
    base = with_series_index(df.select(*keys, *ords, value), keys, ords, name="_ix")
    taus = _first_zero(base, keys, value, max_lag)
    slots = _triple_slots(_join(base, taus, keys), keys, value, "tau")
    feats = _tc3_from_slots(slots, keys, digits)
    return _join(feats, taus, keys).select(*keys, "tau", *[c for c in feats.columns if c not in keys])


def flatten_features(df: DataFrame, struct_col: str, func: str,
                     widths: dict[str, int] | None = None) -> DataFrame:
    """Feature results (a struct of scalars and vectors) -> flat columns.

    A scalar field ``key`` becomes ``<func>_<key>``; a vector field becomes
    ``<func>_<key>_1 .. _n``.  ``n`` comes from ``widths`` or, when not given,
    from one aggregate over the data (the longest vector).
    """
    from pyspark.sql.types import ArrayType
    fields = df.schema[struct_col].dataType.fields
    widths = dict(widths or {})
    vec = [f.name for f in fields if isinstance(f.dataType, ArrayType) and f.name not in widths]
    if vec:
        row = df.agg(*[F.max(F.size(F.col(f"{struct_col}.{n}"))).alias(n) for n in vec]).first()
        widths.update({n: int(row[n] or 0) for n in vec})
    keep = [c for c in df.columns if c != struct_col]
    out = []
    for f in fields:
        src = F.col(f"{struct_col}.{f.name}")
        if isinstance(f.dataType, ArrayType):
            out += [F.get(src, i).alias(f"{func}_{f.name}_{i + 1}") for i in range(widths[f.name])]
        else:
            out.append(src.alias(f"{func}_{f.name}"))
    return df.select(*keep, *out)


def _changes(keys: list[str]):
    """mapInArrow function over rows sorted by ``(keys, order)``, all of a partition: the rows whose phase differs
    from the one before in the series, with that phase and the time of the next change.  The first row of
    the partition's first series counts as a change and is marked ``_head``, since its series may have begun
    before; the last change is marked ``_tail``, since its series may go on."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def differs(table, names):
            """Row i differs from row i - 1 in one of the columns, NULL being a value (True for row 0)."""
            out = np.ones(table.num_rows, bool)
            out[1:] = False
            for name in names:
                c = table.column(name)
                a, b = c.slice(1), c.slice(0, len(c) - 1)
                differ = pc.if_else(pc.and_(pc.is_null(a), pc.is_null(b)), False, pc.fill_null(pc.not_equal(a, b), True))
                out[1:] |= differ.to_numpy().astype(bool)
            return out

        def with_next(table):
            """Of change rows, the time of the next one of the same series."""
            n = table.num_rows
            same = np.append(~differs(table, keys)[1:], False)
            following = pa.array(np.minimum(np.arange(1, n + 1), n - 1), mask=~same)
            return table.set_column(table.schema.get_field_index("_next"), "_next", table.column("_ts").take(following))

        last_row = waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            head = last_row is None
            if not head:
                table = pa.concat_tables([last_row, table]).combine_chunks()
            last_row = table.slice(table.num_rows - 1)
            new_series = differs(table, keys)
            change = new_series | differs(table, ["_phase"])
            if not head:
                change[0] = False                  # the row carried over
            at = np.flatnonzero(change)
            if not len(at):
                continue
            rows = table.take(pa.array(at))
            prev = table.column("_phase").take(pa.array(np.maximum(at - 1, 0), mask=new_series[at]))
            marks = np.zeros(len(at), bool)
            marks[0] = head
            rows = (rows.append_column("_prev", prev).append_column("_next", pa.nulls(len(at), rows.schema.field("_ts").type))
                    .append_column("_head", pa.array(marks)).append_column("_tail", pa.array(np.zeros(len(at), bool))))
            if waiting is not None:
                rows = pa.concat_tables([waiting, rows]).combine_chunks()
            rows = with_next(rows)
            waiting = rows.slice(rows.num_rows - 1)
            yield from rows.slice(0, rows.num_rows - 1).combine_chunks().to_batches()
        if waiting is not None:
            tail = waiting.set_column(waiting.schema.get_field_index("_tail"), "_tail", pa.array([True]))
            yield from tail.combine_chunks().to_batches()
    return run


def status_changes(df: DataFrame, key, phase: str, order, ts: str) -> DataFrame:
    """Rows where a job's phase differs from the one before, with the time until
    the next change (``micros_in_phase``; NULL for the last phase).

    A change into or out of a NULL phase counts.  Rows are range-partitioned on ``(key, order)``, so
    one very chatty job spans many partitions, shuffled once and read as sorted streams.  The changes found are
    written once; only the one at each end of a partition is looked at again, beside its
    neighbours of the same job: at most two rows a partition.
    """
    keys, ords = _cols(key), _cols(order)
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    names = [f"_k{i}" for i in range(len(keys))]
    by = [*names, *(f"_o{i}" for i in range(len(ords)))]
    rows = df.select(*(F.col(k).alias(a) for k, a in zip(keys, names)), *(F.col(o).alias(f"_o{i}") for i, o in enumerate(ords)),
                     F.col(ts).alias("_ts"), F.col(phase).alias("_phase"))
    in_order = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).select(
        *names, "_ts", "_phase", F.spark_partition_id().alias("_pid"))
    kind = {f.name: f.dataType.simpleString() for f in in_order.schema}
    schema = ", ".join([*(f"`{c}` {t}" for c, t in kind.items()), f"_prev {kind['_phase']}", f"_next {kind['_ts']}", "_head boolean", "_tail boolean"])
    found = in_order.mapInArrow(_changes(names), schema).checkpoint()

    ends = found.where("_head OR _tail")
    job = Window.partitionBy(*names).orderBy("_pid", ~F.col("_head"))
    before = F.lag(F.struct("_phase")).over(job)                    # the last phase in the partitions before
    is_change = ~F.col("_head") | F.col("_b").isNull() | ~F.col("_b._phase").eqNullSafe(F.col("_phase"))
    ends = ends.withColumn("_b", before).withColumn("_is", is_change)
    # the first change that an end row knows of: itself, or the next in its partition
    knows = F.when(F.col("_is"), F.struct("_ts")).when(~F.col("_tail") & F.col("_next").isNotNull(), F.struct(F.col("_next").alias("_ts")))
    later = job.rowsBetween(1, Window.unboundedFollowing)
    ends = (ends.withColumn("_knows", knows).withColumn("_later", F.first("_knows", ignorenulls=True).over(later)).where("_is")
            .withColumn("_prev", F.when(F.col("_head"), F.col("_b._phase")).otherwise(F.col("_prev")))
            .withColumn("_next", F.when(F.col("_tail"), F.col("_later._ts")).otherwise(F.col("_next"))))
    cols = [*names, "_ts", "_phase", "_prev", "_next"]
    out = found.where("NOT (_head OR _tail)").select(*cols).unionByName(ends.select(*cols))
    return out.select(*(F.col(a).alias(k) for k, a in zip(keys, names)), F.col("_ts").alias(ts), F.col("_phase").alias(phase),
                      F.col("_prev").alias("prev_phase"), F.col("_next").alias("next_change_ts"),
                      F.expr("timestampdiff(MICROSECOND, _ts, _next)").alias("micros_in_phase"))
