"""Array maths on long voxel/series tables ``(image, coord..., v)``.

The catalogued image tools, re-aimed at one row per value so that images of
any size spread over the cluster: reductions are grouped aggregates, the lag is an
equi-join on the shifted coordinate, smoothing and neighbourhoods run on blocks
with a halo, and exact percentiles come from counts of the values' leading bits, never from one
group's values gathered in one task.
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from lineark.operators.blocks import extremes, gaussian, sliding
from lineark.operators.series import _join


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


_INFINITY = 0x7FF << 52     # its bits; above stands NaN, which pandas takes for NULL


@F.pandas_udf(LongType())
def _ordered_bits(v: pd.Series) -> pd.Series:
    """The bits of a DOUBLE as a LONG that sorts as the number does (-0.0 as 0.0, NaN last)."""
    import numpy as np
    x = v.to_numpy(dtype=np.float64) + 0.0
    x[np.isnan(x)] = np.nan
    b = x.view(np.int64)
    return pd.Series(np.where(b < 0, b ^ np.int64(0x7FFFFFFFFFFFFFFF), b))


@F.pandas_udf(DoubleType())
def _from_bits(b: pd.Series) -> pd.Series:
    import numpy as np
    x = b.to_numpy(dtype=np.int64)
    return pd.Series(np.where(x < 0, x ^ np.int64(0x7FFFFFFFFFFFFFFF), x).view(np.float64))


def exact_quantiles(df: DataFrame, keys, v: str, qs: dict[str, float]) -> DataFrame:
    """Exact linear-interpolated quantiles per group (same rule as
    ``percentile``/``quantile_cont``).  Values are taken as DOUBLE; NULL values do not count; a
    NULL group key is a group; a group without values has no row.

    Selection by counting: four times, the values that agree with the asked rank's value in the bits so
    far are counted by their next 16 bits, and the running counts tell which 16 bits the rank
    falls on.  Only counts are shuffled for a large group (at most 65,536 a task), nothing is
    sorted, and no group is gathered."""
    keys = _cols(keys)
    bits = df.where(F.col(v).isNotNull()).select(*keys, _ordered_bits(F.col(v).cast("double")).alias("_bits"))
    ranks = F.array(*[F.struct(F.lit(name).alias("q"), F.lit(end).alias("end"), fn((F.col("_n") - 1) * F.lit(float(q))).cast("bigint").alias("rank"))
                      for name, q in qs.items() for end, fn in (("lo", F.floor), ("hi", F.ceil))])
    picks = None
    for shift in (48, 32, 16, 0):
        part = F.shiftright("_bits", shift).alias("_at")
        if picks is None:
            counts = bits.select(*keys, part).groupBy(*keys, "_at").agg(F.count(F.lit(1)).alias("_c"))
            group = Window.partitionBy(*keys)
            counts = counts.withColumn("_n", F.sum("_c").over(group)).withColumn("_to", F.sum("_c").over(group.orderBy("_at")))
            due = F.filter(ranks, lambda p: (p.rank >= F.col("_to") - F.col("_c")) & (p.rank < F.col("_to")))
            picks = counts.select(*keys, "_n", "_at", "_to", "_c", F.explode(due).alias("_p")).select(
                *keys, "_n", F.col("_p.q").alias("_q"), F.col("_p.end").alias("_end"), "_at", (F.col("_p.rank") - (F.col("_to") - F.col("_c"))).alias("_rank"))
            continue
        near = bits.select(*keys, F.shiftright("_bits", shift + 16).alias("_pre"), part)
        asked = [*keys, "_n", "_q", "_end", "_rank"]
        counts = (_join(near, picks.withColumnRenamed("_at", "_pre"), [*keys, "_pre"])
                  .groupBy(*asked, "_at").agg(F.count(F.lit(1)).alias("_c"))
                  .withColumn("_to", F.sum("_c").over(Window.partitionBy(*asked).orderBy("_at"))))
        picks = counts.where((F.col("_rank") >= F.col("_to") - F.col("_c")) & (F.col("_rank") < F.col("_to"))).select(
            *keys, "_n", "_q", "_end", "_at", (F.col("_rank") - (F.col("_to") - F.col("_c"))).alias("_rank"))
    found = picks.select(*keys, "_n", "_q", "_end", F.when(F.col("_at") > _INFINITY, F.lit(float("nan"))).otherwise(_from_bits("_at")).alias("_v"))
    at = {(q, e): F.max(F.when((F.col("_q") == q) & (F.col("_end") == e), F.col("_v"))) for q in qs for e in ("lo", "hi")}
    h = {name: (F.max("_n") - 1) * F.lit(float(q)) for name, q in qs.items()}
    return found.groupBy(*keys).agg(*[
        F.when(at[q, "lo"] == at[q, "hi"], at[q, "lo"])
        .otherwise(at[q, "lo"] + (h[q] - F.floor(h[q])) * (at[q, "hi"] - at[q, "lo"])).alias(q) for q in qs])


def reduce_over_dim(df: DataFrame, keep, dim: str, v: str = "v") -> DataFrame:
    """Mean, std, min, max, median, 90th percentile and index of the maximum
    across ``dim`` for every combination of the other dimensions."""
    keep = _cols(keep)
    base = df.groupBy(*keep).agg(
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
        F.max(v).alias("max"), F.max_by(dim, F.struct(F.col(v), -F.col(dim))).alias("argmax"))
    q = exact_quantiles(df, keep, v, {"median": 0.5, "p90": 0.9})
    return _join(base, q, keep, "left")


def ar1_over_dim(df: DataFrame, keep, dim: str, v: str = "v") -> DataFrame:
    """AR(1) coefficient along ``dim`` after removing each series' mean:
    ``sum(x_t x_{t-1}) / sum(x_t^2)``.  The lag is an equi-join on ``dim - 1``."""
    keep = _cols(keep)
    m = df.groupBy(*keep).agg(F.avg(v).alias("_m"))
    x = _join(df, m, keep).select(*keep, dim, (F.col(v) - F.col("_m")).alias("x"))
    prev = x.select(*keep, (F.col(dim) + 1).alias(dim), F.col("x").alias("_xp"))
    num = _join(x, prev, [*keep, dim]).groupBy(*keep).agg(F.sum(F.col("x") * F.col("_xp")).alias("_num"))
    den = x.groupBy(*keep).agg(F.sum(F.col("x") * F.col("x")).alias("_den"))
    return _join(den, num, keep, "left").select(*keep, F.try_divide("_num", "_den").alias("ar1"))


def threshold_values(df: DataFrame, v: str, below: float) -> DataFrame:
    """Values below ``below`` set to zero."""
    return df.withColumn(v, F.when(F.col(v) < below, F.lit(0.0)).otherwise(F.col(v)))


def apply_mask(df: DataFrame, mask: DataFrame, coords, v: str = "v", m: str = "m") -> DataFrame:
    """Keep values where the mask is non-zero, zero elsewhere (missing mask = zero)."""
    coords = _cols(coords)
    j = df.join(mask.select(*coords, F.col(m).alias("_m")), coords, "left")
    keep = F.coalesce(F.col("_m") != 0, F.lit(False))
    return j.select(*[F.when(keep, F.col(v)).otherwise(F.lit(0.0)).alias(v) if c == v else F.col(c)
                      for c in df.columns])


def image_maths(df: DataFrame, fn, other: DataFrame | None = None, coords=None, v: str = "v",
                other_v: str = "v") -> DataFrame:
    """Element-wise maths: ``fn(v)`` or ``fn(v, w)`` with a second image ``other``
    joined on the coordinates.  Chains are nested calls or one composed ``fn``."""
    if other is None:
        return df.withColumn(v, fn(F.col(v)))
    coords = _cols(coords)
    j = df.join(other.select(*coords, F.col(other_v).alias("_w")), coords)
    return j.select(*[fn(F.col(v), F.col("_w")).alias(v) if c == v else F.col(c) for c in df.columns])


def extract_roi(df: DataFrame, box: dict[str, tuple[int, int]]) -> DataFrame:
    """Box given by ``start`` and ``size`` per dimension; coordinates shifted to
    start at 0.  A plain range filter, so it reaches the scan."""
    out = df
    for d, (start, size) in box.items():
        out = out.where((F.col(d) >= start) & (F.col(d) < start + size)).withColumn(d, F.col(d) - start)
    return out


def mean_series(df: DataFrame, time: str, voxel, v: str = "v", mask: DataFrame | None = None) -> DataFrame:
    """Mean over all (or only masked) voxels at each time point."""
    voxel = _cols(voxel)
    src = df if mask is None else df.join(mask.select(*voxel), voxel, "left_semi")
    return src.groupBy(time).agg(F.avg(v).alias("mean"))


def merge_dim(df: DataFrame, image: str, dim: str, per_group: int, extent: int) -> DataFrame:
    """Concatenate every ``per_group`` consecutive images along ``dim``: image
    ``k`` becomes part ``k mod per_group`` of ``k div per_group``, shifted by
    ``extent`` per part."""
    return df.select(*[(F.floor(F.col(image) / per_group)).cast("bigint").alias(image) if c == image else
                       (F.col(dim) + (F.col(image) % per_group) * extent).alias(dim) if c == dim else F.col(c)
                       for c in df.columns])


def split_dim(df: DataFrame, image: str, dim: str, extent: int) -> DataFrame:
    """The inverse: cut ``dim`` into parts of ``extent``; each part is its own image."""
    return df.select(*[(F.col(dim) % extent).alias(dim) if c == dim else F.col(c) for c in df.columns],
                     F.floor(F.col(dim) / extent).cast("bigint").alias("part"))


def image_stats(df: DataFrame, image, v: str = "v") -> DataFrame:
    """Summary statistics per image: voxels, non-zero voxels, mean, std, min, max."""
    image = _cols(image)
    return df.groupBy(*image).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(v) != 0, 1)).alias("n_nonzero"),
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))


def _smoothed(df: DataFrame, keys: list[str], dim: str, v: str, *sigmas: float) -> DataFrame:
    r = max(math.ceil(3 * s) for s in sigmas)
    merged = {"sum": F.sum(F.col(v).cast("double")), "n": F.count(v)}
    out = sliding(df.select(*keys, dim, v), keys, dim, merged, r, r, gaussian(*sigmas), "_at long, _v double")
    return out.select(*keys, F.col("_at").cast(df.schema[dim].dataType).alias(dim), F.col("_v").alias(v))


def gaussian_smooth_1d(df: DataFrame, keys, dim: str, v: str = "v", sigma: float = 1.0) -> DataFrame:
    """Gaussian-weighted mean along ``dim`` (radius ``ceil(3 sigma)``), one row per coordinate;
    weights are renormalised where the neighbourhood runs off the edge, over a missing
    coordinate or over a NULL value (no value in reach: NULL).  Values at the same
    coordinate count each.  Each value is shuffled about once, see :mod:`blocks`."""
    return _smoothed(df, _cols(keys), dim, v, sigma)


def temporal_filter(df: DataFrame, keys, dim: str, v: str = "v", fine: float = 1.0,
                    coarse: float = 4.0) -> DataFrame:
    """Band-pass as the difference of a fine and a coarse Gaussian mean, both from one pass."""
    return _smoothed(df, _cols(keys), dim, v, fine, coarse)


def dilate_erode(df: DataFrame, keys, dim: str, v: str = "v", radius: int = 1) -> DataFrame:
    """Maximum (dilate) and minimum (erode) over ``dim +- radius``, one row per coordinate.
    Values are taken as DOUBLE; a NULL value counts nothing (none in reach: NULL)."""
    keys, y = _cols(keys), F.col(v).cast("double")
    merged = {"max": F.max(y), "min": F.min(y), "n": F.count(v)}
    out = sliding(df.select(*keys, dim, v), keys, dim, merged, radius, radius, extremes(radius), "_at long, _up double, _down double")
    return out.select(*keys, F.col("_at").cast(df.schema[dim].dataType).alias(dim), F.col("_up").alias("dilated"), F.col("_down").alias("eroded"))


def flag_outliers(df: DataFrame, keys, v: str = "v", k: float = 2.0) -> DataFrame:
    """Mark values more than ``k`` standard deviations from their series' mean
    (statistics by grouped aggregate joined back, not a per-series window)."""
    keys = _cols(keys)
    st = df.groupBy(*keys).agg(F.avg(v).alias("_m"), F.stddev_samp(v).alias("_s"))
    return _join(df, st, keys).select(
        *df.columns, (F.abs(F.col(v) - F.col("_m")) > F.lit(k) * F.col("_s")).alias("is_outlier"))


def regress_out(df: DataFrame, keys, v: str, x) -> DataFrame:
    """Remove design columns ``x`` (one name or several) from each series by least squares
    with an intercept: ``v`` becomes the residual, fitted per series.

    One column after another is taken out of ``v`` and of the columns still to come, so
    every step is one grouped aggregate and one join.  A column that the ones before it
    already determine changes nothing.  Rows with a NULL in ``v`` or ``x`` take no part in
    the fit and get NULL."""
    keys, xs = _cols(keys), _cols(x)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [v, *xs]])
    left = {c: f"_left_{i}" for i, c in enumerate([v, *xs])}
    given = {c: f"_given_{i}" for i, c in enumerate([v, *xs])}
    work = df.select("*", *[F.when(whole, F.col(c).cast("double")).alias(n) for names in (left, given) for c, n in names.items()])
    for j, c in enumerate(xs):
        by, targets = left[c], [left[v], *[left[t] for t in xs[j + 1:]]]
        spread = F.var_pop(by) > 1e-12 * F.var_pop(given[c])
        fit = work.groupBy(*keys).agg(
            F.avg(by).alias("_mean"),
            *[F.avg(t).alias(f"_a{t}") for t in targets],
            *[F.coalesce(F.when(spread, F.regr_slope(t, by)), F.lit(0.0)).alias(f"_b{t}") for t in targets])
        new = {t: F.col(t) - (F.col(f"_a{t}") + F.col(f"_b{t}") * (F.col(by) - F.col("_mean"))) for t in targets}
        work = _join(work, fit, keys).select(*[new[n].alias(n) if n in new else F.col(n) for n in work.columns])
    return work.select(*[F.col(left[v]).alias(v) if n == v else F.col(n) for n in df.columns])
