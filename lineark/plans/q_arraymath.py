"""Array-maths queries on ``embeddings`` as a long table ``(vec_id, i, v)``:
each vector is an image (or a voxel's series) and ``i`` its coordinate."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineark.operators import arraymath as am
from lineark.plans.fixtures import table
from lineark.plans.registry import query

D = 6
_VOX = """WITH vox AS (
  SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings)"""


def voxels(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.posexplode("embedding").alias("i", "v")).select(
        "vec_id", F.col("i").cast("bigint").alias("i"), F.col("v").cast("double").alias("v"))


def _r(c, d=D):
    return (F.round(F.col(c), d) + F.lit(0.0)).alias(c)


def _sr(expr, name, d=D):
    return f"round({expr}, {d}) + 0.0 AS {name}"


@query("reduce_over_dim", oracle=_VOX + f""",
s AS (SELECT vec_id, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS mn, max(v) AS mx,
             quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.9) AS p90 FROM vox GROUP BY vec_id)
SELECT s.vec_id, {_sr('mean', 'mean')}, {_sr('std', 'std')}, {_sr('mn', 'min')}, {_sr('mx', 'max')},
       {_sr('median', 'median')}, {_sr('p90', 'p90')},
       (SELECT min(i) FROM vox x WHERE x.vec_id = s.vec_id AND x.v = s.mx) AS argmax
FROM s""")
def q_reduce_over_dim(spark, sf_dir):
    """Mean, std, min, max, median, 90th percentile and argmax along each vector."""
    out = am.reduce_over_dim(voxels(spark, sf_dir), "vec_id", "i")
    return out.select("vec_id", *[_r(c) for c in ("mean", "std", "min", "max", "median", "p90")], "argmax")


@query("ar1_over_dim", oracle=_VOX + f""",
x AS (SELECT vec_id, i, v - avg(v) OVER (PARTITION BY vec_id) AS x FROM vox),
num AS (SELECT a.vec_id, sum(a.x * b.x) AS nm FROM x a JOIN x b ON b.vec_id = a.vec_id AND b.i = a.i - 1 GROUP BY a.vec_id),
den AS (SELECT vec_id, sum(x * x) AS dn FROM x GROUP BY vec_id)
SELECT den.vec_id, {_sr('nm / NULLIF(dn, 0)', 'ar1')} FROM den LEFT JOIN num ON num.vec_id = den.vec_id""")
def q_ar1_over_dim(spark, sf_dir):
    """AR(1) coefficient of every vector after removing its mean."""
    return am.ar1_over_dim(voxels(spark, sf_dir), "vec_id", "i").select("vec_id", _r("ar1"))


@query("threshold_values", oracle=_VOX + f"""
SELECT vec_id, i, {_sr('CASE WHEN v < 0.0 THEN 0.0 ELSE v END', 'v')} FROM vox""")
def q_threshold_values(spark, sf_dir):
    """Values below zero set to zero."""
    return am.threshold_values(voxels(spark, sf_dir), "v", 0.0).select("vec_id", "i", _r("v"))


def _mask(vox):
    return vox.groupBy("i").agg((F.avg("v") > 0).cast("int").alias("m"))


@query("apply_mask", oracle=_VOX + f""",
mask AS (SELECT i, CAST(avg(v) > 0 AS INTEGER) AS m FROM vox GROUP BY i)
SELECT vox.vec_id, vox.i, {_sr('CASE WHEN mask.m <> 0 THEN vox.v ELSE 0.0 END', 'v')}
FROM vox LEFT JOIN mask ON mask.i = vox.i""")
def q_apply_mask(spark, sf_dir):
    """Values kept where the mask (coordinates with a positive mean over all vectors) is set."""
    vox = voxels(spark, sf_dir)
    return am.apply_mask(vox, _mask(vox), "i").select("vec_id", "i", _r("v"))


@query("unary_binary_maths", oracle=_VOX + f""",
mean_img AS (SELECT i, avg(v) AS w FROM vox GROUP BY i)
SELECT vox.vec_id, vox.i, {_sr('abs(vox.v * 2 - mean_img.w)', 'v')} FROM vox JOIN mean_img ON mean_img.i = vox.i""")
def q_unary_binary_maths(spark, sf_dir):
    """``abs(2 * v - mean image)``: a chain of a number operation, an image operation and a unary one."""
    vox = voxels(spark, sf_dir)
    mean_img = vox.groupBy("i").agg(F.avg("v").alias("v"))
    twice = am.image_maths(vox, lambda v: v * 2)
    diff = am.image_maths(twice, lambda v, w: v - w, mean_img, "i")
    return am.image_maths(diff, F.abs).select("vec_id", "i", _r("v"))


@query("extract_roi", oracle=_VOX + f"""
SELECT vec_id, i - 8 AS i, {_sr('v', 'v')} FROM vox WHERE i >= 8 AND i < 24""")
def q_extract_roi(spark, sf_dir):
    """The box ``i`` in [8, 24) of every vector, re-based to start at 0."""
    return am.extract_roi(voxels(spark, sf_dir), {"i": (8, 16)}).select("vec_id", "i", _r("v"))


@query("mean_series", oracle=_VOX + f"""
SELECT i, {_sr('avg(v)', 'mean')} FROM vox WHERE vec_id IN (SELECT vec_id FROM embeddings WHERE label = 1)
GROUP BY i""")
def q_mean_series(spark, sf_dir):
    """Mean over the masked vectors (label 1) at each coordinate."""
    mask = table(spark, sf_dir, "embeddings").where(F.col("label") == 1).select("vec_id")
    return am.mean_series(voxels(spark, sf_dir), "i", "vec_id", mask=mask).select("i", _r("mean"))


@query("merge_split_dim", oracle=_VOX + f"""
SELECT vec_id // 2 AS vec_id, i + (vec_id % 2) * (SELECT max(i) + 1 FROM vox) AS i, {_sr('v', 'v')} FROM vox""")
def q_merge_split_dim(spark, sf_dir):
    """Consecutive vector pairs concatenated along ``i`` (the split is the inverse)."""
    vox = voxels(spark, sf_dir)
    extent = vox.agg(F.max("i") + 1).scalar()
    return am.merge_dim(vox, "vec_id", "i", 2, extent).select("vec_id", "i", _r("v"))


@query("image_stats", oracle=_VOX + f"""
SELECT vec_id, count(*) AS n, count(*) FILTER (WHERE v <> 0) AS n_nonzero, {_sr('avg(v)', 'mean')},
       {_sr('stddev_samp(v)', 'std')}, {_sr('min(v)', 'min')}, {_sr('max(v)', 'max')} FROM vox GROUP BY vec_id""")
def q_image_stats(spark, sf_dir):
    """Summary statistics of every vector."""
    s = am.image_stats(voxels(spark, sf_dir), "vec_id")
    return s.select("vec_id", "n", "n_nonzero", *[_r(c) for c in ("mean", "std", "min", "max")])


def _smooth_sql(sigma: float, name: str) -> str:
    import math
    r = int(math.ceil(3 * sigma))
    return f"""{name} AS (
  SELECT a.vec_id, a.i, sum(exp(-((b.i - a.i) * (b.i - a.i)) / {2.0 * sigma * sigma}) * b.v) /
                        sum(exp(-((b.i - a.i) * (b.i - a.i)) / {2.0 * sigma * sigma})) AS v
  FROM vox a JOIN vox b ON b.vec_id = a.vec_id AND b.i BETWEEN a.i - {r} AND a.i + {r}
  GROUP BY a.vec_id, a.i)"""


@query("gaussian_smooth_1d", oracle=_VOX + ",\n" + _smooth_sql(1.5, "sm") + f"""
SELECT vec_id, i, {_sr('v', 'v')} FROM sm""")
def q_gaussian_smooth_1d(spark, sf_dir):
    """Gaussian smoothing (sigma 1.5) along every vector."""
    return am.gaussian_smooth_1d(voxels(spark, sf_dir), "vec_id", "i", "v", 1.5).select("vec_id", "i", _r("v"))


@query("temporal_filter", oracle=_VOX + ",\n" + _smooth_sql(1.0, "fa") + ",\n" + _smooth_sql(4.0, "co") + f"""
SELECT fa.vec_id, fa.i, {_sr('fa.v - co.v', 'v')} FROM fa JOIN co ON co.vec_id = fa.vec_id AND co.i = fa.i""")
def q_temporal_filter(spark, sf_dir):
    """Band-pass along every vector: fine (sigma 1) minus coarse (sigma 4) Gaussian mean."""
    return am.temporal_filter(voxels(spark, sf_dir), "vec_id", "i", "v", 1.0, 4.0).select("vec_id", "i", _r("v"))


@query("flag_outliers", oracle=_VOX + f""",
st AS (SELECT vec_id, avg(v) AS m, stddev_samp(v) AS s FROM vox GROUP BY vec_id)
SELECT vox.vec_id, vox.i, {_sr('vox.v', 'v')}, abs(vox.v - st.m) > 2.0 * st.s AS is_outlier
FROM vox JOIN st ON st.vec_id = vox.vec_id""")
def q_flag_outliers(spark, sf_dir):
    """Values more than two standard deviations from their vector's mean."""
    return am.flag_outliers(voxels(spark, sf_dir), "vec_id", "v", 2.0).select("vec_id", "i", _r("v"), "is_outlier")


@query("dilate_erode", oracle=_VOX + f"""
SELECT a.vec_id, a.i, {_sr('max(b.v)', 'dilated')}, {_sr('min(b.v)', 'eroded')}
FROM vox a JOIN vox b ON b.vec_id = a.vec_id AND b.i BETWEEN a.i - 2 AND a.i + 2 GROUP BY a.vec_id, a.i""")
def q_dilate_erode(spark, sf_dir):
    """Maximum and minimum over a window of +-2 along every vector."""
    out = am.dilate_erode(voxels(spark, sf_dir), "vec_id", "i", "v", 2)
    return out.select("vec_id", "i", _r("dilated"), _r("eroded"))


@query("regress_out", oracle=_VOX + f""",
fit AS (SELECT vec_id, regr_slope(v, i) AS b, regr_intercept(v, i) AS a FROM vox GROUP BY vec_id)
SELECT vox.vec_id, vox.i, {_sr('vox.v - (fit.a + fit.b * vox.i)', 'v')} FROM vox JOIN fit ON fit.vec_id = vox.vec_id""")
def q_regress_out(spark, sf_dir):
    """Linear trend along ``i`` removed from every vector by least squares."""
    return am.regress_out(voxels(spark, sf_dir), "vec_id", "v", "i").select("vec_id", "i", _r("v"))
