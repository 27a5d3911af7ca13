"""Series queries: tc3 and friends over ``events`` (per user) and ``embeddings`` (per row)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineark.operators import series
from lineark.plans.fixtures import table
from lineark.plans.registry import query

TAU_USER = 5      # a user series has 45-99 points at every scale
TAU_ARRAY = 10    # embeddings are 64 long
DIGITS = 6


def user_series(spark, sf_dir):
    """``events`` as one series per user, ordered by ``(ts, event_id)``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("series_id"), "ts", "event_id", F.col("value").alias("y"))


_S = """s AS (
  SELECT user_id AS series_id, value AS y,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx
  FROM events)"""


def _tc3_sql(prefix: str, tau_b: str, tau_c: str, join_z: str = "", tau_col: str = "",
             final_join: str = "") -> str:
    return f"""{prefix},
t AS (
  SELECT a.series_id, a.y * b.y * c.y AS p3, a.y * b.y AS p2
  FROM s a {join_z}
  JOIN s b ON b.series_id = a.series_id AND b.idx = a.idx + {tau_b}
  JOIN s c ON c.series_id = a.series_id AND c.idx = a.idx + {tau_c}),
g AS (SELECT series_id, COUNT(*) AS n, SUM(p3) AS s3, SUM(p2) AS s2 FROM t GROUP BY series_id),
f AS (
  SELECT k.series_id, COALESCE(g.n, 0) AS n_triples,
         CAST(g.s3 AS DOUBLE) / g.n AS num,
         pow(abs(CAST(g.s2 AS DOUBLE) / g.n), 1.5) AS denom
  FROM (SELECT DISTINCT series_id FROM s) k LEFT JOIN g ON g.series_id = k.series_id)
SELECT f.series_id, {tau_col} f.n_triples,
       round(num / NULLIF(denom, 0), {DIGITS}) + 0.0 AS raw,
       round(abs(num / NULLIF(denom, 0)), {DIGITS}) AS abs,
       round(num, {DIGITS - 4}) + 0.0 AS num, round(abs(num), {DIGITS - 4}) AS absnum,
       round(denom, {DIGITS - 4}) AS denom
FROM f {final_join}"""


@query("tc3", oracle=_tc3_sql(f"WITH {_S}", str(TAU_USER), str(2 * TAU_USER)))
def q_tc3(spark, sf_dir):
    """tc3 at tau=5 for every user series of ``events`` (skew-safe long form)."""
    return series.tc3(user_series(spark, sf_dir), "series_id", "y", ["ts", "event_id"],
                      TAU_USER, digits=DIGITS)


@query("lag_triples", oracle=f"""WITH {_S}
SELECT a.series_id, a.idx AS i, a.y AS y0, b.y AS y1, c.y AS y2
FROM s a
JOIN s b ON b.series_id = a.series_id AND b.idx = a.idx + {TAU_USER}
JOIN s c ON c.series_id = a.series_id AND c.idx = a.idx + {2 * TAU_USER}""")
def q_lag_triples(spark, sf_dir):
    """Aligned (y_i, y_i+5, y_i+10) for every user series."""
    return series.lag_triples(user_series(spark, sf_dir), "series_id", "y", ["ts", "event_id"],
                              TAU_USER).select("series_id", "i", "y0", "y1", "y2")


@query("tc3_array", oracle=f"""WITH e AS (
  SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS y,
         unnest(generate_series(0, len(embedding) - 1)) AS i
  FROM embeddings),
g AS (
  SELECT a.vec_id, COUNT(*) AS n, SUM(a.y * b.y * c.y) AS s3, SUM(a.y * b.y) AS s2
  FROM e a JOIN e b ON b.vec_id = a.vec_id AND b.i = a.i + {TAU_ARRAY}
           JOIN e c ON c.vec_id = a.vec_id AND c.i = a.i + {2 * TAU_ARRAY}
  GROUP BY a.vec_id),
f AS (
  SELECT v.vec_id, CAST(COALESCE(g.n, 0) AS INTEGER) AS n_triples, g.s3 / g.n AS num,
         pow(abs(g.s2 / g.n), 1.5) AS denom
  FROM embeddings v LEFT JOIN g ON g.vec_id = v.vec_id)
SELECT vec_id, n_triples, round(num / NULLIF(denom, 0), {DIGITS}) + 0.0 AS raw,
       round(abs(num / NULLIF(denom, 0)), {DIGITS}) AS abs, round(num, {DIGITS}) + 0.0 AS num,
       round(abs(num), {DIGITS}) AS absnum, round(denom, {DIGITS}) AS denom
FROM f""")
def q_tc3_array(spark, sf_dir):
    """tc3 at tau=10 on each embedding vector, computed in place (no shuffle)."""
    return series.tc3_array(table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                            TAU_ARRAY, digits=DIGITS)


_FZ = f"""WITH {_S},
st AS (SELECT series_id, COUNT(*) AS n, SUM(y) AS sy FROM s GROUP BY series_id),
d AS (SELECT s.series_id, s.idx, st.n, st.n * s.y - st.sy AS d FROM s JOIN st USING (series_id)),
ac AS (
  SELECT a.series_id, b.idx - a.idx AS lag, SUM(a.d * b.d) AS c
  FROM d a JOIN d b ON b.series_id = a.series_id AND b.idx > a.idx
  GROUP BY a.series_id, b.idx - a.idx),
z AS (
  SELECT st.series_id, CAST(COALESCE(MIN(ac.lag) FILTER (WHERE ac.c <= 0), MAX(st.n)) AS BIGINT) AS tau
  FROM st LEFT JOIN ac ON ac.series_id = st.series_id
  GROUP BY st.series_id)"""


@query("first_zero_lag", oracle=f"{_FZ}\nSELECT series_id, tau FROM z")
def q_first_zero_lag(spark, sf_dir):
    """First lag with autocorrelation <= 0 for each user series (exact, no lag cap)."""
    return series.first_zero_lag(user_series(spark, sf_dir), "series_id", "y",
                                 ["ts", "event_id"], max_lag=8)


@query("tc3_auto", oracle=_tc3_sql(_FZ, "z.tau", "2 * z.tau",
                                   join_z="JOIN z ON z.series_id = a.series_id",
                                   tau_col="z.tau,",
                                   final_join="JOIN z ON z.series_id = f.series_id"))
def q_tc3_auto(spark, sf_dir):
    """tc3 with each user series' own tau from the first zero of its ACF."""
    return series.tc3_auto(user_series(spark, sf_dir), "series_id", "y", ["ts", "event_id"],
                           max_lag=8, digits=DIGITS)
