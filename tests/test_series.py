"""tc3, lag alignment, the skew-safe index and the first zero of the ACF against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lineark.operators import series


def tc3_numpy(y, tau):
    n = len(y)
    if n <= 2 * tau:
        return None
    a, b, c = y[:n - 2 * tau], y[tau:n - tau], y[2 * tau:]
    num = np.mean(a * b * c)
    denom = abs(np.mean(a * b)) ** 1.5
    return num / denom, num, denom


def first_zero_numpy(y):
    n = len(y)
    d = y - y.mean()
    for lag in range(1, n):
        if np.sum(d[:n - lag] * d[lag:]) <= 0:
            return lag
    return n


@pytest.fixture(scope="module")
def long_series(spark):
    rng = np.random.default_rng(7)
    rows, data = [], {}
    sizes = {"big": 900, "mid": 40, "tiny": 6, "one": 1}
    for sid, n in sizes.items():
        y = np.round(rng.normal(5, 2, n), 2)
        data[sid] = y
        for i, v in enumerate(y):
            rows.append((sid, 1000 - i * 3, i, float(v)))   # ts decreases: order by -ts
    df = spark.createDataFrame(rows, "sid string, neg_ts long, eid long, y double")
    return df.withColumn("ts", -F.col("neg_ts")), data


def test_series_index_dense_under_skew(spark, long_series):
    df, data = long_series
    ix = series.with_series_index(df, "sid", ["ts", "eid"], partitions=7)
    got = {r.sid: (r.c, r.lo, r.hi, r.d) for r in ix.groupBy("sid").agg(
        F.count("*").alias("c"), F.min("idx").alias("lo"), F.max("idx").alias("hi"),
        F.countDistinct("idx").alias("d")).collect()}
    for sid, y in data.items():
        assert got[sid] == (len(y), 0, len(y) - 1, len(y))
    # positions follow the declared order
    first = ix.where("sid = 'big' AND idx = 0").first()
    assert first.eid == 0


def test_tc3_matches_numpy(long_series):
    df, data = long_series
    out = {r.sid: r for r in series.tc3(df, "sid", "y", ["ts", "eid"], 3).collect()}
    for sid, y in data.items():
        ref = tc3_numpy(y, 3)
        r = out[sid]
        if ref is None:
            assert r.raw is None and r.n_triples == 0
        else:
            assert r.raw == pytest.approx(ref[0], rel=1e-9)
            assert r.num == pytest.approx(ref[1], rel=1e-9)
            assert r.denom == pytest.approx(ref[2], rel=1e-9)
            assert r.abs == pytest.approx(abs(ref[0]), rel=1e-9)


def test_lag_triples_aligned(long_series):
    df, data = long_series
    t = series.lag_triples(df, "sid", "y", ["ts", "eid"], 4).where("sid = 'mid'").orderBy("i").collect()
    y = data["mid"]
    assert len(t) == len(y) - 8
    for r in t:
        assert (r.y0, r.y1, r.y2) == (y[r.i], y[r.i + 4], y[r.i + 8])


def test_tc3_array_equals_long_form(spark):
    rng = np.random.default_rng(3)
    vecs = [(i, [float(x) for x in rng.normal(0, 1, 30)]) for i in range(5)] + [(99, [1.0, 2.0])]
    df = spark.createDataFrame(vecs, "id long, e array<double>")
    arr = {r.id: r for r in series.tc3_array(df, "id", "e", 4).collect()}
    for i, e in vecs:
        ref = tc3_numpy(np.array(e), 4)
        if ref is None:
            assert arr[i].raw is None
        else:
            assert arr[i].raw == pytest.approx(ref[0], rel=1e-9)
    plan = series.tc3_array(df, "id", "e", 4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_first_zero_lag_exact_beyond_block(spark):
    # a slow oscillation: the first zero is far past one block of lags
    n = 200
    y = np.round(np.sin(np.arange(n) / 15.0) * 10 + 20, 2)
    rows = [("s", i, i, float(v)) for i, v in enumerate(y)]
    rows += [("up", i, i, float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "sid string, ts long, eid long, y double")
    got = {r.sid: r.tau for r in series.first_zero_lag(df, "sid", "y", ["ts", "eid"], max_lag=4).collect()}
    assert got["s"] == first_zero_numpy(y)
    assert got["s"] > 4
    assert got["up"] == first_zero_numpy(np.arange(12, dtype=float))


def test_flatten_features_vectors(spark):
    df = spark.createDataFrame([(1, (0.5, [1.0, 2.0])), (2, (0.25, [3.0]))],
                               "id long, out struct<raw:double, q:array<double>>")
    flat = series.flatten_features(df, "out", "CO_x_")
    assert flat.columns == ["id", "CO_x__raw", "CO_x__q_1", "CO_x__q_2"]
    assert flat.orderBy("id").collect()[1]["CO_x__q_2"] is None


def test_status_changes(spark):
    rows = [(1, i, i, p) for i, p in enumerate(["Pending", "Pending", "Running", "Running", "Succeeded"])]
    df = spark.createDataFrame(rows, "job long, eid long, ts long, phase string") \
        .withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz"))
    out = series.status_changes(df, "job", "phase", ["ts", "eid"], "ts").orderBy("ts").collect()
    assert [r.phase for r in out] == ["Pending", "Running", "Succeeded"]
    assert [r.micros_in_phase for r in out] == [2_000_000, 2_000_000, None]


def test_status_changes_with_null_phase_and_plain_key_names(spark):
    rows = [(1, i, p) for i, p in enumerate([None, "Running", None, None, "Running"])]
    for key in ("i", "j", "r", "c"):
        df = spark.createDataFrame(rows, f"{key} long, ts long, phase string").withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz"))
        out = series.status_changes(df, key, "phase", ["ts"], "ts").orderBy("ts").collect()
        assert [r.phase for r in out] == [None, "Running", None, "Running"]
        assert series.tc3(df.withColumn("y", F.lit(1.0)), key, "y", ["ts"], 1).first().n_triples == 3


def test_null_series_key_is_kept(spark):
    rows = [(None, i, float(i % 5)) for i in range(30)] + [("a", i, float(i % 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "sid string, ts long, y double")
    ix = series.with_series_index(df, "sid", ["ts"])
    assert ix.count() == 60
    assert ix.where("sid IS NULL").agg(F.max("idx")).first()[0] == 29
    out = {r.sid: r.n_triples for r in series.tc3(df, "sid", "y", ["ts"], 2).collect()}
    assert out == {None: 26, "a": 26}
    taus = {r.sid: r.tau for r in series.first_zero_lag(df, "sid", "y", ["ts"]).collect()}
    assert set(taus) == {None, "a"}


def test_hot_series_spreads_over_partitions(spark):
    # one series holds 90% of the rows; no task may end up with most of it
    rows = [("hot", i, float(i % 7)) for i in range(9000)] + [(f"s{i % 100}", i, 1.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "sid string, ts long, y double")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")      # tiny data would otherwise be merged into one partition
    try:
        ix = series.with_series_index(df, "sid", ["ts"], partitions=8)
        sizes = ix.where("sid = 'hot'").rdd.glom().map(len).collect()
        hot = ix.where("sid = 'hot'").agg(F.min("idx"), F.max("idx"), F.countDistinct("idx")).first()
    finally:
        spark.conf.set(key, old)
    assert sum(sizes) == 9000 and max(sizes) < 9000 / 2
    assert tuple(hot) == (0, 8999, 9000)


def triples_by_hand(y, tau):
    """(n, num) over complete triples."""
    t = [(a, b, c) for a, b, c in zip(y, y[tau:], y[2 * tau:]) if None not in (a, b, c)]
    return len(t), (sum(a * b * c for a, b, c in t) / len(t) if t else None)


def test_nulls_count_alike_in_all_forms(spark):
    cases = {"a": [None, 1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0], "b": [1.0, None, 3.0], "c": [None] * 6, "d": [2.0] * 2, "e": [1.0, 2.0, 3.0, 4.0, None]}
    rows = [(k, i, v) for k, y in cases.items() for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "sid string, ts long, y double")
    arrays = spark.createDataFrame(list(cases.items()), "sid string, e array<double>")
    long = {r.sid: (r.n_triples, r.num) for r in series.tc3(df, "sid", "y", ["ts"], 1).collect()}
    flat = {r.sid: (r.n_triples, r.num) for r in series.tc3_array(arrays, "sid", "e", 1).collect()}
    want = {k: triples_by_hand(y, 1) for k, y in cases.items()}
    assert long == flat == want
    lags = series.lag_triples(df, "sid", "y", ["ts"], 1).groupBy("sid").count().collect()
    assert {r.sid: r["count"] for r in lags} == {k: n for k, (n, _) in want.items() if n}
    # first zero: centred on the values that are there
    gap = [None if i % 7 == 3 else math.sin(i / 3.0) + 5 for i in range(60)]
    fz = spark.createDataFrame([("g", i, v) for i, v in enumerate(gap)], "sid string, ts long, y double")
    there = [v for v in gap if v is not None]
    d = [None if v is None else v - sum(there) / len(there) for v in gap]
    first = next(k for k in range(1, 60) if sum(a * b for a, b in zip(d, d[k:]) if a is not None and b is not None) <= 0)
    assert series.first_zero_lag(fz, "sid", "y", ["ts"], max_lag=4).first().tau == first


@pytest.mark.parametrize("tau,parts", [(1, 1), (1, 40), (3, 7), (5, 64), (20, 16)])
def test_tc3_carries_over_partition_borders(spark, tau, parts):
    r = np.random.RandomState(tau + parts)
    cases = {"hot": 900, "x": 41, "y": 2 * tau, "z": 2 * tau + 1, None: 33, **{f"s{i}": int(r.randint(1, 9)) for i in range(30)}}
    rows = []
    for k, n in cases.items():
        rows += [(k, i, None if r.rand() < 0.1 else float(r.randint(-9, 9))) for i in range(n)]
    df = spark.createDataFrame(rows, "sid string, ts long, y double").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {x.sid: (x.n_triples, x.num) for x in series.tc3(df, "sid", "y", ["ts"], tau).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for k in cases:
        n, num = triples_by_hand([v for s, _, v in rows if s == k], tau)
        assert got[k][0] == n and (got[k][1] == num if num is None else got[k][1] == pytest.approx(num, abs=1e-9)), k
    assert len(got) == len(cases)


def test_tc3_shuffles_rows_once(spark):
    df = spark.range(100).selectExpr("id % 3 as sid", "id as ts", "cast(id as double) as y")
    plan = series.tc3(df, "sid", "y", ["ts"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "Generate" not in plan and "Join" not in plan


def test_offsets_are_the_build_side(spark):
    df = spark.range(100).selectExpr("id % 3 as sid", "id as ts")
    plan = series.with_series_index(df, "sid", ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildRight" in plan and "BroadcastHashJoin" not in plan
