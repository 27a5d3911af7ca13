"""Blocked neighbourhoods against plain loops: gaps, repeats, NULLs, block and batch borders."""

import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lineark.operators import arraymath as am
from lineark.operators import blocks, series


def _rows(seed):
    r = random.Random(seed)
    rows = [("hot", i, float(r.randint(-50, 50))) for i in range(-150, 700)]
    rows += [(None, i, r.choice([None, 1.0, -2.5])) for i in range(40) if r.random() < 0.6]
    rows += [("gap", i * 9, float(i)) for i in range(20)] + [("twice", 3, 1.0), ("twice", 3, 5.0), ("twice", 4, None)]
    rows += [("none", i, None) for i in range(3)] + [(f"s{i}", i % 3, float(i)) for i in range(60)]
    r.shuffle(rows)
    return rows


def _mean(rows, key, at, sigma):
    r = math.ceil(3 * sigma)
    near = [(math.exp(-(i - at) ** 2 / (2 * sigma * sigma)), v) for k, i, v in rows if k == key and abs(i - at) <= r and v is not None]
    return sum(w * v for w, v in near) / sum(w for w, _ in near) if near else None


@pytest.fixture(params=[(16, 50), (64, 7), (4096, 20_000)])
def small_blocks(request, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", request.param[0])
    monkeypatch.setattr(blocks, "FILL", request.param[1])


@pytest.fixture()
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "13")
    yield
    spark.conf.set(key, old)


def test_smoothing_and_neighbourhoods_match_loops(spark, small_blocks, small_batches):
    rows = _rows(3)
    df = spark.createDataFrame(rows, "k string, i int, v double").repartition(4)
    places = {(k, i) for k, i, _ in rows}
    got = am.gaussian_smooth_1d(df, "k", "i", "v", 1.5).collect()
    assert len(got) == len(places) == len({(r.k, r.i) for r in got})
    for r in got:
        want = _mean(rows, r.k, r.i, 1.5)
        assert r.v is None if want is None else r.v == pytest.approx(want, abs=1e-9)
    band = {(r.k, r.i): r.v for r in am.temporal_filter(df, ["k"], "i", "v", 1.0, 2.0).collect()}
    assert set(band) == places
    for (k, i), v in band.items():
        a, b = _mean(rows, k, i, 1.0), _mean(rows, k, i, 2.0)
        assert v is None if a is None else v == pytest.approx(a - b, abs=1e-9)
    for radius in (0, 1, 5):
        near = {(r.k, r.i): (r.dilated, r.eroded) for r in am.dilate_erode(df, "k", "i", "v", radius).collect()}
        assert set(near) == places
        for (k, i), pair in near.items():
            vs = [v for x, j, v in rows if x == k and abs(i - j) <= radius and v is not None]
            assert pair == ((max(vs), min(vs)) if vs else (None, None))


def test_nan_and_empty(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, float("nan")), ("a", 2, None), ("b", 0, float("nan"))], "k string, i long, v double")
    got = {(r.k, r.i): (r.dilated, r.eroded) for r in am.dilate_erode(df, "k", "i").collect()}
    assert math.isnan(got["a", 0][0]) and got["a", 0][1] == 1.0
    assert math.isnan(got["a", 2][0]) and math.isnan(got["a", 2][1]) and math.isnan(got["b", 0][1])
    assert am.gaussian_smooth_1d(df.limit(0), "k", "i").count() == 0
    lost = spark.createDataFrame([("a", None, 1.0), ("a", 5, 2.0)], "k string, i long, v double")
    assert [(r.i, r.dilated) for r in am.dilate_erode(lost, "k", "i").collect()] == [(5, 2.0)]


def test_rows_are_shuffled_once(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as i", "cast(id as double) as v")
    for out in (am.temporal_filter(df, "k", "i"), am.dilate_erode(df, "k", "i", "v", 2)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan


def _first_zero(y):
    there = [v for v in y if v is not None]
    d = [None if v is None else len(there) * v - sum(there) for v in y]
    for lag in range(1, len(y)):
        pairs = [a * b for a, b in zip(d, d[lag:]) if a is not None and b is not None]
        if pairs and sum(pairs) <= 0:
            return lag
    return len(y)


@pytest.mark.parametrize("kind", ["decimal(12,2)", "long", "double"])
def test_first_zero_lag_matches_loops(spark, small_blocks, small_batches, kind):
    from decimal import Decimal
    r = random.Random(5)
    cases = {"slow": [round(100 * math.sin(i / 40)) for i in range(500)], "noise": [r.randint(-9, 9) for _ in range(300)],
             "up": list(range(30)), "flat": [4] * 12, "one": [7], "gap": [None if i % 5 == 2 else round(50 * math.cos(i / 9)) for i in range(120)],
             "none": [None] * 4, None: [round(1000 * math.cos(i / 100)) for i in range(400)]}
    to = {"decimal(12,2)": lambda v: Decimal(v).scaleb(-2), "long": int, "double": float}[kind]
    rows = [(k, i, None if v is None else to(v)) for k, y in cases.items() for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, f"sid string, ts long, y {kind}").repartition(3)
    got = {x.sid: x.tau for x in series.first_zero_lag(df, "sid", "y", ["ts"], max_lag=4).collect()}
    assert got == {k: _first_zero(y) for k, y in cases.items()}


def test_first_zero_lag_of_large_numbers(spark):
    from decimal import Decimal
    y = [10 ** 12 + (1 if i % 4 < 2 else -1) for i in range(40)]
    df = spark.createDataFrame([("s", i, Decimal(v)) for i, v in enumerate(y)], "sid string, ts long, y decimal(20,0)")
    assert series.first_zero_lag(df, "sid", "y", ["ts"]).first().tau == _first_zero(y)


def test_lag_triples_match_loops(spark, small_blocks, small_batches):
    r = random.Random(8)
    cases = {"a": [r.choice([None, *range(9)]) for _ in range(230)], None: list(range(25)), "b": [1, 2], "c": [None] * 9}
    rows = [(k, i, v) for k, y in cases.items() for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "sid string, ts long, y int").repartition(3)
    got = sorted((x.sid or "", x.i, x.y0, x.y1, x.y2) for x in series.lag_triples(df, "sid", "y", ["ts"], 3).collect())
    want = sorted((k or "", i, y[i], y[i + 3], y[i + 6]) for k, y in cases.items() for i in range(len(y) - 6)
                  if None not in (y[i], y[i + 3], y[i + 6]))
    assert got == want


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_status_changes_over_partition_borders(spark, small_batches, parts):
    r = random.Random(parts)
    rows = [("hot", i, "Running" if 30 < i < 330 else r.choice(["Pending", "Running", None])) for i in range(400)]
    rows += [("still", i, "Pending") for i in range(200)] + [("nulls", i, None) for i in range(50)]
    rows += [(k, i, r.choice("ab")) for k in [None, *(f"s{j}" for j in range(20))] for i in range(r.randint(1, 6))]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "job string, ts long, phase string").withColumn("at", F.timestamp_seconds("ts").cast("timestamp_ntz"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        out = series.status_changes(df, "job", "phase", ["ts"], "at").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    got = {(x.job, int((x["at"] - datetime(1970, 1, 1)).total_seconds())): (x.phase, x.prev_phase, x.micros_in_phase) for x in out}
    want = {}
    for k in {k for k, _, _ in rows}:
        feed = sorted(((i, p) for j, i, p in rows if j == k), key=lambda x: x[0])
        hits = [n for n in range(len(feed)) if n == 0 or feed[n][1] != feed[n - 1][1]]
        for n, nxt in zip(hits, [*hits[1:], None]):
            want[k, feed[n][0]] = (feed[n][1], feed[n - 1][1] if n else None, None if nxt is None else (feed[nxt][0] - feed[n][0]) * 1_000_000)
    assert got == want and len(out) == len(want)


def test_quantiles_by_counts(spark):
    import numpy as np
    r = np.random.RandomState(4)
    cases = {"wide": r.randn(301) * 10.0 ** r.randint(-200, 200, 301), "ties": r.randint(-2, 3, 500) / 2, "one": [3.5], "two": [-1.0, 4.0],
             None: r.rand(64), "near": 1 + np.arange(90) * 2.0 ** -52, "zero": [0.0, -0.0, -5e-324, 5e-324], "inf": [float("-inf"), 1.0, 2.0]}
    rows = [(k, float(v)) for k, vs in cases.items() for v in vs] + [("one", None), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    out = am.exact_quantiles(df, "k", "v", {"a": 0.0, "median": 0.5, "p90": 0.9, "z": 1.0})
    got = {x.k: (x.a, x.median, x.p90, x.z) for x in out.collect()}
    assert set(got) == set(cases)
    for k, vs in cases.items():
        if k == "inf":
            assert got[k][0] == float("-inf") and got[k][1] == 1.0 and got[k][3] == 2.0
        else:
            assert got[k] == pytest.approx(tuple(np.percentile(vs, [0, 50, 90, 100])), rel=1e-12, abs=0), k
    nan = spark.createDataFrame([("n", 1.0), ("n", float("nan")), ("n", -float("nan"))], "k string, v double")
    x = am.exact_quantiles(nan, "k", "v", {"lo": 0.0, "hi": 1.0}).first()
    assert x.lo == 1.0 and math.isnan(x.hi)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_quantiles_shuffle_counts_only(spark):
    df = spark.range(0, 200_000, 1, 4).selectExpr("id % 2 as k", "cast(id % 1000 as double) as v")
    assert [tuple(x) for x in am.exact_quantiles(df, "k", "v", {"m": 0.5}).orderBy("k").collect()] == [(0, 499.0), (1, 500.0)]
