"""Repeated rows, NULL keys and values, deep nesting, cycles: answers stay one per key and whole."""
import json
import re

import pytest
from pyspark.sql import functions as F

from lineark.functions.ids import mint_id
from lineark.operators import arraymath, graph, params, records, requests, resolve


def test_one_answer_per_id_with_repeated_documents(spark):
    doc = json.dumps({"distribution": [{"@id": "d1"}]})
    docs = spark.createDataFrame([("a", doc), ("a", doc), ("b", json.dumps({"distribution": {"@type": "DataDownload", "contentUrl": "h/x/y"}}))],
                                 "dataset_id string, doc string")
    pointers = spark.createDataFrame([("d1", "p"), ("d1", "p")], "dist_id string, name string")
    items = spark.createDataFrame([("j", 1, "a"), ("j", 2, "b")], "job_id string, pos int, dataset_id string")
    got = resolve.resolve_all_or_fail(items, docs, pointers).first()
    assert got.n_ids == 2 and got.resolved
    where = {r.dataset_id: r.location for r in resolve.resolve_distribution(items, docs, pointers).collect()}
    assert where == {"a": "p", "b": "x/y"}
    images = spark.createDataFrame([("c", '{"image":"i"}')] * 2, "container_id string, doc string")
    assert resolve.image_lookup(spark.createDataFrame([("c",)], "container_id string"), images).count() == 1


def test_unknown_and_null_ids_beside_documents_without_entry(spark):
    docs = spark.createDataFrame([("a", json.dumps({"distribution": []})), ("b", json.dumps({"distribution": [{"@id": "d"}]})), ("b", "{}"),
                                  ("c", json.dumps({"distribution": [{"@id": "e"}]})), (None, "{}")], "dataset_id string, doc string")
    pointers = spark.createDataFrame([("d", "p"), (None, "q")], "dist_id string, name string")
    items = spark.createDataFrame([("j", 3, "a"), ("j", 2, "x"), ("j", 1, "b"), ("k", 1, "b"), ("l", 1, None), ("m", 1, None), ("m", 2, "c"),
                                   (None, 1, "b")], "job_id string, pos int, dataset_id string")
    r = resolve.resolve_distribution(items, docs, pointers)
    assert r.columns == ["dataset_id", "job_id", "pos", "location", "status", "ok"]
    assert {x.dataset_id: (x.location, x.status) for x in r.collect()} == {
        "a": (None, resolve.MSG_NO_DIST), "b": ("p", "ok"), "c": (None, resolve.MSG_NO_DIST), "x": (None, resolve.MSG_NO_ID), None: (None, None)}
    got = {x.job_id: (x.resolved, x.error, x.n_ids) for x in resolve.resolve_all_or_fail(items, docs, pointers).collect()}
    assert got == {"j": (False, f"x {resolve.MSG_NO_ID}", 3), "k": (True, None, 1), "l": (None, None, 1),
                   "m": (False, f"c {resolve.MSG_NO_DIST}", 2), None: (True, None, 1)}


def test_each_asked_id_is_resolved_once_and_locations_keep_their_order(spark):
    url = lambda n: json.dumps({"distribution": {"@type": "DataDownload", "contentUrl": f"minio/b/{n}"}})
    docs = spark.createDataFrame([(n, url(n)) for n in "abc"], "dataset_id string, doc string")
    pointers = spark.createDataFrame([], "dist_id string, name string")
    items = spark.createDataFrame([("j", p, "ba"[p % 2]) for p in range(12)] + [("k", 2, "c"), ("k", 1, "x"), ("l", 1, "a")], "job_id string, pos int, dataset_id string")
    r = resolve.resolve_distribution(items, docs, pointers)
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[(dataset_id|id)#\d+\], \[(dataset_id|id)#\d+( AS id#\d+)?\]", plan)     # the distinct IDs that are asked for
    got = {x.job_id: x.locations for x in resolve.resolve_all_or_fail(items, docs, pointers).collect()}
    assert got == {"j": ["b/" + "ba"[p % 2] for p in range(12)], "k": None, "l": ["b/a"]}


def test_repeated_jobs_and_records(spark):
    asked = spark.createDataFrame([("x",), ("y",)], "job_id string")
    jobs = spark.createDataFrame([("x", "Succeeded"), ("x", "Running")], "job_id string, phase string")
    assert {r.job_id: r.active for r in requests.active_filter(asked, jobs).collect()} == {"x": True, "y": False}
    stored = spark.createDataFrame([("x", "ok"), ("x", None)], "job_id string, status string")
    assert {r.job_id: r.status for r in requests.job_status(asked, stored).collect()} == {"x": "ok", "y": None}


def test_newest_of_several_updates(spark):
    kind = "job_id string, status string, logs string, end_ts int, supports array<string>"
    base = spark.createDataFrame([("x", "Running", None, None, None)], kind)
    got = records.upsert_record(base, spark.createDataFrame([("x", "Failed", "l", 1, ["a"]), ("x", "Succeeded", "m", 2, ["b"])], kind)).collect()
    assert [(r.status, r.logs, r.supports) for r in got] == [("Succeeded", "m", ["b"])]


def test_null_values_and_null_groups(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([None, 1.0, 2.0, 3.0])] + [(None, i, float(i)) for i in range(4)], "g string, t int, v double")
    red = {r.g: r.median for r in arraymath.reduce_over_dim(df, "g", "t").collect()}
    assert red == {"a": 2.0, None: 1.5}
    assert arraymath.flag_outliers(df, "g").count() == 8
    assert arraymath.regress_out(df, "g", "v", "t").count() == 8
    assert {r.g for r in arraymath.ar1_over_dim(df, "g", "t").collect()} == {"a", None}
    assert arraymath.gaussian_smooth_1d(df, "g", "t").count() == 8
    assert arraymath.dilate_erode(df, "g", "t").count() == 8


def test_minted_ids_tell_null_from_empty(spark):
    ids = spark.createDataFrame([(None,), ("",), ("\\0",)], "k string").select(mint_id("Dataset", "k").alias("i"))
    assert ids.distinct().count() == 3


def test_nested_parameters(spark):
    doc = 1
    for i in range(6):
        doc = {f"k{i}": doc}
    out = params.flatten_params(spark.createDataFrame([("n", json.dumps(doc))], "owner string, doc string"), "owner", "doc").collect()
    assert [r.key.count("_") for r in out] == [5] and out[0].value == "1"


def test_deep_containment_and_cycles(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(5)], "parent string, node string")
    paths = graph.all_leaf_nodes(chain).collect()
    assert [r.path.count(".") for r in paths] == [5]
    ring = spark.createDataFrame([("a", "b"), ("b", "a")], "parent string, node string")
    with pytest.raises(ValueError, match="cycle"):
        graph.hierarchy_paths(ring)


def test_unknown_edge_function_fails(spark):
    df = spark.createDataFrame([("/a/b.txt", "basename"), ("x", None)], "v string, fn string")
    assert [r.value_in for r in params.edge_function(df, "v", "fn").collect()] == ["b.txt", "x"]
    with pytest.raises(Exception, match="unknown edge function"):
        params.edge_function(df.withColumn("fn", F.lit("nope")), "v", "fn").collect()


def test_regress_out_of_several_columns(spark):
    """Residuals equal numpy's least squares; a dependent column and rows with NULL change nothing."""
    import numpy as np
    rng = np.random.default_rng(3)
    rows = [(g, i, float(rng.normal()), float(i), float(i * i), 2.0 * i + 1) for g in ("a", None) for i in range(12)]
    rows.append(("a", 12, None, 1.0, 1.0, 3.0))
    df = spark.createDataFrame(rows, "g string, i int, v double, x double, y double, z double")
    got = {(r.g, r.i): r.v for r in arraymath.regress_out(df, "g", "v", ["x", "y", "z"]).collect()}
    assert len(got) == 25 and got["a", 12] is None
    for g in ("a", None):
        own = [r for r in rows if r[0] == g and r[2] is not None]
        design = np.array([[1, r[3], r[4]] for r in own])
        want = np.array([r[2] for r in own])
        want = want - design @ np.linalg.lstsq(design, want, rcond=None)[0]
        assert np.allclose([got[g, r[1]] for r in own], want, atol=1e-8)
