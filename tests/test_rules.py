"""Edge rules of requests, parameters, port reports, records and resolution."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lineark.functions import ids, paths, text
from lineark.operators import params, records, requests, resolve


def flatten_reference(d, found=()):
    """Plain-Python statement of the flattening rules, for comparison."""
    out = {}
    for k, v in d.items():
        if k in found:
            continue
        if isinstance(v, dict):
            for sk, sv in flatten_reference(v, found).items():
                out[f"{k}_{sk}"] = sv
        elif isinstance(v, list):
            i = 0
            for item in v:
                if isinstance(item, list):
                    continue
                if isinstance(item, dict):
                    for sk, sv in flatten_reference(item, found).items():
                        out[f"{k}_{sk}_{i}"] = sv
                elif isinstance(item, (int, float)) and not isinstance(item, str):
                    out[f"{k}_{i}"] = item
                i += 1
        else:
            out[k] = v
    return out


def test_validate_request_rules(spark):
    bodies = [("", "sparkjob"), ("not json", "sparkjob"), ('{"dataset_ids":["test"],"software_ids":"test2"}', "sparkjob"),
              ('{"datasetID":null,"scriptID":"s"}', "sparkjob"), ('{"datasetID":"d"}', "sparkjob"),
              ('{"datasetID":"d","scriptID":"s"}', "custom"), ('{"datasetID":["a"],"scriptID":"s","containerID":"c"}', "custom"),
              ('[1,2]', "sparkjob")]
    df = spark.createDataFrame(list(enumerate(b for b, _ in bodies)), "k long, raw string") \
        .join(spark.createDataFrame(list(enumerate(t for _, t in bodies)), "k long, jt string"), "k")
    out = {r.k: (r.rule, r.error) for r in requests.validate_requests(df, "raw", "jt").collect()}
    assert out[0][0] == "empty_body" and out[1][0] == "not_json"
    assert out[0][1] == out[1][1] == requests.MSG_NOT_JSON
    assert out[2] == ("no_datasetID", requests.MSG_NO_DATASET)
    assert out[3] == (None, None)            # present but null still counts as given
    assert out[4] == ("no_scriptID", requests.MSG_NO_SCRIPT)
    assert out[5] == ("no_containerID", requests.MSG_NO_CONTAINER)
    assert out[6] == (None, None)
    assert out[7][0] == "no_datasetID"


def test_request_defaults(spark):
    df = spark.createDataFrame([('{"datasetID":"a","scriptID":"s","executors":3,"qualifer":"q"}',)], "raw string")
    r = requests.request_defaults(requests.validate_requests(df)).first()
    assert r.dataset_ids == ["a"] and r.prefix == "breakfast/" and r.namespace == "99999"
    assert r.executors == "3" and r.executor_memory == "5g" and r.qualifer == "q" and r.parameters == "{}"


def test_flatten_params_rules(spark):
    docs = [
        {"x": 15, "flag": True, "none": None, "opt": {"y": 1, "z": "s", "deep": {"q": 2}},
         "vals": [1, None, [8, 9], {"w": 2, "v": [5, 6]}, "text", 2.5, False]},
        {"a": [[1], [2]], "b": {"c": {"d": {"e": [0, {"f": 1}]}}}},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id long, doc string")
    leaves = params.parameters_only(params.flatten_params(df, "id", "doc"))
    got = {}
    for r in leaves.collect():
        got.setdefault(r.id, {})[r.key] = json.loads(r.value) if r.vtype not in ("string", "null") else r.value
    for i, d in enumerate(docs):
        ref = {k: v for k, v in flatten_reference(d).items()
               if not (isinstance(v, str) and k.split("_")[0] in ("vals",) and k not in d)}
        assert got.get(i, {}) == ref
    # list in list: skipped and not counted; null: counted and dropped; bool kept as a number
    assert "vals_1" not in got[0] and got[0]["vals_w_2"] == 2 and got[0]["vals_v_0_2"] == 5
    assert got[0]["vals_4"] == 2.5 and got[0]["vals_5"] is False and got[0]["none"] is None


def test_flatten_params_found_keys(spark):
    df = spark.createDataFrame([(1, '{"x":1,"y":{"x":2,"z":3}}')], "id long, doc string")
    found = spark.createDataFrame([(1, "x")], "id long, key string")
    keys = {r.key for r in params.flatten_params(df, "id", "doc", found=found).collect()}
    assert keys == {"y_z"}


def test_split_params_files(spark):
    df = spark.createDataFrame([(1, '{"a":"/f1","b":"plain","l":["/f2","nofile",3]}')], "id long, doc string")
    objs = spark.createDataFrame([("/f1",), ("/f2",)], "path string")
    out = {(r.key, r.kind) for r in params.split_params_files(params.flatten_params(df, "id", "doc"), objs).collect()}
    assert out == {("a", "input_file"), ("b", "parameter"), ("l_0", "input_file"), ("l_2", "parameter")}


def test_parse_port_report_rules(spark):
    report = "\n".join(["out = /x.nii", "out = /y.nii", "empty = ", "lst = ['/a', '/nope']",
                        "none = ['/nope']", "u = <undefined>", "a = b = c", "no equals", "n = 3"])
    df = spark.createDataFrame([(1, report)], "k long, t string")
    objs = spark.createDataFrame([("/a",)], "path string")
    got = sorted((r.port, r.seq, r.value) for r in params.parse_port_report(df, "k", "t", objs).collect())
    assert got == [("lst", 0, "/a"), ("n", 0, "3"), ("none", 0, "Not A File"), ("out", 0, "/y.nii")]


def test_path_functions(spark):
    df = spark.createDataFrame([("minio/b/k/f.tar.gz",), ("plain",), ("s3a://bk/key/x",), ("dir/",)], "u string")
    r = df.select(paths.url_location("u").alias("loc"), paths.bucket_key("u").alias("bk"),
                  paths.file_name("u").alias("n"), paths.file_format("u").alias("f")).collect()
    assert [x.loc for x in r] == ["b/k/f.tar.gz", "", "/bk/key/x", ""]
    assert (r[2].bk.bucket, r[2].bk.key) == ("bk", "key/x")
    assert (r[0].bk.bucket, r[0].bk.key) == ("minio", "b/k/f.tar.gz")
    assert [x.n for x in r] == ["f.tar.gz", "plain", "x", ""]
    assert [x.f for x in r] == ["gz", "plain", "x", ""]


def test_id_lists_and_minting(spark):
    df = spark.createDataFrame([("[a,b,,c,]",)], "t string")
    r = df.select(ids.split_id_list("t").alias("l")).first()
    assert r.l == ["a", "b", "c"]
    j = spark.createDataFrame([(["a", "b"],)], "l array<string>").select(ids.join_id_list("l").alias("s")).first()
    assert j.s == "a,b,"
    m = spark.createDataFrame([("x",), ("x",), ("y",)], "k string").select(ids.mint_id("T", "k").alias("m")).collect()
    assert m[0].m == m[1].m != m[2].m and m[0].m.startswith("ark:99999/")


def test_time_text_round_trip(spark):
    df = spark.createDataFrame([("2024-01-01 13:05:09",), ("2024-01-01 00:30:00",)], "s string") \
        .select(F.to_timestamp_ntz("s").alias("ts"))
    r = df.select(text.to_record_time("ts").alias("t")).select("t", text.from_record_time("t").alias("b")).collect()
    assert r[0].t == "Monday, January 01, 2024 01:05:09"
    assert str(r[0].b) == "2024-01-01 01:05:09"      # no AM/PM: read as AM
    assert str(r[1].b) == "2024-01-01 00:30:00"


def test_resolution_outcomes(spark):
    docs = spark.createDataFrame([
        ("d1", '{"distribution":[{"@id":"p0"},{"@type":"DataDownload","contentUrl":"minio/b/one.csv"}]}'),
        ("d2", '{"distribution":{"@id":"p2"}}'),
        ("d3", '{"distribution":[]}'),
        ("d4", '{"distribution":{"@type":"DataDownload"}}'),
        ("d5", '{"distribution":{"@id":"missing"}}')], "dataset_id string, doc string")
    ptr = spark.createDataFrame([("p2", "b/two.csv"), ("p0", "b/zero.csv")], "dist_id string, name string")
    items = spark.createDataFrame([("j", i, d) for i, d in enumerate(["d1", "d2", "d3", "d4", "d5", "nope"])],
                                  "job_id string, pos long, dataset_id string")
    r = {x.dataset_id: (x.location, x.status) for x in resolve.resolve_distribution(items, docs, ptr).collect()}
    assert r["d1"] == ("b/one.csv", "ok") and r["d2"] == ("b/two.csv", "ok")
    for d in ("d3", "d4", "d5"):
        assert r[d] == (None, resolve.MSG_NO_DIST)
    assert r["nope"] == (None, resolve.MSG_NO_ID)
    first = {x.dataset_id: x.location for x in resolve.resolve_distribution(items, docs, ptr, mode="first").collect()}
    assert first["d1"] is None and first["d2"] is None
    allf = resolve.resolve_all_or_fail(items, docs, ptr).first()
    assert not allf.resolved and allf.error == "d3 " + resolve.MSG_NO_DIST


def test_upsert_keeps_supports_without_outputs(spark):
    base = spark.createDataFrame([("j1", "Running", None, ["old"]), ("j2", "Running", None, ["keep"])],
                                 "job_id string, status string, logs string, supports array<string>") \
        .withColumn("end_ts", F.lit(None).cast("timestamp_ntz"))
    upd = spark.createDataFrame([("j1", "Succeeded", "ok", ["new"]), ("j2", "Failed", "", []), ("j3", "Succeeded", "", ["x"])],
                                "job_id string, status string, logs string, supports array<string>") \
        .withColumn("end_ts", F.lit(None).cast("timestamp_ntz"))
    out = {r.job_id: r for r in records.upsert_record(base, upd).collect()}
    assert out["j1"].supports == ["new"] and out["j1"].status == "Succeeded"
    assert out["j2"].supports == ["keep"] and out["j2"].status == "Failed"
    assert out["j3"].supports == ["x"]


def test_id_map_merge_and_lookup(spark):
    known = spark.createDataFrame([("/a", "k1"), ("/b", "k2")], "path string, id string")
    new = spark.createDataFrame([("/b", "n2"), ("/c", "n3")], "path string, id string")
    m = dict((r.path, r.id) for r in records.id_map_merge(known, new).collect())
    assert m == {"/a": "k1", "/b": "n2", "/c": "n3"}
    keys = spark.createDataFrame([(1, "I1"), (2, "I2"), (3, "I2")], "node long, interface string")
    cat = spark.createDataFrame([("I1", "sw1")], "interface string, id string")
    out, new_rows = records.lookup_or_insert(keys, cat)
    assert new_rows.count() == 1
    got = {r.node: (r.id, r.is_new) for r in out.collect()}
    assert got[1] == ("sw1", False) and got[2] == got[3] and got[2][1]


def test_config_merge_and_sweep(spark):
    nodes = spark.createDataFrame([("n1", "w"), ("n2", "w")], "node string, workflow string")
    ns = spark.createDataFrame([("n1", "a", "node")], "node string, key string, value string")
    ws = spark.createDataFrame([("w", "a", "wf"), ("w", "b", "wf")], "workflow string, key string, value string")
    got = {(r.node, r.key): r.value for r in params.config_merge(nodes, ns, ws, {"a": "g", "c": "g"}).collect()}
    assert got == {("n1", "a"): "node", ("n1", "b"): "wf", ("n1", "c"): "g",
                   ("n2", "a"): "wf", ("n2", "b"): "wf", ("n2", "c"): "g"}
    vals = spark.createDataFrame([("n", "p", 1, "1"), ("n", "p", 2, "2"), ("n", "q", 1, "x"), ("n", "q", 2, "y"),
                                  ("n", "q", 3, "z")], "node string, param string, pos int, value string")
    sw = params.param_sweep(vals)
    inst = {r.instance for r in sw.collect()}
    assert len(inst) == 6 and "p=1,q=z" in inst and sw.count() == 12


def test_failure_stage_and_log_default(spark):
    df = spark.createDataFrame([(1, False, "m1", "m2", "pod"), (2, True, "m1", "m2", "pod"), (3, False, "m1", "m2", "pod")],
                               "n_stages int, job_ready boolean, init_message string, init_message_2 string, pod_message string")
    out = [(r.failed_stage, r.message) for r in requests.failure_stage(df).orderBy("n_stages").collect()]
    assert out == [("Download", "m1"), ("WriteOutputs", "pod"), ("JobRunner", "m2")]
    logs = spark.createDataFrame([("Failed", ""), ("Failed", "x"), ("Succeeded", "")], "s string, l string")
    assert [r.o for r in logs.select(text.log_default("s", "l").alias("o")).collect()] == \
        ["Command Unrecognized.", "x", ""]


def test_sink_result_refuses_existing_folder(spark, tmp_path):
    from lineark.sources import files
    df = spark.createDataFrame([(1,)], "a int")
    out = str(tmp_path / "o")
    files.sink_result(df, out, fmt="parquet")
    with pytest.raises(Exception):
        files.sink_result(df, out, fmt="parquet")
    assert os.path.isdir(out)


def test_grouped_map_forms_agree(spark):
    import pandas as pd
    from lineark.operators import udf

    def double(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": pdf["k"], "v2": pdf["v"] * 2})

    df = spark.createDataFrame([(i, float(i)) for i in range(50)], "k long, v double")
    a = sorted(tuple(r) for r in udf.grouped_map(df, ["k"], double, "k long, v2 double").collect())
    b = sorted(tuple(r) for r in udf.grouped_map(df, ["k"], double, "k long, v2 double",
                                                 single_row_groups=True).collect())
    assert a == b == [(i, 2.0 * i) for i in range(50)]


def test_upsert_table_rewrites_only_touched_partitions(spark, tmp_path):
    from lineark.operators.records import upsert_table, write_records
    path = str(tmp_path / "comp")
    base = spark.createDataFrame(
        [("j1", "custom", "Running", None, []), ("j2", "nipype", "Running", None, ["s"]),
         ("j3", "nipype", "Running", None, [])],
        "job_id string, job_type string, status string, logs string, supports array<string>") \
        .withColumn("end_ts", F.lit(None).cast("timestamp_ntz"))
    write_records(base, path, ["job_type"])
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "comp").iterdir() if p.is_dir()}
    upd = spark.createDataFrame([("j2", "nipype", "Succeeded", "ok", ["o1"]), ("j9", "nipype", "Failed", "", [])],
                                "job_id string, job_type string, status string, logs string, supports array<string>") \
        .withColumn("end_ts", F.lit(None).cast("timestamp_ntz"))
    upsert_table(spark, path, upd)
    got = {r.job_id: (r.job_type, r.status, r.supports) for r in spark.read.parquet(path).collect()}
    assert got == {"j1": ("custom", "Running", []), "j2": ("nipype", "Succeeded", ["o1"]),
                   "j3": ("nipype", "Running", []), "j9": ("nipype", "Failed", [])}
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "comp").iterdir() if p.is_dir()}
    assert after["job_type=custom"] == before["job_type=custom"]     # untouched partition kept


def test_mint_id_separator_cannot_collide(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "|c"), ("a", "b|c")], "x string, y string")
    m = [r.m for r in df.select(ids.mint_id("K", "x", "y").alias("m")).collect()]
    assert len({m[0], m[1], m[2]}) == 3 and m[1] == m[3]


def test_duplicate_keys_resolve_deterministically(spark):
    keys = spark.createDataFrame([(1, "I1")], "node long, interface string")
    cat = spark.createDataFrame([("I1", "b"), ("I1", "a")], "interface string, id string")
    out, new_rows = records.lookup_or_insert(keys, cat)
    assert [r.id for r in out.collect()] == ["a"] and new_rows.count() == 0
    nodes = spark.createDataFrame([("n", "w")], "node string, workflow string")
    ns = spark.createDataFrame([("n", "k", "1"), ("n", "k", "2")], "node string, key string, value string")
    ws = spark.createDataFrame([], "workflow string, key string, value string")
    got = [(r.key, r.value) for r in params.config_merge(nodes, ns, ws, {}).collect()]
    assert got == [("k", "2")]


def test_template_is_filled_in_one_pass(spark):
    df = spark.createDataFrame([("{a}/{b}/{none}/{", {"a": "{b}", "b": "x{a}"}), ("plain", {"a": "1"}), ("{a}", {}), (None, {"a": "1"}), ("{a}{a}", {"a": ""})],
                               "t string, p map<string,string>")
    got = [r[0] for r in df.select(params.fill_template("t", "p")).collect()]
    assert got == ["{b}/x{a}/{none}/{", "plain", "{a}", None, ""]


def test_sweep_with_many_combinations(spark):
    rows = [("big", f"p{k}", i, f"v{i}") for k in range(5) for i in range(14)] + [("one", "q", 0, "z")]
    df = spark.createDataFrame(rows, "node string, param string, pos int, value string")
    out = params.param_sweep(df)
    got = {r.node: (r.n, r.k) for r in out.groupBy("node").agg(F.count("*").alias("n"), F.approx_count_distinct("instance", 0.01).alias("k")).collect()}
    assert got["big"][0] == 5 * 14**5 and abs(got["big"][1] / 14**5 - 1) < 0.05 and got["one"] == (1, 1)
    assert out.where("node = 'one'").first().instance == "q=z"
    # more combinations than an INT holds are still numbered
    many = spark.createDataFrame([("m", f"p{k:02d}", i, str(i)) for k in range(33) for i in range(2)], "node string, param string, pos int, value string")
    assert params.param_sweep(many.where("param < 'p16'")).count() == 16 * 2**16


def test_documents_of_four_kinds_read_back(spark):
    import json
    outs = spark.createDataFrame([("ark:1/j", "a/b.csv"), ("ark:1/j", None)], "job_id string, path string")
    minted = records.mint_outputs(outs, "store:9000", "/results/")
    m = minted.where("error IS NULL").first()
    part = (m.download_id, "/results/a/b.csv", "csv", "store:9000/results/a/b.csv")
    d = records.read_documents(records.dataset_json(minted)).collect()
    assert [(x.id, x.type, x.name, x.generated_by, [tuple(p) for p in x.distribution]) for x in d] == [
        (m.dataset_id, "Dataset", "b.csv", "ark:1/j", [(part[0], part[1], part[2], part[3])])]
    w = records.read_documents(records.download_json(minted)).first()
    assert (w.id, w.type, w.name, w.distribution) == (m.download_id, "Download", "/results/a/b.csv", None)
    soft = spark.createDataFrame([("s1", "n", "i", ["x"]), ("s2", "n", "i", ["x", "y, z"]), ("s3", "n", "i", []), ("s4", "n", None, None)],
                                 "id string, name string, interface string, cites array<string>")
    docs = records.software_json(soft, citation="cites")
    raw = {r.id: json.loads(r.doc).get("citation") for r in docs.collect()}
    assert raw == {"s1": "x", "s2": ["x", "y, z"], "s3": None, "s4": None}
    back = {r.id: (r.type, r.interface, r.citation) for r in records.read_documents(docs).collect()}
    assert back == {"s1": ("SoftwareSourceCode", "i", ["x"]), "s2": ("SoftwareSourceCode", "i", ["x", "y, z"]),
                    "s3": ("SoftwareSourceCode", "i", None), "s4": ("SoftwareSourceCode", None, None)}
    jobs = spark.createDataFrame([("j1", None, "Running"), ("j2", None, "Failed")], "job_id string, start_ts timestamp_ntz, status string")
    used = spark.createDataFrame([("j1", "usedDataset", 2, "d2"), ("j1", "usedDataset", 1, "d1"), ("j1", "usedSoftware", 1, "s"),
                                  ("j1", "usedSoftware", 2, "c"), ("j2", "usedSoftware", 1, "s")], "job_id string, role string, pos long, ref_id string")
    runs = {r.status: (r.used, r.software) for r in records.read_documents(records.job_json(jobs, used)).collect()}
    assert runs == {"Running": (["d1", "d2"], ["s", "c"]), "Failed": ([], ["s"])}


def test_open_fields_and_bad_documents(spark):
    docs = spark.createDataFrame([("a", '{"name":"n","x":1,"y":[1,2],"z":null}'), ("b", "not json"), ("c", "[1]"), ("d", None), ("e", "{}")], "id string, doc string")
    got = sorted((r.id, r.field, r.value) for r in records.open_fields(docs, ["name"]).collect())
    assert got == [("a", "x", "1"), ("a", "y", "[1,2]"), ("a", "z", "null")]
    flat = {r.name for r in records.read_documents(docs).collect()}
    assert flat == {"n", None}
