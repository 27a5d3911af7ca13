"""Run provenance: own file inputs, runs kept apart, known paths replace, one ID per file."""

from lineark.operators import graph, records

STORE = {"store_url": "objects:9000", "root": "/results/"}


def _provenance(spark):
    nodes = spark.createDataFrame([(r, n, "tool." + n) for r in ("r1", "r2") for n in "ab"], "run string, node string, interface string")
    edges = spark.createDataFrame([("a", "out", "b", "in")], "src string, src_port string, dst string, dst_port string")
    reports = spark.createDataFrame([("r1", "a", "out", 0, "/w/new0"), ("r1", "a", "out", 1, "/w/known"), ("r1", "a", "out", 2, "/w/new2"),
                                     ("r2", "a", "out", 0, "/w/new0"), ("r2", "a", "out", 1, "/w/new1"), ("r2", "b", "val", 0, "Not A File")],
                                    "run string, node string, port string, seq int, value string")
    inputs = spark.createDataFrame([("r1", "a", "/d/x"), ("r1", "a", "/d/absent"), ("r2", "b", "/d/x")], "run string, node string, input string")
    known = spark.createDataFrame([("/w/known", "ark:1/k"), ("/d/x", "ark:1/x"), ("/d/x", "ark:1/x")], "path string, id string")
    catalogue = spark.createDataFrame([("tool.a", "ark:1/tool")], "interface string, id string")
    return graph.run_provenance(nodes, edges, reports, inputs, known, catalogue)


def test_inputs_known_paths_and_runs(spark):
    out = _provenance(spark)
    of = {(r.run, r.node): r.record_id for r in out["records"].collect()}
    assert len(set(of.values())) == 4
    made = {(r.record_id, r.file_path): r.id for r in out["generated"].collect()}
    assert made[of["r1", "a"], "/w/known"] == "ark:1/k"
    assert made[of["r1", "a"], "/w/new0"] != made[of["r2", "a"], "/w/new0"]
    used = {(r.record_id, r.id, r.source) for r in out["used"].collect()}
    assert used == {
        (of["r1", "a"], "ark:1/x", "location"), (of["r2", "b"], "ark:1/x", "location"),
        # in r1 the known path replaces /w/new0, and /w/new2 is appended; r2 has no known path
        (of["r1", "b"], "ark:1/k", "output"), (of["r1", "b"], made[of["r1", "a"], "/w/new2"], "output"),
        (of["r2", "b"], made[of["r2", "a"], "/w/new0"], "output"), (of["r2", "b"], made[of["r2", "a"], "/w/new1"], "output")}
    assert out["new_software"].count() == 1


def test_reports_and_inputs_are_met_once(spark):
    out = _provenance(spark)
    for name in ("used", "generated"):      # they read the stored outputs and inputs, not the reports again
        assert "value#" not in out[name]._jdf.queryExecution().optimizedPlan().toString(), name


def test_every_operator_names_a_file_alike(spark):
    files = spark.createDataFrame([("j", "/w/a"), ("j", "/w/b"), (None, "/w/a")], "job_id string, path string")
    none = spark.createDataFrame([], "path string, id string")
    minted = {(r.job_id, r.path): r.dataset_id for r in records.mint_outputs(files, **STORE).collect()}
    plain = {(r.job_id, r.path): r.id for r in records.known_path_outputs(files, none, "job_id").collect()}
    assert minted == plain and len(set(minted.values())) == 3
    known = spark.createDataFrame([], "job_id string, path string, id string")
    listed = records.supports_list(files, known, known, "job_id")
    assert {r.id for r in listed.collect()} == set(minted.values())


def test_mint_outputs_flags_rows_without_path(spark):
    files = spark.createDataFrame([("j", "x/a.csv"), ("j", ""), ("k", "x/b.csv")], "job_id string, path string")
    minted = records.mint_outputs(files, **STORE)
    rows = {r.path: r for r in minted.collect()}
    assert rows["x/a.csv"].generated_by == "j" and rows["x/a.csv"].content_url == "objects:9000/results/x/a.csv"
    assert rows[""].dataset_id is None and rows[""].generated_by is None and rows[""].error
    assert {r.job_id: r.all_minted for r in records.all_minted(minted).collect()} == {"j": False, "k": True}


def test_list_objects_without_match(spark, tmp_path):
    from lineark.sources import files
    (tmp_path / "a[1].txt").write_text("x")
    assert files.list_objects(spark, str(tmp_path), prefix="absent").count() == 0
    assert files.list_objects(spark, str(tmp_path), prefix="a[1]").count() == 1


def test_supports_in_one_pass(spark):
    """Outputs, known IDs and inputs meet in one shuffle; rows with a NULL job or ID equal nothing."""
    rows = lambda data, cols: spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols.split()))
    files = rows([("a", "p"), ("a", "p"), ("a", "q"), (None, "p")], "job_id path")
    known = rows([("a", "p", "P"), ("a", "x", "X"), ("a", "x", "X"), ("a", "i", "I"), ("b", "y", "Y"), (None, "p", "P"), ("b", "z", None)], "job_id path id")
    inputs = rows([("a", "I"), ("b", "P"), (None, "P"), ("b", None)], "job_id id")
    listed = records.supports_list(files, known, inputs)
    got = sorted(((r.job_id, r.id, r.kind) for r in listed.collect()), key=str)
    new = lambda job, path: spark.createDataFrame([(job, path)], "j string, p string").select(records.file_id("j", "p").alias("id")).first().id
    assert got == sorted([("a", "P", "output"), ("a", new("a", "q"), "output"), (None, new(None, "p"), "output"), ("a", "X", "other"), ("b", "Y", "other"),
                          (None, "P", "other"), ("b", None, "other")], key=str)
    left = records.outputs_minus_inputs(known, inputs, rows([("a", "X"), (None, "P")], "job_id id"))
    assert sorted(((r.job_id, r.id) for r in left.collect()), key=str) == sorted([("a", "P"), ("b", "Y"), (None, "P"), ("b", None)], key=str)
    for df, most in ((listed, 3), (left, 1)):
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("Exchange hashpartitioning") <= most, plan
