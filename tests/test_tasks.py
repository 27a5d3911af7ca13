"""Tasks keep their size when the input grows; loops move only what changes."""

from lineark import session
from lineark.operators import graph


def test_bounds_of_a_task(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = [spark.conf.get(k, None) for k in keys]
    try:
        for text, want in (("128m", session.SPLIT_BYTES), ("1g", session.SPLIT_BYTES), ("4MB", 4 << 20), ("1000", 1000), ("134217728b", session.SPLIT_BYTES)):
            spark.conf.set(keys[0], text)
            spark.conf.set(keys[1], "64m")
            spark.conf.unset(keys[2])
            session.bound_tasks(spark)
            assert session._bytes(spark.conf.get(keys[0])) == want
            assert session._bytes(spark.conf.get(keys[1])) == session.PARTITION_BYTES
            assert int(spark.conf.get(keys[2])) >= session.PARTITIONS
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_join_on_stored_edges_shuffles_the_other_side_only(spark):
    import contextlib
    import io
    edges = spark.range(5000).selectExpr("id AS node", "id * 7 % 5000 AS next")
    front = spark.range(0, 5000, 3).selectExpr("id AS root", "id * 3 % 5000 AS node")
    with graph._stored_edges(edges, "node") as adj:
        joined = front.join(adj.hint("merge"), "node")
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            joined.explain()
        assert text.getvalue().count("Exchange hashpartitioning") == 1, text.getvalue()
        assert joined.count() == 1667


def test_distances_of_more_pairs_than_ends(spark):
    """A hub with many pairs through it, asked for densely and sparsely: the same distances."""
    n = 12
    edges = [(i, 100) for i in range(n)] + [(100, 200 + i) for i in range(n)] + [(200, 300), (300, 0)]
    df = spark.createDataFrame(edges, "src long, dst long")
    dense = [(i, 200 + j) for i in range(n) for j in range(n)] + [(i, j) for i in range(n) for j in range(n)] + [(200, 201)]
    sparse = [(i, 200 + i) for i in range(n)]
    want = lambda a, b: 0 if a == b else 2 if a < 100 <= b else 4 if (a, b) == (200, 201) else 4 if b == 0 else None
    for pairs in (dense, sparse):
        got = {(x.root, x.node): x.dist for x in graph.distances(df, spark.createDataFrame(pairs, "root long, node long")).collect()}
        assert got == {p: want(*p) for p in pairs}, got


def test_components_behind_each_other_take_no_turn_each(spark):
    """Cycles in a row are settled together: the number of jobs does not grow with their number."""
    def jobs(n):
        rings = [x for i in range(n) for x in ((10 * i, 10 * i + 1), (10 * i + 1, 10 * i), (10 * i + 1, 10 * i + 5), (10 * i + 5, 10 * i + 10))]
        group = f"rings {n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            got = {r.node: r.component for r in graph.cycle_components(spark.createDataFrame(rings + [(0, 0), (3, 3), (-5, -4)], "src long, dst long")).collect()}
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert got == {10 * i + j: 10 * i for i in range(n) for j in (0, 1)} | {3: 3}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    # only the rounds in which the smallest node spreads get more
    assert jobs(6) < 2 * jobs(2)
