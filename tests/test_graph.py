"""Graph properties against brute force on small hand-made graphs."""

import itertools
import random

from lineark.operators import graph


def brute_reach(edges, nodes):
    out = {}
    for r in nodes:
        dist, frontier, d = {}, {r}, 0
        while frontier:
            d += 1
            nxt = {b for a, b in edges if a in frontier} - set(dist) - {r}
            for n in nxt:
                dist[n] = d
            frontier = nxt
        out[r] = dist
    return out


def test_levels_increase_along_edges(spark):
    random.seed(1)
    edges = {(a, b) for a, b in itertools.combinations(range(40), 2) if random.random() < 0.1}
    df = spark.createDataFrame(sorted(edges), "src long, dst long")
    lv = {r.node: r.level for r in graph.topo_levels(df).collect()}
    assert all(lv[b] > lv[a] for a, b in edges)
    # longest path: every non-root has a parent exactly one level lower
    for b in {b for _, b in edges}:
        assert max(lv[a] for a, x in edges if x == b) == lv[b] - 1
    assert graph.acyclic_check(df).count() == 0


def test_cycle_detection_matches_brute_force(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (6, 7), (7, 4), (8, 9)]
    df = spark.createDataFrame(edges, "src long, dst long")
    left = {r.node for r in graph.acyclic_check(df).collect()}
    reach = brute_reach(edges, {n for e in edges for n in e})
    on_cycle = {n for n, d in reach.items() if n in d or any(n in reach[m] and m in reach[n] for m in d)}
    behind = {m for n in on_cycle for m in reach[n]}
    assert left == on_cycle | behind == {1, 2, 3, 4, 5}


def test_closure_is_shortest_and_closed(spark):
    random.seed(5)
    edges = sorted({(random.randrange(30), random.randrange(30)) for _ in range(70)})
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame(edges, "src long, dst long")
    nodes = {n for e in edges for n in e}
    got = {}
    for r in graph.downstream_impact(df).collect():
        got.setdefault(r.root, {})[r.node] = r.dist
    want = brute_reach(edges, nodes)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    back = {}
    for r in graph.evidence_graph(df).collect():
        back.setdefault(r.root, {})[r.node] = r.dist
    for root, d in want.items():
        for n, dist in d.items():
            assert back[n][root] == dist


def test_flatten_hierarchy_nested(spark):
    cont = spark.createDataFrame([("top", "mid"), ("mid", "leaf"), ("mid", "other"), ("top", "x")],
                                 "parent string, node string")
    edges = spark.createDataFrame([("top", "mid.leaf.out", "sink", "in"), ("x", "o", "top", "mid.other.in")],
                                  "src string, src_port string, dst string, dst_port string")
    got = sorted(tuple(r) for r in graph.flatten_hierarchy(cont, edges).collect())
    assert got == [("top.mid.leaf", "out", "sink", "in"), ("top.x", "o", "top.mid.other", "in")]
    names = [r.name for r in graph.list_node_names(cont).collect()]
    assert names == ["top.mid.leaf", "top.mid.other", "top.x"]


def test_ordered_index_display_names(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(11)], "src long, dst long")
    out = graph.ordered_index(graph.topo_levels(df)).orderBy("index").collect()
    assert [r["index"] for r in out] == list(range(12))
    assert out[3].display_name == "03_3"


def test_distances_and_closure_on_random_graphs_with_cycles(spark):
    import random
    r = random.Random(4)
    for n, m in ((12, 20), (30, 36), (25, 25)):
        edges = sorted({(r.randrange(n), r.randrange(n)) for _ in range(m)}) + [(100, 101)]
        out = {}
        for s in {x for e in edges for x in e}:
            far, front = {s: 0}, [s]
            while front:
                front = [b for a in front for x, b in edges if x == a and b not in far and not far.update({b: far[a] + 1})]
            out[s] = far
        df = spark.createDataFrame(edges, "src long, dst long")
        pairs = [(a, b) for a in list(out)[:6] for b in list(out)[::3]] + [(100, 101), (101, 100), (7, 7), (-1, 3)]
        got = {(x.root, x.node): x.dist for x in graph.distances(df, spark.createDataFrame(pairs + pairs[:2], "root long, node long")).collect()}
        assert got == {(a, b): out.get(a, {}).get(b) for a, b in pairs} | {(7, 7): 0}
        roots = spark.createDataFrame([(a,) for a in list(out)[:5]], "root long")
        for every in (1, 3):
            got = {(x.root, x.node): x.dist for x in graph.closure(df, roots, cut_every=every).collect()}
            assert got == {(a, b): d for a in list(out)[:5] for b, d in out[a].items() if d}


def brute_levels(edges):
    nodes = {n for e in edges for n in e}
    preds = {n: [a for a, b in edges if b == n] for n in nodes}
    levels = {}
    while True:
        new = {n: max([levels[p] + 1 for p in preds[n]], default=0) for n in nodes
               if n not in levels and all(p in levels for p in preds[n])}
        if not new:
            return levels
        levels.update(new)


def test_levels_and_components_of_random_graphs(spark):
    random.seed(11)
    for size, m in ((12, 18), (40, 44), (60, 60)):
        edges = sorted({(random.randrange(size), random.randrange(size)) for _ in range(m)})     # self-loops too
        df = spark.createDataFrame(edges + edges[:3], "src long, dst long")
        want = brute_levels(edges)
        nodes = {n for e in edges for n in e}
        assert {r.node: r.level for r in graph.topo_levels(df).collect()} == want
        assert {r.node for r in graph.acyclic_check(df).collect()} == nodes - set(want)
        step = {n: {b for a, b in edges if a == n} for n in nodes}

        def reach(n):
            seen, todo = set(), list(step[n])
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += step[x]
            return seen
        far = {n: reach(n) for n in nodes}
        comp = {n: min(x for x in far[n] if n in far[x]) for n in nodes if n in far[n]}
        assert {r.node: r.component for r in graph.cycle_components(df).collect()} == comp


def test_levels_of_a_long_chain(spark):
    # a chain of 2,000, a node that joins it from its start, a cycle of 300 and a tail behind it
    edges = [(i, i + 1) for i in range(2000)] + [(0, 5000), (1999, 5000), (5000, 5001)]
    edges += [(7000 + i, 7000 + (i + 1) % 300) for i in range(300)] + [(7000, 8000), (8000, 8001), (8001, 5002), (1, 5002)]
    df = spark.createDataFrame(edges, "src long, dst long")
    lv, left = graph.peel_levels(df)
    got = {r.node: r.level for r in lv.collect()}
    assert got == {**{i: i for i in range(2001)}, 5000: 2000, 5001: 2001}
    assert {r.node for r in left.collect()} == {*range(7000, 7300), 8000, 8001, 5002}


def test_levels_of_nulls_and_of_no_edges(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (None, None), (3, 4), (1, 4)], "src long, dst long")
    assert {r.node: r.level for r in graph.topo_levels(df).collect()} == {1: 0, 2: 0, 3: 0, 4: 1}
    none = df.limit(0)
    assert graph.topo_levels(none).count() == graph.acyclic_check(none).count() == graph.cycle_components(none).count() == 0
    names = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c")], "src string, dst string")
    assert {r.node: r.level for r in graph.topo_levels(names).collect()} == {"a": 0, "b": 1, "c": 2}


def test_all_pairs_grow_inside_their_buckets(spark):
    tables = {t.name for t in spark.catalog.listTables()}
    fan = [(a, b) for a in range(3) for b in range(10, 18)] + [(12, 20), (20, 21), (21, 12), (5, 5)]
    for edges in (fan, [(b, a) for a, b in fan], []):       # pairs grow at the end that has more nodes
        want = {(str(a), str(b), d) for a, reach in brute_reach(edges, {n for e in edges for n in e}).items() for b, d in reach.items()}
        df = spark.createDataFrame([(str(a), str(b)) for a, b in edges] + [(None, "1"), ("2", None)], "src string, dst string")
        for every in (1, 2, 4):
            down, up = (graph.closure(df, reverse=r, cut_every=every) for r in (False, True))
            assert "Exchange" not in down._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, down.select("root", "node", "dist").collect())) == sorted(want)
            if every == 4:
                assert sorted(map(tuple, up.select("node", "root", "dist").collect())) == sorted(want)
    assert {t.name for t in spark.catalog.listTables()} == tables and spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
