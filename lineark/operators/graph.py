"""Graph operators as DataFrame loops: levels, cycle check, closure, hierarchy.

Every loop works on whole frontiers (all nodes or all roots at once), ends
when a frontier is empty, and fixes each round's small result with a reliable
``checkpoint()`` or a table (both in ``spark.checkpoint.dir``) so lineage stays short
and a lost executor re-reads instead of recomputing earlier rounds.
"""

from __future__ import annotations

from contextlib import contextmanager
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineark.functions.ids import mint_id
from lineark.operators import records, workflow
from lineark.operators.series import with_series_index
from lineark.session import clean_shuffles, discard, scratch_path


def _nodes(edges: DataFrame, src: str, dst: str) -> DataFrame:
    return edges.select(F.col(src).alias("node")).unionByName(
        edges.select(F.col(dst).alias("node"))).where(F.col("node").isNotNull()).distinct()


def _stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with clean_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _stored_edges(edges: DataFrame, key: str, n: int | None = None):
    """The rows as a table in ``n`` buckets of ``key`` while the block runs: joins on it in a loop shuffle their
    other side alone.  The files lie in the shared folder until then."""
    spark = edges.sparkSession
    path = scratch_path(spark, "buckets")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with clean_shuffles(spark):
        edges.repartition(n, key).write.bucketBy(n, key).option("path", path).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
        discard(spark, path)


def _chains(edges: DataFrame, single: DataFrame) -> DataFrame:
    """``(node, anc, w)`` for the nodes ``single(node, pred)`` with one predecessor: ``anc`` is the nearest
    ancestor with none or several, ``w`` steps back.  Pointers double each round, so a chain of n
    nodes takes log n rounds.  A pointer that still moves then runs in a cycle: its ``anc`` is NULL."""
    jump = single.select("node", F.col("pred").alias("anc"), F.lit(1).cast("bigint").alias("w"))
    jump = _stored(jump, "chains")
    rounds = jump.count().bit_length() + 1
    if rounds == 1:
        return jump
    for r in range(rounds):
        ahead = jump.select(F.col("node").alias("_n"), F.col("anc").alias("_a"), F.col("w").alias("_w"))
        moved = jump.join(ahead, F.col("anc") == F.col("_n"), "left")
        nxt = _stored(moved.select("node", F.coalesce("_a", "anc").alias("anc"), (F.col("w") + F.coalesce("_w", F.lit(0))).alias("w"),
                                   F.col("_n").isNotNull().alias("_moved")), "chains")
        jump = nxt.select("node", "anc", "w")
        if not nxt.where("_moved").take(1):
            return jump
    return nxt.select("node", F.when(~F.col("_moved"), F.col("anc")).alias("anc"), "w")


def peel_levels(edges: DataFrame, src: str = "src", dst: str = "dst") -> tuple[DataFrame, DataFrame]:
    """Longest path from a root to every node.  Returns ``(levels(node, level), left(node))``;
    ``left`` holds the nodes on or behind a cycle and is empty for a DAG.  An edge with a
    NULL end only says that its other end exists.

    Nodes with one predecessor hang on their chain's start and take no part in the rounds.  The
    rest is peeled by counters: each finished node sends its level along its edges, and a
    node is finished when as many edges have reached it as lead to it (a number that every edge
    carries).  The edges are written once, by bucket of their source; a round reads only the
    buckets of the nodes that it finishes, and writes those and the nodes that still wait.
    """
    return _peel(_stored(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct(), "every"))


def _peel(every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`peel_levels` of stored, distinct edges ``(src, dst)``."""
    spark = every.sparkSession
    nodes = _nodes(every, "src", "dst")
    e = every.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    into = e.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("_in"), F.min("src").alias("pred"))
    chains = _chains(e, into.where("_in = 1"))
    # edges into the other nodes, from the start of the chain that their source hangs on
    several = into.where("_in > 1").select(F.col("node").alias("dst"), "_in")
    core = (e.join(several, "dst").join(chains.select(F.col("node").alias("src"), "anc", "w"), "src", "left")
            .where(F.col("w").isNull() | F.col("anc").isNotNull())
            .select(F.coalesce("anc", "src").alias("src"), "dst", "_in", (F.coalesce("w", F.lit(0)) + 1).alias("w")))
    # edges that share both ends go as one, which counts for all of them
    core = core.groupBy("src", "dst", "_in").agg(F.max("w").alias("w"), F.count(F.lit(1)).alias("c"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.hash("node"), F.lit(n))
    stored, state = scratch_path(spark, "edges"), scratch_path(spark, "levels")
    (core.withColumn("bucket", F.pmod(F.hash("src"), F.lit(n))).hint("rebalance", "bucket")
     .write.partitionBy("bucket").parquet(stored))
    kind = core.schema["src"].dataType.simpleString()
    edge_schema = f"src {kind}, dst {kind}, _in long, w long, c long, bucket int"
    state_schema = f"node {kind}, level long, done boolean, _in long, got long"

    def written(r: int) -> DataFrame:
        return spark.read.schema(state_schema).parquet(f"{state}/round={r}")

    first = nodes.join(into.select("node"), "node", "left_anti").select(
        "node", F.lit(0).cast("bigint").alias("level"), F.lit(True).alias("done"), F.lit(0).cast("bigint").alias("_in"), F.lit(0).cast("bigint").alias("got"))
    first.write.parquet(f"{state}/round=0")
    for r in count():
        now = written(r)
        front = now.where("done").select("node", "level")
        touched = [x[0] for x in front.select(bucket).distinct().collect()]     # at most n numbers
        if not touched:
            break
        out = spark.read.schema(edge_schema).parquet(stored).where(F.col("bucket").isin(touched))
        sent = out.join(front.withColumnRenamed("node", "src"), "src").select(
            F.col("dst").alias("node"), (F.col("level") + F.col("w")).alias("level"), "_in", F.col("c").alias("got"))
        waits = now.where("NOT done").select("node", "level", "_in", "got")
        (sent.unionByName(waits).groupBy("node", "_in").agg(F.max("level").alias("level"), F.sum("got").alias("got"))
         .select("node", "level", (F.col("got") == F.col("_in")).alias("done"), "_in", "got")
         .write.parquet(f"{state}/round={r + 1}"))
    peeled = spark.read.schema(state_schema).parquet(state).where("done").select("node", "level")
    hung = chains.join(peeled.withColumnRenamed("node", "anc"), "anc").select("node", (F.col("level") + F.col("w")).alias("level"))
    levels = peeled.unionByName(hung)
    return levels, nodes.join(levels.select("node"), "node", "left_anti")


def topo_levels(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Level of every node = longest path from a root (a topological order is
    ``ORDER BY level, node``).  Nodes on a cycle get no level."""
    return peel_levels(edges, src, dst)[0]


def acyclic_check(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Nodes that cannot be ordered (on or behind a cycle); empty for a DAG."""
    return peel_levels(edges, src, dst)[1]


def cycle_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """The nodes that lie on a cycle, ``(node, component)``; ``component`` is the smallest node of those that
    reach each other.  Nodes merely behind a cycle, or between two, are not listed.

    What can be peeled from the roots and from the leaves goes first, from the side with more free ends to begin
    with.  Then, in turns: every node takes the smallest node that reaches it and the smallest that it reaches.
    Where both are the same node, the node belongs to that one's component; nodes of one component agree in
    both, so an edge between nodes that do not is dropped.  Every piece that the dropped edges leave settles
    at least its smallest node's component in the next turn, all pieces at once."""
    def inside(e, nodes):
        return _stored(e.join(nodes.select(F.col("node").alias("src")), "src", "left_semi")
                       .join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi"), "edges")

    e = _stored(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "edges")
    forth, back = ("src", "dst"), ("dst", "src")
    more_leaves = e.select("src").distinct().count() < e.select("dst").distinct().count()
    for a, b in (back, forth) if more_leaves else (forth, back):
        e = inside(e, _peel(e.select(F.col(a).alias("src"), F.col(b).alias("dst")))[1])
    found = []
    while e.take(1):
        label = _labels(e)
        ends = lambda end, fore, aft: label.select(F.col("node").alias(end), F.col("fore").alias(fore), F.col("aft").alias(aft))
        near = _stored(e.join(ends("src", "fore", "aft"), "src").join(ends("dst", "_f", "_a"), "dst")
                       .where("fore = _f AND aft = _a").select("src", "dst", "fore", "aft"), "edges")
        # a node that only reaches itself need not be on a cycle: it is if one of its edges stays inside
        whole = near.where("fore = aft").select(F.col("fore").alias("component")).distinct()
        found.append(label.where("fore = aft").select("node", F.col("fore").alias("component")).join(whole, "component", "left_semi").select("node", "component"))
        e = near.where("fore <> aft").select("src", "dst")
    out = found[0] if found else _nodes(e, "src", "dst").select("node", F.col("node").alias("component"))
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _labels(e: DataFrame) -> DataFrame:
    """``(node, fore, aft)`` of the edges' nodes: the smallest node that reaches it and the smallest that it
    reaches, itself included.  The edges are stored once, both ways; a round sends on only what has changed."""
    label = _stored(_nodes(e, "src", "dst").select("node", F.col("node").alias("fore"), F.col("node").alias("aft")), "labels")
    arcs = e.select("src", F.col("dst").alias("to"), F.lit(True).alias("forth")).unionByName(
        e.select(F.col("dst").alias("src"), F.col("src").alias("to"), F.lit(False).alias("forth")))
    with _stored_edges(arcs, "src") as arcs:
        front = label
        while True:
            sent = (front.withColumnRenamed("node", "src").join(arcs, "src").groupBy(F.col("to").alias("node"))
                    .agg(F.min(F.when(F.col("forth"), F.col("fore"))).alias("_f"), F.min(F.when(~F.col("forth"), F.col("aft"))).alias("_a")))
            # least() passes over NULLs
            nxt = _stored(label.join(sent, "node", "left").select(
                "node", F.least("fore", "_f").alias("fore"), F.least("aft", "_a").alias("aft"),
                (F.coalesce(F.col("_f") < F.col("fore"), F.lit(False)) | F.coalesce(F.col("_a") < F.col("aft"), F.lit(False))).alias("_less")), "labels")
            label, front = nxt.select("node", "fore", "aft"), nxt.where("_less").select("node", "fore", "aft")
            if not front.take(1):
                return label


def ordered_index(levels: DataFrame, node: str = "node", level: str = "level") -> DataFrame:
    """Running index in topological order (by level, then node) and the display
    name ``<index zero-padded to ceil(log10 n)>_<node>``.  The index comes from
    the range-partitioned numbering, not one global window task."""
    idx = with_series_index(levels.select(node, level), [], [level, node], name="index")
    n = levels.agg(F.count(F.lit(1))).scalar()
    width = F.greatest(F.ceil(F.log10(n)), F.lit(1)).cast("int")
    return idx.select(node, level, "index",
                      F.concat(F.lpad(F.col("index").cast("string"), width, "0"), F.lit("_"),
                               F.col(node).cast("string")).alias("display_name"))


def closure(edges: DataFrame, roots: DataFrame | None = None, src: str = "src", dst: str = "dst",
            reverse: bool = False, cut_every: int = 4) -> DataFrame:
    """Everything reachable from each root, with the BFS distance: ``(root, node, dist)``.

    ``reverse=False`` follows ``src -> dst``; ``reverse=True`` follows edges
    backwards.  All roots run together (default: every node, see :func:`_all_pairs`; with few roots the
    work is in proportion to what they reach).  Each round extends only the newest
    frontier; every ``cut_every`` rounds (twice as long after a cut that left fewer rows than
    the one before) it is cut against every pair seen so far, so
    the loop ends on cyclic graphs too, and pairs met again in between are brought
    down to their shortest distance at the end.  The edges are stored once by bucket of the node that they
    leave, so a round shuffles pairs only.
    """
    if roots is None:
        root, node = ("dst", "src") if reverse else ("src", "dst")
        return _all_pairs(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")), cut_every).select(
            F.col(root).alias("root"), F.col(node).alias("node"), "dist")
    a, b = (dst, src) if reverse else (src, dst)
    with _stored_edges(edges.select(F.col(a).alias("node"), F.col(b).alias("next")).distinct(), "node") as adj:
        frontier = _stored(roots.select(F.col(roots.columns[0]).alias("root")).distinct().withColumn("node", F.col("root")), "pairs")
        seen = frontier
        layers, since, before = [], 0, 0
        for d in count(1):
            step = (frontier.join(adj, "node").select("root", F.col("next").alias("node"))
                    .where(F.col("root") != F.col("node")).distinct())
            since += 1
            if since >= cut_every:
                step = step.join(seen, ["root", "node"], "left_anti")
            step = _stored(step, "pairs")
            n = step.count()
            if not n:
                break
            if since >= cut_every:
                # a frontier that gets smaller ends by itself; one that does not is cut again
                since = 0 if cut_every == 1 or n >= before else -cut_every
                before = n
            layers.append(step.withColumn("dist", F.lit(d).cast("bigint")))
            seen = seen.unionByName(step)
            frontier = step
    if not layers:
        return frontier.limit(0).withColumn("dist", F.lit(0).cast("bigint"))
    out = layers[0]
    for layer in layers[1:]:
        out = out.unionByName(layer)
    return out if cut_every == 1 else out.groupBy("root", "node").agg(F.min("dist").alias("dist"))


# edges in one bucket of the table of all pairs, about
BUCKET_EDGES = 1 << 15


def _all_pairs(edges: DataFrame, cut_every: int) -> DataFrame:
    """The closure of every node at once: ``(src, dst, dist)`` for each ``dst`` that ``src`` reaches.

    What all nodes reach and what they are reached from are the same pairs, so they may grow at either end: it is the end
    that has more nodes, over which the pairs spread.  All rounds lie in one table, in buckets of that end, as do the edges that
    go on from it.  A round joins its newest pairs with those where they lie and shuffles what it makes once; its
    distinct, the cut against the pairs seen and the shortest distances at the end run inside the buckets.  These
    get more, not larger, with more edges.  The rounds and the cuts are those of :func:`closure`.
    """
    spark = edges.sparkSession
    e = _stored(edges.where("src <> dst").distinct(), "edges")
    ahead = e.select("dst").distinct().count() >= e.select("src").distinct().count()
    far, at = ("src", "dst") if ahead else ("dst", "src")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-e.count() // BUCKET_EDGES))
    path = scratch_path(spark, "pairs")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    kind = {f.name: f.dataType.simpleString() for f in e.schema}
    # the folders of all rounds, read as one table
    spark.sql(f"CREATE TABLE {table} (far {kind[far]}, at {kind[at]}, dist BIGINT) USING parquet "
              f"OPTIONS (path '{path}', recursiveFileLookup 'true') CLUSTERED BY (at) INTO {n} BUCKETS")
    rounds = []

    def stored(rows: DataFrame, d: int) -> DataFrame:
        rounds.append(f"{table}_{d}")
        rows.select("far", "at", F.lit(d).cast("bigint").alias("dist")).write.bucketBy(n, "at").option("path", f"{path}/{d}").saveAsTable(rounds[-1])
        return spark.table(rounds[-1])

    def seen() -> DataFrame:
        spark.catalog.refreshTable(table)
        return spark.table(table)

    whole = "spark.sql.requireAllClusterKeysForCoPartition"
    kept = spark.conf.get(whole)
    with _stored_edges(e.select(F.col(far).alias("at"), F.col(at).alias("to")), "at", n) as on, clean_shuffles(spark):
        try:
            spark.conf.set(whole, "false")      # the cut's two sides meet where they lie
            frontier = stored(e.select(F.col(far).alias("far"), F.col(at).alias("at")).repartition(n, "at"), 1)
            since, before = 1, 0
            for d in count(2):
                step = (frontier.join(on.hint("shuffle_hash"), "at").select("far", F.col("to").alias("at"))
                        .where(F.col("far") != F.col("at")).repartition(n, "at").distinct())
                since += 1
                cut = since >= cut_every
                if cut:
                    step = step.join(seen().select("far", "at"), ["far", "at"], "left_anti")
                frontier = stored(step, d)
                new = frontier.count()
                if not new:
                    break
                if cut:
                    # a frontier that gets smaller ends by itself; one that does not is cut again
                    since = 0 if cut_every == 1 or new >= before else -cut_every
                    before = new
            out = seen()
        finally:
            spark.conf.set(whole, kept)
            for name in [table, *rounds]:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
    if cut_every > 1:
        out = out.groupBy("far", "at").agg(F.min("dist").alias("dist"))
    return out.select(F.col("far").alias(far), F.col("at").alias(at), "dist")


def distances(edges: DataFrame, pairs: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Shortest distance along ``src -> dst`` for each asked pair: ``pairs(root, node)`` with ``dist``, NULL where
    there is no path, 0 for a node itself.

    A search from both ends: every round goes one step on from the roots or back from the
    nodes of the pairs that are open, on the side whose newest frontier is smaller.  A pair at distance i + j is
    met when one end has made i steps and the other j, at a node that is new in both: so only
    the newest frontiers are joined, either with each other or by way of the open pairs, whichever
    makes fewer rows.  The open pairs are cut by the answers, and answered ends rest, while there are no
    more pairs than rows in the frontiers; more pairs than that are stored once and only read."""
    e = _stored(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).distinct(), "edges")
    # dealt out before they are made distinct: a task that makes many pairs need not hold them
    asked = _stored(pairs.select("root", "node").repartition("root", "node").distinct(), "asked")
    open_ = asked.where("root <> node")
    n_open = open_.count()
    answers = asked.where("root = node").withColumn("dist", F.lit(0).cast("bigint"))
    with _stored_edges(e.select(F.col("a").alias("at"), F.col("b").alias("to")), "at") as ahead, \
            _stored_edges(e.select(F.col("b").alias("at"), F.col("a").alias("to")), "at") as back:
        sides = {}
        for c, by in (("root", ahead), ("node", back)):
            per = _stored(open_.groupBy(F.col(c).alias("id")).agg(F.count(F.lit(1)).alias("_n")), "ends")
            start = per.select("id", F.col("id").alias("at"))
            sides[c] = {"seen": start, "new": start, "n": start.count(), "by": by, "per": per}
        for d in count(1):
            if not n_open or not all(s["n"] for s in sides.values()):
                break
            s = min(sides.values(), key=lambda x: x["n"])
            step = s["new"].join(s["by"], "at").select("id", F.col("to").alias("at")).distinct().join(s["seen"], ["id", "at"], "left_anti")
            s["new"] = _stored(step, "steps")
            s["n"] = s["new"].count()
            if not s["n"]:
                break
            s["seen"] = s["seen"].unionByName(s["new"])
            left, right = (sides[c]["new"].select(F.col("id").alias(c), "at") for c in ("root", "node"))
            # rows that each way makes: both ends' numbers at a node, or an end's pairs times its frontier
            by_node = left.groupBy("at").agg(F.count(F.lit(1)).alias("_l")).join(right.groupBy("at").agg(F.count(F.lit(1)).alias("_r")), "at")
            by_pair = left.withColumnRenamed("root", "id").join(sides["root"]["per"], "id")
            cost = [x.first()[0] or 0 for x in (by_node.agg(F.sum(F.col("_l").cast("double") * F.col("_r"))), by_pair.agg(F.sum("_n")))]
            if cost[0] <= cost[1]:
                met = left.join(right, "at").select("root", "node").distinct()
            else:
                met = open_.join(left, "root").join(right, ["node", "at"]).select("root", "node").distinct()
            few = n_open <= sides["root"]["n"] + sides["node"]["n"]
            if few:
                met = met.join(open_, ["root", "node"], "left_semi")
            met = _stored(met.where("root <> node"), "met")
            if not met.take(1):
                continue
            answers = answers.unionByName(met.withColumn("dist", F.lit(d).cast("bigint")))
            if few:
                open_ = _stored(open_.join(met, ["root", "node"], "left_anti"), "open")
                n_open = open_.count()
                for c in ("root", "node"):      # ends of answered pairs rest
                    per = _stored(open_.groupBy(F.col(c).alias("id")).agg(F.count(F.lit(1)).alias("_n")), "ends")
                    sides[c]["per"] = per
                    sides[c]["new"] = _stored(sides[c]["new"].join(per, "id", "left_semi"), "steps")
                    sides[c]["n"] = sides[c]["new"].count()
    best = answers.groupBy("root", "node").agg(F.min("dist").alias("dist"))
    return asked.join(best, ["root", "node"], "left").select("root", "node", "dist")


def evidence_graph(edges: DataFrame, roots: DataFrame | None = None, src: str = "src",
                   dst: str = "dst") -> DataFrame:
    """Full evidence of each ID: everything it came from, at any depth.
    Edges point from what was used to what was made (``src -> dst``)."""
    return closure(edges, roots, src, dst, reverse=True)


def downstream_impact(edges: DataFrame, roots: DataFrame | None = None, src: str = "src",
                      dst: str = "dst") -> DataFrame:
    """Everything derived from each ID (the reverse of the evidence graph)."""
    return closure(edges, roots, src, dst, reverse=False)


def provenance_edges(used: DataFrame, generated: DataFrame) -> DataFrame:
    """Record links as graph edges ``used -> run -> generated``."""
    u = used.select(F.col("ref_id").alias("src"), F.col("job_id").alias("dst"))
    g = generated.select(F.col("job_id").alias("src"), F.col("dataset_id").alias("dst"))
    return u.unionByName(g).distinct()


def hierarchy_paths(containment: DataFrame, parent: str = "parent", node: str = "node") -> DataFrame:
    """Dotted path from the top for every node in a containment tree:
    ``(node, path, is_leaf)``.  One join per level, to any depth; a containment
    cycle raises ValueError."""
    c = containment.select(F.col(parent).alias("parent"), F.col(node).alias("node")).distinct()
    up = c.select(F.col("node").alias("cur"), F.col("parent").alias("up"))
    tops = c.select(F.col("parent").alias("node")).distinct().join(c.select("node"), "node", "left_anti")
    paths = c.select("node", F.col("node").alias("path"), F.col("parent").alias("cur"))
    while True:
        paths = (paths.join(up, "cur", "left")
                 .select("node", F.concat_ws(".", "cur", "path").alias("path"), F.col("up").alias("cur")))
        paths = paths.checkpoint()
        if not paths.where(F.col("cur").isNotNull()).take(1):
            break
        if paths.where(F.col("cur") == F.col("node")).take(1):
            raise ValueError("containment has a cycle: a node is inside itself")
    paths = paths.select("node", "path").unionByName(tops.select("node", F.col("node").alias("path")))
    parents = c.select(F.col("parent").alias("node")).distinct().withColumn("_p", F.lit(True))
    return paths.join(parents, "node", "left").select("node", "path", F.col("_p").isNull().alias("is_leaf"))


def all_leaf_nodes(containment: DataFrame, parent: str = "parent", node: str = "node") -> DataFrame:
    """Leaf nodes of all nested workflows, with their dotted paths."""
    return hierarchy_paths(containment, parent, node).where("is_leaf").select("node", "path")


def list_node_names(containment: DataFrame, parent: str = "parent", node: str = "node") -> DataFrame:
    """All leaf node names as dotted paths, sorted."""
    return all_leaf_nodes(containment, parent, node).select(F.col("path").alias("name")).orderBy("name")


def flatten_hierarchy(containment: DataFrame, edges: DataFrame, parent: str = "parent",
                      node: str = "node") -> DataFrame:
    """Rewrite edges that name a container port ``child.port`` to the inner
    leaf: the endpoint becomes the leaf's dotted path and the port the rest.
    Nested containers are unwrapped one level per round."""
    paths = hierarchy_paths(containment, parent, node)
    kids = containment.select(F.col(parent).alias("_c"), F.col(node).alias("_k")).distinct()
    e = edges.select("src", "src_port", "dst", "dst_port")
    for side in ("src", "dst"):
        p = f"{side}_port"
        while True:     # every round takes one name off a port, so it ends
            cand = e.withColumn("_k", F.substring_index(F.col(p), ".", 1)).withColumn("_c", F.col(side))
            hit = cand.join(kids.withColumn("_ok", F.lit(True)), ["_c", "_k"], "left")
            move = F.coalesce(F.col("_ok"), F.lit(False)) & F.col(p).contains(".")
            rest = F.expr(f"substr({p}, instr({p}, '.') + 1)")
            cols = [F.when(move, F.col("_k")).otherwise(F.col(c)).alias(c) if c == side else
                    F.when(move, rest).otherwise(F.col(c)).alias(c) if c == p else F.col(c)
                    for c in e.columns]
            moved = hit.select(*cols, move.alias("_moved")).checkpoint()
            e = moved.drop("_moved")
            if not moved.where("_moved").take(1):
                break
    sp = paths.select(F.col("node").alias("src"), F.col("path").alias("_sp"))
    dp = paths.select(F.col("node").alias("dst"), F.col("path").alias("_dp"))
    return (e.join(sp, "src", "left").join(dp, "dst", "left")
            .select(F.coalesce("_sp", "src").alias("src"), "src_port",
                    F.coalesce("_dp", "dst").alias("dst"), "dst_port"))


def run_provenance(nodes: DataFrame, edges: DataFrame, reports: DataFrame, node_inputs: DataFrame,
                   location_ids: DataFrame, catalogue: DataFrame) -> dict[str, DataFrame]:
    """Provenance of whole workflow runs, for all runs and nodes at once.

    ``nodes(run, node, interface)``, ``reports(run, node, port, seq, value)`` and
    ``node_inputs(run, node, input)``, the files a node names itself, are per run;
    ``edges`` are the workflow's and hold in every run; ``location_ids(path, id)`` are
    the files known before.  Every new ID is a hash of the run and the file path (of the
    run and ``node.port`` for values that are not files), so two runs never share a record,
    and the result does not depend on the order nodes ran in: the whole pass is a few joins.

    A known path reuses its ID and replaces what its port held before; a new output is
    appended to its port.  A node used what its edges bring and its own input files; an
    input is looked up among its run's outputs first, then in the location map.
    Each node gets a software ID from the catalogue (minted once per new interface) and
    a record ID.  Returns ``records``, ``used``, ``generated``, ``new_software``.
    """
    outs = workflow.node_outputs(reports.select("run", "node", "port", "seq", "value"))
    is_file = F.col("file_path") != "Not A File"
    loc = location_ids.groupBy(F.col("path").alias("file_path")).agg(F.min("id").alias("_known"))
    # outputs and inputs are read several times: both are stored, so that no shuffle on the way to them is kept or repeated
    gen = outs.join(loc, "file_path", "left").select(
        "run", "node", "output_name", "file_path", "seq", F.col("_known").isNotNull().alias("_is_known"),
        F.coalesce("_known", F.when(is_file, records.file_id("run", "file_path"))
                   .otherwise(mint_id("Value", "run", "output_name"))).alias("id"))
    gen = _stored(gen, "outputs")
    # the last known path of a port drops the entries before it
    last = gen.where("_is_known").groupBy("run", "output_name").agg(F.max("seq").alias("_from"))
    held = gen.join(last, ["run", "output_name"], "left").where(F.col("_from").isNull() | (F.col("seq") >= F.col("_from")))
    output_ids = held.select("run", F.col("output_name").alias("port"), "seq", "id")
    matched = workflow.edge_input_match(edges, output_ids, run="run").select("run", F.col("dst").alias("node"), "input")
    # an input may have many IDs: it meets its record before them, so the rows that they make are not shuffled
    inputs = _stored(matched.unionByName(node_inputs.select("run", "node", "input")).distinct()
                     .join(nodes.select("run", "node"), ["run", "node"]), "inputs")
    used_ids = workflow.input_id_precedence(inputs, output_ids, location_ids, run="run")
    sw, new_sw = records.lookup_or_insert(nodes.select("run", "node", "interface"), catalogue, "interface", "id")
    comps = sw.select("run", "node", F.col("id").alias("software_id"),
                      mint_id("Job", "run", "node").alias("record_id"))
    ids = comps.select("run", "node", "record_id")
    used = used_ids.select(mint_id("Job", "run", "node").alias("record_id"), "input", "id", "source")
    generated = gen.join(ids, ["run", "node"]).select("record_id", "output_name", "file_path", "id")
    return {"records": comps, "used": used, "generated": generated, "new_software": new_sw}
