"""Workflow graphs as tables: ``nodes(node, interface)``, ``edges(src, src_port, dst, dst_port[, fn])``,
declared ``ports(node, port, direction)`` and containment ``(parent, node)``.

Checks and expansions are joins and aggregates over all nodes at once, not one
scan of the adjacency per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineark.operators.series import with_series_index


def output_name(node: str = "src", port: str = "src_port"):
    return F.concat_ws(".", F.col(node), F.col(port))


def edge_input_match(edges: DataFrame, output_ids: DataFrame, port: str = "port", run: str | None = None) -> DataFrame:
    """For every node, the inputs fed by an upstream output that already has an
    ID: ``src.src_port`` matched against the output-ID map (a function edge
    matches on its source port; the function is ignored).  With ``run``, a column of
    ``output_ids``, the edges hold in every run and each match names its run."""
    key = [run] if run else []
    names = output_ids.select(*key, F.col(port).alias("_out")).distinct()
    e = edges.withColumn("_out", output_name())
    return e.join(names, "_out").select(*key, "dst", "dst_port", F.col("_out").alias("input"))


def input_id_precedence(inputs: DataFrame, output_ids: DataFrame, location_ids: DataFrame,
                        node: str = "node", inp: str = "input", run: str | None = None) -> DataFrame:
    """Resolve node inputs: the output-ID map first (a multi-valued hit gives
    all its IDs), then the location map (path -> id).  ``(node, input, id, source)``, with
    ``run`` in front where it names a column of ``inputs`` and ``output_ids``: outputs
    then only meet inputs of their own run."""
    key = [run] if run else []
    outs = output_ids.select(*key, F.col("port").alias(inp), F.col("id").alias("_oid"), F.col("seq"))
    locs = location_ids.groupBy(F.col("path").alias(inp)).agg(F.min("id").alias("_lid"))
    by_out = inputs.join(outs, [*key, inp]).select(*key, node, inp, F.col("_oid").alias("id"), F.lit("output").alias("source"))
    rest = inputs.join(outs.select(*key, inp).distinct(), [*key, inp], "left_anti")
    by_loc = rest.join(locs, inp).select(*key, node, inp, F.col("_lid").alias("id"), F.lit("location").alias("source"))
    return by_out.unionByName(by_loc)


def unresolved_inputs(inputs: DataFrame, output_ids: DataFrame, location_ids: DataFrame,
                      inp: str = "input") -> DataFrame:
    """Inputs found in neither map."""
    known = output_ids.select(F.col("port").alias(inp)).unionByName(
        location_ids.select(F.col("path").alias(inp))).distinct()
    return inputs.join(known, inp, "left_anti")


def node_outputs(report_rows: DataFrame, node: str = "node", port: str = "port",
                 value: str = "value") -> DataFrame:
    """One row per output file with the output name ``node.port``."""
    return report_rows.select(node, F.concat_ws(".", F.col(node), F.col(port)).alias("output_name"),
                              F.col(value).alias("file_path"), *[c for c in report_rows.columns
                                                                  if c not in (node, port, value)])


def output_id_accumulate(outputs: DataFrame, port: str = "port", seq: list[str] | str = "seq",
                         id_col: str = "id") -> DataFrame:
    """All IDs of each ``node.port`` in arrival order, as ``(port, pos, id)``
    (``pos`` 0 is the first, later ones append).  Positions come from the
    skew-safe index, so a port with very many outputs is split over tasks."""
    seqs = [seq] if isinstance(seq, str) else list(seq)
    return with_series_index(outputs.select(port, *seqs, id_col), port, seqs, name="pos") \
        .select(port, "pos", id_col)


def unconnected_inputs(ports: DataFrame, edges: DataFrame) -> DataFrame:
    """Declared input ports with no incoming edge (what a caller must supply)."""
    ins = ports.where(F.col("direction") == "in").select("node", "port")
    fed = edges.select(F.col("dst").alias("node"), F.col("dst_port").alias("port"))
    return ins.join(fed, ["node", "port"], "left_anti")


def input_bindings(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each connected port of an existing node, the upstream result it
    reads (``src.src_port``) and the edge's function, if any."""
    fn = F.col("fn") if "fn" in edges.columns else F.lit(None).cast("string")
    e = edges.select("dst", "dst_port", output_name().alias("source"), fn.alias("fn"))
    return e.join(nodes.select(F.col("node").alias("dst")).distinct(), "dst", "left_semi")


def unknown_ports(edges: DataFrame, ports: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges naming an input the destination lacks or an output the source
    lacks; nodes whose interface is an I/O type (``.io``) are exempt."""
    io = nodes.where(F.col("interface").contains(".io")).select("node").distinct()
    ins = ports.where(F.col("direction") == "in").select(F.col("node").alias("dst"), F.col("port").alias("dst_port"))
    outs = ports.where(F.col("direction") == "out").select(F.col("node").alias("src"), F.col("port").alias("src_port"))
    e = edges.select("src", "src_port", "dst", "dst_port")
    bad_in = (e.join(ins, ["dst", "dst_port"], "left_anti")
              .join(io.select(F.col("node").alias("dst")), "dst", "left_anti")
              .withColumn("side", F.lit("input")))
    bad_out = (e.join(outs, ["src", "src_port"], "left_anti")
               .join(io.select(F.col("node").alias("src")), "src", "left_anti")
               .withColumn("side", F.lit("output")))
    return bad_in.unionByName(bad_out)


def needed_outputs(edges: DataFrame) -> DataFrame:
    """Per node, the sorted distinct output ports used downstream (``a,b``).
    Pairs are made distinct before the per-node list, so the list is bounded
    by the node's declared ports."""
    pairs = edges.select(F.col("src").alias("node"), F.col("src_port").alias("port")).distinct()
    return pairs.groupBy("node").agg(F.concat_ws(",", F.array_sort(F.collect_list("port"))).alias("needed"))


def duplicate_nodes(nodes: DataFrame, level: str = "parent", name: str = "name") -> DataFrame:
    """Node names used more than once at the same level."""
    return nodes.groupBy(level, name).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_ports(edges: DataFrame) -> DataFrame:
    """Input ports fed by more than one edge (repeats of the same edge do not count)."""
    e = edges.select("src", "src_port", "dst", "dst_port").distinct()
    return e.groupBy("dst", "dst_port").agg(F.count(F.lit(1)).alias("n_edges")).where(F.col("n_edges") > 1)


def group_widths(containment: DataFrame, group: str = "parent") -> DataFrame:
    """Nodes per group and whether the group is (one of) the widest."""
    w = containment.groupBy(group).agg(F.count(F.lit(1)).alias("width"))
    widest = w.agg(F.max("width")).scalar()   # scalar subquery, evaluated by Spark
    return w.withColumn("widest", F.col("width") == widest)


def node_imports(edges: DataFrame) -> DataFrame:
    """The plain link list: each distinct ``(dst, src)`` pair."""
    return edges.select("dst", "src").distinct()
