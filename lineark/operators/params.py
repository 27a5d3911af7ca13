"""Node parameters and port reports: flattening, file routing, template filling, sweeps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineark.functions.paths import file_format, file_name

NOT_A_FILE = "Not A File"
UNDEFINED = "<undefined>"

_OBJ = "map<string,variant>"
_ARR = "array<variant>"


def _vtype(v: Column) -> Column:
    t = F.schema_of_variant(v)
    return (F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int")
            .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "float")
            .when(t == "BOOLEAN", "bool").when(t == "STRING", "string")
            .when(t == "VOID", "null").otherwise("other"))


def flatten_params(df: DataFrame, owner: str, json_col: str,
                   found: DataFrame | None = None) -> DataFrame:
    """Nested parameters -> ``(owner, key, value, vtype, in_list)``, one row per leaf.

    Naming: a dict entry ``k`` under ``p`` is ``p_k``; a scalar at list index
    ``i`` is ``p_i``; a dict at list index ``i`` gives ``p_<sub key>_i``.
    Lists inside lists are skipped and do not advance ``i``; a null in a list
    advances ``i`` but is dropped; a null dict value is kept.  Keys listed in
    ``found`` (``(owner, key)``: ports already fed by an edge) are skipped at
    any depth.  Only the top-level type marker is implied; nested markers are
    not produced.  Levels are expanded in a loop until no container is left;
    each level is checkpointed so later levels do not recompute earlier ones.
    """
    v = F.try_parse_json(F.col(json_col))
    top = df.select(F.col(owner).alias("owner"), F.explode(F.try_variant_get(v, "$", _OBJ)).alias("k", "v"))
    frontier = top.select("owner", "k", F.col("k").alias("name"), F.lit("").alias("suffix"), "v",
                          F.lit(False).alias("in_list"))
    found_keys = found.select(F.col(found.columns[0]).alias("owner"), F.col(found.columns[1]).alias("k")) \
        if found is not None else None
    leaves = []
    while True:
        if found_keys is not None:
            frontier = frontier.join(found_keys, ["owner", "k"], "left_anti")
        obj = F.try_variant_get("v", "$", _OBJ)
        arr = F.try_variant_get("v", "$", _ARR)
        tagged = frontier.withColumn("_obj", obj).withColumn("_arr", arr)
        leaves.append(tagged.where(F.col("_obj").isNull() & F.col("_arr").isNull())
                      .select("owner", F.concat("name", "suffix").alias("key"), "v", "in_list"))
        from_obj = tagged.where(F.col("_obj").isNotNull()).select(
            "owner", "name", "suffix", F.explode("_obj").alias("k", "v")).select(
            "owner", "k", F.concat_ws("_", "name", "k").alias("name"), "suffix", "v",
            F.lit(False).alias("in_list"))
        items = tagged.where(F.col("_arr").isNotNull()).select(
            "owner", "name", "suffix",
            F.posexplode(F.filter("_arr", lambda x: F.try_variant_get(x, "$", _ARR).isNull()))
            .alias("i", "v"))
        in_obj = F.try_variant_get("v", "$", _OBJ)
        from_list_dicts = items.where(in_obj.isNotNull()).select(
            "owner", "name", "i", "suffix", F.explode(in_obj).alias("k", "v")).select(
            "owner", "k", F.concat_ws("_", "name", "k").alias("name"),
            F.concat(F.lit("_"), F.col("i").cast("string"), "suffix").alias("suffix"), "v",
            F.lit(False).alias("in_list"))
        list_scalars = items.where(in_obj.isNull()).select(
            "owner", F.concat("name", F.lit("_"), F.col("i").cast("string"), "suffix").alias("key"),
            "v", F.lit(True).alias("in_list"))
        leaves.append(list_scalars.where(_vtype(F.col("v")) != "null"))
        # fix this level once: the next level and its leaves read it, not its lineage
        frontier = from_obj.unionByName(from_list_dicts).checkpoint()
        if frontier.isEmpty():
            break
    out = leaves[0]
    for leaf in leaves[1:]:
        out = out.unionByName(leaf)
    vt = _vtype(F.col("v"))
    return out.select(
        F.col("owner").alias(owner), "key",
        F.when(vt == "string", F.try_variant_get("v", "$", "string"))
         .when(vt == "null", F.lit(None).cast("string")).otherwise(F.to_json("v")).alias("value"),
        vt.alias("vtype"), "in_list")


def parameters_only(leaves: DataFrame) -> DataFrame:
    """Leaves that are parameters when no file listing is at hand: strings in
    lists are dropped (they could only be kept as files)."""
    return leaves.where(~(F.col("in_list") & (F.col("vtype") == "string")))


def split_params_files(leaves: DataFrame, objects: DataFrame, path: str = "path") -> DataFrame:
    """Route each flattened value: a string naming an existing file is an input
    file; other dict-level values are parameters; non-file strings inside
    lists are dropped.  Adds ``kind`` (``input_file`` / ``parameter``)."""
    files = objects.select(F.col(path).alias("value")).distinct().withColumn("_file", F.lit(True))
    # only strings can name a file: hot numbers and flags never enter the join
    text = leaves.where(F.col("vtype") == "string").join(files, "value", "left").select(*leaves.columns, "_file")
    j = text.unionByName(leaves.where(F.col("vtype") != "string").withColumn("_file", F.lit(None).cast("boolean")))
    is_file = F.col("_file").isNotNull()
    kind = F.when(is_file, "input_file").when(
        ~(F.col("in_list") & (F.col("vtype") == "string")), "parameter")
    return j.withColumn("kind", kind).where(F.col("kind").isNotNull()).drop("_file")


def parse_port_report(df: DataFrame, key: str, text_col: str, objects: DataFrame,
                      path: str = "path") -> DataFrame:
    """Port report text (``name = value`` lines) -> ``(key, port, seq, value)``.

    Lines without exactly one ``=`` or with an empty value are skipped, as is
    ``<undefined>``.  A ``[...]`` value is a list: items are kept only where
    they name an existing file (semi join with ``objects``), and a list with no
    file becomes ``'Not A File'``.  Scalars are kept unchecked.  A port named
    twice keeps its last line.
    """
    lines = df.select(key, F.posexplode(F.split(F.col(text_col), "\n")).alias("ln", "line"))
    parts = F.split("line", "=")
    kv = (lines.where(F.size(parts) == 2)
          .select(key, "ln", F.regexp_replace(parts[0], r"\s+$", "").alias("port"),
                  F.regexp_replace(parts[1], r"^\s+", "").alias("result"))
          .where((F.col("result") != "") & (F.col("result") != UNDEFINED)))
    last = kv.groupBy(key, "port").agg(F.max_by(F.struct("ln", "result"), "ln").alias("_l")) \
        .select(key, "port", F.col("_l.result").alias("result"))
    is_list = F.col("result").startswith("[") & F.col("result").endswith("]")
    scalars = last.where(~is_list).select(key, "port", F.lit(0).alias("seq"), F.col("result").alias("value"))
    body = F.regexp_replace(F.regexp_replace("result", r"^[\[\]]+|[\[\]]+$", ""), "'", "")
    items = last.where(is_list).select(key, "port", F.posexplode(F.split(body, ", ")).alias("seq", "value"))
    files = objects.select(F.col(path).alias("value")).distinct().withColumn("_f", F.lit(True))
    checked = items.join(files, "value", "left")
    kept = checked.where(F.col("_f").isNotNull()).select(key, "port", "seq", "value")
    empty = (checked.groupBy(key, "port").agg(F.max(F.col("_f").isNotNull()).alias("_any"))
             .where(~F.col("_any")).select(key, "port", F.lit(0).alias("seq"), F.lit(NOT_A_FILE).alias("value")))
    return scalars.unionByName(kept).unionByName(empty)


def fill_template(template, params) -> Column:
    """Replace every ``{name}`` in ``template`` with ``params[name]`` (a map column), in one pass:
    a value that itself holds ``{other}`` stays as it is, and so does a name without a value."""
    t = F.col(template) if isinstance(template, str) else template
    p = F.col(params) if isinstance(params, str) else params

    def filled(piece, i):
        value = F.element_at(p, F.substring_index(piece, "}", 1))
        rest = F.substring(piece, F.instr(piece, "}") + 1, F.length(piece))
        return F.when(i == 0, piece).when((F.instr(piece, "}") > 0) & value.isNotNull(), F.concat(value, rest)).otherwise(F.concat(F.lit("{"), piece))
    return F.when(t.isNotNull() & p.isNotNull(), F.array_join(F.transform(F.split(t, r"\{"), filled), ""))


def select_files(df: DataFrame, template: str, params: str, objects: DataFrame,
                 path: str = "path") -> DataFrame:
    """Fill path templates from parameters and keep the files that exist."""
    filled = df.withColumn(path, fill_template(template, params))
    return filled.join(objects.select(path).distinct(), path, "left_semi")


def config_merge(nodes: DataFrame, node_settings: DataFrame, workflow_settings: DataFrame,
                 global_settings: dict[str, str], node: str = "node",
                 workflow: str = "workflow") -> DataFrame:
    """Layered settings, later wins: global <- workflow <- node.  Settings come
    long (``key``, ``value``); each level becomes a map per node/workflow and
    the maps are merged key-wise.  Gives ``(node, key, value)``."""
    def as_map(df, k):
        # one value per (level, key); a key set twice at one level keeps the largest
        one = df.groupBy(k, "key").agg(F.max("value").alias("value"))
        return one.groupBy(k).agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias(f"_{k}_m"))
    g = F.create_map(*[x for kv in sorted(global_settings.items()) for x in (F.lit(kv[0]), F.lit(kv[1]))]) \
        if global_settings else F.create_map().cast("map<string,string>")
    empty = F.create_map().cast("map<string,string>")
    j = (nodes.select(node, workflow)
         .join(as_map(workflow_settings, workflow), workflow, "left")
         .join(as_map(node_settings.select(node, "key", "value"), node), node, "left"))
    later = lambda a, b: F.map_zip_with(a, b, lambda k, x, y: F.coalesce(y, x))
    merged = later(later(g, F.coalesce(F.col(f"_{workflow}_m"), empty)), F.coalesce(F.col(f"_{node}_m"), empty))
    return j.select(node, F.explode(merged).alias("key", "value"))


def param_sweep(values: DataFrame, node: str = "node", param: str = "param",
                pos: str = "pos", value: str = "value") -> DataFrame:
    """Expand nodes with iterable inputs into one instance per value combination.

    ``values`` is long: ``(node, param, pos, value)``.  Each instance is named
    by its assignment (``a=1,b=x`` in parameter order) and gives one row per
    parameter.  The output is the product of the value counts per node, which
    is what the expansion means; nothing beyond that is generated.
    """
    per_param = values.groupBy(node, param).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(pos, value))), lambda s: s[value]).alias("_vals"))
    per_node = per_param.groupBy(node).agg(F.array_sort(F.collect_list(F.struct(param, "_vals"))).alias("_ps"))
    # combination c of a node takes value c / stride_j % size_j of parameter j; the stride is the
    # product of the value counts of the parameters after it
    sizes = F.transform("_ps", lambda s: F.size(s["_vals"]).cast("long"))
    product = lambda x: F.aggregate(x, F.lit(1).cast("long"), lambda a, n: a * n)
    sized = per_node.select(node, "_ps", sizes.alias("_sizes")).withColumn("_n", product("_sizes"))
    strides = F.transform("_sizes", lambda _, j: product(F.slice("_sizes", j + 2, F.greatest(F.size("_sizes") - j - 1, F.lit(0)))))
    # blocks of about sqrt(n) combinations, dealt out before they are expanded: no row holds all of them
    block = F.greatest(F.ceil(F.sqrt("_n")), F.lit(1024)).cast("long")
    blocks = sized.select(node, "_ps", "_sizes", "_n", strides.alias("_st"), block.alias("_w"))
    blocks = blocks.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / F.col("_w")))).alias("_b"))
    blocks = blocks.repartition(F.xxhash64(node, "_b"))
    combos = blocks.select(node, "_ps", "_sizes", "_st", F.explode(F.sequence(
        F.col("_b") * F.col("_w"), F.least(F.col("_n"), (F.col("_b") + 1) * F.col("_w")) - 1)).alias("_c"))
    picked = combos.select(node, F.transform("_ps", lambda s, j: F.struct(
        s[param].alias(param), F.get(s["_vals"], (F.call_function("div", F.col("_c"), F.get("_st", j)) % F.get("_sizes", j)).cast("int")).alias(value))).alias("_e"))
    name = F.concat_ws(",", F.array_sort(F.transform("_e", lambda e: F.concat(e[param], F.lit("="), e[value]))))
    return picked.select(node, name.alias("instance"), F.explode("_e").alias("_e")).select(node, "instance", f"_e.{param}", f"_e.{value}")


# Functions an edge may apply to an upstream value before it reaches a port.
EDGE_FUNCTIONS: dict[str, Callable[..., Column]] = {
    "basename": lambda c: file_name(c),
    "extension": lambda c: file_format(c),
    "upper": lambda c: F.upper(c),
    "strip_ext": lambda c: F.regexp_replace(c, r"\.[^./]*$", ""),
}


def register_edge_function(name: str, fn: Callable[..., Column]) -> None:
    """Add a named column function usable on edges (stored by name, never as source text)."""
    EDGE_FUNCTIONS[name] = fn


def edge_function(df: DataFrame, value: str, fn: str, out: str = "value_in") -> DataFrame:
    """Apply the edge's named function (``fn`` column; NULL = pass through).  A
    name that is not registered fails the query."""
    expr = F.raise_error(F.concat(F.lit("unknown edge function: "), F.col(fn))).cast(df.schema[value].dataType)
    for name, f in EDGE_FUNCTIONS.items():
        expr = F.when(F.col(fn) == name, f(F.col(value))).otherwise(expr)
    return df.withColumn(out, F.when(F.col(fn).isNull(), F.col(value)).otherwise(expr))
