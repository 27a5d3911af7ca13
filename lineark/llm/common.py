"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineark.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: rows handed to Python code at a time, so that a batch of long texts stays small
STEP = 256
#: longest entry, in bytes, of a table that is broadcast; longer ones take the way of the rare ones
ENTRY_BYTES = 64


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of one given table; the scan reads no others."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


#: removes the shuffle files of a write once it has ended; nothing reads them again
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: a lost executor costs a re-read of a shared file, never a
    re-run of the steps before.  The write's own shuffle files go when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote; for those whose last reader has run."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_row(df: DataFrame, **cols: Column) -> DataFrame:
    """``cols`` beside ``row``, a struct of all columns of ``df``: no name can clash with the table's own.
    ``select("row.*")`` gives the table back."""
    return df.select(F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in df.columns)).alias("row"), *(c.alias(name) for name, c in cols.items()))


def per_label(df: DataFrame, counts: dict[float, int], rows: int, *order: str) -> DataFrame:
    """At most ``rows`` rows of ``df``, the first of each ``label`` by ``order``: half of them for the
    rarer label or all that it has, the rest for the other.  ``counts`` has the rows of each label."""
    left, out = rows, df.limit(0)
    for at, label in enumerate(sorted(counts, key=lambda k: (counts[k], k))):
        take = min(counts[label], left // (len(counts) - at))
        left -= take
        out = out.unionByName(df.where(F.col("label") == label).orderBy(*order).limit(take))
    return out


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def as_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, null as empty: Python code then never meets a decoding error."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """Arrow map over ``df``: ``make()`` runs once per task and returns a function from
    a dict of column lists (at most ``STEP`` rows) to a dict of output column lists,
    or None for no rows.  Output columns may have any length, all the same."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator) -> Iterator:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                out = step(batch.slice(at, STEP).to_pydict())
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in fields], schema=fields)

    return df.mapInArrow(run, schema)


class Cache(dict):
    """A bounded memo: ``cache[key]`` computes a miss with ``fn`` and starts anew when full.

    Lookups of known keys run at the speed of a dict, so ``map(cache.__getitem__, keys)``
    stays out of Python code for all but the misses.
    """

    def __init__(self, fn: Callable, limit: int):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.fn(key)
        return value
