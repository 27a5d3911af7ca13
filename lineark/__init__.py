"""lineark: provenance records, workflow graphs and series features as Spark jobs.

Every operator is a plain function from DataFrame(s) to a DataFrame built from
Spark's own joins, aggregates, windows and higher-order functions.  Loops exist
only where the work is a fixed point (graph closure and levels) and they cut
lineage with reliable checkpoints.
"""

from lineark.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
