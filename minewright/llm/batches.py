"""Arrow batches for whole texts, inputs that can be read twice, and column names that clash with none."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from minewright.session import cut

#: Rows per Arrow batch. The session's default of 10,000 long texts would fill a worker's memory.
ROWS = 2000


def bounded_batches(spark: SparkSession, rows: int = ROWS) -> None:
    """Let batches that go to Python hold at most ``rows`` rows, or what the session allows if that is less."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def lean(run):
    """``run`` for mapInArrow, after which a worker gives the memory that Arrow has pooled back."""

    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return whole


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


#: Plan nodes of a table read from files, perhaps filtered.
_SCAN = {"Project", "Filter", "LogicalRelation"}


def rereadable(df: DataFrame) -> DataFrame:
    """A table whose rows stand at the same places whenever and with whichever columns it is read.

    Files do. Anything else (a shuffle deals rows anew once a column is pruned) is written first.
    """
    nodes, found = [df._jdf.queryExecution().optimizedPlan()], set()
    while nodes:
        node = nodes.pop()
        found.add(node.nodeName().split(" ")[0])
        children = node.children()
        nodes += [children.apply(k) for k in range(children.size())]
    return df if found <= _SCAN and "LogicalRelation" in found else cut(df, "rows")
