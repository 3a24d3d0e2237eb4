"""Running totals and dense numbering that never pull a whole order into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.session import cut


def running_totals(df: DataFrame, by: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Inclusive running sums per ``by`` group in the order of ``order`` (unique within the group).

    Rows are range-partitioned by group and order, totalled inside each partition, and shifted by
    the totals of the partitions before: even a group that spans the cluster is never in one task.
    The ranged rows are written once, since a second range sampling could place them differently.
    """
    columns = df.columns
    for name, value in sums.items():
        df = df.withColumn(f"_v_{name}", value)
    ranged = cut(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row per (partition, group): few rows, whatever the data.
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_part", *by).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
               .select("_part", *by, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums]))
    local = ranged.select("_part", *columns, *[F.sum(f"_v_{n}").over(inside).alias(f"_l_{n}") for n in sums])
    return local.join(offsets, ["_part", *by]).select(
        *columns, *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums])


def numbered(df: DataFrame, by: list[str], order: list[str], name: str, start: int = 0) -> DataFrame:
    """Dense consecutive numbers per ``by`` group, counted from ``start``."""
    return (running_totals(df, by, order, {name: F.lit(1).cast("long")})
            .withColumn(name, F.col(name) + (start - 1)))
