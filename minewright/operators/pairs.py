"""Pairing the rows that share a key, without a hot key landing in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SPAN = 1 << 31


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash-partition by the coming join keys, with all shuffle partitions.

    A pairing join turns few bytes into much work; sized by bytes alone, small inputs would be
    merged into one task. The join reuses the partitioning of both sides, so nothing moves twice.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def paired(df: DataFrame, key: list[str], item: str, block: int = 1000) -> DataFrame:
    """Every unordered pair of rows with equal ``key`` and different ``item``, as structs ``x`` and ``y``.

    A key with more than ``block`` rows is cut into blocks by a hash of ``item``; each pair of
    blocks is a join group of its own, so no group holds more than about ``block`` rows a side
    and the pairs of a hot key spread over the cluster. No pair is lost or repeated. Blocks
    follow the hash order and so do ``x`` and ``y``: a pair has the same order under every key.
    """
    hot = (df.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > block)
           .select(*key, F.ceil(F.col("_n") / block).alias("_blocks")))
    rows = (df.withColumn("_hash", F.pmod(F.xxhash64(item), F.lit(SPAN))).join(hot, key, "left")
            .withColumn("_blocks", F.coalesce("_blocks", F.lit(1).cast("long")))
            .withColumn("_block", F.shiftright(F.col("_hash") * F.col("_blocks"), 31)))
    keys = [F.col(k) for k in key]
    payload = F.struct("_hash", *df.columns)
    left = rows.select(*keys, F.col("_block").alias("_lo"),
                       F.explode(F.sequence("_block", F.col("_blocks") - 1)).alias("_hi"), payload.alias("x"))
    right = rows.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), "_block")).alias("_lo"),
                        F.col("_block").alias("_hi"), payload.alias("y"))
    ordered = (F.col("x._hash") < F.col("y._hash")) | (
        (F.col("x._hash") == F.col("y._hash")) & (F.col(f"x.{item}") < F.col(f"y.{item}")))
    keys = [*key, "_lo", "_hi"]
    met = spread(left, keys).join(spread(right, keys), keys)
    return met.where(ordered).select(*key, "x", "y")


def spread_join(left: DataFrame, right: DataFrame, key: list[str], block: int = 500) -> DataFrame:
    """Equi-join where a key with many ``right`` rows is cut into blocks that ``left`` visits one by one."""
    hot = (right.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > block)
           .select(*key, F.ceil(F.col("_n") / block).alias("_blocks")))
    payload = F.xxhash64(*right.columns)
    blocks = F.coalesce("_blocks", F.lit(1).cast("long"))
    there = right.join(hot, key, "left").select(*right.columns, F.pmod(payload, blocks).alias("_block"))
    here = left.join(hot, key, "left").select(*left.columns, F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("_block"))
    keys = [*key, "_block"]
    return spread(here, keys).join(spread(there, keys), keys).drop("_block")
